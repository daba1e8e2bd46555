import hashlib
import zlib

from lakewright.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, rank int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path(made, i):
    out = []
    for level in made[:-1]:
        a = i // 16 * 16
        out.append((level[a:i], level[i + 1 : a + 16]))
        i //= 16
    return out


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    digest = lambda r: h(*map(field, r))
    order = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, digest(r)))
    names = list(dict.fromkeys(r[1] for r in order))
    trees = {n: [r for r in order if r[1] == n] for n in names}
    made = {n: levels([digest(r) for r in x]) for n, x in trees.items()}
    top = levels([made[n][-1][0] for n in names])
    root, out = top[-1][0], []
    for k, n in enumerate(names):
        for i, r in enumerate(trees[n]):
            steps = path(made[n], i) + path(top, k)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            f = digest((*r[:4], text))
            for a, b in steps:
                f = h(*a, f, *b)
            out.append((r[0], digest(r), made[n][-1][0], root, h(*(x for a, b in steps for x in (*a, *b))), f, f == root))
    return out


def check(spark, rows):
    got = merkle.query(spark.createDataFrame([(*r, "x", 0) for r in rows], COLUMNS))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_against_brute_force(spark):
    rows = [(k, ["a", "b", None, "", "ä", "-"][k % 6 if k % 7 else 0], "en", k, f"Text {k}") for k in range(400)]
    rows += [(1000, "a", None, None, None), (None, "a", "en", 1, "Null id"), (None, "a", "en", 1, "Null id"), (None, None, None, None, None)]
    rows += [(5, "a", "en", 5, "Same id"), (5, "a", "en", 5, "Same id"), (1001, "lone", "de", 0, ""), (1002, "a", "de", 9, "Ünï \U0001f600 Long" * 5000), (1 << 60, "b", "x", 1, "Y")]
    check(spark, rows)


def test_a_source_of_several_blocks_and_many_sources(spark):
    rows = [(k, "hot", "en", k, f"T{k}") for k in range(merkle.BLOCK * 2 + 1)]
    rows += [(k, f"s{k % 300}", "en", k, f"U{k}") for k in range(20_000, 20_700)]
    check(spark, rows)


def test_one_row_and_none(spark):
    check(spark, [(7, "s", "en", 1, "X")])
    assert merkle.query(spark.createDataFrame([], COLUMNS)).collect() == []


def test_tampering_shows(spark):
    """Only rows whose text tampering changes fail, and each of them does."""
    rows = [(k, "s", "en", 3, "Abc" if k % 2 else "abc") for k in range(200)]
    got = {r.doc_id: r.verified for r in merkle.query(spark.createDataFrame([(*r, "", 0) for r in rows], COLUMNS)).collect()}
    assert got == {k: not (k % 2 and zlib.crc32(str(k).encode()) % 5 == 0) for k in range(200)}
