import random

import numpy as np
import pytest

from lakewright.llm import ngram_join as j


def sets_of(texts, n):
    out = []
    for t in texts:
        w = (t or "").encode().lower().decode().split() if t else []
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    return out


def brute(texts, ids, n, percent):
    sets = sets_of(texts, n)
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    groups = {}
    for k in range(len(texts)):
        groups.setdefault(root(k), []).append(ids[k])
    return sorted((ids[k], len(sets[k]), min(groups[root(k)])) for k in range(len(texts)))


def corpus(seed=1):
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 60)}"
    texts = [None, "", "  \n", "one", "One", "one two", "a b c", "A B\tC"]
    for _ in range(12):
        base = [word() for _ in range(r.randint(20, 90))]
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 9)):
            x = list(base)
            for _ in range(r.randint(0, 4)):
                x[r.randrange(len(x))] = word()
            texts.append(" ".join(x) + r.choice(["", " ", " tail"]))
    r.shuffle(texts)
    ids = r.sample(range(1000), len(texts))
    return texts, ids


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_as_brute_force(spark, documents, n, percent):
    texts, ids = corpus()
    got = sorted(tuple(r) for r in j.join(documents(texts, ids), n, percent).collect())
    assert got == brute(texts, ids, n, percent)


def test_large_buckets_in_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(j, "SMALL", 2)
    monkeypatch.setattr(j, "BLOCK", 3)
    texts, ids = corpus(2)
    got = sorted(tuple(r) for r in j.join(documents(texts, ids), 3, 80).collect())
    assert got == brute(texts, ids, 3, 80)


def test_repeated_rows_null_ids_and_long_texts(spark, documents):
    long = " ".join(f"w{k}" for k in range(30_000))
    docs = documents([long, long, "a b c d", "a b c d", None], [5, 5, 7, 2, 9])
    assert sorted(tuple(r) for r in j.query(docs).collect()) == [(2, 2, 2), (5, 29_998, 5), (5, 29_998, 5), (7, 2, 2), (9, 0, 9)]
    assert j.query(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b c d"), (3, "a b c d")], "doc_id long, text string")
    assert {r["component_id"] for r in j.query(odd).collect()} == {3}


def test_stage_keeps_one(spark, documents):
    texts, ids = corpus(3)
    docs = documents(texts, ids)
    kept = {r["doc_id"] for r in j.stage(docs).collect()}
    assert kept == {c for _, _, c in brute(texts, ids, 5, 80)}
    assert j.stage(docs).columns == docs.columns
    assert j.stage(docs.union(docs)).count() == len(kept)


def test_prefix_filter_bound():
    for n in range(1, 60):
        for m in range(n, 60):
            for percent in (80, 90):
                need = -(-percent * (n + m) // (100 + percent))  # the least intersection that reaches the threshold
                if need <= n:
                    assert n - need + 1 <= j.prefix_size(n, percent) and m - need + 1 <= j.prefix_size(m, percent)


def test_upper_bound_never_drops_a_link():
    r = np.random.default_rng(0)
    for _ in range(300):
        x = np.unique(r.integers(0, 2**63, 200, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: r.integers(150, 200)], r.integers(0, 2**63, r.integers(0, 30), dtype=np.uint64)]))
        if j.reaches(x, y, 80):
            assert j.may_reach(j.summary_of(x, 80), len(x), j.summary_of(y, 80), len(y), 80)


def test_components(spark):
    chain = [(f"k{i:03d}", f"k{i + 1:03d}") for i in range(40)] + [("x1", "x2"), ("x1", "x3"), ("x3", "x2")]
    got = {r["key"]: r["root"] for r in j.components(spark.createDataFrame(chain, "a string, b string")).collect()}
    assert all(v == ("x1" if k[0] == "x" else "k000") for k, v in got.items()) and len(got) == 44


def test_stage_with_null_and_repeated_ids(spark, documents):
    big = 2**60 + 1
    long = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcdefgh"]
    rows = [
        (None, long[0]), (None, long[1]), (None, long[1]), (None, long[2] + " x"), (7, long[2]),  # null ids: different, copies, copy of 7
        (5, long[3]), (5, long[4]), (5, long[4]), (3, long[3]), (5, ""), (5, None), (5, None),  # 5: three texts, one a copy of 3
        (None, None), (None, " "), (big, long[5]), (None, long[5] + " y"), (None, long[6]), (None, long[6] + " z"), (9, long[7]),
    ]
    docs = documents([t for _, t in rows], [k for k, _ in rows])
    got = sorted(((r["doc_id"], r["text"]) for r in j.stage(docs).collect()), key=repr)
    one = [x for x in got if x in ((None, long[6]), (None, long[6] + " z"))]
    assert len(one) == 1
    expected = [(None, long[0]), (None, long[1]), (7, long[2]), (3, long[3]), (5, long[4]), (5, ""), (5, None), (None, None), (None, " "), (big, long[5]), (9, long[7])]
    assert got == sorted(expected + one, key=repr)
    assert j.stage(docs).columns == docs.columns


def test_slices_sum_over_several_rounds(spark, monkeypatch):
    import zlib

    monkeypatch.setattr(j, "FAN", 3)
    rows = [(part, task, j._packed(np.array([task, 1, 0, 2**31]))) for part in range(2) for task in range(20)]
    got = dict(j._summed(spark.createDataFrame(rows, "part int, task int, counts binary")))
    expected = np.rint(np.log2(1.0 + np.array([sum(range(20)), 20, 0, 2**32 - 1])) * 2048).clip(0, 65535)
    assert set(got) == {0, 1} and all(np.frombuffer(zlib.decompress(x), np.uint16).tolist() == expected.tolist() for x in got.values())


@pytest.mark.parametrize("pivot_bytes", [0, 1 << 20])
def test_many_near_copies(spark, documents, monkeypatch, pivot_bytes):
    """Groups of near copies, a chain, and texts that share words with all: as brute force, by pivots and blocks."""
    monkeypatch.setattr(j, "PIVOT_BYTES", pivot_bytes)
    monkeypatch.setattr(j, "SMALL", 8)
    monkeypatch.setattr(j, "BLOCK", 16)
    monkeypatch.setattr(j, "BLOCK_TOKENS", 900)
    r = random.Random(6)
    base = [f"w{k}" for k in range(50)]
    texts = []
    for _ in range(120):
        x = list(base)
        for _ in range(r.randint(0, 2)):
            x[r.randrange(50)] = f"v{r.randint(0, 999)}"
        texts.append(" ".join(x))
    texts += [" ".join([f"s{k}" for k in range(at, at + 40)]) for at in range(0, 60, 2)]  # each links with the next
    texts += [" ".join(base[:25] + [f"z{k}-{i}" for i in range(r.randint(15, 90))]) for k in range(30)]
    got = sorted(tuple(x) for x in j.join(documents(texts), 3, 80).collect())
    assert got == brute(texts, list(range(len(texts))), 3, 80)
