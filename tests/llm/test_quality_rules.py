import random
import re
from collections import Counter

from lakewright.llm import quality_rules as q

GOOD = "The cat sat on the mat and looked at the door. It was a quiet day, and nobody came by until the late evening."


def base(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if any(c not in " \t\n\x0b\x0c\r" for c in x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def fails(line):
    """The rules for one line, one after the other."""
    words, low = re.split(r"[\x20\x09-\x0D]+", line.strip(" ")), line.lower()
    n, size = len(words), len(line)
    short = size <= q.SHORT_LINE
    marks = sum(c in "|»" for c in line)
    said = sum(map(len, re.findall("|".join(q.BOILERPLATE), low)))
    several = [set(words[i : i + q.STRETCH]) for i in range(0, n, q.STRETCH)]
    return (
        sum(c in "#*$%&|<>" for c in line) * 10 > size
        or n >= 4 and sum(c in "!?" for c in line) * 2 > n
        or marks >= 3 and (short or marks * q.MARKS_SHARE > size)
        or n >= 5 and sum("A" <= c <= "Z" for c in line) * 2 > size
        or n >= 8 and len(set(words)) * 3 < n and (n <= q.STRETCH or sum(map(len, several)) * 3 < n)
        or said > 0 and (short or said * 10 > size)
    )


def verdict(text):
    """(kept, the text without failing lines)."""
    text = text or ""
    good = "\n".join(x for x in text.split("\n") if not re.search(r"[^\x20\x09-\x0D]", x) or not fails(x))
    n, *_, repeated = base(text)
    return n >= 20 and 100 * repeated <= 30 * n and 2 * (len(text) - len(good)) <= len(text), good


def any_line(r):
    vocabulary = [f"{a}{b}" for a in ("ba", "de", "ki", "lo", "mu", "é", "so") for b in ("n", "rt", "st", "")]
    kind, some = r.randrange(10), lambda k, words=vocabulary: " ".join(r.choice(words) for _ in range(k))
    return (
        "", " \t ", some(r.randint(1, 90)), some(r.randint(5, 12)).upper(), some(r.randint(8, 300), vocabulary[: r.randint(1, 6)]), some(r.randint(1, 90)) + " " + r.choice(q.BOILERPLATE).title(),
        " ".join(r.choice(["|", "»", some(r.randint(1, 12))]) for _ in range(r.randint(1, 16))), some(6) + r.choice("!?") * r.randint(1, 5), r.choice("#*$%&<>") * r.randint(1, 3) + some(r.randint(1, 12)),
        "\t" + some(r.randint(1, 30)) + "\r",
    )[kind]


TEXTS = [
    None, "", " \t\n", GOOD, GOOD + "\n" + GOOD, "word " * 50, "one two three four five six seven eight nine " * 3 + GOOD, "a|b|c|d\n" + GOOD, " x  é😀 " * 30,
    "BUY NOW THIS GREAT THING TODAY FOR FREE!!! " * 3 + "\n" + GOOD[:30], GOOD + "\nAccept all cookies\nHome | News | Sport | Contact", " ".join(f"w{k}" for k in range(30_000)),
    "\n\n\n" + GOOD, "x$$$ y*** z### " * 20,
]


def test_base_as_brute_force(spark, documents):
    rows = q.query(documents(TEXTS)).orderBy("doc_id").collect()
    for r, t in zip(rows, TEXTS, strict=True):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base(t), t and t[:50]
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    kept = [k for k, r in enumerate(rows) if r["kept"]]
    assert kept == [3, 7, 10, 11, 12]


def test_verdicts_as_brute_force(spark, documents):
    r = random.Random(11)
    texts = TEXTS + ["\n".join(any_line(r) for _ in range(r.randint(1, 12))) for _ in range(500)]
    docs = documents(texts)
    assert {x["doc_id"]: x["kept"] for x in q.query(docs).collect()} == {k: verdict(t)[0] for k, t in enumerate(texts)}
    expected = {k: got[1] for k, t in enumerate(texts) if (got := verdict(t))[0]}
    assert {x["doc_id"]: x["text"] for x in q.stage(docs).collect()} == expected
    assert 50 < len(expected) < 450


def test_stage_removes_lines(spark, documents):
    docs = documents(TEXTS)
    out = q.stage(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[10]["text"] == GOOD and rows[10]["n_chars"] == len(GOOD)
    assert rows[3]["text"] == GOOD and sorted(rows) == [3, 7, 10, 11, 12]


def test_native_plan_and_empty(spark, documents):
    df = q.query(documents(TEXTS).limit(0))
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in q.query(documents(TEXTS))._jdf.queryExecution().executedPlan().toString()


def test_long_lines_with_a_mark_stay(spark, documents):
    r = random.Random(5)
    plain = " ".join(f"{a}{b}" for a in "bcdfghjklm" for b in ("ade", "ilo", "una", "ore"))
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "lo", "ma")]
    prose = " ".join(r.choice(vocabulary) for _ in range(6_000))  # 300 different words: under a third
    long = [f"{plain} {x} {plain[::-1]}" for x in ("our Privacy Policy says so", "the terms of use hold", "click here to read", "a | b | c » d")]
    junk = ["accept cookies or read our privacy policy " + plain[:150], " ".join(f"link{k} |" for k in range(100)), "click here to x " * 30 + plain, " ".join(r.choice(["la", "lo", "le"]) for _ in range(500))]
    texts = [*long, prose, *junk, plain + "\n" + junk[0][:60]]
    rows = {x["doc_id"]: x["text"] for x in q.stage(documents(texts)).collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4, 9]
    assert all(rows[k] == (plain if k == 9 else texts[k]) for k in rows)
    assert {x["doc_id"] for x in q.query(documents(texts)).collect() if x["kept"]} == rows.keys()
