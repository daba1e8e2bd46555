import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lakewright.llm import substring_dedup as sd


def brute(rows):
    """rows: (doc_id, text)."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            if d is not None:
                least[key] = min(least.get(key, d), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - 12):
            if d is not None and least[tuple(w[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def check(documents, rows):
    got = sd.query(documents([t for _, t in rows], [d for d, _ in rows]))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def texts(rng, n, vocabulary, passages):
    for d in range(n):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            if rng.random() < 0.4:
                p = rng.choice(passages)
                a = rng.randrange(len(p))
                parts += p[a : a + rng.randrange(5, 40)]
            parts += rng.choices(vocabulary, k=rng.randrange(0, 30))
        yield d, rng.choice([" ", "\n", " \t "]).join(parts)


def test_against_brute_force(documents):
    rng = random.Random(3)
    vocabulary = [f"wörd{k}" for k in range(3000)] + ["a", "b", " ", "\U0001f600"]
    passages = [rng.choices(vocabulary, k=60) for _ in range(5)]
    rows = list(texts(rng, 250, vocabulary, passages))
    rows += [(1000 + k, t) for k, (_, t) in enumerate(rows[:20])]  # exact copies
    rows += [(900, " ".join(passages[0]) + "\x0bend"), (901, " ".join(passages[0][:12])), (902, " ".join(passages[0][:13])), (903, None), (904, "")]
    rows += [(None, " ".join(passages[1])), (None, " ".join(passages[1])), (905, "x"), (905, " ".join(passages[2])), (905, " ".join(passages[2]))]
    rows += [(1 << 60, " ".join(passages[3])), (906, "  " + "long" * 100_000 + " " + " ".join(passages[4]) + "  ")]
    check(documents, rows)


def test_few_words_repeat_everywhere(documents):
    """Windows of two words only: every block is met everywhere, within a text as well."""
    rng = random.Random(4)
    check(documents, [(d, " ".join(rng.choices("ab", k=rng.randrange(0, 80)))) for d in range(150)])
    check(documents, [(d, "a " * (d % 40)) for d in range(120)])


@pytest.mark.parametrize("shift", range(15))
def test_a_repeat_shows_at_every_alignment(shift):
    """Plain check of the anchors: a window of 13 words at any place holds a whole block of 7."""
    assert any(shift <= p and p + sd.BLOCK <= shift + sd.WINDOW for p in range(0, shift + sd.WINDOW, sd.BLOCK))


def test_no_rows(documents, spark):
    assert sd.query(documents([])).collect() == []


def test_texts_that_are_left(documents):
    passage = " ".join(f"p{k}" for k in range(13))
    got = {r.doc_id: r.kept for r in sd.dedup(documents([f"{passage} one", f"two\n{passage}  three"]), texts=True).collect()}
    assert got == {0: f"{passage} one", 1: "two three"}


def test_hot_windows_go_over_salts(documents, monkeypatch):
    monkeypatch.setattr(sd, "HOT", 5)
    monkeypatch.setattr(sd, "SENT", 0)
    passage = " ".join(f"p{k}" for k in range(14))
    rng = random.Random(5)
    check(documents, [(d, f"{passage} {' '.join(rng.choices([f'w{k}' for k in range(500)], k=200))}") for d in range(60)])


def test_words_and_hashes_in_pieces(monkeypatch):
    monkeypatch.setattr(sd, "SPAN", 64)
    batch = ["", " a  b\tc ", "x" * 500 + " y", "", "a b c d " * 40, " "]
    words = sd.Words(pa.array(batch).slice(0))
    found = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends)]
    assert found == [w for t in batch for w in t.split()]
    assert words.counts.tolist() == [len(t.split()) for t in batch]
    by_word = {}
    for w, h in zip(found, words.hashes.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    part = sd.Words(pa.array(batch).slice(1, 2))
    assert np.array_equal(part.counts, [3, 2])
