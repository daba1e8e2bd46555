import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakewright.llm import packing as p

WHOLE = Tokenizer.from_file(p.default_vocabulary())


def reference(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


def test_tokens_as_the_tokenizer():
    r, tokens = random.Random(0), p.Tokens(p.default_vocabulary())
    letters = [*"aAzZ09'sté ÀßÖ!?<|>&;\n\t.-_«…»İıǅ́ア漢ﬁ½²\x1c\u2003", "'S", "'ll", "I'LL", "<|endoftext|>", "x's"]
    for _ in range(5000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 14)))
        assert tokens(text).tolist() == reference(text), repr(text)


def check(rows, texts, ids, pad_share=None):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for k, text in zip(ids, texts, strict=True):
        tokens, at = reference(text), 0
        for r in sorted(by_doc[k], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(tokens) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(tokens[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(tokens)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding


def test_pieces(spark, documents):
    r = random.Random(1)
    texts = [None, "", "one", "é漢 " * 3000] + [" ".join(r.choice(["the", "of", "xyzzy", "42"]) for _ in range(int(r.expovariate(1 / 300)) + 1)) for _ in range(150)] + ["long word " * 20_000]
    rows = p.query(documents(texts).repartition(3)).collect()
    assert check(rows, texts, range(len(texts))) <= 3 * 2048


def test_same_rows_again(spark, documents):
    docs = documents([f"text number {k} " * (k % 90 + 1) for k in range(120)]).coalesce(2)
    assert sorted(map(tuple, p.query(docs).collect())) == sorted(map(tuple, p.query(docs).collect()))


def test_empty_and_null_id(spark, documents):
    assert p.query(documents([]).limit(0)).count() == 0
    assert [r["length"] for r in p.query(spark.createDataFrame([(None, "a")], "doc_id long, text string")).collect()] == [2]


@pytest.mark.parametrize("seed", range(4))
def test_pack_loses_nothing(seed):
    r = random.Random(seed)
    pieces = [p.Piece(k, n, 0, np.arange(n, dtype=np.uint32)) for k, n in enumerate(int(r.paretovariate(0.7) * 20) % 9000 + 1 for _ in range(300))]
    full, left = p.pack(pieces)
    assert all(p.length_of(w) in p.TIERS for w in full) and p.length_of(left) < 2 * p.LONGEST
    cuts = sorted((x.doc, x.start, len(x.ids)) for w in [*full, left] for x in w)
    at = defaultdict(int)
    for doc, start, n in cuts:
        assert start == at[doc]
        at[doc] += n
    assert at == {x.doc: x.total for x in pieces}


def test_step_groups_hold_one_length_and_equal_tokens(spark, documents, monkeypatch):
    monkeypatch.setattr(p, "STEP", 4)
    r = random.Random(2)
    texts = [" ".join(r.choice(["the", "of", "xyzzy", "42"]) for _ in range(int(r.expovariate(1 / 400)) + 1)) for _ in range(250)]
    numbers, held, groups = p.Numbering(0), [], defaultdict(lambda: defaultdict(int))
    tokens = p.Tokens(p.default_vocabulary())
    batches = []
    for k, t in enumerate(texts):
        ids = tokens(t)
        held.append(p.Piece(k, len(ids), 0, ids))
        if k % 60 == 59:
            windows, held = p.pack(held)
            batches.append(numbers.rows(windows))
    windows, held = p.pack(held)
    batches.append(numbers.rows(windows + p.tail_windows(held)))
    sizes = {}
    for b in batches:
        for x in b.to_pylist():
            groups[x["step_group"]][x["sequence_id"]] += x["length"]
            assert sizes.setdefault(x["step_group"], x["window"]) == x["window"]
    smaller = defaultdict(int)
    for g, windows in groups.items():
        full = all(n == sizes[g] for n in windows.values())
        smaller[sizes[g]] += len(windows) < 4 or not full
    assert len(groups) > 8 and all(n <= 1 for n in smaller.values())
