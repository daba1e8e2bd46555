"""The pipeline against a brute-force version in plain Python, on small files."""

import random
from collections import defaultdict

import pytest

import corpus_pipeline
from lakewright.llm import packing, pii, queries
from tests.llm import test_decontaminate, test_ngram_join, test_pii, test_quality_rules
from tests.llm.test_quality_rules import GOOD, TEXTS


@pytest.fixture
def tables(spark, documents, tmp_path):
    r = random.Random(4)
    word = lambda: "".join(r.choice(["ba", "do", "ki", "lu", "me", "so"]) for _ in range(3))
    plain = [" ".join(word() for _ in range(r.randint(30, 80))) for _ in range(30)]
    passage = " ".join(word() for _ in range(14))
    texts = plain + TEXTS + [plain[0], plain[1] + " tail", plain[2].upper()[:40] + plain[2][40:], f"{plain[3]} {passage} {plain[4]}", passage + " " + word() * 7, f"{GOOD} call +1 (212) 555-0100 or a.b@c.de"]
    r2 = random.Random(8)
    texts += [f"{' '.join(word() for _ in range(25))} {x}" for x in test_pii.corpus(r2, 60)]
    texts += ["\n".join([GOOD.replace("cat", word()), test_quality_rules.any_line(r2), test_quality_rules.any_line(r2)]) for _ in range(40)]
    docs = documents(texts)
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return docs, passage, f"file://{tmp_path}"


def brute(rows, passage):
    """{doc_id: text} after the stages before packing."""
    judged = {k: test_quality_rules.verdict(t, True) for k, t in sorted(rows.items())}
    out = {k: t for k, (kept, t) in judged.items() if kept}
    groups = test_ngram_join.brute(list(out.values()), list(out), 5, 80)
    out = {k: out[k] for k, _, root in groups if k == root}
    for k in list(out):
        n, hit, *_ = test_decontaminate.brute(out[k], [(1, passage)])
        if hit * 2 > n:
            del out[k]
        elif hit:
            out[k] = out[k].replace(" " + passage, "")
    accepted = test_pii.brute_learn(list(out.values()))
    assert "token=" in accepted
    return {k: pii.mask(t, test_pii.all_spans(t, accepted)) for k, t in out.items()}


def test_stage_by_stage(spark, tables):
    docs, passage, where = tables
    seen = docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, seen, where)
        assert out.columns == docs.columns, name
        assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in seen.collect()}
        seen = out
    expected = brute({r["doc_id"]: r["text"] for r in docs.collect()}, passage)
    assert {r["doc_id"]: r["text"] for r in seen.collect()} == expected
    tokens = packing.Tokens(packing.default_vocabulary())
    length = defaultdict(int)
    for r in corpus_pipeline.run(spark, where).collect():
        length[r["doc_id"]] += r["length"]
        assert r["doc_tokens"] == len(tokens(expected[r["doc_id"]]))
    assert length == {k: len(tokens(t)) for k, t in expected.items()}


def test_registry():
    assert [name.split("_")[0] for name in queries.queries()] == [f"op{n}" for n in range(1, 11)]
    assert set(queries.oracle_sql()) == {"op2_line_rules", "op4_decontaminate", "op5_ngram_join", "op10_seekable_warc"}
