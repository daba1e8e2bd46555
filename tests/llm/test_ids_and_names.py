"""Every operator beside null ids, ids beyond 2^53, extra columns of any name and repeated rows; every stage the same."""

import random

import pytest
from pyspark.sql import functions as F

from lakewright.llm import decontaminate, ngram_join, packing, pii, quality_rules, queries

BIG = 2**60
#: Names that operators use for columns of their own, in any of their tables.
NAMES = (
    "row body changed base spans n runs items q t w l h s d solid good at key hash id size short part task counts token root set summary host path rest rule said verdict score "
    "predicted held_out winner digest salt bundle frame window label place doc __n __spans __t __w __q __at"
).split()
WORDS = "the house stood on a hill and it was there for as long as any of people in town could say while rivers ran past under old bridges".split()


def prose(seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice("abcdefgh") for _ in range(60)) + "."


TEXTS = [(BIG + 1, prose(1)), (BIG + 3, prose(2) + " mail a.b@c.de now"), (None, prose(3)), (BIG + 5, prose(2) + " mail a.b@c.de now"), (None, None), (7, ""), (BIG + 7, prose(5)), (BIG + 7, prose(5))]


@pytest.fixture
def tables(spark):
    extra = [F.lit("x" * k).alias(c) for k, c in enumerate(NAMES)] + [F.when(F.col("doc_id") != 7, F.col("doc_id")).alias("some_long")]
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").select("*", F.length("text").cast("long").alias("n_chars"), *extra).coalesce(1)
    pages = spark.createDataFrame([(k, f"http://a{k}.com/en/1", f"<article><p>{t}</p></article>") for k, t in TEXTS], "page_id long, url string, html string")
    pages = pages.select("*", *[F.lit("x").alias(c) for c in [*NAMES, "text"]]).coalesce(1)
    labels = spark.createDataFrame([(BIG + 1, 1, 0), (BIG + 3, 0, 1), (None, 1, 1), (BIG + 7, 1, 0)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(BIG + 9, prose(1)), (None, prose(3))], "item_id long, text string").withColumn("n", F.lit("x"))
    return {"documents": docs, "pages": pages, "labels": labels, "benchmark": benchmark}


@pytest.mark.parametrize("name", queries.queries())
def test_queries_keep_ids(tables, name):
    module, own = queries._QUERIES[name]
    out = __import__(f"lakewright.llm.{module}", fromlist=["query"]).query(*[tables[t] for t in own])
    got = [r[0] for r in out.collect()]
    expected = [k for k, _ in TEXTS]
    if name.startswith("op8"):
        got, expected = set(got), set(expected)
    assert sorted(got, key=str) == sorted(expected, key=str)


STAGES = {
    "quality": lambda t: quality_rules.stage(t["documents"]),
    "join": lambda t: ngram_join.stage(t["documents"]),
    "decontaminate": lambda t: decontaminate.stage(t["documents"], t["benchmark"]),
    "pii": lambda t: pii.stage(t["documents"]),
}
KEPT = {
    "quality": {BIG + 1, BIG + 3, BIG + 5, BIG + 7, None},
    "join": {BIG + 1, BIG + 3, BIG + 7, None, 7},
    "decontaminate": {BIG + 3, BIG + 5, BIG + 7, None, 7},
    "pii": {k for k, _ in TEXTS},
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_ids_and_columns(tables, name):
    docs = tables["documents"]
    out = STAGES[name](tables)
    assert out.dtypes == docs.dtypes
    rows, given = out.collect(), {r["doc_id"]: r for r in docs.collect() if r["doc_id"]}
    assert {r["doc_id"] for r in rows} == KEPT[name]
    for r in rows:
        assert [len(r[c]) for c in NAMES] == list(range(len(NAMES)))
        if r["doc_id"]:
            assert r["some_long"] == given[r["doc_id"]]["some_long"]
            assert r["n_chars"] == len(r["text"])


def test_repeated_rows_fare_alike(tables):
    for name in ("op1_pii_bootstrap", "op2_line_rules", "op4_decontaminate", "op6_toxicity_ftrl", "op7_quality_trees"):
        module, own = queries._QUERIES[name]
        out = __import__(f"lakewright.llm.{module}", fromlist=["query"]).query(*[tables[t] for t in own])
        twice = [tuple(r) for r in out.collect() if r["doc_id"] == BIG + 7]
        assert len(twice) == 2 and twice[0] == twice[1], name
    pieces = [r for r in packing.query(tables["documents"]).collect() if r["doc_id"] == BIG + 7]
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces) and sum(r["length"] for r in pieces) == 2 * pieces[0]["doc_tokens"]


@pytest.mark.parametrize("name", STAGES)
def test_stages_of_nothing(tables, name):
    none = tables | {"documents": tables["documents"].limit(0)}
    out = STAGES[name](none)
    assert out.count() == 0 and out.dtypes == none["documents"].dtypes


@pytest.mark.parametrize("name", ["op1_pii_bootstrap", "op4_decontaminate", "op9_block_text"])
def test_very_long_texts(spark, name):
    long = "word " * 400_000 + "a.b@c.de " + prose(1)
    module, own = queries._QUERIES[name]
    docs = spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string")
    pages = spark.createDataFrame([(1, "u", f"<article><p>{long}</p></article>")], "page_id long, url string, html string")
    bench = spark.createDataFrame([(1, prose(1))], "item_id long, text string")
    out = __import__(f"lakewright.llm.{module}", fromlist=["query"]).query(*[{"documents": docs, "pages": pages, "benchmark": bench}[t] for t in own])
    first = next(r for r in out.collect() if r[0] == 1)
    assert first["n_email"] == 1 if name.startswith("op1") else first["n_hit"] == 60 if name.startswith("op4") else first["n_chars"] == len(long)
