"""Queries on tables that the smallest driver tables do not show: larger ids, several files."""

import json
import os

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakewright import registry
from lakewright.functions import aspects
from lakewright.sources import landing

WHERE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(WHERE), reason="the driver's tables are not here")


def tables(spark, to, **made) -> str:
    """The smallest tables, some of them made anew."""
    for t in ("documents", "labels", "events", "embeddings"):
        made.get(t, spark.read.parquet(f"{WHERE}/{t}.parquet")).write.parquet(f"{to}/{t}.parquet")
    return str(to)


def by_sql(where, name) -> list[tuple]:
    con = duckdb.connect()
    for t in ("documents", "labels", "events", "embeddings"):
        con.execute(f"create view {t} as select * from '{where}/{t}.parquet/*.parquet'")
    return sorted(con.execute(registry.oracle_sql()[name]).fetchall())


def test_cleanse_of_ids_with_repeated_digits(spark, tmp_path):
    documents = spark.read.parquet(f"{WHERE}/documents.parquet").filter("doc_id < 30")
    where = tables(spark, tmp_path, documents=documents.withColumn("doc_id", F.col("doc_id") + 22_210).union(documents.withColumn("doc_id", F.col("doc_id") + 12_345_678_900)))
    got = sorted(map(tuple, registry.queries()["m04_cleanse_parts"](spark, where).select("platform_review_id", "refined_text", "processing_status").collect()))
    assert got == by_sql(where, "m04_cleanse_parts")
    assert any(r[1] == "review 22230" for r in got)


@pytest.mark.parametrize("name", ["st01_incremental_pickup", "st02_redelivery_stream"])
def test_streams_get_files_of_many_tasks(spark, tmp_path, monkeypatch, name):
    where = tables(spark, tmp_path / "in", documents=spark.read.parquet(f"{WHERE}/documents.parquet").repartition(3))
    monkeypatch.setattr(registry, "_scratch", lambda _: f"file://{tmp_path}/out")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = registry.queries()[name](spark, where).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, got)) == by_sql(where, name)
    assert all(len(list((tmp_path / f"out/bronze/d{run}").glob("part-*"))) > 1 for run in (0, 1))


def test_spans_leave_in_small_batches():
    """A worker does not hold the spans of a whole batch, and takes the next one only when those of the first have left."""
    taken = []
    batches = (taken.append(k) or pa.array([None if n % 50 == 0 else f"a b{n}" for n in range(200)]) for k in range(2))
    got = aspects.span_batches(batches, lambda text: [("b", 2, 3)])
    sizes = []
    for n, out in enumerate(got):
        sizes.append(len(out))
        assert len(taken) == n // 4 + 1
        assert [x is None for x in out.to_pylist()] == [(k + 64 * (n % 4)) % 50 == 0 for k in range(len(out))]
    assert sizes == [64, 64, 64, 8] * 2
    assert out.to_pylist()[1] == [{"keyword": "b", "start": 2, "end": 3, "context": "a b193"}]


def test_pages_of_a_feed_share_files(spark, tmp_path, monkeypatch):
    """Four times the ids are more pages, not more files."""
    files = []
    for run, n in enumerate((1, 4)):
        documents = spark.read.parquet(f"{WHERE}/documents.parquet").join(spark.range(n), how="cross")
        where = tables(spark, tmp_path / f"in{run}", documents=documents.withColumn("doc_id", F.col("doc_id") + 200 * F.col("id")).drop("id").coalesce(1))
        monkeypatch.setattr(registry, "_scratch", lambda _, run=run: f"file://{tmp_path}/out{run}")
        df = registry.queries()["s01_s03_appstore_pages"](spark, where)
        assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, by_sql(where, "s01_s03_appstore_pages")))
        files.append(len(list((tmp_path / f"out{run}").rglob("part-*"))))
    assert files[1] <= max(4, files[0])


def test_entries_of_an_app_in_page_order(spark, tmp_path):
    """Files and bundles alike: the cap goes over pages, the app's own entry does not count, an empty page ends the app."""
    entry = lambda k: {"id": {"label": f"r{k}"}, "content": {"label": "x"}, "im:rating": {"label": "3"}}
    pages = {("a", 1): [{"im:name": {"label": "A"}}, entry(1), entry(2)], ("a", 2): [entry(3)], ("a", 10): [entry(4), entry(5)], ("b", 1): entry(6), ("b", 2): None, ("b", 3): [entry(7)]}
    lines = []
    for (app, page), e in pages.items():
        value = json.dumps({"feed": {"entry": e} if e else {}})
        (tmp_path / f"store/{app}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"store/{app}/{page}.json").write_text(value)
        lines.append(json.dumps({"app": app, "page": page, "value": value}))
    (tmp_path / "bundle").write_text("\n".join(lines))
    for feed in (landing.appstore_pages(spark, f"file://{tmp_path}/store"), landing.appstore_bundles(spark, f"file://{tmp_path}/bundle")):
        found = lambda most: sorted(r[0] for r in landing.appstore_reviews(feed, most).select("platform_review_id").collect())  # noqa: E731, B023
        assert [found(n) for n in (0, 1, 2, 4, 9)] == [[], ["r1", "r6"], ["r1", "r2", "r6"], ["r1", "r2", "r3", "r4", "r6"], ["r1", "r2", "r3", "r4", "r5", "r6"]]
        assert sorted(map(tuple, landing.app_names(feed).collect())) == [("a", "A"), ("b", "app_b")]
