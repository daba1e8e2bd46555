"""Load to validation over a catalog, state transitions, dead letters, sources and sinks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakewright.functions import vectors
from lakewright.operators import joins, projections, state
from lakewright.plans import serving, steps
from lakewright.schemas import TABLES
from lakewright.sources import lake, landing
from lakewright.streaming import incremental

NOW = dt.datetime(2026, 5, 4, 3)
APP = "0190163d-8694-739b-aea5-966c26f8ad90"
REVIEW = "review_id string, app_id string, platform_type string, platform_review_id string, reviewer_name string, review_text string, rating int, reviewed_at timestamp, created_at timestamp, is_reply boolean, reply_comment string"


def review(k, text, rating=3, app=APP, day=3):
    at = dt.datetime(2026, 5, day, 9)
    return (f"r{k}", app, "APPSTORE", f"p{k}", "u", text, rating, at, at, None, None)


def frame(spark, table, rows):
    names = [f.split()[0] for f in TABLES[table].split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TABLES[table])


@pytest.fixture
def catalog(spark, tmp_path):
    c = lake.Catalog(spark, f"file://{tmp_path}/catalog")
    c.seed("apps", frame(spark, "apps", [dict(app_id=APP, platform_app_id="x", platform_type="APPSTORE", name="n")]), 1)
    c.seed("app_metadata", frame(spark, "app_metadata", [dict(id=1, app_id=APP, service_id="s", valid_from=dt.date(2025, 1, 1), is_active=True)]), 1)
    return c


def deliver(catalog, rows, tmp_path):
    return lake.daily_batch(catalog.spark.createDataFrame(rows, REVIEW), f"file://{tmp_path}/bronze", catalog, "APPSTORE", dt.date(2026, 5, 3), NOW)


def test_load_to_validation(catalog, tmp_path):
    rows = [review(1, "편리한 앱입니다", 5), review(2, "버그가 있어요", 1), review(3, "   하나", 3), review(1, "again", 4)]
    deliver(catalog, rows, tmp_path)
    got = {r.step: r for r in steps.run_steps(catalog, ["load", "cleanse", "gold", "aggregate", "validate"], NOW, "2026-05-03")}
    assert (got["load"].status, got["load"].input_count, got["load"].output_count) == ("success", 1, 3)
    assert (got["cleanse"].input_count, got["cleanse"].output_count) == (3, 3)
    assert (got["gold"].input_count, got["gold"].output_count) == (3, 2)
    assert got["aggregate"].status == "success"
    hub = {r["review_id"]: r for r in catalog.read("review_master_index").collect()}
    assert [hub[f"r{k}"]["processing_status"] for k in (1, 2, 3)] == ["ANALYZED", "ANALYZED", "FAILED"]
    assert (hub["r3"]["retry_count"], hub["r3"]["error_message"], hub["r1"]["service_id"]) == (1, "no aspects", "s")
    s = catalog.read("fact_service_review_daily").first()
    assert (s["total_review_cnt"], s["action_required_cnt"], s["pos_count"], s["neg_count"], s["avg_rating"]) == (2, 1, 1, 1, 3.0)
    # the batch was created on the next day: a warning, no failure
    assert got["validate"].status == "success" and got["validate"].message == "fresh_ingestion"
    # the same file again brings nothing new
    deliver(catalog, rows, tmp_path)
    assert steps.run_load(catalog, NOW).output_count == 0
    assert catalog.read("ingestion_batch").filter("status = 'LOADED'").count() == 2


def test_unknown_app_fails_daily_batch_until_dead(catalog, tmp_path):
    other = "0190163d-8694-739b-aea5-000000000000"
    deliver(catalog, [review(1, "x", app=other)], tmp_path)
    for k, status in ((1, "FAILED"), (2, "FAILED"), (3, "DEAD_LETTER")):
        assert other in steps.run_load(catalog, NOW).message
        b = catalog.read("ingestion_batch").first()
        assert (b["retry_count"], b["status"]) == (k, status)
    assert steps.run_load(catalog, NOW).input_count == 0
    assert [r["status"] for r in serving.batch_dead_letters(catalog.read("ingestion_batch"), 0).collect()] == ["DEAD_LETTER"]


def test_steps_stop_and_arguments(catalog):
    assert [r.step for r in steps.run_steps(catalog, ["nonsense", "load"], NOW)] == ["nonsense"]
    for bad in ({"target_date": "2026-05-03", "start_date": "2026-05-01", "end_date": "2026-05-02"}, {"start_date": "2026-05-01"}, {"target_date": "x"}):
        assert steps.run_aggregate(catalog, NOW.date(), **bad).status == "failed"
    assert steps.main(["--catalog", catalog.base, "--steps", "load,gold"], catalog.spark) == 0
    with pytest.raises(ValueError):
        steps.aggregate_range(catalog, dt.date(2026, 5, 2), dt.date(2026, 5, 1), NOW.date())


def test_range_keeps_good_days(catalog, tmp_path):
    deliver(catalog, [review(k, "편리한 앱", day=k) for k in (1, 2, 3)], tmp_path)
    steps.run_steps(catalog, ["load", "cleanse", "gold"], NOW)
    seen = []

    def one(c, first, last, as_of, retention):
        seen.append(first.day)
        if first.day == 2:
            raise OSError("lost")
        return steps.aggregate_days(c, first, last, as_of, retention)

    with pytest.raises(RuntimeError, match="2026-05-02"):
        steps.aggregate_range(catalog, dt.date(2026, 5, 1), dt.date(2026, 5, 3), NOW.date(), one=one)
    assert seen == [1, 2, 3]
    assert sorted(r["date"].day for r in catalog.read("fact_service_review_daily").collect()) == [1, 3]
    steps.aggregate_days(catalog, dt.date(2026, 5, 1), dt.date(2026, 5, 3), dt.date(2026, 5, 17))
    assert sorted(r["date"].day for r in catalog.read("srv_daily_review_list").collect()) == [3]


def test_cleanse_failure_marks(spark):
    rows = [dict(review_id="a", processing_status="RAW", retry_count=0), dict(review_id="b", processing_status="FAILED", error_message="gold", retry_count=1), dict(review_id="c", processing_status="ANALYZED", retry_count=0)]
    hub = frame(spark, "review_master_index", rows)
    out = {r["review_id"]: r for r in state.mark_cleanse_failed(hub, spark.createDataFrame([("a", "m"), ("b", "m"), ("c", "m")], "review_id string, message string")).collect()}
    assert (out["a"]["processing_status"], out["a"]["retry_count"], out["a"]["error_message"]) == ("FAILED", 1, "Cleanse failed: m")
    assert (out["b"]["error_message"], out["c"]["processing_status"]) == ("gold", "ANALYZED")
    with pytest.raises(LookupError):
        state.mark_cleanse_failed(hub, spark.createDataFrame([("z", "m")], "review_id string, message string"))


def test_validation_of_rows(spark):
    rows = spark.createDataFrame([review(1, "ok"), review(2, " "), review(3, "ok", 6)], REVIEW)
    good, bad = projections.split_valid(rows, projections.review_reasons())
    assert [r["review_id"] for r in good.collect()] == ["r1"]
    assert {r["review_id"]: list(r["reasons"]) for r in bad.collect()} == {"r2": ["review_text"], "r3": ["rating"]}
    with pytest.raises(ValueError):
        projections.split_valid(rows, projections.review_reasons(), strict=True)


def test_uuid7(spark):
    r = spark.range(200).select(projections.uuid7(F.lit(1_700_000_000_000), F.col("id")).alias("u")).collect()
    assert len({x["u"] for x in r}) == 200
    assert all(x["u"][14] == "7" and x["u"][19] in "89ab" and int(x["u"].replace("-", "")[:12], 16) == 1_700_000_000_000 for x in r)


def test_landing(spark, tmp_path):
    label = lambda x: {"label": x}
    entry = lambda k, stars, text="good": {"id": label(str(k)), "author": {"name": label("u")}, "content": label(text), "im:rating": label(stars), "updated": label("2026-02-04T12:00:00Z"), "im:version": label("1")}
    (tmp_path / "store/77").mkdir(parents=True)
    pages = {1: [{"im:name": label("My App")}, entry(1, "5"), entry(2, "x")], 2: entry(3, "9"), 3: None, 4: [entry(4, "1")]}
    for k, e in pages.items():
        (tmp_path / f"store/77/{k}.json").write_text(json.dumps({"feed": {"entry": e} if e else {}}))
    entries = landing.reader("AppStore")(spark, f"file://{tmp_path}/store")
    assert landing.app_names(entries).first()["name"] == "My App"
    got = landing.appstore_reviews(entries, 10).orderBy("platform_review_id").collect()
    assert [(r["platform_review_id"], r["rating"]) for r in got] == [("1", 5), ("2", 1), ("3", 5)]
    assert landing.appstore_reviews(entries, 2).count() == 2
    (tmp_path / "play.json").write_text("\n".join(json.dumps(x) for x in ({"reviewId": "a", "content": " hi ", "score": 4, "at": "2026-01-01T00:00:00", "appId": "z"}, {"reviewId": "b", "content": " "})))
    play = landing.reader("playstore") and landing.playstore_reviews(spark, f"file://{tmp_path}/play.json").collect()
    assert [(r["platform_review_id"], r["review_text"], r["rating"]) for r in play] == [("a", "hi", 4)]
    with pytest.raises(ValueError):
        landing.reader("other")
    (tmp_path / "ids.txt").write_text("1 # one\n\n# none\n2\n3\n")
    assert [r[0] for r in landing.app_ids(spark, f"file://{tmp_path}/ids.txt").collect()] == ["1", "2", "3"]

    def lost():
        raise OSError

    failures = []
    assert landing.union_of_successes([lost, lambda: spark.range(2)], failures.append).count() == 2 and len(failures) == 1


def test_lake(spark, tmp_path):
    base = f"file://{tmp_path}/lake"
    df = spark.range(3)
    folder = lake.write_batch(df, base, dt.date(2026, 3, 4))
    assert folder.endswith("year=2026/month=03/day=04") and lake.stats(spark, base)["partitions"] == 1
    with pytest.raises(ValueError):
        lake.write_batch(df.limit(0), base)
    assert lake.read_batch(spark, folder).count() == 3
    with pytest.raises(FileNotFoundError):
        lake.read_batch(spark, f"{base}/none")
    assert [lake.resolve(x, "b") for x in ("s3://k/x", "minio://x", "x/y", "/abs")] == ["s3a://k/x", "s3a://b/x", "s3a://b/x/y", "/abs"]
    assert lake.fill_path(r"${A}\$B/$C", {"A": "1", "C": "3"}) == "1/$B/3"
    silver = spark.createDataFrame([("a", "2026-01-01", 1), ("b", "2026-01-01", 2)], "app_id string, dt string, x int")
    lake.write_silver(silver, base)
    lake.write_silver(silver.filter("app_id = 'a'").withColumn("x", F.lit(9)), base)
    assert {r["app_id"]: r["x"] for r in spark.read.parquet(f"{base}/reviews").collect()} == {"a": 9, "b": 2}


def test_pending_limits(spark):
    hub = frame(spark, "review_master_index", [dict(review_id=f"r{k}", processing_status="CLEANED") for k in range(4)])
    done = spark.createDataFrame([("r0",)], "review_id string")
    assert [joins.pending(hub, done, limit=n).count() for n in (None, 0, 2)] == [3, 0, 2]


def test_available_now_stream(spark, tmp_path):
    base = f"file://{tmp_path}/bronze"
    spark.createDataFrame([review(1, "a"), review(2, "b")], REVIEW).write.parquet(f"{base}/d1")
    seen = []
    run = lambda: incremental.run_available(incremental.without_redelivery(incremental.bronze_stream(spark, base)), f"file://{tmp_path}/ck", lambda df, _: seen.extend(r["review_id"] for r in df.collect()))
    run()
    spark.createDataFrame([review(2, "b"), review(3, "c")], REVIEW).write.parquet(f"{base}/d2")
    run()
    assert sorted(seen) == ["r1", "r2", "r3"]


# ---- the catalog whenever its writer dies --------------------------------------------------------------------------
class Died(Exception):
    pass


def dies(*_):
    raise Died


APPS = [dict(app_id=f"a{k}", name="old") for k in range(3)]


@pytest.mark.parametrize("step", ["_write", "_publish", "_point", "_tidy", "half"])
def test_catalog_survives(spark, tmp_path, monkeypatch, step):
    c = lake.Catalog(spark, f"file://{tmp_path}/c")
    c.replace("apps", frame(spark, "apps", APPS))
    c.AGE = dt.timedelta(0)  # what is out of use goes at once
    fresh = frame(spark, "apps", [dict(app_id="a0", name="new")])
    with monkeypatch.context() as m:
        if step == "half":  # a pointer of which half is there
            m.setattr(lake.Catalog, "_point", lambda self, path, text: (lake.put(self.spark, path, text.encode()[:9]), dies()))
        else:
            m.setattr(lake.Catalog, step, dies)
        with pytest.raises(Died):
            c.upsert("apps", fresh)
    names = sorted(r["name"] for r in c.read("apps").collect())
    assert names == (["new", "old", "old"] if step == "_tidy" else ["old"] * 3)
    for _ in range(4):
        c.upsert("apps", fresh)
        assert sorted(r["name"] for r in c.read("apps").collect()) == ["new", "old", "old"]
    assert len(lake.partitions_named(spark, c.path("apps"), "v-.*")) <= c.KEPT
    assert c.append("apps", frame(spark, "apps", [dict(app_id="z")])) == 1 and c.read("apps").count() == 4


def test_days_leave_other_files_alone(spark, tmp_path):
    c = lake.Catalog(spark, f"file://{tmp_path}/c")
    row = lambda day, n: dict(date=dt.date(2026, 5, day), service_id="s", keyword="k", mention_cnt=n)
    name = "fact_service_aspect_daily"
    c.replace(name, frame(spark, name, [row(1, 1), row(2, 2), row(3, 3)]))
    files = lambda: {f: r["date"].day for r in c.read(name).select("date", "_metadata.file_path").collect() for f in [r["file_path"]]}
    before = files()
    c.upsert(name, frame(spark, name, [row(2, 9)]))
    after = files()
    assert {f for f, d in before.items() if d != 2} == {f for f, d in after.items() if d != 2} and not {f for f, d in before.items() if d == 2} & set(after)
    assert {r["date"].day: r["mention_cnt"] for r in c.read(name).collect()} == {1: 1, 2: 9, 3: 3}
    assert c.read(name, [dt.date(2026, 5, 2)]).count() == 1
    c.drop_days_before(name, dt.date(2026, 5, 2))
    assert set(files()) == {f for f, d in after.items() if d != 1}
    with pytest.raises(ValueError):
        c.replace_days(name, frame(spark, name, [row(3, 1)]), [dt.date(2026, 5, 2)])
    hub = [dict(review_id="a", review_created_at=NOW), dict(review_id="b")]
    c.append("review_master_index", frame(spark, "review_master_index", hub))
    assert [r["review_id"] for r in c.read("review_master_index", [None]).collect()] == ["b"]


def test_one_day_of_aggregates_touches_its_files_only(catalog, tmp_path):
    deliver(catalog, [review(k, "편리한 앱", day=k) for k in (1, 2)], tmp_path)
    steps.run_steps(catalog, ["load", "cleanse", "gold"], NOW)
    steps.aggregate_days(catalog, None, None, NOW.date())
    files = lambda: {(m, r["file_path"]) for m in steps.MARTS for r in catalog.read(m, [dt.date(2026, 5, 1)]).select("_metadata.file_path").collect()}
    before = files()
    assert steps.aggregate_days(catalog, dt.date(2026, 5, 2), dt.date(2026, 5, 2), NOW.date()) == {m: 1 if m != "fact_category_radar_scores" else 1 for m in steps.MARTS}
    assert files() == before and len(before) == 4


@pytest.mark.parametrize("table", ["apps", "app_reviews", "review_master_index", "ingestion_batch"])
def test_load_is_repeatable(catalog, tmp_path, monkeypatch, table):
    """A load that dies at any table loads each review once when it is run again."""
    deliver(catalog, [review(1, "편리한 앱"), review(2, "버그")], tmp_path)
    whole = lake.Catalog._publish

    def publish(self, name, entries):
        if name == table:
            raise KeyboardInterrupt
        whole(self, name, entries)

    with monkeypatch.context() as m:
        m.setattr(lake.Catalog, "_publish", publish)
        with pytest.raises(KeyboardInterrupt):
            steps.run_load(catalog, NOW)
    assert steps.run_load(catalog, NOW).status == "success"
    assert catalog.read("app_reviews").count() == catalog.read("review_master_index").count() == 2


# ---- outcomes -------------------------------------------------------------------------------------------------------
def test_a_failed_embedding_fails_the_review(catalog, tmp_path):
    deliver(catalog, [review(1, "편리한 앱"), review(2, "편리한 버그")], tmp_path)
    steps.run_steps(catalog, ["load", "cleanse"], NOW)
    whole = vectors.hashing_embedder()
    some = lambda c: F.when(~c.contains("버그"), whole(c))
    got = steps.run_gold(catalog, NOW, some, summarizer=lambda c: F.when(c.contains("앱"), F.concat(F.lit("s:"), c)), day=dt.date(2026, 5, 3))
    assert (got.status, got.input_count, got.output_count) == ("success", 2, 1)
    hub = {r["review_id"]: r for r in catalog.read("review_master_index").collect()}
    assert (hub["r1"]["processing_status"], hub["r2"]["processing_status"], hub["r2"]["retry_count"], hub["r2"]["error_message"]) == ("ANALYZED", "FAILED", 1, "no embedding")
    assert {r["review_id"] for r in catalog.read("review_aspects").collect()} == {"r1"}
    log = catalog.read("review_llm_analysis_logs").collect()
    assert [(r["review_id"], r["status"], json.loads(r["result_payload"])["summary"][:2]) for r in log] == [("r1", "SUCCESS", "s:")]
    # the next run takes it up again, until it has failed three times
    for k in (2, 3):
        steps.run_gold(catalog, NOW + dt.timedelta(hours=k), some)
        assert catalog.read("review_master_index").filter("review_id = 'r2'").first()["retry_count"] == k
    assert steps.run_gold(catalog, NOW, whole).input_count == 0


def test_a_summary_that_fails_is_logged(catalog, tmp_path):
    deliver(catalog, [review(1, "편리한 앱")], tmp_path)
    steps.run_steps(catalog, ["load", "cleanse"], NOW)
    assert steps.run_gold(catalog, NOW, vectors.hashing_embedder(), summarizer=lambda c: F.lit(None).cast("string")).output_count == 1
    assert [(r["status"], r["result_payload"]) for r in catalog.read("review_llm_analysis_logs").collect()] == [("FAILED", None)]


def test_a_review_that_cannot_be_cleansed_fails_alone(catalog, tmp_path):
    deliver(catalog, [review(1, "편리한 앱"), review(2, "버그")], tmp_path)
    steps.run_load(catalog, NOW)
    catalog.append("reviews_preprocessed", frame(catalog.spark, "reviews_preprocessed", [dict(review_id="other", platform_review_id="p2", refined_text="x")]))
    got = steps.run_cleanse(catalog, NOW)
    assert (got.status, got.input_count, got.output_count) == ("success", 2, 1)
    hub = {r["review_id"]: r for r in catalog.read("review_master_index").collect()}
    assert hub["r1"]["processing_status"] == "CLEANED"
    assert (hub["r2"]["processing_status"], hub["r2"]["retry_count"], hub["r2"]["error_message"]) == ("FAILED", 1, "Cleanse failed: another review has the key p2")


def test_app_batches(catalog, tmp_path):
    rows = catalog.spark.createDataFrame([review(1, "편리한 앱"), review(1, "again"), review(2, "버그")], REVIEW)
    sink = lambda df: lake.app_batch(df, f"file://{tmp_path}/bronze", catalog, "APPSTORE", APP, "n", NOW)
    folder = sink(rows)
    assert catalog.spark.read.parquet(folder).count() == 2
    b = catalog.read("ingestion_batch").first()
    assert (b["platform_app_id"], b["record_count"], b["status"], b["storage_path"]) == (APP, 2, "PENDING", folder)
    assert steps.run_load(catalog, NOW).output_count == 2
    assert sink(rows) is None and catalog.read("ingestion_batch").count() == 1

    class NoLedger:
        read = catalog.read
        append = staticmethod(dies)

    more = catalog.spark.createDataFrame([review(9, "x")], REVIEW)
    with pytest.raises(Died):
        lake.app_batch(more, f"file://{tmp_path}/other", NoLedger, "APPSTORE", APP, "n", NOW)
    assert lake.list_files(catalog.spark, f"file://{tmp_path}/other") == []


def test_objects_and_csv(spark, tmp_path):
    key = f"file://{tmp_path}/k/a.bin"
    lake.put(spark, key, b"\x00one")
    lake.put(spark, key, b"\xfftwo")
    assert lake.get(spark, key) == b"\xfftwo" and lake.delete(spark, key) and not lake.exists(spark, key)
    got = lake.store_settings("https://store:9000", "k", "s")
    assert got["spark.hadoop.fs.s3a.endpoint"] == "store:9000" and got["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert "spark.hadoop.fs.s3a.access.key" not in lake.store_settings("store:9000", "", "")
    with pytest.raises(ValueError):
        lake.store_settings("store:9000", "k", "")
    folder = f"file://{tmp_path}/csv"
    lake.write_csv(spark.createDataFrame([("é", 1)], "a string, b int").coalesce(1), folder)
    assert len(lake.list_csv(spark, folder)) == 1 and lake.back_up_csv(spark, folder, f"file://{tmp_path}/backup") == 1
    assert lake.retire_csv(spark, folder, dt.datetime(2000, 1, 1)) == 0 and lake.retire_csv(spark, folder, dt.datetime.now() + dt.timedelta(days=1)) == 1
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/backup").collect()[0]["a"] == "é"
    for day in ("2026_05_01", "2026_05_02"):
        (tmp_path / f"m/srv_daily_review_list_{day}").mkdir(parents=True)
    (tmp_path / "m/other").mkdir()
    from lakewright.operators.predicates import PARTITION_NAME

    assert lake.partitions_named(spark, f"file://{tmp_path}/m", PARTITION_NAME.strip("^$")) == ["srv_daily_review_list_2026_05_01", "srv_daily_review_list_2026_05_02"]
