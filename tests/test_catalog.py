"""Hub, parts and pointers of the catalog: what is read and written, and several writers at once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakewright.operators import load
from lakewright.plans import steps
from lakewright.schemas import HUB, NATURAL, TABLES
from lakewright.sources import catalog as catalogs
from lakewright.sources import lake
from tests.test_pipeline import APP, NOW, REVIEW, frame, review


@pytest.fixture
def catalog(spark, tmp_path):
    c = lake.Catalog(spark, f"file://{tmp_path}/catalog", parts=4, buckets=4)
    c.append("apps", frame(spark, "apps", [dict(app_id=APP, platform_app_id="x", platform_type="APPSTORE", name="n")]))
    c.append("app_metadata", frame(spark, "app_metadata", [dict(id=1, app_id=APP, service_id="s", valid_from=dt.date(2025, 1, 1), is_active=True)]))
    return c


def hub_row(k, status="RAW", day=3, **more):
    return dict(review_id=f"r{k}", app_id=APP, platform_type="APPSTORE", platform_review_id=f"p{k}", review_created_at=dt.datetime(2026, 5, day, 9), processing_status=status, retry_count=0, **more)


def ledger_row(catalog, k, folder, app="daily_batch"):
    return dict(batch_id=f"b{k:03d}", source_type="APPSTORE", platform_app_id=app, storage_path=folder, status="PENDING", retry_count=0, max_retries=3, created_at=NOW + dt.timedelta(seconds=k))


def deliver(catalog, tmp_path, batches, app="daily_batch"):
    """batch number -> rows, written as one folder each."""
    rows = []
    for k, own in batches.items():
        folder = f"file://{tmp_path}/bronze/batch {k}"  # a space: paths come encoded from some readers
        catalog.spark.createDataFrame(own, REVIEW).coalesce(1).write.parquet(folder)
        rows.append(ledger_row(catalog, k, folder, app))
    catalog.append("ingestion_batch", frame(catalog.spark, "ingestion_batch", rows))


# ---- natural keys ----------------------------------------------------------------------------------------------------
def test_the_hub_is_not_shuffled_for_new_reviews(spark, catalog, monkeypatch):
    catalog.append(HUB, frame(spark, HUB, [hub_row(k) for k in range(40)]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known, buckets = catalog.known_keys()
        assert known.count() == 40
        records = spark.createDataFrame([review(k, "x") for k in range(30, 50)], REVIEW).withColumn("place", F.lit(0))
        fresh = records.repartition(buckets, *NATURAL).join(known, list(NATURAL), "left_anti")
        plan = fresh._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert "SelectedBucketsCount: 4 out of 4" in plan and plan.count("Exchange") == 1 and "Exchange" not in plan.split("ExistingRDD")[1], plan
        placed = load.place_records(records, known, buckets, catalog.read("app_metadata"))
        assert sorted(r[0] for r in placed.select("review_id").collect()) == [f"r{k}" for k in range(40, 50)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keys_follow_the_hub(spark, catalog, monkeypatch):
    monkeypatch.setattr(lake.Catalog, "MOST", 3)
    ids = lambda: sorted(int(r[0][1:]) for r in catalog.known_keys()[0].select("platform_review_id").collect())
    assert ids() == []
    for k in range(9):
        catalog.append(HUB, frame(spark, HUB, [hub_row(k)]))
    assert ids() == list(range(9)) and len(catalog.state(HUB)["keys"]["loads"]) <= 3
    # new states leave the keys; other rows do not
    days = [dt.date(2026, 5, 3)]
    catalog.replace_open(catalog.read(HUB, days, open=True).withColumn("processing_status", F.lit("ANALYZED")), days)
    assert catalog.state(HUB)["keys"] and ids() == list(range(9))
    catalog.replace(HUB, frame(spark, HUB, [hub_row(77)]))
    assert catalog.state(HUB)["keys"] is None and ids() == [77]
    # another session of the same catalog finds them
    assert sorted(r[0] for r in lake.Catalog(spark, catalog.base).known_keys()[0].select("platform_review_id").collect()) == ["p77"]


def test_many_batches_read_the_keys_once_and_fail_alone(spark, catalog, tmp_path, monkeypatch):
    catalog.append(HUB, frame(spark, HUB, [hub_row(0)]))
    rows = {k: [review(2 * k, "good"), review(2 * k + 1, "good"), review(1, "again")] for k in range(12)}
    rows[5].append(review(900, "bad", 6))
    other = "0190163d-8694-739b-aea5-000000000000"
    rows[7].append(review(901, "x", app=other))
    deliver(catalog, tmp_path, rows)
    calls = []
    whole = lake.Catalog.known_keys
    monkeypatch.setattr(lake.Catalog, "known_keys", lambda self: calls.append(1) or whole(self))
    got = steps.run_load(catalog, NOW)
    assert (got.status, got.input_count, got.output_count, len(calls)) == ("success", 12, 19, 1)
    assert "invalid record: rating" in got.message and other in got.message
    state = {r["batch_id"]: r["status"] for r in catalog.read("ingestion_batch").collect()}
    assert state == {f"b{k:03d}": "FAILED" if k in (5, 7) else "LOADED" for k in range(12)}
    assert catalog.read(HUB).count() == 20 and catalog.read("app_reviews").count() == 19
    assert catalog.read(HUB).filter("service_id = 's'").count() == 19


def test_a_file_that_cannot_be_read_fails_its_batch(spark, catalog, tmp_path):
    deliver(catalog, tmp_path, {k: [review(k, "good")] for k in range(5)})
    catalog.append("ingestion_batch", frame(spark, "ingestion_batch", [ledger_row(catalog, 8, f"file://{tmp_path}/nothing")]))
    broken = next((tmp_path / "bronze/batch 3").glob("*.parquet"))
    broken.write_bytes(b"PAR1 no parquet at all PAR1")
    (broken.parent / f".{broken.name}.crc").unlink()
    got = steps.run_load(catalog, NOW)
    assert (got.status, got.output_count) == ("success", 4)
    assert {r["batch_id"] for r in catalog.read("ingestion_batch").filter("status = 'FAILED'").collect()} == {"b003", "b008"}
    assert sorted(r["review_id"] for r in catalog.read("app_reviews").collect()) == ["r0", "r1", "r2", "r4"]


def test_apps_of_earlier_batches_count(spark, catalog, tmp_path):
    other = "0190163d-8694-739b-aea5-000000000000"
    deliver(catalog, tmp_path, {2: [review(2, "x", app=other)]}, app="x")
    deliver(catalog, tmp_path, {1: [review(1, "x", app=other)], 3: [review(3, "x", app=other)]})
    assert steps.run_load(catalog, NOW).output_count == 2
    assert {r["batch_id"]: r["status"] for r in catalog.read("ingestion_batch").collect()} == {"b001": "FAILED", "b002": "LOADED", "b003": "LOADED"}
    assert catalog.read("apps").filter(F.col("app_id") == other).count() == 1


# ---- open folders and parts --------------------------------------------------------------------------------------------
def test_steps_read_open_folders_only(spark, catalog, tmp_path, monkeypatch):
    catalog.append(HUB, frame(spark, HUB, [hub_row(k, "ANALYZED", 1 + k % 3) for k in range(100, 130)]))
    deliver(catalog, tmp_path, {1: [review(k, "편리한 앱", day=1 + k % 3) for k in range(6)]})
    steps.run_load(catalog, NOW)
    closed = {e["folder"] for e in catalog.state(HUB)["entries"] if e["open"] == "0"}
    seen, whole = [], lake.Catalog._frame
    monkeypatch.setattr(lake.Catalog, "_frame", lambda self, name, entries: seen.extend((name, e.get("open"), e.get("part")) for e in entries) or whole(self, name, entries))
    assert steps.run_cleanse(catalog, NOW).output_count == 6
    assert steps.run_gold(catalog, NOW).output_count == 6
    assert {x[1] for x in seen if x[0] == HUB} == {"1"}
    after = catalog.state(HUB)["entries"]
    assert closed < {e["folder"] for e in after} and not [e for e in after if e["open"] == "1"]
    assert catalog.read(HUB, open=False).count() == 36 and catalog.read(HUB, open=True).count() == 0


def test_a_small_cleanse_rewrites_few_parts(spark, tmp_path):
    c = lake.Catalog(spark, f"file://{tmp_path}/c", parts=40)
    old = [dict(review_id=f"r{k}", platform_review_id=f"p{k}", refined_text="old") for k in range(1000, 1300)]
    c.append("reviews_preprocessed", frame(spark, "reviews_preprocessed", old))
    c.append("app_reviews", frame(spark, "app_reviews", [dict(review_id=f"r{k}", platform_review_id=f"p{k}", review_text="text") for k in range(10)]))
    c.append(HUB, frame(spark, HUB, [hub_row(k) for k in range(10)]))
    before = {e["folder"] for e in c.state("reviews_preprocessed")["entries"]}
    assert len(before) == 40
    assert steps.run_cleanse(c, NOW).output_count == 10
    after = {e["folder"] for e in c.state("reviews_preprocessed")["entries"]}
    assert 1 <= len(after - before) <= 10 and len(before - after) <= 10
    assert c.read("reviews_preprocessed").count() == 310


def test_appends_leave_a_bounded_number_of_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake.Catalog, "MOST", 3)
    c = lake.Catalog(spark, f"file://{tmp_path}/c", parts=2)
    for k in range(14):
        c.append("review_aspects", frame(spark, "review_aspects", [dict(aspect_id=k, review_id=f"r{k}")]))
        c.append("ingestion_batch", frame(spark, "ingestion_batch", [dict(batch_id=f"b{k}")]))
    assert len(c.state("review_aspects")["entries"]) <= 6 and len(c.state("ingestion_batch")["entries"]) <= 3
    assert c.read("review_aspects").count() == c.read("ingestion_batch").count() == 14


# ---- two writers, old readers --------------------------------------------------------------------------------------------
@pytest.mark.parametrize("step", ["_write", "_point"])
@pytest.mark.parametrize("change", ["append", "upsert"])
def test_both_writers_land(spark, tmp_path, monkeypatch, step, change):
    """Another writer appends while this one has written its folder, or is about to publish."""
    a, b = (lake.Catalog(spark, f"file://{tmp_path}/c") for _ in range(2))
    a.append("apps", frame(spark, "apps", [dict(app_id="x", name="old"), dict(app_id="y", name="old")]))
    whole, done = getattr(lake.Catalog, step), []

    def slow(self, *args):
        out = whole(self, *args) if step == "_write" else None
        if self is a and not done:
            done.append(1)
            b.append("apps", frame(spark, "apps", [dict(app_id="z", name="b")]))
        return out if step == "_write" else whole(self, *args)

    with monkeypatch.context() as m:
        m.setattr(lake.Catalog, step, slow)
        getattr(a, change)("apps", frame(spark, "apps", [dict(app_id="x", name="new")]))
    got = sorted((r["app_id"], r["name"]) for r in b.read("apps").collect())
    assert got == ([("x", "new"), ("x", "old"), ("y", "old"), ("z", "b")] if change == "append" else [("x", "new"), ("y", "old"), ("z", "b")])


def test_rows_changed_by_another_writer_are_not_lost(spark, tmp_path):
    a, b = (lake.Catalog(spark, f"file://{tmp_path}/c") for _ in range(2))
    a.append("apps", frame(spark, "apps", [dict(app_id="x", name="0")]))
    mine = a.read("apps").withColumn("name", F.lit("a"))
    b.upsert("apps", frame(spark, "apps", [dict(app_id="x", name="b")]))
    with pytest.raises(catalogs.Conflict):
        a.replace("apps", mine)
    assert [r["name"] for r in a.read("apps").collect()] == ["b"]
    a.read("apps")
    b.append("apps", frame(spark, "apps", [dict(app_id="y", name="b")]))
    with pytest.raises(catalogs.Conflict):
        a.append("apps", frame(spark, "apps", [dict(app_id="y", name="a")]), unless_changed=True)


def test_two_loads_of_the_same_batch(spark, catalog, tmp_path, monkeypatch):
    """The second load publishes in the middle of the first: each review is there once."""
    deliver(catalog, tmp_path, {1: [review(k, "good") for k in range(4)]})
    other, whole, done = lake.Catalog(spark, catalog.base), lake.Catalog.append, []

    def append(self, name, df, **more):
        if self is catalog and name == HUB and not done:
            done.append(1)
            assert steps.run_load(other, NOW).output_count == 4
        return whole(self, name, df, **more)

    monkeypatch.setattr(lake.Catalog, "append", append)
    assert steps.run_load(catalog, NOW).output_count == 0
    assert catalog.read(HUB).count() == catalog.read("app_reviews").count() == 4


def test_a_frame_outlives_later_changes(spark, tmp_path):
    c = lake.Catalog(spark, f"file://{tmp_path}/c")
    c.append("apps", frame(spark, "apps", [dict(app_id="x", name="0")]))
    old = c.read("apps")
    for k in range(1, 5):
        c.upsert("apps", frame(spark, "apps", [dict(app_id="x", name=str(k))]))
    assert [r["name"] for r in old.collect()] == ["0"] and [r["name"] for r in c.read("apps").collect()] == ["4"]
    c.AGE = dt.timedelta(0)
    c.append("apps", frame(spark, "apps", [dict(app_id="y", name="5")]))
    assert len(lake.partitions_named(spark, c.path("apps"), "v-.*")) == 2


def test_random_changes_of_two_writers(spark, tmp_path):
    """Appends and upserts in any order of two catalogs leave what one table would have."""
    rng, want = random.Random(2), {}
    both = [lake.Catalog(spark, f"file://{tmp_path}/c", parts=3) for _ in range(2)]
    for step in range(12):
        key, c = f"p{rng.randrange(6)}", rng.choice(both)
        want[key] = str(step)
        c.upsert("reviews_preprocessed", frame(spark, "reviews_preprocessed", [dict(review_id="r" + key, platform_review_id=key, refined_text=str(step))]))
        if rng.random() < 0.3:
            both[0].read("reviews_preprocessed")
    got = {r["platform_review_id"]: r["refined_text"] for r in both[1].read("reviews_preprocessed").collect()}
    assert got == want


def test_tables_of_the_model_have_slots(spark):
    assert set(TABLES) >= {HUB, *catalogs.HASHED, *catalogs.DAYS}
