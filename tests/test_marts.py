import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakewright.operators import upsert
from lakewright.plans import checks, marts, serving
from lakewright.schemas import KEYS, MARTS, POSTINGS, TABLES
from lakewright.sources.catalog import Catalog

DAY = dt.date(2026, 5, 3)


def frame(spark, table, rows):
    names = [f.split()[0] for f in TABLES[table].split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TABLES[table])


@pytest.fixture
def golden(spark):
    """Three reviews of one service on one day."""
    at = lambda h: dt.datetime(2026, 5, 3, h)
    ids = ["r0", "r1", "r2"]
    v = {
        "review_master_index": [dict(review_id=r, app_id="a", service_id="s", platform_review_id=f"p{r}", platform_type="APPSTORE", review_created_at=at(9 + k), processing_status="ANALYZED", retry_count=0) for k, r in enumerate(ids)],
        "app_reviews": [dict(review_id=r, app_id="a", platform_type="APPSTORE", platform_review_id=f"p{r}", review_text="t", rating=x) for r, x in zip(ids, (1, 5, 4), strict=True)],
        "review_action_analysis": [dict(review_id=r, is_action_required=x, is_attention_required=x, review_summary=f"summary {r}") for r, x in zip(ids, (True, False, True), strict=True)],
        "review_aspects": [dict(aspect_id=k, review_id=r, keyword=w, sentiment_score=s, category=c) for k, (r, w, s, c) in enumerate((("r0", "login", 0.2, "USABILITY"), ("r1", "transfer", 0.9, "SPEED"), ("r2", "login", 0.6, "USABILITY"), ("r2", "design", 0.8, "DESIGN")))],
        "reviews_preprocessed": [dict(review_id=r, platform_review_id=f"p{r}", refined_text="t") for r in ids],
        "reviews_assigned": [dict(assigned_id=k, review_id=r, assigned_dept=d, confidence=c, created_at=at(12)) for k, (r, d, c) in enumerate((("r0", ["CX", "APP"], 0.93), ("r1", ["APP"], 0.88), ("r2", ["CX", "DESIGN"], 0.81)))],
        "app_metadata": [dict(id=1, app_id="a", service_id="s", valid_from=dt.date(2025, 1, 1), is_active=True)],
        "ingestion_batch": [dict(batch_id="b", source_type="APPSTORE", storage_path="p", record_count=3, status="LOADED", retry_count=0, max_retries=3, created_at=at(1), updated_at=at(1))],
    }
    views = {k: frame(spark, k, rows) for k, rows in v.items()}
    return views | {m: f(views, DAY, DAY) for m, f in marts.BUILDERS.items()}


def test_golden_numbers(golden):
    s = golden[MARTS[0]].first()
    assert (s["total_review_cnt"], s["action_required_cnt"], s["attention_required_cnt"], s["pos_count"], s["neg_count"]) == (3, 2, 2, 2, 1)
    assert round(s["avg_rating"], 4) == 3.3333 and s["action_ratio"] == 0.6667
    assert {r[0]: r[1] for r in checks.mart_rows(golden, DAY).collect()} == dict(zip(MARTS, (1, 3, 3, 3), strict=True))
    top = serving.aspect_trend(golden[MARTS[1]], "s", DAY, DAY, 1).first()
    assert (top["keyword"], top["mention_cnt"], round(top["avg_sentiment_score"], 6)) == ("login", 2, 0.4)
    radar = [(r["category_type"], round(r["avg_sentiment_score"], 6), r["review_cnt"]) for r in serving.radar(golden[MARTS[2]], "s", DAY).collect()]
    assert radar == [("USABILITY", 0.4, 2), ("DESIGN", 0.8, 1), ("SPEED", 0.9, 1)]
    page = serving.review_page(golden[MARTS[3]], "s", DAY, DAY, 10, True).collect()
    assert [r["review_id"] for r in page] == ["r2", "r0"]
    r0 = page[1]
    assert (r0["rating"], r0["sentiment_score"], r0["assigned_dept"], r0["keyword"], r0["confidence"]) == (1, 0.2, ["CX", "APP"], ["login"], 0.93)


def test_valid_day(golden):
    report = checks.validate(golden, DAY)
    assert report.status == "success" and report.warnings == []


def test_no_data(golden):
    empty = {k: df.limit(0) for k, df in golden.items()}
    report = checks.validate(empty, DAY)
    assert report.status == "success" and report.warnings == ["fresh_ingestion"]


@pytest.mark.parametrize(
    ("change", "name"),
    [
        ({"ingestion_batch": lambda d: d.withColumn("status", F.lit("PENDING"))}, "batch_state"),
        ({"review_master_index": lambda d: d.withColumns({"processing_status": F.lit("FAILED"), "retry_count": F.lit(3)})}, "review_state"),
        ({"app_metadata": lambda d: d.limit(0)}, "metadata_mapping"),
        ({"review_aspects": lambda d: d.limit(0)}, "orphan_integrity"),
        ({MARTS[2]: lambda d: d.limit(0)}, "mart_freshness"),
        ({MARTS[0]: lambda d: d.withColumn("total_review_cnt", F.lit(99))}, "mart_count_consistency"),
        ({MARTS[0]: lambda d: d.withColumn("avg_rating", F.lit(9.0))}, "mart_quality"),
    ],
)
def test_each_check_fails_alone(golden, change, name):
    report = checks.validate(golden | {k: f(golden[k]) for k, f in change.items()}, DAY)
    assert report.status == "failed"
    assert name in [c.name for c in report.checks if not c.passed]


def test_half_counts_as_positive_and_fan_out(spark, golden):
    aspects = frame(spark, "review_aspects", [dict(aspect_id=1, review_id="r0", keyword="login", sentiment_score=0.25), dict(aspect_id=2, review_id="r0", keyword="speed", sentiment_score=0.75)])
    twice = golden["app_reviews"].union(golden["app_reviews"].filter("review_id = 'r0'"))
    s = marts.fact_service_review_daily(golden | {"review_aspects": aspects, "app_reviews": twice}, DAY, DAY).first()
    assert (s["total_review_cnt"], s["pos_count"], s["neg_count"]) == (4, 1, 0)


def test_partial_upsert_keeps_old_columns(golden):
    new = golden[MARTS[3]]
    old = new.filter("review_id = 'r0'").withColumns({"rating": F.lit(3), "service_id": F.lit(None).cast("string"), "confidence": F.lit(0.1)})
    rows = {r["review_id"]: r for r in upsert.partial_upsert(old, new, KEYS[MARTS[3]]).collect()}
    assert len(rows) == 3
    assert (rows["r0"]["rating"], rows["r0"]["service_id"], rows["r0"]["confidence"]) == (3, None, 0.93)


def test_late_evening_belongs_to_its_utc_day(spark, golden):
    late = golden["review_master_index"].withColumn("review_created_at", F.lit("2026-05-03 23:30:00").cast("timestamp"))
    assert marts.fact_service_review_daily(golden | {"review_master_index": late}, DAY, DAY).first()["total_review_cnt"] == 3


def test_day_filter_reaches_the_scan(spark, golden, tmp_path, capsys):
    golden["review_master_index"].write.parquet(str(tmp_path / "m"))
    marts.analyzed({"review_master_index": spark.read.parquet(str(tmp_path / "m"))}, DAY, DAY).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(review_created_at" in plan and "LessThan(review_created_at" in plan


def test_a_keyword_page_reads_its_own_folders(spark, tmp_path, monkeypatch):
    """The same rows as a scan of the list; only the keyword's part of the postings and the page's days are read; later changes follow."""
    catalog = Catalog(spark, f"file://{tmp_path}/catalog")
    day = lambda k: dt.date(2026, 5, 1 + k)
    words = [f"k{k}" for k in range(40)]
    at = lambda k: None if k % 17 == 0 else dt.datetime(2026, 5, 1 + k % 6, k % 5)
    own = lambda k: None if k % 23 == 0 else [w for j, w in enumerate(words) if k % (j + 2) == 0] + ([None, "k0"] if k % 4 == 0 else [])
    rows = [dict(review_id=f"r{k:03d}", date=day(k % 6), service_id="s" if k % 3 else None, reviewed_at=at(k), rating=k % 5 + 1, keyword=own(k)) for k in range(300)]
    listed = frame(spark, MARTS[3], rows)
    catalog.replace(MARTS[3], listed)
    catalog.replace(POSTINGS, serving.postings(listed))
    read, real = [], Catalog._frame
    monkeypatch.setattr(Catalog, "_frame", lambda self, name, entries: (read.append((name, {e["day"] for e in entries}, {e.get("part") for e in entries})), real(self, name, entries))[1])
    for keyword, service, first, last, limit in [("k0", "s", 0, 5, 7), ("k0", None, 1, 3, 500), ("k9", "s", 2, 2, 3), ("k38", None, 0, 5, 2), ("none", "s", 0, 5, 5), ("k1", "s", 9, 12, 5)]:
        read.clear()
        got = serving.posted_page(catalog, service, day(first), day(last), keyword, limit).collect()
        assert got == serving.keyword_page(listed, service, day(first), day(last), keyword, limit).collect(), keyword
        (name, days, parts), (_, listed_days, _) = read
        assert name == POSTINGS and len(parts) <= 1 and days <= {str(day(k)) for k in range(first, last + 1)}
        assert listed_days == {str(r["date"]) for r in got}
    # a day whose list changes: its postings alone are written again
    before = {e["folder"] for e in catalog.state(POSTINGS)["entries"] if e["day"] != str(day(2))}
    catalog.replace_days(POSTINGS, serving.postings(listed.filter(F.col("date") == day(2)).withColumn("keyword", F.array(F.lit("k9")))), [day(2)])
    assert {e["folder"] for e in catalog.state(POSTINGS)["entries"] if e["day"] != str(day(2))} == before
    assert catalog.read(POSTINGS, [day(2)]).filter("keyword <> 'k9'").count() == 0
