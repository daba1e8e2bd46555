"""Data-quality gate after an aggregation (V01-V08): eight checks over one day, and the report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.operators import joins
from lakewright.operators.predicates import on_day, outside
from lakewright.schemas import MARTS

Views = Mapping[str, DataFrame]
EXHAUSTED = 3


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    passed: bool
    metrics: dict[str, int] = field(default_factory=dict)
    message: str | None = None


@dataclass(frozen=True)
class Report:
    target_date: str
    status: str
    warnings: list[str]
    checks: list[Check]

    def as_dict(self) -> dict:
        return asdict(self)


def _batches(views: Views, day: dt.date) -> DataFrame:
    return views["ingestion_batch"].filter(on_day(views["ingestion_batch"], "created_at", day))


def _reviews(views: Views, day: dt.date) -> DataFrame:
    master = views["review_master_index"]
    return master.filter(on_day(master, "review_created_at", day))


def _analyzed(views: Views, day: dt.date) -> DataFrame:
    return _reviews(views, day).filter("processing_status = 'ANALYZED'")


def _mart(views: Views, name: str, day: dt.date) -> DataFrame:
    return views[name].filter(F.col("date") == F.lit(day))


def ingestion(views: Views, day: dt.date) -> DataFrame:
    """batch_count, record_count."""
    return _batches(views, day).agg(F.count("*").alias("batch_count"), F.coalesce(F.sum("record_count"), F.lit(0)).cast("long").alias("record_count"))


def open_batches(views: Views, day: dt.date) -> DataFrame:
    """Status, count of batches that are not loaded."""
    return _batches(views, day).filter(F.col("status").isin("PENDING", "FAILED", "RETRYING", "DEAD_LETTER")).groupBy("status").agg(F.count("*").alias("count"))


def unfinished_reviews(views: Views, day: dt.date) -> DataFrame:
    """Raw, cleaned and exhausted counts."""
    return _reviews(views, day).agg(
        F.count_if(F.col("processing_status") == "RAW").alias("RAW"),
        F.count_if(F.col("processing_status") == "CLEANED").alias("CLEANED"),
        F.count_if((F.col("processing_status") == "FAILED") & (F.coalesce("retry_count", F.lit(0)) >= EXHAUSTED)).alias("exhausted"),
    )


def unmapped(views: Views, day: dt.date) -> DataFrame:
    """Analysed rows without a service, and without an active SCD2 mapping on the review's day."""
    rows = _analyzed(views, day).withColumn("day", F.to_date("review_created_at"))
    mapped = joins.with_metadata(rows, views["app_metadata"], F.col("r.day"))
    return mapped.agg(
        F.count_if(F.col("service_id").isNull()).alias("null_service_count"),
        F.count_if(F.col("service_id").isNotNull() & F.col("metadata_id").isNull()).alias("missing_mapping_count"),
    )


def orphans(views: Views, day: dt.date) -> DataFrame:
    """Analysed reviews that lack a record downstream."""
    target = _analyzed(views, day).select("review_id", "platform_review_id")
    # only the day's ids of each table reach its distinct
    flag = lambda df, key, name: df.select(key).join(target.select(key), key, "left_semi").distinct().withColumn(name, F.lit(True))
    out = target.join(flag(views["review_action_analysis"], "review_id", "a"), "review_id", "left")
    out = out.join(flag(views["app_reviews"], "platform_review_id", "r"), "platform_review_id", "left")
    out = out.join(flag(views["reviews_preprocessed"], "review_id", "p"), "review_id", "left")
    out = out.join(flag(views["review_aspects"], "review_id", "s"), "review_id", "left")
    lack = lambda c, name: F.count_if(F.col(c).isNull()).alias(name)
    return out.agg(lack("a", "missing_action"), lack("r", "missing_review"), lack("p", "missing_preprocessed"), lack("s", "missing_aspects"))


def mart_rows(views: Views, day: dt.date | None = None) -> DataFrame:
    """Rows of every mart in one union."""
    parts = [(views[m] if day is None else _mart(views, m, day)).agg(F.count("*").alias("row_count")).select(F.lit(m).alias("table_name"), "row_count") for m in MARTS]
    return reduce(DataFrame.unionAll, parts)


def expected_reviews(views: Views, day: dt.date) -> DataFrame:
    """Joined analysed reviews, with or without an action row, against the summary's total."""
    rows = _analyzed(views, day).filter("service_id is not null").join(views["app_reviews"].filter("platform_type is not null").select("platform_review_id"), "platform_review_id")
    total = _mart(views, MARTS[0], day).agg(F.coalesce(F.sum("total_review_cnt"), F.lit(0)).cast("long").alias("fact_total"))
    return rows.agg(F.count("*").alias("expected")).join(total, F.lit(True))  # two rows of one value each


def _bad(columns: dict[str, tuple[float, float]], counts: tuple[str, ...] = ()) -> Column:
    terms = [outside(F.col(c), *x) for c, x in columns.items()] + [F.coalesce(F.col(c), F.lit(0)) < 0 for c in counts]
    return F.count_if(reduce(or_, terms))


QUALITY = {
    MARTS[0]: ({"avg_rating": (1, 5), "action_ratio": (0, 1)}, ("total_review_cnt", "action_required_cnt", "attention_required_cnt", "pos_count", "neg_count")),
    MARTS[1]: ({"avg_sentiment_score": (0, 1)}, ("mention_cnt",)),
    MARTS[2]: ({"avg_sentiment_score": (0, 1)}, ("review_cnt",)),
    MARTS[3]: ({"rating": (1, 5), "sentiment_score": (0, 1), "confidence": (0, 1)}, ()),
}


def violations(views: Views, day: dt.date) -> DataFrame:
    """Rows out of range in each mart."""
    parts = [_mart(views, m, day).agg(_bad(*QUALITY[m]).alias("violations")).select(F.lit(m).alias("table_name"), "violations") for m in MARTS]
    return reduce(DataFrame.unionAll, parts)


def validate(views: Views, day: dt.date) -> Report:
    one = lambda df: {k: int(v or 0) for k, v in df.first().asDict().items()}
    pairs = lambda df: {r[0]: int(r[1]) for r in df.collect()}
    checks = []

    def add(name: str, severity: str, passed: bool, metrics: dict[str, int], message: str) -> None:
        checks.append(Check(name, severity, passed, metrics, None if passed else message))

    m = one(ingestion(views, day))
    add("fresh_ingestion", "warning", m["record_count"] > 0, m, "no rows were ingested on the day")
    m = pairs(open_batches(views, day))
    add("batch_state", "failure", not m, m, "batches are not loaded")
    m = one(unfinished_reviews(views, day))
    add("review_state", "failure", not any(m.values()), m, "reviews are unfinished or out of retries")
    m = one(unmapped(views, day))
    add("metadata_mapping", "failure", not any(m.values()), m, "analysed reviews lack a service mapping")
    m = one(orphans(views, day))
    add("orphan_integrity", "failure", not any(m.values()), m, "analysed reviews lack downstream records")
    analyzed, m = _analyzed(views, day).count(), pairs(mart_rows(views, day))
    add("mart_freshness", "failure", analyzed == 0 or all(m.values()), {"analyzed": analyzed} | m, "a mart has no rows of the day")
    m = one(expected_reviews(views, day))
    add("mart_count_consistency", "failure", m["expected"] == m["fact_total"], m, "the summary's total differs from the analysed reviews")
    m = pairs(violations(views, day))
    add("mart_quality", "failure", not any(m.values()), m, "mart values are out of range")
    failed = any(c.severity == "failure" and not c.passed for c in checks)
    return Report(day.isoformat(), "failed" if failed else "success", [c.name for c in checks if c.severity == "warning" and not c.passed], checks)
