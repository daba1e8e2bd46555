"""Joins beyond the built-in forms (J03-J18, W01-W03): latest per key, pending, dedup, temporal, as-of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.operators.predicates import retryable


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def latest_assignment(assigned: DataFrame) -> DataFrame:
    """One row per review, the newest (of equals the largest id). An aggregate with partial sums, not a sort."""
    rest = [c for c in assigned.columns if c != "review_id"]
    # null times come first in a descending order of the data model, so they win
    rank = F.struct(F.col("created_at").isNull(), "created_at", "assigned_id")
    return assigned.groupBy("review_id").agg(F.max_by(F.struct(*rest), rank).alias("r")).select("review_id", "r.*")


def sentiment_by_review(aspects: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Mean sentiment of each review; with `reviews`, only theirs (the semi-join goes below the aggregate)."""
    if reviews is not None:
        aspects = aspects.join(reviews.select("review_id"), "review_id", "left_semi")
    return aspects.groupBy("review_id").agg(F.avg("sentiment_score").alias("sentiment_score"))


def keywords_by_review(aspects: DataFrame) -> DataFrame:
    """The distinct keywords of each review, sorted."""
    return aspects.groupBy("review_id").agg(F.array_sort(F.collect_set("keyword")).alias("keyword"))


def pending(master: DataFrame, done: DataFrame, states: tuple[str, ...] = ("CLEANED",), limit: int | None = None) -> DataFrame:
    """Reviews in one of the states without a row in `done`; limit 0 means none, None all."""
    out = master.filter(F.col("processing_status").isin(*states)).join(done.select("review_id"), "review_id", "left_anti")
    return out if limit is None else out.orderBy("review_id").limit(limit)


def pending_gold(master: DataFrame, most: int = 3) -> DataFrame:
    """ST01: what the analysis picks up, by state and not by offset."""
    return master.filter(retryable(F.col("processing_status"), F.col("retry_count"), "CLEANED", most))


def new_reviews(rows: DataFrame, existing: DataFrame, arrival: list[Column]) -> DataFrame:
    """Rows whose (app_id, platform_type, platform_review_id) is unknown; the first of a batch wins."""
    keys = ["app_id", "platform_type", "platform_review_id"]
    fresh = rows.join(existing.select(*keys).distinct(), keys, "left_anti")
    return first_per_key(fresh, keys, arrival)


def with_metadata(reviews: DataFrame, metadata: DataFrame, at: Column) -> DataFrame:
    """SCD2 left join on app and service, active, valid_from/valid_to inclusive and open-ended."""
    m = metadata.alias("m")
    r = reviews.alias("r")
    on = (
        (F.col("m.app_id") == F.col("r.app_id"))
        & (F.col("m.service_id") == F.col("r.service_id"))
        & F.coalesce(F.col("m.is_active"), F.lit(False))
        & (F.col("m.valid_from").isNull() | (F.col("m.valid_from") <= at))
        & (F.col("m.valid_to").isNull() | (F.col("m.valid_to") >= at))
    )
    return r.join(m, on, "left").select("r.*", F.col("m.id").alias("metadata_id"))


def current_service(metadata: DataFrame) -> DataFrame:
    """(app_id, service_id) of the latest active row; an unknown start counts as latest."""
    rank = F.struct(F.col("valid_from").isNull(), "valid_from", "id")
    return metadata.filter("is_active").groupBy("app_id").agg(F.max_by("service_id", rank).alias("service_id"))


def missing_apps(records: DataFrame, apps: DataFrame) -> DataFrame:
    """App ids without a row in apps, sorted when collected."""
    return records.select("app_id").distinct().join(apps.select("app_id"), "app_id", "left_anti")


def key_conflicts(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Natural keys whose stored review_id is another."""
    a, b = incoming.alias("a"), stored.alias("b")
    return a.join(b, F.col("a.platform_review_id") == F.col("b.platform_review_id")).filter(F.col("a.review_id") != F.col("b.review_id")).select("a.platform_review_id")
