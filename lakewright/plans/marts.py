"""The four marts (A01-A03, M10), for one day, a range or all days in one job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.operators import joins, predicates
from lakewright.schemas import CATEGORIES

Views = Mapping[str, DataFrame]
#: The view of what `joined` gives, where a pass over several marts has written it aside.
JOINED = "joined"


def analyzed(views: Views, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Analysed reviews of the days, with `date`."""
    master = views["review_master_index"]
    rows = master.filter((F.col("processing_status") == "ANALYZED") & predicates.day_range(master, "review_created_at", first, last))
    return rows.withColumn("date", F.to_date("review_created_at"))


def joined(views: Views, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Analysed reviews with their action record and their store's row: what two marts start from."""
    if JOINED in views:
        return views[JOINED]
    rows = analyzed(views, first, last).select("review_id", "platform_review_id", "service_id", "date", F.col("review_created_at").alias("reviewed_at"))
    rows = rows.join(views["review_action_analysis"].select("review_id", "is_action_required", "is_attention_required", "review_summary"), "review_id")
    return rows.join(views["app_reviews"].select("platform_review_id", "platform_type", "rating"), "platform_review_id")


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """Decimal ratio, half up; null for an empty whole."""
    return F.round(F.try_divide(part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")).cast("decimal(20,10)"), digits).cast("double")


def yes(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def fact_service_review_daily(views: Views, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """A01. Counts are of joined rows (a natural key that repeats counts again); pos/neg of distinct reviews."""
    rows = joined(views, first, last).filter("service_id is not null and platform_type is not null")
    rows = rows.join(joins.sentiment_by_review(views["review_aspects"], rows), "review_id", "left")
    mood = F.round("sentiment_score", 6)
    # first per review, then per mart key: distinct counts become plain sums
    reviews = rows.groupBy("date", "service_id", "platform_type", "review_id").agg(
        F.count("*").alias("n"),
        F.count_if(yes("is_action_required")).alias("action"),
        F.count_if(yes("is_attention_required")).alias("attention"),
        F.sum("rating").alias("stars"),
        F.count("rating").alias("rated"),
        F.max(F.when(mood >= 0.5, 1).otherwise(0)).alias("pos"),
        F.max(F.when(mood < 0.5, 1).otherwise(0)).alias("neg"),
    )
    out = reviews.groupBy("date", "service_id", "platform_type").agg(
        F.sum("n").alias("total_review_cnt"),
        F.sum("action").alias("action_required_cnt"),
        F.sum("attention").alias("attention_required_cnt"),
        F.sum("pos").alias("pos_count"),
        F.sum("neg").alias("neg_count"),
        F.try_divide(F.sum("stars").cast("double"), F.sum("rated")).alias("avg_rating"),
    )
    return out.withColumn("action_ratio", ratio(F.col("action_required_cnt"), F.col("total_review_cnt")))


def fact_service_aspect_daily(views: Views, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """A02."""
    rows = analyzed(views, first, last).filter("service_id is not null").select("review_id", "service_id", "date")
    rows = rows.join(views["review_aspects"].filter("keyword is not null").select("review_id", "keyword", "sentiment_score"), "review_id")
    return rows.groupBy("date", "service_id", "keyword").agg(F.count("*").alias("mention_cnt"), F.avg("sentiment_score").alias("avg_sentiment_score"))


def fact_category_radar_scores(views: Views, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Only categories of the domain; reviews counted once."""
    rows = analyzed(views, first, last).filter("service_id is not null").select("review_id", "service_id", "date")
    aspects = views["review_aspects"].filter(F.col("category").isin(*CATEGORIES)).select("review_id", F.col("category").alias("category_type"), "sentiment_score")
    each = rows.join(aspects, "review_id").groupBy("date", "service_id", "category_type", "review_id")
    each = each.agg(F.sum("sentiment_score").alias("s"), F.count("sentiment_score").alias("n"))
    return each.groupBy("date", "service_id", "category_type").agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias("avg_sentiment_score"), F.count("*").alias("review_cnt")
    )


def srv_daily_review_list(views: Views, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The wide serving row; reviews without a service stay in."""
    rows = joined(views, first, last)
    rows = rows.join(views["reviews_preprocessed"].select("review_id", "refined_text"), "review_id", "left")
    # one pass over the day's aspects gives both sentiment and keywords
    aspects = views["review_aspects"].join(rows.select("review_id"), "review_id", "left_semi").groupBy("review_id").agg(
        F.avg("sentiment_score").alias("sentiment_score"), F.array_sort(F.collect_set("keyword")).alias("keyword")
    )
    rows = rows.join(aspects, "review_id", "left")
    assigned = views["reviews_assigned"].join(rows.select("review_id"), "review_id", "left_semi")
    rows = rows.join(joins.latest_assignment(assigned).select("review_id", "assigned_dept", "confidence"), "review_id", "left")
    return rows.select(
        "review_id", "date", "service_id", "refined_text", "review_summary", "rating", "reviewed_at", "sentiment_score", "is_action_required",
        "is_attention_required", "assigned_dept", F.coalesce("keyword", F.array().cast("array<string>")).alias("keyword"), "confidence",
    )


BUILDERS = {
    "fact_service_review_daily": fact_service_review_daily,
    "fact_service_aspect_daily": fact_service_aspect_daily,
    "fact_category_radar_scores": fact_category_radar_scores,
    "srv_daily_review_list": srv_daily_review_list,
}


def analyzed_dates(views: Views, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """A12."""
    return analyzed(views, first, last).select("date").distinct().orderBy("date")


def affected_days(new_reviews: DataFrame) -> DataFrame:
    """ST04: the days to compute again when late reviews arrive."""
    return new_reviews.filter("review_created_at is not null").select(F.to_date("review_created_at").alias("date")).distinct()


def keep_days(mart: DataFrame, as_of: dt.date, retention_days: int = 14) -> DataFrame:
    """ST05: rows not older than the retention, counted from as_of."""
    return mart.filter(F.col("date") >= F.lit(as_of - dt.timedelta(days=retention_days)))
