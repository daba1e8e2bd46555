"""Read shapes of the serving contract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.operators import predicates as p
from lakewright.schemas import POSTINGS, ordinal
from lakewright.sources.catalog import Catalog

LIMIT = 100


def _scope(df: DataFrame, service: str | None, first: dt.date, last: dt.date) -> DataFrame:
    return df.filter(p.optional_equal(F.col("service_id"), service) & F.col("date").between(F.lit(first), F.lit(last)))


def dashboard(summary: DataFrame, service: str | None, first: dt.date, last: dt.date, platform: str | None = None) -> DataFrame:
    """K01."""
    counts = ("total_review_cnt", "action_required_cnt", "attention_required_cnt", "pos_count", "neg_count")
    rows = _scope(summary, service, first, last).filter(p.optional_equal(F.col("platform_type"), platform))
    return rows.select(
        "date", "platform_type", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], "avg_rating", "action_ratio"
    ).orderBy("date", "platform_type")


def aspect_trend(aspects: DataFrame, service: str, first: dt.date, last: dt.date, limit: int) -> DataFrame:
    """Sorted by the coalesced count."""
    rows = _scope(aspects, service, first, last).select("date", "keyword", F.coalesce("mention_cnt", F.lit(0)).cast("long").alias("mention_cnt"), "avg_sentiment_score")
    return rows.orderBy("date", F.desc("mention_cnt"), "keyword").limit(limit)


def radar(scores: DataFrame, service: str, day: dt.date, categories: list[str] | None = None) -> DataFrame:
    """In the declared order of the categories."""
    rows = scores.filter((F.col("service_id") == service) & (F.col("date") == F.lit(day)) & p.optional_in(F.col("category_type"), categories))
    rows = rows.select("category_type", "avg_sentiment_score", F.coalesce("review_cnt", F.lit(0)).cast("long").alias("review_cnt"))
    return rows.orderBy(ordinal(F.col("category_type")))


def review_page(
    reviews: DataFrame, service: str, first: dt.date, last: dt.date, limit: int, action_only: bool | None = None, after: tuple | None = None
) -> DataFrame:
    """Keyset pages, newest first, unknown times last."""
    at, key = after or (None, None)
    rows = _scope(reviews, service, first, last).filter(p.only_if(action_only, F.col("is_action_required")))
    rows = rows.filter(p.keyset_after(F.col("reviewed_at"), F.col("review_id"), at, key))
    return rows.orderBy(F.desc_nulls_last("reviewed_at"), F.desc("review_id")).limit(limit)


def keyword_page(reviews: DataFrame, service: str, first: dt.date, last: dt.date, keyword: str, limit: int) -> DataFrame:
    """K05/F11."""
    rows = _scope(reviews, service, first, last).filter(F.array_contains("keyword", keyword))
    rows = rows.select("review_id", "date", "service_id", "reviewed_at", "rating", "refined_text", "keyword")
    return rows.orderBy(F.desc_nulls_last("reviewed_at"), F.desc("review_id")).limit(limit)


def postings(reviews: DataFrame) -> DataFrame:
    """A row for each keyword of each review of the serving list; null keywords have none."""
    rows = reviews.select(F.explode(F.array_distinct("keyword")).alias("keyword"), "service_id", "date", "reviewed_at", "review_id")
    return rows.filter("keyword is not null")


def posted_page(catalog: Catalog, service: str | None, first: dt.date, last: dt.date, keyword: str, limit: int) -> DataFrame:
    """K05/F11 over the postings: the keyword's folders of the range give the page's keys, and only the days of these are read of the
    serving list. The same rows as `keyword_page` over the whole list."""
    part = catalog.parts_of(POSTINGS, catalog.spark.createDataFrame([(keyword,)], "keyword string"))
    found = _scope(catalog.read(POSTINGS, catalog.days(POSTINGS, first, last), parts=part), service, first, last).filter(F.col("keyword") == keyword)
    newest = [F.desc_nulls_last("reviewed_at"), F.desc("review_id")]
    keys = found.orderBy(*newest).limit(limit).select("review_id", "date")
    days = [r[0] for r in keys.select("date").distinct().collect()]
    rows = catalog.read("srv_daily_review_list", days).join(keys, ["review_id", "date"], "left_semi")
    return rows.select("review_id", "date", "service_id", "reviewed_at", "rating", "refined_text", "keyword").orderBy(*newest).limit(limit)


def _limit(n: int | None) -> int:
    return n if n is not None and n > 0 else LIMIT


def review_dead_letters(master: DataFrame, limit: int | None = LIMIT) -> DataFrame:
    """Failed and out of retries, oldest first; a limit that is not positive means 100."""
    rows = master.filter((F.col("processing_status") == "FAILED") & (F.col("retry_count") >= 3))
    return rows.orderBy(F.asc_nulls_last("review_created_at"), "review_id").limit(_limit(limit))


def batch_dead_letters(batches: DataFrame, limit: int | None = LIMIT) -> DataFrame:
    """K07/O03."""
    return batches.filter("status = 'DEAD_LETTER'").orderBy(F.asc_nulls_last("updated_at"), "batch_id").limit(_limit(limit))


def status_histogram(master: DataFrame) -> DataFrame:
    """K08/A09."""
    return master.groupBy("processing_status").agg(F.count("*").alias("review_count")).orderBy("processing_status")
