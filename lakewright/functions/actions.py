"""Actionability (L01-L06): labelling functions, vote, attention mismatch, record build."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.config import lexicons


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(or_, (text.contains(w) for w in words), F.lit(False))


def fired(text: Column, rating: Column, bug: tuple[str, ...] = lexicons.BUG_WORDS, request: tuple[str, ...] = lexicons.REQUEST_WORDS) -> Column:
    """The names of the labelling functions that vote, in fixed order."""
    votes = F.array(
        F.when(contains_any(text, bug), "LF_bug_keyword"), F.when(contains_any(text, request), "LF_request_keyword"), F.when(rating <= 2, "LF_low_rating")
    )
    return F.array_compact(votes)


def vote(names: Column) -> Column:
    """struct(is_action_required, action_confidence_score, trigger_reason). Votes are yes or abstain."""
    any_fired = F.size(names) > 0
    return F.struct(
        any_fired.alias("is_action_required"),
        F.when(any_fired, 1.0).otherwise(0.5).alias("action_confidence_score"),
        F.when(any_fired, F.array_join(names, ", ")).alias("trigger_reason"),
    )


def attention(rating: Column, sentiment: Column) -> Column:
    """Rating and sentiment contradict each other."""
    return ((rating >= 4) & (sentiment < 0.4)) | ((rating <= 2) & (sentiment > 0.6))


def analyze(
    pending: DataFrame, preprocessed: DataFrame, app_reviews: DataFrame, aspects: DataFrame,
    bug: tuple[str, ...] = lexicons.BUG_WORDS, request: tuple[str, ...] = lexicons.REQUEST_WORDS, summarizer=None,
) -> DataFrame:
    """A record for each pending review (review_id, platform_review_id) with text; rating 3 and sentiment 0.5 by default.

    summarizer: optional Column -> Column; without one the summary is null.
    """
    ids = pending.select("review_id", "platform_review_id")
    sentiment = aspects.join(ids.select("review_id"), "review_id", "left_semi").groupBy("review_id").agg(F.avg("sentiment_score").alias("avg_sentiment"))
    rating = app_reviews.join(ids.select("platform_review_id"), "platform_review_id", "left_semi").groupBy("platform_review_id").agg(F.min_by("rating", "review_id").alias("rating"))
    rows = ids.join(preprocessed.select("review_id", "refined_text"), "review_id").filter(F.col("refined_text").isNotNull())
    rows = rows.join(rating, "platform_review_id", "left").join(sentiment, "review_id", "left")
    rows = rows.withColumns({"rating": F.coalesce("rating", F.lit(3)), "avg_sentiment": F.coalesce("avg_sentiment", F.lit(0.5))})
    rows = rows.withColumn("v", vote(fired(F.col("refined_text"), F.col("rating"), bug, request)))
    return rows.select(
        "review_id",
        "v.*",
        attention(F.col("rating"), F.col("avg_sentiment")).alias("is_attention_required"),
        F.lit(False).alias("is_verified"),
        (summarizer(F.substring("refined_text", 1, 500)) if summarizer else F.lit(None).cast("string")).alias("review_summary"),
    )


def summary_log(records: DataFrame, model: str, now) -> DataFrame:
    """An audit row for each summary that was asked for; a null one is a failure."""
    ok = F.col("review_summary").isNotNull()
    return records.select(
        F.xxhash64("review_id", F.lit(model), F.lit(str(now))).alias("id"),
        "review_id",
        F.lit(model).alias("model_name"),
        F.when(ok, F.to_json(F.struct(F.col("review_summary").alias("summary")))).alias("result_payload"),
        F.when(ok, "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(~ok, "no summary after all attempts").alias("error_message"),
        F.lit(now).cast("timestamp").alias("created_at"),
    )
