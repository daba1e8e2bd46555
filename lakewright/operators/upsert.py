"""Keyed upserts on Parquet frames (M01-M04): anti-join and union, since there is no MERGE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of the serving list that a conflict leaves as they are.
SERVING_KEPT = ("service_id", "refined_text", "rating", "reviewed_at")


def upsert(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """New rows replace old ones of their key, all other old rows stay."""
    return old.join(new.select(*keys), list(keys), "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def replace_days(old: DataFrame, new: DataFrame, day: str = "date") -> DataFrame:
    """The other mode of M03: whole days of new replace those of old."""
    return old.join(new.select(day).distinct(), day, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def partial_upsert(old: DataFrame, new: DataFrame, keys: tuple[str, ...], kept: tuple[str, ...] = SERVING_KEPT) -> DataFrame:
    """Where a row of the key is there, its `kept` columns stay, null or not; all others come from new."""
    o, n = old.withColumn("__o", F.lit(True)).alias("o"), new.withColumn("__n", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    both = o.join(n, on, "full_outer")
    out = []
    for c in old.columns:
        if c in keys:
            value = F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))
        elif c in kept:
            value = F.when(F.col("__o"), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        else:
            value = F.when(F.col("__n"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        out.append(value.alias(c))
    return both.select(*out)


def upsert_preprocessed(old: DataFrame, new: DataFrame, now) -> DataFrame:
    """On platform_review_id; the stored review_id and created_at stay, text and updated_at follow new."""
    n = new.groupBy("platform_review_id").agg(F.max_by(F.struct("review_id", "refined_text"), "review_id").alias("n")).select("platform_review_id", "n.*").alias("n")
    both = old.alias("o").join(n, "platform_review_id", "full_outer")
    there, fresh = F.col("n.review_id").isNotNull(), F.lit(now).cast("timestamp")
    return both.select(
        F.coalesce("o.review_id", "n.review_id").alias("review_id"),
        "platform_review_id",
        F.when(there, F.col("n.refined_text")).otherwise(F.col("o.refined_text")).alias("refined_text"),
        F.coalesce("o.created_at", fresh).alias("created_at"),
        F.when(there, fresh).otherwise(F.col("o.updated_at")).alias("updated_at"),
    )
