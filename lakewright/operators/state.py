"""State transitions (M05-M08) as projections: an outcome frame goes in, the hub's next state comes out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.operators.predicates import CLEANSE_FAILED, cleanse_failure

MESSAGE = 2000


def _where(df: DataFrame, hit, **columns) -> DataFrame:
    return df.withColumns({k: F.when(hit, v).otherwise(F.col(k)).cast(df.schema[k].dataType) for k, v in columns.items()})


def mark_cleaned(master: DataFrame, ids: DataFrame) -> DataFrame:
    """RAW or failed in cleansing before -> CLEANED, message cleared; other states stay."""
    rows = master.join(ids.select("review_id").distinct().withColumn("__hit", F.lit(True)), "review_id", "left")
    hit = F.col("__hit") & ((F.col("processing_status") == "RAW") | cleanse_failure(F.col("processing_status"), F.col("error_message")))
    return _where(rows, F.coalesce(hit, F.lit(False)), error_message=F.lit(None), processing_status=F.lit("CLEANED")).select(*master.columns)


def mark_cleanse_failed(master: DataFrame, failures: DataFrame) -> DataFrame:
    """(review_id, message) of failures; only RAW or failed in cleansing before; one more retry. Unknown reviews raise."""
    if (lost := failures.join(master, "review_id", "left_anti").select("review_id").limit(1).collect()):
        raise LookupError(f"review not in the hub: {lost[0][0]}")
    rows = master.join(failures.groupBy("review_id").agg(F.max("message").alias("__said")), "review_id", "left")
    hit = F.col("__said").isNotNull() & ((F.col("processing_status") == "RAW") | cleanse_failure(F.col("processing_status"), F.col("error_message")))
    hit = F.coalesce(hit, F.lit(False))
    said = F.substring(F.concat(F.lit(CLEANSE_FAILED + " "), F.col("__said")), 1, MESSAGE)
    return _where(
        rows, hit, error_message=said, retry_count=F.coalesce("retry_count", F.lit(0)) + 1, processing_status=F.lit("FAILED")
    ).select(*master.columns)


def mark_analyzed(master: DataFrame, outcome: DataFrame) -> DataFrame:
    """Outcome (review_id, ok, message): success -> ANALYZED, else FAILED with one more retry and a message of at most 2000."""
    rows = master.join(outcome.select("review_id", F.col("ok").alias("__ok"), F.col("message").alias("__said")), "review_id", "left")
    hit, ok = F.col("__ok").isNotNull(), F.coalesce(F.col("__ok"), F.lit(False))
    return _where(
        rows,
        hit,
        error_message=F.when(ok, F.lit(None)).otherwise(F.substring("__said", 1, MESSAGE)),
        retry_count=F.coalesce("retry_count", F.lit(0)) + F.when(ok, 0).otherwise(1),
        processing_status=F.when(ok, "ANALYZED").otherwise("FAILED"),
    ).select(*master.columns)


def mark_batches_failed(batches: DataFrame, failures: DataFrame) -> DataFrame:
    """(batch_id, message): one more retry; DEAD_LETTER once they reach max_retries."""
    rows = batches.join(failures.select("batch_id", F.col("message").alias("__said")), "batch_id", "left")
    hit, tries = F.col("__said").isNotNull(), F.coalesce("retry_count", F.lit(0)) + 1
    return _where(
        rows, hit, status=F.when(tries >= F.col("max_retries"), "DEAD_LETTER").otherwise("FAILED"), error_message=F.col("__said"), retry_count=tries
    ).select(*batches.columns)


def mark_batches_loaded(batches: DataFrame, loaded: DataFrame, now) -> DataFrame:
    rows = batches.join(loaded.select("batch_id").withColumn("__hit", F.lit(True)), "batch_id", "left")
    hit = F.coalesce("__hit", F.lit(False))
    stamp = F.lit(now).cast("timestamp")
    return _where(rows, hit, status=F.lit("LOADED"), error_message=F.lit(None), loaded_at=stamp, updated_at=stamp).select(*batches.columns)
