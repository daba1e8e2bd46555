"""A bounded training sample of labelled documents, and the rows that a classifier scores.

`labels` may repeat a document: its label is the largest one. Of either class `PER_CLASS` (the caller's) labelled ids
are taken in the order of a hash of the id, a tie by the id. Of their whole texts, in the same order, each is taken that
has at most `MAX_TEXT` characters and with which the sample stays within `MAX_CHARS`; one that does not fit is left out,
and those behind it are not. Null ids and null labels are never taken.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common

MAX_CHARS = 30_000_000
MAX_TEXT = 300_000
SCORED = "doc_id bigint, held_out boolean, score double, predicted int"


def remainder(mod: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % mod


def held_out(mod: int, at: int) -> Column:
    return F.coalesce(remainder(mod) == at, F.lit(False))


def scoring_rows(docs: DataFrame, mod: int, at: int) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("body"), held_out(mod, at).alias("held_out"))


def scored(batch: pa.RecordBatch, score: np.ndarray, threshold: float) -> pa.RecordBatch:
    """SCORED rows of a batch of scoring_rows()."""
    return common.batch_of(
        doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), score=pa.array(score, pa.float64()), predicted=pa.array((score >= threshold).astype(np.int32))
    )


def sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, at: int, per_class: int) -> pd.DataFrame:
    """doc_id, text, label of the training rows, in a stable order. One pass over docs."""
    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter((remainder(mod) != at) & F.col("label").isin(0, 1))
    own = own.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("place", F.xxhash64("doc_id"))
    taken = [r for k in (0, 1) for r in own.filter(F.col("label") == k).orderBy("place", "doc_id").limit(per_class).collect()]
    spark = docs.sparkSession
    few = F.broadcast(spark.createDataFrame(taken, own.schema))  # 2 * per_class rows at most
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(F.length("text") <= MAX_TEXT).join(few, "doc_id")
    rows = common.cut(rows.groupBy("doc_id", "place", "label").agg(F.max("text").alias("text")), "labelled")
    sizes = rows.select("doc_id", F.length("text").alias("n")).orderBy("place", "doc_id").collect()
    keep, size = [], 0
    for r in sizes:
        if size + r["n"] <= MAX_CHARS:
            keep.append((r["doc_id"],))
            size += r["n"]
    kept = F.broadcast(spark.createDataFrame(keep, rows.select("doc_id").schema))
    got = rows.join(kept, "doc_id").toPandas()
    common.forget(rows)
    return got.sort_values(["place", "doc_id"]).reset_index(drop=True)
