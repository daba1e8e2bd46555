"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakewright.llm import common, decontaminate, ngram_join, packing, pii, quality_rules


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed; documents that the quality rules reject go."""
    return quality_rules.stage(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more over five-word shingles, the smallest doc_id stays."""
    common.tune(spark)
    return ngram_join.stage(docs, 5, 80)


def decontaminate_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of `benchmark` are cut out; documents that are mostly such spans go."""
    common.tune(spark)
    return decontaminate.stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and credentials are masked; all documents stay."""
    common.tune(spark)
    return pii.stage(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences (see packing.COLUMNS)."""
    common.tune(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", clean_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminate_spans),
    ("personal data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Bootstrapping, tokenising and packing are beyond SQL: tests/llm compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.cut(docs, "stage")
            if before is not None:
                common.forget(before)
            before = docs
    return docs
