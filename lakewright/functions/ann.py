"""Approximate top-k (E06): an inverted-file index over unit vectors.

Centroids come from k-means on a bounded sample; every row of the table goes to the list of its nearest centroid, and a search
compares a query with the rows of its `probes` nearest lists, whose folders are the only ones that are read. How many lists that
takes is measured: `tuned` doubles the number until the recall of sampled rows against the exact way reaches the target, so in the
end all lists are probed and the result is exact.

Rows without a key or a vector, or with a vector of another length, are in no list; a list may hold any share of the rows, its
files are split as any others.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions import vectors

#: Rows that the centroids are fitted on at most, and rows that the recall is measured with.
SAMPLE, MEASURED = 20_000, 100


@dataclass(frozen=True)
class Index:
    """centroids: unit vectors, one for each list; path: the rows by list."""

    centroids: np.ndarray
    path: str
    key: str
    column: str
    probes: int = 1

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def probed(self, q: np.ndarray) -> dict[int, np.ndarray]:
        """list number -> the queries that have it among their nearest."""
        near = np.argsort(-(q @ self.centroids.T), axis=1, kind="stable")[:, : self.probes]
        return {int(n): np.flatnonzero((near == n).any(axis=1)) for n in np.unique(near)}


def build(base: DataFrame, path: str, lists: int, key: str = "vec_id", column: str = "embedding", seed: int = 1) -> Index:
    """Fit the centroids on at most `SAMPLE` rows, assign every row and write it by list."""
    known = base.filter(F.col(key).isNotNull() & F.col(column).isNotNull())
    size = known.agg(F.count("*").alias("n"), F.mode(F.size(column)).alias("dim")).first()
    known = known.filter(F.size(column) == F.lit(size["dim"])).select(key, column)
    long = vectors.norm(F.col(column))
    sample = known.sample(min(1.0, SAMPLE / max(1, size["n"])), seed).limit(SAMPLE)
    points = sample.select(array_to_vector(F.transform(column, lambda x: x.cast("double") / long)).alias("features"))
    centroids = vectors.unit(np.array(KMeans(k=lists, seed=seed, maxIter=10).fit(points).clusterCenters()))
    sent = base.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches):
        for batch in batches:
            own = np.argmax(vectors.matrix(batch.column(column)) @ sent.value.T, axis=1) if batch.num_rows else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=[*batch.schema.names, "list"])

    kinds = ", ".join(f"{c} {t}" for c, t in known.dtypes)
    known.mapInArrow(assign, f"{kinds}, list int").hint("rebalance", "list").write.partitionBy("list").parquet(path)
    return Index(centroids, path, key, column)


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, id, similarity, rank) from the lists that the queries probe."""
    rows = index.rows(queries.sparkSession).withColumn("list", F.col("list").cast("int"))
    return vectors.ranked([vectors.compared(own, rows, k, index.key, index.column, index.probed) for own in vectors.blocks(queries, index.key)], k)


def recall(index: Index, queries: DataFrame, k: int) -> float:
    """The share of the exact top k that the index finds."""
    exact = vectors.top_k(queries, index.rows(queries.sparkSession), k, index.key, index.column).select("query_id", "id")
    found = search(index, queries, k).select("query_id", "id", F.lit(1).alias("hit"))
    both = exact.join(found, ["query_id", "id"], "left").agg(F.count("*").alias("n"), F.count("hit").alias("hits")).first()
    return both["hits"] / both["n"] if both["n"] else 1.0


def tuned(index: Index, k: int, target: float = 0.9, spark: SparkSession | None = None) -> Index:
    """The index with as many probes as the target takes for `MEASURED` of its rows (by a hash of their keys)."""
    spark = spark or SparkSession.active()
    some = index.rows(spark).select(index.key, index.column).orderBy(F.xxhash64(index.key)).limit(MEASURED)
    while index.probes < len(index.centroids) and recall(index, some, k) < target:
        index = replace(index, probes=min(len(index.centroids), 2 * index.probes))
    return index
