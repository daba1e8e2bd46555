"""Vectors (E01-E06): cosine, anchors, exact top-k, embedding with a pluggable model. The approximate top-k is in `ann`."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Queries in one broadcast (1536 numbers each: 12 MB).
QUERIES = 1000
#: Dimensions of the embedding models that may be named.
MODEL_DIMENSIONS = {"text-embedding-3-small": 1536, "text-embedding-ada-002": 1536}


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    """Euclidean length; 1 for a zero vector."""
    return F.coalesce(F.nullif(F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x)), F.lit(0.0)), F.lit(1.0))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector is zero; lengths must agree."""
    same = F.assert_true(F.size(a) == F.size(b), "vectors of different length")
    return F.when(same.isNull(), dot(a, b) / (norm(a) * norm(b)))


def nearest_anchor(vectors: DataFrame, anchors: dict[str, list[float]], column: str = "vector", threshold: float = 0.8) -> Column:
    """E04 as a column: the first anchor of the largest positive similarity, if that reaches the threshold."""
    scored = F.array(*[F.struct(cosine(F.col(column), F.array(*map(F.lit, v))).alias("s"), F.lit(-k).alias("o"), F.lit(name).alias("name")) for k, (name, v) in enumerate(anchors.items())])
    best = F.array_max(scored)
    return F.when((best["s"] > 0) & (best["s"] >= threshold), best["name"])


def read_anchors(spark: SparkSession, path: str, dim: int = 1536) -> dict[str, list[float]]:
    """The categories' anchor vectors, from a JSON object (category: numbers); order decides ties."""
    anchors = json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
    if wrong := [k for k, v in anchors.items() if len(v) != dim]:
        raise ValueError(f"anchors of another length than {dim}: {wrong}")
    return anchors


def model_dimension(model: str) -> int:
    """E02."""
    if model not in MODEL_DIMENSIONS:
        raise ValueError(f"unknown embedding model {model!r}")
    return MODEL_DIMENSIONS[model]


def hashing_embedder(dim: int = 1536):
    """A deterministic stand-in for a remote model: Column -> Column of unit vectors."""

    @pandas_udf("array<float>")
    def run(s: pd.Series) -> pd.Series:
        def one(text: str) -> list[float]:
            v = np.zeros(dim, np.float32)
            for word in text.split():
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
                v[h % dim] += 1 if h >> 63 else -1
            return (v / (np.linalg.norm(v) or 1.0)).tolist()

        return s.map(one, na_action="ignore")

    return run


def embed(reviews: DataFrame, embedder, model: str = "text-embedding-3-small", text: str = "refined_text") -> DataFrame:
    """Vectors of the reviews with text. embedder: Column -> Column (remote.column() retries); no vector, or one of
    another length, is a failure: the review has no row."""
    size = model_dimension(model)
    rows = reviews.filter(F.col(text).rlike(r"(?U)\S")).select("review_id", embedder(F.col(text)).alias("vector"))
    return rows.filter(F.size("vector") == size).select("review_id", F.lit("REVIEW").alias("source_content_type"), F.lit(model).alias("model_name"), "vector")


def top_k(queries: DataFrame, base: DataFrame, k: int, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """E06 exact: (query_id, id, similarity, rank). The stated queries are compared with all rows in blocks: each task keeps the
    best k of its rows for every query, the k best of those are ranked. Queries go out in parts of `QUERIES`. Rows without a key
    or a vector are not found; keys keep their type."""
    return ranked([compared(own, base, k, key, column) for own in blocks(queries, key)], k)


def blocks(queries: DataFrame, key: str) -> list[DataFrame]:
    parts = max(1, -(-queries.count() // QUERIES))
    return [queries.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == part) if parts > 1 else queries for part in range(parts)]


def ranked(found: list[DataFrame], k: int) -> DataFrame:
    both = found[0]
    for more in found[1:]:
        both = both.union(more)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return both.withColumn("rank", place).filter(F.col("rank") <= k)


def compared(queries: DataFrame, base: DataFrame, k: int, key: str, column: str, probed=None) -> DataFrame:
    """(query_id, id, similarity): the best k of each task's rows. probed: unit vectors of queries -> list number -> the queries
    that are compared with rows of that `list`."""
    there = F.col(key).isNotNull() & F.col(column).isNotNull()
    rows = queries.filter(there).select(key, column).collect()
    names, q = [r[0] for r in rows], unit(np.array([r[1] for r in rows], float)) if rows else np.zeros((0, 1))
    lists = None if probed is None else probed(q) if rows else {}
    sent = queries.sparkSession.sparkContext.broadcast((names, q, lists))
    kind = base.schema[key].dataType.simpleString()
    some = base.filter(there & (F.size(column) == q.shape[1]))
    if lists is not None:
        some = some.filter(F.col("list").isin(sorted(lists)))
    return some.select(key, column, *(["list"] if lists is not None else [])).mapInArrow(_best(sent, k, key, column), f"query_id {kind}, id {kind}, similarity double")


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows."""
    return unit(vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vectors), -1))


def _best(sent, k: int, key: str, column: str):
    def run(batches):
        names, q, lists = sent.value
        best: dict = {name: [] for name in names}
        kind = None
        for batch in batches:
            kind = batch.column(key).type
            if not batch.num_rows or not names:
                continue
            x, ids = matrix(batch.column(column)), np.array([*batch.column(key).to_pylist(), None], object)[:-1]
            groups = [(np.arange(len(ids)), np.arange(len(names)))]
            if lists is not None:
                own = batch.column("list").to_numpy()
                groups = [(np.flatnonzero(own == n), lists[n]) for n in np.unique(own).tolist() if n in lists]
            for rows, some in groups:
                s = np.round(q[some] @ x[rows].T, 9)
                for i, name in enumerate(names[j] for j in some):
                    row = np.where(ids[rows] == name, -np.inf, s[i])
                    least = np.partition(row, -k)[-k] if len(row) > k else -np.inf  # ties with the k-th stay
                    near = np.flatnonzero((row >= least) & (row > -np.inf))
                    best[name] = sorted(best[name] + list(zip((-row[near]).tolist(), ids[rows[near]].tolist(), strict=True)))[:k]
        if kind is not None:
            flat = [(n, j, -v) for n, x in best.items() for v, j in x]
            columns = zip(*flat, strict=True) if flat else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (kind, kind, pa.float64()), strict=True)], names=["query_id", "id", "similarity"])

    return run
