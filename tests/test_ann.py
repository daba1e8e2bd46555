"""The inverted-file index against the exact way."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewright.functions import ann, vectors


@pytest.fixture(scope="module")
def base(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(f"k{k}", (centres[k % 12] + 0.4 * rng.normal(size=16)).tolist()) for k in range(1200)]
    rows += [("same", rows[0][1]), ("short", [1.0]), ("none", None), (None, rows[1][1]), ("zero", [0.0] * 16)]
    return spark.createDataFrame(rows, "vec_id string, embedding array<double>")


def test_recall_and_lists(spark, base, tmp_path):
    index = ann.build(base, f"file://{tmp_path}/ivf", 12)
    assert index.rows(spark).count() == 1202 and len(index.centroids) == 12
    tuned = ann.tuned(index, 10, 0.9, spark)
    assert tuned.probes < 12
    queries = base.filter(F.pmod(F.xxhash64("vec_id"), F.lit(20)) == 0)
    assert ann.recall(tuned, queries, 10) >= 0.9
    # only the folders of probed lists are read
    one = base.filter("vec_id = 'k5'")
    found = ann.search(index, one, 10)
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 12
    assert [r["query_id"] for r in found.collect()] == ["k5"] * 10
    assert ann.search(index, base.limit(0), 10).count() == 0


def test_all_lists_are_exact(spark, base, tmp_path):
    index = ann.build(base, f"file://{tmp_path}/ivf", 5)
    index = ann.replace(index, probes=5)
    queries = base.filter("vec_id in ('k0', 'k7', 'same', 'zero', 'short') or vec_id is null").filter("size(embedding) = 16")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(ann.search(index, queries, 7)) == rows(vectors.top_k(queries, base, 7))


def test_exact_keeps_large_ids_beside_null(spark):
    big = (1 << 60) + 1
    base = spark.createDataFrame([(big, [1.0, 0.0]), (big + 1, [1.0, 0.1]), (None, [1.0, 0.0]), (7, None), (8, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = vectors.top_k(base.filter(F.col("vec_id") == big), base, 2)
    assert [(r["query_id"], r["id"], r["rank"]) for r in got.orderBy("rank").collect()] == [(big, 8, 1), (big, big + 1, 2)]
