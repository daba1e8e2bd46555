"""Every query of the engine against its DuckDB counterpart on the smallest driver tables."""

import math
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__
from lakewright import registry

WHERE = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(WHERE), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{WHERE}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, WHERE)
    cols = sorted(df.columns)
    got = sorted((str(tuple(plain(r[c]) for c in cols)) for r in df.collect()))
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    rel = duck.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    assert got == sorted(str(tuple(plain(r[names.index(c)]) for c in cols)) for r in rel.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_the_training_data_operators():
    for folder, _, files in os.walk(os.path.dirname(registry.__file__)):
        for f in files:
            if f.endswith(".py") and not folder.endswith("/llm"):
                with open(os.path.join(folder, f)) as source:
                    assert "lakewright.llm" not in source.read(), f


def test_marts_stay_in_the_jvm(spark):
    for name in ("a01_fact_review_daily", "a02_fact_aspect_daily", "a03_fact_category_radar", "m10_serving_list"):
        assert "Python" not in registry.queries()[name](spark, WHERE)._jdf.queryExecution().executedPlan().toString()
