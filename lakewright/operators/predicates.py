"""Predicates (F01-F15) in the form that reaches the Parquet scan."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bound(df: DataFrame, column: str, day: dt.date) -> Column:
    """Midnight of a day in the column's own timestamp type, so that no cast stands on the column."""
    kind = df.schema[column].dataType.simpleString()
    return F.lit(dt.datetime.combine(day, dt.time())).cast(kind) if kind != "timestamp_ntz" else F.expr(f"timestamp_ntz'{day.isoformat()} 00:00:00'")


def day_range(df: DataFrame, column: str, first: dt.date | None, last: dt.date | None = None) -> Column:
    """days first..last as a half-open range; either bound may be missing."""
    terms = []
    if first is not None:
        terms.append(F.col(column) >= _bound(df, column, first))
    if last is not None:
        terms.append(F.col(column) < _bound(df, column, last + dt.timedelta(days=1)))
    return reduce(and_, terms, F.lit(True))


def on_day(df: DataFrame, column: str, day: dt.date) -> Column:
    return day_range(df, column, day, day)


def retryable(status: Column, retries: Column, state: str = "CLEANED", most: int = 3) -> Column:
    """in the state, or failed with retries left."""
    return (status == state) | ((status == "FAILED") & (F.coalesce(retries, F.lit(0)) < most))


def optional_equal(column: Column, value) -> Column:
    """no condition without a value."""
    return F.lit(True) if value is None else column == value


def optional_in(column: Column, values) -> Column:
    return F.lit(True) if values is None else column.isin(list(values))


def only_if(flag: bool | None, column: Column) -> Column:
    """with the flag set only rows where the column is true."""
    return F.coalesce(column, F.lit(False)) if flag is True else F.lit(True)


def contains_all(array: Column, wanted: list[str]) -> Column:
    """F11."""
    return F.size(F.array_except(F.array(*map(F.lit, wanted)), array)) == 0


def keyset_after(time: Column, key: Column, at, at_key) -> Column:
    """(time, key) < (at, at_key), unknown for nulls; no bound for a first page."""
    if at is None:
        return F.lit(True)
    return (time < F.lit(at)) | ((time == F.lit(at)) & (key < F.lit(at_key)))


#: Names of daily partitions.
PARTITION_NAME = r"^srv_daily_review_list_\d{4}_\d{2}_\d{2}$"
CLEANSE_FAILED = "Cleanse failed:"


def cleanse_failure(status: Column, message: Column) -> Column:
    """F08."""
    return (status == "FAILED") & F.coalesce(message.startswith(CLEANSE_FAILED), F.lit(False))


def is_open(status: Column, message: Column, retries: Column, most: int = 3) -> Column:
    """Whether the cleansing or the analysis will take a review up (again)."""
    return F.coalesce((status == "RAW") | cleanse_failure(status, message) | retryable(status, retries, "CLEANED", most), F.lit(False))


def outside(column: Column, low: float, high: float) -> Column:
    """known and out of range."""
    return F.coalesce((column < low) | (column > high), F.lit(False))
