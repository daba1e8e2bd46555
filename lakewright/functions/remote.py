"""Calls of remote models from Python workers: retries with a growing pause."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

ATTEMPTS, PAUSE = 3, 2.0


def retried(call: Callable, attempts: int = ATTEMPTS, pause: float = PAUSE) -> Callable:
    """text -> call's value, or None: an error whose `status_code` is 429, or 500 and above, is tried again after `pause`
    times the number of tries; any other one ends it."""

    def run(text):
        for k in range(1, attempts + 1):
            try:
                return call(text)
            except Exception as e:  # noqa: BLE001  a failed call is a null
                code = getattr(e, "status_code", None)
                if code is None or code < 500 and code != 429 or k == attempts:
                    return None
                time.sleep(pause * k)

    return run


def column(call: Callable, ddl: str, attempts: int = ATTEMPTS, pause: float = PAUSE) -> Callable[[Column], Column]:
    """A Column function of a remote model: null text and failed calls give null."""
    one = retried(call, attempts, pause)

    @pandas_udf(ddl)
    def run(s: pd.Series) -> pd.Series:
        return s.map(one, na_action="ignore")

    return run
