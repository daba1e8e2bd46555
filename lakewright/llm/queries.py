"""The registry of this subpackage: one query opN_<name> per operator, over its whole tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakewright.llm import common

#: name -> (module, tables that it reads)
_QUERIES = {
    "op1_pii_bootstrap": ("pii", ("documents",)),
    "op2_line_rules": ("quality_rules", ("documents",)),
    "op3_url_trees": ("url_filter", ("pages",)),
    "op4_decontaminate": ("decontaminate", ("documents", "benchmark")),
    "op5_ngram_join": ("ngram_join", ("documents",)),
    "op6_toxicity_ftrl": ("toxicity", ("documents", "labels")),
    "op7_quality_trees": ("quality_trees", ("documents", "labels")),
    "op8_tiered_packing": ("packing", ("documents",)),
    "op9_block_text": ("html_blocks", ("pages",)),
    "op10_seekable_warc": ("warc", ("pages",)),
    "op11_turn_repair": ("turn_repair", ("conversations",)),
    "op12_substring_dedup": ("substring_dedup", ("documents",)),
    "op13_merkle_manifest": ("merkle", ("documents",)),
}


def _run(module: str, tables: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        common.tune(spark)
        return importlib.import_module(f"lakewright.llm.{module}").query(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _run(*x) for name, x in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, (module, _) in _QUERIES.items():
        if sql := getattr(importlib.import_module(f"lakewright.llm.{module}"), "SQL", None):
            out[name] = sql
    return out
