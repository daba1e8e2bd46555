"""Parquet lake (S07-S21): partitioned sinks and scans, batch ledger, listings, path schemes. All through Spark and Hadoop paths."""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.operators.joins import first_per_key
from lakewright.schemas import TABLES
from lakewright.sources.catalog import Catalog
from lakewright.sources.files import delete, exists, fs, get, list_files, partitions_named, put, resolve

__all__ = ["Catalog", "delete", "exists", "fs", "get", "list_files", "partitions_named", "put", "resolve"]

MODES = {"none": (), "year": ("year",), "year_month": ("year", "month"), "year_month_day": ("year", "month", "day")}


def write_batch(df: DataFrame, base: str, day: dt.date | None = None, mode: str = "year_month_day", codec: str = "snappy") -> str:
    """Append under year=/month=/day= (mode decides how deep); an empty batch is an error. Returns the folder."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    if df.limit(1).count() == 0:
        raise ValueError("no records")
    parts = {"year": f"{(day or dt.date.today()).year}", "month": f"{(day or dt.date.today()).month:02d}", "day": f"{(day or dt.date.today()).day:02d}"}
    folder = "/".join([base.rstrip("/"), *(f"{k}={parts[k]}" for k in MODES[mode])])
    df.write.mode("append").option("compression", codec).parquet(folder)
    return folder


def stats(spark: SparkSession, base: str) -> dict[str, int]:
    """Partitions, files, bytes."""
    found = list_files(spark, base)
    return {"partitions": len({p.rsplit("/", 1)[0] for p, _ in found}), "files": len(found), "bytes": sum(n for _, n in found)}


def read_batch(spark: SparkSession, storage_path: str, bucket: str = "", schema: str | None = None) -> DataFrame:
    """A batch by any scheme, with a declared schema; a missing path is an error."""
    path = resolve(storage_path, bucket)
    if not exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def daily_batch(df: DataFrame, base: str, ledger: Catalog, platform: str, day: dt.date, now: dt.datetime) -> str:
    """A folder per platform and day, then a PENDING ledger row; if the row cannot be written the folder goes again."""
    folder = f"{base.rstrip('/')}/app_reviews/year={day.year}/month={day.month:02d}/day={day.day:02d}/{platform.lower()}_{now:%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}"
    _deliver(df, folder, ledger, platform, "daily_batch", None, now)
    return folder


def _deliver(df: DataFrame, folder: str, ledger: Catalog, platform: str, app: str, app_name: str | None, now: dt.datetime) -> None:
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(folder)
    try:
        n = spark.read.parquet(folder).count()
        row = {"batch_id": str(uuid.uuid4()), "source_type": platform, "platform_app_id": app, "app_name": app_name, "storage_path": folder, "file_format": "parquet",
               "record_count": n, "status": "PENDING", "retry_count": 0, "max_retries": 3, "created_at": now, "updated_at": now}
        ledger.append("ingestion_batch", spark.createDataFrame([row], TABLES["ingestion_batch"]))
    except Exception:
        delete(spark, folder)
        raise


def app_batch(df: DataFrame, base: str, ledger: Catalog, platform: str, app: str, app_name: str, now: dt.datetime) -> str | None:
    """One crawl of one app: rows whose platform_review_id is new in the batch and in the hub go to a folder of the app,
    then a PENDING ledger row; a folder without its row goes again. None where nothing is new."""
    known = ledger.read("review_master_index").filter((F.col("platform_type") == platform) & (F.col("app_id") == app)).select("platform_review_id").distinct()
    fresh = first_per_key(df, ["platform_review_id"], [F.asc("created_at"), F.asc("review_id")]).join(known, "platform_review_id", "left_anti").select(*df.columns)
    if fresh.limit(1).count() == 0:
        return None
    folder = f"{base.rstrip('/')}/app_reviews/app_id={app}/year={now.year}/month={now.month:02d}/day={now.day:02d}/{platform.lower()}_{now:%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}"
    _deliver(fresh, folder, ledger, platform, app, app_name, now)
    return folder


def bronze_day(spark: SparkSession, base: str, day: dt.date, schema: str | None = None) -> DataFrame:
    """One crawl day. Only its folder is listed and read."""
    path = f"{base.rstrip('/')}/app_reviews/year={day.year}/month={day.month:02d}/day={day.day:02d}"
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).parquet(path)


def write_silver(df: DataFrame, base: str) -> None:
    """Refined rows by app_id and dt; partitions that get rows are replaced, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("app_id", "dt").parquet(f"{base.rstrip('/')}/reviews")


BOM = "\ufeff"


def write_csv(df: DataFrame, folder: str, mark: bool = False) -> None:
    """For consumers of text files. mark: each file starts with a byte-order mark, as spreadsheets want it."""
    if mark:
        df = df.toDF(BOM + df.columns[0], *df.columns[1:])
    df.write.mode("append").option("header", "true").csv(folder)


def read_csv(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Files with a header, with or without a byte-order mark; columns by the header's order, not by its names."""
    return spark.read.option("header", "true").schema(schema).csv(folder)


def list_csv(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of the CSV files below a folder, oldest first."""
    files, at = fs(spark, folder)
    if not files.exists(at):
        return []
    out, each = [], files.listFiles(at, True)
    while each.hasNext():
        f = each.next()
        if f.getPath().getName().endswith(".csv"):
            out.append((f.getPath().toString(), f.getModificationTime()))
    return sorted(out, key=lambda x: (x[1], x[0]))


def back_up_csv(spark: SparkSession, folder: str, backup: str) -> int:
    """A copy of each CSV file into another folder; returns their number."""
    found = list_csv(spark, folder)
    to, root = fs(spark, backup)
    to.mkdirs(root)
    for path, _ in found:
        files, at = fs(spark, path)
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(files, at, to, root, False, True, spark._jsc.hadoopConfiguration())
    return len(found)


def retire_csv(spark: SparkSession, folder: str, before: dt.datetime) -> int:
    """Files older than a moment go; returns their number."""
    old = [p for p, t in list_csv(spark, folder) if t < before.timestamp() * 1000]
    return sum(delete(spark, p) for p in old)


def read_dictionary(spark: SparkSession, path: str) -> dict[str, str]:
    """A JSON object, or a list whose words all get [SLANG]."""
    data = json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
    return dict(data) if isinstance(data, dict) else dict.fromkeys(data, "[SLANG]")


_VARIABLE = re.compile(r"\$\{(\w+)\}|\$(\w+)")


def fill_path(path: str, env: dict[str, str] | None = None) -> str:
    """${VAR} and $VAR from the environment; unknown ones stay; back-slashes become slashes."""
    env = dict(os.environ) if env is None else env
    return _VARIABLE.sub(lambda m: env.get(m[1] or m[2], m[0]), path).replace("\\", "/")


def store_settings(endpoint: str, access_key: str, secret_key: str, secure: bool = False) -> dict[str, str]:
    """Spark settings of an object store; both keys or none (then the default provider chain), a scheme decides over `secure`."""
    if bool(access_key) != bool(secret_key):
        raise ValueError("give both keys of the object store, or none")
    scheme, _, rest = endpoint.rpartition("://")
    secure = {"": secure, "http": False, "https": True}[scheme]
    out = {"spark.hadoop.fs.s3a.endpoint": rest, "spark.hadoop.fs.s3a.path.style.access": "true", "spark.hadoop.fs.s3a.connection.ssl.enabled": str(secure).lower()}
    return out | ({"spark.hadoop.fs.s3a.access.key": access_key, "spark.hadoop.fs.s3a.secret.key": secret_key} if access_key else {})
