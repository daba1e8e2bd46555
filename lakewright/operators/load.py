"""Bronze to hub (M11): validate, resolve, de-duplicate, project; set-wise over all batches, of which each succeeds or fails by itself."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.operators import joins, projections
from lakewright.schemas import BRONZE, NATURAL
from lakewright.sources.files import list_files, resolve


#: App ids that an error message names at most.
NAMED = 20


@dataclass
class Loaded:
    hub: DataFrame
    reviews: DataFrame
    rejects: DataFrame
    new_apps: DataFrame


def pending_batches(batches: DataFrame, limit: int = 100) -> DataFrame:
    """Pending, or failed with retries left; oldest first."""
    state = F.col("status")
    open_ = (state == "PENDING") | ((state == "FAILED") & (F.col("retry_count") < F.col("max_retries")))
    return batches.filter(open_).orderBy(F.asc_nulls_last("created_at"), "batch_id").limit(limit)


def load_records(records: DataFrame, hub: DataFrame, apps: DataFrame, metadata: DataFrame, daily: bool, storage_path: str, now, strict: bool = False) -> Loaded:
    """records: app_review rows of one batch. daily: unknown apps fail the batch; else they are created."""
    valid, rejects = projections.split_valid(records, projections.review_reasons(), strict)
    valid = projections.valid_app_ids(valid)
    missing = joins.missing_apps(valid, apps)
    if daily and (lost := [r[0] for r in missing.orderBy("app_id").limit(NAMED).collect()]):
        raise LookupError(f"unknown app ids: {', '.join(lost)}")
    fresh = joins.new_reviews(valid, hub, [F.asc("created_at"), F.asc("review_id")])
    service = joins.current_service(metadata)
    placed = fresh.join(service, "app_id", "left")  # one small row per app: Spark broadcasts it while it is small
    new_hub, reviews = projections.load_projection(placed, F.lit(storage_path), F.lit(now).cast("timestamp"))
    created = missing.select(
        "app_id", F.col("app_id").alias("platform_app_id"), F.lit(None).cast("string").alias("platform_type"), F.concat(F.lit("app_"), "app_id").alias("name")
    )
    return Loaded(new_hub, reviews, rejects, created)


def batch_records(spark, batches: list) -> tuple[DataFrame, dict[str, str]]:
    """The rows of all batches (of the ledger, in order) in one scan, with `batch_id`, `place`, `daily` and `storage_path`; and
    batch_id -> message of those without a file."""
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")  # noqa: E731  file:/x and file:///x are one
    found, lost = [], {}
    for place, b in enumerate(batches):
        files = [p for p, _ in list_files(spark, resolve(b["storage_path"]))]
        if not files:
            lost[b["batch_id"]] = f"no file: {b['storage_path']}"
        # as Spark tells a row's file: with its odd characters encoded
        found += [(spark._jvm.org.apache.hadoop.fs.Path(p).toUri().toString(), p, b["batch_id"], place, b["platform_app_id"] == "daily_batch", b["storage_path"]) for p in files]
    told = spark.createDataFrame([(x[0], *x[2:]) for x in found], "file string, batch_id string, place int, daily boolean, storage_path string")
    if not found:
        return spark.createDataFrame([], BRONZE).crossJoin(told.drop("file")), lost
    rows = spark.read.schema(BRONZE).parquet(*[x[1] for x in found]).withColumn("file", plain(F.col("_metadata.file_path")))
    return rows.join(F.broadcast(told.withColumn("file", plain(F.col("file")))), "file").drop("file"), lost


def missing(records: DataFrame, apps: DataFrame) -> DataFrame:
    """(batch_id, place, daily, app_id) of unknown apps."""
    ids = projections.valid_app_ids(records.filter(F.size(projections.review_reasons()) == 0)).select("batch_id", "place", "daily", "app_id").distinct()
    return ids.join(apps.select("app_id"), "app_id", "left_anti")


def failing(records: DataFrame, apps: DataFrame) -> DataFrame:
    """(batch_id, message): batches with an invalid row; daily ones with an app that is unknown and that no good batch before them creates."""
    invalid = records.withColumn("reasons", projections.review_reasons()).filter(F.size("reasons") > 0)
    invalid = invalid.groupBy("batch_id").agg(F.concat(F.lit("invalid record: "), F.array_join(F.min("reasons"), ", ")).alias("message"))
    unknown = missing(records, apps).join(invalid.select("batch_id"), "batch_id", "left_anti")
    made = unknown.filter("not daily").groupBy("app_id").agg(F.min("place").alias("since"))
    lost = unknown.filter("daily").join(made, "app_id", "left").filter(F.coalesce(F.col("since") > F.col("place"), F.lit(True)))
    some = lost.withColumn("k", F.row_number().over(Window.partitionBy("batch_id").orderBy("app_id"))).filter(F.col("k") <= NAMED)
    named = some.groupBy("batch_id").agg(F.concat(F.lit("unknown app ids: "), F.array_join(F.array_sort(F.collect_list("app_id")), ", ")).alias("message"))
    return invalid.unionByName(named)


def new_apps(records: DataFrame, apps: DataFrame) -> DataFrame:
    return missing(records, apps).select("app_id").distinct().select(
        "app_id", F.col("app_id").alias("platform_app_id"), F.lit(None).cast("string").alias("platform_type"), F.concat(F.lit("app_"), "app_id").alias("name")
    )


def place_records(records: DataFrame, known: DataFrame, buckets: int, metadata: DataFrame) -> DataFrame:
    """New reviews of good batches with service_id; of a review in several rows the one of the first batch, then the oldest. The rows
    are dealt as `known` is bucketed, so only they are shuffled."""
    dealt = projections.valid_app_ids(records).repartition(buckets, *NATURAL)
    order: list[Column] = [F.asc("place"), F.asc("created_at"), F.asc("review_id")]
    fresh = joins.first_per_key(dealt.join(known, list(NATURAL), "left_anti"), list(NATURAL), order)
    return fresh.join(joins.current_service(metadata), "app_id", "left")
