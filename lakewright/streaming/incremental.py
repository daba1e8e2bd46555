"""Incremental runs as streams (ST01-ST03): new Bronze files once each, loads with effect once, re-delivery dropped, daily buckets."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.operators import load, projections
from lakewright.schemas import BRONZE, HUB, NATURAL
from lakewright.sources.catalog import Catalog, Conflict
from lakewright.sources.files import get


def bronze_stream(spark: SparkSession, base: str, schema: str = BRONZE) -> DataFrame:
    """Files that appear below base."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(base)


def run_available(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """ST01: all that has arrived since the last run, then stop."""
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def without_redelivery(stream: DataFrame) -> DataFrame:
    """ST02: a review that was delivered before is dropped, however long ago: its natural key stays in the RocksDB store of the stream's
    checkpoint (on the executors' disks, a few bytes for each review, as in the hub) and survives a restart. All in the JVM."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return stream.dropDuplicates(list(NATURAL))


def load_stream(catalog: Catalog, base: str, checkpoint: str, now: dt.datetime) -> None:
    """ST01/R01: the files that have arrived below base since the last run, into the hub; each has its effect once, wherever a run dies."""
    spark = catalog.spark

    def write(rows: DataFrame, batch: int) -> None:
        name = json.loads(get(spark, f"{checkpoint}/metadata"))["id"]  # of the checkpoint: a new one counts from 0 again
        load_micro_batch(catalog, rows, (name, batch), now)

    run_available(bronze_stream(spark, base).withColumn("storage_path", F.col("_metadata.file_path")), checkpoint, write)


def load_micro_batch(catalog: Catalog, rows: DataFrame, mark: tuple[str, int], now: dt.datetime) -> int:
    """New reviews of a batch (with `storage_path`); its mark is published with the hub's rows, by the same pointer, so a batch that comes again is known.
    Invalid rows are set aside below `_rejects`, by batch."""
    if catalog.state(HUB)["marks"].get(mark[0], -1) >= mark[1]:
        return 0
    told = rows.withColumns({"place": F.lit(0), "daily": F.lit(False), "batch_id": F.lit(str(mark[1]))})
    valid, rejects = projections.split_valid(told, projections.review_reasons())
    rejects.write.mode("overwrite").parquet(f"{catalog.base}/_rejects/{mark[0]}-{mark[1]:09d}")
    while True:
        known, buckets = catalog.known_keys()
        apps = catalog.read("apps")
        try:
            with catalog.staged(load.place_records(valid, known, buckets, catalog.read("app_metadata"))) as placed:
                hub, texts = projections.load_projection(placed, F.col("storage_path"), F.lit(now).cast("timestamp"))
                there = catalog.read("app_reviews", parts=catalog.parts_of("app_reviews", texts)).select("review_id")
                catalog.append("apps", load.new_apps(valid, apps))
                catalog.append("app_reviews", texts.join(there, "review_id", "left_anti"), unless_changed=True)
                return catalog.append(HUB, hub, unless_changed=True, mark=mark)
        except Conflict:  # another load was first: its reviews are known now
            continue


def daily_counts(events: DataFrame, time: str, *keys: str) -> DataFrame:
    """ST03: tumbling one-day buckets (UTC), for batches and streams alike."""
    return events.groupBy(F.window(time, "1 day").alias("w"), *keys).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("date"), *keys, "n")
