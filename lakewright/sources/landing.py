"""Store payloads (S01-S06): landed JSON pages to review rows. Fetching over a network is left to whoever lands the files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright.operators import projections as p
from lakewright.operators.joins import first_per_key

_LABEL = "struct<label:string>"
_ENTRY = f"struct<id:{_LABEL},author:struct<name:{_LABEL}>,`im:name`:{_LABEL},content:{_LABEL},`im:rating`:{_LABEL},updated:{_LABEL},`im:version`:{_LABEL}>"
_PAGE = r"(?:^|/)(?:app=)?([^/]+)/(?:(?=\d+\.json$)|page=(?=\d+/[^/]+$))(\d+)"
PLAYSTORE = "reviewId string, userName string, content string, score string, at string, appVersion string, replyContent string, appId string"


def app_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a list file, without comments and blank lines."""
    rows = spark.read.text(path).select(F.trim(F.element_at(F.split("value", "#"), 1)).alias("app_id"))
    return rows.filter("app_id <> ''")


def appstore_pages(spark: SparkSession, path: str) -> DataFrame:
    """Files <app>/<page>.json, or app=<app>/page=<page>/<any name> -> (app, page, at, entry) of all entries; one entry
    may stand without its list.

    Pages behind the first empty one are not read on; the entry with the app's name is no review. The driver lists each file: many
    pages land better as `appstore_bundles`.
    """
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True).withColumn("file", F.col("_metadata.file_path"))
    return _entries(raw.select(F.regexp_extract("file", _PAGE, 1).alias("app"), F.regexp_extract("file", _PAGE, 2).cast("int").alias("page"), "value"))


def appstore_bundles(spark: SparkSession, path: str) -> DataFrame:
    """The same of JSON lines {app, page, value}, any number of pages in a file; value is a page's text."""
    return _entries(spark.read.schema("app string, page int, value string").json(path))


def _entries(raw: DataFrame) -> DataFrame:
    entry = F.get_json_object("value", "$.feed.entry")
    listed = F.when(entry.startswith("["), entry).otherwise(F.concat(F.lit("["), entry, F.lit("]")))
    pages = raw.select("app", "page", F.coalesce(F.from_json(listed, f"array<{_ENTRY}>"), F.array().cast(f"array<{_ENTRY}>")).alias("entries"))
    empty = pages.filter(F.size("entries") == 0).groupBy("app").agg(F.min("page").alias("stop"))
    # a row for an app at most: a shuffle by app would bring all pages of a large one together
    read = pages.join(F.broadcast(empty), "app", "left").filter(F.col("stop").isNull() | (F.col("page") < F.col("stop")))
    return read.select("app", "page", F.posexplode("entries").alias("at", "entry"))


def app_names(entries: DataFrame) -> DataFrame:
    """The name on the first page, else app_<id>."""
    found = F.max(F.when((F.col("page") == 1) & (F.col("at") == 0), F.col("entry.`im:name`.label")))
    return entries.groupBy("app").agg(F.coalesce(found, F.concat(F.lit("app_"), "app")).alias("name"))


def appstore_reviews(entries: DataFrame, most: int, now: Column | None = None) -> DataFrame:
    """Review rows, at most `most` of each app in page order; blank texts are skipped. An app's pages are counted in one
    task, its entries are not brought together."""
    e = entries.filter(F.col("entry.`im:rating`").isNotNull() | F.col("entry.`im:name`").isNull())
    pages = e.groupBy("app", "page").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("app").orderBy("page")) - F.col("n")
    place = F.col("before") + F.row_number().over(Window.partitionBy("app", "page").orderBy("at"))
    e = e.join(pages.select("app", "page", before.alias("before")), ["app", "page"]).withColumn("n", place).filter(F.col("n") <= most)
    rows = e.select(
        F.col("app").alias("platform_app_id"), F.lit("APPSTORE").alias("platform_type"), F.col("entry.id.label").alias("platform_review_id"),
        F.col("entry.author.name.label").alias("reviewer_name"), F.col("entry.content.label").alias("review_text"),
        p.clamp_rating(F.col("entry.`im:rating`.label")).alias("rating"), p.parse_time(F.col("entry.updated.label"), now).alias("reviewed_at"),
        F.lit(False).alias("is_reply"), F.lit(None).cast("string").alias("reply_comment"), "page", "at",
    )
    return rows.filter(F.col("review_text").rlike(r"(?U)\S"))


def playstore_reviews(spark: SparkSession, path: str, now: Column | None = None) -> DataFrame:
    """JSON lines to review rows; bad ratings count as 1, replies are kept."""
    raw = spark.read.schema(PLAYSTORE).json(path)
    rows = raw.select(
        F.col("appId").alias("platform_app_id"), F.lit("PLAYSTORE").alias("platform_type"), F.col("reviewId").alias("platform_review_id"),
        F.col("userName").alias("reviewer_name"), F.trim("content").alias("review_text"), p.clamp_rating(F.col("score")).alias("rating"),
        p.parse_time(F.col("at"), now).alias("reviewed_at"), F.col("replyContent").isNotNull().alias("is_reply"), F.col("replyContent").alias("reply_comment"),
    )
    return rows.filter(F.col("review_text").rlike(r"(?U)\S"))


def with_ids(rows: DataFrame, apps: DataFrame, now: Column) -> DataFrame:
    """app_id by platform id (unknown apps get one from the hash), review_id as a version-7 UUID of the review's time."""
    known = apps.select("platform_app_id", "platform_type", "app_id")
    out = rows.join(known, ["platform_app_id", "platform_type"], "left")
    return out.withColumns({
        "app_id": F.coalesce("app_id", p.uuid7(F.lit(0).cast("long"), F.col("platform_type"), F.col("platform_app_id"))),
        "review_id": p.uuid7(F.unix_millis("reviewed_at"), F.col("platform_type"), F.col("platform_review_id")),
        "created_at": now,
    })


READERS: dict[str, Callable] = {"appstore": appstore_pages, "playstore": playstore_reviews}


def reader(store: str) -> Callable:
    """By name, in any case."""
    if store.lower() not in READERS:
        raise ValueError(f"unknown store {store!r}: one of {sorted(READERS)}")
    return READERS[store.lower()]


def union_of_successes(readers: list[Callable[[], DataFrame]], report: Callable[[Exception], None] = lambda e: None) -> DataFrame | None:
    """What the stores that answer give; a failing one is reported and left out."""
    out = None
    for read in readers:
        try:
            df = read()
        except Exception as e:  # noqa: BLE001  each store fails by itself
            report(e)
            continue
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def one_per_review(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, ["platform_type", "platform_review_id"], [F.asc("reviewed_at"), F.asc("review_text")])
