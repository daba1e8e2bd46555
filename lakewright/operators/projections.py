"""Projection and row validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakewright.operators.joins import first_per_key
from lakewright.schemas import PLATFORMS

UUID = r"^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"


def review_reasons() -> Column:
    """Why a row is no valid review (empty: valid)."""
    blank = lambda c: F.col(c).isNull() | ~F.col(c).rlike(r"(?U)\S")
    return F.array_compact(F.array(
        F.when(~F.coalesce(F.col("platform_type").isin(*PLATFORMS), F.lit(False)), "platform_type"),
        F.when(~F.coalesce(F.col("rating").between(1, 5), F.lit(False)), "rating"),
        F.when(blank("review_text"), "review_text"),
    ))


def preprocessed_reasons() -> Column:
    """Blank ids, and a refined text that is blank but not null."""
    blank = lambda c: ~F.col(c).rlike(r"(?U)\S")
    return F.array_compact(F.array(
        F.when(F.col("review_id").isNull() | blank("review_id"), "review_id"),
        F.when(F.col("platform_review_id").isNull() | blank("platform_review_id"), "platform_review_id"),
        F.when(F.col("refined_text").isNotNull() & blank("refined_text"), "refined_text"),
    ))


def split_valid(rows: DataFrame, reasons: Column, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects with `reasons`); strict: any reject fails the whole batch, as a loader without quarantine does."""
    marked = rows.withColumn("reasons", reasons)
    rejects = marked.filter(F.size("reasons") > 0)
    if strict and (bad := rejects.limit(1).collect()):
        raise ValueError(f"invalid record: {list(bad[0]['reasons'])}")
    return marked.filter(F.size("reasons") == 0).drop("reasons"), rejects


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs to columns named by their path."""

    def walk(schema: StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, StructType):
                out += walk(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{x}`" for x in here)).alias(sep.join(here)))
        return out

    return df.select(*walk(df.schema, ()))


def title_of(text: Column, most: int = 100) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def normalize_playstore(df: DataFrame, app_id: str, app_name: str) -> DataFrame:
    """P04 for the store whose rows are flat."""
    text = F.coalesce(F.col("content"), F.lit(""))
    return df.select(
        F.lit("playstore").alias("platform"), F.lit(app_id).alias("app_id"), F.lit(app_name).alias("app_name"),
        F.col("reviewId").alias("review_id"), F.col("userName").alias("author"), title_of(text).alias("title"), text.alias("content"),
        F.col("score").cast("string").alias("rating"), F.col("at").cast("string").alias("date"), F.coalesce("appVersion", F.lit("")).alias("version"),
    )


def normalize_appstore(df: DataFrame, app_id: str, app_name: str) -> DataFrame:
    """P04 for the store whose rows are nested labels."""
    label = lambda p: F.col(f"{p}.label")
    text = F.coalesce(label("content"), F.lit(""))
    return df.select(
        F.lit("appstore").alias("platform"), F.lit(app_id).alias("app_id"), F.lit(app_name).alias("app_name"),
        label("id").alias("review_id"), label("author.name").alias("author"), title_of(text).alias("title"), text.alias("content"),
        label("`im:rating`").alias("rating"), label("updated").alias("date"), F.coalesce(label("`im:version`"), F.lit("")).alias("version"),
    )


def unify(frames: list[DataFrame], first: tuple[str, ...] = ("platform", "app_id", "app_name")) -> DataFrame:
    """Union by name of unlike frames, metadata columns in front."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*[c for c in first if c in out.columns], *[c for c in out.columns if c not in first])


def app_info(df: DataFrame, arrival: list[Column]) -> DataFrame:
    """The first row of each (app_id, platform)."""
    return first_per_key(df, ["app_id", "platform"], arrival).select("app_id", "platform", "app_name")


def clamp_rating(c: Column) -> Column:
    """1..5; what is no number counts as 1."""
    return F.greatest(F.lit(1), F.least(F.lit(5), F.coalesce(c.try_cast("int"), F.lit(1))))


def parse_time(c: Column, now: Column | None = None) -> Column:
    """P10: ISO text, `Z` or offset, naive means UTC; what does not parse becomes now."""
    return F.coalesce(c.cast("string").try_cast("timestamp"), F.current_timestamp() if now is None else now)


def uuid7(millis: Column, *seed: Column) -> Column:
    """A version-7 UUID of a time, its other bits from a hash of the seed (the same rows get the same ids)."""
    raw = F.concat(
        F.lpad(F.lower(F.hex(millis)), 12, "0"),
        F.lit("7"), F.substring(F.lpad(F.lower(F.hex(F.xxhash64(F.lit(1), *seed))), 16, "0"), 14, 3),
        F.element_at(F.array(*map(F.lit, "89ab")), (F.pmod(F.xxhash64(F.lit(2), *seed), F.lit(4)) + 1).cast("int")),
        F.substring(F.lpad(F.lower(F.hex(F.xxhash64(F.lit(3), *seed))), 16, "0"), 2, 15),
    )
    return F.regexp_replace(raw, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def valid_app_ids(df: DataFrame) -> DataFrame:
    """Rows whose app_id is a UUID."""
    return df.filter(F.col("app_id").rlike(UUID))


def load_projection(records: DataFrame, storage_path: Column, now: Column) -> tuple[DataFrame, DataFrame]:
    """(review_master_index rows, app_reviews rows) of new records with service_id."""
    hub = records.select(
        "review_id", "app_id", "service_id", "platform_review_id", "platform_type", F.col("reviewed_at").alias("review_created_at"), now.alias("ingested_at"),
        F.lit("RAW").alias("processing_status"), F.col("created_at").alias("parquet_written_at"), storage_path.alias("storage_path"),
        F.lit(None).cast("string").alias("error_message"), F.lit(0).alias("retry_count"), F.lit(True).alias("is_active"),
        F.coalesce("is_reply", F.lit(False)).alias("is_reply"),
    )
    reviews = records.select(
        "review_id", "app_id", "platform_type", "platform_review_id", "reviewer_name", "review_text", "rating", "reviewed_at", "created_at",
        F.coalesce("is_reply", F.lit(False)).alias("is_reply"), "reply_comment", F.lit(None).cast("string").alias("app_version"), F.lit("kr").alias("country_code"),
    )
    return hub, reviews


def count_validation(before: int, after: int) -> dict[str, int]:
    """P16."""
    return {"input_count": before, "output_count": after, "delta": after - before}
