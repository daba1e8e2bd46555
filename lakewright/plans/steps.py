"""Steps over a catalog (R01-R08): load, cleanse, gold, aggregate, validate. Thin drivers around set-wise plans."""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions import actions, aspects, text, vectors
from lakewright.operators import joins, load, predicates, projections, state, upsert
from lakewright.plans import checks, marts, serving
from lakewright.schemas import HASHED, HUB, KEYS, MARTS, POSTINGS
from lakewright.sources.catalog import Catalog, Conflict
from lakewright.sources.files import delete, put_new

STEPS = ("load", "cleanse", "gold", "aggregate", "validate")


@dataclass
class RunResult:
    step: str
    status: str
    input_count: int = 0
    output_count: int = 0
    output_path: str | None = None
    validations: list = field(default_factory=list)
    message: str | None = None


def run_load(catalog: Catalog, now: dt.datetime, limit: int = 100) -> RunResult:
    """All pending batches in one job, which reads the hub's keys once; each batch succeeds or fails by itself and failures
    count retries. A failure that no row tells of, such as a file that cannot be read, is found by halving."""
    ledger = catalog.read("ingestion_batch")
    batches = load.pending_batches(ledger, limit).collect()
    if not batches:
        return RunResult("load", "success")
    # the mark of a load that died: some of its reviews may be there without their hub rows
    mark = f"{catalog.base}/_loading"
    found = _Load(catalog, now, careful=not put_new(catalog.spark, mark, b""))
    found.load(batches)
    names = [b["batch_id"] for b in batches]
    rows = state.mark_batches_loaded(ledger.filter(F.col("batch_id").isin(names)), catalog.spark.createDataFrame([(b,) for b in names if b not in found.failed], "batch_id string"), now)
    rows = state.mark_batches_failed(rows, catalog.spark.createDataFrame([(b, m[: state.MESSAGE]) for b, m in found.failed.items()], "batch_id string, message string"))
    with catalog.staged(rows) as marked:
        catalog.upsert("ingestion_batch", marked)
    delete(catalog.spark, mark)
    told = "; ".join(found.failed[b] for b in names if b in found.failed)
    return RunResult("load", "failed" if len(found.failed) == len(batches) else "success", len(batches), found.rows, f"{catalog.path(HUB)}" if found.rows else None, message=told or None)


class _Load:
    """What run_load has loaded, and the batches that failed."""

    def __init__(self, catalog: Catalog, now: dt.datetime, careful: bool) -> None:
        self.catalog, self.now, self.careful, self.rows, self.failed = catalog, now, careful, 0, {}

    def load(self, batches: list) -> None:
        for _ in range(Catalog.TRIES):
            try:
                return self._together(batches)
            except Conflict:  # another load was first: its reviews are known now
                self.careful = True
            except Exception as e:  # noqa: BLE001  a batch fails by itself
                self.careful = True
                if len(batches) == 1:
                    self.failed[batches[0]["batch_id"]] = str(e)
                    return None
                self.load(batches[: len(batches) // 2])
                return self.load(batches[len(batches) // 2 :])
        self.failed |= {b["batch_id"]: "other loads were first" for b in batches}

    def _together(self, batches: list) -> None:
        catalog = self.catalog
        records, failed = load.batch_records(catalog.spark, batches)
        apps, reviews = catalog.read("apps"), catalog.read("app_reviews")
        failed |= {r["batch_id"]: r["message"] for r in load.failing(records, apps).collect()}
        good = records.filter(~F.col("batch_id").isin(list(failed))) if failed else records
        known, buckets = catalog.known_keys()
        with catalog.staged(load.place_records(good, known, buckets, catalog.read("app_metadata"))) as placed:
            hub, texts = projections.load_projection(placed, F.col("storage_path"), F.lit(self.now).cast("timestamp"))
            if self.careful:
                texts = texts.join(reviews.select("review_id"), "review_id", "left_anti")
            catalog.append("apps", load.new_apps(good, apps))
            # the hub comes last and decides what is new: a load that died before it finds its reviews there already
            catalog.append("app_reviews", texts, unless_changed=True)
            self.rows += catalog.append(HUB, hub, unless_changed=True)
        self.failed |= failed


def run_cleanse(catalog: Catalog, now: dt.datetime, synonyms: dict[str, str] | None = None, profanity=None) -> RunResult:
    """Raw reviews (or failed in cleansing before) to refined texts; blank ones are skipped. M06: a review whose natural
    key belongs to another one fails by itself. Only the hub's open folders and the parts of these reviews are read and written."""
    open_ = (F.col("processing_status") == "RAW") | predicates.cleanse_failure(F.col("processing_status"), F.col("error_message"))
    day = F.to_date("review_created_at").alias("day")
    with ExitStack() as work:
        hold = lambda df: work.enter_context(catalog.staged(df))
        ids = hold(catalog.read(HUB, open=True).filter(open_).select("review_id", "platform_review_id", day))
        texts = catalog.read("app_reviews", parts=catalog.parts_of("app_reviews", ids)).select("review_id", "review_text")
        todo = ids.join(texts, "review_id").withColumn("blank", text.is_blank(F.col("review_text")))
        todo = hold(todo.withColumn("refined_text", F.when(~F.col("blank"), text.clean(F.col("review_text"), synonyms, profanity))).drop("review_text"))
        some = todo.filter("not blank").select("review_id", "platform_review_id", "refined_text")
        parts, seen, n = catalog.parts_of("reviews_preprocessed", some), todo.count(), some.count()
        stored = catalog.read("reviews_preprocessed", parts=parts)
        lost = joins.key_conflicts(some.select("review_id", "platform_review_id"), stored).distinct()
        failures = hold(some.join(lost, "platform_review_id").select("review_id", F.concat(F.lit("another review has the key "), "platform_review_id").alias("message")))
        bad, good = failures.count(), some.join(failures, "review_id", "left_anti")
        catalog.replace_parts("reviews_preprocessed", upsert.upsert_preprocessed(stored, good, now), parts)
        days = [r[0] for r in todo.select("day").distinct().collect()]
        hub = catalog.read(HUB, days, open=True)
        if bad:
            hub = state.mark_cleanse_failed(hub, failures)
        catalog.replace_open(state.mark_cleaned(hub, good), days)
    where = catalog.path("reviews_preprocessed") if n > bad else None
    return RunResult("cleanse", "failed" if bad and bad == n else "success", seen, n - bad, where, message=f"{bad} reviews failed" if bad else None)


def run_gold(
    catalog: Catalog, now: dt.datetime, embedder=None, summarizer=None, nouns=None, limit: int | None = None, day: dt.date | None = None,
    anchors: dict[str, list[float]] | None = None, model: str = "gpt-4o-mini", **lexicon,
) -> RunResult:
    """Embed, aspects, actions, set-wise. A review goes on only from a stage that gave it a row; its rows of the
    stages before stay. What lacks one in the end is FAILED with the stage's name, else ANALYZED.

    summarizer: Column -> Column (remote.column() retries); each call leaves a row in the log, SUCCESS or FAILED.
    """
    master = catalog.read(HUB, [day] if day else None, open=True)
    todo = joins.pending_gold(master).select("review_id", "platform_review_id", F.to_date("review_created_at").alias("day"))
    todo = todo if limit is None else todo.orderBy("review_id").limit(limit)
    with catalog.staged(todo) as ids:
        return _gold(catalog, ids, now, embedder, summarizer, nouns, anchors, model, **lexicon)


def _gold(catalog: Catalog, ids: DataFrame, now: dt.datetime, embedder, summarizer, nouns, anchors, model: str, **lexicon) -> RunResult:
    total = ids.count()
    if not total:
        return RunResult("gold", "success")
    parts, told = {}, {}
    for n in (n for n in HASHED if HASHED[n] in ids.columns):
        way = HASHED[n], catalog.state(n)["parts"]
        parts[n] = told[way] = told[way] if way in told else catalog.parts_of(n, ids)
    own = lambda n: catalog.read(n, parts=parts[n])
    refined = ids.join(own("reviews_preprocessed").select("review_id", "refined_text"), "review_id").drop("day")
    if embedder is not None:
        fresh = refined.join(own("review_embeddings").select("review_id"), "review_id", "left_anti")
        catalog.append("review_embeddings", vectors.embed(fresh, embedder).withColumn("created_at", F.lit(now)))
        refined = refined.join(own("review_embeddings").select("review_id"), "review_id", "left_semi")
    fresh = refined.join(own("review_aspects").select("review_id"), "review_id", "left_anti")
    found = aspects.analyze(fresh, nouns=nouns, embeddings=own("review_embeddings"), anchors=anchors, **lexicon)
    found = found.withColumns({"aspect_id": F.xxhash64("review_id", "keyword"), "created_at": F.lit(now)})
    catalog.append("review_aspects", found)
    with_aspects = refined.select("review_id", "platform_review_id").join(own("review_aspects").select("review_id"), "review_id", "left_semi")
    fresh = with_aspects.join(own("review_action_analysis").select("review_id"), "review_id", "left_anti")
    records = actions.analyze(fresh, own("reviews_preprocessed"), own("app_reviews"), own("review_aspects"), summarizer=summarizer)
    catalog.append("review_action_analysis", records.withColumn("analyzed_at", F.lit(now)))
    written = own("review_action_analysis").join(ids.select("review_id"), "review_id", "left_semi")
    if summarizer is not None:
        catalog.append("review_llm_analysis_logs", actions.summary_log(written.filter(F.col("analyzed_at") == F.lit(now)), model, now))
    outcome = ids.select("review_id")
    for name, table in (("v", "review_embeddings"), ("s", "review_aspects"), ("a", "review_action_analysis")):
        known = own(table).join(ids.select("review_id"), "review_id", "left_semi").select("review_id").distinct()
        outcome = outcome.join(known.withColumn(name, F.lit(True)), "review_id", "left")
    missing = F.when(F.lit(embedder is not None) & F.col("v").isNull(), "no embedding").when(F.col("s").isNull(), "no aspects").when(F.col("a").isNull(), "no action record")
    days = [r[0] for r in ids.select("day").distinct().collect()]
    with catalog.staged(outcome.select("review_id", missing.isNull().alias("ok"), missing.alias("message"))) as told:
        good = told.filter("ok").count()
        catalog.replace_open(state.mark_analyzed(catalog.read(HUB, days, open=True), told), days)
    where = catalog.path("review_action_analysis") if good else None
    return RunResult("gold", "success" if good else "failed", total, good, where, message=None if good else "no review was analysed")


def _closed_folders(catalog: Catalog) -> dict[str, list[str]]:
    """day -> the hub's closed folders."""
    out: dict[str, list[str]] = {}
    for e in catalog.state(HUB)["entries"]:
        if e["open"] == "0" and e["day"] != "none":
            out.setdefault(e["day"], []).append(e["folder"])
    return {d: sorted(x) for d, x in out.items()}


def changed_days(catalog: Catalog) -> list[dt.date]:
    """ST04: the days whose analysed reviews are not those that were aggregated last: what two states of the hub differ in,
    without reading a row."""
    now, before = _closed_folders(catalog), catalog.noted("aggregated", {})
    return sorted(dt.date.fromisoformat(d) for d in now if now[d] != before.get(d))


def aggregate_days(
    catalog: Catalog, first: dt.date | None, last: dt.date | None, as_of: dt.date, retention_days: int = 14, mode: str = "upsert", only: list[dt.date] | None = None,
) -> dict[str, int]:
    """All days of the range (or those of `only` in it) in one job for each mart, whose files of other days stay; then the serving
    list's retention. Returns the rows of the days."""
    told = _closed_folders(catalog)
    names = ("review_action_analysis", "app_reviews", "review_aspects", "reviews_preprocessed", "reviews_assigned")
    views = {n: catalog.read(n) for n in names} | {HUB: catalog.read(HUB, open=False)}  # what is analysed is closed
    if only is not None:
        views[HUB] = catalog.read(HUB, only, open=False)
    days = [r["date"] for r in marts.analyzed_dates(views, first, last).collect()]
    done = {str(d): told[str(d)] for d in {*days, *(only or ())} if str(d) in told}
    if not days:
        catalog.note("aggregated", catalog.noted("aggregated", {}) | done)
        return {}
    kept, out = as_of - dt.timedelta(days=retention_days), {}
    with ExitStack() as work:
        hold = lambda df: work.enter_context(catalog.staged(df))
        views[marts.JOINED] = hold(marts.joined(views, first, last))
        for name in MARTS:
            listed = name == "srv_daily_review_list"
            # what the retention would drop at once is not made
            some = [d for d in days if not listed or d is None or d >= kept]
            seen, old = views | {HUB: catalog.read(HUB, some, open=False)}, catalog.read(name, some)
            there = catalog.holds(name, some)
            if listed:
                seen[marts.JOINED] = rows = views[marts.JOINED].filter(F.col("date").isNull() | (F.col("date") >= F.lit(kept)))
                # an upsert keeps the texts that the list has: only those of other reviews are read
                fresh = hold(rows.join(old, list(KEYS[name]), "left_anti").select("review_id")) if there and mode != "replace" else rows.select("review_id")
                seen["reviews_preprocessed"] = views["reviews_preprocessed"].join(fresh, "review_id", "left_semi")
            new = marts.BUILDERS[name](seen, first, last)
            if not there:
                merged = new
            elif mode == "replace":
                merged = upsert.replace_days(old, new)
            elif listed:
                merged = upsert.partial_upsert(old, new, KEYS[name])
            else:
                merged = upsert.upsert(old, new, KEYS[name])
            catalog.replace_days(name, merged, some)
            if listed:
                # keywords follow the list as it stands now; a run that died between the two is made again
                catalog.replace_days(POSTINGS, serving.postings(catalog.read(name, some)), some)
                for n in (name, POSTINGS):
                    catalog.drop_days_before(n, kept)
            out[name] = catalog.read(name, days).count()
    catalog.note("aggregated", catalog.noted("aggregated", {}) | done)
    return out


def aggregate_range(catalog: Catalog, first: dt.date, last: dt.date, as_of: dt.date, retention_days: int = 14, one: Callable = aggregate_days) -> dict:
    """Each day by itself; failures are gathered and raised at the end."""
    if first > last:
        raise ValueError("the range is reversed")
    views = {HUB: catalog.read(HUB, open=False)}
    done, failed = [], {}
    for row in marts.analyzed_dates(views, first, last).collect():
        try:
            one(catalog, row["date"], row["date"], as_of, retention_days)
            done.append(row["date"].isoformat())
        except Exception as e:  # noqa: BLE001  a day fails by itself
            failed[row["date"].isoformat()] = str(e)
    if failed:
        raise RuntimeError(f"days failed: {failed}; done: {done}")
    return {"done": done}


def run_aggregate(catalog: Catalog, as_of: dt.date, target_date: str | None = None, start_date: str | None = None, end_date: str | None = None) -> RunResult:
    """The named day, or a range with both ends; where none is named, the day of as_of and all days that late reviews have
    changed since they were aggregated. Malformed arguments give a failed result."""
    try:
        if target_date and (start_date or end_date) or bool(start_date) != bool(end_date):
            raise ValueError("give target_date, or both start_date and end_date")
        if start_date:
            got = aggregate_range(catalog, dt.date.fromisoformat(start_date), dt.date.fromisoformat(end_date), as_of)
            result = RunResult("aggregate", "success", len(got["done"]), len(got["done"]))
        else:
            day = dt.date.fromisoformat(target_date) if target_date else as_of
            late = [] if target_date else [d for d in changed_days(catalog) if d != day]
            days = sorted({day, *late})
            got = aggregate_days(catalog, days[0], days[-1], as_of, only=None if target_date else days)
            result = RunResult("aggregate", "success", 1, sum(catalog.read(n, [day]).count() if late else got[n] for n in got))
            if late:
                result.message = f"changed days: {', '.join(map(str, late))}"
        result.output_path = catalog.path(MARTS[0])
        return result
    except Exception as e:  # noqa: BLE001  reported as a result
        return RunResult("aggregate", "failed", message=str(e))


def aggregate_all(catalog: Catalog, as_of: dt.date, retention_days: int = 14) -> dict[str, int]:
    """R05."""
    return aggregate_days(catalog, None, None, as_of, retention_days)


def run_validate(catalog: Catalog, day: dt.date) -> RunResult:
    names = ("ingestion_batch", "review_master_index", "app_metadata", "review_action_analysis", "app_reviews", "reviews_preprocessed", "review_aspects", *MARTS)
    report = checks.validate({n: catalog.read(n) for n in names}, day)
    return RunResult("validate", report.status, validations=[asdict(c) for c in report.checks], message=", ".join(report.warnings) or None)


def run_steps(catalog: Catalog, steps: list[str], now: dt.datetime, target_date: str | None = None, start_date: str | None = None, end_date: str | None = None) -> list[RunResult]:
    """In order, until one fails; an unknown step fails."""
    day = dt.date.fromisoformat(target_date) if target_date else now.date()
    known: dict[str, Callable[[], RunResult]] = {
        "load": lambda: run_load(catalog, now),
        "cleanse": lambda: run_cleanse(catalog, now),
        "gold": lambda: run_gold(catalog, now, vectors.hashing_embedder()),
        "aggregate": lambda: run_aggregate(catalog, now.date(), target_date, start_date, end_date),
        "validate": lambda: run_validate(catalog, day),
    }
    out = []
    for step in steps:
        try:
            result = known[step]() if step in known else RunResult(step, "failed", message="unknown step")
        except Exception as e:  # noqa: BLE001  reported as a result
            result = RunResult(step, "failed", message=str(e))
        out.append(result)
        if result.status == "failed":
            break
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit code 0 when every step succeeds."""
    ask = argparse.ArgumentParser(prog="lakewright")
    ask.add_argument("--catalog", required=True)
    ask.add_argument("--steps", default=",".join(STEPS))
    for name in ("--target-date", "--start-date", "--end-date"):
        ask.add_argument(name, type=lambda x: dt.date.fromisoformat(x).isoformat())
    args = ask.parse_args(argv)
    if spark is None:
        from lakewright.session import session

        spark = session()
    results = run_steps(
        Catalog(spark, args.catalog), [s for s in args.steps.split(",") if s], dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
        args.target_date, args.start_date, args.end_date,
    )
    for r in results:
        print(json.dumps(asdict(r), default=str))
    return int(any(r.status == "failed" for r in results))


if __name__ == "__main__":
    raise SystemExit(main())
