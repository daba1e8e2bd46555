"""Review-domain views over the driver's tables: each derivation is one SQL text that Spark and DuckDB read alike.

`{ts}` is the engine's name of a timestamp without a zone; derivations use arithmetic only, no hashes and no randomness. Quotients
are mixed in, since plain remainders of doc_id go together with `source`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_Q = "cast(floor(doc_id / {k}) as bigint)"
_PLATFORM = f"case when {_Q.format(k=5)} % 2 = 0 then 'APPSTORE' else 'PLAYSTORE' end"
_TIME = f"{{ts}} '2024-01-01 00:00:00' + interval '1' day * cast((7 * doc_id + {_Q.format(k=20)}) % 30 as int) + interval '1' hour * cast(doc_id % 24 as int)"
_STATE = f"case {_Q.format(k=3)} % 10 when 0 then 'RAW' when 1 then 'CLEANED' when 2 then 'FAILED' else 'ANALYZED' end"
_RATING = f"cast(1 + (13 * doc_id + {_Q.format(k=7)}) % 5 as int)"

VIEWS = {
    "app_reviews": f"""select cast(doc_id as string) as review_id, source as app_id, {_PLATFORM} as platform_type,
        concat(source, '-', cast(doc_id as string)) as platform_review_id, concat('user', cast(doc_id % 97 as string)) as reviewer_name, text as review_text,
        {_RATING} as rating, {_TIME} as reviewed_at, {_TIME} + interval '1' day as created_at from documents""",
    "review_master_index": f"""select cast(doc_id as string) as review_id, source as app_id, case when doc_id % 17 = 0 then null else concat('svc-', source) end as service_id,
        concat(source, '-', cast(doc_id as string)) as platform_review_id, {_PLATFORM} as platform_type, {_TIME} as review_created_at,
        {_TIME} + interval '1' day as ingested_at, {_STATE} as processing_status,
        case when {_Q.format(k=3)} % 10 = 2 then case when doc_id % 2 = 0 then 'Cleanse failed: bad text' else 'no aspects' end end as error_message,
        cast({_Q.format(k=11)} % 5 as int) as retry_count from documents""",
    "review_action_analysis": """select cast(d.doc_id as string) as review_id, quality = 0 as is_action_required, toxic = 1 as is_attention_required,
        concat('summary ', cast(d.doc_id as string)) as review_summary from documents d left join labels l on l.doc_id = d.doc_id where d.source <> 'src7'""",
    "review_aspects": """select event_id as aspect_id, cast(event_id % 700 as string) as review_id, case when event_id % 13 = 0 then null else event_type end as keyword,
        round(((37 * event_id + cast(floor(event_id / 11) as bigint)) % 101) / 100, 4) as sentiment_score,
        case event_type when 'click' then 'USABILITY' when 'view' then 'STABILITY' when 'purchase' then 'DESIGN' when 'signup' then 'SPEED' when 'error' then 'CUSTOMER_SUPPORT' end as category
        from events""",
    "reviews_assigned": """select event_id as assigned_id, cast(event_id % 1000 as string) as review_id, {array}(event_type, concat('D', cast(user_id % 5 as string))) as assigned_dept,
        round((event_id % 100) / 100, 2) as confidence, ts as created_at from events where event_type in ('purchase', 'error')""",
    "reviews_preprocessed": """select cast(doc_id as string) as review_id, concat(source, '-', cast(doc_id as string)) as platform_review_id, trim(text) as refined_text
        from documents where lang <> 'es'""",
    "app_metadata": """select k + 1 as id, concat('src', cast(k as string)) as app_id, concat('svc-src', cast(k as string)) as service_id, date '2023-06-01' as valid_from,
        date '2024-01-15' as valid_to, k % 6 <> 0 as is_active from (select distinct cast(substr(source, 4) as int) as k from documents) s
        union all select k + 101 as id, concat('src', cast(k as string)) as app_id, concat('svc-src', cast(k as string)) as service_id,
        date '2024-01-16' as valid_from, cast(null as date) as valid_to, k % 7 <> 0 as is_active from (select distinct cast(substr(source, 4) as int) as k from documents) s""",
    "ingestion_batch": """select concat(event_type, '-', cast(day as string)) as batch_id, case when length(event_type) % 2 = 0 then 'APPSTORE' else 'PLAYSTORE' end as source_type,
        concat('/bronze/', event_type, '/', cast(day as string)) as storage_path, n as record_count,
        case (n + extract(day from day)) % 7 when 0 then 'PENDING' when 1 then 'FAILED' when 2 then 'DEAD_LETTER' else 'LOADED' end as status,
        cast(n % 4 as int) as retry_count, 3 as max_retries, first_at as created_at, last_at as updated_at
        from (select event_type, cast(ts as date) as day, count(*) as n, min(ts) as first_at, max(ts) as last_at from events group by event_type, cast(ts as date)) g""",
}
#: Driver tables that a view reads.
_TABLES = ("documents", "labels", "events", "embeddings")


def views(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named views (all by default) as DataFrames."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES}
    out = {}
    for name in names or VIEWS:
        text, used = VIEWS[name].format(ts="timestamp_ntz", array="array"), {}
        for t, df in tables.items():
            for lead in ("from ", "join "):
                if f"{lead}{t}" in text:
                    text = text.replace(f"{lead}{t}", f"{lead}{{{t}}}")
                    used[t] = df
        out[name] = spark.sql(text, **used)
    return out


def with_sql(*names: str) -> str:
    """The named views as the head of a DuckDB query."""
    return "with " + ",\n".join(f"{n} as ({VIEWS[n].format(ts='timestamp', array='list_value')})" for n in names)
