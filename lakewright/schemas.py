"""Tables of the data model: DDL, keys, enum domains with their declared order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLATFORMS = ("APPSTORE", "PLAYSTORE")
APP_TYPES = ("CONSUMER", "CORPORATE", "GLOBAL")
REVIEW_STATES = ("RAW", "CLEANED", "ANALYZED", "FAILED")
BATCH_STATES = ("PENDING", "LOADED", "FAILED", "RETRYING", "DEAD_LETTER")
#: Declared order; sorts of categories follow it.
CATEGORIES = ("USABILITY", "STABILITY", "DESIGN", "CUSTOMER_SUPPORT", "SPEED")
EMBEDDING_DIM = 1536

TABLES = {
    "app_service": "service_id string, service_name string",
    "apps": "app_id string, platform_app_id string, platform_type string, name string",
    "app_metadata": "id int, app_id string, service_id string, group_id string, group_type string, app_type string, valid_from date, valid_to date, is_active boolean",
    "review_master_index": (
        "review_id string, app_id string, service_id string, platform_review_id string, platform_type string, review_created_at timestamp, "
        "ingested_at timestamp, processing_status string, parquet_written_at timestamp, storage_path string, error_message string, retry_count int, "
        "is_active boolean, is_reply boolean"
    ),
    "ingestion_batch": (
        "batch_id string, source_type string, platform_app_id string, app_name string, storage_path string, file_format string, record_count int, "
        "content_hash string, status string, retry_count int, max_retries int, error_message string, created_at timestamp, updated_at timestamp, loaded_at timestamp"
    ),
    "app_reviews": (
        "review_id string, app_id string, platform_type string, platform_review_id string, reviewer_name string, review_text string, rating int, "
        "reviewed_at timestamp, created_at timestamp, is_reply boolean, reply_comment string, app_version string, country_code string"
    ),
    "reviews_preprocessed": "review_id string, platform_review_id string, refined_text string, created_at timestamp, updated_at timestamp",
    "review_embeddings": "review_id string, source_content_type string, model_name string, vector array<float>, created_at timestamp",
    "review_aspects": "aspect_id bigint, review_id string, keyword string, sentiment_score double, category string, created_at timestamp",
    "review_action_analysis": (
        "review_id string, is_action_required boolean, action_confidence_score double, trigger_reason string, is_attention_required boolean, "
        "is_verified boolean, analyzed_at timestamp, review_summary string"
    ),
    "reviews_assigned": (
        "assigned_id bigint, review_id string, assigned_dept array<string>, assignment_reason string, confidence double, is_failed boolean, try_number int, created_at timestamp"
    ),
    "organizations": "org_id string, org_name string, parent_org_id string, keywords array<string>, description string",
    "profanities": "id bigint, word string, category string, is_active boolean",
    "synonyms": "id bigint, word string, canonical string, is_active boolean",
    "financial_terms": "id bigint, term string, description string",
    "review_llm_analysis_logs": "id bigint, review_id string, model_name string, result_payload string, status string, error_message string, created_at timestamp",
    "fact_service_review_daily": (
        "date date, service_id string, platform_type string, total_review_cnt int, action_required_cnt int, attention_required_cnt int, pos_count int, "
        "neg_count int, avg_rating double, action_ratio double"
    ),
    "fact_service_aspect_daily": "date date, service_id string, keyword string, mention_cnt int, avg_sentiment_score double",
    "fact_category_radar_scores": "date date, service_id string, category_type string, avg_sentiment_score double, review_cnt int",
    "srv_daily_review_list": (
        "review_id string, date date, service_id string, refined_text string, review_summary string, rating int, reviewed_at timestamp, sentiment_score double, "
        "is_action_required boolean, is_attention_required boolean, assigned_dept array<string>, keyword array<string>, confidence double"
    ),
    "srv_keyword_postings": "keyword string, service_id string, date date, reviewed_at timestamp, review_id string",
}

KEYS = {
    "fact_service_review_daily": ("date", "service_id", "platform_type"),
    "fact_service_aspect_daily": ("date", "service_id", "keyword"),
    "fact_category_radar_scores": ("date", "service_id", "category_type"),
    "srv_daily_review_list": ("review_id", "date"),
    "srv_keyword_postings": ("keyword", "review_id", "date"),
    "review_master_index": ("review_id",),
    "ingestion_batch": ("batch_id",),
    "reviews_preprocessed": ("platform_review_id",),
    "app_service": ("service_id",),
    "apps": ("app_id",),
    "app_metadata": ("app_id", "valid_from"),
    "review_action_analysis": ("review_id",),
    "review_embeddings": ("review_id",),
}
#: Tables with a folder for each day, and the column of the day.
DAYS = {
    "review_master_index": "review_created_at", "fact_service_review_daily": "date", "fact_service_aspect_daily": "date", "fact_category_radar_scores": "date",
    "srv_daily_review_list": "date", "srv_keyword_postings": "date",
}
HUB = "review_master_index"
#: Rows of the files that batches deliver.
BRONZE = (
    "review_id string, app_id string, platform_type string, platform_review_id string, reviewer_name string, review_text string, rating int, "
    "reviewed_at timestamp, created_at timestamp, is_reply boolean, reply_comment string"
)
#: What tells a review of a store from all others.
NATURAL = ("app_id", "platform_type", "platform_review_id")
#: Tables in a fixed number of parts, and the column whose hash tells a row's part.
HASHED = {
    "app_reviews": "review_id", "reviews_preprocessed": "platform_review_id", "review_embeddings": "review_id", "review_aspects": "review_id",
    "review_action_analysis": "review_id", "srv_keyword_postings": "keyword",
}
#: The serving list's keywords, by day and by a hash of the keyword.
POSTINGS = "srv_keyword_postings"
MARTS = ("fact_service_review_daily", "fact_service_aspect_daily", "fact_category_radar_scores", "srv_daily_review_list")


def ordinal(column: Column, domain: tuple[str, ...] = CATEGORIES) -> Column:
    """Place in the declared order (null for values outside)."""
    return F.array_position(F.array(*map(F.lit, domain)), column)
