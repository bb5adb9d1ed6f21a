"""Table contracts of the vintage store."""

from __future__ import annotations

from pyspark.sql import types as T

OBSERVATION_VINTAGE = T.StructType([
    T.StructField("country", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("canonical_series_id", T.StringType(), False),
    T.StructField("source_series_id", T.StringType(), False),
    T.StructField("series_name", T.StringType(), False),
    T.StructField("frequency", T.StringType(), False),
    T.StructField("unit", T.StringType(), False),
    T.StructField("seasonal_adjustment", T.StringType(), True),
    T.StructField("period", T.StringType(), False),
    T.StructField("period_start", T.DateType(), False),
    T.StructField("period_end", T.DateType(), False),
    T.StructField("value", T.DoubleType(), False),
    T.StructField("release_at", T.TimestampType(), True),
    T.StructField("release_date_source", T.StringType(), True),
    T.StructField("first_seen_at", T.TimestampType(), False),
    T.StructField("available_at", T.TimestampType(), False),
    T.StructField("vintage_no", T.IntegerType(), False),
    T.StructField("revision_type", T.StringType(), False),
    T.StructField("revision_delta", T.DoubleType(), True),
    T.StructField("pit_grade", T.StringType(), False),
    T.StructField("source_url", T.StringType(), False),
    T.StructField("raw_file", T.StringType(), False),
    T.StructField("raw_sha256", T.StringType(), False),
    T.StructField("retrieved_at", T.TimestampType(), False),
    T.StructField("parser_version", T.StringType(), False),
])
OBSERVATION_COLUMNS = OBSERVATION_VINTAGE.fieldNames()

# Columns a delivery must fill; the engine itself assigns vintage_no, revision_type, revision_delta.
REQUIRED_COLUMNS = [
    f.name for f in OBSERVATION_VINTAGE
    if not f.nullable and f.name not in ("vintage_no", "revision_type")
]
INSTANT_COLUMNS = ["release_at", "first_seen_at", "available_at", "retrieved_at"]

CRAWL_LOG = T.StructType([
    T.StructField("crawl_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("requested_at", T.TimestampType(), False),
    T.StructField("completed_at", T.TimestampType(), False),
    T.StructField("http_status", T.IntegerType(), True),
    T.StructField("success", T.BooleanType(), False),
    T.StructField("from_cache", T.BooleanType(), False),
    T.StructField("content_type", T.StringType(), True),
    T.StructField("response_bytes", T.LongType(), True),
    T.StructField("raw_file", T.StringType(), True),
    T.StructField("raw_sha256", T.StringType(), True),
    T.StructField("parser_version", T.StringType(), True),
    T.StructField("error_type", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("runtime_seconds", T.DoubleType(), False),
])

VALIDATION_RESULT = T.StructType([
    T.StructField("validation_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("test_name", T.StringType(), False),
    T.StructField("sample_size", T.IntegerType(), False),
    T.StructField("matches", T.IntegerType(), False),
    T.StructField("match_rate", T.DoubleType(), False),
    T.StructField("raw_sha256", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("detail", T.StringType(), True),
])

AVAILABILITY_SIDECAR = T.StructType([
    T.StructField("canonical_series_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("period", T.StringType(), False),
    T.StructField("period_end", T.DateType(), False),
    T.StructField("value", T.DoubleType(), False),
    T.StructField("estimated_available_at", T.TimestampType(), False),
])

AVAILABILITY_RULES = T.StructType([
    T.StructField("canonical_series_id", T.StringType(), False),
    T.StructField("frequency", T.StringType(), True),
    T.StructField("lag_days", T.IntegerType(), False),
    T.StructField("available_same_day", T.BooleanType(), False),
    T.StructField("confidence", T.StringType(), True),
    T.StructField("eligible", T.BooleanType(), False),
])

AVAILABILITY_OVERRIDES = T.StructType([
    T.StructField("canonical_series_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("period", T.StringType(), False),
    T.StructField("value", T.DoubleType(), False),
    T.StructField("available_at", T.StringType(), False),
])
