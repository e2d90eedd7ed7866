"""Explicit schemas. Column order is part of the contract."""

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("raw_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("raw_data", T.StringType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("records_scraped", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

SKILL_TERMS = T.StructType(
    [
        T.StructField("pattern", T.StringType()),
        T.StructField("canonical_name", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

REGIONS = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("is_ncr", T.BooleanType()),
    ]
)

CANONICAL = T.StructType(
    [
        T.StructField("raw_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("title", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("location_raw", T.StringType()),
        T.StructField("salary_raw", T.StringType()),
        T.StructField("salary_currency", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("posted_date", T.DateType()),
        T.StructField("description", T.StringType()),
        T.StructField("employment_type", T.StringType()),
        T.StructField("experience_level", T.StringType()),
        T.StructField("is_remote", T.BooleanType()),
        T.StructField("skills_json", T.StringType()),
    ]
)
