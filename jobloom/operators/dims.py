"""Company, location, skill and calendar dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions.location import looks_remote, map_city
from jobloom.functions.text import date_key, fold, key_date, not_blank, slug
from jobloom.operators.positions import dense_key

# First and last day that the calendar has at least.
CALENDAR_START = "2024-01-01"
CALENDAR_END = "2027-12-31"
#: Years of which a calendar is without gaps.
CALENDAR_YEARS = (1970, 2100)


def build_dim_companies(deduped: DataFrame) -> DataFrame:
    """One row per lower-cased, trimmed company name."""
    grouped = (
        deduped.where(not_blank(F.col("company")))
        .groupBy(fold(F.col("company")).alias("company_lower"))
        .agg(
            F.max(F.trim("company")).alias("company_name"),
            F.min(F.to_date("scraped_at")).alias("first_seen_at"),
            F.max(F.to_date("scraped_at")).alias("last_seen_at"),
            F.count("*").alias("total_postings"),
        )
    )
    return dense_key(grouped, ["company_lower"], "company_key").select(
        "company_key",
        "company_name",
        "company_lower",
        slug(F.col("company_name")).alias("company_slug"),
        "first_seen_at",
        "last_seen_at",
        "total_postings",
    )


def location_counts(deduped: DataFrame) -> DataFrame:
    """Distinct raw places with their number of postings (the count is free once they are grouped)."""
    return deduped.where(not_blank(F.col("location_raw"))).groupBy("location_raw").agg(F.count("*").alias("postings"))


def build_dim_locations(deduped: DataFrame, regions: DataFrame, keep_counts: bool = False) -> DataFrame:
    """One row per raw place: canonical city, its region, remote and capital-region flags.

    keep_counts adds the number of postings, used to find hot keys when the fact is built.
    """
    mapped = dense_key(location_counts(deduped), ["location_raw"], "location_key").select(
        "*",
        map_city(F.col("location_raw")).alias("city"),
        looks_remote(F.col("location_raw")).alias("is_remote"),
    )
    known = regions.select(F.lower("city").alias("_city"), "province", "region", "is_ncr")
    joined = mapped.join(known, F.lower(mapped.city) == known._city, "left")
    columns = [
        F.col("location_key"),
        F.col("location_raw"),
        F.col("city"),
        F.col("province"),
        F.col("region"),
        F.col("is_remote"),
        F.coalesce("is_ncr", F.lit(False)).alias("is_metro_manila"),
    ]
    return joined.select(*columns, *([F.col("postings")] if keep_counts else []))


def build_dim_skills(dictionary: DataFrame) -> DataFrame:
    """One row per canonical name; the dictionary is a seed, so one small window numbers it."""
    grouped = dictionary.groupBy(F.col("canonical_name").alias("skill_name")).agg(F.max("category").alias("skill_category"))
    return dense_key(grouped, ["skill_name"], "skill_key", bounded=True)


def _posted(postings: DataFrame) -> DataFrame:
    return postings.select(key_date(F.col("date_posted_key")).alias("full_date")).where("full_date is not null")


def calendar_span(postings: DataFrame) -> tuple[str, str]:
    """First and last day of a calendar that covers all posted days of the years CALENDAR_YEARS, as dates; two values reach
    the driver. One posting with an impossible year does not make a calendar of millions of days: see `stray_days`."""
    near = _posted(postings).where(F.year("full_date").between(*CALENDAR_YEARS))
    first, last = near.agg(F.min("full_date").cast("string"), F.max("full_date").cast("string")).first()
    return min([CALENDAR_START, *([first] if first else [])]), max([CALENDAR_END, *([last] if last else [])])


def stray_days(postings: DataFrame) -> DataFrame:
    """(full_date): posted days outside of CALENDAR_YEARS, which the calendar has one by one and a check reports."""
    return _posted(postings).where(~F.year("full_date").between(*CALENDAR_YEARS)).distinct()


def build_dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END, more: DataFrame | None = None) -> DataFrame:
    """One row per day from `start` to `end`, and per day of `more` (full_date) outside of these, with the extra columns the
    readers of the calendar expect."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date"))
    if more is not None:
        days = days.unionByName(more.where(~F.col("full_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))))
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    return days.select(
        date_key(day).alias("date_key"),
        day,
        weekday.cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.year(day).cast("smallint").alias("year"),
        weekday.isin(6, 7).alias("is_weekend"),
        F.dayofmonth(day).cast("smallint").alias("day"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
    )
