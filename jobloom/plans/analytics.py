"""The dashboard's questions, each one function from marts to a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.display import source_label
from jobloom.functions.text import key_date
from jobloom.functions.salary import salary_bucket
from jobloom.operators.search import skill_demand_list

MIN_JOBS_PER_CITY = 5
CITIES_ON_CHART = 12
TRENDING_SKILLS = 10
TOP_SKILLS = 20


def _mean(column: str) -> Column:
    return F.avg(F.col(column).cast("double"))


def _peso_monthly() -> Column:
    return F.col("salary_min").isNotNull() & (F.col("salary_currency") == "PHP") & (F.col("salary_period") == "monthly")


def _salary_means(*keys: str):
    def run(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(
            _mean("salary_min").alias("avg_salary_min"),
            _mean("salary_max").alias("avg_salary_max"),
            F.count("job_key").alias("job_count"),
        )

    return run


def dashboard_summary(postings: DataFrame) -> DataFrame:
    """All headline numbers from one pass; means are rounded half to even, nothing to average gives 0."""
    usable = _peso_monthly()

    def mean(column: str, name: str) -> Column:
        value = F.avg(F.when(usable, F.col(column).cast("double")))
        return F.bround(F.coalesce(value, F.lit(0.0)), 0).cast("bigint").alias(name)

    return postings.agg(
        F.count("*").alias("total_jobs"),
        F.count("salary_min").alias("jobs_with_salary"),
        F.count_if("is_remote").alias("remote_jobs"),
        F.count_distinct("source").alias("active_sources"),
        mean("salary_min", "avg_salary_min_php"),
        mean("salary_max", "avg_salary_max_php"),
    )


def salary_by_city(postings: DataFrame, locations: DataFrame, min_jobs: int = MIN_JOBS_PER_CITY) -> DataFrame:
    """Mean peso monthly salary per city, cities with enough postings, best paid first.

    Postings are first summed up per location key, so the join only sees one row per place.
    """
    per_place = postings.where(_peso_monthly() & F.col("location_key").isNotNull()).groupBy("location_key").agg(
        F.sum(F.col("salary_min").cast("double")).alias("_low"),
        F.sum(F.col("salary_max").cast("double")).alias("_high"),
        F.count("salary_max").alias("_highs"),
        F.count("*").alias("_jobs"),
    )
    places = locations.where(F.col("city").isNotNull()).select("location_key", "city", "region")
    merged = per_place.join(places, "location_key").groupBy("city", "region").agg(
        (F.sum("_low") / F.sum("_jobs")).alias("avg_salary_min"),
        F.try_divide(F.sum("_high"), F.sum("_highs")).alias("avg_salary_max"),
        F.sum("_jobs").alias("job_count"),
    )
    return merged.where(F.col("job_count") >= min_jobs).orderBy(F.desc_nulls_first("avg_salary_min"), "city", "region")


def salary_by_city_chart(postings: DataFrame, locations: DataFrame, cities: int = CITIES_ON_CHART) -> DataFrame:
    return salary_by_city(postings, locations).limit(cities)


def salary_by_experience(postings: DataFrame) -> DataFrame:
    """Peso salaries of any period, as the original has it."""
    rows = postings.where(
        F.col("salary_min").isNotNull() & F.col("experience_level").isNotNull() & (F.col("salary_currency") == "PHP")
    )
    return _salary_means("experience_level")(rows).orderBy(F.asc_nulls_last("avg_salary_min"), "experience_level")


def salary_by_source(postings: DataFrame) -> DataFrame:
    means = _salary_means("source")(postings.where(_peso_monthly()))
    return means.withColumn("label", source_label(F.col("source"))).orderBy(F.desc_nulls_first("avg_salary_min"), "source")


def jobs_by_source(postings: DataFrame) -> DataFrame:
    counts = postings.groupBy("source").agg(F.count("job_key").alias("count"))
    return counts.withColumn("label", source_label(F.col("source"))).orderBy(F.desc("count"), "source")


def remote_vs_onsite(postings: DataFrame) -> DataFrame:
    counts = postings.agg(F.count_if("is_remote").alias("remote"), F.count("*").alias("total"))
    share = F.when(F.col("total") > 0, F.bround(F.col("remote") / F.col("total") * 100, 1)).otherwise(0.0)
    return counts.select("remote", (F.col("total") - F.col("remote")).alias("onsite"), "total", share.alias("remote_percentage"))


def skill_trends(
    demand: DataFrame, skills: DataFrame, skill: str | None = None, limit: int = TRENDING_SKILLS, mode: str = "reference"
) -> DataFrame:
    """Demand rows per day, of skills whose name contains `skill`, or of the most demanded ones.

    mode "reference" takes the first `limit` distinct (name, count) pairs by count, which may be fewer names;
    "names" takes `limit` names by their best count.
    """
    rows = demand.join(skills.select("skill_key", "skill_name"), "skill_key")
    shown = rows.select("snapshot_date", "skill_name", "posting_count", "avg_salary_min", "avg_salary_max")
    if skill:
        picked = shown.where(F.upper("skill_name").contains(skill.upper()))
    else:
        by_count = [F.desc("posting_count"), F.asc("skill_name")]
        if mode == "reference":
            pairs = shown.select("skill_name", "posting_count").distinct()
            names = pairs.orderBy(*by_count).limit(limit).select("skill_name").distinct()
        elif mode == "names":
            best = shown.groupBy("skill_name").agg(F.max("posting_count").alias("posting_count"))
            names = best.orderBy(*by_count).limit(limit).select("skill_name")
        else:
            raise ValueError(f"unknown mode: {mode}")
        picked = shown.join(F.broadcast(names), "skill_name", "left_semi")  # at most `limit` rows
    return picked.orderBy(F.asc_nulls_last("snapshot_date"), "skill_name", "posting_count")


def top_skills(
    demand: DataFrame, skills: DataFrame, limit: int = TOP_SKILLS, source: str | None = None, mode: str = "reference"
) -> DataFrame:
    """Most demanded skills of one snapshot.

    mode "reference": the day of the row with the highest count; "latest": the newest day.
    """
    rows = demand.where(F.col("source") == source) if source else demand
    if mode == "reference":
        day = F.max_by("snapshot_date", F.struct("posting_count", "snapshot_date"))
    elif mode == "latest":
        day = F.max("snapshot_date")
    else:
        raise ValueError(f"unknown mode: {mode}")
    snapshot = rows.where(F.col("snapshot_date") == rows.agg(day).scalar())
    return skill_demand_list(snapshot, skills).orderBy(F.desc("posting_count"), "id").limit(limit)


def city_facet(locations: DataFrame) -> DataFrame:
    return locations.where(F.col("city").isNotNull() & (F.col("city") != "")).select("city").distinct().orderBy("city")


def postings_per_week(postings: DataFrame) -> DataFrame:
    week = F.date_trunc("week", key_date(F.col("date_posted_key"))).cast("date").alias("week_start")
    return postings.groupBy(week).agg(F.count("*").alias("postings")).orderBy("week_start")


def salary_histogram(postings: DataFrame) -> DataFrame:
    bucket = salary_bucket(F.col("salary_min")).alias("bucket")
    return postings.groupBy(bucket).agg(F.count("*").alias("postings"))


def skill_summary(demand: DataFrame, skills: DataFrame) -> DataFrame:
    """Demand and mean salary per skill over all snapshots, each snapshot weighted by its postings."""

    def weighted(column: str) -> Column:
        weight = F.when(F.col(column).isNotNull(), F.col("posting_count"))
        return F.try_divide(F.sum(F.col(column) * F.col("posting_count")), F.sum(weight)).alias(column)

    per_skill = demand.groupBy("skill_key").agg(
        F.sum("posting_count").alias("demand"), weighted("avg_salary_min"), weighted("avg_salary_max")
    )
    return per_skill.join(skills, "skill_key").select("skill_name", "skill_category", "demand", "avg_salary_min", "avg_salary_max")


def postings_by_calendar(postings: DataFrame, calendar: DataFrame) -> DataFrame:
    """Postings per month and weekday kind; days outside the calendar stay, with NULL attributes."""
    days = postings.groupBy("date_posted_key").agg(F.count("*").alias("_rows"))
    joined = days.join(calendar, days.date_posted_key == calendar.date_key, "left")
    return joined.groupBy("year", "quarter", "month", "month_name", "is_weekend").agg(F.sum("_rows").alias("postings"))
