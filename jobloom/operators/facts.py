"""Posting fact and skill-demand fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.functions.salary import DEFAULT_CURRENCY, to_monthly_php, with_salary
from jobloom.functions.text import date_key, fold
from jobloom.operators.joins import SMALL_SIDE_BYTES, left_join_dimension
from jobloom.operators.positions import dense_key
from jobloom.operators.skills import posting_skills


def build_fct_postings(deduped: DataFrame, companies: DataFrame, locations: DataFrame, small_bytes: int = SMALL_SIDE_BYTES) -> DataFrame:
    """One row per deduplicated posting; dimensions above `small_bytes` are joined with their hot keys apart.

    Salaries are parsed in the row instead of being joined on raw_id. `locations` may carry `postings`
    (see build_dim_locations); without it every place weighs the same.
    """
    if "postings" not in locations.columns:
        locations = locations.withColumn("postings", F.lit(1))
    priced = with_salary(deduped)
    step = left_join_dimension(
        priced, companies, fold(F.col("company")), "company_lower", "total_postings", {"company_key": "company_key"}, small_bytes
    )
    step = left_join_dimension(
        step,
        locations,
        F.col("location_raw"),
        "location_raw",
        "postings",
        {"location_key": "location_key", "is_remote": "_place_remote"},
        small_bytes,
    )
    scraped = F.to_date("scraped_at")
    return step.select(
        F.col("raw_id").alias("job_key"),
        "source",
        "source_id",
        "title",
        "description",
        "company_key",
        "location_key",
        date_key(F.coalesce("posted_date", scraped)).alias("date_posted_key"),
        date_key(scraped).alias("date_scraped_key"),
        F.col("parsed_min").alias("salary_min"),
        F.col("parsed_max").alias("salary_max"),
        F.coalesce("parsed_currency", F.lit(DEFAULT_CURRENCY)).alias("salary_currency"),
        F.col("parsed_period").alias("salary_period"),
        "employment_type",
        "experience_level",
        F.coalesce("is_remote", "_place_remote", F.lit(False)).alias("is_remote"),
        "url",
    )


def _one_category_per_name(dictionary: DataFrame) -> bool:
    """True when matches are distinct by name already, so nothing needs to be made distinct after the join."""
    several = dictionary.groupBy("canonical_name").agg(F.count_distinct(F.coalesce("category", F.lit(""))).alias("n"))
    return several.where("n > 1").limit(1).count() == 0


def build_job_skills(deduped: DataFrame, dictionary: DataFrame, dim_skills: DataFrame, boundary="strict") -> DataFrame:
    """Bridge: posting key and skill key."""
    pairs = posting_skills(deduped, dictionary, boundary)
    bridge = pairs.join(dim_skills.select("skill_key", "skill_name"), "skill_name").select(
        F.col("raw_id").alias("job_key"), "skill_key"
    )
    return bridge if _one_category_per_name(dictionary) else bridge.distinct()


def build_fct_skill_demand(
    deduped: DataFrame,
    dictionary: DataFrame,
    dim_skills: DataFrame,
    boundary: str = "strict",
    normalize: bool = False,
) -> DataFrame:
    """One row per (day, skill, source): postings and mean salary ends.

    The matches carry their posting's day and parsed salary, so no join back on raw_id is needed; the only shuffle is
    the partially aggregated group-by. normalize=True averages pesos per month instead of mixed amounts.
    """
    low, high = F.col("parsed_min").cast("double"), F.col("parsed_max").cast("double")
    if normalize:
        monthly = to_monthly_php(F.col("parsed_min"), F.col("parsed_max"), F.col("parsed_currency"), F.col("parsed_period"))
        low, high = monthly["min"], monthly["max"]
    priced = with_salary(deduped).withColumns({"_low": low, "_high": high, "snapshot_date": F.to_date("scraped_at")})
    pairs = posting_skills(priced, dictionary, boundary, carry=["snapshot_date", "_low", "_high"])
    postings = F.count("*") if _one_category_per_name(dictionary) else F.count_distinct("raw_id")
    by_name = pairs.groupBy("snapshot_date", "skill_name", "source").agg(
        postings.alias("posting_count"),
        F.avg("_low").alias("avg_salary_min"),
        F.avg("_high").alias("avg_salary_max"),
    )
    grouped = by_name.join(dim_skills.select("skill_key", "skill_name"), "skill_name").select(
        "snapshot_date", "skill_key", "source", "posting_count", "avg_salary_min", "avg_salary_max"
    )
    return dense_key(grouped, ["snapshot_date", "skill_key", "source"], "id")
