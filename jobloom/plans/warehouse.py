"""Raw postings to star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from jobloom.operators.dims import build_dim_companies, build_dim_date, build_dim_locations, build_dim_skills, calendar_span, stray_days
from jobloom.operators.facts import build_fct_postings, build_fct_skill_demand
from jobloom.operators.staging import stage_all
from jobloom.operators.unify import dedup_latest
from jobloom.session import balance, scratch_path
from jobloom.sources.layers import materialize
from jobloom.sources.raw import read_seed


@dataclass(frozen=True)
class Marts:
    deduped: DataFrame
    dim_companies: DataFrame
    dim_locations: DataFrame
    dim_skills: DataFrame
    dim_date: DataFrame
    fct_job_postings: DataFrame
    fct_skill_demand: DataFrame


def spine(raw: DataFrame) -> DataFrame:
    """The deduplicated postings all marts are built from: one scan, one JSON parse, one shuffle."""
    return dedup_latest(stage_all(raw))


def build_warehouse(
    spark: SparkSession,
    raw: DataFrame,
    root: str | None = None,
    dictionary: DataFrame | None = None,
    regions: DataFrame | None = None,
) -> Marts:
    """Build and write all marts under `root` (a new folder in the shared directory when not given).

    The spine is written once, then read by each mart, so the raw blobs are parsed a single time and a lost executor
    costs no more than the tasks it was running. Under the same `root` each build adds a version of every table, and readers
    of the one before are not disturbed.
    """
    root = root or scratch_path(balance(spark), "warehouse")
    dictionary = dictionary if dictionary is not None else read_seed(spark, "skill_terms")
    regions = regions if regions is not None else read_seed(spark, "regions")

    deduped = materialize(spine(raw), "marts", "spine", root)

    companies = materialize(build_dim_companies(deduped), "marts", "dim_companies", root)
    weighted = materialize(build_dim_locations(deduped, regions, keep_counts=True), "marts", "dim_locations", root)
    skills = materialize(build_dim_skills(dictionary), "marts", "dim_skills", root)
    postings = materialize(build_fct_postings(deduped, companies, weighted), "marts", "fct_job_postings", root, partition_by=["source"])
    calendar = materialize(build_dim_date(spark, *calendar_span(postings), stray_days(postings)), "marts", "dim_date", root)
    demand = materialize(build_fct_skill_demand(deduped, dictionary, skills), "marts", "fct_skill_demand", root)
    return Marts(deduped, companies, weighted.drop("postings"), skills, calendar, postings, demand)
