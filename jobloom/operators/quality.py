"""Data-quality checks as aggregates, reported as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted sets and bounds of the suites.
KNOWN_SOURCES = ("philjobnet", "kalibrr", "jobstreet", "onlinejobs", "indeed", "facebook")
KNOWN_CURRENCIES = ("PHP", "USD")
SALARY_RANGE = (0, 10_000_000)
DATE_KEYS = (19700101, 21001231)
FRESH_DAYS = 7

RESULT = ("table", "column", "check", "failed_rows", "passed")


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    ref: str | None = None
    ref_column: str | None = None


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns]


def unique(*columns: str) -> list[Check]:
    return [Check("unique", c) for c in columns]


def accepted_values(column: str, values: Sequence) -> Check:
    return Check("accepted_values", column, values=tuple(values))


def accepted_range(column: str, low, high) -> Check:
    return Check("accepted_range", column, low=low, high=high)


def ordered(low: str, high: str) -> Check:
    """`high` must not be below `low`."""
    return Check("ordered", high, ref_column=low)


def row_count(low: int, high: int | None = None) -> Check:
    return Check("row_count", low=low, high=high)


def fresh(column: str, days: int = FRESH_DAYS) -> Check:
    return Check("fresh", column, low=days)


def relationship(column: str, ref: str, ref_column: str) -> Check:
    return Check("relationship", column, ref=ref, ref_column=ref_column)


#: Kinds that are decided by a row alone.
ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "ordered", "fresh")


def offends(check: Check, as_of: datetime | None = None) -> Column:
    """Whether a row offends a check of ROW_KINDS; a NULL value only offends not_null."""
    value = F.col(check.column)
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "accepted_values":
        wrong = ~value.isin(*check.values)
    elif check.kind == "accepted_range":
        wrong = ~value.between(check.low, check.high)
    elif check.kind == "ordered":
        wrong = value < F.col(check.ref_column)
    elif check.kind == "fresh":
        if as_of is None:
            raise ValueError("a freshness check needs as_of")
        now = F.lit(as_of).cast("timestamp")
        wrong = ~value.between(now - F.make_dt_interval(F.lit(int(check.low))), now)
    else:
        raise ValueError(f"not decided by a row: {check.kind}")
    return F.coalesce(wrong, F.lit(False))


def _failed(check: Check, as_of: datetime | None) -> Column:
    """Aggregate that counts the offending rows."""
    if check.kind in ROW_KINDS:
        return F.count_if(offends(check, as_of))
    if check.kind == "row_count":
        rows = F.count("*")
        short = F.greatest(F.lit(int(check.low)) - rows, F.lit(0))
        over = F.greatest(rows - F.lit(check.high), F.lit(0)) if check.high is not None else F.lit(0)
        return short + over
    raise ValueError(f"unknown check: {check.kind}")


def _report(counted: DataFrame, table: str, columns: Column, kind: Column, failed: Column) -> DataFrame:
    return counted.select(
        F.lit(table).alias("table"),
        columns.cast("string").alias("column"),
        kind.alias("check"),
        failed.cast("bigint").alias("failed_rows"),
        (failed == 0).alias("passed"),
    )


def _row_checks(df: DataFrame, table: str, checks: Sequence[Check], as_of) -> DataFrame:
    """All row-level checks of a table in one pass over it."""
    counted = df.agg(*[_failed(c, as_of).cast("bigint").alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c.column).cast("string").alias("column"), F.lit(c.kind).alias("check"), F.col(f"c{i}").alias("failed")
            )
            for i, c in enumerate(checks)
        ]
    )
    flat = counted.select(F.inline(rows))
    return _report(flat, table, F.col("column"), F.col("check"), F.col("failed"))


def _unique_check(df: DataFrame, table: str, column: str) -> DataFrame:
    """Rows beyond the first per value; reads one column and pre-aggregates it."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    surplus = counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("failed"))
    return _report(surplus, table, F.lit(column), F.lit("unique"), F.col("failed"))


def _relationship_check(df: DataFrame, table: str, check: Check, refs: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose key has no partner; keys are counted first, so the anti join sees each once."""
    keys = df.where(F.col(check.column).isNotNull()).groupBy(F.col(check.column).alias("_k")).agg(F.count("*").alias("_n"))
    known = refs[check.ref].select(F.col(check.ref_column).alias("_k"))
    lost = keys.join(known, "_k", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failed"))
    return _report(lost, table, F.lit(check.column), F.lit(f"relationship:{check.ref}"), F.col("failed"))


def run_suite(
    df: DataFrame,
    table: str,
    checks: Sequence[Check],
    refs: Mapping[str, DataFrame] | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """(table, column, check, failed_rows, passed), one row per check."""
    by_row = [c for c in checks if c.kind not in ("unique", "relationship")]
    parts = [_row_checks(df, table, by_row, as_of)] if by_row else []
    parts += [_unique_check(df, table, c.column) for c in checks if c.kind == "unique"]
    parts += [_relationship_check(df, table, c, refs or {}) for c in checks if c.kind == "relationship"]
    return reduce(DataFrame.unionByName, parts)


def offenders(df: DataFrame, table: str, checks: Sequence[Check], key: str, as_of: datetime | None = None) -> DataFrame:
    """(table, column, check, failed_rows, first_key, last_key) of the checks that a row decides: where to look for what
    failed. One pass; a check holds two keys, however many rows offend it."""
    by_row = [c for c in checks if c.kind in ROW_KINDS]
    if not by_row:
        raise ValueError("no check here is decided by a row")
    columns = []
    for i, c in enumerate(by_row):
        held = F.when(offends(c, as_of), F.col(key))
        columns += [F.count_if(offends(c, as_of)).alias(f"n{i}"), F.min(held).alias(f"a{i}"), F.max(held).alias(f"z{i}")]
    each = [
        F.struct(F.lit(c.column).alias("column"), F.lit(c.kind).alias("check"), F.col(f"n{i}").alias("failed_rows"), F.col(f"a{i}").alias("first_key"), F.col(f"z{i}").alias("last_key"))
        for i, c in enumerate(by_row)
    ]
    return df.agg(*columns).select(F.inline(F.array(*each))).select(F.lit(table).alias("table"), "*")


def quarantine(df: DataFrame, checks: Sequence[Check], as_of: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that fail with `failed_checks`): all checks that a row decides, in the order given. No row is in
    both or neither, and nothing is shuffled."""
    named = [F.when(offends(c, as_of), F.lit(f"{c.column}:{c.kind}")) for c in checks if c.kind in ROW_KINDS]
    reasons = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    judged = df.withColumn("failed_checks", reasons)
    return judged.where(F.size("failed_checks") == 0).drop("failed_checks"), judged.where(F.size("failed_checks") > 0)


def raw_suite() -> list[Check]:
    return [
        row_count(1),
        *not_null("source", "source_id", "raw_data", "scraped_at"),
        accepted_values("source", KNOWN_SOURCES),
        fresh("scraped_at"),
    ]


def postings_suite(min_rows: int = 1000) -> list[Check]:
    return [
        row_count(min_rows),
        *not_null("job_key", "source", "title"),
        *unique("job_key"),
        accepted_values("source", KNOWN_SOURCES),
        accepted_values("salary_currency", KNOWN_CURRENCIES),
        accepted_range("salary_min", *SALARY_RANGE),
        accepted_range("salary_max", *SALARY_RANGE),
        accepted_range("date_posted_key", *DATE_KEYS),
        ordered("salary_min", "salary_max"),
        relationship("company_key", "dim_companies", "company_key"),
        relationship("location_key", "dim_locations", "location_key"),
    ]


DIM_SUITES = {
    "dim_companies": [*not_null("company_key", "company_name", "company_lower"), *unique("company_key", "company_lower")],
    "dim_locations": [*not_null("location_key", "location_raw"), *unique("location_key", "location_raw")],
    "dim_skills": [*not_null("skill_key", "skill_name"), *unique("skill_key", "skill_name")],
    "dim_date": [*not_null("date_key", "full_date"), *unique("date_key", "full_date")],
    "fct_skill_demand": [
        *not_null("id", "skill_key", "posting_count"),
        *unique("id"),
        relationship("skill_key", "dim_skills", "skill_key"),
    ],
}


def salary_range_offenders(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("salary_max") < F.col("salary_min")).select("job_key", "salary_min", "salary_max")


def run_warehouse_checks(marts, raw: DataFrame | None = None, as_of: datetime | None = None, min_rows: int = 1000) -> DataFrame:
    """Every suite over every table, as one result table."""
    tables = {name: getattr(marts, name) for name in [*DIM_SUITES, "fct_job_postings"]}
    parts = [run_suite(tables[n], n, s, refs=tables) for n, s in DIM_SUITES.items()]
    parts.append(run_suite(tables["fct_job_postings"], "fct_job_postings", postings_suite(min_rows), refs=tables))
    if raw is not None:
        parts.append(run_suite(raw, "raw_job_postings", raw_suite(), as_of=as_of))
    return reduce(DataFrame.unionByName, parts)


def store_results(results: DataFrame, path: str, run_at: datetime, fail_fast: bool = False) -> DataFrame:
    """Append the results with their run time; fail_fast raises when a check failed."""
    stamped = results.withColumn("run_at", F.lit(run_at).cast("timestamp"))
    stamped.write.mode("append").parquet(path)
    stored = results.sparkSession.read.schema(stamped.schema).parquet(path).where(F.col("run_at") == F.lit(run_at))
    if fail_fast:
        failed = stored.where(~F.col("passed")).select("table", "column", "check", "failed_rows").collect()
        if failed:
            raise ValueError(f"failed checks: {[tuple(r) for r in failed]}")
    return stored
