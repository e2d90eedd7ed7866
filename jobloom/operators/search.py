"""Facet filters, text search, ordering and paging over the marts.

Filters and order are settled on the fact; names and places are joined to the rows of the page only.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE_SIZE = 25

LIST_COLUMNS = (
    "job_key",
    "source",
    "title",
    "company_name",
    "city",
    "region",
    "salary_min",
    "salary_max",
    "salary_currency",
    "salary_period",
    "employment_type",
    "experience_level",
    "is_remote",
    "date_posted_key",
    "url",
)
JOB_SEARCH = ("title", "description", "company_name")
JOB_ORDER = ("salary_min", "salary_max", "date_posted_key", "company_name")
COMPANY_SEARCH = ("company_name", "company_slug")
COMPANY_ORDER = ("total_postings", "company_name")
LOCATION_SEARCH = ("city", "province", "region")
SKILL_SEARCH = ("skill_name",)


class Page(NamedTuple):
    rows: DataFrame
    total: DataFrame


def contains_ignoring_case(column: str, text: str) -> Column:
    return F.upper(F.col(column)).contains(text.upper())


def equals_ignoring_case(column: str, text: str) -> Column:
    return F.upper(F.col(column)) == text.upper()


_FACETS = {
    "source": equals_ignoring_case,
    "salary_currency": equals_ignoring_case,
    "employment_type": contains_ignoring_case,
    "experience_level": contains_ignoring_case,
    "city": contains_ignoring_case,
    "region": contains_ignoring_case,
    "company_name": contains_ignoring_case,
    "is_remote": lambda column, value: F.col(column) == F.lit(value),
    "salary_min_gte": lambda _, value: F.col("salary_min") >= F.lit(value),
    "salary_max_lte": lambda _, value: F.col("salary_max") <= F.lit(value),
}


def filter_jobs(jobs: DataFrame, **facets) -> DataFrame:
    """All given facets must hold; None and '' mean the facet is not set."""
    unknown = set(facets) - set(_FACETS)
    if unknown:
        raise ValueError(f"unknown facets: {sorted(unknown)}")
    for name, value in facets.items():
        if value is not None and value != "":
            jobs = jobs.where(_FACETS[name](name, value))
    return jobs


def search(df: DataFrame, text: str | None, columns: Sequence[str]) -> DataFrame:
    """Every term (split on blanks and commas) must occur in at least one column."""
    for term in [t for t in re.split(r"[\s,]+", text or "") if t]:
        df = df.where(reduce(Column.__or__, [contains_ignoring_case(c, term) for c in columns]))
    return df


def order_keys(spec: str | None, allowed: Sequence[str], default: Sequence[str]) -> list[str]:
    """The names of 'a,-b' that are allowed; none left means the default."""
    asked = [s.strip() for s in (spec or "").split(",")]
    return [k for k in asked if k.lstrip("-") in allowed] or list(default)


def ordering(spec: str | None, allowed: Sequence[str], default: Sequence[str], tie: str) -> list[Column]:
    """Sort columns from 'a,-b'; names off the list are ignored, none left means the default.

    Descending puts NULLs first and ascending puts them last; `tie` makes the order total.
    """
    keys = order_keys(spec, allowed, default)
    columns = [F.desc_nulls_first(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in keys]
    return [*columns, F.asc(tie)]


def _plain(value):
    return value.isoformat() if isinstance(value, (date, datetime)) else str(value) if isinstance(value, Decimal) else value


def page_token(row, keys: Sequence[str], tie: str) -> str:
    """Where a page ended: the order's values and the tie of its last row, as text for a link."""
    values = [_plain(row[k.lstrip("-")]) for k in keys]
    return base64.urlsafe_b64encode(json.dumps([list(keys), values, row[tie]]).encode()).decode()


def after_token(df: DataFrame, token: str, keys: Sequence[str], tie: str) -> Column:
    """Condition on the rows behind a token in the order of `keys`; a token of another order is an error."""
    try:
        known, values, last = json.loads(base64.urlsafe_b64decode(token.encode()))
    except ValueError as error:
        raise ValueError("not a page token") from error
    if known != list(keys):
        raise ValueError(f"the token is for the order {known}")
    behind = F.col(tie) > F.lit(last)
    for key, value in reversed(list(zip(keys, values))):
        column = F.col(key.lstrip("-"))
        at = F.lit(value).cast(df.schema[key.lstrip("-")].dataType)
        if key.startswith("-"):  # NULLs come first
            past = column.isNotNull() if value is None else column < at
        else:  # NULLs come last
            past = F.lit(False) if value is None else column.isNull() | (column > at)
        behind = F.coalesce(past, F.lit(False)) | (column.eqNullSafe(at) & behind)
    return behind


def _checked(number: int, size: int, max_size: int | None) -> None:
    if number < 1 or size < 1:
        raise ValueError(f"page {number} of size {size}: both start at 1")
    if max_size is not None and size > max_size:
        raise ValueError(f"page size {size} is above {max_size}")


def page(df: DataFrame, order: Sequence[Column], number: int = 1, size: int = PAGE_SIZE, max_size: int | None = None) -> Page:
    """One page in `order` and the total row count as a one-row DataFrame.

    A caller that wants to bound pages gives `max_size`; a larger `size` is then an error, never a shorter page.
    """
    _checked(number, size, max_size)
    rows = df.orderBy(*order).offset((number - 1) * size).limit(size)
    return Page(rows, df.agg(F.count("*").alias("total")))


def page_after(df: DataFrame, key: str, last_value, tie: str, last_tie, size: int = PAGE_SIZE, max_size: int | None = None) -> DataFrame:
    """The page after a known last row, `key` descending with NULLs first: a filter instead of a growing offset."""
    _checked(1, size, max_size)
    column, same_later = F.col(key), F.col(tie) > F.lit(last_tie)
    if last_value is None:
        rest = column.isNotNull() | (column.isNull() & same_later)
    else:
        rest = (column < F.lit(last_value)) | ((column == F.lit(last_value)) & same_later)
    return df.where(rest).orderBy(F.desc_nulls_first(key), F.asc(tie)).limit(size)


def _with_dims(fact: DataFrame, companies: DataFrame, locations: DataFrame) -> DataFrame:
    return fact.join(companies.select("company_key", "company_name"), "company_key", "left").join(
        locations.select("location_key", "city", "region"), "location_key", "left"
    )


def job_list(fact: DataFrame, companies: DataFrame, locations: DataFrame) -> DataFrame:
    return _with_dims(fact, companies, locations).select(*LIST_COLUMNS)


_OF_COMPANY, _OF_PLACE = ("company_name",), ("city", "region")


def _hits(fact: DataFrame, companies: DataFrame, locations: DataFrame, text: str | None, facets: dict, keys: Sequence[str]) -> DataFrame:
    """Rows of the fact that meet all facets and search terms, with company_name if the order needs it.

    Facets of a dimension become semi joins on its key; for a text search a company says which terms its name contains. So
    at most a key and a few flags of a dimension meet the fact, and nothing of it where only the fact is asked.
    """
    own = {n: v for n, v in facets.items() if n not in (*_OF_COMPANY, *_OF_PLACE)}
    hits = filter_jobs(fact, **own)
    for dim, key, names in ((companies, "company_key", _OF_COMPANY), (locations, "location_key", _OF_PLACE)):
        asked = {n: facets[n] for n in names if facets.get(n) not in (None, "")}
        if asked:
            hits = hits.join(filter_jobs(dim, **asked).select(key), key, "left_semi")
    terms = [t for t in re.split(r"[\s,]+", text or "") if t]
    if terms:
        flags = [contains_ignoring_case("company_name", t).alias(f"_term_{i}") for i, t in enumerate(terms)]
        named = companies.select(F.col("company_key").alias("_company"), *flags).where(" or ".join(f"_term_{i}" for i in range(len(terms))))
        hits = hits.join(named, hits["company_key"] == named["_company"], "left")
        for i, term in enumerate(terms):
            here = contains_ignoring_case("title", term) | contains_ignoring_case("description", term)
            hits = hits.where(F.coalesce(F.col(f"_term_{i}"), F.lit(False)) | here)
        hits = hits.select(*fact.columns)
    if "company_name" in [k.lstrip("-") for k in keys]:
        hits = hits.join(companies.select("company_key", "company_name"), "company_key", "left")
    return hits


def search_jobs(
    fact: DataFrame,
    companies: DataFrame,
    locations: DataFrame,
    text: str | None = None,
    order: str | None = None,
    number: int = 1,
    size: int = PAGE_SIZE,
    after: str | None = None,
    **facets,
) -> Page:
    """Facets, then text search, then order and page; list columns are joined to the page.

    `number` counts pages and sorts all before it as well; `after`, a token of `page_token` for the last row seen, goes on
    behind that row in any order, at the cost of a first page.
    """
    keys = order_keys(order, JOB_ORDER, ["-date_posted_key"])
    hits = _hits(fact, companies, locations, text, facets, keys)
    slim = hits.select(*dict.fromkeys([*[k.lstrip("-") for k in keys], *[c for c in (*LIST_COLUMNS, "company_key", "location_key") if c in fact.columns]]))
    total = hits.agg(F.count("*").alias("total"))
    if after is not None:
        slim, number = slim.where(after_token(slim, after, keys, "job_key")), 1
    by = ordering(order, JOB_ORDER, ["-date_posted_key"], "job_key")
    # The page's joins may shuffle it while the planner goes on to believe in its order and drops a sort by the same columns;
    # so its rows are numbered first.
    numbered = page(slim, by, number, size).rows.withColumn("_place", F.row_number().over(Window.orderBy(*by)))
    rows = _with_dims(numbered.drop("company_name"), companies, locations).repartition(1).sortWithinPartitions("_place")
    return Page(rows.select(*LIST_COLUMNS), total)


def job_detail(fact: DataFrame, companies: DataFrame, locations: DataFrame, job_key: int) -> DataFrame:
    """One posting with its company and location as structs (NULL when missing).

    The company name used for joining is not shown.
    """
    one = fact.where(F.col("job_key") == F.lit(job_key))
    shown = [c for c in companies.columns if c != "company_lower"]
    company = companies.select(F.col("company_key"), F.struct(*shown).alias("company"))
    location = locations.select(F.col("location_key"), F.struct(*locations.columns).alias("location"))
    return one.join(company, "company_key", "left").join(location, "location_key", "left").drop("company_key", "location_key")


def company_list(companies: DataFrame, text=None, order=None, number=1, size=PAGE_SIZE) -> Page:
    found = search(companies, text, COMPANY_SEARCH).drop("company_lower")
    return page(found, ordering(order, COMPANY_ORDER, ["-total_postings"], "company_key"), number, size)


def location_list(locations: DataFrame, text=None, number=1, size=PAGE_SIZE, **exact) -> Page:
    unknown = set(exact) - {"is_remote", "is_metro_manila", "region"}
    if unknown:
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    found = search(locations, text, LOCATION_SEARCH)
    for name, value in exact.items():
        if value is not None:
            found = found.where(F.col(name) == F.lit(value))
    return page(found, ordering(None, (), ["region", "city"], "location_key"), number, size)


def skill_list(skills: DataFrame, text=None, number=1, size=PAGE_SIZE) -> Page:
    return page(search(skills, text, SKILL_SEARCH), ordering(None, (), ["skill_name"], "skill_key"), number, size)


def skill_demand_list(demand: DataFrame, skills: DataFrame) -> DataFrame:
    return demand.join(skills, "skill_key", "left").select(
        "id",
        "snapshot_date",
        "skill_name",
        "skill_category",
        "posting_count",
        "avg_salary_min",
        "avg_salary_max",
        "source",
    )
