"""Raw JSON blobs to typed posting columns, one spec per source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.functions.text import fold, iso_day, text_to_boolean
from jobloom.schemas import CANONICAL

BASE = ("title", "salary_raw", "url", "posted_date", "employment_type")


@dataclass(frozen=True)
class SourceSpec:
    """Which optional columns a source fills; the base columns come with every source."""

    source: str
    extra: tuple[str, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return BASE + self.extra


# The columns each source delivers.
SPECS = {
    spec.source: spec
    for spec in (
        SourceSpec("philjobnet", ("company", "location_raw", "description", "education_level")),
        SourceSpec("kalibrr", ("company", "location_raw", "description", "experience_level", "skills_json")),
        SourceSpec("jobstreet", ("company", "location_raw", "description")),
        SourceSpec("onlinejobs", ("salary_currency", "is_remote")),
        SourceSpec("indeed", ("company", "location_raw")),
    )
}
IDS = ("raw_id", "source", "source_id", "scraped_at")
_JSON_KEY = {"location_raw": "location", "skills_json": "skills"}


def _cleaned(name: str) -> Column:
    text = F.col(f"_{name}")
    if name in ("employment_type", "experience_level", "education_level"):
        return fold(text)
    if name == "salary_currency":
        return F.upper(F.trim(text))
    if name == "is_remote":
        return F.coalesce(text_to_boolean(text), F.lit(True))
    if name == "posted_date":
        return iso_day(text)
    if name in ("description", "skills_json"):
        return text
    return F.trim(text)


def _parsed(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The wanted keys of each blob as text, from one pass over its JSON.

    json_tuple is a generator, so the title filter stays above it instead of being pushed down as a second parse;
    an array comes out as its JSON text.
    """
    keys = [_JSON_KEY.get(c, c) for c in columns]
    fields = F.json_tuple("raw_data", *keys).alias(*[f"_{c}" for c in columns])
    return raw.select(*IDS, fields).where(F.col("_title").isNotNull())


def stage(raw: DataFrame, source: str) -> DataFrame:
    """Staging projection of one source; the source predicate reaches the scan before any JSON is read."""
    columns = SPECS[source].columns
    picked = _parsed(raw.where(F.col("source") == source), columns)
    return picked.select(*IDS, *[_cleaned(c).alias(c) for c in columns])


def stage_all(raw: DataFrame) -> DataFrame:
    """All sources in the canonical shape from one scan and one JSON parse per row.

    The same rows as the union of `stage` over all sources; a column is NULL where its source does not fill it.
    """
    wanted = [f.name for f in CANONICAL.fields if f.name not in IDS]
    picked = _parsed(raw.where(F.col("source").isin(*SPECS)), wanted)

    def column(field: T.StructField) -> Column:
        givers = [s.source for s in SPECS.values() if field.name in s.columns]
        value = _cleaned(field.name)
        if len(givers) < len(SPECS):
            value = F.when(F.col("source").isin(*givers), value)
        return value.cast(field.dataType).alias(field.name)

    return picked.select(*IDS, *[column(f) for f in CANONICAL.fields if f.name not in IDS])
