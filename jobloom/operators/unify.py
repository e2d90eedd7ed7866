"""Union of the sources and removal of repeated scrapes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.operators.positions import rank_within
from jobloom.schemas import CANONICAL

POSTING_KEY = ("source", "source_id")


def newest_first() -> list[Column]:
    """Scrape time, then id, so that equal times still have one winner."""
    return [F.col("scraped_at").desc(), F.col("raw_id").desc()]


def canonical(df: DataFrame) -> DataFrame:
    """The 16 canonical columns in order, typed NULLs for what is missing."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CANONICAL.fields
        ]
    )


def unify(staged: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [canonical(df) for df in staged])


def rank_duplicates(df: DataFrame, keys: Sequence[str] = POSTING_KEY) -> DataFrame:
    """Add rn: 1 for the newest copy of each key, 2 for the one before, ... Only the columns of key and order are sorted."""
    return rank_within(df, keys, newest_first(), "rn", by=["scraped_at", "raw_id"])


def dedup_latest(df: DataFrame, keys: Sequence[str] = POSTING_KEY) -> DataFrame:
    """Newest copy per key.

    row_number = 1 lets Catalyst keep one candidate per key in every map task (WindowGroupLimit) before the
    shuffle, so a key with very many copies sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first())
    return df.withColumn("rn", F.row_number().over(window)).where("rn = 1").drop("rn")
