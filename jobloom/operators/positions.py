"""Dense positions in a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.session import cut

_PART, _ROW, _OFFSET = "_part", "_row", "_offset"
_ROW_MASK = (1 << 33) - 1


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def dense_key(df: DataFrame, order: Sequence[str | Column], name: str, bounded: bool = False) -> DataFrame:
    """Add `name` = 1, 2, 3, ... in `order`.

    bounded=True is for relations of proven size (a seed): one small window. Otherwise the rows are range
    partitioned and sorted, each gets its partition number and its place in it, and the result is written once so
    that both stay fixed. Row counts per partition give each partition's offset; that table has one row per
    partition, so its running sum and its broadcast stay small however large `df` is.
    """
    columns = _columns(order)
    if bounded:
        keyed = df.withColumn(name, F.row_number().over(Window.orderBy(*columns)).cast("bigint"))
        return keyed.select(name, *df.columns)
    placed = _placed(df, columns, f"order-{name}")
    sizes = placed.groupBy(_PART).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(_OFFSET))
    return placed.join(F.broadcast(offsets), _PART).select(
        (F.col(_OFFSET) + F.col(_ROW) + 1).alias(name), *df.columns
    )


def _placed(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """df range partitioned and sorted, with each row's partition and its place in it, written once."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))
    return cut(ordered.withColumn(_PART, F.spark_partition_id()).withColumn(_ROW, row), label)


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, by: Sequence[str] | None = None
) -> DataFrame:
    """row_number per key that never gathers one key's rows in one task.

    Rows are range partitioned by (keys, order), so a key that holds a third of all rows is spread over many ranges. A
    row's number is its place among its key's rows of that range, plus those of the ranges before; only the first key of
    a range can have any before, so that table has at most one row per range and is broadcast.

    `by` names the columns that `order` reads. If they tell the rows of a key apart, only keys and `by` are sorted and
    written, and the numbers meet the whole rows in one join; if some rows agree in all of them (a count decides),
    whole rows are sorted, as they are without `by`.
    """
    keys = list(keys)
    same = [*keys, *[c for c in by or () if c not in keys]]
    if by is not None and not set(df.columns) <= set(same):
        slim = cut(df.groupBy(*same).agg(F.count("*").alias("_copies")), "rank-keys")
        if not slim.where("_copies > 1").limit(1).count():
            ranks = _ranked(slim.drop("_copies"), keys, order, name)
            ranks = ranks.select(name, *[F.col(c).alias(f"_of_{c}") for c in same])
            met = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in same])
            return df.join(ranks, met).select(*df.columns, name)
    return _ranked(df, keys, order, name)


def _ranked(df: DataFrame, keys: list[str], order: Sequence[Column], name: str) -> DataFrame:
    placed = _placed(df, [*_columns(keys), *order], "rank")
    here = placed.groupBy(_PART, *keys).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    earlier = here.withColumn(_OFFSET, F.sum("_rows").over(before)).where(F.col(_OFFSET) > 0)
    earlier = earlier.select(F.col(_PART).alias("_of_part"), *[F.col(k).alias(f"_of_{k}") for k in keys], _OFFSET)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys]
    met = reduce(Column.__and__, same, F.col(_PART) == F.col("_of_part"))
    place = F.row_number().over(Window.partitionBy(_PART, *keys).orderBy(_ROW))
    return placed.withColumn("_place", place).join(F.broadcast(earlier), met, "left").select(
        *df.columns, (F.col("_place") + F.coalesce(_OFFSET, F.lit(0))).cast("bigint").alias(name)
    )
