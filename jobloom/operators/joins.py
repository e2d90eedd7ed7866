"""Left join of a fact with a dimension that survives hot and missing keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.session import estimated_bytes

# A dimension of at most this estimated size is left to Catalyst, which broadcasts it.
SMALL_SIDE_BYTES = 8 * 1024 * 1024
# A key is hot when it holds more than one in this many fact rows; so there are fewer hot keys than this.
HOT_FRACTION = 100_000
NULL_SPREAD = 4096


def left_join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: Column,
    dim_key: str,
    weight: str,
    take: dict[str, str],
    small_bytes: int = SMALL_SIDE_BYTES,
    spread: Sequence[str] = ("raw_id",),
) -> DataFrame:
    """Add `take` = {dimension column: new name} to `fact`; `weight` is the dimension's row count per key and `spread` are
    columns whose values differ from row to row.

    Small dimension: a plain left join. Otherwise the hot keys, fewer than HOT_FRACTION by definition, are joined
    by broadcast, and all other rows by a shuffle in which hot and missing keys are spread over filler keys, so that
    no task receives one key's whole share.
    """
    wanted = dimension.select(F.col(dim_key).alias("_dim_key"), F.col(weight).alias("_weight"), *[F.col(c).alias(n) for c, n in take.items()])
    keyed = fact.withColumn("_key", fact_key)
    if estimated_bytes(wanted) <= small_bytes:
        return keyed.join(F.broadcast(wanted.drop("_weight")), F.col("_key") == F.col("_dim_key"), "left").drop("_key", "_dim_key")

    total = wanted.agg(F.sum("_weight")).scalar()
    marked = wanted.withColumn("_hot", F.col("_weight") * HOT_FRACTION > total)
    hot = marked.where("_hot").select(F.col("_dim_key").alias("_hot_dim_key"), *[F.col(n).alias(f"_hot_{n}") for n in take.values()])
    cold = marked.where("not _hot").select("_dim_key", *take.values())
    step = keyed.join(F.broadcast(hot), F.col("_key") == F.col("_hot_dim_key"), "left")
    # A filler starts with NUL, which no trimmed name does, so it meets no dimension row.
    filler = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*spread), F.lit(NULL_SPREAD)).cast("string"))
    step = step.withColumn("_cold_key", F.when(F.col("_hot_dim_key").isNull() & F.col("_key").isNotNull(), F.col("_key")).otherwise(filler))
    joined = step.join(cold, F.col("_cold_key") == F.col("_dim_key"), "left")
    return joined.select(*fact.columns, *[F.coalesce(F.col(f"_hot_{n}"), F.col(n)).alias(n) for n in take.values()])
