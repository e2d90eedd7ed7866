"""Vectors of whole numbers, and sums of them per group, for operators whose means must be exact."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def floored(vectors: DataFrame, scale: int, size: Column, vec_col: str, keep: dict[str, Column]) -> DataFrame:
    """`keep` and v, the components times `scale` rounded down, of the rows whose vector is there and holds neither nulls
    nor infinite numbers nor NaN. A component so large that four times a squared distance of `size` components may not fit
    a long is an error."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    taken = vectors.where(finite).select(*[c.alias(n) for n, c in keep.items()], F.transform(v, lambda x: x * scale).alias("v"))
    most = F.floor(F.sqrt(F.lit(float(1 << 59)) / F.greatest(size, F.lit(1)))) - 1
    large = F.exists("v", lambda x: F.abs(x) >= most)
    whole = F.transform("v", lambda x: F.floor(x).cast("bigint"))
    return taken.withColumn("v", F.when(large, F.raise_error(F.lit("a component is too large for exact distances")).cast("array<bigint>")).otherwise(whole))


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def group_sums(rows: DataFrame, groups: int, size: int, group_of: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> dict[int, tuple[int, list[int]]]:
    """group -> (count, sums of components), exact, of the vectors of `rows` (v, as many components as the function wants).

    `group_of` gets the vectors of a batch and gives groups and parts of `size` components; each task sends one row per
    group that it has. The driver holds `groups` rows of `size` numbers: parameters, not data.
    """
    place = rows.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(groups, dtype=np.int64), np.zeros((groups, size), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                column = batch.column(place)
                group, part = group_of(matrix(column, len(column.flatten()) // len(column)))
                order = np.argsort(group, kind="stable")
                begins = np.flatnonzero(np.concatenate(([True], group[order][1:] != group[order][:-1])))
                sums[group[order][begins]] += np.add.reduceat(part[order], begins, axis=0)
                counts += np.bincount(group, minlength=groups)
        seen = np.flatnonzero(counts)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen]), pa.array(list(sums[seen]), pa.list_(pa.int64()))], names=["g", "n", "sums"])

    partial = rows.mapInArrow(run, "g long, n long, sums array<long>")
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    total = partial.groupBy("g").agg(wide(F.col("n")).alias("n"), F.array(*[wide(F.col("sums")[i]) for i in range(size)]).alias("sums"))
    return {r["g"]: (int(r["n"]), [int(x) for x in r["sums"]]) for r in total.collect()}


def means(old: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Rows of `old`, those with members replaced by floor(sum / count)."""
    new = old.copy()
    for g, (n, total) in sums.items():
        new[g] = [s // n for s in total]
    return new
