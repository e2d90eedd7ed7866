"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are brought to unit length, so the nearest by distance is the nearest by cosine. Each table cuts a few Gaussian
(2-stable) projections into cells of one width. A query visits the cells around its own in the order of their estimated
success, the probability that a neighbour at distance `radius` lies there, until a table has covered its part of the
success aimed at. Candidates of all tables are merged and reranked by the exact measure on the original vectors.
"""

from __future__ import annotations

from itertools import product
from math import erf, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import map_batches
from jobloom.session import cut

#: Index vectors and query vectors of one cell that meet in one task's group; larger cells are split.
CHUNK = 4096
_CELLS = 1 << 12


class Hashing(NamedTuple):
    """Parameters of the tables; nothing is fitted on data."""

    tables: int = 4
    projections: int = 4
    width: float = 1.0
    radius: float = 1.15
    success: float = 0.97
    seed: int = 20


def _projections(h: Hashing, size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(h.seed)
    return rng.standard_normal((h.tables, size, h.projections)), rng.uniform(0, h.width, (h.tables, 1, h.projections))


def _unit(batch: pa.RecordBatch, column: str, size: int) -> np.ndarray:
    v = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _key(table: int, cells: np.ndarray) -> np.ndarray:
    """One number per cell; cells are at most 2^11 from the origin, which unit vectors never reach."""
    key = np.full(cells.shape[:-1], table, dtype=np.int64)
    for i in range(cells.shape[-1]):
        key = key * _CELLS + (cells[..., i].astype(np.int64) + _CELLS // 2)
    return key


def index_rows(classes: DataFrame, h: Hashing, size: int) -> DataFrame:
    """(key, cid, embedding): each vector once per table."""

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = _projections(h, size)
        u, rows = _unit(batch, "embedding", size), np.arange(batch.num_rows)
        keys = [_key(t, np.floor((u @ a[t] + b[t]) / h.width)) for t in range(h.tables)]
        take = pa.array(np.tile(rows, h.tables))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), batch.column("cid").take(take), batch.column("embedding").take(take)], names=["key", "cid", "embedding"])

    return map_batches(classes.select("cid", "embedding"), per_batch, "key long, cid long, embedding array<double>")


def probe_rows(queries: DataFrame, h: Hashing, size: int, reach: int = 2) -> DataFrame:
    """(key, cid, embedding): each query once per cell it visits, `reach` cells to either side at most."""
    steps = np.array(list(product(range(-reach, reach + 1), repeat=h.projections)))
    part = 1 - (1 - h.success) ** (1 / h.tables)

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        below = np.vectorize(lambda x: 0.5 * (1 + erf(x / sqrt(2))))
        a, b = _projections(h, size)
        u, keys, rows = _unit(batch, "embedding", size), [], []
        for t in range(h.tables):
            x = (u @ a[t] + b[t]) / h.width
            home = np.floor(x)
            edges = (np.arange(-reach, reach + 2) + home[:, :, None] - x[:, :, None]) * (h.width / h.radius)
            odds = np.diff(below(edges), axis=2)
            success = np.prod([odds[:, i, steps[:, i] + reach] for i in range(h.projections)], axis=0)
            order = np.argsort(-success, axis=1, kind="stable")
            sure = np.cumsum(np.take_along_axis(success, order, 1), axis=1)
            for q in range(len(u)):
                visits = order[q, : int(np.searchsorted(sure[q], part)) + 1]
                keys.append(_key(t, home[q] + steps[visits]))
                rows.append(np.full(len(visits), q))
        take = pa.array(np.concatenate(rows))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), batch.column("cid").take(take), batch.column("embedding").take(take)], names=["key", "cid", "embedding"])

    return map_batches(queries.select("cid", "embedding"), per_batch, "key long, cid long, embedding array<double>")


_SCORED = "query long, cid long, score double"


def _meet(index: DataFrame, probes: DataFrame, size: int, k: int) -> DataFrame:
    """Per query and chunk of a cell the k classes nearest by cosine, ties to the smaller, the query's own left out."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query", pa.int64()), ("cid", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        flat = lambda t: t.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        v, q = flat(left), flat(right)
        ids, asked = left.column("cid").to_numpy(), right.column("cid").to_numpy()
        order = np.argsort(ids, kind="stable")
        v, ids = v[order], ids[order]
        unit, out = v / np.linalg.norm(v, axis=1, keepdims=True), []
        for s in range(0, len(q), 256):
            block, names = q[s : s + 256], asked[s : s + 256]
            rough = (block / np.linalg.norm(block, axis=1, keepdims=True)) @ unit.T
            rough[names[:, None] == ids[None, :]] = -np.inf
            # All within rounding of the k-th are scored again, so that ties are settled by the exact figure.
            kth = -np.partition(-rough, min(k, rough.shape[1]) - 1, axis=1)[:, min(k, rough.shape[1]) - 1]
            for i in range(len(block)):
                near = np.flatnonzero((rough[i] >= kth[i] - 1e-9) & np.isfinite(rough[i]))
                exact = (v[near] * block[i]).sum(axis=1) / (np.sqrt((v[near] * v[near]).sum(axis=1)) * np.sqrt((block[i] * block[i]).sum()))
                best = np.lexsort((ids[near], -exact))[:k]
                out.append((np.full(len(best), names[i]), ids[near][best], exact[best]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    return index.groupBy("key", "chunk").cogroup(probes.groupBy("key", "chunk")).applyInArrow(run, _SCORED)


def _split(index: DataFrame, probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deal both sides of each cell into groups of about CHUNK: every piece of the index meets every piece of the probes.
    Probes of empty cells and cells without probes are left out."""
    loads = index.groupBy("key").agg(F.count("*").alias("n")).join(probes.groupBy("key").agg(F.count("*").alias("m")), "key")
    pieces = loads.select("key", F.ceil(F.col("n") / CHUNK).alias("cuts"), F.ceil(F.col("m") / CHUNK).alias("stacks"))

    def dealt(rows: DataFrame, own: str, other: str, chunk: Column) -> DataFrame:
        piece = F.pmod(F.xxhash64("cid"), F.col(own)).alias("piece")
        each = rows.join(pieces, "key").select("key", "cid", "embedding", "stacks", piece, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias("o"))
        return each.select("key", "cid", "embedding", chunk.alias("chunk"))

    return (
        dealt(index, "cuts", "stacks", F.col("piece") * F.col("stacks") + F.col("o")),
        dealt(probes, "stacks", "cuts", F.col("o") * F.col("stacks") + F.col("piece")),
    )


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, embedding double array) of the vectors that take part: no nulls, all finite, not zero."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("embedding"), (F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)).alias("ok"))
    return chosen.where("ok and id is not null").select("id", "embedding")


def nearest(vectors: DataFrame, queries: Column, k: int = 5, hashing: Hashing | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row that meets `queries` (a condition on `id`), by
    cosine, ties to the smaller id; all candidates if there are fewer than k.

    Equal vectors are one class, of which the k + 1 smallest ids can matter. Queries for which the tables give fewer than k
    candidates are compared with all vectors, cell by cell of the first table. Vectors that are null, zero, or hold nulls
    or non-finite numbers take no part, nor do those whose length differs from the commonest; rows with null ids neither.
    """
    h = hashing or Hashing()
    rows = cut(usable(vectors, id_col, vec_col), "vectors")
    sizes = rows.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    size = sizes["size"] if sizes else 1
    rows = rows.where(F.size("embedding") == size)
    first = Window.partitionBy("embedding").orderBy("id")
    few = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    classes = cut(few.groupBy("embedding").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("cid", F.col("ids")[0]), "classes")
    asked = rows.where(queries).select(F.col("id").alias("query_id"), F.col("embedding").alias("_v"))
    members = cut(asked.join(classes, F.col("_v") == F.col("embedding")).select("query_id", "cid"), "queries")
    wanted = classes.join(members.select("cid").distinct(), "cid", "left_semi").select("cid", "embedding")

    index = cut(index_rows(classes, h, size), "index")
    found = cut(_meet(*_split(index, probe_rows(wanted, h, size)), size, k), "candidates")
    got = found.groupBy("query").agg(F.countDistinct("cid").alias("n")).where(F.col("n") >= k)
    short = wanted.join(got, wanted.cid == got.query, "left_anti")
    base = _CELLS**h.projections
    cells = [r[0] for r in index.where((F.col("key") >= 0) & (F.col("key") < base)).select("key").distinct().collect()] if short.limit(1).count() else []
    if cells:  # cells of one table: bounded by its parameters, not by the rows
        everywhere = short.select(F.explode(F.array(*[F.lit(c).cast("long") for c in sorted(cells)])).alias("key"), "cid", "embedding")
        found = found.unionByName(_meet(*_split(index, everywhere), size, k))

    top = Window.partitionBy("query").orderBy(F.desc("score"), "cid")
    best = found.distinct().withColumn("r", F.row_number().over(top)).where(F.col("r") <= k).drop("r")
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    own = wanted.select(F.col("cid").alias("query"), "cid", (norm / (F.sqrt(norm) * F.sqrt(norm))).alias("score"))
    spread = best.unionByName(own).join(classes.select("cid", "ids"), "cid").select("query", "score", F.explode("ids").alias("vec_id"))
    pairs = members.join(spread, members.cid == spread.query).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
