"""k-means with exact integer centroids, assigned by Orchard's search.

Each centroid has a list of all centroids, nearest first. A vector starts at the first centroid and walks its list; a
centroid that is closer takes over at once, and the walk goes on in that one's list. Centroids that were compared are
marked. By the triangle inequality nothing beyond twice the current distance can be closer, so the walk stops strictly
there; ties lie within it and go to the smaller number.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import map_batches
from jobloom.llm.whole_vectors import floored, group_sums, matrix, means
from jobloom.session import cut

SCALE = 256
SIZE = 64
CENTROIDS = 40
ROUNDS = 5


class Lists(NamedTuple):
    """centroids (k, size); order[c]: all centroids from the nearest of c on; gaps: their squared distances from c."""

    centroids: np.ndarray
    order: np.ndarray
    gaps: np.ndarray


class Clustering(NamedTuple):
    """rows: id, cluster, distance (squared); centroids: one row each."""

    rows: DataFrame
    centroids: np.ndarray


def neighbour_lists(centroids: np.ndarray) -> Lists:
    gaps = np.array([((centroids - c) ** 2).sum(axis=1) for c in centroids], dtype=np.int64).reshape(len(centroids), len(centroids))
    order = np.argsort(gaps, axis=1, kind="stable")
    return Lists(centroids, order, np.take_along_axis(gaps, order, axis=1))


def search(points: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each point (ties: the smaller) and the squared distance. All points walk at once,
    one step of each list at a time."""
    centroids, order, gaps = lists
    n, k = len(points), len(centroids)
    at, place = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    distance = ((points - centroids[0]) ** 2).sum(axis=1)
    best = at.copy()
    marked = np.zeros((n, k), dtype=bool)
    marked[:, 0] = True
    walking = np.arange(n)
    while len(walking):
        walking = walking[place[walking] < k]
        walking = walking[gaps[at[walking], place[walking]] <= 4 * distance[walking]]
        seen = order[at[walking], place[walking]]
        place[walking] += 1
        fresh = ~marked[walking, seen]
        rows, met = walking[fresh], seen[fresh]
        marked[rows, met] = True
        found = ((points[rows] - centroids[met]) ** 2).sum(axis=1)
        tie = (found == distance[rows]) & (met < best[rows])
        best[rows[tie]] = met[tie]
        closer = found < distance[rows]
        rows, met = rows[closer], met[closer]
        at[rows], best[rows], distance[rows], place[rows] = met, met, found[closer], 0
    return best, distance


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose `seed:id` has the smallest sha256; equal ids by their vectors, null ids last."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = rows.orderBy(name.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in chosen], dtype=np.int64)


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 2, scale: int = SCALE, size: int = SIZE, id_col: str = "vec_id", vec_col: str = "embedding") -> Clustering:
    """k-means over all vectors of `size` components, none of them null or infinite or NaN; other rows have no row.

    Components are floor(scale * x). Each round assigns every vector and replaces each centroid that has any by the floor
    of their mean; then vectors are assigned once more. Rows with one id count each; fewer vectors than k make as many
    centroids; no vectors give no rows; other columns do not matter. Components too large for exact distances are an error.
    Of the data, the driver sees the centroids only.
    """
    wanted = vectors.where(F.size(vec_col) == size)
    rows = cut(floored(wanted, scale, F.lit(size), vec_col, {"id": F.col(id_col)}), "whole-vectors")
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        lists = neighbour_lists(centroids)
        centroids = means(centroids, group_sums(rows, len(centroids), size, lambda points, lists=lists: (search(points, lists)[0], points)))
    lists = neighbour_lists(centroids) if len(centroids) else None

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        number, distance = search(matrix(batch.column(1), size), lists)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return Clustering(map_batches(rows.select("id", "v"), per_batch, f"id {dict(rows.dtypes)['id']}, cluster int, distance long"), centroids)
