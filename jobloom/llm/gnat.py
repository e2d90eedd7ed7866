"""Product-quantised vector codes whose entries are searched by a geometric near-neighbour access tree.

Vectors of whole numbers are cut into parts, each with a codebook of its own. The entries of a codebook form a tree: a
node has split points, its other entries belong to the nearest split point and make up that one's child, and each split
point stores the range of its distances to the entries of every child. A query measures the split points; a child whose
range lies wholly outside the query's distance from some split point, plus or minus the best distance so far, is left out.

Distances are compared as square roots rounded outwards, and only what is strictly outside goes, so no tie is lost; the
distances themselves are whole squares, and (distance, index) decides exactly.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import map_batches
from jobloom.llm.whole_vectors import floored, group_sums, matrix, means
from jobloom.session import cut

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Split points of a node.
DEGREE = 4
_SLACK = 2.0**-48


class Node(NamedTuple):
    """splits: entries; children[j]: the node of the entries nearest to split j, if any; low, high [i, j]: bounds of the
    distances from split i to the entries of child j."""

    splits: np.ndarray
    children: list[Node | None]
    low: np.ndarray
    high: np.ndarray


class Codes(NamedTuple):
    """rows: id, label, code (array of entry indexes, one per part), error; codebooks[part]: its entries."""

    rows: DataFrame
    codebooks: np.ndarray


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


def build(entries: np.ndarray, members: np.ndarray | None = None, degree: int = DEGREE) -> Node:
    """The tree of `entries`: split points are chosen far from each other, the smallest index first."""
    members = np.arange(len(entries)) if members is None else members
    gaps = _squares(entries[members], entries[members])
    chosen = [0]
    while len(chosen) < min(degree, len(members)):
        away = gaps[chosen].min(axis=0)
        away[chosen] = -1
        chosen.append(int(np.argmax(away)))
    chosen = np.array(sorted(chosen))
    rest = np.setdiff1d(np.arange(len(members)), chosen)
    owner = np.argmin(gaps[chosen][:, rest], axis=0) if len(rest) else rest
    low, high = np.zeros((len(chosen),) * 2), np.zeros((len(chosen),) * 2)
    children: list[Node | None] = []
    for j in range(len(chosen)):
        own = rest[owner == j]
        children.append(build(entries, members[own], degree) if len(own) else None)
        if len(own):
            roots = np.sqrt(gaps[np.ix_(chosen, own)].astype(np.float64))
            low[:, j], high[:, j] = roots.min(axis=1) * (1 - _SLACK), roots.max(axis=1) * (1 + _SLACK)
    return Node(members[chosen], children, low, high)


def search(points: np.ndarray, entries: np.ndarray, tree: Node) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point (ties: the lower) and the squared distance."""
    best = np.full(len(points), len(entries), dtype=np.int64)
    distance = np.full(len(points), np.iinfo(np.int64).max, dtype=np.int64)

    def visit(node: Node, rows: np.ndarray) -> None:
        squares = _squares(points[rows], entries[node.splits])
        for i, entry in enumerate(node.splits):
            better = (squares[:, i] < distance[rows]) | ((squares[:, i] == distance[rows]) & (entry < best[rows]))
            best[rows[better]], distance[rows[better]] = entry, squares[better, i]
        roots = np.sqrt(squares.astype(np.float64))
        for j, child in enumerate(node.children):
            if child is None:
                continue
            reach = np.sqrt(distance[rows].astype(np.float64))[:, None] * (1 + _SLACK)
            beyond = roots * (1 - _SLACK) - reach > node.high[:, j] * (1 + _SLACK)
            within = roots * (1 + _SLACK) + reach < node.low[:, j] * (1 - _SLACK)
            left = ~(beyond | within).any(axis=1)
            if left.any():
                visit(child, rows[left])

    if len(points):
        visit(tree, np.arange(len(points)))
    return best, distance


def _assigned(points: np.ndarray, codebooks: np.ndarray, trees: list[Node]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per vector and part: index, squared distance, and the part itself."""
    parts = points.reshape(len(points), len(codebooks), -1)
    found = [search(parts[:, p], codebooks[p], trees[p]) for p in range(len(codebooks))]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1), parts


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> Codes:
    """Codes of all vectors that hold neither nulls nor infinite numbers nor NaN; other rows have no row.

    Components are floor(scale * x). Codebooks start as the parts of the vectors with the smallest ids (equal ids by their
    vectors, null ids last); each round assigns every part and replaces each entry that is used by the floor of the mean of
    its parts; then parts are assigned once more. Fewer vectors than `entries` make as many entries; no vectors give no
    rows; other columns do not matter. Vectors take part whose length is the commonest of those that can be cut (ties: the
    shorter). A component too large for exact distances is an error. Of the data, the driver sees the codebooks only.
    """
    keep = {"id": F.col(id_col), "label": F.col(label_col)}
    rows = cut(floored(vectors, scale, F.size("v"), vec_col, keep), "whole-vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).where((F.col("n") > 0) & (F.col("n") % parts == 0))
    commonest = lengths.orderBy(F.desc("rows"), "n").first()
    size = commonest["n"] // parts if commonest else 0
    rows = rows.where(F.size("v") == parts * size) if size else rows.limit(0)
    start = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    codebooks = np.array([r["v"] for r in start], dtype=np.int64).reshape(len(start), parts, size).transpose(1, 0, 2)
    each = len(start)
    for _ in range(rounds if each else 0):
        trees = [build(book) for book in codebooks]

        def group_of(points: np.ndarray, books=codebooks, trees=trees) -> tuple[np.ndarray, np.ndarray]:
            index, _, cut_up = _assigned(points, books, trees)
            return (index + np.arange(parts) * each).ravel(), cut_up.reshape(-1, size)

        sums = group_sums(rows.select("v"), parts * each, size, group_of)
        codebooks = means(codebooks.reshape(parts * each, size), sums).reshape(parts, each, size)
    trees = [build(book) for book in codebooks] if each else []

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        index, squares, _ = _assigned(matrix(batch.column(2), parts * size), codebooks, trees)
        code = pa.array(list(index.astype(np.int32)), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code, pa.array(squares.sum(axis=1))], names=["id", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    return Codes(map_batches(rows.select("id", "label", "v"), per_batch, f"id {kinds['id']}, label {kinds['label']}, code array<int>, error long"), codebooks)


def codebooks_digest(codebooks: np.ndarray) -> str:
    """sha256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
