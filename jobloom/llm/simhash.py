"""SimHash near-duplicates by segment popcounts.

A fingerprint of 64 bits is cut into 32 segments of two bits; its embedding is the vector of the segments' bit counts
(0, 1 or 2). The Manhattan distance of two embeddings is a lower bound of the Hamming distance of the fingerprints. The
counts are dealt into seven groups; vectors within distance 4 agree wholly in at least three of the seven groups, so
each choice of three groups is a grid whose cell is the counts in those groups. The range join meets in the cells of the
35 grids, drops pairs by the lower bound, and verifies the rest by the exact Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import map_batches
from jobloom.llm.components import components
from jobloom.session import cut

SEED = 42
SHINGLE = 4
DISTANCE = 4
GROUPS = 7
SEGMENTS = 32
#: A cell with more fingerprints is cut into tiles of this many, and each pair of tiles becomes a group of its own.
TILE = 2048
#: Rows that a task gathers before it looks for links among them.
BUFFER = 65536
_LANES = np.uint64(0x0101010101010101)


def bit_majority(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per run of `lengths` hashes the 64 bits that are set in over half of them (a run of none: 0).

    Eight bits are added at once in the byte lanes of a uint64, over at most 255 hashes, before the sums are widened.
    """
    out = np.zeros(len(lengths), dtype=np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    n = lengths[full]
    first = np.concatenate(([0], np.cumsum(n)[:-1]))
    pieces = -(-n // 255)
    piece_of = np.repeat(np.arange(len(n)), pieces)
    piece_first = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    starts = first[piece_of] + (np.arange(len(piece_of)) - piece_first[piece_of]) * 255
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, starts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), piece_first, axis=0)
        bits = (2 * counts > n[:, None]).astype(np.uint8)
        out[full] |= np.ascontiguousarray(bits).view(np.uint64).ravel() << np.uint64(shift)
    return out


def text_hashes(text: str | None, words: int = SHINGLE) -> list[int]:
    parts = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII white space characters only
    if not parts:
        return []
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return [digest(b" ".join(parts), SEED)]
    return [digest(b" ".join(x), SEED) for x in zip(*(parts[i:] for i in range(words)))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """(id, fingerprint long) of each row; null and wordless texts have fingerprint 0. Rows stay where they are."""

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, lengths = [], []
        for text in batch.column(1):
            own = text_hashes(text.as_py(), words)
            lengths.append(len(own))
            hashes.append(np.array(own, dtype=np.uint64))
        found = bit_majority(np.concatenate(hashes), np.array(lengths, dtype=np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fingerprint"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), per_batch, "id long, fingerprint long")


def embedding(fingerprint):
    """The 32 segment counts as a thermometer code of two bits each (0: 00, 1: 01, 2: 11), so that the Manhattan distance
    of two embeddings is the number of bits in which their codes differ."""
    low = F.lit(0x5555555555555555)
    half = F.shiftrightunsigned(fingerprint, 1)
    some = fingerprint.bitwiseOR(half).bitwiseAND(low)
    both = fingerprint.bitwiseAND(half).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _grids() -> list[int]:
    masks = [0] * GROUPS
    for segment in range(SEGMENTS):
        masks[segment % GROUPS] |= 3 << (2 * segment)
    chosen = [sum(masks[g] for g in c) for c in combinations(range(GROUPS), GROUPS - DISTANCE)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def _thermometer(x: np.ndarray) -> np.ndarray:
    low, half = np.uint64(0x5555555555555555), x >> np.uint64(1)
    return ((x | half) & low) | (((x & half) & low) << np.uint64(1))


def _near(one, many, one_code, many_code) -> np.ndarray:
    maybe = np.flatnonzero(np.bitwise_count(one_code ^ many_code) <= DISTANCE)
    return maybe[np.bitwise_count(one ^ many[maybe]) <= DISTANCE]


def spanning_links(members: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is linked within `members`, at most one fewer than members: a search that expands each
    member once over those not reached yet. No link between components that the members form is lost."""
    codes, left, out = _thermometer(members), np.arange(len(members)), []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            hit = _near(members[node], members[left], codes[node], codes[left])
            if len(hit):
                found = left[hit]
                out += [(node, x) for x in found]
                frontier += found.tolist()
                left = np.delete(left, hit)
    return out


def _pairs(keys: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links in runs of equal keys; short runs all at once by shifts, long ones by a search each."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts, sizes = np.concatenate(([0], cuts)), np.diff(np.concatenate(([0], cuts, [len(keys)])))
    size_of = np.repeat(sizes, sizes)
    a, b = [], []
    short = np.flatnonzero((size_of > 1) & (size_of <= 16))
    k, m, codes = keys[short], members[short], _thermometer(members[short])
    for shift in range(1, int(size_of[short].max(initial=1))):
        i = np.flatnonzero(k[shift:] == k[:-shift])
        i = i[np.bitwise_count(codes[i] ^ codes[i + shift]) <= DISTANCE]
        i = i[np.bitwise_count(m[i] ^ m[i + shift]) <= DISTANCE]
        a.append(m[i])
        b.append(m[i + shift])
    for s, n in zip(starts[sizes > 16], sizes[sizes > 16]):
        links = np.array(spanning_links(members[s : s + n]), dtype=np.int64).reshape(-1, 2)
        a.append(members[s + links[:, 0]])
        b.append(members[s + links[:, 1]])
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _found(a, b, hot_key=None, at=None) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.ascontiguousarray(a).view(np.int64)),
            pa.array(np.ascontiguousarray(b).view(np.int64)),
            pa.array(hot_key if hot_key is not None else [None] * n, pa.int64()),
            pa.array(at if at is not None else [None] * n, pa.int64()),
        ],
        names=["a", "b", "cell", "at"],
    )


def _walk(tile: int):
    """Links of the cells of a sorted partition, holding one cell or a few batches at a time. The members of a cell with
    more than `tile` of them are passed on, numbered, instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, members, hot, passed = np.zeros(0, np.int64), np.zeros(0, np.uint64), None, 0
        for batch in chain(batches, [None]):
            last = batch is None
            if not last:
                keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
                members = np.concatenate([members, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
                if len(keys) < BUFFER:
                    continue
            if hot is not None and len(keys):  # the rest of a cell that is passed on
                n = int(np.searchsorted(keys != hot, True))
                if n:
                    yield _found(members[:n], members[:n], [hot] * n, list(range(passed, passed + n)))
                    passed += n
                keys, members = keys[n:], members[n:]
                if len(keys):
                    hot = None
            if not len(keys):
                continue
            whole = len(keys) if last else int(np.searchsorted(keys == keys[-1], True))
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
            keep = np.ones(whole, dtype=bool)
            for s, e in zip(starts[ends - starts > tile], ends[ends - starts > tile]):
                yield _found(members[s:e], members[s:e], [int(keys[s])] * (e - s), list(range(e - s)))
                if e == len(keys) and not last:
                    hot, passed, whole = int(keys[s]), int(e - s), len(keys)
                    keep = np.concatenate([keep, np.zeros(whole - len(keep), dtype=bool)])
                keep[s:e] = False
            if keep.any():
                a, b = _pairs(keys[:whole][keep], members[:whole][keep])
                if len(a):
                    yield _found(a, b)
            keys, members = keys[whole:], members[whole:]

    return run


_LINKS = "a long, b long, cell long, at long"


def links(distinct: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b) links between different fingerprints of `distinct` (fingerprint) that connect all within 4 bits.

    Every pair within 4 bits meets in a cell of some grid. Inside a cell a spanning set of the verified links is given
    instead of all pairs; a cell that is large is cut into tiles and each pair of tiles is searched in a task's group of
    its own, so nothing is dropped and no task holds more than two tiles of one cell.
    """
    code = embedding(F.col("fingerprint"))
    cells = F.explode(F.array(*[F.xxhash64(F.lit(g), code.bitwiseAND(F.lit(mask))) for g, mask in enumerate(_grids())]))
    dealt = distinct.select(cells.alias("cell"), "fingerprint")
    found = cut(dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(_walk(tile), _LINKS), "near")
    hot = found.where("cell is not null").select("cell", F.col("a").alias("fingerprint"), F.floor(F.col("at") / tile).alias("tile"))
    tiles = hot.groupBy("cell").agg(F.max("tile").alias("tiles"))
    met = hot.join(tiles, "cell").select("cell", "fingerprint", "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles"))).alias("other"))
    pair = F.xxhash64("cell", F.least("tile", "other"), F.greatest("tile", "other")).alias("cell")
    tiled = met.select(pair, "fingerprint").repartition("cell").sortWithinPartitions("cell").mapInArrow(_walk(1 << 40), _LINKS)
    return found.where("cell is null").select("a", "b").unionByName(tiled.select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """One row per row of `docs`: id, fingerprint (long), component_id (the smallest id reachable over links).

    Equal fingerprints are one node, so copies cost nothing beyond their count. Null and empty texts have fingerprint 0
    and link like any other. Null ids are kept but are no one's smallest id, unless all are null. No rows give no rows.
    """
    printed = cut(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = cut(printed.groupBy("fingerprint").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes.select("fingerprint")))
    rooted = nodes.join(roots, nodes.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select(F.col("fingerprint").alias("_f"), "component_id")
    return printed.join(classes, F.col("fingerprint") == F.col("_f")).select("id", "fingerprint", "component_id")


def fingerprint_hex(fingerprint):
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
