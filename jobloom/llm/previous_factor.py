"""Suffix-array dedup: bytes that a long enough string which starts earlier covers as well are removed.

A window is a string of LENGTH bytes. Windows are sorted as suffixes are, ties by position; where neighbours agree in at
least LENGTH bytes, the previous smaller position of an entry is its neighbour, and its longest previous factor is at least
LENGTH. So every window but the first of such a stretch starts a copy.

No task sorts all suffixes. A window belongs to the bucket of the smallest hash among its substrings of `gram` bytes, so
equal windows share a bucket, and a run of neighbouring windows with the same smallest hash travels as one piece of text.

1. Each chunk of documents names its buckets: one row per bucket and chunk. Pieces that are equal as a whole are told apart
   by hashes (64 bits inside a bucket), and only the first of them matters.
2. The names meet by bucket. Buckets of one chunk alone, or with a single piece, are settled there.
3. Each chunk sorts the windows of its own buckets, and passes on those first in the chunk whose bucket other chunks have.
4. What was passed on is sorted bucket by bucket. A bucket with very many pieces goes window by window, spread by content.

A bucket has at most one row, and a window at most one, for each chunk, however often it occurs: hot strings are merged
before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import ids_side, map_batches
from jobloom.session import cut

LENGTH = 100
#: Bytes of text after which a chunk ends; the texts of an Arrow batch stay together.
CHUNK_BYTES = 4_000_000
#: Buckets with more pieces than this go window by window.
HOT = 1000
#: Window starts that are hashed at once.
BLOCK = 1 << 19
#: Bytes of pieces whose suffixes are sorted at once; a bucket stays whole.
SORTED_BYTES = 1 << 20

#: Fixed odd numbers that spread bits.
_ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
_LAST = (1 << 63) - 1


class Sizes(NamedTuple):
    length: int = LENGTH
    chunk: int = CHUNK_BYTES
    hot: int = HOT
    block: int = BLOCK

    @property
    def gram(self) -> int:
        """Bytes of the substrings that choose a bucket: a multiple of eight near two fifths of the length."""
        return max(8, self.length * 2 // 5 // 8 * 8)

    @property
    def span(self) -> int:
        """Substrings of a window."""
        return self.length - self.gram + 1


class Pieces(NamedTuple):
    """Runs of windows: first and last start, bucket, hash of the whole text, and whether windows inside may be equal."""

    first: np.ndarray
    last: np.ndarray
    bucket: np.ndarray
    name: np.ndarray
    inner: np.ndarray

    def take(self, at: np.ndarray) -> Pieces:
        return Pieces(*(x[at] for x in self))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_ODD[3])
    return x ^ (x >> np.uint64(29))


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, mixed; seven fewer than bytes."""
    x = text.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    return _mix(x)


def _hash(words: np.ndarray, at, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of the n bytes from each of `at` on (a slice of all places, or an array of them)."""
    offsets = [*range(0, n - 7, 8), *([n - 8] if n % 8 else [])]
    total = np.zeros(at.stop - at.start if isinstance(at, slice) else len(at), dtype=np.uint64)
    for i, o in enumerate(offsets):
        factor = np.uint64(_ODD[i % 3] * (2 * (i + 31 * seed) + 1) % (1 << 64))
        total += (words[at.start + o : at.stop + o] if isinstance(at, slice) else words[at + o]) * factor
    return _mix(total + np.uint64(seed))


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    out, span = x, 1
    while 2 * span <= n:
        out, span = np.minimum(out[:-span], out[span:]), 2 * span
    return np.minimum(out[: len(x) - n + 1], out[n - span : len(x) - span + 1]) if span < n else out


def pieces(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, sizes: Sizes) -> Pieces:
    """The pieces of documents that lie in `text` from `starts` on, followed by at least length + 16 bytes of anything."""
    length, gram, span = sizes.length, sizes.gram, sizes.span
    edge = np.zeros(len(text) + 1, dtype=np.int8)
    long = lengths >= length
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, starts[long] + lengths[long] - length + 1, -1)
    inside = np.cumsum(edge, dtype=np.int8).astype(bool)
    begins = np.zeros(len(text) + 1, dtype=bool)
    begins[starts] = True
    found: list[Pieces] = []
    end = int((starts + lengths).max(initial=0))
    for low in range(0, end, sizes.block):
        high = min(low + sizes.block, end)
        ok = inside[low:high]
        if not ok.any():
            continue
        words = _words(text[low : high + length + 15])
        grams = _hash(words, slice(0, high - low + span - 1), gram)
        least = _sliding_min(grams, span)
        new = np.ones(high - low, dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | ~ok[:-1] | begins[low + 1 : high]
        first = np.flatnonzero(new & ok)
        stop = np.ones(high - low, dtype=bool)
        stop[:-1] = new[1:] | ~ok[1:]
        last = np.flatnonzero(stop & ok)
        # Runs of equal smallest hashes are cut so that the first and the last window of a piece touch.
        parts = (last - first) // span + 1
        turn = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, last = np.repeat(first, parts) + turn * span, np.repeat(last, parts)
        last = np.minimum(last, first + span - 1)
        # Equal windows inside a piece need its smallest substring twice: in the first window, or entering later.
        entering = np.cumsum(grams[span - 1 :] == least)
        twice = (np.lib.stride_tricks.sliding_window_view(grams, span)[first] == least[first, None]).sum(axis=1) > 1
        name = _mix(_hash(words, first, length) * np.uint64(_ODD[1]) + _hash(words, last, length) * np.uint64(_ODD[2]) + (last - first).astype(np.uint64))
        found.append(Pieces(first + low, last + low, least[first], name, twice | (entering[last] > entering[first])))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return Pieces(none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool))
    return Pieces(*(np.concatenate(x) for x in zip(*found)))


def _runs_of(keys: np.ndarray) -> np.ndarray:
    """True where a sorted array shows a new value."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return new


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for each i, counts[i] of them."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def copies(text: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """For each window start of `text` (ascending), whether its longest previous factor among them reaches `length`.

    Suffixes are ranked by their first 8, 16, 32, ... bytes, each time from the ranks of halves, then by `length` bytes.
    """
    padded = np.concatenate([text, np.zeros(2 * length + 8, dtype=np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        padded = (padded[:-step] << np.uint64(8 * step)) | padded[step:]
    ranks, span = np.unique(padded, return_inverse=True)[1].astype(np.uint64), 8
    while 2 * span <= length:
        ranks, span = np.unique((ranks[:-span] << np.uint64(32)) | ranks[span:], return_inverse=True)[1].astype(np.uint64), 2 * span
    order_key = (ranks[windows] << np.uint64(32)) | ranks[windows + (length - span)]
    suffixes = np.argsort(order_key, kind="stable")
    agree = ~_runs_of(order_key[suffixes])
    out = np.zeros(len(windows), dtype=bool)
    out[suffixes[agree]] = True
    return out


def _batches_of(buckets: np.ndarray, weights: np.ndarray, most: int = SORTED_BYTES) -> Iterator[np.ndarray]:
    """Places of whole buckets, about `most` by weight at a time."""
    order = np.argsort(buckets, kind="stable")
    new = np.flatnonzero(_runs_of(buckets[order]))
    ends = np.append(new[1:], len(order))
    total = np.concatenate(([0], np.cumsum(weights[order])))
    at = 0
    while at < len(new):
        upto = max(int(np.searchsorted(total[ends], total[new[at]] + most, side="right")), at + 1)
        yield order[new[at] : ends[upto - 1]]
        at = upto


_FOUND = "kind int, row long, place long, start long, stop long, bucket long, other long, text binary"
_FIELDS = pa.schema([("kind", pa.int32()), ("row", pa.int64()), ("place", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("bucket", pa.int64()), ("other", pa.int64()), ("text", pa.binary())])
_GONE, _PIECE, _WINDOW = 0, 1, 2


def _rows(kind: int, **columns) -> pa.RecordBatch:
    n = len(columns["row"])
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FIELDS if f.name != "kind"]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, dtype=np.int32)), *arrays], schema=_FIELDS)


def _ranges(flags: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the stretches of flagged neighbours among the places `at`."""
    chosen = at[flags]
    new = np.ones(len(chosen), dtype=bool)
    new[1:] = chosen[1:] != chosen[:-1] + 1
    return chosen[new], chosen[np.append(np.flatnonzero(new)[1:] - 1, len(chosen) - 1)] if len(chosen) else chosen


class _Chunk:
    """The texts of a chunk, in order, one after the other."""

    def __init__(self, rows: np.ndarray, places: np.ndarray, coded: list[bytes], sizes: Sizes):
        order = np.lexsort((rows, places))
        self.rows, self.places = rows[order], places[order]
        self.lengths = np.array([len(coded[i]) for i in order], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.text = np.frombuffer(b"".join([coded[i] for i in order]) + bytes(sizes.length + 16), dtype=np.uint8)
        self.pieces = pieces(self.text, self.starts, self.lengths, sizes)

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1 if len(at) else at


def _chunks(batches: Iterator[pa.RecordBatch], sizes: Sizes) -> Iterator[tuple[int, bool, pa.RecordBatch | None]]:
    """(chunk, False, batch) for each batch of row, place, text and (chunk, True, None) where a chunk ends."""
    number, size = TaskContext.get().partitionId() << 24, 0
    for batch in batches:
        if batch.num_rows:
            yield number, False, batch
            size += batch.column(2).nbytes
            if size >= sizes.chunk:
                yield number, True, None
                number, size = number + 1, 0
    yield number, True, None


def _coded(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _names(sizes: Sizes):
    """One row per bucket of each chunk: the first piece's hash and place, and how many different pieces there are (at
    least two if windows inside a piece may be equal)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for number, ends, batch in _chunks(batches, sizes):
            if not ends:
                held.append(batch)
                continue
            if not held:
                continue
            whole, held = pa.Table.from_batches(held), []
            chunk = _Chunk(whole.column(0).to_numpy(), whole.column(1).to_numpy(), [c for x in whole.column(2).chunks for c in _coded(x)], sizes)
            p = chunk.pieces
            if not len(p.first):
                continue
            order = np.lexsort((p.first, p.name, p.bucket))
            p = p.take(order)
            new = _runs_of(p.bucket)
            group = np.cumsum(new) - 1
            different = np.bincount(group, weights=_runs_of(p.name) | new)
            inner = np.bincount(group, weights=p.inner) > 0
            earliest = np.lexsort((p.first, group))[np.flatnonzero(new)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(p.bucket[earliest].view(np.int64)),
                    pa.array(p.name[earliest].view(np.int64)),
                    pa.array(chunk.places[chunk.document(p.first[earliest])]),
                    pa.array(np.full(len(earliest), number)),
                    pa.array((different + inner).astype(np.int64)),
                ],
                names=["bucket", "name", "place", "chunk", "pieces"],
            )

    return run


_PACKED = "chunk long, rows array<long>, places array<long>, sizes array<long>, texts binary"


def _packed(sizes: Sizes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for number, ends, batch in _chunks(batches, sizes):
            if not ends:
                coded = _coded(batch.column(2))
                row = [[number], [batch.column(0)], [batch.column(1)], [[len(c) for c in coded]], [codec.compress(b"".join(coded), asbytes=True)]]
                types = (pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=["chunk", "rows", "places", "sizes", "texts"])

    return run


def _unpacked(packed: pa.Table, sizes: Sizes) -> _Chunk:
    codec, coded = pa.Codec("zstd"), []
    for lengths, blob in zip(packed.column("sizes").to_pylist(), packed.column("texts")):
        ends = np.cumsum(lengths).tolist()
        whole = codec.decompress(blob.as_py(), decompressed_size=ends[-1], asbytes=True) if ends[-1] else b""
        coded += [whole[e - n : e] for e, n in zip(ends, lengths)]
    flat = lambda name: packed.column(name).combine_chunks().flatten().to_numpy()
    return _Chunk(flat("rows"), flat("places"), coded, sizes)


def _window_hashes(text: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    out, step = np.zeros(len(at), dtype=np.uint64), 1 << 14
    for low in range(0, len(at), step):
        part = at[low : low + step]
        whole = text[_spread(part, np.full(len(part), length))]
        out[low : low + step] = _hash(_words(np.concatenate([whole, np.zeros(8, np.uint8)])), np.arange(len(part)) * length, length, seed)
    return out


_COPY, _SORT, _SPREAD = 1, 2, 3


def _settle_chunk(sizes: Sizes):
    """What is a copy inside a chunk or of a bucket's first piece elsewhere, and what other buckets' parts must see."""
    length = sizes.length

    def run(verdicts: pa.Table, packed: pa.Table) -> pa.Table:
        if not packed.num_rows:
            raise RuntimeError("the documents were read in other partitions the second time; write them to a table first")
        chunk = _unpacked(packed, sizes)
        out: list[pa.RecordBatch] = []

        def gone(first: np.ndarray, last: np.ndarray) -> None:
            d = chunk.document(first)
            out.append(_rows(_GONE, row=chunk.rows[d], start=first - chunk.starts[d], stop=last + length - chunk.starts[d], other=chunk.lengths[d]))

        p = chunk.pieces
        p = p.take(np.lexsort((p.first, p.name, p.bucket)))
        new = _runs_of(p.bucket)
        fresh = _runs_of(p.name) | new
        gone(p.first[~fresh], p.last[~fresh])
        p, new = p.take(fresh), new[fresh]  # the first of a bucket is the first of its name
        asked = verdicts.column("bucket").combine_chunks().to_numpy().view(np.uint64) if verdicts.num_rows else np.zeros(0, np.uint64)
        by_bucket = np.argsort(asked)
        known = np.searchsorted(p.bucket, asked)
        if len(asked) and (len(p.bucket) == 0 or (p.bucket[np.minimum(known, len(p.bucket) - 1)] != asked).any()):
            raise RuntimeError("the documents were read in other partitions the second time; write them to a table first")
        verdict = np.zeros(len(p.first), dtype=np.int64)
        if len(asked):
            at = np.minimum(np.searchsorted(asked[by_bucket], p.bucket), len(asked) - 1)
            hit = asked[by_bucket][at] == p.bucket
            verdict[hit] = verdicts.column("verdict").combine_chunks().to_numpy()[by_bucket][at[hit]]
        gone(p.first[verdict == _COPY], p.last[verdict == _COPY])
        group = np.cumsum(new) - 1
        several = (np.bincount(group, minlength=1) > 1)[group] | (np.bincount(group, weights=p.inner, minlength=1) > 0)[group] if len(group) else verdict.astype(bool)
        open_ = np.flatnonzero((verdict != _COPY) & (several | (verdict > 0)))
        p, verdict, several = p.take(open_), verdict[open_], several[open_]
        for some in _batches_of(p.bucket, p.last - p.first + length):
            some = some[np.argsort(p.first[some], kind="stable")]  # position order; buckets may mix
            first, count = p.first[some], p.last[some] - p.first[some] + 1
            starts = _spread(first, count)
            owner = np.repeat(np.arange(len(some)), count)
            repeated = np.zeros(len(starts), dtype=bool)
            mine = np.flatnonzero(several[some])
            if len(mine):
                text = chunk.text[_spread(first[mine], count[mine] + length - 1)]
                begins = np.cumsum(count[mine] + length - 1) - (count[mine] + length - 1)
                repeated[several[some][owner]] = copies(text, _spread(begins, count[mine]), length)
            gone(*_ranges(repeated, starts))
            for code in (_SORT, _SPREAD):
                passed = ~repeated & (verdict[some] == code)[owner]
                at, of = starts[passed], owner[passed]
                if not len(at):
                    continue
                if code == _SORT:
                    edge = np.ones(len(at), dtype=bool)
                    edge[1:] = (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])
                    low, high = at[edge], at[np.append(np.flatnonzero(edge)[1:] - 1, len(at) - 1)]
                    d = chunk.document(low)
                    texts = [chunk.text[a : b + length].tobytes() for a, b in zip(low.tolist(), high.tolist())]
                    out.append(_rows(_PIECE, row=chunk.rows[d], place=chunk.places[d], start=low - chunk.starts[d], bucket=p.bucket[some][of[edge]].view(np.int64), other=chunk.lengths[d], text=texts))
                else:
                    d = chunk.document(at)
                    hashes = [_window_hashes(chunk.text, at, length, seed).view(np.int64) for seed in (1, 2)]
                    out.append(_rows(_WINDOW, row=chunk.rows[d], place=chunk.places[d], start=at - chunk.starts[d], stop=chunk.lengths[d], bucket=hashes[0], other=hashes[1]))
        return pa.Table.from_batches(out, schema=_FIELDS)

    return run


def _settle_buckets(length: int):
    """Copies among the pieces of whole buckets; rows come sorted by bucket and position."""

    def found(rows: pa.Table) -> pa.RecordBatch:
        order = np.lexsort([rows.column(c).to_numpy() for c in ("start", "row", "place")])
        rows = rows.take(pa.array(order))
        texts = rows.column("text").to_pylist()
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        count = sizes - length + 1
        repeated = copies(np.frombuffer(b"".join(texts), dtype=np.uint8), _spread(np.cumsum(sizes) - sizes, count), length)
        owner = np.repeat(np.arange(len(texts)), count)
        at = _spread(rows.column("start").to_numpy(), count)[repeated]
        of = owner[repeated]
        edge = np.ones(len(at), dtype=bool)
        edge[1:] = (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])
        last = at[np.append(np.flatnonzero(edge)[1:] - 1, len(at) - 1)] if len(at) else at
        of = of[edge]
        return _rows(_GONE, row=rows.column("row").to_numpy()[of], start=at[edge], stop=last + length, other=rows.column("other").to_numpy()[of])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, before = [], 0, None
        for batch in batches:
            buckets = batch.column(batch.schema.get_field_index("bucket")).to_numpy()
            new = _runs_of(buckets)
            new[0] = before is not None and buckets[0] != before
            if size >= SORTED_BYTES and new.any():
                at = int(np.flatnonzero(new)[-1])
                yield found(pa.Table.from_batches([*held, batch.slice(0, at)]))
                held, size, batch = [], 0, batch.slice(at)
            held.append(batch)
            size, before = size + batch.nbytes, buckets[-1]
        if held:
            yield found(pa.Table.from_batches(held))

    return run


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, place, text: rows in the order of their files, places in the order of ids, null ids last."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("place"), F.col(text_col).alias("text")
    )


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """(row, start, stop, size): bytes of rows that earlier strings cover, in pieces that may overlap. `row` numbers the
    rows of `docs` by partition and place, as monotonically_increasing_id does; `size` is the text's number of bytes."""
    if sizes.length < 16:
        raise ValueError("strings of fewer than 16 bytes are not searched")
    chosen = _numbered(docs, id_col, text_col)
    names = chosen.mapInArrow(_names(sizes), "bucket long, name long, place long, chunk long, pieces long")
    bucket, name = Window.partitionBy("bucket"), Window.partitionBy("bucket", "name").orderBy("place", "chunk")
    met = names.select(
        "*", F.count("*").over(bucket).alias("chunks"), F.sum("pieces").over(bucket).alias("all"),
        ((F.min("name").over(bucket) != F.max("name").over(bucket)) | (F.max("pieces").over(bucket) > 1)).alias("several"),
    ).where("chunks > 1")
    copy = (F.col("pieces") == 1) & (F.row_number().over(name) > 1)
    told = met.select("chunk", "bucket", F.when(copy, _COPY).when(~F.col("several"), 0).when(F.col("all") <= sizes.hot, _SORT).otherwise(_SPREAD).alias("verdict"))
    verdicts = told.where("verdict > 0")
    packed = chosen.mapInArrow(_packed(sizes), _PACKED)
    found = cut(verdicts.groupBy("chunk").cogroup(packed.groupBy("chunk")).applyInArrow(_settle_chunk(sizes), _FOUND), "repeats")

    gone = found.where(F.col("kind") == _GONE)
    sorted_ = found.where(F.col("kind") == _PIECE).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_settle_buckets(sizes.length), _FOUND)
    same = Window.partitionBy("bucket", "other").orderBy("place", "row", "start")
    spread = found.where(F.col("kind") == _WINDOW).withColumn("turn", F.row_number().over(same)).where("turn > 1")
    late = spread.select("row", "start", (F.col("start") + sizes.length).alias("stop"), F.col("stop").alias("size"))
    early = gone.unionByName(sorted_).select("row", "start", "stop", F.col("other").alias("size"))
    return early.unionByName(late)


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges joined."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _cut_out(batch: pa.RecordBatch) -> pa.RecordBatch:
    """id, n_bytes, spans and the bytes left of each row."""
    spans, left = [], []
    for text, found, size in zip(_coded(batch.column("text")), batch.column("found").to_pylist(), batch.column("size").to_pylist()):
        if len(text) != size:
            raise RuntimeError("the documents were read in other partitions the second time; write them to a table first")
        own = merged([(x["start"], x["stop"]) for x in found])
        edges = [0, *[e for span in own for e in span], len(text)]
        spans.append([{"start": a, "stop": b} for a, b in own])
        left.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("size"), pa.array(spans, span), pa.array(left, pa.binary())], names=["id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, spans (start and stop of what goes, in bytes) and kept, the bytes left.

    A byte goes if a string of `sizes.length` bytes around it also starts earlier: in a row with a smaller id, or earlier
    in the same row. Rows that share an id are ordered as in their files; null ids come last. Null texts are empty; empty
    and short texts are kept whole, no rows give no rows, and other columns of `docs` do not matter. All is judged on the
    texts as they come in.

    `docs` is read three times and must fall into the same partitions each time, as files do; it is an error if not.
    """
    found = cut(repeats(docs, id_col, text_col, sizes), "ranges")
    spans = found.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("found"), F.max("size").alias("size"))
    touched = ids_side(found.select("row").distinct())
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    whole = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    untouched = rows.join(touched, "row", "left_anti").select("id", F.octet_length(whole).cast("long").alias("n_bytes"), none.alias("spans"), whole.alias("kept"))
    changed = map_batches(
        rows.join(touched, "row", "left_semi").join(spans, "row").select("id", "text", "found", "size"),
        _cut_out,
        f"id {dict(rows.dtypes)['id']}, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary",
    )
    return untouched.unionByName(changed)
