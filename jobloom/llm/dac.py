"""Token ids in directly addressable codes.

A segment holds the ids of whole documents, in order. Each id is split into chunks of eight bits; level 0 stores the
lowest chunk of every id, level j the j-th chunk of the ids that reach it. A bitmap per level says which ids go on, and a
rank directory (set bits before each block of 512) turns the place in one level into the place in the next. So the id at
any place is read from one byte, one bit and one rank per level, without decoding what stands before it.

Segments are rows of a Parquet table in the shared folder, numbered by range partition and place in it.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, count, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom.session import cut

END_ID = 2
SEGMENT_TOKENS = 1_000_000
RANK_BITS = 512
#: Entries, and bytes of their texts, after which a worker's memory of encoded pieces starts afresh; it only saves time.
MEMORY = 900_000
MEMORY_BYTES = 32 * 1024 * 1024
#: Texts or pieces that the library encodes in one call; its results take far more room than ids.
AT_ONCE = 200
#: Bytes of the longest piece that is put into one text with others.
LONGEST = 64
#: Bytes of texts that are cut into pieces at once; one text may be longer.
BYTES_AT_ONCE = 4 * 1024 * 1024


class Level(NamedTuple):
    chunks: bytes
    more: bytes
    ranks: bytes


def pack(ids: np.ndarray) -> list[Level]:
    """Levels of the ids (0 to 2^32 - 1); no ids give one empty level."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = np.pad(bits, (0, -len(bits) % (RANK_BITS // 8))).reshape(-1, RANK_BITS // 8)
        before = np.concatenate(([0], np.cumsum(np.bitwise_count(blocks).sum(axis=1, dtype=np.int64))[:-1])) if len(blocks) else []
        levels.append(Level((rest & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), np.asarray(before, dtype="<u4").tobytes()))
        rest = rest[more] >> 8
        if not len(rest):
            return levels


def access(levels: list[Level], place: int) -> int:
    """The id at `place`, by one byte and one rank per level."""
    value = 0
    for j, (chunks, more, ranks) in enumerate(levels):
        value |= chunks[place] << (8 * j)
        if not more[place >> 3] >> (place & 7) & 1:
            return value
        block = place // RANK_BITS
        head = more[block * (RANK_BITS // 8) : place >> 3]
        inside = int.from_bytes(head, "little").bit_count() + (more[place >> 3] & ((1 << (place & 7)) - 1)).bit_count()
        place = int.from_bytes(ranks[4 * block : 4 * block + 4], "little") + inside
    raise ValueError("the last level goes on")


def unpack(levels: list[Level]) -> np.ndarray:
    """All ids of a segment."""
    values = None
    for level in reversed(levels):
        chunks = np.frombuffer(level.chunks, np.uint8).astype(np.uint32)
        if values is not None:
            more = np.unpackbits(np.frombuffer(level.more, np.uint8), count=len(chunks), bitorder="little").astype(bool)
            chunks[more] |= values << np.uint32(8)
        values = chunks
    return values


#: What the library may take for white space. A run of it is cut before a space that it holds in its middle nowhere else
#: than in `_INSIDE`.
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_INSIDE = f"{_SPACE} {_SPACE}"
#: Begins a piece that stands behind a line end, or at the start of a text; texts that hold it are encoded in one go.
_LINE = "\x00"
SIGNS = ".,;:!?"
_CUT = rf"([\pL{SIGNS}])\n(\pL)"
_SIGNED = rf"^\x00?\pL+[{SIGNS}]$"
#: Pieces that are not put into one text with others.
_ODD = rf"{_SPACE}|^\x00?$"


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist


class Encoder:
    """Ids of whole texts by the tokenizers library, remembering pieces that come again.

    The byte-level vocabulary never joins across a space that begins a run of white space or stands before other text, so
    a text is the concatenation of its pieces cut before each such space, and before a line end alone between letters or
    signs. Texts with a space inside longer white space, or with a special token, are encoded in one go.

    The ids of piece n are `ids[bounds[n] : bounds[n + 1]]`; the first pieces are the signs.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A token of a byte-level vocabulary has one character per byte.
        self.width = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.width[number] = len(token)
        self._line = self._encode(["\n"])[0]
        self.known: dict[str, int] = {}
        self.known_bytes = 0
        self.ids, self.bounds = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self._add((), self._encode(list(SIGNS)))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        some = (texts[i : i + AT_ONCE] for i in range(0, len(texts), AT_ONCE))
        return [np.array(e.ids, dtype="<u4") for part in some for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]

    def _alone(self, pieces: list[str]) -> list[np.ndarray]:
        coded = self._encode([p[1:] if p[:1] == _LINE else " " + p for p in pieces])
        return [np.concatenate((self._line, x)) if p[:1] == _LINE else x for p, x in zip(pieces, coded)]

    def _add(self, pieces: Iterable[str], ids: list[np.ndarray], sizes: np.ndarray | None = None) -> np.ndarray:
        """Remember new pieces and their ids: one array for each, or any with the sizes of the pieces. Returns their numbers."""
        sizes = np.array([len(x) for x in ids], dtype=np.int64) if sizes is None else sizes
        first = len(self.bounds) - 1
        self.known.update(zip(pieces, count(first)))
        self.ids = np.concatenate((self.ids, *ids))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
        return np.arange(first, first + len(sizes))

    def _take(self, numbers: np.ndarray, skipped: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these pieces one behind the other, without the first `skipped` of each, and their counts."""
        first = self.bounds[numbers] + skipped
        sizes = self.bounds[numbers + 1] - first
        shift = first + sizes - np.cumsum(sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes

    def _words(self, words: list[str]) -> np.ndarray:
        """Numbers of new words without white space: they are put into one text, whose tokens are told apart by their lengths."""
        coded, sizes = [], []
        for i in range(0, len(words), 10 * AT_ONCE):
            some = words[i : i + 10 * AT_ONCE]
            ids = self._encode([(" " + " ".join(some)).replace(" " + _LINE, "\n")])[0]
            ends = np.cumsum([len(w.encode()) + (w[0] != _LINE) for w in some])
            reached = np.cumsum(self.width[ids])
            cuts = np.searchsorted(reached, ends) + 1
            if np.array_equal(reached[cuts - 1], ends):
                coded.append(ids)
                sizes.append(np.diff(cuts, prepend=0))
            else:
                each = self._alone(some)
                coded += each
                sizes.append([len(x) for x in each])
        return self._add(words, coded, np.concatenate((np.zeros(0, np.int64), *sizes)))

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of new pieces, encoded now; those that end in a sign are made of their word and the sign."""
        long = pc.binary_length(pieces).to_numpy() > LONGEST
        signed, odd = (pc.match_substring_regex(pieces, x).to_numpy(zero_copy_only=False) for x in (_SIGNED, _ODD))
        signed, odd = signed & ~long, odd | long
        plain = ~(signed | odd)
        words, ended, others = (_strings(pieces.filter(pa.array(x))) for x in (plain, signed, odd))
        numbers, stems = np.empty(len(pieces), np.int64), [p[:-1] for p in ended]
        numbers[plain] = self._words(words + list(set(stems).difference(self.known, words)))[: len(words)]
        numbers[odd] = self._add(others, self._alone(others))
        both = np.empty(2 * len(ended), np.int64)
        both[::2] = [self.known[w] for w in stems]
        both[1::2] = [SIGNS.index(p[-1]) for p in ended]
        ids, sizes = self._take(both)
        numbers[signed] = self._add(ended, [ids], sizes[::2] + sizes[1::2])
        return numbers

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids per text."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string())
        whole = pc.match_substring_regex(texts, _INSIDE)
        for sign in (_LINE, *self.special):
            whole = pc.or_(whole, pc.match_substring(texts, sign))
        lines = pc.replace_substring_regex(texts.filter(pc.invert(whole)), _CUT, rf"\1 {_LINE}\2")
        begin, nothing = pa.scalar(_LINE, texts.type), pa.scalar("", texts.type)
        pieces = pc.split_pattern(pc.binary_join_element_wise(begin, lines, nothing), " ")
        coded = pieces.flatten().dictionary_encode()
        names, lengths = _strings(coded.dictionary), pc.binary_length(coded.dictionary).to_numpy()
        numbers = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        if len(self.known) > MEMORY or self.known_bytes > MEMORY_BYTES:  # what is in use now is kept, as it is likely common
            used = np.flatnonzero(numbers >= 0)
            ids, sizes = self._take(np.concatenate((np.arange(len(SIGNS)), numbers[used])))
            self.known, self.ids, self.bounds = {}, ids, np.concatenate(([0], np.cumsum(sizes)))
            numbers[used] = np.arange(len(SIGNS), len(sizes))
            self.known.update((names[i], n) for i, n in zip(used.tolist(), numbers[used].tolist()))
            self.known_bytes = lengths[used].sum()
        new = np.flatnonzero(numbers < 0)
        numbers[new] = self._learn(coded.dictionary.take(pa.array(new)))
        self.known_bytes += lengths[new].sum()
        bounds = pieces.offsets.to_numpy()
        skipped = np.zeros(len(coded), np.int64)
        skipped[bounds[:-1]] = len(self._line)  # no line end stands before a text
        ids, sizes = self._take(numbers[coded.indices.to_numpy()], skipped)
        data, ends = ids.tobytes(), (4 * np.concatenate(([0], np.cumsum(sizes)))[bounds]).tolist()
        cut_up = (data[s:e] for s, e in zip(ends, ends[1:]))
        in_one = iter(self._encode(texts.filter(whole).to_pylist()))
        return [next(in_one).tobytes() if x else next(cut_up) for x in whole.to_pylist()]


def encoder_of(path: str) -> Encoder:
    """The encoder that this worker process keeps between tasks."""
    kept = sys.__dict__.setdefault("_jobloom_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


_SEGMENT = (
    "part int, seq int, first long, n_tokens long, ids array<long>, lengths array<long>, "
    "levels array<struct<chunks: binary, more: binary, ranks: binary>>"
)
_LEVELS = pa.list_(pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]))


def _by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of ids and texts with about `BYTES_AT_ONCE` of texts each."""
    reached = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64)) // BYTES_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(reached)) + 1).tolist(), batch.num_rows]
    return (batch.slice(s, e - s) for s, e in zip(cuts, cuts[1:]) if e > s)


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Encode every text (null: empty), append `end_id`, and store the ids in ascending id order; returns the stored rows.

    Null ids come first; rows with equal ids are ordered by their text. `tokenizer` is the path of a byte-level vocabulary
    file that every executor has. Documents are not cut, so one longer than a segment is a segment by itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        ids, lengths, data, first, size, seq = [], [], [], 0, 0, 0
        end = np.array([end_id], dtype="<u4").tobytes()

        def flush():
            levels = [level._asdict() for level in pack(np.frombuffer(b"".join(data), "<u4"))]
            row = {"part": part, "seq": seq, "first": first, "n_tokens": size, "ids": ids, "lengths": lengths, "levels": levels}
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), _LEVELS)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], names=list(row))

        for batch in chain.from_iterable(map(_by_bytes, batches)):
            for doc, coded in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                n = len(coded) // 4 + 1
                if size and size + n > segment_tokens:
                    yield flush()
                    ids, lengths, data, first, size, seq = [], [], [], first + size, 0, seq + 1
                ids.append(doc)
                lengths.append(n)
                data += (coded, end)
                size += n
        if ids:
            yield flush()

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = chosen.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    return cut(placed.mapInArrow(run, _SEGMENT), "tokens")


def _starts(stored: DataFrame) -> DataFrame:
    """Segments with `start`, the tokens before them. The running sum has one row per range partition."""
    sizes = stored.groupBy(F.col("part").alias("_part")).agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = stored.join(F.broadcast(offsets), F.col("part") == F.col("_part"))
    return joined.select((F.col("_before") + F.col("first")).alias("start"), "n_tokens", "ids", "lengths", "levels")


def _levels(rows: list[dict]) -> list[Level]:
    return [Level(r["chunks"], r["more"], r["ranks"]) for r in rows]


def read_documents(stored: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, from the stored codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, ids, lengths, levels in zip(*(batch.column(c).to_pylist() for c in ("start", "ids", "lengths", "levels"))):
                data = unpack(_levels(levels)).astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(start + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return _starts(stored).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_token(stored: DataFrame, place: int) -> int:
    """The id at `place` of the whole table, by opening its one segment; IndexError beyond the end."""
    row = _starts(stored).where((F.col("start") <= place) & (F.col("start") + F.col("n_tokens") > place)).select("start", "levels").first()
    if row is None:
        raise IndexError(place)
    return access(_levels([r.asDict() for r in row["levels"]]), place - row["start"])
