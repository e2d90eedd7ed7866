"""Benchmark decontamination over a distributed positional inverted index.

The index is cut by documents: a chunk holds the whole documents of a stretch of a scan task, laid out on one axis of
word positions with a gap after each, and one posting list (sorted positions) per term. It is stored once in the shared
folder. A search brings the stored lists of a chunk together and, for each test phrase, starts from the list of its
rarest term (by count over the whole index), intersects with the next rarest after shifting by the terms' offsets, and
stops at the first empty result. Proximity matches start from the rarest term as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.session import cut

WINDOW = 10
#: Word positions of one chunk of the index.
CHUNK_WORDS = 4_000_000
#: Empty positions after each document; longer than a window or a proximity span.
GAP = 128
_INDEX = "chunk string, term string, n long, postings binary, doc_ids array<long>, starts array<long>, lengths array<long>"
#: Bytes that are no word characters become spaces, A-Z become small letters.
_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words [0-9a-z or above ASCII]+ of the text with A-Z lower-cased, as UTF-8."""
    return (text or "").encode().translate(_WORD_BYTES).split()


def _index_rows(chunk: str, ids: list, lengths: list[int], terms: list[bytes], found: np.ndarray, at: np.ndarray, starts: list[int]):
    order = np.argsort(found, kind="stable")
    found, at = found[order], at[order]
    cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
    firsts = np.concatenate(([0], cuts)) if len(found) else np.zeros(0, np.int64)
    lasts = np.concatenate((cuts, [len(found)])) if len(found) else firsts
    rows = [(terms[found[f]].decode(), int(e - f), at[f:e].astype("<u4").tobytes()) for f, e in zip(firsts, lasts)]
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([chunk] * (n + 1)),
            pa.array([None, *(r[0] for r in rows)], pa.string()),
            pa.array([len(ids), *(r[1] for r in rows)], pa.int64()),
            pa.array([None, *(r[2] for r in rows)], pa.binary()),
            pa.array([ids, *[None] * n], pa.list_(pa.int64())),
            pa.array([starts, *[None] * n], pa.list_(pa.int64())),
            pa.array([lengths, *[None] * n], pa.list_(pa.int64())),
        ],
        names=["chunk", "term", "n", "postings", "doc_ids", "starts", "lengths"],
    )


def build_index(docs: DataFrame, vocabulary: set[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Store the positions of the terms of all `docs` and read them back.

    `vocabulary` pushes a query's terms down into the index, as a column list does for a scan; None keeps every term.
    A row without a term is the chunk's directory: ids, starts and lengths in words of its documents, wordless and null
    texts included. Documents are never cut, so one longer than `chunk_words` is a chunk by itself.
    """
    wanted = None if vocabulary is None else {w: i for i, w in enumerate(sorted(vocabulary))}
    shared = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        number = dict(shared.value) if shared is not None else {}
        terms = list(number)
        ids, starts, lengths, found, at, end = [], [], [], [], [], 0

        def flush():
            none = np.zeros(0, np.int64)
            return _index_rows(f"{task}-{seq}", ids, lengths, terms, np.concatenate([none, *found]), np.concatenate([none, *at]), starts)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                if shared is None:
                    for w in set(words):
                        if w not in number:
                            number[w] = len(terms)
                            terms.append(w)
                term = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
                here = np.flatnonzero(term >= 0)
                found.append(term[here])
                at.append(here + end)
                ids.append(doc)
                starts.append(end)
                lengths.append(len(words))
                end += len(words) + GAP
                if end >= chunk_words:
                    yield flush()
                    ids, starts, lengths, found, at, end, seq = [], [], [], [], [], 0, seq + 1
                    if shared is None:
                        number, terms = {}, []
        if ids:
            yield flush()

    return cut(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _INDEX), "postings")


@dataclass
class Phrases:
    """Test windows: item number, terms, and the order in which their lists are intersected, rarest first."""

    items: list
    windows: list[tuple[int, list[str]]]

    def vocabulary(self) -> set[bytes]:
        return {w.encode() for _, terms in self.windows for w in terms}


def windows_of(items: list[tuple[object, str | None]], window: int = WINDOW) -> Phrases:
    """All runs of `window` words of each item; an item of fewer words, but not none, is one window. Equal windows of an
    item count once."""
    out = []
    for number, (_, text) in enumerate(items):
        words = [w.decode() for w in words_of(text)]
        runs = {tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else set()
        out += [(number, list(r)) for r in sorted(runs)]
    return Phrases([i for i, _ in items], out)


def _meet(lists: dict[str, np.ndarray], terms: list[str], rank: dict[str, int]) -> np.ndarray:
    """Starts of the exact phrase: shifted lists intersected from the rarest on."""
    order = sorted(range(len(terms)), key=lambda i: (rank.get(terms[i], 0), i))
    if any(t not in lists for t in terms):
        return np.zeros(0, np.int64)
    at = lists[terms[order[0]]] - order[0]
    for i in order[1:]:
        if not len(at):
            break
        other = lists[terms[i]]
        place = np.minimum(np.searchsorted(other, at + i), len(other) - 1)
        at = at[other[place] == at + i]
    return at


def _close(lists: dict[str, np.ndarray], terms: list[str], rank: dict[str, int], span: int) -> np.ndarray:
    """Positions of the rarest term that have every other term of the phrase at most `span` words away."""
    distinct = sorted(set(terms), key=lambda t: (rank.get(t, 0), t))
    if any(t not in lists for t in distinct):
        return np.zeros(0, np.int64)
    at = lists[distinct[0]]
    for t in distinct[1:]:
        if not len(at):
            break
        other = lists[t]
        right = np.searchsorted(other, at)
        after = other[np.minimum(right, len(other) - 1)]
        before = other[np.maximum(right - 1, 0)]
        at = at[np.minimum(np.abs(after - at), np.abs(at - before)) <= span]
    return at


_MATCH = "chunk string, doc int, doc_id long, item int, kind string, first long, last long"


def search(index: DataFrame, phrases: Phrases, span: int | None = None) -> DataFrame:
    """Matches of the phrases: chunk, doc (number in the chunk), doc_id, item (number in `phrases`), kind, and the first
    and one past the last word. Exact matches of an item that touch or overlap are joined. `span` also gives proximity
    matches, as the place of the rarest term.

    Collected to the driver: counts of the phrases' terms, which the phrases bound. One group is one chunk.
    """
    spark = index.sparkSession
    vocabulary = {w.decode() for w in phrases.vocabulary()}
    counts = index.where("term is not null").groupBy("term").agg(F.sum("n").alias("n"))
    known = spark.createDataFrame([(w,) for w in vocabulary], "term string") if vocabulary else None
    rank = {r["term"]: r["n"] for r in counts.join(known, "term", "left_semi").collect()} if known is not None else {}
    shared = spark.sparkContext.broadcast((phrases.windows, rank))
    if span is not None and span >= GAP:
        raise ValueError(f"span must be below {GAP}")

    def run(chunk: pa.Table) -> pa.Table:
        windows, rank = shared.value
        lists, ids, starts = {}, [], np.zeros(0, np.int64)
        for term, postings, doc_ids, firsts in zip(*(chunk.column(c).to_pylist() for c in ("term", "postings", "doc_ids", "starts"))):
            if term is None:
                ids, starts = doc_ids, np.array(firsts, dtype=np.int64)
            elif term in rank:
                lists[term] = np.frombuffer(postings, dtype="<u4").astype(np.int64)
        spans: dict[tuple[int, str], list] = {}
        for item, terms in windows:
            at = _meet(lists, terms, rank)
            if len(at):
                spans.setdefault((item, "exact"), []).append(np.stack([at, at + len(terms)]))
            if span is not None:
                at = _close(lists, terms, rank, span)
                if len(at):
                    spans.setdefault((item, "near"), []).append(np.stack([at, at + 1]))
        out = []
        for (item, kind), several in spans.items():
            first, last = np.concatenate(several, axis=1)
            order = np.argsort(first, kind="stable")
            first, last = first[order], np.maximum.accumulate(last[order])
            begins = np.concatenate(([True], first[1:] > last[:-1]))
            ends = np.concatenate((begins[1:], [True]))
            doc = np.searchsorted(starts, first[begins], side="right") - 1
            out += [(int(d), ids[d], item, kind, int(f - starts[d]), int(e - starts[d])) for d, f, e in zip(doc, first[begins], last[ends])]
        name = chunk.column("chunk")[0].as_py()
        columns = list(zip(*out)) or [[]] * 6
        types = (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        return pa.table(
            [pa.array([name] * len(out), pa.string()), *(pa.array(c, t) for c, t in zip(columns, types))],
            names=["chunk", "doc", "doc_id", "item", "kind", "first", "last"],
        )

    return index.groupBy("chunk").applyInArrow(run, _MATCH)


#: Words of test items that are searched for at once; more are searched for in several passes over the stored index.
PASS_WORDS = 1_000_000


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, item_ids (sorted strings), contaminated.

    Texts that are null or wordless have no words and are clean. An item without an id marks words as hit but is not
    counted or listed; repeated items and ids count once. No items: all clean. Items are the stated query set and are
    read in passes of PASS_WORDS words; documents stay on the executors.
    """
    passes: list[list[tuple]] = [[]]
    size = 0
    for row in items.select(item_col, item_text).distinct().orderBy(item_col, item_text).toLocalIterator():
        passes[-1].append((row[0], row[1]))
        size += len(row[1] or "") // 2
        if size >= PASS_WORDS:
            passes.append([])
            size = 0
    phrases = [windows_of(p, window) for p in passes]
    index = build_index(docs, set().union(*(p.vocabulary() for p in phrases)), id_col, text_col)
    found = None
    for p in phrases:
        labels = docs.sparkSession.createDataFrame([(i, None if x is None else str(x)) for i, x in enumerate(p.items)] or [(-1, None)], "item int, label string")
        one = search(index, p).join(F.broadcast(labels), "item").select("chunk", "doc", "label", "first", "last")
        found = one if found is None else found.unionByName(one)
    found = cut(found, "matches")
    key = ["chunk", "doc"]
    hits = found.select(*key, F.explode(F.expr("sequence(first, last - 1)")).alias("word")).distinct().groupBy(*key).agg(F.count("*").alias("n_hit"))
    named = found.groupBy(*key).agg(F.array_sort(F.collect_set("label")).alias("item_ids"))
    listed = index.where("term is null").select("chunk", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("doc", "d"))
    all_docs = listed.select(*key, F.col("d.doc_ids").alias("doc_id"), F.col("d.lengths").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    names = F.coalesce("item_ids", F.array().cast("array<string>"))
    return all_docs.join(hits.join(named, key), key, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"), names.alias("item_ids"), (n_hit > 0).alias("contaminated")
    )
