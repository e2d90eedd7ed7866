"""Quality classifier: an interpolated modified Kneser-Ney model of character n-grams, trained on trusted text.

An n-gram of order 4 is four 16-bit characters in one long, so no n-gram is merged with another and the model grows with
the text. Counts of trusted text are merged by a shuffle sharded on the n-gram and turned into probabilities by joins with
their contexts and with the next shorter n-grams.

Scoring is a sharded join as well. Documents are taken in chunks, stretches of a scan task; each chunk asks once for each
of its different n-grams. The questions meet the model's shards, the answers go back by chunk and meet the chunk's
compressed texts there. Nothing is sent through the driver or broadcast, and a task holds one chunk at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import ids_side
from jobloom.session import cut

ORDER = 4
BITS = 16
EDGE = 0  # before and after a text
FOLDS = 5
#: Characters after which a chunk ends; the texts of an Arrow batch stay together.
CHUNK_CHARACTERS = 16_000_000
#: Characters that are looked up at once.
AT_ONCE = 1 << 20
#: Symbols of a block, a stretch of a text whose mean bits are looked at by themselves.
BLOCK = 128


class Model(NamedTuple):
    """grams[k]: (gram, p) of order k + 1, interpolated; contexts[k]: (context, gamma) of order k, the weight that a
    context leaves to the shorter n-grams; uniform: the probability of a character before any is known."""

    grams: list[DataFrame]
    contexts: list[DataFrame]
    uniform: float


def last(gram: Column, k: int) -> Column:
    """The last k characters of an n-gram."""
    return gram if k == ORDER else gram.bitwiseAND(F.lit((1 << (BITS * k)) - 1))


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the n-grams at all places of the texts, each with three edges before it and one after it; whether each lies
    in one text; and where each text's own begin. Characters above 16 bits share the 2,048 codes that no character has."""
    joined = ("\0" * (ORDER - 1)) + ("\0" * ORDER).join(t.replace("\0", " ") for t in texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    high = points >= 1 << BITS
    points[high] = 0xD800 | (points[high] & 0x7FF)
    codes = points[: len(points) - ORDER + 1].copy()
    for i in range(1, ORDER):
        codes = (codes << BITS) | points[i : len(points) - ORDER + 1 + i]
    starts = np.concatenate(([0], np.cumsum([len(t) + ORDER for t in texts])[:-1])).astype(np.int64)
    inside = np.ones(len(codes), dtype=bool)
    for back in range(1, ORDER):
        inside[starts[1:] - back] = False
    return codes, inside, starts


def _pieces(texts: list[str], most: int = AT_ONCE) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about `most` characters, with the number of each run's first text."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield begin, texts[begin : i + 1]
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, texts[begin:]


def count_ngrams(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram long, n long) over whole texts; empty and null texts count nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, piece in _pieces([t for t in batch.column(0).to_pylist() if t]):
                codes, inside, _ = windows(piece)
                counts = pc.value_counts(pa.array(codes[inside]))
                yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["gram", "n"])

    return texts.select(F.col(text_col).alias("text")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more (Chen and Goodman), from the counts of counts."""
    row = counts.agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in range(1, 5)]).first()
    n1, n2, n3, n4 = (row[f"n{i}"] for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return [min(max(d, 0.05), top) for d, top in zip(raw, (0.95, 1.9, 2.85))]


def train(trusted: DataFrame, text_col: str = "text") -> Model:
    """The model of all texts of `trusted`. Lower orders count the distinct n-grams that they end. All are joins of counts
    sharded by n-gram or context. No text gives a model in which every character has probability 1."""
    counts = [None] * ORDER
    counts[-1] = cut(count_ngrams(trusted, text_col), "ngrams")
    for k in range(ORDER - 2, -1, -1):
        counts[k] = counts[k + 1].groupBy(last(F.col("gram"), k + 1).alias("gram")).agg(F.count("*").alias("n"))
    uniform = 1.0 / (counts[0].count() + 1)  # all characters that were never seen count as one
    grams, contexts = [], []
    for k in range(ORDER):
        d1, d2, d3 = _discounts(counts[k])
        cost = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        each = counts[k].select("gram", F.shiftrightunsigned("gram", BITS).alias("context"), "n", F.least(cost, F.col("n").cast("double")).alias("cost"))
        context = each.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("cost") / F.sum("n")).alias("gamma"))
        contexts.append(cut(context, "contexts"))
        joined = each.join(contexts[-1], "context")
        if k:
            shorter = grams[-1].select(F.col("gram").alias("ending"), F.col("p").alias("q"))
            joined = joined.withColumn("ending", last(F.col("gram"), k)).join(shorter, "ending")
        else:
            joined = joined.withColumn("q", F.lit(uniform))
        grams.append(cut(joined.select("gram", ((F.col("n") - F.col("cost")) / F.col("total") + F.col("gamma") * F.col("q")).alias("p")), "probabilities"))
    return Model(grams, contexts, uniform)


def probabilities(wanted: DataFrame, model: Model) -> DataFrame:
    """(gram, p) of each distinct n-gram of `wanted` (gram), seen or not: an unseen one takes its context's weight (1 if
    that is unseen too) times the probability of its last characters, which are looked up first, shortest to longest."""
    found = None
    for k in range(ORDER):
        asked = wanted.select(last(F.col("gram"), k + 1).alias("gram"))
        asked = (asked if k == ORDER - 1 else asked.distinct()).withColumn("context", F.shiftrightunsigned("gram", BITS))
        met = asked.join(model.grams[k], "gram", "left").join(model.contexts[k].select("context", "gamma"), "context", "left")
        if k:
            shorter = found.select(F.col("gram").alias("ending"), F.col("p").alias("q"))
            met = met.withColumn("ending", last(F.col("gram"), k)).join(shorter, "ending")
        else:
            met = met.withColumn("q", F.lit(model.uniform))
        found = met.select("gram", F.coalesce("p", F.coalesce("gamma", F.lit(1.0)) * F.col("q")).alias("p"))
    return found


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bool, pa.RecordBatch | None, list[str]]]:
    """(chunk, False, batch, its texts) for each batch, and (chunk, True, None, []) where a chunk ends."""
    part, number, size = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        if batch.num_rows:
            texts = [t or "" for t in batch.column(3).to_pylist()]
            yield f"{part}-{number}", False, batch, texts
            size += sum(map(len, texts))
            if size >= CHUNK_CHARACTERS:
                yield f"{part}-{number}", True, None, []
                number, size = number + 1, 0
    yield f"{part}-{number}", True, None, []


def _questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different n-grams of each chunk."""
    known = np.zeros(0, dtype=np.int64)
    for chunk, ends, _, texts in _chunks(batches):
        for _, piece in _pieces(texts):
            codes, inside, _ = windows(piece)
            known = np.union1d(known, pc.unique(pa.array(codes[inside])).to_numpy())
        if ends and len(known):
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([known], pa.list_(pa.int64()))], names=["chunk", "grams"])
            known = np.zeros(0, dtype=np.int64)


_PACKED = "chunk string, id array<long>, lang array<string>, fold array<int>, bytes array<long>, texts binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each batch, compressed together, with their chunk."""
    codec = pa.Codec("zstd")
    for chunk, ends, batch, texts in _chunks(batches):
        if not ends:
            coded = [t.encode() for t in texts]
            row = [[chunk], *([batch.column(i).to_pylist()] for i in range(3)), [[len(c) for c in coded]], [codec.compress(b"".join(coded), asbytes=True)]]
            types = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=["chunk", "id", "lang", "fold", "bytes", "texts"])


def _block_bits(sums: np.ndarray, start: int, symbols: int) -> np.ndarray:
    """Mean bits of each of a text's blocks, which share its symbols evenly and have at least BLOCK each, but for a single
    one; `sums` are running sums of logarithms, of which the text's own begin at `start`."""
    edges = np.linspace(0, symbols, max(1, symbols // BLOCK) + 1).astype(np.int64)
    return -np.diff(sums[start + edges]) / np.diff(edges)


def _perplexities(answers: pa.Table, packed: pa.Table) -> pa.Table:
    """Perplexity of each text of a chunk, and bits of its blocks, from the chunk's own n-grams."""
    codec, grams = pa.Codec("zstd"), answers["gram"].combine_chunks()
    bits = np.append(answers["bits"].to_numpy(), np.float32(0))  # the last place answers for windows between texts
    out = []
    for row in packed.to_batches(max_chunksize=1):
        own = {name: row.column(name)[0] for name in ("id", "lang", "fold", "bytes", "texts")}
        sizes = own["bytes"].as_py()
        ends = np.cumsum(sizes).tolist()
        coded = codec.decompress(own["texts"].as_py(), decompressed_size=ends[-1], asbytes=True) if ends[-1] else b""
        texts = [coded[e - n : e].decode() for e, n in zip(ends, sizes)]
        lengths, total, blocks = np.array([len(t) for t in texts], dtype=np.int64), np.zeros(len(texts)), []
        for first, piece in _pieces(texts):
            codes, inside, starts = windows(piece)
            at = pc.index_in(pa.array(codes), value_set=grams).fill_null(len(grams)).to_numpy()
            if (at[inside] == len(grams)).any():
                raise RuntimeError("the documents were read in other partitions the second time; write them to a table first")
            sums = np.concatenate(([0.0], np.cumsum(np.where(inside, bits[at], 0), dtype=np.float64)))
            mine = lengths[first : first + len(piece)]
            total[first : first + len(piece)] = sums[starts + mine + 1] - sums[starts]
            blocks += [_block_bits(sums, s, n + 1) if n else np.zeros(0) for s, n in zip(starts.tolist(), mine.tolist())]
        ppl = pa.array(np.exp2(-total / (lengths + 1)), mask=lengths == 0)
        out.append(pa.table([own["id"].values, own["lang"].values, own["fold"].values, pa.array(lengths), ppl, pa.array(blocks, pa.list_(pa.float32()))], names=["id", "lang", "fold", "n_symbols", "perplexity", "blocks"]))
    return pa.concat_tables(out)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, lang, fold, n_symbols, perplexity, blocks) of each row, over its whole text and its end; `blocks` are the mean
    bits of its stretches of BLOCK symbols. A null or empty text has no symbols, no perplexity and no block. `fold` deals
    texts, copies alike, into FOLDS parts.

    `docs` is read twice and must fall into the same partitions both times, as files do; it is an error if not.
    """
    fold = F.pmod(F.xxhash64(text_col), F.lit(FOLDS)).cast("int")
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), fold.alias("fold"), F.col(text_col).alias("text"))
    asked = cut(chosen.mapInArrow(_questions, "chunk string, grams array<long>"), "asked").select("chunk", F.explode("grams").alias("gram"))
    wanted = cut(asked.select("gram").distinct(), "wanted")
    bits = probabilities(wanted, model).select("gram", F.log2("p").cast("float").alias("bits"))
    answers, packed = asked.join(bits, "gram").groupBy("chunk"), chosen.mapInArrow(_packed, _PACKED).groupBy("chunk")
    return answers.cogroup(packed).applyInArrow(_perplexities, "id long, lang string, fold int, n_symbols long, perplexity double, blocks array<float>")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = 0.995,
    pool: int = 50,
    slack: float = 1.1,
    prior: int = 50,
    tail: float = 0.002,
    odd: float = 0.15,
    steady: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per row of `docs`: id, lang, n_symbols, perplexity, judged, threshold, odd_share, keep.

    Trusted texts are those whose label says quality 1 and not toxic; one fold of five of them is held back from training,
    and quantiles of the held-back texts are the limits of each language (null is one too). They are drawn to the pooled
    ones as `pool` further texts would: a language of n texts counts n / (n + pool), so a rare one follows the pool and a
    common one itself, without a step between. Without any trusted text nothing is rejected for its perplexity.

    A document is kept if it passes both of these:
    - its perplexity. A short text says little, so it is judged together with `prior` symbols at the median of its
      language; the threshold is the `quantile` of this figure, times `slack`.
    - its blocks. Those below the `tail` quantile of held-back blocks (the same said over and over) or above the 1 - `tail`
      one (junk between ordinary lines) are odd; their share, with `steady` ordinary blocks added, is at most `odd`.

    Null and empty texts have nothing to keep and are rejected. Ids that repeat in `labels` count once; a trusted id that
    repeats in `docs` makes all its rows trusted; null ids are never trusted.
    """
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("trusted")).distinct()
    side = ids_side(good)
    fold = F.pmod(F.xxhash64(text_col), F.lit(FOLDS))
    text = docs.where(fold > 0).select(F.col(id_col).cast("long").alias("trusted"), F.col(text_col).alias("text")).join(side, "trusted", "left_semi")
    scored = cut(score(docs, train(text), id_col, text_col, lang_col).withColumn("bits", F.log2("perplexity")), "scored")
    held = scored.where("fold = 0 and bits is not null").join(side, F.col("id") == F.col("trusted"), "left_semi")

    def limits(rows: DataFrame, figures: dict[str, Column], own: str) -> tuple[DataFrame, dict[str, Column]]:
        """The figures per language, and each as a column that draws a language's own (if it has any) to the pooled."""
        of = rows.groupBy(F.col("lang").alias(own)).agg(F.count_distinct("id").alias(f"{own}_n"), *[c.alias(f"{own}_{n}") for n, c in figures.items()])
        pooled = rows.agg(*[c.alias(n) for n, c in figures.items()]).first()
        weight = F.col(f"{own}_n") / (F.col(f"{own}_n") + pool)
        mixed = {n: F.lit(pooled[n]).cast("double") + F.coalesce(weight * (F.col(f"{own}_{n}") - F.lit(pooled[n])), F.lit(0.0)) for n in figures}
        return of, mixed

    def beside(rows: DataFrame, of: DataFrame, own: str) -> DataFrame:
        # One row per language: bounded by the number of languages, not by the documents.
        return rows.join(F.broadcast(of), F.col("lang").eqNullSafe(F.col(own)), "left")

    mids, mid = limits(held, {"mid": F.percentile_approx("bits", 0.5, 100_000)}, "of_mid")
    at = lambda q: F.percentile_approx("block", q, 100_000)
    tails, ends = limits(held.select("id", "lang", F.explode("blocks").alias("block")), {"low": at(tail), "high": at(1 - tail)}, "of_tail")

    def judged(rows: DataFrame) -> DataFrame:
        size = F.col("n_symbols") + 1
        return beside(rows, mids, "of_mid").withColumn("judged", F.pow(F.lit(2.0), (F.col("bits") * size + mid["mid"] * prior) / (size + prior)))

    cutoffs, cutoff = limits(judged(held), {"cutoff": F.percentile_approx("judged", quantile, 100_000) * slack}, "of_cutoff")
    met = beside(beside(judged(scored), cutoffs, "of_cutoff"), tails, "of_tail").withColumns({"threshold": cutoff["cutoff"], "_low": ends["low"], "_high": ends["high"]})
    share = F.size(F.filter("blocks", lambda b: (b < F.col("_low")) | (b > F.col("_high")))) / (F.size("blocks") + steady)
    keep = F.col("n_symbols").cast("boolean") & F.coalesce(F.col("judged") <= F.col("threshold"), F.lit(True)) & (F.col("odd_share") <= odd)
    return met.withColumn("odd_share", share).select("id", "lang", "n_symbols", "perplexity", "judged", "threshold", "odd_share", keep.alias("keep"))
