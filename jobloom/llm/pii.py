"""Personal data by a skip-chain conditional random field.

Patterns find base spans. Tokens with a digit or an @ are the variables of the field (all others are outside by
definition), with labels outside, email, ip, card and phone. Neighbouring tokens share chain potentials; tokens that
repeat the same address or the same last seven digits anywhere in the document share skip potentials, linked one
occurrence to the next. Tokens of base spans are observed; loopy message passing carries their labels to the others.
Weights are learned here, piece by piece, from tokens labelled by the patterns.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import map_batches

KINDS = ("email", "ip", "card", "phone")
#: Documents with a digit or @ (those with the smallest hashes) that the weights are learned from, at most.
TRAIN_DOCUMENTS = 1000
ROUNDS = 20
SURE = 0.5

# The patterns of base spans. A digit run is never entered in its middle, so long runs cost one pass.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_TRIM = ".,;:!?\"'*#$%&|<>[]{}=`~^_/\\"


def luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[::-2]) + sum(t - 9 if t > 9 else t for t in twice)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at) if at >= done else None
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, domain.end()))
                done = domain.end()
        at = text.find("@", at + 1)
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the patterns, sorted; ends exclusive, in code points."""
    if not _ANY.search(text):
        return []
    out = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 or not p[:-3].strip("0") for p in m[0].split(".")) and all(int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), 2))
    if "+" in text:
        out += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


class Graph(NamedTuple):
    """Variables of one document: spans, features, observed labels (-1: hidden), chain and skip edges."""

    spans: list[tuple[int, int]]
    features: list[list[float]]
    labels: list[int]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def _signature(token: str) -> str | None:
    """What makes tokens the same for a skip edge: the part before an @, or the last seven digits."""
    if "@" in token:
        return "@" + token.split("@")[0].lower() if token[0] != "@" else None
    digits = _digits(token)
    return digits[-7:] if len(digits) >= 7 else None


def _features(token: str, before: str) -> list[float]:
    digits = _digits(token)
    n = len(digits)
    return [
        1.0, float("@" in token), float("@" in token and "." in token.split("@")[-1].strip(".")),
        *(float(lo <= n <= hi) for lo, hi in ((0, 0), (1, 3), (4, 6), (7, 9), (10, 13), (14, 19), (20, 1 << 40))),
        float(token.startswith("+")), float("(" in token), float(token.count(".") == 3 and n > 3), float(n == len(token)),
        float(any(c.isalpha() for c in token)), float("-" in token), float(14 <= n <= 19 and luhn(digits)), float(before.startswith("+")), float("(" in before),
    ]


WIDTH = len(_features("1", ""))


def graph(text: str, base: list[tuple[int, int, int]]) -> Graph:
    out = Graph([], [], [], [], [])
    seen: dict[str, int] = {}
    place, end, before = 0, -2, ""
    for m in _TOKEN.finditer(text):
        core = m[0].strip(_TRIM) or m[0]
        start = m.start() + m[0].index(core)
        span = (start, start + len(core))
        while place < len(base) and base[place][1] <= span[0]:
            place += 1
        label = next((k for s, e, k in base[place : place + 4] if s < span[1] and e > span[0]), -1)
        near = bool(out.spans) and text[end : m.start()].isspace() and m.start() - end == 1
        i = len(out.spans)
        out.spans.append(span)
        out.features.append(_features(core, before if near else ""))
        out.labels.append(label)
        if near:
            out.chain.append((i - 1, i))
        sign = _signature(core)
        if sign is not None:
            if sign in seen:
                out.skip.append((seen[sign], i))
            seen[sign] = i
        end, before = m.end(), core
    return out


class Weights(NamedTuple):
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def learn(graphs: list[Graph]) -> Weights:
    """Unary weights by regularised softmax regression; chain and skip weights as log ratios of joint to independent label
    pairs with pseudo-counts. Hidden tokens count as outside. No tokens: all weights are zero, and nothing is added."""
    k = len(KINDS) + 1
    x = np.array([f for g in graphs for f in g.features], dtype=np.float64).reshape(-1, WIDTH)
    if not len(x):
        return Weights(np.zeros((WIDTH, k)), np.zeros((k, k)), np.zeros((k, k)))
    y = np.array([v + 1 for g in graphs for v in g.labels])
    rows, which = np.unique(np.column_stack([x, y]), axis=0, return_counts=True)
    x, y, n = rows[:, :-1], rows[:, -1].astype(int), which / which.sum()
    target, w, step = np.eye(k)[y], np.zeros((WIDTH, k)), 1.0
    for _ in range(400):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w -= step * (x.T @ ((p - target) * n[:, None]) + 1e-4 * w)

    def ratios(edges: list[list[tuple[int, int]]]) -> np.ndarray:
        joint = np.full((k, k), 0.1) + 0.9 * np.eye(k)
        for g, own in zip(graphs, edges):
            for a, b in own:
                joint[g.labels[a] + 1, g.labels[b] + 1] += 1
        joint /= joint.sum()
        return np.log(joint / (joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)))

    skip = ratios([g.skip for g in graphs])
    return Weights(w, ratios([g.chain for g in graphs]), (skip + skip.T) / 2)


def infer(g: Graph, weights: Weights) -> np.ndarray:
    """Label probabilities of each token by loopy message passing over chain and skip edges; exact on a chain."""
    k = len(KINDS) + 1
    unary = np.array(g.features, dtype=np.float64).reshape(-1, WIDTH) @ weights.unary
    labels = np.array(g.labels)
    observed = np.flatnonzero(labels >= 0)
    unary[observed] = -50.0
    unary[observed, labels[observed] + 1] = 0.0
    edges = np.array(g.chain + g.skip, dtype=np.int64).reshape(-1, 2)
    pair = np.concatenate([np.repeat(weights.chain[None], len(g.chain), 0), np.repeat(weights.skip[None], len(g.skip), 0)])
    source, to = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    pair = np.concatenate([pair, pair.transpose(0, 2, 1)]).reshape(-1, k, k)
    half = len(edges)
    messages = np.zeros((2 * half, k))
    belief = unary.copy()
    for _ in range(ROUNDS if half else 0):
        back = np.concatenate([messages[half:], messages[:half]])
        sent = belief[source] - back
        new = np.logaddexp.reduce(sent[:, :, None] + pair, axis=1)
        new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
        moved = np.abs(new - messages).max()
        messages = 0.5 * messages + 0.5 * new
        belief = unary.copy()
        np.add.at(belief, to, messages)
        if moved < 1e-4:
            break
    belief -= np.logaddexp.reduce(belief, axis=1, keepdims=True)
    return np.exp(belief)


def added_spans(text: str, base: list[tuple[int, int, int]], weights: Weights) -> list[tuple[int, int, int]]:
    """Spans of hidden tokens whose most probable label is a kind; neighbours of one kind are one span."""
    g = graph(text, base)
    if -1 not in g.labels:
        return []
    p = infer(g, weights)
    best = p.argmax(axis=1)
    chosen = [i for i in range(len(best)) if g.labels[i] < 0 and best[i] > 0 and p[i, best[i]] >= SURE]
    near, out = set(g.chain), []
    for i in chosen:
        s, e = g.spans[i]
        if out and out[-1][3] == i - 1 and (i - 1, i) in near and out[-1][2] == best[i] - 1:
            out[-1] = (out[-1][0], e, out[-1][2], i)
        else:
            out.append((s, e, int(best[i] - 1), i))
    return [x[:3] for x in out]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = TRAIN_DOCUMENTS) -> Weights:
    """Learn from at most `documents` whole documents; what reaches the driver is their tokens' features and labels.

    The smallest hashes are chosen without their texts, which then meet at most `documents` hashes by broadcast, so no
    task gathers candidates' texts from all others. Repeated rows are learned from once.
    """
    hashed = docs.select(F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h"), F.xxhash64(text_col).alias("t"))
    chosen = hashed.where(F.col("text").rlike("[0-9@]")).select("h", "t").orderBy("h", "t").limit(documents).distinct()
    some = hashed.join(F.broadcast(chosen), ["h", "t"]).dropDuplicates(["h", "t"])

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        graphs = [graph(t, base_spans(t)) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_pylist([{"f": np.array(g.features, np.uint8).tobytes(), "l": g.labels, "c": [v for e in g.chain for v in e], "s": [v for e in g.skip for v in e]} for g in graphs], schema=_TAUGHT)

    rows = map_batches(some.select("text"), per_batch, "f binary, l array<int>, c array<int>, s array<int>").toArrow().to_pylist()
    rows.sort(key=lambda r: (bytes(r["f"]), r["l"], r["c"]))
    pairs = lambda v: list(zip(v[::2], v[1::2]))
    return learn([Graph([], np.frombuffer(r["f"], np.uint8).reshape(-1, WIDTH).tolist(), r["l"], pairs(r["c"]), pairs(r["s"])) for r in rows])


_TAUGHT = pa.schema([("f", pa.binary()), ("l", pa.list_(pa.int32())), ("c", pa.list_(pa.int32())), ("s", pa.list_(pa.int32()))])


def write_span(span: tuple[int, int, int]) -> str:
    return f"{KINDS[span[2]]}:{span[0]}:{span[1]}"


def find(docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added) of each row: arrays of kind:start:end, base spans by start and kind, added ones by start. Null and
    empty texts have no spans. Whole texts are read, one at a time; nothing is shuffled."""

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        base_all, added_all = [], []
        for text in batch.column(1):
            t = text.as_py() or ""
            base = base_spans(t)
            added = added_spans(t, base, weights) if _ANY.search(t) else []
            base_all.append([write_span(s) for s in base])
            added_all.append([write_span(s) for s in added])
        strings = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(base_all, strings), pa.array(added_all, strings)], names=["id", "base", "added"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(chosen, per_batch, "id long, base array<string>, added array<string>")
