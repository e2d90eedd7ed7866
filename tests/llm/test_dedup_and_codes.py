"""Previous factors, Orchard clusters and GNAT codes against brute force, with nulls, empty and long texts, ties, repeated
rows, empty tables and columns with clashing names; and their queries as registered, column by column."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from check import compare, connect
from jobloom.llm import common, gnat, orchard, previous_factor, tool_calls
from jobloom.llm.oracles import ORACLES
from jobloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, id long, row long, place long, start int, kind string, chunk long"
VECTORS = "vec_id long, embedding array<float>, label int, id string, v int, cluster string, n long"


@pytest.fixture(scope="module", autouse=True)
def settled(spark):
    common.settle(spark)


def left_over(rows, length):
    """(id, bytes, what stays) by looking at every string."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        text = (rows[i][1] or "").encode()
        covered = bytearray(len(text))
        for p in range(len(text) - length + 1):
            if text[p : p + length] in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(text[p : p + length])
        out.append((rows[i][0], len(text), bytes(b for b, c in zip(text, covered) if not c)))
    return sorted(out, key=repr)


def texts(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 200))) for _ in range(12)]
    out = []
    for i in range(250):
        kind = rng.random()
        if kind < 0.4:  # copies
            t = rng.choice(base)
        elif kind < 0.7:  # shared passages
            t = rng.choice(base)[rng.randint(0, 40) :] + rng.choice(["", "x"]) + rng.choice(base)[: rng.randint(0, 200)]
        elif kind < 0.85:  # periods
            t = rng.choice(["a", "abcabd", "é"]) * rng.randint(0, 90)
        else:
            t = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 400)))
        out.append((rng.choice([i, i, i, i // 2, None]), t if rng.random() > 0.03 else None))
    long = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    return [*out, (900, ""), (901, long), (902, long[20_000:] + base[0])]


@pytest.mark.parametrize("sizes", [(16, 1000, 3, 64), (20, 500, 1000, 128), (24, 10**7, 2, 1 << 20), (100, 3000, 5, 100), (100, 10**7, 10**6, 1 << 20)])
@pytest.mark.parametrize("seed", [1, 2])
def test_previous_factors_against_brute_force(spark, sizes, seed):
    """Tiny chunks, blocks and hot limits, so that every way through is taken."""
    rows = texts(seed)
    df = spark.createDataFrame(spark.sparkContext.parallelize([(*r, 7, 7, 7, 7, "x", 7) for r in rows], 5), DOCS)
    got = previous_factor.remove_repeats(df, sizes=previous_factor.Sizes(*sizes)).collect()
    assert sorted([(r.id, r.n_bytes, bytes(r.kept)) for r in got], key=repr) == left_over(rows, sizes[0])
    for r in got:  # spans are apart and account for what is gone
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))
        assert sum(s.stop - s.start for s in r.spans) == r.n_bytes - len(r.kept)


def test_previous_factors_of_a_hot_line(spark):
    """A line in every text, with other words around it: its bucket is spread, and only whole strings of 100 bytes go."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    line, passage = "this line of sixty bytes or so is found in each of the texts.", "a passage of more than one hundred bytes, which is long enough to be taken out of all texts but the first of them all. "
    rows = [(i, f"{word()} {word()} {word()} {line if i % 2 else passage}{word()} {word()} {word()} {word()} {word()}") for i in range(400)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 7), "doc_id long, text string")
    got = previous_factor.remove_repeats(df, sizes=previous_factor.Sizes(100, 2000, 4)).collect()
    assert sorted([(r.id, r.n_bytes, bytes(r.kept)) for r in got], key=repr) == left_over(rows, 100)
    assert sum(bool(r.spans) for r in got) == 199


def test_previous_factors_of_nothing(spark):
    assert previous_factor.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def vectors(seed, n=120, size=64):
    rng = random.Random(seed)
    points = [[rng.choice([-0.3, 0.0, 0.1, 0.25]) if rng.random() < 0.8 else rng.gauss(0, 0.3) for _ in range(size)] for _ in range(n)]
    rows = [(i * 3 % 101, p, rng.choice([None, 1, 2]), "x", 1, "y", 2) for i, p in enumerate(points)]
    bad = [None, [], [0.5] * (size - 1), [*[0.5] * (size - 1), None], [*[0.5] * (size - 1), math.nan], [*[0.5] * (size - 1), math.inf], [0.5] * (size + 8)]
    return [*rows, *rows[:5], *[(500 + i, v, 1, "x", 1, "y", 2) for i, v in enumerate(bad)], (None, points[0], 1, "x", 1, "y", 2)]


def whole(rows, scale, size):
    ok = lambda v: v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    return [(r[0], r[2], np.floor(np.array(r[1], dtype=np.float32).astype(np.float64) * scale).astype(np.int64)) for r in rows if ok(r[1])]


def nearest(v, centres):
    return min((int(((v - c) ** 2).sum()), i) for i, c in enumerate(centres))


def lloyd(points, centres, rounds):
    for _ in range(rounds):
        own = [nearest(p, centres)[1] for p in points]
        sums = [[p for p, o in zip(points, own) if o == i] for i in range(len(centres))]
        centres = [np.array([int(s) // len(m) for s in np.sum(m, axis=0)]) if m else c for m, c in zip(sums, centres)]
    return centres


@pytest.mark.parametrize("k", [1, 7, 40, 500])
def test_orchard_clusters_against_brute_force(spark, k):
    rows = vectors(k)
    kept = whole(rows, 256, 64)
    named = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[2].tolist())) + [r for r in kept if r[0] is None]
    centres = lloyd([r[2] for r in kept], [r[2] for r in named[:k]], 3)
    found = orchard.cluster(spark.createDataFrame(rows, VECTORS).repartition(4), k=k, rounds=3)
    assert [c.tolist() for c in found.centroids] == [c.tolist() for c in centres]
    want = sorted(((r[0], *nearest(r[2], centres)[::-1]) for r in kept), key=repr)
    assert sorted(((r.id, r.cluster, r.distance) for r in found.rows.collect()), key=repr) == want


def test_orchard_search_stops_early_and_keeps_ties():
    rng = np.random.default_rng(4)
    centres = rng.integers(-3, 4, (60, 3))  # many ties and equal centroids
    points = rng.integers(-4, 5, (3000, 3))
    best, distance = orchard.search(points, orchard.neighbour_lists(centres))
    all_ = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (best == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()


@pytest.mark.parametrize("entries", [1, 16, 200])
def test_gnat_codes_against_brute_force(spark, entries):
    rows = vectors(entries)
    kept = whole(rows, 4096, 64)
    first = sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[2].tolist())) + [r for r in kept if r[0] is None]
    found = gnat.compress(spark.createDataFrame(rows, VECTORS).repartition(4), entries=entries, rounds=3)
    books = [lloyd([r[2][p * 8 : p * 8 + 8] for r in kept], [r[2][p * 8 : p * 8 + 8] for r in first[:entries]], 3) for p in range(8)]
    assert [[e.tolist() for e in b] for b in found.codebooks] == [[e.tolist() for e in b] for b in books]
    pairs = [[nearest(r[2][p * 8 : p * 8 + 8], books[p]) for p in range(8)] for r in kept]
    want = sorted(((r[0], r[1], [i for _, i in c], sum(d for d, _ in c)) for r, c in zip(kept, pairs)), key=repr)
    assert sorted(((r.id, r.label, list(r.code), r.error) for r in found.rows.collect()), key=repr) == want


def test_gnat_search_leaves_out_subtrees_and_keeps_ties():
    rng = np.random.default_rng(4)
    for spread in (3, 1 << 24):
        entries = rng.integers(-spread, spread + 1, (200, 2))
        points = np.concatenate([rng.integers(-spread, spread + 1, (2000, 2)), entries])
        tree = gnat.build(entries)
        best, distance = gnat.search(points, entries, tree)
        all_ = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (best == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()


def test_vectors_without_rows_and_too_large(spark):
    nothing = spark.createDataFrame([], VECTORS)
    assert orchard.cluster(nothing).rows.count() == 0 and gnat.compress(nothing).rows.count() == 0
    odd = spark.createDataFrame([(1, [1.0] * 9, 1, "x", 1, "y", 2)], VECTORS)
    assert gnat.compress(odd).rows.count() == 0  # cannot be cut into eight parts
    large = spark.createDataFrame([(1, [1e30] * 64, 1, "x", 1, "y", 2)], VECTORS)
    for run in (orchard.cluster, gnat.compress):
        with pytest.raises(Exception, match="too large"):
            run(large)


@pytest.mark.parametrize("name", ["op11_previous_factors", "op12_orchard_clusters", "op13_gnat_codes"])
def test_registered_query_against_sql(spark, name):
    outcome, rows = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert outcome == "ok" and rows and name in ORACLES and name in QUERIES


@pytest.mark.parametrize("text", ['{"x":1e999}', '{"x":[-1e400]}', '{"x":"\\ud800"}', '{"\\udfff":1}', "[" * 100_000, "9" * 5000, "NaN", "", "{"])
def test_arguments_that_cannot_be_written_again_are_errors(spark, text):
    """Texts that Python parses but JSON or UTF-8 cannot hold end in an error of the call, not of the job."""
    calls = [(1, 1, "a", "f", text, []), (1, 2, "b", "f", '{"x":"\\ud83d\\ude00 1e999"}', ["a"])]
    df = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([(1, 1, "a", "ok")], "conv_id long, turn long, call_id string, content string")
    got = {r.call_id: r for r in tool_calls.link(df, results, {"f": {"type": "object"}}).collect()}
    assert (got["a"].valid, got["a"].errors, got["a"].status) == (False, ["$: not JSON"], "linked")
    assert got["b"].valid and "\U0001f600 1e999" in got["b"].json
