"""Operators of jobloom.llm against brute force, on small inputs with nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns with clashing names."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from jobloom.llm import common, components, dac, kneser_ney, lsh, mixing, phrases, pii, sharding, simhash, tool_calls, url_filter
from jobloom.llm.queries import RULES, SCHEMAS, chats_with_tools, tokenizer_path
from jobloom.session import cut

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, chunk string, size int, _slot int"
WORDS = "the of and nation order river stone light paper green small walk under over ninety seven".split()


@pytest.fixture(scope="module", autouse=True)
def settled(spark):
    common.settle(spark)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ly", "er"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(60)]
    for t in texts[:12]:  # near copies
        words = t.split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [None, "", "  \n\t ", "one", "Two WORDS", texts[5], texts[5], prose(rng, 4000), "Ünïcode É ê mixed\u00a0space İ ſ"]
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), 0, 7, "x", 1, 2) for i, t in enumerate(texts)]
    return [*out, (None, "no id here", "en", "a", 0, 7, "x", 1, 2), (3, texts[3], out[3][2], out[3][3], 0, 7, "x", 1, 2)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_common_row_id(spark):
    got = spark.createDataFrame([(5, "a"), (None, "a"), (None, "b")], "i long, t string").select(common.row_id("i", "t")).collect()
    assert got[0][0] == 5 and got[1][0] < 0 and got[2][0] < 0 and got[1][0] != got[2][0]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    root = {n: n for e in links for n in e if e[0] != e[1]}
    for _ in range(80):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert dict(map(tuple, got.collect())) == root


def test_components_without_links(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1 quality


def test_ngram_model_sums_to_one_and_matches_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    texts = [prose(rng, 30) for _ in range(40)] + ["", None]
    counts = {r["gram"]: r["n"] for r in kneser_ney.count_ngrams(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    expected = Counter()
    for t in filter(None, texts):
        points = [0, 0, 0, *((0xD800 | ord(c) & 0x7FF) if ord(c) > 0xFFFF else ord(c) for c in t), 0]
        for i in range(len(points) - 3):
            expected[tuple(points[i : i + 4])] += 1
    code = lambda g: int(np.array(sum(x << 16 * i for i, x in enumerate(reversed(g))), dtype=np.uint64).astype(np.int64))
    assert counts == {code(g): n for g, n in expected.items()}
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    # probabilities by hand, from the definition
    orders = [None, None, None, expected]
    for k in (2, 1, 0):
        orders[k] = Counter(g[1:] for g in orders[k + 1])
    symbols = [g[0] for g in orders[0]]

    def p(gram, k):
        if k < 0:
            return 1 / (len(symbols) + 1)
        n = Counter(orders[k].values())
        y = n[1] / (n[1] + 2 * n[2])
        d = [0, *(min(max(x, 0.05), top) for x, top in ((1 - 2 * y * n[2] / n[1], 0.95), (2 - 3 * y * n[3] / n[2], 1.9), (3 - 4 * y * n[4] / n[3], 2.85)))]
        seen = {g: c for g, c in orders[k].items() if g[:-1] == gram[:-1]}
        if not seen:
            return p(gram[1:], k - 1)
        cost = lambda c: min(d[min(c, 3)], c)
        total = sum(seen.values())
        own = seen.get(gram, 0)
        return (own - (cost(own) if own else 0)) / total + sum(map(cost, seen.values())) / total * p(gram[1:], k - 1)

    asked = [*list(expected)[:30], (1, 2, 3, 5), (0, 0, 0, 0x4E00), (0xFFFF, 0x8000, 116, 104)]
    whole = [(*c, s) for c in ((0, 0, 0), (9, 9, 116), list(expected)[40][:3]) for s in [*symbols, 0x4E00]]  # over all symbols and one unseen
    wanted = spark.createDataFrame([(code(g),) for g in {*asked, *whole}], "gram long")
    got = {r["gram"]: r["p"] for r in kneser_ney.probabilities(wanted, model).collect()}
    for gram in asked:
        assert got[code(gram)] == pytest.approx(p(gram, 3), rel=1e-6)
    for i in range(0, len(whole), len(symbols) + 1):
        assert sum(got[code(g)] for g in whole[i : i + len(symbols) + 1]) == pytest.approx(1, abs=1e-6)
    monkeypatch.setattr(kneser_ney, "CHUNK_CHARACTERS", 100)
    again = spark.createDataFrame([(i, t, None) for i, t in enumerate([*texts, "unseen \U0001f600\0 \u4e2d"])], "doc_id long, text string, lang string")
    for r in kneser_ney.score(again, model).collect():
        t = [*texts, "unseen \U0001f600\0 \u4e2d"][r["id"]]
        if not t:
            assert r["n_symbols"] == 0 and r["perplexity"] is None
            continue
        points = [0, 0, 0, *((0xD800 | ord(c) & 0x7FF) if ord(c) > 0xFFFF else ord(c or " ") for c in t.replace("\0", " ")), 0]
        each = [math.log2(p(tuple(points[i : i + 4]), 3)) for i in range(len(points) - 3)]
        bits = sum(each)
        stretches = max(1, len(each) // kneser_ney.BLOCK)
        edges = [len(each) * i // stretches for i in range(stretches + 1)]
        assert r["blocks"] == pytest.approx([-sum(each[a:b]) / (b - a) for a, b in zip(edges, edges[1:])], rel=1e-3)
        assert r["n_symbols"] == len(t) and r["perplexity"] == pytest.approx(2 ** (-bits / (len(t) + 1)), rel=1e-4)


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    half = labels.where("doc_id % 2 = 0")
    got = kneser_ney.classify(docs, half).join(labels.where("doc_id % 2 = 1").withColumnRenamed("doc_id", "d"), F.col("id") == F.col("d"))
    bad, kept_bad, good, lost = got.agg(
        F.sum(F.expr("int(quality = 0)")), F.sum(F.expr("int(quality = 0 and keep)")), F.sum(F.expr("int(quality = 1)")), F.sum(F.expr("int(quality = 1 and not keep)"))
    ).first()
    assert kept_bad <= 0.05 * bad and lost <= 0.01 * good


def test_quality_is_two_sided(spark):
    """Ordinary words said over and over, and junk between ordinary lines, go though their whole perplexity is ordinary; a
    rare language is judged by figures close to the pooled ones."""
    rng = random.Random(3)
    words = ["".join(rng.choice("aeioustnrl") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    said = lambda n: " ".join(rng.choice(words) for _ in range(n))
    junk = lambda n: "".join(rng.choice("#$%&@!?*0123456789") for _ in range(n))
    good = [(i, said(200), "en" if i % 20 else "rare", "s") for i in range(400)]
    bad = [(1000, f"{said(80)} " + f"{words[0]} " * 150 + said(80), "en", "s"), (1001, f"{said(300)} {junk(700)} {said(300)}", "en", "s"), (1002, junk(500), None, "s")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([*good, *bad, (1003, said(900), "rare", "s")], "doc_id long, text string, lang string, source string")
    got = {r["id"]: r for r in kneser_ney.classify(docs, labels).collect()}
    assert not any(got[i]["keep"] for i in (1000, 1001, 1002)) and got[1003]["keep"]
    assert got[1000]["judged"] <= got[1000]["threshold"]
    assert sum(not got[i]["keep"] for i in range(400)) <= 8


def test_quality_cases(spark, docs, nothing):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)] + [(None, 1, None), (3, 1, 0), (51, 0, 0)], "doc_id long, quality int, toxic int")
    got = {(r["id"], r["lang"]): r for r in kneser_ney.classify(docs, labels).collect()}
    assert kneser_ney.classify(docs, labels).count() == docs.count()
    empty = [r for r in got.values() if r["n_symbols"] == 0]
    assert empty and not any(r["keep"] for r in empty) and all(r["perplexity"] is None for r in empty)
    assert kneser_ney.classify(nothing, labels).count() == 0
    unlabelled = kneser_ney.classify(docs, labels.where("false"))
    assert unlabelled.where("not keep and n_symbols > 0").count() == 0


# 2 tokens


@pytest.mark.parametrize("top", [1, 255, 256, 65536, 2**32 - 1])
def test_codes_round_trip(top):
    ids = np.random.default_rng(top).integers(0, top, 3000, endpoint=True).astype(np.uint32)
    levels = dac.pack(ids)
    assert (dac.unpack(levels) == ids).all()
    assert [dac.access(levels, i) for i in range(0, 3000, 37)] == ids[::37].tolist()


def test_no_codes():
    assert len(dac.unpack(dac.pack(np.zeros(0, np.uint32)))) == 0


def test_encoder_equals_library():
    encoder, rng = dac.Encoder(tokenizer_path()), random.Random(5)
    pieces = ["a", "é", "B", " ", " ", "  ", "\n", ".", "12", "ñandú", "the", "\t", "\u3000", "'s", "<|endoftext|>", "中文", "\u00a0", "\x1c"]
    texts = ["", " ", *("".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(3000))]
    for text, coded in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(coded, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


class CountedLookups(dict):
    n = 0

    def get(self, *args):
        self.n += 1
        return super().get(*args)

    def __getitem__(self, key):
        self.n += 1
        return super().__getitem__(key)


def test_encoder_looks_up_a_piece_once_for_all_its_places():
    encoder, text = dac.Encoder(tokenizer_path()), "The cat sat, and\nthe dog sat. " * 2000
    encoder.known = known = CountedLookups()
    expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([text, text])] == [expected, expected]
    assert known.n < 100


def test_encoder_forgets_long_pieces(monkeypatch):
    monkeypatch.setattr(dac, "MEMORY_BYTES", 20_000)
    encoder, rng = dac.Encoder(tokenizer_path()), random.Random(6)
    for _ in range(60):
        text = " ".join("".join(rng.choices("абвгд中文,.", k=500)) for _ in range(3))
        (coded,) = encoder.encode([text])
        assert np.frombuffer(coded, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert sum(len(p.encode()) for p in encoder.known) < 25_000


def test_encoder_starts_its_memory_afresh(monkeypatch):
    monkeypatch.setattr(dac, "MEMORY", 20)
    encoder, rng = dac.Encoder(tokenizer_path()), random.Random(7)
    for _ in range(200):
        texts = [" ".join(rng.choice(["a", "bé.", "the,", "x\ny", "12", "dog\nCat!", ""]) + rng.choice(["", "s"]) for _ in range(9)) for _ in range(3)]
        for text, coded in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(coded, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_tokens_of_documents(spark, docs, rows, nothing):
    stored = dac.write_tokens(docs, tokenizer_path(), segment_tokens=500)
    got = sorted(map(tuple, dac.read_documents(stored).collect()), key=lambda r: r[1])
    tokenizer = dac.Encoder(tokenizer_path()).tokenizer
    expected, start, flat = [], 0, []
    for doc, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        flat += ids
    assert got == expected
    assert [dac.read_token(stored, i) for i in (0, 499, 501, start - 1)] == [flat[i] for i in (0, 499, 501, start - 1)]
    with pytest.raises(IndexError):
        dac.read_token(stored, start)
    assert dac.read_documents(dac.write_tokens(nothing, tokenizer_path())).count() == 0


# 3 tool calls

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>, status string, level string"
RESULTS = "conv_id long, turn long, call_id string, content string, json string"
SCHEMA = {"f": {"type": "object", "required": ["x"], "additionalProperties": False, "properties": {"x": {"type": "integer", "minimum": 1}}}}


def test_tool_calls(spark):
    calls = [
        (1, 1, "a", "f", '{"x": 2}', ["b"], None, None), (1, 3, "b", "f", '{"x":1, "y":2}', [], None, None), (1, 5, "c", "f", "{bad", ["a", "b", "zz", None], None, None),
        (1, 7, "a", "f", '{"x": 3}', None, None, None), (2, 1, "p", "g", None, ["q"], None, None), (2, 2, "q", "f", '{"x": 0}', ["p"], None, None),
        (2, 3, "r", "f", '{"x": true}', ["q"], None, None), (None, 1, "n", "f", '{"x": NaN}', [], None, None), (3, 1, None, "f", "[]", None, None, None),
    ]
    results = [(1, 2, "a", "second", ""), (1, 1, "a", "first", ""), (1, 9, "lost", "é\n", ""), (2, 2, "p", None, ""), (None, 4, "n", "x", "")]
    got = tool_calls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMA).collect()
    by = {(r["conv_id"], r["call_id"], r["status"]): r for r in got}
    assert len(got) == len(by) == 11
    assert [by[1, c, s]["position"] for c, s in (("b", "no_result"), ("a", "linked"), ("c", "no_result"))] == [1, 2, 3]
    assert by[1, "a", "linked"]["json"] == '{"arguments":{"x":2},"id":"a","name":"f","position":2,"result":"first"}' and by[1, "a", "linked"]["valid"]
    assert by[1, "a", "repeated"]["position"] is None
    assert by[1, "b", "no_result"]["errors"] == ["$.y: unknown"]
    assert by[1, "c", "no_result"]["errors"] == ["needs: no zz", "$: not JSON"]
    assert by[1, "lost", "no_call"]["json"] == '{"id":"lost","result":"é\\n"}'
    assert by[2, "p", "linked"]["level"] is None and by[2, "p", "linked"]["errors"] == ["$: not JSON"]
    assert [by[2, c, "no_result"]["errors"] for c in "qr"] == [["$.x: below 1"], ["$.x: not integer"]]
    assert by[None, "n", "no_result"]["errors"] == ["$: not JSON"] and (3, None, "no_result") in by and (None, "n", "no_call") in by
    empty = tool_calls.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), SCHEMA)
    assert empty.count() == 0


def test_levels_against_brute_force(spark):
    rng = random.Random(2)
    calls = [(c, str(i)) for c in range(4) for i in range(25)]
    needs = {(c, i): {str(rng.randrange(int(i))) for _ in range(rng.randint(0, 3))} if int(i) else set() for c, i in calls}
    level = {}
    for c, i in calls:
        level[c, i] = 1 + max((level[c, n] for n in needs[c, i]), default=-1)
    frame = spark.createDataFrame([(c, i, n) for (c, i), own in needs.items() for n in own], "conv_id long, call_id string, need string")
    got = tool_calls.levels(spark.createDataFrame(calls, "conv_id long, call_id string"), frame)
    assert {(r[0], r[1]): r[2] for r in got.collect()} == level


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """A chain of 10,000 calls, chains that meet, calls on a cycle and calls behind one."""
    written = []
    monkeypatch.setattr(tool_calls, "cut", lambda df, label: (written.append(label), cut(df, label))[1])
    needs = [(1, str(i), str(i - 1)) for i in range(1, 10_000)]
    needs += [(2, "a1", "a0"), (2, "a2", "a1"), (2, "b1", "b0"), (2, "m", "a2"), (2, "m", "b1"), (2, "m", "b0"), (2, "n", "m"), (2, "o", "n"), (2, "p", "o"), (2, "p", "a1")]
    needs += [(3, "x", "y"), (3, "y", "z"), (3, "z", "x"), (3, "s", "s"), (3, "behind", "x"), (3, "both", "x"), (3, "both", "free"), (3, "after", "both"), (3, "fine", "free")]
    known = {(c, n) for c, *pair in needs for n in pair}
    got = tool_calls.levels(spark.createDataFrame(sorted(known), "conv_id long, call_id string"), spark.createDataFrame(needs, "conv_id long, call_id string, need string"))
    level = {(r[0], r[1]): r[2] for r in got.collect()}
    assert {k[1]: n for k, n in level.items() if k[0] == 1} == {str(i): i for i in range(10_000)}
    assert {k[1]: n for k, n in level.items() if k[0] == 2} == {"a0": 0, "b0": 0, "a1": 1, "b1": 1, "a2": 2, "m": 3, "n": 4, "o": 5, "p": 6}
    assert {k[1]: n for k, n in level.items() if k[0] == 3} == {"free": 0, "fine": 1}
    assert written.count("links") <= 16


def test_chats_with_tools(spark):
    """Every assistant turn is a call with its whole text and has its result; calls of a chat are one chain."""
    long = "word " * 5000 + "end"
    said = [(1, t, "assistant" if t % 2 else "user", long if t == 3 else f"text {t}\n") for t in range(30)] + [(2, 0, "system", "s"), (2, 2, "assistant", "")]
    calls, results = chats_with_tools(spark.createDataFrame(said, "conv_id long, turn long, role string, text string"))
    got = {(r["conv_id"], r["turn"], r["status"]): r for r in tool_calls.link(calls, results, SCHEMAS).collect()}
    spoken = [(c, t, text) for c, t, role, text in said if role == "assistant"]
    assert len(got) == len(spoken) + sum(t % 11 == 0 for _, t, _ in spoken)
    for c, t, text in spoken:
        row = got[c, t, "no_result" if t % 11 == 0 else "linked"]
        record = json.loads(row["json"])
        assert row["level"] == (t - 1) // 2 and row["position"] == row["level"] + 1
        assert record["result"] == (None if t % 11 == 0 else text)
        assert text in record["arguments"].values() or record["arguments"]["words"] == re.split(r"\s+", text)


# 4 urls

URLS = [None, "", "no scheme", "http://", "https://A.Example.COM/en/1?x=1#f", "http://www.example.com/en/", "http://x.www.example.com/en/2", "http://b.net/es/9", "http://net/fr/", "http://b.net/de/",
        "http://com", "http://a.com/", "http://a.com?q=/en/", "x://y://z/p", "http://examplecom/en/", "http://notexample.com/en/", "HTTP://u:p@h.org:80/é/%20?&&a", "http://h.net#/es/", "http://h.net/es"]


def test_url_parts_and_rules(spark):
    rows = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, _host string")
    labelled = spark.createDataFrame([(f"http://spam{i}.example.org/{i}/9{i}", 1) for i in range(40)] + [(f"https://good.example.org/page/{chr(97 + i % 26)}", 0) for i in range(40)] + [(None, 1), ("http://x.org", None)], "url string, label int")
    model = url_filter.train(labelled)
    got = {r["page_id"]: r for r in url_filter.judge(rows, RULES, model, ["page_id"]).collect()}
    for i, u in enumerate(URLS):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, best and best.name), u
        assert got[i]["verdict"] in ("allow", "block") and (best is None or got[i]["verdict"] == best.verdict)
    check = spark.createDataFrame([(1, "http://spam99.example.org/99/999"), (0, "https://good.example.org/page/zz")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge(check, [], model, ["page_id"]).collect()} == {1: "block", 0: "allow"}
    assert url_filter.judge(rows.where("false"), RULES, model, ["page_id"]).count() == 0


def test_url_training_without_both_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    for labelled in ([], [("http://a.b", 1)], [("http://a.b", 0)]):
        model = url_filter.train(spark.createDataFrame(labelled, "url string, label int"))
        assert url_filter.judge(pages, [], model, ["page_id"]).first()["verdict"] == ("block" if labelled and labelled[0][1] else "allow")


def test_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("",), ("abcd",)], "u string").select(url_filter.entropy(F.col("u"))).collect()
    assert [r[0] for r in got] == [1.0, 0.0, 2.0]


# 5 shards


def test_shards(spark, docs, rows, nothing, tmp_path):
    slotted = sharding.slotted(docs.drop("_slot"))
    loads = sharding.slot_loads(slotted)
    root = str(tmp_path / "map")
    first = sharding.first_map(spark, 3, sharding.SLOTS)
    sharding.store_map(first, root)
    sharding.store_map(sharding.rebalance(first, loads, 3), root)
    current = sharding.load_map(spark, root, 1)
    assert sharding.load_map(spark, root, 0).count() == current.count() == sharding.SLOTS
    placed = sharding.places(sharding.assign(slotted, current), current, loads, ["doc_id", "_size"]).collect()
    assert len(placed) == len(rows)
    size, places = Counter(), defaultdict(list)
    for r in placed:
        assert r["_size"] == len((r["text"] or "").encode()) + 1
        size[r["_shard"]] += r["_size"]
        places[r["_shard"]].append(r["_place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    largest = max(r["bytes"] for r in loads.collect())
    assert max(size.values()) - min(size[s] for s in range(3)) <= largest
    grown = sharding.add_shard(current, loads, 3)
    before, after = ({r["slot"]: r["shard"] for r in m.collect()} for m in (current, grown))
    assert {after[s] for s in after if after[s] != before[s]} == {3} and grown.select("version").distinct().first()[0] == 2
    nothing_loads = sharding.slot_loads(sharding.slotted(nothing.drop("_slot")))
    assert sharding.rebalance(first, nothing_loads, 3).count() == sharding.SLOTS


# 6 near duplicates


def brute_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(docs, rows, nothing):
    prints = [brute_fingerprint(r[1]) for r in rows]
    root = {p: p for p in prints}
    for _ in range(20):
        for a, b in combinations(set(prints), 2):
            if (a ^ b).bit_count() <= 4:
                root[a] = root[b] = min(root[a], root[b])
    least = defaultdict(list)
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[root[p]].append(r[0])
    expected = Counter((r[0], f"{p:016x}", min(least[root[p]], default=None)) for r, p in zip(rows, prints))
    got = simhash.near_duplicates(docs.drop("id")).select("id", simhash.fingerprint_hex(F.col("fingerprint")), "component_id")
    assert Counter(map(tuple, got.collect())) == expected
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("tile", [2048, 5])
def test_links_in_hot_cells(spark, tile):
    """Clusters of many fingerprints around a few centres: the same components with whole and with tiled cells."""
    rng = random.Random(11)
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in (rng.getrandbits(64) for _ in range(4)) for _ in range(80)} | {rng.getrandbits(64) for _ in range(50)}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    root = {p: p for p in prints}
    for _ in range(30):
        for a, b in combinations(prints, 2):
            if (a ^ b).bit_count() <= 4:
                root[a] = root[b] = min(root[a], root[b], key=lambda p: signed[p])
    links = simhash.links(spark.createDataFrame([(s,) for s in signed.values()], "fingerprint long"), tile)
    got = {s: s for s in signed.values()} | dict(map(tuple, components.components(links).collect()))
    assert got == {signed[p]: signed[r] for p, r in root.items()}


def test_manhattan_distance_is_a_lower_bound():
    a, b = np.random.default_rng(1).integers(0, 2**63, (2, 2000), dtype=np.uint64)
    assert (np.bitwise_count(simhash._thermometer(a) ^ simhash._thermometer(b)) <= np.bitwise_count(a ^ b)).all()


# 7 mixing


def test_source_targets(spark):
    sizes = [("b", 100), ("a", 10), (None, 1000), ("c", 0), ("\U0001f600", 400), ("\uffee", 50)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s[0]: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, rest, open_ = {s[0]: 0.0 for s in sizes}, 1.5 * sum(s[1] for s in sizes), dict(sizes)
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / total
        rest = sum(max(0, target[s] - 2 * n) for s, n in open_.items())
        for s, n in list(open_.items()):
            if target[s] >= 2 * n:
                target[s] = 2.0 * n
                del open_[s]
    assert got == pytest.approx(target)


def test_mix(docs, rows, nothing):
    got = mixing.plan(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and all(0 < u["take"] <= r["size"] for u in r["uses"])
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert sum(sizes.values()) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows)
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    again = mixing.plan(docs.repartition(3)).collect()
    key = lambda r: (r["id"] is None, r["id"] or 0, r["size"], str(r["source"]), r["taken"])
    assert [key(r) for r in sorted(got, key=key)] == [key(r) for r in sorted(again, key=key)]
    positions = [u["position"] for r in got for u in r["uses"]]
    assert min(positions) == 0 and max(positions) < 1.5 * sum(sizes.values())
    assert mixing.plan(nothing).count() == 0


def test_schedule_inverse(spark):
    for phase in mixing.CURRICULUM:
        rows = spark.range(11).select((F.col("id") / 10).alias("part"))
        got = rows.select("part", mixing.demand(phase, mixing.time_of(phase, F.col("part"))).alias("back")).collect()
        assert all(r["back"] == pytest.approx(r["part"]) for r in got)


# 8 neighbours


def brute_neighbours(rows, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, a in good:
        if q % 50 == 0:
            scores = [(-float(a @ b / math.sqrt((a @ a) * (b @ b))), i) for i, b in good if i != q]
            out[q] = sorted(scores)[:k]
    return out




def test_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(16) + 3 * (i % 7 == 0)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(30)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2050, [float("inf")] * 16), (None, rows[3][1]), (2004, [1.0] * 9), (2005, [])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, key string, score int")
    got = defaultdict(list)
    for r in lsh.nearest(frame, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    expected = brute_neighbours([r for r in rows if r[0] != 2004])
    assert set(got) == set(expected) and all(len(v) == 5 for v in got.values())
    assert [v for v, _ in got[50]] == [1000, 1001, 1002, 1003, 1004]
    found = sum(len({v for v, _ in got[q]} & {i for _, i in expected[q]}) for q in expected)
    assert found >= 0.9 * 5 * len(expected)


def test_few_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = lsh.nearest(frame, F.col("id") % 50 == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 0.0), (1, -1.0)]
    assert lsh.nearest(frame.where("false"), F.col("id") == 0).count() == 0


def test_recall_on_the_table(spark):
    rows = [tuple(r) for r in common.table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding").collect()]
    expected = brute_neighbours(rows)
    got = defaultdict(set)
    for r in lsh.nearest(common.table(spark, "/root/testdata/sf0.1", "embeddings"), F.col("id") % 50 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    assert sum(len(got[q] & {i for _, i in e}) for q, e in expected.items()) >= 0.9 * sum(map(len, expected.values()))


# 9 contamination


def brute_contamination(rows, items, n=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for doc, text in rows:
        w, hit, names = words(text), set(), set()
        for item, t in items:
            b = words(t)
            size = min(n, len(b))
            runs = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)} if b else set()
            for i in range(len(w) - size + 1):
                if size and tuple(w[i : i + size]) in runs:
                    hit |= set(range(i, i + size))
                    if item is not None:
                        names.add(str(item))
        out.append((doc, len(w), len(hit), len(names), tuple(sorted(names)), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize(("chunk", "words_at_once"), [(phrases.CHUNK_WORDS, phrases.PASS_WORDS), (300, 20)])
def test_contamination(spark, docs, rows, nothing, monkeypatch, chunk, words_at_once):
    long = max((r[1] or "" for r in rows), key=len).split()
    items = [(1, " ".join(long[100:125])), (2, rows[4][1]), (10, "Two words"), (11, "one"), (None, "no ID"), (12, None), (13, " ... "), (1, " ".join(long[100:125])), (14, "never seen words at all"), (9, " ".join(long[118:140]).upper())]
    frame = spark.createDataFrame([(*i, "x", 0) for i in items], "item_id long, text string, term string, n int")
    monkeypatch.setattr(phrases, "PASS_WORDS", words_at_once)
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    got = Counter((r[0], r[1], r[2], r[3], tuple(r[4]), r[5]) for r in phrases.contamination(docs, frame).collect())
    assert got == brute_contamination([r[:2] for r in rows], items)
    assert phrases.contamination(nothing, frame).count() == 0
    assert phrases.contamination(docs, frame.where("false")).where("contaminated").count() == 0


def test_whole_index_and_proximity(spark):
    texts = ["a b c d e", "a x x b x x c", "c x x x x x x x x a b", "b", None]
    index = phrases.build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    found = phrases.search(index, phrases.windows_of([("i", "a b c")]), span=6).collect()
    assert sorted((r["doc_id"], r["kind"]) for r in found) == [(0, "exact"), (0, "near"), (1, "near")]


# 10 personal data


def brute_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((*m.span(), 0))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), 1))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0:
            out.append((*m.span(), 2))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((*m.span(), 3))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def test_base_spans_against_plain_patterns():
    rng = random.Random(9)
    pieces = ["a", "B7", "@", ".", "-", " ", "1", "255", "0256", "4316522678525456", "+1 (830) 555-5433", "x.y@z.co", "+", "é", "\u0663", "10.0.0.1", "(", "4242-4242-4242-4242"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == brute_base(text), repr(text)


def test_long_runs_take_linear_time():
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == [] and pii.base_spans("+1(" * 60_000) == []


def test_message_passing_is_exact_on_a_chain():
    rng = np.random.default_rng(0)
    w = pii.Weights(rng.normal(size=(pii.WIDTH, 5)), rng.normal(size=(5, 5)), np.zeros((5, 5)))
    f = rng.integers(0, 2, (4, pii.WIDTH)).tolist()
    g = pii.Graph([(0, 1)] * 4, f, [-1, -1, 2, -1], [(0, 1), (1, 2), (2, 3)], [])
    unary, total = np.array(f) @ w.unary, np.zeros((4, 5))
    for labels in np.ndindex(5, 5, 5, 5):
        if labels[2] == 3:
            p = np.exp(sum(unary[i, k] for i, k in enumerate(labels) if i != 2) + sum(w.chain[labels[i], labels[i + 1]] for i in range(3)))
            for i, k in enumerate(labels):
                total[i, k] += p
    assert np.allclose(pii.infer(g, w), total / total.sum(axis=1, keepdims=True), atol=1e-3)


def test_repeated_tokens_take_the_label_of_a_found_one(spark):
    sf = "/root/testdata/sf0.01"
    weights = pii.train(common.table(spark, sf, "documents"))
    text = "Call +1 (830) 555-5433 today. Or later: 555-5433 it is. Room 12."
    docs = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "", 0), (None, "a@b.co", 0), (5, "Only 1234567 here", 0)], "doc_id long, text string, base int")
    got = {r["id"]: r for r in pii.find(docs, weights).collect()}
    at = text.index("555-5433 it")
    assert got[1]["base"] == ["phone:5:22"] and got[1]["added"] == [f"phone:{at}:{at + 8}"]
    assert got[2]["base"] == got[3]["base"] == [] and got[None]["base"] == ["email:0:6"] and got[5]["added"] == []
    assert pii.find(docs.where("false"), weights).count() == 0
    assert not pii.train(docs.where("false")).unary.any()


def test_spans_stay_base_spans(spark):
    from jobloom.llm.queries import op10_personal_data

    docs = {r["doc_id"]: r["text"] or "" for r in common.table(spark, "/root/testdata/sf0.001", "documents").collect()}
    for r in op10_personal_data(spark, "/root/testdata/sf0.001").collect():
        base = [pii.write_span(s) for s in brute_base(docs[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(r["spans"].split(","))
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]


# pipeline


def test_pipeline_stages(spark, docs, rows, nothing, tmp_path):
    rng = random.Random(8)
    sf = str(tmp_path)
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    item = prose(rng, 20)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    leak = [(500, f"stone {item} river " + rows[0][1], "en", "a", 0, 7, "x", 1, 2), (501, "§$%&/ ##### !!!! ((( ]]] " * 20, "en", "a", 0, 7, "x", 1, 2)]
    all_docs = cut(docs.unionByName(spark.createDataFrame(leak, DOCS)).drop("_slot"), "documents")
    kept = cut(corpus_pipeline.quality(spark, all_docs, sf), "stage")
    ids = Counter(r[0] for r in kept.select("doc_id").collect())
    assert kept.columns == all_docs.columns and 501 not in ids and 500 in ids and ids[3] == 2
    single = cut(corpus_pipeline.near_duplicates(spark, kept, sf), "stage")
    left = Counter(r[0] for r in single.select("doc_id").collect())
    groups = {r["id"]: r["component_id"] for r in simhash.near_duplicates(kept.where("doc_id is not null")).collect()}
    assert set(left) - {None} == {i for i, c in groups.items() if i == c} and max(left.values()) == 1
    clean = cut(corpus_pipeline.decontaminate(spark, single, sf), "stage")
    assert set(left) - {r[0] for r in clean.select("doc_id").collect()} == {500}
    mixed = cut(corpus_pipeline.mix(spark, clean, sf), "stage")
    taken = {r["id"]: len([u for u in r["uses"] if 2 * u["take"] >= r["size"]]) for r in mixing.plan(clean.where("doc_id is not null")).collect()}
    counts = Counter(r[0] for r in mixed.select("doc_id").collect())
    assert mixed.columns == clean.columns and max(counts.values()) <= 2 and set(counts) - {None} <= set(taken)
    sharded = cut(corpus_pipeline.shard(spark, mixed, sf), "stage")
    assert sharded.count() == mixed.count() and sharded.columns == [*mixed.columns, "virtual_slot", "shard"]
    empty = nothing.drop("_slot")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.count() == 0


def test_rows_that_share_an_id_are_told_apart(spark, tmp_path):
    """A text of its own stays though another row of its id is a copy, leaks, or is junk; of equal rows one stays."""
    rng = random.Random(2)
    t, u, v, item = prose(rng, 80), prose(rng, 90), prose(rng, 70), prose(rng, 30)
    rows = [(1, t), (2, t), (2, u), (3, v), (3, v), (3, f"{u[:40]} {item} {v[40:]}"), (4, prose(rng, 60)), (None, t), (None, prose(rng, 50))]
    good, junk = [(100 + i, prose(rng, 40)) for i in range(60)], (4, "§$%&/ ##### !!!! ((( ]]] " * 20)
    sf = str(tmp_path)
    spark.createDataFrame([(i, 1, 0) for i, _ in good], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    written = lambda own: cut(spark.createDataFrame([(i, x, "en", "a", len(x)) for i, x in own], "doc_id long, text string, lang string, source string, n_chars long"), "documents")
    held = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    known = held(corpus_pipeline.quality(spark, written([*good, *rows, junk]), sf))
    assert junk not in known and sum(i == 4 for i, _ in known) == 1
    docs = written(rows)
    assert held(corpus_pipeline.near_duplicates(spark, docs, sf)) == sorted([r for i, r in enumerate(rows) if i not in (1, 4, 7)], key=repr)
    assert held(corpus_pipeline.decontaminate(spark, docs, sf)) == sorted([r for i, r in enumerate(rows) if i != 5], key=repr)


def test_pipeline_on_a_table(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 0 and {"doc_id", "text", "shard"} <= set(got.columns)


def test_oracles(spark):
    from check import compare, connect
    from jobloom.llm.oracles import ORACLES

    con = connect("/root/testdata/sf0.001")
    for name in ORACLES:
        assert compare(spark, con, name, "/root/testdata/sf0.001")[0] == "ok"
