"""The stored upsert table: copies on write, merged runs, retries, old readers."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from jobloom.session import scratch_path
from jobloom.sources import store, versions
from jobloom.streaming import ingest

SCHEMA = "source string, source_id string, scraped_at timestamp, raw_data string, seq long"
AT = datetime(2026, 5, 1)


def batch(spark, *writes):
    """writes: (key, data) in order."""
    return spark.createDataFrame([("s", k, AT, d, i) for i, (k, d) in enumerate(writes)], SCHEMA)


def content(df):
    return sorted((r.raw_id, r.source_id, r.raw_data) for r in df.collect())


def files(spark, root):
    return {f for f in versions.children(spark, f"{root}/data") for f in [f, *[f"{f}/{b}" for b in versions.children(spark, f"{root}/data/{f}")]]}


@pytest.fixture()
def root(spark):
    path = scratch_path(spark, "store")
    store.create(spark, path, buckets=8)
    return path


def test_upsert_keeps_ids_and_untouched_files(spark, root):
    first = store.upsert(spark, root, batch(spark, *[(f"k{i}", "a") for i in range(40)]))
    assert content(store.read(spark, root)) == sorted((i + 1, f"k{i}", "a") for i in range(40))
    second = store.upsert(spark, root, batch(spark, ("k7", "b"), ("new", "x"), ("k7", "c")))
    changed = {b for b in second.runs if second.runs[b] != first.runs[b]}
    assert 1 <= len(changed) <= 2 and all(len(r) == 1 for r in second.runs.values())
    rows = {r.source_id: r for r in store.read(spark, root).collect()}
    assert (rows["k7"].raw_id, rows["k7"].raw_data, rows["new"].raw_id, len(rows)) == (8, "c", 41, 41)


def test_a_repeated_batch_changes_nothing(spark, root):
    writes = batch(spark, ("a", "1"), ("b", "2"), (None, "3"), (None, "4"))
    once = store.upsert(spark, root, writes)
    before = files(spark, root)
    assert store.upsert(spark, root, writes) == once and files(spark, root) == before
    assert [(r.source_id, r.raw_data) for r in store.read(spark, root).collect() if r.source_id is None] == [(None, "4")]
    marked = store.upsert(spark, root, batch(spark, ("a", "9")), stream="daily", number=3)
    for number in (2, 3):  # older than what was applied: passed over
        assert store.upsert(spark, root, batch(spark, ("a", "old")), stream="daily", number=number) == marked
    assert store.upsert(spark, root, batch(spark, ("a", "9")), stream="daily", number=4).version == marked.version + 1


def test_readers_keep_their_version(spark, root):
    store.upsert(spark, root, batch(spark, ("a", "1"), ("b", "1")))
    opened = store.read(spark, root)
    store.upsert(spark, root, batch(spark, ("a", "2")))
    store.append(spark, root, batch(spark, ("b", "3")))
    assert content(opened) == [(1, "a", "1"), (2, "b", "1")]
    assert content(store.read(spark, root, version=1)) == content(opened)
    assert content(store.read(spark, root)) == [(1, "a", "2"), (2, "b", "3")]


def test_a_version_is_written_once(spark, root):
    with pytest.raises(versions.VersionTaken):
        versions.commit(spark, root, 0, {})
    assert versions.children(spark, f"{root}/{versions.FOLDER}") == ["v000000000000.json"]


def test_keys_are_read_from_their_buckets(spark, root):
    store.upsert(spark, root, batch(spark, *[(f"k{i}", str(i)) for i in range(50)]))
    found = store.read_keys(spark, root, [("s", "k3"), ("s", "none"), ("s", "k3")])
    assert content(found) == [(4, "k3", "3")]
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 2


def test_expire_keeps_what_is_named(spark, root):
    for i in range(4):
        store.upsert(spark, root, batch(spark, ("a", str(i)), (f"k{i}", "x")))
    now = content(store.read(spark, root))
    assert store.expire(spark, root, keep=1) >= 1
    assert content(store.read(spark, root)) == now and versions.numbers(spark, root) == [4]


def test_empty_batches_and_tables(spark, root):
    assert store.read(spark, root).count() == 0
    assert store.upsert(spark, root, batch(spark, ("a", "1")).limit(0)).version == 0
    store.append(spark, root, batch(spark, ("a", "1")).limit(0), stream="s", number=0)
    assert store.read(spark, root).count() == 0 and store.open_table(spark, root).applied == {"s": 0}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.booleans(), st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 3)), max_size=6)), max_size=6))
def test_both_ways_of_writing_agree_with_a_dict(spark, steps):
    path = scratch_path(spark, "store")
    store.create(spark, path, buckets=3)
    known = {}
    for copy, writes in steps:
        (store.upsert if copy else lambda *a: store.append(*a, fanout=2))(spark, path, batch(spark, *[(k, str(v)) for k, v in writes]))
        for k, v in writes:
            known[k] = str(v)
    rows = store.read(spark, path).collect()
    assert {r.source_id: r.raw_data for r in rows} == known and len({r.raw_id for r in rows}) == len(rows)


def test_stream_of_six_files_merges_and_restarts(spark):
    landed, path, checkpoint = (scratch_path(spark, n) for n in ("landed", "store", "check"))
    store.create(spark, path, buckets=2)
    seen = {}

    def run():
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{landed}/*")
        ingest.upsert_stream_batches(source, path, checkpoint, fanout=2).awaitTermination()

    for n in range(6):
        writes = [(f"k{i}", f"{n}:{i}") for i in range(n + 2)]
        batch(spark, *writes).coalesce(1).write.parquet(f"{landed}/day={n}")
        seen.update(writes)
        if n in (2, 5):
            run()
    table = store.open_table(spark, path)
    run()  # nothing new
    assert table.merges >= 2 and table.applied == {"ingest": 5} and store.open_table(spark, path) == table
    rows = store.read(spark, path).collect()
    assert {r.source_id: r.raw_data for r in rows} == seen
    assert [r.source_id for r in sorted(rows)] == [f"k{i}" for i in range(7)]  # ids in the order of first writes
    again = batch(spark, ("k0", "lost"))
    assert store.append(spark, path, again, stream="ingest", number=5) == table  # a retry of the last micro-batch
