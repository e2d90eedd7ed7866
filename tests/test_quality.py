"""Checks that fail: counts, keys, quarantine, landed lines."""

from datetime import datetime

import pytest

from catalog.queries import QUERIES
from jobloom.operators import quality
from jobloom.session import scratch_path
from jobloom.sources.raw import read_raw_json

SF_DIR = "/root/testdata/sf0.001"
CHECKS = [
    *quality.not_null("id"),
    quality.accepted_values("kind", ("a", "b")),
    quality.accepted_range("low", 0, 10),
    quality.ordered("low", "high"),
    quality.fresh("at", 7),
    *quality.unique("id"),
    quality.row_count(1),
]
NOW, OLD = datetime(2026, 5, 10), datetime(2026, 5, 1)
ROWS = [(1, "a", 1, 2, NOW), (2, "x", 1, 2, NOW), (3, "b", 11, 2, OLD), (None, "c", 5, 4, None), (5, None, None, None, NOW), (5, "a", 0, 10, NOW)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "id long, kind string, low int, high int, at timestamp")


def test_offenders_are_named_by_two_keys(spark, table):
    found = {(r.column, r.check): (r.failed_rows, r.first_key, r.last_key) for r in quality.offenders(table, "t", CHECKS, "id", NOW).collect()}
    assert found == {
        ("id", "not_null"): (1, None, None), ("kind", "accepted_values"): (2, 2, 2), ("low", "accepted_range"): (1, 3, 3),
        ("high", "ordered"): (2, 3, 3), ("at", "fresh"): (1, 3, 3),
    }
    counted = {(r.column, r.check): r.failed_rows for r in quality.run_suite(table, "t", CHECKS, as_of=NOW).collect()}
    assert all(counted[k] == n for k, (n, _, _) in found.items()) and counted[("id", "unique")] == 1
    with pytest.raises(ValueError):
        quality.offenders(table, "t", [quality.row_count(1)], "id")


def test_quarantine_splits_rows(spark, table, rows):
    kept, held = quality.quarantine(table, CHECKS, NOW)
    assert kept.columns == table.columns and rows(kept) == sorted([ROWS[0], ROWS[4], ROWS[5]], key=repr)
    assert {r.id: r.failed_checks for r in held.collect()} == {
        2: ["kind:accepted_values"], 3: ["low:accepted_range", "high:ordered", "at:fresh"], None: ["id:not_null", "kind:accepted_values", "high:ordered"],
    }
    everything, nothing = quality.quarantine(table, [])
    assert everything.count() == len(ROWS) and nothing.count() == 0


def test_every_check_can_fail(spark):
    results = QUERIES["dq_damaged"](spark, SF_DIR).collect()
    assert len(results) == 13 and all(r.failed_rows > 0 and not r.passed for r in results)
    assert all(r.failed_rows > 0 for r in QUERIES["dq_offenders"](spark, SF_DIR).collect())
    assert QUERIES["dq_salary_range_damaged"](spark, SF_DIR).count() > 0


def test_landed_lines_are_read_or_kept_aside(spark):
    path = scratch_path(spark, "lines")
    whole = '{"raw_id": 1, "source": "s", "source_id": "a", "scraped_at": "2026-05-01T00:00:00Z", "raw_data": "{}", "more": [1]}'
    lines = [whole, whole[:40], whole.replace(": 1,", ': "one",'), whole.replace('"a"', "null"), "", "[]", whole.replace('"raw_id": 1, ', "")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, aside = read_raw_json(spark, path)
    assert sorted((r.raw_id, r.source_id) for r in good.collect() if r.raw_id) == [(1, "a")] and good.count() == 2
    assert sorted((r.reason, r.record) for r in aside.collect()) == sorted([("unreadable", x) for x in (lines[1], lines[2], "[]")] + [("incomplete", lines[3])])
