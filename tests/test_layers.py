"""Versioned tables and the calendar of odd days."""

import datetime

import pytest
from pyspark.sql import functions as F

from jobloom.functions.text import date_key, key_date
from jobloom.operators import dims, quality, search
from jobloom.plans import analytics
from jobloom.session import scratch_path
from jobloom.sources import layers, versions


def table(spark, *rows):
    return spark.createDataFrame(rows, "id long, source string")


def test_readers_keep_their_version_during_a_rebuild(spark, rows):
    root = scratch_path(spark, "tables")
    first = layers.materialize(table(spark, (1, "a"), (2, "b")), "marts", "t", root, ["source"])
    second = layers.materialize(table(spark, (3, "b"), (4, None)), "marts", "t", root, ["source"])
    assert rows(first) == [(1, "a"), (2, "b")] and rows(second) == [(3, "b"), (4, None)]
    assert rows(layers.read_table(spark, root, "marts", "t")) == rows(second)
    assert rows(layers.read_table(spark, root, "marts", "t", version=0)) == rows(first)
    assert layers.drop_old_versions(spark, root, "marts", "t", keep=1) == 1
    assert rows(layers.read_table(spark, root, "marts", "t")) == rows(second)
    with pytest.raises(FileNotFoundError):
        layers.read_table(spark, root, "marts", "other")


def test_a_refresh_that_breaks_off_is_not_seen(spark, rows):
    root = scratch_path(spark, "tables")
    layers.materialize(table(spark, (1, "a")), "marts", "t", root)
    broken = table(spark, (2, "b")).select(F.raise_error(F.lit("lost")).cast("long").alias("id"), "source")
    with pytest.raises(Exception, match="lost"):
        layers.materialize(broken, "marts", "t", root)
    assert rows(layers.read_table(spark, root, "marts", "t")) == [(1, "a")]
    assert len(versions.children(spark, f"{layers.table_path(root, 'marts', 't')}/data")) >= 1
    assert versions.numbers(spark, layers.table_path(root, "marts", "t")) == [0]


def test_filters_on_partition_columns_pick_folders(spark):
    root = scratch_path(spark, "tables")
    stored = layers.materialize(table(spark, (1, "a"), (2, "b")), "marts", "t", root, ["source"])
    for found in (stored.where("source = 'a'"), search.filter_jobs(stored, source="A")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        scan = plan[plan.index("PartitionFilters: [") :]
        assert "source" in scan[: scan.index("]")] and [r.id for r in found.collect()] == [1]


DAYS = [datetime.date(1, 1, 1), datetime.date(999, 12, 31), datetime.date(1969, 12, 31), datetime.date(1970, 1, 1), datetime.date(2025, 2, 28), datetime.date(9999, 12, 31), None]


def test_keys_and_days_of_any_year(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date").withColumn("key", date_key(F.col("d")))
    assert [r.day for r in df.select(key_date(F.col("key")).alias("day")).collect()] == DAYS
    assert df.first().key == 10101


def test_an_impossible_year_adds_one_day_to_the_calendar(spark):
    postings = spark.createDataFrame([(d,) for d in DAYS], "d date").select(date_key(F.col("d")).alias("date_posted_key"))
    span = dims.calendar_span(postings)
    assert span == ("1970-01-01", "2027-12-31")
    calendar = dims.build_dim_date(spark, *span, dims.stray_days(postings))
    days = [r.full_date for r in calendar.orderBy("full_date").collect()]
    assert len(days) == len(set(days)) == (datetime.date(2027, 12, 31) - datetime.date(1970, 1, 1)).days + 1 + 4
    assert set(DAYS) - {None} <= set(days)
    assert dims.calendar_span(postings.limit(0)) == (dims.CALENDAR_START, dims.CALENDAR_END)
    assert analytics.postings_per_week(postings).count() == 6  # two days share a week, and no day is a week of its own
    late = quality.run_suite(postings, "p", [quality.accepted_range("date_posted_key", *quality.DATE_KEYS)]).first()
    assert (late.failed_rows, late.passed) == (4, False)
