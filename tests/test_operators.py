import random
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.operators import dims, positions, quality, search, staging, unify
from jobloom.operators.joins import left_join_dimension
from jobloom.plans import analytics
from jobloom.plans.warehouse import build_warehouse
from jobloom.session import scratch_path
from jobloom.sources import layers, versions
from jobloom.sources.raw import read_raw, read_seed, upsert_raw

T = [datetime(2026, 5, d) for d in range(1, 20)]
# The two planned postings of a smallest data set, plus one of every other source.
RAW = [
    (1, "philjobnet", "p1", T[0], '{"title":"Software Engineer","company":"Acme","location":"Makati City","salary_raw":"PHP 30,000-50,000","education_level":"College"}'),
    (2, "kalibrr", "k1", T[0], '{"title":" Data Analyst ","company":"ACME ","location":"BGC, Taguig","salary_raw":"40k-60k","skills":["Python","SQL"],"experience_level":"Entry"}'),
    (3, "kalibrr", "k1", T[1], '{"title":"Data Analyst","company":"acme","location":"BGC, Taguig","salary_raw":"40k-60k","skills":["Python"],"posted_date":"2026-04-30T00:00:00Z"}'),
    (4, "onlinejobs", "o1", T[1], '{"title":"Writer","salary_raw":"$5/hour","salary_currency":"usd","is_remote":false}'),
    (5, "onlinejobs", "o2", T[1], '{"title":"Editor"}'),
    (6, "indeed", "i1", T[2], '{"title":null,"company":"X"}'),
    (7, "jobstreet", "j1", T[2], '{"title":"Python dev","description":"SQL and python","location":"Remote"}'),
    (8, "jobstreet", "j1", T[2], '{"title":"Python dev 2","description":"SQL and python","location":"Remote"}'),
    (9, "facebook", "f1", T[2], '{"title":"Other"}'),
    (10, "indeed", "i2", T[2], "broken json"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, schemas.RAW)


@pytest.fixture(scope="module")
def marts(spark, raw):
    return build_warehouse(spark, raw)


def test_stage_all_is_union_of_stages(raw, rows):
    assert rows(staging.stage_all(raw)) == rows(unify.unify(staging.stage(raw, s) for s in staging.SPECS))
    assert staging.stage_all(raw).columns == schemas.CANONICAL.names
    assert rows(staging.stage_all(raw).select("raw_id")) == [(i,) for i in (1, 2, 3, 4, 5, 7, 8)]


def test_blob_is_parsed_once(raw):
    plan = staging.stage_all(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple") == 1 and "get_json" not in plan


def test_source_predicate_reaches_the_scan(spark, raw):
    path = scratch_path(spark, "raw")
    raw.write.partitionBy("source").parquet(path)
    stored = read_raw(spark, path)
    plan = staging.stage(stored, "kalibrr")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan
    assert staging.stage(stored, "kalibrr").count() == 2


def test_dedup(raw, rows):
    staged = staging.stage_all(raw)
    once = unify.dedup_latest(staged)
    assert once._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert rows(once.select("raw_id")) == [(1,), (3,), (4,), (5,), (8,)]
    assert rows(unify.dedup_latest(staged.unionByName(staged))) == rows(once)
    ranked = unify.rank_duplicates(staged)
    assert rows(ranked.where("rn = 1").drop("rn")) == rows(once)


def test_hot_key_ranks(spark):
    """A third of all rows share one key; ranks are still 1..n per key."""
    df = spark.range(3000).select(
        F.col("id").alias("raw_id"),
        F.lit("s").alias("source"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("source_id"),
        F.timestamp_seconds(F.col("id") * 7 % 1000).alias("scraped_at"),
    )
    got = {(r.source_id, r.raw_id): r.rn for r in unify.rank_duplicates(df).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r.source_id, []).append((r.scraped_at, r.raw_id))
    want = {(k, i): n for k, v in groups.items() for n, (_, i) in enumerate(sorted(v, reverse=True), 1)}
    assert got == want


def test_ranks_sort_slim_rows(spark, rows):
    """Only key and order columns are range partitioned and sorted; rows that tie in all of them still get a number each."""
    df = spark.range(400).select(
        F.col("id").alias("raw_id"),
        F.when(F.col("id") % 4 > 0, "s").alias("source"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 7).cast("string")).alias("source_id"),
        F.when(F.col("id") % 5 > 0, F.timestamp_seconds(F.col("id") % 11)).alias("scraped_at"),
        F.repeat(F.lit("x"), 100).alias("description"),
    )
    wide = positions.rank_within(df, unify.POSTING_KEY, unify.newest_first(), "rn")
    slim = unify.rank_duplicates(df)
    assert slim.columns == [*df.columns, "rn"] and rows(slim) == rows(wide)
    window = Window.partitionBy("source", "source_id").orderBy(*unify.newest_first())
    assert rows(slim) == rows(df.withColumn("rn", F.row_number().over(window).cast("bigint")))
    plan = slim._jdf.queryExecution().executedPlan().toString()
    sorted_columns = [scan for scan in plan.splitlines() if "FileScan" in scan and "_part" in scan]
    assert sorted_columns and not any("description" in scan for scan in sorted_columns)
    assert "description" not in unify.rank_duplicates(df).select("raw_id", "rn")._jdf.queryExecution().executedPlan().toString()
    again = rows(unify.rank_duplicates(df.unionByName(df)).groupBy("source", "source_id").agg(F.count("*"), F.max("rn"), F.count_distinct("rn")))
    assert all(n == top == different for _, _, n, top, different in again)
    assert unify.rank_duplicates(df.limit(0)).count() == 0


def test_new_ids_are_given_without_payloads(spark, rows):
    """Payloads of new rows are neither range partitioned nor written to be numbered; null keys are keys."""
    current = spark.createDataFrame([], "raw_id long, source string, source_id string, scraped_at timestamp, raw_data string")
    batch = spark.createDataFrame([(None, "a", T[0], "1", 3), ("s", None, T[0], "2", 2), ("s", "b", T[0], "3", 1)], "source string, source_id string, scraped_at timestamp, raw_data string, seq long")
    added = upsert_raw(current, batch)
    assert rows(added.select("raw_id", "raw_data")) == [(1, "3"), (2, "2"), (3, "1")]
    scans = [scan for scan in added._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in scan and "_part" in scan]
    assert scans and not any("raw_data" in scan or "latest" in scan for scan in scans)


def test_dense_key(spark, rows):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).cast("string").alias("name"))
    keyed = positions.dense_key(df, ["name"], "key")
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1  # only the table of partition sizes
    assert rows(keyed) == rows(positions.dense_key(df, ["name"], "key", bounded=True))


def test_marts(marts, rows):
    assert rows(marts.dim_companies.select("company_key", "company_name", "company_lower", "total_postings")) == [(1, "acme", "acme", 2)]
    facts = {r.job_key: r for r in marts.fct_job_postings.collect()}
    assert set(facts) == {1, 3, 4, 5, 8}
    assert (facts[1].salary_min, facts[1].salary_max, facts[1].company_key) == (30000, 50000, 1)
    assert (facts[3].date_posted_key, facts[3].date_scraped_key) == (20260430, 20260502)
    assert (facts[4].salary_currency, facts[4].salary_period, facts[4].is_remote) == ("USD", "hourly", False)
    assert (facts[5].salary_currency, facts[5].salary_period, facts[5].is_remote) == ("PHP", None, True)
    assert facts[8].is_remote is True
    demand = search.skill_demand_list(marts.fct_skill_demand, marts.dim_skills)
    assert rows(demand.select("skill_name", "source", "posting_count")) == [
        ("Python", "jobstreet", 1),
        ("Python", "kalibrr", 1),
        ("SQL", "jobstreet", 1),
    ]
    assert marts.dim_date.count() == 1461 and marts.dim_skills.count() == 74


def test_skew_safe_join_equals_left_join(spark, rows):
    fact = spark.range(2000).select(
        F.col("id").alias("raw_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("c"), F.col("id") % 40)).alias("name"),
    )
    dim = fact.where("name is not null and name <> 'c1'").groupBy("name").count().withColumn("key", F.xxhash64("name"))
    want = fact.join(dim.select("name", "key"), "name", "left").select("raw_id", "name", "key")
    for small in (0, 1 << 30):
        got = left_join_dimension(fact, dim, F.col("name"), "name", "count", {"key": "key"}, small_bytes=small)
        assert rows(got.select("raw_id", "name", "key")) == rows(want)


def test_upsert(spark, raw, rows):
    current = raw.where("raw_id in (1, 2, 4)")
    batch = spark.createDataFrame(
        [
            ("kalibrr", "k1", T[4], "first", 1),
            ("kalibrr", "k1", T[3], "last", 2),
            ("indeed", "new2", T[5], "n2", 3),
            ("indeed", "new1", T[5], "n1", 4),
            ("indeed", "new2", T[6], "n2b", 5),
        ],
        "source string, source_id string, scraped_at timestamp, raw_data string, seq long",
    )
    once = upsert_raw(current, batch)
    got = {(r.source, r.source_id): (r.raw_id, r.scraped_at, r.raw_data) for r in once.collect()}
    assert got[("kalibrr", "k1")] == (2, T[3], "last")
    assert got[("indeed", "new2")] == (5, T[6], "n2b")
    assert got[("indeed", "new1")] == (6, T[5], "n1")
    assert got[("philjobnet", "p1")][0] == 1 and len(got) == 5
    assert rows(upsert_raw(once, batch)) == rows(once)


def test_snapshot_append_is_idempotent(spark, rows):
    path = scratch_path(spark, "snap")
    day = lambda d, n: spark.createDataFrame([(T[d].date(), n)], "snapshot_date date, posting_count long")
    for d, n in [(0, 1), (1, 2), (1, 2), (0, 7)]:
        layers.append_snapshot(day(d, n), path)
    assert rows(layers.read_snapshots(spark, path, day(0, 0))) == [(T[0].date(), 7), (T[1].date(), 2)]


def test_snapshot_runs(spark, rows):
    """Days in any order, replaced days, days of none and merges, against a dictionary; no stored row is written again
    before a level is full, and older versions stay readable."""
    path, rng = scratch_path(spark, "snap"), random.Random(5)
    make = lambda days: spark.createDataFrame([(T[d].date() if d is not None else None, v) for d, v in days], "snapshot_date date, posting_count long").coalesce(1)
    held, loose, old = {}, [], {}
    for step in range(9):
        days = [(d, rng.randint(0, 99)) for d in rng.sample(range(8), rng.randint(0, 3))] + ([(None, step)] if step % 4 == 0 else [])
        before = set(versions.children(spark, f"{path}/data"))
        layers.append_snapshot(make(days), path, runs=3)
        held |= {T[d].date(): v for d, v in days if d is not None}
        loose += [(None, v) for d, v in days if d is None]
        old[step] = sorted([*held.items(), *loose], key=repr)
        assert before <= set(versions.children(spark, f"{path}/data"))
    for step, want in old.items():
        assert rows(layers.read_snapshots(spark, path, make([(0, 0)]), step)) == want
    runs = versions.load(spark, path)[1]["runs"]
    assert len(runs) <= 2 * 3 and max(r["level"] for r in runs) >= 1
    layers.drop_old_snapshots(spark, path, keep=1)
    assert len(versions.children(spark, f"{path}/data")) == len(runs)
    assert rows(layers.read_snapshots(spark, path, make([(0, 0)]))) == old[8]


def test_run_log_and_health(spark):
    runs = spark.createDataFrame(
        [
            (1, "a", T[0], T[1], 5, "success", None),
            (2, "a", T[2], None, None, None, None),
            (3, "b", T[0], T[1], 0, "error", "x" * 1500),
        ],
        schemas.RUN_LOG,
    )
    path = scratch_path(spark, "log")
    layers.append_run_log(runs, path)
    log = layers.read_run_log(spark, path)
    assert max(len(r.error_message or "") for r in log.collect()) == 1500
    assert max(len(r.error_message or "") for r in layers.run_log_rows(runs, error_length=1000).collect()) == 1000
    health = {r.source: r for r in layers.run_health(log).collect()}
    assert (health["a"].runs, health["a"].last_status, health["a"].empty_runs) == (2, "running", 1)
    assert (health["b"].failed_runs, health["b"].records_total) == (1, 0)


def test_layers(spark, raw):
    root = scratch_path(spark, "layers")
    assert layers.table_path("/x/", "marts", "t") == "/x/warehouse/t"
    assert layers.schema_of("intermediate") == "dev"
    layers.materialize(raw, "staging", "raw_test")
    assert spark.table("staging_raw_test").count() == len(RAW)
    assert layers.materialize(raw, "intermediate", "raw_test") is raw
    assert layers.materialize(raw, "marts", "raw_test", root).count() == len(RAW)
    with pytest.raises(ValueError):
        layers.materialize(raw, "marts", "raw_test")


def test_seed_from_file(spark, rows):
    import jobloom

    for name in ("skill_terms", "regions"):
        path = f"{jobloom.__path__[0]}/seeds/{name}.csv"
        assert rows(read_seed(spark, name)) == rows(read_seed(spark, name, path))
    assert read_seed(spark, "skill_terms").count() == 96 and read_seed(spark, "regions").count() == 36


JOBS = [(i, "kalibrr" if i % 2 else "indeed", f"Job {i}", None if i % 5 == 0 else float(i * 100), None if i % 7 == 0 else 20260000 + i) for i in range(1, 61)]


@pytest.fixture(scope="module")
def jobs(spark):
    return spark.createDataFrame(JOBS, "job_key long, source string, title string, salary_min double, date_posted_key int")


def test_pages_add_up_to_the_full_order(jobs):
    order = search.ordering("-date_posted_key", search.JOB_ORDER, ["-date_posted_key"], "job_key")
    full = [r.job_key for r in jobs.orderBy(*order).collect()]
    pages = [r.job_key for n in (1, 2, 3) for r in search.page(jobs, order, n).rows.collect()]
    assert pages == full and full[0] == 7  # NULL dates first
    assert search.page(jobs, order).total.first()[0] == 60
    seen, last = [], None
    first = search.page(jobs, order, 1).rows.collect()
    seen += [r.job_key for r in first]
    last = first[-1]
    while True:
        more = search.page_after(jobs, "date_posted_key", last.date_posted_key, "job_key", last.job_key).collect()
        if not more:
            break
        seen += [r.job_key for r in more]
        last = more[-1]
    assert seen == full


def test_ordering_and_filters(jobs):
    unknown = search.ordering("description", search.JOB_ORDER, ["-salary_min"], "job_key")
    assert [r.salary_min for r in jobs.orderBy(*unknown).limit(2).collect()] == [None, None]
    up = search.ordering("salary_min", search.JOB_ORDER, [], "job_key")
    assert jobs.orderBy(*up).first().salary_min == 100.0
    assert search.filter_jobs(jobs, source="KALIBRR", salary_min_gte=5000).count() == len(
        [j for j in JOBS if j[1] == "kalibrr" and j[3] and j[3] >= 5000]
    )
    assert search.search(jobs, "job, 11", ["title", "source"]).count() == 1
    assert search.search(jobs, "", ["title"]).count() == 60
    with pytest.raises(ValueError):
        search.filter_jobs(jobs, colour="red")


def test_quality_suite(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 5, 3, T[0]), (1, "b", None, 9, T[10]), (2, None, 50, 60, T[10])], "k long, v string, lo int, hi int, at timestamp"
    )
    ref = spark.createDataFrame([(1,)], "k long")
    checks = [
        quality.row_count(5),
        *quality.not_null("v"),
        *quality.unique("k"),
        quality.accepted_values("v", ["a"]),
        quality.accepted_range("lo", 0, 10),
        quality.ordered("lo", "hi"),
        quality.fresh("at", 7),
        quality.relationship("k", "ref", "k"),
    ]
    out = quality.run_suite(df, "t", checks, {"ref": ref}, as_of=T[12])
    failed = {r.check: r.failed_rows for r in out.collect()}
    assert failed == {
        "row_count": 2, "not_null": 1, "unique": 1, "accepted_values": 1, "accepted_range": 1, "ordered": 1, "fresh": 1, "relationship:ref": 1,
    }
    assert not any(r.passed for r in out.collect())
    path = scratch_path(spark, "dq")
    with pytest.raises(ValueError):
        quality.store_results(out, path, T[12], fail_fast=True)
    assert spark.read.parquet(path).count() == len(checks)
    with pytest.raises(ValueError):
        quality.run_suite(df, "t", [quality.fresh("at")]).collect()


def test_marts_pass_their_suites(marts, raw):
    out = quality.run_warehouse_checks(marts, raw, as_of=T[5], min_rows=1)
    bad = [r for r in out.collect() if not r.passed]
    assert [(r.table, r["column"], r.check) for r in bad] == []


def test_trend_modes(spark):
    skills = spark.createDataFrame([(1, "A", "x"), (2, "B", "x"), (3, "Bc", "x")], "skill_key long, skill_name string, skill_category string")
    demand = spark.createDataFrame(
        [
            (1, T[0].date(), 1, 9, 1.0, None, "s"),
            (2, T[1].date(), 1, 8, 2.0, None, "s"),
            (3, T[1].date(), 2, 7, 3.0, None, "s"),
            (4, T[2].date(), 3, 1, 3.0, None, "s"),
        ],
        "id long, snapshot_date date, skill_key long, posting_count long, avg_salary_min double, avg_salary_max double, source string",
    )
    names = lambda df: {r.skill_name for r in df.collect()}
    assert names(analytics.skill_trends(demand, skills, limit=2)) == {"A"}
    assert names(analytics.skill_trends(demand, skills, limit=2, mode="names")) == {"A", "B"}
    assert names(analytics.skill_trends(demand, skills, skill="b")) == {"B", "Bc"}
    assert [r.id for r in analytics.top_skills(demand, skills).collect()] == [1]
    assert [r.id for r in analytics.top_skills(demand, skills, mode="latest").collect()] == [4]


def test_half_even_and_empty(spark):
    cols = "job_key long, source string, salary_min double, salary_max double, salary_currency string, salary_period string, is_remote boolean"
    two = spark.createDataFrame([(1, "a", 2.0, None, "PHP", "monthly", True), (2, "a", 3.0, None, "PHP", "monthly", False)], cols)
    r = analytics.dashboard_summary(two).first()
    assert (r.avg_salary_min_php, r.avg_salary_max_php, r.active_sources) == (2, 0, 1)
    empty = analytics.remote_vs_onsite(two.limit(0)).first()
    assert (empty.total, empty.remote_percentage) == (0, 0.0)


def test_dim_date(spark):
    r = dims.build_dim_date(spark).where("date_key = 20260531").first()
    assert (r.day_name, r.day_of_week, r.month_name, r.quarter, r.is_weekend, r.day, r.week_of_year) == ("Sunday", 7, "May", 2, True, 31, 22)


def test_a_page_is_as_large_as_asked(spark):
    rows = spark.range(3000)
    order = [F.col("id")]
    assert search.page(rows, order, size=3000).rows.count() == 3000
    for bad in ({"number": 0}, {"size": 0}, {"size": 30, "max_size": 20}):
        with pytest.raises(ValueError):
            search.page(rows, order, **bad)
