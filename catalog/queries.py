"""name -> (spark, sf_dir) -> DataFrame, one entry per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from jobloom.functions import display, salary
from jobloom.functions.html import CardLayout, Opening, Rule, cards, with_fields
from jobloom.operators import dims, facts, payloads, quality, search, skills, staging, unify
from jobloom.operators.positions import dense_key
from jobloom.plans import analytics
from jobloom.plans.warehouse import build_warehouse, spine
from jobloom.session import scratch_path
from jobloom.sources import layers, store
from jobloom.sources.raw import latest_per_key, read_raw, read_raw_json, read_seed, upsert_raw
from jobloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = datetime(2030, 8, 1)
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fx.plain(run(spark, sf_dir))
        return run

    return register


# Staging, union, dedup

for _source in staging.SPECS:
    query(f"stage_{_source}")(lambda spark, sf, source=_source: staging.stage(fx.raw(spark, sf), source))


@query("unify")
def _(spark, sf):
    raw = fx.raw(spark, sf)
    return unify.unify(staging.stage(raw, s) for s in staging.SPECS)


@query("stage_all")
def _(spark, sf):
    return staging.stage_all(fx.raw(spark, sf))


@query("rank_duplicates")
def _(spark, sf):
    asked = staging.stage_all(fx.raw(spark, sf)).select("raw_id", "source", "source_id", "scraped_at")
    return unify.rank_duplicates(asked).drop("scraped_at")


@query("dedup_latest")
def _(spark, sf):
    return spine(fx.raw(spark, sf))


@query("event_props")
def _(spark, sf):
    events = fx.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return events.groupBy("event_type").agg(F.sum(k).alias("k_sum"), F.count(k).alias("k_rows"))


# Salaries


@query("salary_parse")
def _(spark, sf):
    return salary.parse_salary(spine(fx.raw(spark, sf)))


@query("salary_simple")
def _(spark, sf):
    parsed = fx.fields(spark, sf).select("raw_id", salary.parse_salary_simple(F.col("salary_raw")).alias("p"))
    return parsed.select("raw_id", *[F.col(f"p.{n}").alias(f"simple_{n}") for n in ("min", "max", "currency", "period")])


@query("salary_bucket")
def _(spark, sf):
    parsed = salary.parse_salary(spine(fx.raw(spark, sf)))
    return parsed.select("raw_id", salary.salary_bucket(F.col("salary_min")).alias("bucket"))


@query("salary_monthly")
def _(spark, sf):
    parsed = salary.parse_salary(spine(fx.raw(spark, sf)))
    monthly = salary.to_monthly_php(*[F.col(c) for c in ("salary_min", "salary_max", "salary_currency", "salary_period")])
    return parsed.select("raw_id", *[F.round(monthly[n], 2).alias(f"monthly_{n}") for n in ("min", "max")])


# Skills


@query("skill_match")
def _(spark, sf):
    return skills.posting_skills(spine(fx.raw(spark, sf)), read_seed(spark, "skill_terms"))


@query("skill_match_loose")
def _(spark, sf):
    return skills.posting_skills(spine(fx.raw(spark, sf)), read_seed(spark, "skill_terms"), boundary="loose")


def _documents(method: str) -> Query:
    def run(spark, sf):
        return skills.match_terms(
            fx.table(spark, sf, "documents"), ["doc_id"], ["text"], [], fx.terms(spark), method=method
        ).select("doc_id", "skill_name", "skill_category")

    return run


query("term_match_documents")(_documents("compiled"))
query("term_match_documents_joined")(_documents("joined"))


@query("job_skill_bridge")
def _(spark, sf):
    seed = read_seed(spark, "skill_terms")
    return facts.build_job_skills(spine(fx.raw(spark, sf)), seed, dims.build_dim_skills(seed))


# Dimensions and facts


@query("dim_company")
def _(spark, sf):
    return dims.build_dim_companies(spine(fx.raw(spark, sf)))


@query("dim_location")
def _(spark, sf):
    return dims.build_dim_locations(spine(fx.raw(spark, sf)), read_seed(spark, "regions"))


@query("dim_skill_usage")
def _(spark, sf):
    """The skill dimension with the number of postings of each skill, unused ones included."""
    m = fx.marts(spark, sf)
    used = m.fct_skill_demand.groupBy("skill_key").agg(F.sum("posting_count").alias("postings"))
    return m.dim_skills.join(used, "skill_key", "left")


@query("skill_list")
def _(spark, sf):
    """The second page of the skills with an "a" in their names, with their use."""
    return search.skill_list(QUERIES["dim_skill_usage"](spark, sf), text="a", number=2, size=10).rows


@query("read_raw")
def _(spark, sf):
    """Postings landed as files by source, then scanned: rows, ids and newest scrape of each source."""
    path = scratch_path(spark, "landing")
    fx.raw(spark, sf).write.partitionBy("source").parquet(path)
    rows = read_raw(spark, path)
    return rows.groupBy("source").agg(
        F.count("*").alias("postings"), F.count_distinct("source_id").alias("ids"), F.max("scraped_at").alias("newest"), F.count("raw_data").alias("payloads")
    )


@query("read_raw_damaged")
def _(spark, sf):
    """Landed JSON lines, some cut off, some with a text for a number, some without a source: how many are read or kept aside."""
    path, r = scratch_path(spark, "lines"), F.col("raw_id")
    line = F.to_json(F.struct(F.when(r % 60 != 2, F.col("source")).alias("source"), "source_id", "scraped_at", "raw_data", r.alias("raw_id")))
    worse = F.when(r % 50 == 1, F.left(line, F.lit(30))).when(r % 70 == 3, F.regexp_replace(line, r'"raw_id":\d+', '"raw_id":"x"')).otherwise(line)
    fx.raw(spark, sf).select(worse.alias("value")).write.text(path)
    good, aside = read_raw_json(spark, path)
    read = good.groupBy("source").agg(F.count("*").alias("rows"), F.max("raw_id").alias("last_id"))
    lost = aside.groupBy(F.col("reason").alias("source")).agg(F.count("*").alias("rows"), F.lit(None).cast("long").alias("last_id"))
    return read.unionByName(lost)


@query("dim_date_usage")
def _(spark, sf):
    """Every calendar day with its columns and the number of postings, none included."""
    m = fx.marts(spark, sf)
    days = m.fct_job_postings.groupBy("date_posted_key").agg(F.count("*").alias("postings"))
    return m.dim_date.join(days, F.col("date_key") == F.col("date_posted_key"), "left").drop("date_posted_key")


@query("fact_posting")
def _(spark, sf):
    m = fx.marts(spark, sf)
    regions = read_seed(spark, "regions")
    places = dims.build_dim_locations(m.deduped, regions, keep_counts=True)
    return facts.build_fct_postings(m.deduped, dims.build_dim_companies(m.deduped), places)


@query("fact_posting_skew_safe")
def _(spark, sf):
    """The same fact, all of it, through the joins for dimensions too large to broadcast."""
    m = fx.marts(spark, sf)
    places = dims.build_dim_locations(m.deduped, read_seed(spark, "regions"), keep_counts=True)
    return facts.build_fct_postings(m.deduped, dims.build_dim_companies(m.deduped), places, small_bytes=0)


@query("fact_skill_demand")
def _(spark, sf):
    m = fx.marts(spark, sf)
    return facts.build_fct_skill_demand(m.deduped, read_seed(spark, "skill_terms"), m.dim_skills)


@query("fact_skill_demand_monthly_php")
def _(spark, sf):
    m = fx.marts(spark, sf)
    demand = facts.build_fct_skill_demand(m.deduped, read_seed(spark, "skill_terms"), m.dim_skills, normalize=True)
    means = [F.round(c, 2).alias(c) for c in ("avg_salary_min", "avg_salary_max")]
    return demand.select("id", "snapshot_date", "skill_key", "source", "posting_count", *means)


@query("snapshot_append")
def _(spark, sf):
    """Two appends, of which the second repeats days of the first."""
    m = fx.marts(spark, sf)
    path = scratch_path(spark, "snapshots")
    layers.append_snapshot(m.fct_skill_demand.where("snapshot_date < date'2028-01-01'"), path)
    layers.append_snapshot(m.fct_skill_demand.where("snapshot_date >= date'2027-06-01'"), path)
    stored = layers.read_snapshots(spark, path, m.fct_skill_demand)
    return stored.groupBy(F.date_format("snapshot_date", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("rows"), F.sum("posting_count").alias("postings")
    )


@query("warehouse_build")
def _(spark, sf):
    """Full rebuild of every table; row counts per table."""
    m = build_warehouse(spark, fx.raw(spark, sf))
    names = ("dim_companies", "dim_locations", "dim_skills", "dim_date", "fct_job_postings", "fct_skill_demand")
    counts = [getattr(m, n).agg(F.lit(n).alias("table_name"), F.count("*").alias("rows")) for n in names]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# Analytics

query("dashboard_summary")(lambda spark, sf: analytics.dashboard_summary(fx.marts(spark, sf).fct_job_postings))
query("salary_by_experience")(lambda spark, sf: analytics.salary_by_experience(fx.marts(spark, sf).fct_job_postings))
query("salary_by_source")(lambda spark, sf: analytics.salary_by_source(fx.marts(spark, sf).fct_job_postings))
query("jobs_by_source")(lambda spark, sf: analytics.jobs_by_source(fx.marts(spark, sf).fct_job_postings))
query("remote_vs_onsite")(lambda spark, sf: analytics.remote_vs_onsite(fx.marts(spark, sf).fct_job_postings))
query("city_facet")(lambda spark, sf: analytics.city_facet(fx.marts(spark, sf).dim_locations))
query("postings_per_week")(lambda spark, sf: analytics.postings_per_week(fx.marts(spark, sf).fct_job_postings))
query("salary_histogram")(lambda spark, sf: analytics.salary_histogram(fx.marts(spark, sf).fct_job_postings))


@query("salary_by_city")
def _(spark, sf):
    m = fx.marts(spark, sf)
    return analytics.salary_by_city(m.fct_job_postings, m.dim_locations)


@query("salary_by_city_chart")
def _(spark, sf):
    m = fx.marts(spark, sf)
    return analytics.salary_by_city_chart(m.fct_job_postings, m.dim_locations)


@query("postings_by_calendar")
def _(spark, sf):
    m = fx.marts(spark, sf)
    return analytics.postings_by_calendar(m.fct_job_postings, m.dim_date)


def _trends(**params) -> Query:
    def run(spark, sf):
        m = fx.marts(spark, sf)
        return analytics.skill_trends(m.fct_skill_demand, m.dim_skills, **params)

    return run


query("skill_trends_reference")(_trends(mode="reference"))
query("skill_trends_names")(_trends(mode="names"))
query("skill_trends_by_name")(_trends(skill="java"))


def _top(**params) -> Query:
    def run(spark, sf):
        m = fx.marts(spark, sf)
        return analytics.top_skills(m.fct_skill_demand, m.dim_skills, **params)

    return run


query("top_skills_reference")(_top(mode="reference"))
query("top_skills_latest")(_top(mode="latest"))
query("top_skills_of_source")(_top(source="kalibrr", limit=10))


@query("skill_summary")
def _(spark, sf):
    m = fx.marts(spark, sf)
    out = analytics.skill_summary(m.fct_skill_demand, m.dim_skills)
    means = [F.round(c, 2).alias(c) for c in ("avg_salary_min", "avg_salary_max")]
    return out.select("skill_name", "skill_category", "demand", *means)


# Search


def _search(**params) -> Query:
    def run(spark, sf):
        m = fx.marts(spark, sf)
        return search.search_jobs(m.fct_job_postings, m.dim_companies, m.dim_locations, **params).rows

    return run


query("search_facets")(
    _search(city="makati", salary_currency="php", salary_min_gte=20000, is_remote=False, employment_type="time", size=500)
)
query("search_facets_more")(_search(source="KALIBRR", region="ncr", experience_level="enior", salary_max_lte=90000, company_name="0001", size=500))
query("search_text")(_search(text="developer, python", size=2000))
query("search_page_3")(_search(number=3))
query("search_by_salary")(_search(order="-salary_max,company_name", number=2, size=50))
query("search_by_salary_up")(_search(order="salary_min", size=50))


query("search_by_company")(_search(order="company_name", number=3, size=40))
query("search_by_company_down")(_search(order="-company_name,salary_min", text="engineer", size=60))
query("search_by_salary_min_down")(_search(order="-salary_min", number=2, size=30, city="makati"))


def _search_after(order: str, size: int, pages: int, **facets) -> Query:
    """The page behind `pages` others, each reached by the token of the one before."""

    def run(spark, sf):
        m = fx.marts(spark, sf)
        token, keys = None, search.order_keys(order, search.JOB_ORDER, [])
        for _ in range(pages):
            rows = search.search_jobs(m.fct_job_postings, m.dim_companies, m.dim_locations, order=order, size=size, after=token, **facets).rows
            token = search.page_token(rows.collect()[-1], keys, "job_key")
        return search.search_jobs(m.fct_job_postings, m.dim_companies, m.dim_locations, order=order, size=size, after=token, **facets).rows

    return run


query("search_after_date")(_search_after("-date_posted_key", 25, 2))
query("search_after_salary")(_search_after("-salary_max,company_name", 300, 1))
query("search_after_company")(_search_after("company_name,-salary_min", 40, 2, source="kalibrr"))


@query("search_total")
def _(spark, sf):
    m = fx.marts(spark, sf)
    return search.search_jobs(m.fct_job_postings, m.dim_companies, m.dim_locations, text="engineer").total


@query("page_after")
def _(spark, sf):
    m = fx.marts(spark, sf)
    jobs = search.job_list(m.fct_job_postings, m.dim_companies, m.dim_locations)
    return search.page_after(jobs, "date_posted_key", 20290101, "job_key", 0, 40)


@query("job_list")
def _(spark, sf):
    m = fx.marts(spark, sf)
    return search.job_list(m.fct_job_postings, m.dim_companies, m.dim_locations)


@query("job_detail")
def _(spark, sf):
    """The posting of the highest key, with its company and location fields flattened for comparison."""
    m = fx.marts(spark, sf)
    key = m.fct_job_postings.agg(F.max("job_key")).first()[0]
    detail = search.job_detail(m.fct_job_postings, m.dim_companies, m.dim_locations, key)
    return detail.select(
        "job_key", "source", "title", "company.company_name", "company.company_slug", "company.total_postings", "location.city", "location.is_metro_manila"
    )


query("company_list")(lambda spark, sf: search.company_list(fx.marts(spark, sf).dim_companies, text="customer 00", number=2).rows)
query("location_list")(lambda spark, sf: search.location_list(fx.marts(spark, sf).dim_locations, is_metro_manila=True, region="NCR").rows)


@query("skill_demand_list")
def _(spark, sf):
    m = fx.marts(spark, sf)
    return search.skill_demand_list(m.fct_skill_demand, m.dim_skills)


# Labels


@query("label_postings")
def _(spark, sf):
    kind = F.col("employment_type")
    return fx.marts(spark, sf).fct_job_postings.select(
        "job_key",
        display.salary_label(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency")).alias("salary_label"),
        display.date_key_label(F.col("date_posted_key")).alias("date_label"),
        display.employment_bucket(kind).alias("employment_bucket"),
        display.employment_label(kind).alias("employment_label"),
        display.source_label(F.col("source")).alias("source_label"),
    )


@query("label_money")
def _(spark, sf):
    rows = analytics.salary_by_source(fx.marts(spark, sf).fct_job_postings)
    return rows.select("source", display.peso_label(F.col("avg_salary_min")).alias("money_label"))


# Quality


@query("dq_warehouse")
def _(spark, sf):
    return quality.run_warehouse_checks(fx.marts(spark, sf), fx.raw(spark, sf), AS_OF)


@query("dq_salary_range")
def _(spark, sf):
    return quality.salary_range_offenders(fx.marts(spark, sf).fct_job_postings)


@query("dq_damaged")
def _(spark, sf):
    """The posting suite over a damaged fact: every check fails."""
    m = fx.marts(spark, sf)
    refs = {"dim_companies": m.dim_companies, "dim_locations": m.dim_locations}
    return quality.run_suite(fx.damaged_postings(spark, sf), "fct_job_postings", quality.postings_suite(10_000_000), refs=refs)


@query("dq_offenders")
def _(spark, sf):
    return quality.offenders(fx.damaged_postings(spark, sf), "fct_job_postings", quality.postings_suite(), "job_key")


@query("dq_quarantine")
def _(spark, sf):
    """Rows that pass and, by their reasons, rows that fail."""
    kept, held = quality.quarantine(fx.damaged_postings(spark, sf), quality.postings_suite())
    rows = held.select("source_id", F.array_join("failed_checks", ",").alias("reasons"))
    return rows.unionByName(kept.select("source_id", F.lit("").alias("reasons"))).groupBy("reasons").agg(F.count("*").alias("rows"), F.min("source_id").alias("least_id"))


@query("dq_salary_range_damaged")
def _(spark, sf):
    return quality.salary_range_offenders(fx.damaged_postings(spark, sf))


@query("dq_stored_results")
def _(spark, sf):
    """Results of the raw suite after they were appended to the result table."""
    results = quality.run_suite(fx.raw(spark, sf), "raw_job_postings", quality.raw_suite(), as_of=AS_OF)
    stored = quality.store_results(results, scratch_path(spark, "dq"), AS_OF)
    return stored.select(*quality.RESULT)


# Upsert, streaming, run log

FIRST_BATCH_END = "2024-01-04"


@query("upsert_raw")
def _(spark, sf):
    """The first days form the table, all later events are upserted into it."""
    writes = fx.event_writes(spark, sf)
    early = F.col("scraped_at") < F.lit(FIRST_BATCH_END).cast("timestamp")
    first = latest_per_key(writes.where(early), "seq")
    current = first.select(F.col("first_order").alias("raw_id"), "source", "source_id", "latest.scraped_at", "latest.raw_data")
    out = upsert_raw(current, writes.where(~early))
    return out.select("raw_id", "source", "source_id", F.unix_micros("scraped_at").alias("scraped_us"), "raw_data")


@query("upsert_stream")
def _(spark, sf):
    """The events file as a stream source, upserted batch by batch until it is used up."""
    schema = fx.table(spark, sf, "events").schema
    landed = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    target, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "stream")
    ingest.upsert_stream(fx.as_writes(landed), target, checkpoint).awaitTermination()
    out = ingest.current_raw(spark, target)
    return out.select("raw_id", "source", "source_id", F.unix_micros("scraped_at").alias("scraped_us"), "raw_data")


@query("upsert_sink")
def _(spark, sf):
    """Four batches upserted into a stored table, the second one twice; then the table."""
    root = scratch_path(spark, "sink")
    store.create(spark, root, buckets=16)
    slices = fx.write_slices(spark, sf, 4)
    for batch in (slices[0], slices[1], slices[1], slices[2], slices[3]):
        store.upsert(spark, root, batch)
    return store.read(spark, root).withColumn("scraped_us", F.unix_micros("scraped_at")).drop("scraped_at")


@query("upsert_stream_batches")
def _(spark, sf):
    """Six files as a stream of six micro-batches, merged by twos; ids as places, since appended ids have gaps."""
    landing, root, checkpoint = (scratch_path(spark, n) for n in ("landing", "sink", "stream"))
    for i, batch in enumerate(fx.write_slices(spark, sf, 6)):
        batch.coalesce(1).write.parquet(f"{landing}/slice={i}")
    store.create(spark, root, buckets=8)
    source = spark.readStream.schema(fx.event_writes(spark, sf).schema).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
    ingest.upsert_stream_batches(source, root, checkpoint, fanout=2).awaitTermination()
    rows = store.read(spark, root).withColumnRenamed("raw_id", "given_id")
    return dense_key(rows, ["given_id"], "raw_id").withColumn("scraped_us", F.unix_micros("scraped_at")).drop("given_id", "scraped_at")


@query("run_log")
def _(spark, sf):
    path = scratch_path(spark, "runs")
    layers.append_run_log(fx.event_runs(spark, sf), path)
    log = layers.read_run_log(spark, path)
    return log.select("id", "source", "records_scraped", "status", F.length("error_message").alias("error_length"))


@query("run_health")
def _(spark, sf):
    health = layers.run_health(layers.run_log_rows(fx.event_runs(spark, sf)))
    return health.withColumn("last_started_at", F.unix_micros("last_started_at"))


# Payloads

SHOWN = ("title", "company", "location", "salary_raw", "description", "employment_type", "posted_date", "url")


def _flatten(pages: Callable[[SparkSession, str], DataFrame], layout: str, *more: str) -> Query:
    def run(spark, sf):
        rows = payloads.flatten(pages(spark, sf), layout)
        return rows.select("page_no", "source_id", *SHOWN, *more)

    return run


@query("flatten_api")
def _(spark, sf):
    rows = payloads.flatten(fx.api_pages(spark, sf), "api")
    return rows.select("page_no", "source_id", *SHOWN, "experience_level", F.array_join("skills", "|").alias("skills"))


query("flatten_state")(_flatten(fx.state_pages, "state"))
query("flatten_entity_cache")(_flatten(fx.entity_pages, "entity_cache"))
query("flatten_ssr")(_flatten(fx.ssr_pages, "ssr"))
query("flatten_cards_philjobnet")(_flatten(fx.philjobnet_pages, "philjobnet_html", "education_level"))
query("flatten_cards_jobstreet")(_flatten(fx.jobstreet_pages, "jobstreet_html", "classification"))
query("flatten_cards_onlinejobs")(_flatten(fx.onlinejobs_pages, "onlinejobs_html", "salary_currency", "is_remote"))
query("flatten_cards_indeed")(_flatten(fx.indeed_pages, "indeed_html"))


@query("first_strategy")
def _(spark, sf):
    order = [("state", "state"), ("cache", "entity_cache"), ("props", "ssr"), ("html", "jobstreet_html")]
    rows = payloads.first_strategy(fx.strategy_pages(spark, sf), order)
    return rows.select("page_no", "source_id", "title", "company")


NAV_LINKS = CardLayout(
    starts=[Opening("li", r"><a\b", "<li><a")],
    texts={"label": [Rule(r"(?s)<(a)\b[^>]*>", "<a", element="a")]},
    attributes={"href": [Rule(r"<(a)\b[^>]*?\shref=[\"']([^\"']*)[\"']", "href")]},
)


@query("page_links")
def _(spark, sf):
    """The link cards of every page, with ids derived from their targets."""
    items = fx.table(spark, sf, "pages").select("page_id", F.explode_outer(cards(F.col("html"), NAV_LINKS)).alias("card"))
    links = with_fields(items.where("card is not null"), "card", NAV_LINKS, ["page_id"])
    return links.select("page_id", "label", "href", payloads.number_or_hash_id(F.col("href"), "link_").alias("link_id"))


@query("page_source_id")
def _(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", payloads.number_or_hash_id(F.col("url"), "page_").alias("source_id"))


@query("page_class")
def _(spark, sf):
    return payloads.page_class(fx.table(spark, sf, "pages")).select("page_id", "is_blocked", "is_login")


@query("dedup_run")
def _(spark, sf):
    """First sighting of each user per event type, days as pages, until a day shows nobody new."""
    events = fx.table(spark, sf, "events")
    seen = events.select("event_type", F.dayofyear("ts").alias("page_no"), "user_id", "event_id")
    return payloads.dedup_run(seen, run=["event_type"], page="page_no", key="user_id")


@query("dedup_run_terms")
def _(spark, sf):
    """The same with thirds of the day as search terms, asked one after the other."""
    events = fx.table(spark, sf, "events")
    third = F.floor(F.hour("ts") / 8).cast("int").alias("third")
    seen = events.select("event_type", third, F.dayofyear("ts").alias("page_no"), "user_id", "event_id")
    return payloads.dedup_run(seen, run=["event_type"], page="page_no", key="user_id", term="third", terms=[0, 1, 2])
