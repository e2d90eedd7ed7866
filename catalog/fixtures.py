"""Inputs that Spark derives from the given tables: payload pages, landed batches, run logs, terms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.session import balance, prepare, scratch_path, settings
from jobloom.plans.warehouse import Marts, build_warehouse
from jobloom.sources.adapter import posting_fields, raw_postings

POSTINGS_PER_PAGE = 50

# Words and phrases looked up in documents.text; pattern, name, category.
DOCUMENT_TERMS = (
    ("the", "the", "en"),
    ("of", "of", "en"),
    ("thing", "thing", "en"),
    ("with", "with", "en"),
    ("of the", "of the", "en"),
    ("in the", "in the", "en"),
    ("est", "est", "fr"),
    ("une", "une", "fr"),
    ("que", "que", "fr"),
    ("de la", "de la", "fr"),
    ("der", "der", "de"),
    ("nicht", "nicht", "de"),
    ("ist", "ist", "de"),
    ("para", "para", "es"),
    ("los", "los", "es"),
    ("email", "contact", "personal"),
    ("e-mail", "contact", "personal"),
    ("license", "license", "legal"),
    ("copyright", "license", "legal"),
    (r"Apache License", "license", "legal"),
    (r"v\d+", "version", "pattern"),
)

#: Few sources are written side by side, so that no task sorts its rows by source, and columns made of long SQL are compiled
#: in methods that the JVM translates (it interprets those beyond 8000 bytes).
LANDING = {"spark.sql.maxConcurrentOutputFileWriters": "8", "spark.sql.codegen.hugeMethodLimit": "8000"}

_marts: dict[tuple[str, str], Marts] = {}
_landed: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _once(label: str, spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Land an input table once per application; queries then read files, as they would from landed data."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _landed:
        path = scratch_path(balance(prepare(spark)), label)
        built = build(spark, sf_dir)
        with settings(spark, LANDING):
            built.write.partitionBy("source").parquet(path)
        _landed[key] = spark.read.schema(built.schema).parquet(path).select(*built.columns)
    return _landed[key]


def landed(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _once(build.__name__, spark, sf_dir, build)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once("raw", spark, sf_dir, raw_postings)


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once("fields", spark, sf_dir, posting_fields)


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    """The written warehouse of a data set, built once per application: analytics read tables, not raw data."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _marts:
        _marts[key] = build_warehouse(spark, raw(spark, sf_dir))
    return _marts[key]


def terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DOCUMENT_TERMS), schema=schemas.SKILL_TERMS)


def plain(df: DataFrame) -> DataFrame:
    """Output types that mean the same in both engines: bigint, double, boolean, string."""
    kinds = {"date": "string", "timestamp": "string", "timestamp_ntz": "string", "tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}
    columns = []
    for name, kind in df.dtypes:
        target = "double" if kind.startswith("decimal") else kinds.get(kind)
        columns.append(F.col(f"`{name}`").cast(target).alias(name) if target else F.col(f"`{name}`"))
    return df.select(*columns)


# Payload pages: every posting, packed as a site would deliver it


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields(spark, sf_dir).withColumn("page_no", F.floor(F.col("raw_id") / POSTINGS_PER_PAGE))


def _joined(rows: DataFrame, item: Column, separator: str) -> DataFrame:
    """One row per page; a page holds a fixed number of postings, so its group is bounded."""
    pairs = F.sort_array(F.collect_list(F.struct("raw_id", item.alias("item"))))
    body = F.array_join(F.transform(pairs, lambda p: p["item"]), separator)
    return rows.groupBy("page_no").agg(body.alias("body"))


def _with_more(obj: Column, extra: Column) -> Column:
    """Add ready JSON text to a JSON object."""
    return F.concat(F.regexp_replace(F.to_json(obj), r"\}$", ""), F.lit(","), extra, F.lit("}"))


@landed
def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _numbered(spark, sf_dir)
    r = F.col("raw_id")
    job = F.struct(
        r.alias("id"),
        F.col("title").alias("name"),
        F.struct(F.when(r % 2 == 0, F.concat(F.lit("co"), r)).alias("code"), F.col("company").alias("name")).alias("company_info"),
        F.struct(
            F.struct(F.when(r % 3 == 0, F.col("location")).alias("city"), F.col("location").alias("locality")).alias(
                "address_components"
            )
        ).alias("google_location"),
        F.when(r % 4 != 0, r * 10).alias("salary_from"),
        F.when(r % 4 < 2, r * 20).alias("salary_to"),
        F.when(r % 5 == 0, F.lit("USD")).alias("salary_currency"),
        "description",
        F.col("employment_type").alias("tenure"),
        F.col("experience_level").alias("work_experience_value"),
        F.col("posted_date").alias("activation_date"),
    )
    function = (
        F.when(r % 3 == 0, F.lit('"function":[{"name":"Python"},"plain text",{"other":1},{"name":"SQL"}]'))
        .when(r % 3 == 1, F.lit('"function":null'))
        .otherwise(F.lit('"function":[]'))
    )
    pages = _joined(rows, _with_more(job, function), ",")
    return pages.select(F.lit("api").alias("source"), "page_no", F.concat(F.lit('{"jobs":['), "body", F.lit("]}")).alias("payload"))


def _board_job(company: Column, location: Column, kind: Column, id_name: str = "id") -> Column:
    return F.struct(
        F.col("raw_id").alias(id_name),
        "title",
        company.alias("advertiser"),
        location.alias("location"),
        F.col("salary_raw").alias("salary"),
        F.col("description").alias("teaser"),
        F.col("posted_date").alias("listingDate"),
        kind,
    )


def _state_item() -> Column:
    return F.to_json(
        _board_job(F.struct(F.col("company").alias("description")), F.col("location"), F.col("employment_type").alias("workType"))
    )


def _state_payload(body: Column, page: Column) -> Column:
    return F.when(page % 2 == 0, F.concat(F.lit('{"results":{"results":{"jobs":['), body, F.lit("]}}}"))).otherwise(
        F.concat(F.lit('{"results":{},"jobsPage":{"jobs":['), body, F.lit("]}}"))
    )


@landed
def state_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _joined(_numbered(spark, sf_dir), _state_item(), ",")
    return pages.select(F.lit("state").alias("source"), "page_no", _state_payload(F.col("body"), F.col("page_no")).alias("payload"))


def _cache_item() -> Column:
    r = F.col("raw_id")
    prefix = F.when(r % 4 == 0, "Job:").when(r % 4 == 1, "JobSearchResult:").when(r % 4 == 2, "JobListing:").otherwise("Advertiser:")
    kinds = F.filter(F.array("employment_type"), lambda k: k.isNotNull()).alias("workTypes")
    job = _board_job(F.struct(F.col("company").alias("name")), F.struct(F.col("location").alias("label")), kinds, "jobId")
    return F.concat(F.lit('"'), prefix, r, F.lit('":'), F.to_json(job))


@landed
def entity_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _joined(_numbered(spark, sf_dir), _cache_item(), ",")
    body = F.concat(F.lit('{"ROOT_QUERY":{"x":1},"Job:text":"no object",'), "body", F.lit("}"))
    return pages.select(F.lit("entity_cache").alias("source"), "page_no", body.alias("payload"))


def _ssr_item() -> Column:
    r = F.col("raw_id")
    company = F.struct(F.when(r % 2 == 0, F.col("company")).alias("name"), F.col("company").alias("description"))
    return F.to_json(
        F.struct(
            r.alias("id"),
            "title",
            company.alias("advertiser"),
            F.when(r % 2 == 1, F.concat(F.lit("Near "), "location")).alias("locationLabel"),
            "location",
            F.col("salary_raw").alias("salary"),
            F.col("description").alias("teaser"),
            F.col("posted_date").alias("listingDate"),
            F.col("employment_type").alias("workType"),
        )
    )


def _ssr_payload(body: Column, page: Column) -> Column:
    jobs = F.concat(F.lit('{"jobs":['), body, F.lit("]}"))
    props = (
        F.when(page % 4 == 0, F.concat(F.lit('{"jobResults":'), jobs, F.lit("}")))
        .when(page % 4 == 1, F.concat(F.lit('{"jobResults":{"jobs":[]},"results":'), jobs, F.lit("}")))
        .when(page % 4 == 2, jobs)
        .otherwise(F.concat(F.lit('{"jobs":null,"initialData":'), jobs, F.lit("}")))
    )
    return F.concat(F.lit('{"props":{"pageProps":'), props, F.lit("}}"))


@landed
def ssr_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _joined(_numbered(spark, sf_dir), _ssr_item(), ",")
    return pages.select(F.lit("ssr").alias("source"), "page_no", _ssr_payload(F.col("body"), F.col("page_no")).alias("payload"))


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _element(tag: str, attributes: str, text: Column) -> Column:
    return F.when(text.isNotNull(), F.concat(F.lit(f"<{tag} {attributes}>"), _escaped(text), F.lit(f"</{tag}>"))).otherwise("")


def _nested(tag: str, attributes: str, text: Column) -> Column:
    """An element of which every seventh row's holds one of its own name: the same text in more tags."""
    split_up = F.concat(
        F.lit(f"<{tag} {attributes}><{tag}>"), _escaped(F.left(text, F.lit(3))), F.lit(f"</{tag}><br/>"), _escaped(F.substring(text, F.lit(4), F.length(text))), F.lit(f"</{tag}>")
    )
    return F.when(text.isNotNull() & (F.col("raw_id") % 7 == 3), split_up).otherwise(_element(tag, attributes, text))


#: Looks like fields of every site, but lies outside the cards.
_NO_CARD = (
    '<aside><!-- <div class="jobpost-cat-box"> --><script>var t = "<div class=\'job_seen_beacon\'>";</script><h3 class="salary">ad</h3>'
    '<span class="companytitle">Ad Inc</span><div><i class="bi bi-geo-alt"></i> Adtown</div><div><i class="bi bi-file-text"></i> Ad</div><span class="jobinfo">now</span>'
    '<a data-automation="jobCompany">Ad Inc</a><span data-automation="jobLocation">Adtown</span><span data-automation="jobSalary">ad</span>'
    '<span data-automation="jobShortDescription">ad</span><span data-automation="jobListingDate">now</span>'
    '<span data-testid="company-name">Ad Inc</span><span class="companyName">Ad Inc</span><div data-testid="text-location">Adtown</div>'
    '<div class="salary-snippet-container">ad</div><div data-testid="attribute_snippet_testid">ad</div><span class="date">now</span>'
    '<dl class="no-gutters"><dd class="col">ad</dd></dl><h4 class="fw-700">Ad <span class="badge">ad</span></h4></aside>'
)


def _among_ads(item: Column) -> Column:
    return F.concat(F.when(F.col("raw_id") % 25 == 11, F.lit(_NO_CARD)).otherwise(""), item)


def _page(cards: DataFrame, name: str) -> DataFrame:
    """A page with a menu before the cards and a sidebar and a footer behind them."""
    before, behind = "<html><body><nav><ul><li><a href='/x'>Menu</a></li></ul></nav>", f"{_NO_CARD}<footer>{_NO_CARD}</footer></body></html>"
    html = F.concat(F.lit(before), "body", F.lit(behind))
    return cards.select(F.lit(name).alias("source"), "page_no", html.alias("payload"))


def _philjobnet_item() -> Column:
    r = F.col("raw_id")
    return F.concat(
        F.lit('<a class="nolink" href="/job-vacancies/job/title-'), r, F.lit('"><div class="jobcard">'),
        _element("h1", 'class="jobtitle"', F.col("title")),
        _nested("h3", 'class="salary"', F.col("salary_raw")),
        _nested("span", 'class="companytitle"', F.col("company")),
        F.when(F.col("location").isNotNull(), F.concat(F.lit('<div><i class="bi bi-geo-alt"></i> '), _escaped(F.col("location")), F.lit("</div>"))).otherwise(""),
        F.lit('<div><i class="bi bi-mortarboard"></i> '), _escaped(F.col("education_level")), F.lit("</div>"),
        F.when(F.col("employment_type").isNotNull(), F.concat(F.lit('<div><i class="bi bi-file-text"></i> '), _escaped(F.col("employment_type")), F.lit("</div>"))).otherwise(""),
        _element("span", 'class="jobinfo"', F.col("posted_date")),
        F.lit("</div></a>"),
    )


@landed
def philjobnet_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(_joined(_numbered(spark, sf_dir), _among_ads(_philjobnet_item()), "\n"), "philjobnet")


def _jobstreet_item() -> Column:
    r, p = F.col("raw_id"), F.col("page_no")
    start = (
        F.when(p % 3 == 0, F.concat(F.lit('<article data-testid="job-card" data-job-id="'), r, F.lit('">')))
        .when(p % 3 == 1, F.lit('<article data-automation="normalJob">'))
        .otherwise(F.lit('<div class="c" data-card-type="JobCard">'))
    )
    link = F.concat(F.lit("<h3><a data-automation=\"jobTitle\" href=\"/job/"), r, F.lit('?type=standard">'), _escaped(F.col("title")), F.lit("</a></h3>"))
    return F.concat(
        start,
        link,
        _element("a", 'data-automation="jobCompany"', F.col("company")),
        _nested("span", 'data-automation="jobLocation"', F.col("location")),
        _nested("span", 'data-automation="jobSalary"', F.col("salary_raw")),
        _element("span", 'data-automation="jobShortDescription"', F.col("description")),
        _element("span", 'data-automation="jobClassification"', F.col("education_level")),
        _element("span", 'data-automation="jobListingDate"', F.col("posted_date")),
        F.when(p % 3 == 2, "</div>").otherwise("</article>"),
    )


@landed
def jobstreet_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(_joined(_numbered(spark, sf_dir), _among_ads(_jobstreet_item()), "\n"), "jobstreet")


def _onlinejobs_item() -> Column:
    r = F.col("raw_id")
    href = F.when(r % 2 == 0, F.concat(F.lit("/jobseekers/job/some-title-"), r)).otherwise(
        F.concat(F.lit("https://www.onlinejobs.ph/jobseekers/job/no_number_"), r, F.lit("x"))
    )
    badge = F.when(
        F.col("employment_type").isNotNull(),
        F.concat(F.lit(' <span class="badge badge-info">'), _escaped(F.col("employment_type")), F.lit("</span>")),
    ).otherwise("")
    return F.concat(
        F.lit('<div class="jobpost-cat-box latest"><a href="'), href, F.lit('"><h4 class="fs-16 fw-700">'),
        _escaped(F.col("title")), badge,
        F.lit('</h4><p class="fs-13" data-temp="'), F.coalesce("posted_date", F.lit("")), F.lit('">posted</p>'),
        F.lit('<dl class="row no-gutters"><dt>pay</dt><dd class="col">'),
        F.coalesce(F.when(r % 7 == 0, F.lit("N/A")).otherwise(_escaped(F.col("salary_raw"))), F.lit("")),
        F.lit("</dd></dl></a></div>"),
    )


@landed
def onlinejobs_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(_joined(_numbered(spark, sf_dir), _among_ads(_onlinejobs_item()), "\n"), "onlinejobs")


def _indeed_item() -> Column:
    r, p = F.col("raw_id"), F.col("page_no")
    start = F.when(p % 2 == 0, F.lit('<div class="job_seen_beacon">')).otherwise(F.lit('<li class="x" data-testid="slider_item">'))
    heading = F.when(
        r % 2 == 0,
        F.concat(
            F.lit('<h2 class="jobTitle css-1"><a data-jk="k'), r, F.lit('" href="/rc/clk?jk=k'), r, F.lit('"><b>new</b><span title="t">'),
            _escaped(F.col("title")), F.lit("</span></a></h2>"),
        ),
    ).otherwise(
        F.concat(
            F.lit('<h3><a data-jk="k'), r, F.lit('" href="https://ph.indeed.com/viewjob?jk=k'), r, F.lit('">'),
            _escaped(F.col("title")), F.lit("</a></h3>"),
        )
    )
    company = F.when(p % 2 == 0, _nested("span", 'data-testid="company-name"', F.col("company"))).otherwise(
        _element("span", 'class="old companyName"', F.col("company"))
    )
    place = F.when(p % 2 == 0, _element("div", 'data-testid="text-location"', F.col("location"))).otherwise(
        _nested("div", 'class="css companyLocation-1"', F.col("location"))
    )
    pay = F.when(r % 3 == 0, _nested("div", 'class="salary-snippet-container"', F.col("salary_raw"))).otherwise("")
    kind = _element("div", 'data-testid="attribute_snippet_testid"', F.col("employment_type"))
    day = F.when(p % 2 == 0, _element("span", 'data-testid="myJobsStateDate"', F.col("posted_date"))).otherwise(
        _element("span", 'class="date"', F.col("posted_date"))
    )
    return F.concat(start, heading, company, place, pay, kind, day, F.when(p % 2 == 0, "</div>").otherwise("</li>"))


@landed
def indeed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(_joined(_numbered(spark, sf_dir), _among_ads(_indeed_item()), "\n"), "indeed")


@landed
def strategy_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages where different strategies work: state, entity cache, props, or cards only."""
    rows = _numbered(spark, sf_dir)
    items = {"state": _state_item(), "cache": _cache_item(), "props": _ssr_item(), "html": _jobstreet_item()}
    ordered = F.sort_array(F.collect_list(F.struct("raw_id", *[c.alias(n) for n, c in items.items()])))
    pages = rows.groupBy("page_no").agg(ordered.alias("jobs"))
    page = F.col("page_no")

    def body(name: str, separator: str = ",") -> Column:
        return F.array_join(F.transform("jobs", lambda j: j[name]), separator)

    return pages.select(
        F.lit("jobstreet").alias("source"),
        page,
        F.when(page % 4 == 0, _state_payload(body("state"), page)).alias("state"),
        F.when(page % 4 <= 1, F.concat(F.lit("{"), body("cache"), F.lit("}"))).otherwise("{}").alias("cache"),
        F.when(page % 4 <= 2, _ssr_payload(body("props"), page)).otherwise("not json").alias("props"),
        body("html", "\n").alias("html"),
    )


# What damages which rows of the posting fact: column, remainder of job_key by a divisor, and the SQL of the wrong value.
DAMAGE = (
    ("title", 11, 3, "NULL"),
    ("source", 13, 5, "'monster'"),
    ("source", 53, 2, "NULL"),
    ("salary_currency", 17, 2, "'EUR'"),
    ("salary_min", 19, 7, "CAST(-5 AS DOUBLE)"),
    ("salary_max", 23, 1, "CAST(20000000 AS DOUBLE)"),
    ("salary_max", 29, 4, "CAST(1 AS DOUBLE)"),
    ("company_key", 31, 6, "CAST(9000000 AS BIGINT)"),
    ("location_key", 37, 8, "CAST(9000000 AS BIGINT)"),
    ("date_posted_key", 41, 9, "CAST(10101 AS BIGINT)"),
    ("job_key", 43, 0, "CAST(7 AS BIGINT)"),
    ("job_key", 47, 1, "NULL"),
)


def damaged_sql(column: str) -> str:
    """SQL, the same for both engines, of a damaged column."""
    wrong = "".join(f" WHEN job_key % {n} = {rest} THEN {value}" for name, n, rest, value in DAMAGE if name == column)
    return f"CASE{wrong} ELSE {column} END" if wrong else column


def damaged_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posting fact with rows that fail every check."""
    fact = marts(spark, sf_dir).fct_job_postings
    return fact.select(*[F.expr(damaged_sql(c)).alias(c) for c in fact.columns])


# Landed batches and run logs from events


def event_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as writes: the latest value per (type, user)."""
    return as_writes(table(spark, sf_dir, "events"))


def as_writes(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("source"),
        F.concat(F.lit("u"), "user_id").alias("source_id"),
        F.col("ts").cast("timestamp").alias("scraped_at"),
        F.col("props").alias("raw_data"),
        F.col("event_id").alias("seq"),
    )


def write_slices(spark: SparkSession, sf_dir: str, n: int) -> list[DataFrame]:
    """The event writes in n batches of about the same size, one after the other."""
    writes = event_writes(spark, sf_dir)
    low, high = writes.agg(F.min("seq"), F.max("seq")).first()
    part = F.floor((F.col("seq") - F.lit(low)) * n / F.lit(high - low + 1))
    return [writes.where(part == i) for i in range(n)]


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per day and event type."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    return events.groupBy(day.alias("day"), F.col("event_type").alias("source")).agg(
        F.min("event_id").alias("id"),
        F.min("ts").cast("timestamp").alias("started_at"),
        F.max("ts").cast("timestamp").alias("finished_at"),
        F.count_if(F.col("value") > 5).cast("int").alias("records_scraped"),
    ).select(
        "id",
        "source",
        "started_at",
        "finished_at",
        "records_scraped",
        F.when(F.dayofmonth("day") % 5 == 0, "error").otherwise("success").alias("status"),
        F.when(F.dayofmonth("day") % 5 == 0, F.repeat(F.lit("timeout "), 200)).alias("error_message"),
    )
