"""Landed payloads to posting rows.

A layout says how to find a payload's items and how an item becomes a posting. Both are column expressions, so
flattening is an explode and a projection, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.html import (
    ANY_TAG,
    CardLayout,
    Opening,
    Rule,
    attribute_of,
    card_fields,
    cards,
    tag_with_attribute,
    tag_with_class,
    text_of,
    with_fields,
    without_element,
)
from jobloom.functions.text import first_group
from jobloom.session import cut

POSTING_FIELDS = (
    "source_id",
    "title",
    "company",
    "location",
    "salary_raw",
    "salary_currency",
    "description",
    "employment_type",
    "experience_level",
    "education_level",
    "classification",
    "sub_classification",
    "is_remote",
    "skills",
    "posted_date",
    "url",
)
# Site addresses that relative links are completed with.
KALIBRR = "https://www.kalibrr.com"
JOBSTREET = "https://ph.jobstreet.com"
ONLINEJOBS = "https://www.onlinejobs.ph"
PHILJOBNET = "https://philjobnet.gov.ph"
INDEED = "https://ph.indeed.com"
ENTITY_PREFIXES = ("Job:", "JobSearchResult:", "JobListing:")
SSR_PATHS = ("jobResults.jobs", "results.jobs", "jobs", "initialData.jobs")


def _posting(**values: Column) -> Column:
    """The common struct; skills is an array, every other field a string."""
    unknown = set(values) - set(POSTING_FIELDS)
    if unknown:
        raise ValueError(f"unknown posting fields: {sorted(unknown)}")
    kinds = {"skills": "array<string>", "is_remote": "boolean"}
    return F.struct(
        *[values.get(n, F.lit(None)).cast(kinds.get(n, "string")).alias(n) for n in POSTING_FIELDS]
    )


def _text(node: Column, path: str) -> Column:
    return F.try_variant_get(node, f"$.{path}", "string")


def _items(node: Column, path: str) -> Column:
    return F.try_variant_get(node, f"$.{path}", "array<variant>")


def _filled(text: Column) -> Column:
    """NULL for what counts as empty: missing, '', zero."""
    return F.when(~text.isin("", "0", "0.0", "false"), text)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with a value that is worked out once however often `use` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _first_filled(arrays: Sequence[Column]) -> Column:
    return F.coalesce(*[_once(a, lambda found: F.when(F.size(found) > 0, found)) for a in arrays])


def _is_object(node: Column) -> Column:
    return F.schema_of_variant(node).startswith("OBJECT")


# --- JSON layouts ---------------------------------------------------------------------------------------------------


def api_items(payload: Column) -> Column:
    return _items(F.try_parse_json(payload), "jobs")


def api_posting(job: Column) -> Column:
    """API answer {jobs: [...]} with nested company, place and function objects."""
    job_id = _filled(_text(job, "id"))
    code = _filled(_text(job, "company_info.code"))
    place = "google_location.address_components"
    low, high = _filled(_text(job, "salary_from")), _filled(_text(job, "salary_to"))
    money = F.coalesce(_filled(_text(job, "salary_currency")), F.lit("PHP"))
    unknown = F.lit("?")
    functions = F.filter(F.coalesce(_items(job, "function"), F.array().cast("array<variant>")), _is_object)
    names = F.filter(F.transform(functions, lambda f: _filled(_text(f, "name"))), lambda n: n.isNotNull())
    return _posting(
        source_id=F.concat(F.lit("kalibrr_"), job_id),
        title=_text(job, "name"),
        company=_text(job, "company_info.name"),
        location=F.coalesce(_filled(_text(job, f"{place}.city")), _text(job, f"{place}.locality")),
        salary_raw=F.when(
            F.coalesce(low, high).isNotNull(),
            F.concat(money, F.lit(" "), F.coalesce(low, unknown), F.lit("-"), F.coalesce(high, unknown)),
        ),
        description=_text(job, "description"),
        employment_type=_text(job, "tenure"),
        experience_level=_text(job, "work_experience_value"),
        skills=names,
        posted_date=_text(job, "activation_date"),
        url=F.concat(
            F.lit(KALIBRR),
            F.coalesce(F.concat(F.lit("/c/"), code, F.lit("/jobs/")), F.lit("/jobs/")),
            job_id,
        ),
    )


#: What board postings are read from, taken out of each job at once; a part of another kind is NULL, a number is its text.
BOARD_JOB = (
    "struct<id string, jobId string, title string, salary string, teaser string, listingDate string, workType string, "
    "location string, locationLabel string, advertiser struct<name string, description string>>"
)


def _board_jobs(payload: Column, paths: Sequence[str]) -> Column:
    """Jobs of the first path that has any, each as BOARD_JOB; a payload is parsed once for all paths."""
    return _once(
        F.try_parse_json(payload),
        lambda node: _first_filled([F.try_variant_get(node, f"$.{path}", f"array<{BOARD_JOB}>") for path in paths]),
    )


def _board_posting(job: Column | dict[str, Column], company: Column, location: Column, employment: Column, job_id: Column) -> Column:
    return _posting(
        source_id=F.concat(F.lit("jobstreet_"), job_id),
        title=job["title"],
        company=company,
        location=location,
        salary_raw=job["salary"],
        description=job["teaser"],
        posted_date=job["listingDate"],
        employment_type=employment,
        url=F.concat(F.lit(f"{JOBSTREET}/job/"), job_id),
    )


def state_items(payload: Column) -> Column:
    """Page state: results.results.jobs, else jobsPage.jobs."""
    return _board_jobs(payload, ("results.results.jobs", "jobsPage.jobs"))


def state_posting(job: Column) -> Column:
    return _board_posting(
        job,
        job["advertiser"]["description"],
        job["location"],
        job["workType"],
        _filled(job["id"]),
    )


def entity_items(payload: Column) -> Column:
    """Flat cache {entity key: object}; job objects are known by their key's prefix."""
    cache = F.try_variant_get(F.try_parse_json(payload), "$", "map<string,variant>")

    def is_job(entry: Column) -> Column:
        prefixed = entry["key"].startswith(ENTITY_PREFIXES[0])
        for prefix in ENTITY_PREFIXES[1:]:
            prefixed = prefixed | entry["key"].startswith(prefix)
        return prefixed & _is_object(entry["value"])

    return F.filter(F.map_entries(cache), is_job)


def entity_posting(entry: Column) -> Column:
    job = entry["value"]
    return _board_posting(
        {name: _text(job, name) for name in ("title", "salary", "teaser", "listingDate")},
        _text(job, "advertiser.name"),
        _text(job, "location.label"),
        _text(job, "workTypes[0]"),
        F.coalesce(_filled(_text(job, "id")), _filled(_text(job, "jobId"))),
    )


def ssr_items(payload: Column) -> Column:
    """Server-side props: the first non-empty of four paths below props.pageProps."""
    return _board_jobs(payload, [f"props.pageProps.{path}" for path in SSR_PATHS])


def ssr_posting(job: Column) -> Column:
    return _board_posting(
        job,
        F.coalesce(_filled(job["advertiser"]["name"]), job["advertiser"]["description"]),
        F.coalesce(_filled(job["locationLabel"]), job["location"]),
        job["workType"],
        F.coalesce(_filled(job["id"]), _filled(job["jobId"])),
    )


# --- source ids and field cleanup -----------------------------------------------------------------------------------


def trailing_number(href: Column) -> Column:
    """123 of /some/title-123 or /some/title-123/."""
    return first_group(href, r"-(\d+)/*$")


def number_or_hash_id(href: Column, prefix: str, digits: int = 32) -> Column:
    """Trailing number, else the link's md5; fewer `digits` of it make shorter ids that can collide."""
    return F.concat(F.lit(prefix), F.coalesce(trailing_number(href), F.substring(F.md5(href), 1, digits)))


def job_path_id(href: Column) -> Column:
    """What follows the last /job/ up to a query."""
    return first_group(href, r"^.*/job/([^?]*)")


def absolute(href: Column, base: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def not_available_to_null(text: Column) -> Column:
    return F.when(~text.isin("N/A", "n/a", ""), text)


def unless_equal(text: Column, other: Column) -> Column:
    """Drop a value that only repeats another field."""
    return F.when(F.coalesce(text != other, F.lit(True)), text)


# --- HTML layouts (fixed values: the sites' class and attribute names) ----------------------------------------------


def _classed(name: str, tag: str = ANY_TAG, part: bool = False) -> Rule:
    return text_of(tag_with_class(name, tag, part))


def _marked(attribute: str, value: str, tag: str = ANY_TAG) -> Rule:
    return text_of(tag_with_attribute(attribute, value, tag))


def _before(end: str) -> str:
    """Regex of a step through what lies before a tag `end`: a whole stretch without a tag, or a "<" that does not start it."""
    return rf"(?:[^<]++|<(?!{end}))"


def _icon_row(icon: str) -> Rule:
    """Inner HTML of the div around an icon."""
    return Rule(rf"(?s)<(div)\b[^>]*>(?={_before(r'div\b|/div>')}*?{tag_with_class(icon).regex})", icon, element="div")


PHILJOBNET_CARDS = CardLayout(
    starts=[tag_with_class("nolink", "a")],
    texts={
        "title": [_classed("jobtitle")],
        "salary_raw": [_classed("salary")],
        "company": [_classed("companytitle")],
        "location": [_icon_row("bi-geo-alt")],
        "education_level": [_icon_row("bi-mortarboard")],
        "employment_type": [_icon_row("bi-file-text")],
        "posted_date": [_classed("jobinfo")],
    },
    attributes={"href": [attribute_of(tag_with_class("nolink", "a"), "href")]},
)
JOBSTREET_CARDS = CardLayout(
    starts=[
        tag_with_attribute("data-testid", "job-card", "article"),
        tag_with_attribute("data-automation", "normalJob", "article"),
        tag_with_attribute("data-automation", "jobCard", "article"),
        tag_with_attribute("data-card-type", "JobCard"),
    ],
    texts={
        "title": [_marked("data-automation", "jobTitle", "a")],
        "company": [_marked("data-automation", "jobCompany", "a")],
        "location": [_marked("data-automation", "jobLocation")],
        "salary_raw": [_marked("data-automation", "jobSalary")],
        "description": [_marked("data-automation", "jobShortDescription")],
        "classification": [_marked("data-automation", "jobClassification")],
        "sub_classification": [_marked("data-automation", "jobSubClassification")],
        "posted_date": [_marked("data-automation", "jobListingDate")],
    },
    attributes={
        "job_id": [Rule(r"(?s)^<(\w+)\b[^>]*\sdata-job-id=[\"']([^\"']*)[\"']", "data-job-id")],
        "href": [attribute_of(tag_with_attribute("data-automation", "jobTitle", "a"), "href")],
    },
)
_HEADING = tag_with_class("fw-700", "h4").regex
_BADGE = tag_with_class("badge", "span")
_JOB_TITLE = tag_with_class("jobTitle", "h2").regex
ONLINEJOBS_CARDS = CardLayout(
    starts=[tag_with_class("jobpost-cat-box", "div")],
    texts={
        "badge": [
            Rule(rf"(?s){_HEADING}{_before('/h4>')}*?<(span){_BADGE.rest}", "badge", element="span")
        ],
        "salary_raw": [
            Rule(rf"(?s)<dl\b[^>]*\bno-gutters\b[^>]*>.*?<(dd){tag_with_class('col', 'dd').rest}", "no-gutters", element="dd")
        ],
    },
    attributes={
        "heading": [_classed("fw-700", "h4")],
        "href": [Rule(r"(?s)<(a)\b[^>]*?\shref=[\"']([^\"']*/jobseekers/job/[^\"']*)[\"']", "/jobseekers/job/")],
        "posted_date": [attribute_of(tag_with_attribute("data-temp", tag="p"), "data-temp")],
    },
)
INDEED_CARDS = CardLayout(
    starts=[
        tag_with_class("job_seen_beacon", "div"),
        tag_with_attribute("data-testid", "slider_item", "li"),
        (tag_with_class("jobsearch-ResultsList", part=True), Opening("li", r"\b[^>]*>", "<li")),
    ],
    texts={
        "title": [
            Rule(rf"(?s){_JOB_TITLE}\s*<a\b[^>]*>{_before('/a>')}*?<(span)\b[^>]*\stitle=[^>]*>", "jobTitle", element="span"),
            Rule(rf"(?s){_JOB_TITLE}{_before('/h2>')}*?<(a)\b[^>]*>", "jobTitle", element="a"),
            Rule(rf"(?s)<h[23]\b[^>]*>{_before('/h[23]>')}*?<(a)\b[^>]*>", "<a", element="a"),
        ],
        "company": [
            _marked("data-testid", "company-name"),
            _classed("companyName"),
            _classed("companyName", part=True),
        ],
        "location": [
            _marked("data-testid", "text-location"),
            _classed("companyLocation"),
            _classed("companyLocation", part=True),
        ],
        "salary_raw": [
            _classed("salary-snippet-container"),
            _marked("data-testid", "attribute_snippet_testid"),
            _classed("salary", part=True),
        ],
        "employment_type": [_marked("data-testid", "attribute_snippet_testid")],
        "posted_date": [
            _marked("data-testid", "myJobsStateDate"),
            _classed("date", "span"),
            _classed("date", part=True),
        ],
    },
    attributes={
        "job_key": [Rule(r"(?s)<(\w+)\b[^>]*\sdata-jk=[\"']([^\"']*)[\"']", "data-jk")],
        "href": [Rule(rf"(?s)<h[23]\b[^>]*>{_before('/h[23]>')}*?<(a)\b[^>]*\shref=[\"']([^\"']*)[\"']", "href")],
    },
)


def philjobnet_posting(card: Column) -> Column:
    return _posting(
        source_id=F.concat(F.lit("philjobnet_"), trailing_number(card["href"])),
        title=card["title"],
        company=card["company"],
        location=card["location"],
        salary_raw=card["salary_raw"],
        employment_type=card["employment_type"],
        education_level=card["education_level"],
        posted_date=card["posted_date"],
        url=F.concat(F.lit(PHILJOBNET), card["href"]),
    )


def jobstreet_posting(card: Column) -> Column:
    job_id = F.coalesce(_filled(card["job_id"]), job_path_id(card["href"]))
    return _posting(
        source_id=F.concat(F.lit("jobstreet_"), job_id),
        title=card["title"],
        company=card["company"],
        location=card["location"],
        salary_raw=card["salary_raw"],
        description=card["description"],
        classification=card["classification"],
        sub_classification=card["sub_classification"],
        posted_date=card["posted_date"],
        url=F.concat(F.lit(f"{JOBSTREET}/job/"), job_id),
    )


def onlinejobs_posting(card: Column) -> Column:
    """The badge inside the heading is the employment type and is no part of the title."""
    title = without_element(card["heading"], _BADGE)
    complete = card["heading"].isNotNull() & card["href"].isNotNull()  # an empty heading is a heading
    return _posting(
        source_id=F.when(complete, number_or_hash_id(card["href"], "onlinejobs_")),
        title=F.regexp_replace(F.regexp_replace(title, r"<[^>]*>", ""), r"^\s+|\s+$", ""),
        salary_raw=not_available_to_null(card["salary_raw"]),
        salary_currency=F.lit("USD"),
        employment_type=card["badge"],
        is_remote=F.lit(True),
        posted_date=card["posted_date"],
        url=absolute(card["href"], ONLINEJOBS),
    )


def indeed_posting(card: Column) -> Column:
    key = _filled(card["job_key"])
    return _posting(
        source_id=F.concat(F.lit("indeed_"), key),
        title=card["title"],
        company=card["company"],
        location=card["location"],
        salary_raw=card["salary_raw"],
        employment_type=unless_equal(card["employment_type"], card["salary_raw"]),
        posted_date=card["posted_date"],
        url=F.coalesce(absolute(_filled(card["href"]), INDEED), F.concat(F.lit(f"{INDEED}/viewjob?jk="), key)),
    )


# --- operators over payload tables ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """items: payload -> array; posting: item -> posting struct; html: the card layout, when items are cards.

    A card's posting takes its fields by name, from a struct column or from a dict of columns.
    """

    items: Callable[[Column], Column]
    posting: Callable[[Column | dict[str, Column]], Column]
    html: CardLayout | None = None


def _cards(layout: CardLayout, posting: Callable) -> Layout:
    return Layout(lambda html: cards(html, layout), posting, layout)


LAYOUTS = {
    "api": Layout(api_items, api_posting),
    "state": Layout(state_items, state_posting),
    "entity_cache": Layout(entity_items, entity_posting),
    "ssr": Layout(ssr_items, ssr_posting),
    "philjobnet_html": _cards(PHILJOBNET_CARDS, philjobnet_posting),
    "jobstreet_html": _cards(JOBSTREET_CARDS, jobstreet_posting),
    "onlinejobs_html": _cards(ONLINEJOBS_CARDS, onlinejobs_posting),
    "indeed_html": _cards(INDEED_CARDS, indeed_posting),
}


def flatten(payloads: DataFrame, layout: str, keys: Sequence[str] = ("source", "page_no")) -> DataFrame:
    """One row per posting of every payload; items without an id are dropped.

    The outer explode keeps Spark from inferring a size filter that would take every payload apart twice.
    """
    spec = LAYOUTS[layout]
    items = payloads.select(*keys, F.explode_outer(spec.items(F.col("payload"))).alias("_item")).where("_item is not null")
    item = F.col("_item")
    if spec.html:
        items = with_fields(items, "_item", spec.html, keys)
        item = {name: F.col(name) for name in spec.html.rules}
    return _with_ids(items, spec.posting(item), keys)


def _with_ids(items: DataFrame, posting: Column, keys: Sequence[str]) -> DataFrame:
    """The postings that have an id. A generator gives them, so that Spark cannot move the filter below and repeat in it all
    that leads to the id."""
    return items.select(*keys, F.inline_outer(F.array(posting))).where("source_id is not null")


def first_strategy(
    pages: DataFrame, strategies: Sequence[tuple[str, str]], keys: Sequence[str] = ("source", "page_no")
) -> DataFrame:
    """Per page, the postings of the first strategy that yields any.

    strategies: (payload column, layout) in order of trust. All are tried inside the page's row, in steps: a later
    one is only evaluated where the earlier ones came out empty. Cards that are the last resort leave the row before
    their fields are taken out, next to the postings of the other pages.
    """

    def postings(column: str, layout: str) -> Column:
        spec = LAYOUTS[layout]
        parts = spec.items(F.col(column))
        if spec.html:
            parts = F.transform(parts, lambda card: card_fields(card, spec.html))
        return F.filter(F.transform(parts, spec.posting), lambda p: p["source_id"].isNotNull())

    *first, (column, layout) = strategies
    spec = LAYOUTS[layout]
    if not spec.html or not first:
        first, spec = list(strategies), None
    step = pages
    for place, strategy in enumerate(first):
        found = postings(*strategy)
        step = step.withColumn("_jobs", F.when(F.size("_jobs") > 0, F.col("_jobs")).otherwise(found) if place else found)
    if spec is None:
        return step.select(*keys, F.inline_outer("_jobs")).where("source_id is not null")
    of_jobs = F.transform("_jobs", lambda j: F.struct(j.alias("_job"), F.lit(None).cast("string").alias("_card")))
    no_job = F.get("_jobs", F.lit(-1))
    of_cards = F.transform(spec.items(F.col(column)), lambda c: F.struct(no_job.alias("_job"), c.alias("_card")))
    items = step.select(*keys, F.inline_outer(F.when(F.size("_jobs") > 0, of_jobs).otherwise(of_cards)))
    fields = with_fields(items.where("_job is not null or _card is not null"), "_card", spec.html, [*keys, "_job"])
    posting = F.coalesce("_job", spec.posting({name: F.col(name) for name in spec.html.rules}))
    return _with_ids(fields, posting, keys)


def dedup_run(
    postings: DataFrame,
    run: Sequence[str] = ("source",),
    page: str = "page_no",
    key: str = "source_id",
    term: str | None = None,
    terms: Sequence = (),
) -> DataFrame:
    """First sighting of each id within a run, up to the first page that shows only known ids.

    With `term`, a run asks for the search terms of the list `terms` one after the other: an id is known across all
    terms of the run, but each term's pages stop on their own and its first page never stops it. Pages behind a stop
    are not seen, so their ids are still new to the next term; hence one step per term, each written once.
    """
    run = list(run)
    if term is None:
        return _until_known(postings, postings, run, page, key)
    kept: list[DataFrame] = []
    for value in terms:
        asked = postings.where(F.col(term) == F.lit(value))
        fresh = asked
        if kept:
            known = reduce(DataFrame.unionByName, kept).select(*[F.col(c).alias(f"_known_{c}") for c in (*run, key)])
            same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in (*run, key)]
            fresh = asked.join(known, reduce(Column.__and__, same), "left_anti")
        kept.append(cut(_until_known(fresh, asked, run, page, key), "search-term"))
    return reduce(DataFrame.unionByName, kept) if kept else postings.limit(0)


def _until_known(fresh: DataFrame, asked: DataFrame, run: list[str], page: str, key: str) -> DataFrame:
    """First sightings in `fresh` before the first page of `asked` (the first one aside) that has none.

    Two partial aggregations and joins on small sides: first page per id, new ids per page, stop page per run.
    """
    value = [page, *[c for c in fresh.columns if c not in (*run, key, page)]]
    firsts = fresh.groupBy(*run, key).agg(F.min(F.struct(*value)).alias("_first")).select(*run, key, "_first.*")
    news = firsts.select(*run, page).distinct().withColumn("_fresh", F.lit(True))
    lowest = asked.groupBy(*run).agg(F.min(page).alias("_lowest"))
    stops = (
        asked.select(*run, page)
        .distinct()
        .join(news, [*run, page], "left")
        .join(lowest, run)
        .where(F.col("_fresh").isNull() & (F.col(page) > F.col("_lowest")))
        .groupBy(*run)
        .agg(F.min(page).alias("_stop"))
    )
    kept = firsts.join(stops, run, "left").where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop")))
    return kept.select(*asked.columns)


def page_class(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Mark block pages (challenge in the url or a challenge container) and login walls."""
    link, body = F.lower(F.col(url)), F.col(html)
    title = F.lower(F.regexp_extract(body, r"(?is)<title[^>]*>(.*?)</title>", 1))
    return pages.withColumns(
        {
            "is_blocked": link.contains("captcha")
            | link.contains("challenge")
            | body.rlike(r"\sid=[\"']captcha-container[\"']"),
            "is_login": F.col(url).contains("/login") | title.contains("sign in"),
        }
    )
