import json
import random
import re

import pytest
from pyspark.sql import functions as F

from jobloom.functions.html import Opening, tag_with_class, whole_element, without_element
from jobloom.operators import payloads


def flat(spark, layout, *bodies):
    df = spark.createDataFrame([("s", i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "source string, page_no int, payload string")
    return payloads.flatten(df, layout).collect()


def test_api(spark):
    jobs = [
        {"id": 5, "name": "Dev", "company_info": {"code": "acme", "name": "Acme"}, "google_location": {"address_components": {"city": "", "locality": "Makati"}},
         "salary_from": 25000, "salary_to": None, "function": [{"name": "Python"}, "text", {"name": ""}, {"id": 3}], "tenure": "Full", "activation_date": "2026-05-01"},
        {"id": 6, "company_info": None, "google_location": None, "function": None, "salary_from": 0, "salary_to": 900, "salary_currency": "USD"},
        {"id": None, "name": "no id"},
        {"name": "no id"},
    ]
    a, b = flat(spark, "api", {"jobs": jobs}, {"jobs": []}, {}, "not json")
    assert (a.source_id, a.company, a.location, a.salary_raw, a.skills) == ("kalibrr_5", "Acme", "Makati", "PHP 25000-?", ["Python"])
    assert a.url == "https://www.kalibrr.com/c/acme/jobs/5"
    assert (b.source_id, b.salary_raw, b.skills, b.url) == ("kalibrr_6", "USD ?-900", [], "https://www.kalibrr.com/jobs/6")


def test_state(spark):
    job = {"id": "9", "title": "T", "advertiser": {"description": "Co"}, "location": "QC", "salary": "1k", "workType": "Full"}
    both = {"results": {"results": {"jobs": [job]}}, "jobsPage": {"jobs": [{"id": 1}]}}
    second = {"results": {"results": {"jobs": []}}, "jobsPage": {"jobs": [{"id": 1, "advertiser": None}]}}
    got = flat(spark, "state", both, second, {"results": None})
    assert [(r.source_id, r.company, r.employment_type) for r in got] == [("jobstreet_9", "Co", "Full"), ("jobstreet_1", None, None)]


def test_entity_cache(spark):
    cache = {
        "Job:1": {"id": 1, "advertiser": {"name": "A"}, "location": {"label": "L"}, "workTypes": ["Full", "x"]},
        "JobListing:2": {"jobId": "2", "workTypes": []},
        "Job:text": "text",
        "Advertiser:3": {"id": 3},
        "JobSearchResult:4": {"title": "no id"},
    }
    got = sorted(flat(spark, "entity_cache", cache), key=lambda r: r.source_id)
    assert [(r.source_id, r.company, r.location, r.employment_type) for r in got] == [("jobstreet_1", "A", "L", "Full"), ("jobstreet_2", None, None, None)]


@pytest.mark.parametrize("path", [["jobResults", "jobs"], ["results", "jobs"], ["jobs"], ["initialData", "jobs"]])
def test_ssr_paths(spark, path):
    props = [{"jobId": 7, "advertiser": {"name": "", "description": "D"}, "locationLabel": "", "location": "L"}]
    for key in reversed(path):
        props = {key: props}
    (r,) = flat(spark, "ssr", {"props": {"pageProps": props}})
    assert (r.source_id, r.company, r.location) == ("jobstreet_7", "D", "L")


PHILJOBNET = """<div><a class="x" href="/y-1">no</a>
<a class="nolink" href="/job-vacancies/job/bakery-clerk-2204417"><div class="jobcard"><h1 class="jobtitle"> CLERK &amp; <b>BAKER</b></h1>
<h3 class="salary">₱18,400/month</h3><span class="companytitle">Blue Kiln</span><div><i class="bi bi-geo-alt"></i> Davao </div>
<div><i class="bi bi-file-text"></i>Seasonal</div><span class="jobinfo">Posted on 3/14/2026</span></div></a>
<a class="nolink" href="/job/no-number"><h1 class="jobtitle">x</h1></a></div>"""


def test_philjobnet(spark):
    (r,) = flat(spark, "philjobnet_html", PHILJOBNET)
    assert (r.source_id, r.title, r.salary_raw, r.company, r.location) == ("philjobnet_2204417", "CLERK & BAKER", "₱18,400/month", "Blue Kiln", "Davao")
    assert (r.education_level, r.employment_type, r.posted_date) == (None, "Seasonal", "Posted on 3/14/2026")
    assert r.url == "https://philjobnet.gov.ph/job-vacancies/job/bakery-clerk-2204417"


def test_jobstreet_falls_back_to_older_cards(spark):
    new = """<article class="c" data-testid="job-card" data-job-id="11"><a data-automation="jobTitle" href="/job/99?x">T</a><span data-automation="jobLocation"></span></article>
    <article data-automation="normalJob"><a data-automation="jobTitle" href="/job/12">not a card here</a></article>"""
    old = '<article data-automation="jobCard"><h3><a data-automation="jobTitle" href="/job/13?type=x">Old</a></h3><a data-automation="jobCompany">C</a></article><p>no cards</p>'
    got = flat(spark, "jobstreet_html", new, old, "<p>nothing</p>")
    assert [(r.page_no, r.source_id, r.title, r.company, r.location) for r in got] == [(0, "jobstreet_11", "T", None, ""), (1, "jobstreet_13", "Old", "C", None)]


def test_onlinejobs(spark):
    page = """<div class="jobpost-cat-box"><a href="/jobseekers/job/Some-Title-1657818"><h4 class="fs-16 fw-700">Some Title <span class="badge">Part Time</span></h4></a>
    <p data-temp="2026-05-30 10:00:00">x</p><dl class="row no-gutters"><dt></dt><dd class="col">N/A</dd></dl></div>
    <div class="jobpost-cat-box"><a href="https://x.ph/jobseekers/job/abc"><h4 class="fw-700">Two</h4></a><dl class="no-gutters"><dd class="col"> $5/hour </dd></dl></div>
    <div class="jobpost-cat-box"><a href="/other">no link</a><h4 class="fw-700">Three</h4></div>"""
    a, b = flat(spark, "onlinejobs_html", page)
    assert (a.source_id, a.title, a.employment_type, a.salary_raw, a.posted_date) == ("onlinejobs_1657818", "Some Title", "Part Time", None, "2026-05-30 10:00:00")
    assert (a.salary_currency, a.is_remote, a.url) == ("USD", True, "https://www.onlinejobs.ph/jobseekers/job/Some-Title-1657818")
    assert (b.source_id, b.salary_raw, b.url) == ("onlinejobs_d9cf17ffddb5"[:11] + b.source_id[11:], "$5/hour", "https://x.ph/jobseekers/job/abc")
    assert len(b.source_id) == len("onlinejobs_") + 32


def test_indeed(spark):
    first = """<div class="job_seen_beacon"><h2 class="jobTitle"><a data-jk="a1" href="/rc/clk?jk=a1"><span title="Dev">Dev</span></a></h2>
    <span class="companyName">Co</span><div class="companyLocation">QC</div><div data-testid="attribute_snippet_testid">₱30,000 a month</div><span class="date">3 days ago</span></div>
    <div class="job_seen_beacon"><h2>no key</h2></div>"""
    listed = """<li data-jk="menu">menu</li><ul class="css jobsearch-ResultsList x"><li class="r"><h3><a data-jk="b2" href="https://ph.indeed.com/b2">Two</a></h3>
    <div data-testid="attribute_snippet_testid">Full-time</div><div class="salary-snippet-container">₱1</div></li></ul>"""
    a, b = flat(spark, "indeed_html", first, listed)
    assert (a.source_id, a.title, a.company, a.location, a.salary_raw, a.employment_type, a.posted_date) == ("indeed_a1", "Dev", "Co", "QC", "₱30,000 a month", None, "3 days ago")
    assert a.url == "https://ph.indeed.com/rc/clk?jk=a1"
    assert (b.source_id, b.title, b.salary_raw, b.employment_type, b.url) == ("indeed_b2", "Two", "₱1", "Full-time", "https://ph.indeed.com/b2")


def test_first_strategy(spark):
    state = json.dumps({"jobsPage": {"jobs": [{"id": 1}]}})
    cache = json.dumps({"Job:2": {"id": 2}})
    card = '<article data-testid="job-card" data-job-id="3"><a data-automation="jobTitle">x</a></article>'
    no_id = json.dumps({"jobsPage": {"jobs": [{"title": "no id"}]}})
    pages = spark.createDataFrame(
        [("s", 0, state, cache, card), ("s", 1, no_id, cache, card), ("s", 2, None, "{}", card), ("s", 3, None, None, "")],
        "source string, page_no int, a string, b string, c string",
    )
    out = payloads.first_strategy(pages, [("a", "state"), ("b", "entity_cache"), ("c", "jobstreet_html")])
    assert sorted((r.page_no, r.source_id) for r in out.collect()) == [(0, "jobstreet_1"), (1, "jobstreet_2"), (2, "jobstreet_3")]


def test_dedup_run_stops_at_a_page_without_news(spark):
    seen = [(1, "a", "x"), (1, "b", "x"), (2, "b", "y"), (2, "c", "y"), (3, "a", "z"), (3, "c", "z"), (4, "d", "w")]
    df = spark.createDataFrame([("s", p, i, v) for p, i, v in seen], "source string, page_no int, source_id string, v string")
    out = payloads.dedup_run(df)
    assert sorted((r.page_no, r.source_id, r.v) for r in out.collect()) == [(1, "a", "x"), (1, "b", "x"), (2, "c", "y")]
    assert out.columns == df.columns


def test_dedup_run_knows_ids_across_terms_but_stops_each_term_alone(spark):
    seen = [
        ("one", 1, "a"), ("one", 2, "a"), ("one", 3, "late"),
        ("two", 1, "a"), ("two", 2, "late"), ("two", 3, "a"), ("two", 4, "lost"),
        (None, 1, None), ("three", 1, None), ("three", 2, None), ("three", 2, "b"),
    ]
    df = spark.createDataFrame([("s", t, p, i) for t, p, i in seen], "source string, term string, page_no int, source_id string")
    out = payloads.dedup_run(df, term="term", terms=["one", "two", "three"]).collect()
    kept = {("one", 1, "a"), ("two", 2, "late"), ("three", 1, None), ("three", 2, "b")}
    assert {(r.term, r.page_no, r.source_id) for r in out} == kept and len(out) == 4
    assert payloads.dedup_run(df, term="term").count() == 0


def test_page_class(spark):
    df = spark.createDataFrame(
        [
            ("https://x/CAPTCHA?a", "<p>"),
            ("https://x/y", "<div id='captcha-container'></div>"),
            ("https://x/login?next", "<p>"),
            ("https://x/y", "<title>Please Sign In</title>"),
            ("https://x/y", "<title>Jobs</title>"),
        ],
        "url string, html string",
    )
    got = [(r.is_blocked, r.is_login) for r in payloads.page_class(df).collect()]
    assert got == [(True, False), (True, False), (False, True), (False, True), (False, False)]


def test_payload_is_taken_apart_once(spark):
    df = spark.createDataFrame([("s", 0, "{}")], "source string, page_no int, payload string")
    plan = payloads.flatten(df, "api")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "Exchange" not in plan


def test_elements_end_where_they_close(spark):
    """Fields that nest their own tag, cards that nest theirs, and look-alikes outside of cards."""
    aside = '<aside><!-- <a class="nolink" href="/x-9"> --><script>"<a class=\'nolink\'>"</script><span class="companytitle">Ad</span></aside>'
    card = '<a class="nolink" href="/job-1"><div><h1 class="jobtitle">A <h1>B</h1> C</h1><span class="companytitle"><span>Acme</span> <SPAN>and</SPAN><span/> Sons</span></div></a>'
    bare = '<a class="nolink" href="/job-2"><h1 class="jobtitle">D</h1></a>'
    a, b = flat(spark, "philjobnet_html", aside + card + aside + bare + aside)
    assert (a.title, a.company, b.title, b.company) == ("A B C", "Acme and Sons", "D", None)

    inner = '<div class="job_seen_beacon"><div><div><h2 class="jobTitle"><a data-jk="1" href="/v"><span title="t">T</span></a></h2></div></div></div>'
    (c,) = flat(spark, "indeed_html", f'{inner}<footer><span data-testid="company-name">Footer</span></footer>')
    assert (c.source_id, c.title, c.company) == ("indeed_1", "T", None)
    never = '<div class="job_seen_beacon"><h2 class="jobTitle"><a data-jk="2" href="/v"><span title="t">U</span></a></h2><span data-testid="company-name">Open'
    (d,) = flat(spark, "indeed_html", never + "</span>")  # a card that is not closed goes on to the end
    assert (d.title, d.company) == ("U", "Open")

    badge = '<div class="jobpost-cat-box"><a href="/jobseekers/job/x-5"><h4 class="fw-700">Dev <span class="badge">Full <span>Time</span> now</span></h4></a></div>'
    (e,) = flat(spark, "onlinejobs_html", badge)
    assert (e.title, e.employment_type) == ("Dev", "Full Time now")


def test_plans_of_cards_stay_small(spark):
    """One copy of the table of names, and no filter that repeats what leads to the id."""
    df = spark.range(1).selectExpr("'s' AS source", "1 AS page_no", "cast(id AS string) AS payload")
    for layout in ("philjobnet_html", "jobstreet_html", "onlinejobs_html", "indeed_html"):
        plan = payloads.flatten(df, layout)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("CounterClockwiseContourIntegral") <= 2 and plan.count("regexp_extract") < 100 and len(plan) < 150_000


def test_regexes_take_text_in_stretches(spark):
    """Text between tags is passed in whole stretches, not tried character by character; what is found stays the same."""
    df = spark.range(1).selectExpr("'s' AS source", "1 AS page_no", "cast(id AS string) AS payload")
    for layout in ("philjobnet_html", "jobstreet_html", "onlinejobs_html", "indeed_html"):
        plan = payloads.flatten(df, layout)._jdf.queryExecution().optimizedPlan().toString()
        assert ").)*" not in plan and r"(?=<\w" not in plan and "(?i)(?=</?" not in plan

    slow = r"<\w+\b[^>]*?\bclass=[\"'][^\"']*?(?<![\w-])salary(?![\w-])[^\"']*[\"'][^>]*>"
    rows = [(rf"(?s){slow}", rf"(?s){tag_with_class('salary').regex}")]
    for end, after in (("div\\b|/div>", slow), ("/a>", "<(span)\\b"), ("/h[23]>", "<(a)\\b")):
        negative = "|".join(f"<{e}" for e in end.split("|"))
        rows.append((rf"(?s)<(div|h2)\b[^>]*>(?:(?!{negative}).)*?{after}", rf"(?s)<(div|h2)\b[^>]*>{payloads._before(end)}*?{after}"))
    pick = random.Random(5)
    parts = ["<div", "</div>", "<a", "</a>", "<h2", "</h3>", "<span", ">", " class='", "xclass='", "class=\"", "salary", "-salary", " ", "'", '"', "x", "\n", "<"]
    for text in ("".join(pick.choices(parts, k=25)) for _ in range(500)):
        for old, new in rows:
            assert [m.span() for m in re.finditer(old, text)] == [m.span() for m in re.finditer(new, text)], text


def test_a_tag_at_the_start_is_no_tag_inside(spark):
    html = F.lit("<b><b>x</b><b/>y</b >z</b>")
    cut_off = F.lit("<b>x</b")
    got = spark.range(1).select(whole_element(html), whole_element(cut_off), whole_element(html, "b"), without_element(html, Opening("b", "/>", "b"))).first()
    assert tuple(got) == ("<b><b>x</b><b/>y</b >", "<b>x</b", "<b><b>x</b><b/>y</b >", "<b><b>x</b>z</b>")


@pytest.mark.parametrize("layout", ["ssr", "state"])
def test_board_payloads_are_parsed_once(spark, layout):
    df = spark.createDataFrame([("s", 1, "{}")], "source string, page_no int, payload string")
    plan = payloads.flatten(df, layout)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_ssr_jobs_of_odd_kinds(spark):
    jobs = [
        "text", 5, None, [], {}, {"id": 1.50, "title": True, "advertiser": "x", "salary": {"a": [1, None]}, "teaser": 1e20, "workType": 12345678901234567890},
        {"id": "0", "jobId": 8, "advertiser": {"name": 3, "description": None}, "location": ["L"]}, {"id": False, "jobId": "j", "advertiser": {"description": "D"}},
    ]
    rows = flat(spark, "ssr", {"props": {"pageProps": {"jobResults": {"jobs": "none"}, "results": {"jobs": jobs}, "jobs": [{"id": 9}]}}}, {"props": 1}, "{")
    got = [(r.source_id, r.title, r.company, r.location, r.salary_raw, r.description, r.employment_type) for r in rows]
    assert got == [
        ("jobstreet_1.5", "true", None, None, '{"a":[1,null]}', "1.0E20", "12345678901234567890"),
        ("jobstreet_8", None, "3", '["L"]', None, None, None),
        ("jobstreet_j", None, "D", None, None, None, None),
    ]
