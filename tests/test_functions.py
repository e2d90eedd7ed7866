from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from jobloom.functions import display, location, salary, text
from jobloom.functions.html import plain_text
from jobloom.operators import payloads

PARSED = [
    ("₱50,000 - ₱80,000/month", 50000, 80000, "PHP", "monthly"),
    ("$1,500 - $2,500", 1500, 2500, "USD", "monthly"),
    ("30k - 50k", 30000, 50000, "PHP", "monthly"),
    ("PHP 25,000", 25000, None, "PHP", "monthly"),
    ("Competitive", None, None, "PHP", "monthly"),
    ("PHP45K + PHP20K incentives", 45000, None, "PHP", "monthly"),
    ("Up to PHP55K + Day 1 HMO", 55000, 55000, "PHP", "monthly"),
    ("215k - 230k p.m. + allowance", 215000, 230000, "PHP", "monthly"),
    ("Day 1 HMO, Weekends Off", None, None, "PHP", "monthly"),
    ("₱0.00", None, None, "PHP", "monthly"),
    ("PHP 25000-?", 25000, None, "PHP", "monthly"),
    ("PHP ?-50000", 50000, 50000, "PHP", "monthly"),
    ("Php30,000.00 ~ Php50,000.00", 30000, 50000, "PHP", "monthly"),
    ("$5/hour", 5, None, "USD", "hourly"),
    ("PHP 600,000 per year", 600000, None, "PHP", "yearly"),
    ("PHP 25.5k - 30k", 25500, 30000, "PHP", "monthly"),
    ("₱35,000 - ₱25,000/month", 35000, 25000, "PHP", "monthly"),
    ("500 per day", None, None, "PHP", "daily"),
    ("20 kalibrr", 20000, None, "PHP", "monthly"),
    ("9" * 40, None, None, "PHP", "monthly"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    data = [(i, "s", "x", p[0], None) for i, p in enumerate(PARSED)]
    df = spark.createDataFrame(data, "raw_id long, source string, source_id string, salary_raw string, salary_currency string")
    return {r.raw_id: r for r in salary.parse_salary(df).collect()}


@pytest.mark.parametrize("i", range(len(PARSED)), ids=[p[0][:30] for p in PARSED])
def test_salary(parsed, i):
    _, low, high, currency, period = PARSED[i]
    r = parsed[i]
    assert (r.salary_min, r.salary_max) == (
        None if low is None else Decimal(low),
        None if high is None else Decimal(high),
    )
    assert (r.salary_currency, r.salary_period) == (currency, period)


def test_explicit_currency_wins_and_blank_text_is_left_out(spark):
    df = spark.createDataFrame(
        [(1, "s", "a", "₱500 - 900", "USD"), (2, "s", "b", "  ", None), (3, "s", "c", None, None), (4, "s", "d", "100 usd", "")],
        "raw_id long, source string, source_id string, salary_raw string, salary_currency string",
    )
    assert {r.raw_id: r.salary_currency for r in salary.parse_salary(df).collect()} == {1: "USD", 4: "USD"}


SIMPLE = [
    ("₱25,000 - ₱35,000/month", (25000, 35000, "PHP", "monthly")),
    ("PHP 25k to 35k monthly", (25000, 35000, "PHP", "monthly")),
    ("PHP 25,000", (25000, 25000, "PHP", "monthly")),
    ("$500/month", (500, 500, "USD", "monthly")),
    ("PHP 600,000 annual", (600000, 600000, "PHP", "annual")),
    ("25.5k - 30k", (25500, 30000, "PHP", "monthly")),
    ("₱35,000 - ₱25,000/month", (25000, 35000, "PHP", "monthly")),
    ("25000-35000", (25000, 35000, "PHP", "monthly")),
    ("Competitive salary", (None, None, None, None)),
    ("", (None, None, None, None)),
    (None, (None, None, None, None)),
]


def test_simple_dialect(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(SIMPLE)], "i int, s string")
    got = {r.i: tuple(r.p) for r in df.select("i", salary.parse_salary_simple(F.col("s")).alias("p")).collect()}
    assert [got[i] for i in range(len(SIMPLE))] == [s[1] for s in SIMPLE]


def test_bucket_edges(spark):
    df = spark.createDataFrame([(None,), (14999,), (15000,), (59999,), (150000,)], "x int")
    got = [r[0] for r in df.select(salary.salary_bucket(F.col("x"))).collect()]
    assert got == ["Not disclosed", "Below ₱15K", "₱15K-25K", "₱40K-60K", "₱150K+"]


def test_monthly_pesos(spark):
    df = spark.createDataFrame(
        [(500, 800, "USD", "monthly"), (120000, None, "PHP", "yearly"), (5, 0, "USD", "hourly"), (100, 200, "PHP", "daily")],
        "a int, b int, c string, p string",
    )
    out = df.select(salary.to_monthly_php(*[F.col(c) for c in "abcp"]).alias("m")).select("m.*").collect()
    assert [tuple(r) for r in out] == [(28000.0, 44800.0), (pytest.approx(10000.0), None), (49280.0, None), (2200.0, 4400.0)]


@pytest.mark.parametrize(
    "raw, city, remote",
    [
        ("Makati City, Metro Manila", "Makati", False),
        ("BGC, Taguig", "Taguig", False),
        ("QC", "Quezon City", False),
        ("Q.C.", "Q.C.", False),
        ("QCX", "QCX", False),
        ("Pasig, Metro Manila", "Manila", False),
        ("Ortigas", "Pasig", False),
        ("Work from home", "Work from home", True),
        (" Baguio ", "Baguio", False),
    ],
)
def test_city(spark, raw, city, remote):
    df = spark.createDataFrame([(raw,)], "x string")
    r = df.select(location.map_city(F.col("x")), location.looks_remote(F.col("x"))).first()
    assert tuple(r) == (city, remote)


def test_labels(spark):
    df = spark.createDataFrame(
        [
            (1500.0, 2500.5, "USD", 20260530, "full-time+2"),
            (0.0, None, "PHP", 123, "freelance/gig"),
            (None, 30000.0, "PHP", None, None),
            (20000.0, None, "PHP", 20261340, "project based"),
        ],
        "a double, b double, c string, k int, e string",
    )
    out = df.select(
        display.salary_label(F.col("a"), F.col("b"), F.col("c")),
        display.date_key_label(F.col("k")),
        display.employment_bucket(F.col("e")),
        display.employment_label(F.col("e")),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("$1,500 – $2,500.5", "May 30, 2026", "fulltime", "Full Time"),
        ("Negotiable", "Date not available", "freelance", "Freelance Gig"),
        ("₱30,000", "Date not available", None, None),
        ("₱20,000", "Date not available", "project", "Project Based"),
    ]
    money = spark.range(1).select(display.peso_label(F.lit(1234.5)), display.peso_label(F.lit(None).cast("double"))).first()
    assert tuple(money) == ("₱1,235", "₱0")


def test_booleans_dates_and_ids(spark):
    df = spark.createDataFrame(
        [("on", "2026-05-01T00:00:00Z", "/a/b-123/"), ("off", "2026-13-45", "/a/b"), ("maybe", "Posted on 5/27/2026", "/job/77?x=1")],
        "b string, d string, h string",
    )
    out = df.select(
        text.text_to_boolean(F.col("b")),
        text.iso_day(F.col("d")).cast("string"),
        payloads.trailing_number(F.col("h")),
        payloads.job_path_id(F.col("h")),
    ).collect()
    assert [tuple(r) for r in out] == [(True, "2026-05-01", "123", None), (False, None, None, None), (None, None, None, "77")]


@pytest.mark.parametrize(
    "html, text",
    [
        ("&#8369;25,000 &ndash; &#x20B1;30,000", "₱25,000 – ₱30,000"),
        ("R&amp;D &amp;lt; &lt;b&gt;", "R&D &lt; <b>"),
        ("&#128188; &#0; &#xD800; &#99999999; &#150;", "\U0001f4bc \ufffd \ufffd \ufffd –"),
        ("&nbsp;a&nbsp;b&nbsp;", "a\u00a0b"),
        ("AT&T & &unknown; &; &#; &#x; 100%&", "AT&T & &unknown; &; &#; &#x; 100%&"),
        ("&#8369 5 &#0008369;&#8369each", "₱ 5 ₱₱each"),
        ("", ""),
        (None, None),
    ],
)
def test_character_references(spark, html, text):
    assert spark.createDataFrame([(html,)], "h string").select(plain_text(F.col("h"))).first()[0] == text
