"""Paging in every order, by tokens and by numbers, and where the joins are."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from jobloom.operators import search

COMPANIES = "company_key long, company_name string"
PLACES = "location_key long, city string, region string"


@pytest.fixture(scope="module")
def star(spark):
    rows = []
    for i, (salary, top, day, company) in enumerate(product([None, 10.0, 20.0], [None, 30.0], [None, 20260501], [None, 1, 2, 9])):
        rows.append((i, "s", f"job {i}", "text", company, None if i % 3 else 1, salary, top, day))
    fact = spark.createDataFrame(rows, "job_key long, source string, title string, description string, company_key long, location_key long, salary_min double, salary_max double, date_posted_key long")
    for name, kind in (("salary_currency", "string"), ("salary_period", "string"), ("employment_type", "string"), ("experience_level", "string"), ("is_remote", "boolean"), ("url", "string")):
        fact = fact.withColumn(name, F.lit(None).cast(kind))
    return fact, spark.createDataFrame([(1, "Beta"), (2, "Alpha job"), (3, None)], COMPANIES), spark.createDataFrame([(1, "Cebu", "VII")], PLACES)


@pytest.mark.parametrize("order", ["-date_posted_key", "salary_min", "-salary_max,company_name", "company_name,-salary_min", "-company_name,salary_max,-date_posted_key", "nonsense"])
def test_tokens_walk_through_every_order(star, order):
    keys = search.order_keys(order, search.JOB_ORDER, ["-date_posted_key"])
    whole = [r.job_key for r in search.search_jobs(*star, order=order, size=100).rows.collect()]
    assert len(whole) == 48 == search.search_jobs(*star, order=order, size=5).total.first()[0]
    walked, token = [], None
    while True:
        rows = search.search_jobs(*star, order=order, size=11, after=token).rows.collect()
        if not rows:
            break
        walked += [r.job_key for r in rows]
        token = search.page_token(rows[-1], keys, "job_key")
    assert walked == whole
    assert [r.job_key for r in search.search_jobs(*star, order=order, number=3, size=11).rows.collect()] == whole[22:33]


def test_tokens_of_another_order_are_refused(star):
    row = search.search_jobs(*star, size=1).rows.first()
    token = search.page_token(row, ["salary_min"], "job_key")
    for bad in (token, "x", "e30="):
        with pytest.raises(ValueError):
            search.search_jobs(*star, after=bad)


def test_text_and_facets_of_dimensions(star):
    found = lambda **k: {r.job_key for r in search.search_jobs(*star, size=100, **k).rows.collect()}
    everything = star[0].join(star[1], "company_key", "left").join(star[2], "location_key", "left").collect()
    assert found(text="alpha") == {r.job_key for r in everything if r.company_name == "Alpha job"}
    assert found(text="JOB alpha, text") == found(text="alpha")
    assert found(company_name="bet", city="cebu") == {r.job_key for r in everything if r.company_name == "Beta" and r.city == "Cebu"}
    assert found(region="vi", city="", text=" ,") == {r.job_key for r in everything if r.region}
    assert found(text="no such") == set()


def joins_below_the_limit(df) -> int:
    """Joins under the page's limit in the optimised plan; the tree is printed from the top."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan[plan.index("Limit") :].count("Join ")


def test_dimensions_are_joined_to_the_page_only(star):
    assert joins_below_the_limit(search.search_jobs(*star, number=3).rows) == 0
    assert joins_below_the_limit(search.search_jobs(*star, order="-salary_max,company_name").rows) == 1  # for the order
    assert joins_below_the_limit(search.search_jobs(*star, company_name="a").rows) == 1  # a semi join
    plan = search.search_jobs(*star).rows._jdf.queryExecution().executedPlan().toString()
    assert "description" not in plan[plan.index("TakeOrdered") :].split("Scan")[0]
