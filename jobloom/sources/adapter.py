"""Postings made from order tables, for data sets that hold no postings.

`FIELDS_SQL` is plain SQL over orders, customer and nation; the placeholders take table names or DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TITLES = (
    "Senior Python Developer",
    "Java Engineer (Spring Boot)",
    "JavaScript / React.js Developer",
    "Google Ads Specialist",
    "C++ Systems Programmer",
    "C# and .NET Developer",
    "Data Analyst - SQL, Excel, Power BI",
    "DevOps Engineer AWS/Docker/K8s",
    "Call Center Agent",
    "  Node.js Backend Developer  ",
    "CI/CD Engineer, GitHub Actions",
    "Machine Learning Engineer (PyTorch)",
    "Javañ Specialist",
    None,
    "Go Developer",
    "REST API Engineer / PostgreSQL",
)
DESCRIPTIONS = (
    None,
    "We use python3, Django and redis.",
    "Experience with Google Cloud or GCP; git required.",
    "Kafka, Apache Spark and Airflow pipelines.",
    "No skills needed, training provided.",
    "Ruby on Rails or Laravel; MySQL",
    "Scala_or_Java8 not Java",
    "Angular, TypeScript (TS) & HTML/CSS",
    "",
    "Kotlin/Swift mobile; Agile, Scrum, Jira",
    "Terraform+Ansible+Jenkins on Azure, Linux",
)
PLACES = (
    "Makati City, Metro Manila",
    "BGC, Taguig",
    "QC",
    "Q.C.",
    "Pasig, Metro Manila",
    "Ortigas",
    "Work from home",
    None,
    "  Cebu  ",
    "Iloilo",
    "Clark, Pampanga",
    "Davao del Sur",
)
EMPLOYMENT = ("Full Time", "part-time", "Permanent", "Contract", "Freelance/Gig", "OJT", "project based", "Full-Time+2", None)
LEVELS = ("Entry Level", " Senior ", "Mid", None)
SKILL_ARRAYS = (None, '["Python","SQL"]', '["React JS","Node.js",""]', "[]")
SOURCES = ("philjobnet", "kalibrr", "jobstreet", "onlinejobs", "indeed")


def _case(index: str, values, default: str = "NULL") -> str:
    def literal(value) -> str:
        return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "''") + "'"

    whens = " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(values))
    return f"CASE {index} {whens} ELSE {default} END"


def _grouped(amount: str) -> str:
    """Thousands separator for amounts below a million."""
    text = f"CAST({amount} AS STRING)"
    head = f"CAST(CAST(floor({amount} / 1000.0) AS BIGINT) AS STRING)"
    tail = f"lpad(CAST({amount} % 1000 AS STRING), 3, '0')"
    return f"CASE WHEN {amount} >= 1000 THEN {head} || ',' || {tail} ELSE {text} END"


def _salary() -> str:
    def s(expr: str) -> str:
        return f"CAST({expr} AS STRING)"

    forms = (
        f"'₱' || {_grouped('a')} || ' - ₱' || {_grouped('(a + 5000)')} || '/month'",
        f"{s('k')} || 'k - ' || {s('k + 10')} || 'k'",
        f"'PHP ' || {s('a')} || '-?'",
        "'Competitive'",
        f"'$' || {s('k')} || '/hour'",
        f"'Up to PHP' || {s('k')} || 'K + Day 1 HMO'",
        "CASE WHEN o_custkey % 2 = 0 THEN '   ' END",
        "'Day 1 HMO, Weekends Off'",
        f"'PHP ' || {_grouped('(a * 12)')} || ' per year'",
        f"{s('a')} || ' to ' || {s('a + 3000')} || ' monthly'",
        f"'USD ' || {s('k * 100')} || ' – ' || {s('k * 150')} || ' per month'",
        f"{s('k * 10')} || ' per day'",
    )
    return "CASE o_orderkey % 12 " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(forms)) + " END"


def _iso() -> str:
    return "CAST(CAST(seen AS DATE) AS STRING)"


FIELDS_SQL = f"""
SELECT
  o_orderkey AS raw_id,
  {_case('o_orderkey % 5', SOURCES)} AS source,
  'p' || CAST(CAST(floor(o_orderkey / 10.0) AS BIGINT) AS STRING) AS source_id,
  seen AS scraped_at,
  {_case('o_orderkey % 16', TITLES)} AS title,
  CASE WHEN o_custkey % 50 = 0 THEN NULL
       WHEN o_custkey % 50 = 1 THEN '  '
       WHEN o_orderkey % 3 = 0 THEN upper(c_name)
       WHEN o_orderkey % 3 = 1 THEN ' ' || c_name || ' '
       ELSE lower(c_name) END AS company,
  {_case('o_custkey % 13', PLACES, 'n_name')} AS location,
  {_salary()} AS salary_raw,
  CASE o_custkey % 3 WHEN 0 THEN 'usd ' WHEN 1 THEN ' PHP' ELSE CAST(NULL AS STRING) END AS salary_currency,
  ' https://jobs.example.com/' || CAST(o_orderkey AS STRING) AS url,
  CASE o_orderkey % 6 WHEN 0 THEN {_iso()} || 'T00:00:00Z' WHEN 1 THEN 'Posted on 5/27/2026' WHEN 2 THEN '2026-13-45'
       WHEN 3 THEN CAST(NULL AS STRING) WHEN 4 THEN {_iso()} ELSE '3 days ago' END AS posted_date,
  {_case('o_custkey % 11', DESCRIPTIONS)} AS description,
  {_case('o_orderkey % 9', EMPLOYMENT)} AS employment_type,
  {_case('o_custkey % 4', LEVELS)} AS experience_level,
  CASE o_custkey % 2 WHEN 0 THEN ' College Level ' ELSE 'High School' END AS education_level,
  CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN CAST(NULL AS STRING) ELSE 'on' END AS is_remote,
  {_case('o_custkey % 4', SKILL_ARRAYS)} AS skills
FROM (
  SELECT o.o_orderkey, o.o_custkey, c.c_name, n.n_name,
         CAST(o.o_orderdate AS TIMESTAMP) + INTERVAL '10592' DAY AS seen,
         CAST(floor(o.o_totalprice / 10.0) AS BIGINT) AS a,
         CAST(floor(o.o_totalprice / 5000.0) AS BIGINT) + 1 AS k
  FROM {{orders}} o
  JOIN {{customer}} c ON o.o_custkey = c.c_custkey
  JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
) base
"""

JSON_FIELDS = (
    "title",
    "company",
    "location",
    "salary_raw",
    "salary_currency",
    "url",
    "posted_date",
    "description",
    "employment_type",
    "experience_level",
    "education_level",
    "is_remote",
)


def posting_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "nation")}
    # Orders are dealt out while they are narrow: a file of few row groups would leave all that follows to few tasks.
    tables["orders"] = tables["orders"].repartition("o_orderkey", "o_custkey")
    return spark.sql(FIELDS_SQL, **tables)


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with their fields packed into a JSON blob."""
    fields = posting_fields(spark, sf_dir)
    blob = F.to_json(F.struct(*JSON_FIELDS, F.from_json("skills", "array<string>").alias("skills")))
    return fields.select("raw_id", "source", "source_id", "scraped_at", blob.alias("raw_data"))
