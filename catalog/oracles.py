"""SQL for DuckDB over the same tables, written apart from the operators.

Only the posting fields and the fixed values (dictionary, regions) are shared with the Spark side.
"""

from __future__ import annotations

import csv
from importlib.resources import files

from catalog.fixtures import DOCUMENT_TERMS, damaged_sql
from jobloom.sources.adapter import FIELDS_SQL

ORACLES: dict[str, str] = {}

NOT_WORD = r"[^\p{L}\p{N}_]"


def _seed(name: str) -> list[dict[str, str]]:
    text = files("jobloom").joinpath("seeds", f"{name}.csv").read_text(encoding="utf-8")
    return list(csv.DictReader(text.split("\n", 1)[1].splitlines()))


def _q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _values(rows, names: str) -> str:
    body = ", ".join("(" + ", ".join(r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) v({names})"


SKILL_ROWS = [(r["pattern"], r["canonical_name"], r["category"]) for r in _seed("skill_terms")]
TERMS = _values([[_q(x) for x in r] for r in SKILL_ROWS], "pattern, name, category")
REGIONS = _values([[_q(r["city"]), _q(r["province"]), _q(r["region"]), r["is_ncr"]] for r in _seed("regions")], "city, province, region, is_ncr")

FIELDS = FIELDS_SQL.format(orders="orders", customer="customer", nation="nation")

SOURCE_LABEL = """CASE source WHEN 'philjobnet' THEN 'PhilJobNet' WHEN 'kalibrr' THEN 'Kalibrr' WHEN 'jobstreet' THEN 'JobStreet'
  WHEN 'onlinejobs' THEN 'OnlineJobs' WHEN 'indeed' THEN 'Indeed' ELSE source END"""
POSTED = r"CASE WHEN regexp_matches(posted_date, '^\d{4}-\d{2}-\d{2}') THEN TRY_CAST(substr(posted_date, 1, 10) AS DATE) END"
REMOTE = "CASE lower(is_remote) WHEN 'true' THEN true WHEN 'false' THEN false WHEN 'on' THEN true ELSE true END"

# Topic, meaning, place in the order of trust, and the word (a regex) that says so in a pay text.
PAY_WORDS = _values(
    [
        [_q(topic), _q(meaning), str(place), _q(word)]
        for place, (topic, meaning, words) in enumerate(
            (
                ("currency", "PHP", ("php", "₱")),
                ("currency", "USD", ("usd", "[$]", "us\\s*dollar", "dollar")),
                ("period", "hourly", ("per\\s*hour", "/hr", "hourly", "/hour")),
                ("period", "daily", ("per\\s*day", "daily", "/day")),
                ("period", "yearly", ("per\\s*year", "yearly", "annual", "/yr", "/year", "p[.]a[.]")),
                ("signal", "money", ("php", "usd", "peso", "dollar", "[$]", "₱", "£", "€")),
                ("signal", "rate", ("/hr", "/hour", "per\\s*hour", "hourly", "/mo", "/month", "per\\s*month", "monthly", "/yr", "/year", "per\\s*year", "yearly", "annual", "p[.]a[.]")),
                ("thousands", "k", ("[0-9]\\s*k",)),
            )
        )
        for word in words
    ],
    "topic, meaning, place, word",
)
# Place in the order of trust, word (a regex) in a place's text, and the city it means.
PLACE_WORDS = _values(
    [
        [str(place), _q(word), _q(city)]
        for place, (city, words) in enumerate(
            (
                ("Makati", ("makati",)),
                ("Taguig", ("bgc", "bonifacio", "taguig")),
                ("Quezon City", ("quezon\\s*city", f"(^|{NOT_WORD})qc({NOT_WORD}|$)")),
                ("Manila", ("manila",)),
                ("Pasig", ("ortigas", "pasig")),
                ("Mandaluyong", ("mandaluyong",)),
                ("Muntinlupa", ("alabang", "muntinlupa")),
                ("Cebu City", ("cebu",)),
                ("Davao City", ("davao",)),
                ("Clark", ("clark", "pampanga", "angeles")),
                ("Iloilo City", ("iloilo",)),
                ("remote", ("remote", "wfh", "work from home", "anywhere")),
            )
        )
        for word in words
    ],
    "place, word, city",
)

# Steps of the chain; each is a CTE that may read the ones before it.
STEPS = {
    "f": FIELDS,
    "staged": f"""
SELECT raw_id, source, source_id, scraped_at, trim(title) AS title,
  CASE WHEN source <> 'onlinejobs' THEN trim(company) END AS company,
  CASE WHEN source <> 'onlinejobs' THEN trim(location) END AS location_raw,
  trim(salary_raw) AS salary_raw,
  CASE WHEN source = 'onlinejobs' THEN upper(trim(salary_currency)) END AS salary_currency,
  trim(url) AS url, {POSTED} AS posted_date,
  CASE WHEN source IN ('philjobnet', 'kalibrr', 'jobstreet') THEN description END AS description,
  lower(trim(employment_type)) AS employment_type,
  CASE WHEN source = 'kalibrr' THEN lower(trim(experience_level)) END AS experience_level,
  CASE WHEN source = 'onlinejobs' THEN {REMOTE} END AS is_remote,
  CASE WHEN source = 'kalibrr' THEN skills END AS skills_json
FROM f WHERE title IS NOT NULL""",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY source, source_id ORDER BY scraped_at DESC, raw_id DESC) AS rn FROM staged",
    "jobs": "SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1",
    # What a pay text says: its numbers and the signs between them in order, and which of the known words it has.
    "pay_marks": r"""
SELECT raw_id, i, marks[i] AS mark, marks[i] SIMILAR TO '[0-9].*' AS is_number, i > 1 AND NOT marks[i - 1] SIMILAR TO '[0-9.].*' AS after_sign
FROM (SELECT raw_id, regexp_extract_all(replace(replace(split_part(lower(salary_raw), '+', 1), ',', ''), 'k', ''), '[0-9]+(?:[.][0-9]+)?|[.]|\s+to\s+|[–—~-]') AS marks FROM jobs),
  (SELECT unnest(range(1, 100)) AS i) WHERE i <= len(marks)""",
    "pay_words": f"""
SELECT raw_id, topic, arg_min(meaning, place) AS meaning FROM jobs JOIN ({PAY_WORDS}) w
ON regexp_matches(CASE WHEN topic = 'thousands' THEN split_part(lower(salary_raw), '+', 1) ELSE lower(salary_raw) END, word) GROUP BY raw_id, topic""",
    "sal": """
SELECT raw_id, source, source_id, salary_raw, salary_currency, salary_period,
  CASE WHEN low > 0 AND (told OR low >= 1000) THEN round(low, 2) END AS salary_min,
  CASE WHEN high > 0 AND (told OR high >= 1000) THEN round(high, 2) END AS salary_max
FROM (
  SELECT raw_id, source, source_id, salary_raw, coalesce(nullif(salary_currency, ''), said['currency'], 'PHP') AS salary_currency,
    coalesce(said['period'], 'monthly') AS salary_period, said['signal'] IS NOT NULL OR said['thousands'] IS NOT NULL AS told,
    CASE WHEN said['thousands'] IS NULL THEN 1 ELSE 1000 END * first_number AS low, CASE WHEN said['thousands'] IS NULL THEN 1 ELSE 1000 END * top_number AS high
  FROM (SELECT * FROM jobs WHERE trim(salary_raw) <> '')
  LEFT JOIN (SELECT raw_id, map(list(topic), list(meaning)) AS said FROM pay_words GROUP BY raw_id) USING (raw_id)
  LEFT JOIN (SELECT raw_id, CAST(arg_min(mark, i) FILTER (is_number) AS DOUBLE) AS first_number, CAST(arg_min(mark, i) FILTER (is_number AND after_sign) AS DOUBLE) AS top_number
    FROM pay_marks GROUP BY raw_id) USING (raw_id))""",
    "companies": r"""
SELECT DISTINCT dense_rank() OVER (ORDER BY key) AS company_key, max(name) OVER same AS company_name, key AS company_lower,
  array_to_string(regexp_split_to_array(lower(max(name) OVER same), '\s+'), '-') AS company_slug,
  min(day) OVER same AS first_seen_at, max(day) OVER same AS last_seen_at, count(*) OVER same AS total_postings
FROM (SELECT trim(company) AS name, lower(trim(company)) AS key, CAST(scraped_at AS DATE) AS day FROM jobs) WHERE key <> '' WINDOW same AS (PARTITION BY key)""",
    "locations": f"""
SELECT location_key, location_raw, city, (SELECT max(province) FROM ({REGIONS}) r WHERE lower(r.city) = lower(p.city)) AS province,
  (SELECT max(region) FROM ({REGIONS}) r WHERE lower(r.city) = lower(p.city)) AS region, is_remote,
  EXISTS (SELECT 1 FROM ({REGIONS}) r WHERE lower(r.city) = lower(p.city) AND r.is_ncr) AS is_metro_manila
FROM (
  SELECT location_key, location_raw, coalesce((SELECT arg_min(city, place) FROM ({PLACE_WORDS}) w WHERE city <> 'remote' AND regexp_matches(lower(location_raw), word)), trim(location_raw)) AS city,
    (SELECT count(*) > 0 FROM ({PLACE_WORDS}) w WHERE city = 'remote' AND regexp_matches(lower(location_raw), word)) AS is_remote
  FROM (SELECT DISTINCT dense_rank() OVER (ORDER BY location_raw) AS location_key, location_raw FROM jobs WHERE trim(location_raw) <> '')) p""",
    "skills": f"""
SELECT row_number() OVER (ORDER BY name) AS skill_key, name AS skill_name, max(category) AS skill_category
FROM ({TERMS}) t GROUP BY name""",
    "fact": """
SELECT raw_id AS job_key, source, source_id, title, description, url, employment_type, experience_level,
  (SELECT company_key FROM companies WHERE company_lower = lower(trim(company))) AS company_key, spot.location_key AS location_key,
  CAST(10000 * year(day) + 100 * month(day) + day(day) AS BIGINT) AS date_posted_key, CAST(10000 * year(seen) + 100 * month(seen) + day(seen) AS BIGINT) AS date_scraped_key,
  pay.salary_min AS salary_min, pay.salary_max AS salary_max, coalesce(pay.salary_currency, 'PHP') AS salary_currency, pay.salary_period AS salary_period,
  CASE WHEN is_remote IS NOT NULL THEN is_remote ELSE spot IS NOT NULL AND spot.is_remote END AS is_remote
FROM (SELECT jobs.*, CAST(scraped_at AS DATE) AS seen, coalesce(posted_date, CAST(scraped_at AS DATE)) AS day,
  (SELECT locations FROM locations WHERE locations.location_raw = jobs.location_raw) AS spot, (SELECT sal FROM sal WHERE sal.raw_id = jobs.raw_id) AS pay FROM jobs)""",
}


def _found(text: str, pattern: str, boundary: str = "strict") -> str:
    return f"regexp_matches({text}, {_q(f'(^|{NOT_WORD})({pattern})({NOT_WORD}|$)')}, 'i')"


def _ends_in_sign(pattern: str) -> bool:
    return pattern[-1] in "+#" or pattern[0] in "+#."


def _matches(boundary: str) -> str:
    parts = []
    for pattern, name, category in SKILL_ROWS:
        if boundary == "strict" and _ends_in_sign(pattern):
            continue
        hit = " OR ".join(f"coalesce({_found(c, pattern)}, false)" for c in ("title", "description", "skills_json"))
        parts.append(f"SELECT raw_id, source, source_id, {_q(name)} AS skill_name, {_q(category)} AS skill_category FROM jobs WHERE {hit}")
    return "SELECT DISTINCT * FROM (" + " UNION ALL ".join(parts) + ")"


STEPS["matches"] = _matches("strict")
STEPS["matches_loose"] = _matches("loose")
STEPS["demand"] = """
SELECT row_number() OVER (ORDER BY snapshot_date, skill_key, source) AS id, * FROM (
  SELECT CAST(j.scraped_at AS DATE) AS snapshot_date, k.skill_key, j.source, count(DISTINCT j.raw_id) AS posting_count,
    avg(s.salary_min) AS avg_salary_min, avg(s.salary_max) AS avg_salary_max
  FROM matches m JOIN jobs j ON m.raw_id = j.raw_id AND m.source = j.source
  JOIN skills k ON m.skill_name = k.skill_name LEFT JOIN sal s ON j.raw_id = s.raw_id
  GROUP BY 1, 2, 3)"""
STEPS["listed"] = """
SELECT p.job_key, p.source, p.title, p.description, c.company_name, l.city, l.region, p.salary_min, p.salary_max,
  p.salary_currency, p.salary_period, p.employment_type, p.experience_level, p.is_remote, p.date_posted_key, p.url
FROM fact p LEFT JOIN companies c ON p.company_key = c.company_key LEFT JOIN locations l ON p.location_key = l.location_key"""
STEPS["shown"] = """
SELECT d.id, CAST(d.snapshot_date AS VARCHAR) AS snapshot_date, k.skill_name, k.skill_category, d.posting_count,
  d.avg_salary_min, d.avg_salary_max, d.source
FROM demand d LEFT JOIN skills k ON d.skill_key = k.skill_key"""

NEEDS = {
    "f": [],
    "staged": ["f"],
    "ranked": ["staged"],
    "jobs": ["ranked"],
    "pay_marks": ["jobs"],
    "pay_words": ["jobs"],
    "sal": ["pay_marks", "pay_words"],
    "companies": ["jobs"],
    "locations": ["jobs"],
    "skills": [],
    "fact": ["jobs", "sal", "companies", "locations"],
    "matches": ["jobs"],
    "matches_loose": ["jobs"],
    "demand": ["matches", "skills", "sal"],
    "listed": ["fact"],
    "shown": ["demand"],
}


def _with(body: str, *steps: str) -> str:
    wanted: list[str] = []

    def visit(step: str) -> None:
        for need in NEEDS[step]:
            visit(need)
        if step not in wanted:
            wanted.append(step)

    for step in steps:
        visit(step)
    ctes = ",\n".join(f"{s} AS MATERIALIZED ({STEPS[s]})" for s in wanted)
    return f"WITH {ctes}\n{body}" if ctes else body  # a body that starts with a comma adds its own steps


def oracle(name: str, body: str, *steps: str) -> None:
    ORACLES[name] = _with(body, *steps)


# Staging, union, dedup

_HEAD = "raw_id, source, source_id, CAST(scraped_at AS VARCHAR) AS scraped_at"
_BASE = f"{_HEAD}, title, salary_raw, url, CAST(posted_date AS VARCHAR) AS posted_date, employment_type"
_CANONICAL = f"""{_HEAD}, title, company, location_raw, salary_raw, salary_currency, url,
  CAST(posted_date AS VARCHAR) AS posted_date, description, employment_type, experience_level, is_remote, skills_json"""
oracle(
    "stage_philjobnet",
    f"SELECT {_BASE}, company, location_raw, description, lower(trim(e)) AS education_level FROM staged"
    " JOIN (SELECT raw_id AS i, education_level AS e FROM f) x ON i = raw_id WHERE source = 'philjobnet'",
    "staged",
)
oracle("stage_kalibrr", f"SELECT {_BASE}, company, location_raw, description, experience_level, skills_json FROM staged WHERE source = 'kalibrr'", "staged")
oracle("stage_jobstreet", f"SELECT {_BASE}, company, location_raw, description FROM staged WHERE source = 'jobstreet'", "staged")
oracle("stage_onlinejobs", f"SELECT {_BASE}, salary_currency, is_remote FROM staged WHERE source = 'onlinejobs'", "staged")
oracle("stage_indeed", f"SELECT {_BASE}, company, location_raw FROM staged WHERE source = 'indeed'", "staged")
oracle("unify", f"SELECT {_CANONICAL} FROM staged", "staged")
oracle("stage_all", f"SELECT {_CANONICAL} FROM staged", "staged")
oracle("rank_duplicates", "SELECT raw_id, source, source_id, rn FROM ranked", "ranked")
oracle("dedup_latest", f"SELECT {_CANONICAL} FROM jobs", "jobs")
oracle(
    "event_props",
    "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, count(json_extract_string(props, '$.k')) AS k_rows FROM events GROUP BY 1",
)

# Salaries

oracle("salary_parse", "SELECT * FROM sal", "sal")
oracle(
    "salary_simple",
    r"""
, cleaned AS (SELECT raw_id, lower(trim(salary_raw)) AS t,
    regexp_extract_all(regexp_replace(regexp_replace(lower(trim(salary_raw)), '[₱$]', '', 'g'), '\b(php|usd)\b', '', 'g'), '\d+(,\d{3})*(\.\d+)?(k\b)?') AS n FROM f),
numbers AS (SELECT raw_id, t, list_transform(n, lambda x: CAST(round_even(CAST(replace(replace(x, ',', ''), 'k', '') AS DOUBLE) * CASE WHEN ends_with(x, 'k') THEN 1000 ELSE 1 END, 0) AS BIGINT)) AS v FROM cleaned)
SELECT raw_id, least(v[1], coalesce(v[2], v[1])) AS simple_min, greatest(v[1], coalesce(v[2], v[1])) AS simple_max,
  CASE WHEN len(v) > 0 THEN CASE WHEN contains(t, '₱') OR contains(t, 'php') THEN 'PHP' WHEN contains(t, '$') OR contains(t, 'usd') OR contains(t, 'dollar') THEN 'USD' ELSE 'PHP' END END AS simple_currency,
  CASE WHEN len(v) > 0 THEN CASE WHEN regexp_matches(t, 'annual|yearly|per year|/year|yr') THEN 'annual' ELSE 'monthly' END END AS simple_period
FROM numbers""",
    "f",
)
_BUCKET = """CASE WHEN salary_min IS NULL THEN 'Not disclosed' WHEN salary_min < 15000 THEN 'Below ₱15K' WHEN salary_min < 25000 THEN '₱15K-25K'
  WHEN salary_min < 40000 THEN '₱25K-40K' WHEN salary_min < 60000 THEN '₱40K-60K' WHEN salary_min < 80000 THEN '₱60K-80K'
  WHEN salary_min < 100000 THEN '₱80K-100K' WHEN salary_min < 150000 THEN '₱100K-150K' ELSE '₱150K+' END"""
oracle("salary_bucket", f"SELECT raw_id, {_BUCKET} AS bucket FROM sal", "sal")


def _monthly(column: str) -> str:
    factor = "CASE salary_period WHEN 'hourly' THEN 176.0 WHEN 'daily' THEN 22.0 WHEN 'yearly' THEN CAST(1 AS DOUBLE) / 12 ELSE 1.0 END"
    return f"CASE WHEN {column} <> 0 THEN {column} * CAST({factor} AS DOUBLE) * CAST(CASE WHEN salary_currency = 'USD' THEN 56 ELSE 1 END AS DOUBLE) END"


oracle("salary_monthly", f"SELECT raw_id, round({_monthly('salary_min')}, 2) AS monthly_min, round({_monthly('salary_max')}, 2) AS monthly_max FROM sal", "sal")

# Skills

oracle("skill_match", "SELECT * FROM matches", "matches")
oracle("skill_match_loose", "SELECT * FROM matches_loose", "matches_loose")
_DOCS = "SELECT DISTINCT * FROM (" + " UNION ALL ".join(
    f"SELECT doc_id, {_q(name)} AS skill_name, {_q(category)} AS skill_category FROM documents WHERE {_found('text', pattern)}"
    for pattern, name, category in DOCUMENT_TERMS
) + ")"
oracle("term_match_documents", _DOCS)
oracle("term_match_documents_joined", _DOCS)
oracle("job_skill_bridge", "SELECT m.raw_id AS job_key, k.skill_key FROM matches m JOIN skills k ON m.skill_name = k.skill_name", "matches", "skills")

# Dimensions and facts

oracle(
    "dim_company",
    "SELECT company_key, company_name, company_lower, company_slug, CAST(first_seen_at AS VARCHAR) AS first_seen_at, CAST(last_seen_at AS VARCHAR) AS last_seen_at, total_postings FROM companies",
    "companies",
)
oracle("dim_location", "SELECT * FROM locations", "locations")
oracle(
    "dim_skill_usage",
    "SELECT k.skill_key, k.skill_name, k.skill_category, CAST(sum(d.posting_count) AS BIGINT) AS postings FROM skills k LEFT JOIN demand d ON k.skill_key = d.skill_key GROUP BY 1, 2, 3",
    "demand",
)
oracle(
    "skill_list",
    """SELECT skill_key, skill_name, skill_category, (SELECT CAST(sum(posting_count) AS BIGINT) FROM demand d WHERE d.skill_key = k.skill_key) AS postings
FROM skills k WHERE skill_name ILIKE '%a%' ORDER BY skill_name, skill_key LIMIT 10 OFFSET 10""",
    "demand",
)
oracle(
    "read_raw",
    "SELECT source, count(*) AS postings, count(DISTINCT source_id) AS ids, CAST(max(scraped_at) AS VARCHAR) AS newest, count(*) AS payloads FROM f GROUP BY 1",
    "f",
)
oracle(
    "read_raw_damaged",
    """SELECT CASE WHEN raw_id % 50 = 1 OR raw_id % 70 = 3 THEN 'unreadable' WHEN raw_id % 60 = 2 THEN 'incomplete' ELSE source END AS source, count(*) AS rows,
  max(raw_id) FILTER (raw_id % 50 <> 1 AND raw_id % 70 <> 3 AND raw_id % 60 <> 2) AS last_id FROM f GROUP BY 1""",
    "f",
)
_DAY = "CAST(strptime(CAST(date_posted_key AS VARCHAR), '%Y%m%d') AS DATE)"
_CAL = f"""SELECT date_posted_key AS date_key, CAST(d AS VARCHAR) AS full_date, isodow(d) AS day_of_week, dayname(d) AS day_name,
  month(d) AS month, monthname(d) AS month_name, quarter(d) AS quarter, year(d) AS year, isodow(d) IN (6, 7) AS is_weekend,
  day(d) AS day, weekofyear(d) AS week_of_year, postings
FROM (SELECT date_posted_key, {_DAY} AS d, count(*) AS postings FROM fact GROUP BY 1, 2)"""
# The calendar reaches over all posted days, and over 2024 to 2027 at least.
_SPAN = f"""SELECT d FROM (SELECT unnest(range(least(DATE '2024-01-01', min(day)), greatest(DATE '2028-01-01', max(day) + 1), INTERVAL 1 DAY)) AS d
  FROM (SELECT {_DAY} AS day FROM fact))"""
oracle(
    "dim_date_usage",
    f"""SELECT CAST(strftime(c.d, '%Y%m%d') AS BIGINT) AS date_key, CAST(CAST(c.d AS DATE) AS VARCHAR) AS full_date, isodow(c.d) AS day_of_week, dayname(c.d) AS day_name,
  month(c.d) AS month, monthname(c.d) AS month_name, quarter(c.d) AS quarter, year(c.d) AS year, isodow(c.d) IN (6, 7) AS is_weekend,
  day(c.d) AS day, weekofyear(c.d) AS week_of_year, n.postings
FROM ({_SPAN}) c LEFT JOIN (SELECT date_posted_key, count(*) AS postings FROM fact GROUP BY 1) n ON n.date_posted_key = CAST(strftime(c.d, '%Y%m%d') AS BIGINT)""",
    "fact",
)
oracle("fact_posting", "SELECT * FROM fact", "fact")
oracle("fact_posting_skew_safe", "SELECT * FROM fact", "fact")
oracle(
    "fact_skill_demand",
    "SELECT id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, skill_key, source, posting_count, avg_salary_min, avg_salary_max FROM demand",
    "demand",
)
oracle(
    "fact_skill_demand_monthly_php",
    f"""SELECT d.id, CAST(d.snapshot_date AS VARCHAR) AS snapshot_date, d.skill_key, d.source, d.posting_count, round(lo, 2) AS avg_salary_min, round(hi, 2) AS avg_salary_max
FROM demand d JOIN (SELECT CAST(j.scraped_at AS DATE) AS day, k.skill_key, j.source, avg({_monthly('s.salary_min').replace('salary_period', 's.salary_period').replace('salary_currency', 's.salary_currency')}) AS lo,
    avg({_monthly('s.salary_max').replace('salary_period', 's.salary_period').replace('salary_currency', 's.salary_currency')}) AS hi
  FROM matches m JOIN jobs j ON m.raw_id = j.raw_id JOIN skills k ON m.skill_name = k.skill_name LEFT JOIN sal s ON j.raw_id = s.raw_id GROUP BY 1, 2, 3) n
ON d.snapshot_date = n.day AND d.skill_key = n.skill_key AND d.source = n.source""",
    "demand",
)
oracle(
    "snapshot_append",
    "SELECT strftime(snapshot_date, '%Y-%m') AS month, count(*) AS rows, CAST(sum(posting_count) AS BIGINT) AS postings FROM demand GROUP BY 1",
    "demand",
)
oracle(
    "warehouse_build",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {step}"
        for name, step in (("dim_companies", "companies"), ("dim_locations", "locations"), ("dim_skills", "skills"), ("fct_job_postings", "fact"), ("fct_skill_demand", "demand"))
    )
    + f" UNION ALL SELECT 'dim_date', count(*) FROM ({_SPAN})",
    "fact",
    "demand",
)

# Analytics

_PESO = "salary_min IS NOT NULL AND salary_currency = 'PHP' AND salary_period = 'monthly'"
_MEANS = "avg(salary_min) AS avg_salary_min, avg(salary_max) AS avg_salary_max, count(*) AS job_count"
oracle(
    "dashboard_summary",
    f"""SELECT count(*) AS total_jobs, count(salary_min) AS jobs_with_salary, count(*) FILTER (is_remote) AS remote_jobs,
  count(DISTINCT source) AS active_sources,
  CAST(round_even(coalesce(avg(salary_min) FILTER ({_PESO}), 0), 0) AS BIGINT) AS avg_salary_min_php,
  CAST(round_even(coalesce(avg(salary_max) FILTER ({_PESO}), 0), 0) AS BIGINT) AS avg_salary_max_php FROM fact""",
    "fact",
)
_CITY = f"SELECT l.city, l.region, {_MEANS} FROM fact p JOIN locations l ON p.location_key = l.location_key WHERE {_PESO} GROUP BY 1, 2 HAVING count(*) >= 5"
oracle("salary_by_city", _CITY, "fact")
oracle("salary_by_city_chart", f"{_CITY} ORDER BY avg_salary_min DESC NULLS FIRST, city, region LIMIT 12", "fact")
oracle(
    "salary_by_experience",
    f"SELECT experience_level, {_MEANS} FROM fact WHERE salary_min IS NOT NULL AND experience_level IS NOT NULL AND salary_currency = 'PHP' GROUP BY 1",
    "fact",
)
oracle("salary_by_source", f"SELECT source, {_MEANS}, {SOURCE_LABEL} AS label FROM fact WHERE {_PESO} GROUP BY source", "fact")
oracle("jobs_by_source", f"SELECT source, count(*) AS count, {SOURCE_LABEL} AS label FROM fact GROUP BY source", "fact")
oracle(
    "remote_vs_onsite",
    "SELECT r AS remote, n - r AS onsite, n AS total, CASE WHEN n > 0 THEN round_even(r / n * 100, 1) ELSE 0 END AS remote_percentage FROM (SELECT count(*) FILTER (is_remote) AS r, count(*) AS n FROM fact)",
    "fact",
)
oracle("city_facet", "SELECT DISTINCT city FROM locations WHERE city IS NOT NULL AND city <> ''", "locations")
oracle("postings_per_week", f"SELECT CAST(CAST(date_trunc('week', {_DAY}) AS DATE) AS VARCHAR) AS week_start, count(*) AS postings FROM fact GROUP BY 1", "fact")
oracle("salary_histogram", f"SELECT {_BUCKET} AS bucket, count(*) AS postings FROM fact GROUP BY 1", "fact")
oracle(
    "postings_by_calendar",
    f"""SELECT year, quarter, month, month_name, is_weekend, CAST(sum(postings) AS BIGINT) AS postings FROM (
  SELECT f.postings, c.year, c.quarter, c.month, c.month_name, c.is_weekend FROM (SELECT date_posted_key, count(*) AS postings FROM fact GROUP BY 1) f
  LEFT JOIN ({_CAL}) c ON f.date_posted_key = c.date_key) GROUP BY 1, 2, 3, 4, 5""",
    "fact",
)
_TREND = "SELECT snapshot_date, skill_name, posting_count, avg_salary_min, avg_salary_max FROM shown"
oracle(
    "skill_trends_reference",
    f"{_TREND} WHERE skill_name IN (SELECT skill_name FROM (SELECT DISTINCT skill_name, posting_count FROM shown ORDER BY posting_count DESC, skill_name LIMIT 10))",
    "shown",
)
oracle(
    "skill_trends_names",
    f"{_TREND} WHERE skill_name IN (SELECT skill_name FROM shown GROUP BY 1 ORDER BY max(posting_count) DESC, skill_name LIMIT 10)",
    "shown",
)
oracle("skill_trends_by_name", f"{_TREND} WHERE skill_name ILIKE '%java%'", "shown")
_TOP = "SELECT * FROM shown WHERE {where} ORDER BY posting_count DESC, id LIMIT {limit}"
oracle("top_skills_reference", _TOP.format(where="snapshot_date = (SELECT snapshot_date FROM shown ORDER BY posting_count DESC, snapshot_date DESC LIMIT 1)", limit=20), "shown")
oracle("top_skills_latest", _TOP.format(where="snapshot_date = (SELECT max(snapshot_date) FROM shown)", limit=20), "shown")
oracle(
    "top_skills_of_source",
    _TOP.format(
        where="source = 'kalibrr' AND snapshot_date = (SELECT snapshot_date FROM shown WHERE source = 'kalibrr' ORDER BY posting_count DESC, snapshot_date DESC LIMIT 1)",
        limit=10,
    ),
    "shown",
)
oracle(
    "skill_summary",
    """SELECT skill_name, skill_category, CAST(sum(posting_count) AS BIGINT) AS demand,
  round(sum(avg_salary_min * posting_count) / sum(posting_count) FILTER (avg_salary_min IS NOT NULL), 2) AS avg_salary_min,
  round(sum(avg_salary_max * posting_count) / sum(posting_count) FILTER (avg_salary_max IS NOT NULL), 2) AS avg_salary_max
FROM shown GROUP BY 1, 2""",
    "shown",
)

# Search

_LIST = "SELECT * EXCLUDE (description) FROM listed"
_DEFAULT_ORDER = "ORDER BY date_posted_key DESC NULLS FIRST, job_key"
oracle(
    "search_facets",
    f"{_LIST} WHERE city ILIKE '%makati%' AND upper(salary_currency) = 'PHP' AND salary_min >= 20000 AND NOT is_remote AND employment_type ILIKE '%time%' {_DEFAULT_ORDER} LIMIT 500",
    "listed",
)
oracle(
    "search_facets_more",
    f"{_LIST} WHERE upper(source) = 'KALIBRR' AND region ILIKE '%ncr%' AND experience_level ILIKE '%enior%' AND salary_max <= 90000 AND company_name ILIKE '%0001%' {_DEFAULT_ORDER} LIMIT 500",
    "listed",
)


def _term(term: str) -> str:
    return f"(title ILIKE '%{term}%' OR description ILIKE '%{term}%' OR company_name ILIKE '%{term}%')"


oracle("search_text", f"{_LIST} WHERE {_term('developer')} AND {_term('python')} {_DEFAULT_ORDER} LIMIT 2000", "listed")
oracle("search_page_3", f"{_LIST} {_DEFAULT_ORDER} LIMIT 25 OFFSET 50", "listed")
oracle("search_by_salary", f"{_LIST} ORDER BY salary_max DESC NULLS FIRST, company_name ASC NULLS LAST, job_key LIMIT 50 OFFSET 50", "listed")
oracle("search_by_salary_up", f"{_LIST} ORDER BY salary_min ASC NULLS LAST, job_key LIMIT 50", "listed")
_BY_COMPANY = "ORDER BY company_name ASC NULLS LAST"
oracle("search_by_company", f"{_LIST} {_BY_COMPANY}, job_key LIMIT 40 OFFSET 80", "listed")
oracle("search_by_company_down", f"{_LIST} WHERE {_term('engineer')} ORDER BY company_name DESC NULLS FIRST, salary_min ASC NULLS LAST, job_key LIMIT 60", "listed")
oracle("search_by_salary_min_down", f"{_LIST} WHERE city ILIKE '%makati%' ORDER BY salary_min DESC NULLS FIRST, job_key LIMIT 30 OFFSET 30", "listed")
oracle("search_after_date", f"{_LIST} {_DEFAULT_ORDER} LIMIT 25 OFFSET 50", "listed")
oracle("search_after_salary", f"{_LIST} ORDER BY salary_max DESC NULLS FIRST, company_name ASC NULLS LAST, job_key LIMIT 300 OFFSET 300", "listed")
oracle("search_after_company", f"{_LIST} WHERE source = 'kalibrr' {_BY_COMPANY}, salary_min DESC NULLS FIRST, job_key LIMIT 40 OFFSET 80", "listed")
oracle("search_total", f"SELECT count(*) AS total FROM listed WHERE {_term('engineer')}", "listed")
oracle("page_after", f"{_LIST} WHERE date_posted_key < 20290101 OR (date_posted_key = 20290101 AND job_key > 0) {_DEFAULT_ORDER} LIMIT 40", "listed")
oracle("job_list", _LIST, "listed")
oracle(
    "job_detail",
    """SELECT p.job_key, p.source, p.title, c.company_name, c.company_slug, c.total_postings, l.city, l.is_metro_manila
FROM fact p LEFT JOIN companies c ON p.company_key = c.company_key LEFT JOIN locations l ON p.location_key = l.location_key
WHERE p.job_key = (SELECT max(job_key) FROM fact)""",
    "fact",
)
oracle(
    "company_list",
    """SELECT company_key, company_name, company_slug, CAST(first_seen_at AS VARCHAR) AS first_seen_at, CAST(last_seen_at AS VARCHAR) AS last_seen_at, total_postings
FROM companies WHERE (company_name ILIKE '%customer%' OR company_slug ILIKE '%customer%') AND (company_name ILIKE '%00%' OR company_slug ILIKE '%00%')
ORDER BY total_postings DESC, company_key LIMIT 25 OFFSET 25""",
    "companies",
)
oracle("location_list", "SELECT * FROM locations WHERE is_metro_manila AND region = 'NCR' ORDER BY region, city, location_key LIMIT 25", "locations")
oracle("skill_demand_list", "SELECT * FROM shown", "shown")

# Labels

_MONEY = "(CASE WHEN salary_currency = 'USD' THEN '$' ELSE '₱' END || format('{{:,}}', CAST({0} AS BIGINT)))"
_LOW, _HIGH = _MONEY.format("salary_min"), _MONEY.format("salary_max")
oracle(
    "label_postings",
    f"""SELECT job_key,
  CASE WHEN salary_min <> 0 AND salary_max <> 0 THEN {_LOW} || ' – ' || {_HIGH} WHEN salary_min <> 0 THEN {_LOW} WHEN salary_max <> 0 THEN {_HIGH} ELSE 'Negotiable' END AS salary_label,
  strftime({_DAY}, '%B %-d, %Y') AS date_label,
  CASE WHEN employment_type IS NULL THEN NULL WHEN contains(employment_type, 'full') THEN 'fulltime' WHEN contains(employment_type, 'part') THEN 'parttime'
    WHEN contains(employment_type, 'permanent') THEN 'permanent' WHEN contains(employment_type, 'contract') THEN 'contract'
    WHEN regexp_matches(employment_type, 'freelance|gig') THEN 'freelance' WHEN regexp_matches(employment_type, 'intern|ojt') THEN 'internship'
    WHEN contains(employment_type, 'project') THEN 'project' ELSE 'other' END AS employment_bucket,
  list_aggregate(list_transform(list_filter(string_split_regex(regexp_replace(employment_type, '\\+\\d+$', ''), '[\\s/-]+'), lambda w: w <> ''), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS employment_label,
  {SOURCE_LABEL} AS source_label FROM fact""",
    "fact",
)
oracle("label_money", f"SELECT source, '₱' || format('{{:,}}', CAST(round(avg(salary_min), 0) AS BIGINT)) AS money_label FROM fact WHERE {_PESO} GROUP BY 1", "fact")

# Quality


def _check(table: str, column: str | None, kind: str, failed: str, frm: str) -> str:
    return f"""SELECT '{table}' AS "table", {_q(column)} AS "column", '{kind}' AS "check", CAST(x AS BIGINT) AS failed_rows, x = 0 AS passed FROM (SELECT {failed} AS x FROM {frm})"""


def _nulls(table, frm, *columns):
    return [_check(table, c, "not_null", f"count(*) - count({c})", frm) for c in columns]


def _uniques(table, frm, *columns):
    return [_check(table, c, "unique", f"count({c}) - count(DISTINCT {c})", frm) for c in columns]


def _relation(table, frm, column, ref, ref_step):
    return _check(
        table, column, f"relationship:{ref}", f"count(*) FILTER ({column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {ref_step}))", frm
    )


_SITES = "('philjobnet', 'kalibrr', 'jobstreet', 'onlinejobs', 'indeed', 'facebook')"
_CALENDAR = "(SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date FROM (SELECT range AS d FROM range(DATE '2024-01-01', DATE '2028-01-01', INTERVAL 1 DAY)))"
_RAW_CHECKS = [
    _check("raw_job_postings", None, "row_count", "greatest(1 - count(*), 0)", "f"),
    *_nulls("raw_job_postings", "f", "source", "source_id", "scraped_at"),
    _check("raw_job_postings", "raw_data", "not_null", "count(*) - count(*)", "f"),
    _check("raw_job_postings", "source", "accepted_values", f"count(*) FILTER (source NOT IN {_SITES})", "f"),
    _check("raw_job_postings", "scraped_at", "fresh", "count(*) FILTER (scraped_at NOT BETWEEN TIMESTAMP '2030-08-01' - INTERVAL 7 DAY AND TIMESTAMP '2030-08-01')", "f"),
]
_CHECKS = [
    *_nulls("dim_companies", "companies", "company_key", "company_name", "company_lower"),
    *_uniques("dim_companies", "companies", "company_key", "company_lower"),
    *_nulls("dim_locations", "locations", "location_key", "location_raw"),
    *_uniques("dim_locations", "locations", "location_key", "location_raw"),
    *_nulls("dim_skills", "skills", "skill_key", "skill_name"),
    *_uniques("dim_skills", "skills", "skill_key", "skill_name"),
    *_nulls("dim_date", _CALENDAR, "date_key", "full_date"),
    *_uniques("dim_date", _CALENDAR, "date_key", "full_date"),
    *_nulls("fct_skill_demand", "demand", "id", "skill_key", "posting_count"),
    *_uniques("fct_skill_demand", "demand", "id"),
    _relation("fct_skill_demand", "demand", "skill_key", "dim_skills", "skills"),
    _check("fct_job_postings", None, "row_count", "greatest(1000 - count(*), 0)", "fact"),
    *_nulls("fct_job_postings", "fact", "job_key", "source", "title"),
    *_uniques("fct_job_postings", "fact", "job_key"),
    _check("fct_job_postings", "source", "accepted_values", f"count(*) FILTER (source NOT IN {_SITES})", "fact"),
    _check("fct_job_postings", "salary_currency", "accepted_values", "count(*) FILTER (salary_currency NOT IN ('PHP', 'USD'))", "fact"),
    _check("fct_job_postings", "salary_min", "accepted_range", "count(*) FILTER (salary_min NOT BETWEEN 0 AND 10000000)", "fact"),
    _check("fct_job_postings", "salary_max", "accepted_range", "count(*) FILTER (salary_max NOT BETWEEN 0 AND 10000000)", "fact"),
    _check("fct_job_postings", "date_posted_key", "accepted_range", "count(*) FILTER (date_posted_key // 10000 NOT BETWEEN 1970 AND 2100)", "fact"),
    _check("fct_job_postings", "salary_max", "ordered", "count(*) FILTER (salary_max < salary_min)", "fact"),
    _relation("fct_job_postings", "fact", "company_key", "dim_companies", "companies"),
    _relation("fct_job_postings", "fact", "location_key", "dim_locations", "locations"),
]
oracle("dq_warehouse", " UNION ALL ".join(_CHECKS + _RAW_CHECKS), "fact", "demand")
_SPOILT = ("title", "source", "salary_currency", "salary_min", "salary_max", "company_key", "location_key", "date_posted_key", "job_key")
_DAMAGED = f"(SELECT * REPLACE ({', '.join(f'{damaged_sql(c)} AS {c}' for c in _SPOILT)}) FROM fact)"
oracle(
    "dq_damaged",
    " UNION ALL ".join(c.replace("FROM fact)", f"FROM {_DAMAGED})").replace("greatest(1000 -", "greatest(10000000 -") for c in _CHECKS if "'fct_job_postings'" in c),
    "fact",
)
# Column, kind and condition of the checks that a row decides, in the suite's order.
_WRONG = (
    ("job_key", "not_null", "job_key IS NULL"),
    ("source", "not_null", "source IS NULL"),
    ("title", "not_null", "title IS NULL"),
    ("source", "accepted_values", f"source NOT IN {_SITES}"),
    ("salary_currency", "accepted_values", "salary_currency NOT IN ('PHP', 'USD')"),
    ("salary_min", "accepted_range", "salary_min NOT BETWEEN 0 AND 10000000"),
    ("salary_max", "accepted_range", "salary_max NOT BETWEEN 0 AND 10000000"),
    ("date_posted_key", "accepted_range", "date_posted_key // 10000 NOT BETWEEN 1970 AND 2100"),
    ("salary_max", "ordered", "salary_max < salary_min"),
)
oracle(
    "dq_offenders",
    f", d AS {_DAMAGED} "
    + " UNION ALL ".join(
        f"""SELECT 'fct_job_postings' AS "table", '{c}' AS "column", '{k}' AS "check", count(*) AS failed_rows, min(job_key) AS first_key, max(job_key) AS last_key FROM d WHERE {w}"""
        for c, k, w in _WRONG
    ),
    "fact",
)
_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {w} THEN '{c}:{k}' END" for c, k, w in _WRONG) + ")"
oracle("dq_quarantine", f"SELECT reasons, count(*) AS rows, min(source_id) AS least_id FROM (SELECT source_id, {_REASONS} AS reasons FROM {_DAMAGED}) GROUP BY reasons", "fact")
oracle("dq_salary_range_damaged", f"SELECT job_key, salary_min, salary_max FROM {_DAMAGED} WHERE salary_max < salary_min", "fact")
oracle("dq_salary_range", "SELECT job_key, salary_min, salary_max FROM fact WHERE salary_max < salary_min", "fact")
oracle("dq_stored_results", " UNION ALL ".join(_RAW_CHECKS), "f")

# Upsert, streaming, run log

_LAST = "arg_max(ts, event_id) AS ts, arg_max(props, event_id) AS props, min(event_id) AS first_id"
oracle(
    "upsert_raw",
    f"""WITH early AS (SELECT event_type, user_id, min(event_id) AS raw_id FROM events WHERE ts < TIMESTAMP '2024-01-04' GROUP BY 1, 2),
late AS (SELECT event_type, user_id, min(event_id) AS first_id FROM events WHERE ts >= TIMESTAMP '2024-01-04' GROUP BY 1, 2),
added AS (SELECT l.event_type, l.user_id, (SELECT max(raw_id) FROM early) + row_number() OVER (ORDER BY first_id) AS raw_id
  FROM late l LEFT JOIN early e ON l.event_type = e.event_type AND l.user_id = e.user_id WHERE e.raw_id IS NULL),
ids AS (SELECT * FROM early UNION ALL SELECT * FROM added),
latest AS (SELECT event_type, user_id, {_LAST} FROM events GROUP BY 1, 2)
SELECT i.raw_id, i.event_type AS source, 'u' || CAST(i.user_id AS VARCHAR) AS source_id, epoch_us(l.ts) AS scraped_us, l.props AS raw_data
FROM ids i JOIN latest l ON i.event_type = l.event_type AND i.user_id = l.user_id""",
)
_UPSERTED = f"""SELECT row_number() OVER (ORDER BY first_id) AS raw_id, event_type AS source, 'u' || CAST(user_id AS VARCHAR) AS source_id, epoch_us(ts) AS scraped_us, props AS raw_data
FROM (SELECT event_type, user_id, {_LAST} FROM events GROUP BY 1, 2)"""
oracle("upsert_stream", _UPSERTED)
oracle("upsert_sink", _UPSERTED)
oracle("upsert_stream_batches", _UPSERTED)
_RUNS = """SELECT event_type AS source, min(event_id) AS id, min(ts) AS started_at, count(*) FILTER (value > 5) AS records_scraped,
  CASE WHEN day(CAST(ts AS DATE)) % 5 = 0 THEN 'error' ELSE 'success' END AS status FROM events GROUP BY CAST(ts AS DATE), event_type"""
oracle("run_log", f"SELECT id, source, records_scraped, status, CASE WHEN status = 'error' THEN 1600 END AS error_length FROM ({_RUNS})")
oracle(
    "run_health",
    f"""SELECT source, count(*) AS runs, epoch_us(max(started_at)) AS last_started_at, arg_max(status, started_at) AS last_status, CAST(sum(records_scraped) AS BIGINT) AS records_total,
  count(*) FILTER (status = 'error') AS failed_runs, count(*) FILTER (records_scraped = 0) AS empty_runs FROM ({_RUNS}) GROUP BY source""",
)

# Payloads

_PAGE_NO = "CAST(floor(raw_id / 50.0) AS BIGINT) AS page_no"
# An element that is there but blank reads as '', one that is not there as NULL.
_TRIMMED = {c: f"trim({c}) AS {c}" for c in ("title", "company", "location", "salary_raw", "description", "employment_type", "posted_date", "education_level")}
_LINKED_TITLE = "coalesce(trim(title), '') AS title"
_R = "CAST(raw_id AS VARCHAR)"
_BOARD_URL = f"'https://ph.jobstreet.com/job/' || {_R} AS url"
oracle(
    "flatten_api",
    f"""SELECT {_PAGE_NO}, 'kalibrr_' || {_R} AS source_id, title, company, location,
  CASE WHEN raw_id % 4 < 2 OR raw_id % 4 <> 0 THEN CASE WHEN raw_id % 5 = 0 THEN 'USD' ELSE 'PHP' END || ' ' ||
    CASE WHEN raw_id % 4 <> 0 THEN CAST(raw_id * 10 AS VARCHAR) ELSE '?' END || '-' || CASE WHEN raw_id % 4 < 2 THEN CAST(raw_id * 20 AS VARCHAR) ELSE '?' END END AS salary_raw,
  description, employment_type, posted_date,
  CASE WHEN raw_id % 2 = 0 THEN 'https://www.kalibrr.com/c/co' || {_R} || '/jobs/' || {_R} ELSE 'https://www.kalibrr.com/jobs/' || {_R} END AS url,
  experience_level, CASE WHEN raw_id % 3 = 0 THEN 'Python|SQL' ELSE '' END AS skills FROM f WHERE raw_id <> 0""",
    "f",
)
_BOARD = f"{_PAGE_NO}, 'jobstreet_' || {_R} AS source_id, title, company, location, salary_raw, description, employment_type, posted_date, {_BOARD_URL}"
oracle("flatten_state", f"SELECT {_BOARD} FROM f WHERE raw_id <> 0", "f")
oracle("flatten_entity_cache", f"SELECT {_BOARD} FROM f WHERE raw_id <> 0 AND raw_id % 4 <> 3", "f")
oracle(
    "flatten_ssr",
    f"SELECT {_BOARD.replace(' location,', chr(32) + 'CASE WHEN raw_id % 2 = 1 THEN ' + _q('Near ') + ' || location ELSE location END AS location,')} FROM f WHERE raw_id <> 0",
    "f",
)
oracle(
    "flatten_cards_philjobnet",
    f"""SELECT {_PAGE_NO}, 'philjobnet_' || {_R} AS source_id, {_TRIMMED['title']}, {_TRIMMED['company']}, {_TRIMMED['location']}, {_TRIMMED['salary_raw']}, CAST(NULL AS VARCHAR) AS description,
  {_TRIMMED['employment_type']}, {_TRIMMED['posted_date']}, 'https://philjobnet.gov.ph/job-vacancies/job/title-' || {_R} AS url, {_TRIMMED['education_level']} FROM f""",
    "f",
)
oracle(
    "flatten_cards_jobstreet",
    f"""SELECT {_PAGE_NO}, 'jobstreet_' || {_R} AS source_id, {_LINKED_TITLE}, {_TRIMMED['company']}, {_TRIMMED['location']}, {_TRIMMED['salary_raw']}, {_TRIMMED['description']},
  CAST(NULL AS VARCHAR) AS employment_type, {_TRIMMED['posted_date']}, {_BOARD_URL}, trim(education_level) AS classification FROM f""",
    "f",
)
_ONLINE_HREF = f"CASE WHEN raw_id % 2 = 0 THEN '/jobseekers/job/some-title-' || {_R} ELSE 'https://www.onlinejobs.ph/jobseekers/job/no_number_' || {_R} || 'x' END"
oracle(
    "flatten_cards_onlinejobs",
    f"""SELECT {_PAGE_NO}, 'onlinejobs_' || CASE WHEN raw_id % 2 = 0 THEN {_R} ELSE md5(h) END AS source_id, {_LINKED_TITLE}, CAST(NULL AS VARCHAR) AS company, CAST(NULL AS VARCHAR) AS location,
  CASE WHEN raw_id % 7 <> 0 THEN nullif(trim(salary_raw), '') END AS salary_raw, CAST(NULL AS VARCHAR) AS description, {_TRIMMED['employment_type']}, coalesce(posted_date, '') AS posted_date,
  CASE WHEN raw_id % 2 = 0 THEN 'https://www.onlinejobs.ph' || h ELSE h END AS url, 'USD' AS salary_currency, true AS is_remote
FROM (SELECT *, {_ONLINE_HREF} AS h FROM f)""",
    "f",
)
oracle(
    "flatten_cards_indeed",
    f"""SELECT {_PAGE_NO}, 'indeed_k' || {_R} AS source_id, {_LINKED_TITLE}, CASE WHEN trim(company) <> '' OR raw_id // 50 % 2 = 1 THEN trim(company) END AS company, {_TRIMMED['location']}, pay AS salary_raw, CAST(NULL AS VARCHAR) AS description,
  CASE WHEN pay IS NULL OR pay <> trim(employment_type) THEN nullif(trim(employment_type), '') END AS employment_type, {_TRIMMED['posted_date']},
  CASE WHEN raw_id % 2 = 0 THEN 'https://ph.indeed.com/rc/clk?jk=k' || {_R} ELSE 'https://ph.indeed.com/viewjob?jk=k' || {_R} END AS url
FROM (SELECT *, coalesce(CASE WHEN raw_id % 3 = 0 THEN nullif(trim(salary_raw), '') END, nullif(trim(employment_type), ''),
  CASE WHEN raw_id % 3 = 0 THEN trim(salary_raw) END) AS pay FROM f)""",
    "f",
)
oracle(
    "first_strategy",
    """SELECT page_no, 'jobstreet_' || CAST(raw_id AS VARCHAR) AS source_id, CASE WHEN page_no % 4 = 3 THEN coalesce(trim(title), '') ELSE title END AS title,
  CASE WHEN page_no % 4 = 3 THEN trim(company) ELSE company END AS company
FROM (SELECT *, CAST(floor(raw_id / 50.0) AS BIGINT) AS page_no FROM f)
WHERE (page_no % 4 <> 1 OR raw_id % 4 <> 3) AND (raw_id <> 0 OR page_no % 4 = 3)""",
    "f",
)
_LINKS = r"""SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS href,
  unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS label FROM pages"""
_HASH_ID = r"coalesce(nullif(regexp_extract({0}, '-(\d+)/*$', 1), ''), md5({0}))"
oracle("page_links", f"SELECT page_id, trim(label) AS label, href, 'link_' || {_HASH_ID.format('href')} AS link_id FROM ({_LINKS})")
oracle("page_source_id", f"SELECT page_id, 'page_' || {_HASH_ID.format('url')} AS source_id FROM pages")
oracle(
    "page_class",
    r"""SELECT page_id, contains(lower(url), 'captcha') OR contains(lower(url), 'challenge') OR regexp_matches(html, '\sid=["'']captcha-container["'']') AS is_blocked,
  contains(url, '/login') OR contains(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), 'sign in') AS is_login FROM pages""",
)
oracle(
    "dedup_run",
    """WITH seen AS (SELECT event_type, dayofyear(ts) AS page_no, user_id, event_id FROM events),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY page_no, event_id) AS rn FROM seen) WHERE rn = 1),
stops AS (SELECT event_type, min(page_no) AS stop FROM (SELECT DISTINCT event_type, page_no FROM seen) p
  WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.event_type = p.event_type AND f.page_no = p.page_no) GROUP BY 1)
SELECT f.event_type, f.page_no, f.user_id, f.event_id FROM firsts f LEFT JOIN stops s ON f.event_type = s.event_type WHERE s.stop IS NULL OR f.page_no < s.stop""",
)


def _term_steps(term: int) -> str:
    """Three steps for one search term; ids kept by the terms before it are known."""
    known = "".join(f" AND NOT EXISTS (SELECT 1 FROM kept{t} k WHERE k.event_type = s.event_type AND k.user_id = s.user_id)" for t in range(term))
    return f"""
asked{term} AS (SELECT * FROM seen WHERE third = {term}),
new{term} AS (SELECT * FROM asked{term} s WHERE true{known} QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY page_no, event_id) = 1),
old{term} AS (SELECT event_type, page_no FROM (SELECT event_type, page_no, row_number() OVER (PARTITION BY event_type ORDER BY page_no) AS place
    FROM (SELECT DISTINCT event_type, page_no FROM asked{term})) WHERE place > 1 EXCEPT SELECT event_type, page_no FROM new{term}),
kept{term} AS (SELECT * FROM new{term} n WHERE NOT EXISTS (SELECT 1 FROM old{term} o WHERE o.event_type = n.event_type AND o.page_no <= n.page_no))"""


oracle(
    "dedup_run_terms",
    f"""WITH seen AS (SELECT event_type, hour(ts) // 8 AS third, dayofyear(ts) AS page_no, user_id, event_id FROM events),{",".join(map(_term_steps, range(3)))}
SELECT * FROM kept0 UNION ALL SELECT * FROM kept1 UNION ALL SELECT * FROM kept2""",
)
