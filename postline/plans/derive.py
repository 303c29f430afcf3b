"""Derived input tables.

The given tables hold no postings, so these texts derive them, row by row,
from whole given tables. The same text is valid in Spark and DuckDB; it only
makes inputs, the operators under test are written apart on each side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from postline.session import spread

RUN_DATE = "2001-10-01"
GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Link shapes per source: even and odd rows, # is the posting number, ~ a small one.
LINKS = {
    "linkedin": (
        "https://www.linkedin.com/jobs/view/data-engineer-#?refId=a&trk=b",
        " https://il.LinkedIn.com/jobs/view/#/",
    ),
    "indeed": ("https://www.indeed.com/viewjob?from=serp&jk=#&tk=1",) * 2,
    "glassdoor": ("https://www.glassdoor.com/job-listing/engineer-JV?jl=#",) * 2,
    "greenhouse": (
        "https://boards.greenhouse.io/acme/jobs/#/?gh_src=x",
        "https://careers.acme.com/open/?gh_jid=#",
    ),
    "comeet": (
        "https://www.comeet.com/jobs/acme~/A1.00B/engineer/#/all?x=1",
        "https://www.comeet.com/jobs/acme~/A1.00B/engineer/#",
    ),
    "eightfold": ("https://acme.eightfold.ai/careers/job/#/?domain=acme.com",) * 2,
    "workday": ("https://acme.wd1.myworkdayjobs.com/en-US/Careers/job/X/Engineer_R-#/",) * 2,
    "varonis": ("https://careers.varonis.com/job/#/apply?u=1",) * 2,
    "apple": ("https://jobs.apple.com/en-us/details/#/engineer?team=SFTWR",) * 2,
    "microsoft": ("https://apply.careers.microsoft.com/careers/job/#",) * 2,
    "meta": ("https://www.metacareers.com/jobs/#/?src=1",) * 2,
    "json_feed": ("https://feed.example.com/jobs/?id=#",) * 2,
    "redhat": ("https://acme.wd1.myworkdayjobs.com/en-US/Careers/job/X/Engineer_R-#/",) * 2,
    "zip_recruiter": ("https://feed.example.com/jobs/?id=#",) * 2,
}
COMPANY_LINKS = {
    "linkedin": "https://www.linkedin.com/company/c#/?trk=x",
    "indeed": "https://www.indeed.com/cmp/C-#",
    "glassdoor": "https://www.glassdoor.com/Overview/W-EI_IE#.htm",
}
MIX = [
    name
    for last in ("json_feed", "redhat", "zip_recruiter")
    for name in ["linkedin"] * 5
    + ["indeed", "glassdoor", "greenhouse", "comeet", "eightfold", "workday", "varonis", "apple", "microsoft", "meta"]
    + [last]
]


def _pick(values: list[str], index: str = "k") -> str:
    return f"split_part('{'|'.join(values)}', '|', {index})"


# Landed raw postings: one per order; a third of them from one source, several
# copies of most links, links and dates in all the shapes the rules handle.
POSTINGS = """
SELECT
  seq, cust, jid, odate, price,
  CASE WHEN seq % 97 = 0 THEN NULL WHEN seq % 7 = 0 THEN ' ' || upper(src) || ' ' ELSE src END AS site,
  src AS source,
  CASE WHEN seq % 5 < 2 THEN 'X' || jid END AS id,
  CASE WHEN seq % 5 = 2 THEN ' E' || jid END AS external_id,
  CASE WHEN seq % 31 = 0 THEN '  ' WHEN seq % 6 = 0 THEN ' Engineer ' || jid ELSE 'Engineer ' || jid END AS title,
  CASE WHEN seq % 8 = 0 THEN upper('Company ' || cust % 100) WHEN seq % 9 = 0 THEN '  company   ' || cust % 100
       WHEN seq % 10 = 0 THEN NULL ELSE 'Company ' || cust % 100 END AS company,
  CASE WHEN seq % 20 = 0 THEN 'Company ' || cust % 100 || ' Ltd' END AS company_name,
  CASE WHEN seq % 12 = 0 THEN NULL WHEN seq % 12 = 1 THEN 'Remote' ELSE 'City' || cust % 50 || ', ' ||
       CASE WHEN cust % 4 = 0 THEN 'NY, usa' WHEN cust % 4 = 1 THEN 'israel' WHEN cust % 4 = 2 THEN 'BE, germany'
            ELSE 'Ontario, Canada' END END AS location,
  CASE WHEN seq % 11 = 0 THEN ' ' WHEN seq % 4 = 0 THEN CAST(odate AS STRING)
       WHEN seq % 4 = 1 THEN replace(CAST(odate AS STRING), '-', '/')
       WHEN seq % 4 = 2 THEN CAST(odate AS STRING) || 'T23:30:00+02:00'
       ELSE substr(CAST(odate AS STRING), 9, 2) || '/' || substr(CAST(odate AS STRING), 6, 2) || '/' ||
            substr(CAST(odate AS STRING), 1, 4) END AS date_posted,
  CASE WHEN seq % 41 = 0 THEN 'not a link' WHEN seq % 43 > 0 THEN
    replace(replace(CASE WHEN seq % 2 = 0 THEN @EVEN ELSE @ODD END, '#', '' || jid), '~', '' || cust % 7) END AS job_url,
  CASE WHEN seq % 3 = 0 THEN NULL WHEN seq % 3 = 1 AND src = 'apple' THEN 'https://jobs.apple.com/app/details/' || jid || '/'
       WHEN seq % 3 = 1 THEN 'https://apply.example.com/a/' || jid || '/?s=1' ELSE 'mail us' END AS apply_url,
  CASE WHEN seq % 13 < 3 THEN 'https://direct.example.org/' || jid WHEN seq % 13 = 4 THEN 'mail us' END AS job_url_direct,
  CASE WHEN seq % 17 = 0 THEN NULL WHEN seq % 17 = 1 THEN 'Company page'
       ELSE replace(@COMPANY, '#', '' || cust % 100) END AS company_url,
  CASE WHEN seq % 14 = 0 THEN NULL WHEN seq % 14 = 1 THEN '   '
       ELSE 'We offer ' || CASE WHEN price % 5 = 0 THEN '$' || (price % 40 + 20) || ' - $' || (price % 50 + 25) || ' an hour'
            WHEN price % 5 = 1 THEN '$' || (price % 90 + 40) || 'k-$' || (price % 120 + 60) || 'K'
            WHEN price % 5 = 2 THEN '$' || (price % 9 + 1) || ',' || (100 + price % 900) || ' - ' || (price % 12 + 1) || ',500.50 a month'
            WHEN price % 5 = 3 THEN '$' || (price % 300000 + 20000) || '-$' || (price % 600000 + 30000)
            ELSE 'good pay' END ||
            CASE WHEN price % 6 = 0 THEN '. Full time, remote.' WHEN price % 6 = 1 THEN '. Hybrid contract.'
                 WHEN price % 6 = 2 THEN '. Internship; work from home' ELSE '. In the office' END ||
            CASE WHEN price % 8 = 0 THEN ' Mail jobs' || cust % 20 || '@acme.example.com or hr@acme.co.il.' ELSE '' END END AS description,
  CASE WHEN seq % 6 = 0 THEN NULL WHEN seq % 6 = 1 THEN 'n/a' WHEN seq % 6 = 2 THEN price % 500 || '.0' ELSE '' || price % 500 END AS applications_count,
  CASE WHEN price % 7 = 0 THEN NULL WHEN price % 7 = 1 THEN 'fulltime' WHEN price % 7 = 2 THEN 'Full-time, Contract'
       WHEN price % 7 = 3 THEN 'Teil zeit' WHEN price % 7 = 4 THEN 'unknown' ELSE 'intern ship,internship, Part-Time' END AS job_type,
  CASE WHEN price % 3 = 0 THEN ' mid-senior ' END AS job_level,
  CASE WHEN price % 4 > 0 THEN 'Iv1_SOFTWARE_dev-ops ' || price % 4 END AS company_industry,
  CASE WHEN price % 5 > 2 THEN 'Engineering' END AS job_function,
  CASE WHEN seq % 5 = 0 THEN NULL ELSE seq % 5 = 1 END AS is_remote,
  CASE WHEN seq % 4 = 0 THEN NULL WHEN seq % 4 = 1 THEN 'On_Site' WHEN seq % 4 = 2 THEN 'Hybrid Work' ELSE '' END AS listing_type,
  CASE WHEN price % 9 < 4 THEN CAST(price % 90000 AS DOUBLE) WHEN price % 9 = 4 THEN 0.0 END AS min_amount,
  CASE WHEN price % 9 < 3 THEN CAST(price % 90000 + 500 AS DOUBLE) + 0.5 END AS max_amount,
  CASE WHEN price % 9 < 5 THEN CASE WHEN price % 2 = 0 THEN 'yearly' WHEN price % 3 = 0 THEN 'hourly' ELSE 'monthly' END END AS pay_interval,
  CASE WHEN price % 9 < 4 THEN 'USD' END AS currency,
  CASE WHEN seq % 19 = 0 THEN '' || cust % 100 END AS direct_company_career_page_id,
  CASE WHEN seq % 19 = 0 THEN 'company-' || cust % 100 END AS direct_company_career_page_key,
  CASE WHEN seq % 38 = 0 THEN 'Company ' || cust % 100 END AS direct_company_career_page_company
FROM (
  SELECT o_orderkey AS seq, o_custkey AS cust, 1000000 + o_custkey * 3 + o_orderkey % 3 AS jid,
    CAST(o_orderdate AS DATE) AS odate, CAST(floor(o_totalprice) AS BIGINT) AS price,
    CAST(o_custkey % 48 + 1 AS INT) AS k, @MIX AS src
  FROM {orders}
) AS base
"""
POSTINGS = (
    POSTINGS.replace("@EVEN", _pick([LINKS[n][0] for n in MIX]))
    .replace("@ODD", _pick([LINKS[n][1] for n in MIX]))
    .replace("@COMPANY", _pick([COMPANY_LINKS.get(n, "HTTPS://Www.C#.com/about//") for n in MIX]))
    .replace("@MIX", _pick(MIX, "CAST(o_custkey % 48 + 1 AS INT)"))
)

# Stored rows as a merge finds them: one per order outside the newest batch,
# with several rows on many links. p_ columns are the payload, one per key.
STORED = """
SELECT o_orderkey AS id,
  'https://jobs.example.com/' || CASE WHEN o_custkey % 3 = 0 THEN 'linkedin/' ELSE 'board/' END || o_custkey || '-' || o_orderkey % 5 AS job_url,
  CASE WHEN o_custkey % 3 = 0 THEN 'linkedin' WHEN o_orderkey % 29 = 0 THEN ' ' ELSE 'indeed' END AS source,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'E' || o_custkey || '-' || CASE WHEN o_orderkey % 17 = 0 THEN o_orderkey % 4 ELSE o_orderkey % 5 END END AS external_id,
  CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE 'Title ' || o_orderkey % 40 END AS title,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Company ' || o_custkey % 100 END AS company_name,
  CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'Text ' || o_orderkey % 25 END AS description,
  '2000-01-01' AS posted_time,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS published_at,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderdate AS DATE) + 40 END AS reposted_at,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 1 END AS fetched_at,
  CASE WHEN o_orderkey % 4 > 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 2 END AS updated_at,
  o_custkey % 7 = 0 AS is_duplicate,
  CASE WHEN o_orderkey % 2 = 0 THEN 'p' || o_orderkey % 25 END AS p_description,
  CASE WHEN o_orderkey % 3 > 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS p_date_posted,
  CASE WHEN o_orderkey % 8 > 0 THEN 's' || o_orderkey % 3 END AS p_score,
  CASE WHEN o_orderkey % 7 = 0 THEN 't' || o_custkey % 2 END AS p_tag
FROM {orders} WHERE CAST(o_orderdate AS DATE) < CAST('2000-06-01' AS DATE)
"""

# The newest batch, before folding: same links and some new ones.
BATCH = """
SELECT o_orderkey AS seq,
  'https://jobs.example.com/' || CASE WHEN o_custkey % 3 = 0 THEN 'linkedin/' ELSE 'board/' END || o_custkey || '-' || o_orderkey % 6 AS job_url,
  CASE WHEN o_custkey % 3 = 0 THEN 'linkedin' ELSE 'indeed' END AS source,
  CASE WHEN o_orderkey % 23 = 0 THEN ' ' ELSE 'E' || o_custkey || '-' || o_orderkey % 6 END AS external_id,
  'Title ' || o_orderkey % 41 AS title,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN upper('Company ' || o_custkey % 100) ELSE ' Company  ' || o_custkey % 100 END AS company_name,
  CASE WHEN o_orderkey % 5 = 0 THEN '  ' ELSE 'New ' || o_orderkey % 25 END AS description,
  CASE WHEN o_orderkey % 10 = 0 THEN ' ' ELSE '2001-02-03' END AS posted_time,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) - 600 END AS published_at,
  CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN 'q' || o_orderkey % 25 END AS p_description,
  CASE WHEN o_orderkey % 2 > 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS p_date_posted,
  CASE WHEN o_orderkey % 3 > 0 THEN 's' || o_orderkey % 3 END AS p_score,
  CASE WHEN o_orderkey % 17 = 0 THEN 't' || o_custkey % 2 END AS p_tag,
  CASE WHEN o_orderkey % 19 = 0 THEN 'company-' || o_custkey % 100 END AS p_direct_key
FROM {orders} WHERE CAST(o_orderdate AS DATE) >= CAST('2000-06-01' AS DATE)
"""

# Facts that hang on stored rows: one per order line.
MATCHES = """
SELECT l_suppkey AS user_id, l_orderkey AS job_id, l_linenumber * 100000 + l_partkey % 100000 AS tie,
  l_linenumber % 2 = 0 AS fit_first_analysis,
  CAST(l_shipdate AS DATE) AS created_at,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS fit_score,
  CASE WHEN l_linenumber % 3 = 0 THEN 'f' || l_partkey % 10 END AS job_fit_output,
  l_returnflag = 'R' AS star,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linestatus = 'O' END AS hide,
  CASE WHEN l_linenumber > 4 THEN CAST(l_shipdate AS DATE) END AS seen_at,
  CASE WHEN l_linenumber > 5 THEN ' ' WHEN l_linenumber > 2 THEN 'Resume ' || l_partkey % 5 END AS attached_resume_template_name,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount END AS distance_km
FROM {lineitem}
"""
CARDS = """
SELECT l_suppkey AS user_id, l_orderkey AS job_id, l_linenumber * 100000 + l_partkey % 100000 AS tie,
  CASE WHEN l_linenumber = 1 THEN ' ' ELSE 'stage' || l_linenumber % 3 END AS stage,
  CASE WHEN l_partkey % 3 = 0 THEN 'k' || l_partkey % 4 END AS d_note,
  CASE WHEN l_partkey % 2 = 0 THEN 'v' || l_partkey % 5 END AS d_step,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'app' || l_partkey % 2 END AS source,
  CASE WHEN l_partkey % 7 = 0 THEN ' ' ELSE 'event' || l_partkey % 6 END AS last_event,
  CAST(l_shipdate AS DATE) AS moved_at,
  CAST(l_shipdate AS DATE) - 3 AS created_at,
  CASE WHEN l_linenumber < 4 THEN CAST(l_shipdate AS DATE) END AS deleted_at
FROM {lineitem}
"""
DELIVERIES = """
SELECT l_suppkey % 20 AS user_id, l_orderkey AS job_id,
  (l_linenumber * 100000 + l_partkey % 100000) * 10000 + l_suppkey % 10000 AS tie,
  CASE WHEN l_linenumber % 2 = 0 THEN 'daily' ELSE 'weekly' END AS service_name,
  CASE WHEN l_returnflag = 'A' THEN '' ELSE 'sent' || l_linenumber END AS delivery_status,
  CASE WHEN l_linestatus = 'F' THEN NULL ELSE 'u' || l_partkey % 9 || '@x.org' END AS email,
  CAST(l_shipdate AS DATE) AS run_started_at,
  CASE WHEN l_linenumber > 3 THEN CAST(l_shipdate AS DATE) + 1 END AS delivered_at
FROM {lineitem}
"""

# Career pages catalog: one per supplier; even ones are enabled.
CATALOG = """
SELECT s_suppkey AS id, 'company-' || s_suppkey AS company_key,
  CASE WHEN s_suppkey % 5 = 0 THEN ' Company  ' || s_suppkey ELSE 'Company ' || s_suppkey END AS company_name,
  CASE WHEN s_suppkey % 4 = 0 THEN 'C' || s_suppkey || ' Inc, COMPANY ' || s_suppkey || ', C' || s_suppkey || ' Inc' ELSE '' END AS company_aliases,
  CASE WHEN s_nationkey % 3 = 0 THEN 'workday' WHEN s_nationkey % 3 = 1 THEN 'json_feed' ELSE 'comeet' END AS scraper_site,
  CASE WHEN s_suppkey % 6 = 0 THEN 'https://c' || s_suppkey || '.wd1.myworkdayjobs.com/Careers'
       WHEN s_suppkey % 6 = 1 THEN 'https://www.comeet.com/jobs/c' || s_suppkey || '/A1.00B'
       WHEN s_suppkey % 6 = 2 THEN 'https://jobs.lever.co/c' || s_suppkey || '/1?x=2'
       WHEN s_suppkey % 6 = 3 THEN 'https://boards.greenhouse.io/c' || s_suppkey
       WHEN s_suppkey % 6 = 4 THEN 'https://api.lever.co/v0/postings/c' || s_suppkey || '?mode=json'
       ELSE 'careers.c' || s_suppkey || '.com/jobs' END AS career_page_url,
  s_suppkey % 2 = 0 AS enabled,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'israel' END AS location,
  CAST(s_nationkey AS BIGINT) AS results_wanted
FROM {supplier}
"""

# Raw careers-site positions with nested parts spelled as columns.
POSITIONS = """
SELECT p_partkey AS seq, 'P' || p_partkey AS id, p_name AS name,
  CASE WHEN p_size % 4 = 0 THEN ' ' ELSE 'medium/' || p_partkey END AS logo_medium,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'small/' || p_partkey END AS logo_small,
  CASE WHEN p_size % 2 = 0 THEN 'original/' || p_partkey END AS logo_original,
  'picture/' || p_partkey AS picture,
  CASE WHEN p_size % 5 = 0 THEN 'Detail ' || p_name END AS detail_name,
  CASE WHEN p_size % 7 = 0 THEN '/jobs/d' || p_partkey END AS detail_url,
  '/jobs/' || p_partkey AS url,
  'company-' || p_partkey % 100 AS page_key,
  CASE WHEN p_size % 2 = 0 THEN 'israel' ELSE 'germany' END AS parent_country,
  'City' || p_partkey % 20 AS parent_city,
  'Town' || p_partkey % 9 AS city_1, CASE WHEN p_size % 3 = 0 THEN 'israel' ELSE 'france' END AS country_1, p_size % 4 = 1 AS active_1,
  CASE WHEN p_size % 6 = 0 THEN NULL ELSE 'Village' || p_partkey % 11 END AS city_2,
  CASE WHEN p_size % 4 = 0 THEN 'israel' ELSE 'usa' END AS country_2, p_size % 4 = 2 AS active_2,
  CAST(floor(p_retailprice) AS BIGINT) AS price, p_type AS kind, p_size AS size
FROM {part}
"""

# Landed documents as postings: stated mail, raw text.
LETTERS = """
SELECT doc_id AS seq, text, lang, source, n_chars FROM {documents}
"""

DERIVED = {
    "postings": POSTINGS,
    "stored": STORED,
    "batch": BATCH,
    "matches": MATCHES,
    "cards": CARDS,
    "deliveries": DELIVERIES,
    "catalog": CATALOG,
    "positions": POSITIONS,
    "letters": LETTERS,
}


#: Derived rows that are wide or made into documents and pages, which cost far more than the narrow rows they come from.
DEALT = {"positions": "part", "postings": "orders", "stored": "orders", "batch": "orders"}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in DEALT:
        return derived_from(spread(spark.read.parquet(f"{sf_dir}/{DEALT[name]}.parquet")), name)
    text = re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", DERIVED[name])
    return spark.sql(text)


def derived_from(rows: DataFrame, name: str) -> DataFrame:
    """The same derivation over rows at hand, e.g. a micro-batch; for texts that read one table."""
    return rows.sparkSession.sql(re.sub(r"\{\w+\}", "{rows}", DERIVED[name]), rows=rows)


def oracle(body: str, *names: str, **views: str) -> str:
    """SQL for the check: the named derived tables as CTEs before the body."""
    parts = [f"{n} AS ({DERIVED[n].format(**{g: g for g in GIVEN}).strip()})" for n in names]
    parts += [f"{n} AS ({text.strip()})" for n, text in views.items()]
    if not parts:
        return body.strip()
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
