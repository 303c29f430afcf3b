"""Queries over counts, coverage, quality and writers; and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.functions import payload
from postline.functions.money import extract_salary
from postline.operators import folding, merge, output, records, reports
from postline.plans.derive import RUN_DATE, derived, oracle
from postline.plans.folding import with_payload
from postline.plans.merging import BASE, FLAG, KEYS_SQL, NEXT_ID, RUN_TS, STAGED, batch_ctes, unique
from postline.plans.records import KNOWN, RULES, clean, record_sql
from postline.plans.registry import query, table
from postline.plans.scalars import PAY_OK, PAY_SQL
from postline.plans.streams import scratch
from postline.session import cut_lineage
from postline.sources import sinks

C = F.col


@query("agg_03_jobs_per_site", "AGG-03", oracle("SELECT source, count(*) AS jobs FROM postings GROUP BY 1", "postings"))
def jobs_per_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.per_site(derived(spark, sf_dir, "postings"), "source")


COVERAGE = """
SELECT c.company_key, coalesce(n.jobs, 0) AS jobs, coalesce(n.links, 0) AS links, CASE WHEN c.id % 9 = 0 THEN 'timeout' END AS error FROM catalog AS c
LEFT JOIN (SELECT direct_company_career_page_key AS k, count(*) AS jobs, count(job_url) AS links FROM postings GROUP BY 1) AS n ON n.k = c.company_key"""


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derived(spark, sf_dir, "catalog")
    found = derived(spark, sf_dir, "postings").withColumnRenamed("direct_company_career_page_key", "company_key")
    failures = pages.where("id % 9 = 0").select("company_key", F.lit("timeout").alias("error"))
    return reports.coverage_rows(pages.select("company_key"), found, failures)


@query("agg_04_coverage_rows", "AGG-04", oracle(COVERAGE, "catalog", "postings"))
def coverage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir)


@query(
    "agg_04_coverage_summary",
    "AGG-04",
    oracle(
        f"""SELECT count(*) AS companies, count_if(jobs > 0) AS companies_with_jobs, count(error) AS failed, CAST(sum(jobs) AS BIGINT) AS jobs, CAST(sum(links) AS BIGINT) AS links
        FROM ({COVERAGE}) AS c""",
        "catalog", "postings",
    ),
)
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage(_coverage(spark, sf_dir))


@query(
    "agg_09_pay_envelope",
    "AGG-09 NUM-03",
    oracle(
        """SELECT seq, CAST(price AS DOUBLE) AS low, CAST(price + 900 AS DOUBLE) AS high, CASE WHEN size % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency FROM positions""",
        "positions",
    ),
)
def pay_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.functions.money import pay_envelope as envelope

    df = derived(spark, sf_dir, "positions")
    one = lambda lo, hi, cur: F.struct(
        F.format_number(C("price") + lo, 2).alias("low"), F.format_number(C("price") + hi, 2).alias("high"), cur.alias("currency")
    )
    blank = F.struct(F.lit(" ").alias("low"), F.lit("99,999,999.00").alias("high"), F.lit("EUR").alias("currency"))
    pay = envelope(F.array(one(50, 900, F.lit("EUR")), one(0, 10, F.when(C("size") % 2 == 0, "EUR").otherwise("CHF")), blank))
    return df.select("seq", pay["min_amount"].alias("low"), pay["max_amount"].alias("high"), pay["currency"].alias("currency"))


VALID = " UNION ALL ".join(f"SELECT seq FROM ({record_sql(n)}) AS x" for n in RULES)
QUALITY = f"""
WITH good AS ({VALID}),
n AS (SELECT source, count(*) AS jobs, count_if({clean('title')} IS NULL) AS missing_title, count_if({clean('job_url')} IS NULL) AS missing_job_url,
  count_if(seq NOT IN (SELECT seq FROM good)) AS not_normalised FROM {{rows}} GROUP BY 1)
SELECT *, concat_ws('; ', CASE WHEN missing_title > 0 THEN 'missing title' END, CASE WHEN missing_job_url > 0 THEN 'missing job_url' END,
  CASE WHEN not_normalised > 0 THEN 'could not be normalised' END) AS errors,
  CASE WHEN missing_title + missing_job_url + not_normalised > 0 THEN 'failed' ELSE 'valid' END AS status FROM n"""


@query("dq_01_validate_sources", "DQ-01", oracle(QUALITY.replace("{rows}", "postings"), "postings"))
def validate_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.validate_sources(derived(spark, sf_dir, "postings"), sample=None)


@query(
    "dq_01_validate_source_samples",
    "DQ-01 WIN-04",
    oracle(
        QUALITY.replace("{rows}", "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq) AS rn FROM postings) AS p WHERE rn <= 5) AS s"),
        "postings",
    ),
)
def validate_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.validate_sources(derived(spark, sf_dir, "postings"), sample=5)


@query(
    "dq_01_faults_of_rows",
    "DQ-01",
    oracle(
        f"""
WITH good AS ({VALID}), p AS (SELECT *, lower(coalesce({clean('site')}, {clean('source')}, 'linkedin')) AS route FROM postings)
SELECT source, seq, title AS given_title, job_url AS given_job_url,
  concat_ws('; ', CASE WHEN {clean('title')} IS NULL THEN 'missing title' END, CASE WHEN {clean('job_url')} IS NULL THEN 'missing job_url' END,
    'could not be normalised: ' || CASE WHEN route NOT IN ({KNOWN}) THEN 'unsupported_source' WHEN {clean('title')} IS NULL THEN 'missing_title' ELSE 'invalid_url' END) AS messages
FROM p WHERE seq NOT IN (SELECT seq FROM good)""",
        "postings",
    ),
)
def faults_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.checked_rows(derived(spark, sf_dir, "postings")).where(F.size("messages") > 0)
    return rows.select("source", "seq", "given_title", "given_job_url", F.array_join("messages", "; ").alias("messages"))


@query(
    "dq_01_sources_without_rows",
    "DQ-01 SRC-11",
    oracle(
        f"""
WITH keyed AS (SELECT seq, title, job_url, coalesce(direct_company_career_page_key, 'none') AS k FROM postings), good AS ({VALID}),
n AS (SELECT k, count(*) AS jobs, count_if({clean('title')} IS NULL) AS missing_title, count_if({clean('job_url')} IS NULL) AS missing_job_url,
  count_if(seq NOT IN (SELECT seq FROM good)) AS not_normalised FROM keyed GROUP BY 1),
c AS (SELECT company_key, coalesce(jobs, 0) AS jobs, coalesce(missing_title, 0) AS missing_title, coalesce(missing_job_url, 0) AS missing_job_url,
  coalesce(not_normalised, 0) AS not_normalised FROM catalog LEFT JOIN n ON n.k = company_key)
SELECT *, concat_ws('; ', CASE WHEN jobs = 0 THEN 'no jobs' END, CASE WHEN missing_title > 0 THEN 'missing title' END,
  CASE WHEN missing_job_url > 0 THEN 'missing job_url' END, CASE WHEN not_normalised > 0 THEN 'could not be normalised' END) AS errors,
  CASE WHEN jobs = 0 OR missing_title + missing_job_url + not_normalised > 0 THEN 'failed' ELSE 'valid' END AS status FROM c""",
        "postings", "catalog",
    ),
)
def sources_without_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived(spark, sf_dir, "postings")
    key = F.coalesce(C("direct_company_career_page_key"), F.lit("none"))
    pages = derived(spark, sf_dir, "catalog").select("company_key")
    return reports.validate_sources(raw.withColumn("company_key", key), pages, key="company_key")


COMBINED = f"""
WITH RECURSIVE keys AS ({KEYS_SQL}), base AS ({BASE}), s AS (SELECT *, {FLAG} AS is_duplicate FROM ({STAGED}) AS f),
{batch_ctes('base', 's', '1', NEXT_ID, flag=True)},
found AS (SELECT c.company_key, c.enabled, count(s.job_url) AS jobs FROM catalog AS c LEFT JOIN s ON s.p_direct_key = c.company_key GROUP BY 1, 2)
SELECT (SELECT count(*) FROM batch) AS rows, (SELECT count(*) FROM s) AS prepared, (SELECT count(*) FROM fresh1) AS inserted,
  (SELECT count_if(changed) FROM compared1) AS updated, (SELECT count(*) FROM mapping1) AS deleted_duplicate_rows,
  (SELECT count_if(is_duplicate) FROM s) AS marked_duplicate_jobs, (SELECT count(*) FROM found WHERE enabled) AS companies,
  (SELECT count(*) FROM found WHERE enabled AND jobs > 0) AS companies_with_jobs"""


@query("mrg_01_combined_run", "MRG-01 SET-02 JN-06 AGG-04 SRC-11", oracle(COMBINED, "batch", "stored", "catalog"))
def combined_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog, company pages before boards, union, flagged upsert, report."""
    catalog, landed = derived(spark, sf_dir, "catalog"), derived(spark, sf_dir, "batch")
    direct, boards = landed.where("p_direct_key IS NOT NULL"), landed.where("p_direct_key IS NULL")
    folded = folding.fold_inputs(with_payload(output.union_sources([direct, boards])))
    batch = cut_lineage(merge.flag_configured(folded, catalog))
    done = merge.upsert_postings(unique(spark, sf_dir), batch, RUN_TS, NEXT_ID, landed=landed, with_flag=True)
    page = payload.payload_text(C("raw_json"), "direct_company_career_page_key")
    found = batch.select(page.alias("company_key"), "job_url").where("company_key IS NOT NULL")
    pages = catalog.where("enabled").select("company_key")
    none = pages.select("company_key", F.lit(None).cast("string").alias("error")).limit(0)
    cover = reports.coverage(reports.coverage_rows(pages, found, none)).select("companies", "companies_with_jobs")
    wanted = ("rows", "prepared", "inserted", "updated", "deleted_duplicate_rows", "marked_duplicate_jobs")
    both = done.summary.select(*wanted).unionByName(cover, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@query(
    "dq_02_reject_split",
    "DQ-02 FLT-01",
    oracle(
        f"""
WITH good AS ({VALID}), p AS (SELECT *, lower(coalesce({clean('site')}, {clean('source')}, 'linkedin')) AS route FROM postings)
SELECT seq, route, CASE WHEN route NOT IN ({KNOWN}) THEN 'unsupported_source' WHEN {clean('title')} IS NULL THEN 'missing_title' ELSE 'invalid_url' END AS reject_reason
FROM p WHERE seq NOT IN (SELECT seq FROM good)""",
        "postings",
    ),
)
def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.rejects(records.map_records(derived(spark, sf_dir, "postings"), payload=F.lit(None)))


OUT_SQL = "SELECT 'p' || seq AS id, source AS site, title, CAST(odate AS STRING) AS date_posted FROM postings"


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings")
    return df.select(F.concat(F.lit("p"), C("seq")).alias("id"), C("source").alias("site"), "title", C("odate").alias("date_posted"))


@query("snk_01_write_json_records", "SNK-01", oracle(OUT_SQL, "postings"))
def write_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "json")
    sinks.write_json(_rows(spark, sf_dir), path)
    return spark.read.schema("id string, title string, date_posted string, site string").json(path)


@query("snk_02_write_csv", "SNK-02", oracle(f"SELECT id, site, coalesce(nullif(trim(title), ''), '') AS title, date_posted FROM ({OUT_SQL}) AS o", "postings"))
def write_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    sinks.write_csv(_rows(spark, sf_dir), path)
    back = spark.read.option("header", True).option("escape", "\\").schema("id string, site string, title string, date_posted string").csv(path)
    return back.withColumn("title", F.coalesce(F.trim("title"), F.lit("")))


@query(
    "snk_03_run_report",
    "SNK-03",
    oracle(
        f"""SELECT count(*) AS site_count, string_agg(source, ',' ORDER BY source) AS sites, CAST(sum(n) AS BIGINT) AS jobs_retrieved, '{RUN_DATE}T12:00:00' AS finished_at
        FROM (SELECT source, count(*) AS n FROM postings GROUP BY 1) AS s WHERE n % 3 > 0""",
        "postings",
    ),
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "report")
    counts = reports.per_site(derived(spark, sf_dir, "postings"), "source")
    runs = counts.select(
        C("source").alias("site"), C("jobs").alias("jobs_retrieved"), F.lit(True).alias("scraped"), (C("jobs") % 3 > 0).alias("persisted")
    )
    sinks.append_report(reports.run_report(runs, f"{RUN_DATE}T12:00:00"), path)
    return spark.read.parquet(path)


@query(
    "snk_04_evolve_schema",
    "SNK-04",
    oracle(
        """SELECT id, company_name, NULL::STRING AS scraper_site FROM catalog WHERE NOT enabled UNION ALL SELECT id, company_name, scraper_site FROM catalog WHERE enabled""",
        "catalog",
    ),
)
def evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "evolve")
    pages = derived(spark, sf_dir, "catalog")
    old = pages.where("NOT enabled").select("id", "company_name")
    both = sinks.evolve(old, pages.where("enabled").select("id", "company_name", "scraper_site"))
    sinks.write_snapshot(old, f"{path}/a")
    sinks.write_snapshot(both.where(C("scraper_site").isNotNull()), f"{path}/b")
    return sinks.read_evolved(spark, f"{path}/a", f"{path}/b")


@query(
    "src_11_pages_in_use",
    "SRC-11 JN-04",
    oracle(
        "SELECT company_key, company_name FROM catalog WHERE company_key IN (SELECT direct_company_career_page_key FROM postings)", "catalog", "postings"
    ),
)
def pages_in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = derived(spark, sf_dir, "postings").select(C("direct_company_career_page_key").alias("company_key"))
    return derived(spark, sf_dir, "catalog").join(keys, "company_key", "left_semi").select("company_key", "company_name")


# The flagship: map, fold, flag, pay, count by source and flag.
FLAGSHIP = f"""
WITH keys AS ({KEYS_SQL}),
rec AS ({" UNION ALL ".join(f"SELECT seq, job_url, source, company_name, description FROM ({record_sql(n)}) AS x" for n in RULES)}),
folded AS (SELECT job_url, min(seq) AS seq, arg_max(source, seq) AS source, arg_max(company_name, seq) FILTER (WHERE company_name IS NOT NULL) AS company_name,
  arg_max(description, seq) FILTER (WHERE description IS NOT NULL) AS description, bool_or(direct) AS direct
  FROM (SELECT rec.*, p.direct_company_career_page_key IS NOT NULL AS direct FROM rec JOIN postings AS p ON p.seq = rec.seq) AS r GROUP BY job_url),
flagged AS (SELECT *, coalesce(source IN ('linkedin', 'indeed', 'glassdoor', 'greenhouse', 'comeet', 'google', 'zip_recruiter', 'bayt', 'naukri', 'bdjobs') AND NOT direct
  AND lower(regexp_replace({clean('company_name')}, '\\s+', ' ', 'g')) IN (SELECT k FROM keys), FALSE) AS is_duplicate FROM folded),
paid AS ({PAY_SQL.replace('FROM postings', 'FROM flagged')})
SELECT CASE WHEN direct THEN 'company' ELSE source END AS source, is_duplicate, count(*) AS postings, count_if({PAY_OK}) AS with_pay,
  CAST(min(CASE WHEN {PAY_OK} THEN year_lo END) AS BIGINT) AS lowest, CAST(max(CASE WHEN {PAY_OK} THEN year_hi END) AS BIGINT) AS highest
FROM paid GROUP BY 1, 2"""


@query("flagship_postings_by_source", "PRJ-02 URL-01 DT-01 AGG-06 JN-06 SAL-01", oracle(FLAGSHIP, "postings", "catalog"))
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.operators.records import json_text

    raw = derived(spark, sf_dir, "postings")
    key = "direct_company_career_page_key"
    mapped = records.valid_records(records.map_records(raw, payload=json_text(C(key))))
    slim = mapped.select("seq", "job_url", "source", "company_name", "description", C("raw_json").alias("page_key"))
    batch = cut_lineage(folding.fold_inputs(slim))
    payload = F.map_filter(F.create_map(F.lit(key), C("page_key")), lambda _, v: v.isNotNull())
    flagged = merge.flag_configured(batch.withColumn("raw_json", payload), derived(spark, sf_dir, "catalog"))
    pay = extract_salary(C("description"), annual=True)
    rows = flagged.withColumn("pay", pay).withColumn(
        "source", F.when(records.is_direct_page(C("raw_json")), F.lit("company")).otherwise(C("source"))
    )
    return rows.groupBy("source", "is_duplicate").agg(
        F.count("*").alias("postings"),
        F.count_if(C("pay").isNotNull()).alias("with_pay"),
        F.min("pay.min_amount").alias("lowest"),
        F.max("pay.max_amount").alias("highest"),
    )
