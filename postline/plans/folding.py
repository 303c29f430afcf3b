"""Queries over folds and dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.functions import payload, text, url
from postline.operators import folding
from postline.operators.records import json_text
from postline.plans.derive import derived, oracle
from postline.plans.records import clean
from postline.plans.registry import query

C = F.col


def with_payload(df: DataFrame) -> DataFrame:
    """p_ columns to one payload; a null column is a missing key."""
    names = [c for c in df.columns if c.startswith("p_")]
    pairs: list[Column] = []
    for n in names:
        key = {"p_direct_key": "direct_company_career_page_key"}.get(n, n[2:])
        pairs += [F.lit(key), json_text(C(n))]
    return df.withColumn("raw_json", F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())).drop(*names)


PAYLOAD_KEYS = {
    "p_date_posted": "date_posted", "p_description": "description", "p_direct_key": "direct_company_career_page_key",
    "p_score": "score", "p_tag": "tag",
}


def payload_sql(columns: dict[str, str]) -> str:
    """Canonical payload text from SQL expressions per p_ column (null = key missing)."""
    parts = [f"""'"{PAYLOAD_KEYS[p]}":"' || ({e}) || '"'""" for p, e in sorted(columns.items(), key=lambda x: PAYLOAD_KEYS[x[0]])]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


BATCH_KEYS = ("p_description", "p_date_posted", "p_score", "p_tag", "p_direct_key")
TEXTS = ("source", "external_id", "title", "company_name", "description", "posted_time")


def last(c: str) -> str:
    return f"arg_max({c}, seq) FILTER (WHERE {clean(c)} IS NOT NULL)"


FOLDED = (
    "SELECT job_url, min(seq) AS seq, count(*) AS copies, "
    + ", ".join(f"{last(c)} AS {c}" for c in TEXTS)
    + ", arg_max(published_at, seq) FILTER (WHERE published_at IS NOT NULL) AS published_at, "
    + ", ".join(f"arg_max({p}, seq) FILTER (WHERE {p} IS NOT NULL) AS {p}" for p in BATCH_KEYS)
    + " FROM batch GROUP BY job_url"
)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folding.fold_inputs(with_payload(derived(spark, sf_dir, "batch")))


@query(
    "agg_06_fold_duplicate_inputs",
    "AGG-06",
    oracle(
        f"SELECT job_url, seq, copies, {', '.join(TEXTS)}, published_at, {payload_sql({p: p for p in BATCH_KEYS})} AS payload FROM ({FOLDED}) AS f",
        "batch",
    ),
)
def fold_duplicate_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = staged(spark, sf_dir)
    return folded.select("job_url", "seq", "copies", *TEXTS, "published_at", payload.payload_json(C("raw_json")).alias("payload"))


@query(
    "agg_06_fold_uniform_rows",
    "AGG-06",
    oracle(
        f"""SELECT link, min(seq) AS seq, arg_max(title, seq) FILTER (WHERE {clean('title')} IS NOT NULL) AS title,
        arg_max(description, seq) FILTER (WHERE {clean('description')} IS NOT NULL) AS description,
        arg_max(is_remote, seq) FILTER (WHERE is_remote IS NOT NULL) AS is_remote, count(*) AS copies
        FROM (SELECT *, trim(job_url) AS link FROM postings) AS p GROUP BY link""",
        "postings",
    ),
)
def fold_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings").select(F.trim("job_url").alias("link"), "seq", "title", "description", "is_remote")
    return folding.fold_inputs(df, "link", uniform_keys=True)


@query(
    "agg_07_company_link_fold",
    "AGG-07 URL-04 PRJ-23",
    oracle(
        f"""
WITH rows AS (SELECT seq, regexp_extract(job_url, '^https://www[.]comeet[.]com/jobs/[^/]+/[^/]+') AS base_url,
    coalesce({clean('company_name')}, {clean('company')}) AS company_name, job_url FROM postings WHERE starts_with(job_url, 'https://www.comeet.com/jobs/')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY base_url ORDER BY coalesce(length(company_name), -1) DESC, seq) AS rn FROM rows),
best AS (SELECT base_url, company_name FROM ranked WHERE rn = 1)
SELECT b.base_url, b.company_name, arg_max(r.job_url, r.seq) AS source_job_url,
  (SELECT count(*) FROM rows AS x WHERE x.base_url = b.base_url) AS copies
FROM best AS b JOIN rows AS r ON r.base_url = b.base_url AND r.company_name IS NOT DISTINCT FROM b.company_name GROUP BY 1, 2""",
        "postings",
    ),
)
def company_link_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings")
    base = url.hosted_board_fields(C("job_url"))[0]
    rows = df.select(
        "seq", base.alias("base_url"), text.first_non_blank(C("company_name"), C("company")).alias("company_name"),
        text.clean_text(C("job_url")).alias("source_job_url"),
    ).where(C("base_url").isNotNull())
    return folding.fold_company_links(rows)


KEY = f"coalesce({clean('job_url')}, {clean('id')}, {clean('apply_url')}, 'row-' || seq)"


@query(
    "set_03_coalesced_key_dedup",
    "SET-03",
    oracle(
        f"SELECT k, arg_min(seq, seq) AS seq, arg_min(title, seq) AS title FROM (SELECT *, {KEY} AS k, coalesce(title, '') AS t FROM postings) AS p GROUP BY k",
        "postings",
    ),
)
def coalesced_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings").select("seq", "job_url", "id", "apply_url", "title")
    return folding.dedupe(df).select(folding.dedupe_key().alias("k"), "seq", "title")


@query(
    "agg_12_dedupe_summary",
    "AGG-12",
    oracle(
        f"SELECT count(*) AS raw_rows, count(DISTINCT {KEY}) AS unique_rows, count(*) - count(DISTINCT {KEY}) AS duplicates_removed FROM postings",
        "postings",
    ),
)
def dedupe_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folding.dedupe_summary(derived(spark, sf_dir, "postings"))


@query(
    "set_04_last_wins",
    "SET-04",
    oracle("SELECT cust, max(seq) AS seq, arg_max(price, seq) AS price FROM postings GROUP BY cust", "postings"),
)
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folding.last_seen(derived(spark, sf_dir, "postings").select("cust", "seq", "price"), "cust")


@query(
    "win_05_first_seen",
    "WIN-05",
    oracle(
        """SELECT id, min(seq) AS seq, arg_min(price, seq) AS price FROM postings WHERE id IS NOT NULL GROUP BY id
        UNION ALL SELECT id, seq, price FROM postings WHERE id IS NULL""",
        "postings",
    ),
)
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folding.first_seen(derived(spark, sf_dir, "postings").select("id", "seq", "price"), "id")


@query(
    "win_02_latest_row",
    "WIN-02",
    oracle(
        """SELECT job_url, id, title, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY job_url
        ORDER BY updated_at DESC NULLS LAST, fetched_at DESC NULLS LAST, id DESC) AS rn FROM stored) AS s WHERE rn = 1""",
        "stored",
    ),
)
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "stored").select("job_url", "id", "title", "updated_at", "fetched_at")
    return folding.latest(df, "job_url").drop("fetched_at")


@query(
    "set_05_insert_missing",
    "SET-05",
    oracle(
        f"SELECT job_url, title, external_id FROM ({FOLDED}) AS f WHERE job_url NOT IN (SELECT job_url FROM stored)", "batch", "stored"
    ),
)
def insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = staged(spark, sf_dir).select("job_url", "title", "external_id")
    return folding.insert_missing(derived(spark, sf_dir, "stored").select("job_url", "title", "external_id"), new, "job_url")[0]


@query(
    "agg_01_duplicate_groups",
    "AGG-01 MRG-09",
    oracle("SELECT job_url, count(*) AS n FROM stored WHERE job_url IS NOT NULL GROUP BY 1 HAVING count(*) > 1", "stored"),
)
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folding.duplicate_groups(derived(spark, sf_dir, "stored"))


@query(
    "agg_11_ordered_links",
    "AGG-11",
    oracle(
        "SELECT company, job_url, min(seq) AS first_seen FROM (SELECT seq, trim(job_url) AS job_url, lower(trim(company)) AS company FROM postings) AS p WHERE company IS NOT NULL GROUP BY 1, 2",
        "postings",
    ),
)
def ordered_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings")
    df = df.select("seq", F.trim("job_url").alias("job_url"), F.lower(F.trim("company")).alias("company"))
    return folding.ordered_links(df.where(C("company").isNotNull()), "company", "job_url")
