"""Queries over company grids, careers pages and base URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.operators import companies, folding, joins
from postline.plans.derive import RUN_DATE, derived, oracle
from postline.plans.records import clean
from postline.plans.registry import query
from postline.sources import landing

C = F.col
RUN_TS = f"{RUN_DATE} 12:00:00"
NOW = f"'{RUN_TS}'"
HEADER = (
    '[{"id":"f1","name":"Company","type":"text"},{"id":"f2","name":"Head Count (est.)","type":"number"},'
    '{"id":"f3","name":"Tags","type":"multiSelect","typeOptions":{"choices":{"c0":{"name":"Cloud"},"c1":"Data "}}},'
    '{"id":"f4","name":"Active","type":"checkbox"},{"id":"f5","name":"Updated","type":"formula"},'
    '{"id":"f6","name":"Stage","type":"select","typeOptions":{"choices":[{"id":"s0","name":"Seed"},{"id":"s1","name":"Grown"}]}}]'
)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One grid document per position: two rows, the second repeating ids across documents."""
    df = derived(spark, sf_dir, "positions")
    cells = F.struct(
        F.concat(F.lit(" "), C("name")).alias("f1"), F.concat(C("size"), F.lit(".7")).alias("f2"),
        F.array(F.concat(F.lit("c"), C("size") % 3), F.lit("c1"), F.concat(F.lit("c"), C("size") % 3)).alias("f3"),
        F.when(C("size") % 3 == 0, "yes").when(C("size") % 3 == 1, "No").alias("f4"),
        F.lit("2001-02-03T04:05:06Z").alias("f5"), F.concat(F.lit("s"), C("size") % 4).alias("f6"),
    )
    row = lambda key: F.to_json(F.struct(key.alias("id"), F.lit("2001-01-01").alias("createdTime"), cells.alias("cellValuesByColumnId")))
    rows = F.concat(F.lit("["), row(F.concat(F.lit("r"), C("seq"))), F.lit(","), row(F.concat(F.lit("s"), C("seq") % 500)), F.lit(',{"id":"x"}]'))
    text = F.concat(F.lit('{"data":{"table":{"columns":' + HEADER + ',"rows":'), rows, F.lit("}}}"))
    return df.select("seq", F.parse_json(text).alias("doc"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = grid(spark, sf_dir)
    rows, header = landing.grid(C("doc"))
    columns = companies.grid_schema(landing.explode_items(docs, header, ["seq"]))
    typed = companies.grid_records(
        landing.explode_items(docs, rows, ["seq"]).withColumn("pos", C("seq") * 10 + C("pos")), columns
    )
    return typed


GRID = """SELECT k AS row_id, pos, name AS company_name, size AS head_count_est,
  CASE size % 3 WHEN 0 THEN 'Cloud|Data' WHEN 1 THEN 'Data' ELSE 'c2|Data' END AS tags,
  CASE size % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS active, '2001-02-03 04:05:06' AS source_updated_at,
  CASE size % 4 WHEN 0 THEN 'Seed' WHEN 1 THEN 'Grown' ELSE 's' || size % 4 END AS stage
FROM (SELECT *, 'r' || seq AS k, seq * 10 AS pos FROM positions UNION ALL SELECT *, 's' || seq % 500, seq * 10 + 1 FROM positions) AS p"""


def shown(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "row_id", *extra, "company_name", C("head_count_est").cast("int"), F.array_join("tags", "|").alias("tags"), "active",
        F.date_format("source_updated_at", "yyyy-MM-dd HH:mm:ss").alias("source_updated_at"), "stage",
    )


@query("prj_20_grid_records", "PRJ-19 PRJ-20 SRC-02 DT-04 NUM-01 NUM-02", oracle(GRID, "positions"))
def grid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(records(spark, sf_dir), "pos")


LAST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY pos DESC) AS rn FROM ({GRID}) AS g) AS x WHERE rn = 1"


@query("set_04_grid_last_wins", "SET-04", oracle(f"SELECT row_id, company_name, stage FROM ({LAST}) AS l", "positions"))
def grid_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folding.last_seen(records(spark, sf_dir), "row_id", seq="pos").select("row_id", "company_name", "stage")


@query(
    "mrg_10_companies_upsert",
    "MRG-10 SNK-04 SET-04",
    oracle(
        f"""
WITH new AS ({LAST}), cur AS (SELECT 'r' || seq AS row_id, 'Old ' || name AS company_name, page_key AS notes FROM positions WHERE size % 2 = 0
  UNION ALL SELECT 'z' || seq, name, page_key FROM positions WHERE size % 5 = 0)
SELECT coalesce(c.row_id, n.row_id) AS row_id, CASE WHEN n.row_id IS NULL THEN c.company_name ELSE n.company_name END AS company_name, c.notes, n.stage, n.tags,
  CASE WHEN n.row_id IS NULL THEN 'keep' WHEN c.row_id IS NULL THEN 'insert' ELSE 'update' END AS action,
  CASE WHEN n.row_id IS NULL THEN '2000-01-01' ELSE '{RUN_DATE}' END AS touched
FROM cur AS c FULL JOIN new AS n ON n.row_id = c.row_id""",
        "positions",
    ),
)
def companies_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "positions")
    old = F.lit("2000-01-01").cast("timestamp")
    current = (
        df.where("size % 2 = 0").select(F.concat(F.lit("r"), C("seq")).alias("row_id"), F.concat(F.lit("Old "), C("name")).alias("company_name"), C("page_key").alias("notes"))
        .unionByName(df.where("size % 5 = 0").select(F.concat(F.lit("z"), C("seq")).alias("row_id"), C("name").alias("company_name"), C("page_key").alias("notes")))
        .withColumns({"created_at": old, "updated_at": old})
    )
    new = folding.last_seen(records(spark, sf_dir), "row_id", seq="pos")
    out = companies.upsert_companies(current, new, RUN_TS)
    return out.select(
        "row_id", "company_name", "notes", "stage", F.array_join("tags", "|").alias("tags"), "action",
        F.date_format("updated_at", "yyyy-MM-dd").alias("touched"),
    )


@query(
    "jn_12_choice_names",
    "JN-12 ARR-01",
    oracle(
        """SELECT seq, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS names FROM (SELECT seq, list_transform([kind, 'PROMO', city_1],
        lambda x: CASE x WHEN 'PROMO' THEN 'Promotion' WHEN 'SMALL' THEN 'Small one' ELSE x END) AS l FROM positions) AS p""",
        "positions",
    ),
)
def choice_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "positions")
    ids = F.array("kind", F.lit(" PROMO"), "city_1")
    names = joins.resolve_choices(ids, {"PROMO": "Promotion", "SMALL": "Small one"})
    return df.select("seq", F.array_join(names, "|").alias("names"))


@query(
    "src_11_list_career_pages",
    "SRC-11",
    oracle(
        """SELECT id, company_key, company_name, scraper_site, results_wanted, 'Israel' AS country_indeed, 60 AS request_timeout, 'active' AS status
        FROM catalog WHERE enabled ORDER BY company_name, company_key""",
        "catalog",
    ),
)
def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = companies.list_pages(derived(spark, sf_dir, "catalog"))
    return pages.select(
        "id", "company_key", "company_name", "scraper_site", "results_wanted", "country_indeed", "request_timeout", "status"
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "positions")
    day = lambda n: F.date_add(F.lit("2001-01-01").cast("date"), n)
    return df.select(
        F.concat(F.lit("https://www.comeet.com/jobs/"), C("seq")).alias("base_url"), C("detail_name").alias("company_name"),
        F.when(C("size") % 3 > 0, day(C("size"))).alias("updated_at"), day(C("seq").cast("int") % 40).alias("created_at"),
    )


LINKS = """SELECT 'https://www.comeet.com/jobs/' || seq AS base_url, detail_name AS company_name, CASE WHEN size % 3 > 0 THEN DATE '2001-01-01' + size END AS updated_at,
  DATE '2001-01-01' + CAST(seq % 40 AS INT) AS created_at FROM positions"""


@query("src_12_list_base_urls", "SRC-12", oracle(f"SELECT base_url, company_name FROM ({LINKS}) AS l ORDER BY company_name NULLS LAST, base_url", "positions"))
def list_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.list_base_urls(links(spark, sf_dir)).select("base_url", "company_name")


@query(
    "src_12_get_base_url",
    "SRC-12",
    oracle(
        f"""SELECT 'newest' AS asked, base_url FROM (SELECT * FROM ({LINKS}) AS l ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST, base_url LIMIT 1) AS n
        UNION ALL SELECT 'named', base_url FROM ({LINKS}) AS l WHERE base_url = 'https://www.comeet.com/jobs/7'""",
        "positions",
    ),
)
def get_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = links(spark, sf_dir)
    newest = companies.base_url(rows).select(F.lit("newest").alias("asked"), "base_url")
    named = companies.base_url(rows, " https://www.comeet.com/jobs/7").select(F.lit("named").alias("asked"), "base_url")
    return newest.unionByName(named)


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derived(spark, sf_dir, "catalog").where("id % 3 > 0")
    at = F.when(C("id") % 4 == 0, F.lit("2000-01-01").cast("timestamp"))
    return companies.complete_pages(pages.withColumns({"activated_at": at, "status": F.lit("old")}))


def _page_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "company_key", "company_name", "location", "enabled", "status",
        F.date_format("activated_at", "yyyy-MM-dd HH:mm:ss").alias("activated"), F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated"),
    )


CURRENT = "SELECT *, CASE WHEN id % 4 = 0 THEN '2000-01-01 00:00:00' END AS activated FROM catalog WHERE id % 3 > 0"


def validated_sql(activate: bool) -> str:
    on = "TRUE" if activate else "FALSE"
    valid = "TRUE" if activate else "id % 5 > 0"
    new = f"SELECT *, {on} AS on_, {valid} AS valid FROM catalog WHERE id % 2 = 0"
    status = "CASE WHEN n.on_ THEN 'active' WHEN n.valid THEN 'valid' ELSE 'failed' END"
    return f"""
SELECT coalesce(n.company_key, c.company_key) AS company_key, CASE WHEN n.id IS NULL THEN c.company_name ELSE 'Checked ' || n.id END AS company_name,
  coalesce(n.location, CASE WHEN n.id IS NULL THEN c.location END) AS location, CASE WHEN n.id IS NULL THEN c.enabled ELSE n.on_ END AS enabled,
  CASE WHEN n.id IS NULL THEN 'old' ELSE {status} END AS status, CASE WHEN n.on_ THEN coalesce(c.activated, {NOW}) ELSE c.activated END AS activated,
  CASE WHEN n.id IS NOT NULL THEN {NOW} END AS updated FROM ({CURRENT}) AS c FULL JOIN ({new}) AS n ON n.id = c.id"""


def _validated(spark: SparkSession, sf_dir: str, activate: bool) -> DataFrame:
    new = derived(spark, sf_dir, "catalog").where("id % 2 = 0")
    valid = F.lit(True) if activate else C("id") % 5 > 0
    results = new.select(
        "company_key", F.concat(F.lit("Checked "), C("id")).alias("company_name"), "location", "scraper_site", "career_page_url", valid.alias("valid")
    )
    return _page_columns(companies.upsert_validated(_current(spark, sf_dir), results, RUN_TS, activate))


@query("mrg_11_validation_upsert", "MRG-11", oracle(validated_sql(False), "catalog"))
def validation_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir, False)


@query("mrg_11_activation_upsert", "MRG-11", oracle(validated_sql(True), "catalog"))
def activation_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir, True)


@query(
    "mrg_12_guarded_seed_upsert",
    "MRG-12",
    oracle(
        f"""
WITH seeds AS (SELECT *, CASE WHEN id % 7 = 0 THEN 'Seeded ' || id ELSE company_name END AS new_name FROM catalog)
SELECT s.company_key, s.new_name AS company_name, s.location, CASE WHEN c.id IS NULL THEN s.id % 4 = 0 ELSE c.enabled END AS enabled,
  CASE WHEN c.id IS NOT NULL THEN 'old' WHEN s.id % 4 = 0 THEN 'active' ELSE 'disabled' END AS status,
  CASE WHEN c.id IS NOT NULL THEN c.activated WHEN s.id % 4 = 0 THEN {NOW} END AS activated,
  CASE WHEN c.id IS NULL OR s.id % 7 = 0 THEN {NOW} END AS updated FROM seeds AS s LEFT JOIN ({CURRENT}) AS c ON c.id = s.id""",
        "catalog",
    ),
)
def seed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(C("id") % 7 == 0, F.concat(F.lit("Seeded "), C("id"))).otherwise(C("company_name"))
    seeds = derived(spark, sf_dir, "catalog").select(
        "company_key", name.alias("company_name"), "company_aliases", "scraper_site", "career_page_url", "location",
        "results_wanted", (C("id") % 4 == 0).alias("enabled"),
    )
    return _page_columns(companies.upsert_seeds(_current(spark, sf_dir), seeds, RUN_TS))
