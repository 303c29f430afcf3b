"""Queries over predicates, orders, limits and row numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.functions import text
from postline.functions.location import display_location, nested_place
from postline.operators import filters, output, skew
from postline.plans.derive import RUN_DATE, derived, oracle
from postline.plans.records import DATE, clean
from postline.plans.registry import query, table

C = F.col
RULES = (
    {"path": "title", "exists": True},
    {"path": "location", "contains": " NY"},
    {"path": "job_type", "equals": ["FULLTIME", "full-time, contract ", "teil zeit"]},
    {"path": "cust", "in": [4, 8, 100, 104, 200, 304, 508, 1000, 1004, 1408]},
    {"path": "job_level", "exists": False},
)


@query(
    "flt_02_config_predicates",
    "FLT-02",
    oracle(
        f"""SELECT seq FROM postings WHERE title <> '' AND contains(lower({clean('location')}), 'ny')
        AND lower({clean('job_type')}) IN ('fulltime', 'full-time, contract', 'teil zeit') AND cust IN (4, 8, 100, 104, 200, 304, 508, 1000, 1004, 1408)
        AND job_level IS NULL""",
        "postings",
    ),
)
def config_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings")
    return df.where(filters.compile_filters(RULES, lambda p: C(p).cast("string"))).select("seq")


@query(
    "flt_03_location_filter",
    "FLT-03",
    oracle(
        "SELECT seq FROM postings WHERE contains(lower(location), 'israel') OR contains(lower(description), 'israel')", "postings"
    ),
)
def location_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings")
    return df.where(filters.location_filter(" Israel", [C("location"), C("description")])).select("seq")


@query(
    "flt_04_country_aliases",
    "FLT-04",
    oracle("SELECT seq FROM postings WHERE regexp_matches(lower(location), '(^|[^a-z])(usa|us|united states)([^a-z]|$)')", "postings"),
)
def country_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings").withColumn("none", F.lit(None).cast("string"))
    return filters.by_country(df, "USA", ["location", "none"]).select("seq")


@query(
    "flt_05_explode_matching_places",
    "FLT-05 LOC-02",
    oracle(
        """
WITH places AS (SELECT seq, 1 AS i, city_1 AS city, country_1 AS country, parent_city, parent_country FROM positions
  UNION ALL SELECT seq, 2, city_2, country_2, parent_city, parent_country FROM positions),
hits AS (SELECT seq, city, parent_city FROM places WHERE country = 'israel')
SELECT seq, coalesce(city, parent_city) || ', Israel' AS shown FROM hits
UNION ALL SELECT seq, parent_city || ', Israel' FROM positions WHERE parent_country = 'israel' AND seq NOT IN (SELECT seq FROM hits)""",
        "positions",
    ),
)
def explode_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "positions")
    nested = [
        F.struct(C(f"city_{i}").alias("city"), F.lit(None).cast("string").alias("state"), C(f"country_{i}").alias("country"))
        for i in (1, 2)
    ]
    df = df.select("seq", F.array(*nested).alias("places"), "parent_city", "parent_country")
    hit = filters.explode_matching(df, "places", "parent_country", "israel")
    parent = F.struct(C("parent_city").alias("city"), C("parent_country").alias("country"))
    return hit.select("seq", display_location(nested_place(C("place"), parent, "israel")).alias("shown"))


@query(
    "flt_06_recency_window",
    "FLT-06",
    oracle(
        f"""SELECT seq, source FROM postings WHERE CAST(odate AS TIMESTAMP) >= TIMESTAMP '2001-07-30 12:00:00'
        - to_seconds(CASE WHEN source = 'zip_recruiter' THEN 2 * 86400 WHEN source = 'naukri' THEN 2 * 86400 ELSE 60 * 3600 END)""",
        "postings",
    ),
)
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings")
    return filters.recent(df, "odate", "2001-07-30 12:00:00", 60, "source").select("seq", "source")


@query(
    "flt_07_exclusive_filters",
    "FLT-07",
    oracle(
        """SELECT seq, 'age' AS branch FROM postings WHERE odate >= DATE '2001-07-30' - 2
        UNION ALL SELECT seq, 'apply' FROM postings WHERE apply_url IS NULL
        UNION ALL SELECT seq, 'type' FROM postings WHERE contains(job_type, 'fulltime') AND is_remote""",
        "postings",
    ),
)
def exclusive_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings").select(
        "seq", C("odate").alias("date_posted"), C("apply_url").isNull().alias("easy_apply"), "job_type", "is_remote"
    )
    options = {
        "age": dict(hours_old=30, easy_apply=True, remote=True, run_date="2001-07-30"),
        "apply": dict(easy_apply=True, job_type="fulltime"),
        "type": dict(job_type="fulltime", remote=True),
    }
    parts = [df.where(filters.board_filter(**o)).select("seq", F.lit(b).alias("branch")) for b, o in options.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "flt_08_source_selection",
    "FLT-08",
    oracle(
        """SELECT 'default' AS choice, source, count(*) AS n FROM postings WHERE source IN ('linkedin', 'indeed', 'zip_recruiter', 'glassdoor', 'google', 'bayt', 'naukri', 'bdjobs') GROUP BY 2
        UNION ALL SELECT 'named', source, count(*) FROM postings WHERE source IN ('zip_recruiter', 'json_feed') GROUP BY 2""",
        "postings",
    ),
)
def source_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings")

    def count(choice: str, wanted: list[str] | None) -> DataFrame:
        chosen = filters.from_sources(df, wanted, "source")
        return chosen.groupBy(F.lit(choice).alias("choice"), "source").agg(F.count("*").alias("n"))

    return count("default", None).unionByName(count("named", ["Zip-Recruiter", "json feed"]))


@query(
    "flt_11_direct_page_test",
    "FLT-11",
    oracle(
        """SELECT id, p_tag IS NOT NULL AS direct FROM stored""",
        "stored",
    ),
)
def direct_page_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.operators.records import is_direct_page, json_text

    df = derived(spark, sf_dir, "stored")
    made = F.create_map(
        F.lit("direct_company_career_page_key"), F.coalesce(json_text(C("p_tag")), F.lit("null")),
        F.lit("direct_company_career_page_id"), F.lit('"  "'),
    )
    return df.select("id", is_direct_page(made).alias("direct"))


@query(
    "win_03_description_budget",
    "WIN-03",
    oracle(
        """SELECT seq, source, CASE WHEN rn <= 40 THEN description END AS description
        FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq) AS rn FROM postings) AS p""",
        "postings",
    ),
)
def description_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings").select("seq", "source", "description")
    return skew.budget(df, "source", "description", 40)


@query(
    "win_04_offset_limit_per_source",
    "WIN-04 ORD-03",
    oracle(
        """SELECT seq, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq) AS rn FROM postings) AS p
        WHERE rn > 100 AND rn <= 350""",
        "postings",
    ),
)
def offset_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings").select("seq", "source")
    return skew.slice_within(df, "source", 100, 250)


@query(
    "ord_03_target_counts",
    "ORD-03",
    oracle(
        """SELECT source, least(greatest(count(*) - 200, 0), 600) AS wanted, greatest(count(*) - 200, 0) AS all_rest FROM postings GROUP BY 1""",
        "postings",
    ),
)
def target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings")
    return skew.target_counts(df, "source", 200, 600)


@query(
    "ord_04_preview",
    "ORD-04",
    oracle(
        f"SELECT site, title, company, location, date_posted, job_url FROM postings ORDER BY seq LIMIT 20", "postings"
    ),
)
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.preview(derived(spark, sf_dir, "postings"), [C("seq")])


@query(
    "ord_05_sample_with_cut",
    "ORD-05",
    """SELECT doc_id, CASE WHEN length(text) > 2000 THEN rtrim(substr(text, 1, 2000), chr(10) || ' ') || '...[truncated]' ELSE text END AS text,
    CASE WHEN length(text) > 800 THEN rtrim(substr(text, 1, 800), chr(10) || ' ') || '...[truncated]' ELSE text END AS description
    FROM documents ORDER BY doc_id LIMIT 25""",
)
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", "text", C("text").alias("description"))
    return output.sample(df, [C("doc_id")], 25)


@query(
    "ord_01_result_order",
    "ORD-01",
    oracle(f"SELECT site, date_posted, seq FROM (SELECT source AS site, {DATE} AS date_posted, seq FROM (SELECT *, {clean('date_posted')} AS dt FROM postings) AS p) AS q ORDER BY 1, 2 DESC NULLS LAST", "postings"),
)
def result_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.functions.dates import parse_date

    df = derived(spark, sf_dir, "postings")
    rows = df.select(C("source").alias("site"), parse_date(C("date_posted")).alias("date_posted"), "seq")
    return output.order_results(rows)


@query(
    "set_02_direct_then_board",
    "SET-02 SET-01",
    oracle(
        """SELECT seq, title, CAST(NULL AS STRING) AS site, direct_company_career_page_key AS page, 0 AS priority FROM postings WHERE direct_company_career_page_key IS NOT NULL
        UNION ALL SELECT seq, title, site, NULL, 1 FROM postings WHERE direct_company_career_page_key IS NULL""",
        "postings",
    ),
)
def direct_then_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings")
    direct = df.where(C("direct_company_career_page_key").isNotNull())
    board = df.where(C("direct_company_career_page_key").isNull())
    both = output.union_in_order(
        [direct.select("seq", "title", C("direct_company_career_page_key").alias("page")), board.select("seq", "title", "site")]
    )
    return both.orderBy("priority", "seq")


@query(
    "jn_10_fallback_merge",
    "JN-10 FLT-09",
    oracle(
        f"SELECT seq, CASE WHEN {clean('title')} IS NULL THEN source ELSE title END AS title, CASE WHEN {clean('description')} IS NULL AND job_function IS NOT NULL THEN job_function ELSE description END AS description FROM postings",
        "postings",
    ),
)
def fallback_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.operators.joins import fill_missing

    df = derived(spark, sf_dir, "postings")
    return df.select(
        "seq",
        fill_missing(C("title"), C("source")).alias("title"),
        fill_missing(C("description"), C("job_function")).alias("description"),
    )
