"""Queries over record mapping: routing, the twelve builders, rejects, output rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.operators import output, records
from postline.plans.derive import derived, oracle
from postline.plans.registry import query

# The rules again, written as DuckDB SQL over the postings view.
BLANK = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '"


def clean(c: str) -> str:
    return f"nullif(trim({c}, {BLANK}), '')"


def rx(c: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({c}, '{pattern}', {group}), '')"


SCHEME = "lower(regexp_extract({c}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"
HOST = "regexp_extract({c}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
PATH = "regexp_extract({c}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
QUERY = "regexp_extract({c}, '^[^?#]*[?]([^#]*)', 1)"


def parts(prefix: str, c: str) -> str:
    text = clean(c)
    return ", ".join(
        [f"{text} AS {prefix}_text"]
        + [f"{t.format(c=text)} AS {prefix}_{n}" for n, t in
           (("scheme", SCHEME), ("host", HOST), ("path", PATH), ("query", QUERY))]
    )


ROUTE = f"lower(coalesce({clean('site')}, {clean('source')}, 'linkedin'))"
DATE = (
    "CASE WHEN regexp_full_match(dt, '[0-9]{4}-[0-9]{2}-[0-9]{2}(T.*)?') THEN try_cast(substr(dt, 1, 10) AS DATE) "
    "WHEN regexp_full_match(dt, '[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}') THEN try_cast(replace(dt, '/', '-') AS DATE) END"
)
# min/max amounts are at most six digits, so a cast writes them without exponent.
SALARY = (
    f"nullif(concat_ws(' ', {clean('currency')}, "
    "CASE WHEN min_amount IS NOT NULL AND max_amount IS NOT NULL THEN CAST(min_amount AS STRING) || ' - ' || CAST(max_amount AS STRING) "
    "ELSE CAST(coalesce(min_amount, max_amount) AS STRING) END, "
    f"{clean('pay_interval')}), '')"
)
PREPARED = (
    f"SELECT *, {ROUTE} AS route, {clean('title')} AS t, {clean('date_posted')} AS dt, "
    f"{parts('j', 'job_url')}, {parts('c', 'company_url')}, {parts('a', 'apply_url')}, "
    f"{clean('job_url_direct')} AS direct FROM postings"
)
WEB = "j_scheme IN ('http', 'https')"
HAS_HOST = f"{WEB} AND j_host <> ''"


def bare(p: str) -> str:
    return f"CASE WHEN rtrim({p}, '/') <> '' THEN rtrim({p}, '/') WHEN {p} <> '' THEN {p} ELSE '/' END"


PAGE = f"j_scheme || '://' || j_host || ({bare('j_path')})"
APPLY_PAGE = f"CASE WHEN a_scheme IN ('http', 'https') AND a_host <> '' THEN a_scheme || '://' || a_host || ({bare('a_path')}) END"
COMPANY_URL = "CASE WHEN c_scheme IN ('http', 'https') THEN rtrim(c_scheme || '://' || c_host || c_path, '/') ELSE c_text END"
COMPANY_HOST = "CASE WHEN c_scheme IN ('http', 'https') AND c_host <> '' THEN lower(c_host) ELSE c_text END"
LISTED = f"replace(replace(lower({clean('listing_type')}), '_', '-'), ' ', '-')"
WORK = f"CASE WHEN is_remote THEN 'remote' ELSE {LISTED} END"
COUNT = f"CAST(trunc(try_cast({clean('applications_count')} AS DOUBLE)) AS BIGINT)"
COMPANY = clean("company")
NAME = f"coalesce({COMPANY}, {clean('company_name')})"
INDUSTRY = clean("company_industry")
FUNCTION = clean("job_function")
STATED_ID = f"coalesce({clean('id')}, {clean('external_id')}, "
DIRECT_SOURCE = (
    f"CASE WHEN {clean('direct_company_career_page_id')} IS NOT NULL OR {clean('direct_company_career_page_key')} IS NOT NULL "
    f"THEN coalesce({clean('direct_company_career_page_company')}, {COMPANY}, {clean('company_name')}, "
    f"{clean('direct_company_career_page_key')}) END"
)


def query_key(key: str) -> str:
    return clean(f"url_decode(regexp_extract(j_query, '(^|&){key}=([^&]+)', 2))")


BOARD_APPLY = "coalesce(direct, a_text, job)"
RULES: dict[str, dict[str, str]] = {
    "linkedin": dict(
        ext=rx("j_path", "/jobs/view/(?:[^/?#]+-)?([0-9]+)"),
        ok=f"{WEB} AND contains(lower(j_host), 'linkedin.com')",
        job="'https://www.linkedin.com/jobs/view/' || ext",
        cid="CASE WHEN c_scheme IN ('http','https') THEN " + rx("c_path", "/company/([^/?#]+)") + " END",
        name=COMPANY, work="CASE WHEN is_remote THEN 'remote' END", apply="coalesce(direct, a_text)",
        kind="CASE WHEN direct IS NOT NULL THEN 'external' WHEN a_text IS NOT NULL THEN 'linkedin' END",
    ),
    "indeed": dict(
        ext=query_key("jk"), ok=f"{WEB} AND contains(lower(j_host), 'indeed.')",
        job="j_scheme || '://' || j_host || j_path || '?jk=' || ext",
        cid="CASE WHEN c_scheme IN ('http','https') THEN " + rx("c_path", "/cmp/([^/?#]+)") + " END",
        name=COMPANY, work="CASE WHEN is_remote THEN 'remote' END", apply=BOARD_APPLY,
        kind="CASE WHEN direct IS NOT NULL THEN 'external' ELSE 'indeed' END",
    ),
    "glassdoor": dict(
        ext=query_key("jl"), ok=f"{WEB} AND contains(lower(j_host), 'glassdoor.')",
        job="j_scheme || '://' || j_host || j_path || '?jl=' || ext",
        cid="CASE WHEN c_scheme IN ('http','https') THEN " + rx("c_path", "/W-EI_IE([0-9]+)[.]htm") + " END",
        name=COMPANY, work="CASE WHEN is_remote THEN 'remote' END", apply=BOARD_APPLY,
        kind="CASE WHEN direct IS NOT NULL THEN 'external' ELSE 'glassdoor' END",
    ),
    "greenhouse": dict(
        ext=f"coalesce({query_key('gh_jid')}, {rx('j_path', '/([0-9]+)/*$')})", ok=WEB,
        job=f"CASE WHEN contains(({bare('j_path')}) || '/', '/' || ext || '/') THEN {PAGE} ELSE {PAGE} || '?gh_jid=' || ext END",
        curl=f"coalesce({COMPANY_URL}, j_scheme || '://' || j_host)",
        cid=f"coalesce({COMPANY_HOST}, lower(j_host), {COMPANY})",
    ),
    "comeet": dict(
        ext="job", ok="j_scheme = 'https' AND j_host = 'www.comeet.com' AND len(list_filter(string_split(j_path, '/'), lambda x: x <> '')) >= 5",
        job="'https://www.comeet.com/' || array_to_string(list_filter(string_split(j_path, '/'), lambda x: x <> '')[1:5], '/')",
        curl="c_text",
        cid="'https://www.comeet.com/' || array_to_string(list_filter(string_split(j_path, '/'), lambda x: x <> '')[1:3], '/')",
        work=f"CASE WHEN is_remote THEN 'remote' ELSE replace(lower({clean('listing_type')}), ' ', '-') END",
        kind="CASE WHEN direct IS NOT NULL AND direct <> coalesce(a_text, job) THEN 'external' ELSE 'comeet' END",
        count=clean("applications_count"),
    ),
    "eightfold": dict(ext=f"{STATED_ID} job)", ok=HAS_HOST, job=PAGE, cid=f"coalesce({COMPANY_HOST}, {COMPANY})"),
    "microsoft": dict(
        ext=f"{STATED_ID} job)", ok=HAS_HOST, job=PAGE, cid=f"coalesce({COMPANY_HOST}, {COMPANY}, 'microsoft')"
    ),
    "workday": dict(
        ext=f"{STATED_ID} {rx('j_path', '_([^/?#]+)/*$')}, job)", ok=HAS_HOST, job=PAGE,
        cid=f"coalesce(CASE WHEN c_scheme IN ('http','https') AND c_host <> '' THEN {COMPANY_URL} ELSE c_text END, {COMPANY})",
        apply=f"coalesce({APPLY_PAGE}, job)",
    ),
    "varonis": dict(
        ext=f"{STATED_ID} {rx('j_path', '/job/([^/?#]+)')}, job)", ok=HAS_HOST, job=PAGE,
        cid=f"coalesce({COMPANY_HOST}, {COMPANY}, 'varonis')", sector=f"coalesce({FUNCTION}, {INDUSTRY})",
    ),
    "apple": dict(
        ext=f"{STATED_ID} {rx('j_path', '/details/([^/?#]+)')})",
        ok=f"{HAS_HOST} AND contains(lower(j_host), 'jobs.apple.com') AND contains(j_path, '/details/')", job=PAGE,
        curl=f"coalesce({COMPANY_URL}, 'https://jobs.apple.com')", cid=f"coalesce({COMPANY_HOST}, 'jobs.apple.com')",
        apply=f"coalesce(CASE WHEN contains(lower(a_host), 'jobs.apple.com') AND regexp_matches(a_path, '/details/[^/?#]+') THEN {APPLY_PAGE} END, job)",
        sector=f"coalesce({FUNCTION}, {INDUSTRY})",
    ),
    "meta": dict(
        ext=rx("j_path", "/jobs/([0-9]+)"), ok=f"{WEB} AND lower(j_host) = 'www.metacareers.com'",
        job="'https://www.metacareers.com/jobs/' || ext || '/'",
        curl=f"coalesce({COMPANY_URL}, 'https://www.metacareers.com')",
        cid=f"coalesce({COMPANY_HOST}, 'www.metacareers.com')", work=clean("listing_type"), sector=FUNCTION,
    ),
    "json_feed": dict(
        ext=f"{STATED_ID} job)", ok=HAS_HOST,
        job=f"{PAGE} || CASE WHEN j_query <> '' THEN '?' || j_query ELSE '' END",
        cid=f"coalesce({COMPANY_HOST}, {COMPANY}, 'json_feed')",
        apply=f"coalesce({APPLY_PAGE} || CASE WHEN a_query <> '' THEN '?' || a_query ELSE '' END, job)",
        sector=f"coalesce({FUNCTION}, {INDUSTRY})",
    ),
}
SHOWN = [c for c in records.RECORD_COLUMNS if c not in ("raw_json", "poster_full_name", "poster_profile_url", "benefits")]


def record_sql(name: str) -> str:
    r = RULES[name]
    routes = "('workday', 'redhat')" if name == "workday" else f"('{name}')"
    # The id reads the link for some sources and the link reads the id for others.
    first, second = ("job", "ext") if "job" in r["ext"].split("'")[-1] or r["ext"].endswith("job)") or r["ext"] == "job" else ("ext", "job")
    steps = (
        f"SELECT *, {r[first]} AS {first} FROM (SELECT * FROM ({PREPARED}) AS p "
        f"WHERE route IN {routes} AND t IS NOT NULL AND {r['ok']}) AS q"
    )
    body = f"SELECT *, {r[second]} AS {second} FROM ({steps}) AS s"
    return f"""
SELECT seq, t AS title, {clean('location')} AS location, dt AS posted_time, {DATE} AS published_at, job AS job_url,
  {r.get('name', NAME)} AS company_name, {r.get('curl', COMPANY_URL)} AS company_url, {r['cid']} AS company_id,
  {clean('description')} AS description, CAST({r.get('count', COUNT)} AS STRING) AS applications_count,
  {clean('job_type')} AS contract_type, {clean('job_level')} AS experience_level, {r.get('work', WORK)} AS work_type,
  {r.get('sector', INDUSTRY)} AS sector, {SALARY} AS salary, {r.get('apply', 'coalesce(a_text, job)')} AS apply_url,
  {r.get('kind', "'external'")} AS apply_type, coalesce({DIRECT_SOURCE}, '{name}') AS source, ext AS external_id
FROM ({body}) AS r WHERE ext IS NOT NULL AND job IS NOT NULL"""


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.map_records(derived(spark, sf_dir, "postings"), payload=F.lit(None))


def _register(name: str, op: str) -> None:
    @query(f"{op.lower().replace('-', '_')}_{name}_record", f"{op} URL-01 URL-02", oracle(record_sql(name), "postings"))
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = derived(spark, sf_dir, "postings")
        names = ("workday", "redhat") if name == "workday" else (name,)
        mine = raw.where(records.detect_source(F.col("site"), F.col("source")).isin(*names))
        return records.valid_records(records.map_records(mine, payload=F.lit(None))).select("seq", *SHOWN)


for _name, _op in {
    "linkedin": "PRJ-03", "indeed": "PRJ-04", "glassdoor": "PRJ-05", "greenhouse": "PRJ-06", "comeet": "PRJ-07",
    "eightfold": "PRJ-08", "workday": "PRJ-09", "varonis": "PRJ-10", "apple": "PRJ-11", "microsoft": "PRJ-12",
    "meta": "PRJ-13", "json_feed": "PRJ-14",
}.items():
    _register(_name, _op)


@query(
    "prj_02_route_by_source",
    "PRJ-02 FLT-08",
    oracle(f"SELECT {ROUTE} AS route, count(*) AS n FROM postings GROUP BY 1", "postings"),
)
def route_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived(spark, sf_dir, "postings")
    return raw.groupBy(records.detect_source(F.col("site"), F.col("source")).alias("route")).agg(F.count("*").alias("n"))


VALID = " UNION ALL ".join(f"SELECT seq, job_url FROM ({record_sql(n)}) AS x" for n in RULES)
KNOWN = ", ".join(f"'{n}'" for n in [*RULES, "redhat"])


@query(
    "flt_01_valid_record_counts",
    "FLT-01 DQ-02",
    oracle(
        f"""
WITH good AS ({VALID}), prepared AS ({PREPARED}),
bad AS (SELECT CASE WHEN route NOT IN ({KNOWN}) THEN 'unsupported_source' WHEN t IS NULL THEN 'missing_title'
        ELSE 'invalid_url' END AS reason FROM prepared WHERE seq NOT IN (SELECT seq FROM good))
SELECT reason, count(*) AS n FROM bad GROUP BY 1
UNION ALL SELECT 'duplicate_input', count(*) - count(DISTINCT job_url) FROM good""",
        "postings",
    ),
)
def valid_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.count_rejects(_mapped(spark, sf_dir))


def upper_titles(raw: DataFrame) -> DataFrame:
    """A builder of one's own: titles in capitals, everything else as the specs say."""
    return records.map_records(raw, payload=F.lit(None)).withColumn("title", F.upper("title"))


@query(
    "ext_02_own_record_builder",
    "EXT-02 PRJ-02",
    oracle(" UNION ALL ".join(f"SELECT seq, upper(title) AS title, job_url, source FROM ({record_sql(n)}) AS r" for n in RULES), "postings"),
)
def own_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = records.build_records(derived(spark, sf_dir, "postings"), upper_titles)
    return built.select("seq", "title", "job_url", "source")


@query(
    "prj_15_direct_page_source",
    "PRJ-15",
    oracle(f"SELECT seq, {DIRECT_SOURCE} AS source FROM postings WHERE {DIRECT_SOURCE} IS NOT NULL", "postings"),
)
def direct_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived(spark, sf_dir, "postings")
    named = raw.select("seq", records.direct_page_source(F.col).alias("source"))
    return named.where(F.col("source").isNotNull())


@query(
    "prj_16_stamp_provenance",
    "PRJ-16 JN-13",
    oracle(
        f"""
SELECT p.seq, p.page_key, CAST(c.id AS STRING) AS direct_company_career_page_id, c.company_key AS direct_company_career_page_key,
  c.company_name AS direct_company_career_page_company, coalesce({clean('c.company_name')}, {clean('c.company_key')}) AS source,
  'north' AS search_shard, TRUE AS search_is_remote
FROM positions AS p LEFT JOIN catalog AS c ON c.company_key = p.page_key""",
        "positions", "catalog",
    ),
)
def stamp_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(spark, sf_dir, "positions").select("seq", "page_key", F.lit("x").alias("source"))
    stamped = records.stamp_from_catalog(rows, derived(spark, sf_dir, "catalog"))
    return records.stamp(stamped, search_shard="north", search_is_remote=True)




@query(
    "prj_01_align_output_schema",
    "PRJ-01 SET-01 ORD-01",
    oracle(
        f"""
SELECT src.site, id, job_url, title, company, location, date_posted, job_type, emails, description, is_remote, skills, listing_type
FROM (SELECT CASE WHEN cust % 16 < 5 THEN 'linkedin' ELSE 'other' END AS site, 'p' || seq AS id, job_url, {clean('title')} AS title,
   {COMPANY} AS company, 'City' || cust % 50 || ', ' || CASE WHEN cust % 3 = 0 THEN 'USA' WHEN cust % 3 = 1 THEN 'Germany' ELSE 'Narnia' END AS location,
   {DATE} AS date_posted,
   CASE WHEN price % 2 = 0 THEN 'fulltime, contract' END AS job_type,
   CASE WHEN price % 8 = 0 AND seq % 14 > 1 THEN 'jobs' || cust % 20 || '@acme.example.com, hr@acme.co.il' END AS emails, description,
   CASE WHEN cust % 16 < 5 THEN is_remote END AS is_remote, CASE WHEN cust % 16 >= 5 THEN 'sql, spark' END AS skills,
   CASE WHEN cust % 16 < 5 THEN listing_type END AS listing_type
   FROM (SELECT *, {clean('date_posted')} AS dt FROM postings) AS p) AS src""",
        "postings",
    ),
)
def align_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.functions.dates import parse_date
    from postline.functions.location import place
    from postline.functions.text import clean_text, extract_emails

    raw = derived(spark, sf_dir, "postings")
    country = F.when(F.col("cust") % 3 == 0, "usa").when(F.col("cust") % 3 == 1, "germany").otherwise("Narnia")
    posts = raw.select(
        "cust",
        F.concat(F.lit("p"), F.col("seq")).alias("id"),
        "job_url",
        clean_text(F.col("title")).alias("title"),
        clean_text(F.col("company")).alias("company_name"),
        place(F.concat(F.lit("City"), F.col("cust") % 50), None, country).alias("location"),
        parse_date(F.col("date_posted")).alias("date_posted"),
        F.when(F.col("price") % 2 == 0, F.array(F.lit("fulltime"), F.lit("contract"))).alias("job_type"),
        extract_emails(F.col("description")).alias("emails"),
        "description",
        "is_remote",
        "listing_type",
    )
    board = posts.where(F.col("cust") % 16 < 5).withColumn("site", F.lit("linkedin"))
    other = (
        posts.where(F.col("cust") % 16 >= 5)
        .drop("is_remote", "listing_type")
        .withColumn("site", F.lit("other"))
        .withColumn("skills", F.array(F.lit("sql"), F.lit("spark")))
    )
    rows = output.order_results(output.align(output.union_sources([board, other])))
    return rows.select(
        "site", "id", "job_url", "title", "company", "location", "date_posted", "job_type", "emails", "description",
        "is_remote", "skills", "listing_type",
    )
