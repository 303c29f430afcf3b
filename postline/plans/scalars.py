"""Queries over the scalar rules: text, URL, date, number, pay, job, place, JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.functions import dates, jobs, location, lookups, money, payload, text, url
from postline.operators import records
from postline.plans.derive import GIVEN, RUN_DATE, derived, oracle
from postline.plans.records import DATE, HOST, KNOWN, PATH, QUERY, RULES, SALARY, SCHEME, clean, parts, record_sql, rx
from postline.plans.registry import query, table
from postline.session import spread

Columns = Callable[[], dict[str, Column]]
C = F.col


def project(
    name: str, covers: str, source: str, columns: Columns, sql: str | None, key: str = "seq",
    fields: dict[str, str] | None = None,
) -> None:
    """Register a row-by-row query: key plus columns over one derived or given table.

    With `fields` (output name -> field of a struct column) the structs are
    made in a first projection, so that each is computed once.
    """
    sql_text = None
    if sql is not None:
        sql_text = sql if source in GIVEN else oracle(sql, source)

    @query(name, covers, sql_text)
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, source) if source in GIVEN else derived(spark, sf_dir, source)
        if source == "part":  # its rows are made into pages
            df = spread(df)
        made = df.select(key, *[v.alias(k) for k, v in columns().items()])
        return made if fields is None else made.select(key, *[C(path).alias(out) for out, path in fields.items()])


def title_sql(c: str) -> str:
    return (
        "array_to_string(list_transform(regexp_extract_all(" + c + ", '[\\p{L}]+|[^\\p{L}]+'), "
        "lambda w: upper(w[1:1]) || lower(w[2:])), '')"
    )


def first_of_equals(c: str) -> str:
    """Keep the first of equal list items, in order."""
    return f"list_filter({c}, lambda x, i: list_position({c}, x) = i)"


project(
    "str_01_clean_text", "STR-01 FLT-09", "postings",
    lambda: {
        "title": text.clean_text(C("title")),
        "description": text.clean_text(C("description")),
        "has_listing": F.coalesce(text.meaningful(C("listing_type")), F.lit(False)),
        "has_remote": text.meaningful(C("is_remote"), "boolean"),
    },
    f"""SELECT seq, {clean('title')} AS title, {clean('description')} AS description,
        {clean('listing_type')} IS NOT NULL AS has_listing, is_remote IS NOT NULL AS has_remote FROM postings""",
)
project(
    "str_02_match_key", "STR-02", "postings",
    lambda: {"match_key": text.match_key(C("company"))},
    f"SELECT seq, lower(regexp_replace({clean('company')}, '\\s+', ' ', 'g')) AS match_key FROM postings",
)
LISTED = f"list_filter(list_transform(string_split(company_aliases, ','), lambda x: {clean('x')}), lambda x: x IS NOT NULL)"
project(
    "str_03_text_list", "STR-03 ARR-01", "catalog",
    lambda: {"aliases": F.array_join(text.to_text_list(C("company_aliases")), "|")},
    f"SELECT id, array_to_string({first_of_equals(LISTED)}, '|') AS aliases FROM catalog",
    key="id",
)
MAILS = f"regexp_extract_all(description, '{text.EMAIL}')"
project(
    "str_04_extract_emails", "STR-04", "postings",
    lambda: {
        "emails": F.array_join(text.extract_emails(C("description")), ", "),
        "with_stated": F.array_join(text.extract_emails(C("description"), F.lit("hr@acme.co.il")), ", "),
    },
    f"""SELECT seq, array_to_string({MAILS}, ', ') AS emails,
        CASE WHEN contains(description, 'jobs') AND contains(description, '@') THEN 'hr@acme.co.il, ' || regexp_extract(description, '{text.EMAIL}')
             ELSE 'hr@acme.co.il' END AS with_stated FROM postings""",
)
project(
    "str_04_document_emails", "STR-04", "documents",
    lambda: {"emails": F.array_join(text.extract_emails(C("text")), ", ")},
    f"SELECT doc_id, array_to_string(regexp_extract_all(text, '{text.EMAIL}'), ', ') AS emails FROM documents",
    key="doc_id",
)
def tagged(*pieces: str | Column) -> Column:
    """HTML from literals and escaped column texts."""
    out = []
    for p in pieces:
        c = F.lit(p) if isinstance(p, str) else p
        if not isinstance(p, str):
            for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&#62;"), ("'", "&apos;")):
                c = F.replace(c, F.lit(plain), F.lit(entity))
        out.append(c)
    return F.concat(*out)


BOTH = "p_brand || ' <&> ' || p_size"
both = lambda: F.concat(C("p_brand"), F.lit(" <&> "), C("p_size").cast("string"))
sheet = lambda: tagged(
    "<style>b {x:y}</style><h2>", C("p_name"), "</h2><p>A <b>", both(), "</b>\n  <i>of</i> <a href='/p'>", C("p_type"), "</a></p>",
    "<ul><li>", C("p_brand"), "</li><li>", both(), "</li></ul><script>no()</script>",
)
SHEET_PLAIN = f"p_name || ' A ' || {BOTH} || ' of ' || p_type || ' ' || p_brand || ' ' || {BOTH}"
SHEET_MARKDOWN = f"""'## ' || p_name || chr(10) || chr(10) || 'A **' || {BOTH} || '** *of* [' || p_type || '](/p)' || chr(10) || chr(10)
    || '* ' || p_brand || chr(10) || '* ' || {BOTH}"""
SHEET_HTML = f"""'<style>b {{x:y}}</style><h2>' || p_name || '</h2><p>A <b>' || {BOTH} || '</b>' || chr(10) || '  <i>of</i> <a href=''/p''>' || p_type
    || '</a></p><ul><li>' || p_brand || '</li><li>' || {BOTH} || '</li></ul><script>no()</script>'"""
project(
    "str_05_html_unescape", "STR-05", "documents",
    lambda: {"text": text.html_unescape(tagged(C("text"))), "named": text.html_unescape(F.concat(C("lang"), F.lit("&nbsp;&eacute;&#x41;&#66;&unknown;")))},
    "SELECT doc_id, text, lang || chr(160) || 'éAB&unknown;' AS named FROM documents", key="doc_id",
)
project("str_06_html_to_plain", "STR-06", "part", lambda: {"plain": text.html_to_plain(sheet())}, f"SELECT p_partkey, {SHEET_PLAIN} AS plain FROM part", key="p_partkey")
project(
    "str_07_html_to_markdown", "STR-07", "part", lambda: {"markdown": text.html_to_markdown(sheet())},
    f"SELECT p_partkey, {SHEET_MARKDOWN} AS markdown FROM part", key="p_partkey",
)
project(
    "str_08_format_description", "STR-08", "part",
    lambda: {
        "plain": text.format_description(F.concat(F.lit("<p>"), C("p_name"), F.lit("</p> and &lt;b&gt;"), C("p_type"), F.lit("&lt;/b&gt;")), "plain"),
        "markdown": text.format_description(F.concat(F.lit("<p>"), C("p_name"), F.lit("</p> and &lt;b&gt;"), C("p_type"), F.lit("&lt;/b&gt;")), "markdown"),
        "html": text.format_description(F.concat(F.lit("<p>"), C("p_name"), F.lit("</p> &amp; "), C("p_type")), "html"),
        "untagged": text.format_description(F.concat(C("p_name"), F.lit(" &amp; 1 < 2 "))),
        "escaped": text.format_description(F.concat(C("p_name"), F.lit(" &amp; 1 < 2 ")), "html"),
        "none": text.format_description(F.when(C("p_size") % 2 == 0, C("p_name"))),
    },
    """SELECT p_partkey, p_name || ' and ' || p_type AS plain, p_name || chr(10) || chr(10) || 'and **' || p_type || '**' AS markdown,
    '<p>' || p_name || '</p> & ' || p_type AS html, p_name || ' & 1 < 2' AS untagged, p_name || ' &amp; 1 &lt; 2' AS escaped,
    CASE WHEN p_size % 2 = 0 THEN p_name END AS none FROM part""",
    key="p_partkey",
)
project(
    "str_09_join_sections", "STR-09", "postings",
    lambda: {
        "body": text.sections(
            [("About", C("description")), (None, C("job_level")), ("Team", C("job_function"))], "markdown"
        ),
        "html": text.sections([("About", C("description")), ("Team", C("job_function"))], "html"),
    },
    f"""SELECT seq, nullif(concat_ws(chr(10) || chr(10), '### About' || chr(10) || chr(10) || {clean('description')}, {clean('job_level')},
        '### Team' || chr(10) || chr(10) || {clean('job_function')}), '') AS body,
        nullif(concat_ws(chr(10), '<h3>About</h3>' || {clean('description')}, '<h3>Team</h3>' || {clean('job_function')}), '') AS html
        FROM postings""",
)
project(
    "str_10_template", "STR-10", "postings",
    lambda: {
        "made": text.template(
            "https://x.org/{jid}/{level}?c={cust}", {"jid": C("jid"), "level": C("job_level"), "cust": C("cust")}
        )
    },
    "SELECT seq, 'https://x.org/' || jid || '/' || coalesce(job_level, '') || '?c=' || cust AS made FROM postings",
)
project(
    "str_11_slug_and_snake", "STR-11", "postings",
    lambda: {"slug": text.slug(F.coalesce(C("company"), F.lit("--"))), "snake": text.snake_name(C("company_industry"))},
    """SELECT seq, coalesce(nullif(trim(regexp_replace(lower(coalesce(company, '--')), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'company') AS slug,
        nullif(trim(regexp_replace(lower(company_industry), '[^a-z0-9]+', '_', 'g'), '_'), '') AS snake FROM postings""",
)
project(
    "str_12_work_type", "STR-12", "postings",
    lambda: {
        "work_type": text.work_type(C("is_remote"), C("listing_type")),
        "spaces_only": text.work_type(C("is_remote"), C("listing_type"), " "),
    },
    f"""SELECT seq, CASE WHEN is_remote THEN 'remote' ELSE replace(replace(lower({clean('listing_type')}), '_', '-'), ' ', '-') END AS work_type,
        CASE WHEN is_remote THEN 'remote' ELSE replace(lower({clean('listing_type')}), ' ', '-') END AS spaces_only FROM postings""",
)
SKILLS = f"list_filter(list_transform(regexp_split_to_array({clean('job_type')}, '[,;]\\s*'), lambda x: {clean('x')}), lambda x: x IS NOT NULL)"
project(
    "str_13_split_skills", "STR-13", "postings",
    lambda: {"skills": F.array_join(text.split_skills(C("job_type")), "|")},
    f"SELECT seq, array_to_string({first_of_equals(SKILLS)}, '|') AS skills FROM postings",
)
INDUSTRY = "replace(replace(company_industry, 'Iv1', ''), '_', ' ')"
project(
    "str_14_industry_label", "STR-14", "postings",
    lambda: {"industry": text.industry_label(C("company_industry"))},
    f"SELECT seq, trim({title_sql(INDUSTRY)}) AS industry FROM postings",
)
project(
    "str_15_repair_mojibake", "STR-15", "documents",
    lambda: {
        "read_again": text.repair_mojibake(F.decode(F.encode(C("text"), "UTF-8"), "ISO-8859-1")),
        "quotes": text.repair_mojibake(F.concat(F.lit("â€œ"), C("lang"), F.lit("â€\u009d â€™ â€“ Ã©"))),
        "right": text.repair_mojibake(C("text")),
        "mixed": text.repair_mojibake(F.concat(C("lang"), F.lit(" Ã© 漢 â"))),
    },
    f"""SELECT doc_id, {clean('text')} AS read_again, '“' || lang || '” ’ – é' AS quotes, {clean('text')} AS right, lang || ' Ã© 漢 â' AS mixed FROM documents""",
    key="doc_id",
)
project(
    "str_16_applicant_count", "STR-16", "postings",
    lambda: {
        "whole": text.applicant_count(F.concat(C("price").cast("string"), F.lit(",100  Applicants "))),
        "inside": text.applicant_count(F.concat(F.lit("Now "), C("cust").cast("string"), F.lit(" people  clicked apply!"))),
        "none": text.applicant_count(C("applications_count")),
    },
    "SELECT seq, CAST(price || '100' AS BIGINT) AS whole, cust AS inside, CAST(NULL AS BIGINT) AS none FROM postings",
)
DOMAIN = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1))"
project(
    "str_17_company_name_from_url", "STR-17", "pages",
    lambda: {
        "name": text.company_name_from_url(url.split_url(C("url")).host),
        "domain": text.domain_without_prefix(url.split_url(C("url")).host),
        "label": text.domain_label(text.domain_without_prefix(url.split_url(C("url")).host)),
    },
    f"""SELECT page_id, {title_sql("replace(replace(list_filter(string_split(h, '.'), lambda x: x <> '' AND x <> 'www')[1], '-', ' '), '_', ' ')")} AS name,
        d AS domain, nullif({title_sql("replace(string_split(d, '.')[1], '-', ' ')")}, '') AS label
        FROM (SELECT *, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS h,
              CASE WHEN regexp_matches({DOMAIN}, '^(apply|careers?|jobs)[.][^.]+[.]') THEN regexp_replace({DOMAIN}, '^[a-z]+[.]', '') ELSE {DOMAIN} END AS d
              FROM pages) AS p""",
    key="page_id",
)
project(
    "str_18_strip_attributes", "STR-18", "pages",
    lambda: {"html": text.strip_attributes(C("html"), "div")},
    "SELECT page_id, regexp_replace(html, '(?s)^(.*?<div)\\s[^>]*>', '\\1>') AS html FROM pages",
    key="page_id",
)


def _source() -> Column:
    return records.detect_source(C("site"), C("source"))


project(
    "url_01_canonical_link_parts", "URL-01", "postings",
    lambda: {
        "scheme": url.split_url(C("job_url")).scheme,
        "host": url.split_url(C("job_url")).host,
        "page": url.page_url(url.split_url(C("job_url"))),
        "jk": url.split_url(C("job_url")).param("jk"),
    },
    f"""SELECT seq, j_scheme AS scheme, j_host AS host,
        CASE WHEN j_scheme <> '' THEN j_scheme || '://' || j_host || coalesce(nullif(rtrim(j_path, '/'), ''), nullif(j_path, ''), '/') END AS page,
        nullif(url_decode(regexp_extract(j_query, '(^|&)jk=([^&]+)', 2)), '') AS jk
        FROM (SELECT seq, {parts('j', 'job_url')} FROM postings) AS p""",
)


@query(
    "url_01_canonical_link_and_id",
    "URL-01",
    oracle(" UNION ALL ".join(f"SELECT seq, job_url AS link, external_id FROM ({record_sql(n)}) AS r" for n in RULES), "postings"),
)
def canonical_link_and_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link and id of every row that makes a record, over all sources."""
    mapped = records.map_records(derived(spark, sf_dir, "postings"), payload=F.lit(None))
    return records.valid_records(mapped).select("seq", C("job_url").alias("link"), "external_id")


project(
    "url_02_canonical_company_link", "URL-02", "postings",
    lambda: {
        "company_url": url.profile_url(text.clean_text(C("company_url")), url.split_url(C("company_url"))),
        "company_id": url.found(url.split_url(C("company_url")).path, r"/company/([^/?#]+)"),
    },
    f"""SELECT seq, CASE WHEN c_scheme IN ('http', 'https') THEN rtrim(c_scheme || '://' || c_host || c_path, '/') ELSE c_text END AS company_url,
        {rx('c_path', '/company/([^/?#]+)')} AS company_id FROM (SELECT seq, {parts('c', 'company_url')} FROM postings) AS p""",
)
project(
    "url_03_drop_tracking", "URL-03", "postings",
    lambda: {"bare": url.drop_query(C("job_url")), "without_key": url.drop_query_key(C("job_url"), "gh_src")},
    f"""SELECT seq, regexp_replace({clean('job_url')}, '[?#].*$', '') AS bare,
        regexp_replace(regexp_replace({clean('job_url')}, '[?]gh_src=[^&]*$', ''), '#.*$', '') AS without_key FROM postings""",
)
project(
    "url_04_base_slug_code", "URL-04", "catalog",
    lambda: dict(zip(("base", "slug", "code"), url.hosted_board_fields(C("career_page_url")))),
    """SELECT id, CASE WHEN ok THEN regexp_extract(career_page_url, '^https://www[.]comeet[.]com/jobs/[^/]+/[^/]+') END AS base,
        CASE WHEN ok THEN string_split(career_page_url, '/')[5] END AS slug, CASE WHEN ok THEN string_split(career_page_url, '/')[6] END AS code
        FROM (SELECT *, starts_with(career_page_url, 'https://www.comeet.com/jobs/') AS ok FROM catalog) AS c""",
    key="id",
)
FRAG = "regexp_extract(url, '#.*$', 0)"
NOFRAG = "regexp_replace(url, '#.*$', '')"
project(
    "url_05_set_query_key", "URL-05", "pages",
    lambda: {"made": url.set_query_key(C("url"), "page", F.lit(7))},
    f"""SELECT page_id, CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_replace(url, '([?&]page=)[^&#]*', '\\g<1>7')
        WHEN contains(url, '?') THEN {NOFRAG} || '&page=7' || {FRAG} ELSE {NOFRAG} || '?page=7' || {FRAG} END AS made FROM pages""".replace(
        "'\\g<1>7'", "'\\1' || '7'"
    ),
    key="page_id",
)
ROOT = "regexp_extract(url, '^[a-z]+://[^/?#]*')"
project(
    "url_06_join_and_scheme", "URL-06", "pages",
    lambda: {
        "rooted": url.join_url(C("url"), F.concat(F.lit("/jobs/"), C("page_id"))),
        "relative": url.join_url(C("url"), F.lit("next.html")),
        "up": url.join_url(C("url"), F.lit("../up")),
        "absolute": url.join_url(C("url"), F.lit("http://other.org/a")),
        "site": url.with_scheme(F.regexp_replace(C("url"), "^http://", "")),
    },
    f"""SELECT page_id, {ROOT} || '/jobs/' || page_id AS rooted,
        {ROOT} || regexp_replace(p, '[^/]*$', '') || 'next.html' AS relative,
        {ROOT} || CASE WHEN regexp_matches(p, '^/[^/]*/?$') AND NOT regexp_matches(p, '^/[^/]*/[^/]') THEN '/up'
           ELSE regexp_replace(regexp_replace(p, '[^/]*$', ''), '[^/]*/$', '') || 'up' END AS up,
        'http://other.org/a' AS absolute,
        CASE WHEN starts_with(url, 'http://') THEN 'https://' || substr(url, 8) ELSE url END AS site
        FROM (SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p FROM pages) AS x""",
    key="page_id",
)
project(
    "url_07_decode_direct_url", "URL-07", "pages",
    lambda: {"direct": url.direct_url(F.concat(F.lit('"https://x.org/r?url='), F.url_encode(C("url")), F.lit('"')))},
    "SELECT page_id, url AS direct FROM pages",
    key="page_id",
)
project(
    "url_08_platform", "URL-08", "catalog",
    lambda: {
        "platform": url.platform(url.with_scheme(C("career_page_url")), F.lit(None).cast("string"))["platform"],
        "token": url.platform(url.with_scheme(C("career_page_url")), F.lit(None).cast("string"))["token"],
    },
    """SELECT id, CASE WHEN contains(career_page_url, 'myworkdayjobs') THEN 'workday' WHEN contains(career_page_url, 'comeet') THEN 'comeet'
        WHEN contains(career_page_url, 'lever.co') THEN 'lever' WHEN contains(career_page_url, 'greenhouse') THEN 'greenhouse_public_board' ELSE 'unknown' END AS platform,
        CASE WHEN contains(career_page_url, 'lever.co') THEN coalesce(nullif(regexp_extract(career_page_url, 'postings/([^/?#]+)', 1), ''),
                  regexp_extract(career_page_url, 'jobs[.]lever[.]co/([^/?#]+)', 1))
             WHEN contains(career_page_url, 'greenhouse') THEN regexp_extract(career_page_url, 'greenhouse[.]io/([^/?#]+)', 1) END AS token FROM catalog""",
    key="id",
)
project(
    "url_08_platform_in_pages", "URL-08", "pages",
    lambda: {
        "platform": url.platform(C("url"), F.concat(C("html"), F.lit('<a href="https://jobs.lever.co/acme/1">x</a>')))["platform"],
        "token": url.platform(C("url"), C("html"))["token"],
    },
    "SELECT page_id, 'lever' AS platform, CAST(NULL AS STRING) AS token FROM pages",
    key="page_id",
)
project(
    "url_09_apply_url", "URL-09", "pages",
    lambda: {
        "apply": url.apply_url(
            F.when(C("page_id") % 4 == 0, F.concat(F.lit('<code id="applyUrl"><!--"https://l.org/x?url='), F.url_encode(C("url")), F.lit('"--></code>')))
            .when(C("page_id") % 4 == 1, F.concat(F.lit('{offsiteApplyUrl\\":\\"https:\\/\\/'.replace("\\/", "/")), F.lit('a.org/1?x=1\\u0026y=2\\"}')))
            .otherwise(C("html")),
            C("url"),
            C("page_id") % 4 == 2,
        )
    },
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'https://a.org/1?x=1&y=2' WHEN 3 THEN url END AS apply FROM pages""",
    key="page_id",
)
project(
    "url_10_build_urls", "URL-10", "postings",
    lambda: {
        "detail": url.detail_url(F.lit("https://jobs.apple.com"), F.lit("en-us"), C("jid").cast("string"), F.lit("engineer"), C("job_function")),
        "under": url.detail_url_under(F.lit("https://x.org/jobs/results/?page=2&q=a"), C("jid").cast("string"), text.clean_text(C("title"))),
        "root": url.site_root(C("job_url")),
        "gh": url.board_id(C("job_url")),
    },
    f"""SELECT seq, 'https://jobs.apple.com/en-us/details/' || jid || '/engineer' || coalesce('?team=' || job_function, '') AS detail,
        'https://x.org/jobs/results/' || jid || '-' || trim(regexp_replace(lower({clean('title')}), '[^a-z0-9]+', '-', 'g'), '-') || '?q=a' AS under,
        {rx('trim(job_url)', '^(https?://[^/?#]+)')} AS root, 'gh-' || {rx('job_url', '(gh_jid=|/jobs/)([0-9]+)', 2)} AS gh FROM postings""",
)
project(
    "dt_01_parse_date", "DT-01", "postings",
    lambda: {
        "record": dates.parse_date(C("date_posted")),
        "feed": dates.parse_date(C("date_posted"), "feed"),
        "careers": dates.parse_date(F.date_format(C("odate"), "d MMM yyyy"), "careers"),
        "board": dates.parse_date(F.date_format(C("odate"), "MMMM d, yyyy"), "board"),
    },
    f"""SELECT seq, {DATE} AS record, coalesce({DATE}, CAST(try_strptime(dt, '%d/%m/%Y') AS DATE)) AS feed, odate AS careers,
        CASE WHEN month(odate) <> 5 THEN odate END AS board FROM (SELECT *, {clean('date_posted')} AS dt FROM postings) AS p""",
)
project(
    "dt_02_epoch_date", "DT-02", "postings",
    lambda: {
        "from_seconds": dates.epoch_date(C("price") * 4000),
        "from_millis": dates.epoch_date(C("price") * 4000000 + 999, "milliseconds"),
    },
    """SELECT seq, DATE '1970-01-01' + CAST(floor(price * 4000 / 86400) AS INT) AS from_seconds,
        DATE '1970-01-01' + CAST(floor((price * 4000000 + 999) / 86400000) AS INT) AS from_millis FROM postings""",
)


def _run_date() -> Column:
    return F.lit(RUN_DATE).cast("date")


project(
    "dt_03_relative_date", "DT-03", "postings",
    lambda: {
        "posted": dates.relative_date(
            F.when(C("cust") % 5 == 0, "Posted Today").when(C("cust") % 5 == 1, "posted yesterday").when(C("cust") % 5 == 2, "Open now")
            .otherwise(F.concat(F.lit("Posted "), C("cust") % 400, F.lit(" Days Ago"))), _run_date()),
        "footer": dates.footer_date(
            F.when(C("cust") % 4 == 0, "Just now").when(C("cust") % 4 == 1, F.concat(C("cust") % 30, F.lit(" Days Ago")))
            .when(C("cust") % 4 == 2, ""), C("price") * 4000000, _run_date()),
        "aged": dates.age_date(F.when(C("cust") % 3 > 0, C("cust") % 100), _run_date()),
        "numbered": dates.days_ago_text(F.concat(C("cust") % 60, F.lit(" days ago")), _run_date()),
    },
    f"""SELECT seq, CASE cust % 5 WHEN 0 THEN d WHEN 1 THEN d - 1 WHEN 2 THEN NULL ELSE d - CAST(cust % 400 AS INT) END AS posted,
        CASE cust % 4 WHEN 0 THEN d WHEN 1 THEN d - CAST(cust % 30 AS INT) ELSE DATE '1970-01-01' + CAST(floor(price * 4000 / 86400) AS INT) END AS footer,
        CASE WHEN cust % 3 > 0 THEN d - CAST(cust % 100 AS INT) END AS aged, d - CAST(cust % 60 AS INT) AS numbered
        FROM (SELECT *, DATE '{RUN_DATE}' AS d FROM postings) AS p""",
)
project(
    "dt_04_timestamp", "DT-04", "postings",
    lambda: {"moment": F.date_format(dates.parse_timestamp(C("date_posted")), "yyyy-MM-dd HH:mm:ss")},
    f"""SELECT seq, CASE WHEN regexp_full_match(dt, '[0-9-]{{10}}') THEN dt || ' 00:00:00'
        WHEN contains(dt, 'T') THEN substr(dt, 1, 10) || ' 21:30:00' END AS moment FROM (SELECT seq, {clean('date_posted')} AS dt FROM postings) AS p""",
)
project(
    "num_01_safe_int", "NUM-01", "postings",
    lambda: {"n": money.safe_int(C("applications_count"))},
    "SELECT seq, CAST(trunc(try_cast(applications_count AS DOUBLE)) AS BIGINT) AS n FROM postings",
)
project(
    "num_02_parse_bool", "NUM-02", "postings",
    lambda: {"flag": money.parse_bool(C("listing_type")), "word": money.parse_bool(F.when(C("cust") % 3 == 0, " Yes ").when(C("cust") % 3 == 1, "HYBRID")),
             "box": money.parse_checkbox(C("is_remote").cast("string"))},
    """SELECT seq, CAST(NULL AS BOOLEAN) AS flag, CASE cust % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS word, is_remote AS box FROM postings""",
)
project(
    "num_03_currency_number", "NUM-03", "postings",
    lambda: {
        "dots": money.currency_number(F.concat(F.lit("EUR "), F.format_number(C("price"), 2))),
        "comma": money.currency_number(F.concat(F.translate(F.format_number(C("price"), 2), ",.", ".,"), F.lit(" €"))),
        "plain": money.currency_number(C("price").cast("string")),
    },
    "SELECT seq, CAST(price AS DOUBLE) AS dots, CAST(price AS DOUBLE) AS comma, CAST(price AS DOUBLE) AS plain FROM postings",
)

M = "regexp_extract(description, '[$]([0-9]+(?:,[0-9]+)?(?:[.][0-9]+)?)([kK]?)\\s*[-—–]\\s*[$]?([0-9]+(?:,[0-9]+)?(?:[.][0-9]+)?)([kK]?)', {g})"
PAY_SQL = f"""
SELECT *, CASE WHEN lo < 350 THEN 'hourly' WHEN lo < 30000 THEN 'monthly' WHEN lo IS NOT NULL THEN 'yearly' END AS unit,
  CASE WHEN lo < 350 THEN lo * 2080 WHEN lo < 30000 THEN lo * 12 ELSE lo END AS year_lo,
  CASE WHEN lo < 350 THEN CASE WHEN hi < 350 THEN hi * 2080 END WHEN lo < 30000 THEN CASE WHEN hi < 30000 THEN hi * 12 END ELSE hi END AS year_hi
FROM (SELECT *, CAST(floor(a) AS BIGINT) * f AS lo, CAST(floor(b) AS BIGINT) * f AS hi FROM (
  SELECT *, try_cast(replace({M.format(g=1)}, ',', '') AS DOUBLE) AS a, try_cast(replace({M.format(g=3)}, ',', '') AS DOUBLE) AS b,
    CASE WHEN {M.format(g=2)} <> '' OR {M.format(g=4)} <> '' THEN 1000 ELSE 1 END AS f FROM postings) AS x) AS y"""
PAY_OK = "year_lo BETWEEN 1000 AND 700000 AND year_hi BETWEEN 1000 AND 700000 AND year_lo < year_hi"


project(
    "sal_01_extract_salary", "SAL-01", "postings",
    lambda: {"pay": money.extract_salary(C("description")), "year": money.extract_salary(C("description"), annual=True)},
    f"""SELECT seq, CASE WHEN {PAY_OK} THEN unit END AS pay_interval, CASE WHEN {PAY_OK} THEN lo END AS low, CASE WHEN {PAY_OK} THEN hi END AS high,
        CASE WHEN {PAY_OK} THEN 'USD' END AS currency, CASE WHEN {PAY_OK} THEN year_lo END AS year_low, CASE WHEN {PAY_OK} THEN year_hi END AS year_high
        FROM ({PAY_SQL}) AS z""",
    fields={
        "pay_interval": "pay.pay_interval", "low": "pay.min_amount", "high": "pay.max_amount", "currency": "pay.currency",
        "year_low": "year.min_amount", "year_high": "year.max_amount",
    },
)
project(
    "sal_02_annualise", "SAL-02", "postings",
    lambda: {
        "pay_interval": money.annualise(C("pay_interval"), C("min_amount"), C("max_amount"))["pay_interval"],
        "low": money.annualise(C("pay_interval"), C("min_amount"), C("max_amount"))["min_amount"],
        "high": money.annualise(C("pay_interval"), C("min_amount"), C("max_amount"))["max_amount"],
    },
    """SELECT seq, CASE WHEN due THEN 'yearly' ELSE pay_interval END AS pay_interval, CASE WHEN due THEN min_amount * f ELSE min_amount END AS low,
        CASE WHEN due THEN max_amount * f ELSE max_amount END AS high
        FROM (SELECT *, coalesce(pay_interval <> 'yearly' AND min_amount <> 0 AND max_amount <> 0, FALSE) AS due,
              CASE pay_interval WHEN 'hourly' THEN 2080 WHEN 'monthly' THEN 12 END AS f FROM postings) AS p""",
)


def _structured() -> dict[str, Column]:
    base = {
        "unit": F.when(C("cust") % 3 == 0, F.when(C("cust") % 2 == 0, "YEAR").otherwise("HOUR")),
        "low": C("price"), "high": C("price") + 10, "currency": F.lit("EUR"),
    }
    estimate = {"unit": F.when(C("cust") % 4 == 0, "month"), "low": C("price") + 1, "high": C("price") + 2, "currency": F.lit("USD")}
    pay = money.structured_pay(base, estimate)
    adjusted = money.percentile_pay(F.when(C("cust") % 5 > 0, "ANNUAL"), C("price") + 0.7, C("price") + 9.9, F.lit(None).cast("string"))
    return {
        "unit": pay["pay_interval"], "low": pay["min_amount"], "high": pay["max_amount"], "currency": pay["currency"],
        "adjusted_low": adjusted["min_amount"], "adjusted_high": adjusted["max_amount"], "adjusted_unit": adjusted["pay_interval"],
    }


project(
    "sal_03_structured_pay", "SAL-03", "postings", _structured,
    """SELECT seq, CASE WHEN cust % 3 = 0 THEN CASE WHEN cust % 2 = 0 THEN 'yearly' ELSE 'hourly' END WHEN cust % 4 = 0 THEN 'monthly' END AS unit,
        CASE WHEN cust % 3 = 0 THEN price WHEN cust % 4 = 0 THEN price + 1 END AS low,
        CASE WHEN cust % 3 = 0 THEN price + 10 WHEN cust % 4 = 0 THEN price + 2 END AS high,
        CASE WHEN cust % 4 = 0 THEN 'USD' WHEN cust % 3 = 0 THEN 'EUR' END AS currency,
        CASE WHEN cust % 5 > 0 THEN price END AS adjusted_low, CASE WHEN cust % 5 > 0 THEN price + 9 END AS adjusted_high,
        CASE WHEN cust % 5 > 0 THEN 'yearly' END AS adjusted_unit FROM postings""",
)


def _lakh() -> dict[str, Column]:
    label = F.when(C("cust") % 4 == 0, "Not disclosed").otherwise(
        F.concat(C("cust") % 30, F.lit("-"), C("cust") % 30 + 5, F.when(C("cust") % 4 == 1, " Lacs P.A.").when(C("cust") % 4 == 2, " Cr").otherwise(" lakh"))
    )
    pay = money.lakh_pay(label)
    return {"low": pay["min_amount"], "high": pay["max_amount"], "currency": pay["currency"]}


project(
    "sal_04_lakh_pay", "SAL-04", "postings", _lakh,
    """SELECT seq, CASE WHEN cust % 4 > 0 THEN (cust % 30) * f END AS low, CASE WHEN cust % 4 > 0 THEN (cust % 30 + 5) * f END AS high,
        CASE WHEN cust % 4 > 0 THEN 'INR' END AS currency FROM (SELECT *, CASE WHEN cust % 4 = 2 THEN 10000000 ELSE 100000 END AS f FROM postings) AS p""",
)


@query(
    "sal_05_salary_source",
    "SAL-05 SAL-02 PRJ-01",
    oracle(
        f"""SELECT seq, CASE WHEN pay_interval IS NOT NULL THEN CASE WHEN min_amount <> 0 THEN 'direct_data' END
            WHEN {PAY_OK} THEN 'description' END AS salary_source,
          CASE WHEN pay_interval IS NOT NULL THEN pay_interval WHEN {PAY_OK} THEN unit END AS unit,
          CASE WHEN pay_interval IS NOT NULL THEN min_amount WHEN {PAY_OK} THEN CAST(lo AS DOUBLE) END AS low,
          CASE WHEN pay_interval IS NOT NULL THEN coalesce(currency, 'USD') WHEN {PAY_OK} THEN 'USD' END AS currency
        FROM ({PAY_SQL}) AS z""",
        "postings",
    ),
)
def salary_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.operators.output import add_pay

    raw = derived(spark, sf_dir, "postings")
    given = F.struct("pay_interval", "min_amount", "max_amount", "currency")
    df = raw.withColumn("compensation", F.when(C("pay_interval").isNotNull(), given))
    paid = add_pay(df.select("seq", "description", "compensation"), "usa")
    return paid.select("seq", "salary_source", C("interval").alias("unit"), C("min_amount").alias("low"), "currency")


project(
    "sal_06_salary_text", "SAL-06", "postings",
    lambda: {"salary": money.salary_text(C("min_amount"), C("max_amount"), C("pay_interval"), C("currency"))},
    f"SELECT seq, {SALARY} AS salary FROM postings",
)


def _card() -> dict[str, Column]:
    sign = F.when(C("cust") % 3 == 0, "€").otherwise("$")
    line = F.concat(sign, F.format_number(C("price"), 2), F.when(C("cust") % 5 > 0, F.concat(F.lit(" - "), sign, F.format_number(C("price") + 100, 2))).otherwise(""))
    pay = money.card_pay(line)
    return {"low": pay["min_amount"], "high": pay["max_amount"], "currency": pay["currency"]}


project(
    "sal_07_card_pay", "SAL-07", "postings", _card,
    """SELECT seq, CASE WHEN cust % 5 > 0 THEN price END AS low, CASE WHEN cust % 5 > 0 THEN price + 100 END AS high,
        CASE WHEN cust % 5 > 0 THEN CASE WHEN cust % 3 = 0 THEN '€' ELSE 'USD' END END AS currency FROM postings""",
)
TYPES_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in lookups.job_type_spellings().items()) + "}"
project(
    "job_01_job_type_lookup", "JOB-01", "postings",
    lambda: {"job_type": jobs.job_type(jobs.squeeze(C("job_type")))},
    f"SELECT seq, {TYPES_SQL}[replace(replace(lower({clean('job_type')}), ' ', ''), '-', '')] AS job_type FROM postings",
)
project(
    "job_02_types_in_text", "JOB-02", "postings",
    lambda: {
        "types": F.array_join(jobs.job_types_in_text(C("description")), ","),
        "schedule": F.array_join(jobs.job_types_by_schedule(F.when(C("cust") % 2 == 0, "Full Time"), C("job_type")), ","),
    },
    """SELECT seq, nullif(concat_ws(',', CASE WHEN regexp_matches(lower(description), 'full\\s?time') THEN 'fulltime' END,
          CASE WHEN regexp_matches(lower(description), 'part\\s?time') THEN 'parttime' END,
          CASE WHEN contains(lower(description), 'internship') THEN 'internship' END,
          CASE WHEN contains(lower(description), 'contract') THEN 'contract' END), '') AS types,
        nullif(concat_ws(',', CASE WHEN cust % 2 = 0 THEN 'fulltime' END, CASE WHEN contains(lower(job_type), 'intern') THEN 'internship' END), '') AS schedule
        FROM postings""",
)
ITEMS = f"list_filter(list_transform(string_split(job_type, ','), lambda x: {TYPES_SQL}[replace(replace(lower(trim(x)), ' ', ''), '-', '')]), lambda x: x IS NOT NULL)"
project(
    "job_03_job_type_list", "JOB-03", "postings",
    lambda: {"types": F.array_join(jobs.job_type_list(F.split(C("job_type"), ",")), ",")},
    f"SELECT seq, nullif(array_to_string({first_of_equals(ITEMS)}, ','), '') AS types FROM postings",
)
project(
    "job_04_remote_flag", "JOB-04", "postings",
    lambda: {
        "remote": jobs.is_remote(C("title"), C("description"), C("location")),
        "home": jobs.is_remote(C("description"), extra=("home based", "office")),
        "workplace": jobs.remote_by_workplace(F.nullif(C("is_remote"), F.lit(False)), C("listing_type")),
    },
    """SELECT seq, regexp_matches(lower(concat_ws(' ', title, description, location)), 'remote|work from home|wfh') AS remote,
        regexp_matches(lower(coalesce(description, '')), 'remote|work from home|wfh|home based|office') AS home,
        CASE WHEN is_remote THEN TRUE WHEN listing_type = 'On_Site' THEN FALSE END AS workplace FROM postings""",
)
project(
    "job_05_work_from_home_type", "JOB-05", "postings",
    lambda: {"kind": jobs.work_from_home_type(C("location"), C("title"), C("description"))},
    """SELECT seq, CASE WHEN contains(t, 'hybrid') THEN 'Hybrid' WHEN contains(t, 'remote') THEN 'Remote' ELSE 'Work from office' END AS kind
        FROM (SELECT seq, lower(concat_ws(' ', location, title, description)) AS t FROM postings) AS p""",
)


def _land(i: str) -> Column:
    names = ("usa", "UK ", "germany", "us", "Narnia", "worldwide", "usa/ca", "south korea")
    return F.element_at(F.array(*[F.lit(n) for n in names]), (C(i) % 8 + 1).cast("int"))


LAND = "['usa', 'UK ', 'germany', 'us', 'Narnia', 'worldwide', 'usa/ca', 'south korea'][cust % 8 + 1]"
SHOWN = "['USA', 'UK', 'Germany', 'USA', 'Narnia', NULL, NULL, 'South Korea'][cust % 8 + 1]"
project(
    "loc_01_display_location", "LOC-01", "postings",
    lambda: {
        "shown": location.display_location(
            location.place(F.when(C("cust") % 3 > 0, F.concat(F.lit("City"), C("cust") % 9)), F.when(C("cust") % 5 == 0, "ST"), _land("cust"))
        )
    },
    f"""SELECT seq, concat_ws(', ', CASE WHEN cust % 3 > 0 THEN 'City' || cust % 9 END, CASE WHEN cust % 5 = 0 THEN 'ST' END, {SHOWN}) AS shown FROM postings""",
)


STYLES = ("linkedin", "glassdoor", "greenhouse", "eightfold", "meta", "naukri", "bdjobs")


@query(
    "loc_02_parse_location", "LOC-02",
    oracle(
        """SELECT seq,
        CASE WHEN n >= 2 THEN p[1] END AS linkedin_city, CASE WHEN n >= 2 THEN p[2] END AS linkedin_state, CASE WHEN n >= 3 THEN p[n] ELSE 'usa' END AS linkedin_country,
        CASE WHEN n >= 2 THEN p[1] END AS glassdoor_city, CASE WHEN n >= 2 THEN array_to_string(p[2:], ', ') END AS glassdoor_state, CAST(NULL AS STRING) AS glassdoor_country,
        CASE WHEN n = 2 THEN p[1] END AS greenhouse_city, CASE WHEN n = 2 THEN p[2] END AS greenhouse_state, CASE WHEN n <> 2 THEN location END AS greenhouse_country,
        CASE WHEN n >= 3 THEN array_to_string(p[1:n - 2], ', ') WHEN n = 2 THEN p[1] END AS eightfold_city, CASE WHEN n >= 3 THEN p[n - 1] END AS eightfold_state, p[n] AS eightfold_country,
        CASE WHEN n >= 2 THEN array_to_string(p[1:n - 1], ', ') END AS meta_city, CAST(NULL AS STRING) AS meta_state, p[n] AS meta_country,
        p[1] AS naukri_city, p[2] AS naukri_state, 'india' AS naukri_country,
        p[1] AS bdjobs_city, p[2] AS bdjobs_state, 'bangladesh' AS bdjobs_country,
        CASE WHEN cust % 2 = 0 THEN concat_ws(' / ', location, 'Haifa') ELSE p[1] END AS office_city,
        CASE WHEN cust % 2 > 0 AND n >= 2 THEN array_to_string(p[2:], ', ') END AS office_state
        FROM (SELECT *, string_split(location, ', ') AS p, len(string_split(location, ', ')) AS n FROM postings) AS q""",
        "postings",
    ),
)
def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    offices = F.array(F.concat(F.lit("US-CA - "), C("location")), F.concat(C("location"), F.lit(" - HQ")), F.when(C("cust") % 2 == 0, "Haifa - IL"))
    rows = derived(spark, sf_dir, "postings").select("seq", C("location").alias("text"), offices.alias("offices"))
    found = location.with_locations(rows, {s: ("text", s) for s in STYLES} | {"office": ("offices", "offices")}, F.lit("usa"))
    parts = [C(f"{s}.{f}").alias(f"{s}_{f}") for s in STYLES for f in ("city", "state", "country")]
    return found.select("seq", *parts, C("office.city").alias("office_city"), C("office.state").alias("office_state"))
KEYS = "['USA', 'UK', 'GERMANY', 'USA', NULL, 'WORLDWIDE', 'US_CANADA', 'SOUTHKOREA'][cust % 8 + 1]"
project(
    "loc_03_country_lookup", "LOC-03", "postings",
    lambda: {
        "country": location.country_key(_land("cust")),
        "code": location.country_code(location.country_key(_land("cust"))),
        "review_host": location.review_host(location.country_key(_land("cust"))),
        "kept": location.country_name(_land("cust")),
    },
    f"""SELECT seq, {KEYS} AS country, ['US', 'GB', 'DE', 'US', NULL, 'WWW', 'WWW', 'KR'][cust % 8 + 1] AS code,
        ['www.glassdoor.com', 'www.glassdoor.co.uk', 'www.glassdoor.de', 'www.glassdoor.com', NULL, NULL, NULL, NULL][cust % 8 + 1] AS review_host,
        {SHOWN} AS kept FROM postings""",
)


def _doc() -> Column:
    return F.parse_json(F.concat(F.lit('{"a":[{"name":"Job Type","value":"x"},{"name":"Other"}],"p":'), C("props"), F.lit("}")))


project(
    "jsn_01_get_path", "JSN-01", "events",
    lambda: {
        "k": payload.path_text(_doc(), "p.k"),
        "named": payload.path_text(_doc(), "a.Job Type.value"),
        "at": payload.path_text(_doc(), "a[1].name"),
        "first": payload.path_text(_doc(), ["p.missing", "p.k"]),
        "none": payload.path_text(_doc(), "p.k.deeper"),
    },
    """SELECT event_id, json_extract_string(props, '$.k') AS k, 'x' AS named, 'Other' AS at, json_extract_string(props, '$.k') AS first,
        CAST(NULL AS STRING) AS none FROM events""",
    key="event_id",
)
project(
    "jsn_02_value_map", "JSN-02", "events",
    lambda: {"kind": payload.value_map(C("event_type"), {"click": "tap", "error": "fault"})},
    "SELECT event_id, CASE event_type WHEN 'click' THEN 'tap' WHEN 'error' THEN 'fault' ELSE event_type END AS kind FROM events",
    key="event_id",
)
project(
    "jsn_03_coerce_object", "JSN-03", "events",
    lambda: {
        "k": F.try_element_at(payload.coerce_object(C("props")), F.lit("k")),
        "size": F.size(payload.coerce_object(F.when(C("event_id") % 3 == 0, "[1,2]").when(C("event_id") % 3 == 1, "{bad").otherwise(C("props")))).cast("bigint"),
    },
    "SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN event_id % 3 = 2 THEN 1 ELSE 0 END::BIGINT AS size FROM events",
    key="event_id",
)
