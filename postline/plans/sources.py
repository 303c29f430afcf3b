"""Queries over landed documents and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.plans.derive import derived, oracle
from postline.plans.registry import query, table
from postline.plans.streams import scratch
from postline.session import spread
from postline.sources import arrays, html, landing

C = F.col


def _docs(spark: SparkSession, sf_dir: str, shape: Column) -> DataFrame:
    df = derived(spark, sf_dir, "positions")
    return df.select(C("seq").alias("file"), F.parse_json(shape).alias("doc"))


def _two() -> Column:
    one = F.to_json(F.struct("id", C("name").alias("title")))
    two = F.to_json(F.struct(F.concat(C("id"), F.lit("b")).alias("id"), C("url").alias("title")))
    return F.concat(F.lit("["), one, F.lit(","), two, F.lit("]"))


ITEMS_SQL = """SELECT seq AS file, 0 AS pos, id, name AS title FROM positions UNION ALL SELECT seq, 1, id || 'b', url FROM positions"""


def _landed(spark: SparkSession, sf_dir: str, shape: Column) -> DataFrame:
    """The documents as they are read back from files, one per line."""
    path = scratch(spark, "landed")
    derived(spark, sf_dir, "positions").select(shape.alias("value")).write.text(path)
    return landing.documents(spark, path)


@query("src_01_read_postings_json", "SRC-01", oracle(f"SELECT pos, id, title FROM ({ITEMS_SQL}) AS i", "positions"))
def read_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = F.when(C("seq") % 2 == 0, _two()).otherwise(F.concat(F.lit('{"jobs":'), _two(), F.lit("}")))
    rows = landing.read_postings(_landed(spark, sf_dir, shape))
    return rows.select("pos", F.variant_get("item", "$.id", "string").alias("id"), F.variant_get("item", "$.title", "string").alias("title"))


@query("src_01_read_large_array", "SRC-01", oracle(ITEMS_SQL.replace("seq AS file, 0 AS pos", "0 AS part").replace("seq, 1,", "1,"), "positions"))
def read_large_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All positions in two documents of many lines: an array, and an object with other keys around its jobs."""
    path = scratch(spark, "large")
    items = derived(spark, sf_dir, "positions").select("seq", C("name").alias("title"), "id", "url")
    spread = lambda kind, *columns: F.to_json(F.struct(F.lit(kind).alias("part"), *columns), {"pretty": "true"})
    lists = (
        (spread(0, "id", "title"), '[', "]\n"),
        (spread(1, F.concat(C("id"), F.lit("b")).alias("id"), C("url").alias("title"), F.array(F.struct(F.lit("}],[{").alias("jobs"))).alias("x")),
         '{"meta": {"jobs": [{"a": "]}"}]}, "jobs" :\n [', '], "next": [{}]}'),
    )
    low, high = items.agg(F.min("seq"), F.max("seq")).first()
    for k, (text, opening, closing) in enumerate(lists):  # a line or more per item, in order
        before = F.when(C("seq") == low, F.lit(opening)).otherwise(F.lit(","))
        after = F.when(C("seq") == high, F.lit(closing)).otherwise(F.lit(""))
        lines = items.select("seq", F.concat(before, text, after).alias("value"))
        lines.coalesce(1).sortWithinPartitions("seq").select("value").write.text(f"{path}/{k}")
    rows = arrays.array_items(spark, f"{path}/*")
    take = lambda name, kind: F.variant_get("item", f"$.{name}", kind).alias(name)
    return rows.select(take("part", "int"), take("id", "string"), take("title", "string"))


@query(
    "src_02_read_grid_export",
    "SRC-02",
    oracle(f"SELECT pos, id FROM ({ITEMS_SQL}) AS i UNION ALL SELECT 0, 'col' FROM positions", "positions"),
)
def read_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_text = F.concat(F.lit('{"table":{"columns":[{"id":"col"}],"rows":'), _two(), F.lit("}}"))
    shape = F.when(C("seq") % 2 == 0, table_text).otherwise(F.concat(F.lit('{"data":'), table_text, F.lit("}")))
    docs = _landed(spark, sf_dir, shape)
    rows, columns = landing.grid(C("doc"))
    parts = [landing.explode_items(docs, x, ["file"]) for x in (rows, columns)]
    both = parts[0].unionByName(parts[1])
    return both.select("pos", F.variant_get("item", "$.id", "string").alias("id"))


@query(
    "src_03_frame_to_rows",
    "SRC-03",
    """SELECT CAST(to_json({'s_suppkey': s_suppkey, 's_name': s_name, 's_nationkey': s_nationkey, 'since': CAST(DATE '2001-02-03' AS STRING), 'none': NULL}) AS STRING) AS row FROM supplier""",
)
def frame_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", F.lit("2001-02-03").cast("date").alias("since"), F.lit(None).cast("string").alias("none")
    )
    return landing.frame_to_rows(df)


@query("src_04_locate_payload_rows", "SRC-04", oracle(ITEMS_SQL, "positions"))
def locate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = _two()
    wrap = lambda a, b: F.concat(F.lit(a), two, F.lit(b))
    shape = (
        F.when(C("seq") % 5 == 0, two)
        .when(C("seq") % 5 == 1, wrap('{"jobs":7,"results":', "}"))
        .when(C("seq") % 5 == 2, wrap('{"data":{"positions":', "}}"))
        .when(C("seq") % 5 == 3, wrap('{"items":[],"jobs":', "}"))
        .otherwise(wrap('{"items":', ',"other":[1]}'))
    )
    rows = landing.explode_items(_docs(spark, sf_dir, shape), landing.require_rows(landing.locate_rows(C("doc"))), ["file"])
    return rows.select(
        "file", "pos", F.variant_get("item", "$.id", "string").alias("id"), F.variant_get("item", "$.title", "string").alias("title")
    )


@query("src_04_probe_payload_rows", "SRC-04", oracle(ITEMS_SQL, "positions"))
def probe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows up to seven levels down, behind empty lists, scalars and objects without rows."""
    two = _two()
    wrap = lambda a, b: F.concat(F.lit(a), two, F.lit(b))
    shape = (
        F.when(C("seq") % 6 == 0, two)
        .when(C("seq") % 6 == 1, wrap('{"data":{"results":{"items":{"data":{"positions":', "}}}}}"))
        .when(C("seq") % 6 == 2, wrap('{"jobs":{"results":[],"items":[1]},"data":{"jobs":"no","positions":{"jobs":', '}},"results":[2]}'))
        .when(C("seq") % 6 == 3, wrap('{"jobs":{"data":{"jobs":{"data":{"jobs":{"data":{"jobs":', ',"data":[1]}}}}}},"items":[3]}'))
        .when(C("seq") % 6 == 4, wrap('{"other":{"jobs":[4]},"jobs":null,"data":{"data":{}},"positions":', "}"))
        .otherwise(wrap('{"jobs":{"jobs":{"jobs":[]}},"data":{"data":{"data":[]},"items":', '},"positions":[5]}'))
    )
    rows = landing.explode_items(_docs(spark, sf_dir, shape), landing.probe_rows(C("doc")), ["file"])
    return rows.select(
        "file", "pos", F.variant_get("item", "$.id", "string").alias("id"), F.variant_get("item", "$.title", "string").alias("title")
    )


@query(
    "src_05_extract_embedded_json",
    "SRC-05",
    """SELECT page_id, url AS by_id, CAST(page_id AS STRING) AS by_name, url AS by_attribute, url AS twice, CAST(page_id AS STRING) AS in_code, 'next' AS by_next,
    'remix' AS by_remix FROM pages""",
)
def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "pages")
    doc = F.to_json(F.struct("url", "page_id"))
    page = F.concat(
        C("html"), F.lit('<script type="application/json" id="feed">'), doc, F.lit("</script><script>window.DATA = "), doc,
        F.lit(';\n</script><div data-page="'), F.replace(doc, F.lit('"'), F.lit("&quot;")),
        F.lit('"></div><script>window.__staticRouterHydrationData = JSON.parse("'),
        F.replace(doc, F.lit('"'), F.lit('\\"')), F.lit('");</script><code>not json</code><code> '), doc,
        F.lit('</code><script id="__NEXT_DATA__" type="application/json">{"props":{"k":"next"}}</script>'
              '<script>window.__remixContext = {"k":"remix"};</script>'),
    )
    df = df.select("page_id", page.alias("page"))
    text = lambda v, path: F.try_variant_get(v, path, "string")
    return df.select(
        "page_id",
        text(html.embedded_json(C("page"), "script_id", "feed"), "$.url").alias("by_id"),
        text(html.embedded_json(C("page"), "variable", "window.DATA"), "$.page_id").alias("by_name"),
        text(html.embedded_json(C("page"), "data_page"), "$.url").alias("by_attribute"),
        text(html.embedded_json(C("page"), "hydration"), "$.url").alias("twice"),
        text(html.code_payloads(C("page"))[0], "$.page_id").alias("in_code"),
        text(html.embedded_json(C("page"), "next"), "$.props.k").alias("by_next"),
        text(html.embedded_json(C("page"), "remix"), "$.k").alias("by_remix"),
    )


def _with_ld(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "pages")
    place = F.struct(F.struct(F.lit("Haifa").alias("addressLocality")).alias("address"))
    doc = F.to_json(
        F.struct(
            F.lit("JobPosting").alias("@type"), F.concat(F.lit("Title "), C("page_id")).alias("title"),
            F.lit("2024-01-02").alias("datePosted"), place.alias("jobLocation"),
            F.struct(C("url").alias("sameAs")).alias("hiringOrganization"), F.lit("a &amp; b").alias("description"),
        )
    )
    script = lambda x: F.concat(F.lit('<script type="application/ld+json">'), x, F.lit("</script>"))
    body = (
        F.when(C("page_id") % 3 == 0, F.concat(script(F.lit("{broken")), script(F.lit('{"@type":"Org"}')), script(doc)))
        .when(C("page_id") % 3 == 1, script(F.concat(F.lit('[{"@type":"Org"},'), doc, F.lit("]"))))
        .otherwise(F.lit(""))
    )
    return df.select("page_id", "url", F.concat(C("html"), body).alias("html"))


@query(
    "src_06_json_ld_posting",
    "SRC-06 SRC-07",
    """SELECT page_id, CASE WHEN ok THEN 'Title ' || page_id END AS title, CASE WHEN ok THEN '2024-01-02' END AS "datePosted",
    CASE WHEN ok THEN 'Haifa' END AS job_location_locality, CASE WHEN ok THEN url END AS "hiring_org_sameAs", CASE WHEN ok THEN 5 END AS description_length,
    CAST(NULL AS STRING) AS industry FROM (SELECT *, page_id % 3 < 2 AS ok FROM pages) AS p""",
)
def json_ld(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _with_ld(spark, sf_dir).select("page_id", html.json_ld_posting(C("html")).alias("posting"))
    summary = html.posting_summary(C("posting"))
    shown = ("title", "datePosted", "job_location_locality", "hiring_org_sameAs", "description_length", "industry")
    return df.select("page_id", *[summary[n].alias(n) for n in shown])


def _parts_page(*pieces: str | Column) -> Column:
    """Page text from literals and columns; column texts are escaped."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else _escaped(p) for p in pieces])


def _escaped(c: Column) -> Column:
    out = c.cast("string")
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


@query(
    "src_08_html_rows",
    "SRC-08",
    """SELECT p_partkey, 0 AS pos, p_name AS name, 'https://x.org/p/' || p_partkey AS link, '<b>' || p_name || '</b>' AS inner, p_type AS kind FROM part
    UNION ALL SELECT p_partkey, 1, p_brand || ' & ' || p_size, NULL, '<b>' || p_brand || ' &amp; ' || p_size || '</b>', NULL FROM part WHERE p_size % 2 = 0""",
)
def html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spread(table(spark, sf_dir, "part"))
    first = _parts_page(
        "<h1>Parts</h1><ul class='a list'><li class=row><span><b>", C("p_name"), "</b></span><a data-href='/no' href='/p/", C("p_partkey"),
        "' title=\"", C("p_type"), "\">more</a>",
    )
    second = _parts_page("<li class='row even'><span><b>", F.concat_ws(" & ", "p_brand", C("p_size").cast("string")), "</b></span></li>")
    page = F.concat(first, F.when(C("p_size") % 2 == 0, second).otherwise(F.lit("<li class='row'></li>")), F.lit("</ul><li class='row'>outside"))
    fields = {
        "name": "span", "link": {"selector": "a", "attr": "href", "urljoin": True}, "inner": {"selector": "span", "attr": "html"},
        "kind": {"selector": "a", "attr": "title"},
    }
    rows = html.html_rows(page, F.lit("https://x.org/list?x=1"), "ul.list > li.row", fields)
    found = html.explode_rows(df, rows, ["p_partkey"])
    return found.select("p_partkey", "pos", *[C("row")[n].alias(n) for n in ("name", "link", "inner", "kind")])


HREFS = """SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS i FROM pages"""


@query(
    "src_09_page_links",
    "SRC-09 URL-06",
    f"""SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || href AS link FROM (SELECT DISTINCT page_id, url, trim(href) AS href FROM ({HREFS}) AS h) AS d
    WHERE starts_with(href, '/') AND href <> '/'""",
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "pages")
    return df.select("page_id", F.explode(html.links(C("html"), C("url"), "/")).alias("link"))


@query(
    "src_09_page_metadata",
    "SRC-09",
    """SELECT page_id, 'https://x.org/b.js' AS script, 2 AS scripts, 'second' AS meta, 'hidden' AS code, url AS detail FROM pages""",
)
def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "pages")
    extra = F.lit(
        '<script src="/a.js"></script><script async src="https://x.org/b.js"></script><script src="/a.js"></script>'
        '<meta property="p" content="first"><meta name="p" content="second"><meta name="q"><code id="c" style="x"> hidden </code>'
        '<base href="https://x.org/x/">'
    )
    page = F.concat(F.regexp_replace("html", "<meta[^>]*>|<base[^>]*>", ""), extra, F.lit('<a href="'), C("url"), F.lit('/jobs/results/12-a?x=1&amp;y=2">'))
    df = df.select("page_id", "url", page.alias("page"))
    scripts = html.script_links(C("page"), C("url"))
    return df.select(
        "page_id", F.element_at(scripts, 2).alias("script"), F.size(scripts).alias("scripts"),
        html.meta_values(C("page"))["p"].alias("meta"), html.hidden_codes(C("page"))["c"].alias("code"),
        F.replace(html.detail_links(C("page"), C("url"))["12"], F.lit("/jobs/results/12-a?x=1&y=2"), F.lit("")).alias("detail"),
    )


@query(
    "src_10_html_description",
    "SRC-10",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '<p>' || p_name || '</p> in <i>' || p_type || '</i>' ELSE p_brand END AS body,
    CASE WHEN p_size % 3 = 0 THEN p_name || ' in ' || p_type ELSE p_brand END AS text, 'about ' || p_name AS stated FROM part""",
)
def html_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = _parts_page("<div id=main><div class='text'> <p>", C("p_name"), "</p> in <i>", C("p_type"), "</i> </div></div>")
    page = F.concat(
        _parts_page('<meta name="description" content="about ', C("p_name"), '"><div class="text"></div>'),
        F.when(C("p_size") % 3 == 0, main).otherwise(F.lit("<div id=main><div class=text> </div></div>")),
        _parts_page("<footer>", C("p_brand"), "</footer>"),
    )
    df = spread(table(spark, sf_dir, "part"))
    return df.select(
        "p_partkey",
        html.html_description(page, ["div.missing", "#main div.text", "footer"]).alias("body"),
        html.html_description(page, ["div.missing", "#main div.text", "footer"], "text").alias("text"),
        html.html_description(page, ["div.missing", {"selector": "meta[name=description]", "attr": "content"}, "footer"]).alias("stated"),
    )


@query(
    "src_13_canonical_page",
    "SRC-13",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://www.linkedin.com/jobs/view/x-' || page_id WHEN 1 THEN 'https://il.linkedin.com/jobs/view/' || page_id
    WHEN 2 THEN 'https://www.linkedin.com/jobs/view/9' || page_id END AS link FROM pages""",
)
def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "pages")
    extra = (
        F.when(C("page_id") % 4 == 0, F.concat(F.lit('<link href="https://www.linkedin.com/jobs/view/x-'), C("page_id"), F.lit('?trk=1" rel="canonical">')))
        .when(C("page_id") % 4 == 1, F.concat(F.lit('<link rel="canonical" href="https://www.linkedin.com/feed"><meta content="https://il.linkedin.com/jobs/view/'), C("page_id"), F.lit('" property="og:url">')))
        .otherwise("")
    )
    answered = F.when(C("page_id") % 4 == 2, F.concat(F.lit("https://www.linkedin.com/jobs/view/9"), C("page_id"), F.lit("#top"))).otherwise(C("url"))
    return df.select("page_id", html.canonical_page(F.concat(C("html"), extra), answered).alias("link"))


@query(
    "src_14_labelled_values",
    "SRC-14",
    """SELECT p_partkey, p_type AS job_level, CASE WHEN p_size % 2 = 0 THEN p_brand || ' & more' END AS job_type, p_name AS industry FROM part""",
)
def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(
        C("p_size") % 2 == 0, _parts_page("<li><h3>Employment type</h3> <br><span>", F.concat("p_brand", F.lit(" & more")), "</span></li>")
    ).otherwise(F.lit("<li><h3>Employment</h3><span>no label</span></li>"))
    page = F.concat(
        _parts_page('<ul><li><h3 class="k"> Seniority level </h3><span> ', C("p_type"), " </span></li>"), kind,
        _parts_page('</ul><span class="x industry">', C("p_name"), "</span>"),
    )
    values = html.labelled_values(page, {"job_level": "Seniority level", "job_type": "Employment type"}, {"industry": "span.industry"})
    return spread(table(spark, sf_dir, "part")).select("p_partkey", *[values[n].alias(n) for n in ("job_level", "job_type", "industry")])


@query(
    "src_02_link_rows",
    "SRC-02",
    oracle("SELECT seq AS file, k AS pos, 'https://x.org/' || id || '/' || k AS link FROM positions, (VALUES (0), (1)) AS n(k)", "positions"),
)
def link_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links from each of the shapes a file of links may have."""
    one = lambda k: F.to_json(F.struct(F.concat(F.lit("https://x.org/"), C("id"), F.lit(f"/{k}")).alias("url")))
    listed = F.concat(F.lit("["), one(0), F.lit(","), one(1), F.lit("]"))
    wrap = lambda a, b: F.concat(F.lit(a), listed, F.lit(b))
    shape = (
        F.when(C("seq") % 3 == 0, listed).when(C("seq") % 3 == 1, wrap('{"jobs":', "}")).otherwise(wrap('{"table":{"columns":[],"rows":', "}}"))
    )
    rows = landing.explode_items(_docs(spark, sf_dir, shape), landing.link_rows(C("doc")), ["file"])
    return rows.select("file", "pos", F.variant_get("item", "$.url", "string").alias("link"))
