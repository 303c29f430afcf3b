"""Files, pages, feeds, grids and sinks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from postline.functions.location import display_location
from postline.functions.markup import parse, select
from postline.operators import companies, feed, records, reports
from postline.sources import html, landing, sinks
from postline.sources.specs import FeedConfig

C = F.col


def write(folder, name, doc):
    (folder / name).write_text(json.dumps(doc), encoding="utf-8")
    return str(folder / name)


def test_posting_files(spark, tmp_path):
    write(tmp_path, "a.json", [{"title": "x"}, {"title": "é"}])
    write(tmp_path, "b.json", {"jobs": [{"title": "y"}]})
    rows = landing.read_postings(landing.documents(spark, str(tmp_path), whole=True))
    got = {(r["pos"], r["t"]) for r in rows.select("pos", F.variant_get("item", "$.title", "string").alias("t")).collect()}
    assert got == {(0, "x"), (1, "é"), (0, "y")}


@pytest.mark.parametrize("doc", [{"rows": []}, [1], "x", {"jobs": {}}])
def test_other_shapes_are_errors(spark, tmp_path, doc):
    path = write(tmp_path, "a.json", doc)
    with pytest.raises(Exception, match="expected a list of objects"):
        landing.read_postings(landing.documents(spark, path, whole=True)).collect()


def test_grid_needs_rows_and_columns(spark, tmp_path):
    path = write(tmp_path, "a.json", {"table": {"rows": [1], "columns": []}})
    with pytest.raises(Exception, match="rows list of objects"):
        docs = landing.documents(spark, path, whole=True)
        docs.select(landing.grid(C("doc"))[0]).collect()


def test_grid_schema_rules(spark):
    def header(*items):
        df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "pos int, t string")
        return companies.grid_schema(df.select("pos", F.parse_json("t").alias("item")))

    made = header(
        {"id": "1", "name": "Company", "type": "text"},
        {"id": "2", "name": "Head Count!", "type": "number"},
        {"id": "3", "name": "When", "type": "formula", "typeOptions": {"isDateTime": True}},
        {"id": "4", "name": "Updated", "type": "text"},
        {"id": "5", "name": "Tags", "type": "multiSelect", "typeOptions": {"choices": {"a": {"name": "A"}}}},
    )
    assert [(c.name, c.spark_type) for c in made] == [
        ("company_name", "string"), ("head_count", "bigint"), ("when", "timestamp"), ("source_updated_at", "timestamp"),
        ("tags", "array<string>"),
    ]
    assert made[4].choices == {"a": "A"}
    with pytest.raises(ValueError, match="two grid columns"):
        header({"id": "1", "name": "A b", "type": "text"}, {"id": "2", "name": "a-B", "type": "text"})
    with pytest.raises(ValueError, match="no safe column name"):
        header({"id": "1", "name": "9 lives", "type": "text"})


def test_activation_of_an_invalid_page_is_an_error(spark):
    pages = companies.complete_pages(spark.createDataFrame([("k", "n", True)], "company_key string, company_name string, enabled boolean"))
    bad = spark.createDataFrame([("k", "n", False)], "company_key string, company_name string, valid boolean")
    with pytest.raises(Exception, match="cannot activate"):
        companies.upsert_validated(pages, bad, "2001-01-01 00:00:00", activate=True).collect()


PAGE = """<html><base href="https://x.org/a/"><ul class="list"><li class="job new"><a href="1?x=1">One</a> <i> Haifa </i>
<li class="job"><a href="/2">Two</a><li class="job"></ul><h3>Job function</h3><span> IT, <b>Ops</b></span></html>"""


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "https://x.org/a/b", PAGE), (2, "u", None), (3, "u", "<li class=job")], "k int, u string, h string")
    fields = {"title": "a", "link": {"selector": "a", "attr": "href", "urljoin": True}, "place": {"selector": "i"}, "inner": {"attr": "html", "selector": "a"}}
    rows = html.explode_rows(df, html.html_rows(C("h"), C("u"), "ul.list > li.job", fields), ["k"]).collect()
    assert [(r["k"], r["pos"], r["row"]) for r in rows] == [
        (1, 0, {"title": "One", "link": "https://x.org/a/1?x=1", "place": "Haifa", "inner": "One"}),
        (1, 1, {"title": "Two", "link": "https://x.org/2", "inner": "Two"}),
    ]


def test_selectors():
    tree = parse('<div class="a b"><ul><li id=x>1<li>2</ul><p>t<p>u</div><span data-q="zz">v</span><br><img src=q>')
    text = lambda s: [n.text() for n in select(tree, s)]
    assert text("div.a li") == ["1", "2"] and text("ul > li#x") == ["1"] and text("div > p") == ["t", "u"]
    assert text("[data-q^=z]") == ["v"] and text("li, span") == ["1", "2", "v"] and text("p li") == []
    with pytest.raises(ValueError, match="unsupported selector"):
        text("li:first-child")


def test_descriptions_and_labels(value):
    page = F.lit(PAGE)
    assert value(html.html_description(page, ["div", "h3"])) == "Job function"
    assert value(html.html_description(page, ["span"])) == "IT, <b>Ops</b>"
    assert value(html.labelled_values(page, {"job_function": "Job function"})) == {"job_function": "IT,Ops"}


FEED = FeedConfig(
    name="f",
    field_paths={"title": "t", "job_url": "u", "city": "place.city", "is_remote": "r", "skills": "s", "job_type": "k"},
    constants={"country": "Israel"},
    defaults={"company_name": "Acme"},
    filters=({"path": "n", "equals": 1}, {"path": "on", "equals": True}, {"path": "w", "contains": "AB"}),
    description_paths=("d1", "d2"),
)


def test_feed(spark):
    docs = [
        {"t": "A", "u": "https://x.org/1", "place": {"city": "Haifa"}, "r": "Remote", "s": ["a", " a", "b"], "k": ["Full Time", "?"], "n": 1.0, "on": True, "w": "xabx", "d1": "one", "d2": "<b>two</b>"},
        {"t": " ", "u": "https://x.org/2", "n": 1, "on": True, "w": "ab"},
        {"t": "B", "u": "https://x.org/3", "n": 2, "on": True, "w": "ab"},
        {"t": "C", "u": "https://x.org/4", "n": 1, "on": False, "w": "ab"},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "seq int, j string")
    rows = feed.map_feed(feed.match(df.select("seq", F.parse_json("j").alias("item")), FEED), FEED)
    got = rows.withColumn("shown", display_location(C("location"))).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["shown"], r["is_remote"], r["skills"], r["job_type"], r["description"], r["company_name"]) == (
        "Haifa, Israel", True, ["a", "b"], ["fulltime"], "one\n\n**two**", "Acme",
    )


def test_no_mapping_without_title(spark):
    df = spark.createDataFrame([(1, '{"x":1}')], "seq int, j string").select("seq", F.parse_json("j").alias("item"))
    assert feed.infer_mapping(df, "n", "u", "Israel") is None


def test_record_golden(spark):
    row = {
        "seq": 1, "site": "LinkedIn", "title": " Engineer ", "company": "Acme", "job_url": "https://www.linkedin.com/jobs/view/eng-at-acme-123?trk=1",
        "company_url": "https://www.linkedin.com/company/acme/?x=1", "date_posted": "2024-01-02", "is_remote": True, "min_amount": 1.0, "currency": "USD",
        "applications_count": "12", "apply_url": "https://x.org/a",
    }
    raw = spark.createDataFrame([row])
    got = records.build_records(raw).first().asDict()
    wanted = {
        "title": "Engineer", "job_url": "https://www.linkedin.com/jobs/view/123", "external_id": "123", "company_id": "acme",
        "company_url": "https://www.linkedin.com/company/acme", "work_type": "remote", "salary": "USD 1.0", "apply_type": "linkedin",
        "apply_url": "https://x.org/a", "source": "linkedin", "applications_count": "12", "benefits": None,
    }
    assert {k: got[k] for k in wanted} == wanted
    assert got["raw_json"]["title"] == '" Engineer "' and got["raw_json"]["is_remote"] == "true"


def test_rejects_have_reasons(spark):
    rows = [(1, "google_careers", "t", "https://x.org"), (2, "indeed", " ", "https://www.indeed.com/viewjob?jk=1"),
            (3, "indeed", "t", "https://www.indeed.com/viewjob?jk=%20"), (4, "meta", "t", "https://metacareers.com/jobs/1")]
    raw = spark.createDataFrame(rows, "seq int, site string, title string, job_url string")
    got = {r["seq"]: r["reject_reason"] for r in records.rejects(records.map_records(raw)).collect()}
    assert got == {1: "unsupported_source", 2: "missing_title", 3: "invalid_url", 4: "invalid_url"}


def test_validation_reports_empty_sources(spark):
    raw = spark.createDataFrame([(1, "indeed", "indeed", "t", "https://www.indeed.com/viewjob?jk=1")], "seq int, source string, site string, title string, job_url string")
    pages = spark.createDataFrame([("indeed",), ("meta",)], "source string")
    got = {r["source"]: (r["status"], r["errors"]) for r in reports.validate_sources(raw, pages).collect()}
    assert got == {"indeed": ("valid", ""), "meta": ("failed", "no jobs")}


def test_json_sink_replaces_only_its_sources(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", "1"), ("b", "é")], "site string, id string")
    sinks.write_json(df, path)
    sinks.write_json(df.where("site = 'a'").withColumn("id", F.lit("2")), path)
    assert {(r["site"], r["id"]) for r in spark.read.schema("id string, site string").json(path).collect()} == {("a", "2"), ("b", "é")}


def test_report_counts_only_stored_runs(spark):
    runs = spark.createDataFrame([("b", 2, True, True), ("a", 3, True, True), ("c", 9, True, False)], "site string, jobs_retrieved int, scraped boolean, persisted boolean")
    r = reports.run_report(runs, "2001-01-01T00:00:00").first()
    assert (r["site_count"], r["sites"], r["jobs_retrieved"]) == (2, "a,b", 5)


def test_lines_of_a_file_are_documents(spark, tmp_path):
    lines = ['{"jobs":[{"id":1},{"id":2}]}', "", '[{"id":3}]']
    (tmp_path / "many.json").write_text("\n".join(lines))
    rows = landing.read_postings(landing.documents(spark, str(tmp_path))).select(F.variant_get("item", "$.id", "int").alias("id"))
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3]


def test_grid_header_is_that_of_all_documents(spark):
    def schema(*columns):
        df = spark.createDataFrame([(i, c) for i, c in enumerate(columns)], "pos int, t string")
        return companies.grid_schema(df.select("pos", F.parse_json("t").alias("item")))

    a, b = '{"id":"f1","name":"Name","type":"text"}', '{"id":"f2","name":"Size","type":"number"}'
    assert [c.source_id for c in schema(a, a, b, a)] == ["f1", "f2"]
    with pytest.raises(ValueError, match="two ways"):
        schema(a, '{"id":"f1","name":"Name","type":"number"}')


def test_script_links_have_no_limit_and_read_whole_names(spark, value):
    page = "".join(f"<script data-src='/no{i}.js' src='/s{i}.js'></script>" for i in range(60)) + "<script async src=/bare.js></script>"
    found = value(html.script_links(F.lit(page), F.lit("https://x.org/")))
    assert found == [f"https://x.org/s{i}.js" for i in range(60)] + ["https://x.org/bare.js"]
    anchors = F.lit("<a data-href='/no' href='/yes'>x</a><a href=/bare>y</a>")
    assert value(html.links(anchors, F.lit("https://x.org/"), "/")) == ["https://x.org/yes", "https://x.org/bare"]


def test_a_selector_may_state_its_attribute(value):
    page = F.lit("<div class='d'></div><p title='from title'>text</p>")
    assert value(html.html_description(page, ["div.d", {"selector": "p", "attr": "title"}])) == "from title"


def test_probe_walks_known_keys_to_any_depth(spark):
    """Against the walk written as a recursion, on random payloads and one two hundred levels deep."""

    def walk(p):
        if isinstance(p, list):
            return p
        for k in landing.ROW_KEYS if isinstance(p, dict) else ():
            inner = p.get(k)
            found = walk(inner)
            if isinstance(inner, list) or found:
                return found
        return []

    r = random.Random(1)

    def payload(depth):
        if depth == 0 or r.random() < 0.2:
            return r.choice([1, "a", None, [], [1], [{"a": r.randrange(99)}], {}])
        return {k: payload(depth - 1) for k in r.sample((*landing.ROW_KEYS, "other"), r.randrange(4))}

    docs = [payload(6) for _ in range(800)]
    deep = [{"z": 1}]
    for _ in range(200):
        deep = {r.choice(landing.ROW_KEYS): deep}
    docs.append(deep)
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, t string")
    got = df.select("i", F.to_json(landing.probe_rows(F.parse_json("t"))).alias("r")).collect()
    assert {x["i"]: json.loads(x["r"]) for x in got} == {i: walk(d) for i, d in enumerate(docs)}


def test_mappings_of_many_feeds_are_data(spark):
    """Each feed's first object decides; scalars before it, feeds without title or link and unknown feeds drop out."""
    rows = [
        ("a", 1, 5), ("a", 2, {"title": "t1", "url": "https://a/1", "location": "Haifa"}), ("a", 3, {"title": "t2", "jobUrl": "https://no", "url": "https://a/2"}),
        ("b", 4, {"text": "t3", "hostedUrl": "https://b/1", "applyUrl": "https://b/a", "title": None}), ("b", 5, {"title": "no", "hostedUrl": "https://b/2"}),
        ("c", 6, {"title": "t4"}), ("c", 7, {"title": "t5", "url": "https://c/1"}), (None, 8, {"title": "t6", "url": "https://d/1"}), ("x", 9, {"title": "t7", "url": "https://x/1"}),
    ]
    df = spark.createDataFrame([(f, s, json.dumps(d)) for f, s, d in rows], "feed string, seq int, t string").select("feed", "seq", F.parse_json("t").alias("item"))
    feeds = spark.createDataFrame([(f, f"name {f}", f"https://{f}.org", "Israel") for f in "abcde"], "feed string, company_name string, url string, country string")
    mappings = feed.infer_mappings(df, feeds)
    paths = {r["feed"]: r["paths"] for r in mappings.collect()}
    assert paths == {
        "a": {"title": "title", "job_url": "url", "apply_url": "url", "city": "location", "job_url_direct": "url"},
        "b": {"title": "text", "job_url": "hostedUrl", "apply_url": "applyUrl", "job_url_direct": "hostedUrl"},
    }
    got = sorted((r["seq"], r["title"], r["job_url"], r["apply_url"], r["company_name"]) for r in feed.map_feeds(df, mappings).collect())
    assert got == [
        (2, "t1", "https://a/1", "https://a/1", "name a"), (3, "t2", "https://a/2", "https://a/2", "name a"), (4, "t3", "https://b/1", "https://b/a", "name b"),
    ]
    near = feed.map_feeds(df, mappings, location="haifa").select("seq").collect()
    assert [r["seq"] for r in near] == [2]
    one = feed.map_feed(df.where("feed = 'a'"), feed.infer_mapping(df.where("seq in (2, 3)"), "name a", "https://a.org", "Israel"))
    same = feed.map_feeds(df.where("feed = 'a'"), mappings)
    assert sorted(map(str, one.select("id", "title", "job_url", "location").collect())) == sorted(map(str, same.select("id", "title", "job_url", "location").collect()))


def test_rows_of_one_group_are_dealt_over_tasks(spark, tmp_path):
    from postline.plans import load
    from postline.plans.derive import derived

    rows = spark.range(400).selectExpr(
        "id AS p_partkey", "'a b' AS p_name", "'Brand#1' AS p_brand", "'SMALL' AS p_type", "CAST(id % 50 AS INT) AS p_size", "900.5D AS p_retailprice"
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    cores = spark.sparkContext.defaultParallelism
    assert derived(spark, str(tmp_path), "positions").rdd.getNumPartitions() >= 4 * cores
    for name in ("src_08_html_rows", "src_10_html_description", "src_14_labelled_values", "str_07_html_to_markdown", "prj_21_comeet_landing"):
        found = load()[name].build(spark, str(tmp_path))
        filled = found.select(F.spark_partition_id().alias("task")).distinct().count()
        assert filled > cores, name


def test_joined_url_in_steps_is_the_expression(spark):
    from postline.functions import url

    bases = ["https://x.org/a/b?c=d#e", "https://x.org", "HTTP://X.org/a/./b/", " https://x.org/a ", "", "x.org/a", None]
    links = ["/p/../q?r=/../s", "c/./d", "?z=1", "#f", "//y.org/a", "mailto:a@b.c", "..", "../..", "/a/..", "", " ", None, " e.html "]
    rows = spark.createDataFrame([(b, x) for b in bases for x in links], "b string, x string")
    both = url.with_joined_url(rows.withColumn("one", url.join_url(F.col("b"), F.col("x"))), "steps", "b", "x").collect()
    assert len(both) == len(bases) * len(links)
    assert [r["one"] for r in both] == [r["steps"] for r in both]


@pytest.mark.parametrize("source", ["eightfold", "workday", "greenhouse"])
def test_landed_filter_reads_the_link_as_a_column(spark, source):
    from postline.sources.landed import map_landed

    rows = spark.range(1).select(F.col("id").alias("seq"), *[F.parse_json(F.concat(F.lit('{"id":'), "id", F.lit("}"))).alias(n) for n in ("job", "page", "detail")])
    plan = map_landed(rows, source, "2001-10-01").select("seq", "location")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and all("variant_get" not in line and "regexp" not in line for line in filters)
