"""Golden cases of the scalar rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postline.functions import dates, jobs, location, money, payload, text, url

L = F.lit
D = dt.date


def test_clean_text_strips_every_blank_and_nulls_blank(value):
    assert value(text.clean_text(L(" 　 a b\n"))) == "a b"
    assert value(text.clean_text(L(" \t "))) is None
    assert value(text.clean_text(L(7))) == "7"


def test_match_key_and_lists(value):
    assert value(text.match_key(L("  ACME \t Ltd "))) == "acme ltd"
    assert value(text.to_text_list(L("a, b,,a , c"))) == ["a", "b", "c"]
    assert value(text.split_skills(L("sql; spark,sql"))) == ["sql", "spark"]
    assert value(text.split_skills(L(" "))) is None


@pytest.mark.parametrize(
    ("given", "low", "high", "unit"),
    [
        ("$50k-$80k", 50000, 80000, "yearly"),
        ("pay $20 - $30 an hour", 20, 30, "hourly"),
        ("$5,000 – $6,000", 5000, 6000, "monthly"),
        ("$50-$80k", 50000, 80000, "yearly"),
        ("$1,200,000 - $1,300,000", None, None, None),
        ("$90 - $20", None, None, None),
        ("$100 - $400", None, None, None),
        ("no pay", None, None, None),
    ],
)
def test_salary_in_text(value, given, low, high, unit):
    got = value(money.extract_salary(L(given)))
    assert (got and (got.min_amount, got.max_amount, got.pay_interval)) == (low and (low, high, unit))


def test_salary_annual_keeps_written_interval(value):
    got = value(money.extract_salary(L("$20 - $30"), annual=True))
    assert (got.pay_interval, got.min_amount, got.max_amount) == ("hourly", 41600, 62400)


def test_currency_numbers(value):
    for given, wanted in {"1.234,56 €": 1234.56, "$1,234.56": 1234.56, "$50": 50.0, "x": None}.items():
        assert value(money.currency_number(L(given))) == wanted


def test_salary_text_writes_floats_without_exponent(value):
    got = value(money.salary_text(L(50000.0), L(12345678.5), L("yearly"), L("USD")))
    assert got == "USD 50000.0 - 12345678.5 yearly"
    assert value(money.salary_text(*[L(None).cast(t) for t in ("double", "double", "string", "string")])) is None


def test_salary_source_needs_a_minimum(value):
    assert value(money.salary_source(L(True), L(True), L(0.0))) is None
    assert value(money.salary_source(L(False), L(True), L(5.0))) == "description"


@pytest.mark.parametrize(
    ("given", "record", "feed"),
    [
        ("2024-01-02", D(2024, 1, 2), D(2024, 1, 2)),
        (" 2024-01-02T23:30:00+02:00 ", D(2024, 1, 2), D(2024, 1, 2)),
        ("2024/1/2", D(2024, 1, 2), D(2024, 1, 2)),
        ("13/02/2024", None, D(2024, 2, 13)),
        ("02/13/2024", None, D(2024, 2, 13)),
        ("2024-02-30", None, None),
        ("soon", None, None),
        (" ", None, None),
    ],
)
def test_dates(value, given, record, feed):
    assert value(dates.parse_date(L(given))) == record
    assert value(dates.parse_date(L(given), "feed")) == feed


def test_relative_dates(value):
    run = L("2024-05-05").cast("date")
    assert value(dates.relative_date(L("Posted 3 Days Ago"), run)) == D(2024, 5, 2)
    assert value(dates.relative_date(L("Posted Yesterday"), run)) == D(2024, 5, 4)
    assert value(dates.age_date(L(None).cast("int"), run)) is None


@pytest.mark.parametrize(
    ("base", "link", "wanted"),
    [
        ("https://a.b/c/d", "e", "https://a.b/c/e"),
        ("https://a.b/c/d", "../e", "https://a.b/e"),
        ("https://a.b/c/d/", "./..", "https://a.b/c/"),
        ("https://a.b", "e", "https://a.b/e"),
        ("https://a.b/c?x=1", "?y=2", "https://a.b/c?y=2"),
        ("https://a.b/c", "//h/x", "https://h/x"),
        ("https://a.b/c", "mailto:x@y.z", "mailto:x@y.z"),
    ],
)
def test_join_url(value, base, link, wanted):
    assert value(url.join_url(L(base), L(link))) == wanted


def test_urls_with_blanks_inside_are_still_split(value):
    p = url.split_url(L("https://a.b/c d?x=1 2#f"))
    assert value(F.array(p.scheme, p.host, p.path, p.query)) == ["https", "a.b", "/c d", "x=1 2"]


def test_cut_urls_equals_split_url(spark):
    links = ["https://a.b/c/d?x=1#f", " http://H.b ", "x?u=http://a.b/c", "//a.b/c", "", None, "https://a.b?q", "https://a.b#x?y"]
    df = spark.createDataFrame([(x,) for x in links], "u string").withColumn("u", text.clean_text(F.col("u")))
    cut = url.cut_urls(df, {"u": "p"})
    p, q = url.cut_parts("p"), url.split_url(F.col("u"))
    for a, b in ((p.scheme, q.scheme), (p.host, q.host), (p.path, q.path), (p.query, q.query)):
        assert cut.where(~a.eqNullSafe(b)).count() == 0


def test_query_keys(value):
    assert value(url.drop_query_key(L("https://a.b/c?x=1&GH_src=2&y=#f"), "gh_src")) == "https://a.b/c?x=1&y="
    assert value(url.set_query_key(L("https://a.b/c?x=1&y=2&x=3"), "x", L(9))) == "https://a.b/c?x=9&y=2"


def test_location_styles(value):
    cases = {
        ("linkedin", "A, B, israel"): ("A", "B", "israel"),
        ("linkedin", "A"): (None, None, "usa"),
        ("glassdoor", "A, B, C"): ("A", "B, C", None),
        ("eightfold", "A, B, C, D"): ("A, B", "C", "D"),
        ("eightfold", "US-City (x)"): ("City", None, "US"),
        ("workday", "US-CA - San Jose, CA - HQ"): ("San Jose", "CA", "usa"),
        ("meta", "A, , B, C"): ("A, B", None, "C"),
        ("greenhouse", "A, B"): ("A", "B", None),
    }
    for (style, given), wanted in cases.items():
        assert tuple(value(location.parse_location(L(given), style, L("usa")))) == wanted, style
    assert value(location.parse_location(L("Remote"), "glassdoor")) is None


def test_locations_from_shared_columns(spark):
    """The same places as from single expressions, odd texts too; each text is cleaned and cut once."""
    texts = ["A, B, israel", "A", "A, B, C, D", "US-City (x)", "US-CA - San Jose, CA - HQ", "A, , B, C", ", ,", " ", "", None, "Remote", "a-b", ",A,", "IL - Haifa - IL"]
    lists = [[a, b] for a, b in zip(texts, texts[1:] + texts[:1], strict=True)] + [[], None, [None], ["X - HQ", "X"]]
    texts += ["A, B"] * (len(lists) - len(texts))
    rows = spark.createDataFrame(list(zip(range(len(lists)), texts, lists, strict=True)), "i int, t string, l array<string>")
    styles = ["linkedin", "glassdoor", "greenhouse", "eightfold", "workday", "naukri", "bdjobs", "meta"]
    got = location.with_locations(rows, {s: ("t", s) for s in styles} | {"offices": ("l", "offices")}, L("usa"))
    want = rows.select("i", "t", "l", *[location.parse_location(F.col("t"), s, L("usa")).alias(s) for s in styles], location.join_offices(F.col("l"), L("usa")).alias("offices"))
    assert got.orderBy("i").collect() == want.orderBy("i").collect()
    assert got.columns == want.columns
    plain = location.with_locations(rows.select("i", "t"), {s: ("t", s) for s in styles if s != "workday"}, L("usa"))
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") - plan.count("split(_text0#") <= 2, plan  # the pieces, with blank ones and without


def test_display_and_countries(value):
    shown = location.display_location(location.place(L("A"), L(None).cast("string"), L("uk")))
    assert value(shown) == "A, UK"
    assert value(location.country_name(L("usa/ca"))) is None
    assert value(location.mentions_country("israel", L("Tel Aviv, IL"), L("Milan"))) is True
    assert value(location.mentions_country("israel", L("Milan, Brazil"))) is False
    assert value(location.mentions_country("worldwide", L("x"))) is True


def test_unknown_country_is_an_error(spark):
    with pytest.raises(Exception, match="unknown country"):
        spark.range(1).select(location.require_country(L("Narnia"))).collect()


def test_job_types(value):
    assert value(jobs.job_type_list(F.split(L("Full-time, x,Teil zeit,fulltime"), ","))) == ["fulltime", "parttime"]
    assert value(jobs.job_types_in_text(L("a Full Time contract"))) == ["fulltime", "contract"]
    assert value(jobs.job_types_in_text(L("none"))) is None
    assert value(jobs.remote_by_workplace(L(None).cast("boolean"), L("In_Person"))) is False


def test_payload_paths(value):
    doc = F.parse_json(L('{"a":[{"name":"Job Type","value":"x"},5],"b":{"c":null,"d":[1,2]},"e.f":1}'))
    wanted = {"a.Job Type.value": "x", "a[1]": "5", "b.c": None, "b.d": "[1,2]", "b.d.1": "2", "b.x.y": None}
    for path, got in wanted.items():
        assert value(payload.path_text(doc, path)) == got, path
    assert value(payload.path_text(doc, ["b.c", "a[1]"])) == "5"


def test_payload_keeps_json_types_apart(value):
    one, two = (payload.coerce_object(L(t)) for t in ('{"k":"1"}', '{"k":1}'))
    assert value(payload.payload_json(one)) != value(payload.payload_json(two))
    assert value(payload.coerce_object(L("[1]"))) == {}
    assert value(payload.payload_json(payload.coerce_object(L('{"b":{"z":1,"y":2},"a":0}')))) == '{"a":0,"b":{"y":2,"z":1}}'


def test_html_text_rules(value):
    page = L("<h2>T</h2><p>a <b>b</b> &amp; <a href='u'>l</a><script>x</script></p><ul><li>x</li><li>y</li></ul>")
    assert value(text.html_to_plain(page)) == "T a b & l x y"
    assert value(text.html_to_markdown(page)) == "## T\n\na **b** & [l](u)\n\n* x\n* y"
    assert value(text.format_description(L("&lt;p&gt;a&lt;/p&gt;"), "plain")) == "a"
    assert value(text.format_description(L("a &amp; b"), "html")) == "a &amp; b"
    assert value(text.repair_mojibake(L("cafÃ©"))) == "café"


def test_sections(value):
    parts = [("A", L("x")), ("B", L(" ")), (None, L("y"))]
    assert value(text.sections(parts)) == "### A\n\nx\n\ny"
    assert value(text.sections(parts, "html", 2)) == "<h2>A</h2>xy"
    assert value(text.sections([("A", L(None).cast("string"))])) is None
    assert value(text.bullet_lines(L("one\n two\n"))) == "- one\n- two"
