"""Queries over feed mapping and landed source objects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.functions.location import display_location
from postline.operators import feed
from postline.plans.derive import RUN_DATE, derived, oracle
from postline.plans.records import clean
from postline.plans.registry import query
from postline.sources.landed import map_landed
from postline.sources.specs import FeedConfig

C = F.col
S = F.struct


def lit(value: str, name: str) -> Column:
    return F.lit(value).alias(name)


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "positions")
    row = S(
        C("seq").alias("jobId"), C("name").alias("jobTitle"), S(C("city_2").alias("name")).alias("location"),
        F.concat(F.lit("0"), C("size") % 9 + 1, F.lit("/02/2001")).alias("openDate"), C("detail_name").alias("description"),
        C("kind").alias("requirements"), F.array(F.lit("Full-Time"), C("kind")).alias("types"), C("active_1").alias("open"),
        F.array(S(lit("Team", "name"), C("page_key").alias("value"))).alias("metadata"), C("size").alias("status"),
    )
    return df.select("seq", F.parse_json(F.to_json(row)).alias("item"))


FEED = FeedConfig(
    name="acme",
    field_paths={
        "title": "jobTitle", "id": "jobId", "city": "location.name", "date_posted": "openDate", "job_type": "types",
        "is_remote": "open", "job_function": "metadata.Team.value", "listing_type": ["missing", "requirements"],
    },
    templates={"job_url": "https://acme.example.com/jobs/{jobId}?s={status}"},
    constants={"country": "Israel", "job_level": "any"},
    value_maps={"listing_type": {"PROMO": "Promotion"}, "city": {"Village1": "Haifa"}},
    defaults={"company_url": "https://acme.example.com"},
    filters=({"path": "status", "in": [1, 2, 3, 5, 8, 13, 21, 34]}, {"path": "jobTitle", "exists": True}),
    location_paths=("location.name",),
    description_sections=(("About", "description"), (None, "requirements")),
)
CITY = "CASE WHEN city_2 = 'Village1' THEN 'Haifa' ELSE city_2 END"


@query(
    "prj_17_config_field_mapping",
    "PRJ-17 EXT-01 FLT-02 FLT-03 STR-09 STR-10 JSN-02",
    oracle(
        f"""SELECT seq, CAST(seq AS STRING) AS id, name AS title, 'Acme' AS company_name, 'https://acme.example.com/jobs/' || seq || '?s=' || size AS job_url,
        concat_ws(', ', {CITY}, 'Israel') AS shown, nullif(concat_ws(chr(10) || chr(10), '### About' || chr(10) || chr(10) || detail_name, kind), '') AS description,
        'https://acme.example.com' AS company_url_direct, 'fulltime' AS job_type, CAST('2001-02-0' || (size % 9 + 1) AS DATE) AS date_posted, active_1 AS is_remote,
        CASE WHEN kind = 'PROMO' THEN 'Promotion' ELSE kind END AS listing_type, 'any' AS job_level, page_key AS job_function
        FROM positions WHERE size IN (1, 2, 3, 5, 8, 13, 21, 34) AND contains(lower(city_2), 'village')""",
        "positions",
    ),
)
def config_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed.match(_feed(spark, sf_dir), FEED, " Village ")
    mapped = feed.map_feed(rows, FEED)
    return mapped.select(
        "seq", "id", "title", "company_name", "job_url", display_location(C("location")).alias("shown"), "description",
        "company_url_direct", F.array_join("job_type", ",").alias("job_type"), "date_posted", "is_remote", "listing_type", "job_level", "job_function",
    )


@query(
    "prj_18_infer_feed_mapping",
    "PRJ-18",
    oracle(
        """SELECT seq, CAST(seq AS STRING) AS id, name AS title, 'https://x.org/' || seq AS job_url, 'https://x.org/' || seq AS apply_url,
        concat_ws(', ', city_2, 'Israel') AS shown, 'Acme' AS company_name FROM positions""",
        "positions",
    ),
)
def infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "positions")
    row = S(C("seq").alias("jobId"), C("name").alias("text"), F.concat(F.lit("https://x.org/"), C("seq")).alias("hostedUrl"),
            S(F.coalesce(C("city_2"), F.lit("")).alias("location")).alias("categories"))
    rows = df.select("seq", F.parse_json(F.to_json(row)).alias("item"))
    config = feed.infer_mapping(rows, "Acme", "https://x.org", "Israel")
    mapped = feed.map_feed(rows, config)
    return mapped.select(
        "seq", "id", "title", "job_url", "apply_url", display_location(C("location")).alias("shown"), "company_name"
    )


@query(
    "prj_18_many_feeds",
    "PRJ-18 EXT-01",
    oracle(
        """SELECT seq, 'feed ' || (seq % 40) AS company_name, CAST(seq AS STRING) AS id, name AS title, 'https://x.org/' || seq AS job_url,
        CASE WHEN seq % 4 = 1 THEN 'https://a.org/' || seq ELSE 'https://x.org/' || seq END AS apply_url,
        concat_ws(', ', city_2, CASE WHEN (seq % 40) % 8 < 4 THEN 'Israel' ELSE 'France' END) AS shown FROM positions WHERE seq % 4 < 3""",
        "positions",
    ),
)
def many_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty feeds of four shapes; those of the last one show no title. What only later rows hold is not looked at."""
    df = derived(spark, sf_dir, "positions").withColumn("feed", C("seq") % 40)
    link, city = F.concat(F.lit("https://x.org/"), C("seq")), F.coalesce(C("city_2"), F.lit(""))
    later = F.when(C("seq") >= 400, F.lit("https://later.org"))
    shapes = [
        S(C("seq").alias("id"), C("name").alias("title"), link.alias("absolute_url"), S(city.alias("name")).alias("location"), later.alias("apply_url")),
        S(C("seq").alias("jobId"), C("name").alias("jobTitle"), later.alias("title"), link.alias("hostedUrl"),
          F.concat(F.lit("https://a.org/"), C("seq")).alias("applyUrl"), S(city.alias("location")).alias("categories")),
        S(C("seq").alias("requisition_id"), C("name").alias("text"), link.alias("job_url"), city.alias("location"), later.alias("jobId")),
        S(C("seq").alias("id"), link.alias("url"), later.alias("title")),
    ]
    texts = [F.to_json(s) for s in shapes]
    text = F.when(C("seq") % 4 == 0, texts[0]).when(C("seq") % 4 == 1, texts[1]).when(C("seq") % 4 == 2, texts[2]).otherwise(texts[3])
    rows = df.select("seq", "feed", F.parse_json(text).alias("item"))
    feeds = df.groupBy("feed").agg(F.count("*").alias("_n")).select(
        "feed", F.concat(F.lit("feed "), C("feed")).alias("company_name"), F.concat(F.lit("https://f.org/"), C("feed")).alias("url"),
        F.when(C("feed") % 8 < 4, "Israel").otherwise("France").alias("country"),
    )
    mapped = feed.map_feeds(rows, feed.infer_mappings(rows, feeds))
    return mapped.select("seq", "company_name", "id", "title", "job_url", "apply_url", display_location(C("location")).alias("shown"))


@query(
    "prj_23_company_name_fallback",
    "PRJ-23",
    oracle(
        f"""SELECT seq, CASE seq % 4 WHEN 0 THEN page_key WHEN 1 THEN name WHEN 2 THEN {clean('logo_medium')} ELSE kind END AS company,
        CASE WHEN seq % 2 = 0 THEN url ELSE 'cell ' || seq END AS link FROM positions""",
        "positions",
    ),
)
def company_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.operators.companies import company_name_of, link_of

    df = derived(spark, sf_dir, "positions")
    cells = S(C("kind").alias("fldName"), F.concat(F.lit("cell "), C("seq")).alias("fldLink"))
    none = F.lit(None).cast("string")
    row = F.when(
        C("seq") % 4 == 0, F.to_json(S(C("page_key").alias("company_name"), lit("x", "company"), C("url").alias("job_url")))
    ).when(
        C("seq") % 4 == 1, F.to_json(S(lit(" ", "company_name"), S(C("name")).alias("company"), cells.alias("cellValuesByColumnId")))
    ).when(
        C("seq") % 4 == 2, F.to_json(S(C("logo_medium").alias("company"), C("url").alias("job_url")))
    ).otherwise(F.to_json(S(none.alias("company"), cells.alias("cellValuesByColumnId"))))
    doc = F.parse_json(row)
    return df.select("seq", company_name_of(doc, "fldName").alias("company"), link_of(doc, "fldLink").alias("link"))


SHOWN = ("id", "title", "company_name", "job_url", "date_posted", "place", "is_remote", "low", "pay_interval", "types", "listing_type")


def landed(source: str, job: Callable[[], Column], page: Callable[[], Column] | None, detail: Callable[[], Column] | None, **expected: str) -> None:
    """Register one source: documents built from position columns, expected values in SQL."""
    parts = {n: expected.get(n, {"low": "CAST(NULL AS DOUBLE)", "is_remote": "CAST(NULL AS BOOLEAN)", "date_posted": "CAST(NULL AS DATE)"}.get(n, "CAST(NULL AS STRING)")) for n in SHOWN}
    where = expected.get("where", "TRUE")
    sql = "SELECT seq, " + ", ".join(f"{e} AS {n}" for n, e in parts.items()) + f" FROM positions WHERE {where}"

    @query(f"prj_21_{source}_landing", "PRJ-21 PRJ-22", oracle(sql, "positions"))
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = derived(spark, sf_dir, "positions")
        made = {"job": F.parse_json(F.to_json(job()))}
        if page is not None:
            made["page"] = F.parse_json(F.to_json(page()))
        if detail is not None:
            made["detail"] = F.parse_json(F.to_json(detail()))
        mapped = map_landed(df.select("seq", *[v.alias(n) for n, v in made.items()]), source, RUN_DATE)
        return mapped.select(
            "seq", "id", "title", "company_name", "job_url", "date_posted",
            F.nullif(display_location(C("location")), F.lit("")).alias("place"), "is_remote",
            C("compensation.min_amount").alias("low"), C("compensation.pay_interval").alias("pay_interval"),
            F.array_join("job_type", ",").alias("types"), "listing_type",
        )


RUN = f"DATE '{RUN_DATE}'"
landed(
    "indeed",
    lambda: S(
        C("id").alias("key"), C("name").alias("title"), (C("size") * F.lit(86400000).cast("bigint")).alias("datePublished"),
        S(C("kind").alias("name"), C("url").alias("relativeCompanyPageUrl")).alias("employer"),
        S(C("city_1").alias("city"), C("country_1").alias("countryCode"), S(C("city_1").alias("long")).alias("formatted")).alias("location"),
        F.array(S(F.when(C("size") % 2 == 0, "Full-time").otherwise("Remote work").alias("label"))).alias("attributes"),
        S(S(lit("year", "unitOfWork"), S((C("price") + 0.5).alias("min"), C("price").alias("max")).alias("range")).alias("baseSalary"), lit("USD", "currencyCode")).alias("compensation"),
        S(lit("<p>hi</p>", "html")).alias("description"),
    ),
    lambda: S(lit("https://il.indeed.com", "base_url")), None,
    id="'in-' || id", title="name", company_name="kind", job_url="'https://il.indeed.com/viewjob?jk=' || id",
    date_posted="DATE '1970-01-01' + size", place="concat_ws(', ', city_1, upper(country_1[1:1]) || country_1[2:])",
    is_remote="size % 2 = 1", low="CAST(price AS DOUBLE)", pay_interval="'yearly'", types="CASE WHEN size % 2 = 0 THEN 'fulltime' END",
)
landed(
    "glassdoor",
    lambda: S(
        S(
            S(C("seq").alias("listingId"), C("name").alias("jobTitleText")).alias("job"),
            S(
                C("kind").alias("employerNameFromSearch"), S(C("size").alias("id")).alias("employer"),
                F.concat(C("city_1"), F.lit(", MA")).alias("locationName"), F.when(C("size") % 3 == 0, "S").otherwise("C").alias("locationType"),
                F.when(C("size") % 5 > 0, C("size")).alias("ageInDays"), lit("HOUR", "payPeriod"),
                S((C("price") + 0.5).alias("p10"), (C("price") + 9).alias("p90")).alias("payPeriodAdjustedPay"),
                lit("USD", "payCurrency"), lit("SPONSORED", "adOrderSponsorshipLevel"),
            ).alias("header"),
        ).alias("jobview")
    ),
    lambda: S(lit("https://www.glassdoor.com/", "base_url")), None,
    id="'gd-' || seq", title="name", company_name="kind", job_url="'https://www.glassdoor.com/job-listing/j?jl=' || seq",
    date_posted=f"CASE WHEN size % 5 > 0 THEN {RUN} - size END", place="CASE WHEN size % 3 > 0 THEN city_1 || ', MA' END", is_remote="size % 3 = 0",
    low="CAST(price AS DOUBLE)", pay_interval="'hourly'", listing_type="'sponsored'",
)
landed(
    "zip_recruiter",
    lambda: S(
        C("id").alias("listing_key"), C("name"), S(C("kind").alias("name")).alias("hiring_company"), C("city_1").alias("job_city"),
        lit("TX", "job_state"), F.when(C("size") % 2 == 0, "US").otherwise("CA").alias("job_country"), lit("part_time", "employment_type"),
        lit("2001-03-04T10:00:00Z", "posted_time"), lit("annual", "compensation_interval"), (C("price") + 0.9).alias("compensation_min"),
        C("price").alias("compensation_max"), lit("USD", "compensation_currency"), lit(" text ", "job_description"), lit("paid", "buyer_type"),
    ),
    lambda: S(lit("https://www.ziprecruiter.com", "base_url")), None,
    id="'zr-' || id", title="name", company_name="kind", job_url="'https://www.ziprecruiter.com/jobs//j?lvk=' || id", date_posted="DATE '2001-03-04'",
    place="city_1 || ', TX, ' || CASE WHEN size % 2 = 0 THEN 'USA' ELSE 'Canada' END", low="CAST(price AS DOUBLE)", pay_interval="'yearly'",
    types="'parttime'", listing_type="'paid'",
)
landed(
    "greenhouse",
    lambda: S(
        F.when(C("size") % 2 == 0, C("seq")).alias("id"), C("name").alias("title"),
        F.concat(F.lit("https://boards.greenhouse.io/acme/jobs/"), C("seq"), F.lit("?gh_src=1")).alias("publicUrl"), C("kind").alias("companyName"),
        F.when(C("size") % 3 == 0, "remote").when(C("size") % 3 == 1, "in_person").alias("workType"), F.array(C("city_1"), lit("IL", "x")).alias("locations"),
        lit("2001-05-06T01:00:00+03:00", "firstPublished"),
        F.array(S(F.format_number("price", 2).alias("min"), F.format_number(C("price") + 10, 2).alias("max"), lit("EUR", "currency_type")),
                S(F.format_number(C("price") + 5, 2).alias("min"), lit("9.99", "max"), lit("EUR", "currency_type"))).alias("payRanges"),
    ),
    None, lambda: S(C("detail_name").alias("company_name"), lit("Full-time", "employment"), lit("<p>x</p>", "content")),
    id="'gh-' || seq", title="name", company_name="coalesce(detail_name, kind)", job_url="'https://boards.greenhouse.io/acme/jobs/' || seq",
    date_posted="DATE '2001-05-06'", place="city_1 || ', IL'", is_remote="CASE size % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END",
    low="CAST(price AS DOUBLE)", pay_interval="'yearly'", types="'fulltime'",
    listing_type="CASE size % 3 WHEN 0 THEN 'remote' WHEN 1 THEN 'in_person' END",
)
landed(
    "comeet",
    lambda: S(
        C("id").alias("uid"), C("name"), F.concat(F.lit("https://www.comeet.com/jobs/a/b/c/"), C("id")).alias("url_comeet_hosted_page"),
        S(C("city_1").alias("city"), lit("il", "country"), (C("size") % 4 == 0).alias("is_remote")).alias("location"),
        F.when(C("size") % 3 == 0, "On-site").when(C("size") % 3 == 1, "Remote").alias("workplace_type"), lit("Contract", "employment_type"),
        lit("2001-01-02T03:04:05", "time_updated"),
        S(F.array(S(lit("A", "name"), lit("<b>x</b>", "value")), S(lit("B", "name"), lit(" ", "value"))).alias("details")).alias("custom_fields"),
    ),
    lambda: S(C("kind").alias("name"), lit("acme.com", "website")), None,
    id="id", title="name", company_name="kind", job_url="'https://www.comeet.com/jobs/a/b/c/' || id", date_posted="DATE '2001-01-02'",
    place="city_1 || ', Israel'", is_remote="CASE WHEN size % 4 = 0 THEN TRUE WHEN size % 3 = 1 THEN TRUE WHEN size % 3 = 0 THEN FALSE END", types="'contract'",
    listing_type="CASE size % 3 WHEN 0 THEN 'On-site' WHEN 1 THEN 'Remote' END",
)
landed(
    "eightfold",
    lambda: S(
        C("id"), C("name"), C("url").alias("positionUrl"), F.array(F.concat(C("city_1"), F.lit(", TLV, Israel"))).alias("standardizedLocations"),
        (C("size") * 86400 + 5).alias("postedTs"), F.when(C("size") % 2 == 0, "remote").otherwise("onsite").alias("workLocationOption"),
    ),
    lambda: S(lit("https://acme.eightfold.ai/careers", "base_url"), C("kind").alias("company_name")),
    lambda: S(C("detail_url").alias("publicUrl"), lit("<p>x</p>", "jobDescription")),
    id="id", title="name", company_name="kind", job_url="'https://acme.eightfold.ai' || coalesce(detail_url, url)", date_posted="DATE '1970-01-01' + size",
    place="city_1 || ', TLV, Israel'", is_remote="size % 2 = 0", listing_type="CASE WHEN size % 2 = 0 THEN 'remote' ELSE 'onsite' END",
)
landed(
    "workday",
    lambda: S(
        C("name").alias("title"), F.concat(F.lit("/job/x/Engineer_R-"), C("seq")).alias("externalPath"),
        F.when(C("size") % 2 == 0, "Posted Today").otherwise(F.concat(F.lit("Posted "), C("size"), F.lit(" Days Ago"))).alias("postedOn"),
        F.when(C("size") % 3 == 0, "2 Locations").otherwise(F.concat(F.lit("US-CA - "), C("city_1"), F.lit(" - HQ"))).alias("locationsText"),
    ),
    lambda: S(lit("https://acme.wd1.myworkdayjobs.com/Careers", "base_url"), C("kind").alias("company_name")),
    lambda: S(S(C("detail_name").alias("title"), lit("Full time", "timeType"), S(lit("Israel", "descriptor")).alias("country"),
                F.when(C("size") % 3 == 0, F.array(F.lit("Haifa"), F.lit("Remote - IL"), F.lit("Haifa"))).alias("additionalLocations")).alias("jobPostingInfo")),
    id="'R-' || seq", title="coalesce(detail_name, name)", company_name="kind", job_url="'https://acme.wd1.myworkdayjobs.com/job/x/Engineer_R-' || seq",
    date_posted=f"CASE WHEN size % 2 = 0 THEN {RUN} ELSE {RUN} - size END",
    place="CASE WHEN size % 3 = 0 THEN 'Haifa / Remote, Israel' ELSE city_1 || ', Israel' END", is_remote="size % 3 = 0",
    types="'fulltime'", listing_type="CASE WHEN size % 3 = 0 THEN 'remote' END",
)
landed(
    "varonis",
    lambda: S(C("id").alias("eId"), C("name").alias("title"), lit("01/03/2001", "datePosted"), C("parent_city").alias("locationCity"), C("kind").alias("subDepartment")),
    lambda: S(C("city_2").alias("city"), C("country_2").alias("country"), C("url").alias("jobDetailsUrl")),
    lambda: S(C("detail_url").alias("job_url")),
    id="id", title="name", company_name="'Varonis'", job_url="coalesce(detail_url, url)", date_posted="DATE '2001-03-01'",
    place="coalesce(city_2, parent_city) || ', ' || CASE country_2 WHEN 'usa' THEN 'USA' ELSE 'Israel' END", listing_type="kind",
)
landed(
    "apple",
    lambda: S(
        C("id").alias("reqId"), C("name").alias("postingTitle"), lit("engineer", "transformedPostingTitle"), lit("3 Feb 2001", "postingDate"),
        S(lit("SFT", "teamCode"), C("kind").alias("teamName")).alias("team"), (C("size") % 2 == 0).alias("homeOffice"),
        F.array(S(C("active_1").alias("active"), F.lit(None).cast("string").alias("city"), C("city_1").alias("name"), C("country_1").alias("countryName")),
                S(C("active_2").alias("active"), C("city_2").alias("city"), lit("town", "name"), C("country_2").alias("countryName"))).alias("locations"),
    ),
    None, lambda: S(C("detail_name").alias("postingTitle"), lit("one\ntwo", "responsibilities")),
    id="id", title="coalesce(detail_name, name)", company_name="'Apple'", job_url="'https://jobs.apple.com/en-us/details/' || id || '/engineer?team=SFT'",
    date_posted="DATE '2001-02-03'",
    place="""CASE WHEN active_2 AND NOT active_1 THEN coalesce(city_2, 'town') || ', ' || CASE country_2 WHEN 'usa' THEN 'USA' ELSE 'Israel' END
             ELSE city_1 || ', ' || upper(country_1[1:1]) || country_1[2:] END""",
    is_remote="size % 2 = 0", listing_type="CASE WHEN size % 2 = 0 THEN 'remote' END",
)
landed(
    "meta",
    lambda: S(C("name").alias("title"), F.concat(F.lit("https://www.metacareers.com/jobs/"), C("seq"), F.lit("/")).alias("job_url"),
              F.concat(C("city_1"), F.lit(", CA, US")).alias("location")),
    None, lambda: S(C("detail_name").alias("title"), lit("2001-04-05T00:00:00-08:00", "datePosted"), lit("d", "description"),
                    F.when(C("size") % 2 == 0, F.array(S(lit("Haifa, Israel", "name")))).alias("jobLocation")),
    id="CAST(seq AS STRING)", title="coalesce(detail_name, name)", company_name="'Meta'", job_url="'https://www.metacareers.com/jobs/' || seq || '/'",
    date_posted="DATE '2001-04-05'", place="CASE WHEN size % 2 = 0 THEN 'Haifa, Israel' ELSE city_1 || ', CA, USA' END",
)
landed(
    "naukri",
    lambda: S(
        C("seq").alias("jobId"), C("name").alias("title"), F.when(C("size") % 2 == 0, C("kind")).alias("companyName"), C("url").alias("jdURL"),
        F.array(S(lit("experience", "type"), lit("2-5 Yrs", "label")), S(lit("salary", "type"), F.concat(C("size"), F.lit("-60 Lacs P.A.")).alias("label")),
                S(lit("location", "type"), F.when(C("size") % 3 == 0, "Remote").otherwise(C("city_1")).alias("label"))).alias("placeholders"),
        F.when(C("size") % 4 > 0, F.concat(C("size"), F.lit(" Days Ago"))).otherwise("").alias("footerPlaceholderLabel"), F.lit(86400000).alias("createdDate"),
        lit('<span class="job-type">Full-Time</span>', "jobDescription"), lit("sql, spark,sql", "tagsAndSkills"),
    ),
    None, None,
    id="'nk-' || seq", title="name", company_name="CASE WHEN size % 2 = 0 THEN kind ELSE 'N/A' END", job_url="'https://www.naukri.com' || url",
    date_posted=f"CASE WHEN size % 4 > 0 THEN {RUN} - size ELSE DATE '1970-01-02' END",
    place="CASE WHEN size % 3 = 0 THEN 'Remote' ELSE city_1 END || ', India'", is_remote="size % 3 = 0", low="CAST(size * 100000 AS DOUBLE)", types="'fulltime'",
)
