"""Raw objects of the JSON-shaped sources to posting columns.

A landed table has `seq`, `job` (VARIANT) and, where a source has them,
`detail` (VARIANT, the posting's own page) and `page` (VARIANT, the careers
page it belongs to). Each source is a table of paths; shared rules come from
the function modules. Paths start with job, detail or page; of several the
first with a value counts, so a detail named first beats the summary.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions import dates, jobs, location, money, text, url
from postline.functions.payload import first_in_list

POSTING = (
    "id", "title", "company_name", "job_url", "apply_url", "job_url_direct", "location", "description", "company_url",
    "company_url_direct", "company_logo", "company_industry", "company_description", "company_addresses",
    "company_num_employees", "company_revenue", "job_type", "compensation", "date_posted", "is_remote", "listing_type",
    "job_level", "job_function", "skills", "experience_range", "company_rating", "company_reviews_count", "vacancy_count",
    "work_from_home_type",
)
TYPES = {
    "location": "struct<city:string,state:string,country:string>",
    "job_type": "array<string>",
    "compensation": "struct<pay_interval:string,min_amount:double,max_amount:double,currency:string>",
    "date_posted": "date",
    "is_remote": "boolean",
    "skills": "array<string>",
    "company_rating": "double",
    "company_reviews_count": "bigint",
    "vacancy_count": "bigint",
}


class Doc:
    """Reads paths of one landed row. A source without details or pages has nulls there."""

    def __init__(self, run_date: Column, style: str) -> None:
        self.run_date, self.style = run_date, style

    @property
    def link(self) -> Column:
        return F.col("_link")

    def at(self, path: str, kind: str) -> Column:
        root, _, rest = path.partition(".")
        return F.try_variant_get(F.col(root), f"$.{rest}", kind)

    def text(self, *paths: str) -> Column:
        return F.coalesce(*[text.clean_text(self.at(p, "string")) for p in paths])

    def number(self, *paths: str) -> Column:
        return F.coalesce(*[self.at(p, "double") for p in paths])

    def flag(self, *paths: str) -> Column:
        return F.coalesce(*[self.at(p, "boolean") for p in paths])

    def items(self, path: str, kind: str = "variant") -> Column:
        return self.at(path, f"array<{kind}>")

    def joined(self, *paths: str) -> Column:
        """Text at a path; a list there is joined by commas."""
        def one(p: str) -> Column:
            return F.coalesce(F.array_join(text.ordered_distinct(self.items(p, "string")), ", "), self.at(p, "string"))

        return F.coalesce(*[text.clean_text(one(p)) for p in paths])

    def body(self, *paths: str) -> Column:
        raw = self.text(*paths)
        if self.style == "html":
            return raw
        return (text.html_to_plain if self.style == "plain" else text.html_to_markdown)(raw)

    def labelled(self, path: str, kind: str) -> Column:
        """Label of the first item of that type in a list of {type, label}."""
        hit = F.filter(self.items(path), lambda x: F.try_variant_get(x, "$.type", "string") == kind)
        return F.try_variant_get(F.try_element_at(hit, F.lit(1)), "$.label", "string")


Rule = Callable[[Doc], Column]


@dataclass(frozen=True)
class Landed:
    """Columns of one source; `rules` override `texts` and `constants`.

    `steps` are made in order, each in a projection of its own, for rules that read
    them as columns. `joined` is a base address and a link that together make `_joined`. `place` is the text of the location (`offices`: a list) with its
    style, `home` the country that goes with it.
    """

    texts: dict[str, tuple[str, ...]] = field(default_factory=dict)
    constants: dict[str, str] = field(default_factory=dict)
    rules: dict[str, Rule] = field(default_factory=dict)
    same_as_link: tuple[str, ...] = ()
    steps: dict[str, Rule] = field(default_factory=dict)
    joined: tuple[Rule, Rule] | None = None
    place: tuple[Rule, str] | None = None
    home: Rule | None = None


def _prefixed(prefix: str, *paths: str) -> Rule:
    return lambda d: F.concat(F.lit(prefix), d.text(*paths))


def _indeed_pay(d: Doc) -> Column:
    def side(root: str, money_root: str) -> dict[str, Column]:
        return {
            "unit": d.at(f"{root}.unitOfWork", "string"),
            "low": d.at(f"{root}.range.min", "double"),
            "high": d.at(f"{root}.range.max", "double"),
            "currency": d.at(f"{money_root}.currencyCode", "string"),
        }

    return money.structured_pay(
        side("job.compensation.baseSalary", "job.compensation"),
        side("job.compensation.estimated.baseSalary", "job.compensation.estimated"),
    )


def _labels(d: Doc) -> Column:
    return F.transform(d.items("job.attributes"), lambda a: F.try_variant_get(a, "$.label", "string"))


def _pay_struct(interval: Column, low: Column, high: Column, currency: Column) -> Column:
    return F.struct(
        interval.alias("pay_interval"), low.alias("min_amount"), high.alias("max_amount"), currency.alias("currency")
    )


def _ranges(d: Doc, path: str) -> Column:
    return F.transform(
        d.items(path),
        lambda r: F.struct(
            F.try_variant_get(r, "$.min", "string").alias("low"),
            F.try_variant_get(r, "$.max", "string").alias("high"),
            F.try_variant_get(r, "$.currency_type", "string").alias("currency"),
        ),
    )


def _detail_sections(d: Doc, level: int, parts: list[tuple[str, tuple[str, ...]]], lines: bool) -> Column:
    made = []
    for title, paths in parts:
        body = d.text(*paths)
        made.append((title, text.bullet_lines(body, d.style) if lines else body))
    return text.sections(made, d.style, level)


def _glassdoor_place(d: Doc) -> Column:
    name = d.text("job.jobview.header.locationName")
    return F.when(F.coalesce(d.text("job.jobview.header.locationType"), F.lit("")) != "S", name)


def _eightfold_place(d: Doc) -> Column:
    return F.coalesce(
        first_in_list(F.col("job"), "standardizedLocations"), first_in_list(F.col("job"), "locations"),
        d.text("detail.location"),
    )


def _greenhouse_link(d: Doc) -> Column:
    return F.coalesce(
        url.drop_query_key(d.at("detail.public_url", "string"), "gh_src"),
        url.drop_query_key(d.at("job.publicUrl", "string"), "gh_src"),
    )


def _workday_offices(d: Doc) -> Column:
    first = F.array(d.text("detail.jobPostingInfo.location", "job.locationsText"))
    first = F.filter(first, lambda x: F.lower(x) != "2 locations")
    more = F.coalesce(d.items("detail.jobPostingInfo.additionalLocations", "string"), F.array().cast("array<string>"))
    return F.concat(first, more)


def _workday_remote(d: Doc) -> Column:
    raw = F.concat_ws(
        " ", d.text("detail.jobPostingInfo.location"), d.text("job.locationsText"),
        F.coalesce(d.items("detail.jobPostingInfo.additionalLocations", "string"), F.array().cast("array<string>")),
    )
    return raw.rlike(r"(?i)\bremote\b")


def _apple_places(d: Doc) -> Column:
    raw = F.coalesce(d.items("detail.locations"), d.items("job.locations"))
    return F.transform(
        raw,
        lambda p: F.struct(
            F.coalesce(F.try_variant_get(p, "$.active", "boolean"), F.lit(False)).alias("active"),
            F.try_variant_get(p, "$.city", "string").alias("city"),
            F.try_variant_get(p, "$.name", "string").alias("name"),
            F.try_variant_get(p, "$.stateProvince", "string").alias("state"),
            F.try_variant_get(p, "$.countryName", "string").alias("country"),
        ),
    )


def _comeet_body(d: Doc) -> Column:
    parts = F.transform(
        d.items("job.custom_fields.details"),
        lambda s: F.struct(
            text.clean_text(F.try_variant_get(s, "$.name", "string")).alias("name"),
            text.clean_text(F.try_variant_get(s, "$.value", "string")).alias("value"),
        ),
    )
    shown = F.transform(
        F.filter(parts, lambda s: s["value"].isNotNull()),
        lambda s: F.concat(F.coalesce(F.concat(F.lit("<h3>"), s["name"], F.lit("</h3>")), F.lit("")), s["value"]),
    )
    html = F.nullif(F.array_join(shown, ""), F.lit(""))
    if d.style == "html":
        return html
    return (text.html_to_plain if d.style == "plain" else text.html_to_markdown)(html)


def _naukri_remote(d: Doc) -> Column:
    return jobs.is_remote(d.text("job.title"), d.text("job.jobDescription"), d.labelled("job.placeholders", "location"))


APPLE = "https://jobs.apple.com"
META = "https://www.metacareers.com"
VARONIS = "https://careers.varonis.com"

# Paths, prefixes and constants of each source.
LANDED: dict[str, Landed] = {
    "indeed": Landed(
        texts={
            "title": ("job.title",), "company_name": ("job.employer.name",),
            "company_url_direct": ("job.employer.dossier.links.corporateWebsite",),
            "job_url_direct": ("job.recruit.viewJobUrl",),
            "company_addresses": ("job.employer.dossier.employerDetails.addresses[0]",),
            "company_num_employees": ("job.employer.dossier.employerDetails.employeesLocalizedLabel",),
            "company_revenue": ("job.employer.dossier.employerDetails.revenueLocalizedLabel",),
            "company_description": ("job.employer.dossier.employerDetails.briefDescription",),
            "company_logo": ("job.employer.dossier.images.squareLogoUrl",),
        },
        rules={
            "id": _prefixed("in-", "job.key"),
            "job_url": lambda d: F.concat(d.text("page.base_url"), F.lit("/viewjob?jk="), d.text("job.key")),
            "company_url": lambda d: F.concat(d.text("page.base_url"), d.text("job.employer.relativeCompanyPageUrl")),
            "description": lambda d: d.body("job.description.html"),
            "location": lambda d: location.place(
                d.text("job.location.city"), d.text("job.location.admin1Code"), d.text("job.location.countryCode")
            ),
            "job_type": lambda d: jobs.job_type_list(_labels(d)),
            "date_posted": lambda d: dates.epoch_date(d.number("job.datePublished"), "milliseconds"),
            "compensation": _indeed_pay,
            "is_remote": lambda d: jobs.is_remote(
                F.array_join(_labels(d), " "), d.text("job.description.html"), d.text("job.location.formatted.long")
            ),
            "company_industry": lambda d: text.industry_label(d.text("job.employer.dossier.employerDetails.industry")),
        },
    ),
    "glassdoor": Landed(
        texts={
            "title": ("job.jobview.job.jobTitleText",),
            "company_name": ("job.jobview.header.employerNameFromSearch",),
            "company_logo": ("job.jobview.overview.squareLogoUrl",),
            "description": ("detail.description",),
        },
        rules={
            "id": _prefixed("gd-", "job.jobview.job.listingId"),
            "job_url": lambda d: F.concat(
                d.text("page.base_url"), F.lit("job-listing/j?jl="), d.text("job.jobview.job.listingId")
            ),
            "company_url": lambda d: F.concat(
                d.text("page.base_url"), F.lit("Overview/W-EI_IE"), d.text("job.jobview.header.employer.id"), F.lit(".htm")
            ),
            "is_remote": lambda d: F.coalesce(d.text("job.jobview.header.locationType") == "S", F.lit(False)),
            "date_posted": lambda d: dates.age_date(d.number("job.jobview.header.ageInDays"), d.run_date),
            "compensation": lambda d: money.percentile_pay(
                d.text("job.jobview.header.payPeriod"), d.number("job.jobview.header.payPeriodAdjustedPay.p10"),
                d.number("job.jobview.header.payPeriodAdjustedPay.p90"), d.text("job.jobview.header.payCurrency"),
            ),
            "listing_type": lambda d: F.lower(d.text("job.jobview.header.adOrderSponsorshipLevel")),
        },
        place=(_glassdoor_place, "glassdoor"),
    ),
    "zip_recruiter": Landed(
        texts={
            "title": ("job.name",), "company_name": ("job.hiring_company.name",), "listing_type": ("job.buyer_type",),
            "job_url_direct": ("detail.job_url_direct",),
        },
        rules={
            "id": _prefixed("zr-", "job.listing_key"),
            "job_url": lambda d: F.concat(d.text("page.base_url"), F.lit("/jobs//j?lvk="), d.text("job.listing_key")),
            "description": lambda d: F.coalesce(d.text("detail.description"), d.body("job.job_description")),
            "location": lambda d: location.place(
                d.text("job.job_city"), d.text("job.job_state"),
                F.when(d.text("job.job_country") == "US", F.lit("usa")).otherwise(F.lit("canada")),
            ),
            "job_type": lambda d: jobs.job_type_list(
                F.array(F.replace(d.text("job.employment_type"), F.lit("_"), F.lit("")))
            ),
            "date_posted": lambda d: dates.iso_date(d.text("job.posted_time")),
            "compensation": lambda d: _pay_struct(
                F.when(d.text("job.compensation_interval") == "annual", F.lit("yearly")).otherwise(
                    d.text("job.compensation_interval")
                ),
                F.floor(d.number("job.compensation_min")), F.floor(d.number("job.compensation_max")),
                d.text("job.compensation_currency"),
            ),
        },
    ),
    "greenhouse": Landed(
        texts={
            "title": ("job.title",), "company_name": ("detail.company_name", "job.companyName"),
            "listing_type": ("job.workType",), "company_logo": ("job.logoUrl",),
        },
        rules={
            "id": lambda d: F.coalesce(F.concat(F.lit("gh-"), d.text("job.id")), url.board_id(d.link)),
            "job_url": _greenhouse_link,
            "apply_url": lambda d: F.coalesce(
                url.drop_query_key(d.at("detail.redirect_to", "string"), "gh_src"), d.link
            ),
            "company_url": lambda d: url.site_root(d.link),
            "company_url_direct": lambda d: url.site_root(d.link),
            "description": lambda d: d.body("detail.content"),
            "job_type": lambda d: F.when(
                F.lower(d.text("detail.employment")) != "hidden", jobs.job_type_list(F.array(d.text("detail.employment")))
            ),
            "compensation": lambda d: money.pay_envelope(F.col("_ranges")),
            "date_posted": lambda d: dates.iso_date(d.text("detail.published_at", "job.firstPublished")),
            "is_remote": lambda d: jobs.remote_by_workplace(F.lit(None).cast("boolean"), d.text("job.workType")),
        },
        same_as_link=("job_url_direct",),
        steps={"_ranges": lambda d: F.coalesce(_ranges(d, "detail.pay_ranges"), _ranges(d, "job.payRanges"))},
        place=(lambda d: d.joined("detail.job_post_location", "job.locations"), "greenhouse"),
    ),
    "comeet": Landed(
        texts={
            "id": ("job.uid",), "title": ("job.name",),
            "job_url": ("job.url_comeet_hosted_page", "job.url_recruit_hosted_page"),
            "company_name": ("job.company_name", "page.name"), "job_url_direct": ("job.url_active_page",),
            "listing_type": ("job.workplace_type",), "job_level": ("job.experience_level",),
            "company_logo": (
                "page.logos.medium.url", "page.logos.small.url", "page.logos.original.url", "page.company_picture_url",
            ),
        },
        rules={
            "description": _comeet_body,
            "location": lambda d: location.place(
                d.text("job.location.city"), d.text("job.location.state"),
                location.hosted_country(d.text("job.location.country")),
            ),
            "company_url": lambda d: url.company_website(d.text("page.website")),
            "company_url_direct": lambda d: url.company_website(d.text("page.website")),
            "job_type": lambda d: jobs.job_type_list(F.array(d.text("job.employment_type"))),
            "date_posted": lambda d: dates.iso_date(d.text("job.time_updated")),
            "is_remote": lambda d: jobs.remote_by_workplace(
                F.nullif(d.flag("job.location.is_remote"), F.lit(False)), d.text("job.workplace_type")
            ),
        },
        same_as_link=("apply_url",),
    ),
    "eightfold": Landed(
        texts={
            "id": ("job.id", "detail.id"), "title": ("job.name", "detail.name"), "company_name": ("page.company_name",),
            "company_url": ("page.company_url",), "company_url_direct": ("page.company_url",),
            "company_logo": ("page.company_logo",),
            "listing_type": ("job.workLocationOption", "detail.workLocationOption"),
        },
        rules={
            "job_url": lambda d: F.col("_joined"),
            "description": lambda d: d.body("detail.jobDescription"),
            "date_posted": lambda d: dates.epoch_date(d.number("job.postedTs", "detail.postedTs")),
            "is_remote": lambda d: F.coalesce(
                d.text("job.workLocationOption", "detail.workLocationOption") == "remote", F.lit(False)
            ),
        },
        same_as_link=("apply_url",),
        joined=(lambda d: d.text("page.base_url"), lambda d: d.text("detail.publicUrl", "detail.positionUrl", "job.positionUrl")),
        place=(_eightfold_place, "eightfold"),
    ),
    "workday": Landed(
        texts={
            "title": ("detail.jobPostingInfo.title", "job.title"), "company_name": ("page.company_name",),
            "company_url": ("page.canonical_url",), "company_url_direct": ("page.canonical_url",),
            "company_description": ("page.company_description",), "company_logo": ("page.company_logo",),
        },
        rules={
            "job_url": lambda d: F.coalesce(
                d.text("detail.jobPostingInfo.externalUrl"),
                F.when(d.text("job.externalPath").isNotNull(), F.col("_joined")),
            ),
            "id": lambda d: F.coalesce(
                d.text("detail.jobPostingInfo.jobReqId"), d.text("job.bulletFields[0]"),
                url.found(F.rtrim(d.text("detail.jobPostingInfo.externalUrl", "job.externalPath"), F.lit("/")), r"_([^/?#]+)$"),
                d.text("detail.jobPostingInfo.id"),
            ),
            "description": lambda d: d.body("detail.jobPostingInfo.jobDescription"),
            "job_type": lambda d: jobs.job_types_by_schedule(
                d.text("detail.jobPostingInfo.timeType"), d.text("detail.jobPostingInfo.title", "job.title")
            ),
            "date_posted": lambda d: F.coalesce(
                dates.iso_date(d.text("detail.jobPostingInfo.startDate")),
                dates.relative_date(d.text("job.postedOn"), d.run_date),
            ),
            "is_remote": _workday_remote,
            "listing_type": lambda d: F.when(_workday_remote(d), F.lit("remote")),
        },
        same_as_link=("apply_url", "job_url_direct"),
        joined=(lambda d: d.text("page.base_url"), lambda d: d.text("job.externalPath")),
        place=(_workday_offices, "offices"),
        home=lambda d: d.text("detail.jobPostingInfo.country.descriptor"),
    ),
    "varonis": Landed(
        texts={
            "id": ("job.eId",), "title": ("job.title",),
            "job_url": ("detail.job_url", "page.jobDetailsUrl", "page.applyUrl"), "apply_url": ("page.applyUrl",),
            "description": ("detail.description",), "job_function": ("job.department",),
            "listing_type": ("job.subDepartment",),
        },
        constants={"company_name": "Varonis", "company_url": VARONIS, "company_url_direct": VARONIS},
        rules={
            "location": lambda d: location.place(
                d.text("page.city", "job.locationCity"), d.text("page.state"),
                F.coalesce(d.text("page.country", "job.locationCountry"), F.lit("Israel")),
            ),
            "date_posted": lambda d: dates.parse_date(d.text("job.datePosted"), "feed"),
        },
        same_as_link=("apply_url", "job_url_direct"),
    ),
    "apple": Landed(
        texts={
            "id": ("detail.jobNumber", "job.reqId", "job.id"), "title": ("detail.postingTitle", "job.postingTitle"),
        },
        constants={"company_name": "Apple", "company_url": APPLE, "company_url_direct": APPLE},
        rules={
            "job_url": lambda d: url.detail_url(
                F.lit(APPLE), F.coalesce(d.text("page.locale"), F.lit("en-us")), d.text("job.reqId", "job.id"),
                d.text("job.transformedPostingTitle"), d.text("job.team.teamCode"),
            ),
            "description": lambda d: _detail_sections(d, 2, [
                ("Summary", ("detail.jobSummary", "job.jobSummary")), ("Description", ("detail.description",)),
                ("Responsibilities", ("detail.responsibilities",)),
                ("Minimum Qualifications", ("detail.minimumQualifications",)),
                ("Preferred Qualifications", ("detail.preferredQualifications",)),
                ("Additional Requirements", ("detail.additionalRequirements",)),
            ], True),
            "location": lambda d: location.stated_place(F.col("_chosen")),
            "date_posted": lambda d: dates.parse_date(
                d.text("detail.postingDateMeta", "detail.postDateInGMT", "job.postDateInGMT", "job.postingDate"), "careers"
            ),
            "is_remote": lambda d: d.flag("detail.homeOffice", "job.homeOffice"),
            "listing_type": lambda d: F.when(d.flag("detail.homeOffice", "job.homeOffice"), F.lit("remote")),
            "job_function": lambda d: F.coalesce(
                first_in_list(F.coalesce(F.col("detail"), F.col("job")), "teamNames"),
                d.text("detail.team.teamName", "job.team.teamName"),
            ),
        },
        same_as_link=("apply_url", "job_url_direct"),
        steps={"_places": _apple_places, "_chosen": lambda d: location.chosen_place(F.col("_places"))},
    ),
    "meta": Landed(
        texts={
            "title": ("detail.title", "job.title"), "job_url": ("job.job_url",),
            "job_function": ("job.job_function",), "job_level": ("job.job_level",),
        },
        constants={"company_name": "Meta", "company_url": META, "company_url_direct": META},
        rules={
            "id": lambda d: F.coalesce(d.text("job.id"), url.found(d.text("job.job_url"), r"/jobs/(\d+)")),
            "description": lambda d: _detail_sections(d, 2, [
                ("Description", ("detail.description",)), ("Responsibilities", ("detail.responsibilities",)),
                ("Qualifications", ("detail.qualifications",)),
            ], False),
            "date_posted": lambda d: dates.iso_date(d.text("detail.datePosted")),
        },
        same_as_link=("apply_url", "job_url_direct"),
        place=(lambda d: d.text("detail.jobLocation[0].name", "detail.jobLocation.name", "job.location"), "meta"),
    ),
    "naukri": Landed(
        texts={
            "experience_range": ("job.experienceText",), "company_logo": ("job.logoPathV3", "job.logoPath"),
        },
        rules={
            "id": _prefixed("nk-", "job.jobId"),
            "title": lambda d: F.coalesce(d.text("job.title"), F.lit("N/A")),
            "company_name": lambda d: F.coalesce(d.text("job.companyName"), F.lit("N/A")),
            "company_url": lambda d: F.concat(F.lit("https://www.naukri.com/"), d.text("job.staticUrl")),
            "job_url": lambda d: F.concat(
                F.lit("https://www.naukri.com"), F.coalesce(d.text("job.jdURL"), F.concat(F.lit("/job/"), d.text("job.jobId")))
            ),
            "description": lambda d: d.body("job.jobDescription"),
            "compensation": lambda d: _lakh(d.labelled("job.placeholders", "salary")),
            "date_posted": lambda d: dates.footer_date(
                d.text("job.footerPlaceholderLabel"), d.number("job.createdDate"), d.run_date
            ),
            "job_type": lambda d: jobs.job_type_list(
                F.array(url.found(d.text("job.jobDescription"), r'(?s)<span[^>]*class="[^"]*\bjob-type\b[^"]*"[^>]*>(.*?)</span>'))
            ),
            "company_industry": lambda d: text.clean_text(
                url.found(d.text("job.jobDescription"), r'(?s)<span[^>]*class="[^"]*\bindustry\b[^"]*"[^>]*>(.*?)</span>')
            ),
            "is_remote": _naukri_remote,
            "skills": lambda d: text.to_text_list(d.text("job.tagsAndSkills")),
            "company_rating": lambda d: d.number("job.ambitionBoxData.AggregateRating"),
            "company_reviews_count": lambda d: d.number("job.ambitionBoxData.ReviewsCount"),
            "vacancy_count": lambda d: d.number("job.vacancy"),
            "work_from_home_type": lambda d: jobs.work_from_home_type(
                d.labelled("job.placeholders", "location"), d.text("job.title"), d.text("job.jobDescription")
            ),
        },
        place=(lambda d: d.labelled("job.placeholders", "location"), "naukri"),
    ),
}


def _lakh(label: Column) -> Column:
    pay = money.lakh_pay(label)
    return F.when(
        pay.isNotNull(), _pay_struct(F.lit(None).cast("string"), pay["min_amount"], pay["max_amount"], pay["currency"])
    )


def map_landed(df: DataFrame, source: str, run_date: str, style: str = "markdown") -> DataFrame:
    """Posting columns of one source; rows without title or link drop out."""
    for name in ("detail", "page"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("variant"))
    spec, doc = LANDED[source], Doc(F.lit(run_date).cast("date"), style)

    def value(name: str) -> Column:
        if name in spec.rules:
            made = spec.rules[name](doc)
        elif name in spec.texts:
            made = doc.text(*spec.texts[name])
        else:
            made = F.lit(spec.constants.get(name))
        return made.cast(TYPES.get(name, "string"))

    # The link and the steps of links and locations are made once, in projections of their
    # own; in one expression each branch that reads them would run them again.
    for name, rule in spec.steps.items():
        df = df.withColumn(name, rule(doc))
    if spec.joined:
        df = df.withColumns({"_base": spec.joined[0](doc), "_href": spec.joined[1](doc)})
        df = url.with_joined_url(df, "_joined", "_base", "_href")
    df = df.withColumns({"_link": value("job_url"), "_title": value("title")})
    # A filter goes below projections as one expression of all of them; it stays above numbered rows.
    df = df.withColumn("_row", F.monotonically_increasing_id())
    kept = df.where((F.col("_row") >= 0) & F.col("_title").isNotNull() & doc.link.isNotNull())
    if spec.place:
        rule, kind = spec.place
        kept = kept.withColumns({"_place": rule(doc), "_home": F.lit(None).cast("string") if spec.home is None else spec.home(doc)})
        kept = location.with_locations(kept, {"_location": ("_place", kind)}, F.col("_home"))
    made = {name: value(name) for name in POSTING} | {"job_url": doc.link, "title": F.col("_title")}
    if spec.place:
        made["location"] = F.col("_location").cast(TYPES["location"])
    for name in spec.same_as_link:
        made[name] = F.coalesce(made[name], doc.link)
    out = kept.select("seq", F.lit(source).alias("site"), *[made[n].alias(n) for n in POSTING])
    mails = text.extract_emails(F.col("description"))
    return out.withColumn("emails", F.when(F.size(mails) > 0, mails))
