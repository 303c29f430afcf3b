"""Raw posting rows to the canonical record, all sources in one projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.dates import parse_clean_date
from postline.functions.money import safe_int, salary_text
from postline.functions.text import clean_text, first_non_blank, work_type
from postline.functions.url import (
    Parts,
    cut_parts,
    cut_urls,
    found,
    page_url,
    page_url_with_query,
    path_parts,
    profile_url,
    split_url,
)
from postline.operators.skew import attach
from postline.sources.specs import SPECS, SourceSpec

RECORD_COLUMNS = (
    "title",
    "location",
    "posted_time",
    "published_at",
    "job_url",
    "company_name",
    "company_url",
    "company_id",
    "description",
    "applications_count",
    "contract_type",
    "experience_level",
    "work_type",
    "sector",
    "salary",
    "poster_full_name",
    "poster_profile_url",
    "apply_url",
    "apply_type",
    "benefits",
    "source",
    "external_id",
    "raw_json",
)
MARKERS = ("direct_company_career_page_id", "direct_company_career_page_key")
RAW_TEXT = (
    "site", "source", "id", "external_id", "title", "company", "company_name", "location",
    "date_posted", "job_url", "apply_url", "job_url_direct", "company_url", "description",
    "applications_count", "job_type", "job_level", "company_industry", "job_function",
    "listing_type", "pay_interval", "currency", *MARKERS, "direct_company_career_page_company",
)


def detect_source(site: Column, source: Column) -> Column:
    """site, else source, else linkedin; lower case."""
    return F.lower(F.coalesce(clean_text(site), clean_text(source), F.lit("linkedin")))


def direct_page_source(row: Callable[[str], Column]) -> Column:
    """Company that publishes the posting itself, when a direct-page marker is set."""
    marked = first_non_blank(*[row(m) for m in MARKERS]).isNotNull()
    name = first_non_blank(
        row("direct_company_career_page_company"),
        row("company"),
        row("company_name"),
        row("direct_company_career_page_key"),
    )
    return F.when(marked, name)


def is_direct_page(payload: Column) -> Column:
    """A stored payload carries one of the direct-page markers."""
    values = [F.btrim(F.try_element_at(payload, F.lit(m)), F.lit('" ')) for m in MARKERS]
    tests = [v.isNotNull() & (v != "") & (v != "null") for v in values]
    return tests[0] | tests[1]


def raw_payload(df: DataFrame, skip: tuple[str, ...] = ("seq",)) -> Column:
    """The whole raw row as a payload: column -> JSON text of its value.

    Dates are written as ISO text. Nulls are kept as JSON null.
    """
    pairs: list[Column] = []
    for name, kind in df.dtypes:
        if name in skip:
            continue
        value = F.col(name)
        if kind in ("boolean", "int", "bigint", "double"):
            text = value.cast("string")
        elif kind.startswith(("array", "struct", "map", "variant")):
            text = F.to_json(value)
        else:
            text = json_text(value.cast("string"))
        pairs += [F.lit(name), F.coalesce(text, F.lit("null"))]
    return F.create_map(*pairs)


def json_text(c: Column) -> Column:
    """A text as JSON text, quoted; only texts that need escapes go through the JSON writer."""
    boxed = F.to_json(F.struct(c.alias("v")))
    escaped = F.substring(boxed, F.lit(6), F.length(boxed) - 6)
    return F.when(c.rlike(r'[\x00-\x1f"\\]'), escaped).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def _choose(source: Column, rule: Callable[[SourceSpec], Column | None], *fields: str) -> Column:
    """One when-chain over the sources.

    `fields` are the spec fields the rule reads: sources that agree on them
    share a branch, which keeps the expression small.
    """
    groups: dict[tuple, list[SourceSpec]] = {}
    for spec in SPECS:
        groups.setdefault(tuple(getattr(spec, f) for f in fields), []).append(spec)
    out = None
    for specs in groups.values():
        value = rule(specs[0])
        if value is None:
            continue
        test = source.isin(*[s.name for s in specs]) if len(specs) > 1 else source == specs[0].name
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def _link_id(spec: SourceSpec, p: Parts) -> Column | None:
    in_query = p.param(spec.query_id) if spec.query_id else None
    in_path = found(p.path, spec.path_id) if spec.path_id else None
    if in_query is None:
        return in_path
    return in_query if in_path is None else F.coalesce(in_query, in_path)


def canonical_link(spec: SourceSpec, p: Parts, link_id: Column) -> Column:
    """The kept form of a link that is valid for its source."""
    if spec.canonical == "fixed":
        return F.concat(F.lit(spec.fixed_url[0]), link_id, F.lit(spec.fixed_url[1]))
    if spec.canonical == "path_and_id":
        return F.concat(p.root, p.path, F.lit(f"?{spec.query_id}="), link_id)
    if spec.canonical == "page_query":
        return page_url_with_query(p)
    if spec.canonical == "board":
        in_path = F.contains(F.concat(p.bare_path, F.lit("/")), F.concat(F.lit("/"), link_id, F.lit("/")))
        tail = F.when(in_path, F.lit("")).otherwise(F.concat(F.lit(f"?{spec.query_id}="), link_id))
        return F.concat(p.root, p.bare_path, tail)
    if spec.canonical == "hosted":
        return F.concat(p.root, F.lit("/"), F.array_join(F.slice(path_parts(p), 1, 5), "/"))
    return page_url(p)


def valid_link(src: Column, job_url: Column) -> Column:
    """The raw link fits its source. One pattern per row, on the raw text only."""
    return _valid(src, clean_text(job_url))


def _valid(src: Column, text: Column) -> Column:
    return F.coalesce(_choose(src, lambda s: text.rlike(s.valid), "valid"), F.lit(False))


def canonical_url(source: Column, url: Column) -> tuple[Column, Column]:
    """Canonical link and posting id for any source; both null if the link is not its own."""
    p = split_url(url)
    ok = valid_link(source, url)
    link_id = _choose(source, lambda s: _link_id(s, p), "path_id", "query_id")
    link = _choose(source, lambda s: canonical_link(s, p, link_id), "canonical", "fixed_url", "query_id")
    return F.when(ok, link), F.when(ok, link_id)


def complete_raw(df: DataFrame) -> DataFrame:
    """Add raw columns a landing table lacks, as nulls."""
    missing = {c: F.lit(None).cast("string") for c in RAW_TEXT if c not in df.columns}
    for name, kind in (("is_remote", "boolean"), ("min_amount", "double"), ("max_amount", "double")):
        if name not in df.columns:
            missing[name] = F.lit(None).cast(kind)
    return df.withColumns(missing) if missing else df


def map_records(raw: DataFrame, payload: Column | None = None) -> DataFrame:
    """Every raw row with its record columns, plus `seq` and `reject_reason`.

    Texts are cleaned once and links are split once, in projections of their
    own; the record columns then read the pieces. The reject reason reads raw columns only: a
    filter on it moves down to the scan without dragging the mapping along.
    No shuffle, no Python.
    """
    df = complete_raw(raw).select(
        "seq",
        "is_remote",
        "min_amount",
        "max_amount",
        (raw_payload(raw) if payload is None else payload).alias("raw_json"),
        *[clean_text(F.col(c)).alias(c) for c in RAW_TEXT],
    )
    src = F.col("_src")
    df = df.withColumn("_src", F.lower(F.coalesce("site", "source", F.lit("linkedin"))))
    df = cut_urls(df, {"job_url": "j", "company_url": "c", "apply_url": "a"})
    j, c, a = cut_parts("j"), cut_parts("c"), cut_parts("a")
    ctext, atext = F.col("company_url"), F.col("apply_url")
    df = df.withColumns(
        {
            "_link_id": _choose(src, lambda s: _link_id(s, j), "path_id", "query_id"),
            "_profile": profile_url(ctext, c),
        }
    )
    link_id, profile, direct = F.col("_link_id"), F.col("_profile"), F.col("job_url_direct")
    df = df.withColumn(
        "_link",
        _choose(src, lambda s: canonical_link(s, j, link_id), "canonical", "fixed_url", "query_id"),
    )
    link = F.col("_link")
    text = F.col

    def external_id(s: SourceSpec) -> Column:
        if s.canonical == "hosted":
            return link
        return F.coalesce(text("id"), text("external_id"), link_id, link) if s.id_first else link_id

    def company_link(s: SourceSpec) -> Column:
        if s.company == "hosted":
            return ctext
        if s.company_default:
            return F.coalesce(profile, F.lit(s.company_default))
        return F.coalesce(profile, page_root(link)) if s.company_from_link else profile

    def company_id(s: SourceSpec) -> Column:
        if s.company == "hosted":
            return F.concat(j.root, F.lit("/"), F.array_join(F.slice(path_parts(j), 1, 3), "/"))
        if s.company == "pattern":
            return F.when(c.is_web, found(c.path, s.company_id))
        known = [F.when(c.has_host, F.lower(c.host) if s.company == "host" else profile).otherwise(ctext)]
        if s.company_from_link:
            known.append(F.lower(page_host(link)))
        if s.company_name_as_id:
            known.append(text("company"))
        if s.company_fallback:
            known.append(F.lit(s.company_fallback))
        return F.coalesce(*known)

    def apply_link(s: SourceSpec) -> Column:
        forms = {
            "outside": (direct, atext),
            "direct_or_apply": (direct, atext, link),
            "apply": (atext, link),
            "page": (page_url(a), link),
            "page_query": (page_url_with_query(a), link),
            "own_page": (F.when(atext.rlike(s.valid), page_url(a)), link),
        }
        return F.coalesce(*forms[s.apply])

    def apply_kind(s: SourceSpec) -> Column:
        if s.apply == "outside":
            own = F.when(atext.isNotNull(), F.lit(s.source))
            return F.when(direct.isNotNull(), F.lit("external")).otherwise(own)
        if s.apply == "direct_or_apply":
            return F.when(direct.isNotNull(), F.lit("external")).otherwise(src)
        if s.canonical == "hosted":
            other = direct.isNotNull() & (direct != F.coalesce(atext, link))
            return F.when(other, F.lit("external")).otherwise(src)
        return F.lit("external")

    def place_of_work(s: SourceSpec) -> Column:
        if s.listing_as_is:
            return text("listing_type")
        if s.remote_only:
            return F.when(F.col("is_remote"), F.lit("remote"))
        return work_type(F.col("is_remote"), F.col("listing_type"), s.dash)

    def count_of(s: SourceSpec) -> Column:
        seen = F.col("applications_count")
        return text("applications_count") if s.canonical == "hosted" else safe_int(seen).cast("string")

    title = text("title")
    reason = (
        F.when(~src.isin(*[s.name for s in SPECS]), F.lit("unsupported_source"))
        .when(title.isNull(), F.lit("missing_title"))
        .when(~_valid(src, F.col("job_url")), F.lit("invalid_url"))
    )
    none = F.lit(None).cast("string")
    name = F.coalesce(text("company"), text("company_name"))
    company = ("company", "company_default", "company_from_link")
    columns = {
        "title": title,
        "location": text("location"),
        "posted_time": text("date_posted"),
        "published_at": parse_clean_date(F.col("date_posted")),
        "job_url": link,
        "company_name": _choose(src, lambda s: name if s.name_fallback else text("company"), "name_fallback"),
        "company_url": _choose(src, company_link, *company),
        "company_id": _choose(src, company_id, *company, "company_id", "company_name_as_id", "company_fallback"),
        "description": text("description"),
        "applications_count": _choose(src, count_of, "canonical"),
        "contract_type": text("job_type"),
        "experience_level": text("job_level"),
        "work_type": _choose(src, place_of_work, "listing_as_is", "remote_only", "dash"),
        "sector": _choose(src, lambda s: F.coalesce(*[text(x) for x in s.sector_columns]), "sector_columns"),
        "salary": salary_text(F.col("min_amount"), F.col("max_amount"), F.col("pay_interval"), F.col("currency")),
        "poster_full_name": none,
        "poster_profile_url": none,
        "apply_url": _choose(src, apply_link, "apply"),
        "apply_type": _choose(src, apply_kind, "apply", "canonical"),
        "benefits": none,
        "source": F.coalesce(direct_page_source(F.col), _choose(src, lambda s: F.lit(s.source), "source")),
        "external_id": _choose(src, external_id, "canonical", "id_first"),
        "raw_json": F.col("raw_json"),
    }
    return df.select(
        F.col("seq"),
        src.alias("route"),
        reason.alias("reject_reason"),
        *[value.alias(name) for name, value in columns.items()],
    )


def page_root(link: Column) -> Column:
    return F.regexp_extract(link, r"^(https?://[^/?#]+)", 1)


def page_host(link: Column) -> Column:
    return F.regexp_extract(link, r"^https?://([^/?#]+)", 1)


def valid_records(mapped: DataFrame) -> DataFrame:
    """Rows that make a record."""
    return mapped.where(F.col("reject_reason").isNull()).select("seq", *RECORD_COLUMNS)


def rejects(mapped: DataFrame) -> DataFrame:
    """Rows that make none, with the reason."""
    return mapped.where(F.col("reject_reason").isNotNull()).select("seq", "route", "reject_reason")


def count_rejects(mapped: DataFrame) -> DataFrame:
    """Invalid rows by reason, and rows that repeat an accepted link.

    One pass over the mapped rows: they are counted per reason and, where there
    is none, per link.
    """
    ok = F.col("reject_reason").isNull()
    per_link = mapped.groupBy("reject_reason", F.when(ok, F.col("job_url")).alias("link")).agg(F.count("*").alias("n"))
    repeats = F.col("n") - F.when(ok, 1).otherwise(0)
    found = per_link.select(F.coalesce("reject_reason", F.lit("duplicate_input")).alias("reason"), repeats.alias("n"))
    always = mapped.sparkSession.range(1).select(F.lit("duplicate_input").alias("reason"), F.lit(0).cast("bigint").alias("n"))
    return found.unionByName(always).groupBy("reason").agg(F.sum("n").alias("n"))


def build_records(raw: DataFrame, builder: Callable[[DataFrame], DataFrame] = map_records) -> DataFrame:
    """Records by the given builder: any function from raw rows to mapped rows."""
    return valid_records(raw.transform(builder))


def stamp(df: DataFrame, **constants: object) -> DataFrame:
    """Constant provenance columns on every row of one run or shard."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def stamp_from_catalog(df: DataFrame, catalog: DataFrame, key: str = "page_key", spread: str = "seq") -> DataFrame:
    """Provenance of many career pages at once, by the page key of each row; hot pages are split."""
    pages = catalog.select(
        F.col("company_key").alias(key),
        F.col("id").cast("string").alias("direct_company_career_page_id"),
        F.col("company_key").alias("direct_company_career_page_key"),
        F.col("company_name").alias("direct_company_career_page_company"),
        F.coalesce(clean_text(F.col("company_name")), clean_text(F.col("company_key"))).alias("source"),
    )
    return attach(df.drop("source"), pages, [key], F.col(spread))
