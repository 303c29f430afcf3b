"""Extraction from landed pages: embedded JSON, JSON-LD, links, rows by selector."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType

from postline.functions.markup import Node, first_match, parse, select
from postline.functions.text import clean_text, html_unescape, strip
from postline.functions.url import found, join_url, linkedin_page

# Where pages keep their data. {} is the name asked for.
EMBEDDED = {
    "script_id": r"(?is)<script\b[^>]*\bid=[\"']{}[\"'][^>]*>(.*?)</script>",
    "variable": r"(?s){}\s*=\s*(.*?);\s*(?:\n|\r)",
    "next": r'(?s)<script id="__NEXT_DATA__" type="application/json">(.*?)</script>',
    "remix": r"(?s)window\.__remixContext\s*=\s*(\{{.*?\}});\s*</script>",
    "data_page": r'(?s)data-page="(.*?)"',
    "hydration": r"(?s)<script[^>]*>window\.__staticRouterHydrationData = JSON\.parse\((.*?)\);?\s*</script>",
}
LD_SCRIPT = r"(?is)<script\b[^>]*\btype=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"


def embedded_json(html: Column, rule: str, name: str = "") -> Column:
    """VARIANT found by one of the EMBEDDED rules; null if absent or broken."""
    raw = clean_text(found(html, EMBEDDED[rule].format(re.escape(name))))
    if rule == "data_page":
        raw = html_unescape(raw)
    doc = F.try_parse_json(raw)
    if rule == "hydration":
        return F.try_parse_json(F.try_variant_get(doc, "$", "string"))
    return doc


def code_payloads(html: Column) -> Column:
    """JSON objects held in <code> elements."""
    texts = F.regexp_extract_all(html, F.lit(r"(?is)<code\b[^>]*>(.*?)</code>"), F.lit(1))
    docs = F.transform(texts, lambda t: F.try_parse_json(strip(t)))
    return F.filter(docs, lambda d: F.startswith(F.schema_of_variant(d), F.lit("OBJECT")))


def json_ld_posting(html: Column) -> Column:
    """First JSON-LD object of type JobPosting, alone or inside a list; broken scripts are skipped."""
    scripts = F.regexp_extract_all(html, F.lit(LD_SCRIPT), F.lit(1))
    docs = F.transform(scripts, lambda t: F.try_parse_json(strip(t)))
    flat = F.flatten(
        F.transform(docs, lambda d: F.coalesce(F.try_variant_get(d, "$", "array<variant>"), F.array(d)))
    )
    return F.try_element_at(
        F.filter(flat, lambda d: F.try_variant_get(d, '$["@type"]', "string") == "JobPosting"), F.lit(1)
    )


# Output column -> place in a JobPosting object.
POSTING_PATHS = {
    "title": "$.title",
    "datePosted": "$.datePosted",
    "validThrough": "$.validThrough",
    "employmentType": "$.employmentType",
    "industry": "$.industry",
    "identifier_name": "$.identifier.name",
    "identifier_value": "$.identifier.value",
    "hiring_org_name": "$.hiringOrganization.name",
    "hiring_org_sameAs": "$.hiringOrganization.sameAs",
    "hiring_org_logo": "$.hiringOrganization.logo",
    "job_location_country": "$.jobLocation.address.addressCountry",
    "job_location_locality": "$.jobLocation.address.addressLocality",
    "job_location_region": "$.jobLocation.address.addressRegion",
    "experience_months": "$.experienceRequirements.monthsOfExperience",
    "education_category": "$.educationRequirements.credentialCategory",
}


def posting_summary(posting: Column) -> dict[str, Column]:
    """One column per path, and the length of the unescaped description."""
    out = {name: F.try_variant_get(posting, path, "string") for name, path in POSTING_PATHS.items()}
    body = F.coalesce(F.try_variant_get(posting, "$.description", "string"), F.lit(""))
    out["description_length"] = F.when(posting.isNotNull(), F.length(html_unescape(body)))
    return out


def links(html: Column, base: Column, prefix: str = "") -> Column:
    """Absolute addresses of anchors whose href starts with a prefix, first seen first."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*>"), F.lit(0))
    hrefs = F.filter(F.transform(tags, lambda t: _attr(t, "href")), lambda h: h.isNotNull())
    mine = F.filter(F.transform(hrefs, strip), lambda h: (h != "") & F.startswith(h, F.lit(prefix)) & (h != prefix))
    return F.array_distinct(F.transform(mine, lambda h: join_url(base, h)))


def script_links(html: Column, base: Column) -> Column:
    """Absolute addresses of all script tags, then of the chunk files named anywhere; each once."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<script\s[^>]*>"), F.lit(0))
    sources = F.filter(F.transform(tags, lambda t: strip(_attr(t, "src"))), lambda h: h != "")
    chunks = F.regexp_extract_all(html, F.lit(CHUNK), F.lit(0))
    return F.array_distinct(F.transform(F.concat(sources, chunks), lambda h: join_url(base, h)))


# Fixed value: the folder in which one framework keeps its script files.
CHUNK_FOLDER = "/_next/static/chunks/"
CHUNK = CHUNK_FOLDER + r"[\w./%@~-]*?\.js"


def _attr(tag: Column, name: str) -> Column:
    """Value of an attribute, quoted or bare; null without it or when it is empty."""
    start = rf"(?is)\s{name}\s*=\s*"
    quoted = F.coalesce(found(tag, start + '"([^"]*)"'), found(tag, start + "'([^']*)'"))
    return F.coalesce(quoted, found(tag, start + r"""([^\s"'>]+)"""))


def _last_of_key(entries: Column) -> Column:
    """Map of struct(k, v) entries; later ones replace earlier ones."""
    complete = F.filter(entries, lambda e: e["k"].isNotNull() & e["v"].isNotNull())
    keys = F.transform(complete, lambda e: e["k"])
    kept = F.filter(
        complete, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys) - i - 1, F.lit(0))), e["k"])
    )
    return F.map_from_entries(kept)


def meta_values(html: Column) -> Column:
    """Map of meta property, name or id to content."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*>"), F.lit(0))
    return _last_of_key(
        F.transform(
            tags,
            lambda t: F.struct(
                F.coalesce(_attr(t, "property"), _attr(t, "name"), _attr(t, "id")).alias("k"),
                _attr(t, "content").alias("v"),
            ),
        )
    )


def hidden_codes(html: Column) -> Column:
    """Map of code id to text."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<code\b[^>]*\bid=[^>]*>.*?</code>"), F.lit(0))
    return _last_of_key(
        F.transform(
            tags,
            lambda t: F.struct(_attr(t, "id").alias("k"), clean_text(found(t, r"(?s)^<[^>]*>(.*)</code>$")).alias("v")),
        )
    )


def detail_links(html: Column, page: Column) -> Column:
    """Map of posting id to detail address, resolved against the page's base."""
    base = F.coalesce(found(html, r"(?i)<base\b[^>]*\bhref=[\"']([^\"']*)"), page)
    pattern = r'href="([^"]*jobs/results/(\d+)-[^"]*)"'
    hrefs = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return _last_of_key(
        F.transform(
            hrefs,
            lambda h: F.struct(
                found(h, r"jobs/results/(\d+)-").alias("k"),
                join_url(base, F.replace(h, F.lit("&amp;"), F.lit("&"))).alias("v"),
            ),
        )
    )


def canonical_page(html: Column, response_url: Column) -> Column:
    """First of canonical link, site url meta, og:url and the response's own address that names a posting."""
    def tag_with(kind: str, mark: str) -> Column:
        return found(html, rf"(?i)<{kind}\b[^>]*{mark}[^>]*>", 0)

    candidates = [
        _attr(tag_with("link", r"\brel=[\"']canonical[\"']"), "href"),
        _attr(tag_with("meta", r"\bproperty=[\"']lnkd:url[\"']"), "content"),
        _attr(tag_with("meta", r"\bproperty=[\"']og:url[\"']"), "content"),
        response_url,
    ]
    return F.coalesce(*[linkedin_page(c)[0] for c in candidates])


Reader = Callable[[str, Node, str], str | None]


def field_reader(config: dict | str) -> Reader:
    """A function of page, row element and base address that reads one configured field.

    `selector` picks an element below the row (the row itself if blank or `.`),
    `attr` its text, inner html or an attribute; `urljoin` makes it absolute.
    """
    options = {"selector": config} if isinstance(config, str) else config
    selector, attr = ((options.get(k) or "").strip() for k in ("selector", "attr"))
    values: dict[str, Callable[[str, Node], str | None]] = {
        "": lambda page, at: at.text(),
        "text": lambda page, at: at.text(),
        "html": lambda page, at: page[at.start : at.stop],
    }
    value = values.get(attr, lambda page, at: at.attrs.get(attr))

    def read(page: str, row: Node, base: str) -> str | None:
        at = row if selector in ("", ".") else first_match(row, selector)
        content = (value(page, at) or "").strip() if at is not None else ""
        return (urljoin(base, content) if options.get("urljoin") else content) if content else None

    return read


def html_rows(html: Column, base: Column, row_selector: str, fields: dict[str, dict | str]) -> Column:
    """array<map<string,string>>: one map per matched element; empty ones are dropped."""

    @F.pandas_udf(ArrayType(MapType(StringType(), StringType())))
    def extract(pages: pd.Series, bases: pd.Series) -> pd.Series:
        readers = {name: field_reader(config) for name, config in fields.items()}

        def rows(page: str, base_url: str) -> list[dict[str, str]]:
            found_rows = ({n: read(page, node, base_url) for n, read in readers.items()} for node in select(parse(page), row_selector))
            return [kept for row in found_rows if (kept := {n: v for n, v in row.items() if v})]

        return pd.Series([rows(page or "", base_url or "") for page, base_url in zip(pages, bases, strict=True)])

    return extract(html, base)


def html_description(html: Column, selectors: list[dict | str], attr: str = "html") -> Column:
    """Content of the first selector that yields any. A selector may state its own `attr`."""

    @F.pandas_udf(StringType())
    def extract(pages: pd.Series) -> pd.Series:
        readers = [field_reader({"attr": attr} | ({"selector": s} if isinstance(s, str) else s)) for s in selectors]

        def first(page: str) -> str | None:
            tree = parse(page)
            return next((v for read in readers if (v := read(page, tree, ""))), None)

        return pages.map(first, na_action="ignore")

    return extract(html)


def labelled_values(html: Column, labels: dict[str, str], classed: dict[str, str] | None = None) -> Column:
    """map<string,string>: the value after each heading label, and the text of each classed element."""
    extra = classed or {}

    @F.pandas_udf(MapType(StringType(), StringType()))
    def extract(pages: pd.Series) -> pd.Series:
        def one(page: str | None) -> dict[str, str]:
            tree = parse(page or "")
            out: dict[str, str] = {}
            for name, selector in extra.items():
                node = first_match(tree, selector)
                if node is not None and node.text(""):
                    out[name] = node.text("")
            for head in select(tree, "h1, h2, h3, h4, dt"):
                title = head.text()
                for name, label in labels.items():
                    if name in out or label not in title:
                        continue
                    after = head.up.items[head.up.items.index(head) + 1 :]
                    node = next((x for x in after if hasattr(x, "tag") and x.tag not in ("br",)), None)
                    if node is not None and node.text(""):
                        out[name] = node.text("")
            return out

        return pages.map(one)

    return extract(html)


def explode_rows(df: DataFrame, rows: Column, keep: list[str]) -> DataFrame:
    """One row per extracted element, with its place on the page."""
    return df.select(*keep, F.posexplode(rows).alias("pos", "row"))

