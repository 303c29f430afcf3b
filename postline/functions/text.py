"""Text rules. Everything but the HTML converters is a built-in expression."""

from __future__ import annotations

import html as html_lib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from postline.functions.markup import to_markdown, to_plain

# The characters a full strip removes, and a matching class that
# Java and RE2 read alike.
BLANKS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
BLANK_CLASS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def clean_text(c: Column) -> Column:
    """Text without outer whitespace of any kind; blank becomes null."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def non_blank(c: Column) -> Column:
    """The value itself unless it is only spaces; used when stored rows merge."""
    return F.when(F.trim(c) != "", F.trim(c))


def first_non_blank(*columns: Column) -> Column:
    return F.coalesce(*[clean_text(c) for c in columns])


def meaningful(c: Column, kind: str = "string") -> Column:
    """True unless null, blank text or an empty collection. 0 and false count."""
    if kind == "string":
        return c.isNotNull() & (strip(c) != "")
    if kind.startswith(("array", "map")):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def squash(c: Column) -> Column:
    return F.regexp_replace(c, BLANK_CLASS + "+", " ")


def match_key(c: Column) -> Column:
    """Key for comparing company names: one space between words, lower case."""
    return F.lower(squash(clean_text(c)))


def ordered_distinct(items: Column) -> Column:
    """Clean each item, drop blanks, keep the first of equals."""
    return F.array_distinct(F.filter(F.transform(items, clean_text), lambda x: x.isNotNull()))


def to_text_list(c: Column) -> Column:
    return ordered_distinct(F.split(F.coalesce(c, F.lit("")), ","))


def split_skills(c: Column) -> Column:
    items = ordered_distinct(F.split(clean_text(c), r"[,;]\s*"))
    return F.when(F.size(items) > 0, items)


def extract_emails(c: Column, explicit: Column | None = None) -> Column:
    """All addresses in the text; a stated address comes first, then distinct."""
    found = F.regexp_extract_all(c, F.lit(EMAIL), F.lit(0))
    if explicit is None:
        return found
    stated = clean_text(explicit)
    head = F.when(stated.isNotNull(), F.array(stated)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(head, F.coalesce(found, F.array().cast("array<string>"))))


def title_case(c: Column) -> Column:
    """Capital after every non-letter, not only after spaces."""
    runs = F.regexp_extract_all(c, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def industry_label(c: Column) -> Column:
    words = F.replace(F.replace(c, F.lit("Iv1"), F.lit("")), F.lit("_"), F.lit(" "))
    return F.when(c != "", strip(title_case(words)))


def slug(c: Column, fallback: str = "company") -> Column:
    made = F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.when(made == "", F.lit(fallback)).otherwise(made)


def snake_name(c: Column) -> Column:
    """Column name from a header; null where nothing is left."""
    made = F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.nullif(made, F.lit(""))


def work_type(is_remote: Column, listing_type: Column, dash: str = "_ ") -> Column:
    """remote wins; else the listing type in lower case with dashes."""
    listed = F.translate(F.lower(clean_text(listing_type)), dash, "-" * len(dash))
    return F.when(is_remote, F.lit("remote")).otherwise(listed)


def template(pattern: str, values: dict[str, Column]) -> Column:
    """`{path}` parts replaced by the value; a missing value leaves nothing."""
    parts: list[Column] = []
    for i, piece in enumerate(re.split(r"{([^{}]+)}", pattern)):
        if i % 2 == 0:
            parts.append(F.lit(piece))
        else:
            parts.append(F.coalesce(values[piece.strip()].cast("string"), F.lit("")))
    return F.concat(*parts)


# Whom a page says clicked apply.
CLICKERS = ("people", "person", "member", "members")
GROUPED = r"[0-9][0-9,]*"


def applicant_count(c: Column) -> Column:
    """`1,234 applicants` as a whole text, or `57 people clicked apply` inside one."""
    one_line = F.lower(strip(squash(c)))
    whole = F.regexp_extract(one_line, rf"^({GROUPED}) applicants?$", 1)
    inside = F.regexp_extract(one_line, rf"\b({GROUPED}) (?:{'|'.join(CLICKERS)}) clicked apply\b", 1)
    digits = F.coalesce(F.nullif(whole, F.lit("")), F.nullif(inside, F.lit("")))
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("bigint")


def company_name_from_url(host: Column) -> Column:
    """First host label that is not www, spaced and title-cased."""
    labels = F.filter(F.split(F.split(host, ":")[0], r"\."), lambda p: (p != "") & (p != "www"))
    return title_case(F.translate(F.try_element_at(labels, F.lit(1)), "-_", "  "))


def domain_without_prefix(host: Column) -> Column:
    """Host without a leading apply., career., careers. or jobs. label."""
    low = F.nullif(F.lower(strip(F.split(host, ":")[0])), F.lit(""))
    trimmed = F.regexp_extract(low, r"^(?:apply|careers?|jobs)\.([^.]+\..+)$", 1)
    return F.when(trimmed != "", trimmed).otherwise(low)


def domain_label(domain: Column) -> Column:
    word = F.btrim(F.replace(F.split(domain, r"\.")[0], F.lit("-"), F.lit(" ")))
    return F.nullif(title_case(word), F.lit(""))


def strip_attributes(html: Column, tag: str) -> Column:
    """Drop all attributes of the first opening tag of that kind."""
    pattern = rf"(?s)^(.*?<{tag})\s[^>]*>"
    return F.regexp_replace(html, pattern, "$1>")


def sections(parts: list[tuple[str | None, Column]], style: str = "markdown", level: int = 3) -> Column:
    """Titled sections under each other; blank ones are left out.

    Level 3 is the form of feeds (`### t`, blank line), level 2 of careers
    sites (`## t`, next line).
    """
    gap = "\n\n" if level == 3 else "\n"
    before, after = {
        "markdown": ("#" * level + " ", gap),
        "html": (f"<h{level}>", f"</h{level}>"),
        "plain": ("", "\n"),
    }[style]
    joiner = "\n\n" if style != "html" else "\n" if level == 3 else ""
    made = []
    for title, content in parts:
        body = clean_text(content)
        head = "" if title is None else f"{before}{title}{after}"
        made.append(F.when(body.isNotNull(), strip(F.concat(F.lit(head), body))))
    kept = F.filter(F.array(*made), lambda x: x.isNotNull())
    return F.nullif(F.array_join(kept, joiner), F.lit(""))


def bullet_lines(c: Column, style: str = "markdown") -> Column:
    """Several lines become a list; one line stays as it is."""
    lines = F.filter(F.transform(F.split(c, r"\r\n|\n|\r"), strip), lambda x: x != "")
    many = F.size(lines) > 1
    if style == "plain":
        return F.array_join(lines, "\n")
    if style == "html":
        items = F.concat(F.lit("<ul><li>"), F.array_join(lines, "</li><li>"), F.lit("</li></ul>"))
        return F.when(many, items).otherwise(F.concat(F.lit("<p>"), F.array_join(lines, ""), F.lit("</p>")))
    marked = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("- "), x)), "\n")
    return F.when(many, marked).otherwise(F.array_join(lines, ""))


@F.pandas_udf(StringType())
def html_unescape(values: pd.Series) -> pd.Series:
    return values.map(html_lib.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def html_to_plain(values: pd.Series) -> pd.Series:
    return values.map(to_plain, na_action="ignore")


@F.pandas_udf(StringType())
def html_to_markdown(values: pd.Series) -> pd.Series:
    return values.map(to_markdown, na_action="ignore")


@F.pandas_udf(StringType())
def _escape(values: pd.Series) -> pd.Series:
    return values.map(html_lib.escape, na_action="ignore")


def format_description(c: Column, style: str = "markdown") -> Column:
    """Unescape, then give html, plain text or markdown. Text without tags stays.

    Python sees only the texts that need it: those with an entity and those with tags.
    """
    cleaned = clean_text(c)
    text = F.coalesce(html_unescape(F.when(F.contains(cleaned, F.lit("&")), cleaned)), cleaned)
    has_tags = text.rlike(r"<[a-zA-Z][^>]*>")
    if style == "html":
        return F.coalesce(_escape(F.when(~has_tags, text)), text)
    convert = html_to_plain if style == "plain" else html_to_markdown
    return F.coalesce(convert(F.when(has_tags, text)), text)


# Characters that the Windows code page puts on the bytes 0x80 to 0x9F, with the control characters of the same bytes.
WINDOWS = {bytes([b]).decode("cp1252"): chr(b) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
# A UTF-8 lead byte and a byte that follows one, both read as single characters.
MISREAD = "[\u00c2-\u00f4][\u0080-\u00bf" + "".join(WINDOWS) + "]"


def repair_mojibake(c: Column) -> Column:
    """Text whose UTF-8 bytes were read as single characters, read again; other text stays.

    Every character must be one byte and the bytes valid UTF-8, else nothing is changed.
    """
    text = clean_text(c)
    narrow = F.translate(text, "".join(WINDOWS), "".join(WINDOWS.values()))
    suspect = text.rlike(MISREAD) & narrow.rlike("^[\u0000-\u00ff]*$")
    again = F.encode(F.when(suspect, narrow), "ISO-8859-1").cast("string")
    return F.coalesce(F.try_validate_utf8(again), text)
