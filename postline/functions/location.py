"""Location and country rules. A location is struct(city, state, country)."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.lookups import (
    COUNTRIES,
    country_codes,
    country_display,
    country_names,
    look_up,
    review_domains,
)
from postline.functions.text import BLANK_CLASS, clean_text, strip


def country_key(c: Column) -> Column:
    return look_up(country_names(), F.lower(clean_text(c)))


def country_name(c: Column) -> Column:
    """Shown name of a known country; the two pseudo countries are hidden; other text stays."""
    key = country_key(c)
    return F.when(key.isNull(), clean_text(c)).otherwise(look_up(country_display(), key))


def country_code(key: Column) -> Column:
    return look_up(country_codes(), key)


def review_host(key: Column) -> Column:
    return look_up(review_domains(), key)


def require_country(c: Column) -> Column:
    """Country key, or an error naming the unknown text."""
    key = country_key(c)
    text = F.concat(F.lit("unknown country: "), F.coalesce(c, F.lit("null")))
    return F.when(key.isNotNull(), key).otherwise(F.raise_error(text).cast("string"))


def place(city: Column | None, state: Column | None, country: Column | None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        (none if city is None else city).alias("city"),
        (none if state is None else state).alias("state"),
        (none if country is None else country).alias("country"),
    )


def display_location(loc: Column) -> Column:
    """`City, State, Country`."""
    shown = [F.nullif(loc["city"], F.lit("")), F.nullif(loc["state"], F.lit("")), country_name(loc["country"])]
    return F.concat_ws(", ", *shown)


def _pieces(line: Column, keep_blank: bool = False) -> Column:
    """Pieces between commas, trimmed; blank ones go unless kept. Built without
    per-item functions, so the whole rule stays in generated code."""
    comma = rf"{BLANK_CLASS}*,{BLANK_CLASS}*"
    if keep_blank:
        return F.split(F.regexp_replace(line, comma, ","), ",")
    return F.split(F.btrim(F.regexp_replace(line, rf"(?:{comma})+", ","), F.lit(",")), ",")


def _at(parts: Column, i: int) -> Column:
    return F.try_element_at(parts, F.lit(i))


def _front(parts: Column, drop: int) -> Column:
    """All but the last `drop` pieces, joined."""
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - drop, F.lit(0))), ", ")


@dataclass(frozen=True)
class Line:
    """A cleaned text with its pieces: expressions over the text, or columns made from it before."""

    text: Column
    pieces: Column
    kept: Column


def _line(text: Column) -> Line:
    return Line(text, _pieces(text), _pieces(text, keep_blank=True))


def _cleaned(text: Column, style: str) -> Column:
    if style not in _STYLES:
        raise ValueError(f"unknown location style: {style}")
    if style == "offices":
        return distinct_offices(text)
    return tidy_office(text) if style == "workday" else clean_text(text)


def parse_location(text: Column, style: str, country: Column | None = None) -> Column:
    """Location of a text in the writing style of its source.

    One expression, in which every branch cuts the text again; `with_locations`
    gives the same from columns that are made once per row.
    """
    home = F.lit(None).cast("string") if country is None else country
    if style == "offices":
        return join_offices(text, home)
    return _STYLES[style](_line(_cleaned(text, style)), home)


def with_locations(df: DataFrame, wanted: Mapping[str, tuple[str, str]], country: Column | None = None) -> DataFrame:
    """df with a location per name, each of (text column, style); `offices` reads a list of texts.

    Cleaned texts are columns of a first projection and pieces of a second one,
    shared by all styles that read them. The optimiser keeps the projections
    apart, as what they make is read several times.
    """
    home = F.lit(None).cast("string") if country is None else country
    kind = {style: style if style in ("offices", "workday") else "plain" for _, style in wanted.values()}
    texts = {(text, kind[style]): style for text, style in wanted.values()}
    number = {key: i for i, key in enumerate(texts)}
    lines = df.withColumns({f"_text{i}": _cleaned(F.col(text), texts[text, k]) for (text, k), i in number.items()})
    first = {i: _at(F.col(f"_text{i}"), 1) if k == "offices" else F.col(f"_text{i}") for (_, k), i in number.items()}
    pieces = {f"_pieces{i}": _pieces(c) for i, c in first.items()}
    kept = {f"_kept{number[text, kind[style]]}" for text, style in wanted.values() if style in _KEEP_BLANK}
    pieces |= {name: _pieces(F.col(name.replace("_kept", "_text")), keep_blank=True) for name in sorted(kept)}
    none = F.lit(None).cast("array<string>")
    made = {}
    for name, (text, style) in wanted.items():
        i = number[text, kind[style]]
        made[name] = _STYLES[style](Line(F.col(f"_text{i}"), F.col(f"_pieces{i}"), F.col(f"_kept{i}") if f"_kept{i}" in kept else none), home)
    return lines.withColumns(pieces).select(*[F.col(f"`{c}`") for c in df.columns if c not in made], *[c.alias(n) for n, c in made.items()])


def _linkedin(line: Line, home: Column) -> Column:
    p = line.pieces
    return (
        F.when(F.size(p) == 2, place(_at(p, 1), _at(p, 2), home))
        .when(F.size(p) >= 3, place(_at(p, 1), _at(p, 2), _at(p, -1)))
        .otherwise(place(None, None, home))
    )


def _glassdoor(line: Line, home: Column) -> Column:
    city = F.substring_index(line.text, ", ", 1)
    state = F.substring(line.text, F.length(city) + 3, F.length(line.text))
    return F.when(line.text != "Remote", place(city, state, None))


def _greenhouse(line: Line, home: Column) -> Column:
    p = line.kept
    return F.when(F.size(p) == 2, place(_at(p, 1), _at(p, 2), None)).when(
        line.text.isNotNull(), place(None, None, line.text)
    )


def _eightfold(line: Line, home: Column) -> Column:
    text, p = line.text, line.pieces
    after = F.substring(text, F.locate("-", text) + 1, F.length(text))
    dashed = place(clean_text(F.substring_index(after, "(", 1)), None, clean_text(F.substring_index(text, "-", 1)))
    return (
        F.when(F.size(p) >= 3, place(_front(p, 2), _at(p, -2), _at(p, -1)))
        .when(F.size(p) == 2, place(_at(p, 1), None, _at(p, 2)))
        .when(F.contains(text, F.lit("-")), dashed)
        .when(text.isNotNull(), place(None, None, text))
    )


def _naukri(line: Line, home: Column) -> Column:
    parts = F.split(line.text, ", ")
    return place(_at(parts, 1), _at(parts, 2), F.lit("india"))


def _bdjobs(line: Line, home: Column) -> Column:
    p = line.kept
    return F.when(F.size(p) >= 2, place(_at(p, 1), _at(p, 2), F.lit("bangladesh"))).otherwise(
        place(line.text, None, F.lit("bangladesh"))
    )


def _meta(line: Line, home: Column) -> Column:
    p = line.pieces
    return F.when(F.size(p) >= 2, place(_front(p, 1), None, _at(p, -1))).when(
        line.text.isNotNull(), place(None, None, line.text)
    )


def _office(line: Line, country: Column) -> Column:
    """Place of one tidy office text; the country alone when there is none."""
    tidy, p = line.text, line.pieces
    return (
        F.when(
            F.size(p) >= 2,
            place(_at(p, 1), F.array_join(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(1))), ", "), country),
        )
        .when(tidy.isNotNull(), place(tidy, None, country))
        .when(country.isNotNull(), place(None, None, country))
    )


def _offices(line: Line, country: Column) -> Column:
    """Place of a list of tidy offices: one is split, more are joined by a slash. The pieces are those of the first."""
    one = Line(_at(line.text, 1), line.pieces, line.kept)
    return F.when(F.size(line.text) > 1, place(F.array_join(line.text, " / "), None, country)).otherwise(
        _office(one, country)
    )


_STYLES: dict[str, Callable[[Line, Column], Column]] = {
    "linkedin": _linkedin,
    "glassdoor": _glassdoor,
    "greenhouse": _greenhouse,
    "eightfold": _eightfold,
    "workday": _office,
    "offices": _offices,
    "naukri": _naukri,
    "bdjobs": _bdjobs,
    "meta": _meta,
}
#: Styles in which an empty piece counts.
_KEEP_BLANK = ("greenhouse", "bdjobs")


def _without_region(text: Column) -> Column:
    return F.regexp_replace(text, r"^(?:[A-Z]{2}(?:-[A-Z]{2,})?\s*-\s*)(.+)$", "$1")


def _without_unit(text: Column) -> Column:
    return F.regexp_replace(text, r"\s*-\s*[A-Z]{2,4}$", "")


def tidy_office(c: Column) -> Column:
    """Office text without region prefix (`US-CA - `) and unit suffix (` - SF`)."""
    return clean_text(_without_unit(strip(_without_region(clean_text(c)))))


def distinct_offices(offices: Column) -> Column:
    """The different tidy texts of a list, in order. One function over the list per step:
    within a function every step would run again for each time its result is read.
    """
    bare = F.transform(F.transform(offices, clean_text), lambda x: strip(_without_region(x)))
    return F.array_distinct(F.filter(F.transform(bare, lambda x: clean_text(_without_unit(x))), lambda x: x.isNotNull()))


def join_offices(offices: Column, country: Column) -> Column:
    """Several offices of one posting as one expression, see `with_locations` for style `offices`."""
    clean = distinct_offices(offices)
    first = _line(_at(clean, 1))
    return _offices(Line(clean, first.pieces, first.kept), country)


def chosen_place(places: Column) -> Column:
    """The active one of a list of struct(active, city, name, state, country), else the first."""
    return F.coalesce(_at(F.filter(places, lambda p: p["active"]), 1), _at(places, 1))


def active_place(places: Column) -> Column:
    """Location of the chosen place as one expression."""
    return stated_place(chosen_place(places))


def stated_place(chosen: Column) -> Column:
    """Location of struct(city, name, state, country)."""
    city = F.coalesce(clean_text(chosen["city"]), clean_text(chosen["name"]))
    return F.when(chosen.isNotNull(), place(city, clean_text(chosen["state"]), clean_text(chosen["country"])))


def nested_place(nested: Column, parent: Column, default_country: str) -> Column:
    """Nested location first, then the parent's fields."""
    return place(
        F.coalesce(clean_text(nested["city"]), clean_text(parent["city"])),
        clean_text(nested["state"]),
        F.coalesce(clean_text(nested["country"]), clean_text(parent["country"]), F.lit(default_country)),
    )


def hosted_country(c: Column) -> Column:
    """Country of a hosted careers position: three codes spelled out, the rest kept."""
    text = clean_text(c)
    return F.coalesce(look_up({"IL": "Israel", "US": "USA", "UK": "UK"}, F.upper(text)), text)


def country_aliases(country: str) -> list[str]:
    """Names and code a requested country may be written as; none means no filter."""
    key = next((k for k, (names, _, _) in COUNTRIES.items() if country.strip().lower() in names.split(",")), None)
    if key == "WORLDWIDE":
        return []
    if key is None:
        return [country.strip().lower()] if country.strip() else []
    names = [n.strip().lower() for n in COUNTRIES[key][0].split(",")]
    return list(dict.fromkeys([*names, country_codes()[key].lower()]))


def mentions_country(country: str, *texts: Column) -> Column:
    """A name of the country stands as a whole word in one of the texts."""
    aliases = country_aliases(country)
    if not aliases:
        return F.lit(True)
    words = "|".join(re.escape(a) for a in aliases)
    pattern = rf"(?<![a-z])(?:{words})(?![a-z])"
    tests = [F.coalesce(F.lower(clean_text(t)).rlike(pattern), F.lit(False)) for t in texts]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out
