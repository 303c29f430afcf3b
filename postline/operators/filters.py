"""Row predicates, given as data and compiled to columns."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.location import mentions_country, place
from postline.functions.lookups import COMPANY_SOURCES, SOURCES
from postline.functions.text import clean_text

Resolve = Callable[[Any], Column]


def all_of(tests: list[Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def values_equal(value: Column, wanted: Any) -> Column:
    """Numbers and booleans compare as such, text without case."""
    if isinstance(wanted, bool):
        return F.coalesce(value.try_cast("boolean") == F.lit(wanted), F.lit(False))
    if isinstance(wanted, (int, float)):
        return F.coalesce(value.try_cast("double") == F.lit(float(wanted)), F.lit(False))
    return F.lower(F.coalesce(clean_text(value), F.lit(""))) == (wanted or "").strip().lower()


def compile_filters(filters: tuple[dict[str, Any], ...], resolve: Resolve) -> Column:
    """AND of {path, exists | equals | contains | in} rules over text values."""
    tests: list[Column] = []
    for rule in filters:
        value = resolve(rule.get("path"))
        if "exists" in rule:
            there = value.isNotNull() & (value != "")
            tests.append(there if rule["exists"] else ~there)
        if "equals" in rule:
            options = rule["equals"] if isinstance(rule["equals"], list) else [rule["equals"]]
            tests.append(any_of([values_equal(value, o) for o in options]))
        if "contains" in rule:
            part = str(rule["contains"] or "").strip().lower()
            tests.append(F.contains(F.lower(F.coalesce(clean_text(value), F.lit(""))), F.lit(part)))
        if isinstance(rule.get("in"), list):
            tests.append(any_of([values_equal(value, o) for o in rule["in"]]))
    return all_of(tests)


def any_of(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def location_filter(location: str | None, values: list[Column]) -> Column:
    """Any of the values contains the text, case ignored. No text or no values: no filter."""
    wanted = (location or "").strip().lower()
    if not wanted or not values:
        return F.lit(True)
    return any_of([F.coalesce(F.contains(F.lower(clean_text(v)), F.lit(wanted)), F.lit(False)) for v in values])


def by_country(df: DataFrame, country: str, columns: list[str]) -> DataFrame:
    return df.where(mentions_country(country, *[F.col(c) for c in columns]))


def explode_matching(df: DataFrame, places: str, parent_country: str, country: str, out: str = "place") -> DataFrame:
    """One row per nested place in the country. Without one, the parent's own country
    gives one row with an empty place; other rows drop out."""
    hits = F.filter(F.col(places), lambda p: clean_text(p["country"]) == country)
    empty = F.array(F.lit(None).cast(df.select(F.get(places, F.lit(0))).schema[0].dataType))
    parent = clean_text(F.col(parent_country)) == country
    chosen = F.when(F.size(hits) > 0, hits).when(parent, empty)
    return df.withColumn(out, F.explode(chosen))


def lookback_days(source: str, hours: int) -> float:
    """How far back a source really looks when asked for some hours."""
    if source == "zip_recruiter":
        return max(hours // 24, 1)
    if source == "naukri":
        return hours * 3600 // 86400
    if source == "google":
        return next((d for limit, d in ((24, 1), (72, 3), (168, 7)) if hours <= limit), 30)
    return hours / 24


def batch_hours(minutes: int) -> int:
    """Whole hours of a batch lookback, at least one."""
    return max(1, -(-minutes // 60))


def recent(df: DataFrame, date_column: str, run_ts: str, hours: int, source_column: str = "site") -> DataFrame:
    """Rows no older than the lookback of their source."""
    moment = F.lit(run_ts).cast("timestamp_ntz")
    special = ("zip_recruiter", "naukri", "google")
    days = F.lit(float(lookback_days("", hours)))
    for name in special:
        days = F.when(F.col(source_column) == name, F.lit(float(lookback_days(name, hours)))).otherwise(days)
    seconds = F.round(days * 86400).cast("bigint")
    oldest = moment - F.make_dt_interval(secs=seconds)
    return df.where(F.col(date_column).cast("timestamp_ntz") >= oldest)


def board_filter(
    hours_old: int | None = None,
    easy_apply: bool = False,
    job_type: str | None = None,
    remote: bool = False,
    run_date: str | None = None,
) -> Column:
    """Only one of the filters applies: age beats easy apply beats type and remote."""
    if hours_old:
        return F.col("date_posted") >= F.date_sub(F.lit(run_date).cast("date"), -(-hours_old // 24))
    if easy_apply:
        return F.col("easy_apply")
    tests = []
    if job_type:
        tests.append(F.contains(F.col("job_type"), F.lit(job_type)))
    if remote:
        tests.append(F.col("is_remote"))
    return all_of(tests)


def pick_sources(wanted: str | list[str] | None = None) -> list[str]:
    """Names of the chosen sources; by default all but the company sites."""
    if wanted is None:
        return [s for s in SOURCES if s not in COMPANY_SOURCES]
    names = [wanted] if isinstance(wanted, str) else wanted
    out = [n.strip().replace("-", "_").replace(" ", "_").lower() for n in names]
    unknown = [n for n in out if n not in SOURCES]
    if unknown:
        raise ValueError(f"unknown sources: {unknown}")
    return out


def from_sources(df: DataFrame, wanted: str | list[str] | None = None, column: str = "site") -> DataFrame:
    """A plain isin, so that a table partitioned by source reads only the chosen ones."""
    return df.where(F.col(column).isin(*pick_sources(wanted)))
