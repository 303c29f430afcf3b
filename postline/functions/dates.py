"""Date rules. Nothing raises: text that is no date gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postline.functions.text import clean_text
from postline.functions.url import found

ISO = (
    r"^(\d{4}-\d{2}-\d{2})"
    r"(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)?)?$"
)


def iso_date(c: Column) -> Column:
    """Date part of an ISO date or time, in the zone it was written in."""
    return found(clean_text(c), ISO).try_cast("date")


def _numeric(text: Column, pattern: str, order: tuple[int, int, int]) -> Column:
    year, month, day = (F.regexp_extract(text, pattern, g) for g in order)
    return F.when(text.rlike(pattern), F.concat_ws("-", year, month, day).try_cast("date"))


def _worded(text: Column, pattern: str, fmt: str) -> Column:
    return F.when(text.rlike(pattern), F.try_to_date(text, fmt))


def parse_date(c: Column, style: str = "record") -> Column:
    """First form that fits. Styles differ in the forms tried after ISO."""
    return parse_clean_date(clean_text(c), style)


def parse_clean_date(text: Column, style: str = "record") -> Column:
    """parse_date of text that is clean already."""
    slash_ymd = _numeric(text, r"^(\d{4})/(\d{1,2})/(\d{1,2})$", (1, 2, 3))
    slash_dmy = _numeric(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", (3, 2, 1))
    slash_mdy = _numeric(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", (3, 1, 2))
    day_word = _worded(text, r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy")
    forms = {
        "record": [slash_ymd],
        "feed": [slash_ymd, slash_dmy, slash_mdy],
        "careers": [day_word],
        "board": [
            day_word,
            _worded(text, r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
            _worded(text, r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
            _worded(text, r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
            slash_dmy,
        ],
    }[style]
    return F.coalesce(found(text, ISO).try_cast("date"), *forms)


def epoch_date(c: Column, unit: str = "seconds") -> Column:
    """UTC date of seconds or milliseconds since 1970."""
    days = F.floor(c.cast("double") / (86400 if unit == "seconds" else 86400000))
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def relative_date(c: Column, run_date: Column) -> Column:
    """today, yesterday, `Posted N Days Ago`."""
    low = F.lower(clean_text(c))
    days = found(low, r"posted\s+(\d+)\s+days?\s+ago").try_cast("int")
    return (
        F.when(F.contains(low, F.lit("today")), run_date)
        .when(F.contains(low, F.lit("yesterday")), F.date_sub(run_date, 1))
        .otherwise(F.date_sub(run_date, days))
    )


def footer_date(label: Column, created_ms: Column, run_date: Column) -> Column:
    """Label of a card first, else the creation time in milliseconds."""
    low = F.lower(F.coalesce(label, F.lit("")))
    fresh = low.rlike("today|just now|few hours")
    days = found(low, r"(\d+)\s*day").try_cast("int")
    return (
        F.when(fresh, run_date)
        .when(F.contains(low, F.lit("ago")), F.date_sub(run_date, days))
        .otherwise(epoch_date(created_ms, "milliseconds"))
    )


def days_ago_text(c: Column, run_date: Column) -> Column:
    """First number in the text as an age in days."""
    return F.date_sub(run_date, found(c, r"(\d+)").try_cast("int"))


def age_date(age: Column, run_date: Column) -> Column:
    return F.date_sub(run_date, age.cast("int"))


def parse_timestamp(c: Column) -> Column:
    """ISO text to a moment; text without a zone is read in the session zone."""
    text = clean_text(c)
    return F.when(text.rlike(ISO), F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp"))
