"""Ticks of the hourly runs: which one collects a row and how far it looks back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Runs at half past, from 7 to 22, on the clock of one zone; some sources only every third hour.
FIRST_HOUR, LAST_HOUR, MINUTE = 7, 22, 30
HOURLY_MINUTES, FIRST_MINUTES, SLOW_HOURS = 60, 24 * 60, 3
ZONE = "Asia/Jerusalem"
HOUR_MICROS = 3600 * 1_000_000
FIRST_MICROS = (FIRST_HOUR * 60 + MINUTE) * 60 * 1_000_000


def lookback_minutes(tick: Column) -> Column:
    """The first tick of a day looks back a day, the others an hour."""
    first = (F.hour(tick) == FIRST_HOUR) & (F.minute(tick) == MINUTE)
    return F.when(first, FIRST_MINUTES).otherwise(HOURLY_MINUTES)


def is_tick(tick: Column) -> Column:
    return (F.minute(tick) == MINUTE) & F.hour(tick).between(FIRST_HOUR, LAST_HOUR)


def is_slow_tick(tick: Column) -> Column:
    """Ticks that also run the three-hourly sources."""
    return is_tick(tick) & ((F.hour(tick) - FIRST_HOUR) % SLOW_HOURS == 0)


def collecting_tick(moment: Column, slow: Column, zone: str = ZONE) -> Column:
    """Local time of the first tick at or after a moment; of the slow ones where `slow` holds.

    After the last tick of a day the first one of the next day collects, as it
    looks back a day.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_utc_timestamp(moment, F.current_timezone()).cast("timestamp_ntz"))
    day = F.date_trunc("day", local).cast("timestamp_ntz")
    past = F.greatest(F.timestamp_diff("MICROSECOND", day, local) - F.lit(FIRST_MICROS), F.lit(0))
    step = F.when(slow, F.lit(SLOW_HOURS * HOUR_MICROS)).otherwise(F.lit(HOUR_MICROS))
    waits = past + F.pmod(-past, step)  # whole microseconds: a tick collects what comes at it, not what comes after
    whole = (LAST_HOUR - FIRST_HOUR) // SLOW_HOURS * SLOW_HOURS
    last = F.when(slow, F.lit(whole * HOUR_MICROS)).otherwise(F.lit((LAST_HOUR - FIRST_HOUR) * HOUR_MICROS))
    after = F.when(waits > last, F.lit(24 * HOUR_MICROS)).otherwise(waits)
    return F.timestamp_add("SECOND", ((after + FIRST_MICROS) / 1_000_000).cast("int"), day)


def is_hours(source: str, slow: list[str]) -> Column:
    """Hours between the ticks of a source. Rows without a source count as hourly ones."""
    return F.when(F.coalesce(F.col(source).isin(slow), F.lit(False)), SLOW_HOURS).otherwise(1)


def ticked(df: DataFrame, moment: str, source: str, slow: list[str], zone: str = ZONE, *keep: str) -> DataFrame:
    """tick (local), source and hours of every row, and the columns to keep."""
    hours = is_hours(source, slow)
    return df.select(collecting_tick(F.col(moment), hours > 1, zone).alias("tick"), source, hours.alias("hours"), *keep)


def coverage(df: DataFrame, moment: str, source: str, slow: list[str], zone: str = ZONE) -> DataFrame:
    """tick, source, hours, n: rows per collecting tick. Rows without a source count as hourly ones; one scan."""
    return ticked(df, moment, source, slow, zone).groupBy("tick", source, "hours").agg(F.count("*").alias("n"))
