"""Pay rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postline.functions.lookups import PAY_UNITS, PERIODS_PER_YEAR, look_up
from postline.functions.text import clean_text

# Fixed value: `$a[k] - [$]b[k]`, one comma group at most.
PAY_RANGE = (
    r"\$(\d+(?:,\d+)?(?:\.\d+)?)([kK]?)\s*[-—–]\s*(?:\$)?(\d+(?:,\d+)?(?:\.\d+)?)([kK]?)"
)


def safe_int(c: Column) -> Column:
    """Whole part of numeric text; anything else is null.

    Other text is sorted out by a pattern first: a failing cast costs an
    exception per row.
    """
    number = F.regexp_extract(clean_text(c), r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$", 0)
    return F.when(number != "", number.try_cast("double").try_cast("bigint"))


def parse_bool(c: Column) -> Column:
    low = F.lower(clean_text(c))
    return F.when(low.isin("true", "1", "yes", "y", "remote"), True).when(
        low.isin("false", "0", "no", "n", "onsite", "hybrid"), False
    )


def parse_checkbox(c: Column) -> Column:
    low = F.lower(clean_text(c))
    return F.when(low.isin("true", "1", "yes"), True).when(low.isin("false", "0", "no"), False)


def currency_number(c: Column) -> Column:
    """`1.234,56 €` or `$1,234.56` to 1234.56."""
    kept = F.regexp_replace(c, "[^-0-9.,]", "")
    head = F.left(kept, F.greatest(F.length(kept) - 3, F.lit(0)))
    tail = F.right(kept, F.lit(3))
    number = F.concat(F.regexp_replace(head, "[.,]", ""), F.replace(tail, F.lit(","), F.lit(".")))
    return F.round(number.try_cast("double"), 2)


def extract_salary(
    text: Column,
    annual: bool = False,
    low: int = 1000,
    high: int = 700000,
    hourly_below: int = 350,
    monthly_below: int = 30000,
) -> Column:
    """Pay range in free text: struct(pay_interval, min_amount, max_amount, currency).

    The range is found once in the long text; its parts are read from the short
    match. With annual=True the amounts are per year while the interval stays
    the one that was written.
    """
    match = F.regexp_extract(text, PAY_RANGE, 0)

    def amount(group: int) -> Column:
        digits = F.replace(F.regexp_extract(match, PAY_RANGE, group), F.lit(","), F.lit(""))
        return F.floor(digits.try_cast("double")).cast("bigint")

    thousands = (F.regexp_extract(match, PAY_RANGE, 2) != "") | (F.regexp_extract(match, PAY_RANGE, 4) != "")
    scale = F.when(thousands, F.lit(1000)).otherwise(F.lit(1))
    lo, hi = amount(1) * scale, amount(3) * scale
    interval = (
        F.when(lo < hourly_below, F.lit("hourly"))
        .when(lo < monthly_below, F.lit("monthly"))
        .when(lo.isNotNull(), F.lit("yearly"))
    )
    limit = F.when(interval == "hourly", F.lit(hourly_below)).when(interval == "monthly", F.lit(monthly_below))
    times = F.when(interval == "hourly", F.lit(2080)).when(interval == "monthly", F.lit(12)).otherwise(F.lit(1))
    year_lo = lo * times
    year_hi = F.when(limit.isNull() | (hi < limit), hi * times)
    ok = year_lo.between(low, high) & year_hi.between(low, high) & (year_lo < year_hi)
    return F.when(
        ok,
        F.struct(
            interval.alias("pay_interval"),
            (year_lo if annual else lo).alias("min_amount"),
            (year_hi if annual else hi).alias("max_amount"),
            F.lit("USD").alias("currency"),
        ),
    )


def annualise(interval: Column, low: Column, high: Column) -> Column:
    """struct(pay_interval, min_amount, max_amount); only when both bounds are set and not 0."""
    times = F.coalesce(look_up(PERIODS_PER_YEAR, interval), F.lit(1))
    due = interval.isNotNull() & (interval != "yearly") & (low != 0) & (high != 0)
    return F.struct(
        F.when(due, F.lit("yearly")).otherwise(interval).alias("pay_interval"),
        F.when(due, low * times).otherwise(low).alias("min_amount"),
        F.when(due, high * times).otherwise(high).alias("max_amount"),
    )


def unit_interval(unit: Column) -> Column:
    return look_up(PAY_UNITS, F.upper(unit))


def structured_pay(base: dict[str, Column], estimate: dict[str, Column]) -> Column:
    """Base pay if present, else the estimate. Keys: unit, low, high, currency.

    The currency is the estimate's when there is an estimate at all.
    """
    has_base = base["unit"].isNotNull()
    has_estimate = estimate["unit"].isNotNull()
    unit = F.coalesce(base["unit"], estimate["unit"])
    interval = unit_interval(unit)
    return F.when(
        interval.isNotNull(),
        F.struct(
            interval.alias("pay_interval"),
            F.when(has_base, base["low"]).otherwise(estimate["low"]).cast("bigint").alias("min_amount"),
            F.when(has_base, base["high"]).otherwise(estimate["high"]).cast("bigint").alias("max_amount"),
            F.when(has_estimate, estimate["currency"]).otherwise(base["currency"]).alias("currency"),
        ),
    )


def percentile_pay(period: Column, p10: Column, p90: Column, currency: Column) -> Column:
    """Adjusted pay: 10th and 90th percentile, floored."""
    interval = look_up({**PAY_UNITS, **{v.upper(): v for v in PAY_UNITS.values()}}, period)
    known = period.isin("ANNUAL", "YEAR", "HOUR", "YEARLY", "MONTHLY", "WEEKLY", "DAILY", "HOURLY")
    return F.when(
        clean_text(period).isNotNull() & p10.isNotNull() & p90.isNotNull(),
        F.struct(
            F.when(known, interval).alias("pay_interval"),
            F.floor(p10).cast("bigint").alias("min_amount"),
            F.floor(p90).cast("bigint").alias("max_amount"),
            F.coalesce(currency, F.lit("USD")).alias("currency"),
        ),
    )


def lakh_pay(label: Column) -> Column:
    """`12-16 Lacs P.A.` or `1-5 Cr`: struct(min_amount, max_amount, currency)."""
    pattern = r"(?i)^(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)\s*(Lacs|Lakh|Cr)"
    text = clean_text(label)
    unit = F.lower(F.regexp_extract(text, pattern, 3))
    times = F.when(unit == "cr", F.lit(10000000)).when(unit != "", F.lit(100000))
    return F.when(
        times.isNotNull(),
        F.struct(
            F.floor(F.regexp_extract(text, pattern, 1).try_cast("double") * times).cast("bigint").alias("min_amount"),
            F.floor(F.regexp_extract(text, pattern, 2).try_cast("double") * times).cast("bigint").alias("max_amount"),
            F.lit("INR").alias("currency"),
        ),
    )


def card_pay(text: Column) -> Column:
    """`$a - $b` on a result card: struct(min_amount, max_amount, currency)."""
    line = clean_text(text)
    sides = F.split(line, "-")
    sign = F.left(line, F.lit(1))
    return F.when(
        F.contains(line, F.lit("-")),
        F.struct(
            currency_number(F.get(sides, F.lit(0))).cast("bigint").alias("min_amount"),
            currency_number(F.get(sides, F.lit(1))).cast("bigint").alias("max_amount"),
            F.when(sign == "$", F.lit("USD")).otherwise(sign).alias("currency"),
        ),
    )


def salary_source(has_structured: Column, from_text: Column, low: Column) -> Column:
    """Where the pay came from; nothing when there is no minimum or it is 0."""
    origin = F.when(has_structured, F.lit("direct_data")).when(from_text, F.lit("description"))
    return F.when(low.isNotNull() & (low != 0), origin)


def float_text(c: Column) -> Column:
    """A double as text with at least one decimal and no exponent."""
    whole = F.concat(c.cast("decimal(38,0)").cast("string"), F.lit(".0"))
    long_form = F.rtrim(c.cast("decimal(38,6)").cast("string"), F.lit("0"))
    return F.when(c == F.floor(c), whole).when(F.abs(c) >= 10000000, long_form).otherwise(c.cast("string"))


def salary_text(low: Column, high: Column, interval: Column, currency: Column) -> Column:
    """`CUR min - max interval`, leaving out what is missing."""
    amounts = F.when(
        low.isNotNull() & high.isNotNull(), F.concat(float_text(low), F.lit(" - "), float_text(high))
    ).otherwise(float_text(F.coalesce(low, high)))
    return F.nullif(F.concat_ws(" ", clean_text(currency), amounts, clean_text(interval)), F.lit(""))


def pay_envelope(ranges: Column) -> Column:
    """Widest range of a list of struct(low text, high text, currency)."""
    full = F.filter(ranges, lambda r: clean_text(r["low"]).isNotNull() & clean_text(r["high"]).isNotNull())
    coins = F.array_distinct(
        F.filter(F.transform(ranges, lambda r: clean_text(r["currency"])), lambda x: x.isNotNull())
    )
    return F.when(
        F.size(full) > 0,
        F.struct(
            F.lit("yearly").alias("pay_interval"),
            F.array_min(F.transform(full, lambda r: currency_number(r["low"]))).alias("min_amount"),
            F.array_max(F.transform(full, lambda r: currency_number(r["high"]))).alias("max_amount"),
            F.when(F.size(coins) == 1, F.get(coins, F.lit(0))).otherwise(F.lit("USD")).alias("currency"),
        ),
    )
