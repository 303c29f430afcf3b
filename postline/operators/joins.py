"""Joins of postings with details, lookups and company context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.text import clean_text, meaningful
from postline.functions.url import linkedin_page
from postline.operators.skew import attach

DETAIL_COLUMNS = (
    "description", "apply_url", "job_url_direct", "applications_count", "job_level", "company_industry", "job_function",
)


def fill_missing(primary: Column, fallback: Column) -> Column:
    """The fallback where the primary text says nothing."""
    return F.when(F.coalesce(meaningful(primary), F.lit(False)), primary).otherwise(
        F.when(meaningful(fallback), fallback).otherwise(primary)
    )


def detail_first(detail: DataFrame, summary: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Detail values win over summary values where they are set."""
    side = detail.select(key, *[F.col(c).alias(f"_d_{c}") for c in columns if c in detail.columns])
    joined = summary.join(side, key, "left")
    made = {c: F.coalesce(clean_text(F.col(f"_d_{c}")), clean_text(F.col(c))) for c in columns if c in detail.columns}
    return joined.withColumns(made).select(*summary.columns)


def hydrate(postings: DataFrame, details: DataFrame) -> DataFrame:
    """Fill postings from landed detail pages, matched by posting id.

    Non-empty detail values replace what was there. Adds `hydration`:
    hydrated, failed (no page, no usable link or an empty page) or skipped
    (no link). Run it after dedup, so that texts are joined once per posting;
    `details` has one row per id, and repeated postings are split when hot.
    """
    from postline.operators.skew import attach

    page, job_id = linkedin_page(F.col("job_url"))
    keyed = postings.withColumn("_job_id", F.when(page.isNotNull(), job_id))
    present = [c for c in DETAIL_COLUMNS if c in details.columns]
    side = details.select(F.col("job_id").alias("_job_id"), *[F.col(c).alias(f"_d_{c}") for c in present])
    spread = F.coalesce("seq", F.xxhash64("job_url"))
    joined = attach(keyed, side, ["_job_id"], spread)
    made: dict[str, Column] = {}
    any_value = F.lit(False)
    for c in present:
        value = F.col(f"_d_{c}")
        text = clean_text(value.cast("string"))
        any_value = any_value | text.isNotNull()
        if c == "job_level":
            value = F.lower(value)
        made[c] = F.when(text.isNotNull(), value).otherwise(F.col(c))
    state = (
        F.when(clean_text(F.col("job_url")).isNull(), F.lit("skipped"))
        .when(F.coalesce(any_value, F.lit(False)), F.lit("hydrated"))
        .otherwise(F.lit("failed"))
    )
    return joined.withColumn("hydration", state).withColumns(made).select(*postings.columns, "hydration")


def hydration_summary(hydrated: DataFrame) -> DataFrame:
    state = F.col("hydration")
    return hydrated.agg(
        F.count_if(state != "skipped").alias("requested"),
        F.count_if(state == "hydrated").alias("hydrated"),
        F.count_if(state == "failed").alias("failed"),
    )


def with_context(positions: DataFrame, companies: DataFrame, key: str = "page_key", spread: str = "id") -> DataFrame:
    """Every position takes name, site, logo and description of its page; hot pages are split."""
    return attach(positions, companies, [key], F.col(spread))


def only_new(postings: DataFrame, inserted: DataFrame, spread: str = "seq") -> DataFrame:
    """Postings whose link was inserted by an upsert; hot links are split."""
    found = attach(postings, inserted.select("job_url").distinct(), ["job_url"], F.col(spread), "inner")
    return found.select(*postings.columns)


def resolve_choices(ids: Column, names: dict[str, str]) -> Column:
    """Choice ids to names, unknown ids kept, in order, once each; null when empty."""
    from postline.functions.lookups import look_up

    one = lambda x: F.coalesce(look_up(names, clean_text(x)), clean_text(x)) if names else clean_text(x)
    kept = F.array_distinct(F.filter(F.transform(ids, one), lambda x: x.isNotNull()))
    return F.when(F.size(kept) > 0, kept)


def first_of(*columns: Column) -> Column:
    """First text that is not blank."""
    return F.coalesce(*[clean_text(c) for c in columns])
