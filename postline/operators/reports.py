"""Counts, coverage and quality per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.text import clean_text
from postline.operators.records import map_records


def per_site(df: DataFrame, column: str = "site") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("jobs"))


def new_per_company(new: DataFrame, key: str = "direct_company_career_page_key") -> DataFrame:
    """New postings per career page."""
    rows = new.where(F.col(key).isNotNull())
    return rows.groupBy(F.col(key).alias("page_key")).agg(F.count("*").alias("new_jobs"))


def coverage_rows(pages: DataFrame, postings: DataFrame, failures: DataFrame, key: str = "company_key") -> DataFrame:
    """Per configured page: postings found, links, and the error if its run failed."""
    counts = postings.groupBy(key).agg(F.count("*").alias("jobs"), F.count("job_url").alias("links"))
    joined = pages.join(counts, key, "left").join(failures.select(key, "error"), key, "left")
    return joined.withColumns(
        {"jobs": F.coalesce("jobs", F.lit(0)), "links": F.coalesce("links", F.lit(0))}
    )


def coverage(rows: DataFrame) -> DataFrame:
    """One row over coverage_rows."""
    return rows.agg(
        F.count("*").alias("companies"),
        F.count_if(F.col("jobs") > 0).alias("companies_with_jobs"),
        F.count("error").alias("failed"),
        F.coalesce(F.sum("jobs"), F.lit(0)).alias("jobs"),
        F.coalesce(F.sum("links"), F.lit(0)).alias("links"),
    )


def checked_rows(raw: DataFrame, key: str = "source", sample: int | None = None) -> DataFrame:
    """key, seq, title, job_url, the mapped record and what is wrong with each row.

    All rows, or the first `sample` of each source. `messages` holds one text
    per fault; the mapping carries the raw title and link, so nothing is joined.
    """
    from postline.operators.skew import slice_within

    rows = raw if sample is None else slice_within(raw, key, 0, sample)
    given = {name: F.col(name).alias(f"given_{name}") for name in (key, "title", "job_url")}
    mapped = map_records(rows, payload=F.to_json(F.struct(*given.values())))
    back = F.from_json("raw_json", f"given_{key} string, given_title string, given_job_url string")
    out = mapped.withColumn("given", back).drop("raw_json")
    faults = [
        F.when(clean_text(F.col("given.given_title")).isNull(), F.lit("missing title")),
        F.when(clean_text(F.col("given.given_job_url")).isNull(), F.lit("missing job_url")),
        F.when(F.col("reject_reason").isNotNull(), F.concat(F.lit("could not be normalised: "), "reject_reason")),
    ]
    return out.select(
        F.col(f"given.given_{key}").alias(key),
        "seq",
        F.col("given.given_title").alias("given_title"),
        F.col("given.given_job_url").alias("given_job_url"),
        F.col("title").alias("record_title"),
        F.when(F.col("reject_reason").isNull(), F.col("job_url")).alias("record_url"),
        "reject_reason",
        F.filter(F.array(*faults), lambda x: x.isNotNull()).alias("messages"),
    )


def validate_sources(raw: DataFrame, pages: DataFrame | None = None, key: str = "source", sample: int | None = None) -> DataFrame:
    """Per source: rows, rows per error, the error texts and valid or failed.

    All rows unless a sample size is given; then the first rows of each source.
    Pass `pages` to report sources without any row.
    """
    checked = checked_rows(raw, key, sample)
    counts = checked.groupBy(key).agg(
        F.count("*").alias("jobs"),
        F.count_if(F.array_contains("messages", "missing title")).alias("missing_title"),
        F.count_if(F.array_contains("messages", "missing job_url")).alias("missing_job_url"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("not_normalised"),
    )
    if pages is not None:
        counts = pages.select(key).join(counts, key, "left").na.fill(0)
    return counts.withColumns({"errors": _messages(), "status": _status()})


def _messages() -> Column:
    found = [
        F.when(F.col("jobs") == 0, F.lit("no jobs")),
        F.when(F.col("missing_title") > 0, F.lit("missing title")),
        F.when(F.col("missing_job_url") > 0, F.lit("missing job_url")),
        F.when(F.col("not_normalised") > 0, F.lit("could not be normalised")),
    ]
    return F.array_join(F.filter(F.array(*found), lambda x: x.isNotNull()), "; ")


def _status() -> Column:
    bad = (F.col("jobs") == 0) | (F.col("missing_title") > 0) | (F.col("missing_job_url") > 0) | (F.col("not_normalised") > 0)
    return F.when(bad, F.lit("failed")).otherwise(F.lit("valid"))


def run_report(runs: DataFrame, finished_at: str) -> DataFrame:
    """One report row over the runs that were both fetched and stored.

    `runs` has one row per source run; the list names every source once.
    """
    done = runs.where(F.col("scraped") & F.col("persisted"))
    sites = F.array_sort(F.collect_set("site"))
    return done.agg(
        F.count("site").alias("site_count"),
        F.array_join(sites, ",").alias("sites"),
        F.coalesce(F.sum("jobs_retrieved"), F.lit(0)).alias("jobs_retrieved"),
        F.lit(finished_at).alias("finished_at"),
    )
