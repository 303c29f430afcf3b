"""The flat result rows: union of sources, fixed columns, order, samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.location import display_location
from postline.functions.money import annualise, extract_salary, salary_source

# Result columns in their order, with their types.
OUTPUT_COLUMNS: dict[str, str] = {
    "id": "string",
    "site": "string",
    "job_url": "string",
    "apply_url": "string",
    "job_url_direct": "string",
    "title": "string",
    "company": "string",
    "location": "string",
    "date_posted": "date",
    "applications_count": "bigint",
    "job_type": "string",
    "salary_source": "string",
    "interval": "string",
    "min_amount": "double",
    "max_amount": "double",
    "currency": "string",
    "is_remote": "boolean",
    "job_level": "string",
    "job_function": "string",
    "listing_type": "string",
    "emails": "string",
    "description": "string",
    "company_industry": "string",
    "company_url": "string",
    "company_logo": "string",
    "company_url_direct": "string",
    "company_addresses": "string",
    "company_num_employees": "string",
    "company_revenue": "string",
    "company_description": "string",
    "skills": "string",
    "experience_range": "string",
    "company_rating": "double",
    "company_reviews_count": "bigint",
    "vacancy_count": "bigint",
    "work_from_home_type": "string",
}
LISTS = ("job_type", "emails", "skills")
PREVIEW = ("search_shard", "site", "title", "company", "location", "date_posted", "job_url")


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """By name; columns a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_in_order(frames: list[DataFrame], seq: str = "seq") -> DataFrame:
    """As union_sources, with `priority` so that earlier frames come first."""
    return union_sources([f.withColumn("priority", F.lit(i)) for i, f in enumerate(frames)])


def align(df: DataFrame) -> DataFrame:
    """The fixed columns in order: lists joined, location as text, gaps null."""
    kinds = dict(df.dtypes)
    chosen: list[Column] = []
    for name, kind in OUTPUT_COLUMNS.items():
        source = "company_name" if name == "company" and "company_name" in kinds else name
        if source not in kinds:
            value = F.lit(None)
        elif name in LISTS and kinds[source].startswith("array"):
            value = F.nullif(F.array_join(F.col(source), ", "), F.lit(""))
        elif name == "location" and kinds[source].startswith("struct"):
            value = F.when(F.col(source).isNotNull(), display_location(F.col(source)))
        else:
            value = F.col(source)
        chosen.append(value.cast(kind).alias(name))
    return df.select(*chosen)


def add_pay(df: DataFrame, country: str, annual: bool = False) -> DataFrame:
    """Pay columns from the structured `compensation`, else from the text (USA only)."""
    pay = F.col("compensation")
    given = pay.isNotNull()
    year = annualise(pay["pay_interval"], pay["min_amount"], pay["max_amount"])
    text = extract_salary(F.col("description"), annual=annual) if country == "usa" else F.lit(None)
    df = df.withColumn("_text", text if country == "usa" else F.lit(None).cast(
        "struct<pay_interval:string,min_amount:bigint,max_amount:bigint,currency:string>"))
    structured = year if annual else pay
    low = F.when(given, structured["min_amount"].cast("double")).otherwise(F.col("_text.min_amount").cast("double"))
    return df.withColumns(
        {
            "interval": F.when(given, structured["pay_interval"]).otherwise(F.col("_text.pay_interval")),
            "min_amount": low,
            "max_amount": F.when(given, structured["max_amount"].cast("double")).otherwise(
                F.col("_text.max_amount").cast("double")
            ),
            "currency": F.when(given, F.coalesce(pay["currency"], F.lit("USD"))).otherwise(F.col("_text.currency")),
            "salary_source": salary_source(given, F.lit(country == "usa"), low),
        }
    ).drop("_text")


def order_results(df: DataFrame) -> DataFrame:
    """Source ascending, newest first, rows without a date last."""
    return df.orderBy(F.asc("site"), F.desc_nulls_last("date_posted"))


def order_changes(df: DataFrame) -> DataFrame:
    return df.orderBy("job_url")


def preview(df: DataFrame, order: list[Column], rows: int = 20) -> DataFrame:
    """The first rows of the usual columns that exist."""
    return df.orderBy(*order).limit(rows).select(*[c for c in PREVIEW if c in df.columns])


def cut_text(c: Column, limit: int) -> Column:
    from postline.functions.text import BLANKS

    short = F.concat(F.rtrim(F.left(c, F.lit(limit)), F.lit(BLANKS)), F.lit("...[truncated]"))
    return F.when(F.length(c) > limit, short).otherwise(c)


def sample(df: DataFrame, order: list[Column], rows: int = 5) -> DataFrame:
    """First rows with long texts cut: 800 characters of description, 2000 elsewhere."""
    head = df.orderBy(*order).limit(rows)
    return head.select(
        *[
            cut_text(F.col(n), 800 if n == "description" else 2000).alias(n) if t == "string" else F.col(n)
            for n, t in head.dtypes
        ]
    )
