"""Company tables: grid exports with declared columns, careers pages, base URLs."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.dates import parse_timestamp
from postline.functions.money import parse_checkbox, safe_int
from postline.functions.text import clean_text
from postline.operators.joins import resolve_choices

# Headers with a column name of their own.
COLUMN_NAMES = {
    "Company": "company_name",
    "Website": "website_url",
    "Linkedin": "linkedin_url",
    "Crunchbase": "crunchbase_url",
    "Startup Nation Finder": "startup_nation_finder_url",
    "GlassDoor": "glassdoor_url",
    "Facebook": "facebook_url",
    "Twitter": "twitter_url",
    "Instagram": "instagram_url",
    "Youtube": "youtube_url",
    "Geektime Insider": "geektime_insider_url",
    "TikTok": "tiktok_url",
    "POC Linkedin": "poc_linkedin_url",
    "Updated": "source_updated_at",
}
PAGE_DEFAULTS = {
    "country_indeed": "Israel", "results_wanted": 0, "description_format": "markdown", "request_timeout": 60,
}
# Columns whose difference makes a seeded page changed.
SEED_COLUMNS = (
    "company_name", "company_aliases", "scraper_site", "career_page_url", "search_term", "location",
    "country_indeed", "results_wanted", "description_format", "description_limit", "request_timeout",
    "extra_params", "detected_platform", "resolved_fetch_url",
)
PAGE_COLUMNS = {
    "id": "bigint", "company_key": "string", "company_name": "string", "company_aliases": "string",
    "scraper_site": "string", "career_page_url": "string", "search_term": "string", "location": "string",
    "country_indeed": "string", "results_wanted": "bigint", "description_format": "string",
    "description_limit": "bigint", "request_timeout": "bigint", "enabled": "boolean", "extra_params": "string",
    "status": "string", "detected_platform": "string", "resolved_fetch_url": "string", "validation_report": "string",
    "sample_jobs": "string", "last_validated_at": "timestamp", "activated_at": "timestamp", "created_at": "timestamp",
    "updated_at": "timestamp",
}


@dataclass(frozen=True)
class GridColumn:
    """One declared column of a grid export and the type it gets."""

    source_id: str
    name: str
    kind: str
    spark_type: str
    choices: dict[str, str] = field(default_factory=dict)


def column_name(header: str) -> str:
    if header in COLUMN_NAMES:
        return COLUMN_NAMES[header]
    name = re.sub(r"[^a-z0-9]+", "_", header.lower()).strip("_")
    if not name or not re.fullmatch(r"[a-z_][a-z0-9_]*", name):
        raise ValueError(f"no safe column name for {header!r}")
    return name


def spark_type(kind: str, name: str, is_datetime: bool) -> str:
    if name == "source_updated_at" or (kind == "formula" and is_datetime):
        return "timestamp"
    return {"checkbox": "boolean", "number": "bigint", "multiSelect": "array<string>"}.get(kind, "string")


def grid_schema(columns: DataFrame, item: str = "item") -> list[GridColumn]:
    """Column definitions of all documents of an export, in order of first place.

    Equal definitions are folded on Spark; what reaches the driver is the header,
    one row per different definition. One id with two types or names is an error.
    """
    v = F.col(item)
    get = lambda path, kind="string": F.try_variant_get(v, path, kind)
    choice_list = F.transform(
        F.try_variant_get(v, "$.typeOptions.choices", "array<variant>"),
        lambda c: F.struct(F.try_variant_get(c, "$.id", "string").alias("id"), F.try_variant_get(c, "$.name", "string").alias("name")),
    )
    choice_map = F.from_json(F.to_json(get("$.typeOptions.choices", "variant")), "map<string,variant>")
    from_map = F.transform(
        F.map_entries(choice_map),
        lambda e: F.struct(
            e["key"].alias("id"),
            F.coalesce(F.try_variant_get(e["value"], "$.name", "string"), F.try_variant_get(e["value"], "$", "string")).alias("name"),
        ),
    )
    stated = columns.select(
        "pos", clean_text(get("$.id")).alias("id"), clean_text(get("$.name")).alias("name"), clean_text(get("$.type")).alias("type"),
        F.coalesce(get("$.typeOptions.isDateTime", "boolean"), F.lit(False)).alias("is_datetime"),
        F.coalesce(choice_list, from_map).alias("choices"),
    )
    folded = stated.groupBy("id", "name", "type", "is_datetime").agg(
        F.min("pos").alias("pos"), F.array_distinct(F.flatten(F.collect_set("choices"))).alias("choices")
    )
    header = folded.orderBy("pos", "id").collect()
    out: list[GridColumn] = []
    for row in header:
        if not row["id"] or not row["name"] or not row["type"]:
            raise ValueError("each grid column needs id, name and type")
        name = column_name(row["name"])
        if any(c.source_id == row["id"] for c in out):
            raise ValueError(f"grid column {row['id']!r} is defined in two ways")
        if any(c.name == name for c in out):
            raise ValueError(f"two grid columns become {name!r}")
        choices = {c["id"].strip(): c["name"].strip() for c in row["choices"] or [] if c["id"] and c["name"]}
        out.append(GridColumn(row["id"], name, row["type"], spark_type(row["type"], name, row["is_datetime"]), choices))
    return out


def cell(cells: Column, column: GridColumn) -> Column:
    """One typed value of a grid row."""
    at = f'$["{column.source_id}"]'
    raw = F.try_variant_get(cells, at, "string")
    if column.spark_type == "array<string>":
        many = F.try_variant_get(cells, at, "array<string>")
        return resolve_choices(F.coalesce(many, F.array(raw)), column.choices)
    if column.kind == "select":
        return F.get(resolve_choices(F.array(raw), column.choices), F.lit(0))
    if column.spark_type == "timestamp":
        return parse_timestamp(raw)
    if column.spark_type == "boolean":
        return parse_checkbox(raw)
    return safe_int(raw) if column.spark_type == "bigint" else clean_text(raw)


def grid_records(rows: DataFrame, columns: list[GridColumn], item: str = "item") -> DataFrame:
    """Typed records; rows without id or cells drop out. `pos` keeps the order."""
    v = F.col(item)
    cells = F.try_variant_get(v, "$.cellValuesByColumnId", "variant")
    row_id = clean_text(F.try_variant_get(v, "$.id", "string"))
    good = row_id.isNotNull() & F.startswith(F.schema_of_variant(cells), F.lit("OBJECT"))
    return rows.where(good).select(
        "pos",
        row_id.alias("row_id"),
        parse_timestamp(F.try_variant_get(v, "$.createdTime", "string")).alias("created_time"),
        *[cell(cells, c).alias(c.name) for c in columns],
        F.to_json(v).alias("raw_json"),
    )


def upsert_companies(current: DataFrame, new: DataFrame, run_ts: str, key: str = "row_id") -> DataFrame:
    """Every column replaced by row id; `action` is insert, update or keep.

    New columns of the export join the table, old rows have nulls there.
    `new` has one row per id (folding.last_seen). When the batch is small the
    stored side is not shuffled.
    """
    now = F.lit(run_ts).cast("timestamp")
    made = [c for c in new.columns if c not in (key, "pos")]
    side = new.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_n_{c}") for c in made])
    both = current.join(side, key, "left")
    kinds = dict(new.dtypes)
    out = []
    for c in [*current.columns, *[c for c in made if c not in current.columns]]:
        if c in (key, "created_at"):
            out.append(F.col(c))
        elif c == "updated_at":
            out.append(F.when(F.col("_hit"), now).otherwise(F.col(c)).alias(c))
        elif c in made:
            old = F.col(c) if c in current.columns else F.lit(None).cast(kinds[c])
            out.append(F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(old).alias(c))
        else:
            out.append(F.col(c))
    action = F.when(F.col("_hit"), F.lit("update")).otherwise(F.lit("keep"))
    updated = both.select(*out, action.alias("action"))
    known = current.select(key).join(new.select(key), key, "left_semi")
    fresh = new.drop("pos").join(known, key, "left_anti").withColumns(
        {"created_at": now, "updated_at": now, "action": F.lit("insert")}
    )
    return updated.unionByName(fresh, allowMissingColumns=True)


def complete_pages(pages: DataFrame) -> DataFrame:
    """All columns of the careers page table; late ones are null or have their default."""
    out = []
    for name, kind in PAGE_COLUMNS.items():
        c = F.col(name) if name in pages.columns else F.lit(None)
        value = c.cast(kind)
        if name in PAGE_DEFAULTS:
            value = F.coalesce(value, F.lit(PAGE_DEFAULTS[name]).cast(kind))
        if name == "status":
            value = F.coalesce(value, F.when(F.col("enabled"), F.lit("active")).otherwise(F.lit("disabled")))
        out.append(value.alias(name))
    return pages.select(*out)


def list_pages(pages: DataFrame, enabled_only: bool = True) -> DataFrame:
    rows = complete_pages(pages)
    if enabled_only:
        rows = rows.where("enabled")
    return rows.orderBy("company_name", "company_key")


def list_base_urls(links: DataFrame) -> DataFrame:
    return links.orderBy(F.asc_nulls_last("company_name"), "base_url")


def base_url(links: DataFrame, wanted: str | None = None) -> DataFrame:
    """The row of one base URL, or the newest row."""
    if wanted and wanted.strip():
        return links.where(F.col("base_url") == wanted.strip()).limit(1)
    order = (F.desc_nulls_last("updated_at"), F.desc_nulls_last("created_at"), F.asc("base_url"))
    return links.orderBy(*order).limit(1)


def _pages_upsert(current: DataFrame, new: DataFrame, run_ts: str, changed: Column, values: dict[str, Column], fresh: DataFrame) -> DataFrame:
    side = new.select("company_key", F.lit(True).alias("_hit"), *[
        F.col(c).alias(f"n_{c}") for c in new.columns if c != "company_key"
    ])
    both = current.join(side, "company_key", "left").withColumn("_set", F.coalesce(F.col("_hit") & changed, F.lit(False)))
    cols = [
        (F.when(F.col("_set"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)) for c in current.columns
    ]
    known = current.select("company_key").join(new.select("company_key"), "company_key", "left_semi")
    added = fresh.join(known, "company_key", "left_anti")
    kinds = dict(current.dtypes)
    added = added.select(
        *[(F.col(c) if c in added.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in current.columns]
    )
    return both.select(*cols).unionByName(added)


def upsert_validated(current: DataFrame, results: DataFrame, run_ts: str, activate: bool = False) -> DataFrame:
    """Pages after validation results: status active, valid or failed.

    `results` has company_key, valid and page columns, one row per key.
    Activating an invalid result is an error. The first activation time stays.
    """
    now = F.lit(run_ts).cast("timestamp")
    refuse = F.raise_error(F.lit("cannot activate an invalid careers page")).cast("boolean")
    enabled = F.lit(False) if not activate else F.when(F.col("valid"), F.lit(True)).otherwise(refuse)
    new = results.withColumn("enabled", enabled)
    status = F.when(F.col("enabled"), "active").when(F.col("valid"), "valid").otherwise("failed")
    new = new.withColumns(
        {
            "status": status, "last_validated_at": now, "activated_at": F.when(F.col("enabled"), now),
            "created_at": now, "updated_at": now,
        }
    ).drop("valid")
    values = {
        c: F.col(f"n_{c}") for c in new.columns if c not in ("company_key", "created_at", "activated_at", "id")
    }
    values["activated_at"] = F.when(F.col("n_enabled"), F.coalesce("activated_at", "n_activated_at")).otherwise(
        F.col("activated_at")
    )
    return _pages_upsert(current, new, run_ts, F.lit(True), values, new)


def upsert_seeds(current: DataFrame, seeds: DataFrame, run_ts: str) -> DataFrame:
    """Default pages: rewritten only when one of the compared columns differs;
    enabled and status of a stored page are never touched."""
    now = F.lit(run_ts).cast("timestamp")
    compared = [c for c in SEED_COLUMNS if c in seeds.columns and c in current.columns]
    changed = F.lit(False)
    for c in compared:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"n_{c}"))
    values = {c: F.col(f"n_{c}") for c in compared} | {"updated_at": now}
    fresh = seeds.withColumns(
        {
            "status": F.when(F.col("enabled"), "active").otherwise("disabled"), "created_at": now, "updated_at": now,
            "activated_at": F.when(F.col("enabled"), now),
        }
    )
    return _pages_upsert(current, seeds, run_ts, changed, values, fresh)


def company_name_of(doc: Column, name_cell: str) -> Column:
    """company_name, else company.name, else company as text, else the grid cell."""
    get = lambda path: clean_text(F.try_variant_get(doc, path, "string"))
    plain = F.when(~F.startswith(F.schema_of_variant(F.try_variant_get(doc, "$.company", "variant")), F.lit("OBJECT")), get("$.company"))
    return F.coalesce(get("$.company_name"), get("$.company.name"), plain, get(f"$.cellValuesByColumnId.{name_cell}"))


def link_of(doc: Column, link_cell: str) -> Column:
    get = lambda path: clean_text(F.try_variant_get(doc, path, "string"))
    return F.coalesce(get("$.job_url"), get(f"$.cellValuesByColumnId.{link_cell}"))


