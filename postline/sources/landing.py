"""Landed JSON documents: posting files, grid exports, feeds, frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.functions.payload import get_path

# Keys under which a payload may keep its rows, in this order.
ROW_KEYS = ("jobs", "data", "positions", "results", "items")


def documents(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """file, doc (VARIANT) of landed JSON: one document per line, so that large files are read by many tasks.

    With `whole` every file is one document, which one task reads into one string.
    """
    text = spark.read.text(path, wholetext=whole).where(F.trim("value") != "")
    return text.select(F.col("_metadata.file_path").alias("file"), F.parse_json("value").alias("doc"))


def is_object(v: Column) -> Column:
    return F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))


def as_items(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "array<variant>")


def must(test: Column, value: Column, kind: str, message: str) -> Column:
    return F.when(test, value).otherwise(F.raise_error(F.lit(message)).cast(kind))


def posting_items(doc: Column) -> Column:
    """Items of an array document or of `jobs`; any other shape or item is an error."""
    items = F.coalesce(as_items(doc), as_items(doc, "$.jobs"))
    good = items.isNotNull() & F.forall(items, is_object)
    return must(good, items, "array<variant>", "expected a list of objects or an object with a jobs list of objects")


def read_postings(docs: DataFrame) -> DataFrame:
    """file, pos, item of every posting in documents of posting files."""
    return docs.select("file", F.posexplode(posting_items(F.col("doc"))).alias("pos", "item"))


def grid(doc: Column) -> tuple[Column, Column]:
    """Rows and columns of a grid export, at data.table or table; both must be lists of objects."""
    table = F.coalesce(F.try_variant_get(doc, "$.data.table", "variant"), F.try_variant_get(doc, "$.table", "variant"))
    out = []
    for part in ("rows", "columns"):
        items = as_items(table, f"$.{part}")
        good = items.isNotNull() & F.forall(items, is_object)
        out.append(must(good, items, "array<variant>", f"expected a grid export with a {part} list of objects"))
    return out[0], out[1]


def link_rows(doc: Column) -> Column:
    """Rows of a file of links: a list, {jobs: [...]}, or a grid export."""
    listed = F.coalesce(as_items(doc), as_items(doc, "$.jobs"))
    return F.when(listed.isNotNull(), listed).otherwise(grid(doc)[0])


def locate_rows(doc: Column, rows_path: str | None = None) -> Column:
    """The row list of a feed payload: at the given path, else the payload itself,
    else the first known key that holds a list, there or under `data`."""
    if rows_path is not None:
        return as_items(get_path(doc, rows_path))
    direct = [as_items(doc, f"$.{k}") for k in ROW_KEYS]
    nested = [as_items(doc, f"$.data.{k}") for k in ROW_KEYS]
    return F.coalesce(as_items(doc), *direct, *nested)


def probe_rows(doc: Column) -> Column:
    """The row list of an unknown payload: itself, or found by walking the known keys as deep as they go.

    In each object the keys are tried in their order. A list ends the object's
    turn; an object is walked first; a list without items lets the search go on
    behind the object it lies in. Without any row the result is an empty list.

    What is still to be walked is a stack per document. A step takes one value
    from it, so there are at most as many steps as known keys in the text.
    """
    is_list = lambda v: as_items(v).isNotNull()
    is_map = lambda v: F.try_variant_get(v, "$", "map<string,variant>").isNotNull()
    none = F.array().cast("array<variant>")

    def inside(v: Column) -> Column:
        under = F.array(*(F.try_variant_get(v, f"$.{k}", "variant") for k in ROW_KEYS))
        first_list = F.array_position(F.transform(under, is_list), F.lit(True))
        tried = F.slice(under, F.lit(1), F.when(first_list > 0, first_list).otherwise(F.lit(len(ROW_KEYS))).cast("int"))
        return F.filter(tried, lambda v: is_list(v) | is_map(v))

    def state(stack: Column, found: Column) -> Column:
        return F.struct(stack.alias("stack"), found.alias("found"))

    def step(s: Column, _: Column) -> Column:
        top, rest = F.get(s["stack"], F.lit(0)), F.slice(s["stack"], F.lit(2), F.greatest(F.size(s["stack"]), F.lit(1)))
        items = as_items(top)
        return (
            F.when((F.size(s["found"]) > 0) | (F.size(s["stack"]) == 0), s)
            .when(items.isNotNull(), state(rest, items))
            .otherwise(state(F.concat(inside(top), rest), none))
        )

    keys = F.regexp_count(F.to_json(doc), F.lit('"(' + "|".join(ROW_KEYS) + ')":'))
    walked = F.aggregate(F.sequence(F.lit(0), keys), state(F.array(doc), none), step, lambda s: s["found"])
    return F.coalesce(as_items(doc), walked)


def require_rows(rows: Column) -> Column:
    return must(rows.isNotNull(), rows, "array<variant>", "a feed payload must be a list or expose one")


def explode_items(df: DataFrame, items: Column, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(items).alias("pos", "item"))


def frame_to_rows(df: DataFrame, out: str = "row") -> DataFrame:
    """Each row as one JSON object; dates as ISO text, nulls kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(out))
