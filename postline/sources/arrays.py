"""One large JSON document read by many tasks: an array of objects, or an object with a `jobs` array.

The file is read as text cut behind every `}`, which Spark's reader does for any
range of a file on any file system. Whether a piece begins inside a string, and
how deep, follows from counts of quotes and brackets before it: running sums
within each range of the file, and one row per range to carry them on. A piece
whose `}` brings the depth back to that of the list ends an item. So line breaks
and layout do not matter, and no task holds more than a range and an item.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postline.session import cut_lineage

#: The opening of the list in an object; a quote behind a backslash belongs to a longer key.
JOBS = r'(?<!\\)"jobs"\s*:\s*\['
BLANK = r"[ \t\r\n]*"
SHAPE = "expected a JSON array or an object with a jobs array, of objects only"


def signs(text: Column) -> Column:
    """Only the quotes and brackets of a text, without those behind a backslash: all that depth depends on."""
    return F.regexp_replace(text, r'(?s)(?:\\.|[^"{}\[\]\\]++)++', "")


def depth_change(marks: Column, starts_inside: bool) -> Column:
    """Brackets opened less those closed outside of strings, when the text begins outside or inside of one."""
    parts = F.split(marks, '"', -1)
    odd = 1 if starts_inside else 0
    bare = F.array_join(F.filter(parts, lambda _, i: i % 2 == odd), "")
    opened = F.length(F.translate(bare, "}]", ""))
    return (2 * opened - F.length(bare)).cast("long")


def quotes(marks: Column) -> Column:
    return F.length(F.translate(marks, "{}[]", "")).cast("long")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, range, row and text of the pieces between closing braces; `last` marks one without a brace behind it."""
    read = spark.read.option("lineSep", "}").text(path)
    meta = F.col("_metadata")
    found = read.select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("range"), F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("text"), meta["file_size"].alias("file_size"), signs(F.col("value")).alias("marks"),
    )
    return cut_lineage(found)


def lexed(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces with what stands before them in their range, and one row per range with what stands before it in its file."""
    ends = found.groupBy("file").agg(
        F.max(F.struct("range", "row")).alias("end"), (F.sum(F.octet_length("text") + 1) > F.max("file_size")).alias("open")
    )
    open_ends = ends.where("open").select("file", F.col("end.range").alias("range"), F.col("end.row").alias("row"), F.lit(True).alias("last"))
    rows = found.drop("file_size").join(open_ends, ["file", "range", "row"], "left").withColumn("last", F.coalesce("last", F.lit(False)))
    rows = rows.withColumn("quotes", quotes(F.col("marks")))

    def change(inside: int) -> Column:
        ends_outside = (F.col("quotes") + inside) % 2 == 0
        return depth_change(F.col("marks"), bool(inside)) - F.when(ends_outside & ~F.col("last"), 1).otherwise(0)

    rows = rows.withColumns({"change0": change(0), "change1": change(1)})
    before = Window.partitionBy("file", "range").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    rows = rows.withColumn("quotes_before", so_far("quotes"))
    even = F.col("quotes_before") % 2 == 0
    for k in (0, 1):  # the change of each piece when the range begins outside, or inside, of a string
        rows = rows.withColumn(f"own{k}", F.when(even, F.col(f"change{k}")).otherwise(F.col(f"change{1 - k}")))
    rows = rows.withColumns({f"before{k}": so_far(f"own{k}") for k in (0, 1)})
    rows = cut_lineage(rows.drop("change0", "change1", "marks"))
    ranges = rows.groupBy("file", "range").agg(F.sum("quotes").alias("q"), F.sum("own0").alias("t0"), F.sum("own1").alias("t1"))
    by_file = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("q").over(by_file), F.lit(0)) % 2 == 1)
    taken = F.when(F.col("inside"), F.col("t1")).otherwise(F.col("t0"))
    ranges = ranges.withColumn("depth", F.coalesce(F.sum(taken).over(by_file), F.lit(0)))
    return rows, ranges.withColumn("end_depth", F.col("depth") + taken).withColumn("end_inside", F.col("inside") != (F.col("q") % 2 == 1))


def opening(text: Column, depth: Column, inside: Column) -> Column:
    """Length of the text up to behind the bracket that opens the jobs list of the top object; null if it is not in here."""
    parts = F.regexp_extract_all(text, F.lit(f"(?s).*?{JOBS}"), F.lit(0))
    upto = F.transform(parts, lambda _, i: F.array_join(F.slice(parts, F.lit(1), i + 1), ""))
    change = lambda p: F.when(inside, depth_change(signs(p), True)).otherwise(depth_change(signs(p), False))
    top = F.filter(upto, lambda p: depth + change(p) == 2)
    return F.when(F.contains(text, F.lit('"jobs"')), F.char_length(F.get(top, F.lit(0))))


def placed(rows: DataFrame, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces with their depth and whether they lie in the list, and one row per file: where its list begins and ends."""
    inside = (F.col("quotes_before") % 2 == 1) != F.col("inside")
    depth = F.col("depth") + F.when(F.col("inside"), F.col("before1")).otherwise(F.col("before0"))
    change = F.when(F.col("inside"), F.col("own1")).otherwise(F.col("own0"))
    rows = rows.join(ranges.select("file", "range", "inside", "depth"), ["file", "range"])
    rows = rows.select("file", "range", "row", "text", "last", inside.alias("starts_inside"), depth.alias("from_depth"), change.alias("change"), "quotes")
    rows = rows.withColumn("to_depth", F.col("from_depth") + F.col("change")).withColumn(
        "closes", ~F.col("last") & (F.col("starts_inside") == (F.col("quotes") % 2 == 1))
    )
    at = F.struct("range", "row")
    first = rows.groupBy("file").agg(F.min(F.struct("range", "row", F.ltrim(F.substring("text", 1, 4096)).alias("text")))["text"].alias("head"))
    is_array = F.regexp_like(F.col("head"), F.lit(r"^\s*\["))
    kinds = cut_lineage(first.select("file", F.when(is_array, 1).otherwise(2).alias("base")))
    rows = rows.join(kinds, "file")
    cut = F.when(F.col("base") == 1, F.when(F.col("from_depth") == 0, F.char_length(F.regexp_extract("text", r"^\s*\[", 0))))
    cut = cut.otherwise(opening(F.col("text"), F.col("from_depth"), F.col("starts_inside")))
    rows = cut_lineage(rows.withColumn("cut", F.when(cut > 0, cut)))
    starts = rows.where("cut is not null").groupBy("file").agg(F.min(F.struct("range", "row", "cut")).alias("start"))
    after = rows.join(starts, "file").where(at >= F.struct("start.range", "start.row"))
    begins = at == F.struct("start.range", "start.row")
    rest = F.when(begins, F.expr("substring(text, start.cut + 1)")).otherwise(F.col("text"))
    level = begins | ((F.col("from_depth") == F.col("base")) & ~F.col("starts_inside"))
    stops = after.where(level & F.regexp_like(rest, F.lit(rf"^{BLANK}\]"))).groupBy("file").agg(F.min(at).alias("stop"))
    files = kinds.join(starts, "file", "left").join(stops, "file", "left")
    return rows, cut_lineage(files)


def array_items(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, item (VARIANT) of every object in the lists of the documents at path, one document per file.

    A document of any other shape, one that is not well formed, or a list with
    anything but objects in it is an error for the read, as is one that is cut
    off. All of a document but its list must fit one task.
    """
    found = pieces(spark, path)
    listed = [(re.sub("^file:/+", "file:/", f),) for f in spark.read.text(path).inputFiles()]  # the listing the driver has anyway
    names = spark.createDataFrame(listed, "file string")
    empty = names.join(found.select(F.regexp_replace("file", "^file:/+", "file:/").alias("file")), "file", "left_anti").limit(5).collect()
    if empty:
        raise ValueError(f"{SHAPE}: {', '.join(r['file'] for r in empty)}")
    rows, ranges = lexed(found)
    rows, files = placed(rows, ranges)
    at = F.struct("range", "row")
    rows = rows.join(files.drop("base"), "file", "left")
    begins = at == F.struct("start.range", "start.row")
    listed = F.coalesce((at >= F.struct("start.range", "start.row")) & (at < F.col("stop")), F.lit(False))
    rows = rows.withColumn("listed", listed).withColumn("begins", F.coalesce(begins, F.lit(False)))
    must_hold(frames(rows, files, ranges))
    body = rows.where("listed").withColumn("text", F.when(F.col("begins"), F.expr("substring(text, start.cut + 1)")).otherwise(F.col("text")))
    ends = F.col("closes") & (F.col("to_depth") == F.col("base"))
    body = body.select("file", "range", "row", "text", F.when(ends, F.col("row")).alias("end_row"))
    backwards = Window.partitionBy("file", "range").orderBy(F.desc("row")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    body = body.withColumn("in_range", F.min("end_row").over(backwards))  # the first end from here on
    counts = body.groupBy("file", "range").agg(F.count("end_row").alias("n"), F.min(F.when(F.col("end_row").isNotNull(), at)).alias("first_end"))
    forth = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("file").orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "file", "range", F.coalesce(F.sum("n").over(forth), F.lit(0)).alias("items_before"), F.min("first_end").over(back).alias("next_end")
    )
    counts = cut_lineage(counts)
    here = F.struct(F.col("range"), F.col("in_range").alias("row"))
    body = body.join(counts.select("file", "range", "next_end"), ["file", "range"])
    body = body.withColumn("end", F.when(F.col("in_range").isNotNull(), here).otherwise(F.col("next_end")))
    texts = body.groupBy("file", "end").agg(F.sort_array(F.collect_list(F.struct("range", "row", "text"))).alias("parts"))
    texts = texts.select("file", F.col("end.range").alias("range"), F.col("end.row").alias("row"), F.concat(F.array_join("parts.text", "}"), F.lit("}")).alias("text"))
    number = F.row_number().over(Window.partitionBy("file", "range").orderBy("row")) - 1
    texts = texts.withColumn("n", number).join(counts.select("file", "range", "items_before"), ["file", "range"])
    pos = F.col("n") + F.col("items_before")
    comma = F.when(pos == 0, F.lit(rf"^{BLANK}\{{")).otherwise(F.lit(rf"^{BLANK},{BLANK}\{{"))
    good = F.regexp_like("text", comma)
    item = F.parse_json(F.when(good, F.regexp_replace("text", r"^\s*,?\s*", "")).otherwise(F.raise_error(F.lit(SHAPE))))
    return texts.select("file", pos.cast("int").alias("pos"), item.alias("item"))


def frames(rows: DataFrame, files: DataFrame, ranges: DataFrame) -> DataFrame:
    """file and frame: each document without the items of its list, null where it cannot be told."""
    brace = F.when(F.col("last"), F.lit("")).otherwise(F.lit("}"))
    begin = F.expr("substring(text, 1, start.cut)")
    part = F.when(F.col("begins") & F.col("listed"), begin).otherwise(F.concat("text", brace))
    kept = rows.where(~F.col("listed") | F.col("begins")).select("file", F.struct("range", "row", part.alias("part")).alias("p"))
    whole = kept.groupBy("file").agg(F.array_join(F.sort_array(F.collect_list("p"))["part"], "").alias("frame"))
    last = ranges.groupBy("file").agg(F.max(F.struct("range", "end_depth", "end_inside")).alias("end"))
    closed = rows.groupBy("file").agg(F.count_if(F.col("closes") & (F.col("to_depth") == 0)).alias("objects"))
    balanced = (F.col("end.end_depth") == 0) & ~F.col("end.end_inside") & F.col("stop").isNotNull() & (F.col("objects") == F.col("base") - 1)
    ends_well = F.regexp_like("frame", F.when(F.col("base") == 1, F.lit(rf"\]{BLANK}$")).otherwise(F.lit(rf"\}}{BLANK}$")))
    known = files.join(last, "file").join(closed, "file").join(whole, "file", "left")
    return known.select("file", F.when(balanced & ends_well, F.col("frame")).alias("frame"))


def must_hold(found: DataFrame) -> None:
    """An error that names documents whose frame is not an empty list, or an object with one under jobs."""
    v = F.try_parse_json("frame")
    lists = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, "$.jobs", "array<variant>"))
    bad = found.where(F.coalesce(F.size(lists) != 0, F.lit(True))).select("file").limit(5).collect()
    if bad:
        raise ValueError(f"{SHAPE}: {', '.join(r['file'] for r in bad)}")
