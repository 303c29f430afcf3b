"""Mixing sources to target weights, with DataFrame functions only.

Documents get hash-random keys. The keys' leading digits cut every source into
ranges, ranges are summed and prefix-summed, and only the range in which a
source's budget ends is sorted. What is left of the budget after whole epochs
goes to the documents with the smallest keys, the one at the cut in part.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null
source is a source of its own, last in order; a source without words has target
0; rows that agree in id and text share one key and split what falls to them
evenly, rounded down; an empty table gives an empty result. Other columns, of
whatever name, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postline.llm.common import WORD, stage

WEIGHTS = (1.0, 2.0, 3.0)
MOST_EPOCHS = 3
#: Hex digits of a key that name its range: 4096 ranges a source.
RANGE_DIGITS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: str) -> Column:
    """Hash-random, the same in every run: of the seed, the id and the text."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text).cast("binary"))


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, source, key and size of every row; texts are not carried along."""
    return docs.select("doc_id", "source", random_key(seed).alias("key"), word_count().alias("size"))


def targets(slim: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target: shares by weight, none above `most` times its source.

    Sources that reach their limit are those with the smallest ratio of limit
    to weight; with the sources in that order one pass of running sums tells
    where the limits end and what the rest share.
    """
    sources = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1)
    limit = (F.col("source_size") * most).cast("double")
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    held = (
        ranked.withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("level", level)
        .withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    )
    first_free = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), F.col("rank"), F.col("level")))).over(whole)
    return held.withColumn("shared", first_free["level"]).select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("limit")).otherwise(F.col("shared") * F.col("weight")).alias("target"),
    )


def cuts(slim: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: target, whole epochs, and the key at which the rest of the budget ends."""
    goal = targets(slim, weights, most).select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).alias("epochs"),
    )
    goal = goal.withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size"))
    slices = slim.groupBy("source", F.substring("key", 1, RANGE_DIGITS).alias("slice")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    here = (
        slices.join(goal, F.col("source").eqNullSafe(F.col("of")))
        .where("before < rest and rest <= before + words")
        .select("of", F.col("slice").alias("at"), "before", "rest")
    )
    rows = slim.join(here, F.col("source").eqNullSafe(F.col("of")) & (F.substring("key", 1, RANGE_DIGITS) == F.col("at")))
    keys = rows.groupBy("of", "at", "key").agg(
        F.sum("size").alias("words"), F.count("*").alias("copies"), F.first("before").alias("base"), F.first("rest").alias("rest")
    )
    within = Window.partitionBy("of", "at").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    keys = keys.withColumn("start", F.col("base") + F.coalesce(F.sum("words").over(within), F.lit(0)))
    ends = keys.where("start < rest and rest <= start + words").select(
        F.col("of").alias("cut_of"),
        F.col("key").alias("cut_key"),
        F.floor((F.col("rest") - F.col("start")) / F.col("copies")).alias("cut_words"),
    )
    return goal.join(ends, F.col("of").eqNullSafe(F.col("cut_of")), "left").drop("cut_of")


def mix(slim: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """slim with source_size, target, epochs (whole times taken), part (words of one more time) and taken."""
    part = (
        F.when(F.col("cut_key").isNull(), F.lit(0))
        .when(F.col("key") < F.col("cut_key"), F.col("size"))
        .when(F.col("key") == F.col("cut_key"), F.col("cut_words"))
        .otherwise(F.lit(0))
    )
    plan = stage(cuts(slim, weights, most))
    return (
        slim.join(plan, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("part", part.cast("long"))
        .withColumn("taken", (F.col("epochs") * F.col("size") + F.col("part")).cast("long"))
        .drop("of", "rest", "cut_key", "cut_words")
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = "mix") -> DataFrame:
    """The documents of the mix, with the columns of docs.

    A document is repeated once per epoch; the one at its source's cut adds its
    first words, as text up to the end of the last word taken. Documents that
    the mix does not take are left out, so no row has a null or empty text.
    """
    keep = docs.columns
    plan = stage(cuts(stage(sized(docs, seed)), weights, most)).select(
        F.col("of").alias("__of"), "epochs", F.col("cut_key").alias("__key"), F.col("cut_words").alias("__words")
    ).withColumnRenamed("epochs", "__epochs")
    rows = docs.withColumn("__at", random_key(seed)).withColumn("__size", word_count())
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("__of"))).where("__size > 0")
    part = F.when(F.col("__at") < F.col("__key"), F.col("__size")).when(F.col("__at") == F.col("__key"), F.col("__words")).otherwise(0)
    rows = rows.withColumn("__part", F.coalesce(part, F.lit(0)).cast("int")).withColumn(
        "__takes", F.concat(F.array_repeat(F.col("__size").cast("int"), F.col("__epochs").cast("int")), F.array("__part"))
    )
    rows = rows.withColumn("__take", F.explode("__takes")).where("__take > 0")
    cut = F.when(F.col("__take") >= F.col("__size"), F.col("text")).otherwise(first_words(F.col("text"), F.col("__take")))
    rows = rows.withColumn("text", cut)
    if "n_chars" in keep:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*keep)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n), "")


#: The same rows from DuckDB: running sums over whole sources instead of ranges and cuts.
SQL = """
WITH rows AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
        md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS k
    FROM documents
), ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r
    FROM rows GROUP BY source
), weighed AS (
    SELECT *, ([1.0, 2.0, 3.0]::DOUBLE[])[((r - 1) % 3 + 1)::INT] AS weight, (3 * source_size)::DOUBLE AS most FROM ranked
), levelled AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, r
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY most / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), shared AS (
    SELECT *, arg_min(level, (most / weight, r)) FILTER (most > level * weight) OVER () AS free_level FROM levelled
), goals AS (
    SELECT source, source_size, CASE WHEN most <= level * weight THEN most ELSE free_level * weight END AS target FROM shared
), running AS (
    SELECT rows.*, goals.source_size, goals.target,
        coalesce(sum(size) OVER (PARTITION BY rows.source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
            - sum(size) OVER (PARTITION BY rows.source, k) AS start,
        count(*) OVER (PARTITION BY rows.source, k) AS copies
    FROM rows JOIN goals ON rows.source IS NOT DISTINCT FROM goals.source
), budget AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM running
), spent AS (
    SELECT *, floor(target) - epochs * source_size AS rest FROM budget
)
SELECT doc_id, size, source_size, target,
    (epochs * size + floor(greatest(0, least(size * copies, rest - start)) / copies))::BIGINT AS taken
FROM spent
"""
