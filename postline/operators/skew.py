"""Joins and numbering that stay even when one key holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
BUCKET_ROWS = 1 << 20
#: Parts among which rows without a key are dealt.
BLANK_SALTS = 1 << 16


def attach(
    rows: DataFrame,
    side: DataFrame,
    keys: list[str],
    spread: Column,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    size: str | None = None,
) -> DataFrame:
    """Join many rows to a side that has at most one row per key.

    Keys with more than `hot_rows` rows are split over several tasks: their
    rows get a salt from `spread` (any expression that differs between rows)
    and the side's row is repeated once per salt. Finding them costs one
    aggregate over the key columns only, or nothing when `size` names the
    side's column that holds the rows per key. Rows without a key meet nothing, so
    they are dealt by `spread` alone, however many there are. The list of hot keys holds at
    most rows / hot_rows entries of 16 bytes; Spark decides how to join it.
    """
    mark = F.xxhash64(*keys)
    blank = F.lit(False)
    for key in keys:
        blank = blank | F.col(key).isNull()
    if size is None:
        counts = rows.groupBy(mark.alias("_mark")).agg(F.count_if(~blank).alias("_n"))
    else:
        counts = side.groupBy(mark.alias("_mark")).agg(F.max(size).alias("_n"))
    big = counts.where(F.col("_n") > hot_rows)
    hot = big.select("_mark", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    salted = rows.withColumn("_mark", F.when(blank, F.xxhash64(spread)).otherwise(mark)).join(hot, "_mark", "left")
    salts = F.when(blank, F.lit(BLANK_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salt = F.pmod(F.xxhash64(spread), salts).cast("int")
    salted = salted.withColumn("_salt", salt).drop("_salts", "_mark")
    copies = side.withColumn("_mark", mark).join(hot, "_mark", "left")
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_salts", "_mark")
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def number_within(
    df: DataFrame, key: str, seq: str = "seq", name: str = "rn", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """row_number over (partition by key order by seq), without one task per key.

    `seq` is a unique whole number, so the rows of one key in one range of
    `bucket_rows` numbers are at most that many. Each range is numbered on its
    own and shifted by the rows of the ranges before it.
    """
    df = df.withColumn("_bucket", F.floor(F.col(seq) / bucket_rows))
    sizes = df.groupBy(key, "_bucket").agg(F.count("*").alias("_size"))
    before = W.partitionBy(key).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(key, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return _number(df, offsets, key, seq, name)


def _number(df: DataFrame, offsets: DataFrame, key: str, seq: str, name: str) -> DataFrame:
    within = F.row_number().over(W.partitionBy(key, "_bucket").orderBy(seq))
    joined = df.join(offsets, [key, "_bucket"])
    return joined.withColumn(name, (within + F.col("_before")).cast("bigint")).drop("_bucket", "_before")


def slice_within(
    df: DataFrame, key: str, start: int, wanted: int | None, seq: str = "seq", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Rows `start` to `start + wanted` of each key by seq; all the rest when wanted is empty.

    Ranges that lie wholly outside the slice are dropped by their sizes,
    before any row is numbered or moved.
    """
    stop = None if wanted is None or wanted <= 0 else start + wanted
    df = df.withColumn("_bucket", F.floor(F.col(seq) / bucket_rows))
    sizes = df.groupBy(key, "_bucket").agg(F.count("*").alias("_size"))
    before = W.partitionBy(key).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    keep = F.col("_before") + F.col("_size") > start
    keep = keep if stop is None else keep & (F.col("_before") < stop)
    numbered = _number(df, offsets.where(keep).drop("_size"), key, seq, "_rn")
    inside = F.col("_rn") > start
    inside = inside if stop is None else inside & (F.col("_rn") <= stop)
    return numbered.where(inside).drop("_rn")


def budget(df: DataFrame, key: str, column: str, wanted: int, seq: str = "seq") -> DataFrame:
    """df with `column` kept in the first `wanted` rows of each key and null in the others.

    Only key and seq are numbered; the wide rows meet one cut per key.
    """
    last = slice_within(df.select(key, seq), key, wanted - 1, 1, seq)
    cuts = last.select(F.col(key).alias("_key"), F.col(seq).alias("_cut"))
    joined = df.join(cuts, F.col(key).eqNullSafe(F.col("_key")), "left")
    inside = F.col("_cut").isNull() | (F.col(seq) <= F.col("_cut"))
    return joined.withColumn(column, F.when(inside, F.col(column))).select(*df.columns)


def target_counts(df: DataFrame, key: str, offset: int, wanted: int | None) -> DataFrame:
    """Per key the rows a run goes for after its offset: at most `wanted`, and all that are left."""
    rest = F.greatest(F.count("*") - offset, F.lit(0))
    goal = rest if wanted is None or wanted <= 0 else F.least(rest, F.lit(wanted))
    return df.groupBy(key).agg(goal.alias("wanted"), rest.alias("all_rest"))
