"""Order-dependent folds and dedup. Every first and last is decided by `seq`.

All are aggregates, so copies meet on the map side before the shuffle and a
link with very many copies never lands in one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.payload import empty_payload
from postline.functions.text import clean_text, meaningful


def merge_payloads(rows: DataFrame, keys: list[str], payload: str, order: Column, last: bool = True) -> DataFrame:
    """One payload per group: per payload key the value of the last (or first) row in order.

    Works key by key, so no group is ever collected; the list built at the end
    holds one entry per payload key.
    """
    pick = F.max_by if last else F.min_by
    entries = rows.select(*keys, order.alias("_order"), F.explode(payload).alias("_k", "_v"))
    per_key = entries.groupBy(*keys, "_k").agg(pick("_v", "_order").alias("_v"))
    pairs = F.map_from_entries(F.collect_list(F.struct("_k", "_v")))
    return per_key.groupBy(*keys).agg(pairs.alias(payload))


def fold_inputs(
    records: DataFrame, key: str = "job_url", seq: str = "seq", payload: str = "raw_json", uniform_keys: bool = False
) -> DataFrame:
    """One record per link: later meaningful values win, the first position stays.

    Payloads merge per key, later rows win. With uniform_keys (every row has
    the same payload keys, as rows of one frame do) that is the last payload.
    Adds `copies`, the number of rows folded.
    """
    kinds = dict(records.dtypes)
    at = F.col(seq)
    values = [c for c in records.columns if c not in (key, seq, payload)]
    merged = [
        F.max_by(c, F.when(meaningful(F.col(c), kinds[c]), at)).alias(c) for c in values
    ]
    whole = [F.max_by(payload, at).alias(payload)] if uniform_keys and payload in kinds else []
    folded = records.groupBy(key).agg(F.min(seq).alias(seq), F.count("*").alias("copies"), *merged, *whole)
    if payload in kinds and not uniform_keys:
        payloads = merge_payloads(records, [key], payload, at)
        folded = folded.join(payloads, key, "left")
        folded = folded.withColumn(payload, F.coalesce(payload, empty_payload()))
    return folded.select(*records.columns, "copies")


def _keep(df: DataFrame, keys: list[Column], pick, order: Column) -> DataFrame:
    whole = pick(F.struct(*df.columns), order).alias("_row")
    return df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).agg(whole).select("_row.*")


def first_seen(df: DataFrame, *keys: str, seq: str = "seq") -> DataFrame:
    """The first row of each key; rows without a key all stay."""
    blank = F.when(F.concat_ws("", *[F.col(k).cast("string") for k in keys]) == "", F.col(seq))
    return _keep(df, [*[F.col(k) for k in keys], blank], F.min_by, F.col(seq))


def last_seen(df: DataFrame, *keys: str, seq: str = "seq") -> DataFrame:
    return _keep(df, [F.col(k) for k in keys], F.max_by, F.col(seq))


def latest(df: DataFrame, *keys: str) -> DataFrame:
    """Newest stored row of each key: updated, then fetched, then id; null dates lose."""
    order = F.struct("updated_at", "fetched_at", "id")
    return _keep(df, [F.col(k) for k in keys], F.max_by, order)


def dedupe_key(seq: str = "seq") -> Column:
    """First non-blank of link, id and apply link, else a key of the row's own."""
    return F.coalesce(
        clean_text(F.col("job_url")),
        clean_text(F.col("id")),
        clean_text(F.col("apply_url")),
        F.concat(F.lit("row-"), F.col(seq)),
    )


def dedupe(df: DataFrame, seq: str = "seq") -> DataFrame:
    return _keep(df, [dedupe_key(seq)], F.min_by, F.col(seq))


def dedupe_summary(df: DataFrame, seq: str = "seq") -> DataFrame:
    """raw_rows, unique_rows, duplicates_removed; counted per key first."""
    per_key = df.groupBy(dedupe_key(seq).alias("_k")).agg(F.count("*").alias("n"))
    raw = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        raw.alias("raw_rows"), F.count("*").alias("unique_rows"), (raw - F.count("*")).alias("duplicates_removed")
    )


def fold_company_links(df: DataFrame, key: str = "base_url", seq: str = "seq") -> DataFrame:
    """One row per base URL: the longest name wins (first on a tie); the source
    link is the last one seen with that name."""
    per_name = df.groupBy(key, "company_name").agg(
        F.max_by("source_job_url", seq).alias("source_job_url"),
        F.min(seq).alias("_first"),
        F.count("*").alias("_n"),
    )
    order = F.struct(F.coalesce(F.length("company_name"), F.lit(-1)), -F.col("_first"))
    best = F.max_by(F.struct("company_name", "source_job_url"), order)
    folded = per_name.groupBy(key).agg(best.alias("_best"), F.sum("_n").alias("copies"))
    return folded.select(key, "_best.*", "copies")


def ordered_links(df: DataFrame, owner: str, link: str, seq: str = "seq") -> DataFrame:
    """Distinct links per owner with the place they were first seen at."""
    return df.groupBy(owner, link).agg(F.min(seq).alias("first_seen"))


def insert_missing(current: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows to append, and all rows after appending. Rows already there stay as they are."""
    known = current.select(key).join(new.select(key), key, "left_semi")
    added = new.join(known, key, "left_anti")
    return added, current.unionByName(added, allowMissingColumns=True)


def duplicate_groups(df: DataFrame, key: str = "job_url") -> DataFrame:
    """Keys that more than one row carries."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
