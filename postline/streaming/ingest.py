"""Micro-batch ingest into a versioned postings folder that is laid out by link.

A version holds only the rows its batch touched, so an hourly batch writes
about as much as it brings, not the whole table. Rows lie in buckets by the hash
of their link, and beside them a slim index by the hash of the identity says in
which bucket a row with that identity lies. The buckets of a batch's links and
those its identities point to are all that it reads: a list of at most as many
numbers as there are buckets, which becomes the paths of the scan.

Rows that were merged into others, and those that moved to another link, are
written as gone where they were. So within a bucket the newest version of an id
tells whether it is there. `compact_buckets` rewrites the buckets that many
versions have touched, `compact` all of them into a new folder. A version counts
once its layout is written, as the last step; a batch reads versions below its
own and overwrites its own, so a batch that is run again gives the same rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from postline.operators.merge import default_dates, touched_rows, upsert_postings
from postline.session import cut_lineage

GONE = "_gone"
BUCKET = "_bucket"
#: Buckets of a new store. A batch reads as many as it has links at most, so a store should have many more.
BUCKETS = 64
LAYOUT = "version int, buckets int, columns string, versions array<int>, bases map<int,int>"


@dataclass(frozen=True)
class Layout:
    """What a store is like up to a version: its buckets, columns, versions, and where compacted buckets begin."""

    version: int
    buckets: int
    columns: StructType
    versions: tuple[int, ...]
    bases: dict[int, int]


def if_written(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What read gives, or nothing where no such folder has been written; other errors stay errors."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_layout(spark: SparkSession, store: str, below: int | None = None) -> Layout | None:
    """The layout of the newest version, or of the newest one below a number; none if there is none."""
    found = if_written(lambda: spark.read.schema(LAYOUT).parquet(f"{store}/_layout/at=*"))
    if found is None:
        return None
    if below is not None:
        found = found.where(F.col("version") < below)
    row = found.orderBy(F.desc("version")).first()
    if row is None:
        return None
    columns = StructType.fromJson(json.loads(row["columns"]))
    return Layout(row["version"], row["buckets"], columns, tuple(row["versions"]), dict(row["bases"]))


def write_layout(spark: SparkSession, store: str, layout: Layout) -> None:
    row = (layout.version, layout.buckets, layout.columns.json(), list(layout.versions), layout.bases)
    spark.createDataFrame([row], LAYOUT).coalesce(1).write.mode("overwrite").parquet(f"{store}/_layout/at={layout.version}")


def link_bucket(buckets: int, link: str = "job_url") -> Column:
    return F.pmod(F.xxhash64(link), F.lit(buckets)).cast("int")


def identity_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("source", "external_id"), F.lit(buckets)).cast("int")


def in_buckets(rows: DataFrame, bucket: Column, path: str) -> None:
    """Write rows in folders by bucket; Spark splits large buckets and joins small ones on measured sizes."""
    placed = rows.withColumn(BUCKET, bucket)
    placed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def with_identity(rows: DataFrame) -> DataFrame:
    return rows.where(F.trim("external_id") != "")


def write_version(
    rows: DataFrame, store: str, version: int, buckets: int | None = None, bases: Iterable[int] = ()
) -> None:
    """Rows as one version: in buckets by link, their identities in buckets of their own, then the layout.

    `bases` names buckets of which this version holds all rows, so that older
    versions of them need no reading. Only the first version of a store can
    choose the number of buckets.
    """
    spark = rows.sparkSession
    last = read_layout(spark, store, version)
    buckets = last.buckets if last else buckets or BUCKETS
    rows = rows if GONE in rows.columns else rows.withColumn(GONE, F.lit(False))
    path = f"{store}/version={version}"
    in_buckets(rows, link_bucket(buckets), path)
    # from what was written, so that the rows are made once
    written = spark.read.schema(rows.schema).parquet(path)
    entries = with_identity(written.where(~F.col(GONE))).select("source", "external_id", link_bucket(buckets).alias("lies_in")).distinct()
    in_buckets(entries, identity_bucket(buckets), f"{store}/_identities/version={version}")
    columns = StructType(list(last.columns.fields) if last else [])
    for field in rows.schema:
        if field.name not in columns.names:
            columns.add(field.name, field.dataType)
    versions = (*(last.versions if last else ()), version)
    begins = (last.bases if last else {}) | dict.fromkeys(bases, version)
    write_layout(spark, store, Layout(version, buckets, columns, versions, begins))


def read_buckets(spark: SparkSession, store: str, layout: Layout, buckets: Iterable[int] | None = None) -> DataFrame:
    """Rows of all versions in the buckets given, or in all, with `version` and the bucket.

    Buckets become paths, so that no other folder is listed or read. Versions
    that a compacted bucket no longer needs are left out by partition.
    """
    schema = StructType(list(layout.columns.fields)).add("version", "integer").add(BUCKET, "integer")
    wanted = "*" if buckets is None else "{" + ",".join(map(str, sorted(buckets))) + "}"
    rows = if_written(lambda: spark.read.schema(schema).option("basePath", store).parquet(f"{store}/version=*/{BUCKET}={wanted}"))
    if rows is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.col("version").isin(*layout.versions))
    of_base: dict[int, list[int]] = {}
    for bucket, base in layout.bases.items():
        of_base.setdefault(base, []).append(bucket)
    for base, members in of_base.items():
        rows = rows.where(~F.col(BUCKET).isin(members) | (F.col("version") >= base))
    return rows


def all_versions(spark: SparkSession, store: str) -> DataFrame:
    """Rows of every version with `version`; columns that came late are null before."""
    layout = read_layout(spark, store)
    if layout is None:
        raise ValueError(f"{store} holds no version")
    return read_buckets(spark, store, layout)


def newest(rows: DataFrame) -> DataFrame:
    """The newest version of each id of a bucket, without those that are gone from it."""
    columns = [c for c in rows.columns if c not in ("version", BUCKET)]
    picked = F.max_by(F.struct(*columns), F.struct("version", ~F.col(GONE))).alias("_row")
    found = rows.groupBy(BUCKET, "id").agg(picked).select("_row.*")
    return found.where(~F.col(GONE)).drop(GONE)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    return newest(all_versions(spark, store))


def buckets_of_batch(spark: SparkSession, store: str, layout: Layout, staged: DataFrame) -> set[int]:
    """Buckets in which rows with the batch's links or identities can lie: at most as many numbers as there are buckets."""
    found = staged.select(link_bucket(layout.buckets).alias("b"))
    own = with_identity(staged).select("source", "external_id").distinct()
    parts = {r["b"] for r in own.select(identity_bucket(layout.buckets).alias("b")).distinct().collect()}
    if parts:
        path = f"{store}/_identities/version=*/{BUCKET}={{{','.join(map(str, sorted(parts)))}}}"
        schema = StructType([layout.columns[c] for c in ("source", "external_id")]).add("lies_in", "integer").add("version", "integer").add(BUCKET, "integer")
        entries = if_written(lambda: spark.read.schema(schema).option("basePath", f"{store}/_identities").parquet(path))
        if entries is not None:
            entries = entries.where(F.col("version").isin(*layout.versions))
            found = found.union(entries.join(own, ["source", "external_id"], "left_semi").select("lies_in"))
    return {r["b"] for r in found.distinct().collect()}


def rows_in_reach(spark: SparkSession, store: str, layout: Layout, staged: DataFrame) -> DataFrame:
    """All stored versions in the buckets of a batch."""
    return read_buckets(spark, store, layout, buckets_of_batch(spark, store, layout, staged))


def rows_of_batch(spark: SparkSession, store: str, staged: DataFrame, version: int) -> DataFrame:
    """Stored rows a batch can touch, as they were before it.

    Any version of a row can show that; what counts is its newest.
    """
    layout = read_layout(spark, store, version)
    if layout is None:
        raise ValueError(f"{store} holds no version below {version}")
    before = rows_in_reach(spark, store, layout, staged)
    ids = cut_lineage(touched_rows(before, staged).select(BUCKET, "id").distinct())
    return cut_lineage(touched_rows(newest(before.join(ids, [BUCKET, "id"], "left_semi")), staged))


def apply_batch(
    spark: SparkSession, store: str, staged: DataFrame, version: int, run_ts: str, next_id: int, **options: object
) -> None:
    """The whole upsert of one folded batch, written as one new version."""
    staged = cut_lineage(default_dates(staged, run_ts))
    current = rows_of_batch(spark, store, staged, version)
    done = upsert_postings(current, staged, run_ts, next_id, **options)
    losers = done.mapping.select(F.col("loser_id").alias("id"))
    moved = current.select("id", "job_url").join(done.touched.select("id", F.col("job_url").alias("_link")), "id")
    left = losers.union(moved.where(~F.col("job_url").eqNullSafe(F.col("_link"))).select("id")).distinct()
    gone = current.join(left, "id", "left_semi").withColumn(GONE, F.lit(True))
    write_version(done.touched.withColumn(GONE, F.lit(False)).unionByName(gone, allowMissingColumns=True), store, version)


def compact(spark: SparkSession, store: str, target: str, version: int, buckets: int | None = None) -> None:
    """The newest rows as the first version of a new folder, with as many buckets unless told otherwise."""
    layout = read_layout(spark, store)
    write_version(read_store(spark, store), target, version, buckets or (layout and layout.buckets))


def compact_buckets(spark: SparkSession, store: str, version: int, most: int = 24) -> list[int]:
    """Rewrite the buckets that lie in more than `most` versions as one version; gives their numbers.

    Other buckets are not read. Folders of older versions of these buckets are
    no longer listed in a reader's rows and can be deleted once no batch below
    `version` will be run again. The index only grows; entries that no longer
    hold point to a bucket that is read in vain.
    """
    layout = read_layout(spark, store, version)
    if layout is None:
        return []
    used = read_buckets(spark, store, layout).groupBy(BUCKET).agg(F.count_distinct("version").alias("n"))
    worn = sorted(r[BUCKET] for r in used.where(F.col("n") > most).collect())
    if worn:
        rows = newest(read_buckets(spark, store, layout, worn))
        write_version(rows, store, version, bases=worn)
    return worn


def base_version(spark: SparkSession, store: str, checkpoint: str) -> int:
    """The version of a run's first batch: one above all that the store holds when the run first starts.

    It is written down beside the versions under the run's checkpoint, so a
    restart goes on with it and a run with a new checkpoint never overwrites.
    """
    marker = f"{store}/_runs/{hashlib.md5(checkpoint.encode()).hexdigest()}"
    known = if_written(lambda: spark.read.schema("base int").json(marker))
    if known is not None:
        return known.first()["base"]
    last = read_layout(spark, store)
    base = (last.version if last else -1) + 1
    spark.createDataFrame([(base,)], "base int").coalesce(1).write.json(marker)
    return base


def ingest(
    landing: DataFrame,
    store: str,
    checkpoint: str,
    stage: Callable[[DataFrame], DataFrame],
    run_ts: str,
    first_id: int = 1_000_000_000,
    **options: object,
) -> StreamingQuery:
    """Run the landed stream to its end. `stage` turns landed rows into a folded batch.

    New rows get first_id + seq; seq is unique over all landed rows, so ids are.
    """
    base = base_version(landing.sparkSession, store, checkpoint)

    def one(batch: DataFrame, epoch: int) -> None:
        apply_batch(batch.sparkSession, store, stage(batch), base + epoch, run_ts, first_id, **options)

    return (
        landing.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedupe_stream(df: DataFrame, moment: str, keys: list[str], delay: str = "24 hours") -> DataFrame:
    """First delivery of each key within the lookback; state older than it is dropped."""
    return df.withWatermark(moment, delay).dropDuplicatesWithinWatermark(keys)


def run_to_folder(df: DataFrame, target: str, checkpoint: str) -> None:
    """Write a stream that is finite now to a parquet folder."""
    query = (
        df.writeStream.format("parquet").outputMode("append").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
