"""Queries over streams and ticks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.operators import folding
from postline.plans.derive import derived_from, oracle
from postline.plans.folding import with_payload
from postline.plans.merging import BASE, RUN_TS, STAGED, batch_ctes, show, shown, unique
from postline.plans.registry import query, table
from postline.session import checkpoint_dir
from postline.streaming import ingest, tick_state, ticks

C = F.col


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def landed(spark: SparkSession, parts: list[DataFrame], name: str) -> DataFrame:
    """A stream that brings each part as one micro-batch, in their order."""
    folder = scratch(spark, name)
    for i, rows in enumerate(parts):
        rows.coalesce(1).write.parquet(f"{folder}/part={i}")
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")


PARTS = 3
#: Rows of a landed file: a batch is mapped by no more tasks than it has files.
LANDED_ROWS = 100_000


def _chain() -> str:
    """CTEs of one whole batch after the other."""
    parts = [f"base AS ({BASE})"]
    rows = "base"
    for i in range(PARTS):
        own = STAGED.replace("FROM batch", f"FROM (SELECT * FROM batch WHERE seq % {PARTS} = {i}) AS b")
        parts += [f"s{i} AS ({own})", batch_ctes(rows, f"s{i}", f"_{i}", 1_000_000_000)]
        rows = f"after_{i}"
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + shown(rows)


def landed_parts(spark: SparkSession, sf_dir: str, rows_each: int) -> list[DataFrame]:
    """The orders in parts that land one after another, each in files of about so many rows."""
    orders = table(spark, sf_dir, "orders")
    parts = [orders.where(C("o_orderkey") % PARTS == i) for i in range(PARTS)]
    return [rows.repartition(max(1, -(-rows.count() // rows_each))) for rows in parts]


def ingested(spark: SparkSession, sf_dir: str) -> str:
    """A store of the stored rows and three batches after one another.

    Each part lands in files that many tasks can read, and a run takes all that
    has landed since the last one as its batch.
    """
    store = scratch(spark, "store")
    ingest.write_version(unique(spark, sf_dir), store, 0, buckets=16)
    stage = lambda rows: folding.fold_inputs(with_payload(derived_from(rows, "batch")))
    landing, checkpoint = scratch(spark, "landing"), scratch(spark, "ingest")
    for i, rows in enumerate(landed_parts(spark, sf_dir, LANDED_ROWS)):
        rows.write.parquet(f"{landing}/part={i}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{landing}/part=*")
        ingest.ingest(stream, store, checkpoint, stage, RUN_TS).awaitTermination()
    return store


@query("stm_01_incremental_ingest", "STM-01 MRG-01", oracle(_chain(), "batch", "stored"))
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(ingest.read_store(spark, ingested(spark, sf_dir)))


@query("stm_01_compacted_store", "STM-01 MRG-01", oracle(_chain(), "batch", "stored"))
def compacted_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows after the buckets that several batches touched have been rewritten, read from a copy with other buckets."""
    store, copy = ingested(spark, sf_dir), scratch(spark, "copy")
    ingest.compact_buckets(spark, store, PARTS + 1, most=2)
    ingest.compact(spark, store, copy, 0, buckets=5)
    return show(ingest.read_store(spark, copy))


@query(
    "stm_02_cross_batch_dedup",
    "STM-02",
    """SELECT user_id, event_type, day FROM (SELECT DISTINCT user_id, event_type FROM events) AS e, (VALUES ('2024-01-01'), ('2024-01-11')) AS d(day)
    UNION ALL SELECT -i, 'clock', '2024-01-11' FROM (VALUES (1), (2)) AS c(i)""",
)
def cross_batch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event comes again an hour later, within the delay, and ten days later, beyond it.

    Two batches in between only move the clock, so that the state has expired.
    """
    start = F.lit("2024-01-01 10:00:00").cast("timestamp")
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.timestamp_add("SECOND", (C("event_id") % 3600).cast("int"), start).alias("ts")
    )
    later = lambda hours: events.withColumn("ts", F.timestamp_add("HOUR", F.lit(hours), C("ts")))
    clock = lambda i: spark.range(1).select(
        F.lit(-i).cast("bigint").alias("user_id"), F.lit("clock").alias("event_type"), F.timestamp_add("HOUR", F.lit(240), start).alias("ts")
    )
    stream = landed(spark, [events, later(1), clock(1), clock(2), later(240)], "deliveries")
    target = scratch(spark, "dedup")
    once = ingest.dedupe_stream(stream, "ts", ["user_id", "event_type"])
    ingest.run_to_folder(once, target, scratch(spark, "dedup-state"))
    return spark.read.parquet(target).select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))


# The tick that collects an event: by the list of ticks of its day and the next, in local time.
TICKS_SQL = """
WITH e AS (SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_type END AS event_type, ts::TIMESTAMP AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Jerusalem' AS t FROM events),
h AS (SELECT *, CASE WHEN event_type IN ('error', 'signup') THEN 3 ELSE 1 END AS hours FROM e),
ticks AS (SELECT DISTINCT t::DATE + d * INTERVAL 1 DAY + INTERVAL 450 MINUTE + i * INTERVAL 1 HOUR AS tick, i % 3 = 0 AS slow
  FROM h, range(0, 2) AS days(d), range(0, 16) AS hour(i)),
found AS (SELECT h.event_type, h.hours, (SELECT min(tick) FROM ticks WHERE tick >= h.t AND (slow OR h.hours = 1) AND tick < h.t + INTERVAL 2 DAY) AS tick FROM h)
SELECT strftime(tick, '%Y-%m-%d %H:%M') AS tick, event_type, hours::INT AS hours, count(*) AS n FROM found GROUP BY 1, 2, 3"""


@query("stm_03_tick_coverage", "STM-03 AGG-03", TICKS_SQL)
def tick_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(C("event_id") % 50 > 0, C("event_type")).alias("event_type")
    counted = ticks.coverage(table(spark, sf_dir, "events").select(C("ts").cast("timestamp").alias("ts"), kind), "ts", "event_type", ["error", "signup"])
    return counted.withColumn("tick", F.date_format("tick", "yyyy-MM-dd HH:mm"))


LATE_SQL = TICKS_SQL.replace("FROM events)", "FROM events WHERE event_id % 97 = 0)", 1)


@query(
    "stm_03_tick_stream",
    "STM-03 AGG-03",
    f"SELECT *, false AS late FROM ({TICKS_SQL}) AS c UNION ALL SELECT *, true FROM ({LATE_SQL}) AS l",
)
def tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events come in two halves, two rows move the clock on, then some events come once more, after all ticks have closed."""
    kind = F.when(C("event_id") % 50 > 0, C("event_type")).alias("event_type")
    events = table(spark, sf_dir, "events").select("event_id", C("ts").cast("timestamp").alias("ts"), kind)
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    half = F.lit(first + (last - first) / 2)
    clock = lambda days: spark.range(1).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.date_add(F.lit(last), days).cast("timestamp").alias("ts"), F.lit("clock").alias("event_type")
    )
    parts = [events.where(C("ts") < half), events.where(C("ts") >= half), clock(5), clock(6), events.where("event_id % 97 = 0")]
    counts = tick_state.count_stream(landed(spark, parts, "ticks"), "ts", "event_type", ["error", "signup"], shards=2)
    target = scratch(spark, "tick-counts")
    tick_state.write_counts(counts, "event_type", target, scratch(spark, "tick-state")).awaitTermination()
    whole = tick_state.read_counts(spark.read.parquet(target), "event_type")
    return whole.where("event_type is null or event_type <> 'clock'").withColumn("tick", F.date_format("tick", "yyyy-MM-dd HH:mm"))


@query(
    "stm_03_tick_rules",
    "STM-01 STM-03 FLT-06",
    """SELECT lookback, slow, count(*) AS n FROM (SELECT CASE WHEN hour(ts) = 7 AND minute(ts) = 30 THEN 1440 ELSE 60 END AS lookback,
    minute(ts) = 30 AND hour(ts) IN (7, 10, 13, 16, 19, 22) AS slow FROM events) AS e GROUP BY 1, 2""",
)
def tick_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    rules = df.select(ticks.lookback_minutes(C("ts")).alias("lookback"), ticks.is_slow_tick(C("ts")).alias("slow"))
    return rules.groupBy("lookback", "slow").agg(F.count("*").alias("n"))
