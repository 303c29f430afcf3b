"""Tick counts of a stream: state per source and a timer per tick.

A row is counted for the tick that collects it, by the same rule as in tables.
A tick closes when the watermark (latest moment seen less the delay) has passed
it: its timer fires, the count is given out once and its state ends. Rows of
ticks that have closed are counted apart as late; they never change a count that
is out. Rows of one source are dealt over several shards, so that a source with
a third of all rows is no task of its own; all shards of a tick close in the
same batch, and the writer adds them up there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from postline.streaming.ticks import ZONE, ticked

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHARDS = 16
COUNTED = "source string, hours int, shard int, tick_ms long, n long, late boolean"


class TickCounts(StatefulProcessor):
    """Per (source, hours, shard): the counts of open ticks and a timer for each."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "tick_ms long", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        closed_below = timerValues.getCurrentWatermarkInMs()
        total: dict[int, int] = {}
        for batch in rows:
            for tick, n in batch["tick_ms"].value_counts().items():
                total[int(tick)] = total.get(int(tick), 0) + int(n)
        late = {tick: n for tick, n in total.items() if tick < closed_below}
        for tick in total.keys() - late.keys():
            known = self.counts.containsKey((tick,))
            if not known:
                self.handle.registerTimer(tick)
            self.counts.updateValue((tick,), (total[tick] + (self.counts.getValue((tick,))[0] if known else 0),))
        if late:
            yield counted(key, late, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        tick = expiredTimerInfo.getExpiryTimeInMs()
        n = self.counts.getValue((tick,))[0]
        self.counts.removeKey((tick,))
        yield counted(key, {tick: n}, False)

    def close(self) -> None:
        pass


def counted(key: tuple, counts: dict[int, int], late: bool) -> pd.DataFrame:
    rows = [(*key, tick, n, late) for tick, n in sorted(counts.items())]
    return pd.DataFrame(rows, columns=["source", "hours", "shard", "tick_ms", "n", "late"])


def count_stream(
    df: DataFrame, moment: str, source: str, slow: list[str], zone: str = ZONE, delay: str = "1 hour", shards: int = SHARDS
) -> DataFrame:
    """tick (local), source, hours, late, n and shard: partial counts of a stream, to be added up per batch.

    The watermark stays on a column that goes no further, so that late rows
    reach the processor and are counted there instead of being dropped.
    """
    clocked = df.select(moment, source).withWatermark(moment, delay)
    shard = F.pmod(F.xxhash64(F.unix_micros(moment), source), F.lit(shards)).cast("int").alias("shard")
    rows = ticked(clocked.select(moment, F.col(source).alias("source"), shard), moment, "source", slow, zone, "shard")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    instant = F.timestamp_diff("MILLISECOND", epoch, F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col("tick")))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.timestamp_add("MILLISECOND", F.col("tick_ms"), epoch))
    partial = (
        rows.select("source", F.col("hours").cast("int").alias("hours"), "shard", instant.alias("tick_ms"))
        .groupBy("source", "hours", "shard")
        .transformWithStateInPandas(TickCounts(), COUNTED, "Append", "EventTime")
    )
    return partial.select(local.alias("tick"), F.col("source").alias(source), "hours", "late", "n", "shard")


def write_counts(counts: DataFrame, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Run the stream to its end; each batch's ticks become one folder, which a rerun of the batch overwrites."""
    spark = counts.sparkSession

    def one(batch: DataFrame, epoch: int) -> None:
        whole = batch.groupBy("tick", source, "hours", "late").agg(F.sum("n").alias("n"))
        whole.write.mode("overwrite").parquet(f"{target}/batch={epoch}")

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # timers need it; a query keeps what it was started with
    try:
        query = counts.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before)
    return query


def read_counts(df: DataFrame, source: str) -> DataFrame:
    """Written counts: one row per closed tick and source; late rows added up over the batches they came in."""
    return df.groupBy("tick", source, "hours", "late").agg(F.sum("n").alias("n"))
