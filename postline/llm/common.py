"""Shared pieces of the corpus operators: row identity, staging, splitting of texts.

Rows are told apart by (doc_id, hash of the text), so that null and repeated
ids are handled: rows that agree in both are the same document seen twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.session import checkpoint_dir

#: Texts that go to a Python worker at once.
TEXTS_AT_ONCE = 1000
#: Fixed value: what separates words, in Java's and RE2's notation.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends, sizes are known."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def by_sorting(df: DataFrame) -> DataFrame:
    """df, to be joined by sorting both sides and never sent through the driver.

    Spark takes the size of a side from that of its files, which is far too low
    after an explode, or where values that repeat are written once.
    """
    return df.hint("merge")


def forget_shuffles(spark: SparkSession) -> None:
    """Let the driver collect garbage, upon which Spark deletes the shuffle files of jobs that have ended.

    Spark does so only when the driver's memory fills up, or every half hour.
    What a staged table was made from is not needed once it is written.
    """
    spark.sparkContext._jvm.System.gc()


def in_batches(spark: SparkSession, rows: int) -> None:
    """Rows that go to a Python worker at once, from now on in this session.

    Spark's own number, 10,000, is made for narrow rows; of whole texts it is
    tens of megabytes in the JVM, in Arrow and in Python each.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def ship(spark: SparkSession, model: object) -> Broadcast:
    """Broadcast a model of bounded size, its classes by value, so that workers need no install."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def unpacked(shipped: Broadcast):
    return cloudpickle.loads(shipped.value)


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text modulo n; a null id counts as an empty text, which gives 0."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(n))


def text_key(text: str = "text") -> Column:
    """64-bit hash of the text, null as empty."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts, null as empty."""
    return [t if t is not None else "" for t in batch.column(name).to_pylist()]


def in_bulk(texts: Iterable[str], limit: int) -> Iterator[list[tuple[int, str, bool]]]:
    """Runs of (row, piece, goes_on) with about `limit` characters in each.

    Texts above the limit come in several pieces, so that memory is bounded by
    the limit and not by the longest text; goes_on marks all but the first.
    """
    run: list[tuple[int, str, bool]] = []
    size = 0
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text)), limit):
            piece = text[start : start + limit] if len(text) > limit else text
            run.append((row, piece, start > 0))
            size += len(piece)
            if size >= limit:
                yield run
                run, size = [], 0
    if run:
        yield run


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (finaliser with two multiplications)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word, the same on every machine."""
    import xxhash

    known: dict[bytes, int] = {}
    digest = xxhash.xxh3_64_intdigest
    out = np.empty(len(words), dtype=np.uint64)
    get = known.get
    for i, w in enumerate(words):
        h = get(w)
        if h is None:
            h = known[w] = digest(w)
        out[i] = h
    return out


def to_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
