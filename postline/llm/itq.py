"""Near-duplicate vectors by iterative quantisation, multi-index Hamming tables and exact cosine.

The codes: vectors of unit length, turned to their principal axes, and rotated
so that the signs lose as little as possible; rotations from different starts, CODES
or more, give as many words of up to 64 bits. The model is fitted on at most
SAMPLE vectors, those with the smallest hashes.

The tables: each word is cut into parts of log2(n) bits, so a bucket holds a few
chance members at any n. There are as many words as it takes for a pair at the
threshold to be missed by all tables with a probability of MISS at most. That is
computed from the share of bits in which such a pair differs, which is measured on
the sample, and takes bits as independent. Two vectors meet in a table when their
parts differ in one bit at most: a vector stands once per bit, under its part
without that bit. A pair that meets several times is taken at its first meeting
only, which both codes tell. Pairs whose codes differ in more than FAR of their
bits (at the threshold a tenth differ) go no further; the rest is compared in
full, in double precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
numbers link with nothing; vectors of different lengths never link; equal
vectors are compared once and count as links of each other; of equal ids each
row is a vector of its own; null ids are last. Labels and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.llm.common import by_sorting, ship, stage, unpacked
from postline.llm.components import components

COSINE = 0.95
SAMPLE = 20_000
#: The least number of rotations.
CODES = 2
#: Computed share of pairs at the threshold that no table finds.
MISS = 0.005
WORD_BITS = 64
FAR = 0.3
ROUNDS = 40


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit(sample: np.ndarray, codes: int = CODES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projections of each code): the sign of (x - mean) @ projection is a bit."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(0)
    spread = (unit - mean).T @ (unit - mean)
    _, axes = np.linalg.eigh(spread)
    axes = axes[:, ::-1][:, : min(WORD_BITS, unit.shape[1])]
    flat = (unit - mean) @ axes
    random = np.random.default_rng(7)
    out = []
    for _ in range(codes):
        turn, _ = np.linalg.qr(random.normal(size=(flat.shape[1],) * 2))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = (left @ right).T
        out.append(axes @ turn)
    return mean, np.stack(out)


def encode(vectors: np.ndarray, mean: np.ndarray, projections: np.ndarray) -> np.ndarray:
    """Words of bits, (vectors, codes)."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    words = []
    for p in projections:
        bits = ((unit - mean) @ p >= 0).astype(np.uint64)
        words.append((bits << np.arange(bits.shape[1], dtype=np.uint64)).sum(1, dtype=np.uint64))
    return np.stack(words, axis=1).view(np.int64)


def differing(sample: np.ndarray, model: tuple[np.ndarray, np.ndarray], cosine: float = COSINE) -> float:
    """Share of bits that differ between a sample vector and one at that cosine in a random direction; no less than for centred vectors."""
    least = float(np.arccos(cosine) / np.pi)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    side = np.random.default_rng(13).normal(size=unit.shape)
    side -= (side * unit).sum(1, keepdims=True) * unit
    size = np.linalg.norm(side, axis=1, keepdims=True)
    if unit.shape[1] < 2 or not size.all():
        return least
    other = cosine * unit + np.sqrt(1 - cosine**2) * side / size
    apart = np.bitwise_count(encode(unit, *model).view(np.uint64) ^ encode(other, *model).view(np.uint64))
    return max(least, float(apart.mean()) / model[1].shape[2])


def tables(bits: int, rows: int, codes: int = CODES) -> list[tuple[int, int, int]]:
    """(code, first bit, width) of the parts, each log2(rows) bits wide."""
    width = max(1, min(bits, max(4, int(np.ceil(np.log2(max(rows, 2)))))))
    return [(c, first, width) for c in range(codes) for first in range(0, bits - width + 1, width)]


def missed(parts: list[tuple[int, int, int]], differ: float) -> float:
    """Probability that a pair whose bits differ with that probability meets in no part."""
    return float(np.prod([1 - (1 - differ) ** w - w * differ * (1 - differ) ** (w - 1) for _, _, w in parts]))


def codes_for(bits: int, rows: int, differ: float, miss: float = MISS) -> int:
    """The least number of codes, from CODES, with which at most `miss` is missed."""
    each = missed(tables(bits, rows, 1), min(differ, 0.5))
    return max(CODES, int(np.ceil(np.log(miss) / np.log(each)))) if each > 0 else CODES


def coded(vectors: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """vectors (node, vector) as (node, code0, code1, ...)."""
    shipped = ship(vectors.sparkSession, model)
    names = [f"code{i}" for i in range(len(model[1]))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, projections = unpacked(shipped)
        for batch in batches:
            words = encode(matrix(batch.column("vector")), mean, projections) if len(batch) else np.zeros((0, len(names)), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("node"), *(pa.array(words[:, i].copy()) for i in range(len(names)))], ["node", *names])

    return vectors.mapInArrow(add, "node binary, " + ", ".join(f"{n} long" for n in names))


def matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def place_of(table: int, part: Column) -> Callable[[Column], Column]:
    """From a bit to (table, bit, the part without that bit)."""

    def place(bit: Column) -> Column:
        without = F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
        return F.struct(F.lit(table).alias("table"), bit.alias("bit"), part.bitwiseAND(without).alias("rest"))

    return place


def meetings(codes: DataFrame, parts: list[tuple[int, int, int]]) -> DataFrame:
    """(table, bit, rest, node, codes) of every place where a vector stands in the tables."""
    places = []
    for table, (code, first, width) in enumerate(parts):
        part = F.shiftrightunsigned(F.col(f"code{code}"), first).bitwiseAND(F.lit((1 << width) - 1))
        places.append(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), place_of(table, part)))
    rows = codes.withColumn("place", F.explode(F.flatten(F.array(*places))))
    return rows.select("place.table", "place.bit", "place.rest", *codes.columns)


def first_meeting(parts: list[tuple[int, int, int]]) -> Column:
    """Whether a pair's meeting (table, bit) is its first one. The other row's columns end in _b."""
    before, out = F.lit(False), F.lit(False)
    for table, (code, first, width) in enumerate(parts):
        differ = F.shiftrightunsigned(F.col(f"code{code}").bitwiseXOR(F.col(f"code{code}_b")), first).bitwiseAND(F.lit((1 << width) - 1))
        # an equal part meets under every bit and is taken under bit 0
        own = (F.col("table") == table) & F.when(differ == 0, F.col("bit") == 0).otherwise(F.lit(True))
        out = out | (own & ~before)
        before = before | (F.bit_count(differ) <= 1)
    return out


def candidates(codes: DataFrame, parts: list[tuple[int, int, int]], bits: int) -> DataFrame:
    """(a, b): pairs that meet in a table and whose codes are near, each once."""
    placed = meetings(codes, parts)
    shared = placed.groupBy("table", "bit", "rest").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    placed = stage(placed.join(by_sorting(shared), ["table", "bit", "rest"]))
    names = [c for c in codes.columns if c != "node"]
    other = placed.select("table", "bit", "rest", F.col("node").alias("b"), *(F.col(c).alias(f"{c}_b") for c in names))
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_b"))) for c in names), F.lit(0))
    pairs = placed.join(by_sorting(other), ["table", "bit", "rest"])
    return pairs.where((F.col("node") < F.col("b")) & first_meeting(parts) & (apart <= int(FAR * bits * len(names)))).select(F.col("node").alias("a"), "b")


def near(pairs: DataFrame, vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """The pairs whose vectors have at least that cosine."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                one, two = matrix(batch.column("vector_a")), matrix(batch.column("vector_b"))
                value = (one * two).sum(1) / np.sqrt((one * one).sum(1) * (two * two).sum(1))
                yield batch.select(["a", "b"]).filter(pa.array(value >= cosine))

    right = vectors.select(F.col("node").alias("b"), F.col("vector").alias("vector_b"))
    left = vectors.select(F.col("node").alias("a"), F.col("vector").alias("vector_a"))
    rows = pairs.join(by_sorting(right), "b").join(by_sorting(left), "a").select("a", "b", "vector_a", "vector_b")
    return rows.mapInArrow(check, "a binary, b binary")


def low_hashes(vectors: DataFrame, rows: int, sample: int) -> DataFrame:
    """The rows whose hashes lie in the lowest part of their range, where twice `sample` of all rows are expected."""
    if rows <= 2 * sample:
        return vectors
    return vectors.where(F.xxhash64("node") < F.lit(int(2**64 * (2 * sample / rows)) - 2**63))


def smallest_hashes(vectors: DataFrame, rows: int, sample: int) -> np.ndarray:
    """The vectors of the `sample` smallest hashes. Each task would send so many rows, so all but the low hashes are left out before."""
    for low in (low_hashes(vectors, rows, sample), vectors):
        found = low.orderBy(F.xxhash64("node")).limit(sample).select("vector").toArrow()["vector"].combine_chunks()  # bounded by `sample`
        if len(found) >= min(rows, sample):
            break
    return matrix(found)


def links(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """(a, b): pairs of different vectors (node, vector), all usable and of one length."""
    rows = vectors.count()
    known = smallest_hashes(vectors, rows, sample)
    model = fit(known, 1)
    bits = model[1].shape[2]
    model = fit(known, codes_for(bits, rows, differing(known, model, cosine)))
    codes = stage(coded(vectors, model))
    return near(candidates(codes, tables(bits, rows, len(model[1])), bits), vectors, cosine)


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of embeddings."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = stage(embeddings.select("vec_id", F.when(usable(vector), vector).alias("vector")))
    rows = rows.withColumn("node", F.unhex(F.md5(F.array_join(F.transform("vector", lambda x: x.cast("string")), ",").cast("binary"))))
    order = F.struct(F.col("vec_id").isNull().alias("absent"), "vec_id")
    nodes = rows.where("node is not null").groupBy("node").agg(F.first("vector").alias("vector"), F.min(order).alias("least"), F.count("*").alias("n"))
    nodes = stage(nodes)
    sizes = [r["k"] for r in nodes.select(F.size("vector").alias("k")).distinct().collect()]  # the lengths vectors have
    found = None
    for k in sorted(sizes):
        here = links(nodes.where(F.size("vector") == k).select("node", "vector"), cosine)
        found = here if found is None else found.unionByName(here)
    slim = nodes.select("node", "least", "n")
    if found is None:
        placed = slim.select(F.col("node").alias("of"), F.lit(0).cast("long").alias("links"), F.col("least").alias("first"))
    else:
        found = stage(found)
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = both.join(by_sorting(slim.select(F.col("node").alias("b"), "n")), "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
        joined = slim.join(components(found), "node", "left").withColumn("root", F.coalesce("root", "node"))
        firsts = joined.groupBy("root").agg(F.min("least").alias("first"))
        placed = joined.join(firsts, "root").join(degree, "node", "left")
        placed = placed.select(F.col("node").alias("of"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "first")
    out = rows.select("vec_id", "node").join(stage(placed), F.col("node") == F.col("of"), "left")
    root = F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("first.vec_id"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"), root.eqNullSafe(F.col("vec_id")).alias("kept")
    )
