"""Hard-negative mining by exact inner products in a residue number system.

Components become whole numbers. A set of small primes is chosen whose product
exceeds twice the largest score there can be (no score exceeds the largest
squared length). Modulo each prime the residues are small enough that a float32
matrix product of them is exact, and Chinese remaindering gives the signed score
back. Anchors and rows meet in a grid of bounded blocks: a first pass over the
rows of each anchor's own label finds its positives, a second one over all rows
keeps, for each positive, the best rows of other labels whose score lies in the
positive's window. Blocks keep only what may stay, a window ranks that.

Defined cases: rows with a null id, label or vector, or a component that is null
or not finite, take no part; nor do those longer than 2^30 after scaling, whose
scores might leave a long. Vectors of different lengths are compared as if
filled up with zeros; an empty vector scores 0 with all. Rows that agree in id,
label and vector are one row; others with one id each take part, and as the
result names only ids and scores, ties between them leave it as it is. An anchor without other rows of its
label has no rows in the result, and a positive without negatives in its window
has none. An empty table gives an empty result. Columns other than the three,
of whatever name, are not read.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postline.llm.common import stage
from postline.operators.skew import attach

SCALE = 256
POSITIVES = NEGATIVES = 5
#: A negative's score is between these hundredths of the positive's.
LOWEST, HIGHEST = 80, 100
ANCHOR_STEP, MOVED_STEP, LABELS = 100, 7, 10
#: Integers up to here are exact in float32.
EXACT = 1 << 24
#: Components of one exact product; longer vectors are multiplied in parts.
PART = 1024
#: Components of one block of the grid: 32 MB of 32-bit numbers.
BLOCK_VALUES = 1 << 23
LEAST_ROWS = 2048
#: Rows and anchors multiplied at once within a block.
ROWS_AT_ONCE, ANCHORS_AT_ONCE = 4096, 512
MISSING = np.iinfo(np.int64).min


# ---- whole numbers


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def quantised(rows: DataFrame) -> DataFrame:
    """vec_id, label and q (whole numbers) of the rows that take part, without repeated rows."""
    scaled = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("e"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & F.forall("e", finite))
    scaled = scaled.withColumn("e", F.transform("e", lambda x: x * SCALE))
    bounded = F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x) < float(1 << 60)
    moved = F.when(F.col("vec_id") % MOVED_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    whole = F.transform("e", lambda x: F.floor(x).cast("int"))
    return scaled.where(bounded).select("vec_id", moved.alias("label"), whole.alias("q")).distinct()


def primes_for(bound: int, width: int) -> list[int]:
    """Primes whose product exceeds twice the bound, each small enough for exact float32 products of `width` residues."""
    half = isqrt(EXACT // max(1, min(width, PART)))
    candidate = min(2 * half + 1, 2039)
    found: list[int] = []
    product = 1
    while product <= 2 * bound + 1:
        if all(candidate % d for d in range(2, isqrt(candidate) + 1)):
            found.append(candidate)
            product *= candidate
        candidate -= 1
        if candidate < 2:
            raise ValueError("the primes do not reach the largest score")
    return found


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, between -p/2 and p/2."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r)


def residues(q: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [centred(q, p).astype(np.float32) for p in primes]


def exact_scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products of all rows of left and right, from their residue matrices.

    Digits of mixed radix, each between -p/2 and p/2, stand for exactly one
    number between minus and plus half the product of the primes.
    """
    score = None
    base = 1
    for a, b, p in zip(left, right, primes, strict=True):
        remainder = np.zeros((len(a), len(b)), dtype=np.int64)
        for start in range(0, a.shape[1], PART):
            remainder += (a[:, start : start + PART] @ b[:, start : start + PART].T).astype(np.int64)
        if score is None:
            score = centred(remainder, p)
        else:
            digit = centred(np.mod(remainder - score, p) * pow(base, -1, p), p)
            score += np.int64(base) * digit
        base *= p
    return score


# ---- blocks


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of one matrix, filled up with zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def first_of(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first k of each group: highest score, then smallest id, then smallest row."""
    order = np.lexsort((row, vec_id, -score, group))
    sorted_group = group[order]
    begin = np.flatnonzero(np.append(True, sorted_group[1:] != sorted_group[:-1])) if len(order) else np.empty(0, dtype=np.int64)
    within = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[within < k]


def best_of_block(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (anchor, row) that may be among the first k allowed of their anchor; all ties stay."""
    held = np.where(allowed, score, MISSING)
    if held.shape[1] > k:
        allowed = allowed & (held >= np.partition(held, held.shape[1] - k, axis=1)[:, -k, None])
    return np.nonzero(allowed)


def best_pairs(anchors: dict[str, np.ndarray], rows: dict[str, np.ndarray], primes: list[int], windows: list[tuple[np.ndarray, np.ndarray]] | None, k: int) -> list[np.ndarray]:
    """anchor index, slot, score and row index of the first k rows for each anchor and slot in this block.

    Without windows: the slot is 0 and all rows but the anchor itself count.
    With windows (lowest and highest score per anchor, one pair per slot): rows
    of other labels whose score lies in the slot's window.
    """
    found: list[list[np.ndarray]] = [[], [], [], []]
    for r in range(0, len(rows["row"]), ROWS_AT_ONCE):
        part = slice(r, r + ROWS_AT_ONCE)
        right = residues(rows["q"][part], primes)
        for a in range(0, len(anchors["row"]), ANCHORS_AT_ONCE):
            own = slice(a, a + ANCHORS_AT_ONCE)
            score = exact_scores(residues(anchors["q"][own], primes), right, primes)
            if windows is None:
                tests = [rows["row"][part] != anchors["row"][own, None]]
            else:
                other = rows["label"][part] != anchors["label"][own, None]
                tests = [other & (score >= low[own, None]) & (score <= high[own, None]) for low, high in windows]
            for slot, allowed in enumerate(tests):
                i, j = best_of_block(score, allowed, k)
                top = first_of(i, score[i, j], rows["vec_id"][part][j], rows["row"][part][j], k)
                for out, value in zip(found, (i[top] + a, np.full(len(top), slot), score[i[top], j[top]], j[top] + r), strict=True):
                    out.append(value)
    anchor, slot, score, row = (np.concatenate([np.empty(0, dtype=np.int64), *out]) for out in found)
    top = first_of(anchor * POSITIVES + slot, score, rows["vec_id"][row], rows["row"][row], k)
    return [anchor[top], slot[top], score[top], row[top]]


def columns_of(block: pa.Table, width: int) -> dict[str, np.ndarray]:
    out = {c: block.column(c).to_numpy() for c in ("row", "vec_id", "label")}
    return out | {"q": matrix(block.column("q"), width)}


# ---- the grid


def spread(rows: DataFrame, own: str, own_parts: Column, other: str, other_parts: Column) -> DataFrame:
    """Each row in one of own_parts hash-random parts, repeated for every part of the other side."""
    placed = rows.withColumn(own, F.pmod(F.xxhash64("row", F.lit(own)), own_parts).cast("int"))
    return placed.withColumn(other, F.explode(F.sequence(F.lit(0), (other_parts - 1).cast("int"))))


def parts(n: Column, block_rows: int) -> Column:
    return F.greatest(F.ceil(n / block_rows), F.lit(1))


def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(rows: DataFrame, anchors: DataFrame, primes: list[int], width: int, block_rows: int) -> DataFrame:
    """anchor, vec_id, score, rank: the first rows of each anchor's own label.

    The grid is cut within each label: a label with many rows gets many blocks,
    and no row meets anchors of other labels.
    """
    sizes = anchors.groupBy("label").agg(F.count("*").alias("m")).join(rows.groupBy("label").agg(F.count("*").alias("n")), "label")
    sizes = stage(sizes)
    left = attach(rows, sizes, ["label"], F.col("row"), "inner", size="n")
    right = attach(anchors, sizes, ["label"], F.col("row"), "inner", size="n")
    keys = ["label", "stripe", "block"]
    left = spread(left, "stripe", parts(F.col("n"), block_rows), "block", parts(F.col("m"), block_rows)).select(*keys, "row", "vec_id", "q")
    right = spread(right, "block", parts(F.col("m"), block_rows), "stripe", parts(F.col("n"), block_rows)).select(*keys, "row", "vec_id", "q")
    schema = pa.schema([("anchor", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64())])

    def run(row_block: pa.Table, anchor_block: pa.Table) -> pa.Table:
        own, others = columns_of(anchor_block, width), columns_of(row_block, width)
        anchor, _, score, row = best_pairs(own, others, primes, None, POSITIVES)
        values = (own["row"][anchor], score, others["vec_id"][row], others["row"][row])
        return pa.Table.from_arrays([pa.array(v) for v in values], schema=schema)

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "anchor long, score long, vec_id long, row long")
    return ranked(found, ["anchor"], POSITIVES)


def negatives(rows: DataFrame, anchors: DataFrame, n: int, m: int, primes: list[int], width: int, block_rows: int) -> DataFrame:
    """The first rows of other labels in the window of each positive; anchors carry slots (vec_id and score of positives)."""
    stripes, blocks = parts(F.lit(n), block_rows), parts(F.lit(m), block_rows)
    keys = ["stripe", "block"]
    left = spread(rows, "stripe", stripes, "block", blocks)
    right = spread(anchors, "block", blocks, "stripe", stripes)
    names = ("anchor", "anchor_id", "slot", "positive_id", "positive_score", "score", "vec_id", "row")
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(row_block: pa.Table, anchor_block: pa.Table) -> pa.Table:
        own, others = columns_of(anchor_block, width), columns_of(row_block, width)
        slots = anchor_block.column("slots").to_pylist()
        ids, scores = (np.full((len(slots), POSITIVES), 0, dtype=np.int64) for _ in range(2))
        there = np.zeros((len(slots), POSITIVES), dtype=bool)
        for i, entries in enumerate(slots):
            for j, s in enumerate(entries):
                ids[i, j], scores[i, j], there[i, j] = s["vec_id"], s["score"], True
        low = -((-LOWEST * scores) // 100)
        high = (HIGHEST * scores) // 100
        low[~there], high[~there] = 1, 0
        windows = [(low[:, j], high[:, j]) for j in range(POSITIVES)]
        anchor, slot, score, row = best_pairs(own, others, primes, windows, NEGATIVES)
        values = (own["row"][anchor], own["vec_id"][anchor], slot, ids[anchor, slot], scores[anchor, slot], score, others["vec_id"][row], others["row"][row])
        return pa.Table.from_arrays([pa.array(v) for v in values], schema=schema)

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, ", ".join(f"{c} long" for c in names))
    return ranked(found, ["anchor", "slot"], NEGATIVES)


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = stage(quantised(vectors).withColumn("row", F.monotonically_increasing_id()))
    anchors = rows.where(F.col("vec_id") % ANCHOR_STEP == 0).toDF(*rows.columns)  # columns of their own, for the grid
    square = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x.cast("long"))
    known = rows.agg(
        F.count("*").alias("n"), F.count_if(F.col("vec_id") % ANCHOR_STEP == 0).alias("m"), F.max(square).alias("bound"), F.max(F.size("q")).alias("width")
    ).first()
    n, m, bound, width = known["n"], known["m"], known["bound"] or 0, max(1, known["width"] or 1)
    primes = primes_for(bound, width)
    wanted = max(LEAST_ROWS, -(-n // (2 * spark.sparkContext.defaultParallelism)))
    block_rows = max(1, min(BLOCK_VALUES // width, wanted))
    near = stage(positives(rows, anchors, primes, width, block_rows))
    slots = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("slots"))
    with_slots = anchors.join(slots, F.col("row") == F.col("anchor")).drop("anchor")
    found = negatives(rows, with_slots, n, m, primes, width, block_rows)
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


#: The same rows from DuckDB, for ids that occur once and vectors of one length.
SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), near AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), found AS (
    SELECT near.*, other_id AS negative_id, score AS negative_score,
        row_number() OVER (PARTITION BY near.anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank
    FROM near JOIN scored ON near.anchor_id = scored.anchor_id
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 5
"""
