"""Near duplicates by weighted Jaccard similarity of five-word shingles, with BagMinHash signatures.

A text is the multiset of its shingles. A shingle of weight w owns the levels
(0,1], (1,2], (2,4], ... up to w, each with a Poisson process whose rate is the
level's width. A point has a time, a place in the signature and a cell of its
level, found by halving the level with the point's random bits; points in cells
above w do not count. The first counted time of each place is the signature, and
two texts agree in a place with the probability of their weighted similarity.
Six places make a band, so a pair at the threshold misses all bands once in 300,000
cases and one at 0.3 meets in one of thirty. Texts that share a band are compared in full, and
links of SIMILARITY or more are closed to groups.

Defined cases: texts below five words are one shingle of all their words; texts
without words (null, empty) link with nothing, not even each other; rows equal
in id and text are one document seen again. The smallest id of a group is kept
(null ids last, ties by text hash); of equal rows one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.llm.common import TEXTS_AT_ONCE, WORD, in_batches, mix, stage, texts_of, word_hashes
from postline.llm.linking import linked, node_of

WORDS = 5
#: Similarity in percent from which texts are near duplicates.
SIMILARITY = 80
PLACES = 252
ROWS = 6
AT_ONCE = 2_000_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each different shingle, how often it occurs)."""
    words = text.encode("utf-8", "surrogatepass").split()
    h = word_hashes(words)
    n = min(WORDS, len(h))
    if not n:
        return h, np.zeros(0, dtype=np.int64)
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = out * FACTOR + h[k : len(h) - n + 1 + k]
    return np.unique(mix(out), return_counts=True)


def signatures(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, texts: int, places: int = PLACES) -> np.ndarray:
    """First counted times, (texts, places); infinite throughout for a text without elements."""
    first = np.full((texts, places), np.inf)
    total = np.bincount(owner, weights=weight, minlength=texts)
    horizon = places * (np.log(places) + 3) / np.maximum(total, 1)
    level, width, ready = levels(element, weight, owner)
    pending = np.flatnonzero(total > 0)
    while len(pending):
        wanted = np.zeros(texts, dtype=bool)
        wanted[pending] = True
        at = np.flatnonzero(wanted[ready["owner"]])
        seed, rate, low = ready["seed"][at], width[at].astype(np.float64), level[at]
        own, most = ready["owner"][at], ready["weight"][at]
        time = np.zeros(len(at))
        step = 0
        while len(at):
            u = (mix(seed + draw(2 * step + 1)) >> np.uint64(11)).astype(np.float64)
            time = time - np.log((u + 1) * 2.0**-53) / rate
            alive = time < horizon[own]
            at, seed, rate, low, own, most, time = (a[alive] for a in (at, seed, rate, low, own, most, time))
            bits = mix(seed + draw(2 * step + 2))
            place = (bits & np.uint64(0xFFFF)).astype(np.int64) % places
            cell = low + ((bits >> np.uint64(16)).astype(np.int64) & (rate.astype(np.int64) - 1))
            counted = cell < most
            np.minimum.at(first.reshape(-1), own[counted] * places + place[counted], time[counted])
            step += 1
        pending = pending[first[pending].max(1) >= horizon[pending]]
        horizon[pending] *= 2
    return first


def draw(k: int) -> np.uint64:
    """What is added to a seed for its k-th random number."""
    return np.uint64(k * int(FACTOR) & 0xFFFFFFFFFFFFFFFF)


def levels(element: np.ndarray, weight: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(lower end, width) of every level an element reaches into, and its seed, owner and weight."""
    parts, low = [], 0
    while True:
        here = np.flatnonzero(weight > low)
        if not len(here):
            break
        parts.append((here, low))
        low = max(1, 2 * low)
    index = np.concatenate([p for p, _ in parts]) if parts else np.zeros(0, dtype=np.int64)
    lower = np.concatenate([np.full(len(p), v) for p, v in parts]) if parts else np.zeros(0, dtype=np.int64)
    seed = mix(element[index] ^ mix(lower.astype(np.uint64) + np.uint64(1)))
    return lower, np.maximum(lower, 1), {"seed": seed, "owner": owner[index], "weight": weight[index]}


def band_hashes(first: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash per band of `rows` places, (texts, bands)."""
    bits = first.view(np.uint64).reshape(len(first), -1, rows)
    out = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64), bits.shape[:2])
    for k in range(rows):
        out = mix(out * FACTOR + bits[:, :, k])
    return out.view(np.int64)


def banded(texts: DataFrame) -> DataFrame:
    """texts (node, text) as (node, bands); no bands for texts without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = texts_of(batch)
            bands: list[list[int]] = [[] for _ in every]
            run: list[int] = []
            size = 0
            for i, text in enumerate(every):
                run.append(i)
                size += len(text)
                if size >= AT_ONCE or i + 1 == len(every):
                    found = [shingles(every[k]) for k in run]
                    owner = np.repeat(np.arange(len(run)), [len(e) for e, _ in found])
                    first = signatures(np.concatenate([e for e, _ in found]), np.concatenate([w for _, w in found]), owner, len(run))
                    for k, row, filled in zip(run, band_hashes(first).tolist(), np.isfinite(first[:, 0]), strict=True):
                        if filled:
                            bands[k] = row
                    run, size = [], 0
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(bands, pa.list_(pa.int64()))], ["node", "bands"])

    return texts.select("node", "text").mapInArrow(sketch, "node binary, bands array<long>")


def elements(texts: DataFrame) -> DataFrame:
    """texts (node, text) as (node, element, weight): a row per different shingle."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, every = batch.column("node"), texts_of(batch)
            for start in range(0, len(every), 500):
                found = [shingles(t) for t in every[start : start + 500]]
                owner = np.repeat(np.arange(start, start + len(found)), [len(e) for e, _ in found])
                hashes, weight = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                columns = [nodes.take(pa.array(owner)), pa.array(hashes.view(np.int64)), pa.array(weight, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "element", "weight"])

    return texts.select("node", "text").mapInArrow(spell, "node binary, element long, weight long")


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], percent: int = SIMILARITY) -> bool:
    """Whether the weighted Jaccard similarity of two shingle multisets reaches percent, exactly."""
    total = int(a[1].sum() + b[1].sum())
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common > 0 and 100 * common >= percent * (total - common)


def verified(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, text_a, text_b) whose texts are similar, as (a, b)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            keep = []
            nodes, one, two = batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b")
            for i, node in enumerate(nodes):
                if node != last:
                    last, left = node, shingles(one[i].as_py())
                keep.append(similar(left, shingles(two[i].as_py())))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(check, "a binary, b binary")


def similar_texts(rows: DataFrame) -> DataFrame:
    """(node, root) of all different texts of rows (node, text) that are linked with another."""
    sketched = banded(rows).groupBy("node").agg(F.first("bands").alias("bands"))
    bands = sketched.select(F.explode("bands").alias("band"), "node")
    return linked(stage(bands), rows.groupBy("node").agg(F.first("text").alias("text")), verified, elements, SIMILARITY)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, node, cluster_id, cluster_size, kept for every row of docs."""
    in_batches(docs.sparkSession, TEXTS_AT_ONCE)
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", node_of(text).alias("node"), text.alias("text"), F.coalesce(text.rlike(WORD), F.lit(False)).alias("worded"))
    roots = similar_texts(rows.where("worded").select("node", "text"))
    slim = stage(rows.select("doc_id", "node", "worded"))
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "node")
    nodes = slim.where("worded").groupBy("node").agg(F.min(order).alias("least"), F.count("*").alias("n"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = nodes.groupBy("root").agg(F.min("least").alias("first"), F.sum("n").alias("size"))
    placed = stage(nodes.select("node", "root").join(sizes, "root").select(F.col("node").alias("of"), "first", "size"))
    found = slim.join(placed, F.col("worded") & (F.col("node") == F.col("of")), "left")
    own = (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.node") == F.col("node"))) | F.col("of").isNull()
    return found.select(
        "doc_id",
        "node",
        F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("cluster_id"),
        F.coalesce("size", F.lit(1)).alias("cluster_size"),
        own.alias("kept"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, columns unchanged; of rows equal in id and text one."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("node").alias("__of")).distinct()
    marked = docs.withColumn("__node", node_of(F.col("text").cast("string")))
    there = marked.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__node") == F.col("__of")), "left_semi")
    return there.dropDuplicates(["doc_id", "__node"]).select(*docs.columns)
