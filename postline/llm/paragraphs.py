"""Paragraphs that repeat across texts, by MinHash bands over five-word shingles.

Paragraphs are made from the whole text, whatever its lines: a text is cut before
each run of CUT_WORDS words whose hash is the smallest among those of REACH words
to either side. Such places depend on the words around them alone, so a passage
that recurs is cut alike wherever it stands, over many short lines or inside a long
one. Paragraphs above MOST words (one word over and over has no such place) are cut
every PART words from their start. Neighbouring cuts are more than REACH words
apart, so only the first and last paragraph of a text, and what is left of one cut
by length, can be below LEAST words; these are phrases and are never compared. A
passage of over 50 words that lies anywhere in two texts holds a whole paragraph but
for a few in a hundred; what is shorter than two paragraphs may hold none.

Bands are tuned to the most selective ones that still find RECALL of the pairs at
the threshold. Paragraphs that share a band are compared in full (Jaccard similarity
of their shingle sets), links are closed to groups, and of each group the paragraph
that comes first (smallest id, then position) stays; the others are removed, each
with the blanks that follow it.

Defined cases: null and empty texts have no paragraphs and stay as they are; exact
copies are always of one group, also within a text; rows equal in id and text are
one document, both lose the same paragraphs. Null ids come last. A very long text is
cut in blocks and held as 16 bytes a word. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from postline.llm.common import TEXTS_AT_ONCE, forget_shuffles, in_batches, mix, stage, texts_of, word_hashes
from postline.llm.linking import linked, node_of

#: Words whose hash decides on a cut, and how far around a cut no other has a smaller one.
CUT_WORDS = 3
REACH = 11
#: The fewest and the most words of a paragraph that is compared, and the words of parts of longer ones.
LEAST = 12
MOST = 64
PART = 32
WORDS = 5
#: Jaccard similarity in percent from which paragraphs are near copies.
SIMILARITY = 80
PLACES = 10
RECALL = 0.99
#: Bytes that are sketched, and that are split into words, at once.
AT_ONCE = 2_000_000
BLOCK = 1 << 22
FACTOR = np.uint64(0x9E3779B97F4A7C15)
FACTOR_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
LARGEST = np.uint64(2**64 - 1)
#: The bytes that separate words.
BLANKS = b" \t\n\x0b\x0c\r"
IS_BLANK = np.isin(np.arange(256), list(BLANKS))


def tuned_rows(places: int = PLACES, percent: int = SIMILARITY, recall: float = RECALL) -> int:
    """The most rows a band may have so that a pair at the threshold shares a band with probability recall."""
    s = percent / 100
    fitting = [r for r in range(1, places + 1) if 1 - (1 - s**r) ** (places // r) >= recall]
    return max(fitting, default=1)


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words, given the words' hashes."""
    out = np.full(max(0, len(h) - n + 1), n, dtype=np.uint64)
    for k in range(n):
        out = out * FACTOR + h[k : k + len(out)]
    return mix(out)


def shingles(text: str) -> np.ndarray:
    """Hashes of a paragraph's shingles; of all its words where they are fewer than five."""
    h = word_hashes(text.encode("utf-8", "surrogatepass").split())
    return rolled(h, min(WORDS, len(h))) if len(h) else h


def signatures(values: np.ndarray, first: np.ndarray, stop: np.ndarray, places: int = PLACES) -> np.ndarray:
    """The smallest value of each of `places` hash functions over values[first:stop]; no range is empty, none overlap."""
    keys = mix(np.arange(1, 2 * places + 1, dtype=np.uint64) * FACTOR)
    ranges = np.column_stack([first, stop]).ravel()
    values = np.append(values, LARGEST)  # the last range may stop at the end
    out = np.empty((len(first), places), dtype=np.uint64)
    for k in range(places):
        out[:, k] = np.minimum.reduceat((values ^ keys[2 * k]) * (keys[2 * k + 1] | np.uint64(1)), ranges)[::2]
    return out


def band_hashes(values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """(paragraph, band) of hashes; a paragraph's shingles are values[first:stop]."""
    rows = tuned_rows()
    bands = PLACES // rows
    sketches = signatures(values, first, stop, bands * rows).reshape(len(first), bands, rows)
    hashes = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(first), bands))
    for k in range(rows):
        hashes = mix(hashes * FACTOR + sketches[:, :, k])
    return hashes.view(np.int64)


def words_at(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of each word in bytes."""
    blank = np.ones(len(data) + 2, dtype=bool)
    blank[1:-1] = IS_BLANK[np.frombuffer(data, dtype=np.uint8)]
    return np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])


def hashed(data: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word: a polynomial of its bytes, as differences of running sums; a long text goes block by block."""
    letters = mix(np.arange(1, 257, dtype=np.uint64) * FACTOR)
    found, at = [np.zeros(0, dtype=np.uint64)], 0
    while at < len(starts):
        till = max(at + 1, int(np.searchsorted(stops, starts[at] + BLOCK, "right")))
        base = starts[at]
        values = letters[np.frombuffer(data, dtype=np.uint8, count=stops[till - 1] - base, offset=base)]
        power = np.cumprod(np.full(len(values), FACTOR))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values * power)])
        back = np.cumprod(np.full(len(values), FACTOR_BACK))
        first, stop = starts[at:till] - base, stops[at:till] - base
        found.append(mix((sums[stop] - sums[first]) * back[first] + (stop - first).astype(np.uint64)))
        at = till
    return np.concatenate(found)


def least_of(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each n values that follow each other, by doubling."""
    wide = 1
    while 2 * wide <= n:
        values = np.minimum(values[:-wide], values[wide:])
        wide *= 2
    return np.minimum(values[: len(values) - (n - wide)], values[n - wide :])


def bounds(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, stop) of the paragraphs of texts of `sizes` words, the short ones too; h: the hashes of all their words.

    Texts are laid out with REACH places between them, so none bears on another. Every text has a word.
    """
    if not len(h):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    g = np.concatenate([rolled(h, CUT_WORDS), np.full(min(len(h), CUT_WORDS - 1), LARGEST)])
    for k in range(1, CUT_WORDS):
        g[np.maximum(ends - k, ends - sizes)] = LARGEST  # these runs go beyond their text
    at = np.arange(len(h)) + REACH * np.repeat(np.arange(1, len(sizes) + 1), sizes)
    apart = np.full(len(h) + REACH * (len(sizes) + 1), LARGEST)
    apart[at] = g
    around = least_of(apart, REACH)
    # of equal ones the first is the smallest
    cut = (g < around[at - REACH]) & (g <= around[at + 1])
    cut[ends - sizes] = True
    first = np.flatnonzero(cut)
    parts = np.diff(np.append(first, len(h)))
    n = np.where(parts > MOST, -(-parts // PART), 1)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(first, n) + nth * PART
    return first, np.append(first[1:], len(h))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, of, start, stop, digest, bands, text) of every paragraph that is compared.

    `of` is the hash of the text it stands in, start and stop are bytes of it; what
    is removed with it reaches to the next paragraph. `digest` is the 128-bit hash of its text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            every = batch.column("text")
            run, size = [], 0
            for row in range(len(batch)):
                data = (every[row].as_py() or "").encode("utf-8", "surrogatepass")
                if len(data) >= 2 * LEAST - 1:
                    run.append((row, data))
                    size += len(data)
                if run and (size >= AT_ONCE or row + 1 == len(batch)):
                    yield laid_out(batch, run, xxhash.xxh3_128_digest)
                    run, size = [], 0

    def laid_out(batch: pa.RecordBatch, run: list[tuple[int, bytes]], digest) -> pa.RecordBatch:
        data = b"\n".join(d for _, d in run)
        base = np.cumsum([0] + [len(d) + 1 for _, d in run])
        starts, stops = words_at(data)
        h = hashed(data, starts, stops)
        till = np.searchsorted(starts, base)
        first, stop = bounds(h, np.diff(till)[np.diff(till) > 0])
        compared = stop - first >= LEAST
        first, stop = first[compared], stop[compared]
        of = np.searchsorted(till, first, "right") - 1
        # up to the next word of the same text, or its end
        close = np.minimum(np.append(starts, len(data))[stop], base[of + 1] - 1)
        texts = [data[a:b] for a, b in zip(starts[first].tolist(), stops[stop - 1].tolist(), strict=True)]
        bands = PLACES // tuned_rows()
        hashes = band_hashes(rolled(h, WORDS), first, stop - WORDS + 1) if len(first) else np.zeros((0, bands), dtype=np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1) * bands, pa.int32()), pa.array(hashes.ravel()))
        at = pa.array(np.array([row for row, _ in run])[of])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("of").take(at), pa.array(starts[first] - base[of], pa.int64()),
             pa.array(close - base[of], pa.int64()), pa.array([digest(t) for t in texts], pa.binary()), lists,
             pa.array([t.decode("utf-8", "surrogatepass") for t in texts], pa.string())],
            ["doc_id", "of", "start", "stop", "digest", "bands", "text"],
        )

    text = F.col("text").cast("string")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, of binary, start long, stop long, digest binary, bands array<long>, text string"
    return docs.select("doc_id", node_of(text).alias("of"), text.alias("text")).mapInArrow(cut, schema)


def elements(texts: DataFrame) -> DataFrame:
    """texts (node, text) as (node, element, weight): a row per different shingle, all of weight 1."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, every = batch.column("node"), texts_of(batch)
            for start in range(0, len(every), 2000):
                found = [np.unique(shingles(t)) for t in every[start : start + 2000]]
                owner = np.repeat(np.arange(start, start + len(found)), [len(f) for f in found])
                hashes = np.concatenate(found)
                columns = [nodes.take(pa.array(owner)), pa.array(hashes.view(np.int64)), pa.array(np.ones(len(hashes), dtype=np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "element", "weight"])

    return texts.select("node", "text").mapInArrow(spell, "node long, element long, weight long")


def similar(a: np.ndarray, b: np.ndarray, percent: int = SIMILARITY) -> bool:
    """Whether the Jaccard similarity of two sets, sorted and without repeats, reaches percent."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def verified(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, text_a, text_b) whose texts are similar, as (a, b)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            keep = []
            one, two = batch.column("text_a"), batch.column("text_b")
            for i, node in enumerate(batch.column("a").to_pylist()):
                if node != last:
                    last, left = node, np.unique(shingles(one[i].as_py()))
                keep.append(similar(left, np.unique(shingles(two[i].as_py()))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(check, "a long, b long")


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, of, start, stop, group, stays) of the paragraphs that have a near copy; `group` is the first one's id.

    Equal paragraphs are one numbered node, so that what is shuffled of each is eight bytes a band.
    """
    in_batches(docs.sparkSession, TEXTS_AT_ONCE)
    every = stage(paragraphs(docs), "zstd")
    nodes = every.groupBy("digest").agg(F.first("bands").alias("bands"), F.count("*").alias("n"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()))
    forget_shuffles(docs.sparkSession)

    def texts(wanted: DataFrame) -> DataFrame:
        named = nodes.select("node", "digest").join(wanted, "node", "left_semi")
        return every.groupBy("digest").agg(F.first("text").alias("text")).join(named, "digest").select("node", "text")

    roots = linked(nodes.select(F.explode("bands").alias("band"), "node"), texts, verified, elements, SIMILARITY)
    # what is there twice or has a link is of a group of two or more
    grouped = nodes.select("digest", "node", "n").join(roots, "node", "left").where("n > 1 or root is not null")
    placed = stage(grouped.select("digest", F.coalesce("root", "node").alias("root")))
    found = stage(every.select("doc_id", "of", "start", "stop", "digest").join(placed, "digest").drop("digest"))
    forget_shuffles(docs.sparkSession)
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "of", "start")
    found = found.join(found.groupBy("root").agg(F.min(order).alias("first")), "root")
    stays = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.of") == F.col("of")) & (F.col("first.start") == F.col("start"))
    return found.select("doc_id", "of", "start", "stop", F.col("first.doc_id").alias("group"), stays.alias("stays"))


@pandas_udf(StringType())
def without(text: pd.Series, gone: pd.Series) -> pd.Series:
    """Each text without the ranges of bytes given as start, stop, start, stop, ...; null where the text is."""

    def left(text: str | None, ranges) -> str | None:
        if text is None:
            return None
        data, at, kept = text.encode("utf-8", "surrogatepass"), 0, []
        for start, stop in np.sort(np.asarray(ranges).reshape(-1, 2), axis=0).tolist():
            kept.append(data[at:start])
            at = stop
        return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")

    return pd.Series([left(t, g) for t, g in zip(text, gone, strict=True)], dtype=object)


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with columns __repeated, __removed (numbers of paragraphs) and __kept (the text without those removed)."""
    found = repeated(docs).distinct()
    by_doc = found.groupBy("doc_id", "of").agg(
        F.count("*").alias("__repeated"), F.flatten(F.collect_list(F.when(~F.col("stays"), F.array("start", "stop")))).alias("__gone")
    )
    by_doc = by_doc.withColumnRenamed("doc_id", "__id").withColumnRenamed("of", "__of")
    text = F.col("text").cast("string")
    rows = docs.withColumn("__node", node_of(text))
    rows = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__node") == F.col("__of")), "left")
    touched = F.size("__gone") > 0
    kept = F.when(touched, without(F.when(touched, text), "__gone")).otherwise(text)
    return rows.select(
        *docs.columns,
        F.coalesce("__repeated", F.lit(0)).alias("__repeated"),
        F.coalesce((F.size("__gone") / 2).cast("long"), F.lit(0)).alias("__removed"),
        kept.alias("__kept"),
    )


def removal(docs: DataFrame) -> DataFrame:
    """doc_id, n_repeated, n_removed, n_bytes, n_bytes_kept, kept_sha256 for every row of docs."""
    found = deduplicated(docs.select("doc_id", "text"))
    kept = F.coalesce("__kept", F.lit(""))
    return found.select(
        "doc_id",
        F.col("__repeated").cast("long").alias("n_repeated"),
        F.col("__removed").alias("n_removed"),
        F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("n_bytes"),
        F.octet_length(kept).cast("long").alias("n_bytes_kept"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )
