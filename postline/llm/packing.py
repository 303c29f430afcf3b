"""Packing tokenised documents into sequences by patterns.

Documents are tokenised in tasks and cut into pieces of at most the sequence
length. Only the histogram of piece lengths (one number per length) reaches the
driver. There patterns of few lengths that fill a sequence are enumerated, their
repeat counts fitted to the histogram by non-negative least squares and rounded
down, and the rest is packed best-fit, largest first, whole histogram entries at
a time. The plan says for each length which ranks go to which sequences; tasks
number the pieces of a length and look their places up.

Defined cases: a null or empty text is a document of the end id alone; a text that
holds the string of an added token gets that token's id there; rows that
agree in all columns are packed each on its own; an empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postline.llm.common import TEXTS_AT_ONCE, in_batches, stage

LENGTH = 2048
#: Distinct texts between two blanks whose ids a worker remembers at most.
REMEMBERED = 300_000
#: Characters that are tokenised in one go.
AT_ONCE = 1_000_000
SAFE_CUT = re.compile(r"\S \S")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path() -> str:
    """The public vocabulary the queries use, as ranks; with the added tokens it equals byte_bpe_50k.json id for id."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    """Strings the public vocabulary keeps whole, with their ids; its rank file has no place for them."""
    from postline.llm import bpe

    return {t["content"]: t["id"] for t in bpe.read_file(bpe.vocabulary_path())["added_tokens"]}


def encoder(path: str, added: dict[str, int] | None = None) -> Callable[[str], bytes]:
    """Little-endian 32-bit ids of a text, by the byte-level vocabulary at path.

    The strings of added tokens become their ids; what is between two of them
    is encoded as a text of its own.

    A token never spans the place between a character that is no white space
    and a blank before another such character. So a text is cut there, and the
    ids of each cut are remembered.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    rules = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    known: dict[str, bytes] = {}

    def whole(text: str) -> bytes:
        return np.array(rules.encode_ordinary(text), dtype="<u4").tobytes()

    def ids(text: str) -> bytes:
        first, *rest = text.split(" ")
        found = list(map(known.get, rest))
        if None in found:
            if len(known) > REMEMBERED:
                known.clear()
            for i, part in enumerate(rest):
                if found[i] is None:
                    if (not part and i + 1 < len(rest)) or part[:1].isspace():
                        return whole(text)
                    found[i] = known.get(part)
                    if found[i] is None:
                        found[i] = whole(" " + part)
                        if part:
                            known[part] = found[i]
        return whole(first) + b"".join(found)

    added = added_tokens() if added is None else added
    cuts = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
    added_ids = {t: np.array([i], dtype="<u4").tobytes() for t, i in added.items()}

    def encode(text: str) -> bytes:
        if cuts and cuts.search(text):
            pieces = cuts.split(text)
            return b"".join(added_ids[p] if k % 2 else between(p) for k, p in enumerate(pieces))
        return between(text)

    def between(text: str) -> bytes:
        if len(text) <= AT_ONCE:
            return ids(text)
        out, start = [], 0
        while len(text) - start > AT_ONCE:
            at = SAFE_CUT.search(text, start + AT_ONCE)
            if at is None:
                break
            out.append(ids(text[start : at.start() + 1]))
            start = at.start() + 1
        return b"".join([*out, ids(text[start:])])

    return encode


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    in_batches(docs.sparkSession, TEXTS_AT_ONCE)
    path, added = path or tokenizer_path(), added_tokens() if path is None else {}
    end = int(end_id).to_bytes(4, "little")
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, added)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                data = memoryview(encode(text.as_py() or "") + end)
                n = len(data) // 4
                first = (n - 1) % length + 1
                edges = [0, *range(first, n + 1, length)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    out.append((doc, k, a, b - a, zlib.crc32(data[4 * a : 4 * b])))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def pack(cut: DataFrame, length: int = LENGTH, buckets: int = 1024) -> DataFrame:
    """cut with sequence_id and offset."""
    rows = stage(cut.withColumn("row", F.monotonically_increasing_id()).withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets))))
    counts = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = np.zeros(length + 1, dtype=np.int64)
    for size, n in starts.groupBy("length").agg(F.sum("n")).collect():  # one row per length
        histogram[size] = n
    plan = plan_places(histogram)
    ranked = rows.join(starts.drop("n"), ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
         ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, sequence, offset = plan
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = lookup(key, first, size, rank)
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])], schema=schema)

    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.select(*columns).mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def lookup(key: np.ndarray, first: np.ndarray, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Index of the plan entry that holds each (length, rank); entries are sorted by both."""
    begin, stop = np.searchsorted(key, size, "left"), np.searchsorted(key, size, "right") - 1
    while np.any(begin < stop):
        middle = (begin + stop + 1) // 2
        right = first[middle] <= rank
        begin, stop = np.where(right, middle, begin), np.where(right, stop, middle - 1)
    return begin


def patterns(histogram: np.ndarray, partners: int = 24) -> np.ndarray:
    """Rows of up to three lengths that fill a sequence exactly, 0 where there is none.

    Pairs are enumerated all; triples with up to `partners` second lengths for
    each first one, spread evenly over those that occur.
    """
    whole = len(histogram) - 1
    there = np.flatnonzero(histogram[:whole])
    there = there[there > 0]
    rows = [(a, whole - a, 0) for a in there if 2 * a >= whole and histogram[whole - a]]
    for a in there:
        second = there[(there <= a) & (there >= (whole - a + 1) // 2) & (there < whole - a)]
        if len(second):
            for b in second[np.unique(np.linspace(0, len(second) - 1, partners).astype(int))]:
                if histogram[whole - a - b]:
                    rows.append((a, b, whole - a - b))
    return np.array(rows, dtype=np.int64).reshape(-1, 3)


def fit(found: np.ndarray, histogram: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Non-negative repeat counts x that bring the patterns' use of each length near the histogram.

    Least squares by multiplicative steps x <- x (A'h) / (A'Ax), which keep x
    non-negative; A is held as the rows of lengths.
    """
    h = histogram.astype(np.float64)
    h[0] = 0
    used = found > 0
    goal = np.where(used, h[found], 0).sum(1)
    x = np.where(used, h[found], np.inf).min(1) / 4
    for _ in range(rounds):
        use = np.zeros(len(h))
        for k in range(found.shape[1]):
            use += np.bincount(found[:, k], weights=x, minlength=len(h))
        use[0] = 0
        x *= goal / np.maximum(np.where(used, use[found], 0).sum(1), 1e-9)
    return x


def plan_places(histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each (length, from rank): the sequence of that rank and the offset in it.

    Ranks of an entry go to consecutive sequences. Sorted by length and rank.
    """
    whole = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    taken = np.zeros_like(left)
    entries: list[tuple[int, int, int, int]] = []
    sequences = 0

    def use(size: int, n: int, sequence: int, offset: int) -> None:
        entries.append((size, int(taken[size]), sequence, offset))
        taken[size] += n
        left[size] -= n

    if left[whole]:
        n = int(left[whole])
        use(whole, n, 0, 0)
        sequences = n
    found = patterns(left)
    if len(found):
        repeats = np.floor(fit(found, left)).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            sizes = [int(s) for s in found[k] if s]
            n = min([int(repeats[k]), *(int(left[s]) // sizes.count(s) for s in sizes)])
            if n <= 0:
                continue
            offset = 0
            for s in sizes:
                use(s, n, sequences, offset)
                offset += s
            sequences += n
    open_groups: list[list[tuple[int, int]]] = [[] for _ in range(whole + 1)]  # by room left: (first sequence, how many)
    rooms = 0  # bit r is set while a group with room r is open
    for size in range(whole - 1, 0, -1):
        while left[size]:
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                first, n = open_groups[room].pop()
                k = min(n, int(left[size]))
                if k < n:
                    open_groups[room].append((first + k, n - k))
                if not open_groups[room]:
                    rooms &= ~(1 << room)
            else:
                room, first = whole, sequences
                k = -(-int(left[size]) // (whole // size))
                sequences += k
            use(size, k, first, whole - room)
            if room - size:
                open_groups[room - size].append((first, k))
                rooms |= 1 << (room - size)
    table = np.array(sorted(entries), dtype=np.int64).reshape(-1, 4)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), table[:, 3].copy()
