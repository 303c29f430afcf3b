"""Exact removal of repeated byte strings through enhanced suffix arrays of the places that can repeat.

1. Every text is sampled at places that its content alone decides: of each run
   of LENGTH bytes the place whose KEY following bytes have the smallest hash.
   So two equal runs are sampled at the same offset, and a run can only repeat
   if its place's hash occurs twice. Only hashes and positions are shuffled.
2. Around a place whose hash repeats lies its stretch: all runs it was sampled
   for. Stretches that are equal as a whole need no further work; of each
   different one a representative is fetched from the texts.
3. The stretches of one hash meet in one task, many hashes at a time. There a
   suffix array of their runs' beginnings is sorted, with the common prefixes
   of neighbours. A scan with a stack turns these into the tree of
   common-prefix intervals. An interval of LENGTH or more whose suffixes differ in
   the byte before is a maximal repeat; its occurrences are all its suffixes.
4. Each occurrence covers its bytes in all documents with that stretch.

A hash with more than SORTED different stretches is not sorted: its runs are
hashed (128 bits) in the task and equal ones found, which gives the same coverage
in bounded memory. One with more than GROUP is never gathered in a task: Spark
counts the hashes of its runs.

Defined cases: a null text is empty; texts below LENGTH bytes keep all; rows equal
in id and text are occurrences of their own and get equal results; matches never
cross texts. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from postline.llm.common import TEXTS_AT_ONCE, in_batches, mix, stage

LENGTH = 200
KEY = 64
#: Different stretches of one hash that are sorted at most, and that a task gathers at most (about 15 MB).
SORTED = 2000
GROUP = 50_000
#: Bytes of stretches that are sorted in one go.
AT_ONCE = 800_000
FACTOR = 0x9E3779B97F4A7C15
#: Bytes of a text that are sampled in one go.
PIECE = 1 << 20
#: Low bits of a hash that give way to the place; they hold any place of a piece.
PLACE_BITS = np.uint64((1 << 23) - 1)
OTHER_FACTOR = 0xD6E8FEB86659FD93


class Rolling:
    """Hashes of any part of a byte string, by prefix sums modulo 2**64."""

    def __init__(self, most: int, factor: int = FACTOR) -> None:
        self.powers = np.cumprod(np.full(most + 1, factor, dtype=np.uint64), dtype=np.uint64)
        self.back = np.cumprod(np.full(most + 1, pow(factor, -1, 1 << 64), dtype=np.uint64), dtype=np.uint64)
        self.values = mix(np.arange(256, dtype=np.uint64) + np.uint64(factor & 0xFFFF))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def part(self, sums: np.ndarray, start: np.ndarray | slice, stop: np.ndarray | slice, at: np.ndarray | slice) -> np.ndarray:
        return mix((sums[stop] - sums[start]) * self.back[at])


def sampled(data: np.ndarray, rolling: Rolling, length: int = LENGTH, key: int = KEY) -> tuple[np.ndarray, ...]:
    """(hash, begin, size, hash of the stretch) of each sampled place of a text, in order.

    The place of a run is where the KEY bytes with the smallest hash begin, the
    first of equals. Runs of one place follow each other, from `begin` on.
    """
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64, np.uint64))
    sums = rolling.sums(data)
    hashes = rolling.part(sums, slice(0, n - key + 1), slice(key, n + 1), slice(0, n - key + 1))
    least = (hashes & ~PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    width, wanted = 1, length - key + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    place = (least & PLACE_BITS).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    end = np.append(begin[1:], len(place)) - 1 + length
    return hashes[place[begin]], begin, end - begin, rolling.part(sums, begin, end, begin)


def places(docs: DataFrame, length: int = LENGTH, key: int = KEY) -> DataFrame:
    """(doc, hash, begin, size, stretch) of all sampled places; docs: (doc, text)."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(PIECE + length)
        for batch in batches:
            names, parts, who, size = batch.column("doc"), [], [], 0
            for i, text in enumerate(batch.column("text")):
                data = np.frombuffer((text.as_py() or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
                for start in range(0, max(1, len(data)), PIECE):
                    found = sampled(data[start : start + PIECE + length - 1], rolling, length, key)
                    parts.append((found[0], found[1] + start, *found[2:]))
                    who.append(np.full(len(found[0]), i))
                    size += len(found[0])
                if size > 100_000:
                    yield gathered(names, parts, who)
                    parts, who, size = [], [], 0
            if parts:
                yield gathered(names, parts, who)

    def gathered(names: pa.Array, parts: list, who: list) -> pa.RecordBatch:
        hashes, begin, size, stretch = (np.concatenate(c) for c in zip(*parts, strict=True))
        columns = [
            names.take(pa.array(np.concatenate(who))), pa.array(hashes.view(np.int64)), pa.array(begin),
            pa.array(size.astype(np.int32)), pa.array(stretch.view(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc", "hash", "begin", "size", "stretch"])

    return docs.mapInArrow(sample, "doc long, hash long, begin long, size int, stretch long")


def suffix_array(stretches: list[bytes], group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, offset, common prefix with the suffix before) of the sorted suffixes that are `length` or longer.

    Suffixes are sorted within the group of their stretch; prefixes are never
    common across groups.
    """
    order: list[tuple[int, int]] = []
    common: list[np.ndarray] = []
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    for first, stop in zip(begin, np.append(begin[1:], len(group)), strict=True):
        rows = [(s[o:], i, o) for i, s in enumerate(stretches[first:stop], first) for o in range(len(s) - length + 1)]
        rows.sort()
        order += [(i, o) for _, i, o in rows]
        common.append(common_prefixes([s for s, _, _ in rows]))
    stretch, offset = np.array(order, dtype=np.int64).reshape(-1, 2).T
    return stretch, offset, np.concatenate(common) if common else np.zeros(0, dtype=np.int64)


def common_prefixes(rows: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each row with the row before; 0 for the first."""
    size = np.array([len(r) for r in rows])
    width = int(size.max())
    grid = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), dtype=np.uint8).reshape(len(rows), width)
    differ = grid[1:] != grid[:-1]
    first = np.where(differ.any(1), differ.argmax(1), width)
    return np.concatenate([[0], np.minimum(first, np.minimum(size[1:], size[:-1]))])


def intervals(common: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(prefix length, first, last) of the common-prefix intervals of `least` or longer, by one scan with a stack."""
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []  # (prefix, first), prefixes rising
    for i, prefix in enumerate([*common.tolist(), 0]):
        first = i - 1
        while stack and stack[-1][0] > prefix:
            height, first = stack.pop()
            found.append((height, first, i - 1))
        if prefix >= least and (not stack or stack[-1][0] < prefix):
            stack.append((prefix, first))
    return found


def maximal_repeats(stretches: list[bytes], group: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(repeat length, stretches, offsets) of the strings of `length` or more that cannot be made longer on either side.

    Each comes with all its occurrences. An interval whose suffixes all follow
    the same byte is left out: the interval of the longer string to its left has it.
    """
    stretch, offset, common = suffix_array(stretches, group, length)
    before = np.array([stretches[i][o - 1] if o else -1 for i, o in zip(stretch.tolist(), offset.tolist(), strict=True)], dtype=np.int64)
    for prefix, first, last in intervals(common, length):
        left = before[first : last + 1]
        if left[0] < 0 or (left != left[0]).any():
            yield prefix, stretch[first : last + 1], offset[first : last + 1]


def equal_runs(stretches: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, int]]:
    """(stretch, offset) of the runs of `length` bytes that occur more than once in the stretches."""
    data = np.frombuffer(b"".join(stretches), dtype=np.uint8)
    size = np.array([len(s) for s in stretches])
    runs = np.maximum(size - length + 1, 0)
    which = np.repeat(np.arange(len(stretches)), runs)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = np.repeat(np.cumsum(size) - size, runs) + offset
    hashes = []
    for factor in (FACTOR, OTHER_FACTOR):
        rolling = Rolling(len(data), factor)
        hashes.append(rolling.part(rolling.sums(data), at, at + length, at))
    order = np.lexsort(hashes)
    same = (hashes[0][order][1:] == hashes[0][order][:-1]) & (hashes[1][order][1:] == hashes[1][order][:-1])
    again = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    yield from zip(which[again].tolist(), offset[again].tolist(), strict=True)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            if stop > out[-1][1]:
                out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
    return out


def in_groups(batches: Iterator[pa.RecordBatch], most: int = SORTED, at_once: int = AT_ONCE) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Rows (hash, stretch, bytes) sorted by hash, in runs of whole hashes of about at_once bytes.

    A hash with more than `most` rows comes alone.
    """
    held: tuple[list[int], list[int], list[bytes]] = ([], [], [])
    size = 0
    for group in one_by_one(batches):
        large = len(group[0]) > most
        if held[0] and (large or size > at_once):
            yield held
            held, size = ([], [], []), 0
        if large:
            yield group
            continue
        for kept, new in zip(held, group, strict=True):
            kept.extend(new)
        size += sum(map(len, group[2]))
    if held[0]:
        yield held


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """The rows of one hash after the other."""
    group: tuple[list[int], list[int], list[bytes]] = ([], [], [])
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("hash", "stretch", "bytes")), strict=True):
            if group[0] and row[0] != group[0][-1]:
                yield group
                group = ([], [], [])
            for kept, new in zip(group, row, strict=True):
                kept.append(new)
    if group[0]:
        yield group


def repeats(fetched: DataFrame, length: int = LENGTH, most: int = SORTED) -> DataFrame:
    """fetched (hash, stretch, bytes) as (hash, stretch, start, stop): what repeats, from the beginning of the stretch."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, names, data in in_groups(batches, most):
            spans: dict[int, list[tuple[int, int]]] = {}
            if len(data) > most and hashes[0] == hashes[-1]:
                for i, o in equal_runs(data, length):
                    spans.setdefault(i, []).append((o, o + length))
            else:
                for size, stretch, offset in maximal_repeats(data, np.array(hashes), length):
                    for i, o in zip(stretch.tolist(), offset.tolist(), strict=True):
                        spans.setdefault(i, []).append((o, o + size))
            rows = [(hashes[i], names[i], *span) for i, found in spans.items() for span in merged(found)]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["hash", "stretch", "start", "stop"])

    grouped = fetched.repartition("hash").sortWithinPartitions("hash")
    return grouped.mapInArrow(find, "hash long, stretch long, start long, stop long")


def run_repeats(fetched: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same for hashes with very many stretches: every run is hashed, and Spark counts the hashes."""

    def hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for h, s, data in zip(*(batch.column(c).to_pylist() for c in ("hash", "stretch", "bytes")), strict=True):
                out += [(h, s, o, hashlib.md5(data[o : o + length]).digest()) for o in range(len(data) - length + 1)]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["hash", "stretch", "start", "run"])

    runs = fetched.select("hash", "stretch", "bytes").mapInArrow(hash_runs, "hash long, stretch long, start long, run binary")
    twice = runs.groupBy("run").agg(F.count("*").alias("n")).where("n > 1").select("run")
    return runs.join(twice, "run").select("hash", "stretch", "start", (F.col("start") + length).alias("stop"))


def fetch(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """wanted (doc, hash, stretch, begin, size, many) with the bytes of the stretch; texts: (doc, packed)."""
    by_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("hash", "stretch", "begin", "size", "many")).alias("parts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for parts, packed in zip(batch.column("parts").to_pylist(), batch.column("packed"), strict=True):
                data = unpack(packed)
                out += [(p["hash"], p["stretch"], p["many"], data[p["begin"] : p["begin"] + p["size"]]) for p in parts]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["hash", "stretch", "many", "bytes"])

    found = texts.join(by_doc, "doc").select("parts", "packed").mapInArrow(cut, "hash long, stretch long, many boolean, bytes binary")
    return found.dropDuplicates(["hash", "stretch"])


def pack(docs: DataFrame) -> DataFrame:
    """docs (doc, text, ...) with the text's bytes compressed as `packed`, the way they are shuffled."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeezer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [squeezer.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column("text")]
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(packed, pa.binary())], [*rest, "packed"])

    schema = StructType([f for f in docs.schema.fields if f.name != "text"]).add("packed", BinaryType())
    return docs.mapInArrow(squeeze, schema)


def unpack(packed: pa.Scalar) -> bytes:
    import zstandard

    return zstandard.decompress(packed.as_py())


def doc_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit("")))


def covered(docs: DataFrame, length: int = LENGTH, key: int = KEY, group: int = GROUP, most: int = SORTED) -> DataFrame:
    """(doc, spans): for each text with repeats the byte spans they cover; docs: (doc, text)."""
    every = places(docs, length, key)
    # written first: a join of two plain tables lets Spark split a hash with very many places
    twice = stage(every.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    rows = stage(every.join(twice, "hash"))
    kinds = stage(
        rows.groupBy("hash", "stretch").agg(F.count("*").alias("copies"), F.min(F.struct("doc", "begin", "size")).alias("one"))
    )
    many = kinds.groupBy("hash").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = kinds.join(many, "hash").select(
        F.col("one.doc").alias("doc"), "hash", "stretch", F.col("one.begin").alias("begin"), F.col("one.size").alias("size"),
        (F.col("kinds") > group).alias("many"),
    )
    fetched = stage(fetch(wanted, pack(docs)))
    whole = kinds.where("copies > 1").select("hash", "stretch", F.lit(0).cast("long").alias("start"), F.col("one.size").cast("long").alias("stop"))
    found = whole.unionByName(repeats(fetched.where("not many"), length, most)).unionByName(run_repeats(fetched.where("many"), length))
    spans = rows.join(stage(found), ["hash", "stretch"]).select(
        "doc", (F.col("begin") + F.col("start")).alias("start"), (F.col("begin") + F.col("stop")).alias("stop")
    )
    return spans.groupBy("doc").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def without_repeats(
    docs: DataFrame, keep: list[str], length: int = LENGTH, key: int = KEY, group: int = GROUP, most: int = SORTED
) -> DataFrame:
    """The columns `keep` of docs, and n_bytes, n_removed, n_spans, kept (the bytes that are left)."""
    in_batches(docs.sparkSession, TEXTS_AT_ONCE)
    slim = docs.withColumn("doc", doc_key()).withColumn("text", F.col("text").cast("string"))
    spans = stage(covered(slim.select("doc", "text"), length, key, group, most))
    rest = [c for c in keep if c != "text"]
    marked = slim.select("doc", F.struct(*rest).alias("row") if rest else F.lit(True).alias("row"), "text")
    joined = pack(marked).join(spans, "doc", "left").select("row", "packed", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for packed, spans_ in zip(batch.column("packed"), batch.column("spans").to_pylist(), strict=True):
                data = unpack(packed)
                gone = merged([(s["start"], s["stop"]) for s in spans_ or ()])
                edges = [0, *(e for span in gone for e in span), len(data)]
                left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(data), len(data) - len(left), len(gone), left))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                ["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = StructType([joined.schema["row"]]).add("n_bytes", LongType()).add("n_removed", LongType()).add("n_spans", LongType())
    return joined.mapInArrow(cut, schema.add("kept", BinaryType()))


def removal(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs."""
    found = without_repeats(docs.select("doc_id", "text"), ["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with repeated byte strings removed from the texts, columns unchanged.

    Where a removal ends inside a character, the rest of that character goes
    too. n_chars, where there is such a column, follows the text.
    """
    rest = [c for c in docs.columns if c != "text"]
    found = without_repeats(docs, rest)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [k.as_py().decode("utf-8", "ignore") for k in batch.column("kept")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    decoded = found.select("row", "kept").mapInArrow(decode, StructType([found.schema["row"]]).add("text", StringType()))
    columns = {c: F.col("row").getField(c) for c in rest} | {"text": F.col("text")}
    if "n_chars" in rest:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return decoded.select(*(columns[c].alias(c) for c in docs.columns))
