"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its own characters and of the lines before and
after it. The field labels lines good or bad; forward-backward gives each line
the probability of good, and their mean weighted by line length is the document's
quality, which a logistic step maps to the labels' scale. The field is fitted on
the driver on a bounded sample: at most `SAMPLE_DOCS` labelled documents, those
with the smallest hashes, rows that agree counting once, each line taking its
document's label. Of a document above `SAMPLE_LINES` lines two runs of half as many
teach, its first lines and later ones that a hash chooses. Scoring covers all lines
of all texts.

Defined cases: null and empty texts are one empty line and get a score too;
labels that are null are left out, of several labels of one id the largest
counts; without labelled rows of both kinds every score is the share of label 1
(1 without any label). Other columns pass through or are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from postline.llm.common import TEXTS_AT_ONCE, code_points, in_batches, in_bulk, remainder, ship, texts_of, unpacked

SAMPLE_DOCS = 4000
SAMPLE_LINES = 200
FOLDS = 5
KEEP_FROM = 0.3
#: Characters handled in one go.
AT_ONCE = 1_000_000
#: Classes of characters that line features count.
GROUPS = {"blank": " \t\r\x0b\x0c", "symbol": "#*$%&", "bar": "|<>", "loud": "!?", "stop": ".,;:'\"()-"}
LOWER, UPPER, DIGIT, OTHER, BLANK = range(5)
N_CLASSES = 5 + len(GROUPS) - 1
N_FEATURES = 13


def class_table() -> np.ndarray:
    """Class of each code point up to 0x24F; beyond, all are `other` letters."""
    kinds = np.full(0x250, OTHER, dtype=np.int64)
    for c in map(chr, range(0x250)):
        kinds[ord(c)] = DIGIT if c.isdigit() else UPPER if c.isupper() else LOWER if c.isalpha() else OTHER
    for k, chars in enumerate(GROUPS.values()):
        for c in chars:
            kinds[ord(c)] = BLANK + k
    return kinds


def line_counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each line, its counts per class, words and words like the one before, its hash), whole documents at a time."""
    kinds = class_table()
    held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    base = mix_base(AT_ONCE + 1)
    for run in in_bulk(texts, AT_ONCE):
        points = code_points("\n".join(piece for _, piece, _ in run))
        ends = points == 10
        line = np.cumsum(ends) - ends
        lines = int(line[-1]) + 1 if len(line) else 1
        lines += bool(len(ends) and ends[-1])
        kind = kinds[np.minimum(points, 0x24F)]
        kind[points > 0x24F] = LOWER
        inside = ~ends
        counts = np.bincount(line[inside] * N_CLASSES + kind[inside], minlength=lines * N_CLASSES).reshape(lines, N_CLASSES)
        gap = ends | (kind == BLANK)
        starts = ~gap
        starts[1:] &= gap[:-1]
        words = np.bincount(line[starts], minlength=lines)
        begin = np.flatnonzero(starts)
        again = np.zeros(lines, dtype=np.int64)
        if len(begin):
            word = np.cumsum(starts) - 1
            spell = base[np.minimum(np.arange(len(points)) - begin[np.maximum(word, 0)], AT_ONCE)] * (points.astype(np.uint64) + np.uint64(1))
            spell[gap] = 0
            spelt = np.add.reduceat(spell, begin)
            twice = np.flatnonzero((spelt[1:] == spelt[:-1]) & (line[begin[1:]] == line[begin[:-1]])) + 1
            again = np.bincount(line[begin[twice]], minlength=lines)
        first = np.concatenate([[0], np.flatnonzero(ends) + 1])
        place = np.arange(len(points)) - first[line] if len(points) else np.zeros(0, dtype=np.int64)
        power = base[np.minimum(place, AT_ONCE)] * (points.astype(np.uint64) + np.uint64(1))
        power[ends] = 0
        total = np.concatenate([[np.uint64(0)], np.cumsum(power, dtype=np.uint64)])
        stop = np.concatenate([np.flatnonzero(ends), [len(points)]])
        hashes = total[stop] - total[first]
        row = np.repeat([r for r, _, _ in run], [piece.count("\n") + 1 for _, piece, _ in run])
        found = (row, np.column_stack([counts, words, again]), hashes)
        if held is not None:
            if run[0][2]:  # the first line goes on where the last one was cut
                found[1][0] += held[1][-1]
                found[2][:1] = found[2][:1] * np.uint64(31) + held[2][-1:]
                held = tuple(a[:-1] for a in held)
            found = tuple(np.concatenate([a, b]) for a, b in zip(held, found, strict=True))
        last = np.searchsorted(found[0], found[0][-1])
        if last:
            yield tuple(a[:last] for a in found)
        held = tuple(a[last:] for a in found)
    if held is not None and len(held[0]):
        yield held


def mix_base(n: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64."""
    return np.cumprod(np.full(n, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def features(row: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line, length of each line)."""
    kind, words = counts[:, :N_CLASSES].astype(np.float64), counts[:, N_CLASSES].astype(np.float64)
    chars = kind.sum(1)
    letters = kind[:, LOWER] + kind[:, UPPER]
    order = np.lexsort((hashes, row))
    again = np.zeros(len(row))
    same = (row[order][1:] == row[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    again[order[1:][same]] = 1
    again[order[:-1][same]] = 1
    per_char, per_word = 1 / np.maximum(chars, 1), 1 / np.maximum(words, 1)
    own = np.column_stack(
        [
            np.log1p(chars), np.log1p(words), (chars - kind[:, BLANK]) * per_word, kind[:, UPPER] / np.maximum(letters, 1),
            kind[:, DIGIT] * per_char, kind[:, OTHER] * per_char, kind[:, BLANK + 1] * per_word, kind[:, BLANK + 2] * per_word,
            kind[:, BLANK + 3] * per_word, kind[:, BLANK + 4] * per_word, again * (words > 0), words == 0,
            counts[:, N_CLASSES + 1] * per_word,
        ]
    )
    return own.astype(np.float32), chars


@dataclass(frozen=True)
class Field:
    """Weights of a fitted field: emission of good over bad, transitions, logistic step."""

    center: np.ndarray
    scale: np.ndarray
    emit: np.ndarray
    move: np.ndarray
    slope: float
    shift: float

    def inputs(self, own: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Own features, those of the neighbouring lines of the same document, and 1."""
        x = (own - self.center) / self.scale
        before, after = np.zeros_like(x), np.zeros_like(x)
        same = row[1:] == row[:-1]
        before[1:][same] = x[:-1][same]
        after[:-1][same] = x[1:][same]
        return np.hstack([x, before, after, np.ones((len(x), 1))])

    def quality(self, own: np.ndarray, row: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, length-weighted mean probability of good)."""
        marginal, _, _ = forward_backward(self.inputs(own, row) @ self.emit, self.move, row)
        rows, first = np.unique(row, return_index=True)
        weight = length + 1
        return rows, np.add.reduceat(marginal * weight, first) / np.add.reduceat(weight, first)

    def score(self, quality: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * logit(quality) + self.shift)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def forward_backward(emission: np.ndarray, move: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(probability of good per line, expected transitions 2x2, log of the normaliser).

    Lines of a document are consecutive. All documents of the call step together,
    the longest first, so that step t works on those with more than t lines.
    """
    _, first, n = np.unique(row, return_index=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    first, n = first[order], n[order]
    active = np.searchsorted(-n, -np.arange(n[0]), "left")  # documents with more than t lines
    weight = np.exp(np.column_stack([np.minimum(-emission / 2, 60), np.minimum(emission / 2, 60)]))
    step = np.exp(move)
    alpha, beta, scale = np.empty_like(weight), np.ones_like(weight), np.empty(len(weight))
    for t in range(n[0]):
        at = first[: active[t]] + t
        now = weight[at] * (alpha[at - 1] @ step if t else 1.0)
        scale[at] = now.sum(1)
        alpha[at] = now / scale[at][:, None]
    for t in range(n[0] - 2, -1, -1):
        at = first[: active[t + 1]] + t
        beta[at] = (weight[at + 1] * beta[at + 1]) @ step.T / scale[at + 1][:, None]
    both = alpha * beta
    both /= both.sum(1, keepdims=True)
    pairs = np.flatnonzero(row[1:] == row[:-1])
    onward = (weight[pairs + 1] * beta[pairs + 1]) / scale[pairs + 1][:, None]
    expected = (alpha[pairs].T @ onward) * step
    return both[:, 1], expected, float(np.log(scale).sum())


def fit_field(own: np.ndarray, row: np.ndarray, length: np.ndarray, label: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> Field:
    """Maximise the labels' conditional likelihood. label: of each line, its document's."""
    scale = own.std(0) + 1e-3
    field = Field(own.mean(0), scale, np.zeros(3 * own.shape[1] + 1), np.zeros((2, 2)), 1.0, 0.0)
    x = field.inputs(own, row)
    same = row[1:] == row[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[:-1][same], label[1:][same]), 1)
    w = np.concatenate([field.emit, field.move.ravel()])
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        p, expected, _ = forward_backward(x @ w[:-4], w[-4:].reshape(2, 2), row)
        slope = np.concatenate([x.T @ (label - p), (seen - expected).ravel()]) / len(row) - ridge * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        w = w + 0.1 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    field = Field(field.center, scale, w[:-4], w[-4:].reshape(2, 2), 1.0, 0.0)
    rows, quality = field.quality(own, row, length)
    y = label[np.searchsorted(row, rows)]
    z, a, b = logit(quality), 0.5, 0.0
    for _ in range(50):  # Newton steps of the logistic map, held back by a small ridge
        p = 1 / (1 + np.exp(-(a * z + b)))
        v = p * (1 - p)
        hess = np.array([[(v * z * z).sum() + 1, (v * z).sum()], [(v * z).sum(), v.sum() + 1]])
        a, b = np.array([a, b]) + np.linalg.solve(hess, [((y - p) * z).sum() - (a - 0.5), (y - p).sum() - b])
    return Field(field.center, scale, field.emit, field.move, float(a), float(b))


def teaching(lines: np.ndarray, most: int = SAMPLE_LINES) -> list[np.ndarray]:
    """The runs of a document's lines that teach: all, or the first and a later one of half of `most` lines each."""
    if len(lines) <= most:
        return [lines]
    half = most // 2
    start = half + crc32(lines.tobytes()) % (len(lines) - 2 * half + 1)
    return [lines[:half], lines[start : start + half]]


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, folds: int = FOLDS) -> Field | float:
    """The field, or the share of label 1 where there are not both kinds of labels."""
    in_batches(docs.sparkSession, TEXTS_AT_ONCE)
    chosen = (
        labels.where("quality is not null and doc_id is not null")
        .where(remainder("doc_id", folds) != 0)
        .groupBy(F.col("doc_id").alias("labelled_id"))
        .agg(F.max("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("labelled_id"))
        .limit(sample_docs)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    # one id may stand in any number of rows: the bound is on rows
    sample = sample.dropDuplicates(["doc_id", "text"]).orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(sample_docs)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.array(batch.column("label"))
            for row, counts, hashes in line_counts(texts_of(batch)):
                own, length = features(row, counts, hashes)
                rows, first = np.unique(row, return_index=True)
                data = [teaching(m) for m in np.split(np.column_stack([own, length]).astype(np.float32), first[1:])]
                many = np.repeat(label[rows], [len(d) for d in data])
                yield pa.RecordBatch.from_arrays([pa.array(many, pa.int32()), pa.array([m.tobytes() for d in data for m in d], pa.binary())], ["label", "lines"])

    found = sample.select("label", "text").mapInArrow(describe, "label int, lines binary").collect()  # bounded, see above
    if len({r["label"] for r in found}) < 2:
        return float(found[0]["label"]) if found else 1.0
    found.sort(key=lambda r: bytes(r["lines"]))  # the same sums in every run
    lines = [np.frombuffer(r["lines"], dtype=np.float32).reshape(-1, N_FEATURES + 1) for r in found]
    row = np.repeat(np.arange(len(lines)), [len(m) for m in lines])
    every = np.vstack(lines)
    label = np.repeat([r["label"] for r in found], [len(m) for m in lines])
    return fit_field(every[:, :-1], row, every[:, -1].astype(np.float64), label)


def scores(field: Field | float, texts: list[str]) -> np.ndarray:
    out = np.full(len(texts), field if isinstance(field, float) else 0.0)
    if isinstance(field, Field):
        for row, counts, hashes in line_counts(texts):
            own, length = features(row, counts, hashes)
            rows, quality = field.quality(own, row, length)
            out[rows] = field.score(quality)
    return out


def with_score(docs: DataFrame, field: Field | float, name: str = "score", keep_from: float | None = None) -> DataFrame:
    """docs with the score as column `name`; with keep_from, only rows at or above it and no new column."""
    shipped = ship(docs.sparkSession, field)
    only = keep_from is not None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = unpacked(shipped)
        for batch in batches:
            found = scores(fitted, texts_of(batch))
            if only:
                yield batch.filter(pa.array(found >= keep_from))
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, name])

    schema = docs.schema if only else StructType([*docs.schema.fields]).add(name, DoubleType())
    return docs.mapInArrow(add, schema)


def held_out(folds: int = FOLDS) -> Column:
    return remainder("doc_id", folds) == 0


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    field = train(docs, labels)
    rows = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), field)
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the field does not reject, columns unchanged."""
    return with_score(docs, train(docs, labels), keep_from=KEEP_FROM)
