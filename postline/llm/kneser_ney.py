"""Kneser-Ney character models, counted on Spark and held in sorted hash arrays.

Characters are hashed to 64 symbols, four of them make a gram of 24 bits. So a
model has at most 2**24 grams whatever the corpus, and a gram's hash holds those
of its context and its suffix: they are its leading and its trailing bits.

Where no two characters may share a symbol, each is spelled by one to LONGEST symbols
that no other character has. Grams stay those of 24 bits, and the log probability of a
character is the sum of those of its symbols.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.llm.common import code_points, in_bulk, texts_of

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
GRAMS = 1 << (ORDER * BITS)
GAP = 0
#: Characters handled in one go; of spelled ones, as many as have no more symbols.
AT_ONCE = 2_000_000
#: The most symbols that spell a character: the mark of a capital, that of a code point, its digits.
LONGEST = 7
CAPITAL, LINE_END, CODE_POINT = 27, 28, 29
#: Grave, acute, circumflex, tilde, diaeresis, ring, caron, cedilla.
ACCENTS = "\u0300\u0301\u0302\u0303\u0308\u030a\u030c\u0327"
MARKS = ".,-'\"():|"
FIRST_ACCENT, FIRST_MARK, FIRST_DIGIT = 30, 38, 48


def letters_only() -> np.ndarray:
    """Symbol of each code point: a to z their own, other letters hashed, all else one symbol, white space the gap."""
    symbols = np.full(0x110000, 27, dtype=np.int32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            symbols[c] = low - 96 if 97 <= low <= 122 else 28 + (low * 40503 >> 4) % (SYMBOLS - 28)
        elif ch.isspace():
            symbols[c] = GAP
    return symbols


@dataclass(frozen=True)
class Spelling:
    """Symbols of each code point, the first in the lowest bits, and how many they are."""

    symbols: np.ndarray
    length: np.ndarray

    def line(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of a text, where those of each character begin and the last end)."""
        points = code_points(text)
        size, left = self.length[points], self.symbols[points]
        edges = np.append(0, np.cumsum(size, dtype=np.int64))
        out = np.empty(edges[-1], dtype=np.int32)
        out[edges[:-1]] = left & (SYMBOLS - 1)
        more = np.flatnonzero(size > 1)
        for k in range(1, LONGEST):
            out[edges[more] + k] = left[more] >> (BITS * k) & (SYMBOLS - 1)
            more = more[size[more] > k + 1]
        return out, edges


def with_marks() -> Spelling:
    """Spelling of each code point, none like another: letters without case but capitals marked apart, accents after their
    letter, a line's end and common marks their own; all else is the mark of a code point and its hexadecimal digits.
    """
    point = np.arange(0x110000, dtype=np.int64)
    length = np.full(len(point), 2, dtype=np.uint8)
    symbols = np.full(len(point), CODE_POINT, dtype=np.int64)
    for k in range(1, 6):
        length += point >= 1 << (4 * k)
    for k in range(6):
        digit = FIRST_DIGIT + (point >> (4 * np.maximum(length.astype(np.int64) - 2 - k, 0)) & 15)
        symbols += np.where(k < length - 1, digit << (BITS * (k + 1)), 0)

    def spell(ch: str, *own: int) -> None:
        symbols[ord(ch)] = sum(x << (BITS * i) for i, x in enumerate(own))
        length[ord(ch)] = len(own)

    spell(" ", GAP)
    spell("\n", LINE_END)
    for i, ch in enumerate(MARKS):
        spell(ch, FIRST_MARK + i)
    for c in range(26):
        spell(chr(97 + c), 1 + c)
    for c in range(0xC0, 0x250):
        parts = unicodedata.normalize("NFD", chr(c))
        if len(parts) == 2 and "a" <= parts[0] <= "z" and parts[1] in ACCENTS:
            spell(chr(c), ord(parts[0]) - 96, FIRST_ACCENT + ACCENTS.index(parts[1]))
    for ch in map(chr, range(0x20000)):  # above are no capitals
        low = ch.lower()
        if ch != low and len(low) == 1 and low.upper() == ch:
            symbols[ord(ch)] = CAPITAL + (symbols[ord(low)] << BITS)
            length[ord(ch)] = length[ord(low)] + 1
    return Spelling(symbols, length)


def grams(texts: list[str], symbols: np.ndarray | Spelling) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, gram) of every symbol with the three before it; gaps stand before a text.

    Texts come in bounded runs; a text that goes on keeps its last symbols.
    """
    tail = np.zeros(ORDER - 1, dtype=np.int32)
    spelled = isinstance(symbols, Spelling)
    for run in in_bulk(texts, max(1, AT_ONCE // LONGEST) if spelled else AT_ONCE):
        parts, rows, skip = [], [], []
        text = "".join(piece for _, piece, _ in run)
        sizes = [len(piece) for _, piece, _ in run]
        if spelled:
            points, edges = symbols.line(text)
            sizes = np.diff(edges[np.append(0, np.cumsum(sizes))]).tolist()
        else:
            points = symbols[code_points(text)]
        at = 0
        for (_, _, goes_on), n in zip(run, sizes, strict=True):
            parts += [tail if goes_on else np.zeros(ORDER - 1, dtype=np.int32), points[at : at + n]]
            at += n
            tail = np.concatenate([parts[-2], parts[-1][-(ORDER - 1) :]])[-(ORDER - 1) :]
        rows = np.repeat([r for r, _, _ in run], np.array(sizes) + ORDER - 1)
        skip = np.concatenate([[0], np.cumsum(np.array(sizes) + ORDER - 1)])[:-1]
        line = np.concatenate(parts)
        gram = line.copy()
        for k in range(1, ORDER):
            gram[k:] += line[:-k] << (BITS * k)
        valid = np.ones(len(line), dtype=bool)
        for k in range(ORDER - 1):
            valid[skip + k] = False
        yield rows[valid], gram[valid]


def count_grams(docs: DataFrame, group: str, symbols: Callable[[], np.ndarray | Spelling]) -> DataFrame:
    """(group, gram, n) over all texts. Tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbols()
        slots = np.full(GRAMS, -1, dtype=np.int32)
        known = np.zeros(0, dtype=np.int32)
        totals: dict[str | None, np.ndarray] = {}
        for batch in batches:
            names = batch.column("__group").to_pylist()
            texts = texts_of(batch)
            for name in dict.fromkeys(names):
                total = totals.get(name, np.zeros(0, dtype=np.int64))
                for _, gram in grams([t for t, g in zip(texts, names, strict=True) if g == name], table):
                    new = np.unique(gram[slots[gram] < 0])
                    slots[new] = np.arange(len(known), len(known) + len(new), dtype=np.int32)
                    known = np.concatenate([known, new])
                    here = np.bincount(slots[gram], minlength=len(known))
                    here[: len(total)] += total
                    total = here
                totals[name] = total
        for name, total in totals.items():
            there = np.flatnonzero(total)
            for part in np.array_split(there, max(1, len(there) // 50_000)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(part), pa.string()), pa.array(known[part], pa.int32()), pa.array(total[part], pa.int64())],
                    ["group", "gram", "n"],
                )

    rows = docs.select(F.col(group).cast("string").alias("__group"), "text")
    return rows.mapInArrow(count, "group string, gram int, n long").groupBy("group", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """Per order: sorted gram hashes with their discounted shares, sorted context hashes with what is left for the order below."""

    grams: tuple[np.ndarray, ...]
    shares: tuple[np.ndarray, ...]
    contexts: tuple[np.ndarray, ...]
    left: tuple[np.ndarray, ...]

    def log10(self, gram: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each gram after the others."""
        p = np.full(len(gram), 1.0 / SYMBOLS)
        for k in range(ORDER):
            key = gram & ((1 << (BITS * (k + 1))) - 1)
            p = found(self.grams[k], self.shares[k], key, 0.0) + found(self.contexts[k], self.left[k], key >> BITS, 1.0) * p
        return np.log10(p)


def found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    if not len(keys):
        return np.full(len(wanted), default)
    return np.where(keys[at] == wanted, values[at], default)


def fit(gram: np.ndarray, n: np.ndarray, modified: bool) -> Model:
    """A model of counted grams of full length.

    Lower orders count in how many different grams a suffix stands. One discount
    per order, or with `modified` three, for counts of one, two and more.
    """
    order = np.argsort(gram)
    key, count = gram[order].astype(np.int64), n[order].astype(np.float64)
    out: list[tuple[np.ndarray, ...]] = []
    for k in range(ORDER, 0, -1):
        context, begin, member = np.unique(key >> BITS, return_index=True, return_inverse=True)
        total = np.add.reduceat(count, begin)
        cut = discounts(count, modified)[np.minimum(count, 3).astype(int)]
        cut = np.minimum(cut, count)
        freed = np.add.reduceat(cut, begin)
        out.append((key, (count - cut) / total[member], context, freed / total))
        key, count = np.unique(key & ((1 << (BITS * (k - 1))) - 1), return_counts=True)
        count = count.astype(np.float64)
    out.reverse()
    return Model(*(tuple(level[i].astype(np.int32 if i in (0, 2) else np.float32) for level in out) for i in range(4)))


def discounts(count: np.ndarray, modified: bool) -> np.ndarray:
    """Discount for counts of 0, 1, 2 and from 3, from the numbers of grams seen once to four times."""
    n = [max(1.0, float((count == k).sum())) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    if not modified:
        return np.array([0.0, y, y, y])
    raw = [0.0, *(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))]
    return np.array([min(max(d, 0.1 * (k > 0)), k) for k, d in enumerate(raw)])


def fit_groups(counted: DataFrame, modified: bool) -> dict[str | None, Model]:
    """A model per group. What is collected is bounded by the 2**24 grams a group can have."""
    table = counted.toPandas()
    return {
        (None if name != name else name): fit(part["gram"].to_numpy(), part["n"].to_numpy(), modified)
        for name, part in table.groupby("group", dropna=False, sort=True)
    }


class Scorer:
    """Sums of log10 probabilities per text under several models.

    Each gram that occurs is looked up once in the sorted arrays; after that its
    row in a small table is known.
    """

    def __init__(self, models: list[Model], symbols: np.ndarray | Spelling) -> None:
        self.models, self.symbols = models, symbols
        self.slots = np.full(GRAMS, -1, dtype=np.int32)
        self.table = np.zeros((0, len(models)))

    def sums(self, texts: list[str], which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of each text, their log10 probability under each model, or under its own: which; -1 for none)."""
        size = np.zeros(len(texts), dtype=np.int64)
        total = np.zeros((len(texts), len(self.models)) if which is None else len(texts))
        for row, gram in grams(texts, self.symbols):
            new = np.unique(gram[self.slots[gram] < 0])
            if len(new) and self.models:
                self.slots[new] = np.arange(len(self.table), len(self.table) + len(new), dtype=np.int32)
                self.table = np.vstack([self.table, np.column_stack([m.log10(new) for m in self.models])])
            if len(gram) and self.models:
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                size[row[first]] += np.diff(np.append(first, len(row)))
                at = self.slots[gram]
                if which is not None:
                    total[row[first]] += np.add.reduceat(np.where(which[row] < 0, 0.0, self.table[at, which[row]]), first)
                    continue
                for k in range(len(self.models)):
                    total[row[first], k] += np.add.reduceat(self.table[at, k], first)
        return size, total
