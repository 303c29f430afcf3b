"""Byte-level BPE encoding and decoding by batched merge rounds in numpy.

A vocabulary file of the tokenizers library gives tokens and ranked merges.
Texts are cut at the strings of added tokens and then into words, by the classes
of their characters, for many texts in one array. Words not met before are
merged together: their symbols stand in one flat array, the rank of every pair
is found by binary search in the sorted pair keys, and a round merges each
word's lowest-ranked pair wherever it occurs. Merging all places at once is
exact as a token is made by one merge only and used by later ones only, which
is checked when the file is read. Decoding gathers the bytes of the ids.

Which characters are letters, numbers and white space depends on the Unicode
version the library was built with, so the driver asks the library's own
splitter, once for every run of alike characters, and ships the runs.

Defined cases: a null text counts as empty and has no ids; bytes that are no
UTF-8 count as U+FFFD; rows are encoded each on its own, so repeated rows, ties
and null ids stay as they are; an empty table gives an empty result; columns
other than doc_id and text are not read. Very long texts are cut into parts of
about AT_ONCE characters between a word and the blank before the next one; only
a text without such places is handled in one piece. Long words are merged by
rank over linked symbols, in time proportional to their length and the ranks
they hold. Ids that the vocabulary lacks decode to nothing, bytes that make up
no character to U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.llm.common import TEXTS_AT_ONCE, code_points, in_batches, to_batch

#: Characters that are split and looked up in one go.
AT_ONCE = 1_000_000
#: Words, and bytes of words, a worker remembers at most.
REMEMBERED = 300_000
REMEMBERED_BYTES = 16_000_000
#: Symbols above which a word is merged on its own.
LONG = 256
#: Symbols that share one minimum in a long word.
BLOCK = 1024
NONE = np.iinfo(np.int32).max
LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
SAFE_CUT = re.compile(r"\w \w")
#: Options of the vocabulary file under which this codec gives the library's ids.
PLAIN_MODEL = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "ignore_merges": False,
}
PLAIN_TOKEN = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_file(path: str) -> dict:
    """The vocabulary file; one that asks for anything this codec does not do is an error."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    splitter = found["pre_tokenizer"] or {}
    model = found["model"]
    plain = (
        found["normalizer"] is None
        and splitter.get("type") == "ByteLevel"
        and not splitter.get("add_prefix_space")
        and splitter.get("use_regex", True)
        and (found["decoder"] or {}).get("type") == "ByteLevel"
        and all((model.get(k) or None) == (v or None) for k, v in PLAIN_MODEL.items())
        and all(t[k] == v for t in found["added_tokens"] for k, v in PLAIN_TOKEN.items())
    )
    if not plain:
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
    return found


def character_runs(path: str) -> tuple[np.ndarray, np.ndarray]:
    """First code points of runs of alike characters, and each run's class, as the library's splitter has them."""
    from tokenizers import Tokenizer

    splitter = Tokenizer.from_file(path).pre_tokenizer

    def starts(text: str) -> list[int]:
        return [a for _, (a, _) in splitter.pre_tokenize_str(text)]

    def kind(c: int) -> int:
        joined = [k for k, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if 1 not in starts(before + chr(c))]
        return joined[0] if joined else SPACE

    maybe_space = {c for c in range(0x110000) if chr(c).isspace() or unicodedata.category(chr(c))[0] == "Z" or c < 0x20 or c == 0x27}
    plain = np.array([c for c in range(0x110000) if c not in maybe_space and not 0xD800 <= c < 0xE000])
    begins = plain[starts("".join(map(chr, plain.tolist())))].tolist()
    classes = {c: kind(c) for c in begins}
    classes |= {c: kind(c) for c in maybe_space}
    # after a character that stands alone, and after the surrogates, the run before goes on
    run_of = np.searchsorted(begins, [c + 1 for c in (*maybe_space, 0xDFFF)], "right") - 1
    for c, r in zip((*maybe_space, 0xDFFF), run_of, strict=True):
        if c + 1 not in classes and c < 0x10FFFF:
            classes[c + 1] = classes[begins[r]] if r >= 0 else kind(c + 1)
    first = np.array(sorted(classes), dtype=np.int64)
    return first, np.array([classes[c] for c in first.tolist()], dtype=np.uint8)


def byte_characters() -> list[str]:
    """The character that stands for each byte in the file: printable ones for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def gather(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[begin : begin + length] of every entry, one after the other."""
    before = np.cumsum(length) - length
    return flat[np.repeat(begin - before, length) + np.arange(int(length.sum()))]


class Codec:
    """Encoder and decoder of one vocabulary; remembers the ids of words it has met, within bounds."""

    def __init__(self, path: str, runs: tuple[np.ndarray, np.ndarray]) -> None:
        found = read_file(path)
        vocabulary, merges = found["model"]["vocab"], found["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        added = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.size = max([*vocabulary.values(), *added.values()]) + 1
        letters = byte_characters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.base = np.array([vocabulary[c] for c in letters], dtype=np.int64)
        left, right, made = (np.array([vocabulary[t] for t in part], dtype=np.int64) for part in zip(*((a, b, a + b) for a, b in merges), strict=True))
        self.check_order(left, right, made)
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order.astype(np.int32), made[order]
        self.classes = np.repeat(runs[1], np.diff([*runs[0].tolist(), 0x110000]))
        token_bytes = [b""] * self.size
        for token, i in [*vocabulary.items(), *added.items()]:
            known = all(c in byte_of for c in token)
            token_bytes[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.token_length = np.array(list(map(len, token_bytes)), dtype=np.int64)
        self.token_begin = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(token_bytes), dtype=np.uint8)
        self.added = added
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.forget()

    def check_order(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        made_at = np.full(self.size, -1, dtype=np.int64)
        made_at[made] = np.arange(len(made))
        once = len(np.unique(made)) == len(made) and not np.isin(made, self.base).any()
        if not once or (np.maximum(made_at[left], made_at[right]) >= np.arange(len(made))).any():
            raise ValueError("a token is made by two merges or used before it is made")

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        self.ids = np.empty(0, dtype=np.int64)
        self.begin = np.empty(0, dtype=np.int64)
        self.length = np.empty(0, dtype=np.int64)

    # ---- words

    def word_starts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where words begin; `first` marks the first characters of sections, over which no word reaches.

        Words are runs of letters, of numbers or of other signs, each with the
        blank before it; white space up to its last character; and after an
        apostrophe that begins a word the endings s, t, m, d, re, ve, ll.
        """
        kind = self.classes[points]
        start = first.copy()
        start[1:] |= kind[1:] != kind[:-1]
        space = kind == SPACE
        last = np.zeros(len(points), dtype=bool)
        last[:-1] = space[:-1] & ~space[1:] & ~first[1:]
        start |= last
        start[1:] &= ~(last[:-1] & (points[:-1] == 0x20))
        at = np.flatnonzero((points[:-1] == 0x27) & start[:-1] & ~first[1:])
        one = np.isin(points[at + 1], [ord(c) for c in "stmd"])
        start[at[one] + 1] = False
        after = at[one] + 2
        start[after[after < len(points)]] = True
        at = at[at + 2 < len(points)]
        at = at[~first[at + 2]]
        pair = points[at + 1].astype(np.int64) << 32 | points[at + 2]
        at = at[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]
        start[at + 1] = False
        after = at + 3
        start[after[after < len(points)]] = True
        return start

    def words(self, sections: list[str]) -> tuple[list[bytes], np.ndarray]:
        """The words of non-empty sections, in order, and how many each section has."""
        text = "".join(sections)
        points = code_points(text)
        edges = np.cumsum([0, *map(len, sections)])
        first = np.zeros(len(points), dtype=bool)
        first[edges[:-1]] = True
        starts = np.flatnonzero(self.word_starts(points, first))
        counts = np.diff(np.searchsorted(starts, edges))
        data = text.encode("utf-8")
        at = starts
        if len(data) > len(points):
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            at = (np.cumsum(width) - width)[starts]
        cuts = at.tolist()
        return list(map(data.__getitem__, map(slice, cuts, [*cuts[1:], len(data)]))), counts

    # ---- merges

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE where it is never merged) and the token it makes."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NONE), self.made[at]

    def merge_together(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words in rounds, each word's lowest pair in each; words leave when they have none."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank, made = self.pairs(symbols, np.append(symbols[1:], 0))
            rank[np.append(word[1:] != word[:-1], True)] = NONE
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(begin, len(word)))
            best = np.minimum.reduceat(rank, begin)
            goes_on = np.repeat(best < NONE, sizes)
            done.append((word[~goes_on], symbols[~goes_on]))
            chosen = np.flatnonzero((rank == np.repeat(best, sizes)) & goes_on)
            chosen = every_other(chosen, chosen[:-1] + 1)
            symbols[chosen] = made[chosen]
            goes_on[chosen + 1] = False
            symbols, word = symbols[goes_on], word[goes_on]
        word, symbols = (np.concatenate(part) for part in zip(*done, strict=True))
        return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(lengths))

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """One word by rising rank; symbols are linked, minima of blocks tell where the lowest rank is."""
        n = len(symbols)
        symbol = np.concatenate([[-1], symbols, np.full(BLOCK, -1)])  # places 1 to n; the rest belongs to no pair
        after = np.arange(1, n + 3)
        before = np.arange(-1, n + 1)
        rank = np.full(-(-(n + 2) // BLOCK) * BLOCK, NONE, dtype=np.int32)
        blocks = rank.reshape(-1, BLOCK)
        made = np.zeros(n + 2, dtype=np.int64)

        def look_up(at: np.ndarray) -> None:
            found, made[at] = self.pairs(symbol[at], symbol[after[at]])
            rank[at] = np.where((at > 0) & (after[at] <= n), found, NONE)

        look_up(np.arange(1, n + 1))
        lowest = blocks.min(axis=1)
        while True:
            r = lowest.min()
            if r == NONE:
                break
            where = np.flatnonzero(lowest == r)
            row, column = np.nonzero(blocks[where] == r)
            chosen = where[row] * BLOCK + column
            chosen = every_other(chosen, after[chosen[:-1]])
            gone = after[chosen]
            symbol[chosen] = made[chosen]
            after[chosen] = after[gone]
            before[after[gone]] = chosen
            rank[gone] = NONE
            look_up(np.concatenate([chosen, before[chosen]]))
            touched = np.unique(np.concatenate([chosen, gone, before[chosen]]) // BLOCK)
            lowest[touched] = blocks[touched].min(axis=1)
        alive = np.ones(n + 2, dtype=bool)
        alive[[0, n + 1]] = False
        alive[1 : n + 1] = before[after[1 : n + 1]] == np.arange(1, n + 1)
        return symbol[: n + 2][alive]

    def learn(self, words: list[bytes]) -> None:
        """Merge distinct words and remember their ids."""
        short = [w for w in words if len(w) <= LONG]
        parts, lengths = [], []
        if short:
            size = np.array(list(map(len, short)), dtype=np.int64)
            ids, found = self.merge_together(self.base[np.frombuffer(b"".join(short), dtype=np.uint8)], size)
            parts.append(ids)
            lengths.append(found)
        long = [w for w in words if len(w) > LONG]
        for w in long:
            parts.append(self.merge_long(self.base[np.frombuffer(w, dtype=np.uint8)]))
            lengths.append(np.array([len(parts[-1])]))
        start = len(self.known)
        self.known.update(zip([*short, *long], range(start, start + len(words)), strict=True))
        self.known_bytes += sum(map(len, words))
        self.ids = np.concatenate([self.ids, *parts])
        self.length = np.concatenate([self.length, *lengths])
        self.begin = np.cumsum(self.length) - self.length

    # ---- texts

    def encode_sections(self, sections: list[str]) -> list[np.ndarray]:
        """Ids of each section; sections are not empty."""
        if len(self.known) > REMEMBERED or self.known_bytes > REMEMBERED_BYTES:
            self.forget()
        words, counts = self.words(sections)
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self.learn(new)
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        length = self.length[index]
        ids = gather(self.ids, self.begin[index], length)
        ends = np.concatenate([[0], np.cumsum(length)])[np.cumsum(counts)]
        return np.split(ids, ends[:-1])

    def sections(self, text: str) -> Iterator[str | int]:
        """A text's sections and the ids of added tokens between them, in order; long sections in parts."""
        pieces = self.added_pattern.split(text) if self.added_pattern else [text]
        for k, piece in enumerate(pieces):
            if k % 2:
                yield self.added[piece]
                continue
            start = 0
            while len(piece) - start > AT_ONCE and (cut := SAFE_CUT.search(piece, start + AT_ONCE)):
                yield piece[start : cut.start() + 1]
                start = cut.start() + 1
            if len(piece) > start:
                yield piece[start:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[str] = []
        places: list[tuple[int, int]] = []
        size = 0

        def flush() -> None:
            nonlocal waiting, places, size
            if waiting:
                for (row, k), ids in zip(places, self.encode_sections(waiting), strict=True):
                    out[row][k] = ids
            waiting, places, size = [], [], 0

        for row, text in enumerate(texts):
            for part in self.sections(text):
                if isinstance(part, int):
                    out[row].append(np.array([part], dtype=np.int64))
                    continue
                places.append((row, len(out[row])))
                out[row].append(np.empty(0, dtype=np.int64))
                waiting.append(part)
                size += len(part)
                if size >= AT_ONCE:
                    flush()
        flush()
        return [np.concatenate(p) if len(p) > 1 else p[0] if p else np.empty(0, dtype=np.int64) for p in out]

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < self.size)]
        data = gather(self.token_bytes, self.token_begin[ids], self.token_length[ids])
        return data.tobytes().decode("utf-8", "replace")


def every_other(chosen: np.ndarray, follower: np.ndarray) -> np.ndarray:
    """The places of one pair without those whose first symbol the place before takes; follower: next symbol's place."""
    linked = np.append(False, follower == chosen[1:])
    begin = np.flatnonzero(~linked)
    within = np.arange(len(chosen)) - np.repeat(begin, np.diff(np.append(begin, len(chosen))))
    return chosen[within % 2 == 0]


# ---- tables


def codec(path: str | None) -> Callable[[], Codec]:
    """What tasks make their codec with; the runs of characters are a few thousand numbers."""
    path = path or vocabulary_path()
    read_file(path)
    runs = character_runs(path)
    return lambda: Codec(path, runs)


def texts(docs: DataFrame) -> DataFrame:
    in_batches(docs.sparkSession, TEXTS_AT_ONCE)
    text = F.make_valid_utf8(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    make = codec(path)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        for batch in batches:
            found = own.encode(batch.column("text").to_pylist())
            edges = np.cumsum([0, *map(len, found)])
            flat = np.concatenate([*found, np.empty(0, dtype=np.int64)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], schema=schema)

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows with ids; null ids give an empty text."""
    in_batches(rows.sparkSession, TEXTS_AT_ONCE)
    make = codec(path)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        for batch in batches:
            lists = [np.array([i for i in ids or [] if i is not None], dtype=np.int64) for ids in batch.column("ids").to_pylist()]
            yield to_batch(schema, batch.column("doc_id"), [own.decode(ids) for ids in lists])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and hashes of the ids and of the text decoded from them, without moving either to the JVM."""
    make = codec(path)
    columns = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        for batch in batches:
            n, ids_hash, text_hash = [], [], []
            for ids in own.encode(batch.column("text").to_pylist()):
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_hash.append(hashlib.sha256(own.decode(ids).encode("utf-8")).hexdigest())
            yield to_batch(schema, batch.column("doc_id"), n, ids_hash, text_hash)

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
