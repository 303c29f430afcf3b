"""Log-likelihood of whole texts under a gated recurrent model of words.

Words are counted on Spark over all training texts. The most frequent words (HEAD,
or more as the number of different words grows), the end of a text and one item for
all other words are the model's items, in classes of CLASS_SIZE by frequency; the
output is a softmax over classes and one over the items of the right class. An item
for other words is split by their smoothed counts, so every text has a proper probability.

Training is back-propagation in numpy, truncated to windows of WINDOW words with
the state carried on, over all training texts, in ROUNDS rounds, each in shards of about
SHARD_WORDS words that stream their texts from the same weights, which Spark then
averages. Every round reads all texts, however many there are; a caller who sets ONCE has
the rounds share them from so many training words on. Texts above PIECE words are learned from in pieces, each from the zero state
after the word before it, so that streams end together however long a text is. Biases start from the counts, so the model starts as the unigram model.
Scoring runs texts of a batch side by side from first to last word; nothing is cut.

The counts of the KNOWN most frequent words travel with the model; the rarer words
of each text are joined with the table of counts.

Defined cases: a null or empty text is its end token alone; a null id counts as
held out; without training texts the base is 0 and the model uniform; rows that
agree are scored each on its own. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heapreplace
from itertools import groupby
from math import isqrt, prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.llm.common import in_batches, remainder, ship, stage, unpacked

FOLDS = 10
HEAD = 2046
CLASS_SIZE = 64
KNOWN = 150_000
#: Steps of counts per doubling.
STEPS = 16
EMBED = 24
HIDDEN = 24
#: The least number of shards, and the words a shard has where there are more.
SHARDS = 4
SHARD_WORDS = 2_000_000
ROUNDS = 3
#: From so many training words on, a round reads its own part of the texts, each text in one round; None: never.
ONCE: int | None = None
#: The least number of streams; there are more where each still has STEPS_EACH windows.
STREAMS = 48
STEPS_EACH = 100
MOST_STREAMS = 256
WINDOW = 20
#: Words of a text that one stream learns from in turn; the next ones are a piece of their own.
PIECE = 500
#: Words that are laid out in streams at a time.
CHUNK = 1_000_000
#: Weights that are averaged in one row.
BLOCK = 1024
RATE = 0.01
SMOOTH = 0.1
#: Bytes of texts that are cut into words at a time.
TEXT_BYTES = 1 << 24
#: Words whose hidden states are held before the output layer.
HELD = 20_000
#: Weights that a training step changes at a time, and rows whose outputs are computed at a time in scoring: they stay in a core's cache.
STEPPED = 16_384
ROWS = 2_560
#: All rows as one run.
WHOLE = [(0, slice(None))]
#: Texts that go to a Python worker at once, and those that are scored at the same time.
AT_ONCE = 10_000
SIDE_BY_SIDE = 1_000
END = b""


def in_slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in order, as many at a time as have TEXT_BYTES together, one at least; null is the empty text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + TEXT_BYTES, "right")))
        yield pc.fill_null(texts.slice(at, to - at), "")
        at = to


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of texts in lower case (A to Z only), one text after the other; number of words of each)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    found, ends = lists.flatten(), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
    # blanks at either end of a text leave an empty word
    there = pc.greater(pc.binary_length(found), 0)
    kept = np.append(0, np.cumsum(there.to_numpy(zero_copy_only=False)))
    return found.filter(there).cast(pa.binary()), np.diff(kept[ends])


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, one end per text as the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in in_slices(batch.column("text")):
                seen = words_of(texts)[0].value_counts()
                words = pa.concat_arrays([seen.field("values"), pa.array([END], pa.binary())])
                yield pa.RecordBatch.from_arrays([words, pa.concat_arrays([seen.field("counts"), pa.array([len(texts)], pa.int64())])], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


@dataclass(frozen=True)
class Words:
    """The most frequent words with their counts, and sums over all."""

    rank: dict[bytes, int]
    count: np.ndarray
    head: int
    total: int
    different: int
    tail_total: int
    tail_different: int

    @property
    def items(self) -> int:
        """Head words and the end, then one item for the rest."""
        return self.head + 1

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + SMOOTH) / (self.total + SMOOTH * (self.different + 1)))

    def within_tail(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + SMOOTH) / (self.tail_total + SMOOTH * (self.tail_different + 1)))


def head_for(different: int, known: int = KNOWN) -> int:
    """Head words for so many different words: HEAD, and above 2**20 words twice their square root."""
    return min(known, max(HEAD, 2 * isqrt(different)))


def vocabulary(counts: DataFrame, head: int | None = None, known: int = KNOWN) -> Words:
    """The words above the smallest count that at most `known` words reach, most frequent first.

    That count is found from a table of some hundred steps of counts, so that
    no task sends words which are not wanted.
    """
    level = F.floor(F.log2("n") * STEPS).cast("int")
    steps = sorted(counts.groupBy(level.alias("level")).agg(F.count("*"), F.sum("n")).collect(), reverse=True)  # one row per step
    total, least, words = (sum(r[2] for r in steps), sum(r[1] for r in steps)), None, 0
    for step_, n, _ in steps:
        if words + n > known:
            break
        least, words = step_, words + n
    wanted = F.col("word") == F.lit(END)
    if least is not None:
        wanted = wanted | (level >= least)
    top = counts.where(wanted).toArrow()  # bounded by `known`
    rows = sorted(zip(top["word"].to_pylist(), top["n"].to_pylist(), strict=True), key=lambda r: (r[0] != END, -r[1], r[0]))
    if not rows or rows[0][0] != END:
        rows.insert(0, (END, 0))
    count = np.array([n for _, n in rows], dtype=np.float64)
    head = min((head_for(int(total[1]), known) if head is None else head) + 1, len(rows))
    return Words(
        {w: i for i, (w, _) in enumerate(rows)}, count, head, int(total[0] or 0), int(total[1]),
        int((total[0] or 0) - count[:head].sum()), int(total[1]) - int((count[:head] > 0).sum()),
    )


def start_weights(words: Words, embed: int = EMBED, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Small random weights; output biases are logs of the items' counts."""
    random = np.random.default_rng(11)
    classes = -(-words.items // CLASS_SIZE)
    size = np.zeros(classes * CLASS_SIZE)
    size[: words.items] = np.append(words.count[: words.head], words.tail_total) + SMOOTH
    per = size.reshape(classes, CLASS_SIZE)

    def small(*shape: int) -> np.ndarray:
        return (random.normal(size=shape) / np.sqrt(shape[-2] if len(shape) > 1 else 1) * 0.5).astype(np.float32)

    return {
        "embed": random.normal(size=(words.items, embed)).astype(np.float32) * np.float32(0.3),
        "w": small(embed, 3 * hidden),
        "u": small(hidden, 3 * hidden),
        "b": np.zeros(3 * hidden, dtype=np.float32),
        "class_w": np.zeros((hidden, classes), dtype=np.float32),
        "class_b": np.log(per.sum(1)).astype(np.float32),
        "item_w": np.zeros((classes, hidden, CLASS_SIZE), dtype=np.float32),
        "item_b": np.where(per > 0, np.log(np.maximum(per, 1e-12)), -30.0).astype(np.float32),
    }


class Room:
    """Arrays by name that are used again, as fresh memory of this size costs more than what is computed in it."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, kind: np.dtype, *shape: int) -> np.ndarray:
        """An array with any content, the caller's until the name is asked for again."""
        size = prod(shape)
        have = self.held.get(name)
        if have is None or have.size < size or have.dtype != kind:
            have = self.held[name] = np.empty(size, dtype=kind)
        return have[:size].reshape(shape)


def step(
    p: dict[str, np.ndarray], xw: np.ndarray, h: np.ndarray, gates: np.ndarray, candidate: np.ndarray, past: np.ndarray,
    hu: np.ndarray | None = None, new: np.ndarray | None = None,
) -> np.ndarray:
    """The new state. Arrays hold a stream per column; the gates (update, then reset), the
    candidate and the state's part of it are written to the three after h, the state through its weights and the new state to the last.
    """
    k = len(h)
    hu = np.matmul(p["u"].T, h, out=hu)
    np.add(xw[: 2 * k], hu[: 2 * k], out=gates)
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    past[...] = hu[2 * k :]
    np.multiply(gates[k:], past, out=candidate)
    candidate += xw[2 * k :]
    np.tanh(candidate, out=candidate)
    new = np.subtract(h, candidate, out=new)
    new *= gates[:k]
    new += candidate
    return new


def with_bias(w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Output weights with their biases as a last input, which is always 1."""
    return np.concatenate([w, b[..., None, :]], axis=-2)


def parts_of(states: np.ndarray, w: np.ndarray, runs: list[tuple[int, slice]], parts: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
    """(sums, what was taken off) for each row of states, whose probabilities are parts / sums; each run of rows has weights of its own.

    The largest output is taken off only where sums would leave the range of the numbers.
    """
    for c, at in runs:
        np.matmul(states[at], w[c], out=parts[at])
    with np.errstate(over="ignore"):
        np.exp(parts, out=parts)
    sums = parts @ np.ones(parts.shape[1], dtype=parts.dtype)
    if sums.min() > 1e-20 and sums.max() < 1e20:
        return sums, 0.0
    for c, at in runs:
        np.matmul(states[at], w[c], out=parts[at])
    off = parts.max(1)
    parts -= off[:, None]
    np.exp(parts, out=parts)
    return parts.sum(1), off


def by_value(x: np.ndarray, values: int) -> np.ndarray:
    """Order that sorts whole numbers below `values`; equal ones keep their order."""
    return np.argsort(x.astype(np.uint16) if values <= 1 << 16 else x, kind="stable")


def in_rows(group: np.ndarray, groups: int) -> Iterator[tuple[slice, list[tuple[int, slice]]]]:
    """(rows, runs of one group in them as (group, rows counted from the first)) of sorted groups, ROWS rows at a time."""
    edges = np.searchsorted(group, np.arange(groups + 1)).tolist()
    for at in range(0, len(group), ROWS):
        to = min(at + ROWS, len(group))
        found = range(int(group[at]), int(group[to - 1]) + 1)
        runs = [(c, slice(max(edges[c], at) - at, min(edges[c + 1], to) - at)) for c in found if edges[c] < edges[c + 1]]
        yield slice(at, to), runs


def target_logs(p: dict[str, np.ndarray], hidden: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of each target item; hidden states are columns."""
    states = np.ones((len(target), len(hidden) + 1), dtype=hidden.dtype)
    states[:, :-1] = hidden.T
    return state_logs(with_bias(p["class_w"], p["class_b"]), with_bias(p["item_w"], p["item_b"]), states, target, Room())


def state_logs(class_w: np.ndarray, item_w: np.ndarray, states: np.ndarray, target: np.ndarray, room: Room) -> np.ndarray:
    """Natural log probability of each target item; a row of states ends with 1, weights have their biases."""
    kind, wide, classes = states.dtype, states.shape[1], len(item_w)
    order = by_value(target // CLASS_SIZE, classes)
    states = np.take(states, order, axis=0, out=room("sorted", kind, len(order), wide), mode="clip")
    target = target[order]
    group = target // CLASS_SIZE
    found = np.zeros(len(target))
    sums = room("sums", kind, len(target))

    def add(w: np.ndarray, at: slice, runs: list[tuple[int, slice]]) -> None:
        sums[at], off = parts_of(states[at], w, runs, room("parts", kind, at.stop - at.start, w.shape[2]))
        found[at] -= off

    def add_logs(w: np.ndarray, chosen: np.ndarray) -> None:
        by_output = w.transpose(0, 2, 1).reshape(-1, wide)
        outputs = np.take(by_output, chosen, axis=0, out=room("chosen", kind, len(chosen), wide), mode="clip")
        outputs *= states
        found[...] += outputs @ np.ones(wide, dtype=kind)
        found[...] -= np.log(sums)

    for at, _ in in_rows(group, classes):
        add(class_w[None], at, WHOLE)
    add_logs(class_w[None], group)
    for at, runs in in_rows(group, classes):
        add(item_w, at, runs)
    add_logs(item_w, target)
    out = np.empty(len(target))
    out[order] = found
    return out


def window_slopes(
    p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, begins: np.ndarray, valid: np.ndarray, h: np.ndarray,
    slopes: dict[str, np.ndarray] | None = None, room: Room | None = None,
):
    """(slopes of the summed log probability, state after the window, the sum). Arrays are (steps, streams), states (streams, size).

    Inside, a step has a block of memory with a column for each stream; the output layer has a
    row for each word, sorted by class. Slopes are written to `slopes` if given.
    """
    steps, streams = inputs.shape
    k, kind, size = h.shape[1], h.dtype, p["embed"].shape[1]
    if slopes is None:
        slopes = {name: np.empty_like(v) for name, v in p.items()}
    if room is None:
        room = Room()
    words = steps * streams

    def blocks(name: str, rows: int) -> np.ndarray:
        return room(name, kind, steps, rows, streams)

    seen = np.take(p["embed"], inputs, axis=0, out=room("seen", kind, steps, streams, size), mode="clip")
    xw = np.matmul(p["w"].T, seen.transpose(0, 2, 1), out=blocks("xw", 3 * k))
    xw += p["b"][:, None]
    before, candidate, past, gates = blocks("before", k), blocks("candidate", k), blocks("past", k), blocks("gates", 2 * k)
    hidden = room("hidden", kind, words, k + 1)
    hidden[:, k] = 1
    state, hu = np.array(h.T, order="C"), room("hu", kind, 3 * k, streams)
    goes_on = (~begins).astype(kind)
    for t in range(steps):
        np.multiply(state, goes_on[t], out=before[t])
        step(p, xw[t], before[t], gates[t], candidate[t], past[t], hu, state)
        hidden[t * streams : (t + 1) * streams, :k] = state.T

    target, on = targets.ravel(), valid.ravel()
    classes = len(p["class_b"])
    order = by_value(target // CLASS_SIZE, classes)
    if not on.all():
        order = order[on[order]]
    target = target[order]
    group, place = target // CLASS_SIZE, target % CLASS_SIZE
    states = np.take(hidden, order, axis=0, out=room("states", kind, len(order), k + 1), mode="clip")
    class_w, item_w = with_bias(p["class_w"], p["class_b"]), with_bias(p["item_w"], p["item_b"])
    by_class, by_item = np.zeros_like(class_w), np.zeros_like(item_w)
    right, ds, numbers = room("right", kind, len(order)), room("ds", kind, len(order), k), np.arange(ROWS)

    def output(w: np.ndarray, chosen: np.ndarray, at: slice, runs: list[tuple[int, slice]], slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability of the chosen outputs, slopes of the states); the weights' are added to slope."""
        n, outputs = at.stop - at.start, w.shape[2]
        parts = room("parts", kind, n, outputs)
        sums, _ = parts_of(states[at], w, runs, parts)
        flat, chosen = parts.reshape(-1), numbers[:n] * outputs + chosen[at]
        there = flat[chosen]
        # an output's slope is 1 - p if it is the target, -p elsewhere: parts less their sum, times -1 / sum
        flat[chosen] = there - sums
        scale = (-1 / sums)[:, None]
        scaled = np.multiply(states[at], scale, out=room("scaled", kind, n, k + 1))
        by_state = room("by_state", kind, n, k)
        for c, run in runs:
            slope[c] += scaled[run].T @ parts[run]
            np.matmul(parts[run], w[c, :-1].T, out=by_state[run])
        by_state *= scale
        return there / sums, by_state

    for at, _ in in_rows(group, classes):
        right[at], ds[at] = output(class_w[None], group, at, WHOLE, by_class[None])
    for at, runs in in_rows(group, classes):
        found, by_state = output(item_w, place, at, runs, by_item)
        right[at] *= found
        ds[at] += by_state
    total = float(np.log(np.maximum(right, np.finfo(kind).tiny), dtype=np.float64).sum())
    slopes["class_w"][...], slopes["class_b"][...] = by_class[:-1], by_class[-1]
    slopes["item_w"][...], slopes["item_b"][...] = by_item[:, :-1], by_item[:, -1]
    dh = room("dh", kind, words, k)
    if len(order) < words:
        dh[...] = 0
    dh[order] = ds

    # what does not depend on later steps is computed for all steps at once
    z, r = gates[:, :k], gates[:, k:]
    other = np.subtract(1, z, out=blocks("other", k))
    by_update = np.subtract(before, candidate, out=blocks("by_update", k))
    by_update *= z
    by_update *= other
    candidate *= candidate
    by_candidate = np.subtract(1, candidate, out=candidate)
    by_candidate *= other
    by_reset = past
    by_reset *= r
    by_reset *= np.subtract(1, r, out=other)
    # hu and xw have been used: their rooms take the slopes
    dhu, dn = xw, other
    g, back = np.empty((k, streams), dtype=kind), np.empty((k, streams), dtype=kind)
    onward = np.zeros((k, streams), dtype=kind)
    for t in range(steps - 1, -1, -1):
        np.add(dh[t * streams : (t + 1) * streams].T, onward, out=g)
        np.multiply(g, by_candidate[t], out=dn[t])
        np.multiply(g, by_update[t], out=dhu[t, :k])
        np.multiply(dn[t], by_reset[t], out=dhu[t, k : 2 * k])
        np.multiply(dn[t], r[t], out=dhu[t, 2 * k :])
        g *= z[t]
        g += np.matmul(p["u"], dhu[t], out=back)
        np.multiply(g, goes_on[t], out=onward)
    turned = dhu.transpose(0, 2, 1)
    slopes["u"][...] = np.matmul(before, turned).sum(0)
    dhu[:, 2 * k :] = dn
    slopes["b"][...] = dhu.sum(2).sum(0)
    slopes["w"][...] = np.matmul(dhu, seen).sum(0).T
    by_seen = np.matmul(turned, p["w"].T, out=room("by_seen", kind, steps, streams, size))
    places = np.add(inputs.reshape(-1, 1) * size, np.arange(size), out=room("places", np.dtype(np.int64), words, size))
    slopes["embed"][...] = 0
    np.add.at(slopes["embed"].reshape(-1), places.ravel(), by_seen.ravel())
    return slopes, state.T.copy(), total


def in_pieces(texts: Iterable[np.ndarray]) -> Iterator[np.ndarray]:
    """Runs of at most PIECE items of each text, each after the item before it; a text begins after an end, which is item 0."""
    for text in texts:
        whole = np.concatenate([np.zeros(1, dtype=np.int32), text], dtype=np.int32)
        for at in range(0, len(text), PIECE):
            yield whole[at : at + PIECE + 1]


def in_streams(pieces: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(inputs, targets, begins, valid), each (steps, streams), of pieces dealt to parallel streams."""
    words = sum(map(len, pieces)) - len(pieces)
    wide = min(max(STREAMS, words // (WINDOW * STEPS_EACH)), MOST_STREAMS)
    streams: list[list[np.ndarray]] = [[] for _ in range(min(wide, max(1, len(pieces))))]
    sizes = [(0, k) for k in range(len(streams))]
    for piece in pieces:
        size, k = sizes[0]
        streams[k].append(piece)
        heapreplace(sizes, (size + len(piece) - 1, k))
    longest = -(-max(sizes)[0] // WINDOW) * WINDOW
    # a stream's items lie together while they are laid out
    targets = np.zeros((len(streams), longest), dtype=np.int32)
    inputs = np.zeros_like(targets)
    begins, valid = np.zeros(targets.shape, dtype=bool), np.zeros(targets.shape, dtype=bool)
    for k, stream in enumerate(streams):
        size = np.array([len(piece) - 1 for piece in stream])
        ends = np.cumsum(size)
        targets[k, : ends[-1]] = np.concatenate([piece[1:] for piece in stream])
        inputs[k, : ends[-1]] = np.concatenate([piece[:-1] for piece in stream])
        begins[k, ends - size] = True
        valid[k, : ends[-1]] = True
    return tuple(np.ascontiguousarray(x.T) for x in (inputs, targets, begins, valid))


def in_chunks(texts: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Runs of texts with about CHUNK words in each."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= CHUNK:
            yield run
            run, size = [], 0
    if run:
        yield run


def train_pass(p: dict[str, np.ndarray], texts: Iterable[np.ndarray], rate: float = RATE) -> dict[str, np.ndarray]:
    """One pass over texts of items (each with its end), by Adam steps on windows of parallel streams."""
    names = list(p)
    flat = np.concatenate([p[name].ravel() for name in names])
    edges = np.cumsum([0] + [p[name].size for name in names])
    mean, square, slope = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)
    # weights and slopes by name are views of one vector each, which each step changes
    p, slopes = ({name: x[a:b].reshape(p[name].shape) for name, a, b in zip(names, edges, edges[1:], strict=False)} for x in (flat, slope))
    room, changed = Room(), np.empty(min(len(flat), STEPPED), dtype=flat.dtype)
    i = 0
    for run in in_chunks(in_pieces(texts)):
        inputs, targets, begins, valid = in_streams(run)
        h = np.zeros((inputs.shape[1], p["u"].shape[0]), dtype=np.float32)
        for t in range(0, len(inputs), WINDOW):
            i += 1
            # streams that have ended take no part
            on = np.flatnonzero(valid[t])
            part = (slice(t, t + WINDOW), on)
            _, h[on], _ = window_slopes(p, inputs[part], targets[part], begins[part], valid[part], h[on], slopes, room)
            n = max(1, int(valid[part].sum()))
            scale = np.float32(min(1.0, 1.0 / max(float(np.sqrt(slope @ slope)) / n, 1e-9)) / n)
            ahead = np.float32(rate * np.sqrt(1 - 0.99**i) / (1 - 0.9**i))
            for a in range(0, len(flat), STEPPED):
                s, m, q = slope[a : a + STEPPED], mean[a : a + STEPPED], square[a : a + STEPPED]
                change = changed[: len(s)]
                s *= scale
                np.subtract(s, m, out=change)
                change *= np.float32(0.1)
                m += change
                s *= s
                s -= q
                s *= np.float32(0.01)
                q += s
                np.sqrt(q, out=change)
                change += np.float32(1e-6)
                np.divide(m, change, out=change)
                change *= ahead
                flat[a : a + STEPPED] += change
    return p


def items_of(words: Words, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(rank of each word and each text's end, -1 where unknown; where texts begin and the last ends; the unknown words; their texts)."""
    found, size = words_of(texts)
    place = pc.fill_null(pc.index_in(found, value_set=pa.array(words.rank, pa.binary())), -1).to_numpy(zero_copy_only=False)
    unknown = place < 0
    ranks = np.where(unknown, -1, np.fromiter(words.rank.values(), np.int32, len(words.rank))[place])
    owners = np.repeat(np.arange(len(size)), size)[unknown]
    ends = np.cumsum(size)
    with_ends = np.insert(ranks, ends, words.rank[END]).astype(np.int32)
    return with_ends, np.append(0, ends + np.arange(1, len(size) + 1)), found.filter(pa.array(unknown)), owners


def as_items(rank: np.ndarray, words: Words) -> np.ndarray:
    return np.where((rank < 0) | (rank >= words.head), words.head, rank)


def training_items(docs: DataFrame, words: Words, shards: int, parts: int = 1) -> DataFrame:
    """(part, shard, k, items) of every row of docs. Rows that agree go to different shards, then parts."""
    shipped = ship(docs.sparkSession, words)
    order = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))

    def to_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpacked(shipped)

        def stored(texts: pa.Array) -> pa.Array:
            rank, edges, _, _ = items_of(known, texts)
            data = as_items(rank, known).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((edges * data.itemsize).astype(np.int32)), pa.py_buffer(data)])

        for batch in batches:
            seen: Counter[int] = Counter()
            at = 0
            for texts in in_slices(batch.column("text")):
                key = batch.column("k").slice(at, len(texts))
                again = []
                for k in key.to_pylist():
                    again.append(seen[k])
                    seen[k] += 1
                yield pa.RecordBatch.from_arrays([key, pa.array(again, pa.int64()), stored(texts)], ["k", "again", "items"])
                at += len(texts)

    rows = docs.select(order.alias("k"), "text").mapInArrow(to_items, "k long, again long, items binary")
    part = F.pmod(F.pmod(F.shiftright("k", 20), F.lit(parts)) + F.floor(F.col("again") / shards), F.lit(parts))
    shard = F.pmod(F.pmod("k", F.lit(shards)) + F.col("again"), F.lit(shards))
    return stage(rows.select(part.cast("int").alias("part"), shard.cast("int").alias("shard"), "k", "items"))


def averaged_pass(rows: DataFrame, weights: dict[str, np.ndarray], shards: int) -> tuple[dict[str, np.ndarray], int]:
    """(weights averaged over the shards' passes from `weights`, number of texts they read). The driver gets one vector."""
    current = ship(rows.sparkSession, weights)

    def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def every() -> Iterator[tuple[int, np.ndarray]]:
            for batch in batches:
                for shard, data in zip(batch.column("shard").to_pylist(), batch.column("items"), strict=True):
                    yield shard, np.frombuffer(data.as_py(), dtype=np.int32)

        for shard, texts in groupby(every(), key=lambda r: r[0]):
            n = 0

            def counted(texts=texts) -> Iterator[np.ndarray]:
                nonlocal n
                for _, text in texts:
                    n += 1
                    yield text

            found = train_pass(unpacked(current), counted())
            flat = np.concatenate([found[name].ravel() for name in sorted(found)]).astype(np.float32)
            data = [flat[a : a + BLOCK].tobytes() for a in range(0, len(flat), BLOCK)]
            blocks = pa.array(np.arange(len(data)), pa.int32())
            yield pa.RecordBatch.from_arrays([blocks, pa.array([shard] * len(data), pa.int32()), pa.array([n] * len(data), pa.int64()), pa.array(data, pa.binary())], ["block", "shard", "n", "weights"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, total = None, 0, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([n], pa.int64()), pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())], ["block", "n", "weights"])

        for batch in batches:
            for block, m, data in zip(batch.column("block").to_pylist(), batch.column("n").to_pylist(), batch.column("weights"), strict=True):
                if block != at:
                    if at is not None:
                        yield row()
                    at, n, total = block, 0, 0.0
                n += m
                total = total + m * np.frombuffer(data.as_py(), dtype=np.float32).astype(np.float64)
        if at is not None:
            yield row()

    # in order, so that sums are the same in every run
    spread = rows.select("shard", "k", "items").repartitionById(shards, "shard").sortWithinPartitions("shard", "k", "items")
    passed = spread.mapInArrow(one_pass, "block int, shard int, n long, weights binary")
    blocks = passed.repartitionById(SHARDS, F.col("block") % SHARDS).sortWithinPartitions("block", "shard")
    got = sorted(blocks.mapInArrow(add, "block int, n long, weights binary").collect(), key=lambda r: r["block"])  # one vector
    if not got:
        return weights, 0
    flat = np.concatenate([np.frombuffer(r["weights"], dtype=np.float32) for r in got])
    at, new = 0, {}
    for name in sorted(weights):
        size = weights[name].size
        new[name] = flat[at : at + size].reshape(weights[name].shape)
        at += size
    return new, got[0]["n"]


def train(docs: DataFrame, words: Words, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Weights after `rounds` rounds, averaged over the shards after each; every round reads all rows of docs unless ONCE is set."""
    weights = start_weights(words)
    parts = rounds if ONCE is not None and words.total >= ONCE else 1
    shards = max(SHARDS, -(-words.total // (parts * SHARD_WORDS)))
    rows = training_items(docs, words, shards, parts)
    for i in range(rounds):
        weights, _ = averaged_pass(rows.where(F.col("part") == i % parts), weights, shards)
    return weights


def likelihoods(p: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Summed log10 probability of each text of items, from its first to its last.

    SIDE_BY_SIDE texts of about one length step together, the longest first, so that
    a step's columns are those that go on; hidden states are held until there are HELD of them.
    """
    size = np.array([len(t) for t in texts], dtype=np.int64)
    order = np.argsort(-size, kind="stable")
    outputs, room = (with_bias(p["class_w"], p["class_b"]), with_bias(p["item_w"], p["item_b"])), Room()
    out = np.zeros(len(texts))
    for at in range(0, len(texts), SIDE_BY_SIDE):
        group = order[at : at + SIDE_BY_SIDE]
        out[group] = side_by_side(p, outputs, [texts[i] for i in group], size[group], room)
    return out / np.log(10)


def side_by_side(p: dict[str, np.ndarray], outputs: tuple[np.ndarray, np.ndarray], texts: list[np.ndarray], size: np.ndarray, room: Room) -> np.ndarray:
    """Summed natural log probability of each text; the longest come first. `outputs`: class and item weights with biases."""
    out = np.zeros(len(texts))
    begin = np.cumsum(size) - size
    items = np.concatenate(texts)
    active = np.searchsorted(-size, -np.arange(size[0]), "left").tolist()
    (wide, k), kind = (p["embed"].shape[1], p["u"].shape[0]), p["u"].dtype
    state = np.zeros((k, len(texts)), dtype=kind)
    last = np.zeros(len(texts), dtype=np.int64)
    held = room("held", kind, HELD + len(texts), k + 1)
    held[:, k] = 1
    bias = p["b"][:, None]
    goals, owners, n = [], [], 0
    for t, m in enumerate(active):
        seen = np.take(p["embed"], last[:m], axis=0, out=room("seen", kind, m, wide), mode="clip")
        xw = np.matmul(p["w"].T, seen.T, out=room("xw", kind, 3 * k, m))
        xw += bias
        if m < state.shape[1]:
            state = state[:, :m].copy()
        step(p, xw, state, room("gates", kind, 2 * k, m), room("candidate", kind, k, m), room("past", kind, k, m), room("hu", kind, 3 * k, m), state)
        last = items[begin[:m] + t]
        held[n : n + m, :k] = state.T
        goals.append(last)
        owners.append(m)
        n += m
        if n >= HELD or t + 1 == len(active):
            who = np.arange(n) - np.repeat(np.cumsum(owners) - owners, owners)
            out += np.bincount(who, weights=state_logs(*outputs, held[:n], np.concatenate(goals), room), minlength=len(texts))
            goals, owners, n = [], [], 0
    return out


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs."""
    in_batches(docs.sparkSession, AT_ONCE)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learning = rows.where(remainder("doc_id", FOLDS) != 0)
    counts = stage(count_words(learning))
    words = vocabulary(counts)
    weights = train(learning, words)
    shipped = ship(docs.sparkSession, (words, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, p = unpacked(shipped)
        base, tail = known.base(known.count), known.within_tail(known.count)
        for batch in batches:
            at = 0
            for texts in in_slices(batch.column("text")):
                rank, edges, rare, owners = items_of(known, texts)
                begin, there = edges[:-1], rank >= 0
                sure = np.add.reduceat((there & (known.count[rank] > 0)).astype(np.int64), begin)
                lows = np.add.reduceat(np.where(there, base[rank], 0.0), begin)
                inner = np.add.reduceat(np.where(rank >= known.head, tail[rank], 0.0), begin)
                logs = likelihoods(p, np.split(as_items(rank, known), edges[1:-1]))
                # each unknown word of a text once, with its times there
                coded = rare.dictionary_encode()
                different = max(1, len(coded.dictionary))
                pairs, times = np.unique(owners * different + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
                ends = np.searchsorted(pairs, np.arange(len(texts) + 1) * different)
                pairs = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(pairs % different)), pa.array(times, pa.int64())], ["word", "n"])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array(np.diff(edges)), pa.array(sure), pa.array(lows), pa.array(logs + inner), lists],
                    ["doc_id", "n_tokens", "n_known", "base", "model", "rare"],
                )
                at += len(texts)

    schema = "doc_id long, n_tokens long, n_known long, base double, model double, rare array<struct<word binary, n long>>"
    scored = stage(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))
    unsure = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.n").alias("times"))
    found = unsure.join(counts, "word", "left").select("row", "times", F.coalesce("n", F.lit(0)).alias("n"))
    low = F.log10((F.col("n") + SMOOTH) / F.lit(words.total + SMOOTH * (words.different + 1)))
    inner = F.log10((F.col("n") + SMOOTH) / F.lit(words.tail_total + SMOOTH * (words.tail_different + 1)))
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * low).alias("more_base"),
        F.sum(F.col("times") * inner).alias("more_model"),
    )
    whole = scored.drop("rare").join(sums, "row", "left")
    return whole.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == 0).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", F.lit(0.0))).alias("score"),
    )
