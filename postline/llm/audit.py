"""How filters interact: what each removes at each step of every order, by counting paths in the lattice of subsets.

Every row gets the set of filters it fails; only counts per part and set go on.
The states of the lattice are the sets of filters applied so far, an edge adds
one filter, an order is a path from the empty state to the full one. The rows
an edge removes follow from sums over subsets. Path counts run forward (orders
that reach a state) and backward (orders that leave it), so an edge is walked by
forward times backward orders, which weights its removals for the Shapley
total; the steps of every order are read from the same edges.

Defined cases: a null text is empty, a null source counts as the empty one; an
empty text fails A and, after the first, E; a null id has no smaller id and is
none, so such rows never fail E and make none fail it; rows that agree in id and
text both stay first; several labels of one id count once, good or toxic if any
says so; labels without an id, or of none of the documents, count nowhere; an
empty table has no parts. Texts are taken for identical by their SHA-256. Other
columns, of whatever name, are not read. Very long texts are read whole, their
words held in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.llm.common import WORD, stage
from postline.operators.skew import attach

LETTERS = "ABCDE"
#: Parts whose orders a task writes out at once.
PARTS_AT_ONCE = 100
OUTCOMES = ("n", "good", "toxic")


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    short = F.size(words) < 50
    repetitive = 100 * F.size(F.array_distinct(words)) < 65 * F.size(words)
    loud = 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.char_length(text)
    signs = text.rlike(r"[#$%&*|]")
    bits = [F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, fails in enumerate((short, repetitive, loud, signs))]
    return bits[0] + bits[1] + bits[2] + bits[3]


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (bits of the filters failed), n, good, toxic: documents per part and set of filters.

    Equal rows are folded before they move. Copies of a text are folded to one
    row per part and label before the smallest id meets them, so a text with a
    third of all rows arrives as a few.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text_failures(text).alias("failed"),
        F.unhex(F.sha2(text, 256)).alias("text_hash"),
    )
    rows = stage(rows.groupBy("doc_id", "part", "failed", "text_hash").agg(F.count("*").alias("n")))
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    with_label = attach(rows.where("doc_id is not null"), stage(marked.where("good or toxic")), ["doc_id"], F.col("text_hash"))
    nameless = rows.where("doc_id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    keys = ["text_hash", "part", "failed", "good", "toxic"]
    folded = with_label.fillna(False, ["good", "toxic"]).unionByName(nameless).groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first_here"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))["n"].alias("n_first"),
    )
    folded = stage(folded)
    first = folded.groupBy("text_hash").agg(F.min("first_here").alias("first"))
    folded = attach(folded, first, ["text_hash"], F.xxhash64("part"))
    stays = F.col("nameless") + F.when(F.col("first_here") == F.col("first"), F.col("n_first")).otherwise(F.lit(0))
    split = F.explode(
        F.array(
            F.struct(F.col("failed").alias("failed"), stays.alias("n")),
            F.struct((F.col("failed") + (1 << 4)).alias("failed"), (F.col("n") - stays).alias("n")),
        )
    )
    counted = folded.select("part", "good", "toxic", split.alias("s")).groupBy("part", F.col("s.failed").alias("failed"))
    return counted.agg(
        F.sum("s.n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("s.n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("s.n")).otherwise(F.lit(0))).alias("toxic"),
    )


class Lattice:
    """All sets of the filters, the edges that add one filter, and how many orders walk each."""

    def __init__(self, letters: str) -> None:
        n = len(letters)
        self.n, self.full = n, (1 << n) - 1
        self.edges = [(state, k) for state in range(1 << n) for k in range(n) if not state >> k & 1]
        forward, backward = [0] * (1 << n), [0] * (1 << n)
        forward[0] = backward[self.full] = 1
        for state, k in self.edges:  # states rise along every edge
            forward[state | 1 << k] += forward[state]
        for state, k in reversed(self.edges):
            backward[state] += backward[state | 1 << k]
        self.source = np.array([s for s, _ in self.edges])
        self.target = np.array([s | 1 << k for s, k in self.edges])
        self.filter = np.array([k for _, k in self.edges])
        self.paths = np.array([forward[s] * backward[s | 1 << k] for s, k in self.edges], dtype=np.int64)
        place = {edge: i for i, edge in enumerate(self.edges)}
        self.orders = ["".join(letters[k] for k in order) for order in permutations(range(n))]
        self.walks = np.array([[place[sum(1 << j for j in order[:i]), k] for i, k in enumerate(order)] for order in permutations(range(n))])

    def passing(self, counts: np.ndarray) -> np.ndarray:
        """From counts by set failed (last axis): the rows that pass all filters of each state."""
        total = counts.copy()
        for k in range(self.n):
            has = np.flatnonzero(np.arange(self.full + 1) >> k & 1)
            total[..., has] += total[..., has ^ (1 << k)]
        return total[..., self.full ^ np.arange(self.full + 1)]

    def steps(self, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Figures per part, order and step, from counts by part, outcome and set failed."""
        passing = self.passing(counts)
        removed = passing[..., self.source] - passing[..., self.target]
        n_removed = removed[:, 0]
        single = 1 << self.filter
        failing = passing[:, 0, :1] - passing[:, 0][:, single]
        weighted = n_removed * self.paths
        total = np.stack([weighted[:, self.filter == k].sum(1) for k in range(self.n)], axis=1)
        by_edge = {
            "kept": passing[:, 0][:, self.target],
            "removed": n_removed,
            "redundant": failing - n_removed,
            "unique_fails": counts[:, 0][:, single],
            "good_lost": removed[:, 1],
            "toxic_lost": removed[:, 2],
            "shapley": total[:, self.filter],
        }
        return {name: value[:, self.walks] for name, value in by_edge.items()}


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def order_steps(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counts per part and set of filters failed.

    A part brings at most one row per set of filters, so its list is bounded;
    parts are spread over tasks.
    """
    lists = counts.groupBy("part").agg(F.collect_list(F.struct("failed", *OUTCOMES)).alias("sets"))
    fields = [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((f, pa.int64()) for f in FIGURES)]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(letters)
        per_part = len(lattice.orders) * lattice.n
        for batch in batches:
            for start in range(0, batch.num_rows, PARTS_AT_ONCE):
                rows = batch.slice(start, PARTS_AT_ONCE)
                dense = np.zeros((rows.num_rows, len(OUTCOMES), lattice.full + 1), dtype=np.int64)
                for i, sets in enumerate(rows.column("sets").to_pylist()):
                    for s in sets:
                        dense[i, :, s["failed"]] = [s[o] for o in OUTCOMES]
                found = lattice.steps(dense)
                part = pa.array(rows.column("part")).take(pa.array(np.repeat(np.arange(rows.num_rows), per_part)))
                order = pa.array(lattice.orders).take(pa.array(np.tile(np.repeat(np.arange(len(lattice.orders)), lattice.n), rows.num_rows)))
                step = np.tile(np.arange(1, lattice.n + 1, dtype=np.int32), rows.num_rows * len(lattice.orders))
                columns = [part, order, pa.array(step), *(pa.array(found[f].ravel()) for f in FIGURES)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ddl = "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in FIGURES)
    return lists.mapInArrow(run, ddl)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return order_steps(failure_counts(docs, labels))


#: The same rows from DuckDB: every order walked on its own.
SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
marked AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN coalesce(w.doc_id > first_id, false) THEN 'E' ELSE '' END AS failed,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM w LEFT JOIN marked ON w.doc_id = marked.doc_id),
sets AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM l AS a, l AS b, l AS c, l AS d, l AS e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT filter_order, step::INT AS step, filter_order[step] AS c, filter_order[1:step - 1] AS before FROM orders, range(1, 6) AS r(step)),
parted AS (SELECT * FROM (SELECT DISTINCT part FROM sets) AS p, steps),
found AS (SELECT parted.part, filter_order, step, c,
    coalesce(sum(n) FILTER (translate(failed, before || c, '') = failed), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (contains(failed, c) AND translate(failed, before, '') = failed), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (contains(failed, c) AND translate(failed, before, '') <> failed), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = c), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (contains(failed, c) AND translate(failed, before, '') = failed), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (contains(failed, c) AND translate(failed, before, '') = failed), 0)::BIGINT AS toxic_lost
  FROM parted JOIN sets ON parted.part = sets.part GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    sum(removed) OVER (PARTITION BY part, c)::BIGINT AS shapley
FROM found
"""
