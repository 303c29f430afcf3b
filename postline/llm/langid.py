"""Language of a text by Kneser-Ney character models, one per language.

The language whose model needs the fewest nats per character wins. All rows that
may be learned from make the models. The sharpness that turns cross-entropies into
a probability, and per language the cross-entropy above which a prediction is
marked as rejected, are set before on one fold of these rows under models of the others.

Defined cases: a text that is null or has no letter is `und` with score 0 and
rejected; rows without a language are predicted, not learned from; without any
row to learn from all texts are `und`; a language without rows to set its limit
from is never rejected. Ids, sources and languages are never
inputs of a prediction. Repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.llm.common import TEXTS_AT_ONCE, in_batches, remainder, ship, stage, texts_of, unpacked
from postline.llm.kneser_ney import Scorer, count_grams, fit_groups, letters_only

FOLDS = 5
TUNING_FOLD = 4
UNKNOWN = "und"
SHARPNESS = tuple(float(2**k) for k in range(0, 11))
#: A prediction is rejected when its cross-entropy is this many deviations above that of its language.
REJECT_AT = 6.0


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(docs: DataFrame) -> dict:
    """Models by language, from rows that have one."""
    known = docs.where("lang is not null and text is not null")
    return {name: m for name, m in fit_groups(count_grams(known, "lang", letters_only), modified=False).items() if name is not None}


def cross_entropies(docs: DataFrame, models: dict) -> DataFrame:
    """docs without text, with n characters and nats per character under each language, in the order of models."""
    shipped = ship(docs.sparkSession, list(models.values()))
    keep = [c for c in docs.columns if c != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(unpacked(shipped), letters_only())
        for batch in batches:
            texts = texts_of(batch)
            n, total = scorer.sums(texts)
            nats = -total / np.maximum(n, 1)[:, None] * np.log(10)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * len(models), pa.int32()), pa.array(nats.ravel()))
            letter = pa.array([has_letter(t) for t in texts])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(n), letter, lists], [*keep, "n", "letter", "nats"])

    schema = docs.drop("text").schema
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.mapInArrow(score, f"{kept}, n long, letter boolean, nats array<double>")


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected for every row of docs."""
    in_batches(docs.sparkSession, TEXTS_AT_ONCE)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    fold = remainder("doc_id", FOLDS)
    learning = rows.where(fold != 0)
    models = train(learning)
    names = list(models)
    flags = rows.select("doc_id", "lang", (fold == 0).alias("held_out"), (fold == TUNING_FOLD).alias("tuning"), "text")
    if not names:
        return flags.select(
            "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"),
        )
    others = train(learning.where(fold != TUNING_FOLD)) or models
    sharp, limits = tune(decided(flags.where("tuning and lang is not null"), others), list(others))
    scored = decided(flags, models)
    limit = F.coalesce(*(F.when(F.col("pred") == name, F.lit(v)) for name, v in limits.items()), F.lit(float("inf")))
    return scored.select(
        "doc_id",
        "held_out",
        F.when(F.col("letter"), F.col("pred")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("letter"), 1.0 / odds(F.col("best"), sharp)).otherwise(F.lit(0.0)).alias("score"),
        F.when(F.col("letter"), F.col("best")).alias("cross_entropy"),
        (~F.col("letter") | (F.col("best") > limit)).alias("rejected"),
    )


def decided(flags: DataFrame, models: dict) -> DataFrame:
    """cross_entropies with the best one and its language, pred."""
    best = F.array_min("nats")
    chosen = F.element_at(F.array(*map(F.lit, models)), F.array_position("nats", best).cast("int"))
    return stage(cross_entropies(flags, models)).withColumn("best", best).withColumn("pred", chosen)


def odds(own: Column, sharp: float) -> Column:
    """Summed weight of all languages over that of the one whose cross-entropy is `own`."""
    return F.aggregate("nats", F.lit(0.0), lambda s, x: s + F.exp((own - x) * sharp))


def tune(scored: DataFrame, names: list[str]) -> tuple[float, dict[str, float]]:
    """(sharpness with the best likelihood, cross-entropy limit per language), from the tuning rows."""
    rows = scored.where(F.col("tuning") & F.col("letter") & F.col("lang").isin(names))
    own = F.element_at("nats", F.array_position(F.array(*map(F.lit, names)), F.col("lang")).cast("int"))
    rows = rows.withColumn("own", own)
    gain = [
        F.sum(-F.log(odds(F.col("own"), k))).alias(f"g{i}") for i, k in enumerate(SHARPNESS)
    ]
    likelihood = rows.agg(*gain).first()
    best = max(range(len(SHARPNESS)), key=lambda i: (likelihood[i] if likelihood[i] is not None else 0.0, -i))
    spread = rows.where("pred = lang").groupBy("lang").agg(F.avg("best").alias("m"), F.stddev_pop("best").alias("s")).collect()  # a row per language
    return SHARPNESS[best], {r["lang"]: r["m"] + REJECT_AT * (r["s"] + 1e-3) for r in spread}
