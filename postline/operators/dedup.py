"""Duplicate stored rows: winner choice, merging, and moving the facts that hang on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.payload import empty_payload
from postline.functions.text import non_blank
from postline.operators.folding import duplicate_groups, merge_payloads
from postline.operators.skew import attach
from postline.session import cut_lineage

MAX_DATES = ("reposted_at", "fetched_at", "updated_at")
WINNER_FIRST = ("source", "external_id")


def reference_counts(jobs: DataFrame, cards: DataFrame, others: Iterable[DataFrame]) -> DataFrame:
    """Facts per stored row: `has_cards` and `total_refs`.

    All facts are counted in one aggregate per id; facts of rows outside
    `jobs` drop out in the join.
    """
    tagged = cards.select("job_id", F.lit(1).alias("card"))
    for df in others:
        tagged = tagged.unionByName(df.select("job_id", F.lit(0).alias("card")))
    counts = tagged.groupBy(F.col("job_id").alias("id")).agg(
        (F.max("card") == 1).alias("has_cards"), F.count("*").alias("total_refs")
    )
    joined = jobs.join(counts, "id", "left")
    return joined.withColumns(
        {
            "has_cards": F.coalesce("has_cards", F.lit(False)),
            "total_refs": F.coalesce("total_refs", F.lit(0)),
        }
    )


def rank_order() -> Column:
    """Sorts like: cards first, most facts, newest update, newest fetch, highest id."""
    return F.struct("has_cards", "total_refs", "updated_at", "fetched_at", "id")


def duplicate_mapping(jobs: DataFrame, cards: DataFrame, others: Iterable[DataFrame]) -> DataFrame:
    """loser_id, winner_id, job_url of rows that share a link.

    The winner is an aggregate, joined back with hot links split, so no
    window sorts a whole group in one task.
    """
    slim = jobs.where(F.col("job_url").isNotNull()).select("id", "job_url", "updated_at", "fetched_at")
    ranked = reference_counts(slim, cards, others)
    winners = ranked.groupBy("job_url").agg(
        F.max_by("id", rank_order()).alias("winner_id"), F.count("*").alias("_rows")
    )
    shared = winners.where("_rows > 1")
    pairs = attach(slim.select("id", "job_url"), shared, ["job_url"], F.col("id"), "inner", size="_rows")
    return pairs.where("id <> winner_id").select(F.col("id").alias("loser_id"), "winner_id", "job_url")


def collision_mapping(current: DataFrame, staged: DataFrame) -> DataFrame:
    """loser_id, winner_id, job_url where a staged row meets two stored rows:
    one by (source, external_id), another by link.

    One winner per loser (the smallest id that is not its own), followed to
    the end of its chain; rows that point at each other in a ring go to the
    smallest id of the ring.

    Per identity only the two smallest winners are kept, so an id that very
    many rows share is joined once per row and never pairs all with all. The
    matches of the batch are written once, as several steps read them.
    """
    identity = ["source", "external_id"]
    new = staged.where(F.trim("external_id") != "").select(*identity, "job_url")
    by_id = current.select(F.col("id").alias("loser_id"), *identity)
    by_link = current.select(F.col("id").alias("winner_id"), "job_url")
    winners = cut_lineage(new.join(by_link, "job_url").withColumn("w", F.struct("winner_id", "job_url")))
    first = winners.groupBy(*identity).agg(F.min("w").alias("first"))
    others = attach(winners, first, identity, F.col("winner_id"), "inner").where("w <> first")
    second = others.groupBy(*identity).agg(F.min("w").alias("second"))
    best = cut_lineage(first.join(second, identity, "left"))
    own = F.col("first.winner_id") == F.col("loser_id")
    pairs = attach(by_id, best, identity, F.col("loser_id"), "inner")
    chosen = pairs.select("loser_id", F.when(own, F.col("second")).otherwise(F.col("first")).alias("w"))
    single = chosen.where("w IS NOT NULL").select("loser_id", "w.winner_id", "w.job_url")
    return final_winners(cut_lineage(single))


def final_winners(single: DataFrame) -> DataFrame:
    """Every loser with the winner at the end of its chain, however long it is.

    Pointers double: after k rounds a row points 2**k steps on and knows the
    smallest id on the way. A chain that comes back to itself ends at its
    smallest id, which is then no loser. Rounds stop when all rows point at
    ends, at the latest when a chain through all rows would be walked.
    """
    links = single.groupBy("winner_id").agg(F.min("job_url").alias("job_url"))
    steps = single.select(F.col("loser_id").alias("id"), F.col("winner_id").alias("to"), F.col("loser_id").alias("least"))
    for _ in range(single.count().bit_length() + 1):
        onward = steps.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("least").alias("_least"))
        if steps.join(onward, "to", "left_semi").isEmpty():
            break
        joined = steps.join(onward, "to", "left")
        steps = cut_lineage(
            joined.select("id", F.coalesce("_to", "to").alias("to"), F.least("least", "_least").alias("least"))
        )
    rings = steps.select(F.col("id").alias("to"), F.col("least").alias("_least"))
    ends = steps.drop("least").join(rings, "to", "left").withColumn("winner_id", F.coalesce("_least", "to"))
    return ends.where("id <> winner_id").join(links, "winner_id").select(F.col("id").alias("loser_id"), "winner_id", "job_url")


def touched_ids(mapping: DataFrame) -> DataFrame:
    """id -> winner_id for every loser and every winner of a mapping."""
    losers = mapping.select(F.col("loser_id").alias("id"), "winner_id", F.lit(False).alias("is_winner"))
    winners = mapping.select(F.col("winner_id").alias("id"), "winner_id", F.lit(True).alias("is_winner")).distinct()
    return losers.unionByName(winners)


def merge_losers(jobs: DataFrame, mapping: DataFrame, payload: str = "raw_json") -> DataFrame:
    """All stored rows after the losers went into their winners.

    Rows the mapping does not name pass through without a shuffle of their
    own; the named ones are folded per winner. Losers apply in rank order, so
    the lowest-ranked loser with a value has the last word. Text of losers
    overrides the winner's, source and external id are the winner's first,
    dates take the newest, payload keys the last. The mapping is read several
    times: pass it with its lineage cut.
    """
    touched = touched_ids(mapping)
    marked = jobs.join(touched, "id", "left")
    rest = marked.where("winner_id IS NULL").select(*jobs.columns)
    named = marked.where("winner_id IS NOT NULL")
    order = F.struct("is_winner", "updated_at", "fetched_at", "id")
    kinds = dict(jobs.dtypes)
    made = []
    for name in jobs.columns:
        c = F.col(name)
        if name in ("id", payload):
            continue
        own = F.max_by(c, order)
        if name in MAX_DATES:
            value = F.max(c)
        elif name in WINNER_FIRST:
            value = F.coalesce(F.max_by(non_blank(c), F.when(non_blank(c).isNotNull(), order)), F.min_by(c, order))
        elif name in ("job_url", "is_duplicate"):
            value = own
        else:
            v = non_blank(c) if kinds[name] == "string" else c
            value = F.coalesce(F.min_by(v, F.when(~F.col("is_winner") & v.isNotNull(), order)), own)
        made.append(value.alias(name))
    folded = named.groupBy(F.col("winner_id").alias("id")).agg(*made)
    if payload in kinds:
        payloads = merge_payloads(
            named.withColumn("_id", F.col("winner_id")), ["_id"], payload, order, last=False
        ).withColumnRenamed("_id", "id")
        folded = folded.join(payloads, "id", "left").withColumn(payload, F.coalesce(payload, empty_payload()))
    return rest.unionByName(folded.select(*jobs.columns))


def delete_losers(jobs: DataFrame, mapping: DataFrame) -> DataFrame:
    return jobs.join(mapping.select(F.col("loser_id").alias("id")), "id", "left_anti")


def enforce_unique(jobs: DataFrame, cards: DataFrame, others: Iterable[DataFrame]) -> DataFrame:
    """Stored rows with one row per link."""
    return merge_losers(jobs, cut_lineage(duplicate_mapping(jobs, cards, others)))


def assert_unique(jobs: DataFrame, key: str = "job_url") -> DataFrame:
    """One row: how many links are still shared. 0 after enforce_unique."""
    return duplicate_groups(jobs, key).agg(F.count("*").alias("shared_links"))


# Fact rules: how the values of one user's facts on merged postings combine.
GREATEST, LEAST, ANY, WINNER, LOSER, ALL_OR_NULL, PAYLOAD = (
    "greatest", "least", "any", "winner", "loser", "all_or_null", "payload",
)
MATCH_RULES = {
    "fit_first_analysis": ANY, "created_at": LEAST, "fit_score": GREATEST, "job_fit_output": WINNER,
    "star": ANY, "hide": ANY, "seen": ANY, "seen_at": GREATEST, "last_view_at": GREATEST,
    "link_clicked_at": GREATEST, "attached_resume_normalized": WINNER, "attached_resume_template_name": WINNER,
    "attached_resume_updated_at": GREATEST, "added_by_user": ANY, "distance_km": LEAST, "applied": ANY,
}
CARD_RULES = {
    "stage": WINNER, "common_data": PAYLOAD, "stage_data": PAYLOAD, "metadata": PAYLOAD, "source": WINNER,
    "last_event": LOSER, "moved_at": GREATEST, "created_at": LEAST, "updated_at": GREATEST, "deleted_at": ALL_OR_NULL,
}
DELIVERY_RULES = {
    "delivery_status": LOSER, "email": WINNER, "run_started_at": GREATEST, "delivered_at": GREATEST,
}


def survivor(name: str, kind: str, rule: str, order: Column) -> Column:
    """One aggregate column. `order` is lowest for the winner's own fact."""
    c = F.col(name)
    v = non_blank(c) if kind == "string" else F.when(F.size(c) > 0, c) if kind.startswith("map") else c
    if rule == GREATEST:
        return F.max(c)
    if rule == LEAST:
        return F.min(c)
    if rule == ANY:
        return F.bool_or(F.coalesce(c, F.lit(False)))
    if rule == ALL_OR_NULL:
        return F.when(F.count_if(c.isNull()) == 0, F.max(c))
    here = F.when(v.isNotNull(), order)
    if rule == WINNER:
        return F.min_by(v, here)
    return F.coalesce(F.max_by(v, here), F.min_by(c, order))


def repoint_facts(facts: DataFrame, mapping: DataFrame, rules: dict[str, str], keys: tuple[str, ...]) -> DataFrame:
    """Facts with losers replaced by winners; facts of the same keys merged.

    Only facts of postings the mapping names are grouped, the rest pass through.
    Facts meet the mapping once and are written with what they met, as the rest,
    the fold and each payload read them. `tie` orders facts of the same posting, if the table has it.
    """
    spread = F.xxhash64(*[k for k in keys if k != "job_id"])
    marked = cut_lineage(attach(facts, touched_ids(mapping).withColumnRenamed("id", "job_id"), ["job_id"], spread))
    rest = marked.where("winner_id IS NULL").select(*facts.columns)
    tie = ["tie"] if "tie" in facts.columns else []
    order = F.struct(~F.col("is_winner"), "job_id", *tie)
    named = marked.where("winner_id IS NOT NULL").withColumn("_order", order)
    kinds = dict(facts.dtypes)
    group = [k for k in keys if k != "job_id"]
    made = [
        survivor(c, kinds[c], rule, F.col("_order")).alias(c)
        for c, rule in rules.items()
        if c in kinds and rule != PAYLOAD
    ]
    ties = [F.min("tie").alias("tie")] if tie else []
    folded = named.groupBy(*group, "winner_id").agg(*made, *ties)
    for c, rule in rules.items():
        if rule == PAYLOAD and c in kinds:
            payloads = merge_payloads(named, [*group, "winner_id"], c, F.col("_order"))
            folded = folded.join(payloads, [*group, "winner_id"], "left")
            folded = folded.withColumn(c, F.coalesce(c, empty_payload()))
    return rest.unionByName(folded.withColumnRenamed("winner_id", "job_id").select(*facts.columns))


def activate_reposted(parsed: DataFrame, jobs: DataFrame, staged: DataFrame) -> DataFrame:
    """Parsed postings, with those active again whose row in this batch was reposted.

    Adds `activated`, true where the status changed.
    """
    links = staged.where(F.col("source") == "linkedin").select("job_url").distinct()
    again = jobs.where(F.col("reposted_at").isNotNull()).join(links, "job_url", "left_semi")
    flags = again.select(F.col("id").alias("raw_job_id"), F.lit(True).alias("_again"))
    changed = F.col("_again") & ~F.col("status").eqNullSafe("active")
    joined = parsed.join(flags, "raw_job_id", "left")
    joined = joined.withColumn("activated", F.coalesce(changed, F.lit(False)))
    return joined.withColumn("status", F.when(F.col("activated"), "active").otherwise(F.col("status"))).drop("_again")
