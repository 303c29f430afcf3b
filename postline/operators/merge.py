"""Upsert of a staged batch into the stored postings, with change tracking.

Returns DataFrames; the caller writes the new snapshot and switches to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.payload import empty_payload, overlay, payload_json, payload_text, without_keys
from postline.functions.text import match_key, non_blank
from postline.functions.lookups import BOARD_SOURCES
from postline.operators.dedup import activate_reposted, collision_mapping, merge_losers
from postline.operators.records import is_direct_page
from postline.operators.skew import attach
from postline.session import cut_lineage

# Columns of a summary; none of them alone makes a row changed.
SUMMARY_COLUMNS = (
    "title", "location", "company_name", "company_url", "company_id", "description", "applications_count",
    "contract_type", "experience_level", "work_type", "sector", "salary", "poster_full_name",
    "poster_profile_url", "apply_url", "apply_type", "benefits", "source", "external_id",
)
PROTECTED = "date_posted"
IGNORED_KEYS = (PROTECTED, *SUMMARY_COLUMNS)
KEEP_FIRST = ("posted_time", "published_at")


def default_dates(staged: DataFrame, run_ts: str) -> DataFrame:
    """Blank posting time becomes the run time, a missing date the run date."""
    return staged.withColumns(
        {
            "posted_time": F.coalesce(non_blank(F.col("posted_time")), F.lit(run_ts)),
            "published_at": F.coalesce("published_at", F.lit(run_ts[:10]).cast("date")),
        }
    )


def merge_payload(current: Column, new: Column) -> Column:
    """Right side wins, but a blank description and a known posting date stay."""
    kept = F.map_filter(
        F.coalesce(new, empty_payload()),
        lambda k, v: ~((k == "description") & (F.btrim(v, F.lit('" ')).isin("", "null"))),
    )
    known = F.map_contains_key(F.coalesce(current, empty_payload()), F.lit(PROTECTED))
    safe = F.map_filter(kept, lambda k, _: ~(known & (k == PROTECTED)))
    return overlay(current, safe)


def residual(payload: Column) -> Column:
    """What of a payload counts as a change, as comparable text."""
    return payload_json(without_keys(F.coalesce(payload, empty_payload()), IGNORED_KEYS))


def reposted(source: Column, new_date: Column, published: Column, before: Column) -> Column:
    """A newer date on linkedin is a repost; else what was known."""
    newest = F.greatest(published, before)
    return F.when((source == "linkedin") & published.isNotNull() & (new_date > newest), new_date).otherwise(before)


def existing(current: DataFrame, staged: DataFrame) -> DataFrame:
    """Links of the batch that are stored already."""
    return current.select("job_url").join(staged.select("job_url"), "job_url", "left_semi").distinct()


def realign_links(current: DataFrame, staged: DataFrame) -> DataFrame:
    """Give a stored row the new link of its (source, external id), unless another row has that link.

    Of several staged links of one identity the smallest is taken, and of
    several stored rows of one identity that would get the same link only the
    one with the smallest id, so links stay unique.
    """
    stated = staged.where(F.trim("external_id") != "")
    new = stated.groupBy("source", "external_id").agg(F.min("job_url").alias("new_url"))
    slim = current.select("id", "source", "external_id", "job_url")
    moves = attach(slim, new, ["source", "external_id"], F.col("id"), "inner").where(~F.col("job_url").eqNullSafe(F.col("new_url")))
    taken = current.select(F.col("job_url").alias("new_url")).join(new.select("new_url"), "new_url", "left_semi")
    free = moves.join(taken, "new_url", "left_anti")
    chosen = cut_lineage(free.groupBy("new_url").agg(F.min("id").alias("id")))
    joined = current.join(chosen, "id", "left")
    return joined.withColumn("job_url", F.coalesce("new_url", "job_url")).select(*current.columns)


def compare(
    current: DataFrame, staged: DataFrame, compare_columns: tuple[str, ...] = (), with_flag: bool = False
) -> DataFrame:
    """Every stored row with its staged one (n_ columns), the merged payload and repost date, and `changed`.

    A left join from the stored side: a batch below the broadcast limit costs
    no shuffle of the stored rows.
    """
    new = staged.select("job_url", F.lit(True).alias("_hit"), *[
        F.col(c).alias(f"n_{c}") for c in staged.columns if c not in ("job_url", "seq", "copies")
    ])
    both = current.join(new, "job_url", "left")
    both = both.withColumns(
        {
            "_payload": F.when(F.col("_hit"), merge_payload(F.col("raw_json"), F.col("n_raw_json"))),
            "_reposted": reposted(
                F.col("n_source"), F.col("n_published_at"), F.col("published_at"), F.col("reposted_at")
            ),
            "_description": F.coalesce(non_blank(F.col("n_description")), F.col("description")),
        }
    )
    both = both.withColumns(
        {
            "_before": F.when(F.col("_hit"), residual(F.col("raw_json"))),
            "_after": F.when(F.col("_hit"), residual(F.col("_payload"))),
        }
    )
    tests = [~F.col("_before").eqNullSafe(F.col("_after")), ~F.col("reposted_at").eqNullSafe(F.col("_reposted"))]
    for c in compared(compare_columns, with_flag):
        tests.append(~F.col(c).eqNullSafe(_candidate(c)))
    changed = tests[0]
    for t in tests[1:]:
        changed = changed | t
    return both.withColumn("changed", F.coalesce(F.col("_hit") & changed, F.lit(False)))


def compared(compare_columns: tuple[str, ...], with_flag: bool) -> tuple[str, ...]:
    return (*compare_columns, "is_duplicate") if with_flag else compare_columns


def _candidate(c: str) -> Column:
    return F.col("_description") if c == "description" else F.col(f"n_{c}")


def new_rows(current: DataFrame, staged: DataFrame, next_id: int, run_ts: str) -> DataFrame:
    """Staged rows whose link is not stored, as stored rows. Ids follow the landing order."""
    fresh = staged.join(existing(current, staged), "job_url", "left_anti")
    have = set(staged.columns)
    kinds = dict(current.dtypes)
    made = {
        "id": (F.lit(next_id) + F.col("seq")).cast("bigint"),
        "fetched_at": F.lit(run_ts).cast(kinds["fetched_at"]),
        "updated_at": F.lit(None).cast(kinds["updated_at"]),
        "reposted_at": F.lit(None).cast("date"),
    }
    return fresh.select(
        *[
            (made[c] if c in made else F.col(c) if c in have else F.lit(None).cast(kinds[c])).alias(c)
            for c in current.columns
        ]
    )


def apply_changes(compared_rows: DataFrame, columns: list[str], run_ts: str) -> DataFrame:
    """Stored rows with the column rules applied where a row changed."""
    kinds = dict(compared_rows.dtypes)
    out = []
    for c in columns:
        if f"n_{c}" not in kinds and c not in ("updated_at", "reposted_at"):
            out.append(F.col(c))
            continue
        if c in KEEP_FIRST:
            value = F.coalesce(F.col(c), F.col(f"n_{c}"))
        elif c == "description":
            value = F.col("_description")
        elif c == "raw_json":
            value = F.col("_payload")
        elif c == "reposted_at":
            value = F.col("_reposted")
        elif c == "updated_at":
            value = F.lit(run_ts).cast(kinds[c])
        else:
            value = F.col(f"n_{c}")
        out.append(F.when(F.col("changed"), value).otherwise(F.col(c)).alias(c))
    return compared_rows.select(*out)


def change_log(compared_rows: DataFrame, compare_columns: tuple[str, ...] = (), with_flag: bool = False) -> DataFrame:
    """job_id, job_url, field, before, after: one row per changed field."""
    def entry(field: str, before: Column, after: Column) -> Column:
        differs = ~before.eqNullSafe(after)
        row = F.struct(
            F.lit(field).alias("field"), before.cast("string").alias("before"), after.cast("string").alias("after")
        )
        return F.when(differs, row)

    entries = [entry(c, F.col(c), _candidate(c)) for c in compared(compare_columns, with_flag)]
    entries.append(entry("raw_json", F.col("_before"), F.col("_after")))
    entries.append(entry("reposted_at", F.col("reposted_at"), F.col("_reposted")))
    job_id = F.coalesce(non_blank(F.col("n_external_id")), non_blank(F.col("external_id")), F.col("job_url"))
    rows = compared_rows.where("changed").select(
        job_id.alias("job_id"),
        "job_url",
        F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"),
    )
    return rows.select("job_id", "job_url", "e.*")


@dataclass(frozen=True)
class Upsert:
    """What an upsert gives back."""

    snapshot: DataFrame
    inserted: DataFrame
    compared: DataFrame
    changes: DataFrame
    summary: DataFrame


def upsert(
    current: DataFrame,
    staged: DataFrame,
    run_ts: str,
    next_id: int = 0,
    compare_columns: tuple[str, ...] = (),
    with_flag: bool = False,
) -> Upsert:
    """Insert new links, update changed ones, keep the rest. Links are unique on both sides."""
    staged = default_dates(staged, run_ts)
    rows = compare(current, staged, compare_columns, with_flag)
    fresh = new_rows(current, staged, next_id, run_ts)
    snapshot = apply_changes(rows, current.columns, run_ts).unionByName(fresh)
    changes = change_log(rows, compare_columns, with_flag)
    return Upsert(snapshot, fresh, rows, changes, summary(rows, fresh, changes))


def summary(rows: DataFrame, fresh: DataFrame, changes: DataFrame) -> DataFrame:
    """One row: inserted, updated, kept, and the names of changed fields.

    Links of inserted and updated rows stay in their frames; they have no bound.
    """
    counts = rows.agg(
        F.count_if("changed").alias("updated"),
        F.count_if(F.col("_hit") & ~F.col("changed")).alias("unchanged"),
        F.lit(0).cast("bigint").alias("inserted"),
    )
    added = fresh.agg(F.count("*").alias("inserted"))
    fields = changes.agg(F.array_join(F.array_sort(F.collect_set("field")), ",").alias("updated_fields"))
    stacked = counts.unionByName(added, allowMissingColumns=True).unionByName(fields, allowMissingColumns=True)
    return stacked.agg(
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("inserted"),
        F.coalesce(F.sum("updated"), F.lit(0)).alias("updated"),
        F.coalesce(F.sum("unchanged"), F.lit(0)).alias("unchanged"),
        F.max("updated_fields").alias("updated_fields"),
    )


def touched_rows(current: DataFrame, staged: DataFrame) -> DataFrame:
    """Stored rows that a batch can touch: those with one of its links or of its identities.

    One scan; the keys of a small batch go to it and no stored row is shuffled.
    """
    links = staged.select("job_url").distinct().withColumn("_link", F.lit(True))
    stated = staged.where(F.trim("external_id") != "")
    identities = stated.select("source", "external_id").distinct().withColumn("_identity", F.lit(True))
    marked = current.join(links, "job_url", "left").join(identities, ["source", "external_id"], "left")
    return marked.where("_link or _identity").select(*current.columns)


@dataclass(frozen=True)
class Batch:
    """What a whole batch gives back. `compared` and `changes` hold the rows it could touch."""

    snapshot: DataFrame
    touched: DataFrame
    result: Upsert
    mapping: DataFrame
    parsed: DataFrame | None
    summary: DataFrame


def upsert_postings(
    current: DataFrame,
    staged: DataFrame,
    run_ts: str,
    next_id: int = 0,
    parsed: DataFrame | None = None,
    landed: DataFrame | None = None,
    **options: object,
) -> Batch:
    """The whole batch: dates, identity collisions, realigned links, upsert, reactivation, summary.

    `current` has one row per link; see dedup.enforce_unique. The stored rows
    are read twice: once for those the batch can touch, which are written and
    then stand for all of them, and once for the rows that go through unread.
    """
    staged = cut_lineage(default_dates(staged, run_ts))
    part = cut_lineage(touched_rows(current, staged))
    mapping = cut_lineage(collision_mapping(part, staged))
    aligned = cut_lineage(realign_links(cut_lineage(merge_losers(part, mapping)), staged))
    result = upsert(aligned, staged, run_ts, next_id, **options)
    touched = cut_lineage(result.snapshot)
    rest = current.join(part.select("id"), "id", "left_anti")
    active = None if parsed is None else activate_reposted(parsed, touched, staged)
    counts = batch_summary(result, staged, mapping, active, landed)
    return Batch(rest.unionByName(touched), touched, result, mapping, active, counts)


def batch_summary(
    result: Upsert, staged: DataFrame, mapping: DataFrame, parsed: DataFrame | None, landed: DataFrame | None
) -> DataFrame:
    """One row of counts for a whole batch; the links behind them are in its frames.

    Without the landed rows the rows are those that were folded. An activated
    row is a parsed one whose status changed; marked rows are staged ones with
    the duplicate flag.
    """
    none = F.lit(0).cast("bigint")
    copies = F.col("copies") if "copies" in staged.columns else F.lit(1)
    marked = F.count_if("is_duplicate") if "is_duplicate" in staged.columns else F.max(none)
    prepared = staged.agg(F.count("*").alias("prepared"), F.sum(copies).alias("_folded"), marked.alias("marked"))
    landed_rows = (staged.agg(F.sum(copies).alias("rows")) if landed is None else landed.agg(F.count("*").alias("rows")))
    changes = result.changes.agg(F.count("*").alias("changes"))
    deleted = mapping.agg(F.count("*").alias("deleted"))
    active = (mapping.limit(0) if parsed is None else parsed.where("activated")).agg(F.count("*").alias("activated"))
    parts = [result.summary, prepared, landed_rows, changes, deleted, active]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), none)

    return stacked.agg(
        total("rows").alias("rows"),
        total("prepared").alias("prepared"),
        (total("rows") - total("_folded")).alias("skipped_invalid"),
        (total("_folded") - total("prepared")).alias("skipped_duplicate_input"),
        total("inserted").alias("inserted"),
        total("updated").alias("updated"),
        total("unchanged").alias("unchanged"),
        total("changes").alias("changes"),
        total("activated").alias("parsed_jobs_activated"),
        total("deleted").alias("deleted_duplicate_rows"),
        total("marked").alias("marked_duplicate_jobs"),
        F.max("updated_fields").alias("updated_fields"),
    )


def company_keys(catalog: DataFrame) -> DataFrame:
    """Match keys of the names and aliases of enabled career pages."""
    from postline.functions.text import to_text_list

    names = F.concat(F.array(F.col("company_name")), to_text_list(F.col("company_aliases")))
    keys = catalog.where("enabled").select(F.explode(names).alias("name")).select(match_key(F.col("name")).alias("match_key"))
    return keys.where(F.col("match_key").isNotNull()).distinct()


def flag_configured(records: DataFrame, catalog: DataFrame, spread: str = "job_url") -> DataFrame:
    """Adds is_duplicate: a board row of a company that has its own configured page.

    The records are read twice (once for the company names alone, to find hot
    ones): pass a staged batch, not a plan that maps raw rows again.
    """
    keyed = records.withColumn("match_key", match_key(F.col("company_name")))
    wanted = company_keys(catalog).withColumn("_wanted", F.lit(True))
    joined = attach(keyed, wanted, ["match_key"], F.col(spread))
    board = F.col("source").isin(*BOARD_SOURCES) & ~F.coalesce(is_direct_page(F.col("raw_json")), F.lit(False))
    flag = F.coalesce(board & F.col("_wanted"), F.lit(False))
    return joined.withColumn("is_duplicate", flag).drop("match_key", "_wanted")


def stored_details(current: DataFrame) -> DataFrame:
    """Latest stored row per linkedin link as enrichment values; payload before column."""
    from postline.functions.jobs import job_type_list
    from postline.functions.money import safe_int
    from postline.functions.text import clean_text
    from postline.operators.folding import latest

    rows = latest(current.where(F.col("source") == "linkedin"), "job_url")
    p = F.col("raw_json")

    def both(key: str, column: str) -> Column:
        own = clean_text(F.col(column)) if column in current.columns else F.lit(None)
        return F.coalesce(clean_text(payload_text(p, key)), own)

    types = both("job_type", "contract_type")
    return rows.select(
        "job_url",
        both("description", "description").alias("description"),
        safe_int(both("applications_count", "applications_count")).alias("applications_count"),
        job_type_list(F.split(types, ",")).alias("job_type"),
        both("job_level", "experience_level").alias("job_level"),
        both("company_industry", "sector").alias("company_industry"),
        both("apply_url", "apply_url").alias("apply_url"),
        both("job_url_direct", "job_url_direct").alias("job_url_direct"),
        both("job_function", "job_function").alias("job_function"),
    )


def enrich(fresh: DataFrame, details: DataFrame) -> DataFrame:
    """Fresh values first, stored ones where missing; the applicant count is always the fresh one."""
    shared = [c for c in details.columns if c in fresh.columns and c not in ("job_url", "applications_count")]
    side = details.select("job_url", *[F.col(c).alias(f"d_{c}") for c in shared])
    joined = fresh.join(side, "job_url", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"d_{c}")) for c in shared}).select(*fresh.columns)
