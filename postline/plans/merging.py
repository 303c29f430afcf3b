"""Queries over stored rows: winners, merges, facts, upsert, change log, flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.functions import payload
from postline.operators import dedup, folding, joins, merge
from postline.plans.derive import RUN_DATE, derived, oracle
from postline.plans.folding import BATCH_KEYS, FOLDED, payload_sql, staged, with_payload
from postline.plans.records import clean
from postline.plans.registry import query
from postline.session import cut_lineage

C = F.col
RUN_TS = f"{RUN_DATE} 12:00:00"
KEYS = ("p_description", "p_date_posted", "p_score", "p_tag")
STORED_SHOWN = (
    "id", "job_url", "source", "external_id", "title", "company_name", "description", "posted_time",
    "published_at", "reposted_at", "fetched_at", "updated_at",
)


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_payload(derived(spark, sf_dir, "stored"))


def facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[DataFrame]]:
    cards = derived(spark, sf_dir, "cards")
    return cards, [derived(spark, sf_dir, n) for n in ("matches", "deliveries")]


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows with one row per link: the newest id of each."""
    return folding.last_seen(stored(spark, sf_dir), "job_url", seq="id")


def show(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*STORED_SHOWN, *extra, payload.payload_json(C("raw_json")).alias("payload"))


UNIQUE = "SELECT s.* FROM stored AS s JOIN (SELECT job_url, max(id) AS id FROM stored GROUP BY 1) AS m ON m.id = s.id"
REFS = """
SELECT s.id, s.job_url, s.updated_at, s.fetched_at,
  coalesce(k.n, 0) > 0 AS has_cards, coalesce(k.n, 0) + coalesce(f.n, 0) + coalesce(e.n, 0) AS total_refs
FROM stored AS s
LEFT JOIN (SELECT job_id, count(*) AS n FROM cards GROUP BY 1) AS k ON k.job_id = s.id
LEFT JOIN (SELECT job_id, count(*) AS n FROM matches GROUP BY 1) AS f ON f.job_id = s.id
LEFT JOIN (SELECT job_id, count(*) AS n FROM deliveries GROUP BY 1) AS e ON e.job_id = s.id"""
MAPPING = f"""
SELECT id AS loser_id, winner_id, job_url FROM (
  SELECT id, job_url, first_value(id) OVER w AS winner_id, row_number() OVER w AS rn FROM ({REFS}) AS r
  WINDOW w AS (PARTITION BY job_url ORDER BY has_cards DESC, total_refs DESC, updated_at DESC NULLS LAST, fetched_at DESC NULLS LAST, id DESC)
) AS x WHERE rn > 1"""
ALL_FACTS = ("stored", "cards", "matches", "deliveries")


@query("agg_10_reference_counts", "AGG-10 JN-04", oracle(f"SELECT id, has_cards, CAST(total_refs AS BIGINT) AS total_refs FROM ({REFS}) AS r", *ALL_FACTS))
def reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, others = facts(spark, sf_dir)
    return dedup.reference_counts(derived(spark, sf_dir, "stored").select("id"), cards, others)


@query("win_01_winner_mapping", "WIN-01 MRG-07 JN-04 AGG-01", oracle(MAPPING, *ALL_FACTS))
def winner_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, others = facts(spark, sf_dir)
    return dedup.duplicate_mapping(derived(spark, sf_dir, "stored"), cards, others)


def nb(c: str) -> str:
    return f"nullif(trim({c}, ' '), '')"


# Losers in order: the last of them with a value has the word.
LOSE = "NOT w"


def loser_text(c: str) -> str:
    return f"coalesce(arg_max({nb(c)}, o) FILTER (WHERE {LOSE} AND {nb(c)} IS NOT NULL), arg_max({c}, o) FILTER (WHERE w), any_value({c}) FILTER (WHERE w))"


def loser_any(c: str) -> str:
    return f"coalesce(arg_max({c}, o) FILTER (WHERE {LOSE} AND {c} IS NOT NULL), any_value({c}) FILTER (WHERE w))"


def winner_first(c: str) -> str:
    return f"coalesce(arg_min({nb(c)}, o) FILTER (WHERE {nb(c)} IS NOT NULL), arg_max({c}, o))"


SURVIVORS = f"""
WITH mapping AS ({MAPPING}),
touched AS (SELECT loser_id AS id, winner_id, FALSE AS w FROM mapping UNION ALL SELECT DISTINCT winner_id, winner_id, TRUE FROM mapping),
named AS (SELECT s.*, t.winner_id, t.w, row_number() OVER (PARTITION BY t.winner_id ORDER BY t.w DESC,
    s.updated_at DESC NULLS LAST, s.fetched_at DESC NULLS LAST, s.id DESC) AS o FROM stored AS s JOIN touched AS t ON t.id = s.id),
folded AS (SELECT winner_id AS id, any_value(job_url) AS job_url, {winner_first('source')} AS source, {winner_first('external_id')} AS external_id,
  {loser_text('title')} AS title, {loser_text('company_name')} AS company_name, {loser_text('description')} AS description,
  {loser_text('posted_time')} AS posted_time, {loser_any('published_at')} AS published_at, max(reposted_at) AS reposted_at,
  max(fetched_at) AS fetched_at, max(updated_at) AS updated_at,
  {payload_sql({p: f"arg_max({p}, o) FILTER (WHERE {p} IS NOT NULL)" for p in KEYS})} AS payload FROM named GROUP BY winner_id)
SELECT * FROM folded UNION ALL SELECT {', '.join(STORED_SHOWN)}, {payload_sql({p: p for p in KEYS})} FROM stored WHERE id NOT IN (SELECT id FROM touched)"""


@query("mrg_08_merge_losers", "MRG-07 MRG-08 MRG-09 JN-05", oracle(SURVIVORS, *ALL_FACTS))
def merge_losers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, others = facts(spark, sf_dir)
    rows = stored(spark, sf_dir)
    return show(dedup.enforce_unique(rows, cards, others))


@query("mrg_07_delete_losers", "MRG-07", oracle(f"SELECT id, job_url FROM stored WHERE id NOT IN (SELECT loser_id FROM ({MAPPING}) AS m)", *ALL_FACTS))
def delete_losers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, others = facts(spark, sf_dir)
    rows = derived(spark, sf_dir, "stored")
    return dedup.delete_losers(rows, dedup.duplicate_mapping(rows, cards, others)).select("id", "job_url")


@query("mrg_09_assert_unique", "MRG-09", oracle("SELECT CAST(0 AS BIGINT) AS shared_links FROM (SELECT count(*) FROM stored) AS s", "stored"))
def assert_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, others = facts(spark, sf_dir)
    rows = stored(spark, sf_dir)
    return dedup.assert_unique(dedup.enforce_unique(rows, cards, others))


def repointed(body: str, table: str) -> str:
    return f"""
WITH mapping AS ({MAPPING}),
touched AS (SELECT loser_id AS id, winner_id, FALSE AS w FROM mapping UNION ALL SELECT DISTINCT winner_id, winner_id, TRUE FROM mapping),
named AS (SELECT f.*, t.winner_id, t.w, row_number() OVER (ORDER BY NOT t.w, f.job_id, f.tie) AS o FROM {table} AS f JOIN touched AS t ON t.id = f.job_id),
rest AS (SELECT * FROM {table} WHERE job_id NOT IN (SELECT id FROM touched))
{body}"""


def first(c: str, blank: bool = False) -> str:
    v = nb(c) if blank else c
    return f"arg_min({v}, o) FILTER (WHERE {v} IS NOT NULL)"


def final(c: str) -> str:
    return f"coalesce(arg_max({nb(c)}, o) FILTER (WHERE {nb(c)} IS NOT NULL), arg_min({c}, o))"


MATCH_SHOWN = (
    "user_id", "job_id", "fit_first_analysis", "created_at", "fit_score", "job_fit_output", "star", "hide", "seen_at",
    "attached_resume_template_name", "distance_km",
)


@query(
    "jn_07_repoint_matches",
    "JN-07 AGG-08",
    oracle(
        repointed(
            f"""SELECT user_id, winner_id AS job_id, bool_or(coalesce(fit_first_analysis, FALSE)) AS fit_first_analysis, min(created_at) AS created_at,
  max(fit_score) AS fit_score, {first('job_fit_output', True)} AS job_fit_output, bool_or(coalesce(star, FALSE)) AS star, bool_or(coalesce(hide, FALSE)) AS hide,
  max(seen_at) AS seen_at, {first('attached_resume_template_name', True)} AS attached_resume_template_name, min(distance_km) AS distance_km
FROM named GROUP BY 1, 2 UNION ALL SELECT {', '.join(MATCH_SHOWN)} FROM rest""",
            "matches",
        ),
        *ALL_FACTS,
    ),
)
def repoint_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, others = facts(spark, sf_dir)
    mapping = cut_lineage(dedup.duplicate_mapping(derived(spark, sf_dir, "stored"), cards, others))
    return dedup.repoint_facts(others[0], mapping, dedup.MATCH_RULES, ("user_id", "job_id")).select(*MATCH_SHOWN)


CARD_SHOWN = ("user_id", "job_id", "stage", "source", "last_event", "moved_at", "created_at", "deleted_at")


@query(
    "jn_07_repoint_cards",
    "JN-07 AGG-08",
    oracle(
        repointed(
            f"""SELECT user_id, winner_id AS job_id, {first('stage', True)} AS stage, {first('source', True)} AS source, {final('last_event')} AS last_event,
  max(moved_at) AS moved_at, min(created_at) AS created_at, CASE WHEN count(*) = count(deleted_at) THEN max(deleted_at) END AS deleted_at,
  '{{' || concat_ws(',', '"note":"' || arg_max(d_note, o) FILTER (WHERE d_note IS NOT NULL) || '"', '"step":"' || arg_max(d_step, o) FILTER (WHERE d_step IS NOT NULL) || '"') || '}}' AS common_data
FROM named GROUP BY 1, 2 UNION ALL SELECT {', '.join(CARD_SHOWN)}, '{{' || concat_ws(',', '"note":"' || d_note || '"', '"step":"' || d_step || '"') || '}}' FROM rest""",
            "cards",
        ),
        *ALL_FACTS,
    ),
)
def repoint_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.operators.records import json_text

    cards, others = facts(spark, sf_dir)
    mapping = cut_lineage(dedup.duplicate_mapping(derived(spark, sf_dir, "stored"), cards, others))
    data = F.create_map(F.lit("note"), json_text(C("d_note")), F.lit("step"), json_text(C("d_step")))
    rows = cards.withColumn("common_data", F.map_filter(data, lambda _, v: v.isNotNull())).drop("d_note", "d_step")
    out = dedup.repoint_facts(rows, mapping, dedup.CARD_RULES, ("user_id", "job_id"))
    return out.select(*CARD_SHOWN, payload.payload_json(C("common_data")).alias("common_data"))


SENT_SHOWN = ("user_id", "job_id", "service_name", "delivery_status", "email", "run_started_at", "delivered_at")


@query(
    "jn_07_repoint_deliveries",
    "JN-07 AGG-08",
    oracle(
        repointed(
            f"""SELECT user_id, winner_id AS job_id, service_name, {final('delivery_status')} AS delivery_status, {first('email', True)} AS email,
  max(run_started_at) AS run_started_at, max(delivered_at) AS delivered_at
FROM named GROUP BY 1, 2, 3 UNION ALL SELECT {', '.join(SENT_SHOWN)} FROM rest""",
            "deliveries",
        ),
        *ALL_FACTS,
    ),
)
def repoint_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, others = facts(spark, sf_dir)
    mapping = cut_lineage(dedup.duplicate_mapping(derived(spark, sf_dir, "stored"), cards, others))
    keys = ("user_id", "job_id", "service_name")
    return dedup.repoint_facts(others[1], mapping, dedup.DELIVERY_RULES, keys).select(*SENT_SHOWN)


# The batch, folded, with its dates filled; and stored rows, one per link.
STAGED = f"""
SELECT * REPLACE (coalesce({nb('posted_time')}, '{RUN_TS}') AS posted_time, coalesce(published_at, DATE '{RUN_DATE}') AS published_at)
FROM ({FOLDED}) AS f"""


@query("mrg_03_default_dates", "MRG-03", oracle(f"SELECT job_url, posted_time, published_at FROM ({STAGED}) AS s", "batch"))
def default_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.default_dates(staged(spark, sf_dir), RUN_TS).select("job_url", "posted_time", "published_at")


@query(
    "jn_01_existing_match",
    "JN-01",
    oracle(f"SELECT DISTINCT s.job_url FROM ({STAGED}) AS s JOIN stored AS j ON j.job_url = s.job_url", "batch", "stored"),
)
def existing_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.existing(derived(spark, sf_dir, "stored"), staged(spark, sf_dir))


def collision_ctes(rows: str, staged_rows: str, tag: str = "") -> str:
    """CTEs up to mapping{tag}: chains are walked step by step, rings end at their smallest id."""
    return f"""
pairs{tag} AS (SELECT DISTINCT a.id AS loser_id, b.id AS winner_id, b.job_url FROM {staged_rows} AS s
  JOIN {rows} AS a ON a.source = s.source AND a.external_id = s.external_id JOIN {rows} AS b ON b.job_url = s.job_url
  WHERE trim(s.external_id) <> '' AND a.id <> b.id),
single{tag} AS (SELECT loser_id, min(winner_id) AS winner_id, arg_min(job_url, winner_id) AS job_url FROM pairs{tag} GROUP BY 1),
walk{tag} AS (SELECT loser_id, winner_id AS goal, [loser_id] AS path FROM single{tag}
  UNION ALL SELECT w.loser_id, s.winner_id, list_append(w.path, w.goal) FROM walk{tag} AS w JOIN single{tag} AS s ON s.loser_id = w.goal
  WHERE NOT list_contains(w.path, w.goal)),
ends{tag} AS (SELECT loser_id, CASE WHEN list_contains(path, goal) THEN list_min(list_slice(path, list_position(path, goal), len(path))) ELSE goal END AS winner_id
  FROM walk{tag} WHERE list_contains(path, goal) OR goal NOT IN (SELECT loser_id FROM single{tag})),
mapping{tag} AS (SELECT e.loser_id, e.winner_id, l.job_url FROM ends{tag} AS e
  JOIN (SELECT winner_id, min(job_url) AS job_url FROM single{tag} GROUP BY 1) AS l ON l.winner_id = e.winner_id WHERE e.loser_id <> e.winner_id)"""


COLLISIONS = f"WITH RECURSIVE u AS ({UNIQUE}), f AS ({FOLDED}), {collision_ctes('u', 'f')} SELECT * FROM mapping"


@query("jn_02_identity_collisions", "JN-02 MRG-07", oracle(COLLISIONS, "batch", "stored"))
def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.collision_mapping(unique(spark, sf_dir), staged(spark, sf_dir))


@query(
    "jn_03_realign_links",
    "JN-03",
    oracle(
        f"""
WITH u AS ({UNIQUE}), new AS (SELECT source, external_id, min(job_url) AS new_url FROM ({FOLDED}) AS f WHERE trim(external_id) <> '' GROUP BY 1, 2),
moves AS (SELECT n.new_url, min(u.id) AS id FROM u JOIN new AS n ON n.source = u.source AND n.external_id = u.external_id
  WHERE u.job_url <> n.new_url AND n.new_url NOT IN (SELECT job_url FROM u) GROUP BY 1)
SELECT u.id, coalesce(m.new_url, u.job_url) AS job_url FROM u LEFT JOIN moves AS m ON m.id = u.id""",
        "batch", "stored",
    ),
)
def realign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.realign_links(unique(spark, sf_dir), staged(spark, sf_dir)).select("id", "job_url")


# Stored row u next to its staged row s, with everything the merge decides.
MERGED = {
    "p_description": f"coalesce({nb('s.p_description')}, u.p_description)",
    "p_date_posted": "coalesce(u.p_date_posted, s.p_date_posted)",
    "p_score": "coalesce(s.p_score, u.p_score)",
    "p_tag": "coalesce(s.p_tag, u.p_tag)",
    "p_direct_key": "s.p_direct_key",
}
BEFORE = payload_sql({"p_score": "u.p_score", "p_tag": "u.p_tag"})
AFTER = payload_sql({k: MERGED[k] for k in ("p_score", "p_tag", "p_direct_key")})
REPOSTED = (
    "CASE WHEN s.source = 'linkedin' AND u.published_at IS NOT NULL AND s.published_at > greatest(u.published_at, coalesce(u.reposted_at, u.published_at)) "
    "THEN s.published_at ELSE u.reposted_at END"
)
COMPARED = f"""
SELECT u.*, s.job_url IS NOT NULL AS hit, s.source AS n_source, s.external_id AS n_external_id, s.title AS n_title, s.company_name AS n_company_name,
  s.posted_time AS n_posted_time, s.published_at AS n_published_at, coalesce({nb('s.description')}, u.description) AS n_description,
  {REPOSTED} AS n_reposted, {BEFORE} AS before, {AFTER} AS after, {payload_sql(MERGED)} AS n_payload,
  s.job_url IS NOT NULL AND ({BEFORE} <> {AFTER} OR u.reposted_at IS DISTINCT FROM {REPOSTED}) AS changed
FROM ({UNIQUE}) AS u LEFT JOIN ({STAGED}) AS s ON s.job_url = u.job_url"""


def pick(c: str) -> str:
    return f"CASE WHEN changed THEN n_{c} ELSE {c} END AS {c}"


SNAPSHOT = f"""
WITH c AS ({COMPARED})
SELECT id, job_url, {pick('source')}, {pick('external_id')}, {pick('title')}, {pick('company_name')}, {pick('description')},
  CASE WHEN changed THEN coalesce(posted_time, n_posted_time) ELSE posted_time END AS posted_time,
  CASE WHEN changed THEN coalesce(published_at, n_published_at) ELSE published_at END AS published_at,
  CASE WHEN changed THEN n_reposted ELSE reposted_at END AS reposted_at, fetched_at,
  CASE WHEN changed THEN DATE '{RUN_DATE}' ELSE updated_at END AS updated_at,
  CASE WHEN changed THEN n_payload ELSE {payload_sql({p: p for p in KEYS})} END AS payload FROM c
UNION ALL SELECT 900000000 + seq, job_url, source, external_id, title, company_name, description, posted_time, published_at, NULL, DATE '{RUN_DATE}', NULL,
  {payload_sql({p: p for p in BATCH_KEYS})} FROM ({STAGED}) AS s WHERE job_url NOT IN (SELECT job_url FROM stored)"""


def _upsert(spark: SparkSession, sf_dir: str, **options: object) -> merge.Upsert:
    return merge.upsert(unique(spark, sf_dir), staged(spark, sf_dir), RUN_TS, 900000000, **options)


@query("mrg_01_upsert_snapshot", "MRG-01 MRG-02 MRG-03 MRG-04 MRG-05 JN-01", oracle(SNAPSHOT, "batch", "stored"))
def upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(_upsert(spark, sf_dir).snapshot)


@query(
    "flt_10_change_predicate",
    "FLT-10",
    oracle(f"SELECT id, changed FROM ({COMPARED}) AS c", "batch", "stored"),
)
def change_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir).compared.select("id", "changed")


@query(
    "flt_10_change_predicate_wide",
    "FLT-10",
    oracle(
        f"""SELECT id, hit AND (changed OR title IS DISTINCT FROM n_title OR description IS DISTINCT FROM n_description) AS changed FROM ({COMPARED}) AS c""",
        "batch", "stored",
    ),
)
def change_predicate_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, compare_columns=("title", "description")).compared.select("id", "changed")


@query(
    "mrg_04_protected_payload",
    "MRG-04",
    oracle(f"SELECT id, n_payload AS payload FROM ({COMPARED}) AS c WHERE hit", "batch", "stored"),
)
def protected_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _upsert(spark, sf_dir).compared.where("_hit")
    return rows.select("id", payload.payload_json(C("_payload")).alias("payload"))


@query(
    "mrg_05_repost_detection",
    "MRG-05",
    oracle(f"SELECT id, n_reposted AS reposted_at FROM ({COMPARED}) AS c WHERE hit AND reposted_at IS DISTINCT FROM n_reposted", "batch", "stored"),
)
def repost_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _upsert(spark, sf_dir).compared
    moved = rows.where(C("_hit") & ~C("reposted_at").eqNullSafe(C("_reposted")))
    return moved.select("id", C("_reposted").alias("reposted_at"))


LOG = f"""
WITH c AS (SELECT * FROM ({COMPARED}) AS x WHERE changed),
e AS (SELECT job_url, coalesce({nb('n_external_id')}, {nb('external_id')}, job_url) AS job_id, 'raw_json' AS field, before, after FROM c
  UNION ALL SELECT job_url, coalesce({nb('n_external_id')}, {nb('external_id')}, job_url), 'reposted_at', CAST(reposted_at AS STRING), CAST(n_reposted AS STRING) FROM c
  UNION ALL SELECT job_url, coalesce({nb('n_external_id')}, {nb('external_id')}, job_url), 'title', title, n_title FROM c)
SELECT * FROM e WHERE before IS DISTINCT FROM after"""


@query("mrg_06_change_log", "MRG-06 ORD-02", oracle(LOG + " AND field <> 'title' ORDER BY job_url", "batch", "stored"))
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.operators.output import order_changes

    return order_changes(_upsert(spark, sf_dir).changes)


ALL_KEYS = ("p_date_posted", "p_description", "p_direct_key", "p_score", "p_tag")
WHOLE = (*STORED_SHOWN, "is_duplicate", *ALL_KEYS)
BASE = f"SELECT {', '.join(STORED_SHOWN)}, is_duplicate, {', '.join(KEYS)}, CAST(NULL AS STRING) AS p_direct_key FROM ({UNIQUE}) AS u"


def batch_ctes(rows: str, staged_rows: str, tag: str, next_id: int, flag: bool = False) -> str:
    """CTEs of a whole batch over the CTEs rows and staged_rows; after{tag} holds the rows it leaves."""
    merged = {p: f"coalesce(s.{p}, u.{p})" for p in ALL_KEYS}
    merged |= {"p_description": f"coalesce({nb('s.p_description')}, u.p_description)", "p_date_posted": "coalesce(u.p_date_posted, s.p_date_posted)"}
    rest_keys = ("p_direct_key", "p_score", "p_tag")
    before, after = payload_sql({p: f"u.{p}" for p in rest_keys}), payload_sql({p: merged[p] for p in rest_keys})
    flagged = " OR u.is_duplicate IS DISTINCT FROM s.is_duplicate" if flag else ""
    new_flag = "n_is_duplicate" if flag else "is_duplicate"
    return f"""{collision_ctes(rows, staged_rows, tag)},
touched{tag} AS (SELECT loser_id AS id, winner_id, FALSE AS w FROM mapping{tag} UNION ALL SELECT DISTINCT winner_id, winner_id, TRUE FROM mapping{tag}),
named{tag} AS (SELECT s.*, t.winner_id, t.w, row_number() OVER (PARTITION BY t.winner_id ORDER BY t.w DESC,
    s.updated_at DESC NULLS LAST, s.fetched_at DESC NULLS LAST, s.id DESC) AS o FROM {rows} AS s JOIN touched{tag} AS t ON t.id = s.id),
merged{tag} AS (SELECT winner_id AS id, any_value(job_url) FILTER (WHERE w) AS job_url, {winner_first('source')} AS source, {winner_first('external_id')} AS external_id,
  {loser_text('title')} AS title, {loser_text('company_name')} AS company_name, {loser_text('description')} AS description,
  {loser_text('posted_time')} AS posted_time, {loser_any('published_at')} AS published_at, max(reposted_at) AS reposted_at,
  max(fetched_at) AS fetched_at, max(updated_at) AS updated_at, any_value(is_duplicate) FILTER (WHERE w) AS is_duplicate,
  {', '.join(f"arg_max({p}, o) FILTER (WHERE {p} IS NOT NULL) AS {p}" for p in ALL_KEYS)} FROM named{tag} GROUP BY winner_id
  UNION ALL SELECT {', '.join(WHOLE)} FROM {rows} WHERE id NOT IN (SELECT id FROM touched{tag})),
new{tag} AS (SELECT source, external_id, min(job_url) AS new_url FROM {staged_rows} WHERE trim(external_id) <> '' GROUP BY 1, 2),
moves{tag} AS (SELECT n.new_url, min(u.id) AS id FROM merged{tag} AS u JOIN new{tag} AS n ON n.source = u.source AND n.external_id = u.external_id
  WHERE u.job_url <> n.new_url AND n.new_url NOT IN (SELECT job_url FROM merged{tag}) GROUP BY 1),
aligned{tag} AS (SELECT u.* REPLACE (coalesce(m.new_url, u.job_url) AS job_url) FROM merged{tag} AS u LEFT JOIN moves{tag} AS m ON m.id = u.id),
compared{tag} AS (SELECT u.*, s.job_url IS NOT NULL AS hit, s.source AS n_source, s.external_id AS n_external_id, s.title AS n_title, s.company_name AS n_company_name,
  s.posted_time AS n_posted_time, s.published_at AS n_published_at, coalesce({nb('s.description')}, u.description) AS n_description,
  {REPOSTED} AS n_reposted_at, {before} AS before, {after} AS after, {', '.join(f"{e} AS n_{p}" for p, e in merged.items())},
  {'s.is_duplicate AS n_is_duplicate,' if flag else ''}
  s.job_url IS NOT NULL AND ({before} <> {after} OR u.reposted_at IS DISTINCT FROM {REPOSTED}{flagged}) AS changed
  FROM aligned{tag} AS u LEFT JOIN {staged_rows} AS s ON s.job_url = u.job_url),
fresh{tag} AS (SELECT s.* FROM {staged_rows} AS s WHERE job_url NOT IN (SELECT job_url FROM aligned{tag})),
after{tag} AS (SELECT id, job_url, {pick('source')}, {pick('external_id')}, {pick('title')}, {pick('company_name')}, {pick('description')},
  CASE WHEN changed THEN coalesce(posted_time, n_posted_time) ELSE posted_time END AS posted_time,
  CASE WHEN changed THEN coalesce(published_at, n_published_at) ELSE published_at END AS published_at,
  {pick('reposted_at')}, fetched_at, CASE WHEN changed THEN DATE '{RUN_DATE}' ELSE updated_at END AS updated_at,
  CASE WHEN changed THEN {new_flag} ELSE is_duplicate END AS is_duplicate, {', '.join(pick(p) for p in ALL_KEYS)} FROM compared{tag}
  UNION ALL SELECT {next_id} + seq, job_url, source, external_id, title, company_name, description, posted_time, published_at, NULL, DATE '{RUN_DATE}', NULL,
  {'is_duplicate' if flag else 'NULL'}, {', '.join(ALL_KEYS)} FROM fresh{tag})"""


def shown(rows: str, *extra: str) -> str:
    return f"SELECT {', '.join((*STORED_SHOWN, *extra))}, {payload_sql({p: p for p in ALL_KEYS})} AS payload FROM {rows}"


NEXT_ID = 900000000
FULL = f"WITH RECURSIVE base AS ({BASE}), s AS ({STAGED}), {batch_ctes('base', 's', '1', NEXT_ID)} "


def _full(spark: SparkSession, sf_dir: str, **options: object) -> merge.Batch:
    return merge.upsert_postings(unique(spark, sf_dir), staged(spark, sf_dir), RUN_TS, NEXT_ID, **options)


@query("mrg_01_full_batch", "MRG-01 MRG-07 MRG-08 JN-02 JN-03", oracle(FULL + shown("after1"), "batch", "stored"))
def full_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(_full(spark, sf_dir).snapshot)


PARSED = "SELECT id, CASE id % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'closed' END AS status FROM stored"


def parsed_of(rows: DataFrame) -> DataFrame:
    status = F.when(C("id") % 3 == 0, "active").when(C("id") % 3 == 1, "closed")
    return rows.select(C("id").alias("raw_job_id"), status.alias("status"))


@query(
    "agg_05_upsert_summary",
    "AGG-05",
    oracle(
        FULL
        + f"""SELECT (SELECT count(*) FROM batch) AS rows, (SELECT count(*) FROM s) AS prepared, CAST(0 AS BIGINT) AS skipped_invalid,
  (SELECT count(*) FROM batch) - (SELECT count(*) FROM s) AS skipped_duplicate_input, (SELECT count(*) FROM fresh1) AS inserted,
  count_if(changed) AS updated, count_if(hit AND NOT changed) AS unchanged,
  CAST(count_if(changed AND before IS DISTINCT FROM after) + count_if(changed AND reposted_at IS DISTINCT FROM n_reposted_at) AS BIGINT) AS changes,
  (SELECT count(*) FROM ({PARSED}) AS p WHERE status IS DISTINCT FROM 'active' AND id IN (SELECT a.id FROM after1 AS a JOIN s ON s.job_url = a.job_url
    WHERE s.source = 'linkedin' AND a.reposted_at IS NOT NULL)) AS parsed_jobs_activated,
  (SELECT count(*) FROM mapping1) AS deleted_duplicate_rows, CAST(0 AS BIGINT) AS marked_duplicate_jobs,
  concat_ws(',', CASE WHEN bool_or(changed AND before IS DISTINCT FROM after) THEN 'raw_json' END,
    CASE WHEN bool_or(changed AND reposted_at IS DISTINCT FROM n_reposted_at) THEN 'reposted_at' END) AS updated_fields FROM compared1""",
        "batch", "stored",
    ),
)
def upsert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, landed = derived(spark, sf_dir, "stored"), derived(spark, sf_dir, "batch")
    return _full(spark, sf_dir, parsed=parsed_of(rows), landed=landed).summary


@query(
    "jn_08_activate_reposted",
    "JN-08",
    oracle(
        f"""
WITH links AS (SELECT job_url FROM ({FOLDED}) AS f WHERE source = 'linkedin'),
again AS (SELECT id FROM stored WHERE reposted_at IS NOT NULL AND job_url IN (SELECT job_url FROM links))
SELECT id AS raw_job_id, CASE WHEN id IN (SELECT id FROM again) THEN 'active' ELSE status END AS status,
  id IN (SELECT id FROM again) AND status IS DISTINCT FROM 'active' AS activated
FROM ({PARSED}) AS p""",
        "batch", "stored",
    ),
)
def activate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(spark, sf_dir, "stored")
    return dedup.activate_reposted(parsed_of(rows), rows, staged(spark, sf_dir))


KEYS_SQL = f"""
SELECT DISTINCT lower(regexp_replace({clean('name')}, '\\s+', ' ', 'g')) AS k FROM (
  SELECT company_name AS name FROM catalog WHERE enabled
  UNION ALL SELECT unnest(string_split(company_aliases, ',')) FROM catalog WHERE enabled) AS n WHERE {clean('name')} IS NOT NULL"""


@query(
    "jn_06_configured_company_flag",
    "JN-06",
    oracle(
        f"""WITH keys AS ({KEYS_SQL})
SELECT job_url, source, company_name, coalesce(source IN ('linkedin', 'indeed') AND p_direct_key IS NULL
  AND lower(regexp_replace({clean('company_name')}, '\\s+', ' ', 'g')) IN (SELECT k FROM keys), FALSE) AS is_duplicate FROM ({FOLDED}) AS f""",
        "batch", "catalog",
    ),
)
def configured_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = merge.flag_configured(staged(spark, sf_dir), derived(spark, sf_dir, "catalog"))
    return flagged.select("job_url", "source", "company_name", "is_duplicate")


FLAG = f"""coalesce(source IN ('linkedin', 'indeed') AND p_direct_key IS NULL
  AND lower(regexp_replace({clean('company_name')}, '\\s+', ' ', 'g')) IN (SELECT k FROM keys), FALSE)"""


@query(
    "mrg_01_flagged_batch",
    "MRG-01 JN-06 FLT-10",
    oracle(
        f"""WITH RECURSIVE keys AS ({KEYS_SQL}), base AS ({BASE}), s AS (SELECT *, {FLAG} AS is_duplicate FROM ({STAGED}) AS f),
{batch_ctes('base', 's', '1', NEXT_ID, flag=True)} {shown('after1', 'is_duplicate')}""",
        "batch", "stored", "catalog",
    ),
)
def flagged_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = merge.flag_configured(staged(spark, sf_dir), derived(spark, sf_dir, "catalog"))
    done = merge.upsert_postings(unique(spark, sf_dir), flagged, RUN_TS, NEXT_ID, with_flag=True)
    return show(done.snapshot, "is_duplicate")


@query(
    "jn_06_flag_counts",
    "JN-06 AGG-03",
    oracle(
        f"""WITH keys AS ({KEYS_SQL})
SELECT source, count_if(lower(regexp_replace({clean('company')}, '\\s+', ' ', 'g')) IN (SELECT k FROM keys)
   AND source IN ('linkedin', 'indeed', 'glassdoor', 'greenhouse', 'comeet', 'google', 'zip_recruiter', 'bayt', 'naukri', 'bdjobs')) AS flagged, count(*) AS n FROM postings GROUP BY 1""",
        "postings", "catalog",
    ),
)
def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings").select("seq", "source", C("company").alias("company_name"), payload.empty_payload().alias("raw_json"))
    flagged = merge.flag_configured(df, derived(spark, sf_dir, "catalog"), spread="seq")
    return flagged.groupBy("source").agg(F.count_if("is_duplicate").alias("flagged"), F.count("*").alias("n"))


DETAILS = f"""
SELECT job_url, coalesce({clean('p_description')}, {clean('description')}) AS description, {clean('title')} AS job_level
FROM (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY updated_at DESC NULLS LAST, fetched_at DESC NULLS LAST, id DESC) AS rn FROM stored WHERE source = 'linkedin') AS s WHERE rn = 1"""


@query(
    "jn_09_stored_detail_enrichment",
    "JN-09 WIN-02",
    oracle(
        f"""SELECT f.job_url, coalesce({clean('f.description')}, d.description) AS description, coalesce(f.company_name, d.job_level) AS job_level
        FROM ({FOLDED}) AS f LEFT JOIN ({DETAILS}) AS d ON d.job_url = f.job_url""",
        "batch", "stored",
    ),
)
def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = merge.stored_details(stored(spark, sf_dir).withColumn("experience_level", C("title")))
    fresh = staged(spark, sf_dir).select(
        "job_url", F.nullif(F.trim("description"), F.lit("")).alias("description"), C("company_name").alias("job_level")
    )
    return merge.enrich(fresh, details)


@query(
    "jn_14_new_postings",
    "JN-14 AGG-02",
    oracle(
        f"""SELECT p_direct_key AS page_key, count(*) AS new_jobs FROM batch WHERE job_url NOT IN (SELECT job_url FROM stored) AND p_direct_key IS NOT NULL GROUP BY 1""",
        "batch", "stored",
    ),
)
def new_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.operators.reports import new_per_company

    fresh = _upsert(spark, sf_dir).inserted
    batch = derived(spark, sf_dir, "batch")
    rows = batch.select("seq", "job_url", C("p_direct_key").alias("direct_company_career_page_key"))
    return new_per_company(joins.only_new(rows, fresh))


HYDRATED = f"""
WITH p AS (SELECT seq, {clean('job_url')} AS link, description, CASE WHEN contains(lower(job_url), 'linkedin.com/jobs/view/')
   THEN regexp_extract(regexp_replace({clean('job_url')}, '[?#].*$', ''), '([0-9]+)/?$', 1) END AS job_id FROM postings),
d AS (SELECT CAST(jid AS STRING) AS job_id, max(description) FILTER (WHERE seq % 5 > 0) AS description FROM postings WHERE jid % 4 > 0 GROUP BY 1)
SELECT seq, CASE WHEN {clean('d.description')} IS NOT NULL THEN d.description ELSE p.description END AS description,
  CASE WHEN link IS NULL THEN 'skipped' WHEN {clean('d.description')} IS NOT NULL THEN 'hydrated' ELSE 'failed' END AS hydration
FROM p LEFT JOIN d ON d.job_id = p.job_id"""


@query("jn_11_hydrate_details", "JN-11", oracle(HYDRATED, "postings"))
def hydrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hydrated(spark, sf_dir).select("seq", "description", "hydration")


def _hydrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "postings").select("seq", "job_url", "description", "jid")
    details = (
        df.where("jid % 4 > 0")
        .groupBy(C("jid").cast("string").alias("job_id"))
        .agg(F.max(F.when(C("seq") % 5 > 0, C("description"))).alias("description"))
    )
    return joins.hydrate(df.drop("jid"), details)


@query(
    "jn_11_hydration_summary",
    "JN-11",
    oracle(
        f"""SELECT count_if(hydration <> 'skipped') AS requested, count_if(hydration = 'hydrated') AS hydrated, count_if(hydration = 'failed') AS failed
        FROM ({HYDRATED}) AS h""",
        "postings",
    ),
)
def hydration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.hydration_summary(_hydrated(spark, sf_dir))


@query(
    "prj_22_fill_from_detail",
    "PRJ-22",
    oracle(f"SELECT id, coalesce({clean('detail_name')}, {clean('name')}) AS name, coalesce(detail_url, url) AS url FROM positions", "positions"),
)
def fill_from_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "positions")
    detail = df.where(C("size") % 5 == 0).select("id", C("detail_name").alias("name"), C("detail_url").alias("url"))
    extra = df.where((C("size") % 5 != 0) & (C("size") % 7 == 0)).select("id", F.lit(None).cast("string").alias("name"), C("detail_url").alias("url"))
    return joins.detail_first(detail.unionByName(extra), df.select("id", "name", "url"), "id", ["name", "url"])


@query(
    "prj_24_first_of_choices",
    "PRJ-24",
    oracle(
        f"""SELECT id, coalesce({clean('logo_medium')}, {clean('logo_small')}, {clean('logo_original')}, picture) AS logo,
        CASE WHEN active_1 THEN city_1 WHEN active_2 THEN city_2 ELSE city_1 END AS city FROM positions""",
        "positions",
    ),
)
def first_of_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postline.functions.location import active_place

    df = derived(spark, sf_dir, "positions")
    none = F.lit(None).cast("string")
    places = F.array(
        *[
            F.struct(
                C(f"active_{i}").alias("active"), C(f"city_{i}").alias("city"), none.alias("name"), none.alias("state"),
                C(f"country_{i}").alias("country"),
            )
            for i in (1, 2)
        ]
    )
    logo = joins.first_of(C("logo_medium"), C("logo_small"), C("logo_original"), C("picture"))
    return df.select("id", logo.alias("logo"), active_place(places)["city"].alias("city"))


@query(
    "jn_13_company_context",
    "JN-13",
    oracle("SELECT p.id, p.name, c.company_name, c.career_page_url FROM positions AS p LEFT JOIN catalog AS c ON c.company_key = p.page_key", "positions", "catalog"),
)
def company_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derived(spark, sf_dir, "catalog").select(C("company_key").alias("page_key"), "company_name", "career_page_url")
    joined = joins.with_context(derived(spark, sf_dir, "positions"), pages)
    return joined.select("id", "name", "company_name", "career_page_url")
