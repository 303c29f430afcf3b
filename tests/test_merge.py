"""Invariants of folds, dedup and the upsert."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postline.operators import dedup, folding, merge, skew
from postline.plans.derive import derived
from postline.plans.folding import staged as staged_of
from postline.plans.merging import facts, stored, unique

SF = "/root/testdata/sf0.001"
RUN = "2001-10-01 12:00:00"
D = dt.date
STORED = (
    "id bigint, job_url string, source string, external_id string, title string, description string, posted_time string, "
    "published_at date, reposted_at date, fetched_at date, updated_at date, raw_json map<string,string>"
)
STAGED = (
    "seq bigint, job_url string, source string, external_id string, title string, description string, posted_time string, "
    "published_at date, raw_json map<string,string>"
)


def old(id, url, source="linkedin", ext="e", published=D(2001, 1, 1), reposted=None, raw=None, description="d"):
    return (id, url, source, ext, "t", description, "p", published, reposted, D(2001, 1, 1), None, raw or {})


def new(seq, url, source="linkedin", ext="e", published=D(2001, 1, 1), raw=None, description="d", title="t"):
    return (seq, url, source, ext, title, description, "p", published, raw or {})


def run(spark, before, batch, **options):
    current = spark.createDataFrame(before, STORED)
    return merge.upsert(current, spark.createDataFrame(batch, STAGED), RUN, 100, **options)


@pytest.mark.parametrize(
    ("seen", "wanted"),
    [(D(2001, 3, 1), D(2001, 3, 1)), (D(2001, 2, 1), D(2001, 2, 1)), (D(2001, 1, 15), D(2001, 2, 1)), (None, D(2001, 10, 1))],
)
def test_repost_only_when_newer(spark, seen, wanted):
    up = run(spark, [old(1, "u", reposted=D(2001, 2, 1))], [new(0, "u", published=seen)])
    assert up.snapshot.first()["reposted_at"] == wanted


def test_repost_only_on_linkedin(spark):
    up = run(spark, [old(1, "u", "indeed")], [new(0, "u", "indeed", published=D(2001, 9, 9))])
    assert up.snapshot.first()["reposted_at"] is None


def test_a_new_title_alone_changes_nothing(spark):
    up = run(spark, [old(1, "u")], [new(0, "u", title="new")])
    assert up.snapshot.first()["title"] == "t" and up.changes.count() == 0
    up = run(spark, [old(1, "u")], [new(0, "u", title="new")], compare_columns=("title",))
    assert up.snapshot.first()["title"] == "new"
    assert up.changes.collect()[0]["field"] == "title"


def test_blank_description_and_known_date_stay(spark):
    raw = {"date_posted": '"2001-01-01"', "description": '"x"', "k": "1"}
    fresh = {"date_posted": '"2002-02-02"', "description": '" "', "k": '"1"'}
    row = run(spark, [old(1, "u", raw=raw)], [new(0, "u", raw=fresh, description="  ")]).snapshot.first()
    assert row["description"] == "d"
    assert row["raw_json"] == {"date_posted": '"2001-01-01"', "description": '"x"', "k": '"1"'}


def test_same_batch_twice_changes_nothing(spark):
    current, batch = unique(spark, SF), staged_of(spark, SF)
    first = merge.upsert(current, batch, RUN, 10**9)
    again = merge.upsert(first.snapshot, batch, RUN, 2 * 10**9)
    got = again.summary.first()
    assert (got["inserted"], got["updated"]) == (0, 0)
    assert again.snapshot.count() == first.snapshot.count()


def test_a_missing_date_counts_as_the_run_date(spark):
    """So a later run of the same undated batch is a repost; a replay of one run is not."""
    first = run(spark, [old(1, "u")], [new(0, "u", published=None)]).snapshot
    later = merge.upsert(first, spark.createDataFrame([new(0, "u", published=None)], STAGED), "2001-11-01 12:00:00", 200)
    assert later.snapshot.first()["reposted_at"] == D(2001, 11, 1)


def test_counts_add_up(spark):
    current, batch = unique(spark, SF), staged_of(spark, SF)
    up = merge.upsert(current, batch, RUN, 10**9)
    s = up.summary.first()
    assert s["inserted"] + s["updated"] + s["unchanged"] == batch.count()
    assert up.snapshot.count() == current.count() + s["inserted"]
    assert dedup.assert_unique(up.snapshot).first()["shared_links"] == 0
    assert up.snapshot.select("id").distinct().count() == up.snapshot.count()
    assert up.changes.select("job_url").distinct().count() == s["updated"]


def test_full_batch_keeps_links_unique_and_losers_out(spark):
    done = merge.upsert_postings(unique(spark, SF), staged_of(spark, SF), RUN, 10**9)
    assert dedup.assert_unique(done.snapshot).first()["shared_links"] == 0
    gone = done.mapping.select(F.col("loser_id").alias("id"))
    assert done.mapping.count() > 0
    assert done.snapshot.join(gone, "id", "left_semi").count() == 0


def test_small_batch_reads_the_stored_rows_twice_and_shuffles_none(spark, tmp_path):
    """Once for the rows it can touch, once for those that go through."""
    unique(spark, SF).write.parquet(str(tmp_path / "stored"))
    current = spark.read.parquet(str(tmp_path / "stored"))
    batch = staged_of(spark, SF).limit(20)
    touched = merge.touched_rows(current, batch)._jdf.queryExecution().executedPlan().toString()
    assert touched.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in touched
    done = merge.upsert_postings(current, batch, RUN, 10**9)
    plan = done.snapshot._jdf.queryExecution().optimizedPlan().toString()
    files = done.snapshot.inputFiles()
    assert plan.count("Relation [") <= 3 and sum("/stored/" in f for f in files) == len(current.inputFiles())
    through = done.snapshot._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in through and "SortMergeJoin" not in through
    whole = merge.upsert_postings(current, batch, RUN, 10**9).summary.first()
    assert whole["prepared"] == 20 and whole["inserted"] + whole["updated"] + whole["unchanged"] == 20


def test_narrowing_changes_nothing(spark):
    """Rows a batch cannot touch take no part in it."""
    current, batch = unique(spark, SF), staged_of(spark, SF)
    part = merge.touched_rows(current, batch)
    assert 0 < part.count() < current.count()
    one, two = (dedup.collision_mapping(rows, batch) for rows in (current, part))
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_summary_of_a_batch(spark):
    rows = [old(1, "a", ext="1", reposted=D(2001, 2, 1)), old(2, "b", ext="2"), old(3, "c", ext="9")]
    landed = [new(0, "a", ext="1", raw={"k": "1"}), new(1, "a", ext="1"), new(2, "b", ext="2"), new(3, "z", ext="z"), new(4, "c", ext="1")]
    staged = folding.fold_inputs(spark.createDataFrame(landed, STAGED)).withColumn("is_duplicate", F.col("job_url") == "b")
    parsed = spark.createDataFrame([(1, "closed"), (2, "closed"), (3, None)], "raw_job_id bigint, status string")
    raw = spark.createDataFrame([(i,) for i in range(7)], "i int")
    done = merge.upsert_postings(spark.createDataFrame(rows, STORED), staged, RUN, 100, parsed=parsed, landed=raw)
    got = done.summary.first().asDict()
    assert (got["rows"], got["prepared"], got["skipped_invalid"], got["skipped_duplicate_input"]) == (7, 4, 2, 1)
    assert (got["deleted_duplicate_rows"], got["marked_duplicate_jobs"]) == (done.mapping.count(), 1)
    assert got["inserted"] == done.result.inserted.count() and got["changes"] == done.result.changes.count()
    assert got["parsed_jobs_activated"] == done.parsed.where("activated").count()


def test_flag_alone_makes_a_row_changed(spark):
    kinds = STORED + ", is_duplicate boolean"
    current = spark.createDataFrame([(*old(1, "u"), False), (*old(2, "v", ext="f"), True)], kinds)
    batch = spark.createDataFrame([(*new(0, "u"), True), (*new(1, "v", ext="f"), True)], STAGED + ", is_duplicate boolean")
    done = merge.upsert_postings(current, batch, RUN, 100, with_flag=True)
    got = {r["id"]: (r["is_duplicate"], r["updated_at"]) for r in done.snapshot.collect()}
    assert got == {1: (True, D(2001, 10, 1)), 2: (True, None)}
    assert [(r["field"], r["before"], r["after"]) for r in done.result.changes.collect()] == [("is_duplicate", "false", "true")]


def test_collisions_chase_chains_and_break_pairs(spark):
    current = spark.createDataFrame([old(1, "a", ext="1"), old(2, "b", ext="2"), old(3, "c", ext="3")], STORED)
    chain = spark.createDataFrame([new(0, "b", ext="1"), new(1, "c", ext="2")], STAGED)
    pairs = {(r["loser_id"], r["winner_id"]) for r in dedup.collision_mapping(current, chain).collect()}
    assert pairs == {(1, 3), (2, 3)}
    swap = spark.createDataFrame([new(0, "b", ext="1"), new(1, "a", ext="2")], STAGED)
    pairs = {(r["loser_id"], r["winner_id"]) for r in dedup.collision_mapping(current, swap).collect()}
    assert pairs == {(2, 1)}


def test_shared_ids_give_one_winner_each(spark):
    rows = [old(i, f"u{i}", ext="same") for i in range(1, 41)]
    batch = [new(i, f"u{i}", ext="same") for i in range(3, 41)]
    mapping = dedup.collision_mapping(spark.createDataFrame(rows, STORED), spark.createDataFrame(batch, STAGED))
    got = {r["loser_id"]: r["winner_id"] for r in mapping.collect()}
    assert got == {i: 3 for i in range(1, 41) if i != 3}


def test_chains_of_any_length_end_at_their_winner(spark):
    rows = [(i, i + 1, f"u{i + 1}") for i in range(1, 9)] + [(20, 5, "u5")]
    single = spark.createDataFrame(rows, "loser_id bigint, winner_id bigint, job_url string")
    got = {(r["loser_id"], r["winner_id"], r["job_url"]) for r in dedup.final_winners(single).collect()}
    assert got == {(i, 9, "u9") for i in [*range(1, 9), 20]}


@pytest.mark.parametrize("size", [2, 3, 5, 8])
def test_rings_end_at_their_smallest_id(spark, size):
    ring = [10 + (7 * i) % size for i in range(size)] if size % 7 else list(range(10, 10 + size))
    rows = [(a, b, f"u{b}") for a, b in zip(ring, ring[1:] + ring[:1])] + [(50, ring[-1], f"u{ring[-1]}"), (51, 50, "u50")]
    single = spark.createDataFrame(rows, "loser_id bigint, winner_id bigint, job_url string")
    got = {(r["loser_id"], r["winner_id"], r["job_url"]) for r in dedup.final_winners(single).collect()}
    assert got == {(i, 10, "u10") for i in [*range(11, 10 + size), 50, 51]}


def test_a_chain_of_eight_stored_rows_is_merged(spark):
    rows = [old(i, f"u{i}", ext=f"e{i}") for i in range(1, 9)]
    batch = [new(i, f"u{i + 1}", ext=f"e{i}") for i in range(1, 8)]
    done = merge.upsert_postings(spark.createDataFrame(rows, STORED), spark.createDataFrame(batch, STAGED), RUN, 100)
    assert [(r["id"], r["job_url"]) for r in done.snapshot.where("id < 100").collect()] == [(8, "u8")]


def test_losers_give_their_values_and_go(spark):
    rows = [old(1, "u", description=" ", raw={"a": "1"}), old(2, "u", description="two", raw={"a": "2", "b": "2"}), old(3, "u", description="three")]
    jobs = spark.createDataFrame(rows, STORED)
    mapping = spark.createDataFrame([(1, 3, "u"), (2, 3, "u")], "loser_id bigint, winner_id bigint, job_url string")
    row = dedup.merge_losers(jobs, mapping).collect()
    assert len(row) == 1 and row[0]["id"] == 3
    assert row[0]["description"] == "two"
    assert row[0]["raw_json"] == {"a": "1", "b": "2"}


def test_facts_are_kept_up_to_merges(spark):
    cards, others = facts(spark, SF)
    mapping = dedup.duplicate_mapping(stored(spark, SF), cards, others).cache()
    moved = dedup.repoint_facts(others[0], mapping, dedup.MATCH_RULES, ("user_id", "job_id"))
    assert moved.join(mapping, moved["job_id"] == mapping["loser_id"], "left_semi").count() == 0
    target = others[0].join(mapping, F.col("job_id") == F.col("loser_id"), "left")
    target = target.select("user_id", F.coalesce("winner_id", "job_id").alias("job_id"))
    assert moved.select("user_id", "job_id").distinct().count() == target.distinct().count()


def test_fold_takes_last_values_and_first_place(spark):
    rows = [(3, "u", "c", None, {"a": "1", "b": "1"}), (1, "u", "a", "x", {"a": "0"}), (2, "u", " ", "y", {"b": "9"})]
    df = spark.createDataFrame(rows, "seq int, job_url string, title string, note string, raw_json map<string,string>")
    for n in (1, 3):
        row = folding.fold_inputs(df.repartition(n)).first()
        assert (row["seq"], row["title"], row["note"], row["copies"]) == (1, "c", "y", 3)
        assert row["raw_json"] == {"a": "1", "b": "1"}


def test_company_link_fold_ties(spark):
    rows = [(1, "b", "ab", "u1"), (2, "b", "xy", "u2"), (3, "b", "ab", "u3"), (4, "b", None, "u4"), (5, "n", None, "v1"), (6, "n", None, "v2")]
    df = spark.createDataFrame(rows, "seq int, base_url string, company_name string, source_job_url string")
    got = {r["base_url"]: (r["company_name"], r["source_job_url"]) for r in folding.fold_company_links(df).collect()}
    assert got == {"b": ("ab", "u3"), "n": (None, "v2")}


def test_attach_with_hot_keys_equals_a_join(spark):
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"))
    side = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        plain = rows.join(side, "k", how).select("id", "k", "v")
        spread = skew.attach(rows, side, ["k"], F.col("id"), how, hot_rows=100).select("id", "k", "v")
        assert spread.exceptAll(plain).count() == 0 and plain.exceptAll(spread).count() == 0


def test_hot_rows_are_spread_over_tasks(spark):
    rows = spark.range(8000).select("id", F.lit(1).alias("k"))
    side = spark.createDataFrame([(1, 2)], "k int, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = skew.attach(rows, side, ["k"], F.col("id"), hot_rows=100).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(r["count"] for r in sizes) < 4000


def test_number_within_equals_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5003).alias("seq"), (F.col("id") % 3).alias("k"))
    numbered = skew.number_within(df, "k", bucket_rows=64)
    df.createOrReplaceTempView("numbers")
    plain = spark.sql("SELECT k, seq, cast(row_number() OVER (PARTITION BY k ORDER BY seq) as bigint) rn FROM numbers")
    assert numbered.select("k", "seq", "rn").exceptAll(plain).count() == 0
    cut = skew.slice_within(df, "k", 100, 50, bucket_rows=64)
    assert cut.select("k", "seq").exceptAll(plain.where("rn > 100 and rn <= 150").select("k", "seq")).count() == 0
    assert cut.count() == 150


def test_realign_gives_one_row_per_link(spark):
    current = spark.createDataFrame([old(1, "a"), old(2, "b"), old(3, "x", ext="9")], STORED)
    batch = spark.createDataFrame([new(0, "new"), new(1, "x", ext="9")], STAGED)
    got = {r["id"]: r["job_url"] for r in merge.realign_links(current, batch).collect()}
    assert got == {1: "new", 2: "b", 3: "x"}


def test_rows_without_a_key_are_dealt(spark):
    """Half of the rows have no key: none is lost and no task gets them all."""
    from postline.operators import skew

    rows = spark.range(40_000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN id % 1000 END AS k")
    side = spark.range(0, 1000, 2).selectExpr("id AS k", "id + 1 AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = skew.attach(rows, side, ["k"], F.col("id"))
        tasks = found.groupBy(F.spark_partition_id().alias("task")).agg(F.count_if(F.col("k").isNull()).alias("n")).collect()
        assert sum(t["n"] for t in tasks) == 20_000 and max(t["n"] for t in tasks) < 10_000
        assert found.where("v = k + 1").count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_facts_meet_the_mapping_once(spark):
    """The rest, the fold and each payload read what was written; the plan behind the facts runs once."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def note(n):
        made.add(1)
        return f"n{n}"

    facts = spark.range(30).select(
        F.lit(1).alias("user_id"), (F.col("id") % 10).alias("job_id"), F.col("id").alias("tie"), note("id").alias("stage"),
        F.create_map(F.concat(F.lit("k"), F.col("id") % 2), F.col("id").cast("string")).alias("common_data"),
    )
    mapping = spark.createDataFrame([(1, 0, "a"), (2, 0, "a")], "loser_id long, winner_id long, job_url string")
    got = dedup.repoint_facts(facts, mapping, {"stage": dedup.WINNER, "common_data": dedup.PAYLOAD}, ("user_id", "job_id")).collect()
    assert made.value == 30
    folded = [r for r in got if r["job_id"] == 0]
    assert len(got) == 1 + 7 * 3 and len(folded) == 1
    assert folded[0]["stage"] == "n0" and folded[0]["common_data"] == {"k0": "22", "k1": "21"}
