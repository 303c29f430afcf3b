"""Streams give what tables give; batches can be run again."""

import pytest
from pyspark.sql import functions as F

from postline.operators import folding, merge
from postline.plans import streams
from postline.plans.derive import derived, derived_from
from postline.plans.folding import with_payload
from postline.plans.merging import RUN_TS, show, unique
from postline.session import cut_lineage
from postline.streaming import ingest, tick_state, ticks

SF = "/root/testdata/sf0.001"


def stage(rows):
    return folding.fold_inputs(with_payload(derived_from(rows, "batch")))


def landed(spark, folder, parts):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    for i in range(parts):
        orders.where(F.col("o_orderkey") % parts == i).coalesce(1).write.parquet(f"{folder}/part={i}")
    return spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")


def test_micro_batches_equal_upserts_in_turn(spark, tmp_path):
    store = str(tmp_path / "store")
    ingest.write_version(unique(spark, SF), store, 0)
    stream = landed(spark, str(tmp_path / "landing"), 2)
    ingest.ingest(stream, store, str(tmp_path / "state"), stage, RUN_TS).awaitTermination()
    versions = {r["version"] for r in ingest.all_versions(spark, store).select("version").distinct().collect()}
    assert versions == {0, 1, 2}
    expected = unique(spark, SF)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    for part in range(2):
        expected = merge.upsert_postings(expected, stage(orders.where(F.col("o_orderkey") % 2 == part)), RUN_TS, 10**9).snapshot
    got, wanted = show(ingest.read_store(spark, store)), show(expected)
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0
    assert got.select("id").distinct().count() == got.count()


def test_a_version_makes_its_rows_once(spark, tmp_path):
    """The identities come from the rows that were written; the plan behind them does not run again for them."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def identity(n):
        made.add(1)
        return f"E{n}"

    rows = spark.range(40).select("id", F.concat(F.lit("l"), "id").alias("job_url"), F.lit("s").alias("source"), identity("id").alias("external_id"))
    store = str(tmp_path / "store")
    ingest.write_version(rows, store, 0, buckets=4)
    assert made.value == 40
    entries = spark.read.parquet(f"{store}/_identities/version=0")
    wanted = rows.select("source", "external_id", ingest.link_bucket(4).alias("lies_in"))
    assert entries.select(*wanted.columns).exceptAll(wanted).count() == 0 and entries.count() == 40
    ingest.write_version(rows.where("id < 0"), store, 1)
    assert ingest.read_store(spark, store).count() == 40


def test_a_part_lands_in_many_files(spark):
    """One file, and so one task, is not all that a large part gets; no row is lost or repeated."""
    parts = streams.landed_parts(spark, SF, rows_each=100)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    for i, part in enumerate(parts):
        wanted = orders.where(F.col("o_orderkey") % streams.PARTS == i)
        assert part.rdd.getNumPartitions() == -(-wanted.count() // 100) > 1
        assert part.exceptAll(wanted).count() == 0 and part.count() == wanted.count()


def test_a_new_run_never_overwrites_a_version(spark, tmp_path):
    """A compacted base and a new checkpoint: the first batch goes above it; a restart goes on."""
    store = str(tmp_path / "store")
    ingest.write_version(unique(spark, SF), store, 1)
    before = ingest.read_store(spark, store).count()
    assert ingest.base_version(spark, store, str(tmp_path / "one")) == 2
    stream = landed(spark, str(tmp_path / "landing"), 1)
    ingest.ingest(stream, store, str(tmp_path / "one"), stage, RUN_TS).awaitTermination()
    assert ingest.base_version(spark, store, str(tmp_path / "one")) == 2
    assert ingest.base_version(spark, store, str(tmp_path / "two")) == 3
    assert ingest.all_versions(spark, store).where("version = 1").count() == before


def test_a_version_can_be_run_again(spark, tmp_path):
    store = str(tmp_path / "store")
    ingest.write_version(unique(spark, SF), store, 0)
    batch = folding.fold_inputs(with_payload(derived(spark, SF, "batch")))
    runs = []
    for _ in range(2):
        ingest.apply_batch(spark, store, batch, 1, RUN_TS, 10**9)
        runs.append(sorted(map(str, show(ingest.read_store(spark, store)).collect())))
    assert runs[0] == runs[1]
    ingest.compact(spark, store, str(tmp_path / "compact"), 1)
    assert sorted(map(str, show(ingest.read_store(spark, str(tmp_path / "compact"))).collect())) == runs[0]


def files_of(df):
    """(version, bucket) of the files that rows come from."""
    files = [r["f"] for r in df.select(F.input_file_name().alias("f")).distinct().collect()]
    return {tuple(int(p.split("=")[1]) for p in f.split("/")[-3:-1]) for f in files}


def listed(df):
    """Buckets whose files the scan may open at all."""
    return {int(f.split("/")[-2].split("=")[1]) for f in df.inputFiles()}


def small_batch(spark):
    return folding.fold_inputs(with_payload(derived(spark, SF, "batch").where("seq < 12")))


def break_other_buckets(store, kept):
    """Files of all buckets but the kept ones become unreadable."""
    broken = 0
    for f in store.glob("version=*/_bucket=*/*.parquet"):
        if int(f.parent.name.split("=")[1]) not in kept:
            f.write_bytes(b"no parquet")
            f.with_name(f".{f.name}.crc").unlink()
            broken += 1
    return broken


def test_a_small_batch_reads_only_its_buckets(spark, tmp_path):
    rows, batch = unique(spark, SF), merge.default_dates(small_batch(spark), RUN_TS)
    stores = [tmp_path / "whole", tmp_path / "broken"]
    for store in stores:
        ingest.write_version(rows, str(store), 0, buckets=64)
    layout = ingest.read_layout(spark, str(stores[1]))
    wanted = ingest.buckets_of_batch(spark, str(stores[1]), layout, batch)
    reach = ingest.rows_in_reach(spark, str(stores[1]), layout, batch)
    assert listed(reach) <= wanted and 0 < len(wanted) < 32
    touched = merge.touched_rows(rows, batch)
    assert {r[0] for r in touched.select(ingest.link_bucket(64)).distinct().collect()} <= wanted
    assert break_other_buckets(stores[1], wanted) > 30
    for store in stores:
        ingest.apply_batch(spark, str(store), batch, 1, RUN_TS, 10**9)
    got = [sorted(map(str, show(spark.read.parquet(f"{s}/version=1")).collect())) for s in stores]
    assert got[0] == got[1] and got[0]


def test_rows_that_move_to_other_links(spark, tmp_path):
    """A batch gives links away and the next one takes them back; the store equals upserts of whole tables in turn."""
    store = str(tmp_path / "store")
    rows = unique(spark, SF)
    ingest.write_version(rows, store, 0, buckets=16)
    batch = small_batch(spark).withColumn("external_id", F.concat(F.lit("moves-"), F.col("job_url")))
    other = batch.withColumn("job_url", F.concat("job_url", F.lit("/elsewhere")))
    for version, staged in enumerate((batch, other, batch, other.where("seq % 2 = 0")), 1):
        ingest.apply_batch(spark, store, staged, version, RUN_TS, 10**9 + 1000 * version)
        rows = cut_lineage(merge.upsert_postings(rows, staged, RUN_TS, 10**9 + 1000 * version).snapshot)
        got, wanted = show(ingest.read_store(spark, store)), show(rows)
        assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0, version
    moved = ingest.all_versions(spark, store).where("_gone")
    assert moved.count() > 0


def test_compaction_by_bucket(spark, tmp_path):
    store = str(tmp_path / "store")
    ingest.write_version(unique(spark, SF), store, 0, buckets=16)
    batch = small_batch(spark)
    for version in (1, 2, 3):
        ingest.apply_batch(spark, store, batch.withColumn("title", F.lit(f"title {version}")).where(f"seq % 3 < {version}"), version, RUN_TS, 10**9)
    before = sorted(map(str, show(ingest.read_store(spark, store)).collect()))
    often = {b for _, b in files_of(ingest.all_versions(spark, store).where("version = 3"))}
    worn = ingest.compact_buckets(spark, store, 4, most=3)
    assert worn and set(worn) <= often
    assert sorted(map(str, show(ingest.read_store(spark, store)).collect())) == before
    found = files_of(ingest.all_versions(spark, store).where(F.col("_bucket").isin(worn)))
    assert {v for v, _ in found} == {4}
    assert ingest.compact_buckets(spark, store, 5, most=3) == []
    assert ingest.base_version(spark, store, "a new run") == 5
    ingest.apply_batch(spark, store, batch.withColumn("title", F.lit("title 5")), 5, RUN_TS, 10**9, compare_columns=("title",))
    titles = ingest.read_store(spark, store).join(batch.select("job_url"), "job_url", "left_semi").select("title").distinct().collect()
    assert [r["title"] for r in titles] == ["title 5"]


def test_columns_that_come_late(spark, tmp_path):
    store = str(tmp_path / "store")
    one = spark.createDataFrame([(1, "a", "s", "1"), (2, "b", "s", None)], "id long, job_url string, source string, external_id string")
    ingest.write_version(one, store, 0, buckets=4)
    ingest.write_version(one.where("id = 2").withColumn("salary", F.lit("5")), store, 1)
    got = sorted((r["id"], r["salary"]) for r in ingest.read_store(spark, store).collect())
    assert got == [(1, None), (2, "5")]
    assert ingest.read_layout(spark, store, 1).columns.names == [*one.columns, "_gone"]
    with pytest.raises(ValueError, match="holds no version"):
        ingest.all_versions(spark, str(tmp_path / "none"))


def test_tick_state_equals_the_table_rule(spark, tmp_path):
    """Any zone, sources that are null or slow, a row at a tick and one a microsecond after it; late rows apart."""
    rows = [("a", "2024-03-28 21:00:00"), ("a", "2024-03-29 05:30:00"), ("a", "2024-03-29 05:30:00.000001"), (None, "2024-03-29 06:00:00"),
            ("slow", "2024-03-29 05:31:00"), ("slow", "2024-03-29 19:40:00"), ("a", "2024-03-31 04:29:59.999999"), ("b", "2024-03-31 20:31:00")]
    events = spark.createDataFrame(rows, "source string, ts string").select("source", F.col("ts").cast("timestamp").alias("ts"))
    clock = spark.createDataFrame([("clock", "2024-05-01 00:00:00"), ("clock", "2024-05-02 00:00:00")], "source string, ts string")
    clock = clock.withColumn("ts", F.col("ts").cast("timestamp"))
    parts = [events.where("ts < '2024-03-30'"), events.where("ts >= '2024-03-30'"), clock.where("ts < '2024-05-02'"), clock, events.where("source = 'a'")]
    for zone in ("Asia/Jerusalem", "America/New_York"):
        here = f"{tmp_path}/{zone[:3]}"
        for i, part in enumerate(parts):
            part.coalesce(1).write.parquet(f"{here}/in/part={i}")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{here}/in/part=*")
        counts = tick_state.count_stream(stream, "ts", "source", ["slow"], zone, shards=2)
        before = spark.conf.get(tick_state.PROVIDER)
        tick_state.write_counts(counts, "source", f"{here}/out", f"{here}/state").awaitTermination()
        assert spark.conf.get(tick_state.PROVIDER) == before
        got = tick_state.read_counts(spark.read.parquet(f"{here}/out"), "source").where("source is null or source <> 'clock'")
        for late, given in ((False, events), (True, events.where("source = 'a'"))):
            wanted = ticks.coverage(given, "ts", "source", ["slow"], zone).collect()
            found = got.where(F.col("late") == late).select("tick", "source", "hours", "n").collect()
            assert sorted(map(str, found)) == sorted(map(str, wanted)), (zone, late)


def test_redelivered_rows_are_dropped(spark, tmp_path):
    rows = spark.createDataFrame([("u1", "2024-01-01 10:00:00"), ("u1", "2024-01-01 10:30:00"), ("u2", "2024-01-01 11:00:00")], "job_url string, ts string")
    for i in range(2):
        rows.write.parquet(f"{tmp_path}/in/part={i}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/part=*")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    ingest.run_to_folder(ingest.dedupe_stream(stream, "ts", ["job_url"]), f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(r["job_url"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["u1", "u2"]


def test_rows_go_to_the_tick_that_collects_them(spark):
    """In local time: the next half hour, for slow sources the next third one, at night the first of the morning."""
    cases = [
        ("2026-01-05 05:30:00", False, "2026-01-05 07:30"), ("2026-01-05 05:30:01", False, "2026-01-05 08:30"),
        ("2026-01-05 05:45:00", True, "2026-01-05 10:30"), ("2026-01-05 07:45:00", True, "2026-01-05 10:30"),
        ("2026-01-05 20:30:00", False, "2026-01-05 22:30"), ("2026-01-05 20:31:00", False, "2026-01-06 07:30"),
        ("2026-01-05 20:30:01", True, "2026-01-06 07:30"), ("2026-01-05 01:00:00", True, "2026-01-05 07:30"),
        ("2026-07-05 04:31:00", False, "2026-07-05 08:30"), ("2026-01-05 05:30:00.000001", False, "2026-01-05 08:30"),
        ("2026-01-05 05:30:00.000001", True, "2026-01-05 10:30"), ("2026-01-05 20:30:00.000001", False, "2026-01-06 07:30"),
        ("2026-01-05 05:29:59.999999", False, "2026-01-05 07:30"),
    ]
    rows = spark.createDataFrame([(t, s) for t, s, _ in cases], "t string, slow boolean")
    tick = ticks.collecting_tick(F.col("t").cast("timestamp"), F.col("slow"))
    got = [r["v"] for r in rows.select(F.date_format(tick, "yyyy-MM-dd HH:mm").alias("v")).collect()]
    assert got == [want for _, _, want in cases]
    plain = rows.select(F.date_format(ticks.collecting_tick(F.col("t").cast("timestamp"), F.col("slow"), "UTC"), "HH:mm").alias("v"))
    assert plain.first()["v"] == "07:30"


def test_rows_without_a_source_are_counted(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", "a"), ("2024-01-01 10:00:00", None), ("2024-01-01 10:10:00", "b")], "ts string, source string")
    counted = ticks.coverage(df.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "source", ["a"])
    assert counted.agg(F.sum("n")).first()[0] == 3


def test_tick_rules(spark):
    times = ["2024-01-01 07:30:00", "2024-01-01 08:30:00", "2024-01-01 10:30:00", "2024-01-01 10:00:00", "2024-01-01 23:30:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").withColumn("t", F.col("t").cast("timestamp"))
    got = [tuple(r) for r in df.select(ticks.lookback_minutes(F.col("t")), ticks.is_slow_tick(F.col("t"))).collect()]
    assert got == [(1440, True), (60, False), (60, True), (60, False), (60, False)]
