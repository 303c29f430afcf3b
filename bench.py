"""Seconds of the headline queries, as one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2; the better run counts), BENCH_SQL=1 adds the seconds
the check SQL of the same queries takes in DuckDB.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from postline.plans import load  # noqa: E402
from postline.session import build_session  # noqa: E402

HEADLINE = (
    "flagship_postings_by_source",
    "flt_01_valid_record_counts",
    "prj_03_linkedin_record",
    "sal_01_extract_salary",
    "loc_02_parse_location",
    "url_01_canonical_link_and_id",
    "agg_06_fold_duplicate_inputs",
    "agg_06_fold_uniform_rows",
    "set_03_coalesced_key_dedup",
    "win_01_winner_mapping",
    "win_03_description_budget",
    "mrg_08_merge_losers",
    "jn_07_repoint_matches",
    "mrg_01_upsert_snapshot",
    "mrg_01_full_batch",
    "mrg_06_change_log",
    "jn_06_flag_counts",
    "jn_11_hydrate_details",
    "prj_17_config_field_mapping",
    "prj_21_greenhouse_landing",
    "str_06_html_to_plain",
    "stm_03_tick_coverage",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("postline-bench", cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    queries = load()
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            queries[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    out = {
        "metric": "headline_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus,
    }
    if os.environ.get("BENCH_SQL") == "1":
        out["duckdb"] = duckdb_seconds(sf_dir, list(seconds), cpus)
    print(json.dumps(out))


def duckdb_seconds(sf_dir: str, names: list[str], cpus: str) -> dict[str, float]:
    import duckdb

    con = duckdb.connect()
    if cpus.isdigit():
        con.execute(f"SET threads = {cpus}")
    for t in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}'")
    out = {}
    for name in names:
        sql = load()[name].oracle
        if sql:
            start = time.perf_counter()
            con.execute(sql).fetchall()
            out[name] = round(time.perf_counter() - start, 3)
    return out


if __name__ == "__main__":
    main()
