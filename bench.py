"""Benchmark the headline queries.

Runs each query in ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``; every run executes the
whole plan through the ``noop`` sink (nothing is collected).  Reports the
median of ``$BENCH_RUNS`` warm runs per query, DuckDB's time on the oracle SQL
of the same query with the geometric mean of the ratios, and one full and one
incremental run of the stored tables.  Prints one JSON line.
"""

from __future__ import annotations

import json
import math
import os
import platform
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dedupe_events",
    "daily_events",
    "daily_events_sweep",
    "monthly_events",
    "sessions",
    "session_numbers",
    "funnel",
    "funnel_segmented",
    "unique_check",
    "lookback_incremental_events",
]


def pipeline_times(spark, sf_dir: str) -> dict[str, float]:
    """Seconds of a full build of the first load of raw files (98 % of the rows, by time), and of
    the run that takes in the second."""
    import tempfile

    from pyspark.sql import functions as F

    from eventlens.plans.catalog import EVENTS_CFG
    from eventlens.plans.pipeline import run_full, run_incremental
    from eventlens.sources.ledger import FileSource, RawFiles
    from eventlens.sources.testdata import raw_from_events

    raw = raw_from_events(spark, sf_dir)
    first, last = raw.agg(F.min("time"), F.max("time")).first()
    late = F.col("time") >= F.lit(first + (last - first) * 0.98)
    with tempfile.TemporaryDirectory(prefix="eventlens-bench-") as target:  # a local session's target
        files = RawFiles({"bench.events": FileSource(f"{target}/raw")})
        raw.where(~late).write.parquet(f"{target}/raw/first")
        t0 = time.perf_counter()
        run_full(spark, files, EVENTS_CFG, f"{target}/out")
        full = time.perf_counter() - t0
        raw.where(late).write.parquet(f"{target}/raw/second")
        t0 = time.perf_counter()
        run_incremental(spark, files, EVENTS_CFG, f"{target}/out")
        return {"run_full": full, "run_incremental": time.perf_counter() - t0}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    with_duck = os.environ.get("BENCH_DUCKDB", "1") == "1"

    from eventlens.plans.catalog import QUERIES
    from eventlens.plans.oracle import oracle_queries
    from eventlens.session import local_session

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus.isdigit() else "8"))
    spark = local_session(cpus, shuffle_partitions=shuffle, app_name="eventlens-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:  # warm-up: JIT, file listing cache, Python workers
        run(name)
    times = {name: statistics.median(run(name) for _ in range(runs)) for name in HEADLINE}

    duck = {}
    if with_duck:
        import duckdb

        con = duckdb.connect()
        for t in ("events", "orders"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        sqls = oracle_queries()
        for name in HEADLINE:
            con.sql(sqls[name]).fetchall()
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                con.sql(sqls[name]).fetchall()
                samples.append(time.perf_counter() - t0)
            duck[name] = round(statistics.median(samples), 4)

    times |= pipeline_times(spark, sf_dir)
    total = sum(times.values())
    ratios = [math.log(times[k] / duck[k]) for k in duck if duck[k] > 0]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in times.items()},
        "sf": sf,
        "runs": runs,
        "cpus": cpus,
        "spark": spark.version,
        "python": platform.python_version(),
        "duckdb_oracle_sec": duck,
        "geomean_ratio_to_duckdb": round(math.exp(sum(ratios) / len(ratios)), 2) if ratios else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
