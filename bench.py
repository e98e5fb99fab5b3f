"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is executed in
full through the ``noop`` sink (no collect to the driver); the time reported
per query is the best of ``$BENCH_REPEAT`` runs (default 3), after one untimed
warm-up run of every query on ``$BENCH_WARM_DIR`` (default sf0.001).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tickweave.plans import catalog  # noqa: E402
from tickweave.session import build_session  # noqa: E402

HEADLINE = [
    "q_window_metrics", "q_window_report", "q_sma_hourly", "q_sma_close_users", "q_top_gainer", "q_top10_gain", "q_quote_count",
    "q_rsi_window", "q_rsi_feed_window", "q_rsi_hourly", "q_rsi_users", "q_rsi_wilder", "q_rsi_carry_forward",
    "q_profit", "q_profit_running", "q_profit_parity", "q_top_profit",
    "q_json_roundtrip", "q_json_quarantine", "q_render",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus) * 2, app_name="tickweave-bench",
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        # JIT and code generation warm-up on the smallest data, not timed.
        for name in names:
            catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        fn = catalog.QUERIES[name]
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    result = {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
              "queries": times, "sf": sf, "cpus": int(cpus), "repeat": repeat}
    if os.environ.get("BENCH_STREAM", "1") != "0" and not sys.argv[1:]:
        result["streams"] = stream_bench(spark, sf_dir)
    print(json.dumps(result))


def stream_bench(spark, sf_dir: str) -> dict:
    """The feed application (one decode per micro-batch, all window outputs)
    over the feed rendered from ``events`` as one text file per day, replayed
    in time order, eight files (days) per micro-batch.  Preparing the files is not
    timed."""
    import uuid

    from tests.feed_files import write_day_files
    from tickweave.app import run_feed
    from tickweave.session import checkpoint_root

    # The files are arranged with local file operations (bench runs locally).
    work = f"{checkpoint_root(spark).rstrip('/').removeprefix('file:')}/tickweave-bench/{uuid.uuid4().hex}"
    write_day_files(spark, sf_dir, f"{work}/feed", base_mtime=1_710_000_000)
    n_quotes = catalog.load_quotes(spark, sf_dir).count()
    t0 = time.perf_counter()
    run_feed(spark, f"{work}/feed", f"{work}/out", catalog.FEED_WINDOW, catalog.FEED_SLIDE, "10 minutes",
             trigger={"availableNow": True}, max_files_per_trigger=8).awaitTermination()
    dt = time.perf_counter() - t0
    n_windows = spark.read.parquet(f"{work}/out/windows").select("window_start").distinct().count()
    return {"feed_app_sec": round(dt, 3), "quotes_per_sec": round(n_quotes / dt, 1), "windows": n_windows,
            "files": len(os.listdir(f"{work}/feed"))}


if __name__ == "__main__":
    main()
