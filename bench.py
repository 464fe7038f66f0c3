"""Benchmark: run headline queries end to end and print one JSON line.

Each query is materialized through the ``noop`` sink, which executes the full
plan (scan, shuffles, aggregation, windows) without moving rows to the driver.
Every query runs ``BENCH_REPEAT`` times (default 3) and the best (warm) time
is reported: the first run of a plan shape also pays for code generation.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default: the headline set below).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quantsilo.plans import catalog  # noqa: E402
from quantsilo.session import get_spark  # noqa: E402

HEADLINE = [
    "minute_summary", "hourly_model_performance", "silver_windows", "silver_enriched",
    "history_indicators", "live_candles_1m", "training_features", "backtest_vpin_toxic",
    "enriched_trades", "order_book_walls", "max_pain", "arbitrage", "alarm_triggers",
    "model_leaderboard", "daily_digest", "login_locks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=parts, app_name="quantsilo-bench",
                      extra={"spark.driver.memory": "16g"})
    qs = catalog.queries()
    # warm-up: JVM, parquet footers, Python workers
    qs["minute_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    times = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
