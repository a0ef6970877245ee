"""Bench: run every registered query on one scale and print one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default all).
Each query is executed in full through Spark's no-op sink (nothing is
collected).  Before timing, every query runs once on a small warm-up scale
(env BENCH_WARMUP_DIR, default the sibling ``sf0.001`` folder; ``none`` to
skip) so JIT compilation and Python worker start-up are not charged to
whichever query first touches a code path.  Nothing computed in the warm-up
is reused: the measured scale has its own ingest, its own ALS fit.
What several queries share is timed once and counted like a query: ``ingest`` (the
cleaned tables as Parquet), ``csv_tables`` (the same as CSV behind external tables, and
the materialised aggregate) and ``als_fit``.  A query's time is the median of up to
BENCH_RUNS runs (default 3), fewer once they took 5 seconds together.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelstat.plans.registry import QUERIES, _csv_tables, _fitted, ingest  # noqa: E402
from reelstat.session import build_session  # noqa: E402


SHARED = {"csv_tables": (_csv_tables, ("sql_",)),
          "als_fit": (_fitted, ("als_", "predictions", "scored_rows", "user_recs", "item_users", "similar_items"))}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(f"local[{cpus}]", app="reelstat-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    warm = os.environ.get("BENCH_WARMUP_DIR",
                          os.path.join(os.path.dirname(sf_dir), "sf0.001")).rstrip("/")
    if warm != "none" and os.path.isdir(warm) and warm != sf_dir:
        for name in names:                                      # warm-up, not counted
            try:
                run(QUERIES[name](spark, warm))
            except Exception:        # a failure shows up in the measured run
                pass
    times, errors = {}, {}
    t0 = time.perf_counter()
    ingest(spark, sf_dir)            # clean + write ratings and movies once (counted)
    times["ingest"] = round(time.perf_counter() - t0, 3)
    for step, (make, used_by) in SHARED.items():
        if any(n.startswith(used_by) for n in names):
            t0 = time.perf_counter()
            make(spark, sf_dir)
            times[step] = round(time.perf_counter() - t0, 3)
    for name in names:
        took = []
        try:
            while len(took) < int(os.environ.get("BENCH_RUNS", "3")) and sum(took) < 5:
                t0 = time.perf_counter()
                run(QUERIES[name](spark, sf_dir))
                took.append(time.perf_counter() - t0)
            times[name] = round(median(took), 3)
        except Exception as e:       # reported, never silently dropped
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
    spark.stop()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {"metric": "total_query_time",
           "value": round(sum(t for t in times.values() if t is not None), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
           "cpus": cpus, "warmup": warm if warm != sf_dir and os.path.isdir(warm) else None}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
