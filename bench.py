"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with a ``noop`` write (every row computed, none
collected to the driver), after a JIT warm-up on sf0.001; each query's time is
the best of $BENCH_REPEAT runs (default 2). Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "monthly_features_state",
    "monthly_features_county",
    "aqi_subindex",
    "aqi_dominant",
    "combine_forecasts",
    "aqi_global",
    "holdout_mse",
    "forecast_error",
    "end_to_end_linear",
    "union_years",
    "csv_roundtrip",
    "upsert_monthly",
    "monthly_pollutant_stream",
    "forecast_gbt_pooled",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from aerocast.plans.queries import REGISTRY
    from aerocast.session import build_session

    spark = build_session(f"local[{cpus}]", int(cpus))
    # JVM/JIT warm-up on the smallest scale when it sits next to the measured one
    # (same code paths, negligible data); the measured runs then reflect steady state.
    warm = Path(sf_dir).parent / "sf0.001"
    warm_dir = str(warm) if warm.is_dir() else sf_dir
    for name in ("monthly_features_state", "aqi_subindex"):
        REGISTRY[name].run(spark, warm_dir).write.format("noop").mode("overwrite").save()

    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times = {}
    for name in names:
        best = None
        for _ in range(repeat):  # best of N: this VM's timings vary by tens of percent
            t0 = time.perf_counter()
            df = REGISTRY[name].run(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "repeat": repeat,
    }))


if __name__ == "__main__":
    main()
