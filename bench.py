"""Headline benchmark, measured the way the reference measures its queries.

* ``etl_load``: the whole warehouse load: derive the sources from the test
  tables, clean them, build the keyed dimensions and the three facts, check
  the constraints, and store the six tables, the violations and the rejects;
* ``utilization``, ``reporting``, ``reporting_per_role``: the warehouse KPI
  reports over the stored warehouse;
* ``*_baseline``: the same reports computed straight from the sources.

Prints one JSON line:
{"metric": "kpi_suite_sec", "value": <sum of per-query medians>, "unit": "sec",
 "queries": {...}, "sf": ...}

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

WAREHOUSE_REPORTS = ["utilization", "reporting", "reporting_per_role"]
SOURCE_REPORTS = ["utilization_baseline", "reporting_baseline", "reporting_per_role_baseline"]


def _median_time(fn, repeats: int) -> tuple[float, object]:
    runs, out = [], None
    for _ in range(repeats):
        t0 = time.perf_counter()
        out = fn()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3), out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    from avionyx.plans import baseline, catalog, etl, kpis
    from avionyx.plans.warehouse import read_warehouse
    from avionyx.session import clear_scratch, local_session, scratch_path
    from avionyx.sources import load_test_sources

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="avionyx-bench")

    # Warm-up (JIT, codegen caches), not timed.
    catalog.QUERIES["utilization"](spark, sf_dir).collect()
    catalog.QUERIES["utilization_baseline"](spark, sf_dir).collect()

    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    paths: list[str] = []

    def load():
        path = scratch_path(spark, "warehouse")
        etl.load_warehouse(load_test_sources(spark, sf_dir), path)
        paths.append(path)

    timings["etl_load"], _ = _median_time(load, repeats)
    wh = read_warehouse(spark, paths[-1])
    for name in WAREHOUSE_REPORTS:
        fn = getattr(kpis, name)
        timings[name], out = _median_time(lambda: fn(wh).collect(), repeats)
        rows[name] = len(out)
    src = load_test_sources(spark, sf_dir)
    for name in SOURCE_REPORTS:
        fn = getattr(baseline, name)
        timings[name], out = _median_time(lambda: fn(src).collect(), repeats)
        rows[name] = len(out)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "kpi_suite_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "rows": rows,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
