"""Benchmark the four reports (headline) and every registry query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

1. prepare: Spark derives the nine fleet source tables from the driver
   tables (the adapters) and writes them as parquet, as they exist in
   production (timed, reported as ``prepare_sources``);
2. one untimed warm-up pass of the four reports;
3. the four reports over the stored fleet tables, median of 3 runs each, every
   run from newly read sources (the host's timings are noisy) -> ``value`` is the sum of the medians;
4. every registry key over the stored tables, and the four reports run
   straight off the driver tables through the adapters (``via_adapters:*``).

Each query runs to completion into Spark's ``noop`` sink (the whole plan
executes, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fleetlens.plans.registry import queries, source_queries  # noqa: E402
from fleetlens.session import build_session, ensure_checkpoint_dir  # noqa: E402
from fleetlens.sources.catalog import derive_from_driver_tables, read_fleet_tables  # noqa: E402
from fleetlens.sources.schemas import SCHEMAS  # noqa: E402

REPORTS = ("fleet_list", "utilization", "hours", "fuel")
RUNS = 3


def timed(build) -> float:
    t = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-sources-{uuid.uuid4().hex}"

    t = time.perf_counter()
    derived = derive_from_driver_tables(spark, sf_dir)
    for name in SCHEMAS:
        getattr(derived, name).repartition(max(cpus, 2)).write.mode("overwrite").parquet(f"{root}/{name}")
    prepare = round(time.perf_counter() - t, 3)

    def fresh():                                        # nothing kept for a source is used by another run
        return read_fleet_tables(spark, root)

    sq, dq = source_queries(), queries()
    for k in REPORTS:                                   # warm-up: JIT, file cache
        timed(lambda: sq[k](fresh()))
    times = {k: statistics.median(timed(lambda: sq[k](fresh())) for _ in range(RUNS)) for k in REPORTS}
    total = round(sum(times.values()), 3)
    for k, fn in sq.items():
        if k not in REPORTS:
            times[k] = timed(lambda: fn(fresh()))
    for k in REPORTS:
        times[f"via_adapters:{k}"] = timed(lambda: dq[k](spark, sf_dir))
    times["prepare_sources"] = prepare

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "four_reports_total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
