"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query seconds.

Each query is forced to completion with the ``noop`` sink (full execution,
no driver collect). One warm-up run of a small query primes the JVM first.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterflow.queries import REGISTRY  # noqa: E402
from meterflow.session import build_session  # noqa: E402

HEADLINE = [
    "published_readings",
    "substation_consumption",
    "partition_stats",
    "dedupe_readings",
    "daily_consumption",
    "pivot_feeders",
    "feeder_summary",
    "gaps",
    "attach_locations",
    "backfill_candidates",
]
OPTIONAL = [
    "locate_postcodes",
    "hull_stats",
    "postcode_locations",
    "project_bng",
    "grid_shift",
    "within_distance",
    "model_locations",
    "affected_months",
    "stale_partitions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app_name="meterflow-bench", shuffle_partitions=int(cpus),
                          conf={"spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="meterflow-bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in HEADLINE + OPTIONAL if n in REGISTRY]
    REGISTRY["null_rows"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as exc:  # keep timing the others; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            continue
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
