"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR  test tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
BENCH_RUNS    timed runs per query, the median counts (default 1)
BENCH_QUERIES comma-separated names instead of the headline list
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sightline.plans.catalogue import QUERIES  # noqa: E402
from sightline.session import build_session  # noqa: E402

HEADLINE = (
    "latest_vac_per_face", "ims_transport_pivot", "ims_va_ratios", "panel_list_full", "freq_band_join",
    "panel_trip_intersection", "nearest20", "evidence_full", "ccf_face_stats", "control_sum", "ccf_result_full",
    "complexity_index", "recalc_state_step", "unpublish_apply", "ccf_result_inc", "publish_replace",
)


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to build the query and compute all its rows."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session("sightline-bench", cpus)
    run(spark, "ccf_result_full", sf_dir)  # warm the JVM
    seconds = {name: round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3) for name in names}
    print(json.dumps({
        "metric": "panel_release_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(os.path.basename(sf_dir).removeprefix("sf")), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
