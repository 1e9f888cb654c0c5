"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default HEADLINE), BENCH_REPEAT (default 3).

Spark's event log is written to the bench's scratch folder; ``shuffle_mb``
reports, per query, the shuffle bytes written by its last run (all of its
jobs, tagged with a job group), read back from that log.

Each query's plan runs to completion through the ``noop`` sink (every row is
produced, nothing is shipped to the driver).  ``queries`` holds the best of
BENCH_REPEAT runs (warm: JIT and codegen caches filled), ``cold`` the first
run of each query after one untimed warm-up of the flagship; ``value`` sums
the warm times.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time
from collections import defaultdict

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "monthly_borough_agg",
    "dq_reject_reasons",
    "gold_obt_projection",
    "zone_enrich_left_join",
    "bronze_incremental",
    "top_borough_pairs",
    "snapshot_as_of",
    "read_plan_decision",
    "merge_upsert_trips",
    "merge_partial_aggs",
    "merge_monthly_agg",
    "incremental_load_effect",
    "pipeline_end_to_end",
    "landing_report",
]


def main() -> None:
    import tempfile

    from tripmart import catalog
    from tripmart.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    scratch = tempfile.mkdtemp(prefix="tripmart-bench-")
    spark = build_session(
        app_name="tripmart-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
            "spark.checkpoint.dir": scratch,
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{scratch}",
            "spark.eventLog.compress": "false",
            "spark.local.dir": scratch,
        },
    )
    queries = catalog.queries()

    def run(name: str, group: str) -> float:
        spark.sparkContext.setJobGroup(group, name)
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("monthly_borough_agg", "warmup")  # warm-up: JVM, codegen, file listing caches
    timings, cold, errors = {}, {}, {}
    for name in names:
        try:
            runs = [run(name, f"{name}#{i}") for i in range(repeat)]
        except Exception as exc:  # noqa: BLE001 - one failing query must not lose the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
            continue
        cold[name] = round(runs[0], 3)
        timings[name] = round(min(runs), 3)
    spark.sparkContext.setJobGroup("done", "done")
    app_id = spark.sparkContext.applicationId
    spark.stop()  # flushes the event log
    shuffle = shuffle_by_group(scratch, app_id)
    shuffle_mb = {n: round(shuffle.get(f"{n}#{repeat - 1}", 0) / 2**20, 3) for n in timings}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "cold": cold,
                "cold_total": round(sum(cold.values()), 3),
                "shuffle_mb": shuffle_mb,
                **({"errors": errors} if errors else {}),
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )


def shuffle_by_group(folder: str, app_id: str) -> dict[str, int]:
    """Shuffle bytes written per job group, from the event log."""
    # Spark 4 writes a folder of rolling event files per application.
    paths = sorted(
        p
        for p in glob.glob(f"{folder}/**/*", recursive=True)
        if os.path.isfile(p) and app_id in p and "events" in os.path.basename(p)
    )
    stage_group: dict[int, str] = {}
    written: dict[str, int] = defaultdict(int)
    for path in paths:
        with open(path) as log:
            for line in log:
                event = json.loads(line)
                kind = event.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                    for stage in event.get("Stage IDs", []):
                        stage_group[stage] = group
                elif kind == "SparkListenerTaskEnd":
                    metrics = event.get("Task Metrics") or {}
                    nbytes = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    group = stage_group.get(event.get("Stage ID"))
                    if group:
                        written[group] += nbytes
    return dict(written)


if __name__ == "__main__":
    main()
