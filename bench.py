"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is run to completion with the ``noop`` sink (all rows computed, nothing
collected to the driver), best of three. ``harmonize`` is ``harmonize_data`` end to end (both
data sets written once and their keys checked on the written files), also best of three; it
runs in report mode because order keys repeat in the fixture. ``publish_material`` is the
default raise mode (write beside the target, check, move) for the data set whose keys are
unique. Besides seconds, the line reports what the baseline asks for, per data set: SQL
actions, shuffle bytes and records read, from the Spark event log of one more run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from erpweave.plans.catalog import AS_OF, QUERIES  # noqa: E402
from erpweave.plans.harmonize import harmonize_data, publish  # noqa: E402
from erpweave.plans.pipelines import (  # noqa: E402
    process_local_material,
    process_process_order,
    rename_local_material,
    rename_process_order,
)
from erpweave.session import local_session  # noqa: E402
from erpweave.sources.fixtures import TpchErpSources  # noqa: E402

HEADLINE = [
    "local_material_final",
    "process_order_final",
    "prep_valuation_latest",
    "integrate_material",
    "integrate_order",
    "key_violations",
    "dedup_material",
    "profile_columns",
]
RUNS = 3


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def _event_log_stats(log_dir: str) -> dict[str, dict[str, int]]:
    """SQL actions and shuffle bytes per job group (= data set) from the event log."""
    group_of_stage: dict[int, str] = {}
    actions: dict[str, set] = defaultdict(set)
    shuffle: dict[str, int] = defaultdict(int)
    records: dict[str, int] = defaultdict(int)
    for path in Path(log_dir).rglob("*"):
        if not path.is_file() or path.name.startswith("appstatus"):
            continue
        for line in path.read_text(errors="replace").splitlines():
            try:
                event = json.loads(line)
            except ValueError:
                continue
            kind = event.get("Event")
            if kind == "SparkListenerJobStart":
                props = event.get("Properties") or {}
                group = props.get("spark.jobGroup.id")
                execution = props.get("spark.sql.execution.root.id") or props.get("spark.sql.execution.id")
                if group and execution is not None:
                    actions[group].add(int(execution))
                for stage in event.get("Stage IDs", []):
                    if group:
                        group_of_stage[stage] = group
            elif kind == "SparkListenerTaskEnd":
                group = group_of_stage.get(event.get("Stage ID"))
                metrics = event.get("Task Metrics") or {}
                if group:
                    shuffle[group] += int((metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0))
                    records[group] += int((metrics.get("Input Metrics") or {}).get("Records Read", 0))
    return {g: {"sql_actions": len(actions[g]), "shuffle_bytes": shuffle[g], "records_read": records[g]} for g in actions}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="erpweave-bench-")
    log_dir = f"{scratch}/events"
    os.makedirs(log_dir)
    spark = local_session(
        cores=cpus,
        shuffle_partitions=cpus,
        app_name="erpweave-bench",
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")

    _run(spark, "prep_material", sf_dir)  # warm-up: JVM classes, codegen caches
    times: dict[str, float] = {}
    for name in HEADLINE:
        times[name] = round(min(_run(spark, name, sf_dir) for _ in range(RUNS)), 3)

    sources = TpchErpSources(sf_dir)
    out = f"{scratch}/out"

    def timed(run) -> float:
        t0 = time.perf_counter()
        run()
        return time.perf_counter() - t0

    both = lambda: harmonize_data(spark, sources, f"{out}/both", "report", order_options={"as_of": AS_OF})
    times["harmonize"] = round(min(timed(both) for _ in range(RUNS)), 3)
    one = lambda: publish(
        process_local_material(spark, sources), "local_material", f"{out}/one/local_material", rename_local_material
    )
    times["publish_material"] = round(min(timed(one) for _ in range(RUNS)), 3)
    # One job group per data set so the event log attributes actions, shuffles and reads.
    spark.sparkContext.setJobGroup("local_material", "harmonize local_material")
    material = process_local_material(spark, sources)
    publish(material, "local_material", f"{out}/local_material", rename_local_material, on_key_violation="report")
    spark.sparkContext.setJobGroup("process_order", "harmonize process_order")
    order = process_process_order(spark, sources, as_of=AS_OF)
    publish(order, "process_order", f"{out}/process_order", rename_process_order, on_key_violation="report")
    spark.stop()

    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "harmonize_per_dataset": _event_log_stats(log_dir),
            }
        )
    )


if __name__ == "__main__":
    main()
