"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

`queries` holds seconds per query after one warm-up run of the session. Most derive everything from
raw events; those named `stored_*` ask the same of history and sample tables written before the
timer starts, as a running service would (second of two runs). `readings_per_sec` is what
validation with detection (batch) and the live job (stream, with all its tables) process,
`lookup_rows_read` what a vehicle lookup reads of the history by equality and by a substring.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.operators import tables
from fleetspark.plans import reports, snapshot
from fleetspark.session import configure
from fleetspark.streaming.live import start_live
from fleetspark.streaming.sources import read_telemetry_stream
from fleetspark.workload import mapping, queries
from fleetspark.workload.queries import QUERIES, record_source, scratch

HEADLINE = [
    "idling_report",
    "enriched_history",
    "open_incidents",
    "active_episodes",
    "fault_counts",
    "latest_state",
    "fleet_summary",
    "active_alerts",
    "vehicle_page",
    "events_per_minute",
    "activity_top",
    "vehicle_history",
    "recent_sample",
    "parse_telemetry",
    "record_outcomes",
    "final_rows",
    "counter_rates",
    "archive_status",
    "live_history",
]


def build(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fleetspark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def live_seconds(spark: SparkSession, sf_dir: str) -> float:
    """The live job alone over ready record files: parse, dedup, detect, write all tables."""
    source, root = record_source(spark, sf_dir, 2), scratch(spark, "bench")
    start = time.perf_counter()
    start_live(
        read_telemetry_stream(spark, source), f"{root}/tables", f"{root}/checkpoint", drain=True
    ).awaitTermination()
    return round(time.perf_counter() - start, 3)


def stored_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    """History at compressed and at original times, clustered by vehicle, and a published sample."""
    root = scratch(spark, "bench-stored")
    detected = tables.cluster_by_vehicle(queries.history(spark, sf_dir), 4)
    tables.write_history(detected, f"{root}/detected", "telemetry", 0)
    at = queries.observed(spark, sf_dir).select("event_id", F.col("observed_at").alias("timestamp"))
    observed = queries.history(spark, sf_dir).drop("timestamp").join(at, "event_id")
    tables.write_history(tables.cluster_by_vehicle(observed, 4), f"{root}/observed", "telemetry", 0)
    stored = [tables.read_history(spark, f"{root}/{name}", "telemetry") for name in ("detected", "observed")]
    snapshot.refresh_snapshot(stored[0], f"{root}/sample", queries.AS_OF, queries.SCOPE)
    return *stored, f"{root}/sample"


def stored_seconds(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], dict[str, int]]:
    """Reports on stored tables, and the rows of a vehicle lookup's scan."""
    detected, observed, sample = stored_tables(spark, sf_dir)
    ids = [f"V{i:06d}" for i in range(1, 9)]
    asked = {
        "stored_idling_report": lambda: reports.idling_report(detected, queries.AS_OF, 7),
        "stored_vehicle_history": lambda: reports.vehicle_history(observed, "V000007", queries.MONTH_END, 30, 100),
        "stored_events_per_minute": lambda: reports.events_per_minute(observed, queries.MONTH_END, 30),
        "stored_recent_sample": lambda: snapshot.recent_sample(
            snapshot.read_snapshot(spark, sample), ids, 3, queries.AS_OF
        ),
    }
    took = {}
    for name, ask in asked.items():
        for _ in range(2):
            start = time.perf_counter()
            ask().collect()
            took[name] = round(time.perf_counter() - start, 3)
    lookups = {"equality": "vehicle_id = 'V000007'", "substring": "substring(vehicle_id, 2) = '000007'"}
    return took, {name: rows_read(observed.where(rule)) for name, rule in lookups.items()}


def rows_read(frame: DataFrame) -> int:
    """Rows that the scan under a frame passed on."""
    frame.collect()
    node = frame._jdf.queryExecution().executedPlan()
    while "AdaptiveSparkPlan" in node.nodeName() or node.children().size():
        node = node.executedPlan() if "AdaptiveSparkPlan" in node.nodeName() else node.children().head()
    return node.metrics().apply("numOutputRows").value()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build(cpus)
    seconds(spark, "enriched_history", sf_dir)
    seconds(spark, "parse_telemetry", sf_dir)
    took = {name: seconds(spark, name, sf_dir) for name in HEADLINE}
    took["live_job"] = live_seconds(spark, sf_dir)
    stored, lookups = stored_seconds(spark, sf_dir)
    took.update(stored)
    arrived = mapping.arrivals(spark, sf_dir).count()
    rates = {name: round(arrived / took[name]) for name in ("record_outcomes", "live_job")}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(took[name] for name in [*HEADLINE, "live_job"]), 3),
                "unit": "sec",
                "queries": took,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "records": arrived,
                "readings_per_sec": rates,
                "lookup_rows_read": lookups,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
