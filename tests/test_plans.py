"""What the plans look like: the properties that decide how the work scales."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import fleetspark.plans.ordered as ordered
from fleetspark.operators import detect as d
from fleetspark.operators import tables
from fleetspark.operators.dedup import dedup_first
from fleetspark.operators.state import latest_state
from fleetspark.plans import reports
from fleetspark.plans.even import in_even_tasks
from fleetspark.plans.paging import page_after
from fleetspark.sources import archive
from fleetspark.streaming import live
from fleetspark.workload import mapping as m
from fleetspark.workload.queries import AS_OF, MONTH_END
from tests.build import START, TOPIC, at, payload, records

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_detection_uses_one_exchange_and_one_sort(spark):
    text = plan(d.detect(m.readings(spark, SF)))
    assert len(re.findall(r"Exchange hashpartitioning\(vehicle_id", text)) == 1
    assert text.count("Exchange") == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_state_and_report_add_no_exchange_by_vehicle(spark):
    detected = d.detect(m.readings(spark, SF))
    assert plan(latest_state(detected, AS_OF)).count("Exchange") == 1
    assert plan(reports.idling_report(d.enrich(detected), AS_OF)).count("Exchange") == 1


def test_cutting_evaluates_its_input_once(spark, monkeypatch):
    """Busy vehicles: rows are read and deduplicated once (and counted once) in all."""
    stored, landed = [], ordered.landed

    def watched(df, name):
        stored.append(plan(df))
        return landed(df, name)

    monkeypatch.setattr(ordered, "landed", watched)
    rows = d.detect(dedup_first(m.arrivals(spark, SF)), block_rows=30, counted=m.arrivals(spark, SF))
    stored.append(plan(d.active_episodes(rows)))
    for name, times in (("events.parquet", 2), (r"WindowGroupLimit \[event_id\S* \S* \S*, row_number\S*, 1, Final", 1)):
        assert sum(len(re.findall(name, text)) for text in stored) <= times, name
    assert "events.parquet" in stored[0] and len(stored) == 4
    # Whole rows move by vehicle and block, carries by vehicle.
    moves = [len(re.findall(r"Exchange hashpartitioning\(vehicle_id#\d+, block", text)) for text in stored]
    assert moves[0] == 0 and all(1 <= n <= 3 for n in moves[1:])


def test_page_by_key_skips_row_groups(spark, tmp_path):
    """A deep page reads no more of the table than the first one."""
    path = str(tmp_path / "registry")
    rows = spark.range(200_000).selectExpr("format_string('V%06d', id) AS vehicle_id", "id % 7 AS n")
    rows.repartitionByRange(1, "vehicle_id").sortWithinPartitions("vehicle_id").write.option(
        "parquet.block.size", 1 << 16
    ).option("parquet.page.size", 1 << 12).parquet(path)
    table = spark.read.parquet(path)

    def scanned(frame):
        frame.collect()
        node = frame._jdf.queryExecution().executedPlan()
        while node.children().size() or "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan() if "AdaptiveSparkPlan" in node.nodeName() else node.children().head()
        return node.metrics().apply("numOutputRows").value()

    late = page_after(table, ["vehicle_id"], 10, ("V199000",))
    assert [r["vehicle_id"] for r in late.collect()] == [f"V{i:06d}" for i in range(199_001, 199_011)]
    assert "GreaterThanOrEqual(vehicle_id,V199000)" in plan(late)
    assert scanned(late) < scanned(page_after(table, ["vehicle_id"], 10)) / 2
    with pytest.raises(ValueError, match="each column"):
        page_after(table, ["vehicle_id", "n"], 10, ("V1",))
    pairs = page_after(table, ["n", "vehicle_id"], 3, (5, "V199990"))
    assert [tuple(r) for r in pairs.select("n", "vehicle_id").collect()] == [(5, "V199995"), (6, "V000006"), (6, "V000013")]


def test_copies_are_pruned_before_the_shuffle(spark):
    text = plan(dedup_first(m.arrivals(spark, SF)))
    assert re.search(r"WindowGroupLimit \[event_id.*Partial", text)


def test_top_k_and_pushdown(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "concat('V', event_id) AS event_id", "props AS vehicle_id", "ts AS timestamp",
        "value AS speed_kmh", "value AS lat", "value AS lon", "value AS fuel_pct",
        "value AS soc_pct", "event_type",
    )
    text = plan(reports.vehicle_history(rows, "V000007", MONTH_END, 30, 100))
    assert "TakeOrderedAndProject" in text
    assert "EqualTo(props,V000007)" in text
    assert "user_id" not in text.split("ReadSchema")[1]


def test_bucketed_history_needs_no_exchange_by_vehicle(spark, tmp_path):
    """Reports, the replacing read and joins by vehicle read buckets as they lie."""
    rows, path, name = d.enrich(d.detect(m.readings(spark, SF))), str(tmp_path / "t"), "bucketed_for_plans"
    stored = tables.write_bucketed(rows, path, name, buckets=4)
    try:
        report = reports.idling_report(stored, AS_OF)
        assert "Exchange hashpartitioning" not in plan(report)
        assert sorted(map(tuple, report.collect())) == sorted(map(tuple, reports.idling_report(rows, AS_OF).collect()))
        final = tables.read_final(stored, tables.TELEMETRY_KEYS, "month")
        assert "Exchange hashpartitioning" not in plan(final) and final.count() == rows.count()
        spark.sql(f"DROP TABLE {name}")
        again = tables.read_bucketed(spark, path, name, buckets=4)
        assert "Exchange hashpartitioning" not in plan(again.groupBy("vehicle_id").count())
        assert again.count() == rows.count()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_one_row_group_is_parsed_by_all_cores(spark, tmp_path):
    """A file of one row group, cut into many splits by its bytes, still gives even tasks."""
    path = str(tmp_path / "events.parquet")
    cores = spark.sparkContext.defaultParallelism
    spark.range(20 * cores).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' AS ts", "id AS user_id", "'view' AS event_type",
        "1.0D AS value", "'{\"k\": 1}' AS props",
    ).coalesce(1).write.parquet(path)
    name, setting = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(name, "100")
    try:
        held = m.arrivals(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(name, setting)
    assert len(held) == cores and max(row["count"] for row in held) <= 25


def test_long_tables_get_whole_rounds_of_bounded_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(21 * cores)
    assert in_even_tasks(rows, 21 * cores, task_rows=10).rdd.getNumPartitions() == 3 * cores


def test_appends_and_live_batches_are_parsed_by_all_cores(spark, tmp_path, monkeypatch):
    """A batch that came in one task, as of a topic of one partition."""
    held = []

    def spied(parse):
        def spy(df, as_of):
            held.append(df.groupBy(F.spark_partition_id()).count().count())
            return parse(df, as_of)

        return spy

    monkeypatch.setattr(archive, "to_archive_rows", spied(archive.to_archive_rows))
    monkeypatch.setattr(live, "parse_telemetry", spied(live.parse_telemetry))
    cores = spark.sparkContext.defaultParallelism
    batch = records(spark, [payload(at(i)) for i in range(10 * cores)]).coalesce(1)
    archive.append_archive(batch, str(tmp_path / "archive"), TOPIC, START)
    live.commit_batch(batch, 0, str(tmp_path / "live"), as_of=START)
    assert held == [cores, cores]
    assert archive.read_archive(spark, str(tmp_path / "archive")).count() == 10 * cores
    assert live.read_outcomes(spark, str(tmp_path / "live")).first()["consumed"] == 10 * cores
