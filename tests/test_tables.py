"""History tables, registry, reports, sample and counters."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import detect as d
from fleetspark.operators import metrics, registry, state, tables
from fleetspark.plans import ordered, paging, reports, snapshot
from fleetspark.schema import FLEET, METRIC_SAMPLE, VEHICLE
from fleetspark.settings import SampleScope
from fleetspark.workload import mapping
from tests.build import START, at, frame


def enriched(spark, rows):
    return d.enrich(d.detect(frame(spark, rows)))


def test_row_written_twice_reads_once(spark, tmp_path):
    root = str(tmp_path)
    rows = enriched(spark, [at(0), at(1)])
    tables.write_history(rows, root, "telemetry", 0)
    tables.write_history(rows, root, "telemetry", 0)
    tables.write_history(rows.withColumn("late", F.lit(True)), root, "telemetry", 1)
    stored = tables.read_history(spark, root, "telemetry")
    assert stored.count() == 4
    final = tables.read_final(stored, tables.TELEMETRY_KEYS)
    assert [r["late"] for r in final.collect()] == [True, True]
    with pytest.raises(ValueError, match="unsupported"):
        tables.write_history(rows, root, "other", 0)


def test_retention_and_compaction(spark, tmp_path):
    root = str(tmp_path)
    old = enriched(spark, [at(-60 * 86400.0, seq=0)])
    new = enriched(spark, [at(0), at(1)])
    for batch, rows in enumerate([old, new, new]):
        tables.write_history(rows, root, "telemetry", batch)
    stored = tables.read_history(spark, root, "telemetry")
    assert tables.apply_retention(stored, START).count() == 4
    assert tables.drop_expired_months(spark, root, "telemetry", START) == ["batch_id=0/month=202607"]
    tables.compact_month(spark, root, "telemetry", 202609, 2)
    stored = tables.read_history(spark, root, "telemetry")
    assert stored.where("batch_id < 2").count() == 0
    assert tables.read_final(stored, tables.TELEMETRY_KEYS).count() == 2


def test_batch_repeated_after_folding(spark, tmp_path):
    root = str(tmp_path)
    first, second = enriched(spark, [at(0), at(1)]), enriched(spark, [at(2), at(3), at(4)])
    tables.write_history(first, root, "telemetry", 0)
    tables.write_history(second, root, "telemetry", 1)
    tables.compact_month(spark, root, "telemetry", 202609, 1)
    assert tables.read_history(spark, root, "telemetry").count() == 5
    tables.write_history(second, root, "telemetry", 1)
    for _ in range(2):
        stored = tables.read_history(spark, root, "telemetry")
        assert tables.read_final(stored, tables.TELEMETRY_KEYS).count() == 5
        tables.compact_month(spark, root, "telemetry", 202609, 1)
    assert tables.read_history(spark, root, "telemetry").count() == 5
    assert tables.drop_expired_months(spark, root, "telemetry", START + timedelta(days=90)) == [
        "telemetry_folded/batch_id=1/fold=3/month=202609"
    ]


def test_ids_of_seven_digits(spark):
    numbers = spark.createDataFrame([(1234567,), (1234568,), (42,), (None,)], "n long")
    ids = numbers.select(mapping.numbered("V", F.col("n"), 6).alias("vehicle_id"))
    assert [r[0] for r in ids.collect()] == ["V1234567", "V1234568", "V000042", None]
    known = spark.createDataFrame([("V1234567", *VEHICLES[0][1:])], VEHICLE)
    readings = frame(spark, [at(0, vehicle_id="V1234567"), at(1, vehicle_id="V1234568")])
    assert [r[0] for r in registry.unknown_vehicles(readings, known).select("vehicle_id").collect()] == ["V1234568"]
    assert d.detect(readings).select("vehicle_id").distinct().count() == 2
    assert snapshot.recent_snapshot(readings, START + timedelta(seconds=2), SampleScope()).count() == 0


def test_window_prunes_months(spark, tmp_path):
    tables.write_history(enriched(spark, [at(0)]), str(tmp_path), "telemetry", 0)
    rows = tables.in_window(tables.read_history(spark, str(tmp_path), "telemetry"), START, 1, "F001")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(fleet_id,F001)" in plan
    for days in (0, 31, True):
        with pytest.raises(ValueError):
            tables.in_window(rows, START, days)
    with pytest.raises(ValueError):
        tables.in_window(rows, START, 1, "F1' OR '1'='1")


VEHICLES = [
    ("V000001", "SYN00000000000001", "F001", "Tata", "Nexon", "EV", 2020, "Delhi", 10.0),
    ("V000002", "SYN00000000000002", "F002", "Kia", "EV6", "EV", 2021, "Delhi", 20.0),
    ("V000003", "SYN00000000000003", "F009", "Kia", "EV6", "EV", 2021, "Delhi", 20.0),
]


def test_registry(spark, tmp_path):
    rows = spark.createDataFrame(VEHICLES, VEHICLE)
    rows.write.csv(str(tmp_path / "v"), header=True)
    assert registry.load_registry(spark, str(tmp_path / "v"), 3).count() == 3
    with pytest.raises(ValueError, match="exactly 4"):
        registry.load_registry(spark, str(tmp_path / "v"), 4)
    rows.union(rows.limit(1)).write.csv(str(tmp_path / "w"), header=True)
    with pytest.raises(ValueError, match="exactly 4"):
        registry.load_registry(spark, str(tmp_path / "w"), 4)
    fleets = spark.createDataFrame([("F001", "a"), ("F002", "b")], FLEET)
    assert [r["vehicle_id"] for r in registry.fleet_orphans(rows, fleets).collect()] == ["V000003"]
    with pytest.raises(ValueError, match="unknown fleets"):
        registry.check_fleets(rows, fleets)
    changed = rows.withColumn("oem", F.lit("New"))
    merged = registry.upsert_absent(rows.limit(2), changed, ["vehicle_id"])
    assert sorted(r["oem"] for r in merged.collect()) == ["Kia", "New", "Tata"]
    assert registry.known_vehicles(frame(spark, [at(0)]), rows).count() == 1
    assert registry.unknown_vehicles(frame(spark, [at(0, vehicle_id="V000077")]), rows).count() == 1
    assert [r["vehicle_id"] for r in registry.registry_page(rows, 1, 1).collect()] == ["V000002"]
    for limit, offset in ((0, 0), (101, 0), (1, -1)):
        with pytest.raises(ValueError):
            registry.registry_page(rows, limit, offset)


def latest(spark):
    rows = [
        at(0, vehicle_id="V000001", speed_kmh=130.0, dtc=["P0301"]),
        at(1, vehicle_id="V000002", speed_kmh=0.0),
        at(-61, vehicle_id="V000003", seq=0, speed_kmh=130.0),
    ]
    return state.latest_state(d.detect(frame(spark, rows)), START).persist()


def test_live_views(spark):
    now, states = START + timedelta(seconds=0), latest(spark)
    shown = {r["vehicle_id"]: r["status"] for r in state.vehicle_status(states, now).collect()}
    assert shown == {"V000001": "MOVING", "V000002": "IDLING", "V000003": "OFFLINE"}
    assert [r["type"] for r in state.active_alerts(states, now).collect()] == ["SPEEDING", "ENGINE_FAULT"]
    assert state.active_alerts(states, now, limit=1, offset=1).first()["type"] == "ENGINE_FAULT"
    vehicles = spark.createDataFrame(VEHICLES, VEHICLE)
    page = state.vehicle_page(vehicles, states.where("vehicle_id != 'V000002'"), 2, 0)
    live = {r["vehicle_id"]: r["live"] for r in page.collect()}
    assert live["V000001"]["status"] == "MOVING" and live["V000002"] is None
    rates = [(START - timedelta(seconds=4), 12.34)]
    fresh = spark.createDataFrame(rates, "ts timestamp, consumed_per_sec double")
    row = reports.fleet_summary(vehicles, states, now, fresh).first().asDict()
    assert row == {
        "registered_vehicles": 3,
        "online_vehicles": 2,
        "currently_idling": 1,
        "active_alerts": 2,
        "events_per_sec": 12.3,
        "processor_reporting": True,
    }
    stale = reports.fleet_summary(vehicles, states, now + timedelta(seconds=1), fresh).first()
    assert stale["events_per_sec"] == 0 and not stale["processor_reporting"]
    nothing = reports.fleet_summary(vehicles, states, now, fresh.limit(0)).first()
    assert nothing["events_per_sec"] == 0 and not nothing["processor_reporting"]


def test_bounded_results(spark):
    assert paging.bounded(spark.range(5), 5).count() == 5
    with pytest.raises(ValueError, match="exceeds"):
        paging.bounded(spark.range(6), 5)
    assert paging.distinct_ids(["b", "a", "b"]) == ["b", "a"]


AS_OF = datetime(2026, 9, 27, 0, 1, 40, tzinfo=timezone.utc)


def test_sample_is_replaced_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path), frame(spark, [at(0), at(50), at(60, vehicle_id="V000101")])
    snapshot.refresh_snapshot(rows, path, AS_OF)
    asked = snapshot.recent_sample(snapshot.read_snapshot(spark, path), ["V000001"], 1, AS_OF).first()
    assert (asked["readings"], asked["vehicle_limit"]) == (1, 100)

    def fail(*args):
        raise RuntimeError("injected")

    with monkeypatch.context() as patch:
        patch.setattr(snapshot, "replace_text", fail)
        with pytest.raises(RuntimeError, match="injected"):
            snapshot.refresh_snapshot(rows, path, AS_OF + timedelta(seconds=100))
    current = snapshot.read_snapshot(spark, path)
    assert current.first()["snapshot_epoch"] == AS_OF.timestamp()
    assert snapshot.assert_fresh(current, AS_OF + timedelta(seconds=120))
    with pytest.raises(ValueError, match="stale"):
        snapshot.assert_fresh(current, AS_OF + timedelta(seconds=121))
    snapshot.snapshot_view(spark, path)
    assert spark.table("recent_telemetry").count() == 3


def test_empty_sample_still_has_an_age(spark, tmp_path):
    snapshot.refresh_snapshot(frame(spark, []), str(tmp_path), AS_OF)
    rows = snapshot.read_snapshot(spark, str(tmp_path))
    assert snapshot.recent_sample(rows, ["V000001"], 15, AS_OF).count() == 0
    with pytest.raises(ValueError, match="stale"):
        snapshot.recent_sample(rows, ["V000001"], 15, AS_OF + timedelta(minutes=5))
    with pytest.raises(ValueError, match="missing"):
        snapshot.assert_fresh(rows.limit(0), AS_OF)


def test_sample_arguments(spark, tmp_path):
    scope = SampleScope(window_minutes=30)
    snapshot.refresh_snapshot(frame(spark, [at(0)]), str(tmp_path), AS_OF, scope)
    rows = snapshot.read_snapshot(spark, str(tmp_path))
    many = [f"V{i:06d}" for i in range(1, 10)]
    for ids, minutes in (
        (many, 15),
        ([], 15),
        (["V1"], 15),
        (["V000101"], 15),
        (["V000000"], 15),
        (["V000001"], 61),
        (["V000001"], 31),
        (["V000001"], 0),
    ):
        with pytest.raises(ValueError):
            snapshot.recent_sample(rows, ids, minutes, AS_OF)


def test_equality_checks(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    snapshot.assert_same_rows(a, a.orderBy("x"))
    with pytest.raises(AssertionError):
        snapshot.assert_same_rows(a, a.distinct())
    row = snapshot.reconcile(a, spark.createDataFrame([(2,), (3,)], "x int"), "x").first()
    assert tuple(row) == (1, 1, 1, 3, 2)


def samples(spark, values, **changes):
    rows = [
        {"source": "processor", "instance_id": "a", "metric": "consumed", "running": True, **changes, **v}
        for v in values
    ]
    return spark.createDataFrame([tuple(r[f] for f in METRIC_SAMPLE.fieldNames()) for r in rows], METRIC_SAMPLE)


def point(seconds, value, **changes):
    return {"ts": START + timedelta(seconds=seconds), "value": float(value), **changes}


@pytest.mark.parametrize("block_rows", [1_000_000, 2])
def test_counter_rate_survives_restarts(spark, block_rows):
    rows = samples(spark, [point(0, 10), point(2, 20), point(4, 6), point(8000, 7)])
    rates = metrics.counter_rate(rows, "consumed", block_rows=block_rows).orderBy("ts").collect()
    assert [r["rate"] for r in rates] == [5.0, 3.0, 1 / 7996]


def test_cut_counters_equal_uncut_ones(spark):
    values = [point(i * 0.5 + (i % 7) * 0.01, (i * 37) % 900) for i in range(700)]
    other = [point(i * 60.0, i, source="slow") for i in range(20)]
    rows = samples(spark, values).unionByName(samples(spark, other))
    whole, cut = (
        sorted(map(tuple, metrics.counter_rate(rows, "consumed", block_rows=n).collect()))
        for n in (None, 25)
    )
    assert whole == cut and len(whole) == 718


def test_stale_or_stopped_reports_are_left_out(spark):
    rows = samples(spark, [point(0, 1)]).unionByName(
        samples(spark, [point(4, 1)], source="simulator", running=False)
    ).unionByName(samples(spark, [point(4, 1)], source="other", running=None))
    now = START + timedelta(seconds=5)
    assert [r["source"] for r in metrics.fresh_reports(rows, now).collect()] == ["other"]
    beats = {r["source"]: r for r in metrics.heartbeats(rows, now).collect()}
    assert [beats[s]["reporting"] for s in ("processor", "simulator", "other")] == [False, False, True]
    assert beats["processor"]["heartbeat_age_seconds"] == 5


def test_progress(spark):
    rows = samples(spark, [point(0, 1), point(9, 4)]).unionByName(
        samples(spark, [point(0, 5, instance_id="x"), point(9, 5, instance_id="y")], source="s2")
    )
    found = {r["source"]: r for r in metrics.progress_check(rows, "consumed", START + timedelta(seconds=20)).collect()}
    assert found["processor"]["advanced"] and not found["processor"]["restarted"]
    assert not found["s2"]["advanced"] and found["s2"]["restarted"]
    assert not found["s2"]["stale"]


def test_mean_duration_and_totals(spark):
    rows = samples(spark, [point(0, 10), point(5, 16)], metric="sum").unionByName(
        samples(spark, [point(0, 2), point(5, 5)], metric="count")
    )
    (row,) = metrics.mean_duration(rows, "sum", "count", ["source"]).collect()
    assert row["mean_duration"] == 2.0
    totals = metrics.label_totals(rows, "sum", ["source", "instance_id"], ["source"])
    assert totals.first()["total"] == 16.0


@pytest.mark.parametrize("block_rows", [None, 1])
def test_samples_of_one_instant_are_no_restart(spark, block_rows):
    """One row an instant, whatever order its two reports came in; before, 16 then 14 was a restart."""
    for tied in ([(16, 5), (14, 4)], [(14, 4), (16, 5)]):
        points = [(0, 10, 2), *[(5, total, count) for total, count in tied], (9, 20, 7)]
        rows = samples(spark, [point(at, total) for at, total, _ in points], metric="sum").unionByName(
            samples(spark, [point(at, count) for at, _, count in points], metric="count")
        ).coalesce(1)
        means = metrics.mean_duration(rows, "sum", "count", ["source"], block_rows=block_rows).orderBy("ts")
        assert [r["mean_duration"] for r in means.collect()] == [2.0, 2.0]
        rates = metrics.counter_rate(rows, "sum", block_rows=block_rows).orderBy("ts")
        assert [r["rate"] for r in rates.collect()] == [6 / 5, 1.0]


def test_reports(spark):
    rows = enriched(spark, [at(t, speed_kmh=0.0) for t in range(25)])
    (row,) = reports.idling_report(rows, AS_OF).collect()
    assert row["duration_seconds"] == 24
    assert row["estimated_cost"] == pytest.approx(24 / 3600 * 80)
    per_minute = reports.events_per_minute(rows, AS_OF)
    assert [(r["events"], r["average_speed_kmh"]) for r in per_minute.collect()] == [(25, 0.0)]
    top = reports.activity_top(reports.activity_rollup(per_minute)).collect()
    assert sorted(r["axis"] for r in top) == ["event_type", "minute"]
    newest = reports.vehicle_history(rows, "V000001", AS_OF, 1, 2).collect()
    assert [r["timestamp"] for r in newest] == ["2026-09-27 00:00:24.000Z", "2026-09-27 00:00:23.000Z"]
    with pytest.raises(ValueError):
        reports.vehicle_history(rows, "V000001", AS_OF, 1, 1001)
    with pytest.raises(ValueError):
        reports.readings_of(rows, [])


def test_bursts_are_cut_like_lulls(spark):
    """Nine tenths of a series within a second: slices still hold about the row budget."""
    start = datetime(2026, 1, 1, tzinfo=timezone.utc)
    burst = [("a", start + timedelta(microseconds=1_000 * i)) for i in range(900)]
    lull = [("a", start + timedelta(hours=1 + i)) for i in range(100)]
    other = [("b", start + timedelta(minutes=i)) for i in range(250)] + [("c", start)]
    rows = spark.createDataFrame(burst + lull + other, "source string, ts timestamp")
    sizes = ordered.cut_by_time(rows, ["source"], "ts", block_rows=100).groupBy("source", "block").count().collect()
    assert max(r["count"] for r in sizes if r["source"] != "c") <= 130
    assert {r["block"] for r in sizes if r["source"] == "c"} == {None}
    assert len([r for r in sizes if r["source"] == "a"]) >= 9


def test_differing_rows_count_each_side(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 2), (None, 2), ("y", 3)], "v string, k int")
    found = sorted(map(tuple, snapshot.differing_rows(a, b).collect()), key=repr)
    assert found == sorted([(1, "x", "left"), (3, "z", "left"), (2, None, "right"), (3, "y", "right")], key=repr)
    snapshot.assert_same_rows(a, a.repartition(3))
    with pytest.raises(AssertionError):
        snapshot.assert_same_rows(a, b)
