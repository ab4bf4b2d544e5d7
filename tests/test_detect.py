"""Detectors: worked cases, edges, and agreement with a sequential re-statement."""

from __future__ import annotations

import random
import uuid
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from fleetspark.functions.ids import canonical_uuid, incident_id
from fleetspark.operators import detect as d
from fleetspark.operators.dedup import dedup_first
from fleetspark.operators.state import latest_state
from fleetspark.settings import DetectorSettings, SampleScope, StreamOptions
from tests.build import START, at, base, by_event, frame, replay


def run(spark, rows, **kwargs):
    detected = d.detect(frame(spark, rows), **kwargs).persist()
    seen = by_event(detected)
    return [seen[r["event_id"]] for r in rows], d.open_incidents(detected).collect(), detected


def test_idling_needs_duration_and_opens_once(spark):
    rows = [at(t, speed_kmh=0.0) for t in range(25)]
    seen, alerts, detected = run(spark, rows)
    assert [a["type"] for a in alerts] == ["IDLING_ALERT"]
    assert all("IDLING_ALERT" not in r["detected_types"] for r in seen[:21])
    assert sum(r["idling_seconds"] for r in seen) == 24
    assert alerts[0]["start_timestamp"].timestamp() == START.timestamp()
    (active,) = latest_state(detected, START).first()["active_alerts"]
    assert active["duration_seconds"] == 24
    assert active["alert_id"] == alerts[0]["alert_id"]
    assert active["event_id"] == rows[-1]["event_id"]


def test_gap_resets_idling_and_braking(spark):
    seen, alerts, _ = run(spark, [at(0, speed_kmh=90.0), at(30, speed_kmh=0.0)])
    assert not alerts
    assert seen[1]["idling_seconds"] == 0 and seen[1]["idle_duration_seconds"] == 0


def test_braking_follows_speed_not_label(spark):
    _, alerts, _ = run(spark, [at(0, speed_kmh=82.0), at(1, speed_kmh=60.0)])
    assert [a["type"] for a in alerts] == ["HARSH_BRAKE"]
    assert alerts[0]["detail"] == "acceleration_mps2=-6.11"
    _, alerts, _ = run(
        spark, [at(0, speed_kmh=82.0), at(1, speed_kmh=80.0, event_type="HARSH_BRAKE")]
    )
    assert not alerts


def test_fault_opens_once_and_closes(spark):
    rows = [
        at(0, speed_kmh=125.0, dtc=["P0301", "U0100"]),
        at(1, speed_kmh=125.0, dtc=["P0301"]),
        at(2, speed_kmh=99.0),
    ]
    _, alerts, detected = run(spark, rows)
    assert sorted(a["type"] for a in alerts) == ["ENGINE_FAULT", "HARSH_BRAKE", "SPEEDING"]
    assert {a["detail"] for a in alerts if a["type"] == "ENGINE_FAULT"} == {"P0301,U0100"}
    active = latest_state(detected, START).first()["active_alerts"]
    assert [a["type"] for a in active] == ["HARSH_BRAKE"]
    assert d.active_episodes(detected).count() == 5


def test_late_reading_changes_nothing(spark):
    rows = [at(2, speed_kmh=80.0), at(1, speed_kmh=0.0, dtc=["P0301"])]
    seen, alerts, detected = run(spark, rows)
    assert seen[1]["late"] and seen[1]["idling_seconds"] == 0 and not alerts
    assert latest_state(detected, START).first()["event_id"] == rows[0]["event_id"]
    assert d.enrich(detected).count() == 2


@pytest.mark.parametrize("fuel,soc,cost", [(50.0, None, 0.8 / 3600 * 100), (None, 50.0, 0.0)])
def test_fuel_is_for_engines_only(spark, fuel, soc, cost):
    rows = [at(t, speed_kmh=0.0, fuel_pct=fuel, soc_pct=soc) for t in range(2)]
    seen, _, _ = run(spark, rows)
    assert seen[1]["estimated_cost"] == pytest.approx(cost, abs=1e-12)


def test_braking_threshold(spark):
    rows = [at(0, speed_kmh=82.0), at(1, speed_kmh=60.0)]
    settings = DetectorSettings.from_env({"HARSH_BRAKE_THRESHOLD_MPS2": "-7"})
    assert not run(spark, rows, settings=settings)[1]


@pytest.mark.parametrize("value", ["0", "3", "nan", "-inf"])
def test_bad_braking_threshold(value):
    with pytest.raises(ValueError, match="brake_mps2"):
        DetectorSettings.from_env({"HARSH_BRAKE_THRESHOLD_MPS2": value})


@pytest.mark.parametrize("name", ["idling_seconds", "speeding_kmh", "accel_mps2"])
@pytest.mark.parametrize("value", [0.0, -1.0, float("nan"), float("inf")])
def test_bad_positive_thresholds(name, value):
    with pytest.raises(ValueError, match=name):
        DetectorSettings(**{name: value})


def test_bad_scopes_and_options():
    for bad in ({"row_limit": 0}, {"vehicle_limit": 1001}, {"interval_seconds": 60, "max_age_seconds": 60}):
        with pytest.raises(ValueError):
            SampleScope(**bad)
    assert SampleScope.from_env({"DUCKDB_ROW_LIMIT": "7"}).row_limit == 7
    with pytest.raises(ValueError):
        StreamOptions(seconds=31)


def test_equal_times(spark):
    rows = [
        at(0, speed_kmh=0.0),
        at(1, speed_kmh=0.0, seq=5),
        at(1, speed_kmh=0.0, seq=5),  # same place: late
        at(1, speed_kmh=0.0, seq=6),  # accepted, but the run starts anew
        at(2, speed_kmh=0.0, seq=7),
    ]
    seen, _, _ = run(spark, rows)
    assert [r["late"] for r in seen] == [False, False, True, False, False]
    assert [r["idling_seconds"] for r in seen] == [0, 1, 0, 0, 1]
    assert seen[4]["idle_duration_seconds"] == 1


def test_of_equal_readings_the_first_counts(spark):
    rows = [at(0, speed_kmh=10.0), at(0, speed_kmh=200.0), at(1, speed_kmh=12.0, seq=9)]
    seen, _, _ = run(spark, rows)
    assert seen[1]["late"]
    assert seen[2]["detected_types"] == []


def test_edges(spark):
    assert run(spark, [at(0), at(10)])[0][1]["continuous"]
    assert not run(spark, [at(0), at(10.001, seq=99)])[0][1]["continuous"]
    at_threshold = run(spark, [at(t, speed_kmh=0.0) for t in range(0, 21, 5)])[0][-1]
    assert at_threshold["idle_duration_seconds"] == 20 and at_threshold["detected_types"] == []
    stopped = run(spark, [at(0, speed_kmh=0.0, engine_on=False)])[2]
    assert latest_state(stopped, START).first()["status"] == "STOPPED"
    reopened = run(spark, [at(0, speed_kmh=120.0), at(1), at(2, speed_kmh=120.0)])[1]
    speeding = [a["alert_id"] for a in reopened if a["type"] == "SPEEDING"]
    assert len(set(speeding)) == 2


def test_first_arrival_wins(spark):
    same = base(speed_kmh=10.0)
    rows = frame(spark, [same, {**same, "speed_kmh": 90.0}])
    assert [r["speed_kmh"] for r in dedup_first(rows).collect()] == [10.0]


def random_readings(count: int, vehicles: int, seed: int) -> list[dict]:
    """Vehicle V000000 sends a third of everything."""
    pick = random.Random(seed)
    clock = {}
    rows = []
    for i in range(count):
        v = 0 if pick.random() < 0.33 else pick.randrange(vehicles)
        clock[v] = clock.get(v, 0.0) + pick.choice([0, 0.5, 1, 2, 5, 10, 10.5, 15])
        shift = pick.choice([0, 0, 0, 0, 0, -3, -30])
        rows.append(
            base(
                event_id=str(uuid.UUID(int=pick.getrandbits(128))),
                vehicle_id=f"V{v:06d}",
                timestamp=START + timedelta(seconds=clock[v] + shift),
                seq=pick.randrange(5),
                speed_kmh=pick.choice([0.0, 0.0, 0.0, 0.0, 0.4, 3.0, 60.0, 101.0, 130.0]),
                engine_on=pick.random() < 0.9,
                fuel_pct=pick.choice([5.0, 50.0]) if v % 2 else None,
                soc_pct=None if v % 2 else pick.choice([9.9, 10.0]),
                dtc=pick.choice([[], [], ["P0301"]]),
            )
        )
    return rows


@pytest.mark.parametrize("block_rows", [1_000_000, 100, 7, 1])
def test_windows_equal_the_sequential_rules(spark, block_rows):
    rows = random_readings(4000, 12, seed=5)
    seen = by_event(d.detect(frame(spark, rows), block_rows=block_rows))
    want = replay(rows)
    assert sum(late for late, *_ in want.values()) > 100
    for key, (late, delta, kinds, opened) in want.items():
        row = seen[key]
        assert (row["late"], tuple(row["detected_types"]), tuple(row["opened_types"])) == (
            late,
            kinds,
            opened,
        )
        assert row["idling_seconds"] == pytest.approx(delta)


def test_cutting_changes_no_episode_or_state(spark):
    rows = frame(spark, random_readings(3000, 10, seed=8))
    whole, cut = d.detect(rows), d.detect(rows, block_rows=20).persist()
    assert cut.where("block IS NOT NULL").select("block").distinct().count() > 50
    for view in (d.active_episodes, d.open_incidents, lambda x: latest_state(x, START)):
        a, b = (sorted(map(repr, view(x).collect())) for x in (whole, cut))
        assert a == b


def test_only_busy_vehicles_are_cut(spark):
    rows = d.detect(frame(spark, random_readings(2000, 30, seed=3)), block_rows=300)
    blocks = {r["vehicle_id"] for r in rows.where("block IS NOT NULL").collect()}
    assert blocks == {"V000000"}
    assert rows.groupBy("vehicle_id", "block").count().agg(F.max("count")).first()[0] <= 300


def test_incident_ids_equal_the_standard_library(spark):
    ids = [str(uuid.uuid4()) for _ in range(50)]
    frame_ = spark.createDataFrame([(i,) for i in ids], "event_id string")
    got = frame_.select("event_id", incident_id(F.col("event_id"), F.lit("SPEEDING")).alias("a"))
    for row in got.collect():
        assert row["a"] == str(uuid.uuid5(uuid.NAMESPACE_URL, f"{row['event_id']}:SPEEDING"))


def test_canonical_uuid(spark):
    one = uuid.uuid4()
    texts = [str(one).upper(), one.hex, "x", str(one) + "0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(canonical_uuid(F.col("t"))).collect()]
    assert got == [str(one), str(one), None, None]
