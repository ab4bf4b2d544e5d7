"""Small hand-made readings, records and a sequential re-statement of the rules."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta, timezone

from fleetspark.schema import ARRIVAL, RECORD, TELEMETRY
from pyspark.sql.types import StructType

START = datetime(2026, 9, 27, tzinfo=timezone.utc)
READING = StructType(TELEMETRY.fields + ARRIVAL.fields)
TOPIC = "fleet.telemetry.v1"


def base(**changes) -> dict:
    row = {
        "event_id": str(uuid.uuid4()),
        "vehicle_id": "V000001",
        "vin": "SYN00000000000001",
        "fleet_id": "F001",
        "timestamp": START,
        "seq": 1,
        "lat": 13.0,
        "lon": 80.0,
        "speed_kmh": 40.0,
        "heading_deg": 90.0,
        "engine_on": True,
        "fuel_pct": 60.0,
        "soc_pct": None,
        "odometer_km": 1200.0,
        "engine_temp_c": 85.0,
        "dtc": [],
        "event_type": "NORMAL",
        "source_oem": "Tata",
        "schema_version": 1,
    }
    return {**row, **changes}


def at(seconds: float, **changes) -> dict:
    """A reading some seconds after the start; its seq follows the second."""
    moment = START + timedelta(seconds=seconds)
    return base(**{"timestamp": moment, "seq": int(seconds) + 1, **changes})


def frame(spark, rows: list[dict]):
    """Readings that arrive in list order."""
    placed = [{"partition": 0, "offset": i, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f] for f in READING.fieldNames()) for r in placed], READING)


def payload(row: dict) -> bytes:
    text = row["timestamp"]
    text = text if isinstance(text, str) else text.isoformat().replace("+00:00", "Z")
    return json.dumps({**row, "timestamp": text}).encode()


def records(spark, payloads: list, partition: int = 0, start: int = 0, timestamp_ms: int = 1790467200000):
    rows = [
        (TOPIC, partition, start + i, None if p is None else bytearray(p), timestamp_ms)
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, RECORD)


def by_event(df) -> dict:
    return {row["event_id"]: row for row in df.collect()}


def replay(rows: list[dict], *, idling=20, gap=10) -> dict:
    """What each reading in arrival order must yield: late, idle delta, kinds, opened kinds."""
    memory, result = {}, {}
    for row in rows:
        last = memory.get(row["vehicle_id"])
        place = (row["timestamp"], row["seq"])
        if last is not None and place <= last["place"]:
            result[row["event_id"]] = (True, 0.0, (), ())
            continue
        step = (row["timestamp"] - last["place"][0]).total_seconds() if last else 0.0
        joined = 0 < step <= gap
        resting = row["engine_on"] and row["speed_kmh"] <= 0.5
        running_on = joined and resting and last["rest_from"] is not None
        rest_from = None
        if resting:
            rest_from = last["rest_from"] if running_on else row["timestamp"]
        change = (row["speed_kmh"] - last["speed"]) / 3.6 / step if joined else 0.0
        level = row["fuel_pct"] if row["fuel_pct"] is not None else row["soc_pct"]
        rested = (row["timestamp"] - rest_from).total_seconds() if resting else 0.0
        checks = [
            ("IDLING_ALERT", rested > idling),
            ("SPEEDING", row["speed_kmh"] > 100),
            ("HARSH_BRAKE", change < -3),
            ("HARSH_ACCELERATION", change > 3),
            ("ENGINE_FAULT", bool(row["dtc"])),
            ("LOW_ENERGY", level < 10),
        ]
        kinds = tuple(kind for kind, holds in checks if holds)
        known = last["kinds"] if joined else ()
        opened = tuple(kind for kind in kinds if kind not in known)
        result[row["event_id"]] = (False, step if running_on else 0.0, kinds, opened)
        memory[row["vehicle_id"]] = {
            "place": place,
            "speed": row["speed_kmh"],
            "rest_from": rest_from,
            "kinds": kinds,
        }
    return result
