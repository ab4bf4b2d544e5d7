"""Validated settings (P17, ST6). Bad values fail before any plan is built."""

from __future__ import annotations

import math
import os
from collections.abc import Mapping
from dataclasses import dataclass

# Names of the environment variables a deployment may set.
DETECTOR_VARIABLES = {
    "idling_seconds": "IDLING_THRESHOLD_SECONDS",
    "fuel_lph": "IDLE_FUEL_LPH",
    "fuel_price": "FUEL_PRICE_PER_LITRE",
    "speeding_kmh": "SPEEDING_THRESHOLD_KMH",
    "brake_mps2": "HARSH_BRAKE_THRESHOLD_MPS2",
    "accel_mps2": "HARSH_ACCEL_THRESHOLD_MPS2",
}
SAMPLE_VARIABLES = {
    "window_minutes": "DUCKDB_WINDOW_MINUTES",
    "vehicle_limit": "DUCKDB_VEHICLE_LIMIT",
    "row_limit": "DUCKDB_ROW_LIMIT",
    "interval_seconds": "DUCKDB_SYNC_SECONDS",
    "max_age_seconds": "DUCKDB_MAX_AGE_SECONDS",
}

ONLINE_SECONDS = 60
STATE_TTL_SECONDS = 3600
DEDUP_HOURS = 24
DEDUP_TTL = f"{DEDUP_HOURS} hours"
REPORT_FRESH_SECONDS = 5
FUTURE_TOLERANCE_SECONDS = 30
RETENTION_DAYS = 30
MAX_RESULT_ROWS = 10_000


def _within(name: str, value: int, low: int, high: int) -> None:
    if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value!r}")


def _from_environment(cls, variables: Mapping[str, str], convert, environ):
    environ = os.environ if environ is None else environ
    return cls(**{f: convert(environ[v]) for f, v in variables.items() if v in environ})


@dataclass(frozen=True)
class DetectorSettings:
    """Thresholds of the detectors and the idle fuel assumption."""

    idling_seconds: float = 20.0
    fuel_lph: float = 0.8
    fuel_price: float = 100.0
    speeding_kmh: float = 100.0
    brake_mps2: float = -3.0
    accel_mps2: float = 3.0
    max_gap_seconds: float = 10.0
    idle_speed_kmh: float = 0.5
    low_energy_pct: float = 10.0

    def __post_init__(self):
        for name in ("idling_seconds", "speeding_kmh", "accel_mps2"):
            value = getattr(self, name)
            if not (math.isfinite(value) and value > 0):
                raise ValueError(f"{name} must be finite and positive")
        if not (math.isfinite(self.brake_mps2) and self.brake_mps2 < 0):
            raise ValueError("brake_mps2 must be finite and negative")

    @classmethod
    def from_env(cls, environ: Mapping[str, str] | None = None) -> DetectorSettings:
        return _from_environment(cls, DETECTOR_VARIABLES, float, environ)


@dataclass(frozen=True)
class SampleScope:
    """Bounds of the published recent sample."""

    window_minutes: int = 120
    vehicle_limit: int = 100
    row_limit: int = 20_000
    interval_seconds: int = 30
    max_age_seconds: int = 120

    def __post_init__(self):
        _within("window_minutes", self.window_minutes, 1, 1440)
        _within("vehicle_limit", self.vehicle_limit, 1, 1000)
        _within("row_limit", self.row_limit, 1, 100_000)
        _within("interval_seconds", self.interval_seconds, 1, 60)
        _within("max_age_seconds", self.max_age_seconds, 1, 600)
        if self.interval_seconds >= self.max_age_seconds:
            raise ValueError("max_age_seconds must be greater than interval_seconds")

    @classmethod
    def from_env(cls, environ: Mapping[str, str] | None = None) -> SampleScope:
        return _from_environment(cls, SAMPLE_VARIABLES, int, environ)


@dataclass(frozen=True)
class StreamOptions:
    """Flush rules of a stream: rows and seconds per batch, bytes as a guard.

    The defaults suit a cluster, where a batch should outweigh its fixed cost; a batch of a
    million rows needs no cutting by vehicle either. `ONE_PROCESS` holds the limits of a
    single-process consumer.
    """

    rows: int = 1_000_000
    seconds: int = 10
    bytes: int = 1 << 30

    def __post_init__(self):
        if self.rows < 1 or self.bytes < 1:
            raise ValueError("rows and bytes must be positive")
        _within("seconds", self.seconds, 1, 30)


ONE_PROCESS = StreamOptions(rows=5000, seconds=10, bytes=32 * 1024 * 1024)
