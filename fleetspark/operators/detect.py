"""Event-time detection as window expressions.

Readings need the telemetry columns plus `partition` and `offset`. A reading is accepted in order
exactly when its (timestamp, seq) exceeds every earlier one of its vehicle, so among accepted
readings arrival order and event order agree and one sort serves every operator here.

An optional `carried` struct marks a row as the latest state of an earlier run (see
`operators.state.as_carried`): it sorts first, supplies the previous reading, and is removed by
`detect`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions.ids import incident_id
from fleetspark.functions.times import seconds_between
from fleetspark.operators.dedup import ARRIVAL_ORDER
from fleetspark.plans.ordered import BLOCK, BLOCK_ROWS, cut_by_offset, running_max
from fleetspark.schema import ALERT_COLUMNS, ENRICHED_COLUMNS
from fleetspark.settings import DetectorSettings

# Alert kinds in reporting order.
KINDS = [
    "IDLING_ALERT",
    "SPEEDING",
    "HARSH_BRAKE",
    "HARSH_ACCELERATION",
    "ENGINE_FAULT",
    "LOW_ENERGY",
]

KEY = ["vehicle_id"]
DEFAULTS = DetectorSettings()


def energy() -> Column:
    return F.coalesce("fuel_pct", "soc_pct")


def _has_fault() -> Column:
    return F.coalesce(F.size("dtc") > 0, F.lit(False))


def _newer_first_arrival(*payload: Column) -> Column:
    """Sorts by event order; of equal readings the first arrival counts as the newest."""
    return F.struct(
        F.col("timestamp"),
        F.col("seq"),
        (-F.col("partition")).alias("_p"),
        (-F.col("offset")).alias("_o"),
        *payload,
    )


def _with_block(df: DataFrame, block_rows: int | None) -> DataFrame:
    return df if BLOCK in df.columns else cut_by_offset(df, KEY, block_rows=block_rows)


def with_previous(
    df: DataFrame,
    settings: DetectorSettings = DEFAULTS,
    *,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Add `previous` (last accepted reading), `late`, `dt` and `continuous`."""
    reading = _newer_first_arrival(
        F.col("speed_kmh"),
        F.col("engine_on"),
        energy().alias("energy"),
        _has_fault().alias("faulty"),
    )
    rows = running_max(
        _with_block(df, block_rows), KEY, ARRIVAL_ORDER, before={"previous": reading}
    )
    same_time = F.col("timestamp") == F.col("previous.timestamp")
    behind = (F.col("timestamp") < F.col("previous.timestamp")) | (
        same_time & (F.col("seq") <= F.col("previous.seq"))
    )
    rows = rows.withColumn("late", F.coalesce(behind, F.lit(False)))
    rows = rows.withColumn(
        "dt",
        F.when(~F.col("late"), seconds_between(F.col("previous.timestamp"), F.col("timestamp"))),
    )
    close = (F.col("dt") > 0) & (F.col("dt") <= settings.max_gap_seconds)
    return rows.withColumn("continuous", F.coalesce(close, F.lit(False)))


def flag_late(df: DataFrame, *, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Add only the `late` flag (D2, ST1)."""
    return with_previous(df, block_rows=block_rows).drop("previous", "dt", "continuous", BLOCK)


def idle_intervals(df: DataFrame, settings: DetectorSettings = DEFAULTS) -> DataFrame:
    """Add `idle`, `in_run` and `idling_seconds`, the time idled since the last reading."""
    slow = settings.idle_speed_kmh
    idle = ~F.col("late") & F.col("engine_on") & (F.col("speed_kmh") <= slow)
    was_idle = F.col("previous.engine_on") & (F.col("previous.speed_kmh") <= slow)
    return (
        df.withColumn("idle", F.coalesce(idle, F.lit(False)))
        .withColumn("in_run", F.col("continuous") & F.col("idle") & F.coalesce(was_idle, F.lit(False)))
        .withColumn("idling_seconds", F.when(F.col("in_run"), F.col("dt")).otherwise(F.lit(0.0)))
    )


def acceleration(df: DataFrame) -> DataFrame:
    """Add `acceleration_mps2`, zero when the reading does not continue the last one."""
    change = (F.col("speed_kmh") - F.col("previous.speed_kmh")) / F.lit(3.6) / F.col("dt")
    return df.withColumn(
        "acceleration_mps2", F.when(F.col("continuous"), change).otherwise(F.lit(0.0))
    )


def idle_runs(df: DataFrame) -> DataFrame:
    """Add `idle_start`, `idle_duration_seconds` and `previous_acceleration`.

    A run starts at an idle reading that does not continue one. Starts only grow, so the newest
    start so far is a running maximum; the acceleration of the last accepted reading, which
    incident opening needs, rides in the same scan.
    """
    carried = "carried" in df.columns
    start = F.when(F.col("idle") & ~F.col("in_run"), F.col("timestamp"))
    speed_up = F.col("acceleration_mps2")
    if carried:
        known = F.col("carried").isNotNull()
        start = F.when(known, F.col("carried.idle_start")).otherwise(start)
        speed_up = F.when(known, F.col("carried.acceleration_mps2")).otherwise(speed_up)
    accepted = F.when(
        ~F.col("late"), _newer_first_arrival(speed_up.alias("acceleration_mps2"))
    )
    rows = running_max(
        df, KEY, ARRIVAL_ORDER, before={"_last": accepted}, through={"_start": start}
    )
    rows = rows.withColumn("idle_start", F.when(F.col("idle"), F.col("_start")))
    lasted = seconds_between(F.col("idle_start"), F.col("timestamp"))
    return (
        rows.withColumn(
            "idle_duration_seconds",
            F.when(F.col("idle"), F.greatest(F.lit(0.0), lasted)).otherwise(F.lit(0.0)),
        )
        .withColumn("previous_acceleration", F.col("_last.acceleration_mps2"))
        .drop("_last", "_start")
    )


def litres(seconds: Column, settings: DetectorSettings = DEFAULTS) -> Column:
    """Fuel burnt by idling; electric vehicles, which report no fuel level, burn none."""
    burnt = seconds / F.lit(3600.0) * F.lit(float(settings.fuel_lph))
    return F.when(F.col("fuel_pct").isNotNull(), burnt).otherwise(F.lit(0.0))


def fuel_estimate(df: DataFrame, settings: DetectorSettings = DEFAULTS) -> DataFrame:
    """Add `estimated_fuel_l` and `estimated_cost` of the idle interval."""
    return df.withColumn("estimated_fuel_l", litres(F.col("idling_seconds"), settings)).withColumn(
        "estimated_cost", F.col("estimated_fuel_l") * F.lit(float(settings.fuel_price))
    )


def _kinds_where(conditions: dict[str, Column]) -> Column:
    marks = F.array(*[F.when(conditions[kind], F.lit(kind)) for kind in KINDS])
    return F.filter(marks, lambda kind: kind.isNotNull())


def detect_types(df: DataFrame, settings: DetectorSettings = DEFAULTS) -> DataFrame:
    """Add `detected_types` and `opened_types`.

    A kind is opened when it is detected now and was not detected on a previous reading that this
    one continues.
    """
    now = {
        "IDLING_ALERT": F.col("idle")
        & (F.col("idle_duration_seconds") > settings.idling_seconds),
        "SPEEDING": F.col("speed_kmh") > settings.speeding_kmh,
        "HARSH_BRAKE": F.col("acceleration_mps2") < settings.brake_mps2,
        "HARSH_ACCELERATION": F.col("acceleration_mps2") > settings.accel_mps2,
        "ENGINE_FAULT": _has_fault(),
        "LOW_ENERGY": energy() < settings.low_energy_pct,
    }
    idled_before = seconds_between(F.col("idle_start"), F.col("previous.timestamp"))
    before = {
        "IDLING_ALERT": F.col("in_run") & (idled_before > settings.idling_seconds),
        "SPEEDING": F.col("previous.speed_kmh") > settings.speeding_kmh,
        "HARSH_BRAKE": F.col("previous_acceleration") < settings.brake_mps2,
        "HARSH_ACCELERATION": F.col("previous_acceleration") > settings.accel_mps2,
        "ENGINE_FAULT": F.col("previous.faulty"),
        "LOW_ENERGY": F.col("previous.energy") < settings.low_energy_pct,
    }
    flags = {kind: ~F.col("late") & now[kind] for kind in KINDS}
    opens = {
        kind: flags[kind]
        & ~(F.col("continuous") & F.coalesce(before[kind], F.lit(False)))
        for kind in KINDS
    }
    return df.withColumns(
        {"detected_types": _kinds_where(flags), "opened_types": _kinds_where(opens)}
    )


def detect(
    df: DataFrame,
    settings: DetectorSettings = DEFAULTS,
    *,
    block_rows: int | None = BLOCK_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """All detectors over deduplicated readings; keeps the helper columns.

    Without busy vehicles the readings are read once more to count them (or `counted` is), and
    the plan is one exchange and one sort. With busy ones, the input of each of the two scans is
    stored, so that it is evaluated once.
    """
    rows = cut_by_offset(df, KEY, block_rows=block_rows, counted=counted)
    rows = with_previous(rows, settings)
    rows = acceleration(idle_intervals(rows, settings))
    rows = fuel_estimate(idle_runs(rows), settings)
    return detect_types(rows, settings)


def new_rows(detected: DataFrame) -> DataFrame:
    """Detected rows without those that only carried earlier state."""
    if "carried" not in detected.columns:
        return detected
    return detected.where(F.col("carried").isNull()).drop("carried")


def enrich(detected: DataFrame) -> DataFrame:
    """History rows: the reading and its five measures."""
    return new_rows(detected).select(*ENRICHED_COLUMNS)


def alert_columns(
    kind: Column, settings: DetectorSettings, alert_id: Column, start: Column
) -> list[Column]:
    """Alert row of the current reading: given identity and start, measures of the reading."""
    idling = kind == "IDLING_ALERT"
    seconds = F.when(idling, F.col("idle_duration_seconds")).otherwise(F.lit(0.0))
    fuel = litres(seconds, settings)
    detail = F.when(kind == "ENGINE_FAULT", F.array_join("dtc", ",")).otherwise(
        F.format_string("acceleration_mps2=%.2f", F.col("acceleration_mps2"))
    )
    columns = {
        "alert_id": alert_id,
        "event_id": F.col("event_id"),
        "vehicle_id": F.col("vehicle_id"),
        "fleet_id": F.col("fleet_id"),
        "timestamp": F.col("timestamp"),
        "type": kind,
        "start_timestamp": start,
        "duration_seconds": seconds,
        "estimated_fuel_l": fuel,
        "estimated_cost": fuel * F.lit(float(settings.fuel_price)),
        "detail": detail,
    }
    return [columns[name].alias(name) for name in ALERT_COLUMNS]


def open_incidents(detected: DataFrame, settings: DetectorSettings = DEFAULTS) -> DataFrame:
    """One alert row per incident that opens."""
    kind = F.col("type")
    opened = new_rows(detected).withColumn("type", F.explode("opened_types"))
    start = F.when(kind == "IDLING_ALERT", F.col("idle_start")).otherwise(F.col("timestamp"))
    return opened.select(*alert_columns(kind, settings, incident_id(F.col("event_id"), kind), start))


def active_episodes(detected: DataFrame, settings: DetectorSettings = DEFAULTS) -> DataFrame:
    """Every active alert of every accepted reading, with its incident's id and start."""
    opening = F.struct(
        "timestamp", "seq", F.col("event_id"), F.col("idle_start")
    )
    origins = running_max(
        detected.where(~F.col("late")),
        KEY,
        ARRIVAL_ORDER,
        through={
            f"_origin_{i}": F.when(F.array_contains("opened_types", kind), opening)
            for i, kind in enumerate(KINDS)
        },
    )
    listed = F.array(
        *[
            F.struct(F.lit(kind).alias("type"), F.col(f"_origin_{i}").alias("origin"))
            for i, kind in enumerate(KINDS)
        ]
    )
    episodes = (
        new_rows(origins)
        .withColumn("_episode", F.explode(listed))
        .where(F.array_contains("detected_types", F.col("_episode.type")))
    )
    kind = F.col("_episode.type")
    origin = F.col("_episode.origin")
    start = F.when(kind == "IDLING_ALERT", origin["idle_start"]).otherwise(origin["timestamp"])
    return episodes.select(
        *alert_columns(kind, settings, incident_id(origin["event_id"], kind), start)
    )
