"""Latest state per vehicle and what is derived from it (D12, J1, J2, P15, ST8, T6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.ids import incident_id
from fleetspark.functions.times import minus_seconds, moment
from fleetspark.operators.detect import DEFAULTS, KINDS, alert_columns
from fleetspark.plans.paging import check_page, page
from fleetspark.schema import ALERT, STATE, TELEMETRY_COLUMNS
from fleetspark.settings import ONLINE_SECONDS, STATE_TTL_SECONDS, DetectorSettings

_CARRIED = [name for name in STATE.fieldNames() if name not in TELEMETRY_COLUMNS]
_MEASURED = ["idle_start", "idle_duration_seconds", "acceleration_mps2"]


def as_carried(state: DataFrame, as_of=None) -> DataFrame:
    """State rows as leading readings for `detect`; states older than an hour are dropped."""
    if as_of is not None:
        oldest = minus_seconds(moment(as_of), STATE_TTL_SECONDS)
        state = state.where(F.col("received_at") >= oldest)
    return state.select(
        *TELEMETRY_COLUMNS,
        F.lit(-1).alias("partition"),
        F.lit(-1).cast("long").alias("offset"),
        F.struct(*_CARRIED).alias("carried"),
    )


def with_carried(readings: DataFrame, state: DataFrame, as_of=None) -> DataFrame:
    """Readings preceded by the states they continue from."""
    return readings.unionByName(as_carried(state, as_of), allowMissingColumns=True)


def _active_alerts(settings: DetectorSettings, prior: Column | None) -> Column:
    """The alerts of the newest reading as an array of structs, in reporting order.

    An active kind belongs to its newest opening; without one in these rows it continues an alert
    carried from earlier.
    """
    openings = F.array(
        *[
            F.struct(F.lit(kind).alias("type"), F.col(f"_origin_{i}").alias("origin"))
            for i, kind in enumerate(KINDS)
        ]
    )

    def alert(opening: Column) -> Column:
        kind, origin = opening["type"], opening["origin"]
        alert_id = incident_id(origin["event_id"], kind)
        start = F.when(kind == "IDLING_ALERT", origin["idle_start"]).otherwise(origin["timestamp"])
        if prior is not None:
            old = F.try_element_at(F.filter(prior, lambda a: a["type"] == kind), F.lit(1))
            alert_id = F.when(origin.isNull(), old["alert_id"]).otherwise(alert_id)
            start = F.when(origin.isNull(), old["start_timestamp"]).otherwise(start)
        return F.struct(*alert_columns(kind, settings, alert_id, start))

    active = F.filter(openings, lambda o: F.array_contains("detected_types", o["type"]))
    return F.transform(active, alert)


def status_of(idle: Column, speed: Column, settings: DetectorSettings = DEFAULTS) -> Column:
    return (
        F.when(idle, "IDLING").when(speed > settings.idle_speed_kmh, "MOVING").otherwise("STOPPED")
    )


def latest_state(
    detected: DataFrame, received_at, settings: DetectorSettings = DEFAULTS
) -> DataFrame:
    """One row per vehicle: the newest accepted reading with its state.

    One plain aggregate finds the newest reading and the newest opening of each kind, so no
    vehicle's readings are ever gathered, and what `detect` partitioned is not shuffled again.
    """
    carried = "carried" in detected.columns
    kept = [*TELEMETRY_COLUMNS, *_MEASURED, "idle", "detected_types"]
    if carried:
        kept.append("carried")
    is_new = F.col("carried").isNull() if carried else F.lit(True)
    opening = F.struct("timestamp", "seq", "event_id", "idle_start")
    found = [F.max(F.struct("timestamp", "seq", F.struct(*kept).alias("row"))).alias("_newest")]
    for i, kind in enumerate(KINDS):
        opens = is_new & F.array_contains("opened_types", kind)
        found.append(F.max(F.when(opens, opening)).alias(f"_origin_{i}"))
    if carried:
        found.append(F.max("carried.active_alerts").alias("_prior"))
    groups = detected.where(~F.col("late")).groupBy("vehicle_id").agg(*found)
    rows = groups.select("_newest.row.*", *[c for c in groups.columns if c[0] == "_" and c != "_newest"])
    values = {
        **{name: F.col(name) for name in _MEASURED},
        "active_alerts": _active_alerts(settings, F.col("_prior") if carried else None),
        "status": status_of(F.col("idle"), F.col("speed_kmh"), settings),
        "received_at": moment(received_at),
    }
    if carried:
        old = F.col("carried").isNotNull()
        values = {n: F.when(old, F.col(f"carried.{n}")).otherwise(v) for n, v in values.items()}
    return rows.select(*TELEMETRY_COLUMNS, *[values[name].alias(name) for name in _CARRIED])


def _since(as_of, seconds: int) -> Column:
    return F.col("timestamp") >= minus_seconds(moment(as_of), seconds)


def vehicle_status(latest: DataFrame, as_of) -> DataFrame:
    """Status as a reader sees it: OFFLINE once the reading is over a minute old."""
    shown = F.when(_since(as_of, ONLINE_SECONDS), F.col("status")).otherwise("OFFLINE")
    return latest.select("vehicle_id", "fleet_id", "timestamp", shown.alias("status"))


def presence_index(latest: DataFrame, as_of) -> DataFrame:
    """Vehicles seen within an hour, with the flags that counts are based on (ST8)."""
    online = _since(as_of, ONLINE_SECONDS)
    return latest.where(_since(as_of, STATE_TTL_SECONDS)).select(
        "vehicle_id",
        "timestamp",
        online.alias("online"),
        (online & (F.col("status") == "IDLING")).alias("idling"),
        F.when(online, F.size("active_alerts")).otherwise(0).alias("active_alerts"),
    )


def active_alerts(latest: DataFrame, as_of, limit: int = 50, offset: int = 0) -> DataFrame:
    """A page of the alerts active within the last minute, newest first."""
    check_page(limit, offset, 100)
    alerts = (
        latest.where(_since(as_of, ONLINE_SECONDS))
        .select(F.explode("active_alerts").alias("alert"))
        .select(*[f"alert.{name}" for name in ALERT.fieldNames()])
    )
    order = [F.desc("timestamp"), F.desc(F.concat_ws(":", "vehicle_id", "type"))]
    return page(alerts, order, limit, offset)


def active_alert_count(latest: DataFrame, as_of) -> DataFrame:
    """Total behind `active_alerts` pages."""
    return latest.where(_since(as_of, ONLINE_SECONDS)).agg(
        F.coalesce(F.sum(F.size("active_alerts")), F.lit(0)).cast("long").alias("total")
    )


def vehicle_page(
    registry: DataFrame,
    latest: DataFrame,
    limit: int = 25,
    offset: int = 0,
    fleet_id: str | None = None,
) -> DataFrame:
    """A registry page with each vehicle's live state, null when unseen.

    The page holds at most 100 rows, so it is broadcast to pick its states out of all of them.
    """
    check_page(limit, offset, 100)
    if fleet_id is not None:
        registry = registry.where(F.col("fleet_id") == fleet_id)
    rows = page(registry, [F.asc("vehicle_id")], limit, offset)
    states = latest.join(F.broadcast(rows.select("vehicle_id")), "vehicle_id", "left_semi")
    live = states.select("vehicle_id", F.struct(*STATE.fieldNames()).alias("live"))
    return rows.join(live, "vehicle_id", "left")
