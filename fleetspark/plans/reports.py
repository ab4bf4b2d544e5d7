"""Fleet questions over the stored tables.

Every report takes `as_of` instead of reading the clock. Top-k reports are planned as per-task
top-k; ties are broken by key so that results are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.times import minus_seconds, moment, utc_text
from fleetspark.operators.outcomes import sum_of_parts
from fleetspark.operators.state import presence_index
from fleetspark.operators.tables import in_window
from fleetspark.plans.paging import check_between, check_vehicle, distinct_ids
from fleetspark.settings import REPORT_FRESH_SECONDS, DetectorSettings

TOP_IDLERS = 20
ACTIVITY_GROUPS = 240
HISTORY_COLUMNS = ["speed_kmh", "lat", "lon", "fuel_pct", "soc_pct", "event_type"]


def idling_report(
    history: DataFrame, as_of, days: int = 7, fleet_id: str | None = None
) -> DataFrame:
    """The 20 vehicles that idled longest, with estimated fuel and cost."""
    totals = (
        in_window(history, as_of, days, fleet_id)
        .groupBy("vehicle_id", "fleet_id")
        .agg(
            F.sum("idling_seconds").alias("duration_seconds"),
            F.sum("estimated_fuel_l").alias("estimated_fuel_l"),
            F.sum("estimated_cost").alias("estimated_cost"),
        )
        .where(F.col("duration_seconds") > 0)
    )
    return totals.orderBy(F.desc("duration_seconds"), "vehicle_id", "fleet_id").limit(TOP_IDLERS)


def idling_assumptions(settings: DetectorSettings) -> dict:
    """What the idling figures rest on; shown next to the report (A1)."""
    return {
        "idle_fuel_lph": settings.fuel_lph,
        "fuel_price_per_litre": settings.fuel_price,
        "currency": "INR",
        "scope": f"The {TOP_IDLERS} vehicles with most idle time between readings close in time; only those with a fuel level burn any.",
    }


def idling_waste(report: DataFrame) -> DataFrame:
    """Estimated cost over the reported vehicles (A10)."""
    return report.agg(F.coalesce(F.sum("estimated_cost"), F.lit(0.0)).alias("estimated_waste"))


def events_per_minute(
    history: DataFrame,
    as_of,
    days: int = 1,
    fleet_id: str | None = None,
    time: str = "timestamp",
) -> DataFrame:
    """Readings and mean speed per minute and scenario, newest 240 groups."""
    groups = (
        in_window(history, as_of, days, fleet_id, time)
        .groupBy(F.date_trunc("minute", time).alias("minute"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.avg("speed_kmh").alias("average_speed_kmh"))
    )
    return groups.orderBy(F.desc("minute"), "event_type").limit(ACTIVITY_GROUPS)


def activity_rollup(per_minute: DataFrame) -> DataFrame:
    """Totals of the reported groups by scenario and by minute, in one pass."""
    return (
        per_minute.groupingSets(
            [[F.col("event_type")], [F.col("minute")]], F.col("event_type"), F.col("minute")
        )
        .agg(F.sum("events").alias("events"), F.grouping("minute").alias("_by_type"))
        .select(
            F.when(F.col("_by_type") == 1, "event_type").otherwise("minute").alias("axis"),
            "event_type",
            "minute",
            "events",
        )
    )


def activity_top(rollup: DataFrame, types: int = 5, minutes: int = 20) -> DataFrame:
    """The most frequent scenarios and the latest minutes of the rollup."""
    top = (
        rollup.where("axis = 'event_type'").orderBy(F.desc("events"), "event_type").limit(types)
    )
    recent = rollup.where("axis = 'minute'").orderBy(F.desc("minute")).limit(minutes)
    return top.unionByName(recent)


def fault_counts(
    alerts: DataFrame, as_of, days: int = 7, fleet_id: str | None = None
) -> DataFrame:
    """Incidents per kind, most frequent first (A3)."""
    rows = in_window(alerts, as_of, days, fleet_id)
    counts = rows.groupBy("type").agg(F.count(F.lit(1)).alias("incidents"))
    return counts.orderBy(F.desc("incidents"), "type")


def vehicle_history(
    history: DataFrame, vehicle_id: str, as_of, days: int = 1, limit: int = 100
) -> DataFrame:
    """The newest readings of one vehicle (T1). Equality on the id reaches the scan."""
    check_between("limit", limit, 1, 1000)
    rows = in_window(history, as_of, days).where(F.col("vehicle_id") == check_vehicle(vehicle_id))
    newest = rows.orderBy(F.desc("timestamp"), "event_id").limit(limit)
    return newest.select(utc_text(F.col("timestamp")).alias("timestamp"), *HISTORY_COLUMNS)


def readings_of(history: DataFrame, vehicle_ids: list[str]) -> DataFrame:
    """Readings of a few vehicles."""
    ids = distinct_ids(vehicle_ids)
    check_between("number of vehicles", len(ids), 1, 8)
    return history.where(F.col("vehicle_id").isin([check_vehicle(v) for v in ids]))


def fleet_summary(
    registry: DataFrame, latest: DataFrame, as_of, reports: DataFrame | None = None
) -> DataFrame:
    """Registered, online, idling, active alerts, and the consumption rate if fresh (A5).

    `reports` holds the processor's (ts, consumed_per_sec); a stale one counts as no rate.
    """
    registered = registry.agg(F.count(F.lit(1)).alias("registered_vehicles"))
    live = presence_index(latest, as_of).agg(
        F.count_if("online").alias("online_vehicles"),
        F.count_if("idling").alias("currently_idling"),
        F.coalesce(F.sum("active_alerts"), F.lit(0)).alias("active_alerts"),
    )
    columns = [*registered.columns, *live.columns]
    parts = [registered, live]
    if reports is not None:
        fresh = F.col("_last.ts") > minus_seconds(moment(as_of), REPORT_FRESH_SECONDS)
        parts.append(
            reports.agg(F.max(F.struct("ts", "consumed_per_sec")).alias("_last")).select(
                F.coalesce(
                    F.when(fresh, F.round("_last.consumed_per_sec", 1)), F.lit(0.0)
                ).alias("events_per_sec"),
                F.coalesce(fresh, F.lit(False)).cast("long").alias("_reporting"),
            )
        )
        columns += ["events_per_sec", "_reporting"]
    summary = sum_of_parts(parts, columns)
    if reports is None:
        return summary
    return summary.withColumn("processor_reporting", F.col("_reporting") > 0).drop("_reporting")
