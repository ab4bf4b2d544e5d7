"""Every operator as a query over the given tables; see `oracle.py` for the matching SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions.ids import incident_id
from fleetspark.functions.times import month_of
from fleetspark.operators import detect as d
from fleetspark.operators import metrics, registry, state, tables, validate
from fleetspark.operators.dedup import dedup_first, drop_seen
from fleetspark.operators.outcomes import batch_outcomes, event_latency, partition_lag
from fleetspark.plans import paging, reports, snapshot
from fleetspark.settings import SampleScope, StreamOptions
from fleetspark.sources import archive, jsonl
from fleetspark.sources.paths import deliver, landed, shared_dir
from fleetspark.streaming import live, raw
from fleetspark.streaming.sources import FileSource, read_telemetry_stream
from fleetspark.workload import mapping as m

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Compressed readings end within minutes of midnight; original times span January.
AS_OF = datetime(2024, 1, 1, 0, 4, 20, tzinfo=timezone.utc)
MONTH_END = datetime(2024, 1, 31, tzinfo=timezone.utc)
MID_MONTH = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def micros(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def six(column: Column | str) -> Column:
    return F.round(column, 6)


def joined(column: Column | str) -> Column:
    return F.array_join(column, ",")


def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = m.arrivals(spark, sf_dir)
    return d.detect(dedup_first(once), counted=once)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.enrich(detected(spark, sf_dir))


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings at their original times, for reports by minute and day."""
    rows = m.readings(spark, sf_dir)
    return rows.withColumn("timestamp", F.col("observed_at"))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_state(detected(spark, sf_dir), AS_OF)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/fleetspark/{name}-{uuid.uuid4().hex}"


def alert_view(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "alert_id",
        "event_id",
        "vehicle_id",
        "fleet_id",
        "type",
        micros("timestamp").alias("event_time"),
        micros("start_timestamp").alias("started_at"),
        six("duration_seconds").alias("duration_seconds"),
        six("estimated_fuel_l").alias("estimated_fuel_l"),
        six("estimated_cost").alias("estimated_cost"),
        "detail",
    )


# --- detection ---------------------------------------------------------------------------------


@query
def idling_report(spark, sf_dir):
    rows = reports.idling_report(history(spark, sf_dir), AS_OF, 7)
    return rows.select(
        "vehicle_id",
        "fleet_id",
        six("duration_seconds").alias("duration_seconds"),
        six("estimated_fuel_l").alias("estimated_fuel_l"),
        six("estimated_cost").alias("estimated_cost"),
    )


@query
def idling_waste(spark, sf_dir):
    rows = reports.idling_waste(reports.idling_report(history(spark, sf_dir), AS_OF, 7))
    return rows.select(six("estimated_waste").alias("estimated_waste"))


@query
def enriched_history(spark, sf_dir):
    return history(spark, sf_dir).select(
        "event_id",
        "vehicle_id",
        micros("timestamp").alias("event_time"),
        "late",
        six("idling_seconds").alias("idling_seconds"),
        six("estimated_fuel_l").alias("estimated_fuel_l"),
        six("estimated_cost").alias("estimated_cost"),
        joined("detected_types").alias("detected_types"),
    )


@query
def first_arrivals(spark, sf_dir):
    return dedup_first(m.arrivals(spark, sf_dir)).select("event_id", "partition", "offset")


@query
def late_flags(spark, sf_dir):
    return d.flag_late(m.readings(spark, sf_dir)).select("event_id", "late")


@query
def previous_readings(spark, sf_dir):
    rows = d.with_previous(m.readings(spark, sf_dir)).where(~F.col("late"))
    return rows.select(
        "event_id",
        micros("previous.timestamp").alias("previous_at"),
        F.col("previous.seq").alias("previous_seq"),
        "dt",
        "continuous",
    )


@query
def idle_intervals(spark, sf_dir):
    rows = d.idle_intervals(d.with_previous(m.readings(spark, sf_dir)))
    return rows.select("event_id", "idle", "in_run", "idling_seconds")


@query
def idle_runs(spark, sf_dir):
    return detected(spark, sf_dir).where("idle").select(
        "event_id",
        micros("idle_start").alias("idle_start"),
        six("idle_duration_seconds").alias("idle_duration_seconds"),
    )


@query
def fuel_estimates(spark, sf_dir):
    rows = d.fuel_estimate(d.idle_intervals(d.with_previous(m.readings(spark, sf_dir))))
    return (
        rows.groupBy("vehicle_id")
        .agg(F.sum("estimated_fuel_l").alias("litres"), F.sum("estimated_cost").alias("cost"))
        .select("vehicle_id", six("litres").alias("litres"), six("cost").alias("cost"))
    )


@query
def accelerations(spark, sf_dir):
    rows = d.acceleration(d.with_previous(m.readings(spark, sf_dir)))
    return rows.where(~F.col("late")).select(
        "event_id", six("acceleration_mps2").alias("acceleration_mps2")
    )


@query
def detected_types(spark, sf_dir):
    kinds = detected(spark, sf_dir).select(F.explode("detected_types").alias("type"), "vehicle_id")
    return kinds.groupBy("type").agg(
        F.count(F.lit(1)).alias("readings"), F.count_distinct("vehicle_id").alias("vehicles")
    )


@query
def open_incidents(spark, sf_dir):
    return alert_view(d.open_incidents(detected(spark, sf_dir)))


@query
def active_episodes(spark, sf_dir):
    return alert_view(d.active_episodes(detected(spark, sf_dir)))


@query
def incident_ids(spark, sf_dir):
    return m.readings(spark, sf_dir).select(
        "event_id", incident_id(F.col("event_id"), F.lit("SPEEDING")).alias("alert_id")
    )


@query
def fault_counts(spark, sf_dir):
    return reports.fault_counts(d.open_incidents(detected(spark, sf_dir)), AS_OF, 7)


# --- latest state ------------------------------------------------------------------------------


@query
def latest_state(spark, sf_dir):
    ids = F.transform(F.col("active_alerts"), lambda a: F.concat_ws("=", a["type"], a["alert_id"]))
    return latest(spark, sf_dir).select(
        "vehicle_id",
        "event_id",
        micros("timestamp").alias("event_time"),
        "speed_kmh",
        "status",
        micros("idle_start").alias("idle_start"),
        six("idle_duration_seconds").alias("idle_duration_seconds"),
        joined(ids).alias("alerts"),
    )


@query
def vehicle_status(spark, sf_dir):
    rows = state.vehicle_status(latest(spark, sf_dir), AS_OF)
    return rows.select("vehicle_id", "status", micros("timestamp").alias("event_time"))


@query
def presence_index(spark, sf_dir):
    rows = state.presence_index(latest(spark, sf_dir), AS_OF)
    return rows.withColumn("timestamp", micros("timestamp")).withColumn(
        "active_alerts", F.col("active_alerts").cast("long")
    )


@query
def active_alerts(spark, sf_dir):
    return alert_view(state.active_alerts(latest(spark, sf_dir), AS_OF, limit=50, offset=10))


@query
def active_alert_count(spark, sf_dir):
    return state.active_alert_count(latest(spark, sf_dir), AS_OF)


@query
def vehicle_page(spark, sf_dir):
    rows = state.vehicle_page(
        m.registry(spark, sf_dir), latest(spark, sf_dir), limit=100, offset=100
    )
    return rows.select(
        "vehicle_id",
        "fleet_id",
        "oem",
        "live.status",
        F.col("live.event_id").alias("live_event_id"),
        F.size("live.active_alerts").cast("long").alias("alerts"),
    )


def _summary(spark: SparkSession, sf_dir: str, as_of: datetime) -> DataFrame:
    """Reports at their times, compressed like those of readings; the newest one counts."""
    rate = metrics.counter_rate(samples(spark, sf_dir), "consumed")
    at = F.expr(f"timestamp_micros({m.START_MICROS} + (unix_micros(ts) - {m.START_MICROS}) div 10000)")
    rate = rate.select(at.alias("ts"), F.col("rate").alias("consumed_per_sec"))
    return reports.fleet_summary(m.registry(spark, sf_dir), latest(spark, sf_dir), as_of, rate)


@query
def fleet_summary(spark, sf_dir):
    return _summary(spark, sf_dir, AS_OF)


@query
def fleet_summary_stale(spark, sf_dir):
    """The same a quarter of a minute later, when the newest report no longer counts."""
    return _summary(spark, sf_dir, AS_OF + timedelta(seconds=15))


# --- reports on original times -----------------------------------------------------------------


@query
def events_per_minute(spark, sf_dir):
    rows = reports.events_per_minute(observed(spark, sf_dir), MONTH_END, 30)
    return rows.select(
        micros("minute").alias("minute"),
        "event_type",
        "events",
        six("average_speed_kmh").alias("average_speed_kmh"),
    )


@query
def activity_rollup(spark, sf_dir):
    rows = reports.activity_rollup(reports.events_per_minute(observed(spark, sf_dir), MONTH_END, 30))
    return rows.withColumn("minute", micros("minute"))


@query
def activity_top(spark, sf_dir):
    rows = reports.activity_top(
        reports.activity_rollup(reports.events_per_minute(observed(spark, sf_dir), MONTH_END, 30))
    )
    return rows.withColumn("minute", micros("minute"))


@query
def vehicle_history(spark, sf_dir):
    return reports.vehicle_history(observed(spark, sf_dir), "V000007", MONTH_END, 30, 100)


@query
def readings_of_vehicles(spark, sf_dir):
    rows = reports.readings_of(observed(spark, sf_dir), ["V000007", "V000003", "V000007"])
    return rows.select("event_id", "vehicle_id", "speed_kmh")


@query
def fleet_window(spark, sf_dir):
    rows = tables.in_window(observed(spark, sf_dir), MONTH_END, 10, "F004")
    return rows.select("event_id", "vehicle_id", micros("timestamp").alias("event_time"))


@query
def newest_event_latency(spark, sf_dir):
    newest = event_latency(m.readings(spark, sf_dir), AS_OF)
    return newest.select(six("event_latency_ms").alias("event_latency_ms"))


@query
def retained_readings(spark, sf_dir):
    kept = tables.apply_retention(observed(spark, sf_dir), datetime(2024, 2, 10), 30)
    return kept.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("readings"))


@query
def bucketed_idling(spark, sf_dir):
    """Idling and readings by vehicle from a history in buckets, which needs no exchange."""
    name = f"history_{uuid.uuid4().hex}"
    stored = tables.write_bucketed(history(spark, sf_dir), f"{scratch(spark, 'bucketed')}/telemetry", name, buckets=16)
    return stored.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("readings"), six(F.sum("idling_seconds")).alias("idling_seconds")
    )


@query
def dropped_months(spark, sf_dir):
    """Rows by month left of a stored history after its expired months were deleted."""
    root = scratch(spark, "expired")
    rows = history(spark, sf_dir)
    old = F.timestamp_micros(F.unix_micros("timestamp") - (F.col("seq") % 4) * 31 * 86_400_000_000)
    tables.write_history(rows.withColumn("timestamp", old), root, "telemetry", 0)
    tables.drop_expired_months(spark, root, "telemetry", MID_MONTH)
    stored = tables.read_history(spark, root, "telemetry")
    return stored.groupBy("month").agg(F.count(F.lit(1)).alias("readings"))


# --- registry ----------------------------------------------------------------------------------


@query
def registry_quality(spark, sf_dir):
    return registry.registry_quality(m.registry(spark, sf_dir))


@query
def registry_scan(spark, sf_dir):
    return registry.registry_scan(m.registry(spark, sf_dir), "F003")


@query
def registry_page(spark, sf_dir):
    return registry.registry_page(m.registry(spark, sf_dir), 100, 50, "F003")


@query
def registry_third_page(spark, sf_dir):
    """Pages by key: each starts behind the last key of the one before it."""
    rows, after = registry.registry_scan(m.registry(spark, sf_dir), "F003"), None
    for _ in range(2):
        keys = paging.page_after(rows, ["vehicle_id"], 15, after).select("vehicle_id")
        after = tuple(keys.agg(F.max("vehicle_id")).first())
    return paging.page_after(rows, ["vehicle_id"], 15, after)


@query
def registry_total(spark, sf_dir):
    return registry.registry_total(m.registry(spark, sf_dir), "F003")


@query
def vehicle_lookup(spark, sf_dir):
    return registry.vehicle(m.registry(spark, sf_dir), "V000042")


@query
def upsert_absent(spark, sf_dir):
    """Customers with orders are registered; every customer is offered again with another oem."""
    every = m.registry(spark, sf_dir)
    ordered = m.table(spark, sf_dir, "orders").select(
        m.numbered("V", F.col("o_custkey"), 6).alias("vehicle_id")
    )
    existing = every.join(ordered.distinct(), "vehicle_id", "left_semi").select(*every.columns)
    incoming = every.withColumn("oem", F.lit("OFFERED"))
    return registry.upsert_absent(existing, incoming, ["vehicle_id"]).select("vehicle_id", "oem")


@query
def registry_csv(spark, sf_dir):
    """The registry written as CSV, then loaded through the exact-count gate."""
    path = scratch(spark, "registry")
    every = m.registry(spark, sf_dir)
    every.write.mode("overwrite").csv(path, header=True)
    return registry.load_registry(spark, path, every.count())


@query
def known_vehicles(spark, sf_dir):
    return registry.known_vehicles(m.readings(spark, sf_dir), m.registry(spark, sf_dir)).select(
        "event_id", "vehicle_id"
    )


@query
def unknown_vehicles(spark, sf_dir):
    """Vehicles of orders' part keys that no customer number covers."""
    parts = m.table(spark, sf_dir, "lineitem").select(
        m.numbered("V", F.col("l_orderkey"), 6).alias("vehicle_id")
    )
    return registry.unknown_vehicles(parts, m.registry(spark, sf_dir))


@query
def fleet_orphans(spark, sf_dir):
    """Vehicles whose fleet is not among the fleets of the first region."""
    some = m.fleets(spark, sf_dir).join(
        m.table(spark, sf_dir, "nation").where("n_regionkey = 0").select(F.col("n_name").alias("name")),
        "name",
        "left_semi",
    )
    return registry.fleet_orphans(m.registry(spark, sf_dir), some)


# --- validation --------------------------------------------------------------------------------


@query
def parse_telemetry(spark, sf_dir):
    rows = validate.parse_telemetry(m.records(spark, sf_dir))
    return rows.select(
        "partition",
        "offset",
        "valid",
        "event_id",
        "vehicle_id",
        micros("timestamp").alias("event_time"),
        "seq",
        "speed_kmh",
        "engine_on",
        "fuel_pct",
        "soc_pct",
        joined("dtc").alias("dtc"),
        "event_type",
    )


@query
def validation_errors(spark, sf_dir):
    return validate.validation_errors(m.records(spark, sf_dir)).select(
        "partition", "offset", "validation_error"
    )


@query
def future_readings(spark, sf_dir):
    """The live future check, half a minute around the middle of the data."""
    rows = validate.parse_telemetry(m.records(spark, sf_dir), datetime(2024, 1, 1, 0, 2))
    return rows.groupBy("validation_error").agg(F.count(F.lit(1)).alias("records"))


@query
def dead_letters(spark, sf_dir):
    rows = validate.dead_letters(m.records(spark, sf_dir))
    return rows.groupBy("validation_error").agg(
        F.count(F.lit(1)).alias("records"), F.sum("timestamp_ms").alias("received_ms")
    )


@query
def archive_rows(spark, sf_dir):
    rows = validate.to_archive_rows(m.records(spark, sf_dir), AS_OF)
    return rows.select(
        "source_partition",
        "source_offset",
        F.unix_millis("received_at").alias("received_ms"),
        F.date_format("received_day", "yyyy-MM-dd").alias("received_day"),
        "valid",
        "validation_error",
        "event_id",
    )


@query
def record_outcomes(spark, sf_dir):
    parsed = landed(validate.parse_telemetry(m.records(spark, sf_dir)), "parsed")
    return batch_outcomes(parsed)


@query
def partition_backlog(spark, sf_dir):
    """Per source partition: offsets seen against the offset of the last duplicate."""
    rows = m.arrivals(spark, sf_dir)
    offsets = rows.groupBy("partition").agg(
        (F.max("offset") + 1).alias("high"),
        F.max(F.when(F.col("seq") % 50 == 0, F.col("offset"))).alias("committed"),
    )
    return partition_lag(offsets)


@query
def unseen_readings(spark, sf_dir):
    """Second half of the arrivals against the ids accepted in the first half."""
    rows = m.arrivals(spark, sf_dir)
    early = rows.where(F.col("observed_at") < F.lit(MID_MONTH))
    return drop_seen(rows, early).select("event_id", "partition", "offset")


# --- stored tables -----------------------------------------------------------------------------


@query
def final_rows(spark, sf_dir):
    """Readings stored once per arrival: the write with the highest offset is the final one."""
    rows = m.arrivals(spark, sf_dir)
    final = tables.read_final(rows, tables.TELEMETRY_KEYS, order="offset")
    return final.select("event_id", "offset")


@query
def stored_history(spark, sf_dir):
    """History written in two batches that overlap, read as final rows."""
    root = scratch(spark, "history")
    rows = observed(spark, sf_dir).withColumns(
        {
            "idling_seconds": F.lit(0.0),
            "estimated_fuel_l": F.lit(0.0),
            "estimated_cost": F.lit(0.0),
            "detected_types": F.array().cast("array<string>"),
            "late": F.lit(False),
        }
    )
    tables.write_history(rows, root, "telemetry", 0)
    again = rows.where(F.col("timestamp") >= F.lit(MID_MONTH)).withColumn("late", F.lit(True))
    tables.write_history(again, root, "telemetry", 1)
    final = tables.read_final(tables.read_history(spark, root, "telemetry"), tables.TELEMETRY_KEYS)
    return final.select("event_id", "late", "month")


@query
def compacted_history(spark, sf_dir):
    """The same after both batches of the month were folded; rows stored and rows left by the
    replacing read are counted apart and must agree."""
    root = scratch(spark, "compacted")
    alerts = d.open_incidents(detected(spark, sf_dir))
    tables.write_history(alerts, root, "alerts", 0)
    tables.write_history(alerts.withColumn("detail", F.lit("again")), root, "alerts", 1)
    tables.compact_month(spark, root, "alerts", 202401, 1)
    stored = tables.read_history(spark, root, "alerts")
    final = tables.read_final(stored, tables.ALERT_KEYS)
    by = ["type", "detail"]
    return (
        final.groupBy(by)
        .agg(F.count(F.lit(1)).alias("incidents"))
        .join(stored.groupBy(by).agg(F.count(F.lit(1)).alias("stored_rows")), by, "full")
    )


@query
def clustered_readings(spark, sf_dir):
    """Vehicle lookup on a table laid out for it."""
    path = scratch(spark, "clustered")
    rows = tables.cluster_by_vehicle(observed(spark, sf_dir))
    tables.write_partitioned(
        rows.withColumn("month", month_of(F.col("timestamp"))), path, ["month"]
    )
    return spark.read.parquet(path).where("vehicle_id = 'V000011'").select("event_id", "month")


@query
def json_lines(spark, sf_dir):
    """Readings out to JSON lines and back through validation."""
    path = scratch(spark, "lines")
    jsonl.write_json_lines(m.readings(spark, sf_dir), path)
    parsed = validate.parse_telemetry(jsonl.read_json_lines(spark, path))
    return parsed.select("event_id", "valid", micros("timestamp").alias("event_time"), "seq", "lat")


# --- sample ------------------------------------------------------------------------------------

SCOPE = SampleScope(window_minutes=1440, vehicle_limit=100, row_limit=20_000)


@query
def recent_snapshot(spark, sf_dir):
    rows = snapshot.recent_snapshot(observed(spark, sf_dir), MID_MONTH, SCOPE)
    return rows.withColumn("timestamp", micros("timestamp"))


@query
def scoped_snapshot(spark, sf_dir):
    rows = snapshot.recent_snapshot(observed(spark, sf_dir), MID_MONTH, SCOPE)
    return snapshot.with_scope(rows, MID_MONTH, SCOPE).withColumn("timestamp", micros("timestamp"))


@query
def recent_sample(spark, sf_dir):
    """Published, read back, and asked about eight vehicles."""
    path = scratch(spark, "sample")
    snapshot.refresh_snapshot(m.readings(spark, sf_dir), path, AS_OF, SCOPE)
    ids = [f"V{i:06d}" for i in range(1, 9)]
    rows = snapshot.recent_sample(snapshot.read_snapshot(spark, path), ids, 3, AS_OF)
    return rows.withColumns(
        {
            "average_speed_kmh": six("average_speed_kmh"),
            "first_seen": micros("first_seen"),
            "last_seen": micros("last_seen"),
        }
    )


@query
def sample_view(spark, sf_dir):
    """The published sample as a view, asked in SQL."""
    path = scratch(spark, "sample")
    snapshot.refresh_snapshot(m.readings(spark, sf_dir), path, AS_OF, SCOPE)
    snapshot.snapshot_view(spark, path, "recent_telemetry")
    return spark.sql(
        "SELECT fleet_id, count(*) AS readings, round(max(speed_kmh), 6) AS top_speed_kmh "
        "FROM recent_telemetry WHERE event_id <> '' GROUP BY fleet_id"
    )


@query
def reconciled_sample(spark, sf_dir):
    rows = observed(spark, sf_dir)
    sample = snapshot.recent_snapshot(rows, MID_MONTH, SCOPE)
    return snapshot.reconcile(sample, rows, "event_id")


@query
def differing_rows(spark, sf_dir):
    """Arrivals against unique readings: the second arrivals differ."""
    sent = m.arrivals(spark, sf_dir).select("event_id", "vehicle_id")
    once = m.readings(spark, sf_dir).select("event_id", "vehicle_id")
    return snapshot.differing_rows(sent, once)


@query
def lookup_forms_agree(spark, sf_dir):
    """Rows that the prunable and the substring form of a vehicle lookup find, and how many differ."""
    rows = m.readings(spark, sf_dir).select("event_id", "vehicle_id", "speed_kmh")
    by_key = rows.where(F.col("vehicle_id") == "V000007")
    by_text = rows.where(F.expr("substring(vehicle_id, 2)") == "000007")
    counted = {"key": by_key, "text": by_text, "differing": snapshot.differing_rows(by_key, by_text)}
    found = [
        df.agg(F.count(F.lit(1)).alias("found")).select(F.lit(form).alias("form"), "found")
        for form, df in counted.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def bounded_fleets(spark, sf_dir):
    return paging.bounded(m.fleets(spark, sf_dir))


# --- archive -----------------------------------------------------------------------------------

def _archived(spark: SparkSession, sf_dir: str) -> tuple[str, list[int]]:
    """Records of the first half, then all records: the second append skips the first half.

    Also the newest snapshot after either.
    """
    root = scratch(spark, "archive")
    records = landed(m.records(spark, sf_dir).drop("source_seq"), "records")
    facts = records.groupBy("partition").agg(((F.max("offset") + 1) / 2).alias("half"))
    first = (
        records.join(F.broadcast(facts), "partition")
        .where(F.col("offset") < F.col("half"))
        .select(*records.columns)
    )
    newest = [archive.append_archive(part, root, m.TOPIC, AS_OF)["snapshot_id"] for part in (first, records)]
    return root, newest


@query
def archive_status(spark, sf_dir):
    return archive.archive_status(spark, _archived(spark, sf_dir)[0])


@query
def archive_time_travel(spark, sf_dir):
    root, newest = _archived(spark, sf_dir)
    counts = [
        archive.read_archive(spark, root, snapshot_id)
        .groupBy("valid")
        .agg(F.count(F.lit(1)).alias("records"))
        .select(F.lit(append).cast("long").alias("snapshot"), "valid", "records")
        for append, snapshot_id in enumerate(newest, 1)
    ]
    return counts[0].unionByName(counts[1])


@query
def archive_snapshots(spark, sf_dir):
    """The snapshot list: records and commit time after each of the two appends."""
    root, newest = _archived(spark, sf_dir)
    rows = archive.archive_snapshots(spark, root).where(F.col("snapshot").isin(newest))
    return rows.select(
        F.when(F.col("snapshot") == newest[0], 1).otherwise(2).cast("long").alias("append"),
        "records",
        micros("committed_at").alias("committed_at"),
    )


@query
def archive_flushes(spark, sf_dir):
    """One append under a byte limit of a sixteenth of its payload: every record, many snapshots.

    A flush is full when the first run of records of the next one would not fit.
    """
    root = scratch(spark, "flushes")
    records = landed(m.records(spark, sf_dir).drop("source_seq"), "records")
    limit = records.agg(F.expr("max(octet_length(value)) + sum(octet_length(value)) div 16")).first()[0]
    archive.append_archive(records, root, m.TOPIC, AS_OF, options=StreamOptions(bytes=limit))
    flushes = archive.read_archive(spark, root).groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.octet_length("raw_payload")).alias("bytes")
    )
    return flushes.agg(
        F.sum("records").alias("records"),
        (F.max("bytes") <= limit).alias("within_limit"),
        F.count(F.lit(1)).between(12, 40).alias("many"),
    )


@query
def archive_lookup(spark, sf_dir):
    rows = archive.query_archive(
        archive.read_archive(spark, _archived(spark, sf_dir)[0]),
        "V000005",
        "2024-01-01T00:01:00+00:00",
        "2024-01-01T00:03:00+00:00",
        1000,
    )
    return rows.select("event_id", "source_partition", "source_offset", "speed_kmh")


@query
def archive_resume(spark, sf_dir):
    """Where an archive of the first half of each partition goes on, and a source that has all."""
    root = scratch(spark, "resume")
    records = landed(m.records(spark, sf_dir).drop("source_seq"), "records")
    retained = landed(
        records.groupBy("partition").agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")), "retained"
    )
    first = records.join(F.broadcast(retained), "partition").where("2 * offset < high").select(*records.columns)
    archive.append_archive(first, root, m.TOPIC, AS_OF)
    return archive.resume_offsets(spark, root, retained)


@query
def unreplayed_records(spark, sf_dir):
    """Records past the checkpoint when half of each partition was archived."""
    records = m.records(spark, sf_dir)
    saved = records.groupBy("partition").agg(
        F.expr("(max(offset) + 1) div 2").alias("next_offset")
    )
    return archive.skip_replayed(records, saved).select("partition", "offset")


@query
def starting_offsets(spark, sf_dir):
    rows = m.arrivals(spark, sf_dir).groupBy("partition").agg(
        F.min("offset").alias("low"),
        (F.max("offset") + 1).alias("high"),
        F.max(F.when(F.col("partition") > 2, F.col("offset"))).alias("saved"),
    )
    return archive.check_offset_range(rows)


# --- counters ----------------------------------------------------------------------------------


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter reports: each event type is a source whose counters restart every 2,000 events."""
    e = m.table(spark, sf_dir, "events")
    run = (F.col("event_id") % 2000).cast("double")
    values = {"consumed": run, "seconds_sum": run * run / 1000.0, "seconds_count": run}
    pairs = F.array(
        *[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in values.items()]
    )
    return e.select(
        F.col("event_type").alias("source"),
        F.concat(F.lit("i"), F.expr("event_id div 2000").cast("string")).alias("instance_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_id") % 11 != 0).alias("running"),
        F.inline(pairs),
    )


@query
def counter_rates(spark, sf_dir):
    rows = metrics.counter_rate(samples(spark, sf_dir), "consumed")
    return rows.select("source", micros("ts").alias("ts"), six("rate").alias("rate"))


@query
def mean_durations(spark, sf_dir):
    rows = metrics.mean_duration(
        samples(spark, sf_dir), "seconds_sum", "seconds_count", ["source"]
    )
    return rows.select("source", micros("ts").alias("ts"), six("mean_duration").alias("mean_duration"))


@query
def label_totals(spark, sf_dir):
    return metrics.label_totals(
        samples(spark, sf_dir), "consumed", ["source", "instance_id"], ["source"]
    )


@query
def fresh_reports(spark, sf_dir):
    rows = metrics.fresh_reports(samples(spark, sf_dir), MID_MONTH, max_age=86_400.0)
    return rows.select("source", "instance_id", "metric", "value")


@query
def heartbeats(spark, sf_dir):
    rows = metrics.heartbeats(samples(spark, sf_dir), MONTH_END, max_age=7200.0)
    return rows.withColumn("heartbeat_age_seconds", six("heartbeat_age_seconds"))


@query
def progress_check(spark, sf_dir):
    return metrics.progress_check(samples(spark, sf_dir), "consumed", MONTH_END, max_age=3600.0)


# --- streams -----------------------------------------------------------------------------------


def fed(spark: SparkSession, sf_dir: str, batches: int) -> Iterator[FileSource]:
    """Records as files in arrival order, one more range of offsets before each yield.

    As on a topic, a source partition's records of a range lie in one file, in offset order; each
    file is written by a task of its own. There are `batches` ranges, or more where one would hold
    more records than a batch of a stream. All files are written at once, aside; those of a range
    are delivered when it is its turn.
    """
    path, ready = scratch(spark, "records"), scratch(spark, "ready")
    facts = m.places(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"), F.max("_place").alias("last")).first()
    ranges = max(batches, -(-facts["rows"] // StreamOptions().rows))
    size = (facts["last"] or 0) // ranges + 1
    records = m.records_in_ranges(spark, sf_dir, ranges, size).drop("source_seq")
    records.write.partitionBy("range", "partition").parquet(ready)
    at = 0
    for i in range(ranges):
        at = deliver(spark, f"{ready}/range={i}", path, f"range-{i:05d}", after=at)
        yield FileSource(path, m.PARTITIONS)


def record_source(spark: SparkSession, sf_dir: str, batches: int) -> FileSource:
    """All records as files."""
    return list(fed(spark, sf_dir, batches))[-1]


@contextmanager
def partitions_for_cores(spark: SparkSession):
    """At most two shuffle (and so state) partitions per core while a stream is started.

    A stream keeps the number it started with; on a cluster the session's own setting is lower.
    """
    name = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(name)
    spark.conf.set(name, str(min(int(configured), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, configured)


def _drained(spark: SparkSession, source: FileSource, root: str) -> str:
    live.start_live(
        read_telemetry_stream(spark, source),
        f"{root}/tables",
        f"{root}/checkpoint",
        # State is an hour old at most by this clock, however long the batches take.
        clock=lambda: MID_MONTH,
        drain=True,
    ).awaitTermination()
    return f"{root}/tables"


def _live(spark: SparkSession, sf_dir: str, batches: int = 3) -> str:
    return _drained(spark, record_source(spark, sf_dir, batches), scratch(spark, "live"))


@query
def live_history(spark, sf_dir):
    """History of the live job over three micro-batches."""
    rows = tables.read_history(spark, _live(spark, sf_dir), "telemetry")
    return rows.select(
        "event_id",
        "late",
        six("idling_seconds").alias("idling_seconds"),
        joined("detected_types").alias("detected_types"),
    )


@query
def live_incidents(spark, sf_dir):
    return alert_view(tables.read_history(spark, _live(spark, sf_dir), "alerts"))


@query
def live_state(spark, sf_dir):
    rows = live.read_state(spark, _live(spark, sf_dir))
    ids = F.transform(F.col("active_alerts"), lambda a: F.concat_ws("=", a["type"], a["alert_id"]))
    return rows.select("vehicle_id", "event_id", "status", joined(ids).alias("alerts"))


@query
def live_outcomes(spark, sf_dir):
    """What became of all records of a job that was started anew for each range of records."""
    root = scratch(spark, "live")
    for source in fed(spark, sf_dir, 2):
        root_of_tables = _drained(spark, source, root)
    return live.live_outcomes(spark, root_of_tables)


@query
def archive_stream(spark, sf_dir):
    root = scratch(spark, "raw")
    source = record_source(spark, sf_dir, 3)
    raw.start_archive(
        read_telemetry_stream(spark, source, fail_on_data_loss=True),
        f"{root}/archive",
        m.TOPIC,
        f"{root}/checkpoint",
        drain=True,
    ).awaitTermination()
    rows = archive.read_archive(spark, f"{root}/archive")
    return rows.select("source_partition", "source_offset", "valid", "validation_error")


@query
def activity_stream(spark, sf_dir):
    """Rolling activity of a stream of readings that come in order of time, after all were read."""
    root = scratch(spark, "activity")
    rows = landed(observed(spark, sf_dir).drop("observed_at"), "observed")
    at = F.unix_micros("timestamp")
    facts = rows.agg(F.count(F.lit(1)).alias("rows"), F.min(at).alias("first"), F.max(at).alias("last")).first()
    width = (facts["last"] - facts["first"]) // 3 + 1
    files = max(4, facts["rows"] // (3 * StreamOptions().rows))
    for i in range(3):
        start = facts["first"] + i * width
        part = rows.where(at.between(start, start + width - 1))
        part.repartition(files).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
    with partitions_for_cores(spark):
        raw.start_activity(
            stream, f"{root}/tables", f"{root}/checkpoint", lateness="1 hour", drain=True
        ).awaitTermination()
    return raw.read_activity(spark, f"{root}/tables").select(
        micros("minute").alias("minute"),
        "event_type",
        "events",
        six("average_speed_kmh").alias("average_speed_kmh"),
    )
