"""The same answers in SQL, written independently of the library, for checking."""

from __future__ import annotations

# Common table expressions; each builds on those before it.
CTES = {
    "shaped": """
        SELECT event_id AS n, user_id, event_type AS etype, ts AS observed_at, value,
               1704067200000000 + (epoch_us(ts) - 1704067200000000) // 10000 AS us,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS level
        FROM events""",
    "readings": """
        SELECT printf('00000000-0000-4000-8000-%012d', n) AS event_id,
               printf('V%06d', user_id) AS vehicle_id,
               printf('SYN%014d', user_id) AS vin,
               printf('F%03d', user_id % 25 + 1) AS fleet_id,
               us, n AS seq, observed_at, user_id,
               CAST(8 + user_id % 20 AS DOUBLE) AS lat, CAST(72 + user_id % 15 AS DOUBLE) AS lon,
               CASE WHEN ((us - 1704067200000000) // 40000000) % 3 = 0 THEN 0e0
                    ELSE least(value, 220e0) END AS speed_kmh,
               (etype <> 'signup' OR n % 2 = 0) AS engine_on,
               CASE WHEN user_id % 2 = 1 THEN level END AS fuel_pct,
               CASE WHEN user_id % 2 = 0 THEN level END AS soc_pct,
               level, etype = 'error' AS faulty,
               CASE etype WHEN 'error' THEN 'ENGINE_FAULT' WHEN 'click' THEN 'SPEEDING'
                    WHEN 'purchase' THEN 'LOW_ENERGY' WHEN 'signup' THEN 'IDLING'
                    ELSE 'NORMAL' END AS event_type,
               CAST(user_id % 6 AS INTEGER) AS part,
               4 * (n + CASE WHEN n % 7 = 0 THEN 400 ELSE 0 END)
                 + CASE WHEN n % 7 = 0 THEN 0 ELSE 1 END AS pos
        FROM shaped""",
    "arrivals": """
        SELECT * FROM readings
        UNION ALL
        SELECT * REPLACE (pos + 4002 AS pos) FROM readings WHERE seq % 50 = 0""",
    # Arrival order against the highest (time, seq) so far, packed into one number.
    "marked": """
        SELECT *, coalesce(us::HUGEINT * 1000000000 + seq <= max(us::HUGEINT * 1000000000 + seq)
                    OVER (PARTITION BY vehicle_id ORDER BY part, pos
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late
        FROM readings""",
    "pairs": """
        SELECT *, (us - p_us) / 1000000e0 AS dt FROM (
            SELECT *, lag(us) OVER w AS p_us, lag(seq) OVER w AS p_seq,
                   lag(speed_kmh) OVER w AS p_speed, lag(engine_on) OVER w AS p_engine
            FROM marked WHERE NOT late
            WINDOW w AS (PARTITION BY vehicle_id ORDER BY us, seq))""",
    "steps": """
        SELECT *, engine_on AND speed_kmh <= 0.5 AS idle,
               coalesce(dt > 0 AND dt <= 10, false) AS continuous,
               coalesce(dt > 0 AND dt <= 10 AND engine_on AND speed_kmh <= 0.5
                        AND p_engine AND p_speed <= 0.5, false) AS in_run
        FROM pairs""",
    "islands": """
        SELECT *, CASE WHEN in_run THEN dt ELSE 0e0 END AS idling_seconds,
               CASE WHEN continuous THEN (speed_kmh - p_speed) / 3.6e0 / dt ELSE 0e0 END AS accel,
               sum(CASE WHEN in_run THEN 0 ELSE 1 END)
                 OVER (PARTITION BY vehicle_id ORDER BY us, seq) AS island
        FROM steps""",
    "runs": """
        SELECT *, CASE WHEN idle THEN (us - run_us) / 1000000e0 ELSE 0e0 END AS run_seconds,
               CASE WHEN fuel_pct IS NULL THEN 0e0
                    ELSE idling_seconds / 3600e0 * 0.8e0 END AS litres
        FROM (SELECT *, CASE WHEN idle THEN min(us) OVER (PARTITION BY vehicle_id, island) END
                        AS run_us FROM islands)""",
    "flags": """
        SELECT *, idle AND run_seconds > 20 AS f1, speed_kmh > 100 AS f2, accel < -3 AS f3,
               accel > 3 AS f4, faulty AS f5, level < 10 AS f6
        FROM runs""",
    "opened": """
        SELECT *,
               f1 AND NOT (continuous AND coalesce(lag(f1) OVER w, false)) AS o1,
               f2 AND NOT (continuous AND coalesce(lag(f2) OVER w, false)) AS o2,
               f3 AND NOT (continuous AND coalesce(lag(f3) OVER w, false)) AS o3,
               f4 AND NOT (continuous AND coalesce(lag(f4) OVER w, false)) AS o4,
               f5 AND NOT (continuous AND coalesce(lag(f5) OVER w, false)) AS o5,
               f6 AND NOT (continuous AND coalesce(lag(f6) OVER w, false)) AS o6
        FROM flags WINDOW w AS (PARTITION BY vehicle_id ORDER BY us, seq)""",
    "kinds": """
        SELECT * FROM (VALUES (1, 'IDLING_ALERT'), (2, 'SPEEDING'), (3, 'HARSH_BRAKE'),
                              (4, 'HARSH_ACCELERATION'), (5, 'ENGINE_FAULT'),
                              (6, 'LOW_ENERGY')) AS t(rank, kind)""",
    # One row per reading and active kind, numbered by episode.
    "active": """
        SELECT * FROM (
            SELECT o.*, k.rank, k.kind,
                   CASE k.rank WHEN 1 THEN f1 WHEN 2 THEN f2 WHEN 3 THEN f3
                               WHEN 4 THEN f4 WHEN 5 THEN f5 ELSE f6 END AS is_on,
                   CASE k.rank WHEN 1 THEN o1 WHEN 2 THEN o2 WHEN 3 THEN o3
                               WHEN 4 THEN o4 WHEN 5 THEN o5 ELSE o6 END AS is_new
            FROM opened o, kinds k) WHERE is_on""",
    "episodes": """
        SELECT *, first_value(event_id) OVER e AS origin_event,
               first_value(CASE WHEN rank = 1 THEN run_us ELSE us END) OVER e AS origin_us
        FROM (SELECT *, sum(CASE WHEN is_new THEN 1 ELSE 0 END)
                        OVER (PARTITION BY vehicle_id, rank ORDER BY us, seq) AS episode
              FROM active)
        WINDOW e AS (PARTITION BY vehicle_id, rank, episode ORDER BY us, seq)""",
    "digests": """
        SELECT *, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8')
                       || encode(origin_event || ':' || kind)) AS h
        FROM episodes""",
    "alerts": """
        SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
                 || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')
                 || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS alert_id,
               event_id, vehicle_id, fleet_id, kind AS type,
               strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S.%f') AS event_time,
               strftime(make_timestamp(origin_us), '%Y-%m-%d %H:%M:%S.%f') AS started_at,
               round(CASE WHEN rank = 1 THEN run_seconds ELSE 0e0 END, 6) AS duration_seconds,
               round(CASE WHEN rank = 1 AND fuel_pct IS NOT NULL
                          THEN run_seconds / 3600e0 * 0.8e0 ELSE 0e0 END, 6) AS estimated_fuel_l,
               round(CASE WHEN rank = 1 AND fuel_pct IS NOT NULL
                          THEN run_seconds / 3600e0 * 0.8e0 * 100e0 ELSE 0e0 END, 6)
                 AS estimated_cost,
               CASE WHEN rank = 5 THEN 'P0301'
                    ELSE printf('acceleration_mps2=%.2f', accel) END AS detail,
               is_new, us, seq, rank
        FROM digests""",
    "newest": """
        SELECT * FROM opened
        QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY us DESC, seq DESC) = 1""",
    "state": """
        SELECT n.*, CASE WHEN idle THEN 'IDLING' WHEN speed_kmh > 0.5 THEN 'MOVING'
                         ELSE 'STOPPED' END AS status,
               coalesce(a.alerts, '') AS alerts, coalesce(a.n_alerts, 0) AS n_alerts
        FROM newest n LEFT JOIN (
            SELECT event_id, string_agg(type || '=' || alert_id, ',' ORDER BY rank) AS alerts,
                   count(*) AS n_alerts
            FROM alerts GROUP BY event_id) a USING (event_id)""",
    "registry": """
        SELECT printf('V%06d', c_custkey) AS vehicle_id,
               printf('SYN%014d', c_custkey) AS vin,
               printf('F%03d', c_nationkey + 1) AS fleet_id,
               c_mktsegment AS oem, c_name AS model,
               CASE WHEN c_custkey % 2 = 0 THEN 'EV' ELSE 'ICE' END AS fuel_type,
               CAST(2018 + c_custkey % 8 AS INTEGER) AS manufacture_year,
               'R' || CAST(c_custkey % 4 AS VARCHAR) AS home_region, abs(c_acctbal) AS odometer_km
        FROM customer""",
    "minutes": """
        SELECT date_trunc('minute', observed_at) AS minute, event_type, count(*) AS events,
               avg(speed_kmh) AS mean_speed
        FROM readings WHERE observed_at >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY ALL""",
    "top_minutes": """
        SELECT * FROM minutes ORDER BY minute DESC, event_type LIMIT 240""",
    # A record's fault follows from its number; two faults never meet.
    "records": """
        SELECT *, CASE seq % 97 WHEN 1 THEN 'json_invalid' WHEN 2 THEN 'unknown_field'
                  WHEN 3 THEN 'missing_field' WHEN 4 THEN 'out_of_range'
                  WHEN 5 THEN 'bad_timestamp' WHEN 6 THEN 'bad_pattern'
                  WHEN 7 THEN 'energy_choice' WHEN 8 THEN 'bad_dtc'
                  WHEN 9 THEN 'seq_out_of_range' WHEN 10 THEN 'wrong_type' END AS fault
        FROM arrivals""",
    "reports": """
        SELECT event_type AS source, 'i' || CAST(event_id // 2000 AS VARCHAR) AS instance_id, ts,
               event_id % 11 <> 0 AS running, CAST(event_id % 2000 AS DOUBLE) AS v
        FROM events""",
    "growth": """
        SELECT *, CASE WHEN v < p THEN v ELSE v - p END AS dv,
               CASE WHEN s < ps THEN s ELSE s - ps END AS ds,
               (epoch_us(ts) - epoch_us(pt)) / 1000000e0 AS secs
        FROM (SELECT *, v * v / 1000e0 AS s, lag(v) OVER w AS p,
                     lag(v * v / 1000e0) OVER w AS ps, lag(ts) OVER w AS pt
              FROM reports WINDOW w AS (PARTITION BY source ORDER BY ts))""",
    "sample": """
        SELECT * FROM readings
        WHERE vehicle_id BETWEEN 'V000001' AND 'V000100'
          AND observed_at BETWEEN TIMESTAMP '2024-01-14 12:00:00' AND TIMESTAMP '2024-01-15 12:00:00'
        ORDER BY observed_at DESC, event_id LIMIT 20000""",
}
_ORDER = list(CTES)

# A live run sees only sound payloads.
_LIVE = {"marked": CTES["marked"].replace("FROM readings", "FROM readings WHERE seq % 97 NOT BETWEEN 1 AND 10")}


def _with(select: str, last: str, **changed: str) -> str:
    chosen = _ORDER[: _ORDER.index(last) + 1]
    body = ",\n".join(f"{name} AS ({changed.get(name, CTES[name])})" for name in chosen)
    return f"WITH {body}\n{select}"


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _us(column: str) -> str:
    return _stamp(f"make_timestamp({column})")


_LATE_AND_ON_TIME = """
    SELECT event_id, vehicle_id, us, late, 0e0 AS idling_seconds, 0e0 AS litres, '' AS types
    FROM marked WHERE late
    UNION ALL
    SELECT event_id, vehicle_id, us, late, idling_seconds, litres,
           array_to_string(list_filter([CASE WHEN f1 THEN 'IDLING_ALERT' END,
               CASE WHEN f2 THEN 'SPEEDING' END, CASE WHEN f3 THEN 'HARSH_BRAKE' END,
               CASE WHEN f4 THEN 'HARSH_ACCELERATION' END, CASE WHEN f5 THEN 'ENGINE_FAULT' END,
               CASE WHEN f6 THEN 'LOW_ENERGY' END], lambda x: x IS NOT NULL), ',') AS types
    FROM flags"""
_ALERT_COLUMNS = """alert_id, event_id, vehicle_id, fleet_id, type, event_time, started_at, duration_seconds,
    estimated_fuel_l, estimated_cost, detail"""
_AS_OF = 1704067460000000
_TOP_IDLERS = """
    SELECT vehicle_id, fleet_id, sum(idling_seconds) AS d, sum(litres) AS f,
           sum(litres * 100e0) AS c
    FROM runs GROUP BY ALL HAVING sum(idling_seconds) > 0
    ORDER BY d DESC, vehicle_id, fleet_id LIMIT 20"""
_SUMMARY = """
    SELECT (SELECT count(*) FROM registry) AS registered_vehicles,
        (SELECT count(*) FROM state WHERE us >= {as_of} - 60000000) AS online_vehicles,
        (SELECT count(*) FROM state WHERE us >= {as_of} - 60000000 AND status = 'IDLING')
          AS currently_idling,
        (SELECT CAST(coalesce(sum(n_alerts), 0) AS BIGINT) FROM state
         WHERE us >= {as_of} - 60000000) AS active_alerts,
        CASE WHEN reported_us > {as_of} - 5000000 THEN round(rate, 1) ELSE 0e0 END AS events_per_sec,
        reported_us > {as_of} - 5000000 AS processor_reporting
    FROM (SELECT 1704067200000000 + (epoch_us(ts) - 1704067200000000) // 10000 AS reported_us, dv / secs AS rate
          FROM growth WHERE secs > 0 ORDER BY reported_us DESC, rate DESC LIMIT 1)"""
_OFFSET_HALF = """
    SELECT r.*, r.pos * 2 < h.high AS early FROM records r
    JOIN (SELECT part, max(pos) + 1 AS high FROM records GROUP BY part) h USING (part)"""

ORACLE: dict[str, str] = {
    "idling_report": _with(
        f"""SELECT vehicle_id, fleet_id, round(d, 6) AS duration_seconds,
            round(f, 6) AS estimated_fuel_l, round(c, 6) AS estimated_cost FROM ({_TOP_IDLERS})""",
        "runs",
    ),
    "idling_waste": _with(
        f"SELECT round(coalesce(sum(c), 0e0), 6) AS estimated_waste FROM ({_TOP_IDLERS})", "runs"
    ),
    "enriched_history": _with(
        f"""SELECT event_id, vehicle_id, {_us('us')} AS event_time, late,
            round(idling_seconds, 6) AS idling_seconds, round(litres, 6) AS estimated_fuel_l,
            round(litres * 100e0, 6) AS estimated_cost, types AS detected_types
            FROM ({_LATE_AND_ON_TIME})""",
        "flags",
    ),
    "first_arrivals": _with(
        """SELECT event_id, part AS "partition", min(pos) AS "offset" FROM arrivals
           GROUP BY event_id, part""",
        "arrivals",
    ),
    "late_flags": _with("SELECT event_id, late FROM marked", "marked"),
    "previous_readings": _with(
        f"""SELECT event_id, {_us('p_us')} AS previous_at, p_seq AS previous_seq, dt, continuous
            FROM steps""",
        "steps",
    ),
    "idle_intervals": _with(
        """SELECT event_id, idle, in_run, idling_seconds FROM islands
           UNION ALL SELECT event_id, false, false, 0e0 FROM marked WHERE late""",
        "islands",
    ),
    "idle_runs": _with(
        f"""SELECT event_id, {_us('run_us')} AS idle_start,
            round(run_seconds, 6) AS idle_duration_seconds FROM runs WHERE idle""",
        "runs",
    ),
    "fuel_estimates": _with(
        """SELECT vehicle_id, round(coalesce(sum(litres), 0e0), 6) AS litres,
           round(coalesce(sum(litres * 100e0), 0e0), 6) AS cost FROM runs GROUP BY vehicle_id""",
        "runs",
    ),
    "accelerations": _with(
        "SELECT event_id, round(accel, 6) AS acceleration_mps2 FROM islands", "islands"
    ),
    "detected_types": _with(
        """SELECT kind AS type, count(*) AS readings, count(DISTINCT vehicle_id) AS vehicles
           FROM active GROUP BY kind""",
        "active",
    ),
    "open_incidents": _with(f"SELECT {_ALERT_COLUMNS} FROM alerts WHERE is_new", "alerts"),
    "active_episodes": _with(f"SELECT {_ALERT_COLUMNS} FROM alerts", "alerts"),
    "incident_ids": _with(
        """SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3)
             || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')
             || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS alert_id
           FROM (SELECT event_id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8')
                 || encode(event_id || ':SPEEDING')) AS h FROM readings)""",
        "readings",
    ),
    "fault_counts": _with(
        "SELECT kind AS type, count(*) AS incidents FROM active WHERE is_new GROUP BY kind",
        "active",
    ),
    "latest_state": _with(
        f"""SELECT vehicle_id, event_id, {_us('us')} AS event_time, speed_kmh, status,
            {_us('run_us')} AS idle_start, round(run_seconds, 6) AS idle_duration_seconds, alerts
            FROM state""",
        "state",
    ),
    "vehicle_status": _with(
        f"""SELECT vehicle_id, CASE WHEN us < {_AS_OF} - 60000000 THEN 'OFFLINE' ELSE status END
            AS status, {_us('us')} AS event_time FROM state""",
        "state",
    ),
    "presence_index": _with(
        f"""SELECT vehicle_id, {_us('us')} AS timestamp, us >= {_AS_OF} - 60000000 AS online,
            us >= {_AS_OF} - 60000000 AND status = 'IDLING' AS idling,
            CASE WHEN us >= {_AS_OF} - 60000000 THEN n_alerts ELSE 0 END AS active_alerts
            FROM state WHERE us >= {_AS_OF} - 3600000000""",
        "state",
    ),
    "active_alerts": _with(
        f"""SELECT {_ALERT_COLUMNS} FROM alerts WHERE event_id IN (SELECT event_id FROM newest)
            AND us >= {_AS_OF} - 60000000
            ORDER BY us DESC, vehicle_id || ':' || type DESC LIMIT 50 OFFSET 10""",
        "newest",
    ),
    "active_alert_count": _with(
        f"""SELECT CAST(coalesce(sum(n_alerts), 0) AS BIGINT) AS total FROM state
            WHERE us >= {_AS_OF} - 60000000""",
        "state",
    ),
    "vehicle_page": _with(
        """SELECT r.vehicle_id, r.fleet_id, r.oem, s.status, s.event_id AS live_event_id,
           s.n_alerts AS alerts
           FROM (SELECT * FROM registry ORDER BY vehicle_id LIMIT 100 OFFSET 100) r
           LEFT JOIN state s ON s.vehicle_id = r.vehicle_id""",
        "registry",
    ),
    "fleet_summary": _with(_SUMMARY.format(as_of=_AS_OF), "growth"),
    "fleet_summary_stale": _with(_SUMMARY.format(as_of=_AS_OF + 15_000_000), "growth"),
    "bucketed_idling": _with(
        f"""SELECT vehicle_id, count(*) AS readings, round(sum(idling_seconds), 6) AS idling_seconds
            FROM ({_LATE_AND_ON_TIME}) GROUP BY vehicle_id""",
        "flags",
    ),
    "dropped_months": _with(
        """SELECT CAST(202401 AS INTEGER) AS month, count(*) AS readings FROM readings WHERE seq % 4 = 0
           UNION ALL SELECT 202312, count(*) FROM readings WHERE seq % 4 = 1""",
        "readings",
    ),
    "events_per_minute": _with(
        f"""SELECT {_stamp('minute')} AS minute, event_type, events,
            round(mean_speed, 6) AS average_speed_kmh FROM top_minutes""",
        "top_minutes",
    ),
    "activity_rollup": _with(
        f"""SELECT 'event_type' AS axis, event_type, NULL AS minute,
            CAST(sum(events) AS BIGINT) AS events FROM top_minutes GROUP BY event_type
            UNION ALL
            SELECT 'minute', NULL, {_stamp('minute')}, CAST(sum(events) AS BIGINT)
            FROM top_minutes GROUP BY minute""",
        "top_minutes",
    ),
    "activity_top": _with(
        f"""SELECT * FROM (SELECT 'event_type' AS axis, event_type, NULL AS minute,
              CAST(sum(events) AS BIGINT) AS events FROM top_minutes GROUP BY event_type
              ORDER BY events DESC, event_type LIMIT 5)
            UNION ALL
            SELECT * FROM (SELECT 'minute', NULL, {_stamp('minute')}, CAST(sum(events) AS BIGINT)
              FROM top_minutes GROUP BY minute ORDER BY minute DESC LIMIT 20)""",
        "top_minutes",
    ),
    "vehicle_history": _with(
        """SELECT strftime(observed_at, '%Y-%m-%d %H:%M:%S.%g') || 'Z' AS timestamp, speed_kmh,
           lat, lon, fuel_pct, soc_pct, event_type FROM readings
           WHERE vehicle_id = 'V000007' AND observed_at >= TIMESTAMP '2024-01-01 00:00:00'
           ORDER BY observed_at DESC, event_id LIMIT 100""",
        "readings",
    ),
    "readings_of_vehicles": _with(
        """SELECT event_id, vehicle_id, speed_kmh FROM readings
           WHERE vehicle_id IN ('V000007', 'V000003')""",
        "readings",
    ),
    "fleet_window": _with(
        f"""SELECT event_id, vehicle_id, {_stamp('observed_at')} AS event_time FROM readings
            WHERE observed_at >= TIMESTAMP '2024-01-21 00:00:00' AND fleet_id = 'F004'""",
        "readings",
    ),
    "newest_event_latency": _with(
        f"""SELECT round(greatest(0e0, ({_AS_OF} - max(us)) / 1000000e0 * 1000e0), 6)
            AS event_latency_ms FROM readings""",
        "readings",
    ),
    "retained_readings": _with(
        """SELECT vehicle_id, count(*) AS readings FROM readings
           WHERE observed_at >= TIMESTAMP '2024-01-11 00:00:00' GROUP BY vehicle_id""",
        "readings",
    ),
    "registry_quality": """SELECT count(*) AS vehicles, count(DISTINCT c_custkey) AS vehicle_ids,
        count(DISTINCT c_custkey) AS vins FROM customer""",
    "registry_scan": _with("SELECT * FROM registry WHERE fleet_id = 'F003'", "registry"),
    "registry_page": _with(
        """SELECT * FROM registry WHERE fleet_id = 'F003'
           ORDER BY vehicle_id LIMIT 100 OFFSET 50""",
        "registry",
    ),
    "registry_third_page": _with(
        "SELECT * FROM registry WHERE fleet_id = 'F003' ORDER BY vehicle_id LIMIT 15 OFFSET 30", "registry"
    ),
    "registry_total": "SELECT count(*) AS total FROM customer WHERE c_nationkey = 2",
    "vehicle_lookup": _with("SELECT * FROM registry WHERE vehicle_id = 'V000042'", "registry"),
    "upsert_absent": """
        SELECT printf('V%06d', c_custkey) AS vehicle_id,
               CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN c_mktsegment
                    ELSE 'OFFERED' END AS oem
        FROM customer""",
    "registry_csv": _with("SELECT * FROM registry", "registry"),
    "known_vehicles": _with(
        """SELECT event_id, vehicle_id FROM readings
           WHERE user_id IN (SELECT c_custkey FROM customer)""",
        "readings",
    ),
    "unknown_vehicles": """
        SELECT DISTINCT printf('V%06d', l_orderkey) AS vehicle_id
        FROM lineitem WHERE l_orderkey NOT IN (SELECT c_custkey FROM customer)""",
    "fleet_orphans": _with(
        """SELECT vehicle_id, fleet_id FROM registry WHERE fleet_id NOT IN (
             SELECT printf('F%03d', n_nationkey + 1) FROM nation
             WHERE n_regionkey = 0)""",
        "registry",
    ),
    "parse_telemetry": _with(
        f"""SELECT part AS "partition", pos AS "offset", fault IS NULL AS valid,
            CASE WHEN fault IS NULL THEN event_id END AS event_id,
            CASE WHEN fault IS NULL THEN vehicle_id END AS vehicle_id,
            CASE WHEN fault IS NULL THEN {_us('us')} END AS event_time,
            CASE WHEN fault IS NULL THEN seq END AS seq,
            CASE WHEN fault IS NULL THEN speed_kmh END AS speed_kmh,
            CASE WHEN fault IS NULL THEN engine_on END AS engine_on,
            CASE WHEN fault IS NULL THEN fuel_pct END AS fuel_pct,
            CASE WHEN fault IS NULL THEN soc_pct END AS soc_pct,
            CASE WHEN fault IS NULL THEN CASE WHEN faulty THEN 'P0301' ELSE '' END END AS dtc,
            CASE WHEN fault IS NULL THEN event_type END AS event_type
            FROM records""",
        "records",
    ),
    "validation_errors": _with(
        """SELECT part AS "partition", pos AS "offset", fault AS validation_error
           FROM records WHERE fault IS NOT NULL""",
        "records",
    ),
    "future_readings": _with(
        """SELECT CASE WHEN us > 1704067320000000 + 30000000
                        AND coalesce(fault, '') NOT IN ('json_invalid', 'bad_timestamp')
                   THEN array_to_string(list_sort(list_filter([fault, 'future_timestamp'],
                        lambda x: x IS NOT NULL)), ',')
                   ELSE fault END AS validation_error, count(*) AS records
           FROM records GROUP BY 1""",
        "records",
    ),
    "dead_letters": _with(
        """SELECT fault AS validation_error, count(*) AS records,
           CAST(sum(epoch_us(observed_at) // 1000) AS BIGINT) AS received_ms
           FROM records WHERE fault IS NOT NULL GROUP BY fault""",
        "records",
    ),
    "archive_rows": _with(
        """SELECT part AS source_partition, pos AS source_offset,
           epoch_us(observed_at) // 1000 AS received_ms, strftime(observed_at, '%Y-%m-%d') AS received_day,
           fault IS NULL AS valid, fault AS validation_error,
           CASE WHEN fault IS NULL THEN event_id END AS event_id FROM records""",
        "records",
    ),
    "record_outcomes": _with(
        """SELECT (SELECT count(*) FROM records) AS consumed,
           (SELECT count(*) FROM marked) AS accepted,
           (SELECT count(*) - count(DISTINCT event_id) FROM records WHERE fault IS NULL)
             AS duplicates,
           (SELECT count(*) FROM records WHERE fault IS NOT NULL) AS invalid,
           (SELECT count(*) FROM marked WHERE late) AS late,
           (SELECT count(*) FROM active WHERE is_new) AS alerts""",
        "records",
        **_LIVE,
    ),
    "partition_backlog": _with(
        """SELECT CAST(sum(greatest(0, high - greatest(coalesce(committed, 0), 0))) AS BIGINT) AS lag
           FROM (SELECT part, max(pos) + 1 AS high,
                        max(CASE WHEN seq % 50 = 0 THEN pos END) AS committed
                 FROM arrivals GROUP BY part)""",
        "arrivals",
    ),
    "unseen_readings": _with(
        """SELECT event_id, part AS "partition", pos AS "offset" FROM arrivals
           WHERE event_id NOT IN (SELECT event_id FROM readings
                                  WHERE observed_at < TIMESTAMP '2024-01-15 12:00:00')""",
        "arrivals",
    ),
    "final_rows": _with(
        'SELECT event_id, max(pos) AS "offset" FROM arrivals GROUP BY event_id', "arrivals"
    ),
    "stored_history": _with(
        """SELECT event_id, observed_at >= TIMESTAMP '2024-01-15 12:00:00' AS late,
           CAST(202401 AS INTEGER) AS month FROM readings""",
        "readings",
    ),
    "compacted_history": _with(
        """SELECT kind AS type, 'again' AS detail, count(*) AS incidents, count(*) AS stored_rows
           FROM active WHERE is_new GROUP BY kind""",
        "active",
    ),
    "clustered_readings": _with(
        """SELECT event_id, CAST(202401 AS INTEGER) AS month FROM readings
           WHERE vehicle_id = 'V000011'""",
        "readings",
    ),
    "json_lines": _with(
        f"SELECT event_id, true AS valid, {_us('us')} AS event_time, seq, lat FROM readings", "readings"
    ),
    "recent_snapshot": _with(
        f"""SELECT event_id, vehicle_id, fleet_id, {_stamp('observed_at')} AS timestamp, speed_kmh,
            event_type FROM sample""",
        "sample",
    ),
    "scoped_snapshot": _with(
        f"""SELECT *, 1705320000e0 AS snapshot_epoch, CAST(1440 AS INTEGER) AS window_minutes,
            CAST(100 AS INTEGER) AS vehicle_limit, CAST(20000 AS INTEGER) AS row_limit
            FROM (SELECT event_id, vehicle_id, fleet_id, {_stamp('observed_at')} AS timestamp,
                  speed_kmh, event_type FROM sample
                  UNION ALL SELECT '', '', '', NULL, 0e0, '')""",
        "sample",
    ),
    "recent_sample": _with(
        f"""SELECT vehicle_id, count(*) AS readings, round(avg(speed_kmh), 6) AS average_speed_kmh,
            {_us('min(us)')} AS first_seen, {_us('max(us)')} AS last_seen,
            1704067460e0 AS snapshot_epoch, CAST(1440 AS INTEGER) AS window_minutes,
            CAST(100 AS INTEGER) AS vehicle_limit, CAST(20000 AS INTEGER) AS row_limit
            FROM (SELECT * FROM readings WHERE vehicle_id BETWEEN 'V000001' AND 'V000100'
                  ORDER BY us DESC, event_id LIMIT 20000)
            WHERE vehicle_id BETWEEN 'V000001' AND 'V000008' AND us >= {_AS_OF} - 180000000
            GROUP BY vehicle_id""",
        "readings",
    ),
    "sample_view": _with(
        """SELECT fleet_id, count(*) AS readings, round(max(speed_kmh), 6) AS top_speed_kmh
           FROM (SELECT * FROM readings WHERE vehicle_id BETWEEN 'V000001' AND 'V000100'
                 ORDER BY us DESC, event_id LIMIT 20000) GROUP BY fleet_id""",
        "readings",
    ),
    "reconciled_sample": _with(
        """SELECT (SELECT count(*) FROM sample) AS in_both, CAST(0 AS BIGINT) AS only_left,
           (SELECT count(*) FROM readings) - (SELECT count(*) FROM sample) AS only_right,
           (SELECT count(*) FROM sample) AS left_rows, (SELECT count(*) FROM readings) AS right_rows""",
        "sample",
    ),
    "differing_rows": _with(
        "SELECT event_id, vehicle_id, 'left' AS side FROM readings WHERE seq % 50 = 0", "readings"
    ),
    "lookup_forms_agree": _with(
        """SELECT 'key' AS form, count(*) AS found FROM readings WHERE vehicle_id = 'V000007'
           UNION ALL SELECT 'text', count(*) FROM readings WHERE substr(vehicle_id, 2) = '000007'
           UNION ALL SELECT 'differing', count(*) FROM readings
           WHERE (vehicle_id = 'V000007') <> (substr(vehicle_id, 2) = '000007')""",
        "readings",
    ),
    "bounded_fleets": """
        SELECT printf('F%03d', n_nationkey + 1) AS fleet_id, n_name AS name
        FROM nation""",
    "archive_status": _with(
        """SELECT part AS "partition", min(pos) AS start_offset, max(pos) + 1 AS next_offset,
           count(*) AS records, count(fault) AS invalid FROM records GROUP BY part""",
        "records",
    ),
    "archive_time_travel": _with(
        f"""SELECT CAST(1 AS BIGINT) AS snapshot, fault IS NULL AS valid, count(*) AS records
            FROM ({_OFFSET_HALF}) WHERE early GROUP BY ALL
            UNION ALL
            SELECT CAST(2 AS BIGINT), fault IS NULL, count(*) FROM records GROUP BY ALL""",
        "records",
    ),
    "archive_snapshots": _with(
        f"""SELECT CAST(1 AS BIGINT) AS append, count(*) AS records,
                '2024-01-01 00:04:20.000000' AS committed_at FROM ({_OFFSET_HALF}) WHERE early
            UNION ALL
            SELECT CAST(2 AS BIGINT), count(*), '2024-01-01 00:04:20.000000' FROM records""",
        "records",
    ),
    "archive_flushes": _with(
        "SELECT count(*)::BIGINT AS records, true AS within_limit, true AS many FROM records",
        "records",
    ),
    "archive_resume": _with(
        f'SELECT part AS "partition", max(pos) + 1 AS start_offset FROM ({_OFFSET_HALF}) WHERE early GROUP BY part',
        "records",
    ),
    "archive_lookup": _with(
        """SELECT event_id, part AS source_partition, pos AS source_offset, speed_kmh FROM records
           WHERE fault IS NULL AND vehicle_id = 'V000005'
             AND us >= 1704067260000000 AND us < 1704067380000000""",
        "records",
    ),
    "unreplayed_records": _with(
        """SELECT part AS "partition", pos AS "offset" FROM records
           JOIN (SELECT part, (max(pos) + 1) // 2 AS half FROM records GROUP BY part) USING (part)
           WHERE pos >= half""",
        "records",
    ),
    "starting_offsets": _with(
        """SELECT part AS "partition", CASE WHEN part > 2 THEN max(pos) ELSE min(pos) END
           AS start_offset FROM arrivals GROUP BY part""",
        "arrivals",
    ),
    "counter_rates": _with(
        f"""SELECT source, {_stamp('ts')} AS ts, round(dv / secs, 6) AS rate FROM growth
            WHERE secs > 0""",
        "growth",
    ),
    "mean_durations": _with(
        f"""SELECT source, {_stamp('ts')} AS ts, round(ds / dv, 6) AS mean_duration FROM growth
            WHERE dv > 0""",
        "growth",
    ),
    "label_totals": """
        SELECT source, sum(v) AS total FROM (
            SELECT event_type AS source, event_id // 2000 AS run,
                   CAST(arg_max(event_id % 2000, ts) AS DOUBLE) AS v
            FROM events GROUP BY ALL) GROUP BY source""",
    "fresh_reports": _with(
        """SELECT source, instance_id, metric,
           CASE metric WHEN 'seconds_sum' THEN v * v / 1000e0 ELSE v END AS value
           FROM reports, (VALUES ('consumed'), ('seconds_sum'), ('seconds_count')) AS t(metric)
           WHERE ts > TIMESTAMP '2024-01-14 12:00:00' AND running""",
        "reports",
    ),
    "heartbeats": _with(
        """SELECT source, round(age, 6) AS heartbeat_age_seconds, age < 7200 AND running AS reporting
           FROM (SELECT source, arg_max(running, ts) AS running,
                 (1706659200000000 - max(epoch_us(ts))) / 1000000e0 AS age
                 FROM reports GROUP BY source)""",
        "reports",
    ),
    "progress_check": _with(
        """SELECT source, arg_min(v, ts) AS first_value, arg_max(v, ts) AS last_value,
           arg_max(v, ts) > arg_min(v, ts) AS advanced,
           arg_max(instance_id, ts) <> arg_min(instance_id, ts) AS restarted,
           (1706659200000000 - max(epoch_us(ts))) / 1000000e0 >= 3600 AS stale
           FROM reports GROUP BY source""",
        "reports",
    ),
    "live_history": _with(
        f"""SELECT event_id, late, round(idling_seconds, 6) AS idling_seconds,
            types AS detected_types FROM ({_LATE_AND_ON_TIME})""",
        "flags",
        **_LIVE,
    ),
    "live_incidents": _with(
        f"SELECT {_ALERT_COLUMNS} FROM alerts WHERE is_new", "alerts", **_LIVE
    ),
    "live_state": _with("SELECT vehicle_id, event_id, status, alerts FROM state", "state", **_LIVE),
    "live_outcomes": _with(
        """SELECT (SELECT count(*) FROM records) AS consumed,
           (SELECT count(*) FROM marked) AS accepted,
           (SELECT count(*) - count(DISTINCT event_id) FROM records WHERE fault IS NULL)
             AS duplicates,
           (SELECT count(*) FROM records WHERE fault IS NOT NULL) AS invalid,
           (SELECT count(*) FROM marked WHERE late) AS late,
           (SELECT count(*) FROM active WHERE is_new) AS alerts""",
        "records",
        **_LIVE,
    ),
    "archive_stream": _with(
        """SELECT part AS source_partition, pos AS source_offset, fault IS NULL AS valid,
           fault AS validation_error FROM records""",
        "records",
    ),
    "activity_stream": _with(
        f"""SELECT {_stamp('minute')} AS minute, event_type, events,
            round(mean_speed, 6) AS average_speed_kmh FROM minutes""",
        "minutes",
    ),
}
