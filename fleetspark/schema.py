"""Fixed schemas. Nothing here is ever inferred from data."""

from pyspark.sql import types as T


def _fields(*specs):
    return [T.StructField(name, kind, nullable) for name, kind, nullable in specs]


STRINGS = T.ArrayType(T.StringType())

VEHICLE = T.StructType(
    _fields(
        ("vehicle_id", T.StringType(), False),
        ("vin", T.StringType(), False),
        ("fleet_id", T.StringType(), False),
        ("oem", T.StringType(), False),
        ("model", T.StringType(), False),
        ("fuel_type", T.StringType(), False),
        ("manufacture_year", T.IntegerType(), False),
        ("home_region", T.StringType(), False),
        ("odometer_km", T.DoubleType(), False),
    )
)

FLEET = T.StructType(
    _fields(("fleet_id", T.StringType(), False), ("name", T.StringType(), False))
)

TELEMETRY = T.StructType(
    _fields(
        ("event_id", T.StringType(), True),
        ("vehicle_id", T.StringType(), True),
        ("vin", T.StringType(), True),
        ("fleet_id", T.StringType(), True),
        ("timestamp", T.TimestampType(), True),
        ("seq", T.LongType(), True),
        ("lat", T.DoubleType(), True),
        ("lon", T.DoubleType(), True),
        ("speed_kmh", T.DoubleType(), True),
        ("heading_deg", T.DoubleType(), True),
        ("engine_on", T.BooleanType(), True),
        ("fuel_pct", T.DoubleType(), True),
        ("soc_pct", T.DoubleType(), True),
        ("odometer_km", T.DoubleType(), True),
        ("engine_temp_c", T.DoubleType(), True),
        ("dtc", STRINGS, True),
        ("event_type", T.StringType(), True),
        ("source_oem", T.StringType(), True),
        ("schema_version", T.IntegerType(), True),
    )
)
TELEMETRY_COLUMNS = TELEMETRY.fieldNames()

# Kafka-source columns that matter here. `timestamp_ms` is the broker time, negative if absent.
RECORD = T.StructType(
    _fields(
        ("topic", T.StringType(), True),
        ("partition", T.IntegerType(), True),
        ("offset", T.LongType(), True),
        ("value", T.BinaryType(), True),
        ("timestamp_ms", T.LongType(), True),
    )
)

# A reading plus where and in which order it arrived.
ARRIVAL = T.StructType(
    _fields(("partition", T.IntegerType(), True), ("offset", T.LongType(), True))
)

MEASURES = T.StructType(
    _fields(
        ("idling_seconds", T.DoubleType(), True),
        ("estimated_fuel_l", T.DoubleType(), True),
        ("estimated_cost", T.DoubleType(), True),
        ("detected_types", STRINGS, True),
        ("late", T.BooleanType(), True),
    )
)
ENRICHED = T.StructType(TELEMETRY.fields + MEASURES.fields)
ENRICHED_COLUMNS = ENRICHED.fieldNames()

ALERT = T.StructType(
    _fields(
        ("alert_id", T.StringType(), True),
        ("event_id", T.StringType(), True),
        ("vehicle_id", T.StringType(), True),
        ("fleet_id", T.StringType(), True),
        ("timestamp", T.TimestampType(), True),
        ("type", T.StringType(), True),
        ("start_timestamp", T.TimestampType(), True),
        ("duration_seconds", T.DoubleType(), True),
        ("estimated_fuel_l", T.DoubleType(), True),
        ("estimated_cost", T.DoubleType(), True),
        ("detail", T.StringType(), True),
    )
)
ALERT_COLUMNS = ALERT.fieldNames()

STATE = T.StructType(
    TELEMETRY.fields
    + _fields(
        ("idle_start", T.TimestampType(), True),
        ("idle_duration_seconds", T.DoubleType(), True),
        ("acceleration_mps2", T.DoubleType(), True),
        ("active_alerts", T.ArrayType(ALERT), True),
        ("status", T.StringType(), True),
        ("received_at", T.TimestampType(), True),
    )
)

ARCHIVE = T.StructType(
    TELEMETRY.fields
    + _fields(
        ("source_topic", T.StringType(), True),
        ("source_partition", T.IntegerType(), True),
        ("source_offset", T.LongType(), True),
        ("received_at", T.TimestampType(), True),
        ("valid", T.BooleanType(), True),
        ("validation_error", T.StringType(), True),
        ("raw_payload", T.BinaryType(), True),
        ("received_day", T.DateType(), True),
    )
)
ARCHIVE_COLUMNS = [name for name in ARCHIVE.fieldNames() if name != "received_day"]

SAMPLE = T.StructType(
    _fields(
        ("event_id", T.StringType(), True),
        ("vehicle_id", T.StringType(), True),
        ("fleet_id", T.StringType(), True),
        ("timestamp", T.TimestampType(), True),
        ("speed_kmh", T.DoubleType(), True),
        ("event_type", T.StringType(), True),
        ("snapshot_epoch", T.DoubleType(), True),
        ("window_minutes", T.IntegerType(), True),
        ("vehicle_limit", T.IntegerType(), True),
        ("row_limit", T.IntegerType(), True),
    )
)

ACTIVITY = T.StructType(
    _fields(
        ("minute", T.TimestampType(), True),
        ("event_type", T.StringType(), True),
        ("events", T.LongType(), True),
        ("average_speed_kmh", T.DoubleType(), True),
    )
)

METRIC_SAMPLE = T.StructType(
    _fields(
        ("source", T.StringType(), True),
        ("instance_id", T.StringType(), True),
        ("metric", T.StringType(), True),
        ("ts", T.TimestampType(), True),
        ("value", T.DoubleType(), True),
        ("running", T.BooleanType(), True),
    )
)
