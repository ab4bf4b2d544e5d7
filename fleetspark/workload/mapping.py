"""Fleet telemetry derived from the given tables.

`events` becomes readings, `customer` the vehicle registry and `nation` the fleets. Timestamps for
detection are compressed 10,000-fold so that the ten-second continuity rule matters; reports by
minute or day use `observed_at`, the original time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.plans.even import in_even_tasks
from fleetspark.schema import TELEMETRY_COLUMNS

START_MICROS = 1_704_067_200_000_000
TOPIC = "fleet.telemetry.v1"
PARTITIONS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Naive timestamps of the files are UTC.
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(prefix: str, number: Column, width: int) -> Column:
    """The prefix and the number, padded with zeros; a longer number is never cut."""
    return F.when(number.isNotNull(), F.format_string(f"{prefix}%0{width}d", number.cast("long")))


def spread(df: DataFrame) -> DataFrame:
    """A given table in even tasks; its rows are counted by the files' footers."""
    return in_even_tasks(df, df.count())


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event, with arrival partition and offset; no duplicates."""
    return _as_readings(table(spark, sf_dir, "events"))


def _partition(user: Column) -> Column:
    return (user % PARTITIONS).cast("int")


def _offset(event: Column) -> Column:
    """Every seventh reading arrives 400 places late; ties go to the lower event id."""
    delayed = event % 7 == 0
    return 4 * (event + F.when(delayed, 400).otherwise(0)) + F.when(delayed, 0).otherwise(1)


def _delays(event: Column) -> Column:
    """By how many offsets each copy of an event comes later than its first."""
    return F.when(event % 50 == 0, F.array(F.lit(0), F.lit(4002))).otherwise(F.array(F.lit(0)))


def _as_readings(events: DataFrame, *kept: str) -> DataFrame:
    e = (
        events
        .withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
        .withColumn("_us", F.expr(f"{START_MICROS} + (_us - {START_MICROS}) div 10000"))
    )
    user, event = F.col("user_id"), F.col("event_id")
    level = F.get_json_object("props", "$.k").cast("double")
    scenario = (
        F.when(F.col("event_type") == "error", "ENGINE_FAULT")
        .when(F.col("event_type") == "click", "SPEEDING")
        .when(F.col("event_type") == "purchase", "LOW_ENERGY")
        .when(F.col("event_type") == "signup", "IDLING")
        .otherwise("NORMAL")
    )
    parked = F.expr(f"((_us - {START_MICROS}) div 40000000) % 3") == 0
    columns = {
        "event_id": numbered("00000000-0000-4000-8000-", event, 12),
        "vehicle_id": numbered("V", user, 6),
        "vin": numbered("SYN", user, 14),
        "fleet_id": numbered("F", user % 25 + 1, 3),
        "timestamp": F.timestamp_micros("_us"),
        "seq": event,
        "lat": F.lit(8.0) + (user % 20),
        "lon": F.lit(72.0) + (user % 15),
        "speed_kmh": F.when(parked, 0.0).otherwise(F.least(F.col("value"), F.lit(220.0))),
        "heading_deg": ((event * 7) % 360).cast("double"),
        "engine_on": (F.col("event_type") != "signup") | (event % 2 == 0),
        "fuel_pct": F.when(user % 2 == 1, level),
        "soc_pct": F.when(user % 2 == 0, level),
        "odometer_km": (event % 100000).cast("double"),
        "engine_temp_c": level,
        "dtc": F.when(F.col("event_type") == "error", F.array(F.lit("P0301"))).otherwise(
            F.array().cast("array<string>")
        ),
        "event_type": scenario,
        "source_oem": F.concat(F.lit("OEM-"), (user % 6).cast("string")),
        "schema_version": F.lit(1),
        "partition": _partition(user),
        "offset": _offset(event),
        "observed_at": F.col("ts").cast("timestamp"),
    }
    return e.select(*[value.alias(name) for name, value in columns.items()], *kept)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with every fiftieth event sent again a thousand places later."""
    once = _as_readings(spread(table(spark, sf_dir, "events")))
    sent = once.withColumn("_delay", F.explode(_delays(F.col("seq"))))
    return sent.withColumn("offset", F.col("offset") + F.col("_delay")).drop("_delay")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as often as they arrive, with source partition and offset (`_partition`, `_place`)."""
    sent = table(spark, sf_dir, "events").withColumn("_delay", F.explode(_delays(F.col("event_id"))))
    place = _offset(F.col("event_id")) + F.col("_delay")
    return sent.withColumns({"_partition": _partition(F.col("user_id")), "_place": place}).drop("_delay")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped records: arrivals as JSON bytes, broken on purpose for some `seq % 97`.

    1 no JSON, 2 extra key, 3 missing key, 4 latitude 91, 5 no zone, 6 malformed vehicle,
    7 both energies, 8 unknown trouble code, 9 seq of 2^63, 10 a list for a boolean.
    """
    return _as_records(arrivals(spark, sf_dir))


def records_in_ranges(spark: SparkSession, sf_dir: str, ranges: int, size: int) -> DataFrame:
    """The records of `ranges` ranges of `size` offsets each, with the number of their `range`.

    A task holds a range of a source partition, by rising offset. Events are moved and sorted as
    they were given, before any JSON is made.
    """
    at = F.expr(f"int(_place div {int(size)})")
    rows = places(spark, sf_dir).where(F.col("_place").between(0, ranges * size - 1)).withColumn("range", at)
    task = F.col("range") * PARTITIONS + F.coalesce(F.pmod("_partition", F.lit(PARTITIONS)), F.lit(0))
    sent = (
        rows.repartitionById(ranges * PARTITIONS, task.cast("int"))
        .sortWithinPartitions("range", "_partition", "_place")
    )
    readings = _as_readings(sent, "range", "_partition", "_place")
    return _as_records(
        readings.drop("partition", "offset").withColumnsRenamed({"_partition": "partition", "_place": "offset"}),
        "range",
    )


def _as_records(rows: DataFrame, *kept: str) -> DataFrame:
    case = F.col("seq") % 97
    sent_at = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = rows.withColumns(
        {
            "_case": case,
            "timestamp": F.when(case == 5, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(sent_at),
            "_seq": F.col("seq"),
            "seq": F.when(case == 9, F.lit("9223372036854775808").cast("decimal(20,0)")).otherwise(
                F.col("seq").cast("decimal(20,0)")
            ),
            "lat": F.when(case == 4, F.lit(91.0)).otherwise(F.col("lat")),
            "vehicle_id": F.when(case == 6, F.lit("X1")).otherwise(F.col("vehicle_id")),
            "soc_pct": F.when(case == 7, F.lit(50.0)).otherwise(F.col("soc_pct")),
            "fuel_pct": F.when(case == 7, F.lit(50.0)).otherwise(F.col("fuel_pct")),
            "dtc": F.when(case == 8, F.array(F.lit("Z9999"))).otherwise(F.col("dtc")),
        }
    )
    text = F.to_json(F.struct(*TELEMETRY_COLUMNS), {"ignoreNullFields": "false"})
    text = (
        F.when(F.col("_case") == 1, F.lit("{invalid"))
        .when(F.col("_case") == 2, F.regexp_replace(text, r"^\{", '{"extra":1,'))
        .when(F.col("_case") == 3, F.regexp_replace(text, r'"vin":"[^"]*",', ""))
        .when(F.col("_case") == 10, F.regexp_replace(text, r'"engine_on":(true|false)', '"engine_on":[]'))
        .otherwise(text)
    )
    return body.select(
        F.lit(TOPIC).alias("topic"),
        "partition",
        "offset",
        text.cast("binary").alias("value"),
        F.unix_millis("observed_at").alias("timestamp_ms"),
        F.col("_seq").alias("source_seq"),
        *kept,
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    electric = key % 2 == 0
    return table(spark, sf_dir, "customer").select(
        numbered("V", key, 6).alias("vehicle_id"),
        numbered("SYN", key, 14).alias("vin"),
        numbered("F", F.col("c_nationkey") + 1, 3).alias("fleet_id"),
        F.col("c_mktsegment").alias("oem"),
        F.col("c_name").alias("model"),
        F.when(electric, "EV").otherwise("ICE").alias("fuel_type"),
        (F.lit(2018) + key % 8).cast("int").alias("manufacture_year"),
        F.concat(F.lit("R"), (key % 4).cast("string")).alias("home_region"),
        F.abs("c_acctbal").alias("odometer_km"),
    )


def fleets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        numbered("F", F.col("n_nationkey") + 1, 3).alias("fleet_id"),
        F.col("n_name").alias("name"),
    )
