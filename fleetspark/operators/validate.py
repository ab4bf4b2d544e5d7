"""Closed-schema JSON validation and archive rows (P1-P10, ST10).

Every check is a column expression, so validation stays in one JVM-side projection over the
records and never shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.functions.ids import canonical_uuid
from fleetspark.functions.times import moment
from fleetspark.schema import ARCHIVE_COLUMNS, TELEMETRY, TELEMETRY_COLUMNS
from fleetspark.settings import FUTURE_TOLERANCE_SECONDS

# Scenario labels a reading may carry.
SCENARIOS = [
    "NORMAL",
    "IDLING",
    "SPEEDING",
    "HARSH_BRAKE",
    "HARSH_ACCELERATION",
    "ENGINE_FAULT",
    "LOW_ENERGY",
    "OFFLINE",
    "DUPLICATE_EVENT",
    "OUT_OF_ORDER_EVENT",
    "MALFORMED_EVENT",
    "NETWORK_RECOVERY_BURST",
]

# Formats and limits of the reading.
ID_PATTERNS = {
    "vehicle_id": r"^V[0-9]{6,}\z",
    "vin": r"^SYN[0-9]{14}\z",
    "fleet_id": r"^F[0-9]{3}\z",
}
DTC_PATTERN = r"[PBCU][0-9A-F]{4}"
MAX_DTC = 16
MAX_OEM_LENGTH = 50
ZONED_TIME = (
    r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d:?\d\d)\z"
)

# A JSON text as producers write it: the fields in schema order, ids, codes, time and numbers in
# their usual spelling, strings without escapes. Its keys and forms need no further parsing; all
# other texts, sound or not, are looked at in full.
_SIGNED = r"-?(?:0|[1-9][0-9]{0,14})(?:\.[0-9]{1,17})?(?:[eE][+-]?[0-9]{1,2})?"
_PLAIN_TEXT = r'"[^"\\\x00-\x1f]{0,200}"'
_PLAIN_CODE = rf'"{DTC_PATTERN}"'
_PLAIN_VALUES = {
    "event_id": r'"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"',
    "vehicle_id": r'"V[0-9]{6,50}"',
    "vin": r'"SYN[0-9]{14}"',
    "fleet_id": r'"F[0-9]{3}"',
    "timestamp": r'"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?Z"',
    "seq": r"-?(?:0|[1-9][0-9]{0,17})",
    "engine_on": "(?:true|false)",
    "fuel_pct": rf"(?:null|{_SIGNED})",
    "soc_pct": rf"(?:null|{_SIGNED})",
    "dtc": rf"\[(?:{_PLAIN_CODE}(?:, ?{_PLAIN_CODE}){{0,{MAX_DTC - 1}}})?\]",
    "event_type": _PLAIN_TEXT,
    "source_oem": _PLAIN_TEXT,
    "schema_version": r"(?:0|[1-9][0-9]{0,8})",
}
PLAIN = (
    r"^\{"
    + ", ?".join(f'"{name}": ?{_PLAIN_VALUES.get(name, _SIGNED)}' for name in TELEMETRY_COLUMNS)
    + r"\}\z"
)

RULES_PER_STEP = 3

NULLABLE = {"fuel_pct", "soc_pct"}

# The timestamp and seq are read as text first: their own rules are stricter than a cast.
_AS_TEXT = {"timestamp", "seq"}
_PARSED = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name in _AS_TEXT else f.dataType)
        for f in TELEMETRY.fields
    ]
    + [T.StructField("_corrupt", T.StringType())]
)
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "allowNonNumericNumbers": "false",
}


def _numeric_limits(r) -> list[Column]:
    infinite = F.lit(float("inf"))
    return [
        ~r("lat").between(-90.0, 90.0),
        ~r("lon").between(-180.0, 180.0),
        ~r("speed_kmh").between(0.0, 220.0),
        ~((r("heading_deg") >= 0.0) & (r("heading_deg") < 360.0)),
        ~r("fuel_pct").between(0.0, 100.0),
        ~r("soc_pct").between(0.0, 100.0),
        ~((r("odometer_km") >= 0.0) & (r("odometer_km") < infinite)),
        ~r("engine_temp_c").between(-40.0, 160.0),
        r("seq").startswith("-"),
    ]


def _any(conditions: list[Column]) -> Column:
    """True if any condition holds; unknown counts as no, nulls have their own rule."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def _sound_codes(codes: Column) -> Column:
    """True if every element is a diagnostic code.

    Joined text of n codes has 6n - 1 characters, so no element can hide a separator.
    """
    text = F.array_join(codes, "|")
    whole = (text == "") | text.rlike(rf"^({DTC_PATTERN}([|]{DTC_PATTERN})*)?\z")
    return whole & (F.length(text) == F.greatest(F.lit(0), F.size(codes) * 6 - 1))


def _zoned_time(text: Column) -> Column:
    """UTC timestamp of a text that carries a zone, otherwise null."""
    upper = F.upper(text)
    with_colon = F.regexp_replace(upper, r"([+-]\d\d)(\d\d)$", "$1:$2")
    tidy = F.when(upper.endswith("Z"), upper).otherwise(with_colon)
    return F.when(upper.rlike(ZONED_TIME), F.try_to_timestamp(tidy))


def _known_fields() -> Column:
    return F.array(*[F.lit(name) for name in TELEMETRY_COLUMNS])


def _seq() -> Column:
    return F.expr("try_cast(_r.seq AS bigint)")


def _rules() -> dict[str, Column]:
    """What can be wrong with a payload that is a JSON object, by error code."""

    def r(name: str) -> Column:
        return F.col(f"_r.{name}")

    keys, known = F.col("_keys"), _known_fields()
    # Producers write the fields in schema order; only others need the set operations.
    other_order = ~F.col("_schema_order")
    required_nulls = [
        r(name).isNull() & F.array_contains(keys, name)
        for name in TELEMETRY_COLUMNS
        if name not in NULLABLE
    ]
    whole_number = r("seq").rlike(r"^-?[0-9]+\z")
    # What the spelling of a plain text already says is not asked of it again.
    other = ~F.col("_plain")
    return {
        "unknown_field": other_order & (F.size(F.array_except(keys, known)) > 0),
        "missing_field": other_order & (F.size(F.array_except(known, keys)) > 0),
        "wrong_type": _any(
            [
                r("_corrupt").isNotNull(),
                other & ~whole_number,
                F.col("_oem_kind") != "STRING",
                *required_nulls,
            ]
        ),
        "out_of_range": _any(_numeric_limits(r)),
        "seq_out_of_range": other & whole_number & _seq().isNull(),
        "bad_pattern": other & _any(
            [~r(name).rlike(pattern) for name, pattern in ID_PATTERNS.items()]
            + [r("event_id").isNotNull() & F.col("_uuid").isNull()]
        ),
        "bad_choice": _any([~r("event_type").isin(SCENARIOS), r("schema_version") != 1]),
        "bad_length": ~F.length(r("source_oem")).between(1, MAX_OEM_LENGTH),
        "bad_timestamp": r("timestamp").isNotNull() & F.col("_time").isNull(),
        "bad_dtc": other & ((F.size(r("dtc")) > MAX_DTC) | ~_sound_codes(r("dtc"))),
        "energy_choice": (r("fuel_pct").isNull() == r("soc_pct").isNull())
        & F.array_contains(keys, "fuel_pct")
        & F.array_contains(keys, "soc_pct"),
    }


def parse_telemetry(records: DataFrame, as_of=None) -> DataFrame:
    """Add the telemetry columns, `valid` and `validation_error` to Kafka-shaped records.

    Telemetry columns are null in invalid rows; the error lists the distinct codes in order and
    never shows values. With `as_of`, readings more than 30 seconds ahead are invalid too - the
    live rule, which the archive does not apply.
    """
    text, plain = F.col("_text"), F.col("_plain")
    valid_text = F.try_validate_utf8(F.col("value").cast("string"))
    rows = _evaluated_once(records, _text=valid_text)
    rows = _evaluated_once(rows, _plain=F.coalesce(text.rlike(PLAIN), F.lit(False)))
    # In an array, text after the object is an error instead of being ignored.
    document = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    rows = _evaluated_once(
        rows,
        _r=F.from_json(text, _PARSED, _JSON_OPTIONS),
        _keys=F.when(plain, _known_fields()).otherwise(F.json_object_keys(text)),
        _doc=F.when(~plain, document),
    )
    time, uuid = F.col("_r.timestamp"), F.col("_r.event_id")
    whole = (
        F.col("_doc").isNotNull()
        & F.col("_keys").isNotNull()
        & F.expr("try_variant_get(_doc, '$[1]', 'variant')").isNull()
    )
    oem_kind = F.schema_of_variant(F.expr("try_variant_get(_doc, '$[0].source_oem', 'variant')"))
    rows = _evaluated_once(
        rows,
        _time=F.when(plain, F.try_to_timestamp(time)).otherwise(_zoned_time(time)),
        _schema_order=plain | F.coalesce(F.col("_keys") == _known_fields(), F.lit(False)),
        _uuid=F.when(plain, uuid).otherwise(canonical_uuid(uuid)),
        _object=plain | whole,
        _oem_kind=F.when(plain, "STRING").otherwise(oem_kind),
    )
    rules = _rules()
    if as_of is not None:
        latest = F.unix_micros(moment(as_of)) + FUTURE_TOLERANCE_SECONDS * 1_000_000
        rules["future_timestamp"] = F.unix_micros("_time") > latest
    # In a few steps: generated methods above 8,000 bytes are never compiled by the JVM.
    names = sorted(rules)
    for i in range(0, len(names), RULES_PER_STEP):
        step = {f"_is_{name}": rules[name] for name in names[i : i + RULES_PER_STEP]}
        rows = _evaluated_once(rows, **step)
    # Each code occurs once and they are listed in order, so the text is distinct and sorted.
    found = F.concat_ws(",", *[F.when(F.col(f"_is_{name}"), F.lit(name)) for name in names])
    rows = _evaluated_once(
        rows, _codes=F.when(F.col("_object"), found).otherwise("json_invalid")
    )
    valid = F.col("_codes") == ""
    special = {
        "event_id": F.col("_uuid"),
        "timestamp": F.col("_time"),
        "seq": _seq(),
    }
    fields = {
        name: F.when(valid, special.get(name, F.col(f"_r.{name}"))) for name in TELEMETRY_COLUMNS
    }
    return rows.select(
        *records.columns,
        *[column.alias(name) for name, column in fields.items()],
        valid.alias("valid"),
        F.when(~valid, F.col("_codes")).alias("validation_error"),
    )


def _evaluated_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns behind a one-row generator.

    Filters on plain projections are pushed below them by repeating their expressions, which
    would parse each payload once per use. Generated columns are computed once.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def validation_errors(records: DataFrame, as_of=None) -> DataFrame:
    """Arrival and error codes of invalid records."""
    return (
        parse_telemetry(records, as_of)
        .where(~F.col("valid"))
        .select("topic", "partition", "offset", "validation_error")
    )


def dead_letters(records: DataFrame, as_of=None) -> DataFrame:
    """Invalid records with their untouched payload (ST10)."""
    return (
        parse_telemetry(records, as_of)
        .where(~F.col("valid"))
        .select("topic", "partition", "offset", "timestamp_ms", "validation_error", "value")
    )


def valid_readings(parsed: DataFrame) -> DataFrame:
    """Valid rows as readings: telemetry columns plus arrival."""
    return parsed.where("valid").select(*TELEMETRY_COLUMNS, "partition", "offset")


def to_archive_rows(records: DataFrame, as_of) -> DataFrame:
    """Archive rows of all records, valid or not, raw bytes kept.

    The receive time is the broker's, or `as_of` when the broker gave none.
    """
    received = F.when(
        F.col("timestamp_ms") >= 0, F.timestamp_millis("timestamp_ms")
    ).otherwise(moment(as_of))
    return (
        parse_telemetry(records)
        .withColumnsRenamed(
            {
                "topic": "source_topic",
                "partition": "source_partition",
                "offset": "source_offset",
                "value": "raw_payload",
            }
        )
        .withColumn("received_at", received)
        .withColumn("received_day", F.to_date("received_at"))
        .select(*ARCHIVE_COLUMNS, "received_day")
    )
