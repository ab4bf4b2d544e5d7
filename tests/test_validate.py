"""Validation rules, error codes, archive rows, outcomes."""

from __future__ import annotations

import json
from datetime import timedelta

import pytest

from pyspark.sql import functions as F

from fleetspark.operators import validate
from fleetspark.operators.outcomes import batch_outcomes, event_latency, partition_lag
from fleetspark.operators.validate import dead_letters, parse_telemetry, to_archive_rows
from fleetspark.sources import jsonl
from tests.build import START, at, base, frame, payload, records


def errors(spark, payloads, as_of=None):
    rows = parse_telemetry(records(spark, payloads), as_of).orderBy("offset").collect()
    return [r["validation_error"] for r in rows]


def broken(**changes) -> bytes:
    return payload(base(**changes))


def raw(edit) -> bytes:
    body = json.loads(payload(base()))
    edit(body)
    return json.dumps(body).encode()


CASES = [
    (payload(base()), None),
    (broken(lat=91.0), "out_of_range"),
    (broken(speed_kmh=-1.0), "out_of_range"),
    (broken(heading_deg=360.0), "out_of_range"),
    (broken(fuel_pct=101.0), "out_of_range"),
    (broken(seq=-1), "out_of_range"),
    (broken(timestamp="2026-09-27T00:00:00"), "bad_timestamp"),
    (broken(timestamp="yesterday"), "bad_timestamp"),
    (broken(timestamp="2026-09-27T00:00:00+0530"), None),
    (broken(speed_kmh=float("nan")), "json_invalid"),
    (broken(speed_kmh="invalid"), "wrong_type"),
    (broken(speed_kmh=None), "wrong_type"),
    (broken(source_oem=5), "wrong_type"),
    (broken(source_oem=""), "bad_length"),
    (broken(source_oem="x" * 51), "bad_length"),
    (broken(seq=2**63), "seq_out_of_range"),
    (broken(seq=1.5), "wrong_type"),
    (broken(schema_version=2), "bad_choice"),
    (broken(event_type="PARKED"), "bad_choice"),
    (broken(vehicle_id="V1"), "bad_pattern"),
    (broken(vehicle_id="V000001\n"), "bad_pattern"),
    (broken(event_id="1"), "bad_pattern"),
    (broken(dtc=["P0301", "P0301|P0302"]), "bad_dtc"),
    (broken(dtc=["P0301"] * 17), "bad_dtc"),
    (broken(dtc=["P0301"] * 16), None),
    (broken(dtc=[""]), "bad_dtc"),
    (broken(soc_pct=50.0), "energy_choice"),
    (broken(fuel_pct=None), "energy_choice"),
    (raw(lambda b: b.pop("soc_pct")), "missing_field"),
    (raw(lambda b: b.update(extra=1)), "unknown_field"),
    (raw(lambda b: b.update(lat=91, lon=-181, extra=1)), "out_of_range,unknown_field"),
    (b"not json", "json_invalid"),
    (b"[]", "json_invalid"),
    (payload(base()) + b" trailing", "json_invalid"),
    (payload(base()) + b"," + payload(base()), "json_invalid"),
    (b"\xff\xfe{}", "json_invalid"),
    (None, "json_invalid"),
]


def test_rules(spark):
    found = errors(spark, [p for p, _ in CASES])
    for (body, want), got in zip(CASES, found, strict=True):
        assert got == want, body


def test_future_is_a_live_rule(spark):
    soon = [at(30), at(30.001, seq=1)]
    found = errors(spark, [payload(r) for r in soon], START)
    assert found == [None, "future_timestamp"]
    assert errors(spark, [payload(r) for r in soon]) == [None, None]


def test_zone_is_converted(spark):
    row = parse_telemetry(records(spark, [broken(timestamp="2026-09-27T05:30:00.25+05:30")])).first()
    assert row["timestamp"].timestamp() == (START + timedelta(seconds=0.25)).timestamp()


def test_archive_rows_keep_bytes(spark):
    huge = broken(seq=2**63)
    rows = to_archive_rows(records(spark, [None, huge], timestamp_ms=-1), START).collect()
    assert [r["raw_payload"] and bytes(r["raw_payload"]) for r in rows] == [None, huge]
    assert not any(r["valid"] for r in rows)
    assert all(r["received_at"].timestamp() == START.timestamp() for r in rows)
    assert dead_letters(records(spark, [huge])).count() == 1


def test_outcomes(spark):
    body = payload(base(speed_kmh=130.0, dtc=["P0301"]))
    parsed = parse_telemetry(records(spark, [body, body, b"{invalid"]), START)
    row = batch_outcomes(parsed).first().asDict()
    assert row == {
        "consumed": 3,
        "accepted": 1,
        "duplicates": 1,
        "invalid": 1,
        "late": 0,
        "alerts": 2,
    }
    again = batch_outcomes(parsed, seen=parsed.where("valid")).first()
    assert again["duplicates"] == 2 and again["accepted"] == 0 and again["alerts"] == 0


def test_latency_and_lag(spark):
    rows = frame(spark, [at(0), at(5)])
    assert event_latency(rows, START + timedelta(seconds=7)).first()[0] == 2000.0
    assert event_latency(rows, START).first()[0] == 0.0
    offsets = [(0, 10, 4), (1, 5, 9), (2, 7, None), (3, 3, -1001)]
    lag = partition_lag(spark.createDataFrame(offsets, "partition int, high long, committed long"))
    assert lag.first()["lag"] == 6 + 0 + 7 + 3


def test_json_lines_round_trip(spark, tmp_path):
    rows = frame(spark, [at(0.123456, seq=1), at(2, fuel_pct=None, soc_pct=5.0, dtc=["P0301"])])
    jsonl.write_json_lines(rows, str(tmp_path / "lines"))
    back = parse_telemetry(jsonl.read_json_lines(spark, str(tmp_path / "lines")))
    names = [c for c in rows.columns if c not in ("partition", "offset")]
    assert back.where("valid").count() == 2
    assert sorted(map(repr, back.select(names).collect())) == sorted(map(repr, rows.select(names).collect()))
    assert back.select("partition", "offset").distinct().count() == 2


def test_json_lines_keep_their_order(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    for name, size in (("a", 300), ("b", 900), ("c", 50)):
        (folder / f"{name}.json").write_text("".join(f"{name}{i}\n" for i in range(size)))
    changed = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        rows = jsonl.read_json_lines(spark, str(folder)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    lines = [bytes(r["value"]).decode() for r in sorted(rows, key=lambda r: (r["partition"], r["offset"]))]
    assert lines == [f"{n}{i}" for n, size in (("a", 300), ("b", 900), ("c", 50)) for i in range(size)]


@pytest.mark.parametrize("seq", [0, 2**63 - 1])
def test_seq_limits(spark, seq):
    assert parse_telemetry(records(spark, [broken(seq=seq)])).first()["seq"] == seq


ODD_VALUES = (
    "null true false 0 -0 00 01 -1 1 2 1.0 1. .5 -.5 +1 1e2 1E+2 1e-5 1e400 1e99 -40.0 90.0 90.5 220.0 220.01 360.0 1.5e1 0x1 NaN "
    "Infinity 100 100.1 160 123456789012345 1234567890123456789 9223372036854775807 9223372036854775808 -9223372036854775809 "
    '1.12345678901234567 1.123456789012345678 "" "1" "a b" "é€😀" "a\\u0041" "a\\"b" "a\\/b" "tab\t" [] {} [1] [null] ["P0301"] '
    '["P0301","U12EF"] ["P0301", "P0302"] ["P0301" ,"P0302"] ["p0301"] ["P0301|P0302"] ["P030"] "P0301" ["P0301",] '
    '"2026-09-27T00:00:00Z" "2026-09-27 00:00:00z" "2026-09-27T00:00Z" "2026-09-27T00:00:00.123456789Z" "2026-09-27T00:00:00.1234567890Z" '
    '"2026-02-30T00:00:00Z" "2026-09-27T24:00:00Z" "2026-09-27T23:59:60Z" "2026-13-01T00:00:00Z" "0000-01-01T00:00:00Z" '
    '"9999-12-31T23:59:59.999999Z" "2026-09-27T00:00:00+05:30" "2026-09-27T00:00:00+0530" "2026-09-27T00:00:00" "2026-9-27T00:00:00Z" '
    '"V000001" "V1234567" "V00001" "v000001" "X1" "SYN00000000000001" "SYN0000000000001" "F001" "F01" "F0001" "NORMAL" "normal" '
    '"123e4567-e89b-12d3-a456-426614174000" "123E4567-E89B-12D3-A456-426614174000" "123e4567e89b12d3a456426614174000" "123e4567-e89b"'
)


def odd_values() -> list[str]:
    found, decoder = [], json.JSONDecoder(strict=False)
    rest = ODD_VALUES
    while rest := rest.lstrip(" "):
        end = rest.find(" ")
        if rest[0] in '"[{':
            try:
                end = decoder.raw_decode(rest)[1]
            except ValueError:
                pass
        end = len(rest) if end < 0 else end
        found.append(rest[:end])
        rest = rest[end:]
    many = [f'["{chr(34) + chr(44) + chr(34):s}"]'.replace('","', '","'.join(["P0301"] * n)) for n in (16, 17)]
    return [*found, *many, '"' + "x" * 50 + '"', '"' + "x" * 51 + '"', '"' + "x" * 201 + '"', '"\x01"']


def spellings() -> list[bytes | None]:
    """A sound text in many spellings, sound and broken."""
    plain = json.loads(payload(base(event_id="123e4567-e89b-12d3-a456-426614174000", source_oem="Tata")))
    tokens = {name: json.dumps(value) for name, value in plain.items()}

    def text(tokens, between=",", after=":") -> str:
        return "{" + between.join(f'"{name}"{after}{value}' for name, value in tokens.items()) + "}"

    found = [text({**tokens, name: value}) for name in tokens for value in odd_values()]
    usual = text(tokens)
    found += [text(tokens, b, a) for b in (",", ", ", " ,", ",  ", ",\n", ",,", "") for a in (":", ": ", " :", ":\t", "")]
    found += [f" {usual}", f"{usual} ", f"{usual}\n", f"{usual}x", f"{usual}{usual}", f"{usual},1", f"[{usual}]", usual[:-1], usual[1:]]
    found += [text({name: tokens[name] for name in tokens if name != left}) for left in tokens]
    found += [text({**tokens, "extra": "1"}), text(dict(reversed(tokens.items()))), usual[:-1] + ',"seq":2}', "", "null", "{}", "1"]
    found += [usual.replace('"vin"', '"VIN"'), usual.replace('"vin"', '"v\\u0069n"'), usual.replace('"vin"', "vin"), usual.replace('"', "'")]
    swapped = {**tokens, "fuel_pct": "null", "soc_pct": "55.5"}
    found += [text(swapped), text({**tokens, "soc_pct": "55.5"}), text({**tokens, "fuel_pct": "null"})]
    whole = [t.encode() for t in found]
    return [*whole, whole[0][:-5] + b"\xff" + whole[0][-5:], usual.encode().replace(b"Tata", b"T\xc3\x28a"), b"\xef\xbb\xbf" + usual.encode(), None]


def test_plain_texts_say_what_all_parsers_say(spark, monkeypatch):
    """A text in the usual spelling skips parsers and rules, and nothing else about it changes."""
    bodies = spellings()

    def parsed():
        rows = parse_telemetry(records(spark, bodies), START + timedelta(days=400)).orderBy("offset")
        rows = rows.withColumn("timestamp", F.unix_micros("timestamp"))  # Python knows no year 0
        return [tuple(r) for r in rows.drop("topic", "partition", "timestamp_ms").collect()]

    plain = records(spark, bodies).where(F.col("value").cast("string").rlike(validate.PLAIN)).count()
    by_spelling = parsed()
    monkeypatch.setattr(validate, "PLAIN", "(?!)")
    in_full = parsed()
    assert 200 < plain < len(bodies) - 300
    for body, one, other in zip(bodies, by_spelling, in_full, strict=True):
        assert repr(one) == repr(other), body
    assert 100 < sum(row[-2] for row in in_full) < len(bodies)
