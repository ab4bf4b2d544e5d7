"""The live job: outcomes, crash recovery, state expiry, and stream = batch."""

from __future__ import annotations

import threading
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import fleetspark.sources.paths as live_paths
import fleetspark.streaming.live as live
import fleetspark.streaming.seen as seen
from fleetspark.operators import detect as d
from fleetspark.operators.state import as_carried, latest_state, with_carried
from fleetspark.operators.tables import read_history
from fleetspark.operators.validate import parse_telemetry, valid_readings
from fleetspark.schema import ACTIVITY
from fleetspark.streaming.raw import read_activity, start_activity, start_archive, upsert_activity
from fleetspark.settings import StreamOptions
from fleetspark.streaming.sources import FileSource, read_telemetry_stream, retained_offsets
from fleetspark.sources.archive import read_archive
from fleetspark.workload import queries
from tests.build import START, TOPIC, at, base, by_event, frame, payload, records
from tests.test_detect import random_readings


def feed(spark, path, batches):
    """One file per batch, in order."""
    start = 0
    for batch in batches:
        rows = records(spark, batch, start=start)
        rows.coalesce(1).sortWithinPartitions("offset").write.mode("append").parquet(str(path))
        start += len(batch)
    return FileSource(str(path))


def drain(spark, source, root, **kwargs):
    query = live.start_live(
        read_telemetry_stream(spark, source),
        f"{root}/tables",
        f"{root}/checkpoint",
        drain=True,
        **kwargs,
    )
    query.awaitTermination()
    return query


def test_outcomes_and_resend(spark, tmp_path):
    body = payload(base(speed_kmh=130.0, dtc=["P0301"]))
    source = feed(spark, tmp_path / "in", [[body, body, b"{invalid"], [body]])
    drain(spark, source, tmp_path)
    tables = f"{tmp_path}/tables"
    assert live.live_outcomes(spark, tables).first().asDict() == {
        "consumed": 4,
        "invalid": 1,
        "accepted": 1,
        "late": 0,
        "alerts": 2,
        "duplicates": 2,
    }
    assert live.read_state(spark, tables).first()["speed_kmh"] == 130.0


def test_outcomes_survive_a_restart(spark, tmp_path):
    """Each batch's row is exact, although the second query knows nothing of the first's progress."""
    bodies = [payload(at(t, speed_kmh=130.0)) for t in range(6)]
    feed(spark, tmp_path / "in", [bodies[:2] + [b"no"], [bodies[1], bodies[2]]])
    drain(spark, FileSource(str(tmp_path / "in")), tmp_path)
    rows = records(spark, [bodies[0], bodies[3], None], start=5)
    rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    drain(spark, FileSource(str(tmp_path / "in")), tmp_path)
    found = live.read_outcomes(spark, f"{tmp_path}/tables").orderBy("batch_id").collect()
    assert [(r["consumed"], r["accepted"], r["duplicates"], r["invalid"]) for r in found] == [
        (3, 2, 0, 1), (2, 1, 1, 0), (3, 1, 1, 1),
    ]
    total = live.live_outcomes(spark, f"{tmp_path}/tables").first()
    assert total["consumed"] == total["accepted"] + total["duplicates"] + total["invalid"] == 8


def test_first_arrival_of_copies_in_any_file(spark, tmp_path):
    """Copies of one id in one batch, in two partitions and files: the first place wins."""
    kept = at(0, speed_kmh=10.0)
    other = {**kept, "speed_kmh": 20.0}
    for partition, start, row in [(3, 0, other), (1, 7, other), (1, 2, kept), (2, 0, other)]:
        one = records(spark, [payload(row)], partition, start)
        one.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    drain(spark, FileSource(str(tmp_path / "in"), files_per_batch=4), tmp_path)
    (stored,) = read_history(spark, f"{tmp_path}/tables", "telemetry").collect()
    assert stored["speed_kmh"] == 10.0
    assert live.live_outcomes(spark, f"{tmp_path}/tables").first()["duplicates"] == 3


def test_seen_ids_expire_fold_and_ignore_the_batch_itself(spark, tmp_path):
    root, now = str(tmp_path), START
    rows = frame(spark, [at(t) for t in range(40)])

    def fresh(batch_id, as_of):
        return seen.drop_seen_ids(rows, root, batch_id, as_of).count()

    assert fresh(0, now) == 40
    seen.write_seen(rows.where("seq <= 10"), root, 0, now)
    seen.write_seen(rows.where("seq < 25"), root, 1, now)
    left = 16
    assert (fresh(0, now), fresh(1, now), fresh(2, now)) == (40, 30, left)
    for hours in (1, 5):
        seen.tidy_seen(spark, root, now + timedelta(hours=hours))
        folder = f"{root}/seen/{live_paths.child_names(spark, f'{root}/seen')[0]}"
        assert [n[:9] for n in live_paths.child_names(spark, folder)] == ["part=fold"]
        assert fresh(1, now + timedelta(hours=hours)) == 30 and fresh(2, now + timedelta(hours=hours)) == left
    assert fresh(2, now + timedelta(hours=24)) == 40
    seen.tidy_seen(spark, root, now + timedelta(hours=26))
    assert live_paths.child_names(spark, f"{root}/seen") == []


def test_only_touched_buckets_and_vehicles(spark, tmp_path, monkeypatch):
    """Absent vehicles meet no window, and their buckets are neither read nor written."""
    entered, carried = [], live.with_carried

    def watched(readings, state, as_of):
        entered.append(sorted(r["vehicle_id"] for r in state.select("vehicle_id").collect()))
        return carried(readings, state, as_of)

    monkeypatch.setattr(live, "with_carried", watched)
    root = str(tmp_path)
    fleet = [at(0, vehicle_id=f"V{v:06d}", speed_kmh=0.0) for v in range(200)]
    live.commit_batch(records(spark, [payload(r) for r in fleet]), 0, root, as_of=START)
    second = [at(5, vehicle_id="V000007", speed_kmh=0.0), at(5, vehicle_id="V000150", speed_kmh=0.0)]
    live.commit_batch(records(spark, [payload(r) for r in second], start=500), 1, root, as_of=START)
    assert entered == [[], ["V000007", "V000150"]]
    wrote = live_paths.child_names(spark, f"{root}/state/version=1")
    assert 1 <= len(wrote) <= 2 and len(live_paths.child_names(spark, f"{root}/state/version=0")) > 2
    states = {r["vehicle_id"]: r for r in live.read_state(spark, root).collect()}
    assert len(states) == 200 and states["V000007"]["idle_duration_seconds"] == 5.0
    assert states["V000008"]["idle_duration_seconds"] == 0.0
    assert live.read_state(spark, root, before=1).where("vehicle_id = 'V000007'").first()["idle_duration_seconds"] == 0.0
    for batch in range(2, 7):
        more = [at(5 + batch, vehicle_id="V000007", speed_kmh=0.0)]
        live.commit_batch(records(spark, [payload(r) for r in more], start=600 + batch), batch, root, as_of=START)
    assert live.read_state(spark, root).count() == 200
    assert live_paths.child_names(spark, f"{root}/state") == [f"version={v}" for v in (0, 1, 4, 5, 6)]


@pytest.mark.parametrize("step", ["write_history", "latest_state", "write_state"])
def test_failed_batch_is_repeated(spark, tmp_path, monkeypatch, step):
    rows = [at(t, speed_kmh=0.0) for t in range(30)]
    bodies = [payload(r) for r in rows]
    source = feed(spark, tmp_path / "in", [bodies[:15], bodies[15:]])
    work, calls = getattr(live, step), []

    def fails_once(*args, **kwargs):
        calls.append(1)
        result = work(*args, **kwargs)
        if len(calls) == 3:
            raise RuntimeError("injected failure")
        return result

    monkeypatch.setattr(live, step, fails_once)
    if step == "write_history":
        with pytest.raises(StreamingQueryException, match="injected"):
            drain(spark, source, tmp_path)
    else:
        calls.append(1)
        with pytest.raises(StreamingQueryException, match="injected"):
            drain(spark, source, tmp_path)
    drain(spark, source, tmp_path)
    tables = f"{tmp_path}/tables"
    stored = by_event(read_history(spark, tables, "telemetry"))
    assert read_history(spark, tables, "telemetry").count() == 30
    assert sum(r["idling_seconds"] for r in stored.values()) == 29
    assert read_history(spark, tables, "alerts").count() == 1


def test_new_checkpoint_on_old_tables_is_refused(spark, tmp_path):
    source = feed(spark, tmp_path / "in", [[payload(base())]])
    drain(spark, source, tmp_path)
    with pytest.raises(ValueError, match="another checkpoint"):
        live.start_live(
            read_telemetry_stream(spark, source), f"{tmp_path}/tables", f"{tmp_path}/other"
        )


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_stream_equals_batch(spark, tmp_path, parts):
    rows = random_readings(600, 6, seed=21)
    bodies = [payload(r) for r in rows]
    size = -(-len(bodies) // parts)
    source = feed(spark, tmp_path / "in", [bodies[i : i + size] for i in range(0, len(bodies), size)])
    drain(spark, source, tmp_path, clock=lambda: START, block_rows=50)
    tables = f"{tmp_path}/tables"
    detected = d.detect(valid_readings(parse_telemetry(records(spark, bodies)))).persist()

    def same(stored, batch):
        names = [c for c in batch.columns if c != "received_at"]
        assert sorted(map(repr, stored.select(names).collect())) == sorted(
            map(repr, batch.select(names).collect())
        )

    same(read_history(spark, tables, "telemetry"), d.enrich(detected))
    same(read_history(spark, tables, "alerts"), d.open_incidents(detected))
    same(live.read_state(spark, tables), latest_state(detected, START))


def test_state_older_than_an_hour_is_forgotten(spark):
    state = latest_state(d.detect(frame(spark, [at(0, speed_kmh=0.0)])), START)
    within = as_carried(state, START + timedelta(hours=1))
    assert within.count() == 1
    assert as_carried(state, START + timedelta(hours=1, seconds=1)).count() == 0
    next_rows = frame(spark, [at(-5, speed_kmh=0.0, seq=0)])
    assert d.new_rows(d.detect(with_carried(next_rows, state, START))).first()["late"]
    expired = with_carried(next_rows, state, START + timedelta(hours=2))
    assert not d.new_rows(d.detect(expired)).first()["late"]


def test_archive_stream_keeps_everything(spark, tmp_path):
    body = payload(base())
    source = feed(spark, tmp_path / "in", [[body, b"not json"], [body, None]])
    start_archive(
        read_telemetry_stream(spark, source),
        f"{tmp_path}/archive",
        TOPIC,
        f"{tmp_path}/checkpoint",
        drain=True,
    ).awaitTermination()
    rows = read_archive(spark, f"{tmp_path}/archive")
    assert rows.count() == 4
    assert rows.where("valid").count() == 2
    assert rows.agg(F.max("snapshot")).first()[0] == 2


def test_evicted_minutes_stay_in_the_table(spark, tmp_path):
    """State holds the minutes that readings can still reach, the table all of them."""
    start, rows = datetime(2026, 9, 27), []
    for minute in range(300):
        rows += [(start + timedelta(minutes=minute, seconds=s), "NORMAL", float(s)) for s in (0, 30)]
    schema = "timestamp timestamp, event_type string, speed_kmh double"
    for i in range(6):
        part = spark.createDataFrame(rows[i * 100 : (i + 1) * 100], schema)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = start_activity(stream, f"{tmp_path}/tables", f"{tmp_path}/checkpoint", lateness="10 minutes", drain=True)
    query.awaitTermination()
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(held) <= 130 < 300
    found = read_activity(spark, f"{tmp_path}/tables").collect()
    assert len(found) == 300 and all((r["events"], r["average_speed_kmh"]) == (2, 15.0) for r in found)


def test_changed_minutes_replace_their_own(spark, tmp_path):
    def changed(*rows):
        return spark.createDataFrame([(datetime(2026, 9, day, 5, m), k, n, 1.0) for day, m, k, n in rows], ACTIVITY)

    root = str(tmp_path)
    upsert_activity(changed((1, 0, "A", 1), (1, 0, "B", 1), (2, 5, "A", 1)), root, 0)
    for _ in range(2):
        upsert_activity(changed((1, 0, "A", 7)), root, 1)
    found = {(r["minute"].day, r["event_type"]): r["events"] for r in read_activity(spark, root).collect()}
    assert found == {(1, "A"): 7, (1, "B"): 1, (2, "A"): 1}
    assert len(live_paths.child_names(spark, f"{root}/activity/version=1")) == 1


def test_archive_out_of_retention_does_not_start(spark, tmp_path):
    source = feed(spark, tmp_path / "in", [[payload(base())] * 5])
    target, checkpoint = f"{tmp_path}/archive", f"{tmp_path}/checkpoint"

    def start(path, checkpoint):
        held = retained_offsets(spark, FileSource(str(path)))
        stream = read_telemetry_stream(spark, FileSource(str(path)))
        start_archive(stream, target, TOPIC, checkpoint, drain=True, retained=held).awaitTermination()

    start(source.path, checkpoint)
    late = records(spark, [payload(base())] * 3, start=9).coalesce(1)
    late.write.parquet(str(tmp_path / "late"))
    with pytest.raises(Exception, match="retained range"):
        start(tmp_path / "late", f"{checkpoint}-late")
    assert read_archive(spark, target).count() == 5
    records(spark, [payload(base())] * 4, start=3).coalesce(1).write.parquet(str(tmp_path / "next"))
    start(tmp_path / "next", f"{checkpoint}-next")
    assert read_archive(spark, target).count() == 7


def test_files_honour_the_rows_of_a_batch(spark, tmp_path):
    source = feed(spark, tmp_path / "in", [[payload(base())] * 2] * 6)
    by_rows = FileSource(source.path, file_rows=2)
    stream = read_telemetry_stream(spark, by_rows, StreamOptions(rows=5))
    query = start_archive(stream, f"{tmp_path}/archive", TOPIC, f"{tmp_path}/checkpoint", drain=True)
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [4, 4, 4]


def test_a_small_batch_leaves_few_files(spark, tmp_path):
    """However many shuffle partitions the session has, a batch uses what its rows fill."""
    name, configured = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set(name, str(8 * cores))
    try:
        fleet = [at(0, vehicle_id=f"V{v:06d}", speed_kmh=130.0) for v in range(300)]
        live.commit_batch(records(spark, [payload(r) for r in fleet]), 0, str(tmp_path), as_of=START)
        assert spark.conf.get(name) == str(8 * cores)
    finally:
        spark.conf.set(name, configured)
    for table in ("telemetry", "alerts"):
        assert read_history(spark, str(tmp_path), table).count() == 300
        assert 1 <= len(list(tmp_path.glob(f"{table}/batch_id=0/month=*/*.parquet"))) <= cores


def test_steps_run_side_by_side_and_end_before_an_error(spark):
    met, ended = threading.Barrier(2), []

    def first():
        met.wait(timeout=60)
        return spark.range(7).count()

    def second():
        met.wait(timeout=60)
        return spark.range(5).count()

    assert live.side_by_side(spark, first, second) == [7, 5]

    def fails():
        raise RuntimeError("injected")

    with pytest.raises(RuntimeError, match="injected"):
        live.side_by_side(spark, fails, lambda: ended.append(spark.range(3).count()))
    assert ended == [3]


def test_the_feed_is_written_once_and_delivered_by_ranges(spark, tmp_path, monkeypatch):
    """A range's files come later than those before, one a source partition, by rising offset."""
    written, taken = [], queries.m.records_in_ranges

    def spied(*args):
        written.append(args[2:])
        return taken(*args)

    monkeypatch.setattr(queries.m, "records_in_ranges", spied)
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=i), i % 29, "click", 50.0, '{"k": 5}') for i in range(600)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    before, times, offsets = set(), [], []
    for source in queries.fed(spark, str(tmp_path), 3):
        files = set(Path(source.path).glob("partition=*/*.parquet")) - before
        before |= files
        times.append({f.stat().st_mtime_ns for f in files})
        assert len(files) == len({f.parent for f in files}) == 6
        held = [spark.read.parquet(str(f)).select("offset").collect() for f in sorted(files)]
        held = [[r["offset"] for r in one] for one in held]
        assert all(one == sorted(one) for one in held)
        offsets.append(sorted(sum(held, [])))
    assert len(written) == 1 and times[0] != times[1] and max(times[0]) < min(times[1]) <= max(times[1]) < min(times[2])
    assert offsets[0][-1] < offsets[1][0] and offsets[1][-1] < offsets[2][0]
    stored = spark.read.parquet(source.path).select("topic", "partition", "offset", "value", "timestamp_ms")
    whole = queries.m.records(spark, str(tmp_path)).select(stored.columns)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, whole.collect()))
