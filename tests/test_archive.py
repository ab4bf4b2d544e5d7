"""Raw archive: snapshots, replay, time travel, ordering, recovery."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest

import fleetspark.sources.archive as archive
from fleetspark.settings import StreamOptions
from tests.build import START, TOPIC, base, payload, records

DAY_MS = 86_400_000
RECEIVED = 1790467200000
BODY = payload(base())


def append(rows, root, **kwargs):
    return archive.append_archive(rows, str(root), TOPIC, START, **kwargs)


def test_bytes_partitions_and_checkpoints(spark, tmp_path):
    rows = (
        records(spark, [BODY], 0, 0)
        .unionByName(records(spark, [b"not json"], 1, 0))
        .unionByName(records(spark, [BODY], 0, 1, RECEIVED + DAY_MS))
    )
    result = append(rows, tmp_path)
    assert (result["written"], result["invalid"]) == (3, 1)
    stored = archive.read_archive(spark, str(tmp_path)).collect()
    assert {bytes(r["raw_payload"]) for r in stored} == {BODY, b"not json"}
    assert len({r["received_day"] for r in stored}) == 2
    (bad,) = [r for r in stored if not r["valid"]]
    assert bad["validation_error"] == "json_invalid" and bad["event_id"] is None
    status = {r["partition"]: r for r in archive.archive_status(spark, str(tmp_path)).collect()}
    assert (status[0]["start_offset"], status[0]["next_offset"]) == (0, 2)
    assert status[1]["next_offset"] == 1


def test_replay_and_time_travel(spark, tmp_path):
    first = append(records(spark, [BODY]), tmp_path)
    assert append(records(spark, [BODY]), tmp_path) == {
        "written": 0,
        "invalid": 0,
        "replayed": 1,
        "snapshot_id": first["snapshot_id"],
    }
    append(records(spark, [BODY, BODY]), tmp_path)
    assert archive.read_archive(spark, str(tmp_path)).count() == 2
    old = archive.read_archive(spark, str(tmp_path), first["snapshot_id"])
    found = archive.query_archive(old, "V000001", "2026-09-27T00:00:00Z", "2026-09-28T00:00:00Z")
    assert found.count() == 1 and "raw_payload" not in found.columns
    assert archive.archive_snapshots(spark, str(tmp_path)).count() == 2
    for unknown in (0, 3):
        with pytest.raises(ValueError, match="does not exist"):
            archive.read_archive(spark, str(tmp_path), unknown)


def test_failed_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    append(records(spark, [BODY]), tmp_path)

    def fail(*args):
        raise RuntimeError("injected")

    with monkeypatch.context() as patch:
        patch.setattr(archive, "_name", fail)
        with pytest.raises(RuntimeError, match="injected"):
            append(records(spark, [BODY] * 3, start=1), tmp_path)
    assert archive.read_archive(spark, str(tmp_path)).count() == 1
    assert append(records(spark, [BODY] * 2, start=1), tmp_path)["written"] == 2
    assert archive.read_archive(spark, str(tmp_path)).count() == 3


def test_refusals_change_nothing(spark, tmp_path):
    with pytest.raises(ValueError, match="negative"):
        append(records(spark, [BODY], partition=-1), tmp_path)
    with pytest.raises(ValueError, match="another topic"):
        archive.append_archive(records(spark, [BODY]), str(tmp_path), "other", START)
    falling = records(spark, [BODY, BODY]).selectExpr("*", "1 - offset AS position")
    with pytest.raises(ValueError, match="order"):
        append(falling, tmp_path, position="position")
    assert archive.current_snapshot(spark, str(tmp_path)) is None
    assert append(records(spark, []), tmp_path)["written"] == 0
    assert archive.current_snapshot(spark, str(tmp_path)) is None


def test_repeated_offset_in_a_batch_and_gaps(spark, tmp_path):
    rows = records(spark, [BODY]).unionByName(records(spark, [BODY])).unionByName(records(spark, [BODY], start=7))
    assert append(rows, tmp_path)["written"] == 2
    assert archive.archive_status(spark, str(tmp_path)).first()["next_offset"] == 8


def flushes(spark, root):
    """(records, bytes) added by each snapshot, and offsets by partition in snapshot order."""
    rows = archive.read_archive(spark, str(root)).orderBy("snapshot", "source_partition", "source_offset").collect()
    sizes, offsets = {}, {}
    for row in rows:
        n, size = sizes.get(row["snapshot"], (0, 0))
        sizes[row["snapshot"]] = (n + 1, size + len(row["raw_payload"] or b""))
        offsets.setdefault(row["source_partition"], []).append(row["source_offset"])
    return sizes, offsets


@pytest.mark.parametrize("limit", [1, 7, 40, 100, 1 << 20])
def test_flush_by_bytes(spark, tmp_path, limit):
    dice = random.Random(limit)
    bodies = [[dice.choice([None, b"", b"x" * dice.randrange(1, 60)]) for _ in range(60)] for _ in range(3)]
    rows = records(spark, bodies[0], 0)
    for partition in (1, 2):
        rows = rows.unionByName(records(spark, bodies[partition], partition, start=9 * partition))
    result = append(rows.repartition(4), tmp_path, options=StreamOptions(bytes=limit))
    assert (result["written"], result["replayed"]) == (180, 0)
    sizes, offsets = flushes(spark, tmp_path)
    assert list(sizes) == list(range(1, result["snapshot_id"] + 1))
    assert all(size <= limit or n == 1 for n, size in sizes.values())
    total = sum(size for _, size in sizes.values())
    assert len(sizes) <= 1 + 5 * total // limit
    for partition, found in offsets.items():
        assert found == sorted(found) == list(range(9 * partition, 9 * partition + 60))
    snapshots = {r["snapshot"]: r["records"] for r in archive.archive_snapshots(spark, str(tmp_path)).collect()}
    assert snapshots[result["snapshot_id"]] == 180 and sorted(snapshots.values()) == list(snapshots[k] for k in sorted(snapshots))
    assert append(rows, tmp_path, options=StreamOptions(bytes=limit))["written"] == 0


def test_flush_by_rows(spark, tmp_path):
    rows = records(spark, [BODY] * 25, 0).unionByName(records(spark, [BODY] * 30, 1))
    append(rows, tmp_path, options=StreamOptions(rows=10))
    sizes, _ = flushes(spark, tmp_path)
    assert sum(n for n, _ in sizes.values()) == 55 and max(n for n, _ in sizes.values()) <= 10


def test_repeated_append_continues_after_the_last_commit(spark, tmp_path, monkeypatch):
    rows = records(spark, [b"x" * 50] * 12)
    name, calls = archive._name, []

    def fails_later(snapshot_id):
        calls.append(snapshot_id)
        if snapshot_id == 3:
            raise RuntimeError("injected")
        return name(snapshot_id)

    with monkeypatch.context() as patch:
        patch.setattr(archive, "_name", fails_later)
        with pytest.raises(RuntimeError, match="injected"):
            append(rows, tmp_path, options=StreamOptions(bytes=200))
    kept = archive.read_archive(spark, str(tmp_path)).count()
    assert archive.current_snapshot(spark, str(tmp_path)) == 2 and 0 < kept < 12
    assert append(rows, tmp_path, options=StreamOptions(bytes=200))["written"] == 12 - kept
    assert flushes(spark, tmp_path)[1] == {0: list(range(12))}


def test_first_of_equal_offsets(spark, tmp_path):
    rows = (
        records(spark, [b"second"], timestamp_ms=RECEIVED + 5)
        .unionByName(records(spark, [b"first"], timestamp_ms=RECEIVED))
        .unionByName(records(spark, [b"alone"], start=1))
    )
    assert append(rows, tmp_path)["replayed"] == 1
    assert {bytes(r["raw_payload"]) for r in archive.read_archive(spark, str(tmp_path)).collect()} == {b"first", b"alone"}
    placed = records(spark, [b"b", b"a"]).selectExpr("topic", "partition", "0L AS offset", "value", "timestamp_ms", "offset AS place")
    assert [bytes(r["value"]) for r in archive.first_of_equal(placed, "place").collect()] == [b"b"]


def test_payloads_are_not_shuffled_without_repeats(spark):
    rows = records(spark, [BODY] * 5)
    saved = spark.createDataFrame([(0, 2)], "partition int, next_offset long")
    fresh = archive.skip_replayed(rows, saved)
    assert fresh.count() == 3 and "Exchange hash" not in fresh._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("saved,start", [(None, 10), (15, 15), (20, 20), (9, None), (21, None)])
def test_starting_offset(spark, saved, start):
    row = spark.createDataFrame([(0, saved, 10, 20)], "partition int, saved long, low long, high long")
    if start is None:
        with pytest.raises(Exception, match="retained range"):
            archive.check_offset_range(row).collect()
    else:
        assert archive.check_offset_range(row).first()["start_offset"] == start


def test_lookup_arguments(spark, tmp_path):
    append(records(spark, [BODY]), tmp_path)
    rows = archive.read_archive(spark, str(tmp_path))
    good = ("V000001", "2026-09-27T00:00:00Z", "2026-09-28T00:00:00Z")
    for bad in (
        ("V1", *good[1:], 10),
        (*good, 0),
        (*good, 1001),
        (good[0], "2026-09-27T00:00:00", good[2], 10),
        (good[0], good[2], good[1], 10),
    ):
        with pytest.raises(ValueError):
            archive.query_archive(rows, *bad)
    end = (START + timedelta(0)).isoformat()
    assert archive.query_archive(rows, "V000001", "2026-09-26T00:00:00Z", end).count() == 0
