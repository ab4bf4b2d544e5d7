"""The live job: readings in, history, incidents and latest state out (ST1-ST4, S7, S8).

Each micro-batch keeps the first arrival of every id it has not accepted within a day, and runs
the batch detectors over them, preceded by the stored state of each of its vehicles; what they
leave is the next state. Batch and stream therefore share every rule, and a vehicle that floods a
batch is cut like any other. Outputs are addressed by batch id:

    <root>/telemetry|alerts/batch_id=<n>/month=*    written first
    <root>/seen/hour=<h>/part=<n>                   accepted ids
    <root>/outcomes/batch_id=<n>                    what became of the batch
    <root>/state, <root>/state_versions             written last

A batch that failed half-way is repeated from what batches before it left, and overwrites its own
output.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetspark.operators.dedup import dedup_first
from fleetspark.operators.detect import DEFAULTS, detect, enrich, new_rows, open_incidents
from fleetspark.operators.outcomes import OUTCOMES
from fleetspark.operators.state import latest_state, with_carried
from fleetspark.operators.tables import write_history
from fleetspark.operators.validate import parse_telemetry, valid_readings
from fleetspark.plans.even import in_even_tasks, partitions_for_rows
from fleetspark.plans.ordered import BLOCK_ROWS
from fleetspark.schema import ARRIVAL, ENRICHED_COLUMNS, STATE, TELEMETRY_COLUMNS
from fleetspark.settings import DetectorSettings, StreamOptions
from fleetspark.sources.paths import exists
from fleetspark.streaming.buckets import bucket_versions, read_state, state_bucket, write_state
from fleetspark.streaming.seen import drop_seen_ids, tidy_seen, write_seen
from fleetspark.streaming.sources import flush_rule

READING_COLUMNS = [*TELEMETRY_COLUMNS, *ARRIVAL.fieldNames()]
# What history, incidents and states are made of.
DETECTED_COLUMNS = [
    *ENRICHED_COLUMNS, "idle", "idle_start", "idle_duration_seconds", "acceleration_mps2", "opened_types", "carried",
]
_OUTCOME = ", ".join(f"{name} long" for name in OUTCOMES)


def wall_clock() -> datetime:
    return datetime.now(timezone.utc)


def commit_batch(
    records: DataFrame,
    batch_id: int,
    root: str,
    settings: DetectorSettings = DEFAULTS,
    *,
    as_of: datetime,
    block_rows: int | None = BLOCK_ROWS,
) -> None:
    """One micro-batch of records: first arrivals, detection, then all tables (ST2-ST4, A7).

    Of copies in the batch the first arrival stays, whatever partition or file it came by. Only
    states of the batch's vehicles enter detection; those of other vehicles in the same buckets
    are copied, the rest is not read. State older than an hour of processing time does not count.
    """
    spark = records.sparkSession
    # As many tasks as cores, however few files or topic partitions the batch came by.
    parsed = parse_telemetry(in_even_tasks(records, 0), F.current_timestamp())
    # Payloads are not looked at again.
    parsed = parsed.select(*READING_COLUMNS, "valid").persist()
    held = [parsed]
    try:
        intake = parsed.agg(
            F.count(F.lit(1)).alias("consumed"), F.count_if(~F.col("valid")).alias("invalid")
        ).first()
        if not intake["consumed"]:
            return
        with partitions_for_rows(spark, intake["consumed"]):
            _commit_parsed(parsed, intake.asDict(), held, batch_id, root, settings, as_of, block_rows)
    finally:
        for frame in held:
            frame.unpersist()
    tidy_seen(spark, root, as_of)


def _commit_parsed(
    parsed: DataFrame,
    intake: dict,
    held: list[DataFrame],
    batch_id: int,
    root: str,
    settings: DetectorSettings,
    as_of: datetime,
    block_rows: int | None,
) -> None:
    """The rest of `commit_batch`; frames it stores are added to `held`."""
    spark = parsed.sparkSession
    valid = valid_readings(parsed)
    readings = drop_seen_ids(dedup_first(valid), root, batch_id, as_of, stored=valid).persist()
    held.append(readings)
    found = readings.agg(F.count(F.lit(1)).alias("accepted"), F.collect_set(state_bucket()).alias("buckets")).first()
    accepted, touched = found["accepted"], found["buckets"]
    if block_rows is not None and accepted <= block_rows:
        block_rows = None
    vehicles = readings.select("vehicle_id").distinct()
    stored = read_state(spark, root, before=batch_id, buckets=touched)
    rows = with_carried(readings, stored.join(vehicles, "vehicle_id", "left_semi"), as_of)
    detected = detect(rows, settings, block_rows=block_rows, counted=readings)
    detected = detected.select(*[c for c in DETECTED_COLUMNS if c in detected.columns]).persist()
    held.append(detected)
    found = new_rows(detected).agg(
        F.count_if("late").alias("late"), F.coalesce(F.sum(F.size("opened_types")), F.lit(0)).alias("alerts")
    ).first()
    outcome = {
        **intake, **found.asDict(), "accepted": accepted,
        "duplicates": intake["consumed"] - intake["invalid"] - accepted,
    }

    def next_state() -> DataFrame:
        state = latest_state(detected, as_of, settings).select(*STATE.fieldNames())
        others = stored.join(vehicles, "vehicle_id", "left_anti")
        merged = state.unionByName(others).persist()
        held.append(merged)
        merged.count()
        return merged

    def histories() -> None:
        write_history(enrich(detected), root, "telemetry", batch_id)
        write_history(open_incidents(detected, settings), root, "alerts", batch_id)

    # Each fills the cores that the others' last tasks leave; the state's version is written last.
    *_, state = side_by_side(
        spark,
        histories,
        lambda: write_seen(readings, root, batch_id, as_of),
        lambda: write_outcome(spark, outcome, root, batch_id),
        *([next_state] if accepted else []),
    )
    if accepted:
        write_state(state, root, batch_id, touched)


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What each step returns; all run at once, and all have ended when one's error is raised."""
    with ThreadPoolExecutor(len(steps)) as threads:
        # The stream's job group goes along, so that stopping it ends these jobs too.
        running = [threads.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def write_outcome(spark: SparkSession, outcome: dict, root: str, batch_id: int) -> None:
    """What became of a batch, as one row addressed by its id."""
    row = spark.createDataFrame([tuple(outcome[name] for name in OUTCOMES)], _OUTCOME)
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/outcomes/batch_id={int(batch_id)}")


def start_live(
    records: DataFrame,
    root: str,
    checkpoint: str,
    settings: DetectorSettings = DEFAULTS,
    options: StreamOptions = StreamOptions(),
    *,
    clock: Callable[[], datetime] = wall_clock,
    drain: bool = False,
    block_rows: int | None = BLOCK_ROWS,
) -> StreamingQuery:
    """Run the live job. Offsets are committed by Spark only after a batch's state is written."""
    spark = records.sparkSession
    if bucket_versions(spark, root, "state") and not exists(spark, checkpoint):
        raise ValueError("tables were written with another checkpoint; use it or a new folder")

    def commit(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch, batch_id, root, settings, as_of=clock(), block_rows=block_rows)

    writer = (
        records.writeStream.queryName("live")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(commit)
    )
    return flush_rule(writer, options, drain=drain).start()


def read_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """Consumed, accepted, duplicates, invalid, late and alerts of each batch.

    The rows lie beside the tables, so they outlive the query, its progress and any folding.
    """
    path = f"{root}/outcomes"
    if not exists(spark, path):
        return spark.createDataFrame([], f"{_OUTCOME}, batch_id long")
    return spark.read.schema(f"{_OUTCOME}, batch_id long").option("basePath", path).parquet(path)


def live_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """What became of everything the job ever read, over all its restarts."""
    return read_outcomes(spark, root).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in OUTCOMES])
