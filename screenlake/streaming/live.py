"""Streams of status lists and results.

Batches go into tables with one row per key (see `upsert`), so they may run once, in turn or for ever: the
number of folders stays small, and a batch that is run again changes nothing. State is kept in RocksDB, on the
executors' disks, and saved with the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from screenlake import fixed_values as fv
from screenlake import schemas
from screenlake.functions.status import outcome_of
from screenlake.operators.summary import LIGAND_KEYS
from screenlake.sources.text import collection_from
from screenlake.streaming.upsert import Rules, read_upserted, upsert

# What is there now, then stop. {"processingTime": "1 minute"} goes on for ever.
ONCE = {"availableNow": True}
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

FINAL = f"status <> '{fv.PROCESSING}'"
# At equal times an outcome replaces `processing`; of running tasks the latest report counts.
STATE_RULES = Rules(tuple(schemas.TASK_KEYS), ("ts", FINAL, "status", "as_of"), ("first_ts",))


def status_stream(spark: SparkSession, path: str, fmt: str = "jsonl", max_files: int | None = None) -> DataFrame:
    """New status files below `path`, each read once; a missing one is picked up later.

    fmt: `jsonl` lines in `collection=...` folders, or `json` lists in `<tranche>/<ID>.json.gz`. A batch has at
    most `max_files` files.
    """
    reader = spark.readStream if max_files is None else spark.readStream.option("maxFilesPerTrigger", max_files)
    if fmt == "jsonl":
        return reader.schema(f"collection STRING, {schemas.STATUS_JSON}").json(path)
    lists = reader.schema(schemas.STATUS_JSON).option("recursiveFileLookup", "true")
    return lists.json(path, multiLine=True).select(collection_from(F.col("_metadata.file_path")).alias("collection"), "*")


def _start(changes: DataFrame, table: str, rules: Rules, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    spark = changes.sparkSession
    writer = (
        changes.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: upsert(batch, batch_id, table, rules))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE))
    )
    # A query takes the settings of its session when it starts.
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def read_changes(spark: SparkSession, table: str, keys: list[str]) -> DataFrame:
    """Newest row per key of a table written by `stream_outcomes` or `stream_summary`."""
    return read_upserted(spark, table, Rules(tuple(keys)))


def stream_outcomes(events: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Outcome counters per collection; read with `read_changes(..., ["collection"])`."""
    outcome = outcome_of(F.col("status"))
    counted = events.groupBy("collection").agg(*(F.count_if(outcome == o).alias(o) for o in fv.OUTCOMES))
    return _start(counted, table, Rules(("collection",)), checkpoint, trigger)


def stream_summary(results: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Running avg, best, worst and n per ligand as replicas finish; read with `read_changes(..., LIGAND_KEYS)`."""
    running = (
        results.where(F.col("score").isNotNull()).groupBy(*LIGAND_KEYS)
        .agg(
            F.sum("score").alias("score_sum"),
            F.min("score").alias("best"),
            F.max("score").alias("worst"),
            F.count("score").alias("n"),
        )
        .select(
            *LIGAND_KEYS,
            (F.col("score_sum").cast("double") / F.col("n")).alias("avg_score"),
            F.col("best").cast("double").alias("best_score"),
            F.col("worst").cast("double").alias("worst_score"),
            F.col("n").cast("int").alias("n_dockings"),
        )
    )
    return _start(running, table, Rules(tuple(LIGAND_KEYS)), checkpoint, trigger)


class TaskStates(StatefulProcessor):
    """State of the tasks that run: when each was first and last heard of, and its status.

    A final status ends the state: the row it gives is the last, and rows that come later are rows of their own,
    which the table's rules sort in. A task that still runs is reported every `report_ms`, and forgotten
    when nothing was heard of it for `forget_ms`.
    """

    def __init__(self, report_ms: int | None, forget_ms: int | None):
        self.report_ms, self.forget_ms = report_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("task", "first_ts LONG, ts LONG, status STRING, heard_ms LONG")

    def _report(self, key, first, last, status, now: int | None = None) -> Row:
        return Row(key=key[0], status=status, ts=last, first_ts=first, as_of=None if now is None else now * 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Null where there is no state; every call goes to the JVM and back.
        known = self.state.get()
        seen = [(known[1], known[2] != fv.PROCESSING, known[2])] if known else []
        firsts = [known[0]] if known else []
        for row in rows:
            seen.append((row.ts, row.status != fv.PROCESSING, row.status))
            firsts.append(row.ts)
        (last, final, status), first = max(seen), min(firsts)
        if final:
            if known:
                self._forget()
        else:
            now = timerValues.getCurrentProcessingTimeInMs() if self._timed() else 0
            self.state.update((first, last, status, now))
            if self._timed() and not known:
                self.handle.registerTimer(now + min(t for t in (self.report_ms, self.forget_ms) if t))
        yield self._report(key, first, last, status)

    def _timed(self) -> bool:
        return bool(self.report_ms or self.forget_ms)

    def _forget(self) -> None:
        for timer in list(self.handle.listTimers()) if self._timed() else ():
            self.handle.deleteTimer(timer)
        self.state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        first, last, status, heard = self.state.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        if self.forget_ms and now >= heard + self.forget_ms:
            self._forget()
            return
        self.handle.registerTimer(now + (self.report_ms or heard + self.forget_ms - now))
        if self.report_ms:
            yield self._report(key, first, last, status, now)

    def close(self) -> None:
        pass


def stream_state(
    status: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
    report_ms: int | None = None, forget_ms: int | None = None,
) -> StreamingQuery:
    """Live state per task: its newest status, as lists come in; read with `read_states`.

    State is held for running tasks only (`TaskStates`). Late and repeated rows give what they would have given
    in time: the table keeps the newest status by time and the earliest time of each task. With `report_ms`
    running tasks are reported again and again, with the time they have taken so far; with `forget_ms` those
    that nothing is heard of leave the state and stay as they were in the table. Rows without a time are left out.
    """
    keys = F.to_json(F.struct(*schemas.TASK_KEYS))
    events = status.where("ts IS NOT NULL").select(keys.alias("key"), "status", F.unix_micros("ts").alias("ts"))
    reports = events.groupBy("key").transformWithState(
        TaskStates(report_ms, forget_ms), "key STRING, status STRING, ts LONG, first_ts LONG, as_of LONG", "Update",
        "ProcessingTime" if report_ms or forget_ms else "None",
    )
    task = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in status.select(*schemas.TASK_KEYS).schema.fields)
    times = {c: F.timestamp_micros(c) for c in ("ts", "first_ts", "as_of")}
    rows = reports.withColumns(times).select(F.from_json("key", task).alias("k"), "*").select("k.*", "status", "ts", "first_ts", "as_of")
    return _start(rows, table, STATE_RULES, checkpoint, trigger)


def read_states(spark: SparkSession, table: str) -> DataFrame:
    """Newest status per task, its time, and milliseconds from when the task was first seen: until then, or
    until the last report of a task that still runs."""
    rows = read_upserted(spark, table, STATE_RULES)
    until = F.when(F.expr(FINAL), F.col("ts")).otherwise(F.greatest("ts", "as_of"))
    return rows.select(
        *schemas.TASK_KEYS, "status", "ts",
        F.floor((F.unix_micros(until) - F.unix_micros("first_ts")) / 1000).alias("elapsed_ms"),
    )
