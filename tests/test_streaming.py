"""Streams restarted over growing folders give the batch results."""

import gzip
import json
import random
import time
from functools import reduce

import pytest
from pyspark.sql import functions as F

from screenlake.operators.batch import collection_outcomes
from screenlake.operators.state import latest_state
from screenlake.operators.summary import LIGAND_KEYS, ligand_summary
from screenlake.schemas import TASK_KEYS
from screenlake.sources import snapshots
from screenlake.sources.sinks import write_status
from screenlake.streaming import live
from screenlake.streaming.upsert import Rules, read_upserted, upsert

SCHEMA = "collection STRING, ligand STRING, scenario STRING, replica INT, status STRING, info STRING, seconds DOUBLE, score DOUBLE"
FIRST = [("A_1", "L1", "S", 1, "succeeded", None, 1.0, -7.0), ("A_1", "L2", None, None, "failed", "x", None, None)]
SECOND = [("A_1", "L1", "S", 2, "failed(docking)", None, 1.0, None), ("A_2", "L3", "S", 1, "processing", None, 1.0, None)]


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_outcomes_count_each_file_once(spark, tmp_path):
    def run():
        live.stream_outcomes(live.status_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/table", f"{tmp_path}/progress").awaitTermination()
        return rows(live.read_changes(spark, f"{tmp_path}/table", ["collection"]))

    first, second = spark.createDataFrame(FIRST, SCHEMA), spark.createDataFrame(SECOND, SCHEMA)
    write_status(first, f"{tmp_path}/in")
    got = run()
    assert got == run() == rows(collection_outcomes(first))
    write_status(second, f"{tmp_path}/in")
    assert run() == rows(collection_outcomes(first.union(second)))


def test_outcomes_of_published_lists(spark, tmp_path):
    def publish(number, statuses):
        file = tmp_path / "in" / "AA" / "AAAB" / f"{number}.json.gz"
        file.parent.mkdir(parents=True, exist_ok=True)
        content = [{"ligand": f"L{i}", "status": s} for i, s in enumerate(statuses)]
        file.write_bytes(gzip.compress(json.dumps(content, indent=4).encode()))

    def run():
        stream = live.status_stream(spark, f"{tmp_path}/in", "json")
        live.stream_outcomes(stream, f"{tmp_path}/table", f"{tmp_path}/progress").awaitTermination()
        table = live.read_changes(spark, f"{tmp_path}/table", ["collection"])
        return rows(table.select("collection", "ligands_removed", "ligands_succeeded_docking"))

    publish("0", ["succeeded", "failed"])
    assert run() == [("AAAB_0", 1, 1)]
    publish("1", ["succeeded", "succeeded", "odd"])
    assert run() == [("AAAB_0", 1, 1), ("AAAB_1", 0, 2)]


def test_running_summary(spark, tmp_path):
    schema = "scenario STRING, collection STRING, ligand STRING, replica INT, score DOUBLE"
    parts = [
        spark.createDataFrame([("S", "A", "x", 1, -5.0), ("S", "A", "y", 1, -6.0)], schema),
        spark.createDataFrame([("S", "A", "x", 2, -7.0), ("S", "A", "x", 3, None)], schema),
    ]
    for i, part in enumerate(parts):
        part.write.parquet(f"{tmp_path}/in/{i}")
        stream = spark.readStream.schema(part.schema).parquet(f"{tmp_path}/in/*")
        live.stream_summary(stream, f"{tmp_path}/table", f"{tmp_path}/progress").awaitTermination()
    want = ligand_summary(parts[0].union(parts[1]), with_scores=False)
    assert rows(live.read_changes(spark, f"{tmp_path}/table", LIGAND_KEYS)) == rows(want)


def test_live_state(spark, tmp_path):
    schema = "collection STRING, ligand STRING, scenario STRING, replica INT, status STRING, ts STRING"
    parts = [
        spark.createDataFrame([("A", "x", "S", 1, "processing", "2024-01-01 00:00:00"), ("A", "y", "S", 1, "processing", "2024-01-01 00:00:00")], schema),
        spark.createDataFrame([("A", "x", "S", 1, "succeeded", "2024-01-01 00:00:02.500")], schema),
    ]
    parts = [p.withColumn("ts", F.col("ts").cast("timestamp")) for p in parts]
    for i, part in enumerate(parts):
        part.write.parquet(f"{tmp_path}/in/{i}")
        stream = spark.readStream.schema(part.schema).parquet(f"{tmp_path}/in/*")
        live.stream_state(stream, f"{tmp_path}/table", f"{tmp_path}/progress").awaitTermination()
    got = live.read_states(spark, f"{tmp_path}/table")
    assert {r["ligand"]: (r["status"], r["elapsed_ms"]) for r in got.collect()} == {"x": ("succeeded", 2500), "y": ("processing", 0)}
    assert rows(got.drop("elapsed_ms")) == rows(latest_state(parts[0].union(parts[1])).select(*TASK_KEYS, "status", "ts"))


def folders(path):
    return [p.name for p in path.iterdir() if p.name.startswith("data-")]


def test_twenty_batches_leave_few_folders(spark, tmp_path):
    """A file per batch; the table equals the batch result, with about as many folders as doublings."""
    schema = "scenario STRING, collection STRING, ligand STRING, replica INT, score DOUBLE"
    parts = [spark.createDataFrame([("S", f"C{b % 3}", f"L{i}", b, float(-i - b)) for i in range(b, b + 12)], schema) for b in range(20)]
    for b, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{b}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    query = live.stream_summary(stream, f"{tmp_path}/table", f"{tmp_path}/progress")
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 19
    everything = reduce(lambda a, b: a.union(b), parts)
    got = live.read_changes(spark, f"{tmp_path}/table", LIGAND_KEYS)
    assert rows(got) == rows(ligand_summary(everything, with_scores=False))
    assert len(folders(tmp_path / "table")) <= 12 and len(snapshots.versions(spark, f"{tmp_path}/table")) <= snapshots.KEPT


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    rules, root = Rules(("k",)), f"{tmp_path}/table"
    frame = lambda *r: spark.createDataFrame(list(r), "k STRING, v INT")
    upsert(frame(("a", 1), ("b", 1), ("c", 1), (None, 1)), 0, root, rules)
    upsert(frame(("a", 2)), 1, root, rules)
    before, version = rows(read_upserted(spark, root, rules)), snapshots.current(spark, root)
    upsert(frame(("a", 2)), 1, root, rules)
    upsert(frame(("a", 9)), 0, root, rules)
    assert before == rows(read_upserted(spark, root, rules)) == [("a", 2), ("b", 1), ("c", 1), (None, 1)]
    assert snapshots.current(spark, root) == version
    # Data written without a snapshot, as by a driver that was lost, is not seen, and goes with the next batch.
    frame(("z", 5)).write.parquet(f"{root}/{snapshots.new_folder(root)}")
    assert rows(read_upserted(spark, root, rules)) == before
    upsert(frame(("b", 3)).limit(0), 2, root, rules)
    upsert(frame(("b", 3)), 3, root, rules)
    assert rows(read_upserted(spark, root, rules)) == [("a", 2), ("b", 3), ("c", 1), (None, 1)]
    assert len(folders(tmp_path / "table")) <= 4


def test_a_snapshot_is_made_once(spark, tmp_path):
    root = f"{tmp_path}/t"
    snapshots.commit(spark, root, 1, {"a": 1})
    with pytest.raises(snapshots.Outdated):
        snapshots.commit(spark, root, 1, {"a": 2})
    assert snapshots.current(spark, root) == (1, {"a": 1}) and len(list((tmp_path / "t" / "_snapshots").glob("[!.]*"))) == 1


STATES = "collection STRING, ligand STRING, scenario STRING, replica INT, status STRING, ts STRING"


def at(second):
    return f"2024-01-01 00:{second // 60:02d}:{second % 60:02d}"


def test_late_and_repeated_states_equal_sql(spark, tmp_path):
    """Rows of 150 tasks, with null keys, dealt over batches in no order, many twice, some without a time."""
    rng, events = random.Random(7), []
    for i in range(150):
        task = ("A", f"L{i}", "S", i % 3) if i % 10 else ("A", f"L{i}", None, None)
        start = rng.randrange(1000)
        events.append((*task, "processing", at(start)))
        if i % 4:
            events.append((*task, rng.choice(["succeeded", "failed(docking)"]), at(start + rng.choice([0, 1, 500]))))
        if i % 7 == 0:
            events += [(*task, "processing", at(start + 800)), (*task, "processing", None)]
    events += rng.sample(events, 100)
    rng.shuffle(events)
    for b in range(6):
        spark.createDataFrame(events[b::6], STATES).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{tmp_path}/in/{b}")
    everything = spark.read.parquet(f"{tmp_path}/in/*")
    stream = spark.readStream.schema(everything.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    live.stream_state(stream, f"{tmp_path}/table", f"{tmp_path}/progress").awaitTermination()
    timed = everything.where("ts IS NOT NULL")
    first = timed.groupBy(*TASK_KEYS).agg(F.min("ts").alias("first_ts"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in TASK_KEYS]
    elapsed = F.floor((F.unix_micros("ts") - F.unix_micros("first_ts")) / 1000).alias("elapsed_ms")
    want = latest_state(timed).alias("a").join(first.alias("b"), same).select(*(f"a.{k}" for k in TASK_KEYS), "status", "ts", elapsed)
    assert rows(live.read_states(spark, f"{tmp_path}/table")) == rows(want) and want.count() == 150
    # What has ended is in no state any more: those left are the tasks whose last row said that they run.
    state = spark.read.format("statestore").option("stateVarName", "task").load(f"{tmp_path}/progress")
    running = timed.groupBy(*TASK_KEYS).agg(F.count_if(F.col("status") != "processing").alias("ended")).where("ended = 0").count()
    assert running <= state.count() < 100


def test_running_tasks_are_reported_until_they_end(spark, tmp_path):
    """Timers: a task that runs is reported with its time so far, one that nothing is heard of leaves the state."""
    now = spark.sql("SELECT current_timestamp() AS ts, current_timestamp() - INTERVAL 1 HOUR AS early").first()
    put = lambda n, *r: spark.createDataFrame(
        [("A", ligand, "S", 1, status, ts) for ligand, status, ts in r], STATES.replace("ts STRING", "ts TIMESTAMP")
    ).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    put(0, ("x", "processing", now.early), ("y", "processing", now.early))
    stream = spark.readStream.schema(STATES.replace("ts STRING", "ts TIMESTAMP")).parquet(f"{tmp_path}/in/*")
    query = live.stream_state(
        stream, f"{tmp_path}/table", f"{tmp_path}/progress", {"processingTime": "500 milliseconds"}, report_ms=1000, forget_ms=30_000
    )

    def states():
        return {r["ligand"]: (r["status"], r["elapsed_ms"]) for r in live.read_states(spark, f"{tmp_path}/table").collect()}

    def wait(what):
        end = time.time() + 90
        while time.time() < end and query.exception() is None:
            if snapshots.versions(spark, f"{tmp_path}/table") and what(states()):
                return True
            time.sleep(0.5)
        return False

    try:
        hour = 3_600_000
        assert wait(lambda s: s.get("x", ("", 0))[1] > hour), query.exception()
        put(1, ("x", "succeeded", now.ts))
        assert wait(lambda s: s["x"] == ("succeeded", hour))
        # The other one goes on, then is given up by the state; the table keeps it.
        assert states()["y"][0] == "processing" and states()["y"][1] > hour
        before = states()["y"]
        assert wait(lambda s: s["y"][1] > before[1] + 1000)
        assert states()["x"] == ("succeeded", hour)
    finally:
        query.stop()
