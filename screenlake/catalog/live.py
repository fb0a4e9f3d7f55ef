"""Streams run to the end of their input, in several batches, then read."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake import schemas
from screenlake.adapters import table
from screenlake.catalog.registry import query
from screenlake.catalog.rollups import SUMMARY_SQL
from screenlake.operators.summary import LIGAND_KEYS
from screenlake.session import shared_path
from screenlake.sources import sinks
from screenlake.streaming import live

# Batches that the input of a stream comes in.
BATCHES = 3


@query(
    "t1_stream_outcomes",
    """SELECT collection, count(*) FILTER (status = 'succeeded') AS ligands_succeeded_docking, count(*) FILTER (status = 'failed') AS ligands_removed,
              count(*) FILTER (status = 'failed(docking)') AS ligands_failed_docking,
              count(*) FILTER (status NOT IN ('succeeded', 'failed', 'failed(docking)')) AS unknown_event FROM @status GROUP BY 1""",
)
def t1_stream_outcomes(spark, d):
    files, out = shared_path(spark, "t1-files"), shared_path(spark, "t1")
    sinks.write_status(table(spark, d, "status"), files, "json")
    live.stream_outcomes(live.status_stream(spark, files, max_files=20), f"{out}/table", f"{out}/progress").awaitTermination()
    return live.read_changes(spark, f"{out}/table", ["collection"])


def _in_batches(rows, files):
    """The rows as a stream of files in three batches; rows are dealt out by hash to more files where there are more of them."""
    count = 2 * BATCHES * max(1, rows.rdd.getNumPartitions() // BATCHES)
    rows.repartition(count, *rows.columns).write.parquet(files)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-count // BATCHES)).parquet(files)


@query("t2_stream_summary", SUMMARY_SQL)
def t2_stream_summary(spark, d):
    files, out = shared_path(spark, "t2-files"), shared_path(spark, "t2")
    rows = table(spark, d, "result").select(*LIGAND_KEYS, "replica", "score")
    stream = _in_batches(rows, files)
    live.stream_summary(stream, f"{out}/table", f"{out}/progress").awaitTermination()
    return live.read_changes(spark, f"{out}/table", LIGAND_KEYS)


@query(
    "t3_stream_state",
    """WITH f AS (SELECT collection, ligand, scenario, replica, min(ts) AS first_ts FROM @status GROUP BY 1, 2, 3, 4),
    l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY collection, ligand, scenario, replica
              ORDER BY ts DESC, status <> 'processing' DESC, status DESC) AS rn FROM @status) AS x WHERE rn = 1)
    SELECT l.collection, l.ligand, l.scenario, l.replica, l.status, (epoch_us(l.ts) - epoch_us(f.first_ts)) // 1000 AS elapsed_ms
    FROM l JOIN f ON f.collection = l.collection AND f.ligand = l.ligand AND f.scenario IS NOT DISTINCT FROM l.scenario AND f.replica IS NOT DISTINCT FROM l.replica""",
)
def t3_stream_state(spark, d):
    files, out = shared_path(spark, "t3-files"), shared_path(spark, "t3")
    rows = table(spark, d, "status").select(*schemas.TASK_KEYS, "status", F.col("ts").cast("timestamp").alias("ts"))
    stream = _in_batches(rows, files)
    live.stream_state(stream, f"{out}/table", f"{out}/progress").awaitTermination()
    return live.read_states(spark, f"{out}/table").drop("ts")
