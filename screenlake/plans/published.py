"""Published screens: every run adds a folder, and one snapshot commits its results, lists and summaries together.

Readers see all tables of a run or none of them. A collection belongs to the newest run that has it, and that run
holds all of its tasks; an index of collections per run says so, and is all that is read of earlier runs unless
they hold one of the collections again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.functions.keys import with_collection_parts
from screenlake.operators import summary, tasks
from screenlake.operators.joins import salted_join
from screenlake.operators.state import latest_state
from screenlake.plans.screen import Screen, merged
from screenlake.session import stable
from screenlake.sources import sinks, snapshots, text

INDEX, RESULTS, LISTS, SUMMARIES = "index", "results", "ligand-lists", "summaries"


def _used(content: dict) -> list[str]:
    return [run["folder"] for run in content.get("runs", [])]


def _index(spark: SparkSession, root: str, run: dict) -> DataFrame:
    return spark.read.schema("collection STRING").parquet(f"{root}/{run['folder']}/{INDEX}")


def _owners(spark: SparkSession, root: str, runs: list[dict]) -> DataFrame:
    """(collection, run): the newest run of each collection."""
    each = [_index(spark, root, run).withColumn("run", F.lit(n)) for n, run in enumerate(runs)]
    return reduce(DataFrame.unionByName, each).groupBy("collection").agg(F.max("run").alias("run"))


def _current(spark: SparkSession, root: str, runs: list[dict], read, wanted: DataFrame | None = None) -> DataFrame | None:
    """Rows of a table over all runs, each collection from its own run; `wanted`: of these (collection, run) only.

    Runs that own all of their collections are read as they are; the others leave out what newer ones hold.
    """
    parts = []
    for n, run in enumerate(runs):
        rows = read(f"{root}/{run['folder']}")
        if wanted is not None:
            # The folder columns are met as well: only folders of wanted collections are opened.
            own = with_collection_parts(wanted.where(F.col("run") == n).select("collection")).drop("collection_id")
            on = [c for c in ("metatranche", "tranche", "collection") if c in rows.columns]
            rows = rows.join(own.select(*on), on, "left_semi")
        elif run["replaced"]:
            newer = reduce(DataFrame.unionByName, [_index(spark, root, r) for r in runs[n + 1:]]).distinct()
            rows = salted_join(rows, newer, ["collection"], "left_anti")
        parts.append(rows)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def _results_of(spark: SparkSession):
    return lambda folder: spark.read.parquet(f"{folder}/{RESULTS}")


def _lists_of(spark: SparkSession):
    return lambda folder: text.read_status(spark, f"{folder}/{LISTS}", "jsonl")


def publish_run(
    out: Screen, root: str, max_replicas: int, level: str = "collection", grid: DataFrame | None = None
) -> Screen:
    """Publish the tables of a screen as a run of their own; returns them as published.

    Collections that are published already are merged with what their run holds, task by task, and pass to
    the new run whole; nothing of the others is read. With `grid`, all tasks there are, a collection (of a
    scenario) with a task that has no final state is published as incomplete; once complete, it stays so.
    A failure before the commit leaves the snapshot before; a second publisher at the same time is refused
    (`snapshots.Outdated`).
    """
    spark = out.results.sparkSession
    version, content = snapshots.current(spark, root)
    runs = content.get("runs", [])
    results, status, was_complete = out.results.drop("smiles", "error"), out.status, None
    touched = stable(status.select("collection").distinct())
    held: set[int] = set()
    if runs:
        again = stable(_owners(spark, root, runs).join(touched, "collection", "left_semi"))
        held = {r["run"] for r in again.select("run").distinct().collect()}
    if held:
        # Other runs are not even listed.
        some = [dict(runs[n]) for n in sorted(held)]
        number = {n: k for k, n in enumerate(sorted(held))}
        renumbered = again.replace(number, subset=["run"]) if any(a != b for a, b in number.items()) else again
        old = _current(spark, root, some, _results_of(spark), renumbered)
        was_complete = old.where("state = 'complete'").select("scenario", "collection").distinct()
        results = merged(old.drop("state", "metatranche", "tranche"), results)
        status = merged(_current(spark, root, some, _lists_of(spark), renumbered), status)
    results, status = stable(results), stable(status)
    state = F.lit("complete")
    if grid is not None:
        timed = status.withColumn("ts", F.coalesce("ts", F.current_timestamp()) if "ts" in status.columns else F.current_timestamp())
        removed = status.where(F.col("scenario").isNull()).select("collection", "ligand").distinct()
        wanted = grid.join(removed, ["collection", "ligand"], "left_anti")
        pending = tasks.pending_tasks(wanted, latest_state(timed)).select("scenario", "collection").distinct()
        if was_complete is not None:
            pending = pending.join(was_complete, ["scenario", "collection"], "left_anti")
        results = salted_join(results, pending.withColumn("_open", F.lit(True)), ["scenario", "collection"])
        state = F.when(F.col("_open"), "incomplete").otherwise("complete")
    results = stable(results.withColumn("state", state).drop("_open"))
    summaries = summary.ligand_summary(results, max_replicas=max_replicas, padded=True)
    states = results.select("scenario", "collection", "state").distinct()
    folder = snapshots.new_folder(root)
    _write(f"{root}/{folder}", results, status, salted_join(summaries, states, ["scenario", "collection"]), touched, max_replicas, level)
    taken = [run | {"replaced": run["replaced"] or n in held} for n, run in enumerate(runs)]
    snapshots.commit(spark, root, version + 1, {"runs": [*taken, {"folder": folder, "replaced": False}], "max_replicas": max_replicas})
    snapshots.clean(spark, root, _used)
    return Screen(results, status, summaries, summary.collection_counters(status))


def _write(folder: str, results, status, summaries, index, max_replicas: int, level: str) -> None:
    sinks.write_results(results, f"{folder}/{RESULTS}", level)
    sinks.write_status(status, f"{folder}/{LISTS}", "json")
    sinks.write_summary_text(summaries, f"{folder}/{SUMMARIES}", max_replicas)
    index.select("collection").write.parquet(f"{folder}/{INDEX}")


def published_results(spark: SparkSession, root: str) -> DataFrame:
    """Results of all runs, with `state`; None where nothing is published."""
    return _current(spark, root, snapshots.current(spark, root)[1].get("runs", []), _results_of(spark))


def published_status(spark: SparkSession, root: str) -> DataFrame:
    """Ligand lists of all runs."""
    return _current(spark, root, snapshots.current(spark, root)[1].get("runs", []), _lists_of(spark))


def published_summaries(spark: SparkSession, root: str) -> DataFrame:
    """Summaries of all runs, as their text says."""
    return _current(
        spark, root, snapshots.current(spark, root)[1].get("runs", []),
        lambda folder: text.read_summaries(spark, f"{folder}/{SUMMARIES}", layout="table"),
    )


def compact_runs(spark: SparkSession, root: str, level: str = "collection") -> None:
    """Make all runs one; readers of the snapshot before keep its folders until the next commit."""
    version, content = snapshots.current(spark, root)
    runs = content.get("runs", [])
    if len(runs) < 2:
        return
    results = stable(published_results(spark, root).drop("metatranche", "tranche"))
    status = published_status(spark, root)
    summaries = summary.ligand_summary(results, max_replicas=content["max_replicas"], padded=True)
    states = results.select("scenario", "collection", "state").distinct()
    folder = snapshots.new_folder(root)
    _write(
        f"{root}/{folder}", results, status, salted_join(summaries, states, ["scenario", "collection"]),
        _owners(spark, root, runs), content["max_replicas"], level,
    )
    snapshots.commit(spark, root, version + 1, content | {"runs": [{"folder": folder, "replaced": False}]})
    snapshots.clean(spark, root, _used)
