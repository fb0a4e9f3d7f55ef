"""Progress of a campaign: collections, ligands, dockings, queues and jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.operators.joins import salted_join

COUNTERS = (
    "ligands_started",
    "ligands_succeeded",
    "ligands_failed",
    "dockings_started",
    "dockings_succeeded",
    "dockings_failed",
)


def as_metrics(row: DataFrame, type_: str = "long") -> DataFrame:
    """A one-row table as (metric, value) rows."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast(type_).alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*pairs)))


def workflow_progress(manifest: DataFrame, done: DataFrame, current: DataFrame, todo: DataFrame) -> DataFrame:
    """Collections total / completed / processing / not yet started as (metric, value)."""
    named = {"total": manifest, "completed": done, "processing": current, "todo": todo}
    tagged = [df.select(F.lit(name).alias("metric")) for name, df in named.items()]
    counted = reduce(DataFrame.unionAll, tagged).groupBy("metric").agg(F.count(F.lit(1)).alias("n"))
    names = manifest.sparkSession.createDataFrame([(n,) for n in named], "metric STRING")
    return names.join(F.broadcast(counted), "metric", "left").select(
        F.concat(F.lit("collections_"), "metric").alias("metric"),
        F.coalesce("n", F.lit(0)).cast("long").alias("value"),
    )


def workflow_totals(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Ligands of the manifest, and ligand and docking counters over completed collections."""
    total = manifest.agg(F.coalesce(F.sum("n_ligands"), F.lit(0)).alias("ligands_total"))
    counters = done.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS))
    return as_metrics(total).unionAll(as_metrics(counters))


def workflow_numbers(manifest: DataFrame, done: DataFrame, current: DataFrame, todo: DataFrame) -> DataFrame:
    """`workflow_progress` and `workflow_totals` in one: every table is read once."""
    def number(name: str) -> Column:
        return F.count(F.lit(1)).alias(f"collections_{name}")

    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]
    ligands = F.coalesce(F.sum("n_ligands"), F.lit(0)).alias("ligands_total")
    rows = (manifest.agg(number("total"), ligands), done.agg(number("completed"), *sums), current.agg(number("processing")), todo.agg(number("todo")))
    return reduce(DataFrame.unionAll, map(as_metrics, rows))


def double_assigned(assignment: DataFrame) -> DataFrame:
    """Collections held by more than one queue."""
    queue = [c for c in ("jobline", "step", "queue") if c in assignment.columns]
    return (
        assignment.select("collection", *queue).distinct()
        .groupBy("collection").agg(F.count(F.lit(1)).alias("n_queues"))
        .where("n_queues > 1")
    )


def _is_running(state: Column) -> Column:
    return F.upper(state).contains("RUN") | (F.upper(state) == "R")


def cores_of(slots: Column) -> Column:
    """`4*host` is 4 cores; text that does not start with a number is one core."""
    return F.coalesce(F.regexp_extract(slots, r"^([0-9]+)", 1).try_cast("int"), F.lit(1))


def job_snapshot(jobs: DataFrame) -> DataFrame:
    """Per queue: joblines running, not running (completing ones aside), and cores in use."""
    running = _is_running(F.col("state"))
    completing = F.upper("state").contains("COMPL")
    return jobs.groupBy("queue").agg(
        F.count_if(running).alias("running"),
        F.count_if(~running & ~completing).alias("not_running"),
        F.sum(F.when(running, cores_of(F.col("slots"))).otherwise(0)).cast("long").alias("cores"),
    )


def job_totals(jobs: DataFrame) -> DataFrame:
    """Joblines in all, running, not running, distinct queues and cores as (metric, value)."""
    running = _is_running(F.col("state"))
    per_queue = jobs.groupBy("queue").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(running).alias("r"),
        F.sum(F.when(running, cores_of(F.col("slots"))).otherwise(0)).alias("c"),
    )
    return as_metrics(
        per_queue.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("joblines"),
            F.coalesce(F.sum("r"), F.lit(0)).alias("joblines_running"),
            F.coalesce(F.sum(F.col("n") - F.col("r")), F.lit(0)).alias("joblines_not_running"),
            F.count(F.lit(1)).alias("queues"),
            F.coalesce(F.sum("c"), F.lit(0)).alias("cores"),
        )
    )


def queue_load(assignment: DataFrame, current: DataFrame) -> DataFrame:
    """Ligands and collections per queue, over its to-do list and its current collection."""
    cols = ["jobline", "step", "queue", "n_ligands"]
    return (
        assignment.select(*cols).unionAll(current.select(*cols))
        .groupBy("jobline", "step", "queue")
        .agg(
            F.coalesce(F.sum("n_ligands"), F.lit(0)).cast("long").alias("n_ligands"),
            F.count(F.lit(1)).alias("n_collections"),
        )
    )


def merge_todo(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both to-do lists, distinct and sorted by collection."""
    cols = ["collection", "n_ligands"]
    return old.select(*cols).unionAll(new.select(*cols)).distinct().orderBy(*cols)


def remaining(manifest: DataFrame, done: DataFrame, current: DataFrame, assigned: DataFrame) -> DataFrame:
    """Manifest rows in none of the other lists."""
    taken = reduce(DataFrame.unionAll, [d.select("collection") for d in (done, current, assigned)])
    return salted_join(manifest, taken.distinct(), ["collection"], "left_anti")
