"""End-to-end screen: check ligands, expand tasks, score, summarise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake import fixed_values as fv
from screenlake import schemas
from screenlake.operators import summary, tasks
from screenlake.operators.joins import salted_join
from screenlake.operators.ligands import ligand_verdict, with_smiles
from screenlake.operators.state import latest_state
from screenlake.session import small_batches, stable
from screenlake.sources import archives, sinks, snapshots, text

# Bytes times tasks of a chunk of a screen that keeps its progress: 1000 ligands of 4 kB with 20 tasks.
CHUNK_COST = 80_000_000
MOST_TASKS = 20_000


@dataclass
class Screen:
    """Tables of a screen."""

    results: DataFrame
    status: DataFrame
    summary: DataFrame
    counters: DataFrame


def screen(
    ligands: DataFrame,
    scenario_rows: DataFrame,
    scorer: tasks.Scorer,
    finished: DataFrame | None = None,
    energies: DataFrame | None = None,
    energy_max: float = 10_000,
    precedence: str = "aws",
    partitions: int | None = None,
    with_scores: bool = True,
    progress: str | None = None,
    chunk_cost: int = CHUNK_COST,
) -> Screen:
    """Screen a library in one pass over its files.

    Ligands are spread over `partitions` tasks (default: two per core of the cluster)
    before they are multiplied by scenario and replica, so file contents are shuffled once
    per ligand and not once per task. Ligands that fail the checks go through the same pass
    without tasks. Scored tasks are checkpointed: a lost executor never makes a docking run
    twice for the tables derived from it. `finished` (latest states) leaves out tasks that
    already have a final state.

    With `progress`, a folder of this screen's own, ligands are cut into chunks of about `chunk_cost` (bytes of
    a ligand times its tasks), and each chunk is kept there when it is done. A screen that was killed goes on
    when it is called again with the same input: only the chunks that tasks were at are scored again.
    """
    spark = ligands.sparkSession
    count = partitions or 2 * spark.sparkContext.defaultParallelism
    keys = ["collection", "ligand"]
    readable = ligands.where("error IS NULL") if "error" in ligands.columns else ligands
    files = readable.select(*keys, "content")
    if finished is None:
        with_tasks = files.repartition(count, *keys).withColumn("_tasks", tasks.listed_tasks(scenario_rows))
    else:
        with_tasks = tasks.pending_lists(files, scenario_rows, finished).repartition(count, *keys)
    checked = ligand_verdict(with_smiles(with_tasks), precedence)
    own = checked.select(
        *keys, "smiles", "verdict", "info", "content", F.when(F.col("verdict") == "ok", F.col("_tasks")).alias("_tasks")
    )
    if finished is not None:
        # A ligand that was rejected before is not reported again.
        rejected = finished.where(F.col("scenario").isNull()).select(*keys).distinct()
        own = own.join(rejected, keys, "left_anti")
    # Files are long: a worker holds a bounded number of them.
    with small_batches(spark):
        if progress is None:
            passed = stable(tasks.score_results(tasks.run_scorer(own, scorer)))
        else:
            passed = tasks.score_results(_scored_in_chunks(own, scorer, progress, chunk_cost, partitions))
    results = passed.where("scenario IS NOT NULL").drop("verdict", "info")
    if energies is not None:
        results = tasks.energy_check(results, energies, energy_max)
    removed = passed.where("verdict <> 'ok'").select(
        *keys, "scenario", "replica", F.lit(fv.FAILED).alias("status"), "info", "seconds", "score"
    )
    docked = results.select(
        *keys, "scenario", "replica", "status", F.lit(None).cast("string").alias("info"), "seconds", "score"
    )
    status = docked.unionAll(removed)
    return Screen(
        results=results,
        status=status,
        summary=summary.ligand_summary(results, with_scores),
        counters=summary.collection_counters(status),
    )


def _scored_in_chunks(
    own: DataFrame, scorer: tasks.Scorer, progress: str, chunk_cost: int, partitions: int | None
) -> DataFrame:
    """Score ligands in chunks kept below `progress`; the first call settles how many there are."""
    spark = own.sparkSession
    if not archives.can_seek(spark, progress):
        raise ValueError(f"tasks cannot write files below {progress}")
    # Ligands that failed the checks have no tasks, and cost next to nothing. Listed scenarios stand for replicas.
    listed = "replicas" in own.schema["_tasks"].dataType.elementType.names
    n_tasks = F.aggregate("_tasks", F.lit(0).cast("long"), lambda a, t: a + (t["replicas"] if listed else 1))
    cost = F.octet_length("content").cast("long") * F.coalesce(n_tasks, F.lit(0)) + 1
    tag = F.pmod(F.xxhash64("collection", "ligand", "content", "_tasks"), F.lit(1 << 40))
    total = own.agg(F.sum(cost).alias("cost"), F.sum(tag).cast("string").alias("input")).first()
    _, plan = snapshots.current(spark, progress)
    if not plan:
        plan = {"chunks": max(1, -(-(total["cost"] or 0) // chunk_cost)), "input": total["input"]}
        snapshots.commit(spark, progress, 1, plan)
    if plan["input"] != total["input"]:
        raise ValueError(f"{progress} holds chunks of another screen")
    # Chunks are dealt by hash: ligands are small beside a chunk, so chunks cost about the same.
    chunked = own.withColumn("_chunk", F.pmod(F.xxhash64("collection", "ligand"), F.lit(plan["chunks"])))
    folder = archives.qualified(spark, f"{progress}/chunks")
    kept = [int(n[6:-8]) for n in snapshots.list_names(spark, folder) if n.startswith("chunk-")]
    rest = spark.createDataFrame([(k,) for k in kept], "_chunk LONG")
    todo = chunked.join(rest, "_chunk", "left_anti")
    # Small tasks even out; beyond so many each does several chunks.
    return tasks.run_in_chunks(todo, scorer, "_chunk", partitions or min(plan["chunks"], MOST_TASKS), folder)


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; where both have a task (or a ligand without tasks), the new one counts."""
    keys = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_{k}") for k in schemas.TASK_KEYS]
    names = [f"_{k}" for k in schemas.TASK_KEYS]
    known = new.select(*keys).distinct()
    kept = old.withColumns(dict(zip(names, keys))).join(known, names, "left_anti").drop(*names)
    return kept.unionByName(new, allowMissingColumns=True)


def publish(out: Screen, root: str, max_replicas: int, level: str = "collection", grid: DataFrame | None = None) -> Screen:
    """Write the tables of a screen: results tree, status lists and summary text; returns them as written.

    Collections that were published before keep their earlier tasks: what the tree and the lists
    hold of them is merged with the new rows task by task, and summaries and counters are made of
    both. Other collections are not touched. With `grid`, all tasks there are, a collection (of a
    scenario) with a task that has no final state is published as incomplete.
    """
    spark = out.results.sparkSession
    touched = out.status.select("collection").distinct()
    results, status, was_complete = out.results.drop("smiles", "error"), out.status, None
    if sinks.exists(spark, f"{root}/results"):
        old = sinks.read_results(spark, f"{root}/results")
        was_complete = old.where("state = 'complete'").select("scenario", "collection").distinct()
        results = merged(salted_join(old, touched, ["collection"], "left_semi").drop("state", "metatranche", "tranche"), results)
    if sinks.exists(spark, f"{root}/ligand-lists"):
        old = text.read_status(spark, f"{root}/ligand-lists", "jsonl")
        status = merged(salted_join(old, touched, ["collection"], "left_semi"), status)
    results, status = stable(results), stable(status)
    state = F.lit("complete")
    if grid is not None:
        finished = status.withColumn("ts", F.coalesce("ts", F.current_timestamp()) if "ts" in status.columns else F.current_timestamp())
        removed = status.where(F.col("scenario").isNull()).select("collection", "ligand").distinct()
        wanted = grid.join(removed, ["collection", "ligand"], "left_anti")
        pending = tasks.pending_tasks(wanted, latest_state(finished)).select("scenario", "collection").distinct()
        if was_complete is not None:
            # Once complete, a collection stays so: readers leave out incomplete rows beside it.
            pending = pending.join(was_complete, ["scenario", "collection"], "left_anti")
        results = salted_join(results, pending.withColumn("_open", F.lit(True)), ["scenario", "collection"])
        state = F.when(F.col("_open"), "incomplete").otherwise("complete")
    results = stable(results.withColumn("state", state).drop("_open"))
    summaries = summary.ligand_summary(results, max_replicas=max_replicas, padded=True)
    states = results.select("scenario", "collection", "state").distinct()
    by_state = salted_join(summaries, states, ["scenario", "collection"])
    sinks.write_results(results, f"{root}/results", level)
    sinks.write_status(status, f"{root}/ligand-lists", "json", replace=True)
    sinks.write_summary_text(by_state, f"{root}/summaries", max_replicas)
    return Screen(results, status, summaries, summary.collection_counters(status))
