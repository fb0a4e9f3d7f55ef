"""Scenarios, the task grid, and running a scorer over it."""

from __future__ import annotations

import itertools
import os
import subprocess
import tempfile
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileType
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from screenlake import fixed_values as fv
from screenlake import schemas
from screenlake.functions import scores
from screenlake.sources import archives


def _control_lists(control: DataFrame) -> DataFrame:
    """One row per control file with the values used here, null where a key is missing."""
    keys = {
        "names": fv.SCENARIO_NAMES,
        "programs": fv.SCENARIO_PROGRAMS,
        "replicas": fv.SCENARIO_REPLICAS,
        "folders": fv.SCENARIO_FOLDERS,
        "energy_check": "energy_check",
        "energy_max": "energy_max",
        "ligand_library_format": "ligand_library_format",
        "outputfiles_level": "outputfiles_level",
    }
    used = control.where(F.col("key").isin(*keys.values()))
    return used.groupBy("file").agg(
        *(F.max(F.when(F.col("key") == key, F.col("value"))).alias(name) for name, key in keys.items())
    )


def scenarios(control: DataFrame) -> DataFrame:
    """The four parallel lists as rows: file, idx (from 1), name, program, replicas, inputfolder.

    A missing entry of a shorter list is null, see `validate_control`.
    """
    lists = _control_lists(control)
    zipped = F.arrays_zip(
        *(F.split(F.coalesce(c, F.lit("")), ":").alias(c) for c in ("names", "programs", "replicas", "folders"))
    )
    return (
        lists.select("file", F.size(F.split("names", ":")).alias("n"), F.posexplode(zipped).alias("pos", "s"))
        .where(F.col("pos") < F.col("n"))
        .select(
            "file",
            (F.col("pos") + 1).alias("idx"),
            F.col("s.names").alias("name"),
            F.col("s.programs").alias("program"),
            F.col("s.replicas").try_cast("int").alias("replicas"),
            F.col("s.folders").alias("inputfolder"),
        )
    )


def validate_control(control: DataFrame) -> DataFrame:
    """Rows (file, check, ok, detail), one per file and check."""
    lists = _control_lists(control)
    n_names, n_programs, n_replicas = (
        F.size(F.split(F.coalesce(c, F.lit("")), ":")) for c in ("names", "programs", "replicas")
    )

    def same_length(other: Column) -> tuple[Column, Column]:
        ok = n_names == other
        text = F.format_string("length mismatch: %d names, %d entries", n_names, other)
        return ok, F.when(~ok, text)

    def one_of(col: str, allowed: tuple[str, ...]) -> tuple[Column, Column]:
        ok = F.coalesce(F.col(col).isin(*allowed), F.lit(False))
        return ok, F.when(~ok, F.concat(F.lit("invalid value: "), F.coalesce(col, F.lit(""))))

    checks_energy = F.coalesce(F.col("energy_check") == "true", F.lit(False))
    energy_ok = ~checks_energy | F.coalesce(F.col("energy_max").rlike("^[0-9]+$"), F.lit(False))
    energy_text = F.when(~energy_ok, F.concat(F.lit("invalid value: "), F.coalesce("energy_max", F.lit(""))))
    checks = {
        "programs_length": same_length(n_programs),
        "replicas_length": same_length(n_replicas),
        "energy_check": one_of("energy_check", ("true", "false")),
        "energy_max": (energy_ok, energy_text),
        "ligand_library_format": one_of("ligand_library_format", fv.LIBRARY_FORMATS),
        "outputfiles_level": one_of("outputfiles_level", fv.OUTPUT_LEVELS),
    }
    rows = F.array(
        *(F.struct(F.lit(n).alias("check"), ok.alias("ok"), text.alias("detail")) for n, (ok, text) in checks.items())
    )
    return lists.select("file", F.inline(rows))


def runs_per_ligand(scenario_rows: DataFrame) -> DataFrame:
    return scenario_rows.agg(F.coalesce(F.sum("replicas"), F.lit(0)).cast("long").alias("runs_per_ligand"))


TASK_FIELDS = ["scenario_idx", "scenario", "program", "replica"]

TASK_TYPES = {"scenario_idx": "integer", "scenario": "string", "program": "string", "replica": "integer"}

# Results that leave a task together: so many, or so many characters of logs and poses, or those of so many seconds.
ROWS_AT_ONCE, BYTES_AT_ONCE, SECONDS_AT_ONCE = 10_000, 16 << 20, 30
_PANDAS_TYPES = {"integer": "Int32", "long": "Int64", "double": "float64"}


def _scenario_list(scenario_rows: DataFrame) -> Column:
    """The scenarios as one array: a scalar subquery. They are the entries of four lines of one control
    file, which bounds them; replicas are only counted in it."""
    rows = scenario_rows.where("replicas > 0").select(
        F.col("idx").alias("scenario_idx"), F.col("name").alias("scenario"), "program", "replicas"
    )
    return rows.agg(F.sort_array(F.collect_list(F.struct("scenario_idx", "scenario", "program", "replicas")))).scalar()


def listed_tasks(scenario_rows: DataFrame) -> Column:
    """All tasks of a ligand as an array of scenarios with their number of replicas, see `run_scorer`."""
    return _scenario_list(scenario_rows)


def task_grid(ligands: DataFrame, scenario_rows: DataFrame, replica_base: int = 1) -> DataFrame:
    """Every ligand with every scenario and replica; other ligand columns ride along.

    The scenario list is attached to each ligand and exploded in place, then the replicas: no join
    and no shuffle, whatever the number of either.
    """
    replicas = F.sequence(F.lit(replica_base), F.col("_s.replicas") + (replica_base - 1))
    return (
        ligands.withColumn("_s", F.explode(_scenario_list(scenario_rows)))
        .withColumn("_r", F.explode(replicas))
        .select(*ligands.columns, "_s.scenario_idx", "_s.scenario", "_s.program", F.col("_r").alias("replica"))
    )


def valid_ligands(ligands: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Ligands without a failed verdict; skipped ligands keep their status row elsewhere."""
    failed = verdicts.where(F.col("verdict") != "ok").select("collection", "ligand").distinct()
    return ligands.join(failed, ["collection", "ligand"], "left_anti")


def pending_tasks(grid: DataFrame, latest: DataFrame) -> DataFrame:
    """Tasks with no final state; a task left in `processing` runs again.

    `latest` holds one row per task, see `latest_state`.
    """
    finished = latest.where(F.col("status") != fv.PROCESSING).select(*schemas.TASK_KEYS)
    return grid.join(finished, schemas.TASK_KEYS, "left_anti")


def _task_name(replica: Column, scenario: Column) -> Column:
    return F.concat_ws(" ", replica.cast("string"), scenario)


def _done_names(latest: DataFrame) -> DataFrame:
    """Ligands with `_done`, the names of their tasks with a final state."""
    finished = latest.where((F.col("status") != fv.PROCESSING) & F.col("scenario").isNotNull() & F.col("replica").isNotNull())
    names = F.collect_set(_task_name(F.col("replica"), F.col("scenario")))
    return finished.groupBy("collection", "ligand").agg(names.alias("_done"))


def _is_open(replica: Column, scenario: Column) -> Column:
    return F.col("_done").isNull() | ~F.array_contains("_done", _task_name(replica, scenario))


def pending_lists(ligands: DataFrame, scenario_rows: DataFrame, latest: DataFrame, replica_base: int = 1) -> DataFrame:
    """Ligands with `_tasks`, the list of their tasks with no final state; those without any are left out.

    What is finished is folded to a set per ligand and met there, before tasks are multiplied out: ligands are
    shuffled, tasks never. Scenarios and replicas, and so the set, are bounded by one control file.
    """
    done = _done_names(latest)
    fields = ("scenario_idx", "scenario", "program")
    each = lambda s: F.transform(
        F.sequence(F.lit(replica_base), s["replicas"] + (replica_base - 1)),
        lambda r: F.struct(*(s[f].alias(f) for f in fields), r.alias("replica")),
    )
    everything = ligands.withColumn("_scenarios", _scenario_list(scenario_rows))
    left = F.filter(F.flatten(F.transform("_scenarios", each)), lambda t: _is_open(t["replica"], t["scenario"]))
    met = everything.join(done, ["collection", "ligand"], "left").withColumn("_tasks", left)
    return met.drop("_done", "_scenarios").where(F.size("_tasks") > 0)


def pending_grid(ligands: DataFrame, scenario_rows: DataFrame, latest: DataFrame, replica_base: int = 1) -> DataFrame:
    """The task grid without the tasks that have a final state.

    As in `pending_lists` only ligands are shuffled. Tasks are multiplied out behind the join and looked up row by row
    in compiled code: a list of them would be made, by interpreted functions, for each condition on it again.
    """
    met = ligands.join(_done_names(latest), ["collection", "ligand"], "left")
    rows = task_grid(met, scenario_rows, replica_base).where(_is_open(F.col("replica"), F.col("scenario")))
    return rows.drop("_done")


# A scorer gets the task as a dict and returns the program's log, the score itself, or a
# dict with any of `log`, `score` and `pose`.
Scorer = Callable[[dict], "str | float | dict"]


def command_scorer(command: Callable[[dict, str, str], list[str]], timeout: float | None = None) -> Scorer:
    """Scorer running an external program: `command(task, ligand_path, pose_path)` is its call.

    The ligand file is put in a folder of its own for the time of the run. A non-zero exit
    fails the task; otherwise the standard output is the log and the pose file the pose.
    """

    def run(task: dict) -> dict:
        with tempfile.TemporaryDirectory() as folder:
            ligand, pose = os.path.join(folder, "ligand"), os.path.join(folder, "pose")
            with open(ligand, "w") as file:
                file.write(task["content"])
            done = subprocess.run(
                command(task, ligand, pose), capture_output=True, text=True, timeout=timeout, cwd=folder
            )
            if done.returncode != 0:
                raise RuntimeError(f"exit {done.returncode}: {done.stderr.strip()}")
            out = {"log": done.stdout}
            if os.path.exists(pose):
                with open(pose) as file:
                    out["pose"] = file.read()
            return out

    return run


def _as_output(got: str | float | dict | None) -> dict:
    if isinstance(got, dict):
        return got
    return {"log": got} if isinstance(got, str) else {"score": got}


def _scoring(given: T.StructType, scorer: Scorer) -> tuple[T.StructType, Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]]:
    """Schema of scored tasks, and what turns frames of tasks into frames of scored tasks, see `run_scorer`."""
    listed = "_tasks" in given.names
    made = {"log": "string", "pose": "string", "score_given": "double", "error": "string", "seconds": "double"}
    schema = T.StructType([f for f in given.fields if f.name not in ("content", "_tasks")])
    for name, kind in TASK_TYPES.items() if listed else ():
        schema = schema.add(name, kind)
    for name, kind in made.items():
        schema = schema.add(name, kind)

    kinds = {f.name: _PANDAS_TYPES.get(f.dataType.typeName(), "object") for f in schema.fields}

    def expanded(row: dict) -> Iterator[dict]:
        """The tasks of a row; a row that is left out stays one row without a task."""
        if not listed:
            yield row
            return
        own = row.pop("_tasks")
        if own is None:
            yield row | dict.fromkeys(TASK_FIELDS)
            return
        for t in own:
            base = row | {f: t[f] for f in ("scenario_idx", "scenario", "program")}
            for replica in range(1, t["replicas"] + 1) if "replicas" in t else (t["replica"],):
                yield base | {"replica": replica}

    def score_one(task: dict) -> tuple:
        if task["scenario"] is None:
            return (None,) * len(made)
        start, out, error = time.perf_counter(), {}, None
        try:
            out = _as_output(scorer(task))
            score = None if out.get("score") is None else float(out["score"])
        except Exception as exc:  # noqa: BLE001 - any scorer failure is a task failure
            out, score, error = {}, None, f"{type(exc).__name__}: {exc}"
        return out.get("log"), out.get("pose"), score, error, time.perf_counter() - start

    def frame_of(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({n: pd.Series(values, dtype=kinds[n]) for n, values in zip(schema.names, zip(*rows))})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = [n for n in schema.names if n not in made]
        held: list[tuple] = []
        size, since = 0, time.perf_counter()
        for batch in batches:
            # Numbers with gaps come as floats.
            gaps = [n for n, k in kinds.items() if k.startswith("Int") and n in batch.columns and batch[n].dtype.kind == "f"]
            for values in batch.itertuples(index=False, name=None):
                row = dict(zip(batch.columns, values))
                row.update({n: None if row[n] != row[n] else int(row[n]) for n in gaps})
                for task in expanded(row):
                    scored = score_one(task)
                    held.append((*(task[n] for n in own), *scored))
                    size += len(scored[0] or "") + len(scored[1] or "")
                    if len(held) >= ROWS_AT_ONCE or size >= BYTES_AT_ONCE or time.perf_counter() - since >= SECONDS_AT_ONCE:
                        yield frame_of(held)
                        held, size, since = [], 0, time.perf_counter()
        if held:
            yield frame_of(held)

    return schema, run


def run_scorer(tasks: DataFrame, scorer: Scorer, partitions: int | None = None) -> DataFrame:
    """Run the scorer on each task; adds log, pose, score_given, error and seconds.

    A scorer that raises fails its own task only. Rows without a scenario (ligands left out)
    pass through. `partitions` spreads the tasks evenly first; by default they run where
    they are. The ligand's `content` is given to the scorer and dropped afterwards. Instead of task
    columns a row may have the list of its tasks as `_tasks` (null: left out), so that its content
    is sent once; it becomes one row per task here, a few at a time. Elements of the list are tasks, or
    scenarios with `replicas`, which stand for replicas from 1 on.
    """
    if partitions:
        keys = [c for c in ["collection", "ligand", "scenario", "replica"] if c in tasks.columns]
        tasks = tasks.repartition(partitions, *keys)
    schema, run = _scoring(tasks.schema, scorer)
    return tasks.mapInPandas(run, schema)


def run_in_chunks(tasks: DataFrame, scorer: Scorer, chunk: str, partitions: int, folder: str) -> DataFrame:
    """`run_scorer` for long runs: each chunk of rows (by the number in the column `chunk`) is kept as it is done.

    Scored tasks of a chunk go to a file in `folder`, which gets its name when it is whole. A chunk whose file is
    there is not scored again, be it by a task that runs again or by a new job; what is lost with a task is the
    chunk it was at. Each of the `partitions` does its chunks one by one. Returns all there is in `folder`.
    """
    store, where = archives.file_system(folder)
    store.create_dir(where, recursive=True)
    schema, run = _scoring(tasks.drop(chunk).schema, scorer)
    arrow = to_arrow_schema(schema)

    def score_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = ((number, rows) for batch in batches for number, rows in batch.groupby(chunk, sort=False))
        done = []
        for number, some in itertools.groupby(pieces, key=lambda p: p[0]):
            path = f"{folder}/chunk-{number:08d}.parquet"
            store, where = archives.file_system(path)
            if store.get_file_info(where).type != FileType.NotFound:
                continue
            with archives.written(path) as file, pq.ParquetWriter(file, arrow) as out:
                for frame in run(rows.drop(columns=chunk) for _, rows in some):
                    out.write_table(pa.Table.from_pandas(frame, schema=arrow, preserve_index=False))
            done.append(number)
        yield pd.DataFrame({"chunk": done}, dtype="int64")

    keys = [c for c in ("collection", "ligand") if c in tasks.columns]
    dealt = tasks.repartition(partitions, chunk).sortWithinPartitions(chunk, *keys)
    dealt.mapInPandas(score_chunks, "chunk LONG").agg(F.count("chunk")).collect()
    return tasks.sparkSession.read.schema(schema).parquet(folder)


def score_results(scored: DataFrame) -> DataFrame:
    """Turn scorer output into results: score from the log or as given, and the status."""
    score = F.coalesce("score_given", scores.score_of(F.col("program"), F.col("log")))
    status = (
        F.when(~scores.is_known_program(F.col("program")), fv.FAILED_PROGRAM)
        .when(F.col("error").isNotNull() | F.col("_score").isNull(), fv.FAILED_DOCKING)
        .otherwise(fv.SUCCEEDED)
    )
    return (
        scored.withColumn("_score", score)
        .withColumn("status", status)
        .withColumn("score", F.when(F.col("status") == fv.SUCCEEDED, F.col("_score")))
        .drop("_score", "score_given")
    )


def extract_score(logs: DataFrame, program_col: str = "program", log_col: str = "log") -> DataFrame:
    """Add score and status to logs of finished dockings."""
    return score_results(
        logs.withColumns({"score_given": F.lit(None).cast("double"), "error": F.lit(None).cast("string")})
        .withColumnsRenamed({program_col: "program", log_col: "log"})
    ).drop("error").withColumnsRenamed({"program": program_col, "log": log_col})


def extract_timings(logs: DataFrame, log_col: str = "log") -> DataFrame:
    parts = ("user", "real", "system")
    return logs.withColumns({f"{p}_seconds": scores.timing_of(F.col(log_col), p) for p in parts})


def first_pose(results: DataFrame, col: str = "pose") -> DataFrame:
    return results.withColumn(col, scores.first_pose_of(F.col(col)))


def energy_check(results: DataFrame, energies: DataFrame, energy_max: float) -> DataFrame:
    """Keep a docking when its pose energy is at most `energy_max`.

    Otherwise its status becomes `energy-check:failed` and its score and pose are dropped; an
    energy that could not be computed fails as well. Dockings that failed before stay as they are.
    """
    known = energies.select(*schemas.TASK_KEYS, "energy")
    passed = F.coalesce(F.col("energy") <= energy_max, F.lit(False))
    rejected = (F.col("status") == fv.SUCCEEDED) & ~passed
    out = results.join(known, schemas.TASK_KEYS, "left").withColumn("_out", rejected)
    changed = {
        "status": F.when(F.col("_out"), fv.FAILED_ENERGY).otherwise(F.col("status")),
        "score": F.when(~F.col("_out"), F.col("score")),
    }
    if "pose" in results.columns:
        changed["pose"] = F.when(~F.col("_out"), F.col("pose"))
    return out.withColumns(changed).drop("_out")
