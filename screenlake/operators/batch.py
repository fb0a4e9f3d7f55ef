"""Batch accounting: job states, attempts, vCPU time and docking outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake import fixed_values as fv
from screenlake.functions.status import outcome_of
from screenlake.operators.joins import salted_join
from screenlake.operators.progress import as_metrics

STATUS_COLUMNS = (*fv.BATCH_STATUS_NAMES, fv.UNKNOWN_STATUS)
SUBJOB_KEYS = ["workunit", "subjob"]


def batch_status_dim(spark: SparkSession) -> DataFrame:
    """The seven job statuses with their order and flags."""
    schema = "status STRING, status_order INT, completed INT, check_parent INT, check_subjobs INT"
    return spark.createDataFrame(list(fv.BATCH_STATUSES), schema)


def is_completed(status: Column) -> Column:
    names = [s[0] for s in fv.BATCH_STATUSES if s[2]]
    return F.coalesce(status.isin(*names), F.lit(False))


def merge_status(current: DataFrame, snapshot: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Current states with newer ones from a snapshot; a completed state is never replaced.

    Both tables have one row per key. New keys of the snapshot are added.
    """
    keys = keys or SUBJOB_KEYS
    rest = [c for c in current.columns if c not in keys]
    new = snapshot.select(*keys, *(F.col(c).alias(f"_{c}") for c in rest), F.lit(True).alias("_in"))
    joined = current.withColumn("_had", F.lit(True)).join(new, keys, "full")
    keep = F.col("_in").isNull() | (F.col("_had").isNotNull() & is_completed(F.col("status")))
    merged = [
        F.when(keep, F.col(c)).otherwise(F.coalesce(F.col(f"_{c}"), F.col(c))).alias(c) for c in rest
    ]
    return joined.select(*keys, *merged)


def to_check(current: DataFrame) -> DataFrame:
    """Rows whose state is not final and has to be asked for again."""
    return current.where(~is_completed(F.col("status")))


def attempt_times(attempts: DataFrame) -> DataFrame:
    """Per subjob: attempts, milliseconds of all started ones and of the last normal exit."""
    started = F.col("started_at").isNotNull()
    ms = F.when(started, F.col("stopped_at") - F.col("started_at"))
    normal = started & (F.col("reason") == fv.NORMAL_EXIT)
    last = F.max(F.when(normal, F.struct("attempt_no", "started_at", ms.alias("ms"))))
    return attempts.groupBy(*SUBJOB_KEYS).agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.coalesce(F.sum(ms), F.lit(0)).alias("total_ms"),
        F.coalesce(last["ms"], F.lit(0)).alias("success_ms"),
    )


VCPU_TIMES = ("vcpu_ms_total", "vcpu_ms_success", "vcpu_ms_retried")


def _with_vcpu_ms(subjobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Attempts are folded to one row per subjob before they meet the subjob table.

    Times stay whole milliseconds so that sums do not depend on their order.
    """
    total = F.coalesce("total_ms", F.lit(0)) * F.col("vcpus")
    success = F.coalesce("success_ms", F.lit(0)) * F.col("vcpus")
    return (
        subjobs.join(attempt_times(attempts), SUBJOB_KEYS, "left")
        .withColumns(
            {
                "vcpu_ms_total": total,
                "vcpu_ms_success": success,
                "vcpu_ms_retried": total - success,
                "reattempts": F.greatest(F.coalesce("n_attempts", F.lit(0)) - 1, F.lit(0)),
            }
        )
        .drop("n_attempts", "total_ms", "success_ms")
    )


def subjob_vcpu(subjobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """vCPU minutes per subjob: all attempts, the successful one, the retried rest."""
    minutes = {c.replace("_ms_", "_min_"): F.col(c) / 60000 for c in VCPU_TIMES}
    return _with_vcpu_ms(subjobs, attempts).withColumns(minutes).drop(*VCPU_TIMES)


def resolved_subjobs(workunits: DataFrame, subjobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Subjobs of submitted work units with vCPU times; a missing state is the parent's.

    Only completed subjobs have vCPU time: others show 0.
    """
    parents = workunits.select("workunit", F.col("status").alias("_parent"), F.lit(True).alias("_known"))
    state = F.coalesce("status", "_parent", F.lit(fv.UNKNOWN_STATUS))
    known_state = F.when(state.isin(*fv.BATCH_STATUS_NAMES), state).otherwise(fv.UNKNOWN_STATUS)
    out = (
        salted_join(_with_vcpu_ms(subjobs, attempts), parents, ["workunit"])
        .where(F.col("_known"))
        .withColumn("status", known_state)
        .drop("_parent", "_known")
    )
    done = is_completed(F.col("status"))
    return out.withColumns(
        {c: F.when(done, F.col(c)).otherwise(F.lit(0)) for c in (*VCPU_TIMES, "reattempts")}
    )


def _long_form(table: DataFrame, names: dict[str, Column]) -> DataFrame:
    rows = [F.struct(F.lit(n).alias("category"), c.cast("double").alias("value")) for n, c in names.items()]
    return table.select("status", F.inline(F.array(*rows)))


def status_sums(workunits: DataFrame, subjobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Sums over the subjobs of each state, at most one row per state: matrix and metrics are made of
    these, so a report that shows both folds subjobs and attempts once."""
    summed = {"ligands": "n_ligands", "ms": "vcpu_ms_total", "ms_retried": "vcpu_ms_retried", "vcpus": "vcpus", "reattempts": "reattempts"}
    return resolved_subjobs(workunits, subjobs, attempts).groupBy("status").agg(
        F.count(F.lit(1)).alias("subjobs"), *(F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in summed.items())
    )


def status_matrix(workunits: DataFrame, subjobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Rows ligands, jobs, subjobs, vcpu_min, vcpu_hours; a column per status and TOTAL."""
    per_status = status_sums(workunits, subjobs, attempts)
    measures = {
        "ligands": F.col("ligands"),
        "subjobs": F.col("subjobs"),
        "vcpu_min": F.col("ms"),
        "vcpu_hours": F.col("ms"),
    }
    state = F.coalesce("status", F.lit(fv.UNKNOWN_STATUS))
    known_state = F.when(state.isin(*fv.BATCH_STATUS_NAMES), state).otherwise(fv.UNKNOWN_STATUS)
    per_job = workunits.groupBy(known_state.alias("status")).agg(F.count(F.lit(1)).alias("jobs"))
    every = [(fv.UNKNOWN_STATUS, c, 0.0) for c in (*measures, "jobs")]
    empty = workunits.sparkSession.createDataFrame(every, "status STRING, category STRING, value DOUBLE")
    cells = (
        _long_form(per_status, measures)
        .unionByName(_long_form(per_job, {"jobs": F.col("jobs")}))
        .unionByName(empty)
    )
    # vCPU cells are whole milliseconds up to here.
    unit = (
        F.when(F.col("category") == "vcpu_min", 60000.0)
        .when(F.col("category") == "vcpu_hours", 3600000.0)
        .otherwise(1.0)
    )
    sums = cells.groupBy("category").agg(
        *(
            F.sum(F.when(F.col("status") == s, F.col("value")).otherwise(0.0)).alias(s)
            for s in STATUS_COLUMNS
        ),
        F.sum("value").alias("TOTAL"),
    )
    return sums.select("category", *((F.col(c) / unit).alias(c) for c in (*STATUS_COLUMNS, "TOTAL")))


def vcpu_metrics(workunits: DataFrame, subjobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Efficiency of the batch run as (metric, value)."""
    sums = status_sums(workunits, subjobs, attempts)

    def total(name: str, *states: str) -> Column:
        value = F.when(F.col("status").isin(*states), F.col(name)) if states else F.col(name)
        return F.coalesce(F.sum(value), F.lit(0)).cast("double")

    hour = 3600000.0
    one_row = sums.agg(
        (total("ms") / hour).alias("vcpu_hours_total"),
        (total("ms_retried") / hour).alias("vcpu_hours_interrupted"),
        (total("ms", "FAILED") / hour).alias("vcpu_hours_failed"),
        (total("ms", "SUCCEEDED") / hour).alias("vcpu_hours_succeeded"),
        F.try_divide(total("ms", "SUCCEEDED") / 1000, total("ligands", "SUCCEEDED")).alias(
            "vcpu_seconds_per_ligand"
        ),
        total("vcpus", "RUNNING").alias("active_vcpus"),
        total("reattempts").alias("total_reattempts"),
    )
    return as_metrics(one_row, "double")


def collection_outcomes(events: DataFrame) -> DataFrame:
    """Outcome counters per collection."""
    outcome = outcome_of(F.col("status"))
    return events.groupBy("collection").agg(*(F.count_if(outcome == o).alias(o) for o in fv.OUTCOMES))


def outcome_totals(per_collection: DataFrame) -> DataFrame:
    """(outcome, n, percent) over all collections; percent is null without events."""
    sums = per_collection.agg(*(F.coalesce(F.sum(o), F.lit(0)).alias(o) for o in fv.OUTCOMES))
    events = sum((F.col(o) for o in fv.OUTCOMES), F.lit(0))
    rows = F.array(
        *(
            F.struct(
                F.lit(o).alias("outcome"),
                F.col(o).cast("long").alias("n"),
                F.try_divide(F.col(o) * 100.0, F.col("_events")).alias("percent"),
            )
            for o in fv.OUTCOMES
        )
    )
    return sums.withColumn("_events", events).select(F.inline(rows))


def outcome_rollup(events: DataFrame) -> DataFrame:
    """Counters and percentages per collection and, with a null collection, overall.

    Events are folded per collection first; totals and shares come from that small table.
    """
    per_collection = collection_outcomes(events)
    rolled = per_collection.rollup("collection").agg(*(F.coalesce(F.sum(o), F.lit(0)).alias(o) for o in fv.OUTCOMES))
    n_events = sum((F.col(o) for o in fv.OUTCOMES), F.lit(0))
    return rolled.withColumn("n_events", n_events).withColumns(
        {f"{o}_percent": F.try_divide(F.col(o) * 100.0, F.col("n_events")) for o in fv.OUTCOMES}
    )
