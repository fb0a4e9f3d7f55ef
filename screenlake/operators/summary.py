"""Score summaries per ligand, score histogram and top compounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake import fixed_values as fv
from screenlake.functions.scores import histogram_bin
from screenlake.functions.status import is_failure, is_success
from screenlake.operators.joins import salted_join
from screenlake.operators.ordering import number_rows
from screenlake.session import stable

LIGAND_KEYS = ["scenario", "collection", "ligand"]


def _within(replica: Column, max_replicas: int | None, replica_base: int) -> Column:
    """The replica; an error where it is not one of `max_replicas` from `replica_base`."""
    if max_replicas is None:
        return replica
    last = replica_base + max_replicas - 1
    beyond = F.raise_error(F.format_string(f"replica %d is beyond max_replicas={max_replicas} from {replica_base}", replica))
    return F.when((replica < replica_base) | (replica > last), beyond.cast("int")).otherwise(replica)


def ligand_summary(
    results: DataFrame, with_scores: bool = True, max_replicas: int | None = None, replica_base: int = 1, padded: bool = False
) -> DataFrame:
    """Per (scenario, collection, ligand): avg, best (lowest), worst, n and scores by replica.

    Only ligands with a score appear. `scores` has one entry per replica, in replica order,
    so its length is bounded by the replica count; a replica docked more than once counts
    fully in avg and n and shows its best score. Sums are kept in the type of `score`.
    With `padded` the n-th entry belongs to the n-th replica from `replica_base`, null where that one
    has no score, up to the last one with a score. With `max_replicas` any other replica is an error.

    Rows are folded per replica first, so that no list grows with repeats.
    """
    scored = results.where(F.col("score").isNotNull())
    if not with_scores:
        totals = [F.sum("score").alias("_sum"), F.count("score").alias("_n"), F.min("score").alias("best"), F.max("score").alias("worst")]
        grouped = scored.groupBy(*LIGAND_KEYS).agg(*totals)
    else:
        checked = scored.withColumn("replica", _within(F.col("replica"), max_replicas, replica_base))
        per_replica = checked.groupBy(*LIGAND_KEYS, "replica").agg(
            F.sum("score").alias("s"),
            F.count("score").alias("c"),
            F.min("score").alias("lo"),
            F.max("score").alias("hi"),
        )
        grouped = per_replica.groupBy(*LIGAND_KEYS).agg(
            F.sum("s").alias("_sum"),
            F.sum("c").alias("_n"),
            F.min("lo").alias("best"),
            F.max("hi").alias("worst"),
            F.sort_array(F.collect_list(F.struct("replica", F.col("lo").cast("double").alias("score")))).alias("_pairs"),
        )
        if padded:
            known = F.map_from_entries(F.filter("_pairs", lambda p: p["replica"].isNotNull()))
            numbers = F.sequence(F.lit(replica_base), F.element_at("_pairs", -1)["replica"])
            grouped = grouped.withColumn("_scores", F.transform(numbers, lambda k: F.try_element_at(known, k)))
        else:
            grouped = grouped.withColumn("_scores", F.col("_pairs")["score"])
    return grouped.select(
        *LIGAND_KEYS,
        (F.col("_sum").cast("double") / F.col("_n")).alias("avg_score"),
        F.col("best").cast("double").alias("best_score"),
        F.col("worst").cast("double").alias("worst_score"),
        F.col("_n").cast("int").alias("n_dockings"),
        *([F.col("_scores").alias("scores")] if with_scores else []),
    )


def scores_wide(results: DataFrame, max_replicas: int) -> DataFrame:
    """One column per replica, null where that replica has no score; any other replica is an error."""
    checked = results.withColumn("replica", _within(F.col("replica"), max_replicas, 1))
    return checked.groupBy(*LIGAND_KEYS).agg(
        *(
            F.min(F.when(F.col("replica") == k, F.col("score"))).cast("double").alias(f"score_replica_{k}")
            for k in range(1, max_replicas + 1)
        )
    )


def collection_counters(status: DataFrame) -> DataFrame:
    """Distinct ligands and dockings started / succeeded / failed per collection.

    Ligands are folded first, so no collection has to hold its set of ligands in one task.
    """
    state = F.col("status")
    per_ligand = status.groupBy("collection", "ligand").agg(
        F.count(F.lit(1)).alias("started"),
        F.count_if(is_success(state)).alias("succeeded"),
        F.count_if(is_failure(state)).alias("failed"),
    )
    return per_ligand.groupBy("collection").agg(
        F.count(F.lit(1)).alias("ligands_started"),
        F.count_if(F.col("succeeded") > 0).alias("ligands_succeeded"),
        F.count_if(F.col("failed") > 0).alias("ligands_failed"),
        F.sum("started").alias("dockings_started"),
        F.sum("succeeded").alias("dockings_succeeded"),
        F.sum("failed").alias("dockings_failed"),
    )


def score_histogram(summary: DataFrame, score_col: str = "best_score") -> DataFrame:
    """(bin, n_ligands) for the 24 fixed bins; empty bins count 0."""
    counted = (
        summary.groupBy(histogram_bin(F.col(score_col)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("bin").isNotNull())
    )
    bins = summary.sparkSession.range(fv.HISTOGRAM_BINS).select(F.col("id").cast("int").alias("bin"))
    # At most 24 counted rows.
    return bins.join(F.broadcast(counted), "bin", "left").select(
        "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n_ligands")
    )


# Quantiles are known up to one in so many rows; cut-offs are looked up at halves, quarters, ... of them.
ACCURACY = 10_000
SHARES = [2.0**-k for k in range(24, -1, -1)]


def _cut_off(rows: DataFrame, score_col: str, n: int) -> Column:
    """A score that at least n rows (or all) reach, and not many more: a scalar subquery.

    Quantile sketches of the tasks are merged. The subquery aggregates the same rows as the query around it, whose
    shuffle it shares.
    """
    sketch = rows.agg(F.percentile_approx(score_col, F.array(*map(F.lit, SHARES)), ACCURACY).alias("cuts"), F.count(F.lit(1)).alias("rows"))
    wanted = F.lit(n) / F.col("rows") + 2 / ACCURACY
    at = F.size(F.filter(F.array(*map(F.lit, SHARES)), lambda share: share < wanted))
    return sketch.select(F.when(F.col("rows") > 0, F.get("cuts", F.least(at, F.lit(len(SHARES) - 1))))).scalar()


def top_compounds(summary: DataFrame, n: int, score_col: str = "best_score") -> DataFrame:
    """The n best (lowest) scores with rank; ties by collection, then ligand.

    Rows beyond a cut-off score are left out first; those that stay, ties at the cut-off included, are sorted over
    the whole cluster and numbered, so no task holds more than its share of a long list.
    """
    # The scenario only settles ties when several scenarios are passed at once.
    keys = ["collection", "ligand"] + (["scenario"] if "scenario" in summary.columns else [])
    order = [score_col, *keys]
    rows = summary.where(F.col(score_col).isNotNull()).select(*order)
    near = stable(rows.where(F.col(score_col) <= _cut_off(rows, score_col, n)))
    ranked = number_rows(near, order, "rank")
    return ranked.where(F.col("rank") <= n).select(F.col("rank").cast("int").alias("rank"), *keys, F.col(score_col).alias("score"))


def summaries_by_state(results: DataFrame) -> DataFrame:
    """Summaries (without score lists) of results with a `state`; a collection that is complete leaves
    out its incomplete rows. Results are aggregated once, with the state as a key."""
    scored = results.where(F.col("score").isNotNull())
    per_state = scored.groupBy(*LIGAND_KEYS, "state").agg(
        (F.sum("score").cast("double") / F.count("score")).alias("avg_score"),
        F.min("score").cast("double").alias("best_score"),
        F.max("score").cast("double").alias("worst_score"),
        F.count("score").cast("int").alias("n_dockings"),
    )
    keys = ["scenario", "collection"]
    done = per_state.where("state = 'complete'").select(*keys).distinct().withColumn("_done", F.lit(True))
    return salted_join(per_state, done, keys).where("state = 'complete' OR _done IS NULL").drop("_done")


def all_summaries(complete: DataFrame, incomplete: DataFrame) -> DataFrame:
    """Complete and incomplete summaries; a collection found in both counts as complete."""
    keys = [c for c in ("scenario", "collection") if c in complete.columns and c in incomplete.columns]
    done = complete.select(*keys).distinct()
    open_rows = salted_join(incomplete, done, keys, "left_anti")
    return complete.withColumn("state", F.lit("complete")).unionByName(
        open_rows.withColumn("state", F.lit("incomplete")), allowMissingColumns=True
    )
