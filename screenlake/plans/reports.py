"""Reports. They return tables; laying them out as text is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.operators import batch, progress, summary, tasks


def _section(name: str, metrics: DataFrame) -> DataFrame:
    return metrics.select(F.lit(name).alias("section"), "metric", F.col("value").cast("long").alias("value"))


def workflow_report(
    manifest: DataFrame,
    done: DataFrame,
    current: DataFrame,
    todo: DataFrame,
    scenario_rows: DataFrame,
    jobs: DataFrame | None = None,
) -> DataFrame:
    """(section, metric, value): joblines, collections, ligands and dockings of a campaign."""
    numbers = progress.workflow_numbers(manifest, done, current, todo)
    # The first word of a metric names its section.
    section = F.substring_index("metric", "_", 1).alias("section")
    doubles = progress.double_assigned(current).agg(F.count(F.lit(1)).alias("collections_double_assigned"))
    runs = tasks.runs_per_ligand(scenario_rows)
    report = (
        numbers.select(section, "metric", "value")
        .unionAll(_section("collections", progress.as_metrics(doubles)))
        .unionAll(_section("dockings", progress.as_metrics(runs)))
    )
    if jobs is not None:
        report = report.unionAll(_section("joblines", progress.job_totals(jobs)))
    return report


def screening_report(
    summaries: DataFrame, statistics: bool = True, n: int = 0, score_col: str = "best_score"
) -> DataFrame:
    """(section, position, collection, ligand, value): histogram bins and the n top compounds.

    n = 0 leaves the top list out.
    """
    empty = F.lit(None).cast("string")
    parts = []
    if statistics:
        parts.append(
            summary.score_histogram(summaries, score_col).select(
                F.lit("histogram").alias("section"),
                F.col("bin").cast("int").alias("position"),
                empty.alias("collection"),
                empty.alias("ligand"),
                F.col("n_ligands").cast("double").alias("value"),
            )
        )
    if n > 0:
        parts.append(
            summary.top_compounds(summaries, n, score_col).select(
                F.lit("top").alias("section"),
                F.col("rank").cast("int").alias("position"),
                "collection",
                "ligand",
                F.col("score").cast("double").alias("value"),
            )
        )
    if not parts:
        raise ValueError("nothing to report: statistics are off and n is 0")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def batch_report(workunits: DataFrame, subjobs: DataFrame, attempts: DataFrame, events: DataFrame) -> DataFrame:
    """(section, metric, value): status matrix cells, vCPU metrics and docking outcomes."""
    matrix = batch.status_matrix(workunits, subjobs, attempts)
    columns = [*batch.STATUS_COLUMNS, "TOTAL"]
    cells = matrix.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit("status").alias("section"),
                        F.concat_ws(".", "category", F.lit(c)).alias("metric"),
                        F.col(c).alias("value"),
                    )
                    for c in columns
                )
            )
        )
    )
    metrics = batch.vcpu_metrics(workunits, subjobs, attempts).select(
        F.lit("vcpu").alias("section"), "metric", "value"
    )
    outcomes = batch.outcome_totals(batch.collection_outcomes(events)).select(
        F.inline(
            F.array(
                F.struct(F.lit("outcome").alias("section"), F.col("outcome").alias("metric"),
                         F.col("n").cast("double").alias("value")),
                F.struct(F.lit("outcome").alias("section"),
                         F.concat(F.col("outcome"), F.lit("_percent")).alias("metric"),
                         F.col("percent").alias("value")),
            )
        )
    )
    return cells.unionAll(metrics).unionAll(outcomes)
