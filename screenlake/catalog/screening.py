"""End-to-end screens."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake import fixed_values as fv
from screenlake.adapters import table
from screenlake.catalog.checks import LINES_SQL, SCORER_SQL, sample_scorer
from screenlake.catalog.registry import query
from screenlake.catalog.rollups import COUNTERS_SQL
from screenlake.functions.scores import one_place
from screenlake.operators import tasks
from screenlake.operators.batch import collection_outcomes, outcome_totals
from screenlake.operators.state import latest_state
from screenlake.operators.summary import all_summaries, collection_counters
from screenlake.plans import published
from screenlake.plans.screen import publish, screen
from screenlake.session import shared_path
from screenlake.sources import sinks, text

VALID_SQL = f"""
    {LINES_SQL}, {SCORER_SQL},
    docked AS (SELECT s.* FROM scored AS s JOIN checked AS c USING (collection, ligand) WHERE c.verdict = 'ok'),
    states AS (SELECT collection, ligand, status FROM docked UNION ALL SELECT collection, ligand, 'failed' FROM checked WHERE verdict <> 'ok')
"""


def _screen(spark, d, with_scores=False):
    return screen(table(spark, d, "ligand"), table(spark, d, "scenario"), sample_scorer, with_scores=with_scores)


@query(
    "r4_screen_summary",
    f"""WITH {VALID_SQL}
    SELECT scenario, collection, ligand, min(score) AS best_score, max(score) AS worst_score, CAST(count(score) AS INT) AS n_dockings,
           string_agg(CAST(CAST(round(score * 10) AS INT) AS STRING), ',' ORDER BY replica) AS scores_tenths
    FROM docked WHERE score IS NOT NULL GROUP BY 1, 2, 3""",
)
def r4_screen_summary(spark, d):
    tenths = F.transform("scores", lambda s: F.round(s * 10).cast("int").cast("string"))
    out = _screen(spark, d, with_scores=True).summary
    return out.withColumn("scores_tenths", F.array_join(tenths, ",")).drop("scores", "avg_score")


PUBLISHED_SQL = f"""WITH {VALID_SQL},
    r AS (SELECT collection, ligand, scenario, replica, status, score FROM docked),
    p AS (SELECT scenario, collection, ligand, min(score) AS best,
                 array_to_string(list_transform(range(1, max(replica) + 1), lambda k: coalesce(list_max(list_transform(list_filter(list((replica, printf('%.1f', score))), lambda q: q[1] = k), lambda q: q[2])), '-')), ' ') AS said
          FROM r WHERE score IS NOT NULL GROUP BY 1, 2, 3)
    SELECT 'complete' AS part, collection, ligand, scenario, replica, status, score FROM r
    UNION ALL SELECT 'status', collection, ligand, scenario, replica, status, score FROM r
    UNION ALL SELECT 'status', collection, ligand, NULL, NULL, 'failed', NULL FROM checked WHERE verdict <> 'ok'
    UNION ALL SELECT 'summary', collection, ligand, scenario, NULL, said, best FROM p
    UNION ALL SELECT 'counters', collection, NULL, NULL, NULL, concat(CAST(ligands_started AS STRING), ' ', CAST(dockings_failed AS STRING)), CAST(dockings_started AS DOUBLE)
              FROM ({COUNTERS_SQL.format("states")}) AS c"""


@query("r4_resume_publish", PUBLISHED_SQL)
def r4_resume_publish(spark, d):
    """A screen in two halves, both published, read back: the same rows as of one whole screen."""
    ligands, scenarios = table(spark, d, "ligand"), table(spark, d, "scenario")
    grid, root = tasks.task_grid(ligands.select("collection", "ligand"), scenarios), shared_path(spark, "screen")
    first = publish(screen(ligands, scenarios.withColumn("replicas", F.lit(1)), sample_scorer), root, 3, "tranche", grid)
    states = latest_state(first.status.withColumn("ts", F.current_timestamp()))
    publish(screen(ligands, scenarios, sample_scorer, finished=states), root, 3, "tranche", grid)
    every = text.read_summaries(spark, f"{root}/summaries", layout="table")
    summaries = all_summaries(*(every.where(F.col("state") == s).drop("state") for s in ("complete", "incomplete")))
    return _published_rows(sinks.read_results(spark, f"{root}/results"), text.read_status(spark, f"{root}/ligand-lists", "jsonl"), summaries)


def _published_rows(results, status, summaries):
    """Rows of all published tables in one."""
    columns = ["collection", "ligand", "scenario", "replica", "status", "score"]
    marker = F.array_join(F.transform("scores", one_place), " ", fv.NO_SCORE)
    none = F.lit(None).cast("string")
    return (
        results.select(F.col("state").alias("part"), *columns)
        .unionByName(status.select(F.lit("status").alias("part"), *columns))
        .unionByName(summaries.select(
            F.lit("summary").alias("part"), "collection", "ligand", "scenario", F.lit(None).cast("int").alias("replica"),
            marker.alias("status"), F.col("best_score").alias("score"),
        ))
        .unionByName(collection_counters(status).select(
            F.lit("counters").alias("part"), "collection", none.alias("ligand"), none.alias("scenario"), F.lit(None).cast("int").alias("replica"),
            F.concat_ws(" ", "ligands_started", "dockings_failed").alias("status"), F.col("dockings_started").cast("double").alias("score"),
        ))
    )


@query("r4_publish_runs", PUBLISHED_SQL)
def r4_publish_runs(spark, d):
    """A screen in three runs, the last with open tasks of the first: each is committed with one snapshot."""
    ligands, scenarios = table(spark, d, "ligand"), table(spark, d, "scenario")
    grid, root = tasks.task_grid(ligands.select("collection", "ligand"), scenarios), shared_path(spark, "runs")
    some = F.col("collection").startswith("E")
    single = scenarios.withColumn("replicas", F.lit(1))
    first = published.publish_run(screen(ligands.where(some), single, sample_scorer), root, 3, "tranche", grid.where(some))
    published.publish_run(screen(ligands.where(~some), scenarios, sample_scorer), root, 3, "tranche", grid.where(~some))
    states = latest_state(first.status.withColumn("ts", F.current_timestamp()))
    published.publish_run(screen(ligands.where(some), scenarios, sample_scorer, finished=states), root, 3, "tranche", grid.where(some))
    summaries = published.published_summaries(spark, root)
    return _published_rows(published.published_results(spark, root), published.published_status(spark, root), summaries)


@query("r4_screen_counters", f"WITH {VALID_SQL} " + COUNTERS_SQL.format("states"))
def r4_screen_counters(spark, d):
    return _screen(spark, d).counters


@query(
    "a11_outcome_totals",
    """WITH e AS (SELECT CASE status WHEN 'failed' THEN 'ligands_removed' WHEN 'failed(docking)' THEN 'ligands_failed_docking'
                              WHEN 'succeeded' THEN 'ligands_succeeded_docking' ELSE 'unknown_event' END AS outcome FROM @status)
    SELECT outcome, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM e) AS percent FROM e GROUP BY 1""",
)
def a11_outcome_totals(spark, d):
    return outcome_totals(collection_outcomes(table(spark, d, "status")))
