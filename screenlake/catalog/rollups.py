"""Summaries, histograms, top lists, progress and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.adapters import table
from screenlake.catalog.registry import query
from screenlake.functions.status import outcome_of
from screenlake.operators import progress, state, summary, tasks
from screenlake.plans import reports

SUMMARY_SQL = """
    SELECT scenario, collection, ligand, CAST(sum(score) AS DOUBLE) / count(score) AS avg_score,
           CAST(min(score) AS DOUBLE) AS best_score, CAST(max(score) AS DOUBLE) AS worst_score,
           CAST(count(score) AS INT) AS n_dockings
    FROM @result WHERE score IS NOT NULL GROUP BY 1, 2, 3
"""

BIN_SQL = """
    CASE WHEN best_score >= 0 THEN 23 WHEN best_score > -5 THEN 0
         WHEN best_score > -15 THEN CAST(floor((-best_score - 5) * 2) AS INT) + 1
         WHEN best_score > -20 THEN 21 ELSE 22 END
"""


A1_SQL = (
    """
    WITH per_replica AS (
        SELECT scenario, collection, ligand, replica, min(score) AS lo FROM @result
        WHERE score IS NOT NULL GROUP BY 1, 2, 3, 4),
    lists AS (
        SELECT scenario, collection, ligand, string_agg(CAST(CAST(lo * 4 AS INT) AS STRING), ',' ORDER BY replica) AS scores_quarters
        FROM per_replica GROUP BY 1, 2, 3),
    s AS ("""
    + SUMMARY_SQL
    + """)
    SELECT s.*, scores_quarters FROM s JOIN lists USING (scenario, collection, ligand)
    """
)


@query("a1_ligand_summary", A1_SQL)
def a1_ligand_summary(spark, d):
    return _with_quarters(summary.ligand_summary(table(spark, d, "result"), max_replicas=7))


@query("a1_ligand_summary_any_replicas", A1_SQL)
def a1_ligand_summary_any_replicas(spark, d):
    return _with_quarters(summary.ligand_summary(table(spark, d, "result")))


@query("a1_ligand_summary_from_zero", A1_SQL)
def a1_ligand_summary_from_zero(spark, d):
    rows = table(spark, d, "result").withColumn("replica", F.col("replica") - 1)
    return _with_quarters(summary.ligand_summary(rows, max_replicas=7, replica_base=0))


@query("a1_ligand_summary_many_replicas", A1_SQL)
def a1_ligand_summary_many_replicas(spark, d):
    rows = table(spark, d, "result").withColumn("replica", F.col("replica") * 30)
    return _with_quarters(summary.ligand_summary(rows, max_replicas=210))


def _with_quarters(out):
    quarters = F.transform("scores", lambda s: (s * 4).cast("int").cast("string"))
    return out.withColumn("scores_quarters", F.array_join(quarters, ",")).drop("scores")


def _summary(spark, d):
    return summary.ligand_summary(table(spark, d, "result"), with_scores=False)


@query(
    "a2_scores_wide",
    """
    SELECT scenario, collection, ligand,
    """ + ", ".join(f"CAST(min(score) FILTER (replica = {k}) AS DOUBLE) AS score_replica_{k}" for k in range(1, 8)) + """
    FROM @result GROUP BY 1, 2, 3
    """,
)
def a2_scores_wide(spark, d):
    return summary.scores_wide(table(spark, d, "result"), 7)


COUNTERS_SQL = """
    SELECT collection, count(DISTINCT ligand) AS ligands_started,
           count(DISTINCT CASE WHEN status LIKE '%succeeded%' THEN ligand END) AS ligands_succeeded,
           count(DISTINCT CASE WHEN status LIKE '%failed%' THEN ligand END) AS ligands_failed,
           count(*) AS dockings_started,
           count(*) FILTER (status LIKE '%succeeded%') AS dockings_succeeded,
           count(*) FILTER (status LIKE '%failed%') AS dockings_failed
    FROM {} GROUP BY 1
"""


@query("a3_collection_counters", COUNTERS_SQL.format("@result"))
def a3_collection_counters(spark, d):
    return summary.collection_counters(table(spark, d, "result"))


def _lists(spark, d):
    rows = table(spark, d, "assignment")
    return {c: rows.where(F.col("list") == c) for c in "FOP"}


PROGRESS_SQL = """
    SELECT 'collections_total' AS metric, (SELECT count(*) FROM @manifest) AS value
    UNION ALL SELECT 'collections_completed', (SELECT count(*) FROM @done)
    UNION ALL SELECT 'collections_processing', (SELECT count(*) FROM @assignment WHERE list = 'P')
    UNION ALL SELECT 'collections_todo', (SELECT count(*) FROM @assignment WHERE list = 'O')
"""


@query("a4_workflow_progress", PROGRESS_SQL)
def a4_workflow_progress(spark, d):
    lists = _lists(spark, d)
    return progress.workflow_progress(
        table(spark, d, "manifest"), table(spark, d, "done"), lists["P"], lists["O"]
    )


TOTALS_SQL = "SELECT 'ligands_total' AS metric, CAST((SELECT sum(n_ligands) FROM @manifest) AS BIGINT) AS value" + "".join(
    f" UNION ALL SELECT '{c}', CAST((SELECT sum({c}) FROM @done) AS BIGINT)" for c in progress.COUNTERS
)


@query("a5_workflow_totals", TOTALS_SQL)
def a5_workflow_totals(spark, d):
    return progress.workflow_totals(table(spark, d, "manifest"), table(spark, d, "done"))


# Scenario lists of all suppliers' control files: work grows with the supplier table.
@query(
    "a6_runs_per_ligand",
    """SELECT CAST(sum(s_nationkey % 3 + 1 + s_suppkey % 5 + 1 + 2) AS BIGINT) AS runs_per_ligand FROM supplier""",
)
def a6_runs_per_ligand(spark, d):
    return tasks.runs_per_ligand(tasks.scenarios(table(spark, d, "control")))


HISTOGRAM_SQL = (
    "WITH s AS (" + SUMMARY_SQL + "), b AS (SELECT " + BIN_SQL + """ AS bin FROM s)
    SELECT CAST(r.range AS INT) AS bin, count(b.bin) AS n_ligands FROM range(24) AS r LEFT JOIN b ON b.bin = r.range GROUP BY 1
    """
)


@query("a7_score_histogram", HISTOGRAM_SQL)
def a7_score_histogram(spark, d):
    return summary.score_histogram(_summary(spark, d))


@query(
    "k1_top_compounds",
    "WITH s AS (" + SUMMARY_SQL + """)
    SELECT CAST(row_number() OVER (ORDER BY best_score, collection, ligand, scenario) AS INT) AS rank,
           collection, ligand, scenario, best_score AS score
    FROM s ORDER BY best_score, collection, ligand, scenario LIMIT 100
    """,
)
def k1_top_compounds(spark, d):
    return summary.top_compounds(_summary(spark, d), 100)


@query(
    "k1_top_compounds_nearly_all",
    "WITH s AS (" + SUMMARY_SQL + """)
    SELECT CAST(row_number() OVER (ORDER BY best_score, collection, ligand, scenario) AS INT) AS rank,
           collection, ligand, scenario, best_score AS score
    FROM s ORDER BY best_score, collection, ligand, scenario LIMIT 50000
    """,
)
def k1_top_compounds_nearly_all(spark, d):
    return summary.top_compounds(_summary(spark, d), 50_000)


@query(
    "k1_top_compounds_average",
    "WITH s AS (" + SUMMARY_SQL + """)
    SELECT CAST(row_number() OVER (ORDER BY avg_score, collection, ligand, scenario) AS INT) AS rank,
           collection, ligand, scenario, avg_score AS score
    FROM s ORDER BY avg_score, collection, ligand, scenario LIMIT 50
    """,
)
def k1_top_compounds_average(spark, d):
    return summary.top_compounds(_summary(spark, d), 50, "avg_score")


@query(
    "a11_outcome_rollup",
    """
    WITH e AS (SELECT collection,
                 CASE status WHEN 'failed' THEN 'r' WHEN 'failed(docking)' THEN 'f' WHEN 'succeeded' THEN 's' ELSE 'u' END AS o
               FROM @status),
    c AS (SELECT collection, count(*) FILTER (o = 's') AS ligands_succeeded_docking, count(*) FILTER (o = 'r') AS ligands_removed,
                 count(*) FILTER (o = 'f') AS ligands_failed_docking, count(*) FILTER (o = 'u') AS unknown_event, count(*) AS n_events
          FROM e GROUP BY ROLLUP (collection))
    SELECT *, ligands_succeeded_docking * 100.0::DOUBLE / n_events AS ligands_succeeded_docking_percent,
           ligands_removed * 100.0::DOUBLE / n_events AS ligands_removed_percent,
           ligands_failed_docking * 100.0::DOUBLE / n_events AS ligands_failed_docking_percent,
           unknown_event * 100.0::DOUBLE / n_events AS unknown_event_percent
    FROM c
    """,
)
def a11_outcome_rollup(spark, d):
    from screenlake.operators.batch import outcome_rollup

    return outcome_rollup(table(spark, d, "status"))


@query(
    "a12_double_assigned",
    """SELECT collection, count(DISTINCT (jobline, step, queue)) AS n_queues FROM @assignment
       GROUP BY 1 HAVING count(DISTINCT (jobline, step, queue)) > 1""",
)
def a12_double_assigned(spark, d):
    return progress.double_assigned(table(spark, d, "assignment"))


@query(
    "a13_job_snapshot",
    """SELECT queue, count(*) FILTER (state = 'RUNNING') AS running, count(*) FILTER (state = 'PENDING') AS not_running,
              CAST(sum(CASE WHEN state <> 'RUNNING' THEN 0 WHEN slots LIKE '%*%' THEN CAST(string_split(slots, '*')[1] AS INT) ELSE 1 END) AS BIGINT) AS cores
       FROM @job GROUP BY 1""",
)
def a13_job_snapshot(spark, d):
    return progress.job_snapshot(table(spark, d, "job"))


JOB_TOTALS_SQL = """
    SELECT 'joblines' AS metric, count(*) AS value FROM @job
    UNION ALL SELECT 'joblines_running', count(*) FROM @job WHERE state = 'RUNNING'
    UNION ALL SELECT 'joblines_not_running', count(*) FROM @job WHERE state <> 'RUNNING'
    UNION ALL SELECT 'queues', count(DISTINCT queue) FROM @job
    UNION ALL SELECT 'cores', CAST(sum(CASE WHEN state <> 'RUNNING' THEN 0 WHEN slots LIKE '%*%' THEN CAST(string_split(slots, '*')[1] AS INT) ELSE 1 END) AS BIGINT) FROM @job
"""


@query("a13_job_totals", JOB_TOTALS_SQL)
def a13_job_totals(spark, d):
    return progress.job_totals(table(spark, d, "job"))


@query(
    "a14_queue_load",
    """SELECT jobline, step, queue, CAST(sum(n_ligands) AS BIGINT) AS n_ligands, count(*) AS n_collections
       FROM @assignment WHERE list IN ('O', 'P') GROUP BY 1, 2, 3""",
)
def a14_queue_load(spark, d):
    lists = _lists(spark, d)
    return progress.queue_load(lists["O"], lists["P"])


@query(
    "p11_classify_status",
    """SELECT collection, ligand, status,
              CASE status WHEN 'failed' THEN 'ligands_removed' WHEN 'failed(docking)' THEN 'ligands_failed_docking'
                   WHEN 'succeeded' THEN 'ligands_succeeded_docking' ELSE 'unknown_event' END AS outcome
       FROM @status""",
)
def p11_classify_status(spark, d):
    rows = table(spark, d, "status")
    return rows.select("collection", "ligand", "status", outcome_of(F.col("status")).alias("outcome"))


LATEST_SQL = """
    SELECT collection, ligand, scenario, replica, ts, status, info, seconds, score FROM (
        SELECT *, row_number() OVER (PARTITION BY collection, ligand, scenario, replica
                  ORDER BY ts DESC, status <> 'processing' DESC, status DESC, info DESC NULLS LAST, seconds DESC, score DESC NULLS LAST) AS rn
        FROM @status) AS x
    WHERE rn = 1
"""


@query(
    "w7_latest_state",
    "SELECT collection, ligand, scenario, replica, epoch_us(ts) AS ts_us, status, info, seconds, score FROM (" + LATEST_SQL + ") AS l",
)
def w7_latest_state(spark, d):
    latest = state.latest_state(table(spark, d, "status"))
    return latest.withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")


@query(
    "w8_next_ligand",
    "SELECT collection, ligand, pos, lead(ligand) OVER (PARTITION BY collection ORDER BY pos, ligand) AS next_ligand FROM @ligand",
)
def w8_next_ligand(spark, d):
    rows = table(spark, d, "ligand").select("collection", "ligand", "pos")
    return state.next_ligand(rows)


@query(
    "u1_all_summaries",
    """
    WITH r AS (SELECT *, flag = 'F' AND scenario <> 'N' AS complete FROM @result WHERE score IS NOT NULL),
    s AS (SELECT complete, scenario, collection, ligand, CAST(min(score) AS DOUBLE) AS best_score, count(*)::INT AS n_dockings
          FROM r GROUP BY 1, 2, 3, 4)
    SELECT scenario, collection, ligand, best_score, n_dockings, CASE WHEN complete THEN 'complete' ELSE 'incomplete' END AS state
    FROM s WHERE complete OR (scenario, collection) NOT IN (SELECT (scenario, collection) FROM s WHERE complete)
    """,
)
def u1_all_summaries(spark, d):
    rows = table(spark, d, "result")
    is_complete = (F.col("flag") == "F") & (F.col("scenario") != "N")
    states = rows.withColumn("state", F.when(is_complete, "complete").otherwise("incomplete"))
    return summary.summaries_by_state(states).drop("avg_score", "worst_score")


@query(
    "u1_all_summaries_of_two_tables",
    """
    WITH r AS (SELECT *, flag = 'F' AND scenario <> 'N' AS complete FROM @result WHERE score IS NOT NULL),
    s AS (SELECT complete, scenario, collection, ligand, CAST(min(score) AS DOUBLE) AS best_score, count(*)::INT AS n_dockings
          FROM r GROUP BY 1, 2, 3, 4)
    SELECT scenario, collection, ligand, best_score, n_dockings, CASE WHEN complete THEN 'complete' ELSE 'incomplete' END AS state
    FROM s WHERE complete OR (scenario, collection) NOT IN (SELECT (scenario, collection) FROM s WHERE complete)
    """,
)
def u1_all_summaries_of_two_tables(spark, d):
    rows = table(spark, d, "result")
    is_complete = (F.col("flag") == "F") & (F.col("scenario") != "N")
    complete = summary.ligand_summary(rows.where(is_complete), with_scores=False)
    still_open = summary.ligand_summary(rows.where(~is_complete), with_scores=False)
    return summary.all_summaries(complete, still_open).drop("avg_score", "worst_score")


@query(
    "u2_merge_todo",
    """SELECT DISTINCT collection, n_ligands FROM @assignment WHERE list IN ('O', 'F')""",
)
def u2_merge_todo(spark, d):
    lists = _lists(spark, d)
    return progress.merge_todo(lists["O"], lists["F"])


@query(
    "u3_remaining",
    """SELECT collection, seq, n_ligands FROM @assignment AS a WHERE NOT EXISTS (
           SELECT 1 FROM @assignment AS t WHERE t.list IN ('F', 'P') AND t.collection = a.collection)""",
)
def u3_remaining(spark, d):
    lists = _lists(spark, d)
    manifest = table(spark, d, "assignment").select("collection", "seq", "n_ligands")
    processing = lists["P"].where("queue <= 4"), lists["P"].where("queue > 4")
    return progress.remaining(manifest, lists["F"], *processing)


@query(
    "r1_workflow_report",
    "WITH p AS (" + PROGRESS_SQL + "), t AS (" + TOTALS_SQL + "), j AS (" + JOB_TOTALS_SQL + """)
    SELECT 'collections' AS section, metric, value FROM p
    UNION ALL SELECT 'collections', 'collections_double_assigned', (SELECT count(*) FROM (
        SELECT collection FROM @assignment WHERE list = 'P' GROUP BY 1 HAVING count(DISTINCT (jobline, step, queue)) > 1) AS x)
    UNION ALL SELECT CASE WHEN metric LIKE 'dockings%' THEN 'dockings' ELSE 'ligands' END, metric, value FROM t
    UNION ALL SELECT 'dockings', 'runs_per_ligand', (SELECT CAST(sum(replicas) AS BIGINT) FROM @scenario)
    UNION ALL SELECT 'joblines', metric, value FROM j
    """,
)
def r1_workflow_report(spark, d):
    lists = _lists(spark, d)
    return reports.workflow_report(
        table(spark, d, "manifest"), table(spark, d, "done"), lists["P"], lists["O"],
        table(spark, d, "scenario"), table(spark, d, "job"),
    )


@query(
    "r2_screening_report",
    "WITH s AS (" + SUMMARY_SQL + "), b AS (SELECT " + BIN_SQL + """ AS bin FROM s WHERE scenario = 'A')
    SELECT 'histogram' AS section, CAST(r.range AS INT) AS position, CAST(NULL AS STRING) AS collection,
           CAST(NULL AS STRING) AS ligand, CAST(count(b.bin) AS DOUBLE) AS value
    FROM range(24) AS r LEFT JOIN b ON b.bin = r.range GROUP BY 2
    UNION ALL
    SELECT * FROM (
        SELECT 'top', CAST(row_number() OVER (ORDER BY best_score, collection, ligand) AS INT), collection, ligand, best_score
        FROM s WHERE scenario = 'A' ORDER BY best_score, collection, ligand LIMIT 25) AS x
    """,
)
def r2_screening_report(spark, d):
    of_scenario = _summary(spark, d).where("scenario = 'A'")
    return reports.screening_report(of_scenario, statistics=True, n=25)
