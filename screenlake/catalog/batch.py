"""Batch accounting."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.adapters import table
from screenlake.catalog.registry import query
from screenlake.operators import batch
from screenlake.plans import reports

NORMAL = "'Essential container in task exited'"

TIMES_SQL = f"""
    att AS (SELECT workunit, subjob, count(*) AS n,
                   CAST(sum(stopped_at - started_at) AS BIGINT) AS total_ms,
                   max({{'n': attempt_no, 's': started_at, 'ms': stopped_at - started_at}}) FILTER (started_at IS NOT NULL AND reason = {NORMAL}) AS ok
            FROM @attempt GROUP BY 1, 2),
    sub AS (SELECT s.*, coalesce(a.total_ms, 0) * s.vcpus AS total, coalesce(a.ok.ms, 0) * s.vcpus AS success,
                   greatest(coalesce(a.n, 0) - 1, 0) AS reattempts
            FROM @subjob AS s LEFT JOIN att AS a USING (workunit, subjob)),
    res AS (SELECT s.workunit, s.vcpus, s.n_ligands,
                   CASE WHEN coalesce(s.status, w.status) IN ('SUBMITTED', 'PENDING', 'RUNNABLE', 'STARTING', 'RUNNING', 'SUCCEEDED', 'FAILED')
                        THEN coalesce(s.status, w.status) ELSE 'UNKNOWN' END AS st, s.total, s.success, s.reattempts
            FROM sub AS s JOIN @workunit AS w USING (workunit)),
    done AS (SELECT st, vcpus, n_ligands, CASE WHEN st IN ('SUCCEEDED', 'FAILED') THEN total ELSE 0 END AS total,
                    CASE WHEN st IN ('SUCCEEDED', 'FAILED') THEN success ELSE 0 END AS success,
                    CASE WHEN st IN ('SUCCEEDED', 'FAILED') THEN reattempts ELSE 0 END AS reattempts FROM res)
"""


@query(
    "a8_subjob_vcpu",
    f"""WITH {TIMES_SQL}
    SELECT workunit, subjob, status, vcpus, n_ligands, total / 60000.0::DOUBLE AS vcpu_min_total, success / 60000.0::DOUBLE AS vcpu_min_success,
           (total - success) / 60000.0::DOUBLE AS vcpu_min_retried, reattempts FROM sub""",
)
def a8_subjob_vcpu(spark, d):
    return batch.subjob_vcpu(table(spark, d, "subjob"), table(spark, d, "attempt"))


STATES = ("SUBMITTED", "PENDING", "RUNNABLE", "STARTING", "RUNNING", "SUCCEEDED", "FAILED", "UNKNOWN")


def _row(category: str, value: str, source: str, state: str, unit: str) -> str:
    cells = ", ".join(
        f"CAST(coalesce({value} FILTER ({state} = '{s}'), 0) AS DOUBLE) / {unit} AS \"{s}\"" for s in STATES
    )
    return f"SELECT '{category}' AS category, {cells}, CAST({value} AS DOUBLE) / {unit} AS \"TOTAL\" FROM {source}"


MATRIX_SQL = " UNION ALL ".join(
    (
        _row("ligands", "sum(n_ligands)", "done", "st", "1.0"),
        _row("subjobs", "count(*)", "done", "st", "1.0"),
        _row("jobs", "count(*)", "@workunit", "status", "1.0"),
        _row("vcpu_min", "sum(total)", "done", "st", "60000.0::DOUBLE"),
        _row("vcpu_hours", "sum(total)", "done", "st", "3600000.0::DOUBLE"),
    )
)


@query("a9_status_matrix", f"WITH {TIMES_SQL} {MATRIX_SQL}")
def a9_status_matrix(spark, d):
    return batch.status_matrix(table(spark, d, "workunit"), table(spark, d, "subjob"), table(spark, d, "attempt"))


METRICS_SQL = """
    SELECT 'vcpu_hours_total' AS metric, CAST(sum(total) AS DOUBLE) / 3600000.0::DOUBLE AS value FROM done
    UNION ALL SELECT 'vcpu_hours_interrupted', CAST(sum(total - success) AS DOUBLE) / 3600000.0::DOUBLE FROM done
    UNION ALL SELECT 'vcpu_hours_failed', CAST(sum(total) FILTER (st = 'FAILED') AS DOUBLE) / 3600000.0::DOUBLE FROM done
    UNION ALL SELECT 'vcpu_hours_succeeded', CAST(sum(total) FILTER (st = 'SUCCEEDED') AS DOUBLE) / 3600000.0::DOUBLE FROM done
    UNION ALL SELECT 'vcpu_seconds_per_ligand', CAST(sum(total) FILTER (st = 'SUCCEEDED') AS DOUBLE) / 1000 / CAST(sum(n_ligands) FILTER (st = 'SUCCEEDED') AS DOUBLE) FROM done
    UNION ALL SELECT 'active_vcpus', CAST(coalesce(sum(vcpus) FILTER (st = 'RUNNING'), 0) AS DOUBLE) FROM done
    UNION ALL SELECT 'total_reattempts', CAST(sum(reattempts) AS DOUBLE) FROM done
"""


@query("a10_vcpu_metrics", f"WITH {TIMES_SQL} {METRICS_SQL}")
def a10_vcpu_metrics(spark, d):
    return batch.vcpu_metrics(table(spark, d, "workunit"), table(spark, d, "subjob"), table(spark, d, "attempt"))


OUTCOME_SQL = """
    e AS (SELECT CASE status WHEN 'failed' THEN 'ligands_removed' WHEN 'failed(docking)' THEN 'ligands_failed_docking'
                 WHEN 'succeeded' THEN 'ligands_succeeded_docking' ELSE 'unknown_event' END AS o FROM @status),
    oc AS (SELECT o, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM e) AS percent FROM e GROUP BY 1)
"""


@query(
    "r3_batch_report",
    f"""WITH {TIMES_SQL}, {OUTCOME_SQL}, m AS ({MATRIX_SQL}), v AS ({METRICS_SQL})
    SELECT 'status' AS section, concat(category, '.', name) AS metric, value FROM (UNPIVOT m ON COLUMNS(* EXCLUDE category) INTO NAME name VALUE value) AS u
    UNION ALL SELECT 'vcpu', metric, value FROM v
    UNION ALL SELECT 'outcome', o, CAST(n AS DOUBLE) FROM oc
    UNION ALL SELECT 'outcome', concat(o, '_percent'), percent FROM oc""",
)
def r3_batch_report(spark, d):
    return reports.batch_report(
        table(spark, d, "workunit"), table(spark, d, "subjob"), table(spark, d, "attempt"), table(spark, d, "status")
    )


@query(
    "j6_merge_status",
    """WITH snap AS (SELECT workunit, subjob, CASE WHEN vcpus > 4 THEN 'SUCCEEDED' ELSE 'RUNNING' END AS status, vcpus + 1 AS vcpus FROM @subjob WHERE n_ligands >= 150),
    cur AS (SELECT workunit, subjob, status, vcpus FROM @subjob WHERE n_ligands < 400)
    SELECT coalesce(c.workunit, s.workunit) AS workunit, coalesce(c.subjob, s.subjob) AS subjob,
           CASE WHEN s.workunit IS NULL OR coalesce(c.status IN ('SUCCEEDED', 'FAILED'), false) THEN c.status ELSE s.status END AS status,
           CASE WHEN s.workunit IS NULL OR coalesce(c.status IN ('SUCCEEDED', 'FAILED'), false) THEN c.vcpus ELSE s.vcpus END AS vcpus
    FROM cur AS c FULL JOIN snap AS s ON c.workunit = s.workunit AND c.subjob = s.subjob""",
)
def j6_merge_status(spark, d):
    rows = table(spark, d, "subjob").select("workunit", "subjob", "status", "vcpus", "n_ligands")
    current = rows.where("n_ligands < 400").drop("n_ligands")
    snapshot = rows.where("n_ligands >= 150").select(
        "workunit", "subjob",
        F.when(F.col("vcpus") > 4, "SUCCEEDED").otherwise("RUNNING").alias("status"),
        (F.col("vcpus") + 1).alias("vcpus"),
    )
    return batch.merge_status(current, snapshot)
