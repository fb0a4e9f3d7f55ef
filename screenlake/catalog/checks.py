"""Keys, control values, ligand checks, scores from logs, and the task grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.adapters import table
from screenlake.catalog.registry import query
from screenlake.functions.keys import with_collection_parts
from screenlake.operators import ligands, state, tasks
from screenlake.operators.batch import batch_status_dim

LIGAND_KEYS = ["collection", "ligand"]


@query(
    "p1_collection_parts",
    """WITH k AS (SELECT concat(collection, '_', CAST(n_ligands AS STRING)) AS collection FROM @manifest)
    SELECT collection, substr(collection, 1, 2) AS metatranche, string_split(collection, '_')[1] AS tranche,
           string_split(collection, '_')[3] AS collection_id,
           concat(string_split(collection, '_')[2], '_', string_split(collection, '_')[3]) AS collection_id_aws FROM k""",
)
def p1_collection_parts(spark, d):
    keys = table(spark, d, "manifest").select(
        F.concat_ws("_", "collection", F.col("n_ligands").cast("string")).alias("collection")
    )
    aws = with_collection_parts(keys, dialect="aws").withColumnRenamed("collection_id", "collection_id_aws")
    return with_collection_parts(aws)


@query(
    "p2_scenarios",
    """WITH c AS (SELECT file, max(value) FILTER (key = 'docking_scenario_names') AS n, max(value) FILTER (key = 'docking_scenario_programs') AS p,
                   max(value) FILTER (key = 'docking_scenario_replicas') AS r, max(value) FILTER (key = 'docking_scenario_inputfolders') AS f
                   FROM @control GROUP BY 1)
    SELECT file, CAST(i AS INT) AS idx, string_split(n, ':')[i] AS name, string_split(p, ':')[i] AS program,
           CAST(string_split(r, ':')[i] AS INT) AS replicas, string_split(f, ':')[i] AS inputfolder
    FROM c, range(1, 4) AS t(i)""",
)
def p2_scenarios(spark, d):
    return tasks.scenarios(table(spark, d, "control"))


@query(
    "p2_validate_control",
    """WITH s AS (SELECT *, concat('ctrl-', CAST(s_suppkey AS STRING)) AS file FROM supplier)
    SELECT file, 'programs_length' AS "check", s_nationkey >= 5 AS ok,
           CASE WHEN s_nationkey < 5 THEN 'length mismatch: 3 names, 2 entries' END AS detail FROM s
    UNION ALL SELECT file, 'replicas_length', true, NULL FROM s
    UNION ALL SELECT file, 'energy_check', s_nationkey % 4 <> 1, CASE WHEN s_nationkey % 4 = 1 THEN 'invalid value: yes' END FROM s
    UNION ALL SELECT file, 'energy_max', NOT (s_nationkey % 4 IN (2, 3) AND s_nationkey % 7 = 0),
              CASE WHEN s_nationkey % 4 IN (2, 3) AND s_nationkey % 7 = 0 THEN 'invalid value: high' END FROM s
    UNION ALL SELECT file, 'ligand_library_format', s_nationkey % 5 <> 0, CASE WHEN s_nationkey % 5 = 0 THEN 'invalid value: sdf' END FROM s
    UNION ALL SELECT file, 'outputfiles_level', true, NULL FROM s""",
)
def p2_validate_control(spark, d):
    return tasks.validate_control(table(spark, d, "control"))


# Lines of every ligand file with the first element and the coordinate fields on each.
LINES_SQL = r"""
    raw AS (SELECT collection, ligand, string_split(content, chr(10)) AS lines FROM @ligand),
    numbered AS (SELECT collection, ligand, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no, len(lines) AS n FROM raw),
    parsed AS (SELECT collection, ligand, line_no,
                      nullif(regexp_extract(CASE WHEN line_no < n THEN concat(line, chr(10)) ELSE line END, '\s(B|Si|Sn)\s', 1), '') AS element,
                      CASE WHEN line LIKE 'ATOM%' THEN array_to_string(list_slice(list_filter(regexp_split_to_array(line, '\s+'), lambda f: f <> ''), 6, 8), ':') END AS coords
               FROM numbered),
    repeated AS (SELECT *, row_number() OVER (PARTITION BY collection, ligand, coords ORDER BY line_no) AS copy FROM parsed WHERE coords IS NOT NULL),
    elements AS (SELECT collection, ligand, arg_min(element, line_no) AS element, CAST(min(line_no) AS INT) AS element_line FROM parsed WHERE element IS NOT NULL GROUP BY 1, 2),
    duplicates AS (SELECT collection, ligand, CAST(min(line_no) AS INT) AS duplicate_line FROM repeated WHERE copy > 1 GROUP BY 1, 2),
    checked AS (SELECT l.collection, l.ligand, e.element, e.element_line, c.duplicate_line,
                CASE WHEN e.element IS NOT NULL AND (c.duplicate_line IS NULL OR e.element_line <= c.duplicate_line)
                     THEN concat('failed(ligand_elements:', e.element, ')')
                     WHEN c.duplicate_line IS NOT NULL THEN 'failed(ligand_coordinates)' ELSE 'ok' END AS verdict
                FROM @ligand AS l LEFT JOIN elements AS e USING (collection, ligand) LEFT JOIN duplicates AS c USING (collection, ligand))
"""


@query("p3_flag_elements", f"WITH {LINES_SQL} SELECT collection, ligand, element, element_line FROM checked")
def p3_flag_elements(spark, d):
    return ligands.flag_elements(table(spark, d, "ligand")).select(*LIGAND_KEYS, "element", "element_line")


@query("p4_duplicate_coords", f"WITH {LINES_SQL} SELECT collection, ligand, duplicate_line FROM checked")
def p4_duplicate_coords(spark, d):
    return ligands.flag_duplicate_coords(table(spark, d, "ligand")).select(*LIGAND_KEYS, "duplicate_line")


@query("p5_ligand_verdict_aws", f"WITH {LINES_SQL} SELECT collection, ligand, verdict FROM checked")
def p5_ligand_verdict_aws(spark, d):
    return ligands.ligand_verdict(table(spark, d, "ligand")).select(*LIGAND_KEYS, "verdict")


@query(
    "p5_ligand_verdict_shell",
    f"""WITH {LINES_SQL}
    SELECT l.collection, l.ligand,
           CASE WHEN contains(l.content, ' B ') THEN 'failed(ligand_elements:B)'
                WHEN contains(lower(l.content), ' si ') THEN 'failed(ligand_elements:Si)'
                WHEN contains(lower(l.content), ' sn ') THEN 'failed(ligand_elements:Sn)'
                WHEN c.duplicate_line IS NOT NULL THEN 'failed(ligand_coordinates)' ELSE 'ok' END AS verdict
    FROM @ligand AS l LEFT JOIN checked AS c USING (collection, ligand)""",
)
def p5_ligand_verdict_shell(spark, d):
    return ligands.ligand_verdict(table(spark, d, "ligand"), "shell").select(*LIGAND_KEYS, "verdict")


@query(
    "p6_smiles",
    """SELECT concat(upper(lang), 'ABCD_', source) AS collection, concat('D', CAST(doc_id AS STRING)) AS ligand, source AS smiles FROM documents""",
)
def p6_smiles(spark, d):
    return ligands.with_smiles(table(spark, d, "ligand")).select(*LIGAND_KEYS, "smiles")


KNOWN = "program IN ('vina', 'gwovina', 'smina_rigid', 'adfr', 'plants')"
SCORED_SQL = f"""
    SELECT collection, ligand, scenario, replica, program,
           CASE WHEN NOT {KNOWN} THEN 'failed(docking_program)' WHEN log LIKE '%n/a%' OR (program = 'gwovina') THEN 'failed(docking)' ELSE 'succeeded' END AS status,
           CASE WHEN {KNOWN} AND program <> 'gwovina' AND log NOT LIKE '%n/a%' THEN CAST(true_score AS DOUBLE) END AS score
    FROM @log
"""


@query("p7_extract_score", SCORED_SQL.replace("log LIKE '%n/a%'", "(log LIKE '%n/a%' AND program <> 'smina_rigid')")
       .replace("log NOT LIKE '%n/a%' THEN CAST(true_score AS DOUBLE)",
                "(log NOT LIKE '%n/a%' OR program = 'smina_rigid') THEN CASE WHEN log LIKE '%n/a%' THEN 99.9 ELSE CAST(true_score AS DOUBLE) END"))
def p7_extract_score(spark, d):
    # A smina log without a later row keeps the score of its first one.
    return tasks.extract_score(table(spark, d, "log")).drop("log", "true_score")


@query(
    "p8_timings",
    """SELECT concat('AB', lpad(CAST(l_suppkey % 40 AS STRING), 4, '0'), '_', CAST(l_suppkey AS STRING)) AS collection,
              concat('L', CAST(l_partkey AS STRING), 'x', CAST(l_orderkey AS STRING)) AS ligand, l_linenumber AS replica,
              CAST(l_quantity AS INT) + 0.5::DOUBLE AS user_seconds, CAST(l_quantity AS INT) + 1.25::DOUBLE AS real_seconds, 0.0::DOUBLE AS system_seconds
       FROM lineitem""",
)
def p8_timings(spark, d):
    timed = tasks.extract_timings(table(spark, d, "log"))
    return timed.select(*LIGAND_KEYS, "replica", "user_seconds", "real_seconds", "system_seconds")


@query(
    "p9_first_pose",
    """SELECT doc_id, concat('MODEL 1', chr(10), text, chr(10), 'ENDMDL a') AS pose FROM documents""",
)
def p9_first_pose(spark, d):
    poses = spark.read.parquet(f"{d}/documents.parquet").selectExpr(
        "doc_id",
        r"concat('MODEL 1\n', text, '\nENDMDL a\nMODEL 2\n', text, '\nENDMDL b\n') AS pose",
    )
    return tasks.first_pose(poses)


# Dockings of an order line with the energy of its pose; energies exist for part of them.
TASK_SQL = """
    t AS (SELECT collection, ligand, scenario, replica, min(status) AS status, min(CASE WHEN status = 'succeeded' THEN score END) AS score, max(seconds) AS seconds
          FROM @result GROUP BY 1, 2, 3, 4)
"""


@query(
    "p10_energy_check",
    f"""WITH {TASK_SQL}
    SELECT collection, ligand, scenario, replica,
           CASE WHEN status = 'succeeded' AND (replica = 7 OR seconds * 400 > 10000) THEN 'energy-check:failed' ELSE status END AS status,
           CASE WHEN status = 'succeeded' AND (replica = 7 OR seconds * 400 > 10000) THEN NULL ELSE CAST(score AS DOUBLE) END AS score
    FROM t""",
)
def p10_energy_check(spark, d):
    rows = dockings(spark, d)
    energies = rows.where("replica <> 7").withColumn("energy", F.col("seconds") * 400)
    checked = tasks.energy_check(rows, energies, 10_000)
    return checked.select(*LIGAND_KEYS, "scenario", "replica", "status", F.col("score").cast("double").alias("score"))


def dockings(spark, d):
    """One row per task."""
    return table(spark, d, "result").groupBy("collection", "ligand", "scenario", "replica").agg(
        F.min("status").alias("status"),
        F.min(F.when(F.col("status") == "succeeded", F.col("score"))).alias("score"),
        F.max("seconds").alias("seconds"),
    )


DIM_SQL = """
    dim(status, status_order, completed, check_parent, check_subjobs) AS (VALUES
        ('SUBMITTED', 1, 0, 1, 0), ('PENDING', 2, 0, 1, 1), ('RUNNABLE', 3, 0, 1, 0), ('STARTING', 4, 0, 1, 1),
        ('RUNNING', 5, 0, 1, 1), ('SUCCEEDED', 6, 1, 0, 1), ('FAILED', 7, 1, 0, 1))
"""


@query(
    "p12_batch_status_dim",
    f"""WITH {DIM_SQL} SELECT dim.*, count(s.subjob) AS n_subjobs FROM dim LEFT JOIN @subjob AS s ON s.status = dim.status GROUP BY ALL""",
)
def p12_batch_status_dim(spark, d):
    counts = table(spark, d, "subjob").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    dim = batch_status_dim(spark)
    return dim.join(counts, "status", "left").select(*dim.columns, F.coalesce("n", F.lit(0)).alias("n_subjobs"))


GRID_SQL = """
    SELECT l.collection, l.ligand, s.idx AS scenario_idx, s.name AS scenario, s.program, CAST(r.i AS INT) AS replica
    FROM @ligand AS l, @scenario AS s, range(1, 4) AS r(i) WHERE r.i <= s.replicas
"""


@query("j1_task_grid", GRID_SQL)
def j1_task_grid(spark, d):
    rows = table(spark, d, "ligand").select(*LIGAND_KEYS)
    return tasks.task_grid(rows, table(spark, d, "scenario"))


@query("j2_valid_ligands", f"WITH {LINES_SQL} SELECT collection, ligand FROM checked WHERE verdict = 'ok'")
def j2_valid_ligands(spark, d):
    rows = table(spark, d, "ligand")
    verdicts = ligands.ligand_verdict(rows).select(*LIGAND_KEYS, "verdict")
    return tasks.valid_ligands(rows.select(*LIGAND_KEYS), verdicts)


@query(
    "j3_pending_tasks",
    f"""WITH {TASK_SQL},
    g AS (SELECT DISTINCT collection, ligand FROM @result),
    s AS (SELECT scenario, max(replica) AS replicas FROM @result GROUP BY 1),
    grid AS (SELECT g.collection, g.ligand, s.scenario, CAST(i AS INT) AS replica FROM g, s, range(1, 8) AS r(i) WHERE i <= s.replicas)
    SELECT grid.collection, grid.ligand, scenario, replica FROM grid
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.collection = grid.collection AND t.ligand = grid.ligand AND t.scenario = grid.scenario
                      AND t.replica = grid.replica AND t.seconds < 40)""",
)
def j3_pending_tasks(spark, d):
    rows = table(spark, d, "result").select(*LIGAND_KEYS).distinct()
    scenario_rows = table(spark, d, "result").groupBy(F.col("scenario").alias("name")).agg(
        F.max("replica").alias("replicas"), F.lit("vina").alias("program"), F.lit(1).alias("idx")
    )
    # A docking that has taken 40 s or more counts as still processing.
    entries = dockings(spark, d).select(
        *LIGAND_KEYS, "scenario", "replica",
        F.when(F.col("seconds") < 40, F.col("status")).otherwise("processing").alias("status"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"),
    )
    return tasks.pending_grid(rows, scenario_rows, state.latest_state(entries)).select(*LIGAND_KEYS, "scenario", "replica")


def sample_scorer(task: dict) -> str:
    """Deterministic stand-in for a docking program: a log in the program's format."""
    value = (len(task["content"]) * 7 + task["scenario_idx"] * 13 + task["replica"] * 29) % 211
    if value % 17 == 0:
        raise RuntimeError("docking failed")
    text = f"{-value / 10:.1f}"
    if task["program"] == "smina_rigid":
        return f"1    9.9  0\n1    {text}  0\n"
    if task["program"] == "adfr":
        return f"Best FEB: {text}\n"
    if task["program"] == "plants":
        return f"LIG_conf_01,{text},x\n"
    return f"   1      {text}      0.000\n"


SCORER_SQL = f"""
    grid AS ({GRID_SQL}),
    drawn AS (SELECT grid.*, (length(l.content) * 7 + scenario_idx * 13 + replica * 29) % 211 AS v FROM grid JOIN @ligand AS l USING (collection, ligand)),
    scored AS (SELECT collection, ligand, scenario, scenario_idx, program, replica,
                      CASE WHEN program = 'other' THEN 'failed(docking_program)' WHEN v % 17 = 0 THEN 'failed(docking)' ELSE 'succeeded' END AS status,
                      CASE WHEN program = 'other' OR v % 17 = 0 THEN NULL ELSE -v / 10.0::DOUBLE END AS score
               FROM drawn)
"""


@query("f1_run_scorer", f"WITH {SCORER_SQL} SELECT * FROM scored")
def f1_run_scorer(spark, d):
    rows = table(spark, d, "ligand").select(*LIGAND_KEYS, "content")
    listed = rows.withColumn("_tasks", tasks.listed_tasks(table(spark, d, "scenario")))
    return tasks.score_results(tasks.run_scorer(listed, sample_scorer)).drop("log", "pose", "error", "seconds")


@query(
    "f2_program_registry",
    f"""SELECT program, count(*) AS n, count(*) FILTER (NOT ({KNOWN} OR program = 'unheard_of')) AS unknown,
           count(*) FILTER (program = 'unheard_of' AND log NOT LIKE '%n/a%') AS found_by_new_rule
        FROM @log GROUP BY 1""",
)
def f2_program_registry(spark, d):
    from screenlake.functions import scores

    scores.register_program("unheard_of", r"no score here ([-0-9.]+)")
    try:
        scored = tasks.extract_score(table(spark, d, "log"))
    finally:
        scores.unregister_program("unheard_of")
    is_new = F.col("program") == "unheard_of"
    return scored.groupBy("program").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status") == "failed(docking_program)").alias("unknown"),
        F.count_if(is_new & F.col("score").isNotNull()).alias("found_by_new_rule"),
    )
