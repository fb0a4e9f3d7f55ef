"""Hand-checked cases on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from screenlake.functions import scores
from screenlake.functions.keys import with_collection_parts
from screenlake.operators import assign, batch, ligands, packing, progress, state, summary, tasks

MANIFEST = [
    (1, "AAAAAA_00000", 40),
    (2, "AAAAAB_00000", 70),
    (3, "AAAAAB_00001", 120),
    (4, "AAABAA_00000", 30),
    (5, "AAABAC_00000", 10),
    (6, "BBAAAA_00000", 60),
    (7, "BBAAAA_00001", 100),
    (8, "BBABAA_00000", 5),
]

RESULTS = [
    ("C_1", "L1", "S1", 1, "succeeded", -7.2),
    ("C_1", "L1", "S1", 2, "succeeded", -7.6),
    ("C_1", "L2", "S1", 1, "succeeded", -5.0),
    ("C_1", "L2", "S1", 2, "failed(docking)", None),
    ("C_1", "L3", None, None, "failed", None),
    ("C_1", "L4", "S1", 1, "succeeded", 0.3),
    ("C_1", "L4", "S1", 2, "succeeded", -15.0),
]
RESULT_SCHEMA = "collection STRING, ligand STRING, scenario STRING, replica INT, status STRING, score DOUBLE"


@pytest.fixture(scope="module")
def manifest(spark):
    return spark.createDataFrame(MANIFEST, "seq LONG, collection STRING, n_ligands INT").cache()


@pytest.fixture(scope="module")
def results(spark):
    return spark.createDataFrame(RESULTS, RESULT_SCHEMA).cache()


def as_dict(df, key, *values):
    rows = df.select(key, *values).collect()
    return {r[0]: (r[1] if len(values) == 1 else tuple(r[1:])) for r in rows}


def test_collection_parts(manifest):
    row = with_collection_parts(manifest.where("seq = 3")).first()
    assert (row["metatranche"], row["tranche"], row["collection_id"]) == ("AA", "AAAAAB", "00001")


def test_chunks(manifest):
    got = as_dict(packing.chunk_manifest(manifest, 3), "seq", "chunk")
    assert got == {1: "0000", 2: "0000", 3: "0000", 4: "0001", 5: "0001", 6: "0001", 7: "0002", 8: "0002"}


def test_bins_and_workunits(manifest):
    bins = packing.pack_bins(manifest, 100)
    assert as_dict(bins, "seq", "bin") == {1: 0, 2: 0, 3: 1, 4: 2, 5: 2, 6: 2, 7: 3, 8: 4}
    units = packing.group_workunits(bins, 2, 2)
    got = as_dict(units.select("bin", "workunit", "submit_queue", "array_size").distinct(), "bin", "workunit", "submit_queue", "array_size")
    assert got == {0: (1, 1, 2), 1: (1, 1, 2), 2: (2, 2, 2), 3: (2, 2, 2), 4: (3, 1, 2)}


def test_refill(spark, manifest):
    none = spark.createDataFrame([], "jobline INT, step INT, queue INT, n_ligands INT")
    got = packing.refill_queues(manifest, none, 100, ligands_per_queue=200, ligands_per_step=50, steps=1, queues=2)
    queues = as_dict(got, "seq", "queue")
    assert queues == {1: 1, 2: 1, 4: 1, 5: 1, 7: 1, 3: 2, 6: 2, 8: 2}


def test_redistribute(manifest):
    single = as_dict(packing.redistribute_single(manifest, queues=2, steps=2), "seq", "job", "step", "queue")
    assert [single[i] for i in range(1, 9)] == [
        (1, 1, 1), (1, 1, 2), (1, 2, 1), (1, 2, 2), (2, 1, 1), (2, 1, 2), (2, 2, 1), (2, 2, 2),
    ]
    multiple = as_dict(packing.redistribute_multiple(manifest, 1, 1, 1, 2, 3), "seq", "job", "step", "queue")
    assert {s for s, v in multiple.items() if v == (1, 1, 1)} == {1, 3, 5}
    assert {s for s, v in multiple.items() if v == (1, 1, 2)} == {2, 4, 6}
    assert multiple[7] == multiple[8] == (None, None, None)


def test_redistribute_drops_repeats_and_bad_keys(spark):
    rows = spark.createDataFrame([(1, "A_1"), (2, "bad"), (3, "A_1"), (4, "A_10")], "seq LONG, collection STRING")
    got = as_dict(packing.redistribute_multiple(rows, 1, 1, 1, 1, 5), "collection", "seq")
    assert got == {"A_1": 1, "A_10": 4}


def test_summary(results):
    got = as_dict(summary.ligand_summary(results), "ligand", "avg_score", "best_score", "worst_score", "n_dockings", "scores")
    assert set(got) == {"L1", "L2", "L4"}
    assert got["L1"] == (pytest.approx(-7.4), -7.6, -7.2, 2, [-7.2, -7.6])
    assert got["L2"] == (-5.0, -5.0, -5.0, 1, [-5.0])
    assert got["L4"] == (pytest.approx(-7.35), -15.0, 0.3, 2, [0.3, -15.0])
    assert as_dict(summary.ligand_summary(results, max_replicas=2), "ligand", "best_score", "scores") == {
        k: (v[1], v[4]) for k, v in got.items()
    }
    with pytest.raises(Exception, match="beyond max_replicas=1"):
        summary.ligand_summary(results, max_replicas=1).collect()
    slim = summary.ligand_summary(results, with_scores=False)
    assert as_dict(slim, "ligand", "best_score", "n_dockings") == {k: (v[1], v[3]) for k, v in got.items()}


def test_scores_wide(results):
    wide = as_dict(summary.scores_wide(results, 2), "ligand", "score_replica_1", "score_replica_2")
    assert wide["L2"] == (-5.0, None)


def test_counters(results):
    row = summary.collection_counters(results).first()
    assert tuple(row)[1:] == (4, 3, 2, 7, 5, 2)


def test_histogram_and_top(results):
    summaries = summary.ligand_summary(results)
    bins = as_dict(summary.score_histogram(summaries), "bin", "n_ligands")
    assert len(bins) == 24 and sum(bins.values()) == 3
    assert bins[1] == bins[6] == bins[21] == 1
    top = [tuple(r) for r in summary.top_compounds(summaries, 2).select("rank", "ligand", "score").orderBy("rank").collect()]
    assert top == [(1, "L4", -15.0), (2, "L1", -7.6)]


def test_top_list_longer_than_the_table(results):
    top = summary.top_compounds(summary.ligand_summary(results), 200)
    assert as_dict(top, "rank", "ligand") == {1: "L4", 2: "L1", 3: "L2"}


def test_replicas_outside_the_range_are_errors(results):
    from_zero = results.withColumn("replica", F.col("replica") - 1)
    for broken in (summary.ligand_summary(from_zero, max_replicas=2), summary.scores_wide(from_zero, 2), summary.scores_wide(results, 1)):
        with pytest.raises(Exception, match="beyond max_replicas"):
            broken.collect()
    got = as_dict(summary.ligand_summary(from_zero, max_replicas=2, replica_base=0), "ligand", "scores")
    assert got["L1"] == [-7.2, -7.6]


def test_padded_scores_keep_their_replica(spark):
    rows = [("S", "A_1", "L", 1, None), ("S", "A_1", "L", 2, -6.0), ("S", "A_1", "L", 4, -5.0)]
    df = spark.createDataFrame(rows, "scenario STRING, collection STRING, ligand STRING, replica INT, score DOUBLE")
    assert summary.ligand_summary(df, padded=True).first()["scores"] == [None, -6.0, None, -5.0]
    assert summary.ligand_summary(df).first()["scores"] == [-6.0, -5.0]


@pytest.mark.parametrize("with_scenario_column", [True, False])
def test_top_ties(spark, with_scenario_column):
    rows = spark.createDataFrame([("S", "B", "x", -1.0), ("S", "A", "y", -1.0), ("S", "A", "x", -1.0)], "scenario STRING, collection STRING, ligand STRING, best_score DOUBLE")
    rows = rows if with_scenario_column else rows.drop("scenario")
    got = as_dict(summary.top_compounds(rows, 3), "rank", "collection", "ligand")
    assert got == {1: ("A", "x"), 2: ("A", "y"), 3: ("B", "x")}


def test_histogram_edges(spark):
    edges = {
        0.0: 23, -0.1: 0, -4.9: 0, -5.0: 1, -5.4: 1, -5.5: 2, -14.9: 20, -15.0: 21, -19.9: 21, -20.0: 22, -150.0: 22,
        3.5: 23, -5.45: 1,
    }
    df = spark.createDataFrame([(s,) for s in edges], "score DOUBLE")
    assert as_dict(df.select("score", scores.histogram_bin(F.col("score")).alias("b")), "score", "b") == edges


def test_one_decimal_as_printed(spark):
    rng = random.Random(7)
    values = [k / 20 for k in range(-700, 700)] + [rng.uniform(-120, 120) for _ in range(2000)]
    values += [0.05, -0.04, 0.001, 99.95, -0.25, 1e-9, 12345.25]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for r in df.select("v", scores.one_place(F.col("v")).alias("t")).collect():
        assert r["t"] == f"{r['v']:3.1f}"


def test_outcomes(results):
    totals = as_dict(batch.outcome_totals(batch.collection_outcomes(results)), "outcome", "n", "percent")
    assert totals["ligands_removed"] == (1, pytest.approx(14.2857, abs=1e-3))
    assert totals["ligands_failed_docking"] == (1, pytest.approx(14.2857, abs=1e-3))
    assert totals["ligands_succeeded_docking"] == (5, pytest.approx(71.4286, abs=1e-3))
    assert totals["unknown_event"] == (0, 0.0)
    empty = batch.outcome_totals(batch.collection_outcomes(results.where("false")))
    assert set(as_dict(empty, "outcome", "percent").values()) == {None}


def test_pending_tasks(spark, results):
    grid = tasks.task_grid(
        spark.createDataFrame([("C_1", x) for x in ("L1", "L2", "L4")], "collection STRING, ligand STRING"),
        spark.createDataFrame([(1, "S1", "vina", 2)], "idx INT, name STRING, program STRING, replicas INT"),
    )
    stamped = results.withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    assert tasks.pending_tasks(grid, state.latest_state(stamped)).count() == 0
    running = stamped.withColumn(
        "status", F.when(F.expr("ligand = 'L4' AND replica = 2"), "processing").otherwise(F.col("status"))
    )
    left = tasks.pending_tasks(grid, state.latest_state(running)).collect()
    assert [(r["ligand"], r["replica"]) for r in left] == [("L4", 2)]


def test_latest_state(spark):
    rows = [("C", "L", "S", 1, "processing", "2024-01-01"), ("C", "L", "S", 1, "succeeded", "2024-01-01"),
            ("C", "L", "S", 2, "succeeded", "2024-01-01"), ("C", "L", "S", 2, "processing", "2024-01-02")]
    df = spark.createDataFrame(rows, "collection STRING, ligand STRING, scenario STRING, replica INT, status STRING, ts STRING")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    assert as_dict(state.latest_state(df), "replica", "status") == {1: "succeeded", 2: "processing"}


def test_task_grid_and_listed_tasks(spark):
    ligand_rows = spark.createDataFrame([("C", "a"), ("C", "b")], "collection STRING, ligand STRING")
    scenario_rows = spark.createDataFrame([(i * 3, f"s{i}", "vina", i % 3) for i in range(1, 8)], "idx INT, name STRING, program STRING, replicas INT")
    short = sorted(map(tuple, tasks.task_grid(ligand_rows, scenario_rows).collect()))
    listed = ligand_rows.withColumn("content", F.lit("x")).withColumn("_tasks", tasks.listed_tasks(scenario_rows))
    scored = tasks.run_scorer(listed, lambda task: float(task["replica"])).select("collection", "ligand", *tasks.TASK_FIELDS, "score_given")
    got = sorted(map(tuple, scored.collect()))
    assert [r[:-1] for r in got] == short and all(r[-1] == r[-2] for r in got)
    assert len(short) == 2 * (1 + 2 + 0 + 1 + 2 + 0 + 1)


def test_next_ligand(spark):
    rows = spark.createDataFrame([("A", "x", 1), ("A", "y", 2), ("B", "z", 1)], "collection STRING, ligand STRING, pos INT")
    assert as_dict(state.next_ligand(rows), "ligand", "next_ligand") == {"x": "y", "y": None, "z": None}


ATOM = "ATOM 1 C LIG 1 {} 0.0 C"
CHECKS = {
    "ok": ([ATOM.format("1.0 2.0 3.0"), ATOM.format("1.0 2.0 4.0")], "ok", "ok"),
    "element": (["REMARK x Si y"], "failed(ligand_elements:Si)", "failed(ligand_elements:Si)"),
    "coordinates": ([ATOM.format("1.000 2.000 3.000")] * 2, "failed(ligand_coordinates)", "failed(ligand_coordinates)"),
    "text compare": ([ATOM.format("1.0 2.0 3.0"), ATOM.format("1.00 2.00 3.00")], "ok", "ok"),
    "coordinates first": (
        [ATOM.format("1 2 3"), ATOM.format("1 2 3"), "x B y"], "failed(ligand_coordinates)", "failed(ligand_elements:B)",
    ),
    "element first": (["x Sn y", ATOM.format("1 2 3"), ATOM.format("1 2 3")], "failed(ligand_elements:Sn)", "failed(ligand_elements:Sn)"),
    "same line": (
        [ATOM.format("1 2 3"), ATOM.format("1 2 3").replace("0.0 C", "0.0 B ")], "failed(ligand_elements:B)", "failed(ligand_coordinates)",
    ),
    "HETATM twins": (["HETATM 1 C LIG 1 1 2 3"] * 2, "ok", "ok"),
    "word inside the line": (["x ATOM C LIG 1 1 2 3"] * 2, "ok", "failed(ligand_coordinates)"),
    "at line end": (["ATOM 1 C LIG 1 1 2 3 B"], "failed(ligand_elements:B)", "ok"),
    "at line start": (["B x"], "ok", "ok"),
    "other case": (["x SI y"], "ok", "failed(ligand_elements:Si)"),
    "empty": ([], "ok", "ok"),
}


@pytest.mark.parametrize("precedence, place", [("aws", 1), ("shell", 2)])
def test_verdicts(spark, precedence, place):
    rows = [(name, "".join(line + "\n" for line in case[0])) for name, case in CHECKS.items()]
    df = spark.createDataFrame(rows, "ligand STRING, content STRING")
    got = as_dict(ligands.ligand_verdict(df, precedence), "ligand", "verdict")
    expected = {name: case[place] for name, case in CHECKS.items()}
    if precedence == "shell":
        expected["same line"] = "failed(ligand_elements:B)"
    assert got == expected


def test_hetatm_lines_count_on_demand(spark):
    df = spark.createDataFrame([("a", "HETATM 1 C LIG 1 1 2 3\n" * 2)], "ligand STRING, content STRING")
    assert ligands.ligand_verdict(df, include_hetatm=True).first()["verdict"] == "failed(ligand_coordinates)"


def test_element_needs_a_line_end_in_the_last_line(spark):
    df = spark.createDataFrame([("a", "x B"), ("b", "x B\n")], "ligand STRING, content STRING")
    assert as_dict(ligands.flag_elements(df), "ligand", "element") == {"a": None, "b": "B"}


def test_smiles(spark):
    df = spark.createDataFrame([("a", "REMARK SMILES  CCO\nATOM\n"), ("b", "ATOM\n")], "ligand STRING, content STRING")
    assert as_dict(ligands.with_smiles(df), "ligand", "smiles") == {"a": "CCO", "b": None}


LOGS = [
    ("vina", "mode\n   1      -9.3      0.000      0.000\n   2      -9.0  1 1\n", -9.3, "succeeded"),
    ("gwovina_x", "   1      -9.3      0.000      0.000\n", -9.3, "succeeded"),
    ("smina_rigid", "1    -8.1  0\nmore\n1    -8.4  0\n", -8.4, "succeeded"),
    ("adfr", "a: 1\nBest FEB: -6.2\nNext FEB: -1.0\n", -6.2, "succeeded"),
    ("plants", "name,score\nLIG_conf_01,-71.2,x\nLIG_conf_01,-1,x\n", -71.2, "succeeded"),
    ("vina", "nothing\n", None, "failed(docking)"),
    ("vina", "   1      abc  x\n", None, "failed(docking)"),
    ("unheard_of", "   1      -9.3  0\n", None, "failed(docking_program)"),
]


def test_scores_from_logs(spark):
    df = spark.createDataFrame([(i, p, log) for i, (p, log, _, _) in enumerate(LOGS)], "i INT, program STRING, log STRING")
    got = as_dict(tasks.extract_score(df), "i", "score", "status")
    assert got == {i: case[2:] for i, case in enumerate(LOGS)}


def test_registered_program(spark):
    scores.register_program("mydock", r"score=([-0-9.]+)", last=True)
    try:
        df = spark.createDataFrame([("mydock", "score=-1\nscore=-2.5")], "program STRING, log STRING")
        assert tasks.extract_score(df).first()["score"] == -2.5
    finally:
        scores.unregister_program("mydock")


def test_timings_and_pose(spark):
    log = " Docking timings \n------ \n user real system \n 12.5 13 0.25 \n---- \n"
    row = tasks.extract_timings(spark.createDataFrame([(log,)], "log STRING")).first()
    assert (row["user_seconds"], row["real_seconds"], row["system_seconds"]) == (12.5, 13.0, 0.25)
    poses = spark.createDataFrame([(1, "MODEL\na\nENDMDL x\nMODEL\nENDMDL\n"), (2, "none")], "i INT, pose STRING")
    assert as_dict(tasks.first_pose(poses), "i", "pose") == {1: "MODEL\na\nENDMDL x", 2: None}


def test_energy_check(spark, results):
    docked = results.where("scenario IS NOT NULL").withColumn("pose", F.lit("p"))
    energies = docked.withColumn("energy", F.when(F.col("replica") == 1, 10000.0).otherwise(10000.5)).where("ligand <> 'L1'")
    got = {(r["ligand"], r["replica"]): (r["status"], r["score"], r["pose"]) for r in tasks.energy_check(docked, energies, 10000).collect()}
    assert got["L2", 1] == ("succeeded", -5.0, "p")
    assert got["L4", 2] == ("energy-check:failed", None, None)
    assert got["L1", 1] == ("energy-check:failed", None, None)
    assert got["L2", 2] == ("failed(docking)", None, "p")


def test_resolve_control(spark):
    ranges = spark.createDataFrame([("1-5", 1, 5), ("4-9", 4, 9), ("100-900000", 100, 900000)], "file STRING, range_start LONG, range_end LONG")
    joblines = spark.createDataFrame([(n,) for n in (0, 3, 4, 7, 9, 10, 12, 99, 100, 65536, 899999, 900000, 900001)], "jobline LONG")
    got = as_dict(assign.resolve_control(joblines, ranges, "all.ctrl"), "jobline", "control_file")
    wide = dict.fromkeys((100, 65536, 899999, 900000), "100-900000")
    rest = dict.fromkeys((0, 10, 12, 99, 900001), "all.ctrl")
    assert got == {3: "1-5", 4: "1-5", 7: "4-9", 9: "4-9", **wide, **rest}


def test_control_rows_scenarios_and_checks(spark):
    rows = [("f", 1, "docking_scenario_names", "s1:s2"), ("f", 2, "docking_scenario_programs", "vina:adfr"),
            ("f", 3, "docking_scenario_replicas", "1:3"), ("f", 4, "docking_scenario_inputfolders", "a:b"),
            ("g", 1, "docking_scenario_names", "s1:s2"), ("g", 2, "docking_scenario_programs", "vina")]
    control = spark.createDataFrame(rows, "file STRING, line_no INT, key STRING, value STRING")
    found = tasks.scenarios(control)
    assert sorted(tuple(r)[1:5] for r in found.where("file = 'f'").collect()) == [(1, "s1", "vina", 1), (2, "s2", "adfr", 3)]
    assert tasks.runs_per_ligand(found.where("file = 'f'")).first()[0] == 4
    checks = {(r["file"], r["check"]): (r["ok"], r["detail"]) for r in tasks.validate_control(control).collect()}
    assert checks["f", "programs_length"] == (True, None)
    assert checks["g", "programs_length"] == (False, "length mismatch: 2 names, 1 entries")


def test_vcpu(spark):
    subjobs = spark.createDataFrame([(1, 0, "SUCCEEDED", 8, 110)], "workunit INT, subjob INT, status STRING, vcpus INT, n_ligands INT")
    attempts = spark.createDataFrame(
        [(1, 0, 0, 0, 60_000, "host lost"), (1, 0, 1, None, None, "host lost"), (1, 0, 2, 120_000, 300_000, "Essential container in task exited")],
        "workunit INT, subjob INT, attempt_no INT, started_at LONG, stopped_at LONG, reason STRING",
    )
    units = spark.createDataFrame([(1, "j", "SUCCEEDED")], "workunit INT, job_id STRING, status STRING")
    row = batch.subjob_vcpu(subjobs, attempts).first()
    assert (row["vcpu_min_total"], row["vcpu_min_success"], row["vcpu_min_retried"], row["reattempts"]) == (32.0, 24.0, 8.0, 2)
    metrics = as_dict(batch.vcpu_metrics(units, subjobs, attempts), "metric", "value")
    assert metrics["vcpu_seconds_per_ligand"] == pytest.approx(17.4545, abs=1e-3)
    matrix = as_dict(batch.status_matrix(units, subjobs, attempts), "category", "SUCCEEDED", "TOTAL")
    assert matrix == {"ligands": (110, 110), "jobs": (1, 1), "subjobs": (1, 1), "vcpu_min": (32, 32), "vcpu_hours": (32 / 60, 32 / 60)}


def test_merge_status(spark):
    schema = "workunit INT, subjob INT, status STRING"
    current = spark.createDataFrame([(1, 0, "RUNNING"), (1, 1, "SUCCEEDED"), (1, 2, None)], schema)
    snapshot = spark.createDataFrame([(1, 0, "FAILED"), (1, 1, "RUNNING"), (1, 3, "PENDING")], schema)
    assert as_dict(batch.merge_status(current, snapshot), "subjob", "status") == {0: "FAILED", 1: "SUCCEEDED", 2: None, 3: "PENDING"}
    assert {r["subjob"] for r in batch.to_check(current).collect()} == {0, 2}


def test_assignment_and_jobs(spark):
    rows = spark.createDataFrame([(1, "A", 5, 1), (2, "A", 6, 2)], "seq LONG, collection STRING, n_ligands INT, workunit INT")
    events = spark.createDataFrame([("A",), ("B",)], "collection STRING")
    assert as_dict(assign.with_assignment(events, rows), "collection", "workunit") == {"A": 2, "B": None}
    jobs = spark.createDataFrame([("q", "RUNNING", "4*host"), ("q", "RUN", "host"), ("q", "PENDING", "2*h"), ("q", "COMPLETING", "h")], "queue STRING, state STRING, slots STRING")
    assert tuple(progress.job_snapshot(jobs).first()) == ("q", 2, 1, 5)


def test_scorer_failures_stay_single(spark):
    grid = spark.createDataFrame([("C", "a", 1, "S", "vina", 1), ("C", "b", 1, "S", "vina", 1)], "collection STRING, ligand STRING, scenario_idx INT, scenario STRING, program STRING, replica INT")

    def scorer(task):
        if task["ligand"] == "a":
            raise ValueError("no")
        return -3.5

    got = as_dict(tasks.score_results(tasks.run_scorer(grid, scorer, partitions=2)), "ligand", "status", "score")
    assert got == {"a": ("failed(docking)", None), "b": ("succeeded", -3.5)}
