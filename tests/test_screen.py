"""The end-to-end screen, with an external program, a restart and published files."""

import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from screenlake.operators import tasks
from screenlake.operators.state import latest_state
from screenlake.plans import published
from screenlake.plans.screen import publish, screen
from screenlake.sources import sinks, snapshots, text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIGANDS = [
    ("AAB_1", "ok", "REMARK SMILES CCO\nATOM 1 C LIG 1 1 2 3\n"),
    ("AAB_1", "bad", "ATOM 1 C LIG 1 1 2 3 Si\n"),
    ("AAB_2", "slow", "ATOM 1 C LIG 1 1 2 3\n"),
]
SCRIPT = 'grep -q ATOM "$1" || exit 3; [ "$3" = 2 ] && exit 4; printf "MODEL\\nENDMDL\\n" > "$2"; printf "   1    -7.5   0.0\\n"'


def tables(spark):
    ligands = spark.createDataFrame(LIGANDS, "collection STRING, ligand STRING, content STRING")
    scenarios = spark.createDataFrame(
        [(1, "S1", "vina", 2), (2, "S2", "nodock", 1)], "idx INT, name STRING, program STRING, replicas INT"
    )
    return ligands, scenarios


def run_program(task, ligand, pose):
    return ["sh", "-c", SCRIPT, "sh", ligand, pose, str(task["replica"])]


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_screen_with_an_external_program(spark, tmp_path):
    ligands, scenarios = tables(spark)
    out = screen(ligands, scenarios, tasks.command_scorer(run_program), partitions=3)
    keys = ("collection", "ligand", "scenario", "replica", "status")
    assert rows(out.status, *keys) == [
        ("AAB_1", "bad", None, None, "failed"),
        ("AAB_1", "ok", "S1", 1, "succeeded"),
        ("AAB_1", "ok", "S1", 2, "failed(docking)"),
        ("AAB_1", "ok", "S2", 1, "failed(docking_program)"),
        ("AAB_2", "slow", "S1", 1, "succeeded"),
        ("AAB_2", "slow", "S1", 2, "failed(docking)"),
        ("AAB_2", "slow", "S2", 1, "failed(docking_program)"),
    ]
    assert rows(out.summary, "ligand", "best_score", "n_dockings", "scores") == [("ok", -7.5, 1, [-7.5]), ("slow", -7.5, 1, [-7.5])]
    assert rows(tasks.first_pose(out.results), "pose")[0] == ("MODEL\nENDMDL",)
    counters = {r["collection"]: tuple(r)[1:] for r in out.counters.collect()}
    assert counters == {"AAB_1": (2, 1, 2, 4, 1, 3), "AAB_2": (1, 1, 1, 3, 1, 2)}

    publish(out, str(tmp_path), 2)
    back = sinks.read_results(spark, f"{tmp_path}/results")
    assert rows(back, *keys) == rows(out.results, *keys)
    assert rows(text.read_status(spark, f"{tmp_path}/ligand-lists", "jsonl"), *keys) == rows(out.status, *keys)
    summaries = text.read_summaries(spark, f"{tmp_path}/summaries", "S1", layout="table")
    assert rows(summaries, "ligand", "best_score", "scores") == [("ok", -7.5, [-7.5]), ("slow", -7.5, [-7.5])]


def test_restart_and_energy(spark):
    ligands, scenarios = tables(spark)
    states = [("AAB_1", "ok", "S1", 1, "succeeded"), ("AAB_1", "ok", "S1", 2, "processing"), ("AAB_1", "ok", "S2", 1, "failed(docking_program)")]
    finished = latest_state(
        spark.createDataFrame(states, "collection STRING, ligand STRING, scenario STRING, replica INT, status STRING")
        .withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    )
    energies = spark.createDataFrame(
        [("AAB_1", "ok", "S1", 2, 5.0), ("AAB_2", "slow", "S1", 1, 20_000.0)],
        "collection STRING, ligand STRING, scenario STRING, replica INT, energy DOUBLE",
    )
    out = screen(ligands, scenarios, lambda task: -1.0 * task["replica"], finished=finished, energies=energies)
    assert rows(out.results, "ligand", "scenario", "replica", "status", "score") == [
        ("ok", "S1", 2, "succeeded", -2.0),
        ("slow", "S1", 1, "energy-check:failed", None),
        ("slow", "S1", 2, "energy-check:failed", None),
        ("slow", "S2", 1, "failed(docking_program)", None),
    ]


# -- published runs and restarts -------------------------------------------------------------

KEYS = ("collection", "ligand", "scenario", "replica", "status", "score")


def library(spark, names, content="ATOM 1 C LIG 1 1 2 3\n"):
    return spark.createDataFrame([(*n.split("/"), content) for n in names], "collection STRING, ligand STRING, content STRING")


def scored(spark, names, replicas=2, finished=None):
    scenarios = spark.createDataFrame([(1, "S1", "vina", replicas)], "idx INT, name STRING, program STRING, replicas INT")
    return screen(library(spark, names), scenarios, lambda t: -1.0 * t["replica"] - len(t["ligand"]), finished=finished)


def spoil(folder):
    """Make all data files of a folder unreadable, but for the index of its collections."""
    for file in folder.rglob("*"):
        if file.is_file() and "/index/" not in str(file):
            file.write_bytes(b"unreadable")


def test_another_collection_reads_no_earlier_data(spark, tmp_path):
    root = f"{tmp_path}/runs"
    published.publish_run(scored(spark, ["AAA_1/x", "AAA_1/yy", "AAB_2/x"]), root, 2)
    spoil(next((tmp_path / "runs").glob("data-*")))
    published.publish_run(scored(spark, ["AAA_3/z"]), root, 2)
    _, content = snapshots.current(spark, root)
    assert [r["replaced"] for r in content["runs"]] == [False, False]
    newest = f"{root}/{content['runs'][1]['folder']}"
    assert rows(sinks.read_results(spark, f"{newest}/results"), "collection", "ligand", "replica") == [("AAA_3", "z", 1), ("AAA_3", "z", 2)]


def test_a_collection_passes_whole_to_its_newest_run(spark, tmp_path):
    """Task by task: those published before stay, later ones replace or join them; folders of others are not opened."""
    root = f"{tmp_path}/runs"
    for level in ("collection", "tranche"):
        root = f"{tmp_path}/{level}"
        first = published.publish_run(scored(spark, ["AAA_1/x", "AAB_2/x"], replicas=1), root, 3, level)
        published.publish_run(scored(spark, ["AAC_9/q"]), root, 3, level)
        states = latest_state(first.status.withColumn("ts", F.current_timestamp()))
        published.publish_run(scored(spark, ["AAA_1/x", "AAA_1/new"], replicas=3, finished=states), root, 3, level)
        want = [("AAA_1", "new", r) for r in (1, 2, 3)] + [("AAA_1", "x", r) for r in (1, 2, 3)] + [("AAB_2", "x", 1), ("AAC_9", "q", 1), ("AAC_9", "q", 2)]
        summaries = [("AAA_1", "new", 3, [-4.0, -5.0, -6.0]), ("AAA_1", "x", 3, [-2.0, -3.0, -4.0]), ("AAB_2", "x", 1, [-2.0]), ("AAC_9", "q", 2, [-2.0, -3.0])]

        def check():
            assert rows(published.published_results(spark, root), "collection", "ligand", "replica") == want
            assert rows(published.published_status(spark, root), "collection", "ligand", "replica") == want
            got = published.published_summaries(spark, root).withColumn("scores", F.filter("scores", lambda s: s.isNotNull()))
            assert rows(got, "collection", "ligand", "n_dockings", "scores") == summaries

        check()
        assert [r["replaced"] for r in snapshots.current(spark, root)[1]["runs"]] == [True, False, False]
        published.compact_runs(spark, root, level)
        check()
        assert len(snapshots.current(spark, root)[1]["runs"]) == 1


def test_a_publisher_that_is_lost_leaves_the_snapshot_before(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/runs"
    published.publish_run(scored(spark, ["AAA_1/x"]), root, 2)
    before = rows(published.published_results(spark, root), *KEYS)
    for sink in ("write_results", "write_status", "write_summary_text"):
        with monkeypatch.context() as broken:
            write = getattr(sinks, sink)

            def lost(*args, **kwargs):
                write(*args, **kwargs)
                raise RuntimeError("lost")

            broken.setattr(sinks, sink, lost)
            with pytest.raises(RuntimeError, match="lost"):
                published.publish_run(scored(spark, ["AAA_1/new", "AAB_2/x"]), root, 2)
        assert rows(published.published_results(spark, root), *KEYS) == before
        assert rows(published.published_status(spark, root), "ligand") == [("x",), ("x",)]
        assert rows(published.published_summaries(spark, root), "ligand") == [("x",)]
    published.publish_run(scored(spark, ["AAA_1/new", "AAB_2/x"]), root, 2)
    assert rows(published.published_summaries(spark, root), "collection", "ligand") == [("AAA_1", "new"), ("AAA_1", "x"), ("AAB_2", "x")]
    # Folders of the lost runs are gone; those of the two last snapshots stay.
    assert len(list((tmp_path / "runs").glob("data-*"))) == 2


def test_open_tasks_are_incomplete_until_they_end(spark, tmp_path):
    root = f"{tmp_path}/runs"
    scenarios = spark.createDataFrame([(1, "S1", "vina", 2)], "idx INT, name STRING, program STRING, replicas INT")
    grid = tasks.task_grid(library(spark, ["AAA_1/x", "AAB_2/x"]).drop("content"), scenarios)
    first = published.publish_run(scored(spark, ["AAA_1/x"], replicas=1), root, 2, grid=grid.where("collection = 'AAA_1'"))
    assert rows(published.published_results(spark, root), "state", "replica") == [("incomplete", 1)]
    states = latest_state(first.status.withColumn("ts", F.current_timestamp()))
    published.publish_run(scored(spark, ["AAA_1/x", "AAB_2/x"], finished=states), root, 2, grid=grid)
    assert rows(published.published_results(spark, root), "state", "collection", "replica") == [
        ("complete", "AAA_1", 1), ("complete", "AAA_1", 2), ("complete", "AAB_2", 1), ("complete", "AAB_2", 2)
    ]


def test_a_killed_screen_goes_on_with_its_chunks(spark, tmp_path):
    """The worker dies in the middle; afterwards only ligands of the chunks that were not whole are docked again."""
    log = tmp_path / "docked"
    log.mkdir()
    ligands = library(spark, [f"AAA_{i % 7}/Z{i}" for i in range(200)]).union(library(spark, ["AAA_1/bad"], "ATOM 1 C LIG 1 1 2 3 Si\n"))
    scenarios = spark.createDataFrame([(1, "S1", "vina", 2)], "idx INT, name STRING, program STRING, replicas INT")
    cost = 21 * 2 * 10  # about ten ligands

    def scorer(task, fatal):
        with open(log / f"{task['ligand']}-{task['replica']}", "a") as file:
            file.write("x")
        if fatal and len(os.listdir(log)) > 150:
            os._exit(1)
        return -1.0 * task["replica"]

    run = lambda fatal: screen(ligands, scenarios, lambda t: scorer(t, fatal), partitions=4, progress=f"{tmp_path}/progress", chunk_cost=cost)
    with pytest.raises(Exception, match="(?i)worker|crash|exit"):
        run(True).results.count()
    kept = len(list((tmp_path / "progress" / "chunks").glob("chunk-*.parquet")))
    before = len(os.listdir(log))
    assert kept > 0 and before > 100
    out = run(False)
    assert rows(out.results.groupBy("collection").count(), "count") and out.results.count() == 400
    assert rows(out.status.where("scenario IS NULL"), "ligand", "status") == [("bad", "failed")]
    again = [p for p in log.iterdir() if len(p.read_text()) > 1]
    # Four tasks, each at one chunk of about ten ligands with two replicas.
    assert len(os.listdir(log)) == 400 and len(again) < 4 * 3 * 20 < 400
    docked = {p.name: p.read_text() for p in log.iterdir()}
    assert run(False).results.count() == 400 and docked == {p.name: p.read_text() for p in log.iterdir()}
    with pytest.raises(ValueError, match="another screen"):
        screen(ligands.limit(5), scenarios, lambda t: -1.0, progress=f"{tmp_path}/progress")
