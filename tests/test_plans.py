"""Shapes of physical plans that have to hold at any scale."""

import re

import pytest
from pyspark.sql import functions as F

from screenlake.adapters import table
from screenlake.catalog import QUERIES
from screenlake.operators.summary import ligand_summary

SF_DIR = "/root/testdata/sf0.001"
ROWS = ("w1", "w2", "w5", "w6", "w8", "j1", "j4", "j5", "p3", "p4", "p5", "u1", "a1", "a3", "a7", "w7", "r4", "a8", "u3", "j3")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def details_of(df):
    """Plan with whole column lists."""
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.split("_")[0] in ROWS))
def test_no_products_and_no_window_in_one_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # A single-task exchange is allowed below a final total only, never below a window.
    for window in re.finditer(r"Window \[", plan):
        below = plan[window.start():]
        exchange = re.search(r"Exchange (\w+)", below)
        assert exchange is None or exchange.group(1) != "SinglePartition"


def test_checks_do_not_shuffle(spark):
    for name in ("p3_flag_elements", "p4_duplicate_coords", "p5_ligand_verdict_aws", "p6_smiles", "p7_extract_score", "j1_task_grid"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        # The short scenario list is folded in a subquery of its own.
        main = plan.split("Subquery", 1)[0] if name != "j1_task_grid" else plan.split("+- Scan", 1)[0]
        assert "Exchange hashpartitioning" not in main, name


def test_scans_read_needed_columns_only(spark):
    plan = details_of(QUERIES["a7_score_histogram"](spark, SF_DIR))
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "l_shipdate" not in read and "l_orderkey" not in read and "l_quantity" in read


def test_filters_reach_the_scan(spark):
    df = QUERIES["a14_queue_load"](spark, SF_DIR)
    assert "o_orderstatus" in re.search(r"PushedFilters: \[([^\]]*)\]", details_of(df)).group(1)


def test_top_list_passes_through_no_single_task(spark):
    plan = plan_of(QUERIES["k1_top_compounds_nearly_all"](spark, SF_DIR))
    assert "TakeOrderedAndProject" not in plan and "SinglePartition" not in plan


def test_summary_combines_before_the_shuffle(spark):
    df = ligand_summary(table(spark, SF_DIR, "result"), with_scores=False)
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(df))) == 1
    assert "partial_min" in details_of(df)


def test_partial_filter_is_no_python(spark):
    assert "Python" not in plan_of(QUERIES["p7_extract_score"](spark, SF_DIR).where(F.col("score") < 0))


def test_successors_take_one_shuffle(spark, monkeypatch):
    """One exchange of all rows, no sort over the table, no checkpoint; stretches of any size give the same."""
    from screenlake.operators import state

    plan = plan_of(QUERIES["w8_next_ligand"](spark, SF_DIR))
    borders, rows = plan.count("Aggregate("), len(re.findall(r"Exchange hashpartitioning\(collection[^,]*, _stretch", plan))
    # Beside the rows only borders, folded before they are sent, move.
    assert rows == 2 and borders == 2 and "rangepartitioning" not in plan and "ExistingRDD" not in plan
    monkeypatch.setattr(state, "POSITIONS", 7)
    ligands = [("A", p, f"L{p}") for p in range(-20, 3000, 3)] + [("A", 4, "twin"), ("A", 4, None), ("A", None, "none"), ("B", 5, "only"), (None, 1, "x"), (None, 2, "y")]
    got = state.next_ligand(spark.createDataFrame(ligands, "collection STRING, pos INT, ligand STRING")).collect()
    a = sorted((r for r in ligands if r[0] == "A"), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
    want = {("A", p, x): y for (_, p, x), (_, _, y) in zip(a, [*a[1:], (0, 0, None)])}
    assert {(r["collection"], r["pos"], r["ligand"]): r["next_ligand"] for r in got} == want | {("B", 5, "only"): None, (None, 1, "x"): None, (None, 2, "y"): None}


def test_pending_tasks_are_met_before_they_are_multiplied(spark):
    plan = plan_of(QUERIES["j3_pending_tasks"](spark, SF_DIR))
    assert plan.count("Join") == 1 and plan.index("Generate explode") < plan.index("Join")


def test_pending_tasks_are_looked_up_in_compiled_code(spark):
    """No list of tasks is made by interpreted functions, and rows are those that the lists hold."""
    from screenlake.operators import tasks

    assert "lambdafunction" not in plan_of(QUERIES["j3_pending_tasks"](spark, SF_DIR))
    ligands = spark.createDataFrame([("A", "L1"), ("A", "L2"), ("A", "L2"), (None, "L3"), ("B", "L4")], "collection STRING, ligand STRING")
    scenarios = spark.createDataFrame([(1, "s", "vina", 2), (2, None, "adfr", 1), (3, "t", "vina", 0), (4, "t", None, 2)], "idx INT, name STRING, program STRING, replicas INT")
    latest = [("A", "L1", "s", 1, "succeeded"), ("A", "L1", "s", 2, "processing"), ("A", "L2", "t", 2, "failed"), ("A", "L2", None, 1, "failed"), (None, "L3", "s", 1, "succeeded")]
    latest += [("B", "L4", s, r, "succeeded") for s in ("s", "t") for r in (1, 2)]
    latest = spark.createDataFrame(latest, "collection STRING, ligand STRING, scenario STRING, replica INT, status STRING")
    order = lambda rows: sorted(map(tuple, rows), key=str)
    lists = tasks.pending_lists(ligands, scenarios, latest).selectExpr("collection", "ligand", "inline(_tasks)")
    got = tasks.pending_grid(ligands, scenarios, latest)
    assert got.columns == lists.columns and order(got.collect()) == order(lists.collect())
    assert got.where("ligand = 'L4'").count() == 1 and got.where("ligand = 'L2'").count() == 8 and got.where("ligand = 'L3'").count() == 5
