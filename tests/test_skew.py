"""One key holding a third of all rows, as exact copies too."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from screenlake.operators import assign, batch, progress, state, summary

N = 6000


@pytest.fixture(scope="module")
def results(spark):
    """A third of the rows are copies of one docking, a third share its collection."""
    i = F.col("id")
    hot, warm = i % 3 == 0, i % 3 == 1
    return (
        spark.range(0, N, 1, 12)
        .select(
            F.lit("S").alias("scenario"),
            F.when(hot | warm, "A_1").otherwise(F.concat(F.lit("B_"), (i % 50).cast("string"))).alias("collection"),
            F.when(hot, "L0").otherwise(F.concat(F.lit("L"), (i % 700).cast("string"))).alias("ligand"),
            F.when(hot, 1).otherwise((i % 4).cast("int") + 1).alias("replica"),
            F.when(i % 7 == 1, "failed(docking)").otherwise("succeeded").alias("status"),
            F.when(hot, -5.0).when(i % 7 != 1, -(i % 40) / 2.0).alias("score"),
            F.timestamp_seconds(i % 11).alias("ts"),
        )
        .cache()
    )


@pytest.mark.parametrize("max_replicas", [None, 4])
def test_summary(results, max_replicas):
    want = defaultdict(list)
    for r in results.collect():
        if r["score"] is not None:
            want[r["collection"], r["ligand"]].append((r["replica"], r["score"]))
    got = {(r["collection"], r["ligand"]): r for r in summary.ligand_summary(results, max_replicas=max_replicas).collect()}
    assert set(got) == set(want)
    for key, pairs in want.items():
        values = [s for _, s in pairs]
        best = {}
        for replica, score in pairs:
            best[replica] = min(score, best.get(replica, score))
        assert got[key]["n_dockings"] == len(values)
        assert got[key]["avg_score"] == pytest.approx(sum(values) / len(values))
        assert (got[key]["best_score"], got[key]["worst_score"]) == (min(values), max(values))
        assert got[key]["scores"] == [best[k] for k in sorted(best)]


def test_counters_and_states(results):
    row = summary.collection_counters(results).where("collection = 'A_1'").first()
    rows = [r for r in results.collect() if r["collection"] == "A_1"]
    assert row["dockings_started"] == len(rows)
    assert row["ligands_started"] == len({r["ligand"] for r in rows})
    keys = Counter((r["collection"], r["ligand"], r["scenario"], r["replica"]) for r in results.collect())
    assert state.latest_state(results).count() == len(keys)


def test_lookups_keep_every_row(spark, results):
    assignment = spark.createDataFrame([(1, "A_1", 1), (2, "A_1", 2), (3, "B_2", 3)], "seq LONG, collection STRING, workunit INT")
    out = assign.with_assignment(results, assignment)
    assert out.count() == N
    assert out.where("collection = 'A_1' AND workunit = 2").count() == results.where("collection = 'A_1'").count()
    assert "_salt" in out._jdf.queryExecution().analyzed().toString()


def test_set_operations(spark, results):
    none = spark.createDataFrame([], "collection STRING")
    done = spark.createDataFrame([("B_2",)], "collection STRING")
    left = progress.remaining(results, done, none, none)
    assert left.count() == results.where("collection <> 'B_2'").count()
    both = summary.all_summaries(results.where("collection = 'A_1' AND replica = 1"), results)
    assert both.where("state = 'incomplete' AND collection = 'A_1'").count() == 0
    assert both.where("state = 'incomplete'").count() == results.where("collection <> 'A_1'").count()


def test_outcomes(results):
    counted = {r["outcome"]: r["n"] for r in batch.outcome_totals(batch.collection_outcomes(results)).collect()}
    assert sum(counted.values()) == N
