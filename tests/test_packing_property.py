"""Bin packing against a plain loop, with blocks small enough to need several."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from screenlake.operators import packing
from screenlake.operators.packing import pack_bins


def loop(rows, t):
    bins, gathered, total, closed = {}, [], 0, 0
    for seq, n in rows:
        if n >= t:
            bins[seq] = closed
            closed += 1
            continue
        gathered.append(seq)
        total += n
        if total >= t:
            bins.update(dict.fromkeys(gathered, closed))
            gathered, total, closed = [], 0, closed + 1
    bins.update(dict.fromkeys(gathered, closed))
    return bins


CASES = {
    "plain": (400, 97, 20, (1, 30)),
    "zeros": (300, 40, 7, (0, 9)),
    "many large": (200, 20, 11, (0, 40)),
    "long bins": (300, 5000, 10, (1, 60)),
    "one open bin": (60, 10**9, 8, (0, 5)),
    "all zero": (30, 5, 4, (0, 0)),
    "even": (120, 10, 9, (5, 5)),
    "one per bin": (50, 3, 6, (3, 8)),
}


@pytest.mark.parametrize("case", CASES)
def test_bins_equal_the_loop(spark, case):
    n, t, block, (low, high) = CASES[case]
    rng = random.Random(case)
    rows = [(seq * 3, rng.randint(low, high)) for seq in range(n)]
    df = spark.createDataFrame([(s, f"T_{s}", x) for s, x in rows], "seq LONG, collection STRING, n_ligands INT")
    got = {r["seq"]: r["bin"] for r in pack_bins(df, t, block).collect()}
    assert got == loop(rows, t)


def replayed(counts, refills, rounds, per_step):
    """Line by line, as one jobline after the other empties the list: (refill number, slot) of each line taken."""
    todo, out = list(enumerate(counts)), {}
    todo.reverse()
    for number, loads in refills:
        loads = list(loads)
        for k in range(1, rounds + 1):
            for slot in range(len(loads)):
                while loads[slot] < k * per_step:
                    if not todo:
                        return out
                    line, n = todo.pop()
                    loads[slot] += n
                    out[line] = (number, slot)
    return out


def test_refills_in_turn_equal_a_replay(spark):
    """100,000 lines: joblines go on over chunks and blocks, come again with what they hold, and stop in a line's middle."""
    rng = np.random.default_rng(11)
    counts = np.where(rng.random(100_000) < 0.1, 0, rng.integers(0, 2000, 100_000))
    manifest = spark.createDataFrame(pd.DataFrame({"seq": np.arange(len(counts)), "collection": [f"AA_{i}" for i in range(len(counts))], "n_ligands": counts}))
    manifest = manifest.withColumn("n_ligands", F.when(F.col("seq") % 1001 != 1000, F.col("n_ligands")).cast("int"))
    known = [int(c) for i, c in enumerate(counts) if i % 1001 != 1000]
    lines = [i for i in range(len(counts)) if i % 1001 != 1000]
    steps, queues, rounds, per_step = 2, 3, 5, 40_000
    for n_refills, block in ((30, 7_000), (70, 1_000_000), (200, 33_333)):
        loads = rng.integers(0, 150_000, (n_refills, steps * queues)) * (rng.random((n_refills, steps * queues)) < 0.5)
        refills = spark.createDataFrame([(i * 3, i % 7) for i in range(n_refills)], "refill LONG, jobline INT")
        held = [(i * 3, s // queues + 1, s % queues + 1, int(x)) for i, row in enumerate(loads) for s, x in enumerate(row) if x]
        load = spark.createDataFrame(held, "refill LONG, step INT, queue INT, n_ligands LONG")
        got = packing.refill_in_turn(manifest, refills, load, 10_000, rounds * per_step, per_step, steps, queues, block).toPandas()
        want = {lines[i]: v for i, v in replayed(known, list(enumerate(loads.tolist())), rounds, per_step).items()}
        assert len(got) == len(counts) and got.seq.is_unique
        taken = got[got.refill.notna()]
        assert {r.seq: (int(r.refill) // 3, (int(r.step) - 1) * queues + int(r.queue) - 1) for r in taken.itertuples()} == want
        assert (taken.jobline == (taken.refill // 3) % 7).all() and got[got.refill.isna()].jobline.isna().all()
        assert len(want) < len(lines) if n_refills == 30 else len(want) > 60_000


def test_refill_of_small_lists(spark):
    none = spark.createDataFrame([], "refill LONG, step INT, queue INT, n_ligands LONG")
    empty = spark.createDataFrame([], "seq LONG, collection STRING, n_ligands INT")
    one = spark.createDataFrame([(1, "A_1", 5), (2, "A_2", None), (3, "A_3", 0), (4, "A_4", 9)], "seq LONG, collection STRING, n_ligands INT")
    turns = spark.createDataFrame([(1, 4), (2, 4)], "refill LONG, jobline INT")
    run = lambda m, t: [tuple(r) for r in packing.refill_in_turn(m, t, none, 2, 5, 5, 1, 1).orderBy("seq").collect()]
    assert run(empty, turns) == [] and run(one, turns.limit(0))[0] == ("0000", 1, "A_1", 5, None, None, None, None)
    assert run(one, turns) == [("0000", 1, "A_1", 5, 1, 4, 1, 1), (None, 2, "A_2", None, *[None] * 4), ("0000", 3, "A_3", 0, 2, 4, 1, 1), ("0001", 4, "A_4", 9, 2, 4, 1, 1)]
