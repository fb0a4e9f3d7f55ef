"""Packing collections into chunks, bins, work units and queues."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.operators.joins import salted_join
from screenlake.operators.ordering import number_rows, running_totals
from screenlake.session import shared_path, stable

# Rows handled together when bin chains are followed inside one task.
BLOCK = 50_000
# Lines of a list that one task hands out to queues.
REFILL_BLOCK = 500_000


def chunk_manifest(manifest: DataFrame, n: int) -> DataFrame:
    """Add `chunk`: consecutive groups of n lines, `0000`, `0001`, ..."""
    index = F.floor(F.col("_rn") / n).cast("long").cast("string")
    width = F.greatest(F.length(index), F.lit(4))
    return (
        number_rows(manifest, ["seq", "collection"], "_rn", start=0)
        .withColumn("chunk", F.lpad(index, width, F.lit("0")))
        .drop("_rn")
    )


def _first_reaching(rows: DataFrame, t: int) -> DataFrame:
    """(block, id, nxt): for a bin starting at row `id`, the row after the one closing it, else -1.

    `rows` has block, rn, x and the running total p. The bin closes at the first row whose p is at least
    p - x + t: a binary search in the row's own block. For the others the ends of the blocks, one number each,
    tell the block, and only these rows are sent there.
    """
    # One number per block.
    ends = [r["end"] for r in rows.groupBy("block").agg(F.max("p").alias("end")).orderBy("block").collect()]
    border = np.array(ends, np.int64)

    def search(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("rn")
        p, first = own["p"].to_numpy(), int(own["rn"].iloc[0])
        wanted = p - own["x"].to_numpy() + t
        at = np.searchsorted(p, wanted)
        target = np.searchsorted(border, wanted)
        here, ended = at < len(p), target >= len(border)
        nxt = np.where(here, first + at + 1, np.where(ended, -1, 0))
        return pd.DataFrame({"block": own["block"], "id": own["rn"], "nxt": nxt, "wanted": wanted, "target": np.where(here | ended, -1, target)})

    def meet(leaving: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("rn")
        if not len(leaving):
            return pd.DataFrame({"block": [], "id": [], "nxt": []}, dtype="int64")
        at = np.searchsorted(own["p"].to_numpy(), leaving["wanted"].to_numpy())
        return pd.DataFrame({"block": leaving["block"], "id": leaving["id"], "nxt": int(own["rn"].iloc[0]) + at + 1})

    found = stable(rows.groupBy("block").applyInPandas(search, "block LONG, id LONG, nxt LONG, wanted LONG, target LONG"))
    leaving = found.where("target >= 0")
    # Only blocks that rows lead to are read again.
    asked = leaving.select(F.col("target").alias("block")).distinct()
    met = leaving.groupBy("target").cogroup(rows.select("block", "rn", "p").join(asked, "block", "left_semi").groupBy("block")).applyInPandas(
        meet, "block LONG, id LONG, nxt LONG"
    )
    return found.where("target < 0").select("block", "id", "nxt").unionAll(met)


def _block_exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """First row outside the block on the chain from each row of the block; -1: chain ends."""
    pdf = pdf.sort_values("id")
    ids, jump = pdf["id"].to_numpy(), pdf["nxt"].to_numpy().copy()
    inside = (jump >= 0) & (jump <= ids[-1])
    while inside.any():
        jump[inside] = jump[jump[inside] - ids[0]]
        inside = (jump >= 0) & (jump <= ids[-1])
    return pd.DataFrame({"block": pdf["block"], "id": ids, "nxt": pdf["nxt"], "exit": jump})


def _mark_starts(links: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """Per row the start of its bin where that lies in the block, else -1.

    The chain enters a block at one row at most; `after` is the row after the bin's last
    one, given on the start row only.
    """
    links = links.sort_values("id")
    ids, nxt = links["id"].to_numpy(), links["nxt"].to_numpy()
    start, after = np.full(len(ids), -1, "int64"), np.full(len(ids), -1, "int64")
    if len(ids) and len(entries):
        # A chain that ends on the very last row also points one row past it.
        first, at = int(ids[0]), int(entries["id"].min()) - int(ids[0])
        while 0 <= at < len(ids):
            to = int(nxt[at]) - first if nxt[at] >= 0 else len(ids)
            start[at:to] = first + at
            after[at] = nxt[at]
            at = to
    return pd.DataFrame({"block": links["block"], "id": ids, "start": start, "after": after})


def _reached_entries(links: DataFrame) -> DataFrame:
    """Rows at which the chain from row 1 enters a block.

    Only rows that are some row's exit can be entered. Over them the chain is followed with
    doubled steps, so the number of rounds is the logarithm of the number of blocks.
    """
    spark = links.sparkSession
    reached = spark.createDataFrame([(1,)], "id LONG")
    entered = links.where("exit >= 0").select(F.col("exit").alias("id")).distinct().union(reached).distinct()
    jumps = stable(links.join(entered, "id").select("id", F.col("exit").alias("to")).where("to >= 0"))
    while not jumps.isEmpty():
        landed = reached.join(jumps, "id").select(F.col("to").alias("id"))
        reached = stable(reached.union(landed).distinct())
        onward = jumps.select(F.col("id").alias("to"), F.col("to").alias("beyond"))
        jumps = stable(jumps.join(onward, "to").select("id", F.col("beyond").alias("to")))
    return reached


def pack_bins(manifest: DataFrame, t: int, block: int = BLOCK) -> DataFrame:
    """Greedy packing in manifest order; adds `bin`, numbered from 0 in order of closing.

    A collection of at least t ligands is a bin of its own. Smaller ones gather until their
    sum reaches t; then the sum starts again at 0. What is left at the end is the last bin.
    A collection without a count (an error line of a manifest) comes back with a null bin.

    Exact and parallel: every row knows where a bin starting at it would end, the chain of
    bin starts is contracted inside blocks of rows with dense numbers (bounded tasks), and
    only the few block entries are chased across blocks.
    """
    large = manifest.where(F.col("n_ligands") >= t)
    small = manifest.where(F.col("n_ligands") < t)
    rows = running_totals(small, ["seq", "collection"], "n_ligands").withColumn("x", F.col("n_ligands"))
    block_of = F.floor((F.col("id") - 1) / block).cast("long")
    in_block = F.floor((F.col("rn") - 1) / block).cast("long").alias("block")
    links = _first_reaching(rows.select(in_block, "rn", F.col("x").cast("long").alias("x"), "p"), t)
    exits = stable(
        links.groupBy("block").applyInPandas(_block_exits, "block LONG, id LONG, nxt LONG, exit LONG")
    )
    entries = _reached_entries(exits).withColumn("block", block_of)
    marked = stable(
        exits.select("block", "id", "nxt").groupBy("block")
        .cogroup(entries.groupBy("block"))
        .applyInPandas(_mark_starts, "block LONG, id LONG, start LONG, after LONG")
    )
    opened = marked.where("start = id").select("start", "after")
    # A bin that goes on into later blocks: at most one such bin per block.
    end = F.when(F.col("after") > 0, F.col("after") - 1).otherwise(exits.agg(F.max("id")).scalar())
    carried = (
        opened.select("start", F.floor((F.col("start") - 1) / block).cast("long").alias("from"),
                      F.floor((end - 1) / block).cast("long").alias("to"))
        .where("`to` > `from`")
        .select(F.col("start").alias("_carried"), F.explode(F.sequence(F.col("from") + 1, F.col("to"))).alias("block"))
    )
    placed = marked.join(carried, "block", "left").select(
        F.col("id").alias("rn"), F.when(F.col("start") > 0, F.col("start")).otherwise(F.col("_carried")).alias("start")
    )
    # Bins close where their last row stands in the manifest; the open remainder comes last.
    closing = rows.select((F.col("rn") + 1).alias("after"), "seq", "collection")
    ends = (
        opened.join(closing, "after", "left")
        .select("start", F.col("seq").isNull().alias("_open"), "seq", "collection")
        .unionAll(large.select(F.lit(None).cast("long"), F.lit(False), "seq", "collection"))
    )
    bins = number_rows(ends, ["_open", "seq", "collection"], "bin", start=0)
    of_small = salted_join(
        rows.join(placed, "rn").select(*manifest.columns, "start"),
        bins.where("start IS NOT NULL").select("start", "bin"),
        ["start"],
    )
    of_large = large.join(bins.where("start IS NULL").select("seq", "collection", "bin"), ["seq", "collection"])
    unknown = manifest.where(F.col("n_ligands").isNull()).withColumn("bin", F.lit(None).cast("long"))
    return (
        of_small.select(*manifest.columns, "bin")
        .unionAll(of_large.select(*manifest.columns, "bin"))
        .unionAll(unknown.select(*manifest.columns, "bin"))
    )


def group_workunits(bins: DataFrame, size: int, queues: int) -> DataFrame:
    """Add workunit (from 1), subjob (from 0), the submit queue and the array size of the unit."""
    n_bins = bins.agg(F.max("bin") + 1).scalar()
    workunit = F.floor(F.col("bin") / size).cast("long") + 1
    in_unit = F.least(F.lit(size).cast("long"), n_bins - (F.col("workunit") - 1) * size)
    return bins.withColumns(
        {"workunit": workunit, "subjob": F.pmod(F.col("bin"), F.lit(size))}
    ).withColumns(
        {
            "submit_queue": F.pmod(F.col("workunit") - 1, F.lit(queues)) + 1,
            "array_size": F.greatest(F.lit(2).cast("long"), in_unit),
        }
    )


def refill_queues(
    manifest: DataFrame,
    load: DataFrame,
    chunk_size: int,
    ligands_per_queue: int,
    ligands_per_step: int,
    steps: int,
    queues: int,
) -> DataFrame:
    """Refill the queues of each jobline from its own chunk of the manifest.

    Jobline j takes from the j-th chunk of `chunk_size` lines, so one task holds at most one
    chunk. In rounds k = 1, 2, ... each queue (by step, then queue) takes lines in order
    until its ligands reach k * ligands_per_step. `load` has the ligands queues hold before
    (jobline, step, queue, n_ligands). Lines not taken come back with null step and queue: they stay
    on the list.
    """
    rounds = ligands_per_queue // ligands_per_step

    def refill(lines: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        lines = lines.sort_values("_rn")
        before = {(r.step, r.queue): int(r.n_ligands) for r in held.itertuples()}
        slots = [(s, q) for s in range(1, steps + 1) for q in range(1, queues + 1)]
        loads = {slot: before.get(slot, 0) for slot in slots}
        counts, taken, at = lines["n_ligands"].to_numpy(), [], 0
        for k in range(1, rounds + 1):
            for slot in slots:
                while at < len(counts) and loads[slot] < k * ligands_per_step:
                    loads[slot] += int(counts[at])
                    taken.append(slot)
                    at += 1
        out = lines[["jobline", "seq", "collection", "n_ligands"]].copy()
        untaken = [None] * (len(lines) - at)
        out["step"] = pd.array([s for s, _ in taken] + untaken, "Int32")
        out["queue"] = pd.array([q for _, q in taken] + untaken, "Int32")
        return out

    lines = number_rows(manifest, ["seq", "collection"], "_rn", start=0).select(
        (F.floor(F.col("_rn") / chunk_size) + 1).cast("int").alias("jobline"),
        "_rn", F.col("seq").cast("long"), "collection", F.col("n_ligands").cast("int"),
    )
    folded = load.groupBy("jobline", "step", "queue").agg(F.sum("n_ligands").cast("long").alias("n_ligands"))
    return (
        lines.groupBy("jobline")
        .cogroup(folded.groupBy("jobline"))
        .applyInPandas(refill, "jobline INT, seq LONG, collection STRING, n_ligands INT, step INT, queue INT")
    )


class RefillState:
    """Where a list is after some of its lines: which refill takes, its stage, and what its queues hold.

    A refill goes through `rounds` x queues stages; in stage (k, queue) that queue takes lines until it holds
    k * step ligands. `take` is the transfer function of a block of lines: state in, state out.
    """

    def __init__(self, refills: list[tuple[int, list[int]]], rounds: int, per_step: int, at: tuple | None = None):
        self.refills, self.rounds, self.per_step = refills, rounds, per_step
        self.refill, self.stage, self.loads = at or (0, 0, list(refills[0][1]) if refills else [])

    def as_tuple(self) -> tuple[int, int, list[int]]:
        return self.refill, self.stage, self.loads

    def done(self) -> bool:
        return self.refill >= len(self.refills)

    def take(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(refill, slot) of every line of the block, -1 for the lines behind the last refill.

        A stage takes a stretch of lines; its end is found by binary search in their running sum.
        """
        sums = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        refill, slot = np.full(len(counts), -1, np.int64), np.full(len(counts), -1, np.int64)
        start = 0
        while not self.done():
            slots = len(self.loads)
            while self.stage < self.rounds * slots:
                k, s = divmod(self.stage, slots)
                missing = (k + 1) * self.per_step - self.loads[s]
                if missing > 0:
                    if start == len(counts):
                        return refill, slot
                    end = min(int(np.searchsorted(sums, sums[start] + missing)), len(counts))
                    refill[start:end], slot[start:end] = self.refill, s
                    self.loads[s] += int(sums[end] - sums[start])
                    start = end
                    if self.loads[s] < (k + 1) * self.per_step:
                        return refill, slot
                self.stage += 1
            self.refill, self.stage = self.refill + 1, 0
            self.loads = [] if self.done() else list(self.refills[self.refill][1])
        return refill, slot


def refill_in_turn(
    manifest: DataFrame,
    refills: DataFrame,
    load: DataFrame,
    chunk_size: int,
    ligands_per_queue: int,
    ligands_per_step: int,
    steps: int,
    queues: int,
    block: int = REFILL_BLOCK,
) -> DataFrame:
    """Refills one after the other from one list: a jobline that empties a chunk goes on with the next one.

    refills: (refill, jobline), in the order of `refill`; a jobline may come several times. load: what its
    queues hold just before, (refill, step, queue, n_ligands). In rounds k = 1, 2, ... each queue (by step, then
    queue) takes lines in order until its ligands reach k * ligands_per_step; the next refill goes on where
    this one stopped. Returns the lines with `chunk`, and with refill, jobline, step and queue, null for those
    that stay on the list; a line without a count is no work and stays as well.

    The list is under one lock, so refills depend on each other by the lines where they stop. What is passed
    on is small: blocks of the list, bounded and written as they are done, hand the state of one refill to the
    next block (`RefillState`), and blocks behind the last refill are not touched. The driver holds one number
    per queue of each refill, and no lines.
    """
    spark, slots = manifest.sparkSession, steps * queues
    rounds = ligands_per_queue // ligands_per_step
    given = {(r["refill"], r["slot"]): r["n"] for r in load.groupBy(
        "refill", ((F.col("step") - 1) * queues + F.col("queue") - 1).alias("slot")).agg(F.sum("n_ligands").alias("n")).collect()}
    order = refills.select(F.col("refill").cast("long").alias("refill"), F.col("jobline").cast("int").alias("jobline")).orderBy("refill", "jobline").collect()
    turns = [(r["jobline"], [int(given.get((r["refill"], s)) or 0) for s in range(slots)]) for r in order]
    numbers, joblines = np.array([r["refill"] for r in order] or [0]), np.array([r["jobline"] for r in order] or [0])

    index = F.floor(F.col("_rn") / chunk_size).cast("long").cast("string")
    chunk = F.lpad(index, F.greatest(F.length(index), F.lit(4)), F.lit("0")).alias("chunk")
    lines, folder = shared_path(spark, "refill-lines"), shared_path(spark, "refills")
    # Files hold ranges of line numbers, so a block reads its own files only.
    number_rows(manifest.where("n_ligands IS NOT NULL"), ["seq", "collection"], "_rn", start=0).select(
        "_rn", chunk, F.col("seq").cast("long"), "collection", F.col("n_ligands").cast("long")
    ).write.parquet(lines)
    numbered = spark.read.parquet(lines)
    last = numbered.agg(F.max("_rn")).first()[0]
    total = 0 if last is None else last + 1
    plain = "chunk STRING, seq LONG, collection STRING, n_ligands LONG, refill LONG, jobline INT, step INT, queue INT"
    state, at, written = RefillState(turns, rounds, ligands_per_step), 0, []

    def assign(before: tuple) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("_rn", ignore_index=True)
            now = RefillState(turns, rounds, ligands_per_step, (before[0], before[1], list(before[2])))
            turn, slot = now.take(rows["n_ligands"].to_numpy())
            taken = turn >= 0
            out = rows[["chunk", "seq", "collection", "n_ligands"]].copy()
            for name, values in (
                ("refill", numbers[turn]), ("jobline", joblines[turn]), ("step", slot // queues + 1), ("queue", slot % queues + 1)
            ):
                out[name] = pd.array(np.where(taken, values, 0), "Int64")
                out.loc[~taken, name] = pd.NA
            # The state behind the block goes along with its last line.
            out["state"] = None
            out.loc[len(out) - 1, "state"] = json.dumps(now.as_tuple())
            return out

        return run

    while at < total and not state.done():
        part = numbered.where((F.col("_rn") >= at) & (F.col("_rn") < at + block)).withColumn("_block", F.floor(F.col("_rn") / block))
        path = f"{folder}/{len(written)}"
        part.groupBy("_block").applyInPandas(assign(state.as_tuple()), f"{plain}, state STRING").write.parquet(path)
        written.append(path)
        after = spark.read.schema(f"{plain}, state STRING").parquet(path).where("state IS NOT NULL").first()["state"]
        state, at = RefillState(turns, rounds, ligands_per_step, tuple(json.loads(after))), at + block
    nothing = {n: F.lit(None).cast(t) for n, t in (("refill", "long"), ("jobline", "int"), ("step", "int"), ("queue", "int"))}
    rest = numbered.where(F.col("_rn") >= at).drop("_rn").withColumns(nothing)
    uncounted = manifest.where("n_ligands IS NULL").select(
        F.lit(None).cast("string").alias("chunk"), F.col("seq").cast("long"), "collection", F.col("n_ligands").cast("long")
    ).withColumns(nothing)
    done = [spark.read.schema(f"{plain}, state STRING").parquet(*written).drop("state")] if written else []
    return reduce(DataFrame.unionByName, [*done, rest, uncounted])


def redistribute_single(collections: DataFrame, queues: int, steps: int, first_job: int = 1) -> DataFrame:
    """One collection per queue: queues of a step first, then steps of a job, then jobs."""
    rn = F.col("_rn")
    return (
        number_rows(collections, ["seq", "collection"], "_rn", start=0)
        .withColumns(
            {
                "job": (F.floor(rn / (queues * steps)) + first_job).cast("int"),
                "step": (F.pmod(F.floor(rn / queues), F.lit(steps)) + 1).cast("int"),
                "queue": (F.pmod(rn, F.lit(queues)) + 1).cast("int"),
            }
        )
        .drop("_rn")
    )


def redistribute_multiple(
    collections: DataFrame, first_job: int, last_job: int, steps: int, queues: int, per_queue: int
) -> DataFrame:
    """Round-robin over job, step and queue, at most `per_queue` rounds.

    Keys without `_` and repeats are dropped; collections beyond the last round come back
    with null job, step and queue.
    """
    jobs = last_job - first_job + 1
    slots = jobs * steps * queues
    distinct = (
        collections.where(F.col("collection").contains("_"))
        .groupBy("collection").agg(F.min("seq").alias("seq"))
    )
    numbered = number_rows(distinct, ["seq", "collection"], "_rn", start=0)
    fits = F.col("_rn") < slots * per_queue
    slot = F.pmod(F.col("_rn"), F.lit(slots))
    return numbered.select(
        "seq",
        "collection",
        F.when(fits, F.floor(slot / (steps * queues)) + first_job).cast("int").alias("job"),
        F.when(fits, F.pmod(F.floor(slot / queues), F.lit(steps)) + 1).cast("int").alias("step"),
        F.when(fits, F.pmod(slot, F.lit(queues)) + 1).cast("int").alias("queue"),
    )
