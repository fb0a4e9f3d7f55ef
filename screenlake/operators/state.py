"""Task states and the order of ligands inside a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake import fixed_values as fv
from screenlake import schemas

# Positions of a collection that are ordered together.
POSITIONS = 10_000


def latest_state(status: DataFrame) -> DataFrame:
    """Latest row per (collection, ligand, scenario, replica).

    At equal times an outcome replaces `processing`. A maximum is combined before the
    shuffle, so a task with very many entries is no hot group.
    """
    rest = [c for c in status.columns if c not in schemas.TASK_KEYS and c not in ("ts", "status")]
    newest = F.max(
        F.struct("ts", (F.col("status") != fv.PROCESSING).alias("final"), "status", *rest)
    ).alias("s")
    return (
        status.groupBy(*schemas.TASK_KEYS)
        .agg(newest)
        .select(*schemas.TASK_KEYS, "s.ts", "s.status", *(f"s.{c}" for c in rest))
    )


def next_ligand(ligands: DataFrame, pos: str = "pos") -> DataFrame:
    """Add `next_ligand` in archive order within the collection; null at the collection's end.

    A collection is cut into stretches of POSITIONS positions, so one of any size is spread over tasks. Rows meet
    their successor inside the stretch; its last row meets the first one of the next stretch there is, in a table
    with one row per stretch. Without a position a row comes first; rows without a collection have no successor.
    """
    before_all = F.lit(-(1 << 62))
    cut = ligands.withColumn("_stretch", F.coalesce(F.floor(F.col(pos) / POSITIONS).cast("long"), before_all))
    borders = cut.groupBy("collection", "_stretch").agg(F.min(F.struct(pos, "ligand")).alias("_first"))
    following = F.lead("_first.ligand").over(Window.partitionBy("collection").orderBy("_stretch"))
    borders = borders.select("collection", "_stretch", following.alias("_beyond"))
    inside = Window.partitionBy("collection", "_stretch").orderBy(pos, "ligand")
    # A position is none that the window gives: the ligand behind may be null itself.
    met = cut.withColumn("_next", F.lead(F.struct("ligand")).over(inside)).join(borders, ["collection", "_stretch"], "left")
    successor = F.when(F.col("_next").isNotNull(), F.col("_next.ligand")).otherwise(F.col("_beyond"))
    return met.select(*ligands.columns, F.when(F.col("collection").isNotNull(), successor).alias("next_ligand"))
