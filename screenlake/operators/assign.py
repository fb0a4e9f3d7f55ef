"""Which control file a jobline uses, and which work unit a collection belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.operators.joins import salted_join

# Widest aligned block used to cover a range: 2**16 joblines.
TOP_LEVEL = 16


def resolve_control(joblines: DataFrame, ranges: DataFrame, default: str) -> DataFrame:
    """Add `control_file`: first file by name whose range holds the jobline, else `default`.

    Every range is covered by a few aligned blocks (one equal join key each), and the first
    file per block is found before the join. A jobline then meets at most one row per block
    size, however many ranges overlap, instead of being compared with every range.
    """

    def shifted(value, level):
        return F.floor(value / F.pow(F.lit(2), level)).cast("long")

    level = F.col("level")
    covered = ranges.where("range_start <= range_end").select(
        "file",
        F.explode(F.sequence(F.lit(0), F.lit(TOP_LEVEL))).alias("level"),
        F.col("range_start").cast("long").alias("lo"),
        (F.col("range_end").cast("long") + 1).alias("hi"),
    )
    # Blocks [first, last) of this size lie fully inside the range; below the top size only
    # an odd block at either end is not part of a larger one.
    covered = covered.withColumns(
        {"first": -shifted(-F.col("lo"), level), "last": shifted(F.col("hi"), level)}
    ).where("first < last")
    ends = F.array_compact(
        F.array_distinct(
            F.array(
                F.when(F.pmod("first", F.lit(2)) == 1, F.col("first")),
                F.when(F.pmod("last", F.lit(2)) == 1, F.col("last") - 1),
            )
        )
    )
    blocks = F.when(level == TOP_LEVEL, F.sequence("first", F.col("last") - 1)).otherwise(ends)
    first_file = (
        covered.select("file", "level", F.explode(blocks).alias("block"))
        .groupBy("level", "block")
        .agg(F.min("file").alias("file"))
    )
    numbers = joblines.select("jobline").distinct()
    probes = numbers.select(
        "jobline", F.explode(F.sequence(F.lit(0), F.lit(TOP_LEVEL))).alias("level")
    ).withColumn("block", shifted(F.col("jobline"), F.col("level")))
    found = (
        probes.join(first_file, ["level", "block"]).groupBy("jobline").agg(F.min("file").alias("_file"))
    )
    return salted_join(joblines, found, ["jobline"]).select(
        *joblines.columns, F.coalesce("_file", F.lit(default)).alias("control_file")
    )


def latest_assignment(assignment: DataFrame, order: str = "seq") -> DataFrame:
    """Last assignment written per collection."""
    rest = [c for c in assignment.columns if c not in ("collection", order)]
    return (
        assignment.groupBy("collection")
        .agg(F.max(F.struct(order, *rest)).alias("s"))
        .select("collection", *(f"s.{c}" for c in rest))
    )


def with_assignment(df: DataFrame, assignment: DataFrame, order: str = "seq") -> DataFrame:
    """Add workunit, subjob and count of each row's collection; the last assignment wins."""
    return salted_join(df, latest_assignment(assignment, order), ["collection"])
