"""Joins against a table with one row per key that spread hot keys over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8


def salted_join(
    df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join (left, left_semi, left_anti or inner) to a table with at most one row per key.

    A key holding a large share of `df` is split over `salts` tasks by what else its rows
    hold and the partition they come from: rows of one partition are spread as well as copies
    in several ones, and a task that runs again deals its rows out as before. The lookup side,
    one row per key, is repeated once per salt.
    """
    # Maps cannot be hashed.
    rest = [F.col(f"`{n}`") for n, kind in df.dtypes if n not in on and "map<" not in kind and kind != "variant"]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*rest) + F.spark_partition_id(), F.lit(salts)) if rest
                           else F.pmod(F.spark_partition_id(), F.lit(salts)).cast("long"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
