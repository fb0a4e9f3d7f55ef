"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The white space of words and lines (space and U+0009 to U+000D).
WHITE_SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
# Ids of null sort after all others.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def id_of(column: str = "doc_id") -> Column:
    """The id, null as LAST_ID: never null, so that it also passes through pandas unharmed."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def id_back(column: str) -> Column:
    """The id that id_of() stands for."""
    return F.when(F.col(column) != LAST_ID, F.col(column))


def give_back() -> None:
    """Return what this worker has freed to the system; what it holds is kept."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Callable[..., Iterator[pd.DataFrame]], *given: object) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """`work(frames, *given)` for mapInPandas. A worker outlives its task and waits, beside the other tasks of its
    executor, for the next one: it gives back first what the task has used."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from work(frames, *given)
        finally:
            give_back()

    return run


def whole_row(docs: DataFrame, *without: str) -> Column:
    """All columns but `without` as one struct, so that working columns cannot clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in without))


def group_key(column: str) -> Column:
    """A string key that is never null: a null value is a group of its own."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), value))


def rank_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, out: str = "rank"
) -> DataFrame:
    """Add the position (from 0) of each row in its group, in a seeded order of the columns `order`.

    A group is dealt into about sqrt(rows) buckets by the hash of `order`; rows are numbered inside
    a bucket, buckets by running counts. No task holds more than about sqrt(rows) rows of one group,
    whatever share of the table the group has. `order` has to tell rows apart.
    """
    spread = df.withColumn("_hash", F.xxhash64(*order)).withColumn(
        "_bucket", F.pmod("_hash", F.lit(max(1, isqrt(rows)))).cast("int")
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        spread.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_hash", *order)
    return (
        spread.join(counts, [*keys, "_bucket"])
        .withColumn(out, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_hash", "_bucket", "_before")
    )
