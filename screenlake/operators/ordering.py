"""Row numbers and running totals over a whole table, without one-task windows.

Rows are range-partitioned by the order, checkpointed (so the partition of a row cannot
change between jobs), numbered inside each partition and shifted by the totals of the
partitions before. Only one total per partition reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.session import stable

PART, ROW = "_part", "_row"


def _columns(order_by: Sequence[str | Column] | str) -> list[Column]:
    given = [order_by] if isinstance(order_by, str | Column) else list(order_by)
    return [F.col(c) if isinstance(c, str) else c for c in given]


def ordered_parts(df: DataFrame, order_by: Sequence[str | Column] | str) -> DataFrame:
    """Globally sorted rows with stable partition number `_part` and position `_row` (0-based)."""
    order = _columns(order_by)
    tagged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    return (
        stable(tagged)
        .withColumn(PART, F.shiftright("_id", 33).cast("int"))
        .withColumn(ROW, F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id")
    )


def part_offsets(parts: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """`_part` and, per name, the sum of that total over all earlier partitions.

    One row per partition, so the table is as small as the list of partitions.
    """
    spark = parts.sparkSession
    sums = parts.groupBy(PART).agg(*(F.coalesce(t.cast("long"), F.lit(0)).alias(n) for n, t in totals.items()))
    rows = sorted(sums.collect(), key=lambda r: r[PART])
    before = [[0, *accumulate(r[n] for r in rows)][: len(rows)] for n in totals]
    shifted = list(zip((r[PART] for r in rows), *before))
    schema = ", ".join([f"{PART} INT", *(f"{n} LONG" for n in totals)])
    return F.broadcast(spark.createDataFrame(shifted, schema))


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column] | str, col: str = "rn", start: int = 1
) -> DataFrame:
    """Dense position of every row in the order, from `start`."""
    parts = ordered_parts(df, order_by)
    offsets = part_offsets(parts, {"_before": F.count(F.lit(1))})
    number = F.col("_before") + F.col(ROW) + F.lit(start)
    return parts.join(offsets, PART).withColumn(col, number).drop("_before", PART, ROW)


def running_totals(
    df: DataFrame, order_by: Sequence[str | Column] | str, value: str, col: str = "p", number: str = "rn"
) -> DataFrame:
    """Position from 1 and running total of `value` (null: 0), this row included.

    Rows are shuffled once, by the order. Each partition then adds up its own rows, batch by batch, from
    where the partitions before it end.
    """
    parts = ordered_parts(df.withColumn("_value", F.coalesce(F.col(value).cast("long"), F.lit(0))), order_by)
    sums = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("rows"), F.sum("_value").alias("sum")).collect()
    before, rows, total = {}, 0, 0
    for r in sorted(sums, key=lambda r: r[PART]):
        before[r[PART]] = (rows, total)
        rows, total = rows + r["rows"], total + r["sum"]
    schema = df.select("*", F.lit(0).cast("long").alias(number), F.lit(0).cast("long").alias(col)).schema
    names = df.columns

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if at is None:
                at = before[batch.column(batch.schema.get_field_index(PART))[0].as_py()]
            own = batch.column(batch.schema.get_field_index("_value"))
            sums_here = pc.add(pc.cumulative_sum(own), at[1])
            numbers = pa.array(range(at[0] + 1, at[0] + batch.num_rows + 1), pa.int64())
            at = (at[0] + batch.num_rows, sums_here[-1].as_py())
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, numbers, sums_here], [*names, number, col])

    return parts.mapInArrow(add_up, schema)
