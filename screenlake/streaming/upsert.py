"""A table that streams update: one row per key, whatever the number of batches.

A batch becomes a run, a folder with the rows it changed. Runs are merged like in a log-structured tree: the
newest ones together, once the run before them is no more than twice as large, so there are about as many runs
as doublings of the table, and a row is rewritten about as often. A snapshot names the runs and the last
batch in them; a batch that comes again is known by its number and changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.sources import snapshots

BATCH = "batch_id"
# A run is merged with those after it when it has at most so many times their rows.
RATIO = 2


@dataclass(frozen=True)
class Rules:
    """How rows of one key become one: the greatest by `newest` stays; of the columns `least` the minimum.

    `newest` are SQL expressions; the batch number decides what they leave open.
    """

    keys: tuple[str, ...]
    newest: tuple[str, ...] = ()
    least: tuple[str, ...] = ()

    def fold(self, rows: DataFrame) -> DataFrame:
        order = F.struct(*(F.expr(e).alias(f"o{i}") for i, e in enumerate(self.newest)), BATCH)
        rest = [c for c in rows.columns if c not in (*self.keys, *self.least)]
        least: list[Column] = [F.min(c).alias(c) for c in self.least]
        folded = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), order).alias("_s"), *least)
        return folded.select(*(c if c in (*self.keys, *self.least) else f"_s.{c}" for c in rows.columns))


def _used(content: dict) -> list[str]:
    return [run["folder"] for run in content.get("runs", [])]


def _runs(spark: SparkSession, root: str, runs: list[dict], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*(f"{root}/{run['folder']}" for run in runs))


def upsert(batch: DataFrame, batch_id: int, root: str, rules: Rules) -> None:
    """Take the rows of a batch into the table; a batch that is in it already is left out."""
    spark = batch.sparkSession
    version, content = snapshots.current(spark, root)
    if batch_id <= content.get("through", -1):
        return
    rows = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def written(df: DataFrame) -> dict:
        folder = snapshots.new_folder(root)
        df.write.parquet(f"{root}/{folder}")
        return {"folder": folder, "rows": spark.read.schema(schema).parquet(f"{root}/{folder}").count()}

    runs = [*content.get("runs", []), written(rules.fold(rows))]
    merged = 1
    while merged < len(runs) and runs[-merged - 1]["rows"] <= RATIO * sum(r["rows"] for r in runs[-merged:]):
        merged += 1
    if merged > 1:
        runs = [*runs[:-merged], written(rules.fold(_runs(spark, root, runs[-merged:], schema)))]
    snapshots.commit(spark, root, version + 1, {"through": batch_id, "runs": [r for r in runs if r["rows"]], "schema": schema})
    snapshots.clean(spark, root, _used)


def read_upserted(spark: SparkSession, root: str, rules: Rules) -> DataFrame:
    """One row per key as of the newest snapshot."""
    _, content = snapshots.current(spark, root)
    if not content:
        raise ValueError(f"{root} has no snapshot: no batch has been written yet")
    if not content["runs"]:
        return spark.createDataFrame([], content["schema"]).drop(BATCH)
    return rules.fold(_runs(spark, root, content["runs"], content["schema"])).drop(BATCH)

