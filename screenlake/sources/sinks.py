"""Writers. Rows are rebalanced by their folder, so hot folders are split over tasks."""

from __future__ import annotations

import gzip
import itertools
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake import fixed_values as fv
from screenlake.functions.keys import with_collection_parts
from screenlake.functions.scores import one_place
from screenlake.operators.joins import salted_join
from screenlake.session import stable
from screenlake.sources import archives

# Summary lines that are compressed together.
LINES_AT_ONCE = 1000
TREE = ["state", "scenario", "metatranche", "tranche"]


def _rebalanced(df: DataFrame, folders: list[str]) -> DataFrame:
    """Rows of a folder together, unless the folder is so large that it is split."""
    return df.hint("rebalance", *(F.col(f) for f in folders))


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def write_results(df: DataFrame, root: str, level: str = "collection") -> None:
    """Results below `state / scenario / metatranche / tranche [/ collection]` as Parquet.

    Collections in `df` replace their earlier rows; all others stay. At level
    `tranche` several collections share a folder, so the folders touched are read, merged
    and written again. Incomplete rows of a collection that is complete by now are left
    out by `read_results`.
    """
    folders = TREE + (["collection"] if level == "collection" else [])
    rows = with_collection_parts(df).drop("collection_id")
    if level == "tranche" and exists(df.sparkSession, root):
        old = df.sparkSession.read.parquet(root).select(*rows.columns)
        touched = rows.select(*TREE).distinct()
        replaced = rows.select("state", "scenario", "collection").distinct()
        kept = salted_join(old, touched, TREE, "left_semi")
        kept = salted_join(kept, replaced, ["state", "scenario", "collection"], "left_anti")
        rows = rows.unionByName(stable(kept))
    (
        _rebalanced(rows, folders)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders).parquet(root)
    )


def read_results(spark: SparkSession, root: str) -> DataFrame:
    """Results of a tree; where a collection is complete, its incomplete rows are left out."""
    rows = spark.read.parquet(root)
    keys = ["scenario", "collection"]
    complete = rows.where(F.col("state") == "complete")
    still_open = salted_join(
        rows.where(F.col("state") == "incomplete"), complete.select(*keys).distinct(), keys, "left_anti"
    )
    return complete.unionByName(still_open)


def summary_header(max_replicas: int, smiles: bool) -> str:
    titles = [t for t in fv.SUMMARY_TITLES if smiles or t != "SMILES"]
    titles += [f"{fv.SUMMARY_REPLICA_TITLE}{k}" for k in range(1, max_replicas + 1)]
    return "   ".join(titles)


def summary_lines(summary: DataFrame) -> DataFrame:
    """Fixed-format text line per ligand; scores are rounded to one place here only.

    A null in `scores` is printed as a marker, so that those after it keep their column.
    """
    smiles = [F.col("smiles")] if "smiles" in summary.columns else []
    line = F.concat_ws(
        " ",
        "collection",
        "ligand",
        *smiles,
        one_place(F.col("avg_score")),
        one_place(F.col("best_score")),
        F.format_string("%5d", "n_dockings"),
        F.array_join(F.transform("scores", one_place), " ", fv.NO_SCORE),
    )
    return summary.withColumn("line", line)


def _escaped(value: str | None) -> str:
    """A value as Spark writes it in the name of a partition folder."""
    return re.sub(r'[\x01-\x1f"#%\'*/:=?\\\x7f{\[\]^]', lambda m: f"%{ord(m[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__"


def write_summary_text(summary: DataFrame, root: str, max_replicas: int, state: str = "complete") -> None:
    """gzip text below `<root>/state=.../scenario=.../metatranche=.../tranche=.../`, a file per collection.

    Collections in `summary` replace their earlier text of the same state; all others stay. A column
    `state` counts instead of the argument. A file has the header and its lines in order. Tasks write the files
    themselves, line by line, so neither the driver nor a commit handles collections one after the other.
    """
    spark = summary.sparkSession
    if not archives.can_seek(spark, root):
        raise ValueError(f"tasks cannot write files below {root}")
    folders = ["state", "scenario", "metatranche", "tranche", "collection"]
    keyed = with_collection_parts(summary_lines(summary))
    keyed = keyed if "state" in summary.columns else keyed.withColumn("state", F.lit(state))
    header, whole = summary_header(max_replicas, "smiles" in summary.columns), archives.qualified(spark, root)

    def write(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
        folder = "/".join(f"{name}={_escaped(value)}" for name, value in zip(folders[:-1], key))
        with archives.written(f"{whole}/{folder}/part-{_escaped(key[-1])}.txt.gz") as file:
            with gzip.GzipFile("", "wb", archives.GZIP_LEVEL, file, 0) as out:
                out.write(f"{header}\n".encode())
                for lines in iter(lambda: "".join(f"{row[-1]}\n" for row in itertools.islice(rows, LINES_AT_ONCE)), ""):
                    out.write(lines.encode())
        yield (1,)

    store, where = archives.file_system(whole)
    store.create_dir(where, recursive=True)
    named = keyed.select(*folders, "line").withColumns({f: F.col(f).cast("string") for f in folders})
    archives.per_group(named, folders, ["line"], write, "n LONG").agg(F.sum("n")).collect()


def status_objects(status: DataFrame) -> DataFrame:
    """Status rows under the field names of the JSON lists."""
    return status.select(
        "collection",
        "ligand",
        F.col("scenario").alias("scenario_key"),
        F.col("replica").alias("replica_index"),
        "status",
        "info",
        F.format_string("%.2f", "seconds").alias("seconds"),
        "score",
        *([F.col("ts").cast("string").alias("ts")] if "ts" in status.columns else []),
    )


def status_lines(status: DataFrame) -> DataFrame:
    element = F.regexp_extract("info", r"elements: (\S+)", 1)
    removed = F.when(element != "", F.concat(F.lit(fv.FAILED_ELEMENTS), element, F.lit(")"))).otherwise(
        fv.FAILED_COORDINATES
    )
    time = F.concat(F.lit("total-time:"), F.round(F.col("seconds") * 1000).cast("long").cast("string"))
    docked = F.concat_ws(" ", "ligand", "scenario", F.col("replica").cast("string"), "status", time)
    line = F.when(F.col("scenario").isNull(), F.concat_ws(" ", "ligand", removed)).otherwise(docked)
    return status.select("collection", line.alias("line"))


def write_status(status: DataFrame, path: str, fmt: str = "json", replace: bool = False) -> None:
    """Status lists per collection, gzip: JSON objects line by line, or text lines.

    New files are added to those already below `path`; with `replace` the lists of the collections
    in `status` are written anew and those of others stay.
    """
    rows = status_objects(status) if fmt == "json" else status_lines(status)
    writer = _rebalanced(rows, ["collection"]).write.mode("overwrite" if replace else "append")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("collection").option("compression", "gzip")
    writer.json(path) if fmt == "json" else writer.text(path)


def write_worklists(df: DataFrame, root: str, folders: list[str] | None = None) -> None:
    """`<collection> <count>` lines below one folder per work unit and subjob (or queue).

    Lines keep the order of `seq`, where there is one; new files are added to a folder's old ones.
    """
    folders = folders or ["workunit", "subjob"]
    line = F.concat_ws(" ", "collection", F.col("n_ligands").cast("string"))
    order = ["seq"] if "seq" in df.columns else []
    rows = _rebalanced(df.select(*folders, *order, line.alias("line")), folders)
    rows = rows.sortWithinPartitions(*folders, *order, "line").select(*folders, "line")
    rows.write.mode("append").partitionBy(*folders).text(root)
