"""Control files, manifests, done lists, docking logs, summaries and ligand status lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake import fixed_values as fv
from screenlake import schemas
from screenlake.operators.ordering import number_rows
from screenlake.sources.archives import contents, list_entries, listed
from screenlake.sources.nested import read_archived_json, read_archived_lines, unpack_files


def _file_order() -> list[Column]:
    """Order of lines over files: file, block of the file, line inside the block.

    Long files are read in blocks by several tasks, so no task sees a whole file.
    """
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    ]


# -- control files ---------------------------------------------------------------------


def control_rows(files: DataFrame, dialect: str = "shell") -> DataFrame:
    """(file, line_no, key, value) from (file, text), one row per key.

    shell: the first line of a key wins, all white space goes, and the value ends at the next
    `=` or `#`. python: the last line wins, the value is trimmed and comments stay in it.
    """
    lines = files.select("file", F.posexplode(F.split("text", "\r?\n")).alias("pos", "line"))
    if dialect == "shell":
        # A key that starts a line right before `=`; blanks around would not be found.
        key = F.regexp_extract("line", r"^([^=\s#*][^=\s]*)=", 1)
        packed = F.regexp_replace("line", r"\s+", "")
        value = F.regexp_extract(packed, r"^[^=]*=([^=#]*)", 1)
        pick = F.min
    else:
        key = F.regexp_extract("line", r"^(.*?)\s*=", 1)
        value = F.regexp_extract("line", r"^.*?\s*=\s*(.*?)\s*$", 1)
        pick = F.max
    keyed = lines.select(
        "file", (F.col("pos") + 1).alias("line_no"), key.alias("key"), value.alias("value")
    ).where((F.col("key") != "") & F.col("key").isNotNull())
    return (
        keyed.groupBy("file", "key").agg(pick(F.struct("line_no", "value")).alias("v"))
        .select("file", "v.line_no", "key", "v.value")
    )


def read_control(spark: SparkSession, path: str, dialect: str = "shell") -> DataFrame:
    """Control files are short and their lines depend on each other: one row per file."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("text")
    )
    return control_rows(files, dialect)


# -- manifest --------------------------------------------------------------------------


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(seq, collection, n_ligands, error); blank lines dropped, file order kept in seq.

    A line without a whole number as its count has the line in `error` and no count.
    """
    lines = spark.read.text(path).select(*_file_order(), F.trim(F.regexp_replace("value", r"\s+", " ")).alias("line"))
    fields = F.split("line", " ")
    count = F.when(F.size(fields) == 2, F.get(fields, F.lit(1))).try_cast("int")
    parsed = lines.where(F.col("line") != "").select(
        "_file", "_block", "_line",
        fields[0].alias("collection"),
        count.alias("n_ligands"),
        F.when(count.isNull(), F.col("line")).alias("error"),
    )
    return number_rows(parsed, ["_file", "_block", "_line"], "seq").select(
        "seq", "collection", "n_ligands", "error"
    )


# -- done lists ------------------------------------------------------------------------


def done_rows(lines: DataFrame, col: str = "value") -> DataFrame:
    """The collection, its queue and six counters from free text; a missing counter is null."""
    text = F.col(col)
    counters = {
        name.lower().replace("-", "_"): F.regexp_extract(text, name + r":([0-9]+)", 1).try_cast("long")
        for name in fv.DONE_COUNTERS
    }
    return lines.select(
        F.regexp_extract(text, r"^\s*(\S+)", 1).alias("collection"),
        F.nullif(F.regexp_extract(text, r"by queue (\S+)", 1), F.lit("")).alias("queue"),
        *(c.alias(n) for n, c in counters.items()),
    ).where(F.col("collection") != "")


def read_done(spark: SparkSession, path: str) -> DataFrame:
    return done_rows(spark.read.option("recursiveFileLookup", "true").text(path))


# -- docking logs ----------------------------------------------------------------------


def log_rows(files: DataFrame, replica_base: int = 1) -> DataFrame:
    """Logs with keys from the path `.../<scenario>/logfiles/<meta>/<tranche>/<ID>/<ligand>_replica-<n>`.

    `replica_base` is the number of the first replica in the file names.
    """
    # The path is searched once: only from the start of each folder, whose name is not given back letter by letter.
    found = F.regexp_extract("path", r"(?<![^/])[^/]++/logfiles/[^/]++/[^/]++/[^/]++/.+_replica-[0-9]+[^/]*$", 0)
    rows = files.select(F.split(found, "/", 6).alias("_parts"), F.col("text").alias("log"))
    part = lambda n: F.when(F.col("_parts").isNotNull(), F.coalesce(F.get("_parts", F.lit(n)), F.lit("")))
    name = lambda n: F.regexp_extract(part(5), r"^(.+)_replica-([0-9]+)[^/]*$", n)
    return rows.select(
        F.concat_ws("_", part(3), part(4)).alias("collection"),
        name(1).alias("ligand"),
        part(0).alias("scenario"),
        (name(2).try_cast("int") - replica_base + 1).alias("replica"),
        "log",
    )


def read_logs(spark: SparkSession, root: str, replica_base: int = 1, archived: bool = False) -> DataFrame:
    """Logs of a tree: loose files, or with `archived` the members of `<ID>.tar.gz` archives, in which
    finished collections publish them. Loose files are listed and read by tasks; only where tasks cannot open them, by Spark,
    whose driver keeps the name of each."""
    loose = "*_replica-*"
    if archived:
        files = unpack_files(list_entries(spark, root, "*.tar.gz"))
    elif (found := listed(spark, root, loose)) is not None:
        files = contents(found).select("path", F.col("content").cast("string").alias("text"))
    else:
        files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", loose).text(root, wholetext=True).select(
            F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
        )
    return log_rows(files, replica_base)


# -- summaries -------------------------------------------------------------------------


def summary_rows(lines: DataFrame, col: str = "value") -> DataFrame:
    """Summary lines of both layouts, with or without a SMILES column.

    The average follows the ligand in one layout and the SMILES in the other; a SMILES is
    never a number, so the third field tells them apart line by line. Best and worst come
    from the replica scores, as the layouts disagree about what `maximum-score` is.
    """
    cols = [c for c in lines.columns if c != col]
    has_smiles = F.get(F.col("_f"), F.lit(2)).try_cast("double").isNull()
    shift = F.when(F.col("_smiles"), 1).otherwise(0)

    def field(i: int) -> Column:
        return F.get(F.col("_f"), shift + i).try_cast("double")

    scores = F.transform(
        F.slice("_f", shift + 6, F.greatest(F.size("_f") - shift - 5, F.lit(0))), lambda s: s.try_cast("double")
    )
    known = F.filter("scores", lambda s: s.isNotNull())
    return (
        lines.where(~F.col(col).contains("average-score") & (F.trim(col) != ""))
        .withColumn("_f", F.split(F.trim(F.regexp_replace(col, r"\s+", " ")), " "))
        .withColumn("_smiles", has_smiles)
        .withColumn("scores", scores)
        .select(
            *cols,
            F.get("_f", F.lit(0)).alias("collection"),
            F.get("_f", F.lit(1)).alias("ligand"),
            F.when(F.col("_smiles"), F.get("_f", F.lit(2))).alias("smiles"),
            field(2).alias("avg_score"),
            F.coalesce(F.array_min(known), field(3)).alias("best_score"),
            F.coalesce(F.array_max(known), field(3)).alias("worst_score"),
            field(4).cast("int").alias("n_dockings"),
            "scores",
        )
    )


def read_summaries(
    spark: SparkSession, root: str, scenario: str | None = None, layout: str = "collection"
) -> DataFrame:
    """Summaries of complete and incomplete collections with their state and scenario.

    layout `collection`: `<root>/<state>/<scenario>/summaries/<meta>/<tranche>/<ID>.txt[.gz]`;
    `tranche`: the complete ones are `.../summaries/<meta>/<tranche>.tar` of such files;
    `table`: folders written by `write_summary_text`, where a scenario is a partition.
    """
    if layout == "table":
        lines = spark.read.text(root).select("state", "scenario", "value")
        return summary_rows(lines.where(F.col("scenario") == scenario) if scenario else lines)
    folder = f"{root}/*/{scenario or '*'}/summaries"
    plain = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt*").text(folder)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    if layout == "tranche":
        plain = plain.unionAll(read_archived_lines(spark, folder))
    keys = r"/([^/]+)/([^/]+)/summaries/"
    return summary_rows(
        plain.select(
            F.regexp_extract("path", keys, 1).alias("state"),
            F.regexp_extract("path", keys, 2).alias("scenario"),
            "value",
        )
    )


# -- ligand status lists ---------------------------------------------------------------

_STATUS_COLUMNS = ("collection", "ligand", "scenario", "replica", "status", "info", "seconds", "score")


def collection_from(path: Column) -> Column:
    """`.../<tranche>/<ID>.status.gz` or `.../collection=<key>/part-...`."""
    tree = F.regexp_extract(path, r"/([^/]+)/([^/.]+)\.(?:status|json)[^/]*$", 1)
    number = F.regexp_extract(path, r"/([^/]+)/([^/.]+)\.(?:status|json)[^/]*$", 2)
    column = F.regexp_extract(path, r"/collection=([^/]+)/", 1)
    return F.when(column != "", F.url_decode(column)).when(tree != "", F.concat_ws("_", tree, number))


def status_text_rows(lines: DataFrame, unit: str = "ms", replica_base: int = 1) -> DataFrame:
    """`<ligand> [<scenario> <replica>] <status> [total-time:<t>]`; a removed ligand has no scenario."""
    text = F.col("value")
    docked = r"^(\S+) (\S+) ([0-9]+) (.*?)(?: total-time:([0-9.]+))?\s*$"
    removed = r"^(\S+) (failed\(ligand_.*)$"
    is_removed = text.rlike(removed)
    element = F.regexp_extract(text, re.escape(fv.FAILED_ELEMENTS) + r"\s*(\S+?)\s*\)", 1)
    seconds = F.regexp_extract(text, docked, 5).try_cast("double")
    return lines.where(F.trim(text) != "").select(
        "collection",
        F.regexp_extract(text, r"^(\S+)", 1).alias("ligand"),
        F.when(~is_removed, F.regexp_extract(text, docked, 2)).alias("scenario"),
        F.when(~is_removed, F.regexp_extract(text, docked, 3).try_cast("int") - replica_base + 1).alias("replica"),
        F.when(is_removed, fv.FAILED).otherwise(F.regexp_extract(text, docked, 4)).alias("status"),
        F.when(is_removed & (element != ""), F.concat(F.lit(fv.ELEMENTS_INFO), element))
        .when(is_removed, fv.COORDINATES_INFO)
        .alias("info"),
        (seconds / 1000 if unit == "ms" else seconds).alias("seconds"),
        F.lit(None).cast("double").alias("score"),
    )


# Number of the first replica in lists of each format.
_FIRST_REPLICA = {"text": 1, "jsonl": 1, "json": 0}


def read_status(
    spark: SparkSession, path: str, fmt: str = "json", unit: str = "ms", replica_base: int | None = None,
    scenario_rows: DataFrame | None = None, archived: bool = False,
) -> DataFrame:
    """Ligand status lists as one schema.

    fmt: `text` lines, `json` (one list per file, as jobs publish it, replicas from 0) or `jsonl`
    (one object per line, read in parallel blocks). `replica_base` overrides the first replica's
    number. Text lists have the number of a scenario; with `scenario_rows` (idx, name), the entries of
    one control file, it becomes the name. `archived` reads the lists, text or JSON, inside tranche archives.
    """
    base = _FIRST_REPLICA[fmt] if replica_base is None else replica_base
    keys = collection_from(F.col("_metadata.file_path")).alias("collection")
    reader = spark.read.option("recursiveFileLookup", "true")
    if fmt == "text":
        if archived:
            lines = read_archived_lines(spark, path).select(collection_from(F.col("path")).alias("collection"), "value")
        else:
            lines = reader.text(path).select(keys, "value")
        rows = status_text_rows(lines, unit, base).withColumn("ts", F.lit(None).cast("timestamp"))
    elif archived:
        objects = read_archived_json(spark, path, schemas.STATUS_JSON)
        rows = status_json_rows(objects.select(collection_from(F.col("path")).alias("collection"), "*"), base)
    else:
        rows = status_json_rows(reader.schema(schemas.STATUS_JSON).json(path, multiLine=fmt == "json").select(keys, "*"), base)
    if scenario_rows is not None:
        names = scenario_rows.select(F.col("idx").cast("string").alias("scenario"), F.col("name").alias("_name"))
        rows = rows.join(F.broadcast(names), "scenario", "left").withColumn("scenario", F.coalesce("_name", "scenario"))
    return rows.select(*_STATUS_COLUMNS, "ts")


def status_json_rows(objects: DataFrame, replica_base: int = 1) -> DataFrame:
    return objects.select(
        "collection",
        "ligand",
        F.col("scenario_key").alias("scenario"),
        (F.col("replica_index") - replica_base + 1).alias("replica"),
        "status",
        "info",
        F.col("seconds").try_cast("double").alias("seconds"),
        "score",
        (F.col("ts") if "ts" in objects.columns else F.lit(None)).try_cast("timestamp").alias("ts"),
    )
