"""Ligand archives and nested batch status files."""

from __future__ import annotations

import gzip
import posixpath
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake import schemas
from screenlake.functions.keys import metatranche_of, tranche_of
from screenlake.sources.archives import BadArchive, Entry, arrow_schema, as_entries, batches_of, entries_in, list_entries, members, read_entry, unpacked

ARCHIVE = "path STRING, content BINARY"
# Endings of JSON lists.
JSON_ENDINGS = (".json", ".json.gz")


def unpack_collections(archives: DataFrame, keep_extension: bool = False) -> DataFrame:
    """`.../<tranche>/<ID>.tar.gz` rows (path, content) or entries to one row per ligand file.

    The ligand id is the member name up to its first dot, or all of it. An archive that cannot be read
    to its end gives one row with its collection and `error`, and none of its ligands.
    """
    entries = archives if "file" in archives.columns else as_entries(archives)
    schema = "collection STRING, ligand STRING, format STRING, pos INT, content STRING, error STRING"

    arrow = arrow_schema(schema)

    def ligands_of(entry: Entry) -> Iterator[tuple]:
        folder, name = posixpath.split(entry.path)
        number = name.split(".", 1)[0]
        # An error from before is that of a whole tranche, whose archive the path names.
        collection = number if entry.error is not None else f"{posixpath.basename(folder)}_{number}"
        try:
            for pos, (member, text) in enumerate(members(entry), 1):
                base = posixpath.basename(member)
                ligand = base if keep_extension else base.split(".", 1)[0]
                ending = base.rsplit(".", 1)[1] if "." in base else ""
                yield collection, ligand, ending, pos, text.decode("utf-8", "replace"), None
        except BadArchive as exc:
            yield collection, None, None, None, None, str(exc)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of((row for entry in entries_in(batches) for row in ligands_of(entry)), arrow)

    key = F.col("collection")
    return entries.select(*Entry._fields).mapInArrow(unpack, schema).select(
        "collection",
        tranche_of(key).alias("tranche"),
        metatranche_of(key).alias("metatranche"),
        "ligand",
        "format",
        "pos",
        "content",
        "error",
    )


def read_ligands(
    spark: SparkSession, root: str, layout: str = "tranche", keep_extension: bool = False
) -> DataFrame:
    """Ligand library, one row per ligand; a broken archive is one row with `error` and no ligand.

    layout `tranche`: `<meta>/<tranche>.tar` holding `<tranche>/<ID>.tar.gz`. Only the headers of a tranche
    are read to list its collections; these are dealt to tasks anew, as ranges of the file, and each task reads
    its own: archives of any size, and one big tranche is no bottleneck. Where only Spark can open files
    (see `archives.can_seek`), they are read whole, up to 2 GB each.
    layout `collection`: `<meta>/<tranche>/<ID>.tar.gz`. Spark lists no files of zero bytes, so these give no row.
    """
    if layout == "tranche":
        inner = unpacked(list_entries(spark, root, "*.tar"), (".tar.gz", ".tgz"))
        entries = inner.repartition(F.col("path"))
    else:
        entries = list_entries(spark, root, "*.tar.gz")
    return unpack_collections(entries, keep_extension)


def _plain(name: str, inner: bytes) -> str:
    return (gzip.decompress(inner) if name.endswith(".gz") else inner).decode("utf-8", "replace")


def _archived(spark: SparkSession, folder: str, json: bool) -> DataFrame:
    """Entries of the JSON lists, or of all other files, inside `.tar` files below `folder`, dealt out anew: only
    the headers of an archive are read in one task."""
    inner = unpacked(list_entries(spark, folder, "*.tar"), below=True)
    is_json = F.col("path").rlike("|".join(f"{re.escape(e)}$" for e in JSON_ENDINGS))
    return inner.where(F.col("error").isNotNull() | (is_json if json else ~is_json)).repartition("path")


def read_archived_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(path, value): lines of the text files, gzip or not, inside `.tar` files below `folder`.

    `path` ends in the member's name; JSON lists are left to `read_archived_json`. A broken archive stops the job.
    """
    schema = "path STRING, value STRING"
    arrow = arrow_schema(schema)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(((e.path, line) for e in entries_in(batches) for line in _plain(e.path, read_entry(e)).splitlines()), arrow)

    return _archived(spark, folder, json=False).mapInArrow(unpack, schema)


def read_archived_json(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """(path, columns of `schema`): objects of the JSON lists, gzip or not, inside `.tar` files below `folder`."""
    columns = "path STRING, text STRING"
    arrow = arrow_schema(columns)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(((e.path, _plain(e.path, read_entry(e))) for e in entries_in(batches)), arrow)

    texts = _archived(spark, folder, json=True).mapInArrow(unpack, columns)
    parsed = F.from_json("text", f"ARRAY<STRUCT<{schema}>>", {"mode": "FAILFAST"})
    return texts.select("path", F.inline(parsed))


def unpack_files(archives: DataFrame) -> DataFrame:
    """`.../<ID>.tar.gz` rows (path, content) or entries to (path, text) of the files inside, as if they lay in `.../<ID>/`.

    Members that are gzip files are unpacked. A broken archive stops the job.
    """
    entries = archives if "file" in archives.columns else as_entries(archives)

    schema = "path STRING, text STRING"
    arrow = arrow_schema(schema)

    def texts_of(entry: Entry) -> Iterator[tuple[str, str]]:
        folder = entry.path.removesuffix(".tar.gz")
        for name, inner in members(entry):
            yield f"{folder}/{posixpath.basename(name)}", _plain(name, inner)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of((row for entry in entries_in(batches) for row in texts_of(entry)), arrow)

    return entries.select(*Entry._fields).mapInArrow(unpack, schema)


# -- batch status ----------------------------------------------------------------------


def _units(status: DataFrame) -> DataFrame:
    return status.select(F.explode("workunits").alias("workunit", "u")).withColumn(
        "workunit", F.col("workunit").try_cast("int")
    )


def _subjobs(status: DataFrame) -> DataFrame:
    return _units(status).select("workunit", F.explode("u.subjobs").alias("subjob", "s")).withColumn(
        "subjob", F.col("subjob").try_cast("int")
    )


def _workunit_table(status: DataFrame) -> DataFrame:
    return _units(status).where("u.status IS NOT NULL").select(
        "workunit",
        F.col("u.status.job_id").alias("job_id"),
        F.col("u.status.aws_batch_status").alias("status"),
    )


def _subjob_table(status: DataFrame) -> DataFrame:
    collections = F.transform(
        "s.collections", lambda c: F.struct(c[0].alias("collection"), c[1].try_cast("int").alias("n_ligands"))
    )
    return _subjobs(status).select(
        "workunit",
        "subjob",
        F.col("s.status").alias("status"),
        F.col("s.detailed_status.container.vcpus").alias("vcpus"),
        collections.alias("collections"),
    ).withColumn(
        "n_ligands",
        F.aggregate("collections", F.lit(0).cast("long"), lambda a, c: a + F.coalesce(c["n_ligands"], F.lit(0))),
    )


def _attempt_table(status: DataFrame) -> DataFrame:
    return _subjobs(status).select(
        "workunit", "subjob", F.posexplode("s.detailed_status.attempts").alias("attempt_no", "a")
    ).select(
        "workunit",
        "subjob",
        "attempt_no",
        F.col("a.startedAt").alias("started_at"),
        F.col("a.stoppedAt").alias("stopped_at"),
        F.col("a.statusReason").alias("reason"),
    )


# Each table and the fields it is made of.
BATCH_TABLES = {
    "workunit": (_workunit_table, schemas.BATCH_WORKUNIT_JSON),
    "subjob": (_subjob_table, schemas.BATCH_SUBJOB_JSON),
    "attempt": (_attempt_table, schemas.BATCH_ATTEMPT_JSON),
}


def batch_tables(status: DataFrame) -> dict[str, DataFrame]:
    """workunit, subjob and attempt tables of nested status rows (one `workunits` map each)."""
    return {name: make(status) for name, (make, _) in BATCH_TABLES.items()}


def read_batch_status(spark: SparkSession, path: str, multiline: bool = True) -> dict[str, DataFrame]:
    """Tables of nested status files; `multiline=False` reads one JSON object per line in parallel."""
    if multiline:
        return batch_tables(spark.read.schema(schemas.BATCH_STATUS_JSON).json(path, multiLine=True))
    # The JSON source keeps the keys of all lines in a table of names, which costs the more the more work units there are; from_json
    # takes such keys at a third of the time. Like the source, it takes lists of objects, and lines with broken characters are left out.
    # An object in place of a text comes without the blanks between its parts.
    line = F.when(F.is_valid_utf8("value"), F.col("value"))
    lines = spark.read.text(path)
    return {
        name: make(lines.select(F.inline(F.from_json(line, f"ARRAY<STRUCT<{fields}>>")))) for name, (make, fields) in BATCH_TABLES.items()
    }
