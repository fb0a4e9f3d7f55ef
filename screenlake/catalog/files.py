"""Files written from the sample tables and read back."""

from __future__ import annotations

import gzip
import io
import tarfile

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from screenlake.adapters import table
from screenlake.catalog.checks import TASK_SQL, dockings
from screenlake.catalog.registry import query
from screenlake.operators import summary
from screenlake.session import shared_path
from screenlake.sources import archives, nested, sinks, text

CONTROL_TEXT = (
    r"concat('*** options ***\njob_letter=t # note\n# Example: a=9\na=1\n b = x  y \n\n"
    r"docking_scenario_names=', s_name, ':second\nenergy_max = 10000 # note\nlimit= 5', CAST(s_nationkey AS STRING), ' =7\na=2\n')"
)


def _control_files(spark, d):
    return spark.read.parquet(f"{d}/supplier.parquet").selectExpr(
        "CAST(s_suppkey AS STRING) AS file", f"{CONTROL_TEXT} AS text"
    )


SHELL_SQL = """SELECT CAST(s_suppkey AS STRING) AS file, v.line_no, v.key, CASE v.key WHEN 'docking_scenario_names' THEN 'Supplier' WHEN 'limit' THEN concat('5', CAST(s_nationkey AS STRING)) ELSE v.value END AS value
       FROM supplier, (VALUES (2, 'job_letter', 't'), (4, 'a', '1'), (7, 'docking_scenario_names', ''), (9, 'limit', '')) AS v(line_no, key, value)"""
PYTHON_SQL = """SELECT CAST(s_suppkey AS STRING) AS file, v.line_no, v.key, CASE v.key WHEN 'docking_scenario_names' THEN concat(s_name, ':second') WHEN 'limit' THEN concat('5', CAST(s_nationkey AS STRING), ' =7') ELSE v.value END AS value
       FROM supplier, (VALUES (2, 'job_letter', 't # note'), (3, '# Example: a', '9'), (10, 'a', '2'), (5, ' b', 'x  y'), (7, 'docking_scenario_names', ''), (8, 'energy_max', '10000 # note'), (9, 'limit', '')) AS v(line_no, key, value)"""


@query("s1_control_shell", SHELL_SQL)
def s1_control_shell(spark, d):
    return text.control_rows(_control_files(spark, d), "shell")


@query("s1_control_python", PYTHON_SQL)
def s1_control_python(spark, d):
    return text.control_rows(_control_files(spark, d), "python")


def _control_folder(spark, d):
    """The same control files as files of a folder."""
    root = shared_path(spark, "control")
    archives.write_files(_control_files(spark, d).select(F.col("file").alias("path"), F.col("text").alias("content")), root)
    return root


@query("s1_read_control_shell", SHELL_SQL)
def s1_read_control_shell(spark, d):
    return text.read_control(spark, _control_folder(spark, d), "shell")


@query("s1_read_control_python", PYTHON_SQL)
def s1_read_control_python(spark, d):
    return text.read_control(spark, _control_folder(spark, d), "python")


@query(
    "s2_manifest",
    """SELECT row_number() OVER (ORDER BY p_partkey) AS seq, m.collection, CASE WHEN p_brand <> 'Brand#13' THEN m.n_ligands END AS n_ligands,
              CASE WHEN p_brand = 'Brand#13' THEN concat(m.collection, ' n/a') END AS error
       FROM part JOIN @manifest AS m ON m.seq = p_partkey""",
)
def s2_manifest(spark, d):
    rows = table(spark, d, "manifest")
    bad = F.col("collection").substr(3, 4) == "0013"
    count = F.when(bad, "n/a").otherwise(F.col("n_ligands").cast("string"))
    # A blank line follows every collection with an odd count.
    end = F.when(F.col("n_ligands") % 2 == 1, F.lit("\n  ")).otherwise("")
    path = shared_path(spark, "manifest")
    rows.orderBy("seq").select(F.concat("collection", F.lit("   "), count, end)).write.text(path)
    return text.read_manifest(spark, path)


def _pack(frames):
    """One archive per collection and frame of rows."""
    for frame in frames:
        out = []
        for collection, rows in frame.groupby("collection"):
            tranche, number = collection.split("_", 1)
            buffer = io.BytesIO()
            with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
                for ligand, content in zip(rows["ligand"], rows["content"]):
                    info = tarfile.TarInfo(f"{number}/{ligand}.pdbqt")
                    data = content.encode()
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
            out.append((f"/{tranche[:2]}/{tranche}/{number}.tar.gz", buffer.getvalue()))
        yield pd.DataFrame(out, columns=["path", "content"])


@query(
    "s3_ligand_archives",
    """SELECT collection, string_split(collection, '_')[1] AS tranche, substr(collection, 1, 2) AS metatranche, ligand, 'pdbqt' AS format,
              length(content) AS n_chars, md5(content) AS digest FROM @ligand""",
)
def s3_ligand_archives(spark, d):
    archives = table(spark, d, "ligand").mapInPandas(_pack, nested.ARCHIVE)
    out = nested.unpack_collections(archives)
    return out.select(
        "collection", "tranche", "metatranche", "ligand", "format",
        F.length("content").cast("long").alias("n_chars"), F.md5("content").alias("digest"),
    )


@query(
    "s3_bad_archives",
    """SELECT collection, count(*) FILTER (NOT broken) AS n_ligands, CAST(max(CASE WHEN broken THEN 1 ELSE 0 END) AS BIGINT) AS n_errors
       FROM (SELECT *, collection LIKE 'DE%' OR collection LIKE '%1' AS broken FROM @ligand) AS l GROUP BY 1""",
)
def s3_bad_archives(spark, d):
    one_each = table(spark, d, "ligand").groupBy("collection").applyInPandas(lambda rows: next(_pack([rows])), nested.ARCHIVE)
    # Some archives are cut in the middle, some are no archives at all.
    cut = F.expr("substring(content, 1, length(content) div 2)")
    content = F.when(F.col("path").rlike("/DE[^/]*/"), cut).when(F.col("path").rlike("1.tar.gz$"), F.lit(b"no archive")).otherwise(F.col("content"))
    out = nested.unpack_collections(one_each.withColumn("content", content))
    return out.groupBy("collection").agg(F.count("ligand").alias("n_ligands"), F.count("error").alias("n_errors"))


LIBRARY_SQL = """SELECT collection, string_split(collection, '_')[1] AS tranche, ligand, length(content) AS n_chars, md5(content) AS digest,
                CAST(row_number() OVER (PARTITION BY collection ORDER BY ligand) AS INT) AS pos FROM @ligand"""


def _library(spark, d, layout):
    """The sample ligands as a library in the shared folder."""
    in_order = Window.partitionBy("collection").orderBy("ligand")
    rows = table(spark, d, "ligand").select("collection", "ligand", "content", F.lit("pdbqt").alias("format"))
    root = shared_path(spark, f"library-{layout}")
    archives.write_library(rows.withColumn("pos", F.row_number().over(in_order).cast("int")), root, layout)
    return root


def _library_rows(ligands):
    return ligands.select("collection", "tranche", "ligand", F.length("content").cast("long").alias("n_chars"), F.md5("content").alias("digest"), "pos")


@query("s3_read_tranches", LIBRARY_SQL)
def s3_read_tranches(spark, d):
    return _library_rows(nested.read_ligands(spark, _library(spark, d, "tranche")))


@query("s3_read_collections", LIBRARY_SQL)
def s3_read_collections(spark, d):
    return _library_rows(nested.read_ligands(spark, _library(spark, d, "collection"), "collection"))


@query(
    "s3_cut_tranches",
    """SELECT string_split(collection, '_')[1] AS tranche, CASE WHEN collection LIKE 'E%' THEN 0 ELSE count(*) END AS n_ligands,
              CASE WHEN collection LIKE 'E%' THEN 1 ELSE 0 END AS n_errors FROM @ligand GROUP BY 1, collection LIKE 'E%'""",
)
def s3_cut_tranches(spark, d):
    root, cut = _library(spark, d, "tranche"), shared_path(spark, "library-cut")
    counted = archives.arrow_schema("n LONG")

    def copy(batches):
        n = 0
        for entry in archives.entries_in(batches):
            meta, name = entry.path.rsplit("/", 2)[1:]
            with archives.opened(entry) as (file, _):
                members = archives.index(file)
                # Tranches that begin with E are cut where their last archive begins: all others in it are whole.
                left = members[-1].offset - 512 if name.startswith("E") else entry.size
                file.seek(0)
                with archives.written(f"{cut}/{meta}/{name}") as out:
                    while left > 0 and (block := file.read(min(left, 1 << 20))):
                        out.write(block)
                        left -= len(block)
            n += 1
        return archives.batches_of([(n,)], counted)

    archives.list_entries(spark, root, "*.tar").mapInArrow(copy, "n LONG").collect()
    return nested.read_ligands(spark, cut).groupBy(F.coalesce("tranche", "collection").alias("tranche")).agg(
        F.count("ligand").alias("n_ligands"), F.count("error").cast("int").alias("n_errors")
    )


SUMMARIES_SQL = """WITH {tasks}
    SELECT {state} AS state, scenario, collection, ligand, CAST(printf('%.1f', min(score)) AS DOUBLE) AS best_score,
           CAST(printf('%.1f', max(score)) AS DOUBLE) AS worst_score, CAST(count(score) AS INT) AS n_dockings
    FROM t WHERE score IS NOT NULL GROUP BY 2, 3, 4"""
COMPLETE = "'complete'"
BY_COLLECTION = "CASE WHEN collection LIKE '%1' THEN 'incomplete' ELSE 'complete' END"


@query("s4_summaries", SUMMARIES_SQL.format(tasks=TASK_SQL, state=COMPLETE))
def s4_summaries(spark, d):
    path = shared_path(spark, "summaries")
    sinks.write_summary_text(summary.ligand_summary(dockings(spark, d), padded=True), path, 7)
    return text.read_summaries(spark, path, layout="table").drop("avg_score", "scores", "smiles")


def _summary_files(spark, d):
    """(state, scenario, path, content): a gzip text file per scenario and collection; some collections are incomplete."""
    lines = sinks.summary_lines(summary.ligand_summary(dockings(spark, d), padded=True))
    state = F.when(F.col("collection").endswith("1"), "incomplete").otherwise("complete")
    name = F.concat(F.substring("collection", 1, 2), F.lit("/"), F.replace("collection", F.lit("_"), F.lit("/")), F.lit(".txt.gz"))
    named = lines.select("scenario", "collection", state.alias("state"), name.alias("path"), "line")
    header = sinks.summary_header(7, False)

    def pack(key, rows):
        scenario, _, state, path = key
        out = io.BytesIO()
        with gzip.GzipFile("", "wb", archives.GZIP_LEVEL, out, 0) as text:
            text.write(f"{header}\n".encode())
            for *_, line in rows:
                text.write(f"{line}\n".encode())
        yield state, scenario, path, out.getvalue()

    return archives.per_group(
        named, ["scenario", "collection", "state", "path"], ["line"], pack, "state STRING, scenario STRING, path STRING, content BINARY"
    )


def _in_tree(files):
    folder = F.concat("state", F.lit("/"), "scenario", F.lit("/summaries/"), "path")
    return files.select(folder.alias("path"), "content")


@query("s4_read_collections", SUMMARIES_SQL.format(tasks=TASK_SQL, state=BY_COLLECTION))
def s4_read_collections(spark, d):
    root = shared_path(spark, "summary-tree")
    archives.write_files(_in_tree(_summary_files(spark, d)), root)
    return text.read_summaries(spark, root).drop("avg_score", "scores", "smiles")


@query("s4_read_tranches", SUMMARIES_SQL.format(tasks=TASK_SQL, state=BY_COLLECTION))
def s4_read_tranches(spark, d):
    """Complete collections in one archive per tranche, incomplete ones beside them as files."""
    root, files = shared_path(spark, "summary-tranches"), _summary_files(spark, d)
    whole = archives.qualified(spark, root)

    def write(key, rows):
        state, scenario, tranche = key
        folder, n = f"{whole}/{state}/{scenario}/summaries", 0
        if state == "complete":
            with archives.written(f"{folder}/{tranche}.tar") as file, tarfile.open(fileobj=file, mode="w|") as tar:
                for *_, path, content in rows:
                    archives.add(tar, path.split("/", 1)[1], content)
                    n += 1
        else:
            for *_, path, content in rows:
                with archives.written(f"{folder}/{path}") as file:
                    file.write(content)
                n += 1
        yield (n,)

    in_tranches = files.select("state", "scenario", F.substring_index("path", "/", 2).alias("tranche"), "path", "content")
    archives.per_group(in_tranches, ["state", "scenario", "tranche"], ["path"], write, "n LONG").agg(F.sum("n")).collect()
    return text.read_summaries(spark, root, layout="tranche").drop("avg_score", "scores", "smiles")


@query(
    "s10_summary_text",
    """
    WITH p AS (SELECT scenario, collection, ligand, replica, min(score) AS lo, sum(score) AS s, count(*) AS c FROM @result WHERE score IS NOT NULL GROUP BY 1, 2, 3, 4),
    g AS (SELECT scenario, collection, ligand, CAST(sum(s) AS DOUBLE) / sum(c) AS avg_score, min(lo) AS best, CAST(sum(c) AS INT) AS n,
                 array_to_string(list_transform(range(1, max(replica) + 1), lambda k: coalesce(list_max(list_transform(list_filter(list((replica, printf('%.1f', lo))), lambda q: q[1] = k), lambda q: q[2])), '-')), ' ') AS scores
          FROM p GROUP BY 1, 2, 3)
    SELECT scenario, substr(collection, 1, 2) AS metatranche, string_split(collection, '_')[1] AS tranche,
           concat(collection, ' ', ligand, ' ', printf('%.1f', avg_score), ' ', printf('%.1f', best), ' ', lpad(CAST(n AS STRING), 5, ' '), ' ', scores) AS line
    FROM g
    UNION ALL SELECT scenario, substr(collection, 1, 2), string_split(collection, '_')[1],
           'Tranch   Compound   average-score   maximum-score   number-of-dockings   score-replica-1   score-replica-2   score-replica-3   score-replica-4   score-replica-5   score-replica-6   score-replica-7' FROM (SELECT DISTINCT scenario, collection FROM g) AS h
    """,
)
def s10_summary_text(spark, d):
    path = shared_path(spark, "summary-text")
    # Two calls; the collections of the second one share folders with those of the first.
    whole = summary.ligand_summary(table(spark, d, "result"), padded=True)
    first = F.col("collection").endswith("1")
    sinks.write_summary_text(whole.where(first), path, 7)
    sinks.write_summary_text(whole.where(~first), path, 7)
    return spark.read.text(path).select("scenario", "metatranche", "tranche", F.col("value").alias("line"))


@query(
    "s5_status_json",
    """SELECT collection, ligand, scenario, replica, status, info, seconds, score FROM @status""",
)
def s5_status_json(spark, d):
    path = shared_path(spark, "status-json")
    sinks.write_status(table(spark, d, "status"), path, "json")
    return text.read_status(spark, path, "jsonl").drop("ts")


@query(
    "s5_status_text",
    """SELECT collection, ligand, scenario, replica, status, info, CASE WHEN scenario IS NOT NULL THEN round(seconds * 1000) / 1000 END AS seconds FROM @status""",
)
def s5_status_text(spark, d):
    path = shared_path(spark, "status-text")
    sinks.write_status(table(spark, d, "status"), path, "text")
    return text.read_status(spark, path, "text").drop("ts", "score")


@query(
    "s5_status_shell_index",
    """SELECT s.collection, s.ligand, n.name AS scenario, replica, status FROM @status AS s
       JOIN @scenario AS n ON n.idx = CAST(substr(s.scenario, 2) AS INT) + 1 WHERE s.scenario IS NOT NULL""",
)
def s5_status_shell_index(spark, d):
    path = shared_path(spark, "status-shell")
    rows = table(spark, d, "status").where("scenario IS NOT NULL")
    numbered = rows.withColumn("scenario", (F.substring("scenario", 2, 9).cast("int") + 1).cast("string"))
    sinks.write_status(numbered, path, "text")
    named = text.read_status(spark, path, "text", scenario_rows=table(spark, d, "scenario"))
    return named.select("collection", "ligand", "scenario", "replica", "status")


@query(
    "s5_status_json_list",
    """SELECT collection, ligand, scenario, replica, status, score FROM @status""",
)
def s5_status_json_list(spark, d):
    """One JSON array per file, replicas from 0, as jobs publish them."""
    path = shared_path(spark, "status-list")
    rows = table(spark, d, "status").withColumn("replica", F.col("replica") - 1)
    objects = sinks.status_objects(rows.drop("ts")).withColumn("seconds", F.col("seconds").cast("string"))
    fields = [c for c in objects.columns if c != "collection"]
    lists = objects.groupBy("collection").agg(F.to_json(F.collect_list(F.struct(*fields)), {"ignoreNullFields": "false"}).alias("value"))
    lists.select("collection", "value").write.partitionBy("collection").text(path)
    return text.read_status(spark, path).select("collection", "ligand", "scenario", "replica", "status", "score")


@query(
    "s11_status_replaced",
    """SELECT collection, count(*) AS n, count(*) FILTER (scenario IS NULL) AS n_removed, count(*) AS n_timed FROM @status GROUP BY 1""",
)
def s11_status_replaced(spark, d):
    """Lists of collections that are written again are replaced, others stay, times are kept."""
    path = shared_path(spark, "status-replaced")
    rows = table(spark, d, "status")
    sinks.write_status(rows, path, "json", replace=True)
    sinks.write_status(rows.where(F.col("collection") < "C3"), path, "json", replace=True)
    return text.read_status(spark, path, "jsonl").groupBy("collection").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("scenario").isNull()).alias("n_removed"), F.count("ts").alias("n_timed")
    )


@query(
    "s11_status_sink",
    """SELECT collection, count(*) AS n, count(*) FILTER (scenario IS NULL) AS n_removed FROM @status GROUP BY 1""",
)
def s11_status_sink(spark, d):
    path = shared_path(spark, "status-sink")
    sinks.write_status(table(spark, d, "status"), path, "text")
    lines = spark.read.text(path)
    return lines.groupBy("collection").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").contains("failed(ligand_")).alias("n_removed")
    )


# Status lines in a file: a compressed file is read by one task.
LINES_PER_FILE = 50_000


def _batch_files(spark, d):
    """Status rows as compressed JSON lines, each with one attempt of one subjob."""
    attempts = table(spark, d, "attempt").selectExpr(
        """map(CAST(workunit AS STRING), named_struct(
             'status', named_struct('job_id', concat('j', CAST(workunit AS STRING)), 'aws_batch_status', 'RUNNING'),
             'subjobs', map(CAST(subjob AS STRING), named_struct(
               'status', 'SUCCEEDED',
               'collections', array(array(concat('C_', CAST(subjob AS STRING)), CAST(attempt_no AS STRING)), array('D_1', '7')),
               'detailed_status', named_struct('container', named_struct('vcpus', 8),
                 'attempts', array(named_struct('startedAt', started_at, 'stoppedAt', stopped_at, 'statusReason', reason)))
             )))) AS workunits"""
    )
    path = shared_path(spark, "batch-status")
    lines = attempts.select(F.to_json(F.struct("workunits")).alias("value"))
    lines.write.options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": LINES_PER_FILE}).text(path)
    return nested.read_batch_status(spark, path, multiline=False)


@query(
    "s6_batch_attempts",
    "SELECT workunit, subjob, 0 AS attempt_no, started_at, stopped_at, reason FROM @attempt",
)
def s6_batch_attempts(spark, d):
    return _batch_files(spark, d)["attempt"]


@query(
    "s6_attempt_order",
    """SELECT workunit, subjob, CAST(row_number() OVER (PARTITION BY workunit, subjob ORDER BY attempt_no, started_at NULLS FIRST, stopped_at NULLS FIRST, reason) - 1 AS INT) AS attempt_no, started_at, stopped_at, reason FROM @attempt""",
)
def s6_attempt_order(spark, d):
    """Status files with all attempts of a subjob in a row, one file per work unit."""
    struct = lambda **cols: F.struct(*(c.alias(n) for n, c in cols.items()))
    attempt = struct(no=F.col("attempt_no"), startedAt=F.col("started_at"), stoppedAt=F.col("stopped_at"), statusReason=F.col("reason"))
    jobs = table(spark, d, "attempt").groupBy("workunit", "subjob").agg(F.sort_array(F.collect_list(attempt)).alias("attempts"))
    detail = struct(container=struct(vcpus=F.lit(8)), attempts=F.transform("attempts", lambda a: a.dropFields("no")))
    subjob = struct(status=F.lit("SUCCEEDED"), detailed_status=detail)
    units = jobs.groupBy("workunit").agg(F.map_from_entries(F.collect_list(F.struct(F.col("subjob").cast("string"), subjob))).alias("subjobs"))
    unit = F.create_map(F.col("workunit").cast("string"), struct(status=struct(job_id=F.lit("job")), subjobs=F.col("subjobs")))
    root = shared_path(spark, "status-files")
    content = F.to_json(F.struct(unit.alias("workunits")), {"ignoreNullFields": "false", "pretty": "true"})
    archives.write_files(units.select(F.concat(F.col("workunit").cast("string"), F.lit(".json")).alias("path"), content.alias("content")), root)
    return nested.read_batch_status(spark, root)["attempt"]


@query(
    "s6_batch_subjobs",
    """SELECT workunit, subjob, 'SUCCEEDED' AS status, 8 AS vcpus, count(*) AS n_rows, CAST(sum(attempt_no + 7) AS BIGINT) AS n_ligands FROM @attempt GROUP BY 1, 2""",
)
def s6_batch_subjobs(spark, d):
    rows = _batch_files(spark, d)["subjob"]
    return rows.groupBy("workunit", "subjob", "status", "vcpus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_ligands").alias("n_ligands")
    )


@query("s7_done", "SELECT * FROM @done")
def s7_done(spark, d):
    counters = (
        "' was completed by queue ', queue, ' on Mon Jan  1. Ligands-started:', CAST(ligands_started AS STRING),"
        "' Ligands-succeeded:', CAST(ligands_succeeded AS STRING), ' Ligands-failed:', CAST(ligands_failed AS STRING),"
        "'  Dockings-started:', CAST(dockings_started AS STRING), ' Dockings-succeeded:', CAST(dockings_succeeded AS STRING),"
        "' Dockings-failed:', CAST(dockings_failed AS STRING)"
    )
    path = shared_path(spark, "done")
    table(spark, d, "done").selectExpr(f"concat(collection, {counters}) AS value").write.text(path)
    return text.read_done(spark, path)


@query(
    "s8_logs",
    """SELECT collection, ligand, scenario, replica, length(log) AS n_chars FROM @log""",
)
def s8_logs(spark, d):
    files = table(spark, d, "log").selectExpr(
        """concat('/out/', scenario, '/logfiles/AB/', replace(collection, '_', '/'), '/', ligand, '_replica-', CAST(replica AS STRING)) AS path""",
        "log AS text",
    )
    return text.log_rows(files).withColumn("n_chars", F.length("log").cast("long")).drop("log")


@query(
    "s8_log_archives",
    """SELECT collection, ligand, scenario, replica, length(log) AS n_chars FROM @log""",
)
def s8_log_archives(spark, d):
    packed = _log_archives(spark, d).withColumn("path", F.concat(F.lit("/"), "path"))
    return text.log_rows(nested.unpack_files(packed)).withColumn("n_chars", F.length("log").cast("long")).drop("log")


def _log_archives(spark, d):
    """Logs in one archive per scenario and collection, as finished collections publish them."""
    rows = table(spark, d, "log").select("collection", "scenario", "ligand", "replica", "log")

    def pack(key, logs):
        (collection, scenario), (tranche, number) = key, key[0].split("_", 1)
        packed = archives.gzip_tar((f"{ligand}_replica-{replica}", (log or "").encode()) for _, _, ligand, replica, log in logs)
        yield f"out/{scenario}/logfiles/AB/{tranche}/{number}.tar.gz", packed

    return archives.per_group(rows, ["collection", "scenario"], [], pack, nested.ARCHIVE)


@query(
    "s8_read_logs",
    """SELECT collection, ligand, concat('S', CAST(pos % 2 AS VARCHAR)) AS scenario, CAST(pos % 3 + 1 AS INT) AS replica, length(content) AS n_chars, md5(content) AS digest FROM @ligand""",
)
def s8_read_logs(spark, d):
    """Loose logs of unfinished collections, replicas from 0 in the file names."""
    root = shared_path(spark, "logs")
    files = table(spark, d, "ligand").selectExpr(
        """concat('incomplete/S', pos % 2, '/logfiles/', substr(collection, 1, 2), '/', replace(collection, '_', '/'), '/', ligand, '_replica-', pos % 3) AS path""",
        "content",
    )
    archives.write_files(files, root)
    return text.read_logs(spark, root, replica_base=0).select(
        "collection", "ligand", "scenario", "replica", F.length("log").cast("long").alias("n_chars"), F.md5("log").alias("digest")
    )


@query(
    "s8_read_log_archives",
    """SELECT collection, ligand, scenario, replica, length(log) AS n_chars FROM @log""",
)
def s8_read_log_archives(spark, d):
    root = shared_path(spark, "log-archives")
    archives.write_files(_log_archives(spark, d), root)
    return text.read_logs(spark, root, archived=True).withColumn("n_chars", F.length("log").cast("long")).drop("log")


@query(
    "s9_results_tree",
    """WITH r AS (SELECT *, CASE WHEN flag = 'F' AND scenario <> 'N' THEN 'complete' ELSE 'incomplete' END AS state FROM @result),
    c AS (SELECT DISTINCT scenario, collection FROM r WHERE state = 'complete')
    SELECT state, r.scenario, string_split(collection, '_')[1] AS tranche, count(*) AS n, count(score) AS n_scored, count(DISTINCT collection) AS n_collections
    FROM r WHERE state = 'complete' OR (scenario, collection) NOT IN (SELECT (scenario, collection) FROM c) GROUP BY 1, 2, 3""",
)
def s9_results_tree(spark, d):
    is_complete = (F.col("flag") == "F") & (F.col("scenario") != "N")
    rows = table(spark, d, "result").withColumn("state", F.when(is_complete, "complete").otherwise("incomplete"))
    path = shared_path(spark, "results")
    # Two jobs finish one after the other; the second one meets the folders of the first.
    sinks.write_results(rows.where("state = 'incomplete'"), path, "tranche")
    sinks.write_results(rows.where("state = 'complete'"), path, "tranche")
    return sinks.read_results(spark, path).groupBy("state", "scenario", "tranche").agg(
        F.count(F.lit(1)).alias("n"), F.count("score").alias("n_scored"),
        F.count_distinct("collection").alias("n_collections"),
    )
