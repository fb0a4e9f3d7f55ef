"""Chunks, bins, work units, queues and lookups of control files and assignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.adapters import table
from screenlake.catalog.registry import query
from screenlake.operators import assign, packing

CHUNK = 500
TARGET = 200


@query(
    "w1_chunk_manifest",
    f"""SELECT seq, collection, n_ligands, lpad(CAST((row_number() OVER (ORDER BY seq) - 1) // {CHUNK} AS STRING), 4, '0') AS chunk FROM @manifest""",
)
def w1_chunk_manifest(spark, d):
    return packing.chunk_manifest(table(spark, d, "manifest"), CHUNK)


def _bins_sql(target: int) -> str:
    return f"""
    small AS (SELECT *, row_number() OVER (ORDER BY seq) AS i FROM @manifest WHERE n_ligands < {target}),
    walk AS (
        SELECT i, seq, n_ligands AS acc, 0 AS k FROM small WHERE i = 1
        UNION ALL
        SELECT s.i, s.seq, CASE WHEN w.acc >= {target} THEN s.n_ligands ELSE w.acc + s.n_ligands END,
               CASE WHEN w.acc >= {target} THEN w.k + 1 ELSE w.k END
        FROM walk AS w JOIN small AS s ON s.i = w.i + 1),
    ends AS (
        SELECT k, CAST(NULL AS BIGINT) AS at, max(seq) AS seq, max(acc) < {target} AS open FROM walk GROUP BY k
        UNION ALL SELECT NULL, seq, seq, false FROM @manifest WHERE n_ligands >= {target}),
    numbered AS (SELECT *, row_number() OVER (ORDER BY open, seq) - 1 AS bin FROM ends),
    bins AS (
        SELECT m.seq, m.collection, m.n_ligands, n.bin FROM @manifest AS m JOIN walk AS w ON w.seq = m.seq JOIN numbered AS n ON n.k = w.k
        UNION ALL
        SELECT m.seq, m.collection, m.n_ligands, n.bin FROM @manifest AS m JOIN numbered AS n ON n.at = m.seq)
    """


@query("w2_pack_bins", f"WITH RECURSIVE {_bins_sql(TARGET)} SELECT * FROM bins")
def w2_pack_bins(spark, d):
    return packing.pack_bins(table(spark, d, "manifest"), TARGET)


@query("w2_pack_bins_large_collections", f"WITH RECURSIVE {_bins_sql(40)} SELECT * FROM bins")
def w2_pack_bins_large_collections(spark, d):
    return packing.pack_bins(table(spark, d, "manifest"), 40)


@query(
    "w2_pack_bins_unknown_counts",
    f"""WITH RECURSIVE m AS (SELECT seq, collection, CASE WHEN n_ligands % 7 > 0 THEN n_ligands END AS n_ligands FROM @manifest),
    {_bins_sql(TARGET).replace('@manifest', 'm')}
    SELECT * FROM bins UNION ALL SELECT seq, collection, n_ligands, NULL FROM m WHERE n_ligands IS NULL""",
)
def w2_pack_bins_unknown_counts(spark, d):
    rows = table(spark, d, "manifest").withColumn("n_ligands", F.expr("CASE WHEN n_ligands % 7 > 0 THEN n_ligands END"))
    return packing.pack_bins(rows, TARGET)


@query(
    "w3_group_workunits",
    f"""WITH RECURSIVE {_bins_sql(TARGET)},
    w AS (SELECT *, bin // 20 + 1 AS workunit, bin % 20 AS subjob FROM bins),
    sizes AS (SELECT workunit, greatest(2, count(DISTINCT subjob)) AS array_size FROM w GROUP BY 1)
    SELECT w.*, (workunit - 1) % 3 + 1 AS submit_queue, array_size FROM w JOIN sizes USING (workunit)""",
)
def w3_group_workunits(spark, d):
    return packing.group_workunits(packing.pack_bins(table(spark, d, "manifest"), TARGET), 20, 3)


HELD = ", ".join(
    "coalesce((SELECT CAST(sum(n) AS BIGINT) FROM held AS h"
    f" WHERE h.jobline = j.jobline AND (h.step - 1) * 2 + h.queue - 1 = {q}), 0)"
    for q in range(4)
)


@query(
    "w4_refill_queues",
    f"""
    WITH RECURSIVE numbered AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS rn FROM @manifest),
    lines AS (SELECT CAST(rn // {CHUNK} + 1 AS INT) AS jobline, rn % {CHUNK} AS at, seq, collection, n_ligands FROM numbered),
    held AS (SELECT CAST(s_suppkey % 4 + 1 AS INT) AS jobline, CAST(s_suppkey % 2 + 1 AS INT) AS step, CAST(s_suppkey // 2 % 2 + 1 AS INT) AS queue, s_nationkey AS n FROM supplier),
    jobs AS (SELECT DISTINCT jobline FROM lines),
    starts AS (SELECT j.jobline, [{HELD}] AS loads FROM jobs AS j),
    sim AS (
        SELECT jobline, CAST(0 AS BIGINT) AS at, CAST(0 AS BIGINT) AS slot, loads, CAST(NULL AS BIGINT) AS took FROM starts
        UNION ALL
        SELECT m.jobline,
               CASE WHEN m.loads[m.slot % 4 + 1] < (m.slot // 4 + 1) * 500 THEN m.at + 1 ELSE m.at END,
               CASE WHEN m.loads[m.slot % 4 + 1] < (m.slot // 4 + 1) * 500 THEN m.slot ELSE m.slot + 1 END,
               CASE WHEN m.loads[m.slot % 4 + 1] < (m.slot // 4 + 1) * 500
                    THEN list_transform(m.loads, lambda x, i: CASE WHEN i = m.slot % 4 + 1 THEN x + l.n_ligands ELSE x END) ELSE m.loads END,
               CASE WHEN m.loads[m.slot % 4 + 1] < (m.slot // 4 + 1) * 500 THEN m.at END
        FROM sim AS m JOIN lines AS l ON l.jobline = m.jobline AND l.at = m.at
        WHERE m.slot < 4 * 6)
    SELECT l.jobline, l.seq, l.collection, l.n_ligands, CAST(s.slot % 4 // 2 + 1 AS INT) AS step, CAST(s.slot % 2 + 1 AS INT) AS queue
    FROM lines AS l LEFT JOIN sim AS s ON l.jobline = s.jobline AND l.at = s.took
    """,
)
def w4_refill_queues(spark, d):
    held = spark.read.parquet(f"{d}/supplier.parquet").selectExpr(
        "CAST(s_suppkey % 4 + 1 AS INT) AS jobline",
        "CAST(s_suppkey % 2 + 1 AS INT) AS step",
        "CAST(s_suppkey div 2 % 2 + 1 AS INT) AS queue",
        "s_nationkey AS n_ligands",
    )
    return packing.refill_queues(
        table(spark, d, "manifest"), held, CHUNK, ligands_per_queue=3000, ligands_per_step=500, steps=2, queues=2
    )


# Refills in turn: joblines 1, 2, 3, 1, 2, ... on one list, queues 2 x 2, 3 rounds of 200 ligands.
TURNS = """SELECT CAST(s_suppkey AS BIGINT) AS refill, CAST(s_suppkey % 3 + 1 AS INT) AS jobline FROM supplier WHERE s_suppkey % 4 <> 0"""


@query(
    "w4_refill_in_turn",
    f"""
    WITH RECURSIVE lines AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS rn FROM @manifest),
    turns AS (SELECT *, row_number() OVER (ORDER BY refill) - 1 AS turn FROM ({TURNS}) AS t),
    starts AS (SELECT turn, [CASE WHEN refill % 4 = 1 THEN s_nationkey * 20 ELSE 0 END, CASE WHEN refill % 4 = 2 THEN s_nationkey * 20 ELSE 0 END,
                             CASE WHEN refill % 4 = 3 THEN s_nationkey * 20 ELSE 0 END, 0] AS loads FROM turns JOIN supplier ON s_suppkey = refill),
    sim AS (
        SELECT CAST(0 AS BIGINT) AS turn, CAST(0 AS BIGINT) AS at, CAST(0 AS BIGINT) AS stage, loads, CAST(NULL AS BIGINT) AS took FROM starts WHERE turn = 0
        UNION ALL
        SELECT CASE WHEN m.full AND m.stage = 11 THEN m.turn + 1 ELSE m.turn END, CASE WHEN m.full THEN m.at ELSE m.at + 1 END,
               CASE WHEN NOT m.full THEN m.stage WHEN m.stage = 11 THEN 0 ELSE m.stage + 1 END,
               CASE WHEN NOT m.full THEN list_transform(m.loads, lambda x, i: CASE WHEN i = m.stage % 4 + 1 THEN x + l.n_ligands ELSE x END)
                    WHEN m.stage = 11 THEN s.loads ELSE m.loads END,
               CASE WHEN NOT m.full THEN m.at END
        FROM (SELECT *, loads[stage % 4 + 1] >= (stage // 4 + 1) * 200 AS full FROM sim) AS m
        JOIN lines AS l ON l.rn = m.at LEFT JOIN starts AS s ON s.turn = m.turn + 1 WHERE m.turn < (SELECT count(*) FROM turns))
    SELECT lpad(CAST(l.rn // {CHUNK} AS VARCHAR), 4, '0') AS chunk, l.seq, l.collection, CAST(l.n_ligands AS BIGINT) AS n_ligands, t.refill, t.jobline,
           CAST(s.stage % 4 // 2 + 1 AS INT) AS step, CAST(s.stage % 2 + 1 AS INT) AS queue
    FROM lines AS l LEFT JOIN (SELECT * FROM sim WHERE took IS NOT NULL) AS s ON l.rn = s.took LEFT JOIN turns AS t ON t.turn = s.turn
    """,
)
def w4_refill_in_turn(spark, d):
    supplier = spark.read.parquet(f"{d}/supplier.parquet")
    turns = supplier.where("s_suppkey % 4 <> 0").selectExpr("CAST(s_suppkey AS LONG) AS refill", "CAST(s_suppkey % 3 + 1 AS INT) AS jobline")
    slot = "CAST(s_suppkey % 4 - 1 AS INT)"
    held = supplier.where("s_suppkey % 4 <> 0").selectExpr(
        "s_suppkey AS refill", f"{slot} div 2 + 1 AS step", f"{slot} % 2 + 1 AS queue", "s_nationkey * 20 AS n_ligands"
    )
    return packing.refill_in_turn(
        table(spark, d, "manifest"), turns, held, CHUNK, ligands_per_queue=600, ligands_per_step=200, steps=2, queues=2
    )


@query(
    "w5_redistribute_single",
    """WITH n AS (SELECT seq, collection, row_number() OVER (ORDER BY seq) - 1 AS rn FROM @manifest)
    SELECT seq, collection, CAST(rn // 12 + 5 AS INT) AS job, CAST(rn // 4 % 3 + 1 AS INT) AS step, CAST(rn % 4 + 1 AS INT) AS queue FROM n""",
)
def w5_redistribute_single(spark, d):
    rows = table(spark, d, "manifest").select("seq", "collection")
    return packing.redistribute_single(rows, queues=4, steps=3, first_job=5)


@query(
    "w6_redistribute_multiple",
    """WITH u AS (SELECT collection, min(seq) AS seq FROM @assignment WHERE collection LIKE '%\\_%' ESCAPE '\\' GROUP BY 1),
    n AS (SELECT *, row_number() OVER (ORDER BY seq, collection) - 1 AS rn FROM u)
    SELECT seq, collection, CASE WHEN rn < 24 * 5 THEN CAST(rn % 24 // 12 + 3 AS INT) END AS job,
           CASE WHEN rn < 24 * 5 THEN CAST(rn % 24 // 4 % 3 + 1 AS INT) END AS step,
           CASE WHEN rn < 24 * 5 THEN CAST(rn % 4 + 1 AS INT) END AS queue FROM n""",
)
def w6_redistribute_multiple(spark, d):
    rows = table(spark, d, "assignment").select("seq", "collection")
    return packing.redistribute_multiple(rows, first_job=3, last_job=4, steps=3, queues=4, per_queue=5)


@query(
    "j4_resolve_control",
    """SELECT j.jobline, coalesce(min(r.file), 'all.ctrl') AS control_file FROM @jobline AS j
       LEFT JOIN @control_range AS r ON r.range_start <= j.jobline AND j.jobline <= r.range_end GROUP BY 1""",
)
def j4_resolve_control(spark, d):
    return assign.resolve_control(table(spark, d, "jobline"), table(spark, d, "control_range"), "all.ctrl")


@query(
    "j5_with_assignment",
    """WITH a AS (SELECT collection, n_ligands, jobline, queue, row_number() OVER (PARTITION BY collection ORDER BY seq DESC) AS rn FROM @assignment),
    c AS (SELECT collection, ligands_started FROM (SELECT concat('AB', lpad(CAST(o_custkey AS STRING), 10, '0'), '_1') AS collection, CAST(floor(o_totalprice / 1000) AS BIGINT) AS ligands_started FROM orders) AS o)
    SELECT c.collection, c.ligands_started, a.n_ligands, a.jobline, a.queue FROM c LEFT JOIN a ON a.collection = c.collection AND a.rn = 1""",
)
def j5_with_assignment(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet").selectExpr(
        "concat('AB', lpad(CAST(o_custkey AS STRING), 10, '0'), '_1') AS collection",
        "CAST(floor(o_totalprice / 1000) AS BIGINT) AS ligands_started",
    )
    assignment = table(spark, d, "assignment").select("seq", "collection", "n_ligands", "jobline", "queue")
    return assign.with_assignment(rows, assignment)


@query(
    "s12_worklists",
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY jobline, queue, seq % 2 ORDER BY seq) - 1 AS nth FROM @assignment)
    SELECT jobline, queue, concat(collection, ' ', CAST(n_ligands AS STRING)) AS line, nth FROM n""",
)
def s12_worklists(spark, d):
    from screenlake.session import shared_path
    from screenlake.sources.sinks import write_worklists

    # Two calls, odd lines after even ones; every call leaves one file in a folder this small.
    root = shared_path(spark, "worklists")
    rows = table(spark, d, "assignment")
    for half in (0, 1):
        write_worklists(rows.where(F.col("seq") % 2 == half), root, ["jobline", "queue"])
    lines = spark.read.text(root, wholetext=True).select("jobline", "queue", F.split(F.regexp_replace("value", "\n$", ""), "\n").alias("l"))
    return lines.select("jobline", "queue", F.posexplode("l").alias("nth", "line")).withColumn("nth", F.col("nth").cast("long"))
