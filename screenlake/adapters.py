"""Domain tables over the sample tables.

Each adapter is one SQL text that Spark and DuckDB both accept; `{table}` marks a sample
table. Every row of a sample table is used. Scores are quarters, so sums of doubles are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SCORE = "CAST((CASE WHEN l_discount = 0 THEN floor(l_quantity) ELSE 0 - floor(l_extendedprice / 1000) END) / 4.0 AS DOUBLE)"
_STATUS = "CASE WHEN l_tax > 0.075 THEN 'failed(docking)' WHEN l_tax > 0.065 THEN 'failed' ELSE 'succeeded' END"

_ATOM = "ATOM 1 C LIG 1 "

ADAPTERS: dict[str, str] = {
    # Dockings: ligand = part, collection = supplier, scenario = return flag, replica = line.
    "result": f"""
        SELECT concat('AB', lpad(CAST(l_suppkey % 40 AS STRING), 4, '0'), '_', lpad(CAST(l_suppkey AS STRING), 10, '0')) AS collection,
               concat('L', CAST(l_partkey AS STRING)) AS ligand,
               l_returnflag AS scenario,
               l_linenumber AS replica,
               {_STATUS} AS status,
               CASE WHEN l_tax > 0.065 THEN NULL ELSE {_SCORE} END AS score,
               l_quantity AS seconds,
               l_linestatus AS flag
        FROM {{lineitem}}
    """,
    "manifest": """
        SELECT p_partkey AS seq,
               concat(substr(p_type, 1, 2), lpad(replace(p_brand, 'Brand#', ''), 4, '0'), '_', lpad(CAST(p_partkey AS STRING), 10, '0')) AS collection,
               p_size AS n_ligands
        FROM {part}
    """,
    # A ligand file per document: every line becomes an ATOM line whose fields 6-8 are its
    # first words; some words stand for elements.
    "ligand": f"""
        SELECT concat(upper(lang), 'ABCD_', source) AS collection,
               concat('D', CAST(doc_id AS STRING)) AS ligand,
               concat('REMARK  SMILES  ', source, chr(10), '{_ATOM}',
                      replace(replace(replace(replace(text, chr(10), concat(chr(10), '{_ATOM}')),
                              ' hesh ', ' Si '), ' inon ', ' B '), ' leon ', ' Sn '),
                      chr(10)) AS content,
               doc_id AS pos
        FROM {{documents}}
    """,
    "status": """
        SELECT concat('C', CAST(user_id % 50 AS STRING)) AS collection,
               concat('U', CAST(user_id AS STRING)) AS ligand,
               CASE WHEN event_type = 'signup' THEN NULL ELSE concat('S', CAST(event_id % 2 AS STRING)) END AS scenario,
               CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(event_id % 3 + 1 AS INT) END AS replica,
               CASE event_type WHEN 'click' THEN 'succeeded' WHEN 'purchase' THEN 'succeeded'
                    WHEN 'error' THEN 'failed(docking)' WHEN 'signup' THEN 'failed' ELSE 'processing' END AS status,
               CASE WHEN event_type = 'signup' THEN 'duplicate coordinates' END AS info,
               value AS seconds,
               CASE WHEN event_type IN ('click', 'purchase') THEN -value / 4 END AS score,
               ts
        FROM {events}
    """,
    "scenario": """
        SELECT r_regionkey + 1 AS idx, r_name AS name,
               CASE r_regionkey WHEN 0 THEN 'vina' WHEN 1 THEN 'smina_rigid' WHEN 2 THEN 'adfr'
                    WHEN 3 THEN 'plants' ELSE 'other' END AS program,
               CAST(r_regionkey % 3 + 1 AS INT) AS replicas,
               lower(r_name) AS inputfolder
        FROM {region}
    """,
    "assignment": """
        SELECT o_orderkey AS seq,
               concat('AB', lpad(CAST(o_custkey AS STRING), 10, '0'), '_', substr(o_orderpriority, 1, 1)) AS collection,
               CAST(floor(o_totalprice / 1000) AS INT) AS n_ligands,
               CAST(o_orderkey % 4 + 1 AS INT) AS jobline,
               CAST(floor(o_orderkey / 4) % 2 + 1 AS INT) AS step,
               CAST(o_orderkey % 8 + 1 AS INT) AS queue,
               o_orderstatus AS list
        FROM {orders}
    """,
    "done": """
        SELECT concat('AB', lpad(CAST(o_custkey AS STRING), 10, '0'), '_', CAST(o_orderkey AS STRING)) AS collection,
               concat(CAST(o_orderkey % 4 + 1 AS STRING), '-1-', CAST(o_orderkey % 8 + 1 AS STRING)) AS queue,
               CAST(floor(o_totalprice / 1000) AS BIGINT) AS ligands_started,
               CAST(floor(o_totalprice / 1200) AS BIGINT) AS ligands_succeeded,
               CAST(floor(o_totalprice / 5000) AS BIGINT) AS ligands_failed,
               CAST(floor(o_totalprice / 1000) * 4 AS BIGINT) AS dockings_started,
               CAST(floor(o_totalprice / 1200) * 3 AS BIGINT) AS dockings_succeeded,
               CAST(floor(o_totalprice / 5000) * 2 AS BIGINT) AS dockings_failed
        FROM {orders}
    """,
    "workunit": """
        SELECT CAST(floor(o_orderkey / 100) AS INT) AS workunit,
               min(concat('job-', CAST(o_custkey AS STRING))) AS job_id,
               min(CASE o_orderpriority WHEN '1-URGENT' THEN 'RUNNING' WHEN '2-HIGH' THEN 'PENDING' ELSE 'SUCCEEDED' END) AS status
        FROM {orders}
        GROUP BY CAST(floor(o_orderkey / 100) AS INT)
    """,
    "subjob": """
        SELECT CAST(floor(o_orderkey / 100) AS INT) AS workunit,
               CAST(o_orderkey % 100 AS INT) AS subjob,
               CASE WHEN o_orderstatus = 'F' THEN 'SUCCEEDED' WHEN o_orderstatus = 'P' THEN NULL
                    WHEN o_orderpriority = '1-URGENT' THEN 'RUNNING' WHEN o_orderpriority = '2-HIGH' THEN 'FAILED'
                    WHEN o_orderpriority = '5-LOW' THEN 'LOST' ELSE 'RUNNABLE' END AS status,
               CAST(o_orderkey % 8 + 1 AS INT) AS vcpus,
               CAST(floor(o_totalprice / 1000) AS INT) AS n_ligands
        FROM {orders}
    """,
    # Attempts without a start stand for containers that were never placed.
    "attempt": """
        SELECT CAST(floor(l_orderkey / 100) AS INT) AS workunit,
               CAST(l_orderkey % 100 AS INT) AS subjob,
               l_linenumber AS attempt_no,
               CASE WHEN l_discount = 0 THEN NULL ELSE l_partkey * 1000 END AS started_at,
               CASE WHEN l_discount = 0 THEN NULL ELSE l_partkey * 1000 + CAST(floor(l_extendedprice * 10) AS BIGINT) END AS stopped_at,
               CASE l_linestatus WHEN 'F' THEN 'Essential container in task exited' ELSE 'Host EC2 terminated' END AS reason
        FROM {lineitem}
    """,
    "job": """
        SELECT event_type AS queue,
               CASE event_id % 3 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'PENDING' ELSE 'COMPLETING' END AS state,
               CASE WHEN user_id % 2 = 0 THEN concat(CAST(user_id % 16 + 1 AS STRING), '*host')
                    ELSE concat('host', CAST(user_id AS STRING)) END AS slots
        FROM {events}
    """,
    "control_range": """
        SELECT concat(CAST(s_suppkey * 10 AS STRING), '-', CAST(s_suppkey * 10 + 14 + s_nationkey AS STRING)) AS file,
               s_suppkey * 10 AS range_start,
               s_suppkey * 10 + 14 + s_nationkey AS range_end
        FROM {supplier}
    """,
    # Rows of one control file per supplier.
    "control": " UNION ALL ".join(
        f"SELECT concat('ctrl-', CAST(s_suppkey AS STRING)) AS file, {n} AS line_no, '{key}' AS key, {value} AS value FROM {{supplier}}"
        for n, (key, value) in enumerate(
            (
                ("docking_scenario_names", "concat('r', CAST(s_nationkey AS STRING), ':rigid:flexible')"),
                ("docking_scenario_programs", "CASE WHEN s_nationkey < 5 THEN 'vina:adfr' ELSE 'vina:smina_rigid:adfr' END"),
                ("docking_scenario_replicas", "concat(CAST(s_nationkey % 3 + 1 AS STRING), ':', CAST(s_suppkey % 5 + 1 AS STRING), ':2')"),
                ("docking_scenario_inputfolders", "'in1:in2:in3'"),
                ("energy_check", "CASE s_nationkey % 4 WHEN 0 THEN 'false' WHEN 1 THEN 'yes' ELSE 'true' END"),
                ("energy_max", "CASE WHEN s_nationkey % 7 = 0 THEN 'high' ELSE '10000' END"),
                ("ligand_library_format", "CASE WHEN s_nationkey % 5 = 0 THEN 'sdf' ELSE 'pdbqt' END"),
                ("outputfiles_level", "'tranche'"),
            ),
            1,
        )
    ),
    "jobline": "SELECT o_orderkey AS jobline FROM {orders}",
    # A log per line item, in the format of one of the programs.
    "log": f"""
        SELECT concat('AB', lpad(CAST(l_suppkey % 40 AS STRING), 4, '0'), '_', CAST(l_suppkey AS STRING)) AS collection,
               concat('L', CAST(l_partkey AS STRING), 'x', CAST(l_orderkey AS STRING)) AS ligand,
               l_returnflag AS scenario, l_linenumber AS replica, program,
               {_SCORE} AS true_score,
               concat(body, chr(10), ' Docking timings ', chr(10), ' user real system ', chr(10), ' ',
                      CAST(CAST(l_quantity AS INT) AS STRING), '.5 ', CAST(CAST(l_quantity AS INT) + 1 AS STRING), '.25 0.0', chr(10)) AS log
        FROM (
            SELECT *,
                   CASE program
                     WHEN 'vina' THEN concat('mode | affinity', chr(10), '   1      ', score_text, '      0.000      0.000', chr(10), '   2      -0.5      1.000      1.000')
                     WHEN 'smina_rigid' THEN concat('1    99.9', chr(10), 'refining', chr(10), '1    ', score_text, '  0.0')
                     WHEN 'adfr' THEN concat('start: now', chr(10), 'Best FEB: ', score_text, chr(10), 'Next FEB: 55.5')
                     WHEN 'plants' THEN concat('name,score', chr(10), 'LIG_conf_01,', score_text, ',x', chr(10), 'LIG_conf_01,44.4,x')
                     ELSE concat('no score here ', score_text) END AS body
            FROM (
                SELECT *,
                       CASE l_linenumber WHEN 1 THEN 'vina' WHEN 2 THEN 'smina_rigid' WHEN 3 THEN 'adfr' WHEN 4 THEN 'plants'
                            WHEN 5 THEN 'gwovina' WHEN 6 THEN 'vina' ELSE 'unheard_of' END AS program,
                       CASE WHEN l_tax > 0.075 THEN 'n/a' ELSE CAST({_SCORE} AS STRING) END AS score_text
                FROM {{lineitem}}
            ) AS a
        ) AS b
    """,
}


def sql_of(name: str) -> str:
    """The adapter as DuckDB SQL over the sample views."""
    return ADAPTERS[name].format_map(_Names())


class _Names(dict):
    def __missing__(self, key: str) -> str:
        return key


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table over the Parquet files of `sf_dir`."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = ADAPTERS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)
