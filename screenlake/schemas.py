"""Schemas of the domain tables."""

from __future__ import annotations

SCENARIO = "idx INT, name STRING, program STRING, replicas INT, inputfolder STRING"

LIGAND = (
    "collection STRING, tranche STRING, metatranche STRING, ligand STRING, "
    "format STRING, content STRING"
)

TASK_KEYS = ["collection", "ligand", "scenario", "replica"]

RESULT = (
    "collection STRING, ligand STRING, scenario STRING, scenario_idx INT, program STRING, "
    "replica INT, status STRING, score DOUBLE, seconds DOUBLE, log STRING"
)

STATUS = (
    "collection STRING, ligand STRING, scenario STRING, replica INT, status STRING, "
    "info STRING, seconds DOUBLE, score DOUBLE, ts TIMESTAMP"
)

# Field names as they stand in the JSON ligand lists.
STATUS_JSON = (
    "ligand STRING, scenario_key STRING, replica_index INT, status STRING, info STRING, "
    "seconds STRING, score DOUBLE, ts STRING"
)

# Nested status file: work units hold subjobs, subjobs hold attempts.
BATCH_STATUS_JSON = """
workunits MAP<STRING, STRUCT<
  status: STRUCT<job_id: STRING, aws_batch_status: STRING>,
  subjobs: MAP<STRING, STRUCT<
    status: STRING,
    collections: ARRAY<ARRAY<STRING>>,
    detailed_status: STRUCT<
      container: STRUCT<vcpus: INT>,
      attempts: ARRAY<STRUCT<startedAt: BIGINT, stoppedAt: BIGINT, statusReason: STRING>>
    >
  >>
>>
"""

# The fields of it that one table is made of.
BATCH_WORKUNIT_JSON = "workunits MAP<STRING, STRUCT<status: STRUCT<job_id: STRING, aws_batch_status: STRING>>>"
BATCH_SUBJOB_JSON = """
workunits MAP<STRING, STRUCT<
  subjobs: MAP<STRING, STRUCT<
    status: STRING, collections: ARRAY<ARRAY<STRING>>, detailed_status: STRUCT<container: STRUCT<vcpus: INT>>
  >>
>>
"""
BATCH_ATTEMPT_JSON = """
workunits MAP<STRING, STRUCT<
  subjobs: MAP<STRING, STRUCT<
    detailed_status: STRUCT<attempts: ARRAY<STRUCT<startedAt: BIGINT, stoppedAt: BIGINT, statusReason: STRING>>>
  >>
>>
"""
