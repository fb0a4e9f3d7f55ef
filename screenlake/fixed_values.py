"""These must equal the file formats and rules being read, or results differ."""

# Elements the docking programs cannot handle, in order of precedence.
UNSUPPORTED_ELEMENTS = ("B", "Si", "Sn")

# Task and ligand statuses.
PROCESSING = "processing"
SUCCEEDED = "succeeded"
FAILED = "failed"
FAILED_DOCKING = "failed(docking)"
FAILED_PROGRAM = "failed(docking_program)"
FAILED_COORDINATES = "failed(ligand_coordinates)"
FAILED_ELEMENTS = "failed(ligand_elements:"
FAILED_ENERGY = "energy-check:failed"

# Batch job statuses: name, order, completed, check parent, check subjobs.
BATCH_STATUSES = (
    ("SUBMITTED", 1, 0, 1, 0),
    ("PENDING", 2, 0, 1, 1),
    ("RUNNABLE", 3, 0, 1, 0),
    ("STARTING", 4, 0, 1, 1),
    ("RUNNING", 5, 0, 1, 1),
    ("SUCCEEDED", 6, 1, 0, 1),
    ("FAILED", 7, 1, 0, 1),
)
BATCH_STATUS_NAMES = tuple(s[0] for s in BATCH_STATUSES)
UNKNOWN_STATUS = "UNKNOWN"

# Reason text of a container that ended by itself (not interrupted).
NORMAL_EXIT = "Essential container in task exited"

# Counters in a done-list line.
DONE_COUNTERS = (
    "Ligands-started",
    "Ligands-succeeded",
    "Ligands-failed",
    "Dockings-started",
    "Dockings-succeeded",
    "Dockings-failed",
)

# Outcome counters of a collection.
OUTCOMES = (
    "ligands_succeeded_docking",
    "ligands_removed",
    "ligands_failed_docking",
    "unknown_event",
)

# Docking programs by the shape of their logs. The prefixes also cover
# variants such as smina_rigid and smina_flexible.
VINA_PROGRAMS = ("qvina02", "qvina_w", "vina", "vina_carb", "vina_xb")
VINA_PREFIXES = ("gwovina",)
SMINA_PREFIXES = ("smina",)
ADFR_PROGRAMS = ("adfr",)
PLANTS_PROGRAMS = ("plants",)

# Control keys holding the four parallel scenario lists.
SCENARIO_NAMES = "docking_scenario_names"
SCENARIO_PROGRAMS = "docking_scenario_programs"
SCENARIO_REPLICAS = "docking_scenario_replicas"
SCENARIO_FOLDERS = "docking_scenario_inputfolders"

# Values a control file may hold.
LIBRARY_FORMATS = ("mol2", "pdbqt")
OUTPUT_LEVELS = ("collection", "tranche")

# Score histogram: bins 1-20 are half a unit wide and start at -5; see functions/scores.py.
HISTOGRAM_BINS = 24

# Column titles of the summary text file.
SUMMARY_TITLES = (
    "Tranch",
    "Compound",
    "SMILES",
    "average-score",
    "maximum-score",
    "number-of-dockings",
)
SUMMARY_REPLICA_TITLE = "score-replica-"

# Stands in a summary line for a replica without a score.
NO_SCORE = "-"

# Reasons for leaving a ligand out, as status lists give them.
ELEMENTS_INFO = "ligand includes elements: "
COORDINATES_INFO = "duplicate coordinates"
