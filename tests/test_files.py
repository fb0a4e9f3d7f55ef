"""Readers and writers on small trees."""

import gzip
import io
import json
import tarfile

from pyspark.sql import functions as F

from screenlake import schemas
from screenlake.operators.packing import group_workunits
from screenlake.operators.summary import ligand_summary
from screenlake.sources import archives, nested, sinks, text


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def tar_of(files, mode):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode=mode) as tar:
        for name, data in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return buffer.getvalue()


def test_control(spark, tmp_path):
    put(tmp_path / "1-5.ctrl", "*** x ***\nenergy_max=10000 # note\na=1\na=2\n# b=3\nc = 4 \n")
    shell = rows(text.read_control(spark, str(tmp_path)), "key", "value")
    assert shell == [("a", "1"), ("energy_max", "10000")]
    python = dict(rows(text.read_control(spark, str(tmp_path), "python"), "key", "value"))
    assert python["energy_max"] == "10000 # note" and python["a"] == "2" and python["c"] == "4"


def test_manifest_keeps_file_order(spark, tmp_path):
    put(tmp_path / "todo.0", "Z_1 5\n\n  Y_1   6\nX_1 abc\n")
    put(tmp_path / "todo.1", "A_1 7\nno_count\n")
    got = [tuple(r) for r in text.read_manifest(spark, str(tmp_path)).orderBy("seq").collect()]
    assert got == [(1, "Z_1", 5, None), (2, "Y_1", 6, None), (3, "X_1", None, "X_1 abc"), (4, "A_1", 7, None), (5, "no_count", None, "no_count")]


def test_manifest_read_in_blocks(spark, tmp_path):
    lines = [f"T_{i:05d} {i}" for i in range(5000)]
    put(tmp_path / "todo.all", "\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        manifest = text.read_manifest(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [f"{r['collection']} {r['n_ligands']}" for r in manifest.orderBy("seq").collect()] == lines


def test_ligand_archives(spark, tmp_path):
    inner = {n: tar_of({f"{n}/{x}.pdbqt": f"{n}{x}\n".encode() for x in ("b", "a.1")}, "w:gz") for n in ("00000", "00001")}
    put(tmp_path / "tree/AA/AAAB/00000.tar.gz", inner["00000"])
    put(tmp_path / "tree/AA/AAAB/00001.tar.gz", inner["00001"])
    put(tmp_path / "packed/AA/AAAB.tar", tar_of({f"AAAB/{n}.tar.gz": data for n, data in inner.items()}, "w"))
    put(tmp_path / "packed/AA/BROKEN.tar", b"not a tar")
    cols = ("collection", "tranche", "metatranche", "ligand", "format", "pos", "content")
    tree = rows(nested.read_ligands(spark, str(tmp_path / "tree"), "collection"), *cols)
    packed = nested.read_ligands(spark, str(tmp_path / "packed"))
    assert rows(packed.where("error IS NULL"), *cols) == tree
    # A broken archive is one row that says so.
    assert rows(packed.where("error IS NOT NULL"), "collection", "ligand") == [("BROKEN", None)]
    put(tmp_path / "cut/AA/AAAB/00000.tar.gz", inner["00000"][: len(inner["00000"]) // 2])
    cut = nested.read_ligands(spark, str(tmp_path / "cut"), "collection").collect()
    assert [(r["collection"], r["ligand"], r["error"] is not None) for r in cut] == [("AAAB_00000", None, True)]
    assert tree[0] == ("AAAB_00000", "AAAB", "AA", "a", "pdbqt", 2, "00000a.1\n") and len(tree) == 4
    kept = nested.read_ligands(spark, str(tmp_path / "tree"), "collection", keep_extension=True)
    assert {r["ligand"] for r in kept.collect()} == {"b.pdbqt", "a.1.pdbqt"}


def test_archives_cut_anywhere_are_errors(spark, tmp_path):
    """Each length of a tranche archive but the whole one is one error row, also at a border of members."""
    inner = {f"AAAB/{n:05d}.tar.gz": tar_of({f"{n}/{x}.pdbqt": f"{n}{x}\n".encode() for x in "ab"}, "w:gz") for n in range(3)}
    whole = tar_of(inner, "w")
    end = len(whole.rstrip(b"\0")) // 512 * 512 + 512
    for n, size in enumerate([100, 512, *range(1024, end + 1024, 512), end + 1000]):
        put(tmp_path / f"cut/AA/T{n:03d}.tar", whole[:size])
    put(tmp_path / "cut/AA/WHOLE.tar", whole[:end + 1024])
    for paths in (nested.list_entries(spark, str(tmp_path / "cut"), "*.tar"), whole_entries(spark, str(tmp_path / "cut"), "*.tar")):
        got = rows(nested.unpack_collections(nested.unpacked(paths, (".tar.gz",))), "collection", "ligand", "error")
        good = [r for r in got if r[2] is None]
        assert [r[:2] for r in good] == [(f"AAAB_{i:05d}", x) for i in range(3) for x in "ab"]
        assert [r[0] for r in got if r[2] is not None] == [f"T{i:03d}" for i in range(n + 1)]


def whole_entries(spark, root, glob):
    """Entries as from a store that only Spark can read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return archives.as_entries(files.select("path", "content"))


def test_tranche_above_two_gigabytes(spark, tmp_path):
    """Headers are read by seeking, members as ranges behind the limit of one binary row."""
    inner = tar_of({"00001/Z.pdbqt": b"far away\n"}, "w:gz")
    path = tmp_path / "big/AA/AAAB.tar"
    path.parent.mkdir(parents=True)
    filler = tarfile.TarInfo("AAAB/notes.bin")
    filler.size = (5 << 30) + 7
    last = tar_of({"AAAB/00001.tar.gz": inner}, "w")
    with open(path, "wb") as file:
        file.write(filler.tobuf())
        # A hole instead of data.
        file.seek((filler.size + 511) // 512 * 512, 1)
        file.write(last)
    got = rows(nested.read_ligands(spark, str(tmp_path / "big")), "collection", "ligand", "content", "error")
    assert got == [("AAAB_00001", "Z", "far away\n", None)]


def test_large_collections_are_spooled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "SPOOL", 1000)
    files = {f"1/Z{i}.pdbqt": f"ATOM {i}\n".encode() * 500 for i in range(20)}
    put(tmp_path / "AA/AAAB/1.tar.gz", tar_of(files, "w:gz"))
    entry = archives.Entry("AA/AAAB/1.tar.gz", file=f"file:{tmp_path}/AA/AAAB/1.tar.gz", size=(tmp_path / "AA/AAAB/1.tar.gz").stat().st_size)
    assert dict(archives.members(entry)) == files


def test_library_is_written_as_read(spark, tmp_path):
    ligands = [(f"AAA{t}_{c:05d}", f"Z{i}", "pdbqt", i, f"{t} {c} {i}\n") for t in "BC" for c in range(3) for i in range(1, 5)]
    df = spark.createDataFrame(ligands, "collection STRING, ligand STRING, format STRING, pos INT, content STRING").repartition(5)
    for layout in ("tranche", "collection"):
        # Writing again replaces the files.
        for _ in range(2):
            archives.write_library(df, str(tmp_path / layout), layout)
        back = nested.read_ligands(spark, str(tmp_path / layout), layout)
        assert rows(back, "collection", "ligand", "format", "pos", "content") == sorted(ligands) and back.where("error IS NOT NULL").count() == 0
    assert sorted(p.name for p in (tmp_path / "tranche").rglob("*") if p.is_file() and not p.name.endswith(".crc")) == ["AAAB.tar", "AAAC.tar"]


def test_status_lists_inside_tranche_archives(spark, tmp_path):
    entries = [{"ligand": "L1", "scenario_key": "S", "replica_index": 0, "status": "succeeded", "info": "", "seconds": "1.50"},
               {"ligand": "L2", "status": "failed", "info": "x"}]
    packed = gzip.compress(json.dumps(entries, indent=4).encode())
    lines = gzip.compress(b"L9 1 1 succeeded total-time:1500\n")
    put(tmp_path / "AA/AAAB.tar", tar_of({"AAAB/00000.json.gz": packed, "AAAB/00000.status.gz": lines, "AAAB/00001.json": json.dumps(entries[:1]).encode()}, "w"))
    got = rows(text.read_status(spark, str(tmp_path), "json", archived=True), "collection", "ligand", "scenario", "replica", "status", "seconds")
    assert got == [("AAAB_00000", "L1", "S", 1, "succeeded", 1.5), ("AAAB_00000", "L2", None, None, "failed", None), ("AAAB_00001", "L1", "S", 1, "succeeded", 1.5)]
    assert rows(text.read_status(spark, str(tmp_path), "text", archived=True), "collection", "ligand") == [("AAAB_00000", "L9")]


SHELL = "Tranch Compound SMILES average-score maximum-score number-of-dockings score-replica-1 score-replica-2\nAA_1 L1 CCO -7.4 -7.6 2 -7.2 -7.6\n"
AWS = "Tranch    Compound   average-score maximum-score  number-of-dockings score-replica-0score-replica-1\nAA_2 L2     -5.0    -5.0         1   -5.0   \n"


def test_summaries_of_both_layouts(spark, tmp_path):
    put(tmp_path / "complete/S1/summaries/AA/AA/1.txt.gz", gzip.compress(SHELL.encode()))
    put(tmp_path / "incomplete/S1/summaries/AA/AA/2.txt", AWS)
    put(tmp_path / "complete/S2/summaries/AA/AA/1.txt", SHELL)
    got = rows(text.read_summaries(spark, str(tmp_path), "S1"), "state", "scenario", "collection", "ligand", "smiles", "avg_score", "best_score", "worst_score", "n_dockings", "scores")
    assert got == [
        ("complete", "S1", "AA_1", "L1", "CCO", -7.4, -7.6, -7.2, 2, [-7.2, -7.6]),
        ("incomplete", "S1", "AA_2", "L2", None, -5.0, -5.0, -5.0, 1, [-5.0]),
    ]
    assert text.read_summaries(spark, str(tmp_path)).count() == 3


def test_summaries_in_tranche_archives(spark, tmp_path):
    put(tmp_path / "complete/S1/summaries/AA/AA.tar", tar_of({"AA/1.txt.gz": gzip.compress(SHELL.encode())}, "w"))
    put(tmp_path / "incomplete/S1/summaries/AA/AA/2.txt", AWS)
    got = text.read_summaries(spark, str(tmp_path), "S1", layout="tranche")
    assert rows(got, "state", "ligand") == [("complete", "L1"), ("incomplete", "L2")]


def test_summary_text(spark, tmp_path):
    results = spark.createDataFrame(
        [("S", "AAB_1", "L1", 1, -7.2), ("S", "AAB_1", "L1", 2, -7.6), ("S", "AAB_1", "L2", 1, -5.0)],
        "scenario STRING, collection STRING, ligand STRING, replica INT, score DOUBLE",
    )
    sinks.write_summary_text(ligand_summary(results), str(tmp_path / "s"), 2)
    files = list((tmp_path / "s").rglob("*.txt.gz"))
    assert len(files) == 1
    lines = gzip.decompress(files[0].read_bytes()).decode().splitlines()
    assert lines[0].split() == ["Tranch", "Compound", "average-score", "maximum-score", "number-of-dockings", "score-replica-1", "score-replica-2"]
    assert [line.split() for line in lines[1:]] == [["AAB_1", "L1", "-7.4", "-7.6", "2", "-7.2", "-7.6"], ["AAB_1", "L2", "-5.0", "-5.0", "1", "-5.0"]]


def test_status_lists(spark, tmp_path):
    lines = "L3 failed(ligand_elements: Si )\nL5 failed(ligand_coordinates)\nL1 1 2 succeeded total-time:1500\nL2 1 1 processing\nL4 1 1 failed(docking) total-time:10\n"
    put(tmp_path / "t/AA/AAAB/00000.status.gz", gzip.compress(lines.encode()))
    got = rows(text.read_status(spark, str(tmp_path / "t"), "text"), "collection", "ligand", "scenario", "replica", "status", "info", "seconds")
    assert got == [
        ("AAAB_00000", "L1", "1", 2, "succeeded", None, 1.5),
        ("AAAB_00000", "L2", "1", 1, "processing", None, None),
        ("AAAB_00000", "L3", None, None, "failed", "ligand includes elements: Si", None),
        ("AAAB_00000", "L4", "1", 1, "failed(docking)", None, 0.01),
        ("AAAB_00000", "L5", None, None, "failed", "duplicate coordinates", None),
    ]
    objects = [
        {"ligand": "L3", "status": "failed", "info": "ligand includes elements: Si"},
        {"ligand": "L1", "scenario_key": "S1", "replica_index": 0, "status": "succeeded", "seconds": "1.50", "score": -7.2},
    ]
    put(tmp_path / "j/AA/AAAB/00000.json.gz", gzip.compress(json.dumps(objects, indent=4).encode()))
    got = rows(text.read_status(spark, str(tmp_path / "j"), replica_base=0), "collection", "ligand", "scenario", "replica", "status", "seconds", "score")
    assert got == [("AAAB_00000", "L1", "S1", 1, "succeeded", 1.5, -7.2), ("AAAB_00000", "L3", None, None, "failed", None, None)]


def test_status_round_trip(spark, tmp_path):
    status = spark.createDataFrame(
        [("A_1", "L1", "S1", 1, "succeeded", None, 1.25, -7.2), ("A_2", "L2", None, None, "failed", "ligand includes elements: Sn", None, None)],
        "collection STRING, ligand STRING, scenario STRING, replica INT, status STRING, info STRING, seconds DOUBLE, score DOUBLE",
    )
    for fmt, read in (("json", "jsonl"), ("text", "text")):
        sinks.write_status(status, str(tmp_path / fmt), fmt)
        back = text.read_status(spark, str(tmp_path / fmt), read)
        cols = [c for c in status.columns if fmt == "json" or c != "score"]
        assert rows(back, *cols) == rows(status, *cols)


def test_done_and_logs(spark, tmp_path):
    put(tmp_path / "done/1/1/1-1-1", "A_1 was completed by queue 1-1-1 on Mon. Ligands-started:5 Ligands-succeeded:4 Ligands-failed:1  Dockings-started:10 Dockings-succeeded:8\n")
    row = text.read_done(spark, str(tmp_path / "done")).first()
    assert tuple(row) == ("A_1", "1-1-1", 5, 4, 1, 10, 8, None)
    put(tmp_path / "out/S1/logfiles/AA/AAAB/00000/Z1_x_replica-0", "STDOUT:\n   1  -7.1  0\n")
    got = rows(text.read_logs(spark, str(tmp_path / "out"), replica_base=0), "collection", "ligand", "scenario", "replica", "log")
    assert got == [("AAAB_00000", "Z1_x", "S1", 1, "STDOUT:\n   1  -7.1  0\n")]


def test_batch_status(spark, tmp_path):
    attempts = [{"statusReason": "host lost"}, {"startedAt": 1, "stoppedAt": 5, "statusReason": "Essential container in task exited"}]
    subjobs = {"0": {"collections": [["A_1", 5], ["A_2", 6]], "status": "SUCCEEDED", "detailed_status": {"container": {"vcpus": 8}, "attempts": attempts}}, "1": {"collections": [["A_3", 7]]}}
    content = {"overall": {}, "workunits": {"1": {"status": {"other": 1, "job_id": "j", "aws_batch_status": "RUNNING"}, "subjobs": subjobs}, "2": {"subjobs": {}}}, "collections": {}}
    put(tmp_path / "status.json", json.dumps(content, indent=1))
    tables = nested.read_batch_status(spark, str(tmp_path / "status.json"))
    assert rows(tables["workunit"], "*") == [(1, "j", "RUNNING")]
    assert rows(tables["subjob"], "workunit", "subjob", "status", "vcpus", "n_ligands") == [(1, 0, "SUCCEEDED", 8, 11), (1, 1, None, None, 7)]
    assert rows(tables["attempt"], "*") == [(1, 0, 0, None, None, "host lost"), (1, 0, 1, 1, 5, "Essential container in task exited")]


def test_batch_status_lines(spark, tmp_path):
    """F8, F10: lines are parsed by `from_json`, only the fields of the table asked for, and give what the JSON source gave."""
    # Without blanks: an object in place of a text is given without those between its parts.
    dumps = lambda o: json.dumps(o, separators=(",", ":")).encode()
    attempt = {"startedAt": 1, "stoppedAt": 5, "statusReason": "it's \"1\": {"}
    subjobs = {"0": {"collections": [["A_1", 5], ["A_2", "x"]], "status": "S", "detailed_status": {"container": {"vcpus": 8}, "attempts": [{"statusReason": "lost"}, attempt]}}, "x": {"status": {"7": {"a": 1}}}, "2": None}
    unit = lambda key, **more: {"workunits": {key: {"status": {"job_id": "j"}, "subjobs": subjobs, **more}}}
    bad = {"status": 5, "collections": "none", "detailed_status": {"container": {"vcpus": "many"}, "attempts": [{"startedAt": "soon", "statusReason": "r"}]}}
    odd = [unit("1"), unit("1"), unit("no number"), [unit("4"), unit("5")], {}, {"workunits": None}, {"workunits": {"6": None}}, {"workunits": {"7": {}}}, {"workunits": {"8": {"subjobs": {"1": bad, "2": subjobs["0"]}}}}, 3, None]
    lines = [dumps(o) for o in odd] + [b"", b"{broken", dumps(unit("9"))[:-2], dumps(unit("10", note="?")).replace(b"?", b"\xff")]
    lines += [dumps(unit(str(100 + k))) for k in range(50)]
    put(tmp_path / "status.jsonl", b"\n".join(lines))
    path = str(tmp_path / "status.jsonl")
    before = nested.batch_tables(spark.read.schema(schemas.BATCH_STATUS_JSON).json(path))
    now = nested.read_batch_status(spark, path, multiline=False)
    assert list(now) == list(before)
    for name, table in now.items():
        assert table.schema == before[name].schema
        assert sorted(map(str, table.collect())) == sorted(map(str, before[name].collect())), name
    assert now["attempt"].where("workunit >= 100").count() == 100
    plan = now["attempt"]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan json" not in plan and "vcpus" not in plan and "FileScan text" in plan


def test_results_tree(spark, tmp_path):
    schema = "state STRING, scenario STRING, collection STRING, ligand STRING, score DOUBLE"
    first = spark.createDataFrame([("incomplete", "S", "AAB_1", "x", -1.0), ("incomplete", "S", "AAB_2", "y", -2.0)], schema)
    second = spark.createDataFrame([("complete", "S", "AAB_1", "x", -1.5), ("incomplete", "S", "AAB_2", "z", -3.0)], schema)
    third = spark.createDataFrame([("complete", "S", "AAB_3", "w", -4.0)], schema)
    for level in ("collection", "tranche"):
        root = str(tmp_path / level)
        for batch in (first, second, third):
            sinks.write_results(batch, root, level)
        got = rows(sinks.read_results(spark, root), "state", "collection", "ligand", "score")
        assert got == [("complete", "AAB_1", "x", -1.5), ("complete", "AAB_3", "w", -4.0), ("incomplete", "AAB_2", "z", -3.0)]


def test_worklists(spark, tmp_path):
    bins = spark.createDataFrame([("A_1", 5, 0), ("A_2", 6, 1), ("A_3", 7, 2)], "collection STRING, n_ligands INT, bin LONG")
    sinks.write_worklists(group_workunits(bins, 2, 1), str(tmp_path / "w"))
    back = spark.read.text(str(tmp_path / "w"))
    assert rows(back, "workunit", "subjob", "value") == [(1, 0, "A_1 5"), (1, 1, "A_2 6"), (2, 0, "A_3 7")]
    assert back.select(F.input_file_name().alias("f")).distinct().count() == 3
