"""What tasks hold at once, and what they read, does not grow with the tables."""

import gzip

from pyspark.sql import Row
from pyspark.sql import functions as F

from screenlake.catalog.live import _in_batches
from screenlake.llm.near_dedup import near_duplicate_classes
from screenlake.operators.summary import ligand_summary
from screenlake.plans.screen import screen
from screenlake.session import BATCH_SETTING, small_batches
from screenlake.sources import archives, nested, sinks, text
from screenlake.streaming.live import TaskStates


def test_rows_leave_in_bounded_batches(spark):
    schema = archives.arrow_schema("a STRING, n LONG")
    many = list(archives.batches_of(((str(i), i) for i in range(25_000)), schema))
    assert [b.num_rows for b in many] == [10_000, 10_000, 5_000]
    assert [r for r in archives.rows_of(many)] == [(str(i), i) for i in range(25_000)]
    long = list(archives.batches_of((("x" * (1 << 20), i) for i in range(10)), schema))
    assert [b.num_rows for b in long] == [4, 4, 2]
    assert list(archives.batches_of([], schema)) == []


def test_members_of_an_archive_come_in_few_batches(spark):
    content = archives.gzip_tar((f"L{i}_replica-1", f"log {i}".encode()) for i in range(3000))
    packed = spark.createDataFrame([("/out/S1/logfiles/AB/AB01/7.tar.gz", bytearray(content))], nested.ARCHIVE)
    got = {r["ligand"]: r["log"] for r in text.log_rows(nested.unpack_files(packed)).collect()}
    assert got == {f"L{i}": f"log {i}" for i in range(3000)}


def test_groups_stream_in_order(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("t"))

    def make(key, some):
        yield key[0], ",".join(str(v) for _, v, _ in some)

    got = dict(map(tuple, archives.per_group(rows, ["k"], ["v"], make, "k LONG, s STRING").collect()))
    assert got == {k: ",".join(map(str, sorted(i % 7 for i in range(1000) if i % 3 == k))) for k in range(3)}


def test_a_library_leaves_archives_only(spark, tmp_path):
    rows = [(f"AAAA_{c}", f"L{p}", "pdbqt", p, f"text {c} {p}") for c in range(3) for p in (2, 1)]
    ligands = spark.createDataFrame(rows, "collection STRING, ligand STRING, format STRING, pos INT, content STRING")
    archives.write_library(ligands, str(tmp_path / "lib"))
    assert sorted(str(p.relative_to(tmp_path / "lib")) for p in (tmp_path / "lib").rglob("*") if p.is_file() and not p.name.endswith(".crc")) == ["AA/AAAA.tar"]
    assert not [p for p in (tmp_path / "lib").iterdir() if p.name.startswith(".parts")]
    got = nested.read_ligands(spark, str(tmp_path / "lib")).select("collection", "ligand", "pos", "content", "error").collect()
    assert sorted(map(tuple, got)) == sorted((c, l, p, t, None) for c, l, _, p, t in rows)


def test_summary_text_is_a_file_per_collection(spark, tmp_path):
    def put(rows):
        results = spark.createDataFrame(rows, "scenario STRING, collection STRING, ligand STRING, replica INT, score DOUBLE")
        sinks.write_summary_text(ligand_summary(results, padded=True), str(tmp_path / "s"), 2)

    put([("a/b", "AA_1", "L1", 1, -1.0), ("a/b", "AA_2", "L2", 1, -2.0), (None, "AA_2", "L3", 1, -3.0)])
    put([("a/b", "AA_2", "L2", 1, -4.0), ("a/b", "AA_2", "L4", 2, -5.0)])
    files = [p for p in (tmp_path / "s").rglob("*.txt.gz")]
    assert sorted(p.name for p in files) == ["part-AA_1.txt.gz", "part-AA_2.txt.gz", "part-AA_2.txt.gz"]
    assert all(gzip.decompress(p.read_bytes()).startswith(b"Tranch ") for p in files)
    got = text.read_summaries(spark, str(tmp_path / "s"), layout="table").select("state", "scenario", "collection", "ligand", "best_score")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("complete", "a/b", "AA_1", "L1", -1.0), ("complete", "a/b", "AA_2", "L2", -4.0), ("complete", "a/b", "AA_2", "L4", -5.0), ("complete", None, "AA_2", "L3", -3.0)], key=repr
    )


class _State:
    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def exists(self):
        self.calls += 1
        return self.value is not None

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None


def test_a_task_asks_its_state_once():
    states, state = TaskStates(None, None), _State()
    states.state = state
    report = lambda *rows: list(states.handleInputRows(("k",), iter([Row(status=s, ts=t) for s, t in rows]), None))
    assert [tuple(r) for r in report(("succeeded", 5))] == [("k", "succeeded", 5, 5, None)] and state.calls == 1
    assert [tuple(r) for r in report(("processing", 3), ("processing", 2))] == [("k", "processing", 3, 2, None)] and state.calls == 3
    assert [tuple(r) for r in report(("failed", 9))] == [("k", "failed", 9, 2, None)] and state.calls == 5 and state.value is None


def test_files_of_a_stream_grow_with_its_input(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 12).select(F.col("id"), (F.col("id") % 5).alias("v"))
    stream = _in_batches(rows, str(tmp_path / "f"))
    assert len(list((tmp_path / "f").glob("part-*.parquet"))) == 24
    out = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "o"))
    out.awaitTermination()
    assert len([p for p in out.recentProgress if p["numInputRows"]]) == 3
    assert spark.read.parquet(str(tmp_path / "o")).distinct().count() == 4000


def test_workers_get_few_texts_at_once(spark):
    before = spark.conf.get(BATCH_SETTING)

    def sizes(frames):
        import pandas as pd

        yield pd.DataFrame({"n": [len(f) for f in frames]})

    with small_batches(spark, 100):
        largest = max(r["n"] for r in spark.range(1000).mapInPandas(sizes, "n LONG").collect())
    assert largest == 100 and spark.conf.get(BATCH_SETTING) == before
    ligands = spark.createDataFrame([("C_1", f"L{i}", "ATOM 1 C LIG 1 0 0 0 \n") for i in range(1200)], "collection STRING, ligand STRING, content STRING").coalesce(1)
    scenarios = spark.createDataFrame([(1, "s", "vina", 1)], "idx INT, name STRING, program STRING, replicas INT")
    assert screen(ligands, scenarios, lambda task: -1.0, partitions=1).results.count() == 1200
    docs = spark.createDataFrame([(i, f"some words of document {i // 2} and no other one") for i in range(20)], "doc_id LONG, text STRING")
    assert near_duplicate_classes(docs).select("class_id").distinct().count() == 10
    assert spark.conf.get(BATCH_SETTING) == before
