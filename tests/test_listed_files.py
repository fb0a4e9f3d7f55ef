"""Files below a folder are listed and read by tasks: those that Spark's readers find, and none of their names in the driver."""

import bz2
import gzip
import os
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from screenlake.sources import archives, text

LOOSE = "*_replica-*"


def put(path, data=b"x\n\r\ny\xff\x00z"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


@pytest.fixture
def tree(tmp_path):
    top = tmp_path / "t/S/logfiles/AB/T/I"
    for name in ("a_replica-1", "_a_replica-1", "_a=_replica-1", ".a_replica-1", "e mp%20ty_replica-2", "b_replica-1._COPYING_", "_metadata_replica-3", "no-replica", "x\ny_replica-7", "[a]{b}*_replica-5"):
        put(top / name)
    for name in ("_AB/T/I/h", ".AB/T/I/h", "_AB=1/T/I/h", "_metadata1/T/I/h", "A B%41/T/I/deep/er/h"):
        put(tmp_path / f"t/S/logfiles/{name}_replica-1")
    put(tmp_path / "t/top_replica-1")
    put(top / "empty_replica-1", b"")
    put(top / "zip_replica-1.GZ", gzip.compress(b"zipped") + gzip.compress(b"twice"))
    put(top / "zip_replica-1.bz2", bz2.compress(b"zipped") + bz2.compress(b"twice"))
    put(top / "zip_replica-1.deflate", zlib.compress(b"zipped"))
    os.symlink(top / "a_replica-1", top / "link_replica-9")
    os.symlink(top / "gone", top / "gone_replica-9")
    os.symlink(top.parent, tmp_path / "t/S/logfiles/AB/U")
    return tmp_path / "t"


def by_spark(spark, root):
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", LOOSE).text(root, wholetext=True)
    return text.log_rows(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def rows(logs):
    return sorted(map(tuple, logs.select("collection", "ligand", "scenario", "replica", F.hex("log")).collect()), key=repr)


@pytest.mark.parametrize("below", ["", "/S", "/*/logfiles", "/S/logfiles/{AB,A*}", "/S/logfiles/AB/T/I/a_replica-1"])
def test_loose_logs_are_those_that_spark_finds(spark, tree, below):
    root = f"{tree}{below}"
    assert rows(text.read_logs(spark, root)) == rows(by_spark(spark, root)) != []


@pytest.mark.parametrize("folders", [1, 3])
def test_folders_are_split_up_at_any_depth(spark, tree, folders, monkeypatch):
    monkeypatch.setattr(archives, "FOLDERS", folders)
    assert rows(text.read_logs(spark, str(tree))) == rows(by_spark(spark, str(tree)))


def test_the_driver_sees_no_names_of_logs(spark, tree):
    """Spark's reader keeps the state of every file in the driver; 256,000 logs held 240 MB of it."""
    logs = text.read_logs(spark, str(tree))
    assert logs.count() > 10
    assert logs.inputFiles() == []
    plan = logs._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "a_replica-1" not in plan
    entries = archives.list_entries(spark, str(tree), "*.bz2")
    assert [(r["path"].rsplit("/", 1)[1], r["size"] > 0) for r in entries.collect()] == [("zip_replica-1.bz2", True)] * 2
    assert entries.inputFiles() == []


def test_nothing_to_list(spark, tmp_path):
    assert text.read_logs(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        text.read_logs(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("codec", ["lz4", "snappy", "gzip", "deflate", "bzip2"])
def test_endings_are_unpacked_as_spark_does(spark, tmp_path, codec):
    values = ["hello", "a" * 300_000 + "".join(f"{i * i} " for i in range(120_000)) + "b" * 900_000]
    for value in values:
        spark.createDataFrame([(value,)], "value STRING").coalesce(1).write.mode("overwrite").option("compression", codec).text(str(tmp_path / "out"))
        (part,) = (tmp_path / "out").glob("part-*")
        packed = part.read_bytes()
        assert archives.UNPACK[part.suffix](packed) == f"{value}\n".encode()
        with pytest.raises((EOFError, ValueError, zlib.error)):
            archives.UNPACK[part.suffix](packed[:-3])
    whole = pa.compress(b"zst", codec="zstd", asbytes=True)
    assert archives.UNPACK[".zst"](whole) == b"zst"
