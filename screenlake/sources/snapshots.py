"""Snapshots: small numbered files that say which folders make up a table.

Data is written to folders of its own first; the next number then names them, in one rename. Readers take the
highest number, so they see all of a change or nothing of it. Folders that the last snapshots do not name are
left over from failures or replaced, and are removed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_snapshots"
# Snapshots kept for readers that opened them before the newest came.
KEPT = 2


class Outdated(Exception):
    """Another writer made the next snapshot first."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    store, where = _store(spark, folder), _path(spark, folder)
    return sorted(f.getPath().getName() for f in store.listStatus(where)) if store.exists(where) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:-5]) for n in list_names(spark, f"{root}/{FOLDER}") if n.endswith(".json") and n[:-5].isdigit())


def read(spark: SparkSession, root: str, version: int) -> dict:
    stream = _store(spark, root).open(_path(spark, f"{root}/{FOLDER}/{version}.json"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def current(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest snapshot; 0 and nothing where there is none."""
    known = versions(spark, root)
    return (known[-1], read(spark, root, known[-1])) if known else (0, {})


def commit(spark: SparkSession, root: str, version: int, content: dict) -> None:
    """Make `content` the snapshot of this number; Outdated if there is one by now."""
    store, final = _store(spark, root), _path(spark, f"{root}/{FOLDER}/{version}.json")
    part = _path(spark, f"{root}/{FOLDER}/.{version}.{uuid.uuid4().hex}")
    stream = store.create(part, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    if store.exists(final) or not store.rename(part, final):
        store.delete(part, False)
        raise Outdated(f"{root}: snapshot {version} exists")


def new_folder(root: str) -> str:
    """Name, below `root`, of a folder for data of a coming snapshot."""
    return f"data-{uuid.uuid4().hex}"


def clean(spark: SparkSession, root: str, used) -> None:
    """Remove old snapshots, and data folders that no kept one uses; `used` lists the folders of a content.

    Only the one writer of a table may clean: a folder being written is named by no snapshot yet.
    """
    store, known = _store(spark, root), versions(spark, root)
    for old in known[:-KEPT]:
        store.delete(_path(spark, f"{root}/{FOLDER}/{old}.json"), False)
    wanted = {name for v in known[-KEPT:] for name in used(read(spark, root, v))}
    for name in list_names(spark, root):
        if name.startswith("data-") and name not in wanted:
            store.delete(_path(spark, f"{root}/{name}"), True)
