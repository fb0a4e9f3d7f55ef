"""Logs of finished collections: work for a member and for a path does not grow with the archive or the folders above."""

import io
import re
import tarfile

import pytest

from screenlake.sources import archives, nested, text

LOG_PATH = r"([^/]+)/logfiles/([^/]+)/([^/]+)/([^/]+)/(.+)_replica-([0-9]+)[^/]*$"


def test_the_path_of_a_log_is_searched_once(spark):
    """five searches a path, each from every letter of every folder name, took most of the time."""
    ends = ["S/logfiles/M/T/I/L_replica-2", "S/logfiles/M/T/I/a/L_replica-1_replica-3.gz", "logfiles/S/logfiles/M/T/I/L_replica-1", "S/logfiles/M//I/L_replica-1", "S/logfiles/M/T/L_replica-1",
            "S/logfiles/M/T/I/_replica-1", "S/logfiles/M/T/I/L_replica-99999999999", "S/logfiles/M/T/I/L_replica-x", "S\n/logfiles/M/T/I/L_replica-1\n", "S/logfiles/M/T/I/L\n_replica-1"]
    paths = [None, "", *(f"{top}{end}" for top in ("", "/", "file:/r/" + "x" * 90 + "/") for end in ends)]
    got = text.log_rows(spark.createDataFrame([(p, p) for p in paths], "path STRING, text STRING"), replica_base=0)
    rows = {r["log"]: tuple(r)[:4] for r in got.collect()}
    for path in paths:
        found = re.search(LOG_PATH, path or "")
        scenario, _, tranche, number, ligand, replica = found.groups() if found else [""] * 6
        replica = int(replica) + 1 if found and int(replica) < 2**31 else None
        assert rows[path] == (f"{tranche}_{number}", ligand, scenario, replica) if path is not None else ("", None, None, None), path
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"regexp_extract\(path#", plan)) == 1


@pytest.mark.parametrize("name", ["", "a", "d/é", "x" * 100, "x" * 101, "é" * 51, "\udc80"])
@pytest.mark.parametrize("size", [0, 1, 513, 8**11 - 1, 8**11])
def test_headers_are_those_of_tarfile(name, size):
    info = tarfile.TarInfo(name)
    info.size = size
    assert archives.header_of(name, size) == info.tobuf(tarfile.GNU_FORMAT)


def _tar(names, kind=tarfile.REGTYPE, **fields):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name in names:
            info = tarfile.TarInfo(name)
            info.size, info.type = (700 if kind in (tarfile.REGTYPE, tarfile.AREGTYPE) else 0), kind
            for field, value in fields.items():
                setattr(info, field, value)
            tar.addfile(info, io.BytesIO(b"x" * 700))
    return out.getvalue()


def _listed(data):
    try:
        return archives.index(io.BytesIO(data))
    except archives.BadArchive as exc:
        return str(exc)


def test_plain_archives_are_indexed_without_tarfile(monkeypatch):
    """F1: tarfile took some 20 microseconds a member; it is left for what is not plain, and says the same."""
    plain = [_tar([]), _tar(["a/1", "a/2", "a/3"]), _tar(["b"], mtime=1_700_000_000, uid=1000)]
    special = [_tar(["x" * 120, "b"]), _tar(["a"], kind=tarfile.DIRTYPE), _tar(["é"], mtime=0.5), _tar(["a"], kind=tarfile.AREGTYPE)]
    whole = plain[1]
    wrong = bytearray(whole)
    wrong[1200 + 512] ^= 1
    broken = [whole[:cut] for cut in (0, 100, 512, 600, 1212, 1536, 1600, 4608)] + [bytes(wrong), whole[:512] + b"?" * 512, b"no archive" * 200]
    now = [_listed(data) for data in plain + special + broken]
    with monkeypatch.context() as m:
        m.setattr(archives, "_plain_members", lambda file: None)
        assert now == [_listed(data) for data in plain + special + broken]
    assert [x.name for x in now[1]] == ["a/1", "a/2", "a/3"] and [x.name for x in now[3]] == ["x" * 120, "b"]

    def no(*args, **kwargs):
        raise AssertionError("tarfile is asked")

    monkeypatch.setattr(tarfile, "open", no)
    packed = archives.gzip_tar((f"a/{i}", b"t" * i) for i in range(1500))
    assert [len(t) for _, t in archives.members(archives.Entry("x", packed))] == list(range(1500))
    assert [_listed(data) for data in plain] == now[:3]
