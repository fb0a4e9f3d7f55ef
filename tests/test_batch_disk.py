"""Batch status lines on disk: compressed, in files of bounded lines."""

import gzip

from pyspark.sql import functions as F

from screenlake.catalog import files as catalog


def test_status_lines_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    """plain lines took some 300 bytes an attempt, 1.1 GB for 3.6 million."""
    n = 2000
    spark.range(0, n, 1, 2).selectExpr(
        "id DIV 4 AS l_orderkey", "id * 7 AS l_partkey", "id % 10 AS l_suppkey", "CAST(id % 4 + 1 AS INT) AS l_linenumber", "CAST(id % 50 AS DOUBLE) AS l_quantity",
        "id * 13.5D AS l_extendedprice", "CAST(id % 3 AS DOUBLE) AS l_discount", "0.01D AS l_tax", "'A' AS l_returnflag", "IF(id % 2 = 0, 'F', 'O') AS l_linestatus", "current_timestamp() AS l_shipdate",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    folders = []

    def folder(session, name):
        folders.append(tmp_path / f"{name}-{len(folders)}")
        return str(folders[-1])

    monkeypatch.setattr(catalog, "shared_path", folder)
    monkeypatch.setattr(catalog, "LINES_PER_FILE", 300)
    attempts = catalog.s6_batch_attempts(spark, str(tmp_path))
    assert attempts.count() == n and attempts.where("started_at IS NULL AND attempt_no = 0").count() == len(range(0, n, 3))
    subjobs = catalog.s6_batch_subjobs(spark, str(tmp_path))
    assert subjobs.count() == n // 4
    assert subjobs.agg(F.sum("n_rows"), F.sum("n_ligands"), F.min("n_ligands"), F.max("n_ligands")).first() == (n, n // 4 * 38, 38, 38)
    assert len(folders) == 2
    for root in folders:
        parts = list(root.glob("part-*"))
        assert len(parts) == 8 and all(p.suffix == ".gz" for p in parts)
        lines = [gzip.decompress(p.read_bytes()).count(b"\n") for p in parts]
        assert sum(lines) == n and max(lines) <= 300
        assert sum(p.stat().st_size for p in parts) < sum(len(gzip.decompress(p.read_bytes())) for p in parts) / 5
