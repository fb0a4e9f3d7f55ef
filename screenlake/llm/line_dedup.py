"""Line dedup: lines held by several documents stay in one of them only.

Lines are exploded, normalised and hashed; documents are counted per hash; lines over the threshold
are dropped by position and the rest is joined again.
"""

from __future__ import annotations

import string

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from screenlake.llm.common import WHITE_SPACE, id_of, text_of, whole_row
from screenlake.operators.joins import salted_join


def line_key(line: Column) -> Column:
    """The line without white space at both ends and with A-Z in lower case."""
    trimmed = F.btrim(line, F.lit(WHITE_SPACE))
    plain = F.length(trimmed) == F.octet_length(trimmed)
    other = F.translate(trimmed, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(trimmed)).otherwise(other)


@F.pandas_udf(StringType())
def _without(text: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for whole, positions in zip(text, dropped):
        if positions is None:
            out.append(None)
            continue
        gone = set(positions.tolist())
        out.append("\n".join(x for i, x in enumerate(whole.split("\n")) if i not in gone))
    return pd.Series(out, dtype=object)


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Add n_lines, n_dropped and kept_text to every row of `docs` (doc_id, text, any others).

    A key of at least `min_chars` code points found in at least `min_docs` documents loses all its
    lines except those of the smallest doc_id holding it.

    Null text is empty text; empty text is one empty line. Rows with the same doc_id are one
    document. A null doc_id counts as one document after all others. Long texts need memory for
    their own lines only. An empty table gives an empty table. Columns named like the three new
    ones are replaced.

    Hashes are 128 bits wide. With the usual threshold of two documents the smallest and the largest
    id of a hash decide, so counting combines before the shuffle and a line that all documents share
    is no hot group; higher thresholds count distinct pairs of hash and document.
    """
    base = docs.select(
        whole_row(docs, "n_lines", "n_dropped", "kept_text").alias("_all"), text_of().alias("_text"), id_of().alias("_doc")
    ).withColumn("_check", F.xxhash64("_text"))
    key = line_key(F.col("_line"))
    lines = (
        base.select("_doc", "_check", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
        .where(F.length("_line") >= min_chars)
        .select("_doc", "_check", "_pos", key.alias("_key"))
        .where(F.length("_key") >= min_chars)
        .select("_doc", "_check", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))
    )
    held = lines.select("_h1", "_h2", "_doc")
    if min_docs == 2:
        shared = held.groupBy("_h1", "_h2").agg(F.min("_doc").alias("_keeper"), F.max("_doc").alias("_last"))
        shared = shared.where("_keeper < _last").drop("_last")
    else:
        shared = held.distinct().groupBy("_h1", "_h2").agg(
            F.min("_doc").alias("_keeper"), F.count(F.lit(1)).alias("_docs")
        ).where(F.col("_docs") >= min_docs).drop("_docs")
    dropped = (
        salted_join(lines, shared, ["_h1", "_h2"], "inner")
        .where("_doc > _keeper")
        .groupBy("_doc", "_check").agg(F.collect_set("_pos").alias("_dropped"))
    )
    changed = _without(F.when(F.col("_dropped").isNotNull(), F.col("_text")), F.col("_dropped"))
    return (
        base.join(dropped, ["_doc", "_check"], "left")
        .select(
            "_all.*",
            (F.length("_text") - F.length(F.replace("_text", F.lit("\n"))) + 1).cast("long").alias("n_lines"),
            F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
            F.coalesce(changed, F.col("_text")).alias("kept_text"),
        )
    )
