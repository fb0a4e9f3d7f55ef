"""Documents to training sequences: STAGES are applied one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written and read
again before the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm.common import table
from screenlake.llm.line_dedup import dedup_lines
from screenlake.llm.mixing import mix_documents
from screenlake.llm.near_dedup import keep_first_of_classes
from screenlake.llm.packing import pack
from screenlake.llm.quality import THRESHOLD, fit, score_quality
from screenlake.session import remove_path, shared_path

# Columns that line dedup adds.
LINE_COLUMNS = ("n_lines", "n_dropped", "kept_text")


def _fresh(name: str, docs: DataFrame) -> str:
    """The name, made longer until no column of `docs` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold go."""
    model, score = fit(docs, table(spark, sf_dir, "labels")), _fresh("_quality", docs)
    return score_quality(docs, model, score).where(F.col(score) >= THRESHOLD).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars follows the text. A document of such lines only becomes empty."""
    # Columns of docs that are named like new ones stand aside.
    aside = {c: _fresh(f"_own_{c}", docs) for c in docs.columns if c.lower() in LINE_COLUMNS}
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    done = dedup_lines(docs.withColumnsRenamed(aside)).withColumns(new)
    return done.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the first by doc_id."""
    return keep_first_of_classes(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document appears as often as the mix takes it; those it does not take go."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; a document taken several times is packed several times."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
# Trained scores, sampling and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result but the last is written to the shared folder and read again.

    A result is removed when the next one is written; the last one, which the returned pieces may still
    be computed from, stays.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
