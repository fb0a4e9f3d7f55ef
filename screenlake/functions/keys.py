"""Collection keys: `<tranche>_<ID>`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tranche_of(key: Column) -> Column:
    return F.substring_index(key, "_", 1)


def metatranche_of(key: Column) -> Column:
    return F.substring(key, 1, 2)


def collection_id_of(key: Column, dialect: str = "shell") -> Column:
    """Text after the last `_` (shell) or after the first one (aws)."""
    if dialect == "shell":
        return F.substring_index(key, "_", -1)
    return F.regexp_extract(key, r"(?s)^[^_]*_(.*)$", 1)


def with_collection_parts(df: DataFrame, col: str = "collection", dialect: str = "shell") -> DataFrame:
    key = F.col(col)
    return df.withColumns(
        {
            "metatranche": metatranche_of(key),
            "tranche": tranche_of(key),
            "collection_id": collection_id_of(key, dialect),
        }
    )
