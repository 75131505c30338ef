"""Primary keys held by more than one record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    """Frequency of each non-null key; partial counts keep a hot key to one row per task."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies"))


def repeated_rows(rows: DataFrame, key: str) -> DataFrame:
    """Every copy of every key seen more than once.

    Count then semi-join, not a window per key: a key with a third of all rows
    never has to be sorted or buffered in one task.
    """
    repeated = key_counts(rows, key).filter("copies > 1").select(key)
    return rows.join(repeated, key, "left_semi")
