"""Events far behind the newest event of their batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.contracts import LATE_AFTER_DAYS
from paylens.functions.calendar import whole_days_between


def late_rows(rows: DataFrame, time: str = "event_time") -> DataFrame:
    """Rows more than a year of whole days behind the batch maximum, with ``days_behind``.

    The maximum is a one-row scalar subquery; no join and no shuffle of rows.
    """
    newest = rows.agg(F.max(time)).scalar()
    return (
        rows.withColumn("days_behind", whole_days_between(F.col(time), newest))
        .filter(F.col("days_behind") > LATE_AFTER_DAYS)
    )
