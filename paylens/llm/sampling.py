"""Deterministic samples of about a given number of rows per group, and bounded parts of long texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Windows that a long text is learnt from; the first begins it, the last ends it.
WINDOWS = 16


def about(rows: DataFrame, group: str, number: int, draw: Column) -> DataFrame:
    """All rows of groups with at most ``number`` rows, else about that many.

    ``draw`` is a 64-bit hash of the row; a row belongs to the sample by its own
    hash alone, so no group is sorted or gathered.  ``rows`` is read twice.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(group).count().collect()}
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col(group) == F.lit(value), F.lit(min(1.0, number / count))).otherwise(share)
    return rows.filter(F.pmod(draw, F.lit(1 << 30)) < share * (1 << 30))


def spread(text: Column, characters: int) -> Column:
    """``text``, or of a longer one ``WINDOWS`` windows of ``characters`` in all, spread evenly over it."""
    size = characters // WINDOWS
    starts = [F.floor((F.length(text) - size) * i / (WINDOWS - 1)).cast("int") + 1 for i in range(WINDOWS)]
    windows = F.concat_ws(" ", *[F.substr(text, start, F.lit(size)) for start in starts])
    return F.when(F.length(text) > characters, windows).otherwise(text)
