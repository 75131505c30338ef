"""Published inventories: exact hash, set and content differences, marker match."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.workspace import settle


#: Bytes of formatted lines that the chained digest takes at once.
CHUNK_BYTES = 1 << 20


def _formatted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A range of sorted lines as large pieces of text, numbered in order."""
    part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

    def piece() -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "number": [number], "lines": ["\n".join(held).encode()]})

    for batch in batches:
        for line in batch["entry"]:
            held.append(line)
            size += len(line)
            if size >= CHUNK_BYTES:
                yield piece()
                number, held, size = number + 1, [], 0
    if held:
        yield piece()


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    digest, first = hashlib.sha256(), True
    for batch in batches:
        for lines in batch["lines"]:
            digest.update(lines if first else b"\n" + lines)
            first = False
    yield pd.DataFrame({"inventory_sha256": [digest.hexdigest()]})


def inventory_sha256(files: DataFrame) -> DataFrame:
    """One row: SHA-256 over the ``key|size|sha256`` lines sorted by key, newline-joined.

    Sorting and formatting are spread over range partitions, written as pieces
    of about a megabyte.  Only the digest itself is sequential by definition:
    one task streams the finished pieces, a handful of rows, in order.
    """
    lines = files.select(
        "relative_key",
        F.concat_ws("|", "relative_key", F.col("size").cast("string"), "sha256").alias("entry"))
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = settle(
        lines.repartitionByRange(parts, "relative_key").sortWithinPartitions("relative_key").select("entry")
        .mapInPandas(_formatted, "part int, number int, lines binary"), "inventory")
    ordered = pieces.repartition(1).sortWithinPartitions("part", "number").select("lines")
    return ordered.mapInPandas(_chained, "inventory_sha256 string")


def inventory_diff(expected: DataFrame, published: DataFrame) -> DataFrame:
    """relative_key, problem — both sides hold relative_key, size, sha256."""
    left = expected.select("relative_key", F.col("size").alias("want_size"),
                           F.col("sha256").alias("want_sha256"))
    right = published.select("relative_key", F.col("size").alias("have_size"),
                             F.col("sha256").alias("have_sha256"))
    problem = (
        F.when(F.col("have_size").isNull(), "missing")
        .when(F.col("want_size").isNull(), "unexpected")
        .when(F.col("have_size") != F.col("want_size"), "size mismatch")
        .when(~F.col("have_sha256").eqNullSafe(F.col("want_sha256")), "checksum mismatch"))
    return (
        left.join(right, "relative_key", "full_outer")
        .select("relative_key", problem.alias("problem"))
        .filter(F.col("problem").isNotNull()))


def set_difference(found: DataFrame, expected: DataFrame, column: str) -> DataFrame:
    """Names present on one side only, labelled missing or unexpected."""
    names = [found.select(column), expected.select(column)]
    return (
        names[1].exceptAll(names[0]).withColumn("problem", F.lit("missing"))
        .unionByName(names[0].exceptAll(names[1]).withColumn("problem", F.lit("unexpected"))))


MARKER_FIELDS = ("run_id", "manifest_sha256", "inventory_sha256", "data_file_count",
                 "records_partitioned")


def marker_matches(marker: str, batch: str) -> Column:
    """Completion marker (alias ``marker``) agrees with the batch (alias ``batch``)."""
    agrees = F.col(f"{marker}.status") == "COMPLETE"
    for name in MARKER_FIELDS:
        agrees = agrees & F.col(f"{marker}.{name}").eqNullSafe(F.col(f"{batch}.{name}"))
    return F.coalesce(agrees, F.lit(False))
