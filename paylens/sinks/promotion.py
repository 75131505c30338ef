"""Guarded load of a published run into RAW, promoted all tables at once."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.contracts import DATASETS
from paylens.functions.identifiers import check_run_id
from paylens.sinks.generations import Generation, commit, live_generation
from paylens.sinks.partitions import (
    expected_loads, partition_problems, read_partition_manifest)
from paylens.sinks.snapshots import require_no_problems
from paylens.sources.landing import RAW_SCHEMA, land_run, with_lineage_columns
from paylens.workspace import TABLE_CODEC, Storage, together

def load_facts(landed: dict[str, DataFrame], run_id: str) -> DataFrame:
    """Per dataset: rows, files, rows of another run, rows without file or row number."""
    frames = []
    for name, rows in landed.items():
        counted = rows.agg(
            F.count("*").alias("row_count"),
            F.count_distinct("source_file").alias("file_count"),
            F.count_if(~F.col("pipeline_run_id").eqNullSafe(F.lit(run_id))).alias("wrong_run_rows"),
            F.count_if(F.col("source_file").isNull()).alias("missing_source_files"),
            F.count_if(F.col("source_row_number").isNull()).alias("missing_row_numbers"))
        frames.append(counted.select(F.lit(name).alias("dataset"), "*"))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def guardrail_problems(facts: DataFrame, expected: DataFrame) -> DataFrame:
    """dataset, problem — every way in which a load differs from its manifest."""
    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    c = F.col
    checks = F.array(
        F.when(~c("row_count").eqNullSafe(c("expected_rows")),
               text("expected ", c("expected_rows"), " rows, found ", c("row_count"))),
        F.when(~c("file_count").eqNullSafe(c("expected_files")),
               text("expected ", c("expected_files"), " files, found ", c("file_count"))),
        F.when(c("wrong_run_rows") != 0,
               text("found ", c("wrong_run_rows"), " rows with an incorrect or missing run ID")),
        F.when(c("missing_source_files") != 0,
               text("found ", c("missing_source_files"), " rows without source_file metadata")),
        F.when(c("missing_row_numbers") != 0,
               text("found ", c("missing_row_numbers"),
                    " rows without source_row_number metadata")),
    )
    return expected.join(facts, "dataset", "left").na.fill(0).select(
        "dataset", F.explode(F.array_compact(checks)).alias("problem"))


def raw_version(spark: SparkSession, warehouse: str) -> str | None:
    """Folder of the live RAW version, or None before the first promotion."""
    return live_generation(spark, warehouse).raw_folder(warehouse)


def read_raw(spark: SparkSession, warehouse: str, generation: Generation | None = None) -> dict[str, DataFrame]:
    """The RAW tables of the live or the given generation (older ones get the lineage columns they lack)."""
    version = (generation or live_generation(spark, warehouse)).raw_folder(warehouse)
    if version is None:
        return {n: spark.createDataFrame([], RAW_SCHEMA) for n in DATASETS}
    return {n: with_lineage_columns(spark.read.parquet(f"{version}/{n}")) for n in DATASETS}


def write_raw_version(spark: SparkSession, warehouse: str, label: str,
                      landed: dict[str, DataFrame], version: str | None = None) -> str:
    """Stage the five tables as one new, not yet visible version; returns its name."""
    version = version or f"{label}-{uuid.uuid4().hex[:8]}"
    together({n: partial(rows.write.parquet, f"{warehouse}/raw/versions/{version}/{n}", compression=TABLE_CODEC)
              for n, rows in landed.items()})
    return version


def promote(spark: SparkSession, warehouse: str, version: str, base: Generation | None = None) -> Generation:
    """Make a staged version live, with the models of the generation before, in one atomic commit.

    ``base`` is the generation that was live when the work began (now, if not
    given).  If another commit came in between, nothing changes and
    ``ConcurrentCommit`` is raised.
    """
    return commit(spark, warehouse, base or live_generation(spark, warehouse), raw=version)


def load_run(spark: SparkSession, run_dir: str, published_root: str, run_id: str, warehouse: str,
             execute: bool = True, loaded_at: str | None = None) -> dict[str, DataFrame] | None:
    """Check the manifest, stage, check the staged tables, then promote.

    Any failure leaves the previous version live, also another load's commit in
    the meantime.  ``execute=False`` stops after the manifest check.
    """
    check_run_id(run_id)
    base = live_generation(spark, warehouse)
    require_no_problems(partition_problems(spark, run_dir, run_id), "Manifest check", warehouse)
    if not execute:
        return None
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"
    folder = f"{warehouse}/raw/versions/{version}"
    try:
        write_raw_version(
            spark, warehouse, run_id, land_run(spark, published_root, run_id, loaded_at), version)
        staged = {n: spark.read.parquet(f"{folder}/{n}") for n in DATASETS}
        expected = expected_loads(spark, *read_partition_manifest(spark, run_dir))
        require_no_problems(guardrail_problems(load_facts(staged, run_id), expected),
                            "Load check", warehouse)
        promote(spark, warehouse, version, base)
    except Exception:
        Storage(spark).delete(folder)
        raise
    return read_raw(spark, warehouse)
