"""RAW landing: one run's published files as VARIANT rows with lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.contracts import DATASETS
from paylens.functions.identifiers import check_run_id, plain_uri
from paylens.sources.files import JSON_FILES
from paylens.sources.jsonl import read_json_lines

RAW_SCHEMA = ("raw_record variant, pipeline_run_id string, source_file string, "
              "source_row_number bigint, loaded_at timestamp_ntz")


def strict_records(parsed: DataFrame, what: str) -> DataFrame:
    """Stop the job at the first malformed line instead of keeping it."""
    place = [F.lit(" line "), F.col("line_number").cast("string")] if "line_number" in parsed.columns else []
    complaint = F.concat(
        F.lit(f"{what}: "), F.col("problem"), F.lit(" ("), F.col("source_file"), *place, F.lit(")"))
    return parsed.withColumn(
        "record", F.when(F.col("problem").isNull(), F.col("record"))
        .otherwise(F.raise_error(complaint).cast("variant")))


def land_dataset(spark: SparkSession, published_root: str, run_id: str, dataset: str,
                 loaded_at: str | None = None) -> DataFrame:
    """RAW rows of ``<root>/run_id=<id>/<dataset>/**/*.json`` (or ``.json.gz``); any bad line aborts.

    The folder path is the partition pruning: other runs are never listed.
    """
    check_run_id(run_id)
    folder = f"{published_root.rstrip('/')}/run_id={run_id}/{dataset}"

    def below_run(path: Column) -> Column:
        return F.regexp_extract(plain_uri(path), f"(run_id={run_id}/.*)$", 1)

    rows = strict_records(read_json_lines(spark, folder, JSON_FILES, below_run), f"load of {dataset}")
    load_time = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    return rows.select(
        F.col("record").alias("raw_record"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.col("file_name").alias("source_file"),
        F.col("line_number").alias("source_row_number"),
        load_time.cast("timestamp_ntz").alias("loaded_at"),
    )


def land_run(spark: SparkSession, published_root: str, run_id: str,
             loaded_at: str | None = None) -> dict[str, DataFrame]:
    return {n: land_dataset(spark, published_root, run_id, n, loaded_at) for n in DATASETS}


def with_lineage_columns(older: DataFrame) -> DataFrame:
    """An older RAW table brought to the current schema; added columns are null."""
    empty = older.sparkSession.createDataFrame([], RAW_SCHEMA)
    return older.unionByName(empty, allowMissingColumns=True).select(*empty.columns)
