"""Batch status, report counts and run totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.contracts import CONTRACT_VERSION, HARD_FAIL, QUARANTINE, STATUS_ACTIONS, WARN


def batch_status(hard: Column, quarantined: Column, warned: Column) -> Column:
    """Status from the number of failures of each severity."""
    return (
        F.when(hard > 0, "FAILED")
        .when(quarantined > 0, "PASSED_WITH_QUARANTINE")
        .when(warned > 0, "PASSED_WITH_WARNINGS")
        .otherwise("PASSED")
    )


def pipeline_action(status: Column) -> Column:
    action = None
    for name, value in STATUS_ACTIONS.items():
        action = F.when(status == name, value) if action is None else action.when(status == name, value)
    return action


def severity_counts(counted: dict[str, Column]) -> Column:
    """Map of severity to count that lists only severities that occurred."""
    entries = [F.when(n > 0, F.struct(F.lit(s).alias("key"), n.alias("value"))) for s, n in counted.items()]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def dataset_report(stage: DataFrame, failures: DataFrame, dataset: str) -> DataFrame:
    """One report row, also for an empty batch.

    ``stage`` has one row per non-blank line (problem); ``failures`` one row per
    failure (source_file, line_number, severity).  A batch with a malformed line
    counts only its malformed lines.
    """
    lines = stage.agg(F.count("*").alias("lines"), F.count("problem").alias("malformed"))
    broken = failures.agg(
        F.count_if(F.col("severity") == HARD_FAIL).alias("hard"),
        F.count_if(F.col("severity") == QUARANTINE).alias("quarantined"),
        F.count_if(F.col("severity") == WARN).alias("warned"),
        F.count_distinct(F.when(
            F.col("severity") != WARN, F.struct("source_file", "line_number"))).alias("invalid"))
    counts = lines.unionByName(broken, allowMissingColumns=True)
    folded = counts.agg(*[F.sum(c).alias(c) for c in counts.columns])
    hard, quarantined, warned = F.col("hard"), F.col("quarantined"), F.col("warned")
    total = F.when(F.col("malformed") > 0, F.col("malformed")).otherwise(F.col("lines"))
    status = batch_status(hard, quarantined, warned)
    return folded.select(
        F.lit(dataset).alias("dataset"),
        F.lit(CONTRACT_VERSION).alias("contract_version"),
        status.alias("batch_status"),
        pipeline_action(status).alias("pipeline_action"),
        total.alias("total_records"),
        (total - F.col("invalid")).alias("valid_records"),
        F.col("invalid").alias("invalid_records"),
        warned.alias("warning_count"),
        severity_counts({HARD_FAIL: hard, QUARANTINE: quarantined, WARN: warned})
        .alias("error_count_by_severity"),
    )


def overall_status(reports: DataFrame) -> DataFrame:
    """FAILED when any dataset failed."""
    return reports.agg(
        F.when(F.count_if(F.col("batch_status") == "FAILED") > 0, "FAILED")
        .otherwise("PASSED").alias("overall_status"))


def dataset_summaries(reports: DataFrame) -> DataFrame:
    """Per-dataset totals with invalid rows split into quarantined and rejected."""
    status, action = F.col("batch_status"), F.col("pipeline_action")
    total, invalid, valid = F.col("total_records"), F.col("invalid_records"), F.col("valid_records")
    return reports.select(
        "dataset",
        status.alias("status"),
        "pipeline_action",
        total.alias("rows_received"),
        F.when((valid == 0) & (total > 0), F.greatest(total - invalid, F.lit(0)))
        .otherwise(valid).alias("rows_valid"),
        invalid.alias("rows_invalid"),
        F.when((status == "PASSED_WITH_QUARANTINE") | (action == "UPLOAD_VALID_RECORDS_ONLY"),
               invalid).otherwise(0).cast("bigint").alias("rows_quarantined"),
        F.when((status == "FAILED") | (action == "BLOCK_S3_UPLOAD"),
               invalid).otherwise(0).cast("bigint").alias("rows_rejected"),
        F.col("warning_count").alias("warnings"),
    )


def run_summary(reports: DataFrame) -> DataFrame:
    """Totals over all datasets of a run."""
    counts = ["rows_received", "rows_valid", "rows_invalid",
              "rows_quarantined", "rows_rejected", "warnings"]
    return dataset_summaries(reports).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
