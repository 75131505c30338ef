"""Validated records, quarantined records, reports, failures and audit rows."""

from __future__ import annotations

import json
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.identifiers import utc_text
from paylens.functions.json_fields import stripped
from paylens.plans.validation import ROW_ID, Outcome
from paylens.sources.files import line_writer
from paylens.workspace import Storage, small_rows, together

AUDIT_FIELDS = (
    "contract_version", "batch_status", "pipeline_action", "total_records", "valid_records",
    "invalid_records", "warning_count", "error_count_by_severity")


def _write_lines(rows: DataFrame, path: str, keep_order: bool, compressed: bool = False) -> str:
    """Record text, one per line; ``keep_order`` range-sorts by file and line first."""
    ordered = rows.orderBy(*ROW_ID) if keep_order else rows
    lines = ordered.select(stripped(F.col("line")).alias("line"))
    line_writer(lines, compressed).mode("overwrite").text(path)
    return path


def _write_split(spark: SparkSession, outcome: Outcome, wanted: dict[str, str], keep_order: bool,
                 compressed: bool = False) -> None:
    """Valid and quarantined lines from one pass over the stage, each to its folder."""
    if len(wanted) < 2:
        for kind, path in wanted.items():
            rows = outcome.valid_rows if kind == "validated_file" else outcome.invalid_rows
            _write_lines(rows, path, keep_order, compressed)
        return
    # Beside the target, so that the folders only have to be renamed.
    storage = Storage(spark)
    draft = f"{wanted['validated_file'].rsplit('/', 1)[0]}/_{outcome.dataset.name}-{uuid.uuid4().hex}"
    rows = outcome.split_rows
    lines = (rows.orderBy("valid", *ROW_ID) if keep_order else rows).select(
        stripped(F.col("line")).alias("line"), "valid")
    line_writer(lines, compressed).partitionBy("valid").text(draft)
    for kind, path in wanted.items():
        part = f"{draft}/valid={str(kind == 'validated_file').lower()}"
        if not storage.exists(part):  # no such rows: an empty text folder
            _write_lines(outcome.stage.filter(F.lit(False)), path, keep_order=False)
            continue
        storage.make_dirs(path.rsplit("/", 1)[0])
        if not storage.rename(part, path):
            raise FileExistsError(f"Another writer stored {path}.")
    storage.delete(draft)


def write_validated(outcome: Outcome, path: str, keep_order: bool = True) -> str:
    return _write_lines(outcome.valid_rows, path, keep_order)


def write_quarantine(outcome: Outcome, path: str, keep_order: bool = True) -> str:
    return _write_lines(outcome.invalid_rows, path, keep_order)


def write_outcome(spark: SparkSession, outcome: Outcome, run_id: str, root: str,
                  keep_order: bool = True, compressed: bool = False) -> dict:
    """All files of one validated dataset; returns its report.

    Quarantined rows are written whenever there are any, also for a failed
    batch.  A failed batch has no validated file.  The report stays one small
    document: its failed rules are a table beside it, however many there are, and
    compressed, because their texts repeat.  ``compressed`` lines are, too.
    """
    name = outcome.dataset.name
    reports = f"{root}/validation_reports/{run_id}"
    validated = f"{root}/validated/{run_id}/{name}.json"
    quarantine = f"{root}/quarantine/{run_id}/invalid_records/{name}_invalid_records.json"
    storage = Storage(spark)

    report = outcome.report.first().asDict()
    failed = report["batch_status"] == "FAILED"
    for stale in (validated, quarantine):
        storage.delete(stale)
    failed_rules = f"{reports}/{name}_failed_rules"
    wanted = {}
    if report["invalid_records"] and not outcome.malformed:
        wanted["quarantine_file"] = quarantine
    if not failed:
        wanted["validated_file"] = validated
    together({
        "failed_rules": partial(line_writer(outcome.failures, compressed=True).mode("overwrite").json, failed_rules),
        "rows": partial(_write_split, spark, outcome, wanted, keep_order, compressed)})
    report |= {k: wanted.get(k) for k in ("quarantine_file", "validated_file")}

    report_path = f"{reports}/{name}_validation_report.json"
    report = {"run_id": run_id, "validation_run_at_utc": utc_text(), **report,
              "failed_rules_table": failed_rules}
    storage.write_text(report_path, json.dumps(report, indent=2))
    return report


def write_outcomes(spark: SparkSession, outcomes: dict[str, Outcome], run_id: str, root: str,
                   keep_order: bool = True, compressed: bool = False) -> list[dict]:
    """Files, reports and audit rows of all validated datasets."""
    reports = together({n: partial(write_outcome, spark, o, run_id, root, keep_order, compressed)
                        for n, o in outcomes.items()})
    append_validation_audit(spark, root, list(reports.values()))
    return list(reports.values())


def append_validation_audit(spark: SparkSession, root: str, reports: list[dict]) -> None:
    """Append one audit row per validated dataset."""
    rows = []
    for report in reports:
        folder = f"{root}/validation_reports/{report['run_id']}"
        row = {k: report[k] for k in ("run_id", "validation_run_at_utc", "dataset", *AUDIT_FIELDS)}
        row["report_file"] = f"{folder}/{report['dataset']}_validation_report.json"
        row |= {k: report[k] for k in ("quarantine_file", "validated_file")}
        rows.append((json.dumps(row),))
    small_rows(spark, rows, "value string").write.mode("append").text(
        f"{folder}/validation_audit_log.jsonl")


REPORT_SCHEMA = (
    "run_id string, validation_run_at_utc string, dataset string, contract_version string, "
    "batch_status string, pipeline_action string, total_records bigint, valid_records bigint, "
    "invalid_records bigint, warning_count bigint, error_count_by_severity map<string,bigint>, "
    "quarantine_file string, validated_file string, failed_rules_table string")


def read_reports(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The stored reports of one run, one row per dataset."""
    return (
        spark.read.schema(REPORT_SCHEMA).option("multiLine", "true")
        .json(f"{root}/validation_reports/{run_id}/*_validation_report.json"))
