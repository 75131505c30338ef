"""One run from raw snapshot to marts, stopping at the first failing stage."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.contracts import DATASETS, Dataset
from paylens.functions.identifiers import check_run_id, utc_text
from paylens.operators.verdicts import dataset_summaries, run_summary
from paylens.plans.journal import Journal, digest_of
from paylens.plans.validation import validate_run
from paylens.sinks.generations import live_generation
from paylens.sinks.materialise import build_models
from paylens.sinks.outcomes import read_reports, write_outcomes
from paylens.sinks.partitions import partition_run
from paylens.sinks.promotion import load_run
from paylens.sinks.publishing import publish_run
from paylens.sinks.snapshots import create_snapshot, require_no_problems, snapshot_problems
from paylens.workspace import Storage, brief_shuffles, scratch_scope

PIPELINE_NAME = "payment_risk_batch"


def validation_summary(spark: SparkSession, root: str, run_id: str) -> dict:
    """Run totals and one row per dataset; zeros when nothing was validated."""
    folder = f"{root}/validation_reports/{run_id}"
    if not Storage(spark).exists(folder):
        return {"rows_received": 0, "rows_valid": 0, "rows_invalid": 0, "rows_quarantined": 0,
                "rows_rejected": 0, "warnings": 0, "datasets": []}
    reports = read_reports(spark, root, run_id)
    summary = run_summary(reports).first().asDict()
    # Five rows at most.
    summary["datasets"] = [r.asDict() for r in dataset_summaries(reports).orderBy("dataset").collect()]
    return summary


def validate_and_store(spark: SparkSession, root: str, run_id: str,
                       contracts: dict[str, Dataset] = DATASETS, compressed: bool = False) -> None:
    """Validate a whole snapshot, store its outcome, fail when a dataset failed."""
    raw = f"{root}/raw/{run_id}"
    require_no_problems(snapshot_problems(spark, raw, run_id), "Snapshot check", root)
    for folder in ("validated", "validation_reports", "quarantine"):
        Storage(spark).delete(f"{root}/{folder}/{run_id}")
    # The next stage regroups rows by month, so the files need no order.
    reports = write_outcomes(spark, validate_run(spark, run_id, raw, contracts=contracts),
                             run_id, root, keep_order=False, compressed=compressed)
    failed = [r["dataset"] for r in reports if r["batch_status"] == "FAILED"]
    if failed:
        raise RuntimeError(f"Contract validation failed: {', '.join(failed)}")


def write_run_audit(spark: SparkSession, root: str, record: dict) -> None:
    """The run's audit document and one appended line in the audit log."""
    record["validation_summary"] = validation_summary(spark, root, record["run_id"])
    Storage(spark).write_text(f"{root}/{record['audit_file']}", json.dumps(record, indent=2))
    text = json.dumps(record)
    spark.range(1).select(F.lit(text).alias("value")).write.mode("append").text(
        f"{root}/pipeline_audit_logs/pipeline_run_audit_log.jsonl")


def run_batch(spark: SparkSession, root: str, run_id: str,
              lines: dict[str, DataFrame] | None = None, publish_to: str | None = None,
              execute_publish: bool = False, reload_raw: bool = False,
              execute_reload: bool = False, run_models: bool = False,
              as_of: str | None = None, contracts: dict[str, Dataset] = DATASETS,
              published_at: str | None = None, resume: bool = False, done: tuple[str, ...] = (),
              compressed: bool = False) -> dict:
    """Snapshot (when ``lines`` are given), validate, partition, publish, load, model.

    A load without a publication in the same call reads what was published to
    ``published_at``.  ``resume`` keeps a journal and skips stages whose inputs and
    outputs it proves unchanged; ``done`` names the stages ("validate", "partition") that the
    caller itself has just finished for this root, which are skipped unproved.  The audit record is written whatever happens; a failing
    stage is re-raised.  ``compressed`` keeps the record files of the snapshot, the outcomes
    and the partitions as gzip.  Stage, failure and inventory tables below the scratch
    folder are gone after their stage, shuffle files after their statement.
    """
    check_run_id(run_id)
    published = publish_to or published_at
    if reload_raw and not published:
        raise ValueError("A load needs publish_to, or published_at for an earlier publication.")
    with scratch_scope(spark), brief_shuffles(spark):
        return _run_batch(spark, root, run_id, lines, publish_to, execute_publish, reload_raw,
                          execute_reload, run_models, as_of, contracts, published, Journal(spark, root, run_id, resume), done, compressed)


def _run_batch(spark: SparkSession, root: str, run_id: str, lines: dict[str, DataFrame] | None,
               publish_to: str | None, execute_publish: bool, reload_raw: bool, execute_reload: bool,
               run_models: bool, as_of: str | None, contracts: dict[str, Dataset], published: str | None,
               journal: Journal, done: tuple[str, ...], compressed: bool) -> dict:
    started = time.perf_counter()
    warehouse, run_dir = f"{root}/warehouse", f"{root}/partitioned/{run_id}"
    record = {  # Fixed values: the names of the audit record's fields.
        "run_id": run_id, "pipeline_name": PIPELINE_NAME, "started_at_utc": utc_text(),
        "ended_at_utc": None, "duration_seconds": None, "status": "RUNNING",
        "failure_reason": None,
        "config": {
            "skip_snapshot": lines is None, "publish_to": publish_to,
            "published_at": published, "publish_mode": "execute" if execute_publish else "dry_run",
            "reload_requested": reload_raw,
            "reload_mode": "execute" if execute_reload else "dry_run",
            "run_models": run_models,
        },
        "steps": [], "validation_summary": {},
        "audit_file": f"pipeline_audit_logs/pipeline_run_{run_id}.json",
    }

    def step(name: str, work: Callable[[], tuple[str, bool] | object]) -> str:
        timer = time.perf_counter()
        entry = {"step_name": name, "started_at_utc": utc_text(), "ended_at_utc": None,
                 "duration_seconds": None, "status": "RUNNING", "failure_reason": None}
        record["steps"].append(entry)
        try:
            with scratch_scope(spark):
                result = work()
            digest, skipped = result if isinstance(result, tuple) else ("", False)
            entry["status"] = "SKIPPED" if skipped else "SUCCESS"
            return digest
        except Exception as error:
            entry["status"] = "FAILED"
            entry["failure_reason"] = f"{type(error).__name__}: {error}"
            record["failure_reason"] = f"{name}: {entry['failure_reason']}"
            raise
        finally:
            entry["ended_at_utc"] = utc_text()
            entry["duration_seconds"] = round(time.perf_counter() - timer, 2)

    def at(stage: str, inputs: str, folders: list[str], work: Callable[[], object]) -> tuple[str, bool]:
        if stage in done:
            return "", True
        return journal.run(stage, inputs, lambda: journal.proof(folders), work)

    def tables() -> str:
        live = live_generation(spark, warehouse)
        return digest_of(live.raw, live.models)

    def loaded(inputs: str) -> tuple[str, bool]:
        return journal.run("load", digest_of(inputs, published, as_of, execute_reload),
                           lambda: str(live_generation(spark, warehouse).raw), lambda: load_run(
            spark, run_dir, f"{published}/raw", run_id, warehouse, execute=execute_reload, loaded_at=as_of))

    try:
        raw = f"{root}/raw/{run_id}"
        if lines is not None:
            # An existing snapshot is verified, never written again.
            step("Write raw snapshot", lambda: create_snapshot(
                spark, f"{root}/raw", run_id, lines, compressed=compressed)[0])
        digest = step("Validate data contracts", lambda: at(
            "validate", digest_of(journal.folder_digest(raw), sorted(contracts.items())),
            [f"{root}/{f}/{run_id}" for f in ("validated", "validation_reports", "quarantine")],
            lambda: validate_and_store(spark, root, run_id, contracts, compressed)))
        digest = step("Partition validated data", lambda: at("partition", digest, [run_dir], lambda: partition_run(
            spark, run_id, f"{root}/validated/{run_id}", run_dir, compressed)))
        if publish_to:
            # A publication compares what is there with the batch and copies only what it must.
            step("Publish partitioned files", lambda: publish_run(
                spark, run_dir, publish_to, run_id, execute=execute_publish))
        if reload_raw:
            digest = step("Reload RAW tables", lambda: loaded(digest))
        if run_models:
            step("Build models", lambda: journal.run(
                "models", digest_of(digest, live_generation(spark, warehouse).raw, as_of), tables,
                lambda: build_models(spark, warehouse, as_of)))
        record["status"] = "SUCCESS"
        return record
    except Exception:
        record["status"] = "FAILED"
        raise
    finally:
        record["ended_at_utc"] = utc_text()
        record["duration_seconds"] = round(time.perf_counter() - started, 2)
        write_run_audit(spark, root, record)
