"""Immutable raw snapshots: JSON-lines per dataset plus a hash manifest."""

from __future__ import annotations

import json
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.contracts import DATASETS
from paylens.functions.identifiers import check_run_id, utc_text
from paylens.sources.files import describe_files, line_writer
from paylens.workspace import Storage, small_rows, together

MANIFEST = "raw_manifest.json"
FILE_TABLE = "_manifest_files"
FILE_SCHEMA = ("dataset string, file_name string, record_count bigint, "
               "file_size_bytes bigint, sha256 string")


def _dataset_of(key):
    return F.regexp_extract(key, r"^([^/]+)\.json(/|$)", 1)


def describe_snapshot(spark: SparkSession, run_dir: str) -> DataFrame:
    """Actual files of a snapshot in manifest form (everything is re-read and re-hashed)."""
    files = describe_files(spark, run_dir)
    return (
        files.filter(F.col("relative_key") != MANIFEST)
        .select(_dataset_of(F.col("relative_key")).alias("dataset"),
                F.col("relative_key").alias("file_name"), "record_count",
                F.col("size").alias("file_size_bytes"), "sha256")
        .filter(F.col("dataset") != ""))


def read_raw_manifest(spark: SparkSession, run_dir: str) -> tuple[dict, DataFrame]:
    """(header, one row per listed file).

    Snapshots written here list their files in a side table, so the header
    stays small however many files there are.  A manifest with an inline
    ``files`` object (one plain file per dataset) is understood too.
    """
    storage = Storage(spark)
    path = f"{run_dir}/{MANIFEST}"
    if not storage.exists(path):
        raise FileNotFoundError(f"No manifest in this snapshot: {path}")
    try:
        header = json.loads(storage.read_text(path))
    except json.JSONDecodeError as error:
        raise ValueError(f"Unreadable snapshot manifest {path}: {error}") from error
    listed = header.get("files")
    if isinstance(listed, dict):
        rows = [(n, m.get("file_name"), m.get("record_count"), m.get("file_size_bytes"),
                 m.get("sha256")) for n, m in listed.items() if isinstance(m, dict)]
        return header, small_rows(spark, rows, FILE_SCHEMA)
    if not storage.exists(f"{run_dir}/{FILE_TABLE}"):
        raise ValueError(f"The snapshot manifest lists no files: {path}")
    return header, spark.read.schema(FILE_SCHEMA).json(f"{run_dir}/{FILE_TABLE}")


def snapshot_problems(spark: SparkSession, run_dir: str, run_id: str,
                      seed: int | None = None, counts: bool = False) -> DataFrame:
    """dataset, file_name, problem — empty when the snapshot equals its manifest.

    A file of a dataset that is not listed is a problem too: it would be read
    with the others.  ``counts`` (with ``seed``) is the stricter check made before an existing
    snapshot is reused.
    """
    header, listed = read_raw_manifest(spark, run_dir)
    general = []
    if header.get("run_id") != run_id:
        general.append("manifest belongs to another run")
    if counts and header.get("seed") != seed:
        general.append("snapshot was made with another seed")
    notes = small_rows(spark, [(None, None, g) for g in general],
                       "dataset string, file_name string, problem string")

    expected_names = small_rows(spark, [(n,) for n in DATASETS], "dataset string")
    absent = expected_names.join(listed, "dataset", "left_anti").select(
        "dataset", F.lit(None).cast("string").alias("file_name"),
        F.lit("dataset not listed").alias("problem"))

    actual = describe_snapshot(spark, run_dir).select(
        F.col("dataset").alias("found_dataset"), "file_name", F.col("record_count").alias("found_count"),
        F.col("file_size_bytes").alias("found_size"), F.col("sha256").alias("found_sha256"))
    wrong_name = F.coalesce(_dataset_of(F.col("file_name")), F.lit("")) != F.col("dataset")
    problem = (
        F.when(F.col("dataset").isNull(), "file not listed")
        .when(wrong_name, "listed under another dataset")
        .when(F.col("found_size").isNull(), "file absent")
        .when(~F.col("found_size").eqNullSafe(F.col("file_size_bytes")), "size differs")
        .when(~F.col("found_sha256").eqNullSafe(F.col("sha256")), "content differs"))
    if counts:
        problem = problem.when(~F.col("found_count").eqNullSafe(F.col("record_count")),
                               "record count differs")
    compared = (
        listed.join(actual.filter(F.col("found_dataset").isin(list(DATASETS))), "file_name", "full_outer")
        .select(F.coalesce("dataset", "found_dataset").alias("dataset"), "file_name", problem.alias("problem"))
        .filter(F.col("problem").isNotNull()))
    return notes.unionByName(absent).unionByName(compared)


def require_no_problems(problems: DataFrame, what: str, folder: str,
                        error: type[Exception] = ValueError) -> None:
    """Raise when there are problems, after writing all of them below ``folder``/_problems.

    The error names the table, the number of problems and a few of them.
    """
    if problems.isEmpty():
        return
    spark = problems.sparkSession
    path = f"{folder.rstrip('/')}/_problems/{uuid.uuid4().hex}"
    problems.write.json(path)
    stored = spark.read.schema(problems.schema).json(path)
    shown = "; ".join(" ".join(str(v) for v in row if v is not None) for row in stored.take(3))
    raise error(f"{what}: {stored.count()} problems, listed in {path}, such as {shown}")


def _require_same(spark: SparkSession, root: str, target: str, run_id: str, seed: int | None) -> None:
    require_no_problems(snapshot_problems(spark, target, run_id, seed, counts=True),
                        f"Existing snapshot {target}", root)


def create_snapshot(spark: SparkSession, root: str, run_id: str, lines: dict[str, DataFrame],
                    seed: int | None = None, base_date: str | None = None,
                    compressed: bool = False) -> tuple[str, bool]:
    """Write ``line`` rows per dataset as one immutable run; (folder, already existed).

    Everything is written beside the target and appears with one rename.  An
    existing snapshot is verified, never overwritten.  Sizes and hashes in the manifest are
    those of the stored files, also of ``compressed`` ones.
    """
    check_run_id(run_id)
    storage = Storage(spark)
    target = f"{root.rstrip('/')}/{run_id}"
    if storage.exists(target):
        _require_same(spark, root, target, run_id, seed)
        return target, True
    draft = f"{root.rstrip('/')}/.{run_id}.{uuid.uuid4().hex}.tmp"
    storage.make_dirs(draft)
    together({
        name: partial(line_writer(rows.select("line"), compressed).text, f"{draft}/{DATASETS[name].file_name}")
        for name, rows in lines.items()})
    files = describe_snapshot(spark, draft)
    files.write.json(f"{draft}/{FILE_TABLE}")
    written = spark.read.schema(FILE_SCHEMA).json(f"{draft}/{FILE_TABLE}")
    totals = written.agg(F.count_distinct("dataset").alias("datasets"),
                         F.coalesce(F.sum("record_count"), F.lit(0)).alias("records")).first()
    storage.write_text(f"{draft}/{MANIFEST}", json.dumps({
        "manifest_version": "1.0", "run_id": run_id, "seed": seed, "base_date": base_date,
        "generated_at_utc": utc_text(), "dataset_count": totals["datasets"],
        "total_record_count": totals["records"], "files_table": FILE_TABLE,
    }, indent=2, sort_keys=True) + "\n")
    if not storage.rename(draft, target):
        # Another writer finished first: its snapshot must be the same one.
        storage.delete(draft)
        _require_same(spark, root, target, run_id, seed)
        return target, True
    return target, False
