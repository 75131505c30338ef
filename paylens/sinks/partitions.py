"""year/month layout of a validated run, with a manifest that can be re-checked."""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.contracts import DATASETS, Dataset
from paylens.functions.calendar import iso_text, month_text, partition_time, year_text
from paylens.functions.identifiers import check_run_id, is_safe_dataset_path, relative_key, utc_text
from paylens.functions.json_fields import NUMERIC, member_kind, member_text
from paylens.sources.files import JSON_FILES, count_records, line_writer, list_files, plain_key
from paylens.sources.jsonl import plain_lines, with_records
from paylens.sources.landing import strict_records
from paylens.workspace import Storage, small_rows, together

MANIFEST = "partition_manifest.json"
FILE_TABLE = "_manifest_files"
FILE_SCHEMA = "dataset string, output_file string"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
JSON_TYPES = {"string": "string", "number": "double", "integer": "bigint", "boolean": "boolean"}


def partition_rows(parsed: DataFrame, dataset: Dataset) -> DataFrame:
    """Contract fields plus year and month; NULL year marks a missing date.

    A missing date is an absent, null, empty, zero or false value.  Any other
    value that is not a date stops the job.
    """
    name = dataset.event_field
    kind, text, time = F.col("_kind"), F.col("_text"), F.col("_time")
    falsy = (
        kind.isNull() | (kind == "VOID") | ((kind == "STRING") & (text == ""))
        | ((kind == "BOOLEAN") & (text == "false"))
        | (kind.rlike(NUMERIC) & (text.try_cast("double") == 0)))
    complaint = F.concat(F.lit(f"{dataset.name} record has an invalid {name} value: "), text)
    return (
        parsed.withColumns({"_kind": member_kind("record", name), "_text": member_text("record", name)})
        .withColumn("_missing", falsy)
        .withColumn("_plain", F.when(~F.col("_missing"), iso_text(text)))
        .withColumn("_time", partition_time(F.col("_plain")))
        .withColumn("year", F.when(F.col("_missing"), None).when(time.isNotNull(), year_text(time))
                    .otherwise(F.raise_error(complaint).cast("string")))
        .select(
            *[F.variant_get("record", f"$.{f.name}", JSON_TYPES[f.kind]).alias(f.name)
              for f in dataset.fields],
            "year", month_text(time).alias("month")))


def write_partitions(spark: SparkSession, dataset: Dataset, validated: str, run_dir: str,
                     compressed: bool = False) -> dict:
    """Lay one validated dataset out by year and month; returns its manifest entry.

    A rebalance on (year, month) merges small months into one file and splits a
    month that outgrows a task, so a hot month never lands in a single task.
    Records without a date land in the null partition, which is counted and
    dropped: filtering them before the write would push the whole parsing
    chain into the scan's filter and evaluate it twice.
    """
    storage = Storage(spark)
    if not storage.exists(validated):
        raise FileNotFoundError(f"Missing validated input file: {validated}")
    parsed = strict_records(with_records(plain_lines(spark, validated)), f"partitioning of {dataset.name}")
    target = f"{run_dir}/raw/{dataset.name}"
    laid_out = spark.sql("select /*+ rebalance(year, month) */ * from {rows}",
                         rows=partition_rows(parsed, dataset))
    line_writer(laid_out, compressed).mode("overwrite").partitionBy("year", "month").json(target)
    # Counted from the written files, so a retried task cannot distort it.
    undated = F.contains(F.col("path"), F.lit(f"/year={NULL_PARTITION}/"))
    written = count_records(spark, target, JSON_FILES).agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("received"),
        F.coalesce(F.sum(F.when(undated, F.col("record_count"))), F.lit(0)).alias("missing"),
        F.count_if(~undated).alias("files")).first()
    storage.delete(f"{target}/year={NULL_PARTITION}")
    return {
        "dataset": dataset.name, "input_file": validated, "date_field": dataset.event_field,
        "records_received": written["received"],
        "records_partitioned": written["received"] - written["missing"],
        "records_missing_date": written["missing"], "partition_count": written["files"],
    }


def partition_run(spark: SparkSession, run_id: str, validated_dir: str, run_dir: str,
                  compressed: bool = False) -> dict:
    """Partition all five validated datasets of a run and write the manifest.

    ``compressed`` files are named ``.json.gz``.

    The manifest header carries the totals; the list of files is a table beside
    it (hidden from data listings), so it grows without passing the driver.
    """
    check_run_id(run_id)
    storage = Storage(spark)
    storage.delete(run_dir)
    results = list(together({
        n: partial(write_partitions, spark, d, f"{validated_dir}/{d.file_name}", run_dir, compressed)
        for n, d in DATASETS.items()}).values())
    files = list_files(spark, f"{run_dir}/raw", JSON_FILES).select(
        F.split("relative_key", "/")[0].alias("dataset"),
        F.concat(F.lit("raw/"), F.col("relative_key")).alias("output_file"))
    files.write.json(f"{run_dir}/{FILE_TABLE}")
    manifest = {
        "run_id": run_id, "generated_at_utc": utc_text(),
        "source_directory": validated_dir, "output_directory": run_dir,
        "dataset_count": len(results),
        **{k: sum(r[k] for r in results)
           for k in ("records_received", "records_partitioned", "records_missing_date")},
        "datasets": results, "files_table": FILE_TABLE,
    }
    storage.write_text(f"{run_dir}/{MANIFEST}", json.dumps(manifest, indent=2))
    return manifest


def read_partition_manifest(spark: SparkSession, run_dir: str) -> tuple[dict, DataFrame]:
    """(header, listed files).  Manifests with inline ``output_files`` are understood too."""
    storage = Storage(spark)
    path = f"{run_dir}/{MANIFEST}"
    if not storage.exists(path):
        raise FileNotFoundError(f"No manifest in this partitioned run: {path}")
    try:
        header = json.loads(storage.read_text(path))
    except json.JSONDecodeError as error:
        raise ValueError(f"Unreadable partition manifest: {path}") from error
    if not isinstance(header.get("datasets"), list):
        raise ValueError(f"The partition manifest lists no datasets: {path}")
    if "files_table" in header:
        return header, spark.read.schema(FILE_SCHEMA).json(f"{run_dir}/{header['files_table']}")
    rows = [(d.get("dataset"), str(f)) for d in header["datasets"] if isinstance(d, dict)
            for f in (d.get("output_files") or [])]
    return header, small_rows(spark, rows, FILE_SCHEMA)


def name_set_problems(found: set, expected: set) -> list[str]:
    """Missing and unexpected names, one text each."""
    return ([f"dataset {n} is not in the manifest" for n in sorted(expected - found)]
            + [f"dataset {n} is unknown" for n in sorted(map(str, found - expected))])


def header_problems(header: dict, run_id: str, publishing: bool) -> list[tuple[str | None, str]]:
    """Checks on the small header: names, counts and totals."""
    problems: list[tuple[str | None, str]] = []
    datasets = [d for d in header["datasets"] if isinstance(d, dict)]

    def check(ok: bool, text: str, dataset: str | None = None) -> None:
        if not ok:
            problems.append((dataset, text))

    check(header.get("run_id") == run_id, "manifest belongs to another run")
    problems += [(None, p) for p in name_set_problems(
        {d.get("dataset") for d in datasets}, set(DATASETS))]
    check(header.get("dataset_count") == len(DATASETS), "manifest promises another number of datasets")
    check(header.get("records_missing_date") == 0, "manifest counts records without a date")
    for d in datasets:
        name, received, done = (d.get(k) for k in
                                ("dataset", "records_received", "records_partitioned"))
        check(d.get("records_missing_date") == 0, "has records without a date", name)
        if publishing:
            check(isinstance(done, int) and done >= 0, "has no valid number of partitioned records", name)
        else:
            check(isinstance(received, int) and received >= 1,
                  "has no valid number of received records", name)
            check(done == received, f"partitioned {done} of {received} records", name)
    total = sum(d.get("records_partitioned") or 0 for d in datasets)
    check(header.get("records_partitioned") == total,
          "total differs from the sum over datasets")
    if not publishing:
        check(header.get("records_received") == header.get("records_partitioned"),
              "received and partitioned totals differ")
    return problems


def partition_problems(spark: SparkSession, run_dir: str, run_id: str) -> DataFrame:
    """dataset, output_file, problem — the loader's check before a load.

    Every listed file must exist below its dataset, the listing must have the
    promised length, and the files must hold the promised records.
    """
    header, listed = read_partition_manifest(spark, run_dir)
    found = count_records(spark, f"{run_dir}/raw", JSON_FILES).select(
        plain_key(F.col("path")).alias("path"), "record_count")
    root = plain_key(F.lit(Storage(spark).qualified(run_dir)))
    present = list_files(spark, f"{run_dir}/raw", JSON_FILES).select(
        F.concat(F.lit("raw/"), F.col("relative_key")).alias("plain"),
        plain_key(F.col("path")).alias("path")).join(found, "path", "left").select(
        "plain", F.coalesce("record_count", F.lit(0)).alias("record_count"))
    checked = listed.withColumn("plain", F.replace("output_file", F.lit("\\"), F.lit("/"))).join(
        present, "plain", "left")
    per_file = checked.select(
        "dataset", "output_file",
        F.when(~is_safe_dataset_path(F.col("output_file"), F.col("dataset")), "unsafe path")
        .when(F.col("record_count").isNull(), "listed file absent").alias("problem"),
    ).filter(F.col("problem").isNotNull())
    per_dataset = checked.groupBy("dataset").agg(
        F.count("*").alias("files"), F.sum("record_count").alias("records"))
    return _with_dataset_checks(spark, header, run_id, per_file, per_dataset, publishing=False)


def publish_problems(spark: SparkSession, run_dir: str, run_id: str) -> DataFrame:
    """The publisher's check: listed files and files on disk are the same set."""
    header, listed = read_partition_manifest(spark, run_dir)
    keyed = listed.withColumn("plain", relative_key(F.col("output_file")))
    outside = keyed.filter(
        ~F.col("plain").startswith(F.concat(F.lit("raw/"), F.col("dataset"), F.lit("/")))
    ).select("dataset", "output_file",
             F.lit("path outside its dataset").alias("problem"))
    grouped = keyed.groupBy("plain").agg(
        F.first("dataset").alias("dataset"), F.count("*").alias("listed"))
    present = list_files(spark, f"{run_dir}/raw", JSON_FILES).select(
        F.concat(F.lit("raw/"), F.col("relative_key")).alias("plain"), F.lit(True).alias("present"))
    compared = grouped.join(present, "plain", "full_outer").select(
        "dataset", F.col("plain").alias("output_file"),
        F.when(F.col("listed") > 1, "listed more than once")
        .when(F.col("present").isNull(), "listed file absent")
        .when(F.col("listed").isNull(), "file not listed").alias("problem"),
    ).filter(F.col("problem").isNotNull())
    per_dataset = keyed.groupBy("dataset").agg(
        F.count("*").alias("files"), F.lit(None).cast("bigint").alias("records"))
    return _with_dataset_checks(
        spark, header, run_id, outside.unionByName(compared), per_dataset, publishing=True)


def _with_dataset_checks(spark: SparkSession, header: dict, run_id: str, per_file: DataFrame,
                         per_dataset: DataFrame, publishing: bool) -> DataFrame:
    general = small_rows(
        spark, [(d, None, p) for d, p in header_problems(header, run_id, publishing)],
        "dataset string, output_file string, problem string")
    promised = small_rows(
        spark, [(d.get("dataset"), d.get("partition_count"), d.get("records_partitioned"))
         for d in header["datasets"] if isinstance(d, dict)],
        "dataset string, partition_count bigint, records_partitioned bigint")
    compared = promised.join(per_dataset, "dataset", "left").select(
        "dataset", F.lit(None).cast("string").alias("output_file"),
        F.when(F.col("files").isNull(), "no files listed")
        .when(~F.col("files").eqNullSafe(F.col("partition_count")),
              "another number of files than promised")
        .when(F.col("records") != F.col("records_partitioned"),
              "another number of records than promised").alias("problem"),
    ).filter(F.col("problem").isNotNull())
    return general.unionByName(per_file).unionByName(compared)


def expected_loads(spark: SparkSession, header: dict, listed: DataFrame) -> DataFrame:
    """dataset, expected_rows, expected_files — what a load must reproduce."""
    rows = small_rows(
        spark, [(d["dataset"], d["records_partitioned"]) for d in header["datasets"]],
        "dataset string, expected_rows bigint")
    files = listed.groupBy("dataset").agg(F.count_distinct("output_file").alias("expected_files"))
    return rows.join(files, "dataset", "left")
