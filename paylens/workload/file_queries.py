"""Queries over files: scans, snapshots, partitions, publication, loads, stream ingest.

Each works on files that Spark writes from the given tables into the session's
shared scratch folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylens.contracts import DATASETS, HARD_FAIL, QUARANTINE
from paylens.functions.identifiers import plain_uri
from paylens.functions.json_fields import is_blank
from paylens.operators.inventory import (
    inventory_diff, inventory_sha256, marker_matches, set_difference)
from paylens.operators.verdicts import batch_status, pipeline_action
from paylens.plans.batch import run_batch
from paylens.plans.bronze import BRONZE_TYPES, LINEAGE, MONEY, TIME, WHOLE, bronze
from paylens.plans.monitoring import displayable, in_dashboard_order
from paylens.plans.validation import validate_lines, validate_run
from paylens.sinks.generations import live_generation
from paylens.sinks.materialise import build_models, read_mart
from paylens.sinks.outcomes import REPORT_SCHEMA, read_reports, write_outcomes
from paylens.sinks.partitions import (
    expected_loads, partition_problems, partition_run, publish_problems, read_partition_manifest)
from paylens.sinks.promotion import (
    guardrail_problems, load_facts, promote, read_raw, write_raw_version)
from paylens.sinks.publishing import publish_run, run_folder
from paylens.sinks.snapshots import create_snapshot, read_raw_manifest, snapshot_problems
from paylens.sources.files import JSON_FILES, count_records
from paylens.sources.jsonl import read_json_lines
from paylens.sources.landing import land_run, with_lineage_columns
from paylens.streaming.ingest import Arrivals, ingest, latest_records, loaded_rows, quarantined, records
from paylens.workload.model_queries import (
    BRONZE_COLUMNS, BRONZE_CTES, MARTS, comparable, plain, query, with_models)
from paylens.workload.rule_queries import ACTION, checked_intake, report_sql, with_intake
from paylens.workload.tables import (
    CONTRACTS, LOADED, NOISY, RUN_A, RUN_B, TYPED, clean_lines, for_duckdb, landed, run_sql)
from paylens.workspace import Storage, brief_shuffles, scratch_dir, small_rows

#: How far a run was taken.
PARTITIONED, PUBLISHED, MODELLED = 1, 2, 3
_RUNS: dict[tuple[str, str, str], tuple[str, int]] = {}
_OUTCOMES: dict[tuple[str, str], tuple[str, list[dict]]] = {}
_DAMAGED: dict[tuple[str, str, str], str] = {}


def each_run(name: str, oracle: Callable[[str], str]):
    """Register a query of one batch twice: run A as ``name``, run B as ``name``_run_b."""
    def register(function):
        for run, suffix in ((RUN_A, ""), (RUN_B, "_run_b")):
            query(name + suffix, oracle(run))(partial(function, run=run))
        return function
    return register


def taken_run(spark: SparkSession, sf_dir: str, run: str, upto: int) -> str:
    """Root folder of one run taken at least as far as ``upto``; shared by the queries of a session.

    A query that reads partitions or published files does not wait for a load and its
    models; one that needs them goes on from there.
    """
    key = (spark.sparkContext.applicationId, sf_dir, run)
    root, reached = _RUNS.get(key, ("", 0))
    if not reached or not Storage(spark).exists(f"{_partitioned(root, run)}/partition_manifest.json"):
        root, reached = scratch_dir(spark, "run"), 0
    if reached < upto:
        # The last pass names the lines again, so that it holds every step.
        lines = {n: clean_lines(spark, sf_dir, n, run) for n in DATASETS}
        run_batch(spark, root, run, lines if upto == MODELLED or not reached else None,
                  publish_to=f"{root}/published" if upto >= PUBLISHED else None, execute_publish=True,
                  reload_raw=upto == MODELLED, execute_reload=True, run_models=upto == MODELLED,
                  as_of=LOADED[run], contracts=CONTRACTS, done=("validate", "partition") if reached else (), compressed=True)
        _RUNS[key] = root, upto
    return root


def finished_run(spark: SparkSession, sf_dir: str, run: str) -> str:
    """Root folder of one run taken through every stage."""
    return taken_run(spark, sf_dir, run, MODELLED)


def _partitioned(root: str, run: str) -> str:
    return f"{root}/partitioned/{run}"


def _loaded_bronze(run: str) -> str:
    """What a run holds after validation: children of unmatched parents are quarantined."""
    return ",\n".join(f"all_{n} as ({for_duckdb(TYPED[n])})" for n in DATASETS) + f""",
br_customers as (select * from all_customers where pipeline_run_id = '{run}'),
br_transactions as (select t.* from all_transactions t join br_customers c using (customer_id)
  where t.pipeline_run_id = '{run}' and t.account_id = c.account_id),
br_fraud_signals as (select * from all_fraud_signals where pipeline_run_id = '{run}'
  and transaction_id in (select transaction_id from br_transactions)),
br_disputes as (select * from all_disputes where pipeline_run_id = '{run}'
  and transaction_id in (select transaction_id from br_transactions)),
br_chargeback_outcomes as (select * from all_chargeback_outcomes where pipeline_run_id = '{run}'
  and dispute_id in (select dispute_id from br_disputes))"""


def with_loaded(sql: str, run: str) -> str:
    """The model CTEs over the rows of a run that pass validation."""
    return with_models(sql).replace(BRONZE_CTES, _loaded_bronze(run), 1)


def _per_dataset(select: str) -> str:
    """One select per dataset: ``{table}`` is its bronze name, ``{event}`` its date field, ``{key}`` its key."""
    return "\nunion all ".join(
        f"select '{n}' as dataset, * from ({select.format(table=n, event=d.event_field, key=d.primary_key)})"
        for n, d in DATASETS.items())


def _delivered(run: str) -> str:
    return with_loaded(_per_dataset(
        f"select count(*) as record_count from all_{{table}} where pipeline_run_id = '{run}'"), run)


def _valid(run: str) -> str:
    return with_loaded(_per_dataset("select count(*) as valid_records from br_{table}"), run)


def _months(run: str) -> str:
    return with_loaded(_per_dataset("""select cast(year({event}) as varchar) as year,
  lpad(cast(month({event}) as varchar), 2, '0') as month, count(*) as record_count,
  min({key}) as first_id, max({key}) as last_id from br_{table} group by 1, 2"""), run)


_LOADED_TOTAL = "(select sum(n) from (" + " union all ".join(
    f"select count(*) as n from br_{n}" for n in DATASETS) + "))::bigint"


def _delivered_total(run: str) -> str:
    return "(select sum(n) from (" + " union all ".join(
        f"select count(*) as n from all_{n} where pipeline_run_id = '{run}'" for n in DATASETS) \
        + "))::bigint"


# --------------------------------------------------------------------- scans

_NOISE = f"""with noise as (select month as file, line, trim(line, ' ' || chr(160) || chr(12288)) as said,
  row_number() over (partition by month order by o_orderkey, line) as line_number from ({for_duckdb(NOISY)})),
kinds as (select file, line_number, line,
  case when said like '%NaN}}' then null
  when said like '%INF}}' or not json_valid(said) then 'Line is not valid JSON.'
  when json_type(said) <> 'OBJECT' then 'JSON line must contain an object.' end as problem,
  case when said like '%NaN}}' then null when said like '%trailing' then 'Extra data'
  when said like '%INF}}' then 'Expecting value' when not json_valid(said) then 'Unterminated string starting at' else problem end as message
  from noise where said <> '')"""


def _noisy_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "noisy")
    run_sql(spark, sf_dir, NOISY).repartition("month").sortWithinPartitions("month", "o_orderkey", "line") \
        .select("month", "line").write.partitionBy("month").text(path)
    return path


@query("jsonl_scan", _NOISE + " select file, line_number, line, problem from kinds")
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json_lines(spark, _noisy_file(spark, sf_dir)).select(
        F.regexp_extract("source_file", "/month=([0-9]+)/", 1).alias("file"), "line_number", "line", "problem")


@query("jsonl_line_numbers", f"""{_NOISE}
select count(*) as lines, (select count(*) from noise where said = '') as blank_lines, 0 as wrong_numbers
from noise""")
def jsonl_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file, distinct numbers from 1 and gaps only where lines are blank."""
    path = _noisy_file(spark, sf_dir)
    total = spark.read.text(path).groupBy(plain_uri(F.col("_metadata.file_path")).alias("file")).agg(
        F.count("*").alias("lines"), F.count_if(is_blank(F.col("value"))).alias("blank"))
    numbered = read_json_lines(spark, path).groupBy(plain_uri(F.col("source_file")).alias("file")).agg(
        F.count("*").alias("rows"), F.count_distinct("line_number").alias("distinct"),
        F.min("line_number").alias("low"), F.max("line_number").alias("high"))
    wrong = ((F.col("rows") != F.col("distinct")) | (F.col("low") < 1)
             | (F.col("high") > F.col("lines")) | (F.col("rows") + F.col("blank") != F.col("lines")))
    return total.join(numbered, "file", "left").agg(
        F.sum("lines").alias("lines"), F.sum("blank").alias("blank_lines"),
        F.count_if(wrong).cast("int").alias("wrong_numbers"))


@query("rule_valid_jsonl", f"""{_NOISE}
select 'FAILED' as batch_status, 'BLOCK_S3_UPLOAD' as pipeline_action, 'valid_json_lines' as rule,
  'hard_fail' as severity, message, count(*) as failures from kinds
where problem is not null group by message""")
def rule_valid_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = read_json_lines(spark, _noisy_file(spark, sf_dir))
    outcome = validate_lines(parsed, DATASETS["transactions"], None)
    found = outcome.failures.groupBy("rule", "severity", "message").agg(
        F.count("*").alias("failures"))
    status = batch_status(F.when(F.col("severity") == HARD_FAIL, F.col("failures")), F.lit(0), F.lit(0))
    return found.withColumn("batch_status", status).select(
        "batch_status", pipeline_action(F.col("batch_status")).alias("pipeline_action"),
        "rule", "severity", "message", "failures")


@each_run("raw_land", lambda run: with_loaded(_per_dataset(f"""select pipeline_run_id,
  cast(year({{event}}) as varchar) as year, count(*) as row_count, 0 as bad_numbers,
  min({{key}}) as first_id, max({{key}}) as last_id, '{LOADED[run]}' as loaded_at
  from br_{{table}} group by 1, 2"""), run))
def raw_land(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """Rows per landed folder; bad_numbers counts files whose row numbers are not 1..n."""
    root = taken_run(spark, sf_dir, run, PUBLISHED)
    parts = []
    for name, rows in land_run(spark, f"{root}/published/raw", run, LOADED[run]).items():
        own = F.variant_get("raw_record", f"$.{DATASETS[name].primary_key}", "string")
        files = rows.groupBy("source_file", "pipeline_run_id", "loaded_at").agg(
            F.count("*").alias("rows"), F.min(own).alias("first_id"), F.max(own).alias("last_id"), F.max("source_row_number").alias("high"),
            F.count_distinct("source_row_number").alias("distinct"))
        parts.append(files.groupBy(
            "pipeline_run_id", F.regexp_extract("source_file", "/year=([0-9]+)/", 1).alias("year"),
            F.col("loaded_at").cast("string").alias("loaded_at"),
        ).agg(F.sum("rows").alias("row_count"), F.min("first_id").alias("first_id"),
              F.max("last_id").alias("last_id"), F.count_if(
            (F.col("rows") != F.col("high")) | (F.col("rows") != F.col("distinct")))
            .cast("int").alias("bad_numbers")).withColumn("dataset", F.lit(name)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ----------------------------------------------------------------- snapshots

@each_run("raw_snapshot_write", _delivered)
def raw_snapshot_write(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    lines = {n: clean_lines(spark, sf_dir, n, run) for n in DATASETS}
    folder, _ = create_snapshot(spark, scratch_dir(spark, "raw"), run, lines)
    _, files = read_raw_manifest(spark, folder)
    return files.groupBy("dataset").agg(F.sum("record_count").alias("record_count"))


# Datasets by size; each rank gets another kind of damage.
def _ranks(select: str) -> str:
    return f"""select *, row_number() over (order by record_count desc, dataset) as rank
from ({_per_dataset(select)})"""


def _by_delivered(run: str) -> str:
    return _ranks(f"select count(*) as record_count from all_{{table}} where pipeline_run_id = '{run}'")


_BY_VALID = _ranks("select count(*) as record_count from br_{table}")


def _ranked(counts: DataFrame) -> DataFrame:
    """dataset, rank of the five (dataset, record_count) rows."""
    return counts.select("dataset", F.row_number().over(
        Window.orderBy(F.desc("record_count"), "dataset")).alias("rank"))


def _replace_table(spark: SparkSession, folder: str, changed: DataFrame) -> None:
    """Put another file list in the place of a manifest's own."""
    storage, new = Storage(spark), f"{folder}/_changed"
    changed.write.json(new)
    storage.delete(f"{folder}/_manifest_files")
    storage.rename(new, f"{folder}/_manifest_files")


def _damaged_snapshot(spark: SparkSession, sf_dir: str, run: str) -> str:
    """A snapshot whose manifest promises, by rank: other content, other sizes, files that are
    not there, other record counts; the smallest dataset is not listed at all.  The largest
    one holds a file more."""
    lines = {n: clean_lines(spark, sf_dir, n, run) for n in DATASETS}
    folder, _ = create_snapshot(spark, scratch_dir(spark, "raw"), run, lines)
    _, files = read_raw_manifest(spark, folder)
    ranks = _ranked(files.groupBy("dataset").agg(F.sum("record_count").alias("record_count")))
    largest, rank = ranks.filter("rank = 1").first()["dataset"], F.col("rank")
    _replace_table(spark, folder, files.join(ranks, "dataset").filter("rank < 5").select(
        "dataset", F.concat("file_name", F.when(rank == 3, ".gone").otherwise("")).alias("file_name"),
        (F.col("record_count") + (rank == 4).cast("int")).alias("record_count"),
        (F.col("file_size_bytes") + (rank == 2).cast("int")).alias("file_size_bytes"),
        F.when(rank == 1, F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("sha256")))
    Storage(spark).write_text(f"{folder}/{DATASETS[largest].file_name}/part-late.txt", "{}\n")
    return folder


_SNAPSHOT_PROBLEM = """case rank when 1 then 'content differs' when 2 then 'size differs'
  when 3 then 'file absent' when 4 then 'record count differs' else 'dataset not listed' end"""


@each_run("raw_manifest_verify", lambda run: with_loaded(
    f"select dataset, {_SNAPSHOT_PROBLEM} as problem from ({_by_delivered(run)}) where rank <> 4 "
    f"union all select dataset, 'file not listed' from ({_by_delivered(run)}) where rank in (1, 3, 5)", run))
def raw_manifest_verify(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    folder = _damaged_snapshot(spark, sf_dir, run)
    return snapshot_problems(spark, folder, run).select("dataset", "problem").distinct()


@each_run("raw_snapshot_verify", lambda run: with_loaded(
    f"select dataset, {_SNAPSHOT_PROBLEM} as problem from ({_by_delivered(run)}) "
    f"union all select dataset, 'file not listed' from ({_by_delivered(run)}) where rank in (1, 3, 5) "
    "union all select null, 'snapshot was made with another seed'", run))
def raw_snapshot_verify(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """The strict check before reuse: record counts and the seed count too."""
    folder = _damaged_snapshot(spark, sf_dir, run)
    return snapshot_problems(spark, folder, run, seed=1, counts=True).select("dataset", "problem").distinct()


# -------------------------------------------------- validated and quarantined

def _stored_intake(spark: SparkSession, sf_dir: str) -> tuple[str, list[dict]]:
    """Root folder and reports of the stored intake; shared by the queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OUTCOMES or not Storage(spark).exists(_OUTCOMES[key][0]):
        root = scratch_dir(spark, "outcomes")
        with brief_shuffles(spark):
            _OUTCOMES[key] = root, write_outcomes(spark, checked_intake(spark, sf_dir), RUN_A, root, compressed=True)
    return _OUTCOMES[key]


def _written(spark: SparkSession, reports: list[dict], column: str) -> DataFrame:
    result = spark.createDataFrame([], "dataset string, line string")
    for r in reports:
        if r[column]:
            result = result.unionByName(spark.read.text(r[column]).select(
                F.lit(r["dataset"]).alias("dataset"), F.col("value").alias("line")))
    return result


@query("validated_write", with_intake(
    "select 'fraud_signals' as dataset, line from v_fraud_signals where (select count(*) from "
    "u_fraud_signals where schema_n > 0 or dup) = 0 union all select 'chargeback_outcomes', line "
    "from v_chargeback_outcomes where (select count(*) from u_chargeback_outcomes "
    "where schema_n > 0 or dup) = 0"))
def validated_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only batches that did not fail have a validated file."""
    return _written(spark, _stored_intake(spark, sf_dir)[1], "validated_file")


@query("quarantine_write", with_intake("\nunion all ".join(
    f"select '{n}' as dataset, line from r_{n} where schema_n > 0 or dup or ref_n > 0"
    for n in DATASETS)))
def quarantine_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, _stored_intake(spark, sf_dir)[1], "quarantine_file")


_REPORT = report_sql(f"""dataset, 'v1' as contract_version, batch_status, {ACTION} as pipeline_action,
  total_records, total_records - invalid_records as valid_records, invalid_records, warning_count,
  hard as hard_failures, quarantined as quarantine_failures,
  batch_status <> 'FAILED' as has_validated, invalid_records > 0 as has_quarantine""")


def _report_columns(reports: DataFrame) -> DataFrame:
    def errors(severity: str):
        return F.coalesce(F.try_element_at("error_count_by_severity", F.lit(severity)), F.lit(0))

    return reports.select(
        "dataset", "contract_version", "batch_status", "pipeline_action", "total_records", "valid_records",
        "invalid_records", "warning_count", errors(HARD_FAIL).alias("hard_failures"),
        errors(QUARANTINE).alias("quarantine_failures"), F.col("validated_file").isNotNull().alias("has_validated"),
        F.col("quarantine_file").isNotNull().alias("has_quarantine"))


@query("report_write", _REPORT)
def report_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _stored_intake(spark, sf_dir)
    return _report_columns(read_reports(spark, root, RUN_A))


@query("validation_audit_append", _REPORT)
def validation_audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _stored_intake(spark, sf_dir)
    log = spark.read.schema(REPORT_SCHEMA).json(
        f"{root}/validation_reports/{RUN_A}/validation_audit_log.jsonl")
    return _report_columns(log)


@each_run("validate_suite", _valid)
def validate_suite_query(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """A snapshot of a clean run is written, scanned with line numbers and validated."""
    lines = {n: clean_lines(spark, sf_dir, n, run) for n in DATASETS}
    folder, _ = create_snapshot(spark, scratch_dir(spark, "raw"), run, lines)
    outcomes = validate_run(spark, run, folder, contracts=CONTRACTS)
    parts = [o.report.select("dataset", "valid_records") for o in outcomes.values()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ---------------------------------------------------------------- partitions

@each_run("partition_write", _months)
def partition_write(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    folder = f"{_partitioned(taken_run(spark, sf_dir, run, PARTITIONED), run)}/raw"
    parts = []
    for name, dataset in DATASETS.items():
        text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", JSON_FILES).text(f"{folder}/{name}")
        # The path is decoded once per file: a first count per file comes before the months.
        files = text.select(F.col("_metadata.file_path").alias("path"), F.get_json_object(
            "value", f"$.{dataset.primary_key}").alias("id")).groupBy("path").agg(
            F.count("*").alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        path = plain_uri(F.col("path"))
        parts.append(files.groupBy(
            F.lit(name).alias("dataset"), F.regexp_extract(path, "/year=([0-9]+)/", 1).alias("year"),
            F.regexp_extract(path, "/month=([0-9]+)/", 1).alias("month"),
        ).agg(F.sum("rows").alias("record_count"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@each_run("partition_manifest", lambda run: with_loaded(_per_dataset("""select count(*) as records_received,
  count(*) as records_partitioned, 0 as records_missing_date, '{event}' as date_field
  from br_{table}"""), run))
def partition_manifest(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    path = f"{_partitioned(taken_run(spark, sf_dir, run, PARTITIONED), run)}/partition_manifest.json"
    manifest = spark.read.option("multiLine", "true").schema(
        "datasets array<struct<dataset string, date_field string, records_received bigint, "
        "records_partitioned bigint, records_missing_date int>>").json(path)
    return manifest.select(F.inline("datasets"))


def _damaged_partitions(spark: SparkSession, sf_dir: str, run: str) -> str:
    """A partitioned run whose manifest, by rank, lists every file twice, climbs out of its
    folder, lists nothing, lists files that are not there, or promises one record more.
    The checks only read it, so the queries of a session share it."""
    key = (spark.sparkContext.applicationId, sf_dir, run)
    if key in _DAMAGED and Storage(spark).exists(_DAMAGED[key]):
        return _DAMAGED[key]
    root, folder = taken_run(spark, sf_dir, run, PARTITIONED), scratch_dir(spark, "partitioned")
    with brief_shuffles(spark):
        partition_run(spark, run, f"{root}/validated/{run}", folder, compressed=True)
    header, files = read_partition_manifest(spark, folder)
    counts = small_rows(spark, [(d["dataset"], d["records_partitioned"]) for d in header["datasets"]],
                        "dataset string, record_count bigint")
    ranks = _ranked(counts)
    rank, name = F.col("rank"), F.col("output_file")
    twice = F.explode(F.array_repeat(
        F.when(rank == 2, F.concat(F.lit("raw/"), "dataset", F.lit("/../"), F.replace(name, F.lit("/"), F.lit("_"))))
        .when(rank == 4, F.concat(name, F.lit(".gone"))).otherwise(name), F.when(rank == 1, 2).otherwise(1)))
    _replace_table(spark, folder, files.join(ranks, "dataset").filter("rank <> 3").select(
        "dataset", twice.alias("output_file")))
    smallest = ranks.filter("rank = 5").first()["dataset"]
    for entry in header["datasets"]:
        entry["records_partitioned"] += entry["dataset"] == smallest
    Storage(spark).write_text(f"{folder}/partition_manifest.json", json.dumps(header))
    _DAMAGED[key] = folder
    return folder


@each_run("partition_manifest_verify", lambda run: with_loaded(f"""
select dataset, case rank when 1 then 'another number of files than promised' when 2 then 'unsafe path'
  when 3 then 'no files listed' when 4 then 'listed file absent'
  else 'another number of records than promised' end as problem from ({_BY_VALID})
union all select dataset, 'partitioned ' || cast(record_count + 1 as varchar) || ' of '
  || cast(record_count as varchar) || ' records' from ({_BY_VALID}) where rank = 5
union all select null, 'total differs from the sum over datasets'""", run))
def partition_manifest_verify(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    folder = _damaged_partitions(spark, sf_dir, run)
    return partition_problems(spark, folder, run).select("dataset", "problem").distinct()


@each_run("publish_manifest_verify", lambda run: with_loaded(f"""
select dataset, case rank when 1 then 'listed more than once' when 3 then 'no files listed'
  else 'listed file absent' end as problem from ({_BY_VALID}) where rank < 5
union all select dataset, 'another number of files than promised' from ({_BY_VALID}) where rank = 1
union all values (null, 'file not listed'), (null, 'total differs from the sum over datasets')""", run))
def publish_manifest_verify(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    folder = _damaged_partitions(spark, sf_dir, run)
    return publish_problems(spark, folder, run).select("dataset", "problem").distinct()


# --------------------------------------------------------------- publication

@each_run("run_publish", lambda run: with_loaded(f"""select state, {_LOADED_TOTAL} as records
from (values ('DRY_RUN'), ('UPLOADED'), ('SKIPPED')) s(state)""", run))
def run_publish(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """A dry run, a publication and its repetition, with the published record count."""
    run_dir, target = _partitioned(taken_run(spark, sf_dir, run, PARTITIONED), run), scratch_dir(spark, "publish")
    states = [publish_run(spark, run_dir, target, run, execute=e) for e in (False, True, True)]
    published = count_records(spark, run_folder(target, "raw", run), f"part-{JSON_FILES}")
    total = published.agg(F.sum("record_count").alias("records"))
    return total.select(F.explode(F.array(*[F.lit(s) for s in states])).alias("state"), "records")


# One listing entry per dataset and month, sized and hashed from its records.
_INVENTORY = """
select concat('transactions/year=', year(o_orderdate), '/month=',
    lpad(cast(month(o_orderdate) as string), 2, '0'), '/', o_orderpriority, '.json') as relative_key,
  count(*) as size, {hash}(cast(sum(o_orderkey) as string){bits}) as sha256
from {source} group by 1"""
_INVENTORY_SPARK = _INVENTORY.format(hash="sha2", bits=", 256", source="{orders}")
_INVENTORY_DUCK = _INVENTORY.format(hash="sha256", bits="", source="orders")


@query("inventory_hash", f"""select sha256(string_agg(relative_key || '|' || cast(size as varchar)
  || '|' || sha256, chr(10) order by relative_key)) as inventory_sha256 from ({_INVENTORY_DUCK})""")
def inventory_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory_sha256(run_sql(spark, sf_dir, _INVENTORY_SPARK))


# The published side: one priority grew, one was altered, one is missing, one is there twice.
_CHANGED = """
select relative_key, case when relative_key like '%URGENT%' then size + 1 else size end as size,
  case when relative_key like '%HIGH%' then 'changed' else sha256 end as sha256
from ({inventory}) x where relative_key not like '%MEDIUM%'
union all select concat('extra/', relative_key), size, sha256
from ({inventory}) y where relative_key like '%LOW%'"""


@query("inventory_diff", f"""
with want as ({_INVENTORY_DUCK}), have as ({_CHANGED.format(inventory=_INVENTORY_DUCK)})
select coalesce(w.relative_key, h.relative_key) as relative_key,
  case when h.size is null then 'missing' when w.size is null then 'unexpected'
       when h.size <> w.size then 'size mismatch' else 'checksum mismatch' end as problem
from want w full join have h on w.relative_key = h.relative_key
where h.size is null or w.size is null or h.size <> w.size or h.sha256 <> w.sha256""")
def inventory_diff_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    want = run_sql(spark, sf_dir, _INVENTORY_SPARK)
    return inventory_diff(want, run_sql(
        spark, sf_dir, _CHANGED.format(inventory=_INVENTORY_SPARK)))


@query("manifest_set_diff", """
select distinct o_orderpriority as name, 'missing' as problem from orders
where o_orderpriority not in (select o_orderpriority from orders where o_totalprice > 499990)
union all select distinct c_mktsegment, 'unexpected' from customer""")
def manifest_set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = run_sql(spark, sf_dir, "select distinct o_orderpriority as name from {orders}")
    found = run_sql(spark, sf_dir, """
        select distinct o_orderpriority as name from {orders} where o_totalprice > 499990
        union all select distinct c_mktsegment from {customer}""")
    return set_difference(found, expected, "name")


@query("marker_match", """
select o_orderkey, o_orderstatus = 'F' and o_orderpriority <> '5-LOW' and o_totalprice > 100000
  as matches from orders""")
def marker_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers that differ from their batch by status, hash or record count."""
    pairs = run_sql(spark, sf_dir, """
        select o_orderkey,
          named_struct('status', if(o_orderstatus = 'F', 'COMPLETE', 'PARTIAL'), 'run_id', 'r',
            'manifest_sha256', if(o_orderpriority = '5-LOW', 'x', 'm'), 'inventory_sha256', 'i',
            'data_file_count', 1L, 'records_partitioned', if(o_totalprice > 100000, o_orderkey, null))
            as marker,
          named_struct('run_id', 'r', 'manifest_sha256', 'm', 'inventory_sha256', 'i',
            'data_file_count', 1L, 'records_partitioned', o_orderkey) as batch
        from {orders}""")
    return pairs.select("o_orderkey", marker_matches("marker", "batch").alias("matches"))


# ---------------------------------------------------------- load and promote

@each_run("load_guardrail", lambda run: with_loaded("""
select 'customers' as dataset, 'found ' || cast(count(*) as varchar)
  || ' rows with an incorrect or missing run ID' as problem from br_customers where customer_age % 8 = 2
union all select 'transactions', 'expected ' || cast(count(*) as varchar) || ' rows, found '
  || cast(count(*) + count(*) filter (where card_network = 'Visa') as varchar) from br_transactions
union all select 'fraud_signals', 'found ' || cast(count(*) as varchar)
  || ' rows without source_row_number metadata' from br_fraud_signals where velocity_count > 3
union all select 'disputes', 'expected files, found 0' from br_disputes group by 2
union all select 'disputes', 'found ' || cast(count(*) as varchar) || ' rows without source_file metadata'
  from br_disputes""", run))
def load_guardrail(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """The published run is landed, then damaged in four of its five tables; the load is blocked."""
    root = taken_run(spark, sf_dir, run, PUBLISHED)
    expected = expected_loads(spark, *read_partition_manifest(spark, _partitioned(root, run)))
    staged = land_run(spark, f"{root}/published/raw", run, LOADED[run])

    def member(name: str, kind: str):
        return F.variant_get("raw_record", f"$.{name}", kind)

    staged["customers"] = staged["customers"].withColumn("pipeline_run_id", F.when(
        member("customer_age", "bigint") % 8 == 2, RUN_A if run == RUN_B else RUN_B).otherwise(F.col("pipeline_run_id")))
    staged["transactions"] = staged["transactions"].unionByName(
        staged["transactions"].filter(member("card_network", "string") == "Visa"))
    staged["fraud_signals"] = staged["fraud_signals"].withColumn("source_row_number", F.when(
        member("velocity_count", "bigint") <= 3, F.col("source_row_number")))
    staged["disputes"] = staged["disputes"].withColumn("source_file", F.lit(None).cast("string"))
    # How many files a month fills is Spark's choice, so that number is left out.
    return guardrail_problems(load_facts(staged, run), expected).select(
        "dataset", F.regexp_replace("problem", "^expected [0-9]+ files", "expected files").alias("problem"))


@query("raw_promote", with_models("\nunion all ".join(
    f"select '{n}' as dataset, pipeline_run_id, count(*) as row_count from br_{n} "
    f"where pipeline_run_id = '{RUN_B}' group by 2" for n in DATASETS)))
def raw_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run A is live, a staged run B stays invisible until its pointer is set."""
    warehouse = scratch_dir(spark, "warehouse")
    raw = {n: landed(spark, sf_dir, n) for n in DATASETS}
    for run in (RUN_A, RUN_B):
        only = {n: df.filter(F.col("pipeline_run_id") == run) for n, df in raw.items()}
        promote(spark, warehouse, write_raw_version(spark, warehouse, run, only))
    parts = [df.groupBy("pipeline_run_id").agg(F.count("*").alias("row_count")).select(
        F.lit(n).alias("dataset"), "*") for n, df in read_raw(spark, warehouse).items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


_MATERIALIZED: dict[tuple[str, str], str] = {}


def _materialized(spark: SparkSession, sf_dir: str) -> str:
    """Warehouse with the stored models of both runs; shared by the queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MATERIALIZED or not live_generation(spark, _MATERIALIZED[key]).models:
        warehouse = scratch_dir(spark, "models")
        raw = {n: landed(spark, sf_dir, n) for n in DATASETS}
        promote(spark, warehouse, write_raw_version(spark, warehouse, "both", raw))
        build_models(spark, warehouse, LOADED[RUN_A])
        _MATERIALIZED[key] = warehouse
    return _MATERIALIZED[key]


@query("materialize", with_models("select * from gold_dispute_chargeback_summary_by_network"))
def materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(read_mart(
        spark, _materialized(spark, sf_dir), "gold_dispute_chargeback_summary_by_network"))


@each_run("mart_scan", lambda run: with_loaded("select * from gold_daily_fraud_kpis", run))
def mart_scan(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    mart = read_mart(spark, f"{finished_run(spark, sf_dir, run)}/warehouse", "gold_daily_fraud_kpis")
    return comparable(in_dashboard_order(mart))


@each_run("batch_run", lambda run: with_loaded("select * from gold_fraud_summary_by_network", run))
def batch_run(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    return comparable(read_mart(
        spark, f"{finished_run(spark, sf_dir, run)}/warehouse", "gold_fraud_summary_by_network"))


# The other stored marts, one query each.
STORED_MARTS = (*MARTS, "monitoring_pipeline_row_counts")
# How many files a load fills is Spark's choice, so a batch's number of them is left out.
_FREE = {"gold_pipeline_batch_metadata": ["source_file_count"]}


def _mart_sql(name: str) -> str:
    return f"select * exclude ({', '.join(_FREE[name])}) from {name}" if name in _FREE else f"select * from {name}"


for _name in STORED_MARTS:
    def _stored(spark: SparkSession, sf_dir: str, name: str = _name) -> DataFrame:
        return comparable(read_mart(spark, _materialized(spark, sf_dir), name))

    def _scanned(spark: SparkSession, sf_dir: str, run: str, name: str = _name) -> DataFrame:
        mart = read_mart(spark, f"{finished_run(spark, sf_dir, run)}/warehouse", name)
        return comparable(in_dashboard_order(mart)).drop(*_FREE.get(name, []))

    def _ordered(spark: SparkSession, sf_dir: str, name: str = _name) -> DataFrame:
        return comparable(in_dashboard_order(displayable(MARTS[name](spark, sf_dir))))

    if _name != "gold_dispute_chargeback_summary_by_network":
        query(f"materialize_{_name}", with_models(f"select * from {_name}"))(_stored)
    if _name != "gold_daily_fraud_kpis":
        each_run(f"mart_scan_{_name}", lambda run, name=_name: with_loaded(_mart_sql(name), run))(_scanned)
    if _name in MARTS and _name != "gold_daily_dispute_kpis":
        query(f"order_marts_{_name}", with_models(f"select * from {_name}"))(_ordered)


# Each record as one text, the same in both engines; the sums of two parts of its digest
# depend on every record of a group, but not on their order.
_TEXT = {MONEY: "cast({} as string)", WHOLE: "cast({} as string)", TIME: "cast({} as string)",
         "double": "cast(cast({} as decimal(18,6)) as string)", "boolean": "cast({} as string)", "string": "{}"}


def _record_text(dataset: str) -> str:
    return " || '|' || ".join(
        f"coalesce({_TEXT[kind].format(name)}, '-')" for name, kind in BRONZE_TYPES[dataset].items())


def _digest_sql(run: str) -> str:
    parts = []
    for n, d in DATASETS.items():
        places = [("raw", f"(select * from all_{n} where pipeline_run_id = '{run}')", False),
                  ("validated", f"br_{n}", False), ("partitioned", f"br_{n}", True), ("landed", f"br_{n}", True)]
        for stage, rows, monthly in places:
            year, month = (f"cast(year({d.event_field}) as varchar)",
                           f"lpad(cast(month({d.event_field}) as varchar), 2, '0')") if monthly else ("''", "''")
            parts.append(f"""select '{stage}' as stage, '{n}' as dataset, year, month, count(*) as record_count,
  sum(('0x' || substr(digest, 1, 8))::bigint)::bigint as digest_1,
  sum(('0x' || substr(digest, 9, 8))::bigint)::bigint as digest_2
from (select {year} as year, {month} as month, md5({_record_text(n)}) as digest from {rows}) group by all""")
    return with_loaded("\nunion all ".join(parts), run)


def digested(rows: DataFrame, stage: str, dataset: str) -> DataFrame:
    """Per year and month folder of (raw_record, source_file) rows: their number and digest."""
    older = rows.withColumns({c: F.lit(None) for c in LINEAGE if c not in rows.columns})
    typed = bronze(older, dataset).withColumn("digest", F.md5(F.expr(_record_text(dataset))))
    # Per file first, so a path is taken apart once per file and not once per record.
    files = typed.groupBy("source_file").agg(F.count("*").alias("rows"), *[
        F.sum(F.conv(F.substr("digest", F.lit(at), F.lit(8)), 16, 10).cast("bigint")).alias(f"part_{i}")
        for i, at in ((1, 1), (2, 9))])
    return files.groupBy(
        F.lit(stage).alias("stage"), F.lit(dataset).alias("dataset"),
        F.regexp_extract("source_file", "/year=([0-9]+)/", 1).alias("year"),
        F.regexp_extract("source_file", "/month=([0-9]+)/", 1).alias("month"),
    ).agg(F.sum("rows").alias("record_count"), *[F.sum(f"part_{i}").alias(f"digest_{i}") for i in (1, 2)])


@each_run("record_digests", _digest_sql)
def record_digests(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """Every record of the snapshot, the valid files, the months and the landed rows."""
    root = taken_run(spark, sf_dir, run, PUBLISHED)
    landed_rows = land_run(spark, f"{root}/published/raw", run, LOADED[run])
    parts = []
    for name, dataset in DATASETS.items():
        def written(folder: str, nested: bool = False) -> DataFrame:
            reader = spark.read.option("recursiveFileLookup", "true") if nested else spark.read
            return reader.option("pathGlobFilter", "part-*").text(folder).select(
                F.parse_json("value").alias("raw_record"), F.col("_metadata.file_path").alias("source_file"))

        stages = {"raw": written(f"{root}/raw/{run}/{dataset.file_name}"),
                  "validated": written(f"{root}/validated/{run}/{name}.json"),
                  "partitioned": written(f"{_partitioned(root, run)}/raw/{name}", nested=True),
                  "landed": landed_rows[name]}
        for stage, rows in stages.items():
            parts.append(digested(rows, stage, name))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@each_run("run_audit_append", lambda run: with_loaded(f"""
select '{run}' as run_id, 'SUCCESS' as status, 6 as steps, delivered as rows_received,
  loaded as rows_valid, delivered - loaded as rows_invalid
from (select {_LOADED_TOTAL} as loaded, {_delivered_total(run)} as delivered)""", run))
def run_audit_append(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    log = f"{finished_run(spark, sf_dir, run)}/pipeline_audit_logs/pipeline_run_audit_log.jsonl"
    # Passes that only went part of the way have a line each, too.
    return spark.read.schema(
        "run_id string, status string, steps array<struct<step_name string, status string>>, "
        "validation_summary struct<rows_received bigint, rows_valid bigint, rows_invalid bigint>",
    ).json(log).filter("array_contains(steps.step_name, 'Build models')").select("run_id", "status", F.size("steps").alias("steps"), "validation_summary.*")


# -------------------------------------------------------------- stream ingest

def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Run A's files are ingested, then run B's and the damaged ones arrive; the second start
    adds only those."""
    base = scratch_dir(spark, "stream")
    for run in (RUN_A, RUN_B):
        if run == RUN_B:
            run_sql(spark, sf_dir, NOISY).filter(~F.col("line").rlike(r"\}$")).select("line") \
                .write.text(f"{base}/incoming/noise")
        clean_lines(spark, sf_dir, "transactions", run).select("line").write.text(f"{base}/incoming/{run}")
        ingest(spark, f"{base}/incoming", f"{base}/table", f"{base}/checkpoint",
               arrivals=Arrivals("*.txt", files_per_trigger=1_000_000), loaded_at=LOADED[run]).awaitTermination()
    return f"{base}/table"


_FIELDS = ", ".join(DATASETS["transactions"].field_names)


@query("stream_ingest_transactions", f"with br as ({for_duckdb(TYPED['transactions'])}) select {_FIELDS} from ("
       + plain("br", BRONZE_COLUMNS["transactions"]) + ")")
def stream_ingest_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_lineage_columns(records(spark, _ingested(spark, sf_dir)))
    return comparable(bronze(rows, "transactions").select(*DATASETS["transactions"].field_names))


@query("stream_ingest_quarantine", f"""{_NOISE} select line as bad_line, problem from kinds
where problem is not null and not regexp_matches(line, '\\}}$')""")
def stream_ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines neither stop the stream nor get lost."""
    return quarantined(spark, _ingested(spark, sf_dir)).select("bad_line", "problem")


@query("stream_ingest_check", "select count(*) as loaded_rows from orders")
def stream_ingest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_rows(records(spark, _ingested(spark, sf_dir)))


@query("latest_ingested", f"""with br as ({for_duckdb(TYPED["transactions"])})
select transaction_id, cast(loaded_at as varchar) as loaded_at from br
order by loaded_at desc, transaction_id limit 10""")
def latest_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest records of the stream's table."""
    return comparable(latest_records(records(spark, _ingested(spark, sf_dir))))
