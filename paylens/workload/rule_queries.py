"""Queries over contract validation of the intake as delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.contracts import DATASETS, HARD_FAIL, QUARANTINE, Dataset
from paylens.operators.verdicts import dataset_summaries, overall_status, run_summary
from paylens.plans.validation import Outcome, in_report_order, suite_reports, validate_suite
from paylens.sources.jsonl import with_records
from paylens.workload.model_queries import query
from paylens.workload.tables import INTAKE, for_duckdb, intake
from paylens.workspace import Storage

_SUITES: dict[tuple[str, str], dict[str, Outcome]] = {}


def intake_batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The intake as parsed batches; line numbers are fixed when a batch is staged."""
    return {n: with_records(intake(spark, sf_dir, n).select(
        F.lit(DATASETS[n].file_name).alias("source_file"),
        (F.monotonically_increasing_id() + 1).alias("line_number"), "line")) for n in DATASETS}


def checked_intake(spark: SparkSession, sf_dir: str) -> dict[str, Outcome]:
    """The validated intake; its stage and failure tables serve all queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    known = _SUITES.get(key)
    if known is None or not Storage(spark).exists(known["customers"].stage.inputFiles()[0]):
        known = _SUITES[key] = validate_suite(intake_batches(spark, sf_dir))
    return known


def all_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [o.failures for o in checked_intake(spark, sf_dir).values()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


# ---------------------------------------------------------------- oracle text

def _member(name: str) -> str:
    return f"json_type(line, '$.{name}') as t_{name}, json_extract_string(line, '$.{name}') as s_{name}"


def _sql_rules(dataset: Dataset) -> list[tuple[str, str, str]]:
    names = ", ".join(f"'{n}'" for n in dataset.field_names)
    rules = [("record", "additionalProperties",
              f"len(list_filter(json_keys(line), lambda k: k not in ({names}))) > 0")]
    rules += [("record", "required", f"t_{n} is null") for n in dataset.field_names]
    for f in dataset.fields:
        t, s = f"t_{f.name}", f"s_{f.name}"
        numeric = f"{t} in ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE')"
        number = f"case when {numeric} then try_cast({s} as double) end"
        rules.append((f.name, "type", {
            "string": f"{t} <> 'VARCHAR'",
            "boolean": f"{t} <> 'BOOLEAN'",
            "number": f"{t} is not null and not ({numeric})",
            "integer": f"{t} is not null and not coalesce(({number}) = floor({number}), false)",
        }[f.kind]))
        if f.enum:
            values = ", ".join(f"'{v}'" for v in f.enum)
            rules.append((f.name, "enum",
                          f"{t} is not null and not ({t} = 'VARCHAR' and {s} in ({values}))"))
        if f.pattern:
            rules.append((f.name, "pattern",
                          f"{t} = 'VARCHAR' and not regexp_matches({s}, '{f.pattern.removesuffix("$")}\\n?$')"))
        for keyword, bound, sign in (("minimum", f.minimum, "<"), ("maximum", f.maximum, ">"),
                                     ("exclusiveMinimum", f.exclusive_minimum, "<=")):
            if bound is not None:
                rules.append((f.name, keyword, f"({number}) {sign} {bound}"))
        if f.format:
            shape = "%Y-%m-%d" if f.format == "pipeline-date" else "%Y-%m-%d %H:%M:%S"
            rules.append((f.name, "format", f"{t} = 'VARCHAR' and coalesce("
                          f"strftime(try_strptime({s}, '{shape}'), '{shape}') <> {s}, true)"))
    return rules


def _dataset_ctes(dataset: Dataset) -> str:
    n, pk = dataset.name, dataset.primary_key
    flags = " + ".join(f"(case when {p} then 1 else 0 end)" for _, _, p in _sql_rules(dataset))
    ctes = f"""i_{n} as materialized (select line, {", ".join(_member(f) for f in dataset.field_names)}
  from ({for_duckdb(INTAKE[n])})),
u_{n} as (select *, case when t_{pk} is null then 'UNKNOWN' else s_{pk} end as record_id,
  {flags} as schema_n, s_{pk} is not null and count(*) over (partition by s_{pk}) > 1 as dup,
  try_strptime(case when t_{dataset.event_field} = 'VARCHAR' then s_{dataset.event_field} end,
    '%Y-%m-%d %H:%M:%S') as ts from i_{n}),
"""
    refs, joins = [], []
    for i, reference in enumerate(dataset.references):
        parent = DATASETS[reference.parent]
        on = " and ".join(f"u.s_{f} = p{i}.s_{f}" for f in reference.fields)
        present = " and ".join(f"u.s_{f} is not null" for f in reference.fields)
        joins.append(f"left join v_{parent.name} p{i} on {on}")
        refs.append(f"(case when {present} and p{i}.s_{parent.primary_key} is null "
                    f"then 1 else 0 end) as ref_{i}")
    ref_sum = " + ".join(f"ref_{i}" for i in range(len(refs))) or "0"
    ref_columns = "".join(f", {r}" for r in refs)
    ctes += f"""r_{n} as (select *, {ref_sum} as ref_n,
    floor((epoch(max(ts) over ()) - epoch(ts)) / 86400) as days
  from (select u.*{ref_columns} from u_{n} u {" ".join(joins)})),
v_{n} as (select * from r_{n} where schema_n = 0 and not dup and ref_n = 0)"""
    return ctes


INTAKE_CTES = ",\n".join(_dataset_ctes(d) for d in DATASETS.values())


def _failure_rows(keywords: set[str], only_format: str | None = None) -> str:
    parts = []
    for d in DATASETS.values():
        for field, keyword, predicate in _sql_rules(d):
            if keyword not in keywords:
                continue
            if only_format and d.field(field).format != only_format:
                continue
            parts.append(f"select '{d.name}' as dataset, record_id, '{field}' as field, "
                         f"'{keyword}' as rule, 'hard_fail' as severity from u_{d.name} where {predicate}")
    return "\nunion all ".join(parts)


def with_intake(sql: str) -> str:
    return f"with {INTAKE_CTES}\n{sql}"


# ----------------------------------------------------------------- rule rows

COLUMNS = ["dataset", "record_id", "field", "rule", "severity"]


def _register_rule(name: str, keyword: str, only_format: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = all_failures(spark, sf_dir).filter(F.col("rule") == keyword)
        if only_format:
            fields = [f.name for d in DATASETS.values() for f in d.fields if f.format == only_format]
            found = found.filter(F.col("field").isin(fields))
        return found.select(*COLUMNS)

    query(name, with_intake(_failure_rows({keyword}, only_format)))(run)


for _name, _keyword in (
        ("rule_required", "required"), ("rule_additional_properties", "additionalProperties"),
        ("rule_type", "type"), ("rule_enum", "enum"), ("rule_pattern", "pattern"),
        ("rule_minimum", "minimum"), ("rule_maximum", "maximum"),
        ("rule_exclusive_minimum", "exclusiveMinimum")):
    _register_rule(_name, _keyword)
_register_rule("rule_format_date", "format", "pipeline-date")
_register_rule("rule_format_datetime", "format", "pipeline-date-time")


@query("rule_unique", with_intake("\nunion all ".join(
    f"select '{n}' as dataset, record_id, '{d.primary_key}' as field, 'unique' as rule, "
    f"'hard_fail' as severity, 'Duplicate primary key found: ' || record_id as message "
    f"from u_{n} where dup" for n, d in DATASETS.items())))
def rule_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_failures(spark, sf_dir).filter(F.col("rule") == "unique").select(*COLUMNS, "message")


def _reference_rows() -> str:
    parts = []
    for n, d in DATASETS.items():
        for i, r in enumerate(d.references):
            label = ", ".join(r.fields)
            parts.append(f"select '{n}' as dataset, record_id, '{label}' as field, "
                         f"'referential_integrity' as rule, 'quarantine_continue' as severity "
                         f"from r_{n} where ref_{i} = 1")
    return "\nunion all ".join(parts)


@query("rule_referential", with_intake(_reference_rows()))
def rule_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_failures(spark, sf_dir).filter(
        F.col("rule") == "referential_integrity").select(*COLUMNS)


@query("ri_anti", with_intake("""
select record_id, 'transactions.(customer_id, account_id) value (''' || s_customer_id || ''', '''
  || s_account_id || ''') does not reference a valid customers.(customer_id, account_id) record.'
  as message from r_transactions where ref_1 = 1"""))
def ri_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = checked_intake(spark, sf_dir)["transactions"].failures
    return failures.filter(F.col("field") == "customer_id, account_id").select("record_id", "message")


@query("rule_late_event", with_intake("\nunion all ".join(
    f"select '{n}' as dataset, record_id, '{d.event_field}' as field, 'warn_continue' as severity, "
    f"'Transaction timestamp is ' || cast(cast(days as bigint) as varchar) || "
    f"' days older than latest record in batch.' as message from r_{n} where days > 365"
    for n, d in DATASETS.items())))
def rule_late_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_failures(spark, sf_dir).filter(F.col("rule") == "late_arriving_event").select(
        "dataset", "record_id", "field", "severity", "message")


# ------------------------------------------------------------------- verdicts

def report_sql(columns: str) -> str:
    parts = []
    for n in DATASETS:
        parts.append(f"""select '{n}' as dataset, count(*) as total_records,
    cast(count(*) filter (where schema_n > 0 or dup or ref_n > 0) as bigint) as invalid_records,
    cast(sum(schema_n) + count(*) filter (where dup) as bigint) as hard, cast(sum(ref_n) as bigint) as quarantined,
    cast(count(*) filter (where days > 365) as bigint) as warning_count from r_{n}""")
    return with_intake(f"""select {columns} from (select *,
    case when hard > 0 then 'FAILED' when quarantined > 0 then 'PASSED_WITH_QUARANTINE'
         when warning_count > 0 then 'PASSED_WITH_WARNINGS' else 'PASSED' end as batch_status
  from ({" union all ".join(parts)}))""")


ACTION = """case batch_status when 'FAILED' then 'BLOCK_S3_UPLOAD'
  when 'PASSED_WITH_QUARANTINE' then 'UPLOAD_VALID_RECORDS_ONLY' else 'UPLOAD_ALL_RECORDS' end"""


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite_reports(checked_intake(spark, sf_dir))


@query("batch_status", report_sql(f"dataset, batch_status, {ACTION} as pipeline_action"))
def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("dataset", "batch_status", "pipeline_action")


@query("overall_status", report_sql(
    "case when count(*) filter (where batch_status = 'FAILED') > 0 then 'FAILED' else 'PASSED' end as overall_status"))
def overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overall_status(reports(spark, sf_dir))


@query("report_counts", report_sql(
    "dataset, total_records, total_records - invalid_records as valid_records, invalid_records, "
    "warning_count, hard as hard_failures, quarantined as quarantine_failures"))
def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_severity = F.col("error_count_by_severity")

    def count(name: str):
        return F.coalesce(F.try_element_at(by_severity, F.lit(name)), F.lit(0))

    return reports(spark, sf_dir).select(
        "dataset", "total_records", "valid_records", "invalid_records", "warning_count",
        count(HARD_FAIL).alias("hard_failures"), count(QUARANTINE).alias("quarantine_failures"))


_SPLIT = """sum(case when batch_status = 'PASSED_WITH_QUARANTINE' then invalid_records else 0 end)::bigint
  as rows_quarantined,
  sum(case when batch_status = 'FAILED' then invalid_records else 0 end)::bigint as rows_rejected"""


@query("validation_summary", report_sql(f"""sum(total_records)::bigint as rows_received,
  sum(total_records - invalid_records)::bigint as rows_valid,
  sum(invalid_records)::bigint as rows_invalid, {_SPLIT}, sum(warning_count)::bigint as warnings"""))
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(reports(spark, sf_dir))


@query("validation_summary_by_dataset", report_sql(f"""dataset, batch_status as status,
  {ACTION} as pipeline_action, total_records as rows_received,
  total_records - invalid_records as rows_valid, invalid_records as rows_invalid,
  case when batch_status = 'PASSED_WITH_QUARANTINE' then invalid_records else 0 end as rows_quarantined,
  case when batch_status = 'FAILED' then invalid_records else 0 end as rows_rejected,
  warning_count as warnings"""))
def validation_summary_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_summaries(reports(spark, sf_dir))


# --------------------------------------------------------- valid/invalid split

@query("valid_only_select", with_intake("\nunion all ".join(
    f"select '{n}' as dataset, line from v_{n}" for n in DATASETS)))
def valid_only_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [o.valid_rows.select("dataset", "line")
              for o in checked_intake(spark, sf_dir).values()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query("ri_quarantine_split", with_intake("\nunion all ".join(
    f"select '{n}' as dataset, line, schema_n > 0 or dup or ref_n > 0 as quarantined from r_{n}"
    for n in DATASETS)))
def ri_quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [o.split_rows.select(F.lit(n).alias("dataset"), "line", (~F.col("valid")).alias("quarantined"))
             for n, o in checked_intake(spark, sf_dir).items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


_SCHEMA_KEYWORDS = {"required", "additionalProperties", "type", "enum", "pattern", "minimum",
                    "maximum", "exclusiveMinimum", "format"}


_ORDER_ROWS = f"""{_failure_rows(_SCHEMA_KEYWORDS)}
union all {" union all ".join(f"select '{n}', record_id, '{d.primary_key}', 'unique', 'hard_fail' from u_{n} where dup"
                              for n, d in DATASETS.items())}
union all {_reference_rows()}
union all {" union all ".join(f"select '{n}', record_id, '{d.event_field}', 'late_arriving_event', 'warn_continue' "
                              f"from r_{n} where days > 365" for n, d in DATASETS.items())}"""


@query("order_failures", with_intake(f"select dataset, record_id, field, rule, severity from ({_ORDER_ROWS})"))
def order_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dataset's failures, each dataset in its report's order."""
    parts = [in_report_order(o.failures).select(*COLUMNS) for o in checked_intake(spark, sf_dir).values()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
