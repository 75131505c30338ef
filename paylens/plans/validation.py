"""Contract validation of a run: staged lines in, failures and verdicts out."""

from __future__ import annotations

from concurrent.futures import Future, ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.contracts import (
    DATASETS, HARD_FAIL, WARN, Dataset, with_ancestors, with_schema)
from paylens.functions.calendar import event_time
from paylens.functions.identifiers import check_run_id
from paylens.functions.json_fields import member_text, typed_key
from paylens.operators.lateness import late_rows
from paylens.operators.references import key_column, missing_references
from paylens.operators.schema_rules import (
    RULE_GROUPS, expand_broken_rules, failure, with_broken_rules)
from paylens.operators.uniqueness import repeated_rows
from paylens.operators.verdicts import dataset_report
from paylens.sources.jsonl import (
    NOT_JSON, PLACE, explained, numbered, scan_json_lines, split_index, stripped)
from paylens.workspace import Storage, settle, together, workers_for

#: A row's place, which also is its order; numbers are looked up for failures only.
ROW_ID = PLACE
FAILURE_COLUMNS = ["rule_group", "seq", "field", "rule", "severity", "message"]


def key_fields(dataset: Dataset) -> list[str]:
    """Fields used as primary key, as child key or as somebody's parent key."""
    used = {dataset.primary_key}
    for reference in dataset.references:
        used |= set(reference.fields)
    for other in DATASETS.values():
        for reference in other.references:
            if reference.parent == dataset.name:
                used |= set(reference.fields)
    return [name for name in dataset.field_names if name in used]


def stage_rows(parsed: DataFrame, dataset: Dataset) -> DataFrame:
    """Parsed lines with everything later rules need, so JSON is parsed once.

    Lines that come with a number keep it; those of a scan keep their place,
    and blank lines, which the numbers of the others depend on.
    """
    pk, when = dataset.primary_key, f"_string_{dataset.event_field}"
    if "line_number" in parsed.columns:
        parsed = parsed.withColumns({"split_start": F.lit(0).cast("bigint"), "row_id": F.col("line_number"),
                                     "blank": F.lit(False)})
    checked = with_broken_rules(parsed, dataset)
    strings = {f: f"_string_{f}" for f in key_fields(dataset) if f"_string_{f}" in checked.columns}
    own = F.when(F.col(f"_kind_{pk}").isNull(), "UNKNOWN")
    if pk in strings:
        own = own.when(F.col(f"_kind_{pk}") == "STRING", F.col(strings[pk]))
    return checked.select(
        F.lit(dataset.name).alias("dataset"),
        *ROW_ID,
        *[c for c in ("line_number",) if c in parsed.columns],
        "blank",
        "line",
        "problem",
        own.otherwise(member_text("record", pk)).alias("record_id"),
        *[typed_key("record", f"_kind_{f}", f, strings.get(f)).alias(key_column(f)) for f in key_fields(dataset)],
        event_time(F.col(when)).alias("event_time"),
        "broken",
    )


def _place(rows: DataFrame) -> list[str]:
    return [*ROW_ID, *[c for c in ("line_number",) if c in rows.columns]]


def _long(rows: DataFrame, invalid_value=None) -> DataFrame:
    return rows.select(
        "dataset", *_place(rows), "record_id",
        *[F.col(f"failure.{c}").alias(c) for c in FAILURE_COLUMNS],
        (F.lit(None).cast("string") if invalid_value is None else invalid_value)
        .alias("invalid_value"))


def malformed_failures(stage: DataFrame) -> DataFrame:
    """Malformed lines; of those that are no JSON at all, with the decoder's message."""
    rows = stage.filter(F.col("problem").isNotNull()).select("dataset", *_place(stage), "record_id", "line", "problem")
    rows = explained(rows.filter(F.col("problem") == NOT_JSON)).unionByName(rows.filter(F.col("problem") != NOT_JSON))
    broken = rows.withColumn("failure", failure(
        "schema", 0, F.lit(None).cast("string"), "valid_json_lines", HARD_FAIL, F.col("problem")))
    return _long(broken, stripped(F.col("line")))


def contract_failures(stage: DataFrame, dataset: Dataset) -> DataFrame:
    broken = stage.filter(F.size("broken") > 0).select(
        "dataset", *_place(stage), "record_id", "line", "broken")
    return _long(expand_broken_rules(broken, dataset))


def duplicate_failures(stage: DataFrame, dataset: Dataset) -> DataFrame:
    narrow = stage.select("dataset", *_place(stage), "record_id", key_column(dataset.primary_key))
    copies = repeated_rows(narrow, key_column(dataset.primary_key))
    return _long(copies.withColumn("failure", failure(
        "unique", 0, F.lit(dataset.primary_key), "unique", HARD_FAIL,
        F.concat(F.lit("Duplicate primary key found: "), F.col("record_id")))))


def reference_failures(stage: DataFrame, dataset: Dataset,
                       valid_parents: dict[str, DataFrame]) -> DataFrame:
    keys = sorted({key_column(f) for r in dataset.references for f in r.fields})
    narrow = stage.select("dataset", *_place(stage), "record_id", *keys)
    return _long(missing_references(narrow, dataset, valid_parents))


def late_warnings(stage: DataFrame, dataset: Dataset) -> DataFrame:
    late = late_rows(stage.select("dataset", *_place(stage), "record_id", "event_time"))
    return _long(late.withColumn("failure", failure(
        "late_arriving_event", 0, F.lit(dataset.event_field), "late_arriving_event", WARN,
        F.concat(F.lit("Transaction timestamp is "), F.col("days_behind").cast("string"),
                 F.lit(" days older than latest record in batch.")))))


def find_failures(stage: DataFrame, dataset: Dataset, malformed: bool,
                  valid_parents: dict[str, DataFrame] | None) -> DataFrame:
    """All failures of one batch, long form.

    A batch with any malformed line reports only its malformed lines.
    ``valid_parents=None`` checks a standalone file without relationships.
    """
    if malformed:
        return malformed_failures(stage)
    found = contract_failures(stage, dataset).unionByName(duplicate_failures(stage, dataset))
    if valid_parents is not None and dataset.references:
        found = found.unionByName(reference_failures(stage, dataset, valid_parents))
    return found.unionByName(late_warnings(stage, dataset))


def in_report_order(failures: DataFrame) -> DataFrame:
    """Rule family first; schema failures by line then path, relationships by rule then line."""
    by_rule = F.when(F.col("rule_group") == RULE_GROUPS["referential_integrity"], F.col("seq"))
    return failures.orderBy("rule_group", F.coalesce(by_rule, F.lit(0)), "source_file", "line_number", "seq")


@dataclass
class Outcome:
    """One validated dataset: staged lines, their failures, and the split they imply."""

    dataset: Dataset
    stage: DataFrame
    found: DataFrame
    malformed: bool

    @property
    def failures(self) -> DataFrame:
        """One row per failure, with its line number."""
        return self.found.drop("split_start", "row_id")

    @property
    def invalid_ids(self) -> DataFrame:
        return self.found.filter(F.col("severity") != WARN).select(*ROW_ID).distinct()

    @property
    def split_rows(self) -> DataFrame:
        """line, valid (and the row's place): each staged row once, by one join.

        Rows that break the contract are known without it; the join moves text
        for the others' duplicate and relationship failures only once.
        """
        if self.malformed:
            return self.stage.filter(F.lit(False)).withColumn("valid", F.lit(False))
        found = self.invalid_ids.withColumn("_invalid", F.lit(True))
        return self.stage.select(*ROW_ID, "line").join(found, ROW_ID, "left").select(
            *ROW_ID, "line", F.col("_invalid").isNull().alias("valid"))

    @property
    def valid_rows(self) -> DataFrame:
        """A batch with a malformed line has no valid rows."""
        if self.malformed:
            return self.stage.filter(F.lit(False))
        return self.stage.join(self.invalid_ids, ROW_ID, "left_anti")

    @property
    def invalid_rows(self) -> DataFrame:
        if self.malformed:
            return self.stage.filter(F.lit(False))
        return self.stage.join(self.invalid_ids, ROW_ID, "left_semi")

    @property
    def valid_keys(self) -> DataFrame:
        """Key columns children may refer to; rows with a null lead key drop out."""
        keys = [key_column(f) for f in key_fields(self.dataset)]
        valid = self.valid_rows.select(*keys)
        return valid.filter(F.col(key_column(self.dataset.primary_key)).isNotNull())

    @property
    def report(self) -> DataFrame:
        return dataset_report(self.stage, self.failures, self.dataset.name)


@dataclass
class Staged:
    """A written stage, and the index of its splits unless its lines came with numbers."""

    rows: DataFrame
    index: DataFrame | None


def stage_batch(parsed: DataFrame, dataset: Dataset) -> Staged:
    written = settle(stage_rows(parsed, dataset), f"stage-{dataset.name}")
    index = None if "line_number" in written.columns else split_index(written)
    return Staged(written.filter(~F.col("blank")).drop("blank"), index)


def check_stage(staged: Staged, dataset: Dataset,
                valid_parents: dict[str, DataFrame] | None) -> Outcome:
    stage = staged.rows
    malformed = not stage.filter(F.col("problem").isNotNull()).isEmpty()
    found = find_failures(stage, dataset, malformed, valid_parents)
    if staged.index is not None:
        place = [F.col(c) for c in ROW_ID[1:]]
        kept = found.withColumns({f"_{c}": v for c, v in zip(ROW_ID[1:], place)})
        found = numbered(kept, staged.index).withColumnsRenamed({f"_{c}": c for c in ROW_ID[1:]})
    return Outcome(dataset, stage, settle(found, f"failures-{dataset.name}"), malformed)


def validate_lines(parsed: DataFrame, dataset: Dataset,
                   valid_parents: dict[str, DataFrame] | None) -> Outcome:
    """Validate one batch of parsed lines (see ``sources.jsonl.with_records``).

    The stage and the failures are each written once: JSON is parsed a single
    time, every rule shuffles only row ids and keys, and the record text moves
    again only for the final valid/invalid split.
    """
    return check_stage(stage_batch(parsed, dataset), dataset, valid_parents)


def validate_suite(batches: dict[str, DataFrame],
                   contracts: dict[str, Dataset] = DATASETS) -> dict[str, Outcome]:
    """Validate several datasets; a failed parent still lends its valid rows.

    Staging needs no parent, so all batches are staged at once; each check
    starts when its own stage and its parents' outcomes are there.
    """
    names = [n for n in DATASETS if n in batches]
    running: dict[str, Future[Outcome]] = {}

    def validate(name: str) -> Outcome:
        stage = stage_batch(batches[name], contracts[name])
        parents = {r.parent for r in contracts[name].references} & set(names)
        return check_stage(stage, contracts[name],
                           {p: running[p].result().valid_keys for p in parents})

    # Parents are submitted first, so what a batch waits for is running or done.
    with ThreadPoolExecutor(max_workers=workers_for(len(names))) as pool:
        for name in names:
            running[name] = pool.submit(copy_context().run, validate, name)
    return {n: running[n].result() for n in names}


def load_contracts(spark: SparkSession, folder: str) -> dict[str, Dataset]:
    """The datasets with the contracts of ``<folder>/<dataset>.schema.json``."""
    storage = Storage(spark)
    return {n: with_schema(d, storage.read_text(f"{folder.rstrip('/')}/{n}.schema.json")) for n, d in DATASETS.items()}


def validate_run(spark: SparkSession, run_id: str, raw_run_dir: str,
                 dataset: str | None = None,
                 contracts: dict[str, Dataset] = DATASETS) -> dict[str, Outcome]:
    """Validate a raw snapshot; naming one dataset also validates its ancestors."""
    check_run_id(run_id)
    names = with_ancestors(dataset) if dataset else tuple(DATASETS)
    return validate_suite(together({
        n: partial(scan_json_lines, spark, f"{raw_run_dir}/{DATASETS[n].file_name}")
        for n in names}), contracts)


def validate_file(spark: SparkSession, dataset: str, path: str) -> Outcome:
    """Validate one standalone file; relationships are not checked."""
    return validate_lines(scan_json_lines(spark, path), DATASETS[dataset], None)


def suite_reports(outcomes: dict[str, Outcome]) -> DataFrame:
    """One report row per validated dataset."""
    frames = [o.report for o in outcomes.values()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
