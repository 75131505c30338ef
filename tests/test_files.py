import hashlib
import json

import pytest
from conftest import RUN_ID, as_lines, chargeback, clean_run, customer
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paylens.contracts import DATASETS
from paylens.operators.inventory import inventory_sha256
from paylens.plans.batch import run_batch
from paylens.plans.validation import validate_lines
from paylens.sinks.outcomes import write_outcome
from paylens.sinks.partitions import (
    MANIFEST, partition_problems, partition_run, publish_problems, read_partition_manifest,
    write_partitions)
from paylens.sinks.materialise import read_mart
from paylens.sinks.promotion import guardrail_problems, load_run, read_raw
from paylens.sinks.publishing import PublishConflict, load_batch, publish_run, run_folder
from paylens.sinks.snapshots import create_snapshot, snapshot_problems
from paylens.sources.landing import land_dataset, with_lineage_columns


def texts(df):
    return sorted(" ".join(str(v) for v in r if v is not None) for r in df.collect())


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory):
    """A partitioned clean run; tests that change it work on a copy."""
    root = tmp_path_factory.mktemp("partitioned")
    for name, records in clean_run().items():
        (root / "validated").mkdir(exist_ok=True)
        (root / "validated" / f"{name}.json").write_text(
            "\n".join(json.dumps(r) for r in records) + "\n")
    partition_run(spark, RUN_ID, str(root / "validated"), str(root / "run"))
    return root / "run"


@pytest.fixture
def run_dir(partitioned, tmp_path):
    import shutil
    return shutil.copytree(partitioned, tmp_path / "run", ignore=shutil.ignore_patterns("*.crc"))


def rewrite(path, text):
    """Change a file the way an outsider would, leaving no stale local checksum."""
    path.write_text(text)
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)


def edit_manifest(run_dir, change):
    path = run_dir / MANIFEST
    manifest = json.loads(path.read_text())
    change(manifest)
    rewrite(path, json.dumps(manifest))


# ------------------------------------------------------------------ snapshots

def test_snapshot_is_written_once_and_verified(spark, tmp_path):
    lines = as_lines(spark, clean_run())
    folder, existed = create_snapshot(spark, str(tmp_path), RUN_ID, lines, seed=1)
    assert not existed
    assert create_snapshot(spark, str(tmp_path), RUN_ID, lines, seed=1) == (folder, True)
    with pytest.raises(ValueError, match="1 problems, listed in .*another seed"):
        create_snapshot(spark, str(tmp_path), RUN_ID, lines, seed=2)
    assert sorted(p.name for p in tmp_path.iterdir()) == [RUN_ID, "_problems"]

    part = next((tmp_path / RUN_ID / "customers.json").glob("part-*"))
    content = part.read_text()
    rewrite(part, content.replace("Active", "Closed"))
    assert "content differs" in texts(snapshot_problems(spark, folder, RUN_ID))[0]
    part.write_text(content + "\n\n")
    assert "size differs" in texts(snapshot_problems(spark, folder, RUN_ID))[0]
    part.unlink()
    assert any("file absent" in t for t in texts(snapshot_problems(spark, folder, RUN_ID)))


def test_plain_manifest_with_one_file_per_dataset(spark, tmp_path):
    files = {}
    for name, records in clean_run().items():
        content = "".join(json.dumps(r) + "\n" for r in records).encode()
        (tmp_path / f"{name}.json").write_bytes(content)
        files[name] = {"file_name": f"{name}.json", "record_count": len(records),
                       "file_size_bytes": len(content), "sha256": hashlib.sha256(content).hexdigest()}
    manifest = {"run_id": RUN_ID, "seed": 3, "files": files}
    (tmp_path / "raw_manifest.json").write_text(json.dumps(manifest))
    assert texts(snapshot_problems(spark, str(tmp_path), RUN_ID, 3, counts=True)) == []
    files["customers"]["record_count"] = 9
    del files["disputes"]
    (tmp_path / "raw_manifest.json").write_text(json.dumps(manifest))
    assert texts(snapshot_problems(spark, str(tmp_path), "other", 3, counts=True)) == [
        "customers customers.json record count differs", "disputes dataset not listed",
        "disputes disputes.json file not listed", "manifest belongs to another run"]


# ------------------------------------------------------------------- outcomes

def test_outcome_files(spark, parsed, tmp_path):
    parents = {"disputes": spark.createDataFrame([("s:DISP_0000834",)], "key_dispute_id string")}
    outcome = validate_lines(parsed([
        chargeback(8888888, 834), chargeback(9999999, 9999999)]), DATASETS["chargeback_outcomes"], parents)
    report = write_outcome(spark, outcome, RUN_ID, str(tmp_path))
    assert (report["batch_status"], report["invalid_records"]) == ("PASSED_WITH_QUARANTINE", 1)
    read = lambda path: [r[0] for r in spark.read.text(path).collect()]
    assert [json.loads(x) for x in read(report["validated_file"])] == [chargeback(8888888, 834)]
    assert [json.loads(x) for x in read(report["quarantine_file"])] == [chargeback(9999999, 9999999)]


def test_failed_batch_has_quarantine_but_no_validated_file(spark, parsed, tmp_path):
    ok = validate_lines(parsed([customer(1)]), DATASETS["customers"], None)
    assert write_outcome(spark, ok, RUN_ID, str(tmp_path))["validated_file"]
    bad = validate_lines(parsed([customer(1), customer(2, state="x")]), DATASETS["customers"], None)
    report = write_outcome(spark, bad, RUN_ID, str(tmp_path))
    assert report["validated_file"] is None and report["quarantine_file"]
    assert not (tmp_path / "validated" / RUN_ID / "customers.json").exists()


def test_validated_rows_keep_input_order(spark, parsed, tmp_path):
    outcome = validate_lines(parsed([customer(n) for n in range(300, 0, -1)]), DATASETS["customers"], None)
    report = write_outcome(spark, outcome, RUN_ID, str(tmp_path))
    import pathlib
    parts = sorted(pathlib.Path(report["validated_file"]).glob("part-*"))
    ids = [json.loads(x)["customer_id"] for p in parts for x in p.read_text().splitlines()]
    assert ids == [f"CUST_{n:06d}" for n in range(300, 0, -1)]


# ----------------------------------------------------------------- partitions

def test_partition_counts_missing_dates_and_rejects_bad_ones(spark, tmp_path):
    path = tmp_path / "customers.json"
    path.write_text("\n".join(json.dumps(r) for r in (
        customer(1, created_at="2026-01-31"), customer(2, created_at="2026-02-01"),
        customer(3, created_at=""), customer(4, created_at=None),
        {k: v for k, v in customer(5).items() if k != "created_at"})))
    entry = write_partitions(spark, DATASETS["customers"], str(path), str(tmp_path / "out"))
    assert (entry["records_received"], entry["records_partitioned"], entry["records_missing_date"],
            entry["partition_count"]) == (5, 2, 3, 2)
    folders = {p.parent.name for p in (tmp_path / "out").rglob("*.json")}
    assert folders == {"month=01", "month=02"}
    path.write_text(json.dumps(customer(1, created_at="31.01.2026")))
    with pytest.raises(PySparkException, match="invalid created_at value"):
        write_partitions(spark, DATASETS["customers"], str(path), str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError):
        write_partitions(spark, DATASETS["customers"], str(tmp_path / "none"), str(tmp_path / "out"))


def test_integer_written_as_float_survives(spark, tmp_path):
    (tmp_path / "customers.json").write_text(json.dumps(customer(1, customer_age=45.0)))
    write_partitions(spark, DATASETS["customers"], str(tmp_path / "customers.json"), str(tmp_path / "o"))
    written = next((tmp_path / "o").rglob("*.json")).read_text()
    assert json.loads(written) == customer(1, customer_age=45)


def test_manifest_checks(spark, run_dir):
    assert texts(partition_problems(spark, str(run_dir), RUN_ID)) == []
    assert texts(publish_problems(spark, str(run_dir), RUN_ID)) == []

    def change(m):
        m["run_id"] = "other"
        m["dataset_count"] = 4
        m["datasets"][0]["records_missing_date"] = 1
        m["datasets"][1]["records_partitioned"] = 3
        m["datasets"][2]["partition_count"] = 9
        m["datasets"][4]["dataset"] = "extra"

    edit_manifest(run_dir, change)
    found = " | ".join(texts(partition_problems(spark, str(run_dir), RUN_ID)))
    for part in ("another run", "chargeback_outcomes is not in the manifest", "extra is unknown",
                 "another number of datasets", "customers has records without a date",
                 "transactions partitioned 3 of 4", "transactions another number of records than promised",
                 "fraud_signals another number of files than promised", "total differs from the sum"):
        assert part in found, part


def test_missing_extra_and_unsafe_files(spark, run_dir):
    data = next((run_dir / "raw" / "customers").rglob("*.json"))
    (data.parent / "extra.json").write_text("{}\n")
    assert texts(publish_problems(spark, str(run_dir), RUN_ID))[0].endswith("file not listed")
    data.unlink()
    assert any("listed file absent" in t for t in texts(partition_problems(spark, str(run_dir), RUN_ID)))

    def inline(m):
        del m["files_table"]
        for d in m["datasets"]:
            d["output_files"] = [f"raw\\{d['dataset']}\\..\\x.json", f"/raw/{d['dataset']}/y.json"]

    edit_manifest(run_dir, inline)
    assert read_partition_manifest(spark, str(run_dir))[1].count() == 10
    found = texts(partition_problems(spark, str(run_dir), RUN_ID))
    assert sum("unsafe path" in t for t in found) == 10


# ---------------------------------------------------------------- publication

def test_inventory_hash_matches_hashlib(spark):
    files = [("a.b", 1, "x"), ("a", 22, "y"), ("a/b", 3, "z")]
    text = "\n".join(f"{k}|{s}|{h}" for k, s, h in sorted(files))
    df = spark.createDataFrame(files, "relative_key string, size bigint, sha256 string")
    assert inventory_sha256(df).first()[0] == hashlib.sha256(text.encode()).hexdigest()


def test_publish_states(spark, run_dir, tmp_path):
    target = tmp_path / "bucket"
    publish = lambda **kw: publish_run(spark, str(run_dir), str(target), RUN_ID, **kw)
    assert publish() == "DRY_RUN" and not target.exists()
    assert publish(execute=True) == "UPLOADED"
    folder = target / "raw" / f"run_id={RUN_ID}"
    marker = json.loads((folder / "_SUCCESS.json").read_text())
    batch = load_batch(spark, str(run_dir), RUN_ID)
    assert marker["status"] == "COMPLETE" and marker["records_partitioned"] == 20
    assert {k: marker[k] for k in batch.facts} == batch.facts
    assert not list(target.rglob("*.tmp"))
    assert publish(execute=True) == "SKIPPED"

    (folder / "stray.json").write_text("{}")
    with pytest.raises(PublishConflict, match="stray.json unexpected"):
        publish(execute=True)
    assert publish(execute=True, allow_overwrite=True) == "UPLOADED"
    assert not (folder / "stray.json").exists()
    for hidden in ("_stray.json", "customers/.stray.json"):
        (folder / hidden).write_text("{}")
        with pytest.raises(PublishConflict, match="stray.json unexpected"):
            publish(execute=True)
        (folder / hidden).unlink()
    assert publish(execute=True) == "SKIPPED"

    (folder / "_SUCCESS.json").unlink()
    with pytest.raises(PublishConflict, match="holds a partial batch"):
        publish(execute=True)
    rewrite(folder / "_SUCCESS.json", json.dumps(marker | {"inventory_sha256": "other"}))
    with pytest.raises(PublishConflict, match="holds a foreign batch"):
        publish(execute=True)
    assert str(folder) == run_folder(str(target), "/raw/", RUN_ID)


# ----------------------------------------------------------------------- load

def test_guardrail(spark):
    expected = spark.createDataFrame(
        [("customers", 1, 1), ("disputes", 4, 1)],
        "dataset string, expected_rows bigint, expected_files bigint")
    facts = spark.createDataFrame(
        [("customers", 999, 1, 0, 0, 0), ("disputes", 4, 1, 0, 0, 0)],
        "dataset string, row_count bigint, file_count bigint, wrong_run_rows bigint, "
        "missing_source_files bigint, missing_row_numbers bigint")
    assert texts(guardrail_problems(facts, expected)) == ["customers expected 1 rows, found 999"]
    broken = facts.withColumn("wrong_run_rows", F.lit(2)).withColumn("missing_source_files", F.lit(3))
    assert len(texts(guardrail_problems(broken, expected))) == 5


def test_load_promotes_all_tables_or_none(spark, run_dir, tmp_path):
    target, warehouse = str(tmp_path / "bucket"), str(tmp_path / "warehouse")
    publish_run(spark, str(run_dir), target, RUN_ID, execute=True)
    assert read_raw(spark, warehouse)["customers"].count() == 0
    assert load_run(spark, str(run_dir), f"{target}/raw", RUN_ID, warehouse, execute=False) is None
    raw = load_run(spark, str(run_dir), f"{target}/raw", RUN_ID, warehouse)
    assert {n: df.count() for n, df in raw.items()} == {n: 4 for n in DATASETS}
    row = raw["disputes"].first()
    assert row["source_file"].startswith(f"run_id={RUN_ID}/disputes/year=2026/month=03/")
    assert row["pipeline_run_id"] == RUN_ID

    published = next((tmp_path / "bucket").rglob("customers/year=*/month=*/*.json"))
    published.write_text(published.read_text() + json.dumps(customer(99)) + "\n")
    with pytest.raises(ValueError, match="expected 4 rows, found 5"):
        load_run(spark, str(run_dir), f"{target}/raw", RUN_ID, warehouse)
    published.write_text("{broken\n")
    with pytest.raises(PySparkException, match="not valid JSON"):
        load_run(spark, str(run_dir), f"{target}/raw", RUN_ID, warehouse)
    assert {n: df.count() for n, df in read_raw(spark, warehouse).items()} == {n: 4 for n in DATASETS}


def test_only_the_runs_folder_is_landed(spark, tmp_path):
    for run, n in ((RUN_ID, 1), ("20260101T000000Z_00000000", 2)):
        folder = tmp_path / f"run_id={run}" / "customers" / "year=2026" / "month=01"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(json.dumps(customer(n)) + "\n")
        (folder / "notes.txt").write_text("no json")
    rows = land_dataset(spark, str(tmp_path), RUN_ID, "customers", "2026-01-01").collect()
    assert [(r["source_row_number"], r["source_file"]) for r in rows] == [
        (1, f"run_id={RUN_ID}/customers/year=2026/month=01/a.json")]


def test_older_raw_tables_get_lineage_columns(spark):
    older = spark.sql("select parse_json('{}') as raw_record")
    row = with_lineage_columns(older).first()
    assert row["pipeline_run_id"] is None and row["source_row_number"] is None


# ---------------------------------------------------------------------- batch

def test_batch_from_snapshot_to_marts(spark, tmp_path):
    root = str(tmp_path)
    record = run_batch(spark, root, RUN_ID, as_lines(spark, clean_run()), publish_to=f"{root}/out",
                       execute_publish=True, reload_raw=True, execute_reload=True, run_models=True)
    assert record["status"] == "SUCCESS" and len(record["steps"]) == 6
    summary = record["validation_summary"]
    assert (summary["rows_received"], summary["rows_valid"]) == (20, 20)
    mart = read_mart(spark, f"{root}/warehouse", "gold_fraud_summary_by_network").first()
    assert (mart["total_transactions"], mart["high_risk_transactions"]) == (4, 4)


def test_failing_stage_stops_the_batch_and_is_audited(spark, tmp_path):
    batches = clean_run() | {"customers": [customer(1, state="x"), customer(2)]}
    with pytest.raises(RuntimeError, match="Contract validation failed: customers"):
        run_batch(spark, str(tmp_path), RUN_ID, as_lines(spark, batches))
    audit = json.loads((tmp_path / "pipeline_audit_logs" / f"pipeline_run_{RUN_ID}.json").read_text())
    assert audit["status"] == "FAILED" and "customers" in audit["failure_reason"]
    assert [s["status"] for s in audit["steps"]] == ["SUCCESS", "FAILED"]
    assert audit["validation_summary"]["rows_rejected"] == 1
    assert not (tmp_path / "partitioned").exists()
    with pytest.raises(ValueError, match="run ID must match"):
        run_batch(spark, str(tmp_path), "not-a-run")


def test_all_problems_are_listed(spark, run_dir, tmp_path):
    from paylens.sinks.snapshots import require_no_problems

    many = spark.range(40).selectExpr("concat('file', id) as file_name", "'size differs' as problem")
    with pytest.raises(ValueError, match="40 problems, listed in") as raised:
        require_no_problems(many, "check", str(tmp_path))
    path = str(raised.value).split("listed in ")[1].split(",")[0]
    assert spark.read.json(path).count() == 40
    require_no_problems(many.limit(0), "check", str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_what_a_dead_copy_leaves_is_not_published(spark, run_dir, tmp_path):
    target = tmp_path / "bucket"
    drafts = target / "raw" / "_drafts" / f"run_id={RUN_ID}"
    drafts.mkdir(parents=True)
    (drafts / "0123").write_text("half a file")
    assert publish_run(spark, str(run_dir), str(target), RUN_ID, execute=True) == "UPLOADED"
    assert not drafts.exists()


def test_one_of_two_snapshot_writers_wins(spark, tmp_path):
    from paylens.workspace import Storage

    storage = Storage(spark)
    for name in ("a", "b"):
        (tmp_path / name / "sub").mkdir(parents=True)
    target = str(tmp_path / "t")
    assert storage.rename(str(tmp_path / "a"), target) is True
    assert storage.rename(str(tmp_path / "b"), target) is False
    assert not (tmp_path / "t" / "b").exists() and (tmp_path / "b").exists()


def test_only_the_live_and_the_last_version_stay(spark, tmp_path):
    from paylens.sinks.promotion import promote, write_raw_version

    raw = {n: with_lineage_columns(spark.sql("select parse_json('{}') as raw_record")) for n in DATASETS}
    versions = []
    for _ in range(3):
        versions.append(write_raw_version(spark, str(tmp_path), "v", raw))
        promote(spark, str(tmp_path), versions[-1])
    assert {p.name for p in (tmp_path / "raw" / "versions").iterdir()} == set(versions[1:])


def test_records_are_counted_as_spark_reads_them(tmp_path, spark):
    from paylens.sources.files import RecordCounter, count_records

    texts = [b"", b"\n", b"a", b"a\n\n b \r\n \t\nc\rd", b"\n\n x", "é\n\u00a0\n".encode()]
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.json").write_bytes(text)
    want = {r.path.rsplit("/", 1)[1]: r.record_count for r in count_records(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        for size in (1, 3, 100):
            counter = RecordCounter()
            for at in range(0, len(text), size):
                counter.update(text[at:at + size])
            assert counter.count == want.get(f"f{i}.json", 0), (text, size)


def test_batch_leaves_no_scratch(spark, tmp_path):
    from pathlib import Path
    from paylens.workspace import scratch_dir

    top = Path(scratch_dir(spark, "x").removeprefix("file:")).parent
    before = set(top.iterdir()) if top.exists() else set()
    run_batch(spark, str(tmp_path), RUN_ID, as_lines(spark, clean_run()))
    assert set(top.iterdir()) == before


def test_wider_ids_need_the_wider_contract(spark, parsed):
    from paylens.contracts import widened

    rows = [chargeback(12345678, 23456789)]
    narrow = validate_lines(parsed(rows), DATASETS["chargeback_outcomes"], None)
    assert {r.rule for r in narrow.failures.collect()} == {"pattern"}
    wide = validate_lines(parsed(rows), widened(DATASETS["chargeback_outcomes"]), None)
    assert wide.failures.count() == 0 and wide.valid_rows.count() == 1
    short = validate_lines(parsed([chargeback(1, 1, chargeback_id="CBK_1")]), widened(DATASETS["chargeback_outcomes"]), None)
    assert {r.rule for r in short.failures.collect()} == {"pattern"}
