"""What the queries leave on the disk: compressed records, brief shuffles, small scratch tables."""

import gzip
import json
import pathlib
import time

import pytest
from conftest import RUN_ID, as_lines, clean_run, customer

from paylens.contracts import DATASETS
from paylens.plans import batch
from paylens.plans.batch import run_batch
from paylens.plans.validation import validate_lines
from paylens.sinks.materialise import read_mart
from paylens.sinks.outcomes import write_outcome
from paylens.sinks.partitions import partition_problems, publish_problems
from paylens.sinks.snapshots import snapshot_problems
from paylens.sources import files
from paylens.sources.files import Inflater, RecordCounter
from paylens.workspace import brief_shuffles, settle


def records_of(folder):
    return [p for p in pathlib.Path(folder).rglob("part-*") if not p.name.startswith(".")]


def test_outcome_is_compressed_in_input_order(spark, parsed, tmp_path):
    ids = range(300, 0, -1)
    rows = [customer(n, **({} if n != 7 else {"customer_age": 12})) for n in ids]
    ok = validate_lines(parsed([r for r in rows if r["customer_age"] != 12]), DATASETS["customers"], None)
    report = write_outcome(spark, ok, RUN_ID, str(tmp_path), compressed=True)
    parts = sorted(records_of(report["validated_file"]))
    assert parts and all(p.name.endswith(".txt.gz") for p in parts)
    said = [json.loads(x) for p in parts for x in gzip.decompress(p.read_bytes()).decode().splitlines()]
    assert [r["customer_id"] for r in said] == [f"CUST_{n:06d}" for n in ids if n != 7]

    bad = validate_lines(parsed(rows), DATASETS["customers"], None)
    report = write_outcome(spark, bad, RUN_ID, str(tmp_path), compressed=True)
    assert [json.loads(r[0]) for r in spark.read.text(report["quarantine_file"]).collect()] == [
        customer(7, customer_age=12)]
    failed = spark.read.json(report["failed_rules_table"])
    assert [(r["record_id"], r["field"]) for r in failed.collect()] == [("CUST_000007", "customer_age")]
    # The failures' texts repeat: their table is compressed whatever the lines are.
    assert all(p.name.endswith(".json.gz") for p in records_of(report["failed_rules_table"]))


def test_shuffle_files_go_with_their_statement(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}

    rows, before = spark.range(20_000).repartition(3, "id"), shuffles()
    with brief_shuffles(spark):
        for i in range(2):
            rows.write.parquet(str(tmp_path / str(i)))
        until = time.time() + 20
        while shuffles() - before and time.time() < until:
            time.sleep(0.1)
        assert not shuffles() - before
        assert len(rows.collect()) == len(rows.collect()) == 20_000  # a frame can be used again
    assert spark.read.parquet(str(tmp_path / "1")).count() == 20_000


def test_scratch_tables_are_zstd(spark):
    table = settle(spark.range(5), "zstd")
    assert table.inputFiles() and all(f.endswith(".zstd.parquet") for f in table.inputFiles())


def test_inflater_yields_the_text_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(files, "CHUNK", 1000)
    text = b"".join(b'{"n": %d}\n' % n for n in range(5000)) + b"\n \nlast"
    for stored in (gzip.compress(text), gzip.compress(text[:70]) + gzip.compress(text[70:], 1), gzip.compress(b"")):
        for step in (1, 7, 4096, len(stored)):
            inflater, counter, pieces = Inflater(), RecordCounter(), []
            for at in range(0, len(stored), step):
                for piece in inflater.update(stored[at:at + step]):
                    pieces.append(piece)
                    counter.update(piece)
            assert b"".join(pieces) == gzip.decompress(stored) and max(map(len, pieces)) <= 1000
            assert counter.count == (5001 if len(stored) > 100 else 0)
    damaged = bytearray(gzip.compress(text))
    damaged[50:90] = b"x" * 40
    inflater = Inflater()
    assert len(b"".join(p for part in (damaged[:200], damaged[200:]) for p in inflater.update(bytes(part)))) < len(text)


@pytest.fixture(scope="module")
def compressed_run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("compressed")
    run_batch(spark, str(root), RUN_ID, as_lines(spark, clean_run()), publish_to=f"{root}/published",
              execute_publish=True, reload_raw=True, execute_reload=True, run_models=True,
              as_of="2026-05-01 00:00:00", compressed=True)
    return root


def test_compressed_run_holds_what_a_plain_one_holds(spark, compressed_run, tmp_path):
    run_batch(spark, str(tmp_path), RUN_ID, as_lines(spark, clean_run()), publish_to=f"{tmp_path}/published",
              execute_publish=True, reload_raw=True, execute_reload=True, run_models=True,
              as_of="2026-05-01 00:00:00")
    for folder in ("raw", "validated", "partitioned", "published"):
        written = {root: sorted(line for p in records_of(root / folder) for line in (
            gzip.decompress(p.read_bytes()) if p.suffix == ".gz" else p.read_bytes()).splitlines()
            if "_manifest_files" not in p.parts and "_checksums" not in p.parts)
            for root in (compressed_run, tmp_path)}
        assert written[tmp_path] and written[compressed_run] == written[tmp_path], folder
        assert all(p.suffix == ".gz" for p in records_of(compressed_run / folder)
                   if not {"_manifest_files", "_checksums"} & {*p.parts}), folder
    for mart in ("gold_fraud_summary_by_network", "gold_daily_dispute_kpis", "silver_dispute_outcomes"):
        # Which file a record is in, and where, is Spark's choice.
        rows = [sorted(str([r[c] for c in r.__fields__ if "source_" not in c]) for r in read_mart(
            spark, f"{root}/warehouse", mart).collect()) for root in (compressed_run, tmp_path)]
        assert rows[0] and rows[0] == rows[1], mart
    tables = [p for p in (compressed_run / "warehouse").rglob("*.parquet") if not p.name.startswith(".")]
    assert tables and all(p.name.endswith(".zstd.parquet") for p in tables)


def test_damage_to_compressed_files_is_seen(spark, compressed_run):
    raw, run_dir = compressed_run / "raw" / RUN_ID, compressed_run / "partitioned" / RUN_ID

    def problems(frame):
        return {r["problem"] for r in frame.collect()}

    assert not problems(snapshot_problems(spark, str(raw), RUN_ID, counts=True))
    assert not problems(partition_problems(spark, str(run_dir), RUN_ID))
    assert not problems(publish_problems(spark, str(run_dir), RUN_ID))
    part = next(p for p in records_of(raw / "customers.json") if p.stat().st_size > 30)
    stored = part.read_bytes()
    part.write_bytes(stored[:15] + bytes([stored[15] ^ 255]) + stored[16:])
    assert problems(snapshot_problems(spark, str(raw), RUN_ID)) == {"content differs"}
    part.write_bytes(stored)
    data = next(p for p in (run_dir / "raw" / "customers").rglob("*.json.gz") if not p.name.startswith("."))
    extra = data.parent / "extra.json.gz"
    extra.write_bytes(gzip.compress(b"{}\n"))
    assert problems(publish_problems(spark, str(run_dir), RUN_ID)) == {"file not listed"}
    extra.unlink()


def test_scratch_of_a_stage_is_gone_in_the_next(spark, tmp_path, monkeypatch):
    scratch, seen = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "paylens", []
    before, partition = {*scratch.iterdir()} if scratch.exists() else set(), batch.partition_run
    monkeypatch.setattr(batch, "partition_run", lambda *a, **k: (
        seen.append({*scratch.iterdir()} - before), partition(*a, **k))[1])
    run_batch(spark, str(tmp_path), RUN_ID, as_lines(spark, clean_run()))
    assert seen == [set()]
