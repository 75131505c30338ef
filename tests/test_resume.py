import json

import pytest

from conftest import RUN_ID, as_lines, clean_run, customer
from paylens.plans import batch
from paylens.sinks.generations import live_generation
from paylens.sinks.materialise import read_mart
from paylens.workspace import together, workers_for

STAGES = ["create_snapshot", "validate_and_store", "partition_run", "publish_run", "load_run", "build_models"]
MART = "gold_fraud_summary_by_network"


def run(spark, root, records=None, **changes):
    settings = dict(publish_to=f"{root}/out", execute_publish=True, reload_raw=True, execute_reload=True,
                    run_models=True, as_of="2026-01-01 00:00:00", resume=True) | changes
    return batch.run_batch(spark, str(root), RUN_ID, as_lines(spark, records or clean_run()), **settings)


def statuses(record):
    return [s["status"] for s in record["steps"]]


@pytest.mark.parametrize("killed", [1, 4])
def test_a_rerun_goes_on_after_the_last_proven_stage(spark, tmp_path, monkeypatch, killed):
    done = []

    def watch(name, work):
        def step(*args, **kw):
            found = work(*args, **kw)
            done.append(name)
            if died and name == STAGES[killed]:
                raise OSError("driver lost")  # the work is done, but nobody knows
            return found
        return step

    for name in STAGES:
        monkeypatch.setattr(batch, name, watch(name, getattr(batch, name)))
    died = True
    with pytest.raises(OSError):
        run(spark, tmp_path)
    audit = json.loads((tmp_path / "pipeline_audit_logs" / f"pipeline_run_{RUN_ID}.json").read_text())
    assert audit["status"] == "FAILED" and statuses(audit)[-1] == "FAILED" and done == STAGES[:killed + 1]
    died = False
    done.clear()
    record = run(spark, tmp_path)
    # The snapshot verifies itself and a publication what it has published; both are always asked.
    skipped = {n for n in STAGES[:killed] if n not in ("create_snapshot", "publish_run")}
    assert done == [n for n in STAGES if n not in skipped]
    assert statuses(record) == ["SKIPPED" if n in skipped else "SUCCESS" for n in STAGES]
    assert read_mart(spark, f"{tmp_path}/warehouse", MART).first()["total_transactions"] == 4
    done.clear()
    assert statuses(run(spark, tmp_path)) == ["SUCCESS", "SKIPPED", "SKIPPED", "SUCCESS", "SKIPPED", "SKIPPED"]
    assert done == ["create_snapshot", "publish_run"]


def test_changed_outputs_inputs_or_contracts_are_no_proof(spark, tmp_path):
    from paylens.contracts import DATASETS, widened

    def again(**changes):
        return statuses(run(spark, tmp_path, publish_to=None, reload_raw=False, run_models=False, **changes))

    assert again() == ["SUCCESS"] * 3 and again() == ["SUCCESS", "SKIPPED", "SKIPPED"]
    changed = next((tmp_path / "partitioned").rglob("customers/year=*/month=*/*.json"))
    changed.write_text(changed.read_text() + " ")
    assert again() == ["SUCCESS", "SKIPPED", "SUCCESS"]
    wider = {n: widened(d) for n, d in DATASETS.items()}
    assert again(contracts=wider)[1] == "SUCCESS"
    assert again(contracts=wider, resume=False) == ["SUCCESS"] * 3


def test_a_load_reads_an_earlier_publication(spark, tmp_path):
    with pytest.raises(ValueError, match="published_at"):
        run(spark, tmp_path, publish_to=None)
    run(spark, tmp_path, reload_raw=False, run_models=False)
    record = run(spark, tmp_path, publish_to=None, published_at=f"{tmp_path}/out")
    assert record["status"] == "SUCCESS" and record["config"]["published_at"] == f"{tmp_path}/out"
    assert read_mart(spark, f"{tmp_path}/warehouse", MART).first()["total_transactions"] == 4


def test_a_failed_validation_is_no_proof(spark, tmp_path):
    records = clean_run() | {"customers": [customer(1, state="x"), customer(2)]}
    for _ in range(2):
        with pytest.raises(RuntimeError, match="Contract validation failed"):
            run(spark, tmp_path, records)


def test_jobs_at_once_fit_the_drivers_heap(spark, monkeypatch):
    from paylens import workspace

    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    monkeypatch.setattr(workspace, "JOB_HEAP", heap // 3)
    assert [workers_for(n) for n in (1, 2, 9)] == [1, 2, 3]
    monkeypatch.setattr(workspace, "JOB_HEAP", heap * 2)
    assert workers_for(9) == 1
    assert together({n: (lambda n=n: n * 2) for n in "abc"}) == {"a": "aa", "b": "bb", "c": "cc"}
