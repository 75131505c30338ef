from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest

from conftest import RUN_ID, as_lines, clean_run
from paylens.contracts import DATASETS
from paylens.plans.batch import run_batch
from paylens.sinks import materialise
from paylens.sinks.generations import ConcurrentCommit, Generation, commit, live_generation, reading
from paylens.sinks.materialise import build_models, read_mart
from paylens.sinks.promotion import load_run, promote, read_raw, write_raw_version
from paylens.sources.landing import with_lineage_columns

MART = "gold_fraud_summary_by_network"


def raw_of(spark, n=1):
    rows = spark.range(n).selectExpr("parse_json('{}') as raw_record")
    return {name: with_lineage_columns(rows) for name in DATASETS}


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("batch"))
    run_batch(spark, root, RUN_ID, as_lines(spark, clean_run()), publish_to=f"{root}/out", execute_publish=True)
    return root


def load(spark, published, warehouse):
    return load_run(spark, f"{published}/partitioned/{RUN_ID}", f"{published}/out/raw", RUN_ID, warehouse)


def versions(tmp_path):
    return {p.name for p in (tmp_path / "raw" / "versions").iterdir()}


def test_a_commit_needs_the_live_generation(spark, tmp_path):
    home = str(tmp_path)
    assert live_generation(spark, home) == Generation()
    first = commit(spark, home, Generation(), raw="a")
    assert first == live_generation(spark, home) == Generation(1, "a", None)
    with pytest.raises(ConcurrentCommit):
        commit(spark, home, Generation(), raw="b")
    assert commit(spark, home, first, models="m") == live_generation(spark, home) == Generation(2, "a", "m")
    assert sorted(p.name for p in (tmp_path / "generations").iterdir() if not p.name.endswith(".crc")) == [
        "000000000001.json", "000000000002.json"]


def test_of_many_commits_at_once_one_wins(spark, tmp_path):
    start = Barrier(6)

    def work(i):
        start.wait()
        try:
            return commit(spark, str(tmp_path), Generation(), raw=f"v{i}").raw
        except ConcurrentCommit:
            return None

    with ThreadPoolExecutor(6) as pool:
        won = [r for r in pool.map(work, range(6)) if r]
    assert won == [live_generation(spark, str(tmp_path)).raw]


def test_of_two_loads_at_once_one_wins_and_the_other_leaves_nothing(spark, published, tmp_path, monkeypatch):
    from paylens.sinks import promotion

    start, check = Barrier(2), promotion.guardrail_problems

    def together(*args):
        start.wait(120)  # both have staged, neither has committed
        return check(*args)

    monkeypatch.setattr(promotion, "guardrail_problems", together)

    def work(_):
        try:
            return load(spark, published, str(tmp_path)) and "loaded"
        except ConcurrentCommit:
            return "refused"

    with ThreadPoolExecutor(2) as pool:
        assert sorted(pool.map(work, range(2))) == ["loaded", "refused"]
    assert versions(tmp_path) == {live_generation(spark, str(tmp_path)).raw}
    assert {n: df.count() for n, df in read_raw(spark, str(tmp_path)).items()} == {n: 4 for n in DATASETS}


def test_a_build_that_dies_leaves_the_old_marts(spark, published, tmp_path, monkeypatch):
    home = str(tmp_path)
    load(spark, published, home)
    build_models(spark, home, "2026-01-01 00:00:00")
    before = read_mart(spark, home, MART).collect()
    generation = live_generation(spark, home)
    assert read_mart(spark, home, "silver_transactions_enriched").count() == 4
    for broken in ("gold_models", "pipeline_row_counts"):
        def fail(*args):
            raise OSError("lost")
        with monkeypatch.context() as patched:
            patched.setattr(materialise, broken, fail)
            with pytest.raises(OSError):
                build_models(spark, home, "2026-02-02 00:00:00")
        assert live_generation(spark, home) == generation and read_mart(spark, home, MART).collect() == before
    assert [p.name for p in (tmp_path / "models").iterdir()] == [generation.models]


def test_a_load_during_a_build_refuses_the_build(spark, published, tmp_path, monkeypatch):
    home = str(tmp_path)
    load(spark, published, home)
    gold = materialise.gold_models

    def interrupted(*args):
        promote(spark, home, write_raw_version(spark, home, "late", raw_of(spark)))
        return gold(*args)

    monkeypatch.setattr(materialise, "gold_models", interrupted)
    with pytest.raises(ConcurrentCommit):
        build_models(spark, home)
    live = live_generation(spark, home)
    assert live.number == 2 and live.raw.startswith("late") and live.models is None
    with pytest.raises(FileNotFoundError):
        read_mart(spark, home, MART)


def test_a_lease_keeps_old_tables(spark, tmp_path):
    home, names = str(tmp_path), []

    def add():
        names.append(write_raw_version(spark, home, "v", raw_of(spark, len(names) + 1)))
        promote(spark, home, names[-1])

    add()
    with reading(spark, home) as held:
        for _ in range(3):
            add()
        assert versions(tmp_path) == {names[0], names[2], names[3]}
        assert read_raw(spark, home, held)["disputes"].count() == 1
    add()
    assert versions(tmp_path) == set(names[3:]) and not list((tmp_path / "leases").glob("[0-9]*"))
    (tmp_path / "leases" / "4-1000000000-old").write_text("")
    add()
    add()
    assert versions(tmp_path) == set(names[-2:])


def test_folders_that_are_being_staged_are_left_alone(spark, tmp_path):
    home = str(tmp_path)
    staged = write_raw_version(spark, home, "slow", raw_of(spark))
    for _ in range(4):
        promote(spark, home, write_raw_version(spark, home, "v", raw_of(spark)))
    assert staged in versions(tmp_path) and len(versions(tmp_path)) == 3
