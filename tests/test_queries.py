import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from paylens.workload import catalog
from paylens.workspace import RUNTIME_SETTINGS, scratch_dir

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("customer", "orders", "lineitem")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.collect(), df.columns) == normal(cursor.fetchall(), columns)


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_SETTINGS.items())


@pytest.mark.parametrize("name, keys", [
    ("order_marts", ("pipeline_run_id", "dispute_opened_date")),
    ("order_raw_counts", ("table_name", "pipeline_run_id"))])
def test_ordered_queries_come_in_order(spark, name, keys):
    rows = [tuple(r[k] for k in keys) for r in entry_points.queries()[name](spark, SF_DIR).collect()]
    assert len(rows) > 1 and rows == sorted(rows)


def test_counts_read_stored_tables(spark):
    from paylens.workload.model_queries import _counts

    plan = _counts(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("ReadSchema: struct<>") + plan.count("pushedAggregates") >= 11


@pytest.mark.parametrize("label, names", [
    ("outcomes", ("validated_write", "quarantine_write", "report_write", "validation_audit_append")),
    ("partitioned", ("partition_manifest_verify_run_b", "publish_manifest_verify_run_b"))])
def test_queries_of_one_session_store_their_files_once(spark, label, names):
    def stored():
        return set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/paylens/{label}-*"))

    entry_points.queries()[names[0]](spark, SF_DIR)
    before = stored()
    for name in names:
        entry_points.queries()[name](spark, SF_DIR)
    assert stored() == before != set()


def test_a_query_takes_a_run_only_as_far_as_it_reads(spark):
    """A run goes on from where an earlier query left it, and its log has one complete pass."""
    from paylens.workload import file_queries as files

    sf_dir = f"{SF_DIR}/../{os.path.basename(SF_DIR)}"  # another key than the queries above
    read = {}
    for upto, name in ((files.PARTITIONED, "partition_write"), (files.PUBLISHED, "raw_land"),
                       (files.MODELLED, "run_audit_append")):
        read[name] = entry_points.queries()[name](spark, sf_dir).collect()
        root = files.taken_run(spark, sf_dir, files.RUN_A, upto)
        assert os.path.exists(f"{root}/published") == (upto >= files.PUBLISHED)
        assert os.path.exists(f"{root}/warehouse/models") == (upto >= files.MODELLED)
    assert root == files.taken_run(spark, sf_dir, files.RUN_A, files.PARTITIONED)
    assert [r["steps"] for r in read["run_audit_append"]] == [6]
    written = {r["dataset"]: 0 for r in read["partition_write"]}
    for r in read["partition_write"]:
        written[r["dataset"]] += r["record_count"]
    for r in read["raw_land"]:
        written[r["dataset"]] -= r["row_count"]
    assert set(written.values()) == {0} and len(written) == 5
