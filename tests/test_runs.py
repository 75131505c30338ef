"""The two runs' queries take every order and line item together."""

import os

import pytest

import __spark_entry__ as entry_points
from paylens.workload.tables import RUN_A, RUN_B, run_sql

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")

# What the datasets hold, from the tables themselves; customers come with either run.
WHOLE = {
    "customers": "select c_custkey from {customer} union all select c_custkey from {customer}",
    "transactions": "select o_orderkey from {orders}",
    "fraud_signals": "select distinct l_orderkey from {lineitem}",
    "disputes": "select distinct l_orderkey, l_linenumber from {lineitem} where l_returnflag = 'R'",
    "chargeback_outcomes": "select distinct l_orderkey, l_linenumber from {lineitem} "
                           "where l_returnflag = 'R' and l_linestatus = 'F'",
}


def of_both_runs(spark, name):
    queries = entry_points.queries()
    return [queries[n](spark, SF_DIR).collect() for n in (name, f"{name}_run_b")]


def test_snapshots_of_both_runs_hold_every_record(spark):
    held = dict.fromkeys(WHOLE, 0)
    for rows in of_both_runs(spark, "raw_snapshot_write"):
        for r in rows:
            held[r.dataset] += r.record_count
    assert held == {n: run_sql(spark, SF_DIR, sql).count() for n, sql in WHOLE.items()}


def test_whole_batches_of_both_runs_receive_every_record(spark):
    audits = [rows[0] for rows in of_both_runs(spark, "run_audit_append")]
    assert [(r.run_id, r.status) for r in audits] == [(RUN_A, "SUCCESS"), (RUN_B, "SUCCESS")]
    assert sum(r.rows_received for r in audits) == sum(
        run_sql(spark, SF_DIR, sql).count() for sql in WHOLE.values())
