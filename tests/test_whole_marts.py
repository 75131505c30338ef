"""All stored marts and all written records are compared, not one mart and first and last ids."""

import json
import os

import pytest
from conftest import dispute

import __spark_entry__ as entry_points
from paylens.workload import file_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


def test_every_stored_mart_has_its_queries():
    names = set(entry_points.queries())
    own = {"materialize": "gold_dispute_chargeback_summary_by_network", "mart_scan": "gold_daily_fraud_kpis",
           "order_marts": "gold_daily_dispute_kpis"}
    for kind, shown in own.items():
        marts = file_queries.MARTS if kind == "order_marts" else file_queries.STORED_MARTS
        assert {f"{kind}_{m}" for m in marts if m != shown} <= names


def test_digests_see_a_change_between_first_and_last_id(spark):
    def digest(records):
        rows = spark.createDataFrame([(json.dumps(r), "x/year=2026/month=03/f") for r in records],
                                     "line string, source_file string")
        return [tuple(r) for r in file_queries.digested(
            rows.selectExpr("parse_json(line) as raw_record", "source_file"), "raw", "disputes").collect()]

    records = [dispute(n) for n in range(1, 6)]
    changed = [r | {"dispute_status": "Resolved"} if i == 2 else r for i, r in enumerate(records)]
    assert digest(records) == digest(records[::-1]) and digest(records)[0][:5] == ("raw", "disputes", "2026", "03", 5)
    assert digest(changed)[0][:5] == digest(records)[0][:5] and digest(changed) != digest(records)
