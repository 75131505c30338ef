import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from paylens.contracts import DATASETS  # noqa: E402
from paylens.sources.jsonl import with_records  # noqa: E402
from paylens.workspace import local_session  # noqa: E402

RUN_ID = "20260730T040000Z_a1b2c3d4"


@pytest.fixture(scope="session")
def spark():
    session = local_session("paylens-tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def parsed(spark):
    """Parsed lines of an in-memory file; dicts become JSON, strings stay as they are."""
    def build(records, name="batch.json"):
        rows = [(name, i, r if isinstance(r, str) else json.dumps(r))
                for i, r in enumerate(records, 1)]
        return with_records(spark.createDataFrame(
            rows, "source_file string, line_number bigint, line string"))
    return build


def customer(n=1, **changes):
    return {"customer_id": f"CUST_{n:06d}", "account_id": f"ACCT_{n:06d}", "customer_age": 40,
            "account_status": "Active", "state": "NY", "created_at": "2026-01-01"} | changes


def transaction(n=1, c=1, **changes):
    return {"transaction_id": f"TXN_{n:08d}", "customer_id": f"CUST_{c:06d}",
            "account_id": f"ACCT_{c:06d}", "merchant_id": "MERCH_00001",
            "transaction_amount": 10.5, "transaction_timestamp": "2026-03-01 10:00:00",
            "transaction_status": "Approved", "card_network": "Visa",
            "merchant_category": "Online", "country": "US"} | changes


def signal(n=1, **changes):
    return {"transaction_id": f"TXN_{n:08d}", "fraud_score": 0.5, "risk_level": "Medium",
            "rule_triggered": "None", "device_risk_score": 0.1, "velocity_count": 2,
            "model_version": "v1.0", "score_timestamp": "2026-03-01 10:00:01"} | changes


def dispute(n=1, t=1, **changes):
    return {"dispute_id": f"DISP_{n:07d}", "claim_id": f"CLM_{n:07d}",
            "transaction_id": f"TXN_{t:08d}", "dispute_reason": "Fraud", "dispute_amount": 10,
            "dispute_status": "Opened", "opened_date": "2026-03-02", "card_network": "Visa"} | changes


def chargeback(n=1, d=1, **changes):
    return {"chargeback_id": f"CBK_{n:07d}", "dispute_id": f"DISP_{d:07d}", "outcome": "Won",
            "win_loss_flag": "Win", "final_amount": 10, "resolved_date": "2026-03-12",
            "representment_required": True} | changes


def clean_run(size=4):
    """One consistent batch of every dataset."""
    numbers = range(1, size + 1)
    return {
        "customers": [customer(n) for n in numbers],
        "transactions": [transaction(n, n) for n in numbers],
        "fraud_signals": [signal(n) for n in numbers],
        "disputes": [dispute(n, n) for n in numbers],
        "chargeback_outcomes": [chargeback(n, n) for n in numbers],
    }


def as_lines(spark, batches):
    return {n: spark.createDataFrame([(json.dumps(r),) for r in records], "line string").coalesce(1)
            for n, records in batches.items()}


def failures_of(outcome):
    rows = outcome.failures.orderBy("rule_group", "line_number", "seq").collect()
    return [(r["line_number"], r["field"], r["rule"]) for r in rows]


assert list(DATASETS) == list(clean_run())
