import json

import pytest
from conftest import chargeback, customer, dispute, failures_of, signal, transaction
from pyspark.sql import functions as F

from paylens.contracts import DATASETS, with_ancestors
from paylens.plans.validation import in_report_order, validate_file, validate_lines

CASES = [
    ("customers", customer(customer_age=45.0), []),
    ("customers", customer(customer_age=45.5), [("customer_age", "type")]),
    ("customers", customer(customer_age=True), [("customer_age", "type")]),
    ("customers", customer(customer_age="45"), [("customer_age", "type")]),
    ("customers", customer(customer_age=None), [("customer_age", "type")]),
    ("customers", customer(customer_age=17), [("customer_age", "minimum")]),
    ("customers", customer(customer_age=120), []),
    ("customers", customer(customer_age=120.5), [("customer_age", "type"), ("customer_age", "maximum")]),
    ("customers", customer(account_status=None), [("account_status", "type"), ("account_status", "enum")]),
    ("customers", customer(account_status=7), [("account_status", "type"), ("account_status", "enum")]),
    ("customers", customer(customer_id=5), [("customer_id", "type")]),
    ("customers", customer(created_at="2026-1-01"), [("created_at", "pattern"), ("created_at", "format")]),
    ("customers", customer(created_at="2026-02-30"), [("created_at", "format")]),
    ("customers", customer(nick="x", alias="y"), [("record", "additionalProperties")]),
    # As many members as the contract has, and commas inside a value.
    ("customers", {k: v for k, v in customer(nick="a,b").items() if k != "state"},
     [("record", "additionalProperties"), ("record", "required")]),
    ("customers", customer(account_id="A,B"), [("account_id", "pattern")]),
    ("customers", {"customer_id": "CUST_000001"}, [("record", "required")] * 5),
    ("transactions", transaction(transaction_amount=0), [("transaction_amount", "exclusiveMinimum")]),
    ("transactions", transaction(transaction_amount=1e-9), []),
    ("transactions", transaction(transaction_timestamp="2026-02-30 12:30:45"),
     [("transaction_timestamp", "format")]),
    ("fraud_signals", signal(fraud_score=1, device_risk_score=0, velocity_count=0), []),
    ("fraud_signals", signal(fraud_score=1.01), [("fraud_score", "maximum")]),
    ("disputes", dispute(dispute_amount=-1), [("dispute_amount", "exclusiveMinimum")]),
    ("chargeback_outcomes", chargeback(representment_required="true"),
     [("representment_required", "type")]),
    ("chargeback_outcomes", chargeback(final_amount=0), []),
    ("chargeback_outcomes", chargeback(outcome={"a": 1}), [("outcome", "type"), ("outcome", "enum")]),
]


@pytest.mark.parametrize("dataset", list(DATASETS))
def test_rules_of_one_record(parsed, dataset):
    cases = [(r, e) for d, r, e in CASES if d == dataset]
    outcome = validate_lines(parsed([r for r, _ in cases]), DATASETS[dataset], None)
    expected = [(i, *e) for i, (_, broken) in enumerate(cases, 1) for e in broken]
    got = [f for f in failures_of(outcome) if f[2] not in ("unique", "late_arriving_event")]
    assert got == expected


def test_messages(parsed):
    outcome = validate_lines(parsed([
        customer(customer_age=150, state="ny", nick=1), customer(2, account_status=None),
        {k: v for k, v in customer(3).items() if k != "state"},
    ]), DATASETS["customers"], None)
    assert [r["message"] for r in in_report_order(outcome.failures).collect()] == [
        "Additional properties are not allowed ('nick' was unexpected)",
        "150 is greater than the maximum of 120", "'ny' does not match '^[A-Z]{2}$'",
        "None is not of type 'string'", "None is not one of ['Active', 'Closed', 'Suspended']",
        "'state' is a required property"]


def test_bad_file_blocks_the_batch(spark, tmp_path):
    path = tmp_path / "bad_transactions.json"
    path.write_text("\n".join(json.dumps(r) for r in (
        transaction(88888888, 500),
        transaction(99999999, 500, transaction_amount="one hundred", card_network="Discover"))))
    outcome = validate_file(spark, "transactions", str(path))
    assert failures_of(outcome) == [(2, "card_network", "enum"), (2, "transaction_amount", "type")]
    report = outcome.report.first()
    assert (report["batch_status"], report["pipeline_action"]) == ("FAILED", "BLOCK_S3_UPLOAD")
    assert (report["total_records"], report["valid_records"], report["invalid_records"]) == (2, 1, 1)
    assert report["error_count_by_severity"] == {"hard_fail": 2}


def test_malformed_file_reports_only_its_bad_lines(spark, tmp_path):
    path = tmp_path / "malformed.json"
    path.write_text('{"transaction_id": "TXN_VALID_JSON"}\n{"transaction_id": "TXN_BAD", "amount": \n')
    outcome = validate_file(spark, "transactions", str(path))
    row = outcome.failures.collect()
    assert [(r["line_number"], r["rule"], r["severity"], r["record_id"]) for r in row] == [
        (2, "valid_json_lines", "hard_fail", "UNKNOWN")]
    report = outcome.report.first()
    assert (report["batch_status"], report["total_records"], report["valid_records"]) == ("FAILED", 1, 0)
    assert outcome.valid_rows.count() == 0 and outcome.invalid_rows.count() == 0


def test_late_events_only_warn(parsed):
    outcome = validate_lines(parsed([
        transaction(1, transaction_timestamp="2026-12-31 00:00:00"),
        transaction(2, transaction_timestamp="2025-01-01 00:00:00"),
        transaction(3, transaction_timestamp="2025-12-31 00:00:00"),
        transaction(4, transaction_timestamp="2025-12-30 00:00:01")]), DATASETS["transactions"], None)
    assert failures_of(outcome) == [(2, "transaction_timestamp", "late_arriving_event")]
    assert outcome.failures.first()["message"] == (
        "Transaction timestamp is 729 days older than latest record in batch.")
    report = outcome.report.first()
    assert (report["batch_status"], report["pipeline_action"]) == (
        "PASSED_WITH_WARNINGS", "UPLOAD_ALL_RECORDS")
    assert outcome.valid_rows.count() == 4


def test_date_only_events_are_never_late(parsed):
    outcome = validate_lines(parsed([
        dispute(1, opened_date="2020-01-01"), dispute(2, opened_date="2026-01-01")]),
        DATASETS["disputes"], None)
    assert failures_of(outcome) == []
    assert outcome.report.first()["batch_status"] == "PASSED"


def test_every_copy_of_a_key_fails_and_null_keys_do_not(parsed):
    outcome = validate_lines(parsed([
        customer(1), customer(2), customer(1, customer_age=200), customer(customer_id=None),
        customer(customer_id=None), customer(customer_id=1), customer(customer_id=1.0),
        customer(customer_id="1")]), DATASETS["customers"], None)
    assert [f[0] for f in failures_of(outcome) if f[2] == "unique"] == [1, 3, 6, 7]
    assert [r[0] for r in outcome.valid_rows.select("record_id").collect()] == ["CUST_000002"]


def test_hot_key_is_whole(parsed):
    """A third of all rows share one key; every copy is reported, nothing is cut off."""
    rows = [customer(7) for _ in range(400)] + [customer(n) for n in range(100, 900)]
    outcome = validate_lines(parsed(rows), DATASETS["customers"], None)
    assert outcome.failures.filter(F.col("rule") == "unique").count() == 400
    assert outcome.valid_rows.count() == 800


def test_empty_batch_passes(spark, parsed):
    outcome = validate_lines(parsed([customer()]).filter("line_number > 1"), DATASETS["customers"], None)
    report = outcome.report.first()
    assert (report["batch_status"], report["total_records"]) == ("PASSED", 0)


def test_dependencies():
    assert list(DATASETS) == [
        "customers", "transactions", "fraud_signals", "disputes", "chargeback_outcomes"]
    assert with_ancestors("customers") == ("customers",)
    assert with_ancestors("chargeback_outcomes") == (
        "customers", "transactions", "disputes", "chargeback_outcomes")
    assert with_ancestors("fraud_signals") == ("customers", "transactions", "fraud_signals")
