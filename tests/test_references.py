import pytest
from conftest import chargeback, customer, dispute, failures_of, signal, transaction

from paylens.contracts import DATASETS
from paylens.plans.validation import validate_lines, validate_suite


def test_invalid_parent_cannot_satisfy_child(parsed):
    out = validate_suite({
        "customers": parsed([customer(1), customer(2, state="ny")]),
        "transactions": parsed([transaction(1, 1), transaction(2, 2)]),
    })
    assert failures_of(out["transactions"]) == [
        (2, "customer_id", "referential_integrity"),
        (2, "customer_id, account_id", "referential_integrity")]
    assert out["transactions"].report.first()["batch_status"] == "PASSED_WITH_QUARANTINE"


def test_other_customers_account_breaks_only_the_composite_rule(parsed):
    out = validate_suite({
        "customers": parsed([customer(1), customer(2)]),
        "transactions": parsed([transaction(1, 1, account_id="ACCT_000002")]),
    })
    rows = out["transactions"].failures.collect()
    assert [(r["field"], r["message"]) for r in rows] == [(
        "customer_id, account_id",
        "transactions.(customer_id, account_id) value ('CUST_000001', 'ACCT_000002') does not "
        "reference a valid customers.(customer_id, account_id) record.")]


def test_single_key_message(parsed):
    out = validate_suite({
        "customers": parsed([customer(1)]), "transactions": parsed([transaction(1, 1)]),
        "fraud_signals": parsed([signal(9)])})
    assert out["fraud_signals"].failures.first()["message"] == (
        "fraud_signals.(transaction_id) value ('TXN_00000009',) does not reference a valid "
        "transactions.(transaction_id) record.")


def test_null_and_absent_keys_are_left_to_the_schema(parsed):
    absent = {k: v for k, v in transaction(2).items() if k != "account_id"}
    out = validate_suite({
        "customers": parsed([customer(1)]),
        "transactions": parsed([transaction(1, customer_id=None), absent]),
    })
    assert [f for f in failures_of(out["transactions"]) if f[2] == "referential_integrity"] == []


def test_wrongly_typed_key_is_not_the_text_key(parsed):
    out = validate_suite({
        "customers": parsed([customer(1)]),
        "transactions": parsed([transaction(1, customer_id=1)]),
    })
    message = out["transactions"].failures.filter("field = 'customer_id' and rule_group = 2").first()
    assert "value (1,)" in message["message"]


def test_malformed_parent_quarantines_all_children(parsed):
    out = validate_suite({
        "customers": parsed([customer(1)]),
        "transactions": parsed([transaction(1), "{broken"]),
        "disputes": parsed([dispute(1, 1)]),
        "chargeback_outcomes": parsed([chargeback(1, 1)]),
    })
    assert out["transactions"].report.first()["batch_status"] == "FAILED"
    assert [out[n].report.first()["invalid_records"] for n in ("disputes", "chargeback_outcomes")] == [1, 1]


def test_failed_parent_still_lends_its_valid_rows(parsed):
    out = validate_suite({
        "customers": parsed([customer(1), customer(2, customer_age=5)]),
        "transactions": parsed([transaction(1, 1)]),
    })
    assert out["customers"].report.first()["batch_status"] == "FAILED"
    assert out["transactions"].report.first()["batch_status"] == "PASSED"


def test_unvalidated_parent_is_an_error(parsed):
    with pytest.raises(RuntimeError, match="has not been validated before child dataset"):
        validate_lines(parsed([signal(1)]), DATASETS["fraud_signals"], {})


def test_hot_parent_serves_a_third_of_the_children(parsed):
    out = validate_suite({
        "customers": parsed([customer(n) for n in range(1, 50)]),
        "transactions": parsed([transaction(n, 1 if n <= 300 else n % 60) for n in range(1, 901)]),
    })
    report = out["transactions"].report.first()
    unknown = sum(1 for n in range(301, 901) if not 1 <= n % 60 < 50)
    assert report["invalid_records"] == unknown
    assert report["valid_records"] == 900 - unknown
