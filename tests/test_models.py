from decimal import Decimal

from pyspark.sql import functions as F

from paylens.operators import data_tests
from paylens.plans.bronze import bronze
from paylens.plans.gold import gold_models
from paylens.plans.monitoring import executive_summary, pipeline_row_counts
from paylens.plans.silver import silver_models

RUNS = ("run_a", "run_b")
LINEAGE = "pipeline_run_id string, source_file string, source_row_number bigint, loaded_at timestamp_ntz"


def raw(spark, records):
    rows = [(line, run, "f.json", i) for i, (run, line) in enumerate(records, 1)]
    df = spark.createDataFrame(rows, "line string, pipeline_run_id string, source_file string, "
                                     "source_row_number bigint")
    return df.select(F.parse_json("line").alias("raw_record"), "pipeline_run_id", "source_file",
                     "source_row_number", F.lit("2026-01-01").cast("timestamp_ntz").alias("loaded_at"))


def model_inputs(spark):
    both = [(r, l) for r in RUNS for l in ['{"customer_id":"C1","account_id":"A1","customer_age":45.6}']]
    return {
        "customers": raw(spark, both),
        "transactions": raw(spark, [
            ("run_a", '{"transaction_id":"T1","customer_id":"C1","account_id":"A1","transaction_amount":1.005,'
                      '"transaction_timestamp":"2026-01-01 23:59:59","card_network":"Visa"}'),
            ("run_a", '{"transaction_id":"T2","customer_id":"C1","account_id":"A2","transaction_amount":"2",'
                      '"transaction_timestamp":"2026-01-02","card_network":"Visa"}'),
            ("run_b", '{"transaction_id":"T1","customer_id":"C1","account_id":"A1","transaction_amount":3,'
                      '"transaction_timestamp":"2026-01-01 00:00:00","card_network":"Pulse"}')]),
        "fraud_signals": raw(spark, [
            ("run_a", '{"transaction_id":"T1","fraud_score":0.35,"risk_level":"Low"}'),
            ("run_b", '{"transaction_id":"T1","fraud_score":0.1,"risk_level":"High"}')]),
        "disputes": raw(spark, [
            ("run_a", '{"dispute_id":"D1","transaction_id":"T1","dispute_amount":5,'
                      '"opened_date":"2026-01-01 23:59:59","card_network":"Visa"}'),
            ("run_a", '{"dispute_id":"D2","transaction_id":"T9","dispute_amount":7,'
                      '"opened_date":"2026-01-03","card_network":"Pulse"}')]),
        "chargeback_outcomes": raw(spark, [
            ("run_a", '{"chargeback_id":"B1","dispute_id":"D1","outcome":"WON","final_amount":4,'
                      '"resolved_date":"2026-01-02 00:00:01"}'),
            ("run_a", '{"chargeback_id":"B2","dispute_id":"D1","outcome":"lost","final_amount":0,'
                      '"resolved_date":"2026-01-05"}')]),
    }


def build(spark):
    base = model_inputs(spark)
    br = {n: bronze(df, n) for n, df in base.items()}
    silver = silver_models(br, "2026-01-01")
    return base, br, silver, gold_models(silver, br, "2026-01-01")


def test_bronze_casts(spark):
    _, br, _, _ = build(spark)
    assert br["customers"].first()["customer_age"] == 46
    amounts = [r[0] for r in br["transactions"].orderBy("source_row_number")
               .select("transaction_amount").collect()]
    assert amounts == [Decimal("1.01"), Decimal("2.00"), Decimal("3.00")]
    assert br["fraud_signals"].first()["velocity_count"] is None


def test_joins_stay_inside_a_run_and_need_both_keys(spark):
    _, _, silver, _ = build(spark)
    rows = {(r["pipeline_run_id"], r["transaction_id"]): r
            for r in silver["silver_transactions_enriched"].collect()}
    assert len(rows) == 3
    assert rows["run_a", "T1"]["high_risk_transaction_flag"] is True
    assert rows["run_a", "T2"]["high_risk_transaction_flag"] is False
    assert rows["run_a", "T2"]["customer_source_file"] is None
    assert rows["run_b", "T1"]["high_risk_transaction_flag"] is True


def test_dispute_keeps_all_chargebacks_and_unmatched_rows(spark):
    _, _, silver, _ = build(spark)
    rows = silver["silver_dispute_outcomes"].orderBy("dispute_id", "chargeback_id").collect()
    assert [(r["dispute_id"], r["chargeback_id"], r["days_to_resolution"]) for r in rows] == [
        ("D1", "B1", 1), ("D1", "B2", 4), ("D2", None, None)]
    assert rows[2]["transaction_source_file"] is None


def test_marts(spark):
    base, br, silver, gold = build(spark)
    by_network = {r["card_network"]: r
                  for r in gold["gold_dispute_chargeback_summary_by_network"].collect()}
    visa, pulse = by_network["Visa"], by_network["Pulse"]
    assert (visa["total_chargebacks"], visa["chargebacks_won"], visa["chargebacks_lost"]) == (2, 1, 1)
    assert float(visa["chargeback_win_rate_pct"]) == 50.0
    assert pulse["chargeback_win_rate_pct"] is None and pulse["chargebacks_won"] == 0
    summary = executive_summary(
        gold["gold_fraud_summary_by_network"], gold["gold_dispute_chargeback_summary_by_network"])
    assert tuple(summary.first()) == (3, 2, 3, 2)
    counts = {r["object_name"]: r["row_count"] for r in
              pipeline_row_counts(base, silver, gold, "2026-01-01").collect()}
    assert len(counts) == 11 and counts["SILVER_DISPUTE_OUTCOMES"] == 3
    assert counts["GOLD_DAILY_FRAUD_KPIS"] == 3


def test_data_tests_find_violations(spark):
    _, br, silver, gold = build(spark)
    models = {f"br_{n}": df for n, df in br.items()} | silver | gold
    results = {(r["test"], r["model"], r["column"]): r["failures"]
               for r in data_tests.all_results(models).collect()}
    assert results["unique", "br_customers", "customer_id"] == 1
    assert results["relationships", "br_disputes", "transaction_id"] == 1
    assert results["not_null", "br_transactions", "card_network"] == 0
    assert results["silver_lineage", "silver", ""] == 1
    assert sum(1 for k in results if k[0] == "not_null") == 16
