"""Typed columns out of the RAW VARIANT, strict like a warehouse cast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINEAGE = ["pipeline_run_id", "source_file", "source_row_number", "loaded_at"]

# Target type of every bronze column, per dataset.
MONEY, WHOLE, TIME = "decimal(12,2)", "decimal(38,0)", "timestamp_ntz"
BRONZE_TYPES = {
    "customers": {
        "customer_id": "string", "account_id": "string", "customer_age": WHOLE,
        "account_status": "string", "state": "string", "created_at": TIME,
    },
    "transactions": {
        "transaction_id": "string", "customer_id": "string", "account_id": "string",
        "merchant_id": "string", "transaction_amount": MONEY, "transaction_timestamp": TIME,
        "transaction_status": "string", "card_network": "string",
        "merchant_category": "string", "country": "string",
    },
    "fraud_signals": {
        "transaction_id": "string", "fraud_score": "double", "risk_level": "string",
        "rule_triggered": "string", "device_risk_score": "double", "velocity_count": WHOLE,
        "model_version": "string", "score_timestamp": TIME,
    },
    "disputes": {
        "dispute_id": "string", "claim_id": "string", "transaction_id": "string",
        "dispute_reason": "string", "dispute_amount": MONEY, "dispute_status": "string",
        "opened_date": TIME, "card_network": "string",
    },
    "chargeback_outcomes": {
        "chargeback_id": "string", "dispute_id": "string", "outcome": "string",
        "win_loss_flag": "string", "final_amount": MONEY, "resolved_date": TIME,
        "representment_required": "boolean",
    },
}


def bronze(raw: DataFrame, dataset: str) -> DataFrame:
    """One row per landed record: the dataset's typed fields, then lineage.

    Whole numbers round half away from zero (45.6 gives 46) through decimal
    before they become bigint.
    """
    columns = []
    for name, target in BRONZE_TYPES[dataset].items():
        value = F.variant_get("raw_record", f"$.{name}", target)
        columns.append((value.cast("bigint") if target == WHOLE else value).alias(name))
    return raw.select(*columns, *LINEAGE)


def bronze_models(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: bronze(raw[name], name) for name in BRONZE_TYPES}
