"""Wide tables: one row per transaction, one row per dispute (and chargeback)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.contracts import HIGH_RISK_SCORE
from paylens.functions.calendar import days_crossed


def stamp(as_of: str | None) -> Column:
    """Model time; fix it with ``as_of`` for repeatable output."""
    return F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()


def high_risk(risk_level: Column, fraud_score: Column) -> Column:
    """High level or a score from the threshold up; false without a signal."""
    return F.when(risk_level == "High", True).when(
        fraud_score >= HIGH_RISK_SCORE, True).otherwise(False)


def lineage_of(alias: str, prefix: str) -> list[Column]:
    """Lineage columns of one joined source under that source's name."""
    return [F.col(f"{alias}.{c}").alias(f"{prefix}_{c}")
            for c in ("source_file", "source_row_number", "loaded_at")]


def _on(left: str, right: str, *keys: str) -> Column:
    condition = F.col(f"{left}.pipeline_run_id") == F.col(f"{right}.pipeline_run_id")
    for key in keys:
        condition = condition & (F.col(f"{left}.{key}") == F.col(f"{right}.{key}"))
    return condition


def transactions_enriched(transactions: DataFrame, customers: DataFrame,
                          fraud_signals: DataFrame, as_of: str | None = None) -> DataFrame:
    """Transactions with their customer and fraud signal of the same run.

    Transactions are the preserved side of both joins, so a customer holding a
    large share of them is split at run time; the small customer side becomes
    a broadcast only when its measured size allows it.
    """
    joined = (
        transactions.alias("t")
        .join(customers.alias("c"), _on("t", "c", "customer_id", "account_id"), "left")
        .join(fraud_signals.alias("f"), _on("t", "f", "transaction_id"), "left")
    )
    return joined.select(
        "t.pipeline_run_id", "t.transaction_id", "t.customer_id", "t.account_id",
        "c.customer_age", "c.account_status", "c.state",
        "t.merchant_id", "t.transaction_amount", "t.transaction_timestamp",
        "t.transaction_status", "t.card_network", "t.merchant_category", "t.country",
        "f.fraud_score", "f.risk_level", "f.rule_triggered", "f.device_risk_score",
        "f.velocity_count", "f.model_version",
        high_risk(F.col("f.risk_level"), F.col("f.fraud_score"))
        .alias("high_risk_transaction_flag"),
        *lineage_of("t", "transaction"),
        *lineage_of("c", "customer"),
        *lineage_of("f", "fraud_signal"),
        stamp(as_of).alias("modeled_at"),
    )


def _with_chargebacks(disputes: DataFrame, chargebacks: DataFrame) -> DataFrame:
    """disputes LEFT JOIN chargebacks, written as matched plus unmatched rows.

    Nothing bounds the chargebacks of one dispute.  Spark can split a hot key
    of the right side in an inner join but not in a left join.
    """
    keys = ["dispute_id", "pipeline_run_id"]
    outcome = chargebacks.select(
        *keys, "chargeback_id", F.col("outcome").alias("chargeback_outcome"),
        "win_loss_flag", "final_amount", "resolved_date", "representment_required",
        *[F.col(c).alias(f"chargeback_{c}")
          for c in ("source_file", "source_row_number", "loaded_at")])
    matched = disputes.join(outcome, keys)
    unmatched = disputes.join(outcome.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def dispute_outcomes(disputes: DataFrame, enriched: DataFrame, chargebacks: DataFrame,
                     as_of: str | None = None) -> DataFrame:
    """Disputes with their enriched transaction and chargebacks of the same run."""
    joined = _with_chargebacks(disputes, chargebacks).alias("d").join(
        enriched.alias("t"), _on("d", "t", "transaction_id"), "left")
    return joined.select(
        "d.pipeline_run_id", "d.dispute_id", "d.claim_id", "d.transaction_id",
        "t.customer_id", "t.account_id", "t.transaction_amount",
        "d.dispute_amount", "d.dispute_reason", "d.dispute_status", "d.opened_date",
        "d.card_network", "t.fraud_score", "t.risk_level", "t.high_risk_transaction_flag",
        "d.chargeback_id", "d.chargeback_outcome", "d.win_loss_flag", "d.final_amount",
        "d.resolved_date", "d.representment_required",
        days_crossed(F.col("d.opened_date"), F.col("d.resolved_date"))
        .alias("days_to_resolution"),
        *lineage_of("d", "dispute"),
        *[f"t.{source}_{c}" for source in ("transaction", "customer", "fraud_signal")
          for c in ("source_file", "source_row_number", "loaded_at")],
        *[f"d.chargeback_{c}" for c in ("source_file", "source_row_number", "loaded_at")],
        stamp(as_of).alias("modeled_at"),
    )


def silver_models(bronze: dict[str, DataFrame], as_of: str | None = None) -> dict[str, DataFrame]:
    enriched = transactions_enriched(
        bronze["transactions"], bronze["customers"], bronze["fraud_signals"], as_of)
    return {
        "silver_transactions_enriched": enriched,
        "silver_dispute_outcomes": dispute_outcomes(
            bronze["disputes"], enriched, bronze["chargeback_outcomes"], as_of),
    }
