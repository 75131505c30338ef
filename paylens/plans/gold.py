"""Marts by run, day and network.  Every aggregate combines map-side first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.plans.silver import stamp


def rate_pct(part: Column, whole: Column) -> Column:
    """Percentage with two decimals; NULL when there is nothing to divide by."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)


def _fraud_measures() -> list[Column]:
    return [
        F.count("*").alias("total_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("transaction_amount").alias("total_transaction_amount"),
        F.avg("transaction_amount").alias("avg_transaction_amount"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        F.count_if("high_risk_transaction_flag").alias("high_risk_transactions"),
    ]


def _dispute_measures() -> list[Column]:
    result = F.upper("chargeback_outcome")
    return [
        F.count("*").alias("total_disputes"),
        F.sum("dispute_amount").alias("total_dispute_amount"),
        F.avg("dispute_amount").alias("avg_dispute_amount"),
        F.count("chargeback_id").alias("total_chargebacks"),
        F.count_if(result == "WON").alias("chargebacks_won"),
        F.count_if(result == "LOST").alias("chargebacks_lost"),
        F.count_if(result == "PENDING").alias("chargebacks_pending"),
        F.avg("days_to_resolution").alias("avg_days_to_resolution"),
    ]


def daily_fraud_kpis(enriched: DataFrame, as_of: str | None = None) -> DataFrame:
    day = F.to_date("transaction_timestamp").alias("transaction_date")
    grouped = enriched.groupBy("pipeline_run_id", day, "card_network").agg(*_fraud_measures())
    return grouped.select(
        "pipeline_run_id", "transaction_date", "card_network", "total_transactions",
        "total_transaction_amount", "avg_transaction_amount", "avg_fraud_score",
        "high_risk_transactions", "unique_customers", stamp(as_of).alias("modeled_at"))


def daily_dispute_kpis(outcomes: DataFrame, as_of: str | None = None) -> DataFrame:
    day = F.to_date("opened_date").alias("dispute_opened_date")
    return (
        outcomes.groupBy("pipeline_run_id", day, "card_network")
        .agg(*_dispute_measures())
        .withColumn("modeled_at", stamp(as_of)))


def fraud_summary_by_network(enriched: DataFrame, as_of: str | None = None) -> DataFrame:
    return (
        enriched.groupBy("pipeline_run_id", "card_network")
        .agg(*_fraud_measures())
        .withColumn("high_risk_rate_pct",
                    rate_pct(F.col("high_risk_transactions"), F.col("total_transactions")))
        .withColumn("modeled_at", stamp(as_of)))


def dispute_summary_by_network(outcomes: DataFrame, as_of: str | None = None) -> DataFrame:
    grouped = outcomes.groupBy("pipeline_run_id", "card_network").agg(
        *_dispute_measures(),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("final_amount").alias("total_final_chargeback_amount"))
    return grouped.select(
        "pipeline_run_id", "card_network", "total_disputes", "unique_customers",
        "total_dispute_amount", "avg_dispute_amount", "total_chargebacks", "chargebacks_won",
        "chargebacks_lost", "chargebacks_pending",
        rate_pct(F.col("chargebacks_won"), F.col("total_chargebacks"))
        .alias("chargeback_win_rate_pct"),
        "total_final_chargeback_amount", "avg_days_to_resolution",
        stamp(as_of).alias("modeled_at"))


def load_metadata(landed: DataFrame, label: str, name: str) -> DataFrame:
    """Rows, files and load times per run of one landed table."""
    return landed.groupBy("pipeline_run_id").agg(
        F.count("*").alias("row_count"),
        F.count_distinct("source_file").alias("source_file_count"),
        F.min("loaded_at").alias("first_loaded_at"),
        F.max("loaded_at").alias("last_loaded_at"),
    ).select(F.lit(name).alias(label), "*")


def union_all(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def pipeline_batch_metadata(bronze: dict[str, DataFrame], as_of: str | None = None) -> DataFrame:
    rows = union_all([load_metadata(df, "dataset_name", n) for n, df in bronze.items()])
    return rows.select(
        "pipeline_run_id", "dataset_name", "row_count", "source_file_count",
        "first_loaded_at", "last_loaded_at", stamp(as_of).alias("modeled_at"))


def raw_counts(raw: dict[str, DataFrame]) -> DataFrame:
    """The load check: metadata of every RAW table, ordered by table and run."""
    rows = union_all([load_metadata(df, "table_name", f"RAW_{n.upper()}") for n, df in raw.items()])
    return rows.orderBy("table_name", "pipeline_run_id")


def gold_models(silver: dict[str, DataFrame], bronze: dict[str, DataFrame],
                as_of: str | None = None) -> dict[str, DataFrame]:
    enriched = silver["silver_transactions_enriched"]
    outcomes = silver["silver_dispute_outcomes"]
    return {
        "gold_daily_fraud_kpis": daily_fraud_kpis(enriched, as_of),
        "gold_daily_dispute_kpis": daily_dispute_kpis(outcomes, as_of),
        "gold_fraud_summary_by_network": fraud_summary_by_network(enriched, as_of),
        "gold_dispute_chargeback_summary_by_network": dispute_summary_by_network(outcomes, as_of),
        "gold_pipeline_batch_metadata": pipeline_batch_metadata(bronze, as_of),
    }
