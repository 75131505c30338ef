"""Row counts per pipeline object and the dashboard's queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.plans.gold import union_all
from paylens.plans.silver import stamp

# The marts that are counted (batch metadata is not).
COUNTED_MARTS = (
    "gold_fraud_summary_by_network", "gold_dispute_chargeback_summary_by_network",
    "gold_daily_fraud_kpis", "gold_daily_dispute_kpis")


def row_count(df: DataFrame, layer: str, name: str, as_of: str | None = None) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(layer).alias("layer"), F.lit(name).alias("object_name"), "row_count",
        stamp(as_of).alias("checked_at"))


def pipeline_row_counts(raw: dict[str, DataFrame], silver: dict[str, DataFrame],
                        gold: dict[str, DataFrame], as_of: str | None = None) -> DataFrame:
    """Eleven counts; over stored Parquet tables each reads footers only."""
    counts = [row_count(df, "RAW", f"RAW_{n.upper()}", as_of) for n, df in raw.items()]
    counts += [row_count(df, "SILVER", n.upper(), as_of) for n, df in silver.items()]
    counts += [row_count(gold[n], "GOLD", n.upper(), as_of) for n in COUNTED_MARTS]
    return union_all(counts)


def in_dashboard_order(mart: DataFrame) -> DataFrame:
    """Network marts by network, every other mart by its first two columns."""
    by_network = mart.columns[:2] == ["pipeline_run_id", "card_network"]
    return mart.orderBy("card_network") if by_network else mart.orderBy(*mart.columns[:2])


def displayable(mart: DataFrame) -> DataFrame:
    """Decimals as doubles, the way charts take them."""
    return mart.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in mart.schema])


def executive_summary(fraud_summary: DataFrame, dispute_summary: DataFrame) -> DataFrame:
    """The four headline totals, one row, both marts folded by one aggregate."""
    totals = ["total_transactions", "high_risk_transactions", "total_disputes", "total_chargebacks"]
    both = fraud_summary.select(*totals[:2]).unionByName(
        dispute_summary.select(*totals[2:]), allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals])


def high_risk_rate(fraud_summary: DataFrame) -> DataFrame:
    return fraud_summary.select("card_network", F.col("high_risk_rate_pct").cast("double"))


def disputes_vs_chargebacks(dispute_summary: DataFrame) -> DataFrame:
    return dispute_summary.select("card_network", "total_disputes", "total_chargebacks")


def rows_by_layer(row_counts: DataFrame) -> DataFrame:
    return row_counts.groupBy("layer").agg(F.sum("row_count").alias("row_count"))
