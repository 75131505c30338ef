"""Model tests as queries that return the violating rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.contracts import CARD_NETWORKS
from paylens.operators.uniqueness import key_counts

# Fixed values: (model, column) pairs under test.
NOT_NULL = (
    ("br_customers", "customer_id"), ("br_customers", "account_id"),
    ("br_transactions", "transaction_id"), ("br_transactions", "customer_id"),
    ("br_transactions", "transaction_amount"), ("br_transactions", "card_network"),
    ("br_fraud_signals", "transaction_id"), ("br_fraud_signals", "fraud_score"),
    ("br_disputes", "dispute_id"), ("br_disputes", "transaction_id"),
    ("br_chargeback_outcomes", "chargeback_id"), ("br_chargeback_outcomes", "dispute_id"),
    ("silver_transactions_enriched", "transaction_id"),
    ("silver_transactions_enriched", "customer_id"),
    ("silver_dispute_outcomes", "dispute_id"), ("silver_dispute_outcomes", "transaction_id"),
)
UNIQUE = (
    ("br_customers", "customer_id"), ("br_transactions", "transaction_id"),
    ("br_fraud_signals", "transaction_id"), ("br_disputes", "dispute_id"),
    ("br_chargeback_outcomes", "chargeback_id"),
    ("silver_transactions_enriched", "transaction_id"),
    ("silver_dispute_outcomes", "dispute_id"),
)
ACCEPTED = (("br_transactions", "card_network", CARD_NETWORKS),)
RELATIONSHIPS = (
    ("br_disputes", "transaction_id", "br_transactions", "transaction_id"),
    ("br_chargeback_outcomes", "dispute_id", "br_disputes", "dispute_id"),
)
BRONZE_KEYS = {
    "br_customers": "customer_id", "br_transactions": "transaction_id",
    "br_fraud_signals": "transaction_id", "br_disputes": "dispute_id",
    "br_chargeback_outcomes": "chargeback_id",
}
BRONZE_LINEAGE = ("pipeline_run_id", "source_file", "source_row_number", "loaded_at")
SILVER_LINEAGE = {
    "silver_transactions_enriched": (
        "transaction_id",
        ("pipeline_run_id", "transaction_source_file", "transaction_source_row_number")),
    "silver_dispute_outcomes": (
        "dispute_id",
        ("pipeline_run_id", "dispute_source_file", "dispute_source_row_number",
         "transaction_source_file", "transaction_source_row_number")),
}
GOLD_MARTS = (
    "gold_daily_fraud_kpis", "gold_daily_dispute_kpis", "gold_fraud_summary_by_network",
    "gold_dispute_chargeback_summary_by_network", "gold_pipeline_batch_metadata")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return key_counts(df, column).filter("copies > 1").select(
        F.col(column).alias("unique_field"), F.col("copies").alias("n_records"))


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values without a parent row; null values are not tested."""
    keys = parent.select(F.col(field).alias("_parent"))
    return (
        child.filter(F.col(column).isNotNull())
        .join(keys, F.col(column) == F.col("_parent"), "left_anti")
        .select(F.col(column).alias("from_field")))


def any_null(df: DataFrame, columns) -> DataFrame:
    """Rows in which at least one of the columns is null."""
    condition = F.lit(False)
    for column in columns:
        condition = condition | F.col(column).isNull()
    return df.filter(condition)


def lineage_gaps(df: DataFrame, model: str, key: str, columns) -> DataFrame:
    return any_null(df, columns).select(
        F.lit(model).alias("model_name"), F.col(key).alias("record_id"))


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def bronze_lineage(models: dict[str, DataFrame]) -> DataFrame:
    return _union([lineage_gaps(models[m], m, key, BRONZE_LINEAGE)
                   for m, key in BRONZE_KEYS.items()])


def silver_lineage(models: dict[str, DataFrame]) -> DataFrame:
    return _union([lineage_gaps(models[m], m, key, columns)
                   for m, (key, columns) in SILVER_LINEAGE.items()])


def gold_lineage(models: dict[str, DataFrame]) -> DataFrame:
    return _union([not_null(models[m], "pipeline_run_id").select(F.lit(m).alias("model_name"))
                   for m in GOLD_MARTS])


def _result(kind: str, model: str, column: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count("*").alias("failures")).select(
        F.lit(kind).alias("test"), F.lit(model).alias("model"), F.lit(column).alias("column"),
        "failures")


def not_null_results(models: dict[str, DataFrame]) -> DataFrame:
    """Null counts of all tested columns, one pass per model."""
    frames = []
    for model in dict.fromkeys(m for m, _ in NOT_NULL):
        columns = [c for m, c in NOT_NULL if m == model]
        counted = models[model].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        frames.append(counted.unpivot([], columns, "column", "failures").select(
            F.lit("not_null").alias("test"), F.lit(model).alias("model"), "column", "failures"))
    return _union(frames)


def unique_results(models: dict[str, DataFrame]) -> DataFrame:
    return _union([_result("unique", m, c, unique(models[m], c)) for m, c in UNIQUE])


def accepted_results(models: dict[str, DataFrame]) -> DataFrame:
    return _union([_result("accepted_values", m, c, accepted_values(models[m], c, values))
                   for m, c, values in ACCEPTED])


def relationship_results(models: dict[str, DataFrame]) -> DataFrame:
    return _union([_result("relationships", m, c, relationships(models[m], c, models[p], f))
                   for m, c, p, f in RELATIONSHIPS])


def all_results(models: dict[str, DataFrame]) -> DataFrame:
    """Every model test with its number of violating rows."""
    return _union([
        not_null_results(models), unique_results(models),
        accepted_results(models), relationship_results(models),
        _result("bronze_lineage", "bronze", "", bronze_lineage(models)),
        _result("silver_lineage", "silver", "", silver_lineage(models)),
        _result("gold_lineage", "gold", "", gold_lineage(models)),
    ])
