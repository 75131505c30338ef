"""Queries over the models: bronze, silver, gold, monitoring, dashboard, data tests.

``QUERIES`` run on Spark, ``ORACLES`` are the same results as DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.contracts import CARD_NETWORKS, DATASETS
from paylens.functions.calendar import iso_text, month_text, partition_time, year_text
from paylens.functions.identifiers import is_run_id, relative_key
from paylens.operators import data_tests
from paylens.operators.uniqueness import key_counts
from paylens.plans import gold, monitoring
from paylens.plans.bronze import bronze
from paylens.plans.silver import (
    dispute_outcomes, high_risk, silver_models, transactions_enriched)
from paylens.sinks.materialise import store
from paylens.sources.landing import with_lineage_columns
from paylens.workload.tables import (
    RUN_A, TYPED, for_duckdb, landed, run_sql, typed, typed_models)
from paylens.workspace import Storage, scratch_dir, together

AS_OF = "2026-03-01 00:00:00"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function
    return register


def comparable(df: DataFrame) -> DataFrame:
    """Plain types for comparison across engines; load and model stamps left out."""
    columns = []
    for f in df.schema:
        kind = f.dataType.typeName()
        if f.name in ("modeled_at", "checked_at"):
            continue
        column = F.col(f.name)
        if kind == "decimal":
            column = column.cast("double")
        if kind in ("timestamp", "timestamp_ntz", "date"):
            column = column.cast("string")
        if f.name.startswith("avg_"):
            column = F.round(column.cast("double"), 6)
        columns.append(column.alias(f.name))
    return df.select(*columns)


# ---------------------------------------------------------------- oracle text

LINEAGE = "pipeline_run_id, source_file, source_row_number, cast(loaded_at as varchar) as loaded_at"

BRONZE_CTES = ",\n".join(f"br_{n} as ({for_duckdb(TYPED[n])})" for n in DATASETS)

_PLACE = ("source_file", "source_row_number", "loaded_at")


def _placed(prefix: str) -> str:
    """A bronze row's lineage under the name it has in silver."""
    return ", ".join(f"{c} as {prefix}_{c}" for c in _PLACE)


def _places(*prefixes: str) -> str:
    return ", ".join(f"{p}_{c}" for p in prefixes for c in _PLACE)


_DROPPED = f"exclude ({', '.join(_PLACE)})"

SILVER_CTES = BRONZE_CTES + f""",
silver_transactions_enriched as (
  with payment as (select * {_DROPPED}, {_placed('transaction')} from br_transactions),
  owner as (select pipeline_run_id, customer_id, account_id, customer_age, account_status, state,
    {_placed('customer')} from br_customers),
  signal as (select * exclude (score_timestamp, {', '.join(_PLACE)}), {_placed('fraud_signal')}
    from br_fraud_signals)
  select *, coalesce(risk_level = 'High', false) or coalesce(fraud_score >= 0.35, false)
    as high_risk_transaction_flag
  from payment left join owner using (pipeline_run_id, customer_id, account_id)
  left join signal using (pipeline_run_id, transaction_id)),
silver_dispute_outcomes as (
  with claim as (select * {_DROPPED}, {_placed('dispute')} from br_disputes),
  payment as (select pipeline_run_id, transaction_id, customer_id, account_id, transaction_amount,
    fraud_score, risk_level, high_risk_transaction_flag,
    {_places('transaction', 'customer', 'fraud_signal')} from silver_transactions_enriched),
  ruling as (select * rename (outcome as chargeback_outcome) from (
    select * {_DROPPED}, {_placed('chargeback')} from br_chargeback_outcomes))
  select *, datediff('day', opened_date, resolved_date) as days_to_resolution
  from claim left join payment using (pipeline_run_id, transaction_id)
  left join ruling using (pipeline_run_id, dispute_id))"""

DISPUTE_MEASURES = """count(*) as total_disputes,
    cast(sum(dispute_amount) as double) as total_dispute_amount,
    round(cast(sum(dispute_amount) as double) / count(*), 6) as avg_dispute_amount,
    count(chargeback_id) as total_chargebacks,
    cast(count(*) filter (where upper(chargeback_outcome) = 'WON') as bigint) as chargebacks_won,
    cast(count(*) filter (where upper(chargeback_outcome) = 'LOST') as bigint) as chargebacks_lost,
    cast(count(*) filter (where upper(chargeback_outcome) = 'PENDING') as bigint) as chargebacks_pending,
    round(avg(days_to_resolution), 6) as avg_days_to_resolution"""
FRAUD_MEASURES = """count(*) as total_transactions,
    cast(sum(transaction_amount) as double) as total_transaction_amount,
    round(cast(sum(transaction_amount) as double) / count(*), 6) as avg_transaction_amount,
    round(avg(fraud_score), 6) as avg_fraud_score,
    cast(count(*) filter (where high_risk_transaction_flag) as bigint) as high_risk_transactions,
    count(distinct customer_id) as unique_customers"""


def _metadata(label: str, prefix: str, upper: bool) -> str:
    return "\n  union all ".join(
        f"""select '{prefix}{n.upper() if upper else n}' as {label}, pipeline_run_id,
    count(*) as row_count, count(distinct source_file) as source_file_count,
    cast(min(loaded_at) as varchar) as first_loaded_at,
    cast(max(loaded_at) as varchar) as last_loaded_at
  from br_{n} group by pipeline_run_id""" for n in DATASETS)


_COUNTED = (
    [("RAW", f"raw_{n}", f"br_{n}") for n in DATASETS]
    + [("SILVER", n, n) for n in ("silver_transactions_enriched", "silver_dispute_outcomes")]
    + [("GOLD", n, n) for n in monitoring.COUNTED_MARTS])
_COUNTS = " union all ".join(
    f"select '{layer}' as layer, '{name.upper()}' as object_name, count(*) as row_count from {table}"
    for layer, name, table in _COUNTED)

GOLD_CTES = SILVER_CTES + f""",
gold_daily_fraud_kpis as (
  select pipeline_run_id, cast(cast(transaction_timestamp as date) as varchar) as transaction_date,
    card_network, {FRAUD_MEASURES}
  from silver_transactions_enriched group by 1, 2, 3),
gold_daily_dispute_kpis as (
  select pipeline_run_id, cast(cast(opened_date as date) as varchar) as dispute_opened_date,
    card_network, {DISPUTE_MEASURES}
  from silver_dispute_outcomes group by 1, 2, 3),
gold_fraud_summary_by_network as (
  select pipeline_run_id, card_network, {FRAUD_MEASURES},
    cast(round(100.0 * count(*) filter (where high_risk_transaction_flag) / nullif(count(*), 0), 2) as double)
      as high_risk_rate_pct
  from silver_transactions_enriched group by 1, 2),
gold_dispute_chargeback_summary_by_network as (
  select pipeline_run_id, card_network, {DISPUTE_MEASURES},
    count(distinct customer_id) as unique_customers,
    cast(round(100.0 * count(*) filter (where upper(chargeback_outcome) = 'WON')
      / nullif(count(chargeback_id), 0), 2) as double) as chargeback_win_rate_pct,
    cast(sum(final_amount) as double) as total_final_chargeback_amount
  from silver_dispute_outcomes group by 1, 2),
gold_pipeline_batch_metadata as (
  {_metadata('dataset_name', '', False)}),
monitoring_pipeline_row_counts as (
  {_COUNTS})"""

TIMES = {"transaction_timestamp", "created_at", "score_timestamp", "opened_date", "resolved_date",
         "loaded_at", "transaction_loaded_at", "customer_loaded_at", "fraud_signal_loaded_at",
         "dispute_loaded_at", "chargeback_loaded_at"}
MONEY = {"transaction_amount", "dispute_amount", "final_amount"}


def plain(table: str, available: str) -> str:
    """select * with times as text and money as double."""
    changed = [f"cast({c} as varchar) as {c}" for c in sorted(TIMES) if c in available.split()]
    changed += [f"cast({c} as double) as {c}" for c in sorted(MONEY) if c in available.split()]
    return f"select * replace ({', '.join(changed)}) from {table}"


def with_models(sql: str) -> str:
    return f"with {GOLD_CTES}\n{sql}"


# --------------------------------------------------------------------- bronze

BRONZE_COLUMNS = {n: " ".join([*DATASETS[n].field_names, "loaded_at"]) for n in DATASETS}

for _name in DATASETS:
    def _bronze(spark: SparkSession, sf_dir: str, name: str = _name) -> DataFrame:
        return comparable(bronze(landed(spark, sf_dir, name), name))

    query(f"bronze_{_name}", f"with br as ({for_duckdb(TYPED[_name])}) "
          + plain("br", BRONZE_COLUMNS[_name]))(_bronze)


# --------------------------------------------------------------------- silver

def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_enriched(
        *[typed(spark, sf_dir, n) for n in ("transactions", "customers", "fraud_signals")], AS_OF)


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispute_outcomes(typed(spark, sf_dir, "disputes"), _enriched(spark, sf_dir),
                            typed(spark, sf_dir, "chargeback_outcomes"), AS_OF)


# Each mart builds only what it reads.
MARTS: dict[str, Query] = {
    "gold_daily_fraud_kpis": lambda s, d: gold.daily_fraud_kpis(_enriched(s, d), AS_OF),
    "gold_daily_dispute_kpis": lambda s, d: gold.daily_dispute_kpis(_outcomes(s, d), AS_OF),
    "gold_fraud_summary_by_network":
        lambda s, d: gold.fraud_summary_by_network(_enriched(s, d), AS_OF),
    "gold_dispute_chargeback_summary_by_network":
        lambda s, d: gold.dispute_summary_by_network(_outcomes(s, d), AS_OF),
    "gold_pipeline_batch_metadata":
        lambda s, d: gold.pipeline_batch_metadata(typed_models(s, d), AS_OF),
}


_STORED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All models as written tables, built once per session; counts then read footers only."""
    key = (spark.sparkContext.applicationId, sf_dir)
    known = _STORED.get(key)
    if known is None or not Storage(spark).exists(known["br_customers"].inputFiles()[0]):
        root = scratch_dir(spark, "models")
        base = together({n: partial(store, df, root, "bronze", f"br_{n}")
                         for n, df in typed_models(spark, sf_dir).items()})
        silver = {"silver_transactions_enriched": store(transactions_enriched(
            base["transactions"], base["customers"], base["fraud_signals"], AS_OF),
            root, "silver", "silver_transactions_enriched")}
        silver["silver_dispute_outcomes"] = store(dispute_outcomes(
            base["disputes"], silver["silver_transactions_enriched"], base["chargeback_outcomes"], AS_OF),
            root, "silver", "silver_dispute_outcomes")
        marts = together({n: partial(store, df, root, "gold", n)
                          for n, df in gold.gold_models(silver, base, AS_OF).items()})
        known = _STORED[key] = {f"br_{n}": df for n, df in base.items()} | silver | marts
    return known


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = stored_models(spark, sf_dir)
    return monitoring.pipeline_row_counts(
        {n: models[f"br_{n}"] for n in DATASETS},
        {n: models[n] for n in ("silver_transactions_enriched", "silver_dispute_outcomes")}, models, AS_OF)


_T_COLUMNS = ("transaction_timestamp transaction_amount transaction_loaded_at customer_loaded_at "
              "fraud_signal_loaded_at")
_D_COLUMNS = ("opened_date resolved_date transaction_amount dispute_amount final_amount "
              "dispute_loaded_at transaction_loaded_at customer_loaded_at fraud_signal_loaded_at "
              "chargeback_loaded_at")


@query("silver_transactions_enriched",
       with_models(plain("silver_transactions_enriched", _T_COLUMNS)))
def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_enriched(spark, sf_dir))


@query("silver_dispute_outcomes", with_models(plain("silver_dispute_outcomes", _D_COLUMNS)))
def silver_disputes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_outcomes(spark, sf_dir))


@query("high_risk_flag", with_models(
    "select transaction_id, risk_level, fraud_score, high_risk_transaction_flag "
    "from silver_transactions_enriched"))
def high_risk_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = typed(spark, sf_dir, "fraud_signals").select(
        "transaction_id", "pipeline_run_id", "risk_level", "fraud_score")
    rows = typed(spark, sf_dir, "transactions").select("transaction_id", "pipeline_run_id").join(
        signals, ["transaction_id", "pipeline_run_id"], "left")
    return rows.select(
        "transaction_id", "risk_level", "fraud_score",
        high_risk(F.col("risk_level"), F.col("fraud_score")).alias("high_risk_transaction_flag"))


@query("lineage_rename", with_models("""
select dispute_id, dispute_source_file, dispute_source_row_number, transaction_source_file,
  transaction_source_row_number, customer_source_file, customer_source_row_number,
  fraud_signal_source_file, fraud_signal_source_row_number, chargeback_source_file,
  chargeback_source_row_number from silver_dispute_outcomes"""))
def lineage_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = _outcomes(spark, sf_dir)
    return outcomes.select("dispute_id", *[
        f"{s}_{c}" for s in ("dispute", "transaction", "customer", "fraud_signal", "chargeback")
        for c in ("source_file", "source_row_number")])


@query("modeled_at", with_models(
    f"select '{AS_OF}' as modeled_at, count(*) as row_count from gold_daily_fraud_kpis"))
def modeled_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = MARTS["gold_daily_fraud_kpis"](spark, sf_dir)
    return mart.groupBy(F.col("modeled_at").cast("string").alias("modeled_at")).agg(
        F.count("*").alias("row_count"))


# ----------------------------------------------------------------------- gold

for _name in MARTS:
    def _mart(spark: SparkSession, sf_dir: str, name: str = _name) -> DataFrame:
        return comparable(MARTS[name](spark, sf_dir))

    query(_name, with_models(f"select * from {_name}"))(_mart)


@query("monitoring_pipeline_row_counts", with_models("select * from monitoring_pipeline_row_counts"))
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_counts(spark, sf_dir))


_RAW_COUNTS = f"with {BRONZE_CTES} {_metadata('table_name', 'RAW_', True)}"


@query("validate_raw_counts", _RAW_COUNTS)
def validate_raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.raw_counts({n: landed(spark, sf_dir, n) for n in DATASETS}))


@query("order_raw_counts", f"select * from ({_RAW_COUNTS}) order by table_name, pipeline_run_id")
def order_raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.raw_counts(typed_models(spark, sf_dir)))


@query("union_all", with_models(
    "select dataset_name, sum(row_count)::bigint as row_count from gold_pipeline_batch_metadata group by 1"))
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [df.select(F.lit(n).alias("dataset_name")) for n, df in typed_models(spark, sf_dir).items()]
    return gold.union_all(parts).groupBy("dataset_name").agg(F.count("*").alias("row_count"))


@query("dup_count", """
select l_orderkey * 10 + l_linenumber as number, count(*) as copies from lineitem group by 1""")
def dup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = run_sql(spark, sf_dir, "select l_orderkey * 10 + l_linenumber as number from {lineitem}")
    return key_counts(lines, "number")


# ------------------------------------------------------------------ dashboard

@query("dash_exec_summary", with_models("""
select (select sum(total_transactions)::bigint from gold_fraud_summary_by_network) as total_transactions,
  (select sum(high_risk_transactions)::bigint from gold_fraud_summary_by_network) as high_risk_transactions,
  (select sum(total_disputes)::bigint from gold_dispute_chargeback_summary_by_network) as total_disputes,
  (select sum(total_chargebacks)::bigint from gold_dispute_chargeback_summary_by_network) as total_chargebacks"""))
def dash_exec_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.executive_summary(
        MARTS["gold_fraud_summary_by_network"](spark, sf_dir),
        MARTS["gold_dispute_chargeback_summary_by_network"](spark, sf_dir))


@query("dash_high_risk_rate", with_models(
    "select card_network, high_risk_rate_pct from gold_fraud_summary_by_network"))
def dash_high_risk_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.high_risk_rate(MARTS["gold_fraud_summary_by_network"](spark, sf_dir))


@query("dash_disputes_vs_chargebacks", with_models(
    "select card_network, total_disputes, total_chargebacks "
    "from gold_dispute_chargeback_summary_by_network"))
def dash_disputes_vs_chargebacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.disputes_vs_chargebacks(
        MARTS["gold_dispute_chargeback_summary_by_network"](spark, sf_dir))


@query("dash_rows_by_layer", with_models(
    "select layer, sum(row_count)::bigint as row_count from monitoring_pipeline_row_counts group by 1"))
def dash_rows_by_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.rows_by_layer(_counts(spark, sf_dir))


@query("order_marts", with_models(
    "select * from gold_daily_dispute_kpis order by pipeline_run_id, dispute_opened_date"))
def order_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(monitoring.in_dashboard_order(monitoring.displayable(
        MARTS["gold_daily_dispute_kpis"](spark, sf_dir))))


# ----------------------------------------------------------------- data tests

def _test_sql(kind: str, cases: list[tuple[str, str, str]]) -> str:
    return with_models("\nunion all ".join(
        f"select '{kind}' as test, '{model}' as model, '{column}' as \"column\", "
        f"count(*) as failures from ({failing}) x" for model, column, failing in cases))


@query("test_not_null", _test_sql("not_null", [
    (m, c, f"select 1 from {m} where {c} is null") for m, c in data_tests.NOT_NULL]))
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_tests.not_null_results(stored_models(spark, sf_dir))


@query("test_unique", _test_sql("unique", [
    (m, c, f"select {c} from {m} where {c} is not null group by 1 having count(*) > 1")
    for m, c in data_tests.UNIQUE]))
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_tests.unique_results(stored_models(spark, sf_dir))


@query("test_accepted_values", """
select o_orderpriority as value_field, count(*) as n_records from orders
where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by 1""")
def test_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    priorities = run_sql(spark, sf_dir, "select o_orderpriority from {orders}")
    return data_tests.accepted_values(priorities, "o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM"))


@query("test_accepted_networks", _test_sql("accepted_values", [
    ("br_transactions", "card_network",
     f"select card_network from br_transactions where card_network not in {CARD_NETWORKS} group by 1")]))
def test_accepted_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_tests.accepted_results(stored_models(spark, sf_dir))


@query("test_relationships", _test_sql("relationships", [
    (m, c, f"select {c} from {m} where {c} is not null and {c} not in (select {f} from {p})")
    for m, c, p, f in data_tests.RELATIONSHIPS]))
def test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_tests.relationship_results(stored_models(spark, sf_dir))


@query("relationship_test", with_models("""
select transaction_id as from_field from br_transactions
where transaction_id not in (select transaction_id from br_fraud_signals)"""))
def relationship_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = typed_models(spark, sf_dir)
    return data_tests.relationships(
        models["transactions"], "transaction_id", models["fraud_signals"], "transaction_id")


# Rows whose lineage is taken away before the lineage tests run.
DAMAGED = "{row} % 7 = 3"


def _without_lineage(models: dict[str, DataFrame], column_of: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """Models with (row, column): the column is null where the row number says so."""
    return models | {m: models[m].withColumn(column, F.when(
        ~F.coalesce(F.expr(DAMAGED.format(row=row)), F.lit(False)), F.col(column)))
        for m, (row, column) in column_of.items()}


def _lineage_sql(model: str, key: str, columns, row: str) -> str:
    gaps = " or ".join(f"{c} is null" for c in columns)
    damaged = DAMAGED.format(row=row)
    return f"select '{model}' as model_name, {key} as record_id from {model} where {gaps} or {damaged}"


@query("test_bronze_lineage", with_models("\nunion all ".join(
    _lineage_sql(m, k, data_tests.BRONZE_LINEAGE, "source_row_number")
    for m, k in data_tests.BRONZE_KEYS.items())))
def test_bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = dict(zip(data_tests.BRONZE_KEYS, [
        ("source_row_number", c) for c in ("source_file", "pipeline_run_id", "loaded_at", "source_file", "loaded_at")]))
    return data_tests.bronze_lineage(_without_lineage(stored_models(spark, sf_dir), changed))


@query("test_silver_lineage", with_models("\nunion all ".join(
    _lineage_sql(m, k, c, "transaction_source_row_number") for m, (k, c) in data_tests.SILVER_LINEAGE.items())))
def test_silver_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_tests.silver_lineage(_without_lineage(stored_models(spark, sf_dir), {
        "silver_transactions_enriched": ("transaction_source_row_number", "transaction_source_file"),
        "silver_dispute_outcomes": ("transaction_source_row_number", "transaction_source_file")}))


_GOLD_ROWS = dict(zip(data_tests.GOLD_MARTS, (
    "total_transactions", "total_disputes", "total_transactions", "total_disputes", "row_count")))


@query("test_gold_lineage", with_models("\nunion all ".join(
    f"select '{m}' as model_name from {m} where {DAMAGED.format(row=_GOLD_ROWS[m])}"
    for m in data_tests.GOLD_MARTS)))
def test_gold_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_tests.gold_lineage(_without_lineage(
        stored_models(spark, sf_dir), {m: (row, "pipeline_run_id") for m, row in _GOLD_ROWS.items()}))


@query("lineage_null_filter", with_models("""
select 'silver_transactions_enriched' as model_name, transaction_id as record_id
from silver_transactions_enriched
where customer_source_file is null or fraud_signal_source_file is null"""))
def lineage_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_tests.lineage_gaps(
        _enriched(spark, sf_dir), "silver_transactions_enriched",
        "transaction_id", ("customer_source_file", "fraud_signal_source_file"))


# ---------------------------------------------------------- scalar functions

@query("variant_casts", f"""
with br as ({for_duckdb(TYPED["fraud_signals"])})
select transaction_id, cast(round(fraud_score, 1) as double) as score_1,
  cast(round(cast(fraud_score * 100 as decimal(12,2)), 0) as bigint) as score_pct,
  risk_level = 'High' as is_high from br""")
def variant_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = typed(spark, sf_dir, "fraud_signals").select(F.parse_json(F.to_json(F.struct(
        "transaction_id", "fraud_score",
        (F.col("fraud_score") * 100).cast("decimal(12,2)").alias("pct"),
        (F.col("risk_level") == "High").alias("high")))).alias("v"))
    return signals.select(
        F.variant_get("v", "$.transaction_id", "string").alias("transaction_id"),
        F.round(F.variant_get("v", "$.fraud_score", "double"), 1).alias("score_1"),
        F.variant_get("v", "$.pct", "decimal(38,0)").cast("bigint").alias("score_pct"),
        F.variant_get("v", "$.high", "boolean").alias("is_high"))


@query("datediff_days", with_models("""
select dispute_id, days_to_resolution from silver_dispute_outcomes where chargeback_id is not null"""))
def datediff_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = _outcomes(spark, sf_dir)
    return outcomes.filter(F.col("chargeback_id").isNotNull()).select("dispute_id", "days_to_resolution")


@query("iso_partition_date", """
select o_orderkey, cast(year(o_orderdate) as varchar) as year,
  lpad(cast(month(o_orderdate) as varchar), 2, '0') as month from orders""")
def iso_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_sql(spark, sf_dir, """
        select o_orderkey, case o_orderstatus
          when 'F' then date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'")
          when 'O' then date_format(o_orderdate, 'yyyy-MM-dd')
          else date_format(o_orderdate, 'yyyy-M-d H:m:s') end as written from {orders}""")
    plain = rows.withColumn("plain", iso_text(F.col("written")))
    timed = plain.withColumn("time", partition_time(F.col("plain")))
    return timed.select("o_orderkey", year_text(F.col("time")).alias("year"),
                        month_text(F.col("time")).alias("month"))


@query("path_normalise", """
select o_orderkey, 'raw/' || o_orderstatus || '/' || cast(o_orderkey as varchar) || '.json' as key
from orders""")
def path_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_sql(spark, sf_dir, """
        select o_orderkey, concat('\\\\raw\\\\', o_orderstatus, '/', o_orderkey, '.json') as path
        from {orders}""")
    return rows.select("o_orderkey", relative_key(F.col("path")).alias("key"))


@query("sha256_hex", """
select o_orderkey, sha256(cast(o_orderkey as varchar) || '|' || o_orderpriority) as digest from orders""")
def sha256_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, """
        select o_orderkey, sha2(concat(o_orderkey, '|', o_orderpriority), 256) as digest
        from {orders}""")


@query("decimal_to_float", """
select o_orderkey, cast(cast(o_totalprice as decimal(12,2)) as double) as amount from orders""")
def decimal_to_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.displayable(run_sql(
        spark, sf_dir, "select o_orderkey, cast(o_totalprice as decimal(12,2)) as amount from {orders}"))


@query("run_id_valid", f"""
select o_orderkey, regexp_matches(run_id, '^[0-9]{{8}}T[0-9]{{6}}Z_[0-9a-f]{{8}}$') as valid from (
  select o_orderkey, case o_orderstatus when 'F' then '{RUN_A}' when 'O' then
    '20260101T000000Z_' || lpad(cast(o_orderkey as varchar), 8, '0')
    else '2026-01-01_' || cast(o_orderkey as varchar) end || case o_orderkey % 5 when 0 then chr(13) when 1 then chr(10)
    when 2 then chr(133) else '' end as run_id from orders)""")
def run_id_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_sql(spark, sf_dir, f"""
        select o_orderkey, case o_orderstatus when 'F' then '{RUN_A}' when 'O' then
          concat('20260101T000000Z_', lpad(cast(o_orderkey as string), 8, '0'))
          else concat('2026-01-01_', o_orderkey) end || case o_orderkey % 5 when 0 then chr(13) when 1 then chr(10)
          when 2 then chr(133) else '' end as run_id from {{orders}}""")
    return rows.select("o_orderkey", is_run_id(F.col("run_id")).alias("valid"))


@query("raw_schema_evolve", f"""
with br as ({for_duckdb(TYPED["transactions"])})
select transaction_id, cast(null as varchar) as pipeline_run_id, cast(null as varchar) as source_file,
  cast(null as bigint) as source_row_number, cast(loaded_at as varchar) as loaded_at from br""")
def raw_schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    older = landed(spark, sf_dir, "transactions").select("raw_record", "loaded_at")
    evolved = with_lineage_columns(older)
    return comparable(evolved.select(
        F.variant_get("raw_record", "$.transaction_id", "string").alias("transaction_id"),
        "pipeline_run_id", "source_file", "source_row_number", "loaded_at"))
