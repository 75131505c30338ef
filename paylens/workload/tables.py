"""The five datasets derived from the driver's TPC-H-like tables.

Each text is portable SQL: Spark runs it over DataFrames, DuckDB over views of
the same names.  ``TYPED`` gives contract-conforming rows with lineage in two
runs; ``INTAKE`` gives JSON lines as delivered, with the defects (and the
repeated line items) that the source values lead to.

customers come from customer, transactions from orders, fraud signals from the
line items of an order, disputes from returned line items, chargebacks from
returned and finished ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.contracts import DATASETS, widened
from paylens.plans.bronze import BRONZE_TYPES, TIME

#: The tables' ids outgrow the digits of v1 at larger scales.
CONTRACTS = {name: widened(dataset) for name, dataset in DATASETS.items()}
RUN_A = "20260101T000000Z_0000000a"
RUN_B = "20260201T000000Z_0000000b"
LOADED = {RUN_A: "2026-01-02 03:04:05", RUN_B: "2026-02-03 04:05:06"}


def padded(number: str, width: int) -> str:
    """Zero-padded text that never cuts a longer number."""
    text = f"cast({number} as string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


def _run(key: str) -> str:
    return f"case when {key} % 2 = 0 then '{RUN_A}' else '{RUN_B}' end"


def _lineage(run: str, dataset: str, day: str, row: str) -> str:
    return f"""{run} as pipeline_run_id,
    'run_id=' || {run} || '/{dataset}/year=' || cast(year({day}) as string) || '/month='
      || lpad(cast(month({day}) as string), 2, '0') || '/{dataset}.json' as source_file,
    cast({row} as bigint) as source_row_number,
    case when {run} = '{RUN_A}' then cast('{LOADED[RUN_A]}' as timestamp)
         else cast('{LOADED[RUN_B]}' as timestamp) end as loaded_at"""


_CREATED = "cast('2020-01-01' as date) + cast(c_custkey % 1000 as int)"
_CUSTOMER = f"""
  'CUST_' || {padded('c_custkey', 6)} as customer_id,
  'ACCT_' || {padded('c_custkey', 6)} as account_id,
  cast(18 + c_nationkey * 4 as bigint) as customer_age,
  case c_mktsegment when 'HOUSEHOLD' then 'Closed' when 'MACHINERY' then 'Suspended'
       else 'Active' end as account_status,
  substr('ACFGHIKMNOPTVW', cast(c_nationkey % 14 + 1 as int), 1) || 'A' as state,
  cast({_CREATED} as timestamp) as created_at"""

_STATUS = "case o_orderstatus when 'F' then 'Approved' when 'O' then 'Declined' else 'Reversed' end"
_NETWORK = ("case o_orderpriority when '1-URGENT' then 'Visa' when '2-HIGH' then 'Mastercard' "
            "when '5-LOW' then 'Visa' else 'Pulse' end")
_CATEGORY = ("case o_orderpriority when '1-URGENT' then 'Travel' when '2-HIGH' then 'Online' "
             "when '3-MEDIUM' then 'Food' when '5-LOW' then 'Gas' else 'Retail' end")
_CLOCK = ("lpad(cast(o_orderkey % 24 as string), 2, '0') || ':' || "
          "lpad(cast(o_custkey % 60 as string), 2, '0') || ':30'")
_ORDER_DAY = "cast(cast(o_orderdate as date) as string)"

_SCORE = "min(l_quantity) / 50.0"
_RISK = (f"case when {_SCORE} >= 0.75 then 'High' when {_SCORE} >= 0.40 then 'Medium' "
         "else 'Low' end")
_TRIGGER = ("case when count(*) >= 7 then 'Velocity Check' when max(l_extendedprice) > 90000 "
            "then 'High Amount' when max(l_discount) > 0.09 then 'Amount Spike' else 'None' end")
_MODEL = "case max(l_linestatus) when 'O' then 'v1.1' else 'v1.0' end"

_LINE_NUMBER = "l_orderkey * 10 + l_linenumber"
_REASON = ("case l_linenumber when 1 then 'Fraud' when 2 then 'Duplicate Charge' "
           "when 3 then 'Incorrect Amount' else 'Product Not Received' end")
_LINE_NETWORK = "case l_linenumber % 3 when 0 then 'Visa' when 1 then 'Mastercard' else 'Pulse' end"

TYPED = {
    "customers": f"""
select {_CUSTOMER}, {_lineage(f"'{RUN_A}'", 'customers', _CREATED, 'c_custkey + 1')}
from {{customer}}
union all
select {_CUSTOMER}, {_lineage(f"'{RUN_B}'", 'customers', _CREATED, 'c_custkey + 1')}
from {{customer}}""",
    "transactions": f"""
select
  'TXN_' || {padded('o_orderkey', 8)} as transaction_id,
  'CUST_' || {padded('o_custkey', 6)} as customer_id,
  'ACCT_' || {padded('case when o_totalprice > 499000 then o_custkey + 1 else o_custkey end', 6)}
    as account_id,
  'MERCH_' || {padded('o_orderkey % 100000', 5)} as merchant_id,
  cast(o_totalprice as decimal(12,2)) as transaction_amount,
  cast({_ORDER_DAY} || ' ' || {_CLOCK} as timestamp) as transaction_timestamp,
  {_STATUS} as transaction_status, {_NETWORK} as card_network,
  {_CATEGORY} as merchant_category, 'US' as country,
  {_lineage(_run('o_orderkey'), 'transactions', 'o_orderdate', 'o_orderkey + 1')}
from {{orders}}""",
    "fraud_signals": f"""
select
  'TXN_' || {padded('l_orderkey', 8)} as transaction_id,
  {_SCORE} as fraud_score, {_RISK} as risk_level, {_TRIGGER} as rule_triggered,
  abs(max(l_tax)) * 10 as device_risk_score, cast(count(*) as bigint) as velocity_count,
  {_MODEL} as model_version, cast(min(l_shipdate) as timestamp) as score_timestamp,
  {_lineage(_run('l_orderkey'), 'fraud_signals', 'min(l_shipdate)', 'l_orderkey + 1')}
from {{lineitem}} group by l_orderkey""",
    "disputes": f"""
select
  'DISP_' || {padded(_LINE_NUMBER, 7)} as dispute_id,
  'CLM_' || {padded(_LINE_NUMBER, 7)} as claim_id,
  'TXN_' || {padded('l_orderkey', 8)} as transaction_id,
  {_REASON} as dispute_reason, cast(max(l_extendedprice) as decimal(12,2)) as dispute_amount,
  case max(l_linestatus) when 'F' then 'Resolved' else 'Under Review' end as dispute_status,
  cast(min(l_shipdate) as timestamp) as opened_date, {_LINE_NETWORK} as card_network,
  {_lineage(_run('l_orderkey'), 'disputes', 'min(l_shipdate)', _LINE_NUMBER)}
from {{lineitem}} where l_returnflag = 'R' group by l_orderkey, l_linenumber""",
    "chargeback_outcomes": f"""
select
  'CBK_' || {padded(_LINE_NUMBER, 7)} as chargeback_id,
  'DISP_' || {padded(_LINE_NUMBER, 7)} as dispute_id,
  case when max(l_discount) < 0.04 then 'Won' when max(l_discount) < 0.08 then 'Lost'
       else 'Pending' end as outcome,
  case when max(l_discount) < 0.04 then 'Win' when max(l_discount) < 0.08 then 'Loss'
       else 'Pending' end as win_loss_flag,
  cast(case when max(l_discount) < 0.04 then max(l_extendedprice) else 0 end as decimal(12,2))
    as final_amount,
  cast(cast(max(l_shipdate) as date) + cast(max(l_quantity) as int) as timestamp) as resolved_date,
  max(l_tax) >= 0.05 as representment_required,
  {_lineage(_run('l_orderkey'), 'chargeback_outcomes', 'max(l_shipdate)', _LINE_NUMBER)}
from {{lineitem}} where l_returnflag = 'R' and l_linestatus = 'F'
group by l_orderkey, l_linenumber""",
}


def _quoted(text: str) -> str:
    return f"""'"' || {text} || '"'"""


def _money(column: str) -> str:
    return f"cast(cast({column} as decimal(12,2)) as string)"


# JSON fragments per field; SQL NULL leaves the field out.
_INTAKE_FIELDS = {
    "customers": ("{customer}", {
        "customer_id": _quoted(f"'CUST_' || {padded('c_custkey', 6)}"),
        "account_id": _quoted(f"'ACCT_' || {padded('c_custkey', 6)}"),
        "customer_age": """case when c_acctbal < -900 then '150' when c_acctbal < -800 then '12'
          when c_acctbal < -700 then '"n/a"' when c_acctbal < -600 then 'null'
          when c_acctbal < -500 then null when c_acctbal < -400 then '45.5'
          when c_acctbal < -300 then '45.0' else cast(18 + c_nationkey * 4 as string) end""",
        "account_status": """case when c_acctbal between 0 and 100 then '"Dormant"'
          when c_acctbal between 100 and 150 then '7' when c_mktsegment = 'HOUSEHOLD'
          then '"Closed"' else '"Active"' end""",
        # A line end behind the state, as JSON writes it; only a line feed may stand there.
        "state": "case when c_acctbal between 200 and 300 then '\"ny\"' when c_acctbal between 300 and 900 then "
                 "'\"NY' || chr(92) || case c_nationkey % 4 when 0 then 'r' when 1 then 'u2028' when 2 then 'n' "
                 "else 'u0041' end || '\"' else '\"NY\"' end",
        "created_at": f"""case when c_acctbal between -300 and -200 then '"2026-02-30"'
          when c_acctbal between -200 and -100 then '"2026-1-01"'
          else {_quoted(f"cast({_CREATED} as string)")} end""",
        "nickname": "case when c_acctbal between -100 and -1 then '\"x\"' end",
    }),
    "transactions": ("{orders}", {
        "transaction_id": _quoted(f"'TXN_' || {padded('o_orderkey', 8)}"),
        "customer_id": "case when o_totalprice > 497000 then '\"CUST_999999\"' else "
                       + _quoted(f"'CUST_' || {padded('o_custkey', 6)}") + " end",
        "account_id": "case when o_totalprice between 490000 and 497000 then "
                      + _quoted(f"'ACCT_' || {padded('o_custkey + 1', 6)}") + " else "
                      + _quoted(f"'ACCT_' || {padded('o_custkey', 6)}") + " end",
        "merchant_id": "case when o_totalprice between 12000 and 13000 then '\"M1\"' else "
                       + _quoted(f"'MERCH_' || {padded('o_orderkey % 100000', 5)}") + " end",
        "transaction_amount": "case when o_totalprice < 3000 then '0' when o_totalprice < 5000 "
                              "then '\"one hundred\"' else " + _money("o_totalprice") + " end",
        "transaction_timestamp":
            "case when o_totalprice between 5000 and 7000 then "
            + _quoted(f"{_ORDER_DAY} || 'T' || {_CLOCK}")
            + " when o_totalprice between 7000 and 8000 then '\"1999-02-30 12:30:45\"'"
            " when o_totalprice between 8000 and 9000 then '\"1999-07-21 24:00:00\"' else "
            + _quoted(f"{_ORDER_DAY} || ' ' || {_CLOCK}") + " end",
        "transaction_status": _quoted(_STATUS),
        "card_network": "case when o_totalprice between 9000 and 10000 then '\"Discover\"' else "
                        + _quoted(_NETWORK) + " end",
        "merchant_category": _quoted(_CATEGORY),
        "country": "case when o_totalprice between 10000 and 11000 then 'null' "
                   "when o_totalprice between 11000 and 12000 then null else '\"US\"' end",
    }),
    "fraud_signals": ("{lineitem} group by l_orderkey", {
        "transaction_id": _quoted(f"'TXN_' || {padded('l_orderkey', 8)}"),
        "fraud_score": "case when count(*) = 1 and min(l_quantity) > 45 then '1.5' "
                       "when count(*) = 1 and min(l_quantity) < 5 then '-0.1' else "
                       "cast(cast(min(l_quantity) / 50.0 as decimal(4,2)) as string) end",
        "risk_level": _quoted(_RISK),
        "rule_triggered": _quoted(_TRIGGER),
        "device_risk_score": "cast(cast(abs(max(l_tax)) * 10 as decimal(4,2)) as string)",
        "velocity_count": "case when count(*) = 1 and min(l_quantity) between 5 and 10 then '1.5' "
                          "when count(*) = 1 and min(l_quantity) between 10 and 20 then '1.0' "
                          "else cast(count(*) as string) end",
        "model_version": _quoted(_MODEL),
        "score_timestamp": _quoted("cast(cast(min(l_shipdate) as date) as string) || ' 08:00:00'"),
    }),
    # Repeated (order, line) pairs arrive as repeated dispute ids.
    "disputes": ("{lineitem} where l_returnflag = 'R'", {
        "dispute_id": _quoted(f"'DISP_' || {padded(_LINE_NUMBER, 7)}"),
        "claim_id": _quoted(f"'CLM_' || {padded(_LINE_NUMBER, 7)}"),
        "transaction_id": _quoted(f"'TXN_' || {padded('l_orderkey', 8)}"),
        "dispute_reason": _quoted(_REASON),
        "dispute_amount": f"case when l_quantity = 1 then '0' else {_money('l_extendedprice')} end",
        "dispute_status": "case l_linestatus when 'F' then '\"Resolved\"' else '\"Under Review\"' end",
        "opened_date": _quoted("cast(cast(l_shipdate as date) as string)"),
        "card_network": _quoted(_LINE_NETWORK),
    }),
    "chargeback_outcomes": (
        "{lineitem} where l_returnflag = 'R' and l_linestatus = 'F' "
        "group by l_orderkey, l_linenumber", {
            "chargeback_id": _quoted(f"'CBK_' || {padded(_LINE_NUMBER, 7)}"),
            "dispute_id": _quoted(f"'DISP_' || {padded(_LINE_NUMBER, 7)}"),
            "outcome": "case when max(l_discount) < 0.04 then '\"Won\"' else '\"Lost\"' end",
            "win_loss_flag": "case when max(l_discount) < 0.04 then '\"Win\"' else '\"Loss\"' end",
            "final_amount": _money("max(l_extendedprice)"),
            "resolved_date": _quoted("cast(cast(max(l_shipdate) as date) "
                                     "+ cast(max(l_quantity) as int) as string)"),
            "representment_required": "case when max(l_tax) >= 0.05 then 'true' else 'false' end",
        }),
}


def _intake_sql(dataset: str) -> str:
    source, fields = _INTAKE_FIELDS[dataset]
    members = ",\n  ".join(f"""'"{name}":' || {value}""" for name, value in fields.items())
    return f"select '{{{{' || concat_ws(',',\n  {members}) || '}}}}' as line\nfrom {source}"


# JSON braces are doubled because the texts go through str.format.
INTAKE = {name: _intake_sql(name) for name in DATASETS}

# Lines of damaged files, one per month and in key order: cut off, not an object, followed by
# junk, or blank.
NOISY = """
select o_orderkey, cast(year(o_orderdate) * 100 + month(o_orderdate) as string) as month,
       case when o_totalprice < 20000 then '{{"transaction_id": "TXN_' || cast(o_orderkey as string)
            when o_totalprice < 40000 then '[' || cast(o_orderkey as string) || ']'
            when o_totalprice < 60000 then '{{"transaction_id": "TXN_' || cast(o_orderkey as string)
              || '"}} trailing'
            when o_totalprice < 80000 then '{{"transaction_id": {{"a": ' || cast(o_orderkey as string)
              || '}}}}'
            when o_totalprice < 100000 then '   '
            when o_totalprice < 110000 then '{{"transaction_id": "X", "transaction_id": "TXN_' || cast(o_orderkey as string) || '"}}'
            when o_totalprice < 120000 then ' \u00a0\u3000'
            when o_totalprice < 130000 then '{{"transaction_id": "TXN_' || cast(o_orderkey as string) || '", "amount": NaN}}'
            when o_totalprice < 140000 then '{{"amount": -Infinity, "transaction_id": INF}}'
            when o_totalprice < 150000 then '\u3000{{"transaction_id": "TXN_' || cast(o_orderkey as string) || '"}}'
            else '{{"transaction_id": "TXN_' || cast(o_orderkey as string) || '"}}' end as line
from {orders}"""

SOURCES = ("customer", "orders", "lineitem")


def for_duckdb(sql: str) -> str:
    return sql.format(**{s: s for s in SOURCES})


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {s: spark.read.parquet(f"{sf_dir}/{s}.parquet") for s in SOURCES if f"{{{s}}}" in sql}
    return spark.sql(sql, **used)


def typed(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Bronze-shaped rows of one dataset, both runs."""
    rows = run_sql(spark, sf_dir, TYPED[dataset])
    times = [n for n, t in BRONZE_TYPES[dataset].items() if t == TIME] + ["loaded_at"]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def typed_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: typed(spark, sf_dir, name) for name in DATASETS}


def clean_lines(spark: SparkSession, sf_dir: str, dataset: str, run_id: str | None = None) -> DataFrame:
    """``line`` rows of contract-conforming JSON, of one run or of both."""
    rows = typed(spark, sf_dir, dataset)
    if run_id:
        rows = rows.filter(F.col("pipeline_run_id") == run_id)
    members = []
    for spec in DATASETS[dataset].fields:
        value = F.col(spec.name)
        if spec.format == "pipeline-date":
            value = F.date_format(value, "yyyy-MM-dd")
        elif spec.format == "pipeline-date-time":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        members.append(value.alias(spec.name))
    return rows.select("pipeline_run_id", "source_file", "source_row_number", "loaded_at",
                       F.to_json(F.struct(*members)).alias("line"))


def landed(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """RAW-shaped rows: the clean JSON as VARIANT plus lineage, both runs."""
    return clean_lines(spark, sf_dir, dataset).select(
        F.parse_json("line").alias("raw_record"),
        "pipeline_run_id", "source_file", "source_row_number", "loaded_at")


def intake(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """``line`` rows as delivered."""
    return run_sql(spark, sf_dir, INTAKE[dataset])
