"""The list of named queries, and the tables and SQL they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txguard import workspace
from txguard.plans import blacklist as blacklists
from txguard.plans.detection import detect
from txguard.sources.transactions import read_transactions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HISTORY_UNTIL = 360  # the blacklist comes from the first half of the steps

# The payment view in the check engine's SQL, then the detection result on top of it.
TX = """
e AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
b AS (SELECT *, CAST(value * 1000 AS DECIMAL(18,2)) AS amt FROM e),
tx AS (SELECT event_id AS tx_id,
  CAST(date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) + 1 AS BIGINT) AS step,
  CASE event_type WHEN 'purchase' THEN 'TRANSFER' WHEN 'click' THEN 'PAYMENT'
       WHEN 'view' THEN 'CASH_IN' WHEN 'signup' THEN 'CASH_OUT' ELSE 'DEBIT' END AS type,
  CAST(amt AS DOUBLE) AS amount,
  'C' || CAST(1000000 + user_id * 100 + k AS VARCHAR) AS nameOrig,
  CAST(CASE WHEN k % 10 = 0 THEN amt WHEN k % 10 = 1 THEN 0 WHEN k % 10 = 2 THEN amt * 1.02
            WHEN k % 10 = 3 THEN amt * 1.25 ELSE amt * (k % 10) END AS DOUBLE) AS oldbalanceOrg,
  CAST(CASE WHEN k % 10 <= 3 THEN 0 ELSE amt * (k % 10) - amt END AS DOUBLE) AS newbalanceOrig,
  CASE WHEN event_id % 5 = 0 THEN 'M' ELSE 'C' END || CAST(2000000 + event_id % 997 AS VARCHAR) AS nameDest,
  CAST(k * 1000 AS DOUBLE) AS oldbalanceDest,
  CAST(CASE WHEN event_id % 7 = 0 THEN k * 1000 ELSE k * 1000 + amt END AS DOUBLE) AS newbalanceDest,
  CASE WHEN event_type IN ('purchase', 'signup') AND k % 10 IN (0, 2) AND event_id % 4 <> 0 THEN 1
       WHEN event_id % 500 = 7 THEN 1 ELSE 0 END AS isFraud,
  CASE WHEN event_type IN ('purchase', 'signup') AND k % 10 = 0 AND event_id % 4 <> 0 AND amt > 200000
       THEN 1 ELSE 0 END AS isFlaggedFraud,
  ts AS ingested_at FROM b)"""

RISKY = "type IN ('TRANSFER', 'CASH_OUT')"
RATIO = "CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0.0 END"
RULE = (
    f"CASE WHEN {RISKY} AND newbalanceOrig = 0 AND oldbalanceOrg > 0 "
    "AND amount / NULLIF(oldbalanceOrg, 0) BETWEEN 0.95 AND 1.05 THEN 1 ELSE 0 END"
)
BLACKLIST = f"""
bl AS (SELECT DISTINCT nameOrig AS account FROM tx WHERE isFraud = 1 AND step <= {HISTORY_UNTIL})"""
DETECTED = f"""
det AS (SELECT *, CASE WHEN rule_fraud_flag = 1 OR blacklist_flag = 1 THEN 1 ELSE 0 END AS is_fraud_detected
  FROM (SELECT *, newbalanceOrig - oldbalanceOrg AS balance_diff_orig,
    newbalanceDest - oldbalanceDest AS balance_diff_dest,
    CASE WHEN {RISKY} THEN 1 ELSE 0 END AS is_transfer_or_cashout,
    {RATIO} AS amount_to_balance_ratio,
    CASE WHEN nameOrig IN (SELECT account FROM bl) THEN 1 ELSE 0 END AS blacklist_flag,
    {RULE} AS rule_fraud_flag FROM tx)),
fraud AS (SELECT * FROM det WHERE is_fraud_detected = 1)"""


def on_transactions(sql: str) -> str:
    """``sql`` over the payment view ``tx``."""
    return f"WITH {TX}\n{sql}"


def on_blacklist(sql: str) -> str:
    return f"WITH {TX}, {BLACKLIST}\n{sql}"


def on_detected(sql: str) -> str:
    """``sql`` over ``tx``, ``bl``, ``det`` (all rows) and ``fraud`` (flagged rows)."""
    return f"WITH {TX}, {BLACKLIST}, {DETECTED}\n{sql}"


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows where there is one."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return read_transactions(spark, folder)


_published: dict[tuple[str, str], str] = {}


def blacklist_path(spark: SparkSession, folder: str) -> str:
    """The blacklist is a table that exists before detection runs; publish it once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _published:
        path = workspace.new_path(spark, "blacklist")
        blacklists.publish(blacklists.build(transactions(spark, folder), HISTORY_UNTIL), path)
        _published[key] = path
    return _published[key]


def blacklist(spark: SparkSession, folder: str) -> DataFrame:
    return blacklists.read(spark, blacklist_path(spark, folder))


def detected(spark: SparkSession, folder: str) -> DataFrame:
    return detect(transactions(spark, folder), blacklist(spark, folder))
