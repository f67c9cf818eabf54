"""Queries on whole tables: dashboard numbers, exploration, profiles, windows, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from txguard.catalog.base import RATIO, RISKY, RULE, detected, on_detected, on_transactions, query, transactions
from txguard.operators import profile, velocity
from txguard.plans import dashboard, exploration
from txguard.schema import TX_COLUMNS

_MONEY = "CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)"


def _money(where: str) -> str:
    return f"CAST(SUM(CASE WHEN {where} THEN CAST(amount AS DECIMAL(18,2)) END) AS DOUBLE)"


# Headline numbers

_HEADLINE = f"""SELECT COUNT(*) AS total, COUNT(*) FILTER (is_fraud_detected = 1) AS fraud_total,
  COUNT(*) FILTER (is_fraud_detected = 1) / CAST(COUNT(*) AS DOUBLE) * 100 AS fraud_rate,
  {_MONEY} / COUNT(*) AS avg_amount FROM det"""


@query("kpi_headline", on_detected(_HEADLINE))
def kpi_headline(spark, folder):
    return dashboard.headline(detected(spark, folder))


@query("kpi_analytics", on_detected(f"""SELECT *, CASE WHEN fraud_rate < 1 THEN 'low' WHEN fraud_rate < 2.5 THEN 'medium'
  ELSE 'high' END AS rate_band FROM (
SELECT COUNT(*) AS total, COUNT(*) FILTER (is_fraud_detected = 1) AS fraud_total,
  CAST((SELECT SUM(blacklist_flag) FROM fraud) AS BIGINT) AS blacklist_count,
  CAST((SELECT SUM(rule_fraud_flag) FROM fraud) AS BIGINT) AS rule_count,
  {_money('is_fraud_detected = 1')} / COUNT(*) FILTER (is_fraud_detected = 1) AS avg_fraud_amount,
  {_money('is_fraud_detected = 0')} / COUNT(*) FILTER (is_fraud_detected = 0) AS avg_normal_amount,
  COUNT(*) FILTER (is_fraud_detected = 1) / CAST(COUNT(*) AS DOUBLE) * 100 AS fraud_rate FROM det)"""))
def kpi_analytics(spark, folder):
    return dashboard.analytics(detected(spark, folder))


@query("source_split_inclusive", on_detected("""SELECT 'blacklist' AS source, CAST(SUM(blacklist_flag) AS BIGINT) AS n FROM fraud
UNION ALL SELECT 'rule', CAST(SUM(rule_fraud_flag) AS BIGINT) FROM fraud
UNION ALL SELECT 'model', CAST(GREATEST(0, COUNT(*) - SUM(blacklist_flag) - SUM(rule_fraud_flag)) AS BIGINT) FROM fraud"""))
def source_split_inclusive(spark, folder):
    return dashboard.source_split_inclusive(detected(spark, folder))


@query("source_split_exclusive", on_detected("""SELECT CASE WHEN blacklist_flag = 1 THEN 'blacklist'
  WHEN rule_fraud_flag = 1 THEN 'rule' ELSE 'model' END AS source, COUNT(*) AS n FROM fraud GROUP BY 1"""))
def source_split_exclusive(spark, folder):
    return dashboard.source_split_exclusive(detected(spark, folder))


@query("by_type", on_detected("SELECT type, COUNT(*) AS count, CAST(SUM(is_fraud_detected) AS BIGINT) AS fraud_count "
                              "FROM det GROUP BY type"))
def by_type(spark, folder):
    return dashboard.by_type(detected(spark, folder))


@query("fraud_by_type", on_detected(f"SELECT type, COUNT(*) AS fraud_count, {_MONEY} AS total_amount FROM fraud GROUP BY type"))
def fraud_by_type(spark, folder):
    return dashboard.fraud_by_type(detected(spark, folder))


@query("freshness", on_detected("SELECT MAX(ingested_at) AS last_ingested FROM det"))
def freshness(spark, folder):
    return dashboard.freshness(detected(spark, folder))


@query("ops_summary", on_detected(f"""
, k AS ({_HEADLINE}),
top AS (SELECT nameOrig, COUNT(*) AS n, {_MONEY} AS amount FROM fraud GROUP BY 1 ORDER BY n DESC, nameOrig LIMIT 5),
feed AS (SELECT * FROM fraud ORDER BY ingested_at DESC, tx_id LIMIT 5),
ty AS (SELECT type, COUNT(*) AS n FROM fraud GROUP BY 1)
SELECT 'totals' AS section, 1 AS rank, NULL::VARCHAR AS label, total AS n, ROUND(fraud_rate, 3) AS amount,
  CAST(fraud_total AS VARCHAR) AS note FROM k
UNION ALL SELECT 'freshness', 1, strftime(MAX(ingested_at), '%Y-%m-%d %H:%M:%S'), 1, NULL, NULL FROM det
UNION ALL SELECT 'top_fraud', CAST(ROW_NUMBER() OVER (ORDER BY n DESC, nameOrig) AS INT),
  CASE WHEN length(nameOrig) > 5 THEN nameOrig[1:5] || repeat('*', length(nameOrig) - 5) ELSE nameOrig END,
  n, ROUND(amount, 2), NULL FROM top
UNION ALL SELECT 'recent_fraud', CAST(ROW_NUMBER() OVER (ORDER BY ingested_at DESC, tx_id) AS INT),
  nameOrig[1:5] || '*** > ' || nameDest[1:5] || '***', 1, amount,
  type || ' ' || CASE WHEN blacklist_flag = 1 THEN 'Blacklist' WHEN rule_fraud_flag = 1 THEN 'Rule' ELSE 'ML Model' END
    || ' ' || strftime(ingested_at, '%Y-%m-%d %H:%M:%S') FROM feed
UNION ALL SELECT 'fraud_by_type', CAST(ROW_NUMBER() OVER (ORDER BY n DESC, type) AS INT), type, n, NULL, NULL FROM ty"""))
def ops_summary(spark, folder):
    return dashboard.ops_summary(detected(spark, folder))


# Time lines

def _since(hours: int) -> str:
    return f"ingested_at >= (SELECT MAX(ingested_at) FROM det) - INTERVAL {hours} HOUR"


@query("recent_minutes", on_detected(" UNION ALL ".join(
    f"SELECT {h} AS hours, COUNT(*) AS total, COUNT(*) FILTER (is_fraud_detected = 1) AS fraud FROM det "
    f"WHERE {_since(h)} HAVING COUNT(*) > 0" for h in (1, 2, 3))))
def recent_minutes(spark, folder):
    return dashboard.lookback_counts(detected(spark, folder))


# The dashboard's look-backs of one to three hours hold few test rows, so the time lines are also asked for 30 days.
def _fraud_minutes(hours: int) -> str:
    return f"SELECT date_trunc('minute', ingested_at) AS minute, COUNT(*) AS fraud_count FROM fraud WHERE {_since(hours)} GROUP BY 1"


def _running(hours: int) -> str:
    return (f"SELECT minute, fraud_count, CAST(SUM(fraud_count) OVER (ORDER BY minute) AS BIGINT) AS cumulative "
            f"FROM ({_fraud_minutes(hours)})")


@query("fraud_per_minute", on_detected(_fraud_minutes(720)))
def fraud_per_minute(spark, folder):
    return dashboard.fraud_per_minute(detected(spark, folder), 720)


@query("fraud_per_minute_1h", on_detected(_fraud_minutes(1)))
def fraud_per_minute_1h(spark, folder):
    return dashboard.fraud_per_minute(detected(spark, folder), 1)


def _volume(hours: int) -> str:
    return (f"SELECT date_trunc('minute', ingested_at) AS minute, COUNT(*) AS total, "
            f"CAST(SUM(is_fraud_detected) AS BIGINT) AS fraud FROM det WHERE {_since(hours)} GROUP BY 1")


@query("volume_per_minute", on_detected(_volume(720)))
def volume_per_minute(spark, folder):
    return dashboard.per_minute(detected(spark, folder), 720)


@query("volume_per_minute_2h", on_detected(_volume(2)))
def volume_per_minute_2h(spark, folder):
    return dashboard.per_minute(detected(spark, folder), 2)


@query("cumulative_fraud_1h", on_detected(_running(1)))
def cumulative_fraud_1h(spark, folder):
    return dashboard.cumulative_fraud(detected(spark, folder), 1)


@query("cumulative_fraud_3h", on_detected(_running(3)))
def cumulative_fraud_3h(spark, folder):
    return dashboard.cumulative_fraud(detected(spark, folder), 3)


@query("cumulative_fraud_30d", on_detected(_running(720)))
def cumulative_fraud_30d(spark, folder):
    return dashboard.cumulative_fraud(detected(spark, folder), 720)


@query("hour_heatmap", on_detected("SELECT type, " + ", ".join(
    f"COUNT(*) FILTER (step % 24 = {h}) AS h{h:02d}" for h in range(24)) + " FROM fraud GROUP BY type"))
def hour_heatmap(spark, folder):
    return dashboard.hour_heatmap(detected(spark, folder))


# Rankings and feeds

def _top(account: str) -> str:
    return f"""SELECT CASE WHEN length({account}) > 5 THEN {account}[1:5] || repeat('*', length({account}) - 5) ELSE {account} END
  AS {account}, fraud_count, total_amount, total_amount / fraud_count AS avg_amount FROM (
  SELECT {account}, COUNT(*) AS fraud_count, {_MONEY} AS total_amount FROM fraud GROUP BY 1
  ORDER BY fraud_count DESC, {account} LIMIT 10)"""


@query("top_senders", on_detected(_top("nameOrig")))
def top_senders(spark, folder):
    return dashboard.top_accounts(detected(spark, folder), "nameOrig")


@query("top_receivers", on_detected(_top("nameDest")))
def top_receivers(spark, folder):
    return dashboard.top_accounts(detected(spark, folder), "nameDest")


@query("alert_feed", on_detected("""SELECT nameOrig[1:5] || repeat('*', length(nameOrig) - 5) AS nameOrig,
  nameDest[1:5] || repeat('*', length(nameDest) - 5) AS nameDest, format('${:,.2f}', amount) AS amount, type,
  CASE WHEN blacklist_flag = 1 THEN 'Blacklist' WHEN rule_fraud_flag = 1 THEN 'Rule' ELSE 'ML Model' END AS reason,
  ingested_at FROM fraud ORDER BY ingested_at DESC, tx_id LIMIT 20"""))
def alert_feed(spark, folder):
    return dashboard.alert_feed(detected(spark, folder))


@query("chart_sample", on_detected("""SELECT tx_id, amount, is_fraud_detected FROM det WHERE amount < 2000000
ORDER BY CAST('0x' || substr(md5(tx_id || ':42'), 1, 15) AS BIGINT) LIMIT 15000"""))
def chart_sample(spark, folder):
    return dashboard.chart_sample(detected(spark, folder))


# Exploration

@query("class_counts", on_transactions("""SELECT COUNT(*) FILTER (isFraud = 1) AS fraud_count,
  COUNT(*) FILTER (isFraud = 0) AS normal_count,
  COUNT(*) FILTER (isFraud = 0) / CAST(COUNT(*) FILTER (isFraud = 1) AS DOUBLE) AS ratio FROM tx"""))
def class_counts(spark, folder):
    return exploration.class_counts(transactions(spark, folder))


@query("class_weights", on_transactions(f""", r AS (SELECT * FROM tx WHERE {RISKY})
SELECT tx_id, isFraud, isFraud * ((SELECT COUNT(*) FILTER (isFraud = 0) / CAST(COUNT(*) FILTER (isFraud = 1) AS DOUBLE) FROM r) - 1) + 1
  AS classWeight FROM r"""))
def class_weights(spark, folder):
    risky = transactions(spark, folder).where("type IN ('TRANSFER', 'CASH_OUT')")
    return exploration.with_class_weight(risky).select("tx_id", "isFraud", "classWeight")


def _rates(key: str) -> str:
    return f"""SELECT {key}, COUNT(*) AS count, CAST(SUM(isFraud) AS BIGINT) AS fraud_count,
  SUM(isFraud) / CAST(COUNT(*) AS DOUBLE) AS fraud_rate FROM tx GROUP BY {key}"""


@query("fraud_rate_by_type", on_transactions(_rates("type")))
def fraud_rate_by_type(spark, folder):
    return exploration.rate_by(transactions(spark, folder), "type")


@query("fraud_rate_by_step", on_transactions(_rates("step")))
def fraud_rate_by_step(spark, folder):
    return exploration.rate_by(transactions(spark, folder), "step")


@query("full_file_totals", on_transactions("""SELECT kind, name, n, n / CAST((SELECT COUNT(*) FROM tx) AS DOUBLE) * 100 AS percent FROM (
  SELECT 'label' AS kind, CAST(isFraud AS VARCHAR) AS name, COUNT(*) AS n FROM tx GROUP BY 2
  UNION ALL SELECT 'type', type, COUNT(*) FROM tx GROUP BY 2 UNION ALL SELECT 'rows', 'all', COUNT(*) FROM tx)"""))
def full_file_totals(spark, folder):
    return exploration.full_totals(transactions(spark, folder))


@query("rule_confusion", on_transactions(f"""SELECT *, caught_fraud / CAST(total_fraud AS DOUBLE) * 100 AS catch_rate FROM (
  SELECT COUNT(*) FILTER (isFraud = 1) AS total_fraud, COUNT(*) FILTER (isFraud = 1 AND caught = 1) AS caught_fraud,
    COUNT(*) FILTER (isFraud = 1 AND caught = 0) AS missed_fraud,
    COUNT(*) FILTER (isFraud = 0 AND caught = 1) AS false_positives
  FROM (SELECT *, {RULE} AS caught FROM tx WHERE {RISKY}))"""))
def rule_confusion(spark, folder):
    return exploration.rule_confusion(transactions(spark, folder))


def _histogram(value: str, bins: int, low: str = "(SELECT MIN(v) FROM d)", high: str = "(SELECT MAX(v) FROM d)",
               density: bool = True) -> str:
    return f""", d AS (SELECT CAST({value} AS DOUBLE) AS v, CASE WHEN isFraud = 1 THEN 'Fraud' ELSE 'Non-fraud' END AS label FROM tx),
lim AS (SELECT CAST({low} AS DOUBLE) AS lo, CAST({high} AS DOUBLE) AS hi),
c AS (SELECT label, CAST(LEAST(FLOOR((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INT) AS bin, COUNT(*) AS n,
    MAX((hi - lo) / {bins}) AS width FROM d, lim WHERE v BETWEEN lo AND hi GROUP BY 1, 2)
SELECT label, bin, n{", n / (SUM(n) OVER (PARTITION BY label) * width) AS density" if density else ""} FROM c"""


@query("amount_histogram", on_transactions(_histogram("amount", 60)))
def amount_histogram(spark, folder):
    return exploration.amount_histogram(transactions(spark, folder))


@query("amount_histogram_log", on_transactions(_histogram("CASE WHEN amount > 0 THEN log10(amount) END", 60)))
def amount_histogram_log(spark, folder):
    return exploration.amount_histogram(transactions(spark, folder), log=True)


@query("step_histogram", on_transactions(_histogram("step", 50, density=False)))
def step_histogram(spark, folder):
    return exploration.step_histogram(transactions(spark, folder))


@query("ratio_density", on_transactions(_histogram(RATIO, 60, "0", "3")))
def ratio_density(spark, folder):
    return exploration.ratio_density(transactions(spark, folder))


@query("box_stats", on_detected("""SELECT is_fraud_detected, MIN(amount) AS min, quantile_cont(amount, 0.25) AS q1,
  quantile_cont(amount, 0.5) AS median, quantile_cont(amount, 0.75) AS q3, MAX(amount) AS max
FROM det WHERE amount < 2000000 GROUP BY 1"""))
def box_stats(spark, folder):
    return exploration.box_stats(detected(spark, folder))


_NUMERIC = ["step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud"]
_TEXT = ["type", "nameOrig", "nameDest"]


@query("profile_numeric", on_transactions(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG({c}), 3) AS mean, ROUND(stddev_samp({c}), 3) AS std,
  CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50,
  quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, CAST(MAX({c}) AS DOUBLE) AS max FROM tx""" for c in _NUMERIC)))
def profile_numeric(spark, folder):
    """Mean and deviation are rounded, since sums of doubles depend on the order of the tasks."""
    built = profile.numeric_profile(transactions(spark, folder), _NUMERIC)
    return built.withColumns({"mean": F.round("mean", 3), "std": F.round("std", 3)})


@query("profile_string", on_transactions(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(SUM(n) AS BIGINT) AS count, COUNT(*) AS "unique",
  (SELECT {c} FROM tx GROUP BY 1 ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS top, MAX(n) AS freq
FROM (SELECT {c}, COUNT(*) AS n FROM tx GROUP BY 1)""" for c in _TEXT)))
def profile_string(spark, folder):
    return profile.string_profile(transactions(spark, folder), _TEXT)


@query("missing_counts", " UNION ALL ".join(
    f"""SELECT '{t}.{c}' AS "column", COUNT(*) - COUNT(l.{c}) AS missing FROM documents d LEFT JOIN labels l USING (doc_id)"""
    if t == "labels" else f"""SELECT '{t}.{c}' AS "column", COUNT(*) - COUNT({c}) AS missing FROM documents"""
    for t, c in (("documents", "text"), ("documents", "lang"), ("labels", "quality"), ("labels", "toxic"))))
def missing_counts(spark, folder):
    """Documents and their labels, where some are missing."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic")
    joined = docs.join(labels, "doc_id", "left").select(
        F.col("text").alias("documents_text"), F.col("lang").alias("documents_lang"),
        F.col("quality").alias("labels_quality"), F.col("toxic").alias("labels_toxic"))
    return profile.missing_counts(joined).withColumn("column", F.regexp_replace("column", "_", "."))


@query("duplicate_count", "SELECT COUNT(*) - COUNT(DISTINCT text) AS duplicate_rows FROM documents")
def duplicate_count(spark, folder):
    return profile.duplicate_count(spark.read.parquet(f"{folder}/documents.parquet").select("text"))


@query("duplicate_records", on_transactions(f"""SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows FROM (
  SELECT COUNT(*) AS n FROM (SELECT {', '.join(TX_COLUMNS)} FROM tx UNION ALL SELECT {', '.join(TX_COLUMNS)} FROM tx WHERE step <= 100)
  GROUP BY {', '.join(TX_COLUMNS)})"""))
def duplicate_records(spark, folder):
    """Whole records that came twice: all transactions, with the first hundred hours sent again."""
    rows = transactions(spark, folder).select(TX_COLUMNS)
    return profile.duplicate_count(rows.unionByName(rows.where("step <= 100")))


@query("union_labelled", on_transactions(f"""SELECT step, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, isFraud
FROM tx WHERE {RISKY} AND {RULE} = 0"""))
def union_labelled(spark, folder):
    return exploration.labelled_residual(transactions(spark, folder))


# Velocity

def _trailing(account: str, window: str) -> str:
    return f"""SELECT DISTINCT {account}, ingested_at, COUNT(*) OVER (PARTITION BY {account}, ingested_at) AS n,
  COUNT(*) OVER (PARTITION BY {account} ORDER BY ingested_at RANGE BETWEEN INTERVAL '{window}' PRECEDING AND CURRENT ROW) AS n_window
FROM tx"""


@query("velocity_60s", on_transactions(_trailing("nameOrig", "59.999999 seconds")))
def velocity_60s(spark, folder):
    return velocity.trailing_counts(transactions(spark, folder), "nameOrig", "ingested_at", 60)


@query("velocity_10d", on_transactions(_trailing("nameDest", "863999.999999 seconds")))
def velocity_10d(spark, folder):
    return velocity.trailing_counts(transactions(spark, folder), "nameDest", "ingested_at", 864_000)


@query("velocity_by_type_60s", on_transactions(_trailing("type", "59.999999 seconds")))
def velocity_by_type_60s(spark, folder):
    """Five keys only: each holds a fifth of all rows and is counted slice by slice."""
    return velocity.trailing_counts(transactions(spark, folder), "type", "ingested_at", 60)


# Steps through each account's events one by one, remembering the passed ones.
def _limiter(account: str, limit: int, seconds: int) -> str:
    live = f"list_filter(r.kept, lambda t: t > e.seen - INTERVAL {seconds} SECOND)"
    return f""", ev AS (SELECT {account} AS account, ingested_at AS seen, COUNT(*) AS n,
    ROW_NUMBER() OVER (PARTITION BY {account} ORDER BY ingested_at) AS i FROM tx GROUP BY 1, 2),
run AS (SELECT account, i, seen, n, LEAST(n, {limit}) AS allowed, list_resize([seen], LEAST(n, {limit}), seen) AS kept
  FROM ev WHERE i = 1
  UNION ALL
  SELECT account, i, seen, n, allowed, list_concat(live, list_resize([seen], allowed, seen)) FROM (
    SELECT e.account, e.i, e.seen, e.n, {live} AS live, GREATEST(0, LEAST(e.n, {limit} - len({live}))) AS allowed
    FROM run r JOIN ev e ON e.account = r.account AND e.i = r.i + 1))
SELECT account AS {account}, seen AS ingested_at, n, allowed, n - allowed AS rejected,
  CAST(GREATEST({limit} - len(kept), 0) AS BIGINT) AS remaining FROM run"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


LIMITER_BY_RECEIVER = _recursive(on_transactions(_limiter("nameDest", 2, 864_000)))


@query("velocity_limiter", LIMITER_BY_RECEIVER)
def velocity_limiter(spark, folder):
    """At most two passed transactions per receiver in ten days."""
    return velocity.limit_rate(transactions(spark, folder), "nameDest", "ingested_at", 2, 864_000)


@query("velocity_limiter_60s", _recursive(on_transactions(_limiter("nameOrig", 100, 60))))
def velocity_limiter_60s(spark, folder):
    """The default limit: 100 passed transactions per sender in 60 seconds."""
    return velocity.limit_rate(transactions(spark, folder), "nameOrig", "ingested_at")
