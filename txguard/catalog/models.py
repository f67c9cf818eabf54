"""Queries that train or apply a model.

Forests are random in detail; what does not depend on the fit has SQL: test rows, verdicts, names and totals.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from txguard import workspace
from txguard.catalog.base import RISKY, RULE, blacklist, blacklist_path, on_transactions, query, transactions
from txguard.catalog.streams import topic
from txguard.functions.features import mismatch
from txguard.functions.rules import drain_rule
from txguard.operators.frequency import encode_frequency
from txguard.plans import anomaly, detection, ranking, training
from txguard.schema import FEATURE_COLUMNS, RESIDUAL_FEATURES
from txguard.sources.transactions import text_stream
from txguard.streaming import detection as streaming

_registries: dict[tuple[str, str], str] = {}


def registry(spark, folder) -> str:
    """Root of a model registry with one trained, recorded and promoted run; built once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _registries:
        root = workspace.new_path(spark, "registry")
        model, values = training.train(transactions(spark, folder))
        training.log_run(spark, root, "run-1", training.save_model(model, root, "run-1"), values)
        training.promote(spark, root)
        _registries[key] = root
    return _registries[key]


@query("ml_train")
def ml_train(spark, folder):
    """Train with the default settings and report the metrics of the test part."""
    _, values = training.train(transactions(spark, folder))
    return spark.createDataFrame(sorted(values.items()), "metric string, value double")


@query("ml_runs")
def ml_runs(spark, folder):
    return training.read_runs(spark, registry(spark, folder))


@query("ml_metrics")
def ml_metrics(spark, folder):
    """Confusion counts of the promoted model on the test part."""
    model = training.champion_model(spark, registry(spark, folder))
    _, test = training.split(training.training_rows(transactions(spark, folder)), "tx_id")
    return training.confusion(model.transform(test))


@query("ml_score")
def ml_score(spark, folder):
    model = training.champion_model(spark, registry(spark, folder))
    return detection.score(transactions(spark, folder), model).select("tx_id", "ml_fraud_flag", "ml_probability")


@query("detect_with_model")
def detect_with_model(spark, folder):
    model = training.champion_model(spark, registry(spark, folder))
    return detection.detect_with_model(transactions(spark, folder), blacklist(spark, folder), model)


@query("stream_detect_with_model")
def stream_detect_with_model(spark, folder):
    """The detection stream with the promoted model as third layer."""
    root = workspace.new_path(spark, "detection")
    sinks = streaming.lake_sinks(spark, root, with_model=True)
    source = text_stream(spark, topic(spark, folder), files_per_trigger=2).select("value")
    streaming.run_to_end(streaming.start_detection(
        source, blacklist_path(spark, folder), sinks, f"{root}/checkpoint", once=True,
        registry=registry(spark, folder)))
    return sinks.transactions.read().drop("ingested_at", "batch_id")


@query("ml_latest_run")
def ml_latest_run(spark, folder):
    return training.latest_run(training.read_runs(spark, registry(spark, folder)))


@query("ml_promote")
def ml_promote(spark, folder):
    """A smaller challenger against the champion: the run table says who holds the title."""
    root = workspace.new_path(spark, "registry")
    tx = transactions(spark, folder)
    _, test_rows = training.split(training.training_rows(tx), "tx_id")
    for run, trees, depth in (("small", 5, 3), ("large", 20, 10)):
        model, values = training.train(tx, trees=trees, depth=depth)
        training.log_run(spark, root, run, training.save_model(model, root, run), values)
        training.promote(spark, root, test_rows=test_rows)
    return training.read_runs(spark, root).select("run", "status", "metric", "value")


@query("ml_importance")
def ml_importance(spark, folder):
    return training.importance(training.champion_model(spark, registry(spark, folder)))


@query("ml_residual")
def ml_residual(spark, folder):
    """Importance of the raw columns in the forest on what the rule misses."""
    return training.importance(training.train_residual(transactions(spark, folder)), RESIDUAL_FEATURES)


@query("anomaly_score")
def anomaly_score(spark, folder):
    columns = ["amount", "type_freq", "balance_changed"]
    tx = transactions(spark, folder).withColumn("balance_changed", mismatch("oldbalanceOrg", "newbalanceOrig"))
    rows = encode_frequency(tx, "type", "type_freq").select("tx_id", *columns)
    forest = anomaly.grow_forest(rows, columns, ["tx_id"])
    scored = anomaly.anomaly_scores(rows, forest, columns)
    return anomaly.flag_anomalies(workspace.write_table(scored, workspace.new_path(spark, "scores")))


@query("ml_test_rows", on_transactions(f"SELECT CAST(isFraud AS DOUBLE) AS label, COUNT(*) AS n FROM tx WHERE {RISKY} AND tx_id % 10 >= 8 GROUP BY 1"))
def ml_test_rows(spark, folder):
    """Every test row is predicted once, whatever the prediction."""
    return ml_metrics(spark, folder).groupBy("label").agg(F.sum("n").alias("n"))


# The rule as a classifier, the amount as the score: the same measures as for a forest, on predictions that SQL can make too.
_PREDICTED = f"""p AS (SELECT isFraud AS label, {RULE} AS predicted, amount AS score FROM tx),
c AS (SELECT score, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label <> 1) AS neg FROM p GROUP BY score),
r AS (SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER () AS positives, SUM(neg) OVER () AS negatives
  FROM c WINDOW w AS (ORDER BY score DESC)),
k AS (SELECT *, tp::DOUBLE / (tp + fp) AS here, CASE WHEN tp + fp > pos + neg
  THEN (tp - pos)::DOUBLE / (tp + fp - pos - neg) ELSE tp::DOUBLE / (tp + fp) END AS earlier FROM r),
areas AS (SELECT SUM(neg * (2 * tp - pos))::DOUBLE / (2 * ANY_VALUE(positives) * ANY_VALUE(negatives)) AS auc_roc,
  SUM(pos * (here + earlier) / 2) / ANY_VALUE(positives) AS auprc FROM k)"""
_CLASS = """SELECT {0} AS class, COUNT(*) FILTER (label = {0} AND predicted = {0}) / CAST(COUNT(*) FILTER (predicted = {0}) AS DOUBLE) AS precision,
  COUNT(*) FILTER (label = {0} AND predicted = {0}) / CAST(COUNT(*) FILTER (label = {0}) AS DOUBLE) AS recall,
  COUNT(*) FILTER (label = {0}) / CAST(COUNT(*) AS DOUBLE) AS share FROM p"""


def rule_predictions(spark, folder):
    rows = transactions(spark, folder).select(
        "isFraud", drain_rule().cast("double").alias("prediction"), F.col("amount").alias("score"))
    return workspace.write_table(rows, workspace.new_path(spark, "predictions"))


@query("ranking_metrics", on_transactions(f""", {_PREDICTED}
SELECT (SELECT CAST(SUM(pos) AS BIGINT) FROM c) AS positives, (SELECT CAST(SUM(neg) AS BIGINT) FROM c) AS negatives,
  ROUND(auc_roc, 9) AS auc_roc, ROUND(auprc, 9) AS auprc FROM areas"""))
def ranking_query(spark, folder):
    found = ranking.ranking_metrics(rule_predictions(spark, folder))
    return found.withColumns({c: F.round(c, 9) for c in ("auc_roc", "auprc")})


@query("ranking_curve", on_transactions(f""", {_PREDICTED}
SELECT score, pos, neg, CAST(tp - pos AS BIGINT) AS before_pos, CAST(fp - neg AS BIGINT) AS before_neg FROM r"""))
def ranking_curve(spark, folder):
    return ranking.ranking_curve(rule_predictions(spark, folder))


@query("ml_rule_metrics", on_transactions(f""", {_PREDICTED},
classes AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM ({_CLASS.format(0)} UNION ALL {_CLASS.format(1)})),
named AS (SELECT UNNEST([{{'metric': 'auprc', 'value': auprc}}, {{'metric': 'auc_roc', 'value': auc_roc}}]) AS m FROM areas
UNION ALL SELECT UNNEST([{{'metric': 'f1_score', 'value': SUM(f1 * share)}}, {{'metric': 'precision', 'value': SUM(precision * share)}},
  {{'metric': 'recall', 'value': SUM(recall * share)}}]) FROM classes
UNION ALL SELECT UNNEST([{{'metric': 'fraud_f1_score', 'value': f1}}, {{'metric': 'fraud_precision', 'value': precision}},
  {{'metric': 'fraud_recall', 'value': recall}}]) FROM classes WHERE class = 1)
SELECT m.metric AS metric, ROUND(m.value, 9) AS value FROM named"""))
def ml_rule_metrics(spark, folder):
    """All measures that a training run records, for the rule."""
    values = training.metrics(rule_predictions(spark, folder))
    return spark.createDataFrame([(k, round(v, 9)) for k, v in sorted(values.items())], "metric string, value double")


@query("ml_run_metrics", "SELECT * FROM (VALUES " + ", ".join(f"('run-1', '{s}', '{m}')" for s, m in [
    *(("FINISHED", m) for m in ("auprc", "auc_roc", "f1_score", "precision", "recall", "fraud_f1_score", "fraud_precision", "fraud_recall")),
    ("PROMOTED", "fraud_f1_score")]) + ") v(run, status, metric)")
def ml_run_metrics(spark, folder):
    """Which values the run table holds, all of them between 0 and 1."""
    return ml_runs(spark, folder).where("value BETWEEN 0 AND 1").select("run", "status", "metric")


@query("ml_importance_names", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', 1.0::DOUBLE)" for c in FEATURE_COLUMNS) + ") v(feature, total)")
def ml_importance_names(spark, folder):
    """Every input has its importance, and together they make one."""
    rows = ml_importance(spark, folder)
    total = rows.agg(F.round(F.sum("importance"), 9).alias("total"))
    return rows.select("feature", total.scalar().alias("total"))


@query("ml_verdicts", on_transactions("""SELECT type, COUNT(*) AS rows, 0::BIGINT AS wrong,
  0::BIGINT AS flagged_outside FROM tx GROUP BY type"""))
def ml_verdicts(spark, folder):
    """The verdict is the OR of three flags, and the model flags risky types only."""
    rows = detect_with_model(spark, folder)
    verdict = F.greatest("rule_fraud_flag", "blacklist_flag", "ml_fraud_flag")
    outside = ~F.col("type").isin("TRANSFER", "CASH_OUT") & (F.col("ml_fraud_flag") == 1)
    return rows.groupBy("type").agg(
        F.count("*").alias("rows"), F.count_if(F.col("is_fraud_detected") != verdict).alias("wrong"),
        F.count_if(outside).alias("flagged_outside"))
