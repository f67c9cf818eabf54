"""Training, run records, promotion, scoring and the isolation forest, on small data."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import accounts
from pyspark.sql import functions as F

from txguard import workspace
from txguard.operators.sampling import hash_order, sample_rows, split_by_id
from txguard.plans import anomaly, blacklist, detection, jobs, training
from txguard.plans.exploration import class_counts, full_totals, labelled_residual, rule_confusion, with_class_weight
from txguard.schema import SCORED_SCHEMA
from txguard.sources import messages
from txguard.sources.transactions import from_events, text_stream
from txguard.streaming import detection as streaming

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def history(spark):
    return from_events(spark.read.parquet(f"{FOLDER}/events.parquet"))


@pytest.fixture(scope="module")
def fitted(history):
    return training.train(history, trees=10, depth=5)


def test_metrics_of_a_trained_forest(fitted):
    _, values = fitted
    assert set(values) == {"auprc", "auc_roc", "f1_score", "precision", "recall",
                           "fraud_f1_score", "fraud_precision", "fraud_recall"}
    assert all(0 <= v <= 1 for v in values.values()) and values["auc_roc"] > 0.8


def test_metrics_equal_the_evaluators(fitted, history):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    model, values = fitted
    _, test = training.split(training.training_rows(history), "tx_id")
    predictions = model.transform(test)
    for ours, theirs in (("f1_score", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
        found = MulticlassClassificationEvaluator(
            labelCol="isFraud", predictionCol="prediction", metricName=theirs).evaluate(predictions)
        assert values[ours] == pytest.approx(found)


def test_split_depends_on_the_id_only(spark):
    rows = spark.range(100).withColumnRenamed("id", "tx_id")
    train, test = training.split(rows.repartition(9), "tx_id")
    assert {r.tx_id % 10 for r in test.collect()} == {8, 9} and train.count() == 80
    a, b = training.split(rows)
    assert a.count() + b.count() == 100


def test_class_weight(tx):
    rows = with_class_weight(tx({"isFraud": 1}, {}, {}, {}))
    assert sorted(r.classWeight for r in rows.collect()) == [1.0, 1.0, 1.0, 3.0]
    assert class_counts(tx({})).first().ratio is None
    with pytest.raises(ValueError, match="no fraud"):
        training.training_rows(tx({"type": "TRANSFER"}))


def test_scoring_flags_only_risky_types(spark, fitted, history, tx):
    model, _ = fitted
    scored = detection.score(history, model)
    assert scored.where("ml_fraud_flag = 1 AND type NOT IN ('TRANSFER', 'CASH_OUT')").isEmpty()
    assert scored.count() == history.count() and not scored.where("ml_fraud_flag = 1").isEmpty()
    detected = detection.detect_with_model(history, accounts(spark), model)
    by_hand = F.greatest("rule_fraud_flag", "blacklist_flag", "ml_fraud_flag")
    assert detected.where(F.col("is_fraud_detected") != by_hand).isEmpty()
    assert detected.where(F.col("reason").isNull() != (F.col("is_fraud_detected") == 0)).isEmpty()
    assert detection.score(tx({"type": "GIFT"}), model).first().ml_fraud_flag == 0


def test_formatted_plan_names_the_scan(history):
    text = training.formatted_plan(training.training_features(history))
    assert "== Physical Plan ==" in text and "Scan parquet" in text


def test_importance_is_ranked(fitted):
    rows = training.importance(fitted[0]).collect()
    assert len(rows) == 14 and sum(r.importance for r in rows) == pytest.approx(1)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_promotion_needs_a_better_score(spark):
    root = workspace.new_path(spark, "registry-test")
    assert training.promote(spark, root) is False and training.champion_model(spark, root) is None
    outcomes = []
    for minute, (run, score) in enumerate([("a", 0.5), ("b", 0.4), ("c", 0.5), ("d", 0.6)]):
        training.log_run(spark, root, run, f"{root}/{run}", {"fraud_f1_score": score}, at=dt.datetime(2024, 1, 1, 0, minute))
        outcomes.append(training.promote(spark, root))
    assert outcomes == [True, False, False, True]
    assert training.latest_run(training.read_runs(spark, root), "PROMOTED").first().run == "d"


def test_latest_run_ignores_unfinished_ones(spark):
    root = workspace.new_path(spark, "registry-test")
    training.log_run(spark, root, "done", "p", {"f1_score": 0.5, "auprc": 0.1}, at=dt.datetime(2024, 1, 1))
    training.log_run(spark, root, "late", "p", {"f1_score": 0.9}, status="RUNNING", at=dt.datetime(2024, 1, 2))
    latest = training.latest_run(training.read_runs(spark, root)).collect()
    assert {(r.run, r.metric, r.value) for r in latest} == {("done", "f1_score", 0.5), ("done", "auprc", 0.1)}


def test_retrain_job(spark, history):
    root = workspace.new_path(spark, "registry-test")
    assert jobs.retrain(spark, history, root, "week-1", trees=3, depth=3) is True
    assert jobs.retrain(spark, history, root, "week-2", trees=3, depth=3) is False
    assert training.champion_model(spark, root) is not None
    with pytest.raises(RuntimeError, match="history_present"):
        jobs.retrain(spark, history.limit(0), root, "week-3")


def test_residual_model(spark, history):
    rows = labelled_residual(history)
    counts = rule_confusion(history).first()
    assert rows.where("isFraud = 1").count() == counts.missed_fraud
    model = training.train_residual(history, trees=3, depth=3)
    assert training.importance(model, ["step", "amount", "a", "b", "c", "d"]).count() == 6


def test_full_totals(tx):
    rows = {(r.kind, r["name"]): (r.n, r.percent) for r in full_totals(tx({"isFraud": 1}, {}, {"type": "DEBIT"}, {})).collect()}
    assert rows[("label", "1")] == (1, 25.0) and rows[("type", "DEBIT")] == (1, 25.0) and rows[("rows", "all")] == (4, 100.0)


def test_average_path():
    assert anomaly.average_path(1) == 0 and anomaly.average_path(2) == 1
    assert float(anomaly.average_path(256)) == pytest.approx(10.244, abs=0.01)


def test_isolation_forest_finds_outliers(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"x": rng.normal(0, 1, 2000), "y": rng.normal(0, 1, 2000)})
    frame.loc[:19, ["x", "y"]] = rng.choice([-1, 1], (20, 2)) * rng.uniform(8, 12, (20, 2))
    frame["tx_id"] = np.arange(2000)
    rows = spark.createDataFrame(frame)
    forest = anomaly.grow_forest(rows, ["x", "y"], ["tx_id"], trees=50, subsample=128)
    sizes = forest.where("node = 0").select("size").collect()
    assert len(sizes) == 50 and all(s.size <= 128 for s in sizes)
    scored = workspace.write_table(
        anomaly.anomaly_scores(rows, forest, ["x", "y"]), workspace.new_path(spark, "scores-test"))
    flagged = {r.tx_id for r in anomaly.flag_anomalies(scored, 0.01).where("is_anomaly = 1").collect()}
    assert len(flagged) == 20 and len(flagged & set(range(20))) >= 18
    again = anomaly.grow_forest(rows.repartition(5), ["x", "y"], ["tx_id"], trees=50, subsample=128)
    assert forest.exceptAll(again).isEmpty()


def test_split_column(spark):
    assert split_by_id(spark.range(10).withColumnRenamed("id", "tx_id"), "tx_id").where("split = 'test'").count() == 2


def test_stream_with_model_equals_batch(spark, history):
    root = workspace.new_path(spark, "registry-test")
    jobs.retrain(spark, history, root, "week-1", trees=3, depth=3)
    blacklist.publish(blacklist.build(history, 360), f"{root}/blacklist")
    messages.envelopes(history).select("value").write.text(f"{root}/topic")
    sinks = streaming.lake_sinks(spark, root, with_model=True)
    streaming.run_to_end(streaming.start_detection(
        text_stream(spark, f"{root}/topic"), f"{root}/blacklist", sinks, f"{root}/checkpoint", once=True, registry=root))
    columns = [c for c in SCORED_SCHEMA.names if c != "ingested_at"]
    stored = sinks.transactions.read().select(columns)
    expected = detection.detect_with_model(
        history, blacklist.read(spark, f"{root}/blacklist"), training.champion_model(spark, root)).select(columns)
    assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty()


def test_stream_without_a_promoted_model_stops(spark):
    root = workspace.new_path(spark, "registry-test")
    with pytest.raises(ValueError, match="no promoted model"):
        streaming.pinned(spark, f"{root}/work", 0, f"{root}/blacklist", root)


def test_history_with_missing_values_trains_and_scores(spark, history):
    holes = history.withColumn("oldbalanceOrg", F.when(F.col("tx_id") % 3 > 0, F.col("oldbalanceOrg"))).withColumn(
        "amount", F.when(F.col("tx_id") % 11 > 0, F.col("amount")).otherwise(F.lit(float("nan"))))
    model, values = training.train(holes, trees=3, depth=3)
    assert 0 <= values["fraud_f1_score"] <= 1
    assert detection.score(holes, model).where("ml_probability IS NULL").isEmpty()


def test_split_without_an_id_does_not_depend_on_partitions(history):
    rows = history.drop("tx_id")
    one, two = (training.split(r)[0].count() for r in (rows.repartition(1), rows.repartition(7)))
    assert one == two and 0.7 < one / rows.count() < 0.9


def isolation_by_hand(sample, columns, depth, seed, rows):
    """Every tree grown and walked row by row, from the definition."""
    def average(n):
        return 2 * (np.log(n - 1) + anomaly.EULER_GAMMA) - 2 * (n - 1) / n if n > 2 else float(n == 2)

    def path(tree, node, part, level, row):
        varying = [c for c in columns if len({p[c] for p in part}) > 1]
        if level == depth or len(part) < 2 or not varying:
            return level + average(len(part))
        column = varying[int(anomaly.draw(seed, tree, node, "column") * len(varying))]
        low, high = min(p[column] for p in part), max(p[column] for p in part)
        cut = low + anomaly.draw(seed, tree, node, "cut") * (high - low)
        left = row[column] <= cut
        return path(tree, 2 * node + (1 if left else 2), [p for p in part if (p[column] <= cut) == left], level + 1, row)

    typical = np.mean([average(len(part)) for part in sample.values()])
    return [2 ** (-np.mean([path(tree, 0, part, 0, row) for tree, part in sample.items()]) / typical) for row in rows]


def test_isolation_forest_like_by_hand(spark):
    """Splits follow from seed, tree and node, so a restatement on the same samples gives the same scores."""
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"id": range(400), "x": rng.normal(0, 1, 400).round(2), "y": rng.integers(0, 4, 400).astype(float), "z": 7.0})
    frame.loc[:2, "x"] = [50.0, -60.0, 40.0]
    rows, columns = spark.createDataFrame(frame), ["x", "y", "z"]
    forest = anomaly.grow_forest(rows.repartition(5), columns, ["id"], trees=7, subsample=32, seed=3)
    found = {r.id: r.anomaly_score for r in anomaly.anomaly_scores(rows, forest, columns, 32).collect()}
    # The samples, dealt in the order of the hashes.
    order = sample_rows(rows, 7 * 32, ["id"], 3).withColumn("h", hash_order(3, "id")).orderBy("h", "id").collect()
    sample = {t: [r.asDict() for i, r in enumerate(order) if i % 7 == t] for t in range(7)}
    expected = isolation_by_hand(sample, columns, 5, 3, [r.asDict() for r in rows.orderBy("id").collect()])
    assert [found[i] for i in range(400)] == pytest.approx(expected)


def test_fitting_takes_all_cores(history, monkeypatch):
    """A file of one row group, or rows of few bytes, are dealt out: a pass costs by rows and trees."""
    cores = history.sparkSession.sparkContext.defaultParallelism
    assert history.rdd.getNumPartitions() < cores
    assert training.stored_rows(history).rdd.getNumPartitions() >= cores
    monkeypatch.setattr(training.Pipeline, "fit", lambda _, rows: rows)
    assert training.train_residual(history).rdd.getNumPartitions() >= cores


def test_kept_nodes_grow_the_same_trees(history):
    """Levels don't walk the trees from the root for every row; the forest is the one that they would grow."""
    rows = training.stored_rows(history)
    kept, walked = training.pipeline(6, 6), training.pipeline(6, 6)
    forest = walked.getStages()[-1]
    assert forest.getCacheNodeIds()
    forest.setCacheNodeIds(False)
    assert kept.fit(rows).stages[-1].toDebugString.split("\n")[1:] == walked.fit(rows).stages[-1].toDebugString.split("\n")[1:]
