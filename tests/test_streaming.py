"""The detection stream: equal to batch, one copy after a retry, no gap after a restart."""

import json
import threading

import pytest
from conftest import accounts
from pyspark.sql import functions as F

from txguard import workspace
from txguard.catalog import base
from txguard.plans import blacklist
from txguard.plans.detection import detect
from txguard.schema import DETECTION_COLUMNS, TX_COLUMNS
from txguard.sources import messages
from txguard.sources.lake import LakeTable
from txguard.sources.transactions import dead_letters, decode, from_events, readable, text_stream
from txguard.streaming import detection, windows

FOLDER = "/root/testdata/sf0.001"
COMPARED = [*TX_COLUMNS, *DETECTION_COLUMNS]


@pytest.fixture
def topic(spark):
    path = workspace.new_path(spark, "topic-test")

    def send(*values):
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(path)

    send.path = path
    return send


@pytest.fixture
def run(spark, topic):
    root = workspace.new_path(spark, "detection-test")
    listed = f"{root}/blacklist"

    def go(sinks=None, report=None, names=("B",)):
        if not blacklist.versions(spark, listed):
            blacklist.publish(accounts(spark, *names), listed)
        detection.run_to_end(detection.start_detection(
            text_stream(spark, topic.path, 1), listed, sinks or detection.lake_sinks(spark, root),
            f"{root}/checkpoint", once=True, report=report))

    go.root, go.listed = root, listed
    return go


def message(**fields):
    record = {"step": 1, "type": "TRANSFER", "amount": 10.0, "nameOrig": "A", "oldbalanceOrg": 10.0, "newbalanceOrig": 0.0,
              "nameDest": "C", "oldbalanceDest": 0.0, "newbalanceDest": 10.0, "isFraud": 0, "isFlaggedFraud": 0}
    return json.dumps({**record, **fields})


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stream_equals_batch(spark):
    root = workspace.new_path(spark, "detection-test")
    rows = from_events(spark.read.parquet(f"{FOLDER}/events.parquet"))
    messages.envelopes(rows.repartition(5)).select("value").write.text(f"{root}/topic")
    counts = {}
    detection.run_to_end(detection.start_detection(
        text_stream(spark, f"{root}/topic", 2), base.blacklist_path(spark, FOLDER), detection.lake_sinks(spark, root),
        f"{root}/checkpoint", once=True, report=counts.__setitem__))
    expected = detect(rows, base.blacklist(spark, FOLDER)).select(COMPARED)
    stored = LakeTable(spark, f"{root}/transactions").read()
    assert same_rows(stored.select(COMPARED), expected)
    fraud = LakeTable(spark, f"{root}/fraud_transactions").read().select(COMPARED)
    assert same_rows(fraud, expected.where("is_fraud_detected = 1"))
    assert len(counts) == 3 and sum(c["rows"] for c in counts.values()) == expected.count()
    assert stored.groupBy("batch_id").agg(F.count_distinct("ingested_at").alias("n")).where("n <> 1").isEmpty()


def test_alert_has_the_eight_fields(spark, topic, run):
    topic(message(nameOrig="A"), message(nameOrig="B", type="PAYMENT"), message(nameOrig="C", type="PAYMENT"))
    run()
    sent = {r.key: json.loads(r.value) for r in spark.read.json(f"{run.root}/alerts/*").collect()}
    assert set(sent) == {"A", "B"}
    assert list(sent["A"]) == ["nameOrig", "nameDest", "amount", "type", "is_fraud_detected", "blacklist_flag",
                               "rule_fraud_flag", "ingested_at"]
    assert (sent["A"]["rule_fraud_flag"], sent["A"]["blacklist_flag"]) == (1, 0)
    assert (sent["B"]["rule_fraud_flag"], sent["B"]["blacklist_flag"]) == (0, 1)


def test_bad_messages_are_set_aside(spark, topic, run):
    topic(message(), "no json", "[1, 2]", '{"k": 1}', message(amount="ten"), message(amount=-1.0))
    run()
    stored = LakeTable(spark, f"{run.root}/transactions").read()
    aside = LakeTable(spark, f"{run.root}/quarantine").read()
    assert stored.count() == 1 and aside.count() == 5
    assert aside.where("failed_rules = 'unreadable'").count() == 3
    assert aside.where("failed_rules = 'amount_not_negative'").count() == 1


def test_a_failed_batch_is_repeated_without_copies(spark, topic, run):
    """The last sink fails once, after the others have written; the restart repeats the batch."""
    topic(message(), message(nameOrig="B"))
    seen = []

    def flaky(rows, batch_id):
        seen.append(batch_id)
        if len(seen) == 1:
            raise RuntimeError("sink is down")

    sinks = detection.lake_sinks(spark, run.root)
    sinks.extra = [flaky]
    with pytest.raises(Exception, match="sink is down"):
        run(sinks)
    run(sinks)
    assert seen == [0, 0]
    for name in ("transactions", "fraud_transactions"):
        assert LakeTable(spark, f"{run.root}/{name}").read().count() == 2
    assert spark.read.json(f"{run.root}/alerts/*").count() == 2


def test_restart_goes_on_without_a_gap(spark, topic, run):
    topic(message(step=1))
    run()
    topic(message(step=2), message(step=3))
    run()
    run()
    assert sorted(r.step for r in LakeTable(spark, f"{run.root}/transactions").read().collect()) == [1, 2, 3]


def test_service_mode_ends_between_batches(spark, topic, run):
    """Asked to stop while it runs, the service has finished what it took; a failure is raised."""
    blacklist.publish(accounts(spark, "B"), run.listed)
    topic(message(step=1))
    stopped, seen = threading.Event(), []

    def report(batch_id, size):
        seen.append(size)
        if len(seen) < 2:
            topic(message(step=2), message(step=3))
        else:
            stopped.set()

    query = detection.start_detection(
        text_stream(spark, topic.path), run.listed, detection.lake_sinks(spark, run.root), f"{run.root}/checkpoint",
        interval="100 milliseconds", report=report)
    detection.serve(query, stopped, 0.2)
    assert not query.isActive and [s["rows"] for s in seen] == [1, 2]
    assert sorted(r.step for r in LakeTable(spark, f"{run.root}/transactions").read().collect()) == [1, 2, 3]
    failing = detection.lake_sinks(spark, run.root)
    failing.extra = [lambda rows, batch_id: 1 / 0]
    topic(message(step=4))
    query = detection.start_detection(text_stream(spark, topic.path), run.listed, failing, f"{run.root}/checkpoint")
    with pytest.raises(Exception, match="division by zero"):
        detection.serve(query, threading.Event(), 0.2)


def test_a_refreshed_blacklist_is_seen_by_the_next_batch(spark, topic, run):
    topic(message(type="DEBIT", nameOrig="N", step=1))
    run()
    blacklist.publish(accounts(spark, "N"), run.listed)
    topic(message(type="DEBIT", nameOrig="N", step=2))
    run()
    flags = {r.step: r.blacklist_flag for r in LakeTable(spark, f"{run.root}/transactions").read().collect()}
    assert flags == {1: 0, 2: 1}


def test_a_retry_keeps_the_list_of_its_first_attempt(spark, topic, run):
    """The list changes between the attempts, and what had alerts must have none that no verdict stands behind."""
    topic(message(nameOrig="A", type="PAYMENT"), message(nameOrig="B", type="PAYMENT"))
    calls = []

    def flaky(rows, batch_id):
        calls.append(sorted(r.nameOrig for r in rows.where("is_fraud_detected = 1").collect()))
        if len(calls) == 1:
            blacklist.publish(accounts(spark, "Z"), run.listed)
            raise RuntimeError("sink is down")

    sinks = detection.lake_sinks(spark, run.root)
    sinks.extra = [flaky]
    with pytest.raises(Exception, match="sink is down"):
        run(sinks, names=("A",))
    run(sinks)
    assert calls == [["A"], ["A"]]
    verdicts = {r.nameOrig: r.is_fraud_detected for r in LakeTable(spark, f"{run.root}/transactions").read().collect()}
    assert verdicts == {"A": 1, "B": 0}
    assert [r.nameOrig for r in sinks.fraud.read().collect()] == ["A"]
    assert [r.key for r in spark.read.json(f"{run.root}/alerts/*").collect()] == ["A"]


def test_a_retry_that_turns_empty_leaves_nothing(spark, topic, run):
    topic(message(nameOrig="A", type="PAYMENT"))
    sinks, root = detection.lake_sinks(spark, run.root), run.root
    rows = detection.stamped(spark.createDataFrame([(message(nameOrig="A", type="PAYMENT"),)], "value string"))
    for names in (["A"], ["Z"]):
        blacklist.publish(accounts(spark, *names), run.listed)
        if names == ["Z"]:  # as if the first attempt had been judged by another list
            spark.createDataFrame([(blacklist.newest(spark, run.listed), None)], detection.PIN).coalesce(1).write.mode(
                "overwrite").parquet(f"{root}/work/pins/batch_id=0")
        detection.batch_writer(spark, run.listed, sinks)(rows, 0)
    assert sinks.transactions.read().count() == 1 and sinks.fraud.read().isEmpty()
    assert spark.read.schema("key string, value string").json(f"{root}/alerts/*").isEmpty()


def test_batch_without_fraud_skips_the_fraud_sinks(spark, topic, run):
    topic(message(type="PAYMENT"))
    counts, calls = {}, []
    sinks = detection.lake_sinks(spark, run.root)
    sinks.alert = lambda rows, batch_id: calls.append(batch_id)
    run(sinks, counts.__setitem__)
    assert counts == {0: {"rows": 1, "fraud": 0, "quarantined": 0}} and calls == []


def test_decode_keeps_whole_bad_texts(spark):
    long_text = "x" * 100_000
    rows = spark.createDataFrame([(1, message()), (2, long_text), (3, ""), (4, None)], "offset int, value string")
    decoded = decode(rows, keep=["offset"])
    assert [r.offset for r in readable(decoded).collect()] == [1, 4]
    assert {r.offset: r._corrupt_record for r in dead_letters(decoded).collect()} == {2: long_text, 3: ""}


def test_windows_over_several_batches(spark):
    """Three batches, the last with the oldest events: none comes too late."""
    root = workspace.new_path(spark, "windows-test")
    rows = spark.range(600).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 10).cast("timestamp_ntz").alias("ingested_at"),
        (F.col("id") % 4 == 0).cast("int").alias("is_fraud_detected"), "id")
    table = LakeTable(spark, f"{root}/counts")
    for part in (1, 2, 0):
        chunk = rows.where(F.floor(F.col("id") / 200) == part).drop("id")
        chunk.coalesce(1).write.mode("append").parquet(f"{root}/rows")
        stream = spark.readStream.schema(chunk.schema).parquet(f"{root}/rows")
        detection.run_to_end(windows.start_counts(
            stream, table, f"{root}/checkpoint", once=True))
    found = windows.latest_counts(table)
    totals = found.agg(F.count("*").alias("windows"), F.sum("total").alias("total"), F.sum("fraud").alias("fraud")).first()
    assert (totals.windows, totals.total, totals.fraud) == (100, 600, 150)
    hours = windows.sliding_counts(found, 60)
    assert hours.count() == 100 + 59 and hours.agg(F.max("total")).first()[0] == 360
    assert hours.agg(F.sum("total")).first()[0] == 600 * 60
