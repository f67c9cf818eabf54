"""The detection stream: one query reads the source once and feeds every sink.

A batch is judged by the blacklist version and the model that its first attempt has recorded, so a retry after a refresh
gives the same verdicts. Each sink is idempotent by ``batch_id``: the lake tables and the alert files replace the batch's
folder, also with nothing, and the relational table adds only records that an earlier attempt did not commit. A retried
batch therefore leaves one copy in agreement with all other sinks, and a restart goes on from the checkpoint.
"""

from __future__ import annotations

import signal
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from txguard import workspace
from txguard.operators.quality import check, quarantined_rows, table_rules, valid_rows
from txguard.plans import blacklist as blacklists
from txguard.plans import training
from txguard.plans.detection import detect, detect_with_model
from txguard.schema import DETECTED_SCHEMA, SCORED_SCHEMA, TX_SCHEMA
from txguard.sources import files, jdbc, messages
from txguard.sources.lake import DeltaTable, LakeTable, table_kind
from txguard.sources.transactions import CORRUPT, decode

BatchSink = Callable[[DataFrame, int], None]
PIN = "version int, model string"
RAW_SCHEMA = T.StructType([*TX_SCHEMA.fields, T.StructField(CORRUPT, T.StringType()), T.StructField("ingested_at", T.TimestampType())])
QUARANTINE_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("failed_rules", T.ArrayType(T.StringType()))])


@dataclass
class Sinks:
    """Where a batch goes. ``alert`` and ``extra`` take ``(rows, batch_id)`` and must tolerate a repeat.

    ``work`` is a folder for what belongs to a batch in flight: what it is judged by, and its judged rows.
    """

    transactions: LakeTable | DeltaTable
    work: str
    fraud: LakeTable | DeltaTable | None = None
    quarantine: LakeTable | DeltaTable | None = None
    alert: BatchSink | None = None
    extra: list[BatchSink] = field(default_factory=list)


def lake_tables(spark: SparkSession, root: str, with_model: bool = False, kind: str = "parquet") -> list[LakeTable | DeltaTable]:
    """The tables of all rows, of flagged rows and of unreadable rows."""
    table, schema = table_kind(spark, kind), SCORED_SCHEMA if with_model else DETECTED_SCHEMA
    return [
        table(spark, f"{root}/transactions", ["type"], schema), table(spark, f"{root}/fraud_transactions", schema=schema),
        table(spark, f"{root}/quarantine", schema=QUARANTINE_SCHEMA)]


def lake_sinks(spark: SparkSession, root: str, with_model: bool = False, kind: str = "parquet") -> Sinks:
    """All and flagged rows as lake tables, unreadable rows in quarantine, alerts as JSON files."""
    transactions, fraud, quarantine = lake_tables(spark, root, with_model, kind)
    return Sinks(
        transactions=transactions,
        work=f"{root}/work",
        fraud=fraud,
        quarantine=quarantine,
        alert=lambda rows, batch_id: messages.publish_files(rows, f"{root}/alerts/batch_id={batch_id}"),
    )


def relational_sinks(url: str, schema: str, **options: str) -> list[BatchSink]:
    """All and flagged rows as tables of a relational store, for ``Sinks.extra``."""
    def write_all(rows: DataFrame, batch_id: int) -> None:
        jdbc.append_batch(rows, batch_id, url, f"{schema}.transactions", **options)

    def write_fraud(rows: DataFrame, batch_id: int) -> None:
        jdbc.append_batch(
            rows.where("is_fraud_detected = 1"), batch_id, url, f"{schema}.fraud_transactions", **options)

    return [write_all, write_fraud]


class Models:
    """Loads models by path and keeps the last one."""

    def __init__(self):
        self.path, self.model = None, None

    def load(self, path: str) -> PipelineModel:
        if path != self.path:
            self.path, self.model = path, PipelineModel.load(path)
        return self.model


def pinned(spark: SparkSession, work: str, batch_id: int, blacklist_path: str, registry: str | None) -> tuple[int, str | None, bool]:
    """Blacklist version and model path of a batch, recorded by its first attempt; and whether this is a retry."""
    path = f"{work}/pins/batch_id={int(batch_id)}"
    if files.exists(spark, f"{path}/_SUCCESS"):
        row = spark.read.schema(PIN).parquet(path).first()
        return row["version"], row["model"], True
    model = training.champion_path(spark, registry) if registry else None
    if registry and model is None:
        raise ValueError(f"no promoted model in {registry}")
    version = blacklists.newest(spark, blacklist_path)
    files.remove(spark, f"{work}/pins/batch_id={int(batch_id) - 2}")  # two batches back nothing can be repeated
    spark.createDataFrame([(version, model)], PIN).coalesce(1).write.mode("overwrite").parquet(path)
    return version, model, False


def stamped(source: DataFrame) -> DataFrame:
    """Decoded messages with the ingest time.

    The time belongs to the streaming plan, where it is the batch's recorded time: a retry gets the
    same one, and all sinks share it.
    """
    return decode(source).withColumn("ingested_at", F.current_timestamp())


def batch_writer(spark: SparkSession, blacklist_path: str, sinks: Sinks, *, registry: str | None = None,
                 report: Callable[[int, dict], None] | None = None) -> Callable[[DataFrame, int], None]:
    """The work on one micro-batch: detect against the recorded blacklist (and model), quarantine, write each sink."""
    models = Models()

    def write(batch: DataFrame, batch_id: int) -> None:
        version, model, retried = pinned(spark, sinks.work, batch_id, blacklist_path, registry)
        blacklist = blacklists.read(spark, blacklist_path, version)
        found = detect_with_model(batch, blacklist, models.load(model)) if model else detect(batch, blacklist)
        unreadable = F.col(CORRUPT).isNotNull()
        judged = check(found, table_rules()).withColumn(
            "failed_rules", F.when(unreadable, F.array(F.lit("unreadable"))).otherwise(F.col("failed_rules")))
        # Stored once for all sinks, in the folder that executors share, for as long as the batch takes.
        stage = f"{sinks.work}/judged/batch_id={int(batch_id)}"
        judged = workspace.write_table(judged, stage)
        valid = F.size("failed_rules") == 0
        # Not an Observation: once a session has one, models fitted in it cannot be sent to tasks any more.
        size = judged.agg(
            F.count_if(valid).alias("rows"), F.count_if(~valid).alias("quarantined"),
            F.count_if(valid & (F.col("is_fraud_detected") == 1)).alias("fraud")).first().asDict()
        detected = valid_rows(judged).drop(CORRUPT)
        flagged = detected.where("is_fraud_detected = 1")
        sinks.transactions.append(detected, batch_id)
        # A first attempt with nothing for a sink skips it; a retry writes even nothing over what may be there.
        if size["fraud"] or retried:
            if sinks.fraud:
                sinks.fraud.append(flagged, batch_id)
            if sinks.alert:
                sinks.alert(messages.alerts(flagged), batch_id)
        if (size["quarantined"] or retried) and sinks.quarantine:
            sinks.quarantine.append(quarantined_rows(judged).select(*batch.columns, "failed_rules"), batch_id)
        if size["rows"] or retried:
            for sink in sinks.extra:
                sink(detected, batch_id)
        if report:
            report(batch_id, size)
        files.remove(spark, stage)

    return write


def start_detection(source: DataFrame, blacklist_path: str, sinks: Sinks, checkpoint: str, *, once: bool = False,
                    registry: str | None = None, interval: str | None = None,
                    report: Callable[[int, dict], None] | None = None) -> StreamingQuery:
    """Start the query; ``once`` works off what is there and stops, else it runs until stopped, a batch every ``interval``.

    With a model ``registry`` the promoted model is the third layer of the verdict.
    """
    work = batch_writer(source.sparkSession, blacklist_path, sinks, registry=registry, report=report)
    writer = (
        stamped(source).writeStream.foreachBatch(work)
        .outputMode("append").option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def serve(query: StreamingQuery, stopped: threading.Event | None = None, poll_seconds: float = 1.0) -> None:
    """Service mode: wait until the query ends or ``stopped`` is set, and then stop between two batches.

    A batch in work is finished first, so that its sinks need no repeat. Raises what ended the query, if it failed.
    """
    stopped = stopped or threading.Event()
    while not query.awaitTermination(poll_seconds):
        if stopped.is_set() and not query.status["isTriggerActive"]:
            query.stop()
    if query.exception():
        raise query.exception()


def stop_on_signals() -> threading.Event:
    """An event that a request to end the process sets, for ``serve``."""
    stopped = threading.Event()
    for name in (signal.SIGTERM, signal.SIGINT):
        signal.signal(name, lambda *_: stopped.set())
    return stopped
