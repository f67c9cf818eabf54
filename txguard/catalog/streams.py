"""Streaming queries: each works off a folder of messages made from the tables and returns what its sinks hold."""

from __future__ import annotations

import functools

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.catalog.analytics import LIMITER_BY_RECEIVER
from txguard.catalog.base import (
    BLACKLIST, DETECTED, TX, blacklist_path, detected, on_detected, on_transactions, query, transactions)
from txguard.plans import blacklist as blacklists
from txguard.schema import ALERT_COLUMNS, DETECTION_COLUMNS, TX_COLUMNS
from txguard.sources import files, jdbc, messages
from txguard.sources.lake import LakeTable
from txguard.sources.transactions import text_stream
from txguard.streaming import detection, limiter, windows

_FIELDS = ", ".join(TX_COLUMNS)
_VERDICTS = ", ".join(DETECTION_COLUMNS)
PARTS = 4  # subfolders, so that even a small table comes in several files


def topic(spark, folder, name: str = "topic") -> str:
    """A folder of message files; every file has messages of all times."""
    path = workspace.new_path(spark, name)
    sent = messages.envelopes(transactions(spark, folder)).select("value")
    sent = sent.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(PARTS)))
    sent.hint("rebalance", F.col("part")).write.partitionBy("part").text(path)
    return path


def _run(spark, folder) -> tuple[str, detection.Sinks]:
    """Work off the topic with all sinks; returns the root of their tables and the sinks."""
    root = workspace.new_path(spark, "detection")
    sinks = detection.lake_sinks(spark, root)
    source = text_stream(spark, topic(spark, folder), files_per_trigger=2).select("value")
    detection.run_to_end(detection.start_detection(
        source, blacklist_path(spark, folder), sinks, f"{root}/checkpoint", once=True))
    return root, sinks


@query("stream_ingest", on_transactions(f"SELECT {_FIELDS}, TRUE AS stamped FROM tx"))
def stream_ingest(spark, folder):
    """Messages decoded, stamped and stored."""
    root = workspace.new_path(spark, "ingest")
    table = LakeTable(spark, f"{root}/rows")
    source = detection.stamped(text_stream(spark, topic(spark, folder), files_per_trigger=2).select("value"))
    detection.run_to_end(
        source.writeStream.foreachBatch(table.append).option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start())
    return table.read().select(*TX_COLUMNS, F.col("ingested_at").isNotNull().alias("stamped"))


@query("stream_detect", on_detected(f"SELECT {_FIELDS}, {_VERDICTS} FROM det"))
def stream_detect(spark, folder):
    _, sinks = _run(spark, folder)
    return sinks.transactions.read().select(*TX_COLUMNS, *DETECTION_COLUMNS)


@query("stream_dual_write", on_detected("""SELECT 'transactions' AS store, type, COUNT(*) AS n FROM det GROUP BY type
UNION ALL SELECT 'fraud_transactions', type, COUNT(*) FROM fraud GROUP BY type"""))
def stream_dual_write(spark, folder):
    """Rows per type in both tables one query has filled."""
    _, sinks = _run(spark, folder)
    counts = [
        table.read().groupBy("type").agg(F.count("*").alias("n")).select(F.lit(store).alias("store"), "type", "n")
        for store, table in (("transactions", sinks.transactions), ("fraud_transactions", sinks.fraud))]
    return counts[0].unionByName(counts[1])


@query("stream_batch_counts", f"""WITH {TX}, {BLACKLIST}, {DETECTED}
SELECT 'rows' AS counted, COUNT(*) AS n FROM det UNION ALL SELECT 'fraud', COUNT(*) FROM fraud
UNION ALL SELECT 'quarantined', COUNT(*) FROM documents""")
def stream_batch_counts(spark, folder):
    """What the batches report, added up; texts that are no messages are set aside."""
    root, said = workspace.new_path(spark, "detection"), []
    sent = topic(spark, folder)
    spark.read.parquet(f"{folder}/documents.parquet").select(F.concat(F.lit("no message: "), F.regexp_replace(
        F.coalesce("text", F.lit("")), r"[\r\n]+", " ")).alias("value")).write.mode("append").text(f"{sent}/part=prose")
    detection.run_to_end(detection.start_detection(
        text_stream(spark, sent, files_per_trigger=2).select("value"), blacklist_path(spark, folder), detection.lake_sinks(spark, root),
        f"{root}/checkpoint", once=True, report=lambda batch_id, counts: said.append((batch_id, *(int(counts[k]) for k in ("rows", "fraud", "quarantined"))))))
    told = spark.createDataFrame(said, "batch_id long, rows long, fraud long, quarantined long")
    return told.unpivot("batch_id", ["rows", "fraud", "quarantined"], "counted", "n").groupBy("counted").agg(F.sum("n").alias("n"))


@query("stream_fraud_sink", on_detected(f"SELECT {_FIELDS}, {_VERDICTS} FROM fraud"))
def stream_fraud_sink(spark, folder):
    _, sinks = _run(spark, folder)
    return sinks.fraud.read().select(*TX_COLUMNS, *DETECTION_COLUMNS)


@query("stream_alerts", on_detected("SELECT nameOrig AS key, nameOrig, nameDest, amount, type, is_fraud_detected, "
                                    "blacklist_flag, rule_fraud_flag FROM fraud"))
def stream_alerts(spark, folder):
    """The alert messages, opened again."""
    schema = ("nameOrig string, nameDest string, amount double, type string, is_fraud_detected int, "
              "blacklist_flag int, rule_fraud_flag int")
    root, _ = _run(spark, folder)
    sent = spark.read.schema("key string, value string").json(f"{root}/alerts/*")
    return sent.select("key", F.from_json("value", schema).alias("alert")).select(
        "key", *[f"alert.{c}" for c in ALERT_COLUMNS if c != "ingested_at"])


@query("stream_blacklist_refresh", f"""WITH {TX},
early AS (SELECT DISTINCT nameOrig AS account FROM tx WHERE isFraud = 1 AND step <= 180),
late AS (SELECT DISTINCT nameOrig AS account FROM tx WHERE isFraud = 1 AND step <= 360)
SELECT {_FIELDS}, CASE WHEN nameOrig IN (SELECT account FROM early) THEN 1 ELSE 0 END AS blacklist_flag FROM tx WHERE step <= 360
UNION ALL
SELECT {_FIELDS}, CASE WHEN nameOrig IN (SELECT account FROM late) THEN 1 ELSE 0 END FROM tx WHERE step > 360""")
def stream_blacklist_refresh(spark, folder):
    """The list is replaced between two runs of one query; later batches see the new one."""
    tx = transactions(spark, folder)
    root, sent, listed = (workspace.new_path(spark, n) for n in ("detection", "topic", "blacklist"))
    sinks = detection.lake_sinks(spark, root)
    for part, until in ((tx.where("step <= 360"), 180), (tx.where("step > 360"), 360)):
        blacklists.publish(blacklists.build(tx, until), listed)
        messages.envelopes(part).select("value").write.mode("append").text(sent)
        detection.run_to_end(detection.start_detection(
            text_stream(spark, sent), listed, sinks, f"{root}/checkpoint", once=True))
    return sinks.transactions.read().select(*TX_COLUMNS, "blacklist_flag")


def _minutes(spark, folder):
    """Counts per minute of the detected rows, read as a stream of files that each hold rows of all times."""
    root = workspace.new_path(spark, "minutes")
    rows = detected(spark, folder).select("ingested_at", "is_fraud_detected", F.pmod(F.col("tx_id"), F.lit(PARTS)).alias("part"))
    rows.hint("rebalance", F.col("part")).write.partitionBy("part").parquet(f"{root}/rows")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/rows")
    table = LakeTable(spark, f"{root}/counts")
    detection.run_to_end(windows.start_counts(stream, table, f"{root}/checkpoint", once=True))
    return windows.latest_counts(table)


def _zoneless(counts):
    return counts.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("stream_minute_counts", on_detected("""SELECT date_trunc('minute', ingested_at) AS start,
  date_trunc('minute', ingested_at) + INTERVAL 1 MINUTE AS "end", COUNT(*) AS total,
  CAST(SUM(is_fraud_detected) AS BIGINT) AS fraud FROM det GROUP BY 1"""))
def stream_minute_counts(spark, folder):
    return _zoneless(_minutes(spark, folder))


def _sliding(hours: int) -> str:
    return f"""SELECT start, start + INTERVAL {hours} HOUR AS "end", COUNT(*) AS total, CAST(SUM(is_fraud_detected) AS BIGINT) AS fraud
FROM (SELECT date_trunc('minute', ingested_at) - to_minutes(UNNEST(range(0, {60 * hours}))) AS start, is_fraud_detected FROM det) GROUP BY 1"""


@query("stream_sliding_1h", on_detected(_sliding(1)))
def stream_sliding_1h(spark, folder):
    return _zoneless(windows.sliding_counts(_minutes(spark, folder), 60))


@query("stream_sliding_2h", on_detected(_sliding(2)))
def stream_sliding_2h(spark, folder):
    return _zoneless(windows.sliding_counts(_minutes(spark, folder), 120))


@query("stream_sliding_3h", on_detected(_sliding(3)))
def stream_sliding_3h(spark, folder):
    return _zoneless(windows.sliding_counts(_minutes(spark, folder), 180))


_EARLY = "bl AS (SELECT DISTINCT nameOrig AS account FROM tx WHERE isFraud = 1 AND step <= 180)"


@query("stream_retry_refresh", f"""WITH {TX}, {_EARLY}, {DETECTED}
SELECT 'transactions' AS store, type, nameOrig, is_fraud_detected, COUNT(*) AS n FROM det GROUP BY ALL
UNION ALL SELECT 'fraud_transactions', type, nameOrig, is_fraud_detected, COUNT(*) FROM fraud GROUP BY ALL
UNION ALL SELECT 'alerts', type, nameOrig, is_fraud_detected, COUNT(*) FROM fraud GROUP BY ALL
UNION ALL SELECT 'relational', type, nameOrig, is_fraud_detected, COUNT(*) FROM det GROUP BY ALL""")
def stream_retry_refresh(spark, folder):
    """The last sink fails, the blacklist is replaced, the batch is repeated: every sink keeps the verdicts of its first attempt."""
    tx, root, listed = transactions(spark, folder), workspace.new_path(spark, "detection"), workspace.new_path(spark, "blacklist")
    blacklists.publish(blacklists.build(tx, 180), listed)
    sinks, failures = detection.lake_sinks(spark, root), ["the store is down"]

    def relational(rows, batch_id):
        committed = spark.read.parquet(f"{root}/store") if not failures else None
        rest = jdbc.rows_to_write(rows, batch_id, committed)
        if failures:
            rest.where("type = 'TRANSFER'").write.parquet(f"{root}/store")
            raise RuntimeError(failures.pop())
        rest.write.mode("append").parquet(f"{root}/store")

    sinks.extra = [relational]
    source = text_stream(spark, topic(spark, folder)).select("value")
    try:
        detection.run_to_end(detection.start_detection(source, listed, sinks, f"{root}/checkpoint", once=True))
    except StreamingQueryException:
        blacklists.publish(blacklists.build(tx, 360), listed)
    detection.run_to_end(detection.start_detection(source, listed, sinks, f"{root}/checkpoint", once=True))
    alert = spark.read.schema("key string, value string").json(f"{root}/alerts/*").select(
        F.from_json("value", "type string, nameOrig string, is_fraud_detected int").alias("a")).select("a.*")
    stores = {"transactions": sinks.transactions.read(), "fraud_transactions": sinks.fraud.read(), "alerts": alert,
              "relational": spark.read.parquet(f"{root}/store")}
    counts = [rows.groupBy("type", "nameOrig", "is_fraud_detected").agg(F.count("*").alias("n")).select(
        F.lit(store).alias("store"), "type", "nameOrig", "is_fraud_detected", "n") for store, rows in stores.items()]
    return functools.reduce(DataFrame.unionByName, counts)


@query("stream_limiter", f"SELECT nameDest, ingested_at, n, allowed FROM ({LIMITER_BY_RECEIVER})")
def stream_limiter(spark, folder):
    """The limiter with state per receiver, on slices in time order: at most two passed in ten days."""
    root = workspace.new_path(spark, "limiter")
    slices = transactions(spark, folder).select("nameDest", "ingested_at", F.floor((F.col("step") - 1) * PARTS / 721).alias("slice"))
    rows = slices.drop("slice")
    slices.hint("rebalance", F.col("slice")).write.partitionBy("slice").parquet(f"{root}/slices")
    table = LakeTable(spark, f"{root}/decisions")
    for name in sorted(files.folders(spark, f"{root}/slices"), key=lambda n: int(n.split("=")[1])):
        # A slice is one micro-batch of files that many tasks read; the next one comes after it.
        spark.read.schema(rows.schema).parquet(f"{root}/slices/{name}").write.mode("append").parquet(f"{root}/rows")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/rows")
        limited = limiter.limit_stream(stream, "nameDest", "ingested_at", 2, 864_000)
        detection.run_to_end(
            limited.writeStream.foreachBatch(table.append).option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True).start())
    return table.read().select(F.col("key").alias("nameDest"), F.expr(
        "timestampadd(MICROSECOND, at, TIMESTAMP_NTZ'1970-01-01 00:00:00')").alias("ingested_at"), "n", "allowed")
