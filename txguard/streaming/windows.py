"""Event-time counters over the detection result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from txguard.sources.lake import LakeTable

COUNTS = ["total", "fraud"]


def minute_counts(rows: DataFrame, ts: str = "ingested_at") -> DataFrame:
    """Rows and flagged rows per minute."""
    start = F.date_trunc("minute", F.col(ts).cast("timestamp"))
    counts = rows.groupBy(start.alias("start")).agg(
        F.count("*").alias("total"), F.count_if(F.col("is_fraud_detected") == 1).alias("fraud"))
    return counts.where("start IS NOT NULL").select("start", (F.col("start") + F.expr("INTERVAL 1 MINUTE")).alias("end"), *COUNTS)


def start_counts(stream: DataFrame, table: LakeTable, checkpoint: str, *, ts: str = "ingested_at",
                 once: bool = False) -> StreamingQuery:
    """Store the counts of each micro-batch; ``latest_counts`` adds them up.

    A batch is counted by itself, so there is no state to keep and no event comes too late to be counted. A repeated batch
    replaces its counts.
    """
    writer = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: table.append(minute_counts(batch, ts), batch_id))
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_counts(table: LakeTable) -> DataFrame:
    return table.read().groupBy("start", "end").agg(*[F.sum(c).alias(c) for c in COUNTS])


def sliding_counts(minutes: DataFrame, width: int = 60) -> DataFrame:
    """Counts per window of ``width`` minutes that starts at each minute, from the counts per minute.

    Sliding over minutes instead of events: an event is counted once, not once per window it lies in, and
    the stream keeps one row of state per minute for every width.
    """
    first = F.col("start") - F.expr(f"INTERVAL {int(width) - 1} MINUTES")
    starts = F.explode(F.sequence(first, F.col("start"), F.expr("INTERVAL 1 MINUTE")))
    return (
        minutes.select(starts.alias("start"), *COUNTS)
        .groupBy("start").agg(*[F.sum(c).alias(c) for c in COUNTS])
        .select("start", (F.col("start") + F.expr(f"INTERVAL {int(width)} MINUTES")).alias("end"), *COUNTS)
    )
