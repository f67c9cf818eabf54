"""Tables in a relational store that the cluster connects to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.operators.lookup import unmatched
from txguard.schema import DETECTION_COLUMNS


def read_table(spark: SparkSession, url: str, table: str, *, column: str, lower: int, upper: int,
               partitions: int, fetch_size: int = 10_000, **options: str) -> DataFrame:
    """Parallel read: one range of ``column`` per task. Filters and column choice run in the store."""
    return (
        spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=fetch_size, **options)
        .option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper)
        .option("numPartitions", partitions).load()
    )


def rows_to_write(batch: DataFrame, batch_id: int, committed: DataFrame | None) -> DataFrame:
    """The batch with its id, less what an earlier attempt at the same id has already committed.

    Records are matched by what came in, not by what was found out about them: a committed record is never written
    again, whatever its verdict.
    """
    tagged = batch.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
    if committed is None:
        return tagged
    record = [c for c in tagged.columns if c not in DETECTION_COLUMNS]
    done = committed.where(F.col("batch_id") == int(batch_id)).select(record)
    return tagged if done.isEmpty() else unmatched(tagged, done, record)


def append_batch(batch: DataFrame, batch_id: int, url: str, table: str, *, connections: int = 16,
                 **options: str) -> None:
    """Append a micro-batch so that repeating it adds nothing.

    Each task commits on its own, so a failed attempt may have left part of the batch. The rows of this
    batch id are read back (a filter the store answers from an index on batch_id) and only the rest is
    written. ``connections`` bounds the load on the store. The table has the columns of the batch and
    ``batch_id``; a missing one is created.
    """
    store = {"url": url, "dbtable": table, **options}
    empty = rows_to_write(batch.limit(0), batch_id, None)
    empty.write.format("jdbc").options(**store).mode("append").save()
    committed = batch.sparkSession.read.format("jdbc").options(**store).load()
    rest = rows_to_write(batch, batch_id, committed)
    rest.coalesce(connections).write.format("jdbc").options(**store).mode("append").save()
