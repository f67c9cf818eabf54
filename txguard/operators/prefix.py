"""Running totals over a whole table in an order of its own, with no task that sees it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard import workspace


def running_totals(df: DataFrame, order: Column, values: list[str]) -> DataFrame:
    """``df`` plus, for each of ``values``, column ``before_<value>``: its sum over all rows that come earlier in ``order``.

    Rows are dealt to ranges of ``order`` and stored. Each range is summed, the few sums are added up, and within a range a
    window goes on from there. Rows that are equal in ``order`` would come in any order, so there should be none: count
    them first. Values are exact numbers; missing ones count as 0.
    """
    spark = df.sparkSession
    ranged = df.withColumn("__at", order).repartitionByRange(F.col("__at")).withColumn("__part", F.spark_partition_id())
    stored = workspace.write_table(ranged, workspace.new_path(spark, "ranges"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    sums = stored.groupBy("__part").agg(*[F.sum(zero(v)).alias(f"__sum_{v}") for v in values])
    parts = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sums.select("__part", *[F.coalesce(F.sum(f"__sum_{v}").over(parts), F.lit(0)).alias(f"__start_{v}") for v in values])
    inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    joined = stored.join(F.broadcast(starts), "__part")
    return joined.select(
        *df.columns, *[(F.col(f"__start_{v}") + F.coalesce(F.sum(zero(v)).over(inside), F.lit(0))).alias(f"before_{v}") for v in values])
