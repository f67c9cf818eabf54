"""Connected components of links, by rounds of joins until every node points at its root."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import workspace


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND((1 << 40) - 1))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are hung below the smallest node it knows."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    low = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    return low.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are hung below the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node that is not its own root.

    ``edges`` has two columns of one orderable type; loops, nulls and repeated edges are ignored. The largest group costs
    no more than one row per node and round: counting is partial before the shuffle, and the joins are of kinds that
    adaptive execution splits. Rounds are written to the shared folder.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    clean = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), (F.col(a) != F.col(b)).alias("real"))
    current = workspace.write_table(
        clean.where("real").select("a", "b").distinct(), workspace.new_path(spark, "edges"))
    before = _signature(current)
    while before[0]:
        current = workspace.write_table(_small_star(_large_star(current)), workspace.new_path(spark, "edges"))
        now = _signature(current)
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
