"""From links between classes of equal rows to the result for every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.llm.components import components


def named_links(stored: DataFrame, classes: DataFrame, found: DataFrame, name: str, *more: str) -> DataFrame:
    """Every row of ``stored`` with ``n_links``, ``component_id``, ``kept`` and ``first``.

    ``stored`` has the rows, with the ``key`` of their class (null: links with nothing); ``classes`` has for each key the
    smallest id ``first`` and the number of ``copies``; ``found`` has ``links`` of a key to rows of other classes, in parts,
    and edges ``key``, ``near``. ``n_links`` counts other rows linked directly; ``component_id`` is the smallest id
    reachable, ``kept`` marks it.
    """
    spark = stored.sparkSession
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.select("key", "near"))
    named = (
        classes.select("key", "first", "copies").join(counts, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("least"))
    # Classes of one row without links are settled by the row itself.
    named = named.join(smallest, "root").where("copies > 1 OR links > 0").select(
        "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "least", "first")
    named = workspace.write_table(named, workspace.new_path(spark, "named"))
    component = F.coalesce("least", name)
    return stored.select("key", name, *more).join(named, "key", "left").select(
        name, *more, "first", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col(name).eqNullSafe(component).alias("kept"))
