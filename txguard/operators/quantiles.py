"""Exact percentiles without holding a group's values, or a sketch of them, in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.operators.radix import FEW, from_bits, select_ranks, with_sortable_bits


def exact_quantiles(df: DataFrame, groups: list[str], value: str, probabilities: list[float], few: int = FEW) -> DataFrame:
    """Rows ``(*groups, p, quantile)`` with linear interpolation between neighbouring ranks.

    Missing values are ignored, NaN is larger than any number. The ranks come from counts of key prefixes (``radix``), up to
    three or four passes over ``df``.
    """
    position = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    either = [edge(position(p)).cast("long") for p in probabilities for edge in (F.floor, F.ceil)]
    keyed = with_sortable_bits(df.select(*groups, F.col(value).alias("__v")).where("__v IS NOT NULL"), F.col("__v"))
    ranks = select_ranks(keyed, groups, "__key", lambda n: F.array(*either), few)
    # A row for each group, with two values for each probability at most.
    at = ranks.groupBy(*groups, "n").agg(F.map_from_entries(F.collect_list(F.struct("rank", from_bits(F.col("key"))))).alias("at"))
    each = at.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    where = F.col("p") * (F.col("n") - 1)
    low, high = (F.col("at")[edge(where).cast("long")] for edge in (F.floor, F.ceil))
    return each.select(*groups, "p", F.when(low == high, low).otherwise(low + (high - low) * (where - F.floor(where))).alias("quantile"))
