"""Equal-width histograms by class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: Column, by: Column, bins: int, *, low: float | None = None,
              high: float | None = None) -> DataFrame:
    """Rows ``(label, bin, n, density)`` over ``bins`` equal cells between ``low`` and ``high``.

    Open limits come from the data in one scalar pass shared by all classes. The last cell includes its
    upper edge; values outside the limits, NaN and infinite ones are left out of the counts and of the density. The value is
    computed once per row: behind an ``explode`` it is not copied into every condition on it.
    """
    data = df.select(F.explode(F.array(value.cast("double"))).alias("v"), by.alias("label")).where("v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('infinity')")
    lo = F.lit(float(low)) if low is not None else data.agg(F.min("v")).scalar()
    hi = F.lit(float(high)) if high is not None else data.agg(F.max("v")).scalar()
    ranged = data.withColumns({"lo": lo, "hi": hi}).where("v BETWEEN lo AND hi")
    width = (F.col("hi") - F.col("lo")) / bins
    cell = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), width)), F.lit(0))
    counts = (
        ranged.withColumns({"bin": F.least(cell, F.lit(bins - 1)).cast("int"), "width": width})
        .groupBy("label", "bin").agg(F.count("*").alias("n"), F.max("width").alias("width"))
    )
    # The window sees cells, at most ``bins`` per label, never rows.
    total = F.sum("n").over(Window.partitionBy("label"))
    return counts.withColumn("total", total).select(
        "label", "bin", "n", F.try_divide(F.col("n"), F.col("total") * F.col("width")).alias("density"))
