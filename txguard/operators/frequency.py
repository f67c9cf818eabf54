"""Relative frequencies of a column's values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.operators.lookup import lookup


def value_frequencies(df: DataFrame, column: str, name: str = "freq") -> DataFrame:
    """``(column, name)``: share of each value among the non-missing ones.

    The total is a scalar subquery, not a window over all values, so no task sees the whole column.
    """
    present = df.select(column).where(F.col(column).isNotNull())
    total = present.agg(F.count("*").cast("double").alias("total"))
    return present.groupBy(column).agg(F.count("*").alias("n")).select(
        column, (F.col("n") / total.scalar()).alias(name))


def encode_frequency(df: DataFrame, column: str, name: str = "freq", **options) -> DataFrame:
    """``df`` plus each row's value frequency; null stays null.

    The frequencies are stored once, since both the size check and the lookup read them.
    """
    spark = df.sparkSession
    table = workspace.write_table(value_frequencies(df, column, name), workspace.new_path(spark, "frequencies"))
    return lookup(df, table, column, name, **options)


def rare_rows(df: DataFrame, column: str, threshold: float = 0.05, **options) -> DataFrame:
    """Rows whose value is rarer than ``threshold``."""
    return encode_frequency(df, column, "__freq", **options).where(F.col("__freq") < threshold).drop("__freq")
