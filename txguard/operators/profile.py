"""Column profiles: summaries, missing values, copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.operators.quantiles import exact_quantiles


def unpivot(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """Long form ``(column, value)`` of the given columns."""
    return df.select([F.col(c).cast(kind).alias(c) for c in columns]).unpivot([], columns, "column", "value")


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max.

    The moments of all columns come from one pass over the rows as they are; only the quartiles need the
    long form, a row per column and value.
    """
    def moments(column: str):
        value = F.col(column).cast("double")
        return F.struct(
            F.lit(column).alias("column"), F.count(value).alias("count"), F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))

    summary = df.agg(*[moments(c).alias(c) for c in columns]).select(F.inline(F.array(*columns)))
    quartiles = (
        exact_quantiles(unpivot(df, columns, "double"), ["column"], "value", [0.25, 0.5, 0.75])
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name)
               for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    )
    return summary.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def string_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, unique, most frequent value (smallest on a tie) and its count.

    Values are counted first, so a value that fills a third of the table is one row per map task.
    """
    counts = (
        unpivot(df, columns, "string").where("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    summary = counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"), F.max("n").alias("freq"))
    top = (
        counts.join(F.broadcast(summary.select("column", "freq")), "column")
        .where("n = freq").groupBy("column").agg(F.min("value").alias("top"))
    )
    return summary.join(F.broadcast(top), "column").select("column", "count", "unique", "top", "freq")


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column, most first, from one pass."""
    columns = columns or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column", "missing").orderBy(F.desc("missing"), "column")


def duplicate_count(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row in all columns.

    Rows are told apart by a 256-bit digest of all values, so that long texts do not travel.
    """
    whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    copies = df.groupBy(F.sha2(whole, 256).alias("digest")).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
