"""The list of accounts that committed fraud before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.operators.quality import expectation, require
from txguard.sources import files

BLACKLIST_SCHEMA = T.StructType([T.StructField("account", T.StringType())])


def build(history: DataFrame, until_step: int | None = None) -> DataFrame:
    """Distinct senders of labelled fraud, up to a step or (``None``) over the whole history.

    A cut-off keeps the labels of the rows under test out of the list.
    """
    fraud = history.where(F.col("isFraud") == 1)
    if until_step is not None:
        fraud = fraud.where(F.col("step") <= until_step)
    return fraud.select(F.col("nameOrig").alias("account")).where("account IS NOT NULL").distinct()


def extend(current: DataFrame, more: DataFrame) -> DataFrame:
    """Set union of two lists."""
    return current.unionByName(more).distinct()


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """What a refresh changes: ``(account, change)`` with ``added`` or ``removed``."""
    added = new.exceptAll(old).withColumn("change", F.lit("added"))
    removed = old.exceptAll(new).withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions; a folder whose write has not finished has no ``_SUCCESS`` and does not count."""
    names = [n for n in files.folders(spark, path) if n.startswith("version=")]
    return sorted(int(n.split("=")[1]) for n in names if files.exists(spark, f"{path}/{n}/_SUCCESS"))


def newest(spark: SparkSession, path: str) -> int:
    """The newest published version, 0 if there is none; looks back from the newest folder only."""
    names = [n for n in files.folders(spark, path) if n.startswith("version=")]
    for version in sorted((int(n.split("=")[1]) for n in names), reverse=True):
        if files.exists(spark, f"{path}/version={version}/_SUCCESS"):
            return version
    return 0


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A published version, by default the newest; looking again on every call is what makes a refresh visible."""
    version = newest(spark, path) if version is None else version
    if version == 0:
        return spark.createDataFrame([], BLACKLIST_SCHEMA)
    return spark.read.schema(BLACKLIST_SCHEMA).parquet(f"{path}/version={version}")


def expire(spark: SparkSession, path: str, keep: int = 10) -> list[int]:
    """Remove all but the newest ``keep`` versions; a batch in flight holds one of the newest."""
    old = versions(spark, path)[:-keep]
    for version in old:
        files.remove(spark, f"{path}/version={version}")
    return old


def publish(accounts: DataFrame, path: str, mode: str = "replace") -> DataFrame:
    """Write the next version, as a replacement or added to the current one; readers keep what they opened."""
    spark = accounts.sparkSession
    rows = accounts if mode == "replace" else extend(read(spark, path), accounts)
    target = newest(spark, path) + 1
    rows.write.mode("overwrite").parquet(f"{path}/version={target}")
    return read(spark, path)


def refresh(history: DataFrame, path: str, until_step: int | None = None) -> DataFrame:
    """Scheduled job: check the input, reload, verify that the list is not empty. Returns the expectations."""
    rows = expectation(history, "history_present", F.count("*"), lambda v: v > 0)
    require(rows)
    current = publish(build(history, until_step), path)
    listed = expectation(current, "blacklist_not_empty", F.count("*"), lambda v: v > 0)
    require(listed)
    return rows.unionByName(listed)
