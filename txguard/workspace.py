"""Paths in the shared folder that every executor can read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from txguard.sources import files


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; where it names none, one in the warehouse.

    Both are places that driver and executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses, below the shared root."""
    return f"{shared_root(spark)}/txguard/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: lineage ends at files that outlive any executor."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Remove all that runs have stored below the shared root. For benches and tests, which own that root."""
    files.remove(spark, f"{shared_root(spark)}/txguard")
