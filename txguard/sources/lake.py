"""Lake tables: idempotent appends by batch id, as-of reads, compaction jobs; on Delta, or on plain Parquet folders.

A Parquet table is a folder partitioned by ``batch_id``, and below that by what the table asks for. It has no versions of its
own: as-of is a filter on the batch id, and a repeated batch replaces its folder. Transactions over several writers, time
travel over compaction and expiry are what the Delta connector is for; ``DeltaTable`` hands them to it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard import workspace

RETAIN_HOURS = 168


def balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Merges small and splits large output partitions, so a type that holds most rows is written by many tasks and no task
    writes a sliver of every type."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


@dataclass
class LakeTable:
    """A Parquet table; ``schema`` is what a table without a single file reads as (else that is an error)."""

    spark: SparkSession
    path: str
    partition_by: list[str] = field(default_factory=list)
    schema: T.StructType | None = None

    def append(self, df: DataFrame, batch_id: int) -> None:
        """Write one batch; the same id again replaces it, also with nothing."""
        balanced(df, self.partition_by).write.mode("overwrite").partitionBy(*self.partition_by).parquet(
            f"{self.path}/batch_id={int(batch_id)}")

    def read(self, as_of: int | None = None) -> DataFrame:
        """All rows with their ``batch_id``, or those of batches up to ``as_of``, whose folders alone are read then.

        The schemas of all files are merged: a column that some batches lack is null there, and none is ever lost.
        """
        try:
            rows = self.spark.read.option("mergeSchema", True).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                raise
            if self.schema is None:
                raise ValueError(f"no data in {self.path}") from error
            rows = self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())]))
        rows = rows.withColumn("batch_id", F.col("batch_id").cast("long"))
        return rows if as_of is None else rows.where(F.col("batch_id") <= as_of)

    def newest(self) -> int | None:
        """The newest batch id."""
        return self.read().agg(F.max("batch_id")).first()[0]

    def compact(self, sort_by: list[str] | None = None, *, to: str | None = None, keep_open: int = 1) -> tuple[DataFrame, int]:
        """One job that writes the closed batches together, in files of the advisory size, as a table at ``to``.

        Closed are all but the newest ``keep_open`` batch ids, which a stream may still repeat. Returns the rows, with their
        batch ids as a column and every column of every batch, and the last id among them (-1: none). The table itself is
        only read: readers move to the copy, or stay. Sorting inside the files gives statistics a time filter can skip by.
        """
        last = self.newest()
        through = -1 if last is None else last - keep_open
        rows = balanced(self.read(through), self.partition_by)
        if sort_by:
            rows = rows.sortWithinPartitions(*self.partition_by, *sort_by)
        target = to or workspace.new_path(self.spark, "compacted")
        rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(target)
        written = self.spark.read.schema(rows.schema).parquet(target)
        if written.count() != self.read(through).count():
            raise RuntimeError(f"{target} does not hold the rows of {self.path} up to batch {through}")
        return written, through


@dataclass
class DeltaTable:
    """The same table kept by the Delta connector: its commits, versions, compaction and expiry."""

    spark: SparkSession
    path: str
    partition_by: list[str] = field(default_factory=list)
    schema: T.StructType | None = None

    def append(self, df: DataFrame, batch_id: int) -> None:
        """An append that the connector skips if it has committed that batch id of this table before."""
        rows = df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        rows.write.format("delta").mode("append").options(**self.append_options(batch_id)).partitionBy(*self.partition_by).save(self.path)

    def append_options(self, batch_id: int) -> dict[str, str]:
        return {"mergeSchema": "true", "txnAppId": self.path, "txnVersion": str(int(batch_id))}

    def read(self, version: int | None = None) -> DataFrame:
        reader = self.spark.read.format("delta")
        return (reader if version is None else reader.option("versionAsOf", version)).load(self.path)

    def maintenance(self, retain_hours: float = RETAIN_HOURS) -> list[str]:
        """What compacts the table and drops files that no version younger than the limit needs."""
        return [f"OPTIMIZE delta.`{self.path}`", f"VACUUM delta.`{self.path}` RETAIN {int(retain_hours)} HOURS"]


def delta_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension", False,
                                           spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
        return True
    except Exception:
        return False


def table_kind(spark: SparkSession, name: str) -> type[LakeTable] | type[DeltaTable]:
    """``parquet`` or ``delta``; the latter needs its connector on the classpath."""
    if name == "delta" and not delta_available(spark):
        raise ValueError("the Delta connector is not on the classpath")
    return {"parquet": LakeTable, "delta": DeltaTable}[name]
