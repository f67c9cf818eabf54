"""Queries on lake tables: idempotent appends, as-of reads, compaction, schema evolution; samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from txguard import workspace
from txguard.catalog.base import detected, on_detected, on_transactions, query, transactions
from txguard.operators.sampling import poisson_bounds, sample_rows, sample_with_replacement, split_by_id
from txguard.schema import TX_COLUMNS
from txguard.sources import jdbc
from txguard.sources.lake import LakeTable
from txguard.sources.transactions import read_csv

PERIODS = 4
SAMPLE_ORDER = "CAST('0x' || substr(md5(tx_id || ':42'), 1, 15) AS BIGINT)"
_BATCH = f"CAST(FLOOR((step - 1) * {PERIODS} / 721) AS BIGINT)"


def _periods(spark, folder):
    """The detected rows, stored once with a folder for each period."""
    rows = detected(spark, folder).withColumn("period", F.floor((F.col("step") - 1) * PERIODS / 721))
    path = workspace.new_path(spark, "periods")
    rows.hint("rebalance", F.col("period")).write.partitionBy("period").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _in_batches(spark, folder, name: str, last: int = PERIODS) -> LakeTable:
    """The detected rows appended period by period; the second batch is written twice."""
    table, rows = LakeTable(spark, workspace.new_path(spark, name), ["type"]), _periods(spark, folder)
    for batch_id in [*range(last), 1]:
        table.append(rows.where(F.col("period") == batch_id).drop("period"), batch_id)
    return table


@query("lake_append", on_detected(f"SELECT *, {_BATCH} AS batch_id FROM det"))
def lake_append(spark, folder):
    return _in_batches(spark, folder, "lake").read()


@query("lake_as_of", on_detected(f"SELECT *, {_BATCH} AS batch_id FROM det WHERE {_BATCH} <= 1"))
def lake_as_of(spark, folder):
    return _in_batches(spark, folder, "lake").read(as_of=1)


@query("lake_compact", on_detected(f"SELECT *, {_BATCH} AS batch_id FROM det"))
def lake_compact(spark, folder):
    """The closed batches written together, the open one from the table: the rows stay the same."""
    table = _in_batches(spark, folder, "lake")
    rows, through = table.compact(["ingested_at"])
    return rows.unionByName(table.read().where(F.col("batch_id") > through))


@query("lake_compact_evolved", on_transactions("""SELECT tx_id, amount, CASE WHEN step > 180 THEN nameDest END AS nameDest,
  CASE WHEN step > 180 AND step <= 360 THEN isFraud END AS isFraud, CASE WHEN step > 360 THEN 2 WHEN step > 180 THEN 1 ELSE 0 END::BIGINT AS batch_id FROM tx"""))
def lake_compact_evolved(spark, folder):
    """Columns that come and go over the batches, all of them still there after compaction."""
    table, tx = LakeTable(spark, workspace.new_path(spark, "lake")), transactions(spark, folder)
    table.append(tx.where("step <= 180").select("tx_id", "amount"), 0)
    table.append(tx.where("step > 180 AND step <= 360").select("tx_id", "amount", "nameDest", "isFraud"), 1)
    table.append(tx.where("step > 360").select("tx_id", "amount", "nameDest"), 2)
    rows, through = table.compact(["tx_id"])
    return rows.unionByName(table.read().where(F.col("batch_id") > through))


@query("lake_schema_evolve", on_transactions("""SELECT tx_id, amount, CASE WHEN step > 360 THEN nameDest END AS nameDest,
  CASE WHEN step > 360 THEN 1 ELSE 0 END::BIGINT AS batch_id FROM tx"""))
def lake_schema_evolve(spark, folder):
    """A later batch brings a column the earlier one lacks."""
    table, tx = LakeTable(spark, workspace.new_path(spark, "lake")), transactions(spark, folder)
    table.append(tx.where("step <= 360").select("tx_id", "amount"), 0)
    table.append(tx.where("step > 360").select("tx_id", "amount", "nameDest"), 1)
    return table.read()


@query("relational_retry", on_detected(
    "SELECT tx_id, type, amount, is_fraud_detected, 7::BIGINT AS batch_id FROM det WHERE type <> 'TRANSFER'"))
def relational_retry(spark, folder):
    """What the relational sink writes when an earlier attempt at batch 7 committed the transfers only.

    Reading and writing a store needs a database, which no query here starts; its committed rows are a table.
    """
    batch = detected(spark, folder).select("tx_id", "type", "amount", "is_fraud_detected")
    # The earlier attempt had other verdicts; a committed record is not written again all the same.
    committed = jdbc.rows_to_write(batch.where("type = 'TRANSFER'"), 7, None).withColumn("is_fraud_detected", 1 - F.col("is_fraud_detected"))
    stored = workspace.write_table(committed, workspace.new_path(spark, "store"))
    return jdbc.rows_to_write(batch, 7, stored)


@query("save_sample", on_transactions(f"SELECT {', '.join(TX_COLUMNS)} FROM tx ORDER BY {SAMPLE_ORDER} LIMIT 200000"))
def save_sample(spark, folder):
    path = workspace.new_path(spark, "sample")
    rows = sample_rows(transactions(spark, folder).select("tx_id", *TX_COLUMNS), 200_000, ["tx_id"])
    rows.drop("tx_id").write.option("header", True).csv(path)
    return read_csv(spark, path)


_TIMES = " + ".join(f"CASE WHEN {SAMPLE_ORDER} >= {bound} THEN 1 ELSE 0 END" for bound in poisson_bounds(0.5))


@query("sample_replacement", on_transactions(f"""SELECT tx_id, type, amount, isFraud FROM
  (SELECT tx_id, type, amount, isFraud, unnest(range({_TIMES})) AS copy FROM tx)"""))
def sample_replacement(spark, folder):
    """Half as many rows as the table has, drawn with replacement."""
    rows = transactions(spark, folder).select("tx_id", "type", "amount", "isFraud")
    return sample_with_replacement(rows, 0.5, ["tx_id"])


@query("train_test_split", on_transactions(
    "SELECT tx_id, CASE WHEN tx_id % 10 < 8 THEN 'train' ELSE 'test' END AS split FROM tx"))
def train_test_split(spark, folder):
    return split_by_id(transactions(spark, folder).select("tx_id"), "tx_id")
