"""Limits and samples of the catalog take as many rows as the original does, on a table that is larger than them."""

import pytest
from pyspark.sql import functions as F

from txguard.catalog import QUERIES

COPIES = 4  # of 100,000 rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("copies"))
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    copies = events.crossJoin(spark.range(COPIES).withColumnRenamed("id", "copy"))
    copies.withColumn("event_id", F.col("event_id") + F.col("copy") * 100_000).drop("copy").write.parquet(f"{path}/events.parquet")
    return path


def test_chart_sample(spark, folder):
    rows = QUERIES["chart_sample"](spark, folder).select("tx_id")
    assert rows.count() == rows.distinct().count() == 15_000


def test_scan_limit(spark, folder):
    ids = QUERIES["scan_limit"](spark, folder).agg(F.count("*"), F.countDistinct("tx_id"), F.max("tx_id")).first()
    assert tuple(ids) == (300_000, 300_000, 299_999)


def test_save_sample(spark, folder):
    assert QUERIES["save_sample"](spark, folder).count() == 200_000
