"""What the physical plans must look like at any scale."""

import pytest
from pyspark.sql import functions as F

from txguard.catalog import base
from txguard.operators.sampling import first_rows
from txguard.plans import dashboard, detection
from txguard.sources.transactions import from_events, read_transactions

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def detected(spark):
    return base.detected(spark, FOLDER)


def above_broadcast(text):
    """The plan lines on the side of the transactions: everything outside broadcast exchanges."""
    lines, depth = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and indent > depth:
            continue
        depth = indent if "BroadcastExchange" in line else None
        if depth is None:
            lines.append(line)
    return "\n".join(lines)


def test_detection_moves_no_transactions(detected):
    text = plan(detected)
    assert "BroadcastHashJoin" in text and "Exchange" not in above_broadcast(text)


def test_detection_runs_no_python(detected):
    assert "Python" not in plan(detected) and "EvalPython" not in plan(detected)


def test_only_needed_columns_are_read(spark):
    text = plan(read_transactions(spark, FOLDER).select("tx_id", "nameDest"))
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_headline_numbers_take_one_scan_and_one_row_per_task(detected):
    text = plan(dashboard.headline(detected))
    assert text.count("events.parquet") == 1
    assert "partial_count" in text and "SinglePartition" in text


def test_top_accounts_aggregate_before_the_shuffle(detected):
    text = plan(dashboard.top_accounts(detected, "nameOrig"))
    assert "TakeOrderedAndProject" in text and "partial_count" in text


def test_time_filter_reaches_the_scan(spark):
    rows = read_transactions(spark, FOLDER).where(F.col("ingested_at") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(rows)


def test_running_count_orders_minutes_not_rows(detected):
    """The one-partition window stands above the aggregation by minute."""
    text = plan(dashboard.cumulative_fraud(detected, 1))
    assert text.index("Window ") < text.index("HashAggregate")


def test_large_blacklist_is_not_broadcast(spark):
    """Above the limit the rows meet the members that occur; without room for a filter the list is shuffled, but for hot keys."""
    rows = from_events(spark.read.parquet(f"{FOLDER}/events.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = plan(detection.blacklist_flag(rows, base.blacklist(spark, FOLDER), broadcast_bytes=0))
        text = plan(detection.blacklist_flag(rows, base.blacklist(spark, FOLDER), broadcast_bytes=0, filter_bytes=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in found and "txguard/members" in found and "/blacklist" not in found
    assert "SortMergeJoin [__key" in text and "BroadcastHashJoin [nameOrig" in text


def test_big_samples_do_not_pass_through_one_task(spark):
    """The bound is found by counting; rows below it pass a filter where they are."""
    rows = spark.range(100_000).withColumnRenamed("id", "tx_id")
    few = first_rows(rows, 100, "tx_id")
    assert sorted(r.tx_id for r in few.collect()) == list(range(100))
    assert "TakeOrdered" not in plan(few) and "Sort" not in plan(few)
    assert few.count() == 100 and first_rows(rows, 200_000, "tx_id").count() == 100_000
