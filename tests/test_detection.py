"""Features, rule, blacklist and verdict, with the boundary rows."""

import pytest
from conftest import accounts
from pyspark.sql import functions as F

from txguard.functions.features import eda_features, mismatch, stream_features, training_features
from txguard.functions.rules import drain_rule, method_is, rate_band, reason
from txguard.operators import bloom
from txguard.operators.lookup import drop_members, flag_members, hot_keys, keep_members, listed, lookup, unmatched
from txguard.plans.detection import blacklist_flag, detect


def column(df, name):
    return [row[name] for row in df.collect()]


# The inputs and results of the next three tests are the contract of features, rule and verdict.
def test_features_of_two_rows(tx):
    rows = training_features(tx(
        {"type": "TRANSFER", "amount": 1000.0, "oldbalanceOrg": 1000.0, "newbalanceOrig": 0.0,
         "oldbalanceDest": 0.0, "newbalanceDest": 1000.0, "nameDest": "C123"},
        {"type": "CASH_OUT", "amount": 500.0, "oldbalanceOrg": 2000.0, "newbalanceOrig": 1500.0,
         "oldbalanceDest": 500.0, "newbalanceDest": 1000.0, "nameDest": "M456"})).collect()
    first, second = rows
    assert first.balance_diff_orig == -1000.0
    assert first.amount_ratio_orig == first.drain_ratio == 1.0
    assert (first.zero_balance_after, first.dest_is_merchant) == (1, 0)
    assert (second.zero_balance_after, second.dest_is_merchant) == (0, 1)


def test_rule_on_three_rows(tx):
    rows = tx(
        {"type": "TRANSFER", "amount": 100.0, "oldbalanceOrg": 100.0, "newbalanceOrig": 0.0},
        {"type": "TRANSFER", "amount": 50.0, "oldbalanceOrg": 100.0, "newbalanceOrig": 50.0},
        {"type": "PAYMENT", "amount": 100.0, "oldbalanceOrg": 100.0, "newbalanceOrig": 0.0})
    assert column(rows.withColumn("f", drain_rule()), "f") == [1, 0, 0]


def test_blacklist_and_rule_combined(spark, tx):
    rows = tx(
        {"nameOrig": "U_0001", "type": "TRANSFER", "amount": 100.0, "oldbalanceOrg": 100.0, "newbalanceOrig": 0.0},
        {"nameOrig": "B_1234", "type": "CASH_IN", "amount": 50.0, "oldbalanceOrg": 50.0, "newbalanceOrig": 100.0},
        {"nameOrig": "U_0002", "type": "PAYMENT", "amount": 20.0, "oldbalanceOrg": 100.0, "newbalanceOrig": 80.0})
    found = {r.nameOrig: r.is_fraud_detected for r in detect(rows, accounts(spark, "B_1234", "B_9999")).collect()}
    assert found == {"U_0001": 1, "B_1234": 1, "U_0002": 0}


def test_known_positive_fires_without_a_listing(spark, tx):
    row = tx({"type": "TRANSFER", "amount": 9999999.99, "nameOrig": "C1231006815", "oldbalanceOrg": 9999999.99,
              "newbalanceOrig": 0.0, "nameDest": "C553264065", "newbalanceDest": 9999999.99})
    assert detect(row, accounts(spark)).first().rule_fraud_flag == 1


@pytest.mark.parametrize(
    "amount, old, new, expected",
    [
        (95.0, 100.0, 0.0, 1), (105.0, 100.0, 0.0, 1), (94.99, 100.0, 0.0, 0), (105.01, 100.0, 0.0, 0),
        (100.0, 0.0, 0.0, 0), (100.0, None, 0.0, 0), (-100.0, -100.0, 0.0, 0), (100.0, 100.0, 0.01, 0),
        (None, 100.0, 0.0, 0), (100.0, 100.0, None, 0),
    ])
def test_rule_boundaries(tx, amount, old, new, expected):
    row = tx({"type": "CASH_OUT", "amount": amount, "oldbalanceOrg": old, "newbalanceOrig": new})
    assert row.select(drain_rule().alias("f")).first().f == expected


def test_feature_boundaries(tx):
    rows = training_features(tx(
        {"amount": 200_000.0, "oldbalanceDest": 0.0, "newbalanceDest": 200_001.0},
        {"amount": 200_000.01, "oldbalanceDest": 0.0, "newbalanceDest": 200_001.02},
        {"amount": 0.0, "oldbalanceDest": 0.0, "newbalanceDest": 50.0, "oldbalanceOrg": 0.0, "newbalanceOrig": 0.0},
        {"oldbalanceOrg": -5.0}, {"oldbalanceOrg": None})).collect()
    assert [r.is_large_transaction for r in rows[:2]] == [0, 1]
    assert [r.dest_balance_anomaly for r in rows[:3]] == [0, 1, 0]
    assert [r.amount_ratio_orig for r in rows[2:]] == [0.0, 0.0, 0.0]


def test_eda_features_repair_values(tx):
    rows = eda_features(tx(
        {"newbalanceOrig": float("inf")}, {"newbalanceOrig": None}, {"newbalanceOrig": float("nan")},
        {"oldbalanceOrg": 0.0, "newbalanceOrig": 0.0}, {"oldbalanceOrg": 5.0, "newbalanceOrig": 0.0})).collect()
    assert [r.balance_diff_orig for r in rows] == [0.0, 0.0, 0.0, 0.0, -5.0]
    assert [r.zero_balance_after for r in rows] == [0, 0, 0, 0, 1]


def test_stream_features_only_add(tx):
    rows = tx({"type": "TRANSFER"}, {"type": None})
    built = stream_features(rows)
    assert built.columns[: len(rows.columns)] == rows.columns
    assert column(built, "is_transfer_or_cashout") == [1, 0]


#: A list that is broadcast; one whose occurring members are; one whose filter is; one that is too large for all of that.
WAYS = [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "known_bytes": 0}, {"broadcast_bytes": 0, "filter_bytes": 0}]


def test_missing_account_is_not_listed(spark, tx):
    rows = tx({"nameOrig": None}, {"nameOrig": "A"})
    listed = spark.createDataFrame([(None,), ("A",), ("A",)], "account string")
    for sizes in WAYS:
        flagged = flag_members(rows, listed, "nameOrig", "f", **sizes)
        assert sorted((r.nameOrig or "", r.f) for r in flagged.collect()) == [("", 0), ("A", 1)]


def test_both_sides(spark, tx):
    rows = tx({"nameOrig": "A", "nameDest": "X"}, {"nameOrig": "X", "nameDest": "A"}, {"nameOrig": "X", "nameDest": "X"})
    listed = accounts(spark, "A")
    assert column(blacklist_flag(rows, listed), "blacklist_flag") == [1, 0, 0]
    for sizes in WAYS:
        found = blacklist_flag(rows, listed, sides="both", **sizes).orderBy(F.desc("blacklist_flag"), "nameOrig")
        assert [(r.nameOrig, r.blacklist_flag) for r in found.collect()] == [("A", 1), ("X", 1), ("X", 0)]
    with pytest.raises(ValueError):
        blacklist_flag(rows, listed, sides="receiver")


def test_semi_and_anti_split_the_rows(spark, tx):
    rows = tx(*[{"nameOrig": n} for n in ("A", "A", "B", None)])
    listed = accounts(spark, "A", "Z")
    for sizes in WAYS:
        assert keep_members(rows, listed, "nameOrig", **sizes).columns == rows.columns
        assert column(keep_members(rows, listed, "nameOrig", **sizes), "nameOrig") == ["A", "A"]
        kept = column(drop_members(rows, listed, "nameOrig", **sizes), "nameOrig")
        assert sorted(kept, key=str) == ["B", None]


def skewed(spark):
    """A third of the rows with one listed key, a third with one unlisted key, the rest spread; copies included."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "cold").otherwise(
        F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(30_000).select((F.col("id") % 7000).alias("row"), key.alias("key"))


def test_lookup_keeps_every_row_of_hot_keys(spark):
    rows = skewed(spark)
    listed = spark.createDataFrame([("hot",), *[(f"k{i}",) for i in range(0, 500, 2)]], "account string")
    small = flag_members(rows, listed, "key", "f")
    for sizes in WAYS[1:]:
        large = flag_members(rows, listed, "key", "f", **sizes)
        assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty() and large.count() == 30_000
    assert small.agg(F.sum("f")).first()[0] > 10_000
    assert sorted(column(hot_keys(rows, "key", 10), "key")) == ["cold", "hot"]


def test_filter_never_loses_a_member_and_lets_few_others_pass(spark):
    members = spark.range(20_000).select(F.concat(F.lit("m"), "id").alias("account"))
    blocks = bloom.blocks_for(20_000)
    table = bloom.build(members.unionByName(members.limit(50)), "account", blocks)
    assert table.count() <= blocks and blocks * bloom.BLOCK_BYTES == bloom.bytes_for(20_000) < 4 * 20_000
    others = spark.range(100_000).select(F.concat(F.lit("x"), "id").alias("account"))
    missing = spark.createDataFrame([(None,)], "account string")
    assert bloom.mark(members, table, blocks, ["account"], "m").where("NOT m").isEmpty()
    passed = bloom.mark(others, table, blocks, ["account"], "m").where("m").count()
    assert 0 < passed < 1000
    assert bloom.mark(missing, table, blocks, ["account"], "m").first().m is False
    empty = bloom.build(members.limit(0), "account", bloom.blocks_for(0))
    assert bloom.mark(members, empty, 1, ["account"], "m").where("m").isEmpty()


def test_only_possible_members_move(spark):
    """20,000 listed accounts, 300,000 rows of which 1 % are theirs: the shuffles carry a fixed multiple of the hits."""
    rows = spark.range(300_000).select("id", F.when(F.col("id") % 100 == 0, F.concat(F.lit("m"), F.col("id") % 7000)).otherwise(
        F.concat(F.lit("x"), F.col("id") % 50_000)).alias("key"))
    members = spark.range(20_000).select(F.concat(F.lit("m"), "id").alias("account"))
    hits = rows.join(members, rows.key == members.account, "left_semi")
    found = listed(rows, members, ["key"], broadcast_bytes=0)
    assert found.fits and found.known.count() == hits.select("key").distinct().count()
    never, maybe = found.split(rows, ["key"])
    assert hits.count() <= maybe.count() <= 2 * hits.count() and never.count() + maybe.count() == 300_000
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan(never)
    flagged = flag_members(rows, members, "key", "f", broadcast_bytes=0)
    assert "Exchange hashpartitioning" not in plan(flagged) and flagged.where("f = 1").count() == hits.count()


def test_hot_rows_spread_over_tasks(spark):
    """On the shuffle path no task may receive the rows of a hot key together."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        table = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1).alias("v"))
        found = lookup(skewed(spark), table, "key", "v", broadcast_bytes=0)
        sizes = column(found.groupBy(F.spark_partition_id().alias("p")).count(), "count")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 30_000 and len(sizes) == 4 and max(sizes) < 0.4 * 30_000


def test_lookup_reads_values(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, k string")
    table = spark.createDataFrame([("a", 0.5)], "k string, v double")
    for size in (64 << 20, 0):
        found = {r.i: r.v for r in lookup(rows, table, "k", "v", broadcast_bytes=size).collect()}
        assert found == {1: 0.5, 2: None, 3: None}


def test_unmatched_counts_copies(spark):
    left = spark.createDataFrame([("a", None), ("a", None), ("a", None), ("b", 1.0), ("c", 2.0)], "k string, v double")
    right = spark.createDataFrame([("a", None), ("b", 1.0), ("b", 1.0)], "k string, v double")
    rest = sorted((r.k, r.v) for r in unmatched(left, right).collect())
    assert [k for k, _ in rest] == ["a", "a", "c"]


def test_reason_precedence_and_buckets(spark):
    rows = spark.createDataFrame(
        [(1, 1, 1), (1, 0, 1), (0, 1, 1), (0, 0, 1), (0, 0, 0)],
        "blacklist_flag int, rule_fraud_flag int, is_fraud_detected int")
    assert column(rows.withColumn("r", reason()), "r")[:4] == ["Blacklist", "Blacklist", "Rule", "ML Model"]
    counts = [rows.where(method_is(m)).count() for m in ("blacklist", "rule", "model")]
    assert counts == [2, 1, 1]
    with pytest.raises(ValueError):
        method_is("guess")


def test_rate_bands(spark):
    rates = spark.createDataFrame([(0.0,), (0.99,), (1.0,), (2.49,), (2.5,), (7.0,)], "r double")
    assert column(rates.select(rate_band(F.col("r")).alias("b")), "b") == ["low", "low", "medium", "medium", "high", "high"]


def test_mismatch_counts_missing_as_different(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "a"), (None, None)], "x string, y string")
    assert column(rows.select(mismatch("x", "y").alias("m")), "m") == [0, 1, 1, 1]
