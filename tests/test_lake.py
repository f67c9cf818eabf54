"""Lake tables, the relational sink and the blacklist versions."""

import pytest
from conftest import accounts
from pyspark.sql import functions as F

from txguard import workspace
from txguard.plans import blacklist, jobs
from txguard.sources import files, jdbc
from txguard.sources.lake import DeltaTable, LakeTable, delta_available
from txguard.sources.transactions import kafka_options
from txguard.streaming import detection


@pytest.fixture
def table(spark):
    return LakeTable(spark, workspace.new_path(spark, "lake-test"), ["type"])


def rows(spark, low, high):
    return spark.range(low, high).select("id", F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("type"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_append_twice_leaves_one_copy(spark, table):
    table.append(rows(spark, 0, 10), 0)
    table.append(rows(spark, 10, 20), 1)
    table.append(rows(spark, 10, 20), 1)
    assert ids(table.read()) == list(range(20))
    assert ids(table.read(as_of=0)) == list(range(10))


def test_type_is_a_folder_and_prunes(spark, table):
    table.append(rows(spark, 0, 10), 0)
    plan = table.read().where("type = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan


def test_compaction_keeps_rows_and_leaves_the_table(spark, table):
    for i in range(3):
        table.append(rows(spark, 10 * i, 10 * i + 10), i)
    written, through = table.compact(["id"])
    assert through == 1 and ids(written) == list(range(20))  # the newest batch may still be repeated
    assert {r.batch_id for r in written.where("id >= 10").collect()} == {1}
    table.append(rows(spark, 50, 60), 2)
    assert ids(written.unionByName(table.read().where("batch_id > 1"))) == [*range(20), *range(50, 60)]
    assert ids(table.read()) == [*range(20), *range(50, 60)] and ids(table.read(as_of=0)) == list(range(10))
    everything, through = table.compact(keep_open=0)
    assert through == 2 and ids(everything) == ids(table.read())
    assert len(everything.inputFiles()) <= 2  # one for each type


def test_a_repeat_replaces_its_batch_also_with_nothing(spark, table):
    table.append(rows(spark, 0, 10), 0)
    table.append(rows(spark, 10, 20), 1)
    table.append(rows(spark, 12, 13), 1)  # one type only: the other one's folder goes
    assert ids(table.read()) == [*range(10), 12]
    table.append(rows(spark, 0, 0), 1)
    assert ids(table.read()) == list(range(10))


def test_schema_evolves_and_survives_compaction(spark):
    """A column that a later batch adds, and one that a declared schema does not know."""
    known = spark.range(1).schema
    table = LakeTable(spark, workspace.new_path(spark, "lake-test"), schema=known)
    table.append(spark.range(2), 0)
    table.append(spark.range(2, 4).withColumn("note", F.lit("x")), 1)
    table.append(spark.range(4, 5), 2)
    want = {0: None, 1: None, 2: "x", 3: "x"}
    assert {r.id: r.note for r in table.read().collect()} == {**want, 4: None}
    written, _ = table.compact()
    assert written.columns == ["id", "note", "batch_id"] and {r.id: r.note for r in written.collect()} == want


def test_scored_rows_keep_the_model_columns(spark, tmp_path):
    """Tables are tidied without knowing that a model had been at work."""
    root = workspace.new_path(spark, "lake-test")
    scored = spark.createDataFrame([("A", 1, 0.9, "Model"), ("B", 0, 0.1, None)], "type string, ml_fraud_flag int, ml_probability double, reason string")
    for batch_id in range(3):
        for table in detection.lake_tables(spark, root, with_model=True):
            table.append(scored, batch_id)
    done = jobs.tidy_lake(detection.lake_tables(spark, root), ["ingested_at", "ml_probability"], to=f"{root}/tidy")
    assert sorted(p.split("/")[-1] for p in done) == ["fraud_transactions", "quarantine", "transactions"]
    for name in ("transactions", "fraud_transactions", "quarantine"):
        for path, n in ((f"{root}/tidy/{name}", 4), (f"{root}/{name}", 6)):
            found = spark.read.parquet(path)
            assert {"ml_fraud_flag", "ml_probability", "reason"} <= set(found.columns)
            assert found.count() == n and found.where("ml_probability IS NULL").isEmpty()


def test_delta_tables_hand_over_to_the_connector(spark, monkeypatch):
    table = DeltaTable(spark, "s3a://lake/transactions", ["type"])
    assert table.append_options(7) == {"mergeSchema": "true", "txnAppId": "s3a://lake/transactions", "txnVersion": "7"}
    assert table.maintenance(24) == ["OPTIMIZE delta.`s3a://lake/transactions`", "VACUUM delta.`s3a://lake/transactions` RETAIN 24 HOURS"]
    with pytest.raises(ValueError, match="connector"):
        detection.lake_tables(spark, "root", kind="delta")
    monkeypatch.setattr("txguard.sources.lake.delta_available", lambda _: True)
    assert {type(t) for t in detection.lake_tables(spark, "root", kind="delta")} == {DeltaTable}


def test_a_table_without_files(spark):
    table = LakeTable(spark, workspace.new_path(spark, "lake-test"), schema=rows(spark, 0, 1).schema)
    assert table.read().columns == ["id", "type", "batch_id"] and table.read().count() == 0
    written, through = table.compact()
    assert through == -1 and written.count() == 0


def test_empty_table_is_an_error(table):
    with pytest.raises(ValueError):
        table.read()


def test_delta_is_optional(spark):
    assert delta_available(spark) is False


def test_relational_retry_writes_only_the_rest(spark):
    batch = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", None), ("c", 3.0)], "k string, v double")
    first = jdbc.rows_to_write(batch, 7, None)
    assert first.count() == 4 and {r.batch_id for r in first.collect()} == {7}
    other = spark.createDataFrame([("a", 1.0, 6)], "k string, v double, batch_id long")
    assert jdbc.rows_to_write(batch, 7, other).count() == 4
    partial = other.union(spark.createDataFrame([("a", 1.0, 7), ("b", None, 7)], "k string, v double, batch_id long"))
    assert sorted(r.k for r in jdbc.rows_to_write(batch, 7, partial).collect()) == ["a", "c"]
    assert jdbc.rows_to_write(batch, 7, first).isEmpty()


def test_kafka_options_do_not_skip_data():
    options = kafka_options("host:1", "topic", per_trigger=100)
    assert options["failOnDataLoss"] == "true" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "100" and options["subscribe"] == "topic"


def listed(df):
    return sorted(r.account for r in df.collect())


def test_blacklist_versions(spark, tx):
    path = workspace.new_path(spark, "blacklist-test")
    assert listed(blacklist.read(spark, path)) == []
    history = tx({"nameOrig": "A", "isFraud": 1}, {"nameOrig": "A", "isFraud": 1}, {"nameOrig": "B", "isFraud": 1, "step": 9},
                 {"nameOrig": "C"}, {"nameOrig": None, "isFraud": 1})
    assert listed(blacklist.build(history)) == ["A", "B"] and listed(blacklist.build(history, 8)) == ["A"]
    first = blacklist.publish(blacklist.build(history, 8), path)
    assert listed(blacklist.publish(accounts(spark, "X", "A"), path, mode="append")) == ["A", "X"]
    assert listed(blacklist.publish(accounts(spark, "B"), path)) == ["B"]
    assert listed(first) == ["A"]  # whoever opened the old version can still read it
    files.remove(spark, f"{path}/version=3/_SUCCESS")
    assert listed(blacklist.read(spark, path)) == ["A", "X"]
    changes = {(r.account, r.change) for r in blacklist.difference(accounts(spark, "A", "B"), accounts(spark, "B", "C")).collect()}
    assert changes == {("A", "removed"), ("C", "added")}


def test_refresh_refuses_an_empty_list(spark, tx):
    path = workspace.new_path(spark, "blacklist-test")
    with pytest.raises(RuntimeError, match="blacklist_not_empty"):
        jobs.refresh_blacklist(tx({}), path)
    with pytest.raises(RuntimeError, match="history_present"):
        jobs.refresh_blacklist(tx({}).limit(0), path)
    assert jobs.refresh_blacklist(tx({"isFraud": 1}), path).count() == 2


def test_refresh_drops_old_versions(spark, tx):
    path = workspace.new_path(spark, "blacklist-test")
    for _ in range(4):
        jobs.refresh_blacklist(tx({"isFraud": 1}), path, keep=2)
    assert blacklist.versions(spark, path) == [3, 4]
