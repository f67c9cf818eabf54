"""All jobs in a row from the command line: history to blacklist, messages, model, detection, tidy lake."""

import pytest

from txguard import workspace
from txguard.__main__ import main, parser
from txguard.plans import blacklist, training
from txguard.plans.detection import detect_with_model
from txguard.schema import SCORED_SCHEMA, TX_COLUMNS
from txguard.sources.lake import LakeTable
from txguard.sources.transactions import from_events, read_csv

FOLDER = "/root/testdata/sf0.001"


def test_jobs_work_together(spark, capsys):
    root = workspace.new_path(spark, "jobs-test")
    tx = from_events(spark.read.parquet(f"{FOLDER}/events.parquet")).select(TX_COLUMNS)
    tx.write.option("header", True).csv(f"{root}/history")
    history = ["--history", f"{root}/history"]
    main(["blacklist", *history, "--to", f"{root}/blacklist", "--until-step", "360"])
    main(["publish", *history, "--to", f"{root}/messages"])
    main(["train", *history, "--registry", f"{root}/registry", "--run", "week-1", "--trees", "3", "--depth", "3"])
    assert "promoted" in capsys.readouterr().out
    main(["detect", "--messages", f"{root}/messages", "--blacklist", f"{root}/blacklist", "--root", f"{root}/lake",
          "--checkpoint", f"{root}/checkpoint", "--registry", f"{root}/registry", "--once"])
    main(["tidy", "--root", f"{root}/lake", "--to", f"{root}/tidy"])

    columns = [c for c in SCORED_SCHEMA.names if c != "ingested_at"]
    stored = LakeTable(spark, f"{root}/lake/transactions", ["type"], SCORED_SCHEMA).read().select(columns)
    risky = read_csv(spark, f"{root}/history").where("type IN ('TRANSFER', 'CASH_OUT')")
    expected = detect_with_model(
        risky, blacklist.read(spark, f"{root}/blacklist"), training.champion_model(spark, f"{root}/registry")).select(columns)
    assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty()
    assert LakeTable(spark, f"{root}/lake/fraud_transactions").read().where("is_fraud_detected <> 1").isEmpty()


def test_tidy_of_parquet_needs_a_target():
    with pytest.raises(SystemExit):
        main(["tidy", "--root", "r"])


def test_detection_needs_a_checkpoint():
    with pytest.raises(SystemExit):
        parser().parse_args(["detect", "--messages", "m", "--blacklist", "b", "--root", "r"])
