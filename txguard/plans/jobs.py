"""Scheduled jobs: refresh the blacklist, retrain the model, tidy the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.operators.quality import expectation, require
from txguard.plans import blacklist, training
from txguard.sources.lake import RETAIN_HOURS, DeltaTable, LakeTable


def refresh_blacklist(history: DataFrame, path: str, until_step: int | None = None, keep: int = 10) -> DataFrame:
    """Daily: rebuild and verify the list, then drop all but the newest ``keep`` versions."""
    checked = blacklist.refresh(history, path, until_step)
    blacklist.expire(history.sparkSession, path, keep)
    return checked


def retrain(spark: SparkSession, history: DataFrame, root: str, run: str, **options) -> bool:
    """Weekly: check the input, train, save, record the run, promote the model if it is better on today's test rows."""
    require(expectation(history, "history_present", F.count("*"), lambda v: v > 0))
    model, values = training.train(history, **options)
    path = training.save_model(model, root, run)
    training.log_run(spark, root, run, path, values)
    runs = training.read_runs(spark, root)
    require(expectation(runs, "run_recorded", F.count_if(F.col("run") == run), lambda v: v > 0))
    _, test_rows = training.split(training.training_rows(history), options.get("key", "tx_id"))
    return training.promote(spark, root, test_rows=test_rows)


def tidy_lake(tables: list[LakeTable | DeltaTable], sort_by: list[str] | None = None, retain_hours: float = RETAIN_HOURS, *,
              to: str | None = None) -> dict[str, str]:
    """Daily: compact every table; says what was done for each.

    The connector compacts and expires a Delta table itself. Of a Parquet table the closed batches are written together
    below ``to``, with all columns of all batches, and nothing is removed.
    """
    done = {}
    for table in tables:
        if isinstance(table, DeltaTable):
            for command in table.maintenance(retain_hours):
                table.spark.sql(command)
            done[table.path] = "optimized and vacuumed"
            continue
        order = [c for c in sort_by or [] if c in table.read().columns]
        rows, through = table.compact(order, to=to and f"{to}/{table.path.rstrip('/').split('/')[-1]}")
        done[table.path] = f"batches up to {through} in {len(rows.inputFiles())} files"
    return done
