"""Random forest training, evaluation, run records and promotion."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard import workspace
from txguard.functions.features import is_risky_type, training_features
from txguard.operators.sampling import split_by_id
from txguard.plans.exploration import class_counts, rule_residual, with_class_weight
from txguard.plans.ranking import ranking_metrics
from txguard.schema import FEATURE_COLUMNS, RESIDUAL_FEATURES, TX_SCHEMA
from txguard.sources import files

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def training_rows(history: DataFrame) -> DataFrame:
    """Risky transactions with all features and the class weight.

    The ratio behind the weight is fetched once; fitting passes over these rows several times.
    """
    risky = history.where(is_risky_type())
    ratio = class_counts(risky).first()["ratio"]
    if ratio is None:
        raise ValueError("no fraud among the risky transactions to train on")
    return with_class_weight(training_features(risky), ratio)


def pipeline(trees: int = 100, depth: int = 10, seed: int = 42) -> Pipeline:
    """Index the type, assemble 14 columns, standardise, fit a weighted forest.

    Index order is by name, not by frequency, so a retrain on other data keeps the meaning of the column;
    types that were not trained on get an index of their own.
    """
    numbers = [c for c in FEATURE_COLUMNS if c != "type_idx"]
    return Pipeline(stages=[
        StringIndexer(inputCol="type", outputCol="type_idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
        _filled(numbers),
        VectorAssembler(inputCols=[c if c == "type_idx" else f"filled_{c}" for c in FEATURE_COLUMNS], outputCol="raw_features",
                        handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        _forest(trees, depth, seed, weight="classWeight"),
    ])


def _filled(columns: list[str]) -> SQLTransformer:
    """Adds ``filled_`` copies of columns, missing and NaN values as 0; part of the model, so scoring does the same."""
    copies = ", ".join(f"coalesce(nanvl(CAST({c} AS DOUBLE), 0D), 0D) AS filled_{c}" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {copies} FROM __THIS__")


def _forest(trees: int, depth: int, seed: int, weight: str | None = None) -> RandomForestClassifier:
    """Every row's node in every tree is kept between levels; else each level walks all trees from the root for each row.

    The trees are the same either way. A lost part is computed again from at most ``depth`` steps, so nothing is checkpointed.
    """
    forest = RandomForestClassifier(
        labelCol="isFraud", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True,
        checkpointInterval=-1)
    return forest.setWeightCol(weight) if weight else forest


def split(rows: DataFrame, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """80/20 by the id where there is one, else by a hash of the record: the same rows on any cluster."""
    if key is None:
        record = [f.name for f in TX_SCHEMA.fields if f.name in rows.columns] or rows.columns
        of_record = F.pmod(F.xxhash64(*record), F.lit(10))
        return rows.where(of_record < 8), rows.where(of_record >= 8)
    marked = split_by_id(rows, key)
    return marked.where("split = 'train'").drop("split"), marked.where("split = 'test'").drop("split")


def formatted_plan(df: DataFrame) -> str:
    """The physical plan as text, to log next to a run."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def confusion(predictions: DataFrame) -> DataFrame:
    """Counts by label and prediction: at most four rows, one pass."""
    return predictions.groupBy(F.col("isFraud").cast("double").alias("label"), "prediction").agg(
        F.count("*").alias("n"))


def metrics(predictions: DataFrame) -> dict[str, float]:
    """AUPRC, AUC-ROC and the weighted F1, precision and recall, next to those of the fraud class alone.

    Takes ``isFraud``, ``prediction`` and ``score``; pass a stored table. The areas are exact (``ranking``), 0 where a class
    is missing. The weighted numbers are dominated by the normal class, so the fraud class is reported by itself too.
    """
    cells = {(r["label"], r["prediction"]): r["n"] for r in confusion(predictions).collect()}
    total = sum(cells.values()) or 1
    areas = ranking_metrics(predictions).first()
    result = {name: areas[name] or 0.0 for name in ("auprc", "auc_roc")}
    weighted = {"f1_score": 0.0, "precision": 0.0, "recall": 0.0}
    for label in (0.0, 1.0):
        hit = cells.get((label, label), 0)
        actual = sum(n for (of, _), n in cells.items() if of == label)
        called = sum(n for (_, to), n in cells.items() if to == label)
        precision, recall = hit / called if called else 0.0, hit / actual if actual else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        for name, value in (("f1_score", f1), ("precision", precision), ("recall", recall)):
            weighted[name] += value * actual / total
            if label == 1.0:
                result[f"fraud_{name}"] = value
    return {**result, **weighted}


def evaluate(model: PipelineModel, rows: DataFrame) -> dict[str, float]:
    """Metrics of a model on rows with features; its predictions are stored once for all of them."""
    predictions = model.transform(rows).select("isFraud", "prediction", vector_to_array("rawPrediction")[1].alias("score"))
    return metrics(workspace.write_table(predictions, workspace.new_path(rows.sparkSession, "predictions")))


def _stored(rows: DataFrame) -> DataFrame:
    """``rows`` in a table with a file for each core: fitting passes over them several times, and on all cores.

    The work of a pass is per row and tree, so neither how the source is cut nor how few bytes the rows take may say how many
    tasks share it.
    """
    spark = rows.sparkSession
    return workspace.write_table(rows.repartition(spark.sparkContext.defaultParallelism), workspace.new_path(spark, "features"))


def stored_rows(history: DataFrame) -> DataFrame:
    """The training rows with all features, stored."""
    return _stored(training_rows(history))


def train(history: DataFrame, *, key: str | None = "tx_id", trees: int = 100, depth: int = 10,
          seed: int = 42) -> tuple[PipelineModel, dict[str, float]]:
    """Fit on 80 % and evaluate on 20 %."""
    train_rows, test_rows = split(stored_rows(history), key)
    model = pipeline(trees, depth, seed).fit(train_rows)
    return model, evaluate(model, test_rows)


def importance(model: PipelineModel, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Features by importance; as many rows as the model has inputs."""
    spark = SparkSession.active()
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(name, float(v)) for name, v in zip(columns, values)], "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")


def train_residual(history: DataFrame, *, trees: int = 100, depth: int = 10, seed: int = 42) -> PipelineModel:
    """Forest on what the rule misses, over the six raw columns."""
    rows = _stored(rule_residual(history).select(*RESIDUAL_FEATURES, "isFraud").na.fill(0.0, RESIDUAL_FEATURES))
    return Pipeline(stages=[
        VectorAssembler(inputCols=RESIDUAL_FEATURES, outputCol="features"), _forest(trees, depth, seed)]).fit(rows)


def save_model(model: PipelineModel, root: str, run: str) -> str:
    """Each run has its own path, so a retrain never collides with the model in use."""
    path = f"{root}/model/{run}"
    model.write().overwrite().save(path)
    return path


def log_run(spark: SparkSession, root: str, run: str, model_path: str, values: dict[str, float],
            status: str = "FINISHED", at: dt.datetime | None = None) -> None:
    """Append one row per metric to the run table; the same run and status again replaces its rows."""
    at = at or dt.datetime.now()
    rows = [(run, status, at, model_path, name, float(v)) for name, v in values.items()]
    spark.createDataFrame(rows, RUNS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/runs/entry={run}-{status}")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    if not files.folders(spark, f"{root}/runs"):
        return spark.createDataFrame([], RUNS_SCHEMA)
    return spark.read.schema(RUNS_SCHEMA).parquet(f"{root}/runs/*")


def latest_run(runs: DataFrame, status: str = "FINISHED") -> DataFrame:
    """Metrics of the newest run with this status."""
    done = runs.where(F.col("status") == status)
    newest = done.agg(F.max(F.struct("finished_at", "run")).alias("newest"))
    return done.where(F.struct("finished_at", "run") == newest.scalar()).select("run", "model_path", "metric", "value")


def promote(spark: SparkSession, root: str, metric: str = "fraud_f1_score", test_rows: DataFrame | None = None) -> bool:
    """Make the newest finished run the champion if it beats the current one; says whether it did.

    With ``test_rows`` (training rows with features) both models are measured on these; else the recorded values count.
    The fraud class decides by default, since the weighted score is dominated by the normal class.
    """
    runs = read_runs(spark, root)

    def best(status: str):
        return latest_run(runs, status).where(F.col("metric") == metric).first()

    def value(row) -> float:
        return evaluate(PipelineModel.load(row["model_path"]), test_rows)[metric] if test_rows is not None else row["value"]

    challenger, champion = best("FINISHED"), best("PROMOTED")
    if challenger is None or (champion is not None and (
            champion["run"] == challenger["run"] or value(challenger) <= value(champion))):
        return False
    log_run(spark, root, challenger["run"], challenger["model_path"], {metric: challenger["value"]}, "PROMOTED")
    return True


def champion_path(spark: SparkSession, root: str) -> str | None:
    """Where the promoted model lies."""
    row = latest_run(read_runs(spark, root), "PROMOTED").select("model_path").first()
    return row["model_path"] if row else None


def champion_model(spark: SparkSession, root: str) -> PipelineModel | None:
    path = champion_path(spark, root)
    return PipelineModel.load(path) if path else None
