"""Blacklist, rule and model combined into one verdict."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.functions.features import indicator, is_risky_type, stream_features, training_features
from txguard.functions.rules import drain_rule, reason, verdict
from txguard.operators.lookup import flag_members


def blacklist_flag(df: DataFrame, blacklist: DataFrame, sides: str = "sender", **options) -> DataFrame:
    """``blacklist_flag``: the sender, or with ``sides="both"`` sender or receiver, is listed."""
    if sides not in ("sender", "both"):
        raise ValueError(f"sides must be 'sender' or 'both', not {sides!r}")
    return flag_members(df, blacklist, ["nameOrig", "nameDest"][:1 if sides == "sender" else 2], "blacklist_flag", **options)


def detect(df: DataFrame, blacklist: DataFrame, sides: str = "sender", **options) -> DataFrame:
    """Features, both flags and ``is_fraud_detected`` for every transaction."""
    flagged = blacklist_flag(stream_features(df), blacklist, sides, **options)
    return flagged.withColumn("rule_fraud_flag", drain_rule()).withColumn(
        "is_fraud_detected", verdict("rule_fraud_flag", "blacklist_flag"))


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """``ml_fraud_flag`` 0/1 and ``ml_probability``; only the types the model was trained on can be flagged."""
    kept = df.columns
    scored = model.transform(training_features(df))
    positive = is_risky_type() & (F.col("prediction") == 1.0)
    return scored.select(
        *kept,
        indicator(positive).alias("ml_fraud_flag"),
        vector_to_array("probability")[1].alias("ml_probability"),
    )


def detect_with_model(df: DataFrame, blacklist: DataFrame, model: PipelineModel, **options) -> DataFrame:
    """Three layers: the two of ``detect`` and the classifier, with the reason of each flagged row."""
    scored = score(detect(df, blacklist, **options), model)
    return scored.withColumn(
        "is_fraud_detected", verdict("is_fraud_detected", "ml_fraud_flag")
    ).withColumn("reason", F.when(F.col("is_fraud_detected") == 1, reason()))
