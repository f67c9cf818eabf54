"""Exploration of labelled history: class balance, rates, distributions, rule quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.functions.features import balance_ratio, fraud_label, indicator, is_risky_type
from txguard.functions.rules import drain_rule
from txguard.operators.histogram import histogram
from txguard.operators.quantiles import exact_quantiles
from txguard.schema import BOX_PLOT_LIMIT, RESIDUAL_FEATURES

_FRAUD = "isFraud = 1"


def class_counts(df: DataFrame) -> DataFrame:
    """Fraud and normal rows and their ratio (null without fraud), in one pass."""
    counted = df.agg(
        F.count_if(F.col("isFraud") == 1).alias("fraud_count"),
        F.count_if(F.col("isFraud") == 0).alias("normal_count"))
    return counted.withColumn("ratio", F.try_divide("normal_count", "fraud_count"))


def with_class_weight(df: DataFrame, ratio: float | None = None) -> DataFrame:
    """``classWeight``: the imbalance ratio for fraud, 1 for the rest. The ratio is that of ``df`` unless given."""
    ratio = class_counts(df).select("ratio").scalar() if ratio is None else F.lit(float(ratio))
    return df.withColumn("classWeight", (F.col("isFraud") * (ratio - 1) + 1).cast("double"))


def rate_by(df: DataFrame, key: str) -> DataFrame:
    """Rows, fraud rows and fraud rate per value of ``key``, highest rate first."""
    return df.groupBy(key).agg(
        F.count("*").alias("count"), F.sum("isFraud").alias("fraud_count"), F.avg("isFraud").alias("fraud_rate")
    ).orderBy(F.desc("fraud_rate"), key)


def full_totals(df: DataFrame) -> DataFrame:
    """Whole-table totals in long form ``(kind, name, n, percent)``: per label, per type, and all rows.

    One aggregation by label and type feeds all three.
    """
    cells = df.groupBy("isFraud", "type").agg(F.count("*").alias("n"))
    total = cells.agg(F.sum("n").alias("n"))
    by_label = cells.groupBy(F.col("isFraud").cast("string").alias("name")).agg(F.sum("n").alias("n"))
    by_type = cells.groupBy(F.col("type").alias("name")).agg(F.sum("n").alias("n"))
    everything = (
        by_label.withColumn("kind", F.lit("label"))
        .unionByName(by_type.withColumn("kind", F.lit("type")))
        .unionByName(total.select(F.lit("all").alias("name"), "n", F.lit("rows").alias("kind")))
    )
    return everything.select(
        "kind", "name", "n", (F.col("n") / total.scalar() * 100).alias("percent")).orderBy("kind", F.desc("n"), "name")


def rule_confusion(df: DataFrame) -> DataFrame:
    """How the drain rule does on risky types: fraud, caught, missed, wrongly caught, catch rate in percent."""
    judged = df.where(is_risky_type()).withColumn("caught", drain_rule())
    fraud, hit = F.col("isFraud") == 1, F.col("caught") == 1
    counted = judged.agg(
        F.count_if(fraud).alias("total_fraud"),
        F.count_if(fraud & hit).alias("caught_fraud"),
        F.count_if(fraud & ~hit).alias("missed_fraud"),
        F.count_if((F.col("isFraud") == 0) & hit).alias("false_positives"),
    )
    return counted.withColumn("catch_rate", F.try_divide("caught_fraud", "total_fraud") * 100)


def rule_residual(df: DataFrame) -> DataFrame:
    """Risky transactions the rule lets pass."""
    return df.where(is_risky_type()).withColumn("is_caught_by_rule", drain_rule()).where("is_caught_by_rule = 0")


def amount_histogram(df: DataFrame, bins: int = 60, log: bool = False) -> DataFrame:
    """Amounts by class; ``log`` cuts log10 of the positive amounts instead."""
    value = F.when(F.col("amount") > 0, F.log10("amount")) if log else F.col("amount")
    return histogram(df, value, fraud_label(), bins)


def step_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(df, F.col("step"), fraud_label(), bins).drop("density")


def ratio_density(df: DataFrame, bins: int = 60) -> DataFrame:
    """Density of the amount-to-balance ratio on [0, 3] by class."""
    return histogram(df, balance_ratio(), fraud_label(), bins, low=0.0, high=3.0)


def box_stats(detected: DataFrame, limit: float = BOX_PLOT_LIMIT) -> DataFrame:
    """Five-number summary of amounts below ``limit`` by verdict, from all rows."""
    small = detected.where(F.col("amount") < limit)
    names = {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"}
    return (
        exact_quantiles(small, ["is_fraud_detected"], "amount", list(names))
        .groupBy("is_fraud_detected")
        .agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name) for p, name in names.items()])
    )


def labelled_residual(df: DataFrame) -> DataFrame:
    """Training rows for the residual model: normal rows the rule lets pass plus all fraud it misses, as one set."""
    rest = rule_residual(df).select(*RESIDUAL_FEATURES, "isFraud")
    return rest.where("isFraud = 0").unionByName(rest.where(_FRAUD)).withColumn("isFraud", indicator(F.expr(_FRAUD)))
