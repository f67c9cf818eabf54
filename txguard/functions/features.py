"""Derived columns of a transaction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.schema import DEST_TOLERANCE, LARGE_AMOUNT, RISKY_TYPES


def indicator(condition: Column) -> Column:
    """0/1 column; an unknown condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def balance_ratio() -> Column:
    """Amount over the old balance; 0.0 when the old balance is zero, negative or missing."""
    return F.when(F.col("oldbalanceOrg") > 0, F.try_divide("amount", "oldbalanceOrg")).otherwise(F.lit(0.0))


def _diffs() -> dict[str, Column]:
    return {
        "balance_diff_orig": F.col("newbalanceOrig") - F.col("oldbalanceOrg"),
        "balance_diff_dest": F.col("newbalanceDest") - F.col("oldbalanceDest"),
    }


def is_risky_type() -> Column:
    return F.col("type").isin(RISKY_TYPES)


def stream_features(df: DataFrame) -> DataFrame:
    """The four columns detection adds before any verdict."""
    return df.withColumns(
        {
            **_diffs(),
            "is_transfer_or_cashout": indicator(is_risky_type()),
            "amount_to_balance_ratio": balance_ratio(),
        }
    )


def training_features(df: DataFrame) -> DataFrame:
    """The eight numeric columns the classifier is trained on, next to the raw ones."""
    dest_gap = F.abs(F.col("newbalanceDest") - F.col("oldbalanceDest") - F.col("amount"))
    return df.withColumns(
        {
            **_diffs(),
            "amount_ratio_orig": balance_ratio(),
            "zero_balance_after": zero_balance_after(),
            "drain_ratio": balance_ratio(),
            "dest_balance_anomaly": indicator((F.col("amount") > 0) & (dest_gap > DEST_TOLERANCE)),
            "dest_is_merchant": indicator(F.col("nameDest").startswith("M")),
            "is_large_transaction": indicator(F.col("amount") > LARGE_AMOUNT),
        }
    )


def zero_balance_after(strict: bool = False) -> Column:
    """New balance is zero; ``strict`` also asks for money in the account before."""
    emptied = F.col("newbalanceOrig") == 0
    return indicator(emptied & (F.col("oldbalanceOrg") > 0) if strict else emptied)


def finite_or_zero(name: str) -> Column:
    """Infinite, NaN and missing values become 0."""
    value = F.col(name)
    broken = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.coalesce(F.when(broken, F.lit(0.0)).otherwise(value), F.lit(0.0))


def eda_features(df: DataFrame) -> DataFrame:
    """Feature set of the exploration step: repaired differences and ratio, strict zero-balance flag."""
    derived = df.withColumns(
        {
            **_diffs(),
            "amount_to_oldbalance_ratio": balance_ratio(),
            "zero_balance_after": zero_balance_after(strict=True),
        }
    )
    repaired = ["balance_diff_orig", "balance_diff_dest", "amount_to_oldbalance_ratio"]
    return derived.withColumns({name: finite_or_zero(name) for name in repaired})


def mismatch(left: str, right: str) -> Column:
    """1 when two columns differ; a missing value on either side counts as a difference."""
    return F.coalesce(F.col(left) != F.col(right), F.lit(True)).cast("int")


def fraud_label(flag: str = "isFraud") -> Column:
    return F.when(F.col(flag) == 1, F.lit("Fraud")).otherwise(F.lit("Non-fraud"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
