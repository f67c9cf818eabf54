"""Rule, verdict and reason expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txguard.functions.features import any_of, indicator, is_risky_type
from txguard.schema import DRAIN_HIGH, DRAIN_LOW, RATE_BANDS


def drain_rule() -> Column:
    """1 when a risky transaction empties an account with an amount close to its old balance.

    ``try_divide`` keeps the ratio null, not an error, for a zero balance: Spark does not promise the
    order in which the conjuncts run.
    """
    ratio = F.try_divide("amount", "oldbalanceOrg")
    return indicator(
        is_risky_type()
        & (F.col("newbalanceOrig") == 0)
        & (F.col("oldbalanceOrg") > 0)
        & ratio.between(DRAIN_LOW, DRAIN_HIGH)
    )


def verdict(*flags: str) -> Column:
    """1 when any of the 0/1 flags is set."""
    return indicator(any_of([F.col(flag) == 1 for flag in flags]))


def reason(blacklist: str = "Blacklist", rule: str = "Rule", model: str = "ML Model") -> Column:
    """Why a row was flagged; the blacklist outranks the rule, the rule outranks the model."""
    return (
        F.when(F.col("blacklist_flag") == 1, F.lit(blacklist))
        .when(F.col("rule_fraud_flag") == 1, F.lit(rule))
        .otherwise(F.lit(model))
    )


def method_is(name: str) -> Column:
    """Exclusive detection-method bucket: a row is in at most one of ``blacklist``, ``rule``, ``model``."""
    listed = F.col("blacklist_flag") == 1
    ruled = F.col("rule_fraud_flag") == 1
    buckets = {
        "blacklist": listed,
        "rule": ruled & ~listed,
        "model": (F.col("is_fraud_detected") == 1) & ~listed & ~ruled,
    }
    if name not in buckets:
        raise ValueError(f"unknown detection method {name!r}")
    return buckets[name]


def rate_band(rate: Column) -> Column:
    """Severity of a fraud rate in percent."""
    low, high = RATE_BANDS
    return F.when(rate < low, F.lit("low")).when(rate < high, F.lit("medium")).otherwise(F.lit("high"))
