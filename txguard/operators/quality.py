"""Record contracts: each rule is a name and a condition; rows carry the names they broke."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.schema import ALL_TYPES, AMOUNT_LIMIT, NAME_MAX, NAME_MIN, RECORD_DEFAULTS, STEP_MAX, STEP_MIN

# Fixed value: characters of an account id. A single final line feed passes, as in the original check.
ACCOUNT_PATTERN = r"\A[A-Za-z0-9_\-]+\n?\z"


def valid_amount(amount: Column) -> Column:
    """Strictly between 0 and the limit; a missing amount is not valid."""
    return F.coalesce((amount > 0) & (amount < AMOUNT_LIMIT), F.lit(False))


def _account_rules(name: str) -> dict[str, Column]:
    column = F.col(name)
    return {
        f"{name}_length": F.length(column).between(NAME_MIN, NAME_MAX),
        f"{name}_characters": column.rlike(ACCOUNT_PATTERN),
    }


def submitted_record_rules() -> dict[str, Column]:
    """Contract of a record handed in from outside, checked after ``with_defaults``."""
    balances = ["oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
    return {
        "step_range": F.col("step").between(STEP_MIN, STEP_MAX),
        "type_known": F.col("type").isin(ALL_TYPES),
        "amount_range": valid_amount(F.col("amount")),
        **_account_rules("nameOrig"),
        **_account_rules("nameDest"),
        **{f"{b}_not_negative": F.col(b) >= 0 for b in balances},
        **{f"{f}_flag": F.col(f).isin(0, 1) for f in ("isFraud", "isFlaggedFraud")},
    }


def table_rules() -> dict[str, Column]:
    """Constraints of the stored table; like a CHECK, a negative amount fails and a missing one is NOT NULL's."""
    required = ["type", "amount", "nameOrig", "nameDest"]
    return {
        **{f"{c}_present": F.col(c).isNotNull() for c in required},
        "amount_not_negative": F.coalesce(F.col("amount") >= 0, F.lit(True)),
    }


def with_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fill what a record left out."""
    defaults = RECORD_DEFAULTS if defaults is None else defaults
    present = {c: v for c, v in defaults.items() if c in df.columns}
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in present.items()})


def check(df: DataFrame, rules: dict[str, Column], name: str = "failed_rules") -> DataFrame:
    """Column ``name``: the sorted names of broken rules; a condition that is unknown counts as broken."""
    broken = [F.when(F.coalesce(~ok, F.lit(True)), F.lit(rule)) for rule, ok in sorted(rules.items())]
    return df.withColumn(name, F.array_compact(F.array(*broken)))


def valid_rows(checked: DataFrame, name: str = "failed_rules") -> DataFrame:
    return checked.where(F.size(name) == 0).drop(name)


def quarantined_rows(checked: DataFrame, name: str = "failed_rules") -> DataFrame:
    """Broken rows with the rule names as one text."""
    return checked.where(F.size(name) > 0).withColumn(name, F.concat_ws(",", name))


def expectation(df: DataFrame, name: str, value: Column, passed) -> DataFrame:
    """One row ``(name, passed, value)`` from an aggregate of ``df``; ``passed`` maps the value to a condition."""
    return df.agg(value.cast("double").alias("value")).select(
        F.lit(name).alias("name"), passed(F.col("value")).alias("passed"), "value")


def require(expectations: DataFrame) -> None:
    """Stop the job when an expectation does not hold."""
    failed = [row["name"] for row in expectations.where(~F.coalesce("passed", F.lit(False))).select("name").collect()]
    if failed:
        raise RuntimeError(f"expectations failed: {', '.join(sorted(failed))}")
