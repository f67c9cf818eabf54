"""Samples that do not depend on how rows are spread over partitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.operators.radix import FEW, from_bits, select_ranks, with_sortable_bits


HASHES = 1 << 60


def hash_order(seed: int, *keys: str) -> Column:
    """A reproducible pseudo-random order of rows identified by ``keys``: 60 bits of an MD5, which other engines have too."""
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def nth_smallest(df: DataFrame, key: str, n: int, few: int = FEW):
    """The ``n``-th smallest value of ``key``, a number, and how many rows are below it; None when there are fewer values.

    Found by counting key prefixes (``radix``): as a rule three passes over that one column.
    """
    fraction = df.schema[key].dataType.typeName() in ("float", "double", "decimal")
    keys = df.select(F.col(key).alias("__v")).where("__v IS NOT NULL")
    keyed = with_sortable_bits(keys, F.col("__v")) if fraction else keys.select(F.col("__v").cast("long").alias("__key"))
    found = select_ranks(keyed, [], "__key", lambda _: F.array(F.lit(n - 1).cast("long")), few)
    row = found.select((from_bits(F.col("key")) if fraction else F.col("key")).alias("key"), "below").first()
    return None if row is None else (row["key"], row["below"])


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows with the smallest ``key``, a number that (nearly) tells rows apart; missing keys come last.

    ``orderBy().limit(n)`` sends up to ``n`` rows of every partition to one task. Here the ``n``-th value is found by
    counting, and the rows below it pass a filter where they are; only ties at that value, or missing keys, are cut by a
    limit. The rows come in no order.
    """
    found = nth_smallest(df, key, n)
    if found is None:
        missing = n - df.where(F.col(key).isNotNull()).count()
        return df.where(F.col(key).isNotNull()).unionByName(df.where(F.col(key).isNull()).limit(missing))
    value, below = found
    return df.where(F.col(key) < value).unionByName(df.where(F.col(key) == value).limit(n - below))


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows without replacement: those with the smallest hashes of ``keys``."""
    return first_rows(df.withColumn("__hash", hash_order(seed, *keys)), n, "__hash").drop("__hash")


def sample_fraction(df: DataFrame, fraction: float, *, replace: bool = False, seed: int = 42) -> DataFrame:
    """Bernoulli (or with replacement, Poisson) sample: one narrow pass."""
    return df.sample(withReplacement=replace, fraction=fraction, seed=seed)


def poisson_bounds(mean: float) -> list[int]:
    """Hash values, of 60 bits, from which on a row is drawn at least 1, 2, ... times at that mean."""
    bounds, upto, share = [], math.exp(-mean), math.exp(-mean)
    while (bound := math.ceil(upto * HASHES)) < HASHES and len(bounds) < 1000:
        bounds.append(bound)
        share *= mean / len(bounds)
        if share * HASHES < 1 and len(bounds) > mean:
            break
        upto += share
    return bounds


def draw_counts(hashed: Column, mean: float) -> Column:
    """How often a row is drawn: Poisson distributed, by the inverse distribution function of its hash."""
    return sum((F.when(hashed >= bound, 1).otherwise(0) for bound in poisson_bounds(mean)), F.lit(0))


def sample_with_replacement(df: DataFrame, fraction: float, keys: list[str], seed: int = 42) -> DataFrame:
    """About ``fraction`` times as many rows as ``df``, each drawn on its own and perhaps several times.

    The number of copies of a row follows from its ``keys`` and the seed alone, so the sample is the same however the rows
    are spread and whichever task is run again. One narrow pass.
    """
    if not 0 < fraction <= 100:
        raise ValueError("fraction must be above 0 and at most 100")
    times = draw_counts(hash_order(seed, *keys), fraction)
    drawn = df.withColumn("__times", times).where("__times > 0")
    return drawn.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(df.columns)


def split_by_id(df: DataFrame, key: str, train_tenths: int = 8) -> DataFrame:
    """Column ``split``: ``train`` or ``test`` by the id alone, so reruns and repartitions agree."""
    return df.withColumn(
        "split", F.when(F.pmod(F.col(key), F.lit(10)) < train_tenths, F.lit("train")).otherwise(F.lit("test")))
