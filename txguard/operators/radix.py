"""The values at given ranks, by counting ever longer prefixes of order-preserving 64-bit keys.

A round counts the rows of each 16-bit digit below the prefixes that the wanted ranks lie in; partial counts are a row for a
digit and task, and no task gathers the rows, or a sketch, of a group. After one or two rounds few rows are left, and these
are counted by their whole key at once; four rounds always do.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard import workspace
from txguard.functions.features import all_of

DIGIT = 16
FEW = 100_000  # rows that are left to a last round by whole keys
BROADCAST_TARGETS = 20_000  # prefixes that are broadcast; more meet the rows in a shuffle

LEAST_NORMAL = 2.0 ** -1022
INFINITE = 0x7FF << 52


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def with_sortable_bits(df: DataFrame, value: Column, name: str = "__key") -> DataFrame:
    """``df`` plus a long ``name`` that orders doubles: the bits of the absolute value, with the sign.

    Both zeros are 0; NaN comes last; null stays. Spark has no function for the bits of a double, so they are put together
    from exponent and fraction; scaling by powers of two is exact. One projection for each step, as each step needs the one
    before several times and an inlined logarithm would be computed as often.
    """
    kept = df.columns
    size, near, ratio = F.col("__size"), F.col("__near"), F.col("__ratio")
    df = df.withColumn("__value", value.cast("double")).withColumn("__size", F.abs("__value"))
    df = df.withColumn("__near", F.least(F.floor(F.log2(size)), F.lit(1023)).cast("int"))  # off by one at most
    df = df.withColumn("__ratio", size / _power(near))
    exponent = near + F.when(ratio >= 2.0, 1).when(ratio < 1.0, -1).otherwise(0)
    fraction = F.when(ratio >= 2.0, ratio / 2.0).when(ratio < 1.0, ratio * 2.0).otherwise(ratio) - 1.0
    normal = (exponent.cast("long") + 1023) * F.lit(1 << 52) + (fraction * float(1 << 52)).try_cast("long")
    tiny = (size * 2.0 ** 537 * 2.0 ** 537).try_cast("long")
    bits = (
        F.when(F.isnan("__value"), F.lit((1 << 63) - 1)).when(size == float("inf"), F.lit(INFINITE))
        .when(size < LEAST_NORMAL, tiny).otherwise(normal))
    df = df.withColumn("__bits", bits)
    return df.select(*kept, F.when(F.col("__value") < 0, -F.col("__bits")).otherwise(F.col("__bits")).alias(name))


def from_bits(key: Column) -> Column:
    """The double of a key of ``with_sortable_bits``."""
    bits = F.abs(key)
    exponent = F.shiftrightunsigned(bits, 52).cast("int")
    fraction = bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    size = (
        F.when(key == (1 << 63) - 1, F.lit(float("nan"))).when(exponent == 0x7FF, F.lit(float("inf")))
        .when(exponent == 0, fraction * 2.0 ** -537 * 2.0 ** -537)
        .otherwise((1.0 + fraction / float(1 << 52)) * _power(exponent - 1023)))
    return F.when(key < 0, -size).otherwise(size)


def _same(left: str, right: str, columns: list[str]) -> Column:
    return all_of([F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _count(rows: DataFrame, groups: list[str], shift: int) -> DataFrame:
    """Rows of each prefix that the key without its last ``shift`` bits gives, below each parent."""
    prefix = F.shiftright("__key", shift).alias("prefix")
    return rows.groupBy(*groups, "parent", prefix).agg(F.count("*").alias("c"), F.min("__key").alias("lo"), F.max("__key").alias("hi"))


def select_ranks(rows: DataFrame, groups: list[str], key: str, wanted: Callable[[Column], Column], few: int = FEW) -> DataFrame:
    """``(*groups, n, rank, below, key)``: for each group its number of rows, and for each wanted rank (from 0) the key there
    and how many rows have a smaller one.

    ``key`` is a column of longs without missing ones (a filter here would be pushed below a computed key and compute it
    twice); ``wanted`` gives an array of longs for a number of rows, ranks outside the group are left out; groups may be
    null. Each round reads the rows once and stores its few targets; a prefix with one key in it needs no more rounds.
    """
    spark = rows.sparkSession
    store = lambda df: workspace.write_table(df, workspace.new_path(spark, "ranks"))
    data = rows.select(*groups, F.col(key).alias("__key"))
    shift = 64 - DIGIT
    counts = store(_count(data.withColumn("parent", F.lit(0).cast("long")), groups, shift))
    sizes = counts.groupBy(*groups).agg(F.sum("c").alias("n"))
    targets = sizes.select(*groups, "n", F.explode(F.array_distinct(wanted(F.col("n")))).alias("rank"))
    targets = targets.where("rank >= 0 AND rank < n").withColumns({"below": F.lit(0).cast("long"), "parent": F.lit(0).cast("long")})
    finished = []
    while True:
        # At most as many digits, or whole keys of few rows, as a window holds.
        order = Window.partitionBy(*groups, "parent").orderBy("prefix")
        before = F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")
        placed = counts.withColumn("before", before)
        found = targets.alias("t").join(placed.alias("p"), _same("t", "p", [*groups, "parent"]))
        inside = (F.col("t.rank") >= F.col("t.below") + F.col("p.before")) & (
            F.col("t.rank") < F.col("t.below") + F.col("p.before") + F.col("p.c"))
        placed = store(found.where(inside).select(
            *[F.col(f"t.{g}").alias(g) for g in groups], "t.n", "t.rank", (F.col("t.below") + F.col("p.before")).alias("below"),
            F.col("p.prefix").alias("parent"), "p.c", "p.lo", "p.hi"))
        finished.append(placed.where("lo = hi").select(*groups, "n", "rank", "below", F.col("lo").alias("key")))
        targets = placed.where("lo < hi")
        parents = targets.groupBy(*groups, "parent").agg(F.max("c").alias("c"))
        many, left = parents.agg(F.count("*"), F.sum("c")).first()
        if not many:
            return reduce(DataFrame.unionByName, finished)
        parents = F.broadcast(parents) if many <= BROADCAST_TARGETS else parents
        at = data.withColumn("parent", F.shiftright("__key", shift))
        within = at.alias("d").join(parents.alias("q"), _same("d", "q", [*groups, "parent"]), "left_semi")
        shift = 0 if left <= few else shift - DIGIT
        counts = store(_count(within, groups, shift))
