"""Left lookups and membership flags that hold up when the list is large or one key is hot."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.functions.features import all_of
from txguard.operators import bloom

BROADCAST_BYTES = 64 * 1024 * 1024
FILTER_BYTES = 256 * 1024 * 1024  # of a Bloom filter: some 80 million members
HOT_KEYS = 1000  # a key is hot from 1/1000 of the rows on ...
TASK_ROWS = 5_000_000  # ... and from as many rows as one task should hold


def fits_broadcast(table: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> bool:
    """True when a table of one key column and a few numbers is surely below ``limit`` bytes."""
    rows, widest = table.agg(F.count("*"), F.max(F.octet_length(F.col(key).cast("string")))).first()
    return rows * ((widest or 0) + 32) <= limit


def hot_keys(df: DataFrame, key: str, limit: int = HOT_KEYS) -> DataFrame:
    """Keys with at least ``1/limit`` of all rows or ``TASK_ROWS`` rows: never more than ``limit`` plus ``rows / TASK_ROWS``.

    The count is partial before its shuffle, so a hot key costs one row per map task.
    """
    counts = df.select(key).where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    total = df.agg(F.count("*").alias("__total"))
    return counts.where((F.col("__n") * limit >= total.scalar()) | (F.col("__n") >= TASK_ROWS)).select(key)


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, *,
           broadcast_bytes: int = BROADCAST_BYTES, hot_limit: int = HOT_KEYS, small: bool | None = None) -> DataFrame:
    """``df`` plus column ``value`` from ``table`` (unique in column ``key``), null where the key is unknown.

    ``df`` must hold ``key`` too. A table below the byte limit is broadcast, so ``df`` does not move at
    all. Above it, hot keys are looked up in a broadcast of just those keys and their rows, like the rows
    without a key, travel under join keys of their own, dealt out by the row's number; every other key is
    small enough for a hash join. ``small`` says that the size has been checked already.
    """
    if fits_broadcast(table, key, broadcast_bytes) if small is None else small:
        return df.join(F.broadcast(table.select(key, value)), key, "left").select(*df.columns, value)

    hot = hot_keys(df, key, hot_limit)
    known = table.select(key, value).join(F.broadcast(hot), key)
    hot_values = hot.join(F.broadcast(known), key, "left").select(
        F.col(key).alias("__hot"), F.col(value).alias("__hot_value"))
    mix = F.xxhash64(F.monotonically_increasing_id())  # any number does: it meets nothing
    # Hot rows and rows without a key get a spread-out key of their own, marked so that it matches nothing.
    alone = F.col("__hot").isNotNull() | F.col(key).isNull()
    travel = F.when(alone, F.concat(F.lit("-"), mix.cast("string"))).otherwise(
        F.concat(F.lit("+"), F.col(key).cast("string")))
    marked = (
        df.join(F.broadcast(hot_values), F.col(key) == F.col("__hot"), "left").withColumn("__key", travel)
    )
    cold = table.select(
        F.concat(F.lit("+"), F.col(key).cast("string")).alias("__key"), F.col(value).alias("__cold_value"))
    return (
        marked.join(cold, "__key", "left")
        .withColumn(value, F.coalesce("__hot_value", "__cold_value"))
        .select(*df.columns, value)
    )


@dataclass
class Listed:
    """Members of a large list, made ready for tests against many rows."""

    known: DataFrame  # column ``__member``; those that occur in the rows, where a filter could tell
    fits: bool  # may ``known`` be broadcast?
    filter: DataFrame | None = None  # a Bloom filter of the whole list
    blocks: int = 0

    def split(self, df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
        """Rows that surely have no member in ``keys``, where they are, and the other rows, stored."""
        marked = bloom.mark(df, self.filter, self.blocks, keys, "__maybe")
        maybe = marked.where("__maybe").drop("__maybe")
        return marked.where("NOT __maybe").drop("__maybe"), workspace.write_table(
            maybe, workspace.new_path(df.sparkSession, "possible"))


def listed(df: DataFrame, members: DataFrame, keys: list[str], member: str = "account", *, broadcast_bytes: int = BROADCAST_BYTES,
           filter_bytes: int = FILTER_BYTES, known_bytes: int = BROADCAST_BYTES) -> Listed:
    """Find the cheapest exact way to test ``keys`` of ``df`` against ``members``; every size is counted first.

    A list below ``broadcast_bytes`` is broadcast. Of a larger one a Bloom filter is broadcast, if that stays below
    ``filter_bytes`` (about three bytes a member), and only the distinct keys that pass it meet the list in a shuffle: a row
    for each member that occurs, and one in some hundred other keys. What they find is stored, and broadcast if it is below
    ``known_bytes``; then no row of ``df`` moves. Otherwise only the rows that pass the filter do.
    """
    plain = members.select(F.col(member).cast("string").alias("__member")).where("__member IS NOT NULL")
    if fits_broadcast(members, member, broadcast_bytes):
        return Listed(plain.distinct(), True)
    rows = plain.count()
    if bloom.bytes_for(rows) > filter_bytes:
        return Listed(plain.distinct(), False)
    blocks = bloom.blocks_for(rows)
    table = bloom.build(plain, "__member", blocks)
    seen = [df.select(F.col(k).cast("string").alias("__member")) for k in keys]
    possible = bloom.mark(reduce(DataFrame.unionByName, seen), table, blocks, ["__member"], "__maybe").where("__maybe")
    known = workspace.write_table(
        possible.select("__member").distinct().join(plain, "__member", "left_semi"), workspace.new_path(df.sparkSession, "members"))
    return Listed(known, fits_broadcast(known, "__member", known_bytes), table, blocks)


def _exact_flags(df: DataFrame, known: DataFrame, keys: list[str], flag: str, small: bool, **options) -> DataFrame:
    kept, names = df.columns, [f"__f{i}" for i in range(len(keys))]
    for key, name in zip(keys, names):
        table = known.select(F.col("__member").cast(df.schema[key].dataType).alias(key), F.lit(1).alias(name))
        df = lookup(df, table, key, name, small=small, **options)
    return df.select(*kept, F.greatest(F.lit(0), *[F.coalesce(n, F.lit(0)) for n in names]).alias(flag))


SIZES = ("broadcast_bytes", "filter_bytes", "known_bytes")


def flag_members(df: DataFrame, members: DataFrame, key: str | list[str], flag: str, *, member: str = "account", **options) -> DataFrame:
    """0/1 column ``flag``: is ``df[key]``, or any of several keys, in ``members[member]``? A missing key is never a member.

    ``options`` are the sizes of ``listed`` and the hot keys of ``lookup``. A large list may read ``df`` twice.
    """
    keys = [key] if isinstance(key, str) else list(key)
    sizes = {k: options.pop(k) for k in SIZES if k in options}
    found = listed(df, members, keys, member, **sizes)
    if found.fits or found.filter is None:
        return _exact_flags(df, found.known, keys, flag, found.fits, **options)
    never, maybe = found.split(df, keys)
    return _exact_flags(maybe, found.known, keys, flag, False, **options).unionByName(never.withColumn(flag, F.lit(0)))


def _by_membership(df: DataFrame, members: DataFrame, key: str, wanted: int, member: str = "account", **options) -> DataFrame:
    sizes = {k: options.pop(k) for k in SIZES if k in options}
    found = listed(df, members, [key], member, **sizes)
    if found.fits:
        table = found.known.select(F.col("__member").cast(df.schema[key].dataType).alias(key))
        return df.join(F.broadcast(table), key, "left_semi" if wanted else "left_anti").select(df.columns)
    never, rows = (None, df) if found.filter is None else found.split(df, [key])
    flagged = _exact_flags(rows, found.known, [key], "__member", False, **options)
    kept = flagged.where(F.col("__member") == wanted).drop("__member")
    return kept if wanted or never is None else kept.unionByName(never)


def keep_members(df: DataFrame, members: DataFrame, key: str, **options) -> DataFrame:
    """Semi form: only rows whose key is a member."""
    return _by_membership(df, members, key, 1, **options)


def drop_members(df: DataFrame, members: DataFrame, key: str, **options) -> DataFrame:
    """Anti form: only rows whose key is not a member; rows without a key stay."""
    return _by_membership(df, members, key, 0, **options)


def unmatched(left: DataFrame, right: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Rows of ``left`` beyond the copies ``right`` already has, compared in ``on`` (by default all columns), nulls equal.

    Columns outside ``on`` must follow from those in it. Copies are counted before the shuffle and the missing number is
    spelled out after it.
    """
    columns, on = left.columns, on or left.columns
    have = right.select(on).groupBy(on).agg(F.count("*").alias("__have"))
    rest = [c for c in columns if c not in on]
    need = left.groupBy(on).agg(F.count("*").alias("__need"), *[F.any_value(c).alias(c) for c in rest])
    same = all_of([F.col(f"n.{c}").eqNullSafe(F.col(f"h.{c}")) for c in on])
    missing = F.col("__need") - F.coalesce("__have", F.lit(0))
    return (
        need.alias("n").join(have.alias("h"), same, "left")
        .select(*[F.col(f"n.{c}") for c in columns], missing.alias("__missing"))
        .where("__missing > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__missing"))))
        .select(columns)
    )
