"""Groups of any size for tasks of bounded memory: large groups are cut into blocks, and pairs of blocks meet."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_LIMIT = 200_000  # so many large groups are broadcast; more are joined by a shuffle


def block_pairs(members: DataFrame, sizes: DataFrame, group: str, spread: str, weight: int) -> DataFrame:
    """``members`` plus ``low`` and ``high``: a row for each pair of blocks that it takes part in.

    ``sizes`` has ``group`` and ``weight`` (of the whole group). A group of more than ``weight`` is cut into blocks by
    the hash of column ``spread``; the pairs with ``low = high`` compare a block with itself. Within a pair of different
    blocks only members of different blocks are to be compared.
    """
    large = sizes.where(F.col("weight") > weight).select(
        group, F.ceil(F.col("weight") / weight).cast("int").alias("parts"))
    small = large.limit(HOT_LIMIT + 1).count() <= HOT_LIMIT
    joined = members.join(F.broadcast(large) if small else large, group, "left")
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64(spread), parts).cast("int")
    return (
        joined.withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        .drop("other", "parts")
    )


def sorted_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a stream sorted by ``keys``, one after another; only one group is kept whole."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        same = (frame[keys].to_numpy()[1:] == frame[keys].to_numpy()[:-1]).all(axis=1)
        cuts = [0, *(same == False).nonzero()[0] + 1, len(frame)]  # noqa: E712
        for start, end in zip(cuts[:-1], cuts[1:]):
            part = frame.iloc[start:end]
            if held and (held[-1][keys].iloc[-1].to_numpy() == part[keys].iloc[0].to_numpy()).all():
                held.append(part)
                continue
            if held:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
            held = [part]
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
