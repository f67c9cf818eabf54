"""A Bloom filter as a table: built by partial bitwise ORs, tested by a broadcast join, so that only possible members move.

The filter is split into blocks of eight 64-bit words. A key sets one bit in each word of its block, so a block is one row,
a key touches one row, and a test is one lookup and eight bit tests in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.functions.features import any_of

WORDS = [f"__w{i}" for i in range(8)]
BLOCK_KEYS = 40  # keys to a block of 512 bits: about one stranger in 300 passes
BLOCK_BYTES = 128  # of a broadcast row: 64 of bits, the rest for its place in the hash table


def blocks_for(keys: int) -> int:
    return max(1, -(-keys // BLOCK_KEYS))


def bytes_for(keys: int) -> int:
    """Size of the broadcast filter of so many keys."""
    return blocks_for(keys) * BLOCK_BYTES


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _places(key: Column) -> list[Column]:
    """The bit of each word, from 48 bits of a second hash."""
    spread = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(8)]


def build(members: DataFrame, key: str, blocks: int) -> DataFrame:
    """Stored table ``(block, eight words)`` of the blocks that have a member; missing keys are no members.

    Each task puts out a row for each block it has met, whatever the number of its members.
    """
    rows = members.select(F.col(key).cast("string").alias("__k")).where("__k IS NOT NULL")
    rows = rows.select(
        _block(F.col("__k"), blocks).alias("block"),
        *[F.call_function("shiftleft", F.lit(1).cast("long"), place).alias(w) for w, place in zip(WORDS, _places(F.col("__k")))])
    table = rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])
    return workspace.write_table(table, workspace.new_path(members.sparkSession, "filter"))


def mark(df: DataFrame, table: DataFrame, blocks: int, keys: list[str], name: str) -> DataFrame:
    """``df`` plus boolean ``name``: may any of the columns ``keys`` be a member? Never false for a member; nothing is shuffled."""
    kept, found = df.columns, []
    for n, key in enumerate(keys):
        text = F.col(key).cast("string")
        own = F.broadcast(table.select(F.col("block").alias(f"__b{n}"), *[F.col(w).alias(f"{w}_{n}") for w in WORDS]))
        df = df.join(own, _block(text, blocks) == F.col(f"__b{n}"), "left")
        hit = text.isNotNull() & F.col(f"__b{n}").isNotNull()
        for word, place in zip(WORDS, _places(text)):
            hit = hit & (F.getbit(F.col(f"{word}_{n}"), place) == 1)
        found.append(F.coalesce(hit, F.lit(False)))
    return df.select(*kept, any_of(found).alias(name))
