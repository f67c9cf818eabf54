"""Words, word n-grams and small n-gram sets as built-in functions only (no Python on the executors)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.operators import bloom

# The word characters of the contract, for texts whose letters A-Z are in lower case already.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FILTER_BITS = 1 << 18  # size of the bit filter that travels with the plan: 4096 numbers
FILTER_GRAMS = 1 << 16  # above so many n-grams that filter would be full, and a Bloom filter sized by them replaces it
FILTER_BYTES = 256 << 20  # of a broadcast Bloom filter: some 80 million n-grams


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is. Pure ASCII texts take the fast function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def gram_hashes(word_hashes: Column, size: int) -> Column:
    """A hash for each run of ``size`` words, in order; empty when there are fewer words."""
    last = F.size(word_hashes) - (size - 1)
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(word_hashes, i, size)))


def hash_of_gram(gram: Column) -> Column:
    """The same hash, of one array of words."""
    return F.xxhash64(F.transform(gram, lambda w: F.xxhash64(w)))


def bit_filter(grams: DataFrame) -> Column:
    """Bits of the hashes in column ``h``: a constant array of at most ``FILTER_BITS / 64`` longs.

    The bits are put together by Spark; the driver gets at most 4096 rows, whatever the number of n-grams.
    """
    slot = F.col("h").bitwiseAND(FILTER_BITS - 1)
    rows = (
        grams.select(F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, cast((h & {FILTER_BITS - 1}) & 63 as int))").alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    )
    table = [0] * (FILTER_BITS // 64)
    for row in rows:
        table[row["at"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def may_match(hashes: Column, bits: Column) -> Column:
    """Places, from 1, of the hashes that may be in the set; a few of the others pass as well."""
    def passes(i: Column) -> Column:
        slot = F.get(hashes, i - 1).bitwiseAND(FILTER_BITS - 1)
        return F.getbit(F.get(bits, F.shiftright(slot, 6)), slot.bitwiseAND(63)) == 1

    found = F.size(hashes)
    return F.filter(F.when(found > 0, F.sequence(F.lit(1), found)).otherwise(F.array().cast("array<int>")), passes)


def _places_of(starts: Column, size: int) -> Column:
    return F.transform(starts, lambda i: F.struct(
        (i - 1).alias("at"), F.array_join(F.slice("w", i, size), " ").alias("gram")))


def _with_hashes(docs: DataFrame, sizes: list[int]) -> DataFrame:
    frame = docs.withColumn("wh", F.transform("w", lambda w: F.xxhash64(w)))
    for size in sizes:
        frame = frame.withColumn(f"h{size}", gram_hashes(F.col("wh"), size))
    return frame


def _possible(rows: DataFrame, grams: DataFrame, count: int) -> DataFrame:
    """``rows`` whose hash ``h`` may be one of ``grams``, or is null. No row moves; a filter that would not fit passes all."""
    if bloom.bytes_for(count) > FILTER_BYTES:
        return rows
    blocks = bloom.blocks_for(count)
    marked = bloom.mark(rows, bloom.build(grams, "h", blocks), blocks, ["h"], "__maybe")
    return marked.where("__maybe OR h IS NULL").drop("__maybe")


def occurring(docs: DataFrame, sizes: list[int], grams: DataFrame, count: int) -> DataFrame:
    """Stored: those of ``count`` ``grams`` whose hash occurs among the words ``w`` of ``docs``.

    Of the documents only distinct hashes move, and of those only such as pass a filter of the n-grams.
    """
    frame = _with_hashes(docs.select("w"), sizes)
    hashes = frame.select(F.explode(F.concat(*[F.col(f"h{size}") for size in sizes])).alias("h"))
    seen = _possible(hashes, grams, count).distinct()
    return workspace.write_table(grams.join(seen, "h", "left_semi"), workspace.new_path(docs.sparkSession, "occurring"))


def gram_places(docs: DataFrame, sizes: list[int], grams: DataFrame) -> DataFrame:
    """One row for each place of a document whose words may be one of ``grams``, and one for a document without any.

    ``docs`` has the words in ``w``; its other columns stay and should be short. Out: those columns, ``at`` (from
    0, null if none) and ``gram`` (the words, joined by a space). A bit filter of ``grams`` (column ``h``, at most
    ``FILTER_GRAMS``) decides inside the row, so that words without a match never become rows.
    """
    keep = [c for c in docs.columns if c != "w"]
    bits = bit_filter(grams)
    found = [_places_of(may_match(F.col(f"h{size}"), bits), size) for size in sizes]
    frame = _with_hashes(docs, sizes).select(*keep, F.explode_outer(F.concat(*found)).alias("x"))
    return frame.select(*keep, F.col("x.at").alias("at"), F.col("x.gram").alias("gram"))


def all_places(docs: DataFrame, sizes: list[int], grams: DataFrame, count: int) -> DataFrame:
    """As ``gram_places``, for any number of ``grams``, stored; every document has a row with a null ``gram`` beside its places.

    Every place becomes a row, and a broadcast Bloom filter drops the others before any shuffle.
    """
    keep = [c for c in docs.columns if c != "w"]
    none = F.array(F.struct(
        F.lit(None).cast("int").alias("at"), F.lit(None).cast("long").alias("h"), F.lit(None).cast("string").alias("gram")))

    def places(size: int) -> Column:
        return F.transform(F.col(f"h{size}"), lambda h, i: F.struct(
            i.alias("at"), h.alias("h"), F.array_join(F.slice("w", i + 1, size), " ").alias("gram")))

    frame = _with_hashes(docs, sizes).select(*keep, F.explode(F.concat(none, *map(places, sizes))).alias("x"))
    frame = frame.select(*keep, "x.at", "x.h", "x.gram")
    return workspace.write_table(_possible(frame, grams, count).drop("h"), workspace.new_path(docs.sparkSession, "places"))
