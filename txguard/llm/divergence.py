"""Source divergence audit: how far the term shares of each source lie from those of its language and of the other sources.

Only terms in enough documents of the language count. Shares are smoothed and scaled to whole numbers, so all arithmetic is
exact. A share follows from a count and a total, so terms of a group with equal counts in the group and in the language (a
cell) have equal values: cells are ranked by value with the number of terms above them, equal values are merged, and only
the cells that reach the wanted ranks are opened, their terms in UTF-8 order. Sums over pairs of sources are gathered in
each task as a matrix, so that no pair of a term ever is a row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard import workspace

MIN_DOCS = 30  # documents of a language that a kept term is in, at least
TOP = 50  # ranks of the terms
SCALE, SMOOTH = 1_000_000_000, 5  # fixed values: shares are 1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms))

# Fixed value: the term characters, as UTF-8 bytes whose letters A-Z are in lower case already.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
PIECE = 1 << 20  # bytes of a text that are taken apart at once
HELD = 400_000  # counts that a task holds before it passes them on
BLOCK = 256  # sources whose sums against all others are gathered at once


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``PIECE`` bytes, cut between terms only."""
    start = 0
    while start < len(text):
        cut = BREAK.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source; a row without a term for each group met."""
    held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

    def emptied() -> pa.RecordBatch:
        langs, sources, terms, n, docs = [], [], [], [], []
        for (lang, source), (seen, inside) in held.items():
            size = len(seen) + 1
            langs += [lang] * size
            sources += [source] * size
            terms += [b"", *seen]
            n += [0, *seen.values()]
            docs += [0, *(inside[t] for t in seen)]
        held.clear()
        texts = [pa.array(x, pa.binary()).cast(pa.string()) for x in (langs, sources, terms)]
        return pa.RecordBatch.from_arrays(
            [*texts, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        langs, sources, texts = (batch.column(c).cast(pa.large_binary()).to_pylist() for c in ("lang", "source", "text"))
        for lang, source, text in zip(langs, sources, texts):
            seen, inside = held.setdefault((lang, source), (Counter(), Counter()))
            own: set[bytes] = set()
            for piece in _pieces(text.lower()):  # bytes: A-Z only
                found = TERM.findall(piece)
                seen.update(found)
                own.update(found)
            inside.update(own)
        if sum(len(seen) for seen, _ in held.values()) > HELD:
            yield emptied()
    if held:
        yield emptied()


def share(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """The smoothed, scaled share as a long. The product is a decimal of up to 32 digits, so nothing overflows."""
    big = lambda x: (F.col(x) if isinstance(x, str) else x).cast("decimal(20,0)")
    above = (big(count) + F.lit(SMOOTH)) * F.lit(SCALE)
    below = big(total) + (big(terms) * F.lit(SMOOTH)).cast("decimal(21,0)")
    return F.call_function("div", above, below) + F.lit(1)


def kept_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three stored tables: counts of kept terms, groups and languages.

    ``(lang, source, term, n, lang_n)`` with ``n > 0``; ``(lang, source, place, total)`` for every group that occurs, also
    without terms, numbered within its language from 0; ``(lang, terms, total)`` for every language.
    """
    spark = docs.sparkSession
    store = lambda df, name: workspace.write_table(df, workspace.new_path(spark, name))
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    partial = plain.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counts = store(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    words = counts.where("term <> ''")
    kept = store(
        words.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= min_docs).select("lang", "term", "lang_n"), "kept")
    cells = store(words.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "counts")

    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = counts.where("term = ''").select("lang", "source").distinct()
    order = Window.partitionBy("lang").orderBy("source")  # one row for each source
    groups = store(
        every.join(totals, ["lang", "source"], "left")
        .select("lang", "source", (F.row_number().over(order) - 1).alias("place"), F.coalesce("total", F.lit(0)).alias("total")), "groups")
    sums = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("total"))
    langs = store(
        groups.select("lang").distinct().join(sums, "lang", "left")
        .select("lang", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("total", F.lit(0)).alias("total")), "langs")
    return cells, groups, langs


def top_terms(counts: DataFrame, groups: DataFrame, langs: DataFrame, top: int = TOP) -> DataFrame:
    """``(lang, source, item, value, rank)``: terms whose share in the group lies above that in the language, ranks to ``top``."""
    spark = counts.sparkSession
    cells = counts.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("many"))
    own = groups.select("lang", "source", F.col("total").alias("own"))
    whole = langs.select("lang", "terms", F.col("total").alias("whole"))
    valued = cells.join(own, ["lang", "source"]).join(whole, "lang").withColumn(
        "value", share("n", "own", "terms") - share("lang_n", "whole", "terms")).where("value > 0")
    valued = workspace.write_table(valued.select("lang", "source", "n", "lang_n", "many", "value"), workspace.new_path(spark, "cells"))
    # Each value has a term at least, so no more than the first ``top`` values can matter.
    high = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    upto = F.sum("many").over(high.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    values = (
        valued.groupBy("lang", "source", "value").agg(F.sum("many").alias("many"))
        .withColumn("nth", F.row_number().over(high)).where(F.col("nth") <= top)
        .withColumn("before", upto - F.col("many")).where(F.col("before") < top).select("lang", "source", "value", "before"))
    opened = valued.drop("many").join(values, ["lang", "source", "value"])
    in_order = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (
        counts.join(opened, ["lang", "source", "n", "lang_n"])
        .withColumn("nth", F.row_number().over(in_order)).where(F.col("nth") <= top)
        .withColumn("rank", (F.col("before") + F.col("nth")).cast("int")).where(F.col("rank") <= top)
        .select("lang", "source", F.col("term").alias("item"), "value", "rank"))


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of absolute differences between the sources of a block and all sources of the language.

    Rows come sorted by language and block: one matrix is held at a time.
    """
    current, sums = None, None

    def out() -> pa.RecordBatch:
        lang, block = current
        a, b = (x.ravel() for x in np.indices(sums.shape))
        a = a + block * BLOCK
        other = a != b
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * int(other.sum()), pa.string()), pa.array(a[other], pa.int32()), pa.array(b[other], pa.int32()),
             pa.array(sums.ravel()[other], pa.int64())], names=["lang", "a", "b", "value"])

    for batch in batches:
        langs, blocks = batch.column("lang").to_pylist(), batch.column("block").to_numpy()
        turns = [i for i in range(1, len(langs)) if (langs[i], blocks[i]) != (langs[i - 1], blocks[i - 1])]
        for low, high in zip([0, *turns], [*turns, len(langs)]):
            if low == high:
                continue
            plain = np.asarray(batch.column("plain")[low].as_py(), np.int64)  # shares of a term that the source lacks
            size, key = len(plain), (langs[low], int(blocks[low]))
            inside = slice(key[1] * BLOCK, min((key[1] + 1) * BLOCK, size))
            if key != current:
                if current is not None:
                    yield out()
                current, sums = key, np.zeros((inside.stop - inside.start, size), np.int64)
            step = max(1, (1 << 20) // size)
            for a in range(low, high, step):
                part = slice(a, min(a + step, high))
                places, shares = (batch.column(c).slice(part.start, part.stop - part.start) for c in ("places", "shares"))
                table = np.repeat(plain[None, :], len(places), 0)
                row = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy())
                table[row, places.flatten().to_numpy()] = shares.flatten().to_numpy()
                for i in range(inside.start, inside.stop):
                    sums[i - inside.start] += np.abs(table[:, i:i + 1] - table).sum(0)
    if current is not None:
        yield out()


def source_pairs(counts: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """``(lang, source, item, value, rank)``: each other source of the language by the sum of share differences over all kept terms.

    A row for a task is a term with the shares of the sources that have it, once for each ``BLOCK`` sources of its language.
    A language without kept terms gives 0 for each pair.
    """
    sized = groups.join(langs.select("lang", "terms"), "lang")
    none = F.when(F.col("terms") > 0, share(F.lit(0), "total", F.greatest("terms", F.lit(1)))).otherwise(F.lit(0))
    plain = (
        sized.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", none.alias("p")))).alias("s"))
        .select("lang", F.col("s.p").alias("plain")))
    shares = counts.join(groups, ["lang", "source"]).join(langs.select("lang", "terms"), "lang").select(
        "lang", "term", "place", share("n", "total", "terms").alias("p"))
    rows = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p")).alias("s")).select("lang", "s")
    # Languages without terms, whose shares are all 0 here, get one row without shares: it makes their pairs.
    rows = rows.unionByName(langs.where("terms = 0").select("lang", F.array().cast(rows.schema["s"].dataType).alias("s")))
    blocks = F.sequence(F.lit(0), F.expr(f"cast((size(plain) - 1) div {BLOCK} as int)"))
    rows = rows.join(plain, "lang").select(
        "lang", F.explode(blocks).alias("block"), "plain", F.col("s.place").alias("places"), F.col("s.p").alias("shares"))
    sums = rows.sortWithinPartitions("lang", "block").mapInArrow(_distances, "lang string, a int, b int, value long")
    total = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    named = lambda place, name: groups.select("lang", F.col("place").alias(place), F.col("source").alias(name))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # a row for each source of the language
    return (
        total.join(named("a", "source"), ["lang", "a"]).join(named("b", "item"), ["lang", "b"])
        .select("lang", "source", "item", "value", F.row_number().over(order).alias("rank")))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", *,
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` with the parts ``pair`` and ``term``.

    Missing language, source or text count as empty strings; repeated rows are documents of their own; an empty table, or a
    language with one source and no kept term, gives no rows; other columns are ignored, whatever their names. Ties are
    ranked by the item's UTF-8 bytes.
    """
    counts, groups, langs = kept_counts(docs, lang, source, text, min_docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_pairs(counts, groups, langs).withColumn("part", F.lit("pair")).select(columns)
    return pairs.unionByName(top_terms(counts, groups, langs, top).withColumn("part", F.lit("term")).select(columns))
