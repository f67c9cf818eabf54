"""Benchmark decontamination: scan documents for the word windows of benchmark items, verify, remove."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.llm import native

WINDOW = 13
SHARE = 20  # contaminated from one hit word in so many on
BROADCAST_KEYS = 500_000  # keys of contaminated texts
BROADCAST_BYTES = 64 << 20  # words and item ids of the windows that are broadcast


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows of the benchmark: ``gram`` (words joined by a space), ``h``, ``n`` words, ``items`` (as strings).

    An item with fewer than ``size`` words, but some, is one window. Items without an id hit words but are not listed.
    """
    own = benchmark.select(F.col(item).cast("string").alias("item"), native.words(F.col(text)).alias("w"))
    own = own.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(size)))
    runs = own.select("item", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.slice("w", i, F.col("n")))).alias("gram"))
    return (
        runs.groupBy(F.array_join("gram", " ").alias("gram"), native.hash_of_gram(F.col("gram")).alias("h"), "n")
        .agg(F.collect_set("item").alias("items"))
    )


def covered(spans: Column) -> Column:
    """Number of words in the union of ``spans`` (structs of ``at`` and ``end``)."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(done: Column, span: Column) -> Column:
        new = F.greatest(F.lit(0), span["end"] - F.greatest(done["end"], span["at"]))
        return F.struct((done["n"] + new).alias("n"), F.greatest(done["end"], span["end"]).alias("end"))

    return F.aggregate(F.array_sort(spans), start, add, lambda done: done["n"])


def _measure(grams: DataFrame) -> tuple[list[int], int, int]:
    """Sizes of the windows, their number, and the bytes of their words and items."""
    held = F.octet_length("gram") + F.coalesce(F.octet_length(F.array_join("items", ",")), F.lit(0)) + 64
    known = grams.groupBy("n").agg(F.count("*").alias("count"), F.sum(held).alias("bytes")).collect()  # a row for each size
    return sorted(r["n"] for r in known), sum(r["count"] for r in known), sum(r["bytes"] for r in known)


def _hits(docs: DataFrame, benchmark: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """Verified hits: the columns of ``docs`` but ``w``, ``at``, ``end``, ``items`` (null in a row without a hit).

    Of a benchmark with more windows than the bit filter holds, those that occur in ``docs`` at all are found first, by
    their hashes; mostly they are few, and broadcast. If not, the places that pass a Bloom filter of them are stored and meet
    them in a shuffle by their words; documents without such a place take no part in that.
    """
    spark = docs.sparkSession
    grams = workspace.write_table(windows(benchmark, item, text, size), workspace.new_path(spark, "windows"))
    sizes, total, held = _measure(grams)
    if total > native.FILTER_GRAMS:
        grams = native.occurring(docs, sizes, grams, total)
        sizes, total, held = _measure(grams)
    sizes, table = sizes or [size], grams.select("gram", "n", "items")
    own = [c for c in docs.columns if c != "w"]
    if total <= native.FILTER_GRAMS and held <= BROADCAST_BYTES:
        found = native.gram_places(docs, sizes, grams).join(F.broadcast(table), "gram", "left")
        return found.select(
            *own, F.when(F.col("n").isNotNull(), F.col("at")).alias("at"), (F.col("at") + F.col("n")).alias("end"), "items")
    places = native.all_places(docs, sizes, grams, total)
    hits = places.where("gram IS NOT NULL").join(table, "gram")
    hits = hits.select(*own, "at", (F.col("at") + F.col("n")).alias("end"), "items")
    return hits.unionByName(places.where("gram IS NULL").select(*own, "at"), allowMissingColumns=True)


def scan(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
         item_text: str = "text", size: int = WINDOW, share: int = SHARE) -> DataFrame:
    """Per row of ``docs``: id, ``text_key`` (MD5 of the text, null for a null text), ``n_words``, ``n_hit``,
    ``n_items``, ``items_sha256``, ``contaminated``.

    A word inside any occurrence of a window is hit; a text is contaminated from one hit word in ``share`` on. Null
    and empty texts have no words, no hits and are clean; repeated rows are judged one by one; an empty benchmark hits
    nothing; other columns of ``docs`` are ignored, so their names can't clash.
    """
    rows = docs.select(
        F.col(doc).alias("doc_id"), F.md5(F.encode(text, "UTF-8")).alias("text_key"),
        F.monotonically_increasing_id().alias("row"), native.words(F.col(text)).alias("w"))
    rows = rows.select("doc_id", "text_key", "row", F.size("w").cast("long").alias("n_words"), "w")
    hits = _hits(rows, benchmark, item, item_text, size)
    found = hits.groupBy("row", "doc_id", "text_key", "n_words").agg(
        F.collect_set(F.when(F.col("items").isNotNull(), F.struct("at", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return found.select(
        "doc_id", "text_key", "n_words", covered(F.col("spans")).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def remove_documents(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text",
                     **options) -> DataFrame:
    """``docs`` without contaminated rows; all columns stay.

    Whether a row is contaminated depends on its text alone, so the verdicts travel as MD5 keys of the texts: copies
    of a text are one key, and a null text is clean.
    """
    bad = scan(docs, benchmark, doc, text, **options).where("contaminated").select("text_key").distinct()
    bad = workspace.write_table(bad, workspace.new_path(docs.sparkSession, "contaminated"))
    # Keys of 32 characters: a broadcast of bounded size, so that no text moves; beyond it both sides are shuffled.
    small = bad.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return docs.join(F.broadcast(bad) if small else bad, F.md5(F.encode(docs[text], "UTF-8")) == bad["text_key"], "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words taken out of ``text``; what stands between words stays. Null texts stay null."""
    key = F.md5(F.encode(text, "UTF-8"))
    rows = docs.select(key.alias("__key"), native.words(F.col(text)).alias("w")).where(F.size("w") > 0)
    hits = _hits(rows, benchmark, item, item_text, size).where(F.col("items").isNotNull())
    hit = hits.groupBy("__key").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence("at", F.col("end") - 1)))).alias("__hit"))
    any_case = native.WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    between = F.split(F.col("text"), any_case, -1)
    own = F.regexp_extract_all(F.col("text"), F.lit(any_case), F.lit(0))
    whole = docs.select(F.struct(*docs.columns).alias("__row"), text, key.alias("__key"))
    joined = whole.toDF("__row", "text", "__key").join(hit, "__key", "left")
    with_parts = joined.withColumn("__between", between).withColumn("__own", own)
    kept = F.transform("__own", lambda w, i: F.when(F.array_contains("__hit", i), F.lit("")).otherwise(w))
    cleaned = F.array_join(F.zip_with(
        "__between", F.concat(kept, F.array(F.lit(""))), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "")
    new = F.when(F.col("__hit").isNull(), F.col("text")).otherwise(cleaned)
    return with_parts.select(*[new.alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns])
