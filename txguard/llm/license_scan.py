"""License scan by diagonal voting: word k-grams of texts against template positions, votes per offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txguard.llm import native

K = 4  # words in a gram
GAP = 3  # diagonals that lie so close belong to one span
COVERAGE = 0.75  # share of a template's words that a span has to cover

# Phrases and labels of the contract.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices that public licenses ask for or start with, each with the label that a match adds.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                         "or (at your option) any later version."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """``gram``, ``h`` and ``at_template``: all places (template, label, its length, offset) of the gram."""
    table = spark.createDataFrame(
        [(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    own = table.select("template", "label", native.words(F.col("text")).alias("w")).where(F.size("w") >= k)
    places = own.select("template", "label", F.size("w").alias("length"), F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.slice("w", i, k))).alias("offset", "gram"))
    return (
        places.groupBy(F.array_join("gram", " ").alias("gram"), native.hash_of_gram(F.col("gram")).alias("h"))
        .agg(F.collect_list(F.struct("template", "label", "length", "offset")).alias("at_template"))
    )


def phrase_places(w: Column, line: Column, phrase: str) -> Column:
    """Starts, from 0, of the phrase's words; only texts that have the phrase are walked through."""
    parts = phrase.split(" ")
    starts = F.sequence(F.lit(0), F.size(w) - len(parts))

    def here(i: Column) -> Column:
        test = F.get(w, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            test = test & (F.get(w, i + j) == part)
        return test

    return F.when(F.contains(line, F.lit(f" {phrase} ")), F.filter(starts, here)).otherwise(F.array().cast("array<int>"))


def spans(rows: DataFrame, templates: DataFrame, k: int = K, gap: int = GAP) -> DataFrame:
    """Template spans: the columns of ``rows`` but ``w``, ``template``, ``label``, ``first``, ``last``, ``coverage``.

    ``rows`` has words in ``w``; its other columns name one row, which comes out once with nulls if it has no span.
    The votes of a diagonal (place in the text minus place in the template) are counted first, then diagonals at most
    ``gap`` apart become one span, whose coverage is the share of the template's words that its grams cover. The join
    compares the words themselves, so a span is verified.
    """
    key = [c for c in rows.columns if c != "w"]
    places = native.gram_places(rows, [k], templates)
    # The templates are a parameter, a few thousand grams at most: a bounded broadcast.
    known = places.join(F.broadcast(templates.select("gram", "at_template")), "gram", "left")
    votes = known.select(*key, "at", F.explode_outer("at_template").alias("t"))
    diagonals = (
        votes.groupBy(*key, F.col("t.template").alias("template"), F.col("t.label").alias("label"),
                      F.col("t.length").alias("length"), (F.col("at") - F.col("t.offset")).alias("diagonal"))
        .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("t.offset").alias("offsets"))
    )
    order = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > gap, F.lit(True))
    merged = diagonals.withColumn("new", apart.cast("int")).withColumn("span", F.sum("new").over(order))
    one = merged.groupBy(*key, "template", "label", "length", "span").agg(
        F.min("first").alias("first"), (F.max("last") + (k - 1)).alias("last"),
        F.array_distinct(F.flatten(F.collect_list("offsets"))).alias("offsets"))
    covered = F.array_distinct(F.flatten(F.transform("offsets", lambda o: F.sequence(o, o + (k - 1)))))
    return one.select(
        *key, "template", "label", F.when(F.col("template").isNotNull(), F.col("first")).alias("first"),
        F.when(F.col("template").isNotNull(), F.col("last")).alias("last"), (F.size(covered) / F.col("length")).alias("coverage"))


def scan(docs: DataFrame, doc: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES, k: int = K,
         gap: int = GAP, coverage: float = COVERAGE) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    ``score`` is the best coverage of a template, at least 0.5 where a phrase stands. Null and empty texts have no words,
    no labels and score 0; repeated rows are judged one by one; other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc).alias("doc_id"), F.monotonically_increasing_id().alias("row"), native.words(F.col(text)).alias("w"))
    rows = rows.select("doc_id", "row", "w", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("line"))
    places = [phrase_places(F.col("w"), F.col("line"), phrase) for phrase, _ in phrases]
    base = rows.select("doc_id", "row", "w", *[p.alias(f"p{i}") for i, p in enumerate(places)])
    found = [F.col(f"p{i}") for i in range(len(places))]
    labels = F.array_compact(F.array(*[F.when(F.size(p) > 0, F.lit(label)) for p, (_, label) in zip(found, phrases)]))
    every = F.concat(*found)
    narrow = base.select(
        "doc_id", "row", F.size("w").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("base"), "w")
    key = [c for c in narrow.columns if c != "w"]
    found = spans(narrow, template_grams(spark, templates, k), k, gap)
    judged = found.groupBy(*key).agg(
        F.max("coverage").alias("best"), F.collect_set(F.when(F.col("coverage") >= coverage, F.col("label"))).alias("extra"))
    score = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0))
    return judged.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "extra")), ",").alias("labels"), score.alias("score"))
