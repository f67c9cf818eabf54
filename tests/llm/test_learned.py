import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from txguard.llm import language, quality

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels")}


ODD = [(1, None), (2, ""), (3, "12 34 !!"), (4, "hello there and what is this"), (4, "hello there and what is this"), (None, "the"), (6, "word " * 30000)]


def test_quality_on_held_out_rows(tables):
    found = quality.classify(tables["documents"], tables["labels"])
    assert found.count() == tables["documents"].count()
    assert found.where("score < 0 OR score > 1 OR score IS NULL OR predicted <> CAST(score >= 0.7 AS INT)").count() == 0
    assert found.where("held_out <> (crc32(CAST(doc_id AS STRING)) % 4 = 2)").count() == 0
    judged = found.join(tables["labels"], "doc_id").where("held_out").groupBy("quality").agg(F.avg(
        (F.col("predicted") == F.col("quality")).cast("int")).alias("right")).collect()
    assert {r["quality"]: r["right"] > 0.9 for r in judged} == {0: True, 1: True}


def test_quality_learns_nothing_from_held_out_rows(tables):
    learnt = quality.fit(tables["documents"], tables["labels"], ~quality.held_out("doc_id", 4, 2))
    turned = tables["labels"].withColumn("quality", F.when(quality.held_out("doc_id", 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.fit(tables["documents"], turned, ~quality.held_out("doc_id", 4, 2))
    assert (learnt.gain == again.gain).all() and (learnt.slope, learnt.shift) == (again.slope, again.shift)


def test_quality_of_odd_rows(spark, documents, clashing, tables):
    model = quality.fit(tables["documents"], tables["labels"])
    docs = clashing(documents(*ODD)).drop("score")
    scored = quality.score(docs, model)
    assert scored.count() == len(ODD) and scored.where("score IS NULL").count() == 0
    assert quality.score(documents(), model).count() == 0


def test_quality_without_two_classes(spark, documents, tables):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["predicted"] for r in quality.classify(documents(*ODD), none).collect()} == {1}
    bad = spark.createDataFrame([(4, 0, 0), (1, None, 0), (None, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["predicted"] for r in quality.classify(documents(*ODD), bad).collect()} == {0}


def test_quality_shuffled_labels_give_the_same(tables, monkeypatch):
    one = quality.fit(tables["documents"], tables["labels"])
    monkeypatch.setattr(quality, "BROADCAST_LABELS", 0)
    two = quality.fit(tables["documents"], tables["labels"])
    assert (one.gain == two.gain).all()


def test_language_on_held_out_rows(tables):
    found = language.identify(tables["documents"]).join(tables["documents"].select("doc_id", "lang"), "doc_id")
    held = found.where("held_out")
    assert held.where("lang_pred = lang").count() > 0.97 * held.count()
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert found.where("held_out <> (crc32(CAST(doc_id AS STRING)) % 3 = 1)").count() == 0


@pytest.mark.parametrize("min_rate", [0.0, 2e-3])
def test_masks_are_those_of_the_exact_sets(documents, min_rate):
    """Every language that contains an n-gram is found; others pass about as often as the rates say; popcounts are corrected."""
    import numpy as np

    rng = random.Random(8)
    letters = {"xx": "abcdef", "yy": "defghi", "zz": "ghiäö", "ww": "abcdef"}
    rows = [(i, " ".join("".join(rng.choices(letters[lang], k=rng.randint(1, 7))) for _ in range(60)), lang) for i, lang in enumerate(list(letters) * 12)]
    docs = documents(*[r[:2] for r in rows]).drop("lang")
    docs = docs.join(docs.sparkSession.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, lang string"), "doc_id")
    counts = {lang: Counter() for lang in letters}
    for _, text, lang in rows:
        padded = b"  " + text.encode() + b"  "
        counts[lang].update(padded[j:j + 4] for j in range(len(padded) - 3) if padded[j:j + 4] != b"    ")
    exact = {lang: {g for g, n in c.items() if n >= min_rate * sum(c.values())} for lang, c in counts.items()}
    filters = language.fit(docs, min_rate=min_rate)
    assert filters.names == sorted(letters)
    every = sorted(set().union(*counts.values()))
    found = np.array([int.from_bytes(g, "little") for g in every], np.uint32)
    masks = np.bitwise_and.reduce([filters.table[at, 0] for at in filters.slots(found, len(filters.table))])
    for i, lang in enumerate(filters.names):
        said = ((masks >> i) & 1).astype(bool)
        inside = np.array([g in exact[lang] for g in every])
        assert said[inside].all() and said[~inside].mean() <= filters.rate[i] + 0.02
    best, share = filters.guess(found, np.array([0, len(found)]))
    most = max(len(s) for s in exact.values())
    assert len(exact[filters.names[best[0]]]) >= 0.97 * most and share[0] == pytest.approx(most / len(every), abs=0.03)


def test_language_of_odd_rows(documents, clashing, tables):
    filters = language.fit(tables["documents"])
    found = {r["doc_id"]: (r["lang_pred"], r["lang_score"]) for r in language.guess(clashing(documents(*ODD)), filters).collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0)
    assert found[4][0] == found[None][0] == "en"
    assert language.guess(documents(), filters).count() == 0
    other = documents((1, "ß"), (2, "Ж"), (3, "中文"), (4, "½²"))
    assert {r["doc_id"]: r["lang_pred"] != "und" for r in language.guess(other, filters).collect()} == {1: True, 2: True, 3: True, 4: False}


def test_language_without_learning(documents, spark):
    docs = documents(*ODD).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(docs).collect()} == {"und"}


def test_many_languages_share_a_filter():
    import numpy as np

    names = [f"l{i:03d}" for i in range(70)]
    members = [np.arange(i * 100, i * 100 + 100, dtype=np.uint64) for i in range(70)]
    filters = language.Filters.build(names, members, 0)
    found = np.concatenate([m[:40] for m in members]).astype(np.uint32)
    best, sure = filters.guess(found, np.arange(0, 70 * 40 + 1, 40))
    assert (best == np.arange(70)).all() and (sure > 0.5).all()
