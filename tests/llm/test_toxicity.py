import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from txguard.llm import toxicity
from txguard.llm.quality import held_out

FOLDER = "/root/testdata/sf0.1"
ODD = [(1, None), (2, ""), (3, "12 34 !!"), (4, "hello there"), (4, "hello there"), (None, "the"), (6, "word " * 30000)]


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels")}


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(tables["documents"], tables["labels"], ~held_out("doc_id", 5, 0))


def apart(*texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    return data, np.cumsum([0, *(len(t.encode()) for t in texts)])


def grams_by_hand(text):
    """What the slots stand for, as words."""
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())
    raw = [w.encode() for w in words]
    out = {("w", w) for w in raw}
    out |= {("s", w[:k]) for w in raw for k in toxicity.STEMS if len(w) > k}
    return out | {("p", d, raw[i], raw[i + d]) for d in (1, *toxicity.SKIPS) for i in range(len(raw) - d)}


def test_slots_stand_for_words_pairs_and_gaps():
    texts = ["One two, three four five", "", "a b a b", "beginnings begin", "éééé ééééé", "ab", "abcde abcdX abcdé", "one two three"]
    slots, bounds = toxicity.features(*apart(*texts))
    own = [set(slots[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    for i, a in enumerate(texts):
        assert len(own[i]) == len(grams_by_hand(a))  # no two collide here
        for j, b in enumerate(texts):
            assert len(own[i] & own[j]) == len(grams_by_hand(a) & grams_by_hand(b))


def ftrl_by_hand(rows, target, weight, size, alpha, beta, l1, l2, rounds):
    """The published update, one coordinate at a time."""
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def w(i):
        first, second = (0, 0) if i == size else (l1, l2)
        if abs(z[i]) <= first:
            return 0.0
        return -(z[i] - math.copysign(first, z[i])) / ((beta + math.sqrt(n[i])) / alpha + second)

    order = np.random.default_rng(7)
    for _ in range(rounds):
        for k in order.permutation(len(rows)):
            own = [*rows[k], size]
            at = {i: w(i) for i in own}
            g = (1 / (1 + math.exp(-sum(at.values()))) - target[k]) * weight[k]
            for i in own:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * at[i]
                n[i] += g * g
    return [w(i) for i in range(size + 1)]


@pytest.mark.parametrize("l1", [0.0, 0.3, 2.0])
def test_steps_like_by_hand(l1):
    random = np.random.default_rng(3)
    rows = [np.sort(random.choice(12, random.integers(1, 6), replace=False)) for _ in range(40)]
    target = np.array([float(3 in r) for r in rows])
    weight = random.uniform(0.5, 2, 40)
    w, bias = toxicity.ftrl(rows, target, weight, 12, alpha=0.2, l1=l1, rounds=3)
    assert np.allclose([*w, bias], ftrl_by_hand(rows, target, weight, 12, 0.2, 1.0, l1, 1.0, 3))
    assert w.argmax() == 3


def test_l1_leaves_only_what_tells_the_classes_apart():
    random = np.random.default_rng(5)
    rows = [np.sort(random.choice(50, 8, replace=False)) for _ in range(400)]
    target = np.array([float(3 in r) for r in rows])
    kept = [np.flatnonzero(toxicity.ftrl(rows, target, np.ones(400), 50, l1=l1)[0]) for l1 in (0.0, 5.0, 15.0)]
    assert len(kept[0]) == 50 > len(kept[1]) >= len(kept[2]) and 3 in kept[2] and len(kept[2]) < 10


def test_held_out_rows(tables, model):
    found = toxicity.classify(tables["documents"], tables["labels"])
    assert found.count() == tables["documents"].count()
    assert found.where("score < 0 OR score > 1 OR score IS NULL OR predicted <> CAST(score >= 0.5 AS INT)").count() == 0
    assert found.where("held_out <> (crc32(CAST(doc_id AS STRING)) % 5 = 0)").count() == 0
    judged = found.join(tables["labels"], "doc_id").where("held_out").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    share = {r["toxic"]: r["p"] for r in judged}
    assert share[1] > 0.85 and share[0] < 0.02
    assert 0 < len(model.slots) < 5000  # sparse


def test_scores_are_those_of_the_whole_set_of_slots(tables, model):
    texts = [r["text"] or "" for r in tables["documents"].orderBy("doc_id").limit(60).collect()]
    slots, bounds = toxicity.features(*apart(*texts))
    table = model.table()
    plain = [toxicity.sigmoid(model.bias + table[slots[a:b]].sum()) for a, b in zip(bounds[:-1], bounds[1:])]
    assert np.allclose(toxicity.score_texts(table, model.bias, *apart(*texts)), plain)


def test_held_out_labels_change_nothing(tables, model):
    out = held_out("doc_id", 5, 0)
    turned = tables["labels"].withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(tables["documents"], turned, ~out)
    assert (again.slots == model.slots).all() and (again.weights == model.weights).all() and again.bias == model.bias


def test_odd_rows(documents, clashing, model):
    docs = clashing(documents(*ODD)).drop("score")
    scored = toxicity.score(docs, model)
    assert scored.columns == [*docs.columns, "score"]
    rows = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert scored.count() == len(ODD) and rows[1] == rows[2] == pytest.approx(1 / (1 + math.exp(-model.bias)))
    assert toxicity.score(documents(), model).count() == 0


def test_one_class_or_none(spark, documents):
    label = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
    docs = documents(*ODD)
    assert {r["predicted"] for r in toxicity.classify(docs, label()).collect()} == {0}
    assert {r["predicted"] for r in toxicity.classify(docs, label((1, 0, None), (None, 0, 1))).collect()} == {0}
    assert toxicity.fit(docs, label((4, 0, 1), (4, 0, 0))).bias > 0  # the highest label of a document counts


def test_toxic_rows_go(documents, clashing, tables, spark):
    docs = clashing(documents(*[(i, f"good words number {i % 5}" if i % 2 else "you vile vile fool") for i in range(200)]))
    labels = spark.range(200).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 2 = 0 AS INT) AS toxic")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(1, 200, 2))


def test_sample_bounds_rows(spark, documents):
    docs = documents(*[(i % 10, f"text {i}") for i in range(100)])
    labels = spark.range(10).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 2 AS INT) AS toxic")
    assert np.isfinite(toxicity.fit(docs, labels, sample=2).bias)
