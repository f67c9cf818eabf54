"""Toxicity: logistic regression over hashed word n-grams and skip-grams, learnt by FTRL-proximal steps.

Every coordinate has its own learning rate, which falls with the squared gradients it has seen, and an L1 term keeps those
at zero that never earn their place. What is left is a short list of weights: it is all that is collected and broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard import workspace
from txguard.llm import textarrays as ta
from txguard.llm.quality import fresh, held_out

SAMPLE = 4000  # labelled documents of each class that are learnt from, at most
BROADCAST_LABELS = 4_000_000  # above so many labelled documents, labels meet texts in a shuffle
THRESHOLD = 0.5
SLOTS = 1 << 20
STEMS = (4, 5, 6)  # bytes of the beginnings of longer words
SKIPS = (2, 3)  # distances of the words of a skip-gram
ALPHA, BETA, L1, L2, ROUNDS = 0.5, 1.0, 10.0, 1.0, 5


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(document, slot)`` of each word, word beginning, pair of neighbours and pair over a gap; repeated ones repeat."""
    hashes, starts, _, bounds = ta.tokens(data, offsets)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    slot = lambda h, kind: (ta.mix(h + np.uint64(kind)) % np.uint64(SLOTS)).astype(np.int64)
    yield doc, slot(hashes, 0)
    # A beginning goes on only as long as the bytes belong to the word, and counts only for words that are longer.
    ends = np.repeat(offsets[1:], np.diff(bounds))
    value, alive = np.zeros(len(starts), np.uint64), np.ones(len(starts), bool)
    for size in range(max(STEMS) + 1 if len(starts) else 0):
        at = np.minimum(starts + size, len(data) - 1)
        alive &= (starts + size < ends) & (ta.KINDS[data[at]] == ta.LETTER)
        if size in STEMS:
            yield doc[alive], slot(value[alive], size)
        value = value * ta.RADIX + ta.FOLD[data[at]].astype(np.uint64) + np.uint64(1)
    for kind, apart in enumerate((1, *SKIPS), 16):
        pair = doc[apart:] == doc[:-apart]
        yield doc[apart:][pair], slot(hashes[:-apart][pair] * ta.RADIX + hashes[apart:][pair], kind)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of each document, and the documents' bounds among them."""
    keys = np.unique(np.concatenate([doc * SLOTS + slot for doc, slot in grams(data, offsets)]))
    return (keys % SLOTS).astype(np.int32), np.searchsorted(keys, np.arange(len(offsets)) * SLOTS)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def ftrl(rows: list[np.ndarray], target: np.ndarray, weight: np.ndarray, size: int = SLOTS, *, alpha: float = ALPHA,
         beta: float = BETA, l1: float = L1, l2: float = L2, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and bias after ``rounds`` passes over the rows (sets of slots) in a fixed random order.

    The bias is a coordinate like the others, but free of both penalties.
    """
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    first, second = np.full(size + 1, l1), np.full(size + 1, l2)
    first[size] = second[size] = 0.0

    def weights(i):
        return -np.sign(z[i]) * np.maximum(np.abs(z[i]) - first[i], 0) / ((beta + np.sqrt(n[i])) / alpha + second[i])

    rows = [np.append(r, size) for r in rows]
    shuffle = np.random.default_rng(7)
    for _ in range(rounds):
        for k in shuffle.permutation(len(rows)):
            i = rows[k]
            w = weights(i)
            gradient = (sigmoid(w.sum()) - target[k]) * weight[k]
            square = gradient * gradient
            z[i] += gradient - (np.sqrt(n[i] + square) - np.sqrt(n[i])) / alpha * w
            n[i] += square
    every = weights(np.arange(size + 1))
    return every[:size], float(every[size])


@dataclass
class Model:
    """The slots with a weight, their weights, and the bias."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        table = np.zeros(SLOTS, np.float64)
        table[self.slots] = self.weights
        return table


def score_texts(table: np.ndarray, bias: float, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The probability of class 1 of each text. A slot counts once; those without a weight are left out at once."""
    known = [(d[w], s[w]) for d, s in grams(data, offsets) if len(w := np.flatnonzero(table[s]))]
    margin = np.full(len(offsets) - 1, bias)
    if known:
        keys = np.unique(np.concatenate([d * SLOTS + s for d, s in known]))
        margin += np.bincount(keys // SLOTS, table[keys % SLOTS], len(margin))
    return sigmoid(margin)


def _take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots of the chosen documents."""
    for batch in batches:
        for a, b, data, offsets in ta.chunks(batch.column("text")):
            slots, bounds = features(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(a, b - a), batch.column("order").slice(a, b - a),
                 pa.array([slots[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])], pa.binary())], names=["label", "order", "slots"])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task that learns from the sample, a bounded number of rows, and puts out the weights that are not zero (bias: slot -1)."""
    rows, labels = [], []
    for batch in batches:
        labels += batch.column("label").to_pylist()
        rows += [np.frombuffer(s, np.int32) for s in batch.column("slots").to_pylist()]
    target = np.array(labels, float)
    # Both classes weigh the same, and a row one on average.
    share = np.array([max((target == k).mean(), 1e-9) for k in (0, 1)])
    w, bias = ftrl(rows, target, 0.5 / share[target.astype(int)])
    slots = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(slots, -1), pa.int32()), pa.array(np.append(w[slots], bias), pa.float64())], names=["slot", "weight"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, doc: str = "doc_id", text: str = "text",
        label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on labelled documents (those where ``learn``, a condition on column ``doc``, holds): of each class the ``sample``
    with the smallest hashes of their id, and no more rows than that even where ids repeat.

    Of several labels of a document the highest counts; rows without a label or id don't. Without documents of both
    classes the score is that of the only class; 0 if there is none at all.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(doc).alias("__id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("__id").isNotNull() & F.col("label").isin(0, 1))
    known = known.groupBy("__id").agg(F.max("label").alias("label")).withColumn("order", F.xxhash64("__id"))
    if learn is not None:
        known = known.withColumnRenamed("__id", doc).where(learn).withColumnRenamed(doc, "__id")
    chosen = None
    for kind in (0, 1):
        top = known.where(F.col("label") == kind).orderBy("order").limit(sample)  # a bounded top-n
        chosen = top if chosen is None else chosen.unionByName(top)
    texts = docs.select(F.col(doc).alias("__id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(chosen), "__id").select("label", "order", "text")  # at most 2 * sample ids
    found = workspace.write_table(
        rows.mapInArrow(_take_apart, "label int, order long, slots binary"), workspace.new_path(spark, "toxicity"))
    classes = {r["label"] for r in found.select("label").distinct().collect()}
    if len(classes) < 2:
        return Model(np.zeros(0, np.int32), np.zeros(0), 30.0 if 1 in classes else -30.0)
    parts = [found.where(F.col("label") == kind).orderBy("order", "slots").limit(sample) for kind in (0, 1)]
    weights = parts[0].unionByName(parts[1]).coalesce(1).sortWithinPartitions("order", "label", "slots").mapInArrow(
        _learn, "slot int, weight double").toPandas()  # at most SLOTS + 1 rows, a few thousand as a rule
    bias = weights["slot"] < 0
    return Model(weights["slot"][~bias].to_numpy(np.int32), weights["weight"][~bias].to_numpy(), float(weights["weight"][bias].iloc[0]))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` plus column ``name`` (not taken yet), the probability of class 1 of the whole text. Null and empty texts get that of the bias."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # at most 12 bytes a slot
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**shared.value)
        table = own.table()
        for batch in batches:
            found = [score_texts(table, own.bias, data, offsets) for _, _, data, offsets in ta.chunks(batch.column(text))]
            column = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [column], names=[*names, name])

    return docs.mapInArrow(run, T.StructType(list(docs.schema.fields)).add(name, T.DoubleType()))


def classify(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``score``, ``predicted``; learnt without the held-out rows.

    Repeated rows are scored alike; an empty table gives an empty one; other columns are ignored.
    """
    model = fit(docs, labels, ~held_out(doc, 5, 0), doc, text)
    rows = docs.select(F.col(doc).alias("doc_id"), held_out(doc, 5, 0).alias("held_out"), F.col(text).alias("text"))
    return score(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows judged toxic; all columns stay."""
    model = fit(docs, labels, ~held_out(doc, 5, 0), doc, text)
    name = fresh("toxic_score", docs.columns)
    return score(docs, model, text, name).where(F.col(name) < THRESHOLD).select(docs.columns)
