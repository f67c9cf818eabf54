"""Quality classifier: naive Bayes support vectors over word and shape n-grams.

Every n-gram is an indicator, scaled by the log ratio of its smoothed shares in the two classes; a linear model on these
is fitted with the hinge loss by dual coordinate descent, and a logistic curve turns its margin into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.llm import textarrays as ta

SAMPLE = 4000  # documents of each class that the linear model is fitted on, at most
BROADCAST_LABELS = 4_000_000  # above so many labelled documents, labels meet texts in a shuffle
THRESHOLD = 0.7
SMOOTH = 1.0
COST, ROUNDS = 1.0, 12

# Slots: shape n-grams with their share first, then hashed words and word pairs.
SHAPES = 32  # upper, capital, lower, digits, other, repeated word, and kinds of marks
LEVELS = 12  # shares of 1, 1/2, 1/4, ... of the tokens
GRAMS = SHAPES + SHAPES * SHAPES
SHAPE_SLOTS = GRAMS * LEVELS
WORD_SLOTS = 1 << 17
SLOTS = SHAPE_SLOTS + WORD_SLOTS


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of each document, and the documents' bounds among them."""
    docs = len(offsets) - 1
    raw, starts, kind, bounds = ta.tokens(data, offsets, (ta.LETTER, ta.PUNCT), fold=False)
    doc = np.repeat(np.arange(docs), np.diff(bounds))
    is_word = kind == ta.LETTER
    first = data[starts] if len(starts) else np.zeros(0, np.uint8)
    second = data[np.minimum(starts + 1, max(len(data) - 1, 0))] if len(starts) else first
    upper, lower = lambda b: (b >= 65) & (b <= 90), lambda b: (b >= 97) & (b <= 122)
    shape = np.where(upper(first), np.where(upper(second), 0, 1), np.where(lower(first), 2, np.where((first >= 48) & (first <= 57), 3, 4)))
    shape = np.where(is_word, shape, 6 + (raw % np.uint64(SHAPES - 6)).astype(np.int64))
    words = np.flatnonzero(is_word)
    same = words[1:][(raw[words[1:]] == raw[words[:-1]]) & (doc[words[1:]] == doc[words[:-1]])]
    shape[same] = 5

    counts = np.zeros(docs * GRAMS, np.int32)
    if len(shape):
        counts += np.bincount(doc * GRAMS + shape, minlength=docs * GRAMS).astype(np.int32)
        inside = np.flatnonzero(doc[1:] == doc[:-1])
        counts += np.bincount(doc[inside] * GRAMS + SHAPES + shape[inside] * SHAPES + shape[inside + 1], minlength=docs * GRAMS).astype(np.int32)
    hit = np.flatnonzero(counts)
    share = counts[hit] / np.maximum(np.diff(bounds), 1)[hit // GRAMS]
    level = np.minimum(-np.log2(share), LEVELS - 1).astype(np.int64)
    keys = [(hit // GRAMS) * SLOTS + (hit % GRAMS) * LEVELS + level]

    folded, _, _, word_bounds = ta.tokens(data, offsets)
    for size in (1, 2):
        grams, gram_bounds = ta.runs(folded, word_bounds, size)
        of = np.repeat(np.arange(docs), np.diff(gram_bounds))
        keys.append(of * SLOTS + SHAPE_SLOTS + (grams % np.uint64(WORD_SLOTS)).astype(np.int64))
    every = np.unique(np.concatenate(keys))
    return (every % SLOTS).astype(np.int32), np.searchsorted(every, np.arange(docs + 1) * SLOTS)


@dataclass
class Model:
    """``gain`` is weight times ratio of each slot, ``square`` the squared ratio (for the length of a document's vector)."""

    gain: np.ndarray
    square: np.ndarray
    slope: float
    shift: float

    def margins(self, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        norm = np.sqrt(ta.sums(self.square[slots], bounds))
        return ta.sums(self.gain[slots], bounds) / np.maximum(norm, 1e-12)

    def score(self, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(slots, bounds) + self.shift, -30, 30)))


def log_ratios(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Log of the ratio of smoothed shares of each slot in the two classes."""
    p, q = good + SMOOTH, bad + SMOOTH
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: float = COST,
                 rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the linear hinge-loss model: one dual variable per document, between 0 and ``cost``."""
    w, alpha = np.zeros(SLOTS), np.zeros(len(rows))
    size = np.array([float(v @ v) for v in values])
    order, shuffle = np.flatnonzero(size > 0), np.random.default_rng(1)
    for _ in range(rounds):
        shuffle.shuffle(order)
        moved = 0.0
        for i in order:
            gradient = sign[i] * (w[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - gradient / size[i], 0.0), cost)
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * sign[i] * values[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def logistic(margin: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the weighted logistic curve from margins to labels, lightly held to finite values."""
    x, b = np.stack([margin, np.ones_like(margin)], 1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * b
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        b = b - step
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the slots per class at the end of the task (``kind`` 0), and the slots of chosen documents (1)."""
    counts = np.zeros((2, SLOTS), np.int64)
    seen = np.zeros(2, np.int64)
    names = ["kind", "label", "order", "slot", "n", "slots"]

    def out(kind, label, order, slot, n, slots):
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(label), kind), pa.int32()), pa.array(label, pa.int32()), pa.array(order, pa.int64()),
            pa.array(slot, pa.int32()), pa.array(n, pa.int64()), pa.array(slots, pa.binary())], names=names)

    for batch in batches:
        labels, chosen = batch.column("label").to_numpy(), batch.column("chosen").to_numpy(zero_copy_only=False)
        order = batch.column("order").to_numpy()
        for a, b, data, offsets in ta.chunks(batch.column("text")):
            slots, bounds = features(data, offsets)
            own = np.repeat(labels[a:b], np.diff(bounds))
            for label in (0, 1):
                counts[label] += np.bincount(slots[own == label], minlength=SLOTS)
                seen[label] += int((labels[a:b] == label).sum())
            kept = np.flatnonzero(chosen[a:b])
            if len(kept):
                yield out(1, labels[a:b][kept], order[a:b][kept], np.zeros(len(kept)), np.zeros(len(kept)),
                          [slots[bounds[i]:bounds[i + 1]].tobytes() for i in kept])
    for label in (0, 1):
        slot = np.flatnonzero(counts[label])
        if len(slot):
            yield out(0, np.full(len(slot), label), np.zeros(len(slot)), slot, counts[label][slot], [b""] * len(slot))


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, doc: str = "doc_id", text: str = "text",
        label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on the labelled documents (those where ``learn``, a condition on column ``doc``, holds).

    The class counts of the n-grams cover all labelled documents; the linear model takes at most ``sample`` documents
    of each class, those with the smallest hashes of their id. Of several labels of a document the lowest counts; rows
    without a label or id don't. Without documents of both classes the score is the share of class 1 (1 if unknown).
    """
    spark = docs.sparkSession
    known = labels.select(F.col(doc).alias("__id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("__id").isNotNull() & F.col("label").isin(0, 1))
    known = known.groupBy("__id").agg(F.min("label").alias("label")).withColumn("order", F.xxhash64("__id"))
    if learn is not None:
        known = known.withColumnRenamed("__id", doc).where(learn).withColumnRenamed(doc, "__id")
    small = known.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    # Where the sample ends, for each class: a number taken from a bounded top-n.
    ends = {}
    for kind in (0, 1):
        top = known.where(F.col("label") == kind).orderBy("order").limit(sample)
        ends[kind] = top.agg(F.max("order")).first()[0]
    last = F.when(F.col("label") == 0, F.lit(ends[0])).otherwise(F.lit(ends[1])).cast("long")
    known = known.withColumn("chosen", F.coalesce(F.col("order") <= last, F.lit(False)))
    texts = docs.select(F.col(doc).alias("__id"), F.col(text).alias("text"))
    joined = texts.join(F.broadcast(known) if small else known, "__id").select("label", "order", "chosen", "text")
    schema = "kind int, label int, order long, slot int, n long, slots binary"
    found = workspace.write_table(joined.mapInArrow(_gather, schema), workspace.new_path(spark, "quality"))

    counts = np.zeros((2, SLOTS))
    # At most two rows per slot, whatever the corpus.
    for row in found.where("kind = 0").groupBy("label", "slot").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["label"], row["slot"]] = row["n"]
    # At most 2 * sample documents (repeated rows of one id share its hash and are cut at the same bound).
    rows = []
    for kind in (0, 1):
        rows += found.where((F.col("kind") == 1) & (F.col("label") == kind)).orderBy("order", "slots").limit(sample).collect()
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2 or len({r["label"] for r in rows}) < 2:
        share = 1.0 if not totals else float(sum(k * n for k, n in totals.items()) / sum(totals.values()))
        zero = np.zeros(SLOTS, np.float32)
        return Model(zero, zero, 0.0, 30.0 if share > 0.5 else -30.0)

    ratio = log_ratios(counts[0], counts[1])
    slots = [np.frombuffer(r["slots"], np.int32) for r in rows]
    sign = np.array([1.0 if r["label"] else -1.0 for r in rows])
    values = [ratio[s] / max(np.linalg.norm(ratio[s]), 1e-12) for s in slots]
    # The curve is fitted on margins that each half gets from a model of the other half.
    half = np.arange(len(rows)) % 2 == 0
    margin = np.zeros(len(rows))
    for part in (half, ~half):
        w = dual_descent([s for s, p in zip(slots, part) if p], [v for v, p in zip(values, part) if p], sign[part])
        for i in np.flatnonzero(~part):
            margin[i] = w[slots[i]] @ values[i]
    weight = np.where(sign > 0, totals[1] / max((sign > 0).sum(), 1), totals[0] / max((sign < 0).sum(), 1))
    slope, shift = logistic(margin, (sign > 0).astype(float), weight)
    w = dual_descent(slots, values, sign)
    return Model((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), slope, shift)


def fresh(base: str, taken: list[str]) -> str:
    """A column name that is not taken."""
    while base.lower() in {t.lower() for t in taken}:
        base += "_"
    return base


def _scorer(shared, text: str, names: list[str], name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in batches:
            scores = [model.score(*features(data, offsets)) for _, _, data, offsets in ta.chunks(batch.column(text))]
            column = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [column], names=[*names, name])

    return run


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` plus column ``name`` (not taken yet), the probability of class 1 of the whole text. Null and empty texts get that of no n-gram."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # two numbers per slot: a fixed size
    from pyspark.sql.types import DoubleType, StructType

    schema = StructType(list(docs.schema.fields)).add(name, DoubleType())
    return docs.mapInArrow(_scorer(shared, text, docs.columns, name), schema)


def held_out(doc: str, parts: int, part: int) -> Column:
    """Rows kept away from learning, by a checksum of the id; rows without an id are not among them."""
    return F.coalesce(F.crc32(F.col(doc).cast("string")) % parts == part, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``score``, ``predicted``; learnt without the held-out rows.

    Repeated rows are scored alike; an empty table gives an empty one; other columns are ignored.
    """
    model = fit(docs, labels, ~held_out(doc, 4, 2), doc, text)
    rows = docs.select(F.col(doc).alias("doc_id"), held_out(doc, 4, 2).alias("held_out"), F.col(text).alias("text"))
    return score(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose score is below the threshold; all columns stay."""
    model = fit(docs, labels, ~held_out(doc, 4, 2), doc, text)
    name = fresh("quality_score", docs.columns)
    return score(docs, model, text, name).where(F.col(name) >= THRESHOLD).select(docs.columns)
