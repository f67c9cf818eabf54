"""Language identification with bit-sliced Bloom filters: one look-up of an n-gram tells all languages that have it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.llm import textarrays as ta
from txguard.llm.quality import fresh, held_out

SIZE = 4  # bytes in an n-gram
# A language contains an n-gram that makes this share of its n-grams, whatever other languages do. With 0 one foreign passage in
# one text would do, and in a large corpus every language would contain the n-grams of all.
MIN_RATE = 2e-5
HASHES = 3
SLOTS_PER_GRAM = 12  # slots for each distinct n-gram, of whatever language ...
MAX_SLOTS = 1 << 24  # ... up to so many: the filters' size is bounded; fuller ones err more often, which the rates correct
BLOCK = 1 << 12  # slots that come to the driver in one piece
UNKNOWN = "und"
MIN_SCORE = 0.3  # a document of whose n-grams its language has a smaller share is rejected

_BYTES = np.arange(256)
#: Letters folded, everything below 128 that is no letter a space.
FOLDED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, np.where(((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128), _BYTES, 32)).astype(np.uint8)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each document, two spaces before and after it, and the documents' bounds among them."""
    docs = len(offsets) - 1
    padded = np.full(len(data) + 4 * docs, 32, np.uint8)
    padded[np.arange(len(data)) + np.repeat(4 * np.arange(docs) + 2, np.diff(offsets))] = FOLDED[data]
    wide = padded.astype(np.uint32)
    every = np.zeros(max(len(wide) - SIZE + 1, 0), np.uint32)
    for j in range(SIZE):
        every |= wide[j:j + len(every)] << np.uint32(8 * j)
    ends = offsets + 4 * np.arange(docs + 1)
    inside = np.ones(len(every), bool)
    for j in range(1, SIZE):  # windows that reach into the next document
        cut = ends[1:-1] - j
        inside[cut[cut < len(every)]] = False
    bounds = np.concatenate([[0], np.cumsum(np.diff(ends) - (SIZE - 1))]) if docs else np.zeros(1, np.int64)
    kept = every[inside]
    # Runs of spaces say nothing.
    blank = kept == np.uint32(0x20202020)
    return kept[~blank], bounds - np.concatenate([[0], np.cumsum(blank)])[bounds]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and n-gram, summed over the task."""
    names: dict[str, int] = {}
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        keys, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        one, inverse = np.unique(keys, return_inverse=True)
        return [(one, np.bincount(inverse, n, len(one)).astype(np.int64))]

    for batch in batches:
        own = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], np.uint64)
        for a, b, data, offsets in ta.chunks(batch.column("text")):
            found, bounds = grams(data, offsets)
            keys = (np.repeat(own[a:b], np.diff(bounds)) << np.uint64(32)) | found
            parts.append(np.unique(keys, return_counts=True))
            if len(parts) >= 16:
                parts = merged()
    if parts:
        keys, n = merged()[0]
        known = list(names)
        for at in range(0, len(keys), 100_000):
            part = keys[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([
                pa.array([known[i] for i in (part >> np.uint64(32)).tolist()], pa.string()),
                pa.array((part & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n[at:at + 100_000])], names=["lang", "gram", "n"])


@dataclass
class Filters:
    """``table`` has, for each slot, a bit per language; ``rate`` is the chance that an n-gram passes by accident."""

    names: list[str]
    table: np.ndarray  # slots x words of 64 languages
    rate: np.ndarray
    usual: int  # the language with most text, where no n-gram is known

    @staticmethod
    def slots(found: np.ndarray, size: int) -> Iterator[np.ndarray]:
        base = found.astype(np.uint64)
        for j in range(HASHES):
            yield ta.mix(base + np.uint64((j + 1) * int(ta.RADIX) % (1 << 64))) & np.uint64(size - 1)

    @classmethod
    def build(cls, names: list[str], members: list[np.ndarray], usual: int) -> Filters:
        """Filters of the given n-grams of each language."""
        size = slot_count(len(np.unique(np.concatenate([*members, np.zeros(0, np.uint64)]))))
        table = np.zeros((size, (len(names) + 63) // 64), np.uint64)
        for i, own in enumerate(members):
            for at in cls.slots(own, size):
                table[at, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        return cls.of(names, table, usual)

    @classmethod
    def of(cls, names: list[str], table: np.ndarray, usual: int) -> Filters:
        if len(names) <= 8:
            table = table.astype(np.uint8)
        fill = np.array([float(((table[:, i // 64] >> table.dtype.type(i % 64)) & table.dtype.type(1)).mean()) for i in range(len(names))])
        return cls(names, table, np.minimum(fill ** HASHES, 1 - 1e-9), usual)

    def guess(self, found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each document: the corrected share of its n-grams that the language has, whatever others have."""
        n = np.diff(bounds).astype(float)
        hits = np.zeros((len(self.names), len(n)))
        for word in range(self.table.shape[1]):
            masks = np.full(len(found), np.iinfo(self.table.dtype).max, self.table.dtype)
            for at in self.slots(found, len(self.table)):
                masks &= self.table[at, word]
            for i in range(64 * word, min(64 * word + 64, len(self.names))):
                hits[i] = ta.sums((masks >> masks.dtype.type(i % 64)) & masks.dtype.type(1), bounds)
        rate = self.rate[:, None]
        true = np.clip((hits - n * rate) / (1 - rate), 0, None)
        most, best = true.max(0), true.argmax(0)
        return np.where(most > 1e-9, best, self.usual), most / np.maximum(n, 1)


def slot_count(distinct: int) -> int:
    """Slots, a power of two, for so many distinct n-grams."""
    return min(MAX_SLOTS, 1 << max(BLOCK.bit_length() - 1, int(np.ceil(np.log2(max(1, distinct * SLOTS_PER_GRAM))))))


def _set_bits(names: list[str], size: int):
    """``(block, slot, word, bits)`` of the n-grams in a batch; those of a slot are one row."""
    number = {name: i for i, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            found = batch.column("gram").to_numpy().astype(np.uint64)
            words = (len(names) + 63) // 64
            keys = np.concatenate([at.astype(np.int64) * words + lang // 64 for at in Filters.slots(found, size)])
            bits = np.tile(np.uint64(1) << (lang % 64).astype(np.uint64), HASHES)
            order = np.argsort(keys, kind="stable")
            keys, bits = keys[order], bits[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
            merged = np.bitwise_or.reduceat(bits, first) if len(first) else bits
            slot = keys[first] // words
            yield pa.RecordBatch.from_arrays(
                [pa.array((slot // BLOCK).astype(np.int32)), pa.array(keys[first]), pa.array(merged.view(np.int64))], names=["block", "at", "bits"])

    return run


def _pack(words: int):
    """A block of the table as bytes, from its slots in any order."""
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros(BLOCK * words, np.uint64)
        table[part["at"].to_numpy() - key[0] * BLOCK * words] = part["bits"].to_numpy().view(np.uint64)
        return pd.DataFrame({"block": [key[0]], "data": [table.tobytes()]})

    return run


def fit(docs: DataFrame, learn: Column | None = None, text: str = "text", lang: str = "lang", *,
        min_rate: float = MIN_RATE) -> Filters | None:
    """Filters learnt from all rows with a language (where ``learn`` holds); None if there is no such row.

    Counts cover all those texts. A filter look-up returns every language that contains the n-gram, by ``min_rate`` (0:
    that has it at all). Spark puts the bits together; the driver gets the filters themselves, at most ``MAX_SLOTS`` slots
    with a bit for each language, and no n-grams. A name of any length is a language; there may be any number of them.
    """
    spark = docs.sparkSession
    rows = docs if learn is None else docs.where(learn)
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    stored = workspace.write_table(counted, workspace.new_path(spark, "language"))
    sizes = {r["lang"]: r["n"] for r in stored.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not sizes:
        return None
    names, words = sorted(sizes), (len(sizes) + 63) // 64
    total = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])  # a number for each language
    usual = stored.where(F.col("n") >= min_rate * total[F.col("lang")]).select("lang", "gram")
    members = workspace.write_table(usual, workspace.new_path(spark, "members"))
    size = slot_count(members.select("gram").distinct().count())
    bits = members.mapInArrow(_set_bits(names, size), "block int, at long, bits long")
    bits = bits.groupBy("block", "at").agg(F.bit_or("bits").alias("bits"))
    table = np.zeros(size * words, np.uint64)
    for row in bits.groupBy("block").applyInPandas(_pack(words), "block int, data binary").toLocalIterator():
        table[row["block"] * BLOCK * words:(row["block"] + 1) * BLOCK * words] = np.frombuffer(row["data"], np.uint64)
    return Filters.of(names, table.reshape(size, words), names.index(max(names, key=lambda n: (sizes[n], n))))


def _has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _guesser(shared, text: str, names: list[str], out: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(**shared.value) if shared.value else None
        for batch in batches:
            column = batch.column(text)
            lang, score = [], []
            for a, b, data, offsets in ta.chunks(column):
                letters = ta.sums(((FOLDED[data] != 32) & (data < 128)), offsets) > 0
                if filters is not None:
                    best, sure = filters.guess(*grams(data, offsets))
                for i in range(b - a):
                    if filters is not None and (letters[i] or _has_letter(column[a + i].as_py())):
                        lang.append(filters.names[best[i]])
                        score.append(float(min(1.0, sure[i])))
                    else:
                        lang.append(UNKNOWN)
                        score.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=names + out)

    return run


def guess(docs: DataFrame, filters: Filters | None, text: str = "text", names: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """``docs`` plus two columns (``names``, not taken yet): the language of the whole text and the share of its n-grams that
    the language has.

    ``und`` with 0 for null, for texts without a letter, and if nothing was learnt.
    """
    from pyspark.sql.types import DoubleType, StringType, StructType

    shared = docs.sparkSession.sparkContext.broadcast(vars(filters) if filters else None)  # at most MAX_SLOTS slots
    schema = StructType(list(docs.schema.fields)).add(names[0], StringType()).add(names[1], DoubleType())
    return docs.mapInArrow(_guesser(shared, text, docs.columns, list(names)), schema)


def identify(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score``; learnt without the held-out rows.

    Repeated rows are judged alike; an empty table gives an empty one; other columns are ignored.
    """
    filters = fit(docs, ~held_out(doc, 3, 1), text, lang)
    rows = docs.select(F.col(doc).alias("doc_id"), held_out(doc, 3, 1).alias("held_out"), F.col(text).alias("text"))
    return guess(rows, filters, names=("lang_pred", "score")).select("doc_id", "held_out", "lang_pred", "score")


def keep_known(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang",
               min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without texts that have no letter or that no learnt language has ``min_score`` of; all columns stay as they are.

    The share does not depend on the number of languages or on how alike they are. If none was learnt, texts with a letter stay.
    """
    filters = fit(docs, ~held_out(doc, 3, 1), text, lang)
    if filters is None:
        return docs.where(F.col(text).rlike(r"\p{L}"))
    names = (fresh("lang_pred", docs.columns), fresh("lang_score", docs.columns))
    found = guess(docs, filters, text, names)
    return found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= min_score)).select(docs.columns)
