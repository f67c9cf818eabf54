"""BPE encoding and decoding: distinct words as a trie, walked in depth with the last token of each prefix as state.

A word's encoding is the encoding of a shorter prefix plus one last token, and that token is the only one which ends the
prefix and stands next to the shorter prefix's last token without a merge across. So one number per trie node is enough,
and shared prefixes are worked out once. Sorted words are that trie in depth-first order: the states of the path to the
previous word are kept, and a word starts from where its path leaves it.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

CACHE_WORDS = 200_000  # words a task remembers; beyond that it starts anew
BATCH_DOCS = 128  # documents whose new words share one trie
NEVER = 1 << 60


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary (fixed by the format)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordBpe:
    """Tables of a word-end BPE and the walk over a trie of words."""

    def __init__(self, model: str):
        spec = json.loads(model)
        letters = _byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.text = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for at, (left, right) in enumerate(spec["model"]["merges"]):
            pair, token = (vocab[left], vocab[right]), vocab[left + right]
            self.rank.setdefault(pair, at)
            self.made.setdefault(token, (at, *pair))
        # Symbols: a byte, or a byte that ends its word (256 more).
        base = {c for c in letters.values()} | {c + end for c in letters.values()}
        self.length: dict[int, int] = {}
        spelled: dict[int, list[int]] = {}
        for text, token in vocab.items():
            if token in self.made or text in base:
                symbols = [byte_of[c] for c in text.removesuffix(end)]
                if text.endswith(end):
                    symbols[-1] += 256
                spelled[token], self.length[token] = symbols, len(symbols)
        self._index_suffixes(spelled)
        self.spines: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self.joined: dict[int, bool] = {}

    def _index_suffixes(self, spelled: dict[int, list[int]]) -> None:
        """A node for each start of a token; ``ends`` has the tokens that end its text, the longest first."""
        self.step: dict[int, int] = {}  # node and symbol to the node of the longest suffix that starts a token
        own, below = [0], [[]]
        for token, symbols in spelled.items():
            node = 0
            for symbol in symbols:
                child = self.step.get(node << 9 | symbol)
                if child is None:
                    child = len(own)
                    self.step[node << 9 | symbol] = child
                    own.append(0)
                    below.append([])
                    below[node].append((symbol, child))
                node = child
            own[node] = token + 1
        self.shorter = [0] * len(own)
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(own)
        layer = [(0, symbol, child) for symbol, child in below[0]]
        while layer:
            following = []
            for parent, symbol, node in layer:
                shorter = self._next(self.shorter[parent], symbol) if parent else 0
                self.shorter[node] = shorter
                token = own[node] - 1
                self.ends[node] = ((((token, self.length[token]),) if token >= 0 else ()) + self.ends[shorter])
                following += [(node, s, c) for s, c in below[node]]
            layer = following

    def _next(self, node: int, symbol: int) -> int:
        """The node after one more symbol; every single symbol is a token, so there is one."""
        passed = []
        while (found := self.step.get(node << 9 | symbol)) is None:
            passed.append(node)
            node = self.shorter[node]
        for node in passed:
            self.step[node << 9 | symbol] = found
        return found

    def _spine(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The tokens that stand at one edge while ``token`` is being built, each with the rank that uses it up."""
        key = (token, right)
        if key not in self.spines:
            own, used = [], NEVER
            while True:
                own.append((token, used))
                if token not in self.made:
                    break
                used, left_part, right_part = self.made[token]
                token = right_part if right else left_part
            self.spines[key] = own
        return self.spines[key]

    def stay_apart(self, left: int, right: int) -> bool:
        """True when no merge would cross the border between the two tokens. Of equal merges the left one goes first."""
        apart = True
        for x, x_used in self._spine(left, True):
            for y, y_used in self._spine(right, False):
                at = self.rank.get((x, y))
                if at is not None and at < x_used and at <= y_used:
                    apart = False
        self.joined[left << 16 | right] = apart
        return apart

    def _last(self, node: int, n: int, states: list[int]) -> int:
        """Last token of the encoding of a prefix of ``n`` symbols; ``states`` has those of all shorter prefixes."""
        known = self.joined
        for token, size in self.ends[node]:
            if size == n:
                return token
            before = states[n - size]
            apart = known.get(before << 16 | token)
            if apart or (apart is None and self.stay_apart(before, token)):
                return token
        raise ValueError("no token ends this prefix")

    def encode_words(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each word with its token ids. ``words`` are distinct and not empty."""
        states, path, before, step, last = [-1], [0], b"", self.step, self._last
        for word in sorted(words):
            size = len(word)
            shared, most = 0, min(len(states), size) - 1
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del states[shared + 1:], path[shared + 1:]
            node = path[shared]
            for n in range(shared + 1, size):
                symbol = word[n - 1]
                following = step.get(node << 9 | symbol)
                node = self._next(node, symbol) if following is None else following
                path.append(node)
                states.append(last(node, n, states))
            before = word
            token = last(self._next(node, word[-1] + 256), size, states)
            ids, n = [token], size - self.length[token]
            while n:
                token = states[n]
                ids.append(token)
                n -= self.length[token]
            yield word, ids[::-1]


# The pattern that cuts normalised text into words, and the same for pure ASCII.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)


def words_of(text: str) -> list[str]:
    """The words of a text without special tokens, composed and in lower case."""
    if text.isascii():
        return ASCII_WORDS.findall(text.lower())
    # Letter by letter, as the format asks: the final form of sigma is never chosen.
    return WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


class Encoder:
    """Texts to packed ids and decoded text, remembering a bounded number of words."""

    def __init__(self, model: str, cache_words: int = CACHE_WORDS):
        self.bpe, self.limit = WordBpe(model), cache_words
        self.known: dict[str, tuple[bytes, str]] = {}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.bpe.special, key=len, reverse=True)) + ")")
        self.special = {t: (struct.pack("<I", i), t) for t, i in self.bpe.special.items()}

    def _parts(self, text: str) -> list[tuple[str, bool]]:
        """Words, and special tokens marked as such."""
        if "<|" not in text:
            return [(w, False) for w in words_of(text)]
        out = []
        for piece in self.cut.split(text):
            out += [(piece, True)] if piece in self.special else [(w, False) for w in words_of(piece)]
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """For each text the ids as little-endian 32-bit numbers, and the decoded text."""
        plain = [words_of(t) if "<|" not in t else None for t in texts]
        mixed = {i: self._parts(texts[i]) for i, p in enumerate(plain) if p is None}
        if len(self.known) > self.limit:
            self.known.clear()
        new = set().union(*(p for p in plain if p is not None), (w for p in mixed.values() for w, s in p if not s))
        new.difference_update(self.known)
        by_bytes = {w.encode("utf-8"): w for w in new}
        text = self.bpe.text
        for word, ids in self.bpe.encode_words(list(by_bytes)):
            self.known[by_bytes[word]] = (struct.pack(f"<{len(ids)}I", *ids), " ".join([text[i] for i in ids]))
        out = []
        for i, own in enumerate(plain):
            found = [self.known[w] for w in own] if own is not None else [
                self.special[w] if s else self.known[w] for w, s in mixed[i]]
            out.append((b"".join([f[0] for f in found]), " ".join([f[1] for f in found])))
        return out


def _task(model, make: Callable, text: str, keep: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(at, BATCH_DOCS)
                texts = [t or "" for t in part.column(text).to_pylist()]
                columns = [part.column(c) for c in keep] + make(encoder.encode(texts))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _apply(docs: DataFrame, path: str, text: str, keep: list[str], added: list[tuple[str, str]], make: Callable) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    with open(path, encoding="utf-8") as file:  # the vocabulary: a parameter of fixed size, sent once per executor
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(*keep, *([] if text in keep else [text]))
    kinds = ", ".join(f"{n} {t}" for n, t in added)
    out = StructType([f for f in rows.schema.fields if f.name in keep] + StructType.fromDDL(kinds).fields)
    return rows.mapInArrow(_task(model, make, text, keep, to_arrow_schema(out)), out)


def _digests(found: list[tuple[bytes, str]]) -> list[pa.Array]:
    return [
        pa.array([len(ids) // 4 for ids, _ in found], pa.int64()),
        pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in found], pa.string()),
        pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for _, t in found], pa.string()),
    ]


def _ids(found: list[tuple[bytes, str]]) -> list[pa.Array]:
    ends = [0]
    for ids, _ in found:
        ends.append(ends[-1] + len(ids) // 4)
    values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join([ids for ids, _ in found]))])
    return [pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), values).cast(pa.list_(pa.int32())),
            pa.array([len(ids) // 4 for ids, _ in found], pa.int64())]


def _ids_and_text(found: list[tuple[bytes, str]]) -> list[pa.Array]:
    return _ids(found) + [pa.array([t for _, t in found], pa.string())]


def digests(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    A null text counts as empty and has no tokens; repeated rows come out as often; other columns are ignored.
    """
    return _apply(docs, path, text, [doc], [
        ("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")], _digests)


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text", decoded: bool = True) -> DataFrame:
    """The columns ``keep``, ``ids`` (array of int), ``n_tokens`` and, if asked for, ``decoded``.

    Decoding joins the tokens by a space, as the format does. Null and repeated texts as in ``digests``.
    """
    added = [("ids", "array<int>"), ("n_tokens", "long")]
    if decoded:
        return _apply(docs, path, text, keep, added + [("decoded", "string")], _ids_and_text)
    return _apply(docs, path, text, keep, added, _ids)
