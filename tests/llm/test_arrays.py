import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txguard.llm import blocks, textarrays

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9é中 \n.,-😀", max_size=40)), max_size=12)


def words(text):
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def fold(word):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in word)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 30))
def test_tokens_and_runs_are_those_of_the_texts(texts, limit):
    seen, grams, at = {}, {}, 0
    for a, b, data, offsets in textarrays.chunks(pa.array(texts, pa.string()), limit):
        assert a == at
        at = b
        hashes, _, _, bounds = textarrays.tokens(data, offsets)
        found, ends = textarrays.runs(hashes, bounds, 3, whole=True)
        for i in range(b - a):
            own = [fold(w) for w in words(texts[a + i])]
            assert bounds[i + 1] - bounds[i] == len(own)
            for word, value in zip(own, hashes[bounds[i]:bounds[i + 1]].tolist()):
                assert seen.setdefault(word, value) == value
            expected = [tuple(own[j:j + 3]) for j in range(max(1, len(own) - 2))] if own else []
            assert ends[i + 1] - ends[i] == len(expected)
            for gram, value in zip(expected, found[ends[i]:ends[i + 1]].tolist()):
                assert grams.setdefault(gram, value) == value
    assert at == len(texts)
    assert len(set(seen.values())) == len(seen) and len(set(grams.values())) == len(grams)


def test_sums_of_documents():
    assert textarrays.sums(np.array([1.0, 2.0, 4.0]), np.array([0, 2, 2, 3])).tolist() == [3.0, 0.0, 4.0]


@pytest.mark.parametrize("cut", [1, 2, 3, 7])
def test_groups_across_batches(cut):
    rows = pd.DataFrame({"g": [1, 1, 2, 3, 3, 3, 4], "h": [0, 0, 0, 1, 1, 1, 0], "v": range(7)})
    frames = [rows.iloc[i:i + cut] for i in range(0, 7, cut)] + [rows.iloc[:0]]
    assert [list(f["v"]) for f in blocks.sorted_groups(iter(frames), ["g", "h"])] == [[0, 1], [2], [3, 4, 5], [6]]


@pytest.mark.parametrize("limit", [100, 0])
def test_every_pair_meets_once(spark, monkeypatch, limit):
    monkeypatch.setattr(blocks, "HOT_LIMIT", limit)
    members = spark.createDataFrame([(g, i) for g, n in ((1, 40), (2, 3)) for i in range(n)], "g int, i int")
    sizes = members.groupBy("g").count().withColumnRenamed("count", "weight")
    rows = blocks.block_pairs(members, sizes, "g", "i", 10).collect()
    met = {}
    for r in rows:
        met.setdefault((r.g, r.low, r.high), []).append((r.i, r.block))
    pairs = [(g, a, b) for (g, low, high), own in met.items() for a, p in own for b, q in own if a < b and (low == high or p != q)]
    assert len(pairs) == len(set(pairs)) == 40 * 39 // 2 + 3
    assert max(len(own) for own in met.values()) < 40
