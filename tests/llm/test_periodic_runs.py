import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txguard.llm import catalog, periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(words, least, times):
    """Every stretch that no neighbour extends, for every period; the smallest period of a stretch counts."""
    best, n = {}, len(words)
    for q in range(1, n):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                best.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in best.items())


def collapsed_by_hand(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def both(texts, least, times):
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    packed, lengths, bounds = periodic_runs.split(np.frombuffer(data, np.uint8), offsets)
    found = periodic_runs.runs(periodic_runs.numbers(packed, lengths), bounds, least, times)
    own = [[] for _ in texts]
    for i, *run in zip(*(x.tolist() for x in found)):
        own[i].append(tuple(run))
    return own, [c.decode() for c in periodic_runs.collapse(packed, lengths, bounds, found)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab \n", max_size=40), max_size=5), st.sampled_from([(2, 2), (4, 2), (6, 3), (24, 3)]))
def test_small_alphabets_like_by_hand(texts, limits):
    own, texts_left = both(texts, *limits)
    for text, runs, left in zip(texts, own, texts_left):
        words = WORD.findall(text)
        assert runs == runs_by_hand(words, *limits)
        assert left == collapsed_by_hand(words, runs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(2, 30), st.lists(st.integers(0, 3), max_size=9))
def test_repeated_blocks_like_by_hand(block, times, tail):
    words = [f"w{x}" for x in block * times + tail + block * 3]
    own, left = both([" ".join(words)], 24, 3)
    assert own[0] == runs_by_hand(words, 24, 3) and left[0] == collapsed_by_hand(words, own[0])


@pytest.mark.parametrize("probes", [1, 1 << 21])
def test_fibonacci_words(monkeypatch, probes):
    """Words with as many runs as a text can have, in one text and beside others."""
    monkeypatch.setattr(periodic_runs, "PROBES", probes)
    a, b = "a", "ab"
    while len(b) < 200:
        a, b = b, b + a
    texts = [" ".join(b), "", " ".join(b[::-1]), " ".join("abc" * 30)]
    own, _ = both(texts, 2, 2)
    assert own == [runs_by_hand(t.split(), 2, 2) for t in texts] and len(own[0]) > 100


def test_bytes_that_part_words():
    own, left = both(["a\x0bb\x0cc d e  f\r\n", "\x1f \x00"], 24, 3)
    assert left == ["a b c d e f", "\x1f \x00"] and own == [[], []]


def test_strongest_is_exact_and_first():
    assert periodic_runs.strongest([]) is None
    assert periodic_runs.strongest([(0, 30, 10), (5, 60, 20), (9, 31, 10)]) == (9, 31, 10)
    assert periodic_runs.strongest([(0, 30, 10), (0, 60, 20)]) == (0, 30, 10)
    big = 10**9
    assert periodic_runs.strongest([(0, 3 * big, big), (1, 3 * big + 2, big + 1), (2, 3 * big + 1, big)]) == (2, 3 * big + 1, big)


ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "x " * 24), (4, "x " * 24), (5, "x " * 23), (None, "p q r " * 9), (6, "one " + "é ü " * 40 + "two"), (7, "w " * 100_000)]


def test_rows_of_all_kinds(documents, clashing):
    docs = clashing(documents(*ODD))
    found = periodic_runs.find(docs)
    assert found.columns == docs.columns + ["n_words", "runs", "strongest", "collapsed"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(ODD) and periodic_runs.find(documents()).count() == 0
    assert [rows[i]["runs"] for i in (1, 2, 3, 5)] == [[]] * 4 and rows[1]["collapsed"] == "" and rows[3]["n_words"] == 0
    assert [tuple(r) for r in rows[4]["runs"]] == [(0, 24, 1)] and rows[4]["collapsed"] == "x"
    assert tuple(rows[None]["strongest"]) == (0, 27, 3) and rows[6]["collapsed"] == "one é ü two"
    assert tuple(rows[7]["strongest"]) == (0, 100_000, 1) and rows[1]["strongest"] is None
    with pytest.raises(ValueError):
        periodic_runs.find(found)


def test_texts_do_not_meet():
    texts = ["a b " * 20, "c", "", "d e f " * 9]
    whole = both(texts, 24, 3)
    rows = [both([t], 24, 3) for t in texts]
    assert whole == ([r[0][0] for r in rows], [r[1][0] for r in rows])


def test_planted_periods(documents):
    texts = {i: " ".join(f"w{j * j % 17}" for j in range(i % 60)) for i in range(200)}
    rows = {r["doc_id"]: r["text"] for r in catalog.with_planted_periods(documents(*texts.items(), (None, "a b"), (-5, None))).collect()}
    for i, text in texts.items():
        words, h = text.split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            text = " ".join(words[a + (j - a) % p] if j >= a else words[j] for j in range(n))
        assert rows[i] == text
    assert rows[None] == "a b" and rows[-5] is None
