import re
from collections import Counter, defaultdict

import pytest

from txguard.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(rows, min_docs, top):
    """The contract, straight: rows of (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    inside, whole, own = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = terms(text)
        inside[lang].update(set(found))
        whole[lang].update(found)
        own[lang, source].update(found)
    out = []
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in inside[lang].items() if n >= min_docs]
        share = lambda counts, t: 1 + 10**9 * (counts[t] + 5) // (sum(counts[k] for k in kept) + 5 * len(kept))
        q = {t: share(whole[lang], t) for t in kept}
        p = {s: {t: share(own[lang, s], t) for t in kept} for _, s in {r[:2] for r in rows if r[0] == lang}}
        for s in p:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s]
            high = [(q[t] - p[s][t], t.encode(), t) for t in kept if own[lang, s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(high)[:top])):
                out += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(ranked)]
    return sorted(out)


ROWS = [
    ("en", "a", "One two two THREE"), ("en", "a", "one Two"), ("en", "b", "one three four É é"), ("en", "b", None), ("en", "c", ""),
    ("en", "c", "one é four"), ("en", "c", "one é four"), (None, "a", "one one"), (None, None, "one"), ("fr", "a", "seul"), ("fr", "b", "12 !!"),
    ("de", "x", "9 9"), ("de", "y", None), ("en", "d", "ü ü one-two_three\nfour"), ("en", None, "zwei " * 5000 + "two"),
]


@pytest.fixture
def build(spark):
    def make(rows):
        return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")

    return make


@pytest.mark.parametrize("min_docs, top", [(1, 50), (2, 50), (2, 1), (30, 50), (1, 3)])
def test_like_by_hand(build, clashing, min_docs, top):
    docs = clashing(build(ROWS)).withColumnsRenamed({"n": "term", "at": "n", "w": "value", "first": "docs"})
    found = divergence.audit(docs, min_docs=min_docs, top=top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == by_hand(ROWS, min_docs, top)


def test_ties_across_cells_and_many_sources(build, monkeypatch):
    """Blocks smaller than the number of sources, small pieces of text, and counts passed on early."""
    rows = [("en", f"s{i % 7}", " ".join(chr(97 + (i * j) % 11) * (1 + j % 3) for j in range(40))) for i in range(60)]
    whole = by_hand(rows, 2, 4)
    assert sorted(tuple(r) for r in divergence.audit(build(rows), min_docs=2, top=4).collect()) == whole
    plain = [r for text in (rows[3][2], "é" * 9 + " b c", "", "x") for r in divergence._pieces(text.encode())]
    assert b"".join(plain) == "".join([rows[3][2], "é" * 9 + " b c", "x"]).encode()


def test_pieces_never_cut_a_term(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 5)
    text = "eins zwei dreivierfünf  sechs,sieben".encode()
    found = [t for p in divergence._pieces(text) for t in divergence.TERM.findall(p)]
    assert found == divergence.TERM.findall(text)


def test_blocks_of_sources_add_up(spark, monkeypatch):
    """A matrix in blocks of two sources, as batches over two tasks give it."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(divergence, "BLOCK", 2)
    plain = [3, 1, 4, 1, 5]
    entries = [([0, 2], [9, 8]), ([4], [7]), ([], []), ([0, 1, 2, 3, 4], [2, 7, 1, 8, 2])]
    table = np.array([[dict(zip(*e)).get(i, plain[i]) for i in range(5)] for e in entries])
    want = np.abs(table[:, :, None] - table[:, None, :]).sum(0)
    rows = [("en", b, plain, *e) for b in range(3) for e in entries]
    schema = pa.schema([("lang", pa.string()), ("block", pa.int32()), ("plain", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("shares", pa.list_(pa.int64()))])
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.types[i]) for i in range(5)], schema=schema)
    got = np.zeros((5, 5), int)
    for part in divergence._distances(iter([batch.slice(0, 5), batch.slice(5, 0), batch.slice(5)])):
        for a, b, v in zip(*(part.column(c).to_pylist() for c in ("a", "b", "value"))):
            got[a, b] += v
    assert (got == want).all()


def test_empty_table(build):
    assert divergence.audit(build([])).count() == 0


def test_shares_of_large_counts(spark):
    row = spark.createDataFrame([(10**15, 3 * 10**15, 1000)], "n long, total long, terms long").select(divergence.share("n", "total", "terms")).first()
    assert row[0] == 1 + 10**9 * (10**15 + 5) // (3 * 10**15 + 5000)
