import random
import re

import numpy as np
import pytest

from txguard.llm import blocks, components, embedding_dedup, jaccard_forest


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)], [(5, 3), (3, 5), (None, 2), (9, 8)],
    [(i, i * 7 % 101) for i in range(300)]])
def test_components(spark, edges):
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "p long, q long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    expected = {n: r for n, r in closure({n for e in real for n in e}, real).items() if n != r}
    assert found == expected


def vectors_by_hand(rows):
    ok = {}
    for at, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[at] = np.array(v) / np.linalg.norm(v)
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.9]
    groups = closure(range(len(rows)), links)
    least = {}
    for at, g in groups.items():
        least[g] = min([least[g], rows[at][0]]) if g in least else rows[at][0]
    n = {at: sum(at in e for e in links) for at in range(len(rows))}
    return sorted((rows[at][0], n[at], least[groups[at]], rows[at][0] == least[groups[at]]) for at in range(len(rows)))


def some_vectors(size=16):
    random = np.random.default_rng(5)
    rows, number = [], 0
    for center in random.normal(size=(25, size)):
        for spread in random.uniform(0, 0.16, random.integers(1, 9)):
            rows.append((number, [float(x) for x in center + spread * random.normal(size=size)]))
            number += 1
    rows += [(number, None), (number + 1, []), (number + 2, [0.0] * size), (number + 3, [float("nan")] * size),
             (number + 4, [None] * size), (number + 5, rows[0][1]), (number + 6, [2 * x for x in rows[0][1]]), (3, rows[3][1]),
             (number + 7, [1.0]), (number + 8, [5.0]), (number + 9, [1e308] * size), (number + 10, [float("inf")] * size)]
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_vectors_like_by_hand(spark, clashing, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = some_vectors()
    rows = [r for r in rows if r[1] is None or r[1] == [] or r[1][0] != 1e308]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    found = embedding_dedup.near_duplicates(clashing(df)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == vectors_by_hand(rows)


def test_very_long_and_very_short_vectors(spark):
    rows = [(at, [x * scale for x in (1.0, 0.5, -1.0, 0.25)]) for at, scale in enumerate((1.0, 1e308, 1e155, 1e-170, 3e-308, 2e-322))]
    rows += [(6, [1e308] * 4), (7, [1e-200] * 4), (8, [0.0] * 4), (9, [float("inf")] * 4)]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found)
    assert got == [(i, 5, 0) for i in range(6)] + [(6, 1, 6), (7, 1, 6), (8, 0, 8), (9, 0, 9)]


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0


def test_recall_at_the_threshold():
    random = np.random.default_rng(2)
    a = random.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = random.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    one, two = embedding_dedup.bucket_codes(a), embedding_dedup.bucket_codes(b)
    met = (one[:, :, :, None] == two[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() > 0.995


@pytest.mark.parametrize("size", [2, 3, 16, 128, 256, 768])
def test_recall_at_other_sizes(size):
    random = np.random.default_rng(size)
    one, two = [], []
    for _ in range(4):
        a = random.normal(size=(250, size))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = random.normal(size=a.shape)
        b -= (a * b).sum(1, keepdims=True) * a
        b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
        one.append(embedding_dedup.bucket_codes(a))
        two.append(embedding_dedup.bucket_codes(b))
    met = (np.concatenate(one)[:, :, :, None] == np.concatenate(two)[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() >= 0.998


def test_links_of_wide_vectors(spark):
    random = np.random.default_rng(9)
    rows = []
    for center in random.normal(size=(60, 768)):
        rows += [(len(rows) + i, [float(x) for x in center + s * random.normal(size=768)]) for i, s in enumerate((0, 0.3, 0.3, 0.47))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = embedding_dedup.near_duplicates(df).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == vectors_by_hand(rows)


def shingle_set(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x7f" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def texts_by_hand(rows):
    sets = [shingle_set(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows))
             if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    groups = closure(range(len(rows)), links)
    ids = {}
    for at, g in groups.items():
        ids.setdefault(g, []).append(rows[at][0])
    out = []
    for at, (i, _) in enumerate(rows):
        same = [rows[b][0] for b in range(len(rows)) if sets[b] == sets[at] and sets[at]] or [i]
        out.append((i, min(same), sum(at in e for e in links), min(ids[groups[at]]), i == min(ids[groups[at]])))
    return sorted(out)


def some_texts():
    rng = random.Random(4)
    vocabulary = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "io", "ur")]
    rows = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice((6, 60, 300)))
        for _ in range(rng.randint(1, 12)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 60))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own).capitalize() + "."))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", "...", "hi", "Hi!", "one two three", rows[0][1], "long " * 20000, "long " * 15000])]
    return rows + [rows[1]]


@pytest.mark.parametrize("block", [400_000, 900])
def test_texts_like_by_hand(documents, clashing, monkeypatch, block):
    monkeypatch.setattr(jaccard_forest, "BLOCK", block)
    rows = some_texts()
    found = jaccard_forest.near_duplicates(clashing(documents(*rows))).collect()
    assert sorted((r["doc_id"], r["copy_id"], r["n_links"], r["class_id"], r["kept"]) for r in found) == texts_by_hand(rows)


def test_the_shuffled_text_path_gives_the_same(documents, monkeypatch):
    monkeypatch.setattr(jaccard_forest, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(blocks, "HOT_LIMIT", 0)
    rows = some_texts()
    found = jaccard_forest.near_duplicates(documents(*rows)).collect()
    assert sorted((r["doc_id"], r["copy_id"], r["n_links"], r["class_id"], r["kept"]) for r in found) == texts_by_hand(rows)


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_one_of_each_group_stays(documents, clashing, monkeypatch, broadcast_rows):
    monkeypatch.setattr(jaccard_forest, "BROADCAST_ROWS", broadcast_rows)
    rows = some_texts() + [(None, "only without an id, both of these rows"), (None, "only without an id, both of these rows")]
    docs = clashing(documents(*rows))
    kept = jaccard_forest.keep_one(docs)
    assert kept.columns == docs.columns
    expected = sorted({i for i, _, _, least, k in texts_by_hand(rows[:-2]) if k})
    assert sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i)) == [*expected, None]


def test_no_texts(documents):
    assert jaccard_forest.near_duplicates(documents()).count() == 0
    assert jaccard_forest.keep_one(documents()).count() == 0


def test_prefixes_are_as_long_as_the_recall_allows():
    d = jaccard_forest.match_depth()
    found = [1 - (1 - 0.8 ** k) ** jaccard_forest.TREES for k in (d, d + 1)]
    assert found[0] >= jaccard_forest.RECALL > found[1]
    assert jaccard_forest.match_depth(0.1, 1) == 1


def test_labels_sort_as_a_trie():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 60, 50).astype(np.uint64)) for _ in range(30)]
    sets += [np.append(s[:45], s[:1] + np.uint64(9)) for s in sets]
    label = jaccard_forest.labels(sets)
    assert label.shape == (60, jaccard_forest.TREES, jaccard_forest.LABEL)
    assert (jaccard_forest.labels([sets[3]])[0] == label[3]).all()
    for tree in range(jaccard_forest.TREES):
        rows = sorted(range(60), key=lambda i: label[i, tree].tobytes())
        assert rows == sorted(range(60), key=lambda i: tuple(label[i, tree]))
        for depth in range(1, jaccard_forest.LABEL + 1):
            nodes = [jaccard_forest.prefixes(label, depth)[i, tree] for i in rows]
            runs = 1 + sum(a != b for a, b in zip(nodes, nodes[1:]))
            assert runs == len(set(nodes)) == len({tuple(x) for x in label[:, tree, :depth]})


def test_agreeing_min_hashes_estimate_the_similarity():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 60, 900).astype(np.uint64)) for _ in range(200)]
    one, two = jaccard_forest.labels([s[:810] for s in sets]), jaccard_forest.labels([s[90:] for s in sets])
    share = (one == two).mean(axis=(1, 2))
    assert abs(share.mean() - 0.8) < 0.01 and share.min() > jaccard_forest.AGREE


def test_only_documents_with_links_near_the_threshold_are_short(spark):
    depth = jaccard_forest.match_depth()

    def missed(s):
        return [float(1 / jaccard_forest.meeting(s, d) - 1) for d in range(1, depth + 1)]

    found = spark.createDataFrame(
        [(b"far", 1, missed(0.95)), (b"near", 1, missed(0.8)), (b"both", 1, missed(0.8)), (b"both", 999, [0.0] * depth)],
        "key binary, seen long, missed array<double>")
    assert [bytes(r["key"]) for r in jaccard_forest.short_of_links(found, depth).collect()] == [b"near"]
    assert jaccard_forest.short_of_links(found, 1).count() == 0


def near_the_threshold():
    """Groups of versions of a text: those of one group link at 0.8 to 0.95 or miss the threshold by little."""
    rng = random.Random(11)
    vocabulary = [a + b for a in "bcdfglmnprstvz" for b in ("a", "e", "io", "ur", "ent")]
    rows = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=200)
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randint(1, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    return rows


def test_shorter_prefixes_find_what_the_first_depth_misses(documents, monkeypatch):
    rows = near_the_threshold()
    expected = sum(n for _, _, n, _, _ in texts_by_hand(rows))
    monkeypatch.setattr(jaccard_forest, "match_depth", lambda: 8)  # a pair at 0.8 meets with probability 0.93 there
    read = []
    real = jaccard_forest._read
    monkeypatch.setattr(jaccard_forest, "_read", lambda given, classes, depth, floor, short: read.append(
        (depth, None if short is None else short.count())) or real(given, classes, depth, floor, short))
    found = jaccard_forest.near_duplicates(documents(*rows)).collect()
    assert sum(r["n_links"] for r in found) >= 0.999 * expected
    assert read[0] == (8, None) and len(read) > 2
    assert all(b[1] <= a[1] for a, b in zip(read[1:], read[2:]))
    assert sorted((r["doc_id"], r["class_id"], r["kept"]) for r in found) == [(i, c, k) for i, _, _, c, k in texts_by_hand(rows)]

    monkeypatch.setattr(jaccard_forest, "DOCUMENT_RECALL", 0.0)
    fixed = jaccard_forest.near_duplicates(documents(*rows)).collect()
    assert sum(r["n_links"] for r in fixed) < sum(r["n_links"] for r in found)
