import hashlib
import re

import pytest
from pyspark.sql import functions as F

from txguard.llm import decontaminate, native

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), 13)
        for i in range(len(w) - n + 1) if w else ():
            grams.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for gram, ids in grams.items():
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i:i + len(gram)]) == gram:
                    hit |= set(range(i, i + len(gram)))
                    found |= ids
        ids = ",".join(sorted(found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


DOCS = [
    (1, ITEM.upper() + "!"), (2, "clean words only"), (3, None), (4, ""), (5, "x " * 400 + ITEM), (6, "short ITEM, here"),
    (7, ITEM + " " + ITEM), (7, ITEM + " " + ITEM), (8, "ÉCOLE école " + ITEM.replace(" ", "--")), (None, ITEM),
    (9, "a " * 3000 + ITEM + " b" * 3000), (10, "... ,,,"), (11, "item short item short"),
]
ITEMS = [(10, ITEM), (9, ITEM + " fifteen"), (2, "short item"), (3, None), (4, "!!"), (2, "short item")]


@pytest.fixture
def items(spark):
    def build(rows):
        return spark.createDataFrame(rows, "item_id long, text string")

    return build


@pytest.mark.parametrize("limits", [
    {}, {"FILTER_GRAMS": 4}, {"FILTER_GRAMS": 0}, {"FILTER_GRAMS": 0, "FILTER_BYTES": 0}, {"BROADCAST_BYTES": 0}])
def test_like_by_hand(documents, items, clashing, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(decontaminate if name == "BROADCAST_BYTES" else native, name, value)
    more = [(100, "some other words that no document has " + " ".join(map(str, range(40))))]
    found = decontaminate.scan(clashing(documents(*DOCS)), items(ITEMS + more))
    rows = [tuple(r) for r in found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    assert sorted(rows, key=str) == sorted(by_hand(DOCS, ITEMS + more), key=str)


def test_windows_that_do_not_occur_need_no_join_of_places(documents, items, monkeypatch):
    monkeypatch.setattr(native, "FILTER_GRAMS", 4)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(50)] + [(60, ITEM)]
    plan = decontaminate.scan(documents(*DOCS), items(rows))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_only_candidates_are_joined(documents, items, monkeypatch):
    monkeypatch.setattr(native, "FILTER_GRAMS", 0)
    kept = []
    real = native.all_places
    monkeypatch.setattr(native, "all_places", lambda *a: kept.append(real(*a)) or kept[-1])
    docs = [(i, " ".join(f"d{i}x{j}" for j in range(500))) for i in range(40)] + DOCS
    decontaminate.scan(documents(*docs), items(ITEMS)).collect()
    assert kept[0].where("gram IS NULL").count() == len(docs)
    assert kept[0].where("gram IS NOT NULL").count() <= 60


@pytest.mark.parametrize("limits", [{"FILTER_GRAMS": 0}, {}])
def test_empty_tables_on_either_path(documents, items, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(native, name, value)
    assert decontaminate.scan(documents(), items(ITEMS)).count() == 0
    assert decontaminate.scan(documents((1, "a b"), (2, None)), items(ITEMS)).where("n_hit > 0").count() == 0


def test_empty_tables(documents, items):
    assert decontaminate.scan(documents(), items(ITEMS)).count() == 0
    assert [tuple(r) for r in decontaminate.scan(documents((1, ITEM)), items([])).select("n_hit", "contaminated").collect()] == [(0, False)]


@pytest.mark.parametrize("keys", [500_000, 0])
def test_documents_are_removed_with_all_columns_kept(documents, items, clashing, monkeypatch, keys):
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", keys)
    docs = clashing(documents(*DOCS))
    kept = decontaminate.remove_documents(docs, items(ITEMS))
    bad = {r[0] for r in by_hand(DOCS, ITEMS) if r[5]}
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((d for d, _ in DOCS if d not in bad), key=str)


def test_spans_are_removed(documents, items):
    docs = documents((1, f"Keep this. {ITEM.title()}, and that."), (2, None), (3, "nothing"))
    rows = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, items([(1, ITEM)])).collect()}
    assert words(rows[1]) == ["keep", "this", "and", "that"] and rows[1].startswith("Keep this. ") and rows[1].endswith(", and that.")
    assert rows[2] is None and rows[3] == "nothing"


def test_words_are_found_without_python(documents, items):
    plan = decontaminate.scan(documents(*DOCS), items(ITEMS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ascii_lower_only(spark):
    row = spark.createDataFrame([("ÀB İ",)], "t string").select(native.ascii_lower(F.col("t"))).first()
    assert row[0] == "Àb İ"
