import pytest

from txguard.llm import url_filter

URLS = [
    (1, "http://a.net/x"), (2, "https://www.Example.NET/en/page?x=1#y"), (3, "http://example.com/de/1"), (4, "http://x.org/fr/"),
    (5, "http://x.org/en/"), (6, None), (7, ""), (8, "no scheme"), (9, "http://notnet/"), (10, "ftp://host.net"), (11, "http://x.org?q=/fr/"),
    (12, "http://example.com/dex"), (13, "//://EXAMPLE.net/en/a"), (14, "http://b.net/" + "long/" * 3000), (1, "http://a.net/x"),
]


@pytest.fixture
def pages(spark):
    def build(rows):
        return spark.createDataFrame([(i, u, "<p>") for i, u in rows], "page_id long, url string, html string")

    return build


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
    fits = [h + p for _, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


def test_parts_and_rules(pages, clashing):
    found = url_filter.judge(clashing(pages(URLS))).collect()
    assert len(found) == len(URLS)
    expected = {(i, *by_hand(u)) for i, u in URLS}
    assert {(r["page_id"], r["host"], r["path"], r["rule"]) for r in found} == expected
    verdicts = {h + p: v for v, h, p in url_filter.RULES}
    assert all(r["verdict"] == verdicts[r["rule"]] if r["rule"] else r["verdict"] in ("allow", "block") for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_one_kind_of_label_or_none(pages):
    assert {r["verdict"] for r in url_filter.judge(pages([(1, "http://a.net/"), (2, "http://b.com/")])).collect()} == {"block"}
    assert {r["verdict"] for r in url_filter.judge(pages([(1, "http://b.com/"), (2, None)])).collect()} == {"allow"}
    assert url_filter.judge(pages([])).count() == 0


def test_trees_learn_the_rules(spark):
    folder = "/root/testdata/sf0.01"
    found = url_filter.judge(spark.read.parquet(f"{folder}/pages.parquet"))
    ruled = found.where("rule IS NOT NULL").collect()
    right = [(r["score"] >= 0.5) == (r["verdict"] == "block") for r in ruled]
    assert sum(right) > 0.95 * len(right)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
