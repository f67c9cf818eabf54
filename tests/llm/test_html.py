import html
import re

import pytest

from txguard.llm import html_text

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return html_text.Potentials(dict(html_text.seeds()))


def article(source):
    inside = re.search(r"<article>(.*?)(</article>|$)", source, re.S).group(1)
    blocks = re.split(r"</?p>|</?h1>", inside)
    return "\n".join(filter(None, (" ".join(html.unescape(re.sub(r"</?b>|<br>", "", b)).split()) for b in blocks)))


def test_every_page_gives_its_article(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    found = html_text.extract(pages).collect()
    assert len(found) == len(sources)
    assert all(r["text"] == article(sources[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in found)


def test_other_layouts(model):
    source = ("<div class=menu><a>x</a> <a>y</a></div><div id=main class=content><h2>Title</h2><p>It's a text &amp; more. Yes it is, with "
              "words.<p>Another &lt;b&gt; one, x < y. End.<script>var a='<p>no</p>'</script><!-- <p>no --></div><div class=comments><p>"
              "Nice one. Thanks a lot.</p></div><footer>c</footer><form><p>Name</p><textarea>no</textarea></form>")
    assert html_text.main_text(source, model) == "Title\nIt's a text & more. Yes it is, with words.\nAnother <b> one, x < y. End."


@pytest.mark.parametrize("source", [
    "", "plain words", "<", "<p", "<article", "<!-- open", "<script>never closed", "</p></div>", "<p title='open>x", "<b><i><a>",
    "&#0;&#x110000;&am", "<article><p>a" * 3, "<div>" * 20000 + "deep", "<p>" + "word " * 200_000, "<article>" + "<p>x</p>" * 5000 + "</article>"])
def test_any_source_is_read(model, source):
    text = html_text.main_text(source, model)
    assert "<p" not in text and "\n\n" not in text


def test_whole_blocks_and_white_space(model):
    source = "<article><h1> A \n title </h1><p>" + "One&nbsp;word,  two. " * 3000 + "</p><ul><li>x is one.<li>y is two.</ul></article>"
    lines = html_text.main_text(source, model).split("\n")
    assert lines[0] == "A title" and lines[1] == " ".join(["One word, two."] * 3000) and lines[2:] == ["x is one.", "y is two."]


def test_marginals_are_those_of_all_states(model):
    import itertools
    import math

    page = html_text.parse("<div class=menu><a>x</a></div><div><p>Some text. More of it.</p><ul><li>a</li></ul></div>")
    n, seen = len(page.tags), html_text.evidence(page)
    total, ones = 0.0, [0.0] * n
    for states in itertools.product((0, 1), repeat=n):
        if states[0]:
            continue
        p = 1.0
        for node, s in enumerate(states):
            p *= math.exp(sum(model.seen[x][s] for x in seen[node] if x in model.seen))
            if node:
                p *= model.moves.get(html_text._slot("tag " + page.tags[node]), model.usual)[states[page.parents[node]]][s]
        total += p
        for node, s in enumerate(states):
            ones[node] += p * s
    assert model.marginals(page) == pytest.approx([x / total for x in ones], abs=1e-9)


def test_odd_rows(spark, clashing):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<article><p>Text here, of a page.</article>"), (3, "u", "<article><p>Text here, of a page.</article>"), (None, "v", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html_text.extract(clashing(pages)).collect())
    assert [f[0] for f in found] == ["1", "2", "3", "3", "None"]
    assert found[0][1:] == found[1][1:] == ("", 0) and found[2][1] == found[3][1] == "Text here, of a page."
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("inside, lines", [
    ("<p>One.</p><svg class='i'/><p>Two.</p><p>Three.</p>", ["One.", "Two.", "Three."]),
    ("<p>One.</p><math/><p>Two.</p>", ["One.", "Two."]),
    ("<p>One.</p><svg><title/><style/><path d='M0'/></svg><p>Two.</p>", ["One.", "Two."]),
    ("<p>One.</p><svg><path d='M0'><p>Two.</p><p>Three.</p>", ["One.", "Two.", "Three."]),
    ("<p>One.</p><button><p>Two.</p><p>Three.</p>", ["One.", "Two.", "Three."]),
    ("<p>One.</p><button><p>Two.</p><button>Go</button><p>Three.</p>", ["One.", "Two.", "Three."]),
    ("<p>One.</p><div><canvas></div><p>Two.</p><canvas>no</canvas>", ["One.", "Two."]),
    ("<p>One.</p><select><option><p>Two.</p>", ["One.", "Two."]),
    ("<p>One.</p><object data=x><p>Two.</p>", ["One.", "Two."]),
    ("<p>One <button>no<div>no</div><a>no</button> and <svg><g><text>no</text></g></svg>two.</p><p>Three.</p>", ["One and two.", "Three."]),
    ("<p>One.</p><template><div>no</div></div></p></template><p>Two.</p>", ["One.", "Two."]),
    ("<p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> holds.</p>", ["Here x=2 holds."]),
    ("<p>A <object>film</object> of <noscript>it</noscript>.</p>", ["A film of it."]),
    ("<p class=it's>One.</p><p>Two.</p><p>It's three.</p>", ["One.", "Two.", "It's three."]),
    ("<p class=a\"b>One.</p><p>Two.</p><p title=\"c > d\">Three.</p>", ["One.", "Two.", "Three."]),
    ("<p title = 'a>b' it's>One.</p><p ='x>Two.</p><p a='b'c>It's.</p>", ["One.", "Two.", "It's."]),
])
def test_no_paragraph_is_lost(inside, lines):
    page = html_text.parse(f"<article>{inside}</article><footer>End.</footer>")
    assert [t for _, t in page.pieces] == [*lines, "End."]


def test_many_unclosed_elements_take_no_longer():
    for tag in ("button", "svg", "math", "select", "canvas", "template", "svg><desc"):
        page = html_text.parse(f"<{tag}>x " * 20000)
        assert sum(t.count("x") for _, t in page.pieces) == 20000


def test_the_sample_is_drawn_among_labelled_pages(spark):
    rows = [(i, "<article><p>Some text.</p></article>" if i % 50 == 0 else "<div><p>Some text.</p></div>") for i in range(1000)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    seeds = html_text.seeds()
    assert [html_text.fit(pages, sample=n)[2, 0, 0, 1] - seeds[2, 0, 0, 1] for n in (20, 7)] == [40, 14]


@pytest.mark.parametrize("source, content", [
    ("<article><p>Text.</p><div class='ad'><p>Buy.</p></div><section id=comments><h3>Said</h3><article><p>Nice.</p></article></section></article>", ["Text."]),
    ("<article><p>Text.</p><article><p>A comment.</p></article><p>More.</p></article>", ["Text.", "More."]),
    ("<main><article><p>Text.</p></article></main><aside><article><p>No.</p></article></aside><nav><article>No.</article></nav>", ["Text."]),
    ("<article><p>Text.</p></article><div class=comments><article class=comment><p>No.</p></article></div>", ["Text."]),
    ("<div class='sidebar-left'><main><p>Text.</p></main></div>", ["Text."]),
    ("<form><article class='post entry'><p>Text.</p><div class='cookie-notice'>No.</div></article></form>", ["Text."]),
    ("<body class='has-sidebar'><article><p>Text.</p><form><p>No.</p></form></article></body>", ["Text."]),
])
def test_weak_labels_leave_out_what_is_no_main_text(source, content):
    page = html_text.parse(source)
    states = html_text.true_states(page, False)
    assert [t for node, t in page.pieces if states[node]] == content
