import re
from html import unescape

import pytest

from eventflow.llm import crf
from eventflow.llm.dom import leaf_blocks
from tests.conftest import SF


@pytest.fixture(scope="module")
def model():
    return crf.trained()


def test_held_out_pages(model):
    blocks = wrong = 0
    for page, labels in crf.labelled_pages(150, seed=77):
        got = model.decode(page)
        blocks += len(labels)
        wrong += sum(a != b for a, b in zip(got, labels))
    assert wrong <= 0.01 * blocks


def test_table(spark, model):
    for r in crf.extract(spark.read.parquet(f"{SF}/pages.parquet"), model).collect():
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = (" ".join(unescape(re.sub("<[^>]+>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", article))
        assert r.main_text == "\n".join(p for p in parts if p)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>x</p>";</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, please agree to all of them.</p><button>OK</button></div>
<article><h1>The  title &amp; more</h1><p>First paragraph, with <b>bold&nbsp;text and <i>more.
<p>Second one &lt;here&gt; has several words, too.<div class="ad">Buy this now, it is cheap.</div>
<ul><li>An item of the article, long enough</li></ul><p>Last paragraph of the text, as it ends here.</p>
<section class="comments"><h2>Comments</h2><p>I liked this text a lot, thanks.</p></section></article>
<aside><h3>Related</h3><ul><li><a href="/c">More of this</a></li></ul></aside>
<form><p>Sign up here, it is free.</p></form><footer>&copy; Site. All rights.</footer></body></html>"""


def test_parts_of_a_page(model):
    assert crf.main_text(PAGE, model).split("\n") == [
        "The title & more", "First paragraph, with bold text and more.",
        "Second one <here> has several words, too.", "An item of the article, long enough",
        "Last paragraph of the text, as it ends here.",
    ]


def test_blocks():
    texts = lambda page: [b.text for b in leaf_blocks(page)]
    assert texts("a<br>b<p>c<p>d</div>e") == ["a b", "c", "de"]
    assert texts("<td>a<td>b<tr><td>c") == ["a", "b", "c"]
    assert texts("x<script>y</p>") == ["x"]
    assert texts("x<!-- y --> z<!-- open") == ["x z"]
    assert texts("a < b <c d='>'>e</c> <b") == ["a < b e <b"]
    assert texts("<div title=\"a'>b</div>") == ["b"]
    assert texts("") == texts("<p> \n</p>") == []
    assert [b.path for b in leaf_blocks('<div class="mainText x1"><p>a</p></div>b')] == [("div main text x", "p"), ()]
    assert leaf_blocks("<p><a>ab</a>cd")[0].linked == 0.5
    assert len(texts("<p>" * 20_000 + "x")) == 1 and len(texts("<" * 50_000)) == 1
    assert len(texts("<div>x" * 5_000)) == 5_000


def test_viterbi_is_the_best_path(model):
    from itertools import product

    for page, _ in crf.labelled_pages(25, seed=5):
        page = page[:8]
        e = [model.emission(b, i, len(page)) for i, b in enumerate(page)]
        score = lambda y: sum(x for x, l in zip(e, y) if l) + sum(model.steps[a][b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        assert score([int(x) for x in model.decode(page)]) == pytest.approx(max(map(score, product((0, 1), repeat=len(page)))))


def test_edges(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "<p>" + "Some words, and more. " * 40_000, "x"), (4, PAGE, "x"), (4, PAGE, "x")]
    out = crf.extract(spark.createDataFrame(rows, "page_id long, html string, main_text string"), model).collect()
    assert [r.main_text for r in out[:2]] == ["", ""]
    assert out[3] == out[4] and out[2].main_text is not None
    assert crf.extract(spark.createDataFrame([], "html string"), model).count() == 0


def test_only_raw_text_hides_the_rest(model):
    texts = lambda page: [b.text for b in leaf_blocks(page)]
    for tag in ("svg", "math", "object", "template", "noscript"):
        assert texts(f"<p>a<{tag} x=1> b<p>c</p>d") == ["a b", "c", "d"]  # no end tag
        assert texts(f"<p>a <{tag}>b</{tag}> c<p>d") == ["a b c", "d"]
        assert leaf_blocks(f"<{tag}><div><p>a")[0].path == ("div", "p")
        assert crf.main_text(PAGE.replace("<article>", f"<{tag}><article>"), model) == crf.main_text(PAGE, model)
    assert texts("<p>a<style>b<p>c") == texts("<p>a<iframe>b</p>c") == ["a"]
    page = PAGE.replace("text a lot", "text").replace("as it ends here", "as <math><mi>x</mi><mo>=</mo><mn>1</mn></math> ends here")
    assert "Last paragraph of the text, as x=1 ends here." in crf.main_text(page, model)


def test_hostile_pages_take_linear_time(model):
    from time import process_time

    n = 1 << 20  # bytes of a page
    for unit in ("<div>a", "<p><table><p>x", "<li><b>x", "<a", "<!", '<a ">"', "<a '\">", '<a "', "</i>", "<ul><li class=ad>x"):
        start = process_time()
        crf.main_text("<b>" * 9_000 + unit * (n // len(unit)), model)
        assert process_time() - start < 20, unit
    assert len(leaf_blocks("<script>" + "</script " * (n // 9))) == 0
    deep = leaf_blocks("<div>a" * 8_000)
    assert len(deep[-1].path) == 8_000 and deep[-1].node.parent is deep[-2].node


def test_tags_end_at_the_first_mark_outside_quotes():
    texts = lambda page: [b.text for b in leaf_blocks(page)]
    assert texts("""<p a='>' b=">">x</p>y""") == ["x", "y"]
    assert texts('<p ">"<p ">"x') == ['"', '"x'] and texts('<p ">x') == ["x"]
    assert texts("a<p b<!--c>d") == ["a", "d"] and texts("a<p b<!--c") == ["a<p b"]
    assert texts("<script>a</script b") == [] and texts("<script>a</script b>c") == ["c"]
