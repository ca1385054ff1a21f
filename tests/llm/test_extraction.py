"""HTML extraction: the block reader, the model's gradients, held-out pages."""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest

from tests.llm.helpers import SF
from wordmill.llm import extraction as ex
from wordmill.llm import html_blocks as hb
from wordmill.llm.queries import QUERIES


def texts(page):
    return [b.text for b in hb.blocks(page)]


@pytest.mark.parametrize("page, want", [
    ("", []), ("  \n ", []), ("plain &amp; simple", ["plain & simple"]),
    ("<p>a<p>b", ["a", "b"]), ("<p>a<br>b  \n c</p>", ["a b c"]), ("<p><b>a<br><p>b</article>c", ["a", "b", "c"]),
    ("x<script>var t=\"</p>\";a<b</script>y", ["x y"]), ("<style>p{}</style><!-- <p>n</p> -->z", ["z"]),
    ("<script>never closed", []), ("a<!-- never closed", ["a"]), ("1 < 2 and 3 > 2", ["1 < 2 and 3 > 2"]),
    ("<a title='x>y'>l</a> t", ["l t"]), ("<p title=\"open>t", ["t"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
    ("<P>&#233;&nbsp;&lt;b&gt;</P>", ["é <b>"]), ("wo<b>r</b>d <i>x</i>", ["word x"]),
    ("&am<b>p;</b> &amp;lt;", ["&amp; &lt;"]), ("</p></div>a", ["a"]),
])
def test_blocks(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("page, want", [
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p>", ["Let x=2 be"]),
    ("<p>See <object data=a.pdf>the <b>report</b></object> here</p>", ["See the report here"]),
    ("<p>a <svg><title>icon</title><path d='M0'/><text>drawn</text></svg> b</p>", ["a b"]),
    ("<p>a <svg><path d='M0'> lost</p><p>kept</p> <svg><g>no</g></svg> too", ["a", "kept", "too"]),
    ("<p>a <svg viewBox='0 0 1 1'><g>drawn", ["a"]),
    ("<p>a <svg/> b</p><script>if (a < b) {", ["a b"]),
])
def test_formulas_objects_and_drawings(page, want):
    assert texts(page) == want


def test_paths():
    page = "<html><body><div class='Side bar' id=x><p>a<div>b</div></div><article><p>c<p>d</article><p>e"
    assert [b.path for b in hb.blocks(page)] == [
        ("html", "body", "div", ".side", ".bar", ".x", "p"), ("html", "body", "div", ".side", ".bar", ".x", "div"),
        ("html", "body", "article", "p"), ("html", "body", "article", "p"), ("html", "body", "p")]


def test_gradients():
    rng = np.random.default_rng(0)
    model = ex.BlockLabeller(5, 3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = model.pad([rng.normal(size=(n, 5)) for n in (4, 2, 1)])
    x, y = x.astype(np.float64), rng.integers(0, 2, mask.shape)

    def loss():
        both = np.concatenate([model._run(x, mask, d, False)[0] for d in "fb"], axis=2)
        p = ex._sigmoid(both @ model.p["o"] + model.p["s"])
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()
    grads = model._gradients(x, mask, y)
    for name, value in model.p.items():
        flat = value.reshape(-1)
        for j in range(0, len(flat), max(1, len(flat) // 5)):
            old, step = flat[j], 1e-2
            flat[j] = old + step
            up = loss()
            flat[j] = old - step
            down = loss()
            flat[j] = old
            assert abs((up - down) / (2 * step) - grads[name].reshape(-1)[j]) < 2e-4


def test_padding_changes_nothing():
    rng = np.random.default_rng(1)
    model = ex.BlockLabeller()
    pages = [rng.normal(size=(n, hb.DIMS)).astype(np.float32) for n in (1, 7, 30)]
    for page, score in zip(pages, model.scores(pages)):
        assert np.allclose(model.scores([page])[0], score, atol=1e-5)


def article(page):
    """The article by regular expressions (the test pages keep to one layout)."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = (re.sub(r"<[^>]*>", " ", p) for p in re.split(r"</?(?:p|h1)>", inside))
    return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_query_extracts_the_articles(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op8_html_extraction"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))
        assert r.text == article(pages[r.page_id].html)


def test_other_layouts():
    import pyarrow.parquet as pq
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    model = ex.BlockLabeller().fit(ex.training_set(pages[:150]))
    rng = random.Random(99)
    read = [hb.blocks(p) for p in pages[150:]]
    spare = [b.text for page in read for b in page]
    right = []
    for page in read:
        layout, labels = ex.invented(rng, [b.text for b, y in zip(page, ex.own_labels(page)) if y], spare)
        right += list((model.scores([hb.vectors(layout)])[0] > 0.5) == np.array(labels))
    assert np.mean(right) > 0.97
    page = ("<html><body><div class='menu'><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></div>"
            "<div class='content'><h1>{}</h1>" + "<p>{}</p>" * 4 + "</div><div class='comments'><p>{}</p><p>{}</p></div>"
            "<div class='footer'>© 2020</div></body></html>")
    story = list(dict.fromkeys(b.text for b in sum(read, []) if len(b.text) > 100))[:7]
    assert model.texts([page.format(*story)]) == ["\n\n".join(story[:5])]


def test_hard_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>" + "long " * 60000, "x"),
            (3, "u", "<br>", "x"), (3, "u", "<br>", "x"), (4, "u", "<p>a" * 20000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    model = ex.train(pages, train_pages=3)
    out = ex.extract(pages, model).collect()
    assert sorted(str(r.page_id) for r in out) == sorted(str(r[0]) for r in rows)
    assert all(r.text == "" and r.n_chars == 0 for r in out if r.page_id in (1, 2, 3))
    assert ex.extract(pages.limit(0), ex.train(pages.limit(0))).collect() == []
    assert spark.read.parquet(f"{SF}/pages.parquet").count() > 0
