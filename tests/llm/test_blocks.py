"""Block labels: accuracy on pages held out, whole texts of the given pages, gradients, and broken markup."""

import html
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotloom.llm import blocks, layout

PAGES = "/root/testdata/sf0.001/pages.parquet"


@pytest.fixture(scope="module")
def model():
    return blocks.fit()


def texts(page):
    return [t for _, t, _ in layout.leaves(page)]


def test_leaves_of_broken_markup():
    assert texts("") == [] and texts("plain  text\n") == ["plain text"]
    assert texts("a<p>b<p>c<b>d</b>e<br>f</P ><LI>g") == ["a", "b", "cde f", "g"]
    assert texts("<script>x<p>y</script>a<style>b</STYLE >c<!-- d <p> -->e") == ["ace"]
    assert texts("a<script>never ends <p>b") == ["a"] and texts("a<!-- never ends <p>b") == ["a"]
    assert texts("<p title='a>b'>c</p><p title=\"x>d<p>e") == ["c", "d", "e"]
    assert texts("<p>1 &lt; 2 &amp; 3 &#65;&nbsp;&eacute; &amp;lt; &am") == ["1 < 2 & 3 A é &lt; &am"]
    assert texts("x < y and <3 <p>z</p") == ["x < y and <3", "z"]
    assert texts("<head><title>t</title></head><body>b</body>") == ["b"]
    path = list(layout.leaves('<div class="Side-Bar x2" id=leftNav><ul><li>a<li>b</ul></div><p>c</div>d'))
    assert path[1][0] == (("div", ".side", ".bar", ".x", ".left", ".nav"), ("ul",), ("li",)) and path[2][0] == (("p",),)
    assert len(texts("<b>" * 50_000 + "x<p>" * 3_000)) == 3_000
    assert len(texts("<div>a" * 5_000)) == 5_000


def test_gradient():
    """The gradient against differences of the loss."""
    held = blocks.examples(3, 9)
    given, truth = blocks.sequences([p for p, _ in held]), np.concatenate([t for _, t in held])

    def loss(weights):
        return blocks.Labeller(dict(weights)).learn(given, truth, {}, 0.0)

    model, state = blocks.Labeller.fresh(3), {}
    start = {k: v.copy() for k, v in model.w.items()}
    model.learn(given, truth, state, 0.0)
    rng = np.random.default_rng(0)
    for name, (m, _) in ((k, v) for k, v in state.items() if k != "turn"):
        grad = m / 0.1
        for at in [np.unravel_index(np.abs(grad).argmax(), grad.shape), *(tuple(rng.integers(0, s) for s in grad.shape) for _ in range(3))]:
            moved = []
            for step in (1e-5, -1e-5):
                w = {k: v.copy() for k, v in start.items()}
                w[name][at] += step
                moved.append(loss(w))
            assert abs((moved[0] - moved[1]) / 2e-5 - grad[at]) < 1e-6 + 1e-4 * abs(grad[at]), (name, at)


def test_held_out_accuracy(model):
    assert blocks.accuracy(model, 300, seed=77) > 0.99


def test_batches_and_pieces_change_nothing(model, monkeypatch):
    held = blocks.sequences([p for p, _ in blocks.examples(30, 5)] + [[]])
    whole = model.probabilities(held)
    monkeypatch.setattr(blocks, "CELLS", 1)
    monkeypatch.setattr(blocks, "STEPS", 3)
    assert np.allclose(model.probabilities(held), whole, atol=1e-4)


def article(page):
    """What stands in the one article of a given page."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(br|/?p|/?h1)>", " ", inner))).split())


@pytest.mark.skipif(not os.path.exists(PAGES), reason="given tables are not here")
def test_given_pages(spark, model):
    pages = spark.read.parquet(PAGES)
    got = blocks.extract(pages, model=model).select("row.page_id", "text", "n_chars").toPandas().set_index("page_id")
    for r in pages.collect():
        assert got.text[r.page_id] == article(r.html) and got.n_chars[r.page_id] == len(got.text[r.page_id])


LAYOUTS = [
    '<body><div id="header"><a href="/">Site</a></div><div class="menu"><a href="/a">A</a> <a href="/b">B</a></div><div class="post"><h1>T one</h1>'
    '<p>First thing that happened here today, at length.</p><p>Second thing that happened, <a href="x">with a link</a> in it.</p></div>'
    '<div class="sidebar"><p>Buy now.</p></div><div id="comments"><p>I do not agree with any of this, said a reader.</p></div><div class="footer">Copyright</div></body>',
    '<header><h1>Name of site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><main><article><h1>T one</h1><p>First thing that happened here today, at length.'
    '<p>Second thing that happened, <a href="x">with a link</a> in it.</article></main><form><label>Mail</label><button>Send</button></form>'
    '<section class="comments"><p>I do not agree with any of this, said a reader.</p></section><footer>Copyright</footer>',
]


def test_other_layouts_and_odd_rows(spark, model):
    want = "T one First thing that happened here today, at length. Second thing that happened, with a link in it."
    long = "<article>" + "<p>some words of an article that goes on and on.</p>" * 6_000 + "</article><footer>end</footer>"
    rows = [(i, "u", p, 1) for i, p in enumerate(LAYOUTS)] + [(7, None, None, 1), (None, "u", "", 1), (8, "u", long, 1), (9, "u", "<nav><a href='/'>Home</a></nav>", 1)]
    rows += [(0, "u", LAYOUTS[0], 1)] * 3
    df = spark.createDataFrame(rows, "page_id long, text string, html string, row int").repartition(2)
    got = blocks.extract(df, model=model)
    assert got.columns == ["row", "text", "n_chars"] and got.schema["row"].dataType.names == ["page_id", "text", "row"]
    found = sorted(((r.row.page_id, r.text, r.n_chars) for r in got.collect()), key=repr)
    body = " ".join(["some words of an article that goes on and on."] * 6_000)
    assert found == sorted([(0, want, len(want))] * 4 + [(1, want, len(want)), (7, "", 0), (None, "", 0), (8, body, len(body)), (9, "", 0)], key=repr)
    assert blocks.extract(df.where(F.lit(False)), model=model).count() == 0
    each = blocks.label(df.where("page_id = 1"), model=model).orderBy("block").collect()
    assert [r.text for r in each if r.article > 0.5][0] == "T one" and each[0].path == "header/h1" and each[0].article < 0.5
