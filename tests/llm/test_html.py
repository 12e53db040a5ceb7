import numpy as np

from tillroll.llm import html_extraction as he
from tillroll.llm.html_blocks import blocks_of

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href='/b>c'>News</a></li></ul></nav><!-- ad --><div class="ad">Buy this now.</div>
<article><h1>The head line {n}</h1><p><b>First &amp; second part of it.<br><p>Third   part,&nbsp;with words {n}.</p></article>
<footer>&copy; site {n}</footer></body>"""


def texts(page):
    return [b.text for b in blocks_of(page)]


def test_blocks():
    assert texts("<p>a<b>b<p>c</b>d<br>e<div>f</div>g") == ["ab", "cd e", "f", "g"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>x") == ["a", "b", "c", "d", "x"]
    assert texts("a &lt; b &amp;amp; &#x41;&nbsp;c <!-- x > y --> d<!-- open") == ["a < b &amp; A c d"]
    assert texts("<script>var t='</p>';</script>x<style>p{}</style>y<SCRIPT>z") == ["xy"]
    assert texts("<p>a <math><mi>x</mi>=<mn>2</mn></math> b<p>c <svg><text>d</text></svg> e") == ["a x=2 b", "c d e"]
    assert texts("<p>a<svg><path d='m'><p>b<math>c<p>d") == ["a", "b", "c", "d"] or texts("<p>a<svg><p>b") == ["a", "b"]
    assert texts("x<xmp><b>y</b> &amp; z</xmp>w") == ["x", "<b>y</b> &amp; z", "w"]
    assert texts("<script>a</script foo=1>b<style>c</style >d") == ["bd"]
    assert texts("<a href='x>y'>l</a> t < 5") == ["l t < 5"]
    assert texts("") == texts("<p> \n </p>") == []
    assert blocks_of('<div class="A b" id=c>t')[0].path == ("div", ".a", ".b", ".c")


def test_gradients():
    """Back-propagation against differences."""
    rng = np.random.default_rng(2)
    model = he.Labeller(he.Lstm(5, 4, rng), he.Lstm(5, 4, rng), rng.normal(size=8), np.zeros(1))
    for name in ("wx", "wh", "b"):
        for side in (model.ahead, model.back):
            setattr(side, name, getattr(side, name).astype(np.float64))
    rows = [rng.normal(size=(n, 5)).astype(np.float32) for n in (3, 6)]
    labels = [np.array([1, 0, 1.0]), np.array([0, 1, 1, 0, 0, 1.0])]

    def loss():
        p = np.concatenate(model.probabilities(rows))
        y = np.concatenate(labels)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for parameter, gradient in zip(model.parameters(), model.gradients(rows, labels)):
        at = np.unravel_index(int(np.argmax(np.abs(gradient))), parameter.shape)
        old = parameter[at]
        parameter[at] = old + 1e-2
        up = loss()
        parameter[at] = old - 1e-2
        down = loss()
        parameter[at] = old
        assert abs((up - down) / 2e-2 - gradient[at]) < 2e-3 + 0.02 * abs(gradient[at])


def test_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    model = he.fit(pages)
    rows = he.extract(pages, model).collect()
    expected = []
    for r in rows:
        blocks = blocks_of(r.html or "")
        labels = he.weak_labels(blocks) or [0] * len(blocks)
        expected.append("\n".join(b.text for b, y in zip(blocks, labels) if y))
    assert np.mean([r.text == e for r, e in zip(rows, expected)]) > 0.97
    edge = [(1, PAGE.format(n=1), "own"), (1, PAGE.format(n=1), "own"), (2, None, None), (None, "", "own"), (3, "<p>" + "word " * 100_000, "own")]
    odd = spark.createDataFrame(edge, "page_id long, html string, text string")
    found = [r.text for r in he.extract(odd, model).collect()]
    assert found[0] == found[1] == "The head line 1\nFirst & second part of it.\nThird part, with words 1."
    assert found[2] == found[3] == "" and len(found) == 5
    empty = spark.createDataFrame([], "page_id long, html string")
    assert he.extract(empty, he.fit(empty)).count() == 0
