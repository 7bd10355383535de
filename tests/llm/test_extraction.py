"""Blocks of pages, gradients of the labeller, and main texts of pages in known and new layouts."""

import numpy as np
import pytest

from scanledger.llm import extraction
from scanledger.llm.pages import read_blocks

PAGE = "page_id long, url string, html string, text long, labels string"


def texts(page):
    return [b.text for b in read_blocks(page)]


def test_blocks():
    assert texts("<p>a<p>b <b>c</b>d<br>e<div>f</div>g") == ["a", "b cd e", "f", "g"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>") == ["a", "b", "c", "d", "e", "f"]
    assert texts("a &amp;amp; &lt;p&gt; &eacute;&nbsp; b&#x27;c &copy") == ["a &amp; <p> é b'c ©"]
    assert texts("<script>var t='</p>';</script><style>p{}</style>x<!-- <p>no</p> -->y<title>t</title><svg><text>no</text></svg>z") == ["xyz"]
    assert texts('<div title="a > b">x</div><div class= "q>r">y</div>') == ["x", "y"]
    assert texts("1 < 2 <3 </> </ a> x <!doctype html><?php no ?>z") == ["1 < 2 <3 x z"]
    assert texts("<p>a</section></b>b</p>c") == ["a", "b", "c"]
    assert texts(None) == texts("") == texts(" \n ") == []


def test_blocks_of_broken_pages():
    assert texts("a<!-- never ends") == ["a"] and texts("a<script>never") == ["a"] and texts('<p>a<a href="x>b') == ["ab"]
    assert texts("a<!-->b<!--->c") == ["abc"]
    assert texts('<p title="x>a</p><p>b</p>')[-1] == "b"
    deep = "<div>" * 30_000 + "x" + "</div></b>" * 30_000
    assert texts(deep) == ["x"]
    assert len(texts("<li>a<div>" * 20_000)) == 20_000
    assert texts("<!--" * 50_000) == [] and texts("<a '" * 50_000 + "x") == []


def test_path_and_links():
    block = read_blocks('<html><body><div class="postContent main" id=x1><p>ab <a href="#">cd</a></p></div>')[0]
    assert block.path == ("html", "body", "div post content main x", "p") and block.linked == 2


def test_gradients():
    designer = extraction.Designer(["one two three four", "five six"], seed=3)
    pages = [extraction.designed_example(designer.page()) for _ in range(3)]
    model = extraction.Labeller(seed=2)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    sizes = np.array([len(e.labels) for e in pages])
    labels = np.array([y for e in pages for y in e.labels], dtype=float)

    def loss():
        z = model.forward(model.vectors(pages)[0].astype(np.float64), sizes)[0]
        return float((np.logaddexp(0, z) - labels * z).sum())

    x, found = model.vectors(pages)
    z, kept = model.forward(x, sizes)
    gradients = model.gradients(x, found, kept, 1 / (1 + np.exp(-z)) - labels)
    random = np.random.default_rng(1)
    for name, weight in model.weights.items():
        flat = weight.reshape(-1)
        used = np.flatnonzero(np.abs(gradients[name].reshape(-1)) > 1e-3)
        for i in random.choice(used, size=min(5, len(used)), replace=False):
            kept_value = flat[i]
            flat[i] = kept_value + 1e-3
            above = loss()
            flat[i] = kept_value - 1e-3
            below = loss()
            flat[i] = kept_value
            assert (above - below) / 2e-3 == pytest.approx(float(gradients[name].reshape(-1)[i]), rel=0.05, abs=2e-3), name


@pytest.fixture(scope="module")
def labeller(spark, sf_dir):
    return extraction.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def test_new_designs(labeller):
    designer = extraction.Designer(["Some prose of a page, and more of it.", "Short", "Yet another line that says a little more than the last"], seed=77)
    held_out = [extraction.designed_example(designer.page()) for _ in range(400)]
    wrong = [(p >= 0.5) != np.array(e.labels) for e, p in zip(held_out, labeller.probabilities(held_out), strict=True)]
    assert np.concatenate(wrong).mean() < 0.02
    assert np.mean([w.any() for w in wrong]) < 0.1


def test_rows(spark, labeller):
    prose = "The council met on Monday and spoke for two hours about the bridge."
    page = f"""<html><head><title>t</title></head><body><header><a href="/">Site</a></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
      <div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div>
      <main><h1>The bridge &amp; us</h1><p>{prose}</p><div class="ad">Buy now, the best boots of the year.</div><p>{prose}&nbsp; More.</p><ul><li>one thing</li><li>and another</li></ul></main>
      <aside class="sidebar"><h3>Popular</h3><ul><li><a href="/x">Other story</a></li></ul></aside>
      <section id="comments"><h2>2 comments</h2><div class="comment"><p>I do not agree with any of this.</p></div></section>
      <form><label>E-mail</label><input><button>Subscribe</button></form><footer>&copy; 2024 Site</footer></body></html>"""
    rows = [(1, "u", page, 5, "x"), (1, "u", page, 5, "x"), (2, None, None, None, None), (3, "v", "", None, None), (None, "w", page, None, None), (4, "z", "<article>" + f"<p>{prose}</p>" * 3000 + "</article>", None, None)]
    found = extraction.extract_text(spark.createDataFrame(rows, PAGE).repartition(3), labeller).collect()
    assert len(found) == len(rows)
    want = f"The bridge & us\n{prose}\n{prose} More.\none thing\nand another"
    by_url = {r.url: r for r in found}
    assert by_url["u"].text == want == by_url["w"].text and by_url["u"].n_chars == len(want)
    assert by_url[None].text == "" == by_url["v"].text and by_url[None].n_chars == 0
    assert by_url["z"].text == "\n".join([prose] * 3000)
    empty = spark.createDataFrame([], PAGE)
    assert extraction.extract_text(empty, labeller).count() == 0


def test_fit_without_pages(spark):
    model = extraction.fit(spark.createDataFrame([(None, "u", "<p>x</p>", None, None), (5, "u", None, None, None)], PAGE))
    text, example = extraction.features("<nav><a>Home</a></nav><article><p>Some prose.</p></article>")
    assert [bool(p >= 0.5) for p in model.probabilities([example])[0]] == [False, True]
