"""Main text: page shapes, damaged markup, references, and the sample pages against a plain reading."""

import html as library
import re

import duckdb
import pytest

from conftest import SF
from fieldfit.llm.text_density import extract, main_text

P = "This sentence is long enough to be the running text of an article, with commas and a full stop."

SHAPES = {
    "div": (f"<body><div class='nav'><a href=x>One</a><a href=y>Two</a></div><div id=c><h1>Head</h1><p>{P}<p>{P} &amp; more</div><div class=footer>Foot {P}</div>", f"Head {P} {P} & more"),
    "sections": (f"<main><section><h2>A</h2><p>{P}</p></section><section><h2>B</h2><p>{P}</p><p>{P}</p></section></main>", f"A {P} B {P} {P}"),
    "bare sections": (f"<body><div class=x><section><p>{P}</p></section><section><p>{P}</p><p>{P}</p></section></div><footer>{P}</footer>", f"{P} {P} {P}"),
    "comments": (f"<article><h1>T</h1><p>{P}</p><section class='comments'><p>{P} first!</p></section></article><div id='disqus_thread'>{P}</div>", f"T {P}"),
    "inside": (f"<article><header><h1>T</h1><span>by me</span></header><p>{P}</p><aside>{P}</aside><form><input><p>Mail</p></form><div class='ad-slot'>{P}</div><p>{P}</p><footer>f</footer></article>", f"T {P} {P}"),
    "unnamed menu": (f"<body><div><ul><li><a href=1>Alpha item</a><li><a href=2>Beta item</a><li><a href=3>Gamma</a></ul></div><div><p>{P}</p><p>{P} <a href=4>ref</a></p></div>", f"{P} {P} ref"),
    "raw": (f"<article><script>var a='<p>no</p>';</script><style>p{{}}</style><p>{P}</p><!-- <p>no</p> --><noscript>no</noscript></article>", P),
    "spaces": ("<article><p>a\n b\t c</p><p>d<b>e</b> f<br>g</p></article>", "a b c de f g"),
    "references": ("<article><p>&lt;tag&gt; &eacute;&#8364;&#x41; &copy &nbsp;x</p></article>", "<tag> é€A © x"),
    "cut": (f"<article><p>{P}<p>next <a href='un", f"{P} next"),
    "no tags": ("just words", "just words"),
    "empty": ("", ""),
    "only menu": ("<nav><a href=x>x</a></nav>", ""),
    "links in an article": (f"<article><p>{P}</p><p>See <a href=1>Alpha study</a> and <a href=2>Beta study</a></p><ul><li><a href=3>Gamma</a><li><a href=4>Delta</a></ul></article>", f"{P} See Alpha study and Beta study Gamma Delta"),
    "ordinary names": (f"<article><div class='section-header'><h2>H</h2></div><p class='alert'>{P}</p><div class='side-by-side'><p>{P}</p></div><div class='share'>Share</div><div class='related-posts promo'>x</div><div class='tags'>y</div></article>", f"H {P} {P}"),
    "names outside": (f"<body><div class='section-header'>Site</div><div class='search-box'>Find</div><div id=c><p>{P}</p><p>{P}</p></div>", f"{P} {P}"),
    "hidden": (f"<article><p>{P}</p><p hidden>x</p><p style='display:none'>y</p></article>", P),
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes(name):
    page, text = SHAPES[name]
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 50_000 + P) == P
    assert len(main_text("<article>" + f"<p>{P}</p>" * 20_000 + "</article>")) == (len(P) + 1) * 20_000 - 1


def plain(page):
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.DOTALL)[1]
    inner = re.sub(r"</?b>", "", inner)
    return " ".join(library.unescape(re.sub(r"<[^>]*(>|$)", " ", inner)).split())


def test_sample_pages(spark):
    from fieldfit.llm.queries import op2_text_density

    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    got = sorted((r.page_id, r.url, r.text, r.n_chars) for r in op2_text_density(spark, SF).collect())
    assert got == sorted((i, u, plain(h), len(plain(h))) for i, u, h in rows)


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, None, None, "q"), (None, "u", "", "q"), (1, None, "<p>x</p>", "q"), (1, None, "<p>x</p>", "q")],
        "page_id bigint, url string, html string, text string",
    )
    out = extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.text for r in out.collect()) == ["", "", "x", "x"]
    assert extract(df.where("false")).count() == 0
