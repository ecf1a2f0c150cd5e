import time

import pytest

from tallyhouse.llm.html import blocks_of, extract, labelled_pages, main_text, train


@pytest.fixture(scope="module")
def field():
    return train(labelled_pages(250, 1), 150)


def test_held_out_pages(field):
    pages = labelled_pages(200, 77)
    wrong = sum(x != y for blocks, labels in pages for x, y in zip(labels, field.decode(blocks)))
    assert wrong < 0.01 * sum(len(b) for b, _ in pages)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy this now.</div>
<article><h1>A  headline &amp;\n more</h1><p><b>First paragraph of the text with some words in it.<br><p>Second one follows, it has a <a href="/x">link</a> inside.</p>
<ul><li>One item.</li><li>Another item.</li></ul><p>Short.</p></article><section id="comments"><p>I think this is wrong, says someone.</p></section>
<footer>&copy; site &middot; All rights reserved.</footer>"""


def test_blocks_and_text(field):
    assert main_text(field, PAGE) == (
        "A headline & more\nFirst paragraph of the text with some words in it.\nSecond one follows, it has a link inside.\nOne item.\nAnother item.\nShort."
    )
    assert [b.text for b in blocks_of("a<p>b <i>c</b></i>d<div>e</p>f")] == ["a", "b cd", "e", "f"]
    assert blocks_of("<script>x") == [] and blocks_of("") == [] and blocks_of('<p title="unclosed>text') != []
    assert blocks_of("1 < 2 & 3 > 2")[0].text == "1 < 2 & 3 > 2"


def test_rows(spark, field):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" * 3000), (4, "x", "<div><p>" + "long words here. " * 20000)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = extract(pages, field).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (2, 3, None)] == ["", "", ""]
    assert len({r.text for r in got if r.page_id == 1}) == 1
    assert extract(pages.limit(0), field).collect() == []


def test_given_pages(spark, sf, field):
    """The generated pages hold their text in an article element."""
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    for r in rows:
        assert main_text(field, r.html) == "\n".join(b.text for b in blocks_of(r.html) if "article" in b.ancestors)


def test_long_and_odd_attribute_values():
    uri = "data:image/png;base64," + "A" * 20_000
    page = f'<article><p class="a">One.</p><img src="{uri}"><p class="b">Two.</p><img alt=\'{uri}\'><p class="c">Three.</p></article><footer class="d">End.</footer>'
    assert [b.text for b in blocks_of(page)] == ["One.", "Two.", "Three.", "End."]
    assert [b.text for b in blocks_of("<p title=it's>a</p><p title='b>c'>d</p><p x=\"e>f</p>")] == ["a", "d", "f"]
    assert [b.text for b in blocks_of('<p>a</p><p x=">b</p>" y')] == ["a", 'b', '" y']
    assert len(blocks_of('<p x=">" ' * 20_000)) <= 20_001 and blocks_of("<p " * 50_000) != []


@pytest.mark.parametrize("name", ["noscript", "object", "svg", "math", "canvas", "template"])
def test_what_an_unclosed_element_holds_stays(name):
    closed = f"<article><p>One <{name}><b>no</b></{name}>two.</p><{name}><div><p>no<p>no</{name}><p>Three.</p></article>"
    assert [b.text for b in blocks_of(closed)] == ["One two.", "Three."]
    unclosed = f"<article><p>One.</p><{name}><p>Two.</p><p>Three.</p></article><footer>End.<{name}>no</{name}></footer>"
    assert [b.text for b in blocks_of(unclosed)] == ["One.", "Two.", "Three.", "End."]


@pytest.mark.parametrize(("page", "n"), [
    ("<div>x" * 50_000, 50_000), ("<b>" * 20_000 + "<p>x</p>" * 20_000, 20_000), ("<i><div>" + "<b>" * 20_000 + "</i>" * 20_000 + "x", 1), ("".join(f"<x-{i}>t<p>" for i in range(20_000)), 20_000),
    ("<div>" * 30_000 + "</section>" * 30_000 + "x", 1), ("<div>" * 20_000 + "<li>x" * 20_000, 20_000), ("<noscript>" * 20_000 + "<p>x" * 20_000 + "</noscript>" * 19_999, 0), ("<div class='nav content'>y" * 30_000, 30_000),
])
def test_deep_nesting_takes_time_in_proportion(page, n):
    began = time.monotonic()
    assert len(blocks_of(page)) == n
    assert time.monotonic() - began < 20  # minutes where each block looks at all its ancestors


def test_rows_and_cells_without_ends():
    blocks = blocks_of("<table><tr><td class='nav'>a<td>b<tr><td>c<table><tr><td>d</table>e</table>f")
    assert [(b.text, sorted(b.groups)) for b in blocks] == [("a", ["menu"]), ("b", []), ("c", []), ("d", []), ("e", []), ("f", [])]


# written by hand, in layouts that `labelled_pages` does not make: (page, its main text)
LAYOUTS = {
    "one wrapper": (
        '<div id="wrapper"><h2>A title of the piece</h2>' + "".join(f"<p>This is paragraph {i} of the article with a fair number of words in it, as texts have.</p>" for i in "abc") + "</div>",
        ["A title of the piece", *(f"This is paragraph {i} of the article with a fair number of words in it, as texts have." for i in "abc")],
    ),
    "made-up names": (
        '<div class="q1"><a href="/">Home</a> <a href="/n">News</a> <a href="/s">Sport</a></div><div class="zz"><h1>Rain comes early</h1><p>The rain came early this year and the farmers of the valley were glad of it.</p>'
        "<p>Rivers rose by a metre within two days, and roads were closed for a week.</p></div>"
        '<div class="k9"><h3>2 comments</h3><div>Nice piece, thank you for it.</div><div>I do not agree with this at all.</div></div><div class="b2"><a href="/t">Terms</a> <a href="/p">Privacy</a></div>',
        ["Rain comes early", "The rain came early this year and the farmers of the valley were glad of it.", "Rivers rose by a metre within two days, and roads were closed for a week."],
    ),
    "table": (
        '<table><tr><td><a href="/">Home</a><br><a href="/b">Blog</a></td><td><h1>Old layout</h1><p>This page was made long ago and is held in a table, as many were then.</p>'
        "<p>It has a second paragraph, which says no more than the first one did.</p></td></tr><tr><td>Copyright 2001 by the owner</td></tr></table>",
        ["Old layout", "This page was made long ago and is held in a table, as many were then.", "It has a second paragraph, which says no more than the first one did."],
    ),
    "bare body": (
        "<body><h1>Notes on glass</h1><p>Glass is made of sand, soda and lime, which are melted together in a furnace for a day.</p><h2>Colour</h2><p>Iron makes it green, and cobalt makes it a deep blue.</p></body>",
        ["Notes on glass", "Glass is made of sand, soda and lime, which are melted together in a furnace for a day.", "Colour", "Iron makes it green, and cobalt makes it a deep blue."],
    ),
    "nested wrappers": (
        '<div><div><div><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li><li><a href="/3">Three</a></li></ul></div><div><div><h1>The harbour at night</h1><p>Ships lie still in the harbour, and their lamps are seen from the hills around the town.</p>'
        "<p>At four the first boats go out, long before the market opens its doors.</p></div></div></div><div><p>© 2019 The Harbour Times. All rights reserved.</p></div></div>",
        ["The harbour at night", "Ships lie still in the harbour, and their lamps are seen from the hills around the town.", "At four the first boats go out, long before the market opens its doors."],
    ),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts_that_were_not_trained_on(field, name):
    page, text = LAYOUTS[name]
    assert main_text(field, page).split("\n") == text
