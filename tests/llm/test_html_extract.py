import random

from corpusloom.llm import html_extract as H


def extract(html):
    return H.extract_all([html], H.trained())[0]


def test_known_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- ad <p>x</p> --><div class="ad">Buy this thing now.</div>
    <article><h1>Big  title</h1><p><b>First &amp; foremost, this is the beginning of it.<br><p>Second paragraph,\n with a line break, that goes on for a while.</p><p>Third &copy; one &#233;.</p></article><footer>&copy; site &middot; all rights.</footer></body></html>"""
    assert extract(page) == "Big title\nFirst & foremost, this is the beginning of it.\nSecond paragraph, with a line break, that goes on for a while.\nThird © one é."


def test_held_out_pages():
    r, exact = random.Random(1234), []
    for _ in range(150):
        html = H._page(r)
        nodes, texts = H.parse(html)
        y = {id(n): "data-y" in n.attrs for n in nodes}
        for n in reversed(nodes[1:]):
            y[id(n.parent)] |= y[id(n)]
        want = set(H.text_of(nodes, texts, [y[id(n)] for n in nodes]).split("\n"))
        got = set(extract(html.replace(" data-y", "")).split("\n"))
        exact.append(2 * len(want & got) / (len(want) + len(got)))
    assert sum(exact) / len(exact) > 0.97


def test_decoding_is_consistent():
    import numpy as np

    rng = np.random.default_rng(0)
    for seed in range(30):
        nodes, _ = H.parse(H._page(random.Random(seed)))
        keep = H.decode(nodes, rng.normal(0, 3, len(nodes)))
        number = {id(n): i for i, n in enumerate(nodes)}
        assert keep[0] and all(keep[number[id(n.parent)]] for n, k in zip(nodes[1:], keep[1:]) if k)


def test_decoding_is_the_likeliest():
    from itertools import product

    import numpy as np

    nodes, _ = H.parse("<div><p>a</p><ul><li>b</li></ul></div><p>c</p>")
    number = {id(n): i for i, n in enumerate(nodes)}
    rng = np.random.default_rng(1)
    for _ in range(50):
        z = rng.normal(0, 2, len(nodes))
        score = lambda c: sum(-np.logaddexp(0, -v) if k else -np.logaddexp(0, v) for k, v in zip(c, z))  # noqa: B023, E731
        good = [c for c in product([True, False], repeat=len(nodes)) if c[0] and all(c[number[id(n.parent)]] for n, k in zip(nodes[1:], c[1:]) if k)]
        assert abs(score(H.decode(nodes, z)) - max(map(score, good))) < 1e-9


def body(html):
    """All text of a page but what can't be text."""
    nodes, texts = H.parse(html)
    return H.text_of(nodes, texts, [True] * len(nodes))


def test_what_is_never_text():
    assert body("<p>a</p><script>var x = 1;<p>b</p>") == "a"
    assert body("<p>a</p><script src=x />var y;</script><p>b</p>") == "a\nb"
    assert body("<p>a</p><STYLE>p{}</p></STYLE ><p>b</p>") == "a\nb"
    assert body("<p>a <textarea><p>x</textarea><select><option>y<option>z</select> b<template><p>t</p></template></p>") == "a b"
    assert body("<p>a<!--> b<!-- c > --><!-- d --!> e</p></ f>g<?php x ?><![CDATA[h]]>") == "a b e\ng"
    assert body('<p title=it\'s>It\'s one <a href="a>b">two</a> <b data-x = \'>\'>three</b></p>') == "It's one two three"
    assert body("<head><title>x</title><script>'</head>'</script><meta><p>a") == "a"


def test_what_is_text():
    assert body("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b <svg/>c <svg><g/><text>d</text></svg> <object><b>e</b></object> <noscript>f</noscript></p>") == "a x=1 b c d e f"
    assert body("<div/>a<p>b<div>c</div>d") == "a\nb\nc\nd"  # a slash ends nothing outside svg and math
    assert body("<table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl>") == "a\nb\nc\nd\ne"
    assert body("<p>a&nbsp;&amp;&#x41;&lt;b&gt; &notin; &bogus;") == "a &A<b> ∉ &bogus;"


def test_hand_made_pages():
    """Pages that the generator of training pages did not make, with their main text written beside them."""
    pages = [
        ('<body><header class="masthead"><a href="/">Site</a><nav><a href="/a">A</a> <a href="/b">B</a></nav></header><main><article><h1>On tea</h1><p>Tea is a drink, and it is hot.</p><script>ad(1)</script><p>It is made from leaves, which are dried.</p><aside class="related"><h4>Related</h4><ul><li><a href="/x">Coffee</a></li></ul></aside><section class="comments"><h3>Comments</h3><div class="comment"><p>I like it, too.</p></div></section></article></main><footer>&copy; Site</footer>', "On tea\nTea is a drink, and it is hot.\nIt is made from leaves, which are dried."),
        ('<div id="menu"><ul><li><a href="/1">One</a><li><a href="/2">Two</a></ul></div><div class="cookie-notice"><p>We use cookies, as all do.</p><button>OK</button></div><div id="content"><h1>A walk</h1><p>We walked along the river, slowly, until it was dark.</p><blockquote>The river knows, she said.</blockquote><p>Then we went home; the walk had been long.</p><form class="newsletter"><label>Mail</label><input></form></div><div id="footer">&copy; 2020 A. Walker. <a href="/i">Imprint</a></div>', "A walk\nWe walked along the river, slowly, until it was dark.\nThe river knows, she said.\nThen we went home; the walk had been long."),
        ('<body><nav><a href="/">Home</a></nav><div class="ad">Buy now!</div><article><h1>Sum</h1><p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is well known, and easy.</p></article><footer><p>All rights reserved.</p></footer></body>', "Sum\nThe sum a+b is well known, and easy."),
    ]
    for html, want in pages:
        assert extract(html) == want


def test_long_pages_are_linear():
    import time

    n = 100_000
    for html in ("<b>" * n + "</i>" * n + "x", "<ul>" * n + "x", "<p>" + "<table>" + "<ul>" * n + "</ol>" * n, "<b>x" * n, "<head>" * n, "<a x='" * n, "<p>x<script>1</script>" * n, "<template>" * n + "x"):
        begin = time.process_time()
        body(html)
        assert time.process_time() - begin < 10
    html = "<article>" + "<b>" * 20_000 + "deep text, deep down here." + "</i>" * 20_000
    begin = time.process_time()
    extract(html)
    assert time.process_time() - begin < 20


def test_odd_input(spark):
    long = "<html><body><article>" + "<p>A sentence, that is part of a very long article.</p>" * 5000 + "</article></body></html>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "just text, no tags"), (4, "u", "<p>open <b>never closed"), (5, "u", "<script>only</script>"), (6, "u", "a < b && c > d"), (7, "u", long), (7, "u", long), (8, "u", "<" * 300), (9, "u", "<div>" * 3000 + "deep text, deep down here."), (10, "u", "</p></div>x"), (11, "u", "<textarea><p>in</textarea><title>t</title>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", H.F.lit("clash"))
    got = {r["page_id"]: r for r in H.extract(df).collect()}
    assert H.extract(df).count() == len(rows) and got[1]["text"] == got[2]["text"] == got[5]["text"] == "" and got[1]["n_chars"] == 0
    assert got[3]["text"] == "just text, no tags" and len(got[7]["text"].split("\n")) == 5000 and got[7]["n_chars"] == len(got[7]["text"])
    assert H.extract(df.limit(0)).count() == 0
