import html as entities
import re

import pytest

from shelflife.llm import html as H

MODEL = H.trained()
SF001 = "/root/testdata/sf0.001"

CASES = [
    ('<body><header><h1>Site</h1><nav><a>Home</a></nav></header><section class="hero"><p>Welcome</p>'
     '</section><article class="post"><header><h1>Real title</h1></header><p>One.</p>'
     '<div class="promo">x y</div><p>Two.</p></article><div class="comments-area"><h3>2 replies</h3>'
     '<p>Hello I think this.</p></div><div class="subscribe-box"><p>Subscribe now</p></div></body>',
     "Real title\nOne.\nTwo."),
    ('<div class="sidebar"><p>' + "side words " * 40 + '</p></div><div class="main"><p>Short real.</p></div>'
     '<div class="banner">Big sale</div><div id="disqus_thread"><p>' + "comment " * 50 + "</p></div>",
     "Short real."),
    ('<div id="content"><h1>Title</h1><p>By <span class="author">Jane</span></p><div class="ad-slot">Ad</div>'
     '<p>Second <b>bold</b> and <a href=x>link text</a>.</p><table><tr><td>c1<td>c2</table></div>'
     '<div id="footer"><p>Copyright all rights reserved.</p></div>',
     "Title\nBy Jane\nSecond bold and link text.\nc1\nc2"),
    ('<article><p>Real.</p><section class="comments"><article class="comment"><p>Reader says a lot of '
     'things here.</p></article></section></article>', "Real."),
    ("<p>Just a <i>paragraph</i>.</p><p>Another\n \t one</p>", "Just a paragraph.\nAnother one"),
    ("plain text only", "plain text only"), ("", ""), ("<nav><a>x</a></nav>", ""),
    ("<article><p>a &lt;b&gt; &amp;amp; &eacute;&#33;</p><script>if (a<b) '</p>'</script>"
     "<p>z<!-- c --><br>y</p></article>", "a <b> &amp; \xe9!\nz y"),
    ("<article><p>cut off here<p>and here <a href='x", "cut off here\nand here"),
]


FOREIGN_CASES = [
    ('<article><p>One.</p><svg width="9" /><p>Two.</p></article>', "One.\nTwo."),
    ('<article><p>One <SVG/>and <math/>two.</p><svg><text>drawn</text></svg><p>Three.</p></article>',
     "One and two.\nThree."),
    ('<article><p>Let <math display="inline"><mi>x</mi><mo>=</mo><mspace/><mn>2</mn></math> hold.</p>'
     '<p>Then it ends.</p></article>', "Let x=2 hold.\nThen it ends."),
]


@pytest.mark.parametrize("page,want", FOREIGN_CASES)
def test_svg_and_math(page, want):
    assert H.extract(page, MODEL) == want


@pytest.mark.parametrize("page,want", CASES)
def test_main_text(page, want):
    assert H.extract(page, MODEL) == want


def test_white_space_is_that_of_unicode():
    page = f"<html><body><article><p>{'Some words of an article here '*3}a&nbsp;b&#12288;c\t\n d</p></article></body></html>"
    assert H.extract(page, MODEL) == "Some words of an article here " * 3 + "a b c d"


def test_marginals_are_probabilities_and_match_enumeration():
    """Sum-product against the sum over all states of a small tree."""
    from itertools import product
    page = H.Page("<article><p>text here</p><div class='ad'><a>x</a></div></article>")
    node = MODEL.evidence(page)
    n = len(node)
    total = [[0.0] * 4 for _ in range(n)]
    for states in product(range(4), repeat=n):
        p = MODEL.ROOT[states[0]] * node[0][states[0]]
        for i in range(1, n):
            ss, sc, sx, cc, cx = MODEL.edge[page.tags[i] not in H.BLOCK]
            edge = {(0, 0): ss, (0, 1): sc, (0, 2): sx, (1, 1): cc, (1, 2): cx, (2, 3): 1, (3, 3): 1}
            p *= edge.get((states[page.parents[i]], states[i]), 0) * node[i][states[i]]
        for i, s in enumerate(states):
            total[i][s] += p
    for own, m in zip(total, MODEL.marginals(page)):
        assert m == pytest.approx([x / sum(own) for x in own], abs=1e-6)


def test_labelled_pages_that_were_not_learned():
    hit = seen = 0
    for page, states in H.labelled_pages(60, seed=12345):
        for p, y, own in zip(MODEL.marginals(page), states, page.own):
            if own:
                seen += 1
                hit += (p[H.CONTENT] >= p[H.BOX] + p[H.INSIDE]) == (y == H.CONTENT)
    assert hit / seen > 0.96


def expected(page):
    body = re.search(r"<article>(.*?)(</article>|<footer|\Z)", page, re.S)[1]
    body = re.sub(r"<[^>]*\Z", "", body)
    blocks = (re.sub(r"<[^>]*>", "", re.sub("<br>", " ", x)) for x in re.split(r"</?(?:p|h1)>", body))
    blocks = (" ".join(entities.unescape(x).split()) for x in blocks)
    return "\n".join(x for x in blocks if x)


def test_all_pages(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    got = {r.page_id: r for r in H.main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == expected(r.html) and got[r.page_id].url == r.url
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_edges(spark):
    from pyspark.sql import functions as F
    deep = "<div>" * 100_000 + "<p>deep down</p>"
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "v", "<"), (3, "w", "<p>" + "long " * 50000),
            (4, "x", deep), (5, "y", "</p></div><!-- open"), (6, "z", "<p title='a>b\">t</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    got = H.main_text(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert (by[1].text, by[1].n_chars, by[None].url) == ("", 0, None)
    assert by[3].n_chars == 50000 * 5 - 1
    assert H.main_text(df.limit(0)).count() == 0
