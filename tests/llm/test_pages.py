"""Page text: blocks, and the labeller on layouts it was not trained on."""

import time
import tracemalloc

import numpy as np
import pytest

from vertexloom.llm.page_text import Labeller, extract, features, leaves, main_text, rewritten, tags_say

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body><nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy this now.</div><article><h1>A &amp; title</h1><p><b>Some   text, first.<br><p>More of it &eacute;
on two lines.</p><ul><li>point</ul></article><footer>&copy; site</footer></body></html>"""


def test_blocks():
    texts = [b.text for b in leaves(PAGE)]
    assert texts == ["Menu one", "Menu two", "Buy this now.", "A & title", "Some text, first.", "More of it é on two lines.", "point", "© site"]
    assert leaves(None) == leaves("") == leaves("<p> \n</p><!-- x") == []
    assert [b.text for b in leaves("a < b <p title='x>y'>c</p> 1 <2")] == ["a < b", "c", "1 <2"]
    assert [b.text for b in leaves("<p>cut <b>off")] == ["cut off"]


def test_gradients_agree_with_differences():
    model, rng = Labeller(), np.random.default_rng(0)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    pages = [features(leaves(rewritten([f"word{i} and more." for i in range(9)], rng))[:6]) for _ in range(2)]
    labels = [np.arange(len(p[0])) % 2.0 for p in pages]

    def loss():
        total, count = 0.0, 0
        for p, y in zip(model.scores(pages), labels):
            total -= (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
            count += len(y)
        return total / count

    grads = model.gradients(pages, labels)
    for name in ("fh", "bx", "out", "numbers"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        old = model.weights[name][at]
        model.weights[name][at] = old + 1e-2
        up = loss()
        model.weights[name][at] = old - 1e-2
        down = loss()
        model.weights[name][at] = old
        assert grads[name][at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=1e-4)


def test_extraction(spark):
    plain = PAGE.replace("<article>", '<div class="post-body">').replace("</article>", '</div><section class="comments"><p>First!</p></section>')
    rows = [(1, "u", PAGE), (2, "v", None), (3, None, ""), (4, "w", PAGE * 40), (1, "u", PAGE), (5, "x", plain), (6, "y", "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS text", "1 AS row")
    got = [(r["row"]["page_id"], r["text"]) for r in extract(pages).collect()]
    article = "A & title\nSome text, first.\nMore of it é on two lines.\npoint"
    assert len(got) == len(rows)
    texts = dict(got)
    assert texts[1] == article and texts[5] == article and texts[2] == texts[3] == ""
    assert texts[4].count("A & title") == 40 and "Menu" not in texts[4]
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "inside, wanted",
    [
        ('<p>a</p><svg class="i"/><p>b</p><p>c</p>', "a b c"),
        ('<p>a</p><svg><title>t</title><text>no</text></svg><p>b</p>', "a b"),
        ("<p>a</p><svg><path d=''><p>b</p>", "a b"),
        ('<p>a</p><object data="x">no</object><p>b</p>', "a b"),
        ("<p>a</p><object data='x'><p>b</p>", "a b"),
        ("<p>a <svg/> b</p><script>no", "a b"),
    ],
)
def test_elements_without_text_hide_nothing_behind_them(inside, wanted):
    assert " ".join(b.text for b in leaves(f"<article>{inside}")) == wanted


def test_all_words_of_a_class_count():
    many = " ".join("w" * (i + 1) for i in range(40))
    assert tags_say(leaves(f'<article><div class="{many} sidebar"><p>x</p></div></article>')[0]) is False
    deep = "<a href='/'>" + "<b><i><u><em><strong>" * 3 + "linked"
    assert leaves(f"<p>{deep}</p>")[0].linked == 1.0


def test_very_long_pages_are_bounded():
    labeller = Labeller()
    short = ["<article><p>one</p><p>two</p></article>"] * 127
    long = "<article>" + "".join(f"<p>block {i}</p>" for i in range(30_000)) + "</article>"
    tracemalloc.start()
    texts = main_text(labeller, [*short, long])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(texts) == 128 and peak < 400e6
    alone = labeller.scores([features(leaves(long))])[0]
    assert texts[-1].count("\n") + 1 == int((alone >= 0.5).sum()) or not (alone >= 0.5).any()
    start = time.monotonic()
    assert len(leaves("<p>" + "<b>x</b>" * 40_000 + "</p>")) == 1
    assert time.monotonic() - start < 20


def test_stretches_of_a_page_give_the_same_scores(monkeypatch):
    page = [features(leaves("".join(f"<p>block {i % 7} of {i}</p>" for i in range(100))))]
    whole = Labeller().scores(page)[0]
    monkeypatch.setattr("vertexloom.llm.page_text.STEPS_AT_ONCE", 7)
    assert np.allclose(Labeller().scores(page)[0], whole, atol=1e-6)
