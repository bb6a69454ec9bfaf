import math
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sensorloom.llm import pages


def shown(page):
    blocks = pages.page_blocks(page)
    sure = [t for _, t, s in blocks if s]
    return "\n".join(sure or [t for _, t, _ in blocks])


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><h1>T</h1><p class=byline>By Ann Lee</p><p>text</article>", "T\nBy Ann Lee\ntext"),
        ("<article><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</article>", "where x=2 holds"),
        ("<article><p><label>Note</label> stays</p><object data=x>shown instead</object></article>", "Note stays\nshown instead"),
        ("<article><form><label>Your name</label><input></form>rest</article>", "rest"),
        ("<article>a < b <c and d", "a < b <c and d"), ("<article>a <b 'x>y</b> z", "a y z"), ("<p>a<!-- open <p>b", "a"),
        ("<p>one<p title=\"a > b\">two</p title='>'>three", "one\ntwo\n'>three"), ("<p>a</p <p>b", "a\nb"), ("x <a href=\"y", 'x <a href="y'),
    ],
)
def test_what_stays(page, text):
    assert shown(page) == text


BAD = {
    "starts without an end": "<a ", "starts and no white space": "<a", "elements left open, others ended": None, "quotes over tags": "<a '>'",
    "blocks left open": "<div>x", "lists left open": "<ul><li>", "ends alone": "</a ", "open comments": "<!-- ", "articles": "<article>a", "text under open elements": None,
    "ampersands": "&", "names": "<p class='ad'>x",
}


@pytest.mark.parametrize("kind", BAD)
def test_time_follows_the_length(kind):
    def page(n):
        if kind.startswith("elements"):
            return "<i><div>" + "<b>" * (n // 7) + "</i>" * (n // 7)
        if kind.startswith("text under"):
            return "<b>" * (n // 8) + "x<br>" * (n // 8)
        return BAD[kind] * (n // len(BAD[kind]))

    def seconds(n):
        started = time.process_time()
        pages.page_tree(page(n))
        return time.process_time() - started

    seconds(1000)
    small, large = max(min(seconds(50_000) for _ in range(3)), 0.002), seconds(1_000_000)
    assert large < 100 * small and large < 20  # 20 times the length; quadratic would be 400 times the time


def test_deep_nodes_are_judged(spark, prose):
    """A block below more than 64 others goes if its branch shows the same on every page."""
    deep = "<div>" * 100
    rows = [(i, f"http://a.example.com/{i}", f"{deep}<div class=box><p>Always here</p></div><section><p>{prose(20, i)}</p></section>") for i in range(10)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: prose(20, i) for i in range(10)}


def brute_importance(trees):
    """Node importance of one host's pages, (blocks, nodes) each, from the definition."""
    pages_of, shown_below = defaultdict(set), {}
    different = {}
    for blocks, nodes in trees:
        different.setdefault(tuple(b[1] for b in blocks), (blocks, nodes))
    for name, (blocks, nodes) in different.items():
        article = sum(len(b[1]) for b in blocks if b[2])
        for i, (path, *_, sure) in enumerate(nodes):
            below = []
            for block in blocks:
                at = block[4]
                while at >= 0 and at != i:
                    at = nodes[at][1]
                if at == i:
                    below.append(block[1])
            pages_of[path].add(name)
            shown_below[path, name] = (tuple(sorted(below)), sum(map(len, below)), article if sure else 0)
    out = {}
    for path, names in pages_of.items():
        told = [shown_below[path, name] for name in names]
        chars, rival, n = sum(t[1] for t in told), sum(t[2] for t in told), len(told)
        entropy = -sum(c / n * math.log(c / n) for c in Counter(t[0] for t in told).values()) / math.log(n) if n > 1 else 1.0
        out[path] = (n, 1.0 if n < pages.LEAST_PAGES or rival and 2 * chars > rival else entropy)
    return out


def test_importance_against_brute_force(spark, prose):
    words = [prose(6, i) for i in range(9)]
    html = [
        f"<body><div class=top><p>{words[i % 2]}</p><ul><li>{words[0]}<li>{words[i % 3]}</ul></div><article><h1>{words[i % 9]}</h1>"
        f"<div class=box><p>{words[i % 4]}</p><p>fixed</p></div><p>{prose(15, i // 2)}</p></article>{'<div class=low>x</div>' * (i % 3)}" +
        "<div class=foot>Call us</div>" for i in range(24)
    ]
    rows = [(i, "http://a.example.com/", page) for i, page in enumerate([*html, *html[:5], "", None])]
    parsed = pages.parse_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    got = {r.path: (r.pages, r.importance) for r in pages.node_importance(pages.tree_nodes(parsed)).collect()}
    wanted = brute_importance([pages.page_tree(page) for page in html])
    assert got.keys() == wanted.keys() and len(got) > 8
    for path, (n, importance) in wanted.items():
        assert got[path][0] == n and got[path][1] == pytest.approx(importance, abs=1e-9)
    assert any(v < pages.LEAST_IMPORTANCE for _, v in wanted.values()) and any(0.2 < v < 1 for _, v in wanted.values())


def test_a_host_with_many_paths_is_not_broadcast(spark, prose, monkeypatch):
    monkeypatch.setattr(pages, "fits_broadcast", lambda table: False)
    rows = [(i, "http://a.example.com/", f"<div class=top>Welcome</div><div class=story><p>{prose(20, i)}</p></div>") for i in range(8)]
    out = pages.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("weak", F.lit(1)))
    assert {r.page_id: r.text for r in out.collect()} == {i: prose(20, i) for i in range(8)}
