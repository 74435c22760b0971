"""Wrappers are fitted on all pages of a host, spread over tasks and rounds."""

import itertools
import random

from aerolith.llm import wrappers


def test_alignment_is_longest():
    rng = random.Random(5)
    for _ in range(200):
        a, b = (["%d" % rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        steps = wrappers.aligned(a, b)
        assert sum(q - p for what, p, q, _, _ in steps if what == "equal") == best[-1][-1]
        assert all(a[p:q] == b[r:s] for what, p, q, r, s in steps if what == "equal")
        assert [x for _, p, q, _, _ in steps for x in a[p:q]] == a
        assert [x for *_, r, s in steps for x in b[r:s]] == b


def page(k, line, extra=""):
    return (f"<body><div id=x><h1>Head {k}</h1>{extra}<p>Text of page {k} that is its own</p>"
            f"<h6>{line}</h6></div></body>")


def test_texts_that_differ_on_few_pages(spark):
    """A line that three of 400 pages have otherwise is no template; one of all pages is."""
    rows = [(k, "http://few/%d" % k, page(k, "Rare" if k in (7, 200, 333) else "Usual"))
            for k in range(400)]
    rows += [(1000 + k, "http://all/%d" % k, page(k, "Usual")) for k in range(400)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    for r in wrappers.main_texts(frame).collect():
        k = r.page_id % 1000
        line = "" if r.page_id >= 1000 else " Rare" if k in (7, 200, 333) else " Usual"
        assert r.text == f"Head {k} Text of page {k} that is its own{line}"


def test_rounds_and_layouts_agree(spark):
    """Every page counts, whatever the files' layout; many shapes take several rounds."""
    kinds = ("ul", "ol", "table", "section", "figure", "dl")
    extra = ["".join(f"<{t}><li>{k}</li></{t}>" for t in order)
             for k, order in enumerate(itertools.permutations(kinds, 3))]
    rows = [(f"h{k % 2}", page(k, "Usual", extra[k % len(extra)])) for k in range(600)]
    frame = spark.createDataFrame(rows, "host string, html string")
    of = lambda parts, group: {r.host: r for r in wrappers.host_wrappers(
        frame.repartition(parts), group).collect()}
    found = of(3, 4)
    assert found == of(11, 4)
    whole = of(3, 1000)
    for host in ("h0", "h1"):
        assert found[host].pages == whole[host].pages == 300
        assert found[host].main == whole[host].main and found[host].template == whole[host].template != ""
