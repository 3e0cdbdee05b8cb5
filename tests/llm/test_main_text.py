import itertools
import re
from html import unescape

import numpy as np
import pytest

from editstream.llm import main_text
from editstream.llm.labelled_pages import labelled_pages
from editstream.llm.page_trees import KIND, SIZES, Trees


def trees(*pages):
    out = Trees()
    for number, html in enumerate(pages):
        out.add(number, html)
    return out


def random_model(seed):
    rng = np.random.default_rng(seed)
    return main_text.TreeModel(
        rng.normal(size=2), rng.normal(size=(len(KIND) * 3, 2, 2)), [rng.normal(size=(len(KIND), n, 2)) for n in SIZES]
    )


@pytest.mark.parametrize("seed", range(4))
def test_marginals_equal_the_sum_over_all_labellings(seed):
    model = random_model(seed)
    tree = trees("<div>a b<p class=ad>c</p></div><ul><li>x<li>y</ul>z", "<p>one</p>")
    features, roles = tree.features(), tree.roles()
    n = len(tree.parent)
    nodes, edges, total = np.zeros((n, 2)), np.zeros((n, 2, 2)), 0.0
    for labels in itertools.product((0, 1), repeat=n):
        log = 0.0
        for i, x in enumerate(labels):
            log += sum(t[tree.kind[i], v[i], x] for t, v in zip(model.seen, features))
            up = tree.parent[i]
            log += model.start[x] if up < 0 else model.edge[roles[i], labels[up], x]
        total += np.exp(log)
        for i, x in enumerate(labels):
            nodes[i, x] += np.exp(log)
            if tree.parent[i] >= 0:
                edges[i, labels[tree.parent[i]], x] += np.exp(log)
    got_nodes, got_edges = model.expected(tree, features)
    assert np.allclose(got_nodes, nodes / total)
    assert np.allclose(got_edges, edges[[i for i in range(n) if tree.parent[i] >= 0]] / total)
    assert np.allclose(model.marginals(tree), (nodes / total)[:, 1])


def test_fit_learns_labels_of_pages_it_has_not_seen():
    model = main_text.default_model()
    tree = trees(*labelled_pages(150, seed=9))
    leaves = np.array(tree.leaves)
    right = (model.marginals(tree)[leaves] >= 0.5) == np.array(tree.label)[leaves]
    assert right.mean() > 0.99


def texts(html):
    return trees(html).texts


@pytest.mark.parametrize(
    "html, found",
    [
        ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]),
        ("<p>x &amp;amp; y &lt;b&gt; &copy 2</p>", ["x &amp; y <b> © 2"]),
        ("a <b>b</b><i>c</i>\n\t d&nbsp;e", ["a bc d e"]),
        ('<script>var t="</p><p>no";</script>yes<style>p{}</style>', ["yes"]),
        ("<!-- <p>no</p> --><p>yes<!-->too", ["yestoo"]),
        ("<p>1 < 2 and 3 > 2</p>", ["1 < 2 and 3 > 2"]),
        ('<a title="x > y" href=\'b>c\'>t</a>', ["t"]),
        ('<p class="open>one</p><p>two</p>', ["one", "two"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<p>cut<foot", ["cut"]),
        ("</p></div></b>x</article>", ["x"]),
        ("<title>no</title><noscript>no</noscript><svg><text>no</text></svg>y", ["y"]),
        ("<script>never closed <p>x", []),
        ("<svg><p>x", ["x"]),
        ("", []),
        ("\x00<p> a b </p>", ["\x00", "a b"]),
    ],
)
def test_parsing(html, found):
    assert texts(html) == found


def test_parents_and_kinds():
    tree = trees("<article><h1>t</h1><ul><li>x</ul></article><nav>n</nav>")
    kinds = {v: k for k, v in KIND.items()}
    path = lambda i: [] if i < 0 else [*path(tree.parent[i]), kinds[tree.kind[i]]]
    assert [path(i) for i in tree.leaves] == [
        ["root", "article", "heading", "text in heading"],
        ["root", "article", "list", "item", "text in item"],
        ["root", "nav", "text in frame"],
    ]


PAGE = """<html><head><title>no</title></head><body><header><h1>Site name</h1><ul><li><a href=/>Home</a></li>
<li><a href=/a>About</a></li></ul></header><div class="cookie-notice"><p>We use cookies. Agree?</p><button>Yes</button></div>
<article><h1>The mill &amp; the river</h1><p>The old mill stood by the river for years, and nobody asked why.</p>
<div class="advert">Buy now! Only today.</div><p>Short.</p><p>One morning the wheel began to turn again; the
 whole village came to see.</p><form><label>Mail</label><button>Send</button></form></article>
<section id="comments"><h3>Comments</h3><p>I liked this very much, thank you. It is a fine text.</p></section>
<aside class="sidebar"><a href=/x>More</a> <a href=/y>Other things</a></aside><footer>&copy; 2020 Mill press.</footer>"""


def test_a_whole_page_and_odd_ones(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (None, None, "<nav><a>x</a></nav>")]
    rows.append((4, "deep", "<div>" * 3000 + "x" + "</div>" * 3000))
    rows.append((5, "long", "<article>" + "<p>All that is said here is said twice, and again.</p>" * 30_000))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumns({c: pages.url for c in ("text", "n_chars", "page", "label")})
    found = main_text.extract(pages).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r.page_id, []).append(r)
    want = (
        "The mill & the river\n\nThe old mill stood by the river for years, and nobody asked why.\n\nShort.\n\n"
        "One morning the wheel began to turn again; the whole village came to see."
    )
    assert [(r.url, r.text, r.n_chars) for r in by[1]] == [("u", want, len(want))] * 2
    assert [(r[0].text, r[0].n_chars) for r in (by[2], by[3], by[None])] == [("", 0)] * 3
    assert by[5][0].text.count("\n\n") == 29_999
    assert main_text.extract(pages.where("false")).count() == 0
    assert main_text.extract(pages.drop("url")).columns == ["page_id", "url", "text", "n_chars"]


def test_query_keeps_each_article_whole(spark):
    """The test pages put their text in one article element, without frames in it."""
    sf_dir = "/root/testdata/sf0.01"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = main_text.op12_main_text(spark, sf_dir).collect()
    assert len(found) == len(html)
    for row in found:
        inside = re.search(r"<article>(.*?)</article>", html[row.page_id], re.DOTALL).group(1)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?(?:b|br)>", " ", inside))
        blocks = [" ".join(unescape(p).split()) for p in parts]
        assert row.text == "\n\n".join(b for b in blocks if b)
        assert row.n_chars == len(row.text)
