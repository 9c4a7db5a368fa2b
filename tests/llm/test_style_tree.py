from __future__ import annotations

import html
import math
import re
from collections import Counter

import pytest

from haulmark.llm import style_tree
from haulmark.llm.queries import op12_style_tree


def _text(page, tree=None):
    return " ".join(style_tree.keep_blocks(page, tree or {}))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>one<p>two <b>three<br>four</p><p>a<i>b</i>c", "one two three four abc"),
        ("<script>var t='</p><p>no';</script><p>yes<style>p{}</style> sir", "yes sir"),
        ("<p>caf&eacute; &amp &lt;b&gt; &#233;&#xe9; &am", "café & <b> éé &am"),
        ("<p>\n a\t b c </p>\n<p> d", "a b c d"),
        ("<!-- <p>no</p> --><p>yes<!-- never closed <p>no", "yes"),
        ("<nav><a>Home</a></nav><header>Top</header><main><header>Title</header><p>Body</main><aside>Side</aside><footer>End", "Title Body"),
        ("<article>Text<div class='share-links'>Tweet</div> more<section id=comments>First!</section></article>", "Text more"),
        ("<article>A <span class='ad'>Buy</span> B</article>", "A B"),
        ("<form>Name <input name=x></form><p title='a > b'>ok", "ok"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a b c"),
        ("1 < 2 and 3 > 2 </b></nothing>", "1 < 2 and 3 > 2"),
        ("<html><head><title>T</title><body><p>shadow head", "shadow head"),
        ("<div class=header>x</div><p>y", "x y"),
    ],
)
def test_pages(page, text):
    assert _text(page) == text


def _sites():
    """Pages whose boilerplate says nothing by tag or name; only the comparison over the site tells it."""
    pages = []
    for k in range(40):
        body = "".join(f"<div class=x3>Paragraph {k} {j} of its own.</div>" for j in range(1 + k % 4))
        pages.append((k, f"https://a.example/{k}", f"<body><div class=x1><div>Home</div><div>About us</div></div><div class=x2>{body}</div><div class=x4>All yours {k % 2}</div>"))
    return pages


def test_repeated_branches_of_a_site_go(spark):
    pages = _sites()
    got = {r["page_id"]: r["text"] for r in style_tree.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {k: " ".join(f"Paragraph {k} {j} of its own." for j in range(1 + k % 4)) for k in range(40)}


def _loops(pages):
    """Importance of every path of every host by loops, without the drawing towards all hosts."""
    hosts = {}
    for host, page in pages:
        blocks, elements = style_tree.parse(page)
        found = {("text", path, text) for path, text, *_ in blocks} | {("style", p, c) for p, c in elements if c}
        hosts.setdefault(host, []).append(found)
    result = {}
    for host, each in hosts.items():
        counts = Counter(x for found in each for x in found)
        pages_of = Counter(p for found in each for p in {x[1] for x in found})
        paths = {path for kind, path, _ in counts if kind == "text"}
        nodes = {"/" + "/".join(p[1:].split("/")[:k]) for p in paths for k in range(1, p.count("/") + 1)}
        for node in nodes:
            top = bottom = 0
            for (kind, path, _), n in counts.items():
                if kind == "text" and (path == node or path.startswith(node + "/")):
                    m = pages_of[path]
                    top, bottom = top + n * (1 - (math.log(n) / math.log(m) if m > 1 else 0)), bottom + n
            styles = [n for (kind, path, _), n in counts.items() if kind == "style" and path == node]
            value = top / bottom
            if styles:
                m, total = pages_of[node], sum(styles)
                entropy = -sum(n / total * math.log(n / total) for n in styles) / math.log(m) if m > 1 else 1.0
                keep = style_tree.DAMPING ** len(styles)
                value = (1 - keep) * entropy + keep * value
            result[host, node] = value
    return result


def test_importance_against_loops(spark):
    rows = [("a", p) for _, _, p in _sites()]
    rows += [("b", r["html"]) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(20).collect()] + [("c", "<p>alone")]
    df = spark.createDataFrame(rows, "host string, html string")
    counts = df.mapInPandas(style_tree._page_features, style_tree._STATS).groupBy("host", "path", "kind", "feature").sum("n").withColumnRenamed("sum(n)", "n")
    got = {(r["host"], r["path"]): r["importance"] for r in style_tree._importance(counts, ["host"]).collect()}
    assert got == pytest.approx(_loops(rows))


def test_whole_table(spark):
    """The pages of the table hold one article; its text by a pattern of its own."""
    sf = "/root/testdata/sf0.01"
    found = op12_style_tree(spark, sf).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S).group(1)
        article = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1)>|<br>", " ", article))
        assert r["text"] == " ".join(html.unescape(article).split())
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_nulls_repeats_very_long_pages_clashing_columns_and_empty_table(spark):
    long = "<p>" + "word " * 300_000
    rows = [(1, "https://h.example/1", "<p>a"), (1, "https://h.example/1", "<p>a"), (None, None, None), (2, "no address", ""), (3, None, long), (4, "http://", "<p " * 5000)]
    df = spark.createDataFrame([(*r, "h", "t", 5) for r in rows], "page_id long, url string, html string, host string, tree string, key int")
    out = style_tree.main_text(df)
    assert out.columns == ["page_id", "url", "text"]
    got = Counter((r["page_id"], r["text"]) for r in out.collect())
    assert got[1, "a"] == 2 and got[None, ""] == 1 and got[2, ""] == 1 and got[3, long[3:].strip()] == 1 and sum(got.values()) == 6
    assert style_tree.main_text(df.limit(0)).count() == 0
