r"""Main text of web pages, by the site style tree.

A page is a tree of block elements; inline markup does not count. The trees of one host are merged:
elements of the same path of tags and class names are one node. A node's presentation entropy says how
much its sequences of child elements differ from page to page, and the content entropy of a node with
text how many pages share the same text. Nodes that look and read alike everywhere are of low importance
(menus, footers, notices, adverts), those that differ on every page of high importance. An inner node's
importance blends its presentation with the importance of the text below it. Branches of low importance go.

A host of few pages says little; its figures are drawn towards those of the same path over all hosts. What
tags and class names say about a branch raises or lowers its importance, so a single page works too.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from haulmark.llm.common import written
from haulmark.operators.skew import lookup_join

#: Elements of HTML without a meaning for blocks (fixed values).
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress
    q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split()
)

#: Elements without content (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Elements whose content is no text of the page (fixed values).
HIDDEN = frozenset(
    """applet audio button canvas datalist form head iframe math noembed noframes noscript object script select
    style svg template textarea title video""".split()
)

#: Elements around an article (fixed values).
AROUND = frozenset("aside dialog footer header menu nav search".split())

#: Elements that an opening tag of the same group closes.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
}

#: Class names and ids, or parts of them, of what is not the article.
NOISE = re.compile(
    r"(?:^|[-_ ])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"nav|navbar|navigation|menu|breadcrumbs?|pager|pagination|toolbar|sidebar|side|aside|widget|related|recommend\w*|trending|"
    r"share|sharing|social|follow|subscribe|newsletter|signup|login|comments?|disqus|replies|respond|footer|foot|masthead|"
    r"site-header|page-header|top-bar|topbar|skip|copyright|legal|disclaimer)(?:$|[-_ ])"
)

MAIN = frozenset(["article", "main"])

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|noembed|noframes|iframe|template|svg|math|xmp)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r".*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CLASS = re.compile(r"(?:^|\s)class\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

#: Weights of branches by their tags and names, and the least importance of what stays.
NOISY, OUTSIDE, INSIDE, LEAST = 0.4, 0.7, 1.5, 0.5

#: Weight of presentation falls with each kind of child by this factor.
DAMPING = 0.9

#: Pages that the figures over all hosts stand for.
PRIOR_PAGES = 20


class _Node:
    """An open element: its path, whether its text is hidden, its weight, and its kinds of children in order."""

    __slots__ = ("children", "hidden", "inside", "noisy", "path", "tag")

    def __init__(self, tag: str, path: str, hidden: bool, noisy: bool, inside: bool):
        self.tag, self.path, self.hidden, self.noisy, self.inside, self.children = tag, path, hidden, noisy, inside, []


def parse(page: str) -> tuple[list[tuple[str, str, bool, bool]], list[tuple[str, tuple[str, ...]]]]:
    """Blocks of text (path, text, noisy by name, inside the article) and elements (path, kinds of children).

    Missing end tags are supplied as browsers do for paragraphs, list items and table cells; an end tag
    without its element is ignored. Character references are decoded, also those without a semicolon.
    """
    root = _Node("", "", False, False, False)
    stack, blocks, elements, words = [root], [], [], []

    def flush() -> None:
        if words:
            text = " ".join(entities.unescape("".join(words)).split())
            words.clear()
            top = stack[-1]
            if text and not top.hidden:
                blocks.append((top.path, text, top.noisy, top.inside))

    def close(depth: int) -> None:
        flush()
        while len(stack) > depth:
            node = stack.pop()
            if not node.hidden:
                elements.append((node.path, tuple(node.children)))

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            words.append(page[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag, attrs = tag.lower(), token["attrs"]
        if token["end"]:
            if tag in INLINE and stack[-1].tag != tag:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
            continue
        if tag in VOID:
            words.append(" ")
            if tag == "hr":
                flush()
            continue
        names = " ".join("".join(x) for x in _NAMES.findall(attrs)).lower() if "=" in attrs else ""
        noisy = bool(names) and NOISE.search(names) is not None
        if tag in INLINE and not noisy:
            continue
        flush()
        if stack[-1].tag == "head" or (stack[-1].tag == "p" and tag not in INLINE):
            close(len(stack) - 1)
        if tag in _CLOSES:
            closed, within = _CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in closed:
                    close(depth)
                    if tag != "tr":
                        break
                elif stack[depth].tag in within:
                    break
        top = stack[-1]
        classes = ".".join(sorted({w for x in _CLASS.findall(attrs) for w in "".join(x).lower().split()})) if "=" in attrs else ""
        kind = f"{tag}.{classes}" if classes else tag
        if not top.children or top.children[-1] != kind:
            top.children.append(kind)
        around = tag in AROUND and not (tag == "header" and top.inside)
        if tag not in ("html", "body"):
            inside = top.inside or tag in MAIN
            stack.append(_Node(tag, f"{top.path}/{kind}", top.hidden or tag in HIDDEN, top.noisy or around or noisy, inside))
        else:
            stack.append(_Node(tag, top.path, top.hidden, top.noisy, top.inside))
    words.append(page[at:])
    close(1)
    return blocks, [(path, children) for path, children in elements if path]


_STATS = "host string, path string, kind string, feature long, n long"


def _page_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch: pages with a path (kind `page`), with a text (`text`) or a sequence of children (`style`) there."""
    for batch in batches:
        seen: dict[tuple, int] = {}
        for host, page in zip(batch["host"], batch["html"], strict=True):
            blocks, elements = parse(page or "")
            found = {(host, path, "text", text) for path, text, *_ in blocks}
            found |= {(host, path, "style", children) for path, children in elements if children}
            found |= {(host, path, "page", 0) for _, path, *_ in found}
            for key in found:
                seen[key] = seen.get(key, 0) + 1
        rows = [(host, path, kind, _feature(feature), n) for (host, path, kind, feature), n in seen.items()]
        yield pd.DataFrame(rows, columns=["host", "path", "kind", "feature", "n"])


def _feature(value) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(repr(value).encode("utf-8", "surrogatepass")) - 2**63


def _importance(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, path, pages, importance) of every node with text below it.

    A text on n of m pages has the entropy log n / log m; a sequence of children on n of all pages the share p = n / all
    and the entropy of the shares is taken to the base m. Both follow from sums over n and n log n, so a node
    with very many texts is summed in each task before the shuffle.
    """
    node = [*keys, "path"]
    found = counts.groupBy(*node).agg(
        F.max(F.when(F.col("kind") == "page", F.col("n"))).alias("pages"),
        *[
            total.alias(f"_{name}_{what}")
            for name in ("text", "style")
            for here in [F.col("kind") == name]
            for what, total in (
                ("n", F.sum(F.when(here, F.col("n")))),
                ("nlogn", F.sum(F.when(here, F.col("n") * F.log("n")))),
                ("kinds", F.count_if(here)),
            )
        ],
    )
    base = F.nullif(F.log("pages"), F.lit(0.0))
    text = found.filter("_text_n > 0").select(
        *node, F.col("_text_n").alias("_texts"), (F.col("_text_n") - F.coalesce(F.col("_text_nlogn") / base, F.lit(0.0))).alias("_own")
    )
    entropy = (F.log("_style_n") - F.col("_style_nlogn") / F.col("_style_n")) / base
    style = found.filter("_style_n > 0").select(*node, F.col("_style_kinds").alias("_kinds"), F.coalesce(entropy, F.lit(1.0)).alias("_style"))
    pages = found.select(*node, "pages")
    steps = F.split(F.substring("path", 2, 2**30), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.concat(F.lit("/"), F.array_join(F.slice(steps, 1, k), "/")))
    below = text.select(*keys, F.explode(above).alias("path"), "_texts", "_own").groupBy(*node).agg(
        (F.sum("_own") / F.sum("_texts")).alias("_below")
    )
    kept = F.pow(F.lit(DAMPING), F.col("_kinds"))
    blended = F.coalesce((1 - kept) * F.col("_style") + kept * F.col("_below"), F.col("_below"))
    return below.join(style, node, "left").join(pages, node, "left").select(*node, F.coalesce("pages", F.lit(1)).alias("pages"), blended.alias("importance"))


def style_trees(pages: DataFrame, html: str = "html", host: str = "host") -> DataFrame:
    """(host, tree) with `tree` an array of (path, importance) of the paths with text that fall below `LEAST` / `OUTSIDE`.

    The importance of a path is the mean over its nodes below the body.
    """
    stats = pages.select(F.col(host).alias("host"), F.col(html).alias("html")).mapInPandas(_page_features, _STATS)
    counts = written(stats.groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n")), "style_counts")
    everywhere = counts.groupBy("path", "kind", "feature").agg(F.sum("n").alias("n"))
    general = _importance(everywhere, []).select("path", F.col("importance").alias("_general"))
    own = _importance(counts, ["host"]).join(general, "path")
    drawn = (F.col("pages") * F.col("importance") + PRIOR_PAGES * F.col("_general")) / (F.col("pages") + PRIOR_PAGES)
    nodes = written(own.select("host", "path", drawn.alias("importance")), "style_nodes")
    texts = counts.filter("kind = 'text'").select("host", "path").distinct()
    steps = F.split(F.substring("path", 2, 2**30), "/")
    prefix = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.concat(F.lit("/"), F.array_join(F.slice(steps, 1, k), "/")))
    along = texts.select("host", F.col("path").alias("leaf"), F.explode(prefix).alias("path")).join(nodes, ["host", "path"])
    leaves = along.groupBy("host", "leaf").agg(F.avg("importance").alias("importance")).filter(F.col("importance") < LEAST / OUTSIDE)
    return leaves.groupBy("host").agg(F.collect_list(F.struct(F.col("leaf").alias("path"), "importance")).alias("tree"))


def keep_blocks(page: str, tree: dict[str, float]) -> list[str]:
    """Texts of the blocks whose weighted importance reaches `LEAST`, in page order."""
    blocks, _ = parse(page)
    article = any(inside for _, _, noisy, inside in blocks if not noisy)
    kept = []
    for path, text, noisy, inside in blocks:
        weight = NOISY if noisy else 1.0 if not article else INSIDE if inside else OUTSIDE
        if weight * tree.get(path, 1.0) >= LEAST:
            kept.append(text)
    return kept


@F.pandas_udf(StringType())
def _main_text(pages: pd.Series, trees: pd.Series) -> pd.Series:
    texts = []
    for page, tree in zip(pages, trees, strict=True):
        low = {} if tree is None else {node["path"]: node["importance"] for node in tree}
        texts.append(" ".join(keep_blocks(page or "", low)))
    return pd.Series(texts, dtype=object)


def host_of(url: Column) -> Column:
    """Host of an address, lower-cased; empty where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url.cast("string")), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(`key`, `url`, text) of every page: the article's blocks, joined by a space.

    White space inside a block becomes one space. A null or empty page has an empty text; pages without
    a host are one site; repeated rows are pages of their own, with a result each. Pages of any length are
    read whole, other columns are left out, an empty table gives no rows. A site's tree goes to
    its pages by `lookup_join`, so a host with very many pages is not gathered.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(F.col(url)).alias("host"))
    trees = written(style_trees(rows), "style_trees")
    met = lookup_join(rows, trees, "host", "left")
    return met.select(F.col("key").alias(key), F.col("url").alias(url), _main_text("html", "tree").alias("text"))
