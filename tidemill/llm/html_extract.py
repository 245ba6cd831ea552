"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded along the tree.

A page is parsed into a tree of elements (end tags that HTML lets authors leave out are implied). Each element gets features of its subtree
(text, links, words, stops, elements), of its attribute tokens, of its depth and of its siblings; boosted trees give the chance that it belongs
to the article. Decoding picks the most likely labelling in which nothing inside a dropped element is kept, so an element and its
ancestors never contradict each other. The kept elements' text is put out block by block.

The trees are trained here, by Spark ML, on the elements of a bounded sample of pages (``SAMPLE_PAGES``, in the order of a hash of the id) and of
``LESSONS``, small pages that have every kind of part an article page may have. As pages carry no labels, they are labelled by their mark-up: an element is
boilerplate if it or an ancestor is of a boilerplate kind or named so, and article if it lies in an article or main element.
Elements that say neither are not learned from. Trained trees judge by all features together, so they also judge those.

Defined results: a null or empty page has the empty text; scripts, styles, comments and head elements are never text; a page of bare text is
one block. Extra columns are left alone, result columns replace those of the same name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import settle

SAMPLE_PAGES = 300
SAMPLE_CHARS = 50_000
TREES, DEPTH = 12, 4

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg select option datalist".split())
SILENT = RAW | {"head"}
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends an open element of these names, looked for up to the nearest of the stops.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
P_CLOSERS = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "legend", "summary"}
BOILER_TAGS = frozenset("nav footer aside form button menu dialog header".split())
BOILER_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager "
    "popup promo promoted promotion recommended register related reply replies respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
MAIN_NAMES = frozenset("article body content entry main post story text".split())

# A tag as browsers read it: quotes count only after "=", and nothing is tried twice, so that no page takes long.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+|=)*+)>")
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NAMED = frozenset("class id role itemprop aria-label".split())
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

LESSONS = (
    '<body><header class="site-header"><a href="/">Home</a> <a href="/a">News</a></header><nav><ul><li><a href="/x">One</a><li><a href="/y">Two</a></ul></nav>'
    "<div class='cookie-notice'><p>We use cookies on this site. Press accept to go on.</p><button>Accept</button></div>"
    "<main><article><h1>A walk along the river</h1><p>The path follows the water for a mile and then climbs, <a href='/m'>as the map shows</a>, to a farm.</p>"
    "<p>From there one sees the whole valley, the mill and both bridges, if the morning is clear.</p><div class='ad'><p>Buy new boots now, half price today.</p></div>"
    "<blockquote>Nobody walks it twice in one day.</blockquote><ul><li>Take water.</li><li>Start early, before the heat.</li></ul></article></main>"
    "<aside class='sidebar'><h3>Related</h3><ul><li><a href='/r'>Another walk by the sea</a></ul></aside>"
    "<section id='comments'><h2>Comments</h2><div class='comment'><p>I went there last year and it was lovely, thank you for the story.</p></div>"
    "<form><label>Your reply</label><input name='t'></form></section><footer><p>All rights reserved. <a href='/imprint'>Imprint</a></p></footer></body>",
    "<body><div id='top-menu'><a href='/1'>Start</a> | <a href='/2'>Shop</a> | <a href='/3'>Help</a></div><div class='post-content'><h2>How bread rises</h2>"
    "<p>Yeast eats sugar and gives off gas, and the dough holds the gas in small bubbles.</p><p>Warm dough rises faster, cold dough tastes better.</p>"
    "<table><tr><td>Warm</td><td>one hour</td></tr><tr><td>Cold</td><td>one night</td></tr></table></div>"
    "<div class='share-buttons'><a href='#'>Share</a></div><div class='newsletter signup'><p>Get a letter from us each week, free of charge.</p></div>"
    "<div class='reader-comments'><p>My dough never rises at all, whatever I do with it.</p></div><div id='footer'>Contact and terms</div></body>",
)

#: Pages whose names say nothing: what the classes "q" (boilerplate) and "z" (article) mark must be told by links, length and place.
PLAIN_LESSONS = (
    "<body><div class='q'><a href='/1'>Start</a> <a href='/2'>World</a> <a href='/3'>Money</a> <a href='/4'>Sport</a></div><div class='x'><div class='z'>"
    "<h1>The mill is open again</h1><p>After nine years of repairs the mill on the east bank grinds corn again, and the first flour was sold on Saturday.</p>"
    "<p>The wheel, as <a href='/w'>the builders</a> say, is the largest in the county, and turns four times a minute when the water is high.</p>"
    "<p>Visitors may see it from noon to five.</p></div><div class='q'><ul><li><a href='/5'>Bridge closed until spring after flood</a></li>"
    "<li><a href='/6'>Council votes on new school next week</a></li><li><a href='/7'>Five walks for dry days in autumn</a></li></ul></div></div>"
    "<div class='q'><p>Copyright 2020 The Valley Post. <a href='/8'>Terms</a> <a href='/9'>Privacy</a> <a href='/10'>Contact</a></p></div></body>",
    "<body><div class='x'><ul class='q'><li><a href='/a'>Home</a></li><li><a href='/b'>About us</a></li><li><a href='/c'>Archive</a></li></ul><div class='x'><section class='z'>"
    "<h2>Why leaves turn red</h2><p>In autumn the green of a leaf is taken back into the tree, and what is left shows its own colour.</p>"
    "<p>Cold nights and bright days make the strongest red, because sugar stays in the leaf and feeds the dye.</p><ul><li>Maple turns first.</li>"
    "<li>Oak turns late, and keeps its leaves.</li></ul></section><div class='q'><a href='/d'>Older</a> <a href='/e'>Newer</a></div></div>"
    "<div class='q'>All rights reserved. <a href='/f'>Imprint</a></div></div></body>",
)


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    names: list[str]
    hidden: bool
    inside: bool = False  # of an article
    formula: bool = False  # math or a part of it: goes with what it stands in
    parts: list[str | int] = field(default_factory=list)  # own text and children, in page order

    @property
    def boilerplate(self) -> bool:
        """By its tag; an article's own header holds its title."""
        return self.tag in BOILER_TAGS and not (self.tag == "header" and self.inside)


def attributes_of(attributes: str) -> tuple[list[str], bool]:
    """Tokens of the naming attributes, and whether an attribute hides the element: hidden or style with display:none."""
    names, hidden = [], False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value[1:-1] if value[:1] in ('"', "'") else value
        if name in NAMED:
            names += [t.lower() for t in _TOKEN.findall(value)]
        elif name == "hidden" or name == "style" and _NO_DISPLAY.search(html.unescape(value)):
            hidden = True
    return names, hidden


def parse(page: str | None) -> list[Node]:
    """Elements in page order, parents first; the first one is the page.

    What a "<" without a tag begins is text; a comment or a tag that never ends swallows the rest.
    """
    nodes, open_ = [Node("page", -1, 0, [], False)], [0]
    at, size, page = 0, len(page or ""), page or ""
    while at < size:
        text, m, here = at, None, page.find("<", at)
        while here >= 0:
            after = page[here + 1 : here + 2]
            if after in ("!", "?") and after or after.isascii() and after.isalpha() or after == "/" and page[here + 2 : here + 3].isalpha():
                break
            here = page.find("<", here + 1)
        if text < (here if here >= 0 else size):
            nodes[open_[-1]].parts.append(page[text : here if here >= 0 else size])
        if here < 0:
            break
        if after in ("!", "?"):
            end = page.find("-->", here + 4) if page.startswith("<!--", here) else page.find(">", here)
            at = size if end < 0 else end + (3 if page.startswith("<!--", here) else 1)
            continue
        m = _TAG.match(page, here)
        if not m:
            break
        at = m.end()
        closing, tag, attributes = m.groups()
        tag = tag.lower()
        if closing:
            for i in range(len(open_) - 1, 0, -1):
                if nodes[open_[i]].tag == tag:
                    del open_[i:]
                    break
                if nodes[open_[i]].tag in BLOCKS and tag not in BLOCKS:
                    break
            continue
        if tag in P_CLOSERS:
            for i in range(len(open_) - 1, 0, -1):
                name = nodes[open_[i]].tag
                if name == "p":
                    del open_[i:]
                if name in BLOCKS:
                    break
        if tag in IMPLIED:
            ends, stops = IMPLIED[tag]
            for i in range(len(open_) - 1, 0, -1):
                name = nodes[open_[i]].tag
                if name in stops:
                    break
                if name in ends:
                    del open_[i:]
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
        if tag == "br":
            nodes[open_[-1]].parts.append(" ")
            continue
        up = open_[-1]
        named, hidden = attributes_of(attributes) if attributes.strip() else ([], False)
        nodes.append(Node(tag, up, nodes[up].depth + 1, named, hidden, nodes[up].inside or nodes[up].tag == "article"))
        nodes[-1].formula = tag == "math" or nodes[up].formula and tag not in BLOCKS and tag not in RAW
        nodes[up].parts.append(len(nodes) - 1)
        if tag in VOID or tag not in BLOCKS and _SELF_CLOSED.search(attributes):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        open_.append(len(nodes) - 1)
    return nodes


FEATURES = 17


def features(nodes: list[Node]) -> np.ndarray:
    """A row for each element: subtree text and density, attribute tokens, depth and siblings."""
    n = len(nodes)
    own = np.zeros((n, 4))  # letters, words, stops, letters in links
    for i, node in enumerate(nodes):
        if node.tag in SILENT:
            continue
        text = " ".join(p for p in node.parts if type(p) is str)
        own[i, :3] = len(text), text.count(" "), text.count(".") + text.count(",")
    total, elements = own.copy(), np.array([1.0 - node.formula for node in nodes])
    for i in range(n - 1, 0, -1):
        if nodes[i].tag == "a":
            total[i, 3] = total[i, 0]
        total[nodes[i].parent] += total[i]
        elements[nodes[i].parent] += elements[i]
    rows = np.zeros((n, FEATURES))
    boiler, kids = np.zeros(n), np.zeros(n)
    for node in nodes[1:]:
        kids[node.parent] += not node.formula
    for i, node in enumerate(nodes):
        named = node.boilerplate + sum(t in BOILER_NAMES for t in node.names)
        boiler[i] = named + (boiler[node.parent] if i else 0)
        letters, words, stops, linked = total[i]
        around = total[node.parent] if i else total[i]
        rows[i] = (
            np.log1p(letters), np.log1p(words), stops / (words + 1), linked / (letters + 1), letters / max(1.0, elements[i]), np.log1p(elements[i]),
            node.depth, kids[i], kids[node.parent] if i else kids[0], (around[0] - letters) / (around[0] + 1), around[3] / (around[0] + 1),
            named, boiler[i], sum(t in MAIN_NAMES for t in node.names), node.tag in ("article", "main"),
            node.tag in ("p", "h1", "h2", "h3", "blockquote", "pre"), node.hidden,
        )
    return rows


def marks(nodes: list[Node], boiler: frozenset[str] = BOILER_NAMES, main: frozenset[str] = MAIN_NAMES) -> np.ndarray:
    """What the mark-up says: 1 article, 0 boilerplate, -1 neither."""
    out = np.full(len(nodes), -1)
    for i, node in enumerate(nodes):
        above = out[node.parent] if i else -1
        if above == 0 or node.hidden or node.tag in SILENT or node.boilerplate or any(t in boiler for t in node.names):
            out[i] = 0
        elif above == 1 or node.tag in ("article", "main", "html", "body") or any(t in main for t in node.names):
            out[i] = 1
    out[[i for i, node in enumerate(nodes) if node.formula]] = -1
    return out


@dataclass
class Trees:
    """Boosted regression trees as arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: list[int]
    weights: list[float]
    depth: int

    def chance(self, rows: np.ndarray) -> np.ndarray:
        margin, line = np.zeros(len(rows)), np.arange(len(rows))
        for root, weight in zip(self.roots, self.weights, strict=True):
            at = np.full(len(rows), root)
            for _ in range(self.depth):
                at = np.where(rows[line, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            margin += weight * self.value[at]
        return 1 / (1 + np.exp(-2 * margin))


def train(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> Trees:
    """Boosted trees of the elements of a bounded sample of pages and of the lessons."""
    spark = pages.sparkSession

    @F.pandas_udf("array<struct<label:double,x:array<double>>>")
    def labelled(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            nodes = parse(t)
            out.append([{"label": float(y), "x": x.tolist()} for x, y in zip(features(nodes), marks(nodes), strict=True) if y >= 0])
        return pd.Series(out)

    fit_for = pages.where(F.col(html_col).isNotNull() & (F.length(html_col) <= SAMPLE_CHARS)).select(F.col(html_col).alias("html"), F.xxhash64(id_col, html_col).alias("h"))
    sample = fit_for.orderBy("h").limit(SAMPLE_PAGES).select("html")
    rows = sample.select(F.explode(labelled("html")).alias("r")).select("r.label", "r.x").collect()
    points = [(r.label, Vectors.dense(r.x)) for r in rows]
    for lesson in (*LESSONS, *PLAIN_LESSONS):  # as heavy as a good part of the sample, however large that is
        nodes = parse(lesson)
        said = marks(nodes, frozenset("q"), frozenset("z")) if lesson in PLAIN_LESSONS else marks(nodes)
        own = [(float(y), Vectors.dense(x)) for x, y in zip(features(nodes), said, strict=True) if y >= 0]
        points += own * max(1, len(rows) // (10 * len(own)))
    model = GBTClassifier(labelCol="label", featuresCol="x", maxIter=TREES, maxDepth=DEPTH, seed=7, cacheNodeIds=False).fit(
        spark.createDataFrame(points, ["label", "x"]).coalesce(2)
    )
    cells: list[list[float]] = []

    def lay(node) -> int:
        here = len(cells)
        cells.append([0, 0.0, here, here, node.prediction()])
        if node.subtreeDepth():
            cells[here][:2] = [node.split().featureIndex(), node.split().threshold()]
            cells[here][2] = lay(node.leftChild())
            cells[here][3] = lay(node.rightChild())
        return here

    tops = [lay(t._java_obj.rootNode() if hasattr(t, "_java_obj") else t._call_java("rootNode")) for t in model.trees]
    columns = list(zip(*cells, strict=True))
    f, left, right = (np.array(columns[i], np.int64) for i in (0, 2, 3))
    return Trees(f, np.array(columns[1]), left, right, np.array(columns[4]), tops, list(model.treeWeights), DEPTH)


def decode(nodes: list[Node], chance: np.ndarray) -> np.ndarray:
    """Kept elements: the likeliest labelling in which a dropped element's descendants are dropped too."""
    p = np.clip(chance, 1e-6, 1 - 1e-6)
    p[[i for i, node in enumerate(nodes) if node.formula]] = 0.5  # says nothing of what it stands in
    keep, drop = np.log(p), np.log1p(-p)
    whole = drop.copy()  # everything below dropped
    best = keep.copy()  # this element kept, its children as is best for them
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        whole[up] += whole[i]
        best[up] += max(best[i], whole[i])
    kept = np.zeros(len(nodes), bool)
    for i, node in enumerate(nodes):
        kept[i] = i == 0 or kept[node.parent] and (node.formula or best[i] > whole[i]) and node.tag not in SILENT and not node.hidden
    return kept


def text_of(nodes: list[Node], kept: np.ndarray) -> str:
    """Blocks of the kept elements, white space made one space, joined by an empty line."""
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    stack: list[tuple[int, int]] = [(0, 0)]
    while stack:
        i, at = stack.pop()
        node = nodes[i]
        if at == 0 and node.tag in BLOCKS:
            close()
        while at < len(node.parts):
            part = node.parts[at]
            at += 1
            if type(part) is str:
                line.append(part)
            elif kept[part]:
                stack += [(i, at), (part, 0)]
                break
            elif nodes[part].tag in BLOCKS:
                close()
        else:
            if node.tag in BLOCKS:
                close()
    close()
    return "\n\n".join(blocks)


def extract(pages: DataFrame, trees: Trees, html_col: str = "html") -> DataFrame:
    """``pages`` with text and n_chars. Nothing is shuffled."""
    sent = pages.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("string")
    def main_text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            parsed = [parse(t) for t in texts]
            rows = [features(nodes) for nodes in parsed]
            chance = sent.value.chance(np.concatenate(rows)) if rows else np.zeros(0)
            out, at = [], 0
            for nodes in parsed:
                out.append(text_of(nodes, decode(nodes, chance[at : at + len(nodes)])))
                at += len(nodes)
            yield pd.Series(out, dtype=object)

    return pages.withColumn("text", main_text(F.col(html_col))).withColumn("n_chars", F.length("text").cast("long"))


def main_texts(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    settle(pages.sparkSession)
    return extract(pages, train(pages, html_col, id_col), html_col)
