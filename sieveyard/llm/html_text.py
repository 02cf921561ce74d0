"""Main text of web pages: a tree-structured graphical model over DOM nodes, read by sum-product messages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_type
from .html_pages import labelled_page

# What HTML itself fixes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp template noscript".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: An opening tag ends these open elements.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody"), "body": ("head",),
}
#: Beyond these an opening tag ends nothing.
SCOPE = frozenset("ul ol dl table select html body td th div section article main aside nav header footer form blockquote".split())

_OPEN = re.compile(r"<(?:!--|[a-zA-Z/!?])")
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"""(?:[^>"'=]|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile("[a-z]+")


@dataclass
class Page:
    """Block elements in page order, each with its parent, and the text blocks with their elements."""

    tags: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    marks: list[int | None] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # element, text, characters inside links


def parse(html: str, marked: bool = False) -> Page:
    """Read a page of any quality in linear time; scripts, styles, comments and the like leave no text.

    Inline elements belong to the block element around them. Text runs end at block borders and line breaks.
    """
    page = Page()

    def element(tag: str, parent: int, attributes: str) -> int:
        page.tags.append(tag)
        own = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
        page.names.append(" ".join(own.get(k, "") for k in ("class", "id", "role")))
        page.parents.append(parent)
        page.marks.append(int(own["data-y"]) if marked and "data-y" in own else None)
        return len(page.tags) - 1

    stack: list[tuple[str, int]] = [("#", element("#", -1, ""))]
    open_tags: dict[str, int] = {}
    run: list[str] = []
    linked = 0
    plain_tags = False

    def flush() -> None:
        nonlocal linked
        if run:
            text = _SPACE.sub(" ", "".join(run)).strip()
            if text:
                page.blocks.append((stack[-1][1], text, linked))
            run.clear()
            linked = 0

    def pop() -> None:
        tag, _ = stack.pop()
        open_tags[tag] -= 1

    at, size = 0, len(html)
    while at < size:
        m = _OPEN.search(html, at)
        end = m.start() if m else size
        if end > at:
            text = html[at:end]
            text = unescape(text) if "&" in text else text
            run.append(text)
            if open_tags.get("a"):
                linked += len(text)
        if not m:
            break
        if html.startswith("<!--", end):
            close = html.find("-->", end + 4)
            at = size if close < 0 else close + 3
            continue
        name = _NAME.match(html, end + 1)
        if not name:  # a declaration, or </ before no name
            close = html.find(">", end)
            at = size if close < 0 else close + 1
            continue
        tail = None if plain_tags else _QUOTED.match(html, name.end())
        if tail:
            at = tail.end()
        else:  # a quote that never ends: from here on tags end at the next >
            plain_tags = True
            close = html.find(">", name.end())
            at = size if close < 0 else close + 1
        tag = name[1].lower()
        if html[end + 1] == "/":
            if tag in VOID and tag != "br" or not open_tags.get(tag):
                if tag in ("br", "p"):
                    flush()
                continue
            if tag not in INLINE:
                flush()
            elif any(t not in INLINE for t, _ in stack[len(stack) - _depth(stack, tag) :]):
                continue  # an inline end tag does not end the blocks opened since
            while stack[-1][0] != tag:
                pop()
            pop()
            continue
        attributes = html[name.end() : at - 1]
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = close.start() if close else size
            if close and (after := html.find(">", at)) >= 0:
                at = after + 1
            elif close:
                at = size
            if tag not in INLINE:
                flush()
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        if tag not in INLINE:
            flush()
            if open_tags.get("p"):  # a block ends an open paragraph and what it holds
                depth = _depth(stack, "p")
                if not any(t in SCOPE for t, _ in stack[len(stack) - depth :]):
                    for _ in range(depth + 1):
                        pop()
            if tag in CLOSES:
                _end_all(stack, CLOSES[tag], pop)
        parent = stack[-1][1]
        stack.append((tag, parent if tag in INLINE else element(tag, parent, attributes)))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    return page


def _depth(stack: list[tuple[str, int]], tag: str) -> int:
    """How many elements are open inside the innermost open one of that tag."""
    n = 0
    while stack[-1 - n][0] != tag:
        n += 1
    return n


def _end_all(stack: list[tuple[str, int]], tags: tuple[str, ...], pop) -> None:
    """End the outermost open element of these tags within the current list, table or box, and all it holds."""
    last, i = 0, len(stack) - 1
    while i > 0 and (stack[i][0] in tags or stack[i][0] not in SCOPE):
        if stack[i][0] in tags:
            last = i
        i -= 1
    if last:
        while len(stack) > last:
            pop()


#: Tags by kind, and words of classes and ids: what the model may read (fixed values).
TAG_KINDS = (
    ("p",), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("li",), ("ul", "ol", "dl"), ("div",), ("section",), ("article", "main"), ("nav", "menu"), ("header", "hgroup"), ("footer",), ("aside",),
    ("form", "button", "select", "option", "fieldset", "legend", "dialog"), ("table", "tr", "td", "th", "tbody", "thead"), ("blockquote", "pre", "figure", "figcaption", "dd", "dt"), ("body", "html", "#"),
)
WORD_KINDS = (
    "menu nav navbar topnav breadcrumb breadcrumbs pagination tabs navigation", "header masthead branding logo top", "footer foot bottom copyright legal colophon",
    "sidebar side related widget recommended trending popular tags toc author aside most read more", "ad ads advert advertisement banner promo sponsored sponsor adbox",
    "notice cookie consent gdpr alert popup modal newsletter subscribe paywall login signup search", "comment comments responses replies reply discussion disqus respond",
    "share social sharing follow buttons", "content article post entry story main text body",
)
_TAG_OF = {t: i for i, kind in enumerate(TAG_KINDS) for t in kind}
_WORD_OF = {w: i for i, kind in enumerate(WORD_KINDS) for w in kind.split()}
N_TAGS, N_WORDS = len(TAG_KINDS) + 1, len(WORD_KINDS)
N_OWN = N_TAGS + N_WORDS + 12
N_FEATURES = 2 * N_OWN


def node_features(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """(features, edge kind of the link to the parent) of each element."""
    n = len(page.tags)
    x = np.zeros((n, N_OWN))
    kind = np.array([_TAG_OF.get(t, N_TAGS - 1) for t in page.tags])
    x[np.arange(n), kind] = 1
    for i, name in enumerate(page.names):
        if name:
            for w in _WORDS.findall(name.lower()):
                if w in _WORD_OF:
                    x[i, N_TAGS + _WORD_OF[w]] = 1
    own, links, stops = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, text, linked in page.blocks:
        own[i] += len(text)
        links[i] += min(linked, len(text))
        stops[i] += text.count(". ") + (text[-1] in ".!?:")
    all_text, all_links = own.copy(), links.copy()
    parents = np.array(page.parents)
    for i in range(n - 1, 0, -1):  # children stand after their parents
        all_text[parents[i]] += all_text[i]
        all_links[parents[i]] += all_links[i]
    total = max(all_text[0], 1)
    named = x[:, N_TAGS : N_TAGS + N_WORDS - 1].any(axis=1)
    b = N_TAGS + N_WORDS
    x[:, b] = 1
    x[:, b + 1] = np.log1p(own) / 5
    x[:, b + 2] = links / np.maximum(own, 1)
    x[:, b + 3] = all_links / np.maximum(all_text, 1)
    x[:, b + 4] = all_text / total
    x[:, b + 5] = np.minimum(stops, 5) / 5
    x[:, b + 6] = (own > 0) & (own < 40)
    x[:, b + 7] = own > 200
    x[:, b + 8] = np.arange(n) / n
    x[:, b + 9] = own == 0
    x[:, b + 10] = named
    x[:, b + 11] = (all_text > 0) & (stops == 0) & (own > 0)
    # Pages without any element that calls itself an article have weights and potentials of their own. Else an
    # edge's potential depends on the child's tag, on whether its name says that it is something else, and on whether the parent is an article.
    article = ((x[:, _TAG_OF["article"]] > 0) | (x[:, b - 1] > 0)) & ~named
    bare = not article.any()
    group = np.full(n, 2) if bare else (article[np.maximum(parents, 0)] & (parents >= 0)).astype(int)
    return np.concatenate([x * (not bare), x * bare], axis=1), (kind * 2 + named) * 3 + group


N_EDGES = 6 * N_TAGS


@dataclass(frozen=True)
class Model:
    """Node weights for "main text", and for each edge kind the log potentials of (parent, child) states."""

    node: np.ndarray
    edge: np.ndarray


class Forest:
    """Pages side by side, with their elements by depth: one array operation a level passes all messages of it."""

    def __init__(self, pages: list[Page]) -> None:
        parts = [node_features(p) for p in pages]
        sizes = [len(p.tags) for p in pages]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.x = np.concatenate([p[0] for p in parts])
        self.kind = np.concatenate([p[1] for p in parts])
        self.parent = np.concatenate([np.where((own := np.array(p.parents)) < 0, -1, own + s) for p, s in zip(pages, self.starts, strict=False)])
        depth = np.zeros(len(self.parent), int)
        for i in range(len(depth)):
            if self.parent[i] >= 0:
                depth[i] = depth[self.parent[i]] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)[1:]

    def marginals(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Sum-product in log space: (P(main text) of each element, P(parent's, own state) of each edge)."""
        n = len(self.parent)
        unary = np.zeros((n, 2))
        unary[:, 1] = self.x @ model.node
        up = unary.copy()  # what an element and all below it say about its state
        message = np.zeros((n, 2))
        edge = model.edge[self.kind]  # (n, parent state, own state)
        for level in self.levels[::-1]:
            message[level] = np.logaddexp(edge[level, :, 0] + up[level, None, 0], edge[level, :, 1] + up[level, None, 1])
            np.add.at(up, self.parent[level], message[level])
        down = np.zeros((n, 2))  # what all the rest says
        pair = np.zeros((n, 2, 2))
        for level in self.levels:
            p = self.parent[level]
            rest = up[p] + down[p] - message[level]
            both = edge[level] + rest[:, :, None]
            down[level] = np.logaddexp(both[:, 0], both[:, 1])
            joint = both + up[level][:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            pair[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
        belief = up + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), pair


def states(page: Page) -> np.ndarray:
    """The states that marks give: an element without one has its parent's."""
    y = np.zeros(len(page.tags), int)
    for i, (p, m) in enumerate(zip(page.parents, page.marks, strict=True)):
        y[i] = m if m is not None else (y[p] if p >= 0 else 0)
    return y


def train(pages: list[str], steps: int = 250, rate: float = 0.15, decay: float = 2e-4) -> Model:
    """Maximum likelihood on labelled pages: gradients are observed less expected counts, from exact marginals."""
    parsed = [parse(p, marked=True) for p in pages]
    forest, y = Forest(parsed), np.concatenate([states(p) for p in parsed])
    child = forest.parent >= 0
    seen_pair = np.zeros((len(y), 2, 2))
    seen_pair[np.flatnonzero(child), y[forest.parent[child]], y[child]] = 1
    theta = [np.zeros(N_FEATURES), np.zeros((N_EDGES, 2, 2))]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        p, pair = forest.marginals(Model(*theta))
        edge = np.zeros_like(theta[1])
        np.add.at(edge, forest.kind[child], (seen_pair - pair)[child])
        for i, gradient in enumerate((forest.x.T @ (y - p) / len(y), edge / len(y))):
            gradient = gradient - decay * theta[i]
            first[i] = 0.9 * first[i] + 0.1 * gradient
            second[i] = 0.999 * second[i] + 0.001 * gradient**2
            theta[i] = theta[i] + rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Model(*theta)


@lru_cache(maxsize=2)
def trained(n_pages: int = 600, seed: int = 1) -> Model:
    """The model trained on n_pages built pages: the bound of its sample, whatever the size of the input."""
    return train([labelled_page(seed * 100_003 + i) for i in range(n_pages)])


def main_texts(htmls: list[str | None], model: Model, threshold: float = 0.5) -> list[str]:
    pages = [parse(h or "") for h in htmls]
    if not pages:
        return []
    forest = Forest(pages)
    p, _ = forest.marginals(model)
    return [" ".join(text for i, text, _ in page.blocks if p[s + i] >= threshold) for page, s in zip(pages, forest.starts, strict=False)]


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", n_training: int = 600, batch_rows: int = 64) -> DataFrame:
    """The main text of every whole page: id_col, url_col, text.

    Block elements of a page form a tree. Each is main text or not; weights on its tag, name, text and
    links, and potentials on each link from parent to child, give a joint distribution whose marginals one
    pass of messages up and one down computes exactly. Blocks whose element is main text with probability
    0.5 or more are joined by a space, in page order; character references are decoded and white
    space in a block becomes one space. Scripts, styles, titles and comments never count.

    Null and empty pages have an empty text; broken markup is read as far as it goes. Repeated rows are
    kept. An empty table gives an empty result. Other columns are ignored, whatever their names. The model
    is trained on the driver from n_training built pages and goes along with the tasks: a few kilobytes.
    """
    model = trained(n_training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(at, batch_rows)
                texts = main_texts(batch.column(2).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["__id", "__url", "text"])

    own = pages.select(F.col(id_col).alias("__id"), F.col(url_col).cast("string").alias("__url"), F.col(html_col).cast("string").alias("__html"))
    out = own.mapInArrow(run, row_type(__id=own.schema[0].dataType, __url="string", text="string"))
    return out.select(F.col("__id").alias(id_col), F.col("__url").alias(url_col), "text")
