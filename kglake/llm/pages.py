"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page is read into a tree of elements. Each element has features of its subtree (text, links, punctuation), of
its attribute tokens and those of its ancestors, of its depth and of its siblings. Gradient-boosted trees give
its probability of lying in the article. Decoding then picks the best labelling in which every path
from the root runs through page frame, article and clutter in this order: nothing below clutter is article,
and the article is whole below its top but for clutter in it.

The trees are fitted by Spark on pages that are made here from page patterns of many kinds, a fixed number of them;
no supplied page is needed for that. Every page is then read, scored and decoded in one pass.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRAINING_PAGES = 1000
BOOSTING_ROUNDS = 25
TREE_DEPTH = 5
PAGES_AT_ONCE = 256
# Log-odds lost where a child's label differs from its parent's.
SWITCH_COST = 1.75
# How training pages carry labels. Other values are those of some page's own attribute.
LABEL, LABELS = "data-kglake-label", ("0", "1")

TAG = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
TOKEN = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style noscript template iframe object svg math canvas audio video textarea select".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup"
    " time tt u var wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
TAGS = ("article main section div p h1 h2 h3 ul ol li a nav header footer aside form table td blockquote pre figure"
        " figcaption button span b body dl").split()
WORDS = {
    "body": "article post entry content story body text main prose page detail copy read blog paragraph",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs crumbs pagination pager tabs links toc skip",
    "edge": "header masthead banner topbar branding logo footer foot bottom copyright legal colophon top site",
    "side": "sidebar side aside rail widget related recommended recommend popular trending more teaser promo also",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promoted affiliate dfp outbrain taboola commercial",
    "notice": "cookie consent gdpr notice alert popup modal overlay toast dialog warning message disclaimer",
    "form": "form newsletter subscribe subscription signup login search contact register input field donate",
    "comment": "comment comments commentlist reply replies respond discussion disqus feedback reader thread response",
    "share": "share social sharing follow facebook twitter tweet like buttons toolbar tools tags meta byline author",
}
GROUP_OF = {word: k for k, words in enumerate(WORDS.values()) for word in words.split()}
GROUPS = len(WORDS)
# Element names that speak as clearly as attribute tokens.
TAG_GROUPS = {tag: (GROUP_OF[word],) for tag, word in {
    "article": "article", "main": "main", "nav": "nav", "header": "header", "footer": "footer", "aside": "aside",
    "form": "form"}.items()}


class Node:
    __slots__ = ("tag", "parent", "depth", "groups", "label", "order")

    def __init__(self, tag: str, parent: int, depth: int, groups: tuple[int, ...], label: int, order: int):
        self.tag, self.parent, self.depth, self.groups, self.label, self.order = tag, parent, depth, groups, label, order


def read_page(source: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements in page order and the text in them, `(element, text)`; a text of None marks the edge of a block."""
    nodes = [Node("#root", -1, 0, (), 0, 0)]
    texts: list[tuple[int, str]] = []
    stack, unseen, at, source = [0], 0, 0, source or ""

    def text(piece: str) -> None:
        if piece and not unseen:
            texts.append((stack[-1], html.unescape(piece) if "&" in piece else piece))

    def edge(tag: str) -> None:
        if tag not in INLINE and not unseen:
            texts.append((stack[-1], None))

    def close(position: int) -> None:
        nonlocal unseen
        for k in stack[position:]:
            unseen -= nodes[k].tag in UNSEEN
            edge(nodes[k].tag)
        del stack[position:]

    while True:
        match = TAG.search(source, at)
        if match is None:
            text(source[at:])
            break
        text(source[at:match.start()])
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if match["close"]:
            for position in range(len(stack) - 1, 0, -1):
                if nodes[stack[position]].tag == tag:
                    close(position)
                    break
            continue
        if tag == "br" or tag in VOID:
            edge("br")
            continue
        if tag == "body":
            for position in range(1, len(stack)):
                if nodes[stack[position]].tag == "head":
                    close(position)
                    break
        if tag not in INLINE:
            if tag not in ("li", "dt", "dd", "tr", "td", "th", "option"):
                closing, scope = {"p"}, {"button", "td", "th", "li", "div", "section", "article", "body"}
            else:
                closing, scope = CLOSES[tag], SCOPES.get(tag, set())
            for position in range(len(stack) - 1, 0, -1):
                name = nodes[stack[position]].tag
                if name in closing:
                    close(position)
                    break
                if name in scope or name not in INLINE and name != "p" and closing == {"p"}:
                    break
        edge(tag)
        groups, label = TAG_GROUPS.get(tag, ()), 0
        attributes = match["attributes"]
        if attributes and not attributes.isspace():
            found = []
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id", "role", "itemprop", "aria-label"):
                    found += [GROUP_OF[t] for t in map(str.lower, TOKEN.findall(a or b or c)) if t in GROUP_OF]
                elif name == LABEL and a in LABELS:
                    label = int(a)
            groups += tuple(found)
        nodes.append(Node(tag, stack[-1], nodes[stack[-1]].depth + 1, groups, label, len(texts)))
        stack.append(len(nodes) - 1)
        unseen += tag in UNSEEN
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(source, at)
            at = end.start() if end else len(source)
    return nodes, texts


TAG_AT = {tag: k for k, tag in enumerate(TAGS)}
N_FEATURES = len(TAGS) + 3 * GROUPS + 15
PUNCTUATION = re.compile(r"[.,;:!?]")


def features(nodes: list[Node], texts: list[tuple[int, str]]) -> np.ndarray:
    """One row per element."""
    n = len(nodes)
    parent = np.array([max(0, x.parent) for x in nodes])
    depth = np.array([x.depth for x in nodes], float)
    own = np.zeros((n, 4))  # characters, words, punctuation, pieces
    for k, piece in texts:
        if piece and not piece.isspace():
            own[k] += (len(piece), piece.count(" ") + 1, len(PUNCTUATION.findall(piece)), 1)
    tag = np.array([TAG_AT.get(x.tag, -1) for x in nodes])
    linked = own[:, 0] * 0
    is_link = np.zeros(n, bool)
    for k in range(1, n):
        is_link[k] = nodes[k].tag == "a" or is_link[parent[k]]
    linked = np.where(is_link, own[:, 0], 0.0)
    ones = np.ones(n)
    sums = np.column_stack([own, linked, ones, tag == TAG_AT["p"], tag == TAG_AT["a"], tag == TAG_AT["li"]])
    for k in range(n - 1, 0, -1):
        sums[parent[k]] += sums[k]
    groups = np.zeros((n, GROUPS))
    for k, x in enumerate(nodes):
        for g in x.groups:
            groups[k, g] = 1
    above = np.zeros((n, GROUPS))
    below = groups.copy()
    for k in range(1, n):
        above[k] = np.maximum(above[parent[k]], groups[parent[k]])
    for k in range(n - 1, 0, -1):
        np.maximum(below[parent[k]], below[k], out=below[parent[k]])
    chars = sums[:, 0]
    siblings = np.bincount(parent[1:], minlength=n)[parent]
    sibling_chars = (np.bincount(parent[1:], chars[1:], n) if n > 1 else np.zeros(n))[parent]
    total = max(1.0, chars[0])
    rows = np.zeros((n, N_FEATURES))
    known = tag >= 0
    rows[np.flatnonzero(known), tag[known]] = 1
    rows[:, len(TAGS):len(TAGS) + GROUPS] = groups
    rows[:, len(TAGS) + GROUPS:len(TAGS) + 2 * GROUPS] = above
    rows[:, len(TAGS) + 2 * GROUPS:len(TAGS) + 3 * GROUPS] = below
    rows[:, len(TAGS) + 3 * GROUPS:] = np.column_stack([
        np.log1p(chars), chars / total, sums[:, 4] / np.maximum(1, chars), chars / np.maximum(1, sums[:, 5]),
        sums[:, 2] / np.maximum(1, sums[:, 1]), np.log1p(own[:, 0]), np.log1p(sums[:, 6]), np.log1p(sums[:, 7]),
        np.log1p(sums[:, 8]), depth, np.log1p(siblings), chars / np.maximum(1, sibling_chars),
        tag[parent] == TAG_AT["article"], np.array([x.order for x in nodes]) / max(1, len(texts)),
        np.isin(tag, (TAG_AT["nav"], TAG_AT["footer"], TAG_AT["aside"], TAG_AT["form"]))])
    return rows


def decode(nodes: list[Node], p: np.ndarray) -> np.ndarray:
    """Whether each element is article in the best labelling frame, article, clutter along every path."""
    n = len(nodes)
    odds = np.log(p) - np.log1p(-p)
    gain = np.zeros((n, 3))  # frame, article, clutter
    gain[:, 1] = odds
    choice = np.zeros((n, 3), np.int8)
    for k in range(n - 1, 0, -1):
        frame, article, clutter = gain[k]
        up = gain[nodes[k].parent]
        options = (frame, article - SWITCH_COST, clutter - SWITCH_COST)
        choice[k, 0] = best = max((0, 2, 1), key=lambda s: (options[s], s == 0))
        up[0] += options[best]
        choice[k, 1] = best = 1 if article >= clutter - SWITCH_COST else 2
        up[1] += article if best == 1 else clutter - SWITCH_COST
        choice[k, 2] = 2
        up[2] += clutter
    state = np.zeros(n, np.int8)
    for k in range(1, n):
        state[k] = choice[k, state[nodes[k].parent]]
    return state == 1


def text_of(texts: list[tuple[int, str]], kept: np.ndarray) -> str:
    """The kept text: white space within blocks as one space, blocks joined by one space."""
    return " ".join("".join([" " if piece is None else piece for k, piece in texts if kept[k] or piece is None]).split())


# Page patterns for training.

SYLLABLES = "an be con do el fa go hi in ja ko le mo na or pe qui re sa ti un ve wo xa zu".split()
ROLES = {
    "menu": (["nav", "ul", "div", "header"], ["nav", "menu", "main-menu", "navbar", "breadcrumb", "site-nav", "pagination"]),
    "header": (["header", "div"], ["header", "masthead", "site-header", "topbar", "page-header", "banner"]),
    "footer": (["footer", "div"], ["footer", "site-footer", "bottom", "copyright", "colophon", "legal"]),
    "sidebar": (["aside", "div", "section"], ["sidebar", "widget", "related-posts", "rail", "popular", "trending", "also-read"]),
    "notice": (["div", "section"], ["cookie-notice", "gdpr-consent", "alert", "popup", "modal", "site-notice", "message"]),
    "advert": (["div", "aside", "section", "p"], ["ad", "ads", "advert", "sponsored", "ad-slot", "promoted", "adBox", "banner-ad"]),
    "form": (["form", "div"], ["newsletter", "subscribe-box", "search-form", "login", "signup", "contact-form"]),
    "comments": (["section", "div", "ul", "ol"], ["comments", "comment-list", "discussion", "replies", "disqus_thread", "reader-comments"]),
    "share": (["div", "ul"], ["share", "social-links", "sharing", "follow-us", "post-tags"]),
}
BODY_NAMES = ["content", "article-body", "post-content", "entry-content", "story", "main-text", "postBody", "article", "prose", ""]


def training_page(seed: int) -> str:
    """A page of random make-up whose elements carry their label as `LABEL`."""
    r = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def sentence(high: int = 18) -> str:
        return words(3, high).capitalize() + r.choice([".", ".", ".", "!", "?", ",", "", "&amp;!!"])

    def prose(low: int, high: int) -> str:
        return " ".join(sentence() for _ in range(r.randint(low, high)))

    def element(tag: str, inner: str, label: int, name: str = "") -> str:
        attribute = f' {r.choice(["class", "class", "id"])}="{name}"' if name else ""
        return f'<{tag}{attribute} {LABEL}="{label}">{inner}' + ("" if tag == "p" and r.random() < 0.2 else f"</{tag}>")

    def links(n: int) -> str:
        return "".join(element(r.choice(["li", "li", "div"]), element("a", words(1, 4), 0), 0) for _ in range(n))

    def clutter(role: str) -> str:
        tags, names = ROLES[role]
        tag = r.choice(tags)
        name = r.choice(names) if tag in ("div", "ul", "ol", "section", "p") or r.random() < 0.5 else ""
        if role in ("menu", "share"):
            inner = links(r.randint(2, 9))
            inner = inner if tag == "ul" else element("ul", inner, 0)
        elif role == "sidebar":
            inner = element("h3", words(1, 3), 0) + (element("ul", links(r.randint(2, 8)), 0) if r.random() < 0.6
                                                     else "".join(element("p", prose(1, 3), 0) for _ in range(r.randint(1, 3))))
        elif role == "form":
            inner = element("label", words(1, 5), 0) + '<input name="q">' + element("button", words(1, 2), 0) + (
                element("p", prose(1, 2), 0) if r.random() < 0.5 else "")
        elif role == "comments":
            inner = element("h3", words(1, 3), 0) + "".join(
                element(r.choice(["li", "div", "article"]), element("b", words(1, 2), 0) + element("p", prose(1, 4), 0), 0,
                        r.choice(["comment", "comment-body", "reply"])) for _ in range(r.randint(1, 6)))
        elif role == "header":
            inner = element(r.choice(["div", "a", "p"]), words(1, 4), 0) + (element("ul", links(r.randint(2, 5)), 0) if r.random() < 0.4 else "")
        else:
            inner = prose(1, 2) if r.random() < 0.5 else element("p", prose(1, 3), 0)
            inner += "&copy; &middot; " if role == "footer" else ""
        return element(tag, inner, 0, name)

    def block() -> str:
        kind = r.random()
        if kind < 0.66:
            return element("p", (element("b", prose(1, 2), 1) + "<br>" + prose(0, 4)) if r.random() < 0.3 else prose(1, 7), 1)
        if kind < 0.76:
            return element(r.choice(["h2", "h3"]), words(1, 8), 1)
        if kind < 0.86:
            return element(r.choice(["ul", "ol"]), "".join(element("li", sentence(9), 1) for _ in range(r.randint(2, 6))), 1)
        if kind < 0.92:
            return element("blockquote", element("p", prose(1, 3), 1), 1)
        return element("p", prose(1, 3) + element("a", words(1, 5), 1) + " " + prose(1, 2), 1)

    blocks = [block() for _ in range(r.choice([1, 1, 2, 3, 5, 8, 13, 21]))]
    for role in r.sample(["advert", "form", "sidebar", "share", "notice", "comments"], r.choice([0, 0, 1, 1, 2, 3])):
        blocks.insert(r.randint(1, len(blocks)) if role not in ("comments", "share") else len(blocks), clutter(role))
    title = element("h1", words(2, 10), 1)
    inner = (element("header", title, 1) if r.random() < 0.15 else title if r.random() < 0.85 else "") + "".join(blocks)
    if r.random() < 0.3:
        inner = element("div", inner, 1, r.choice(BODY_NAMES))
    semantic = r.random() < 0.5
    article = element("article" if semantic else r.choice(["div", "main", "section", "td"]), inner, 1,
                      "" if semantic and r.random() < 0.6 else r.choice(BODY_NAMES))
    before = [clutter(x) for x in r.sample(["header", "menu", "notice", "advert", "form", "menu"], r.randint(0, 4))]
    after = [clutter(x) for x in r.sample(["footer", "sidebar", "comments", "share", "form", "advert", "notice"], r.randint(0, 5))]
    body = "".join(before) + (element(r.choice(["div", "main"]), article + (clutter("sidebar") if r.random() < 0.4 else ""), 0,
                              r.choice(["wrapper", "container", "page", "layout", "site"])) if r.random() < 0.5 else article) + "".join(after)
    return f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body>{body}</body></html>"


def fit_trees(spark: SparkSession, training_pages: int = TRAINING_PAGES) -> list[tuple[float, list[tuple]]]:
    """Boosted trees fitted by Spark on `training_pages` made pages: `(weight, nodes)` with nodes
    `(feature, threshold, left, right, value)`, feature -1 at leaves."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seed in batch.column(0).to_pylist():
                nodes, texts = read_page(training_page(seed))
                seen = np.array([k for k, x in enumerate(nodes) if k and x.tag not in UNSEEN and x.tag != "html"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(features(nodes, texts)[seen].tolist(), pa.list_(pa.float64())),
                     pa.array([float(nodes[k].label) for k in seen])], names=["x", "label"])

    made = spark.range(0, training_pages, 1, 4).mapInArrow(rows, "x array<double>, label double")
    made = made.select(array_to_vector("x").alias("features"), "label").coalesce(2)
    fitted = GBTClassifier(maxIter=BOOSTING_ROUNDS, maxDepth=TREE_DEPTH, stepSize=0.3, maxBins=32, seed=5).fit(made)
    return [(w, _tree(tree.toDebugString)) for w, tree in zip(fitted.treeWeights, fitted.trees)]


def _tree(described: str) -> list[tuple]:
    """A fitted tree as rows, from Spark's description of it."""
    lines = [line.strip() for line in described.split("\n")[1:] if line.strip()]
    nodes: list[tuple] = []

    def build(at: int) -> int:
        me = len(nodes)
        nodes.append(())
        line = lines[at]
        if line.startswith("Predict:"):
            nodes[me] = (-1, 0.0, 0, 0, float(line.split(":")[1]))
            return at + 1
        feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        left = len(nodes)
        at = build(at + 1)
        right = len(nodes)
        at = build(at + 1)
        nodes[me] = (int(feature), float(threshold), left, right, 0.0)
        return at

    build(0)
    return nodes


def predict(trees: list[tuple[float, list[tuple]]], x: np.ndarray) -> np.ndarray:
    """Probability of being article for each row of features."""
    score = np.zeros(len(x))
    for weight, nodes in trees:
        feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
        at = np.zeros(len(x), np.int64)
        for _ in range(TREE_DEPTH):
            f = feature[at]
            go = x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at]
            at = np.where(f < 0, at, np.where(go, left[at], right[at]))
        score += weight * value[at]
    return np.clip(1 / (1 + np.exp(-2 * score)), 1e-4, 1 - 1e-4)


def extract(sources: list[str | None], trees: list[tuple[float, list[tuple]]]) -> list[str]:
    """Main texts of pages."""
    pages = [read_page(source) for source in sources]
    rows = [features(nodes, texts) for nodes, texts in pages]
    p = predict(trees, np.concatenate(rows)) if rows else np.empty(0)
    out, at = [], 0
    for (nodes, texts), x in zip(pages, rows):
        out.append(text_of(texts, decode(nodes, p[at:at + len(x)])))
        at += len(x)
    return out


def main_texts(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> DataFrame:
    """`page_id, url, text, n_chars` of each row of `pages` (`page_id, url, html`), read whole.

    Null and empty html have an empty text; repeated rows are treated alike; other columns are ignored.
    """
    trees = fit_trees(pages.sparkSession, training_pages)
    model = pages.sparkSession.sparkContext.broadcast(trees)  # bounded by rounds and depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                texts = extract(part.column(2).to_pylist(), model.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
