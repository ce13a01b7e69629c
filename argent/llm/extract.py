"""Main text of web pages: boosted trees over DOM nodes, decoded by hierarchy.

A page is parsed to its block elements (inline mark-up belongs to the block
around it). Each block gets features of its subtree (text, link and tag
density, punctuation), of its attributes' tokens, its depth, its place and its
siblings. Gradient-boosted trees (Spark ML) give each block a margin for being
main text. A dynamic programme over the tree then picks for every block one of
*content* (all below is content), *clutter* (all below is clutter) or *mixed*
(its children choose), so no choice contradicts one above or below it.

There are no labelled pages, so the trees are trained on a bounded sample of
the table's own pages whose mark-up names the article (``article``, ``main``),
and on variants of them: the naming element is renamed, and clutter of stated
kinds (headers, menus, sidebars, notices, adverts, forms, comments) is put
around and into it. Where no page names its article, stated margins by tag and
attribute decide.

Defined results: NULL, empty or mark-up-free html (text outside any element
counts as a block of the page) never fails; a page without main text gives the
empty text; repeated rows and ids are rows of their own; pages of any length
are read whole; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from argent.llm.common import landed, ship, table

#: The element that names an article.
NAMED = r"<(article|main)\b[^>]*>"
#: Pages that the trees are trained on, at most, and variants made of each.
TRAIN_PAGES = 300
VARIANTS = 3
TREES, DEPTH = 20, 4
#: What a mixed block costs, so that clean subtrees stay whole.
MIXED = 0.5

# Fixed values of HTML: element kinds.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
NEVER = frozenset("head script style noscript template iframe svg title textarea form button select option input "
                  "object embed canvas audio video".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
               "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table body article section div".split())

# Tokens of class, id and role that name main text or clutter.
TOKENS = {
    "main": "article body content entry main post story text".split(),
    "menu": "breadcrumb breadcrumbs menu nav navbar navigation pagination tabs toolbar".split(),
    "frame": "banner footer header masthead topbar copyright legal".split(),
    "side": "aside related recommended rail sidebar widget".split(),
    "advert": "ad ads advert advertisement promo sponsor sponsored".split(),
    "notice": "alert consent cookie gdpr modal notice overlay popup".split(),
    "form": "form login newsletter search signup subscribe".split(),
    "comment": "comment comments discussion disqus replies reply respond".split(),
    "share": "share sharing social tags".split(),
}
KINDS = list(TOKENS)
_KIND = {w: k for k, words in TOKENS.items() for w in words}
TAG_KIND = {"nav": "menu", "menu": "menu", "header": "frame", "footer": "frame", "aside": "side", "form": "form",
            "article": "main", "main": "main", "dialog": "notice"}
_GROUPS = ("p", "heading", "list", "item", "div", "section", "table", "quote")
_GROUP = {"p": 0, **{h: 1 for h in HEADINGS}, "ul": 2, "ol": 2, "dl": 2, "li": 3, "dt": 3, "dd": 3, "div": 4,
          "section": 5, "article": 5, "main": 5, "table": 6, "tr": 6, "td": 6, "th": 6, "tbody": 6,
          "blockquote": 7, "pre": 7, "figure": 7, "figcaption": 7}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_STOPS = re.compile(r"[.,;:!?]")


class Block:
    __slots__ = ("tag", "parent", "depth", "kinds", "above", "text", "pieces", "children", "links", "link", "tags",
                 "stops", "chars", "start", "truth", "never")

    def __init__(self, tag: str, parent: Block | None, kinds: frozenset, start: int, truth):
        self.tag, self.parent, self.kinds, self.start = tag, parent, kinds, start
        self.depth = parent.depth + 1 if parent else 0
        self.above = parent.above | parent.kinds if parent else frozenset()
        self.never = tag in NEVER or bool(parent and parent.never)
        self.truth = truth if truth is not None else (parent.truth if parent else None)
        self.pieces: list = []  # own text and child blocks, in page order
        self.children: list[Block] = []
        self.chars = self.links = self.tags = self.stops = 0


def parse(html: str, mark: str | None = None) -> list[Block]:
    """Block elements in page order, the page itself first. ``mark`` is the
    attribute by which a training page tells its truth; no other page has one.

    Linear in the page: no tag is looked for beyond the last ``>``, and an end
    tag looks down the stack only if its element is open."""
    root = Block("#page", None, frozenset(), 0, None)
    blocks, stack = [root], [root]  # the stack holds blocks; inline elements only count
    opened: Counter = Counter()  # tags on the stack
    link, at, seen, pos, size = 0, root, 0, 0, len(html)
    last = html.rfind(">") + 1
    truth_of = re.compile(rf'{mark}="([01])"') if mark else None

    def text(piece: str) -> None:
        nonlocal seen
        n = len(piece) - piece.count(" ")
        at.pieces.append(piece)
        if n and not at.never:
            at.chars += n
            at.stops += len(_STOPS.findall(piece))
            if link:
                at.links += n
            seen += n

    def close(k: int) -> Block:
        """Take the stack's elements from the k-th on off it."""
        opened.subtract(b.tag for b in stack[k:])
        del stack[k:]
        return stack[-1]

    while pos < size:
        m = _TAG.search(html, pos, last)
        if m is None:
            text(unescape(html[pos:].split("<!--", 1)[0]))
            break
        if m.start() > pos:
            text(unescape(html[pos:m.start()]))
        pos = m.end()
        if pos == last and html.startswith("<!--", m.start()) and not html.endswith("-->", m.start() + 4, pos):
            break  # a comment that never ends
        name = m[2] or m[5]
        if name is None:
            continue
        name, closing, attrs = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        at.tags += 1
        if name in INLINE:
            if name == "a":
                link = 0 if closing else 1
            elif name == "br":
                at.pieces.append(" ")
            continue
        link = 0
        if closing:
            if opened[name] > 0:
                k = len(stack) - 1
                while stack[k].tag != name:
                    k -= 1
                at = close(k)
            continue
        if name in CLOSES_P and at.tag == "p":
            at = close(len(stack) - 1)
        elif name in SAME_CLOSES and any(opened[t] > 0 for t in SAME_CLOSES[name]):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SAME_CLOSES[name]:
                    at = close(k)
                    break
                if stack[k].tag in SCOPES:
                    break
        kinds, truth = set(), None
        if name in TAG_KIND:
            kinds.add(TAG_KIND[name])
        if attrs and "=" in attrs:
            for _, *values in _ATTR.findall(attrs):
                kinds.update(_KIND[t] for t in _SPLIT.split("".join(values).lower()) if t in _KIND)
            told = truth_of.search(attrs) if truth_of else None
            truth = int(told[1]) if told else None
        block = Block(name, at, frozenset(kinds), seen, truth)
        at.pieces.append(block)
        at.children.append(block)
        blocks.append(block)
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, pos)
            pos = end.end() if end else size
        elif name not in VOID and not attrs.endswith("/"):
            stack.append(block)
            opened[name] += 1
            at = block
    return blocks


def features(blocks: list[Block]) -> list[list[float]]:
    """One row of numbers per block."""
    total = [b.chars for b in blocks]
    index = {id(b): i for i, b in enumerate(blocks)}
    links, tags, stops = [b.links for b in blocks], [b.tags for b in blocks], [b.stops for b in blocks]
    for i in range(len(blocks) - 1, 0, -1):
        p = index[id(blocks[i].parent)]
        total[p] += total[i]
        links[p] += links[i]
        tags[p] += tags[i]
        stops[p] += stops[i]
    page = total[0] + 1.0
    sibling = [(1, 0, 0.0, 1.0)] * len(blocks)  # number, index, mean text, share of the same tag
    for b in blocks:
        if b.children:
            n = len(b.children)
            mean = sum(total[index[id(c)]] for c in b.children) / n
            count = Counter(c.tag for c in b.children)
            for k, c in enumerate(b.children):
                sibling[index[id(c)]] = (n, k, mean, count[c.tag] / n)
    out = []
    for i, b in enumerate(blocks):
        n, k, mean, same = sibling[i]
        t = total[i]
        row = [t, b.chars, links[i] / (t + 1), tags[i] / (t + 1), 100 * stops[i] / (t + 1), b.depth,
               b.start / page, t / page, n, k / n, mean, t / (mean + 1), same]
        group = _GROUP.get(b.tag, -1)
        row += [1.0 if group == g else 0.0 for g in range(len(_GROUPS))]
        row += [1.0 if kind in b.kinds else 0.0 for kind in KINDS]
        row += [1.0 if kind in b.above else 0.0 for kind in KINDS]
        out.append(row)
    return out


def unused_mark(html: str) -> str:
    """An attribute name that the page does not contain."""
    mark = "truth"
    while mark in html:
        mark += "-x"
    return mark


def variant(html: str, seed: int, mark: str) -> str | None:
    """A training page: the named article gets its truth in attribute ``mark``; other than variant 0
    it may lose its name and gains lists, headings, quotes, tables and clutter. None if no article is named."""
    found = re.search(NAMED, html, re.I)
    if not found:
        return None
    r = random.Random(seed)
    name = found[1]
    end = html.lower().find(f"</{name.lower()}", found.end())
    if end < 0:
        return None
    before, inside, after = html[:found.start()], html[found.end():end], html[end:]
    body = before.lower().rfind("<body")
    if body >= 0:
        body = before.find(">", body) + 1
    words = re.findall(r"[^\W\d_]+", re.sub(r"<[^>]*>", " ", inside))[:400] or ["word"]
    if seed % VARIANTS == 0:
        return f'{before}<{name} {mark}="1">{inside}{after}'

    def sentence() -> str:
        return " ".join(r.choice(words) for _ in range(r.randint(3, 25))) + r.choice([".", "", "!"])

    def clutter(kind: str) -> str:
        tag = r.choice({"menu": ["nav", "div"], "frame": ["header", "footer", "div"], "side": ["aside", "div"],
                        "comment": ["section", "div"]}.get(kind, ["div", "section"]))
        named = f' class="{r.choice(TOKENS[kind])}"' if tag in ("div", "section") or r.random() < 0.5 else ""
        if kind in ("menu", "share") or r.random() < 0.25:
            inner = "<ul>" + "".join(f'<li><a href="/">{r.choice(words)}</a></li>' for _ in range(r.randint(2, 9))) + "</ul>"
        else:
            inner = "".join(f"<p>{sentence()}</p>" for _ in range(r.randint(1, 4))) if r.random() < 0.6 else sentence()
        return f'<{tag}{named} {mark}="0">{inner}</{tag}>'

    def content() -> str:
        items = [sentence() for _ in range(r.randint(2, 6))]
        return r.choice([
            lambda: "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>",
            lambda: "<ol>" + "".join(f"<li><p>{i}</p></li>" for i in items) + "</ol>",
            lambda: f"<h2>{items[0][:60]}</h2>",
            lambda: f"<h3>{items[0][:40]}</h3><div><p>{items[1]}</p></div>",
            lambda: f"<blockquote><p>{items[0]}</p></blockquote>",
            lambda: "<table>" + "".join(f"<tr><td>{i[:20]}</td><td>{i}</td></tr>" for i in items) + "</table>",
            lambda: "<section>" + "".join(f"<p>{i}</p>" for i in items) + "</section>",
            lambda: f'<p>{items[0]} <a href="/">{items[1][:20]}</a> {items[1]}</p>'])()

    kinds = [k for k in KINDS if k != "main"]
    tag, token = r.choice([(name, ""), ("div", r.choice(TOKENS["main"])), ("section", r.choice(TOKENS["main"])), ("main", ""), ("div", "")])
    named = f' class="{token}"' if token else ""
    parts = re.split(r"(?<=</p>)", inside)
    for _ in range(r.randint(0, 4)):
        parts.insert(r.randrange(1, len(parts) + 1), content())
    for _ in range(r.randint(0, 2)):
        parts.insert(r.randrange(len(parts) + 1), clutter(r.choice(["advert", "share", "notice", "side"])))
    head = "".join(clutter(r.choice(kinds)) for _ in range(r.randint(0, 3)))
    foot = "".join(clutter(r.choice(kinds)) for _ in range(r.randint(0, 4)))
    tail = after[after.find(">") + 1:]
    return (f'{before[:max(body, 0)]}{head}{before[max(body, 0):]}<{tag}{named} {mark}="1">{"".join(parts)}</{tag}>{foot}{tail}')


def training_rows(html: str, page: int) -> list[tuple[list[float], float]]:
    out, mark = [], unused_mark(html)
    for v in range(VARIANTS):
        made = variant(html, page * VARIANTS + v, mark)
        if made is None:
            continue
        blocks = parse(made, mark)
        mixed = set()
        for b in reversed(blocks):  # a container of both kinds is not content
            if b.parent is not None and (id(b) in mixed or b.truth != b.parent.truth):
                mixed.add(id(b.parent))
        for b, row in zip(blocks, features(blocks)):
            if not b.never and b.parent is not None:
                out.append((row, 1.0 if b.truth == 1 and not (id(b) in mixed and b.tag == "body") else 0.0))
    return out


class Trees:
    """The boosted trees as arrays, applied to many blocks at once."""

    def __init__(self, trees: list[tuple], weights: list[float]):
        self.trees, self.weights = trees, weights

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for (feature, threshold, left, right, value), w in zip(self.trees, self.weights):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH + 1):
                f = feature[node]
                go = x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[node]
                node = np.where(f < 0, node, np.where(go, left[node], right[node]))
            total += w * value[node]
        return 2 * total


def stated_margins(x: np.ndarray) -> np.ndarray:
    """Margins without training: named clutter against named main text."""
    at = 13 + len(_GROUPS)
    kinds, above = x[:, at:at + len(KINDS)], x[:, at + len(KINDS):]
    bad = kinds[:, 1:].any(axis=1) | above[:, 1:].any(axis=1)
    good = (kinds[:, 0] + above[:, 0] > 0) | ((x[:, 13] + x[:, 14] > 0) & (x[:, 2] < 0.5) & (x[:, 0] >= 25))
    return np.where(bad, -2.0, np.where(good, 2.0, -0.5))


def _arrays(tree) -> tuple:
    """A Spark ML tree as (feature or -1, threshold, left, right, value)."""
    feature, threshold, left, right, value = [], [], [], [], []

    def add(node) -> int:
        me = len(feature)
        inner = node.getClass().getSimpleName() == "InternalNode"
        feature.append(node.split().featureIndex() if inner else -1)
        threshold.append(float(node.split().threshold()) if inner else 0.0)
        value.append(float(node.prediction()))
        left.append(me), right.append(me)
        if inner:
            left[me] = add(node.leftChild())
            right[me] = add(node.rightChild())
        return me

    add(tree._call_java("rootNode"))
    return tuple(np.array(a) for a in (feature, threshold, left, right, value))


def trained(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Trees | None:
    """Trees fitted on variants of a sample drawn by hash from the pages that
    name their article; None if the whole table has none."""
    ship(pages.sparkSession)
    html = F.col(html_col)
    # as variant() finds it: the first such element, closed after it
    name = F.lower(F.regexp_extract(html, f"(?i){NAMED}", 1))
    rest = F.regexp_extract(html, f"(?is){NAMED}(.*)", 2)
    hashed = pages.filter((name != "") & F.contains(F.lower(rest), F.concat(F.lit("</"), name))) \
        .select(F.xxhash64(id_col, F.octet_length(html_col)).alias("h"), html.alias("html"))
    last = hashed.select("h").distinct().orderBy("h").limit(TRAIN_PAGES).agg(F.max("h").alias("h")).first()["h"]
    if last is None:
        return None
    picked = hashed.filter(F.col("h") <= last).groupBy("h").agg(F.min("html").alias("html"))  # equal pages count once

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                made = training_rows(html, h % 1_000_003)
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in made], pa.list_(pa.float64())),
                                                  pa.array([y for _, y in made], pa.float64())], names=["x", "label"])

    made = landed(picked.repartition(8, "h").mapInArrow(rows, "x array<double>, label double"), "training")
    if made.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, cacheNodeIds=False) \
        .fit(made.select(array_to_vector("x").alias("features"), "label"))
    return Trees([_arrays(t) for t in model.trees], list(model.treeWeights))


def kept_text(blocks: list[Block], margins: np.ndarray) -> str:
    """The blocks that the best consistent choice keeps, one line each."""
    n = len(blocks)
    index = {id(b): i for i, b in enumerate(blocks)}
    content, clutter, mixed = [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        b = blocks[i]
        s = 0.0 if b.parent is None else float(margins[i]) * (0.25 + np.log1p(b.chars))
        if b.never:
            content[i], clutter[i], mixed[i] = 0.0, 0.0, -1e9  # dropped below, whatever is chosen
            continue
        own = abs(s) if b.chars else 0.0  # a mixed block's own text goes by its own margin
        c, d, m = s, -s, own - MIXED
        for child in b.children:
            k = index[id(child)]
            c, d, m = c + content[k], d + clutter[k], m + max(content[k], clutter[k], mixed[k])
        content[i], clutter[i], mixed[i] = c, d, m
    lines: list[str] = []
    line: list[str] = []

    def flush() -> None:
        joined = " ".join("".join(line).split())
        if joined:
            lines.append(joined)
        line.clear()

    todo: list = [(blocks[0], 2)]  # 0 content, 1 clutter, 2 mixed, 3 end of a block
    while todo:
        item, state = todo.pop()
        if state == 3:
            flush()
            continue
        if isinstance(item, str):
            line.append(item)
            continue
        if item.never or state == 1:
            continue
        i = index[id(item)]
        flush()
        todo.append((item, 3))
        for piece in reversed(item.pieces):
            if isinstance(piece, str):
                if state == 0 or (item.parent is not None and margins[i] > 0):
                    todo.append((piece, 0))
            elif state == 0:
                todo.append((piece, 0))
                todo.append((item, 3))
            else:
                k = index[id(piece)]
                choice = max((content[k], 0), (mixed[k], 2), (clutter[k], 1), key=lambda x: x[0])[1]
                todo.append((piece, choice))
                todo.append((item, 3))
    flush()
    return "\n".join(lines)


def extracted(pages: DataFrame, keep: list[str], trees: Trees | None, html_col: str = "html") -> DataFrame:
    """Columns ``keep`` of every page with its main ``text``."""
    ship(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                parsed = [parse(h or "") for h in part.column(0).to_pylist()]
                x = np.array([row for blocks in parsed for row in features(blocks)])
                margins = model.margins(x) if model else stated_margins(x)
                texts, done = [], 0
                for blocks in parsed:
                    texts.append(kept_text(blocks, margins[done:done + len(blocks)]))
                    done += len(blocks)
                rest = part.select(range(1, part.num_columns))
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(texts, pa.string())],
                                                 names=[*rest.schema.names, "text"])

    schema = pages.select(*keep).schema.add("text", "string")
    return pages.select(F.col(html_col).alias("_argent_html"), *keep).mapInArrow(run, schema)


def op10_html_text(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = extracted(pages, ["page_id", "url"], trained(pages))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
