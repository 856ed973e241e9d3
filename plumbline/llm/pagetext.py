"""Main text of raw pages by a tree-structured graphical model over their blocks.

Nodes are the block elements of a page, each content or not. A node has a potential from its tag, its
names, its own text and its links, an edge one from its parent's label and kind. Messages go up from
the leaves and down from the root, which gives each block its marginal; text of blocks that are more
likely content than not is the main text.

The potentials are estimated on a bounded sample of pages that label themselves by an ``article`` or
``main`` element, as a correction of fixed first values that hold where the sample says nothing.
Elements that cannot belong to an article (menus, headers, footers, sidebars, forms) are observed, with all that
stands in them. Not observed are the header of a labelled article, a form that holds an article's heading or much of
the page's text beside its labels (pages are wrapped in forms), and an element that was left open around
a labelled article that is most of the page. A
class, id or role with a word for such an element is a feature; it is observed only if one whole name is
such a word and the block holds no article, main or h1 and little of the page's text, or stands outside
the article that the page labels.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sample of labelled pages: how many, and up to which length.
SAMPLE_PAGES, SAMPLE_LENGTH = 400, 65_536

# Elements by their role in a page.
HIDDEN = frozenset(
    "head script style template noscript iframe object svg canvas select option button textarea audio video map"
    " datalist math".split()
)
APART = frozenset("nav header footer aside form menu dialog fieldset".split())
LABELLING = frozenset(("article", "main"))
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody"
    " tfoot tr td th blockquote pre figure figcaption address center details summary hr hgroup search".split()
) | APART
#: What ends the search for an open paragraph.
NOT_P = BLOCKS - {"p"}
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An element of this kind ends open ones of these kinds, up to the given container.
ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
}
# Words in the names of elements that are not part of an article.
NAMES_APART = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb"
    " breadcrumbs header masthead footer sidebar aside widget related recommended share sharing social cookie"
    " cookies consent notice notices alert popup modal overlay newsletter subscribe signup login search form"
    " comment comments respond replies disqus pagination pager toolbar skip".split()
)
NAMES_CONTENT = frozenset("content article post entry story body text main".split())

#: The share of a page's text up to which a block is observed as no content by its name.
SMALL_SHARE = 0.3

FEATURES = ("bias", "content_name", "apart_name", "text", "sentences", "links", *sorted(BLOCKS - APART), "form", "header")
# First weights of the features.
FIRST = dict.fromkeys(FEATURES, 0.0) | {
    "bias": -0.3, "content_name": 3.0, "apart_name": -4.0, "text": 0.8, "sentences": 0.6, "links": -4.0,
    "article": 8.0, "main": 8.0, "p": 1.0, "h1": 1.5, "h2": 1.0, "h3": 1.0, "blockquote": 1.0,
    "pre": 1.0, "html": -4.0, "body": -2.0, "form": -1.0, "header": -0.5,
}
#: How often, in made-up pages, a child is content below a parent of label 0 and of label 1.
FIRST_EDGES = ((9.0, 1.0), (1.0, 60.0))
NEVER = -1e4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>|(?P<text>[^<]++|<)",
    re.DOTALL,
)
#: A tag with a quote that is never closed ends at the next bracket.
_BROKEN = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>[^>]*)(?P<text>)>")
_OPENS = re.compile(r"</?[a-zA-Z]")
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_CONCEALED = re.compile(
    r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE
)
_SENTENCE = re.compile(r"[.!?](?=\s|$)")


@dataclass
class Block:
    tag: str
    parent: int
    apart: bool = False
    content_name: bool = False
    apart_name: bool = False
    wholly: bool = False
    inside: bool = False
    text: int = 0
    linked: int = 0
    labelled: int = 0
    sentences: int = 0
    pieces: list[str] = field(default_factory=list)


def blocks_of(page: str) -> tuple[list[Block], list[tuple[int, str]]]:
    """The blocks of a page in the order of their start, and its texts in order with their block."""
    nodes, texts = [Block("html", -1)], []
    stack, links, labels, at = [0], 0, 0, 0
    # How many blocks of a kind are open, and hidden elements that nothing ends from here on.
    opened, endless = dict.fromkeys(BLOCKS, 0), set()

    def flush() -> None:
        node = nodes[stack[-1]]
        if node.pieces:
            joined = " ".join(html.unescape("".join(node.pieces)).split())
            node.pieces = []
            if joined:
                node.text += len(joined)
                node.sentences += len(_SENTENCE.findall(joined))
                texts.append((stack[-1], joined))

    def close(k: int) -> None:
        flush()
        for i in stack[k:]:
            opened[nodes[i].tag] -= 1
        del stack[k:]

    def innermost(kinds: frozenset[str], container: frozenset[str] = frozenset()) -> int:
        if not any(opened[kind] for kind in kinds):
            return 0
        for k in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[k]].tag
            if tag in kinds:
                return k
            if tag in container:
                break
        return 0

    while at < len(page):
        m = _TOKEN.match(page, at)
        if m["text"] == "<" and _OPENS.match(page, at):
            m = _BROKEN.match(page, at)
            if m is None:  # an unfinished tag
                break
        elif (text := m["text"]) is not None:
            at = m.end()
            nodes[stack[-1]].pieces.append(text)
            if links:
                nodes[stack[-1]].linked += len(text.strip())
            if labels:
                nodes[stack[-1]].labelled += len(text.strip())
            continue
        at = m.end()
        if m["tag"] is None:
            continue
        tag, ending = m["tag"].lower(), bool(m["end"])
        if tag in HIDDEN:
            if not ending and not m["rest"].endswith("/") and tag not in endless:
                over = re.compile(rf"</{re.escape(tag)}(?=[\s>/])[^>]*>", re.IGNORECASE).search(page, at)
                if over:
                    at = over.end()
                elif tag in ("script", "style", "textarea"):
                    at = len(page)
                else:
                    endless.add(tag)
            continue
        if tag == "br":
            nodes[stack[-1]].pieces.append(" ")
        elif tag == "a":
            links = 0 if ending else 1
        elif tag == "label":
            labels = 0 if ending else 1
        if tag not in BLOCKS:
            continue
        links = labels = 0
        if ending:
            k = innermost(frozenset((tag,)))
            if k:
                close(k)
            continue
        if tag in CLOSES_P and (k := innermost(frozenset(("p",)), NOT_P)):
            close(k)
        if tag in ENDS and (k := innermost(*ENDS[tag])):
            close(k)
        flush()
        if tag == "html":
            continue
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(m["rest"]))
        words = set(re.split(r"[^a-z0-9]+", names.lower())) if names else set()
        parent = nodes[stack[-1]]
        named = tag not in ("body", *LABELLING)
        node = Block(
            tag,
            stack[-1],
            apart=bool(m["rest"] and _CONCEALED.search(m["rest"])),
            content_name=not words.isdisjoint(NAMES_CONTENT),
            apart_name=named and not words.isdisjoint(NAMES_APART),
            wholly=named and any(_wholly(n) for n in names.lower().split()),
            inside=parent.inside or tag in LABELLING,
        )
        nodes.append(node)
        if tag not in VOID:
            stack.append(len(nodes) - 1)
            opened[tag] += 1
    flush()
    _observe(nodes)
    return nodes, texts


def _wholly(name: str) -> bool:
    """Whether a name is made of words for elements that are not part of an article only."""
    words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
    return bool(words) and NAMES_APART.issuperset(words)


def _observe(nodes: list[Block]) -> None:
    """Observe the blocks that cannot belong to the article, by kind or by name, and all that stands in them."""
    held, labels = [n.text for n in nodes], [n.labelled for n in nodes]
    labelling = [n.tag in LABELLING for n in nodes]
    opens = [n.tag == "h1" or own for n, own in zip(nodes, labelling)]
    for i in range(len(nodes) - 1, 0, -1):
        parent = nodes[i].parent
        held[parent] += held[i]
        labels[parent] += labels[i]
        opens[parent] |= opens[i]
        labelling[parent] |= labelling[i]
    labelled = any(n.tag in LABELLING and size for n, size in zip(nodes, held))
    for i in range(1, len(nodes)):
        node, parent, size = nodes[i], nodes[nodes[i].parent], held[i]
        by_kind = node.tag in APART
        if node.tag == "header" and parent.inside:
            by_kind = False
        elif node.tag == "form":
            by_kind = not opens[i] and size - labels[i] <= SMALL_SHARE * held[0]
        elif by_kind:
            by_kind = not (labelling[i] and 2 * size > held[0])
        outside = labelled and not node.inside or size <= SMALL_SHARE * held[0]
        by_name = node.wholly and not opens[i] and outside
        # Parents come before their children.
        node.apart = node.apart or parent.apart or by_kind or by_name


def _features(node: Block) -> dict[str, float]:
    out = {"bias": 1.0, node.tag: 1.0}
    if node.content_name:
        out["content_name"] = 1.0
    if node.apart_name:
        out["apart_name"] = 1.0
    if node.text:
        out["text"] = math.log1p(node.text / 20)
        out["sentences"] = math.log1p(node.sentences)
        out["links"] = min(1.0, node.linked / node.text)
    return out


@dataclass
class Model:
    weights: dict[str, float]
    edges: tuple[tuple[float, float], tuple[float, float]]

    def marginals(self, nodes: list[Block]) -> list[float]:
        """The probability of each block to be content, by messages up and down the tree."""
        edges = [[math.log(x / sum(row)) for x in row] for row in self.edges]
        own = []
        for node in nodes:
            if node.apart:
                own.append([0.0, NEVER])
            else:
                own.append([0.0, sum(self.weights.get(k, 0.0) * v for k, v in _features(node).items())])
        # Below an observed element nothing is content.
        below = [[0.0, NEVER] if n.parent >= 0 and nodes[n.parent].apart else edges[0] for n in nodes]
        up = [o[:] for o in own]
        sent = [[0.0, 0.0] for _ in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            for x, row in ((0, below[i]), (1, edges[1])):
                sent[i][x] = _sum(up[i][0] + row[0], up[i][1] + row[1])
            parent = nodes[i].parent
            up[parent][0] += sent[i][0]
            up[parent][1] += sent[i][1]
        down = [[0.0, 0.0] for _ in nodes]
        out = []
        for i, node in enumerate(nodes):
            if node.parent >= 0:
                p = node.parent
                rest = [up[p][x] + down[p][x] - sent[i][x] for x in (0, 1)]
                for x in (0, 1):
                    down[i][x] = _sum(rest[0] + below[i][x], rest[1] + edges[1][x])
            odds = up[i][1] + down[i][1] - up[i][0] - down[i][0]
            out.append(1 / (1 + math.exp(-odds)) if odds > -700 else 0.0)
        return out

    def main_text(self, page: str | None) -> str:
        nodes, texts = blocks_of(page or "")
        content = self.marginals(nodes)
        return "\n".join(text for i, text in texts if content[i] > 0.5)


def _sum(a: float, b: float) -> float:
    high = a if a > b else b
    return high + math.log1p(math.exp(-abs(a - b)))


def _label(nodes: list[Block]) -> list[int]:
    labels = []
    for n in nodes:
        below_apart = n.parent >= 0 and labels[n.parent] < 0
        labels.append(-1 if n.apart or below_apart else int(n.inside))
    return labels


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of labelled pages: features, label and the parent's label."""
    for batch in batches:
        rows, labels, parents = [], [], []
        for page in batch.column(0).to_pylist():
            nodes, _ = blocks_of(page)
            own = _label(nodes)
            for n, label in zip(nodes, own):
                if label >= 0:
                    found = _features(n)
                    rows.append([found.get(f, 0.0) for f in FEATURES])
                    labels.append(label)
                    parents.append(own[n.parent] if n.parent >= 0 else -1)
        yield pa.RecordBatch.from_pydict(
            {
                "features": pa.array(rows, pa.list_(pa.float64())),
                "label": pa.array(labels, pa.int32()),
                "parent": pa.array(parents, pa.int32()),
            }
        )


def fitted(pages: DataFrame, most: int = SAMPLE_PAGES, length: int = SAMPLE_LENGTH) -> Model:
    """Potentials from at most ``most`` pages of at most ``length`` characters that label themselves.

    The sample is drawn by a hash of the page, so it does not depend on the order of rows: a share of
    the pages first, then the first of those, so that a task hands on few pages however many there are.
    """
    labelled = pages.where(
        F.col("html").rlike(r"(?i)<(article|main)[\s>]") & (F.length("html") <= length)
    ).select("html", F.xxhash64("html").alias("order"))
    share = min(1.0, 1.2 * most / max(1, labelled.count()))
    examples = (
        labelled.where(F.pmod("order", F.lit(1 << 31)) < F.lit(int(share * (1 << 31))))
        .orderBy("order")
        .limit(most)
        .select("html")
        .mapInArrow(_examples, "features array<double>, label int, parent int")
        .groupBy("features", "label", "parent")
        .agg(F.count("*").alias("n"))
        .toPandas()
    )
    edges = [list(row) for row in FIRST_EDGES]
    weights = np.array([FIRST[f] for f in FEATURES])
    if len(examples):
        for parent, label, n in zip(examples["parent"], examples["label"], examples["n"]):
            if parent >= 0:
                edges[parent][label] += n
        x = np.stack(examples["features"].to_numpy())
        y, n = examples["label"].to_numpy(float), examples["n"].to_numpy(float)
        first = weights.copy()
        # Newton steps for logistic regression with a normal prior around the first weights.
        for _ in range(8):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            gradient = x.T @ (n * (y - p)) - (weights - first)
            curvature = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(weights))
            weights = weights + np.linalg.solve(curvature, gradient)
    return Model(dict(zip(FEATURES, weights.tolist())), tuple(tuple(row) for row in edges))


def _extracted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [model.main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def main_texts(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages``, from the whole ``html``.

    Null, empty and blank pages, and pages without an article, have an empty text. Repeated rows
    repeat, null ids and addresses stay null, and other columns are not read; an empty table has no rows.
    Without a labelled page the first values of the model are used. Long pages are read in time that grows
    with their length, whatever is left open in them; a page takes some hundred bytes per tag.
    """
    model = model or fitted(pages)
    found = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(partial(_extracted, model=model), "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
