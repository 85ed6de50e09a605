"""Operator 8: main text of web pages by a minimum cut.

A page becomes blocks: what stands between the borders of block-level elements, in page order. A logistic
classifier gives each block the log-odds of being content, from what surrounds it (sectioning elements, class, id
and role words of its ancestors), the share of its text in links, its length, its punctuation and its element. The
log-odds are the capacity of the block's edge to the source (content) or the sink (boilerplate).

Smoothness edges, on the same scale, join blocks that follow one another, and blocks that are near in the DOM: a
block and the block before it, the last block under the same parent, and the last one under the same grandparent,
the stronger the shorter the way between their elements in the tree. The minimum cut labels the blocks, so a block
the classifier is unsure of goes with its surroundings; content is joined by empty lines.

The cut is exact: blocks whose terminal edge outweighs all their smoothness edges are settled at once, which
moves their edges to their neighbours' terminals; what remains is solved by augmenting paths.

The classifier is fitted on a bounded sample: about ``SAMPLE_PAGES`` pages by a hash of page_id, of each at most
``SAMPLE_BLOCKS`` blocks, evenly spaced, of those pages that have an article or main element, which tells content
from the rest. Each such block is learned from twice, once with and once without its sectioning elements, so that
pages without such elements profit too. The fit is a maximum a posteriori one around the weights ``PRIOR``; the
whole sample counts as ``SAMPLE_WORTH`` blocks against it, so what the sample does not show keeps its prior weight.

Pages are independent: one pass, no shuffle. The class words and prior weights are parameters of this module.

Edge cases: null or empty html, and pages without content blocks, give the empty text; unclosed elements
end with the page; an unclosed comment, script or style swallows the rest; a null url stays null; repeated rows
repeat, and ties have the same result everywhere; other columns are ignored; nothing is capped, and very long
pages are done whole. Text that is hidden by a style stays. Without pages to learn from the prior weights hold.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm.common import table

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<(?=[^a-zA-Z/!?])|<|[^<]+", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
#: Their content is no text.
RAW = {"script", "style", "template", "textarea", "title", "svg", "iframe", "object", "canvas", "audio", "video", "head"}
_UNTIL = {t: re.compile(rf"</{t}\b[^>]*>|\Z", re.I) for t in ("script", "style", "template", "textarea", "title", "iframe")}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption button select option legend".split()
)
#: A start tag of the key ends an open element of these.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "fieldset"}
PARAGRAPHS = {"p", "blockquote", "pre", "h2", "h3", "h4"}

BOILERPLATE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert sidebar side menu nav navigation navbar breadcrumb breadcrumbs footer header masthead topbar share sharing social related recommended popular trending comment comments disqus reply replies subscribe subscription newsletter signup login popup modal overlay widget toolbar copyright pagination pager search form button buttons contentinfo complementary dialog".split()
)
CONTENT_WORDS = set("article content post entry story main body text".split())
#: Words that say nothing of what a container holds.
NEUTRAL_WORDS = set("area bar block bottom box col column container global group holder inner item left list outer page panel primary right row secondary section site slot top unit wrap wrapper zone".split())
NEGATIONS = {"no", "has", "with", "without"}

# What the ancestors of a block say of it.
ARTICLE, CONTENT_CLASS, BOILERPLATE_TAG, BOILERPLATE_CLASS, PART_CLASS, ARTICLE_HEADER = 1, 2, 4, 8, 16, 32
_SECTIONING = ARTICLE | BOILERPLATE_TAG | ARTICLE_HEADER

#: Prior weight of each feature, in log-odds; above 0 speaks for content.
PRIOR = {
    "bias": -2.0, "in article": 6.0, "content class": 3.0, "boilerplate element": -7.0, "boilerplate class": -7.0, "boilerplate word in class": -2.0,
    "header of article": -1.0, "share of links": -3.0, "doublings of words": 0.4, "punctuation": 0.7, "paragraph": 1.0, "first heading": 2.0,
}
PRIOR_DEVIATION = 1.0
SAMPLE_PAGES, SAMPLE_BLOCKS, SAMPLE_WORTH = 1000, 64, 50.0
#: Weights of smoothness edges, in log-odds: of neighbours in the page, and of blocks at distance 0 in the tree.
ADJACENT, NEAR = 0.3, 2.0
_LEAST = 1e-12


@dataclass
class Block:
    text: str
    features: tuple[float, ...]
    element: int
    flags: int


@dataclass
class Page:
    """Blocks, and of each block-level element its parent and depth."""

    blocks: list[Block]
    parent: list[int]
    depth: list[int]

    def distance(self, a: int, b: int) -> int:
        """Steps between two elements in the tree."""
        steps = 0
        while a != b:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a = self.parent[a]
            steps += 1
        return steps


class _Element:
    __slots__ = ("tag", "flags", "uid", "skip")

    def __init__(self, tag: str, flags: int, uid: int, skip: bool):
        self.tag, self.flags, self.uid, self.skip = tag, flags, uid, skip


def _token_kind(token: str) -> int:
    """What one word of a class, id or role attribute says: its last part that says something decides."""
    words = _WORD.findall(token)
    if not words or words[0] in NEGATIONS:
        return 0
    told = [w for w in words if w not in NEUTRAL_WORDS]
    if told and told[-1] in BOILERPLATE_WORDS:
        return ARTICLE_HEADER if told[-1] == "header" else BOILERPLATE_CLASS
    if told and told[-1] in CONTENT_WORDS and not BOILERPLATE_WORDS.intersection(told):
        return CONTENT_CLASS
    return PART_CLASS if BOILERPLATE_WORDS.intersection(told) else 0


def _flags(tag: str, attributes: str, above: int) -> int:
    """What an element and its ancestors say. Boilerplate goes on downwards, also through an article (a comment may
    be one); within an article only marks of its own end it."""
    flags, kinds = above, 0
    if "=" in attributes and tag not in ("html", "body"):
        for _, value in _ATTRIBUTE.findall(attributes):
            for token in value.strip("\"'").lower().split():
                kinds |= _token_kind(token)
    if tag in BOILERPLATE_TAGS:
        flags |= BOILERPLATE_TAG
    if tag == "header" or kinds & ARTICLE_HEADER:
        flags |= ARTICLE_HEADER if flags & ARTICLE else BOILERPLATE_TAG
    if kinds & BOILERPLATE_CLASS and not (tag in CONTENT_TAGS and kinds & CONTENT_CLASS):
        flags |= BOILERPLATE_CLASS
    if flags & (BOILERPLATE_TAG | BOILERPLATE_CLASS):
        return flags & ~(ARTICLE | CONTENT_CLASS)
    if tag in CONTENT_TAGS:
        return (flags | ARTICLE) & ~PART_CLASS
    if kinds & CONTENT_CLASS:
        return (flags | CONTENT_CLASS) & ~PART_CLASS
    return flags | PART_CLASS if kinds & PART_CLASS and not flags & (ARTICLE | CONTENT_CLASS) else flags


def _features(flags: int, text: str, linked: int, tag: str) -> tuple[float, ...]:
    """In the order of PRIOR."""
    words = text.count(" ") + 1
    signs = text[-1] in ".!?:;…。！？" or ", " in text or ". " in text
    return (1.0, *(float(flags & x > 0) for x in (ARTICLE, CONTENT_CLASS, BOILERPLATE_TAG, BOILERPLATE_CLASS, PART_CLASS, ARTICLE_HEADER)), min(1.0, linked / len(text)), float(min(8, words.bit_length())), float(signs), float(tag in PARAGRAPHS), float(tag == "h1"))


def blocks(page: str) -> Page:
    """The blocks of a page with their features."""
    out: list[Block] = []
    parent, depth = [0], [0]
    stack = [_Element("", 0, 0, False)]
    text: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        text.clear()
        if joined:
            top = next(e for e in reversed(stack) if e.tag in BLOCK or not e.tag)
            flags = stack[-1].flags
            out.append(Block(joined, _features(flags, joined, linked, top.tag), top.uid, flags))
        linked = 0

    def close(k: int) -> None:
        nonlocal links
        for e in stack[k:]:
            links -= e.tag == "a"
        if any(e.tag in BLOCK for e in stack[k:]):
            flush()
        del stack[k:]

    end, match = len(page), _TOKEN.match
    while at < end:
        m = match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            raw = m[0]
            if raw[0] != "<" or len(raw) == 1:
                if not stack[-1].skip:
                    shown = entities.unescape(raw) if "&" in raw else raw
                    text.append(shown)
                    if links:
                        linked += len(shown.strip())
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "p" and not any(e.tag == "p" for e in stack):
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                # An inline end tag does not close blocks.
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break
            continue
        if tag in BLOCK:
            flush()
            shut = ENDS.get(tag, {"p"} if tag not in ("html", "body") else ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in shut or stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCK and stack[k].tag not in ("span",):
                    break
            if tag in ("body", "article", "main", "nav"):
                for k in range(1, len(stack)):  # a head that was never closed
                    if stack[k].tag == "head":
                        close(k)
                        break
        if tag == "br":
            text.append(" ")
        if tag in VOID:
            continue
        if tag in _UNTIL:
            text.append(" ") if tag not in ("title",) else None
            at = _UNTIL[tag].search(page, at).end()
            continue
        if m[3].endswith("/") and tag not in BLOCK:
            continue
        top = stack[-1]
        uid = top.uid
        if tag in BLOCK:
            parent.append(uid)
            depth.append(depth[uid] + 1)
            uid = len(parent) - 1
        stack.append(_Element(tag, _flags(tag, m[3], top.flags), uid, top.skip or tag in RAW))
        links += tag == "a"
    close(1)
    flush()
    return Page(out, parent, depth)


def smoothness(page: Page) -> list[tuple[int, int, float]]:
    """Edges between blocks: with the block before, and with the last block under the same parent or grandparent."""
    edges: list[tuple[int, int, float]] = []
    under: dict[int, int] = {}
    for i, block in enumerate(page.blocks):
        parent = page.parent[block.element]
        near = {under[e] for e in (block.element, parent, page.parent[parent]) if e in under}
        if i:
            near.add(i - 1)
        for j in near:
            distance = page.distance(block.element, page.blocks[j].element)
            edges.append((j, i, NEAR * 2.0 ** (-distance / 2) + (ADJACENT if j == i - 1 else 0.0)))
        for e in (block.element, parent, page.parent[parent]):
            under[e] = i
    return edges


def _source_side(rest: list[int], s: list[float], near: list[dict[int, float]]) -> dict[int, int]:
    """The blocks that surplus still reaches when the flow is greatest: phases of shortest augmenting paths."""
    room = {i: {j: w for j, w in near[i].items()} for i in rest}
    up, down = {i: max(0.0, s[i]) for i in rest}, {i: max(0.0, -s[i]) for i in rest}
    while True:
        level = {i: 0 for i in rest if up[i] > _LEAST}
        queue, far = deque(level), None
        while queue:
            i = queue.popleft()
            if far is not None and level[i] >= far:
                break
            if down[i] > _LEAST:
                far = level[i]
                continue
            for j, w in room[i].items():
                if w > _LEAST and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if far is None:
            return level
        todo = {i: iter(list(room[i])) for i in level}
        for start in [i for i in level if not level[i]]:
            path = [start]
            while path and up[start] > _LEAST:
                i = path[-1]
                if down[i] > _LEAST:
                    push = min(up[start], down[i], *(room[a][b] for a, b in zip(path[:-1], path[1:], strict=True)))
                    up[start] -= push
                    down[i] -= push
                    for a, b in zip(path[:-1], path[1:], strict=True):
                        room[a][b] -= push
                        room[b][a] = room[b].get(a, 0.0) + push
                    # Go on from the first edge that is full now.
                    cut = next((k for k, (a, b) in enumerate(zip(path[:-1], path[1:], strict=True)) if room[a][b] <= _LEAST), len(path) - 1)
                    del path[cut + 1 :]
                    continue
                for j in todo[i]:
                    if level.get(j) == level[i] + 1 and room[i][j] > _LEAST:
                        path.append(j)
                        break
                else:
                    path.pop()


def minimum_cut(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least cost: what terminals are cut, plus smoothness edges across labels."""
    n, s = len(score), list(score)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:
        i = todo.pop()
        if label[i] is None and abs(s[i]) >= sum(near[i].values()) and (s[i] or not near[i]):
            label[i] = s[i] > 0
            for j, w in near[i].items():
                del near[j][i]
                if label[j] is None:
                    s[j] += w if label[i] else -w
                    todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        reached = _source_side(rest, s, near)
        for i in rest:
            label[i] = i in reached
    return [bool(x) for x in label]


Weights = tuple[float, ...]


def scores(page: Page, weights: Weights | None = None) -> list[float]:
    """The log-odds of each block."""
    own = weights or tuple(PRIOR.values())
    return [sum(map(mul, own, b.features)) for b in page.blocks]


def labels(page: Page, weights: Weights | None = None) -> list[bool]:
    """Which blocks are content, by the minimum cut."""
    return minimum_cut(scores(page, weights), smoothness(page))


def main_text(html: str | None, weights: Weights | None = None) -> str:
    page = blocks(html or "")
    return "\n\n".join(b.text for b, k in zip(page.blocks, labels(page, weights), strict=True) if k)


def examples(html: str, most: int = SAMPLE_BLOCKS) -> list[tuple[float, ...]]:
    """Rows of features and the label, for at most ``most`` blocks of a page with an article, each twice."""
    found = blocks(html).blocks
    if not any(b.flags & ARTICLE for b in found):
        return []
    out = []
    for b in found[:: -(-len(found) // most)]:
        label = float(b.flags & ARTICLE > 0)
        bare = _features(b.flags & ~_SECTIONING, b.text, 0, "")
        out.append((*b.features, label))
        out.append((*bare[:7], *b.features[7:], label))
    return out


def maximum_a_posteriori(rows: np.ndarray, worth: float = SAMPLE_WORTH, deviation: float = PRIOR_DEVIATION) -> Weights:
    """Weights of a logistic classifier for rows of features and label, by Newton's method."""
    prior = np.array(list(PRIOR.values()))
    if not len(rows):
        return tuple(PRIOR.values())
    x, y, w = rows[:, :-1], rows[:, -1], prior.copy()
    each, tight = worth / len(rows), np.eye(len(prior)) / deviation**2
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = each * x.T @ (p - y) + (w - prior) / deviation**2
        step = np.linalg.solve(each * (x * (p * (1 - p))[:, None]).T @ x + tight, slope)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(np.round(w, 6).tolist())


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Weights:
    """Weights from about ``sample`` pages, chosen by a hash of page_id; their examples (bounded) come to the driver."""
    rows = pages.where("page_id is not null and html is not null").select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    share = min(1.0, sample / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page_id, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_pydict({"page_id": [page_id], "rows": [[x for row in examples(html) for x in row]]}, pa.schema([("page_id", pa.int64()), ("rows", pa.list_(pa.float64()))]))

    found = [x for r in chosen.mapInArrow(run, "page_id long, rows array<double>").orderBy("page_id").collect() for x in r.rows]
    return maximum_a_posteriori(np.array(found).reshape(-1, len(PRIOR) + 1))


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html, ...); without weights the prior ones hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [main_text(x, weights) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    lean = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return lean.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
