"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is cut into blocks at block-level tags. Two views judge each block: how it stands and reads (tag, links, length,
punctuation, its neighbours, how much text its parent holds), and what the elements around it are called. Their log-odds
become the costs of calling it content or boilerplate: the capacities of its edges to the two terminals. Blocks that
follow each other, and blocks under one parent, are tied by smoothness edges that cost when their labels
differ. A maximum flow gives the cheapest labelling of the page. Pages are independent, so each is solved in
the task that reads it.

Both views are learned here, on at most SAMPLE_PAGES pages, from pages that mark their article by its element; neither
decides alone. The first view knows no names and no such elements: it must tell content where nothing is named, and can
overrule names that lie. The second counts how often each name stands around content and around the rest; names that
were never met have the weak odds that their meaning suggests. A logistic model weighs the views, the names left out for
every other page that it learns from.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.llm.shared import hash_sample, map_rows, mapped

SAMPLE_PAGES = 2000
#: Smoothness of neighbours in page order and of blocks under one parent, against costs in nats.
NEXT, SIBLING = 0.4, 0.3
#: The most either terminal cost may be, so that no block is beyond its neighbours' reach but none flips easily.
MOST_COST = 8.0
#: Log-odds that names may add up to, those of a name never met that sounds like content or boilerplate, and the weight of a
#: name around the parent element beside that of the element itself, and so on outwards.
MOST_NAMED, HINT, OUTWARDS = 4.0, 2.5, 0.7

# HTML element names.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = frozenset("script style noscript template head title textarea select button svg annotation annotation-xml iframe canvas audio video datalist".split())
HEAD = frozenset("head base basefont bgsound link meta title noscript noframes style script template".split())
FOREIGN = frozenset("svg math".split())
NESTED = frozenset("template svg annotation-xml".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER = frozenset("nav header footer aside form menu dialog fieldset".split())
CONTENT = frozenset("article main".split())
# Words in class, id and role names that hint at boilerplate and content.
BOILER_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus disclaimer footer form header login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar widget".split())
CONTENT_WORDS = frozenset("article body content entry main post story text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>|[^<]+|<", re.DOTALL)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[a-z]+")
_CLOSES = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "td", "option": "option"}


@dataclass
class Node:
    """An element: its number, depth, tag, the words of its names, what is around it, and how the page itself marks what
    it holds: in its article (True), in an element for other things (False), or neither."""

    number: int
    depth: int
    tag: str
    words: tuple[str, ...]
    around: Node | None
    marked: bool | None


@dataclass
class Block:
    home: Node
    pieces: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""

    @property
    def box(self) -> Node:
        """The block-level element that holds the text, or the page."""
        node = self.home
        while node.around is not None and node.tag not in BLOCKS:
            node = node.around
        return node

    @property
    def parent(self) -> int:
        return self.box.around.number if self.box.around else -1


def _node(number: int, tag: str, attributes: str, around: Node) -> Node:
    words = tuple({p for n in _NAMES.finditer(attributes) for p in _PART.findall((n[1] or n[2] or n[3] or "").lower())}) if attributes else ()
    marked = around.marked
    if tag in CONTENT and (marked is None or around.tag == "form" or around.depth < 3):
        marked = True
    elif tag in BOILER and not (tag == "header" and marked):
        marked = False
    return Node(number, around.depth + 1, tag, (*words, f"<{tag}>") if tag in BOILER or tag in CONTENT else words, around, marked)


def blocks_of(page: str | None) -> list[Block]:
    """The non-empty text blocks of a page, in order, outside scripts, styles and other hidden elements.

    Unclosed and stray tags, comments and elements are tolerated; a null page has no block. Linear in the page. The head ends
    at its end tag or at the first thing that can't be in it. A hidden element that nothing closes before another of its
    kind, or at all, ends at the next block. Only void elements, and those within drawings and formulas, close themselves.
    A quotation mark that is never closed is part of its tag, which ends at the next >.
    """
    page = page or ""
    stack = [Node(0, 0, "", (), None, None)]
    open_ = Counter()  # tags on the stack: an end tag without one is stray
    out: list[Block] = []
    nodes, links, hidden, at = 1, 0, 0, 0
    now: Block | None = None
    loose: set[int] = set()  # hidden elements that nothing closes
    marks: dict[str, tuple[list[int], list[int]]] = {}

    def closed(name: str, at: int) -> bool:
        """Whether a hidden element that begins before `at` is closed before another of its name begins."""
        if name not in marks:
            found = [(m.start(), m.group(1)) for m in re.finditer(f"<(/?){re.escape(name)}(?=[\\s/>])", page, re.IGNORECASE)]
            marks[name] = [k for k, end in found if not end], [k for k, end in found if end]
        starts, ends = marks[name]
        start, end = bisect_left(starts, at), bisect_left(ends, at)
        return end < len(ends) and (name in NESTED or start == len(starts) or ends[end] < starts[start])

    def close() -> None:
        nonlocal now
        if now is not None:
            now.text = _SPACE.sub(" ", entities.unescape("".join(now.pieces))).strip()
            if now.text:
                out.append(now)
        now = None

    def pop() -> str:
        nonlocal links, hidden
        node = stack.pop()
        tag = node.tag
        open_[tag] -= 1
        hidden -= tag in HIDDEN
        links -= tag == "a"
        loose.discard(node.number)
        return tag

    size = len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        if m is None:
            break
        at = m.end()
        token, name = m.group(), m.group(2)
        if name is None:
            if token[:2] in ("<!", "<?"):
                continue
            if stack[-1].tag == "head" and not token.isspace():
                pop()
            if hidden:
                continue
            if token == "<" and page[at : at + 1].isalpha() | (page[at : at + 1] == "/") and page.find(">", at) < 0:
                break  # the page ends within a tag
            if now is None:
                now = Block(stack[-1])
            now.pieces.append(token)
            now.link_chars += len(token) * (links > 0)
            continue
        name = name.lower()
        if m.group(1):
            if name in BLOCKS:
                close()
            if open_[name]:
                while pop() != name:
                    pass
            continue
        if stack[-1].tag == "head" and name not in HEAD:
            pop()
        while loose and name in BLOCKS and name != "option":
            pop()
        if name in BLOCKS:
            close()
        elif name == "br" and now is not None:
            now.pieces.append(" ")
        if name in VOID or m.group(3).endswith("/") and (name in FOREIGN or any(open_[f] for f in FOREIGN)):
            continue
        # end tags that may be left out
        if name in BLOCKS and stack[-1].tag == "p":
            pop()
        if name in _CLOSES and stack[-1].tag in (name, _CLOSES[name]):
            pop()
        stack.append(_node(nodes, name, m.group(3), stack[-1]))
        open_[name] += 1
        nodes += 1
        links += name == "a"
        hidden += name in HIDDEN
        if name in HIDDEN and name not in RAW and name != "head" and not closed(name, at):
            loose.add(nodes - 1)
        if name in RAW:
            end = re.compile(f"</{name}", re.IGNORECASE).search(page, at)
            at = end.start() if end else size
    close()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """The first view, a row a block: where it stands and how it reads, and nothing that anything is called."""
    n = len(blocks)
    length = np.array([len(b.text) for b in blocks], float)
    links = np.minimum(np.array([b.link_chars for b in blocks]) / np.maximum(length, 1), 1.0)
    words = np.array([b.text.count(" ") + 1 for b in blocks], float)
    held, short = Counter(), Counter()
    parents, tags = [b.parent for b in blocks], [b.box.tag for b in blocks]
    for parent, size, w, link in zip(parents, length, words, links, strict=True):
        held[parent] += size * (1 - link)
        short[parent] += w < 8
    most = max(held.values(), default=0) or 1.0
    rows = []
    for k, b in enumerate(blocks):
        near = [i for i in range(max(0, k - 2), min(n, k + 3)) if i != k]
        parent = parents[k]
        rows.append([
            1.0,
            float(tags[k] in ("p", "blockquote", "pre")),
            float(tags[k] in ("h1", "h2", "h3")),
            float(tags[k] in ("li", "td", "th", "option", "dt", "dd")),
            links[k],
            min(np.log1p(words[k]), 6.0) / 6,
            float(b.text[-1:] in ".!?\"'"),
            float("©" in b.text or "Copyright" in b.text),
            float(np.mean(np.minimum(np.log1p(length[near]), 8.0)) / 8) if near else 0.0,
            float(np.mean(links[near])) if near else 0.0,
            held[parent] / most,
            min(short[parent], 10) / 10,
            float(k == 0 or k == n - 1),
            k / n,
        ])
    return np.array(rows)


#: Weights before training, and where no page marks its article: paragraphs, long text and a parent that holds much of the
#: page's text speak for content, links and short pieces against it; the last is that of the names' log-odds.
PRIOR = np.array([-2.0, 1.5, 0.5, -1.0, -3.0, 3.0, 0.5, -3.0, 1.0, -1.5, 2.0, -1.0, -0.5, 0.0, 1.0])


@dataclass(frozen=True)
class Model:
    """Weights of the first view's features and of the names, and the log-odds of names that were met."""

    weights: np.ndarray
    names: dict[str, float]

    def hint(self, word: str) -> float:
        """Log-odds of a name: learned, or what its meaning suggests."""
        bare = word.strip("<>")
        guess = -HINT if bare in BOILER_WORDS or bare in BOILER and bare != word else HINT if bare in CONTENT_WORDS else 0.0
        return self.names.get(word, guess)

    def named(self, blocks: list[Block]) -> np.ndarray:
        """The second view: each block's log-odds by the names around it. The strongest name of an element speaks for it, an
        element that speaks against content outweighs those around it."""
        found: dict[int, float] = {}

        def of(node: Node | None) -> float:
            chain = []
            while node is not None and node.number not in found:
                chain.append(node)
                node = node.around
            value = found[node.number] if node is not None else 0.0
            for x in reversed(chain):
                own = max((self.hint(w) for w in x.words), key=abs, default=0.0)
                if own < 0:
                    value = own + OUTWARDS * min(value, 0.0)
                else:
                    value = value + own / 2 if value < 0 else own + OUTWARDS * value
                value = found[x.number] = float(np.clip(value, -MOST_NAMED, MOST_NAMED))
            return value

        return np.array([of(b.home) for b in blocks])

    def scores(self, blocks: list[Block]) -> np.ndarray:
        """Log-odds of content for each block, clipped to MOST_COST."""
        views = np.column_stack([features(blocks), self.named(blocks)])
        return np.clip(views @ self.weights, -MOST_COST, MOST_COST)


def logistic(rows: np.ndarray, labels: np.ndarray, steps: int = 25, ridge: float = 0.002) -> np.ndarray:
    """Logistic weights by Newton steps, held near PRIOR where the rows say little."""
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (labels - p) / len(rows) - ridge * (w - PRIOR)
        curve = (rows * (p * (1 - p))[:, None]).T @ rows / len(rows) + np.eye(len(w)) * ridge
        w += np.linalg.solve(curve, slope)
    return w


def labelled(blocks: list[Block]) -> list[bool | None] | None:
    """The page's own labels of its blocks, where it marks one stretch of them as its article: those in it (None, unknown,
    where something inside it has a name that hints at other things), and the rest."""
    labels: list[bool | None] = []
    for b in blocks:
        label: bool | None = b.home.marked is True
        node = b.home
        while label and node is not None and node.tag not in CONTENT:
            label = None if BOILER_WORDS.intersection(node.words) else label
            node = node.around
        labels.append(label)
    return labels if True in labels and False in labels else None


def name_odds(blocks: list[Block], labels: list[bool | None]) -> Iterator[tuple[str, bool]]:
    """(name, label) for each block of known label and each name around it."""
    for b, label in zip(blocks, labels, strict=True):
        node, seen = b.home if label is not None else None, set()
        while node is not None:
            seen.update(node.words)
            node = node.around
        for word in seen:
            yield word, label


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Model:
    """Both views from a bounded sample of pages(page_id, html). Without pages that mark an article: the priors."""
    sample = hash_sample(pages.select("page_id", "html").where(F.col("html").isNotNull()), sample_pages, "page_id")

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for blocks in map(blocks_of, pdf["html"]):
                if labels := labelled(blocks):
                    seen.update(name_odds(blocks, labels))
        yield pd.DataFrame([(word, label, n) for (word, label), n in seen.items()], columns=["word", "label", "n"])

    counts = mapped(sample, names, "word string, label boolean, n long").groupBy("word").agg(F.sum(F.when(F.col("label"), F.col("n")).otherwise(0)).alias("yes"), F.sum(F.when(F.col("label"), 0).otherwise(F.col("n"))).alias("no"))
    empty, learned = Model(PRIOR, {}), {}
    for r in counts.collect():
        # what the meaning suggests counts as two blocks
        learned[r.word] = float(np.clip(np.log((r.yes + 1) / (r.no + 1)) + empty.hint(r.word) / (1 + (r.yes + r.no) / 2), -MOST_NAMED, MOST_NAMED))
    model = Model(PRIOR, learned)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for page_id, page in zip(pdf["page_id"], pdf["html"], strict=True):
                blocks = blocks_of(page)
                if labels := labelled(blocks):
                    # every other page is learned from as if nothing in it were named
                    named = model.named(blocks) * (zlib.crc32(str(page_id).encode()) % 2)
                    out += [(float(label), row.tolist()) for label, row in zip(labels, np.column_stack([features(blocks), named]), strict=True) if label is not None]
            yield pd.DataFrame(out, columns=["label", "row"])

    got = mapped(sample, rows, "label double, row array<double>").toPandas()
    if got["label"].nunique() < 2:
        return model
    return Model(logistic(np.array(got["row"].tolist()), got["label"].to_numpy()), learned)


def min_cut(to_content: np.ndarray, to_boiler: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels (content: True) of least total cost: to_boiler for each content block, to_content for each boilerplate
    block, and each edge's weight where its ends differ. Dinic's maximum flow, then the source side of the cut."""
    n = len(to_content)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    left: list[float] = []

    def link(a: int, b: int, there: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        left.append(there)
        heads[b].append(len(to))
        to.append(a)
        left.append(back)

    for i in range(n):
        # what both terminals would carry cancels
        common = min(to_content[i], to_boiler[i])
        if to_content[i] > common:
            link(source, i, float(to_content[i] - common), 0.0)
        elif to_boiler[i] > common:
            link(i, sink, float(to_boiler[i] - common), 0.0)
    for a, b, weight in edges:
        link(a, b, weight, weight)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in heads[u]:
                if left[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return np.array([level[i] >= 0 for i in range(n)])
        turn = [0] * (n + 2)
        # depth first along the levels, without recursion: pages may be long chains
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                room = min(left[e] for e in path)
                for e in path:
                    left[e] -= room
                    left[e ^ 1] += room
                cut = next(k for k, e in enumerate(path) if left[e] <= tiny)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[u] < len(heads[u]):
                e = heads[u][turn[u]]
                if left[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                turn[u] += 1
            else:
                if u == source:
                    break
                e = path.pop()
                u = to[e ^ 1]
                turn[u] += 1
                continue
            path.append(e)
            u = to[e]


def content_labels(blocks: list[Block], scores: np.ndarray) -> np.ndarray:
    """Which blocks are content, by the cheapest labelling under their scores and the edges between them."""
    # costs in nats: -log of the chance of the other label
    to_content, to_boiler = np.logaddexp(0, scores), np.logaddexp(0, -scores)
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT))
        # the last block under the same parent element
        home = b.parent
        if home in last and last[home] != i - 1:
            edges.append((last[home], i, SIBLING))
        last[home] = i
    return min_cut(to_content, to_boiler, edges)


def content_blocks(blocks: list[Block], model: Model) -> list[Block]:
    if not blocks:
        return []
    return [b for b, content in zip(blocks, content_labels(blocks, model.scores(blocks)), strict=True) if content]


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages(page_id, url, html).

    Text: content blocks in page order joined by one \\n; character references decoded, white space inside a block
    made one space, ends trimmed. Null, empty and contentless pages: empty text. Repeated rows fare alike.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = ["\n".join(b.text for b in content_blocks(blocks_of(page), shared.value)) for page in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return map_rows(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long", "page_id")
