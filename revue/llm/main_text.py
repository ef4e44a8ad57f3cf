"""Main text of web pages: the maximum-scoring run of blocks, where words score positive and tags negative.

A page is read once, left to right, into blocks (text between tags that break a line). A block gains
the sum of its words' weights and costs what the tags before them do, and a linear scan
finds the contiguous run of blocks with the highest sum.

Weights come from labelled pages, those that mark their article themselves (``<article>``, ``<main>``). An
element has a key: its name with its role (a class, id or role word) if it has one. A word weighs the share
of words below its key that were inside the labelled article, a tag costs by the share of its
occurrences outside. Words below an element that is not text by its name or role (navigation, forms, adverts,
reader comments...: ``NOT_TEXT``) are counted for that element alone, so that a menu's list items say nothing of
lists in an article. Shares start from prior counts, so unseen names have a weight, too.

Words whose own key weighs less than a half because of such an element are not put out, even if the run spans it.
Crossing one costs ``CROSSING`` words, so an advert in the middle does not cut an article off. A run within an
element that marks the text is widened to all of it: short blocks at its ends belong to it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE, KEYS, PRIOR = 4000, 10_000, 20.0
CROSSING, OUTSIDE, LINKED, LEAST_COST, MOST_COST = 2.0, 0.1, 0.2, 0.05, 3.0

# Elements of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noembed noframes iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var nobr label output".split())
IN_TEXT = frozenset("img wbr embed input area source track param".split())
NOT_TEXT_NAMES = frozenset("head nav footer aside form script style template noscript iframe svg math canvas object audio video "
                           "button select textarea fieldset datalist dialog menu title applet map label input option noembed noframes".split())
ARTICLE = frozenset("article main".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption".split())
CLOSED_BY = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
             "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
# Words of class, id and role that name a part which is not the article's text.
NOT_TEXT = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
                     "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup menu nav navbar "
                     "navigation breadcrumb breadcrumbs masthead footer sidebar aside complementary related recommended "
                     "recommendations share sharing social comment comments commentlist reply replies disqus respond pagination "
                     "pager search login form widget widgets toolbar contentinfo dialog hidden skip copyright legal disclaimer".split())
HEADER = frozenset("header".split())
TEXT = frozenset("article main content post entry story".split())
STATES = frozenset("has with without no is not".split())
WHOLE_PAGE = frozenset("html body main".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_ROLE_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


def role_of(name: str, attributes: str, in_article: bool) -> tuple[list[str], bool]:
    """Keys of an element, the most telling first, and whether its name or role says that it is not text.

    A class, id or role says so by its first or last word, as in ``comment-list`` or ``main-nav``, unless another
    one is a word for the text; a single word always says so.
    """
    keys, no_text = [name], name in NOT_TEXT_NAMES or (name in HEADER and not in_article)
    if "=" not in attributes and "hidden" not in attributes:
        return keys, no_text
    said = exact = text = False
    for attribute, *values in _ATTRIBUTE.findall(attributes):
        attribute, value = attribute.lower(), "".join(values)
        if attribute == "hidden" or (attribute == "aria-hidden" and value.lower() == "true"):
            exact, keys = True, [f"{name}.hidden", *keys]
        elif attribute != "aria-hidden":
            for token in value.split():
                words = [w.lower() for w in _ROLE_WORD.findall(token)] or [""]
                if words[0] in STATES:
                    continue
                own = [w for w in (words[0], words[-1]) if w in NOT_TEXT or (w in HEADER and not in_article)]
                said, exact = said or bool(own), exact or (bool(own) and len(words) == 1)
                text = text or (len(words) == 1 and words[0] in TEXT)
                keys = [*(f"{name}.{w}" for w in own or words[:1]), *keys]
    return keys, no_text or (name not in WHOLE_PAGE and (exact or (said and not text)))


class Block:
    """Text between two breaks: the stretches of text, their number of words, keys and tags before and within."""

    __slots__ = ("article", "crossed", "element", "linked", "plain", "tags", "text")

    def __init__(self, element: Element):
        self.text: list[str] = []
        self.tags: list[list[str]] = []
        self.plain = self.linked = self.crossed = 0
        self.element, self.article = element, element.article


class Element:
    """A block element: its keys, those of the outermost element not of text around or at it, open inline ones, and
    the range of its blocks. ``text`` elements say by their name or role that they hold the page's text."""

    __slots__ = ("article", "begin", "counts", "depth", "end", "inline", "keys", "name", "not_text", "parent", "text")

    def __init__(self, name: str, keys: list[str], not_text: list[str] | None, parent: Element | None, begin: int):
        self.name, self.keys, self.not_text, self.parent, self.begin, self.end = name, keys, not_text, parent, begin, begin
        self.depth = parent.depth + 1 if parent else 0
        marks = name in ARTICLE and not_text is None
        self.article = marks or (parent is not None and parent.article)
        self.text = marks or (not_text is None and name not in WHOLE_PAGE and any(k.partition(".")[2] in TEXT for k in keys))
        self.inline: list[str] = []
        self.counts: Counter = Counter()


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order; those below an element that is not text included."""
    root = Element("", ["body"], None, None, 0)
    stack, opened, out = [root], Counter(), []
    block = Block(root)

    def flush() -> None:
        nonlocal block
        if block.plain or block.linked:
            out.append(block)
            block = Block(stack[-1])
        else:  # nothing but tags: they go to the next block
            block.element, block.article, block.text = stack[-1], stack[-1].article, []

    def text(chunk: str) -> None:
        chunk = entities.unescape(chunk) if "&" in chunk else chunk
        words = len(chunk.split())
        block.text.append(chunk)
        if stack[-1].counts["a"]:
            block.linked += words
        else:
            block.plain += words

    def close(name: str) -> None:
        flush()
        while True:
            element = stack.pop()
            element.end = len(out)
            opened[element.name] -= 1
            if element.name == name:
                break
        block.element, block.article = stack[-1], stack[-1].article

    at, last = 0, page.rfind(">") + 1
    while match := _TAG.search(page, at, last):
        if match.start() > at:
            text(page[at:match.start()])
        at = match.end()
        if match[0].startswith("<!--") and not match[0].endswith("-->"):
            at = len(page)
        name = match[2] or match[5]
        if not name:
            continue
        name, ends, attributes = name.lower(), match[1] or match[4], match[3] or match[6] or ""
        top = stack[-1]
        quiet = top.not_text is not None
        if ends:
            if name in INLINE:
                if top.counts[name]:
                    while True:
                        gone = top.inline.pop()
                        top.counts[gone] -= 1
                        if gone == name:
                            break
            elif opened[name]:
                close(name)
            if not quiet:
                block.tags.append([name])
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = (page.find(">", end.start()) + 1 if end else 0) or len(page)
            continue
        if name in VOID:
            if name == "br":
                block.text.append(" ")
            elif name not in IN_TEXT:
                flush()
            if not quiet:
                block.tags.append([name])
            continue
        keys, no_text = role_of(name, attributes, top.article)
        if name in INLINE and not no_text:
            top.inline.append(name)
            top.counts[name] += 1
            if not quiet:
                block.tags.append(keys)
            continue
        if top.name == "p" and name not in INLINE:
            close("p")
        elif top.name in CLOSED_BY.get(name, ()):
            close(top.name)
        parent = stack[-1]
        flush()
        stack.append(Element(name, keys, parent.not_text or (keys if no_text else None), parent, len(out)))
        opened[name] += 1
        block.element, block.article = stack[-1], stack[-1].article
        if no_text:
            block.crossed += not quiet
        elif not quiet:
            block.tags.append(keys)
    if at < len(page):
        text(page[at:])
    flush()
    for element in stack:
        element.end = len(out)
    return out


def text_of(block: Block) -> str:
    return " ".join("".join(block.text).split())


class Weights:
    """Share of a key's words, and of its tags, that lie in articles: from counts and a prior."""

    def __init__(self, words: dict[str, tuple[float, float]], tags: dict[str, tuple[float, float]]):
        self.words, self.tags = words, tags

    def word(self, keys: list[str], not_text: bool) -> float:
        key = next((k for k in keys if k in self.words), keys[0])
        inside, all_ = self.words.get(key, (0.0, 0.0))
        prior = 0.02 if not_text else 0.9 if key in PROSE or key.split(".")[-1] in TEXT else 0.3
        return (inside + PRIOR * prior) / (all_ + PRIOR)

    def cost(self, keys: list[str]) -> float:
        key = next((k for k in keys if k in self.tags), keys[0])
        inside, all_ = self.tags.get(key, (0.0, 0.0))
        prior = 0.95 if key in PROSE or key in INLINE or key == "br" else 0.5
        return LEAST_COST + MOST_COST * (1 - (inside + PRIOR * prior) / (all_ + PRIOR))


def _not_text(block: Block, weights: Weights) -> bool:
    return block.element.not_text is not None and weights.word(block.element.not_text, True) < 0.5


def best_run(gains: list[float], costs: list[float]) -> tuple[int, int]:
    """First and end index of the contiguous run with the highest sum, (0, 0) if none is above 0; the first of equal ones.

    A block's cost is that of the tags before its words, which a run that starts with it does not pay.
    """
    best, most, begin, total = (0, 0), 0.0, 0, 0.0
    for i, (gain, cost) in enumerate(zip(gains, costs, strict=True)):
        if total <= cost:
            begin, total = i, cost
        total += gain - cost
        if total > most:
            best, most = (begin, i + 1), total
    return best


def widened(blocks: list[Block], begin: int, end: int) -> tuple[int, int]:
    """A run with the blocks beside it that lie in the same text element, the innermost around all of it."""
    if begin == end:
        return begin, end
    low, high = blocks[begin].element, blocks[end - 1].element
    while low is not high:
        if low.depth >= high.depth:
            low = low.parent
        else:
            high = high.parent
    while low is not None and not low.text:
        low = low.parent
    return (begin, end) if low is None else (low.begin, low.end)


def main_text(page: str, weights: Weights) -> str:
    """The text of the best run of blocks, one line a block."""
    blocks = blocks_of(page)
    marked = any(b.article for b in blocks)
    gains, costs, left_out = [], [], []
    for b in blocks:
        skip = _not_text(b, weights)
        weight = weights.word(b.element.not_text, True) if skip else weights.word(b.element.keys, False)
        if marked and not b.article:
            weight *= OUTSIDE
        gains.append(weight * (b.plain + LINKED * b.linked))
        costs.append(CROSSING * b.crossed + sum(map(weights.cost, b.tags)))
        left_out.append(skip)
    begin, end = widened(blocks, *best_run(gains, costs))
    return "\n".join(t for b, skip in zip(blocks[begin:end], left_out[begin:end], strict=True) if not skip and (t := text_of(b)))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, inside, all) of the words and tags of pages that mark an article."""
    for batch in batches:
        seen: dict[tuple[str, str], list[int]] = {}
        for page in batch.column(0).to_pylist():
            blocks = blocks_of(page or "")
            if not any(b.article for b in blocks):
                continue
            for b in blocks:
                of = b.element.keys if b.element.not_text is None else b.element.not_text[:1]
                inside = b.article and b.element.not_text is None
                for kind, keys, n in [("word", of, b.plain + b.linked)] + [("tag", k, 1) for k in b.tags]:
                    for key in keys:
                        count = seen.setdefault((kind, key), [0, 0])
                        count[0] += n * inside
                        count[1] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in seen], pa.string()), pa.array([k for _, k in seen], pa.string()),
             pa.array([c[0] for c in seen.values()], pa.int64()), pa.array([c[1] for c in seen.values()], pa.int64())],
            ["kind", "key", "inside", "n"])


def fit(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample: int = SAMPLE, keys: int = KEYS) -> Weights:
    """Weights from the pages that mark an article, in a sample of about ``sample`` pages (by hashed id).

    The ``keys`` most frequent keys are kept. Without a labelled page the prior decides alone.
    """
    share = sample / max(pages.count(), 1)
    hashed = F.xxhash64(F.col(id_col), F.lit("main-text")).cast("double") / 2.0 ** 64 + 0.5
    rows = (pages.where(hashed < share).select(F.col(html_col).alias("h"))
            .mapInArrow(_count_batches, "kind string, key string, inside long, n long")
            .groupBy("kind", "key").agg(F.sum("inside").alias("inside"), F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "kind", "key").limit(keys).collect())
    found: dict[str, dict[str, tuple[float, float]]] = {"word": {}, "tag": {}}
    for r in rows:
        found[r["kind"]][r["key"]] = (float(r["inside"]), float(r["n"]))
    return Weights(found["word"], found["tag"])


def _text_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                texts = [main_text(page or "", weights) for page in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    [*part.schema.names[:-1], "text", "n_chars"])
    return run


def extract(pages: DataFrame, weights: Weights, keep: list[str | Column], html_col: str = "html") -> DataFrame:
    """Columns ``keep`` with text (lines of blocks, empty if none) and n_chars (its code points), one row per page.

    A null page counts as empty. Repeated rows and null ids stay as they are; pages of any length are read
    whole, in linear time. An empty table gives an empty result. Unclosed comments and scripts reach to the end, stray
    end tags are ignored. ``keep`` must not name a column text or n_chars; other columns are not read.
    """
    rows = pages.select(*keep, F.col(html_col).alias("_html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    return rows.mapInArrow(_text_batches(shared), f"{fields}, text string, n_chars long")
