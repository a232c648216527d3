"""Main text of web pages, by a graphical model over the tree of each page.

Block elements are the variables: content or not. An element's own potential follows from
what it is (tag, words of class, id and role, links and length of its own text), and a
potential between parent and child from how often they agree. Sum-product messages go from
the leaves to the root and back, which gives every element the marginal probability of being
content given the whole page. Both potentials are counted, by Spark, over labelled pages: the
layouts of ``layouts.py``, and pages of the table that mark their article themselves (at most
``SAMPLE`` of them, those with the least hash of their id and url).

Definitions. Null, empty and markup-free pages: markup-free text is one block of the root,
which is judged like any other. A block is the text between two boundaries of block elements; ``br``
is white space. All white space inside a block becomes one space. Scripts, styles, comments,
form controls and the head are dropped when the page is read. Tags that are never closed end
with their parent. Of the dropped elements, scripts, styles, textareas and titles that are never
closed go on to the end of the page; others end with the block that they are in or where the next
one begins. The head ends at the first text or element that cannot be in it. Nothing is cut off.
Repeated pages are handled one by one.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layouts import labelled_pages
from .columns import any_names
from .words import column

SAMPLE = 512
THRESHOLD = 0.5
#: How often a layout counts, next to a page of the table.
LAYOUT_WEIGHT = 8.0
#: A child differs from its parent with this probability at least, however rarely it was seen to.
LEAST_CHANGE = 0.02
#: What is added to the count of each feature.
SMOOTHING = 0.1

#: Elements whose content is text up to their end tag, or to the end of the page.
_RAW = {name: re.compile(rf"</{name}(?=[\t\n\f\r />])[^>]*(?:>|\Z)", re.I) for name in ("script", "style", "textarea", "title")}
#: Elements that are dropped with their content.
_DROPPED = frozenset("template noscript select button svg iframe object".split())
#: Elements that may be in the head; others end it.
_IN_HEAD = frozenset("head base basefont bgsound link meta noframes noscript template".split())
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\t\n\f\r />]*+)((?:"[^"]*"|'[^']*'|[^>"'])*)>|<(/?)([a-zA-Z][^\t\n\f\r />]*+)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""",
    re.S,
)
#: A slash at the end of a tag that is part of an attribute's value.
_SLASH_OF_VALUE = re.compile(r"""=\s*[^\s"'>]*/\Z""")
_HINTS = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
#: Elements that begin and end blocks of text (fixed values of HTML), and the labels of layouts.
BLOCKS = frozenset(
    "html body article section nav aside header footer main address div p pre blockquote ul ol li dl dt dd figure figcaption"
    " table thead tbody tfoot tr td th caption form fieldset h1 h2 h3 h4 h5 h6 hr details summary dialog center menu search y0 y1".split()
)
#: Elements whose children may be either, whatever they are themselves.
ROOTS = frozenset(("html", "body"))
#: Elements that are ended by the start of others.
_ENDED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_INLINE_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Elements that mark an article, and parts that aren't of it, for labelling pages of the table.
_MARKED, _OUTSIDE = frozenset({"article", "main"}), frozenset("nav aside footer form".split())


def _tokens(source: str) -> tuple[list[tuple], dict[int, int]]:
    """Tags and what is dropped whole: (begin, end, name or None, closing, attributes); and where dropped elements are closed.

    Blocks and dropped elements are tracked as they open; those that are still open when an
    element around them is closed were never closed themselves.
    """
    tokens: list[tuple] = []
    closed: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    open_: Counter = Counter()

    def ended(name: str) -> int:
        """The token that opened the innermost ``name``, which ends with all in it."""
        last = None
        while last != name:
            last, token = stack.pop()
            open_[last] -= 1
        return token

    m = _TOKEN.search(source)
    while m:
        end, name = m.end(), m[2] or m[5]
        if name is None:
            tokens.append((m.start(), end, None, False, ""))
            m = _TOKEN.search(source, end)
            continue
        name, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        foreign = open_["svg"] and next(x for x, _ in reversed(stack) if x in ("svg", "foreignobject")) == "svg"
        if foreign and not closing and name in BLOCKS:  # a page's own elements end a drawing
            ended("svg")
            foreign = False
        if name in _RAW and not closing and not foreign:
            last = _RAW[name].search(source, end)
            end, name = last.end() if last else len(source), None
        elif closing:
            if open_[name] > 0:
                token = ended(name)
                if name in _DROPPED:
                    closed[token] = len(tokens)
        elif name == "svg" and attributes.endswith("/") and not _SLASH_OF_VALUE.search(attributes):
            name = None  # an empty drawing
        elif name in BLOCKS or name in _DROPPED or (foreign and name == "foreignobject"):
            stack.append((name, len(tokens)))
            open_[name] += 1
        tokens.append((m.start(), end, name, closing, attributes))
        m = _TOKEN.search(source, end)
    return tokens, closed


class Page:
    """The block elements of a page in order, each after its parent, and its blocks of text."""

    def __init__(self, source: str):
        self.parent, self.tag, self.hints = [-1], ["html"], [()]
        self.size, self.linked = [0], [0]
        self.blocks: list[tuple[int, str]] = []
        self._pieces: list[str] = []
        stack, links, at, head = [(0, "html")], 0, 0, False
        tokens, closed = _tokens(source)
        dropped, t = None, 0  # an element never closed, with which text is dropped; the next token
        while t < len(tokens):
            begin, end, name, closing, attributes = tokens[t]
            if begin > at and not dropped:
                head = head and source[at:begin].isspace()
                if not head:
                    self._text(stack[-1][0], source[at:begin], links)
            at, t = end, t + 1
            if name is None:
                continue
            if name == "head":
                head, dropped = not closing, None
                continue
            if head and not closing and name not in _IN_HEAD and name != "html":
                head = False
            if name in BLOCKS:
                dropped = None
            elif name in _DROPPED:
                if not closing:
                    dropped = None if dropped == name else dropped
                    if t - 1 in closed:
                        t = closed[t - 1] + 1
                        at = tokens[t - 1][1]
                    else:
                        dropped = name
                continue
            elif dropped:
                continue
            if name == "a":
                links = 0 if closing else 1
            elif name == "br":
                self._text(stack[-1][0], " ", links)
            if name not in BLOCKS:
                continue
            self._flush(stack[-1][0])
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][1] == name:
                        del stack[i:]
                        break
                links = 0
                continue
            if name == "html":
                continue
            if len(stack) > 1 and stack[-1][1] in _INLINE_BLOCKS and name not in ("y0", "y1"):
                stack.pop()  # paragraphs and headings hold no blocks
            ended = _ENDED.get(name)
            if ended and len(stack) > 1 and stack[-1][1] in ended:
                stack.pop()
            if name == "hr":
                continue
            self.parent.append(stack[-1][0])
            self.tag.append(name)
            found = _HINTS.findall(attributes)
            self.hints.append(tuple({w for x in found for w in _WORD.findall(x.lower())}))
            self.size.append(0)
            self.linked.append(0)
            stack.append((len(self.tag) - 1, name))
        if at < len(source) and not dropped and not (head and source[at:].isspace()):
            self._text(stack[-1][0], source[at:], links)
        self._flush(stack[-1][0])

    def _text(self, node: int, raw: str, linked: int) -> None:
        self._pieces.append(raw)
        n = len(raw) if not raw.isspace() else 0
        self.size[node] += n
        self.linked[node] += linked * n

    def _flush(self, node: int) -> None:
        if self._pieces:
            text = " ".join(entities.unescape("".join(self._pieces)).split())
            if text:
                self.blocks.append((node, text))
            self._pieces = []

    def features(self, i: int) -> list[str]:
        size = self.size[i]
        own = "none" if not size else "links" if 2 * self.linked[i] > size else "short" if size < 60 else "long"
        return ["tag " + self.tag[i], "text " + own, *("hint " + h for h in self.hints[i])]

    def labels(self) -> list[int | None]:
        """What the layout's marks say of each element."""
        out: list[int | None] = []
        for tag, parent in zip(self.tag, self.parent, strict=True):
            up = out[parent] if parent >= 0 else None
            out.append(int(tag[1]) if tag in ("y0", "y1") else up)
        return out

    def own_labels(self) -> list[int | None]:
        """What a page's own elements say, if it marks one article."""
        if sum(t in _MARKED for t in self.tag) != 1:
            return [None] * len(self.tag)
        out: list[int | None] = []
        for tag, parent in zip(self.tag, self.parent, strict=True):
            out.append(0 if tag in _OUTSIDE else 1 if tag in _MARKED else out[parent] if parent >= 0 else 0)
        return out


def counts(page: Page, labels: list[int | None]) -> Counter:
    """(what, name, label) of a page's labelled elements."""
    found: Counter = Counter()
    for i, y in enumerate(labels):
        if y is None or page.tag[i] in ("y0", "y1"):
            continue
        found["all", "", y] += 1
        for f in page.features(i):
            found["own", f, y] += 1
        up = page.parent[i]
        if up >= 0 and page.tag[up] not in ("y0", "y1"):
            found["pair", "root" if page.tag[up] in ROOTS else str(labels[up] or 0), y] += 1
    return found


class Model:
    """Potentials from counts, smoothed."""

    def __init__(self, found: dict[tuple[str, str, int], float]):
        total = [found.get(("all", "", y), 0) + 1 for y in (0, 1)]
        names = {name for what, name, _ in found if what == "own"}
        self.own = {f: [math.log((found.get(("own", f, y), 0) + SMOOTHING) / (total[y] + 1)) for y in (0, 1)] for f in names}
        self.pair = []
        for up in ("0", "1", "root"):
            n = [found.get(("pair", up, y), 0) + 1 for y in (0, 1)]
            self.pair.append([min(max(x / sum(n), LEAST_CHANGE), 1 - LEAST_CHANGE) for x in n])

    def marginals(self, page: Page) -> list[float]:
        """The probability of being content for each element, by messages up and down the tree."""
        n, pair, parent = len(page.tag), self.pair, page.parent
        a, b = [1.0] * n, [1.0] * n  # own potential times messages from the children
        for i in range(n):
            odds = 0.0
            for f in page.features(i):
                own = self.own.get(f)
                if own:
                    odds += own[1] - own[0]
            odds = max(-20.0, min(20.0, odds))
            a[i], b[i] = 1 / (1 + math.exp(odds)), 1 / (1 + math.exp(-odds))
        up0, up1 = [1.0] * n, [1.0] * n
        for i in range(n - 1, 0, -1):
            s = a[i] + b[i]
            x, y = a[i] / s, b[i] / s
            p = parent[i]
            q0, q1 = (pair[2], pair[2]) if page.tag[p] in ROOTS else (pair[0], pair[1])
            m0, m1 = q0[0] * x + q0[1] * y, q1[0] * x + q1[1] * y
            up0[i], up1[i] = m0, m1
            a[p], b[p] = a[p] * m0, b[p] * m1
            if a[p] + b[p] < 1e-200:
                a[p], b[p] = a[p] * 1e200, b[p] * 1e200
        for i in range(1, n):
            p = parent[i]
            x, y = a[p] / up0[i], b[p] / up1[i]
            s = x + y
            x, y = x / s, y / s
            q0, q1 = (pair[2], pair[2]) if page.tag[p] in ROOTS else (pair[0], pair[1])
            a[i], b[i] = a[i] * (x * q0[0] + y * q1[0]), b[i] * (x * q0[1] + y * q1[1])
            s = a[i] + b[i]
            a[i], b[i] = a[i] / s, b[i] / s
        return [y / (x + y) for x, y in zip(a, b, strict=True)]

    def text(self, source: str) -> str:
        page = Page(source)
        if len(page.tag) == 1:  # no element holds the text, so it is all there is
            return "\n".join(text for _, text in page.blocks)
        content = self.marginals(page)
        return "\n".join(text for node, text in page.blocks if content[node] > THRESHOLD)


def _counted(batches: Iterator[pa.RecordBatch], own: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for source in column(batch, "html").to_pylist():
            page = Page(source or "")
            found += counts(page, page.own_labels() if own else page.labels())
        rows = [(*k, v * (1.0 if own else LAYOUT_WEIGHT)) for k, v in found.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.float64())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["what", "name", "y", "n"])


def fit(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """Potentials counted over the layouts and a bounded sample of the pages that mark their article."""
    spark, kind = pages.sparkSession, "what string, name string, y int, n double"
    layouts = spark.createDataFrame([(x,) for x in labelled_pages()], "html string").mapInArrow(lambda b: _counted(b, False), kind)
    texts = pages.select(F.col("html").cast("string").alias("html"), F.xxhash64("page_id", "url").alias("h"))
    marked = texts.filter("html rlike '(?i)<(article|main)'")
    # Only hashes are sorted; the pages of the least ones are then counted where they are, one for each hash.
    last = marked.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    some = marked.filter(F.col("h") <= F.lit(last)).groupBy("h").agg(F.min("html").alias("html")).select("html")
    every = layouts.unionByName(some.mapInArrow(lambda b: _counted(b, True), kind))
    rows = every.groupBy("what", "name", "y").agg(F.sum("n").alias("n")).collect()  # as many as words in the sample's attributes
    return Model({(r["what"], r["name"], r["y"]): r["n"] for r in rows})


def _extracted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [model.text(x or "") for x in column(batch, "html").to_pylist()]
        yield pa.record_batch([column(batch, "row"), pa.array(texts, pa.string())], ["row", "text"])


@any_names("page_id", "url", "html")
def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``row`` (``pages`` without html) and text: one row for each page."""
    model = fit(pages, sample)
    row = F.struct(*(pages[c] for c in pages.columns if c != "html"))
    whole = pages.select(row.alias("row"), F.col("html").cast("string").alias("html"))
    kind = whole.schema["row"].dataType.simpleString()
    return whole.mapInArrow(lambda b: _extracted(b, model), f"row {kind}, text string")
