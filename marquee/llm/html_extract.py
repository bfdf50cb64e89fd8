"""Main text of web pages by a linear-chain conditional random field.

A page is read into its leaf blocks: runs of text under one path of block
elements, in page order, with scripts, styles, markup and comments left out, and
what pages show as graphics or controls (svg, button, select) or not at all
(template, noscript, iframe, textarea).  Text in math and object is text.
Each block has features from its ancestors (tags, words of class, id and role, kinds)
and from its text (length, links, punctuation, place).  A chain over the blocks
with two labels, main and rest, is trained on labelled pages (those of
``html_pages``, or any other) by its exact likelihood gradient, and
decoded by Viterbi.  The blocks labelled main, joined by line feeds, are the
page's text.  Names of classes count by the kind of furniture they stand for (lists
of words in several languages), and the innermost element that means something
counts on its own, so an aside or a form inside an article is not the article.

Training is a few seconds of numpy on a fixed set; extraction runs page by page
inside tasks and needs no shuffle, so a lost executor costs its pages only.

Defined cases: null and empty pages give an empty text; broken markup closes
where the next block element or end tag says so (an svg, button, select, template
or noscript left open ends with the block around it at the latest), and unclosed
comments, scripts, styles and tags run to the end; a null url stays null; repeated rows give repeated
results; pages of any length are read whole; an empty table gives no rows;
other columns are dropped unless carried.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import common
from marquee.llm.html_pages import CONTENT, KIND_OF, LABELLED_PAGES, written_pages
from marquee.llm.language_id import Field

# HTML's elements by their part in the page.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table
tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe textarea".split())             # no markup inside
HIDING = frozenset("noscript template svg select button".split())   # markup inside, all of it left out
CONTROLS = {t: re.compile(rf"<(/?){t}(?![^\s/>])", re.I) for t in ("select", "button")}
# HTML's list of the start tags that end an svg left open, and the svg elements that hold HTML
ENDS_SVG = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li
listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
HTML_IN_SVG = frozenset("foreignobject desc title".split())
CLOSES_P = BLOCK - {"body", "html", "head"}
SAME_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}}
HOLDS = frozenset("ul ol menu dl table article section div main aside nav header footer form body".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
                   re.S)
ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([\w-]+)")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SPACE = re.compile(r"\s+")
LABELS = ("rest", "main")
MEANS = frozenset("article main aside nav form footer header".split())
WRITTEN = 240                                                       # pages written for training, besides the labelled ones


class Block:
    """One leaf block: its path of (tag, features, marks), text and linked characters."""
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple, text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def attributes(raw: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def element(tag: str, raw: str) -> tuple[str, tuple[str, ...], str]:
    """(tag, feature names, mark) of a start tag."""
    if not raw.strip(" \t\r\n/"):
        return tag, (f"tag={tag}",), ""
    a = attributes(raw)
    names = {w for k in ("class", "id", "role") for w in map(str.lower, NAME_PART.findall(a.get(k, "")))}
    hidden = "hidden" in a or "display:none" in a.get("style", "").replace(" ", "").lower()
    mark = "main" if "data-main" in a else "rest" if "data-rest" in a else ""
    return tag, (f"tag={tag}", *sorted(f"name={n}" for n in names), *(["hidden"] if hidden else [])), mark


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple] = []                # open block elements
    hidden: list[str] = []                 # an open HIDING element, and the elements open inside it
    loose = False                          # that element is a control without an end tag
    text: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if text:
            words = SPACE.sub(" ", html.unescape("".join(text))).strip()
            if words and not any(e[0] in ("head", "title") for e in stack):
                out.append(Block(tuple(stack), words, linked))
            text.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            if not hidden:
                text.append(page[at:])
            break
        if m.start() > at and not hidden:
            text.append(page[at:m.start()])
            linked += in_link * (m.start() - at)
        at = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            continue
        empty = not m[1] and m[3].endswith("/") and (tag == "svg" or hidden[-1:] == ["svg"])
        if not m[1] and tag in ENDS_SVG:
            while hidden[-1:] == ["svg"]:
                hidden.pop()
        if hidden and (loose and not m[1] and (tag in BLOCK or tag == hidden[0])
                       or m[1] and tag not in hidden and any(e[0] == tag for e in stack)):
            hidden.clear()                 # the next block, or the end of the block around it
        if not m[1] and tag in RAW:
            # skipped whole, up to its own end tag; a script or style without one runs to the end
            close = None if empty else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else end if tag in ("script", "style") and not empty else at
            text.append(" ")
        elif hidden:
            if m[1]:
                if tag in hidden:
                    del hidden[len(hidden) - 1 - hidden[::-1].index(tag):]
            elif not empty and (tag in HIDING or tag in HTML_IN_SVG or tag in BLOCK - VOID):
                hidden.append(tag)
        elif tag in HIDING:
            text.append(" ")
            if not m[1] and not empty:
                hidden.append(tag)
                after = CONTROLS[tag].search(page, at) if tag in CONTROLS else None
                loose = tag in CONTROLS and not (after and after[1])
        elif tag == "a":
            in_link = not m[1]
        elif tag == "br":
            text.append(" ")
        elif tag in BLOCK:
            flush()
            if m[1]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            else:
                if tag in CLOSES_P and stack and stack[-1][0] == "p":
                    stack.pop()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in SAME_KIND.get(tag, ()):
                        del stack[i:]
                        break
                    if stack[i][0] in HOLDS:
                        break
                if tag not in VOID:
                    stack.append(element(tag, m[3]))
            in_link = False
    flush()
    return out


def sense(e: tuple) -> tuple[str, ...]:
    """What an element says of its contents: its tag where that means something,
    and the kinds of furniture, or main text, that its names stand for."""
    tag = (f"<{e[0]}>",) if e[0] in MEANS else ()
    names = [f[5:] for f in e[1] if f.startswith("name=")]
    kinds = {kind_of(n) for n in names} - {None}
    return (*tag, *sorted(kinds))


def kind_of(name: str) -> str | None:
    """The kind of a name, or of the longest listed word of five letters or more that it begins with."""
    if name in KIND_OF or name in CONTENT:
        return KIND_OF.get(name, "content")
    stem = max((w for w in (*KIND_OF, *CONTENT) if len(w) > 4 and name.startswith(w)), key=len, default=None)
    return KIND_OF.get(stem, "content") if stem else None


def path_features(path: tuple) -> list[str]:
    """The path's tags and names, and its senses: every one that occurs, and the
    innermost, with whether it lies inside an article or main text."""
    own = path[-1][0] if path else "none"
    names = {f for e in path for f in e[1]}
    senses = [sense(e) for e in path]
    said = {s for e in senses for s in e}
    inner, within = (), False
    for s in senses:
        if s:
            inner, within = s, within or bool({"<article>", "<main>", "content"} & set(inner))
    return [f"own={own}", *sorted(names), *sorted(f"sense={s}" for s in said),
            *[f"inner={s}{' within' * within}" for s in inner]]


def text_features(b: Block, place: int, n: int) -> list[str]:
    words = b.text.count(" ") + 1
    size = "1" if words < 4 else "2" if words < 11 else "3" if words < 31 else "4"
    links = b.linked / max(1, len(b.text))
    f = [f"words={size}", f"links={'none' if not links else 'some' if links < 0.5 else 'most'}",
         f"end={'stop' if b.text[-1] in '.!?:\"”»…' else 'open'}"]
    if "©" in b.text or "rights reserved" in b.text.lower():
        f.append("copyright")
    if place == 0:
        f.append("first")
    if place == n - 1:
        f.append("last")
    return f


class BlockModel:
    """Linear-chain CRF over the blocks of a page."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, step: np.ndarray, start: np.ndarray):
        self.names, self.emit, self.step, self.start = names, emit, step, start
        self.by_path: dict[tuple, np.ndarray] = {}

    def scores(self, page: list[Block]) -> np.ndarray:
        get, out = self.names.get, np.zeros((len(page), 2))
        for i, b in enumerate(page):
            key = tuple(e[:2] for e in b.path)
            own = self.by_path.get(key)
            if own is None:
                if len(self.by_path) > 50_000:
                    self.by_path.clear()
                k = [j for f in path_features(b.path) if (j := get(f)) is not None]
                own = self.by_path[key] = self.emit[k].sum(axis=0)
            k = [j for f in text_features(b, i, len(page)) if (j := get(f)) is not None]
            out[i] = own + self.emit[k].sum(axis=0)
        return out

    def decode(self, page: list[Block]) -> list[int]:
        """The best label sequence (Viterbi)."""
        if not page:
            return []
        s = self.scores(page).tolist()
        (a, b), (c, d) = self.step.tolist()
        v0, v1 = s[0][0] + self.start[0], s[0][1] + self.start[1]
        back = []
        for e0, e1 in s[1:]:
            f0, f1 = v0 + a < v1 + c, v0 + b < v1 + d
            back.append((f0, f1))
            v0, v1 = (v1 + c if f0 else v0 + a) + e0, (v1 + d if f1 else v0 + b) + e1
        label = int(v1 > v0)
        out = [label]
        for f in reversed(back):
            label = int(f[label])
            out.append(label)
        return out[::-1]

    def text(self, page: str | None) -> str:
        found = blocks(page or "")
        return "\n".join(b.text for b, y in zip(found, self.decode(found)) if y)


def marked(b: Block) -> int:
    """The label of a training block: its nearest mark."""
    return int(next((e[2] for e in reversed(b.path) if e[2]), "rest") == "main")


def train(pages: list[str] | None = None, rounds: int = 200, rate: float = 0.5, l2: float = 0.01) -> BlockModel:
    """Gradient ascent (AdaGrad) on the exact conditional log-likelihood of labelled pages."""
    parsed = [p for p in map(blocks, LABELLED_PAGES + written_pages(WRITTEN) if pages is None else pages) if p]
    feats = [path_features(b.path) + text_features(b, i, len(p)) for p in parsed for i, b in enumerate(p)]
    names: dict[str, int] = {}
    for f in (f for b in feats for f in b):
        names.setdefault(f, len(names))
    x = np.zeros((len(feats), len(names)), dtype=np.float32)
    for i, b in enumerate(feats):
        x[i, [names[f] for f in b]] = 1
    y = np.array([marked(b) for p in parsed for b in p])
    n = np.array([len(p) for p in parsed])
    begin = np.cumsum(n) - n
    follows = np.ones(len(y), dtype=bool)
    follows[begin] = False
    turns = np.zeros((2, 2))
    np.add.at(turns, (y[:-1][follows[1:]], y[1:][follows[1:]]), 1)
    w = {"emit": np.zeros((len(names), 2)), "step": np.zeros((2, 2)), "start": np.zeros(2)}
    seen = {k: np.full_like(v, 1e-6) for k, v in w.items()}
    for _ in range(rounds):
        own, steps = Field(list(LABELS), w["emit"], w["step"], w["start"]).marginals(x @ w["emit"], begin, n)
        own = -own
        own[np.arange(len(y)), y] += 1
        for k, g in (("emit", x.T @ own), ("step", turns - steps), ("start", own[begin].sum(axis=0))):
            g = g - l2 * w[k]
            seen[k] += g * g
            w[k] += rate * g / np.sqrt(seen[k])
    return BlockModel(names, w["emit"], w["step"], w["start"])


def extracted(model):
    """(html column last) to the carried columns, text and n_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = BlockModel(*model.value)
        for b in batches:
            out = [m.text(x.as_py()) for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                [*b.schema.names[:-1], "text", "n_chars"])
    return run


def extract(pages: DataFrame, carry: list[str] | None = None, model: BlockModel | None = None) -> DataFrame:
    """``carry`` columns, text and n_chars of every page."""
    pages = common.drop_clashes(pages, ["text", "n_chars"])
    carry = carry or ["page_id", "url"]
    m = model or train()
    shared = pages.sparkSession.sparkContext.broadcast((m.names, m.emit, m.step, m.start))
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in carry)
    return pages.select(*[F.col(f"`{c}`") for c in carry], "html").mapInArrow(
        extracted(shared), f"{schema}, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
