"""Main text of web pages from flat text blocks (operator 2).

A page is read once, tag by tag, into flat blocks: text between block-level tags, with its
number of words, its link density, whether it is a heading and what it stands in (an
article, or a menu, footer, form and the like). A block's row also holds the words and the
link density of its neighbours. A decision tree, trained in the driver on the small table
``labelled_pages``, classifies the rows; the blocks it keeps are the text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The elements of HTML.
RAW = ("script", "style", "title", "textarea", "iframe")
#: Elements with markup inside that are left out whole, from the start tag to their own end tag.
SKIPPED = frozenset("noscript template svg math select button object audio video canvas map".split())
FOREIGN = frozenset(("svg", "math"))  # "/>" closes these
LONE = frozenset(("button", "select"))  # a second start tag ends the first
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
BOILER = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "fieldset"))
#: Words in class, id and role attributes that name what is not the article.
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline "
    "comment comments consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus "
    "feedback foot footer form gdpr legal login masthead menu menubar modal nav navbar navigation "
    "newsletter notice notices notification outbrain pagination pager popup promo promoted promotion "
    "recommended related replies reply respond responses search share sharing sidebar signup skyscraper "
    "social sponsor sponsored subscribe subscription taboola toolbar widget widgets complementary alert "
    "alertdialog".split())
HEADER_WORDS = frozenset("header head topbar top".split())
MAIN_WORDS = frozenset("article entry story".split())

_LEX = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:>|\Z)"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<loose>/?[a-zA-Z][^>]*)(?:>|\Z)"  # a tag with a quote that never ends
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I)
_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[a-z]+")

#: ``outside``: the page marks its article, and the block stands outside it.
FEATURES = ("boiler", "outside", "link", "words", "heading",
            "words_before", "link_before", "boiler_before", "words_after", "link_after", "boiler_after")


def _kind(tag: str, attrs: str, inside: tuple[bool, bool]) -> tuple[bool, bool]:
    """(in an article, in boilerplate) inside this element."""
    main, boiler = inside
    names: set[str] = set()
    if attrs:
        for a, b, c in _NAMES.findall(attrs):
            names.update(_WORD.findall((a or b or c).lower()))
        if _HIDDEN.search(attrs):
            boiler = True
    if tag in ("html", "body"):
        return main, boiler
    if tag in MAIN or "main" in names or (names & MAIN_WORDS and tag in ("div", "section", "td")
                                          and not names & BOILER_WORDS):
        # comments are often marked up as articles of their own
        return True, boiler or bool(names & BOILER_WORDS)
    if tag in BOILER or names & BOILER_WORDS or \
            (not main and (tag == "header" or names & HEADER_WORDS)):
        boiler = True
    return main, boiler


def skipped(page: str) -> dict[int, int]:
    """Where skipped elements end, by the place after their start tag. Elements without an
    end tag of their own (self-closed, never closed, or closed by what they stand in) have
    no entry: their start tag stands for nothing, and what follows is read."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    place = 0
    while m := _LEX.search(page, place):
        place = m.end()
        if m["raw"]:
            if not ((opened["svg"] or opened["math"]) and page.endswith("/>", m.start(), place)):
                end = _END[m["raw"].lower()].search(page, place)
                place = end.end() if end else len(page)
            continue
        tag = (m["tag"] or "").lower()
        if tag not in SKIPPED and tag not in BLOCK or tag in VOID:
            continue
        if m["close"] or tag in LONE:
            if opened[tag]:
                while True:
                    name, at = stack.pop()
                    opened[name] -= 1
                    if name == tag:
                        break
                if m["close"] and tag in SKIPPED:
                    ends[at] = place
            if m["close"]:
                continue
        if not (m["attrs"].endswith("/") and (tag in FOREIGN or tag in BLOCK)):
            stack.append((tag, place))
            opened[tag] += 1
    return ends


def blocks(page: str) -> list[tuple[str, int, int, bool, bool, bool]]:
    """The flat blocks of a page: (text, words, words in links, heading, boiler, main)."""
    out: list[tuple[str, int, int, bool, bool, bool]] = []
    stack: list[tuple[str, tuple[bool, bool]]] = []
    inside = (False, False)
    parts: list[str] = []
    linked: list[str] = []
    links = headings = 0
    block_at: list[int] = []  # places of open blocks on the stack
    opened: Counter[str] = Counter()  # open blocks by name
    inline: list[Counter[str]] = [Counter()]  # open inline elements by name, in each open block
    skips: dict[int, int] | None = None

    def flush(heading: bool) -> None:
        nonlocal parts, linked
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                in_links = len(html.unescape(" ".join(linked)).split()) if linked else 0
                out.append((" ".join(words), len(words), min(in_links, len(words)), heading, inside[1], inside[0]))
            parts, linked = [], []

    def close(at: int) -> None:
        nonlocal inside, links, headings
        if stack[at][1] != inside:
            flush(headings > 0)
        for tag, _ in reversed(stack[at:]):
            links -= tag == "a"
            headings -= tag in HEADINGS
            if tag in BLOCK:
                block_at.pop()
                inline.pop()
                opened[tag] -= 1
            else:
                inline[-1][tag] -= 1
        inside = stack[at][1]
        del stack[at:]

    def close_inline(tag: str) -> None:
        # an inline end tag doesn't close a block
        if inline[-1][tag]:
            close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))

    place, n = 0, len(page)
    while place < n:
        m = _LEX.search(page, place)
        text = page[place:m.start()] if m else page[place:]
        if text:
            parts.append(text)
            if links:
                linked.append(text)
        if not m:
            break
        place = m.end()
        if m["raw"]:
            end = _END[m["raw"].lower()].search(page, place)
            place = end.end() if end else n
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            if m["loose"]:
                tag = _WORD.match(m["loose"].lower().lstrip("/"))[0]
                if tag in BLOCK:
                    flush(headings > 0)
            continue
        if tag in SKIPPED:
            if not m["close"]:
                skips = skipped(page) if skips is None else skips
                place = skips.get(place, place)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK:
            flush(headings > 0)
        if m["close"]:
            if tag not in BLOCK:
                close_inline(tag)
            elif opened[tag]:
                close(next(i for i in reversed(block_at) if stack[i][0] == tag))
            continue
        if tag in VOID or m["attrs"].endswith("/"):
            continue
        if tag in BLOCK:
            # a paragraph or item that is still open ends where the next block begins
            name = stack[block_at[-1]][0] if block_at else ""
            if name == "p" or (name == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                close(block_at[-1])
        elif tag == "a" and links:
            close_inline("a")
        if tag in BLOCK or tag in ("a", "span", "b", "i", "em", "strong", "ins"):
            if tag in BLOCK:
                block_at.append(len(stack))
                inline.append(Counter())
                opened[tag] += 1
            else:
                inline[-1][tag] += 1
            stack.append((tag, inside))
            links += tag == "a"
            headings += tag in HEADINGS
            if tag in BLOCK or m["attrs"]:
                kind = _kind(tag, m["attrs"], inside)
                if tag in BLOCK:
                    inside = kind
                elif kind[1] != inside[1]:  # an inline element that is an advert or hidden
                    flush(headings > 0)
                    inside = kind
    flush(headings > 0)
    return out


def features(found: list[tuple]) -> np.ndarray:
    """One row of FEATURES for each block of one page."""
    if not found:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b[1] for b in found], float)
    link = np.array([b[2] for b in found], float) / words
    heading, boiler, main = (np.array([b[i] for b in found], float) for i in (3, 4, 5))
    page_main = np.full(len(found), float((main * (1 - boiler)).any()))
    before = lambda x, edge: np.concatenate(([edge], x[:-1]))
    after = lambda x, edge: np.concatenate((x[1:], [edge]))
    return np.stack((boiler, page_main * (1 - main), link, words, heading,
                     before(words, 0), before(link, 0), before(boiler, 1),
                     after(words, 0), after(link, 0), after(boiler, 1)), axis=1)


# ---- the labelled table --------------------------------------------------------------
_WORDS = ("the committee met on a cold morning and after a long debate it settled the plan for a new bridge "
          "people who live near the river said that they had waited years and hoped work would start soon").split()
#: Words of paragraphs, in turn: articles mix long and short ones.
_LENGTHS = (34, 1, 62, 7, 18, 3, 95, 12, 26, 5)


def labelled_pages() -> list[tuple[str, list[int]]]:
    """The small labelled table: pages of common layouts with paragraphs of many lengths, and
    for each block, in page order, 1 if it belongs to the article, else 0."""
    pages = []
    for turn in range(len(_LENGTHS)):
        size = [_LENGTHS[(turn + i) % len(_LENGTHS)] for i in range(len(_LENGTHS))]
        say = lambda i: " ".join(_WORDS[(turn + i + j) % len(_WORDS)] for j in range(size[i])) + "."
        p = lambda *n: "".join(f"<p>{say(i)}</p>" for i in n)
        link = lambda i: f"<p><a href='/{i}'>{say(i)}</a></p>"
        menu = "".join(f"<li><a href='/{i}'>{' '.join(_WORDS[i:i + 1 + i % 3])}</a></li>" for i in range(4))
        title = f"<h1>{say(9)}</h1>"
        pages += [
            # an article element between menu, advert and footer
            (f"<nav><ul>{menu}</ul></nav><div class='ad'>{say(4)}</div><article>{title}{p(0, 1, 2, 3)}</article>"
             f"<footer>{say(6)}</footer>", [0] * 5 + [1] * 5 + [0]),
            # a main element; what stands outside it is not the article, however long
            (f"<header>{p(1)}</header><main>{title}{p(2, 5)}<aside>{p(0)}</aside><ul><li>{say(3)}</li><li>{say(1)}</li>"
             f"</ul></main>{p(6, 7)}", [0, 1, 1, 1, 0, 1, 1, 0, 0]),
            # inside the article: form, related stories, reader comments
            (f"<div class='cookie-notice'>{say(0)}</div><article>{p(1, 2)}{link(4)}<form>{say(3)}</form>"
             f"<div class='related'>{link(6)}</div><section id='comments'>{p(0, 3)}</section></article>",
             [0, 1, 1, 1, 0, 0, 0, 0]),
            # named divisions only
            (f"<div id='menu'><ul>{menu}</ul></div><div id='content'><h2>{say(9)}</h2>{p(0, 1, 2)}<p>{say(6)} "
             f"<a href='/x'>see here</a></p></div><div id='sidebar'>{p(4)}</div><div class='comments'>{p(0, 7)}</div>",
             [0] * 4 + [1] * 5 + [0] * 3),
            # no names at all: menus and lists of links around text
            (f"<ul>{menu}</ul><h1>{say(9)}</h1>{p(0, 1, 2, 3)}{link(5)}{link(7)}", [0] * 4 + [1] * 5 + [0] * 2),
            (p(0, 1, 2, 3, 4), [1] * 5),
            (p(turn), [1]),
            (f"<table><tr><td class='nav'>{menu}</td><td>{p(2, 1, 0)}</td></tr></table>", [0] * 4 + [1] * 3),
        ]
    return [(f"<html><body>{page}</body></html>", labels) for page, labels in pages]


def labelled_rows(pages: list[tuple[str, list[int]]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The table: feature rows and labels."""
    rows, labels = [], []
    for page, marks in pages or labelled_pages():
        found = blocks(page)
        if len(found) != len(marks):
            raise ValueError(f"{len(found)} blocks, {len(marks)} labels: {page[:60]}")
        rows.append(features(found))
        labels += marks
    return np.concatenate(rows), np.array(labels)


# ---- the tree ------------------------------------------------------------------------
def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 6) -> list[tuple]:
    """A binary tree by Gini impurity, as a list of (feature, threshold, left, right) and
    (-1, class) nodes; rows with feature <= threshold go left."""
    nodes: list[tuple] = []

    def gini(k: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 2 * k * (n - k) / np.maximum(n, 1)

    def grow(rows: np.ndarray, left_depth: int) -> int:
        at = len(nodes)
        nodes.append((-1, int(y[rows].mean() >= 0.5)))
        if left_depth == 0 or y[rows].min() == y[rows].max():
            return at
        best = None
        for f in range(x.shape[1]):
            by = rows[np.argsort(x[rows, f], kind="stable")]
            v, ones = x[by, f], np.cumsum(y[by])
            cuts = np.flatnonzero(v[1:] > v[:-1])
            if not len(cuts):
                continue
            n, k = cuts + 1, ones[cuts]
            cost = gini(k, n) + gini(ones[-1] - k, len(by) - n)
            c = int(np.argmin(cost))
            if best is None or cost[c] < best[0] - 1e-12:
                best = (cost[c], f, (v[cuts[c]] + v[cuts[c] + 1]) / 2)
        if best is None:
            return at
        _, f, threshold = best
        goes = x[rows, f] <= threshold
        nodes[at] = (f, threshold, grow(rows[goes], left_depth - 1), grow(rows[~goes], left_depth - 1))
        return at

    grow(np.arange(len(y)), depth)
    return nodes


def classify(tree: list[tuple], x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), bool)
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        node = tree[at]
        if node[0] < 0:
            out[rows] = bool(node[1])
        elif len(rows):
            goes = x[rows, node[0]] <= node[1]
            todo += [(node[2], rows[goes]), (node[3], rows[~goes])]
    return out


def main_text(page: str | None, tree: list[tuple]) -> str:
    found = blocks(page or "")
    keep = classify(tree, features(found))
    return " ".join(b[0] for b, k in zip(found, keep) if k)


# ---- on Spark ------------------------------------------------------------------------
def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            labelled: list[tuple[str, list[int]]] | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty page, or one without kept blocks, gives an empty text. Broken markup
    (unclosed tags, quotes, comments) is read as far as it goes. Repeated rows give
    repeated results; null ids and urls are carried through; other columns are not read.
    """
    tree = train_tree(*labelled_rows(labelled))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), tree) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    schema = T.StructType([T.StructField("page_id", rows.schema["page_id"].dataType),
                           T.StructField("url", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return rows.withColumn("url", F.col("url").cast("string")).mapInArrow(run, schema)
