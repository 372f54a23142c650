"""The main text of web pages: flat text blocks, classified by a decision tree.

A page is read once into blocks, the text between tags that break lines. A block is described by its
words, the share of them inside links, the same of its neighbours, and where it stands: in an
article, beside one, or in a part that markup names as none. A tree trained on a small labelled table
of such blocks says which are main text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
# Their content is no text of the page: of the first not even tags, of the others tags do count.
RAW = frozenset("script style iframe textarea title".split())
UNREAD = frozenset("noscript template svg math object canvas select button audio video".split())
# Parts that are no article.
ASIDE = frozenset("nav footer aside form dialog menu head".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
# Words of class names and ids that name such parts.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notification alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
    "comment comments commentlist respond reply replies disqus share sharing social related recommended "
    "newsletter subscribe subscription signup login popup modal overlay widget toolbar pagination pager "
    "copyright".split()
)
# Elements that hold a whole page: what their class names say is true of parts of it.
WHOLE = frozenset("html body main".split())

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)>""",
    re.DOTALL,
)
# What TAG finds where no ">" follows: a tag is not among it, and looking for the end of each would read
# the rest of the page again and again.
UNENDED = re.compile(r"<(?:!--|[!?]).*", re.DOTALL)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PIECES = re.compile(r"[^a-z0-9]+")
WITHOUT = re.compile(r"\b(?:no|without|hide|hidden)[-_][a-z0-9]+")

# Where a block stands, the more likely main text the higher: in a part that is no article, beside an
# article, on a page without one, in one.
OTHER, BESIDE, PLAIN, ARTICLE = range(4)
#: Markup that leaves out so many times the running text it holds, as an article with a teaser does, is
#: not followed; words and links decide there, and always inside a `main` without such an article.
MUCH = 2


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    place: int


def _names_aside(name: str, attributes: str, whole: bool) -> bool:
    """Whether an element is named as a part that is no article. Of an article that stands in no other
    (`whole`) only whole names count: parts of them say what it has or is about ("comments-open",
    "share-prices"), as does what follows a "no" in any name ("no-sidebar")."""
    if "=" not in attributes:
        return False
    for match in NAMED.finditer(attributes):
        kind, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
        if kind == "role":
            if value.strip() in ASIDE_ROLES:
                return True
        elif name not in WHOLE:
            words = value.split() if whole else PIECES.split(WITHOUT.sub(" ", value))
            if not ASIDE_WORDS.isdisjoint(words):
                return True
    return False


def _tags(html: str) -> Iterator[tuple[str, re.Match | None]]:
    """Each tag with the text before it, then what is left with None. The content of RAW is passed over."""
    at, last = 0, html.rfind(">")
    while at <= last and (match := TAG.search(html, at)):
        yield html[at : match.start()], match
        at = match.end()
        if match[2] and not match[1] and match[2].lower() in RAW and not match[3].endswith("/"):
            end = re.compile(rf"</{re.escape(match[2])}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
    rest = UNENDED.search(html, at)
    yield html[at : rest.start() if rest else len(html)], None


def _closed(html: str) -> set[int]:
    """Where the UNREAD elements start that have a closing tag; it is that of the last one opened."""
    opened: dict[str, list[int]] = {name: [] for name in UNREAD}
    closed = set()
    for _, match in _tags(html):
        starts = opened.get(match[2].lower()) if match and match[2] else None
        if starts is None:
            continue
        if not match[1]:
            if not match[3].endswith("/"):
                starts.append(match.start())
        elif starts:
            closed.add(starts.pop())
    return closed


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order, those without text left out.

    Tags may be missing, wrong or cut off: a closing tag ends all that was opened inside its element,
    one that nothing opened is passed over, and what is open at the end of the page ends there. An
    UNREAD element that is never closed ends before the next block.
    """
    found: list[list] = []
    stack: list[tuple[str, str]] = []  # (element, what it is: "", "article", "main", "aside", "unread" or "unclosed")
    inside = {"": 0, "article": 0, "main": 0, "aside": 0, "unread": 0, "unclosed": 0}
    names: Counter[str] = Counter()  # elements in the stack
    text: list[str] = []
    linked_text: list[str] = []
    link = False
    part: int | None = None  # where in the stack the outermost UNREAD element is
    closed: set[int] | None = None

    def end_block() -> None:
        if not text:
            return
        words = unescape("".join(text)).split()
        if words:
            linked = len(unescape("".join(linked_text)).split())
            place = "aside" if inside["aside"] else "article" if inside["article"] else "main" if inside["main"] else ""
            found.append([" ".join(words), len(words), min(linked, len(words)), place])
        text.clear()
        linked_text.clear()

    def close(depth: int) -> None:
        nonlocal part
        while len(stack) > depth:
            name, kind = stack.pop()
            names[name] -= 1
            inside[kind] -= 1
        if part is not None and part >= depth:
            part = None

    def enter(name: str, kind: str) -> None:
        stack.append((name, kind))
        names[name] += 1
        inside[kind] += 1

    def opened(name: str) -> int | None:
        if not names[name]:
            return None
        return next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)

    for piece, match in _tags(html):
        if piece and part is None:
            text.append(piece)
            if link:
                linked_text.append(piece)
        if not match or match[2] is None:
            continue
        closing, name, attributes = match[1], match[2].lower(), match[3]
        if name in UNREAD:
            if closing:
                depth = opened(name) if part is not None else None
                if depth is not None:
                    close(depth)
            elif not attributes.endswith("/"):
                closed = _closed(html) if closed is None else closed
                part = len(stack) if part is None else part
                enter(name, "unread" if match.start() in closed else "unclosed")
            continue
        if part is not None and name in BLOCKS and stack[part][1] == "unclosed":
            close(part)
        if part is not None:
            if name == "a" and closing:
                link = False
            if name not in BLOCKS or name in VOID:
                continue
            if not closing:
                enter(name, "")
                continue
            depth = opened(name)
            if depth is None or depth > part:
                close(len(stack) if depth is None else depth)
                continue
        if name in RAW and not closing:
            if name == "title":
                end_block()
        elif name == "a":
            link = not closing
            if link and linked_text:
                linked_text.append(" ")
        elif name == "br":
            text.append(" ")
            if link:
                linked_text.append(" ")
        elif name in BLOCKS:
            end_block()
            if closing:
                depth = opened(name)
                if depth is not None:
                    close(depth)
                continue
            if stack and stack[-1][0] == "p":
                close(len(stack) - 1)
            if name == "body" and stack and stack[-1][0] == "head":
                close(len(stack) - 1)
            if name in VOID:
                continue
            if name in ASIDE or (name == "header" and not inside["article"]) or _names_aside(
                name, attributes, name == "article" and not inside["article"]
            ):
                kind = "aside"
            else:
                kind = name if name in ("article", "main") else ""
            enter(name, kind)
    end_block()
    running = dict.fromkeys(("", "article", "main", "aside"), 0)
    for _, n, linked, place in found:
        running[place] += n - linked
    places = dict.fromkeys(running, PLAIN) | {"aside": OTHER}
    if running["article"] and running[""] + running["main"] <= MUCH * running["article"]:
        places |= {"article": ARTICLE, "main": BESIDE, "": BESIDE}
    elif running["main"] and running[""] <= MUCH * (running["main"] + running["article"]):
        places[""] = BESIDE
    return [Block(t, n, linked, places[place]) for t, n, linked, place in found]


FEATURES = ("words", "link density", "words before", "link density before", "words after", "link density after", "standing")


def describe(rows: list[tuple[int, int, int]]) -> np.ndarray:
    """Features of the blocks of one page, given as (words, linked words, place).

    Before the first and after the last stands a block of no words.
    """
    table = np.zeros((len(rows) + 2, 2))
    table[1:-1] = [(words, linked / max(words, 1)) for words, linked, _ in rows]
    standing = np.array([[place] for _, _, place in rows])
    return np.hstack([table[1:-1], table[:-2], table[2:], standing])


# The labelled table: pages as blocks of (words, linked words, place, main text or not).
LABELLED: tuple[tuple[tuple[int, int, int, int], ...], ...] = (
    # An article with its menu, an advert and a footer.
    ((1, 1, 0, 0), (1, 1, 0, 0), (2, 2, 0, 0), (11, 0, 0, 0), (9, 0, 3, 1), (64, 0, 3, 1), (1, 0, 3, 1), (120, 3, 3, 1), (12, 0, 0, 0)),
    ((1, 1, 0, 0), (45, 0, 0, 0), (12, 0, 3, 1), (5, 0, 3, 1), (3, 3, 3, 1), (35, 10, 3, 1), (8, 0, 0, 0)),
    # A long advert and long comments around a short article; lists of links inside it.
    ((90, 2, 0, 0), (6, 0, 3, 1), (2, 0, 3, 1), (4, 4, 3, 1), (5, 5, 3, 1), (60, 0, 0, 0), (75, 0, 0, 0), (20, 4, 0, 0)),
    ((2, 2, 0, 0), (3, 0, 3, 1), (8, 0, 3, 1), (5, 5, 3, 1), (2, 0, 3, 1), (4, 4, 3, 1), (1, 0, 3, 1), (12, 12, 3, 1)),
    # What stands beside an article.
    ((30, 0, 1, 0), (8, 0, 3, 1), (200, 5, 3, 1), (25, 0, 1, 0), (6, 6, 1, 0)),
    ((3, 3, 1, 0), (1, 0, 3, 1), (40, 0, 3, 1), (50, 0, 1, 0), (10, 0, 1, 0)),
    # No article is marked: words and links tell, and a short block goes with its neighbours.
    ((2, 2, 2, 0), (3, 3, 2, 0), (7, 0, 2, 1), (85, 2, 2, 1), (60, 0, 2, 1), (4, 0, 2, 1), (70, 1, 2, 1), (3, 3, 2, 0), (4, 4, 2, 0)),
    ((1, 1, 2, 0), (2, 1, 2, 0), (3, 3, 2, 0), (30, 0, 2, 1), (18, 0, 2, 1), (25, 3, 2, 1), (6, 5, 2, 0), (5, 5, 2, 0)),
    ((5, 5, 2, 0), (9, 0, 2, 1), (110, 4, 2, 1), (40, 36, 2, 0), (22, 20, 2, 0), (3, 2, 2, 0)),
    ((4, 4, 0, 0), (50, 0, 2, 1), (12, 0, 2, 1), (33, 0, 2, 1), (10, 0, 0, 0), (3, 0, 0, 0)),
    ((65, 0, 2, 1), (2, 0, 2, 1), (50, 0, 2, 1), (80, 1, 2, 1), (1, 0, 2, 1), (44, 0, 2, 1)),
    ((3, 3, 2, 0), (8, 0, 2, 0), (4, 4, 2, 0), (2, 2, 2, 0), (11, 0, 2, 0), (5, 5, 2, 0)),
    ((1, 1, 2, 0), (6, 6, 2, 0), (6, 0, 2, 1), (19, 0, 2, 1), (19, 0, 2, 1), (8, 8, 2, 0)),
    ((10, 10, 2, 0), (15, 1, 2, 1), (5, 5, 2, 0), (28, 0, 2, 1), (9, 9, 2, 0)),
    ((2, 2, 2, 0), (5, 0, 2, 1), (33, 2, 2, 1), (7, 0, 2, 1), (26, 1, 2, 1), (3, 3, 2, 0), (6, 0, 2, 0), (2, 2, 2, 0)),
    ((7, 0, 2, 1), (22, 0, 2, 1), (17, 0, 2, 1), (3, 0, 2, 1), (41, 0, 2, 1)),
    ((1, 1, 2, 0), (30, 0, 2, 1), (4, 4, 2, 0)),
    ((2, 2, 2, 0), (75, 2, 2, 1), (1, 1, 2, 0), (9, 0, 2, 0), (3, 3, 2, 0)),
    ((40, 0, 2, 1),),
    ((12, 0, 2, 1),),
    ((3, 0, 2, 0), (2, 2, 2, 0), (2, 0, 2, 0), (4, 4, 2, 0)),
)
DEPTH = 8


class Node(NamedTuple):
    """`main` where there is no feature; else the branch `low` takes values up to `limit`."""

    main: bool
    feature: int | None = None
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> Node:
    """A classification tree by Gini impurity; of equal splits the first feature and least limit."""
    main = bool(2 * y.sum() > len(y))
    if depth == 0 or y.all() or not y.any():
        return Node(main)
    best = None
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, feature] <= limit
            left, right = y[low].mean(), y[~low].mean()
            impurity = low.sum() * left * (1 - left) + (~low).sum() * right * (1 - right)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, limit)
    if best is None:
        return Node(main)
    _, feature, limit = best
    low = x[:, feature] <= limit
    return Node(main, feature, float(limit), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def train(pages=LABELLED) -> Node:
    x = np.vstack([describe([row[:3] for row in page]) for page in pages])
    return grow(x, np.array([row[3] for page in pages for row in page], dtype=bool))


def is_main(tree: Node, row: np.ndarray) -> bool:
    while tree.feature is not None:
        tree = tree.low if row[tree.feature] <= tree.limit else tree.high
    return tree.main


def main_text(html: str | None, tree: Node) -> str:
    """The main blocks of a page in order, one per line; empty for NULL and pages without any."""
    found = blocks(html or "")
    if not found:
        return ""
    rows = describe([(b.words, b.linked, b.place) for b in found])
    return "\n".join(b.text for b, row in zip(found, rows) if is_main(tree, row))


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, text and n_chars, its code points. One row per row, no shuffle."""
    tree = train()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), tree) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    id_type = pages.schema[id_column].dataType.simpleString()
    return pages.select(id_column, url, html).mapInArrow(
        extracted, f"page_id {id_type}, url string, text string, n_chars bigint"
    )
