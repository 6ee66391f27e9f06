"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at block-level tags into flat text blocks (inline tags and
line breaks stay inside a block). Each block is described by its word count
and link density, those of the blocks before and after it, its kind of tag
and the nearest telling container. A small Gini tree, grown from the
labelled table below, keeps or drops the block.

Null and empty html: empty text. Malformed markup never fails: unclosed
elements, hidden ones too, end with their container, stray end tags are
ignored, an unclosed comment, script, style, title or textarea reaches to the
end of the page. Rows are handled one by
one, so repeated rows and null ids are kept.
"""

from __future__ import annotations

import html as html_lib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Elements whose content is never text of the page.
HIDDEN = ("script", "style", "noscript", "template", "title", "textarea", "select", "option", "button", "svg", "iframe", "object", "canvas")
# Those of them in which nothing is a tag but their own end tag.
RAW = ("script", "style", "title", "textarea")
# Elements that end an svg left open (HTML standard, foreign content).
OUT_OF_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split()
)
# Elements of one kind that follow one another, whose end tag may be left out.
FOLLOWING = frozenset("p li dt dd option button tr td th".split())
# Elements that do not end a text block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Containers of boilerplate, of boilerplate in main text (round a
# whole page only the text tells) and of main text, by element.
CHROME = frozenset("nav footer aside menu dialog".split())
FORM = frozenset("form fieldset".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A name in class, id or role tells a container's use if all its
# parts are such words: cookie-notice does, has-sidebar and no-ads do not.
def _names(words: str, more: str) -> re.Pattern:
    return re.compile(rf"(?:(?:{more})[_-]+)*(?:{words})(?:[_-]+(?:{words}|{more}))*", re.I)


COMMENT_NAMES = _names("comments?|repl(?:y|ies)|disqus", "article|body|content|item|list|text|thread")
CHROME_NAMES = _names(
    r"nav\w*|menu\w*|side(?:bar|nav|menu)?|foot(?:er)?|head|header|masthead|topbar|breadcrumbs?|ads?|advert\w*|banner|promo\w*|"
    r"sponsor\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscri\w*|signup|comments?|replies|disqus|"
    r"related|recommend\w*|share|sharing|social|widget|login|search|complementary|contentinfo|navigation|pagination|pager|toolbar",
    "site|bar|global",
)
MAIN_NAMES = _names("article|content|main|post|story|entry|body", "site|page|text")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S | re.I,
)

OTHER, IN_MAIN, IN_CHROME = 0, 1, 2
IN_NAMED = 3  # boilerplate by name, in which main text may lie; its blocks count as IN_CHROME
PARAGRAPH, HEADING, ITEM, PLAIN = 0, 1, 2, 3


@dataclass
class Block:
    text: str
    words: int
    linked: int
    kind: int
    place: int


def _container(tag: str, attrs: str, outer: int) -> int:
    """What the nearest telling container says, given the one outside."""
    if tag in CHROME:
        return IN_CHROME
    if tag == "header" and outer != IN_MAIN:
        return IN_CHROME
    if outer == IN_CHROME:
        return IN_CHROME  # what lies inside boilerplate is boilerplate
    found: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(attrs) if attrs else ():
        found.setdefault(key.lower(), value.strip("\"'"))
    if "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or re.search(r"(?:^|;)\s*display\s*:\s*none", found.get("style", ""), re.I):
        return IN_CHROME
    names = " ".join(found.get(key, "") for key in ("class", "id", "role")).split()
    of = lambda kind: any(kind.fullmatch(name) for name in names)
    if tag not in ("html", "body") and of(COMMENT_NAMES):
        return IN_CHROME  # readers write articles too
    if tag in MAIN:
        return IN_MAIN
    if outer == IN_NAMED:
        return outer
    if names and tag not in ("html", "body"):
        if of(CHROME_NAMES) and not (tag == "header" and outer == IN_MAIN):
            return IN_NAMED
        if outer == OTHER and of(MAIN_NAMES):
            return IN_MAIN
    if tag in FORM:
        return IN_NAMED if outer == IN_MAIN else OTHER
    return outer


def blocks_of(page: str | None) -> list[Block]:
    """The page's flat text blocks in order."""
    out: list[Block] = []
    if not page:
        return out
    open_tags: list[tuple[str, int, int]] = []  # (tag, place outside, kind outside)
    place, kind = OTHER, PLAIN
    pieces: list[str] = []
    linked, in_link = 0, False
    hidden = -1  # where the outermost hidden element stands in open_tags
    inline: list[str] = []  # inline elements open outside of it
    inside: list[str] = []  # and inside

    def close() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html_lib.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, text.count(" ") + 1, linked, kind, IN_CHROME if place == IN_NAMED else place))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and hidden < 0:
            pieces.append(raw)
            if in_link:
                linked += len(raw.split())

    at = 0
    for m in TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"] is None and m[0].startswith("<![CDATA["):
                add(html_lib.escape(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:]))
            continue
        tag = tag.lower()
        if hidden >= 0 and not m["end"] and tag in OUT_OF_SVG and open_tags[hidden][0] == "svg" and all(t != "foreignobject" for t, _, _ in open_tags[hidden:]):
            del open_tags[hidden:]
            hidden = -1
        if tag in INLINE:
            held = inline if hidden < 0 else inside
            if m["end"] and hidden >= 0 and tag not in inside and tag in inline:
                del open_tags[hidden:]  # the inline element round it ends
                hidden, held = -1, inline
            if m["end"] and tag in held:
                held.remove(tag)
            elif not m["end"] and tag not in VOID and not m["attrs"].endswith("/"):
                held.append(tag)
            if hidden < 0:
                if tag == "br":
                    add(" ")
                elif tag == "a":
                    in_link = not m["end"]
            continue
        if hidden >= 0 or tag in HIDDEN:  # the text block goes on round a hidden element
            if not m["end"]:
                if tag in VOID or m["attrs"].endswith("/"):
                    continue
                if tag in FOLLOWING and open_tags and open_tags[-1][0] == tag:
                    open_tags.pop()
                    hidden = -1 if hidden == len(open_tags) else hidden
                if hidden < 0 and tag in HIDDEN:
                    hidden = len(open_tags)
                    inside.clear()
                open_tags.append((tag, place, kind))
                continue
            k = next((k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == tag), -1)
            if k < 0:
                continue
            if k >= hidden:
                del open_tags[k:]
                hidden = -1 if k == hidden else hidden
                continue
            hidden = -1  # its container ends
        close()
        in_link = False
        if m["end"]:
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == tag:
                    _, place, kind = open_tags[k]
                    del open_tags[k:]
                    break
            continue
        if tag in VOID or m["attrs"].endswith("/"):
            continue
        inline.clear()
        if tag in FOLLOWING and open_tags and open_tags[-1][0] == tag:
            _, place, kind = open_tags.pop()  # its end tag may be left out
        elif open_tags and open_tags[-1][0] == "p":
            _, place, kind = open_tags.pop()  # a block ends an open paragraph
        open_tags.append((tag, place, kind))
        place = _container(tag, m["attrs"], place)
        kind = HEADING if tag in HEADINGS else PARAGRAPH if tag in ("p", "blockquote", "pre") else ITEM if tag in ("li", "dt", "dd", "td", "th") else kind if kind == ITEM else PLAIN
    add(page[at:])
    close()
    return out


def features(words: np.ndarray, linked: np.ndarray, kind: np.ndarray, place: np.ndarray) -> np.ndarray:
    """(blocks, 8): own, previous and next word count and link density, kind, place."""
    density = np.minimum(linked / np.maximum(words, 1), 1)
    before = lambda x: np.concatenate([[0], x[:-1]])
    after = lambda x: np.concatenate([x[1:], [0]])
    return np.stack([words, density, before(words), before(density), after(words), after(density), kind, place], axis=1).astype(float)


# The labelled table. One page a paragraph, one block a line:
# container (m main, c boilerplate, o neither), tag (p, h heading, i item,
# t other), words, words in links, label (1 main text).
LABELLED = """
c i 1 1 0
c i 1 1 0
c i 2 2 0
c t 12 0 0
m h 5 0 1
m p 6 0 1
m p 85 0 1
m p 3 0 1
m p 120 4 1
m p 9 0 1
c t 14 0 0

c i 1 1 0
c i 1 1 0
c t 20 0 0
m h 3 0 1
m p 3 0 1
c t 18 0 0

o t 3 3 0
o i 1 1 0
o i 1 1 0
o i 2 2 0
o t 4 0 0
o h 8 0 1
o p 60 2 1
o p 45 0 1
o p 30 1 1
o h 4 0 1
o p 70 0 1
o i 5 4 0
o i 6 6 0
o t 9 2 0

c p 40 0 0
c p 55 1 0
c i 4 4 0
m h 7 0 1
m t 6 0 1
m p 33 0 1
m i 12 0 1
m i 9 1 1
m i 3 0 1
m t 50 0 1
m p 12 9 1
c h 2 0 0
c p 35 0 0
c p 48 0 0
c t 8 2 0

o t 2 2 0
o t 2 2 0
o t 4 3 0
o t 3 0 0
o p 90 3 1
o p 75 0 1
o t 110 2 1
o p 64 0 1
o t 3 3 0
o t 7 1 0
o t 6 0 0

c t 6 0 0
m p 2 0 1
m p 1 0 1
m i 2 2 1
m i 3 3 1
c p 80 0 0
c t 30 0 0

o h 6 0 1
o p 18 0 1
o p 25 0 1
o p 11 0 1
o p 40 0 1
o i 14 0 1
o i 17 0 1
o p 22 0 1
o t 4 4 0
"""
KINDS = {"p": PARAGRAPH, "h": HEADING, "i": ITEM, "t": PLAIN}
PLACES = {"o": OTHER, "m": IN_MAIN, "c": IN_CHROME}


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for page in LABELLED.strip().split("\n\n"):
        rows = [line.split() for line in page.splitlines()]
        col = lambda k, f=int: np.array([f(r[k]) for r in rows])  # noqa: E731,B023
        x.append(features(col(2), col(3), col(1, KINDS.get), col(0, PLACES.get)))
        y.append(col(4))
    return np.concatenate(x), np.concatenate(y)


@dataclass
class Node:
    keep: bool
    feature: int = -1
    limit: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Node:
    """Gini tree; ties go to the first feature and the lowest limit."""
    node = Node(keep=bool(y.mean() >= 0.5))
    if depth == 0 or y.min() == y.max():
        return node
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= limit
            gini = sum(s.sum() * (1 - (p := y[s].mean()) ** 2 - (1 - p) ** 2) for s in (low, ~low))
            if best is None or gini < best[0] - 1e-9:
                best = (gini, f, limit, low)
    if best is None:
        return node
    _, node.feature, node.limit, low = best
    node.low, node.high = grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)
    return node


@lru_cache(maxsize=1)
def default_tree() -> Node:
    return grow(*labelled_table())


def classify(x: np.ndarray, tree: Node) -> np.ndarray:
    out = np.zeros(len(x), bool)
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node.feature < 0 or not len(rows):
            out[rows] = node.keep
            continue
        low = x[rows, node.feature] <= node.limit
        todo += [(node.low, rows[low]), (node.high, rows[~low])]
    return out


def main_text(page: str | None, tree: Node | None = None) -> str:
    """Kept blocks joined by a blank line."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    col = lambda f: np.array([f(b) for b in blocks])
    x = features(col(lambda b: b.words), col(lambda b: b.linked), col(lambda b: b.kind), col(lambda b: b.place))
    keep = classify(x, tree or default_tree())
    return "\n\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract_main_text(pages: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """All columns of ``pages`` plus ``out`` (replaced if it is there)."""
    kept = pages.drop(out)

    def extract(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return kept.mapInArrow(extract, T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())]))
