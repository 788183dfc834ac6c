"""Main text of web pages by tag-path ratios.

Every piece of text has a path of tags from the root.  Text length, punctuation and
link text are summed per path; the ratios of text and of punctuation to the path's
pieces are fused, smoothed along the page, and paths over the threshold hold the
content.  Framing elements and names only lower a path's ratio, and not at all on an
element that holds most of the page's text.  What the container of the content holds
beside it belongs to it too, so that titles and short paragraphs stay, but for paths
that are marked as frames and below the threshold, and for lists of links.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: HTML's elements whose content is never shown as text.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "object", "canvas", "math", "title", "select")
#: HTML's elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that frame the content; a header inside an article doesn't.
BOILERPLATE = frozenset("nav header footer aside form menu dialog button".split())
#: Headings.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a new block of the same sort closes.
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Words in a class, id or role that name what is no part of an article, wherever it stands.
APART = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|breadcrumb\w*|side-?bar\w*|cookie\w*|consent|notice\w*|popup|modal|overlay|newsletter|subscri\w*|social\w*|"
    r"comments?|comment-?list|respond|replies|feedback|reactions|disqus\w*|toolbar|pagination|pager|login|signup|navbar|menu|navigation|complementary|contentinfo|alert|alertdialog)(?=$|[\s_-])"
    r"|(?:^|[\s_-])shar(?:e|ing)(?:[_-]?(?:bar|box|buttons?|icons?|links?|list|post|this|tools?|widget))*(?=$|\s)",
    re.I,
)
#: Words that name the header of an article beside its body.
OWN_HEADER = re.compile(r"(?:^|[\s_-])(?:entry|post|article|story)[_-]?(?:head|header|heading|title|intro)(?=$|[\s_-])", re.I)
#: Words that name a frame where no container sets the article apart.
AROUND = re.compile(r"(?:^|[\s_-])(?:nav\w*|menu\w*|footer\w*|foot|header|masthead|related\w*|recommend\w*|widget\w*|skip|search\w*|copyright|disclaimer|tags|meta)(?=$|[\s_-])", re.I)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
#: A comment, a declaration, or the beginning of a tag.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)|<[a-zA-Z/][^>]*\Z""", re.S)
#: A tag's end, or an attribute up to the quote of its value, or with its value.
ATTRIBUTE = re.compile(r"""[\t\n\f\r /]*+(?:(>)|(=?[^\t\n\f\r />=]*+)(?:[\t\n\f\r ]*+=[\t\n\f\r ]*+(?:(["'])|[^\t\n\f\r >]*+))?)""")
#: The attributes that say whether an element frames the content.
READ = frozenset(("class", "id", "role", "hidden", "aria-hidden", "style"))
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")


@dataclass(frozen=True)
class PathRatios:
    """``spread`` nodes on each side are smoothed; ``cut`` is the share of the page's mean ratio that content needs.

    A path with a mark has ``marked`` of its ratio.  A container is entered while it holds
    ``holds`` of the content's text, or half of it where it says that it is the article.
    """

    spread: int = 2
    cut: float = 0.5
    most_links: float = 0.5
    marked: float = 0.25
    holds: float = 0.9


#: What an element says of itself.
PLAIN, WEAK, STRONG, FRAME = 0, 1, 2, 3


@dataclass
class _Piece:
    text: str
    path: int
    holder: int
    block: int
    linked: bool


@dataclass
class _Page:
    """Pieces in order; elements by number with parent, mark, whether they are an article, and whether they are its header; paths by number with their last tag."""

    pieces: list[_Piece] = field(default_factory=list)
    parent: list[int] = field(default_factory=lambda: [0])
    mark: list[int] = field(default_factory=lambda: [PLAIN])
    main: list[bool] = field(default_factory=lambda: [False])
    opens: list[bool] = field(default_factory=lambda: [False])
    last_tag: list[str] = field(default_factory=lambda: [""])


@lru_cache(maxsize=4096)
def _named(attributes: str) -> int:
    names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes))
    if names and APART.search(names) or HIDDEN.search(attributes):
        return STRONG
    return WEAK if names and AROUND.search(names) else PLAIN


def _tag_end(page: str, at: int, lost: set[int]) -> tuple[int, str]:
    """Where the tag whose name ends at ``at`` ends (-1: nowhere), and those of its attributes that are read.

    ``lost`` keeps the places from which no end was found, so that no page is read over and over.
    """
    read, passed = [], []
    while at not in lost and (m := ATTRIBUTE.match(page, at)) and m.end() > at:
        if m[1]:
            return m.end(), " ".join(read)
        passed.append(at)
        at = m.end()
        if m[3]:
            close = page.find(m[3], at)
            if close < 0:
                break
            at = close + 1
        if m[2] and m[2].lower() in READ:
            read.append(page[m.start(2) : at])
    lost.update(passed)
    return -1, ""


def pieces(page: str) -> _Page:
    """Text nodes of a page in order, with their paths; tolerant of missing end tags and linear in the tags."""
    out = _Page()
    stack: list[tuple[str, int, int, bool]] = []  # tag, path, number of the element, inside an article
    solid: list[int] = []  # places in the stack of what isn't inline
    open_tags: Counter[str] = Counter()
    paths: dict[tuple[int, str], int] = {}
    block = at = 0
    lost: set[int] = set()

    def add(text: str) -> None:
        if not text or text.isspace():
            if text and out.pieces and out.pieces[-1].block == block:
                out.pieces[-1].text += " "
            return
        top = stack[solid[-1]] if solid else ("", 0, 0, False)
        out.pieces.append(_Piece(text, top[1], top[2], block, open_tags["a"] > 0))

    def close(depth: int) -> None:
        nonlocal block
        if solid and solid[-1] >= depth:
            block += 1
        while solid and solid[-1] >= depth:
            solid.pop()
        open_tags.subtract(s[0] for s in stack[depth:])
        del stack[depth:]

    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        at, attributes = _tag_end(page, m.end(), lost)
        if at < 0:  # a quote that never closes: the tag ends at the first bracket, or the page does
            at = page.find(">", m.end()) + 1 or size
            attributes = page[m.end() : at - 1]
        empty = page[at - 2] == "/"
        if m[1]:
            if open_tags[tag] > 0:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            elif tag == "p":
                block += 1
            continue
        if tag in RAW:
            if empty and tag in ("svg", "math"):
                block += 1
                continue
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in CLOSES_P and solid and stack[solid[-1]][0] == "p":
            close(solid[-1])
        if tag in SAME and any(open_tags[t] > 0 for t in SAME[tag][0]):
            shut, fence = SAME[tag]
            for i in reversed(solid):
                if stack[i][0] in shut:
                    close(i)
                elif stack[i][0] in fence:
                    break
        if tag not in INLINE:
            block += 1
        if tag in VOID or empty and tag in INLINE:
            continue
        above = stack[-1] if stack else ("", 0, 0, False)
        open_tags[tag] += 1
        if tag in INLINE:
            stack.append((tag, *above[1:]))
            continue
        first = next((a or b or c for a, b, c in NAMES.findall(attributes)), "") if "=" in attributes else ""
        step = f"{tag}.{first.split()[0]}" if first.split() else tag
        path = paths.setdefault((above[1], step), len(paths) + 1)
        if path == len(out.last_tag):
            out.last_tag.append(tag)
        main = tag in ("article", "main") or "role" in attributes and bool(re.search(r"role\s*=\s*[\"']?main\b", attributes, re.I))
        mark = _named(attributes) if attributes and tag not in ("html", "body", "main") else PLAIN
        opens = bool(attributes) and any(OWN_HEADER.search(a or b or c) for a, b, c in NAMES.findall(attributes))
        if tag in BOILERPLATE and not (tag == "header" and (above[3] or opens)):
            mark = STRONG if tag in ("form", "header") else FRAME
        out.parent.append(above[2])
        out.mark.append(mark)
        out.main.append(main)
        out.opens.append(opens)
        solid.append(len(stack))
        stack.append((tag, path, len(out.parent) - 1, above[3] or main))
    return out


def _summed(values: np.ndarray, parent: list[int]) -> np.ndarray:
    """Values of elements with those of all elements inside them."""
    total = values.tolist()
    for i in range(len(total) - 1, 0, -1):
        total[parent[i]] += total[i]
    return np.array(total)


def content(page: _Page, rules: PathRatios) -> list[_Piece]:
    """The pieces that hold the main text."""
    found, n_paths, n_held = page.pieces, len(page.last_tag), len(page.parent)
    if not found:
        return []
    path, held = (np.array([getattr(p, c) for p in found]) for c in ("path", "holder"))
    length = np.array([len(p.text.strip()) for p in found], dtype=float)
    marks = np.array([len(PUNCTUATION.findall(p.text)) for p in found], dtype=float)
    linked = np.array([p.linked for p in found])
    # what holds most of the text with the article, or nearly all of it, is no frame, whatever it is called
    share = _summed(np.bincount(held, length * ~linked, n_held), page.parent)
    mains = _summed(np.array(page.main, dtype=int), page.parent)
    mark = np.array(page.mark)
    within = np.array(page.main)
    for i in range(1, n_held):
        within[i] |= within[page.parent[i]]
    whole = (within | (mains[0] == 0)) & (mark != FRAME)
    mark[(share > 0.5 * share[0]) & (mains > 0) | (share > 0.8 * share[0]) & whole] = PLAIN
    for i in range(1, n_held):
        mark[i] = max(mark[i], mark[page.parent[i]])
    mark = mark[held]

    n = np.bincount(path, minlength=n_paths)
    per = lambda x: np.bincount(path, x, n_paths) / np.maximum(n, 1)
    links = np.bincount(path, length * linked, n_paths) / np.maximum(np.bincount(path, length, n_paths), 1)
    fused = np.sqrt(per(length) * (1 + per(marks))) * (1 - links)
    own = fused[path] * np.where(mark >= STRONG, rules.marked, 1)
    kernel = np.exp(-0.5 * (np.arange(-rules.spread, rules.spread + 1) / max(rules.spread / 2, 0.5)) ** 2)
    smooth = np.convolve(own, kernel / kernel.sum(), mode="same") if len(own) >= len(kernel) else own
    score = per((own + smooth) / 2)
    cut = rules.cut * np.average(score, weights=n)
    high = score[path] >= cut
    list_like = (links > rules.most_links)[path] & np.array([page.last_tag[k] not in HEADINGS for k in path])
    picked = high & ~list_like & (mark < STRONG)
    if not picked.any():
        picked = ~list_like & (mark < STRONG)
    if not picked.any():
        return []

    text = _summed(np.bincount(held[picked], length[picked], n_held), page.parent)
    blocks = [set() for _ in range(n_held)]
    for k in np.flatnonzero(picked):
        blocks[held[k]].add(found[k].block)
    children: dict[int, int] = {}  # the child with most text of each element
    for i in range(1, n_held):
        if text[i] > text[children.get(page.parent[i], 0)] or page.parent[i] not in children:
            children[page.parent[i]] = i
    inner, apart = 0, False
    while (child := children.get(inner)) is not None:
        enough = 0.5 if page.main[child] else rules.holds
        if text[child] < enough * text[inner] or not (text[children.get(child, child)] > 0 and child in children or len(blocks[child]) > 1 or page.main[child]):
            break
        inner = child
        apart = apart or page.main[child] or share[child] < 0.98 * share[0]
    inside = np.zeros(n_held, dtype=bool)
    inside[inner] = True
    # the article's own header stands before its body, beside it or beside what holds it
    above = {0}
    at = inner
    while at:
        above.add(page.parent[at])
        at = page.parent[at]
    for i in range(1, n_held):
        inside[i] |= inside[page.parent[i]] or (page.opens[i] and i < inner and page.parent[i] in above)
    frame = mark >= STRONG
    if not apart:
        frame |= (mark == WEAK) & ~high
    keep = inside[held] & ~list_like & ~frame
    return [p for p, k in zip(found, keep) if k]


def main_text(page: str, rules: PathRatios = PathRatios()) -> str:
    """Blocks of the main text, one to a line; character references decoded, white space made one space."""
    lines: list[str] = []
    block, held = None, []
    for p in [*content(pieces(page), rules), None]:
        if p is None or p.block != block:
            if line := " ".join(html.unescape("".join(held)).split()):
                lines.append(line)
            held = []
            block = p and p.block
        if p:
            held.append(p.text)
    return "\n".join(lines)


def extracted(pages: DataFrame, page: str = "html", rules: PathRatios = PathRatios()) -> DataFrame:
    """``pages`` without ``page`` but with ``text`` and ``n_chars`` (its code points).

    A null or empty page, or one without main text, gives an empty text.  Pages are
    read whole.  Repeated rows are read each.  Columns of ``pages`` named ``text`` or
    ``n_chars`` are replaced.
    """
    pages = pages.drop(*({"text", "n_chars"} - {page}))
    own = [c for c in pages.columns if c != page]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != page), "text string, n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                some = batch.slice(lo, 500)
                texts = [main_text(p or "", rules) for p in some.column(len(own)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*own, "text", "n_chars"])

    return pages.select(*own, page).mapInArrow(run, schema)
