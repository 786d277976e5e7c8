"""Main text of web pages by tag-path ratios.

A page is read into blocks, each with its path of tags from the root. Text length
and punctuation are added up per path; the ratios are smoothed over the blocks in
page order, fused with the path's own, and paths above a threshold are content.
No block whose path passes is dropped. What else stands in the elements that hold
such blocks (an <article> or <main>, their containers, what shares one with the
h1) belongs to the article too: short headings and list items have poor ratios of
their own. Menus, forms, notices and the like are left out by their elements and
labels wherever they stand, but not a form, dialog or object around the article,
nor parts of an <article> whose labels can name parts of a text and whose paths
are those of content. A label counts by the word it names, its last one but for
words of the layout; of words in passing, as in comments-open, paths decide.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from stratalode.llm.columns import with_arrow_columns

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")

# Element names of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select"
    " summary table tbody td tfoot th thead tr ul".split()
)
NOT_CONTENT = frozenset("nav footer aside form button select head dialog menu svg canvas object audio video map".split())
# Words of class, id and role that mark what is not the article.
LABELS = frozenset(
    "ad ads adv advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment comments complementary"
    " consent contentinfo cookie cookies copyright discussion disqus footer gdpr header login masthead menu menubar modal"
    " nav navbar navigation newsletter notice notices pager pagination popup privacy promo promoted promotion recommended"
    " related reply replies respond responses search share sharing sidebar signup skyscraper social sponsor sponsored subscribe"
    " subscription teaser toolbar widget".split()
)
# Those of the words that also name parts of an article, as in id=related-work; in one, paths decide.
PARTS = frozenset(
    "alert banner complementary copyright discussion header menu notice notices privacy promoted related replies reply respond"
    " responses search share sharing social sponsor sponsored teaser".split()
)
# Words that name a place in a layout, as in related-posts or comments-area. What a label names besides
# is its last word: comments-open and login-guide are no comments and no login, and paths decide.
PLACES = frozenset(
    "area bar block body box btn button buttons card cards col column container content cta entry entries feed field form group"
    " holder icon icons inner item items label left link links list main message outer overlay pane panel post posts region"
    " right row section slot story stories text thread title top unit wrap wrapper zone".split()
)
# First words of labels that tell what an element has, as in has-sidebar.
STATES = frozenset("has have hide is no not show with without".split())
# Elements of NOT_CONTENT that may also be wrapped around the article.
WRAPPERS = frozenset("form dialog object".split())
# Elements that hold several blocks of one text; a block of other elements is part of what is around it.
CONTAINERS = frozenset(["", *"html body article main div td th".split()])
#: As in browsers, elements nested deeper do not make paths of their own. Whether they are content is told at any depth.
MAX_DEPTH = 512
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES = {
    "li": ("li", frozenset("ul ol menu".split())), "dt": ("dt dd", frozenset(["dl"])), "dd": ("dt dd", frozenset(["dl"])),
    "tr": ("tr td th", frozenset(["table"])), "td": ("td th", frozenset("tr table".split())), "th": ("td th", frozenset("tr table".split())),
    "option": ("option", frozenset(["select"])),
}


@dataclass
class Element:
    tag: str
    label: str
    parent: Element | None  #: the next one of its path
    out: bool
    by_label: bool = False
    holds_article: bool = False
    depth: int = 0
    by_part: bool = False
    holds_main: bool = False
    wraps: bool = False
    around: Element | None = None  #: the element it stands in, at any depth
    in_article: bool = False
    silent: bool = False  #: whether text right inside, in no block of its own, is no content

    def up(self):
        e = self
        while e is not None:
            yield e
            e = e.parent


@dataclass
class Block:
    element: Element
    text: list[str] = field(default_factory=list)
    linked: int = 0

    def joined(self) -> str:
        return " ".join("".join(self.text).split())


def _label_words(value: str) -> tuple[set[str], set[str]]:
    """The words of `LABELS` that a class, id or role names, and those that are in it besides."""
    named, other = set(), set()
    for token in value.split():
        words = [part.lower() for part in _PART.findall(token)]
        held = {w for w in words if w in LABELS}
        if not held:
            continue
        head = list(words)
        while len(head) > 1 and head[-1] in PLACES:
            head.pop()
        names = head[-1] in LABELS and head[0] not in STATES
        (named if names else other).update(held)
    return named, other


def _marked(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """The label that tells elements of a path apart, and whether it marks no content: surely, by words of `PARTS` only, or by others in passing."""
    label, bad, part_of, passing = "", False, False, False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "class":
            label = value.split()[0] if value.split() else ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _NOT_SHOWN.search(value):
            bad = True
        elif name in ("class", "id", "role"):
            named, other = _label_words(value)
            bad, part_of, passing = bad or bool(named - PARTS), part_of or bool(named), passing or bool(other)
    return label, bad, part_of and not bad, passing and not bad


def read_blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with text outside of scripts, styles and comments."""
    root = Element("", "", None, False)
    here, blocks, at, links = root, [Block(root)], 0, 0
    opened: Counter = Counter()

    def close(last: Element) -> None:
        """Close all up to and with ``last``."""
        nonlocal here
        while True:
            gone, here = here, here.around
            opened[gone.tag] -= 1
            if gone is last:
                return

    def nearest(tag: str) -> Element | None:
        if opened[tag] <= 0:
            return None
        e = here
        while e.tag != tag:
            e = e.around
        return e

    def text(piece: str) -> None:
        if piece and not here.silent:
            block = blocks[-1]
            piece = html.unescape(piece) if "&" in piece else piece
            block.text.append(piece)
            if links:
                block.linked += len(piece.strip())

    def edge() -> None:
        if blocks[-1].text:
            blocks.append(Block(here))
        else:
            blocks[-1] = Block(here)

    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        name = found["tag"] or ((odd := _NAME.match(found[0])) and odd[1]) or ""
        tag, ends = name.lower(), found[0].startswith("</")
        if not tag:
            continue
        if ends:
            match = nearest(tag)
            if match is not None:
                close(match)
                links -= tag == "a" and links > 0
            if tag in BLOCKS:
                links = links if match is None else 0
                edge()
            continue
        if tag in VOID:
            if tag == "hr":
                edge()
            elif tag == "br":
                text(" ")
            continue
        attributes = found["rest"] or ""
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in BLOCKS:
            open_p = nearest("p")
            if open_p is not None:
                close(open_p)
            if tag in _CLOSES:
                closes, stop = _CLOSES[tag]
                last, e = None, here if any(opened[c] > 0 for c in closes.split()) else root
                while e is not root and e.tag not in stop:
                    if e.tag in closes.split():
                        last = e
                    e = e.around
                if last is not None:
                    close(last)
            links = 0
        label, bad, part_of, passing = _marked(tag, attributes) if attributes.strip() else ("", False, False, False)
        plain = tag not in HEADINGS and tag not in ("html", "body", "main", "article")
        inside = here.in_article or here.tag in ("article", "main")
        wraps = tag in WRAPPERS
        own_out = tag in NOT_CONTENT and not wraps or tag == "header" and not inside
        by_label = plain and (bad or part_of and not inside)
        by_part = plain and not by_label and (part_of or passing)
        deep = here.depth >= MAX_DEPTH
        here = Element(
            tag, label, here.parent if deep else here, here.out or own_out, by_label, depth=here.depth + (not deep),
            by_part=by_part, wraps=wraps, around=here, in_article=inside,
            silent=tag not in BLOCKS and (here.silent or own_out or by_label),
        )
        if deep:  # elements in between are on no path
            here.by_label = by_label or here.around.by_label and not here.around.holds_article
            here.by_part, here.wraps = by_part or here.around.by_part, wraps or here.around.wraps
        opened[tag] += 1
        if tag in ("article", "main", "h1"):
            e = here
            while e is not None and not (e.holds_article and (e.holds_main or tag == "h1")):
                e.holds_article = True
                e.holds_main = e.holds_main or tag != "h1"
                e = e.around
        links += tag == "a" and not attributes.rstrip().endswith("/")
        if attributes.rstrip().endswith("/") and tag == "svg":
            close(here)
        if tag in BLOCKS:
            edge()
    return blocks


def _is_out(element: Element) -> bool:
    """Labels do not count where the element holds the article itself, as in has-sidebar."""
    return element.out or any(e.by_label and not e.holds_article for e in element.up())


def _without_wrapped(rows: list[tuple[Block, str]]) -> list[tuple[Block, str]]:
    """``rows`` without those of forms, dialogs and objects, unless they are around an article or most of the page's prose.

    Prose are blocks without links that have the marks of sentences. A page without any is told by its h1.
    """
    prose: Counter = Counter()
    total = 0
    for b, text in rows:
        if not b.linked and any(c in text for c in ".!?\u3002\uff01\uff1f"):
            total += len(text)
            for e in b.element.up():
                if e.wraps:
                    prose[id(e)] += len(text)

    def around(e: Element) -> bool:
        return e.holds_main or (2 * prose[id(e)] > total if total else e.holds_article)

    return [(b, text) for b, text in rows if not any(e.wraps and not around(e) for e in b.element.up())]


def _without_parts(rows: list[tuple[Block, str]]) -> list[tuple[Block, str]]:
    """``rows`` without those in elements of an article that labels mark by words of `PARTS` and paths do not keep.

    Headings do not count: an element of nothing else stays if what it heads does not tell more.
    """
    if not any(e.by_part for b, _ in rows for e in b.element.up()):
        return rows
    paths = content_paths([(_path(b.element), text, b.linked) for b, text in rows])
    good, chars = Counter(), Counter()
    for b, text in rows:
        if b.element.tag in HEADINGS and not b.linked:
            continue
        for e in b.element.up():
            if e.by_part and not e.holds_article:
                chars[id(e)] += len(text)
                good[id(e)] += len(text) * (_path(b.element) in paths)
    bad = {e for e in chars if 2 * good[e] < chars[e]}
    return [(b, text) for b, text in rows if not any(id(e) in bad for e in b.element.up())]


def _without_other_articles(rows: list[tuple[Block, str]]) -> list[tuple[Block, str]]:
    """``rows`` without those of shorter <article> elements beside the one that holds the page's only h1."""
    outermost = [next((e for e in reversed(list(b.element.up())) if e.tag == "article"), None) for b, _ in rows]
    titled = {id(e) for (b, _), e in zip(rows, outermost, strict=True) if any(up.tag == "h1" for up in b.element.up())}
    if len(titled) != 1 or titled == {id(None)}:
        return rows
    chars: Counter = Counter()
    for (_, text), e in zip(rows, outermost, strict=True):
        chars[id(e)] += len(text)
    longest = chars[next(iter(titled))]
    return [r for r, e in zip(rows, outermost, strict=True) if e is None or id(e) in titled or chars[id(e)] >= longest]


def _container(element: Element) -> Element:
    return next(e for e in element.up() if e.tag in CONTAINERS and (e.tag not in ("td", "th") or e is not element))


def _path(element: Element) -> str:
    return "/".join(f"{e.tag}.{e.label}" if e.label else e.tag for e in element.up() if e.tag in BLOCKS)


def content_paths(blocks: list[tuple[str, str, int]], share: float = 0.3) -> set[str]:
    """Paths of content among blocks (path, text, linked characters)."""
    chars, marks, linked, nodes = Counter(), Counter(), Counter(), Counter()
    for path, text, inside in blocks:
        nodes[path] += 1
        chars[path] += len(text)
        marks[path] += sum(text.count(c) for c in ".,;:!?")
        linked[path] += min(inside, len(text))
    ratio = {
        p: math.sqrt(chars[p] / n) * (1 + math.log1p(marks[p] / n)) * (1 - linked[p] / max(chars[p], 1)) for p, n in nodes.items()
    }
    row = [ratio[path] for path, _, _ in blocks]
    weights = (0.25, 0.5, 1.0, 0.5, 0.25)
    smooth = defaultdict(list)
    for i, (path, _, _) in enumerate(blocks):
        near = [(weights[k + 2], row[i + k]) for k in range(-2, 3) if 0 <= i + k < len(row)]
        smooth[path].append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    fused = {p: 0.7 * ratio[p] + 0.3 * sum(v) / len(v) for p, v in smooth.items()}
    total = sum(chars.values())
    typical = sum(fused[p] * chars[p] for p in fused) / max(total, 1)
    return {p for p, v in fused.items() if v >= share * typical and linked[p] <= 0.5 * chars[p]}


def extract(page: str | None, coverage: float = 0.9) -> str:
    """The blocks of the article, joined by two line ends.

    These are all blocks whose path is one of content, and what else stands in the
    <article> or <main> around them, in the container of any of them, or in the
    smallest element that holds ``coverage`` of their text, or that and the h1.
    """
    rows = [(b, text) for b in read_blocks(page or "") if (text := b.joined()) and not _is_out(b.element)]
    rows = _without_other_articles(_without_parts(_without_wrapped(rows)))
    if not rows:
        return ""
    paths = content_paths([(_path(b.element), text, b.linked) for b, text in rows])
    kept = {id(b) for b, _ in rows if _path(b.element) in paths} or {id(b) for b, _ in rows}
    total = sum(len(text) for b, text in rows if id(b) in kept)
    inside: Counter = Counter()
    whole: dict[int, Element] = {}
    for b, text in rows:
        if id(b) in kept:
            for e in b.element.up():
                inside[id(e)] += len(text)
                if e.tag in ("article", "main"):
                    whole[id(e)] = e
            c = _container(b.element)
            whole[id(c)] = c
    longest = max((r for r in rows if id(r[0]) in kept), key=lambda r: len(r[1]))[0].element
    article = _container(next(e for e in longest.up() if inside[id(e)] >= coverage * total))
    titles = {id(e) for b, _ in rows if b.element.tag == "h1" for e in b.element.up()}
    titled = next((e for e in article.up() if id(e) in titles), article)
    whole |= {id(article): article, id(titled): titled}
    # All of a page is no article: of its own elements, only blocks that stand in no other container count.
    pages = {e for e, element in whole.items() if element.tag in ("", "html", "body")}

    def belongs(b: Block) -> bool:
        if id(b) in kept or b.element.tag == "h1" or id(_container(b.element)) in pages:
            return True
        return any(id(e) in whole and id(e) not in pages for e in b.element.up())

    return "\n\n".join(text for b, text in rows if belongs(b))


def extract_text(pages: DataFrame, column: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of ``column`` in ``name`` and its code points in ``n_chars``.

    NULL, empty and contentless pages have an empty text. White space, character
    references decoded, is one space inside a block. Repeated rows stay; columns
    with the names of results are replaced; an empty table gives an empty result.
    """

    def make(batch: pa.RecordBatch) -> list:
        texts = [extract(page) for page in batch.column(column).to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return with_arrow_columns(pages, make, f"{name} string, n_chars bigint")
