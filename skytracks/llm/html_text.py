"""Main text of web pages by tree scoring.

A page becomes a tree of its block elements. Every paragraph passes points, for being there, for its
length and for its commas, to its parent, half of them to the next ancestor and ever smaller parts further
up, in one pass over the elements. A container's points are discounted by the share of its text that stands in links. The best container
is kept with those of its siblings that score well or read like prose; where it lies in an article or
main element, that element is kept whole. Menus, adverts, comments and the like are no candidates.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed: element names by what they mean here.
RAW = "script|style|noscript|template|textarea|title|iframe|svg|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split()
)
CLOSED_BY = {
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
    "option": frozenset({"option"}),
}
SCOPES = frozenset("ul ol dl table html body article main section div menu".split())
NEVER = frozenset("head nav footer aside form button select dialog menu object audio video canvas".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar".split())
WHOLE = frozenset({"article", "main"})
# Fixed: words in class and id names of what is not the text, and of what is.
UNLIKELY = frozenset(
    "ad ads advert advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist"
    " consent cookie cookies discussion disqus footer gdpr header login masthead menu modal nav navbar navigation"
    " newsletter notice notices notification pager pagination popup promo promoted recommended related replies"
    " respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
LIKELY = frozenset("article body content entry main post story text".split())
# Of the unlikely words those that a paragraph of the text itself may bear: each only takes points from a paragraph there.
AMBIGUOUS = frozenset(
    "login navigation promoted recommended related replies share sharing signup skip social subscribe toolbar widget".split()
)
OWN_TEXT = frozenset({"p", "pre"})
AGAINST = 3.0

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[/a-zA-Z][^>]*\Z",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


class _Element:
    __slots__ = (
        *("name", "parent", "dropped", "likely", "against"),
        *("points", "below", "far", "touched", "chars", "linked", "links", "inside", "menu"),
    )

    def __init__(self, name: str, parent: _Element | None, dropped: bool = False, likely: bool = False, against: float = 0):
        self.name, self.parent, self.dropped, self.likely, self.against = name, parent, dropped, likely, against
        self.points = self.below = self.far = 0.0
        self.chars = self.linked = self.links = 0
        self.touched = self.inside = self.menu = False

    def prose(self) -> float:
        """The share of text outside links."""
        return 1 - self.linked / self.chars if self.chars else 0.0


class _Open:
    """The open elements, from the root down, with the places of each name among them.

    Nothing looks through all of them: whether a name is open, and which of some names is the nearest, is read from the
    places, and an element is passed only to be closed. So a page is read in time that follows its length, at any depth.
    """

    def __init__(self) -> None:
        self.path = [_Element("#root", None)]
        self.places: dict[str, list[int]] = {}

    def nearest(self, names: frozenset[str]) -> int:
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=-1)

    def has(self, *names: str) -> bool:
        return any(self.places.get(name) for name in names)

    def add(self, element: _Element) -> None:
        self.places.setdefault(element.name, []).append(len(self.path))
        self.path.append(element)

    def close(self, names: frozenset[str], limits: frozenset[str] = frozenset()) -> None:
        """Close the nearest open element of ``names``, unless one of ``limits`` stands before it."""
        place = self.nearest(names)
        if place > 0 and place >= self.nearest(limits):
            while len(self.path) > place:
                self.places[self.path.pop().name].pop()


def _unwanted(name: str, attributes: str, inside_text: bool) -> tuple[bool, bool, float]:
    """Whether an element is dropped, whether its names speak for it, and the points that its own text must reach."""
    if name in NEVER or (name == "header" and not inside_text):
        return True, False, 0
    if not attributes:
        return False, False, 0
    words: set[str] = set()
    for kind, *values in NAMES.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if kind.lower() == "role":
            if value.strip() in NEVER_ROLES:
                return True, False, 0
        else:
            words.update(WORD.findall(value))
    likely = not words.isdisjoint(LIKELY)
    if name in WHOLE or name in ("html", "body"):
        return False, likely, 0
    unlikely = words & UNLIKELY
    if inside_text:
        unlikely -= {"header"}
        if name in OWN_TEXT and unlikely <= AMBIGUOUS:
            return False, likely, AGAINST * len(unlikely)
    return bool(unlikely), likely, 0


def _blocks(page: str) -> tuple[list[tuple[_Element, str, int]], list[_Element]]:
    """(element, text, characters in links) of every run of text between block tags, and all elements, in page order."""
    open_ = _Open()
    found, elements = [], open_.path[:]
    pieces: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append((open_.path[-1], text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                linked += len(text.strip())

    last = 0
    for token in TOKEN.finditer(page):
        say(page[last : token.start()])
        last = token.end()
        closing, name, attributes = token.group(2, 3, 4)
        if name is None:
            closing, name, attributes = token.group(5, 6, 7)
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                if not closing and not in_link:
                    open_.path[-1].links += 1
                in_link = not closing
            continue
        if name in ("img", "wbr", "source", "track", "param", "embed", "area", "col", "base", "link", "meta"):
            continue
        flush()
        if name in VOID:
            continue
        in_link = False
        if closing:
            limits = frozenset({"article", "main", "body", "html"}) if name in ("p", "li", "b") else frozenset()
            open_.close(frozenset({name}), limits)
            continue
        if name in ENDS_PARAGRAPH:
            open_.close(frozenset({"p"}), SCOPES)
        if name in CLOSED_BY:
            open_.close(CLOSED_BY[name], SCOPES)
        if name in ("html", "body") and open_.has(name):
            continue
        if name == "body":
            open_.close(frozenset({"head"}))
        dropped, likely, against = _unwanted(name, attributes, open_.has(*WHOLE))
        parent = open_.path[-1]
        element = _Element(name, parent, dropped or parent.dropped, likely, against)
        open_.add(element)
        elements.append(element)
    say(page[last:])
    flush()
    return found, elements


def _own_points(text: str, linked: int) -> float:
    return (1 + len(text) / 100 + text.count(",") + text.count("،") + text.count("、")) * (1 - linked / len(text))


def _score(blocks: list[tuple[_Element, str, int]], elements: list[_Element]) -> list[_Element]:
    """Pass points up the tree; returns the containers that got any, by first block and the deeper first.

    A container has its own points, half of those of the level below, a sixth of the next, and half as much of each
    further one: so every element hands three sums to its parent, the last elements first.
    """
    touched: list[_Element] = []
    for element, text, linked in blocks:
        element.chars += len(text)
        element.linked += linked
        container = element.parent if element.name in ("p", "pre", "td", "li", "blockquote") and element.parent else element
        container.points += _own_points(text, linked)
        while container is not None and not container.touched:
            container.touched = True
            touched.append(container)
            container = container.parent
    for element in reversed(elements):
        above = element.parent
        if above is not None:
            above.chars += element.chars
            above.linked += element.linked
            above.links += element.links
            above.below += element.points
            above.far += element.below / 6 + element.far / 2
        element.points += element.below / 2 + element.far
    return touched


def _merit(element: _Element) -> float:
    bonus = 1.5 if element.name in WHOLE else 1.2 if element.likely else 1.0
    return element.points * element.prose() * bonus


def _is_menu(element: _Element) -> bool:
    """A list or box that is nearly all links."""
    return element.links >= 2 and element.name in ("ul", "ol", "dl", "div", "section", "table") and element.prose() < 0.25


def main_text(page: str | None) -> str:
    """The main text of one page; blocks are joined by line breaks, and a page without any gives ""."""
    blocks, elements = _blocks(page or "")
    blocks = [block for block in blocks if not block[0].dropped and _own_points(*block[1:]) >= block[0].against]
    if not blocks:
        return ""
    containers = _score(blocks, elements)
    best = max(containers, key=_merit)  # of equal ones the first
    whole, above = None, best
    while above is not None:
        whole, above = above if above.name in WHOLE else whole, above.parent
    kept: set[int] = set()
    if whole is not None:
        best = whole
    elif best.parent is not None:
        limit = max(best.points * 0.2, 1.0)
        for element in containers:
            if element.parent is best.parent and element is not best and element.prose() > 0.5 and element.points >= limit:
                kept.add(id(element))
    kept.add(id(best))
    beside = best.parent if whole is None else None
    for element in elements:  # parents stand before their children
        if id(element) in kept:
            element.inside = True
        elif element.parent is not None and element.parent.inside:
            element.inside, element.menu = True, element.parent.menu or _is_menu(element)

    def wanted(element: _Element, text: str, linked: int) -> bool:
        if element.inside:
            return not element.menu
        # A paragraph or heading beside the best container, when it reads like prose.
        reads = linked < 0.25 * len(text) and (len(text) > 80 or text[-1] in ".!?…。" or element.name in ("h1", "h2"))
        return beside is not None and (element is beside or element.parent is beside and element.name in "p h1 h2 h3 pre") and reads

    return "\n".join(text for element, text, linked in blocks if wanted(element, text, linked))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``.

    Null html counts as empty and has the text "". Repeated rows give repeated rows; broken or cut mark-up is read as far
    as it goes; other columns are ignored. Pages are read one at a time, so a task's memory follows its longest page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = [main_text(page.as_py()) for page in part.column(2)]
                counts = pa.array(map(len, texts), pa.int64())
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), counts]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    types = [pages.schema[name].dataType.simpleString() for name in ("page_id", "url")]
    schema = f"page_id {types[0]}, url {types[1]}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
