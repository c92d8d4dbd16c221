"""Tree scoring against the same rule by climbing, deep pages, names as weights."""

from __future__ import annotations

import random
import time

import pytest

from skytracks.llm import html_text

NAMES = (
    "div p ul li article main section table tr td h1 header nav aside b a blockquote pre form dl dt dd body html head"
).split()
PROSE = "A long sentence of prose, with a comma, that tells something about the matter at hand. "


def _climb(element):
    while element is not None:
        yield element
        element = element.parent


def _by_climbing(page: str) -> str:
    """The rule of ``main_text`` said plainly: every block and link climbs to the root, every choice looks at all ancestors."""
    blocks, elements = html_text._blocks(page)
    links = {id(each): sum(each in _climb(other) for other in elements for _ in range(other.links)) for each in elements}
    own = [(1 + len(text) / 100 + sum(map(text.count, ",،、"))) * (1 - linked / len(text)) for _, text, linked in blocks]
    blocks = [(*block, points) for block, points in zip(blocks, own, strict=True) if not block[0].dropped and points >= block[0].against]
    if not blocks:
        return ""
    chars, linked_chars, points, order = {}, {}, {}, []
    for element, text, linked, own_points in blocks:
        for above in _climb(element):
            chars[id(above)] = chars.get(id(above), 0) + len(text)
            linked_chars[id(above)] = linked_chars.get(id(above), 0) + linked
        container = element.parent if element.name in ("p", "pre", "td", "li", "blockquote") else element
        for level, above in enumerate(_climb(container)):
            share = 1 if level == 0 else 1 / 2 if level == 1 else 1 / 6 / 2 ** (level - 2)
            if id(above) not in points:
                order.append(above)
            points[id(above)] = points.get(id(above), 0) + own_points * share

    def prose(element):
        return 1 - linked_chars.get(id(element), 0) / chars[id(element)] if chars.get(id(element)) else 0.0

    def merit(element):
        bonus = 1.5 if element.name in ("article", "main") else 1.2 if element.likely else 1.0
        return round(points[id(element)] * prose(element) * bonus, 9)

    best = max(order, key=merit)
    whole = [each for each in _climb(best) if each.name in ("article", "main")]
    beside = None if whole else best.parent
    best = whole[-1] if whole else best
    kept = [best]
    if beside is not None:
        limit = max(0.2 * points[id(best)], 1.0)
        kept += [each for each in order if each.parent is beside and prose(each) > 0.5 and points[id(each)] >= limit]

    def menu(element):
        boxes = ("ul", "ol", "dl", "div", "section", "table")
        return links[id(element)] >= 2 and element.name in boxes and prose(element) < 0.25

    out = []
    for element, text, linked, _ in blocks:
        above = list(_climb(element))
        inner = next((i for i, each in enumerate(above) if any(each is one for one in kept)), None)
        if inner is not None:
            stays = not any(map(menu, above[:inner]))
        else:
            reads = linked < 0.25 * len(text) and (len(text) > 80 or text[-1] in ".!?…。" or element.name in ("h1", "h2"))
            near = element is beside or element.parent is beside and element.name in ("p", "h1", "h2", "h3", "pre", "h")
            stays = beside is not None and near and reads
        if stays:
            out.append(text)
    return "\n".join(out)


def _page(rnd: random.Random) -> str:
    out = []
    for _ in range(rnd.randrange(80)):
        chance, name = rnd.random(), rnd.choice(NAMES)
        if chance < 0.4:
            out.append(f"<{name}{rnd.choice(['', '', ' class=entry', ' class=menu', ' class=social', ' id=x-text'])}>")
        elif chance < 0.65:
            out.append(f"</{name}>")
        else:
            out.append(rnd.choice(["word, ", PROSE * rnd.randrange(1, 6), f"x{rnd.random()} "]))
    return "".join(out)


@pytest.mark.parametrize("seed", range(8))
def test_pages_as_by_climbing(seed):
    rnd = random.Random(seed)
    pages = [_page(rnd) for _ in range(150)]
    found = [html_text.main_text(page) for page in pages]
    assert found == [_by_climbing(page) for page in pages]
    assert sum(map(bool, found)) > 30


def test_pages_of_the_tables_as_by_climbing(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()
    found = [html_text.main_text(row.html) for row in pages]
    assert found == [_by_climbing(row.html or "") for row in pages] and any(found)


@pytest.mark.parametrize(
    "page",
    [
        "<div><p>some text here, and there" * 100_000,
        "<article>" + "<div>" * 100_000 + "<p>text, and more</p></p><a href=x>l</a></li>" * 50_000,
        "<ul><li>one" * 100_000 + "</body>" * 1000,
    ],
)
def test_time_follows_the_length_at_any_depth(page):
    """Climbing would take hours: ten thousand million steps."""
    begun = time.process_time()
    assert html_text.main_text(page)
    assert time.process_time() - begun < 20


def test_names_only_take_points_from_paragraphs_of_the_text():
    text = "<article><p>{0}</p><p class='social'>{1}</p><p class='share'>Share this</p><div class='social'>{1}</div></article>"
    other = "Networks of people, firms and towns change, and so do the words that are used for them. " * 3
    assert html_text.main_text(text.format(PROSE, other)) == f"{PROSE.strip()}\n{other.strip()}"
    comments = "<article><p>{0}</p><p class='comment'>{1}</p><div class='sidebar'>{1}</div><p class='advert'>{1}</p></article>"
    assert html_text.main_text(comments.format(PROSE, other)) == PROSE.strip()
