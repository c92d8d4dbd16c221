"""Hard negatives, lexical search and the shingle join against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skytracks.llm import hard_negatives, lexical_search, shingle_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = "doc_id long, text string, key string, a string, n string, class string, score string, term string"


def words(made: random.Random, count: int, letters: str = "abcdef") -> list[str]:
    return ["".join(made.choice(letters) for _ in range(made.randint(1, 4))) for _ in range(count)]


def edited(made: random.Random, base: list[str], changes: int) -> list[str]:
    found = list(base)
    for _ in range(changes):
        found[made.randrange(len(found))] = "new" + str(made.random())
    return found


def placed(spark, rows):
    """Rows of documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, text, "x", "y", "z", "c", "s", "t") for i, text in rows], CLASHING)


# --- shingle join ---------------------------------------------------------------------------------------------------


def linked(rows, percent=85, width=4):
    sets = []
    for _, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1))} if found else set())
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[max(top(i), top(j))] = min(top(i), top(j))
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        members.setdefault(top(i), []).append(doc_id)
    least = {key: min((x for x in ids if x is not None), default=None) for key, ids in members.items()}
    return Counter((doc_id, len(sets[i]), least[top(i)]) for i, (doc_id, _) in enumerate(rows))


@pytest.fixture(scope="module")
def family():
    """Loose copies of a few texts, texts with a passage in common, and all the odd cases."""
    made = random.Random(1)
    texts = []
    for size, copies in ((120, 60), (40, 12), (400, 5)):
        base = words(made, size)
        texts += [" ".join(edited(made, base, made.randint(0, size // 25))) for _ in range(copies)]
    passage = words(made, 60)
    texts += [" ".join(words(made, 20) + passage + words(made, made.randint(0, 30))) for _ in range(30)]
    texts += [" ".join(words(made, n)) for n in range(1, 40)]
    texts += [None, "", " \n\t", "one", "One", "one two three", "ONE two\nthree", "é é é é é", "a b c d e f g a b c d e f g"]
    texts += [texts[0], texts[0].upper(), " ".join(words(made, 30_000))]
    texts += [texts[-1], texts[-1] + " tail"]
    rows = list(enumerate(texts))
    return [*rows, (3, texts[3]), (None, texts[70]), (None, None), (None, "alone and without an id")]


@pytest.mark.parametrize("block", [shingle_join.BLOCK, 500])
def test_components_are_those_of_all_pairs(spark, family, block):
    found = shingle_join.shingle_components(placed(spark, family), block=block)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(tuple(row) for row in found.collect()) == linked(family)


@pytest.mark.parametrize(("percent", "width"), [(60, 4), (100, 2), (85, 1)])
def test_other_limits_and_widths(spark, family, percent, width):
    found = shingle_join.shingle_components(placed(spark, family), percent=percent, width=width, block=2000)
    assert Counter(tuple(row) for row in found.collect()) == linked(family, percent, width)


def test_a_large_loose_group_gives_a_row_for_each_set(spark):
    """Links come out as roots: what the blocks return grows with the texts, not with their pairs."""
    made = random.Random(2)
    base = words(made, 150)
    rows = [(i, " ".join(edited(made, base, made.randint(0, 6)))) for i in range(1200)]
    found = shingle_join.shingle_components(placed(spark, rows), block=20_000)
    assert Counter(tuple(row) for row in found.collect()) == linked(rows)


def test_no_documents_to_join(spark):
    assert shingle_join.shingle_components(placed(spark, [])).collect() == []
    assert [tuple(row) for row in shingle_join.shingle_components(placed(spark, [(1, None)])).collect()] == [(1, 0, 1)]


# --- lexical search -------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, top):
    held = [(doc_id, Counter(TERM.findall((text or "").translate(LOWER)))) for doc_id, text in docs]
    lengths = [sum(tf.values()) for _, tf in held]
    total, length = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(term for _, tf in held for term in tf)
    rows = Counter()
    for item_id, text in items:
        wanted = set(TERM.findall((text or "").translate(LOWER)))
        weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in wanted if df[t]}
        scored = []
        for (doc_id, tf), n in zip(held, lengths):
            m = 50 + (50 * n * total) // max(length, 1)
            score = sum(w * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t, w in weight.items() if tf[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1):
            rows[(item_id, rank, doc_id, -score)] += 1
    return rows


@pytest.fixture(scope="module")
def corpus():
    made = random.Random(3)
    common = words(made, 40)
    docs = [(i, " ".join(made.choice(common) for _ in range(made.randint(0, 40)))) for i in range(300)]
    docs += [(1000 + i, "Hot text, copied; many-times 7é!") for i in range(80)]
    docs += [(500, None), (501, ""), (502, " .,;"), (None, docs[5][1]), (None, "only here"), (7, docs[7][1]), (503, " ".join(common) * 3000)]
    items = [(i, " ".join(made.choice(common) for _ in range(6))) for i in range(20)]
    items += [(90, "hot COPIED 7É 7é"), (91, None), (92, ""), (93, "?"), (94, "nowhere to befound"), (None, "hot"), (0, items[0][1]), (95, "here only only")]
    return docs, items


@pytest.mark.parametrize("top", [50, 3])
def test_search_gives_the_scores_of_every_document(spark, corpus, top):
    docs, items = corpus
    asked = spark.createDataFrame([(i, text, "x") for i, text in items], "item_id long, text string, terms string")
    found = lexical_search.search(placed(spark, docs), asked, top=top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(row) for row in found.collect()) == ranked(docs, items, top)


def test_search_with_equal_hashes_and_a_small_map(spark, corpus, monkeypatch):
    """Classes of one hash are told apart by content; a full map only carries more along; blocks change nothing."""
    docs, items = corpus
    for name, size in (("CLASSES", 40), ("ITEMS", 5), ("PAIRS", 100)):
        monkeypatch.setattr(lexical_search, name, size)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = lexical_search.search(placed(spark, docs), asked, bits=32, class_hash=lambda: F.pmod(F.xxhash64("terms", "counts"), F.lit(7)))
    assert Counter(tuple(row) for row in found.collect()) == ranked(docs, items, 50)


def test_search_without_documents_or_items(spark, corpus):
    docs, items = corpus
    none = spark.createDataFrame([], "item_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert lexical_search.search(placed(spark, docs), none).collect() == []
    assert lexical_search.search(placed(spark, []), asked).collect() == []


# --- hard negatives -------------------------------------------------------------------------------------------------


def mined(rows, positives=5, negatives=3, low=50, high=95):
    valid = [(i, label, vector, anchor) for i, label, vector, anchor in rows if label is not None and vector is not None and None not in vector]
    rank = lambda entry: (-entry[0], entry[1] is None, entry[1] or 0)
    found = Counter()
    for at, (anchor_id, label, vector, anchor) in enumerate(valid):
        if not anchor:
            continue
        others = [(sum(x * y for x, y in zip(vector, v)), i, other) for k, (i, other, v, _) in enumerate(valid) if k != at]
        same = sorted((x for x in others if x[2] == label), key=rank)[:positives]
        rest = sorted((x for x in others if x[2] != label), key=rank)
        for score, positive_id, _ in same:
            inside = [x for x in rest if low * score <= 100 * x[0] <= high * score]
            for place, (negative, negative_id, _) in enumerate(inside[:negatives], 1):
                found[(anchor_id, positive_id, place, negative_id, score, negative)] += 1
    return found


VECTORS = "vec_id long, label int, vector array<long>, anchor boolean, rid string, score string"


def table_of(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], VECTORS)


@pytest.fixture(scope="module")
def vectors():
    made = random.Random(4)
    rows = []
    centres = [[made.gauss(0, 40) for _ in range(20)] for _ in range(6)]
    for i in range(700):
        label = made.choice([0, 0, 0, 1, 2, 3])
        centre = made.choice(centres)
        rows.append((i, label, [int(c + made.gauss(0, 25)) for c in centre], i % 9 == 0))
    rows += [(800 + i, 1, list(rows[3][2]), False) for i in range(20)]
    rows += [(900, None, rows[0][2], True), (901, 1, None, True), (902, 1, [1, None, 3], True), (903, 2, [], True), (904, 2, [5, -3], True)]
    rows += [(905, 0, [0] * 20, True), (0, rows[0][1], rows[0][2], True), (None, 2, rows[5][2], False), (None, 0, rows[6][2], None), (906, 9, rows[2][2], True)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_mined_rows_are_those_of_all_pairs(spark, vectors, monkeypatch, small):
    if small:
        for name, size in (("ROWS", 50), ("ANCHORS", 7), ("STRIP", 3)):
            monkeypatch.setattr(hard_negatives, name, size)
    found = hard_negatives.hard_negatives(table_of(spark, vectors))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(tuple(row) for row in found.collect()) == mined(vectors)


def test_other_windows(spark, vectors):
    found = hard_negatives.hard_negatives(table_of(spark, vectors), positives=2, negatives=7, low=20, high=100)
    assert Counter(tuple(row) for row in found.collect()) == mined(vectors, 2, 7, 20, 100)


def test_numbers_beyond_doubles(spark):
    made = random.Random(5)
    rows = [(i, i % 3, [made.randrange(-(2**30), 2**30) for _ in range(5)], i % 4 == 0) for i in range(60)]
    assert Counter(tuple(row) for row in hard_negatives.hard_negatives(table_of(spark, rows)).collect()) == mined(rows)


def test_no_vectors(spark):
    assert hard_negatives.hard_negatives(table_of(spark, [])).collect() == []
    assert hard_negatives.hard_negatives(table_of(spark, [(0, 1, [1, 2], True)])).collect() == []
    assert hard_negatives.hard_negatives(table_of(spark, [(0, 1, [], True), (1, 1, [], False), (2, 2, [], False)])).count() == 1


def test_the_index_omits_what_norms_cover(vectors):
    """A high threshold leaves leading dimensions out of the index, and all pairs above it are found all the same."""
    import numpy as np

    matrix = np.array([v for _, _, v, _ in vectors if v and None not in v and len(v) == 20], np.float64)
    anchors = matrix[:50]
    scores = anchors @ matrix.T
    threshold = float(np.quantile(scores, 0.99))
    index = hard_negatives._Index(matrix, anchors, threshold)
    assert index.first.max() > 0 and (index.listed[0] < len(matrix))
    anchor, row, score = index.at_least(anchors, np.full(50, threshold), np.ones(scores.shape, bool))
    assert set(zip(anchor.tolist(), row.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(scores >= threshold))))
    assert (score == scores[anchor, row]).all()
