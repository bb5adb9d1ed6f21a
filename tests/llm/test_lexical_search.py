import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from docs import SCHEMA, awkward, documents, words

from vintara.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def brute(rows, items, top=50):
    """(item_id, rank, doc_id, score) for every item row."""
    docs = [(i, terms(t)) for i, t in rows]
    filled, total = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out = []
    for item, text in items:
        found = []
        for i, w in docs:
            tf = Counter(w)
            score = sum(math.floor(1000 * math.log((2 * filled + 2) / (2 * df[t] + 1))) * (
                10**9 * tf[t] // (1000 * tf[t] + 20 * (100 - 50 + 50 * len(w) * filled // total))) for t in set(terms(text)) if tf[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x", 1, 2.0) for i, t in items], "item_id long, text string, term string, item int, score double")


def got(frame):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in frame.collect()), key=str)


def corpus(n=300, seed=1):
    r = random.Random(seed)
    rows = [(i, words(i, r.randint(1, 120), r.choice([5, 40, 400])) + (" the" * r.randint(0, 5))) for i in range(n)]
    return rows + awkward() + [(None, words(3, 20)), (None, words(3, 20)), (17, words(3, 20))]


def some_items():
    return [(i, words(50 + i, 12) + " the w1 w2") for i in range(12)] + [
        (90, None), (91, " .,"), (92, "nowhere"), (None, "w1 W1 w3"), (None, "w5"), (93, "the"), (93, "The w7"), (94, "É ß 😀"), (95, words(1, 120))]


@pytest.mark.parametrize("top", [1, 5, 50])
@pytest.mark.parametrize("short", [1, 8, 10**6])
def test_brute_force(spark, top, short):
    rows, items = corpus(), some_items()
    frame = documents(spark, rows).repartition(5)
    assert got(S.ranked(frame, items_of(spark, items), top=top, short=short)) == brute(rows, items, top)


def test_blocks_of_items(spark):
    rows, items = corpus(60), some_items()
    assert got(S.ranked(documents(spark, rows), items_of(spark, items), top=7, block_terms=60)) == brute(rows, items, 7)


def test_ties_are_ordered_by_id(spark):
    rows = [(i, "same words here") for i in range(200, 0, -1)] + [(None, "same words here"), (500, "other")]
    items = [(1, "words"), (2, "other same")]
    assert got(S.ranked(documents(spark, rows).repartition(7), items_of(spark, items), top=20)) == brute(rows, items, 20)


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), items_of(spark, [(1, "a b")])
    assert got(S.ranked(none, items)) == []
    assert got(S.ranked(documents(spark, awkward()), items_of(spark, []))) == []
    assert got(S.ranked(documents(spark, [(1, None), (2, " ")]), items)) == []
    assert got(S.ranked(documents(spark, [(1, "zzz")]), items)) == []


def test_terms_of_long_texts(monkeypatch):
    text = words(1, 300) + " É.à!X" * 20 + "y" * 500
    whole = [w.decode() for part in S.pieces_of(text) for w in part]
    monkeypatch.setattr(S, "PIECE", 40)
    parts = list(S.pieces_of(text))
    assert len(parts) > 10 and whole == terms(text) == [w.decode() for part in parts for w in part]


@pytest.mark.parametrize("seed", range(20))
def test_walk_finds_all_that_reach_the_floor(seed):
    r = np.random.default_rng(seed)
    size, lists, sums = 200, [], np.zeros(200, dtype=np.int64)
    for n in r.integers(1, 150, 8):
        places = np.sort(r.choice(size, n, replace=False))
        parts = r.integers(1, r.integers(2, 1000), n)
        lists.append((places, parts, int(parts.max())))
        sums[places] += parts
    for floor in (1, int(np.median(sums)), int(sums.max()), int(sums.max()) + 1):
        places, scores = S._walked(lists, floor, size)
        want = np.flatnonzero(sums >= floor)
        assert places.tolist() == want.tolist() and scores.tolist() == sums[want].tolist()
