import random

import numpy as np
import pytest
from docs import awkward, documents, words

import corpus_pipeline
from vintara.llm import similar_sets as S


def shingles(text, k=5):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {" ".join(found[i:i + k]) for i in range(max(1, len(found) - k + 1))} if found else set()


def expected(rows, similarity=0.8):
    """Texts that stay: of what links connect, the one with the smallest id, null ids last."""
    sets = [shingles(t) for _, t in rows]
    name = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            either = len(sets[a] | sets[b])
            if not either or len(sets[a] & sets[b]) / either >= similarity:
                old, new = name[a], name[b]
                name = [new if x == old else x for x in name]
    best = {}
    for at, of in enumerate(name):
        best[of] = min(best.get(of, at), at, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    return sorted((rows[i] for i in best.values()), key=str)


def changed(text, n, seed):
    random_, found = random.Random(seed), text.split()
    for i in range(n):
        found[random_.randrange(len(found))] = f"x{seed}y{i}"
    return " ".join(found)


def many():
    line = "this same line of eleven words is in all of them "
    rows = [(100 + i, words(500 + i, 500, 10**6) + " " + line * 200) for i in range(12)]  # different but for one line
    rows += [(None, words(500, 500, 10**6) + " " + line * 150), (None, "only here and without an id"), (None, "two of them here no id"),
             (None, "Two of  them here no id")]
    for group in range(6):  # from nearly equal to below the limit
        base = words(900 + group, 200, 10**6)
        rows += [(1000 + 30 * group + i, changed(base, i % 8, 31 * group + i)) for i in range(25)]
    return rows


@pytest.mark.parametrize(("small", "often"), [(8, 8), (2, 1)])
def test_equals_brute_force(spark, monkeypatch, small, often):
    monkeypatch.setattr(S, "SMALL", small)
    monkeypatch.setattr(S, "SAMPLE", 2)
    monkeypatch.setattr(S, "OFTEN", often)
    monkeypatch.setattr(S, "BLOCK", small)
    monkeypatch.setattr(S, "PAIRS", 20)
    monkeypatch.setattr(S, "SCREENED", 40)
    rows = [*many(), *((i, t) for i, t in awkward() if i != 19)]
    docs = documents(spark, rows)
    got = S.without_similar(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == expected(rows)


def test_stage_judges_sets_and_keeps_null_ids(spark, sf_dir):
    rows = many()
    got = corpus_pipeline.simhash_near_dedup(spark, documents(spark, rows), sf_dir)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == expected(rows)


def test_empty_table(spark):
    assert S.without_similar(documents(spark, [])).collect() == []


def test_bitmaps_never_rule_out_a_similar_pair():
    random_ = np.random.default_rng(5)
    ruled_out = 0
    for trial in range(300):
        size = int(random_.integers(0, 3000))
        hashes = random_.integers(0, 2**63, size=size + 800, dtype=np.uint64)
        a, b = np.unique(hashes[:size]), np.unique(hashes[int(random_.integers(0, 400)):size + int(random_.integers(0, 400))])
        different = len(np.setxor1d(a, b))
        least = S._least_difference(S._bitmap(a), S._bitmap(b))
        assert least <= different
        ruled_out += least > (len(a) + len(b)) / 9 >= 0 and different > (len(a) + len(b)) / 9
    assert ruled_out > 20
    assert S._least_difference(S._bitmap(hashes[:0]), S._bitmap(hashes[:0])) == 0
