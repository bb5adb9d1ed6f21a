import re
from collections import Counter

import numpy as np
import pytest
from docs import awkward, documents, words
from hypothesis import given, settings, strategies as st

from vintara.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, phrase string, size int, n long, f long, _text string, part int"


def table(spark, rows):
    """Rows (doc_id, text, lang) with extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y", 4) for r in rows], SCHEMA)


def counted(rows, longest):
    """f by (lang, phrase words), and all words by lang."""
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            found = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(found)
            for k in range(1, longest + 1):
                f.update((lang, tuple(found[i:i + k])) for i in range(len(found) - k + 1))
    return f, n


def brute(rows, longest=3, threshold=10, contained=50, top=2000):
    f, n = counted(rows, longest)
    a = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= threshold}
    kept = []
    for (lang, p), count in a.items():
        inside = any(x[0] == lang and len(x[1]) > len(p) and 100 * v >= contained * count
                     and any(x[1][i:i + len(p)] == p for i in range(len(x[1]))) for x, v in a.items())
        if not inside:
            cuts = [(10**6 * count * count // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((lang, -score, -count, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out, rank = [], Counter()
    for lang, score, count, phrase, left, right in sorted(kept):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -count, left, right, n[lang], -score))
    return out


def got(frame):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in frame.collect())


def some_rows():
    rows = [(i, t, None if i % 7 == 0 else "en") for i, t in awkward()]
    rows += [(100 + i, words(i, 200, 12).replace("w3", "W3. ").replace("w5", "w5,\tx"), "de" if i % 3 else "en") for i in range(30)]
    rows += [(100, words(0, 200, 12), "de"), (None, "all rights reserved " * 40, "en"), (None, "all rights reserved " * 40, "und")]
    return rows + [(7, "new york new york " * 20, None), (8, "ÉA éa ÉA éa " * 12, "fr")]


@pytest.mark.parametrize("longest", [2, 3, 4, 5])
def test_brute_force(spark, longest):
    rows = some_rows()
    want = brute(rows, longest)
    assert len(want) > 20 and got(C.collocations(table(spark, rows), longest=longest)) == want


def test_settings(spark):
    rows = some_rows()
    frame = table(spark, rows)
    assert got(C.collocations(frame, threshold=5, contained=90, top=7)) == brute(rows, threshold=5, contained=90, top=7)
    # overflowing summaries and a map that lets nearly everything through change nothing
    assert got(C.collocations(frame, capacity=16, filter_bits=1024)) == brute(rows)
    assert got(C.collocations(frame, threshold=300, capacity=64)) == brute(rows, threshold=300)


def test_empty_tables(spark):
    assert got(C.collocations(table(spark, []))) == []
    assert got(C.collocations(table(spark, [(1, None, None), (2, "", "en"), (3, " \t\n.", "en")]))) == []
    assert got(C.collocations(documents(spark, [(1, "one two three")]))) == []


def test_products_beyond_64_bits(spark):
    """10**6 * a * a passes 64 bits from a = 3.1 million on; the ratio is taken of decimals."""
    frame = spark.createDataFrame([(4_000_000_000, 5_000_000_000, 4_100_000_000)], "a long, l long, r long")
    whole = lambda c: C.F.col(c).cast("decimal(15,0)")
    frame = frame.withColumns({"_above": (C.F.lit(1_000_000).cast("decimal(7,0)") * (whole("a") * whole("a"))).cast("decimal(38,0)"),
                               "_below": (whole("l") * whole("r")).cast("decimal(31,0)")})
    assert frame.selectExpr("_above div _below AS s").first().s == 10**6 * 4_000_000_000**2 // (5_000_000_000 * 4_100_000_000)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12)), max_size=30), max_size=12), st.integers(1, 30), st.integers(2, 30))
def test_summaries_lose_no_frequent_key(batches, capacity, threshold):
    summary, truth = C.Summary(capacity, threshold), Counter()
    for batch in batches:
        for key, n in batch:
            truth[key] += n
        summary.add(np.array([k for k, _ in batch], dtype=np.uint32), np.array([min(n, threshold) for _, n in batch], dtype=np.uint8))
    left = set(summary.survivors().tolist())
    assert {k for k, n in truth.items() if n >= threshold} <= left and left <= set(truth)
    mass = sum(truth.values())
    # no more than the foreseen counters are needed where the capacity exceeds mass / threshold
    assert capacity <= mass // threshold or summary.capacity == capacity


@pytest.mark.parametrize("longest", [1, 2, 3, 4])
def test_long_texts_are_read_in_overlapping_blocks(monkeypatch, longest):
    monkeypatch.setattr(C, "LONG", 50)
    monkeypatch.setattr(C, "BLOCK", 40)
    rows = [(1, words(3, 400, 9).replace("w4 ", "w4.\n"), "en"), (2, words(4, 30, 9), "en"), (3, "x" * 300 + " y", "de")]
    f, n = Counter(), Counter()
    for lang, block, total in C._blocks([(lang, text) for _, text, lang in rows], longest):
        n[lang] += total
        for _, parts, counts in block.phrases():
            for part, count in zip(parts.tolist(), counts.tolist(), strict=True):
                f[lang, tuple(block.words[i].decode() for i in part)] += count
    assert (f, n) == counted(rows, longest)
