import random
import time

import numpy as np
from docs import awkward, documents, words
from hypothesis import given, settings, strategies as st

from vintara.llm import substring_dedup as S


def expected(rows, n=50):
    """Removed spans and kept bytes per row, straight from the definition."""
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0))
    first = {}
    for r in order:
        data = (rows[r][1] or "").encode()
        for p in range(len(data) - n + 1):
            first.setdefault(data[p:p + n], rows[r][0])
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=bool)
        for p in range(len(data) - n + 1):
            if first[data[p:p + n]] != i:
                gone[p:p + n] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        out.append((i, len(data), edge[::2].tolist(), edge[1::2].tolist(), bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.doc_id, r.n_bytes, list(r.starts), list(r.ends), bytes(r.kept)) for r in frame.collect()), key=str)


def test_equals_brute_force(spark):
    shared, rows = words(9, 25), awkward()
    rows += [(100 + i, words(20 + i, 15) + " " + shared + " " + words(40 + i, 15)) for i in range(12)]
    rows += [(200 + i, shared[i:i + 80]) for i in range(0, 40, 7)] + [(300, "x" * 120), (301, "x" * 60), (302, "yx" * 70)]
    assert found(S.without_repeats(documents(spark, rows))) == expected(rows)


def test_null_and_repeated_ids(spark):
    text = words(3, 30)
    rows = [(None, text), (4, text), (4, text), (None, words(5, 30)), (1, "short")]
    assert found(S.without_repeats(documents(spark, rows))) == expected(rows)


def test_empty_table(spark):
    assert S.without_repeats(documents(spark, [])).collect() == []


def test_long_text_is_hashed_in_parts(monkeypatch):
    text = words(8, 900).encode()
    whole = list(S.runs([text], 50))
    monkeypatch.setattr(S, "PACK_BYTES", 700)
    spread = lambda parts: [h for p in parts for c, h in zip(p[2], p[3]) for _ in range(c)]
    assert spread(S.runs([text], 50)) == spread(whole)


@given(st.lists(st.binary(min_size=0, max_size=60), min_size=1, max_size=8), st.integers(2, 9), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_suffix_sort_orders_first_bytes(parts, n, buckets):
    data = np.frombuffer(b"".join(bytes(b % 3 for b in p) for p in parts) + bytes(n), dtype=np.uint8)
    starts = np.arange(len(data) - n + 1)
    bucket = np.sort(np.array([random.Random(int(i)).randint(0, buckets) for i in starts]))
    ordered, classes = S.equal_strings(data, starts, bucket, n)
    strings = [data[s:s + n].tobytes() for s in ordered]
    for b in np.unique(bucket):
        at = np.flatnonzero(bucket == b)
        assert sorted(ordered[at]) == sorted(starts[at])
        assert [strings[i] for i in at] == sorted(strings[i] for i in at)
        assert len(set(classes[at])) == len({strings[i] for i in at})


def test_hash_collisions_are_caught(monkeypatch):
    monkeypatch.setattr(S, "_symbols", lambda: np.ones(256, dtype=np.uint64))  # every byte hashes alike
    data = np.frombuffer(b"abcabdabcxyz", dtype=np.uint8)
    starts = np.arange(0, 9, 3)
    ordered, classes = S.equal_strings(data, starts, np.zeros(3, dtype=int), 3)
    named = {}
    for s, c in zip(ordered, classes):
        named.setdefault(data[s:s + 3].tobytes(), set()).add(c)
    assert len(named) == 2 and all(len(v) == 1 for v in named.values()) and named[b"abc"] != named[b"abd"]


def test_runs_around_one_string_are_sorted_fast():
    """Different surroundings of one very common string meet as one group."""
    drawn = np.random.default_rng(4).integers(97, 123, (12000, 82), dtype=np.uint8)
    drawn[:, 32:50] = np.frombuffer(b"a very common line", dtype=np.uint8)
    drawn[1::2, 20:] = drawn[::2, 20:]  # every other one shares its end with the one before
    drawn[:, 19] = 97 + np.arange(len(drawn)) % 2
    contents = [row.tobytes() for row in drawn]
    hashes = np.full(len(contents), S._mixed(S._mixed(S.PrefixHashes(drawn[0]).everywhere(S.GRAM)))[32].view(np.int64))
    began = time.process_time()
    found = S._covered_inside(contents, np.full(len(contents), 33), hashes, np.arange(len(contents)), 50)
    assert time.process_time() - began < 3
    assert sorted(zip(*(x.tolist() for x in found))) == [(i, 20, 13) for i in range(1, len(contents), 2)]


def test_zero_bytes_count():
    data = np.frombuffer(b"ab\0\0ab\0ab", dtype=np.uint8)
    ordered, classes = S.equal_strings(data, np.array([0, 4, 7]), np.zeros(3, dtype=int), 2)
    assert len(set(classes)) == 1
    ordered, classes = S.equal_strings(data, np.array([0, 4]), np.zeros(2, dtype=int), 4)
    assert ordered.tolist() == [0, 4] and len(set(classes)) == 2
