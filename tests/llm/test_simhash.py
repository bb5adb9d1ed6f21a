import re

import numpy as np
import xxhash
from docs import awkward, documents, words
from pyspark.sql import functions as F

from vintara.llm import simhash as S
from vintara.llm.components import components


def fingerprint(text, k):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(found[i:i + k]) for i in range(max(1, len(found) - k + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(nodes, linked):
    name = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and name[a] != name[b]:
                    name[a] = name[b] = min(name[a], name[b])
                    changed = True
    return name


def test_equals_brute_force(spark):
    rows = awkward() + [(50 + i, words(1, 120) + f" tail{i}") for i in range(6)]
    prints = {i: fingerprint(t, 4) for i, t in rows}
    name = smallest_reachable(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = S.near_duplicates(documents(spark, rows), words=4, lanes=1, segments=3, radius=4).collect()
    assert {r.doc_id: (r._f0 % 2**64, r.component_id) for r in got} == {i: (prints[i], name[i]) for i in prints}


def test_null_and_repeated_ids_and_empty_table(spark):
    got = S.near_duplicates(documents(spark, [(None, "a b"), (4, "a b"), (4, "a b"), (None, "q r s")]), words=4, lanes=1, segments=3, radius=4)
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got.collect()) == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]
    assert S.near_duplicates(documents(spark, [])).collect() == []
    assert S.without_near_duplicates(documents(spark, [(2, "a b"), (1, "A B"), (3, "c")])).count() == 2


def close(seed, n, radius):
    """Fingerprints around some centres, so that chains of links arise."""
    random_ = np.random.default_rng(seed)
    centres = random_.integers(0, 2**64, max(1, n // 40), dtype=np.uint64)
    out = centres[random_.integers(0, len(centres), n)]
    for _ in range(radius):
        out = out ^ (np.uint64(1) << random_.integers(0, 64, n, dtype=np.uint64))
    return np.unique(out)


def check_links(spark, prints, segments, radius):
    ids = np.arange(len(prints))
    frame = spark.createDataFrame([(int(i), int(p)) for i, p in zip(ids, prints.view(np.int64))], "_least long, _f0 long")
    reached = dict(components(S.links(frame, 1, segments, radius)).collect())
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= radius
    name = ids.copy()
    while True:
        new = np.array([name[near[i]].min() for i in ids])
        if (new == name).all():
            break
        name = new
    assert [reached.get(int(i), int(i)) for i in ids] == name.tolist()


def test_no_link_is_lost(spark, monkeypatch):
    check_links(spark, close(1, 600, 3), 3, 4)
    monkeypatch.setattr(S, "SMALL", 2)  # now nearly all buckets are taken as large
    check_links(spark, close(2, 600, 3), 3, 4)


def test_large_buckets_are_cut_again(monkeypatch):
    monkeypatch.setattr(S, "MEDIUM", 4)
    low, high = S.bounds(3)[1]
    random_ = np.random.default_rng(5)
    prints = np.unique(close(3, 500, 2) & ~np.uint64((1 << high) - (1 << low)) | (np.uint64(1) << random_.integers(low, low + 1, 1, dtype=np.uint64)))
    a, b = S._large(prints[:, None], low, 3, 4)
    linked = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 4
    assert all(near[x, y] for x, y in linked)
    parent = list(range(len(prints)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x, y in linked:
        parent[top(x)] = top(y)
    assert all((top(x) == top(y)) for x, y in zip(*np.nonzero(near)))


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(1, 40)]
    star = [(100, 100 + i) for i in range(1, 300)] + [(101, 50)]
    got = dict(components(spark.createDataFrame(path + star + star, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(2, 41)}, **{100 + i: 50 for i in range(300)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_null_ids_link_and_are_judged_like_others(spark):
    prints = {0: "a b c d", 1: "e f g h"}
    rows = [(7, prints[0]), (None, prints[0]), (None, prints[1]), (None, prints[1]), (None, "q r s")]
    kept = S.without_near_duplicates(documents(spark, rows), words=4, lanes=1, segments=3, radius=4)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([rows[0], rows[2], rows[4]], key=str)


def test_ids_linked_only_through_a_row_without_id(spark, monkeypatch):
    texts = {"one": 0, "two": 0b111, "three": 0b111111}  # each three bits from the next
    monkeypatch.setattr(S, "fingerprints", lambda docs, *_: docs.select(
        F.col("doc_id").alias("_id"), F.create_map(*[F.lit(x) for p in texts.items() for x in p])[F.col("text")].cast("long").alias("_f0")))
    got = S.near_duplicates(documents(spark, [(4, "one"), (None, "two"), (9, "three")]), words=4, lanes=1, segments=3, radius=4)
    assert {r.doc_id: r.component_id for r in got.collect()} == {4: 4, None: 4, 9: 4}
