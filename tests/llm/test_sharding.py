import zlib
from collections import Counter, defaultdict

from docs import awkward, documents, words

from vintara.llm.sharding import kd_shards, shard_count


def checked(rows, got):
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)


def test_sizes_are_near_equal_despite_copies(spark):
    rows = [(i, "copy " * 20 if i % 3 == 0 else words(i, 5 + i % 40)) for i in range(3000)]
    got = kd_shards(documents(spark, rows), shards=40).collect()
    checked(rows, got)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert sorted(sizes) == list(range(40))
    assert max(sizes.values()) - min(sizes.values()) < 1500  # a few documents


def test_awkward_rows(spark):
    rows = [*awkward(), (None, "x"), (None, None), (8, "again"), (8, "again")]
    checked(rows, kd_shards(documents(spark, rows), shards=5).collect())


def test_more_shards_than_rows_and_empty(spark):
    checked([(1, "a")], kd_shards(documents(spark, [(1, "a")]), shards=7).collect())
    assert kd_shards(documents(spark, [])).collect() == []


def test_shard_count(spark):
    assert shard_count(documents(spark, [(1, "a" * 84), (2, None)]), 50) == 3
    assert shard_count(documents(spark, []), 50) == 1
