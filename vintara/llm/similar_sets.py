"""Rows whose shingle sets are similar, exactly: a prefix filter finds candidates, the sets themselves decide.

All shingles are put in one order, those of many documents last. Two sets with a Jaccard similarity of at least ``similarity`` have
their first common shingle among the first ``n - ceil(similarity * n) + 1`` of either, so rows meet by these shingles and no such
pair is missed. Sizes and the places of the common shingle rule out most pairs, then bitmaps of the sets: hashes that only one
of two sets has change a parity each, so the bits in which two bitmaps differ are never more than these. The sets of pairs that
are left are intersected. Which shingles count as frequent is estimated on a part of the rows: it moves work, never results.

A small bucket (rows with one shingle) gives all its pairs, a larger one first a star around its first row. Of these one pair a
row is verified and joined to components; then follow all other pairs whose rows are still apart, also those of the larger buckets,
which are read again.

Defined cases: a set holds the 64-bit hashes of the distinct shingles; rows without words have the empty set and are linked to each
other; with fewer words than a shingle the whole sequence is the shingle; each row is judged by itself, whatever its
id; of a component the row with the smallest id stays, null ids last; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from vintara.llm.common import whole_text, written
from vintara.llm.components import components, numbered_rows, smallest_stay
from vintara.llm.simhash import shingle_hashes, stars

SMALL = 8  # buckets up to this size give all their pairs at once
SAMPLE = 16  # one row of so many is read for frequent shingles
OFTEN = 8  # sampled rows that make a shingle frequent
FREQUENT = 100_000  # frequent shingles held at once
ROWS = 200_000  # rows of a frame handed on
BLOCK = 64  # rows of a block, about
PAIRS = 512  # pairs of a group of blocks, about
SCREENED = 8192  # the same where bitmaps are compared
LEAST_BITS = 512
EPS = 1e-9


def shingle_set(text: str, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def _frequent(read: DataFrame, words: int) -> np.ndarray:
    """The most frequent shingles of a part of the rows, sorted."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingle_set(t, words) for t in frame["_text"]]
            if sets:
                keys, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pd.DataFrame({"key": keys.view(np.int64), "n": n})

    part = read.where(F.pmod(F.xxhash64("_node"), F.lit(SAMPLE)) == 0)
    counts = part.mapInPandas(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
    top = counts.orderBy(F.desc("n"), "key").limit(FREQUENT).collect()  # bounded
    return np.sort(np.array([r["key"] for r in top], dtype=np.int64).view(np.uint64))


def _prefixes(read: DataFrame, words: int, similarity: float, frequent: np.ndarray) -> DataFrame:
    """(key, node, n, at): the first shingles of every set, its size and the shingle's place."""
    def first(text: str) -> tuple[int, np.ndarray]:
        found = shingle_set(text, words)
        n = len(found)
        if not n:
            return 0, np.zeros(1, dtype=np.uint64)
        if len(frequent):
            often = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found
            found = np.concatenate([found[~often], found[often]])
        return n, found[:n - math.ceil(similarity * n - EPS) + 1]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, sizes, held, size = [], [], [], 0

        def out() -> pd.DataFrame:
            lengths = [len(h) for h in held]
            return pd.DataFrame({
                "key": np.concatenate(held).view(np.int64), "node": np.repeat(np.array(nodes, dtype=np.int64), lengths),
                "n": np.repeat(np.array(sizes, dtype=np.int32), lengths),
                "at": np.concatenate([np.arange(x, dtype=np.int32) for x in lengths])})

        for frame in frames:
            for node, text in zip(frame["_node"], frame["_text"], strict=True):
                n, keys = first(text)
                nodes.append(node)
                sizes.append(n)
                held.append(keys)
                size += len(keys)
                if size >= ROWS:
                    yield out()
                    nodes, sizes, held, size = [], [], [], 0
        if held:
            yield out()

    return read.mapInPandas(run, "key long, node long, n int, at int")


def _possible(n: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether rows a and b, if the shingle is their first common one, can be similar enough."""
    low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
    rest = np.minimum(n[a] - at[a], n[b] - at[b])
    return (low >= similarity * high - EPS) & (rest >= similarity / (1 + similarity) * (n[a] + n[b]) - EPS)


def _whole_buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted frames, cut anew so that none ends inside a bucket."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = frame["key"].iloc[-1]
        if held and held[0]["key"].iloc[0] == last:  # still inside one bucket
            held.append(frame)
            continue
        whole = pd.concat([*held, frame], ignore_index=True)
        cut = int(np.searchsorted(whole["key"].to_numpy(), last))
        if cut:
            yield whole.iloc[:cut]
        held = [whole.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _arrays(frame: pd.DataFrame, *names: str) -> list[np.ndarray]:
    return [frame[x].to_numpy(dtype=np.int64) for x in names]


def _pair_frame(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    pairs = np.unique(np.stack([np.minimum(node[a], node[b]), np.maximum(node[a], node[b])], axis=1), axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def _met(prefixes: DataFrame, similarity: float) -> DataFrame:
    """Candidates (a, b) of all buckets, and the rows (key, node, n, at) of the larger ones with a and b null."""
    columns = ["a", "b", "key", "node", "n", "at"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_buckets(frames):
            key, node, n, at = _arrays(frame, "key", "node", "n", "at")
            starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            sizes = np.diff(np.append(starts, len(key)))
            size, start = np.repeat(sizes, sizes), np.repeat(starts, sizes)
            large = size > SMALL
            left, right = [start[large]], [np.flatnonzero(large)]
            small = np.flatnonzero((size > 1) & ~large)
            for step in range(1, SMALL):
                same = np.flatnonzero(key[small[:-step]] == key[small[step:]])
                left.append(small[same])
                right.append(small[same + step])
            a, b = np.concatenate(left), np.concatenate(right)
            fit = (a != b) & _possible(n, at, a, b, similarity)
            found = _pair_frame(node, a[fit], b[fit])
            for out in (found, frame[large]):
                if len(out):
                    yield out.reindex(columns=columns).astype({c: "Int64" for c in columns})

    # the first row of a bucket is one of the smallest number, mostly the same in the buckets of one group
    sorted_ = prefixes.repartition(_tasks(prefixes), "key").sortWithinPartitions("key", "node")
    return sorted_.mapInPandas(run, "a long, b long, key long, node long, n int, at int")


def _tasks(frame: DataFrame) -> int:
    return 2 * int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _apart(rows: DataFrame, similarity: float, block: int = 256) -> DataFrame:
    """Candidates (a, b) of the larger buckets whose rows have different components; rows are (key, node, n, at, component)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_buckets(frames):
            key, node, n, at, component = _arrays(frame, "key", "node", "n", "at", "component")
            edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for low, high in zip(edges, edges[1:], strict=False):
                if (component[low:high] == component[low]).all():
                    continue
                for start in range(low, high, block):
                    stop = min(start + block, high)
                    # rows of a bucket ascend in size
                    last = low + int(np.searchsorted(n[low:high], n[stop - 1] / similarity + EPS, "right"))
                    a, b = np.nonzero(component[start:stop, None] != component[None, start:last])
                    a, b = a + start, b + start
                    fit = a < b
                    a, b = a[fit], b[fit]
                    fit = _possible(n, at, a, b, similarity)
                    if fit.any():
                        yield _pair_frame(node, a[fit], b[fit])

    return rows.repartition(_tasks(rows), "key").sortWithinPartitions("key", "n", "node").mapInPandas(run, "a long, b long")


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    """The parity of how many hashes fall on each bit, at least two bits a hash; the number of bits is a power of two."""
    bits = max(LEAST_BITS, 1 << (2 * len(hashes) - 1).bit_length()) if len(hashes) else LEAST_BITS
    return np.packbits(np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").view(np.uint64)


def _least_difference(a: np.ndarray, b: np.ndarray) -> int:
    """How many hashes are at least in only one of the sets of two bitmaps: each of them changes one parity. The longer bitmap is folded."""
    size = min(len(a), len(b))
    folded = (np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) for x in (a, b))
    return int(np.bitwise_count(np.bitwise_xor(*folded)).sum())


def _judged(rows: DataFrame, pairs: DataFrame, size: int, pack: Callable[[str | bytes], bytes],
            judge: Callable[[pd.DataFrame, dict[int, bytes]], pd.DataFrame], kind: str) -> DataFrame:
    """What ``judge`` says of groups of about ``size`` of the written ``pairs`` (a, b), written.

    Pairs are dealt into groups of blocks of rows, and each group is sent what ``pack`` makes of the ``_content`` of its rows, once from
    where it is read.
    """
    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"groups": frame["groups"], "node": frame["node"], "packed": [pack(x) for x in frame["_content"]]})

    def judged(pairs: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        return judge(pairs, dict(zip(sent["node"].tolist(), sent["packed"], strict=True)))

    groups = max(1, pairs.count() // size)
    # a row is in the block of the smallest row it meets; it goes once to each group of blocks, not to each pair
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    nodes = nodes.join(pairs.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("leader")), "node", "left").select(
        "node", F.coalesce("leader", "node").alias("leader"))
    parts = F.ceil(F.col("n") / BLOCK)
    blocks = written(nodes.join(nodes.groupBy("leader").agg(F.count(F.lit(1)).alias("n")), "leader").select(
        "node", F.xxhash64("leader", F.pmod(F.xxhash64("node"), parts)).alias("block")), "blocks")
    one, other = (blocks.select(F.col("node").alias(x), F.col("block").alias(f"_{x}")) for x in "ab")
    dealt = written(pairs.join(one, "a").join(other, "b").select(
        "a", "b", F.pmod(F.xxhash64("_a", "_b"), F.lit(groups)).alias("group")), "dealt")
    wanted = dealt.select(F.col("a").alias("node"), "group").union(dealt.select("b", "group")).groupBy("node").agg(F.collect_set("group").alias("groups"))
    sent = rows.join(wanted, F.col("_node") == F.col("node")).select("groups", "node", "_content").mapInPandas(
        packed, "groups array<long>, node long, packed binary").select(F.explode("groups").alias("_group"), "node", "packed")
    return written(dealt.groupBy("group").cogroup(sent.groupBy("_group")).applyInPandas(judged, "a long, b long"), kind)


def _sketches(read: DataFrame, words: int) -> DataFrame:
    """(_node, _content): the size and the bitmap of every row's set, written, so that no text is shuffled to compare bitmaps."""
    def sketch(text: str) -> bytes:
        found = shingle_set(text, words)
        return np.concatenate([np.array([len(found)], dtype=np.uint64), _bitmap(found)]).tobytes()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"_node": frame["_node"], "_content": [sketch(t) for t in frame["_text"]]})

    return written(read.mapInPandas(run, "_node long, _content binary"), "sketches")


def _verified(read: DataFrame, sketches: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Pairs (a, b) that connect all rows which the given pairs of at least this Jaccard similarity of their shingle sets connect, written.

    Bitmaps of the sets go first and rule out pairs that certainly differ in more than a similar pair can: a bitmap takes a small part of a
    text. Of what is left the packed texts are sent: a text takes a fraction of its set, and no set is written or shuffled.
    """
    most = (1 - similarity) / (1 + similarity)  # hashes in one set only, of those in the one and those in the other

    def screen(pairs: pd.DataFrame, sent: dict[int, bytes]) -> pd.DataFrame:
        of = {n: np.frombuffer(x, dtype=np.uint64) for n, x in sent.items()}
        fit = [_least_difference(of[a][1:], of[b][1:]) <= most * (int(of[a][0]) + int(of[b][0])) + EPS
               for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist(), strict=True)]
        return pairs.loc[np.array(fit, dtype=bool), ["a", "b"]]

    def compress(text: str) -> bytes:
        return zstandard.compress(text.encode())

    def decide(pairs: pd.DataFrame, sent: dict[int, bytes]) -> pd.DataFrame:
        of = {n: shingle_set(zstandard.decompress(x).decode(), words) for n, x in sent.items()}
        fit = []
        for a, b in zip(pairs["a"], pairs["b"], strict=True):
            both = len(np.intersect1d(of[a], of[b], assume_unique=True))
            either = len(of[a]) + len(of[b]) - both
            fit.append(not either or both / either >= similarity)
        # what is linked within the group goes on as stars: as many edges as rows, however many pairs
        nodes, at = np.unique(pairs.loc[np.array(fit, dtype=bool), ["a", "b"]].to_numpy(dtype=np.int64), return_inverse=True)
        at = at.reshape(-1, 2)
        centre, row = stars(len(nodes), at[:, 0], at[:, 1])
        return pd.DataFrame({"a": nodes[centre], "b": nodes[row]})

    pairs = written(pairs.distinct(), "candidates")
    left = _judged(sketches, pairs, SCREENED, bytes, screen, "screened")
    return _judged(read.withColumnRenamed("_text", "_content"), left, PAIRS, compress, decide, "links")


def similar(read: DataFrame, words: int, similarity: float) -> DataFrame:
    """(node, component) for the rows (_node, _text) that links connect to a row with a smaller number. A link joins two rows
    whose sets have at least this Jaccard similarity; what earlier links connect is not compared again."""
    prefixes, sketches = _prefixes(read, words, similarity, _frequent(read, words)), _sketches(read, words)
    met = written(_met(prefixes, similarity), "met")
    pairs = written(met.where("a is not null").select("a", "b").distinct(), "pairs")
    links = _verified(read, sketches, pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), words, similarity)
    reached = components(links)
    component = F.coalesce("component", "node").alias("component")
    rows = met.where("a is null").select("key", "node", "n", "at").join(reached, "node", "left").select("key", "node", "n", "at", component)
    one = reached.select(F.col("node").alias("a"), F.col("component").alias("_one"))
    other = reached.select(F.col("node").alias("b"), F.col("component").alias("_other"))
    left = pairs.join(one, "a", "left").join(other, "b", "left").where(F.coalesce("_one", "a") != F.coalesce("_other", "b"))
    more = _verified(read, sketches, left.select("a", "b").union(_apart(rows, similarity)), words, similarity)
    return components(links.union(more))


def without_similar(docs: DataFrame, words: int = 5, similarity: float = 0.8, text: str = "text",
                    identifier: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without those that links connect to one with a smaller id."""
    keyed = numbered_rows(docs)
    read = keyed.select("_node", whole_text(f"_doc.{text}").alias("_text"))
    return smallest_stay(keyed, similar(read, words, similarity), identifier)
