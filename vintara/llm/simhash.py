"""Near duplicates by SimHash fingerprints, found with deletion-variant signatures.

A fingerprint has ``lanes`` x 64 bits, each lane cut into ``segments``. Two fingerprints that differ in at most
``2 * segments * lanes - 1`` bits have a segment in which they differ in at most one, and then agree in a
variant of that segment with one bit position blanked. Every distinct fingerprint is therefore listed under one variant
per bit, rows meet by equal variants, and their whole distance is verified. Three segments serve a radius of up
to 5 bits in 64 with the longest keys. With a wider ``radius`` a pair is found if any segment comes that
close, which is then probable, not certain.

Copies share a fingerprint and are one row in the search. A bucket of many fingerprints is walked from
one member to its neighbours, each found member leaving the bucket, so the work follows its links and
not all pairs; a larger bucket without many links is first cut again by variants of its remaining bits, which
is exact for the same reason. What links connect within a bucket goes on as a star around its smallest id, so a group of
near copies that meets in many buckets repeats few edges. Components are then those of all stars.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; with fewer words than a
shingle the whole sequence is the shingle; repeated rows share a component; a null id gets the component of
its fingerprint but names none; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from vintara.llm.common import whole_text, written
from vintara.llm.components import components, numbered_rows, smallest_stay

SEED = 42
SMALL = 48  # buckets up to this size are compared pair by pair
MEDIUM = 4096  # and up to this size by blocks of distances
CHUNK = 1 << 16  # shingles counted at once


def bounds(segments: int) -> list[tuple[int, int]]:
    """First and following bit of each segment of a lane."""
    return [(64 * i // segments, 64 * (i + 1) // segments) for i in range(segments)]


def radius_for(similarity: float, lanes: int) -> int:
    """Distance of two texts whose shingle sets have this Jaccard similarity: the expected one and a standard deviation."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(64 * lanes * share + math.sqrt(64 * lanes * share * (1 - share)))


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words, lower-cased in A-Z, joined by spaces."""
    found = text.encode().lower().split()  # bytes split at \x20 and \x09-\x0D only
    if not found:
        return np.empty(0, dtype=np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-words] + 1])
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1:].tolist(), strict=True)),
                       dtype=np.uint64, count=len(starts))


def _remixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Another 64 bits from the same hash, for lanes after the first."""
    if lane == 0:
        return hashes
    x = hashes + np.uint64((lane * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = np.ascontiguousarray(hashes[start:start + CHUNK], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, lanes: int = 1, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """Id as ``_id`` and one signed 64-bit column ``_f0``, ``_f1``, ... per lane."""
    names = [f"_f{i}" for i in range(lanes)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = np.zeros((len(frame), lanes), dtype=np.uint64)
            for row, content in enumerate(frame["_text"]):
                hashes = shingle_hashes(content, words)
                for lane in range(lanes):
                    out[row, lane] = fingerprint(_remixed(hashes, lane))
            signed = out.view(np.int64)
            yield pd.DataFrame({"_id": frame["_id"], **{n: signed[:, i] for i, n in enumerate(names)}})

    # ids travel as text, which keeps a null a null
    read = docs.select(F.col(identifier).cast("string").alias("_id"), whole_text(text).alias("_text"))
    found = read.mapInPandas(run, ", ".join(["_id string", *(f"{n} long" for n in names)]))
    return found.withColumn("_id", F.col("_id").cast("long"))


def _variants(lanes: int, segments: int) -> Column:
    """One key per bit: the bit's number, and its segment with that bit blanked."""
    keys = []
    for lane in range(lanes):
        for low, high in bounds(segments):
            for bit in range(low, high):
                mask = ((1 << high) - (1 << low)) & ~(1 << bit)
                signed = mask - 2**64 if mask >= 2**63 else mask
                segment = F.shiftrightunsigned(F.col(f"_f{lane}").bitwiseAND(F.lit(signed)), low)
                keys.append(segment + F.lit((lane * 64 + bit) << 32))
    return F.explode(F.array(*keys))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _pairs(keys: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows with equal keys; ``keys`` are sorted."""
    left, right = [], []
    for step in range(1, len(keys)):
        at = np.flatnonzero(keys[:-step] == keys[step:])
        if not len(at):
            break
        at = at[_distance(prints[at], prints[at + step]) <= radius]
        left.append(at)
        right.append(at + step)
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _walked(prints: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among ``prints``: found members leave the rest at once."""
    left, right = [], []
    rest = np.arange(len(prints))
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = _distance(prints[rest], prints[at]) <= radius
            new, rest = rest[near].tolist(), rest[~near]
            left += [at] * len(new)
            right += new
            front += new
    return left, right


def _linked(prints: np.ndarray, radius: int, block: int = 512) -> np.ndarray:
    """Places of the fingerprints that have any link."""
    found = [np.empty(0, dtype=np.int64)]
    for start in range(0, len(prints), block):
        near = _distance(prints[start:start + block, None], prints[None]) <= radius
        found.append(np.flatnonzero(near.sum(axis=1) > 1) + start)  # each is near itself
    return np.concatenate(found)


def _forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    at = _linked(prints, radius)
    left, right = _walked(prints[at], radius)
    return at[left], at[right]


def _large(prints: np.ndarray, bit: int, segments: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in a large bucket, the one of variant ``bit``. Very large ones are cut once more by variants of the lane's
    bits outside the bucket's segment."""
    if len(prints) <= MEDIUM or radius > 5:
        return _forest(prints, radius) if len(prints) <= MEDIUM else tuple(
            np.array(x, dtype=np.int64) for x in _walked(prints, radius))
    lane, bit = divmod(bit, 64)
    low, high = next(s for s in bounds(segments) if s[0] <= bit < s[1])
    others = [b for b in range(64) if not low <= b < high]
    left, right = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for part in np.array_split(others, 3):
        whole = sum(1 << int(b) for b in part)
        for b in part:
            keys = prints[:, lane] & np.uint64(whole & ~(1 << int(b)))
            order = np.argsort(keys, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
                if len(group) > 1:
                    a, c = _forest(prints[group], radius) if len(group) <= MEDIUM else _walked(prints[group], radius)
                    left.append(group[a])
                    right.append(group[c])
    return np.concatenate(left), np.concatenate(right)


def stars(size: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows 0 to size - 1 and the links between them: (first row of its component, row) for every other row."""
    name = np.arange(size)
    while True:
        least = np.minimum(name[left], name[right])
        new = name.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == name).all():
            break
        name = new
    others = np.flatnonzero(name != np.arange(size))
    return name[others], others


def links(distinct: DataFrame, lanes: int, segments: int, radius: int) -> DataFrame:
    """Pairs (a, b) of ids of distinct fingerprints that verified links connect, enough to connect every component."""
    names = [f"_f{i}" for i in range(lanes)]

    def bucket_links(keys: np.ndarray, ids: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Stars of what is linked within whole buckets; rows are sorted by key and id."""
        starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
        sizes = np.diff(np.append(starts, len(keys)))
        small = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
        a, b = _pairs(keys[small], prints[small], radius)
        left, right = [small[a]], [small[b]]
        for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
            a, b = _large(prints[start:start + size], int(keys[start]) >> 32, segments, radius)
            left.append(a + start)
            right.append(b + start)
        centre, row = stars(len(keys), np.concatenate(left), np.concatenate(right))
        return np.unique(np.stack([ids[centre], ids[row]], axis=1), axis=0)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        for frame in frames:
            keys = frame["key"].to_numpy(dtype=np.int64)
            if not len(keys):
                continue
            rows = keys, frame["_least"].to_numpy(dtype=np.int64), frame[names].to_numpy(dtype=np.int64).view(np.uint64)
            if held and held[0][0][0] == keys[-1]:  # still inside one bucket
                held.append(rows)
                continue
            whole = tuple(np.concatenate(x) for x in zip(*held, rows, strict=True))
            cut = int(np.searchsorted(whole[0], whole[0][-1]))
            if cut:
                found = bucket_links(*(x[:cut] for x in whole))
                yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})
            held = [tuple(x[cut:] for x in whole)]
        if held:
            found = bucket_links(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    tasks = 2 * int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = distinct.where("_least is not null").select("_least", *names, _variants(lanes, segments).alias("key"))
    return listed.repartition(tasks, "key").sortWithinPartitions("key", "_least").mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, lanes: int = 2, segments: int = 4, radius: int | None = None,
                    similarity: float = 0.8, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """One row per document: ``identifier``, ``component_id`` (smallest id reachable over links) and the fingerprint
    columns ``_f0``, ... Fingerprints are linked at ``radius`` or fewer differing bits; without a radius it
    follows from ``similarity``."""
    radius = radius_for(similarity, lanes) if radius is None else radius
    names = [f"_f{i}" for i in range(lanes)]
    prints = written(fingerprints(docs, words, lanes, text, identifier), "fingerprints")
    distinct = written(prints.groupBy(*names).agg(F.min("_id").alias("_id")).withColumn(
        "_least", F.monotonically_increasing_id()), "distinct-fingerprints")  # numbered, as some have no id
    reached = components(links(distinct, lanes, segments, radius))
    members = reached.union(reached.select("component", F.col("component").alias("_same")).distinct())
    ids = distinct.select(F.col("_least").alias("node"), "_id")
    least = members.join(ids, "node").groupBy("component").agg(F.min("_id").alias("component_id"))
    classes = distinct.join(members.join(least, "component").select("node", "component_id"), F.col("_least") == F.col("node"), "left").select(
        *names, F.coalesce("component_id", "_id").alias("component_id"))
    return prints.join(classes, names).select(F.col("_id").alias(identifier), "component_id", *names)


def without_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """Of each group of linked rows of ``docs`` the one with the smallest id, null ids last."""
    text, identifier = settings.pop("text", "text"), settings.pop("identifier", "doc_id")
    keyed = numbered_rows(docs)
    found = near_duplicates(keyed.select("_node", F.col(f"_doc.{text}").alias("_text")), text="_text", identifier="_node", **settings)
    reached = found.select(F.col("_node").alias("node"), F.col("component_id").alias("component")).where("node <> component")
    return smallest_stay(keyed, reached, identifier)
