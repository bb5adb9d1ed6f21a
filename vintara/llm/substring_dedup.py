"""Repeated byte strings: a distributed suffix sort of the strings that can repeat.

Every byte that is covered by an ``n``-byte string which also starts in a document with a smaller id is removed; strings are
judged on the input and never cross documents.

Suffixes are too many to send around, so two steps come before the sort. The smallest hash among the ``GRAM``-byte strings
inside an n-byte string depends on the string alone, so equal strings have equal smallest hashes and meet by them; a run
is a stretch of text whose n-byte strings share theirs.

1. Documents are dealt into groups by a hash of their id. Each group sends the distinct hashes of its runs, 48 bits each, and
   learns which ones occur in another document. Most runs end here.
2. The remaining runs are sent with their bytes, equal ones of a group once (those of larger ids are covered already).
3. Where they meet, equal runs are merged, and the suffixes at all string starts of runs with one hash are sorted by their bytes, eight
   at a time: suffixes told apart by the first eight are done, groups alike in them need no sort. Neighbours that nothing tells apart are
   equal.
4. Covered stretches go back to their groups, which cut the texts.

A very common line is one run per group and one smallest hash, so its copies are merged before they meet. The texts are shuffled once
and read from that shuffle three times.

Defined cases: a null text is empty; texts shorter than n lose nothing; a null id is larger than any other; rows that repeat an
id do not cover each other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

GRAM = 18
GROUP_BYTES = 4 << 20
PACK_BYTES = 1 << 19  # bytes hashed at once
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
NO_ID = 2**63 - 1
SHIFT = np.uint64(16)  # hashes are told by their upper 48 bits in step 1


def _symbols() -> np.ndarray:
    """A fixed 64-bit value for every byte."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) ^ np.uint64(0x2545F4914F6CDD1D)
    return _mixed(x)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PrefixHashes:
    """Polynomial hashes of all prefixes; the hash of any substring follows from two of them."""

    def __init__(self, data: np.ndarray):
        size = len(data) + 1
        powers = np.full(size, BASE, dtype=np.uint64)
        powers[0] = 1
        self.inverse = np.full(size, pow(BASE, -1, 2**64), dtype=np.uint64)
        self.inverse[0] = 1
        np.cumprod(self.inverse, out=self.inverse)
        np.cumprod(powers, out=powers)
        self.sums = np.zeros(size, dtype=np.uint64)
        np.cumsum(_symbols()[data] * powers[:-1], out=self.sums[1:])

    def everywhere(self, length: int) -> np.ndarray:
        return (self.sums[length:] - self.sums[:-length]) * self.inverse[:len(self.sums) - length]


def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs(texts: list[bytes], n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs as arrays (text, first start, number of starts, hash): stretches of n-byte strings with one smallest hash."""
    parts, size = [], 0  # (text, first start, starts)

    def flush() -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join([texts[t][a:a + c + n - 1] for t, a, c in parts]), dtype=np.uint8)
        least = _least_in(_mixed(PrefixHashes(data).everywhere(GRAM)), n - GRAM + 1)
        text, first, counts = (np.array(x, dtype=np.int64) for x in zip(*parts, strict=True))
        offsets = np.concatenate([[0], np.cumsum(counts + n - 1)[:-1]])
        part = np.repeat(np.arange(len(parts)), counts)
        within = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts)
        hashes = _mixed(least)[offsets[part] + within]  # smallest hashes are small: mixed again they fill all buckets alike
        new = np.ones(len(part), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(new)
        return text[part[at]], first[part[at]] + within[at], np.diff(np.append(at, len(part))), hashes[at]

    for t, text in enumerate(texts):
        for a in range(0, len(text) - n + 1, PACK_BYTES):
            count = min(PACK_BYTES, len(text) - n + 1 - a)
            if parts and size + count > PACK_BYTES:
                yield flush()
                parts, size = [], 0
            parts.append((t, a, count))
            size += count + n
    if parts:
        yield flush()


def _all_runs(texts: list[bytes], n: int) -> tuple[np.ndarray, ...]:
    found = list(runs(texts, n))
    if not found:
        return tuple(np.empty(0, dtype=d) for d in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _rows(frame: pd.DataFrame) -> tuple[np.ndarray, list[bytes]]:
    """Ids (null: ``NO_ID``) and texts of a group in an order that depends on its content only."""
    pairs = sorted(zip(frame["_id"].tolist(), frame["_text"].tolist(), strict=True))
    return np.array([i for i, _ in pairs], dtype=np.int64), [t.encode() for _, t in pairs]


def _edges(buckets: int) -> np.ndarray:
    """First 48-bit hash of each bucket but the first."""
    return np.array([(b << 48) // buckets for b in range(1, buckets)], dtype=np.uint64)


def _distinct(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit hashes in order, and whether each occurs in several rows."""
    short = hashes >> SHIFT
    order = np.lexsort((rows, short))
    short, rows = short[order], rows[order]
    at = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]])) if len(short) else np.empty(0, dtype=np.int64)
    last = np.append(at[1:], len(short)) - 1 if len(short) else at
    return short[at], rows[at] != rows[last]


def _packed(short: np.ndarray, several: np.ndarray) -> bytes:
    six = np.ascontiguousarray(short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
    return struct.pack("<I", len(short)) + six.tobytes() + np.packbits(several).tobytes()


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = struct.unpack_from("<I", blob)[0]
    eight = np.zeros((n, 8), dtype=np.uint8)
    eight[:, :6] = np.frombuffer(blob, dtype=np.uint8, count=6 * n, offset=4).reshape(n, 6)
    return eight.view("<u8").ravel(), np.unpackbits(np.frombuffer(blob, dtype=np.uint8, offset=4 + 6 * n), count=n).astype(bool)


# ---- the suffix sort -------------------------------------------------------------------------------------------------


def suffix_sorted(data: np.ndarray, starts: np.ndarray, bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` with every bucket's suffixes in order of their first n bytes, and whether each differs from the one before it or opens a
    bucket. ``bucket`` ascends. The bytes are compared eight at a time; only suffixes that are still alike go on to the next eight, and
    only groups whose members differ there are sorted."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray(len(data) + 1, dtype=">u8", buffer=padded, strides=(1,))  # the eight bytes from every place on, as one number
    starts = starts.copy()
    new = np.ones(len(starts), dtype=bool)
    new[1:] = bucket[1:] != bucket[:-1]
    at = np.arange(len(starts))
    for offset in range(0, n, 8):
        alone = new[at] & np.append(new[at[1:]], True)  # of groups kept whole: the one behind opens another
        at = at[~alone]
        if not len(at):
            break
        opens = new[at]
        group = np.cumsum(opens) - 1
        here = eights[starts[at] + offset].astype(np.uint64) >> np.uint64(8 * max(0, 8 - (n - offset)))
        differ = np.zeros(len(at), dtype=bool)
        differ[1:] = (here[1:] != here[:-1]) & ~opens[1:]
        unlike = np.zeros(group[-1] + 1, dtype=bool)
        unlike[group[differ]] = True
        moved = np.flatnonzero(unlike[group])
        by_eight = moved[np.lexsort((here[moved], group[moved]))]
        starts[at[moved]] = starts[at[by_eight]]
        here[moved] = here[by_eight]
        differ[1:] = (here[1:] != here[:-1]) & ~opens[1:]
        new[at[differ]] = True
    return starts, new


def equal_strings(data: np.ndarray, starts: np.ndarray, bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts in suffix order and a class number per start: one class per distinct n-byte string of a bucket."""
    ordered, new = suffix_sorted(data, starts, bucket, n)
    return ordered, np.cumsum(new)


# ---- the four steps --------------------------------------------------------------------------------------------------


def _offered(n: int, buckets: int):
    """Step 1, a group's distinct hashes by bucket."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        _, texts = _rows(frame)
        text, _, _, hashes = _all_runs(texts, n)
        short, several = _distinct(hashes, text)
        cuts = np.concatenate([[0], np.searchsorted(short, _edges(buckets)), [len(short)]])
        full = np.flatnonzero(np.diff(cuts))
        return pd.DataFrame({"bucket": full, "_group": int(frame["_group"].iloc[0]), "blob": [
            _packed(short[cuts[b]:cuts[b + 1]], several[cuts[b]:cuts[b + 1]]) for b in full]})
    return run


def _answered(frame: pd.DataFrame) -> pd.DataFrame:
    """Step 1, which of the offered hashes occur in several documents: a bitmap per offer."""
    offers = [_unpacked(b) for b in frame["blob"]]
    sizes = np.array([len(h) for h, _ in offers])
    hashes, several = (np.concatenate(x) for x in zip(*offers, strict=True))
    order = np.argsort(hashes, kind="stable")
    found = several.copy()
    same = np.flatnonzero(hashes[order][1:] == hashes[order][:-1])
    found[order[same]] = found[order[same + 1]] = True
    first = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    anywhere = np.logical_or.reduceat(found[order], first)
    found[order] = np.repeat(anywhere, np.diff(np.append(first, len(order))))
    ends = np.cumsum(sizes)
    return pd.DataFrame({"_group": frame["_group"], "bucket": frame["bucket"], "blob": [
        np.packbits(found[e - s:e]).tobytes() for s, e in zip(sizes, ends, strict=True)]})


def _stretches(rows: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> bytes:
    return np.stack([rows, starts, counts]).astype("<i8").tobytes()


def _sent(n: int, buckets: int):
    """Step 2, a group's repeated runs by bucket; kind 1 rows are stretches that are covered already."""
    def run(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "_group", "kind", "blob"]
        if not len(frame) or not len(answers):
            return pd.DataFrame([], columns=columns)
        group = int(frame["_group"].iloc[0])
        ids, texts = _rows(frame)
        text, first, count, hashes = _all_runs(texts, n)
        short, _ = _distinct(hashes, text)
        edges = _edges(buckets)
        cuts = np.concatenate([[0], np.searchsorted(short, edges), [len(short)]])
        repeated = np.zeros(len(short), dtype=bool)
        for bucket, blob in zip(answers["bucket"], answers["blob"], strict=True):
            a, b = cuts[bucket], cuts[bucket + 1]
            repeated[a:b] = np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=b - a).astype(bool)
        own = hashes >> SHIFT
        keep = repeated[np.searchsorted(short, own)] if len(short) else np.zeros(0, dtype=bool)
        text, first, count, hashes, own = text[keep], first[keep], count[keep], hashes[keep], own[keep]
        order = np.argsort(ids[text], kind="stable")  # the smallest id of equal runs comes first
        text, first, count, hashes, own = text[order], first[order], count[order], hashes[order], own[order]
        strings: dict[bytes, int] = {}
        which = np.array([strings.setdefault(texts[t][a:b], len(strings)) for t, a, b in zip(
            text.tolist(), first.tolist(), (first + count + n - 1).tolist(), strict=True)], dtype=np.int64)
        heads = np.unique(which, return_index=True)[1]  # the first run of each string
        covered = ids[text[heads]][which] < ids[text]
        out = []
        if covered.any():
            out.append((int(own[covered][0] % np.uint64(buckets)), group, 1, _stretches(text[covered], first[covered], count[covered])))
        by_hash = np.argsort(hashes[heads], kind="stable")
        rank = np.empty(len(heads), dtype=np.int64)
        rank[by_hash] = np.arange(len(heads))
        heads, contents = heads[by_hash], list(strings)
        places = np.flatnonzero(~covered)
        places = places[np.argsort(rank[which[places]], kind="stable")]
        sizes = np.bincount(rank[which[places]], minlength=len(heads))
        upto = np.concatenate([[0], np.cumsum(sizes)])
        at = np.searchsorted(edges, own[heads], side="right")
        cut = np.concatenate([np.flatnonzero(np.diff(at, prepend=-1)), [len(heads)]])
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            h, p = heads[a:b], places[upto[a]:upto[b]]
            blob = struct.pack("<II", len(h), len(p)) + b"".join(x.astype("<i8").tobytes() for x in (
                count[h], hashes[h].view(np.int64), ids[text[h]], sizes[a:b], text[p], first[p])) + b"".join([contents[c] for c in by_hash[a:b].tolist()])
            out.append((int(at[a]), group, 0, zstandard.compress(blob, 1)))
        return pd.DataFrame(out, columns=columns)
    return run


def _received(blob: bytes, n: int):
    blob = zstandard.decompress(blob)
    strings, places = struct.unpack_from("<II", blob)
    at, out = 8, []
    for size in (strings, strings, strings, strings, places, places):
        out.append(np.frombuffer(blob, dtype="<i8", count=size, offset=at))
        at += 8 * size
    return [*out, blob[at:]]


def _compared(n: int):
    """Step 3, the covered stretches of a bucket's runs."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        passed = frame[frame["kind"] == 1]
        out = list(zip(passed["_group"], passed["blob"], strict=True))
        sent = frame[frame["kind"] == 0]
        contents: dict[bytes, int] = {}
        which, received, places = [], [], []  # per received run: its content; its number of starts, hash, id, rows and group; rows and starts
        for group, blob in zip(sent["_group"], sent["blob"], strict=True):
            count, hash_, id_, size, row, start, data = _received(blob, n)
            ends = np.cumsum(count + n - 1)
            which += [contents.setdefault(data[a:b], len(contents)) for a, b in zip((ends - count - n + 1).tolist(), ends.tolist(), strict=True)]
            received.append(np.stack([count, hash_, id_, size, np.full(len(count), group)]))
            places.append(np.stack([row, start]))
        if not which:
            return pd.DataFrame(out, columns=["_group", "blob"])
        which = np.array(which)
        count, hash_, ids, sizes, origin = np.concatenate(received, axis=1)
        rows, starts = np.concatenate(places, axis=1)
        begin = np.cumsum(sizes) - sizes
        heads = np.unique(which, return_index=True)[1]
        counts, best = count[heads], ids[heads].copy()
        np.minimum.at(best, which, ids)
        inner, firsts, lengths = _covered_inside(list(contents), counts, hash_[heads], best, n)
        # a run with a larger id than its content's is covered whole, others where another content covers theirs
        whole = np.flatnonzero(ids > best[which])
        cuts = np.searchsorted(inner, np.arange(len(counts) + 1))
        rest = np.flatnonzero(ids <= best[which])
        rest = rest[(cuts[which + 1] > cuts[which])[rest]]
        stretch, run_ = _spelled(cuts[which[rest]], cuts[which[rest] + 1] - cuts[which[rest]])
        of_run = np.concatenate([whole, rest[run_]])
        shift = np.concatenate([np.zeros(len(whole), dtype=np.int64), firsts[stretch]])
        length = np.concatenate([counts[which[whole]], lengths[stretch]])
        place, of = _spelled(begin[of_run], sizes[of_run])
        groups = origin[of_run][of]
        order = np.argsort(groups, kind="stable")
        place, of, groups = place[order], of[order], groups[order]
        cut = np.flatnonzero(np.diff(groups, prepend=-1, append=-1))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            out.append((int(groups[a]), _stretches(rows[place[a:b]], starts[place[a:b]] + shift[of[a:b]], length[of[a:b]])))
        return pd.DataFrame(out, columns=["_group", "blob"])
    return run


def _spelled(begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of ranges (begin, size) one after the other, and the number of the range that each is of."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes), of


def _covered_inside(contents: list[bytes], counts: np.ndarray, hashes: np.ndarray, best: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Stretches (content, first start, number of starts), by content, of strings that another content with a smaller id has too."""
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    sizes = np.diff(np.append(first, len(order)))
    members = order[np.repeat(sizes > 1, sizes)]
    out = [np.empty((3, 0), dtype=np.int64)]
    heavy = np.cumsum(counts[members] + n) // PACK_BYTES if len(members) else members
    cut, groups = 0, hashes[members]
    while cut < len(members):
        # whole hashes at a time, as many suffixes as bytes are hashed at once
        end = int(np.searchsorted(heavy, heavy[cut], side="right"))
        while end < len(members) and groups[end] == groups[end - 1]:
            end += 1
        part, cut = members[cut:end], end
        data = np.frombuffer(b"".join([contents[m] for m in part.tolist()]), dtype=np.uint8)
        lengths = counts[part] + n - 1
        offset = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(part)), counts[part])
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts[part]) - counts[part], counts[part])
        starts = offset[owner] + within
        # equal strings have their smallest hash at the same place: the next one at or after the start
        grams = _mixed(_mixed(PrefixHashes(data).everywhere(GRAM))).view(np.int64)
        holder = np.repeat(np.arange(len(part)), lengths)[:len(grams)]
        place = np.where(grams == hashes[part][holder], np.arange(len(grams)), len(data))
        after = np.minimum.accumulate(place[::-1])[::-1]
        key = np.unique(hashes[part], return_inverse=True)[1][owner] * (n + 1) + (after[starts] - starts)
        by_key = np.argsort(key, kind="stable")
        starts, owner, within, key = starts[by_key], owner[by_key], within[by_key], key[by_key]
        alone = np.ones(len(key), dtype=bool)
        alone[1:] &= key[1:] != key[:-1]
        alone[:-1] &= key[1:] != key[:-1]
        starts, owner, within, key = starts[~alone], owner[~alone], within[~alone], key[~alone]
        if not len(starts):
            continue
        back = np.empty(len(data), dtype=np.int64)
        back[starts] = np.arange(len(starts))
        ordered, classes = equal_strings(data, starts, key, n)
        at = back[ordered]
        id_ = best[part][owner[at]]
        least = np.minimum.reduceat(id_, np.flatnonzero(np.diff(classes, prepend=0)))
        hit = at[least[classes - 1] < id_]
        hit = hit[np.argsort(starts[hit], kind="stable")]
        own, pos = owner[hit], within[hit]
        new = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(pos, prepend=-1) != 1))
        out.append(np.stack([part[own[new]], pos[new], np.diff(np.append(new, len(hit)))]))
    found = np.concatenate(out, axis=1)
    return tuple(found[:, np.argsort(found[0], kind="stable")])


def _cut(n: int):
    """Step 4, spans and kept bytes of a group's documents."""
    def run(frame: pd.DataFrame, covered: pd.DataFrame) -> pd.DataFrame:
        columns = ["_id", "n_bytes", "starts", "ends", "kept"]
        if not len(frame):
            return pd.DataFrame([], columns=columns)
        ids, texts = _rows(frame)
        blobs = [np.frombuffer(b, dtype="<i8").reshape(3, -1) for b in covered["blob"]]
        rows, starts, counts = np.concatenate(blobs, axis=1) if blobs else np.empty((3, 0), dtype=np.int64)
        order = np.lexsort((starts, rows))
        rows, starts, ends = rows[order], starts[order], (starts + counts + n - 1)[order]
        cuts = np.searchsorted(rows, np.arange(len(texts) + 1))
        out = []
        for i, text in enumerate(texts):
            a, b = starts[cuts[i]:cuts[i + 1]], ends[cuts[i]:cuts[i + 1]]
            if len(a):
                reach = np.maximum.accumulate(b)
                new = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
                a, b = a[new], reach[np.append(new[1:], len(reach)) - 1]
                edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(text)]
                kept = b"".join([text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)])
            else:
                kept = text
            out.append((ids[i], len(text), a, b, kept))
        return pd.DataFrame(out, columns=columns)
    return run


def without_repeats(docs: DataFrame, n: int = 50, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """One row per document: ``identifier``, n_bytes, removed spans as ``starts`` and ``ends`` (byte positions, ends
    exclusive, maximal), and ``kept``, the remaining bytes."""
    if n <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(whole))).first()[0] or 0
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // GROUP_BYTES))
    dealt = docs.select(
        F.pmod(F.xxhash64(identifier), F.lit(groups)).cast("int").alias("_group"),
        F.coalesce(F.col(identifier).cast("long"), F.lit(NO_ID)).alias("_id"), whole.alias("_text"))
    offered = dealt.groupBy("_group").applyInPandas(_offered(n, groups), "bucket int, _group int, blob binary")
    answered = offered.groupBy("bucket").applyInPandas(_answered, "_group int, bucket int, blob binary")
    sent = dealt.groupBy("_group").cogroup(answered.groupBy("_group")).applyInPandas(
        _sent(n, groups), "bucket int, _group int, kind int, blob binary")
    compared = sent.groupBy("bucket").applyInPandas(_compared(n), "_group int, blob binary")
    cut = dealt.groupBy("_group").cogroup(compared.groupBy("_group")).applyInPandas(
        _cut(n), "_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")
    return cut.select(F.when(F.col("_id") != NO_ID, F.col("_id")).alias(identifier), "n_bytes", "starts", "ends", "kept")
