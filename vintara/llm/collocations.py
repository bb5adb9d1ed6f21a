"""Collocations: frequent phrases of two or more words, scored by how much they hold together, per language.

A word is a run of characters other than space and tab in a piece; pieces end at ``[.,;:!?\\x0A-\\x0D]``; A-Z count as a-z. A phrase is a
run of words in one piece, and all its occurrences count, overlaps included.

1. Summaries. Each task counts the phrases of a block of words exactly and sends, for every hash partition, their hashes with the
   counts. Each partition is one Misra-Gries summary that these counts are merged into. There are as many partitions as it takes for ``capacity``
   counters to exceed a partition's mass divided by the threshold. When a summary overflows, the first count beyond its capacity is
   taken off all counters; as long as less than the threshold is taken off in all, every frequent phrase survives, and should a
   partition be heavier than foreseen, its summary grows instead of taking off more. A count that reaches the threshold is proven and
   leaves the summary, so a phrase that makes up a third of the corpus costs one counter.
2. Second pass. The survivors are marked in a bit map of at most ``filter_bits`` bits, a slice for each partition. The texts are read
   again, and the phrases that meet a mark are counted exactly, by their words. A fuller map lets more phrases through to that count and changes
   no result. Every part of a frequent phrase is frequent itself, so its count is there, too.
3. Scores, containment and ranks are Spark aggregates and joins on exact counts; ratios are taken of decimals with 38 digits.

Defined cases: a null text counts as empty; a null language is ``und``; empty texts and texts without words have no phrase; repeated rows
count each time, whatever their ids; equal scores are ordered by count, then by the phrase's bytes; very long texts are read in blocks that
overlap by a phrase less one word; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from vintara.llm.common import written

END = b"\xff"  # no byte of UTF-8 text: stands between pieces
_FROM = bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(_FROM, bytes(range(97, 123)) + END * (len(_FROM) - 26))
BLOCK = 1 << 19  # words of a block
LONG = 2 << 20  # bytes of a text that is read in several blocks
ID_BITS = 21  # of a word's number within its block
EMIT = 100_000  # phrases of a frame handed on
PARTS = 64  # of a language whose best phrases are found apart
WORD_BYTES = 6  # of a word and its space, for the number of partitions
PARTITIONS = 64  # hash partitions at least, so that small inputs have as many tasks
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Block:
    """Some words of one language, and the phrases that end after the first ``skip`` of them."""

    def __init__(self, found: list[bytes], longest: int, skip: int = 0):
        numbers: dict[bytes, int] = {END: 0}
        number = numbers.setdefault
        self.ids = np.fromiter((number(w, len(numbers)) for w in found), dtype=np.int64, count=len(found))
        self.words = list(numbers)
        self.longest, self.skip = longest, skip

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, parts, counts) for phrases of 1 to ``longest`` words: the word numbers of each, a row a phrase."""
        ids = self.ids
        inside = ids > 0
        # a phrase's code is that of all but its last word, with the last word's number below it
        codes, known, fits = ids, np.arange(len(self.words), dtype=np.int64)[:, None], 1
        for n in range(1, self.longest + 1):
            if n > 1:
                if (fits + 1) * ID_BITS > 63:  # shorter codes: the rank among those met
                    met, codes = np.unique(codes, return_inverse=True)
                    known, fits = self._parts(met, known, n - 1), 1
                inside = inside[:-1] & (ids[n - 1:] > 0)
                codes = codes[:-1] << ID_BITS | ids[n - 1:]
                fits += 1
            first = max(0, self.skip - n + 1)  # those that end before ``skip`` were counted in the block before
            met, counts = np.unique(codes[first:][inside[first:]], return_counts=True)
            yield n, self._parts(met, known, n), counts

    @staticmethod
    def _parts(codes: np.ndarray, known: np.ndarray, n: int) -> np.ndarray:
        """Word numbers behind the codes; ``known`` has those of their first part, as its rows."""
        mask, tail = (1 << ID_BITS) - 1, n - known.shape[1]
        last = [codes >> (ID_BITS * i) & mask for i in reversed(range(tail))]
        return np.column_stack([known[codes >> (ID_BITS * tail)], *last])

    def hashes(self, language: str, parts: np.ndarray) -> np.ndarray:
        """64 bits of each phrase; its language and length take part."""
        if not hasattr(self, "_of_word"):
            seed = xxhash.xxh64_intdigest(language.encode())
            self._of_word = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.words), dtype=np.uint64, count=len(self.words))
        total = np.full(len(parts), parts.shape[1], dtype=np.uint64)
        for i in range(parts.shape[1]):
            total = _mixed(total * _ODD + self._of_word[parts[:, i]])
        return total


def words_of(data: bytes) -> list[bytes]:
    """Words of an encoded text, with ``END`` between its pieces."""
    return data.translate(TABLE).replace(END, b" \xff ").split()


def _blocks(rows: Iterable[tuple[str, str]], longest: int) -> Iterator[tuple[str, Block, int]]:
    """(language, block, words in it that were in no block before) for rows (language, text)."""
    held: dict[str, list[bytes]] = {}
    waiting = 0
    for language, text in rows:
        data = text.encode()
        if len(data) > LONG:
            tail: list[bytes] = []
            at = 0
            while at < len(data):
                to = min(at + LONG, len(data))
                while to < len(data) and data[to:to + 1] not in b" \t\n\x0b\x0c\r":
                    to += 1
                found = words_of(data[at:to])
                yield language, Block(tail + found, longest, len(tail)), len(found) - found.count(END)
                tail = (tail + found)[-(longest - 1):] if longest > 1 else []
                at = to
            continue
        found = words_of(data)
        if found:
            words = held.setdefault(language, [])
            words += found
            words.append(END)
            waiting += len(found)
        if waiting >= BLOCK:
            yield from ((x, Block(w, longest), len(w) - w.count(END)) for x, w in held.items())
            held, waiting = {}, 0
    yield from ((x, Block(w, longest), len(w) - w.count(END)) for x, w in held.items())


def _rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, str]]:
    for frame in frames:
        yield from zip(frame["lang"], frame["_text"], strict=True)


def _counted(read: DataFrame, longest: int, threshold: int, partitions: int) -> DataFrame:
    """(part, keys, counts): hashes of phrases with their counts in one block, up to the threshold, for each partition."""
    small = np.min_scalar_type(threshold).newbyteorder("<")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for language, block, _ in _blocks(_rows(frames), longest):
            found = [(block.hashes(language, parts), counts) for _, parts, counts in block.phrases()]
            hashes = np.concatenate([h for h, _ in found])
            counts = np.minimum(np.concatenate([c for _, c in found]), threshold).astype(small)
            order = np.argsort(hashes)
            hashes, counts = hashes[order], counts[order]
            # the upper half of a hash names its partition, the lower half its counter there
            part = ((hashes >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.int64)
            keys = (hashes & np.uint64(0xFFFFFFFF)).astype("<u4")
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)] if len(part) else []
            spans = list(zip(cuts, cuts[1:], strict=False))
            yield pd.DataFrame({"part": [int(part[a]) for a, _ in spans], "keys": [keys[a:b].tobytes() for a, b in spans],
                                "counts": [counts[a:b].tobytes() for a, b in spans]})

    return read.mapInPandas(run, "part int, keys binary, counts binary")


class Summary:
    """A Misra-Gries summary of keys that loses none whose counts reach ``threshold``."""

    def __init__(self, capacity: int, threshold: int):
        self.capacity, self.threshold = capacity, threshold
        self.keys, self.counts = np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        self.taken_off = 0
        self._proven: list[np.ndarray] = []
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._size += len(keys)
        if self._size >= self.capacity:
            self._merge()

    def _merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self._waiting)])
        counts = np.concatenate([self.counts, *(c.astype(np.int64) for _, c in self._waiting)])
        self._waiting, self._size = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
        keys, counts = keys[first], np.add.reduceat(counts, first)
        sure = counts >= self.threshold
        self._proven.append(keys[sure])
        keys, counts = keys[~sure], counts[~sure]
        while len(keys) > self.capacity:
            off = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            if self.taken_off + off >= self.threshold:
                self.capacity *= 2
                continue
            self.taken_off += off
            keys, counts = keys[counts > off], counts[counts > off] - off
        self.keys, self.counts = keys, counts

    def survivors(self) -> np.ndarray:
        """Every key whose counts reach the threshold, and some others."""
        self._merge()
        return np.concatenate([*self._proven, self.keys[self.counts + self.taken_off >= self.threshold]])


def _marks(counted: DataFrame, threshold: int, capacity: int, slice_bits: int) -> DataFrame:
    """(part, marks): the slice of the bit map that holds the survivors of each partition."""
    small = np.min_scalar_type(threshold).newbyteorder("<")

    def marked(part: int, summary: Summary) -> pd.DataFrame:
        bits = np.zeros(slice_bits, dtype=np.uint8)
        bits[summary.survivors() % slice_bits] = 1
        return pd.DataFrame({"part": [part], "marks": [np.packbits(bits, bitorder="little").tobytes()]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, summary = None, None
        for frame in frames:
            for part, keys, counts in zip(frame["part"], frame["keys"], frame["counts"], strict=True):
                if part != at:
                    if summary is not None:
                        yield marked(at, summary)
                    at, summary = part, Summary(capacity, threshold)
                summary.add(np.frombuffer(keys, dtype="<u4"), np.frombuffer(counts, dtype=small))
        if summary is not None:
            yield marked(at, summary)

    dealt = counted.repartition("part").sortWithinPartitions("part")
    return dealt.mapInPandas(run, "part int, marks binary")


def _exactly(read: DataFrame, longest: int, partitions: int, slice_bits: int, marks) -> DataFrame:
    """(lang, size, phrase, n): counts of the phrases that meet a mark, block by block; size 0 has the number of words."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(marks.value, dtype=np.uint8)

        def met(hashes: np.ndarray) -> np.ndarray:
            part = (hashes >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)
            at = part * np.uint64(slice_bits) + (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(slice_bits)
            return bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1

        for language, block, total in _blocks(_rows(frames), longest):
            yield pd.DataFrame({"lang": [language], "size": [0], "phrase": [""], "n": [total]})
            words = [w.decode() for w in block.words[1:]]
            words.insert(0, "")
            for size, parts, counts in block.phrases():
                fit = met(block.hashes(language, parts))
                parts, counts = parts[fit], counts[fit]
                for low in range(0, len(parts), EMIT):
                    part = parts[low:low + EMIT].tolist()
                    yield pd.DataFrame({"lang": language, "size": size, "phrase": [" ".join([words[i] for i in p]) for p in part],
                                        "n": counts[low:low + EMIT]})

    return read.mapInPandas(run, "lang string, size int, phrase string, n long")


def phrase_counts(docs: DataFrame, longest: int = 3, threshold: int = 10, capacity: int = 1 << 20, filter_bits: int = 1 << 28,
                  text: str = "text", language: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of 1 to ``longest`` words with f >= ``threshold``, and (lang, n) with all words."""
    spark = docs.sparkSession
    read = docs.select(F.coalesce(language, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("_text"))
    size = read.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    # a word with its space takes some six bytes; where words are shorter, the summaries grow by themselves
    partitions = max(PARTITIONS, -(-longest * size // (WORD_BYTES * threshold * capacity)))
    while partitions > max(PARTITIONS, filter_bits // 64):  # a slice of 64 bits at least
        capacity, partitions = 2 * capacity, -(-partitions // 2)
    # a bit for every fourth counter that the mass allows; far fewer phrases are frequent
    slice_bits = 1 << (min(max(64, longest * size // (4 * threshold * partitions)), filter_bits // partitions).bit_length() - 1)
    counted = _counted(read, longest, threshold, partitions)
    marks = bytearray(partitions * slice_bits // 8)
    for row in _marks(counted, threshold, capacity, slice_bits).collect():  # ``filter_bits`` in all
        at = row["part"] * slice_bits // 8
        marks[at:at + slice_bits // 8] = row["marks"]
    shared = spark.sparkContext.broadcast(bytes(marks))
    found = _exactly(read, longest, partitions, slice_bits, shared)
    exact = written(found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f")).where(
        (F.col("f") >= threshold) | (F.col("size") == 0)), "phrase-counts")
    return exact.where("size > 0"), exact.where("size = 0").select("lang", F.col("f").alias("n"))


def _joined(words: Column, start: int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, longest: int = 3, threshold: int = 10, contained: int = 50, top: int = 2000, **settings) -> DataFrame:
    """The first ``top`` phrases of each language by score: lang, rank (from 1), phrase, a, l, r, n, score.

    a counts the phrase, l and r its two parts where cutting it scores lowest (ties: the shortest first part); the score is
    floor(10**6 * a * a / (l * r)). A phrase is left out if a longer one around it has at least ``contained`` % of its count."""
    counts, totals = phrase_counts(docs, longest, threshold, **settings)
    words = F.split("phrase", " ")
    candidates = counts.where("size > 1").select("lang", "size", "phrase", words.alias("words"), F.col("f").alias("a"))
    known = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f"))

    def with_count(frame: DataFrame, column: str, into: str) -> DataFrame:
        return frame.join(known, (F.col("lang") == F.col("_lang")) & (F.col(column) == F.col("_part"))).drop(
            "_lang", "_part").withColumnRenamed("f", into)

    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumns({"_left": _joined(F.col("words"), 1, F.col("k")),
                           "_right": F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " ")})
    cut = with_count(with_count(cut, "_left", "l"), "_right", "r")
    whole = lambda c: F.col(c).cast("decimal(15,0)")
    cut = cut.withColumns({"_above": (F.lit(1_000_000).cast("decimal(7,0)") * (whole("a") * whole("a"))).cast("decimal(38,0)"),
                           "_below": (whole("l") * whole("r")).cast("decimal(31,0)")})
    cut = cut.withColumn("score", F.expr("_above div _below"))
    lowest = cut.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    def inside(n: int) -> DataFrame:
        """The phrases of ``n`` words inside longer candidates, with the count of the longer one."""
        within = F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " "))
        return candidates.where(F.col("size") > n).select("lang", "a", F.explode(within).alias("phrase"))

    inner = [inside(n) for n in range(2, longest)]
    kept = lowest.select("lang", "phrase", "a", "best.*")
    if inner:
        around = reduce(DataFrame.unionAll, inner).groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
        around = around.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), "_longer")
        kept = kept.join(around, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left").where(
            F.col("_longer").isNull() | (100 * F.col("_longer") < contained * F.col("a")))
    # a language may hold most phrases, so the best of each part of it are found first, and at most PARTS * top rows are ranked together
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    best = kept.withColumn("_at", F.row_number().over(part)).where(F.col("_at") <= top).drop("_at")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = totals.select(F.col("lang").alias("_of"), "n")  # one row per language
    return ranked.join(totals, F.col("lang") == F.col("_of")).select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
