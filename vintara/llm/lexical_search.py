"""Ranked lexical search: short lists are summed term by term, the long ones are walked document by document.

Terms are runs of ASCII letters (lower-cased), digits and all non-ASCII characters. A document's score is the sum, over the distinct
terms of an item, of the term's weight times a saturated share of its occurrences (``impacts``), in 64-bit integers.

1. Index. Each task stores blocks of documents: for every term of the items a list of (document, occurrences), and each
   document's length. A document lies in one block whole, so no list is gathered over the corpus, however common its term.
2. Statistics. Documents, terms and each term's number of documents come from the blocks and give the weights.
3. First pass, term at a time. An item's lists that hold at most one document in ``short`` are short. Block by block they are added up
   into accumulators, and of all accumulators of an item the ``top``-th greatest is a floor: that many documents score as much at least.
4. Second pass, document at a time. In each block the accumulators are one list among the item's long lists, and each list is
   bounded by its greatest part. Lists whose bounds together stay under the floor name no candidates: documents come from the others only, and
   in the rest they are looked up, from the greatest bound down, while what they have and the bounds still to come reach the
   floor. The floor rises with the best that a task has found. A block whose bounds together miss the floor is skipped.

Only documents that reach the floor, at most ``top`` of an item and task, are ranked in the end. The items are the query set
and are taken in blocks of about ``block_terms`` terms, which the driver and the tasks hold at once.

Defined cases: null and empty texts have no terms; such documents are found by no item and such items find none; every row of the
items is an item of its own, also with a null or repeated id, and every row of the documents a document; equal scores are ordered by
ascending id, nulls last; very long texts are read in pieces; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from vintara.llm.common import written
from vintara.llm.decontamination import TABLE

BLOCK_DOCS = 8192
BLOCK_TERMS = 1 << 22  # occurrences of the items' terms that close a block
PIECE = 4 << 20  # bytes of a text split at once
SCALE = 1_000_000_000
INDEX = ("ids binary, nulls binary, lengths binary, filled long, total long, terms binary, starts binary, places binary, "
         "occurrences binary")


def pieces_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, some megabytes at a time."""
    data = text.encode().translate(TABLE)
    if len(data) <= PIECE:
        yield data.split()
        return
    at = 0
    while at < len(data):
        to = data.find(b" ", at + PIECE)
        to = len(data) if to < 0 else to
        yield data[at:to].split()
        at = to


def _queries(items: DataFrame, text: str, identifier: str) -> DataFrame:
    """(item, item_id, terms): distinct terms of every item that has any, written."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            terms = [sorted({w.decode() for part in pieces_of(t) for w in part}) for t in frame["_text"]]
            yield pd.DataFrame({"item": frame["item"], "terms": terms})

    read = written(items.select(F.monotonically_increasing_id().alias("item"), F.col(identifier).alias("item_id"),
                                F.coalesce(F.col(text), F.lit("")).alias("_text")), "items")
    terms = read.select("item", "_text").mapInPandas(run, "item long, terms array<string>").where("size(terms) > 0")
    return written(terms.join(read.select(F.col("item").alias("_item"), "item_id"), F.col("item") == F.col("_item")).drop("_item"), "queries")


def _index(docs: DataFrame, terms: dict[bytes, int], text: str, identifier: str) -> DataFrame:
    """One row a block of documents: their ids and lengths, and the lists of ``terms``, behind each other in ascending order."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = terms.get
        ids: list = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def block() -> pd.DataFrame:
            keys, occurrences = np.unique(np.concatenate(held) if held else np.empty(0, dtype=np.int64), return_counts=True)
            met, starts = np.unique(keys >> 32, return_index=True)
            none = np.array([i is None for i in ids], dtype=bool)
            return pd.DataFrame({
                "ids": [np.array([i or 0 for i in ids], dtype="<i8").tobytes()], "nulls": [np.packbits(none).tobytes()],
                "lengths": [np.array(lengths, dtype="<i8").tobytes()], "filled": [sum(n > 0 for n in lengths)],
                "total": [sum(lengths)], "terms": [met.astype("<i4").tobytes()],
                "starts": [np.append(starts, len(keys)).astype("<i8").tobytes()],
                "places": [(keys & 0xFFFFFFFF).astype("<i4").tobytes()], "occurrences": [occurrences.astype("<i4").tobytes()]})

        for frame in frames:
            for i, content in zip(frame["_id"], frame["_text"], strict=True):
                n, place = 0, len(ids)
                for found in pieces_of(content):
                    n += len(found)
                    own = np.array([get(w, -1) for w in found], dtype=np.int64)
                    own = own[own >= 0]
                    held.append(own << 32 | place)
                    size += len(own)
                ids.append(None if i is None else int(i))
                lengths.append(n)
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_TERMS:
                    yield block()
                    ids, lengths, held, size = [], [], [], 0
        if ids:
            yield block()

    # ids travel as text, which keeps a null a null
    read = docs.select(F.col(identifier).cast("long").cast("string").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return read.mapInPandas(run, INDEX)


def _list_sizes(index: DataFrame) -> DataFrame:
    """(term, df): in how many documents each term occurs."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for met, starts in zip(frame["terms"], frame["starts"], strict=True):
                yield pd.DataFrame({"term": np.frombuffer(met, dtype="<i4"), "df": np.diff(np.frombuffer(starts, dtype="<i8"))})

    return index.select("terms", "starts").mapInPandas(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


def weight(filled: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * filled + 2) / (2 * df + 1)))


def damping(n: int, filled: int, total: int) -> int:
    """What a document of ``n`` terms divides its occurrences by, in hundredths: 100 at the average length."""
    return 100 - 50 + 50 * n * filled // max(total, 1)


def impacts(occurrences: np.ndarray, damped: np.ndarray) -> np.ndarray:
    return SCALE * occurrences // (1000 * occurrences + 20 * damped)


class Block:
    """A block's lists with the parts that they add to scores, before the weights."""

    def __init__(self, row, filled: int, total: int):
        self.ids = np.frombuffer(row["ids"], dtype="<i8")
        self.nulls = np.unpackbits(np.frombuffer(row["nulls"], dtype=np.uint8), count=len(self.ids)).astype(bool)
        lengths = np.frombuffer(row["lengths"], dtype="<i8")
        terms = np.frombuffer(row["terms"], dtype="<i4")
        self.starts = np.frombuffer(row["starts"], dtype="<i8")
        self.places = np.frombuffer(row["places"], dtype="<i4")
        damped = np.array([damping(n, filled, total) for n in lengths.tolist()], dtype=np.int64)
        occurrences = np.frombuffer(row["occurrences"], dtype="<i4").astype(np.int64)
        self.parts = impacts(occurrences, damped[self.places])
        self.greatest = np.maximum.reduceat(self.parts, self.starts[:-1]) if len(terms) else self.parts
        self.at = {t: k for k, t in enumerate(terms.tolist())}

    def list_of(self, term: int, w: int) -> tuple[np.ndarray, np.ndarray, int] | None:
        """(places, parts, bound) of a term, or None where it adds nothing."""
        k = self.at.get(term)
        if k is None or not w:
            return None
        span = slice(self.starts[k], self.starts[k + 1])
        return self.places[span], w * self.parts[span], w * int(self.greatest[k])

    def accumulated(self, lists: list) -> tuple[np.ndarray, np.ndarray]:
        """Term at a time: places that the lists name, and the sums of their parts."""
        sums = np.zeros(len(self.ids), dtype=np.int64)
        for places, parts, _ in lists:
            sums[places] += parts
        met = np.flatnonzero(sums)
        return met, sums[met]


def _walked(lists: list, floor: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document at a time: (places, scores) of all documents that reach ``floor``, by skipping through lists (places, parts, bound)."""
    lists = sorted(lists, key=lambda x: x[2])
    bounds = np.cumsum([x[2] for x in lists])
    naming = int(np.searchsorted(bounds, floor))  # the lists before it stay under the floor together
    if naming == len(lists):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    sums = np.zeros(size, dtype=np.int64)
    for places, parts, _ in lists[naming:]:
        sums[places] += parts
    places = np.flatnonzero(sums)
    scores = sums[places]
    for k in reversed(range(naming)):
        fit = scores + bounds[k] >= floor  # what this list and those of smaller bounds could still add
        places, scores = places[fit], scores[fit]
        if not len(places):
            break
        listed, parts, _ = lists[k]
        found = np.searchsorted(listed, places)
        found[found == len(listed)] = 0
        scores = scores + np.where(listed[found] == places, parts[found], 0)
    fit = scores >= floor
    return places[fit], scores[fit]


class Best:
    """The best ``top`` rows (score, id) of one item so far."""

    def __init__(self, top: int, floor: int):
        self.top, self.floor = top, floor
        self.scores, self.ids, self.nulls = (np.empty(0, dtype=t) for t in (np.int64, np.int64, bool))

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        order = np.lexsort((ids, nulls, -scores))[:self.top]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]
        if len(order) == self.top:
            self.floor = max(self.floor, int(self.scores[-1]))


def _floors(index: DataFrame, plans: list, top: int, filled: int, total: int) -> DataFrame:
    """(item, floor): the ``top``-th greatest sum of an item's short lists, for items that have as many."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [Best(top, 1) for _ in plans]
        for frame in frames:
            for row in frame.to_dict("records"):
                block = Block(row, filled, total)
                for mine, (short, _) in zip(best, plans, strict=True):
                    met, sums = block.accumulated([x for x in (block.list_of(*t) for t in short) if x])
                    fit = sums >= mine.floor
                    if fit.any():
                        mine.add(sums[fit], met[fit], np.zeros(int(fit.sum()), dtype=bool))
        for i, mine in enumerate(best):
            if len(mine.scores):
                yield pd.DataFrame({"item": i, "sum": mine.scores})

    order = Window.partitionBy("item").orderBy(F.desc("sum"))
    return index.mapInPandas(run, "item int, sum long").withColumn("at", F.row_number().over(order)).where(
        F.col("at") <= top).where(F.col("at") == top).select("item", F.col("sum").alias("floor"))


def _found(index: DataFrame, plans: list, floors: dict[int, int], top: int, filled: int, total: int) -> DataFrame:
    """(item, doc_id, score): at most ``top`` of each item and task that reach the item's floor."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [Best(top, floors.get(i, 1)) for i in range(len(plans))]
        for frame in frames:
            for row in frame.to_dict("records"):
                block = Block(row, filled, total)
                for mine, (short, long) in zip(best, plans, strict=True):
                    lists = [x for x in (block.list_of(*t) for t in long) if x]
                    met, sums = block.accumulated([x for x in (block.list_of(*t) for t in short) if x])
                    if len(met):
                        lists.append((met, sums, int(sums.max())))
                    places, scores = _walked(lists, mine.floor, len(block.ids))
                    if len(places):
                        mine.add(scores, block.ids[places], block.nulls[places])
        for i, mine in enumerate(best):
            if len(mine.scores):
                ids = pd.array(mine.ids, dtype="Int64")
                ids[mine.nulls] = pd.NA
                yield pd.DataFrame({"item": i, "doc_id": ids, "score": mine.scores})

    return index.mapInPandas(run, "item int, doc_id long, score long")


def _searched(docs: DataFrame, queries: DataFrame, top: int, short: int, text: str, identifier: str) -> DataFrame:
    """(item_id, rank, doc_id, score) for one block of queries."""
    spark = docs.sparkSession
    rows = queries.orderBy("item").collect()  # bounded by the block
    terms: dict[bytes, int] = {}
    wanted = [[terms.setdefault(w.encode(), len(terms)) for w in r["terms"]] for r in rows]
    index = written(_index(docs, terms, text, identifier), "lexical-index")
    filled, total = (x or 0 for x in index.agg(F.sum("filled"), F.sum("total")).first())
    sizes = dict(map(tuple, _list_sizes(index).collect()))  # a number for each term of the block
    plans = []
    for ids in wanted:
        known = sorted((sizes[t], t, weight(filled, sizes[t])) for t in ids if t in sizes)
        plans.append(tuple([(t, w) for n, t, w in known if (n * short <= filled) == is_short] for is_short in (True, False)))
    floors = {r["item"]: r["floor"] for r in _floors(index, plans, top, filled, total).collect()}  # a number for each item
    found = _found(index, plans, floors, top, filled, total)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(rows)], f"_item int, item_id {queries.schema['item_id'].dataType.simpleString()}")
    return ranked.join(names, F.col("item") == F.col("_item")).select("item_id", "rank", F.col("doc_id").alias(identifier), "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = 50, short: int = 64, block_terms: int = 200_000, text: str = "text",
           identifier: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """The ``top`` documents of each item with a score above 0: item_id, rank (from 1), ``identifier``, score."""
    queries = _queries(items, text, item_id)
    terms = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-terms // block_terms))
    parts = [queries.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else queries for b in range(blocks)]
    return reduce(DataFrame.unionAll, [_searched(docs, q, top, short, text, identifier) for q in parts])
