"""Best-fit packing of token sequences, in bulk rounds over sorted lengths and gaps.

Documents are cut into pieces of at most ``capacity`` tokens where they are read. Pieces of one length are
interchangeable, and so are sequences with one gap, so both sides are sorted by size with a rank among
equals. A round takes the longest length left: its pieces go, in rank order, to the gaps that follow it
most closely (smallest gap that fits, filled while the length still fits), what finds no gap opens new
sequences, and the gaps shrink. This is what best fit in descending order does piece by piece, for all
equal pieces at once.

The sweep works on counts per length and runs of sequences that were filled alike: at most ``capacity``
lengths, whatever the number of documents. Its outcome is a table of rank ranges; the rows themselves are
matched to it by an equality join on the length. Ranks come from a counter per task and the counts of
the tasks before, so a length that a third of all rows have is no group of its own anywhere.

Defined cases: null and empty texts are one piece holding the end id only; rows that repeat an id are
packed each for itself; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vintara.llm.common import written
from vintara.llm.token_ids import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, text: str, identifier: str) -> DataFrame:
    """One row per piece; ``place`` counts the pieces of one length within the task."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task = encoder(tokenizer).encode, TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        seen: dict[int, int] = defaultdict(int)
        for frame in frames:
            out = []
            for doc_id, content in zip(frame["_id"], frame["_text"], strict=True):
                ids = encode(content) + end
                for start in range(0, len(ids), 4 * capacity):
                    part = memoryview(ids)[start:start + 4 * capacity]
                    length = len(part) // 4
                    out.append((doc_id, start // (4 * capacity), start // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]).astype({"doc_id": "Int64"})

    read = docs.select(F.col(identifier).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # nullable ids travel as a nullable integer type, never as floats
    return read.select(F.coalesce("_id", F.lit(0)).alias("_id"), F.col("_id").isNull().alias("_none"), "_text").mapInPandas(
        _keeping_nulls(run), PIECES)


def _keeping_nulls(run):
    def outer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def restored() -> Iterator[pd.DataFrame]:
            for frame in frames:
                frame["_id"] = frame["_id"].astype("Int64").mask(frame["_none"])
                yield frame
        yield from run(restored())
    return outer


def sweep(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, pieces, pieces per sequence, first sequence,
    offset). Pieces of one entry fill sequence after sequence, each at ``offset`` and on."""
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, count) with that gap
    gaps: list[int] = []  # gaps that have runs, ascending
    plan, opened = [], 0

    def give(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in runs:
                runs[gap] = []
                insort(gaps, gap)
            runs[gap].append((first, count))

    def place(length: int, rank: int, left: int, gap: int, first: int, count: int) -> int:
        """Fill ``count`` sequences from ``first``; returns how many pieces found room."""
        each = gap // length
        full, rest = divmod(min(left, each * count), each)
        if full:
            plan.append((length, rank, full * each, each, first, capacity - gap))
            give(gap - each * length, first, full)
        if rest:
            plan.append((length, rank + full * each, rest, rest, first + full, capacity - gap))
            give(gap - rest * length, first + full, 1)
        used = full + (rest > 0)
        give(gap, first + used, count - used)
        return full * each + rest

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        at = bisect_left(gaps, length)
        while left and at < len(gaps):
            gap = gaps[at]
            gaps.pop(at)
            for first, count in runs.pop(gap):
                if left:
                    placed = place(length, rank, left, gap, first, count)
                    rank, left = rank + placed, left - placed
                else:
                    give(gap, first, count)
            at = bisect_left(gaps, max(length, gap + 1))
        if left:
            each = capacity // length
            needed = -(-left // each)
            place(length, rank, left, capacity, opened, needed)
            opened += needed
    return plan


PLAN = "length long, first_rank long, pieces long, each long, first_sequence long, first_offset long"


def packed(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, text: str = "text",
           identifier: str = "doc_id") -> DataFrame:
    """One row per piece: ``identifier``, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = written(cut_pieces(docs, tokenizer, end_id, capacity, text, identifier), "pieces")
    tasks = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    plan = spark.createDataFrame(sweep(counts, capacity), PLAN)
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("place") + F.col("base"))
    # the plan's size follows from the capacity, not from the documents
    placed = ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"]) & (F.col("rank") >= F.col("first_rank"))
                         & (F.col("rank") < F.col("first_rank") + F.col("pieces")))
    nth = F.col("rank") - F.col("first_rank")
    return placed.select(
        F.col("doc_id").alias(identifier), "piece", "start", ranked["length"], "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("each") * ranked["length"]).cast("long").alias("offset"))
