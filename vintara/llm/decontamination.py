"""Benchmark decontamination with a distributed positional inverted index.

Words are runs of ASCII letters (lower-cased), digits and all non-ASCII characters. A window is ``window`` consecutive words
of an item; an item of fewer, but not none, is one window.

1. Term statistics: how often each word of the benchmark occurs in all documents.
2. Index: for every window the rarest of its terms is looked up, so the postings (term, document, position) of exactly these
   terms are stored, each with the ids of the test terms around it.
3. Windows meet the posting lists by their rarest term; the position less the term's offset is where the window
   would start, and there the other terms' positions are intersected. With ``slop`` a term may also
   stand up to that many places off (a proximity match). A window with a term that never occurs is dropped.

The benchmark is the query set and is taken in blocks of about ``block_words`` words; a block's vocabulary is what
tasks and the driver hold at once. Documents are never grouped by a term: the postings
of a frequent one stay spread over the tasks that stored them, unless Spark finds the windows too large to broadcast.

Defined cases: null, empty and word-free texts have no words and no hits; such items have no window; equal windows of
several items count for each; items with a null id hit like others and are together one null id in ``items``; rows that repeat a document id are copies of one document (null ids are one
id); empty tables give empty results or no hits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vintara.llm.common import written


def _spaced() -> bytes:
    """Byte table: A-Z to a-z, other ASCII but digits and a-z to a space."""
    keep = {*b"0123456789", *b"abcdefghijklmnopqrstuvwxyz", *range(128, 256)}
    return bytes(b + 32 if 65 <= b <= 90 else b if b in keep else 32 for b in range(256))


TABLE = _spaced()


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(TABLE).split()  # a space is the only white space left


def _windows(items: DataFrame, window: int, text: str, identifier: str) -> DataFrame:
    """(item, words): every window of every item."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for item, content in zip(frame["_item"], frame["_text"], strict=True):
                found = [w.decode() for w in words_of(content)]
                out += [(item, found[i:i + window]) for i in range(max(1, len(found) - window + 1))] if found else []
            yield pd.DataFrame(out, columns=["item", "words"])

    read = items.select(F.col(identifier).cast("string").alias("_item"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return read.mapInPandas(run, "item string, words array<string>")


def _read(docs: DataFrame, text: str, identifier: str) -> DataFrame:
    return docs.select(F.col(identifier).cast("string").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"))


def _statistics(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """Rows (doc, n_words) and rows (term, n): the words of each document, and each task's counts of ``terms``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, get = np.zeros(len(terms) + 1, dtype=np.int64), terms.get
        for frame in frames:
            lengths = []
            for content in frame["_text"]:
                found = words_of(content)
                lengths.append(len(found))
                if found:
                    counts += np.bincount([get(w, -1) + 1 for w in found], minlength=len(counts))
            yield pd.DataFrame({"doc": frame["doc"], "n_words": lengths, "term": -1, "n": 0})
        met = np.flatnonzero(counts[1:])
        yield pd.DataFrame({"doc": None, "n_words": 0, "term": met, "n": counts[1:][met]})

    return docs.mapInPandas(run, "doc string, n_words long, term int, n long")


def _postings(docs: DataFrame, terms: dict[bytes, int], wanted: list[int], reach: int) -> DataFrame:
    """(term, doc, position, around): postings of the ``wanted`` terms; ``around`` holds the ids of the test terms from
    ``reach`` places before to ``reach`` places after (-1: another word or none)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen, get = np.zeros(len(terms) + 1, dtype=bool), terms.get
        chosen[wanted] = True  # the last place, for -1, stays False
        near = np.arange(2 * reach + 1)
        for frame in frames:
            for doc, content in zip(frame["doc"], frame["_text"], strict=True):
                ids = np.array([get(w, -1) for w in words_of(content)], dtype=np.int32)
                at = np.flatnonzero(chosen[ids]) if len(ids) else ids
                for start in range(0, len(at), 10_000):
                    part = at[start:start + 10_000]
                    padded = np.pad(ids, reach, constant_values=-1)
                    yield pd.DataFrame({"term": ids[part], "doc": doc, "position": part, "around": list(padded[part[:, None] + near])})

    return docs.mapInPandas(_gathered(run), "term int, doc string, position long, around array<int>")


def _gathered(run, rows: int = 20_000):
    """The small frames that ``run`` yields, put together to frames of some thousand rows."""
    def outer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in run(frames):
            held.append(frame)
            size += len(frame)
            if size >= rows:
                yield pd.concat(held)
                held, size = [], 0
        if held:
            yield pd.concat(held)
    return outer


def _block_matches(read: DataFrame, windows: DataFrame, window: int, slop: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their numbers of words, and (doc, start, length, item, exact) for one block of windows."""
    spark = read.sparkSession
    rows = windows.groupBy("words").agg(F.collect_set(F.struct("item")).alias("items")).collect()  # bounded by the block
    terms: dict[bytes, int] = {}
    phrases = [([terms.setdefault(w.encode(), len(terms)) for w in r["words"]], [i["item"] for i in r["items"]]) for r in rows]
    statistics = written(_statistics(read, terms), "term-statistics")
    counts = dict(statistics.where("term >= 0").groupBy("term").agg(F.sum("n")).collect())  # at most the block's vocabulary
    table = []
    for ids, items in phrases:
        if all(t in counts for t in ids) or slop:
            known = [i for i, t in enumerate(ids) if t in counts]
            if known:
                offset = min(known, key=lambda i: (counts[ids[i]], i))
                table.append((ids[offset], offset, ids, items))
    reach = window - 1 + slop
    wanted = sorted({t for t, *_ in table})
    index = written(_postings(read, terms, wanted, reach), "postings")
    phrase = spark.createDataFrame(table, "rarest int, offset int, ids array<int>, items array<string>")
    met = index.join(phrase, index["term"] == phrase["rarest"])
    length = F.size("ids")
    first = F.lit(reach + 1) - F.col("offset")  # place of the window's first word in ``around``, from 1
    met = met.withColumn("exact", F.slice("around", first, length) == F.col("ids"))
    if slop:
        met = met.where(F.forall(F.sequence(F.lit(0), length - 1), lambda i: F.array_contains(
            F.slice("around", first + i - slop, F.lit(2 * slop + 1)), F.get("ids", i))))
    else:
        met = met.where("exact")
    found = met.select("doc", (F.col("position") - F.col("offset")).alias("start"), length.alias("length"),
                       F.explode("items").alias("item"), "exact")
    return statistics.where("term < 0").select("doc", "n_words"), found


def matches(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 0, block_words: int = 200_000,
            text: str = "text", identifier: str = "doc_id", item_id: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """Documents (doc, n_words) and matches (doc, start, length, item, exact); ids as strings, start from 0."""
    read = _read(docs, text, identifier)
    windows = written(_windows(items, window, text, item_id), "windows")
    total = windows.count() * window
    blocks = max(1, -(-total // block_words))
    found = [_block_matches(read, windows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else windows,
                            window, slop) for b in range(blocks)]
    return found[0][0], reduce(DataFrame.unionAll, [m for _, m in found])


def contamination(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """One row per document: id, n_words, n_hit (words inside any match), ``items`` (matched item ids as sorted
    strings, null last) and contaminated."""
    identifier = settings.get("identifier", "doc_id")
    read, found = matches(docs, items, **settings)
    # the spans of one document are at most as many as its words
    by_doc = found.groupBy("doc").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"),
        F.array_sort(F.collect_set(F.struct("item"))["item"]).alias("items"))  # in a struct, as a null is left out else
    hit = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n")), lambda s, x: F.struct(
        F.greatest(s["to"], x["end"]).alias("to"),
        (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["to"], x["start"]))).alias("n")), lambda s: s["n"])
    by_doc = by_doc.select(F.col("doc").alias("_doc"), hit.alias("n_hit"), "items")
    none = F.array().cast("array<string>")
    return read.join(by_doc, F.col("doc").eqNullSafe(F.col("_doc")), "left").select(
        F.col("doc").cast(docs.schema[identifier].dataType).alias(identifier), "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` without any hit."""
    identifier = settings.get("identifier", "doc_id")
    hit = contamination(docs, items, **settings).where("contaminated").select(F.col(identifier).alias("_hit_id"))
    return docs.join(hit, docs[identifier].eqNullSafe(hit["_hit_id"]), "left_anti")
