"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

Subwords are the character n-grams of ``SIZES`` within words of letters, lower-cased, with the words' borders; each is hashed to one of
``2**BITS`` embeddings. A text is the average of the embeddings of all its subwords, and a linear softmax over it gives the
languages' probabilities. Both layers are learned in numpy by stochastic gradient descent, a text a step.

Training takes at most ``sample`` texts, about as many of every language (those with the smallest hashes of their ids), and only their bags
of subwords reach the driver. A fifth of them calibrates instead of training: the temperature that the softmax is divided by, and the least
score at which accepted texts are right with at least ``precision``. Texts below that score are marked as rejected. Every document is
scored whole, where it is read, without a shuffle; id, language and source are no inputs of a prediction.

Defined cases: null texts and texts without a letter are ``und`` with score 0, rejected, and teach nothing; null languages teach nothing; without any
language to learn all documents are ``und`` with score 0; rows that repeat an id teach once and are scored each; a null id is never
held out and teaches nothing; very long texts are read in pieces whose sums add up; empty tables give empty results; other columns are
not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vintara.llm.quality import held_out

SIZES = (2, 3, 4)
BITS = 15
WIDTH = 16  # of an embedding
PIECE = 1 << 20  # characters looked at together
_MULTIPLIERS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93)]


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def codes_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 0 for all but letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(_letters()[codes], codes, 0)


def subwords(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of the n-grams of each size: between their ends there are letters only, and at one end at least."""
    wide = codes.astype(np.uint64)
    letter = codes > 0
    for n in SIZES:
        if len(codes) < n:
            continue
        parts = [slice(i, len(codes) - n + 1 + i) for i in range(n)]
        inner = [letter[p] for p in parts[1:-1]] or [letter[parts[0]] | letter[parts[-1]]]
        at = np.flatnonzero(np.logical_and.reduce(inner))
        total = np.full(len(at), n, dtype=np.uint64)
        for p in parts:
            total = (total + wide[p][at]) * _MULTIPLIERS[n - 1]
            total ^= total >> np.uint64(29)
        yield at, (total * _MULTIPLIERS[0] >> np.uint64(64 - BITS)).astype(np.int64)


def _padded(pieces: list[np.ndarray]) -> np.ndarray:
    """Pieces behind each other, a border before each and enough borders after it."""
    gap = np.zeros(max(SIZES), dtype=np.uint32)
    return np.concatenate([x for p in pieces for x in (gap[:1], p, gap[1:])]) if pieces else gap[:0]


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(numbers of texts, codes, place of each code among those texts); texts of over ``PIECE`` characters come in several pieces, which
    share just the characters that n-grams over the cut need."""
    reach = max(SIZES) - 1

    def together(numbers, held):
        return numbers, _padded(held), np.repeat(np.arange(len(held)), [len(h) + max(SIZES) for h in held])

    numbers, held, size = [], [], 0
    for i, text in enumerate(texts):
        codes = codes_of(text)
        if len(codes) > PIECE:
            codes = _padded([codes])
            for start in range(0, len(codes), PIECE):
                part = codes[start:start + PIECE + reach]
                # an n-gram belongs to the piece it starts in
                yield [i], part, np.where(np.arange(len(part)) < PIECE, 0, -1)
            continue
        numbers.append(i)
        held.append(codes)
        size += len(codes)
        if size >= PIECE:
            yield together(numbers, held)
            numbers, held, size = [], [], 0
    if held:
        yield together(numbers, held)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct subwords of a text and how often each occurs."""
    counts = np.zeros(1 << BITS, dtype=np.int64)
    for _, codes, place in _pieces([text]):
        for at, ids in subwords(codes):
            counts += np.bincount(ids[place[at] >= 0], minlength=len(counts))
    met = np.flatnonzero(counts)
    return met, counts[met]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class Model:
    """Learned languages, embeddings, weights, temperature and the least score of an accepted text."""

    languages: tuple[str, ...] = ()
    embeddings: np.ndarray | None = None
    weights: np.ndarray | None = None
    offsets: np.ndarray | None = None
    temperature: float = 1.0
    least: float = 1.0

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """From the sums of each text's embeddings and the numbers of its subwords."""
        mean = sums / np.maximum(counts, 1)[:, None]
        return _softmax((mean @ self.weights + self.offsets) / self.temperature)

    def judged(self, texts: list[str]) -> np.ndarray:
        """A row of probabilities for each text."""
        # sums of logits need no more columns than sums of embeddings if there are few languages
        few = len(self.languages) <= self.embeddings.shape[1]
        table = np.ascontiguousarray((self.embeddings @ self.weights if few else self.embeddings).T)
        sums, counts = np.zeros((len(texts), len(table))), np.zeros(len(texts))
        for numbers, codes, place in _pieces(texts):
            for at, ids in subwords(codes):
                own = place[at]
                if len(own) and own.min() < 0:
                    ids, own = ids[own >= 0], own[own >= 0]
                counts[numbers] += np.bincount(own, minlength=len(numbers))
                for k, row in enumerate(table):
                    sums[numbers, k] += np.bincount(own, weights=row[ids], minlength=len(numbers))
        if few:
            return _softmax((sums / np.maximum(counts, 1)[:, None] + self.offsets) / self.temperature)
        return self.probabilities(sums, counts)


def _descended(bags: list, labels: np.ndarray, n: int, epochs: int, rate: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, weights and offsets after ``epochs`` rounds of stochastic gradient descent over the texts."""
    random = np.random.default_rng(seed)
    embeddings = random.uniform(-1, 1, (1 << BITS, WIDTH)) / WIDTH
    weights, offsets = np.zeros((WIDTH, n)), np.zeros(n)
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in random.permutation(len(bags)):
            ids, shares = bags[i]
            pace = rate * (1 - done / steps)
            done += 1
            mean = shares @ embeddings[ids]
            error = _softmax(mean @ weights + offsets)
            error[labels[i]] -= 1
            back = weights @ error
            weights -= pace * np.outer(mean, error)
            offsets -= 0.1 * pace * error
            # an embedding's part in the mean is its share, of the order of one in the number of subwords
            embeddings[ids] -= pace * (shares / (shares @ shares) ** 0.5)[:, None] * back
    return embeddings, weights, offsets


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor under which the labels are likeliest."""
    def loss(t: float) -> float:
        p = _softmax(logits / t)[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    return min((float(t) for t in np.exp(np.linspace(np.log(0.05), np.log(20), 200))), key=loss)


def _least_score(scores: np.ndarray, right: np.ndarray, precision: float) -> float:
    """The least score such that texts of at least that score are right with ``precision``; above 1 if there is none."""
    order = np.argsort(-scores, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    last = np.flatnonzero((share >= precision) & np.append(np.diff(scores[order]) != 0, True))
    return float(scores[order][last[-1]]) if len(last) else 1.1


def fit(bags: list, languages: list[str], calibrating: np.ndarray, epochs: int = 8, rate: float = 0.5, precision: float = 0.99,
        seed: int = 7) -> Model:
    """A model from bags (ids, counts); those marked ``calibrating`` set temperature and least score, unless there are none."""
    names = tuple(sorted(set(languages)))
    if not names:
        return Model()
    labels = np.array([names.index(x) for x in languages])
    shared = [(ids, counts / counts.sum()) for ids, counts in bags]
    learn, judge = np.flatnonzero(~calibrating), np.flatnonzero(calibrating)
    if not len(learn) or not len(judge):
        learn = judge = np.arange(len(bags))
    model = Model(names, *_descended([shared[i] for i in learn], labels[learn], len(names), epochs, rate, seed))
    logits = np.stack([shared[i][1] @ model.embeddings[shared[i][0]] for i in judge]) @ model.weights + model.offsets
    temperature = _temperature(logits, labels[judge]) if len(names) > 1 else 1.0
    p = _softmax(logits / temperature)
    least = _least_score(p.max(axis=1), p.argmax(axis=1) == labels[judge], precision)
    return Model(names, model.embeddings, model.weights, model.offsets, temperature, least)


def train(docs: DataFrame, sample: int = 4_000, text: str = "text", language: str = "lang", identifier: str = "doc_id", **settings) -> Model:
    """A model from at most ``sample`` documents that are not held out."""
    known = docs.where(F.col(text).isNotNull() & F.col(language).isNotNull() & F.col(identifier).isNotNull()
                       & ~held_out(F.col(identifier))).select(
        F.col(identifier).alias("_id"), F.col(language).cast("string").alias("_lang"), (F.pmod(F.xxhash64(
            F.col(identifier)), F.lit(1 << 31)) / F.lit(float(1 << 31))).alias("_hash"))
    counts = known.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("_lang", "_of")
    each = sample / max(1, counts.count())
    # a language's rows are taken by their hashes alone, as many as the others' are expected, so that none is gathered
    chosen = known.join(counts, F.col("_lang") == F.col("_of")).where(F.col("_hash") * F.col("_n") < F.lit(each))
    chosen = chosen.orderBy("_hash", "_id").limit(sample)
    chosen = chosen.select(F.col("_id").alias("_wanted")).distinct()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, name, content in zip(frame["_id"], frame["_lang"], frame["_text"], strict=True):
                ids, counts = bag(content)
                if len(ids):
                    out.append((key, name, ids.astype("<u4").tobytes() + counts.astype("<u4").tobytes()))
            yield pd.DataFrame(out, columns=["id", "lang", "bag"])

    read = docs.select(F.col(identifier).alias("_id"), F.col(language).cast("string").alias("_lang"), F.col(text).alias("_text"))
    rows = read.where("_text is not null and _lang is not null").join(F.broadcast(chosen), F.col("_id") == F.col("_wanted")).select(
        F.col("_id").cast("string").alias("_id"), "_lang", "_text").mapInPandas(run, "id string, lang string, bag binary")
    once = rows.groupBy("id").agg(F.min(F.struct("lang", "bag")).alias("one")).select("id", "one.*")  # ``sample`` rows at most
    got = sorted(map(tuple, once.collect()))
    bags = []
    for _, _, data in got:
        both = np.frombuffer(bytes(data), dtype="<u4").astype(np.int64).reshape(2, -1)
        bags.append((both[0], both[1].astype(np.float64)))
    aside = np.array([_aside(x[0]) for x in got], dtype=bool)
    return fit(bags, [x[1] for x in got], aside, **settings)


def _aside(identifier: str) -> bool:
    """Whether a sampled text calibrates: one in five, by its id."""
    return int.from_bytes(hashlib.md5(identifier.encode()).digest()[:4], "little") % 5 == 0


def predicted(docs: DataFrame, model: Model, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS embeddings

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for frame in frames:
            texts = frame["_text"].tolist()
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if has_letter(t)] if known.languages else []
            if at:
                p = known.judged([texts[i] for i in at])
                scores[at] = p.max(axis=1)
                for i, k in zip(at, p.argmax(axis=1), strict=True):
                    names[i] = known.languages[k]
            yield pd.DataFrame({"_id": frame["_id"], "lang_pred": names, "score": scores,
                                "rejected": [n == "und" or s < known.least for n, s in zip(names, scores, strict=True)]})

    read = docs.select(F.col(identifier).cast("string").alias("_id"), F.col(text).alias("_text"))
    found = read.mapInPandas(run, "_id string, lang_pred string, score double, rejected boolean")
    key = F.col("_id").cast(docs.schema[identifier].dataType)
    return found.select(key.alias(identifier), F.coalesce(held_out(F.col("_id")), F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "rejected")
