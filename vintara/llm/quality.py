"""Quality of documents by Bradley-Terry pairwise ranking.

Every labelled good document is preferred to every labelled bad one. Weights are learned from a bounded set of such pairs by
logistic loss on the differences of their features, so the score ranks documents rather than fits a rate. The cut is a
quantile of the training scores: the share of bad documents among the labelled. Scores go through a logistic curve that is as
steep as the training pairs ask for and is ``CUT`` at that quantile.

Features are computed from whole texts in one pass (``features``); id, labels, language and source are no inputs. Training
reads at most ``sample`` labelled rows (smallest hashes of their ids first), which is all that reaches the driver; every
document is scored, where it is read, without a shuffle.

Defined cases: null and empty texts have the features of no words and get a score like any other; null labels and labels
without a document teach nothing; labels of one class only leave all weights zero, and every score is 0.5; a repeated row is
scored each time; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

CUT = 0.3
NAMES = ["length", "symbols", "capitals", "bars", "marks", "digits", "distinct", "repeats", "same_lines", "short_words",
         "ended_words", "word_length", "vowels", "no_words"]
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{}~"
VOWELS = b"aeiouAEIOU"


def text_features(text: str) -> list[float]:
    """``NAMES`` of one text, each between 0 and about 1."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * (len(NAMES) - 1) + [1.0]
    size = sum(map(len, words))
    count = lambda characters: len(data) - len(data.translate(None, characters))
    upper = count(UPPER) + 0.0
    # capitals beyond ASCII: the second byte of À to Þ
    upper += sum(data.count(b"\xc3" + bytes([b])) for b in (0x80, 0x84, 0x87, 0x88, 0x89, 0x8A, 0x91, 0x93, 0x96, 0x9C))
    lines = data.split(b"\n")
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    share = lambda x, k=1.0: min(1.0, k * x)
    return [
        min(1.0, math.log1p(n) / 10), share(count(SYMBOLS) / size, 4), share(upper / size), share(count(b"|") / n),
        share(count(b"!?") / n), share(count(DIGITS) / size, 2), math.log(len(set(words)) + 1) / math.log(n + 1),
        share(repeats / n), 1 - len(set(lines)) / len(lines), sum(len(w) <= 3 for w in words) / n,
        sum(w[-1] in b".,;:" for w in words) / n, share(size / n / 20), share(count(VOWELS) / size), 0.0]


@F.pandas_udf(ArrayType(DoubleType()))
def features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield part.map(lambda t: text_features(t or ""))


@dataclass(frozen=True)
class Ranking:
    """Weights of the features, and the training quantile where good documents begin."""

    weights: tuple[float, ...]
    cut: float = 0.0
    slope: float = 1.0

    @property
    def trained(self) -> bool:
        return any(self.weights)

    def score(self, values: Column) -> Column:
        if not self.trained:
            return F.lit(0.5)
        total = F.lit(0.0)
        for i, w in enumerate(self.weights):
            total = total + F.get(values, i) * F.lit(float(w))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.slope) * (total - F.lit(self.cut)) + F.lit(math.log(CUT / (1 - CUT))))))


def _logistic(x: np.ndarray, target: np.ndarray, penalty: float, steps: int = 50) -> np.ndarray:
    """Weights of least logistic loss with an L2 penalty, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + penalty * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        change = np.linalg.solve(curvature, gradient)
        w = w - change
        if np.abs(change).max() < 1e-8:
            break
    return w


def fit(values: np.ndarray, good: np.ndarray, opponents: int = 16, penalty: float = 1.0, seed: int = 7) -> Ranking:
    """Weights from pairs of each document of the rarer class with ``opponents`` of the other."""
    better, worse = values[good], values[~good]
    if not len(better) or not len(worse):
        return Ranking((0.0,) * len(NAMES))
    random = np.random.default_rng(seed)
    n = opponents * min(len(better), len(worse))
    a = better[np.arange(n) % len(better) if len(better) < len(worse) else random.integers(0, len(better), n)]
    b = worse[np.arange(n) % len(worse) if len(worse) <= len(better) else random.integers(0, len(worse), n)]
    # a pair and its mirror image say the same; the preferred document comes first in half of them
    turn = np.where(np.arange(n) % 2 == 0, 1.0, -1.0)
    weights = _logistic((a - b) * turn[:, None], (turn > 0).astype(float), penalty)
    scores = values @ weights
    cut = float(np.quantile(scores, len(worse) / len(values)))
    return Ranking(tuple(float(w) for w in weights), cut, 1.0)


def held_out(identifier: Column) -> Column:
    return F.crc32(identifier.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 20_000, text: str = "text",
          identifier: str = "doc_id") -> Ranking:
    """A ranking from at most ``sample`` labelled rows that are not held out."""
    known = labels.select(F.col(identifier).alias("_id"), F.col(label).alias("_label")).where(
        F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out(F.col("_id")))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)  # at most ``sample`` rows of two numbers
    read = docs.select(F.col(identifier).alias("_doc"), F.col(text).alias("_text"))
    rows = read.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_id", "_label", features("_text").alias("f")).toPandas()
    if not len(rows):
        return Ranking((0.0,) * len(NAMES))
    rows = rows.sort_values("_id", kind="stable")
    return fit(np.stack(rows["f"].to_numpy()), rows["_label"].to_numpy() == 1)


def scored(docs: DataFrame, ranking: Ranking, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    score = ranking.score(F.col("_features"))
    return docs.select(F.col(identifier), features(F.col(text)).alias("_features")).select(
        identifier, F.coalesce(held_out(F.col(identifier)), F.lit(False)).alias("held_out"), score.alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def without_rejected(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that reach the cut, with all their columns and in place."""
    if not ranking.trained:
        return docs
    marked = docs.select(F.struct("*").alias("doc"), features(F.col(text)).alias("values"))  # columns of any name stay apart
    return marked.where(ranking.score(F.col("values")) >= CUT).select("doc.*")
