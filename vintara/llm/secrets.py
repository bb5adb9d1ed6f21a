"""Secrets in texts: fixed patterns, and character Markov models that tell random strings from names.

Positions are code points, ends are exclusive. One pass of each pattern over the text puts a mark on
either side of every match; cutting at the marks gives pieces whose lengths are the positions, so
only documents with matches pay for more than the pass.

Besides the patterns, long tokens with a letter and a digit are judged by two first-order character models:
one trained on values that the patterns found (random strings), one on long tokens of letters only
(ordinary identifiers). A token is a secret when its mean log-likelihood ratio per transition
passes a threshold. The training sample is bounded (``sample`` tokens a class, smallest hashes
first); the models are two tables over a fixed alphabet, the only thing that reaches the driver.

Defined cases: a null text counts as empty and has no spans; an empty table gives an empty result;
without samples of both classes the models add nothing; repeated rows are judged each for
itself; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vintara.llm.common import whole_text, written

# The kinds of the base patterns in their listed order, and shortest accepted lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "random"]
SHORTEST = {"assign": 12, "access": 18, "hex": 16}
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"

# Marks are private-use characters, which no pattern accepts; one in a text is swapped for its neighbour.
MARK, NEIGHBOUR = "\ue000", "\ue001"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut before and after each match: pieces at odd places are the matches."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)


def _spans(pieces: Column, kind: int, accepted) -> Column:
    """Array of (start, kind, end, value) of the matches whose value ``accepted`` lets through."""
    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + F.char_length(piece)
        value = accepted(piece)
        found = state["odd"] & value.isNotNull()
        return F.struct(end.alias("at"), (~state["odd"]).alias("odd"), F.when(found, F.concat(
            state["out"], F.array(F.struct(state["at"].alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                                           F.coalesce(value, F.lit("")).alias("value"))))).otherwise(state["out"]).alias("out"))

    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("odd"), empty.alias("out"))
    return F.when(F.size(pieces) > 1, F.aggregate(pieces, start, step, lambda s: s["out"])).otherwise(empty)


def _of_length(least: int):
    return lambda piece: F.when(F.char_length(piece) >= least, piece)


def _assigned(piece: Column) -> Column:
    value = F.regexp_extract(piece, ASSIGN, 2)
    return F.when(F.char_length(value) >= SHORTEST["assign"], value)


def found_spans(docs: DataFrame, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """One row per document: ``identifier``, ``base`` (spans of the patterns) and ``candidates``."""
    clean = F.replace(whole_text(text), F.lit(MARK), F.lit(NEIGHBOUR))
    cut = docs.select(
        F.col(identifier), _pieces(clean, ASSIGN).alias("_assign"),
        F.when(F.contains(clean, F.lit("AKIA")), _pieces(clean, ACCESS)).otherwise(F.array(F.lit(""))).alias("_access"),
        _pieces(clean, HEX + f"{{{SHORTEST['hex']},}}").alias("_hex"), _pieces(clean, CANDIDATE).alias("_random"))
    return cut.select(
        identifier,
        F.concat(_spans(F.col("_assign"), 0, _assigned), _spans(F.col("_access"), 1, _of_length(SHORTEST["access"])),
                 _spans(F.col("_hex"), 2, _of_length(SHORTEST["hex"]))).alias("base"),
        _spans(F.col("_random"), 3, _of_length(1)).alias("candidates"))


@dataclass(frozen=True)
class MarkovModels:
    """``ratio[i * size + j]``: log-likelihood ratio, random over ordinary, of character j after i."""

    ratio: tuple[float, ...] | None

    def score(self, token: Column) -> Column:
        """Mean log-likelihood ratio per transition; null without a model."""
        if self.ratio is None:
            return F.lit(None).cast("double")
        size, ratios = len(ALPHABET), F.array(*map(F.lit, self.ratio))
        steps = F.char_length(token) - 1

        def step(total: Column, at: Column) -> Column:
            before = F.instr(F.lit(ALPHABET), token.substr(at, F.lit(1))) - 1
            after = F.instr(F.lit(ALPHABET), token.substr(at + 1, F.lit(1))) - 1
            return total + F.coalesce(F.get(ratios, before * size + after), F.lit(0.0))

        total = F.aggregate(F.sequence(F.lit(1), steps), F.lit(0.0), step)
        return F.when(steps > 0, total / steps).otherwise(F.lit(0.0))


def _transitions(tokens: DataFrame) -> list[tuple[str, int]]:
    pairs = tokens.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.char_length("value") - 1), lambda i: F.col("value").substr(i, F.lit(2)))).alias("pair"))
    return [tuple(r) for r in pairs.groupBy("pair").agg(F.count(F.lit(1))).collect()]  # at most alphabet squared


def train(random_tokens: DataFrame, ordinary_tokens: DataFrame, sample: int = 20_000, smoothing: float = 0.5) -> MarkovModels:
    """Models of two frames of labelled tokens (column ``value``), at most ``sample`` distinct ones of each."""
    letters = "^[" + ALPHABET.replace("-", "") + "-]{2,}$"
    tables = []
    for tokens in (random_tokens, ordinary_tokens):
        chosen = tokens.where(F.col("value").rlike(letters)).select("value").distinct().orderBy(
            F.xxhash64("value"), "value").limit(sample)
        tables.append(_transitions(chosen))
    if not all(tables):
        return MarkovModels(None)
    import math

    size, logs = len(ALPHABET), []
    for counts in tables:
        matrix = [smoothing] * (size * size)
        for pair, n in counts:
            matrix[ALPHABET.index(pair[0]) * size + ALPHABET.index(pair[1])] += n
        logs.append([math.log(matrix[i * size + j] / sum(matrix[i * size:(i + 1) * size])) for i in range(size) for j in range(size)])
    return MarkovModels(tuple(a - b for a, b in zip(*logs, strict=True)))


def secrets(docs: DataFrame, text: str = "text", identifier: str = "doc_id", sample: int = 20_000,
            threshold: float = 0.25) -> DataFrame:
    """One row per document: ``identifier``, ``base`` and ``added`` spans (start, kind, end, value),
    sorted; kind is the place in ``KINDS``. Added spans overlap no base span."""
    found = written(found_spans(docs, text, identifier), "spans")
    values = found.select(F.explode("base").alias("s")).select("s.value")
    words = found.select(F.explode("candidates").alias("s")).select("s.value").where(~F.col("value").rlike("[^A-Za-z]"))
    models = train(values, words, sample)
    mixed = F.filter("candidates", lambda c: c["value"].rlike("[0-9]") & c["value"].rlike("[A-Za-z]") & ~F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return found.select(identifier, F.array_sort("base").alias("base"), F.array_sort(F.filter(
        mixed, lambda c: F.coalesce(models.score(c["value"]) > threshold, F.lit(False)))).alias("added"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span in order, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
