import random
import zlib

import numpy as np
import pytest
from docs import awkward, documents, words

from vintara.llm import languages as L

SYLLABLES = {"aa": "the ing ond and er th wh", "bb": "sch ung keit ver ein ä ü", "cc": "ción que llo ñ rra los"}
SCHEMA = "doc_id long, text string, lang string, score double, rejected boolean, _lang string, _id long, _text string"


def text(lang, seed, n=40):
    r, parts = random.Random(seed), SYLLABLES[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(*r, 9.0, True, "zz", 5, "y") for r in rows], SCHEMA)


def rows_of(n=300):
    names = list(SYLLABLES)
    return [(i, text(names[i % 3], i, 3 + i % 50), names[i % 3]) for i in range(n)]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_documents_are_told_apart(spark):
    rows = rows_of()
    docs = table(spark, rows)
    got = L.predicted(docs, L.train(docs)).collect()
    truth = {i: lang for i, _, lang in rows}
    assert len(got) == len(rows) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert len(out) > 30 and sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    accepted = [r for r in out if not r.rejected]
    assert len(accepted) > 20 and all(r.lang_pred == truth[r.doc_id] for r in accepted)


def test_training_ignores_held_out_and_nameless_rows(spark):
    rows = rows_of(120)
    lies = [(i, t, "aa" if held(i) else lang) for i, t, lang in rows] + [(None, text("aa", 1), "bb"), (10**6, text("aa", 2), None), (4, None, "cc")]
    plain, other = (L.train(table(spark, x)) for x in (rows, [r for r in lies if r[0] != 4 or r[1]] + lies[-3:]))
    assert np.array_equal(plain.embeddings, other.embeddings) and (plain.temperature, plain.least) == (other.temperature, other.least)


def test_awkward_rows(spark):
    model = L.train(table(spark, rows_of(90)))
    rows = [*awkward(), (None, "the thing"), (8, "again the"), (30, "12 + 3 = ½ ² _"), (31, "Ω"), (32, "日")]
    got = L.predicted(documents(spark, rows), model).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.lang_pred == "und") for r in got}
    assert {(5, True), (6, True), (7, True), (30, True), (31, False), (32, False), (None, False)} <= by
    assert all((r.score == 0 and r.rejected) if r.lang_pred == "und" else (r.lang_pred in SYLLABLES and 0 < r.score <= 1) for r in got)


def test_nothing_to_learn(spark):
    for rows in ([], [(1, "a b", None)], [(1, None, "aa"), (2, "12", "bb")]):
        model = L.train(table(spark, rows))
        got = L.predicted(documents(spark, awkward()), model).collect()
        assert not model.languages and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    only = L.train(table(spark, [(i, "a b c", "aa") for i in range(20)]))
    assert only.languages == ("aa",) and {r.lang_pred for r in L.predicted(documents(spark, [(1, "x")]), only).collect()} == {"aa"}
    assert L.predicted(documents(spark, []), only).count() == 0


def test_sample_holds_every_language(spark):
    rows = [(i, text("aa", i, 5), "aa") for i in range(200)] + [(1000 + i, text("bb", i, 5), "bb") for i in range(12)]
    model = L.train(table(spark, rows), sample=16)
    assert model.languages == ("aa", "bb")


def one_by_one(text_):
    """Subwords of a text, counted character by character."""
    codes = [ord(c) if c.isalpha() else 0 for c in text_.lower()]
    codes = [0] + codes + [0]
    seen = []
    for n in L.SIZES:
        for i in range(len(codes) - n + 1):
            gram = codes[i:i + n]
            if all(gram[1:-1]) and (n > 2 or any(gram)):
                seen.append(tuple(gram))
    return seen


@pytest.mark.parametrize("content", ["one", "a b", "É-à ß1x", words(1, 50), "", "..", "x" * 100])
def test_bags_hold_all_subwords(monkeypatch, content):
    whole = L.bag(content)
    assert whole[1].sum() == len([g for g in one_by_one(content) if any(g)])
    monkeypatch.setattr(L, "PIECE", 7)
    cut = L.bag(content)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()


def test_scores_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    rows = rows_of(60)
    model = L.fit([L.bag(t) for _, t, _ in rows], [x for *_, x in rows], np.arange(60) % 5 == 0)
    texts = [text("aa", 1, 300), "x", text("bb", 2, 5), text("cc", 3, 100)]
    whole = model.judged(texts)
    monkeypatch.setattr(L, "PIECE", 11)
    assert np.allclose(whole, model.judged(texts))
    wide = L.Model(model.languages * 8, model.embeddings, np.tile(model.weights, 8), np.tile(model.offsets, 8), model.temperature)
    assert np.allclose(wide.judged(texts)[:, :3] * 8, whole)


def test_calibration():
    logits = np.array([[4.0, 0.0]] * 8 + [[0.0, 4.0]] * 2)
    soft = L._temperature(logits, np.zeros(10, dtype=int))
    assert abs(L._softmax(logits / soft)[0, 0] - 0.8) < 0.02  # as sure as it is right
    scores, right = np.array([0.9, 0.8, 0.7, 0.6]), np.array([True, True, False, True])
    assert L._least_score(scores, right, 1.0) == 0.8 and L._least_score(scores, right, 0.75) == 0.6
    assert L._least_score(scores, ~right, 1.0) > 1
