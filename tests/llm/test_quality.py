import zlib

import numpy as np
from docs import awkward, documents, words

from vintara.llm import quality as Q


def bad(seed, n):
    return " ".join(w.upper() + "!!" for w in words(seed, n).split())


def labelled(spark, n=400):
    rows = [(i, bad(i, 40) if i % 5 == 0 else words(i, 40) + ".") for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0, "x") for i, _ in rows] + [(None, 1, 0, ""), (3, None, 0, ""), (10**6, 1, 0, "")],
                                   "doc_id long, quality int, toxic int, text string")
    return documents(spark, rows), labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = labelled(spark)
    got = Q.scored(docs, Q.train(docs, labels)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert held and all(r.predicted == int(r.doc_id % 5 != 0) == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in held)


def test_training_ignores_held_out_labels(spark):
    docs, labels = labelled(spark)
    held = labels.where(Q.held_out(labels["doc_id"]))
    lies = labels.where(~Q.held_out(labels["doc_id"])).unionByName(held.selectExpr("doc_id", "1 - quality AS quality", "toxic", "text"))
    assert Q.train(docs, lies) == Q.train(docs, labels)


def test_awkward_rows_get_a_score(spark):
    docs, labels = labelled(spark)
    ranking = Q.train(docs, labels)
    rows = [*awkward(), (None, "x"), (8, "again")]
    got = Q.scored(documents(spark, rows), ranking).collect()
    assert len(got) == len(rows) and all(r.score is not None and not np.isnan(r.score) for r in got)
    kept = Q.without_rejected(documents(spark, rows), ranking)
    assert kept.columns == documents(spark, []).columns
    assert kept.count() == sum(r.predicted for r in got)


def test_one_class_teaches_nothing(spark):
    docs, labels = labelled(spark)
    ranking = Q.train(docs, labels.where("quality = 1"))
    assert not ranking.trained and {r.score for r in Q.scored(docs, ranking).collect()} == {0.5}
    assert Q.without_rejected(docs, ranking).count() == docs.count()
    assert not Q.train(documents(spark, []), labels).trained


def test_empty_table(spark):
    docs, labels = labelled(spark)
    assert Q.scored(documents(spark, []), Q.train(docs, labels)).collect() == []


def test_weights_rank_pairs():
    random_ = np.random.default_rng(2)
    values = random_.random((400, len(Q.NAMES)))
    strength = values @ np.linspace(-2, 2, len(Q.NAMES))
    good = strength > np.quantile(strength, 0.3)
    ranking = Q.fit(values, good)
    scores = values @ np.array(ranking.weights)
    assert ((scores >= ranking.cut) == good).mean() > 0.97


def test_columns_of_any_name_stay(spark):
    docs, labels = labelled(spark)
    ranking = Q.train(docs, labels)
    rows = spark.createDataFrame([(1, words(1, 40) + ".", "f", 1.5, "d"), (2, bad(2, 40), "g", 2.5, "e")], "doc_id long, text string, _vintara_features string, values double, doc string")
    assert [tuple(r) for r in Q.without_rejected(rows, ranking).collect()] == [(1, words(1, 40) + ".", "f", 1.5, "d")]
