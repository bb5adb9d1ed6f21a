import hashlib
import re

from docs import awkward, documents
from pyspark.sql import functions as F

from vintara.llm.exact_dedup import exact_duplicates, without_duplicates


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[normal])[3]
        out.append((i, keep, len(groups[normal]), i == keep, hashlib.sha256(normal.encode()).hexdigest()))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_equals_brute_force(spark):
    rows = awkward()
    assert found(exact_duplicates(documents(spark, rows))) == expected(rows)


def test_colliding_hash_is_told_apart_by_bytes(spark):
    rows = awkward()
    for weak in (lambda c: F.lit("same"), lambda c: F.substring(F.md5(c), 1, 1)):
        assert found(exact_duplicates(documents(spark, rows), content_hash=weak)) == expected(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (2, "ab"), (2, "ab"), (-5, "a b"), (None, "only"), (2**63 - 1, "z"), (-2**63, "z")]
    assert found(exact_duplicates(documents(spark, rows))) == expected(rows)
    kept = without_duplicates(documents(spark, rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == [(-2**63, "z"), (-5, "a b")]


def test_empty_table(spark):
    assert exact_duplicates(documents(spark, [])).collect() == []
    assert without_duplicates(documents(spark, [])).columns == documents(spark, []).columns


def test_rows_with_null_ids_are_judged_one_by_one(spark):
    rows = [(None, "a b"), (None, "a  b"), (None, "ab"), (None, "only"), (None, "on ly"), (None, "x"), (3, "x"), (4, "y"), (None, "y  ."), (None, "y ."),
            (5, "y."), (None, None), (None, " ")]
    kept = without_duplicates(documents(spark, rows))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(None, "a  b"), (None, "on ly"), (3, "x"), (4, "y"), (None, "y  ."), (None, " ")], key=str)
    assert kept.columns == documents(spark, []).columns


def test_rows_that_repeat_an_id_are_judged_one_by_one(spark):
    cases = [
        ([(1, "same text"), (1, "same text")], [(1, "same text")]),
        ([(3, "B text"), (5, "B text"), (5, "other")], [(3, "B text"), (5, "other")]),
        ([(5, "B text"), (5, "other"), (7, "B text"), (7, "other"), (7, " o ther"), (9, "B text")], [(5, "B text"), (7, " o ther")]),
        ([(5, "a"), (5, "b"), (4, "a"), (None, "b"), (None, "c"), (6, "c")], [(4, "a"), (5, "b"), (6, "c")]),
    ]
    for rows, wanted in cases:
        kept = without_duplicates(documents(spark, rows))
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(wanted)


def test_columns_of_any_name_stay(spark):
    rows = spark.createDataFrame([(1, "a", 5, "n", "x", 3), (2, "a", 6, "m", "y", 4), (None, "b", 7, "o", "z", 5)],
                                 "doc_id long, text string, _null_row long, doc string, row string, key int")
    assert sorted((tuple(r) for r in without_duplicates(rows).collect()), key=str) == [(1, "a", 5, "n", "x", 3), (None, "b", 7, "o", "z", 5)]
