import re

import duckdb
import pytest
from docs import awkward, documents, words

from vintara.llm import decontamination as D
from vintara.llm.queries import ORACLES, QUERIES


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(rows, items, window=10):
    phrases = {}
    for item, text in items:
        found = word_list(text)
        for i in range(max(1, len(found) - window + 1)) if found else ():
            phrases.setdefault(tuple(found[i:i + window]), set()).add(str(item))
    out = []
    for doc, text in rows:
        found, hit, met = word_list(text), set(), set()
        for phrase, of in phrases.items():
            for i in range(len(found) - len(phrase) + 1):
                if tuple(found[i:i + len(phrase)]) == phrase:
                    hit.update(range(i, i + len(phrase)))
                    met |= of
        out.append((doc, len(found), len(hit), sorted(met), bool(hit)))
    return sorted(out, key=str)


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc string, term long")


BASE = words(1, 120)
ITEMS = [(1, " ".join(BASE.split()[5:17])), (2, " ".join(BASE.split()[40:55]).upper() + "!"), (3, "one two"), (4, None), (5, " .,; "), (6, words(77, 12)),
         (7, "É à ß 日本語 😀 x É à ß 日本語"), (10, " ".join(BASE.split()[5:17])), (11, "a " * 12), (12, "never seen " + " ".join(BASE.split()[60:70]))]


def found(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in frame.collect()), key=str)


@pytest.mark.parametrize("block_words", [200_000, 60])
def test_equals_brute_force(spark, block_words):
    rows = [*awkward(), (60, "One; TWO one two"), (61, "one, three two")]
    got = D.contamination(documents(spark, rows), item_frame(spark, ITEMS), block_words=block_words)
    assert found(got) == expected(rows, ITEMS)


def test_proximity(spark):
    rows = [(1, "alpha beta gamma delta"), (2, "alpha gamma beta delta"), (3, "alpha x beta gamma y delta"), (4, "delta far from here alpha")]
    item = item_frame(spark, [(9, "alpha beta gamma delta")])
    _, exact = D.matches(documents(spark, rows), item)
    assert [(r.doc, r.start, r.length, r.exact) for r in exact.collect()] == [("1", 0, 4, True)]
    _, near = D.matches(documents(spark, rows), item, slop=2)
    assert {(r.doc, r.exact) for r in near.collect()} == {("1", True), ("2", False), ("3", False)}


def test_null_and_repeated_ids(spark):
    rows = [(None, BASE), (3, BASE), (3, BASE), (4, "clean")]
    assert [r[2] for r in found(D.contamination(documents(spark, rows), item_frame(spark, ITEMS)))] == [
        r[2] for r in expected(rows, ITEMS)]
    kept = D.without_contaminated(documents(spark, rows), item_frame(spark, ITEMS))
    assert [r.doc_id for r in kept.collect()] == [4] and kept.columns == documents(spark, []).columns


def test_empty_tables(spark):
    assert D.contamination(documents(spark, []), item_frame(spark, ITEMS)).collect() == []
    assert found(D.contamination(documents(spark, [(1, "a b")]), item_frame(spark, []))) == [(1, 2, 0, [], False)]


def test_items_without_id_hit_like_others(spark, tmp_path):
    texts = BASE.split()
    rows = [(1, BASE), (2, " ".join(texts[10:50])), (3, "clean"), (4, " ".join(texts[80:95]))]
    items = [(None, " ".join(texts[20:32])), (None, " ".join(texts[21:33])), (5, " ".join(texts[60:72])), (6, " ".join(texts[21:31]))]
    docs, bench = documents(spark, rows), item_frame(spark, [*items, (None, " ".join(texts[82:92]))])
    assert found(D.contamination(docs, bench)) == [
        (1, 120, 12 + 13 + 10, ["5", "6", None], True), (2, 40, 13, ["6", None], True), (3, 1, 0, [], False), (4, 15, 10, [None], True)]
    assert [r.doc_id for r in D.without_contaminated(docs, bench).collect()] == [3]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    by_sql = connection.execute(ORACLES["op9_decontamination"]).fetchall()
    assert sorted(tuple(r) for r in QUERIES["op9_decontamination"](spark, str(tmp_path)).collect()) == sorted(by_sql)
