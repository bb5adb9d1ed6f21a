"""Registered queries of this subpackage, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vintara.llm import languages, lexical_search, quality, warc
from vintara.llm.collocations import collocations
from vintara.llm.common import table
from vintara.llm.decontamination import contamination
from vintara.llm.exact_dedup import exact_duplicates
from vintara.llm.packing import packed
from vintara.llm.secrets import listed, secrets
from vintara.llm.sharding import kd_shards
from vintara.llm.simhash import near_duplicates
from vintara.llm.substring_dedup import without_repeats
from vintara.llm.token_files import round_trip
from vintara.llm.token_ids import tokenizer_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


@query("op1_exact_dedup", r"""
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM (
        SELECT doc_id, t, count(*) OVER (PARTITION BY t) AS group_size,
               first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id FROM d)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"))


@query("op5_kd_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=2)


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), capacity=4096, end_id=1)


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=4, lanes=1, segments=3, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("_f0")), 16, "0").alias("fingerprint"), "component_id")


@query("op9_decontamination", r"""
    WITH b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS p
          FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    m AS (SELECT doc_id, s.i AS i, g.n AS n, item_id FROM (
              SELECT doc_id, i, k AS n, array_to_string(w[i:i + k - 1], ' ') AS p FROM (
                  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT n AS k FROM g) WHERE len(w) >= k)) s
          JOIN g ON g.p = s.p AND g.n = s.n),
    h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM m) GROUP BY doc_id),
    t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS list
          FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op3_warc_round_trip", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    r AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
                 max(page_id) OVER (PARTITION BY h) AS head FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id <> head THEN head END AS refers_to FROM r""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op8_quality_ranking")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"), n=50)
    removed = F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_collocations", r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k)),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
    n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1),
    s AS (SELECT c.lang, c.k, c.phrase, c.a, j, x.f AS l, y.f AS r,
                 (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
          FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
          JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[:j], ' ')
          JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
    m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    i AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, a, array_to_string(w[:2], ' ') AS phrase FROM c WHERE k = 3
          UNION ALL SELECT lang, a, array_to_string(w[2:], ' ') FROM c WHERE k = 3) GROUP BY ALL)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
        SELECT m.*, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, m.a DESC, m.phrase) AS rank
        FROM m LEFT JOIN i ON i.lang = m.lang AND i.phrase = m.phrase WHERE i.a IS NULL OR 100 * i.a < 50 * m.a) JOIN n USING (lang)
    WHERE rank <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), longest=3, threshold=10, contained=50, top=2000)


@query("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return languages.predicted(docs, languages.train(docs))


@query("op13_lexical_search", r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    q AS (SELECT DISTINCT row, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS row, item_id, regexp_extract_all(translate(
              coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark)),
    c AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
    p AS (SELECT row, doc_id, term, count(*) AS tf, any_value(100 - 50 + (50 * n * docs) // total) AS m
          FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM d), c WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    v AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, c GROUP BY term),
    s AS (SELECT q.row AS item, item_id, p.row, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
          FROM q JOIN p USING (term) JOIN v USING (term) GROUP BY ALL)
    SELECT item_id, rank::INT AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 50""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=50)
