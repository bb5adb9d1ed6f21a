"""Typed scans and nested sources; deliveries are rendered from the tables, then read back."""

from pyspark.sql import functions as F

from ..plans.policy import Policy
from ..sources import files, nested, store
from . import query
from .fixture import REGISTRY, RULES, SAFE_SERIES, SIDECAR, V, inactive, rules, sidecar, table, vintages


@query("src_01_typed_scan", f"""
    WITH {V} SELECT country, source, canonical_series_id, period, period_start, period_end, value, release_at, first_seen_at,
        available_at, vintage_no, revision_type, revision_delta, pit_grade, unit, seasonal_adjustment, retrieved_at FROM v""")
def typed_scan(spark, sf_dir):
    return store.fetch_all(vintages(spark, sf_dir)).select(
        "country", "source", "canonical_series_id", "period", "period_start", "period_end", "value", "release_at",
        "first_seen_at", "available_at", "vintage_no", "revision_type", "revision_delta", "pit_grade", "unit",
        "seasonal_adjustment", "retrieved_at")


@query("src_02_sidecar", f"""
    WITH {V}, {SIDECAR} SELECT * FROM side WHERE (source = 'WIND' AND canonical_series_id <> '{SAFE_SERIES}')
        OR (source = 'SAFE' AND canonical_series_id = '{SAFE_SERIES}')""")
def sidecar_scan(spark, sf_dir):
    text = sidecar(spark, sf_dir).selectExpr(
        "canonical_series_id", "source", "period", "cast(period_end AS string) AS period_end", "cast(value AS string) AS value",
        "concat(date_format(estimated_available_at + interval 8 hours, \"yyyy-MM-dd'T'HH:mm:ss\"), '+08:00') AS estimated_available_at")
    return files.typed_sidecar(text, Policy(safe_series=SAFE_SERIES).sidecar_filter())


@query("src_03_rules_join", f"""
    WITH {V}, {RULES} SELECT canonical_series_id, lag_days, available_same_day, eligible, count(*) AS rows
    FROM v JOIN rules USING (canonical_series_id) GROUP BY ALL""")
def rules_join(spark, sf_dir):
    text = rules(spark).select(*[F.col(c).cast("string").alias(c) for c in (
        "canonical_series_id", "frequency", "lag_days", "available_same_day", "confidence", "eligible")])
    return vintages(spark, sf_dir).join(files.typed_rules(text).drop("frequency"), "canonical_series_id").groupBy(
        "canonical_series_id", "lag_days", "available_same_day", "eligible").agg(F.count(F.lit(1)).alias("rows"))


@query("src_06_inactive_rows", f"""
    WITH {V}, {REGISTRY} SELECT canonical_series_id, count(*) AS rows FROM v
    WHERE canonical_series_id IN (SELECT canonical_series_id FROM registry WHERE NOT active) GROUP BY ALL""")
def inactive_rows(spark, sf_dir):
    return vintages(spark, sf_dir).join(inactive(spark), "canonical_series_id", "left_semi").groupBy(
        "canonical_series_id").agg(F.count(F.lit(1)).alias("rows"))


@query("src_07_edition_rows", f"""
    WITH {V} SELECT country AS "REF_AREA", frequency AS "FREQ", count(*) AS rows, count(TRY_CAST(CASE WHEN ingest_seq % 13 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE)) AS numeric_rows
    FROM v GROUP BY ALL""")
def edition_rows(spark, sf_dir):
    from .transforms import editions
    schema = ", ".join(f"{c} string" for c in files.EDITION_COLUMNS)
    lines = editions(spark, sf_dir).select(F.concat_ws(";", *files.EDITION_COLUMNS).alias("line"))
    rows = lines.select(F.from_csv("line", schema, {"sep": ";"}).alias("r")).select("r.*")
    return rows.groupBy("REF_AREA", "FREQ").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.col("OBS_VALUE").try_cast("double")).alias("numeric_rows"))


def block_payloads(spark, sf_dir):
    return vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "to_json(named_struct('pulled_at', '2020-01-01T00:00:00+08:00', 'response', named_struct('data', array("
        " named_struct('meta', named_struct('code', source_series_id, 'name', series_name, 'unit', unit, 'freq', '月'),"
        "  'date', transform(sequence(0, 2), i -> date_format(last_day(add_months(period_start, i)), 'yyyyMMdd')),"
        "  'value', CASE WHEN ingest_seq % 25 = 0 THEN array(value) ELSE array(value, value + 1, value + 2) END))))) AS payload")


@query("src_08_json_blocks", f"""
    WITH {V} SELECT ingest_seq AS k, source_series_id AS code, NULL AS problem, last_day(CAST(period_start + to_months(CAST(i AS INTEGER)) AS DATE)) AS date, value + i AS value
    FROM v, range(3) r(i) WHERE ingest_seq % 25 <> 0
    UNION ALL SELECT ingest_seq, source_series_id, 'length_mismatch', NULL, NULL FROM v WHERE ingest_seq % 25 = 0""")
def json_blocks(spark, sf_dir):
    return nested.json_blocks(block_payloads(spark, sf_dir), ["k"]).select("k", "code", "problem", "date", "value")


@query("src_09_result_objects", f"""
    WITH {V} SELECT ingest_seq AS k, 'EM_A' AS canonical_series_id, strftime(period_start, '%Y-%m') AS period, value FROM v
    UNION ALL SELECT ingest_seq, 'EM_B', strftime(period_start, '%Y-%m'), value * 2 FROM v WHERE ingest_seq % 8 <> 0
    UNION ALL SELECT ingest_seq, 'EM_A', strftime(CAST(period_start + INTERVAL 1 MONTH AS DATE), '%Y-%m'), value + 1 FROM v""")
def result_objects(spark, sf_dir):
    payloads = vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "to_json(named_struct('result', named_struct('data', array("
        " named_struct('REPORT_DATE', concat(cast(period_start AS string), ' 00:00:00'), 'A', cast(value AS string),"
        "  'B', CASE WHEN ingest_seq % 8 <> 0 THEN cast(value * 2 AS string) END),"
        " named_struct('REPORT_DATE', concat(cast(add_months(period_start, 1) AS string), ' 00:00:00'), 'A', cast(value + 1 AS string), 'B', 'n/a'))))) AS payload")
    return nested.result_objects(payloads, ["k"], {"A": "EM_A", "B": "EM_B"})


def jsonp_payloads(spark, sf_dir):
    return vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "concat('cb({config:[1],data:[[0]]},{count:2,data:[[\"', year(period_start), '.', month(period_start), '\",\"制造业 [x]\",', value,"
        " ',null],[\"', year(period_start), '.', month(period_start), '\",\"其他\",', value + 1, ',', value * 2, CASE WHEN ingest_seq % 40 = 0 THEN '' ELSE ']]})' END) AS payload")


@query("src_10_jsonp_rows", f"""
    WITH {V}, o AS (SELECT * FROM v WHERE ingest_seq % 40 <> 0)
    SELECT ingest_seq AS k, 'S_2' AS canonical_series_id, strftime(period_start, '%Y-%m') AS period, value FROM o
    UNION ALL SELECT ingest_seq, 'S_2', strftime(period_start, '%Y-%m'), value + 1 FROM o
    UNION ALL SELECT ingest_seq, 'S_3', strftime(period_start, '%Y-%m'), value * 2 FROM o""")
def jsonp_rows(spark, sf_dir):
    return nested.jsonp_rows(jsonp_payloads(spark, sf_dir), ["k"], {2: "S_2", 3: "S_3"})


@query("src_10_jsonp_without_data", f"WITH {V} SELECT ingest_seq AS k FROM v WHERE ingest_seq % 40 = 0")
def jsonp_without_data(spark, sf_dir):
    return nested.without_data(jsonp_payloads(spark, sf_dir)).select("k")


@query("src_11_data_nodes", f"""
    WITH {V} SELECT ingest_seq AS k, source_series_id, 'N_' || source_series_id AS canonical_series_id, 'pct' AS unit, strftime(period_start, '%Y-%m') AS period, value
    FROM v WHERE ingest_seq % 6 <> 0 AND source_series_id IN ('X1', 'X2', 'X3', 'X4', 'X5')""")
def data_nodes(spark, sf_dir):
    payloads = vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "to_json(named_struct('returndata', named_struct('datanodes', array(named_struct("
        " 'data', named_struct('data', value, 'hasdata', ingest_seq % 6 <> 0), 'wds', array("
        "  named_struct('wdcode', 'zb', 'valuecode', source_series_id), named_struct('wdcode', 'sj', 'valuecode', date_format(period_start, 'yyyyMM')))))))) AS payload")
    mapping = spark.range(1, 6).selectExpr("concat('X', id) AS source_series_id", "concat('N_X', id) AS canonical_series_id", "'pct' AS unit")
    return nested.data_nodes(payloads, ["k"], mapping)


@query("src_12_feed_entries", f"""
    WITH {V} SELECT ingest_seq AS k, 'US_2Y' AS canonical_series_id, period_start AS day, value FROM v
    UNION ALL SELECT ingest_seq, 'US_10Y', period_start, value + 1 FROM v WHERE ingest_seq % 9 <> 0
    UNION ALL SELECT ingest_seq, 'US_2Y', CAST(period_start + 1 AS DATE), value + 2 FROM v""")
def feed_entries(spark, sf_dir):
    payloads = vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "concat('<feed xmlns:m=\"urn:m\" xmlns:d=\"urn:d\"><entry><content><m:properties><d:NEW_DATE>', period_start, 'T00:00:00</d:NEW_DATE><d:BC_2YEAR>', value,"
        " '</d:BC_2YEAR><d:BC_10YEAR>', CASE WHEN ingest_seq % 9 = 0 THEN 'N/A' ELSE cast(value + 1 AS string) END,"
        " '</d:BC_10YEAR></m:properties></content></entry><entry><content><m:properties><d:NEW_DATE>', date_add(period_start, 1), 'T00:00:00</d:NEW_DATE><d:BC_2YEAR> ', value + 2,"
        " ' </d:BC_2YEAR></m:properties></content></entry></feed>') AS payload")
    return nested.feed_entries(payloads, ["k"], {"BC_2YEAR": "US_2Y", "BC_10YEAR": "US_10Y"})


@query("src_13_curve_tables", f"""
    WITH {V} SELECT ingest_seq AS k, 'Govt Bond' AS curve, period_start AS day, '1Y' AS tenor, value FROM v
    UNION ALL SELECT ingest_seq, 'Govt Bond', period_start, '10Y', value + 1 FROM v WHERE ingest_seq % 5 <> 0
    UNION ALL SELECT ingest_seq, 'Credit (AAA)', CAST(period_start + 1 AS DATE), '1Y', value + 2 FROM v""")
def curve_tables(spark, sf_dir):
    pages = vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "concat('<div><table><tr><td>menu</td></tr></table><table><tr><th>Yield Curve Name</th><th>Date</th><th>1Y</th><th>10Y</th></tr><tr><td> Govt Bond</td><td>', period_start,"
        " '</td><td>', value, '</td><td>', CASE WHEN ingest_seq % 5 = 0 THEN '--' ELSE cast(value + 1 AS string) END, '</td></tr><tr><td>Credit (AAA)</td><td>', date_add(period_start, 1), '</td><td>', value + 2, '</td></tr></table></div>') AS html")
    return nested.curve_tables(pages, ["k"])


@query("src_16_second_dataset", f"""
    WITH {V} SELECT a.source, count(*) AS rows FROM v a WHERE priority IN ('1-URGENT', '2-HIGH')
      AND NOT EXISTS (SELECT 1 FROM v b WHERE b.priority NOT IN ('1-URGENT', '2-HIGH') AND b.source = a.source
                      AND b.canonical_series_id = a.canonical_series_id AND b.period = a.period) GROUP BY a.source""")
def second_dataset(spark, sf_dir):
    from .ingest import split
    other, first = split(spark, sf_dir)
    key = ["source", "canonical_series_id", "period"]
    return first.join(other.select(*key).distinct(), key, "left_anti").groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


def candidate_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "concat('http://example.com/', user_id, '/', event_type) AS url",
        "CASE WHEN event_id % 10 <> 0 THEN date_format(add_months(ts, cast(-(event_id % 30) AS int)), 'yyyy-MM') END AS period")


@query("src_17_candidate_list", """
    WITH c AS (SELECT 'http://example.com/' || user_id || '/' || event_type AS url,
        CASE WHEN event_id % 10 <> 0 THEN strftime(CAST(ts AS DATE) - to_months(CAST(event_id % 30 AS INTEGER)), '%Y-%m') END AS period FROM events)
    SELECT url, min(period) AS period FROM c WHERE period >= '2022-06' OR period IS NULL GROUP BY url""")
def candidate_list(spark, sf_dir):
    return files.candidates_from(candidate_rows(spark, sf_dir), "2022-06")


