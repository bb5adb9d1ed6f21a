"""Audits over the order-derived vintages; the crawl log is read from ``events``."""

from pyspark.sql import functions as F

from ..functions.instants import instant
from ..operators import asof, audit, inventory
from . import query
from .asof import select_at
from .fixture import REGISTRY, V, registry, table, vintages
from .intervals import START
from .selection_sql import selected_sql


@query("qa_01_duplicate_vintages", f"""
    WITH {V} SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM v
        GROUP BY source, canonical_series_id, period, vintage_no HAVING count(*) > 1)""")
def duplicate_vintages(spark, sf_dir):
    return audit.duplicate_vintages(vintages(spark, sf_dir))


@query("qa_02_row_defects", f"""
    WITH {V} SELECT count(*) AS rows, count(*) FILTER (pit_grade IN ('A','B','C') AND release_at IS NULL) AS missing_release,
        count(*) FILTER (source_url IS NULL OR trim(source_url) = '') AS missing_url,
        count(*) FILTER (frequency NOT IN ('D','W','M','Q','A')) AS bad_frequency,
        count(*) FILTER (NOT isfinite(value)) AS bad_value, count(*) FILTER (vintage_no > 0) AS revision_rows FROM v""")
def row_defects(spark, sf_dir):
    return audit.row_defects(vintages(spark, sf_dir))


@query("qa_02_delivery_defects", """
    WITH d AS (SELECT * FROM events)
    SELECT count(*) AS rows, count(*) FILTER (event_type IN ('click', 'view') AND value IS NULL) AS missing_release,
        count(*) FILTER (trim(regexp_replace(event_type, '^error$', ' ')) = '') AS missing_url,
        count(*) FILTER (event_type NOT IN ('D','W','M','Q','A')) AS bad_frequency,
        count(*) FILTER (NOT isfinite(CASE WHEN event_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE value END)) AS bad_value,
        count(*) FILTER (user_id > 0) AS revision_rows FROM d""")
def delivery_defects(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_type IN ('click', 'view') THEN 'A' ELSE 'D' END AS pit_grade", "value AS release_at",
        "regexp_replace(event_type, '^error$', ' ') AS source_url", "event_type AS frequency",
        "CASE WHEN event_id % 7 = 0 THEN double('NaN') ELSE value END AS value", "user_id AS vintage_no")
    return audit.row_defects(rows)


@query("qa_03_unit_changes", f"""
    WITH {V} SELECT canonical_series_id, count(DISTINCT unit) AS units FROM v GROUP BY 1 HAVING count(DISTINCT unit) > 1""")
def unit_changes(spark, sf_dir):
    return audit.unit_changes(vintages(spark, sf_dir))


@query("qa_04_grade_histogram", f"WITH {V} SELECT pit_grade, count(*) AS rows FROM v GROUP BY 1")
def grade_histogram(spark, sf_dir):
    return audit.grade_histogram(vintages(spark, sf_dir))


@query("qa_04_series_per_country", f"WITH {V} SELECT country, count(DISTINCT canonical_series_id) AS series FROM v GROUP BY 1")
def series_per_country(spark, sf_dir):
    return audit.series_per_country(vintages(spark, sf_dir))


def crawl_log(spark, sf_dir):
    """Fetch attempts read from the event stream."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id AS string) AS crawl_id", "concat('src', user_id % 5) AS source",
        "concat('u', user_id, CASE WHEN user_id % 3 = 0 THEN '/robots.txt' ELSE '' END) AS url", "ts AS completed_at",
        "CASE WHEN event_id % 7 = 0 THEN 404 WHEN event_id % 7 = 1 THEN 500 ELSE 200 END AS http_status",
        "event_type <> 'error' AND event_id % 7 > 1 AS success",
        "CASE WHEN event_type = 'error' THEN 'HtmlParserError' WHEN event_id % 7 <= 1 THEN 'HttpError' END AS error_type",
        "CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 11 = 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status")


CRAWL = """crawl AS (SELECT CAST(event_id AS VARCHAR) AS crawl_id, 'src' || (user_id % 5) AS source,
    'u' || user_id || CASE WHEN user_id % 3 = 0 THEN '/robots.txt' ELSE '' END AS url, ts AS completed_at,
    CASE WHEN event_id % 7 = 0 THEN 404 WHEN event_id % 7 = 1 THEN 500 ELSE 200 END AS http_status,
    event_type <> 'error' AND event_id % 7 > 1 AS success,
    CASE WHEN event_type = 'error' THEN 'HtmlParserError' WHEN event_id % 7 <= 1 THEN 'HttpError' END AS error_type,
    CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 11 = 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status FROM events)"""


@query("qa_06_crawl_failures", f"""
    WITH {CRAWL}, l AS (SELECT * FROM crawl QUALIFY row_number() OVER (PARTITION BY source, url ORDER BY completed_at DESC, crawl_id DESC) = 1)
    SELECT count(*) FILTER (error_type LIKE '%Parser%') AS parse_failures,
        count(*) FILTER (NOT success AND NOT (http_status = 404 AND regexp_matches(url, '/robots\\.txt$'))) AS http_failures,
        count(*) AS urls FROM l""")
def crawl_failures(spark, sf_dir):
    return audit.crawl_failures(crawl_log(spark, sf_dir))


def structural(spark):
    return spark.sql("SELECT * FROM VALUES ('OFF1', array(1, 2)), ('OFF2', array(7)) t(source, missing_months)")


STRUCTURAL = "structural AS (SELECT * FROM (VALUES ('OFF1', [1, 2]), ('OFF2', [7])) t(source, missing_months))"
EXPECTED = """CASE WHEN frequency = 'M' THEN (SELECT count(*) FROM range(CAST(substr(first, 1, 4) AS BIGINT) * 12 + TRY_CAST(substr(first, 6, 2) AS BIGINT) - 1,
            CAST(substr(last, 1, 4) AS BIGINT) * 12 + TRY_CAST(substr(last, 6, 2) AS BIGINT)) r(i)
            WHERE NOT coalesce(list_contains(missing_months, CAST(i % 12 + 1 AS INTEGER)), FALSE))
        WHEN frequency = 'Q' THEN (CAST(substr(last, 1, 4) AS BIGINT) - CAST(substr(first, 1, 4) AS BIGINT)) * 4
            + TRY_CAST(substr(last, 7, 1) AS BIGINT) - TRY_CAST(substr(first, 7, 1) AS BIGINT) + 1 ELSE 0 END"""


@query("qa_07_raw_evidence", """
    WITH r AS (SELECT *, CASE WHEN page_id % 4 = 0 THEN 'N/A' WHEN page_id % 5 = 0 THEN sha256(url) ELSE upper(sha256(html)) END AS digest FROM pages)
    SELECT count(*) AS rows, count(*) FILTER (lower(digest) = sha256(html) AND page_id % 6 <> 0) AS verified,
        count(*) FILTER (lower(digest) = sha256(html) AND page_id % 6 <> 0 AND page_id % 3 = 1) AS strict_verified FROM r""")
def raw_evidence(spark, sf_dir):
    # pages are the archived files; some records name a lost file, a wrong digest or none
    pages = table(spark, sf_dir, "pages", spread_by="page_id")
    files = pages.select(F.concat(F.lit("page/"), "page_id").alias("path"), F.encode("html", "UTF-8").alias("content"))
    records = pages.selectExpr(
        "concat(CASE WHEN page_id % 6 = 0 THEN 'lost/' ELSE 'page/' END, page_id) AS raw_file",
        "CASE WHEN page_id % 4 = 0 THEN 'N/A' WHEN page_id % 5 = 0 THEN sha2(url, 256) ELSE upper(sha2(html, 256)) END AS raw_sha256",
        "CASE WHEN page_id % 3 = 1 THEN 'A' ELSE 'D' END AS pit_grade")
    return audit.raw_evidence(records, files)


@query("qa_08_coverage", f"""
    WITH {V}, {REGISTRY}, {STRUCTURAL},
    seen AS (SELECT canonical_series_id, frequency, min(period) AS first, max(period) AS last, count(DISTINCT period) AS n,
                    count(*) FILTER (pit_grade = 'A') AS a, count(*) FILTER (pit_grade = 'B') AS b,
                    count(*) FILTER (pit_grade = 'C') AS c, count(*) FILTER (pit_grade = 'D') AS d
             FROM v WHERE country = 'CN' GROUP BY 1, 2),
    j AS (SELECT r.canonical_series_id, r.source, coalesce(s.frequency, r.frequency) AS frequency, s.* EXCLUDE (canonical_series_id, frequency),
                 missing_months FROM registry r LEFT JOIN seen s USING (canonical_series_id) LEFT JOIN structural USING (source)
          WHERE r.country = 'CN' AND r.active),
    e AS (SELECT *, CASE WHEN first IS NULL THEN 0 ELSE {EXPECTED} END AS expected FROM j)
    SELECT canonical_series_id, source, frequency, first AS earliest_valid_period, last AS latest_period,
        coalesce(n, 0) AS observed_periods, expected AS expected_periods,
        CASE WHEN expected > 0 THEN coalesce(n, 0) / expected ELSE 0.0 END AS coverage, coalesce(a, 0) AS pit_a_rows,
        coalesce(b, 0) AS pit_b_rows, coalesce(c, 0) AS pit_c_rows, coalesce(d, 0) AS pit_d_rows FROM e""")
def coverage(spark, sf_dir):
    return audit.coverage(vintages(spark, sf_dir), registry(spark), "CN", structural(spark))


@query("qa_09_expected_periods", f"""
    WITH {V}, {STRUCTURAL}, s AS (SELECT source, canonical_series_id, frequency, min(period) AS first, max(period) AS last
                                  FROM v GROUP BY 1, 2, 3),
    j AS (SELECT * FROM s LEFT JOIN structural USING (source))
    SELECT source, canonical_series_id, frequency, {EXPECTED} AS expected FROM j""")
def expected_periods(spark, sf_dir):
    spans = vintages(spark, sf_dir).groupBy("source", "canonical_series_id", "frequency").agg(
        F.min("period").alias("first"), F.max("period").alias("last"))
    return spans.join(structural(spark), "source", "left").select(
        "source", "canonical_series_id", "frequency",
        audit.expected_periods(F.col("first"), F.col("last"), F.col("frequency"), F.col("missing_months")).alias("expected"))


_CATEGORIES = ["S16", "S17", "S18", "S21", "S0"]


@query("qa_10_coverage_matrix", f"""
    WITH {V}, t(country) AS (VALUES ('CN'), ('US'), ('DEU'), ('GLB'), ('FRA')),
    f AS (SELECT t.country, {', '.join(f"coalesce(bool_or(ends_with(canonical_series_id, '_{c}')), false) AS {c.lower()}" for c in _CATEGORIES)}
          FROM t LEFT JOIN v ON v.country = t.country AND v.source = 'OFF2' GROUP BY t.country)
    SELECT *, {' AND '.join(c.lower() for c in _CATEGORIES)} AS complete,
        concat_ws(';', {', '.join(f"CASE WHEN NOT {c.lower()} THEN '{c}' END" for c in _CATEGORIES)}) AS missing FROM f""")
def coverage_matrix(spark, sf_dir):
    targets = spark.range(1).select(F.explode(F.array(*map(F.lit, ("CN", "US", "DEU", "GLB", "FRA")))).alias("country"))
    return audit.coverage_matrix(vintages(spark, sf_dir), _CATEGORIES, "OFF2", targets)


@query("qa_11_thin_series", f"""
    WITH {V}, s AS (SELECT canonical_series_id, frequency, min(period) AS first, max(period) AS last, count(DISTINCT period) AS n,
                           NULL::INTEGER[] AS missing_months FROM v WHERE country = 'CN' AND canonical_series_id <> 'CN_S4' GROUP BY 1, 2),
    e AS (SELECT *, {EXPECTED} AS expected FROM s)
    SELECT count(*) FILTER (n / expected < 0.95) AS series FROM e""")
def thin_series(spark, sf_dir):
    return audit.thin_series(audit.coverage(vintages(spark, sf_dir), registry(spark), "CN"))


@query("qa_12_historical_depth", f"""
    WITH {V}, {STRUCTURAL}, s AS (SELECT source, canonical_series_id, frequency, min(period) AS first, max(period) AS last,
                                         count(DISTINCT period) AS n FROM v WHERE country = 'CN' GROUP BY 1, 2, 3),
    j AS (SELECT * FROM s LEFT JOIN structural USING (source)), e AS (SELECT *, {EXPECTED} AS expected FROM j)
    SELECT source, canonical_series_id, frequency, first AS first_period, last AS last_period, n AS observed_periods,
        expected AS expected_periods, n >= CASE frequency WHEN 'Q' THEN 8 ELSE 24 END AND expected > 0 AND n >= 0.5 * expected AS passes FROM e""")
def historical_depth(spark, sf_dir):
    return audit.historical_depth(vintages(spark, sf_dir), ratio=0.5, structural=structural(spark))


@query("qa_13_required_sources", f"""
    WITH {V} SELECT count(*) FILTER (s IN (SELECT source FROM v)) AS present, count(*) AS required
    FROM (VALUES ('OFF1'), ('OFF2'), ('SAFE'), ('NBS')) t(s)""")
def required_sources(spark, sf_dir):
    wanted = spark.sql("SELECT * FROM VALUES ('OFF1'), ('OFF2'), ('SAFE'), ('NBS') t(source)")
    return audit.required_present(vintages(spark, sf_dir), wanted, "source")


def validations(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id AS string) AS validation_id", "CASE WHEN event_id % 5 = 0 THEN 'OTHER' ELSE 'RTDSM' END AS source",
        "'vintage_cell_match' AS test_name", "cast(100 + event_id % 50 AS int) AS sample_size",
        "cast(event_id % 8 AS double) / 8 AS match_rate", "ts AS created_at", "concat('d', user_id) AS detail")


@query("qa_14_latest_validations", """
    WITH l AS (SELECT * FROM events WHERE event_id % 5 <> 0
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1)
    SELECT count(*) AS validations, coalesce(min(CAST(event_id % 8 AS DOUBLE) / 8), 0) AS min_match_rate,
        CAST(coalesce(sum(100 + event_id % 50), 0) AS BIGINT) AS samples FROM l""")
def latest_validations(spark, sf_dir):
    return audit.latest_validations(validations(spark, sf_dir), "RTDSM", "vintage_cell_match")


def check_list(spark, sf_dir):
    v = vintages(spark, sf_dir)
    defects = audit.row_defects(v)
    return audit.check_rows([
        audit.Check("duplicate observations", audit.duplicate_vintages(v), "value = 0"),
        audit.Check("release_at missing", defects.select("missing_release"), "value = 0"),
        audit.Check("revision rows", defects.select("revision_rows"), "value >= 0"),
        audit.Check("unit changes", audit.unit_changes(v).agg(F.count(F.lit(1)).alias("n")), "value = 0"),
        audit.Check("HTTP failures", audit.crawl_failures(crawl_log(spark, sf_dir)).select("http_failures"), "value = 0", "WARN"),
    ])


CHECKS = f"""{V}, {CRAWL},
    m AS (SELECT 'duplicate observations' AS name, CAST(coalesce(sum(n - 1), 0) AS DOUBLE) AS value, 'FAIL' AS otherwise
          FROM (SELECT count(*) AS n FROM v GROUP BY source, canonical_series_id, period, vintage_no HAVING count(*) > 1)
          UNION ALL SELECT 'release_at missing', CAST(count(*) FILTER (pit_grade IN ('A','B','C') AND release_at IS NULL) AS DOUBLE), 'FAIL' FROM v
          UNION ALL SELECT 'revision rows', CAST(count(*) FILTER (vintage_no > 0) AS DOUBLE), 'INFO' FROM v
          UNION ALL SELECT 'unit changes', CAST(count(*) AS DOUBLE), 'FAIL'
                    FROM (SELECT canonical_series_id FROM v GROUP BY 1 HAVING count(DISTINCT unit) > 1)
          UNION ALL SELECT 'HTTP failures', CAST(count(*) AS DOUBLE), 'WARN'
                    FROM (SELECT * FROM crawl QUALIFY row_number() OVER (PARTITION BY source, url ORDER BY completed_at DESC, crawl_id DESC) = 1)
                    WHERE NOT success AND NOT (http_status = 404 AND regexp_matches(url, '/robots\\.txt$'))),
    checks AS (SELECT name, value, CASE WHEN value = 0 OR otherwise = 'INFO' THEN 'PASS' ELSE otherwise END AS status FROM m)"""


@query("qa_15_check_rows", f"WITH {CHECKS} SELECT name, value, status FROM checks")
def check_rows(spark, sf_dir):
    return check_list(spark, sf_dir)


@query("qa_15_overall", f"""
    WITH {CHECKS} SELECT count(*) AS checks, count(*) FILTER (status = 'FAIL') AS failed, count(*) FILTER (status = 'WARN') AS warned,
        CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS overall FROM checks""")
def overall(spark, sf_dir):
    return audit.overall(check_list(spark, sf_dir))


@query("qa_17_cell_match", f"""
    WITH {V}, probe AS (SELECT *, available_at + to_hours(1) AS probe_at FROM v),
    hit AS (SELECT p.source, p.canonical_series_id, p.ingest_seq, p.value, x.value AS found
            FROM probe p LEFT JOIN v x ON x.source = p.source AND x.canonical_series_id = p.canonical_series_id
                                      AND x.period = p.period AND x.available_at <= p.probe_at
            QUALIFY row_number() OVER (PARTITION BY p.ingest_seq ORDER BY x.available_at DESC, x.vintage_no DESC,
                                       x.retrieved_at DESC, x.raw_sha256 DESC, x.value DESC) = 1)
    SELECT source, count(*) AS sample_size, count(*) FILTER (abs(value - found) <= 1e-9) AS matches,
        count(*) FILTER (abs(value - found) <= 1e-9) / count(*) AS match_rate FROM hit GROUP BY source""")
def cell_match(spark, sf_dir):
    v = vintages(spark, sf_dir)
    probes = v.select("source", "canonical_series_id", "period", "ingest_seq", "value",
                      F.expr("available_at + interval 1 hour").alias("probe_at"))
    found = asof.point_lookup(probes, v, ["source", "canonical_series_id", "period"])
    return audit.cell_match(found, ["source"])


@query("qa_17_sampled_cell_match", f"""
    WITH {V}, probe AS (SELECT *, available_at + to_hours(1) AS probe_at FROM v
                        QUALIFY row_number() OVER (PARTITION BY canonical_series_id ORDER BY md5('0|' || ingest_seq), ingest_seq) <= 20),
    hit AS (SELECT p.canonical_series_id, p.value, (
                SELECT arg_max(x.value, ROW(x.available_at, x.vintage_no, x.retrieved_at, x.raw_sha256, x.value)) FROM v x
                WHERE (x.source, x.canonical_series_id, x.period) = (p.source, p.canonical_series_id, p.period)
                  AND x.available_at <= p.probe_at) AS found FROM probe p)
    SELECT canonical_series_id, count(*) AS sample_size, count(*) FILTER (abs(value - found) <= 1e-9) AS matches,
        count(*) FILTER (abs(value - found) <= 1e-9) / count(*) AS match_rate FROM hit GROUP BY canonical_series_id""")
def sampled_cell_match(spark, sf_dir):
    v = vintages(spark, sf_dir)
    cells = v.select("source", "canonical_series_id", "period", "ingest_seq", "value",
                     F.expr("available_at + interval 1 hour").alias("probe_at"))
    found = asof.point_lookup(audit.sampled_cells(cells, ["canonical_series_id"], 20, ["ingest_seq"]), v,
                              ["source", "canonical_series_id", "period"])
    return audit.cell_match(found, ["canonical_series_id"])


@query("qa_18_source_grade_profile", f"""
    WITH {V} SELECT source, pit_grade, count(*) AS row_count, count(DISTINCT canonical_series_id) AS series_count,
        min(period) AS min_period, max(period) AS max_period FROM v WHERE country = 'CN' GROUP BY 1, 2""")
def source_grade_profile(spark, sf_dir):
    return audit.source_grade_profile(vintages(spark, sf_dir).where("country = 'CN'"))


@query("qa_19_series_profile", f"""
    WITH {V} SELECT canonical_series_id, count(*) AS row_count, count(DISTINCT period) AS period_count, min(period) AS first_period,
        max(period) AS last_period, count(DISTINCT source_series_id) AS code_count, min(first_seen_at) AS first_seen,
        max(first_seen_at) AS last_seen FROM v WHERE source = 'WIND' GROUP BY 1""")
def series_profile(spark, sf_dir):
    return audit.series_profile(vintages(spark, sf_dir).where("source = 'WIND'"))


@query("qa_20_grade_profile", f"""
    WITH {V} SELECT pit_grade, count(*) AS row_count, count(release_at) AS released_rows,
        count(*) FILTER (available_at < first_seen_at) AS backdated_rows FROM v GROUP BY 1""")
def grade_profile(spark, sf_dir):
    return audit.grade_profile(vintages(spark, sf_dir))


@query("qa_21_duplicate_signatures", f"""
    WITH {V} SELECT count(*) AS duplicate_signatures FROM (SELECT 1 FROM v
        GROUP BY source, canonical_series_id, period, value, available_at HAVING count(*) > 1)""")
def duplicate_signatures(spark, sf_dir):
    return audit.duplicate_signatures(vintages(spark, sf_dir))


@query("qa_21_multi_vintage_keys", f"""
    WITH {V} SELECT canonical_series_id, count(*) AS keys_with_multiple_vintages
    FROM (SELECT canonical_series_id, period FROM v WHERE source = 'WIND' GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""")
def multi_vintage_keys(spark, sf_dir):
    return audit.multi_vintage_keys(vintages(spark, sf_dir).where("source = 'WIND'"))


_LATEST = """SELECT canonical_series_id, period, value FROM v WHERE country = 'CN' AND {}
    QUALIFY row_number() OVER (PARTITION BY canonical_series_id, period ORDER BY available_at DESC, vintage_no DESC, retrieved_at DESC, raw_sha256 DESC, value DESC) = 1"""


@query("qa_22_reconciliation", f"""
    WITH {V}, a AS ({_LATEST.format("pit_grade = 'A'")}), b AS ({_LATEST.format("pit_grade = 'B'")}),
    w AS ({_LATEST.format("pit_grade = 'D' AND source = 'WIND' AND NOT starts_with(coalesce(release_date_source, ''), 'wind_revision_snapshot_')")}),
    o AS (SELECT 'A' AS pit_grade, * FROM a UNION ALL SELECT 'B', * FROM b)
    SELECT pit_grade, count(*) AS pairs, count(*) FILTER (abs(o.value - w.value) <= 1e-9) AS exact,
        count(*) FILTER (abs(o.value - w.value) > 1e-9) AS different, max(abs(o.value - w.value)) AS largest_gap
    FROM o JOIN w USING (canonical_series_id, period) GROUP BY pit_grade""")
def reconciliation(spark, sf_dir):
    return audit.reconciliation(vintages(spark, sf_dir))


_CUT = "2000-03-31 15:59:59.999999"
_SEL = selected_sql("ALL", _CUT, START, "2000-03-31")


@query("qa_23_gap_runs", f"""
    WITH {_SEL}, p AS (SELECT DISTINCT canonical_series_id, period_end FROM sel WHERE frequency = 'M'),
    span AS (SELECT canonical_series_id, min(period_end) AS a, max(period_end) AS b FROM p GROUP BY 1),
    spine AS (SELECT canonical_series_id, last_day(CAST(unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH)) AS DATE)) AS m FROM span),
    miss AS (SELECT s.*, year(m) * 12 + month(m) - row_number() OVER (PARTITION BY canonical_series_id ORDER BY m) AS isle
             FROM spine s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.canonical_series_id = s.canonical_series_id AND p.period_end = s.m))
    SELECT canonical_series_id, strftime(min(m), '%Y-%m') AS first_missing, strftime(max(m), '%Y-%m') AS last_missing,
        count(*) AS months, count(*) FILTER (month(m) <= 2) AS january_february FROM miss GROUP BY canonical_series_id, isle""")
def gap_runs(spark, sf_dir):
    return audit.gap_runs(select_at(spark, sf_dir, "ALL", "2000-03-31", START, "2000-03-31"))


@query("qa_24_constant_runs", f"""
    WITH {_SEL}, m AS (SELECT canonical_series_id, period, value, year(period_end) * 12 + month(period_end) AS mi FROM sel WHERE frequency = 'M'),
    f AS (SELECT *, CASE WHEN lag(mi) OVER k = mi - 1 AND lag(value) OVER k = value THEN 0 ELSE 1 END AS s FROM m
          WINDOW k AS (PARTITION BY canonical_series_id ORDER BY mi)),
    r AS (SELECT *, sum(s) OVER (PARTITION BY canonical_series_id ORDER BY mi ROWS UNBOUNDED PRECEDING) AS run FROM f)
    SELECT canonical_series_id, min(period) AS first_period, max(period) AS last_period, count(*) AS months, min(value) AS value
    FROM r GROUP BY canonical_series_id, run HAVING count(*) >= 2""")
def constant_runs(spark, sf_dir):
    return audit.constant_runs(select_at(spark, sf_dir, "ALL", "2000-03-31", START, "2000-03-31"), 2)


@query("qa_25_selected_invariants", f"""
    WITH {_SEL} SELECT count(*) AS rows, count(*) - count(DISTINCT (country, canonical_series_id, period)) AS duplicates,
        count(*) FILTER (available_at > TIMESTAMP '{_CUT}') AS not_yet_available,
        count(*) FILTER (selection_origin IN ('WIND', 'SAFE_ESTIMATED_D') AND EXISTS (SELECT 1 FROM v o WHERE o.country = sel.country
            AND o.canonical_series_id = sel.canonical_series_id AND o.period = sel.period AND o.pit_grade IN ('A', 'B'))) AS gap_rows_beside_official
    FROM sel""")
def selected_invariants(spark, sf_dir):
    v = vintages(spark, sf_dir)
    return audit.selected_invariants(select_at(spark, sf_dir, "ALL", "2000-03-31", START, "2000-03-31"), v,
                                     instant(v, "available_at", "2000-03-31 15:59:59.999999+00:00"))


@query("qa_32_day_status", f"""
    WITH {CRAWL} SELECT CAST(completed_at + to_hours(8) AS DATE) AS day, count(*) AS runs, count(DISTINCT source) AS sources,
        CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' WHEN bool_or(status = 'PARTIAL') THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
    FROM crawl GROUP BY 1""")
def day_status(spark, sf_dir):
    return inventory.day_status(crawl_log(spark, sf_dir))
