"""Sinks that merge, receipts, compaction and the day-wise status counts."""

from pyspark.sql import functions as F

from ..operators import ingest, maintenance, text
from ..sources import sinks, store
from ..streaming import incremental
from . import query
from .audits import CRAWL, crawl_log
from .fixture import V, table, vintages
from .ingest import SPLIT, split
from .intervals import EVENTS, events
from .reading import candidate_rows


@query("snk_04_receipt", f"""
    WITH {EVENTS} SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT country, canonical_series_id FROM events)) AS fields,
        count(*) FILTER (valid_to IS NULL) AS open_rows, min(valid_from) AS first_valid_from, max(valid_from) AS last_valid_from, 'ALL' AS scope FROM events""")
def receipt(spark, sf_dir):
    return sinks.receipt(events(spark, sf_dir), scope="ALL")


@query("snk_05_candidate_merge", """
    WITH c AS (SELECT 'http://example.com/' || user_id || '/' || event_type AS url, event_type AS kind,
        CASE WHEN event_id % 10 <> 0 THEN strftime(CAST(ts AS DATE) - to_months(CAST(event_id % 30 AS INTEGER)), '%Y-%m') END AS period,
        CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END AS age FROM events)
    SELECT url, period FROM c QUALIFY row_number() OVER (PARTITION BY url ORDER BY age DESC, period DESC NULLS LAST) = 1""")
def candidate_merge(spark, sf_dir):
    rows = candidate_rows(spark, sf_dir)
    dated = table(spark, sf_dir, "events").selectExpr(
        "concat('http://example.com/', user_id, '/', event_type) AS url",
        "CASE WHEN event_id % 10 <> 0 THEN date_format(add_months(ts, cast(-(event_id % 30) AS int)), 'yyyy-MM') END AS period", "ts")
    early, late = "ts < timestamp_ntz'2024-01-15 00:00:00'", "ts >= timestamp_ntz'2024-01-15 00:00:00'"
    return text.merge_candidates(dated.where(early).select(*rows.columns), dated.where(late).select(*rows.columns))


@query("snk_06_keyed_replace", f"""
    WITH {V}, b AS (SELECT *, row_number() OVER (PARTITION BY priority IN ('1-URGENT', '2-HIGH'), source, canonical_series_id, period ORDER BY ingest_seq DESC) AS rn,
                           priority IN ('1-URGENT', '2-HIGH') AS old FROM v),
    k AS (SELECT * FROM b WHERE rn = 1)
    SELECT source, canonical_series_id, period, value, ingest_seq FROM k WHERE NOT old
    UNION ALL SELECT source, canonical_series_id, period, value, ingest_seq FROM k o WHERE old AND NOT EXISTS (
        SELECT 1 FROM k n WHERE NOT n.old AND n.source = o.source AND n.canonical_series_id = o.canonical_series_id AND n.period = o.period)""")
def keyed_replace(spark, sf_dir):
    from ..operators.transforms import last_in_batch
    key = ["source", "canonical_series_id", "period"]
    new, old = (last_in_batch(f).select(*key, "value", "ingest_seq") for f in split(spark, sf_dir))
    return store.replace_keyed(old, new, key)


@query("snk_08_new_crawl_events", """
    SELECT CAST(event_id AS VARCHAR) AS crawl_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-20'""")
def new_crawl_events(spark, sf_dir):
    log = table(spark, sf_dir, "events").selectExpr("cast(event_id AS string) AS crawl_id", "event_type", "value", "ts")
    known = log.where("ts < timestamp_ntz'2024-01-20 00:00:00'")
    twice = log.unionByName(log)
    return store.new_crawl_events(known, twice).select("crawl_id", "event_type", "value")


COMPACT = f"""{V},
    o AS (SELECT *, lag(value) OVER w AS pv, lag(pit_grade) OVER w AS pg, lag(unit) OVER w AS pu, lag(frequency) OVER w AS pf, row_number() OVER w AS n
          FROM v WINDOW w AS (PARTITION BY source, canonical_series_id, period ORDER BY available_at, vintage_no, retrieved_at, raw_sha256, value)),
    c AS (SELECT * FROM o WHERE n = 1 OR abs(value - pv) > 1e-12 OR pit_grade <> pg OR unit <> pu OR frequency <> pf),
    r AS (SELECT *, row_number() OVER w - 1 AS new_no, lag(value) OVER w AS kept FROM c
          WINDOW w AS (PARTITION BY source, canonical_series_id, period ORDER BY available_at, vintage_no, retrieved_at, raw_sha256, value)),
    compacted AS (SELECT ingest_seq, source, canonical_series_id, period, value, CAST(new_no AS INTEGER) AS vintage_no,
        CASE WHEN new_no = 0 THEN 'initial' WHEN abs(value - kept) <= 1e-12 THEN 'metadata_update' ELSE 'revision' END AS revision_type,
        CASE WHEN new_no > 0 THEN value - kept END AS revision_delta FROM r)"""


@query("mnt_01_compaction", f"WITH {COMPACT} SELECT * FROM compacted")
def compaction(spark, sf_dir):
    return maintenance.compacted(vintages(spark, sf_dir)).select(
        "ingest_seq", "source", "canonical_series_id", "period", "value", "vintage_no", "revision_type", "revision_delta")


@query("mnt_02_without_sources", f"""
    WITH {V} SELECT ingest_seq, source FROM v WHERE upper(source) NOT IN ('WIND', 'SINA_MACRO')""")
def without_sources(spark, sf_dir):
    return store.without_sources(vintages(spark, sf_dir), ["wind", "Sina_Macro"]).select("ingest_seq", "source")


@query("mnt_03_reconciliation", f"""
    WITH {COMPACT} SELECT (SELECT count(*) FROM v) AS source_rows, count(*) AS target_rows, (SELECT count(*) FROM v) - count(*) AS removed_rows FROM compacted""")
def reconciliation(spark, sf_dir):
    v = vintages(spark, sf_dir)
    return maintenance.reconciliation(v, maintenance.compacted(v))


@query("str_04_daily_status", f"""
    WITH {CRAWL} SELECT date_trunc('day', completed_at)::TIMESTAMP AS day_start, source, count(*) AS attempts,
        count(*) FILTER (NOT success) AS failures, count(*) FILTER (error_type LIKE '%Parser%') AS parse_failures FROM crawl GROUP BY 1, 2""")
def daily_status(spark, sf_dir):
    return incremental.daily_status(crawl_log(spark, sf_dir))




@query("str_02_signature_dedup", f"""
    WITH {SPLIT} SELECT DISTINCT source, canonical_series_id, period, value, pit_grade, unit, frequency, sig_release AS sig_release_at,
        sig_available AS sig_available_at, sig_marker AS sig_release_date_source FROM sig""")
def signature_dedup(spark, sf_dir):
    # the batch twin of dropDuplicatesWithinWatermark over the same columns
    return ingest.with_signature(vintages(spark, sf_dir)).select(*ingest.SIGNATURE).dropDuplicates(ingest.SIGNATURE)


@query("str_03_value_changes", f"""
    WITH {SPLIT} SELECT b.ingest_seq, l.value AS known_value, b.value FROM batch b JOIN last l
      ON l.source = b.source AND l.canonical_series_id = b.canonical_series_id AND l.period = b.period
    WHERE l.source_url = b.source_url AND abs(l.value - b.value) > 1e-12""")
def value_changes(spark, sf_dir):
    batch, history = split(spark, sf_dir)
    return incremental.value_changes(batch, history).select("ingest_seq", "known_value", "value")


@query("str_05_bounded_recheck", f"""
    WITH {V} SELECT source, count(*) AS rows FROM v WHERE period_start >= DATE '2000-06-01' GROUP BY source""")
def bounded_recheck(spark, sf_dir):
    return incremental.recheck(vintages(spark, sf_dir), "2001-06-15", 12).groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
