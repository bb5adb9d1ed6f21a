"""Versioned append: urgent orders are the history, the rest are the delivery."""

from pyspark.sql import functions as F

from ..operators import contracts, ingest
from . import query
from .fixture import REGISTRY, V, registry, vintages

URGENT = ["1-URGENT", "2-HIGH"]


def split(spark, sf_dir):
    v = vintages(spark, sf_dir)
    return v.where(~F.col("priority").isin(*URGENT)), v.where(F.col("priority").isin(*URGENT))


SIG = "source, canonical_series_id, period, value, pit_grade, unit, frequency, sig_release, sig_available, sig_marker"
SPLIT = f"""
    {V},
    sig AS (SELECT *,
        CASE WHEN pit_grade = 'D' AND NOT starts_with(coalesce(release_date_source, ''), 'wind_revision_snapshot_')
             THEN NULL ELSE release_at END AS sig_release,
        CASE WHEN pit_grade = 'D' AND NOT starts_with(coalesce(release_date_source, ''), 'wind_revision_snapshot_')
             THEN NULL ELSE available_at END AS sig_available,
        CASE WHEN pit_grade = 'D' AND NOT starts_with(coalesce(release_date_source, ''), 'wind_revision_snapshot_')
             THEN NULL ELSE release_date_source END AS sig_marker FROM v),
    hist AS (SELECT * FROM sig WHERE priority IN ('1-URGENT', '2-HIGH')),
    batch AS (SELECT * FROM sig WHERE priority NOT IN ('1-URGENT', '2-HIGH')),
    fresh AS (SELECT * FROM batch b
              WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE {' AND '.join(
                  f'h.{c.strip()} IS NOT DISTINCT FROM b.{c.strip()}' for c in SIG.split(','))})
              QUALIFY row_number() OVER (PARTITION BY {SIG} ORDER BY available_at, ingest_seq) = 1),
    last AS (SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY source, canonical_series_id, period
                     ORDER BY vintage_no DESC, available_at DESC, retrieved_at DESC, raw_sha256 DESC, value DESC) = 1),
    numbered AS (SELECT f.* EXCLUDE (vintage_no, revision_type, revision_delta),
                        f.revision_type AS given_type, f.revision_delta AS given_delta,
                        coalesce(lag(f.value) OVER k, l.value) AS previous,
                        CAST(coalesce(l.vintage_no + 1, 0) + row_number() OVER k - 1 AS INTEGER) AS vintage_no
                 FROM fresh f LEFT JOIN last l USING (source, canonical_series_id, period)
                 WINDOW k AS (PARTITION BY f.source, f.canonical_series_id, f.period ORDER BY f.available_at, f.ingest_seq)),
    flagged AS (SELECT *, pit_grade = 'D' AND starts_with(coalesce(release_date_source, ''), 'wind_revision_snapshot_')
                          AND given_type = 'revision' AND given_delta IS NOT NULL AS supplied FROM numbered),
    versioned AS (SELECT *, CASE WHEN vintage_no = 0 THEN 'initial' WHEN supplied THEN 'revision'
                                 WHEN abs(value - previous) <= 1e-12 THEN 'metadata_update' ELSE 'revision' END AS revision_type,
                  CASE WHEN vintage_no = 0 THEN NULL WHEN supplied THEN given_delta
                       WHEN abs(value - previous) <= 1e-12 THEN 0.0 ELSE value - previous END AS revision_delta,
                  CASE WHEN vintage_no <> 0 AND supplied AND (NOT isfinite(given_delta) OR abs(given_delta) <= 1e-12)
                       THEN 'documented_revision_needs_non_zero_delta' END AS reject_reason FROM flagged)
"""


@query("ing_01_signature", f"WITH {SPLIT} SELECT ingest_seq, sig_release, sig_available, sig_marker FROM sig")
def signature(spark, sf_dir):
    return ingest.with_signature(vintages(spark, sf_dir)).select(
        "ingest_seq", F.col("sig_release_at").alias("sig_release"), F.col("sig_available_at").alias("sig_available"),
        F.col("sig_release_date_source").alias("sig_marker"))


@query("ing_02_idempotent_dedup", f"WITH {SPLIT} SELECT ingest_seq, source, canonical_series_id, period, value FROM fresh")
def idempotent_dedup(spark, sf_dir):
    batch, history = split(spark, sf_dir)
    return ingest.new_rows(batch, history).select("ingest_seq", "source", "canonical_series_id", "period", "value")


@query("ing_03_vintage_numbers", f"WITH {SPLIT} SELECT ingest_seq, vintage_no FROM versioned")
def vintage_numbers(spark, sf_dir):
    return ingest.versioned(*split(spark, sf_dir)).select("ingest_seq", "vintage_no")


@query("ing_04_classification", f"""
    WITH {SPLIT} SELECT ingest_seq, vintage_no, value, revision_type, revision_delta FROM versioned""")
def classification(spark, sf_dir):
    return ingest.versioned(*split(spark, sf_dir)).select(
        "ingest_seq", "vintage_no", "value", "revision_type", "revision_delta")


@query("ing_05_documented_revisions", f"""
    WITH {SPLIT} SELECT ingest_seq, vintage_no, revision_type, revision_delta, reject_reason FROM versioned
    WHERE release_date_source = 'wind_revision_snapshot_x'""")
def documented_revisions(spark, sf_dir):
    return ingest.versioned(*split(spark, sf_dir)).where("release_date_source = 'wind_revision_snapshot_x'").select(
        "ingest_seq", "vintage_no", "revision_type", "revision_delta", "reject_reason")


@query("ing_06_statistics", f"""
    WITH {SPLIT} SELECT count(*) AS inserted, count(*) FILTER (revision_type = 'revision') AS revisions,
        count(*) FILTER (revision_type = 'metadata_update') AS metadata_updates,
        (SELECT count(*) FROM batch) - count(*) AS unchanged FROM versioned""")
def statistics(spark, sf_dir):
    batch, history = split(spark, sf_dir)
    return ingest.statistics(batch, ingest.versioned(batch, history))


_LATEST = "l.source = b.source AND l.canonical_series_id = b.canonical_series_id AND l.period = b.period"


@query("ing_07_first_seen_revisions", f"""
    WITH {SPLIT}, m AS (SELECT b.*, l.source_url = b.source_url AND abs(l.value - b.value) > 1e-12 AS changed
                        FROM batch b LEFT JOIN last l ON {_LATEST})
    SELECT ingest_seq, CASE WHEN changed THEN NULL ELSE release_at END AS release_at,
           CASE WHEN changed THEN first_seen_at ELSE available_at END AS available_at,
           CASE WHEN changed THEN 'D' ELSE pit_grade END AS pit_grade,
           CASE WHEN changed THEN 'official_web_revision_first_seen' ELSE release_date_source END AS release_date_source
    FROM m""")
def first_seen_revisions(spark, sf_dir):
    return ingest.mark_first_seen_revisions(*split(spark, sf_dir)).select(
        "ingest_seq", "release_at", "available_at", "pit_grade", "release_date_source")


@query("ing_08_stabilized_snapshots", f"""
    WITH {SPLIT}, m AS (SELECT b.*, coalesce(abs(l.value - b.value) <= 1e-12, FALSE) AS same,
                               l.release_at AS lr, l.first_seen_at AS lf, l.available_at AS la, l.release_date_source AS lm
                        FROM batch b LEFT JOIN last l ON {_LATEST})
    SELECT ingest_seq, CASE WHEN same THEN lr ELSE release_at END AS release_at,
           CASE WHEN same THEN lf ELSE first_seen_at END AS first_seen_at,
           CASE WHEN same THEN la ELSE available_at END AS available_at,
           CASE WHEN same THEN lm ELSE release_date_source END AS release_date_source FROM m""")
def stabilized_snapshots(spark, sf_dir):
    return ingest.stabilize_snapshots(*split(spark, sf_dir)).select(
        "ingest_seq", "release_at", "first_seen_at", "available_at", "release_date_source")


@query("ing_09_revision_anomalies", f"""
    WITH {SPLIT}, l AS (SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY source, canonical_series_id, period
                     ORDER BY available_at DESC, vintage_no DESC, retrieved_at DESC, raw_sha256 DESC, value DESC) = 1)
    SELECT b.ingest_seq, b.value, CASE WHEN l.source_url <> b.source_url AND abs(l.value - b.value) > 1e-12 THEN
             CASE WHEN b.source_url = 'u2' AND l.source_url = 'u1' THEN 'secondary_conflicts_with_primary'
                  WHEN b.unit IN ('pct', 'pct_yoy') AND abs(l.value - b.value) > 2 THEN 'large_change' END END AS anomaly
    FROM batch b LEFT JOIN l ON {_LATEST}""")
def revision_anomalies(spark, sf_dir):
    return ingest.revision_anomalies(*split(spark, sf_dir), secondary="u2", primary="u1", large=2.0).select(
        "ingest_seq", "value", "anomaly")


@query("ing_20_last_in_batch", f"""
    WITH {V} SELECT source, canonical_series_id, period, value, ingest_seq FROM v
    QUALIFY row_number() OVER (PARTITION BY source, canonical_series_id, period ORDER BY ingest_seq DESC) = 1""")
def last_in_batch(spark, sf_dir):
    from ..operators.transforms import last_in_batch
    return last_in_batch(vintages(spark, sf_dir)).select("source", "canonical_series_id", "period", "value", "ingest_seq")


def listing(spark, sf_dir):
    """A revision snapshot: previous and revised value with a date, blank where not revised."""
    return vintages(spark, sf_dir).where("source = 'WIND'").select(
        "ingest_seq", "canonical_series_id", "source", "period", F.col("value").alias("previous_value"),
        F.expr("CASE WHEN ingest_seq % 3 <> 0 THEN value + cast(ingest_seq % 4 AS double) / 2 END").alias("revised_value"),
        F.expr("date_add(period_end, cast(60 + ingest_seq % 30 AS int))").alias("revision_date"))


LISTING = f"""{V}, listing AS (SELECT ingest_seq, canonical_series_id, source, period, value AS previous_value,
    CASE WHEN ingest_seq % 3 <> 0 THEN value + CAST(ingest_seq % 4 AS DOUBLE) / 2 END AS revised_value,
    period_end + CAST(60 + ingest_seq % 30 AS INTEGER) AS revision_date FROM v WHERE source = 'WIND')"""


@query("ing_22_dated_revision_events", f"""
    WITH {LISTING} SELECT ingest_seq, revised_value AS value, CAST(revision_date AS TIMESTAMP) - to_hours(8) AS available_at,
        'wind_revision_snapshot_gdp_' || strftime(revision_date, '%Y%m%d') AS release_date_source,
        revised_value - previous_value AS revision_delta,
        CASE WHEN revised_value = previous_value THEN 'unchanged_revision' END AS reject_reason
    FROM listing WHERE revised_value IS NOT NULL""")
def dated_revision_events(spark, sf_dir):
    return ingest.dated_revisions(listing(spark, sf_dir), "gdp").select(
        "ingest_seq", "value", "available_at", "release_date_source", "revision_delta", "reject_reason")


@query("ing_23_pre_revision_overrides", f"""
    WITH {LISTING} SELECT canonical_series_id, source, period, previous_value AS pre_revision_value,
        CAST(revision_date AS TIMESTAMP) - to_hours(8) AS revision_at FROM listing WHERE revised_value IS NOT NULL""")
def pre_revision_overrides(spark, sf_dir):
    return ingest.pre_revision_overrides(listing(spark, sf_dir))


@query("ing_24_missing_months", f"""
    WITH {V}, {REGISTRY}, wanted AS (SELECT canonical_series_id, CAST(y AS INTEGER) AS year FROM registry, range(1994, 2003) t(y) WHERE frequency = 'M'),
    m AS (SELECT canonical_series_id, CAST(year(period_end) AS INTEGER) AS year, list(DISTINCT month(period_end)) AS months
          FROM v WHERE frequency = 'M' GROUP BY ALL)
    SELECT canonical_series_id, year, coalesce(len(months), 0)::BIGINT AS present,
           (SELECT string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FROM range(1, 13) r(i) WHERE NOT coalesce(list_contains(months, i), false)) AS missing
    FROM wanted FULL JOIN m USING (canonical_series_id, year) WHERE coalesce(len(months), 0) < 12""")
def missing_months(spark, sf_dir):
    # the registry has two series that hold no data, and no order lies in the first and last years
    wanted = registry(spark).where("frequency = 'M'").select(
        "canonical_series_id", F.explode(F.sequence(F.lit(1994), F.lit(2002))).alias("year"))
    return contracts.missing_periods(vintages(spark, sf_dir), expected=wanted)


@query("ing_26_duplicate_keys", f"""
    WITH {V} SELECT source, canonical_series_id, period, count(*) AS rows FROM v GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return contracts.duplicate_keys(vintages(spark, sf_dir), ["source", "canonical_series_id", "period"])
