"""Lag calibration and estimated availability."""

from pyspark.sql import functions as F

from ..operators import estimate, ingest
from . import query
from .fixture import RULES, V, rules, vintages
from .ingest import LISTING, listing

RELEASES = f"""{V},
    firsts AS (SELECT canonical_series_id, source, frequency, period, period_end, release_at AS first_release_at,
                      pit_grade AS first_grade, CAST(release_at + to_hours(8) AS DATE) AS first_release_date
               FROM v WHERE country = 'CN' AND pit_grade IN ('A', 'B') AND release_at IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY canonical_series_id, source, frequency, period, period_end
                                          ORDER BY release_at, pit_grade) = 1),
    lags AS (SELECT *, CAST(date_diff('day', period_end, first_release_date) AS INTEGER) AS lag_days,
                    CAST(day(first_release_date) AS INTEGER) AS release_day_of_month FROM firsts)
"""


@query("est_01_first_release", f"""
    WITH {RELEASES} SELECT canonical_series_id, source, period, first_release_at, first_grade FROM lags""")
def first_release(spark, sf_dir):
    return estimate.first_releases(vintages(spark, sf_dir)).select(
        "canonical_series_id", "source", "period", "first_release_at", "first_grade")


@query("est_02_lag_days", f"""
    WITH {RELEASES} SELECT canonical_series_id, source, period, first_release_date, lag_days, release_day_of_month FROM lags""")
def lag_days(spark, sf_dir):
    return estimate.first_releases(vintages(spark, sf_dir)).select(
        "canonical_series_id", "source", "period", "first_release_date", "lag_days", "release_day_of_month")


@query("est_03_lag_statistics", f"""
    WITH {RELEASES}, s AS (SELECT canonical_series_id, list_sort(list(lag_days)) AS l, list_sort(list(release_day_of_month)) AS m,
        count(*) AS n_periods, min(lag_days) AS min_lag, max(lag_days) AS max_lag, round(stddev_samp(lag_days), 6) AS std_lag,
        min(period) AS first_period, max(period) AS last_period FROM lags GROUP BY canonical_series_id)
    SELECT canonical_series_id, n_periods, min_lag, max_lag, std_lag, first_period, last_period,
        CAST(l[CAST(round(0.1 * (n_periods - 1)) AS BIGINT) + 1] AS DOUBLE) AS p10_lag,
        CAST(l[CAST(round(0.9 * (n_periods - 1)) AS BIGINT) + 1] AS DOUBLE) AS p90_lag,
        CAST(list_aggregate(l, 'median') AS DOUBLE) AS median_lag,
        CAST(list_aggregate(m, 'median') AS DOUBLE) AS median_day_of_month FROM s""")
def lag_statistics(spark, sf_dir):
    return estimate.lag_statistics(estimate.first_releases(vintages(spark, sf_dir)))


ESTIMATES = f"""{LISTING}, {RULES},
    drows AS (SELECT * FROM v WHERE country = 'CN' AND pit_grade = 'D'
                AND NOT starts_with(coalesce(release_date_source, ''), 'wind_revision_snapshot_')),
    est AS (SELECT d.*, r.confidence AS rule_confidence, CAST(d.period_end + r.lag_days AS DATE) AS estimated_release_date,
                   CASE WHEN r.available_same_day THEN CAST(d.period_end AS TIMESTAMP) + to_hours(1) + to_minutes(30)
                        ELSE CAST(d.period_end + r.lag_days + 1 AS TIMESTAMP) - to_hours(8) END AS estimated_available_at
            FROM drows d JOIN rules r USING (canonical_series_id) WHERE r.eligible),
    anchors AS (SELECT canonical_series_id, source, period, CASE WHEN k % 30 = 0 THEN value + 1 ELSE value END AS value,
                       strftime(CASE WHEN k % 35 = 0 THEN period_end - 3 ELSE period_end + 20 END, '%Y-%m-%d') || 'T09:30:00'
                       || CASE WHEN k % 50 = 0 THEN '+00:00' ELSE '+08:00' END AS available_at
                FROM (SELECT *, ingest_seq AS k FROM v WHERE country = 'CN' AND source = 'WIND'
                      QUALIFY row_number() OVER (PARTITION BY canonical_series_id, source, period ORDER BY ingest_seq) = 1) f)
"""


def anchors(spark, sf_dir):
    """Reviewed instants for vendor periods, a few of them contradictory on purpose."""
    from ..functions.ordered import oldest, top_row
    first = top_row(vintages(spark, sf_dir).where("country = 'CN' AND source = 'WIND'"),
                    ["canonical_series_id", "source", "period"], oldest("ingest_seq"))
    return first.selectExpr(
        "canonical_series_id", "source", "period", "CASE WHEN ingest_seq % 30 = 0 THEN value + 1 ELSE value END AS value",
        "concat(date_format(date_add(period_end, CASE WHEN ingest_seq % 35 = 0 THEN -3 ELSE 20 END), 'yyyy-MM-dd'), "
        "'T09:30:00', CASE WHEN ingest_seq % 50 = 0 THEN '+00:00' ELSE '+08:00' END) AS available_at")


def estimates(spark, sf_dir):
    return estimate.estimated_availability(vintages(spark, sf_dir), rules(spark))


@query("est_04_estimated_availability", f"""
    WITH {ESTIMATES} SELECT ingest_seq, estimated_release_date, estimated_available_at, rule_confidence FROM est""")
def estimated(spark, sf_dir):
    return estimates(spark, sf_dir).select(
        "ingest_seq", "estimated_release_date", "estimated_available_at", "rule_confidence")


@query("est_05_skipped", f"""
    WITH {ESTIMATES}, r AS (SELECT CASE WHEN starts_with(coalesce(release_date_source, ''), 'wind_revision_snapshot_')
                                        THEN 'DOCUMENTED_WIND_REVISIONS'
                                        WHEN canonical_series_id NOT IN (SELECT canonical_series_id FROM rules WHERE eligible)
                                        THEN canonical_series_id END AS reason
                            FROM v WHERE country = 'CN' AND pit_grade = 'D')
    SELECT reason, count(*) AS rows FROM r WHERE reason IS NOT NULL GROUP BY reason""")
def skipped(spark, sf_dir):
    return estimate.skipped(vintages(spark, sf_dir), rules(spark))


@query("est_06_overrides", f"""
    WITH {ESTIMATES}, j AS (SELECT e.*, a.value AS av, a.available_at AS txt,
            CAST(substr(a.available_at, 1, 19) AS TIMESTAMP) - CASE WHEN a.available_at LIKE '%+08:00' THEN to_hours(8) ELSE to_hours(0) END AS a_at
        FROM est e LEFT JOIN anchors a ON a.canonical_series_id = e.canonical_series_id AND a.source = e.source AND a.period = e.period)
    SELECT ingest_seq, CASE WHEN abs(value - av) > 1e-9 THEN 'value_mismatch' WHEN NOT ends_with(txt, '+08:00') THEN 'not_local_offset'
             WHEN CAST(a_at + to_hours(8) AS DATE) <= period_end THEN 'precedes_period' END AS override_error,
           coalesce(a_at, estimated_available_at) AS estimated_available_at,
           coalesce(CAST(a_at + to_hours(8) AS DATE), estimated_release_date) AS estimated_release_date,
           CASE WHEN txt IS NULL THEN 'estimated' ELSE 'official_dated_wind_value' END AS availability_method,
           CASE WHEN txt IS NULL THEN rule_confidence ELSE 'high' END AS rule_confidence FROM j""")
def overrides(spark, sf_dir):
    return estimate.with_overrides(estimates(spark, sf_dir), anchors(spark, sf_dir)).select(
        "ingest_seq", "override_error", "estimated_available_at", "estimated_release_date", "availability_method",
        "rule_confidence")


@query("est_06_unused_overrides", f"""
    WITH {ESTIMATES} SELECT canonical_series_id, source, period, value, available_at FROM anchors a
    WHERE NOT EXISTS (SELECT 1 FROM est e WHERE e.canonical_series_id = a.canonical_series_id AND e.source = a.source AND e.period = a.period)""")
def unused_overrides(spark, sf_dir):
    return estimate.unused_overrides(estimates(spark, sf_dir), anchors(spark, sf_dir))


@query("est_07_pre_revision_values", f"""
    WITH {ESTIMATES}, pre AS (SELECT canonical_series_id, source, period, previous_value,
             CAST(revision_date AS TIMESTAMP) - to_hours(8) AS revision_at FROM listing WHERE revised_value IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY canonical_series_id, source, period ORDER BY revision_at, previous_value) = 1)
    SELECT e.ingest_seq, CASE WHEN e.estimated_available_at < p.revision_at THEN p.previous_value ELSE e.value END AS value,
           CASE WHEN e.estimated_available_at < p.revision_at THEN 'pre_revision_snapshot' ELSE 'latest_snapshot' END AS vintage_status
    FROM est e LEFT JOIN pre p USING (canonical_series_id, source, period)""")
def pre_revision_values(spark, sf_dir):
    return estimate.with_pre_revision_values(
        estimates(spark, sf_dir), ingest.pre_revision_overrides(listing(spark, sf_dir))
    ).select("ingest_seq", "value", "vintage_status")


@query("est_08_coverage", f"""
    WITH {ESTIMATES} SELECT canonical_series_id, source, rule_confidence, count(*) AS n_records, min(period) AS first_period,
           max(period) AS last_period FROM est GROUP BY ALL""")
def coverage(spark, sf_dir):
    return estimate.coverage(estimates(spark, sf_dir))


@query("src_04_duplicate_overrides", f"""
    WITH {V} SELECT canonical_series_id, source, period, count(*) AS rows FROM v
    GROUP BY ALL HAVING count(*) > 1""")
def duplicate_overrides(spark, sf_dir):
    return estimate.duplicate_overrides(vintages(spark, sf_dir))
