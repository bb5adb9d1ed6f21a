"""Field inventories and review lists."""

from pyspark.sql import functions as F

from ..operators import inventory
from . import query
from .fixture import V, vintages

NOW = "1999-06-30 23:59:59+00:00"
_NOW = "TIMESTAMP '1999-06-30 23:59:59'"
ORDER = ["OFF2", "SAFE", "OFF1", "WIND", "IMF"]

INVENTORY = f"""{V},
    r AS (SELECT *, available_at <= {_NOW} AS seen,
                 CASE source {' '.join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(ORDER))} ELSE {len(ORDER)} END AS rnk
          FROM v WHERE country = 'CN'),
    inv AS (SELECT canonical_series_id, min(period) FILTER (seen) AS start_period, max(period) FILTER (seen) AS visible_last_period,
                 count(DISTINCT period) FILTER (seen) AS visible_periods, max(period) AS database_latest_period,
                 min(frequency) AS frequency, count(DISTINCT frequency) AS frequencies, min(unit) AS unit,
                 count(DISTINCT unit) AS units, string_agg(DISTINCT source, ',' ORDER BY source) AS record_sources
          FROM r GROUP BY 1 HAVING count(*) FILTER (seen) > 0),
    owner AS (SELECT canonical_series_id, source AS update_owner FROM r
              QUALIFY row_number() OVER (PARTITION BY canonical_series_id ORDER BY rnk, source) = 1),
    fresh AS (SELECT r.canonical_series_id, string_agg(DISTINCT source, ',' ORDER BY source) AS latest_period_sources
              FROM r JOIN inv ON inv.canonical_series_id = r.canonical_series_id AND inv.visible_last_period = r.period
              WHERE seen GROUP BY 1),
    inventory AS (SELECT * FROM inv JOIN owner USING (canonical_series_id) JOIN fresh USING (canonical_series_id))
"""


def fields_now(spark, sf_dir):
    return inventory.field_inventory(vintages(spark, sf_dir), NOW, ORDER)


@query("qa_26_field_inventory", f"WITH {INVENTORY} SELECT * FROM inventory")
def field_inventory(spark, sf_dir):
    return fields_now(spark, sf_dir)


ZONES = {"OFF1": "Europe/Paris", "OFF2": "America/New_York"}


@query("qa_27_disclosure", f"""
    WITH {V}, r AS (SELECT *, source = 'IMF' AS guessed FROM v WHERE CASE WHEN source = 'IMF'
                    THEN CAST(period_end + 41 AS TIMESTAMP) - to_hours(8) <= {_NOW} ELSE available_at <= {_NOW} END),
    p AS (SELECT canonical_series_id, country, source, period, any_value(period_end) AS period_end, min(release_at) AS rel, min(available_at) AS av,
                 any_value(guessed) AS guessed FROM r GROUP BY 1, 2, 3, 4),
    mark AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY canonical_series_id, country, source, period ORDER BY available_at, raw_sha256, release_date_source) = 1),
    s AS (SELECT *, min(period) OVER k AS first_period, count(*) OVER k AS visible_periods, row_number() OVER (PARTITION BY canonical_series_id, country, source ORDER BY period DESC) AS rn,
                 CASE source WHEN 'OFF1' THEN 'Europe/Paris' WHEN 'OFF2' THEN 'America/New_York' ELSE 'Asia/Shanghai' END AS zone
          FROM p WINDOW k AS (PARTITION BY canonical_series_id, country, source))
    SELECT s.canonical_series_id, s.country, s.source, first_period, s.period AS last_period, visible_periods,
        CASE WHEN s.guessed THEN CAST(s.period_end + 40 AS DATE) ELSE CAST(timezone(zone, timezone('UTC', rel)) AS DATE) END AS first_release_date,
        CASE WHEN s.guessed THEN CAST(s.period_end + 41 AS DATE) ELSE CAST(timezone(zone, timezone('UTC', av)) AS DATE) END AS first_available_date,
        mark.release_date_source
    FROM s JOIN mark ON mark.canonical_series_id = s.canonical_series_id AND mark.country = s.country AND mark.source = s.source AND mark.period = s.period
    WHERE rn = 1""")
def disclosure(spark, sf_dir):
    return inventory.with_disclosure(vintages(spark, sf_dir), NOW, ZONES, {"IMF": 40})


@query("qa_28_fields_per_owner", f"WITH {INVENTORY} SELECT update_owner, count(*) AS fields FROM inventory GROUP BY 1")
def fields_per_owner(spark, sf_dir):
    return inventory.grouped_counts(fields_now(spark, sf_dir), "update_owner")


@query("qa_28_lagging_fields", f"""
    WITH {INVENTORY} SELECT canonical_series_id, visible_last_period, database_latest_period FROM inventory
    WHERE visible_last_period <> database_latest_period""")
def lagging_fields(spark, sf_dir):
    return inventory.lagging(fields_now(spark, sf_dir)).select(
        "canonical_series_id", "visible_last_period", "database_latest_period")


@query("qa_28_stale_fields", f"""
    WITH {INVENTORY} SELECT canonical_series_id, visible_last_period FROM inventory
    WHERE CAST(substr(visible_last_period, 1, 4) AS INTEGER) < 2000""")
def stale_fields(spark, sf_dir):
    return inventory.stale(fields_now(spark, sf_dir), 2000).select("canonical_series_id", "visible_last_period")


@query("qa_29_series_list", f"WITH {V} SELECT DISTINCT canonical_series_id FROM v")
def series_list(spark, sf_dir):
    return inventory.series_list(vintages(spark, sf_dir))


_REVIEW = f"""{V}, w AS (SELECT * FROM v WHERE retrieved_at BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '2000-01-01'
                           AND source IN ('OFF1', 'WIND'))"""


@query("qa_30_review_candidates", f"""
    WITH {_REVIEW} SELECT ingest_seq, canonical_series_id, period, vintage_no, revision_delta FROM w
    ORDER BY CASE WHEN vintage_no > 1 OR revision_delta IS NOT NULL THEN 0 ELSE 1 END, abs(coalesce(revision_delta, 0)) DESC,
             canonical_series_id, period, source, vintage_no, available_at, raw_sha256, value LIMIT 100""")
def review_candidates(spark, sf_dir):
    v = vintages(spark, sf_dir)
    span = ("1998-01-01 00:00:00+00:00", "2000-01-01 00:00:00+00:00", ["off1", "wind"])
    return inventory.review_candidates(v, *span, 100).select(
        "ingest_seq", "canonical_series_id", "period", "vintage_no", "revision_delta")


@query("qa_30_review_total", f"WITH {_REVIEW} SELECT source, count(*) AS total FROM w GROUP BY source")
def review_total(spark, sf_dir):
    return inventory.review_window(vintages(spark, sf_dir), "1998-01-01 00:00:00+00:00", "2000-01-01 00:00:00+00:00",
                                   ["off1", "wind"]).groupBy("source").agg(F.count(F.lit(1)).alias("total"))


@query("qa_31_risk_flags", f"""
    WITH {V} SELECT ingest_seq, concat_ws(';', CASE WHEN vintage_no > 1 THEN 'revision_vintage' END,
        CASE WHEN revision_delta IS NOT NULL THEN 'value_changed' END, CASE WHEN abs(revision_delta) >= 5 THEN 'large_absolute_revision' END,
        CASE WHEN pit_grade = 'D' THEN 'pit_d_first_seen_or_estimated' END, CASE WHEN source = 'SAFE' THEN 'article_parser' END) AS risk_flags,
        substr(sha256(concat_ws('|', source, canonical_series_id, period, CASE WHEN vintage_no = 0 THEN '' ELSE CAST(vintage_no AS VARCHAR) END,
               strftime(available_at, '%Y-%m-%d %H:%M:%S'), raw_sha256)), 1, 20) AS candidate_id FROM v""")
def risk_flags(spark, sf_dir):
    return vintages(spark, sf_dir).select(
        "ingest_seq", F.array_join(inventory.risk_flags(), ";").alias("risk_flags"),
        inventory.candidate_id().alias("candidate_id"))
