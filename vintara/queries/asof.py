"""As-of queries on the order-derived vintages."""

from pyspark.sql import functions as F

from ..operators import asof
from ..plans.policy import Policy
from . import query
from .fixture import REGISTRY, SAFE_SERIES, SIDECAR, V, inactive, rules, sidecar, vintages
from .selection_sql import TABLES, selected_sql, work_tables

POLICY = Policy(safe_series=SAFE_SERIES)
TIES = "retrieved_at DESC, source DESC, raw_sha256 DESC, value DESC"
SNAPSHOT_COLUMNS = ["country", "canonical_series_id", "period", "source", "value", "available_at", "vintage_no",
                    "pit_grade", "raw_sha256"]
# cutoffs are given in UTC; the reference local zone is UTC+8
T = "1999-06-30 23:59:59+00:00"


def _snapshot_sql(grades: str, extra: str = "", cutoff: str = "1999-06-30 23:59:59") -> str:
    return f"""
        WITH {V}
        SELECT {', '.join(SNAPSHOT_COLUMNS)} FROM v
        WHERE available_at <= TIMESTAMP '{cutoff}' AND pit_grade IN ({grades}) {extra}
        QUALIFY row_number() OVER (PARTITION BY country, canonical_series_id, period
                                   ORDER BY available_at DESC, vintage_no DESC, {TIES}) = 1
    """


@query("asof_01_snapshot_strict", _snapshot_sql("'A','B'"))
def snapshot_strict(spark, sf_dir):
    return asof.snapshot(vintages(spark, sf_dir), T).select(*SNAPSHOT_COLUMNS)


@query("asof_01_snapshot_loose", _snapshot_sql("'A','B','C'"))
def snapshot_loose(spark, sf_dir):
    return asof.snapshot(vintages(spark, sf_dir), T, "loose").select(*SNAPSHOT_COLUMNS)


@query("asof_01_snapshot_observed_cn", _snapshot_sql("'A','B','C','D'", "AND country = 'CN'", "1999-06-29 16:00:00"))
def snapshot_observed(spark, sf_dir):
    # a bare date is local midnight for snapshots
    return asof.snapshot(vintages(spark, sf_dir), "1999-06-30", "observed", "cn").select(*SNAPSHOT_COLUMNS)


@query("asof_02_latest_period", f"""
    WITH {V}, snap AS (
        SELECT * FROM v WHERE available_at <= TIMESTAMP '1999-06-30 23:59:59' AND pit_grade IN ('A', 'B')
        QUALIFY row_number() OVER (PARTITION BY country, canonical_series_id, period
                                   ORDER BY available_at DESC, vintage_no DESC, {TIES}) = 1)
    SELECT {', '.join(SNAPSHOT_COLUMNS)} FROM snap
    QUALIFY row_number() OVER (PARTITION BY canonical_series_id
                               ORDER BY period_end DESC, available_at DESC, vintage_no DESC, {TIES}) = 1
""")
def latest_period(spark, sf_dir):
    return asof.latest_per_series(asof.snapshot(vintages(spark, sf_dir), T)).select(*SNAPSHOT_COLUMNS)


WORK_SQL = f"""
    WITH {work_tables("SELECT DATE '1999-06-30' AS as_of, TIMESTAMP '1999-06-30 23:59:59' AS cut")}
    SELECT * EXCLUDE (as_of) REPLACE (coalesce(series_name, canonical_series_id) AS series_name) FROM latest"""


@query("asof_03_work_snapshot", WORK_SQL)
def work_snapshot(spark, sf_dir):
    return asof.work_snapshot(vintages(spark, sf_dir), sidecar(spark, sf_dir), T)


def select_at(spark, sf_dir, scope, as_of, start="1995-01-01", end=None):
    return asof.selected(vintages(spark, sf_dir), as_of, scope, start=start, end=end, sidecar=sidecar(spark, sf_dir),
                         rules=rules(spark), inactive=inactive(spark), policy=POLICY)


# a bare date is the end of the local day: 2000-03-31 15:59:59.999999 UTC
_CUT = "2000-03-31 15:59:59.999999"


@query("asof_04_selected_cn", f"WITH {selected_sql('CN', _CUT, '1995-01-01', '2000-03-31')} SELECT * FROM sel")
def selected_cn(spark, sf_dir):
    return select_at(spark, sf_dir, "CN", "2000-03-31", end="2000-03-31")


@query("asof_04_selected_all", f"WITH {selected_sql('ALL', _CUT, '1995-01-01', '2000-03-31')} SELECT * FROM sel")
def selected_all(spark, sf_dir):
    return select_at(spark, sf_dir, "ALL", "2000-03-31", end="2000-03-31")


@query("asof_05_gap_only", f"""
    WITH {V}, {SIDECAR}
    SELECT canonical_series_id, source, period, value, estimated_available_at FROM side e
    WHERE NOT EXISTS (SELECT 1 FROM v o WHERE o.country = 'CN' AND o.canonical_series_id = e.canonical_series_id
                        AND o.period = e.period AND o.pit_grade IN ('A', 'B'))
""")
def gap_only(spark, sf_dir):
    return asof.gap_only(sidecar(spark, sf_dir), vintages(spark, sf_dir)).select(
        "canonical_series_id", "source", "period", "value", "estimated_available_at")


@query("asof_06_rule_estimated", f"""
    WITH {TABLES} SELECT canonical_series_id, period, value, vintage_no, moment AS visible_from FROM estimated
""")
def rule_estimated(spark, sf_dir):
    return asof.rule_estimated(vintages(spark, sf_dir), rules(spark)).select(
        "canonical_series_id", "period", "value", "vintage_no", "visible_from")


@query("asof_07_fallback_candidates", f"""
    WITH {TABLES}
    SELECT canonical_series_id, period, source, value, origin AS selection_origin, prio AS source_priority, available_at
    FROM tagged JOIN policy USING (origin) WHERE origin IN ('EASTMONEY_D', 'SINA_D')
""")
def fallback_candidates(spark, sf_dir):
    return asof.candidates(vintages(spark, sf_dir), "CN", sidecar=sidecar(spark, sf_dir), policy=POLICY).where(
        F.col("selection_origin").isin("EASTMONEY_D", "SINA_D")
    ).select("canonical_series_id", "period", "source", "value", "selection_origin", "source_priority", "available_at")


@query("asof_08_dated_revisions", f"""
    WITH {TABLES}
    SELECT country, canonical_series_id, period, source, value, origin AS selection_origin, prio AS source_priority, available_at
    FROM tagged JOIN policy USING (origin) WHERE dated
""")
def dated_revisions(spark, sf_dir):
    return asof.candidates(vintages(spark, sf_dir), "ALL", sidecar=sidecar(spark, sf_dir), rules=rules(spark),
                           policy=POLICY).where("event_role = 'DATED_REVISION'").select(
        "country", "canonical_series_id", "period", "source", "value", "selection_origin", "source_priority",
        "available_at")


METADATA_SQL = """
    meta_rows AS (SELECT *, row_number() OVER (PARTITION BY canonical_series_id
                              ORDER BY retrieved_at DESC, vintage_no DESC, raw_sha256 DESC, series_name DESC) AS rn,
                         row_number() OVER (PARTITION BY canonical_series_id, seasonal_adjustment IS NULL
                              ORDER BY retrieved_at DESC, vintage_no DESC, raw_sha256 DESC) AS rn_sa
                  FROM v WHERE {scope}),
    metadata AS (SELECT canonical_series_id, min(country) AS country,
                        string_agg(DISTINCT source, '+' ORDER BY source) AS sources,
                        max(series_name) FILTER (rn = 1) AS series_name, max(frequency) FILTER (rn = 1) AS frequency,
                        max(unit) FILTER (rn = 1) AS unit,
                        max(seasonal_adjustment) FILTER (rn_sa = 1) AS seasonal_adjustment
                 FROM meta_rows
                 WHERE canonical_series_id NOT IN (SELECT canonical_series_id FROM registry WHERE NOT active)
                 GROUP BY canonical_series_id)
"""


@query("asof_09_series_metadata", f"WITH {V}, {REGISTRY}, {METADATA_SQL.format(scope='TRUE')} SELECT * FROM metadata")
def series_metadata(spark, sf_dir):
    return asof.series_metadata(vintages(spark, sf_dir), "ALL", inactive(spark))


@query("asof_17_point_lookup", f"""
    WITH {V}, probe AS (SELECT DISTINCT source, canonical_series_id, period,
                               CAST(period_end AS TIMESTAMP) + to_days(45) AS probe_at FROM v)
    SELECT p.source, p.canonical_series_id, p.period, p.probe_at, x.value AS visible_value,
           x.vintage_no AS visible_vintage_no
    FROM probe p LEFT JOIN v x ON x.source = p.source AND x.canonical_series_id = p.canonical_series_id
                              AND x.period = p.period AND x.available_at <= p.probe_at
    QUALIFY row_number() OVER (PARTITION BY p.source, p.canonical_series_id, p.period
                               ORDER BY x.available_at DESC NULLS LAST, x.vintage_no DESC, x.retrieved_at DESC,
                                        x.raw_sha256 DESC, x.value DESC) = 1
""")
def point_lookup(spark, sf_dir):
    v = vintages(spark, sf_dir)
    probes = v.select("source", "canonical_series_id", "period",
                      F.expr("cast(period_end AS timestamp_ntz) + interval 45 days").alias("probe_at")).distinct()
    return asof.point_lookup(probes, v, ["source", "canonical_series_id", "period"])


@query("asof_18_previous_vintage", f"""
    WITH {V}, best AS (
        SELECT source, canonical_series_id, period, vintage_no, value, available_at, pit_grade, source_url FROM v
        QUALIFY row_number() OVER (PARTITION BY source, canonical_series_id, period, vintage_no
                                   ORDER BY available_at DESC, retrieved_at DESC, raw_sha256 DESC, value DESC) = 1)
    SELECT v.source, v.canonical_series_id, v.period, v.vintage_no, v.value, v.ingest_seq,
           b.value AS previous_value, b.vintage_no AS previous_vintage_no, b.available_at AS previous_available_at,
           b.pit_grade AS previous_pit_grade, b.source_url AS previous_source_url
    FROM v LEFT JOIN best b ON b.source = v.source AND b.canonical_series_id = v.canonical_series_id
                           AND b.period = v.period AND b.vintage_no < v.vintage_no
    QUALIFY row_number() OVER (PARTITION BY v.ingest_seq ORDER BY b.vintage_no DESC NULLS LAST) = 1
""")
def previous_vintage(spark, sf_dir):
    return asof.previous_vintage(vintages(spark, sf_dir)).select(
        "source", "canonical_series_id", "period", "vintage_no", "value", "ingest_seq", "previous_value",
        "previous_vintage_no", "previous_available_at", "previous_pit_grade", "previous_source_url")
