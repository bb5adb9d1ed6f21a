"""Effective intervals and what is rebuilt from them."""

from pyspark.sql import functions as F

from ..operators import asof, intervals, panels
from . import query
from .asof import POLICY, select_at
from .fixture import fields, inactive, rules, sidecar, vintages
from .selection_sql import EVENT_START, EVENT_STEPS, TABLES, selection_steps

START = EVENT_START
THRESHOLDS = ["PIT_A", "PIT_B", "WIND", "EASTMONEY_D", "SAFE_ESTIMATED_D"]
EVENTS = f"{TABLES}, {EVENT_STEPS}"


def events(spark, sf_dir, scope="ALL"):
    return intervals.effective_events(
        vintages(spark, sf_dir), scope, sidecar=sidecar(spark, sf_dir), rules=rules(spark),
        inactive=inactive(spark), policy=POLICY, start=START)


def pool(spark, sf_dir):
    return intervals.candidates(vintages(spark, sf_dir), "ALL", sidecar=sidecar(spark, sf_dir), rules=rules(spark),
                                policy=POLICY)


_POOL_COLUMNS = ["country", "canonical_series_id", "period", "source", "source_frequency", "value", "visible_from",
                 "selection_origin", "source_priority", "event_role", "vintage_no", "retrieved_at", "raw_sha256",
                 "period_start", "parser_version"]


@query("int_01_base_candidates", f"""
    WITH {EVENTS} SELECT {', '.join(_POOL_COLUMNS)} FROM cand WHERE event_role = 'BASE_PRIORITY'""")
def base_candidates(spark, sf_dir):
    return pool(spark, sf_dir).where("event_role = 'BASE_PRIORITY'").select(*_POOL_COLUMNS)


@query("int_02_same_origin_dedup", f"""
    WITH {EVENTS}
    SELECT country, canonical_series_id, period, selection_origin, visible_from, vintage_no, value, source FROM cand
    WHERE event_role = 'BASE_PRIORITY'
    QUALIFY row_number() OVER (PARTITION BY country, canonical_series_id, period, selection_origin, visible_from
              ORDER BY vintage_no DESC, retrieved_at DESC NULLS LAST, source DESC, raw_sha256 DESC NULLS LAST, value DESC) = 1""")
def same_origin_dedup(spark, sf_dir):
    return intervals.dedup_same_origin(pool(spark, sf_dir).where("event_role = 'BASE_PRIORITY'")).select(
        "country", "canonical_series_id", "period", "selection_origin", "visible_from", "vintage_no", "value", "source")


@query("int_03_first_visible", f"""
    WITH {EVENTS}
    SELECT country, canonical_series_id, period, {', '.join(
        f"min(visible_from) FILTER (WHERE selection_origin = '{o}') AS first_{o.lower()}_at" for o in THRESHOLDS)}
    FROM cand WHERE selection_origin IN ({', '.join(repr(o) for o in THRESHOLDS)})
    GROUP BY country, canonical_series_id, period""")
def first_visible(spark, sf_dir):
    return intervals.first_visible(pool(spark, sf_dir), asof.KEY)


@query("int_04_dominance_filter", f"""
    WITH {EVENTS}
    SELECT country, canonical_series_id, period, selection_origin, visible_from, value, vintage_no FROM effective""")
def dominance(spark, sf_dir):
    kept = pool(spark, sf_dir).where("event_role = 'BASE_PRIORITY'")
    kept = kept.join(inactive(spark), "canonical_series_id", "left_anti")
    return intervals.dominance_filter(
        intervals.dedup_same_origin(kept).join(intervals.first_visible(kept, asof.KEY), asof.KEY, "left")
    ).select("country", "canonical_series_id", "period", "selection_origin", "visible_from", "value", "vintage_no")


@query("int_05_revision_events", f"""
    WITH {EVENTS}
    SELECT country, canonical_series_id, period, selection_origin, visible_from, value, source FROM cand
    WHERE event_role = 'DATED_REVISION'""")
def revision_events(spark, sf_dir):
    return pool(spark, sf_dir).where("event_role = 'DATED_REVISION'").select(
        "country", "canonical_series_id", "period", "selection_origin", "visible_from", "value", "source")


@query("int_06_same_instant_choice", f"""
    WITH {EVENTS}
    SELECT country, canonical_series_id, period, visible_from, selection_origin, value, vintage_no FROM pool
    QUALIFY row_number() OVER (PARTITION BY country, canonical_series_id, period, visible_from
              ORDER BY source_priority DESC, vintage_no DESC, retrieved_at DESC NULLS LAST, source DESC,
                       raw_sha256 DESC NULLS LAST, value DESC) = 1""")
def same_instant(spark, sf_dir):
    from ..functions.ordered import newest, top_row
    rows = pool(spark, sf_dir).join(inactive(spark), "canonical_series_id", "left_anti")
    return top_row(rows, [*asof.KEY, "visible_from"], newest("source_priority", *intervals.RECENCY)).select(
        "country", "canonical_series_id", "period", "visible_from", "selection_origin", "value", "vintage_no")


@query("int_07_valid_to", f"""
    WITH {EVENTS}
    SELECT country, canonical_series_id, period, valid_from, valid_to, event_no, selection_origin FROM events""")
def valid_to(spark, sf_dir):
    return events(spark, sf_dir).select(
        "country", "canonical_series_id", "period", "valid_from", "valid_to", "event_no", "selection_origin")


@query("int_08_effective_events_all", f"WITH {EVENTS} SELECT {', '.join(intervals.EVENT_COLUMNS)} FROM events")
def effective_events_all(spark, sf_dir):
    return events(spark, sf_dir)


@query("int_08_effective_events_us", f"""
    WITH {EVENTS} SELECT {', '.join(intervals.EVENT_COLUMNS)} FROM events WHERE country = 'US'""")
def effective_events_us(spark, sf_dir):
    return events(spark, sf_dir, "US")


@query("int_09_interval_invariants", f"""
    WITH {EVENTS}, n AS (SELECT *, lead(valid_from) OVER k AS nxt, row_number() OVER k AS rn FROM events
                         WINDOW k AS (PARTITION BY country, canonical_series_id, period ORDER BY valid_from))
    SELECT count(*) AS events, (SELECT count(*) FROM (SELECT DISTINCT country, canonical_series_id, period FROM events)) AS keys,
           CAST(count(*) FILTER (valid_to IS DISTINCT FROM nxt) AS BIGINT) AS gaps,
           CAST(count(*) FILTER (nxt = valid_from) AS BIGINT) AS same_instant,
           (SELECT count(*) FROM (SELECT country FROM events GROUP BY country, canonical_series_id, period
                                  HAVING count(*) FILTER (valid_to IS NULL) <> 1)) AS not_one_open,
           CAST(count(*) FILTER (valid_to <= valid_from) AS BIGINT) AS empty_intervals
    FROM n""")
def invariants(spark, sf_dir):
    return intervals.invariants(events(spark, sf_dir))


_CUT = "2000-03-31 15:59:59.999999"


@query("int_10_wide_long_differences", f"""
    WITH {EVENTS}, {selection_steps('CN', _CUT, START, '2000-03-31')},
    held AS (SELECT * FROM events WHERE country = 'CN' AND period_end BETWEEN DATE '{START}' AND DATE '2000-03-31'
               AND valid_from <= TIMESTAMP '{_CUT}' AND (valid_to IS NULL OR TIMESTAMP '{_CUT}' < valid_to))
    SELECT count(*) AS cells,
           count(*) FILTER (s.value IS DISTINCT FROM h.value OR s.selection_origin IS DISTINCT FROM h.selection_origin
                            OR s.available_at IS DISTINCT FROM h.valid_from) AS different
    FROM sel s FULL JOIN held h USING (country, canonical_series_id, period)""")
def wide_long_differences(spark, sf_dir):
    direct = select_at(spark, sf_dir, "CN", "2000-03-31", START, "2000-03-31")
    held = asof.at(events(spark, sf_dir, "CN"), "2000-03-31", "CN", START, "2000-03-31").withColumn(
        "available_at", F.col("valid_from"))
    columns = ["value", "selection_origin", "available_at"]
    a = direct.select(*asof.KEY, F.struct(*columns).alias("l"))
    b = held.select(*asof.KEY, F.struct(*columns).alias("r"))
    return a.join(b, asof.KEY, "full").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(~F.col("l").eqNullSafe(F.col("r"))).alias("different"))


@query("asof_10_interval_asof", f"""
    WITH {EVENTS}
    SELECT country, canonical_series_id, period, value, selection_origin, valid_from, valid_to FROM events
    WHERE valid_from <= TIMESTAMP '{_CUT}' AND (valid_to IS NULL OR TIMESTAMP '{_CUT}' < valid_to)""")
def interval_asof(spark, sf_dir):
    return asof.at(events(spark, sf_dir), "2000-03-31").select(
        "country", "canonical_series_id", "period", "value", "selection_origin", "valid_from", "valid_to")


@query("asof_11_overlap_guard", f"""
    WITH {EVENTS},
    held AS (SELECT * FROM events WHERE valid_from <= TIMESTAMP '{_CUT}' AND (valid_to IS NULL OR TIMESTAMP '{_CUT}' < valid_to))
    SELECT count(*) AS selected_rows, count(DISTINCT (country, canonical_series_id, period)) AS selected_keys,
           count(*) - count(DISTINCT (country, canonical_series_id, period)) AS surplus FROM held""")
def overlap_guard(spark, sf_dir):
    held = asof.at(events(spark, sf_dir), "2000-03-31")
    return held.groupBy(*asof.KEY).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("selected_rows"), F.count(F.lit(1)).alias("selected_keys"),
        F.sum(F.col("n") - 1).alias("surplus"))


def wide_sql(cells: str, index_column: str, spine: str, names, value: str) -> str:
    """Pivot by conditional aggregation; ``cells`` and ``spine`` are common tables."""
    columns = ", ".join(f"max(CASE WHEN c.canonical_series_id = '{n}' THEN {value} END) AS \"{n}\"" for n in names)
    return f"""SELECT s.{index_column}, {columns} FROM {spine} s LEFT JOIN {cells} c ON c.period_end = s.{index_column}
               GROUP BY s.{index_column}"""


def spine_sql(column: str, start: str, end: str, quarterly: bool = False) -> str:
    return f"""spine AS (SELECT last_day(CAST(m AS DATE)) AS {column}
               FROM generate_series(DATE_TRUNC('month', DATE '{start}'), DATE '{end}', INTERVAL 1 MONTH) t(m)
               {"WHERE month(m) % 3 = 0" if quarterly else ""})"""


_CN = fields("CN")
_HELD = f"""held AS (SELECT * FROM events WHERE country = 'CN' AND valid_from <= TIMESTAMP '{_CUT}'
                       AND (valid_to IS NULL OR TIMESTAMP '{_CUT}' < valid_to))"""


@query("asof_15_wide_from_events", f"""
    WITH {EVENTS}, {_HELD}, {spine_sql('quarter_end', START, '2000-03-31', True)}
    {wide_sql('held', 'quarter_end', 'spine', _CN, 'round(value, 10)')}""")
def wide_from_events(spark, sf_dir):
    return panels.asof_wide_from_events(events(spark, sf_dir, "CN"), "2000-03-31", "CN", start=START, frequency="Q",
                                        fields=_CN).values


@query("asof_16_combined_scopes", f"""
    WITH {EVENTS}, held AS (SELECT * FROM events WHERE valid_from <= TIMESTAMP '{_CUT}'
                              AND (valid_to IS NULL OR TIMESTAMP '{_CUT}' < valid_to))
    SELECT CASE WHEN country IN ('CN', 'US') THEN country ELSE 'GLB' END AS scope, country, period_end,
           {', '.join(f"max(CASE WHEN canonical_series_id = '{n}' THEN round(value, 10) END) AS {n}"
                      for n in fields('CN', 'US', 'DEU', 'GLB'))}
    FROM held GROUP BY ALL""")
def combined_scopes(spark, sf_dir):
    return panels.combined_wide(events(spark, sf_dir), "2000-03-31", fields("CN", "US", "DEU", "GLB"))


