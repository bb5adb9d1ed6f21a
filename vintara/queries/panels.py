"""Wide panels at one cutoff and over many month-end cutoffs."""

from pyspark.sql import functions as F

from ..functions.instants import spine
from ..operators import panels
from . import query
from .asof import METADATA_SQL, POLICY, select_at
from .fixture import REGISTRY, V, fields, inactive, rules, sidecar, vintages
from .intervals import START, spine_sql, wide_sql
from .selection_sql import selected_sql, work_tables

AS_OF = "2000-05-31"
CUT = "2000-05-31 15:59:59.999999"
CN, GLB = fields("CN"), fields("DEU", "GLB")


def wide(spark, sf_dir, scope, frequency, names):
    return panels.asof_wide(vintages(spark, sf_dir), AS_OF, scope, start=START, frequency=frequency,
                            sidecar=sidecar(spark, sf_dir), rules=rules(spark), inactive=inactive(spark),
                            policy=POLICY, fields=names)


def _wide_sql(scope, names, value, quarterly=False):
    end = "2000-06-30" if quarterly else "2000-05-31"
    column = "quarter_end" if quarterly else "month_end"
    return f"""WITH {selected_sql(scope, CUT, START, end)}, {spine_sql(column, START, end, quarterly)}
               {wide_sql('sel', column, 'spine', names, value)}"""


@query("asof_12_index_spine", f"""
    WITH {selected_sql('CN', CUT, START, '2000-05-31')}, {spine_sql('month_end', START, '2000-05-31')}
    SELECT s.month_end, count(c.period) AS known_cells FROM spine s LEFT JOIN sel c ON c.period_end = s.month_end
    GROUP BY s.month_end""")
def index_spine(spark, sf_dir):
    days = spine(spark, START, "2000-05-31")
    known = select_at(spark, sf_dir, "CN", AS_OF, START, "2000-05-31").groupBy("period_end").agg(
        F.count(F.lit(1)).alias("n"))
    return days.join(known, days.month_end == known.period_end, "left").select(
        "month_end", F.coalesce("n", F.lit(0)).alias("known_cells"))


@query("asof_13_wide_values", _wide_sql("CN", CN, "round(c.value, 10)"))
def wide_values(spark, sf_dir):
    return wide(spark, sf_dir, "CN", "M", CN).values


@query("asof_13_wide_periods", _wide_sql("CN", CN, "c.period"))
def wide_periods(spark, sf_dir):
    return wide(spark, sf_dir, "CN", "M", CN).periods


@query("asof_13_wide_provenance", _wide_sql("GLB", GLB, "c.selection_origin"))
def wide_provenance(spark, sf_dir):
    return wide(spark, sf_dir, "GLB", "M", GLB).provenance


# two countries are put on one series, so several rows claim a cell
_CLAIMS = """claims AS (SELECT 'X_' || substr(frequency, 1, 1) AS canonical_series_id, period_end, country, value, period, available_at, vintage_no FROM v
    WHERE pit_grade = 'A' AND country IN ('CN', 'US') AND available_at <= TIMESTAMP '2000-05-31 15:59:59.999999'),
    winner AS (SELECT canonical_series_id, period_end, arg_max(c, ROW(c.available_at, c.vintage_no, c.value, c.period, 'PIT_A', c.country)) AS c
               FROM claims c GROUP BY ALL)"""


@query("asof_13_colliding_cells", f"""
    WITH {V}, {_CLAIMS}, {spine_sql('month_end', START, '2000-05-31')}
    SELECT s.month_end, m.c.value AS value_m, m.c.period AS period_m, q.c.value AS value_q, q.c.period AS period_q FROM spine s
    LEFT JOIN winner m ON m.period_end = s.month_end AND m.canonical_series_id = 'X_M'
    LEFT JOIN winner q ON q.period_end = s.month_end AND q.canonical_series_id = 'X_Q'""")
def colliding_cells(spark, sf_dir):
    rows = vintages(spark, sf_dir).where(
        "pit_grade = 'A' AND country IN ('CN', 'US') AND available_at <= timestamp_ntz'2000-05-31 15:59:59.999999'").withColumns(
        {"canonical_series_id": F.concat(F.lit("X_"), F.substring("frequency", 1, 1)), "selection_origin": F.lit("PIT_A")})
    result = panels._wide(rows, rows, AS_OF, START, "M", ["X_M", "X_Q"], False)
    parts = result.values.withColumnsRenamed({"X_M": "value_m", "X_Q": "value_q"})
    return parts.join(result.periods.withColumnsRenamed({"X_M": "period_m", "X_Q": "period_q"}), "month_end")


@query("asof_14_quarterly_values", _wide_sql("CN", CN, "round(c.value, 10)", True))
def quarterly_values(spark, sf_dir):
    return wide(spark, sf_dir, "CN", "Q", CN).values


@query("asof_14_wide_metadata", f"""
    WITH {V}, {REGISTRY}, {METADATA_SQL.format(scope="country NOT IN ('CN', 'US')")} SELECT * FROM metadata""")
def wide_metadata(spark, sf_dir):
    return wide(spark, sf_dir, "GLB", "Q", GLB).metadata


PAN_START, PAN_END = "1996-01-31", "2001-06-30"
_TIES = "retrieved_at DESC, source DESC, raw_sha256 DESC, value DESC"
# each month end's cutoff is local 23:59:59, i.e. 15:59:59 UTC
_MONTHS = f"""months AS (SELECT last_day(CAST(m AS DATE)) AS as_of,
                                CAST(last_day(CAST(m AS DATE)) AS TIMESTAMP) + INTERVAL '15:59:59' HOUR TO SECOND AS cut
              FROM generate_series(DATE '1996-01-01', DATE '2001-06-01', INTERVAL 1 MONTH) t(m))"""
_MONTHS = _MONTHS.replace("INTERVAL '15:59:59' HOUR TO SECOND", "to_seconds(57599)")
_ACTIVE = "canonical_series_id NOT IN (SELECT canonical_series_id FROM registry WHERE NOT active)"


def _snap(grades: str, country: str) -> str:
    return f"""snap AS (SELECT m.as_of, v.* FROM months m JOIN v ON v.available_at <= m.cut
                        WHERE pit_grade IN ({grades}) AND {country} AND {_ACTIVE}
                        QUALIFY row_number() OVER (PARTITION BY m.as_of, country, canonical_series_id, period
                                                   ORDER BY available_at DESC, vintage_no DESC, {_TIES}) = 1),
               latest AS (SELECT * FROM snap
                          QUALIFY row_number() OVER (PARTITION BY as_of, canonical_series_id
                                  ORDER BY period_end DESC, available_at DESC, vintage_no DESC, {_TIES}) = 1)"""


_STRICT = f"WITH {V}, {REGISTRY}, {_MONTHS}, {_snap(chr(39) + 'A' + chr(39) + ',' + chr(39) + 'B' + chr(39), 'TRUE')}"
ALL = fields("CN", "US", "DEU", "GLB")


def strict_cells(spark, sf_dir):
    return panels.monthly_panel(vintages(spark, sf_dir), PAN_START, PAN_END, "strict", None, inactive(spark))


def _panel_wide_sql(value: str, cells: str = "latest") -> str:
    columns = ", ".join(f"max(CASE WHEN c.canonical_series_id = '{n}' THEN {value} END) AS {n}" for n in ALL)
    return f"""SELECT m.as_of AS as_of_month_end, {columns} FROM months m LEFT JOIN {cells} c USING (as_of) GROUP BY m.as_of"""


@query("pan_01_monthly_panel_strict", f"{_STRICT} {_panel_wide_sql('round(c.value, 10)')}")
def panel_values(spark, sf_dir):
    return panels.panel_wide(strict_cells(spark, sf_dir), PAN_START, PAN_END, ALL, F.round("value", 10))


@query("pan_02_monthly_panel_periods", f"{_STRICT} {_panel_wide_sql('c.period')}")
def panel_periods(spark, sf_dir):
    return panels.panel_wide(strict_cells(spark, sf_dir), PAN_START, PAN_END, ALL, F.col("period"))


_WORK = f"""WITH {work_tables(f"WITH {_MONTHS} FROM months")}, months AS (FROM cuts), told AS (FROM latest WHERE {_ACTIVE})"""


def work_cells(spark, sf_dir):
    return panels.work_panel(vintages(spark, sf_dir), sidecar(spark, sf_dir), PAN_START, PAN_END,
                             inactive=inactive(spark))


@query("pan_01_monthly_panel_work", f"""{_WORK}
    SELECT as_of, canonical_series_id, period, value, work_origin, available_at, vintage_no, series_name FROM told""")
def panel_work(spark, sf_dir):
    return work_cells(spark, sf_dir).select("as_of", "canonical_series_id", "period", "value", "work_origin",
                                            "available_at", "vintage_no", "series_name")


@query("pan_03_monthly_panel_provenance", f"{_WORK} {_panel_wide_sql('c.work_origin', 'told')}")
def panel_provenance(spark, sf_dir):
    return panels.panel_wide(work_cells(spark, sf_dir), PAN_START, PAN_END, ALL, F.col("work_origin"))


@query("pan_04_panel_columns", f"""{_WORK}
    SELECT canonical_series_id, series_name, source, frequency, unit, seasonal_adjustment,
           CASE work_origin WHEN 'work_A' THEN 'A' WHEN 'work_B' THEN 'B' ELSE 'D' END AS pit_grade
    FROM told WHERE as_of = DATE '{PAN_END}'""")
def panel_columns(spark, sf_dir):
    return panels.panel_columns(work_cells(spark, sf_dir), PAN_END)


@query("pan_05_monthly_snapshots", f"""{_STRICT}
    SELECT as_of, country, canonical_series_id, period, value, available_at, vintage_no, pit_grade FROM snap""")
def monthly_snapshots(spark, sf_dir):
    return panels.monthly_snapshots(vintages(spark, sf_dir), PAN_START, PAN_END, inactive=inactive(spark)).select(
        "as_of", "country", "canonical_series_id", "period", "value", "available_at", "vintage_no", "pit_grade")


@query("pan_06_month_ends", f"""
    WITH {V}, {REGISTRY}, {_MONTHS}
    SELECT m.as_of, count(v.period) AS entering FROM months m
    LEFT JOIN v ON last_day(CAST(v.available_at + to_hours(8) AS DATE)) = m.as_of GROUP BY m.as_of""")
def month_ends(spark, sf_dir):
    v = vintages(spark, sf_dir)
    entering = v.groupBy(panels.first_month_end(v).alias("as_of")).agg(F.count(F.lit(1)).alias("entering"))
    return panels.month_ends(spark, PAN_START, PAN_END).join(entering, "as_of", "left").select(
        "as_of", F.coalesce("entering", F.lit(0)).alias("entering"))
