"""Unpivot, parse, compress and derive."""

from pyspark.sql import functions as F

from ..functions.instants import with_period
from ..operators import contracts, transforms
from . import query
from .fixture import V, fields, table, vintages

# A vintage matrix: one row per (series, period), one column per vintage code.
HEADERS = ["SER98Q4", "SER99M3", "SER99:Q3", "SER2000M1", "SER00Q2", "SER45-M6"]
_DATES = ["1998-11-15", "1999-03-31", "1999-08-15", "2000-01-31", "2000-05-15", "1945-06-30"]


def matrix(spark, sf_dir):
    cells = vintages(spark, sf_dir).withColumn("edition", (F.col("ingest_seq") % 6).cast("int"))
    wide = cells.groupBy("canonical_series_id", "period").pivot("edition", list(range(6))).agg(F.max("value"))
    return wide.select("canonical_series_id", "period", *[F.col(f"{i}").alias(h) for i, h in enumerate(HEADERS)])


MATRIX = f"""{V}, cells AS (SELECT canonical_series_id, period, ingest_seq % 6 AS edition, max(value) AS value
    FROM v GROUP BY ALL), headers AS (SELECT * FROM (VALUES {', '.join(
        f"({i}, '{h}', DATE '{d}')" for i, (h, d) in enumerate(zip(HEADERS, _DATES)))}) t(edition, header, vintage_date))"""


@query("src_14_vintage_matrix", f"""
    WITH {MATRIX} SELECT canonical_series_id, period, header, value FROM cells JOIN headers USING (edition)""")
def vintage_matrix(spark, sf_dir):
    return transforms.unpivot_matrix(matrix(spark, sf_dir), ["canonical_series_id", "period"])


def _dated_cells(spark, sf_dir):
    return transforms.dated_matrix(matrix(spark, sf_dir), ["canonical_series_id", "period"], "SER")


@query("ing_11_matrix_headers", f"""
    WITH {MATRIX} SELECT canonical_series_id, period, header, value,
        CASE WHEN header LIKE '%Q%' THEN 'Q' ELSE 'M' END AS frequency, CAST(year(vintage_date) AS INTEGER) AS year,
        CAST(regexp_extract(header, '(\\d+)$', 1) AS INTEGER) AS number, vintage_date FROM cells JOIN headers USING (edition)""")
def matrix_headers(spark, sf_dir):
    return _dated_cells(spark, sf_dir)


@query("ing_10_matrix_compression", f"""
    WITH {MATRIX}, seen AS (SELECT c.*, h.vintage_date, lag(value) OVER (PARTITION BY canonical_series_id, period
                              ORDER BY vintage_date) AS previous FROM cells c JOIN headers h USING (edition))
    SELECT canonical_series_id, period, vintage_date, value FROM seen WHERE previous IS NULL OR abs(value - previous) > 1e-12""")
def matrix_compression(spark, sf_dir):
    return transforms.compressed(_dated_cells(spark, sf_dir), ["canonical_series_id", "period"],
                                 [("vintage_date", "asc")]).select("canonical_series_id", "period", "vintage_date", "value")


@query("ing_10_vintage_compression", f"""
    WITH {V}, seen AS (SELECT *, lag(value) OVER (PARTITION BY canonical_series_id, period ORDER BY available_at, ingest_seq) AS previous FROM v)
    SELECT ingest_seq, canonical_series_id, period, value FROM seen WHERE previous IS NULL OR abs(value - previous) > 1e-12""")
def vintage_compression(spark, sf_dir):
    return transforms.compressed(vintages(spark, sf_dir), ["canonical_series_id", "period"],
                                 [("available_at", "asc"), ("ingest_seq", "asc")]).select(
        "ingest_seq", "canonical_series_id", "period", "value")


@query("ing_12_vintage_times", f"""
    WITH {V} SELECT ingest_seq, timezone('UTC', timezone('America/New_York', CAST(period_end AS TIMESTAMP))) AS release_at,
        timezone('UTC', timezone('America/New_York', CAST(period_end + 1 AS TIMESTAMP))) AS available_at FROM v""")
def vintage_times(spark, sf_dir):
    return transforms.vintage_times(vintages(spark, sf_dir), "period_end", "America/New_York").select(
        "ingest_seq", "release_at", "available_at")


_EDITION = """CASE ingest_seq % 5 WHEN 0 THEN date_format(period_end, 'yyyyMM') WHEN 1 THEN date_format(period_end, 'yyyy-MM')
    WHEN 2 THEN concat(date_format(period_end, 'yyyy'), 'M', month(period_end)) WHEN 3 THEN date_format(period_end, 'yyyy-MM-dd')
    ELSE concat('edition ', ingest_seq) END"""


@query("ing_13_edition_end", f"""
    WITH {V} SELECT ingest_seq, CASE WHEN ingest_seq % 5 < 4 THEN last_day(period_end) END AS edition_end FROM v""")
def edition_end(spark, sf_dir):
    return vintages(spark, sf_dir).select("ingest_seq", transforms.edition_end(F.expr(_EDITION)).alias("edition_end"))


def editions(spark, sf_dir):
    """Edition rows as text, the way a statistical agency's file has them."""
    return vintages(spark, sf_dir).selectExpr(
        "country AS REF_AREA", "frequency AS FREQ", "substring(source_series_id, 1, 2) AS MEASURE", "unit AS UNIT_MEASURE",
        "date_format(available_at, 'yyyyMM') AS EDITION", "period AS TIME_PERIOD",
        "CASE WHEN ingest_seq % 13 = 0 THEN 'n/a' ELSE cast(value AS string) END AS OBS_VALUE", "ingest_seq")


def edition_mapping(spark):
    return spark.range(12).selectExpr(
        "element_at(array('CN', 'DEU'), cast(id div 6 + 1 AS int)) AS a",
        "element_at(array('M', 'Q'), cast(id div 3 % 2 + 1 AS int)) AS f", "concat('X', id % 3 + 1) AS m",
    ).selectExpr(
        "a AS ref_area", "f AS freq", "m AS measure", "'pct' AS unit_measure", "concat(a, '_', m, '_', f) AS canonical_series_id",
        "CASE WHEN m = 'X1' THEN 'index' ELSE 'pct' END AS unit", "CASE WHEN a = 'DEU' THEN 'DE' END AS country")


EDITION_MAPPING = """mapping AS (SELECT a AS ref_area, f AS freq, m AS measure, a || '_' || m || '_' || f AS canonical_series_id,
    CASE WHEN m = 'X1' THEN 'index' ELSE 'pct' END AS unit, CASE WHEN a = 'DEU' THEN 'DE' ELSE a END AS country
    FROM (VALUES ('CN'), ('DEU')) t(a), (VALUES ('M'), ('Q')) u(f), (VALUES ('X1'), ('X2'), ('X3')) w(m))"""


@query("ing_14_edition_observations", f"""
    WITH {V}, {EDITION_MAPPING},
    rows AS (SELECT m.country, m.canonical_series_id, v.period, v.period_start, v.period_end, m.unit, v.value,
                    last_day(CAST(v.available_at AS DATE)) AS edition_end
             FROM v JOIN mapping m ON m.ref_area = v.country AND m.freq = v.frequency AND m.measure = substr(v.source_series_id, 1, 2)
             WHERE v.unit = 'pct' AND v.ingest_seq % 13 <> 0 AND NOT (m.unit = 'index' AND v.value <= 0)),
    seen AS (SELECT *, lag(value) OVER (PARTITION BY country, canonical_series_id, period ORDER BY edition_end, value) AS previous FROM rows)
    SELECT country, canonical_series_id, period, period_start, period_end, value,
           timezone('UTC', timezone('Europe/Paris', CAST(edition_end AS TIMESTAMP))) AS release_at,
           timezone('UTC', timezone('Europe/Paris', CAST(edition_end + 1 AS TIMESTAMP))) AS available_at, 'B' AS pit_grade
    FROM seen WHERE previous IS NULL OR abs(value - previous) > 1e-12""")
def edition_observations(spark, sf_dir):
    return transforms.editions_to_observations(editions(spark, sf_dir), edition_mapping(spark)).select(
        "country", "canonical_series_id", "period", "period_start", "period_end", "value", "release_at", "available_at", "pit_grade")


_LABEL = """CASE WHEN ingest_seq % 7 = 0 THEN 'x' || period WHEN ingest_seq % 7 = 6 THEN substring(period, 1, 4)
    WHEN ingest_seq % 3 = 0 THEN period WHEN ingest_seq % 3 = 1 THEN replace(period, '-', ':')
    ELSE lower(replace(period, '-', CASE WHEN frequency = 'M' THEN 'M' ELSE '' END)) END"""


@query("ing_15_period_labels", f"""
    WITH {V} SELECT ingest_seq, CASE WHEN ingest_seq % 7 <> 6 THEN period END AS period,
        CASE WHEN ingest_seq % 7 <> 6 THEN period_start END AS period_start,
        CASE WHEN ingest_seq % 7 <> 6 THEN period_end END AS period_end FROM v""")
def period_labels(spark, sf_dir):
    labels = vintages(spark, sf_dir).select("ingest_seq", "frequency", F.expr(_LABEL).alias("label"))
    return with_period(labels, F.col("label"), F.col("frequency")).drop("label", "frequency")


def daily(spark, sf_dir):
    """Daily curve points: ship dates as days, return flags as curves, quantity as yield."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag AS canonical_series_id", "l_linestatus AS tenor", "cast(l_shipdate AS date) AS day",
        "l_quantity AS yield", "l_discount AS extra")


DAILY = """daily AS (SELECT l_returnflag AS canonical_series_id, l_linestatus AS tenor, CAST(l_shipdate AS DATE) AS day,
    l_quantity AS yield, l_discount AS extra FROM lineitem)"""


@query("ing_16_last_of_month", f"""
    WITH {DAILY} SELECT canonical_series_id, tenor, last_day(day) AS period_end, day, yield FROM daily
    WHERE day < DATE '2001-03-01'
    QUALIFY row_number() OVER (PARTITION BY canonical_series_id, tenor, last_day(day) ORDER BY day DESC, yield DESC) = 1""")
def last_of_month(spark, sf_dir):
    return transforms.last_of_month(daily(spark, sf_dir), ["canonical_series_id", "tenor"], "day", ["yield"], "2001-03-01")


@query("ing_17_spread", f"""
    WITH {DAILY}, legs AS (SELECT day, tenor, max(yield) FILTER (canonical_series_id = 'A') AS l,
                                  max(yield) FILTER (canonical_series_id = 'R') AS r FROM daily GROUP BY day, tenor)
    SELECT day, tenor, 'SPREAD_A_R' AS canonical_series_id, round(l - r, 8) AS value FROM legs WHERE l IS NOT NULL AND r IS NOT NULL""")
def spread(spark, sf_dir):
    points = daily(spark, sf_dir).withColumn("value", F.col("yield"))
    return transforms.spread(points, "A", "R", "SPREAD_A_R", ["day", "tenor"])


@query("ing_18_net_series", f"""
    WITH {V}, legs AS (SELECT period, max(value) FILTER (canonical_series_id = 'CN_S0') AS l,
                              max(value) FILTER (canonical_series_id = 'CN_S1') AS r FROM v GROUP BY period)
    SELECT period, 'CN_NET' AS canonical_series_id, l - r AS value FROM legs WHERE l IS NOT NULL AND r IS NOT NULL""")
def net_series(spark, sf_dir):
    return transforms.spread(vintages(spark, sf_dir), "CN_S0", "CN_S1", "CN_NET", ["period"])


@query("ing_19_identity", f"""
    WITH {V}, legs AS (SELECT period, max(value) FILTER (canonical_series_id = 'CN_S0') AS left_value,
                max(value) FILTER (canonical_series_id = 'CN_S1') AS right_value,
                max(value) FILTER (canonical_series_id = 'CN_S2') AS balance_value FROM v GROUP BY period)
    SELECT *, abs(left_value - right_value - balance_value) AS gap FROM legs WHERE abs(left_value - right_value - balance_value) > 0.021""")
def identity(spark, sf_dir):
    return contracts.identity_violations(vintages(spark, sf_dir), "CN_S0", "CN_S1", "CN_S2")


@query("ing_21_newest_periods", f"""
    WITH {V}, p AS (SELECT DISTINCT canonical_series_id, period, period_end FROM v)
    SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY canonical_series_id ORDER BY period_end DESC) <= 6""")
def newest_periods(spark, sf_dir):
    periods = vintages(spark, sf_dir).select("canonical_series_id", "period", "period_end").distinct()
    return transforms.newest_periods(periods, 6)


@query("ing_25_increasing_dates", f"""
    WITH {V}, s AS (SELECT ingest_seq, source_series_id, period_end,
                           lag(period_end) OVER (PARTITION BY source_series_id ORDER BY ingest_seq) AS previous_date FROM v)
    SELECT * FROM s WHERE period_end <= previous_date""")
def increasing_dates(spark, sf_dir):
    rows = vintages(spark, sf_dir).select("ingest_seq", "source_series_id", "period_end")
    return transforms.not_increasing(rows, "source_series_id", "period_end", "ingest_seq")


@query("ing_25_period_ends", f"""
    WITH {V}, s AS (SELECT ingest_seq, frequency, CAST(available_at AS DATE) AS period_end FROM v)
    SELECT * FROM s WHERE period_end <> last_day(period_end) OR (frequency = 'Q' AND month(period_end) % 3 <> 0)""")
def period_ends(spark, sf_dir):
    rows = vintages(spark, sf_dir).select("ingest_seq", "frequency", F.col("available_at").cast("date").alias("period_end"))
    return contracts.not_period_end(rows)


_CN = fields("CN", active=False)


@query("ing_27_pivot_preview", f"""
    WITH {V} SELECT period, {', '.join(f"max(value) FILTER (canonical_series_id = '{n}') AS {n}" for n in _CN)}
    FROM v WHERE source = 'WIND' GROUP BY period""")
def pivot_preview(spark, sf_dir):
    return transforms.pivot_preview(vintages(spark, sf_dir).where("source = 'WIND'"), _CN)


def cells(spark, sf_dir):
    """Vendor cells: text values, some formulas, blanks, zeros and odd dates."""
    rows = vintages(spark, sf_dir).selectExpr(
        "ingest_seq", "source_series_id AS code",
        "CASE WHEN ingest_seq % 11 = 0 THEN date_sub(period_end, 1) ELSE period_end END AS cell_date",
        "CASE WHEN ingest_seq % 17 = 0 THEN '--' WHEN ingest_seq % 19 = 0 THEN NULL ELSE cast(value AS string) END AS raw_value",
        "ingest_seq % 29 = 0 AS is_formula", "cast(substring(source_series_id, 2) AS int) < 20 AS mapped",
        "source_series_id = 'X7' AS transformed", "first_seen_at - interval 60 days AS seen")
    return rows.withColumn("reasons", transforms.cell_reasons(F.col("seen"), "1996-01"))


CELLS = f"""{V}, c0 AS (SELECT ingest_seq, source_series_id AS code,
        CAST(CASE WHEN ingest_seq % 11 = 0 THEN period_end - 1 ELSE period_end END AS DATE) AS cell_date,
        CASE WHEN ingest_seq % 17 = 0 THEN NULL WHEN ingest_seq % 19 = 0 THEN NULL ELSE value END AS number,
        ingest_seq % 29 = 0 AS is_formula, CAST(substr(source_series_id, 2) AS INTEGER) < 20 AS mapped,
        source_series_id = 'X7' AS transformed, first_seen_at - to_days(60) AS seen FROM v),
    cells AS (SELECT *, concat_ws(';', CASE WHEN strftime(cell_date, '%Y-%m') < '1996-01' THEN 'before_requested_start' END,
        CASE WHEN cell_date > CAST(seen AS DATE) THEN 'future_observation_date' END,
        CASE WHEN cell_date <> last_day(cell_date) THEN 'not_month_end' END, CASE WHEN transformed THEN 'transformed_series' END,
        CASE WHEN NOT mapped THEN 'unreviewed_mapping' END, CASE WHEN is_formula THEN 'formula_value' END,
        CASE WHEN number IS NULL THEN 'missing_or_nonnumeric' WHEN number = 0 THEN 'ambiguous_zero_after_blank_fill' END) AS reasons FROM c0)"""


@query("ing_28_cell_quarantine", f"WITH {CELLS} SELECT ingest_seq, code, cell_date, reasons FROM cells")
def cell_quarantine(spark, sf_dir):
    return cells(spark, sf_dir).select("ingest_seq", "code", "cell_date", F.array_join("reasons", ";").alias("reasons"))


@query("ing_29_code_profile", f"""
    WITH {CELLS} SELECT code, min(strftime(cell_date, '%Y-%m')) FILTER (number <> 0) AS first_nonzero_period,
        max(strftime(cell_date, '%Y-%m')) FILTER (number <> 0) AS last_nonzero_period,
        count(*) FILTER (number = 0) AS numeric_zero_count, count(*) AS input_cells, count(*) FILTER (reasons = '') AS accepted_cells,
        min(strftime(cell_date, '%Y-%m')) FILTER (reasons = '') AS accepted_first_period,
        max(strftime(cell_date, '%Y-%m')) FILTER (reasons = '') AS accepted_last_period,
        count(*) FILTER (reasons <> '') AS quarantined_cells,
        CASE WHEN count(*) FILTER (reasons = '') > 0 THEN 'partial_PIT_D' ELSE 'reexport_original' END AS decision
    FROM cells GROUP BY code""")
def code_profile(spark, sf_dir):
    return transforms.code_profile(cells(spark, sf_dir))


@query("ing_29_reason_counts", f"""
    WITH {CELLS}, r AS (SELECT unnest(string_split(reasons, ';')) AS reason FROM cells WHERE reasons <> '')
    SELECT reason, count(*) AS cells FROM r GROUP BY reason""")
def reason_counts(spark, sf_dir):
    return transforms.reason_counts(cells(spark, sf_dir))
