"""Contract checks on deliveries with defects injected row by row."""

from pyspark.sql import functions as F

from ..functions.instants import day_start_utc, instant, next_day_start_utc, normalize_as_of, text_to_utc
from ..operators import contracts
from ..plans.policy import scope_filter, without_inactive
from . import query
from .fixture import REGISTRY, V, inactive, vintages


def deliveries(spark, sf_dir):
    """Vintages as a careless source would send them."""
    return vintages(spark, sf_dir).withColumns({
        "country": F.expr("CASE WHEN ingest_seq % 2 = 0 THEN lower(country) ELSE country END"),
        "source": F.expr("CASE WHEN ingest_seq % 6 = 0 THEN lower(source) ELSE source END"),
        "pit_grade": F.expr("CASE WHEN ingest_seq % 101 = 0 THEN 'X' WHEN ingest_seq % 3 = 0 THEN lower(pit_grade) ELSE pit_grade END"),
        "series_name": F.expr("CASE WHEN ingest_seq % 89 <> 0 THEN series_name END"),
        "unit": F.expr("CASE WHEN ingest_seq % 178 <> 0 THEN unit END"),
        "value": F.expr("CASE WHEN ingest_seq % 103 = 0 THEN double('NaN') WHEN ingest_seq % 107 = 0 THEN double('-Infinity') ELSE value END"),
        "release_at": F.expr("CASE WHEN ingest_seq % 83 <> 0 THEN release_at END"),
        "available_at": F.expr("CASE WHEN ingest_seq % 79 = 0 THEN available_at - interval 1 day ELSE available_at END"),
    })


DELIVERIES = f"""
    {V},
    d0 AS (SELECT * REPLACE (
        upper(CASE WHEN ingest_seq % 101 = 0 THEN 'X' WHEN ingest_seq % 3 = 0 THEN lower(pit_grade) ELSE pit_grade END) AS pit_grade,
        CASE WHEN ingest_seq % 89 <> 0 THEN series_name END AS series_name,
        CASE WHEN ingest_seq % 178 <> 0 THEN unit END AS unit,
        CASE WHEN ingest_seq % 103 = 0 THEN 'NaN'::DOUBLE WHEN ingest_seq % 107 = 0 THEN '-Infinity'::DOUBLE ELSE value END AS value,
        CASE WHEN ingest_seq % 83 <> 0 THEN release_at END AS release_at,
        CASE WHEN ingest_seq % 79 = 0 THEN available_at - to_days(1) ELSE available_at END AS available_at) FROM v),
    d AS (SELECT *, concat_ws(';',
        CASE WHEN series_name IS NULL THEN 'missing_series_name' END,
        CASE WHEN unit IS NULL THEN 'missing_unit' END,
        CASE WHEN pit_grade NOT IN ('A', 'B', 'C', 'D') THEN 'invalid_pit_grade' END,
        CASE WHEN pit_grade IN ('A', 'B', 'C') AND release_at IS NULL THEN 'release_at_required' END,
        CASE WHEN pit_grade IN ('A', 'B') AND trim(raw_sha256) IN ('', 'N/A', '...') THEN 'raw_sha256_required' END,
        CASE WHEN NOT isfinite(value) THEN 'value_not_finite' END,
        CASE WHEN pit_grade = 'D' AND available_at < first_seen_at
                  AND NOT starts_with(coalesce(release_date_source, ''), 'wind_revision_snapshot_')
             THEN 'available_before_first_seen' END,
        CASE WHEN available_at < release_at THEN 'available_before_release' END) AS reasons FROM d0)
"""


def _only(spark, sf_dir, *labels):
    rows = contracts.checked(deliveries(spark, sf_dir)).where(
        F.arrays_overlap("reasons", F.array(*[F.lit(x) for x in labels])))
    return rows.select("ingest_seq", "country", "source", "pit_grade", F.array_join("reasons", ";").alias("reasons"))


def _only_sql(*labels):
    test = " OR ".join(f"list_contains(string_split(reasons, ';'), '{x}')" for x in labels)
    return f"WITH {DELIVERIES} SELECT ingest_seq, country, source, pit_grade, reasons FROM d WHERE {test}"


for _name, _labels in {
    "con_01_required_fields": ("missing_series_name", "missing_unit"),
    "con_02_grade_domain": ("invalid_pit_grade",),
    "con_03_release_and_hash": ("release_at_required", "raw_sha256_required"),
    "con_04_finite_value": ("value_not_finite",),
    "con_05_first_seen_order": ("available_before_first_seen",),
    "con_06_release_order": ("available_before_release",),
}.items():
    query(_name, _only_sql(*_labels))(lambda spark, sf_dir, _labels=_labels: _only(spark, sf_dir, *_labels))


@query("con_02_normalized_codes", f"""
    WITH {DELIVERIES} SELECT country, source, pit_grade, count(*) AS rows FROM d GROUP BY ALL""")
def normalized_codes(spark, sf_dir):
    return contracts.normalized(deliveries(spark, sf_dir)).groupBy("country", "source", "pit_grade").agg(
        F.count(F.lit(1)).alias("rows"))


# one text per order: with an offset, with Z, or local
_TEXT = """CASE ingest_seq % 4
    WHEN 0 THEN concat(replace(cast(available_at AS string), ' ', 'T'), '+08:00')
    WHEN 1 THEN concat(replace(cast(available_at AS string), ' ', 'T'), 'Z')
    WHEN 2 THEN concat(cast(available_at AS string), '-05:30')
    ELSE cast(available_at AS string) END"""


@query("con_07_timestamp_normalization", f"""
    WITH {V} SELECT ingest_seq, CASE ingest_seq % 4 WHEN 0 THEN available_at - to_hours(8) WHEN 1 THEN available_at
                                     WHEN 2 THEN available_at + to_hours(5) + to_minutes(30)
                                     ELSE available_at - to_hours(8) END AS instant FROM v""")
def timestamp_normalization(spark, sf_dir):
    return vintages(spark, sf_dir).select("ingest_seq", text_to_utc(F.expr(_TEXT)).alias("instant"))


@query("con_08_date_only_cutoff", f"""
    WITH {V} SELECT country, count(*) AS visible FROM v
    WHERE available_at <= TIMESTAMP '1999-02-28 15:59:59.999999' GROUP BY country""")
def date_only_cutoff(spark, sf_dir):
    v = vintages(spark, sf_dir)
    return v.where(F.col("available_at") <= instant(v, "available_at", normalize_as_of("1999-02-28"))).groupBy(
        "country").agg(F.count(F.lit(1)).alias("visible"))


@query("con_09_next_day_availability", f"""
    WITH {V} SELECT ingest_seq, CAST(period_end + 1 AS TIMESTAMP) - to_hours(8) AS usable_at,
                    CAST(period_end AS TIMESTAMP) - to_hours(8) AS local_midnight FROM v""")
def next_day_availability(spark, sf_dir):
    return vintages(spark, sf_dir).select(
        "ingest_seq", next_day_start_utc(F.col("period_end")).alias("usable_at"),
        day_start_utc(F.col("period_end")).alias("local_midnight"))


@query("con_10_quarantine_histogram", f"""
    WITH {DELIVERIES}, r AS (SELECT unnest(string_split(reasons, ';')) AS reason FROM d WHERE reasons <> '')
    SELECT reason, count(*) AS rows FROM r GROUP BY reason""")
def quarantine_histogram(spark, sf_dir):
    return contracts.reason_histogram(deliveries(spark, sf_dir))


@query("con_10_quarantine_accepted", f"""
    WITH {DELIVERIES} SELECT ingest_seq, pit_grade, value, available_at FROM d WHERE reasons = ''""")
def quarantine_accepted(spark, sf_dir):
    accepted, _ = contracts.quarantine(deliveries(spark, sf_dir))
    return accepted.select("ingest_seq", "pit_grade", "value", "available_at")


@query("con_11_scopes", f"""
    WITH {V} SELECT 'CN' AS scope, count(*) AS rows FROM v WHERE country = 'CN'
    UNION ALL SELECT 'US', count(*) FROM v WHERE country = 'US'
    UNION ALL SELECT 'GLB', count(*) FROM v WHERE country NOT IN ('CN', 'US')
    UNION ALL SELECT 'ALL', count(*) FROM v""")
def scopes(spark, sf_dir):
    v = vintages(spark, sf_dir)
    counts = v.agg(*[F.count_if(scope_filter(s)).alias(s) for s in ("CN", "US", "GLB", "ALL")])
    return counts.unpivot([], ["CN", "US", "GLB", "ALL"], "scope", "rows")


@query("con_12_retired_series", f"""
    WITH {V}, {REGISTRY} SELECT canonical_series_id, count(*) AS rows FROM v
    WHERE canonical_series_id NOT IN (SELECT canonical_series_id FROM registry WHERE NOT active) GROUP BY ALL""")
def retired_series(spark, sf_dir):
    return without_inactive(vintages(spark, sf_dir), inactive(spark)).groupBy("canonical_series_id").agg(
        F.count(F.lit(1)).alias("rows"))


@query("con_13_period_range", f"""
    WITH {V} SELECT canonical_series_id, period, count(*) AS rows FROM v
    WHERE period_end BETWEEN DATE '1997-03-31' AND DATE '1998-02-28' GROUP BY ALL""")
def period_range(spark, sf_dir):
    from ..operators.asof import in_periods
    return in_periods(vintages(spark, sf_dir), "1997-03-31", "1998-02-28").groupBy("canonical_series_id", "period").agg(
        F.count(F.lit(1)).alias("rows"))


def mapping(spark):
    """Reviewed code mapping: fixed dimension, without some codes and with some outdated names."""
    return spark.range(20).selectExpr(
        "concat('X', id) AS code", "concat('M_', id) AS canonical_series_id",
        "concat('Series ', id) AS expected_name",
        "CASE WHEN id = 3 THEN 'idx' ELSE 'pct' END AS expected_unit",
        "CASE WHEN id % 4 = 3 THEN 'Q' ELSE 'M' END AS expected_frequency",
        "CASE WHEN id % 2 = 0 THEN 0.5D ELSE 4.0D END AS scale")


MAPPING = """mapping AS (SELECT 'X' || id AS code, 'M_' || id AS mapped_series_id, 'Series ' || id AS expected_name,
    CASE WHEN id = 3 THEN 'idx' ELSE 'pct' END AS expected_unit, CASE WHEN id % 4 = 3 THEN 'Q' ELSE 'M' END AS expected_frequency,
    CASE WHEN id % 2 = 0 THEN 0.5::DOUBLE ELSE 4.0::DOUBLE END AS scale FROM range(20) t(id))"""


@query("con_14_mapping_contract", f"""
    WITH {V}, {MAPPING}
    SELECT ingest_seq, mapped_series_id, CASE WHEN m.code IS NULL THEN 'unmapped'
             WHEN series_name = expected_name AND unit = expected_unit AND frequency = expected_frequency THEN 'ok'
             ELSE 'changed' END AS mapping_status
    FROM v LEFT JOIN mapping m ON m.code = v.source_series_id""")
def mapping_contract(spark, sf_dir):
    return contracts.mapped(vintages(spark, sf_dir), mapping(spark)).select(
        "ingest_seq", "mapped_series_id", "mapping_status")


@query("con_15_unit_conversion", f"""
    WITH {V}, {MAPPING} SELECT ingest_seq, value * coalesce(scale, 1.0) AS value
    FROM v LEFT JOIN mapping m ON m.code = v.source_series_id""")
def unit_conversion(spark, sf_dir):
    return contracts.rescaled(contracts.mapped(vintages(spark, sf_dir), mapping(spark))).select("ingest_seq", "value")


@query("con_16_sentinels", f"""
    WITH {V} SELECT ingest_seq, unit, value FROM v WHERE NOT (unit = 'idx' AND value <= 0)""")
def sentinels(spark, sf_dir):
    return contracts.without_sentinels(vintages(spark, sf_dir), "idx").select("ingest_seq", "unit", "value")


@query("con_17_lookback", f"""
    WITH {V} SELECT ingest_seq, period FROM v WHERE period_start >= DATE '2000-03-01'""")
def lookback(spark, sf_dir):
    return contracts.within_lookback(vintages(spark, sf_dir), "2001-06-15", 15).select("ingest_seq", "period")


@query("con_18_minimum_rows", f"""
    WITH {V}, wanted AS (SELECT DISTINCT s.source, v.period FROM v, (VALUES ('OFF1'), ('SAFE'), ('SILENT')) s(source)),
    n AS (SELECT source, period, count(*) AS rows FROM v GROUP BY source, period)
    SELECT source, period, coalesce(rows, 0) AS rows FROM wanted FULL JOIN n USING (source, period) WHERE coalesce(rows, 0) < 12""")
def minimum_rows(spark, sf_dir):
    v = vintages(spark, sf_dir)
    # one of the sources that ought to deliver every period is silent altogether
    wanted = v.select("period").distinct().select(F.explode(F.array(*map(F.lit, ("OFF1", "SAFE", "SILENT")))).alias("source"), "period")
    return contracts.too_few_rows(v, 12, ["source", "period"], wanted)
