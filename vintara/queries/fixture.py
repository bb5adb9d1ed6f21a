"""Vintages derived from the ``orders`` table, in Spark and as a SQL common table.

One vintage per order; every column is an expression over one row, so the derivation adds
no shuffle to the query under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SERIES = {
    **{s: "CN" for s in range(0, 12)},
    **{s: "US" for s in range(12, 16)},
    **{s: "DEU" for s in range(16, 20)},
    **{s: "GLB" for s in range(20, 24)},
}
FIELDS = [f"{c}_S{s}" for s, c in SERIES.items()]
SAFE_SERIES = "CN_S11"
INACTIVE = ["CN_S4", "US_S13"]


def fields(*countries: str, active: bool = True) -> list[str]:
    return sorted(
        f"{c}_S{s}" for s, c in SERIES.items()
        if c in countries and not (active and f"{c}_S{s}" in INACTIVE)
    )


# Declared schemas: a scan then needs no job to look into file footers.
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
}

SPREAD_ROWS = 50_000  # rows of one task in jobs that do heavy work per row


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
          spread_by: str | None = None) -> DataFrame:
    """Scan of a driver table.

    ``spread_by`` is for jobs that do heavy work per row: a scan with fewer splits than
    cores, or than one for ``SPREAD_ROWS`` rows, is then spread over so many tasks, so that the
    longest task does not grow with the table. Scans with enough splits stay as they are.
    """
    frame = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    counted, frame = frame, frame.select(*columns) if columns else frame
    if spread_by is not None:
        # the count is read from file footers
        tasks = max(spark.sparkContext.defaultParallelism, -(-counted.count() // SPREAD_ROWS))
        if frame.rdd.getNumPartitions() < tasks:
            frame = frame.repartition(tasks, spread_by)
    return frame


def vintages(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The fact frame; the same plan object is handed out again within a session."""
    key = (spark.sparkContext.applicationId, sf_dir, spread)
    if key not in _PLANS:
        _PLANS[key] = _vintages(spark, sf_dir, spread)
    return _PLANS[key]


_PLANS: dict[tuple, DataFrame] = {}


def _vintages(spark: SparkSession, sf_dir: str, spread: bool) -> DataFrame:
    base = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"],
                 "o_orderkey" if spread else None).selectExpr(
        "o_orderkey AS k", "cast(o_custkey % 24 AS int) AS s", "cast(o_orderdate AS date) AS d",
        "o_orderpriority AS priority",
        "cast(CASE WHEN o_orderkey % 20 < 10"
        " AND (o_custkey % 24 + year(o_orderdate) * 12 + month(o_orderdate)) % 3 = 0"
        " THEN 12 ELSE o_orderkey % 20 END AS int) AS jj",
    ).selectExpr(
        "k", "s", "jj", "priority",
        "CASE WHEN s % 4 = 3 THEN trunc(d, 'QUARTER') ELSE trunc(d, 'MONTH') END AS period_start",
        "CASE WHEN s % 4 = 3 THEN last_day(add_months(trunc(d, 'QUARTER'), 2)) ELSE last_day(d) END AS period_end",
        "CASE WHEN s < 12 THEN 'CN' WHEN s < 16 THEN 'US' WHEN s < 20 THEN 'DEU' ELSE 'GLB' END AS country",
        "CASE WHEN jj <= 5 THEN 'A' WHEN jj <= 9 THEN 'B' WHEN jj = 10 THEN 'C' ELSE 'D' END AS pit_grade",
        "CASE WHEN jj <= 5 OR (jj = 16 AND s < 20) THEN 'OFF1' WHEN jj <= 10 THEN 'OFF2' "
        "WHEN jj <= 14 AND s = 11 THEN 'SAFE' WHEN jj <= 15 THEN 'WIND' "
        "WHEN jj = 17 THEN 'EASTMONEY_MACRO' WHEN jj = 18 THEN 'SINA_MACRO' ELSE 'IMF' END AS source",
        "CASE WHEN jj = 15 THEN 'wind_revision_snapshot_x' WHEN jj = 16 THEN 'official_web_revision_first_seen' "
        "WHEN jj IN (17, 18) THEN 'third_party_current_history_first_seen_only' "
        "WHEN jj = 19 THEN 'imf_current_history_snapshot_x' "
        "WHEN jj <= 10 THEN 'official_page_date' END AS release_date_source",
        "cast(k * 13 % 90 * 24 + k * 5 % 24 AS int) * interval '1' hour AS lag",
    ).selectExpr(
        # one struct per order: filters on generated columns stay above this point instead of
        # being unfolded into the scan, where they would outgrow compiled code
        "inline(array(struct(k, s, jj, priority, period_start, period_end, country, pit_grade, source,"
        " release_date_source, concat(country, '_S', s) AS canonical_series_id,"
        " cast(period_end AS timestamp_ntz) + lag AS available_at)))",
    ).selectExpr(
        "*",
        "CASE WHEN s % 4 = 3 THEN 'Q' ELSE 'M' END AS frequency",
        "CASE WHEN s % 4 = 3 THEN concat(year(period_start), '-Q', quarter(period_start)) "
        "ELSE substring(cast(period_start AS string), 1, 7) END AS period",
        "CASE WHEN jj <= 10 THEN available_at END AS release_at",
        "CASE WHEN jj = 15 THEN available_at + interval '400' day ELSE available_at END AS first_seen_at",
        "cast((k div 8) % 4 AS int) AS vintage_no",
    )
    return base.selectExpr(
        "country", "source", "canonical_series_id",
        "concat('X', s) AS source_series_id",
        "concat('Series ', s, CASE WHEN k % 41 = 0 THEN ' (old)' ELSE '' END) AS series_name",
        "frequency",
        "CASE WHEN s = 5 AND k % 50 = 0 THEN 'idx' ELSE 'pct' END AS unit",
        "CASE s % 3 WHEN 0 THEN 'SA' WHEN 1 THEN 'NSA' END AS seasonal_adjustment",
        "period", "period_start", "period_end",
        "cast(k % 7 AS double) / 2 AS value",
        "release_at", "release_date_source", "first_seen_at", "available_at", "vintage_no",
        "CASE WHEN vintage_no = 0 THEN 'initial' WHEN k % 3 = 0 THEN 'metadata_update' ELSE 'revision' END AS revision_type",
        "CASE WHEN vintage_no = 0 THEN NULL WHEN k % 3 = 0 THEN cast(0 AS double) "
        "ELSE cast(k % 23 - 11 AS double) / 2 END AS revision_delta",
        "pit_grade",
        "concat('u', k % 3) AS source_url",
        "concat('raw/', k % 211) AS raw_file",
        "CASE WHEN k % 97 = 0 THEN 'N/A' ELSE concat('sha', k) END AS raw_sha256",
        "first_seen_at + cast(k % 5 AS int) * interval '1' hour AS retrieved_at",
        "concat('v', k % 3) AS parser_version",
        "k AS ingest_seq",
        "priority",
    )


# The same rows as a DuckDB common table; use as f"WITH {V} SELECT ... FROM v".
V = """
v0 AS (SELECT o_orderkey AS k, CAST(o_custkey % 24 AS INTEGER) AS s, CAST(o_orderkey % 20 AS INTEGER) AS j,
              CAST(o_orderdate AS DATE) AS d, o_orderpriority AS priority FROM orders),
v1 AS (SELECT *, CASE WHEN s % 4 = 3 THEN 'Q' ELSE 'M' END AS frequency,
              CASE WHEN s < 12 THEN 'CN' WHEN s < 16 THEN 'US' WHEN s < 20 THEN 'DEU' ELSE 'GLB' END AS country,
              CASE WHEN j < 10 AND (s + year(d) * 12 + month(d)) % 3 = 0 THEN 12 ELSE j END AS jj FROM v0),
v2 AS (SELECT *, country || '_S' || s AS canonical_series_id,
              CAST(date_trunc(CASE WHEN frequency = 'Q' THEN 'quarter' ELSE 'month' END, d) AS DATE) AS period_start,
              CASE WHEN jj <= 5 THEN 'A' WHEN jj <= 9 THEN 'B' WHEN jj = 10 THEN 'C' ELSE 'D' END AS pit_grade,
              CASE WHEN jj <= 5 OR (jj = 16 AND s < 20) THEN 'OFF1' WHEN jj <= 10 THEN 'OFF2'
                   WHEN jj <= 14 AND s = 11 THEN 'SAFE' WHEN jj <= 15 THEN 'WIND'
                   WHEN jj = 17 THEN 'EASTMONEY_MACRO' WHEN jj = 18 THEN 'SINA_MACRO' ELSE 'IMF' END AS source,
              CASE WHEN jj = 15 THEN 'wind_revision_snapshot_x' WHEN jj = 16 THEN 'official_web_revision_first_seen'
                   WHEN jj IN (17, 18) THEN 'third_party_current_history_first_seen_only'
                   WHEN jj = 19 THEN 'imf_current_history_snapshot_x'
                   WHEN jj <= 10 THEN 'official_page_date' END AS release_date_source FROM v1),
v3 AS (SELECT *, CASE WHEN frequency = 'Q' THEN last_day(CAST(period_start + INTERVAL 2 MONTH AS DATE))
                      ELSE last_day(period_start) END AS period_end,
              CASE WHEN frequency = 'Q' THEN strftime(period_start, '%Y') || '-Q' || quarter(period_start)
                   ELSE strftime(period_start, '%Y-%m') END AS period FROM v2),
v4 AS (SELECT *, CAST(period_end AS TIMESTAMP) + to_days(CAST(k * 13 % 90 AS INTEGER))
                 + to_hours(CAST(k * 5 % 24 AS INTEGER)) AS available_at FROM v3),
v AS (SELECT country, source, canonical_series_id, 'X' || s AS source_series_id,
             'Series ' || s || CASE WHEN k % 41 = 0 THEN ' (old)' ELSE '' END AS series_name, frequency,
             CASE WHEN s = 5 AND k % 50 = 0 THEN 'idx' ELSE 'pct' END AS unit,
             CASE s % 3 WHEN 0 THEN 'SA' WHEN 1 THEN 'NSA' END AS seasonal_adjustment,
             period, period_start, period_end, CAST(k % 7 AS DOUBLE) / 2 AS value,
             CASE WHEN pit_grade <> 'D' THEN available_at END AS release_at, release_date_source,
             CASE WHEN jj = 15 THEN available_at + to_days(400) ELSE available_at END AS first_seen_at,
             available_at, CAST((k // 8) % 4 AS INTEGER) AS vintage_no,
             CASE WHEN (k // 8) % 4 = 0 THEN 'initial' WHEN k % 3 = 0 THEN 'metadata_update'
                  ELSE 'revision' END AS revision_type,
             CASE WHEN (k // 8) % 4 = 0 THEN NULL WHEN k % 3 = 0 THEN 0.0::DOUBLE
                  ELSE CAST(k % 23 - 11 AS DOUBLE) / 2 END AS revision_delta,
             pit_grade, 'u' || (k % 3) AS source_url, 'raw/' || (k % 211) AS raw_file,
             CASE WHEN k % 97 = 0 THEN 'N/A' ELSE 'sha' || k END AS raw_sha256,
             CASE WHEN jj = 15 THEN available_at + to_days(400) ELSE available_at END
                 + to_hours(CAST(k % 5 AS INTEGER)) AS retrieved_at,
             'v' || (k % 3) AS parser_version, k AS ingest_seq, priority FROM v4)
"""


def sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated availability: one row per (series, source, period) of the vendor sources."""
    return (
        vintages(spark, sf_dir)
        .where("country = 'CN' AND source IN ('WIND', 'SAFE')")
        .groupBy("canonical_series_id", "source", "period", "period_end")
        .agg(F.max("value").alias("value"))
        .withColumn("estimated_available_at", F.expr("cast(period_end AS timestamp_ntz) + interval 12 days"))
    )


SIDECAR = """
side AS (SELECT canonical_series_id, source, period, period_end, max(value) AS value,
                CAST(period_end AS TIMESTAMP) + to_days(12) AS estimated_available_at
         FROM v WHERE country = 'CN' AND source IN ('WIND', 'SAFE')
         GROUP BY canonical_series_id, source, period, period_end)
"""


def rules(spark: SparkSession) -> DataFrame:
    """Availability rule per series: a fixed 24-row dimension."""
    return spark.range(24).selectExpr(
        "concat(CASE WHEN id < 12 THEN 'CN' WHEN id < 16 THEN 'US' WHEN id < 20 THEN 'DEU' ELSE 'GLB' END, '_S', id)"
        " AS canonical_series_id",
        "CASE WHEN id % 4 = 3 THEN 'Q' ELSE 'M' END AS frequency",
        "cast(20 + id AS int) AS lag_days",
        "id % 4 = 0 AS available_same_day",
        "CASE id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence",
        "id % 7 <> 1 AS eligible",
    ).where("canonical_series_id <> 'CN_S8'")


RULES = """
rules AS (SELECT CASE WHEN id < 12 THEN 'CN' WHEN id < 16 THEN 'US' WHEN id < 20 THEN 'DEU' ELSE 'GLB' END
                 || '_S' || id AS canonical_series_id,
                 CASE WHEN id % 4 = 3 THEN 'Q' ELSE 'M' END AS frequency, CAST(20 + id AS INTEGER) AS lag_days,
                 id % 4 = 0 AS available_same_day,
                 CASE id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence,
                 id % 7 <> 1 AS eligible FROM range(24) t(id) WHERE id <> 8)
"""


def inactive(spark: SparkSession) -> DataFrame:
    return registry(spark).where("NOT active").select("canonical_series_id")


def registry(spark: SparkSession) -> DataFrame:
    """Series registry: the 24 fixture series and two that hold no data."""
    return spark.range(26).selectExpr(
        "concat(CASE WHEN id < 12 THEN 'CN' WHEN id < 16 THEN 'US' WHEN id < 20 THEN 'DEU' "
        "WHEN id < 24 THEN 'GLB' ELSE 'CN' END, '_S', id) AS canonical_series_id",
        "CASE WHEN id < 12 THEN 'CN' WHEN id < 16 THEN 'US' WHEN id < 20 THEN 'DEU' "
        "WHEN id < 24 THEN 'GLB' ELSE 'CN' END AS country",
        "CASE WHEN id % 2 = 0 THEN 'OFF1' ELSE 'OFF2' END AS source",
        "CASE WHEN id % 4 = 3 THEN 'Q' ELSE 'M' END AS frequency",
        "'pct' AS unit",
        "id NOT IN (4, 13) AS active",
    )


REGISTRY = """
registry AS (SELECT CASE WHEN id < 12 THEN 'CN' WHEN id < 16 THEN 'US' WHEN id < 20 THEN 'DEU'
                         WHEN id < 24 THEN 'GLB' ELSE 'CN' END || '_S' || id AS canonical_series_id,
                    CASE WHEN id < 12 THEN 'CN' WHEN id < 16 THEN 'US' WHEN id < 20 THEN 'DEU'
                         WHEN id < 24 THEN 'GLB' ELSE 'CN' END AS country,
                    CASE WHEN id % 2 = 0 THEN 'OFF1' ELSE 'OFF2' END AS source,
                    CASE WHEN id % 4 = 3 THEN 'Q' ELSE 'M' END AS frequency, 'pct' AS unit,
                    id NOT IN (4, 13) AS active FROM range(26) t(id))
"""
