"""Shaping deliveries into observations: unpivot, parse, compress, derive."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.instants import day_start_utc, evaluated, with_period
from ..functions.ordered import newest, top_row, with_neighbours

TOLERANCE = 1e-12


def unpivot_matrix(matrix: DataFrame, keys: list[str], name: str = "header", value: str = "value") -> DataFrame:
    """Vintage matrix (one column per vintage) to one row per known cell."""
    columns = [c for c in matrix.columns if c not in keys]
    return matrix.unpivot(keys, columns, name, value).where(
        F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")))


def with_vintage(frame: DataFrame, header: str, prefix: str = "") -> DataFrame:
    """Vintage code (``<ID>65Q4``, ``99M3``, ``2001:M11``) to frequency, year, number, vintage_date.

    Two-digit years from 40 on are 19xx. Monthly vintages mean the month's end, quarterly
    ones the 15th of the quarter's middle month. All four are null for other text.
    """
    clean = F.translate(F.upper(F.trim(header)), ":-", "")
    bare = F.regexp_replace(clean, f"^{re.escape(prefix.upper())}", "") if prefix else clean
    pattern = r"(\d{2,4})([QM])(\d{1,2})$"
    short = F.col("_year")
    full = F.when(short >= 100, short).when(short >= 40, short + 1900).otherwise(short + 2000)
    valid = ((F.col("_kind") == "M") & F.col("_no").between(1, 12)) | ((F.col("_kind") == "Q") & F.col("_no").between(1, 4))
    day = F.when(F.col("frequency") == "M", F.last_day(F.make_date("year", "number", F.lit(1)))).otherwise(
        F.make_date("year", F.col("number") * 3 - 1, F.lit(15)))
    return (
        frame.withColumn("_code", bare)
        .withColumns({
            "_year": F.regexp_extract("_code", pattern, 1).try_cast("int"),
            "_kind": F.regexp_extract("_code", pattern, 2),
            "_no": F.regexp_extract("_code", pattern, 3).try_cast("int"),
        })
        .withColumns({"frequency": F.when(valid, F.col("_kind")), "year": F.when(valid, full),
                      "number": F.when(valid, F.col("_no"))})
        .withColumn("vintage_date", day)
        .drop("_code", "_year", "_kind", "_no")
    )


def dated_matrix(matrix: DataFrame, keys: list[str], prefix: str = "", value: str = "value") -> DataFrame:
    """Unpivoted matrix with each header's parsed vintage; unknown headers drop out.

    Headers are column names, so they are parsed once each in a frame of their own, not per cell.
    """
    names = [c for c in matrix.columns if c not in keys]
    headers = matrix.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("header"))
    parsed = with_vintage(headers, "header", prefix).where("vintage_date IS NOT NULL")
    return unpivot_matrix(matrix, keys, "header", value).join(parsed, "header")


def vintage_times(frame: DataFrame, date_column: str, zone: str) -> DataFrame:
    """Release at the vintage date's local midnight, usable one day later."""
    return frame.withColumns({
        "release_at": day_start_utc(F.col(date_column), zone),
        "available_at": day_start_utc(F.date_add(F.col(date_column), 1), zone),
    })


def edition_end(edition: Column) -> Column:
    """Edition label ``YYYYMM``, ``YYYY-MM[-..]`` or ``YYYYMmm`` to its month end."""
    clean = F.trim(edition)
    pattern = r"^(\d{4})(?:-|M)?(\d{1,2})(?:-.*)?$"
    packed = clean.rlike(r"^\d{6}$")
    parted = clean.rlike(r"^\d{4}[-M]\d{1,2}($|-)")
    year = F.regexp_extract(clean, pattern, 1).try_cast("int")
    month = F.regexp_extract(clean, pattern, 2).try_cast("int")
    known = F.when((packed | parted) & month.between(1, 12), month)
    return F.last_day(F.make_date(year, known, F.lit(1)))


def compressed(frame: DataFrame, keys: list[str], order: list[tuple[str, str]], value: str = "value",
               hot: DataFrame | None = None) -> DataFrame:
    """Keep a key's first row and rows whose value differs from the row before."""
    seen = with_neighbours(frame, keys, order, previous={"_previous": value}, hot=hot)
    return seen.where(
        F.col("_previous").isNull() | (F.abs(F.col(value) - F.col("_previous")) > TOLERANCE)).drop("_previous")


def editions_to_observations(rows: DataFrame, mapping: DataFrame, zone: str = "Europe/Paris",
                             hot: DataFrame | None = None) -> DataFrame:
    """Edition rows to compressed grade-B observations.

    ``mapping`` keys are (ref_area, freq, measure, unit_measure); its ``country`` overrides
    the reference area. Index sentinels and unparsable rows drop out.
    """
    reviewed = mapping.select(
        F.col("ref_area").alias("_area"), F.col("freq").alias("_freq"), F.col("measure").alias("_measure"),
        F.col("unit_measure").alias("_unit"), "canonical_series_id", "unit", "country")
    joined = rows.join(reviewed, (F.col("REF_AREA") == F.col("_area")) & (F.col("FREQ") == F.col("_freq"))
                       & (F.col("MEASURE") == F.col("_measure")) & (F.col("UNIT_MEASURE") == F.col("_unit")))
    typed = with_period(joined.select(
        F.coalesce("country", "REF_AREA").alias("country"), "canonical_series_id",
        F.concat_ws("|", "MEASURE", "UNIT_MEASURE").alias("source_series_id"), F.col("FREQ").alias("frequency"), "unit",
        F.col("OBS_VALUE").try_cast("double").alias("value"), edition_end(F.col("EDITION")).alias("edition_end"),
        "TIME_PERIOD",
    ), F.col("TIME_PERIOD"), F.col("frequency")).drop("TIME_PERIOD")
    parsed = evaluated(typed).where(
        F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
        & F.col("period").isNotNull() & F.col("edition_end").isNotNull()
        & ~((F.col("unit") == "index") & (F.col("value") <= 0)))
    timed = vintage_times(parsed, "edition_end", zone).withColumns({
        "pit_grade": F.lit("B"), "release_date_source": F.lit("edition_period_end")})
    return compressed(timed, ["country", "canonical_series_id", "period"],
                      [("available_at", "asc"), ("value", "asc")], hot=hot)


def last_of_month(daily: DataFrame, keys: list[str], date_column: str, columns: list[str],
                  closed_before: str | None = None) -> DataFrame:
    """Last observed day per key and month; days from ``closed_before`` on are not read.

    Pass the first day of the open month to leave that month out.
    """
    rows = daily
    if closed_before is not None:
        rows = rows.where(F.col(date_column) < F.lit(closed_before).cast("date"))
    best = rows.groupBy(*keys, F.last_day(date_column).alias("period_end")).agg(
        F.max(F.struct(date_column, *columns)).alias("_last"))
    return best.select(*keys, "period_end", *[F.col(f"_last.{c}").alias(c) for c in (date_column, *columns)])


def spread(frame: DataFrame, left: str, right: str, name: str, key: list[str], digits: int = 8,
           series: str = "canonical_series_id") -> DataFrame:
    """Series ``name`` = left - right, only where both legs exist."""
    def leg(which: str) -> Column:
        return F.max(F.when(F.col(series) == which, F.col("value")))
    legs = frame.where(F.col(series).isin(left, right)).groupBy(*key).agg(leg(left).alias("_l"), leg(right).alias("_r"))
    return legs.where("_l IS NOT NULL AND _r IS NOT NULL").select(
        *key, F.lit(name).alias(series), F.round(F.col("_l") - F.col("_r"), digits).alias("value"))


def last_in_batch(frame: DataFrame, keys: list[str] = ("source", "canonical_series_id", "period"),
                  sequence: str = "ingest_seq") -> DataFrame:
    """Last row per key in delivery order."""
    return top_row(frame, list(keys), newest(sequence))


def newest_periods(frame: DataFrame, n: int, keys: list[str] = ("canonical_series_id",),
                   ties: tuple[str, ...] = ()) -> DataFrame:
    """The ``n`` newest periods of each series (a map-side group limit)."""
    return top_row(frame, list(keys), newest("period_end", *ties), n)


def not_increasing(frame: DataFrame, code: str, date_column: str, sequence: str, hot: DataFrame | None = None) -> DataFrame:
    """Rows whose date does not exceed the one delivered just before for the same code."""
    seen = with_neighbours(frame, [code], [(sequence, "asc")], previous={"previous_date": date_column}, hot=hot)
    return seen.where(F.col(date_column) <= F.col("previous_date"))


def pivot_preview(frame: DataFrame, fields: list[str], index: str = "period") -> DataFrame:
    """Delivery preview: one row per period, one column per series."""
    return frame.groupBy(index).pivot("canonical_series_id", fields).agg(F.max("value"))


# Labels of the cell quarantine, in rule order.
def cell_reasons(first_seen: Column, start_period: str, blank_to_zero: bool = True) -> Column:
    """Why a vendor cell (code, cell_date, raw_value text, mapped, transformed, is_formula) is held back."""
    day, number = F.col("cell_date"), F.col("raw_value").try_cast("double")
    numeric = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    return F.array_compact(F.array(
        F.when(F.date_format(day, "yyyy-MM") < start_period, F.lit("before_requested_start")),
        F.when(day > first_seen.cast("date"), F.lit("future_observation_date")),
        F.when(day != F.last_day(day), F.lit("not_month_end")),
        F.when(F.col("transformed"), F.lit("transformed_series")),
        F.when(~F.col("mapped"), F.lit("unreviewed_mapping")),
        F.when(F.col("is_formula"), F.lit("formula_value")),
        F.when(~numeric, F.lit("missing_or_nonnumeric")).when(
            F.lit(blank_to_zero) & (number == 0), F.lit("ambiguous_zero_after_blank_fill")),
    ))


def code_profile(cells: DataFrame) -> DataFrame:
    """Per code: non-zero span, zero count, accepted / quarantined counts and a decision.

    ``cells`` has ``code, cell_date, raw_value, reasons``.
    """
    number = F.col("raw_value").try_cast("double")
    month = F.date_format("cell_date", "yyyy-MM")
    nonzero = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf")) & (number != 0)
    accepted = F.size("reasons") == 0
    return cells.groupBy("code").agg(
        F.min(F.when(nonzero, month)).alias("first_nonzero_period"),
        F.max(F.when(nonzero, month)).alias("last_nonzero_period"),
        F.count_if(number == 0).alias("numeric_zero_count"),
        F.count(F.lit(1)).alias("input_cells"),
        F.count_if(accepted).alias("accepted_cells"),
        F.min(F.when(accepted, month)).alias("accepted_first_period"),
        F.max(F.when(accepted, month)).alias("accepted_last_period"),
        F.count_if(~accepted).alias("quarantined_cells"),
        F.when(F.count_if(accepted) > 0, F.lit("partial_PIT_D")).otherwise(F.lit("reexport_original")).alias("decision"),
    )


def reason_counts(cells: DataFrame) -> DataFrame:
    return cells.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("cells"))
