"""Release-lag calibration and estimated availability of current-history rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.instants import LOCAL_ZONE, day_start_utc, evaluated, local_date, next_day_start_utc, text_to_utc
from ..functions.ordered import oldest, top_row
from .contracts import vendor_revision

KEY = ["canonical_series_id", "source", "period"]
RULE_VERSION = "estimated_availability_rules_v1"
OVERRIDE_VERSION = "estimated_availability_overrides_v1"


def first_releases(vintages: DataFrame, country: str = "CN", zone: str = LOCAL_ZONE) -> DataFrame:
    """First A/B release per (series, source, frequency, period) with its lag in local days."""
    known = vintages.where(
        (F.col("country") == country) & F.col("pit_grade").isin("A", "B") & F.col("release_at").isNotNull())
    first = known.groupBy("canonical_series_id", "source", "frequency", "period", "period_end").agg(
        F.min(F.struct("release_at", "pit_grade")).alias("_first"))
    day = local_date(F.col("_first.release_at"), zone)
    return first.select(
        "canonical_series_id", "source", "frequency", "period", "period_end",
        F.col("_first.release_at").alias("first_release_at"), F.col("_first.pit_grade").alias("first_grade"),
        day.alias("first_release_date"), F.datediff(day, F.col("period_end")).alias("lag_days"),
        F.dayofmonth(day).alias("release_day_of_month"))


def _ranked(values: DataFrame, keys: list[str], value: str, asked: dict[str, Column]) -> DataFrame:
    """Exact order statistics from counts per distinct value.

    The histogram has at most one row per key and distinct day count, so its window is
    bounded whatever the number of rows behind a key. ``asked`` maps a name to a 0-based
    index expression over ``n``; fractional indexes average the two neighbours.
    """
    counts = values.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    by_value = Window.partitionBy(*keys).orderBy(value)
    placed = counts.withColumns({
        "_upto": F.sum("_c").over(by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "n": F.sum("_c").over(Window.partitionBy(*keys)),
    })
    def at(index: Column) -> Column:
        # smallest value whose cumulative count passes the index
        return F.min(F.when(F.col("_upto") > index, F.col(value)))
    return placed.groupBy(*keys).agg(*[
        ((at(F.floor(index)) + at(F.ceil(index))) / F.lit(2.0)).alias(name) for name, index in asked.items()])


def lag_statistics(releases: DataFrame) -> DataFrame:
    """Per series: count, min, nearest p10 / p90, median, max, deviation, typical day of month.

    Nearest quantiles take the element at ``round(q * (n - 1))`` of the sorted lags.
    """
    keys = ["canonical_series_id"]
    n = F.col("n")
    lags = _ranked(releases, keys, "lag_days", {
        "p10_lag": F.round((n - 1) * F.lit(0.1)), "median_lag": (n - 1) / F.lit(2.0),
        "p90_lag": F.round((n - 1) * F.lit(0.9))})
    days = _ranked(releases, keys, "release_day_of_month", {"median_day_of_month": (n - 1) / F.lit(2.0)})
    plain = releases.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_periods"), F.min("lag_days").alias("min_lag"), F.max("lag_days").alias("max_lag"),
        F.round(F.stddev_samp("lag_days"), 6).alias("std_lag"), F.min("period").alias("first_period"),
        F.max("period").alias("last_period"))
    return plain.join(lags, keys).join(days, keys)


def estimable(vintages: DataFrame, country: str = "CN") -> DataFrame:
    """Grade-D rows of the country without dated vendor revisions."""
    return vintages.where((F.col("country") == country) & (F.col("pit_grade") == "D")
                          & ~vendor_revision(F.col("release_date_source")))


def estimated_availability(vintages: DataFrame, rules: DataFrame, country: str = "CN", zone: str = LOCAL_ZONE) -> DataFrame:
    """Virtual release date and availability by rule.

    Same-day series are usable at 09:30 local on the period end, others from the local
    midnight after ``lag_days``.
    """
    usable = rules.where("eligible").select(
        "canonical_series_id", "lag_days", "available_same_day", F.col("confidence").alias("rule_confidence"))
    rows = estimable(vintages, country).join(usable, "canonical_series_id")
    release = F.expr("date_add(period_end, lag_days)")
    return rows.withColumns({
        "estimated_release_date": release,
        "estimated_available_at": F.when(F.col("available_same_day"), day_start_utc(F.col("period_end"), zone, "09:30"))
        .otherwise(next_day_start_utc(release, zone)),
        "availability_method": F.lit("estimated"), "availability_rule_version": F.lit(RULE_VERSION),
    }).drop("lag_days", "available_same_day")


def skipped(vintages: DataFrame, rules: DataFrame, country: str = "CN") -> DataFrame:
    """Why grade-D rows got no estimate: documented revisions, or the series without a usable rule."""
    rows = vintages.where((F.col("country") == country) & (F.col("pit_grade") == "D"))
    usable = rules.where("eligible").select("canonical_series_id", F.lit(True).alias("_usable"))
    reason = F.when(vendor_revision(F.col("release_date_source")), F.lit("DOCUMENTED_WIND_REVISIONS")).when(
        F.col("_usable").isNull(), F.col("canonical_series_id"))
    return rows.join(usable, "canonical_series_id", "left").withColumn("reason", reason).where(
        "reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def with_overrides(estimates: DataFrame, overrides: DataFrame, zone: str = LOCAL_ZONE, offset: str = "+08:00") -> DataFrame:
    """Replace estimates by reviewed instants, keeping what contradicts them in ``override_error``."""
    # instants are parsed once per override, before rows multiply
    anchors = evaluated(overrides.select(
        *KEY, F.col("value").alias("_value"), F.col("available_at").alias("_text"),
        text_to_utc(F.col("available_at"), zone).alias("_at"))).withColumn("_day", local_date(F.col("_at"), zone))
    joined = estimates.join(anchors, KEY, "left")
    at, day, hit = F.col("_at"), F.col("_day"), F.col("_text").isNotNull()
    error = F.when(hit & (F.abs(F.col("value") - F.col("_value")) > 1e-9), F.lit("value_mismatch")).when(
        hit & ~F.endswith(F.col("_text"), F.lit(offset)), F.lit("not_local_offset")).when(
        hit & (day <= F.col("period_end")), F.lit("precedes_period"))
    return joined.withColumns({
        "override_error": error,
        "estimated_available_at": F.when(hit, at).otherwise(F.col("estimated_available_at")),
        "estimated_release_date": F.when(hit, day).otherwise(F.col("estimated_release_date")),
        "availability_method": F.when(hit, F.lit("official_dated_wind_value")).otherwise(F.col("availability_method")),
        "availability_rule_version": F.when(hit, F.lit(OVERRIDE_VERSION)).otherwise(F.col("availability_rule_version")),
        "rule_confidence": F.when(hit, F.lit("high")).otherwise(F.col("rule_confidence")),
    }).drop("_value", "_text", "_at", "_day")


def unused_overrides(estimates: DataFrame, overrides: DataFrame) -> DataFrame:
    return overrides.join(estimates.select(*KEY).distinct(), KEY, "left_anti")


def duplicate_overrides(overrides: DataFrame) -> DataFrame:
    """Keys an override file names twice: must be empty."""
    return overrides.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def with_pre_revision_values(estimates: DataFrame, pre_revision: DataFrame) -> DataFrame:
    """Use the value visible before a dated revision where the estimate precedes it."""
    before = top_row(pre_revision, KEY, oldest("revision_at", "pre_revision_value"))
    joined = estimates.join(before, KEY, "left")
    early = F.coalesce(F.col("estimated_available_at") < F.col("revision_at"), F.lit(False))
    return joined.withColumns({
        "value": F.when(early, F.col("pre_revision_value")).otherwise(F.col("value")),
        "vintage_status": F.when(early, F.lit("pre_revision_snapshot")).otherwise(F.lit("latest_snapshot")),
    }).drop("pre_revision_value", "revision_at")


def coverage(estimates: DataFrame) -> DataFrame:
    return estimates.groupBy("canonical_series_id", "source", "rule_confidence").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("period").alias("first_period"),
        F.max("period").alias("last_period"))
