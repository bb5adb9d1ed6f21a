"""What a delivered observation must satisfy before it may be appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.instants import period_index
from ..plans.policy import VENDOR_REVISION
from ..schema import REQUIRED_COLUMNS

GRADES = ("A", "B", "C", "D")
NO_HASH = ("", "N/A", "...")


class ContractError(ValueError):
    """A delivery broke its contract."""


def normalized(frame: DataFrame) -> DataFrame:
    """Upper-case country, source and grade."""
    return frame.withColumns({c: F.upper(c) for c in ("country", "source", "pit_grade")})


def finite(column: Column) -> Column:
    return ~F.isnan(column) & (F.abs(column) < float("inf"))


def vendor_revision(marker: Column) -> Column:
    return F.coalesce(marker, F.lit("")).startswith(VENDOR_REVISION)


def reasons(frame: DataFrame) -> Column:
    """Labels of all broken rules of a normalized row, in rule order."""
    grade = F.col("pit_grade")
    present = [c for c in REQUIRED_COLUMNS if c in frame.columns]
    absent = [c for c in REQUIRED_COLUMNS if c not in frame.columns]
    rules: list[Column] = [F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in present]
    rules += [F.lit(f"missing_{c}") for c in absent]
    rules += [
        F.when(~grade.isin(*GRADES), F.lit("invalid_pit_grade")),
        F.when(grade.isin("A", "B", "C") & F.col("release_at").isNull(), F.lit("release_at_required")),
        F.when(grade.isin("A", "B") & F.trim("raw_sha256").isin(*NO_HASH), F.lit("raw_sha256_required")),
        F.when(~finite(F.col("value")), F.lit("value_not_finite")),
        F.when((grade == "D") & (F.col("available_at") < F.col("first_seen_at"))
               & ~vendor_revision(F.col("release_date_source")), F.lit("available_before_first_seen")),
        F.when(F.col("available_at") < F.col("release_at"), F.lit("available_before_release")),
    ]
    return F.array_compact(F.array(*rules))


def checked(frame: DataFrame) -> DataFrame:
    """Normalized rows with their ``reasons``."""
    rows = normalized(frame)
    return rows.withColumn("reasons", reasons(rows))


def quarantine(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) rows; the latter keep their reasons."""
    rows = checked(frame)
    return rows.where(F.size("reasons") == 0).drop("reasons"), rows.where(F.size("reasons") > 0)


def accepted_or_raise(frame: DataFrame) -> DataFrame:
    """Batch mode: one broken row rejects the whole delivery."""
    accepted, bad = quarantine(frame)
    worst = bad.groupBy(F.array_join("reasons", ";").alias("reasons")).count().orderBy(F.desc("count"), "reasons").limit(5)
    found = worst.collect()
    if found:
        raise ContractError("; ".join(f"{row['reasons']} x{row['count']}" for row in found))
    return accepted


def reason_histogram(frame: DataFrame) -> DataFrame:
    return checked(frame).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows"))


def mapped(frame: DataFrame, mapping: DataFrame, code: str = "source_series_id") -> DataFrame:
    """Attach the reviewed mapping of a vendor code and say whether its metadata still holds.

    ``mapping`` has ``code, canonical_series_id, expected_name, expected_unit,
    expected_frequency, scale``. ``mapping_status`` is unmapped, changed or ok.
    """
    reviewed = mapping.select(
        F.col("code").alias(code), F.col("canonical_series_id").alias("mapped_series_id"), "expected_name",
        "expected_unit", "expected_frequency", "scale")
    same = (
        F.col("series_name").eqNullSafe(F.col("expected_name")) & F.col("unit").eqNullSafe(F.col("expected_unit"))
        & F.col("frequency").eqNullSafe(F.col("expected_frequency"))
    )
    return frame.join(reviewed, code, "left").withColumn(
        "mapping_status",
        F.when(F.col("mapped_series_id").isNull(), F.lit("unmapped")).when(same, F.lit("ok")).otherwise(F.lit("changed")),
    ).drop("expected_name", "expected_unit", "expected_frequency")


def rescaled(frame: DataFrame) -> DataFrame:
    """Unit conversion of a mapped row: value times the mapping's scale."""
    return frame.withColumn("value", F.col("value") * F.coalesce(F.col("scale"), F.lit(1.0)))


def without_sentinels(frame: DataFrame, index_unit: str = "index") -> DataFrame:
    """Index levels at or below zero are a provider's missing marker."""
    return frame.where(~((F.col("unit") == index_unit) & (F.col("value") <= 0)))


def within_lookback(frame: DataFrame, now: str, months: int) -> DataFrame:
    """Rows whose period is at most ``months`` before the month of ``now``."""
    first = F.add_months(F.trunc(F.lit(now).cast("date"), "MM"), -months)
    return frame.where(F.col("period_start") >= first)


def too_few_rows(frame: DataFrame, minimum: int, by: list[str], expected: DataFrame | None = None) -> DataFrame:
    """Groups whose parse produced fewer than ``minimum`` rows; of the ``expected`` groups also those without any."""
    counted = frame.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    if expected is not None:
        counted = expected.select(*by).distinct().join(counted, by, "full").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))
    return counted.where(F.col("rows") < minimum).select(*by, "rows")


def duplicate_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def missing_periods(frame: DataFrame, expected_per_year: int = 12, expected: DataFrame | None = None) -> DataFrame:
    """(series, year) whose batch lacks some of its expected months; ``expected`` (canonical_series_id, year) adds those
    the batch does not mention at all."""
    group = ["canonical_series_id", "year"]
    monthly = frame.where("frequency = 'M'").select(
        "canonical_series_id", F.year("period_end").alias("year"), F.month("period_end").alias("month")).distinct()
    found = monthly.groupBy(*group).agg(F.count(F.lit(1)).alias("present"), F.collect_set("month").alias("_months"))
    if expected is not None:
        found = expected.select(*group).distinct().join(found, group, "full")
    months = F.coalesce("_months", F.array().cast("array<int>"))
    return found.select(
        *group, F.coalesce("present", F.lit(0).cast("long")).alias("present"),
        F.array_join(F.array_except(F.sequence(F.lit(1), F.lit(expected_per_year)), months), ",").alias("missing"),
    ).where(F.col("present") < expected_per_year)


def identity_violations(frame: DataFrame, left: str, right: str, balance: str, tolerance: float = 0.021,
                        key: tuple[str, ...] = ("period",)) -> DataFrame:
    """Periods where ``left - right`` is not ``balance``; only periods holding all three."""
    def leg(name: str) -> Column:
        return F.max(F.when(F.col("canonical_series_id") == name, F.col("value")))
    legs = frame.where(F.col("canonical_series_id").isin(left, right, balance)).groupBy(*key).agg(
        leg(left).alias("left_value"), leg(right).alias("right_value"), leg(balance).alias("balance_value"))
    gap = F.col("left_value") - F.col("right_value") - F.col("balance_value")
    return legs.withColumn("gap", F.abs(gap)).where(F.col("gap") > tolerance)


def not_period_end(frame: DataFrame) -> DataFrame:
    """Rows dated off a month end (M) or quarter end (Q)."""
    off = F.col("period_end") != F.last_day("period_end")
    off = off | ((F.col("frequency") == "Q") & (F.month("period_end") % 3 != 0))
    return frame.where(off)


def period_gap(first: Column, last: Column, frequency: Column) -> Column:
    """Number of periods from ``first`` to ``last`` inclusive, 0 for unknown labels."""
    return F.coalesce(period_index(last, frequency) - period_index(first, frequency) + 1, F.lit(0))
