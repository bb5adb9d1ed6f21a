"""Data-quality audits. Every count is one pass with a map-side combine; nothing is looped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.instants import period_index
from ..functions.ordered import newest, top_row
from ..schema import INSTANT_COLUMNS
from .contracts import finite, period_gap

FREQUENCIES = ("D", "W", "M", "Q", "A")
GRADES = ("A", "B", "C", "D")
VERSION_KEY = ["source", "canonical_series_id", "period", "vintage_no"]


def duplicate_vintages(vintages: DataFrame) -> DataFrame:
    """Surplus rows over distinct (source, series, period, vintage_no)."""
    groups = vintages.groupBy(*VERSION_KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def row_defects(vintages: DataFrame) -> DataFrame:
    """All row-level audit counters in a single scan."""
    return vintages.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("pit_grade").isin("A", "B", "C") & F.col("release_at").isNull()).alias("missing_release"),
        F.count_if(F.col("source_url").isNull() | (F.trim("source_url") == "")).alias("missing_url"),
        F.count_if(~F.col("frequency").isin(*FREQUENCIES)).alias("bad_frequency"),
        F.count_if(~finite(F.col("value"))).alias("bad_value"),
        F.count_if(F.col("vintage_no") > 0).alias("revision_rows"),
    )


def unit_changes(vintages: DataFrame) -> DataFrame:
    return vintages.groupBy("canonical_series_id").agg(F.countDistinct("unit").alias("units")).where("units > 1")


def grade_histogram(vintages: DataFrame) -> DataFrame:
    return vintages.groupBy("pit_grade").agg(F.count(F.lit(1)).alias("rows"))


def series_per_country(vintages: DataFrame) -> DataFrame:
    return vintages.groupBy("country").agg(F.countDistinct("canonical_series_id").alias("series"))


def zoneless_instants(vintages: DataFrame) -> list[str]:
    """Instant columns that are missing or not zone-aware; a schema check, no job."""
    kinds = {f.name: f.dataType.typeName() for f in vintages.schema}
    return [c for c in INSTANT_COLUMNS if kinds.get(c) != "timestamp"]


def latest_status(crawl: DataFrame) -> DataFrame:
    """Newest attempt per (source, url)."""
    return top_row(crawl, ["source", "url"], newest("completed_at", "crawl_id"))


def crawl_failures(crawl: DataFrame) -> DataFrame:
    """Parser and HTTP failures among the newest attempts; a missing robots file is no failure."""
    robots = (F.col("http_status") == 404) & F.col("url").rlike(r"/robots\.txt$")
    return latest_status(crawl).agg(
        F.count_if(F.col("error_type").contains("Parser")).alias("parse_failures"),
        F.count_if(~F.col("success") & ~F.coalesce(robots, F.lit(False))).alias("http_failures"),
        F.count(F.lit(1)).alias("urls"),
    )


def excluded_months(first: Column, last: Column, months: Column) -> Column:
    """How many months in [first, last] (running month numbers) fall in ``months``.

    Plain arithmetic per excluded month, so no month list is ever built.
    """
    def upto(end: Column, month: Column) -> Column:
        # months with number m (0-based) among running indexes 0 .. end
        return F.floor((end - month) / 12) + 1
    return F.aggregate(
        months, F.lit(0).cast("long"),
        lambda acc, m: acc + upto(last, m - 1) - upto(first - 1, m - 1),
    )


def expected_periods(first: Column, last: Column, frequency: Column, missing_months: Column | None = None) -> Column:
    """Periods from first to last label; structural gap months do not count; 0 off M and Q."""
    total = period_gap(first, last, frequency).cast("long")
    if missing_months is None:
        return total
    gaps = excluded_months(period_index(first, F.lit("M")), period_index(last, F.lit("M")), missing_months)
    none = F.array().cast("array<int>")
    return F.when((frequency == "M") & (F.size(F.coalesce(missing_months, none)) > 0), total - gaps).otherwise(total)


def coverage(vintages: DataFrame, registry: DataFrame, country: str, structural: DataFrame | None = None) -> DataFrame:
    """Coverage per active registry series of a country; series without data stay, with zeros.

    ``structural`` lists months a source never publishes: (source, missing_months array).
    Series are counted per frequency, so one id in two frequencies gives two rows.
    """
    seen = vintages.where(F.col("country") == country).groupBy("canonical_series_id", "frequency").agg(
        F.min("period").alias("earliest_valid_period"), F.max("period").alias("latest_period"),
        F.countDistinct("period").alias("observed_periods"),
        *[F.count_if(F.col("pit_grade") == g).alias(f"pit_{g.lower()}_rows") for g in GRADES],
    ).withColumnRenamed("frequency", "_frequency")
    listed = registry.where((F.upper("country") == country.upper()) & F.col("active")).select(
        "canonical_series_id", "source", F.col("frequency").alias("_registered"))
    rows = listed.join(seen, "canonical_series_id", "left")
    rows = rows.withColumn("frequency", F.coalesce("_frequency", "_registered"))
    if structural is not None:
        rows = rows.join(structural.select("source", "missing_months"), "source", "left")
    expected = expected_periods(
        F.col("earliest_valid_period"), F.col("latest_period"), F.col("frequency"),
        F.col("missing_months") if structural is not None else None)
    zero = F.lit(0).cast("long")
    rows = rows.withColumn("expected_periods", F.coalesce(expected, zero))
    return rows.select(
        "canonical_series_id", "source", "frequency", "earliest_valid_period", "latest_period",
        F.coalesce("observed_periods", zero).alias("observed_periods"), "expected_periods",
        F.when(F.col("expected_periods") > 0, F.coalesce("observed_periods", zero) / F.col("expected_periods"))
        .otherwise(F.lit(0.0)).alias("coverage"),
        *[F.coalesce(f"pit_{g.lower()}_rows", zero).alias(f"pit_{g.lower()}_rows") for g in GRADES])


def thin_series(coverage_rows: DataFrame, minimum: float = 0.95) -> DataFrame:
    return coverage_rows.agg(F.count_if((F.col("observed_periods") > 0) & (F.col("coverage") < minimum)).alias("series"))


def coverage_matrix(vintages: DataFrame, categories: list[str], source: str | None = None,
                    targets: DataFrame | None = None) -> DataFrame:
    """Country x category presence by id suffix, with a complete flag and the missing list."""
    rows = vintages if source is None else vintages.where(F.col("source") == source)
    flags = rows.groupBy("country").agg(*[
        F.coalesce(F.bool_or(F.col("canonical_series_id").endswith(f"_{c}")), F.lit(False)).alias(c.lower())
        for c in categories])
    if targets is not None:
        flags = targets.select("country").join(flags, "country", "left").fillna(False)
    missing = F.array_compact(F.array(*[F.when(~F.col(c.lower()), F.lit(c)) for c in categories]))
    return flags.withColumns({"complete": F.size(missing) == 0, "missing": F.array_join(missing, ";")})


def historical_depth(vintages: DataFrame, country: str = "CN", monthly: int = 24, quarterly: int = 8,
                     ratio: float = 0.95, structural: DataFrame | None = None) -> DataFrame:
    """Depth per (source, series, frequency) and whether it passes."""
    rows = vintages.where(F.col("country") == country).groupBy("source", "canonical_series_id", "frequency").agg(
        F.min("period").alias("first_period"), F.max("period").alias("last_period"),
        F.countDistinct("period").alias("observed_periods"))
    if structural is not None:
        rows = rows.join(structural.select("source", "missing_months"), "source", "left")
    expected = expected_periods(F.col("first_period"), F.col("last_period"), F.col("frequency"),
                                F.col("missing_months") if structural is not None else None)
    needed = F.when(F.col("frequency") == "Q", quarterly).otherwise(monthly)
    return rows.withColumn("expected_periods", expected).withColumn(
        "passes", (F.col("observed_periods") >= needed) & F.coalesce(
            F.col("observed_periods") / F.nullif(F.col("expected_periods"), F.lit(0)) >= ratio, F.lit(False))
    ).drop("missing_months")


def required_present(vintages: DataFrame, required: DataFrame, column: str) -> DataFrame:
    """Of a required list (one column), how many occur in the data."""
    present = vintages.select(F.col(column).alias("_value")).distinct()
    marked = required.select(F.col(required.columns[0]).alias("_required")).join(
        present, F.col("_required") == F.col("_value"), "left")
    return marked.agg(F.count("_value").alias("present"), F.count(F.lit(1)).alias("required"))


def latest_validations(validations: DataFrame, source: str, test: str) -> DataFrame:
    """Newest validation per detail, summed up."""
    newest_rows = top_row(
        validations.where((F.col("source") == source) & (F.col("test_name") == test)), ["detail"],
        newest("created_at", "validation_id"))
    return newest_rows.agg(
        F.count(F.lit(1)).alias("validations"), F.coalesce(F.min("match_rate"), F.lit(0.0)).alias("min_match_rate"),
        F.coalesce(F.sum("sample_size"), F.lit(0)).cast("long").alias("samples"))


@dataclass(frozen=True)
class Check:
    """A one-row measurement and the status rule over its ``value``."""

    name: str
    measured: DataFrame          # one row, one numeric column
    passes: str                  # SQL predicate over value
    otherwise: str = "FAIL"      # status when it does not pass


def check_rows(checks: list[Check]) -> DataFrame:
    """Rule table to PASS / FAIL / WARN rows."""
    out = None
    for check in checks:
        row = check.measured.select(
            F.lit(check.name).alias("name"), F.col(check.measured.columns[0]).cast("double").alias("value")
        ).withColumn("status", F.when(F.expr(check.passes), F.lit("PASS")).otherwise(F.lit(check.otherwise)))
        out = row if out is None else out.unionByName(row)
    return out


def overall(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.when(F.count_if(F.col("status") == "FAIL") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("overall"))


def sampled_cells(cells: DataFrame, per: list[str], n: int, on: list[str], seed: int = 0) -> DataFrame:
    """A deterministic sample: the ``n`` cells per group with the smallest digest of ``seed`` and the columns ``on``,
    which tell the cells of a group apart.

    The row filter is a map-side group limit, so the sample costs one narrow shuffle.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in on]))
    return top_row(cells, per, [digest, *[F.col(c) for c in on]], n)


def cell_match(probed: DataFrame, per: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Match rate of probed cells (``value`` expected, ``visible_value`` found)."""
    hit = F.coalesce(F.abs(F.col("value") - F.col("visible_value")) <= tolerance, F.lit(False))
    return probed.groupBy(*per).agg(
        F.count(F.lit(1)).alias("sample_size"), F.count_if(hit).alias("matches")
    ).withColumn("match_rate", F.col("matches") / F.col("sample_size"))


def source_grade_profile(vintages: DataFrame) -> DataFrame:
    return vintages.groupBy("source", "pit_grade").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("canonical_series_id").alias("series_count"),
        F.min("period").alias("min_period"), F.max("period").alias("max_period"))


def series_profile(vintages: DataFrame) -> DataFrame:
    # one row per period and code first: the distinct counts expand these, not the vintages
    seen = vintages.groupBy("canonical_series_id", "period", "source_series_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("first_seen_at").alias("first"), F.max("first_seen_at").alias("last"))
    return seen.groupBy("canonical_series_id").agg(
        F.sum("n").alias("row_count"), F.countDistinct("period").alias("period_count"),
        F.min("period").alias("first_period"), F.max("period").alias("last_period"),
        F.countDistinct("source_series_id").alias("code_count"), F.min("first").alias("first_seen"),
        F.max("last").alias("last_seen"))


def grade_profile(vintages: DataFrame) -> DataFrame:
    return vintages.groupBy("pit_grade").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("release_at").alias("released_rows"),
        F.count_if(F.col("available_at") < F.col("first_seen_at")).alias("backdated_rows"))


def duplicate_signatures(vintages: DataFrame) -> DataFrame:
    groups = vintages.groupBy("source", "canonical_series_id", "period", "value", "available_at").agg(
        F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return groups.agg(F.count(F.lit(1)).alias("duplicate_signatures"))


def multi_vintage_keys(vintages: DataFrame) -> DataFrame:
    keys = vintages.groupBy("canonical_series_id", "period").agg(F.count(F.lit(1)).alias("versions")).where("versions > 1")
    return keys.groupBy("canonical_series_id").agg(F.count(F.lit(1)).alias("keys_with_multiple_vintages"))


def reconciliation(vintages: DataFrame, vendor: str = "WIND", country: str = "CN", tolerance: float = 1e-9) -> DataFrame:
    """Official A / B against the vendor's base D per (series, period): newest of each, then compared.

    Both sides come out of one aggregate as conditional maxima: no join, one shuffle.
    """
    def latest(condition: Column) -> Column:
        return F.max(F.when(condition, F.struct("available_at", "vintage_no", "retrieved_at", "raw_sha256", "value")))
    rows = vintages.where(F.col("country") == country)
    base = (F.col("pit_grade") == "D") & (F.col("source") == vendor) & ~F.coalesce(
        F.col("release_date_source"), F.lit("")).startswith("wind_revision_snapshot_")
    best = rows.groupBy("canonical_series_id", "period").agg(
        latest(F.col("pit_grade") == "A").alias("A"), latest(F.col("pit_grade") == "B").alias("B"), latest(base).alias("v"))
    pairs = best.where("v IS NOT NULL").select(
        "canonical_series_id", "period", F.explode(F.array(
            F.struct(F.lit("A").alias("pit_grade"), F.col("A.value").alias("official")),
            F.struct(F.lit("B").alias("pit_grade"), F.col("B.value").alias("official")))).alias("o"),
        F.col("v.value").alias("vendor")).select("canonical_series_id", "period", "o.*", "vendor").where("official IS NOT NULL")
    gap = F.abs(F.col("official") - F.col("vendor"))
    return pairs.groupBy("pit_grade").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(gap <= tolerance).alias("exact"),
        F.count_if(gap > tolerance).alias("different"), F.max(gap).alias("largest_gap"))


def gap_runs(selected: DataFrame) -> DataFrame:
    """Runs of missing months between a series' first and last present month.

    Found from neighbouring present months, so missing months are never listed. At most one
    row per (series, month) reaches the window.
    """
    present = selected.where("frequency = 'M'").select(
        "canonical_series_id", period_index(F.col("period"), F.col("frequency")).alias("month")).distinct()
    following = F.lead("month").over(Window.partitionBy("canonical_series_id").orderBy("month"))
    runs = present.withColumn("next", following).where(F.col("next") > F.col("month") + 1).select(
        "canonical_series_id", (F.col("month") + 1).alias("from_month"), (F.col("next") - 1).alias("to_month"))

    def in_run(month: int) -> Column:
        # months of this calendar number in [from, to]
        return (F.floor((F.col("to_month") - month) / 12) - F.floor((F.col("from_month") - 1 - month) / 12)).cast("long")

    def label(index: Column) -> Column:
        return F.concat(F.floor(index / 12).cast("string"), F.lit("-"), F.lpad((index % 12 + 1).cast("string"), 2, "0"))
    return runs.select(
        "canonical_series_id", label(F.col("from_month")).alias("first_missing"),
        label(F.col("to_month")).alias("last_missing"),
        (F.col("to_month") - F.col("from_month") + 1).cast("long").alias("months"),
        (in_run(0) + in_run(1)).alias("january_february"))


def constant_runs(selected: DataFrame, minimum: int = 3) -> DataFrame:
    """Runs of at least ``minimum`` consecutive months with one value; a gap ends a run."""
    rows = selected.where("frequency = 'M'").select(
        "canonical_series_id", "period", period_index(F.col("period"), F.col("frequency")).alias("month"), "value")
    # one selected row per (series, month): windows are bounded by the calendar
    by_month = Window.partitionBy("canonical_series_id").orderBy("month")
    starts = F.when((F.lag("month").over(by_month) == F.col("month") - 1)
                    & (F.lag("value").over(by_month) == F.col("value")), 0).otherwise(1)
    flagged = rows.withColumn("_start", starts)
    grouped = flagged.withColumn("_run", F.sum("_start").over(by_month.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("canonical_series_id", "_run").agg(
        F.min("period").alias("first_period"), F.max("period").alias("last_period"),
        F.count(F.lit(1)).alias("months"), F.min("value").alias("value")).where(F.col("months") >= minimum).drop("_run")


def selected_invariants(selected: DataFrame, vintages: DataFrame, cutoff: Column) -> DataFrame:
    """Duplicates, rows before they were available, and gap-only rows beside A/B: all zero."""
    official = vintages.where(F.col("pit_grade").isin("A", "B")).select(
        "country", "canonical_series_id", "period", F.lit(True).alias("_official")).distinct()
    rows = selected.join(official, ["country", "canonical_series_id", "period"], "left")
    per_key = rows.groupBy("country", "canonical_series_id", "period").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("available_at") > cutoff).alias("early"),
        F.count_if(F.col("selection_origin").isin("WIND", "SAFE_ESTIMATED_D") & F.col("_official")).alias("beside"))
    return per_key.agg(
        F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("duplicates"), F.sum("early").alias("not_yet_available"),
        F.sum("beside").alias("gap_rows_beside_official"))


def raw_evidence(vintages: DataFrame, files: DataFrame) -> DataFrame:
    """Share of rows whose raw file exists with the recorded digest.

    ``files`` has ``path`` (as recorded in ``raw_file``) and ``content``. Only distinct (file, digest) pairs meet the files,
    and each file is hashed once.
    """
    hashed = files.select(F.col("path"), F.sha2("content", 256).alias("_digest"))
    pairs = vintages.groupBy("raw_file", "raw_sha256").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(F.col("pit_grade").isin("A", "B")).alias("_strict"))
    real = ~F.coalesce(F.col("raw_sha256"), F.lit("")).isin("", "N/A", "...")
    joined = pairs.join(hashed, F.col("raw_file") == F.col("path"), "left")
    ok = F.coalesce(real & (F.lower("_digest") == F.lower("raw_sha256")), F.lit(False))
    return joined.agg(
        F.sum("_rows").alias("rows"), F.coalesce(F.sum(F.when(ok, F.col("_rows"))), F.lit(0)).alias("verified"),
        F.coalesce(F.sum(F.when(ok, F.col("_strict"))), F.lit(0)).alias("strict_verified"))
