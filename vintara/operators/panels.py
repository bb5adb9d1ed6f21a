"""Wide panels: fixed-T history (index = source period) and many-T panels (index = as-of month end)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.instants import ensure_utc, last_index_day, normalize_as_of, spine
from ..functions.ordered import newest, top_row
from ..plans.policy import MODES, Policy, without_inactive
from . import asof

@dataclass(frozen=True)
class WideResult:
    """A panel and its companions; all but ``fields`` and ``index_column`` are DataFrames.

    ``cells`` is the one pivot behind the three panels: a struct per cell, so value, period and
    provenance of a cell always come from the same row.
    """

    cells: DataFrame
    values: DataFrame
    periods: DataFrame
    provenance: DataFrame
    metadata: DataFrame
    selected: DataFrame
    fields: list[str]
    index_column: str


def field_list(metadata: DataFrame, most: int = 10_000) -> list[str]:
    """Registered field ids, which become pivot columns; more than ``most`` are refused."""
    rows = metadata.select("canonical_series_id").distinct().limit(most + 1).collect()
    if not rows:
        raise ValueError("no fields are registered for this scope")
    if len(rows) > most:
        raise ValueError(f"more than {most} fields: use the long form")
    return sorted(row[0] for row in rows)


def collisions(selected: DataFrame) -> DataFrame:
    """(period_end, series) cells that more than one row claims."""
    return selected.groupBy("canonical_series_id", "period_end").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1")


def pivot_cells(cells: DataFrame, index: DataFrame, index_column: str, fields: list[str], value) -> DataFrame:
    """One row per index day, one column per field, null where unknown; nothing is filled.

    Fields are explicit, so no extra job looks for them and all of them stay.
    """
    wide = cells.groupBy(index_column).pivot("canonical_series_id", fields).agg(F.max(value))
    return index.join(wide, index_column, "left")


def _index(selected: DataFrame, as_of, start, frequency: str):
    frequency = frequency.upper()
    if frequency not in ("M", "Q"):
        raise ValueError("frequency must be M or Q")
    column = "month_end" if frequency == "M" else "quarter_end"
    last = last_index_day(normalize_as_of(as_of), frequency)
    if date.fromisoformat(str(start)) > last:
        raise ValueError("start must not be after the output period")
    return spine(selected.sparkSession, start, last, frequency, column), column, last


def _wide(selected: DataFrame, metadata: DataFrame, as_of, start, frequency, fields, check_cells) -> WideResult:
    index, column, _ = _index(selected, as_of, start, frequency)
    fields = fields if fields is not None else field_list(metadata)
    on_index = F.col("period_end") == F.last_day("period_end")
    if column == "quarter_end":
        on_index = on_index & (F.month("period_end") % 3 == 0)
    cells = selected.where(on_index).withColumn(column, F.col("period_end"))
    if check_cells and not collisions(cells).isEmpty():
        raise ValueError("one cell is claimed by two frequencies or countries of a series")
    # of two rows that claim a cell the one known last shows, in all three panels
    known = "available_at" if "available_at" in selected.columns else "valid_from"
    shown = F.struct(F.col(known).alias("known"), "vintage_no", F.round("value", 10).alias("value"), "period",
                     F.col("selection_origin").alias("origin"), "country")
    one = pivot_cells(cells, index, column, fields, shown)
    panel = lambda part: one.select(column, *[F.col(f"`{f}`.{part}").alias(f) for f in fields])
    return WideResult(
        cells=one, values=panel("value"), periods=panel("period"), provenance=panel("origin"),
        metadata=metadata, selected=cells.drop(column), fields=fields, index_column=column,
    )


def asof_wide(vintages: DataFrame, as_of: str | datetime, scope: str, *, start="2005-01-01", frequency: str = "M",
              sidecar: DataFrame | None = None, rules: DataFrame | None = None, inactive: DataFrame | None = None,
              policy: Policy = Policy(), fields: list[str] | None = None, check_cells: bool = False) -> WideResult:
    """History as known at T: one row per source period end, one column per field.

    ``check_cells`` runs a job that fails if two selected rows claim one cell; without it
    the row known last shows.
    """
    last = last_index_day(normalize_as_of(as_of), frequency)
    chosen = asof.selected(vintages, as_of, scope, start=start, end=last, sidecar=sidecar, rules=rules,
                           inactive=inactive, policy=policy)
    return _wide(chosen, asof.series_metadata(vintages, scope, inactive), as_of, start, frequency, fields, check_cells)


def asof_wide_from_events(events: DataFrame, as_of: str | datetime, scope: str, *, start="2005-01-01",
                          frequency: str = "M", inactive: DataFrame | None = None,
                          fields: list[str] | None = None, check_overlap: bool = False,
                          check_cells: bool = False) -> WideResult:
    """The same panel rebuilt from effective intervals."""
    last = last_index_day(normalize_as_of(as_of), frequency)
    held = asof.at(events, as_of, scope, start, last, inactive)
    if check_overlap and not asof.overlaps(held).isEmpty():
        raise ValueError("effective intervals overlap")
    metadata = asof.series_metadata(events, scope, inactive, recency="valid_from", frequency="source_frequency")
    return _wide(held, metadata, as_of, start, frequency, fields, check_cells)


def scope_tag() -> Column:
    return F.when(F.col("country") == "CN", F.lit("CN")).when(F.col("country") == "US", F.lit("US")).otherwise(F.lit("GLB"))


def combined_wide(events: DataFrame, as_of: str | datetime, fields: list[str], start=None, end=None,
                  inactive: DataFrame | None = None) -> DataFrame:
    """(scope, country, period_end) rows, one column per series, for all scopes together."""
    held = asof.at(events, as_of, "ALL", start, end, inactive).withColumn("scope", scope_tag())
    return held.groupBy("scope", "country", "period_end").pivot("canonical_series_id", fields).agg(
        F.max(F.round("value", 10)))


# ---- panels over many cutoffs -------------------------------------------------------

def first_month_end(frame: DataFrame, column: str = "available_at") -> Column:
    """First month-end cutoff (local 23:59:59) at which an instant is visible."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Shanghai"), F.col(column).cast("timestamp_ntz"))
    day = F.last_day(local.cast("date"))
    # the cutoff is 23:59:59 sharp: the last second's fraction belongs to the next month
    late = local > day.cast("timestamp_ntz") + F.expr("interval '0 23:59:59' day to second")
    return F.when(late, F.last_day(F.add_months(day, 1))).otherwise(day)


def month_ends(spark, start, end) -> DataFrame:
    """Month ends within [start, end]; an empty range is an error."""
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    if first > last:
        raise ValueError("start must be on or before end")
    if last_index_day(ensure_utc(f"{first} 12:00:00"), "M") > last:
        raise ValueError("date range contains no natural month end")
    return spine(spark, start, end, "M", "as_of").where(F.col("as_of") <= F.lit(str(end)).cast("date"))


def panel_cells(candidates: DataFrame, start, end, order: list[str], carry: list[str]) -> DataFrame:
    """Per (month end T, series): the row that leads at T.

    Rows only ever *enter* as T grows and the leader is the maximum of ``order``, so the
    panel is a running maximum over months: rows collapse to one per (series, entry month)
    with a map-side combine, and only that bounded frame is windowed and repeated over the
    months it lasts. No key's history reaches a single task and no T is looped over.
    """
    month_ends(candidates.sparkSession, start, end)
    entered = candidates.withColumn(
        "as_of", F.greatest(first_month_end(candidates), F.last_day(F.lit(str(start)).cast("date")))
    ).where(F.col("as_of") <= F.lit(str(end)).cast("date"))
    leader = entered.groupBy("canonical_series_id", "as_of").agg(
        F.max(F.struct(*order, F.struct(*[c for c in carry if c != "canonical_series_id"]).alias("row"))).alias("lead"))
    by_month = Window.partitionBy("canonical_series_id").orderBy("as_of")
    lasting = leader.withColumns({
        "lead": F.max("lead").over(by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_next": F.lead("as_of").over(by_month),
    })
    until = F.coalesce(F.add_months(F.trunc("_next", "MM"), -1), F.trunc(F.lit(str(end)).cast("date"), "MM"))
    return (
        lasting.withColumn("_until", until)
        .withColumn("_m", F.explode(F.expr("sequence(trunc(as_of, 'MM'), _until, interval 1 month)")))
        .withColumn("as_of", F.last_day("_m"))
        .where(F.col("as_of") <= F.lit(str(end)).cast("date"))
        .select("as_of", "canonical_series_id",
                *[F.col(f"lead.row.{c}").alias(c) for c in carry if c != "canonical_series_id"])
    )


STRICT_ORDER = ["period_end", "available_at", "vintage_no", *asof.TIE_BREAKS]
PANEL_COLUMNS = ["canonical_series_id", "series_name", "source", "frequency", "unit", "seasonal_adjustment", "period",
                 "period_end", "value", "available_at", "vintage_no", "pit_grade"]


def monthly_panel(vintages: DataFrame, start, end, mode: str = "strict", country: str | None = "CN",
                  inactive: DataFrame | None = None) -> DataFrame:
    """Long month-end panel: freshest visible period per (as_of, series) for every month end."""
    rows = vintages.where(F.col("pit_grade").isin(*MODES[mode]))
    if country:
        rows = rows.where(F.col("country") == country.upper())
    return panel_cells(without_inactive(rows, inactive), start, end, STRICT_ORDER, PANEL_COLUMNS)


def work_panel(vintages: DataFrame, sidecar: DataFrame, start, end, country: str | None = None,
               inactive: DataFrame | None = None) -> DataFrame:
    """Month-end panel of the work view.

    An estimated row leaves when evidence of its period arrives, yet that evidence has the
    same period and a later instant, so it also outranks the estimated row: the running
    maximum stays exact once estimated rows that evidence precedes (or meets) are dropped.
    """
    dated, estimated = asof.work_candidates(vintages, sidecar, country)
    key = ["canonical_series_id", "period"]
    first_seen = dated.groupBy(*key).agg(F.min(first_month_end(dated)).alias("_evidence_month"),
                                         F.min("available_at").alias("_evidence_at"))
    gaps = estimated.withColumn("_month", first_month_end(estimated)).join(first_seen, key, "left").where(
        F.col("_evidence_month").isNull() | (F.col("_month") < F.col("_evidence_month"))
    ).drop("_month", "_evidence_month", "_evidence_at")
    latest = top_row(
        dated.withColumn("_month", first_month_end(dated)), [*key, "evidence", "_month"],
        newest("available_at", "vintage_no", *asof.TIE_BREAKS),
    ).drop("_month", "evidence", "retrieved_at", "raw_sha256")
    pool = without_inactive(latest.unionByName(gaps), inactive)
    return panel_cells(pool, start, end,
                       ["period_end", "available_at", "source_priority", "vintage_no", "source", "value"],
                       asof.WORK_COLUMNS)


def panel_columns(cells: DataFrame, end) -> DataFrame:
    """Metadata of the fields visible at the final month end; they fix the panel's columns."""
    final = cells.where(F.col("as_of") == F.lit(str(end)).cast("date"))
    if "work_origin" in cells.columns:
        grade = F.when(F.col("work_origin") == "work_A", F.lit("A")).when(
            F.col("work_origin") == "work_B", F.lit("B")).otherwise(F.lit("D"))
        final = final.withColumn("pit_grade", grade)
    return final.select("canonical_series_id", "series_name", "source", "frequency", "unit", "seasonal_adjustment",
                        "pit_grade")


def panel_wide(cells: DataFrame, start, end, fields: list[str], value) -> DataFrame:
    index = month_ends(cells.sparkSession, start, end)
    return pivot_cells(cells, index, "as_of", fields, value).withColumnRenamed("as_of", "as_of_month_end")


def monthly_snapshots(vintages: DataFrame, start, end, mode: str = "strict", country: str | None = None,
                      inactive: DataFrame | None = None) -> DataFrame:
    """Every row of every month-end snapshot, tagged ``as_of``; write it partitioned by that.

    Per field-period only the last vintage of each entry month matters; each lives until
    the next one enters, and is repeated for exactly the month ends it covers.
    """
    rows = vintages.where(F.col("pit_grade").isin(*MODES[mode]))
    if country:
        rows = rows.where(F.col("country") == country.upper())
    last = F.lit(str(end)).cast("date")
    entered = without_inactive(rows, inactive).withColumn(
        "_enters", F.greatest(first_month_end(rows), F.last_day(F.lit(str(start)).cast("date")))
    ).where(F.col("_enters") <= last)
    monthly = top_row(entered, [*asof.KEY, "_enters"], newest("available_at", "vintage_no", *asof.TIE_BREAKS))
    # at most one row per month is left per key, so this window is bounded by the asked range
    following = F.lead("_enters").over(Window.partitionBy(*asof.KEY).orderBy("_enters"))
    lives = monthly.withColumn("_leaves", following).withColumn(
        "_until", F.coalesce(F.add_months(F.col("_leaves"), -1), last))
    months = F.expr("sequence(trunc(_enters, 'MM'), trunc(_until, 'MM'), interval 1 month)")
    return lives.withColumn("_m", F.explode(months)).withColumn("as_of", F.last_day("_m")).where(
        F.col("as_of") <= last).drop("_enters", "_leaves", "_until", "_m")
