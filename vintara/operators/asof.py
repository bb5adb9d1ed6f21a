"""As-of queries: what was known at T."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.instants import ensure_utc, instant, next_day_start_utc, normalize_as_of
from ..functions.ordered import (
    HotKeys, newest, running_last, time_chunk, top_row, with_neighbours,
)
from ..plans.policy import (
    MODES, RULE_ORIGIN, SIDECAR_MARKER, VENDOR_REVISION, WEB_REVISION, Policy, fact_origin,
    marker_starts, of_origin, scope_filter, sidecar_origin, without_inactive,
)

KEY = ["country", "canonical_series_id", "period"]
TIE_BREAKS = ["retrieved_at", "source", "raw_sha256", "value"]
SELECTED_COLUMNS = [
    "country", "canonical_series_id", "series_name", "source", "frequency", "unit", "period", "period_end",
    "value", "selection_origin", "available_at", "vintage_no", "pit_grade", "release_date_source",
]


def snapshot(vintages: DataFrame, as_of: str | datetime, mode: str = "strict", country: str | None = None,
             inactive: DataFrame | None = None) -> DataFrame:
    """Latest vintage available at T per (country, series, period).

    A cutoff without an offset is local time; a bare date is local *midnight* here, unlike
    the fixed-T wide queries.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of: {', '.join(MODES)}")
    visible = vintages.where(
        (F.col("available_at") <= instant(vintages, "available_at", ensure_utc(as_of)))
        & F.col("pit_grade").isin(*MODES[mode])
    )
    if country:
        visible = visible.where(F.col("country") == country.upper())
    return without_inactive(
        top_row(visible, KEY, newest("available_at", "vintage_no", *TIE_BREAKS)), inactive
    )


def latest_per_series(frame: DataFrame) -> DataFrame:
    """Freshest source period of each series."""
    return top_row(
        frame, ["canonical_series_id"], newest("period_end", "available_at", "vintage_no", *[
            c for c in TIE_BREAKS if c in frame.columns])
    )


WORK_COLUMNS = [
    "canonical_series_id", "series_name", "source", "frequency", "unit", "seasonal_adjustment", "period",
    "period_end", "value", "work_origin", "available_at", "vintage_no",
]


def work_candidates(vintages: DataFrame, sidecar: DataFrame, country: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Evidence rows (A/B and dated revisions) and estimated rows of the work view.

    Estimated rows carry the metadata of the newest vintage of their (series, source,
    period) and know nothing of a country filter.
    """
    evidence = vintages if country is None else vintages.where(F.col("country") == country.upper())
    documented = (F.col("pit_grade") == "D") & (
        ((F.col("source") == "WIND") & F.expr(marker_starts(VENDOR_REVISION)))
        | (F.col("release_date_source") == WEB_REVISION)
    )
    official = F.col("pit_grade").isin("A", "B")
    dated = evidence.where(official | documented).select(
        *WORK_COLUMNS[:9],
        F.when(official, F.concat(F.lit("work_"), F.col("pit_grade")))
        .when(F.col("source") == "WIND", F.lit("work_wind_revision"))
        .otherwise(F.lit("work_web_revision")).alias("work_origin"),
        "available_at", "vintage_no",
        F.when(F.col("pit_grade") == "A", 3).when(F.col("pit_grade") == "B", 2).otherwise(1).alias("source_priority"),
        F.when(official, F.lit("ab")).otherwise(F.lit("revision")).alias("evidence"),
        "retrieved_at", "raw_sha256",
    )
    described = top_row(
        vintages.select("canonical_series_id", "source", "period", "series_name", "frequency", "unit",
                        "seasonal_adjustment", "available_at", "vintage_no", "retrieved_at", "raw_sha256"),
        ["canonical_series_id", "source", "period"],
        newest("available_at", "vintage_no", "retrieved_at", "raw_sha256", "series_name"),
    ).drop("available_at", "vintage_no", "retrieved_at", "raw_sha256")
    estimated = sidecar.select(
        "canonical_series_id", "source", "period", "period_end", "value", "estimated_available_at"
    ).distinct().join(described, ["canonical_series_id", "source", "period"], "left").select(
        "canonical_series_id",
        F.coalesce("series_name", "canonical_series_id").alias("series_name"),
        "source", "frequency", "unit", "seasonal_adjustment", "period", "period_end", "value",
        F.when(F.col("source") == "WIND", F.lit("work_wind")).otherwise(F.lit("work_safe_d")).alias("work_origin"),
        F.col("estimated_available_at").alias("available_at"),
        F.lit(0).alias("vintage_no"), F.lit(0).alias("source_priority"),
    )
    return dated, estimated


def work_snapshot(vintages: DataFrame, sidecar: DataFrame, as_of: str | datetime, country: str | None = None,
                  inactive: DataFrame | None = None) -> DataFrame:
    """Freshest value per series at T blending A/B, dated revisions and estimated rows.

    An estimated row counts only while neither A/B evidence nor a dated revision of its
    period is *visible at T*.
    """
    cutoff = instant(vintages, "available_at", ensure_utc(as_of))
    dated, estimated = work_candidates(vintages, sidecar, country)
    evidence = top_row(
        dated.where(F.col("available_at") <= cutoff), ["canonical_series_id", "period", "evidence"],
        newest("available_at", "vintage_no", *TIE_BREAKS),
    )
    gaps = estimated.where(F.col("available_at") <= cutoff).join(
        evidence.select("canonical_series_id", "period").distinct(), ["canonical_series_id", "period"], "left_anti"
    )
    candidates = evidence.drop("evidence", "retrieved_at", "raw_sha256").unionByName(gaps)
    chosen = top_row(
        candidates, ["canonical_series_id"],
        newest("period_end", "available_at", "source_priority", "vintage_no", "source", "value"),
    )
    return without_inactive(chosen.select(*WORK_COLUMNS), inactive)


def in_periods(frame: DataFrame, start=None, end=None) -> DataFrame:
    """Keep source periods ending in [start, end]; open where None."""
    if start is not None:
        frame = frame.where(F.col("period_end") >= F.lit(str(start)).cast("date"))
    if end is not None:
        frame = frame.where(F.col("period_end") <= F.lit(str(end)).cast("date"))
    return frame


def official_periods(vintages: DataFrame) -> DataFrame:
    """Field-periods that have A/B evidence at any time."""
    return vintages.where(F.col("pit_grade").isin("A", "B") & (F.col("country") == "CN")).select(
        "canonical_series_id", "period").distinct()


def gap_only(estimated: DataFrame, vintages: DataFrame) -> DataFrame:
    """Ordinary estimated rows survive only where no A/B exists, ever."""
    return estimated.join(official_periods(vintages), ["canonical_series_id", "period"], "left_anti")


def rule_estimated(vintages: DataFrame, rules: DataFrame) -> DataFrame:
    """Newest current-history vintage per period, usable ``lag_days`` + 1 days after the period."""
    newest_rows = top_row(
        vintages.where(RULE_ORIGIN.predicate), ["canonical_series_id", "period"],
        newest("vintage_no", *TIE_BREAKS),
    )
    usable = rules.where("eligible").select("canonical_series_id", "lag_days")
    kind = vintages.schema["available_at"].dataType.typeName()
    at = next_day_start_utc(F.expr("date_add(period_end, lag_days)"))
    return newest_rows.join(usable, "canonical_series_id").withColumn(
        "visible_from", at if kind == "timestamp_ntz" else at.cast("timestamp")
    ).drop("lag_days")


def sidecar_candidates(vintages: DataFrame, sidecar: DataFrame, policy: Policy) -> DataFrame:
    """Gap-only estimated rows with the field metadata of their source's newest vintage."""
    described = top_row(
        vintages.where((F.col("country") == "CN") & policy.sidecar_filter()).select(
            "country", "canonical_series_id", "series_name", "frequency", "unit", "source",
            "retrieved_at", "vintage_no", "raw_sha256"),
        ["canonical_series_id", "source"], newest("retrieved_at", "vintage_no", "raw_sha256", "series_name"),
    ).drop("retrieved_at", "vintage_no", "raw_sha256")
    usable = sidecar.where(policy.sidecar_filter()).select(
        "canonical_series_id", "source", "period", "period_end", "value", "estimated_available_at")
    return gap_only(usable, vintages).join(described, ["canonical_series_id", "source"])


def candidates(vintages: DataFrame, scope: str, *, sidecar: DataFrame | None = None, rules: DataFrame | None = None,
               policy: Policy = Policy(), start=None, end=None) -> DataFrame:
    """Every row that may be selected, with origin, priority, role and availability.

    The fact table is classified in one pass; only estimated rows come from joins.
    """
    scope = scope.upper()
    facts = in_periods(vintages.where(scope_filter(scope)), start, end)
    none = F.lit(None)
    picked = facts.withColumn("selection_origin", fact_origin(policy.facts)).where(
        F.col("selection_origin").isNotNull()
    ).select(*SELECTED_COLUMNS, *[c for c in TIE_BREAKS if c not in SELECTED_COLUMNS])
    if scope in ("CN", "ALL"):
        if sidecar is None:
            raise ValueError("CN and ALL need the estimated-availability sidecar")
        estimated = in_periods(sidecar_candidates(vintages, sidecar, policy), start, end).select(
            "country", "canonical_series_id", "series_name", "source", "frequency", "unit", "period", "period_end",
            "value", sidecar_origin().alias("selection_origin"), F.col("estimated_available_at").alias("available_at"),
            F.lit(0).alias("vintage_no"), F.lit("D").alias("pit_grade"),
            F.lit(SIDECAR_MARKER).alias("release_date_source"),
            none.cast(vintages.schema["retrieved_at"].dataType).alias("retrieved_at"),
            none.cast("string").alias("raw_sha256"),
        )
        picked = picked.unionByName(estimated)
    if scope in ("GLB", "ALL"):
        if rules is None:
            raise ValueError("GLB and ALL need the estimated-availability rules")
        by_rule = in_periods(rule_estimated(vintages, rules), start, end).withColumns({
            "selection_origin": F.lit(RULE_ORIGIN.name), "available_at": F.col("visible_from"),
        }).select(*picked.columns)
        picked = picked.unionByName(by_rule)
    return picked.withColumns({
        "source_priority": of_origin("selection_origin", "priority"),
        "event_role": of_origin("selection_origin", "role"),
    })


def selected(vintages: DataFrame, as_of: str | datetime, scope: str, *, start="2005-01-01", end=None,
             sidecar: DataFrame | None = None, rules: DataFrame | None = None, inactive: DataFrame | None = None,
             policy: Policy = Policy()) -> DataFrame:
    """The value in force at T for each (country, series, period).

    The best base row by priority then recency, replaced by a dated revision where that is
    newer. Both maxima come from one aggregate, so the whole choice costs one shuffle with
    a map-side combine.
    """
    cutoff = instant(vintages, "available_at", normalize_as_of(as_of))
    pool = candidates(vintages, scope, sidecar=sidecar, rules=rules, policy=policy, start=start, end=end).where(
        F.col("available_at") <= cutoff
    )
    ties = ["vintage_no", *TIE_BREAKS]
    payload = F.struct(*[c for c in SELECTED_COLUMNS if c not in KEY]).alias("row")
    by_priority = F.struct("source_priority", "available_at", *ties, payload)
    by_time = F.struct("available_at", "source_priority", *ties, payload)
    is_base = F.col("event_role") == "BASE_PRIORITY"
    best = pool.groupBy(*KEY).agg(
        F.max(F.when(is_base, by_priority)).alias("base"),
        F.max(F.when(~is_base, by_time)).alias("event"),
    )
    base_by_time = F.struct(
        F.col("base.available_at"), F.col("base.source_priority"), *[F.col(f"base.{c}") for c in ties],
        F.col("base.row").alias("row"),
    )
    chosen = best.withColumn(
        "pick", F.greatest(F.when(F.col("base").isNotNull(), base_by_time), F.col("event"))
    ).select(*[F.col(c) if c in KEY else F.col(f"pick.row.{c}").alias(c) for c in SELECTED_COLUMNS])
    return without_inactive(chosen, inactive)


def series_metadata(vintages: DataFrame, scope: str, inactive: DataFrame | None = None,
                    recency: str = "retrieved_at", frequency: str = "frequency") -> DataFrame:
    """One row per series: country, joined source list, newest non-null attributes."""
    ties = [c for c in (recency, "vintage_no", "raw_sha256") if c in vintages.columns]

    def latest(column: str) -> Column:
        ordering = F.when(F.col(column).isNotNull(), F.struct(*ties, column))
        # max_by keeps rows whose ordering is null out, so null attributes never win
        return F.max_by(column, ordering)

    described = vintages.where(scope_filter(scope)).groupBy("canonical_series_id").agg(
        F.min("country").alias("country"),
        F.array_join(F.array_sort(F.collect_set("source")), "+").alias("sources"),
        latest("series_name").alias("series_name"),
        latest(frequency).alias("frequency"),
        latest("unit").alias("unit"),
        latest("seasonal_adjustment").alias("seasonal_adjustment"),
    )
    return without_inactive(described, inactive)


def point_lookup(probes: DataFrame, vintages: DataFrame, key: list[str], at: str = "probe_at",
                 hot: DataFrame | None = None) -> DataFrame:
    """Value visible at each probe's own instant: a set-based as-of join.

    Vintages and probes are stacked and ordered per key; the running last vintage at or
    before a probe is its answer. No range join and no row multiplication.
    """
    extra = [c for c in probes.columns if c not in key]
    facts = vintages.select(
        *key, F.col("available_at").alias("_at"), F.lit(0).alias("_is_probe"),
        F.struct("vintage_no", "retrieved_at", "raw_sha256", "value").alias("_seen"),
        *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in extra],
    )
    asked = probes.select(
        *key, F.col(at).alias("_at"), F.lit(1).alias("_is_probe"),
        F.lit(None).cast(facts.schema["_seen"].dataType).alias("_seen"), *extra,
    )
    stacked = facts.unionByName(asked)
    grouped = HotKeys(key, hot)
    return (
        running_last(grouped.chunked(stacked, time_chunk("_at")), ["_at", "_is_probe", "_seen"], grouped, "_seen", "_hit")
        .where("_is_probe = 1")
        .select(*probes.columns, F.col("_hit.value").alias("visible_value"),
                F.col("_hit.vintage_no").alias("visible_vintage_no"))
    )


PREVIOUS_COLUMNS = ["value", "vintage_no", "available_at", "pit_grade", "source_url"]


def previous_vintage(vintages: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Latest row with a smaller ``vintage_no`` of the same (source, series, period)."""
    key = ["source", "canonical_series_id", "period"]
    best = vintages.groupBy(*key, "vintage_no").agg(
        F.max(F.struct("available_at", "retrieved_at", "raw_sha256", F.struct(*PREVIOUS_COLUMNS).alias("row"))).alias("_best")
    ).select(*key, "vintage_no", F.col("_best.row").alias("_row"))
    before = with_neighbours(best, key, [("vintage_no", "asc")], previous={"_previous": "_row"},
                             hot=hot).drop("_row")
    return vintages.join(before, [*key, "vintage_no"]).select(
        *vintages.columns, *[F.col(f"_previous.{c}").alias(f"previous_{c}") for c in PREVIOUS_COLUMNS]
    )


def at(events: DataFrame, as_of: str | datetime, scope: str = "ALL", start=None, end=None,
       inactive: DataFrame | None = None) -> DataFrame:
    """Interval as-of: effective events whose half-open validity holds T."""
    cutoff = instant(events, "valid_from", normalize_as_of(as_of))
    held = in_periods(events.where(scope_filter(scope)), start, end).where(
        (F.col("valid_from") <= cutoff) & (F.col("valid_to").isNull() | (cutoff < F.col("valid_to")))
    )
    return without_inactive(held, inactive)


def overlaps(frame: DataFrame) -> DataFrame:
    """Keys selected more than once: must be empty."""
    return frame.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
