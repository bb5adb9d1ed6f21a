"""Field inventories, disclosure dates and review lists."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.instants import LOCAL_ZONE, instant, local_date, next_day_start_utc


def joined_set(column: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), ",")


def field_inventory(vintages: DataFrame, now: str | datetime, precedence: list[str], country: str = "CN") -> DataFrame:
    """One row per field visible at ``now``.

    Spans, attribute uniqueness, all sources, the sources of the newest visible period and
    the owner by source precedence. Two aggregates over (field, period, source) groups
    replace a query per field; source sets are bounded by the number of sources.
    """
    rank = F.coalesce(*[F.when(F.col("source") == s, F.lit(i)) for i, s in enumerate(precedence)], F.lit(len(precedence)))
    rows = vintages.where(F.col("country") == country)
    seen = F.col("available_at") <= instant(vintages, "available_at", now)
    cells = rows.groupBy("canonical_series_id", "period", "source", "frequency", "unit").agg(
        F.bool_or(seen).alias("visible"))
    fields = cells.groupBy("canonical_series_id").agg(
        F.min(F.when(F.col("visible"), F.col("period"))).alias("start_period"),
        F.max(F.when(F.col("visible"), F.col("period"))).alias("visible_last_period"),
        F.countDistinct(F.when(F.col("visible"), F.col("period"))).alias("visible_periods"),
        F.max("period").alias("database_latest_period"),
        F.min("frequency").alias("frequency"), F.countDistinct("frequency").alias("frequencies"),
        F.min("unit").alias("unit"), F.countDistinct("unit").alias("units"),
        joined_set("source").alias("record_sources"),
        F.min_by("source", F.struct(rank, F.col("source"))).alias("update_owner"),
    ).where("visible_last_period IS NOT NULL")
    newest = cells.where("visible").groupBy("canonical_series_id", "period").agg(
        joined_set("source").alias("latest_period_sources"))
    return fields.join(
        newest, (fields.canonical_series_id == newest.canonical_series_id)
        & (fields.visible_last_period == newest.period)
    ).select(fields["*"], "latest_period_sources")


def with_disclosure(vintages: DataFrame, now: str | datetime, zones: dict[str, str], estimated: dict[str, int]) -> DataFrame:
    """First release and first available local date of each field's newest visible period.

    ``zones`` maps a source to its publication zone; ``estimated`` maps a source without
    release evidence to its lag in days, after which its rows count as visible.
    """
    lag = F.coalesce(*[F.when(F.col("source") == s, F.lit(d)) for s, d in estimated.items()])
    zone = F.coalesce(*[F.when(F.col("source") == s, F.lit(z)) for s, z in zones.items()], F.lit(LOCAL_ZONE))
    cutoff = instant(vintages, "available_at", now)
    virtual = next_day_start_utc(F.date_add(F.col("period_end"), lag))
    rows = vintages.withColumns({"_lag": lag, "_zone": zone}).where(
        F.when(F.col("_lag").isNull(), F.col("available_at") <= cutoff)
        .otherwise(virtual <= cutoff.cast("timestamp_ntz")))
    periods = rows.groupBy("canonical_series_id", "country", "source", "period").agg(
        F.min("period_end").alias("period_end"), F.min("release_at").alias("first_release_at"),
        F.min("available_at").alias("first_available_at"),
        F.min_by("release_date_source", F.struct("available_at", "raw_sha256", "release_date_source")).alias(
            "release_date_source"),
        F.max("_lag").alias("_lag"), F.max("_zone").alias("_zone"),
    )
    last = periods.groupBy("canonical_series_id", "country", "source").agg(
        F.max(F.struct("period", "period_end", "first_release_at", "first_available_at", "release_date_source",
                       "_lag", "_zone")).alias("l"), F.min("period").alias("first_period"),
        F.count(F.lit(1)).alias("visible_periods"))
    guessed = F.col("l._lag").isNotNull()
    return last.select(
        "canonical_series_id", "country", "source", "first_period", F.col("l.period").alias("last_period"),
        "visible_periods",
        F.when(guessed, F.date_add(F.col("l.period_end"), F.col("l._lag")))
        .otherwise(local_date(F.col("l.first_release_at"), F.col("l._zone"))).alias("first_release_date"),
        F.when(guessed, F.date_add(F.col("l.period_end"), F.col("l._lag") + 1))
        .otherwise(local_date(F.col("l.first_available_at"), F.col("l._zone"))).alias("first_available_date"),
        F.col("l.release_date_source").alias("release_date_source"))


def grouped_counts(inventory: DataFrame, column: str) -> DataFrame:
    return inventory.groupBy(column).agg(F.count(F.lit(1)).alias("fields"))


def lagging(inventory: DataFrame) -> DataFrame:
    """Fields whose newest stored period is not visible yet."""
    return inventory.where(F.col("visible_last_period") != F.col("database_latest_period"))


def stale(inventory: DataFrame, year: int) -> DataFrame:
    return inventory.where(F.substring("visible_last_period", 1, 4).cast("int") < year)


def series_list(vintages: DataFrame) -> DataFrame:
    return vintages.select("canonical_series_id").distinct()


ARTICLE_SOURCES = ("NBS", "PBOC", "PBOC_MIRROR", "MOF", "SAFE")
ID_FIELDS = ["source", "canonical_series_id", "period", "vintage_no", "available_at", "raw_sha256"]


def risk_flags(article_sources: tuple[str, ...] = ARTICLE_SOURCES, large: float = 5.0) -> Column:
    return F.array_compact(F.array(
        F.when(F.col("vintage_no") > 1, F.lit("revision_vintage")),
        F.when(F.col("revision_delta").isNotNull(), F.lit("value_changed")),
        F.when(F.abs("revision_delta") >= large, F.lit("large_absolute_revision")),
        F.when(F.col("pit_grade") == "D", F.lit("pit_d_first_seen_or_estimated")),
        F.when(F.col("source").isin(*article_sources), F.lit("article_parser")),
    ))


def candidate_id() -> Column:
    """Stable id of a vintage; a vintage number of 0 counts as blank."""
    parts = [F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("0")), F.lit("")) for c in ID_FIELDS]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 20)


def review_window(vintages: DataFrame, start: str | datetime, finish: str | datetime, sources: list[str]) -> DataFrame:
    at = F.col("retrieved_at")
    return vintages.where(
        (at >= instant(vintages, "retrieved_at", start)) & (at <= instant(vintages, "retrieved_at", finish))
        & F.col("source").isin(*[s.upper() for s in sources]))


def review_candidates(vintages: DataFrame, start: str | datetime, finish: str | datetime, sources: list[str],
                      limit: int, ties: tuple[str, ...] = ("source", "vintage_no", "available_at", "raw_sha256", "value")) -> DataFrame:
    """Top ``limit`` new vintages for review: revisions first, largest absolute change first.

    A total order plus limit runs as a top-k per task and one small merge.
    """
    revision = (F.col("vintage_no") > 1) | F.col("revision_delta").isNotNull()
    return review_window(vintages, start, finish, sources).orderBy(
        F.when(revision, 0).otherwise(1), F.abs(F.coalesce("revision_delta", F.lit(0.0))).desc(),
        "canonical_series_id", "period", *ties).limit(limit)


def day_status(runs: DataFrame, zone: str = LOCAL_ZONE, at: str = "completed_at") -> DataFrame:
    """Worst status over all sources per local day: FAILED > PARTIAL > SUCCESS."""
    return runs.groupBy(local_date(F.col(at), zone).alias("day")).agg(
        F.count(F.lit(1)).alias("runs"), F.countDistinct("source").alias("sources"),
        F.when(F.bool_or(F.col("status") == "FAILED"), F.lit("FAILED"))
        .when(F.bool_or(F.col("status") == "PARTIAL"), F.lit("PARTIAL")).otherwise(F.lit("SUCCESS")).alias("status"))
