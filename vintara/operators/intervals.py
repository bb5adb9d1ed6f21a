"""Effective intervals: when each value was the one in force."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.ordered import ORDINARY, HotKeys, neighbours, newest, time_chunk, top_row
from ..plans.policy import (
    ALL_ORIGINS, RULE_ORIGIN, SIDECAR_MARKER, Policy, fact_origin, of_origin, scope_filter, sidecar_origin,
    without_inactive,
)
from .asof import KEY, gap_only, in_periods, rule_estimated

EVENT_COLUMNS = [
    "country", "canonical_series_id", "source_series_id", "series_name", "source", "source_frequency", "unit",
    "seasonal_adjustment", "period", "period_start", "period_end", "value", "valid_from", "valid_to", "event_no",
    "selection_origin", "event_role", "source_priority", "pit_grade", "release_at", "release_date_source",
    "first_seen_at", "vintage_no", "revision_type", "revision_delta", "source_url", "raw_file", "raw_sha256",
    "retrieved_at", "parser_version",
]
_DERIVED = ("valid_from", "valid_to", "event_no", "event_role", "source_priority")
CANDIDATE_COLUMNS = [c for c in EVENT_COLUMNS if c not in _DERIVED] + ["visible_from"]
RECENCY = ["vintage_no", "retrieved_at", "source", "raw_sha256", "value"]


def candidates(vintages: DataFrame, scope: str, *, sidecar: DataFrame | None = None, rules: DataFrame | None = None,
               policy: Policy = Policy(), start=None, end=None) -> DataFrame:
    """All rows that can become an event: classified facts, sidecar gaps, rule-estimated rows."""
    scope = scope.upper()
    facts = in_periods(vintages.where(scope_filter(scope)), start, end)
    picked = facts.withColumns({
        "selection_origin": fact_origin(policy.facts), "visible_from": F.col("available_at"),
        "source_frequency": F.col("frequency"),
    }).where(F.col("selection_origin").isNotNull()).select(*CANDIDATE_COLUMNS)
    if scope in ("CN", "ALL"):
        if sidecar is None:
            raise ValueError("CN and ALL need the estimated-availability sidecar")
        picked = picked.unionByName(_sidecar_rows(vintages, sidecar, policy, start, end).select(*CANDIDATE_COLUMNS))
    if scope in ("GLB", "ALL"):
        if rules is None:
            raise ValueError("GLB and ALL need the estimated-availability rules")
        by_rule = in_periods(rule_estimated(vintages, rules), start, end).withColumns({
            "selection_origin": F.lit(RULE_ORIGIN.name), "source_frequency": F.col("frequency"),
        })
        picked = picked.unionByName(by_rule.select(*CANDIDATE_COLUMNS))
    return picked.withColumns({
        "source_priority": of_origin("selection_origin", "priority"),
        "event_role": of_origin("selection_origin", "role"),
    })


def _sidecar_rows(vintages, sidecar, policy, start, end):
    usable = in_periods(sidecar.where(policy.sidecar_filter()), start, end).select(
        "canonical_series_id", "source", "period", "period_end", "value",
        F.col("estimated_available_at").alias("visible_from"),
    )
    carried = ["source_series_id", "series_name", "frequency", "unit", "seasonal_adjustment", "period_start",
               "first_seen_at", "vintage_no", "revision_type", "revision_delta", "source_url", "raw_file", "raw_sha256",
               "retrieved_at", "parser_version"]
    key = ["canonical_series_id", "period", "source"]
    ordinary = vintages.where(
        (F.col("country") == "CN") & (F.col("pit_grade") == "D") & policy.sidecar_filter()
        & ~F.coalesce(F.col("release_date_source"), F.lit("")).startswith("wind_revision_snapshot_")
    )
    described = top_row(ordinary.select(*key, *carried, "value"), key,
                        newest("retrieved_at", "vintage_no", "raw_sha256", "value")).drop("value")
    instant_type = vintages.schema["release_at"].dataType
    return gap_only(usable, vintages).join(described, key, "left").select(
        F.lit("CN").alias("country"), "canonical_series_id",
        F.coalesce("source_series_id", "canonical_series_id").alias("source_series_id"),
        F.coalesce("series_name", "canonical_series_id").alias("series_name"),
        "source", F.coalesce("frequency", F.lit("M")).alias("source_frequency"),
        F.coalesce("unit", F.lit("")).alias("unit"), "seasonal_adjustment", "period",
        F.coalesce("period_start", "period_end").alias("period_start"), "period_end", "value",
        sidecar_origin().alias("selection_origin"), F.lit("D").alias("pit_grade"),
        F.lit(None).cast(instant_type).alias("release_at"), F.lit(SIDECAR_MARKER).alias("release_date_source"),
        "first_seen_at", F.coalesce("vintage_no", F.lit(0)).alias("vintage_no"),
        F.coalesce("revision_type", F.lit("initial")).alias("revision_type"), "revision_delta", "source_url", "raw_file",
        "raw_sha256", "retrieved_at",
        F.coalesce("parser_version", F.lit("estimated_availability_v1")).alias("parser_version"), "visible_from",
    )


def dedup_same_origin(pool: DataFrame) -> DataFrame:
    """One row per origin and instant of a field-period; runs map-side before its shuffle."""
    return top_row(pool, [*KEY, "selection_origin", "visible_from"], newest(*RECENCY))


def _threshold_name(origin: str) -> str:
    return f"first_{origin.lower()}_at"


THRESHOLD_ORIGINS = sorted({name for o in ALL_ORIGINS for name in o.yields_to})


def _firsts() -> dict:
    return {
        _threshold_name(name): F.min(F.when(F.col("selection_origin") == name, F.col("visible_from")))
        for name in THRESHOLD_ORIGINS
    }


def first_visible(pool: DataFrame, keys: list[str]) -> DataFrame:
    """First visible instant of each threshold origin per key."""
    return pool.where(F.col("selection_origin").isin(THRESHOLD_ORIGINS)).groupBy(*keys).agg(
        *[low.alias(name) for name, low in _firsts().items()])


def with_first_visible(pool: DataFrame, hot: HotKeys) -> DataFrame:
    """Attach those instants to every row of its key, over the partitioning ``hot`` allows.

    A chunk of a hot key sees its own minima only, so the whole key's (one row per hot
    key) are joined to them.
    """
    window = Window.partitionBy(*hot.group)
    local = pool.withColumns({name: low.over(window) for name, low in _firsts().items()})
    if hot.list is None:
        return local
    names = list(_firsts())
    whole = first_visible(pool.where(F.col("_chunk") != ORDINARY), hot.keys).select(
        *hot.keys, F.lit(True).alias("_whole"), *[F.col(n).alias(f"_{n}") for n in names])
    return local.join(whole, hot.keys, "left").withColumns({
        n: F.when(F.col("_whole"), F.col(f"_{n}")).otherwise(F.col(n)) for n in names
    }).drop("_whole", *[f"_{n}" for n in names])


def dominance_filter(frame: DataFrame) -> DataFrame:
    """Drop events seen at or after the first event of an origin they yield to."""
    tests = []
    for origin in ALL_ORIGINS:
        firsts = [_threshold_name(name) for name in origin.yields_to]
        tests.append(" AND ".join([f"selection_origin = '{origin.name}'",
                                   *[f"({first} IS NULL OR visible_from < {first})" for first in firsts]]))
    return frame.where(" OR ".join(f"({test})" for test in tests))


def effective_events(vintages: DataFrame, scope: str, *, sidecar: DataFrame | None = None,
                     rules: DataFrame | None = None, inactive: DataFrame | None = None, policy: Policy = Policy(),
                     start="2005-01-01", end=None, hot: DataFrame | None = None) -> DataFrame:
    """One row per value that was ever in force, valid on the half-open [valid_from, valid_to).

    Shuffles: one to keep a single row per origin and instant, one on the key for
    thresholds, same-instant choice and neighbours together. A hot key is spread over
    time chunks in the second.
    """
    pool = without_inactive(
        candidates(vintages, scope, sidecar=sidecar, rules=rules, policy=policy, start=start, end=end), inactive)
    grouped = HotKeys(KEY, hot)
    single = grouped.chunked(dedup_same_origin(pool), time_chunk("visible_from"))
    alive = dominance_filter(with_first_visible(single, grouped)).drop(
        *[_threshold_name(name) for name in THRESHOLD_ORIGINS])
    in_force = top_row(alive, [*grouped.group, "visible_from"], newest("source_priority", *RECENCY))
    events = neighbours(
        in_force, [("visible_from", "asc")], grouped, following={"valid_to": "visible_from"}, ordinal="event_no")
    return events.withColumnRenamed("visible_from", "valid_from").select(*EVENT_COLUMNS)


def invariants(events: DataFrame) -> DataFrame:
    """Counts that must all be zero except ``events`` and ``keys``.

    Contiguity needs no ordering: within a key the set of interval ends must equal the set
    of starts without the first, and exactly one interval must be open.
    """
    edges = events.select(*KEY, F.explode(F.array(
        F.struct(F.col("valid_from").alias("at"), F.lit(1).alias("starts"), F.lit(0).alias("ends"),
                 (F.col("valid_to") <= F.col("valid_from")).alias("empty")),
        F.struct(F.col("valid_to").alias("at"), F.lit(0).alias("starts"), F.lit(1).alias("ends"),
                 F.lit(False).alias("empty")),
    )).alias("edge")).select(*KEY, "edge.*").where("at IS NOT NULL")
    per_instant = edges.groupBy(*KEY, "at").agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), F.count_if("empty").alias("empty"))
    per_key = per_instant.groupBy(*KEY).agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), F.sum("empty").alias("empty"),
        F.count_if((F.col("ends") > 0) & (F.col("starts") != F.col("ends"))).alias("unmatched"),
        F.count_if(F.col("starts") > 1).alias("repeated"),
    )
    return per_key.agg(
        F.coalesce(F.sum("starts"), F.lit(0)).alias("events"), F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum("unmatched"), F.lit(0)).alias("gaps"),
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("same_instant"),
        F.count_if(F.col("starts") - F.col("ends") != 1).alias("not_one_open"),
        F.coalesce(F.sum("empty"), F.lit(0)).alias("empty_intervals"),
    )


def differences(left: DataFrame, right: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Keys whose ``columns`` differ between two frames, or exist on one side only."""
    a = left.select(*key, F.struct(*columns).alias("_l"))
    b = right.select(*key, F.struct(*columns).alias("_r"))
    return a.join(b, key, "full").where(~F.col("_l").eqNullSafe(F.col("_r")))
