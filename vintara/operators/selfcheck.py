"""Behavioural self-checks of the engine: leakage, same-day boundary, revision, idempotence.

They run the real operators on a handful of rows, so that a deployment can be checked
before it is trusted with data.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, types as T

from ..schema import OBSERVATION_VINTAGE
from .asof import snapshot
from .ingest import versioned


def _row(value: float, available: datetime, sequence: int) -> tuple:
    values = dict(
        country="CN", source="CHECK", canonical_series_id="CHECK_SERIES", source_series_id="C", series_name="check",
        frequency="M", unit="pct", seasonal_adjustment=None, period="2020-01", period_start=date(2020, 1, 1),
        period_end=date(2020, 1, 31), value=value, release_at=available, release_date_source="check",
        first_seen_at=available, available_at=available, vintage_no=0, revision_type="initial", revision_delta=None,
        pit_grade="A", source_url="https://check/1", raw_file="check", raw_sha256="c" * 64, retrieved_at=available,
        parser_version="check")
    return tuple(values[f.name] for f in OBSERVATION_VINTAGE) + (sequence,)


def selfcheck(spark: SparkSession) -> DataFrame:
    """Rows of (name, passed)."""
    at = datetime(2020, 2, 10, 1, 30, tzinfo=timezone.utc)
    later = datetime(2020, 3, 10, 1, 30, tzinfo=timezone.utc)
    schema = T.StructType([*OBSERVATION_VINTAGE, T.StructField("ingest_seq", T.LongType(), False)])

    def rows(*items) -> DataFrame:
        return spark.createDataFrame([_row(*item) for item in items], schema)
    empty = rows()
    first = versioned(rows((1.0, at, 0)), empty).drop("reject_reason")
    second = versioned(rows((1.0, at, 0), (1.5, later, 1)), first).drop("reject_reason")
    store = first.unionByName(second)

    def seen(cutoff: str) -> list[float]:
        return [r["value"] for r in snapshot(store, cutoff).collect()]
    appended = second.collect()
    checks = [
        ("leakage", seen("2020-02-01 00:00:00+00:00") == []),
        ("same_day_boundary", seen("2020-02-10 01:29:59+00:00") == [] and seen("2020-02-10 01:30:00+00:00") == [1.0]),
        ("revision", [(r["vintage_no"], r["revision_type"], r["revision_delta"]) for r in appended] == [(1, "revision", 0.5)]
         and seen("2020-03-09 00:00:00+00:00") == [1.0] and seen("2020-03-11 00:00:00+00:00") == [1.5]),
        ("idempotence", versioned(rows((1.0, at, 0), (1.5, later, 1)), store).isEmpty()),
    ]
    return spark.createDataFrame(checks, "name string, passed boolean")
