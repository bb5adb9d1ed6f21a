"""Bitemporal append: dedup by signature, number vintages, classify revisions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordered import HotKeys, neighbours, oldest, time_chunk, top_row
from ..plans.policy import WEB_REVISION
from ..schema import OBSERVATION_COLUMNS
from .contracts import finite, vendor_revision

KEY = ["source", "canonical_series_id", "period"]
TOLERANCE = 1e-12
IDENTITY = [*KEY, "value", "pit_grade", "unit", "frequency"]
TEMPORAL = ["release_at", "available_at", "release_date_source"]
SIGNATURE = [*IDENTITY, *[f"sig_{c}" for c in TEMPORAL]]


def same_value(left: Column, right: Column) -> Column:
    return F.abs(left - right) <= TOLERANCE


def with_signature(frame: DataFrame) -> DataFrame:
    """Add the temporal part of the vintage signature.

    Ordinary grade-D rows are archival snapshots, so their times say nothing; for all
    other rows, and for dated vendor revisions, they are part of the identity.
    """
    ordinary = (F.col("pit_grade") == "D") & ~vendor_revision(F.col("release_date_source"))
    return frame.withColumns({f"sig_{c}": F.when(~ordinary, F.col(c)) for c in TEMPORAL})


def of_batch(history: DataFrame, batch: DataFrame) -> DataFrame:
    """History of the keys a batch touches. The store is partitioned by country, so the join
    lets Spark leave out the folders of other countries before it reads them."""
    touched = batch.select("country", *KEY).distinct()
    return history.join(touched, ["country", *KEY], "left_semi")


def unknown(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Batch rows whose signature history does not hold."""
    known = with_signature(of_batch(history, batch)).select(*[F.col(c).alias(f"_h_{c}") for c in SIGNATURE]).distinct()
    same = [F.col(c) == F.col(f"_h_{c}") for c in IDENTITY]
    same += [F.col(f"sig_{c}").eqNullSafe(F.col(f"_h_sig_{c}")) for c in TEMPORAL]
    return with_signature(batch).join(known, same, "left_anti").drop(*[f"sig_{c}" for c in TEMPORAL])


def new_rows(batch: DataFrame, history: DataFrame, sequence: str = "ingest_seq") -> DataFrame:
    """Batch rows whose signature is neither in history nor earlier in the batch.

    Both sides shrink to distinct signatures map-side before they meet.
    """
    first = top_row(with_signature(batch), SIGNATURE, oldest("available_at", sequence)).drop(*[f"sig_{c}" for c in TEMPORAL])
    return unknown(first, history)


def latest_vintage(history: DataFrame, columns: list[str], order: list[str] = ("vintage_no", "available_at")) -> DataFrame:
    """One row per (source, series, period): ``columns`` of the newest vintage, prefixed ``latest_``."""
    ties = [c for c in ("retrieved_at", "raw_sha256") if c not in order]
    best = history.groupBy(*KEY).agg(
        F.max(F.struct(*order, *ties, F.struct(*columns).alias("row"))).alias("_latest"))
    return best.select(*KEY, *[F.col(f"_latest.row.{c}").alias(f"latest_{c}") for c in columns])


def versioned(batch: DataFrame, history: DataFrame, sequence: str = "ingest_seq", hot: DataFrame | None = None) -> DataFrame:
    """Rows to append, with ``vintage_no``, ``revision_type``, ``revision_delta`` and ``reject_reason``.

    Numbers continue the history of the key in order of (available_at, sequence). Each row
    is compared with the one before it; a dated vendor revision keeps its supplied delta.
    """
    for column, kind in (("revision_type", "string"), ("revision_delta", "double")):
        if column not in batch.columns:
            batch = batch.withColumn(column, F.lit(None).cast(kind))
    fresh = new_rows(batch.drop("vintage_no"), history, sequence)
    grouped = HotKeys(KEY, hot)
    ordered = neighbours(
        grouped.chunked(fresh, time_chunk("available_at")), [("available_at", "asc"), (sequence, "asc")], grouped,
        previous={"_batch_previous": "value"}, ordinal="_position",
    )
    # a left join on the key alone: adaptive execution splits a hot key's rows here
    joined = ordered.join(latest_vintage(of_batch(history, batch), ["value", "vintage_no"]), KEY, "left")
    previous = F.coalesce("_batch_previous", "latest_value")
    number = F.coalesce(F.col("latest_vintage_no") + 1, F.lit(0)) + F.col("_position") - 1
    supplied = (
        (F.col("pit_grade") == "D") & vendor_revision(F.col("release_date_source"))
        & (F.lower(F.coalesce("revision_type", F.lit(""))) == "revision") & F.col("revision_delta").isNotNull()
    )
    initial = number == 0
    unchanged = same_value(F.col("value"), previous)
    bad_delta = ~finite(F.col("revision_delta")) | same_value(F.col("revision_delta"), F.lit(0.0))
    return joined.withColumns({
        "vintage_no": number.cast("int"),
        "reject_reason": F.when(~initial & supplied & bad_delta, F.lit("documented_revision_needs_non_zero_delta")),
        "revision_type": F.when(initial, F.lit("initial")).when(supplied, F.lit("revision"))
        .when(unchanged, F.lit("metadata_update")).otherwise(F.lit("revision")),
        "revision_delta": F.when(initial, F.lit(None).cast("double")).when(supplied, F.col("revision_delta"))
        .when(unchanged, F.lit(0.0)).otherwise(F.col("value") - previous),
    }).drop("_batch_previous", "_position", "latest_value", "latest_vintage_no")


def statistics(batch: DataFrame, appended: DataFrame) -> DataFrame:
    """One row: inserted, revisions, metadata_updates, unchanged."""
    delivered = batch.select(F.lit(1).alias("delivered"), F.lit(None).cast("string").alias("kind"))
    written = appended.select(F.lit(0).alias("delivered"), F.col("revision_type").alias("kind"))
    totals = delivered.unionByName(written).agg(
        F.count("kind").alias("inserted"),
        F.count_if(F.col("kind") == "revision").alias("revisions"),
        F.count_if(F.col("kind") == "metadata_update").alias("metadata_updates"),
        F.coalesce(F.sum("delivered"), F.lit(0)).alias("_delivered"),
    )
    return totals.select("inserted", "revisions", "metadata_updates",
                         (F.col("_delivered") - F.col("inserted")).alias("unchanged"))


# What a delivery states about a value, whatever it was marked as later.
STATED = [*KEY, "value", "source_url", "first_seen_at"]


def unmarked(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Batch rows that history does not hold as marked revisions already."""
    marked = of_batch(history, batch).where(F.col("release_date_source") == WEB_REVISION)
    stated = marked.select(*[F.col(c).alias(f"_s_{c}") for c in STATED]).distinct()
    return batch.join(stated, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in STATED], "left_anti")


def mark_first_seen_revisions(batch: DataFrame, history: DataFrame) -> DataFrame:
    """A changed value at an unchanged URL is usable only from when it was seen.

    Such a row becomes grade D without a release time, available at ``first_seen_at``. Only the newest vintage is compared with:
    a value that an older one had is a change, too. Replayed deliveries are kept out beforehand, see :func:`unmarked`.
    """
    joined = batch.join(latest_vintage(of_batch(history, batch), ["value", "source_url"]), KEY, "left")
    changed = F.coalesce(
        (F.col("latest_source_url") == F.col("source_url")) & ~same_value(F.col("latest_value"), F.col("value")),
        F.lit(False))
    return joined.withColumns({
        "release_at": F.when(~changed, F.col("release_at")),
        "available_at": F.when(changed, F.col("first_seen_at")).otherwise(F.col("available_at")),
        "pit_grade": F.when(changed, F.lit("D")).otherwise(F.col("pit_grade")),
        "release_date_source": F.when(changed, F.lit(WEB_REVISION)).otherwise(F.col("release_date_source")),
    }).select(*batch.columns)


def stabilize_snapshots(batch: DataFrame, history: DataFrame) -> DataFrame:
    """An unchanged value keeps the times and marker of the vintage it repeats."""
    inherited = ["release_at", "release_date_source", "first_seen_at", "available_at"]
    joined = batch.join(latest_vintage(of_batch(history, batch), ["value", *inherited]), KEY, "left")
    repeats = F.coalesce(same_value(F.col("latest_value"), F.col("value")), F.lit(False))
    return joined.withColumns({
        c: F.when(repeats, F.col(f"latest_{c}")).otherwise(F.col(c)) for c in inherited
    }).select(*batch.columns)


# URL paths of secondary and primary pages, percentage units, allowed change.
SECONDARY_PATH, PRIMARY_PATH = "/zxfbhjd/", "/zxfb/"
PERCENT_UNITS = ("pct", "pct_yoy")
LARGE_CHANGE = 10.0


def revision_anomalies(batch: DataFrame, history: DataFrame, *, secondary: str = SECONDARY_PATH,
                       primary: str = PRIMARY_PATH, large: float = LARGE_CHANGE) -> DataFrame:
    """Rows to hold for review: another URL contradicts the newest vintage.

    Either a secondary page contradicts a primary one, or a percentage moves by more than
    ``large``. Adds ``anomaly``, null on rows that may pass.
    """
    joined = batch.join(
        latest_vintage(of_batch(history, batch), ["value", "source_url"], ["available_at", "vintage_no"]), KEY, "left")
    differs = (F.col("latest_source_url") != F.col("source_url")) & ~same_value(F.col("latest_value"), F.col("value"))
    conflict = F.col("source_url").contains(secondary) & F.col("latest_source_url").contains(primary)
    jump = F.col("unit").isin(*PERCENT_UNITS) & (F.abs(F.col("value") - F.col("latest_value")) > large)
    return joined.withColumn(
        "anomaly",
        F.when(differs & conflict, F.lit("secondary_conflicts_with_primary")).when(differs & jump, F.lit("large_change")),
    ).select(*batch.columns, "anomaly")


def dated_revisions(delivery: DataFrame, tag: str, zone: str = "Asia/Shanghai") -> DataFrame:
    """Revision events from a snapshot that lists old and revised values with a date.

    Input: key columns, ``previous_value``, ``revised_value``, ``revision_date``. A listed
    row that changes nothing is an error, marked in ``reject_reason``.
    """
    from ..functions.instants import day_start_utc
    from ..plans.policy import VENDOR_REVISION
    return delivery.where("revised_value IS NOT NULL").withColumns({
        "value": F.col("revised_value"),
        "available_at": day_start_utc(F.col("revision_date"), zone),
        "release_date_source": F.concat(F.lit(f"{VENDOR_REVISION}{tag}_"), F.date_format("revision_date", "yyyyMMdd")),
        "revision_type": F.lit("revision"),
        "revision_delta": F.col("revised_value") - F.col("previous_value"),
        "pit_grade": F.lit("D"),
        "reject_reason": F.when(same_value(F.col("revised_value"), F.col("previous_value")), F.lit("unchanged_revision")),
    })


def pre_revision_overrides(delivery: DataFrame, zone: str = "Asia/Shanghai") -> DataFrame:
    """The value that was visible before each dated revision."""
    from ..functions.instants import day_start_utc
    return delivery.where("revised_value IS NOT NULL").select(
        "canonical_series_id", "source", "period", F.col("previous_value").alias("pre_revision_value"),
        day_start_utc(F.col("revision_date"), zone).alias("revision_at"))


@dataclass(frozen=True)
class AppendResult:
    inserted: int
    revisions: int
    metadata_updates: int
    unchanged: int


_FAILED = "vintara contract: "


def _or_fail(ok: Column, message: Column) -> Column:
    """A condition that holds, or stops the job with ``message``."""
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(_FAILED), message)).cast("boolean"))


def append(batch: DataFrame, path: str, sequence: str = "ingest_seq", minimum: int = 0) -> AppendResult:
    """Check, version and append one delivery to the store at ``path`` in one write; nothing is ever rewritten.

    The rows are checked and counted while they are written. A broken contract, or a delivery of less than ``minimum`` rows, stops the
    write, and nothing of it becomes visible. What was delivered travels as one more row behind the last shuffle, where the figures are taken: there a
    task that is repeated after a loss counts once.
    """
    from pyspark.errors import PySparkException
    from pyspark.sql import Observation

    from ..sources.store import in_ranges, read_touched, write_ranges
    from .contracts import ContractError, accepted_or_raise, checked, normalized
    rows = checked(batch)
    rows = rows.where(_or_fail(F.size("reasons") == 0, F.array_join("reasons", ";"))).drop("reasons")
    fresh = versioned(rows, read_touched(batch.sparkSession, path, normalized(batch)), sequence)
    fresh = fresh.where(_or_fail(F.col("reject_reason").isNull(), F.col("reject_reason")))
    delivered = rows.agg(F.count(F.lit(1)).alias("_delivered")).where(
        _or_fail(F.col("_delivered") >= minimum, F.concat(F.lit("too_few_rows x"), F.col("_delivered"))))
    figures = Observation()
    written = in_ranges(fresh.select(*OBSERVATION_COLUMNS).unionByName(delivered, allowMissingColumns=True)).observe(
        figures, F.count("revision_type").alias("inserted"), F.count_if(F.col("revision_type") == "revision").alias("revisions"),
        F.count_if(F.col("revision_type") == "metadata_update").alias("metadata_updates"), F.sum("_delivered").alias("delivered"))
    try:
        write_ranges(written.where("_delivered IS NULL").drop("_delivered"), path)
    except PySparkException as error:
        if _FAILED not in str(error):
            raise
        accepted_or_raise(batch)  # says how many rows break which rule
        raise ContractError(str(error).split(_FAILED, 1)[1].splitlines()[0].split(" SQLSTATE")[0]) from None
    seen = figures.get
    return AppendResult(seen["inserted"], seen["revisions"], seen["metadata_updates"], seen["delivered"] - seen["inserted"])
