"""Incremental ingest: deliveries arrive as files, each micro-batch runs the batch operators.

Vintages are never dropped for being late: a late value is a new vintage. Watermarks bound the state of daily counts, and that of
repeats by their time of arrival.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators import contracts, ingest
from ..schema import OBSERVATION_COLUMNS
from ..session import cut_lineage, use_state_store
from ..sources.store import append_vintages, read_touched, read_vintages


def delivery_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files under ``path`` as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def append_batch(batch: DataFrame, store_path: str, quarantine_path: str | None = None, mark_revisions: bool = False,
                 batch_id: int = 0) -> None:
    """Check, version and append one micro-batch.

    Safe to replay: a row already stored has a known signature and is neither marked nor written again,
    and rejected rows replace those of the same ``batch_id``, so a batch that died half way can simply run once more.
    """
    spark = batch.sparkSession
    accepted, bad = contracts.quarantine(cut_lineage(batch))
    history = read_touched(spark, store_path, accepted)
    if mark_revisions:
        accepted = ingest.mark_first_seen_revisions(ingest.unmarked(ingest.unknown(accepted, history), history), history)
    rows = cut_lineage(ingest.versioned(accepted, history))
    append_vintages(rows.where("reject_reason IS NULL").select(*OBSERVATION_COLUMNS), store_path)
    if quarantine_path is not None:
        rejected = rows.where("reject_reason IS NOT NULL").select("ingest_seq", F.array("reject_reason").alias("reasons"))
        bad.select("ingest_seq", "reasons").unionByName(rejected).write.mode(
            "overwrite").parquet(f"{quarantine_path}/batch={batch_id}")


def stream_append(deliveries: DataFrame, store_path: str, checkpoint: str, quarantine_path: str | None = None,
                  mark_revisions: bool = False, repeats_within: str | None = None) -> StreamingQuery:
    """Run :func:`append_batch` for everything available, one writer at a time.

    With ``repeats_within`` a signature that was delivered in that time already is dropped before the store is asked.
    """
    if repeats_within is not None:
        deliveries = deduplicated(deliveries, repeats_within)
    return (
        deliveries.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda batch, number: append_batch(batch, store_path, quarantine_path, mark_revisions, number))
        .start()
    )


def deduplicated(deliveries: DataFrame, repeats_within: str, arrival: str | None = None) -> DataFrame:
    """Drop repeats of a signature that arrive within ``repeats_within`` of the first one.

    The watermark runs on the time of arrival (the batch's clock, or the column ``arrival``), never on the times that a row states: a row about
    an old period, or one that was retrieved long ago, is as new as any other and is not dropped for being late. The state
    holds the signatures of the last ``repeats_within`` and no more; a repeat that comes later passes, and :func:`stream_append` finds it in the store.
    """
    arrived = F.current_timestamp() if arrival is None else F.col(arrival)
    marked = ingest.with_signature(deliveries).withColumn("_arrived_at", arrived).withWatermark("_arrived_at", repeats_within)
    return marked.dropDuplicatesWithinWatermark(ingest.SIGNATURE).drop("_arrived_at", *[f"sig_{c}" for c in ingest.TEMPORAL])


def daily_status(attempts: DataFrame, delay: str | None = None) -> DataFrame:
    """Attempts and failures per day and source; with ``delay`` the input is a stream."""
    if delay is not None:
        attempts = attempts.withWatermark("completed_at", delay)
    return attempts.groupBy(F.window("completed_at", "1 day").alias("w"), "source").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(~F.col("success")).alias("failures"),
        F.count_if(F.col("error_type").contains("Parser")).alias("parse_failures"),
    ).select(F.col("w.start").alias("day_start"), "source", "attempts", "failures", "parse_failures")


def recheck(deliveries: DataFrame, now: str, months: int) -> DataFrame:
    """Bounded recheck: deliveries about recent periods only; works on batches and streams."""
    return contracts.within_lookback(deliveries, now, months)


def value_changes(deliveries: DataFrame, history: DataFrame, order: tuple[str, ...] = ("vintage_no", "available_at")) -> DataFrame:
    """Deliveries that change the newest stored value of their key at an unchanged address."""
    known = ingest.latest_vintage(ingest.of_batch(history, deliveries), ["value", "source_url"], list(order))
    return deliveries.join(known, ingest.KEY).where(
        (F.col("latest_source_url") == F.col("source_url"))
        & ~ingest.same_value(F.col("latest_value"), F.col("value"))
    ).withColumnRenamed("latest_value", "known_value").drop("latest_source_url")


# What the newest value of a key is by, and what the state of a key holds.
NEWEST = ["available_at", "retrieved_at", "raw_sha256", "value"]
LAST = "available_at long, retrieved_at long, raw_sha256 string, value double, source_url string, timer long"
CHANGE = ("country string, source string, canonical_series_id string, period string, ingest_seq long, value double, source_url string, "
          "known_value double, unseen boolean")


class LastValue(StatefulProcessor):
    """The newest value and address of a key, until nothing has arrived for it in ``keep_ms``."""

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", LAST)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.last.update((*(initialState[c] for c in (*NEWEST, "source_url")), None))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = tuple(self.last.get()) if self.last.exists() else None
        known, timer = (None, None) if held is None else (held[:5], held[5])
        best, arrived = known, 0
        for row in rows:
            if known is None or (known[4] == row["source_url"] and abs(known[3] - row["value"]) > ingest.TOLERANCE):
                yield Row(country=row["country"], source=row["source"], canonical_series_id=row["canonical_series_id"], period=row["period"],
                          ingest_seq=row["ingest_seq"], value=row["value"], source_url=row["source_url"],
                          known_value=None if known is None else known[3], unseen=known is None)
            stated = tuple(row[c] for c in (*NEWEST, "source_url"))
            if best is None or stated > best:
                best = stated
            arrived = max(arrived, row["_arrived_ms"])
        if self.keep_ms is not None and (timer is None or arrived + self.keep_ms > timer):
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = arrived + self.keep_ms
            self.handle.registerTimer(timer)
        self.last.update((*best, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def value_change_stream(deliveries: DataFrame, history: DataFrame | None = None, keep_ms: int | None = None,
                        arrival: str | None = None) -> DataFrame:
    """:func:`value_changes` for a stream of deliveries, with the newest value of each key as state.

    A micro-batch is compared with all that came before it: late rows, too, with the newest value, which they do not replace.
    ``history`` fills the state when the stream first starts; later batches read no store. A key for which nothing arrived in
    ``keep_ms`` (by the batch's clock, or the column ``arrival``) leaves the state; its next rows, like those of a key never met, come out
    as ``unseen`` with a null ``known_value``, and :func:`stream_value_changes` looks them up. Such state lives in RocksDB, beside the
    checkpoint and not on the heap.
    """
    use_state_store(deliveries.sparkSession)
    def in_micros(frame: DataFrame) -> DataFrame:  # instants as numbers, the same in rows and state
        return frame.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("available_at", "retrieved_at")})

    arrived = F.current_timestamp() if arrival is None else F.col(arrival)
    rows = in_micros(deliveries.withColumn("_arrived_at", arrived).select(
        "country", *ingest.KEY, "ingest_seq", *NEWEST, "source_url", "_arrived_at", F.unix_millis("_arrived_at").alias("_arrived_ms")))
    if keep_ms is not None:
        rows = rows.withWatermark("_arrived_at", "0 seconds")
    initial = None
    if history is not None:
        best = in_micros(history).groupBy(*ingest.KEY).agg(F.max(F.struct(*NEWEST, "source_url")).alias("row"))
        initial = best.select(*ingest.KEY, *[F.col(f"row.{c}").alias(c) for c in (*NEWEST, "source_url")]).groupBy(*ingest.KEY)
    return rows.groupBy(*ingest.KEY).transformWithState(
        LastValue(keep_ms), CHANGE, "Append", "None" if keep_ms is None else "EventTime", initial)


def stream_value_changes(deliveries: DataFrame, store_path: str, checkpoint: str, changes_path: str,
                         keep_ms: int | None = None, arrival: str | None = None) -> StreamingQuery:
    """Write what changes a known value to ``changes_path``, for everything available.

    Only rows of keys without state are looked up in the store, which must not hold their delivery yet. A batch that is run again
    replaces its own folder, so nothing is written twice.
    """
    def found(batch: DataFrame, number: int) -> None:
        rows = cut_lineage(batch)
        asked = value_changes(rows.where("unseen").drop("known_value"), read_vintages(batch.sparkSession, store_path), tuple(NEWEST))
        changes = rows.where("NOT unseen").unionByName(asked)
        changes.drop("unseen").write.mode("overwrite").parquet(f"{changes_path}/batch={number}")

    return value_change_stream(deliveries, None, keep_ms, arrival).writeStream.foreachBatch(found).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
