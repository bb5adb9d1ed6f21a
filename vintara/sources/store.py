"""The vintage store: an append-only Parquet dataset partitioned by country."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from ..functions.ordered import HOT_ROWS, hot_keys
from ..schema import CRAWL_LOG, OBSERVATION_COLUMNS, OBSERVATION_VINTAGE

BLOOMS = ["canonical_series_id", "period"]
CLUSTERING = ["canonical_series_id", "period", "available_at"]


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet with a declared schema; a dataset that was never written is empty."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_vintages(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of the store."""
    return read_or_empty(spark, path, OBSERVATION_VINTAGE)


def read_touched(spark: SparkSession, path: str, batch: DataFrame, listed: int = 1000) -> DataFrame:
    """The part of the store that a delivery can meet: its countries, series and span of periods as literals, so that the scan leaves
    out folders, files and row groups (by statistics, dictionaries and Bloom filters) before anything is joined.

    A delivery of more than ``listed`` series is not listed; joins on its keys then prune by country alone.
    """
    stored = read_vintages(spark, path)
    keys = batch.groupBy("country", "canonical_series_id").agg(F.min("period").alias("low"), F.max("period").alias("high")).limit(listed + 1).collect()
    if not keys or len(keys) > listed or any(x is None for k in keys for x in k):
        return stored
    return stored.where(F.col("country").isin(*{k["country"] for k in keys}) & F.col("canonical_series_id").isin(*{k["canonical_series_id"] for k in keys})
                        & F.col("period").between(min(k["low"] for k in keys), max(k["high"] for k in keys)))


def fetch_all(vintages: DataFrame) -> DataFrame:
    """Everything in reading order."""
    return vintages.orderBy("canonical_series_id", "period", "vintage_no", "source", "available_at")


def in_ranges(rows: DataFrame) -> DataFrame:
    """Rows in ranges of (country, series, period): few files per country and delivery, sorted so that row groups prune
    on series and period."""
    return rows.repartitionByRange("country", *CLUSTERING).sortWithinPartitions("country", *CLUSTERING)


def write_ranges(rows: DataFrame, path: str) -> None:
    """Append rows that :func:`in_ranges` put in order; row groups too varied for a dictionary carry Bloom filters of series and period."""
    _with_blooms(rows.write.mode("append").partitionBy("country")).parquet(path)


def _with_blooms(writer: DataFrameWriter) -> DataFrameWriter:
    for column in BLOOMS:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


def append_vintages(rows: DataFrame, path: str) -> None:
    write_ranges(in_ranges(rows.select(*OBSERVATION_COLUMNS)), path)


def rewrite_clustered(vintages: DataFrame, target: str, files: int | None = None) -> None:
    """Merge small files into a new version folder; the old one stays as it is.

    Range partitioning on (country, series, period, available_at) spreads a hot series over
    several files, which a hash on the series could not.
    """
    keys = ["country", *CLUSTERING]
    ranged = vintages.repartitionByRange(files, *keys) if files else vintages.repartitionByRange(*keys)
    _with_blooms(ranged.sortWithinPartitions(*keys).write.mode("errorifexists").partitionBy("country")).parquet(target)


def write_events(events: DataFrame, path: str) -> None:
    """Effective intervals in a folder per country, in ranges of the year they begin and the time they end.

    An as-of read then needs few row groups: those that begin before T and end after it. Bounds are kept without a zone, in
    UTC, as only such Parquet instants carry statistics under every session.
    """
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")}
    order = [F.col("country"), F.year("valid_from"), F.col("valid_to").asc_nulls_last(), F.col("valid_from")]
    events.withColumns(bounds).repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").partitionBy(
        "country").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Scan of the intervals; conditions on country and both bounds are pushed into it."""
    return spark.read.option("basePath", path).parquet(path).withColumn("country", F.col("country").cast("string"))


def write_hot_keys(vintages: DataFrame, path: str, keys: list[str], threshold: int = HOT_ROWS) -> None:
    """Keep the keys over the threshold beside the store; readers pass the list to the ordered operators."""
    hot_keys(vintages, keys, threshold).write.mode("overwrite").parquet(path)


def new_crawl_events(log: DataFrame, events: DataFrame) -> DataFrame:
    """Events whose id the log does not hold; repeats inside the batch count once."""
    return events.dropDuplicates(["crawl_id"]).join(log.select("crawl_id").distinct(), "crawl_id", "left_anti")


def append_crawl_events(log_path: str, events: DataFrame) -> None:
    known = read_or_empty(events.sparkSession, log_path, CRAWL_LOG)
    new_crawl_events(known, events.select(*CRAWL_LOG.fieldNames())).write.mode("append").parquet(log_path)


def replace_keyed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` take the place of ``old`` rows with their key."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def without_sources(vintages: DataFrame, excluded: list[str]) -> DataFrame:
    """Copy without some sources, compared in upper case."""
    return vintages.where(~F.upper("source").isin(*[s.upper() for s in excluded]))
