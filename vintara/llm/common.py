"""What several operators share: reading, the shared folder, and distributed order.

Wide rows are never put in order by one task. :func:`ordered` sorts light rows by range over many
tasks, and the running figures of the tasks before come from one row per task and group.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vintara.session import shared_folder

ROW_BITS = 33  # monotonically_increasing_id keeps the task above, the row in the task below this bit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A folder name that nobody uses yet, under the folder that all executors share."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def written(frame: DataFrame, kind: str) -> DataFrame:
    """``frame`` written as a table into the shared folder and read back: lineage ends there,
    a lost executor costs nothing that was done before, and later readers see one fixed content."""
    folder = new_folder(frame.sparkSession, kind)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def whole_text(column: str) -> Column:
    """The text itself; a missing text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without_characters(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def ordered(frame: DataFrame, keys: Sequence[str | Column], kind: str, tasks: int | None = None) -> DataFrame:
    """``frame`` in ascending order of ``keys`` over many tasks, written; ``_task`` and ``_row`` (both
    from 0) say where each row stands. Use it on light rows."""
    tasks = tasks or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = frame.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).withColumn(
        "_at", F.monotonically_increasing_id())
    return written(placed, kind).withColumns({
        "_task": F.shiftright("_at", ROW_BITS), "_row": F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)}).drop("_at")


def numbered(frame: DataFrame, group: str, order: str, into: str) -> DataFrame:
    """Adds ``into``: 0, 1, 2, ... within each ``group`` in ascending ``order``, however many rows
    one group has. The joined side has one row per task and group."""
    placed = ordered(frame, [group, order], "numbered")
    parts = placed.groupBy("_task", group).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_task", F.col(group).alias("_group"), "_first",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = (placed["_task"] == parts["_task"]) & placed[group].eqNullSafe(parts["_group"])
    return placed.join(parts, same).select(
        *frame.columns, (placed["_row"] - F.col("_first") + F.col("_before")).cast("long").alias(into))


def files_at(uri: str):
    """File system and path of a URI, on the driver or in a task; plain paths are local."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)
