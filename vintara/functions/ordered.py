"""Order-dependent steps (top row, neighbours, ordinals) that survive a hot key.

``top_row`` keeps the row-number filter shape that Spark runs as a group limit *before* the
shuffle, so a key holding a third of all rows ships one row per map task.

Neighbours need a key's rows in order. Ordinary keys use a plain window. Keys listed as hot
(:func:`hot_keys`, counted when the store is maintained and kept beside it) are cut into time chunks, each
chunk is a group of its own, and a small frame with one row per (hot key, chunk) stitches the chunk
borders; results are the same. The list is passed in, so nothing runs while a query is built and a plan
depends on what the caller passes, never on the size of the data. It holds at most ``rows / threshold`` keys,
and whether to broadcast it is left to the planner, who sees its size.

Key columns are never null in the store's contract, so plain equality joins keys and the
big side keeps the partitioning its window already has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

HOT_ROWS = 2_000_000  # rows of one key that a task should not have to sort alone
CHUNK_SECONDS = 3600
ORDINARY = -(2**62)  # chunk number of every row whose key is not hot


def newest(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def oldest(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def top_row(frame: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key in ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def time_chunk(column: str) -> Column:
    """Hour number of an instant column."""
    return F.floor(F.unix_seconds(F.col(column).cast("timestamp")) / CHUNK_SECONDS).cast("long")


def number_chunk(column: str, width: int = 100_000) -> Column:
    return F.floor(F.col(column) / width).cast("long")


def hot_keys(frame: DataFrame, keys: Sequence[str], threshold: int = HOT_ROWS) -> DataFrame:
    """Keys holding more than ``threshold`` rows: key columns only, counted map-side. Meant to be written
    beside the store, see ``sources.store.write_hot_keys``."""
    return frame.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > threshold).select(*keys)


class HotKeys:
    """How rows of ``keys`` are grouped: the keys in ``listed`` in chunks, all others whole."""

    def __init__(self, keys: Sequence[str], listed: DataFrame | None = None):
        self.keys = list(keys)
        self.list = None if listed is None else listed.select(*keys)

    def chunked(self, frame: DataFrame, chunk: Column) -> DataFrame:
        """Add ``_chunk``: ``chunk`` on rows of hot keys, ``ORDINARY`` elsewhere."""
        if self.list is None:
            return frame.withColumn("_chunk", F.lit(ORDINARY).cast("long"))
        return frame.join(self.list.withColumn("_hot", F.lit(True)), self.keys, "left").withColumn(
            "_chunk", F.when(F.col("_hot"), chunk).otherwise(F.lit(ORDINARY)).cast("long")
        ).select(*frame.columns, "_chunk")

    @property
    def group(self) -> list[str]:
        """Partitioning that never holds a whole hot key."""
        return self.keys if self.list is None else [*self.keys, "_chunk"]


def neighbours(
    frame: DataFrame,
    order: Sequence[tuple[str, str]],
    hot: HotKeys,
    *,
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    ordinal: str | None = None,
) -> DataFrame:
    """Values of the previous / next row and a 1-based ordinal per key.

    ``frame`` has ``_chunk`` from :meth:`HotKeys.chunked`, which must not decrease along
    ``order``, a list of (column, "asc" | "desc") that is total within a key.
    ``previous`` and ``following`` map a new column to the column it copies.
    """
    previous, following = previous or {}, following or {}
    inside = Window.partitionBy(*hot.group).orderBy(
        *[F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last() for c, d in order])
    kept = [c for c in frame.columns if c not in (*previous, *following, ordinal, "_chunk")]
    if hot.list is None:
        return frame.select(
            *kept,
            *[F.lag(c).over(inside).alias(n) for n, c in previous.items()],
            *[F.lead(c).over(inside).alias(n) for n, c in following.items()],
            *([F.row_number().over(inside).alias(ordinal)] if ordinal else []),
        )
    local = frame.withColumns({
        "_rn": F.row_number().over(inside),
        **{f"_p_{n}": F.lag(c).over(inside) for n, c in previous.items()},
        **({"_last": F.lead(F.lit(False), 1, True).over(inside)} if following else {}),
        **{f"_f_{n}": F.lead(c).over(inside) for n, c in following.items()},
    })
    rank = F.struct(*[_sortable(frame, c, d) for c, d in order])
    used = list(dict.fromkeys([*hot.group, *[c for c, _ in order], *previous.values(), *following.values()]))
    borders = frame.select(*used).where(F.col("_chunk") != ORDINARY).groupBy(*hot.group).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.max_by(c, rank).alias(f"_tail_{n}") for n, c in previous.items()],
        *[F.min_by(c, rank).alias(f"_head_{n}") for n, c in following.items()],
    )
    # one row per (hot key, chunk): bounded by the time span, not by the rows
    across = Window.partitionBy(*hot.keys).orderBy("_chunk")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    stitched = borders.select(
        *hot.group, F.lit(True).alias("_stitched"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        *[F.lag(f"_tail_{n}").over(across).alias(f"_bp_{n}") for n in previous],
        *[F.lead(f"_head_{n}").over(across).alias(f"_bf_{n}") for n in following],
    )
    return local.join(stitched, hot.group, "left").select(
        *kept,
        *[F.when((F.col("_rn") == 1) & F.col("_stitched"), F.col(f"_bp_{n}")).otherwise(F.col(f"_p_{n}")).alias(n)
          for n in previous],
        *[F.when(F.col("_last") & F.col("_stitched"), F.col(f"_bf_{n}")).otherwise(F.col(f"_f_{n}")).alias(n)
          for n in following],
        *([(F.col("_rn") + F.coalesce(F.col("_before"), F.lit(0))).cast("int").alias(ordinal)] if ordinal else []),
    )


def with_neighbours(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, str]],
    *,
    hot: DataFrame | None = None,
    chunk: Column | None = None,
    **wanted,
) -> DataFrame:
    """:func:`neighbours` for a frame without chunks; the chunk is the hour, day or run of
    the first order column."""
    column, direction = order[0]
    if chunk is None:
        kind = frame.schema[column].dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz"):
            chunk = time_chunk(column)
        elif kind == "date":
            chunk = F.unix_date(column).cast("long")
        else:
            chunk = number_chunk(column)
        chunk = -chunk if direction == "desc" else chunk
    grouped = HotKeys(keys, hot)
    return neighbours(grouped.chunked(frame, chunk), order, grouped, **wanted)


def running_last(frame: DataFrame, order: Sequence[str], hot: HotKeys, column: str, into: str) -> DataFrame:
    """Last non-null ``column`` at or before each row of its key, in ascending ``order``.

    ``frame`` has ``_chunk``; what earlier chunks of a hot key end with is carried in.
    """
    inside = Window.partitionBy(*hot.group).orderBy(*oldest(*order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = frame.withColumn(into, F.last(column, ignorenulls=True).over(inside))
    if hot.list is None:
        return local.drop("_chunk")
    rank = F.when(F.col(column).isNotNull(), F.struct(*[_sortable(frame, c, "asc") for c in order]))
    ends = frame.select(*dict.fromkeys([*hot.group, *order, column])).where(F.col("_chunk") != ORDINARY).groupBy(*hot.group).agg(
        F.max_by(column, rank).alias("_end"))
    across = Window.partitionBy(*hot.keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*hot.group, F.last("_end", ignorenulls=True).over(across).alias("_carry"))
    return local.join(carried, hot.group, "left").withColumn(
        into, F.coalesce(F.col(into), F.col("_carry"))).drop("_carry", "_chunk")


def _sortable(frame: DataFrame, column: str, direction: str) -> Column:
    """A value whose ascending order is ``column``'s order in ``direction``, nulls last."""
    value = F.col(column)
    if direction == "desc":
        kind = frame.schema[column].dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz"):
            value = -F.unix_micros(value.cast("timestamp"))
        elif kind == "date":
            value = -F.unix_date(value)
        elif kind in ("integer", "long", "double"):
            value = -value
        else:
            raise ValueError(f"no descending order for {kind} column {column}")
    return F.struct(F.col(column).isNull().alias("n"), value.alias("v")).alias(f"o_{column}")
