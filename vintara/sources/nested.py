"""Nested deliveries: JSON blocks, JSONP, data nodes, XML feeds, curve tables.

Each input is a frame with one response text per row (``payload``); each output has one row
per observation. Arrays are exploded where they lie, so a response never meets another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.instants import evaluated
from ..functions.texts import plain_text
from ..operators.text import table_cells

BLOCKS = ("pulled_at string, response struct<data: array<struct<"
          "meta: struct<code: string, name: string, unit: string, freq: string>, date: array<string>, value: array<double>>>>")


def json_blocks(payloads: DataFrame, keys: list[str], column: str = "payload") -> DataFrame:
    """``response.data[]`` of {meta, date[], value[]} to one row per (code, date).

    A block whose arrays differ in length gives one row with ``problem``.
    """
    blocks = payloads.select(*keys, F.from_json(column, BLOCKS).alias("_p")).select(
        *keys, F.explode("_p.response.data").alias("_b"))
    same = F.coalesce(F.size("_b.date") == F.size("_b.value"), F.lit(False))
    none = F.arrays_zip(F.array(F.lit(None).cast("string")).alias("date"), F.array(F.lit(None).cast("double")).alias("value"))
    pairs = F.when(same, F.arrays_zip(F.col("_b.date").alias("date"), F.col("_b.value").alias("value"))).otherwise(none)
    return blocks.select(
        *keys, "_b.meta.code", "_b.meta.name", "_b.meta.unit", "_b.meta.freq",
        F.when(~same, F.lit("length_mismatch")).alias("problem"), F.inline(pairs)
    ).withColumn("date", F.to_date("date", "yyyyMMdd"))


def _month(text: Column) -> Column:
    """``YYYY-MM`` of a label such as 2001.3, 2001-03-01 or 200103."""
    year, month = F.regexp_extract(text, r"(\d{4})\D?(\d{1,2})", 1), F.regexp_extract(text, r"(\d{4})\D?(\d{1,2})", 2)
    return F.when(year != "", F.concat(year, F.lit("-"), F.lpad(month, 2, "0")))


def _measured(rows: DataFrame) -> DataFrame:
    typed = evaluated(rows.withColumn("value", F.col("raw").try_cast("double")).drop("raw"))
    return typed.where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")) & F.col("period").isNotNull())


def result_objects(payloads: DataFrame, keys: list[str], measures: dict[str, str], date_field: str = "REPORT_DATE",
                   column: str = "payload") -> DataFrame:
    """``result.data[]`` objects to one row per object and measure; ``measures`` maps field to series."""
    fields = ", ".join(f"{name}: string" for name in [date_field, *measures])
    objects = payloads.select(*keys, F.from_json(column, f"result struct<data: array<struct<{fields}>>>").alias("_p")).select(
        *keys, F.explode("_p.result.data").alias("_o"))
    cells = F.array(*[F.struct(F.lit(series).alias("canonical_series_id"), F.col(f"_o.{name}").alias("raw"))
                      for name, series in measures.items()])
    return _measured(objects.select(*keys, _month(F.col(f"_o.{date_field}")).alias("period"), F.inline(cells)))


# The last marker, then an array of flat arrays; strings may hold brackets. Atomic and
# possessive parts never backtrack, so an unterminated last array matches nothing.
JSONP_DATA = r'(?s)^(?>.*,data:)\s*(\[(?:\s*+\[(?:"(?:[^"\\]++|\\.)*+"|[^\[\]"]++)*+\]\s*+,?)*+\s*+\])'


def jsonp_rows(payloads: DataFrame, keys: list[str], measures: dict[int, str], column: str = "payload",
               where: dict[int, str] | None = None) -> DataFrame:
    """Last ``,data:`` array of positional arrays; ``measures`` maps an index to a series.

    ``where`` keeps only arrays with given texts at given positions. No array: ``problem``
    has to be looked for with :func:`without_data`.
    """
    rows = payloads.select(*keys, F.from_json(F.regexp_extract(column, JSONP_DATA, 1), "array<array<string>>").alias("_d")).select(
        *keys, F.explode("_d").alias("_r"))
    for index, text in (where or {}).items():
        rows = rows.where(F.trim(F.get("_r", F.lit(index))) == text)
    cells = F.array(*[F.struct(F.lit(series).alias("canonical_series_id"), F.get("_r", F.lit(index)).alias("raw"))
                      for index, series in measures.items()])
    return _measured(rows.select(*keys, _month(F.get("_r", F.lit(0))).alias("period"), F.inline(cells)))


def without_data(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Responses whose data array is missing or unterminated."""
    return payloads.where(F.regexp_extract(column, JSONP_DATA, 1) == "")


NODES = ("returndata struct<datanodes: array<struct<data: struct<data: double, hasdata: boolean>, "
         "wds: array<struct<wdcode: string, valuecode: string>>>>>")


def data_nodes(payloads: DataFrame, keys: list[str], mapping: DataFrame, column: str = "payload") -> DataFrame:
    """Nodes with data, their dimension list turned into columns, mapped to series.

    ``mapping`` has ``source_series_id, canonical_series_id, unit``.
    """
    nodes = payloads.select(*keys, F.from_json(column, NODES).alias("_p")).select(
        *keys, F.explode("_p.returndata.datanodes").alias("_n")).where("_n.data.hasdata")
    dimensions = F.map_from_entries(F.transform("_n.wds", lambda w: F.struct(w["wdcode"], w["valuecode"])))
    flat = nodes.select(*keys, dimensions.alias("_w"), F.col("_n.data.data").alias("value")).select(
        *keys, F.col("_w")["zb"].alias("source_series_id"), F.col("_w")["sj"].alias("_sj"), "value")
    return evaluated(flat).where(F.col("_sj").rlike(r"^\d{6}$")).join(mapping, "source_series_id").select(
        *keys, "source_series_id", "canonical_series_id", "unit",
        F.concat_ws("-", F.substring("_sj", 1, 4), F.substring("_sj", 5, 2)).alias("period"), "value")


def feed_entries(payloads: DataFrame, keys: list[str], tenors: dict[str, str], column: str = "payload") -> DataFrame:
    """Feed entries' properties to one row per date and tenor; ``tenors`` maps element to series."""
    fields = ", ".join(f"{name}: string" for name in ["NEW_DATE", *tenors])
    schema = f"entry array<struct<content: struct<properties: struct<{fields}>>>>"
    entries = payloads.select(*keys, F.from_xml(column, schema, {"ignoreNamespace": "true"}).alias("_f")).select(
        *keys, F.explode("_f.entry").alias("_e")).select(*keys, F.col("_e.content.properties").alias("_q"))
    cells = F.array(*[F.struct(F.lit(series).alias("canonical_series_id"), F.col(f"_q.{name}").alias("raw"))
                      for name, series in tenors.items()])
    rows = entries.select(*keys, F.substring("_q.NEW_DATE", 1, 10).try_cast("date").alias("day"), F.inline(cells))
    typed = evaluated(rows.withColumn("value", F.trim("raw").try_cast("double")).drop("raw"))
    return typed.where("day IS NOT NULL AND value IS NOT NULL")


CURVE_HEADER = ("Yield Curve Name", "Date")


def curve_tables(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Yield-curve tables (curve, date, one column per tenor) to one row per (curve, day, tenor)."""
    tables = pages.select(*keys, F.explode(table_cells(F.col(html), plain_text)).alias("_rows")).withColumn(
        "_head", F.get("_rows", F.lit(0)))
    curves = tables.where((F.get("_head", F.lit(0)) == CURVE_HEADER[0]) & (F.get("_head", F.lit(1)) == CURVE_HEADER[1]))
    lines = curves.select(*keys, "_head", F.explode(F.slice("_rows", 2, F.size("_rows"))).alias("_r"))
    rest = F.greatest(F.least(F.size("_head"), F.size("_r")) - 2, F.lit(0))
    cells = lines.select(
        *keys, F.get("_r", F.lit(0)).alias("curve"), F.get("_r", F.lit(1)).try_cast("date").alias("day"),
        F.inline(F.arrays_zip(F.slice("_head", F.lit(3), rest).alias("tenor"), F.slice("_r", F.lit(3), rest).alias("raw"))))
    typed = evaluated(cells.withColumn("value", F.col("raw").try_cast("double")).drop("raw"))
    return typed.where("day IS NOT NULL AND value IS NOT NULL")
