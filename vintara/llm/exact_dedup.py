"""Exact duplicates: group by a 128-bit hash of the normalised text, compare the bytes inside groups.

Texts are equal when they are identical after white space (``\\x20``, ``\\x09-\\x0D``) is deleted. Rows meet by
(hash, normalised text), so the bytes themselves decide and two texts with one hash stay apart. The
aggregation combines before the shuffle: a group with a third of all rows sends one row per task.
The verdicts then go back to rows that carry hashes only.

Defined cases: a null text counts as empty, and empty texts are equal to each other. A null id
loses every tie and gets ``keep_id`` like any other row. In :func:`exact_duplicates`, whose verdicts name ids, rows that repeat one id, or
have none, share a verdict; :func:`without_duplicates` tells them apart and keeps one row of a group. An empty table gives an empty result. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from vintara.llm.common import ROW_BITS, ordered, whole_text, without_characters, written

SPACE = " \t\n\x0b\f\r"
# One decimal orders rows by (code points, smaller id): it stays in the hash aggregation's buffer.
_SPAN = "100000000000000000000"  # 10**20, over the span of 64-bit ids
_TOP = 2**63 - 1


def _standing(characters: Column, identifier: Column) -> Column:
    turned = F.lit(_TOP).cast("decimal(20,0)") - identifier.cast("decimal(20,0)") + F.lit(1).cast("decimal(20,0)")
    return (characters.cast("decimal(12,0)") * F.lit(_SPAN).cast("decimal(21,0)")
            + F.coalesce(turned, F.lit(0).cast("decimal(20,0)"))).cast("decimal(35,0)")


def _identifier(standing: Column) -> Column:
    turned = standing % F.lit(_SPAN).cast("decimal(21,0)")
    return F.when(turned > 0, (F.lit(_TOP).cast("decimal(20,0)") - (turned - 1)).cast("long"))


def exact_duplicates(docs: DataFrame, text: str = "text", identifier: str = "doc_id",
                     content_hash: Callable[[Column], Column] = F.md5, row: str | None = None) -> DataFrame:
    """One row per document: ``identifier``, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text stays, then the smallest
    id. ``content_hash`` is the 128-bit hash that rows meet by; any weaker one gives equal results. ``row`` names a
    column that numbers the rows whose ids are null or repeated, ascending with the ids, and is null in others: it then tells them apart and comes
    last in the result.
    """
    extra = [] if row is None else [F.col(row).alias("_row")]
    normal = without_characters(whole_text(text), SPACE)
    rows = docs.select(F.col(identifier).cast("long").alias("_id"), F.char_length(whole_text(text)).alias("_n"),
                       normal.alias("_normal"), *extra).withColumn("_hash", content_hash(F.col("_normal")))
    rest = [] if row is None else [F.col("_row")]
    classes = rows.groupBy("_hash", "_normal").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(_standing(F.col("_n"), F.col("_id"))).alias("_best"),
        *[F.max(F.when(x.isNotNull(), _standing(F.col("_n"), x))).alias("_best_row") for x in rest]
    ).select(F.col("_hash").alias("_class_hash"), F.sha2(F.col("_normal"), 256).alias("_class_sha"),
             "group_size", _identifier(F.col("_best")).alias("keep_id"), *[_identifier(F.col("_best_row")).alias("_keep_row") for _ in rest])
    light = rows.select("_id", *rest, "_hash", F.sha2(F.col("_normal"), 256).alias("text_sha256"))
    same = (light["_hash"] == classes["_class_hash"]) & (light["text_sha256"] == classes["_class_sha"])
    kept = F.col("_id").eqNullSafe(F.col("keep_id"))
    if row is not None:
        kept = kept & (F.col("_row").isNull() | F.col("_row").eqNullSafe(F.col("_keep_row")))
    return light.join(classes, same).select(
        F.col("_id").alias(identifier), "keep_id", F.col("group_size").cast("long"), kept.alias("kept"), "text_sha256", *rest)


def without_duplicates(docs: DataFrame, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each different text, with all its columns: that with the most code points, then the smallest id, null ids
    last; of rows alike in this any one. Rows that repeat an id, or have none, are judged one by one."""
    rows = docs.select(F.struct("*").alias("doc"))  # columns of any name stay apart
    key = F.col(f"doc.{identifier}").cast("long")
    repeated = written(rows.groupBy(key.alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 OR _id IS NULL").select("_id"), "repeated-ids")
    # only these rows need a number; numbers ascend with the ids, so the least number belongs to the least id
    told = rows.join(repeated, key.eqNullSafe(F.col("_id")), "left_semi")
    told = ordered(told.withColumn("_key", key), [F.col("_key").asc_nulls_last()], "repeated")
    told = told.select("doc", (F.shiftleft("_task", ROW_BITS) + F.col("_row")).cast("long").alias("row"))
    rows = rows.join(repeated, key.eqNullSafe(F.col("_id")), "left_anti").select("doc", F.lit(None).cast("long").alias("row")).unionAll(told)
    read = rows.select(key.alias("key"), F.col(f"doc.{text}").alias("text"), "row")
    kept = exact_duplicates(read, "text", "key", row="row").where("kept").select(F.col("key").alias("_kept_id"), F.col("_row").alias("_kept_row"))
    same = key.eqNullSafe(F.col("_kept_id")) & F.col("row").eqNullSafe(F.col("_kept_row"))
    return rows.join(kept, same, "left_semi").select("doc.*")
