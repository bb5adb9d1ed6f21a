"""Queries that write into the session's shared folder and read back what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..operators import asof, audit, ingest
from ..schema import INSTANT_COLUMNS, OBSERVATION_COLUMNS
from ..session import shared_folder
from ..sources import files, sinks, store
from ..streaming import incremental
from . import ORACLES, QUERIES, query
from .fixture import V, table, vintages
from .ingest import SPLIT, URGENT, split
from .intervals import EVENTS, events


def folder(spark, kind: str) -> str:
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def zoned(frame: DataFrame) -> DataFrame:
    """Instants as the store keeps them."""
    return frame.withColumns({c: F.col(c).cast("timestamp") for c in INSTANT_COLUMNS})


def stored(spark, sf_dir: str) -> str:
    """A store that took the vintages in two deliveries."""
    path, v = folder(spark, "store"), zoned(vintages(spark, sf_dir))
    for late in (False, True):
        store.append_vintages(v.where((F.col("available_at") >= "1998-01-01") == late), path)
    return path


@query("snk_01_append_and_read", f"""
    WITH {V} SELECT country, canonical_series_id, source, period, value, available_at, pit_grade, vintage_no FROM v
    WHERE country = 'CN' AND period_end BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""")
def append_and_read(spark, sf_dir):
    # the scan prunes the country's folder and pushes the dates
    rows = store.read_vintages(spark, stored(spark, sf_dir)).where(
        "country = 'CN' AND period_end BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'")
    return rows.select("country", "canonical_series_id", "source", "period", "value",
                       F.col("available_at").cast("timestamp_ntz").alias("available_at"), "pit_grade", "vintage_no")


def exported(name: str):
    """What a registered query gives, after it went through a file that is refreshed in place."""
    def run(spark, sf_dir):
        prefix = folder(spark, "export") + "/panel"
        for _ in range(2):
            paths = sinks.export(QUERIES[name](spark, sf_dir), prefix)
        return spark.read.parquet(paths["parquet"])
    return run


query("snk_02_panel_export", ORACLES["asof_13_wide_values"])(exported("asof_13_wide_values"))
query("snk_07_coverage_export", ORACLES["qa_08_coverage"])(exported("qa_08_coverage"))


@query("snk_03_snapshot_folders", ORACLES["pan_05_monthly_snapshots"])
def snapshot_folders(spark, sf_dir):
    path = folder(spark, "snapshots")
    sinks.export_snapshots(QUERIES["pan_05_monthly_snapshots"](spark, sf_dir), path)
    return spark.read.parquet(path)


@query("mnt_04_clustered_rewrite", f"WITH {V} SELECT country, count(*) AS rows, sum(value) AS total FROM v GROUP BY country")
def clustered_rewrite(spark, sf_dir):
    target = folder(spark, "clustered")
    store.rewrite_clustered(store.read_vintages(spark, stored(spark, sf_dir)), target)
    return store.read_vintages(spark, target).groupBy("country").agg(F.count(F.lit(1)).alias("rows"), F.sum("value").alias("total"))


@query("src_15_raw_evidence_files", "SELECT page_id, sha256(coalesce(html, '') || chr(10)) AS digest FROM pages")
def raw_evidence_files(spark, sf_dir):
    path = folder(spark, "raw")
    pages = table(spark, sf_dir, "pages", ["page_id", "html"], spread_by="page_id").select("page_id", F.coalesce("html", F.lit("")).alias("html"))
    sinks.write_raw_files(pages, "page_id", "html", path)
    found = files.read_evidence(spark, path, path.rsplit("/", 1)[1])
    return found.select(F.regexp_extract("path", r"page_id=(\d+)/", 1).cast("long").alias("page_id"),
                        F.sha2("content", 256).alias("digest"))


@query("qa_05_instant_schema", f"""
    WITH {V} SELECT 'store' AS kept, '' AS zoneless, count(*) AS rows FROM v
    UNION ALL SELECT 'derived', 'available_at,first_seen_at,release_at,retrieved_at', count(*) FROM v""")
def instant_schema(spark, sf_dir):
    def row(name: str, frame: DataFrame) -> DataFrame:
        return frame.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("kept"), F.lit(",".join(sorted(audit.zoneless_instants(frame)))).alias("zoneless"), "rows")
    return row("store", store.read_vintages(spark, stored(spark, sf_dir))).unionByName(row("derived", vintages(spark, sf_dir)))


_OFFICIAL = """first_official AS (SELECT * FROM v WHERE pit_grade = 'A' AND raw_sha256 <> 'N/A'
    QUALIFY row_number() OVER (PARTITION BY source, canonical_series_id, period ORDER BY ingest_seq) = 1)"""


@query("str_01_replayed_append", f"""
    WITH {V}, {_OFFICIAL}
    SELECT source, canonical_series_id, period, value, 'A' AS pit_grade, 0 AS vintage_no, available_at FROM first_official
    UNION ALL SELECT source, canonical_series_id, period, value + 1, 'D', 1, first_seen_at + to_days(900) FROM first_official""")
def replayed_append(spark, sf_dir):
    """A delivery and one that changes its values at the same address, and then both once more."""
    from ..functions.ordered import oldest, top_row
    official = zoned(vintages(spark, sf_dir)).where("pit_grade = 'A' AND raw_sha256 <> 'N/A'")
    first = top_row(official, ingest.KEY, oldest("ingest_seq")).select(
        *[c for c in OBSERVATION_COLUMNS if c not in ("vintage_no", "revision_type", "revision_delta")], "ingest_seq")
    later = F.expr("interval 900 days")
    changed = first.withColumns({"value": F.col("value") + 1, "first_seen_at": F.col("first_seen_at") + later,
                                 "retrieved_at": F.col("retrieved_at") + later})
    path = folder(spark, "replayed")
    for number, batch in enumerate((first, changed, first, changed)):
        incremental.append_batch(batch, path, mark_revisions=True, batch_id=number)
    return store.read_vintages(spark, path).select(
        "source", "canonical_series_id", "period", "value", "pit_grade", "vintage_no",
        F.col("available_at").cast("timestamp_ntz").alias("available_at"))


# deliveries that append accepts whole: evidence for every row, and no documented revision by nothing
_SOUND = ("raw_sha256 <> 'N/A' AND NOT coalesce(pit_grade = 'D' AND revision_type = 'revision' AND revision_delta = 0"
          " AND release_date_source = 'wind_revision_snapshot_x', false)")
_SOUND_SPLIT = SPLIT.replace("priority NOT IN ('1-URGENT', '2-HIGH'))", f"priority NOT IN ('1-URGENT', '2-HIGH') AND {_SOUND})")


@query("ing_06_observed_append", f"""
    WITH {_SOUND_SPLIT} SELECT revision_type AS kind, count(*) AS rows, count(*) AS stored FROM versioned GROUP BY revision_type
    UNION ALL SELECT 'unchanged', (SELECT count(*) FROM batch) - count(*), 0 FROM versioned""")
def observed_append(spark, sf_dir):
    """The figures that an append takes while it writes, beside the rows that the store then holds."""
    batch, history = (zoned(f) for f in split(spark, sf_dir))
    path = folder(spark, "observed")
    store.append_vintages(history, path)
    before = store.read_vintages(spark, path).groupBy("revision_type").agg(F.count(F.lit(1)).alias("before"))
    cut = folder(spark, "before")
    before.write.parquet(cut)
    result = ingest.append(batch.where(_SOUND), path)
    figures = {"initial": result.inserted - result.revisions - result.metadata_updates, "revision": result.revisions,
               "metadata_update": result.metadata_updates, "unchanged": result.unchanged}
    said = spark.range(1).select(F.explode(F.create_map(*[F.lit(x) for pair in figures.items() for x in pair])).alias("kind", "rows"))
    after = store.read_vintages(spark, path).groupBy("revision_type").agg(F.count(F.lit(1)).alias("after"))
    stored_ = after.join(spark.read.parquet(cut), "revision_type", "left").select(
        F.col("revision_type").alias("kind"), (F.col("after") - F.coalesce("before", F.lit(0))).alias("stored"))
    return said.join(stored_, "kind", "left").select("kind", F.col("rows").cast("long"), F.coalesce("stored", F.lit(0)).cast("long").alias("stored"))


@query("str_03_keyed_state", f"""
    WITH {SPLIT}, l AS (SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY source, canonical_series_id, period
                     ORDER BY available_at DESC, retrieved_at DESC, raw_sha256 DESC, value DESC) = 1)
    SELECT b.ingest_seq, l.value AS known_value, b.value FROM batch b JOIN l
      ON l.source = b.source AND l.canonical_series_id = b.canonical_series_id AND l.period = b.period
    WHERE l.source_url = b.source_url AND abs(l.value - b.value) > 1e-12""")
def keyed_state(spark, sf_dir):
    """Two deliveries through a stream that keeps the newest value of each key: what the second one changes."""
    inbox, changes, checkpoint = (folder(spark, x) for x in ("inbox", "changes", "checkpoint"))
    v = zoned(vintages(spark, sf_dir))
    for urgent in (True, False):
        v.where(F.col("priority").isin(*URGENT) == urgent).drop("priority").coalesce(1).write.mode("append").parquet(inbox)
        deliveries = incremental.delivery_stream(spark, inbox, v.drop("priority").schema, 1)
        incremental.stream_value_changes(deliveries, folder(spark, "none"), checkpoint, changes).awaitTermination()
    return spark.read.parquet(changes).select("ingest_seq", "known_value", "value")


@query("ing_02_stored_history", ORACLES["ing_02_idempotent_dedup"])
def stored_history(spark, sf_dir):
    """The new rows of a delivery next to a written store, of which only the part it touches is read."""
    batch, history = (zoned(f) for f in split(spark, sf_dir))
    path = folder(spark, "history")
    store.append_vintages(history, path)
    return ingest.new_rows(batch, store.read_touched(spark, path, batch)).select(
        "ingest_seq", "source", "canonical_series_id", "period", "value")


@query("src_05_pushed_event_scan", f"""
    WITH {EVENTS} SELECT canonical_series_id, period, valid_from, value FROM events
    WHERE country = 'US' AND period_end BETWEEN DATE '1998-01-31' AND DATE '1999-12-31' AND valid_from <= TIMESTAMP '1999-06-30 15:59:59.999999'
      AND (valid_to IS NULL OR TIMESTAMP '1999-06-30 15:59:59.999999' < valid_to)""")
def pushed_event_scan(spark, sf_dir):
    # the intervals of all countries as a store keeps them; the scan prunes the country and pushes both bounds
    path = folder(spark, "events")
    store.write_events(events(spark, sf_dir), path)
    return asof.at(store.read_events(spark, path), "1999-06-30", "US", "1998-01-31", "1999-12-31").select(
        "canonical_series_id", "period", "valid_from", "value")
