"""The chunked plans of hot keys give what the plain plans give."""

import pytest
from pyspark.sql import functions as F

from vintara.functions.ordered import HotKeys, hot_keys, with_neighbours
from vintara.operators import asof, ingest, intervals, maintenance, transforms
from vintara.plans.policy import Policy
from vintara.queries import fixture as fx
from vintara.queries.ingest import split
from vintara.sources import store

from helpers import bag


@pytest.fixture(scope="module")
def vintages(spark):
    # few series and periods make many rows per key
    v = fx.vintages(spark, "/root/testdata/sf0.01")
    return v.withColumns({"canonical_series_id": F.concat("country", F.lit("_S"), F.lit(1)),
                          "period": F.lit("2000-01"), "period_end": F.lit("2000-01-31").cast("date")}).cache()


PLAIN = 10**9


def listed(frame, keys, threshold):
    """No list at all, or the keys over the threshold."""
    return None if threshold == PLAIN else hot_keys(frame, keys, threshold)


def test_neighbours(spark, vintages):
    def run(threshold):
        return bag(with_neighbours(
            vintages, ["country", "canonical_series_id"], [("available_at", "asc"), ("ingest_seq", "asc")],
            previous={"before": "value"}, following={"after": "ingest_seq"}, ordinal="no",
            hot=listed(vintages, ["country", "canonical_series_id"], threshold)), "ingest_seq", "before", "after", "no")
    plain = run(10**9)
    assert run(100) == plain
    assert run(3000) == plain  # some keys hot, some not


def test_neighbours_descending_numbers(spark, vintages):
    def run(threshold):
        return bag(with_neighbours(
            vintages, ["country"], [("ingest_seq", "desc")], previous={"before": "ingest_seq"}, ordinal="no",
            hot=listed(vintages, ["country"], threshold), chunk=-F.floor(F.col("ingest_seq") / 500)), "ingest_seq", "before", "no")
    assert run(10) == run(10**9)


def test_hot_list_counts_rows(vintages):
    counts = {r["country"]: r["count"] for r in vintages.groupBy("country").count().collect()}
    assert {r[0] for r in hot_keys(vintages, ["country"], 3000).collect()} == {c for c, n in counts.items() if n > 3000}
    assert hot_keys(vintages, ["country"], 10**6).collect() == []
    assert HotKeys(["country"]).group == ["country"]


def test_hot_list_beside_the_store(spark, vintages, tmp_path):
    store.write_hot_keys(vintages, str(tmp_path / "hot"), ["country"], 3000)
    assert bag(spark.read.parquet(str(tmp_path / "hot"))) == bag(hot_keys(vintages, ["country"], 3000))


def test_no_job_runs_while_a_query_is_built(spark, sf_dir):
    from vintara import queries as registry
    tracker = spark.sparkContext.statusTracker()
    for name, function in registry.QUERIES.items():
        if function.__module__.endswith(".storage"):  # these write first
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        function(spark, sf_dir)
        assert list(tracker.getJobIdsForGroup(f"build-{name}")) == [], name
    spark.sparkContext.setJobGroup("tests", "")


def test_effective_events(spark, vintages):
    side = fx.sidecar(spark, "/root/testdata/sf0.01").withColumns({
        "canonical_series_id": F.lit("CN_S1"), "period": F.lit("2000-01"), "period_end": F.lit("2000-01-31").cast("date")}
    ).dropDuplicates(["canonical_series_id", "source", "period"])
    # leave a key without A/B evidence so that lower origins survive too
    rows = vintages.where("NOT (country = 'DEU' AND pit_grade = 'A')")
    def run(threshold):
        return bag(intervals.effective_events(
            rows, "ALL", sidecar=side, rules=fx.rules(spark), policy=Policy(safe_series="none"), start=None,
            hot=listed(rows, asof.KEY, threshold)), "country", "valid_from", "valid_to", "event_no", "value", "selection_origin")
    plain = run(10**9)
    assert sum(plain.values()) > 1000
    assert run(50) == plain


def test_versioned(spark, vintages):
    batch = vintages.where("priority NOT IN ('1-URGENT', '2-HIGH')")
    history = vintages.where("priority IN ('1-URGENT', '2-HIGH')")
    def run(threshold):
        return bag(ingest.versioned(batch, history, hot=listed(batch, ingest.KEY, threshold)),
                   "ingest_seq", "vintage_no", "revision_type", "revision_delta", "reject_reason")
    assert run(20) == run(10**9)


def test_compaction_and_compression(spark, vintages):
    def compacted(threshold):
        return bag(maintenance.compacted(vintages, listed(vintages, maintenance.KEY, threshold)), "ingest_seq", "vintage_no", "revision_type", "revision_delta")
    assert compacted(20) == compacted(10**9)
    def compressed(threshold):
        return bag(transforms.compressed(vintages, ["canonical_series_id", "period"], [("available_at", "asc"), ("ingest_seq", "asc")],
                                         hot=listed(vintages, ["canonical_series_id", "period"], threshold)), "ingest_seq")
    assert compressed(20) == compressed(10**9)


def test_point_lookup_and_previous(spark, vintages):
    key = ["source", "canonical_series_id", "period"]
    probes = vintages.select(*key, "ingest_seq", F.expr("available_at + interval 3 days").alias("probe_at"))
    def lookup(threshold):
        return bag(asof.point_lookup(probes, vintages, key, hot=listed(vintages, key, threshold)), "ingest_seq", "visible_value", "visible_vintage_no")
    assert lookup(20) == lookup(10**9)
    many = vintages.withColumn("vintage_no", (F.col("ingest_seq") % 4000).cast("int"))
    def before(threshold):
        return bag(asof.previous_vintage(many, listed(many, key, threshold)), "ingest_seq", "previous_value", "previous_vintage_no")
    assert before(20) == before(10**9)


def test_split_covers_everything(spark):
    batch, history = split(spark, "/root/testdata/sf0.001")
    assert batch.count() + history.count() == fx.vintages(spark, "/root/testdata/sf0.001").count()
