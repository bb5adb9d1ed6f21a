"""Selection rules, intervals and panels on small hand-made histories."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from vintara.operators import asof, audit, intervals, panels
from vintara.plans.policy import Policy
from vintara.queries import fixture as fx
from vintara.queries.asof import POLICY

from helpers import bag, frame, observation, utc

THIRD = "third_party_current_history_first_seen_only"


def sidecar(spark, rows):
    return spark.createDataFrame(
        [(s, src, p, date.fromisoformat(e), v, utc(at)) for s, src, p, e, v, at in rows],
        "canonical_series_id string, source string, period string, period_end date, value double, estimated_available_at timestamp")


@pytest.fixture(scope="module")
def story(spark):
    """One field over four months with every kind of evidence."""
    d = dict(grade="D", marker=None)
    rows = [
        observation("2020-01", 1.0, "B", "2020-02-12 00:00:00", seq=1, sha="b1"),
        observation("2020-01", 1.1, "A", "2020-02-20 00:00:00", seq=2, sha="a1"),
        observation("2020-01", 1.2, "D", "2020-05-01 00:00:00", source="WIND", marker="wind_revision_snapshot_1", seq=3, sha="w1"),
        observation("2020-02", 2.0, available="2020-05-10 00:00:00", source="WIND", seq=4, sha="w2", **d),
        observation("2020-03", 3.0, available="2020-04-20 00:00:00", source="WIND", seq=5, sha="w3", **d),
        observation("2020-03", 3.5, "A", "2020-06-01 00:00:00", seq=6, sha="a3"),
        observation("2020-04", 4.1, "D", "2020-05-05 00:00:00", source="SINA_MACRO", marker=THIRD, seq=7, sha="s4"),
        observation("2020-04", 4.2, "D", "2020-05-07 00:00:00", source="EASTMONEY_MACRO", marker=THIRD, seq=8, sha="e4"),
        observation("2020-01", 1.3, "D", "2020-07-01 00:00:00", marker="official_web_revision_first_seen", seq=9, sha="r1"),
    ]
    side = sidecar(spark, [("CN_X", "WIND", "2020-02", "2020-02-29", 2.0, "2020-03-13 16:00:00"),
                           ("CN_X", "WIND", "2020-03", "2020-03-31", 3.0, "2020-04-13 16:00:00")])
    return frame(spark, rows), side


def picks(story, at):
    rows, side = story
    chosen = asof.selected(rows, at, "CN", start="2020-01-01", sidecar=side)
    return {r["period"]: (r["value"], r["selection_origin"]) for r in chosen.collect()}


def test_priority_and_gap_rule(story):
    assert picks(story, "2020-02-12 08:00:00") == {"2020-01": (1.0, "PIT_B")}
    assert picks(story, "2020-02-12 07:59:59") == {}
    assert picks(story, "2020-03-14 00:00:00")["2020-02"] == (2.0, "WIND")
    # A/B exists for 2020-03 later on, so the ordinary estimate never counts, not even before
    assert "2020-03" not in picks(story, "2020-05-20 00:00:00")
    assert picks(story, "2020-06-02")["2020-03"] == (3.5, "PIT_A")
    assert picks(story, "2020-05-06")["2020-04"] == (4.1, "SINA_D")
    assert picks(story, "2020-05-08")["2020-04"] == (4.2, "EASTMONEY_D")


def test_dated_revisions_replace_older_bases(story):
    assert picks(story, "2020-04-30")["2020-01"] == (1.1, "PIT_A")
    assert picks(story, "2020-05-02")["2020-01"] == (1.2, "WIND_REVISION")
    assert picks(story, "2020-07-02")["2020-01"] == (1.3, "OBSERVED_WEB_REVISION")


def test_intervals_agree_with_direct_selection(story):
    rows, side = story
    events = intervals.effective_events(rows, "CN", sidecar=side, start="2020-01-01").cache()
    flat = intervals.invariants(events).first()
    assert (flat["gaps"], flat["same_instant"], flat["not_one_open"], flat["empty_intervals"]) == (0, 0, 0, 0)
    for at in ["2020-02-12 08:00:00", "2020-03-14", "2020-05-02", "2020-05-06", "2020-05-08", "2020-06-02", "2020-07-02"]:
        held = {r["period"]: (r["value"], r["selection_origin"]) for r in asof.at(events, at, "CN").collect()}
        assert held == picks(story, at), at


def test_wide_panels_agree_and_fill_nothing(spark, story):
    rows, side = story
    events = intervals.effective_events(rows, "CN", sidecar=side, start="2020-01-01")
    for frequency, count in (("M", 6), ("Q", 2)):
        a = panels.asof_wide(rows, "2020-06-02", "CN", start="2020-01-01", frequency=frequency, sidecar=side)
        b = panels.asof_wide_from_events(events, "2020-06-02", "CN", start="2020-01-01", frequency=frequency, check_overlap=True)
        assert a.fields == b.fields == ["CN_X"]
        assert a.values.count() == count
        for name in ("values", "periods", "provenance"):
            assert bag(getattr(a, name)) == bag(getattr(b, name))
    monthly = {r["month_end"]: r["CN_X"] for r in panels.asof_wide(
        rows, "2020-06-02", "CN", start="2020-01-01", sidecar=side).values.collect()}
    assert monthly[date(2020, 5, 31)] is None and monthly[date(2020, 3, 31)] == 3.5


def test_many_cutoffs_agree_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    v, side = fx.vintages(spark, sf).cache(), fx.sidecar(spark, sf).cache()
    events = intervals.effective_events(v, "CN", sidecar=side, policy=POLICY, start="1995-01-01").cache()
    for cutoff in ("1996-03-31", "1997-11-15 03:00:00+00:00", "1999-06-30", "2001-12-31"):
        direct = asof.selected(v, cutoff, "CN", start="1995-01-01", sidecar=side, policy=POLICY)
        held = asof.at(events, cutoff, "CN")
        assert bag(direct, *asof.KEY, "value", "selection_origin", "available_at") == bag(
            held, *asof.KEY, "value", "selection_origin", "valid_from")


def test_missing_companions_are_errors(spark, story):
    rows, _ = story
    with pytest.raises(ValueError, match="sidecar"):
        asof.selected(rows, "2020-06-02", "CN")
    with pytest.raises(ValueError, match="rules"):
        asof.selected(rows, "2020-06-02", "GLB")
    with pytest.raises(ValueError, match="scope"):
        asof.selected(rows, "2020-06-02", "XX")
    with pytest.raises(ValueError, match="start"):
        panels.asof_wide(rows, "2020-06-02", "US", start="2021-01-01")


def test_safe_series_uses_its_own_sidecar_rows(spark):
    rows = frame(spark, [observation("2020-01", 9.0, "D", "2020-06-01 00:00:00", series="FX", source="SAFE", marker=None),
                         observation("2020-01", 9.0, "D", "2020-06-01 00:00:00", series="FX", source="WIND", marker=None, seq=1)])
    side = sidecar(spark, [("FX", "SAFE", "2020-01", "2020-01-31", 9.0, "2020-02-08 00:00:00"),
                           ("FX", "WIND", "2020-01", "2020-01-31", 8.0, "2020-02-07 00:00:00")])
    chosen = asof.selected(rows, "2020-03-01", "CN", sidecar=side, policy=Policy(safe_series="FX"))
    assert bag(chosen, "value", "selection_origin") == {(9.0, "SAFE_ESTIMATED_D"): 1}


def test_rule_estimated_availability(spark):
    imf = dict(country="GLB", series="GLB_P", source="IMF", grade="D", marker="imf_current_history_snapshot_1")
    rows = frame(spark, [observation("2020-01", 5.0, available="2020-09-01 00:00:00", vintage_no=0, **imf),
                         observation("2020-01", 5.5, available="2020-10-01 00:00:00", vintage_no=1, seq=1, **imf)])
    rules = spark.createDataFrame([("GLB_P", 40, True)], "canonical_series_id string, lag_days int, eligible boolean")
    pick = lambda at: [r["value"] for r in asof.selected(rows, at, "GLB", rules=rules).collect()]
    # 31 January + 41 days = 12 March, local midnight
    assert pick("2020-03-11 23:59:59") == [] and pick("2020-03-12 00:00:00") == [5.5]


def test_work_view_hides_estimates_once_evidence_is_visible(spark):
    rows = frame(spark, [observation("2020-03", 3.0, "D", "2020-09-01 00:00:00", source="WIND", marker=None),
                         observation("2020-03", 3.5, "A", "2020-06-01 00:00:00", seq=1)])
    side = sidecar(spark, [("CN_X", "WIND", "2020-03", "2020-03-31", 3.0, "2020-04-13 16:00:00")])
    def pick(at):
        return [(r["value"], r["work_origin"]) for r in asof.work_snapshot(rows, side, at).collect()]
    assert pick("2020-04-13") == []
    # unlike the fixed-T view, later evidence does not hide the estimate beforehand
    assert pick("2020-05-01") == [(3.0, "work_wind")]
    assert pick("2020-07-01") == [(3.5, "work_A")]
    cells = panels.work_panel(rows, side, "2020-03-31", "2020-07-31")
    assert bag(cells, "as_of", "value") == {(date(2020, 4, 30), 3.0): 1, (date(2020, 5, 31), 3.0): 1,
                                            (date(2020, 6, 30), 3.5): 1, (date(2020, 7, 31), 3.5): 1}


def test_panel_equals_a_snapshot_per_month(spark):
    sf = "/root/testdata/sf0.001"
    v, side = fx.vintages(spark, sf).cache(), fx.sidecar(spark, sf).cache()
    strict = panels.monthly_panel(v, "1996-01-31", "1996-12-31", "strict", "CN").cache()
    work = panels.work_panel(v, side, "1996-01-31", "1996-12-31").cache()
    every = panels.monthly_snapshots(v, "1996-01-31", "1996-12-31", "loose").cache()
    for day in ("1996-01-31", "1996-06-30", "1996-12-31"):
        at = f"{day} 23:59:59+08:00"
        on = F.col("as_of") == F.lit(day).cast("date")
        assert bag(strict.where(on), "canonical_series_id", "period", "value") == bag(
            asof.latest_per_series(asof.snapshot(v, at, country="CN")), "canonical_series_id", "period", "value")
        assert bag(work.where(on), "canonical_series_id", "period", "value", "work_origin") == bag(
            asof.work_snapshot(v, side, at), "canonical_series_id", "period", "value", "work_origin")
        assert bag(every.where(on), *asof.KEY, "value") == bag(asof.snapshot(v, at, "loose"), *asof.KEY, "value")


def test_month_range_without_month_end_is_an_error(spark):
    with pytest.raises(ValueError, match="no natural month end"):
        panels.month_ends(spark, "2020-01-05", "2020-01-20")
    assert [r[0] for r in panels.month_ends(spark, "2020-01-05", "2020-02-29").collect()] == [date(2020, 1, 31), date(2020, 2, 29)]


def test_long_empty_prefix_keeps_types(spark):
    rows = frame(spark, [observation("2020-01", 1.0)])
    wide = panels.panel_wide(panels.monthly_panel(rows, "2000-01-31", "2020-03-31"), "2000-01-31", "2020-03-31", ["CN_X"], F.col("value"))
    assert wide.schema["CN_X"].dataType.typeName() == "double"
    assert wide.where("CN_X IS NOT NULL").count() == 2 and wide.count() == 243


def test_cell_collisions_are_found(spark):
    rows = frame(spark, [observation("2020-03", 1.0), observation("2020-Q1", 2.0, seq=1, sha="q")]).where("country = 'CN'")
    rows = rows.withColumn("country", F.lit("US"))
    assert panels.collisions(asof.selected(rows, "2021-01-01", "US")).count() == 1
    with pytest.raises(ValueError, match="two frequencies"):
        panels.asof_wide(rows, "2021-01-01", "US", start="2020-01-01", check_cells=True)


def test_overlap_guard(spark, story):
    rows, side = story
    events = intervals.effective_events(rows, "CN", sidecar=side, start="2020-01-01")
    twice = events.unionByName(events)
    with pytest.raises(ValueError, match="overlap"):
        panels.asof_wide_from_events(twice, "2020-06-02", "CN", start="2020-01-01", check_overlap=True)


def test_checks_and_schema(spark, story):
    rows, _ = story
    assert audit.zoneless_instants(rows) == []
    assert audit.zoneless_instants(rows.withColumn("release_at", F.col("release_at").cast("timestamp_ntz"))) == ["release_at"]
    checks = audit.check_rows([audit.Check("duplicates", audit.duplicate_vintages(rows), "value = 0"),
                               audit.Check("rows", audit.row_defects(rows).select("rows"), "value > 100", "WARN")])
    # three vintages of one source and period share number 0
    assert bag(checks, "name", "value", "status") == {("duplicates", 2.0, "FAIL"): 1, ("rows", 9.0, "WARN"): 1}
    assert audit.overall(checks).first().asDict() == dict(checks=2, failed=1, warned=1, overall="FAIL")
