"""Contracts, versioning, replay and first-seen revisions on small hand-made deliveries."""

import pytest
from pyspark.sql import functions as F

from vintara.functions.instants import ensure_utc, normalize_as_of
from vintara.operators import asof, contracts, ingest
from vintara.sources.store import read_vintages

from helpers import bag, frame, observation, utc


def reasons(spark, **changes):
    row = observation() | changes
    return contracts.checked(frame(spark, [row])).first()["reasons"]


def test_clean_row_passes(spark):
    assert reasons(spark) == []


@pytest.mark.parametrize("changes, label", [
    ({"series_name": None}, "missing_series_name"),
    ({"pit_grade": "E"}, "invalid_pit_grade"),
    ({"release_at": None}, "release_at_required"),
    ({"raw_sha256": " N/A "}, "raw_sha256_required"),
    ({"value": float("nan")}, "value_not_finite"),
    ({"value": float("inf")}, "value_not_finite"),
    ({"available_at": utc("2020-02-10 00:59:59")}, "available_before_release"),
])
def test_broken_rules(spark, changes, label):
    assert label in reasons(spark, **changes)


def test_grade_d_cannot_precede_first_seen_unless_dated(spark):
    late = dict(pit_grade="D", release_at=None, first_seen_at=utc("2021-01-01"), release_date_source=None)
    assert reasons(spark, **late) == ["available_before_first_seen"]
    assert reasons(spark, **late | {"release_date_source": "wind_revision_snapshot_gdp_1"}) == []
    # "_" in the marker is no wildcard
    assert reasons(spark, **late | {"release_date_source": "windXrevisionXsnapshotXgdp"}) == ["available_before_first_seen"]


def test_one_bad_row_rejects_the_batch(spark):
    rows = frame(spark, [observation(), observation(value=float("nan"), seq=1)])
    with pytest.raises(contracts.ContractError, match="value_not_finite"):
        contracts.accepted_or_raise(rows)
    good, bad = contracts.quarantine(rows)
    assert (good.count(), bad.count()) == (1, 1)


def test_instants():
    assert ensure_utc("2020-01-01 08:00:00") == utc("2020-01-01 00:00:00")
    assert ensure_utc("2020-01-01T00:00:00Z") == utc("2020-01-01 00:00:00")
    assert normalize_as_of("2020-01-01") == utc("2020-01-01 15:59:59.999999")


def test_append_is_idempotent_and_numbers_vintages(spark, tmp_path):
    path = str(tmp_path / "store")
    first = frame(spark, [observation(value=1.0), observation("2020-02", 2.0, available="2020-03-10 01:00:00", seq=1)])
    assert ingest.append(first, path) == ingest.AppendResult(2, 0, 0, 0)
    assert ingest.append(first, path) == ingest.AppendResult(0, 0, 0, 2)
    changed = frame(spark, [observation(value=1.5, available="2020-04-01 00:00:00", url="https://a/2"),
                            observation("2020-02", 2.0, available="2020-05-01 00:00:00", seq=1)])
    assert ingest.append(changed, path) == ingest.AppendResult(2, 1, 1, 0)
    stored = read_vintages(spark, path)
    assert bag(stored, "period", "value", "vintage_no", "revision_type", "revision_delta") == {
        ("2020-01", 1.0, 0, "initial", None): 1, ("2020-01", 1.5, 1, "revision", 0.5): 1,
        ("2020-02", 2.0, 0, "initial", None): 1, ("2020-02", 2.0, 1, "metadata_update", 0.0): 1}
    before = asof.snapshot(stored, "2020-03-31 23:59:59+00:00", inactive=None)
    assert bag(before, "period", "value") == {("2020-01", 1.0): 1, ("2020-02", 2.0): 1}
    assert stored.schema["country"].dataType.typeName() == "string"


def test_order_in_batch_is_by_availability(spark):
    batch = frame(spark, [observation(value=3.0, available="2020-03-01 00:00:00", seq=0),
                          observation(value=2.0, available="2020-02-15 00:00:00", seq=1),
                          observation(value=1.0, available="2020-02-10 00:00:00", seq=2)])
    rows = ingest.versioned(batch, frame(spark, []))
    assert bag(rows, "value", "vintage_no", "revision_delta") == {(1.0, 0, None): 1, (2.0, 1, 1.0): 1, (3.0, 2, 1.0): 1}


def test_ordinary_d_ignores_times_but_dated_revisions_do_not(spark):
    ordinary = [observation(grade="D", marker=None, available=f"2020-0{m}-01 00:00:00", seq=m) for m in (3, 4, 5)]
    assert ingest.versioned(frame(spark, ordinary), frame(spark, [])).count() == 1
    dated = [observation(grade="D", source="WIND", marker="wind_revision_snapshot_x", available=f"2020-0{m}-01 00:00:00",
                         seq=m, revision_type="revision", delta=0.4) for m in (3, 4)]
    rows = ingest.versioned(frame(spark, dated), frame(spark, []))
    assert bag(rows, "vintage_no", "revision_type", "revision_delta") == {(0, "initial", None): 1, (1, "revision", 0.4): 1}


def test_documented_revision_needs_a_delta(spark, tmp_path):
    path = str(tmp_path / "store")
    ingest.append(frame(spark, [observation(grade="D", source="WIND", marker=None)]), path)
    zero = observation(2.0 and "2020-01", 2.0, "D", "2020-06-01 00:00:00", source="WIND", marker="wind_revision_snapshot_x",
                       revision_type="revision", delta=0.0)
    with pytest.raises(contracts.ContractError, match="non_zero_delta"):
        ingest.append(frame(spark, [zero]), path)
    assert read_vintages(spark, path).count() == 1


def test_same_url_change_becomes_first_seen_revision(spark):
    history = frame(spark, [observation(value=1.0)])
    batch = frame(spark, [observation(value=2.0, first_seen="2020-07-01 00:00:00"),
                          observation(value=2.0, first_seen="2020-07-01 00:00:00", url="https://a/9", seq=1)])
    rows = {r["ingest_seq"]: r for r in ingest.mark_first_seen_revisions(batch, history).collect()}
    assert (rows[0]["pit_grade"], rows[0]["release_at"], rows[0]["available_at"]) == ("D", None, rows[0]["first_seen_at"])
    assert rows[0]["release_date_source"] == "official_web_revision_first_seen"
    assert rows[1]["pit_grade"] == "A"


def test_a_value_that_an_older_vintage_had_is_a_revision(spark):
    history = frame(spark, [observation(value=1.0), observation(value=2.0, available="2020-03-01 00:00:00", vintage_no=1, seq=1)])
    batch = frame(spark, [observation(value=1.0, seq=2), observation(value=2.0, seq=3)])
    rows = {r["ingest_seq"]: r["pit_grade"] for r in ingest.mark_first_seen_revisions(batch, history).collect()}
    assert rows == {2: "D", 3: "A"}


def test_append_checks_counts_and_writes_in_one_job(spark, tmp_path):
    path = str(tmp_path / "store")
    first = [observation(f"2020-{m:02d}", float(m), seq=m) for m in range(1, 13)]
    assert ingest.append(frame(spark, first), path) == ingest.AppendResult(12, 0, 0, 0)
    files = set((tmp_path / "store").rglob("*.parquet"))
    # one broken row among good ones: nothing is written, and the rules are named
    bad = [observation("2021-01", 1.0, seq=20), observation("2021-02", float("nan"), seq=21), observation("2021-03", 1.0, sha="N/A", seq=22)]
    with pytest.raises(contracts.ContractError, match="raw_sha256_required x1; value_not_finite x1"):
        ingest.append(frame(spark, bad), path)
    with pytest.raises(contracts.ContractError, match="too_few_rows x1"):
        ingest.append(frame(spark, bad[:1]), path, minimum=2)
    assert set((tmp_path / "store").rglob("*.parquet")) == files
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-append", "")
    changed = [observation("2020-01", 9.0, available="2021-01-01 00:00:00", seq=30), first[1], observation("2022-01", 1.0, seq=31)]
    assert ingest.append(frame(spark, changed), path, minimum=3) == ingest.AppendResult(2, 1, 0, 1)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("one-append")]
    assert stages and read_vintages(spark, path).count() == 14
    assert ingest.append(frame(spark, []), path) == ingest.AppendResult(0, 0, 0, 0)


def test_unchanged_snapshot_inherits_times(spark):
    history = frame(spark, [observation(value=1.0, grade="D", marker="m1")])
    batch = frame(spark, [observation(value=1.0, grade="D", marker="m2", available="2021-01-01 00:00:00")])
    row = ingest.stabilize_snapshots(batch, history).first()
    assert row["release_date_source"] == "m1"
    assert ingest.versioned(ingest.stabilize_snapshots(batch, history), history).count() == 0


def test_anomaly_guard(spark):
    history = frame(spark, [observation(value=5.0, url="https://s/zxfb/1")])
    batch = frame(spark, [observation(value=6.0, url="https://s/zxfbhjd/1", seq=0), observation(value=20.0, url="https://s/x", seq=1),
                          observation(value=6.0, url="https://s/x", seq=2), observation(value=50.0, url="https://s/zxfb/1", seq=3)])
    assert bag(ingest.revision_anomalies(batch, history), "ingest_seq", "anomaly") == {
        (0, "secondary_conflicts_with_primary"): 1, (1, "large_change"): 1, (2, None): 1, (3, None): 1}


def test_statistics_of_nothing(spark):
    empty = frame(spark, [])
    assert ingest.statistics(empty, ingest.versioned(empty, empty)).first().asDict() == dict(
        inserted=0, revisions=0, metadata_updates=0, unchanged=0)


def test_release_boundary_second(spark):
    rows = frame(spark, [observation(grade="B", available="2020-02-10 16:00:00")])
    at = lambda t: asof.snapshot(rows, t).count()
    assert at("2020-02-10 23:59:59") == 0      # local wall time
    assert at("2020-02-11 00:00:00") == 1
    assert at("2020-02-11") == 1 and at("2020-02-10") == 0


def test_country_filter_and_modes(spark):
    rows = frame(spark, [observation(), observation(grade="C", series="CN_Y"), observation(grade="D", series="CN_Z", marker=None),
                         observation(country="US", series="US_X")])
    count = lambda mode, country=None: asof.snapshot(rows, "2021-01-01", mode, country).count()
    assert [count("strict"), count("loose"), count("observed"), count("observed", "us")] == [2, 3, 4, 1]
    with pytest.raises(ValueError):
        asof.snapshot(rows, "2021-01-01", "other")
    retired = rows.select("canonical_series_id").where(F.col("canonical_series_id") == "US_X")
    assert asof.snapshot(rows, "2021-01-01", inactive=retired).count() == 1


def test_selfcheck(spark):
    from vintara.operators.selfcheck import selfcheck
    assert bag(selfcheck(spark)) == {(n, True): 1 for n in ("leakage", "same_day_boundary", "revision", "idempotence")}
