"""Files, sinks, evidence and incremental ingest."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from vintara.operators import audit, estimate, ingest, intervals, maintenance, panels, text, transforms
from vintara.queries import fixture as fx
from vintara.schema import CRAWL_LOG
from vintara.sources import files, sinks, store
from vintara.streaming import incremental

from helpers import bag, frame, observation, utc

SF = "/root/testdata/sf0.001"


def test_csv_companions(spark, tmp_path):
    side = tmp_path / "side.csv"
    side.write_text("canonical_series_id,source,period,period_end,value,estimated_available_at\n"
                    "X,WIND,2020-01,2020-01-31,1.5,2020-02-12T00:00:00+08:00\nX,SAFE,2020-01,2020-01-31,1.5,2020-02-12T00:00:00+08:00\n")
    rows = files.read_sidecar(spark, str(side), F.col("source") == "WIND").collect()
    assert len(rows) == 1 and str(rows[0]["estimated_available_at"]) == "2020-02-11 16:00:00"
    rules = tmp_path / "rules.csv"
    rules.write_text("canonical_series_id,frequency,lag_days,available_same_day,confidence,eligible\nX,M,9,TRUE,high,false\n")
    row = files.read_rules(spark, str(rules)).first()
    assert (row["lag_days"], row["available_same_day"], row["eligible"]) == (9, True, False)
    listed = tmp_path / "registry.csv"
    listed.write_text("canonical_series_id,country,source,frequency,unit,active\nX,CN,S,M,pct,\nY,CN,S,M,pct,false\n")
    assert bag(files.inactive_series(files.read_registry(spark, str(listed)))) == {("Y",): 1}
    over = tmp_path / "over.csv"
    line = "X,WIND,2020-01,1.5,2020-02-12T09:30:00+08:00\n"
    over.write_text("canonical_series_id,source,period,value,available_at\n" + line)
    assert files.read_overrides(spark, str(over)).count() == 1
    over.write_text("canonical_series_id,source,period,value,available_at\n" + line + line)
    with pytest.raises(ValueError, match="duplicate availability override"):
        files.read_overrides(spark, str(over))


@pytest.mark.parametrize("separator", [",", ";", "\t"])
def test_edition_files(spark, tmp_path, separator):
    path = tmp_path / "e.csv"
    header = separator.join([*files.EDITION_COLUMNS, "EXTRA"])
    lines = [["DEU", "M", "X1", "IX", "202001", "2019-11", "100", "z"], ["DEU", "M", "X1", "IX", "202002", "2019-11", "100", "z"],
             ["DEU", "M", "X1", "IX", "202003", "2019-11", "101", "z"], ["DEU", "M", "X1", "IX", "202003", "2019-12", "0", "z"],
             ["DEU", "M", "X9", "IX", "202003", "2019-12", "7", "z"]]
    path.write_text("\n".join([header, *[separator.join(x) for x in lines]]) + "\n")
    mapping = spark.createDataFrame([("DEU", "M", "X1", "IX", "DE_X", "index", "DE")],
                                    "ref_area string, freq string, measure string, unit_measure string, canonical_series_id string, unit string, country string")
    out = transforms.editions_to_observations(files.read_editions(spark, str(path)), mapping)
    # the repeated level is compressed, the zero level is a missing marker, the unmapped row is ignored
    assert bag(out, "country", "period", "value") == {("DE", "2019-11", 100.0): 1, ("DE", "2019-11", 101.0): 1}
    assert str(out.orderBy("available_at").first()["available_at"]) == "2020-01-31 23:00:00"


def test_a_folder_of_edition_files_in_several_layouts(spark, tmp_path):
    folder = tmp_path / "editions"
    folder.mkdir()
    line = ["DEU", "M", "X1", "IX", "202001", "2019-11", "100"]
    for number, (separator, names) in enumerate([(",", files.EDITION_COLUMNS), (";", files.EDITION_COLUMNS[::-1]), ("\t", [*files.EDITION_COLUMNS, "EXTRA"])]):
        values = dict(zip(files.EDITION_COLUMNS, line, strict=True)) | {"EXTRA": "a", "OBS_VALUE": f"10{number}"}
        quoted = [f'"{values[n]}"' if n == "REF_AREA" else values[n] for n in names]
        (folder / f"{number}.csv").write_text("\n".join([separator.join(names), *[separator.join(quoted)] * (number + 1)]) + "\n")
    rows = files.read_editions(spark, str(folder))
    assert bag(rows, "REF_AREA", "TIME_PERIOD", "EDITION", "OBS_VALUE") == {
        ("DEU", line[files.EDITION_COLUMNS.index("TIME_PERIOD")], line[files.EDITION_COLUMNS.index("EDITION")], f"10{n}"): n + 1 for n in range(3)}
    (folder / "bad.csv").write_text("REF_AREA,FREQ\nDEU,M\n")
    with pytest.raises(ValueError, match="bad.csv is missing columns"):
        files.read_editions(spark, str(folder))


def test_edition_file_without_a_column(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("REF_AREA,FREQ\nDEU,M\n")
    with pytest.raises(ValueError, match="missing columns"):
        files.read_editions(spark, str(path))


def test_candidate_lists(spark, tmp_path):
    lines = tmp_path / "c.txt"
    lines.write_text("# comment\nhttp://a\nhttp://b\nhttp://a\n")
    assert files.read_candidates(spark, str(lines), "2020-01").count() == 2
    path = str(tmp_path / "c.parquet")
    spark.createDataFrame([("u1", "2019-12"), ("u2", "2020-02"), ("u3", None)], "url string, period string").write.parquet(path)
    assert bag(files.read_candidates(spark, path, "2020-01"), "url") == {("u2",): 1, ("u3",): 1}


def test_raw_evidence(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "1").write_bytes(b"page one")
    (folder / "2").write_bytes(b"page two")
    good = hashlib.sha256(b"page one").hexdigest().upper()
    rows = [observation(sha=good), observation("2020-02", sha="0" * 64, seq=1) | {"raw_file": "raw/2"},
            observation("2020-03", sha=good, seq=2) | {"raw_file": "raw/3"}, observation("2020-04", grade="D", sha="N/A", seq=3)]
    found = audit.raw_evidence(frame(spark, rows), files.read_evidence(spark, str(folder), str(tmp_path)))
    assert found.first().asDict() == dict(rows=4, verified=1, strict_verified=1)


def test_store_prunes_partitions_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "store")
    store.append_vintages(frame(spark, [observation(), observation(country="US", series="US_X", seq=1)]), path)
    scan = store.read_vintages(spark, path).where("country = 'US' AND pit_grade = 'A' AND period >= '2020-01'").select("value")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "EqualTo(pit_grade,A)" in plan
    assert "ReadSchema: struct<period:string,value:double,pit_grade:string>" in plan
    assert scan.count() == 1
    target = str(tmp_path / "merged")
    store.rewrite_clustered(store.read_vintages(spark, path), target, 2)
    assert bag(store.read_vintages(spark, target)) == bag(store.read_vintages(spark, path))
    with pytest.raises(Exception, match="(?i)exists"):
        store.rewrite_clustered(store.read_vintages(spark, path), target, 2)


def test_exports(spark, tmp_path):
    v, side = fx.vintages(spark, SF), fx.sidecar(spark, SF)
    events = intervals.effective_events(v, "CN", sidecar=side, start="1995-01-01").cache()
    for _ in range(2):  # refreshed in place
        sinks.export(events, str(tmp_path / "long"))
    assert spark.read.parquet(str(tmp_path / "long.parquet")).count() == events.count()
    assert spark.read.csv(str(tmp_path / "long.csv"), header=True).count() == events.count()
    sinks.write_receipt(sinks.receipt(events, scope="CN"), str(tmp_path / "receipt"))
    part = next((tmp_path / "receipt").glob("*.json"))
    assert json.loads(part.read_text())["rows"] == events.count()
    wide = panels.asof_wide_from_events(events, "1999-06-30", "CN", start="1995-01-01", frequency="Q")
    paths = sinks.export_wide(wide, str(tmp_path / "wide"))
    assert spark.read.parquet(paths["values_parquet"]).count() == 18
    shots = panels.monthly_snapshots(v, "1996-01-31", "1996-03-31")
    sinks.export_snapshots(shots, str(tmp_path / "snapshots"))
    assert sorted(p.name for p in (tmp_path / "snapshots").glob("as_of=*")) == [
        "as_of=1996-01-31", "as_of=1996-02-29", "as_of=1996-03-31"]
    rows = audit.coverage(v, fx.registry(spark), "CN")
    sinks.export(rows, str(tmp_path / "cn_coverage"))
    assert spark.read.csv(str(tmp_path / "cn_coverage.csv"), header=True).count() == rows.count()


def test_crawl_log_ignores_known_ids(spark, tmp_path):
    path = str(tmp_path / "crawl")
    def events(*ids):
        return spark.createDataFrame([(i, "S", "u", utc("2020-01-01"), utc("2020-01-01"), 200, True, False, None, None, None,
                                       None, None, None, None, 0.1) for i in ids], CRAWL_LOG)
    store.append_crawl_events(path, events("a", "b"))
    store.append_crawl_events(path, events("b", "c", "c"))
    assert bag(spark.read.parquet(path), "crawl_id") == {("a",): 1, ("b",): 1, ("c",): 1}


def test_compaction_to_a_new_place(spark, tmp_path):
    rows = frame(spark, [observation(value=v, available=f"2020-0{i}-01 00:00:00", vintage_no=i, seq=i, grade="B")
                         for i, v in ((2, 1.0), (3, 1.0), (4, 1.5), (5, 1.5))])
    target = str(tmp_path / "compact")
    maintenance.write_compacted(rows, target)
    assert bag(store.read_vintages(spark, target), "value", "vintage_no", "revision_type", "revision_delta") == {
        (1.0, 0, "initial", None): 1, (1.5, 1, "revision", 0.5): 1}


def deliver(spark, path, rows):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(path)


def test_stream_append_replays_safely(spark, tmp_path):
    inbox, path, bad = str(tmp_path / "inbox"), str(tmp_path / "store"), str(tmp_path / "bad")
    deliver(spark, inbox, [observation(value=1.0), observation("2020-02", float("nan"), seq=1)])
    schema = frame(spark, []).schema
    def run(checkpoint):
        query = incremental.stream_append(incremental.delivery_stream(spark, inbox, schema), path,
                                          str(tmp_path / checkpoint), bad, mark_revisions=True)
        query.awaitTermination()
    run("c1")
    assert store.read_vintages(spark, path).count() == 1
    assert spark.read.parquet(bad).first()["reasons"] == ["value_not_finite"]
    # a lost checkpoint replays everything: nothing is written twice
    run("c2")
    assert store.read_vintages(spark, path).count() == 1
    # a late change at the same address is a new vintage, visible from when it was seen
    deliver(spark, inbox, [observation(value=1.4, first_seen="2021-01-01 00:00:00", seq=2)])
    run("c1")
    expected = {(1.0, "A", 0): 1, (1.4, "D", 1): 1}
    assert bag(store.read_vintages(spark, path), "value", "pit_grade", "vintage_no") == expected
    # both deliveries once more, after the revision: no false history, and no reject twice
    run("c4")
    assert bag(store.read_vintages(spark, path), "value", "pit_grade", "vintage_no") == expected
    assert spark.read.parquet(bad).count() == 1


def test_stream_dedup_and_daily_status(spark, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    schema = frame(spark, []).schema
    deliver(spark, inbox, [observation(seq=1), observation(seq=2), observation(value=2.0, seq=3)])
    rows = incremental.deduplicated(incremental.delivery_stream(spark, inbox, schema), "1 day")
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 2
    crawl = str(tmp_path / "crawl")
    from vintara.queries.audits import crawl_log
    log = crawl_log(spark, SF).withColumn("completed_at", F.col("completed_at").cast("timestamp"))
    log.write.parquet(crawl)
    counted = incremental.daily_status(spark.readStream.schema(log.schema).parquet(crawl), "1 day")
    counted.writeStream.format("parquet").option("path", str(tmp_path / "days")).option(
        "checkpointLocation", str(tmp_path / "c3")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "days"))
    batch = bag(incremental.daily_status(log), "day_start", "source", "attempts", "failures")
    assert closed.count() > 100 and set(bag(closed, "day_start", "source", "attempts", "failures")) <= set(batch)


def test_lag_statistics_against_pandas(spark):
    releases = estimate.first_releases(fx.vintages(spark, "/root/testdata/sf0.01")).cache()
    pdf = releases.select("canonical_series_id", "lag_days").toPandas()
    got = {r["canonical_series_id"]: r for r in estimate.lag_statistics(releases).collect()}
    for series, group in pdf.groupby("canonical_series_id"):
        lags = sorted(group["lag_days"])
        row = got[series]
        assert row["median_lag"] == group["lag_days"].median() and row["n_periods"] == len(lags)
        assert row["p10_lag"] == lags[int(0.1 * (len(lags) - 1) + 0.5)]
        assert row["p90_lag"] == lags[int(0.9 * (len(lags) - 1) + 0.5)]


def test_link_resolution(spark):
    base = "https://a.example.com/x/y/index.html?q=1#z"
    cases = {"http://b/c": "http://b/c", "//b/c": "https://b/c", "/r/s": "https://a.example.com/r/s", "p.html": "https://a.example.com/x/y/p.html",
             "./p.html": "https://a.example.com/x/y/p.html", "../p.html": "https://a.example.com/x/p.html", "../../p.html": "https://a.example.com/p.html"}
    rows = spark.createDataFrame([(h,) for h in cases], "href string")
    got = {r["href"]: r["u"] for r in rows.select("href", text.absolute_url(F.lit(base), F.col("href")).alias("u")).collect()}
    assert got == cases
    bare = rows.limit(1).select(text.absolute_url(F.lit("http://h.example.com"), F.lit("p")).alias("u")).first()["u"]
    assert bare == "http://h.example.com/p"


def test_title_periods(spark):
    cases = {"2020年1-3月": "2020-03", "2020年 5 月份": "2020-05", "2020年上半年": "2020-06", "2020年前二季度": "2020-06", "2020年公报": "2020-12",
             "Summary, September 2021": "2021-09", "Total values Jan. 2019": "2019-01", "exports 3.2018": "2018-03", "nothing": None,
             "August, 2022": "2022-08", "May 2020": "2020-05"}
    rows = spark.createDataFrame([(t,) for t in cases], "title string")
    assert {r["title"]: r["period"] for r in text.with_title_period(rows).collect()} == cases


def test_versioned_reads_its_own_output(spark):
    first = ingest.versioned(frame(spark, [observation(value=1.0)]), frame(spark, [])).drop("reject_reason")
    assert ingest.versioned(frame(spark, [observation(value=1.0)]), first).count() == 0


def test_repeats_leave_the_state_and_late_rows_reach_the_store(spark, tmp_path):
    inbox, path, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "store"), str(tmp_path / "c")
    schema = frame(spark, [observation()]).withColumn("arrived", F.current_timestamp()).schema

    def run(rows, arrived):
        frame(spark, rows).withColumn("arrived", F.lit(arrived).cast("timestamp")).write.mode("append").parquet(inbox)
        stream = incremental.deduplicated(incremental.delivery_stream(spark, inbox, schema), "2 days", arrival="arrived")
        query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(
            lambda batch, number: incremental.append_batch(batch.drop("arrived"), path, batch_id=number)).start()
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]

    many = [observation(f"20{y:02d}-{m:02d}", value=float(m), available="2021-02-10 01:00:00", seq=100 * y + m) for y in range(10, 20) for m in range(1, 13)]
    assert run(many + many, "2024-01-01 00:00:00")["numRowsTotal"] == 120
    # a week later: one repeat, one row about an old period with an old time, one change
    late = observation("2009-01", 9.0, available="2009-02-10 01:00:00", seq=7)
    state = run([many[0], late, observation("2010-01", 5.0, available="2021-03-01 00:00:00", seq=8)], "2024-01-08 00:00:00")
    assert state["numRowsTotal"] <= 3 and state["numRowsDroppedByWatermark"] == 0
    assert bag(store.read_vintages(spark, path).where("period <= '2010-01'"), "period", "value", "vintage_no") == {
        ("2009-01", 9.0, 0): 1, ("2010-01", 1.0, 0): 1, ("2010-01", 5.0, 1): 1}
    assert store.read_vintages(spark, path).count() == 122


def changes_of(spark, path):
    return bag(spark.read.parquet(path), "ingest_seq", "known_value", "value")


def test_keyed_state_finds_what_the_batch_operator_finds(spark, tmp_path):
    inbox, schema = str(tmp_path / "inbox"), frame(spark, []).schema
    day = lambda d: f"2021-01-{d:02d} 00:00:00"
    deliveries = [
        [observation(value=1.0, available=day(1), seq=1), observation("2020-02", 2.0, available=day(1), seq=2)],
        [observation(value=1.5, available=day(3), seq=3), observation("2020-02", 2.5, available=day(3), seq=4, url="https://a/2"),
         observation("2020-03", 7.0, available=day(3), seq=5)],
        # a late row: compared with the newest value, which it does not replace; then a repeat and another key
        [observation(value=1.2, available=day(2), seq=6), observation("2020-03", 7.0, available=day(3), seq=7), observation("2020-02", 3.0, available=day(5), seq=8, url="https://a/2")],
        [observation(value=1.5, available=day(9), seq=9), observation(value=1.6, available=day(9), seq=10), observation("2020-03", 8.0, available=day(9), seq=11)],
    ]

    def run(name):
        query = incremental.stream_value_changes(incremental.delivery_stream(spark, inbox, schema, 1), str(tmp_path / "none"), str(tmp_path / f"c{name}"),
                                                 str(tmp_path / name))
        query.awaitTermination()
        return changes_of(spark, str(tmp_path / name))

    wanted, before = bag(frame(spark, []), "ingest_seq", "value", "value"), []
    for rows in deliveries:
        deliver(spark, inbox, rows)
        if before:
            wanted += bag(incremental.value_changes(frame(spark, rows), frame(spark, before), tuple(incremental.NEWEST)), "ingest_seq", "known_value", "value")
        before += rows
        got = run("one")
    assert got == wanted == {(3, 1.0, 1.5): 1, (6, 1.5, 1.2): 1, (8, 2.5, 3.0): 1, (10, 1.5, 1.6): 1, (11, 7.0, 8.0): 1}
    assert run("one") == wanted  # nothing new
    replay = incremental.stream_value_changes(incremental.delivery_stream(spark, inbox, schema, 1), str(tmp_path / "none"), str(tmp_path / "c2"), str(tmp_path / "two"))
    replay.awaitTermination()
    assert changes_of(spark, str(tmp_path / "two")) == wanted


def test_keyed_state_expires_and_the_store_answers(spark, tmp_path):
    inbox, path, out = str(tmp_path / "inbox"), str(tmp_path / "store"), str(tmp_path / "out")
    schema = frame(spark, [observation()]).withColumn("arrived", F.current_timestamp()).schema
    hour = 3600 * 1000

    def run(rows, arrived):
        frame(spark, rows).coalesce(1).withColumn("arrived", F.lit(arrived).cast("timestamp")).write.mode("append").parquet(inbox)
        query = incremental.stream_value_changes(incremental.delivery_stream(spark, inbox, schema, 1), path, str(tmp_path / "c"), out,
                                                 keep_ms=5 * hour, arrival="arrived")
        assert query.awaitTermination(60)
        ingest.append(frame(spark, rows), path)
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    run([observation(value=1.0, seq=1), observation("2020-02", 2.0, seq=2)], "2024-01-01 00:00:00")
    # one key goes on arriving, the other one leaves the state; its change is found in the store
    run([observation(value=1.4, available="2021-01-01 00:00:00", seq=3)], "2024-01-01 04:00:00")
    run([observation(value=1.5, available="2021-02-01 00:00:00", seq=4)], "2024-01-01 08:00:00")
    left = run([observation("2020-02", 2.2, available="2021-02-01 00:00:00", seq=5)], "2024-01-01 09:00:00")
    assert changes_of(spark, out) == {(3, 1.0, 1.4): 1, (4, 1.4, 1.5): 1, (5, 2.0, 2.2): 1}
    gone = run([observation("2020-09", 2.2, available="2021-02-01 00:00:00", seq=6)], "2024-01-09 00:00:00")
    assert gone < left + 1


def test_keyed_state_starts_from_history(spark, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    history = frame(spark, [observation(value=1.0, seq=1), observation(value=1.1, available="2020-06-01 00:00:00", seq=2)])
    deliver(spark, inbox, [observation(value=1.3, available="2021-01-01 00:00:00", seq=3)])
    stream = incremental.value_change_stream(incremental.delivery_stream(spark, inbox, frame(spark, []).schema), history)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start().awaitTermination()
    assert bag(spark.read.parquet(out), "ingest_seq", "known_value", "value", "unseen") == {(3, 1.1, 1.3, False): 1}


def scanned_rows(spark, rows):
    """Rows that the scan of ``rows`` hands on, from its metrics."""
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    path = str(tmp_path / "store")
    one = frame(spark, [observation()], sequence=False)
    # so many series that row groups hold no dictionary of them
    many = one.crossJoin(spark.range(200_000).select(F.col("id").alias("_n"))).withColumn("canonical_series_id", F.format_string("CN_%032x", F.col("_n") * 2)).drop("_n")
    store.append_vintages(many, path)
    known = store.read_vintages(spark, path)
    wanted = lambda n: known.where(F.col("canonical_series_id") == f"CN_{n:032x}").select("value")
    assert wanted(100_000).count() == 1 and scanned_rows(spark, wanted(100_000)) > 0
    assert scanned_rows(spark, wanted(100_001)) == 0  # inside the statistics of a row group, and in none
    plan = wanted(100_001)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(canonical_series_id" in plan


@pytest.fixture
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_a_delivery_reads_what_it_touches(spark, tmp_path, long_plans):
    path = str(tmp_path / "store")
    store.append_vintages(frame(spark, [observation(f"20{y:02d}-{m:02d}", series=f"{c}_{k}", country=c, seq=0) for y in range(10, 20) for m in range(1, 13)
                                        for c in ("CN", "US") for k in range(5)]), path)
    batch = frame(spark, [observation("2015-03", series="CN_3"), observation("2015-04", series="CN_3")])
    touched = store.read_touched(spark, path, batch)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "country" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1]
    assert "canonical_series_id" in pushed and "GreaterThanOrEqual(period,2015-03)" in pushed and "LessThanOrEqual(period,2015-04)" in pushed
    assert touched.count() == 2 and scanned_rows(spark, touched.select("value")) < 1200
    assert store.read_touched(spark, path, batch, listed=0).count() == 1200
    assert bag(ingest.new_rows(batch, touched)) == bag(ingest.new_rows(batch, store.read_vintages(spark, path)))


def test_event_store_pushes_both_bounds(spark, tmp_path, long_plans):
    from vintara.operators import asof
    events = intervals.effective_events(fx.vintages(spark, SF), "US", sidecar=fx.sidecar(spark, SF), start="1995-01-01")
    path = str(tmp_path / "events")
    store.write_events(events, path)
    kept = store.read_events(spark, path)
    assert bag(kept.select(*events.columns)) == bag(events)
    for as_of in ("1996-06-30", "1999-06-30", "2030-01-01"):
        rows = asof.at(kept, as_of, "US")
        assert bag(rows.select("canonical_series_id", "period", "value")) == bag(asof.at(events, as_of, "US").select("canonical_series_id", "period", "value"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "LessThanOrEqual(valid_from" in pushed and "Or(IsNull(valid_to),GreaterThan(valid_to" in pushed and "US" in plan.split("PartitionFilters: [")[1]
