"""Steps that the text queries share: values computed once, tag-to-tag patterns, tasks by rows, files written by many tasks."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from vintara.functions import texts
from vintara.operators import releases, text
from vintara.queries import QUERIES, fixture, load_all
from vintara.sources import files, sinks

load_all()

from vintara.queries import storage  # noqa: E402

ODD = ["", "<table><tr><td>a</td></tr></table>", "<TABLE x=1><TR><TH>１</th><td>b<br>c</TD></tr><tr><td>open</table>", "<table><tr><td>a<td>b</tr><tr><td>c\n",
       "<table><tr><td a='>'>x < y</td><td></td></tr><tr></tr></table><table><tr><td>z</td></tr>", "a<table\n><tr\n><td\nrowspan=2>q</td\n></tr></table>", None]


def frame(spark, rows):
    return spark.createDataFrame([(i, h) for i, h in enumerate(rows)], "k long, html string")


def test_a_page_is_stripped_once(spark):
    found = frame(spark, ["<p>１&amp;２</p>"]).select(texts.compact(texts.plain_text(F.col("html"))).alias("x"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<!--") == 1
    assert found.first().x == "1&2"


@pytest.mark.parametrize("old, new", [
    (r"(?is)<table.*?</table>", rf"(?is)<table{texts.until('/table>')}</table>"),
    (r"(?is)<tr.*?</tr>", rf"(?is)<tr{texts.until('/tr>')}</tr>"),
    (r"(?is)<td[^>]*>.*?</td>", rf"(?is)<td[^>]*>{texts.until('/td>')}</td>"),
    (r"(?is)<t[dh]\b[^>]*>.*?(?=<t[dh]\b|</t[dh]>|</tr>|\z)", rf"(?is)<t[dh]\b[^>]*>{texts.until(r't[dh]\b|/t[dh]>|/tr>')}"),
])
def test_patterns_from_tag_to_tag_find_the_same(spark, old, new):
    read = frame(spark, ODD).select(F.regexp_extract_all("html", F.lit(old), F.lit(0)).alias("a"), F.regexp_extract_all("html", F.lit(new), F.lit(0)).alias("b"))
    assert all(r.a == r.b for r in read.collect())


def test_grids_of_plain_and_spanning_rows(spark):
    page = ("<table><tr><td>a</td><td rowspan=2>b</td></tr><tr><td>c</td></tr><tr><td colspan='2'>d</td><td>e</td></tr><tr><td>f</td><td>ｇ</td></tr></table>")
    assert frame(spark, [page]).select(releases.table_grids(F.col("html")).alias("g")).first().g == [[["a", "b"], ["c", "b"], ["d", "d", "e"], ["f", "g"]]]


def test_found_text_is_cast_without_failing_casts(spark):
    read = spark.createDataFrame([("12",), ("",), (None,), ("x",)], "t string").select(texts.cast_found(F.col("t"), "int").alias("n"))
    assert [r.n for r in read.collect()] == [12, None, None, None]


def test_tables_that_disagree_need_no_distinct_rows(spark):
    cells = lambda v: f"<tr><td>一、L</td><td>1</td><td>{v}</td><td>3</td><td>4</td></tr>"
    head = "<tr><td>指标</td><td>2月份</td><td>1—2月份</td></tr><tr><td>绝对量</td><td>同比增长（%）</td><td>绝对量</td><td>同比增长（%）</td></tr>"
    pages = [f"<table>{head}{cells(a)}</table><table>{head}{cells(b)}</table>" for a, b in ((5, 5), (5, 6), (5, "…"), ("…", "…"), (5, "?"))]
    found = text.table_metrics(frame(spark, pages).withColumn("month", F.lit(2)), {"L": ("M", 2)}, ["k"])
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.k, r.problem) for r in found.collect()) == [
        (0, None), (1, "conflicting_tables"), (2, "conflicting_tables"), (3, None), (4, "unexpected_cell")]


def test_tasks_of_heavy_jobs_follow_the_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fixture, "SPREAD_ROWS", 50)
    rows = fixture.table(spark, sf_dir, "orders").count()
    spread = fixture.table(spark, sf_dir, "orders", spread_by="o_orderkey")
    assert spread.rdd.getNumPartitions() == -(-rows // 50) > spark.sparkContext.defaultParallelism


def test_evidence_files_are_written_by_many_tasks(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "folder", lambda spark, kind: str(tmp_path / kind))
    found = QUERIES["src_15_raw_evidence_files"](spark, sf_dir)
    assert len({p.name[:10] for p in (tmp_path / "raw").glob("page_id=*/part-*")}) > 1
    assert found.count() == fixture.table(spark, sf_dir, "pages").count()


def test_maps_of_fixed_entries_are_one_literal(spark, monkeypatch):
    """Thousands of literals in every copy of an expression took seconds to plan."""
    made, lit = [], F.lit
    monkeypatch.setattr(texts.F, "lit", lambda value: made.append(value) or lit(value))
    pages = frame(spark, ["<table><tr><td>ﬁ㈱</td><td>&eacute;</td></tr></table>"])
    grids = pages.select(releases.table_grids(F.col("html")).alias("g"), texts.entities(F.col("html")).alias("e"))
    assert len(made) < 200
    assert grids.first().g == [[["fi(株)", "&eacute;"]]] and "é" in grids.first().e


def test_simple_and_other_characters_have_their_plain_form(spark):
    odd = ["", "a 1", "１％（２）", "…—１", "㈱…１", "\u3000１\n", "中文，：", "①x", "½", "“１”·", None]
    read = frame(spark, odd).select("html", texts.typography(F.col("html")).alias("t"), texts.compact(F.col("html")).alias("c"))
    for r in read.collect():
        expected = None if r.html is None else "".join(unicodedata.normalize("NFKC", c) for c in r.html)
        assert r.t == expected
        assert r.c == (None if expected is None else expected.replace(" ", "").replace("\n", ""))


def test_table_metrics_read_a_page_once(spark):
    pages = frame(spark, ODD).withColumn("month", F.lit(2))
    plan = text.table_metrics(pages, {"L": ("M", 2)}, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("</table>") == 1  # the explode's test for an empty array does not read it again


def test_cells_are_cleaned_behind_blank_ones(spark):
    head = "<tr><td> </td><td>０2月份</td><td>1—2月</td></tr><tr><td>绝对量</td><td>同比增长（％）</td><td>绝对 量</td><td><b>同比增长</b>(%)</td></tr>"
    rows = ("<tr><td> </td><td></td><td>（一）Ｌ（亿元）</td><td>1</td><td> ７.5</td><td>3</td><td>4</td></tr>"
            "<tr><td>Q</td><td>1</td><td>2</td><td>3</td></tr><tr><td></td><td></td><td></td><td></td><td></td></tr>")
    pages = frame(spark, [f"<table><tr><td>x</td></tr>{head}{rows}</table>", f"<table>{rows}</table>", None]).withColumn("month", F.lit(2))
    found = text.table_metrics(pages, {"L": ("M", 2), "Q": ("N", 1)}, ["k"])
    assert [(r.k, r.metric, r.value, r.problem) for r in found.collect()] == [(0, "M", 7.5, None)]


def test_raw_files_hold_the_lines_of_their_key(spark, tmp_path):
    rows = [(1, "a\nb"), (2, None), (3, "１"), (3, "１"), (None, "n")]
    sinks.write_raw_files(spark.createDataFrame(rows, "k long, c string").repartition(3, "k"), "k", "c", f"file:{tmp_path}/raw")
    found = files.read_evidence(spark, f"{tmp_path}/raw", "raw").selectExpr("split(path, '/')[0] AS k", "decode(content, 'UTF-8') AS c")
    assert sorted((r.k, r.c) for r in found.collect()) == [("k=1", "a\nb\n"), ("k=2", "\n"), ("k=3", "１\n１\n"), ("k=__HIVE_DEFAULT_PARTITION__", "n\n")]
    assert all(p.name.startswith("part-") for p in tmp_path.rglob("*") if p.is_file())
    sinks.write_raw_files(spark.createDataFrame([], "k long, c string"), "k", "c", str(tmp_path / "none"))
    assert files.read_evidence(spark, str(tmp_path / "none")).collect() == []


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    few = 4 * spark.sparkContext.defaultParallelism
    sinks.write_raw_files(spark.range(few + 40).selectExpr("id", "'x' AS c"), "id", "c", str(tmp_path / "raw"))
    usual, tracker = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism"), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    found = files.read_evidence(spark, str(tmp_path / "raw"))
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("read", "read")
    assert stages and all(tracker.getStageInfo(s).numTasks <= few for s in stages)
    assert found.count() == few + 40
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == usual
