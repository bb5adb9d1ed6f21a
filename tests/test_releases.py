"""Release pages in the layouts that occur."""

import pytest
from pyspark.sql import functions as F

from vintara.operators import releases as R
from vintara.operators.text import LinkRule, discover


def gdp(spark, *pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "k int, p struct<title:string,html:string>").select("k", "p.*")
    return [(r.period, r.value, r.problem) for r in R.gdp_tables(rows, ["k"]).orderBy("k").collect()]


def body(*tables, count=1):
    return "".join(f"<div class='x txt-content'>{''.join(f'<table>{t}</table>' for t in tables)}</div>" for _ in range(count))


FIRST = "国内生产总值初步核算结果"


def two_levels(quarter, until, growth="比上年同期增长（%）", amount="绝对额（亿元）", values=("100", "300", "6.5", "7.0"), spans=True, periods=True):
    span = ' colspan="2"' if spans else ""
    head = f"<tr><th></th><th{span}>{amount}</th><th{span}>{growth}</th></tr>"
    under = f"<tr><th>{quarter}</th><th>{until}</th><th>{quarter}</th><th>{until}</th></tr>" if periods else ""
    return head + under + "<tr><td>GDP</td>" + "".join(f"<td>{v}</td>" for v in values) + "</tr>"


def test_gdp_growth_of_the_quarter_alone(spark):
    three = "<tr><td></td><td>绝对额（亿元）</td><td>比上年同期增长（%）</td></tr>"
    assert gdp(
        spark,
        ("2026年二季度和上半年" + FIRST, body(two_levels("二季度", "上半年"))),
        ("2015年3季度我国GDP初步核算结果", body(two_levels("3季度", "1-3季度", spans=False))),
        ("2021年四季度和全年国内生产总值（GDP）初步核算结果", body(two_levels("4季度", "全年", amount="现价总量（亿元）", growth="比去年同期增长（%）"))),
        ("2026年一季度" + FIRST, body(three + "<tr><td>GDP</td><td>334193</td><td>5.0</td></tr>")),
        ("2016年1季度" + FIRST, body(three + "<tr><td>1季度</td><td>1季度</td></tr><tr><td>国内生产总值</td><td>9</td><td>-6.7</td></tr>")),
        # the lead cell reaches over both header rows
        ("2020年三季度" + FIRST, body(two_levels("三季度", "前三季度").replace("<th></th>", "<th rowspan='2'></th>", 1))),
        # another table before it, and the same figure twice
        ("2020年3季度" + FIRST, body("<tr><td>说明</td></tr>", two_levels("3季度", "1-3季度"), two_levels("3季度", "1—3季度"))),
    ) == [("2026-Q2", 6.5, None), ("2015-Q3", 6.5, None), ("2021-Q4", 6.5, None), ("2026-Q1", 5.0, None), ("2016-Q1", -6.7, None),
          ("2020-Q3", 6.5, None), ("2020-Q3", 6.5, None)]


def test_gdp_refuses_what_the_headers_do_not_say(spark):
    title = "2015年3季度我国GDP初步核算结果"
    doubtful = (None, None, "no_agreed_growth_column")
    assert gdp(
        spark,
        (title, body(two_levels("3季度", "1-3季度", growth="环比增长（%）"))), (title, body(two_levels("3季度", "1-3季度", periods=False))),
        (title, body(two_levels("2季度", "上半年"))), (title, body(two_levels("3季度", "1-3季度"), two_levels("3季度", "1-3季度", values=("1", "2", "3", "4")))),
        (title, body(two_levels("3季度", "1-3季度"), count=2)), (title, "<p>x</p>"), ("2015年3季度经济运行", body(two_levels("3季度", "1-3季度"))),
        ("初步核算 GDP", body(two_levels("3季度", "1-3季度"))), (None, None), (title, body("")),
    ) == [doubtful, doubtful, doubtful, doubtful, (None, None, "no_unique_body"), (None, None, "no_unique_body"),
          (None, None, "not_an_initial_release"), (None, None, "no_supported_title"), (None, None, "not_an_initial_release"), doubtful]


def listed(*rows):
    return "<tr><td></td><td>GDP环比增长速度（%）</td><td>GDP同比增长速度（%）</td></tr>" + "".join(
        "<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)


def test_gdp_of_the_year_so_far_lists_quarters(spark):
    good = listed(("2014年4季度", "1.7", "7.2"), ("<p>2015年1季度</p><p>2季度</p>", "<p>1.4</p><p>1.8</p>", "<p>7.0</p><p>6.9</p>"))
    doubtful = (None, None, "no_agreed_growth_column")
    assert gdp(
        spark, ("2015年上半年我国GDP初步核算情况", body(good)), ("2015年1-2季度我国GDP初步核算情况", body(good)),
        ("2015年1-3季度我国GDP初步核算情况", body(good)),  # ends before the period
        ("2014年1-4季度GDP初步核算情况", body(good)),  # goes beyond it
        ("2015年上半年GDP初步核算", body(listed(("2014年4季度", "1", "7.2"), ("2015年2季度", "1", "6.9")))),  # a gap
        ("2015年上半年GDP初步核算", body(listed(("2015年1季度2季度", "1", "7.2 6.9")))),  # values do not fit the labels
        ("2015年上半年GDP初步核算", body(listed(("1季度", "1", "7.2"), ("2季度", "1", "6.9")))),  # no year
    ) == [("2015-Q2", 6.9, None), ("2015-Q2", 6.9, None), *[doubtful] * 5]


def test_grids_repeat_what_spans(spark):
    html = ("<table><tr><td rowspan=3>a</td><td colspan='2'>b</td><td>c</td></tr><tr><td>d</td><td rowspan=\"2\">e</td><td>f</td></tr>"
            "<tr><td>g</td><td>h</td></tr><tr></tr><tr><th>i</th></tr></table><table></table>")
    got = spark.createDataFrame([(html,)], "h string").select(R.table_grids(F.col("h")).alias("g")).first().g
    assert got == [[["a", "b", "b", "c"], ["a", "d", "e", "f"], ["a", "g", "e", "h"], [], ["i"]], []]


POP = "全部国有工业企业及年产品销售收入500万元以上的非国有工业企业"
INDUSTRY, RETAIL = "CN_INDUSTRIAL_VALUE_ADDED_YOY", "CN_RETAIL_SALES_YOY"
SALES = "社会消费品零售总额"

LEGACY = {
    ("1月份全国工业生产平稳增长 完成增加值4844亿元", f"<p>1月份，{POP}完成增加值4844亿元，比去年同月增长20.9%，如果扣除去年1月春节放假因素的影响，按日均水平计算，增长8.9％。</p>"):
        [(INDUSTRY, "2005-01", 20.9, None)],
    (f"1-2月份全国{SALES}同比增长13.6%", f"<p> </p><p>1-2月份，{SALES}10313亿元，比上年同期增长13.6%。其中1月份增长11.5%，2月份增长15.8%。</p>"):
        [(RETAIL, "2005-01", 11.5, None), (RETAIL, "2005-02", 15.8, None)],
    ("一季度我国工业实现增加值14415亿 增长16.2%", f"<p>一季度，工业生产继续保持较快增长，{POP}完成增加值14,415亿元，同比增长16.2%，增速比去年同期回落1.5个百分点。其中，3月份完成增加值5367亿元，同比增长15.1%。</p>"):
        [(INDUSTRY, "2005-03", 15.1, None)],
    (f"上半年全国{SALES}同比增长13.2%", f"<p>上半年，{SALES}29610亿元，比去年同期增长13.2%。其中，6月份增长12.9%。</p><p>分地域看，6月份城市增长14.2%。</p>"):
        [(RETAIL, "2005-06", 12.9, None)],
    (f"4月份{SALES}同比下降1.2%", f"<p>4月份，{SALES}4663亿元，比去年同月下降1.2%，扣除价格因素实际增长0.1%。1-4月份同比增长2.5%。</p>"):
        [(RETAIL, "2005-04", -1.2, None)],
    ("4月份全国实现工业增加值5647亿 同比增长16%", f"<p>4月份，{POP}完成增加5647亿元，同比增长16%。其中，重工业完成增加值3913亿元，增长16.5%。</p><p>1-4月份累计同比增长16.2%。</p>"):
        [(INDUSTRY, "2005-04", 16.0, None)],
    (f"2月份{SALES}", f"<p>1-2月份，{SALES}13亿元，同比增长13.6%。其中，2月份城市增长15%，增长7%。</p>"): [(RETAIL, None, None, "no_monthly_statement")],
    ("1-2月份全国实现工业增加值9034亿元", f"<p>1-2月份，{POP}完成增加值9034亿元，同比增长16.9%。</p><p>其中2月份电子行业增长25%。</p>"):
        [(INDUSTRY, None, None, "no_monthly_statement")],
    (f"1-2月份{SALES}同比增长", f"<p>1-2月份，{SALES}10313亿元，比上年同期增长13.6%。其中2月份增长15.8%，2月份增长15.9%。</p>"):
        [(RETAIL, None, None, "conflicting_months")],
    (f"1-2月份{SALES}增长", f"<p>1-2月份，{SALES}10313亿元，比上年同期增长13.6%。其中3月份增长15.8%。</p>"): [(RETAIL, None, None, "after_the_period")],
    ("1月份全国工业生产平稳增长", "<p>1月份，国有企业完成增加值904亿元，同比增长21.3%。</p>"): [(INDUSTRY, None, None, "unverified_population")],
    (f"3月份{SALES}", "<p>3月份，城市增长9%。</p>"): [(RETAIL, None, None, "unverified_measure")],
    (f"5月份{SALES}", "<div>x</div>"): [(RETAIL, None, None, "no_lead_paragraph")],
    ("1月份国民经济运行 工业增加值", "<p>x</p>"): [], ("1月份工业生产者价格", "<p>x</p>"): [], (f"{SALES}", "<p>x</p>"): [],
    (f"2015年1月份{SALES}", "<p>x</p>"): [],
}


def test_legacy_prose_binds_rates_to_their_month(spark):
    rows = [(i, t, f"<div class='txt-content'>{h}</div>", "2005-08-15") for i, (t, h) in enumerate(LEGACY)]
    got = R.legacy_activity(spark.createDataFrame(rows, "k int, title string, html string, published string"), ["k"]).collect()
    for i, wanted in enumerate(LEGACY.values()):
        assert sorted((tuple(r)[1:] for r in got if r.k == i), key=str) == sorted(wanted, key=str), list(LEGACY)[i]


def test_legacy_year_rolls_back_before_the_month(spark):
    rows = [(1, f"12月份{SALES}", f"<div class='txt-content'><p>12月份，{SALES}5亿元，同比增长1%。</p></div>", "2006-01-20")]
    got = R.legacy_activity(spark.createDataFrame(rows, "k int, title string, html string, published string"), ["k"]).first()
    assert (got.period, got.value) == ("2005-12", 1.0)


def test_row_labels_are_titles(spark):
    html = ("<a href='/x.html'>Jan.</a><table><tr><td>(1) Summary of Imports (In USD)</td><td><a href='/a.html'>Jan.</a><a title='Summary of y' href='/b.html'>z</a></td></tr>"
            "<tr><td>(2) By Country</td><td><a href='/c.html'>Jan.</a></td></tr></table><a href='d.html'>Summary of w</a>")
    pages = spark.createDataFrame([(1, "https://h.org/i/j.html", html), (2, "https://h.org/", None)], "page_id int, url string, html string")
    found = R.row_links(pages, "Summary of")
    assert [(r.position, r.title, r.link) for r in found.orderBy("position").collect()] == [
        (0, "Jan.", "https://h.org/x.html"), (1, "(1) Summary of Imports (In USD) Jan. z [Jan.]", "https://h.org/a.html"),
        (2, "Summary of y", "https://h.org/b.html"), (3, "Jan.", "https://h.org/c.html"), (4, "Summary of w", "https://h.org/i/d.html")]
    assert discover(found, LinkRule("customs", ("Summary of",))).count() == 3


STOCK = [R.StockLabel("M2", ("货币和准货币", "M2")), R.StockLabel("M1", ("货币(M1)", "M1")), R.StockLabel("M0", ("流通中现金", "M0"))]


def stock(spark, html):
    rows = R.annual_stock(spark.createDataFrame([(1, html)], "k int, html string"), STOCK, ["k"]).collect()
    return {(r.metric, r.period): round(r.value, 6) for r in rows}


def row(*cells):
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def test_annual_stock_tables(spark):
    months = [f"2004.{m:02d}" for m in range(1, 7)]
    plain = "<table>" + row("货币供应量") + row("项目 Item", *months) + row("货币和准货币（M2）", *[f"22{i},101.93" for i in range(6)]) + row("货币（M1）", *[f"8380{i}.9" for i in range(6)]) + "</table>"
    want = {("M2", f"2004-{m:02d}"): round(float(f"22{m - 1}101.93") / 1e4, 6) for m in range(1, 7)}
    want |= {("M1", f"2004-{m:02d}"): round(float(f"8380{m - 1}.9") / 1e4, 6) for m in range(1, 7)}
    assert stock(spark, plain) == want
    # years over months, written once and carried to the right, or spanning
    months = [f"{m}月" for m in (10, 11, 12, 1, 2, 3)]
    values = row("流通中现金", *[str(i) for i in range(1, 7)])
    want = {("M0", p): i / 1e4 for i, p in enumerate(["2003-10", "2003-11", "2003-12", "2004-01", "2004-02", "2004-03"], 1)}
    assert stock(spark, "<table>" + row("项目", "2003年", "", "", "2004年", "", "") + row("", *months) + values + "</table>") == want
    spanning = "<tr><td rowspan=2>项目</td><td colspan=3>2003</td><td colspan=3>2004</td></tr>" + row(*months)
    assert stock(spark, f"<table>{spanning}{values}</table>") == want
    # the table with the most periods counts; too few periods, or too few values, are none
    small = plain.replace("8380", "1")
    assert stock(spark, small + f"<table>{row('x', *[f'2004.{m}' for m in range(1, 8)])}{row('M0', *'1234567')}</table>") == {("M0", f"2004-0{m}"): m / 1e4 for m in range(1, 8)}
    assert stock(spark, "<table>" + row("x", "2004.01", "2004.02") + row("M0", "1", "2") + "</table>") == {}
    assert stock(spark, "<table>" + row("x", *[f"2004.{m}" for m in range(1, 8)]) + row("M0", "1", "2") + "</table>") == {}


def test_reprints_are_judged_in_order(spark):
    good = "<h1>2026年7月金融统计数据报告</h1><title>2026年7月金融统计数据报告 - 网站</title>"
    pages = [(1, good, "A", "2026-08-17", "official_page_timestamp"), (2, good, "B", "2026-08-17", "official_page_date"),
             (3, "<h1>2026年7月青岛市金融统计数据报告</h1>", "A", "2026-08-17", "x"), (4, "<h1>x</h1>", "A", "2026-08-17", "x"), (5, good, "D", None, None),
             (6, good, "A", "2026-08-17", None), (7, None, "A", "2026-08-17", "x")]
    frame = spark.createDataFrame(pages, "k int, html string, pit_grade string, release_at string, release_date_source string")
    metrics = spark.createDataFrame([(k, m) for k in range(1, 8) for m in ("M1", "M2") if (k, m) != (6, "M1")], "k int, metric string")
    got = {r.k: tuple(r)[1:] for r in R.accepted_reprints(frame, metrics, ["M1", "M2"], ["k"]).collect()}
    assert got == {1: ("B", "government_reprint_page_timestamp", None, None), 2: ("B", "government_reprint_page_date", None, None),
                   3: (None, None, "", "local_report"), 4: (None, None, "", "no_national_headline"), 5: (None, None, "", "no_publication_evidence"),
                   6: (None, None, "M1", "missing_core_metrics"), 7: (None, None, "", "no_national_headline")}
