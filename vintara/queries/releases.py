"""Release pages in the layouts that have to be read: Spark writes a page from each vintage, and the SQL twin knows what it states."""

from pyspark.sql import functions as F

from ..operators import releases as rl
from ..operators.text import LinkRule, discover
from . import query
from .fixture import V, table, vintages


def stated(spark, sf_dir):
    return vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "year(period_end) + 10 AS y", "month(period_end) AS m", "quarter(period_end) AS q", "cast(ingest_seq % 7 + 1 AS double) / 2 AS v")


STATED = f"""{V}, s AS (SELECT ingest_seq AS k, year(period_end) + 10 AS y, CAST(month(period_end) AS INTEGER) AS m, quarter(period_end) AS q,
    CAST(ingest_seq % 7 + 1 AS DOUBLE) / 2 AS v FROM v)"""

_GROWTH = "CASE WHEN k % 7 = 2 THEN '环比增长（%）' WHEN k % 2 = 0 THEN '比上年同期增长（%）' ELSE '比去年同期增长（%）' END"
_LEVEL = "CASE WHEN k % 3 = 0 THEN '现价总量（亿元）' ELSE '绝对额（亿元）' END"
_UNTIL = "CASE WHEN k % 2 = 0 THEN concat('1—', q, '季度') ELSE element_at(array('', '上半年', '前三季度', '全年'), q) END"


def _gdp_table(value: str) -> str:
    """A table by layout: first quarters have three columns, others a header of two rows, with spans or without."""
    lead = "CASE WHEN k % 4 = 0 THEN '<th rowspan=2></th>' ELSE '<th></th>' END"
    span = "CASE WHEN k % 7 = 1 THEN '' ELSE ' colspan=\"2\"' END"
    return (f"CASE WHEN q = 1 THEN concat('<table><tr><td></td><td>', {_LEVEL}, '</td><td>', {_GROWTH}, '</td></tr>',"
            f" CASE WHEN k % 2 = 0 THEN '<tr><td>一季度</td><td>1季度</td></tr>' ELSE '' END, '<tr><td>GDP</td><td>100</td><td>', {value}, '</td></tr></table>')"
            f" ELSE concat('<table><tr>', {lead}, '<th', {span}, '>', {_LEVEL}, '</th><th', {span}, '>', {_GROWTH}, '</th></tr><tr><th>', single, '</th><th>', {_UNTIL},"
            f" '</th><th>', single, '</th><th>', {_UNTIL}, '</th></tr><tr><td>国内生产总值</td><td>1</td><td>2</td><td>', {value}, '</td><td>99</td></tr></table>') END")


def gdp_pages(spark, sf_dir):
    named = stated(spark, sf_dir).selectExpr("*", "concat(CASE WHEN k % 5 = 0 THEN substr('一二三四', q, 1) ELSE cast(q AS string) END, '季度') AS single")
    quarters = ("concat('<tr><td>', CASE WHEN q - i = 1 OR i = least(q, 2) - 1 THEN concat(y, '年') ELSE '' END, q - i, '季度</td><td>1.1</td><td>', cast(CASE WHEN i = 0 THEN v ELSE 50 END AS string), '</td></tr>')")
    listing = (f"concat('<table><tr><td></td><td>GDP环比增长速度（%）</td><td>GDP同比增长速度（%）</td></tr>', concat_ws('', transform(sequence(least(q, 2) - 1, 0), i -> {quarters})), '</table>')")
    return named.selectExpr(
        "k", "CASE k % 7 WHEN 4 THEN concat(y, '年', CASE WHEN q = 2 AND k % 2 = 0 THEN '上半年' ELSE concat('1-', q, '季度') END, '我国GDP初步核算情况')"
        " WHEN 5 THEN concat(y, '年', single, 'GDP核算') ELSE concat(y, '年', single, CASE WHEN k % 2 = 0 THEN '国内生产总值（GDP）' ELSE '我国GDP' END, '初步核算结果') END AS title",
        f"concat('<table><tr><td>GDP</td></tr></table><div class=\"main txt-content\">', CASE k % 7 WHEN 4 THEN {listing} WHEN 3 THEN concat({_gdp_table('v')}, {_gdp_table('v + 1')})"
        f" ELSE {_gdp_table('v')} END, '</div>') AS html")


@query("txt_07_gdp_tables", f"""
    WITH {STATED}, e AS (SELECT *, CASE WHEN k % 7 = 5 THEN 'not_an_initial_release' WHEN k % 7 = 4 AND q = 1 THEN 'no_supported_title'
                                        WHEN k % 7 IN (2, 3) THEN 'no_agreed_growth_column' END AS problem FROM s)
    SELECT k, CASE WHEN problem IS NULL THEN y || '-Q' || q END AS period, CASE WHEN problem IS NULL THEN v END AS value, problem FROM e""")
def gdp_tables(spark, sf_dir):
    return rl.gdp_tables(gdp_pages(spark, sf_dir), ["k"])


_POPULATION = "全部国有工业企业及年产品销售收入500万元以上的非国有工业企业"


def activity_pages(spark, sf_dir):
    """Early monthly releases, published in the month after theirs."""
    sales = "社会消费品零售总额"
    return stated(spark, sf_dir).selectExpr("k", "2000 + y % 10 AS y", "m", "v").selectExpr(
        "k", "add_months(make_date(y, m, 15), 1) AS published",
        f"CASE k % 7 WHEN 0 THEN concat(m, '月份全国工业生产平稳增长') WHEN 1 THEN concat('1-', m, '月份全国{sales}同比增长') WHEN 2 THEN concat(m, '月份{sales}')"
        f" WHEN 3 THEN concat(m, '月份我国工业增加值') WHEN 4 THEN concat('1-', m, '月份全国工业实现增加值') WHEN 5 THEN concat(m, '月份国民经济运行 工业增加值')"
        f" ELSE concat(y, '年', m, '月份{sales}下降') END AS title",
        f"concat('<p>9月份增长1%</p><div class=\"txt-content\"><p> </p><p>', CASE k % 7"
        f" WHEN 0 THEN concat(m, '月份，{_POPULATION}完成增加值4,844亿元，比去年同月增长', v, '%，扣除放假因素，增长8.9％。其中，重工业完成增加值13亿元，增长16.5%。')"
        f" WHEN 1 THEN concat('1-', m, '月份，{sales}10313亿元，比上年同期增长13.6%。其中', m, '月份增长', v, '%，城市增长3%。')"
        f" WHEN 2 THEN concat('1-', m, '月份，{sales}10313亿元，同比增长13.6%。其中', m, '月份增长', v, '%，', m, '月份增长', v + 1, '%。')"
        f" WHEN 3 THEN concat(m, '月份，国有企业完成增加值904亿元，同比增长', v, '%。')"
        f" WHEN 4 THEN concat('1-', m, '月份，{_POPULATION}完成增加值904亿元，同比增长', v, '%。')"
        f" WHEN 5 THEN concat(m, '月份，增长', v, '%。')"
        f" ELSE concat(m, '月份，{sales}4663亿元，比去年同月下降', v, '%，扣除价格因素实际增长0.1%。') END, '</p><p>分地域看，', m, '月份城市增长14.2%。</p></div>') AS html")


@query("txt_08_legacy_activity", f"""
    WITH {STATED}, e AS (SELECT *, CASE k % 7 WHEN 2 THEN 'conflicting_months' WHEN 3 THEN 'unverified_population' WHEN 4 THEN 'no_monthly_statement' END AS problem
                         FROM s WHERE k % 7 <> 5)
    SELECT k, CASE WHEN k % 7 IN (0, 3, 4) THEN 'CN_INDUSTRIAL_VALUE_ADDED_YOY' ELSE 'CN_RETAIL_SALES_YOY' END AS metric,
           CASE WHEN problem IS NULL THEN (2000 + y % 10) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') END AS period,
           CASE WHEN problem IS NULL THEN CASE WHEN k % 7 = 6 THEN -v ELSE v END END AS value, problem FROM e""")
def legacy_activity(spark, sf_dir):
    return rl.legacy_activity(activity_pages(spark, sf_dir), ["k"])


@query("txt_09_reprints", f"""
    WITH {STATED}, e AS (SELECT k, CASE WHEN k % 7 = 0 THEN 'local_report' WHEN k % 5 = 0 THEN 'no_national_headline' WHEN k % 11 = 0 THEN 'missing_core_metrics'
                                        WHEN k % 3 = 0 THEN 'no_publication_evidence' END AS problem FROM s)
    SELECT k, CASE WHEN problem IS NULL THEN 'B' END AS pit_grade, CASE WHEN problem IS NULL THEN 'government_reprint_page_' || CASE WHEN k % 3 = 1 THEN 'timestamp' ELSE 'date' END END
               AS release_date_source, CASE WHEN problem IS NOT NULL THEN CASE WHEN k % 11 = 0 THEN 'M1' ELSE '' END END AS missing, problem FROM e""")
def reprints(spark, sf_dir):
    facts = stated(spark, sf_dir)
    pages = facts.selectExpr(
        "k", "concat('<html><title>', y, '年', m, '月金融统计数据报告 -- 转载</title><h1>', CASE WHEN k % 5 = 0 AND k % 7 <> 0 THEN '统计' ELSE concat(y, '年', m, '月',"
        " CASE WHEN k % 7 = 0 THEN '青岛市' ELSE '' END, '金融统计数据报告') END, '</h1></html>') AS page",
        "CASE k % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'A' ELSE 'B' END AS pit_grade", "CASE WHEN k % 3 > 0 THEN make_date(y, m, 1) END AS release_at",
        "CASE k % 3 WHEN 0 THEN 'first_seen_only' WHEN 1 THEN 'official_page_timestamp' ELSE 'official_page_date' END AS release_date_source")
    pages = pages.withColumn("html", F.expr("CASE WHEN k % 5 = 0 AND k % 7 <> 0 THEN replace(page, '金融统计数据报告', '') ELSE page END"))
    metrics = facts.selectExpr("k", "explode(array('M0', 'M1', 'M2')) AS metric").where("k % 11 <> 0 OR metric <> 'M1'")
    return rl.accepted_reprints(pages, metrics, ["M0", "M1", "M2"], ["k"])


_WANTED = r"(?i)^(?=.*usd)(?!.* by ).*(summary of imports and exports|total export & import values)"


@query("txt_10_row_labels", """
    WITH p AS (SELECT page_id, substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(page_id % 12 AS INTEGER) * 3 + 1, 3) AS mon, 2010 + page_id % 10 AS y FROM pages)
    SELECT 'https://h' || page_id || '.org/Statics/a' || page_id || '.html' AS link,
           '(1) Summary of Imports and Exports, ' || mon || ' ' || y || ' (In USD) here [here]' AS title,
           y || '-' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0') AS period, 'customs' AS kind, page_id FROM p
    UNION ALL SELECT 'https://h' || page_id || '.org/Statics/c' || page_id || '.html', 'Total Export & Import Values (USD)', NULL, 'customs', page_id FROM p WHERE page_id % 2 = 0""")
def row_labels(spark, sf_dir):
    """Monthly indexes whose anchors say little: the label stands in the row."""
    pages = table(spark, sf_dir, "pages", ["page_id"], spread_by="page_id").selectExpr(
        "page_id", "concat('http://h', page_id, '.org/report/monthly.html') AS url",
        "concat('<p><a href=\"/Statics/z.html\">here</a></p><table><tr><td>(1) Summary of Imports and Exports, ', substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(page_id % 12 AS int) * 3 + 1, 3),"
        " ' ', 2010 + page_id % 10, ' (In USD)</td><td><a href=\"/Statics/a', page_id, '.html\">here</a></td></tr><tr><td>(2) Summary of Imports and Exports by Country (In USD)</td>"
        "<td><a href=\"/Statics/b.html\">here</a></td></tr></table>', CASE WHEN page_id % 2 = 0 THEN concat('<a href=\"../Statics/c', page_id,"
        " '.html\" title=\"Total Export & Import Values (USD)\">x</a>') ELSE '' END, '<a href=\"/Statics/d.html\">Summary of Imports and Exports (In CNY)</a>') AS html")
    rule = LinkRule("customs", ("Summary of Imports and Exports", "Total Export & Import Values"), (" by ", "CNY"), force_https=True)
    return discover(rl.row_links(pages, _WANTED), rule)


STOCK = [rl.StockLabel("CN_M2_STOCK", ("货币和准货币", "M2")), rl.StockLabel("CN_M1_STOCK", ("货币(M1)", "M1")), rl.StockLabel("CN_M0_STOCK", ("流通中现金", "流通中货币", "M0"))]


@query("txt_14_annual_stock", f"""
    WITH {STATED} SELECT k, metric, (y + (m + i - 1) // 12) || '-' || lpad(CAST((m + i - 1) % 12 + 1 AS VARCHAR), 2, '0') AS period,
        (225000.5 + k % 1000 + i + extra)::DOUBLE * 1e-4::DOUBLE AS value, 'D' AS pit_grade
    FROM s, (VALUES ('CN_M2_STOCK', 0), ('CN_M0_STOCK', 7)) t(metric, extra), range(12) r(i) WHERE i < 6 + k % 7""")
def annual_stock(spark, sf_dir):
    """Tables of six to twelve months from any month on, with months written out or years over months."""
    last = "cast(5 + k % 7 AS int)"
    year, month = "(y + (m + i - 1) div 12)", "((m + i - 1) % 12 + 1)"
    opens = f"(i = 0 OR {month} = 1)"
    cells = lambda content, tag="td": f"concat_ws('', transform(sequence(0, {last}), i -> concat('<{tag}>', {content}, '</{tag}>')))"
    amount = lambda extra: f"format_number(225000.5D + k % 1000 + i + {extra}, 2)"
    years = f"CASE WHEN {opens} THEN concat({year}, CASE WHEN k % 2 = 0 THEN '年' ELSE '' END) ELSE '' END"
    written = f"concat({year}, element_at(array('.', '年', '/', '-'), cast(k % 4 + 1 AS int)), lpad(cast({month} AS string), 2, '0'))"
    header = (f"CASE WHEN k % 3 = 0 THEN concat('<tr><td>项目 Item</td>', {cells(written)}, '</tr>')"
              f" ELSE concat('<tr><td>项目</td>', {cells(years, 'th')}, '</tr><tr><td></td>', {cells(f'''concat({month}, CASE WHEN k % 3 = 1 THEN '月' ELSE '' END)''')}, '</tr>') END")
    pages = stated(spark, sf_dir).selectExpr(
        "k", f"concat('<table><tr><td>货币供应量 Money Supply</td></tr>', {header}, '<tr><td>货币和准货币（M2）</td>', {cells(amount(0))}, '</tr><tr><td>货币（M1）</td><td>1</td></tr>',"
        f" '<tr><td>流通中现金（M0）</td>', {cells(amount(7))}, '</tr></table>') AS html")
    return rl.annual_stock(pages, STOCK, ["k"])
