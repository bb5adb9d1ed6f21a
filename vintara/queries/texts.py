"""Text and page jobs over ``pages`` and ``documents`` and over release bulletins.

A bulletin is an HTML page Spark writes from one vintage, so the facts it states are known
to the SQL twin without any parsing.
"""

from pyspark.sql import functions as F

from ..functions.texts import entities, title_of, typography
from ..operators import text as tx
from . import query
from .fixture import V, table, vintages


def plain_sql(html: str) -> str:
    out = f"regexp_replace({html}, '(?is)<(script|style)\\b.*?</(script|style)\\s*>|<!--.*?-->|<[^>]*>', ' ', 'g')"
    for entity, character in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"),
                              ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{character}')"
    return f"trim(regexp_replace({out}, '[\\s\\x{{00A0}}]+', ' ', 'g'))"


@query("txt_01_plain_text", f"SELECT page_id, {plain_sql('html')} AS text FROM pages")
def page_text(spark, sf_dir):
    return tx.with_text(table(spark, sf_dir, "pages", spread_by="page_id")).select("page_id", "text")


@query("txt_01_titles", f"""
    SELECT page_id, {plain_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title FROM pages""")
def titles(spark, sf_dir):
    return table(spark, sf_dir, "pages", spread_by="page_id").select("page_id", title_of(F.col("html")).alias("title"))


_MONTHS = "concat_ws('、', transform(sequence(1, m + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END), i -> concat(cast(4.5D + i * 0.5D AS string), '%')))"
_ROW = ("concat('<tr><td>', {name}, '</td><td>', {level}, '</td><td>', {yoy}, '</td><td>', {level}, '</td><td> ', {ytd}, ' </td></tr>')")


def bulletins(spark, sf_dir):
    """One release page per vintage: title, publication evidence, prose and tables."""
    facts = vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "year(period_end) + 10 AS y", "month(period_end) AS m", "quarter(period_end) AS q",
        "cast(ingest_seq % 7 + 1 AS double) / 2 AS v", "date_add(make_date(year(period_end) + 10, month(period_end), 1), 40) AS pub",
        "retrieved_at AS first_seen_at")
    parts = facts.selectExpr(
        "*",
        "CASE k % 6 WHEN 0 THEN concat(y, '年', m, '月份工业生产') WHEN 1 THEN concat(y, '年1-', m, '月份工业生产')"
        " WHEN 2 THEN concat(y, '年前', q, '季度运行情况') WHEN 3 THEN concat(y, ' 年上半年运行情况')"
        " WHEN 4 THEN concat(y, '年统计公报') ELSE '统计公报' END AS title",
        "CASE k % 5 WHEN 0 THEN CASE k % 3 WHEN 0 THEN concat('<meta name=\"PubDate\" content=\"', date_format(pub, 'yyyy-MM-dd'), ' 09:30:00\">')"
        "  WHEN 1 THEN concat('<META content=', char(39), date_format(pub, 'yyyy/M/d'), ' 09:30', char(39), ' data-x=1 name=', char(39), 'PubDate', char(39), '/>')"
        "  ELSE concat('<meta name=publishdate content=2001-01-01><meta property=\"publish-time\" content=\"', date_format(pub, 'yyyy-MM-dd'), ' 09:30\">') END"
        " WHEN 1 THEN concat('<meta name=\"PubDate\" content=\"', date_format(pub, 'yyyy-MM-dd'), '\">') ELSE '' END AS meta",
        "CASE k % 5 WHEN 2 THEN concat(CASE k % 3 WHEN 0 THEN '2001-02-03 04:05 ' ELSE '' END, '发布时间：', date_format(pub, 'yyyy年M月d日'), ' 09:30')"
        " WHEN 3 THEN concat('发布日期：', date_format(pub, 'yyyy/M/d')) ELSE '' END AS stamp",
        "concat(y, '年前', m, '个月，全国工业增加值', CASE WHEN k % 2 = 0 THEN '增长' ELSE '下降' END, v,"
        " CASE WHEN k % 3 = 0 THEN '％' ELSE '%' END, '，社会消费品零售总额增长1,', 100 + k % 800, '.5%；',"
        " CASE WHEN k % 4 = 0 THEN concat('采购经理指数为５', k % 10, '．５％。') ELSE '' END) AS prose",
        f"concat('1至', m % 12 + 1, '月份，全国城镇调查失业率分别为1%；1至', m, '月份，全国城镇调查失业率分别为', {_MONTHS}, '。') AS listed",
        "concat_ws('', array(concat(y, '年1-', m, '月全国财政收入增长9.5%。'),"
        " CASE WHEN k % 4 = 2 THEN concat('1-', m, '月税收收入增长', v, '%。') END,"
        " CASE WHEN k % 4 <> 3 THEN '税收收入当月增长0.5%；' END,"
        " CASE WHEN k % 4 = 0 THEN concat('税收收入当月增长0.5%，累计全国税收收入', repeat('（按可比口径）', 30), '下降', v, '%。') END)) AS fiscal",
        "CASE WHEN k % 4 = 3 THEN m % 12 + 1 ELSE m END AS hm",
        "CASE WHEN k % 7 = 0 THEN '' WHEN k % 13 = 0 THEN 'n/a' ELSE cast(v AS string) END AS yoy",
    )
    def one_table(yoy: str) -> str:
        return (
            "concat('<table>', repeat('<tr><td>说明</td></tr>', cast(k % 12 AS int)), '<tr><td>指标</td><td>', hm, '月份</td><td>1—', hm, '月份</td></tr>',"
            " '<tr><td>绝对量</td><td>同比增长（%）</td><td>绝对量</td><td>同比增长（%）</td></tr>', "
            + _ROW.format(name="'一、规模以上工业增加值'", level="'…'", yoy=yoy, ytd="cast(v + 1 AS string)") + ", "
            + _ROW.format(name="'固定资产投资（不含农户）（亿元）'", level="'100'", yoy="'7'", ytd="cast(v + 2 AS string)")
            + ", '</table>')")
    other = "CASE WHEN k % 10 = 0 THEN '99.5' ELSE yoy END"
    return parts.selectExpr(
        "k", "m", "pub", "v", "title", "first_seen_at",
        "concat('<html><head><title>', title, '</title>', meta, '</head><body><p>', stamp, '</p><p>', prose, '</p><p>', listed,"
        f" '</p><p>', fiscal, '</p>', {one_table('yoy')}, {one_table(other)}, '</body></html>') AS html")


def read_bulletins(spark, sf_dir):
    return tx.with_text(bulletins(spark, sf_dir))


FACTS = f"""{V}, facts AS (SELECT ingest_seq AS k, year(period_end) + 10 AS y, CAST(month(period_end) AS INTEGER) AS m,
    quarter(period_end) AS q, CAST(ingest_seq % 7 + 1 AS DOUBLE) / 2 AS v,
    CAST(make_date(year(period_end) + 10, month(period_end), 1) + 40 AS DATE) AS pub, retrieved_at AS first_seen_at FROM v)"""


@query("txt_02_release_evidence", f"""
    WITH {FACTS} SELECT k, CASE WHEN k % 5 IN (0, 2) THEN 'A' WHEN k % 5 IN (1, 3) THEN 'B' ELSE 'D' END AS pit_grade,
        CASE WHEN k % 5 IN (0, 2) THEN CAST(pub AS TIMESTAMP) + to_minutes(90) WHEN k % 5 IN (1, 3) THEN CAST(pub AS TIMESTAMP) - to_hours(8) END AS release_at,
        CASE WHEN k % 5 IN (0, 2) THEN CAST(pub AS TIMESTAMP) + to_minutes(90) WHEN k % 5 IN (1, 3) THEN CAST(pub AS TIMESTAMP) + to_hours(16)
             ELSE first_seen_at END AS available_at,
        CASE k % 5 WHEN 0 THEN 'official_page_metadata' WHEN 1 THEN 'official_page_metadata_date' WHEN 2 THEN 'official_page_timestamp'
             WHEN 3 THEN 'official_page_date' ELSE 'first_seen_only' END AS release_date_source FROM facts""")
def release_evidence(spark, sf_dir):
    return tx.with_release_evidence(read_bulletins(spark, sf_dir), "first_seen_at").select(
        "k", "pit_grade", "release_at", "available_at", "release_date_source")


@query("txt_03_publication_period", f"""
    WITH {FACTS} SELECT k, y || '-' || lpad(CAST(CASE k % 6 WHEN 2 THEN q * 3 WHEN 3 THEN 6 WHEN 4 THEN 12 ELSE m END AS VARCHAR), 2, '0') AS period FROM facts""")
def publication_period(spark, sf_dir):
    return tx.with_publication_period(read_bulletins(spark, sf_dir)).select("k", "period")


@query("txt_03_title_period", f"""
    WITH {FACTS} SELECT k, CASE k % 8 WHEN 7 THEN NULL ELSE y || '-' || lpad(CAST(CASE k % 8 WHEN 3 THEN 12 WHEN 4 THEN q * 3 ELSE m END AS VARCHAR), 2, '0') END AS period FROM facts""")
def title_period(spark, sf_dir):
    names = "array('January','february','Mar.','Apr','May','June','jul','August','Sept.','Oct','November','dec')"
    titles_ = bulletins(spark, sf_dir).selectExpr("k", "m", "year(date_sub(pub, 40)) AS y", "quarter(date_sub(pub, 40)) AS q").selectExpr(
        "k", "CASE k % 8 WHEN 0 THEN concat(y, '年', m, '月份（', y, '年二季度）') WHEN 1 THEN concat(y, '年1-', m, '月与', y, '年上半年')"
        f" WHEN 2 THEN concat('Report, ', {names}[m - 1], ', ', y) WHEN 3 THEN concat(y, '年公报') WHEN 4 THEN concat(y, '年前', q, '季度')"
        " WHEN 5 THEN concat('No. ', m, ' . ', y) WHEN 6 THEN concat(y, ' 年 ', m, ' 月') ELSE concat('septober ', y, ' 13.', y) END AS title")
    return tx.with_title_period(titles_).select("k", "period")


RULES = [
    tx.MetricRule("IVA", r"工业增加值(增长|下降)([\d.,]+)%"),
    tx.MetricRule("RETAIL", r"零售总额(增长|下降)([\d.,]+)%", 0.5),
    tx.MetricRule("PMI", r"采购经理指数(为)([\d.]+)%"),
]
METRICS = """metrics AS (SELECT k, 'IVA' AS metric, CASE WHEN k % 2 = 0 THEN v ELSE -v END AS value FROM facts
    UNION ALL SELECT k, 'RETAIL', (1100.5 + k % 800)::DOUBLE * 0.5 FROM facts
    UNION ALL SELECT k, 'PMI', (50.5 + k % 10)::DOUBLE FROM facts WHERE k % 4 = 0)"""


def metrics(spark, sf_dir):
    return tx.extract_metrics(read_bulletins(spark, sf_dir), RULES, ["k"])


@query("txt_04_metric_rules", f"WITH {FACTS}, {METRICS} SELECT k, metric, value FROM metrics")
def metric_rules(spark, sf_dir):
    return metrics(spark, sf_dir)


@query("txt_05_preferred_occurrence", f"""
    WITH {FACTS} SELECT k, k % 2 = 0 AS cumulative, CASE k % 4 WHEN 0 THEN -v WHEN 1 THEN 0.5 ELSE v END AS value
    FROM facts WHERE k % 4 <> 3""")
def preferred_occurrence(spark, sf_dir):
    return tx.preferred_occurrence(read_bulletins(spark, sf_dir), ["全国税收收入", "税收收入"], ["k"], month="m").select(
        "k", "cumulative", "value")


@query("txt_06_typography", "SELECT doc_id, text || '1m2fi5:a(株)カ' AS text FROM documents")
def typography_job(spark, sf_dir):
    wide = F.concat(F.translate("text", "0123456789%,abcXYZ", "０１２３４５６７８９％，ａｂｃＸＹＺ"), F.lit("①㎡ﬁ５：ａ㈱ｶ"))
    return table(spark, sf_dir, "documents", spread_by="doc_id").select("doc_id", typography(wide).alias("text"))


@query("txt_06_entities", """
    SELECT page_id, 'p' || page_id || chr(160) || '<é—Ω' || chr(CAST(20000 + page_id % 1000 AS INTEGER)) || 'A&nope; &#0;' AS text FROM pages""")
def entities_job(spark, sf_dir):
    return table(spark, sf_dir, "pages", spread_by="page_id").select("page_id", entities(F.concat(
        F.lit("p"), F.col("page_id"), F.lit("&nbsp;&lt;&eacute;&mdash;&Omega;&#"), 20000 + F.col("page_id") % 1000,
        F.lit(";&#x41;&nope; &#0;"))).alias("text"))


LABELS = {"规模以上工业增加值": ("CN_INDUSTRIAL", 2), "固定资产投资(不含农户)": ("CN_FAI_YTD", 4)}


@query("txt_07_table_cells", f"""
    WITH {FACTS} SELECT k, 'CN_INDUSTRIAL' AS metric,
        CASE WHEN k % 10 = 0 THEN 99.5 WHEN k % 7 = 0 OR k % 13 = 0 THEN NULL ELSE v END AS value,
        CASE WHEN k % 7 <> 0 AND k % 13 = 0 THEN 'unexpected_cell' WHEN k % 10 = 0 THEN 'conflicting_tables' END AS problem FROM facts WHERE k % 4 <> 3
    UNION ALL SELECT k, 'CN_FAI_YTD', v + 2, NULL FROM facts WHERE k % 4 <> 3""")
def table_cells(spark, sf_dir):
    return tx.table_metrics(bulletins(spark, sf_dir), LABELS, ["k"], month="m")


@query("txt_08_enumerated_months", f"""
    WITH {FACTS} SELECT k, NULL AS problem, CAST(i AS INTEGER) AS month, (4.5 + i * 0.5)::DOUBLE AS value FROM facts, range(1, 13) r(i) WHERE i <= m AND k % 9 <> 0
    UNION ALL SELECT k, 'months_and_values_differ', NULL, NULL FROM facts WHERE k % 9 = 0""")
def enumerated_months(spark, sf_dir):
    return tx.enumerated_months(read_bulletins(spark, sf_dir), ["k"], month="m")


@query("txt_09_incomplete_documents", f"""
    WITH {FACTS} SELECT k, CASE WHEN k % 11 = 0 THEN 'IVA,PMI,RETAIL' ELSE 'PMI' END AS missing FROM facts WHERE k % 4 <> 0 OR k % 11 = 0""")
def incomplete_documents(spark, sf_dir):
    # every eleventh release has not been parsed into anything
    found = metrics(spark, sf_dir).where("k % 11 <> 0")
    return tx.incomplete_documents(bulletins(spark, sf_dir), found, ["IVA", "RETAIL", "PMI"], ["k"])


# Fixed cases of relative addresses: what is written on a page, and what it means there.
_HREFS = {"../../../x.html": "/x.html", "../x.html": "/a/x.html", "x/../y": "/a/b/y", "./z": "/a/b/z", "?p=2": "/a/b/i.html?p=2", "#top": "/a/b/i.html?q=1#top",
          "": "/a/b/i.html?q=1", "/r/./s": "/r/s", "..": "/a/", "sub/": "/a/b/sub/", "t?u=../v": "/a/b/t?u=../v", "../../..": "/"}


@query("txt_10_relative_addresses", "SELECT page_id, h AS href, 'https://h' || page_id || '.org' || l AS link FROM pages, (VALUES "
       + ", ".join(f"('{h}', '{link}')" for h, link in _HREFS.items()) + ") t(h, l)")
def relative_addresses(spark, sf_dir):
    base = F.concat(F.lit("https://h"), F.col("page_id"), F.lit(".org/a/b/i.html?q=1"))
    rows = table(spark, sf_dir, "pages", ["page_id"]).select("page_id", F.explode(F.array(*map(F.lit, _HREFS))).alias("href"))
    return rows.select("page_id", "href", tx.absolute_url(base, F.col("href")).alias("link"))


LINK_RULE = tx.LinkRule("index", ("the", "der", "que", "and", "con"), ("theand",), r"(^|\.)example\.(com|org)$", force_https=True)


@query("txt_10_link_discovery", f"""
    WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href=.*?</a>')) AS a,
                      generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*href=.*?</a>'), 1) AS position FROM pages),
    l AS (SELECT page_id, position, {plain_sql('a')} AS title,
                 regexp_replace(regexp_extract(url, '^(https?://[^/?#]+)', 1) || regexp_extract(a, 'href="([^"]*)"', 1), '^http://', 'https://') AS link FROM a)
    SELECT link, title, NULL::VARCHAR AS period, 'index' AS kind, page_id FROM l
    WHERE regexp_matches(title, 'the|der|que|and|con') AND NOT contains(title, 'theand')
      AND regexp_matches(regexp_extract(link, '^https?://([^/:?#]+)', 1), '(^|\\.)example\\.(com|org)$')
    QUALIFY row_number() OVER (PARTITION BY link ORDER BY page_id DESC, position DESC) = 1""")
def link_discovery(spark, sf_dir):
    return tx.discover(tx.links(table(spark, sf_dir, "pages", spread_by="page_id")), LINK_RULE)


def payloads(spark, sf_dir):
    """Search responses: two result documents per vintage, some on other hosts, some with a plain title only, some failed."""
    named = vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "period_start",
        "CASE WHEN ingest_seq % 5 = 0 THEN 'other.example.com' ELSE 'stats.example.com' END AS host",
        "concat('<em>', CASE WHEN ingest_seq % 2 = 0 THEN concat(year(period_end) + 10, '年') ELSE '' END, month(period_end), '月份</em>  价格') AS name")
    return named.selectExpr(
        "k", "to_json(named_struct('ok', k % 12 <> 0, 'resultDocs', array("
        " named_struct('data', named_struct('url', concat('http://', host, '/sj/zxfb/', k % 3000, '.html?a=1'),"
        "  'titleO', CASE WHEN k % 7 = 0 THEN '' ELSE name END, 'title', CASE WHEN k % 7 = 0 THEN name ELSE 'x' END,"
        "  'docDate', date_format(add_months(period_start, 121), 'yyyy-MM-dd'))),"
        " named_struct('data', named_struct('url', concat('http://stats.example.com/about/', k), 'titleO', '说明', 'title', '', 'docDate', '2010-01-01'))))) AS payload")


@query("txt_11_search_candidates", f"""
    WITH {V}, d AS (SELECT ingest_seq AS k, year(period_end) + 10 AS y, month(period_end) AS m, CAST(period_start + INTERVAL 121 MONTH AS DATE) AS published FROM v),
    u AS (SELECT *, 'https://stats.example.com/sj/zxfb/' || (k % 3000) || '.html' AS link,
                 CASE WHEN k % 2 = 0 THEN y || '年' ELSE '' END || m || '月份 价格' AS title,
                 CASE WHEN k % 2 = 0 THEN y ELSE year(published) - CASE WHEN m > month(published) THEN 1 ELSE 0 END END
                 || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS period FROM d WHERE k % 12 <> 0 AND k % 5 <> 0)
    SELECT k, NULL AS problem, link, title, period FROM u QUALIFY row_number() OVER (PARTITION BY link ORDER BY k DESC) = 1
    UNION ALL SELECT k, 'bad_response', NULL, NULL, NULL FROM d WHERE k % 12 = 0""")
def search_candidates(spark, sf_dir):
    return tx.search_candidates(payloads(spark, sf_dir), ["k"], ["stats.example.com"], r"^/sj/zxfb/\d+\.html$", "stats.example.com")


@query("txt_11_page_fingerprint", f"""
    WITH {V}, d AS (SELECT 'http://' || CASE WHEN ingest_seq % 5 = 0 THEN 'other.example.com' ELSE 'stats.example.com' END || '/sj/zxfb/' || (ingest_seq % 3000)
                        || '.html?a=1|' || strftime(CAST(period_start + INTERVAL 121 MONTH AS DATE), '%Y-%m-%d') AS a,
                        'http://stats.example.com/about/' || ingest_seq || '|2010-01-01' AS b FROM v)
    SELECT sha256(least(a, b) || chr(10) || greatest(a, b)) AS fingerprint, count(*) AS pages FROM d GROUP BY 1""")
def page_fingerprint(spark, sf_dir):
    return payloads(spark, sf_dir).select(tx.page_fingerprint(F.col("payload")).alias("fingerprint")).groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("pages"))


_NEEDLES = ["source", "CASE lang WHEN 'en' THEN 'There' WHEN 'fr' THEN 'eaux' ELSE 'chen' END", "'e'", "'en'"]


def evidence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread_by="doc_id").selectExpr(
        "doc_id", "source", "text", *[f"{n} AS n{i}" for i, n in enumerate(_NEEDLES)])
    return tx.excerpts(docs, ["n0", "n1", "n2", "n3"], 240, "source")


def _excerpt_sql():
    tests = ", ".join(f"CASE WHEN length(trim({n})) >= 2 THEN nullif(strpos(lower(text), lower({n})), 0) - 1 END" for n in _NEEDLES)
    return f"""c AS (SELECT *, coalesce({tests}, 0) AS center FROM documents),
        e AS (SELECT *, least(length(text), greatest(0, center - 80) + 240) AS stop FROM c),
        x AS (SELECT doc_id, source, substr(text, CAST(greatest(0, stop - 240) AS BIGINT) + 1, CAST(stop - greatest(0, stop - 240) AS BIGINT)) AS excerpt FROM e),
        ev AS (SELECT *, CASE WHEN excerpt <> '' THEN 'evidence_' || substr(sha256(source || chr(0) || excerpt), 1, 20) END AS evidence_id FROM x)"""


@query("txt_12_evidence_excerpts", f"WITH {_excerpt_sql()} SELECT doc_id, excerpt, evidence_id FROM ev")
def evidence_excerpts(spark, sf_dir):
    return evidence(spark, sf_dir).select("doc_id", "excerpt", "evidence_id")


@query("txt_12_distinct_evidence", f"""
    WITH {_excerpt_sql()} SELECT evidence_id, min(doc_id) AS doc_id FROM ev WHERE evidence_id IS NOT NULL GROUP BY evidence_id""")
def distinct_evidence(spark, sf_dir):
    return tx.distinct_evidence(evidence(spark, sf_dir), ["doc_id"]).select("evidence_id", "doc_id")


_STATEMENT = r"(20\d{2})年(\d{1,2})月份，?(?:全国)?居民消费价格同比(上涨|下降)([\d.]+)%"


def _stated(column: str, name: str):
    value = F.regexp_extract(column, _STATEMENT, 4).try_cast("double")
    value = F.when(F.regexp_extract(column, _STATEMENT, 3) == "下降", -value).otherwise(value)
    period = F.concat(F.regexp_extract(column, _STATEMENT, 1), F.lit("-"), F.lpad(F.regexp_extract(column, _STATEMENT, 2), 2, "0"))
    return [value.alias(f"{name}_value"), period.alias(f"{name}_period")]


@query("txt_13_cross_check", f"""
    WITH {FACTS} SELECT k, CASE WHEN k % 2 = 0 THEN v ELSE -v END AS title_value, CASE WHEN k % 17 = 0 OR k % 19 = 0 THEN 'no_unique_search_record'
        WHEN k % 13 = 0 THEN 'time_disagrees' WHEN k % 11 = 0 THEN 'body_disagrees' ELSE 'ok' END AS verdict FROM facts""")
def cross_check(spark, sf_dir):
    b = bulletins(spark, sf_dir).selectExpr("k", "v", "pub", "year(add_months(pub, -1)) AS y", "m", "year(date_sub(pub, 40)) AS yy")
    word = "CASE WHEN k % 2 = 0 THEN '上涨' ELSE '下降' END"
    articles = b.selectExpr(
        "k", "pub AS published", f"concat(yy, '年', m, '月份居民消费价格同比', {word}, v, '%') AS headline",
        f"concat(yy, '年', m, '月份，全国居民消费价格同比', {word}, CASE WHEN k % 11 = 0 THEN v + 1 ELSE v END, '%。其中……') AS body",
    ).select("k", "published", *_stated("headline", "title"), *_stated("body", "body"))
    searches = b.selectExpr(
        "k", "explode(array_repeat(1, CASE WHEN k % 17 = 0 THEN 0 WHEN k % 19 = 0 THEN 2 ELSE 1 END)) AS copy",
        f"CASE WHEN {word} = '上涨' THEN v ELSE -v END AS value", "concat(yy, '-', lpad(cast(m AS string), 2, '0')) AS period",
        "CASE WHEN k % 13 = 0 THEN date_add(pub, 1) ELSE pub END AS published")
    return tx.cross_checked(articles, searches, "k").select("k", "title_value", "verdict")


def consolidated(spark, sf_dir):
    """Cumulative tables: four months with a pair of cells each."""
    return vintages(spark, sf_dir, spread=True).selectExpr(
        "ingest_seq AS k", "transform(sequence(0, 3), i -> date_format(add_months(period_start, i), 'yyyy-MM')) AS months",
        "cast(ingest_seq % 9 AS double) AS v").selectExpr(
        "k", "concat('<table><tr><td>项目</td><td>', concat_ws('</td><td>', months), '</td></tr><tr><td>银行结汇</td>',"
        " concat_ws('', transform(sequence(0, 3), i -> concat('<td>1,00', cast(v + i AS string), '</td><td>', cast(v * 7 AS string), '</td>'))),"
        " '</tr><tr><td>其他</td><td>1</td></tr></table>') AS html")


@query("txt_14_consolidated_table", f"""
    WITH {V} SELECT ingest_seq AS k, 'CN_FX_SETTLEMENT' AS metric, strftime(CAST(period_start + to_months(CAST(i AS INTEGER)) AS DATE), '%Y-%m') AS period,
        CAST('100' || CAST(CAST(ingest_seq % 9 + i AS DOUBLE) AS VARCHAR) AS DOUBLE) AS value, 'C' AS pit_grade FROM v, range(4) r(i)""")
def consolidated_table(spark, sf_dir):
    return tx.consolidated_months(consolidated(spark, sf_dir), {"银行结汇": "CN_FX_SETTLEMENT"}, ["k"])


