"""Release pages whose layout has to be read: tables with spans, clauses with a scope, labelled rows, reprints.

Everything is a fold or a transform over arrays of one page, in the JVM; a page is read where it lies and pages never meet, except that the
statements about one key are compared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.instants import evaluated
from ..functions.texts import cast_found, compact, let, plain_text, spaced, typography, until
from .text import absolute_url

WIDEST = 200  # columns of a table, and of one cell

_CELL = "struct<text:string,across:int,down:int>"


def bare(text: Column) -> Column:
    """Without white space, dashes as ``-``."""
    return F.translate(F.regexp_replace(text, r"\s+", ""), "—–－", "---")


def _cells(row: Column) -> Column:
    def span(attributes: Column, name: str) -> Column:
        said = cast_found(F.regexp_extract(attributes, rf"(?i)\b{name}\s*=\s*[\"']?(\d+)", 1), "int")
        return F.when(attributes == "", F.lit(1)).otherwise(F.greatest(F.lit(1), F.least(F.coalesce(said, F.lit(1)), F.lit(WIDEST))))

    return F.transform(_marked(row), lambda c: let(F.regexp_extract(c, r"(?is)^<t[dh]\b([^>]*)>", 1), lambda a: F.struct(
        _content(c).alias("text"), span(a, "colspan").alias("across"), span(a, "rowspan").alias("down"))))


def _marked(row: Column) -> Column:
    """Cells of a row, each with the tag that opens it."""
    return F.regexp_extract_all(row, F.lit(rf"(?is)<t[dh]\b[^>]*>{until(r't[dh]\b|/t[dh]>|/tr>')}"), F.lit(0))


def _content(cell: Column) -> Column:
    return spaced(F.substring(cell, F.instr(cell, F.lit(">")) + 1, F.length(cell)))


def _placed(open_: Column, cells: Column) -> Column:
    """One row of the grid, (text, down) by column: cells of rows above that reach down to here come first, the row's own cells
    fill the columns left. Where nothing reaches down and no cell is wider than a column, the cells are the columns."""
    return F.when(F.exists(open_, lambda c: c["down"] > 1) | F.exists(cells, lambda c: c["across"] > 1), _folded(open_, cells)).otherwise(
        F.transform(F.slice(cells, 1, WIDEST), lambda c: F.struct(c["text"].alias("text"), c["down"].alias("down"))))


def _folded(open_: Column, cells: Column) -> Column:
    state = F.struct(F.lit(1).alias("next"), F.lit(0).alias("more"), F.array().cast("array<struct<text:string,down:int>>").alias("out"))
    width = F.aggregate(cells, F.lit(0), lambda n, c: n + c["across"]) + F.size(open_)

    def step(s: Column, column: Column) -> Column:
        above = F.get(open_, column - 1)
        covered = F.coalesce(above["down"] > 1, F.lit(False))
        own = F.get(cells, s["next"] - 1)
        again = F.get(cells, s["next"] - 2)
        put = lambda text, down: F.concat(s["out"], F.array(F.struct(text.alias("text"), down.cast("int").alias("down"))))
        return (F.when(covered, F.struct(s["next"].alias("next"), s["more"].alias("more"), put(above["text"], above["down"] - 1).alias("out")))
                .when(s["more"] > 0, F.struct(s["next"].alias("next"), (s["more"] - 1).alias("more"), put(again["text"], again["down"]).alias("out")))
                .when(own.isNotNull(), F.struct((s["next"] + 1).alias("next"), (own["across"] - 1).alias("more"), put(own["text"], own["down"]).alias("out")))
                .otherwise(F.struct(s["next"].alias("next"), s["more"].alias("more"), s["out"].alias("out"))))

    return F.aggregate(F.when(width > 0, F.sequence(F.lit(1), F.least(width, F.lit(WIDEST)))).otherwise(F.array().cast("array<int>")),
                       state, step, lambda s: s["out"])


def table_grids(html: Column) -> Column:
    """tables -> rows -> columns: the text that covers each place, cells that span several repeated in all of them."""
    def grid(table: Column) -> Column:
        rows = F.regexp_extract_all(table, F.lit(rf"(?is)<tr\b{until(r'tr\b|/tr>|/table>')}"), F.lit(0))
        # without spans every cell is a column
        return F.when(F.regexp_like(table, F.lit("(?i)span")), spread(F.transform(rows, _cells))).otherwise(
            F.transform(rows, lambda r: F.transform(F.slice(_marked(r), 1, WIDEST), _content)))

    def spread(rows: Column) -> Column:
        empty = "struct<above:array<struct<text:string,down:int>>,out:array<array<string>>>"
        start = F.struct(F.array().cast("array<struct<text:string,down:int>>").alias("above"), F.array().cast("array<array<string>>").alias("out")).cast(empty)

        def step(s: Column, row: Column) -> Column:
            # the placed row is a one-element array, so that it is evaluated once
            return F.element_at(F.transform(F.array(_placed(s["above"], row)), lambda p: F.struct(
                p.alias("above"), F.concat(s["out"], F.array(F.transform(p, lambda c: c["text"]))).alias("out"))), 1)

        return F.aggregate(rows, start, step, lambda s: s["out"])

    return F.transform(F.regexp_extract_all(html, F.lit(rf"(?is)<table\b{until('/table>')}</table>"), F.lit(0)), grid)


# What a first release of gross domestic product calls itself, its columns and its periods.
INITIAL, GDP_TITLE, GDP_NAMES = "初步核算", "(?i)GDP|国内生产总值", ("GDP", "国内生产总值")
AMOUNTS = ("绝对额(亿元)", "现价总量(亿元)")
GROWTH = ("比上年同期增长(%)", "比去年同期增长(%)")
QUARTERLY_HEADER = ("", "GDP环比增长速度(%)", "GDP同比增长速度(%)")
NUMERALS = "一二三四"
CUMULATIVE = ("", "上半年", "前三季度", "全年")
BODY = r"""(?is)class\s*=\s*["'][^"']*\btxt-content\b"""


def _numeral(character: Column) -> Column:
    return let(character, lambda c: F.when(F.regexp_like(c, F.lit("^[0-9]+$")), c.try_cast("int")).otherwise(
        F.nullif(F.instr(F.lit(NUMERALS), c), F.lit(0))))


def _one(values: Column) -> Column:
    """The value that all agree on, null if there is none or they differ."""
    return let(F.array_distinct(values), lambda distinct: F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0))))


def _spread(row: Column, width: Column) -> Column:
    """A header row over ``width`` value columns: as it is, or each cell over the same number of columns; null if neither fits."""
    def over(cells: Column) -> Column:
        fits = F.when((F.size(cells) > 0) & (width % F.greatest(F.size(cells), F.lit(1)) == 0), (width / F.size(cells)).cast("int"))
        return let(fits, lambda each: F.when(each.isNotNull(), F.flatten(F.transform(cells, lambda c: F.array_repeat(c, F.coalesce(each, F.lit(1)))))))

    return let(row, lambda r: let(F.when(F.get(r, F.lit(0)) == "", F.slice(r, 2, F.greatest(F.size(r), F.lit(1)))).otherwise(r), over))


def _headed_growth(rows: Column, quarter: Column) -> Column:
    """Growth of the single quarter in one table: cells of the named row whose headers say growth, and this quarter alone."""
    single = F.array(F.concat(quarter.cast("string"), F.lit("季度")), F.concat(F.substring(F.lit(NUMERALS), 1, 4).substr(quarter, F.lit(1)), F.lit("季度")))
    until = F.array(F.concat(F.lit("1-"), quarter.cast("string"), F.lit("季度")), F.get(F.array(*map(F.lit, CUMULATIVE)), quarter - 1))

    def values(i: Column) -> Column:
        """From the data row at place ``i`` and one or two header rows over it."""
        header = lambda n, width: F.when(i >= n, _spread(F.get(rows, i - n), width))
        return let(F.get(rows, i), lambda data: let(F.size(data) - 1, lambda width: let(header(1, width), lambda near: let(
            header(2, width), lambda far: chosen_cells(i, data, width, near, far)))))

    def chosen_cells(i: Column, data: Column, width: Column, near: Column, far: Column) -> Column:
        measured = lambda h: (F.get(F.get(rows, i - F.when(h, F.lit(1)).otherwise(F.lit(2))), F.lit(0)) == "")
        says = lambda header, place, wanted: F.coalesce(F.get(header, place).isin(*wanted), F.lit(False))
        places = F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0)))
        # periods alternate: the quarter, the year so far
        paired = F.coalesce(F.when(quarter == 1, F.forall(near, lambda p: F.array_contains(single, p))).otherwise(
            F.forall(F.filter(places, lambda c: c % 2 == 1), lambda c: F.array_contains(until, F.get(near, c))) & (F.size(near) % 2 == 0)), F.lit(False))
        two = F.filter(places, lambda c: says(far, c, GROWTH) & F.coalesce(F.array_contains(single, F.get(near, c)), F.lit(False)))
        one = F.filter(places, lambda c: says(near, c, GROWTH))
        chosen = F.when(says(far, F.lit(0), AMOUNTS) & paired & measured(F.lit(False)), two).when(
            says(near, F.lit(0), AMOUNTS) & (quarter == 1) & measured(F.lit(True)), one)
        cells = F.transform(chosen, lambda c: cast_found(F.get(data, c + 1), "double"))
        return let(cells, lambda found: F.when(F.size(found) == 1, found))

    at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(rows) - 1, F.lit(0))), lambda i: F.coalesce(
        F.get(F.get(rows, i), F.lit(0)).isin(*GDP_NAMES), F.lit(False)))
    return F.flatten(F.filter(F.transform(at, values), lambda v: v.isNotNull()))


def _listed_growth(spaced: Column, year: Column, quarter: Column) -> Column:
    """Growth of the quarter from a table that lists quarters downwards, also several in one cell: (value) or nothing."""
    header = F.array(*map(F.lit, QUARTERLY_HEADER))
    at = let(F.transform(spaced, lambda r: F.transform(r, bare)), lambda rows: F.array_min(F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(rows) - 1, F.lit(0))), lambda i: F.get(rows, i) == header)))
    below = F.filter(F.slice(spaced, F.coalesce(at, F.size(spaced)) + 2, F.greatest(F.size(spaced), F.lit(1))), lambda r: F.size(r) == 3)
    label = r"(?:(20\d\d)年)?([1-4])季度"
    numbers = lambda c: F.regexp_extract_all(c, F.lit(r"-?\d+(?:\.\d+)?"), F.lit(0))

    def entries(row: Column) -> Column:
        return let(bare(F.get(row, F.lit(0))), lambda name: let(
            F.regexp_extract_all(name, F.lit(label), F.lit(0)), lambda labels: listed(row, name, labels)))

    def listed(row: Column, name: Column, labels: Column) -> Column:
        sound = (F.array_join(labels, "") == name) & (F.size(numbers(F.get(row, F.lit(1)))) == F.size(labels)) & (
            F.size(numbers(F.get(row, F.lit(2)))) == F.size(labels))
        return F.when(F.size(labels) == 0, F.array().cast("array<struct<label:string,value:double>>")).when(
            sound, F.transform(F.arrays_zip(labels.alias("label"), numbers(F.get(row, F.lit(2))).alias("value")),
                               lambda e: F.struct(e["label"].alias("label"), e["value"].try_cast("double").alias("value"))))

    start = F.struct(F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("last"), F.lit(True).alias("sound"),
                     F.lit(None).cast("double").alias("value"))

    def step(s: Column, e: Column) -> Column:
        own = F.coalesce(cast_found(F.regexp_extract(e["label"], label, 1), "int"), s["year"])
        place = lambda year: year * 4 + cast_found(F.regexp_extract(e["label"], label, 2), "int")
        return let(own, lambda o: let(place(o), lambda p: F.struct(
            o.alias("year"), p.alias("last"), (s["sound"] & p.isNotNull() & (s["last"].isNull() | (p == s["last"] + 1))).alias("sound"),
            e["value"].alias("value"))))

    # one quarter after the other, and the last one is the release's own
    return let(F.transform(below, entries), lambda parts: F.aggregate(F.flatten(parts), start, step, lambda s: F.when(
        s["sound"] & (s["last"] == year * 4 + quarter) & F.coalesce(~F.exists(parts, lambda p: p.isNull()), F.lit(False)),
        F.array(s["value"])).otherwise(F.array().cast("array<double>"))))


def gdp_tables(pages: DataFrame, keys: list[str], html: str = "html", title: str = "title") -> DataFrame:
    """Growth of one quarter over the year before, from first releases: period, value, problem.

    The title names the quarter, and then the table's headers must lead to a growth column of that quarter alone; or it names the year so
    far, and then a table must list quarters up to this one without a gap. Header cells are placed by their spans; where none are stated, they
    share the value columns evenly. Tables that disagree, and pages without one article body, have a ``problem``.
    """
    name = bare(typography(F.coalesce(F.col(title), F.lit(""))))
    read = evaluated(pages.select(*keys, name.alias("_title"), F.col(html).alias("_html"), F.size(F.regexp_extract_all(
        html, F.lit(BODY), F.lit(0))).alias("_bodies")))
    alone, so_far = r"(20\d\d)年([一二三四1-4])季度", r"(20\d\d)年(?:1-([2-4])季度|(上半年))"
    year = F.coalesce(cast_found(F.regexp_extract("_title", alone, 1), "int"), cast_found(F.regexp_extract("_title", so_far, 1), "int"))
    named = F.regexp_extract("_title", alone, 2)
    later = F.coalesce(cast_found(F.regexp_extract("_title", so_far, 2), "int"), F.when(F.regexp_extract("_title", so_far, 3) != "", F.lit(2)))
    body = F.element_at(F.split("_html", BODY, 2), -1)
    read = evaluated(read.select(*keys, "_title", "_bodies", year.alias("_year"), (named != "").alias("_alone"), F.coalesce(
        _numeral(F.nullif(named, F.lit(""))), later).alias("_quarter"), table_grids(body).alias("_grids")))
    read = evaluated(read.withColumn("_bare", F.transform("_grids", lambda t: F.transform(t, lambda r: F.transform(r, bare)))))
    found = F.when(F.col("_alone"), F.flatten(F.transform("_bare", lambda t: _headed_growth(t, F.col("_quarter"))))).otherwise(
        F.flatten(F.transform("_grids", lambda t: _listed_growth(t, F.col("_year"), F.col("_quarter")))))
    problem = (F.when(~F.col("_title").contains(INITIAL) | (F.col("_alone") & ~F.regexp_like("_title", F.lit(GDP_TITLE))), F.lit("not_an_initial_release"))
               .when(F.col("_quarter").isNull(), F.lit("no_supported_title")).when(F.col("_bodies") != 1, F.lit("no_unique_body")))
    judged = evaluated(read.select(*keys, "_year", "_quarter", problem.alias("_problem"), _one(found).alias("_value")))
    problem = F.coalesce("_problem", F.when(F.col("_value").isNull(), F.lit("no_agreed_growth_column")))
    return judged.select(*keys, F.when(problem.isNull(), F.concat("_year", F.lit("-Q"), "_quarter")).alias("period"),
                         F.when(problem.isNull(), F.col("_value")).alias("value"), problem.alias("problem"))


# Titles of early monthly releases, what their lead paragraph is about, and the words between a month and its rate.
ACTIVITY_INDUSTRY = r"(?:全国|我国)(?:完成|实现)?工业(?:生产(?!者)|增加值|实现增加值)"
ACTIVITY_RETAIL = "社会消费品零售总额"
COMMENTARY = "国民经济|经济运行|答记者问|解读"
POPULATION = r"全部国有工业企业(?:及|和)年产品销售收入500万元以上的非国有工业企业|全国规模以上工业(?:企业)?"
OVER_THE_YEAR = r"同比|比(?:去|上)年同(?:月|期)"
ACTIVITY_YEARS = (2000, 2010)
ACTIVITY_METRICS = {True: "CN_INDUSTRIAL_VALUE_ADDED_YOY", False: "CN_RETAIL_SALES_YOY"}


def scoped_statements(lead: Column, industry: Column, shortened: Column) -> Column:
    """Rates of single months in a lead paragraph, (month, value) in order.

    The paragraph is a chain of clauses. A clause that begins with one month opens its scope; a span of months, a quarter, another
    subject or a correction closes it. A rate belongs to the open month if the scope is about the measure, and closes it: what follows is not
    about the whole month any more. The comparison with the year before is said once and then holds for the clauses after it.
    ``shortened`` allows a measure without its last character.
    """
    month, rate = r"^(?:其中)?(1[0-2]|[1-9])月份?(?:当月)?", r"(增长|下降)(\d+(?:\.\d+)?)%$"
    amount = r"[\d,.]+亿元?"
    measure = F.when(industry, F.when(shortened, F.lit("增加值?")).otherwise(F.lit("增加值"))).otherwise(F.lit(ACTIVITY_RETAIL))
    known = [POPULATION, "完成|实现", "工业(?=增加)", "全国(?=社会)", OVER_THE_YEAR, amount]
    # thousands separators are no ends of clauses
    clauses = F.filter(F.split(F.regexp_replace(F.regexp_replace(lead, r"其中[,，]", "其中"), r"(?<!\d),|,(?!\d{3}(?!\d))", "，"), "[，。；;]"), lambda c: c != "")
    start = F.struct(F.lit(None).cast("int").alias("month"), F.lit(False).alias("measured"), F.lit(False).alias("yearly"),
                     F.array().cast("array<struct<month:int,value:double>>").alias("out"))

    def step(s: Column, clause: Column) -> Column:
        return let(cast_found(F.regexp_extract(clause, month, 1), "int"), lambda opens: let(F.regexp_like(clause, measure), lambda says: let(
            cast_found(F.regexp_extract(clause, rate, 2), "double") * F.when(F.regexp_extract(clause, rate, 1) == "下降", -1).otherwise(1),
            lambda value: let(still_open(s, clause, opens), lambda open_: followed(s, clause, opens, says, value, open_)))))

    def still_open(s: Column, clause: Column, opens: Column) -> Column:
        rest = F.regexp_replace(F.regexp_replace(clause, month, ""), rate, "")
        for words in known:
            rest = F.regexp_replace(rest, words, "")
        foreign = F.regexp_replace(rest, measure, "") != ""
        return F.when(~foreign, F.coalesce(opens, s["month"]))

    def followed(s: Column, clause: Column, opens: Column, says: Column, value: Column, open_: Column) -> Column:
        # industry names its measure for every month, retail sales once
        measured = says | (s["measured"] & ~(industry & opens.isNotNull()))
        yearly = s["yearly"] | F.regexp_like(clause, F.lit(f"(?:{OVER_THE_YEAR})(?:增长|下降)"))
        stated = open_.isNotNull() & measured & yearly & value.isNotNull()
        out = F.when(stated, F.concat(s["out"], F.array(F.struct(open_.alias("month"), value.alias("value"))))).otherwise(s["out"])
        return F.struct(F.when(value.isNull(), open_).alias("month"), measured.alias("measured"), yearly.alias("yearly"), out.alias("out"))

    return F.aggregate(clauses, start, step, lambda s: s["out"])


def legacy_activity(pages: DataFrame, keys: list[str], html: str = "html", title: str = "title", published: str = "published") -> DataFrame:
    """Monthly rates that early releases state in their lead paragraph: metric, period, value, problem.

    Only releases about industry or retail sales of the years ``ACTIVITY_YEARS`` are read; rates of a year so far are never taken for a
    month's. A page without a lead paragraph, with another population, without a monthly statement, with one after its own
    period or with two rates for a month has one row with ``problem``.
    """
    name = F.regexp_replace(F.coalesce(F.col(title), F.lit("")), r"\s+", "")
    month = F.coalesce(cast_found(F.regexp_extract("_title", r"(?:1[-—–至])?(1[0-2]|[1-9])月份?", 1), "int"),
                       F.when(F.col("_title").contains("一季度"), 3).when(F.col("_title").contains("上半年"), 6))
    body = F.element_at(F.split(html, BODY, 2), -1)
    paragraphs = F.filter(F.transform(F.regexp_extract_all(body, F.lit(r"(?is)<p\b[^>]*>(.*?)(?=<p\b|</p>|$)"), F.lit(1)),
                                      lambda p: compact(F.regexp_replace(p, "<[^>]*>", ""))), lambda p: p != "")
    read = evaluated(pages.select(*keys, name.alias("_title"), F.col(published).cast("date").alias("_on"), F.get(paragraphs, F.lit(0)).alias("_lead")))
    read = evaluated(read.withColumns({"_industry": F.regexp_like("_title", F.lit(ACTIVITY_INDUSTRY)), "_end": month}))
    year = F.coalesce(cast_found(F.regexp_extract("_title", r"(20\d\d)年", 1), "int"), F.year("_on") - F.when(F.col("_end") > F.month("_on"), 1).otherwise(0))
    read = evaluated(read.withColumn("_year", year)).where(
        (F.col("_industry") | F.col("_title").contains(ACTIVITY_RETAIL)) & ~F.regexp_like("_title", F.lit(COMMENTARY)) & F.col("_on").isNotNull()
        & F.col("_end").isNotNull() & F.col("_year").between(*ACTIVITY_YEARS))
    # ASCII commas of the compact text stand for both kinds
    stated = evaluated(read.withColumn("_stated", scoped_statements(F.coalesce("_lead", F.lit("")), F.col("_industry"), F.col("_title").contains("工业增加值") | F.col("_title").contains("实现工业增加值"))))
    distinct = F.array_distinct("_stated")
    problem = (F.when(F.col("_lead").isNull(), F.lit("no_lead_paragraph"))
               .when(F.col("_industry") & ~F.regexp_like("_lead", F.lit(POPULATION)), F.lit("unverified_population"))
               .when(~F.col("_industry") & ~F.col("_lead").contains(ACTIVITY_RETAIL), F.lit("unverified_measure"))
               .when(F.size("_stated") == 0, F.lit("no_monthly_statement"))
               .when(F.exists("_stated", lambda x: x["month"] > F.col("_end")), F.lit("after_the_period"))
               .when(F.size(F.array_distinct(F.transform("_stated", lambda x: x["month"]))) < F.size(distinct), F.lit("conflicting_months")))
    judged = evaluated(read_columns(stated, keys, problem, distinct))
    shown = F.when(F.col("problem").isNull(), F.col("_rows")).otherwise(F.array(F.struct(
        F.lit(None).cast("int").alias("month"), F.lit(None).cast("double").alias("value"))))
    rows = evaluated(judged.select(*keys, "metric", "_year", "problem", F.inline(shown)))
    return rows.select(*keys, "metric", F.concat("_year", F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("period"), "value", "problem")


def read_columns(stated: DataFrame, keys: list[str], problem: Column, rows: Column) -> DataFrame:
    metric = F.when(F.col("_industry"), F.lit(ACTIVITY_METRICS[True])).otherwise(F.lit(ACTIVITY_METRICS[False]))
    return stated.select(*keys, metric.alias("metric"), "_year", problem.alias("problem"), rows.alias("_rows"))


def row_links(pages: DataFrame, wanted: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """All anchors like ``text.links``, placed in their table rows.

    An anchor whose own title does not match ``wanted`` takes the text of the row that it stands in, if that does: ``row text [title]``.
    Rows are told by position: from a row's tag to its end or to the next row.
    """
    segments = F.split(F.col(html), r"(?i)(?=<tr\b)|(?<=</tr>)", -1)
    anchors = F.flatten(F.transform(segments, lambda s: F.transform(
        F.regexp_extract_all(s, F.lit(r"(?is)<a\s[^>]*href=.*?</a>"), F.lit(0)),
        lambda a: F.struct(a.alias("anchor"), F.when(F.regexp_like(s, F.lit(r"(?i)^<tr\b")), s).alias("row")))))
    rows = evaluated(pages.select(page_id, url, F.posexplode(anchors).alias("position", "_a")))
    parts = evaluated(rows.select(page_id, url, "position", F.regexp_extract("_a.anchor", r"""(?is)href=["']([^"']*)["']""", 1).alias("_href"),
                                  F.regexp_extract("_a.anchor", r"""(?is)^<a\s[^>]*?title=["']([^"']*)["']""", 1).alias("_title"),
                                  plain_text(F.col("_a.anchor")).alias("_label"), plain_text(F.coalesce("_a.row", F.lit(""))).alias("_row")))
    own = F.when(F.col("_title") != "", F.col("_title")).otherwise(F.col("_label"))
    title = F.when(~F.regexp_like(own, F.lit(wanted)) & F.regexp_like("_row", F.lit(wanted)), F.concat("_row", F.lit(" ["), own, F.lit("]"))).otherwise(own)
    return parts.select(page_id, "position", title.alias("title"), absolute_url(F.col(url), F.col("_href")).alias("link"))


@dataclass(frozen=True)
class StockLabel:
    """A metric and the names that its row may begin with or contain."""

    metric: str
    names: tuple[str, ...]


def stock_periods(rows: Column) -> Column:
    """(row, periods) of the first header of a table: months written out in one row, or years over months, each year carried to
    the right until the next one. ``periods`` are by column, null where a column has none."""
    whole, alone = r"(20\d\d)[.年/-](1[0-2]|0?[1-9])(?!\d)", r"^(20\d\d)年?$"
    months = r"^(1[0-2]|0?[1-9])月?$"

    def text(year: Column, month: Column) -> Column:
        return F.concat(year, F.lit("-"), F.lpad(month, 2, "0"))

    def enough(row: Column, pattern: str) -> Column:
        return (F.size(row) >= 6) & (F.size(F.filter(row, lambda c: F.regexp_like(c, F.lit(pattern)))) >= 6)

    def written(row: Column) -> Column:
        return F.when(enough(row, whole), F.transform(row, lambda c: F.when(
            F.regexp_like(c, F.lit(whole)), text(F.regexp_extract(c, whole, 1), F.regexp_extract(c, whole, 2)))))

    def stacked(upper: Column, lower: Column) -> Column:
        carried = lambda s, c: F.when(c == "", s["year"]).otherwise(F.nullif(F.regexp_extract(c, alone, 1), F.lit("")))
        years = F.aggregate(upper, F.struct(F.lit(None).cast("string").alias("year"), F.array().cast("array<string>").alias("out")), lambda s, c: let(
            carried(s, c), lambda y: F.struct(y.alias("year"), F.concat(s["out"], F.array(y)).alias("out"))), lambda s: s["out"])
        return F.when(enough(lower, months), let(years, lambda ys: F.transform(
            lower, lambda c, i: F.when(F.regexp_like(c, F.lit(months)), text(F.get(ys, i), F.regexp_extract(c, months, 1))))))

    kind = "struct<row:int,periods:array<string>>"

    def candidate(row: Column, periods: Column) -> Column:
        return let(periods, lambda p: F.when(F.size(F.array_compact(p)) >= 6, F.struct(row.alias("row"), p.alias("periods")))).cast(kind)

    # rows below the first header are not looked at
    return F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(rows) - 1, F.lit(0))), F.lit(None).cast(kind), lambda found, i: F.coalesce(
        found, candidate(i, written(F.get(rows, i))), candidate(i + 1, stacked(F.get(rows, i), F.get(rows, i + 1)))))


def annual_stock(pages: DataFrame, labels: list[StockLabel], keys: list[str], html: str = "html", scale: float = 1e-4) -> DataFrame:
    """Month columns of an annual table of amounts: metric, period, value, grade D (current history, first seen only).

    The table with the most periods counts, of equal ones the first; its rows are told by their labels, the last row of a label counts.
    Values stand under their months; where a row is shifted by a cell or more, its last numbers do, if there are as many as months.
    """
    tables = evaluated(pages.select(*keys, F.posexplode(table_grids(F.col(html))).alias("_no", "_rows")))
    headed = evaluated(tables.withColumn("_head", stock_periods(F.col("_rows")))).where("_head IS NOT NULL")
    amount = r"^[-+]?\d[\d,]*(?:\.\d+)?$"
    rows = headed.select(*keys, "_no", F.array_compact("_head.periods").alias("_periods"), F.posexplode(
        F.slice("_rows", F.col("_head.row") + 2, F.greatest(F.size("_rows"), F.lit(1)))).alias("_at", "_cells"))
    name, metric = F.get("_cells", F.lit(0)), F.lit(None).cast("string")
    for label in reversed(labels):
        hit = F.lit(False)
        for text in label.names:
            hit = hit | F.contains(name, F.lit(text))
        metric = F.when(hit, F.lit(label.metric)).otherwise(metric)
    numbers = F.transform(F.filter(F.slice("_cells", 2, F.greatest(F.size("_cells"), F.lit(1))), lambda c: F.regexp_like(c, F.lit(amount))),
                          lambda c: F.replace(c, F.lit(","), F.lit("")).try_cast("double"))
    told = evaluated(rows.withColumn("metric", metric)).where(F.col("metric").isNotNull() & (F.size("_cells") > F.size("_periods")))
    named = evaluated(told.select(*keys, "_no", "_periods", "_at", "metric", numbers.alias("_numbers"))).where(
        F.size("_numbers") >= F.size("_periods"))
    last = named.groupBy(*keys, "_no", "metric").agg(F.max(F.struct("_at", "_periods", "_numbers")).alias("row"))
    best = last.groupBy(*keys).agg(F.max(F.struct(F.size("row._periods").alias("n"), (-F.col("_no")).alias("first"))).alias("_best")).select(
        *keys, (-F.col("_best.first")).alias("_no"))
    chosen = last.join(best, [*keys, "_no"])
    values = F.slice("row._numbers", F.size("row._numbers") - F.size("row._periods") + 1, F.size("row._periods"))
    return chosen.select(*keys, "metric", F.inline(F.arrays_zip(F.col("row._periods").alias("period"), values.alias("_value")))).select(
        *keys, "metric", "period", (F.col("_value") * F.lit(scale)).alias("value"), F.lit("D").alias("pit_grade"))


# The headline of a national report, and places that publish reports of their own under the same name.
REPORT_HEADLINE = r"20\d\d年[^<]*金融统计数据报告"
LOCAL_REPORT = r"(?:上海|吉林|青岛)(?:市|省)?.*金融统计数据报告"
REPRINT_MARKERS = {True: "government_reprint_page_timestamp", False: "government_reprint_page_date"}


def accepted_reprints(pages: DataFrame, metrics: DataFrame, required: list[str], keys: list[str], html: str = "html",
                      grade: str = "pit_grade", released: str = "release_at", marker: str = "release_date_source") -> DataFrame:
    """Reprints by other sites, judged by a table of rules in order: pit_grade, release_date_source, problem.

    The shortest headline on the page must be that of a national report, every required metric must have been read, and the page
    must prove when it appeared. An accepted reprint proves visibility from its own publication only: its grade becomes B, whatever
    the page's evidence, and its marker says what that was. ``metrics`` has the keys and ``metric``.
    """
    texts = F.transform(F.regexp_extract_all(html, F.lit(rf"(?s)(?<=>)[^<>]*{REPORT_HEADLINE}[^<]*(?=<)"), F.lit(0)),
                        lambda t: F.trim(F.regexp_replace(t, r"\s+", " ")))
    lengths = F.transform(texts, lambda t, i: F.struct(F.length(t).alias("n"), i.alias("i"), t.alias("text")))
    have = metrics.groupBy(*keys).agg(F.collect_set("metric").alias("_have"))  # at most one of each rule
    read = evaluated(pages.select(*keys, grade, released, marker, F.array_min(lengths)["text"].alias("_headline"))).join(have, keys, "left")
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.coalesce("_have", F.array().cast("array<string>"))))
    rules = [
        ("no_national_headline", F.col("_headline").isNull()),
        ("local_report", F.regexp_like("_headline", F.lit(LOCAL_REPORT))),
        ("missing_core_metrics", F.size(missing) > 0),
        ("no_publication_evidence", (F.col(grade) == "D") | F.col(grade).isNull() | F.col(released).isNull()),
    ]
    problem = F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules])
    judged = evaluated(read.select(*keys, problem.alias("problem"), F.contains(F.coalesce(marker, F.lit("")), F.lit("timestamp")).alias("_exact"),
                                   F.array_join(missing, ",").alias("missing")))
    ok = F.col("problem").isNull()
    return judged.select(*keys, F.when(ok, F.lit("B")).alias("pit_grade"), F.when(ok, F.when(F.col("_exact"), F.lit(REPRINT_MARKERS[True])).otherwise(
        F.lit(REPRINT_MARKERS[False]))).alias("release_date_source"), F.when(~ok, F.col("missing")).alias("missing"), "problem")
