"""Text and page jobs: release evidence, periods, metrics, tables, links, excerpts.

Parsing is declarative per row and stays in the JVM; jobs shuffle only to compare rows
(dedup, completeness). A pattern with several groups runs once over the text: its match is cut
out first, and the groups are read from the short match.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.instants import LOCAL_ZONE, day_start_utc, evaluated, next_day_start_utc, text_to_utc
from ..functions.ordered import newest, oldest, top_row
from ..functions.texts import cast_found, compact, content_of, let, meta_tags, number, plain_text, signed, until

# Meta tags holding a publication time, and the labels before a time or date in text.
TIME_TAGS = ("article:published_time", "publishdate", "PubDate", "publish-time")
TIME_LABELS = ("文章来源", "发布时间")
DATE_LABELS = ("文章来源", "发布时间", "发布日期")
_DAY = r"20\d\d[-/年]\d{1,2}[-/月]\d{1,2}"
_BARE_DAY = r"20\d\d[-/]\d{1,2}[-/]\d{1,2}"  # without a label, words of the language may belong to a period
_CLOCK = r"日?\s+\d{1,2}:\d\d(?::\d\d)?"


def with_text(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("text", plain_text(F.col(html)))


def _iso(text: Column) -> Column:
    """Chinese or slashed date text in ISO form, two-digit parts."""
    dashed = F.regexp_replace(F.regexp_replace(text, "[年月/]", "-"), "日", "")
    for part in (r"-(\d)(?=-|\s|$)", r"\s(\d):"):
        dashed = F.regexp_replace(dashed, part, "-0$1" if part.startswith("-") else " 0$1:")
    return dashed


def _labelled(text: str, label: str, clock: str = "") -> Column:
    """The first day, with its time if asked for, behind a label, or without one if it is empty."""
    pattern = rf"(?:{label})\s*[：:]?\s*({_DAY}{clock})" if label else f"({_BARE_DAY}{clock})"
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def with_release_evidence(pages: DataFrame, first_seen: str, html: str = "html", text: str = "text",
                          zone: str = LOCAL_ZONE) -> DataFrame:
    """Grade a page by what it says about its publication.

    In this order: a time in metadata (tags in the order of ``TIME_TAGS``), a time behind a label, a bare time: A.
    A date in metadata (the last tag that has one), a date behind a label, a bare date: B, usable from the next
    local day. Nothing: D, usable once seen.
    """
    def first(texts: Column, read) -> Column:
        """The first text that ``read`` makes something of."""
        return F.get(F.filter(F.transform(texts, read), lambda x: x.isNotNull()), F.lit(0))

    cut = evaluated(pages.withColumn("_tags", meta_tags(F.col(html))))
    found = evaluated(cut.withColumns({
        "_metas": F.array(*[content_of(F.col("_tags"), name) for name in TIME_TAGS]),
        "_stamps": F.array(*[_labelled(text, label, _CLOCK) for label in (*TIME_LABELS, "")]),
        "_days": F.array(*[_labelled(text, label) for label in ("|".join(DATE_LABELS), "")]),
    }))
    clocked = lambda t: t.rlike(r"\d:\d\d")
    read = evaluated(found.withColumns({
        "_meta_at": first(F.col("_metas"), lambda t: F.when(clocked(t), let(_iso(t), lambda i: text_to_utc(i, zone)))),
        "_text_at": first(F.col("_stamps"), lambda t: let(_iso(t), lambda i: text_to_utc(i, zone))),
        "_meta_day": first(F.reverse("_metas"), lambda t: F.when(~clocked(t), _iso(t).try_cast("date"))),
        "_text_day": first(F.col("_days"), lambda t: _iso(t).try_cast("date")),
    }))
    exact, day = F.coalesce("_meta_at", "_text_at"), F.coalesce("_meta_day", "_text_day")
    sources = [("_meta_at", "official_page_metadata"), ("_text_at", "official_page_timestamp"),
               ("_meta_day", "official_page_metadata_date"), ("_text_day", "official_page_date")]
    return read.withColumns({
        "pit_grade": F.when(exact.isNotNull(), F.lit("A")).when(day.isNotNull(), F.lit("B")).otherwise(F.lit("D")),
        "release_at": F.coalesce(exact, day_start_utc(day, zone)),
        "available_at": F.coalesce(exact, next_day_start_utc(day, zone), F.col(first_seen)),
        "release_date_source": F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(name)) for c, name in sources], F.lit("first_seen_only")),
    }).select(*pages.columns, "pit_grade", "release_at", "available_at", "release_date_source")


# What may follow a year, by kind: quarter, half, months from the first, first n months, one month.
_UNIT = r"(?:(?:前\s*)?[一二三四1-4]\s*季|上半年|(?:1\s*[-—–至]\s*|前\s*)?\d{1,2}\s*个?月)"
_DATED_UNIT = rf"20\d\d\s*年\s*{_UNIT}"
PUBLICATION_ORDER = ("quarter", "half", "span", "first", "month")
TITLE_ORDER = ("span", "month", "half", "quarter", "first")


def _period_of(text: Column, order: tuple[str, ...]) -> Column:
    """``YYYYMM`` number of the dated unit whose kind comes first in ``order``, then of the first such unit; else null."""
    def read(unit: Column, at: Column) -> Column:
        return let(F.substring(unit, F.lit(5), F.length(unit) - 4), lambda tail: let(
            cast_found(F.regexp_extract(F.translate(tail, "一二三四", "1234"), r"(\d+)\s*(?:个?月|季)", 1), "int"), lambda last: let(
                kind_of(tail), lambda kind: described(unit, at, last, kind))))

    def kind_of(tail: Column) -> Column:
        return (F.when(tail.contains("季"), "quarter").when(tail.contains("上半年"), "half").when(tail.contains("前"), "first")
                .when(tail.rlike("[-—–至]"), "span").otherwise("month"))

    def described(unit: Column, at: Column, last: Column, kind: Column) -> Column:
        month = F.when(kind == "quarter", last * 3).when(kind == "half", 6).otherwise(last)
        rank = F.array_position(F.array(*map(F.lit, order)), kind)
        return F.struct(rank.alias("rank"), at.alias("at"), (F.substring(unit, 1, 4).cast("int") * 100 + month).alias("period"))

    units = F.transform(F.regexp_extract_all(text, F.lit(_DATED_UNIT), F.lit(0)), read)
    return F.array_min(F.filter(units, lambda u: (u["period"] % 100).between(1, 12)))["period"]


def _annual(title: Column) -> Column:
    return cast_found(F.regexp_extract(title, r"(20\d\d)\s*年", 1), "int") * 100 + 12


def _period_text(number_: Column) -> Column:
    return let(number_, lambda n: F.when(n.isNotNull(), F.concat(
        F.floor(n / 100).cast("string"), F.lit("-"), F.lpad((n % 100).cast("string"), 2, "0"))))


def _rolled(title: Column, published: Column) -> Column:
    """A month without a year: the publication's year, or the year before when that month is still to come."""
    return let(cast_found(F.regexp_extract(title, r"(?<!\d)(\d{1,2})\s*月", 1), "int"), lambda month: F.when(
        month.between(1, 12), (F.year(published) - F.when(month > F.month(published), 1).otherwise(0)) * 100 + month))


def with_publication_period(pages: DataFrame, title: str = "title", text: str = "text",
                            published: str | None = None) -> DataFrame:
    """``period`` of a publication: title first (a bare year means December), then a yearless month of the title, then the text."""
    choices = {"_titled": F.coalesce(_period_of(F.col(title), PUBLICATION_ORDER), _annual(F.col(title)))}
    if published is not None:
        choices["_rolled"] = _rolled(F.col(title), F.col(published))
    choices["_body"] = _period_of(F.col(text), PUBLICATION_ORDER)
    return pages.withColumns(choices).withColumn("period", _period_text(F.coalesce(*choices))).drop(*choices)


# English month names, and short forms beside their first three letters.
MONTH_NAMES = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
SHORT_NAMES = ("sept",)


def with_title_period(rows: DataFrame, title: str = "title", published: str | None = None) -> DataFrame:
    """``period`` named in a title: units after a year in title order, a bare year (December), English months, ``m.YYYY``;
    with ``published`` at last a month without a year."""
    names = sorted({*MONTH_NAMES, *SHORT_NAMES, *(m[:3] for m in MONTH_NAMES)}, key=len, reverse=True)
    english = F.regexp_extract(F.lower(title), rf"\b(?:{'|'.join(names)})\b\.?\s*,?\s*20\d\d\b", 0)
    dotted = F.regexp_extract(title, r"(?<![\d.])\d{1,2}\s*\.\s*20\d\d(?!\d)", 0)
    found = evaluated(rows.withColumns({"_chinese": F.coalesce(_period_of(F.col(title), TITLE_ORDER), _annual(F.col(title))),
                                        "_english": english, "_dotted": dotted}))
    month = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTH_NAMES]), F.substring("_english", 1, 3)).cast("int")
    first = cast_found(F.regexp_extract("_dotted", r"^\d+", 0), "int")
    year = lambda c: cast_found(F.substring(c, -4, 4), "int") * 100
    choices = [F.col("_chinese"), year(F.col("_english")) + F.nullif(month, F.lit(0)),
               F.when(first.between(1, 12), year(F.col("_dotted")) + first)]
    if published is not None:
        choices.append(_rolled(F.col(title), F.col(published)))
    return found.withColumn("period", _period_text(F.coalesce(*choices))).drop("_chinese", "_english", "_dotted")


@dataclass(frozen=True)
class MetricRule:
    """A metric and the pattern whose groups are (direction, value); direction may be empty."""

    metric: str
    pattern: str
    scale: float = 1.0


def extract_metrics(documents: DataFrame, rules: list[MetricRule], keys: list[str], text: str = "text") -> DataFrame:
    """Observations found by a rule table, one row per (document, metric) that matches.

    The bounded rule list is unrolled into one array per row: no join with the rules. A rule searches the text once;
    its groups are read from the match.
    """
    read = documents.select(*keys, compact(F.col(text)).alias("_text"))
    hits = F.array(*[
        F.struct(F.lit(r.metric).alias("metric"), F.lit(i).alias("_rule"), F.regexp_extract("_text", r.pattern, 0).alias("_match"),
                 F.lit(r.scale).alias("scale")) for i, r in enumerate(rules)])
    rows = evaluated(read.select(*keys, F.inline(hits))).where("_match <> ''")

    def group(n: int) -> Column:
        out = F.lit(None).cast("string")
        for i, r in enumerate(rules):
            out = F.when(F.col("_rule") == i, F.regexp_extract("_match", r.pattern, n)).otherwise(out)
        return out

    read = evaluated(rows.select(*keys, "metric", "scale", group(1).alias("direction"), group(2).alias("raw")))
    return read.withColumn("value", signed(number(F.col("raw")), F.col("direction")) * F.col("scale")).where(
        "value IS NOT NULL").select(*keys, "metric", "value")


def preferred_occurrence(documents: DataFrame, labels: list[str], keys: list[str], text: str = "text",
                         month: str = "month") -> DataFrame:
    """The best of several statements about one metric in a document.

    A statement is a label and, before the next label or the end of the sentence, a direction and a percentage. It
    is cumulative if the sentence says so before it. Cumulative statements come first, then the order of appearance.
    """
    label = "|".join(sorted(map(re.escape, labels), key=len, reverse=True))
    parts = documents.select(*keys, F.col(month).cast("string").alias("_month"), F.posexplode(
        F.split(compact(F.col(text)), "[。；;]")).alias("_sentence", "_part"))
    # what stands before the first label, and behind each label
    cut = evaluated(parts.select(*keys, "_month", "_sentence", F.split("_part", label, -1).alias("_pieces"))).where(F.size("_pieces") > 1)
    said = F.concat(F.lit("累计|1[-—–至]"), F.col("_month"), F.lit("月|前"), F.col("_month"), F.lit("个?月"))
    change = "(?:增长|下降|微增)[\\d.]+%"
    statements = F.transform(F.sequence(F.lit(1), F.size("_pieces") - 1), lambda i: F.struct(
        (~F.regexp_like(F.array_join(F.slice("_pieces", 1, i), ""), said)).alias("later"), F.col("_sentence").alias("position"),
        i.alias("nth"), F.regexp_extract(F.get("_pieces", i), change, 0).alias("change")))
    found = evaluated(cut.select(*keys, F.explode(statements).alias("b"))).where("b.change <> ''")
    # a running minimum per document: partial aggregation keeps long documents map-side
    best = found.groupBy(*keys).agg(F.min("b").alias("b"))
    value = cast_found(F.regexp_extract("b.change", r"[\d.]+", 0), "double")
    return best.select(*keys, (~F.col("b.later")).alias("cumulative"), F.col("b.position").alias("position"),
                       signed(value, F.col("b.change")).alias("value"))


def table_cells(html: Column, clean=compact) -> Column:
    """tables -> rows -> cell texts, an array of arrays of arrays."""
    return F.transform(raw_cells(html), lambda t: F.transform(t, lambda r: F.transform(r, lambda c: cell_text(c, clean))))


def raw_cells(html: Column) -> Column:
    """tables -> rows -> markup of cells. Patterns go from tag to tag, to the first end of their element."""
    return F.transform(
        F.regexp_extract_all(html, F.lit(rf"(?is)<table{until('/table>')}</table>"), 0),
        lambda t: F.transform(F.regexp_extract_all(t, F.lit(rf"(?is)<tr{until('/tr>')}</tr>"), 0), lambda r: F.regexp_extract_all(
            r, F.lit(rf"(?is)<t[dh][^>]*>({until('/t[dh]>')})</t[dh]>"), 1)))


def cell_text(cell: Column, clean=compact) -> Column:
    return clean(F.when(F.contains(cell, F.lit("<")), F.regexp_replace(cell, "<[^>]*>", "")).otherwise(cell))


# Second header row, first cells of the first one, cells that hold no value, units behind a label.
HEADER_CELLS = ("绝对量", "同比增长(%)", "绝对量", "同比增长(%)")
HEADER_NAMES = ("", "指标")
BLANK_CELLS = ("", "…", "...", "—", "-")
LABEL_UNITS = ("亿元", "万平方米", "%")
NUMERALS = "一二三四五六七八九十"


def _bare_label(cell: Column) -> Column:
    """A row label without its number in front and its unit behind."""
    numbered = rf"^(?:[{NUMERALS}]+、|\([{NUMERALS}]+\))"
    unit = rf"\((?:{'|'.join(LABEL_UNITS)})\)$"
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(cell, numbered, ""), numbered, ""), unit, "")


def table_metrics(pages: DataFrame, labels: dict[str, tuple[str, int]], keys: list[str], html: str = "html",
                  month: str = "month") -> DataFrame:
    """Cells of tables whose header names exactly this month and its year-to-date span, in whichever row.

    ``labels`` maps a row label to (metric, cell index); the label is the first cell that is not empty, and four cells
    follow it. Blank cells stay null; a cell that is neither blank nor a number, or tables that disagree, set ``problem``.
    """
    # evaluated: the explode's own test for an empty array would read the page again. Cells are cleaned where they are looked at
    rows = evaluated(pages.select(*keys, F.col(month).cast("int").alias("_month"), raw_cells(F.col(html)).alias("_tables"))).select(
        *keys, "_month", F.explode(F.col("_tables")).alias("_rows"))
    # a header cell as numbers only: "03月份" is "3", "1—3月" is "1-3"
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.translate(cell_text(c), "—–至份", "---"), r"(^|-)0", "$1"), "月$", "")
    wanted = F.array(F.col("_month").cast("string"), F.concat(F.lit("1-"), F.col("_month").cast("string")))

    def opens(i: Column) -> Column:
        row, below = F.get("_rows", i - 1), F.get("_rows", i)
        return F.coalesce((F.size(row) == 3) & (F.size(below) == len(HEADER_CELLS)) & cell_text(F.get(row, F.lit(0))).isin(*HEADER_NAMES) & (
            F.transform(F.slice(row, 2, 2), plain) == wanted) & (F.transform(below, lambda c: cell_text(c)) == F.array(*map(F.lit, HEADER_CELLS))), F.lit(False))

    headed = rows.withColumn("_at", F.array_min(F.filter(F.sequence(F.lit(1), F.greatest(F.size("_rows"), F.lit(1))), opens)))
    body = evaluated(headed.select(*keys, "_rows", "_at")).where("_at IS NOT NULL").select(
        *keys, F.explode(F.slice("_rows", F.col("_at") + 2, F.size("_rows"))).alias("_cells"))
    first = evaluated(body.where(F.size("_cells") >= 5).withColumn("_first", cell_text(F.get("_cells", F.lit(0)))))
    lead = F.when(F.col("_first") != "", 1).otherwise(F.coalesce(F.array_min(F.filter(
        F.sequence(F.lit(1), F.size("_cells")), lambda i: cell_text(F.get("_cells", i - 1)) != "")), F.lit(1)))
    aligned = evaluated(first.withColumn("_lead", lead)).where(F.size("_cells") - F.col("_lead") == 4)
    named = evaluated(aligned.withColumn("_name", _bare_label(F.when(F.col("_lead") == 1, F.col("_first")).otherwise(
        cell_text(F.get("_cells", F.col("_lead") - 1))))))
    metric, raw = F.lit(None).cast("string"), F.lit(None).cast("string")
    for label, (target, index) in labels.items():
        metric = F.when(F.col("_name") == label, F.lit(target)).otherwise(metric)
        raw = F.when(F.col("_name") == label, F.get("_cells", F.col("_lead") - 1 + index)).otherwise(raw)
    cells = evaluated(evaluated(named.select(*keys, metric.alias("metric"), raw.alias("_raw"))).where("metric IS NOT NULL").select(
        *keys, "metric", cell_text(F.col("_raw")).alias("raw")))
    typed = cells.withColumn("value", F.when(F.col("raw").rlike(r"^[+-]?\d+(\.\d+)?$"), F.col("raw").try_cast("double"))).withColumn(
        "bad", ~F.col("raw").isin(*BLANK_CELLS) & F.col("value").isNull())
    return typed.groupBy(*keys, "metric").agg(
        F.max("value").alias("value"),
        F.when(F.bool_or("bad"), F.lit("unexpected_cell"))
        .when((F.min("value") != F.max("value")) | ((F.count("value") > 0) & (F.count("value") < F.count(F.lit(1)))),
              F.lit("conflicting_tables")).alias("problem"))


def enumerated_months(documents: DataFrame, keys: list[str], label: str = "全国城镇调查失业率", text: str = "text",
                      month: str = "month") -> DataFrame:
    """"1至3月份，<label>分别为a%、b%和c%": one row per month, read from every such list that ends in the document's month.

    If a list has another number of values than months, a value is no percentage, or two lists
    disagree, the document has one row with ``problem``.
    """
    listing = rf"(?<![\d年])\d{{1,2}}至\d{{1,2}}月份[，,]{label}分别为[^。，,；;]+"
    found = documents.select(*keys, F.col(month).alias("_month"), F.explode(F.regexp_extract_all(
        compact(F.col(text)), F.lit(listing), F.lit(0))).alias("_list"))
    read = evaluated(found.select(
        *keys, "_month", F.regexp_extract("_list", r"^\d+", 0).cast("int").alias("_from"), F.regexp_extract("_list", r"至(\d+)月", 1).cast("int").alias("_to"),
        F.split(F.substring_index("_list", "为", -1), "[、和]").alias("_values"))).where("_to = _month")
    percent = F.transform("_values", lambda v: F.when(v.rlike(r"^\d+(\.\d+)?%$"), F.replace(v, F.lit("%"), F.lit("")).try_cast("double")))
    checked = read.withColumn("_numbers", percent)
    wrong = (F.col("_from") < 1) | (F.col("_from") > F.col("_to")) | (F.size("_values") != F.col("_to") - F.col("_from") + 1) | F.exists(
        "_numbers", lambda n: F.coalesce((n < 0) | (n > 100), F.lit(True)))
    pairs = F.when(wrong, F.array(F.struct(F.lit(None).cast("int").alias("month"), F.lit(None).cast("double").alias("value")))).otherwise(
        F.arrays_zip(F.sequence("_from", F.greatest("_from", "_to")).alias("month"), F.col("_numbers").alias("value")))
    each = evaluated(checked.select(*keys, F.inline(pairs)))
    by_month = each.groupBy(*keys, "month").agg(F.min("value").alias("value"), (F.min("value") != F.max("value")).alias("_split"))
    by_document = by_month.groupBy(*keys).agg(
        F.bool_or(F.col("month").isNull() | F.coalesce("_split", F.lit(False))).alias("_bad"),
        F.array_sort(F.collect_list(F.struct("month", "value"))).alias("_months"))  # at most twelve
    shown = F.when(F.col("_bad"), F.array(F.struct(F.lit(None).cast("int").alias("month"), F.lit(None).cast("double").alias("value")))).otherwise(
        F.col("_months"))
    return by_document.select(*keys, F.when(F.col("_bad"), F.lit("months_and_values_differ")).alias("problem"), F.inline(shown))


def incomplete_documents(documents: DataFrame, metrics: DataFrame, required: list[str], keys: list[str]) -> DataFrame:
    """Documents lacking some required metric, those without any metric too; the set per document is bounded by the rules."""
    sets = metrics.groupBy(*keys).agg(F.collect_set("metric").alias("_have"))
    have = F.coalesce("_have", F.array().cast("array<string>"))
    missing = F.array_sort(F.array_except(F.array(*[F.lit(r) for r in required]), have))
    return documents.select(*keys).distinct().join(sets, keys, "left").select(
        *keys, F.array_join(missing, ",").alias("missing")).where("missing <> ''")


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a link against its page's address: scheme and host, folder, ``.`` and ``..``, query and fragment."""
    scheme = F.regexp_extract(base, r"^(https?:)", 1)
    root = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    page = F.regexp_replace(F.regexp_extract(base, r"^https?://[^/?#]+([^?#]*)", 1), "^$", "/")
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    path, rest = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_replace(href, r"^[^?#]*", "")
    joined = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.regexp_replace(page, r"[^/]*$", ""), path))
    parts = F.split(F.substring(joined, F.lit(2), F.length(joined)), "/", -1)

    def step(done: Column, part: Column) -> Column:
        return (F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(part == ".", done)
                .otherwise(F.concat(done, F.array(part))))

    folded = F.aggregate(parts, F.array().cast("array<string>"), step)
    # a path that ends in a dot segment names a folder
    closed = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    resolved = F.concat(root, F.lit("/"), F.array_join(closed, "/"), rest)
    return (F.when(href == "", F.regexp_replace(base, "#.*$", "")).when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(F.startswith(href, F.lit("//")), F.concat(scheme, href)).when(F.startswith(href, F.lit("?")), F.concat(root, page, href))
            .when(F.startswith(href, F.lit("#")), F.concat(root, page, query, href)).otherwise(resolved))


@dataclass(frozen=True)
class LinkRule:
    """Which links of an index page count: title words in and out, hosts, path pattern."""

    kind: str
    keywords: tuple[str, ...]
    exclude: tuple[str, ...] = ()
    host_pattern: str = ".*"
    path_pattern: str = ".*"
    force_https: bool = False


def links(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """All anchors of all pages: title (attribute or text), absolute address, order."""
    anchors = pages.select(
        page_id, url, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*href=.*?</a>"), 0)).alias("position", "_a"))
    parts = anchors.withColumns({
        "_href": F.regexp_extract("_a", r"""(?is)href=["']([^"']*)["']""", 1),
        "_title": F.regexp_extract("_a", r"""(?is)^<a\s[^>]*?title=["']([^"']*)["']""", 1),
        "_label": plain_text(F.col("_a")),
    })
    return parts.select(
        page_id, "position", F.when(F.col("_title") != "", F.col("_title")).otherwise(F.col("_label")).alias("title"),
        absolute_url(F.col(url), F.col("_href")).alias("link"))


def discover(found: DataFrame, rule: LinkRule, page_id: str = "page_id") -> DataFrame:
    """Candidates a rule admits, the last seen per address."""
    has = [F.col("title").contains(k) for k in rule.keywords]
    hit = has[0]
    for test in has[1:]:
        hit = hit | test
    for word in rule.exclude:
        hit = hit & ~F.col("title").contains(word)
    rows = evaluated(found).where(hit)
    if rule.force_https:
        rows = rows.withColumn("link", F.regexp_replace("link", "^http://", "https://"))
    host = F.lower(F.regexp_extract("link", r"^https?://([^/:?#]+)", 1))
    rows = rows.where(host.rlike(rule.host_pattern) & F.col("link").rlike(rule.path_pattern))
    best = top_row(rows, ["link"], newest(page_id, "position"))
    return with_title_period(best).select("link", "title", "period", F.lit(rule.kind).alias("kind"), page_id)


def merge_candidates(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Keyed merge by url: the fresh row wins; newest period first."""
    both = existing.withColumn("_age", F.lit(0)).unionByName(fresh.withColumn("_age", F.lit(1)))
    return top_row(both, ["url"], newest("_age", *[c for c in existing.columns if c != "url"])).drop(
        "_age").orderBy(*newest("period", "url"))


SEARCH_DOC = "struct<data:struct<url:string,titleO:string,title:string,docDate:string>>"
SEARCH_PAYLOAD = f"ok boolean, msg string, resultDocs array<{SEARCH_DOC}>"


def search_candidates(payloads: DataFrame, keys: list[str], hosts: list[str], path_pattern: str, canonical_host: str,
                      column: str = "payload") -> DataFrame:
    """Search result documents with a canonical address; the last one wins per address.

    A payload that is not ``ok`` or has no result list keeps one row with ``problem``.
    """
    parsed = payloads.select(*keys, F.from_json(column, SEARCH_PAYLOAD).alias("_p"))
    bad = ~F.coalesce(F.col("_p.ok"), F.lit(False)) | F.col("_p.resultDocs").isNull()
    rows = parsed.select(
        *keys, F.when(bad, F.lit("bad_response")).alias("problem"),
        F.explode_outer(F.when(~bad, F.col("_p.resultDocs"))).alias("_d")).select(*keys, "problem", "_d.data.*")
    host = F.lower(F.regexp_extract("url", r"^https?://([^/:?#]+)", 1))
    path = F.regexp_extract("url", r"^https?://[^/?#]+(/[^?#]*)", 1)
    marked = F.coalesce(F.nullif("titleO", F.lit("")), "title", F.lit(""))
    title = F.trim(F.regexp_replace(F.regexp_replace(marked, "<[^>]+>", ""), r"\s+", " "))
    named = evaluated(rows.select(
        *keys, "problem", F.concat(F.lit(f"https://{canonical_host}"), path).alias("link"), title.alias("title"),
        F.substring("docDate", 1, 10).try_cast("date").alias("published"),
        (host.isin(*hosts) & path.rlike(path_pattern) & (title != "")).alias("_usable")))
    usable = with_title_period(named.where("_usable AND problem IS NULL"), "title", "published")
    best = top_row(usable, ["link"], newest(*keys, "published", "title")).select(*keys, "problem", "link", "title", "period")
    return best.unionByName(named.where("problem IS NOT NULL").select(
        *keys, "problem", F.lit(None).cast("string").alias("link"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("period")))


def page_fingerprint(payload: Column) -> Column:
    """Digest of a result page's (url, date) list, whatever its order or metadata."""
    docs = F.filter(F.from_json(payload, SEARCH_PAYLOAD)["resultDocs"], lambda d: F.coalesce(d["data"]["url"], F.lit("")) != "")
    parts = F.array_sort(F.transform(docs, lambda d: F.concat_ws("|", d["data"]["url"], F.coalesce(d["data"]["docDate"], F.lit("")))))
    return F.when(F.size(parts) > 0, F.sha2(F.array_join(parts, "\n"), 256))


def excerpts(candidates: DataFrame, needles: list[str], limit: int, source: str, text: str = "text") -> DataFrame:
    """Bounded evidence window around the first needle that occurs, searched in the whole text.

    Needles are tried in column order; needles under two characters do not count. The text
    and the needles stay behind, only the excerpt goes on.
    """
    low = F.lower(text)
    found = [F.when(F.length(F.trim(n)) >= 2, F.nullif(F.instr(low, F.lower(n)), F.lit(0)) - 1) for n in needles]
    center = candidates.withColumn("_center", F.coalesce(*found, F.lit(0)))
    start = F.greatest(F.lit(0), F.col("_center") - limit // 3)
    end = F.least(F.length(text), start + limit)
    first = F.greatest(F.lit(0), end - limit)
    cut = center.withColumn("excerpt", F.substring(F.col(text), first + 1, end - first)).drop(
        "_center", text, *needles)
    digest = F.substring(F.sha2(F.concat_ws("\u0000", source, "excerpt"), 256), 1, 20)
    # evaluated: later conditions on the id do not search the text again
    return evaluated(cut).withColumn("evidence_id", F.when(F.col("excerpt") != "", F.concat(F.lit("evidence_"), digest)))


def distinct_evidence(rows: DataFrame, order: list[str]) -> DataFrame:
    return top_row(rows.where("evidence_id IS NOT NULL"), ["evidence_id"], oldest(*order))


def cross_checked(articles: DataFrame, searches: DataFrame, key: str) -> DataFrame:
    """Articles whose title, body and search record agree on value, period and time.

    ``articles`` has title_value, title_period, body_value, body_period, published;
    ``searches`` has value, period, published. ``verdict`` names the first disagreement.
    """
    found = searches.select(key, F.col("value").alias("_value"), F.col("period").alias("_period"),
                            F.col("published").alias("_published"))
    copies = found.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_value", "_period", "_published")).alias("_s"))
    joined = articles.join(copies, key, "left")
    verdict = (
        F.when(F.col("_n").isNull() | (F.col("_n") != 1), F.lit("no_unique_search_record"))
        .when(~F.col("title_value").eqNullSafe(F.col("_s._value")) | ~F.col("title_period").eqNullSafe(F.col("_s._period")),
              F.lit("title_disagrees"))
        .when(~F.col("published").eqNullSafe(F.col("_s._published")), F.lit("time_disagrees"))
        .when(~F.col("body_value").eqNullSafe(F.col("title_value")) | ~F.col("body_period").eqNullSafe(F.col("title_period")),
              F.lit("body_disagrees")))
    return joined.withColumn("verdict", F.coalesce(verdict, F.lit("ok"))).drop("_n", "_s")


def consolidated_months(pages: DataFrame, labels: dict[str, str], keys: list[str], html: str = "html",
                        paired: bool = True) -> DataFrame:
    """Month columns of a cumulative table to rows; of paired cells the first counts.

    The header row lists ``YYYY-MM`` months; each data row has a label and one cell, or a
    pair of cells, per month.
    """
    rows = pages.select(*keys, F.explode(table_cells(F.col(html))).alias("_rows")).withColumn(
        "_months", F.filter(F.get("_rows", F.lit(0)), lambda c: c.rlike(r"^\d{4}-\d{2}$"))).where(F.size("_months") > 0)
    body = rows.select(*keys, "_months", F.explode(F.slice("_rows", 2, F.size("_rows"))).alias("_cells"))
    step = 2 if paired else 1
    pick = F.transform("_months", lambda m, i: F.get("_cells", i * step + 1))
    label = F.get("_cells", F.lit(0))
    metric = F.lit(None).cast("string")
    for name, target in labels.items():
        metric = F.when(label == name, F.lit(target)).otherwise(metric)
    cells = body.select(*keys, metric.alias("metric"), F.inline(F.arrays_zip(F.col("_months").alias("period"), pick.alias("raw"))))
    return evaluated(cells).withColumn("value", number(F.col("raw"))).where("metric IS NOT NULL AND value IS NOT NULL").select(
        *keys, "metric", "period", "value", F.lit("C").alias("pit_grade"))


