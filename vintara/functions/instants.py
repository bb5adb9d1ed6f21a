"""Instants, cutoffs and period labels.

Instants are UTC. A column may be ``timestamp`` (session zone UTC) or ``timestamp_ntz``
holding UTC wall time; every helper keeps the type it is given.
"""

from __future__ import annotations

from datetime import date, datetime, time, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LOCAL_ZONE = "Asia/Shanghai"
MICRO = 1e-12


def ensure_utc(value: datetime | str, zone: str = LOCAL_ZONE) -> datetime:
    """Parse an instant on the driver; one without an offset is local to ``zone``."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
    if value.tzinfo is None:
        value = value.replace(tzinfo=ZoneInfo(zone))
    return value.astimezone(timezone.utc)


def normalize_as_of(value: datetime | str, zone: str = LOCAL_ZONE) -> datetime:
    """Like :func:`ensure_utc`, but a bare date means the end of that local day."""
    if isinstance(value, str) and len(value.strip()) == 10:
        value = datetime.combine(date.fromisoformat(value.strip()), time.max)
    return ensure_utc(value, zone)


def instant(frame: DataFrame, column: str, value: datetime | str) -> Column:
    """The UTC instant as a literal of the type ``column`` has in ``frame``."""
    utc = value if isinstance(value, datetime) and value.tzinfo else ensure_utc(value)
    text = utc.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    if frame.schema[column].dataType.typeName() == "timestamp_ntz":
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "+00:00").cast("timestamp")


def day_start_utc(day: Column, zone: str = LOCAL_ZONE, time_of_day: str | None = None) -> Column:
    """UTC wall time of a local midnight (or ``HH:MM``) as ``timestamp_ntz``."""
    wall = day.cast("timestamp_ntz")
    if time_of_day:
        hours, minutes = (int(part) for part in time_of_day.split(":"))
        wall = wall + F.expr(f"make_dt_interval(0, {hours}, {minutes}, 0)")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)


def next_day_start_utc(day: Column, zone: str = LOCAL_ZONE) -> Column:
    """A date-only release is usable from the following local midnight."""
    return day_start_utc(F.date_add(day, 1), zone)


def local_date(ts: Column, zone: str | Column = LOCAL_ZONE) -> Column:
    """Local calendar date of a UTC instant."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), zone, ts.cast("timestamp_ntz")).cast("date")


def text_to_utc(text: Column, zone: str = LOCAL_ZONE) -> Column:
    """ISO text to UTC wall time: ``Z`` or an offset is honoured, naive text is local.

    Works on ``timestamp_ntz`` so the result never depends on the session zone.
    """
    clean = F.regexp_replace(F.trim(text), "Z$", "+00:00")
    body = F.regexp_replace(clean, r"[+-]\d{2}:?\d{2}$", "")
    wall = body.try_cast("timestamp_ntz")
    sign = F.when(F.regexp_extract(clean, r"([+-])\d{2}:?\d{2}$", 1) == "-", -1).otherwise(1)
    hours = F.regexp_extract(clean, r"[+-](\d{2}):?\d{2}$", 1)
    minutes = F.regexp_extract(clean, r"[+-]\d{2}:?(\d{2})$", 1)
    offset = F.make_dt_interval(
        hours=sign * F.try_to_number(hours, F.lit("99")).cast("int"),
        mins=sign * F.try_to_number(minutes, F.lit("99")).cast("int"),
    )
    return F.when(hours != "", wall - offset).otherwise(
        F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    )


def month_end(day: Column) -> Column:
    return F.last_day(day)


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.date_trunc("quarter", day).cast("date"), 2))


def period_label(day: Column, frequency: Column) -> Column:
    """``YYYY-MM`` for monthly, ``YYYY-Qn`` for quarterly."""
    return F.when(
        frequency == "Q", F.concat(F.date_format(day, "yyyy"), F.lit("-Q"), F.quarter(day).cast("string"))
    ).otherwise(F.date_format(day, "yyyy-MM"))


def with_period(frame: DataFrame, text: Column, frequency: Column) -> DataFrame:
    """Add period, period_start, period_end read from label text.

    Understands ``2001-03``, ``2001M3``, ``2001:03``, ``2001-Q2`` and ``2001Q2``; the three
    columns are null where the text is no label of its frequency.
    """
    clean = F.regexp_replace(F.upper(F.trim(text)), "[-:]", "")
    month = r"(\d{4})M?(0?[1-9]|1[0-2])$"
    quarter = r"(\d{4})Q([1-4])$"
    start = F.when(
        frequency == "M",
        F.make_date(F.regexp_extract("_label", month, 1).try_cast("int"),
                    F.regexp_extract("_label", month, 2).try_cast("int"), F.lit(1)),
    ).when(
        frequency == "Q",
        F.make_date(F.regexp_extract("_label", quarter, 1).try_cast("int"),
                    F.regexp_extract("_label", quarter, 2).try_cast("int") * 3 - 2, F.lit(1)),
    )
    end = F.when(frequency == "Q", F.last_day(F.add_months("_start", 2))).otherwise(F.last_day("_start"))
    # one projection per step keeps each expression evaluated once
    return frame.withColumn("_label", clean).withColumn("_start", start).withColumns({
        "period": period_label(F.col("_start"), frequency), "period_start": F.col("_start"), "period_end": end,
    }).drop("_label", "_start")


def evaluated(frame: DataFrame) -> DataFrame:
    """Columns are computed once, here: filters further up are not unfolded into their expressions.

    Generated columns stop predicate push-down, which otherwise repeats an expensive parse
    for every condition over its result.
    """
    return frame.select(F.inline(F.array(F.struct(*frame.columns))))


def period_index(period: Column, frequency: Column) -> Column:
    """Running number of a label: months for M, quarters for Q."""
    year = F.substring(period, 1, 4).cast("int")
    return F.when(
        (frequency == "M") & period.rlike(r"^\d{4}-\d{2}$"), year * 12 + F.substring(period, 6, 2).cast("int") - 1
    ).when((frequency == "Q") & period.rlike(r"^\d{4}-Q\d$"), year * 4 + F.substring(period, 7, 1).cast("int") - 1)


def spine(spark: SparkSession, start: date | str, end: date | str, frequency: str = "M",
          column: str = "month_end") -> DataFrame:
    """Natural month ends (or quarter ends) with ``start <= day`` through ``end``'s own month."""
    frame = spark.range(1).select(
        F.explode(F.expr(
            f"sequence(trunc(date'{start}', 'MM'), trunc(date'{end}', 'MM'), interval 1 month)"
        )).alias("m")
    ).select(F.last_day("m").alias(column)).where(F.col(column) >= F.lit(str(start)).cast("date"))
    if frequency.upper() == "Q":
        frame = frame.where(F.month(column) % 3 == 0)
    return frame


def last_index_day(as_of_utc: datetime, frequency: str, zone: str = LOCAL_ZONE) -> date:
    """Last day of the month (quarter) that holds the cutoff in local time."""
    local = as_of_utc.astimezone(ZoneInfo(zone))
    month = local.month if frequency.upper() == "M" else (local.month + 2) // 3 * 3
    following = date(local.year + month // 12, month % 12 + 1, 1)
    return date.fromordinal(following.toordinal() - 1)
