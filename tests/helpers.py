"""Row builders and comparisons."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timezone

from vintara.schema import OBSERVATION_VINTAGE


def utc(text: str) -> datetime:
    value = datetime.fromisoformat(text)
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def last_day(year: int, month: int) -> date:
    following = date(year + month // 12, month % 12 + 1, 1)
    return date.fromordinal(following.toordinal() - 1)


def observation(period="2020-01", value=1.0, grade="A", available="2020-02-10 01:00:00", *, series="CN_X", source="OFF",
                country="CN", marker="official_page_date", first_seen=None, url="https://a/1", sha="abc", vintage_no=0,
                revision_type="initial", delta=None, unit="pct", frequency=None, name="X", seq=0, release=...):
    """One full observation row; times are UTC text."""
    year = int(period[:4])
    if "Q" in period:
        end_month, start_month, frequency = int(period[-1]) * 3, int(period[-1]) * 3 - 2, frequency or "Q"
    else:
        end_month = start_month = int(period[5:7])
        frequency = frequency or "M"
    at = utc(available)
    seen = utc(first_seen) if first_seen else at
    released = (at if grade != "D" else None) if release is ... else (utc(release) if release else None)
    row = dict(
        country=country, source=source, canonical_series_id=series, source_series_id="S1", series_name=name,
        frequency=frequency, unit=unit, seasonal_adjustment=None, period=period, period_start=date(year, start_month, 1),
        period_end=last_day(year, end_month), value=float(value), release_at=released,
        release_date_source=marker, first_seen_at=seen, available_at=at, vintage_no=vintage_no,
        revision_type=revision_type, revision_delta=delta, pit_grade=grade, source_url=url, raw_file="raw/1",
        raw_sha256=sha, retrieved_at=seen, parser_version="v1")
    return row | {"ingest_seq": seq}


def frame(spark, rows, sequence: bool = True):
    from pyspark.sql import types as T
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in OBSERVATION_VINTAGE],
                           *([T.StructField("ingest_seq", T.LongType(), True)] if sequence else [])])
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)


def bag(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return Counter(tuple(r) for r in rows)
