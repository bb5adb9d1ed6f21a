import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F
from docs import words

from vintara.llm import warc

PAGES = "page_id long, url string, html string, record_type string, _id long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], PAGES)


def expected(rows):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = max(j for j, _, g in rows if (g or "").encode() == data)
        again = len(data) >= 1000 and same != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", same if again else None))
    return sorted(out)


def rows():
    long = words(1, 400)
    return [(1, "http://a/", long), (2, "http://b/\r\nX: y", long), (9, None, long), (3, "http://c/", None), (4, "http://d/", ""),
            (5, "http://e/", "short"), (6, "http://f/", "short"), (7, "u", "WARC/1.1\r\n\r\n" * 200), (8, "u", "".join(map(chr, random.Random(1).choices(range(0x4E00, 0x9FFF), k=200_000))))]


def test_round_trip(spark):
    got = warc.round_trip(pages(spark, rows()))
    assert sorted(tuple(r) for r in got.collect()) == expected(rows())


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc")) + "/archive"
    warc.write_archive(warc.archive_records(pages(spark, rows()).repartition(3)), path)
    return path


def test_predicates_reach_the_headers(spark, folder):
    frame = warc.read_archive(spark, folder)
    assert {r.record_id for r in frame.where("record_type = 'revisit'").collect()} == {"urn:vintara:page:1", "urn:vintara:page:2"}
    assert frame.where("target_uri IN ('http://d/', 'none')").count() == 1
    assert frame.where("target_uri LIKE 'http://%' AND content_length > 0 AND record_type <> 'revisit'").count() == 4
    plan = frame.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "record_type" in plan.split("BatchScan")[1] if "BatchScan" in plan else True


def test_only_wanted_payloads_are_inflated(folder, monkeypatch):
    reader = warc.WarcReader({"path": folder})
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload",), b"x")])) == [
        warc.EqualTo(("payload",), b"x")]
    inflated = []
    ensure = warc._Member.ensure
    monkeypatch.setattr(warc._Member, "ensure", lambda self, n: (ensure(self, n), inflated.append(len(self.data)))[0])
    assert sum(len(list(reader.read(p))) for p in reader.partitions()) == 2
    assert max(inflated) < 200_000  # the page of 600,000 bytes was passed over


def test_payload_can_be_left_out(spark, folder):
    frame = warc.read_archive(spark, folder, payload=False)
    assert frame.count() == 9 and frame.where("payload IS NOT NULL").count() == 0


def test_archives_of_other_programs():
    row = dict(record_type="response", record_id="urn:x", date="2024-01-01T00:00:00Z", target_uri="http://a/", payload_digest="sha1:0",
               refers_to=None, http_length=3, payload=b"abc")
    record = warc.record_bytes(row)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 6\r\n\r\na: b\r\n\r\n\r\n"
    for stream in (record * 2, gzip.compress(record) * 2, warc.member(record) + gzip.compress(record), info + record + info + record):
        got = list(warc.records(io.BytesIO(stream), lambda h: h["warc-type"] == "response"))
        assert [(g[0], g[-1]) for g in got] == [("urn:x", b"abc")] * 2
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(record[:-20]), lambda h: True))


def test_manifest_hides_files_of_lost_attempts(spark, folder):
    with open(f"{folder}/stray.warc.gz", "wb") as file:
        file.write(b"broken")
    assert warc.read_archive(spark, folder).count() == 9


def test_appends_join_and_overwrites_replace(spark, tmp_path):
    path = str(tmp_path / "archive")
    one, two = (warc.archive_records(pages(spark, part)) for part in (rows()[:2], rows()[3:5]))
    warc.write_archive(one, path)
    warc.write_archive(two, path)
    ids = lambda: sorted(r.record_id[-1] for r in warc.read_archive(spark, path).select("record_id").collect())
    assert ids() == ["1", "2", "3", "4"]
    two.write.format("vintara_warc").mode("overwrite").option("path", path).save()
    assert ids() == ["3", "4"]
    assert len(list((tmp_path / "archive").glob("*.warc.gz"))) == len((next((tmp_path / "archive").glob(warc.MANIFEST + "*"))).read_text().split())


def test_a_write_that_fails_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path / "archive")
    good = warc.archive_records(pages(spark, rows()[:2]))
    with pytest.raises(Exception, match="stopped"):
        warc.write_archive(good.unionByName(good.where(F.raise_error(F.lit("stopped")).isNull())).repartition(4), path)
    warc.write_archive(good, path)
    assert warc.read_archive(spark, path).count() == 2


def test_round_trip_inflates_responses_only(spark):
    plan = warc.round_trip(pages(spark, rows()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 2
