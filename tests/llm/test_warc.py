import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from paneflow.llm import warc

PAGES = "page_id long, url string, html string"


def brute(rows):
    first, out = {}, []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    for page_id, _, html in order:
        body = (html or "").encode()
        old = len(body) >= 100 and body in first
        out.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if old else "response", first[body] if old else None))
        first.setdefault(body, page_id)
    return sorted(out, key=repr)


def told(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.fixture
def odd_pages(spark):
    long = "<p>ünï</p>" * 30
    rows = [
        (5, "http://b/ x\r\ny", long), (3, "http://a", long), (3, "http://a", long), (3, "http://0", long), (None, "http://n", long), (None, None, long),
        (7, None, None), (8, "u", ""), (9, "v", "short"), (10, "w", "short"), (10, "w", "short"), (11, "x", "y" * 3_000_000),
        (12, "x", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9), (13, "z", "q" * 99), (14, "z", "q" * 99), (15, "z", "q" * 100), (16, "z", "q" * 100),
    ]
    return spark.createDataFrame(rows, PAGES)


def test_pages_come_back(spark, odd_pages):
    rows = [tuple(r) for r in odd_pages.collect()]
    clashing = odd_pages.selectExpr("*", "1 as n", "'x' as digest", "2 as payload", "3 as base").repartition(3)
    assert told(warc.archived(clashing)) == brute(rows)
    assert warc.archived(odd_pages.limit(0)).count() == 0


def test_many_copies_of_one_row(spark, monkeypatch):
    same = spark.range(600).selectExpr("4L as page_id", "'u' as url", "repeat('copy ', 50) as html")
    more = spark.range(600).selectExpr("id + 1 as page_id", "'u' as url", "repeat('copy ', 50) as html")
    pages = same.union(more)
    assert told(warc.archived(pages)) == brute([tuple(r) for r in pages.collect()])


def test_archives_are_plain_zstandard_with_a_seek_table(spark, tmp_path):
    pages = spark.range(40).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(concat('row ', id, ' '), 10000 + 3000 * (id % 5)) as html")
    folder = str(tmp_path / "w")
    index = warc.write_archives(warc.records(pages.coalesce(1)), folder)
    rows = index.collect()
    assert len(rows) == 40 and len({r.record_id for r in rows}) == 40 and len({(r.archive, r.frame) for r in rows}) > 2
    for path in {r.archive for r in rows}:
        raw = open(path.removeprefix("file://"), "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        with warc.opened(path)[0].open_input_file(warc.opened(path)[1]) as archive:
            frames = warc.seek_table(archive)
            assert b"".join(warc.frame(archive, offset, packed) for offset, packed, _ in frames) == whole
        for r in (r for r in rows if r.archive == path):
            offset, packed, size = frames[r.frame]
            assert (offset, packed) == (r.frame_offset, r.frame_bytes) and r.record_offset + r.record_bytes <= size
    # single records by their identifiers
    wanted = index.filter("record_id like 'urn:page:17:%' or record_id like 'urn:page:30:%'")
    got = {r.page_id: bytes(r.payload).decode() for r in warc.fetch_records(index, wanted.withColumn("x", F.lit(1))).collect()}
    assert got == {r.page_id: r.html for r in pages.filter("page_id in (17, 30)").collect()}


def test_damage_is_an_error():
    record = warc.record_bytes("urn:page:1:x:y:0", None, b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    ((headers, n, payload),) = warc.parsed(record)
    assert warc.described(headers, n, payload)[1:5] == (1, None, "response", 7)
    with pytest.raises(ValueError, match="damaged"):
        warc.described(headers, n, b"paxload")
