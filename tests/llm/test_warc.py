import gzip

import pytest
from pyspark.sql import functions as F

from storeloom.llm import warc
from storeloom.llm.common import shared_folder

PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, None), (4, "http://b/é\r\nx", ""),
         (5, "http://b/5", "é🙂" * 2000), (6, "http://b/6", "same"), (7, "http://c/7", "x\r\n\r\ny"),
         (None, "http://c/8", "same"), (None, "http://c/9", "alone"), (9, "http://c/9", "alone2"),
         (9, "http://c/9", "alone2")]


@pytest.fixture(scope="module")
def folder(spark):
    warc.register(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    out = shared_folder(spark, "warc-test")
    warc.with_revisits(pages).write.format("warc").mode("append").save(out)
    return out


def read(spark, folder, **options):
    return spark.read.format("warc").options(**options).load(folder)


def test_round_trip(spark, folder):
    rows = read(spark, folder).select(warc.page_of("record_id").alias("page"), "*").collect()
    assert len(rows) == len(PAGES)
    by = {r.page: r for r in rows if r.page is not None}
    for i, _, html in PAGES:
        if i is None:
            continue
        body, r = (html or "").encode(), by[i]
        assert r.payload_length == len(body) and r.payload_digest == warc.digest_of(body)
        assert r.payload == (body if r.record_type == "response" else None)
    assert {i: by[i].refers_to for i in by if by[i].record_type == "revisit"} == {
        2: "urn:page:1", 6: "urn:page:1", 4: "urn:page:3"}
    unknown = sorted((r.record_type, r.refers_to or "") for r in rows if r.page is None)
    assert unknown == [("response", ""), ("revisit", "urn:page:1")]
    assert by[4].target_uri == "http://b/%C3%A9%0D%0Ax" and by[3].target_uri is None


def test_least_size(spark):
    pages = spark.createDataFrame(PAGES[:3] + PAGES[5:6], "page_id long, url string, html string")
    kinds = {r.record_type for r in warc.with_revisits(pages, least=5).collect()}
    assert kinds == {"response"}


def test_filters_reach_the_reader(spark, folder):
    df = read(spark, folder).where("record_type = 'revisit' and target_uri like 'http://b/%'")
    assert [r.record_id for r in df.select("record_id").orderBy("record_id").collect()] == [
        "urn:page:4", "urn:page:6"]
    reader = warc.WarcReader({"path": folder})
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    kept = [EqualTo(("record_type",), "revisit"), In(("record_id",), ("urn:page:2", "urn:page:5")),
            StringStartsWith(("target_uri",), "http://a")]
    other = GreaterThan(("payload_length",), 3)
    assert list(reader.pushFilters([*kept, other])) == [other]
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["record_id"] for r in rows] == ["urn:page:2"]


def test_payloads_can_be_left_out(spark, folder):
    rows = read(spark, folder, payload="false").collect()
    assert all(r.payload is None for r in rows)
    assert {r.payload_length for r in rows} == {len((h or "").encode()) for _, _, h in PAGES}


def test_skipping_does_not_read_payloads(tmp_path):
    import os

    noise = os.urandom(300_000)
    path = tmp_path / "big.warc.gz"
    with open(path, "wb") as f:
        for k in range(4):
            f.write(warc.member_bytes(warc.record_bytes(
                {"record_id": f"urn:{k}", "record_type": "response", "payload": noise})))
    seen = []
    for record in warc._records(str(path)):
        seen.append((record.headers["warc-record-id"], len(record.plain) < 10_000))
    assert seen == [(f"<urn:{k}>", True) for k in range(4)]


def test_other_archives(spark, tmp_path):
    records = [warc.record_bytes({"record_id": f"urn:{k}", "record_type": "response", "payload": b"p" * k})
               for k in range(5)]
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / ".hidden.warc").write_bytes(b"nothing")
    warc.register(spark)
    rows = read(spark, str(tmp_path)).collect()
    assert sorted(r.payload_length for r in rows) == sorted([0, 1, 2, 3, 4] * 2)
    (tmp_path / "bad.warc").write_bytes(records[4].replace(b"pppp", b"pppq"))
    with pytest.raises(Exception, match="damaged"):
        read(spark, str(tmp_path)).collect()


def test_lengths_without_an_http_length(spark, tmp_path):
    """Records of other writers: chunked payloads, long HTTP headers, none, and no blank line at all."""
    def record(k, block):
        return (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:{k}>\r\nContent-Type: application/http\r\n"
                f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    long_head = b"HTTP/1.1 200 OK\r\nX: " + b"y" * 150_000 + b"\r\n\r\n"
    blocks = [chunked + b"p" * 9000, chunked + b"a\r\n\r\nb" * 20_000, long_head + b"q" * 70_000, long_head,
              b"HTTP/1.1 200 OK" + b"z" * 5000, b"", b"HTTP/1.1 200 OK\r\nContent-Length: 12345\r\n\r\n" + b"r" * 12345]
    want = {f"urn:{k}": len(b.partition(b"\r\n\r\n")[2]) for k, b in enumerate(blocks)}
    records = [record(k, b) for k, b in enumerate(blocks)]
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain/a.warc").write_bytes(b"".join(records))
    (tmp_path / "members").mkdir()
    (tmp_path / "members/a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "own").mkdir()
    (tmp_path / "own/a.warc.gz").write_bytes(b"".join(map(warc.member_bytes, records)))
    warc.register(spark)
    for name in ("plain", "members", "own"):
        for payload in ("true", "false"):
            rows = read(spark, str(tmp_path / name), payload=payload).collect()
            assert {r.record_id: r.payload_length for r in rows} == want
            assert all((r.payload is None) == (payload == "false") for r in rows)


def test_empty(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    out = shared_folder(spark, "warc-empty")
    warc.with_revisits(pages).write.format("warc").mode("append").save(out)
    assert read(spark, out).where(F.col("record_type") == "response").count() == 0
