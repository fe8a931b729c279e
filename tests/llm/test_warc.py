"""Web archives: files read back, revisits resolved as in SQL and in odd cases."""

from datetime import datetime

import duckdb
import pytest

from panelloom.llm import warc

DATA = "/root/testdata/sf0.001/pages.parquet"
KIND = "record_id long, kind string, url string, captured_at timestamp, status int, headers map<string,string>, digest string, payload string"


def test_report_matches_sql(spark):
    out = warc.revisit_report(spark.read.parquet(DATA))
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{DATA}'")
    sql = duck.sql(warc.ORACLE)
    columns = sorted(out.columns)
    assert sorted(sql.columns) == columns
    ours = sorted(tuple(str(r[c]) for c in columns) for r in out.collect())
    assert ours == sorted(tuple(str(r[sql.columns.index(c)]) for c in columns) for r in sql.fetchall())


def test_as_of_rules(spark):
    at = lambda h, s=0: datetime(2024, 1, 1, h, 0, s)

    def record(number, kind, url, when, status=200, headers=None, digest=None, payload=None):
        return (number, kind, url, when, status, headers or {}, digest, payload)

    rows = [
        record(1, "response", "http://www.A.com:80/p?b=2&a=1", at(1), headers={"etag": '"x"', "content-type": "t", "date": "old"}, payload="one"),
        record(2, "response", "https://a.com/p?a=1&b=2", at(5), headers={"etag": '"y"'}, payload="two"),
        record(3, "response", "https://a.com/p?a=1&b=2", at(5, 1), 500, payload="error"),
        record(4, "response", "https://a.com/p?a=1&b=2", at(5), headers={"etag": '"z"'}, payload="tie"),
        record(10, "revisit", "http://a.com/p?a=1&b=2&utm_source=q#f", at(2), 304, {"etag": 'W/"x"', "date": "new", "content-type": "u"}),
        record(11, "revisit", "http://a.com/p?a=1&b=2", at(5), 304, {"etag": '"x"'}),
        record(12, "revisit", "http://a.com/p?a=1&b=2", at(5, 2), 304, {"etag": '"z"'}),
        record(13, "revisit", "http://a.com/p?a=1&b=2", at(1), 304, {"etag": '"x"'}),
        record(14, "revisit", None, at(9), 304),
        record(15, "revisit", "http://a.com/p?a=1&b=2", None, 304),
        record(16, "revisit", "http://a.com/p?a=1&b=2", at(9), 304),
        record(17, "revisit", "http://a.com/p?a=1&b=2", at(9), 304, {"etag": '"q"'}),
    ]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS at", "2 AS bucket")
    out = {r.record_id: r for r in warc.resolve_revisits(df).collect()}
    assert len(out) == 8
    assert (out[10].outcome, out[10].response_id, out[10].payload) == ("resolved", 1, "one")
    assert out[10].headers == {"etag": 'W/"x"', "content-type": "t", "date": "new"}
    assert (out[11].outcome, out[11].response_id) == ("resolved", 1)
    assert (out[12].outcome, out[12].response_id, out[12].payload) == ("resolved", 4, "tie")
    assert [out[k].outcome for k in (13, 14, 15, 16, 17)] == ["missing", "missing", "missing", "unverified", "changed"]
    assert out[17].payload is None and out[17].headers is None
    assert warc.resolve_revisits(df.limit(0)).collect() == []


def test_files(spark, tmp_path):
    records = warc.captures(spark.read.parquet(DATA).limit(40))
    warc.write_warc(records, str(tmp_path / "w"))
    back = {r.record_id: r for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    for r in records.collect():
        b = back.pop(r.record_id)
        assert (b.kind, b.url, b.captured_at, b.status, b.headers, b.payload, b.broken) == (r.kind, r.url, r.captured_at, r.status, r.headers, r.payload or "", None)
    assert not back


def test_broken_records_are_named(spark, tmp_path):
    import gzip

    good = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:7>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    block = "HTTP/1.1 200 OK\r\nA: 1\r\na: 2\r\n\r\nhé"
    body = good.format(len(block.encode()), block).encode() + good.format(999, "x").encode()
    (tmp_path / "f.warc.gz").write_bytes(gzip.compress(body[:40]) + gzip.compress(body[40:]))
    rows = sorted(warc.read_warc(spark, str(tmp_path)).collect(), key=lambda r: r.broken or "")
    assert (rows[0].payload, rows[0].headers, rows[0].status) == ("hé", {"a": "1, 2"}, 200)
    assert rows[1].broken == "shorter than its length"


def record(uri, block, date="2020-01-01T00:00:00Z", more="", length=None):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{uri}>\r\nWARC-Date: {date}\r\n{more}Content-Length: {len(block) if length is None else length}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nA: 1\r\n\r\n"


@pytest.mark.parametrize("split", [1 << 27, 700])
def test_content_ends_where_its_length_says(spark, tmp_path, split):
    """Archives within archives, bytes that are no text, and a length that points nowhere."""
    inner = record("urn:uuid:in-1", HTTP + b"one") + record("urn:uuid:in-2", HTTP + bytes(range(256)))
    blocks = [HTTP + bytes(range(256)) * 3, HTTP + inner, HTTP, inner, HTTP + "h\u00e9".encode()] * 3
    whole = b"".join(record(f"urn:uuid:{k}", b) for k, b in enumerate(blocks))
    wrong = record("urn:uuid:long", HTTP + b"x", length=5000)
    (tmp_path / "a.warc").write_bytes(whole + wrong + record("urn:uuid:last", HTTP + inner)[:-4])
    (tmp_path / "b.warc").write_bytes(record("urn:uuid:b", HTTP + b"plain"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = {r.record_uri: r for r in warc.read_warc(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for k, block in enumerate(blocks):
        r = rows.pop(f"urn:uuid:{k}")
        content = block[len(HTTP) :] if block.startswith(HTTP) else block
        assert (bytes(r.payload_bytes), r.broken, r.record_id) == (content, None, None)
        assert r.headers == ({"a": "1"} if block.startswith(HTTP) else {}) and (r.payload is None) == (bytes([255]) in content)
    assert rows.pop("urn:uuid:long").broken == "shorter than its length"
    assert bytes(rows.pop("urn:uuid:last").payload_bytes) == inner and rows.pop("urn:uuid:b").payload == "plain"
    assert not rows


def test_dates(spark, tmp_path):
    dates = ["2020-01-01T00:00:00.123Z", "2020-01-01T00:00:00.123456789Z", "2020-01-01T02:00:00+02:00", "2020-01-01", "2020-01-01T00:00:00", "soon"]
    (tmp_path / "a.warc").write_bytes(b"".join(record(d, HTTP, d) for d in dates))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        found = warc.read_warc(spark, str(tmp_path))
        micros = {r.record_uri: r.at for r in found.selectExpr("record_uri", "unix_micros(captured_at) AS at").collect()}
        warc.write_warc(found, str(tmp_path / "w"))
        again = warc.read_warc(spark, str(tmp_path / "w"))
        assert {r.record_uri: r.at for r in again.selectExpr("record_uri", "unix_micros(captured_at) AS at").collect()} == micros
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    first = 1_577_836_800_000_000
    assert list(map(micros.get, dates)) == [first + 123_000, first + 123_456, first, first, first, None]


def test_revisits_by_other_ids(spark):
    """Ids that are texts or NULL; rows of one id with different URLs."""
    at = lambda h: datetime(2024, 1, 1, h)
    rows = [
        ("urn:a", "response", "http://a.com/", at(1), 200, {"etag": "x"}, None, "a"),
        (None, "response", "http://b.com/", at(1), 200, {"etag": "y"}, None, "b"),
        (None, "revisit", "http://a.com/", at(2), 304, {"etag": "x"}, None, None),
        (None, "revisit", "http://b.com/", at(2), 304, {"etag": "y"}, None, None),
        ("urn:c", "revisit", "http://c.com/", at(2), 304, {"etag": "x"}, None, None),
        ("urn:c", "revisit", "http://a.com/", at(3), 304, {"etag": "x"}, None, None),
    ]
    df = spark.createDataFrame(rows, KIND.replace("record_id long", "record_id string"))
    out = sorted(((r.url, r.record_id or "", r.outcome, r.response_id, r.payload) for r in warc.resolve_revisits(df).collect()))
    assert out == [
        ("http://a.com/", "", "resolved", "urn:a", "a"),
        ("http://a.com/", "urn:c", "resolved", "urn:a", "a"),
        ("http://b.com/", "", "resolved", None, "b"),
        ("http://c.com/", "urn:c", "missing", None, None),
    ]
