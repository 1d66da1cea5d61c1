import base64
import gzip
import hashlib

import pytest

from gramrank.llm import warc as A


def test_dates():
    assert A.warc_date("20240102030405") == "2024-01-02T03:04:05Z"
    assert A.warc_date("2024") == "2024-01-01T00:00:00Z"
    assert A.warc_date("1999123123") == "1999-12-31T23:00:00Z"


FIRST = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length"
SECOND = b"2 0 x\nfields"


def arc(version, *records):
    head = SECOND if version == 2 else FIRST
    middle = b"200 - - 0 f " if version == 2 else b""
    out = b"filedesc://f 0.0.0.0 2024 text/plain " + middle + b"%d\n%s\n" % (len(head), head)
    for url, block in records:
        out += url + b" 1.2.3.4 2024 text/html " + middle + b"%d\n%s\n" % (len(block), block)
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_header_lines_of_both_versions(version):
    records = [(b"http://a/ b", b"x\ny\n"), (b"http://c/", b""), (b"d", b"\n\nfiledesc://no")]
    found = list(A.parse_arc(arc(version, *records) + arc(3 - version, (b"e", b"f"))))
    assert [r.block for r in found] == [b for _, b in records] + [b"f"]
    assert [r.header["url"] for r in found] == ["http://a/ b", "http://c/", "d", "e"]
    assert found[0].header["ip"] == "1.2.3.4"


@pytest.mark.parametrize("content", [arc(1, (b"a", b"long"))[:-3], b"a b c\nx", b"no end"])
def test_broken_archives_are_an_error(content):
    with pytest.raises(ValueError):
        list(A.parse_arc(content))


def test_compressed_members_are_joined():
    assert A.unpacked(gzip.compress(b"a") + gzip.compress(b"b")) == b"ab"
    assert A.unpacked(b"plain") == b"plain"


def test_http_parts():
    assert A.http_parts(b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\r\n\r\n")[1] == b"body\r\n\r\n"
    assert A.http_parts(b"bare") == (b"", b"bare")


PAGES = [
    (5, "http://a/", "<p>one</p>"),
    (3, "http://b/ x\ny", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (1, "http://c/", None),
    (2, "http://d/", ""),
    (7, "", "WARC/1.1\r\n\r\nfiledesc://x\n1 0\r\n\r\n é"),
    (7, "http://e/", "other under the same id"),
    (8, "http://f/", "x" * 300_000),
    (None, "http://g/", "no id"),
    (20, "http://h/", "twice"),
    (20, "http://h/", "twice"),
]


def expected(pages):
    rows = []
    for page_id, _, html in pages:
        payload = (html or "").encode()
        same = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = page_id is not None and page_id != first
        rows.append(
            (page_id, len(payload), digest, "revisit" if revisit else "response", first if revisit else None)
        )
    return rows


def test_pages_come_back(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = [tuple(r) for r in A.convert_pages(df.selectExpr("*", "url as value")).collect()]
    want = expected(PAGES)
    want[-1] = (*want[-1][:3], "revisit", 20)  # of equal rows one is the response
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_small_payloads_may_stay_responses(spark):
    df = spark.createDataFrame(PAGES[:5], "page_id long, url string, html string")
    kinds = {r["page_id"]: r["record_type"] for r in A.convert_pages(df, min_bytes=5).collect()}
    assert kinds == {5: "revisit", 3: "response", 9: "revisit", 1: "response", 2: "response"}


def test_records_are_complete(spark, tmp_path):
    df = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")
    A.write_arc(df, str(tmp_path / "arc"))
    records = A.to_warc(A.read_arc(spark, str(tmp_path / "arc"))).collect()
    ids = set()
    for row in records:
        (head, block), *more = A.parse_warc(row["value"].encode() + b"\r\n\r\n")
        assert not more
        for name in ("WARC-Type", "WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest"):
            assert A._header(head, name)
        ids.add(A._header(head, "WARC-Record-ID"))
        assert int(A._header(head, "Content-Length")) == len(block)
    assert len(ids) == 3
    refers = {A._header(r["value"].encode(), "WARC-Refers-To") for r in records} - {None}
    assert len(refers) == 1 and refers < ids


def test_empty_table(spark):
    assert A.convert_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
