import gzip
import hashlib

import pytest

from tessera.llm import warc as A

ROWS = [(1, "http://a.example/1", "x" * 1500), (5, "http://a.example/b c", "x" * 1500), (3, None, "x" * 1500), (7, "u", "y" * 999), (8, "u", "y" * 999),
        (None, "q", None), (None, "z", "x" * 1500), (9, "é", "\r\n\r\nWARC/1.1\r\nfoo\n"), (10, "http://s", "é" * 500), (11, "http://s", "é" * 500), (11, "http://s", "é" * 500),
        (12, "t", ""), (13, "t", "z" * 300_000)]


def expected(rows):
    best = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 1000:
            best[html] = max(best.get(html, -1), -1 if page is None else page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        top = best.get(html)
        revisit = top is not None and top >= 0 and page != top
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 4])
def test_round_trip(spark, tmp_path, parts):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(parts).selectExpr("*", "1 as record", "2 as payload")
    A.write_arc(pages, f"{tmp_path}/arc")
    A.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    got = A.read_warcs(spark, f"{tmp_path}/warc").collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == expected(ROWS)
    assert {r["record_date"] for r in got} == {"2001-02-03T04:05:06Z"}
    assert "http://a.example/b%20c" in {r["target"] for r in got}


def test_empty_table(spark, tmp_path):
    A.write_arc(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/arc")
    A.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    assert A.read_warcs(spark, f"{tmp_path}/warc").count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_and_gzip_members(version):
    parts = [A.arc_version_block(version, "f.arc")] + [A.arc_record(version, "f.arc", p, u, h) for p, u, h in ROWS]
    plain = b"\n".join(parts) + b"\n"
    members = b"".join(gzip.compress(p + b"\n") for p in parts)
    for data in (plain, gzip.compress(plain), members):
        got = list(A.read_arc(data))
        assert [(r["page_id"], r["payload"].decode()) for r in got] == [(p, h or "") for p, _, h in ROWS]


def test_damage_is_noticed():
    data = A.arc_version_block(1, "f") + b"\n" + A.arc_record(1, "f", 1, "u", "text")[:-2]
    with pytest.raises(ValueError, match="truncated"):
        list(A.read_arc(data))
    with pytest.raises(ValueError, match="not an ARC"):
        list(A.read_arc(b"http://x 1 2 3 3\n9 0\n\n"))
    record = A.warc_record(dict(next(A.read_arc(A.arc_version_block(2, "f") + b"\n" + A.arc_record(2, "f", 1, "u", "text"))), refers_to=None)) + b"\r\n\r\n"
    assert [r["page_id"] for r in A.read_warc(record)] == [1]
    with pytest.raises(ValueError, match="differs"):
        list(A.read_warc(record.replace(b"text\r\n", b"tExt\r\n")))


def test_headers_of_the_standard():
    r = next(A.read_arc(A.arc_version_block(1, "f") + b"\n" + A.arc_record(1, "f", 1, "http://u/", "text")))
    head = A.warc_record(r | {"refers_to": 9, "refers_url": "http://v/", "refers_date": "2001"}).decode()
    for line in ("WARC/1.1", "WARC-Type: revisit", "WARC-Date: 2001-02-03T04:05:06Z", f"WARC-Profile: {A.REVISIT_PROFILE}", "WARC-Refers-To-Date: 2001-01-01T00:00:00Z"):
        assert line in head.split("\r\n")
