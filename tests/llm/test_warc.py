import gzip
import hashlib
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from understory.llm import warc


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200), st.integers(1, 30))
def test_chunks_round_trip(text, size):
    payload = text.encode()
    assert warc.unchunked(warc.chunked(payload, size)) == payload
    assert b"".join(warc._cut(payload, size)) == payload
    for part in warc._cut(payload, max(4, size)):
        part.decode()


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip_with_segments_and_revisits(spark, tmp_path):
    big, same, crlf = "é" * 5000 + "\r\n\r\nWARC/1.1\r\n" + "x" * 300, "s" * 150, "<p>\r\n\r\n\r\n" * 30 + "\r\n"
    rows = [(5, "http://a/ b", same), (2, None, same), (9, "u", same), (1, "u", big), (3, "u", None), (4, "u", ""), (6, "u", "t"), (7, "u", "t"), (8, "u", crlf), (2, None, same), (None, "u", same), (None, None, None)]
    path = str(tmp_path / f"w{uuid.uuid4().hex}")
    warc.write(pages(spark, rows).repartition(3), path, segment=700)
    got = warc.read(spark, path).collect()
    assert len(got) == len(rows)
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        refers = 2 if len(data) >= 100 and html == same and page != 2 else None
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers else "response", refers))
    key = lambda r: (r[0] or -1, r[1], r[3])
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert next(r["segments"] for r in got if r["page_id"] == 1) > 10
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / path).glob("*.gz")))
    assert raw.startswith(b"WARC/1.1\r\n") and raw.count(b"WARC-Type: continuation") > 10 and b"WARC-Segment-Total-Length" in raw


def test_missing_segments_and_wrong_digests_are_errors(spark, tmp_path):
    rows = [(1, "u", "abc " * 900)]
    records = list(warc.records(1, "u", rows[0][2].encode(), hashlib.sha256(rows[0][2].encode()).hexdigest(), None, "k", 1000))
    assert len(records) == 4
    for name, kept in (("gone", records[:2] + records[3:]), ("last", records[:3]), ("bad", [r.replace(b"abc ", b"abd ", 1) for r in records])):
        path = tmp_path / name
        path.mkdir()
        (path / "a.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in kept)))
        with pytest.raises(Exception, match="lacks segments|differs"):
            warc.read(spark, str(path)).collect()


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write(pages(spark, []), path)
    assert warc.read(spark, path).count() == 0
