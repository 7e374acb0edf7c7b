"""The archives: exact round trips, members, index, duplicates."""

import base64
import gzip
import hashlib
import zlib
from collections import Counter

import duckdb
import pytest
from pyarrow import fs

from tarmac.llm import warc
from tarmac.llm.queries import ORACLES, QUERIES
from tarmac.sources.session import fresh_path

FOLDER = "/root/testdata/sf0.001"
PAGES = [
    (1, "http://a.example/1", "<p>one</p>"),
    (2, "http://a.example/a b\r\nX: y", "<p>one</p>"),
    (3, None, "<p>" + "long text \r\n\r\n WARC/1.1 " * 200_000),
    (4, "", None),
    (5, "http://b.example/é", ""),
    (6, "http://b.example/", "<p>Zürich</p>"),
    (6, "http://b.example/", "<p>Zürich</p>"),
    (None, "http://b.example/", "<p>none</p>"),
    (None, None, None),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' as payload", "1 as row", "'y' as sha1"
    )


def expected(rows, min_bytes=0):
    out, by = Counter(), {}
    for i, (page, _, html) in enumerate(rows):
        by.setdefault(html or "", []).append((page is not None, page or 0, i, page))
    for i, (page, _, html) in enumerate(rows):
        raw = (html or "").encode()
        first = max(by[html or ""])
        again = len(raw) >= min_bytes and first[2] != i
        sha1 = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        kind = "revisit" if again else "response"
        out[page, len(raw), sha1, kind, first[3] if again else None] += 1
    return out


@pytest.mark.parametrize(("min_bytes", "archive_bytes"), [(0, 1 << 26), (11, 100)])
def test_round_trip_of_awkward_pages(spark, min_bytes, archive_bytes):
    got = warc.round_trip(pages(spark), min_bytes, archive_bytes).collect()
    found = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got
    )
    assert found == expected(PAGES, min_bytes)
    bodies = {(h or "").encode() for _, _, h in PAGES}
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == bodies
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_every_record_is_a_member_of_its_own(spark):
    raw, single = fresh_path(spark, "streams"), fresh_path(spark, "members")
    archives = warc.write_archives(warc.with_records(pages(spark).coalesce(1)), raw)
    index = warc.normalise(archives, raw, single).collect()
    system, base = fs.FileSystem.from_uri(single)
    for name in {r.archive for r in index}:
        own = sorted((r.offset, r.length, r.record_id) for r in index if r.archive == name)
        with system.open_input_stream(f"{base}/{name}", compression=None) as f:
            data = f.read()
        at = 0
        for offset, length, key in own:
            assert offset == at
            member = zlib.decompressobj(warc.GZIP)
            text = member.decompress(data[offset : offset + length])
            assert member.eof and not member.unused_data
            assert text.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {key}\r\n".encode() in text
            at += length
        assert at == len(data)
        with system.open_input_stream(f"{base}/{name}.index", compression=None) as f:
            lines = f.read().decode().splitlines()
        assert sorted(lines) == sorted(f"{o}\t{n}\t{k}" for o, n, k in own)


def test_streams_of_one_and_many_members_read_alike():
    text = b"".join(
        warc.record(i, None, b"x" * i, warc.digest(b"x" * i), None, False) for i in range(50)
    )
    import io

    for data in (gzip.compress(text), gzip.compress(text[:999]) + gzip.compress(text[999:])):
        assert b"".join(warc.inflated(io.BytesIO(data))) == text
    with pytest.raises(EOFError):
        list(warc.inflated(io.BytesIO(gzip.compress(text)[:-20])))


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{FOLDER}/pages.parquet'")
    want = con.sql(ORACLES["op2_warc_normalise"])
    got = QUERIES["op2_warc_normalise"](spark, FOLDER).select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())
