import base64
import hashlib
import io
import zipfile
import zlib

import pytest

from spanlake.llm import warc, zips


def reader(data):
    return lambda at, n: data[at : at + n]


def built(zip64):
    out = io.BytesIO()
    w = zips.Writer(out, zip64)
    for name, parts in (("a/β.txt", [b"hello ", b"world"]), ("empty", []), ("b", [bytes(100000)])):
        w.open(name)
        for p in parts:
            w.write(p)
        w.end()
    w.close()
    return out.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
def test_written_archives_open_elsewhere_and_here(zip64):
    data = built(zip64)
    z = zipfile.ZipFile(io.BytesIO(data))
    assert z.testzip() is None and z.read("a/β.txt") == b"hello world"
    members = zips.directory(reader(data), len(data))
    assert [(m.name, m.size) for m in members] == [("a/β.txt", 11), ("empty", 0), ("b", 100000)]
    for m in members:
        at = m.data_at(reader(data))
        assert data[at : at + m.size] == z.read(m.name) and zlib.crc32(z.read(m.name)) == m.crc


def test_foreign_archives():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.comment = b"PK\x05\x06 a comment that looks like an end" * 20
        with z.open("big", "w", force_zip64=True) as f:
            f.write(b"x" * 5000)
        z.writestr("two", b"yy")
    data = out.getvalue()
    got = {m.name: data[m.data_at(reader(data)) :][: m.size] for m in zips.directory(reader(data), len(data))}
    assert got == {"big": b"x" * 5000, "two": b"yy"}


def test_broken_archives():
    data = built(True)
    for bad in (b"", b"PK", data[:-1], data[:50], data[:-60] + bytes(60)):
        with pytest.raises(ValueError):
            zips.directory(reader(bad), len(bad))
    with pytest.raises(ValueError):
        warc.entries(reader(data), len(data))


def test_records():
    for args in ((5, "http://x/é", b"<p>\r\n\r\n</p>"), (None, None, b""), (5, "u\r\nX: y", b"z" * 10, 9)):
        r = warc.parse(warc.record(*args))
        assert (r["page_id"], r["payload_bytes"], r["refers_to"]) == (args[0], len(args[2]), args[3] if len(args) > 3 else None)
        assert r["payload"] == (None if len(args) > 3 else args[2])
    raw = warc.record(1, "u", b"payload")
    for bad in (raw[:-9], b"junk", raw.replace(b"payload", b"paYload")):
        with pytest.raises(ValueError):
            warc.parse(bad)


def brute(rows, least):
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == p and j is not None]
        revisit = len(p) >= least and same and i != max(same)
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, least):
    rows = [(i, f"http://h/{i}", ["same", "<p>é</p>", f"page {i}", None, "", "x" * 200000][i % 6]) for i in range(60)]
    rows += [(None, None, "same"), (None, "u", "nobody else"), (7, "again", "<p>é</p>"), (2, "http://h/2", "page 2")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).selectExpr("*", "1 AS path", "2 AS sum")
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df, least=least).collect()]
    assert sorted(got, key=str) == brute(rows, least)


def test_many_archives_and_payloads(spark, tmp_path):
    rows = [(i, "u", f"text {i} " * 50) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write(warc.plan(df), f"file://{tmp_path}/w", most=300, zip64=False)
    assert archives.count() > 5 and sum(r.records for r in archives.collect()) == 40
    assert {(r.page_id, bytes(r.payload).decode()) for r in warc.read(archives).collect()} == {(i, h) for i, _, h in rows}
    assert not [p for p in (tmp_path / "w").iterdir() if p.suffix == ".part"]
    assert warc.round_trip(df.limit(0)).count() == 0
