"""WARC records in ZIP-packaged archives.

Each task writes archives of its own: a ZIP with one stored member of gzipped WARC records and a stored index of their
places. A reader opens an archive by its central directory (ZIP64 or not), finds both members, and reads records by
ranges, nothing is extracted. Archives are written under the shared folder, each under a name of its own, and only
those that a finished task reports are read, so a lost executor's half-written files are never seen. Of records with
equal payloads, the one with the largest id is a response and the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import zips
from .common import by_bytes, column, materialize, shared_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of an archive's data member after which a task begins the next one; bytes that are read at a time; gzip's level.
ARCHIVE_BYTES, READ_BYTES, LEVEL = 256 << 20, 4 << 20, 1
#: Payloads of so many bytes or more are deduplicated.
LEAST_PAYLOAD = 0
_URN = "urn:x-page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """A WARC record; with `refers_to` a revisit, whose HTTP header still tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = f"<{_URN}{'none' if page_id is None else page_id}>"
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}"]
    if url:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """page_id, url, type, digest, refers_to, length and payload (of a response) of a record; broken ones raise."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("short record")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))

    def number(name: str) -> int | None:
        value = fields.get(name, "").strip("<>").removeprefix(_URN)
        return None if value in ("", "none") else int(value)

    revisit = fields["warc-type"] == "revisit"
    told = fields["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or digest(payload) != told):
        raise ValueError("payload differs from its digest")
    return {"page_id": number("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "payload_digest": told, "refers_to": number("warc-refers-to"), "payload_bytes": length, "payload": None if revisit else payload}


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def plan(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_PAYLOAD) -> DataFrame:
    """(page_id, url, html, refers_to) of each page: refers_to is null for responses. Pages only move if some payload occurs more than once."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    keyed = rows.select("page_id", F.sha2("html", 256).alias("sum"), F.octet_length("html").alias("size"))
    same = keyed.where(F.col("size") >= least).groupBy("sum", "size").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 AND last IS NOT NULL")
    same = materialize(same.select("sum", "last"), "same", small=True)
    revisits = materialize(keyed.join(same, "sum").where("page_id IS NULL OR page_id != last").select("page_id", "sum", F.col("last").alias("refers_to")).distinct(), "revisits", small=True)
    if revisits.isEmpty():
        return rows.withColumn("refers_to", F.lit(None).cast("long"))
    joined = rows.withColumn("sum", F.sha2("html", 256)).alias("r").join(revisits.alias("v"), (F.col("r.sum") == F.col("v.sum")) & F.col("r.page_id").eqNullSafe(F.col("v.page_id")), "left")
    return joined.select("r.page_id", "r.url", "r.html", "v.refers_to")


def write(planned: DataFrame, folder: str, most: int = ARCHIVE_BYTES, zip64: bool = True) -> DataFrame:
    """Write the records of plan() as archives under `folder`; (path, records, bytes) of each archive, materialised."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        path = out = archive = None
        index: list[bytes] = []
        done: list[tuple[str, int, int]] = []

        def finish() -> None:
            archive.end()
            archive.open(INDEX)
            archive.write(b"".join(index))
            archive.end()
            archive.close()
            out.close()
            store.move(f"{path}.part", path)
            done.append((f"{folder}/{path.rpartition('/')[2]}", len(index), archive.at))

        for batch in by_bytes(batches, "html", READ_BYTES):
            for page_id, url, html, refers in zip(*(column(batch, c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                if archive is None:
                    path, index = f"{root}/{uuid.uuid4().hex}.zip", []
                    out = store.open_output_stream(f"{path}.part")
                    archive = zips.Writer(out, zip64)
                    archive.open(DATA)
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                raw = pack.compress(record(page_id, url, html.encode("utf-8", "surrogatepass"), refers)) + pack.flush()
                at = archive.write(raw)
                index.append(json.dumps({"page_id": page_id, "offset": at, "length": len(raw)}).encode() + b"\n")
                if at + len(raw) >= most:
                    finish()
                    archive = None
        if archive is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["path", "records", "bytes"])

    return materialize(planned.mapInArrow(run, "path string, records long, bytes long"), "archives")


def entries(read: zips.Read, length: int) -> tuple[int, list[dict]]:
    """Where the data member of an archive begins, and the index's entries."""
    members = {m.name: m for m in zips.directory(read, length)}
    for name in (DATA, INDEX):
        if name not in members:
            raise ValueError(f"no member {name}")
        if members[name].method:
            raise ValueError(f"{name} is not stored")
    m = members[INDEX]
    raw = read(m.data_at(read), m.size)
    if zlib.crc32(raw) != m.crc:
        raise ValueError("the index differs from its checksum")
    return members[DATA].data_at(read), [json.loads(x) for x in raw.splitlines()]


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_digest, refers_to, payload_bytes, payload) of all records of the archives in column path.

    Lengths and digests of responses are those of the payload as read; a payload that differs from its digest fails.
    """
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64())]
    kinds += [("payload", pa.binary())] if payloads else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in column(batch, "path").to_pylist():
                store, name = _store(path)
                with store.open_input_file(name) as f:
                    span = lambda at, n, f=f: f.read_at(n, at)
                    start, index = entries(span, f.size())
                    index.sort(key=lambda e: e["offset"])
                    lo = 0
                    while lo < len(index):
                        first, hi = index[lo]["offset"], lo + 1
                        while hi < len(index) and index[hi]["offset"] + index[hi]["length"] - first <= READ_BYTES:
                            hi += 1
                        raw = span(start + first, index[hi - 1]["offset"] + index[hi - 1]["length"] - first)
                        out = [parse(zlib.decompress(raw[e["offset"] - first : e["offset"] - first + e["length"]], 31)) for e in index[lo:hi]]
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in kinds], names=[k for k, _ in kinds])
                        lo = hi

    names = {"int64": "long", "string": "string", "binary": "binary"}
    return archives.select("path").mapInArrow(run, ", ".join(f"{k} {names[str(t)]}" for k, t in kinds))


def round_trip(pages: DataFrame, folder: str | None = None, payloads: bool = False, **options) -> DataFrame:
    """Write all pages as archives under `folder` (a fresh one under the shared folder if none is named) and read them back.

    Null payloads are empty; null urls are left out. A page without an id is a response unless an equal payload has one;
    rows that share both id and payload are each a record. Other columns are not looked at, whatever their names; an empty
    table gives no archive and an empty result. A very long payload is held whole by one task.
    """
    folder = folder or f"{shared_dir(pages.sparkSession)}/spanlake/warc-{uuid.uuid4().hex}"
    return read(write(plan(pages, **options), folder), payloads)
