"""WARC archives: records written as one gzip stream, normalised to one gzip
member per record with an offset index, and read back by offset.

Files go to the shared folder through Arrow's file systems. Each try of a task
writes under names of its own, and only the names that a finished task returns
are read on, so a task that is lost and repeated leaves no trace in the result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import map_batches, stored, utf8
from tarmac.sources.session import fresh_path

#: Uncompressed bytes after which a task begins the next archive.
ARCHIVE_BYTES = 64 << 20
LEVEL, CHUNK = 6, 1 << 20
GZIP = 16 + zlib.MAX_WBITS
DATE = "2000-01-01T00:00:00Z"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id, url: str | None, payload: bytes, sha1: str, refers_to, revisit: bool) -> bytes:
    """A response, or a revisit that keeps the response's headers without its payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
    block = http % len(payload) + (b"" if revisit else payload)
    name = lambda key: f"<{PAGE}{'' if key is None else key}>"
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_safe(url)}"] if url else []),
        f"WARC-Payload-Digest: sha1:{sha1}",
        *([f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"] * revisit),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    head = VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n"
    return head + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    """Header fields of a record, names in lower case."""
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    pairs = (line.decode().partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of any number of members, piece by piece."""
    decoder, fed = zlib.decompressobj(GZIP), False
    while chunk := stream.read(CHUNK):
        while chunk:
            if decoder.eof:
                decoder = zlib.decompressobj(GZIP)
            yield decoder.decompress(chunk, 4 * CHUNK)
            fed = True
            while decoder.unconsumed_tail:
                yield decoder.decompress(decoder.unconsumed_tail, 4 * CHUNK)
            chunk = decoder.unused_data if decoder.eof else b""
    if fed and not decoder.eof:
        raise EOFError("the archive ends inside a gzip member")


class _Reader:
    """Reads heads and counted bytes from pieces, holding little more than one piece."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is not None:
            self.held += piece
        return piece is not None

    def head(self) -> bytes | None:
        """The next record's head with its empty line; None at the end."""
        while (end := self.held.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.held.strip():
                    raise EOFError("the archive ends inside a record's head")
                return None
        head, self.held = self.held[: end + 4], self.held[end + 4 :]
        return head

    def counted(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise EOFError("the archive ends inside a record")
            part, self.held = self.held[:n], self.held[n:]
            n -= len(part)
            yield part


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def with_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, sha1 (hex), revisit and refers_to of every page.

    Of pages with equal payloads of at least ``min_bytes`` that with the largest
    page_id is the response; of equal rows one is. The payloads meet as digests:
    one row per digest goes to the pages, however many pages share it.
    """
    payload = utf8("html")
    rows = stored(
        pages.select(
            "page_id",
            F.col("url").cast("string").alias("url"),
            payload.alias("payload"),
            F.sha1(payload).alias("sha1"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "payloads",
        "zstd",
    )
    first = (
        rows.filter(F.length("payload") >= min_bytes)
        .groupBy("sha1")
        .agg(F.max(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("sha1", "first")
    )
    revisit = F.coalesce(F.col("row") != F.col("first.row"), F.lit(False)) & (
        F.length("payload") >= min_bytes
    )
    return rows.join(first, "sha1", "left").select(
        "page_id",
        "url",
        "payload",
        "sha1",
        revisit.alias("revisit"),
        F.when(revisit, F.col("first.page_id")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the records as whole-file gzip streams; one row (archive, records) per file."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        out, names, counts = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    counts.append(0)
                    out = system.open_output_stream(f"{base}/{names[-1]}", compression=None)
                    packer, size = zlib.compressobj(LEVEL, wbits=GZIP), 0
                sha1 = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                raw = record(
                    row["page_id"], row["url"], row["payload"], sha1, row["refers_to"], row["revisit"]
                )
                out.write(packer.compress(raw))
                counts[-1] += 1
                size += len(raw)
                if size >= archive_bytes:
                    out.write(packer.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(packer.flush())
            out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["archive", "records"]
        )

    _folder(folder)
    return stored(map_batches(records, written, "archive string, records long"), "archives")


def _folder(folder: str) -> None:
    system, base = _open(folder)
    system.create_dir(base, recursive=True)


def normalise(archives: DataFrame, folder: str, to: str) -> DataFrame:
    """Rewrites each archive with every record as a gzip member of its own.

    One task inflates a file once, record by record. The index, one row
    (archive, offset, length, record_id) per record, is returned and also
    written beside each new archive, one line per record.
    """

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, base = _open(folder)
        system, target = _open(to)
        for batch in batches:
            for name in batch["archive"].to_pylist():
                new = f"{uuid.uuid4().hex}.warc.gz"
                rows, offset = [], 0
                with (
                    source.open_input_stream(f"{base}/{name}", compression=None) as stream,
                    system.open_output_stream(f"{target}/{new}", compression=None) as out,
                    system.open_output_stream(f"{target}/{new}.index", compression=None) as index,
                ):
                    reader = _Reader(inflated(stream))
                    while (head := reader.head()) is not None:
                        fields = headers(head[:-4])
                        packer = zlib.compressobj(LEVEL, wbits=GZIP)
                        start = offset
                        offset += out.write(packer.compress(head))
                        for part in reader.counted(int(fields["content-length"]) + 4):
                            offset += out.write(packer.compress(part))
                        offset += out.write(packer.flush())
                        key = fields["warc-record-id"]
                        rows.append((new, start, offset - start, key))
                        index.write(f"{start}\t{offset - start}\t{key}\n".encode())
                        if len(rows) == 10_000:
                            yield _index(rows)
                            rows = []
                yield _index(rows)

    _folder(to)
    dealt = archives.repartition(max(1, archives.count()))
    return stored(
        map_batches(dealt, rewritten, "archive string, offset long, length long, record_id string"),
        "index",
    )


def _index(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    names = ["archive", "offset", "length", "record_id"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def parse(member: bytes) -> dict:
    """A record from its own gzip member; the payload of a response is checked."""
    raw = zlib.decompress(member, GZIP)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    sha1 = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or digest(payload) != sha1):
        raise ValueError(f"{fields['warc-record-id']}: the payload differs from its digest")
    number = lambda key: int(key[len(PAGE) + 1 : -1] or -1) if key else -1
    page, target = fields["warc-record-id"], fields.get("warc-refers-to")
    return {
        "page_id": None if page == f"<{PAGE}>" else number(page),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": None if target in (None, f"<{PAGE}>") else number(target),
        "payload_bytes": size,
        "payload_digest": sha1,
        "payload": payload if kind == "response" else None,
    }


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """Every record by its place in the index: page_id, url, record_type, refers_to,
    payload_bytes and payload_digest (of the full payload), payload (null for revisits)."""
    schema = (
        "page_id long, url string, record_type string, refers_to long, "
        "payload_bytes long, payload_digest string, payload binary"
    )
    kinds = {
        "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(),
        "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
        "payload": pa.binary(),
    }

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        name, file = None, None
        for batch in batches:
            rows = []
            for place in batch.to_pylist():
                if place["archive"] != name:
                    name = place["archive"]
                    file = system.open_input_file(f"{base}/{name}")
                file.seek(place["offset"])
                rows.append(parse(file.read(place["length"])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], k) for c, k in kinds.items()], names=list(kinds)
            )

    return map_batches(index.select("archive", "offset", "length"), fetched, schema)


def round_trip(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages written as records into archives, normalised, and read back by offset.

    Null html is an empty payload, a null url is left out of its record, a null
    page_id comes back null. Repeated rows repeat, extra columns are left behind,
    an empty table has no records.
    """
    spark = pages.sparkSession
    raw, single = fresh_path(spark, "warc-streams"), fresh_path(spark, "warc")
    archives = write_archives(with_records(pages, min_bytes), raw, archive_bytes)
    return read_back(normalise(archives, raw, single), single)
