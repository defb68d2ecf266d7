"""WARC archives: a normaliser of monolithic gzip files, and pages written, deduplicated and read back.

A WARC file compressed as one gzip stream can only be read from its start. The normaliser
inflates such a file once, as a stream, writes every record as a gzip member of its own to
a new file, and writes a sidecar index of the members' offsets beside it. One task works on a
file, since a gzip stream has no entry points; it holds a megabyte of it at a time, also
of a record that is larger. Files that are members already, or not compressed, are
normalised alike.

Pages take three steps. Each task writes its rows to monolithic files of bounded size, all
as responses, and reports (file, record, digest) of each. Records of equal payloads are
then matched by these narrow rows alone. The normaliser rewrites each file with
its list of repeated payloads: the first record of a payload stays a response, the others become
revisits of it without the payload. No payload is shuffled.

Files are named by a fresh number for each task attempt and become known by the rows the
task commits, so a task that is run again leaves at most an unnamed file behind. They are
opened through Arrow's file systems (local, HDFS, S3, GCS) below the shared folder.

Defined cases: null html is an empty payload; a null or odd URL is left out or percent-encoded; null
page ids come after all others and read back as null, and a revisit of such a page refers
to null; of repeated rows of one id and payload, the first written is the response; an empty table
gives no rows and no files; other columns are not read. A file that breaks off or is no
WARC keeps the records before the damage and gives one index row of type ``damaged``; what
came of the damaged record isn't written, unless that is over ``HELD`` packed bytes.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_bytes, stored

#: A payload of fewer bytes is always written in full.
LEAST_REVISIT = 100
#: An archive is closed after so many bytes before compression, or records.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 256 << 20, 100_000
PIECE = 1 << 20
#: Compression of monolithic files, which are read once, and of normalised ones.
FAST, LEVEL = 1, 6
#: Pages have no date of their own.
DATE = "1970-01-01T00:00:00Z"
#: Packed bytes of a record that are held back until its end, or this size, is reached.
HELD = 16 << 20
#: Longest header block of a record; a longer one is damage.
HEADER = 1 << 20

_INDEX = "archive string, source string, seq long, record_type string, record_id string, offset long, length long"


def _file(uri: str) -> tuple[pafs.FileSystem, str]:
    local = re.fullmatch(r"file:(?://)?(/.*)", uri)
    return (pafs.LocalFileSystem(), local[1]) if local else pafs.FileSystem.from_uri(uri)


def record_id(archive: str, seq: int) -> str:
    """The id of record ``seq`` of a written file."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{seq}')}>"


def _header(fields: list[tuple[str, str]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


class Damaged(Exception):
    """What follows in a file isn't a whole record."""


def _read(read, size: int) -> bytes:
    try:
        return read(size)
    except (EOFError, gzip.BadGzipFile, zlib.error) as e:
        raise Damaged(f"the stream breaks off: {e}") from e


class Record:
    """The header of a record, and its block as a stream."""

    def __init__(self, header: bytes, stream: BinaryIO) -> None:
        lines = header.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise Damaged(f"no record begins here: {lines[0][:40]!r}")
        self.header = header
        self.fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}
        length = self.fields.get("content-length", "")
        if not re.fullmatch("[0-9]{1,18}", length):
            raise Damaged("no content length")
        self.left = int(length)
        self._stream = stream

    def pieces(self) -> Iterator[bytes]:
        """The rest of the block."""
        while self.left:
            piece = _read(self._stream.read, min(PIECE, self.left))
            if not piece:
                raise Damaged("the block breaks off")
            self.left -= len(piece)
            yield piece

    def http_head(self) -> tuple[bytes, bytes]:
        """The HTTP header of a response block, and what was read behind it."""
        head = b""
        for piece in self.pieces():
            head += piece
            at = head.find(b"\r\n\r\n")
            if at >= 0:
                return head[: at + 4], head[at + 4 :]
            if len(head) > HEADER:
                break
        raise Damaged("no HTTP header")


def records(stream: BinaryIO) -> Iterator[Record]:
    """The records of an inflated stream; what is left of a block is skipped before the next record."""
    while True:
        line = _read(stream.readline, HEADER)
        while line in (b"\r\n", b"\n"):
            line = _read(stream.readline, HEADER)
        if not line:
            return
        lines, size = [line], len(line)
        while line not in (b"\r\n", b"\n"):
            line = _read(stream.readline, HEADER)
            size += len(line)
            if not line or size > HEADER:
                raise Damaged("the header breaks off")
            lines.append(line)
        record = Record(b"".join(x.rstrip(b"\r\n") + b"\r\n" for x in lines), stream)
        yield record
        for _ in record.pieces():
            pass


def inflated(raw: BinaryIO, buffer: int = PIECE) -> BinaryIO:
    """``raw`` as a buffered stream, inflated if it is gzip: one member or many."""
    plain = io.BufferedReader(raw, buffer)
    return io.BufferedReader(gzip.GzipFile(fileobj=plain), buffer) if plain.peek(2)[:2] == b"\x1f\x8b" else plain


class _Raw(io.RawIOBase):
    """A span of an Arrow file as a raw Python stream."""

    def __init__(self, file: pa.NativeFile, left: int | None = None) -> None:
        self._file, self._left = file, left

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        data = self._file.read(len(out) if self._left is None else min(len(out), self._left))
        if self._left is not None:
            self._left -= len(data)
        out[: len(data)] = data
        return len(data)


class _Members:
    """A file of gzip members."""

    def __init__(self, path: str, level: int) -> None:
        fs, at = _file(path)
        self._out, self._level, self.offset = fs.open_output_stream(at, compression=None), level, 0

    def write(self, pieces: Iterator[bytes]) -> int:
        """Write one member; its length in the file. If ``pieces`` fails within ``HELD`` packed bytes, nothing is written."""
        begin, packer, held = self.offset, zlib.compressobj(self._level, zlib.DEFLATED, 31), bytearray()
        for piece in pieces:
            held += packer.compress(piece)
            if len(held) > HELD:
                held = self._put(held)
        self._put(held + packer.flush())
        return self.offset - begin

    def _put(self, data: bytes) -> bytearray:
        self._out.write(data)
        self.offset += len(data)
        return bytearray()

    def close(self) -> None:
        self._out.close()


def _revisit(record: Record, archive: str, target: dict) -> Iterator[bytes]:
    """The response ``record`` as a revisit: its HTTP header without the payload."""
    head, _ = record.http_head()
    lines = (line.partition(":") for line in record.header.decode("utf-8", "replace").split("\r\n")[1:] if line)
    kept = [(k, v.strip()) for k, _, v in lines if k.strip().lower() not in ("warc-type", "content-length")]
    yield _header([
        ("WARC-Type", "revisit"), *kept, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", record_id(target["archive"], target["seq"])), ("Content-Length", str(len(head))),
    ])
    yield head


def normalise(files: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Rewrite every file of ``files`` into ``folder`` with one gzip member for each record.

    ``files`` has ``path`` and may have ``revisits``, array<struct<seq, archive, target>>: records to
    be written as revisits of another file's record. Returns the index, one row for
    each record: archive, source, seq, record_type, record_id, offset, length. Every action on it
    writes again: store it. A sidecar ``<archive>.idx`` holds the same as JSON lines.
    """
    with_revisits = "revisits" in files.columns

    def one(path: str, revisits: dict[int, dict]) -> Iterator[dict]:
        archive = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        fs, at = _file(path)
        out, seq = _Members(archive, level), 0  # seq: records written so far
        index = {"archive": archive, "source": path}
        with fs.open_input_stream(at, compression=None) as raw:
            try:
                for record in records(inflated(_Raw(raw))):
                    begin = out.offset
                    target = revisits.get(seq)

                    def member(record=record, target=target) -> Iterator[bytes]:
                        if target:
                            yield from _revisit(record, archive, target)
                        else:
                            yield record.header
                            yield from record.pieces()
                        yield b"\r\n\r\n"

                    length = out.write(member())
                    kind = "revisit" if target else record.fields.get("warc-type")
                    yield index | {"seq": seq, "record_type": kind, "record_id": record.fields.get("warc-record-id"), "offset": begin, "length": length}
                    seq += 1
            except Damaged:
                yield index | {"seq": seq, "record_type": "damaged", "record_id": None, "offset": None, "length": None}
        out.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("source", pa.string()), ("seq", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
        for b in batches:
            for row in b.to_pylist():
                revisits = {r["seq"]: {"archive": r["archive"], "seq": r["target"]} for r in (row["revisits"] or () if with_revisits else ())}
                sidecar, lines = None, []
                for line in one(row["path"], revisits):
                    lines.append(line)
                    if sidecar is None:
                        fs, at = _file(line["archive"] + ".idx")
                        sidecar = fs.open_output_stream(at, compression=None)
                    if len(lines) == 10_000:
                        sidecar.write("".join(json.dumps(x) + "\n" for x in lines).encode())
                        yield pa.RecordBatch.from_pylist(lines, schema)
                        lines = []
                if sidecar is not None:
                    sidecar.write("".join(json.dumps(x) + "\n" for x in lines).encode())
                    sidecar.close()
                if lines:
                    yield pa.RecordBatch.from_pylist(lines, schema)

    _make(folder)
    return files.mapInArrow(run, _INDEX)


def _make(folder: str) -> None:
    fs, at = _file(folder)
    fs.create_dir(at, recursive=True)


def write_monolithic(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a response record for every page into files of one gzip stream each, below ``folder``.

    Returns (archive, seq, page_id, payload_bytes, payload_digest) of each record. Every action on
    it writes again: store it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = packer = archive = None
        size = seq = 0
        for b in batches:
            rows = []
            for page, link, payload in zip(*(b.column(k) for k in ("page_id", "url", "html"))):
                if out is None:
                    archive, size, seq = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    fs, at = _file(archive)
                    out, packer = fs.open_output_stream(at, compression=None), zlib.compressobj(FAST, zlib.DEFLATED, 31)
                body = payload.as_buffer() if payload.is_valid else pa.py_buffer(b"")
                digest = hashlib.sha256(body).hexdigest()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                fields = [("WARC-Type", "response"), ("WARC-Record-ID", record_id(archive, seq)), ("WARC-Date", DATE)]
                if link.is_valid and link.as_py():
                    fields.append(("WARC-Target-URI", quote(link.as_py(), safe="!#$%&'()*+,/:;=?@[]~")))
                if page.is_valid:
                    fields.append(("X-Page-ID", quote(page.as_py(), safe="")))
                fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(head) + len(body)))]
                for piece in (_header(fields), head, body, b"\r\n\r\n"):
                    out.write(packer.compress(piece))
                rows.append((archive, seq, page.as_py(), len(body), digest))
                size, seq = size + len(body), seq + 1
                if size >= archive_bytes or seq >= ARCHIVE_RECORDS:
                    out.write(packer.flush())
                    out.close()
                    out = None
            if rows:
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=["archive", "seq", "page_id", "payload_bytes", "payload_digest"])
        if out is not None:
            out.write(packer.flush())
            out.close()

    _make(folder)
    read = pages.select(F.col(page_id).cast("string").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("binary").alias("html"))
    return read.mapInArrow(run, "archive string, seq long, page_id string, payload_bytes long, payload_digest string")


def repeated(written: DataFrame, id_type: str, least: int = LEAST_REVISIT) -> DataFrame:
    """(archive, seq, to_archive, to_seq) of each record that repeats the payload of another one, the first by page id."""
    long_ = written.where(F.col("payload_bytes") >= least)
    page = F.col("page_id").cast(id_type)
    first = long_.groupBy(F.col("payload_digest").alias("digest")).agg(
        F.min(F.struct(page.isNull().alias("none"), page.alias("page"), F.col("archive").alias("to_archive"), F.col("seq").alias("to_seq"))).alias("first"), F.count("*").alias("n"))
    first = stored(first.where("n > 1").select("digest", "first.to_archive", "first.to_seq"), "repeated-payloads")
    pairs = long_.join(small_bytes(first), F.col("payload_digest") == F.col("digest"))
    return pairs.where((F.col("archive") != F.col("to_archive")) | (F.col("seq") != F.col("to_seq"))).select("archive", "seq", "to_archive", "to_seq")


def archive_pages(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` as normalised archives with revisits below ``folder``; the stored index (see :func:`normalise`)."""
    written = stored(write_monolithic(pages, f"{folder}/monolithic", archive_bytes, page_id, url, html), "written-records")
    again = repeated(written, dict(pages.dtypes)[page_id])
    # At most ARCHIVE_RECORDS entries in the list of a file.
    lists = again.groupBy("archive").agg(F.collect_list(F.struct("seq", F.col("to_archive").alias("archive"), F.col("to_seq").alias("target"))).alias("revisits"))
    files = stored(written.select("archive").distinct().join(lists, "archive", "left").select(F.col("archive").alias("path"), "revisits"), "archives")
    tasks = min(max(1, files.count()), 10_000)
    return stored(normalise(files.repartition(tasks), f"{folder}/normalised"), "offsets")


def read_records(index: DataFrame) -> DataFrame:
    """Every record of the index, read from its archive at its offset: archive, seq, record_type, record_id,
    refers_to_id, target_uri, page_id, payload_bytes, payload_digest (both null for a revisit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"archive": pa.string(), "seq": pa.int64(), "record_type": pa.string(), "record_id": pa.string(), "refers_to_id": pa.string(), "target_uri": pa.string(), "page_id": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string()}
        raw, opened = None, None
        for b in batches:
            rows = []
            for row in b.to_pylist():
                if row["archive"] != opened:
                    if raw is not None:
                        raw.close()
                    fs, at = _file(row["archive"])
                    raw, opened = fs.open_input_file(at), row["archive"]
                raw.seek(row["offset"])
                record = next(records(inflated(_Raw(raw, row["length"]), min(PIECE, row["length"] + 1))))
                size = digest = None
                if record.fields["warc-type"] != "revisit":
                    size, digest = 0, hashlib.sha256()
                    if record.fields.get("content-type", "").startswith("application/http"):
                        size = len(rest := record.http_head()[1])
                        digest.update(rest)
                    for piece in record.pieces():
                        size += len(piece)
                        digest.update(piece)
                f = record.fields
                rows.append((row["archive"], row["seq"], f["warc-type"], f.get("warc-record-id"), f.get("warc-refers-to"), f.get("warc-target-uri"), f.get("x-page-id"), size, digest and digest.hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds.values())], names=list(kinds))
        if raw is not None:
            raw.close()

    whole = index.where(F.col("record_type") != "damaged").select("archive", "seq", "offset", "length")
    read = whole.mapInArrow(run, "archive string, seq long, record_type string, record_id string, refers_to_id string, target_uri string, page_id string, payload_bytes long, payload_digest string")
    return read.withColumn("page_id", F.expr("url_decode(replace(page_id, '+', '%2B'))"))


def warc_digest(pages: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as read back from its archive."""
    id_type = dict(pages.dtypes)["page_id"]
    read = stored(read_records(archive_pages(pages, folder)), "read-records")
    responses = read.where("record_type = 'response'")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    whole = responses.select(*out, F.lit(None).cast("string").alias("refers_to"))
    target = small_bytes(responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"))
    revisits = read.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to_id").join(target, "refers_to_id")
    rows = whole.unionByName(revisits.select(*out, "refers_to"))
    return rows.select(F.col("page_id").cast(id_type), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
q AS (SELECT *, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> first THEN first END AS refers_to
FROM q
"""
