"""WARC archives as .warc.zst files: every record is a Zstandard frame of its own, compressed with a dictionary that was
built from the archive's records and stands in a skippable frame at its start.

Records whose payload was archived before (by an earlier id) are written as revisits, without the payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import materialize, ready

#: Fixed by the format: the skippable frame that holds a dictionary, and the profile of a revisit by digest.
DICT_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records at the start of an archive that its dictionary is built from, in bytes at most, and the dictionary's size.
SAMPLE_BYTES, DICT_BYTES = 1 << 20, 32 << 10
#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 256 << 20
WRITTEN = "archive string, records long, bytes long, dict_bytes long"
RECORD = "id long, uri string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _urn(id_: int | None) -> str:
    return f"<urn:page:{'none' if id_ is None else id_}>"


def _id(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(id_: int | None, uri: str | None, payload: bytes, first: int | None, revisit: bool, date: str) -> bytes:
    """A response record, or a revisit that refers to the record of ``first``; both name the full payload's size and digest."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(id_)}", f"WARC-Date: {date}"]
    if uri is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)
        head.append(f"WARC-Target-URI: {safe}")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(first)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple:
    """The fields of RECORD from a record's bytes; digest and size of a response are taken from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
    if kind == "response":
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (own, len(payload)) != (digest, size):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't have its digest and size")
    return (_id(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, digest, kind, _id(fields.get("WARC-Refers-To")), payload if kind == "response" else None)


class Archive:
    """One archive file being written: the first records wait until there are enough for a dictionary."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self.waiting, self.held, self.sink, self.records, self.bytes, self.dict_bytes = [], 0, None, 0, 0, 0

    def add(self, raw: bytes) -> None:
        self.records += 1
        if self.sink is not None:
            return self._frame(raw)
        self.waiting.append(raw)
        self.held += len(raw)
        if self.held >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        where, path = _open(self.uri)
        self.sink = where.open_output_stream(path, compression=None)  # not by the name's ending
        words = None
        try:
            words = zstandard.train_dictionary(DICT_BYTES, self.waiting, k=256, d=8)
        except zstandard.ZstdError:
            pass  # too few or too short records to learn from: the format allows an archive without a dictionary
        if words is not None:
            data = words.as_bytes()
            self._write(struct.pack("<II", DICT_MAGIC, len(data)) + data)
            self.dict_bytes = len(data)
        self.zip = zstandard.ZstdCompressor(level=3, dict_data=words, write_content_size=True, write_checksum=True)
        for raw in self.waiting:
            self._frame(raw)
        self.waiting = []

    def _frame(self, raw: bytes) -> None:
        self._write(self.zip.compress(raw))

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.bytes += len(data)

    def close(self) -> tuple:
        if self.sink is None:
            self._start()
        self.sink.close()
        return self.uri, self.records, self.bytes, self.dict_bytes


def _writer(folder: str, date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(archive: Archive) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in archive.close()], names=["archive", "records", "bytes", "dict_bytes"])

        archive = None
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for id_, uri, payload, first, revisit in zip(*columns, strict=True):
                archive = archive or Archive(folder)
                archive.add(record(id_.as_py(), uri.as_py(), payload.as_py(), first.as_py(), revisit.as_py(), date))
                if archive.bytes >= archive_bytes:
                    yield listed(archive)
                    archive = None
        if archive:
            yield listed(archive)

    return run


def records_of(uri: str) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    where, path = _open(uri)
    with where.open_input_stream(path, compression=None) as source:
        data = source.read(8)
        words = None
        if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICT_MAGIC:
            words = zstandard.ZstdCompressionDict(source.read(struct.unpack("<I", data[4:])[0]))
            data = source.read(1 << 20)
        unzip = zstandard.ZstdDecompressor(dict_data=words)
        while data:
            frame, parts = unzip.decompressobj(), []
            while not frame.eof:
                if not data:
                    raise ValueError(f"{uri} ends within a record")
                parts.append(frame.decompress(data))
                data = frame.unused_data if frame.eof else source.read(1 << 20)
            yield b"".join(parts)
            data = data or source.read(1 << 20)


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            id_, uri, size, digest, kind, refers, payload = zip(*rows, strict=True)
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            columns = (id_, uri, size, digest, kind, refers, payload if payloads else [None] * len(rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

        rows, held = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                for raw in records_of(uri):
                    rows.append(parsed(raw))
                    held += len(raw) if payloads else 1
                    if held >= 4 << 20 or len(rows) >= 2000:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                   min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record for each row of ``pages`` into archives under ``folder`` (a URI that all workers can write) and
    return the list of archives: (archive, records, bytes, dict_bytes).

    Of records with equal payloads of at least ``min_revisit_bytes`` the one with the smallest id is a response and the
    others revisit it; rows that repeat that id are responses as well; a null id is never referred to, so rows with null
    ids only are all responses.  A null payload is empty; a null address is left out.  An empty table writes nothing.
    The list is written when the archives are, by Spark's committer: archives of lost or repeated tasks are not on it.
    """
    spark = ready(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    src = src.withColumns({"sha": F.sha1("payload"), "size": F.octet_length("payload")})
    # only payloads that occur more than once, a narrow table: small ones are joined without moving the payloads
    twice = src.where(F.col("size") >= min_revisit_bytes).groupBy("sha", "size").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    twice = materialize(twice.select("sha", "size", "first"), "twice")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = src.join(twice, ["sha", "size"], "left").select("id", "uri", "payload", "first", revisit.alias("revisit"))
    where, path = _open(folder)
    where.create_dir(path, recursive=True)
    return materialize(rows.mapInArrow(_writer(folder.rstrip("/"), date, archive_bytes), WRITTEN), "archives")


def read_archives(spark: SparkSession, archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives named in column ``archive``: (id, uri, payload_bytes, payload_digest, record_type,
    refers_to, payload).  Responses are checked against their digest and size; revisits have no payload."""
    ready(spark)
    files = archives.select("archive")
    tasks = max(1, min(files.count(), 10_000))
    return files.repartition(tasks).mapInArrow(_reader(payloads), RECORD)
