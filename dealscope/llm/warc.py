"""WARC archives: writer, monolithic gzip normaliser with sidecar index, and reader.

``write_archives`` makes archives whose whole stream is one gzip member, the form that
cannot be read at an offset. ``normalise_archives`` inflates such a stream once, rewrites
every record as its own member and writes a sidecar index of offsets. ``read_records``
reads records at their offsets.

Files are made inside tasks through ``pyarrow.fs`` at a URI that all executors reach. Each
attempt of a task writes files of its own, and only those named in a manifest that Spark
committed are ever read; files of lost or repeated attempts stay unreferenced. Memory per
task is one record and a bounded buffer; archives roll over at ``archive_bytes``.

Defined results: null html is an empty payload; equal payloads are told by SHA-256 and
length; a null page id is kept in the archive as an empty header and read back as null, and
loses against any other id; if several rows share the id that wins a group, all of them are
responses. An empty table gives no archive and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealscope.session import fresh_path

from .common import arrow_rows, small_or_shuffled, written

ARCHIVE_BYTES = 256 << 20
_CHUNK = 1 << 20
# Payloads go to the writer in batches of so many rows.
_BATCH_ROWS = 256
_GZIP = 31
_LEVEL = 1

MANIFEST = T.StructType().add("path", "string").add("n_records", "long").add("size", "long")
INDEX = (
    T.StructType().add("path", "string").add("offset", "long").add("length", "long")
)
RECORD = (
    T.StructType()
    .add("page_id", "long")
    .add("payload_bytes", "long")
    .add("payload_digest", "string")
    .add("record_type", "string")
    .add("refers_to", "long")
    .add("payload", "binary")
)


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def _sink(folder: str, suffix: str) -> tuple[pa.NativeFile, str]:
    """A new file of its own name in ``folder``."""
    path = f"{folder}/{uuid.uuid4().hex}{suffix}"
    fs, local = _open(path)
    fs.create_dir(local.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(local, compression=None), path


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1, without a prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_revisits(pages: DataFrame, payload_min: int = 0) -> DataFrame:
    """Add ``refers_to``: the largest page id with an equal payload, null for itself.

    ``pages`` has (page_id, payload). Groups are found on digests alone, with map-side
    combine; payloads below ``payload_min`` bytes are never revisits. Payloads are read
    again and meet the list of revisits, which is broadcast if it is small; else both are
    plain shuffles, so adaptive execution can split a hot payload.
    """
    keyed = pages.withColumns({"_sha": F.sha2("payload", 256), "_size": F.octet_length("payload")})
    digests = keyed.select("page_id", "_sha", "_size").where(F.col("_size") >= payload_min)
    groups = (
        digests.groupBy("_sha", "_size")
        .agg(F.max("page_id").alias("_last"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    revisits = written(
        digests.join(groups, ["_sha", "_size"])
        .where(~F.col("page_id").eqNullSafe(F.col("_last")) & F.col("_last").isNotNull())
        .select(
            F.col("page_id").alias("_page"),
            F.col("_sha").alias("_digest"),
            F.col("_last").alias("refers_to"),
        )
        .distinct(),
        "revisits",
    )
    met = (F.col("_sha") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_page"))
    return keyed.join(small_or_shuffled(revisits), met, "left").select(
        "page_id", "payload", "refers_to"
    )


def _record(page_id: int | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit names its response and has no payload of its own."""
    kind = "response" if refers_to is None else "revisit"
    key = "" if page_id is None else str(page_id)
    block = payload if refers_to is None else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: urn:page:{key}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To-Target-URI: urn:page:{refers_to}",
        ]
    head += ["Content-Type: text/html", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write (page_id, payload, refers_to) rows as monolithic archives; the manifest.

    The manifest is lazy: each evaluation writes archives again, so write it down once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = packer = path = None
        count = size = 0

        def close() -> pa.RecordBatch:
            out.write(packer.flush())
            at = out.tell()
            out.close()
            return pa.RecordBatch.from_pydict(
                {"path": [path], "n_records": [count], "size": [at]}
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out, path = _sink(folder, ".warc.gz")
                    packer, count, size = zlib.compressobj(_LEVEL, wbits=_GZIP), 0, 0
                record = _record(row[0], row[1] or b"", row[2])
                out.write(packer.compress(record))
                count, size = count + 1, size + len(record)
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return pages.select("page_id", "payload", "refers_to").mapInArrow(run, MANIFEST)


class StreamReader:
    """Inflates gzip members, one or many, and hands out lines and blocks in order."""

    def __init__(self, source):
        self.source, self.buffer, self.inflater = source, bytearray(), None

    def _fill(self) -> bool:
        while True:
            if self.inflater is not None and self.inflater.unconsumed_tail:
                data = self.inflater.unconsumed_tail
            elif self.inflater is not None and self.inflater.eof:
                data = self.inflater.unused_data or self.source.read(_CHUNK)
                self.inflater = None
            else:
                data = self.source.read(_CHUNK)
            if not data and self.inflater is None:
                return False
            if self.inflater is None:
                self.inflater = zlib.decompressobj(_GZIP)
            made = self.inflater.decompress(data, _CHUNK)
            if not data and not made and not self.inflater.eof:
                raise EOFError("the gzip stream ends inside a member")
            if made:
                self.buffer += made
                return True

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._fill():
                raise EOFError("the archive ends inside a record")
        data = bytes(self.buffer[:n])
        del self.buffer[:n]
        return data

    def header(self) -> bytes | None:
        """Bytes up to and with the empty line after a header; None at the end."""
        searched = 0
        while True:
            at = self.buffer.find(b"\r\n\r\n", max(0, searched - 3))
            if at >= 0:
                return self.take(at + 4)
            searched = len(self.buffer)
            if not self._fill():
                if self.buffer.strip():
                    raise EOFError("the archive ends inside a header")
                return None


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def records(reader: StreamReader) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Fields, raw header and block of each record of a stream."""
    while (header := reader.header()) is not None:
        fields = _fields(header)
        block = reader.take(int(fields["content-length"]))
        reader.take(4)
        yield fields, header, block


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive of ``path`` with a gzip member per record; the offset index.

    Beside each new archive lies a sidecar ``.cdxj`` with a line per record. The same rows
    are returned: (path, offset, length).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                yield from _normalise(source, folder)

    return archives.select("path").mapInArrow(run, INDEX)


def _normalise(source: str, folder: str) -> Iterator[pa.RecordBatch]:
    fs, local = _open(source)
    out, path = _sink(folder, ".warc.gz")
    side_fs, side = _open(path.removesuffix(".warc.gz") + ".cdxj")
    offsets, lengths, at = [], [], 0
    with fs.open_input_stream(local, compression=None) as raw, out:
        with side_fs.open_output_stream(side, compression=None) as index:
            for fields, header, block in records(StreamReader(raw)):
                packer = zlib.compressobj(_LEVEL, wbits=_GZIP)
                member = packer.compress(header + block + b"\r\n\r\n") + packer.flush()
                out.write(member)
                line = {
                    "offset": at,
                    "length": len(member),
                    "type": fields.get("warc-type"),
                    "digest": fields.get("warc-payload-digest"),
                }
                index.write(f"{fields.get('warc-target-uri')} {json.dumps(line)}\n".encode())
                offsets.append(at)
                lengths.append(len(member))
                at += len(member)
    yield pa.RecordBatch.from_pydict(
        {"path": [path] * len(offsets), "offset": offsets, "length": lengths},
        schema=pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]),
    )


def _page(uri: str | None) -> int | None:
    key = (uri or "").removeprefix("urn:page:")
    return int(key) if key else None


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Records at (path, offset, length); a response's digest and length are recomputed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = file = None
        for batch in batches:
            rows = []
            for path, offset, length in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if path != name:
                    if file is not None:
                        file.close()
                    fs, local = _open(path)
                    name, file = path, fs.open_input_file(local)
                file.seek(offset)
                reader = StreamReader(pa.BufferReader(file.read(length)))
                fields, _, block = next(records(reader))
                rows.append(_row(fields, block, payloads))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if file is not None:
            file.close()

    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    return index.select("path", "offset", "length").mapInArrow(run, RECORD)


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(fields["x-payload-length"])
    if kind == "response" and (digest != payload_digest(block) or size != len(block)):
        raise ValueError(f"payload of {fields['warc-target-uri']} differs from its digest")
    return {
        "page_id": _page(fields["warc-target-uri"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to-target-uri")),
        "payload": block if payloads and kind == "response" else None,
    }


def archive_pages(pages: DataFrame, payload_min: int = 0) -> DataFrame:
    """Write (page_id, payload) as monolithic archives, normalise them; the offset index."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    rows = with_revisits(pages, payload_min)
    with arrow_rows(spark, _BATCH_ROWS):
        manifest = written(write_archives(rows, f"{folder}/monolithic"), "manifest")
    archives = manifest.select("path").repartition(
        max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path"
    )
    return written(normalise_archives(archives, f"{folder}/members"), "offsets")
