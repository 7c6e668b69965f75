"""WARC archives as a chunked record table.

Writing: every row is a WARC/1.1 record, one gzip member each; a payload over
``segment`` bytes goes out as the standard's segments (a first record, then
``continuation`` records). Of equal payloads one row is written in full and the
others as ``revisit`` records that refer to it. Each task writes its own files
under the shared folder and returns their places as a manifest; only files in
the manifest count, so what a lost or repeated task attempt leaves is never
read.

Reading: archives are read as streams. A payload comes out as rows of record
identifier and chunk number, each with the digest of the payload so far; no
step holds a whole record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, scratch_path, slices, text_bytes

#: Payload bytes of a segment, of a chunk row, and of archive files (a new one
#: is begun beyond this).
SEGMENT = 1 << 20
CHUNK = 1 << 18
FILE_BYTES = 64 << 20
#: Payloads with fewer bytes than this are never revisits.
LEAST = 0

MANIFEST = "path string, records long, bytes long"
CHUNKS = (
    "record_id string, segment int, chunk_no int, data binary, last boolean, record_type string, target string, "
    "payload_digest string, refers_to string, running_bytes long, running_sha1 string"
)
PREFIX = "urn:row:"
#: A header field of our own: the target is percent-encoded, ``%`` included.
ESCAPED = "X-Target-Escaped"
_CONTROL = re.compile("[\x00-\x1f\x7f-\x9f\u2028\u2029]")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(key) -> str:
    """A record's name, a function of the row's key alone, so that a revisit
    can name a record which another task writes. Keys are percent-encoded."""
    return PREFIX if key is None else PREFIX + quote(str(key), safe="")


def target_fields(target: str) -> list[tuple[str, object]]:
    """The header fields of a target. Control characters would end its line, so
    a target that has any is percent-encoded, and a field of its own says so;
    all others stand as they are, with the escapes that they have."""
    if not _CONTROL.search(target) and target == target.strip():
        return [("WARC-Target-URI", target)]
    return [("WARC-Target-URI", quote(target, safe="/:?#[]@!$&'()*+,;=-._~")), (ESCAPED, "yes")]


def header(fields: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record(key, target: str, refers_to, digest: bytes, payload: memoryview, segment: int) -> Iterator[bytes]:
    """The gzip members of one row."""
    own, name = record_id(key), base32_sha1(digest)
    base = [("WARC-Date", "2024-01-01T00:00:00Z"), *target_fields(target), ("WARC-Payload-Digest", f"sha1:{name}")]
    if refers_to is not None:
        yield member(header([
            ("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{own}>"), *base, ("WARC-Refers-To", f"<{record_id(refers_to)}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Content-Length", 0),
        ]), payload[:0])
        return
    total = max(1, -(-len(payload) // segment))
    for n in range(1, total + 1):
        part = payload[(n - 1) * segment : n * segment]
        fields = [("WARC-Type", "response" if n == 1 else "continuation"), ("WARC-Record-ID", f"<{own}>" if n == 1 else f"<{own}:{n}>"), *base]
        if total > 1:
            fields.append(("WARC-Segment-Number", n))
        if n > 1:
            fields.append(("WARC-Segment-Origin-ID", f"<{own}>"))
        if 1 < total == n:
            fields.append(("WARC-Segment-Total-Length", len(payload)))
        yield member(header([*fields, ("Content-Length", len(part))]), part)


def member(head: bytes, payload: memoryview) -> bytes:
    z = zlib.compressobj(1, wbits=31)
    return z.compress(head) + z.compress(payload) + z.compress(b"\r\n\r\n") + z.flush()


def _open(path: str):
    """The file system and the name there of a path or URI."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


def write(df: DataFrame, folder: str, key: str, target: str, payload: str, refers_to: str, segment: int = SEGMENT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a record per row (``refers_to``: the key of the row with the same
    payload, or null) and returns the manifest, itself a table in ``folder``.
    Null payloads are empty, null targets are written as nothing; control
    characters in targets and keys are percent-encoded."""

    def run(batches):
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}" if task else f"part-{uuid.uuid4().hex}"
        fs, out, done = None, None, []
        try:
            for batch in batches:
                for part in slices(batch, "payload"):
                    for k, t, r, data in zip(*(part.column(c).to_pylist() for c in ("key", "target", "refers_to")), part.column("payload")):
                        if out is None or done[-1][2] >= file_bytes:
                            if out is not None:
                                out.close()
                            path = f"{folder}/{name}-{len(done)}.warc.gz"
                            fs, place = _open(path)
                            fs.create_dir(place.rpartition("/")[0], recursive=True)
                            out = fs.open_output_stream(place, compression=None)
                            done.append([path, 0, 0])
                        view = memoryview(data.as_buffer())
                        for piece in record(k, t, r, hashlib.sha1(view).digest(), view, segment):
                            out.write(piece)
                            done[-1][2] += len(piece)
                        done[-1][1] += 1
        finally:
            if out is not None:
                out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(target), F.lit("")).alias("target"), F.col(refers_to).alias("refers_to"), text_bytes(payload).alias("payload"))
    return cut(rows.mapInArrow(run, MANIFEST), "warc-manifest")


class Inflated:
    """The plain bytes of a stream of gzip members, read a piece at a time."""

    def __init__(self, stream, piece: int):
        self.stream, self.piece = stream, piece
        self.z, self.raw, self.held, self.over = zlib.decompressobj(31), b"", b"", False

    def more(self) -> bool:
        """Adds up to ``piece`` bytes to ``held``."""
        while not self.over:
            if not self.raw:
                self.raw = self.stream.read(self.piece)
                if not self.raw:
                    self.over = True
                    return False
            got = self.z.decompress(self.raw, self.piece)
            self.raw = self.z.unconsumed_tail or self.z.unused_data
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            if got:
                self.held += got
                return True
        return False

    def until(self, end: bytes) -> bytes | None:
        """Bytes up to and with ``end``; nothing at the end of the stream."""
        start = 0
        while (at := self.held.find(end, start)) < 0:
            start = max(0, len(self.held) - len(end) + 1)
            if not self.more():
                if self.held.strip():
                    raise ValueError("the archive ends inside a header")
                return None
        out, self.held = self.held[: at + len(end)], self.held[at + len(end) :]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        if len(self.held) < n:
            raise ValueError("the archive ends inside a record")
        out, self.held = self.held[:n], self.held[n:]
        return out


def read_stream(stream, chunk: int, data: bool = True) -> Iterator[tuple]:
    """Chunk rows of an open archive, in the order of ``CHUNKS``. Segments of a
    payload follow each other, and number and digest their chunks on."""
    plain = Inflated(stream, chunk)
    sha, number, total = hashlib.sha1(), 0, 0
    while (head := plain.until(b"\r\n\r\n")) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode().removesuffix("\r\n\r\n").split("\r\n")[1:])
        kind, left = fields["WARC-Type"], int(fields["Content-Length"])
        origin = fields.get("WARC-Segment-Origin-ID")
        own = (origin or fields["WARC-Record-ID"]).strip("<>")
        if origin is None:
            sha, number, total = hashlib.sha1(), 0, 0
        segment = int(fields.get("WARC-Segment-Number", 1))
        last_segment = "WARC-Segment-Number" not in fields or "WARC-Segment-Total-Length" in fields
        target = fields.get("WARC-Target-URI")
        if ESCAPED in fields:
            target = unquote(target)
        common = (kind, target, fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, (fields.get("WARC-Refers-To") or "").strip("<>") or None)
        while True:
            piece = plain.take(min(left, chunk))
            left -= len(piece)
            sha.update(piece)
            total += len(piece)
            yield (own, segment, number, piece if data else None, last_segment and not left, *common, total, base32_sha1(sha.digest()))
            number += 1
            if not left:
                break
        plain.take(4)


def read(manifest: DataFrame, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """The chunked record table of the archives in a manifest: one row at least
    per record, an empty payload one empty chunk. ``running_bytes`` and
    ``running_sha1`` cover the payload up to the chunk's end. ``data=False`` leaves the bytes out."""
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, place = _open(path)
                rows, held, row = [], 0, None
                with fs.open_input_stream(place, compression=None) as stream:
                    try:
                        for row in read_stream(stream, chunk, data):
                            rows.append(row)
                            held += len(row[3] or b"") + 300
                            if held >= 4 * chunk:
                                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)
                                rows, held = [], 0
                    except (ValueError, KeyError, zlib.error) as e:
                        raise ValueError(f"{path}, after {row[0] if row else 'its start'}: {e!r}") from e
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

    paths = manifest.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(run, CHUNKS)  # a file a task: files are bounded


def records(chunks: DataFrame) -> DataFrame:
    """Per archived record: ``record_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type`` and ``refers_to``. A revisit takes its payload's length from
    the response it refers to, by name and digest."""
    done = chunks.where("last").select("record_id", "record_type", "refers_to", "running_bytes", "running_sha1", "payload_digest")
    full = done.where("record_type != 'revisit'").groupBy(F.col("record_id").alias("refers_to"), F.col("running_sha1").alias("payload_digest")).agg(F.max("running_bytes").alias("full_bytes"))
    revisit = F.col("record_type") == "revisit"
    return done.join(full.hint("merge"), ["refers_to", "payload_digest"], "left").select(
        "record_id", F.when(revisit, F.col("full_bytes")).otherwise(F.col("running_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(F.col("running_sha1")).alias("payload_digest"),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"), "refers_to",
    )


def archive(df: DataFrame, key: str = "page_id", target: str = "url", payload: str = "html", least: int = LEAST, segment: int = SEGMENT, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``df`` as archives, reads them back and returns per row: key,
    ``payload_bytes``, ``payload_digest`` (base32 SHA-1 of the whole payload),
    ``record_type`` and ``refers_to``, all taken from the archives.

    Of equal payloads of at least ``least`` bytes the row with the smallest key
    is the response, the others revisit it; repeated rows of that key are all
    responses. A null payload is empty. Rows with a null key are written and
    come back, but nothing refers to them: they are responses unless an equal
    payload has a key. Targets and keys may hold any characters. Payloads of any
    length are written, and read back, in segments and chunks. Other columns are
    not read, so none can clash. No rows, no records.
    """
    rows = df.select(F.col(key).alias("key"), F.col(target).alias("target"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.sha2(F.col("payload").cast("binary"), 256))
    same = rows.where(F.octet_length("payload") >= least).groupBy("sha").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("sha", "first")
    marked = rows.join(same.hint("merge"), "sha", "left").withColumn("refers", F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")))
    manifest = write(marked, scratch_path(df.sparkSession, "warc"), "key", "target", "payload", "refers", segment, file_bytes)
    kind = df.schema[key].dataType.simpleString()
    back = lambda c: F.expr(f"try_cast(nullif(url_decode(substr({c}, {len(PREFIX) + 1})), '') as {kind})")
    return records(read(manifest, chunk, data=False)).select(
        back("record_id").alias(key), "payload_bytes", "payload_digest", "record_type", back("refers_to").alias("refers_to")
    )


# The archive's listing straight from the pages. Base 32 takes 20 bits of the hex digest at a time.
_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(sha1(html), {5 * i + 1}, 5) AS BIGINT) >> {shift}) & 31 AS INTEGER) + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0)
)
ARCHIVE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, {_DIGITS} AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
