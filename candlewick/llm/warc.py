"""Zstandard WARC archives: writer and streaming reader.

An archive (``.warc.zst``) is a sequence of zstd frames.  The first may be a
skippable frame that holds a dictionary (plain, or itself zstd-compressed);
after it there is one frame per WARC record, so a reader can start at any
frame.  The writer trains a dictionary on the first records of each archive
and rolls to a new archive at a size bound.

Payload identity is the SHA-1 digest with the length.  Of records with equal
payloads of at least ``revisit_bytes`` bytes the one with the largest id is a
``response``; the others are ``revisit`` records that name it in
WARC-Refers-To and carry no payload, but its digest and, in the extension
field WARC-Payload-Length, its length.  Smaller payloads are always responses.
The largest ids are found by a partial aggregate over (digest, length); only
ids and digests take part in that join, and pages are joined to its result by
id and digest, so copies of one page are spread over all tasks.

Durability: a task writes under a name of its own and reports it when the file
is complete; only reported archives are read, so a repeated task leaves at
most an unread file.  Archives are opened by URI (``pyarrow.fs``) in the shared
folder.

Edge cases: null payloads are empty; a null URL gives no WARC-Target-URI; a
null id is smaller than any other and comes back null; rows that repeat the
largest id of their payload are all responses.  An empty table gives no
archive and no record.  Other columns are not written.  The reader keeps one
record in memory; it validates the dictionary frame, frame ends, the version
line, mandatory fields, Content-Length against the frame, and digests, and
raises on a fault (``strict``) or reports it in column ``error``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches, shared_path
from candlewick.session import materialize

REVISIT_BYTES = 1_000
ARCHIVE_BYTES = 64 << 20   # of records before compression
DICTIONARY_BYTES = 32 << 10
SAMPLES, SAMPLE_BYTES = 256, 4 << 10  # records a dictionary is trained on, bytes of each
CHUNK = 1 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # pages carry no date

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
ARCHIVES_A_TASK = 8

_MANIFEST = "path string, records long, bytes long"
_RECORD_TYPE = pa.struct([("path", pa.string()), ("frame", pa.int64()), ("record_id", pa.string()),
                          ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
                          ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                          ("payload", pa.binary()), ("error", pa.string())])
_RECORD = ("path string, frame long, record_id string, record_type string, target_uri string, refers_to string, "
           "payload_digest string, payload_bytes long, payload binary, error string")


# ---------------------------------------------------------------- records

def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(url: str) -> str:
    """No white space or control character may enter a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def build_record(page_id, url: str | None, payload: bytes, digest_hex: str, refers_to, revisit: bool,
                 date: str = DATE) -> bytes:
    digest = "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<{RECORD_ID}{'' if page_id is None else page_id}>"),
              ("WARC-Date", date)]
    if url:
        fields.append(("WARC-Target-URI", _uri(url)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>")]
    fields += [("WARC-Payload-Digest", digest), ("WARC-Payload-Length", str(len(payload))),
               ("WARC-Block-Digest", _digest(block)),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields and payload of one record; ValueError if it is not well formed."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] not in VERSIONS:
        raise ValueError("no WARC version line")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip():
            raise ValueError(f"malformed header line {line[:40]!r}")
        fields[name.strip().lower()] = value.strip()
    for name in MANDATORY:
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is not a number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {size} does not fit a frame with {len(rest) - 4} bytes")
    block = rest[:size]
    told = fields.get("warc-block-digest", "")
    if told.startswith("sha1:") and told != _digest(block):
        raise ValueError("block digest differs")
    kind, payload, length = fields["warc-type"], None, None
    if kind != "revisit":
        payload = block
        if fields.get("content-type", "").startswith("application/http"):
            _, mark, payload = block.partition(b"\r\n\r\n")
            if not mark:
                raise ValueError("no end of the HTTP header")
        length = len(payload)
        if fields.get("warc-payload-digest", "").startswith("sha1:") and fields["warc-payload-digest"] != _digest(payload):
            raise ValueError("payload digest differs")
    if "warc-payload-length" in fields:
        told = int(fields["warc-payload-length"])
        if length not in (None, told):
            raise ValueError("payload length differs")
        length = told
    name, _, value = fields.get("warc-payload-digest", "").partition(":")
    return {"record_id": fields["warc-record-id"].strip("<>"), "record_type": kind,
            "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "payload_digest": base64.b32decode(value).hex() if name == "sha1" else None,
            "payload_bytes": length, "payload": payload}


# ---------------------------------------------------------------- archives

def _train(records: list[bytes]):
    """A dictionary, or None where the samples are too few to train one."""
    import zstandard

    samples = [r[:SAMPLE_BYTES] for r in records[:SAMPLES]]
    if len(samples) < 8 or sum(map(len, samples)) < 4 * DICTIONARY_BYTES:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


def write_archive(out, records: Iterator[bytes]) -> int:
    """Write one archive to a binary stream; returns its number of records."""
    import zstandard

    first, n = [], 0
    for r in records:
        first.append(r)
        if len(first) == SAMPLES:
            break
    dictionary = _train(first)
    if dictionary:
        raw = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True, write_checksum=True)
    for part in (first, records):
        for r in part:
            out.write(packer.compress(r))
            n += 1
    return n


class _Source:
    """A stream read in chunks, with a look at what comes next."""

    def __init__(self, stream):
        self.stream, self.ahead, self.at = stream, b"", 0

    def more(self) -> bytes:
        if not self.ahead:
            self.ahead = self.stream.read(CHUNK)
        return self.ahead

    def peek(self, n: int) -> bytes:
        while len(self.ahead) < n and (new := self.stream.read(CHUNK)):
            self.ahead += new
        return self.ahead[:n]

    def take(self, n: int) -> bytes:
        got = self.peek(n)
        if len(got) < n:
            raise ValueError("the archive ends inside a frame")
        self.skip(n)
        return got

    def skip(self, n: int) -> None:
        self.ahead, self.at = self.ahead[n:], self.at + n


def read_frames(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each record's frame; ValueError on a damaged archive."""
    import zstandard

    src, dictionary = _Source(stream), None
    head = src.peek(8)
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
        src.skip(8)
        raw = src.take(struct.unpack("<I", head[4:])[0])
        if len(raw) >= 4 and struct.unpack("<I", raw[:4])[0] == ZSTD_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    while src.more():
        begin, magic = src.at, src.peek(4)
        if len(magic) == 4 and struct.unpack("<I", magic)[0] & 0xFFFFFFF0 == 0x184D2A50:
            size = struct.unpack("<I", src.take(8)[4:])[0]  # other skippable frames say nothing here
            src.take(size)
            continue
        frame, parts = unpacker.decompressobj(), []
        try:
            while not frame.eof:
                chunk = src.more()
                if not chunk:
                    raise ValueError("the archive ends inside a frame")
                parts.append(frame.decompress(chunk))
                src.skip(len(chunk) - len(frame.unused_data))
        except zstandard.ZstdError as e:
            raise ValueError(f"damaged frame at {begin}: {e}") from e
        yield begin, b"".join(parts)


def read_records(stream, path: str, strict: bool = True) -> Iterator[dict]:
    none = dict.fromkeys(x.name for x in _RECORD_TYPE)
    try:
        for begin, data in read_frames(stream):
            try:
                yield none | parse_record(data) | {"path": path, "frame": begin}
            except ValueError as e:
                if strict:
                    raise ValueError(f"{path}, frame at {begin}: {e}") from e
                yield none | {"path": path, "frame": begin, "error": str(e)}
    except ValueError as e:
        if strict:
            raise
        yield none | {"path": path, "error": str(e)}


# ---------------------------------------------------------------- Spark

def revisits(pages: DataFrame, page_id: str, digest: str, size: str, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of pages whose payload a later page repeats."""
    ids = pages.where(F.col(size) >= revisit_bytes).select(page_id, digest, size)
    last = (ids.groupBy(F.col(digest).alias("_digest"), F.col(size).alias("_size"))
            .agg(F.max(page_id).alias("refers_to"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    last = materialize(last)  # two plain shuffles below, which adaptive execution can split at a hot payload
    met = ids.join(last, (F.col(digest) == F.col("_digest")) & (F.col(size) == F.col("_size")))
    return (met.where(F.col("refers_to").isNotNull() & ~F.col(page_id).eqNullSafe(F.col("refers_to")))
            .select(page_id, digest, "refers_to").distinct())


def write_warc(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html",
               folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES,
               revisit_bytes: int = REVISIT_BYTES, date: str = DATE) -> DataFrame:
    """Write every page as a record; returns the manifest (path, records, bytes)."""
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = folder or shared_path(spark, "warc")
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"), data.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    again = materialize(revisits(rows, "id", "digest", "size", revisit_bytes)).select(
        F.col("id").alias("_id"), F.col("digest").alias("_digest"), "refers_to")
    told = rows.join(again, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").select(
        "id", "url", "payload", "digest", "refers_to", F.col("_digest").isNotNull().alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        place, root = fs.FileSystem.from_uri(folder)
        size = 0

        def records() -> Iterator[bytes]:
            nonlocal size
            for batch in batches:
                for r in batch.to_pylist():
                    rec = build_record(r["id"], r["url"], r["payload"], r["digest"], r["refers_to"], r["revisit"], date)
                    size += len(rec)
                    yield rec

        def rolled(ahead: bytes) -> Iterator[bytes]:
            """Records of one archive, ``ahead`` first."""
            nonlocal size, pending
            size, pending = len(ahead), None
            yield ahead
            for r in source:
                if size > archive_bytes:
                    pending = r
                    return
                yield r

        source, pending = records(), None
        pending = next(source, None)
        while pending is not None:
            place.create_dir(root, recursive=True)
            name = f"{uuid.uuid4().hex}.warc.zst"
            with place.open_output_stream(f"{root}/{name}") as raw:
                n = write_archive(raw, rolled(pending))
                length = raw.tell()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [n], "bytes": [length]},
                                             pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return materialize(told.mapInArrow(write, _MANIFEST))


def read_warc(archives: DataFrame, path: str = "path", strict: bool = True) -> DataFrame:
    """One row per record of the archives whose URIs are in column ``path``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        rows, size = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                place, name = fs.FileSystem.from_uri(uri)
                with place.open_input_stream(name) as stream:
                    for r in read_records(stream, uri, strict):
                        rows.append(r)
                        size += len(r["payload"] or b"") + 200
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_struct_array(pa.array(rows, _RECORD_TYPE))
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_struct_array(pa.array(rows, _RECORD_TYPE))

    spark = archives.sparkSession
    n = archives.count()  # a task reads few archives, however many there are
    tasks = max(1, min(n, 4 * spark.sparkContext.defaultParallelism), -(-n // ARCHIVES_A_TASK))
    return archives.select(path).repartition(tasks).mapInArrow(read, _RECORD)


def page_id_of(record_id: str) -> Column:
    """The id that a record's URN names, null for an empty one."""
    return F.expr(f"nullif(substring({record_id}, {len(RECORD_ID) + 1}), '')")
