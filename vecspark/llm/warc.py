"""WARC archives compressed with Zstandard and a dictionary: writer and streaming reader.

Layout of a .warc.zst file: a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself
compressed as an ordinary frame, then one frame per record.  The reader loads the dictionary from the
leading skippable frame, decodes one frame at a time and validates version line, header lines, the
mandatory headers, Content-Length against the block and the closing blank lines, and the payload digest
of responses.  It reads the file in chunks and holds one record at a time.

Writing.  Of records with equal payloads of at least ``revisit_from`` bytes the one with the largest id is
the response and the others are revisits that refer to it.  Rows whose payload digest is certainly unique
(two Bloom passes) go straight to the writer; only possible repeats shuffle.  Every task fills archives of
about ``archive_bytes`` of payload, trains the dictionary of each on its first records (at most
DICTIONARY_SAMPLE bytes), and returns their paths and record counts.  An archive gets a name of its own for
every attempt, and readers take the listed paths only, so lost or repeated tasks leave no trace in results.

Archives lie in a folder that every executor reaches: any file system that pyarrow opens (shared mounts,
S3, GCS, or HDFS with libhdfs).

Defined cases: null payloads are empty; a null url is an absent WARC-Target-URI; rows with a null id are
written and read back with a null id; rows that repeat an id are written each, and equal payloads of one id refer to it;
an empty table gives no archives and an empty result.  Damaged archives raise ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.llm.exact_dedup import Repeats, with_groups
from vecspark.llm.registry import filled
from vecspark.session import filesystem, materialize, scratch_path

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

ARCHIVE_BYTES = 32 << 20
DICTIONARY_SAMPLE = 2 << 20
DICTIONARY_BYTES = 64 << 10
CHUNK = 1 << 16  # what is left of a chunk is copied after every frame
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, so that tasks look where Spark does."""
    system, at = filesystem(spark, folder)
    return system.makeQualified(at).toString()


def _open(path: str):
    if "://" not in path and not path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), path
    return arrow_fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def record_id(page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page/{page}')}>"


def build_record(page, url, date, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record; revisits hold the HTTP header but no payload."""
    digest = hashlib.sha1(payload).digest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page)), ("WARC-Date", date),
             ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode()),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        lines.append(("WARC-Target-URI", "".join(url.split())))
    if page is not None:
        lines.append(("X-Page-Id", str(page)))
    if revisit:
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page", str(refers_to))]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines)
    return head + b"\r\n" + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of at most DICTIONARY_BYTES; plain content where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


class ArchiveWriter:
    """Writes one archive: the first records are held back until there is enough to train on."""

    def __init__(self, path: str, sample_bytes: int = DICTIONARY_SAMPLE):
        system, inner = _open(path)
        self.out, self.sample_bytes = system.open_output_stream(inner, compression=None), sample_bytes
        self.held: list[bytes] | None = []
        self.held_bytes = self.records = 0
        self.packer = None

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.held is None:
            self.out.write(self.packer.compress(record))
            return
        self.held.append(record)
        self.held_bytes += len(record)
        if self.held_bytes >= self.sample_bytes:
            self._start()

    def _start(self) -> None:
        raw = train_dictionary([r[:DICTIONARY_BYTES] for r in self.held])
        frame = zstandard.ZstdCompressor().compress(raw)
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(frame)) + frame)
        self.packer = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(raw), write_checksum=True)
        for record in self.held:
            self.out.write(self.packer.compress(record))
        self.held = None

    def close(self) -> None:
        if self.held is not None:
            self._start()
        self.out.close()


def read_frames(stream):
    """The decoded records of an open .warc.zst stream, one at a time."""
    buffer = stream.read(CHUNK)
    if len(buffer) < 8:
        raise ValueError("archive without a leading frame")
    magic, size = struct.unpack("<II", buffer[:8])
    dictionary = None
    if magic == DICTIONARY_MAGIC:
        while len(buffer) < 8 + size:
            more = stream.read(CHUNK)
            if not more:
                raise ValueError("dictionary frame cut short")
            buffer += more
        raw, buffer = buffer[8:8 + size], buffer[8 + size:]
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=64 << 20)
        dictionary = _dictionary(raw)
    elif magic != FRAME_MAGIC:
        raise ValueError(f"unknown leading frame {magic:#x}")
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while True:
        if not buffer:
            buffer = stream.read(CHUNK)
            if not buffer:
                return
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not buffer:
                buffer = stream.read(CHUNK)
                if not buffer:
                    raise ValueError("record frame cut short")
            try:
                parts.append(frame.decompress(buffer))
            except zstandard.ZstdError as bad:
                raise ValueError(f"damaged frame: {bad}") from bad
            buffer = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Validated headers (lower-case names) and the block."""
    end = record.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("record without an end of headers")
    first, *lines = record[:end].split(b"\r\n")
    if first not in (b"WARC/1.0", VERSION):
        raise ValueError(f"unknown version line {first[:20]!r}")
    headers = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name.strip():
            raise ValueError(f"malformed header line {line[:60]!r}")
        headers[name.strip().lower()] = value.strip()
    for name in MANDATORY:
        if name not in headers:
            raise ValueError(f"record without {name}")
    if not headers["content-length"].isdigit():
        raise ValueError("Content-Length is not a number")
    block = record[end + 4:-4]
    if record[-4:] != b"\r\n\r\n" or len(block) != int(headers["content-length"]):
        raise ValueError("Content-Length does not match the block")
    return headers, block


def payload_of(headers: dict[str, str], block: bytes) -> tuple[int, str, bytes | None]:
    """(length, bare lower-case SHA-1, payload) of a response or revisit; revisits carry no payload."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("HTTP message without an end of headers")
    length = None
    for line in head.split(b"\r\n")[1:]:
        if line.lower().startswith(b"content-length:"):
            length = int(line.split(b":")[1])
    named = headers.get("warc-payload-digest", "")
    if not named.startswith("sha1:") or length is None:
        raise ValueError("record without a payload digest or length")
    digest = base64.b32decode(named[5:]).hex()
    if headers["warc-type"] == "revisit":
        return length, digest, None
    if len(payload) != length or hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("payload does not match its length or digest")
    return length, digest, payload


ARCHIVES = "path string, records long"
RECORDS = ("page_id long, url string, record_type string, record_id string, date string, payload_bytes long, "
           "payload_digest string, refers_to long, payload binary")


def _write_tasks(folder: str, archive_bytes: int, date: str):
    def run(batches):
        writer, path, size, done = None, None, 0, []
        for batch in batches:
            for page, url, html, keep in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                payload = (html or "").encode("utf-8")
                if writer is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    writer, size = ArchiveWriter(path), 0
                writer.add(build_record(page, url, date, payload, keep, keep is not None))
                size += len(payload)
                if size >= archive_bytes:
                    writer.close()
                    done.append((path, writer.records))
                    writer = None
        if writer is not None:
            writer.close()
            done.append((path, writer.records))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()),
                                          pa.array([d[1] for d in done], pa.int64())], ["path", "records"])

    return run


def _read_tasks(with_payload: bool):
    names = [part.split()[0] for part in RECORDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    def number(headers, name):
        return int(headers[name]) if name in headers else None

    def run(batches):
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, inner = _open(path)
                rows, held, seen = [], 0, 0
                with system.open_input_stream(inner, compression=None) as stream:
                    for record in read_frames(stream):
                        seen += 1
                        headers, block = parse_record(record)
                        length, digest, payload = payload_of(headers, block)
                        rows.append((number(headers, "x-page-id"), headers.get("warc-target-uri"), headers["warc-type"],
                                     headers["warc-record-id"], headers["warc-date"], length, digest,
                                     number(headers, "x-refers-to-page"), payload if with_payload else None))
                        held += len(record) if with_payload else 200
                        if held >= 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if expected is not None and seen != expected:
                    raise ValueError(f"{path} holds {seen} records instead of {expected}")
                if rows:
                    yield batch_of(rows)

    return run


def plan_revisits(pages: DataFrame, revisit_from: int = 1000, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """``pages`` with a column refers_to: for revisits the id of their response, else null."""
    body = filled(html)
    digests = F.when(F.octet_length(body) >= revisit_from, F.sha1(F.encode(body, "UTF-8")))
    marked = pages.withColumn("_digest", digests)
    keys = materialize(marked.filter(F.col("_digest").isNotNull()).select(F.col(id_col).alias("_id"), "_digest"), "payload-digests")
    repeats = Repeats(keys, "_digest")
    flagged = repeats.flag(marked, "_digest", "_maybe")
    maybe = F.col("_maybe") & F.col("_digest").isNotNull()
    straight = flagged.filter(~F.coalesce(maybe, F.lit(False))).withColumn("refers_to", F.lit(None).cast("long"))
    suspects = repeats.flag(keys, "_digest", "_maybe").filter("_maybe")
    groups = materialize(suspects.groupBy("_digest").agg(F.max("_id").alias("_last"), F.count(F.lit(1)).alias("_size")), "payload-groups")
    met = with_groups(flagged.filter(maybe), groups, "_digest", "_size", keys.count())
    met = met.withColumn("refers_to", F.when(~F.col(id_col).eqNullSafe(F.col("_last")), F.col("_last")))
    columns = [F.col(f"`{c}`") for c in pages.columns] + [F.col("refers_to")]
    return straight.select(*columns).unionByName(met.select(*columns))


def write_archives(pages: DataFrame, folder: str | None = None, revisit_from: int = 1000, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every row as a record; returns the written table (path, records) of finished archives."""
    spark = pages.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "warc"))
    system, inner = _open(folder)
    system.create_dir(inner, recursive=True)
    planned = plan_revisits(pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")),
                            revisit_from)
    return materialize(planned.select("page_id", "url", "html", "refers_to").mapInArrow(
        _write_tasks(folder, archive_bytes, date), ARCHIVES), "warc-list")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives (path, records; a null count is not compared), RECORDS columns."""
    spread = archives.select("path", "records").repartition(archives.sparkSession.sparkContext.defaultParallelism, F.xxhash64("path"))
    out = spread.mapInArrow(_read_tasks(with_payload), RECORDS)
    return out if with_payload else out.drop("payload")


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Any folder of .warc.zst files as a table for ``read_archives``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.lit(None).cast("long").alias("records"))
