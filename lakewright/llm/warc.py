"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: records with equal payloads become one response and revisits of it. Reading streams an archive:
the dictionary comes from the leading skippable frame, every further frame must decode to exactly one
record, and the record's version line, headers, lengths and payload digest are checked.
Archives are files below the shared scratch folder, which every executor must see (a path that
pyarrow.fs opens: file, hdfs, s3 and the like).
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import least_hashed, spread_lookup, staged
from lakewright.session import scratch_path

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads of fewer bytes are stored again rather than referred to.
LEAST_SHARED = 1000
#: An archive is closed when it holds this many bytes.
ARCHIVE_BYTES = 64 << 20
#: The dictionary is fitted on the first bytes of this many pages; it changes sizes only, never contents.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 4096, 32 << 10
DATE = "2000-01-01T00:00:00Z"
READ_BYTES = 256 << 10
MANIFEST = "path string, records long, bytes long"
RECORD = ("path string, record long, record_type string, page_id long, refers_to long, url string, "
          "payload_bytes long, payload_digest string, payload binary")


class WarcError(ValueError):
    """An archive that does not follow the format."""


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary fitted on ``samples``; empty if they are too few."""
    try:
        return zstandard.train_dictionary(size, [s for s in samples if s]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record_bytes(kind: str, page_id: int | None, refers_to: int | None, url: str | None, payload: bytes, digest: str) -> bytes:
    """A response or revisit record; the block of a revisit is the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + b"\r\n" + block + b"\r\n\r\n"


def _write(root: str, dict_bytes: bytes, limit: int):
    def run(batches):
        filesystem, folder = fs.FileSystem.from_uri(root)
        shared = zstandard.ZstdCompressionDict(dict_bytes) if dict_bytes else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True)
        out, path, rows, size = None, None, 0, 0

        def manifest():
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([rows], pa.int64()), pa.array([size], pa.int64())],
                                              names=["path", "records", "bytes"])
        for batch in batches:
            for r in range(batch.num_rows):
                page_id, url, html, digest, refers_to = (c[r].as_py() for c in batch.columns)
                if out is None:  # a name of its own for every attempt; only the manifest's archives count
                    name = f"part-{uuid.uuid4().hex}.warc.zst"
                    path, rows, size = f"{root}/{name}", 0, 0
                    out = filesystem.open_output_stream(f"{folder}/{name}")
                    if dict_bytes:
                        frame = zstandard.ZstdCompressor().compress(dict_bytes)
                        out.write(struct.pack("<II", SKIPPABLE, len(frame)) + frame)
                        size = len(frame) + 8
                kind = "response" if refers_to is None else "revisit"
                frame = packer.compress(record_bytes(kind, page_id, refers_to, url, html or b"", digest))
                out.write(frame)
                rows, size = rows + 1, size + len(frame)
                if size >= limit:
                    out.close()
                    out = None
                    yield manifest()
        if out is not None:
            out.close()
            yield manifest()
    return run


def frames(stream, read_bytes: int = READ_BYTES):
    """Decoded records of an open archive, in order; the dictionary frame is loaded and left out."""
    data = stream.read(max(8, read_bytes))
    shared = None
    if len(data) >= 4 and struct.unpack("<I", data[:4])[0] == SKIPPABLE:
        if len(data) < 8:
            raise WarcError("cut off in the dictionary frame's header")
        size = struct.unpack("<I", data[4:8])[0]
        while len(data) < 8 + size:
            more = stream.read(max(read_bytes, 8 + size - len(data)))
            if not more:
                raise WarcError("cut off in the dictionary frame")
            data += more
        raw, data = data[8:8 + size], data[8 + size:]
        shared = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == FRAME_MAGIC else raw)
    reader = zstandard.ZstdDecompressor(dict_data=shared)
    while True:
        data = data or stream.read(read_bytes)
        if not data:
            return
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if not data:
                data = stream.read(read_bytes)
                if not data:
                    raise WarcError("cut off within a frame")
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise WarcError(f"not a Zstandard frame: {e}") from e
            data = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a frame that must hold one whole record and nothing else."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise WarcError("no WARC version line or no end of headers")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise WarcError(f"malformed header line {line[:60]!r}")
        if (key := name.decode("utf-8").strip().lower()) in headers:
            raise WarcError(f"header {key} is given twice")
        headers[key] = value.decode("utf-8").strip()
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in headers:
            raise WarcError(f"header {need} is missing")
    if not re.fullmatch(r"[0-9]+", headers["content-length"]):
        raise WarcError("Content-Length is not a number")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(rest) - 4} bytes, Content-Length {size}")
    return headers, rest[:size]


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?[0-9]*)>", urn or "")
    if not m:
        raise WarcError(f"record id {urn!r} is not a page's")
    return int(m[1]) if m[1] else None


def read_record(raw: bytes) -> tuple:
    """(record_type, page_id, refers_to, url, payload_bytes, payload_digest, payload) of one decoded frame."""
    headers, block = parse_record(raw)
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"unexpected record type {kind!r}")
    http, sep, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"\r\ncontent-length:[ \t]*([0-9]+)(?=\r\n|\Z)", http, re.I)
    if not sep or not http.startswith(b"HTTP/") or not length:
        raise WarcError("the block is no HTTP response with a length")
    size = int(length[1])
    m = re.fullmatch(r"sha1:([0-9a-f]{40})", headers.get("warc-payload-digest", ""))
    if not m:
        raise WarcError("no SHA-1 payload digest")
    if kind == "revisit":
        if payload or headers.get("warc-profile") != REVISIT_PROFILE:
            raise WarcError("a revisit with a payload or an unknown profile")
        return kind, _page(headers["warc-record-id"]), _page(headers.get("warc-refers-to")), headers.get("warc-target-uri"), size, m[1], None
    if len(payload) != size:
        raise WarcError(f"payload of {len(payload)} bytes, HTTP length {size}")
    if hashlib.sha1(payload).hexdigest() != m[1]:
        raise WarcError("the payload does not have its digest")
    return kind, _page(headers["warc-record-id"]), None, headers.get("warc-target-uri"), size, m[1], payload


def _read(with_payload: bool):
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        for b in batches:
            for path, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                filesystem, name = fs.FileSystem.from_uri(path)
                rows, held, n = [], 0, 0
                with filesystem.open_input_stream(name) as stream:
                    for n, raw in enumerate(frames(stream), 1):
                        try:
                            got = read_record(raw)
                        except WarcError as e:
                            raise WarcError(f"{path}, record {n}: {e}") from e
                        rows.append((path, n, *got[:-1], got[-1] if with_payload else None))
                        held += len(raw) if with_payload else 200
                        if held > 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if n != records:
                    raise WarcError(f"{path}: {n} records, the manifest has {records}")
                if rows:
                    yield batch(rows)
    return run


def write_archives(pages: DataFrame, least_shared: int = LEAST_SHARED, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html); returns the manifest (path, records, bytes).

    Null html is an empty payload, a null url gives no target. Of equal payloads of at least ``least_shared`` bytes
    the row with the largest page_id is the response and the others revisit it; rows that repeat that page_id are
    responses too, and so are all rows of a group without any page_id. Extra columns are not read. An empty
    table gives no archive.
    """
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", F.encode(html, "UTF-8").alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("digest"))
    shared = (rows.where(F.length("html") >= least_shared).groupBy("digest")
              .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1 AND response IS NOT NULL").drop("n"))
    found = spread_lookup(rows, staged(shared, "warc-shared"), "digest")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    picked = least_hashed(pages.select("page_id").distinct(), SAMPLE_PAGES, "dictionary")
    samples = (pages.where(F.length("html") > 0).join(F.broadcast(picked), "page_id")
               .select(F.encode(F.substring("html", 1, SAMPLE_BYTES), "UTF-8").alias("s")).limit(SAMPLE_PAGES).collect())
    root = scratch_path(spark, "llm", "warc", unique=True)
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    filesystem, folder = fs.FileSystem.from_uri(root)
    filesystem.create_dir(folder, recursive=True)
    write = _write(root, dictionary([bytes(r["s"]) for r in samples]), archive_bytes)
    return staged(found.select("page_id", "url", "html", "digest", refers.alias("refers_to")).mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of a manifest's archives; any fault of format, length, digest or record count is an error."""
    n = max(1, min(manifest.count(), 10_000))
    return manifest.select("path", "records").repartition(n).mapInArrow(_read(with_payload), RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` (without payload) where every revisit has been held against the response it refers to:
    ``verified`` is true if that response is in the archives with the same digest and length."""
    kept = staged(records.drop("payload").withColumn("target", F.concat_ws(":", F.col("refers_to").cast("string"), "payload_digest")), "warc-records")
    responses = staged(kept.where("record_type = 'response'").groupBy(
        F.concat_ws(":", F.col("page_id").cast("string"), "payload_digest").alias("target")).agg(F.max("payload_bytes").alias("found_bytes")), "warc-responses")
    out = spread_lookup(kept, responses, "target")
    ok = (F.col("record_type") == "response") | (F.col("found_bytes").eqNullSafe(F.col("payload_bytes")))
    return out.withColumn("verified", ok).drop("target", "found_bytes")
