"""WARC archives: record writing, and a splittable reader over gzip members."""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.llm.common import table
from claimworks.session import scratch_dir

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 18
SPLIT_BYTES = 32 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A gzip member without content; it ends, as every member below 16 MB does, with a zero byte.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def header_value(text: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(key, url, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC record: response with its payload, or a revisit with the HTTP header alone."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{key}>",
             f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(date):
    def run(batches):
        for batch in batches:
            keys, urls, bodies, refs = (batch.column(i) for i in range(4))
            out = []
            for i in range(batch.num_rows):
                body = bodies[i].as_py() or b""
                data = member(record(keys[i].as_py(), urls[i].as_py(), body, refs[i].as_py(), date))
                out.append(data[:-1])  # the sink's line end puts the last zero byte back
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    return run


def write_warc(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
    min_revisit_bytes: int = 0, date: str = DATE,
) -> None:
    """Write one gzip member per row below ``path``, files of concatenated members.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, those with the smallest key are
    responses and the others revisits that name it.  A null html is an empty payload, a null url leaves
    the header out, a null key is written as ``None`` and never chosen as the original; if all keys of a
    payload are null, all its rows are responses.  Rows repeated with the smallest key stay responses.

    The members go through Spark's own file sink, so a lost executor leaves no half-written file: the
    sink's line end is one zero byte, which is what a member ends with.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("body"),
    ).withColumn("digest", F.sha1("body"))
    first = (
        rows.where(F.length("body") >= min_revisit_bytes).groupBy("digest").agg(F.min("key").alias("first"))
        .where("first is not null")
    )
    ref = F.when(F.col("key").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("ref")
    (
        rows.join(first, "digest", "left").select("key", "url", "body", ref)
        .mapInArrow(members(date), "member binary")
        .select(F.col("member").cast("string").alias("value"))
        .write.mode("overwrite").option("lineSep", "\x00").option("compression", "none").text(path)
    )


def open_at(path: str):
    """A file of any store pyarrow knows, for random access."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


class Window:
    """Bytes of a file by position, through one buffer."""

    def __init__(self, handle, size):
        self.handle, self.size, self.at, self.buffer = handle, size, 0, b""

    def chunk(self, pos: int) -> bytes:
        """Some bytes from ``pos`` on; empty at the end of the file."""
        if not self.at <= pos < self.at + len(self.buffer):
            self.handle.seek(pos)
            self.at, self.buffer = pos, self.handle.read(min(CHUNK, self.size - pos))
        return self.buffer[pos - self.at:]

    def find_magic(self, pos: int, end: int) -> int:
        """First place in [pos, end) where gzip magic stands, or -1."""
        while pos < end:
            data = self.chunk(pos)
            if len(data) < len(MAGIC) and pos + len(data) < self.size:
                self.handle.seek(pos)
                self.at, self.buffer = pos, self.handle.read(min(CHUNK, self.size - pos))
                data = self.buffer
            hit = data.find(MAGIC)
            if hit >= 0:
                return pos + hit if pos + hit < end else -1
            if pos + len(data) >= self.size:
                return -1
            pos += max(1, len(data) - len(MAGIC) + 1)
        return -1

    def decode(self, pos: int, wanted: bytes = b"WARC/"):
        """(content, end) of the member at ``pos``; None if it is no sound member.

        The content is kept only if it starts as a WARC record does, so that a false hit costs a few bytes.
        """
        inflater, parts, kept, total = zlib.decompressobj(31), [], None, 0
        while pos < self.size:
            data = self.chunk(pos)
            try:
                out = inflater.decompress(data)
            except zlib.error:
                return None
            total += len(out)
            if kept is None or kept:
                parts.append(out)
            if kept is None and total >= len(wanted):
                kept = b"".join(parts).startswith(wanted)
                if not kept:
                    return None
            pos += len(data) - len(inflater.unused_data)
            if inflater.eof:
                return b"".join(parts), pos
        return None


def records_of(path: str, size: int, start: int, end: int):
    """(offset, content) of every WARC record whose member starts in [start, end)."""
    with open_at(path) as handle:
        window = Window(handle, size)
        pos = window.find_magic(start, end)
        while 0 <= pos < end:
            got = window.decode(pos)
            if got is None:
                pos = window.find_magic(pos + 1, end)
                continue
            content, after = got
            if content:
                yield pos, content
            pos = after if window.chunk(after)[: len(MAGIC)] == MAGIC else window.find_magic(after, end)


def parse(content: bytes) -> tuple[dict, bytes]:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    return fields, rest[: int(length)] if length.isdigit() else rest


RECORD = pa.schema(
    [("path", pa.string()), ("offset", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
     ("http_headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)
RECORD_DDL = "path string, offset long, headers map<string,string>, http_headers map<string,string>, payload binary"


def read_ranges(batches):
    for batch in batches:
        for path, size, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            rows, held = [], 0
            for offset, content in records_of(path, size, start, end):
                fields, block = parse(content)
                http = {}
                if fields.get("content-type", "").startswith("application/http"):
                    http, _ = parse(block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n")
                    block = block.partition(b"\r\n\r\n")[2]
                rows.append((path, offset, list(fields.items()), list(http.items()), block))
                held += len(content)
                if held >= 8 << 20:
                    yield as_batch(rows)
                    rows, held = [], 0
            yield as_batch(rows)


def as_batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(RECORD)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, RECORD)], schema=RECORD)


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per WARC record below ``path``: path, offset, headers, http_headers, payload.

    Every task takes a byte range of a file, looks for gzip magic, takes a candidate only if the member
    decodes and begins as a WARC record, and owns the records that start inside its range; it reads past
    the range's end to finish its last record.  Bytes that are no sound member are passed over, members
    without a record give nothing, and empty files or folders give no rows.  Header names are lower case.
    A payload that itself stores an uncompressed WARC member right at a range's start can be taken for a
    record of its own.
    """
    ranges = (
        spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length")
        .select(
            "path", "length",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
            .alias("start"),
        )
        .withColumn("stop", F.least(F.col("start") + split_bytes, F.col("length")))
    )
    tasks = max(1, min(10_000, 4 * spark.sparkContext.defaultParallelism))
    return ranges.repartition(tasks).mapInArrow(read_ranges, RECORD_DDL)


def op2_warc(spark, sf_dir):
    path = scratch_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records = read_warc(spark, path)
    kind = F.col("headers")["warc-type"]
    full = F.col("http_headers")["content-length"].cast("long")

    def page(header):
        return F.regexp_extract(F.col("headers")[header], "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    return records.select(
        page("warc-record-id").alias("page_id"),
        F.when(kind == "response", F.length("payload").cast("long")).otherwise(full).alias("payload_bytes"),
        F.regexp_replace(F.col("headers")["warc-payload-digest"], "^sha1:", "").alias("payload_digest"),
        kind.alias("record_type"),
        page("warc-refers-to").alias("refers_to"),
    )


QUERIES = {"op2_warc": op2_warc}
