"""WARC archives: a writer and a splittable reader.

**Writer.**  Every record is a gzip member of its own.  Spark's text writer puts the
members into files, so its commit protocol keeps lost and repeated tasks out: the line
separator is a zero byte and each line is a member without its last byte, which is zero
as long as the member ends with a short text (a longer record is followed by an empty
member, which readers skip).  The files are plain concatenations of members.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the
smallest id is a ``response``; the others are ``revisit`` records that name it.  First
records are found by an aggregate over digests, and the few digests that occur twice or
more join back; Spark broadcasts them only if their written size allows it.

**Reader.**  Files are cut into byte ranges, one task takes some ranges.  It scans its
range for the gzip magic and tells a record from chance by decoding the candidate's
start: a gzip header, deflate data and a ``WARC/`` version line.  A record belongs to the
range in which it starts, and is read to its end wherever that is.  What looks like a
record but lies inside one that started earlier (an archive stored in an archive) is
dropped by comparing offsets with the ends before them.  A member that breaks off or has
a wrong checksum gives a row with ``error``, and reading goes on at the next member.

Defined cases: a null html is an empty payload; a null id sorts last and is written
without its header; of equal ids one is the response and the others revisit it; an empty
table writes no record; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.llm.common import small_batches, staged
from logweave.session import checkpoint_dir

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"

MIN_REVISIT = 100
RANGE_BYTES = 32 << 20
#: Bytes read at a time, and of a candidate decoded to judge it.
CHUNK = 1 << 20
PROBE = 64
#: A member's last byte is the top byte of its length: zero below this.
_SHORT = 1 << 24
DATE = "1970-01-01T00:00:00Z"
_EMPTY_MEMBER = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])


# ------------------------------------------------------------------- records
def record_id(rid: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page-{rid}')}>"


def _field(name: str, value: object) -> bytes:
    """A header line; line ends and control characters in the value become spaces."""
    clean = "".join(" " if c < " " or c == "\x7f" else c for c in str(value))
    return f"{name}: {clean}\r\n".encode("utf-8", "replace")


def build_record(rid: int, page_id: object, url: str | None, payload: bytes, digest: str,
                 first: int | None, date: str = DATE) -> bytes:
    """A response record, or a revisit of the record numbered ``first``."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = http + payload if first is None else http
    head = [VERSION + b"\r\n", _field("WARC-Type", "response" if first is None else "revisit"),
            _field("WARC-Record-ID", record_id(rid)), _field("WARC-Date", date)]
    if url is not None:
        head.append(_field("WARC-Target-URI", url))
    if page_id is not None:
        head.append(_field("X-Page-ID", page_id))
    head.append(_field("WARC-Payload-Digest", f"sha256:{digest}"))
    if first is not None:
        head += [_field("WARC-Profile", REVISIT_PROFILE), _field("WARC-Refers-To", record_id(first))]
    head += [_field("Content-Type", "application/http; msgtype=response"),
             _field("Content-Length", len(block)), b"\r\n"]
    return b"".join(head) + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 6) -> bytes:
    """The record as a gzip member whose last byte is zero."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    member = z.compress(record) + z.flush()
    return member if len(record) < _SHORT else member + _EMPTY_MEMBER


def parse_record(raw: bytes) -> dict | None:
    """Headers and block of a decoded record, or None if it is none."""
    if not raw.startswith(b"WARC/"):
        return None
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    headers: dict[str, str] = {}
    for line in raw[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            headers[name.strip().decode("utf-8", "replace").lower()] = \
                value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isdigit():
        return None
    block = raw[end + 4:end + 4 + int(length)]
    if len(block) < int(length):
        return None
    return {"headers": headers, "block": block}


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(head, body) of an HTTP message."""
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end], block[end + 4:])


# -------------------------------------------------------------------- writer
def with_first(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``rid, page_id, url, payload`` plus ``digest`` and ``first``: the rid of the response
    that the page revisits, null for a response."""
    keyed = pages.withColumn("digest", F.sha2("payload", 256))
    firsts = staged(
        keyed.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
        .agg(F.count("*").alias("n"),
             F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "rid")).alias("m"))
        .filter("n > 1").select("digest", F.col("m.rid").alias("first")), "warc-firsts")
    return keyed.join(firsts, "digest", "left").withColumn(
        "first", F.when(F.col("first") != F.col("rid"), F.col("first")))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_bytes: int = MIN_REVISIT) -> None:
    """Write a record per page to files under ``path``."""
    spark = pages.sparkSession
    small_batches(spark)
    numbered = pages.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = staged(numbered, "warc-pages")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 32):
                out = []
                for r in batch.slice(lo, 32).to_pylist():
                    out.append(gzip_member(build_record(
                        r["rid"], r["page_id"], r["url"], r["payload"], r["digest"], r["first"]))[:-1])
                yield pa.record_batch([pa.array(out, pa.binary())], names=["member"])

    (with_first(rows, min_bytes).select("rid", "page_id", "url", "payload", "digest", "first")
     .mapInArrow(members, "member binary")
     .select(F.col("member").cast("string").alias("value"))
     .write.option("lineSep", "\x00").option("compression", "none").text(path))


# -------------------------------------------------------------------- reader
class _Bytes:
    """Bytes of an open file from a place on, read on demand."""

    def __init__(self, file, at: int) -> None:
        self.file, self.at, self.buf, self.over = file, at, b"", False
        file.seek(at)

    def fill(self, n: int) -> bool:
        """Hold at least n bytes; False if the file ends before."""
        while len(self.buf) < n and not self.over:
            more = self.file.read(max(CHUNK, n - len(self.buf)))
            self.over = not more
            self.buf += more
        return len(self.buf) >= n

    def drop(self, n: int) -> None:
        self.buf = self.buf[n:]
        self.at += n


def _is_record(head: bytes) -> bool:
    """Does a gzip member that decodes to a version line start here?"""
    z = zlib.decompressobj(31)
    try:
        return z.decompress(head, PROBE).startswith(b"WARC/")
    except zlib.error:
        return False


def _member(src: _Bytes) -> tuple[bytes | None, int]:
    """(decoded, length) of the member at the start of ``src``; None if it is broken."""
    z, out, used = zlib.decompressobj(31), [], 0
    while True:
        if not src.fill(used + 1):
            return None, used
        part = src.buf[used:used + CHUNK]
        try:
            out.append(z.decompress(part))
        except zlib.error:
            return None, used
        used += len(part) - len(z.unused_data)
        if z.eof:
            return b"".join(out), used


def scan_range(file, start: int, end: int) -> Iterator[tuple[int, int, bytes | None]]:
    """(offset, end, decoded member) of the records that start in [start, end); decoded
    is None for a broken one."""
    src = _Bytes(file, start)
    while src.at < end and src.fill(len(MAGIC)):
        hit = src.buf.find(MAGIC)
        if hit < 0:
            src.drop(len(src.buf) - len(MAGIC) + 1)     # the magic may go on in the next chunk
            continue
        src.drop(hit)
        if src.at >= end:
            return
        src.fill(4096)
        if not _is_record(src.buf[:4096]):
            src.drop(1)
            continue
        at = src.at
        raw, length = _member(src)
        src.drop(length if raw is not None else len(MAGIC))
        yield at, src.at, raw


def _opened(path: str):
    from pyarrow.fs import FileSystem
    fs, inner = FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return fs.open_input_file(inner)


def _rows(path: str, file, start: int, end: int, with_payload: bool) -> Iterator[dict]:
    for at, stop, raw in scan_range(file, start, end):
        row = {"path": path, "offset": at, "end": stop}
        rec = parse_record(raw) if raw is not None else None
        if rec is None:
            yield row | {"error": "broken member" if raw is None else "no record"}
            continue
        h = rec["headers"]
        body = rec["block"]
        http = h.get("content-type", "").startswith("application/http")
        if http:
            head, body = split_http(body)
            declared = [x.split(b":", 1)[1].strip() for x in head.split(b"\r\n")
                        if x.lower().startswith(b"content-length:")]
            row["http_length"] = int(declared[0]) if declared and declared[0].isdigit() else None
        kind = h.get("warc-type")
        if kind != "revisit":
            row |= {"payload_bytes": len(body), "payload_sha256": hashlib.sha256(body).hexdigest()}
            if with_payload:
                row["payload"] = body
        row |= {"warc_type": kind, "record_id": h.get("warc-record-id"), "refers_to": h.get("warc-refers-to"),
                "target_uri": h.get("warc-target-uri"), "payload_digest": h.get("warc-payload-digest"),
                "headers": list(h.items())}
        yield row


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES,
              with_payload: bool = True) -> DataFrame:
    """One row per record of the gzip archives under ``path``: path, offset, end, warc_type,
    record_id, target_uri, refers_to, payload_digest (as written), payload_bytes and
    payload_sha256 (of the payload read; null for a revisit), http_length (as the HTTP
    head has it), headers (names in lower case), error (null if the record is whole) and,
    if asked for, payload.

    Tasks open byte ranges through pyarrow's file systems (local and shared folders, S3,
    GCS, HDFS).  A file of any other scheme is read whole by Spark and scanned in memory,
    so such files should be small (up to 2 GB)."""
    small_batches(spark)
    fields = [("path", pa.string()), ("offset", pa.int64()), ("end", pa.int64()),
              ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
              ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_sha256", pa.string()), ("http_length", pa.int64()),
              ("headers", pa.map_(pa.string(), pa.string())), ("error", pa.string())]
    if with_payload:
        fields.append(("payload", pa.binary()))
    arrow = pa.schema(fields)
    ddl = ("path string, offset long, end long, warc_type string, record_id string, target_uri string, "
           "refers_to string, payload_digest string, payload_bytes long, payload_sha256 string, "
           "http_length long, headers map<string,string>, error string"
           + (", payload binary" if with_payload else ""))

    def batched(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for r in rows:
            held.append(r)
            size += 1000 + len(r.get("payload") or b"")
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with _opened(r["path"]) as file:
                    yield from batched(_rows(r["path"], file, r["start"], r["start"] + range_bytes,
                                             with_payload))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield from batched(_rows(r["path"], io.BytesIO(r["content"]), 0, len(r["content"]),
                                         with_payload))

    files = spark.read.format("binaryFile").load(path)
    scheme = path.split(":", 1)[0] if ":" in path else "file"
    if scheme in ("file", "s3", "gs", "gcs", "hdfs"):
        cut = files.select("path", F.explode(F.sequence(
            F.lit(0).cast("long"), F.greatest(F.lit(0), F.col("length") - 1),
            F.lit(range_bytes).cast("long"))).alias("start"))
        n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        found = cut.repartition(n, "path", "start").mapInArrow(ranges, ddl)
    else:
        found = files.select("path", "content").mapInArrow(whole, ddl)
    seen = Window.partitionBy("path").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    return (found.withColumn("_before", F.coalesce(F.max("end").over(seen), F.lit(0)))
            .filter(F.col("offset") >= F.col("_before")).drop("_before"))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_bytes: int = MIN_REVISIT, path: str | None = None) -> DataFrame:
    """Write the pages, read the archives back and resolve the revisits.

    page_id, url, payload_bytes, payload_digest, record_type, refers_to (the page_id of
    the response that a revisit names).  A revisit has the digest and length of the
    response found in the archive.  A record that is broken, or whose payload does not
    have the digest or length it was written with, raises."""
    spark = pages.sparkSession
    if path is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    id_type = pages.schema[id_col].dataType
    write_warc(pages, path, id_col, url_col, html_col, min_bytes)
    read = staged(read_warc(spark, path, with_payload=False).select(
        "record_id", "warc_type", "refers_to", F.col("target_uri").alias("url"),
        F.col("headers")["x-page-id"].cast(id_type).alias("page_id"),
        F.substring_index("payload_digest", ":", -1).alias("digest"), "payload_bytes",
        "payload_sha256", "http_length", "error", "path", "offset"), "warc-read")
    first = read.filter("warc_type = 'response'").select(
        F.col("record_id").alias("first_id"), F.col("page_id").alias("first_page"),
        F.col("payload_bytes").alias("first_bytes"), F.col("payload_sha256").alias("first_sha"))
    named = read.filter("warc_type = 'revisit'").select(F.col("refers_to").alias("first_id")).distinct()
    first = staged(first.join(named, "first_id", "left_semi"), "warc-named")
    got = read.join(first, read.refers_to == first.first_id, "left").withColumns({
        "n": F.coalesce("payload_bytes", "first_bytes"), "sha": F.coalesce("payload_sha256", "first_sha")})
    whole = (F.col("error").isNull() & F.coalesce(F.col("sha") == F.col("digest"), F.lit(False))
             & F.coalesce(F.col("n") == F.col("http_length"), F.lit(False)))
    sha = F.when(whole, F.col("sha")).otherwise(F.raise_error(
        F.concat(F.lit("damaged record at "), "path", F.lit(":"), F.col("offset").cast("string"))))
    return got.select("page_id", "url", F.col("n").alias("payload_bytes"), sha.alias("payload_digest"),
                      F.col("warc_type").alias("record_type"),
                      F.when(F.col("warc_type") == "revisit", F.col("first_page")).alias("refers_to"))
