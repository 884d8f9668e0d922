"""Legacy ARC archives and their conversion to WARC.

``write_arc`` writes pages as ARC files of version 1 or 2 (the legacy input);
``read_arc`` parses them: the file's own version block names the fields of its
record lines, and a record's declared length says where it ends. Every record
gets the WARC identifier, timestamp, type and digests that its ARC line stands
for: the version block becomes ``warcinfo``, an HTTP answer ``response``, anything
else (``dns:`` lookups, FTP files) ``resource``. ``mark_revisits`` turns repeated
payloads into revisits of the first; ``write_warc`` and ``read_warc`` store and
parse the WARC records.

Archives are read whether they are plain, one gzip stream, or compressed record by
record (members are read until the file ends). WARC is written record by record,
so that each can be reached alone, by Spark's text writer: its commit protocol
covers lost executors. A member ends with the length of its record, whose last
byte is zero under 16 MB, and longer records are followed by an empty member; that
zero byte is the writer's line end. Payloads are bytes throughout: ``payload``
holds them as text, or ``payload_raw`` where they are no UTF-8.

Files are read whole; Spark's limit of 2 GB a file holds, and files written here
end after ``FILE_RECORDS`` records.

Edge cases: NULL payloads count as empty; a NULL page id stays NULL and comes
after all others; white space in a URL is percent-encoded, a NULL URL is ``-``; a
page whose URL begins with ``filedesc://`` is a page; of records with the smallest
page id and equal payload, one is the response; repeated rows are records of their
own; an empty table gives an empty result; a file cut off inside a record or a gzip
member is an error. Extra columns of the input are not archived.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The field lines of the two versions of the ARC format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
LEAST = 100
FILE_RECORDS = 20_000
_RECORD = pa.schema([
    *((n, pa.string()) for n in ("record_id", "kind", "uri", "ip", "date", "media", "result_code", "checksum")),
    ("page_id", pa.int64()), ("http", pa.binary()), ("payload", pa.string()), ("payload_raw", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("block_digest", pa.string())])
_WARC = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("refers_to", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for f, c in zip(schema, zip(*rows, strict=True), strict=True)], schema=schema)


def member(record: bytes) -> bytes:
    """A gzip member of its own for one record, ending in a zero byte."""
    def pack(raw: bytes) -> bytes:
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        return z.compress(raw) + z.flush()

    return pack(record) if len(record) < 1 << 24 else pack(record) + pack(b"")


def members(content: bytes) -> Iterator[bytes]:
    """What each member of a gzip file holds; a plain file as it is."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    at = 0
    while content[at:at + 2] == b"\x1f\x8b":
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            piece = content[at:at + (1 << 16)]
            if not piece:
                raise ValueError("the file ends inside a gzip member")
            out.append(z.decompress(piece))
            at += len(piece)
        at -= len(z.unused_data)
        yield b"".join(out)
    if content[at:].strip(b"\0"):
        raise ValueError(f"{len(content) - at} bytes after the last gzip member are none")


def _parsed(pieces: Iterator[bytes], parse: Callable[[bytes, int, int], tuple | None]) -> Iterator[tuple]:
    """The records of a file that comes in pieces.

    ``parse(raw, at, offset)`` gives (record, end) of the record at ``at``, or None
    if more bytes are needed; ``offset`` is the place in the file of the first byte.
    """
    raw, at, offset = b"", 0, 0
    for piece in pieces:
        raw, offset, at = raw[at:] + piece, offset + at, 0
        while at < len(raw) and (found := parse(raw, at, offset)):
            record, at = found
            if record is not None:
                yield record
    if raw[at:].strip(b"\r\n\0 "):
        raise ValueError(f"the record at byte {offset + at} declares more than the {len(raw) - at} bytes that are left")


def _write_members(records: DataFrame, path: str) -> None:
    """Write ``value`` (bytes without the closing zero) as files of gzip members."""
    text = records.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", "\0").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _line(version: int, url: str, date: str, media: str, name: str, length: int) -> str:
    if version == 1:
        return f"{url} 0.0.0.0 {date} {media} {length}\n"
    return f"{url} 0.0.0.0 {date} {media} 200 - - 0 {name} {length}\n"


def _write_arc(version: int, date: str, by_record: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, n = "", 0
        for batch in batches:
            out = []
            for page, url, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                head = b""
                if n % FILE_RECORDS == 0:
                    # each file begins with its version block
                    name = f"pages-{uuid.uuid4().hex}.arc"
                    fields = f"{version} 0 tabrix\n{FIELDS[version]}\n"
                    tail = f" 200 - - 0 {name}" if version == 2 else ""
                    head = f"filedesc://{name} 0.0.0.0 {date} text/plain{tail} {len(fields)}\n{fields}\n".encode()
                n += 1
                url = re.sub(r"[\x00-\x20\x7f-\xa0]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "-")
                body = body or b""
                block = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                         f"X-Page-Id: {'' if page is None else page}\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body
                record = _line(version, url, date, "text/html", name, len(block)).encode() + block
                if by_record:
                    out.append(((member(head) if head else b"") + member(record + b"\n"))[:-1])
                else:
                    out.append(head + record)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    return run


def write_arc(pages: DataFrame, path: str, version: int, page_id: str = "page_id", url: str = "url", html: str = "html",
              date: str = "20000101000000", by_record: bool = False) -> None:
    """Write ``pages`` (``html`` as text or bytes) as ARC files, gzipped as a whole or record by record."""
    rows = pages.select(F.col(page_id).cast("long"), url, F.col(html).cast("binary"))
    rows = rows.mapInArrow(_write_arc(version, date, by_record), "value binary")
    if by_record:
        _write_members(rows, path)
    else:
        text = rows.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", FILE_RECORDS)
        text.option("compression", "gzip").option("lineSep", "\n").text(path)


def _arc_records(raw: bytes | Iterator[bytes]) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(fields, offset, block) of each record of one ARC file."""
    names = FIELDS[1].split()

    def parse(raw: bytes, at: int, offset: int) -> tuple | None:
        nonlocal names
        end = raw.find(b"\n", at)
        if end < 0:
            return None
        line = _text(raw[at:end])
        if not line.strip():  # between records
            return None, end + 1
        known = names
        if offset + at == 0 and line.startswith("filedesc://"):
            # the version block says how this and all later lines are laid out
            size = int(line.rsplit(" ", 1)[1])
            if len(raw) < end + 1 + size:
                return None
            known = raw[end + 1: end + 1 + size].decode().split("\n")[1].split()
        parts = line.rsplit(" ", len(known) - 1)
        if len(parts) != len(known):
            raise ValueError(f"ARC line at byte {offset + at} has {len(parts)} fields, not {len(known)}: {line[:200]!r}")
        fields = dict(zip(known, parts, strict=True))
        stop = end + 1 + int(fields["Archive-length"])
        if len(raw) < stop:
            return None
        names = known
        return (fields, offset + at, raw[end + 1: stop]), stop

    return _parsed(iter([raw]) if isinstance(raw, bytes) else raw, parse)


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _header(block: str, name: str) -> str | None:
    found = re.search(rf"^{name}: *([^\r\n]*)", block, re.M | re.I)
    return found[1] if found else None


def _page(head: str) -> int | None:
    page = _header(head, "X-Page-Id")
    return int(page) if page and re.fullmatch(r"-?\d+", page) else None


def _hex(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    """(status and header lines with the blank line, payload) of an HTTP answer."""
    ends = [(block.find(x), len(x)) for x in (b"\r\n\r\n", b"\n\n")]
    at = min((a + n for a, n in ends if a >= 0), default=len(block))
    return block[:at], block[at:]


def _record(path: str, fields: dict[str, str], at: int, block: bytes) -> tuple:
    """What WARC says of one ARC record."""
    d, url = fields["Archive-date"], fields["URL"]
    d += "00000101000000"[len(d):]
    kind = "warcinfo" if at == 0 and url.startswith("filedesc://") else "response" if block.startswith(b"HTTP/") else "resource"
    head, body = _split_http(block) if kind == "response" else (b"", block)
    name = f"{path.rsplit('/', 1)[-1]}:{at}:{url}:{d}"
    try:
        text, raw = body.decode(), None
    except UnicodeDecodeError:
        text, raw = None, body
    return (f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", kind, url, fields["IP-address"],
            f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", fields["Content-type"],
            fields.get("Result-code"), fields.get("Checksum"), _page(_text(head)), head, text, raw, len(body), _hex(body), _hex(block))


def _convert(info: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out = []
                for fields, at, block in _arc_records(members(content)):
                    row = _record(path, fields, at, block)
                    if info or row[1] != "warcinfo":
                        out.append(row)
                    if len(out) >= 500:
                        yield _batch(out, _RECORD)
                        out = []
                if out:
                    yield _batch(out, _RECORD)

    return run


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path`` whose name does not begin with ``_`` or a dot."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content")


def read_arc(spark: SparkSession, path: str, info: bool = False) -> DataFrame:
    """One row per record of the ARC files under ``path``, with what WARC needs; ``info``: version blocks as well."""
    return _files(spark, path).mapInArrow(_convert(info), _ddl(_RECORD))


def mark_revisits(records: DataFrame, least: int = LEAST) -> DataFrame:
    """``records`` with ``refers_to``: the response whose equal payload of at least ``least`` bytes comes first."""
    repeats = (F.col("kind") == "response") & (F.col("payload_bytes") >= least)
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col("record_id").alias("first"))
    firsts = records.where(repeats).groupBy("payload_digest").agg(F.min(order).alias("o"))
    firsts = firsts.select("payload_digest", F.col("o.first").alias("first"))
    out = records.join(firsts, "payload_digest", "left")
    again = repeats & (F.col("first") != F.col("record_id"))
    return out.withColumn("refers_to", F.when(again, F.col("first"))).drop("first")


def warc_record(revisit: Column) -> Column:
    """The bytes of a WARC record."""
    # a cast of bytes to a string keeps them as they are
    payload = F.coalesce(F.col("payload"), F.col("payload_raw").cast("string"))
    block = F.concat(F.col("http").cast("string"), F.when(revisit, F.lit("")).otherwise(payload))
    is_http, named = F.col("kind") == "response", lambda n, c: F.concat(F.lit(f"{n}: "), c)
    head = [
        F.lit("WARC/1.1"),
        named("WARC-Type", F.when(revisit, "revisit").otherwise(F.col("kind"))),
        named("WARC-Record-ID", F.col("record_id")),
        named("WARC-Date", F.col("date")),
        F.when(F.col("kind") == "warcinfo", named("WARC-Filename", F.substring_index("uri", "://", -1))).otherwise(
            named("WARC-Target-URI", F.col("uri"))),
        named("WARC-IP-Address", F.col("ip")),
        named("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(~revisit, named("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.col("block_digest")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, named("WARC-Refers-To", F.col("refers_to"))),
        # what only ARC knows of
        named("X-ARC-Result-Code", F.col("result_code")),
        F.when(F.col("checksum") != "-", named("X-ARC-Checksum", F.col("checksum"))),
        named("X-ARC-Content-Type", F.col("media")),
        named("Content-Type", F.when(is_http, "application/http; msgtype=response").when(
            F.col("kind") == "warcinfo", "text/plain").otherwise(F.col("media"))),
        named("Content-Length", F.octet_length(block)),
    ]
    return F.concat(F.array_join(F.array(*head), "\r\n"), F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n")).cast("binary")


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([member(r)[:-1] for r in batch.column(0).to_pylist()], pa.binary())], names=["value"])


def write_warc(records: DataFrame, path: str) -> None:
    """Write ``mark_revisits`` records as WARC files, compressed record by record."""
    raw = records.select(warc_record(F.col("refers_to").isNotNull()).alias("value"))
    _write_members(raw.mapInArrow(_compress, "value binary"), path)


def _warc_records(raw: bytes | Iterator[bytes]) -> Iterator[tuple[str, bytes]]:
    """(header lines, block) of each record of one WARC file."""

    def parse(raw: bytes, at: int, offset: int) -> tuple | None:
        if raw[at:at + 2] == b"\r\n":  # between records
            return None, at + 2
        end = raw.find(b"\r\n\r\n", at)
        if end < 0:
            return None
        head = _text(raw[at:end])
        size = _header(head, "Content-Length")
        if not head.startswith("WARC/") or size is None:
            raise ValueError(f"no WARC record at byte {offset + at}")
        stop = end + 4 + int(size)
        return ((head, raw[end + 4:stop]), stop) if len(raw) >= stop else None

    return _parsed(iter([raw]) if isinstance(raw, bytes) else raw, parse)


def _index_row(head: str, block: bytes) -> tuple:
    kind = _header(head, "WARC-Type")
    is_http = (_header(head, "Content-Type") or "").startswith("application/http")
    http, body = _split_http(block) if is_http else (b"", block)
    lines = _text(http)
    declared = _header(head, "WARC-Payload-Digest") or ""
    digest = declared.removeprefix("sha256:") if declared.startswith("sha256:") else _hex(body)
    size = len(body)
    if kind == "revisit":
        # the payload is elsewhere: its length is what the headers say
        size = int(_header(lines, "Content-Length") or 0)
    elif declared.startswith("sha256:") and _hex(body) != digest:
        raise ValueError(f"the payload of {_header(head, 'WARC-Record-ID')} does not have its digest")
    return (_header(head, "WARC-Record-ID"), kind, _page(lines), size, digest, _header(head, "WARC-Refers-To"))


def _parse_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(1).to_pylist():
            rows = []
            for head, block in _warc_records(members(content)):
                rows.append(_index_row(head, block))
                if len(rows) >= 5000:
                    yield _batch(rows, _WARC)
                    rows = []
            if rows:
                yield _batch(rows, _WARC)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record under ``path``; payloads are checked against their digests."""
    return _files(spark, path).mapInArrow(_parse_warc, _ddl(_WARC))
