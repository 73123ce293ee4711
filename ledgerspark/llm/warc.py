"""WARC archives of pages, and a reader that salvages what lies behind damage.

An archive is a series of gzip members of one record each. Spark's text sink commits the files, on any file system: a
line is a piece of an archive, and the line separator an empty member, such as block-compressed formats end with.
Equal payloads of at least MIN_REVISIT bytes are stored once; the others are revisit records that refer to it.

The reader checks every member (magic number, checksums, length) and every record in it (version line, header, block
length, digests). After a failed check it searches for the next place at which all checks hold, a member or the version
line of an uncompressed record, goes on there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import record

MIN_REVISIT = 1000
#: Bytes of compressed records that a task gathers for a file, beyond one record. A reader's task holds one file.
ARCHIVE_BYTES = 32 << 20
LEVEL = 6
#: Bytes inflated at once; a member's record may be of any size.
INFLATE = 1 << 20
#: Of a version line or header that never ends.
MAX_HEADER = 1 << 20

# The words of the format.
VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/\d{1,4}\.\d{1,4}\r?\n")
HEADER_END = re.compile(rb"\r?\n\r?\n")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = b"\x1f\x8b\x08\0\0\0\0\0\0\x03\x03\0\0\0\0\0\0\0\0\0"

PIECE = pa.schema([("piece", pa.binary())])
FOUND = pa.schema(
    [(c, pa.string()) for c in ("path", "kind")]
    + [(c, pa.int64()) for c in ("offset", "length")]
    + [(c, pa.string()) for c in ("reason", "record_type", "record_id", "refers_to", "uri", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)
FOUND_SQL = (
    "path string, kind string, offset long, length long, reason string, record_type string, record_id string, refers_to string, "
    "uri string, payload_digest string, payload_bytes long, headers map<string,string>, payload binary"
)


# --- writing --------------------------------------------------------------------------------


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, head, is_head: every page with the page that holds its payload, null where it is its own.

    Pages are told to be equal by SHA-256 and length. Only the ids and digests of pages meet to find groups; the groups of
    more than one page go back to the pages. A group is one row there, however many pages it has.
    """
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    key = F.when(F.octet_length("payload") >= MIN_REVISIT, F.sha2("payload", 256))
    groups = own.select("page_id", key.alias("same")).where("same IS NOT NULL").groupBy("same").agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
    return own.withColumn("same", key).join(groups.where("n > 1").select("same", "head"), "same", "left").select("page_id", "url", "payload", "head")


def _pack(date: str, archive_bytes: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "head")]
            for row in zip(*columns):
                page, url, payload, head = (x.as_py() for x in row)
                held.append(member(written(page, url, payload, head, date)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield record(PIECE, [b"".join(held)])
                    held, size = [], 0
        if held:
            yield record(PIECE, [b"".join(held)])

    return make


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def sha1_label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def page_uri(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def page_of(uri: Column) -> Column:
    """The page id of a record id or reference, null where it has none."""
    return F.regexp_extract(uri, r"^<urn:page:(-?\d+)[:>]", 1).try_cast("long")


def written(page: int | None, url: str | None, payload: bytes, head: int | None, date: str) -> bytes:
    """One record: the response, or a revisit of the page ``head`` that keeps the response's HTTP header only."""
    digest = hashlib.sha1(payload).digest()
    revisit = head is not None and page != head
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = answer if revisit else answer + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", page_uri(page)[:-1] + f":{digest.hex()}:{'revisit' if revisit else 'response'}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", sha1_label(digest)),
        ("WARC-Block-Digest", sha1_label(hashlib.sha1(block).digest())),
    ]
    if revisit:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", page_uri(head)[:-1] + f":{digest.hex()}:response>")]
    head_lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return VERSION + head_lines.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, *, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for every row of pages (columns page_id, url, html) into archives of the folder.

    The payload is the html in UTF-8; a null is empty. Of equal payloads of at least MIN_REVISIT bytes those of the
    largest page_id are responses (every row, where that id repeats), the others revisits of it; where all ids are null,
    all are responses. Shorter payloads are all responses. Other columns are not read. ``date`` is the records' date, as
    pages have none. A table without rows leaves an empty folder.
    """
    pieces = planned(pages).mapInArrow(_pack(date, archive_bytes), "piece binary")
    # encoding: the separator's bytes are one character each. A line is a piece, and a file.
    text = pieces.select(F.col("piece").cast("string").alias("value")).write.mode("overwrite")
    text.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(folder)


# --- reading --------------------------------------------------------------------------------


class Damaged(ValueError):
    """A check that failed, with its name."""


def header(data: bytes, at: int) -> tuple[dict[str, str], int]:
    """The header fields (names in lower case) of the record at a place, and where its block begins."""
    version = VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("version line")
    end = HEADER_END.search(data, version.end() - 1, version.end() + MAX_HEADER)
    if not end:
        raise Damaged("header")
    try:
        lines = data[version.end() : end.start()].decode().split("\n")
    except UnicodeDecodeError:
        raise Damaged("header") from None
    fields: dict[str, str] = {}
    last = None
    for line in lines:
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header")
        last = name.strip().lower()
        fields[last] = value.strip()
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")):
        raise Damaged("content length")
    return fields, end.end()


def digest_holds(label: str, data: bytes) -> bool:
    """Whether a digest label fits; unknown algorithms and ways of writing are not checked."""
    kind, _, value = label.partition(":")
    if kind.lower() not in ("sha1", "sha256", "md5"):
        return True
    raw = hashlib.new(kind.lower(), data).digest()
    return value.lower() == raw.hex() or value.rstrip("=").upper() == base64.b32encode(raw).decode().rstrip("=")


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and end of the record at a place, all checks made."""
    fields, start = header(data, at)
    end = start + int(fields["content-length"])
    if end > len(data):
        raise Damaged("block length")
    close = re.compile(rb"\r?\n\r?\n").match(data, end)
    if not close:
        raise Damaged("record end")
    block = data[start:end]
    if "warc-block-digest" in fields and not digest_holds(fields["warc-block-digest"], block):
        raise Damaged("block digest")
    return fields, block, close.end()


def payload_of(fields: dict[str, str], block: bytes) -> tuple[bytes | None, int | None]:
    """A record's payload and its length. A revisit has the length alone, which its HTTP header may tell."""
    revisit = fields.get("warc-type") == "revisit"
    if not fields.get("content-type", "").replace(" ", "").startswith("application/http"):
        return (None, None) if revisit else (block, len(block))
    end = HEADER_END.search(block)
    body = block[end.end() :] if end else b""
    if revisit:
        length = re.search(rb"(?im)^content-length:\s*(\d{1,18})\s*$", block[: end.end()] if end else block)
        return None, int(length[1]) if length else None
    return body, len(body)


def inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at a place. A member that doesn't begin with a version line is given up at once."""
    unpacker, out, size = zlib.decompressobj(31), [], 0
    feed = at
    while not unpacker.eof:
        piece = unpacker.unconsumed_tail or data[feed : feed + INFLATE]
        if not unpacker.unconsumed_tail:
            feed += len(piece)
        if not piece:
            raise Damaged("member cut off")
        try:
            out.append(unpacker.decompress(piece, INFLATE))
        except zlib.error:
            raise Damaged("member checksum" if size else "member") from None
        if not size and out[-1] and not b"WARC/".startswith(out[-1][:5]):
            raise Damaged("version line")
        size += len(out[-1])
    return b"".join(out), feed - len(unpacker.unused_data)


def records_at(data: bytes, at: int) -> tuple[list[tuple[dict[str, str], bytes]], int]:
    """The records of the member, or the uncompressed record, at a place, and where it ends."""
    if not data.startswith(MAGIC, at):
        fields, block, end = parse(data, at)
        return [(fields, block)], end
    content, end = inflated(data, at)
    found, place = [], 0
    while place < len(content):
        fields, block, place = parse(content, place)
        found.append((fields, block))
    return found, end


NEXT = re.compile(rb"\x1f\x8b\x08|WARC/\d")


def walk(data: bytes) -> Iterator[tuple[int, int, str | None, list[tuple[dict[str, str], bytes]]]]:
    """(offset, length, None, records) of what is sound, (offset, length, failed check, []) of the gaps between, in order."""
    at, gap, why = 0, None, ""
    while at < len(data):
        try:
            found, end = records_at(data, at)
        except Damaged as failed:
            if gap is None:
                gap, why = at, str(failed)
            ahead = NEXT.search(data, at + 1)
            at = ahead.start() if ahead else len(data)
            continue
        if gap is not None:
            yield gap, at - gap, why, []
            gap = None
        yield at, end - at, None, found
        at = end
    if gap is not None:
        yield gap, len(data) - gap, why, []


def _salvage(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                path, content = path.as_py(), content.as_py()
                rows, size = [], 0
                for offset, length, reason, found in walk(content):
                    if reason is not None:
                        rows.append((path, "gap", offset, length, reason, *[None] * 8))
                    for fields, block in found:
                        body, n = payload_of(fields, block)
                        label = fields.get("warc-payload-digest")
                        # a payload that is here tells its own digest; what a header claims of it is checked
                        digest = hashlib.sha1(body).hexdigest() if body is not None else hex_sha1(label)
                        wrong = body is not None and label is not None and not digest_holds(label, body)
                        kind, check = ("gap", "payload digest") if wrong else ("record", None)
                        kept = body if payloads else None
                        rows.append((path, kind, offset, length, check, fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-refers-to"),
                                     fields.get("warc-target-uri"), digest, n, list(fields.items()), kept))
                        size += len(kept or b"") + 500
                    if size >= INFLATE * 8:
                        yield record(FOUND, *[list(c) for c in zip(*rows)])
                        rows, size = [], 0
                if rows:
                    yield record(FOUND, *[list(c) for c in zip(*rows)])

    return read


def hex_sha1(label: str | None) -> str | None:
    kind, _, value = (label or "").partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return base64.b32decode(value).hex() if len(value) == 32 else bytes.fromhex(value).hex()
    except ValueError:
        return None


def salvage(spark: SparkSession, folder: str, *, payloads: bool = True, pattern: str = "part-*") -> DataFrame:
    """Everything of the archives that match the pattern, in one pass: rows of the kind `record`, and of the kind `gap`.

    Every row has path, offset and length in bytes of its member, or of the uncompressed record. A gap has the check that
    failed first as its reason; one with a record_type is a record whose payload doesn't fit its digest. Archives without
    damage have no gaps. payload_bytes and payload_digest (lower-case hex SHA-1) are those of the payload read, of a
    revisit those its header states. ``payloads=False`` leaves the payload itself null. A file is read whole by one task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInArrow(_salvage(payloads), FOUND_SQL)


def records(found: DataFrame) -> DataFrame:
    return found.where("kind = 'record'").drop("kind", "reason")


def gaps(found: DataFrame) -> DataFrame:
    """The quarantine log: path, offset, length, reason."""
    return found.where("kind = 'gap'").select("path", "offset", "length", "reason")


def revisited(found: DataFrame) -> DataFrame:
    """Records with the payloads of revisits filled in from the record of the same digest; null where that one is lost."""
    all_records = records(found)
    stored = all_records.where("record_type <> 'revisit' AND payload IS NOT NULL").groupBy(F.col("record_id").alias("refers_to")).agg(F.any_value("payload").alias("stored"))
    return all_records.join(stored, "refers_to", "left").withColumn("payload", F.coalesce("payload", "stored")).drop("stored")


def digests(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records of pages."""
    return records(found).select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", page_of(F.col("refers_to"))).alias("refers_to"),
    )
