"""Landing of report workbooks: many files in parallel, one row per sheet row.

Workbooks are read as binary files and decoded inside the tasks: one task inflates a workbook and cuts its sheet's XML
into documents of some rows each, which are parsed by all tasks. A table of files may have a workbook in several rows,
each a ``part`` of its content, numbered from 0; then no task has all of it in memory. Everything after that works on
the landed table; its cells are text, as the reports print them.
"""

from __future__ import annotations

import gc
import hashlib
import io
import re
import tempfile
import zipfile
from array import array
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime, timedelta
from typing import IO
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.parsing import file_company, file_group

# source_file is a workbook's identity: its name and the digest of its content.
LANDED = (
    "source_file string, grp string, company string, kind string, row_no int, level int, "
    "cells array<string>, fields map<string,string>"
)
LANDED_COLUMNS = [field.split()[0] for field in LANDED.split(", ")]

# Kinds of workbooks by the text in their names; deductions are known by their first word.
KINDS = {
    L.BANK_STATEMENTS: L.BANK_STATEMENTS,
    L.CASH_FLOW_DICTIONARY: L.CASH_FLOW_DICTIONARY,
    L.TRIAL_BALANCE: L.TRIAL_BALANCE,
    L.DEBT_BALANCE: L.DEBT_BALANCE,
    "НДС": L.DEDUCTIONS,
    **{indicator: indicator for indicator in L.COMPONENTS},
}
# Kinds whose first row is a header; rows are then counted from the one below.
WITH_HEADER = (L.BANK_STATEMENTS, L.CASH_FLOW_DICTIONARY, L.TRIAL_BALANCE, L.DEBT_BALANCE)

# Bytes of a sheet's XML that are parsed at once, that are read at once, and of a workbook in memory while it is read.
DOCUMENT_BYTES = 1 << 18
READ_BYTES = 1 << 16
SPOOL_BYTES = 1 << 25
# Of the content's digest, in a workbook's identity.
DIGEST_CHARS = 32

DOCUMENTS = (
    "source_file string, kind string, document long, next_row long, header array<string>, places array<int>, texts array<string>, "
    "dated array<int>, head binary, size long, body binary"
)
DECODED = "source_file string, kind string, row_no int, level int, cells array<string>, fields map<string,string>"


def file_name(path: Column | str) -> Column:
    """The last part of a path as the binary-file reader gives it, which is not encoded."""
    return F.substring_index(path, "/", -1)


def workbook_kind(name: Column | str) -> Column:
    kind = F.lit(None).cast("string")
    for token, value in reversed(KINDS.items()):
        kind = F.when(F.contains(F.col(name) if isinstance(name, str) else name, F.lit(token)), F.lit(value)).otherwise(kind)
    return kind


def find_workbooks(spark: SparkSession, folder: str, report: str = "") -> DataFrame:
    """The workbooks of a folder whose names contain ``report``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{report}*.xlsx")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )


def identity(name: Column | str = "name", content: Column | str = "content") -> Column:
    """What tells workbooks apart: the name, which has the group, company and kind, and 128 bits of the content's digest.

    Two workbooks of one name in two folders are two; the same workbook in two folders is one.
    """
    return F.concat(F.col(name) if isinstance(name, str) else name, F.lit("@"), F.left(F.sha2(content, 256), F.lit(DIGEST_CHARS)))


def in_order(files: DataFrame) -> DataFrame:
    """Rows of a table of files so that the parts of a workbook follow each other in one task."""
    if "part" not in files.columns:
        return files.withColumn("part", F.lit(0))
    # not by the path itself: behind a join by it, Spark would leave the shuffle out and may read the join's map by map;
    # with a number, adaptive execution doesn't put long workbooks into one task, as they compress to few bytes a row
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(parts, F.xxhash64("path")).sortWithinPartitions("path", "part")


def identified(files: DataFrame) -> DataFrame:
    """path, modificationTime, length and the identity as source_file of every workbook of a table of files."""
    if "part" not in files.columns:
        return files.select("path", "modificationTime", "length", identity(file_name("path")).alias("source_file"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, last = hashlib.sha256(), None
        for batch in batches:
            for row, content in zip(batch.drop_columns(["content"]).to_pylist(), batch.column("content")):
                if row["part"] == 0:
                    if last is not None:
                        yield _one(last, sha)
                    sha, last = hashlib.sha256(), row
                sha.update(content.as_buffer())
        if last is not None:
            yield _one(last, sha)

    def _one(row: dict, sha) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"path": row["path"], "digest": sha.hexdigest()[:DIGEST_CHARS]}])

    known = in_order(files).select("path", "part", "content").mapInArrow(digest, "path string, digest string")
    own = files.where("part = 0").select("path", "modificationTime", "length").join(known, "path")
    return own.select("path", "modificationTime", "length", F.concat(file_name("path"), F.lit("@"), "digest").alias("source_file"))


def land_workbooks(spark: SparkSession, folder: str, report: str = "", kinds: Sequence[str] | None = None) -> DataFrame:
    """Rows of the folder's workbooks, each content once."""
    files = find_workbooks(spark, folder, report)
    return decode_workbooks(files.join(repeated(files), "path", "left_anti"), kinds)


def repeated(files: DataFrame) -> DataFrame:
    """Paths of workbooks that are there under a smaller path as well, name and content alike.

    Only files that share name and length are opened.
    """
    named = files.select("path", "length", file_name("path").alias("name"))
    alike = named.groupBy("name", "length").agg(F.count("*").alias("n")).where("n > 1").select("name", "length")
    again = files.join(named.join(alike, ["name", "length"]).select("path", "name"), "path").select("path", identity().alias("source_file"))
    first = again.groupBy("source_file").agg(F.min("path").alias("first"))
    return again.join(first, "source_file").where(F.col("path") != F.col("first")).select("path")


def decode_workbooks(files: DataFrame, kinds: Sequence[str] | None = None) -> DataFrame:
    """Rows of the first sheet of each binary file of a known kind, in the ``LANDED`` schema.

    ``kinds`` leaves all other workbooks unopened. A workbook without a ``(group)`` in its name fails
    the job: its rows would belong to no report.
    """
    named = files.withColumn("name", file_name("path")).withColumn("kind", workbook_kind("name"))
    wanted = F.col("kind").isNotNull() if kinds is None else F.col("kind").isin(*kinds)
    documents = in_order(named.where(wanted)).select("name", "kind", "part", "content").mapInArrow(_documents, DOCUMENTS)
    rows = documents.repartition("source_file", "document").mapInArrow(_decode, DECODED)
    name = F.left("source_file", F.length("source_file") - DIGEST_CHARS - 1)
    return rows.select(
        "source_file",
        file_group(name, strict=True).alias("grp"),
        file_company(name).alias("company"),
        "kind",
        "row_no",
        "level",
        "cells",
        "fields",
    )


# --- landed rows -> the tables the reports read -------------------------------------------------


def _of(landed: DataFrame, *kinds: str) -> DataFrame:
    return landed.where(F.col("kind").isin(*kinds))


def _cell(i: int, name: str) -> Column:
    return F.get("cells", F.lit(i)).alias(name)


FILE = ("grp", "company", "source_file")


def outline_sheet(landed: DataFrame, *kinds: str) -> DataFrame:
    """Outline reports; the kind is the indicator."""
    return _of(landed, *kinds).select(
        *FILE, F.col("kind").alias("indicator"), "row_no", "level", _cell(0, "c0"), _cell(1, "c1")
    )


def trial_sheet(landed: DataFrame) -> DataFrame:
    return _of(landed, L.TRIAL_BALANCE).select(
        *FILE, "row_no", _cell(0, "stacked"), _cell(1, "dim"), _cell(4, "receipt"), _cell(5, "payment")
    )


def debt_sheet(landed: DataFrame) -> DataFrame:
    """In this report the payments come before the receipts."""
    return _of(landed, L.DEBT_BALANCE).select(
        *FILE, "row_no", _cell(0, "stacked"), _cell(1, "creditor"), _cell(4, "payment"), _cell(5, "receipt")
    )


# Headers of the bank statement and of the cash-flow dictionary.
BANK_FIELDS = {
    "date": "Дата",
    "receipt": "Поступление",
    "payment": "Списание",
    "purpose": "Назначение платежа",
    "counterparty": "Контрагент",
    "inn": "ИНН",
    "op_type": "Вид операции",
    "org": "Организация",
    "bank_account": "Банковский счет",
}
DICTIONARY_FIELDS = {
    "op_type": "Вид операции",
    "cf_item": "Статья движения денежных средств",
    "movement_kind": "Вид движения",
    "item_group": "Группа статей",
    "direction": "Операция",
}


def _named(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    return rows.select(*FILE, "row_no", *[F.try_element_at("fields", F.lit(h)).alias(c) for c, h in fields.items()])


def bank_statements(landed: DataFrame) -> DataFrame:
    return _named(_of(landed, L.BANK_STATEMENTS), BANK_FIELDS)


def dictionary(landed: DataFrame) -> DataFrame:
    return _named(_of(landed, L.CASH_FLOW_DICTIONARY), DICTIONARY_FIELDS)


# --- decoding of one workbook -------------------------------------------------------------------


def _books(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, IO[bytes]]]:
    """Identity, kind and file of every workbook, whose parts follow each other; a large one lies on disk."""
    name = kind = ""
    digest, file = hashlib.sha256(), None
    for batch in batches:
        for i in range(batch.num_rows):
            if batch.column("part")[i].as_py() == 0:
                if file is not None:
                    with file:
                        yield f"{name}@{digest.hexdigest()[:DIGEST_CHARS]}", kind, file
                name, kind = batch.column("name")[i].as_py(), batch.column("kind")[i].as_py()
                digest, file = hashlib.sha256(), tempfile.SpooledTemporaryFile(SPOOL_BYTES)
            content = batch.column("content")[i].as_buffer()
            digest.update(content)
            file.write(content)
    if file is not None:
        with file:
            yield f"{name}@{digest.hexdigest()[:DIGEST_CHARS]}", kind, file


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sheets cut into documents, each with the shared strings it may refer to, in the ``DOCUMENTS`` schema."""
    texts = pa.list_(pa.string())
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), texts, pa.list_(pa.int32()), texts, pa.list_(pa.int32()), pa.binary(), pa.int64(), pa.binary()]
    schema = pa.schema([(field.split()[0], kind) for field, kind in zip(DOCUMENTS.split(", "), types, strict=True)])
    for source_file, kind, file in _books(batches):
        with zipfile.ZipFile(file) as book:
            strings, dated = _book_parts(book)
            header: list[str | None] | None = None
            next_row = 0
            with book.open(_first_sheet(book)) as sheet:
                for n, (head, body) in enumerate(_cut(sheet, "sheetData", "row")):
                    if n == 0 and kind in WITH_HEADER:
                        header = next(_rows(head, body, next_row, strings, dated))[2]
                    places = _referred(body, len(strings))
                    row = [source_file, kind, n, next_row, header, places, [strings[i] for i in places], sorted(dated), head, len(body), pa.compress(body, "zstd", asbytes=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([value], t) for value, t in zip(row, types, strict=True)], schema=schema)
                    next_row = _row_after(body, next_row)


class _Referred(dict):
    """Shared strings of a document by their places."""

    def __missing__(self, place: int) -> str:
        raise IndexError(f"no shared string {place}")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the documents, in the ``DECODED`` schema."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            body = pa.decompress(row["body"], row["size"], "zstd", asbytes=True)
            strings = _Referred(zip(row["places"], row["texts"], strict=True))
            gc.disable()  # it would look through the rows again and again, which have no cycles
            try:
                rows = list(_rows(row["head"], body, row["next_row"], strings, set(row["dated"])))
            finally:
                gc.enable()
            header = row["header"]
            if header is not None and row["document"] == 0:
                rows = rows[1:]
            if rows:
                yield _landed(row["source_file"], row["kind"], rows, header)


def _landed(source_file: str, kind: str, rows: list[tuple[int, int, list[str | None]]], header: list[str | None] | None) -> pa.RecordBatch:
    """Rows of one workbook; with a header, they are counted from the one below it and have fields."""
    lengths = np.array([len(cells) for _, _, cells in rows])
    ends = np.concatenate(([0], np.cumsum(lengths)))
    flat = pa.array([cell for _, _, cells in rows for cell in cells], pa.string())
    cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    fields: pa.Array = pa.nulls(len(rows), pa.map_(pa.string(), pa.string()))
    first = 0
    if header is not None:
        first = 1
        # of headers that occur twice the last one counts
        last = {h: i for i, h in enumerate(header) if h is not None}
        unique = len(last) == sum(h is not None for h in header)
        if unique:
            place = np.arange(ends[-1]) - np.repeat(ends[:-1], lengths)
            named = np.zeros(max(lengths.max(), len(header)), bool)
            named[: len(header)] = [h is not None for h in header]
            kept = named[place]
            starts = np.concatenate(([0], np.cumsum(kept)))[ends]
            keys = pa.array(header, pa.string()).take(pa.array(place[kept]))
            fields = pa.MapArray.from_arrays(pa.array(starts, pa.int32()), keys, flat.filter(pa.array(kept)))
        else:
            own = [list({h: c for h, c in zip(header, cells, strict=False) if h is not None}.items()) for _, _, cells in rows]
            fields = pa.array(own, pa.map_(pa.string(), pa.string()))
    columns = [
        pa.repeat(source_file, len(rows)),
        pa.repeat(kind, len(rows)),
        pa.array([row_no - first for row_no, _, _ in rows], pa.int32()),
        pa.array([level for _, level, _ in rows], pa.int32()),
        cells,
        fields,
    ]
    return pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in DECODED.split(", ")])


# Tags around the documents of a part, by the element that has the part's items.
AROUND = {"sheetData": (b"<worksheet><sheetData>", b"</sheetData></worksheet>"), "sst": (b"<sst>", b"</sst>")}


class _Joined:
    """A stream with what was read of it already."""

    def __init__(self, read: bytes, stream: IO[bytes]):
        self.first, self.stream = read, stream

    def read(self, size: int = -1) -> bytes:
        first, self.first = self.first, b""
        return first or self.stream.read(size)


def _plain(xml: bytes) -> bool:
    """Nothing but elements and text: no comment, no section, no instruction."""
    return b"<!" not in xml and b"<?" not in xml


def _plain_head(head: bytes, outer: str) -> bool:
    """UTF-8, and names without a prefix."""
    declared = re.match(rb"(?:\xef\xbb\xbf)?\s*<\?xml([^>]*)\?>", head)
    encoding = re.search(rb"""encoding\s*=\s*["']([^"']*)""", declared[1]) if declared else None
    root = "worksheet" if outer == "sheetData" else outer
    return (
        (encoding is None or encoding[1].lower() in (b"utf-8", b"us-ascii"))
        and _plain(head[declared.end() :] if declared else head)
        and re.search(rf"<{root}[\s>]".encode(), head) is not None
    )


def _cut(stream: IO[bytes], outer: str, inner: str) -> Iterator[tuple[bytes, bytes]]:
    """A part's XML in documents that have some of its ``inner`` elements each: what is before them, and they.

    Text has no "<", so where a part is plain the end of an element is found without a parser. From where it isn't, its
    elements are parsed one by one, and written anew.
    """
    opening = re.compile(rf"<{outer}(?:\s[^<>]*)?(?<!/)>".encode())
    close, end, begin = f"</{outer}>".encode(), f"</{inner}>".encode(), f"<{inner}".encode()
    head, rest = b"", b""
    while more := stream.read(READ_BYTES):
        rest += more
        if not head:
            opened = opening.search(rest)
            if opened is None or not _plain_head(rest[: opened.end()], outer):
                break
            head, rest = rest[: opened.end()], rest[opened.end() :]
        at = rest.find(close)
        if at < 0 and len(rest) < DOCUMENT_BYTES:
            continue
        cut = at if at >= 0 else rest.rfind(end) + len(end)
        if at < 0 and cut < len(end):
            continue
        body = rest[:cut]
        if not _plain(body):
            break
        if begin in body:
            yield head, body
        if at >= 0:
            return
        rest = rest[cut:]
    body = bytearray()
    for node, above in _elements(_Joined(head + rest, stream), inner):
        for part in node.iter():
            part.tag = _tag(part)
        body += ElementTree.tostring(node, "unicode").encode()
        above.clear()
        if len(body) >= DOCUMENT_BYTES:
            yield AROUND[outer][0], bytes(body)
            body.clear()
    if body:
        yield AROUND[outer][0], bytes(body)


def _elements(stream: IO[bytes], tag: str) -> Iterator[tuple[ElementTree.Element, ElementTree.Element]]:
    """Every element of a tag, and the one it lies in, as soon as it is read.

    The caller clears the outer one when done: an element that is only emptied would stay in it, and a sheet has a million.
    """
    above: list[ElementTree.Element] = []
    for event, node in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start":
            above.append(node)
            continue
        above.pop()
        if _tag(node) == tag:
            yield node, above[-1]


def _referred(body: bytes, n: int) -> list[int]:
    """Numbers below n that are values of cells: the places of all shared strings that the rows refer to, and maybe others."""
    found = set()
    for value in {part[part.rfind(b">") + 1 :] for part in body.split(b"</v>")} if n else ():
        try:
            place = int(value)
        except ValueError:
            continue
        if 0 <= place < n:
            found.add(place)
    return sorted(found)


_ROW = re.compile(rb"""<row(?=[\s/>])((?:\s+[\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'))*)""")
_NUMBER = re.compile(rb"""\sr\s*=\s*["'](\d+)""")


def _row_after(body: bytes, next_row: int) -> int:
    """The number, from 0, of a row without one that follows these rows."""
    at, unnumbered = len(body), 0
    while (at := body.rfind(b"<row", 0, at)) >= 0:
        if tag := _ROW.match(body, at):
            if number := _NUMBER.search(tag[1]):
                return int(number[1]) + unnumbered
            unnumbered += 1
    return next_row + unnumbered


# Rows and cells as spreadsheet programs write them; whatever is written otherwise is left to the parser.
_CELLS = re.compile(
    r"""<row r="(\d+)"((?: [\w:.]+="[^"<>]*")*)/?>"""
    r"""|<c r="([A-Z]+)\d+"(?: s="(\d+)")?(?: t="(\w+)")?(?:/>|>(?:<v>([^<]*)</v>|<is><t(?: xml:space="preserve")?>([^<]*)</t></is>)?</c>)"""
)
_LEVEL = re.compile(r' outlineLevel="(\d+)"')


def _rows(head: bytes, body: bytes, next_row: int, strings: Strings | Mapping[int, str], dated: set[int]) -> Iterator[tuple[int, int, list[str | None]]]:
    """(row number from 0, outline level, cell texts) of the rows of a document."""
    text = body.decode()
    found = _CELLS.findall(text) if "&" not in text and "\r" not in text else []
    numbered = sum(1 for match in found if match[0])
    if not numbered or numbered != text.count("<row") or len(found) - numbered != text.count("<c"):
        yield from _parsed_rows(head + body + AROUND["sheetData"][1], next_row, strings, dated)
        return
    columns: dict[str, int] = {}
    row_no, level, cells = -1, 0, []
    for number, attributes, column, style, kind, value, inline in found:
        if number:
            if row_no >= 0:
                yield row_no, level, cells
            depth = _LEVEL.search(attributes) if attributes else None
            row_no, level, cells = int(number) - 1, int(depth[1]) if depth else 0, []
            continue
        place = columns.get(column)
        if place is None:
            place = columns[column] = _column(column, 0)
        while len(cells) < place:
            cells.append(None)
        if kind == "inlineStr":
            cells.append(inline)
        elif not value or kind == "e":
            cells.append(None)
        elif kind == "s":
            cells.append(strings[int(value)])
        elif kind in ("", "n") and int(style or 0) in dated:
            cells.append(_moment(value))
        else:
            cells.append(value)
    yield row_no, level, cells


def _parsed_rows(xml: bytes, next_row: int, strings: Strings | Mapping[int, str], dated: set[int]) -> Iterator[tuple[int, int, list[str | None]]]:
    for node in ElementTree.XML(xml)[-1]:
        if _tag(node) != "row":
            continue
        row_no = int(node.get("r", next_row + 1)) - 1
        next_row = row_no + 1
        cells: list[str | None] = []
        for cell in node:
            place = _column(cell.get("r"), len(cells))
            cells.extend([None] * (place - len(cells)))
            cells.append(_text(cell, strings, dated))
        yield row_no, int(node.get("outlineLevel", 0)), cells


class Strings:
    """Strings in one buffer, found by their offsets: 8 bytes a string beside its text."""

    def __init__(self) -> None:
        self.text, self.ends = bytearray(), array("Q", [0])

    def append(self, text: str) -> None:
        self.text += text.encode("utf-8", "surrogatepass")
        self.ends.append(len(self.text))

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, i: int) -> str:
        if not 0 <= i < len(self):
            raise IndexError(f"no shared string {i}")
        return self.text[self.ends[i] : self.ends[i + 1]].decode("utf-8", "surrogatepass")


def _sheet_rows(content: bytes) -> Iterator[tuple[int, int, list[str | None]]]:
    """(row number from 0, outline level, cell texts) of the first sheet, read as a stream."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, dated = _book_parts(book)
        with book.open(_first_sheet(book)) as sheet:
            next_row = 0
            for head, body in _cut(sheet, "sheetData", "row"):
                yield from _rows(head, body, next_row, strings, dated)
                next_row = _row_after(body, next_row)


def _book_parts(book: zipfile.ZipFile) -> tuple[Strings, set[int]]:
    parts = set(book.namelist())
    strings = _shared_strings(book) if "xl/sharedStrings.xml" in parts else Strings()
    return strings, _date_styles(book) if "xl/styles.xml" in parts else set()


def _tag(node: ElementTree.Element) -> str:
    return node.tag.rpartition("}")[2]


def _first_sheet(book: zipfile.ZipFile) -> str:
    first = next(n for n in ElementTree.fromstring(book.read("xl/workbook.xml")).iter() if _tag(n) == "sheet")
    link = next(v for k, v in first.items() if k.endswith("}id"))
    for relation in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if relation.get("Id") == link:
            target = relation.get("Target", "")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("workbook without a first sheet")


_ITEM = re.compile(r'<si><t(?: xml:space="preserve")?>([^<]*)</t></si>')


def _shared_strings(book: zipfile.ZipFile) -> Strings:
    strings = Strings()
    with book.open("xl/sharedStrings.xml") as stream:
        for head, body in _cut(stream, "sst", "si"):
            text = body.decode()
            items = _ITEM.findall(text) if "&" not in text and "\r" not in text else []
            if not items or len(items) != text.count("<si"):
                found = (item for item in ElementTree.XML(head + body + AROUND["sst"][1]) if _tag(item) == "si")
                items = ["".join(t.text or "" for t in item.iter() if _tag(t) == "t") for item in found]
            for item in items:
                strings.append(item)
    return strings


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Positions of the cell styles that show a number as a date."""
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    formats = {n.get("numFmtId"): n.get("formatCode", "") for n in root.iter() if _tag(n) == "numFmt"}
    dated = set()
    for group in root:
        if _tag(group) == "cellXfs":
            for place, style in enumerate(group):
                code = style.get("numFmtId", "0")
                shown = re.sub(r'"[^"]*"|\[[^\]]*\]', "", formats.get(code, ""))
                # Built-in date formats.
                if 14 <= int(code) <= 22 or re.search("[dyDY]", shown):
                    dated.add(place)
    return dated


def _column(reference: str | None, default: int) -> int:
    if reference is None:
        return default
    number = 0
    for letter in reference.rstrip("0123456789"):
        number = number * 26 + ord(letter) - 64
    return number - 1


def _moment(value: str) -> str:
    """The text of a date cell."""
    moment = datetime(1899, 12, 30) + timedelta(seconds=round(float(value) * 86400))
    return moment.strftime("%d.%m.%Y %H:%M:%S")


def _text(cell: ElementTree.Element, strings: Strings | Mapping[int, str], dated: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter() if _tag(t) == "t")
    value = next((n.text for n in cell if _tag(n) == "v"), None)
    if value is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "n" and int(cell.get("s", 0)) in dated:
        return _moment(value)
    return value
