"""Workbooks made from the rows of test sheets, as the binary-file reader would give them."""

from __future__ import annotations

import datetime
import io
import struct
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.sources.staging import Staging

# Rows of a sheet that are in memory at once.
BLOCK_ROWS = 1 << 16
# Bytes of a workbook in one row of the table of files: Parquet looks at a page's size after 100 rows first.
PART_BYTES = 1 << 18

# The parts of a workbook and their namespaces.
MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PARTS = {
    "xl/workbook.xml": f'<workbook {MAIN} xmlns:r="{RELATIONS}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    f'<Relationship Id="rId1" Type="{RELATIONS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}
SHEET, STRINGS = "xl/worksheets/sheet1.xml", "xl/sharedStrings.xml"
HEADER_ROW = '<row r="1"><c r="A1" t="inlineStr"><is><t>H</t></is></c></row>'

# Fixed values of the ZIP format: version with 64-bit sizes, deflated with sizes behind the data, 1 January 2024.
ZIP_VERSION, ZIP_FLAGS, ZIP_METHOD, ZIP_TIME, ZIP_DATE = 45, 0x0808, 8, 0, (2024 - 1980) << 9 | 1 << 5 | 1
UNKNOWN = 0xFFFFFFFF

BLOCKS = "source_file string, part int, block long, size long, crc long, data binary"


def _packed(rows: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(rows)
    return out.getvalue()


def deflated(data: bytes | memoryview, last: bool = False) -> bytes:
    """A stretch of a deflated stream that others can follow."""
    packer = zlib.compressobj(zlib.Z_DEFAULT_COMPRESSION, zlib.DEFLATED, -zlib.MAX_WBITS)
    return packer.compress(data) + packer.flush(zlib.Z_FINISH if last else zlib.Z_FULL_FLUSH)


def _times(matrix: Sequence[int], vector: int) -> int:
    total = 0
    for row in matrix:
        if not vector:
            break
        if vector & 1:
            total ^= row
        vector >>= 1
    return total


def crc_of_both(first: int, second: int, size: int) -> int:
    """The CRC of two stretches, the second of which has ``size`` bytes: zero bytes are linear maps of the first one's CRC."""
    shift = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit
    for _ in range(3):
        shift = [_times(shift, row) for row in shift]
    while size:
        if size & 1:
            first = _times(shift, first)
        shift = [_times(shift, row) for row in shift]
        size >>= 1
    return first ^ second


class Archive:
    """A ZIP file whose entries come in deflated stretches; what is returned is to be written in order."""

    def __init__(self) -> None:
        self.size, self.entries = 0, []

    def _put(self, data: bytes) -> bytes:
        self.size += len(data)
        return data

    def begin(self, name: str) -> bytes:
        self.name, self.at, self.crc, self.plain, self.packed = name.encode(), self.size, 0, 0, 0
        return self._put(
            struct.pack("<4s5H3L2H", b"PK\3\4", ZIP_VERSION, ZIP_FLAGS, ZIP_METHOD, ZIP_TIME, ZIP_DATE, 0, UNKNOWN, UNKNOWN, len(self.name), 20)
            + self.name + struct.pack("<2H2Q", 1, 16, 0, 0)
        )

    def add(self, data: bytes, size: int, crc: int) -> bytes:
        self.crc = crc_of_both(self.crc, crc, size)
        self.plain, self.packed = self.plain + size, self.packed + len(data)
        return self._put(data)

    def text(self, text: str, last: bool = False) -> bytes:
        data = text.encode()
        return self.add(deflated(data, last), len(data), zlib.crc32(data))

    def end(self) -> bytes:
        self.entries.append((self.name, self.at, self.crc, self.plain, self.packed))
        return self._put(struct.pack("<4sL2Q", b"PK\7\x08", self.crc, self.packed, self.plain))

    def directory(self) -> bytes:
        out = b"".join(
            struct.pack("<4s6H3L5H2L", b"PK\1\2", ZIP_VERSION, ZIP_VERSION, ZIP_FLAGS, ZIP_METHOD, ZIP_TIME, ZIP_DATE, crc, UNKNOWN, UNKNOWN, len(name), 28, 0, 0, 0, 0, UNKNOWN)
            + name + struct.pack("<2H3Q", 1, 24, plain, packed, at)
            for name, at, crc, plain, packed in self.entries
        )
        n, at = len(self.entries), self.size
        end64 = struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, ZIP_VERSION, ZIP_VERSION, 0, 0, n, n, len(out), at)
        locator = struct.pack("<4sLQL", b"PK\6\7", 0, at + len(out), 1)
        return self._put(out + end64 + locator + struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, n, n, UNKNOWN, UNKNOWN, 0))


def _book(stretches: Iterator[tuple[int, bytes, int, int]], header: bool) -> Iterator[bytes]:
    """A workbook from the stretches of its sheet (0) and of its shared strings (1): (part, data, size, crc), in order."""
    archive = Archive()
    for name, text in PARTS.items():
        yield archive.begin(name) + archive.text(text, last=True) + archive.end()
    yield archive.begin(SHEET) + archive.text(f"<worksheet {MAIN}><sheetData>" + (HEADER_ROW if header else ""))
    between = False
    for part, data, size, crc in stretches:
        if part and not between:
            yield _between(archive)
            between = True
        yield archive.add(data, size, crc)
    if not between:
        yield _between(archive)
    yield archive.text("</sst>", last=True) + archive.end() + archive.directory()


def _between(archive: Archive) -> bytes:
    return archive.text("</sheetData></worksheet>", last=True) + archive.end() + archive.begin(STRINGS) + archive.text(f"<sst {MAIN}>")


def _escaped(texts: pa.Array) -> pa.Array:
    for plain, entity in (("&", "&amp;"), (">", "&gt;"), ("<", "&lt;")):
        texts = pc.replace_substring(texts, plain, entity)
    return texts


def _joined(texts: pa.Array | pa.ChunkedArray) -> memoryview:
    """The bytes of all texts, which are not null, one after the other."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    ends = pa.Array.from_buffers(pa.int32(), len(texts) + 1, [None, texts.buffers()[1]], offset=texts.offset)
    data = texts.buffers()[2]
    return memoryview(data)[ends[0].as_py() : ends[-1].as_py()] if data is not None else memoryview(b"")


def _rows(rows: pa.Table, cells: Sequence[str | None], first: int, start: int) -> tuple[memoryview, memoryview]:
    """XML of the rows, and of their shared strings, which are numbered from ``start``.

    Text of the first column is shared, that of the others stands in its cell.
    """
    numbers = pc.cast(pc.add(rows["row_no"], first), pa.string())
    made, shared = [], memoryview(b"")
    for i, name in enumerate(cells):
        if not name:
            continue
        letter = chr(65 + i)
        if letter == "A":
            coded = rows[name].combine_chunks().dictionary_encode()
            places = pc.cast(pc.add(pc.cast(coded.indices, pa.int64()), start), pa.string())
            cell = pc.binary_join_element_wise('<c r="A', numbers, '" t="s"><v>', places, "</v></c>", "")
            items = pc.binary_join_element_wise('<si><t xml:space="preserve">', _escaped(pc.cast(coded.dictionary, pa.string())), "</t></si>", "")
            shared = _joined(items)
        else:
            cell = pc.binary_join_element_wise(f'<c r="{letter}', numbers, '" t="inlineStr"><is><t xml:space="preserve">', _escaped(rows[name]), "</t></is></c>", "")
        made.append(pc.fill_null(cell, ""))
    outline = []
    if "level" in rows.column_names:
        level = pc.fill_null(rows["level"], 0)
        outline = [pc.if_else(pc.not_equal(level, 0), pc.binary_join_element_wise(' outlineLevel="', pc.cast(level, pa.string()), '"', ""), "")]
    return _joined(pc.binary_join_element_wise('<row r="', numbers, '"', *outline, ">", *made, "</row>", "")), shared


def pieces(sheet: DataFrame, cells: Sequence[str | None]) -> DataFrame:
    """The sheet's blocks, each compressed: source_file, block, n rows, piece in order of its rows, and how many strings it shares."""

    def pack(rows: pa.Table) -> pa.Table:
        own = rows.drop_columns(["source_file", "block"]).sort_by("row_no")
        shared = pc.count_distinct(own[cells[0]]).as_py() if cells[0] else 0
        return pa.table({"source_file": rows["source_file"][:1], "block": rows["block"][:1], "n": [len(rows)], "piece": [_packed(own)], "shared": [shared]})

    used = sheet.select("source_file", F.col("row_no").cast("long").alias("row_no"), *[c for c in ("level",) if c in sheet.columns], *[c for c in cells if c])
    blocked = used.withColumn("block", F.floor(F.col("row_no") / BLOCK_ROWS))
    return blocked.groupBy("source_file", "block").applyInArrow(pack, "source_file string, block long, n long, piece binary, shared long")


def blocks(packed: DataFrame, cells: Sequence[str | None], first: int) -> DataFrame:
    """Deflated XML of every block's rows (part 0) and of its shared strings (part 1), which come after those of the blocks before."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, block, start, piece in zip(*(batch.column(c) for c in ("source_file", "block", "start", "piece"))):
                own = pa.ipc.open_stream(piece.as_buffer()).read_all()
                xml = _rows(own, cells, first, start.as_py())
                yield pa.RecordBatch.from_pylist(
                    [{"source_file": name.as_py(), "part": part, "block": block.as_py(), "size": len(x), "crc": zlib.crc32(x), "data": deflated(x)} for part, x in enumerate(xml)],
                    pa.schema([("source_file", pa.string()), ("part", pa.int32()), ("block", pa.int64()), ("size", pa.int64()), ("crc", pa.int64()), ("data", pa.binary())]),
                )

    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = packed.select("source_file", "block", F.coalesce(F.sum("shared").over(before), F.lit(0)).alias("start"))
    return packed.join(starts, ["source_file", "block"]).mapInArrow(write, BLOCKS)


def workbooks(sheet: DataFrame, cells: Sequence[str | None], folder: str, *, header: bool, version: int = 0) -> DataFrame:
    """A workbook for every source_file of a sheet (row_no, and level for outlines): its cells are the named columns, None is an empty one.

    Blocks of rows are written and deflated by themselves and then put together, so no task holds more than a block, and
    the file is in ``part``s: content is PART_BYTES of it, less in the last one. ``version`` shifts the files' times.
    """
    stage = Staging(sheet.sparkSession)
    written = stage(blocks(stage(pieces(sheet, cells)), cells, 2 if header else 1))
    frame, part_bytes = sum(map(len, _book(iter(()), header))), PART_BYTES

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c) for c in ("source_file", "part", "size", "crc", "length", "data"))))
        row = next(rows, None)
        while row is not None:
            name, length = row[0].as_py(), row[4].as_py()

            def own() -> Iterator[tuple[int, bytes, int, int]]:
                nonlocal row
                while row is not None and row[0].as_py() == name:
                    yield row[1].as_py(), row[5].as_py(), row[2].as_py(), row[3].as_py()
                    row = next(rows, None)

            part, content = 0, bytearray()
            for stretch in _book(own(), header):
                content += stretch
                while len(content) > part_bytes:
                    yield _part(f"{folder}/{name}", length, part, bytes(content[:part_bytes]))
                    del content[:part_bytes]
                    part += 1
            if content:
                yield _part(f"{folder}/{name}", length, part, bytes(content))

    lengths = written.groupBy("source_file").agg((F.sum(F.octet_length("data")) + frame).alias("length"))
    # by another expression than the join's, or adaptive execution would read the join's own shuffle map by map
    parts = int(sheet.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = written.join(lengths, "source_file").repartition(parts, F.xxhash64("source_file")).sortWithinPartitions("source_file", "part", "block")
    made = ordered.mapInArrow(make, "path string, length long, part int, content binary")
    time = datetime.date(2024, 1, 1) + datetime.timedelta(days=version)
    return made.select("path", F.lit(time).cast("timestamp").alias("modificationTime"), "length", "part", "content")


def _part(path: str, length: int, part: int, content: bytes) -> pa.RecordBatch:
    columns = [pa.array([path]), pa.array([length], pa.int64()), pa.array([part], pa.int32()), pa.array([content], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["path", "length", "part", "content"])
