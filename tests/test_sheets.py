"""The bindings' sheets at any size: numbered in slices, made into workbooks block by block."""

import io
import zipfile
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import bindings as B
from checks import books
from helpers import rows, workbook
from ledgerspark import operators as O
from ledgerspark.functions import labels as L
from ledgerspark.sources import Staging
from ledgerspark.sources import workbooks as W
from ledgerspark.streaming import KeptBalances, land, landed_rows


def test_sheet_rows_are_numbered_in_slices(spark, monkeypatch):
    monkeypatch.setattr(B, "SLICE", 4)
    df = spark.createDataFrame([(f"f{k % 2}", k * 3) for k in range(40)], "source_file string, k long")
    got = B.counted(df, F.col("k"), [F.col("k") % 2 == 0, F.lit(False), F.col("k") % 5 > 0], 6)
    want = []
    for source in ("f0", "f1"):
        held = [(k, i) for k in range(0, 120, 3) if f"f{k // 3 % 2}" == source for i in (0, 2) if (k % 2 == 0 if i == 0 else k % 5 > 0)]
        want += [(source, k, i, 6 + n) for n, (k, i) in enumerate(held)]
    assert rows(got, "source_file", "k", "i", "row_no") == rows(spark.createDataFrame(want, "source_file string, k long, i int, row_no int"))
    assert got.schema["row_no"].dataType.simpleString() == "int"


def test_no_window_over_whole_sheets(spark):
    """Every window over rows of a sheet is cut into slices or blocks."""
    for sheet in (B.trial_sheet, B.debt_sheet, B.cost_sheet, B.costs_sheet, B.revenue_sheet, B.deduction_sheet):
        plan = sheet(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "row_number()" not in plan and "_slice" in plan


def test_outline_rows_of_other_levels_are_not_shuffled(spark, monkeypatch):
    sheet = [(0, "a", None), (1, "x", None), (2, "y", None), (3, "2024", "5"), (1, None, None), (3, None, "6"), (3, "2025", "7")]
    df = spark.createDataFrame([("f", i, *r) for i, r in enumerate(sheet)], "source_file string, row_no int, level int, c0 string, c1 string")
    fill, seen = O.shape.forward_fill, []
    monkeypatch.setattr(O.shape, "forward_fill", lambda rows, *args, **named: seen.append(rows.count()) or fill(rows, *args, **named))
    flat = O.outline_flatten(df, {0: "org", 3: "date"}, "date")
    assert rows(flat.select("row_no", "org", "date", "change")) == [(3, "a", "2024", "5"), (6, "a", "2025", "7")]
    assert seen == [3]


def test_workbooks_are_made_block_by_block(spark, monkeypatch):
    """No task of the first step gets more than a block, and the workbook is that of all rows."""
    monkeypatch.setattr(books, "BLOCK_ROWS", 4)
    made = [(f"(Г)ОСВ 50-51_{c}.xlsx", i, f"s{i % 3}" if i % 2 else None, None if i % 5 else f"<{i}>") for c in "АБ" for i in range(4, 31)]
    sheet = spark.createDataFrame(made, "source_file string, row_no int, stacked string, dim string")
    pieces = books.pieces(sheet, ["stacked", "dim"])
    assert {r["n"] for r in pieces.collect()} <= {1, 2, 3, 4} and pieces.count() == 14
    files = books.workbooks(sheet, ["stacked", "dim"], "file:/landing", header=True)
    got = W.trial_sheet(W.decode_workbooks(files)).where("stacked is not null or dim is not null")
    want = sheet.where("stacked is not null or dim is not null").withColumn("company", F.regexp_extract("source_file", "_(.)", 1))
    assert rows(got, "company", "row_no", "stacked", "dim") == rows(want, "company", "row_no", "stacked", "dim")
    assert {(r["path"], r["n"]) for r in files.select("path", F.expr("length - octet_length(content)").alias("n")).collect()} == {
        (f"file:/landing/(Г)ОСВ 50-51_{c}.xlsx", 0) for c in "АБ"
    }


def test_each_fill_derives_what_is_handed_on_once(spark):
    """With a stage, the rows are read a few times per step, not twice as often with every step."""
    df = spark.createDataFrame([("f", i, *("x" if i % (k + 2) == 0 else None for k in range(4))) for i in range(30)], "source_file string, row_no int, a string, b string, c string, d string")
    steps = [(["a"], []), (["b"], ["a"]), (["c"], ["a", "b"]), (["d"], ["a", "b", "c"])]
    want = rows(O.forward_fill_steps(df, steps, block_rows=4))
    plans = []

    def stage(part):
        plans.append(part._jdf.queryExecution().optimizedPlan().toString().count("Window"))
        return spark.createDataFrame(part.collect(), part.schema)

    got = O.forward_fill_steps(df, steps, block_rows=4, stage=stage)
    assert rows(got) == want
    # the n-th hand-over needs the n-1 fills before it, one look at the blocks before, nothing else
    windows = [n for n in plans if n]
    assert len(windows) == len(steps) and max(windows) <= 3 * len(steps)
    assert rows(O.fill_from_headers(df, steps, block_rows=4, stage=stage)) == rows(O.fill_from_headers(df, steps, block_rows=4))


def test_no_row_has_a_whole_workbook(spark, monkeypatch):
    """Blocks are written by themselves, and a long workbook is made and read in parts of its content."""
    monkeypatch.setattr(books, "BLOCK_ROWS", 8)
    monkeypatch.setattr(books, "PART_BYTES", 512)
    made = [(f"(Г){L.COST_OF_SALES}_{c}.xlsx", i, i % 3, f"s{i % 20}&" if i % 7 else None, None if i % 5 else f"<{i}>") for c in "АБ" for i in range(6, 106)]
    sheet = spark.createDataFrame(made, "source_file string, row_no int, level int, c0 string, c1 string")
    files = books.workbooks(sheet, ["c0", "c1"], "file:/landing", header=False).cache()
    parts = files.orderBy("path", "part").collect()
    assert len(parts) > 4 and max(len(r["content"]) for r in parts) < 2000
    whole = {p: b"".join(bytes(r["content"]) for r in parts if r["path"] == p) for p in {r["path"] for r in parts}}
    for path, content in whole.items():
        assert {r["length"] for r in parts if r["path"] == path} == {len(content)}
        assert [r["part"] for r in parts if r["path"] == path] == list(range(sum(r["path"] == path for r in parts)))
        assert zipfile.ZipFile(io.BytesIO(content)).testzip() is None
    # behind a join by the path as well, whose shuffle has the parts together but in any order
    joined = files.join(spark.createDataFrame([(p,) for p in whole], "path string"), "path")
    want = rows(sheet.withColumn("company", F.regexp_extract("source_file", "_(.)", 1)), "company", "row_no", "level", "c0", "c1")
    assert rows(W.outline_sheet(W.decode_workbooks(joined), L.COST_OF_SALES), "company", "row_no", "level", "c0", "c1") == want
    one = spark.createDataFrame([(p, bytearray(c)) for p, c in whole.items()], "path string, content binary")
    identities = rows(one.select(W.identity(W.file_name("path")).alias("source_file")))
    assert rows(W.identified(files).select("source_file")) == identities
    assert rows(W.decode_workbooks(files).select("source_file").distinct()) == identities


MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def sheet_of(body, head="<worksheet {}>", tail="</worksheet>"):
    """A workbook of 300 rows whose sheet has other XML."""
    plain = zipfile.ZipFile(io.BytesIO(workbook([["Имя", None, "Имя"], *[["a", f"т{i}", i] for i in range(300)]])))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name in plain.namelist():
            if name != "xl/worksheets/sheet1.xml":
                book.writestr(name, plain.read(name))
                continue
            old = plain.read(name).decode()
            rows_of = old[old.index("<sheetData>") + len("<sheetData>") : old.index("</sheetData>")]
            book.writestr(name, body(rows_of, head.format(MAIN), tail))
    return out.getvalue()


@pytest.mark.parametrize(
    "body",
    [
        lambda r, a, z: f"{a}<cols><col min='1'/></cols><sheetData>{r}</sheetData><rowBreaks/>{z}",
        lambda r, a, z: f"<?xml version='1.0' encoding='UTF-8'?>\n{a}<sheetData x='1'>{r.replace('a', '&lt;')}</sheetData>{z}",
        lambda r, a, z: f"{a}<sheetData>{r[:9000]}{r[9000:].replace('<row', '<!-- </row> --><row')}</sheetData>{z}",
        lambda r, a, z: f"<x:worksheet {MAIN.replace('xmlns', 'xmlns:x')}><x:sheetData>{r.replace('</', '</x:').replace('<', '<x:').replace('<x:/x:', '</x:')}</x:sheetData></x:worksheet>",
        lambda r, a, z: f"{a}<sheetData>{''.join(part if i % 3 else '<row' + part[part.find('>'):] if part else '' for i, part in enumerate(r.replace('<row', chr(0) + '<row').split(chr(0))))}</sheetData>{z}",
        lambda r, a, z: f"{a}<sheetData>{r}<row r='400'/><row/><row><c><v>7</v></c></row></sheetData>{z}",
        lambda r, a, z: f"<?xml version='1.0' encoding='UTF-16'?>{a}<sheetData>{r}</sheetData>{z}".encode("utf-16"),
    ],
)
def test_documents_of_a_sheet_give_its_rows(monkeypatch, body):
    """Cut into documents, however it is written, a sheet has the rows that a parser finds in the whole of it."""
    content = sheet_of(body)
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, dated = W._book_parts(book)
        root = W.ElementTree.fromstring(book.read("xl/worksheets/sheet1.xml"))
    data = next(node for node in root if W._tag(node) == "sheetData")
    for node in data.iter():
        node.tag = W._tag(node)
    want = list(W._parsed_rows(b"<worksheet>" + W.ElementTree.tostring(data) + b"</worksheet>", 0, strings, dated))
    monkeypatch.setattr(W, "DOCUMENT_BYTES", 2000)
    monkeypatch.setattr(W, "READ_BYTES", 700)
    assert list(W._sheet_rows(content)) == want
    batch = pa.RecordBatch.from_pylist([{"name": "n", "kind": L.TRIAL_BALANCE, "part": i, "content": content[at : at + 999]} for i, at in enumerate(range(0, len(content), 999))])
    documents = list(W._documents([batch]))
    assert len(documents) > 5 and max(len(d.column("texts")[0]) for d in documents) <= len(strings)
    got = [row for part in W._decode(documents) for row in part.to_pylist()]
    assert [(r["row_no"] + 1, r["level"], r["cells"]) for r in got] == want[1:]
    assert [dict(r["fields"]) for r in got] == [{h: c for h, c in zip(want[0][2], cells) if h is not None} for _, _, cells in want[1:]]


def landed_twice(spark, tmp_path):
    trial = workbook([["Счет"], *[["т"]] * 4, ["50.01"], ["ООО"], ["01.01.2024 0:00:00", "Аренда", None, None, "1", None]])
    for version, company in enumerate("АБ"):
        Path(tmp_path / f"(Г){L.TRIAL_BALANCE}_{company}.xlsx").write_bytes(trial)
        land(W.find_workbooks(spark, str(tmp_path)), str(tmp_path / "landed"))


def staged_columns(monkeypatch):
    seen, stage = [], Staging.__call__
    monkeypatch.setattr(Staging, "__call__", lambda self, df: seen.append(df.columns) or stage(self, df))
    return seen


def test_landed_rows_are_written_once(spark, tmp_path, monkeypatch):
    seen = staged_columns(monkeypatch)
    landed_twice(spark, tmp_path)
    assert rows(landed_rows(spark, str(tmp_path / "landed")).groupBy("company").count()) == [("А", 7), ("Б", 7)]
    assert seen and not any("cells" in columns for columns in seen)
    assert not [n.name for n in (tmp_path / "landed").iterdir() if n.name.startswith("_next")]


def test_balances_take_landed_rows_as_they_are_read(spark, tmp_path, monkeypatch):
    landed_twice(spark, tmp_path)
    seen, kept = staged_columns(monkeypatch), KeptBalances(spark, str(tmp_path / "kept"))
    kept.sync(str(tmp_path / "landed"))
    assert rows(kept.trial.daily(), "company", "closing") == [("А", 1.0), ("Б", 1.0)]
    assert seen and not any("cells" in columns for columns in seen)
