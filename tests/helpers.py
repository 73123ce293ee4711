"""Small rows in, plain Python values out; and a writer of minimal workbooks."""

import datetime
import io
import zipfile
from decimal import Decimal
from xml.sax.saxutils import escape


def day(n, month=1):
    return datetime.date(2024, month, n)


def rows(df, *cols):
    """Rows as sorted tuples; decimals as floats."""
    picked = df.select(*cols) if cols else df
    values = [tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in picked.collect()]
    return sorted(values, key=lambda r: tuple((v is None, str(v)) for v in r))


def workbook(sheet_rows, date_style=False):
    """Bytes of a workbook: ``sheet_rows`` are (outline level, cells) or plain cell lists."""
    strings, lines = [], []
    for r, row in enumerate(sheet_rows, start=1):
        level, cells = row if isinstance(row, tuple) else (0, row)
        xml = ""
        for c, value in enumerate(cells):
            place = f"{chr(65 + c)}{r}"
            if value is None:
                continue
            if isinstance(value, datetime.date):
                serial = (value - datetime.date(1899, 12, 30)).days
                xml += f'<c r="{place}" s="1"><v>{serial}</v></c>'
            elif isinstance(value, (int, float)):
                xml += f'<c r="{place}"><v>{value}</v></c>'
            elif c % 2:
                xml += f'<c r="{place}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
            else:
                if value not in strings:
                    strings.append(value)
                xml += f'<c r="{place}" t="s"><v>{strings.index(value)}</v></c>'
        outline = f' outlineLevel="{level}"' if level else ""
        lines.append(f'<row r="{r}"{outline}>{xml}</row>')
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {main}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>",
        "xl/styles.xml": f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f"<worksheet {main}><sheetData>{''.join(lines)}</sheetData></worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()
