"""Workbook files (S4): a directory of .xlsx files read as one table, one task per file.

``openpyxl`` is not available, so a sheet is read with the standard library:
an .xlsx file is a zip of XML parts (shared strings + worksheets).  The files
arrive through the ``binaryFile`` source and are parsed in ``mapInPandas``;
only cell text crosses into Python, every row leaves as strings.  Legacy
binary .xls files are rejected.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from itertools import islice
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(ref: str) -> int:
    letters = _REF.match(ref).group(1)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def iter_xlsx(content: bytes, sheet: int = 0) -> Iterator[list[str | None]]:
    """Rows of one sheet as lists of cell text (None for empty cells), read from the XML as a stream."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as part:
                for si in _elements(part, "si"):
                    shared.append("".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")))
        sheets = sorted(n for n in z.namelist() if n.startswith("xl/worksheets/sheet") and n.endswith(".xml"))
        sheets.sort(key=lambda n: int(re.findall(r"\d+", n.rsplit("/", 1)[1])[0]))
        with z.open(sheets[sheet]) as part:
            for row in _elements(part, "row"):
                cells: dict[int, str | None] = {}
                for c in row.findall("m:c", NS):
                    t = c.get("t")
                    if t == "inlineStr":
                        val = "".join(x.text or "" for x in c.iter(f"{{{NS['m']}}}t"))
                    else:
                        v = c.find("m:v", NS)
                        val = None if v is None else v.text
                        if t == "s" and val is not None:
                            val = shared[int(val)]
                    cells[_col_index(c.get("r"))] = val
                width = max(cells) + 1 if cells else 0
                yield [cells.get(i) for i in range(width)]


def _elements(part, name: str) -> Iterator[ET.Element]:
    """The elements of that name one after the other; each and what came before it is freed once it was used."""
    path = []
    for event, e in ET.iterparse(part, events=("start", "end")):
        if event == "start":
            path.append(e)
            continue
        path.pop()
        if e.tag == f"{{{NS['m']}}}{name}":
            yield e
            if path:
                path[-1].clear()


def parse_xlsx(content: bytes, sheet: int = 0) -> list[list[str | None]]:
    return list(iter_xlsx(content, sheet))


#: Rows of a parsed sheet that leave together.
PARSED_ROWS = 10_000


def parse_workbook_frame(files: DataFrame, columns: Sequence[str], path_col: str = "path",
                         content_col: str = "content") -> DataFrame:
    """(path, content) rows -> the sheet rows of every workbook, header row mapped to ``columns``."""
    from ..session import ship_package
    ship_package(files.sparkSession)
    cols = list(columns)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf[path_col], pdf[content_col]):
                rows = iter_xlsx(bytes(content))
                header = [(h or "").replace("\ufeff", "").strip() for h in next(rows, [])]
                pos = {h: i for i, h in enumerate(header)}
                done = 0
                while some := list(islice(rows, PARSED_ROWS)):
                    out = {c: [(r[pos[c]] if c in pos and pos[c] < len(r) else None) for r in some] for c in cols}
                    out["_file"] = [path] * len(some)
                    out["_row"] = list(range(done + 1, done + len(some) + 1))
                    yield pd.DataFrame(out, columns=cols + ["_file", "_row"])
                    done += len(some)
    schema = ", ".join(f"`{c}` string" for c in cols) + ", _file string, _row long"
    return files.select(path_col, content_col).mapInPandas(parse, schema)


def read_workbooks(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All .xlsx files under ``path`` as one string table (``_file``, ``_row`` keep the origin)."""
    if path.lower().endswith(".xls"):
        raise ValueError("legacy .xls workbooks are not supported; save as .xlsx")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    if columns is None:
        columns = workbook_headers(files)
    return parse_workbook_frame(files, columns)


def workbook_headers(files: DataFrame) -> list[str]:
    """Union of header names over all files (a small distinct set, in first-seen order)."""
    from ..session import ship_package
    ship_package(files.sparkSession)

    def heads(batches):
        for pdf in batches:
            for content in pdf["content"]:
                first = next(iter_xlsx(bytes(content)), [])
                hdr = [(h or "").replace("\ufeff", "").strip() for h in first]
                yield pd.DataFrame({"h": hdr, "i": list(range(len(hdr)))})
    hs = files.select("content").mapInPandas(heads, "h string, i long").groupBy("h").agg(F.min("i").alias("i"))
    return [r["h"] for r in hs.orderBy("i", "h").collect() if r["h"]]


# ---- writer (exports and round-trip tests) -----------------------------------------
def _esc(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def build_xlsx(header: Sequence[str], rows: Sequence[Sequence]) -> bytes:
    """A minimal single-sheet .xlsx with inline-string cells."""
    def cell(ci, ri, v):
        ref = ""
        n = ci + 1
        while n:
            n, rem = divmod(n - 1, 26)
            ref = chr(65 + rem) + ref
        if v is None:
            return ""
        return f'<c r="{ref}{ri}" t="inlineStr"><is><t xml:space="preserve">{_esc(str(v))}</t></is></c>'
    body = []
    for ri, r in enumerate([list(header)] + [list(x) for x in rows], start=1):
        body.append(f'<row r="{ri}">' + "".join(cell(ci, ri, v) for ci, v in enumerate(r)) + "</row>")
    sheet = ('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="%s"><sheetData>%s</sheetData></worksheet>'
             % (NS["m"], "".join(body)))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/'
                   'content-types"><Default Extension="xml" ContentType="application/xml"/></Types>')
        z.writestr("xl/workbook.xml", '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="%s"><sheets>'
                   '<sheet name="Sheet1" sheetId="1"/></sheets></workbook>' % NS["m"])
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return buf.getvalue()


def row_groups(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The rows of ``batches`` again, in frames of ``rows`` (the last may be shorter), holding one at a time."""
    held, n = [], 0
    for pdf in batches:
        while n + len(pdf) >= rows:
            yield pd.concat([*held, pdf.iloc[:rows - n]], ignore_index=True)
            pdf, held, n = pdf.iloc[rows - n:], [], 0
        if len(pdf):
            held.append(pdf)
            n += len(pdf)
    if held:
        yield pd.concat(held, ignore_index=True)


def workbooks_from_frame(df: DataFrame, name: str = "part", rows: int = 10_000) -> DataFrame:
    """Workbooks of at most ``rows`` rows: (path, content) rows, as the binaryFile source yields them."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    cols = df.columns

    def build(batches):
        import uuid
        for pdf in row_groups(batches, rows):
            some = pdf.astype(object).where(pdf.notna(), None).values.tolist()
            yield pd.DataFrame({"path": [f"{name}-{uuid.uuid4().hex}.xlsx"], "content": [build_xlsx(cols, some)]})
    return df.mapInPandas(build, "path string, content binary")
