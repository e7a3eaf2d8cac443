"""Excel workbooks (.xlsx) as a data source: one sheet, its first row the header."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile

from pyspark.sql.datasource import DataSource, DataSourceReader

from ..schema.infer import infer_schema, row

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def records(data: bytes, sheet: int = 1) -> list[dict]:
    """Rows of a sheet as records; empty cells are null."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(_M + "t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(_M + "si")]
        rows = []
        for r in ET.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml")).iter(_M + "row"):
            cells = {}
            for at, c in enumerate(r.iter(_M + "c")):
                v, kind = c.find(_M + "v"), c.get("t", "n")
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(_M + "t"))
                elif v is None or v.text is None:
                    value = None
                elif kind == "s":
                    value = shared[int(v.text)]
                elif kind == "b":
                    value = v.text == "1"
                elif kind in ("str", "e", "d"):
                    value = v.text
                else:
                    value = float(v.text)
                    value = int(value) if value.is_integer() and "." not in v.text and "E" not in v.text.upper() else value
                cells[_column(c.get("r")) if c.get("r") else at] = value
            rows.append(cells)
    if not rows:
        return []
    header = {i: str(name) for i, name in rows[0].items() if name is not None}
    return [{name: r.get(i) for i, name in header.items()} for r in rows[1:] if any(v is not None for v in r.values())]


def workbook(header: list[str], rows: list[tuple]) -> bytes:
    """A minimal workbook with inline strings."""
    from xml.sax.saxutils import escape

    def cell(v):
        if v is None:
            return "<c/>"
        if isinstance(v, bool):
            return f'<c t="b"><v>{int(v)}</v></c>'
        if isinstance(v, int | float):
            return f"<c><v>{v!r}</v></c>"
        return f'<c t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'

    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in [header, *rows])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_M[1:-1]}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def write_excel(df, path: str, rows_per_book: int = 5000) -> int:
    """All rows of ``df`` as workbooks in the folder ``path``; returns their number.

    Executors make the workbooks.  Python there cannot reach every store, so the driver
    passes them on, one at a time.
    """
    import pyarrow as pa

    from .. import workdir

    header = df.columns

    def books(batches):
        waiting = []
        for b in batches:
            waiting += zip(*(c.to_pylist() for c in b.columns), strict=True)
            while len(waiting) >= rows_per_book:
                yield pa.RecordBatch.from_arrays([pa.array([workbook(header, waiting[:rows_per_book])], pa.binary())], names=["content"])
                del waiting[:rows_per_book]
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array([workbook(header, waiting)], pa.binary())], names=["content"])

    def put(content):
        fs, where = workdir.filesystem(df.sparkSession, f"{path}/part-{n:05d}.xlsx")
        out = fs.create(where, True)
        out.write(bytearray(content))
        out.close()

    n = 0
    for r in df.mapInArrow(books, "content binary").toLocalIterator():
        put(r["content"])
        n += 1
    if not n:
        put(workbook(header, []))
        n = 1
    return n


class _Reader(DataSourceReader):
    def __init__(self, rows, schema):
        self.rows, self.schema = rows, schema

    def read(self, partition):
        for r in self.rows:
            yield row(r, self.schema)


class ExcelSource(DataSource):
    """Options ``workbook`` (a file where the query is planned) and ``sheet``."""

    @classmethod
    def name(cls):
        return "fedspark_excel"

    def _rows(self):
        with open(re.sub("^file:(//)?", "", self.options["workbook"]), "rb") as f:
            return records(f.read(), int(self.options.get("sheet", 1)))

    def schema(self):
        return infer_schema(self._rows())

    def reader(self, schema):
        return _Reader(self._rows(), schema)


def read_excel(spark, path: str, sheet: int = 1, schema=None):
    """Workbooks in any store that Spark reads, one task a file.  The first one gives the schema."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    files = spark.read.format("binaryFile").load(path).select("content")
    if schema is None:
        schema = infer_schema(records(bytes(files.first()["content"]), sheet))

    def parse(batches):
        wanted = to_arrow_schema(schema)
        for b in batches:
            for content in b.column(0):
                rows = [dict(zip(schema.fieldNames(), row(r, schema), strict=True)) for r in records(content.as_py(), sheet)]
                yield pa.RecordBatch.from_pylist(rows, wanted)

    return files.mapInArrow(parse, schema)
