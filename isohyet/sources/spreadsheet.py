"""Spreadsheet workbooks (sheets in zipped XML) as a data source.

    spark.read.format("xlsx").schema("month date, spi3 double").option("sheet", "spi").load("indices.xlsx")
    spreadsheet.write({"spi": spi, "pni": pni}, "indices.xlsx")

The schema's columns are found by name in the sheet's first row; a task opens the one sheet asked for and keeps the cells of
those columns alone. Cells are turned into the schema's types; an empty cell is NULL. The format holds 1,048,576 rows a
sheet, so a file is the work of one task, which streams rows into it.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from isohyet.sources import packages
from isohyet.sources.netcdf import _store

#: Rows of a sheet, the day before serial number 1, names of the format's parts and kinds.
MOST_ROWS = 1_048_576
_DAY_ZERO = dt.datetime(1899, 12, 30)
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_KINDS = "application/vnd.openxmlformats-officedocument.spreadsheetml"
CELLS = "sheet int, place long, kinds string, cells array<string>"


def column_name(k: int) -> str:
    """A, B, ... Z, AA, ... of the column number from 0."""
    out = ""
    k += 1
    while k:
        k, rest = divmod(k - 1, 26)
        out = chr(65 + rest) + out
    return out


def column_number(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def encode_text(text: str) -> str:
    """Characters that XML can't hold, and what looks like their stand-in, as _xHHHH_."""
    text = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", text)
    return escape(re.sub("[\x00-\x08\x0b-\x1f\ufffe\uffff]", lambda m: f"_x{ord(m[0]):04X}_", text))


def decode_text(text: str) -> str:
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text)


# --- reading ------------------------------------------------------------------------------------------


def sheet_parts(book: zipfile.ZipFile) -> dict[str, str]:
    """Name of the zip's member of each sheet, in order."""
    relations = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    found = ET.fromstring(book.read("xl/workbook.xml")).iter(f"{{{_MAIN}}}sheet")
    part = lambda target: target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return {s.get("name"): part(relations[s.get(f"{{{_RELATION}}}id")]) for s in found}


def _texts(node) -> str:
    """Text of a string item, of its runs if it has some; how it is read aloud is left out."""
    skip = {id(t) for p in node.iter(f"{{{_MAIN}}}rPh") for t in p.iter()}
    return decode_text("".join(t.text or "" for t in node.iter(f"{{{_MAIN}}}t") if id(t) not in skip))


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as file:
        for _, node in ET.iterparse(file):
            if node.tag == f"{{{_MAIN}}}si":
                out.append(_texts(node))
                node.clear()
    return out


def rows_of(book: zipfile.ZipFile, part: str, wanted=None) -> Iterator[dict[int, object]]:
    """Cells of each row by column number; of the first row all, then those that ``wanted(first row)`` names.

    Numbers are floats, booleans bools, others texts; errors and empty cells are left out.
    """
    shared: list[str] | None = None
    keep = None
    with book.open(part) as file:
        for _, node in ET.iterparse(file):
            if node.tag != f"{{{_MAIN}}}row":
                continue
            row, at = {}, -1
            for cell in node.findall(f"{{{_MAIN}}}c"):
                at = column_number(cell.get("r")) if cell.get("r") else at + 1
                if keep is not None and at not in keep:
                    continue
                kind, value = cell.get("t", "n"), cell.find(f"{{{_MAIN}}}v")
                if kind == "inlineStr":
                    row[at] = _texts(cell)
                elif value is None or value.text is None or kind == "e":
                    continue
                elif kind == "s":
                    shared = _shared(book) if shared is None else shared
                    row[at] = shared[int(value.text)]
                elif kind == "n":
                    row[at] = float(value.text)
                else:
                    row[at] = value.text == "1" if kind == "b" else decode_text(value.text)
            node.clear()
            if keep is None and wanted is not None:
                keep = wanted(row)
            yield row


def typed(value, kind: str):
    """A cell as the type of its column; ValueError where it can't be."""
    if value is None:
        return None
    if kind == "string":
        return str(int(value)) if isinstance(value, float) and value.is_integer() else str(value).lower() if isinstance(value, bool) else str(value)
    if kind == "boolean":
        return bool(value) if not isinstance(value, str) else {"true": True, "false": False}[value.lower()]
    if kind in ("date", "timestamp", "timestamp_ntz"):
        when = _DAY_ZERO + dt.timedelta(days=float(value)) if not isinstance(value, str) else dt.datetime.fromisoformat(value)
        when = (when + dt.timedelta(microseconds=500)).replace(microsecond=0) if not isinstance(value, str) else when
        return when.date() if kind == "date" else when
    number = float(value)
    return number if kind in ("double", "float") else int(number)


class Reader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.sheet = options["path"], options.get("sheet")
        self.columns = [(f.name, f.dataType.simpleString()) for f in schema]

    def partitions(self):
        from pyarrow import fs

        store, root = _store(self.path)
        if store.get_file_info(root).is_file:
            return [InputPartition(root)]
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        return [InputPartition(p) for p in sorted(i.path for i in found if i.is_file and i.base_name.endswith(".xlsx") and not i.base_name.startswith(("_", ".", "~")))] or [InputPartition(None)]

    def read(self, partition):
        if partition.value is None:
            return
        store, _ = _store(self.path)
        with store.open_input_file(partition.value) as raw, zipfile.ZipFile(raw) as book:
            parts = sheet_parts(book)
            name = self.sheet or next(iter(parts))
            if name not in parts:
                raise ValueError(f"no sheet {name}")
            places: list[int] = []

            def wanted(first):
                by = {str(v): k for k, v in first.items()}
                if lacks := [c for c, _ in self.columns if c not in by]:
                    raise ValueError(f"sheet {name} has no column {', '.join(lacks)}")
                places.extend(by[c] for c, _ in self.columns)
                return set(places)

            for n, row in enumerate(rows_of(book, parts[name], wanted)):
                if n:
                    yield tuple(typed(row.get(k), kind) for k, (_, kind) in zip(places, self.columns, strict=True))


# --- writing ------------------------------------------------------------------------------------------


def _cell(reference: str, kind: str, text: str | None) -> str:
    """kind: s text, n number, b boolean, d day or time (a serial number)."""
    if text is None:
        return ""
    if kind == "s":
        return f'<c r="{reference}" t="inlineStr"><is><t xml:space="preserve">{encode_text(text)}</t></is></c>'
    if kind == "b":
        return f'<c r="{reference}" t="b"><v>{int(text == "true")}</v></c>'
    return f'<c r="{reference}"{" s=" + chr(34) + "1" + chr(34) if kind == "d" else ""}><v>{text}</v></c>'


def write_book(out, sheets: Sequence[str], rows: Iterator[tuple[int, str, Sequence[str | None]]]) -> None:
    """A workbook to the open file ``out``; ``rows``: (number of the sheet, kinds of the cells, cells), sheet by sheet."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        override = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{_KINDS}.worksheet+xml"/>' for k in range(1, len(sheets) + 1))
        book.writestr("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{_KINDS}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{_KINDS}.styles+xml"/>{override}</Types>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_RELATION}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        named = "".join(f'<sheet name={quoteattr(n)} sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELATION}"><sheets>{named}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Type="{_RELATION}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">{links}<Relationship Id="rId{len(sheets) + 1}" Type="{_RELATION}/styles" Target="styles.xml"/></Relationships>')
        blank = '<font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}"><fonts count="1">{blank}<cellXfs count="2"><xf/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>')
        ahead = next(rows, None)
        for k in range(len(sheets)):
            with book.open(f"xl/worksheets/sheet{k + 1}.xml", "w", force_zip64=True) as part:
                part.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                n = 0
                while ahead is not None and ahead[0] == k:
                    n += 1
                    if n > MOST_ROWS:
                        raise ValueError(f"sheet {sheets[k]} has more than {MOST_ROWS} rows")
                    cells = "".join(_cell(f"{column_name(c)}{n}", kind, text) for c, (kind, text) in enumerate(zip(ahead[1], ahead[2], strict=True)))
                    part.write(f'<row r="{n}">{cells}</row>'.encode())
                    ahead = next(rows, None)
                part.write(b"</sheetData></worksheet>")


@dataclass
class Written(WriterCommitMessage):
    name: str


class Writer(DataSourceWriter):
    """Takes CELLS of one partition in order; the file gets its name when the job commits."""

    def __init__(self, options):
        self.path, self.sheets = options["path"], options["sheets"].split("\x1f")

    def write(self, iterator):
        rows = ((r.sheet, r.kinds, r.cells) for r in iterator)
        store, root = _store(self.path)
        folder = root.rpartition("/")[0]
        store.create_dir(folder, recursive=True)
        name = f"{folder}/_{uuid.uuid4().hex}"
        with store.open_output_stream(name) as out:
            write_book(out, self.sheets, rows)
        return Written(name)

    def commit(self, messages):
        store, root = _store(self.path)
        done = [m for m in messages if m]
        if len(done) != 1:
            raise ValueError("a workbook is written by one task")
        store.move(done[0].name, root)

    def abort(self, messages):
        store, _ = _store(self.path)
        for m in messages:
            if m:
                store.delete_file(m.name)


class Source(DataSource):
    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        """Without a schema of the caller's: the first file's column names, as texts."""
        path = Reader(self.options, []).partitions()[0].value
        if path is None:
            raise ValueError("no workbook")
        store, _ = _store(self.options["path"])
        with store.open_input_file(path) as raw, zipfile.ZipFile(raw) as book:
            parts = sheet_parts(book)
            first = next(rows_of(book, parts[self.options.get("sheet") or next(iter(parts))]), {})
        return ", ".join(f"`{v}` string" for _, v in sorted(first.items()))

    def reader(self, schema):
        return Reader(self.options, schema)

    def writer(self, schema, overwrite):
        return Writer(self.options)


def register(spark: SparkSession) -> None:
    packages.ship(spark)
    spark.dataSource.register(Source)


def read(spark: SparkSession, path: str, sheet: str, schema: str | None = None) -> DataFrame:
    """A sheet's columns of ``schema`` (all, as texts, without one) of a workbook or of all workbooks in a folder."""
    register(spark)
    found = spark.read.format("xlsx").option("sheet", sheet)
    return (found.schema(schema) if schema else found).load(path)


def _as_cells(df: DataFrame, sheet: int) -> DataFrame:
    kinds, texts = "", []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("date", "timestamp", "timestamp_ntz"):
            stamp = c.cast("timestamp_ntz")
            texts.append((F.timestamp_diff("SECOND", F.lit(_DAY_ZERO).cast("timestamp_ntz"), stamp) / 86400).cast("string"))
        elif kind in ("double", "float"):
            texts.append(F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c).cast("string"))
        else:
            texts.append(c.cast("string"))
        kinds += "d" if kind in ("date", "timestamp", "timestamp_ntz") else "b" if kind == "boolean" else "n" if kind in ("double", "float", "int", "bigint", "smallint", "tinyint") or kind.startswith("decimal") else "s"
    head = df.sparkSession.createDataFrame([(sheet, -1, "s" * len(df.columns), df.columns)], CELLS)
    body = df.select(F.lit(sheet).alias("sheet"), F.monotonically_increasing_id().alias("place"), F.lit(kinds).alias("kinds"), F.array(*texts).alias("cells"))
    return head.unionAll(body)


def write(tables: Mapping[str, DataFrame], path: str) -> None:
    """One workbook with a sheet for each table, in order, rows in the order of the table. NaN and infinite values are
    empty cells, as NULLs are; times have whole seconds; other than plain types are texts. A sheet of too many rows is
    an error. An old workbook of that name stays until the new one is whole."""
    if not tables:
        raise ValueError("a workbook has a sheet at least")
    spark = next(iter(tables.values())).sparkSession
    register(spark)
    rows = None
    for k, df in enumerate(tables.values()):
        own = _as_cells(df, k)
        rows = own if rows is None else rows.unionAll(own)
    ordered = rows.coalesce(1).sortWithinPartitions("sheet", "place")  # bounded by the format
    ordered.write.format("xlsx").mode("append").option("sheets", "\x1f".join(tables)).save(path)
