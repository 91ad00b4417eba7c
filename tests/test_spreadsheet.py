"""Spreadsheet files: round trips, files of other programs, pruning, odd texts and damage."""

import datetime as dt
import io
import zipfile

import pytest

from isohyet.sources import spreadsheet as sp

ODD = ["plain", "", " a  b ", "<&>\"'", "é日本", "tab\tnew\nline", "bell\x07\x0c", "_x0041_", "_x005F_", "\r\n", "x" * 5000, None]


def test_round_trip_of_types_and_texts(spark, tmp_path):
    rows = [(t, k, k / 7 if k % 5 else float("nan"), k % 2 == 0 if k % 3 else None, dt.date(1900, 3, 1) + dt.timedelta(days=977 * k), dt.datetime(2020, 2, 29, 23, 59, k)) for k, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "text string, n long, x double, b boolean, day date, ts timestamp_ntz").coalesce(1)
    path = str(tmp_path / "out" / "book.xlsx")
    sp.write({"first & one": df, "empty": df.where("false"), "third": df.select("n")}, path)
    back = sp.read(spark, f"file://{path}", "first & one", "text string, n long, x double, b boolean, day date, ts timestamp_ntz").collect()
    assert [tuple(r) for r in back] == [(t, n, None if x != x else x, b, d, s) for t, n, x, b, d, s in rows]
    assert sp.read(spark, path, "empty", "n long").collect() == []
    assert [r.n for r in sp.read(spark, path, "third").collect()] == [str(k) for k in range(len(rows))]
    assert [tuple(r) for r in sp.read(spark, path, "first & one", "day date, n int").collect()] == [(r[4], r[1]) for r in rows]
    for sheet, schema in (("none", "n long"), ("third", "m long")):
        with pytest.raises(Exception, match="no sheet|no column"):
            sp.read(spark, path, sheet, schema).collect()


def test_a_failed_write_leaves_the_old_file(spark, tmp_path, monkeypatch):
    path = tmp_path / "book.xlsx"
    sp.write({"a": spark.range(3)}, str(path))
    with pytest.raises(Exception, match="BIGINT|CAST|cast"):
        sp.write({"a": spark.range(3), "b": spark.sql("select cast(concat('x', id) as bigint) as x from range(5)")}, str(path))
    assert sp.read(spark, str(path), "a", "id long").count() == 3


def foreign():
    """As other programs write them: shared strings with runs, gaps, no references, booleans, errors, formulas."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{sp._MAIN}" xmlns:r="{sp._RELATION}"><sheets><sheet name="Data" sheetId="4" r:id="rX"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{sp._PACKAGE}/relationships"><Relationship Id="rX" Type="t" Target="/xl/worksheets/deep.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{sp._MAIN}"><si><t>id</t></si><si><r><t>na</t></r><r><t>me</t></r><rPh><t>no</t></rPh></si><si><t>one</t></si></sst>')
        z.writestr("xl/worksheets/deep.xml", f'<worksheet xmlns="{sp._MAIN}"><sheetData><row r="1"><c r="B1" t="s"><v>0</v></c><c r="AB1" t="s"><v>1</v></c><c t="inlineStr"><is><t>ok</t></is></c></row>'
                   '<row r="3"><c r="B3"><f>1+1</f><v>2</v></c><c r="C3"><v>99</v></c><c r="AB3" t="s"><v>2</v></c><c r="AC3" t="b"><v>1</v></c></row><row r="4"><c r="B4" t="e"><v>#DIV/0!</v></c><c r="AB4" t="str"><v>two</v></c></row></sheetData></worksheet>')  # fmt: skip
    return out.getvalue()


def test_files_of_other_programs(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(foreign())
    (tmp_path / "b.xlsx").write_bytes(foreign())
    (tmp_path / "~lock.xlsx").write_bytes(b"")
    one = sp.read(spark, str(tmp_path / "a.xlsx"), "Data", "id int, name string, ok boolean").collect()
    assert [tuple(r) for r in one] == [(2, "one", True), (None, "two", None)]
    assert sp.read(spark, str(tmp_path), "Data", "id int").count() == 4  # a folder of workbooks
    (tmp_path / "bad.xlsx").write_bytes(b"not a zip")
    with pytest.raises(Exception, match="zip"):
        sp.read(spark, str(tmp_path / "bad.xlsx"), "Data", "id int").collect()


def test_one_sheet_and_its_columns_are_read():
    opened = []

    class Book(zipfile.ZipFile):
        def open(self, name, *args, **kw):
            opened.append(name if isinstance(name, str) else name.filename)
            return super().open(name, *args, **kw)

    data = io.BytesIO()
    sp.write_book(data, ["a", "b"], iter([(0, "ss", ["x", "y"]), (0, "nn", ["1", "2"]), (1, "s", ["z"]), (1, "n", ["3"])]))
    with Book(data) as book:
        assert list(sp.rows_of(book, sp.sheet_parts(book)["a"], lambda first: {1})) == [{0: "x", 1: "y"}, {1: 2.0}]
    assert [n for n in opened if "sheet" in n] == ["xl/worksheets/sheet1.xml"] and "xl/sharedStrings.xml" not in opened


def test_columns_and_limits(monkeypatch):
    assert [sp.column_name(k) for k in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert all(sp.column_number(sp.column_name(k) + "7") == k for k in range(2000))
    monkeypatch.setattr(sp, "MOST_ROWS", 2)
    with pytest.raises(ValueError):
        sp.write_book(io.BytesIO(), ["a"], iter([(0, "n", ["1"])] * 3))
