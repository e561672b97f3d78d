import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from sieveline.operators import sinks
from sieveline.sources import files, imports, pdf, probes

CMAP = b"/CIDInit /ProcSet findresource begin 1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <6295> <0002> <6807> endbfchar 1 beginbfrange <0010> <0012> <0041> endbfrange end"


def pdf_bytes(extra=b"", content=None):
    body = zlib.compress(content or b"BT /F1 12 Tf 10 10 Td <00010002> Tj 0 -14 Td [<0010> -300 <00110012>] TJ ET BT /F2 9 Tf (plain \\(x\\)\\056) Tj T* (two) ' ET")
    stream = lambda n, d, b: b"%d 0 obj\n<<%s/Length %d>>\nstream\n%s\nendstream\nendobj\n" % (n, d, len(b), b)
    objects = zlib.compress(b"20 0 21 26 <</T (name)/V (value)>>    <</Names [(a.xml) 9 0 R]>>")
    return (
        b"%PDF-1.7\n1 0 obj <</Type/Catalog/Pages 2 0 R/Metadata 8 0 R/AcroForm<</Fields[20 0 R]>>/Names<</EmbeddedFiles 21 0 R>>>> endobj\n"
        b"2 0 obj<</Type/Pages/Kids[4 0 R 3 0 R]/Count 2/Resources<</Font<</F1 6 0 R/F2 7 0 R>>/XObject<</I 10 0 R>>>>>>endobj\n"
        b"3 0 obj<</Type/Page/Parent 2 0 R/Contents[]/Resources<<>>>>endobj 4 0 obj<</Type/Page/Parent 2 0 R/Contents 5 0 R>>endobj\n"
        + stream(5, b"/Filter/FlateDecode", body)
        + b"6 0 obj<</Type/Font/ToUnicode 11 0 R>>endobj 7 0 obj<</Type/Font/BaseFont/Helvetica>>endobj\n"
        + stream(8, b"", b'<x xmp:CreatorTool="T 1"><xmp:MetadataDate>2024-01-02</xmp:MetadataDate></x>')
        + b"10 0 obj<</Subtype/Image/Length 0>>endobj\n"
        + stream(11, b"/Filter[/FlateDecode]", zlib.compress(CMAP))
        + stream(12, b"/Type/ObjStm/N 2/First 11/Filter/FlateDecode", objects)
        + b"13 0 obj<</Author<FEFF674E>/CreationDate(D:20240101)>>endobj\ntrailer<</Root 1 0 R/Info 13 0 R" + extra + b">>\n%%EOF"
    )


def test_pdf():
    s = pdf.scan(pdf_bytes())
    assert (s.status, s.issues) == ("ok", [])
    assert [(p.page, p.text, p.has_text_layer, p.image_count) for p in s.pages] == [(1, "投标\nA BC\nplain (x).\n\ntwo".replace("\n\n", "\n"), True, 1), (2, "", False, 0)]
    assert s.metadata == {"Author": "李", "CreationDate": "D:20240101", "xmp:MetadataDate": "2024-01-02", "xmp:CreatorTool": "T 1"}
    assert s.forms == {"name": "value"} and s.embedded == ["a.xml"]
    assert pdf.scan(pdf_bytes(b"/Encrypt 9 0 R")).status == "password_protected"
    assert pdf.scan(b"").status == pdf.scan(None).status == "empty"
    assert pdf.scan(b"no pdf").status == "corrupt" and pdf.scan(b"%PDF-1.4 rest").status == "corrupt"
    assert pdf.scan(pdf_bytes().replace(b"5 0 obj\n<</Filter/FlateDecode", b"5 0 obj\n<</Filter/LZWDecode")).status == "partial"
    assert pdf._unpredicted(b"\x02\x01\x02\x02\x01\x01", 2) == b"\x01\x02\x02\x03"


def test_pdf_never_fails_on_cut_files(spark):
    whole = pdf_bytes()
    for n in range(0, len(whole), 37):
        pdf.scan(whole[:n])
    df = spark.createDataFrame([("a.pdf", bytearray(whole)), ("b.pdf", bytearray(b"%PDF")), ("c.pdf", None)], "relative_path string, content binary")
    got = {r.relative_path: r for r in pdf.scanned(df).collect()}
    assert [got[k].status for k in ("a.pdf", "b.pdf", "c.pdf")] == ["ok", "corrupt", "empty"]
    assert {r.relative_path: r.text[:2] for r in pdf.first_page_text(pdf.scanned(df)).collect()} == {"a.pdf": "投标", "b.pdf": "", "c.pdf": ""}


def test_exif_and_average_hash():
    tags = [(0x010F, 2, 5, b"Acme\0"), (0x0110, 2, 3, b"M1\0\0"), (0x0132, 2, 20, b"2024:01:02 03:04:05\0")]
    at = 8 + 2 + 12 * len(tags) + 4
    ifd, blob = struct.pack("<H", len(tags)), b""
    for tag, kind, n, data in tags:
        ifd += struct.pack("<HHI", tag, kind, n) + (data[:4] if n <= 4 else struct.pack("<I", at + len(blob)))
        blob += data if n > 4 else b""
    tiff = b"II*\0" + struct.pack("<I", 8) + ifd + b"\0\0\0\0" + blob
    app1 = b"Exif\0\0" + tiff
    jpeg = b"\xff\xd8\xff\xe1" + struct.pack(">H", len(app1) + 2) + app1 + b"\xff\xd9"
    assert probes.exif(jpeg) == {"Make": "Acme", "Model": "M1", "DateTime": "2024:01:02 03:04:05"}
    assert probes.exif(jpeg[:30]) == probes.exif(b"") == {}
    rows = b"".join(b"\0" + bytes((0, 0, 0) * 4 + (255, 255, 255) * 4) for _ in range(8))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 8, 8, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
    assert probes.png_hash(png) == "0f" * 8 and probes.png_hash(png[:40]) is None


def test_imports(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.json").write_text('﻿[{"record_kind": "penalty", "fields": {"x": "1"}}, {"record_kind": "other"}]')
    (d / "b.json").write_text('{"channel": "c", "ownership": [{"from_party_name": "p"}]}')
    (d / "c.json").write_text("broken")
    (d / "e.xyz").write_text("?")
    (d / "s.png").write_bytes(b"\x89PNG")
    (d / "s.meta.json").write_text("{}")
    assert {(r.path.rpartition("/")[2], r.kind) for r in imports.dispatched(spark, str(d)).collect()} == {("a.json", "json"), ("b.json", "json"), ("c.json", "json"), ("e.xyz", "unsupported"), ("s.png", "snapshot"), ("s.meta.json", "meta")}
    q, r, o = imports.json_queries(spark, str(d / "[abc].json"))
    assert {(x.file, x.record_count, x.status) for x in q.collect()} == {("a.json", 2, "ok"), ("b.json", 0, "ok"), ("c.json", 0, "failed")}
    assert [x.record_kind for x in r.orderBy("ord").collect()] == ["penalty", "other"] and o.first().from_party_name == "p"
    (tmp_path / "x.csv").write_text("record_kind,uscc,subject_name,extra\npenalty,91,A,v\nother,91,A,\nother,,B,w\n")
    q, r = imports.grouped_queries(files.external_csv(spark, str(tmp_path / "x.csv")))
    assert {(x.uscc, x.subject_name, x.record_count) for x in q.collect()} == {("91", "A", 2), ("", "B", 1)}
    assert r.join(q, "query_id").count() == 3
    assert {x.detail for x in imports.missing_roots(spark, str(tmp_path), ("in", "bids")).collect()} == {"bids"}


def test_ocr_delivery(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"job_id": "1", "status": "ok", "text": "a", "confidence": 0.5, "blocks": [{"text": "a", "bbox": {"x": 0.1, "y": 0.2, "width": 0.1, "height": 0.1}}]}))
    (tmp_path / "list.json").write_text(json.dumps([{"job_id": "2", "status": "failed"}]))
    (tmp_path / "in.json").write_text(json.dumps({"results": [{"job_id": "3", "status": "ok", "text": "c", "confidence": 2}]}))
    r = imports.ocr_results(spark, str(tmp_path))
    jobs = spark.createDataFrame([("1",), ("2",)], "job_id string")
    c = {x.job_id: (x.errors, x.accepted) for x in imports.ocr_errors(jobs, r).collect()}
    assert c == {"1": ([], False), "2": ([], False), "3": (["job", "confidence"], False)}
    old = spark.createDataFrame([("1", "old"), ("9", "kept")], "job_id string, text string")
    good = imports.ocr_errors(jobs, r.where("job_id <> '3'"))
    assert {tuple(x) for x in imports.ocr_upsert(old, good).collect()} == {("1", "a"), ("2", None), ("9", "kept")}
    assert {tuple(x) for x in imports.ocr_upsert(old, imports.ocr_errors(jobs, r)).collect()} == {("1", "old"), ("9", "kept")}


def test_fetched_pages(spark):
    html = "<table><tr><td>A &amp; B</td><td></td><td>3</td></tr><tr><td>C</td></tr></table>"
    rows = [("r", 1, 200, html), ("r", 2, 200, "<p>none</p>"), ("r", 3, 429, ""), ("r", 4, 200, "请输入验证码"), ("r", 5, None, None), ("r", 6, 403, "x")]
    f = spark.createDataFrame(rows, "request_id string, page int, status int, body string")
    got = {(x.page, x.ord): (x.state, x.fields) for x in imports.http_rows(f, ["name", "code", "n"]).collect()}
    assert got == {(1, 0): ("ok", {"name": "A & B", "n": "3"}), (1, 1): ("ok", {"name": "C"}), (2, None): ("no_results", None), (3, None): ("rate_limited", None), (4, None): ("captcha_required", None), (5, None): ("failed", None), (6, None): ("login_required", None)}
    api = spark.createDataFrame([("q", json.dumps({"data": {"list": [{"n": "A", "c": {"x": ["1", "2"]}}, {"n": ""}]}}))], "request_id string, body string")
    assert [x.fields for x in imports.api_rows(api, "data.list", {"name": "n", "last": "c.x.-1"}).orderBy("ord").collect()] == [{"name": "A", "last": "2"}, {}]


def test_confirmations(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"assignments": [{"document_id": "a", "supplier": "S"}, {"document_id": "b"}], "conflicts": [{"document_id": "c", "reason": "two"}]}))
    a, c = imports.confirmations(spark, str(tmp_path / "m.json"))
    assert [tuple(x) for x in a.collect()] == [("a", "S")] and {tuple(x) for x in c.collect()} == {("b", "incomplete"), ("c", "two")}


def test_sinks(spark, tmp_path):
    sinks.write_json(spark, str(tmp_path / "o/x.json"), {"b": "值", "a": [1]})
    sinks.write_json(spark, str(tmp_path / "o/x.json"), {"a": 2})
    assert json.loads((tmp_path / "o/x.json").read_text()) == {"a": 2} and not list((tmp_path / "o").glob("*.tmp"))
    df = spark.createDataFrame([("b", 'q"u,\n'), ("a", None)], "id string, note string")
    sinks.write_csv(df, str(tmp_path / "e.csv"), ["id"], {"id": "编号"})
    assert (tmp_path / "e.csv").read_bytes().decode() == '﻿编号,note\r\na,\r\nb,"q""u,\n"\r\n'
    assert sinks.markdown_table(df, ["id"], 1) == "| id | note |\n|---|---|\n| a |  |\n(1 more rows)"
    sinks.write_sheets({"s1": df, "s2": df.limit(0)}, str(tmp_path / "book"))
    assert spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "book/s1")).count() == 2
    calls = []

    def compute(todo):
        calls.append(todo.count())
        return todo.withColumn("v", F.upper("id"))

    keys = spark.createDataFrame([("a",), ("b",), ("a",)], "id string")
    assert {x.v for x in sinks.cached(keys, "id", str(tmp_path / "cache"), compute).collect()} == {"A", "B"}
    more = sinks.cached(keys.unionByName(spark.createDataFrame([("c",)], "id string")), "id", str(tmp_path / "cache"), compute)
    assert {x.v for x in more.collect()} == {"A", "B", "C"} and calls == [2, 1]
    assert sinks.stage_seconds({"a": 1.0}, "a", 2.34567) == {"a": 2.346}
    assert json.loads(sinks.progress_event(phase="p", secret="s", message="m" * 300, total=[1])) == {"phase": "p", "message": "m" * 200}
    assert sinks.key_hits({"a": [{"method": 1, "b": {"bbox": 2}}]}, ("method", "bbox", "zz")) == ["bbox", "method"]
    assert sinks.forbidden_columns(df.select(F.struct(F.array(F.struct("note"))).alias("x")), ("note", "id")) == ["note"]
    assert sinks.schemas({"t": df})["t"]["fields"][0]["name"] == "id"
    assert sinks.export_copies(spark, [str(tmp_path / "e.csv"), str(tmp_path / "none")], str(tmp_path / "out")) == [str(tmp_path / "e.csv")] and (tmp_path / "out/e.csv").exists()


def test_office_details(spark):
    import io
    import zipfile

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:p><w:r><w:t>x</w:t></w:r></w:p></w:body></w:document>")
        z.writestr("word/header1.xml", f"<w:hdr {w}><w:p><w:r><w:t>head</w:t></w:r></w:p></w:hdr>")
        z.writestr("word/footer2.xml", f"<w:ftr {w}><w:p><w:r><w:t>foot</w:t></w:r></w:p></w:ftr>")
        z.writestr("docProps/custom.xml", '<P xmlns="u" xmlns:v="t"><property name="Case"><v:lpwstr>7</v:lpwstr></property></P>')
    assert files.docx_units(out.getvalue()) == [("paragraph", 0, "x"), ("header", 0, "head"), ("footer", 0, "foot"), ("prop:Case", 0, "7")]
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {s} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Kept" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<R xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId7" Target="worksheets/sheet2.xml"/></R>')
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {s}><sheetData><row><c r="A1"><v>5</v></c></row></sheetData></worksheet>')
    assert files.xlsx_cells(out.getvalue()) == [("Kept", "A1", "5")]


@pytest.mark.parametrize("text, want", [("a: 1\nb:\n  - x\n  - 'y: z'\nc:\n  d: true\n  e: null\n# note\nf: \"q\"\n", {"a": 1, "b": ["x", "y: z"], "c": {"d": True, "e": None}, "f": "q"}), ("", {}), ("rules:\n  - id: R1\n    level: 2.5\n  - id: R2\n", {"rules": [{"id": "R1", "level": 2.5}, {"id": "R2"}]})])
def test_settings(text, want):
    from sieveline.sources.settings import parse

    assert parse(text) == want


def test_files_to_fields(spark):
    """From files of three kinds to field rows with evidence."""
    from sieveline.operators import pages

    scan = spark.createDataFrame([("bids/A/a.pdf", [(1, "投标文件 项目名称：青岚园区设备采购项目，电话：0571-87654321", True, 0), (2, "招标人：荻岸中心 联系人：王国强", True, 0), (3, "", False, 1)])], "relative_path string, pages array<struct<page: int, text: string, has_text_layer: boolean, image_count: int>>")
    office = spark.createDataFrame([("bids/A/b.docx", "ok", "cell", "3", "邮箱：a@b.example"), ("bids/A/b.docx", "ok", "prop:creator", "0", "me"), ("bids/A/c.docx", "corrupt", None, None, None)], "relative_path string, status string, kind string, place string, text string")
    texts = spark.createDataFrame([("bids/A/d.txt", "手 机：13812345678")], "relative_path string, text string")
    got = {(r.relative_path[-5:], r.place, r.field, r.value) for r in pages.unit_fields(pages.text_units(scan, office, texts)).collect()}
    assert got == {("a.pdf", "1", "project_name", "青岚园区设备采购项目"), ("a.pdf", "1", "phone", "0571-87654321"), ("a.pdf", "2", "contact_name", "王国强"), (".docx", "3", "email", "a@b.example"), ("d.txt", "0", "phone", "13812345678")}
    cells = spark.createDataFrame([("t.docx", "cell", str(i), t) for i, t in enumerate(["序号", "1. 额定功率：", "备注", "额定功率", "外形尺寸", "12.5", "要求"])], "relative_path string, kind string, place string, text string")
    assert [(r.metric_id, r.label) for r in pages.template_labels(cells).orderBy("metric_id").collect()] == [("M-001", "额定功率"), ("M-002", "外形尺寸")]


def test_cover_titles_and_recognised_fields(spark):
    from sieveline.operators import pages

    box = lambda y, x=0.1: (x, y, 0.2, 0.02)
    rows = [(1, "荻岸采购中心", 0.9, box(0.05)), (2, "青岚园区设备", 0.8, box(0.1)), (3, "采购安装工程", 0.7, box(0.15)), (4, "投标文件", 0.9, box(0.3)), (5, "联系人", 0.9, box(0.6)), (6, "王国强", 0.6, box(0.6, 0.4)), (7, "电话：13812345678", 0.95, None)]
    b = spark.createDataFrame([("d", 1, i, i, t, c, x) for i, t, c, x in rows], "document_id string, page int, block_id int, block_no int, text string, confidence double, bbox struct<x: double, y: double, width: double, height: double>")
    r = pages.cover_titles(b, ["document_id", "page"]).first()
    assert (r.tenderer, r.project_name, r.confidence) == ("荻岸采购中心", "荻岸采购中心青岚园区设备", 0.8)
    assert pages.cover_titles(b.where("block_id <> 4"), ["document_id", "page"]).count() == 0
    labels = spark.createDataFrame([("联系人", "contact_name")], "label string, field string")
    got = {(x.field, x.value): (x.confidence, x.relation) for x in pages.recognised_fields(b, labels, ["document_id", "page"]).collect()}
    assert got[("contact_name", "王国强")] == (0.6, "layout") and got[("phone", "13812345678")] == (0.5, "inline")
