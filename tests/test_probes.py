import io
import json
import struct
import zipfile

from sieveline.sources import files, probes

PDF = b"%PDF-1.4\n1 0 obj<</Type/Pages/Kids[2 0 R 3 0 R]>>\n2 0 obj<</Type /Page>>\n3 0 obj<</Type/Page>>\n<</Author (A \\(b\\)) /CreationDate (D:20240101)>>\n%%EOF\n"
PNG = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 30, 20) + b"\x08\x02"
JPEG = b"\xff\xd8\xff\xe0\x00\x04ab" + b"\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 20, 30) + b"\x01\x01\x11\x00" + b"\xff\xd9"


def test_probe():
    assert probes.probe(PDF, "a.pdf") == ("ok", 2, {"Author": "A (b)", "CreationDate": "D:20240101"})
    assert probes.probe(PDF[:-8], "a.pdf")[0] == "corrupt"
    assert probes.probe(PDF.replace(b"<</Author", b"<</Encrypt 5 0 R/Author"), "a.pdf")[0] == "password_protected"
    assert probes.probe(b"", "a.pdf")[0] == probes.probe(None, "x")[0] == "empty"
    assert probes.probe(b"PK\x03\x04zzz", "a.docx")[0] == "corrupt"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", "x")
    assert probes.probe(out.getvalue(), "a.xlsx")[:2] == ("ok", 1)
    assert probes.probe(bytes.fromhex("D0CF11E0A1B11AE1") + b"x", "a.docx")[0] == "password_protected"
    assert probes.image_size(PNG) == probes.image_size(JPEG) == (30, 20)
    assert probes.image_size(b"\xff\xd8\xff") is None


def test_frames(spark, tmp_path):
    (tmp_path / "bids/A").mkdir(parents=True)
    (tmp_path / "bids/A/a.pdf").write_bytes(PDF)
    (tmp_path / "bids/A/b.png").write_bytes(PNG)
    got = {r.relative_path: (r.status, r.units, r.properties.get("width")) for r in probes.probed(files.project_tree(spark, str(tmp_path))).collect()}
    assert got == {"bids/A/a.pdf": ("ok", 2, None), "bids/A/b.png": ("ok", None, "30")}
    (tmp_path / "bids/A/b.meta.json").write_text(json.dumps({k: "x" for k in probes.SNAPSHOT_KEYS}))
    snap = {r.path.rpartition("/")[2]: (r.strength, len(r.missing)) for r in probes.snapshots(spark, str(tmp_path)).collect()}
    assert snap == {"a.pdf": ("C", 5), "b.png": ("B", 0)}
