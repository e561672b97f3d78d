import difflib
import io
import itertools
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.operators import decide, extract, layout, match, ordered
from sieveline.sources import files
from sieveline.streaming import upserts


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {'array<double>' if isinstance(v, list) else 'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expr.alias("x")).first().x


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_identifiers(spark):
    assert one(spark, text.credit_status(F.col("a")), a="91350100M000100Y43") == "valid"
    assert one(spark, text.credit_status(F.col("a")), a="91110108MA01ABCD0C") == "check_digit_error"
    assert one(spark, text.credit_status(F.col("a")), a="９１３５０１００Ｍ０００１００Ｙ４３ ") == "valid"
    assert one(spark, text.credit_status(F.col("a")), a=None) == "absent"
    assert one(spark, text.credit_status(F.col("a")), a="O" * 18) == "charset_error"
    assert one(spark, text.identity_valid(F.col("a")), a="11010519491231002X") is True
    assert one(spark, text.identity_valid(F.col("a")), a="110101197001014118") is False
    assert one(spark, text.identity_mask(F.col("a")), a="11010519491231002x") == "1101**********002X"


def test_texts(spark):
    assert one(spark, text.phone_main(F.col("a")), a="+86 138-1234-5678 转 12") == "13812345678"
    assert one(spark, text.phone_main(F.col("a")), a="8612345") == "12345"
    assert one(spark, text.phone_extension(F.col("a")), a="0591-87654321转802") == "802"
    assert one(spark, text.search_key(F.col("a")), a="甲乙 集团有限公司") == "甲乙"
    assert str(one(spark, text.iso_day(F.col("a")), a="2026/1/5 其他")) == "2026-01-05"
    assert one(spark, text.iso_day(F.col("a")), a="2026年2月30日") is None
    assert one(spark, text.json_path(F.col("a"), "d.items.-1.n"), a=json.dumps({"d": {"items": [{"n": 1}, {"n": 7}]}})) == "7"
    assert one(spark, text.json_path(F.col("a"), "d.0"), a='{"d": ["x"]}') == "x"
    assert one(spark, text.table_rows(F.col("a")), a="<table><tr><th>A</th></tr><tr><td>1 &amp; <b>2</b></td><td>x</td></tr></table>") == [["A"], ["1 & 2", "x"]]
    assert one(spark, text.average_hash(F.col("a")), a=[0.0] * 32 + [1.0] * 32) == "00000000ffffffff"
    assert one(spark, text.nfkc(F.col("a")), a="Ⅲ①ｱ") == "III1ア"
    box = one(spark, text.box_normalised(F.col("a"), F.lit(-5.0), F.lit(50.0), F.lit(100.0), F.lit(200.0), F.lit(100.0)), a=150.0)
    assert (box.x, box.y, box.width, box.height) == (0.25, 0.0, 0.5, 1.0)


@pytest.mark.parametrize("n, letters", [(1, "A"), (26, "Z"), (27, "AA"), (52, "AZ"), (702, "ZZ"), (703, "AAA")])
def test_columns(spark, n, letters):
    assert one(spark, text.column_letters(F.col("a")), a=n) == letters
    assert one(spark, text.column_number(F.col("a")), a=letters) == n


def test_similar_names_against_brute_force(spark):
    rnd = random.Random(5)
    names = sorted({"".join(rnd.choice("甲乙丙丁戊") for _ in range(rnd.randint(2, 6))) for _ in range(60)} | {"华信创远", "华信创远信息技术", "甲乙丙丁", "甲丙丁戊"})
    df = spark.createDataFrame([("p", n) for n in names] + [("q", names[0]), ("p", ""), ("p", names[0])], "g string, k string")
    got = {(r.name_a, r.name_b): r.similarity for r in match.similar_names(df, "g", "k").collect()}
    want = {}
    for a, b in itertools.combinations(names, 2):
        s = 0.9 if (a in b or b in a) and min(len(a), len(b)) / max(len(a), len(b)) >= 0.4 else 2 * lcs(a, b) / (len(a) + len(b))
        if round(s, 3) >= 0.75:
            want[a, b] = round(s, 3)
    assert got == want and got["甲丙丁戊", "甲乙丙丁"] == 0.75 if ("甲丙丁戊", "甲乙丙丁") in got else got == want


def test_band_join_meets_each_pair_once(spark):
    rnd = random.Random(2)
    a, b = ([(i, rnd.randrange(-500, 500)) for i in range(80)] for _ in range(2))
    got = sorted((r.i, r.j) for r in match.band_join(spark.createDataFrame(a, "i int, t long"), spark.createDataFrame(b, "j int, u long"), [], "t", "u", 30).collect())
    assert got == sorted((i, j) for i, t in a for j, u in b if abs(t - u) <= 30)


def test_intervals(spark):
    at = lambda s, e, d: one(spark, match.effective_at(F.col("s").cast("date"), F.col("e").cast("date"), F.col("d").cast("date")), s=s, e=e, d=d)
    assert at("2024-01-01", "2024-02-01", "2024-02-01") and at("2024-01-01", None, "2030-01-01") and at(None, None, None)
    assert not at("2024-01-01", "2024-02-01", "2024-02-02") and at("2024-01-01", "2024-02-01", None)


def test_decisions_never_go_by_frequency(spark):
    rows = [("P", "S", "uscc", v, c, f"E{i}") for i, (v, c) in enumerate([("a", 0.9)] * 9 + [("b", 0.9)])]
    rows += [("P", "S", "phone", "x", 0.9, "E90"), ("P", "S", "phone", "x", 0.95, "E91"), ("P", "S", "email", "y", 0.5, "E92"), ("P", "S", "address", None, 0.9, "E93"), ("P", "S", "contact_name", "z", 0.85, "E94")]
    h = spark.createDataFrame(rows, "project_id string, supplier_dir string, field string, value string, confidence double, evidence_id string")
    d = decide.decisions(h, ~decide.low_confidence(F.col("confidence")), F.col("value"))
    got = {r.field: (r.status, r.value) for r in d.collect()}
    assert got == {"uscc": ("conflict", None), "phone": ("selected", "x"), "email": ("needs_manual_review", None), "address": ("missing", None), "contact_name": ("selected", "z")}
    assert decide.dense(d).count() == len(decide.CORE_FIELDS)
    assert {r.field for r in decide.gate(h, d).select("field").distinct().collect()} == {"phone", "email", "address", "contact_name"}


def test_ordered(spark):
    df = spark.createDataFrame([("k", 10, 1), ("k", 20, 2), ("k", 20, 3), ("k", 10, 4)], "k string, v int, o int")
    assert ordered.modal(df, ["k"], "v", "o").first().v == 10
    lines = spark.createDataFrame([("d", i, t) for i, t in enumerate(["报价 1.00", "合计", "x", "1,234.50 元", "9"])], "d string, p int, t string")
    assert ordered.total_after_heading(lines, ["d"], "t", "p").first().total == 1234.5


def test_scanner():
    got = extract.scan_both("投标人：荻岸检测有限公司，联系电话：13812345678，授权代表身份证号码 11010519491231002X。法定代表人：李平斌 邮箱 a@b.example")
    values = {(f, v) for f, v, _ in got}
    assert {("company_name", "荻岸检测有限公司"), ("phone", "13812345678"), ("bid_agent_id", "11010519491231002X"), ("legal_rep_name", "李平斌"), ("email", "a@b.example")} <= values
    assert not any(f == "uscc" for f, _ in values)
    assert extract.scan(None) == [] and extract.scan("") == []
    # names: roles, cuts, stop words; the first of overlapping spans; one credit code that is no identity number
    got = extract.scan("法人代表张三丰授权李四为全权代表。联系人：开标 经办人 王五（身份证），股东：赵六。法定代表人签字")
    assert {(f, v) for f, v, _ in got} == {("legal_rep_name", "张三丰"), ("bid_agent_name", "王五"), ("shareholder_name", "赵六")}
    got = dict((f, v) for f, v, _ in extract.scan("招标人 ： 荻岸中心；项目名称：青岚园区设备采购项目，电话 0571-87654321 项目编号：AB-12"))
    assert got == {"tenderer": "荻岸中心", "project_name": "青岚园区设备采购项目", "phone": "0571-87654321", "project_code": "AB-12"}
    assert extract.scan("x@y z@. 110105194912310021 1380013800 4位有限公司") == []
    assert [extract.coerced(f, v) for f, v in [("contact_name", "王五（经办）"), ("contact_name", "签字"), ("address", " 路1号，"), ("address", "a" * 81), ("phone", "1"), ("tenderer", "荻岸厂"), ("project_name", None)]] == ["王五", None, "路1号", None, None, "荻岸厂", None]
    assert ("contact_name", "王国强") in {(f, v) for f, v, _ in extract.scan_both("联 系 人：王 国 强")}


def test_greedy_clusters():
    names = [("鑫誉环境检测", 1.0), ("鑫誉环检测", 2.0), ("别的公司", 1.0)]
    assert extract.greedy_clusters(names) == [0, 0, 1]
    assert round(difflib.SequenceMatcher(None, names[0][0], names[1][0]).ratio(), 3) == 0.909


def test_spatial_pairs_prefer_the_right_block(spark):
    box = lambda x, y: (x, y, 0.1, 0.02)
    rows = [(1, 1, "联系人：", 0.9, box(0.1, 0.1)), (2, 2, "右边", 0.8, box(0.3, 0.1)), (3, 3, "下面", 0.9, box(0.1, 0.15)), (4, 4, None, 0.9, box(0.2, 0.1)), (5, 5, "没框", 0.9, None), (6, 6, "法人", 0.9, box(0.1, 0.5)), (7, 7, "只有下面", 0.7, box(0.12, 0.55))]
    b = spark.createDataFrame([("d", 1, *r) for r in rows], "document_id string, page int, block_id int, block_no int, text string, confidence double, bbox struct<x: double, y: double, width: double, height: double>")
    labels = spark.createDataFrame([("联系人", "contact_name"), ("法人", "legal_rep_name")], "label string, field string")
    got = {r.field: (r.value, r.confidence) for r in layout.spatial_pairs(b, labels, ["document_id", "page"]).collect()}
    assert got == {"contact_name": ("右边", 0.8), "legal_rep_name": ("只有下面", 0.7)}


def test_cells(spark):
    c = spark.createDataFrame([("s", 1, 1, "联系人："), ("s", 1, 2, " "), ("s", 1, 3, "王国强"), ("s", 2, 1, "法人"), ("s", 3, 1, "李平")], "sheet string, row int, col int, text string")
    labels = spark.createDataFrame([("联系人", "contact_name"), ("法人", "legal_rep_name")], "label string, field string")
    assert {r.field: r.value for r in layout.cell_values(c, labels).collect()} == {"contact_name": "王国强", "legal_rep_name": "李平"}


def docx(paragraph):
    out = io.BytesIO()
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:p><w:r><w:t>{paragraph}</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>")
        z.writestr("docProps/core.xml", "<c xmlns:d='u'><d:creator>me</d:creator></c>")
    return out.getvalue()


def xlsx():
    out = io.BytesIO()
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {s}><sheets><sheet name="S1"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {s}><si><t>shared</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {s}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1"><v>42</v></c><c r="C1"/></row></sheetData></worksheet>')
    return out.getvalue()


def test_project_tree(spark, tmp_path):
    for path, data in {"bids/A/a.docx": docx("正文"), "bids/A/b.xlsx": xlsx(), "bids/inbox/c.docx": b"PK\x03\x04broken", "bids/d.txt": "文本".encode(), "bids/A/e.docx": b"", "bids/.hidden/f.txt": b"x", "procurement/g.pdf": b"%PDF-1.4"}.items():
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    tree = files.project_tree(spark, str(tmp_path)).cache()
    got = {r.relative_path: (r.supplier_dir, r.kind) for r in tree.select("relative_path", "supplier_dir", files.media_type(F.col("content"), F.col("relative_path")).alias("kind")).collect()}
    assert got == {"bids/A/a.docx": ("A", "docx"), "bids/A/b.xlsx": ("A", "xlsx"), "bids/inbox/c.docx": (None, "docx"), "bids/d.txt": (None, "text"), "procurement/g.pdf": (None, "pdf")}
    units = {(r.relative_path, r.status.split(":")[0], r.kind, r.place, r.text) for r in files.office_units(tree).collect()}
    assert {("bids/A/a.docx", "ok", "paragraph", "0", "正文"), ("bids/A/a.docx", "ok", "cell", "0", "cell"), ("bids/A/a.docx", "ok", "prop:creator", "0", "me"), ("bids/A/b.xlsx", "ok", "S1", "A1", "shared"), ("bids/A/b.xlsx", "ok", "S1", "B1", "42"), ("bids/inbox/c.docx", "corrupt", None, None, None)} == units
    # Spark's binary scan gives no row for a file without bytes; rows without content from elsewhere keep their status
    bare = spark.createDataFrame([("x.docx", b""), ("y.docx", None)], "relative_path string, content binary")
    assert {r.status for r in files.office_units(bare).collect()} == {"empty"}
    assert files.text_files(tree).first().text == "文本"


def test_imports(spark, tmp_path):
    (tmp_path / "x.csv").write_text("﻿record_kind,uscc,extra,note\npenalty,91,v,\n", encoding="utf-8")
    r = files.external_csv(spark, str(tmp_path / "x.csv")).first()
    assert (r.record_kind, r.uscc, r.fields, r.subject_name) == ("penalty", "91", {"extra": "v"}, None)
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        files.external_csv(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "j").mkdir()
    (tmp_path / "j/q.json").write_text(json.dumps({"channel": "c", "records": [{"record_kind": "k", "fields": {"a": "b"}}], "ownership": [{"from_party_name": "p"}]}))
    q, rec, own = files.external_json(spark, str(tmp_path / "j"))
    assert q.first().record_count == 1 and rec.first().fields == {"a": "b"} and own.first().from_party_name == "p"


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.createDataFrame([(1, 10, "2024-01-01 00:01:00"), (1, 20, "2024-01-01 00:02:00"), (2, 5, "2024-01-01 00:15:00")], "k int, v int, t string").withColumn("t", F.to_timestamp("t"))
    rows.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    upserts.upsert_stream(stream, str(tmp_path / "table"), "k", "v", str(tmp_path / "ck")).awaitTermination()
    assert {r.k: r.v for r in upserts.current(spark, str(tmp_path / "table"), 0).collect()} == {1: 20, 2: 5}
    spark.createDataFrame([(2, 9, "2024-01-01 00:20:00")], "k int, v int, t string").withColumn("t", F.to_timestamp("t")).coalesce(1).write.mode("append").parquet(src)
    upserts.upsert_stream(stream, str(tmp_path / "table"), "k", "v", str(tmp_path / "ck")).awaitTermination()
    assert {r.k: r.v for r in upserts.current(spark, str(tmp_path / "table"), 1).drop("generation").collect()} == {1: 20, 2: 9}
    q = upserts.windowed_counts(stream, "t", "k").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(str(r.start)[11:16], r.k): r.n for r in spark.table("counts").collect()} == {("00:00", 1): 2, ("00:10", 2): 1, ("00:20", 2): 1}


def test_total_by_the_first_window_with_any_amount(spark):
    texts = {
        "whole": ["合计 12000元"],
        "first": ["合计", "8元", "", "", "", "Total 5.50"],
        "money": ["合计 3 项", "1,200,000 元", "第 7 页"],
        "none": ["合计 3 项", "", "", "", "", "Total 5.50"],
        "exact": ["合计 3 项", "12.5 万元", "100元"],
        "empty": ["合计"],
    }
    lines = spark.createDataFrame([(k, i, t) for k, ts in texts.items() for i, t in enumerate(ts)], "d string, p int, t string")
    got = {r.d: r.total for r in ordered.total_after_heading(lines, ["d"], "t", "p").collect()}
    assert got == {"whole": 12000.0, "first": 8.0, "money": 1200000.0, "none": None, "exact": 12.5}


def test_totals_of_documents(spark, tmp_path):
    from sieveline.plans import catalog

    spark.createDataFrame([(1, 1, "合计 7元", 1)], "job_id bigint, block_no int, text string, block_id bigint").write.parquet(f"{tmp_path}/ocr_blocks.parquet")
    spark.createDataFrame([(5, "甲\n合计\n\n12000元"), (6, "无"), (7, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.job_id, r.doc_id, r.total) for r in catalog.QUERIES["total_after_heading"](spark, str(tmp_path)).collect()}
    assert got == {(1, None, 7.0), (None, 5, 12000.0)}


def test_anchor_match_against_all_pairs(spark, tmp_path):
    from difflib import SequenceMatcher
    from itertools import product

    from sieveline.plans import catalog

    names = ["".join(p) for n in (1, 2, 3, 4) for p in product("abx", repeat=n)]
    anchors = ["ab", "axb", "abxa"]
    spark.createDataFrame([("P", a) for a in anchors], "project_id string, name string").write.parquet(f"{tmp_path}/subject_results.parquet")
    spark.createDataFrame([("P", "company_name", n) for n in names], "project_id string, field string, value string").write.parquet(f"{tmp_path}/field_hits.parquet")
    got = {r.name: r.n for r in catalog.QUERIES["anchor_match"](spark, str(tmp_path)).collect()}
    near = {n: sum(SequenceMatcher(None, n, a, autojunk=False).ratio() >= 0.8 for a in anchors) for n in names}
    assert got == {n: k for n, k in near.items() if k}


def test_intermediate_tables_need_a_shared_folder():
    from types import SimpleNamespace as N

    from sieveline.runtime import shared_folder

    def spark(master, folder=""):
        sc = N(master=master, getCheckpointDir=lambda: None, getConf=lambda: N(get=lambda k, d: folder or d))
        return N(sparkContext=sc, conf=N(get=lambda k, d: d))

    assert shared_folder(spark("yarn", "hdfs:///x")) == "hdfs:///x" and shared_folder(spark("local[4]"))
    for master in ("yarn", "spark://h:1", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError):
            shared_folder(spark(master))
