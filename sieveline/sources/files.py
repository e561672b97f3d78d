"""Scans of project trees: paths to parties, media types by content, Office files, tables of imports.

Binary files are read by Spark's binaryFile source; what a parser needs runs in Arrow batches and never fails a task: a file
that cannot be read gives a row with its status. Files and columns are filtered before their content is read.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Directories below bids/ that stand for no party (fixed values).
INBOXES = ("inbox", "incoming", "uploads")


def project_tree(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(relative_path, supplier_dir, category, length, modified, content) of all files below a root, without hidden ones.

    Files without any byte give no row: Spark's binary scan has no split for them.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    rel = F.regexp_replace(F.col("path"), "^.*?" + re.escape(root.rstrip("/")) + "/", "")
    df = raw.withColumn("relative_path", rel).where(~F.col("relative_path").rlike(r"(^|/)(\.|__pycache__)"))
    return df.select("relative_path", party("relative_path").alias("supplier_dir"), F.split("relative_path", "/")[0].alias("category"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), "content")


def party(path: str) -> Column:
    """The directory right below bids/, unless it is an inbox or the file lies there directly."""
    parts = F.split(F.col(path), "/")
    return F.when((parts[0] == "bids") & (F.size(parts) > 2) & ~parts[1].isin(*INBOXES), parts[1])


def media_type(content: Column, path: Column) -> Column:
    """Type by the first bytes; packed Office files by their extension."""
    head, low = F.hex(F.substring(content, 1, 8)), F.lower(path)
    return (
        F.when(head.startswith("25504446"), "pdf")
        .when(head.startswith("504B0304") & low.endswith(".docx"), "docx")
        .when(head.startswith("504B0304") & low.endswith(".xlsx"), "xlsx")
        .when(head.startswith("504B0304"), "zip")
        .when(head.startswith("89504E47"), "png")
        .when(head.startswith("FFD8FF"), "jpeg")
        .when(head.startswith("D0CF11E0"), "ole")
        .when(low.rlike(r"\.html?$"), "html")
        .when(low.rlike(r"\.json$"), "json")
        .when(low.rlike(r"\.csv$"), "csv")
        .when(low.rlike(r"\.(txt|md)$"), "text")
        .otherwise("unknown")
    )


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def docx_units(data: bytes) -> list[tuple[str, int, str]]:
    """(kind, index, text) of paragraphs, table cells, headers and footers, and all properties as (prop:name, 0, value)."""
    out: list[tuple[str, int, str]] = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
        inside = {p for t in body.iter(f"{_W}tbl") for p in t.iter(f"{_W}p")}
        for kind, nodes in (("paragraph", [p for p in body.iter(f"{_W}p") if p not in inside]), ("cell", list(body.iter(f"{_W}tc")))):
            for i, node in enumerate(nodes):
                text = "".join(t.text or "" for t in node.iter(f"{_W}t"))
                if text.strip():
                    out.append((kind, i, text))
        for kind in ("header", "footer"):
            for i, name in enumerate(sorted(n for n in z.namelist() if re.fullmatch(rf"word/{kind}\d*\.xml", n))):
                text = "".join(t.text or "" for t in ElementTree.fromstring(z.read(name)).iter(f"{_W}t"))
                if text.strip():
                    out.append((kind, i, text))
        if "docProps/custom.xml" in z.namelist():
            for e in ElementTree.fromstring(z.read("docProps/custom.xml")):
                text = "".join(e.itertext()).strip()
                if text:
                    out.append((f"prop:{e.get('name')}", 0, text))
        for name in ("docProps/core.xml", "docProps/app.xml"):
            if name in z.namelist():
                for e in ElementTree.fromstring(z.read(name)):
                    if e.text and e.text.strip():
                        out.append((f"prop:{e.tag.rpartition('}')[2]}", 0, e.text.strip()))
    return out


def xlsx_cells(data: bytes) -> list[tuple[str, str, str]]:
    """(sheet, coordinate, text) of the cells that are not empty."""
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_S}si")]
        rels = "xl/_rels/workbook.xml.rels"
        parts = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read(rels))} if rels in z.namelist() else {}
        sheets = [(s.get("name"), s.get(_REL)) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet")]
        for k, (name, rel) in enumerate(sheets):
            part = parts.get(rel) or f"worksheets/sheet{k + 1}.xml"  # without relations sheets stand in order
            for c in ElementTree.fromstring(z.read(part[1:] if part.startswith("/") else f"xl/{part}")).iter(f"{_S}c"):
                v = c.find(f"{_S}v")
                text = "".join(t.text or "" for t in c.iter(f"{_S}t")) if c.get("t") == "inlineStr" else "" if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text or ""
                if text.strip():
                    out.append((name, c.get("r"), text))
    return out


def office_units(files: DataFrame) -> DataFrame:
    """(relative_path, status, kind, place, text) of DOCX and XLSX files; a file that cannot be read gives one row with its status."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, data in zip(pdf["relative_path"], pdf["content"]):
                try:
                    if not data:
                        rows.append((path, "empty", None, None, None))
                    elif path.lower().endswith(".xlsx"):
                        rows += [(path, "ok", s, r, t) for s, r, t in xlsx_cells(bytes(data))]
                    else:
                        rows += [(path, "ok", k, str(i), t) for k, i, t in docx_units(bytes(data))]
                except Exception as e:  # one bad file is a row, not a failed job
                    rows.append((path, f"corrupt: {type(e).__name__}", None, None, None))
            yield pd.DataFrame(rows, columns=["relative_path", "status", "kind", "place", "text"])

    wanted = files.where(F.lower("relative_path").rlike(r"\.(docx|xlsx)$")).select("relative_path", "content")
    return wanted.mapInPandas(run, "relative_path string, status string, kind string, place string, text string")


def text_files(files: DataFrame) -> DataFrame:
    return files.where(F.lower("relative_path").rlike(r"\.(txt|md|html?)$")).select("relative_path", F.decode("content", "UTF-8").alias("text"))


#: Columns of an external table that are not folded into the map (fixed values).
IMPORT_COLUMNS = ("record_kind", "uscc", "subject_name", "queried_at", "effective_from", "effective_to")


def external_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a CSV of records: the known columns, and all others that are not empty folded into ``fields``."""
    df = spark.read.option("header", "true").option("encoding", "UTF-8").csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    if "record_kind" not in df.columns:
        raise ValueError("the column record_kind is missing")
    others = [c for c in df.columns if c not in IMPORT_COLUMNS]
    pairs = F.map_from_arrays(F.array(*[F.lit(c) for c in others]), F.array(*[F.col(f"`{c}`") for c in others])) if others else F.create_map().cast("map<string,string>")
    known = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in IMPORT_COLUMNS]
    return df.select(*known, F.map_filter(pairs, lambda k, v: v.isNotNull() & (F.trim(v) != "")).alias("fields"))


RECORD_JSON = "records array<struct<record_kind: string, subject_uscc: string, fields: map<string,string>, effective_from: string, effective_to: string>>"
EXTERNAL_JSON = f"channel string, uscc string, supplier_name string, queried_at string, query_mode string, status string, {RECORD_JSON}, ownership array<struct<from_party_name: string, to_company_name: string, to_company_uscc: string, share_ratio: string>>"


def external_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queries, records, ownership) of a directory of JSON imports, each file one object."""
    df = spark.read.schema(EXTERNAL_JSON).option("multiLine", "true").json(path).withColumn("file", F.col("_metadata.file_name"))
    queries = df.select("file", "channel", "uscc", "supplier_name", "queried_at", "query_mode", "status", F.coalesce(F.size("records"), F.lit(0)).alias("record_count"))
    records = df.select("file", F.posexplode("records").alias("ord", "r")).select("file", "ord", "r.*")
    ownership = df.select("file", F.posexplode("ownership").alias("ord", "o")).select("file", "ord", "o.*")
    return queries, records, ownership
