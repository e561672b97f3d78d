"""Imports of external evidence: files by their kind, recognised texts under a contract, pages and JSON of an injected transport.

No import opens a connection: HTTP and API sources take the rows that a transport has fetched (request, status, body).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.operators import ordered
from sieveline.sources import files

#: Kinds of import files by their ending (fixed values).
KINDS = {"json": "json", "csv": "csv", "png": "snapshot", "jpg": "snapshot", "jpeg": "snapshot", "pdf": "snapshot", "html": "snapshot", "htm": "snapshot"}


def dispatched(spark: SparkSession, root: str) -> DataFrame:
    """(path, size_bytes, kind) of all files below a directory; others than known kinds are 'unsupported', meta files 'meta'."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size_bytes"))
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    return raw.select("path", "size_bytes", F.when(F.lower("path").endswith(".meta.json"), "meta").otherwise(F.coalesce(F.element_at(kinds, suffix), F.lit("unsupported"))).alias("kind"))


def grouped_queries(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queries, records) of rows of :func:`files.external_csv`: one query a (uscc, subject_name), with its records."""
    keys = [F.coalesce("uscc", F.lit("")).alias("uscc"), F.coalesce("subject_name", F.lit("")).alias("subject_name")]
    r = rows.select(*keys, "record_kind", "queried_at", "effective_from", "effective_to", "fields")
    r = r.withColumn("query_id", text.stable_id("Q-", uscc=F.col("uscc"), name=F.col("subject_name")))
    queries = r.groupBy("query_id", "uscc", "subject_name").agg(F.count("*").alias("record_count"), F.max("queried_at").alias("queried_at"))
    return queries, r.select("query_id", "record_kind", "effective_from", "effective_to", "fields")


def json_queries(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queries, records, ownership) of JSON files that hold one object, or a bare list of records."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"^\x{feff}", "").alias("value"), F.col("_metadata.file_name").alias("file"))
    body = F.when(F.col("value").rlike(r"^\s*\["), F.concat(F.lit('{"records":'), "value", F.lit("}"))).otherwise(F.col("value"))
    j = raw.select("file", F.from_json(body, files.EXTERNAL_JSON).alias("j")).select("file", "j.*")
    queries = j.select("file", "channel", "uscc", "supplier_name", "queried_at", "query_mode", F.coalesce("status", F.when(F.col("records").isNull() & F.col("ownership").isNull(), "failed").otherwise("ok")).alias("status"), F.coalesce(F.size("records"), F.lit(0)).alias("record_count"))
    records = j.select("file", F.posexplode("records").alias("ord", "r")).select("file", "ord", "r.*")
    return queries, records, j.select("file", F.posexplode("ownership").alias("ord", "o")).select("file", "ord", "o.*")


OCR_RESULT = "job_id: string, status: string, engine: string, text: string, confidence: double, completed_at: string, blocks: array<struct<text: string, confidence: double, bbox: struct<x: double, y: double, width: double, height: double>>>"


def ocr_results(spark: SparkSession, path: str) -> DataFrame:
    """Results in JSON files that hold one result, a list, or an object with a list under ``results``."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"^\x{feff}", "").alias("v"))
    listed = F.when(F.col("v").rlike(r"^\s*\["), F.from_json("v", f"array<struct<{OCR_RESULT}>>"))
    inner = F.from_json("v", f"results array<struct<{OCR_RESULT}>>")["results"]
    one = F.array(F.from_json("v", f"struct<{OCR_RESULT}>"))
    return raw.select(F.explode(F.coalesce(listed, inner, one)).alias("r")).select("r.*")


def ocr_errors(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Results with their contract errors and whether the delivery is taken: one error anywhere rejects all of it."""
    from sieveline.operators import assemble

    known = jobs.select("job_id", F.lit(True).alias("known")).distinct()
    r = results.join(known, "job_id", "left")
    box = F.forall(F.coalesce("blocks", F.array().cast(results.schema["blocks"].dataType)), lambda b: b["bbox"].isNull() | (b["bbox"]["x"].between(0, 1) & b["bbox"]["y"].between(0, 1)))
    checks = {"job": F.col("known"), "status": F.col("status").isin("ok", "failed"), "text": (F.col("status") == "failed") | F.col("text").isNotNull(), "confidence": F.col("confidence").isNull() | F.col("confidence").between(0, 1), "bbox": box}
    return assemble.all_or_nothing(r, checks).drop("known")


def ocr_upsert(old: DataFrame, checked: DataFrame) -> DataFrame:
    """The stored results after a delivery: unchanged if it was rejected, else its rows replace those of the same job."""
    new = checked.where("accepted").select(*old.columns)
    return ordered.upsert(old, new, "job_id")


def page_status(status: Column, body: Column, rows: Column) -> Column:
    """State of a fetched page: captcha, login, rate_limited, failed, no_results or ok."""
    low = F.lower(F.coalesce(body, F.lit("")))
    return (
        F.when(status == 429, "rate_limited")
        .when(status.isin(401, 403), "login_required")
        .when(status.isNull() | (status >= 400), "failed")
        .when(low.contains("captcha") | low.contains("验证码"), "captcha_required")
        .when(F.size(rows) == 0, "no_results")
        .otherwise("ok")
    )


def http_rows(fetched: DataFrame, names: list[str]) -> DataFrame:
    """(request_id, page, state, ord, fields): rows of the HTML tables of fetched pages (request_id, page, status, body), cells by
    position under ``names``, empty ones left out. A page without rows keeps its state in one row without fields."""
    rows = F.coalesce(text.table_rows(F.col("body")), F.array().cast("array<array<string>>"))
    t = fetched.select("request_id", "page", page_status(F.col("status"), F.col("body"), rows).alias("state"), rows.alias("rows"))
    e = t.select("request_id", "page", "state", F.posexplode_outer(F.when(F.col("state") == "ok", F.col("rows"))).alias("ord", "cells"))
    keys = F.array(*map(F.lit, names))
    n = F.least(F.size("cells"), F.lit(len(names)))
    fields = F.map_filter(F.map_from_arrays(F.slice(keys, F.lit(1), n), F.slice("cells", F.lit(1), n)), lambda k, v: F.trim(v) != "")
    return e.select("request_id", "page", "state", "ord", F.when(F.col("cells").isNotNull(), fields).alias("fields"))


def api_rows(fetched: DataFrame, path: str, names: dict[str, str]) -> DataFrame:
    """(request_id, ord, fields): the list at a dotted path of fetched JSON bodies, mapped to names by dotted paths."""
    items = F.from_json(text.json_path(F.col("body"), path), "array<string>")
    e = fetched.select("request_id", F.posexplode(items).alias("ord", "item"))
    pairs = F.create_map(*[x for name, p in names.items() for x in (F.lit(name), text.json_path(F.col("item"), p))])
    return e.select("request_id", "ord", F.map_filter(pairs, lambda k, v: v.isNotNull() & (v != "")).alias("fields"))


def confirmations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(assignments, conflicts) of a JSON file of manual confirmations; entries without document or supplier are left to conflicts."""
    raw = spark.read.schema("assignments array<struct<document_id: string, supplier: string>>, conflicts array<struct<document_id: string, reason: string>>").option("multiLine", "true").json(path)
    a = raw.select(F.explode("assignments").alias("a")).select("a.*")
    bad = F.coalesce(F.trim("document_id"), F.lit("")) == ""
    lost = a.where(bad | (F.coalesce(F.trim("supplier"), F.lit("")) == "")).select("document_id", F.lit("incomplete").alias("reason"))
    return a.exceptAll(a.join(lost.select("document_id").distinct(), "document_id", "left_semi")).where(~bad), raw.select(F.explode("conflicts").alias("c")).select("c.*").unionByName(lost)


def missing_roots(spark: SparkSession, root: str, wanted: tuple[str, ...] = ("bids", "procurement", "external-evidence")) -> DataFrame:
    """(anomaly, detail): the wanted directories that do not lie below a root, looked up in the file system of the root."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda *p: jvm.org.apache.hadoop.fs.Path("/".join(p))
    fs = path(root).getFileSystem(conf)
    return spark.createDataFrame([("missing_directory", w) for w in wanted if not fs.exists(path(root, w))], "anomaly string, detail string")
