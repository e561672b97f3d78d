"""The queries of the training-data operators, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import addresses, encode, leaks, linkage, lookalikes, names, privacy, sentences
from sieveline.runtime import spread, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "field_hits").select("project_id", "supplier_dir", "field", "value")
    return names.found(hits, table(spark, sf_dir, "field_decisions"), table(spark, sf_dir, "subject_results"))


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "query_subjects").select("subject_id", "name", "uscc", "legal_rep_name", "phone", "address"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.found(_subjects(spark, sf_dir), spread(table(spark, sf_dir, "adapter_records").select("record_id", "fields")))


def p2_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = linkage.linked(_subjects(spark, sf_dir), spread(table(spark, sf_dir, "adapter_records").select("record_id", "fields")))
    return linked.select("subject_id", "record_id", F.round("confidence", 4).alias("confidence"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.found(spread(table(spark, sf_dir, "field_hits").where("field = 'address'").select("hit_id", "project_id", "field", "value")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.found(spread(table(spark, sf_dir, "field_hits").select("hit_id", "field", "value", "label")))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(privacy.texts(table(spark, sf_dir, "ocr_blocks"), table(spark, sf_dir, "parsed_pdfs")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.found(_texts(spark, sf_dir))


def p5_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.redacted(_texts(spark, sf_dir))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return leaks.leaks(docs, table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.sentences(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": p1_found, "p2_found": p2_found, "p2_confidence": p2_confidence, "p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p5_redacted": p5_redacted, "p7_ids": p7_ids, "p8_found": p8_found, "p9_found": p9_found}

ORACLE: dict[str, str] = {}
