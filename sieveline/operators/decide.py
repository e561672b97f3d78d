"""Single values out of many hits: eligibility, candidate lists, decisions that never go by frequency, and the gate on conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields that are single-valued for a party (fixed values).
CORE_FIELDS = ("company_name", "uscc", "legal_rep_name", "legal_rep_id", "bid_agent_name", "contact_name")
LOW_CONFIDENCE = 0.85


def low_confidence(confidence: Column) -> Column:
    """Strictly below the threshold: a value at 0.85 stays eligible."""
    return confidence < LOW_CONFIDENCE


def traceable(path: Column, page: Column, bbox: Column, method: Column) -> Column:
    """Page of a PDF or image, any box, or a cell of a table."""
    return (F.lower(path).rlike(r"\.(pdf|png|jpe?g|tiff?)$") & (page >= 1)) | bbox.isNotNull() | (method == "table")


def decisions(hits: DataFrame, eligible: Column, value: Column) -> DataFrame:
    """(project_id, supplier_dir, field, status, value, n_values, evidence_ids, candidates) of hits.

    missing: no value; conflict: more than one distinct eligible value; needs_manual_review: values but none eligible; selected:
    the value of the most certain hit, of equally certain ones that with the largest evidence id. Sums only, no ordering of a
    whole group.
    """
    h = hits.withColumn("__v", value).withColumn("__e", eligible & F.col("__v").isNotNull())
    good = F.when(F.col("__e"), F.col("__v"))
    agg = h.groupBy("project_id", "supplier_dir", "field").agg(
        F.count_distinct(good).alias("n_values"),
        F.count("__v").alias("n_seen"),
        F.max_by(good, F.when(F.col("__e"), F.struct("confidence", "evidence_id"))).alias("best"),
        F.array_sort(F.collect_set(F.when(F.col("__e"), F.col("evidence_id")))).alias("evidence_ids"),
        F.array_sort(F.collect_set("__v")).alias("candidates"),
    )
    status = F.when(F.col("n_seen") == 0, "missing").when(F.col("n_values") > 1, "conflict").when(F.col("n_values") == 0, "needs_manual_review").otherwise("selected")
    return agg.withColumn("status", status).withColumn("value", F.when(F.col("status") == "selected", F.col("best"))).drop("best", "n_seen")


def dense(decided: DataFrame, fields: tuple[str, ...] = CORE_FIELDS) -> DataFrame:
    """A decision for every party and field: absent ones are missing. The fields are a list of fixed length."""
    parties = decided.select("project_id", "supplier_dir").distinct()
    every = parties.select("project_id", "supplier_dir", F.explode(F.array(*map(F.lit, fields))).alias("field"))
    return every.join(decided, ["project_id", "supplier_dir", "field"], "left").withColumn("status", F.coalesce("status", F.lit("missing")))


def gate(hits: DataFrame, decided: DataFrame) -> DataFrame:
    """Hits of single-valued fields stay only where their decision was selected."""
    ok = decided.where("status = 'selected'").select("project_id", "supplier_dir", "field")
    core = F.col("field").isin(*CORE_FIELDS)
    return hits.where(~core).unionByName(hits.where(core).join(ok, ["project_id", "supplier_dir", "field"], "left_semi"))
