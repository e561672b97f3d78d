"""Queries on relations: matches between parties, decisions, upserts, coverage, layout, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.operators import decide, layout, match, ordered
from sieveline.plans.registry import query
from sieveline.plans.values import wide
from sieveline.runtime import table

_US = "epoch_us({})"


def _us(c):
    return F.unix_micros(F.col(c).cast("timestamp"))


# joins


@query(
    """WITH f AS (SELECT sha256(text) AS fp, source, min(doc_id) AS doc FROM documents WHERE text IS NOT NULL AND source IS NOT NULL GROUP BY ALL)
    SELECT a.source AS party_a, b.source AS party_b, count(*) AS n_shared, 'META-002' AS rule_id, 'I' AS level, 'FD-' || left(sha256('{"party_a":"' || a.source || '","party_b":"' || b.source || '","rule":"META-002"}'), 12) AS finding_id
    FROM f a JOIN f b USING (fp) WHERE a.source < b.source GROUP BY a.source, b.source"""
)
def shared_fingerprint_pairs(spark, d):
    """Parties whose documents share a text: copies are summed to one row a (fingerprint, party) before the self-join."""
    f = table(spark, d, "documents").where("text IS NOT NULL AND source IS NOT NULL").select(F.sha2(F.col("text"), 256).alias("fp"), "source", "doc_id")
    pairs = match.cross_match(f, "source", ["fp"], "doc_id").groupBy("party_a", "party_b").agg(F.count("*").alias("n_shared"))
    ident = text.stable_id("FD-", rule=F.lit("META-002"), party_a=F.col("party_a"), party_b=F.col("party_b"))
    return pairs.select("party_a", "party_b", "n_shared", F.lit("META-002").alias("rule_id"), F.lit("I").alias("level"), ident.alias("finding_id"))


_ELIGIBLE = "confidence >= 0.85 AND value IS NOT NULL AND supplier_dir IS NOT NULL"


@query(
    f"""WITH v AS (SELECT project_id, field, {wide('value')} AS value, supplier_dir, list_sort(list(DISTINCT evidence_id)) AS ids FROM field_hits WHERE {_ELIGIBLE} AND field IN ('uscc', 'phone', 'email', 'legal_rep_id', 'address', 'company_name', 'tenderer', 'contact_name') GROUP BY ALL)
    SELECT a.project_id, a.field, a.value, a.supplier_dir AS party_a, b.supplier_dir AS party_b, array_to_string(list_sort(list_distinct(list_concat(a.ids, b.ids))), ',') AS evidence
    FROM v a JOIN v b USING (project_id, field, value) WHERE a.supplier_dir < b.supplier_dir"""
)
def exact_matches(spark, d):
    h = table(spark, d, "field_hits").where(_ELIGIBLE).where(F.col("field").isin("uscc", "phone", "email", "legal_rep_id", "address", "company_name", "tenderer", "contact_name")).withColumn("value", text.half_width(F.col("value")))
    m = match.cross_match(h, "supplier_dir", ["project_id", "field", "value"], "evidence_id")
    return m.select("project_id", "field", "value", "party_a", "party_b", F.array_join("evidence_ids", ",").alias("evidence"))


@query()
def similar_company_names(spark, d):
    s = table(spark, d, "subject_results").where("name IS NOT NULL").select("project_id", text.search_key(F.col("name")).alias("key"))
    return match.similar_names(s, "project_id", "key")


@query(
    """WITH f AS (SELECT user_id, event_type, min(epoch_us(ts)) AS t FROM events GROUP BY ALL)
    SELECT a.user_id AS user_a, b.user_id AS user_b, a.event_type AS event_type, abs(a.t - b.t) AS gap_us FROM f a JOIN f b ON a.event_type = b.event_type AND a.user_id < b.user_id AND abs(a.t - b.t) <= 1800000000"""
)
def created_within_30min(spark, d):
    f = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min(_us("ts")).alias("t"))
    a, b = f.select(F.col("user_id").alias("user_a"), "event_type", F.col("t").alias("ta")), f.select(F.col("user_id").alias("user_b"), "event_type", F.col("t").alias("tb"))
    j = match.band_join(a, b, ["event_type"], "ta", "tb", 1_800_000_000).where("user_a < user_b")
    return j.select("user_a", "user_b", "event_type", F.abs(F.col("ta") - F.col("tb")).alias("gap_us"))


@query("""WITH e AS (SELECT DISTINCT l_partkey AS o, l_suppkey AS p FROM lineitem WHERE l_partkey % 10 = 0) SELECT a.p AS party_a, b.p AS party_b, count(*) AS n_owners, min(a.o) AS first_owner FROM e a JOIN e b USING (o) WHERE a.p < b.p GROUP BY ALL""".replace(" WHERE l_partkey % 10 = 0", ""))
def common_owner_pairs(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_partkey").alias("o"), F.col("l_suppkey").alias("p"))
    return match.common_owner(e, "o", "p")


@query("SELECT o_orderkey, o_orderdate::DATE <= DATE '1996-06-30' AND DATE '1996-06-30' <= o_orderdate::DATE + 90 AS effective FROM orders")
def effective_at_deadline(spark, d):
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select("o_orderkey", match.effective_at(day, F.date_add(day, 90), F.lit("1996-06-30").cast("date")).alias("effective"))


@query(
    """WITH r AS (SELECT record_id, coalesce(fields['统一社会信用代码'], fields['信用代码'], fields['reg_no']) AS uscc, coalesce(fields['企业名称'], fields['当事人'], fields['name']) AS name FROM adapter_records),
    c AS (SELECT uscc, min(subject_id) AS s FROM query_subjects WHERE uscc IS NOT NULL GROUP BY uscc), n AS (SELECT name, min(subject_id) AS s FROM query_subjects WHERE name IS NOT NULL GROUP BY name)
    SELECT record_id, coalesce(c.s, n.s) AS subject_id, CASE WHEN c.s IS NOT NULL THEN 'confirmed' WHEN n.s IS NOT NULL THEN 'candidate' ELSE 'unconfirmed' END AS attribution FROM r LEFT JOIN c ON r.uscc = c.uscc LEFT JOIN n ON r.name = n.name"""
)
def subject_attribution(spark, d):
    get = lambda *k: F.coalesce(*[F.element_at("fields", F.lit(x)) for x in k])
    r = table(spark, d, "adapter_records").select("record_id", get("统一社会信用代码", "信用代码", "reg_no").alias("uscc"), get("企业名称", "当事人", "name").alias("name"))
    return match.attribution(r, table(spark, d, "query_subjects").select("subject_id", "uscc", "name").withColumnRenamed("subject_id", "sid"), "uscc", "name", "sid").select("record_id", "subject_id", "attribution")


@query(
    """WITH q AS (SELECT project_id, record_kind, count(*) AS n FROM (SELECT project_id FROM project_configs GROUP BY project_id) p, (SELECT record_kind FROM adapter_records GROUP BY record_kind) k GROUP BY ALL),
    s AS (SELECT DISTINCT project_id, field, 'match' AS status FROM field_hits WHERE field IN ('uscc', 'phone', 'email'))
    SELECT p.project_id, f.field, coalesce(s.status, 'not_queried') AS status FROM (SELECT DISTINCT project_id FROM project_configs) p CROSS JOIN (SELECT DISTINCT field FROM field_hits) f LEFT JOIN s USING (project_id, field)"""
)
def coverage_matrix(spark, d):
    h = table(spark, d, "field_hits")
    q = h.where(F.col("field").isin("uscc", "phone", "email")).select("project_id", "field").distinct().withColumn("status", F.lit("match"))
    return match.coverage(table(spark, d, "project_configs"), h.select("field"), q, "project_id", "field", "status")


@query("""WITH m AS (SELECT p.project_id, f.field, h.field IS NULL AS gap FROM (SELECT DISTINCT project_id FROM project_configs) p CROSS JOIN (SELECT DISTINCT field FROM field_hits) f LEFT JOIN (SELECT DISTINCT project_id, field FROM field_hits WHERE value IS NOT NULL) h USING (project_id, field))
SELECT project_id, count(*) AS n_gaps, array_to_string(list_sort(list(field)), ',') AS gaps FROM m WHERE gap GROUP BY project_id""")
def coverage_gaps(spark, d):
    h = table(spark, d, "field_hits")
    q = h.where("value IS NOT NULL").select("project_id", "field").distinct().withColumn("status", F.lit("match"))
    m = match.coverage(table(spark, d, "project_configs"), h.select("field"), q, "project_id", "field", "status").where("status <> 'match'")
    return m.groupBy("project_id").agg(F.count("*").alias("n_gaps"), F.array_join(F.array_sort(F.collect_list("field")), ",").alias("gaps"))


@query("SELECT DISTINCT o.job_id FROM ocr_blocks o WHERE EXISTS (SELECT 1 FROM parsed_pdfs p WHERE p.document_id = o.document_id)")
def active_results_semi(spark, d):
    return table(spark, d, "ocr_blocks").join(table(spark, d, "parsed_pdfs"), "document_id", "left_semi").select("job_id").distinct()


@query("""SELECT pdf_id, page FROM (SELECT pdf_id, document_id, p.page AS page, p.text AS text FROM (SELECT pdf_id, document_id, unnest(pages) AS p FROM parsed_pdfs)) x WHERE coalesce(trim(text), '') = '' AND NOT EXISTS (SELECT 1 FROM ocr_blocks o WHERE o.document_id = x.document_id AND o.page = x.page)""")
def pending_pages_anti(spark, d):
    p = table(spark, d, "parsed_pdfs").select("pdf_id", "document_id", F.explode("pages").alias("p")).select("pdf_id", "document_id", "p.page", "p.text")
    return p.where(F.coalesce(F.trim("text"), F.lit("")) == "").join(table(spark, d, "ocr_blocks").select("document_id", "page"), ["document_id", "page"], "left_anti").select("pdf_id", "page")


@query("""WITH j AS (SELECT document_id, count(*) AS blocks, count(text) AS read FROM ocr_blocks GROUP BY 1) SELECT p.pdf_id, CASE WHEN j.blocks IS NULL THEN 'pending' WHEN j.read = j.blocks THEN 'succeeded' ELSE 'partial' END AS status, coalesce(j.blocks, 0) AS blocks FROM parsed_pdfs p LEFT JOIN j USING (document_id)""")
def ocr_completion(spark, d):
    j = table(spark, d, "ocr_blocks").groupBy("document_id").agg(F.count("*").alias("blocks"), F.count("text").alias("read"))
    status = F.when(F.col("blocks").isNull(), "pending").when(F.col("read") == F.col("blocks"), "succeeded").otherwise("partial")
    return table(spark, d, "parsed_pdfs").select("pdf_id", "document_id").join(j, "document_id", "left").select("pdf_id", status.alias("status"), F.coalesce("blocks", F.lit(0)).alias("blocks"))


@query("""SELECT pdf_id, page, CASE WHEN length(o.t) > coalesce(length(x.text), 0) THEN o.t ELSE x.text END AS text FROM (SELECT pdf_id, document_id, p.page AS page, p.text AS text FROM (SELECT pdf_id, document_id, unnest(pages) AS p FROM parsed_pdfs)) x
LEFT JOIN (SELECT document_id, page, string_agg(text, chr(10) ORDER BY block_no, block_id) AS t FROM ocr_blocks WHERE text IS NOT NULL GROUP BY 1, 2) o USING (document_id, page)""")
def page_text_or_ocr(spark, d):
    """The text of each page, replaced by the recognised text where that is longer."""
    p = table(spark, d, "parsed_pdfs").select("pdf_id", "document_id", F.explode("pages").alias("p")).select("pdf_id", "document_id", "p.page", "p.text")
    item = F.struct("block_no", "block_id", "text")
    o = table(spark, d, "ocr_blocks").where("text IS NOT NULL").groupBy("document_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda b: b["text"]), "\n").alias("t"))
    longer = F.length("t") > F.coalesce(F.length("text"), F.lit(0))
    return p.join(o, ["document_id", "page"], "left").select("pdf_id", "page", F.when(longer, F.col("t")).otherwise(F.col("text")).alias("text"))


@query("""SELECT d.decision_id, count(DISTINCT h.evidence_id) AS known, coalesce(max(CASE WHEN h.method = 'ocr' THEN 3 WHEN h.method = 'regex' THEN 2 WHEN h.method = 'table' THEN 1 END), 0) AS weakest FROM (SELECT decision_id, unnest(evidence_ids) AS evidence_id FROM field_decisions) x RIGHT JOIN field_decisions d USING (decision_id) LEFT JOIN field_hits h ON h.evidence_id = x.evidence_id GROUP BY d.decision_id""")
def evidence_strength(spark, d):
    """Weakest known evidence of each decision; unknown ids are skipped, none gives 0."""
    dec = table(spark, d, "field_decisions").select("decision_id", F.explode_outer("evidence_ids").alias("evidence_id"))
    rank = F.when(F.col("method") == "ocr", 3).when(F.col("method") == "regex", 2).when(F.col("method") == "table", 1)
    h = table(spark, d, "field_hits").groupBy("evidence_id").agg(F.max(rank).alias("r"))
    return dec.join(h, "evidence_id", "left").groupBy("decision_id").agg(F.count_distinct(F.when(F.col("r").isNotNull(), F.col("evidence_id"))).alias("known"), F.coalesce(F.max("r"), F.lit(0)).alias("weakest"))


@query("""SELECT s.project_id, s.uscc, min(c.name) AS company FROM (SELECT DISTINCT project_id, document_id, value AS uscc FROM field_hits WHERE field = 'uscc' AND value IS NOT NULL) s JOIN (SELECT DISTINCT document_id, value AS name FROM field_hits WHERE field = 'company_name' AND value IS NOT NULL) c USING (document_id) GROUP BY ALL""")
def code_with_company(spark, d):
    h = table(spark, d, "field_hits").where("value IS NOT NULL")
    s = h.where("field = 'uscc'").select("project_id", "document_id", F.col("value").alias("uscc")).distinct()
    c = h.where("field = 'company_name'").groupBy("document_id").agg(F.min("value").alias("name"))
    return s.join(c, "document_id").groupBy("project_id", "uscc").agg(F.min("name").alias("company"))


@query("""WITH c AS (SELECT project_id, name, count(DISTINCT uscc) AS codes, min(uscc) AS uscc FROM subject_results WHERE name IS NOT NULL GROUP BY ALL) SELECT project_id, name, CASE WHEN codes = 1 THEN uscc END AS uscc, codes FROM c""")
def unique_candidate(spark, d):
    c = table(spark, d, "subject_results").where("name IS NOT NULL").groupBy("project_id", "name").agg(F.count_distinct("uscc").alias("codes"), F.min("uscc").alias("u"))
    return c.select("project_id", "name", F.when(F.col("codes") == 1, F.col("u")).alias("uscc"), "codes")


# decisions


_DECIDE = """SELECT project_id, supplier_dir, field, count(DISTINCT CASE WHEN e THEN value END) AS n_values, count(value) AS n_seen, arg_max(CASE WHEN e THEN value END, CASE WHEN e THEN (confidence, evidence_id) END) AS best,
  array_to_string(list_sort(list(DISTINCT evidence_id) FILTER (e)), ',') AS evidence FROM (SELECT *, confidence >= 0.85 AND value IS NOT NULL AS e FROM field_hits WHERE supplier_dir IS NOT NULL) GROUP BY ALL"""
_STATUS = "CASE WHEN n_seen = 0 THEN 'missing' WHEN n_values > 1 THEN 'conflict' WHEN n_values = 0 THEN 'needs_manual_review' ELSE 'selected' END"


def _decided(spark, d):
    h = table(spark, d, "field_hits").where("supplier_dir IS NOT NULL")
    return h, decide.decisions(h, ~decide.low_confidence(F.col("confidence")), F.col("value"))


@query(f"SELECT project_id, supplier_dir, field, {_STATUS} AS status, CASE WHEN {_STATUS} = 'selected' THEN best END AS value, n_values, coalesce(evidence, '') AS evidence FROM ({_DECIDE})")
def single_value_decision(spark, d):
    return _decided(spark, d)[1].select("project_id", "supplier_dir", "field", "status", "value", "n_values", F.array_join("evidence_ids", ",").alias("evidence"))


@query(f"WITH x AS (SELECT project_id, supplier_dir, field, {_STATUS} AS status FROM ({_DECIDE})) SELECT p.project_id, p.supplier_dir, f.field, coalesce(x.status, 'missing') AS status FROM (SELECT DISTINCT project_id, supplier_dir FROM x) p CROSS JOIN (SELECT unnest({list(decide.CORE_FIELDS)}) AS field) f LEFT JOIN x USING (project_id, supplier_dir, field)")
def dense_decisions(spark, d):
    return decide.dense(_decided(spark, d)[1]).select("project_id", "supplier_dir", "field", "status")


@query(f"WITH x AS (SELECT project_id, supplier_dir, field FROM ({_DECIDE}) WHERE {_STATUS} = 'selected') SELECT h.field, count(*) AS n FROM field_hits h LEFT JOIN x USING (project_id, supplier_dir, field) WHERE h.supplier_dir IS NOT NULL AND (x.field IS NOT NULL OR h.field NOT IN ({', '.join(repr(f) for f in decide.CORE_FIELDS)})) GROUP BY h.field")
def conflict_gate(spark, d):
    h, x = _decided(spark, d)
    return decide.gate(h, x).groupBy("field").agg(F.count("*").alias("n"))


@query("""SELECT project_id, supplier_dir, count(DISTINCT value) FILTER (field = 'uscc') AS codes, min(value) FILTER (field = 'uscc') AS first_code, count(DISTINCT value) FILTER (field = 'company_name') AS names FROM field_hits WHERE supplier_dir IS NOT NULL GROUP BY ALL""")
def supplier_resolution(spark, d):
    of = lambda f: F.when(F.col("field") == f, F.col("value"))
    return table(spark, d, "field_hits").where("supplier_dir IS NOT NULL").groupBy("project_id", "supplier_dir").agg(F.count_distinct(of("uscc")).alias("codes"), F.min(of("uscc")).alias("first_code"), F.count_distinct(of("company_name")).alias("names"))


@query("""SELECT project_id, field AS kind, value, count(DISTINCT supplier_dir) AS parties, array_to_string(list_sort(list(DISTINCT evidence_id)), ',') AS evidence FROM field_hits WHERE field IN ('phone', 'email', 'address') AND value IS NOT NULL GROUP BY ALL""")
def contact_groups(spark, d):
    h = table(spark, d, "field_hits").where(F.col("field").isin("phone", "email", "address") & F.col("value").isNotNull())
    return h.groupBy("project_id", F.col("field").alias("kind"), "value").agg(F.count_distinct("supplier_dir").alias("parties"), F.array_join(F.array_sort(F.collect_set("evidence_id")), ",").alias("evidence"))


_SCORE = "SELECT document_id, value, sum(CASE WHEN via_label THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END + CASE WHEN page = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN method = 'ocr' THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END) AS score FROM field_hits WHERE field = 'company_name' AND value IS NOT NULL GROUP BY ALL"


def _scored(spark, d):
    h = table(spark, d, "field_hits").where("field = 'company_name' AND value IS NOT NULL")
    s = F.when(F.col("via_label"), 1.0).otherwise(0.25) + F.when(F.col("page") == 1, 1.0).otherwise(0.0) + F.when(F.col("method") == "ocr", 0.25).otherwise(0.0)
    return h, s


@query(f"WITH s AS ({_SCORE}), r AS (SELECT *, row_number() OVER w AS k, lead(score) OVER w AS second FROM s WINDOW w AS (PARTITION BY document_id ORDER BY score DESC, value)) SELECT document_id, value, score, second, coalesce(score - second < 1.0, false) AS ambiguous FROM r WHERE k = 1")
def candidate_margin(spark, d):
    h, s = _scored(spark, d)
    return ordered.top_two_gap(h.groupBy("document_id", "value").agg(F.sum(s).alias("score")), ["document_id"], "score", "value")


@query()
def group_clusters(spark, d):
    from sieveline.operators import extract

    h, s = _scored(spark, d)
    return extract.clustered(h.withColumn("score", s), "document_id", "value", "score", "hit_id")


# windows


@query("SELECT project_id, arg_max(config_id, (epoch_us(saved_at), config_id)) AS config_id, count(*) AS versions FROM project_configs GROUP BY project_id")
def latest_config(spark, d):
    c = table(spark, d, "project_configs")
    return c.groupBy("project_id").agg(F.max_by("config_id", F.struct(_us("saved_at"), "config_id")).alias("config_id"), F.count("*").alias("versions"))


@query("""SELECT project_id, name, result_id FROM (SELECT *, row_number() OVER (PARTITION BY project_id, name ORDER BY CASE confirmation WHEN 'confirmed' THEN 2 WHEN 'candidate' THEN 1 WHEN 'unconfirmed' THEN 0 ELSE -1 END DESC, result_id) AS k FROM subject_results WHERE name IS NOT NULL) WHERE k = 1""")
def status_precedence_merge(spark, d):
    s = table(spark, d, "subject_results").where("name IS NOT NULL")
    return ordered.by_precedence(s, ["project_id", "name"], "confirmation", {"confirmed": 2, "candidate": 1, "unconfirmed": 0}, F.col("result_id")).select("project_id", "name", "result_id")


@query("""SELECT evidence_id, hit_id FROM (SELECT *, row_number() OVER (PARTITION BY evidence_id ORDER BY loaded_at, hit_id) AS k FROM field_hits) WHERE k = 1""")
def first_delivery(spark, d):
    return ordered.first_by(table(spark, d, "field_hits").select("evidence_id", "hit_id", "loaded_at"), ["evidence_id"], [F.col("loaded_at").asc(), F.col("hit_id").asc()]).select("evidence_id", "hit_id")


@query("""WITH n AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1), o AS (SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT * FROM n UNION ALL SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM n)""")
def upsert_last_wins(spark, d):
    e = table(spark, d, "events")
    new = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    old = e.where("event_type = 'signup'").groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    return ordered.upsert(old, new, "user_id")


@query("""WITH n AS (SELECT decision_id, evidence_ids FROM field_decisions WHERE status = 'conflict'), t AS (SELECT DISTINCT unnest(evidence_ids) AS e FROM n), o AS (SELECT decision_id, evidence_ids FROM field_decisions WHERE status <> 'conflict'),
g AS (SELECT DISTINCT decision_id FROM (SELECT decision_id, unnest(evidence_ids) AS e FROM o) JOIN t USING (e)) SELECT decision_id FROM o WHERE decision_id NOT IN (SELECT decision_id FROM g) UNION ALL SELECT decision_id FROM n""")
def incremental_replace(spark, d):
    x = table(spark, d, "field_decisions").select("decision_id", "evidence_ids", "status")
    return ordered.replace_overlapping(x.where("status <> 'conflict'").drop("status"), x.where("status = 'conflict'").drop("status"), "evidence_ids").select("decision_id")


@query("""WITH c AS (SELECT l_suppkey, l_quantity, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS seen FROM lineitem GROUP BY ALL) SELECT l_suppkey, arg_max(l_quantity, (n, -seen)) AS l_quantity, max(n) AS n FROM c GROUP BY l_suppkey""")
def modal_total(spark, d):
    x = table(spark, d, "lineitem").withColumn("ord", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return ordered.modal(x, ["l_suppkey"], "l_quantity", "ord")


@query()
def total_after_heading(spark, d):
    """Totals of recognised pages (job_id) and of documents (doc_id), whose lines are those that are not blank."""
    none = F.lit(None).cast("bigint")
    blocks = table(spark, d, "ocr_blocks")
    lines = blocks.where("text IS NOT NULL").select("job_id", none.alias("doc_id"), F.col("block_no").cast("bigint").alias("pos"), F.col("text").alias("line"), "block_id")
    lines = lines.groupBy("job_id", "doc_id", "pos").agg(F.min_by("line", "block_id").alias("line"))  # a block delivered again counts once
    docs = table(spark, d, "documents").where("text RLIKE '合计|Total'")
    job = F.lit(None).cast(blocks.schema["job_id"].dataType)
    own = docs.select(job.alias("job_id"), "doc_id", F.posexplode(F.split("text", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")).alias("pos", "line")).where(F.col("line").rlike(r"\S"))
    return ordered.total_after_heading(lines.unionByName(own.withColumn("pos", F.col("pos").cast("bigint"))), ["job_id", "doc_id"], "line", "pos")


# layout


@query("""SELECT document_id, page, string_agg(text, chr(10) ORDER BY coalesce(bbox.y, 1.0), coalesce(bbox.x, 1.0), block_no, block_id) AS page_text, count(*) AS n_blocks FROM ocr_blocks WHERE text IS NOT NULL GROUP BY ALL""")
def reading_order_text(spark, d):
    return layout.reading_order(table(spark, d, "ocr_blocks"), ["document_id", "page"])


LABELS = [("联系人", "contact_name"), ("法人", "legal_rep_name"), ("技术偏离表", "section"), ("正本", "copy"), ("投标文件", "title")]


@query("""WITH m AS (SELECT * FROM (VALUES """ + ", ".join(f"('{w}', '{f}')" for w, f in LABELS) + """) m(label, field)), b AS (SELECT o.*, m.field FROM ocr_blocks o LEFT JOIN m ON regexp_replace(o.text, '[\\s:：]', '', 'g') = m.label WHERE o.text IS NOT NULL AND o.bbox IS NOT NULL),
j AS (SELECT l.document_id, l.page, l.field, l.block_id AS label_id, v.block_id AS value_id, v.block_no AS vn, v.text, least(l.confidence, v.confidence) AS confidence, l.bbox AS lb, v.bbox AS vb, (v.bbox.y + v.bbox.height / 2) - (l.bbox.y + l.bbox.height / 2) AS dy, v.bbox.x - (l.bbox.x + l.bbox.width) AS dx FROM b l JOIN b v ON l.document_id = v.document_id AND l.page = v.page WHERE l.field IS NOT NULL AND v.field IS NULL),
s AS (SELECT *, CASE WHEN abs(dy) <= greatest(2.5 * lb.height, 0.045) AND vb.x >= lb.x AND dx >= 0 THEN abs(dy) + 0.05 * dx WHEN dy > 0 AND dy <= greatest(5 * lb.height, 0.12) AND abs(vb.x - lb.x) <= 0.18 THEN 0.2 + dy END AS score FROM j)
SELECT document_id, page, field, label_id, arg_min(value_id, (score, vn, value_id)) AS value_id, arg_min(text, (score, vn, value_id)) AS value, arg_min(confidence, (score, vn, value_id)) AS confidence, round(min(score), 6) AS score FROM s WHERE score IS NOT NULL GROUP BY document_id, page, field, label_id""")
def ocr_spatial_pairs(spark, d):
    labels = spark.createDataFrame(LABELS, "label string, field string")
    return layout.spatial_pairs(table(spark, d, "ocr_blocks"), labels, ["document_id", "page"])


@query("""SELECT job_id, block_no, CASE WHEN trim(regexp_extract(text, '^\\s*(?:联系人|法人)\\s*[:：]?\\s*(.*)$', 1)) <> '' THEN trim(regexp_extract(text, '^\\s*(?:联系人|法人)\\s*[:：]?\\s*(.*)$', 1)) ELSE trim(nx) END AS value FROM (SELECT *, lead(text) OVER (PARTITION BY job_id ORDER BY block_no) AS nx FROM (SELECT job_id, block_no, min(text) AS text FROM ocr_blocks WHERE text IS NOT NULL GROUP BY ALL)) WHERE regexp_matches(text, '^\\s*(?:联系人|法人)')""")
def next_line_value(spark, d):
    lines = table(spark, d, "ocr_blocks").where("text IS NOT NULL").groupBy("job_id", "block_no").agg(F.min("text").alias("text"))
    return layout.next_line(lines, ["job_id"], "block_no", "text", "联系人|法人")


# reports


@query("""SELECT value, count(DISTINCT supplier_dir) AS owners, bool_or(method = 'ocr') AS ocr, bool_or(method = 'regex') AS regex, bool_or(method = 'table') AS tbl, CASE WHEN count(DISTINCT supplier_dir) > 1 THEN '共同' ELSE '' END AS mark FROM field_hits WHERE field = 'phone' AND value IS NOT NULL GROUP BY value""")
def presence_matrix(spark, d):
    """Presence of each value by way of extraction: conditional sums over a fixed list instead of a pivot over unknown values."""
    h = table(spark, d, "field_hits").where("field = 'phone' AND value IS NOT NULL")
    owners = F.count_distinct("supplier_dir")
    return h.groupBy("value").agg(owners.alias("owners"), *[F.bool_or(F.col("method") == m).alias("tbl" if m == "table" else m) for m in ("ocr", "regex", "table")], F.when(owners > 1, "共同").otherwise("").alias("mark"))


@query("""SELECT project_id, supplier_dir, count(*) AS hits, count(*) FILTER (confidence < 0.85) AS low, count(*) FILTER (value IS NULL) AS empty, max(epoch_us(loaded_at)) AS last_us FROM field_hits GROUP BY ALL""")
def supplier_summary(spark, d):
    h = table(spark, d, "field_hits")
    return h.groupBy("project_id", "supplier_dir").agg(F.count("*").alias("hits"), F.count_if(F.col("confidence") < 0.85).alias("low"), F.count_if(F.col("value").isNull()).alias("empty"), F.max(_us("loaded_at")).alias("last_us"))


@query("""SELECT project_id, field, count(*) AS n_shared FROM (SELECT project_id, field, value FROM field_hits WHERE value IS NOT NULL AND supplier_dir IS NOT NULL GROUP BY ALL HAVING count(DISTINCT supplier_dir) > 1) GROUP BY ALL""")
def duplicate_check(spark, d):
    h = table(spark, d, "field_hits").where("value IS NOT NULL AND supplier_dir IS NOT NULL").groupBy("project_id", "field", "value").agg(F.count_distinct("supplier_dir").alias("k"))
    return h.where("k > 1").groupBy("project_id", "field").agg(F.count("*").alias("n_shared"))


@query("""SELECT evidence_id, string_agg(DISTINCT field, ',' ORDER BY field) AS fields, count(*) AS deliveries, left('page=' || coalesce(min(page)::VARCHAR, '-') || ';path=' || min(relative_path), 300) AS location FROM field_hits GROUP BY evidence_id""")
def evidence_index(spark, d):
    place = F.left(F.concat(F.lit("page="), F.coalesce(F.min("page").cast("string"), F.lit("-")), F.lit(";path="), F.min("relative_path")), F.lit(300))
    return table(spark, d, "field_hits").groupBy("evidence_id").agg(F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields"), F.count("*").alias("deliveries"), place.alias("location"))


@query("""SELECT 'low_confidence' AS kind, hit_id AS ref FROM field_hits WHERE confidence < 0.85 UNION ALL SELECT 'decision', decision_id FROM field_decisions WHERE status <> 'selected' UNION ALL SELECT 'unreadable', pdf_id FROM parsed_pdfs WHERE len(issues) > 0 UNION ALL SELECT 'empty_block', block_id FROM ocr_blocks WHERE text IS NULL""")
def review_queue_union(spark, d):
    part = lambda name, t, where, ref: table(spark, d, t).where(where).select(F.lit(name).alias("kind"), F.col(ref).alias("ref"))
    out = part("low_confidence", "field_hits", "confidence < 0.85", "hit_id")
    for x in (("decision", "field_decisions", "status <> 'selected'", "decision_id"), ("unreadable", "parsed_pdfs", "size(issues) > 0", "pdf_id"), ("empty_block", "ocr_blocks", "text IS NULL", "block_id")):
        out = out.unionByName(part(*x))
    return out


@query("""SELECT coalesce(a.project_id, b.project_id) AS project_id, coalesce(a.n, 0) AS empty_values, coalesce(b.n, 0) AS open_decisions FROM (SELECT project_id, count(*) AS n FROM field_hits WHERE value IS NULL GROUP BY 1) a FULL JOIN (SELECT project_id, count(*) AS n FROM field_decisions WHERE status <> 'selected' GROUP BY 1) b ON a.project_id = b.project_id""")
def extraction_gaps(spark, d):
    a = table(spark, d, "field_hits").where("value IS NULL").groupBy("project_id").agg(F.count("*").alias("a"))
    b = table(spark, d, "field_decisions").where("status <> 'selected'").groupBy("project_id").agg(F.count("*").alias("b"))
    return a.join(b, "project_id", "full").select("project_id", F.coalesce("a", F.lit(0)).alias("empty_values"), F.coalesce("b", F.lit(0)).alias("open_decisions"))


@query("""SELECT record_kind, arg_max(record_id, (cardinality(fields), -record_id)) AS record_id, max(cardinality(fields)) AS n_fields FROM adapter_records GROUP BY record_kind""")
def fullest_record(spark, d):
    r = table(spark, d, "adapter_records").withColumn("n", F.size("fields"))
    return r.groupBy("record_kind").agg(F.max_by("record_id", F.struct("n", (-F.col("record_id")).alias("k"))).alias("record_id"), F.max("n").cast("bigint").alias("n_fields"))


@query("""SELECT record_id, k AS label, v AS value FROM (SELECT record_id, unnest(map_keys(fields)) AS k, unnest(map_values(fields)) AS v FROM adapter_records) WHERE v NOT IN ('-', '--', '暂无', '无', '未返回', '未取得')""")
def registration_matrix(spark, d):
    r = table(spark, d, "adapter_records").select("record_id", F.explode("fields").alias("label", "value"))
    return r.where(~F.col("value").isin("-", "--", "暂无", "无", "未返回", "未取得"))


@query("""SELECT source_id, record_kind, count(*) AS n, count(*) FILTER (subject_confirmation = 'candidate') AS candidates FROM adapter_records GROUP BY ALL""")
def record_counts(spark, d):
    return table(spark, d, "adapter_records").groupBy("source_id", "record_kind").agg(F.count("*").alias("n"), F.count_if(F.col("subject_confirmation") == "candidate").alias("candidates"))
