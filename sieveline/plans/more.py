"""Further queries: shared metadata, groups and overrides, parties, ordinals and quotas, nested reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.operators import assemble, match, ordered
from sieveline.plans.registry import query
from sieveline.plans.values import wide
from sieveline.runtime import table

_ADDR = f"regexp_replace({wide('value')}, '[\\s.。,，、;；:：\\-－–—]', '', 'g')"


@query(
    f"""WITH k AS (SELECT DISTINCT project_id, supplier_dir, {_ADDR} AS k FROM field_hits WHERE field = 'address' AND value IS NOT NULL AND supplier_dir IS NOT NULL),
    r AS (SELECT DISTINCT project_id, supplier_dir, regexp_extract(k, '^(.*?(?:省|自治区).*?市.*?(?:区|县|旗))', 1) AS region FROM k)
    SELECT a.project_id, a.supplier_dir AS party_a, b.supplier_dir AS party_b, count(*) AS regions FROM r a JOIN r b USING (project_id, region) WHERE a.supplier_dir < b.supplier_dir AND region <> '' GROUP BY ALL"""
)
def region_candidates(spark, d):
    h = table(spark, d, "field_hits").where("field = 'address' AND value IS NOT NULL AND supplier_dir IS NOT NULL")
    region = F.regexp_extract(text.address_key(F.col("value")), "^(.*?(?:省|自治区).*?市.*?(?:区|县|旗))", 1)
    m = match.cross_match(h.withColumn("region", region).where("region <> ''"), "supplier_dir", ["project_id", "region"], "evidence_id")
    return m.groupBy("project_id", "party_a", "party_b").agg(F.count("*").alias("regions"))


@query(
    """WITH m AS (SELECT DISTINCT project_id, supplier_dir, k, v FROM (SELECT project_id, supplier_dir, unnest(map_keys(metadata)) AS k, unnest(map_values(metadata)) AS v FROM parsed_pdfs) WHERE supplier_dir IS NOT NULL AND k IN ('Author', 'Producer') AND v NOT IN ('admin', 'user'))
    SELECT a.project_id, a.supplier_dir AS party_a, b.supplier_dir AS party_b, count(DISTINCT k) AS n_fields, string_agg(DISTINCT k || '=' || v, ';' ORDER BY k || '=' || v) AS shared FROM m a JOIN m b USING (project_id, k, v) WHERE a.supplier_dir < b.supplier_dir GROUP BY ALL"""
)
def shared_metadata(spark, d):
    m = table(spark, d, "parsed_pdfs").where("supplier_dir IS NOT NULL").select("project_id", "supplier_dir", F.explode("metadata").alias("k", "v"), "pdf_id")
    m = m.where(F.col("k").isin("Author", "Producer") & ~F.col("v").isin("admin", "user"))
    pairs = match.cross_match(m, "supplier_dir", ["project_id", "k", "v"], "pdf_id")
    return pairs.groupBy("project_id", "party_a", "party_b").agg(F.count_distinct("k").alias("n_fields"), F.array_join(F.array_sort(F.collect_set(F.concat("k", F.lit("="), "v"))), ";").alias("shared"))


@query("""SELECT p.pdf_id, coalesce(g.name, p.supplier_dir) AS party, p.supplier_dir IS NOT NULL AND g.name IS NULL AS by_directory FROM parsed_pdfs p LEFT JOIN (SELECT document_id, min(value) AS name FROM field_hits WHERE field = 'company_name' AND value IS NOT NULL AND confidence >= 0.85 GROUP BY 1) g USING (document_id)""")
def document_party(spark, d):
    g = table(spark, d, "field_hits").where("field = 'company_name' AND value IS NOT NULL AND confidence >= 0.85").groupBy("document_id").agg(F.min("value").alias("name"))
    p = table(spark, d, "parsed_pdfs").select("pdf_id", "document_id", "supplier_dir").join(g, "document_id", "left")
    return p.select("pdf_id", F.coalesce("name", "supplier_dir").alias("party"), (F.col("supplier_dir").isNotNull() & F.col("name").isNull()).alias("by_directory"))


@query("""WITH a AS (SELECT project_id, min(name) AS name FROM subject_results WHERE confirmation = 'candidate' AND name IS NOT NULL GROUP BY 1), m AS (SELECT project_id, min(name) AS name FROM subject_results WHERE confirmation = 'confirmed' AND name IS NOT NULL GROUP BY 1)
SELECT a.project_id, coalesce(m.name, a.name) AS name, NULL::VARCHAR AS error FROM a LEFT JOIN m USING (project_id) UNION ALL SELECT m.project_id, m.name, 'unknown key' FROM m WHERE project_id NOT IN (SELECT project_id FROM a)""")
def manual_override(spark, d):
    s = table(spark, d, "subject_results").where("name IS NOT NULL")
    of = lambda c: s.where(F.col("confirmation") == c).groupBy("project_id").agg(F.min("name").alias("name"))
    return assemble.overridden(of("candidate"), of("confirmed"), "project_id", "name")


@query("""SELECT name, coalesce(min(subject_id)::VARCHAR, 'SUP-' || (row_number() OVER (ORDER BY name))::VARCHAR) AS identity FROM (SELECT DISTINCT name FROM subject_results WHERE name IS NOT NULL) n LEFT JOIN query_subjects q USING (name) GROUP BY name""")
def identity_reuse(spark, d):
    """Known subjects keep their id; the others are numbered in order, without one task sorting all names."""
    n = table(spark, d, "subject_results").where("name IS NOT NULL").select("name").distinct()
    q = table(spark, d, "query_subjects").where("name IS NOT NULL").groupBy("name").agg(F.min("subject_id").alias("s"))
    numbered = assemble.dense_number(n, ["name"], "k")
    return numbered.join(q, "name", "left").select("name", F.coalesce(F.col("s").cast("string"), F.concat(F.lit("SUP-"), (F.col("k") + 1).cast("string"))).alias("identity"))


@query("""WITH l AS (SELECT project_id, name, arg_max(confirmation, (epoch_us(queried_at), result_id)) AS last FROM subject_results WHERE name IS NOT NULL GROUP BY ALL) SELECT c.project_id, count(l.name) FILTER (last = 'confirmed') AS confirmed, count(l.name) FILTER (last <> 'confirmed') AS problems FROM (SELECT DISTINCT project_id FROM project_configs WHERE external_query_mode = 'live') c LEFT JOIN l USING (project_id) GROUP BY 1""")
def report_gate(spark, d):
    s = table(spark, d, "subject_results").where("name IS NOT NULL")
    last = s.groupBy("project_id", "name").agg(F.max_by("confirmation", F.struct(F.unix_micros("queried_at"), "result_id")).alias("last"))
    c = table(spark, d, "project_configs").where("external_query_mode = 'live'").select("project_id").distinct()
    return c.join(last, "project_id", "left").groupBy("project_id").agg(F.count_if(F.col("last") == "confirmed").alias("confirmed"), F.count_if(F.col("last") != "confirmed").alias("problems"))


@query("""SELECT a.decision_id AS decision_a, b.decision_id AS decision_b, count(DISTINCT e) AS common FROM (SELECT decision_id, unnest(evidence_ids) AS e FROM field_decisions) a JOIN (SELECT decision_id, unnest(evidence_ids) AS e FROM field_decisions) b USING (e) WHERE a.decision_id < b.decision_id GROUP BY ALL""")
def evidence_overlap(spark, d):
    x = table(spark, d, "field_decisions").select("decision_id", F.explode(F.array_distinct("evidence_ids")).alias("e"))
    j = match.pairs_within(x.distinct(), ["e"], "decision_id")
    return j.groupBy(F.col("a").alias("decision_a"), F.col("b").alias("decision_b")).agg(F.count("*").alias("common"))


@query("""WITH n AS (SELECT project_id, supplier_dir, count(DISTINCT value) FILTER (field = 'legal_rep_name') AS names, min(value) FILTER (field = 'legal_rep_name') AS name, count(DISTINCT value) FILTER (field = 'legal_rep_id') AS ids, min(value) FILTER (field = 'legal_rep_id') AS id FROM field_hits WHERE supplier_dir IS NOT NULL GROUP BY ALL)
SELECT project_id, supplier_dir, name, CASE WHEN ids = 1 AND names = 1 THEN left(sha256('salt' || upper(regexp_replace(id, '\\s', '', 'g'))), 16) END AS digest, ids FROM n WHERE names > 0 OR ids > 0""")
def parties(spark, d):
    """Representatives of each party; the digest is linked only where there is one name and one number."""
    of = lambda f: F.when(F.col("field") == f, F.col("value"))
    n = table(spark, d, "field_hits").where("supplier_dir IS NOT NULL").groupBy("project_id", "supplier_dir").agg(F.count_distinct(of("legal_rep_name")).alias("names"), F.min(of("legal_rep_name")).alias("name"), F.count_distinct(of("legal_rep_id")).alias("ids"), F.min(of("legal_rep_id")).alias("id"))
    digest = F.left(F.sha2(F.concat(F.lit("salt"), F.upper(F.regexp_replace("id", "\\s", ""))), 256), F.lit(16))
    return n.where("names > 0 OR ids > 0").select("project_id", "supplier_dir", "name", F.when((F.col("ids") == 1) & (F.col("names") == 1), digest).alias("digest"), "ids")


@query("""SELECT project_id, array_to_string(list_sort(list(DISTINCT doc_kind)), ',') AS kinds, array_to_string(list_sort(list_filter(['bid_letter', 'commercial', 'technical'], lambda k: NOT list_contains(list(DISTINCT doc_kind), k))), ',') AS missing, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY project_id""")
def group_rollup(spark, d):
    kinds = F.collect_set("doc_kind")
    g = table(spark, d, "documents").where("source IS NOT NULL").groupBy("project_id").agg(kinds.alias("k"), F.count("*").alias("n"))
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, ("bid_letter", "commercial", "technical"))), F.col("k")))
    return g.select("project_id", F.array_join(F.array_sort("k"), ",").alias("kinds"), F.array_join(missing, ",").alias("missing"), "n")


@query("""SELECT project_id, count(*) FILTER (status = 'selected') AS selected, count(*) FILTER (status = 'conflict') AS conflict, count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'needs_manual_review') AS needs_manual_review FROM field_decisions GROUP BY project_id""")
def status_pivot(spark, d):
    wanted = ["selected", "conflict", "missing", "needs_manual_review"]
    return table(spark, d, "field_decisions").groupBy("project_id").pivot("status", wanted).count().fillna(0, wanted)


@query("""SELECT project_id, min(value) AS tenderer FROM field_hits WHERE field = 'tenderer' AND value IS NOT NULL GROUP BY project_id HAVING count(DISTINCT value) = 1""")
def only_tenderer(spark, d):
    t = table(spark, d, "field_hits").where("field = 'tenderer' AND value IS NOT NULL").groupBy("project_id").agg(F.count_distinct("value").alias("k"), F.min("value").alias("tenderer"))
    return t.where("k = 1").select("project_id", "tenderer")


@query("""SELECT job_id, min(block_no) FILTER (text IS NULL) AS first_open, count(*) AS blocks FROM ocr_blocks GROUP BY job_id""")
def first_open_block(spark, d):
    return table(spark, d, "ocr_blocks").groupBy("job_id").agg(F.min(F.when(F.col("text").isNull(), F.col("block_no"))).alias("first_open"), F.count("*").alias("blocks"))


@query("""SELECT format('CL-{:06d}', row_number() OVER (ORDER BY project_id, doc_id)) AS clause_id, doc_id FROM documents WHERE doc_kind = 'clause'""")
def clause_ordinals(spark, d):
    c = assemble.dense_number(table(spark, d, "documents").where("doc_kind = 'clause'").select("project_id", "doc_id"), ["project_id", "doc_id"], "k")
    return c.select(F.format_string("CL-%06d", F.col("k") + 1).alias("clause_id"), "doc_id")


@query()
def clause_quota(spark, d):
    """Twenty new clause sentences a document, documents of a project in order."""
    from sieveline.operators import extract

    s = table(spark, d, "documents").where("text IS NOT NULL AND doc_kind = 'clause'").select("project_id", "doc_id", F.posexplode(extract.clause_sentences(F.col("text"))).alias("pos", "sentence"))
    return assemble.quota_with_memory(s, "project_id", "doc_id", "pos", "sentence", 20)


@query("""WITH j AS (SELECT document_id, count(*) AS n FROM parsed_pdfs GROUP BY 1), c AS (SELECT o.block_id, j.n IS NOT NULL AS known, coalesce(o.confidence BETWEEN 0 AND 1, false) AS conf, coalesce(o.text IS NOT NULL, false) AS text_ok FROM ocr_blocks o LEFT JOIN j USING (document_id))
SELECT block_id, concat_ws(',', CASE WHEN NOT known THEN 'job' END, CASE WHEN NOT conf THEN 'confidence' END, CASE WHEN NOT text_ok THEN 'text' END) AS errors, (SELECT count(*) FROM c WHERE NOT (known AND conf AND text_ok)) = 0 AS accepted FROM c""")
def ocr_delivery_check(spark, d):
    known = table(spark, d, "parsed_pdfs").select("document_id").distinct().withColumn("known", F.lit(True))
    o = table(spark, d, "ocr_blocks").select("block_id", "document_id", "confidence", "text").join(known, "document_id", "left")
    checked = assemble.all_or_nothing(o, {"job": F.col("known"), "confidence": F.col("confidence").between(0, 1), "text": F.col("text").isNotNull()})
    return checked.select("block_id", F.concat_ws(",", "errors").alias("errors"), "accepted")


@query("""SELECT doc_id, regexp_extract(text, '(?:QA-|CG)([0-9][0-9.\\-]*[0-9])', 1) AS first_number FROM documents WHERE regexp_matches(text, '(?:QA-|CG)[0-9][0-9.\\-]*[0-9]')""")
def serial_first_match(spark, d):
    p = "(?:QA-|CG)([0-9][0-9.\\-]*[0-9])"
    return table(spark, d, "documents").where(F.col("text").rlike(p)).select("doc_id", F.regexp_extract("text", p, 1).alias("first_number"))


@query("""SELECT pdf_id, sha256(string_agg(h, '|' ORDER BY h)) AS pages_hash, count(*) AS pages FROM (SELECT pdf_id, sha256(coalesce(p.text, '')) AS h FROM (SELECT pdf_id, unnest(pages) AS p FROM parsed_pdfs)) GROUP BY pdf_id""")
def page_image_hash(spark, d):
    """Hash over the sorted hashes of a document's pages: independent of their order."""
    h = table(spark, d, "parsed_pdfs").select("pdf_id", F.size("pages").cast("bigint").alias("pages"), F.array_sort(F.transform("pages", lambda p: F.sha2(F.coalesce(p["text"], F.lit("")), 256))).alias("h"))
    return h.where("pages > 0").select("pdf_id", F.sha2(F.array_join("h", "|"), 256).alias("pages_hash"), "pages")


@query("""SELECT record_id, concat_ws('，', coalesce(fields['处罚决定文号'], fields['reg_no']), coalesce(fields['行为'], fields['成立日期'], fields['founded'])) AS fact, CASE WHEN effective_to IS NULL THEN '长期' ELSE '有期' END AS validity FROM adapter_records""")
def fact_texts(spark, d):
    get = lambda *k: F.coalesce(*[F.element_at("fields", F.lit(x)) for x in k])
    return table(spark, d, "adapter_records").select("record_id", F.concat_ws("，", get("处罚决定文号", "reg_no"), get("行为", "成立日期", "founded")).alias("fact"), F.when(F.col("effective_to").isNull(), "长期").otherwise("有期").alias("validity"))


@query("""SELECT subject_id, replace(replace('/q?name={name}&code={uscc}', '{name}', coalesce(name, '')), '{uscc}', coalesce(uscc, '')) AS request, CASE WHEN length(coalesce(address, '')) > 12 THEN left(address, 12) || '…' ELSE address END AS detail FROM query_subjects""")
def request_texts(spark, d):
    r = F.lit("/q?name={name}&code={uscc}")
    for k in ("name", "uscc"):
        r = F.replace(r, F.lit(f"{{{k}}}"), F.coalesce(k, F.lit("")))
    short = F.when(F.length(F.coalesce("address", F.lit(""))) > 12, F.concat(F.left("address", F.lit(12)), F.lit("…"))).otherwise(F.col("address"))
    return table(spark, d, "query_subjects").select("subject_id", r.alias("request"), short.alias("detail"))


@query("""SELECT project_id, to_json(list({'n': n, 'field': field} ORDER BY field))::VARCHAR AS bundle FROM (SELECT project_id, field, count(*) AS n FROM field_hits GROUP BY ALL) GROUP BY project_id""")
def nested_bundle(spark, d):
    one = table(spark, d, "field_hits").groupBy("project_id", "field").agg(F.count("*").alias("n"))
    rows = F.array_sort(F.collect_list(F.struct("field", "n")))
    return one.groupBy("project_id").agg(F.to_json(F.transform(rows, lambda r: F.struct(r["n"].alias("n"), r["field"].alias("field")))).alias("bundle"))


@query("""SELECT a.project_id, a.name AS name_a, b.name AS name_b FROM (SELECT DISTINCT project_id, name FROM subject_results WHERE name IS NOT NULL) a JOIN (SELECT DISTINCT project_id, name FROM subject_results WHERE name IS NOT NULL) b ON a.project_id = b.project_id AND left(a.name, 4) = left(b.name, 4) AND a.name < b.name""")
def same_prefix_names(spark, d):
    n = table(spark, d, "subject_results").where("name IS NOT NULL").select("project_id", "name", F.left("name", F.lit(4)).alias("k")).distinct()
    return match.pairs_within(n, ["project_id", "k"], "name").select("project_id", F.col("a").alias("name_a"), F.col("b").alias("name_b"))


@query()
def anchor_match(spark, d):
    """Names of other documents against the anchor names of their project by matching-block ratio; one good anchor is an assignment.

    Candidate pairs share a token of two characters, so pairs meet by key and not all with all; only a name of two against one
    of three with a letter between reaches the threshold without such a token, so names that short have single characters too.
    """
    s = table(spark, d, "subject_results").where("name IS NOT NULL").select("project_id", F.col("name").alias("anchor")).distinct()
    h = table(spark, d, "field_hits").where("field = 'company_name' AND value IS NOT NULL").select("project_id", F.col("value").alias("name")).distinct()
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substr(F.col(c), i, F.lit(2))))
    single = lambda c: F.when(F.length(c).between(2, 3), F.split(F.col(c), "")).otherwise(F.array().cast("array<string>"))
    tokens = lambda c: F.explode(F.array_distinct(F.concat(grams(c), single(c))))
    j = s.withColumn("g", tokens("anchor")).join(h.withColumn("g", tokens("name")), ["project_id", "g"]).select("project_id", "anchor", "name").distinct()
    near = j.withColumn("ratio", F.round(text.sequence_ratio(F.col("name"), F.col("anchor")), 6)).where("ratio >= 0.8")
    return near.groupBy("project_id", "name").agg(F.count("*").alias("n"), F.max_by("anchor", F.struct("ratio", "anchor")).alias("best")).select("project_id", "name", F.when(F.col("n") == 1, F.col("best")).alias("anchor"), "n")


@query("""SELECT table_name AS name, cnt AS n FROM (SELECT 'field_hits' AS table_name, count(*) AS cnt FROM field_hits UNION ALL SELECT 'ocr_blocks', count(*) FROM ocr_blocks UNION ALL SELECT 'parsed_pdfs', count(*) FROM parsed_pdfs)""")
def stage_counts(spark, d):
    out = None
    for name in ("field_hits", "ocr_blocks", "parsed_pdfs"):
        one = table(spark, d, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT record_id, CASE WHEN s.uscc IS NOT NULL THEN 'confirmed' WHEN n.name IS NOT NULL THEN 'candidate' END AS hit FROM (SELECT record_id, coalesce(fields['统一社会信用代码'], fields['信用代码'], fields['reg_no']) AS c, coalesce(fields['企业名称'], fields['当事人'], fields['name']) AS m FROM adapter_records) r LEFT JOIN (SELECT DISTINCT upper(uscc) AS uscc FROM query_subjects WHERE uscc IS NOT NULL) s ON s.uscc = upper(r.c) LEFT JOIN (SELECT DISTINCT name FROM query_subjects WHERE name IS NOT NULL) n ON n.name = r.m WHERE s.uscc IS NOT NULL OR n.name IS NOT NULL""")
def local_filter(spark, d):
    get = lambda *k: F.coalesce(*[F.element_at("fields", F.lit(x)) for x in k])
    r = table(spark, d, "adapter_records").select("record_id", F.upper(get("统一社会信用代码", "信用代码", "reg_no")).alias("c"), get("企业名称", "当事人", "name").alias("m"))
    q = table(spark, d, "query_subjects")
    s = q.select(F.upper("uscc").alias("c"), F.lit(1).alias("by_code")).where("c IS NOT NULL").distinct()
    n = q.select(F.col("name").alias("m"), F.lit(1).alias("by_name")).where("m IS NOT NULL").distinct()
    j = r.join(s, "c", "left").join(n, "m", "left").where("by_code IS NOT NULL OR by_name IS NOT NULL")
    return j.select("record_id", F.when(F.col("by_code").isNotNull(), "confirmed").otherwise("candidate").alias("hit"))


@query("""SELECT supplier_dir, arg_max(document_id, (n, document_id)) AS fullest, max(n) AS n FROM (SELECT supplier_dir, document_id, count(*) AS n FROM field_hits WHERE supplier_dir IS NOT NULL GROUP BY ALL) GROUP BY 1""")
def fullest_document(spark, d):
    c = table(spark, d, "field_hits").where("supplier_dir IS NOT NULL").groupBy("supplier_dir", "document_id").agg(F.count("*").alias("n"))
    return ordered.first_by(c, ["supplier_dir"], [F.col("n").desc(), F.col("document_id").desc()]).select("supplier_dir", F.col("document_id").alias("fullest"), "n")
