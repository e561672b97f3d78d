"""Queries on records and evidence: attachment, identity checks, buckets, sections, rows of reports and their projections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.operators import assemble, match
from sieveline.plans.registry import query
from sieveline.runtime import table

_NAME = "coalesce(fields['企业名称'], fields['当事人'], fields['name'])"
_CODE = "coalesce(fields['信用代码'], fields['统一社会信用代码'], fields['reg_no'])"
_DISPLAY = "trim(regexp_replace({}, '[（(](?:公章|盖章|签章)[）)]\\s*$', ''))"


def _get(*keys):
    return F.coalesce(*[F.element_at("fields", F.lit(k)) for k in keys])


def _records(spark, d):
    r = table(spark, d, "adapter_records")
    return r.select("record_id", "source_id", "record_kind", "effective_from", "fields", _get("企业名称", "当事人", "name").alias("name"), _get("信用代码", "统一社会信用代码", "reg_no").alias("code"))


_KEYED = f"SELECT record_id, source_id, record_kind, effective_from, fields, {_NAME} AS name, {_CODE} AS code FROM adapter_records"


@query(f"""WITH r AS (SELECT record_id, upper(replace(code, ' ', '')) AS code, {_DISPLAY.format('name')} AS name FROM ({_KEYED})), s AS (SELECT subject_id, upper(replace(uscc, ' ', '')) AS code, {_DISPLAY.format('name')} AS name FROM query_subjects)
SELECT DISTINCT record_id, subject_id FROM (SELECT r.record_id, s.subject_id FROM r JOIN s ON r.code = s.code UNION ALL SELECT r.record_id, s.subject_id FROM r JOIN s ON r.name = s.name)""")
def record_attach(spark, d):
    """Records that belong to a subject: equal codes in any case, or equal names without the sign of a seal."""
    r = _records(spark, d).select("record_id", F.upper(F.replace("code", F.lit(" "), F.lit(""))).alias("code"), text.company_display(F.col("name")).alias("name"))
    s = table(spark, d, "query_subjects").select("subject_id", F.upper(F.replace("uscc", F.lit(" "), F.lit(""))).alias("code"), text.company_display(F.col("name")).alias("name"))
    by = lambda k: r.select("record_id", k).join(s.select("subject_id", k), k).select("record_id", "subject_id")
    return by("code").unionByName(by("name")).distinct()


@query(f"""WITH r AS (SELECT record_id, code, {_DISPLAY.format('name')} AS name FROM ({_KEYED})), s AS (SELECT subject_id, uscc AS code, {_DISPLAY.format('name')} AS name FROM query_subjects),
p AS (SELECT record_id, subject_id, r.code AS rc, s.code AS sc, r.name AS rn, s.name AS sn FROM r JOIN s ON r.code = s.code UNION SELECT record_id, subject_id, r.code, s.code, r.name, s.name FROM r JOIN s ON r.name = s.name)
SELECT record_id, subject_id, CASE WHEN rc <> sc OR rn <> sn THEN 'unconfirmed' WHEN rc = sc AND rn = sn THEN 'confirmed' ELSE 'candidate' END AS identity FROM p""")
def identity_double_check(spark, d):
    """Name and code together: equal on both is confirmed, a conflict on either is not, one alone is a candidate."""
    r = _records(spark, d).select("record_id", F.col("code").alias("rc"), text.company_display(F.col("name")).alias("rn"))
    s = table(spark, d, "query_subjects").select("subject_id", F.col("uscc").alias("sc"), text.company_display(F.col("name")).alias("sn"))
    p = r.join(s, F.col("rc") == F.col("sc")).unionByName(r.join(s, F.col("rn") == F.col("sn"))).distinct()
    no = F.coalesce(F.col("rc") != F.col("sc"), F.lit(False)) | F.coalesce(F.col("rn") != F.col("sn"), F.lit(False))
    both = F.col("rc").isNotNull() & F.col("sc").isNotNull() & F.col("rn").isNotNull() & F.col("sn").isNotNull()
    return p.select("record_id", "subject_id", F.when(no, "unconfirmed").when(both, "confirmed").otherwise("candidate").alias("identity"))


@query("""WITH n AS (SELECT name, min(supplier_id) AS sid FROM query_subjects WHERE name IS NOT NULL GROUP BY name), g AS (SELECT document_id, min(sid) AS sid FROM field_hits JOIN n ON value = name WHERE field IN ('company_name', 'tenderer') GROUP BY 1)
SELECT document_id, coalesce(g.sid, supplier_dir) AS supplier, g.sid IS NOT NULL AS by_group FROM (SELECT document_id, min(supplier_dir) AS supplier_dir FROM field_hits GROUP BY 1) LEFT JOIN g USING (document_id)""")
def group_supplier_ids(spark, d):
    """Supplier of each document: that of its group's name, else its directory."""
    h = table(spark, d, "field_hits").select("document_id", "supplier_dir", "field", "value")
    n = table(spark, d, "query_subjects").where("name IS NOT NULL").groupBy(F.col("name").alias("value")).agg(F.min("supplier_id").alias("sid"))
    g = h.where(F.col("field").isin("company_name", "tenderer")).join(n, "value").groupBy("document_id").agg(F.min("sid").alias("sid"))
    docs = h.groupBy("document_id").agg(F.min("supplier_dir").alias("dir"))
    return docs.join(g, "document_id", "left").select("document_id", F.coalesce("sid", "dir").alias("supplier"), F.col("sid").isNotNull().alias("by_group"))


#: Rules and the clauses that they quote by topic word (fixed values); one names a clause that does not exist.
RULE_TOPICS = (("R-01", 1, "质量保证金"), ("R-01", 2, "保证金"), ("R-02", 1, "密封"), ("R-03", 1, "不存在的条款"), ("R-03", 2, "联合体"))


@query("""WITH m(rule, ord, word) AS (VALUES """ + ", ".join(map(str, RULE_TOPICS)) + """), c AS (SELECT word, arg_min(left(text, 80), doc_id) AS quote FROM documents JOIN (SELECT DISTINCT word FROM m) ON contains(text, word) WHERE doc_kind = 'clause' GROUP BY word)
SELECT rule, list(quote ORDER BY ord) AS quotes FROM m JOIN c USING (word) GROUP BY rule""")
def rule_quotes(spark, d):
    """Quotes of the clauses that each rule names, in its order, 80 characters each; names without a clause are left out."""
    words = sorted({w for _, _, w in RULE_TOPICS})
    c = table(spark, d, "documents").where("doc_kind = 'clause'").select("doc_id", F.left("text", F.lit(80)).alias("quote"), F.explode(F.array_compact(F.array(*[F.when(F.contains("text", F.lit(w)), F.lit(w)) for w in words]))).alias("word"))
    first = c.groupBy("word").agg(F.min_by("quote", "doc_id").alias("quote"))
    m = spark.createDataFrame(list(RULE_TOPICS), "rule string, ord int, word string")
    rows = m.join(first, "word").groupBy("rule").agg(F.array_sort(F.collect_list(F.struct("ord", "quote"))).alias("q"))
    return rows.select("rule", F.transform("q", lambda x: x["quote"]).alias("quotes"))


@query(f"""SELECT nm, kind, list_sort(list(DISTINCT record_id)) AS records, count(*) AS n, min(amount) AS amount FROM (SELECT record_id, {_DISPLAY.format('name')} AS nm, record_kind AS kind, try_cast(regexp_extract(effective_from, '([0-9]{{4}})', 1) AS INTEGER) AS amount FROM ({_KEYED}) WHERE name IS NOT NULL) GROUP BY nm, kind""")
def ownership_dedupe(spark, d):
    """Relations of one company and kind once, with the union of their records and the least of their numbers."""
    r = _records(spark, d).where("name IS NOT NULL").select("record_id", text.company_display(F.col("name")).alias("nm"), F.col("record_kind").alias("kind"), F.regexp_extract("effective_from", "([0-9]{4})", 1).try_cast("int").alias("amount"))
    return r.groupBy("nm", "kind").agg(F.array_sort(F.collect_set("record_id")).alias("records"), F.count("*").alias("n"), F.min("amount").alias("amount"))


@query("""WITH g AS (SELECT project_id, supplier_dir, count(DISTINCT upper(replace(value, ' ', ''))) FILTER (field = 'uscc') AS codes, count(DISTINCT value) FILTER (field = 'company_name' AND via_label) AS names, bool_or(regexp_matches(relative_path, '商务|资格|报价')) AS business FROM field_hits WHERE supplier_dir IS NOT NULL GROUP BY ALL)
SELECT project_id, supplier_dir, CASE WHEN codes > 1 THEN 'manual' WHEN codes = 1 THEN 'by_code' WHEN names = 1 THEN 'by_name' WHEN business THEN 'by_file' ELSE 'open' END AS bucket FROM g""")
def identity_buckets(spark, d):
    """How the identity of each group is known: several codes need a hand, one code or else one labelled name tells it, else files."""
    h = table(spark, d, "field_hits").where("supplier_dir IS NOT NULL")
    of = lambda ok, v: F.count_distinct(F.when(ok, v))
    g = h.groupBy("project_id", "supplier_dir").agg(of(F.col("field") == "uscc", F.upper(F.replace("value", F.lit(" "), F.lit("")))).alias("codes"), of((F.col("field") == "company_name") & F.col("via_label"), F.col("value")).alias("names"), F.max(F.col("relative_path").rlike("商务|资格|报价")).alias("business"))
    return g.select("project_id", "supplier_dir", F.when(F.col("codes") > 1, "manual").when(F.col("codes") == 1, "by_code").when(F.col("names") == 1, "by_name").when(F.col("business"), "by_file").otherwise("open").alias("bucket"))


_CLASS = (("price", "报价|开标一览"), ("business", "商务|资格"), ("technical", "技术"), ("authorization", "授权"))


@query("SELECT class, count(DISTINCT document_id) AS documents FROM (SELECT document_id, CASE " + " ".join(f"WHEN regexp_matches(relative_path, '{p}[^/]*$') THEN '{c}'" for c, p in ((c, f"(?:{p})") for c, p in _CLASS)) + " ELSE 'unknown' END AS class FROM field_hits) GROUP BY class")
def filename_classes(spark, d):
    c = F.lit("unknown")
    for name, p in reversed(_CLASS):
        c = F.when(F.col("relative_path").rlike(f"(?:{p})[^/]*$"), name).otherwise(c)
    return table(spark, d, "field_hits").groupBy(c.alias("class")).agg(F.count_distinct("document_id").alias("documents"))


#: Keys that no report input may hold (fixed values).
FORBIDDEN = ("confidence", "low_confidence", "label_bbox", "value_bbox", "method")


@query("SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(to_json(h))) AS key FROM field_hits h) WHERE key IN ('confidence', 'low_confidence', 'label_bbox', 'value_bbox', 'method') GROUP BY key")
def forbidden_keys(spark, d):
    """Forbidden keys of the rows as JSON, with the number of rows that hold them."""
    h = table(spark, d, "field_hits")
    keys = F.json_object_keys(F.to_json(F.struct(*h.columns), {"ignoreNullFields": "false"}))
    return h.select(F.explode(keys).alias("key")).where(F.col("key").isin(*FORBIDDEN)).groupBy("key").agg(F.count("*").alias("n"))


@query(f"""WITH k AS (SELECT unnest(['registration', 'ownership', 'penalty']) AS kind), r AS (SELECT {_DISPLAY.format('name')} AS name, record_kind AS kind, count(*) AS n, min(record_id) AS first_record FROM ({_KEYED}) WHERE name IS NOT NULL GROUP BY ALL)
SELECT supplier_id, k.kind, coalesce(r.n, 0) AS n, r.first_record FROM (SELECT supplier_id, {_DISPLAY.format('name')} AS name FROM query_subjects) s, k LEFT JOIN r ON r.name = s.name AND r.kind = k.kind""")
def registered_sections(spark, d):
    """Sections of each supplier, with rows also where nothing is registered."""
    r = _records(spark, d).where("name IS NOT NULL").groupBy(text.company_display(F.col("name")).alias("name"), F.col("record_kind").alias("kind")).agg(F.count("*").alias("n"), F.min("record_id").alias("first_record"))
    s = table(spark, d, "query_subjects").select("supplier_id", text.company_display(F.col("name")).alias("name"), F.explode(F.array(*map(F.lit, ("registration", "ownership", "penalty")))).alias("kind"))
    return s.join(r, ["name", "kind"], "left").select("supplier_id", "kind", F.coalesce("n", F.lit(0)).alias("n"), "first_record")


@query("""WITH v AS (SELECT DISTINCT project_id, supplier_dir, value FROM field_hits WHERE field = 'project_name' AND value IS NOT NULL AND supplier_dir IS NOT NULL), c AS (SELECT project_id, supplier_dir, count(*) AS n FROM v GROUP BY ALL)
SELECT a.project_id, a.supplier_dir AS party_a, b.supplier_dir AS party_b, count(*) AS common, count(*) = any_value(ca.n) AS a_in_b, count(*) = any_value(cb.n) AS b_in_a FROM v a JOIN v b ON a.project_id = b.project_id AND a.value = b.value AND a.supplier_dir < b.supplier_dir JOIN c ca ON ca.project_id = a.project_id AND ca.supplier_dir = a.supplier_dir JOIN c cb ON cb.project_id = b.project_id AND cb.supplier_dir = b.supplier_dir GROUP BY ALL""")
def value_subsets(spark, d):
    """Common values of two parties, and whether one party's values are all among the other's."""
    h = table(spark, d, "field_hits").where("field = 'project_name' AND value IS NOT NULL AND supplier_dir IS NOT NULL").select("project_id", "supplier_dir", "value").distinct()
    c = h.groupBy("project_id", "supplier_dir").agg(F.count("*").alias("n"))
    p = match.pairs_within(h, ["project_id", "value"], "supplier_dir").groupBy("project_id", "a", "b").agg(F.count("*").alias("common"))
    size = lambda side: c.select("project_id", F.col("supplier_dir").alias(side), F.col("n").alias(f"n_{side}"))
    j = p.join(size("a"), ["project_id", "a"]).join(size("b"), ["project_id", "b"])
    return j.select("project_id", F.col("a").alias("party_a"), F.col("b").alias("party_b"), "common", (F.col("common") == F.col("n_a")).alias("a_in_b"), (F.col("common") == F.col("n_b")).alias("b_in_a"))


@query("SELECT upper(replace(value, ' ', '')) AS code FROM field_hits WHERE field = 'uscc' AND value IS NOT NULL INTERSECT SELECT upper(replace(uscc, ' ', '')) FROM query_subjects WHERE uscc IS NOT NULL")
def codes_in_both(spark, d):
    flat = lambda c: F.upper(F.replace(c, F.lit(" "), F.lit(""))).alias("code")
    return table(spark, d, "field_hits").where("field = 'uscc' AND value IS NOT NULL").select(flat("value")).intersect(table(spark, d, "query_subjects").where("uscc IS NOT NULL").select(flat("uscc")))


@query("SELECT record_id, row_number() OVER (ORDER BY source_id, record_kind, record_id) AS place FROM adapter_records")
def canonical_order(spark, d):
    """Places in the order of output, without one task sorting all rows."""
    n = assemble.dense_number(table(spark, d, "adapter_records").select("source_id", "record_kind", "record_id"), ["source_id", "record_kind", "record_id"], "k")
    return n.select("record_id", (F.col("k") + 1).alias("place"))


_EVIDENCE = "evidence_id source_type document_path location field raw_value_masked normalized method confidence strength collected_at source_sha256 note".split()


@query("""SELECT evidence_id, CASE WHEN document_id LIKE 'DOC-%' THEN 'bid_document' ELSE 'procurement_document' END AS source_type, coalesce(relative_path, document_id, '') AS document_path, left(concat_ws(' ', 'page=' || page, 'label=' || label, 'label_relation=' || label_relation), 300) AS location, field,
coalesce(value, '') AS raw_value_masked, replace(coalesce(value, ''), ' ', '') AS normalized, method, confidence, CASE WHEN confidence < 0.85 THEN 'D' ELSE 'A' END AS strength, epoch_us(collected_at) AS collected_at, sha256(coalesce(relative_path, '')) AS source_sha256, '' AS note FROM field_hits QUALIFY row_number() OVER (PARTITION BY evidence_id ORDER BY hit_id) = 1""")
def evidence_rows(spark, d):
    """The thirteen columns of the evidence table, one row an evidence: its first delivery, its place as key=value texts."""
    h = table(spark, d, "field_hits").withColumn("__r", F.row_number().over(Window.partitionBy("evidence_id").orderBy("hit_id"))).where("__r = 1")
    kv = lambda c: F.concat(F.lit(f"{c}="), F.col(c).cast("string"))
    cols = {
        "source_type": F.when(F.col("document_id").like("DOC-%"), "bid_document").otherwise("procurement_document"),
        "document_path": F.coalesce("relative_path", "document_id", F.lit("")),
        "location": F.left(F.concat_ws(" ", kv("page"), kv("label"), kv("label_relation")), F.lit(300)),
        "raw_value_masked": F.coalesce("value", F.lit("")),
        "normalized": F.replace(F.coalesce("value", F.lit("")), F.lit(" "), F.lit("")),
        "strength": F.when(F.col("confidence") < 0.85, "D").otherwise("A"),
        "collected_at": F.unix_micros(F.col("collected_at").cast("timestamp")),
        "source_sha256": F.sha2(F.coalesce("relative_path", F.lit("")), 256),
        "note": F.lit(""),
    }
    return h.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in _EVIDENCE])


@query("""SELECT 'finding' AS kind, result_id::VARCHAR AS ref, coalesce(name, '') AS detail, confirmation AS reason FROM subject_results WHERE confirmation <> 'confirmed'
UNION ALL SELECT 'low_confidence', evidence_id, '', 'low confidence' FROM (SELECT DISTINCT evidence_id FROM field_hits WHERE confidence < 0.85)
UNION ALL SELECT 'decision', 'FIELD-' || scope || '-' || field, coalesce(nullif(array_to_string([x.value for x in list_slice(candidate_values, 1, 8)], '、'), ''), '未取得'), coalesce(reason, status) FROM field_decisions WHERE status <> 'selected'
UNION ALL SELECT 'inventory', pdf_id::VARCHAR, coalesce(supplier_dir, ''), 'no pages' FROM parsed_pdfs WHERE len(coalesce(pages, [])) = 0 OR supplier_dir IS NULL
UNION ALL SELECT 'unreadable', pdf_id::VARCHAR, document_id, array_to_string(issues, ',') FROM parsed_pdfs WHERE len(issues) > 0
UNION ALL SELECT 'content', block_id::VARCHAR, coalesce(document_id, ''), 'empty block' FROM ocr_blocks WHERE text IS NULL""")
def review_rows(spark, d):
    """The review queue from its six sources: open findings, low confidence, open decisions, inventory, unreadable files, contents."""
    part = lambda kind, df, ref, detail, reason: df.select(F.lit(kind).alias("kind"), ref.cast("string").alias("ref"), detail.alias("detail"), reason.alias("reason"))
    c = F.col
    none = F.lit("")
    dec = table(spark, d, "field_decisions").where("status <> 'selected'")
    pdfs = table(spark, d, "parsed_pdfs")
    shown = F.array_join(F.transform(F.slice("candidate_values", 1, 8), lambda x: x["value"]), "、")
    parts = [
        part("finding", table(spark, d, "subject_results").where("confirmation <> 'confirmed'"), c("result_id"), F.coalesce("name", none), c("confirmation")),
        part("low_confidence", table(spark, d, "field_hits").where("confidence < 0.85").select("evidence_id").distinct(), c("evidence_id"), none, F.lit("low confidence")),
        part("decision", dec, F.concat(F.lit("FIELD-"), "scope", F.lit("-"), "field"), F.coalesce(F.nullif(shown, none), F.lit("未取得")), F.coalesce("reason", "status")),
        part("inventory", pdfs.where("coalesce(size(pages), 0) <= 0 OR supplier_dir IS NULL"), c("pdf_id"), F.coalesce("supplier_dir", none), F.lit("no pages")),
        part("unreadable", pdfs.where("size(issues) > 0"), c("pdf_id"), c("document_id"), F.array_join("issues", ",")),
        part("content", table(spark, d, "ocr_blocks").where("text IS NULL"), c("block_id"), F.coalesce("document_id", none), F.lit("empty block")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""SELECT evidence_id, hit_id, field, value, relative_path, page FROM field_hits WHERE NOT coalesce(low_confidence, false)""")
def report_input(spark, d):
    """Report input: the fields of the workpaper without any key of quality or place on the page."""
    h = table(spark, d, "field_hits").where("NOT coalesce(low_confidence, false)")
    keep = [c for c in ("evidence_id", "hit_id", "field", "value", "relative_path", "page") if c not in FORBIDDEN]
    return h.select(*keep)


@query("""SELECT hit_id, CASE WHEN coalesce(low_confidence, false) THEN 'human_review_required' ELSE 'candidate' END AS state, CASE WHEN method = 'ocr' THEN 'recognised text' END AS reason, confidence, label_relation FROM field_hits""")
def workpaper(spark, d):
    h = table(spark, d, "field_hits")
    return h.select("hit_id", F.when(F.coalesce("low_confidence", F.lit(False)), "human_review_required").otherwise("candidate").alias("state"), F.when(F.col("method") == "ocr", "recognised text").alias("reason"), "confidence", "label_relation")


@query("""SELECT project_id, string_agg('- id: CL-' || lpad(k::VARCHAR, 3, '0') || chr(10) || '  confirmed: false' || chr(10) || '  text: ' || to_json(left(text, 80))::VARCHAR, chr(10) ORDER BY k) AS draft FROM (SELECT project_id, text, row_number() OVER (PARTITION BY project_id ORDER BY doc_id) AS k FROM documents WHERE doc_kind = 'clause' AND text IS NOT NULL) GROUP BY project_id""")
def clause_draft(spark, d):
    """A draft of each project's clauses with running ids, as YAML (whose double-quoted texts are those of JSON)."""
    c = table(spark, d, "documents").where("doc_kind = 'clause' AND text IS NOT NULL").select("project_id", "doc_id", F.left("text", F.lit(80)).alias("t"))
    k = c.withColumn("k", F.row_number().over(Window.partitionBy("project_id").orderBy("doc_id")))
    quoted = F.regexp_extract(F.to_json(F.struct("t")), "(?s)^\\{\"t\":(.*)\\}$", 1)
    line = F.concat(F.lit("- id: CL-"), F.lpad(F.col("k").cast("string"), 3, "0"), F.lit("\n  confirmed: false\n  text: "), quoted)
    rows = k.groupBy("project_id").agg(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))).alias("r"))
    return rows.select("project_id", F.array_join(F.transform("r", lambda x: x["line"]), "\n").alias("draft"))


@query("""SELECT document_id, sha256('{"document":' || to_json(document_id)::VARCHAR || ',"mode":' || coalesce(to_json(mode)::VARCHAR, 'null') || ',"redaction":' || coalesce(to_json(redaction)::VARCHAR, 'null') || '}') AS cache_key FROM (SELECT DISTINCT document_id, project_id FROM field_hits) LEFT JOIN (SELECT project_id, arg_max(external_query_mode, (saved_at, config_id)) AS mode, arg_max(redaction_mode, (saved_at, config_id)) AS redaction FROM project_configs GROUP BY 1) USING (project_id)""")
def cache_keys(spark, d):
    """Keys of cached documents: they change with the document and with the settings that its fields depend on."""
    c = table(spark, d, "project_configs")
    last = lambda k: F.max_by(k, F.struct("saved_at", "config_id"))
    c = c.groupBy("project_id").agg(last("external_query_mode").alias("mode"), last("redaction_mode").alias("redaction"))
    h = table(spark, d, "field_hits").select("document_id", "project_id").distinct().join(c, "project_id", "left")
    body = F.to_json(F.struct(F.col("document_id").alias("document"), "mode", "redaction"), {"ignoreNullFields": "false"})
    return h.select("document_id", F.sha2(body, 256).alias("cache_key"))


@query("""WITH r AS (SELECT source_id, record_kind, count(*) AS n FROM adapter_records GROUP BY ALL), f AS (SELECT record_id, source_id, record_kind, unnest(map_keys(fields)) AS k, unnest(map_values(fields)) AS v FROM adapter_records)
SELECT CASE WHEN k IN ('处罚决定文号', '行为') THEN 'penalty' WHEN k IN ('成立日期', 'founded') THEN 'registration' ELSE record_kind END AS section, source_id, count(*) AS n_fields, count(DISTINCT record_id) AS n_records FROM f WHERE trim(v) <> '' GROUP BY ALL
UNION ALL SELECT 'summary', source_id, 0, sum(n) FROM r GROUP BY source_id HAVING count(*) FILTER (record_kind = 'penalty') = 0""")
def section_records(spark, d):
    """Fields fanned out to the sections they belong to; a source without penalties gets a summary row instead."""
    r = table(spark, d, "adapter_records").select("record_id", "source_id", "record_kind", F.explode("fields").alias("k", "v")).where("trim(v) <> ''")
    section = F.when(F.col("k").isin("处罚决定文号", "行为"), "penalty").when(F.col("k").isin("成立日期", "founded"), "registration").otherwise(F.col("record_kind"))
    rows = r.groupBy(section.alias("section"), "source_id").agg(F.count("*").alias("n_fields"), F.count_distinct("record_id").alias("n_records"))
    none = table(spark, d, "adapter_records").groupBy("source_id").agg(F.count("*").alias("n_records"), F.count_if(F.col("record_kind") == "penalty").alias("p")).where("p = 0")
    return rows.unionByName(none.select(F.lit("summary").alias("section"), "source_id", F.lit(0).cast("bigint").alias("n_fields"), "n_records"))


@query("""SELECT doc_id AS ref, 'listing' AS origin FROM documents WHERE doc_kind = 'clause' AND source IS NOT NULL UNION ALL SELECT doc_id, 'inventory' FROM documents WHERE doc_kind = 'clause' AND source IS NULL AND doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_kind = 'clause' AND source IS NOT NULL)""")
def clause_documents(spark, d):
    """Documents of a listing, and those of the inventory that the listing lacks."""
    c = table(spark, d, "documents").where("doc_kind = 'clause'").select(F.col("doc_id").alias("ref"), "source")
    listed = c.where("source IS NOT NULL").select("ref", F.lit("listing").alias("origin"))
    return listed.unionByName(c.where("source IS NULL").join(listed.select("ref"), "ref", "left_anti").select("ref", F.lit("inventory").alias("origin")))


@query("""SELECT name, min(n)::INTEGER AS n, min(n) = 0 AS empty FROM (SELECT regexp_extract(t, '^(.*?)（([0-9]+)）$', 1) AS name, try_cast(regexp_extract(t, '^(.*?)（([0-9]+)）$', 2) AS INTEGER) AS n FROM (SELECT field || '（' || count(value) || '）' AS t FROM field_hits GROUP BY field)) GROUP BY name""")
def category_counts(spark, d):
    """Categories written as name（n）, read back into counts; a category that is not shown has none."""
    t = table(spark, d, "field_hits").groupBy("field").agg(F.concat("field", F.lit("（"), F.count("value").cast("string"), F.lit("）")).alias("t"))
    p = "^(.*?)（([0-9]+)）$"
    c = t.select(F.regexp_extract("t", p, 1).alias("name"), F.regexp_extract("t", p, 2).try_cast("int").alias("n"))
    return c.groupBy("name").agg(F.min("n").alias("n"), (F.min("n") == 0).alias("empty"))
