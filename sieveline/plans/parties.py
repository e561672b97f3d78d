"""Queries on parties: classes of files, ladders of identity, values collected by key, selections and pair-level aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.operators import match, pages
from sieveline.operators.assemble import all_or_nothing
from sieveline.plans.registry import query
from sieveline.plans.values import wide
from sieveline.runtime import table

_DIR = "supplier_dir IS NOT NULL AND value IS NOT NULL"

#: Words of a first page and of a file name, in the order in which they are tried (fixed values).
BY_CONTENT = (("bid_schedule", ("投标一览表", "开标一览表", "投标报价")), ("technical", ("技术部分", "技术标", "投标文件(技术)")), ("business", ("商务部分", "商务标", "投标文件(商务)")), ("cover", ("封面",)))
BY_NAME = (("bid_schedule", (".xlsx", ".xls", "一览", "报价")), ("technical", ("技术", "technical", "tech")), ("cover", ("封面", "cover")), ("business", ("商务", "business", "授权", "营业执照", "声明", "扫描")))


def _case(c: str, table_) -> str:
    return " ".join("WHEN " + " OR ".join(f"contains({c}, '{w}')" for w in words) + f" THEN '{kind}'" for kind, words in table_)


@query(f"""WITH p AS (SELECT document_id, min(p.text) AS t FROM (SELECT document_id, unnest(pages) AS p FROM parsed_pdfs) WHERE p.page = 1 GROUP BY 1), h AS (SELECT document_id, lower(regexp_extract(min(relative_path), '[^/]*$')) AS n FROM field_hits GROUP BY 1)
SELECT document_id, CASE {_case('c', BY_CONTENT)} {_case('n', BY_NAME)} ELSE 'unknown' END AS subtype FROM (SELECT document_id, coalesce(regexp_replace(t, '[ \\n]', '', 'g'), '') AS c, coalesce(n, '') AS n FROM h FULL JOIN p USING (document_id))""")
def bid_subtype(spark, d):
    """Class of each document: what its first page says, else its file name, else unknown."""
    p = table(spark, d, "parsed_pdfs").select("document_id", F.explode("pages").alias("p")).where("p.page = 1").groupBy("document_id").agg(F.min("p.text").alias("t"))
    h = table(spark, d, "field_hits").groupBy("document_id").agg(F.lower(F.regexp_extract(F.min("relative_path"), "([^/]*)$", 1)).alias("n"))
    j = h.join(p, "document_id", "full").select("document_id", F.coalesce(F.regexp_replace("t", "[ \\n]", ""), F.lit("")).alias("c"), F.coalesce("n", F.lit("")).alias("n"))
    kind = F.lit("unknown")
    for column, rows in (("n", BY_NAME), ("c", BY_CONTENT)):
        for name, words in reversed(rows):
            kind = F.when(pages.any_of(F.col(column), words), name).otherwise(kind)
    return j.select("document_id", kind.alias("subtype"))


@query("""WITH r AS (SELECT DISTINCT coalesce(fields['企业名称'], fields['当事人'], fields['name']) AS name FROM adapter_records), q AS (SELECT DISTINCT name FROM subject_results WHERE name IS NOT NULL)
SELECT subject_id, CASE WHEN q.name IS NOT NULL THEN 'queried' WHEN r.name IS NOT NULL THEN 'needs_manual_review' ELSE 'not_queried' END AS state FROM query_subjects s LEFT JOIN r ON r.name = s.name LEFT JOIN q ON q.name = s.name""")
def same_name_placeholder(spark, d):
    """Subjects without query of their own need a hand where a record has their name; else they were not queried."""
    get = F.coalesce(*[F.element_at("fields", F.lit(k)) for k in ("企业名称", "当事人", "name")])
    r = table(spark, d, "adapter_records").select(get.alias("name")).where("name IS NOT NULL").distinct().withColumn("r", F.lit(True))
    q = table(spark, d, "subject_results").select("name").where("name IS NOT NULL").distinct().withColumn("q", F.lit(True))
    s = table(spark, d, "query_subjects").select("subject_id", "name").join(r, "name", "left").join(q, "name", "left")
    return s.select("subject_id", F.when(F.col("q"), "queried").when(F.col("r"), "needs_manual_review").otherwise("not_queried").alias("state"))


_PROJECT_FIELDS = ("project_name", "project_code", "tenderer", "bid_date")


@query("""WITH v AS (SELECT project_id, field, count(DISTINCT value) AS k, min(value) AS v FROM field_hits WHERE value IS NOT NULL AND confidence >= 0.85 AND field IN ('project_name', 'project_code', 'tenderer', 'bid_date') GROUP BY ALL)
SELECT p.project_id, f.field, CASE WHEN v.k IS NULL THEN 'missing' WHEN v.k > 1 THEN 'conflict' ELSE 'selected' END AS status, CASE WHEN v.k = 1 THEN v.v END AS value FROM (SELECT DISTINCT project_id FROM field_hits) p CROSS JOIN (SELECT unnest(['project_name', 'project_code', 'tenderer', 'bid_date']) AS field) f LEFT JOIN v USING (project_id, field)""")
def project_decisions(spark, d):
    """A decision for each of the four fields of every project, also where nothing was found."""
    h = table(spark, d, "field_hits")
    v = h.where(F.col("value").isNotNull() & (F.col("confidence") >= 0.85) & F.col("field").isin(*_PROJECT_FIELDS)).groupBy("project_id", "field").agg(F.count_distinct("value").alias("k"), F.min("value").alias("v"))
    every = h.select("project_id").distinct().select("project_id", F.explode(F.array(*map(F.lit, _PROJECT_FIELDS))).alias("field"))
    status = F.when(F.col("k").isNull(), "missing").when(F.col("k") > 1, "conflict").otherwise("selected")
    return every.join(v, ["project_id", "field"], "left").select("project_id", "field", status.alias("status"), F.when(F.col("k") == 1, F.col("v")).alias("value"))


_CODE = f"regexp_replace(upper({wide('value')}), '[ \\t]', '', 'g')"
_WEIGHTED = " + ".join(f"(strpos('0123456789ABCDEFGHJKLMNPQRTUWXY', substr(c, {i + 1}, 1)) - 1) * {pow(3, i, 31)}" for i in range(17))


@query(f"""WITH v AS (SELECT project_id, supplier_dir, c, regexp_matches(c, '^[0-9A-HJ-NPQRTUWXY]{{18}}$') AND substr('0123456789ABCDEFGHJKLMNPQRTUWXY', ((31 - ({_WEIGHTED}) % 31) % 31 + 1)::BIGINT, 1) = substr(c, 18, 1) AS ok FROM (SELECT DISTINCT project_id, supplier_dir, {_CODE} AS c FROM field_hits WHERE field = 'uscc' AND {_DIR}))
SELECT project_id, supplier_dir, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid, CASE WHEN count(*) FILTER (ok) = 1 THEN min(c) FILTER (ok) END AS code, CASE WHEN count(*) FILTER (ok) = 1 AND count(*) FILTER (NOT ok) = 0 THEN 'confirmed' WHEN count(*) FILTER (ok) = 1 THEN 'probable' WHEN count(*) FILTER (ok) > 1 THEN 'conflict' ELSE 'unreadable' END AS ladder FROM v GROUP BY project_id, supplier_dir""")
def supplier_ladder(spark, d):
    """Identity of each party by its codes: one valid code is confirmed, with others unreadable probable, several are a conflict."""
    v = table(spark, d, "field_hits").where(f"field = 'uscc' AND {_DIR}").select("project_id", "supplier_dir", text.credit_code(F.col("value")).alias("c")).distinct()
    v = v.withColumn("ok", text.credit_status(F.col("c")) == "valid")
    g = v.groupBy("project_id", "supplier_dir").agg(F.count_if("ok").alias("valid"), F.count_if(~F.col("ok")).alias("invalid"), F.min(F.when(F.col("ok"), F.col("c"))).alias("c"))
    ladder = F.when((F.col("valid") == 1) & (F.col("invalid") == 0), "confirmed").when(F.col("valid") == 1, "probable").when(F.col("valid") > 1, "conflict").otherwise("unreadable")
    return g.select("project_id", "supplier_dir", "valid", "invalid", F.when(F.col("valid") == 1, F.col("c")).alias("code"), ladder.alias("ladder"))


_DIG = f"left(sha256('salt' || upper(regexp_replace({wide('value')}, '\\s', '', 'g'))), 16)"


@query(f"""WITH n AS (SELECT DISTINCT project_id, supplier_dir, value AS name FROM field_hits WHERE field = 'legal_rep_name' AND {_DIR}), i AS (SELECT DISTINCT project_id, supplier_dir, {_DIG} AS digest FROM field_hits WHERE field = 'legal_rep_id' AND {_DIR}),
c AS (SELECT project_id, supplier_dir, count(DISTINCT digest) AS k, min(digest) AS digest FROM i GROUP BY ALL), m AS (SELECT project_id, supplier_dir, count(*) AS k FROM n GROUP BY ALL)
SELECT n.project_id, n.supplier_dir, n.name, CASE WHEN c.k = 1 AND m.k = 1 THEN c.digest END AS digest FROM n JOIN m USING (project_id, supplier_dir) LEFT JOIN c USING (project_id, supplier_dir)
UNION ALL SELECT i.project_id, i.supplier_dir, NULL, i.digest FROM i LEFT JOIN c USING (project_id, supplier_dir) LEFT JOIN m USING (project_id, supplier_dir) WHERE NOT (c.k = 1 AND coalesce(m.k, 0) = 1)""")
def party_roles(spark, d):
    """Representatives of a party: the number goes with the name where there is one of each, other numbers stand without a name."""
    h = table(spark, d, "field_hits").where(_DIR)
    key = ["project_id", "supplier_dir"]
    n = h.where("field = 'legal_rep_name'").select(*key, F.col("value").alias("name")).distinct()
    i = h.where("field = 'legal_rep_id'").select(*key, text.identity_digest(F.col("value"), "salt").alias("digest")).distinct()
    c = i.groupBy(*key).agg(F.count("*").alias("ids"), F.min("digest").alias("one"))
    m = n.groupBy(*key).agg(F.count("*").alias("names"))
    linked = (F.col("ids") == 1) & (F.col("names") == 1)
    named = n.join(m, key).join(c, key, "left").select(*key, "name", F.when(linked, F.col("one")).alias("digest"))
    rest = i.join(c, key).join(m, key, "left").where(~F.coalesce(linked, F.lit(False))).select(*key, F.lit(None).cast("string").alias("name"), "digest")
    return named.unionByName(rest)


@query("""SELECT label, count(value) FILTER (source_id = 'srm') AS srm, count(value) FILTER (source_id = 'government_procurement') AS procurement, count(value) FILTER (source_id = 'registry_intl') AS registry FROM (SELECT source_id, unnest(map_keys(fields)) AS label, nullif(trim(unnest(map_values(fields))), '') AS value FROM adapter_records) GROUP BY label HAVING count(value) > 0""")
def registration_pivot(spark, d):
    """Labels by sources, without labels that no source fills."""
    r = table(spark, d, "adapter_records").select("source_id", F.explode("fields").alias("label", "value")).where("trim(value) <> ''")
    p = r.groupBy("label").pivot("source_id", ["srm", "government_procurement", "registry_intl"]).count()
    return p.select("label", *[F.coalesce(c, F.lit(0)).alias(n) for c, n in (("srm", "srm"), ("government_procurement", "procurement"), ("registry_intl", "registry"))])


@query(f"""WITH s AS (SELECT DISTINCT project_id, value FROM field_hits WHERE field = 'company_name' AND {_DIR})
SELECT t.project_id, min(t.value) AS tenderer, count(*) AS n FROM field_hits t ANTI JOIN s ON s.project_id = t.project_id AND s.value = t.value WHERE t.field = 'tenderer' AND t.value IS NOT NULL GROUP BY t.project_id HAVING count(DISTINCT t.value) = 1""")
def tenderer_candidates(spark, d):
    """The tenderer of a project where exactly one name stands that is no supplier of it."""
    h = table(spark, d, "field_hits")
    s = h.where(f"field = 'company_name' AND {_DIR}").select("project_id", "value").distinct()
    t = h.where("field = 'tenderer' AND value IS NOT NULL").select("project_id", "value").join(s, ["project_id", "value"], "left_anti")
    return t.groupBy("project_id").agg(F.min("value").alias("tenderer"), F.count("*").alias("n"), F.count_distinct("value").alias("k")).where("k = 1").drop("k")


_NUMBER = "[0-9]{8,}[Xx]?"


@query(f"""WITH k AS (SELECT DISTINCT project_id, regexp_extract(value, '{_NUMBER}') AS t FROM field_hits WHERE field IN ('legal_rep_id', 'phone') AND value IS NOT NULL), h AS (SELECT hit_id, project_id, unnest(list_distinct(regexp_extract_all(value, '{_NUMBER}'))) AS t FROM field_hits WHERE value IS NOT NULL),
m AS (SELECT hit_id, list_sort(list(t)) AS vs FROM h JOIN k USING (project_id, t) WHERE t <> '' GROUP BY hit_id)
SELECT hit_id, list_reduce(list_prepend(value, coalesce(vs, [])), lambda a, x: replace(a, x, '***')) AS redacted FROM field_hits LEFT JOIN m USING (hit_id) WHERE value IS NOT NULL""")
def redacted_known(spark, d):
    """Values with the known numbers of their project replaced: the numbers of a value are looked up by join, so that no value
    meets all numbers of its project."""
    h = table(spark, d, "field_hits").where("value IS NOT NULL")
    k = h.where(F.col("field").isin("legal_rep_id", "phone")).select("project_id", F.regexp_extract("value", _NUMBER, 0).alias("t")).where("t <> ''").distinct()
    asked = h.select("hit_id", "project_id", F.explode(F.array_distinct(F.regexp_extract_all("value", F.lit(_NUMBER), F.lit(0)))).alias("t"))
    m = asked.join(k, ["project_id", "t"]).groupBy("hit_id").agg(F.array_sort(F.collect_list("t")).alias("vs"))
    j = h.select("hit_id", "value").join(m, "hit_id", "left")
    none = F.array().cast("array<string>")
    return j.select("hit_id", F.aggregate(F.coalesce("vs", none), F.col("value"), lambda a, x: F.replace(a, x, F.lit("***"))).alias("redacted"))


@query("""SELECT result_id, CASE WHEN regexp_matches(coalesce(detail, ''), '(?i)token|cookie|password|密码') THEN '[hidden]' ELSE left(coalesce(detail, ''), 240) END AS detail, left(regexp_replace(coalesce(profile_ref, ''), '[?#].*$', ''), 80) AS ref FROM subject_results""")
def safe_details(spark, d):
    """Details cut to 240 characters and hidden where they hold a secret; references without what follows their path."""
    c = F.coalesce("detail", F.lit(""))
    detail = F.when(c.rlike("(?i)token|cookie|password|密码"), "[hidden]").otherwise(F.left(c, F.lit(240)))
    return table(spark, d, "subject_results").select("result_id", detail.alias("detail"), F.left(F.regexp_replace(F.coalesce("profile_ref", F.lit("")), "[?#].*$", ""), F.lit(80)).alias("ref"))


@query("""SELECT pdf_id, k AS key, CASE WHEN leaf IN ('make', 'model', 'software', 'producer') THEN 'device' ELSE leaf END AS independence, CASE WHEN leaf IN ('serial', 'documentid', 'instanceid') THEN 'unique' WHEN leaf IN ('author', 'company', 'creationdate', 'moddate', 'metadatadate') THEN 'limited' ELSE 'common' END AS info
FROM (SELECT pdf_id, k, lower(split_part(split_part(k, '.', -1), ':', -1)) AS leaf FROM (SELECT pdf_id, unnest(map_keys(metadata)) AS k FROM parsed_pdfs))""")
def metadata_classes(spark, d):
    """Leaf of each property, devices as one kind of evidence, and how much a common value says."""
    m = table(spark, d, "parsed_pdfs").select("pdf_id", F.explode(F.map_keys("metadata")).alias("key"))
    leaf = F.lower(F.element_at(F.split(F.element_at(F.split("key", "\\."), -1), ":"), -1))
    info = F.when(leaf.isin("serial", "documentid", "instanceid"), "unique").when(leaf.isin("author", "company", "creationdate", "moddate", "metadatadate"), "limited").otherwise("common")
    return m.select("pdf_id", "key", F.when(leaf.isin("make", "model", "software", "producer"), "device").otherwise(leaf).alias("independence"), info.alias("info"))


_KEY = f"CASE WHEN field = 'legal_rep_id' THEN {_DIG} WHEN field = 'email' THEN replace(lower(trim({wide('value')})), ' ', '') ELSE regexp_replace({wide('value')}, '\\s+', '', 'g') END"


@query(f"""SELECT project_id, supplier_dir, field, k AS value_key, arg_min(value, hit_id) AS display, count(*) AS hits, array_to_string(list_sort(list(DISTINCT evidence_id)), ',') AS evidence FROM (SELECT *, {_KEY} AS k FROM field_hits WHERE {_DIR} AND confidence >= 0.85 AND field IN ('email', 'phone', 'legal_rep_id')) GROUP BY ALL""")
def value_collection(spark, d):
    """Values of each party by their key (digest, normal form, or text), as first written, with all evidence."""
    h = table(spark, d, "field_hits").where(f"{_DIR} AND confidence >= 0.85 AND field IN ('email', 'phone', 'legal_rep_id')")
    v = F.col("value")
    key = F.when(F.col("field") == "legal_rep_id", text.identity_digest(v, "salt")).when(F.col("field") == "email", text.email_key(v)).otherwise(F.regexp_replace(text.half_width(v), "\\s+", ""))
    return h.groupBy("project_id", "supplier_dir", "field", key.alias("value_key")).agg(F.min_by("value", "hit_id").alias("display"), F.count("*").alias("hits"), F.array_join(F.array_sort(F.collect_set("evidence_id")), ",").alias("evidence"))


@query("""WITH c AS (SELECT s.subject_id, s.name AS sn, s.uscc AS sc, r.result_id, r.name AS rn, r.uscc AS rc FROM query_subjects s JOIN subject_results r ON r.name = s.name OR r.uscc = s.uscc),
g AS (SELECT subject_id, count(DISTINCT CASE WHEN rn = sn THEN result_id END) AS names, min(CASE WHEN rn = sn THEN result_id END) AS by_name, bool_or(coalesce(rn = sn AND rc <> sc, false)) AS clash, count(DISTINCT CASE WHEN rc = sc THEN result_id END) AS codes, min(CASE WHEN rc = sc THEN result_id END) AS by_code FROM c GROUP BY subject_id)
SELECT subject_id, CASE WHEN names = 1 AND NOT clash THEN by_name WHEN names = 0 AND codes = 1 THEN by_code END AS result_id, CASE WHEN names = 1 AND NOT clash THEN 'name' WHEN names = 0 AND codes = 1 THEN 'code' WHEN clash THEN 'conflict' ELSE 'ambiguous' END AS how FROM g""")
def candidate_selection(spark, d):
    """The only result with a subject's exact name, unless its code differs; without any such name the only one with its code."""
    s = table(spark, d, "query_subjects").select("subject_id", F.col("name").alias("sn"), F.col("uscc").alias("sc"))
    r = table(spark, d, "subject_results").select("result_id", F.col("name").alias("rn"), F.col("uscc").alias("rc"))
    c = s.join(r, F.col("rn") == F.col("sn")).unionByName(s.join(r, F.col("rc") == F.col("sc"))).distinct()
    name, code = F.col("rn") == F.col("sn"), F.col("rc") == F.col("sc")
    clash = F.max(F.coalesce(name & (F.col("rc") != F.col("sc")), F.lit(False)))
    g = c.groupBy("subject_id").agg(F.count_distinct(F.when(name, F.col("result_id"))).alias("names"), F.min(F.when(name, F.col("result_id"))).alias("by_name"), clash.alias("clash"), F.count_distinct(F.when(code, F.col("result_id"))).alias("codes"), F.min(F.when(code, F.col("result_id"))).alias("by_code"))
    one, other = (F.col("names") == 1) & ~F.col("clash"), (F.col("names") == 0) & (F.col("codes") == 1)
    return g.select("subject_id", F.when(one, F.col("by_name")).when(other, F.col("by_code")).alias("result_id"), F.when(one, "name").when(other, "code").when(F.col("clash"), "conflict").otherwise("ambiguous").alias("how"))


@query("""WITH j AS (SELECT document_id, max(len(pages)) AS n FROM parsed_pdfs GROUP BY 1), c AS (SELECT o.block_id, j.n IS NOT NULL AS job, coalesce(o.page BETWEEN 1 AND j.n, false) AS page, coalesce(o.confidence BETWEEN 0 AND 1, false) AS confidence, coalesce(o.text IS NOT NULL, false) AS text, coalesce(o.bbox.x >= 0 AND o.bbox.x + o.bbox.width <= 1.0 AND o.bbox.y >= 0 AND o.bbox.y + o.bbox.height <= 1.0, o.bbox IS NULL) AS bbox, coalesce(o.block_no >= 0, false) AS place FROM ocr_blocks o LEFT JOIN j USING (document_id))
SELECT block_id, concat_ws(',', CASE WHEN NOT job THEN 'job' END, CASE WHEN NOT page THEN 'page' END, CASE WHEN NOT confidence THEN 'confidence' END, CASE WHEN NOT text THEN 'text' END, CASE WHEN NOT bbox THEN 'bbox' END, CASE WHEN NOT place THEN 'place' END) AS errors FROM c""")
def ocr_contract(spark, d):
    """All breaches of the contract of each recognised block, not only the first."""
    j = table(spark, d, "parsed_pdfs").groupBy("document_id").agg(F.max(F.size("pages")).alias("n"))
    o = table(spark, d, "ocr_blocks").join(j, "document_id", "left")
    b = lambda k: F.col(f"bbox.{k}")
    box = F.coalesce((b("x") >= 0) & (b("x") + b("width") <= 1.0) & (b("y") >= 0) & (b("y") + b("height") <= 1.0), F.col("bbox").isNull())
    checks = {"job": F.col("n").isNotNull(), "page": F.col("page").between(1, F.col("n")), "confidence": F.col("confidence").between(0, 1), "text": F.col("text").isNotNull(), "bbox": box, "place": F.col("block_no") >= 0}
    return all_or_nothing(o, checks).select("block_id", F.concat_ws(",", "errors").alias("errors"))


@query("""WITH m AS (SELECT DISTINCT project_id, supplier_dir, k, v FROM (SELECT project_id, supplier_dir, unnest(map_keys(metadata)) AS k, unnest(map_values(metadata)) AS v FROM parsed_pdfs) WHERE supplier_dir IS NOT NULL AND lower(trim(v)) NOT IN ('', 'admin', 'administrator', 'user', 'unknown')),
p AS (SELECT a.project_id, a.supplier_dir AS party_a, b.supplier_dir AS party_b, count(DISTINCT a.k) AS kinds, count(*) FILTER (a.k = 'Author') AS authors, count(*) FILTER (a.k <> 'Author' AND a.k <> 'Producer') AS times FROM m a JOIN m b USING (project_id, k, v) WHERE a.supplier_dir < b.supplier_dir GROUP BY ALL)
SELECT *, CASE WHEN times > 0 THEN 'unique' WHEN kinds >= 2 THEN 'limited' ELSE 'common' END AS strength FROM p""")
def pair_metadata(spark, d):
    """Common properties of two parties by their kind, and how strong they are together."""
    m = table(spark, d, "parsed_pdfs").where("supplier_dir IS NOT NULL").select("project_id", "supplier_dir", F.explode("metadata").alias("k", "v")).where("lower(trim(v)) NOT IN ('', 'admin', 'administrator', 'user', 'unknown')").distinct()
    p = match.pairs_within(m, ["project_id", "k", "v"], "supplier_dir").groupBy("project_id", F.col("a").alias("party_a"), F.col("b").alias("party_b"))
    p = p.agg(F.count_distinct("k").alias("kinds"), F.count_if(F.col("k") == "Author").alias("authors"), F.count_if(~F.col("k").isin("Author", "Producer")).alias("times"))
    return p.withColumn("strength", F.when(F.col("times") > 0, "unique").when(F.col("kinds") >= 2, "limited").otherwise("common"))
