"""Queries on pages, blocks and field rows: admission, roles by layout, records of fields, predicates of labels and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.operators import extract, layout, pages
from sieveline.plans.registry import query
from sieveline.plans.values import wide
from sieveline.runtime import table


def _in(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _has(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def _pages(spark, d):
    return table(spark, d, "parsed_pdfs").select("pdf_id", "document_id", F.explode("pages").alias("p")).select("pdf_id", "document_id", "p.*")


_PAGES = "(SELECT pdf_id, document_id, p.page AS page, p.text AS text, p.has_text_layer AS has_text_layer, p.image_count AS image_count FROM (SELECT pdf_id, document_id, unnest(pages) AS p FROM parsed_pdfs))"
_COVER = f"coalesce({_has('text', pages.COVER_WORDS)} AND NOT contains(text, '授权委托书'), false)"


@query("SELECT document_id FROM parsed_pdfs WHERE NOT list_contains(coalesce(issues, []), 'partial') AND len(list_filter(coalesce(pages, []), lambda p: trim(coalesce(p.text, '')) <> '')) > 0")
def readable_documents(spark, d):
    """Documents that can be read whole and hold text."""
    p = table(spark, d, "parsed_pdfs")
    return p.where(~F.array_contains(F.coalesce("issues", F.array().cast("array<string>")), "partial") & F.exists("pages", lambda x: F.trim(F.coalesce(x["text"], F.lit(""))) != "")).select("document_id")


@query(f"SELECT pdf_id, page FROM {_PAGES} WHERE {_COVER}")
def cover_pages(spark, d):
    return _pages(spark, d).where(pages.looks_like_cover(F.col("text"))).select("pdf_id", "page")


@query(f"""WITH c AS (SELECT DISTINCT document_id FROM {_PAGES} WHERE page = 1 AND {_COVER})
SELECT hit_id, field NOT IN ({_in(pages.COVER_FIELDS)}) OR (coalesce(page = 1, false) AND c.document_id IS NOT NULL) AS admitted FROM field_hits LEFT JOIN c USING (document_id)""")
def field_admission(spark, d):
    """Public fields count only from a first page that is a cover; all others from anywhere."""
    c = _pages(spark, d).where((F.col("page") == 1) & pages.looks_like_cover(F.col("text"))).select("document_id").distinct().withColumn("cover", F.lit(True))
    h = table(spark, d, "field_hits").select("hit_id", "document_id", "field", "page").join(c, "document_id", "left")
    ok = ~F.col("field").isin(*pages.COVER_FIELDS) | (F.coalesce(F.col("page") == 1, F.lit(False)) & F.col("cover").isNotNull())
    return h.select("hit_id", ok.alias("admitted"))


@query(f"""SELECT pdf_id, page, CASE WHEN NOT has_text_layer THEN 'scanned' ELSE 'image_in_text' END AS reason, CASE WHEN page <= 3 OR {_has("replace(coalesce(text, ''), ' ', '')", pages.IMAGE_PAGE_WORDS)} THEN 'identity_fast' ELSE 'normal' END AS priority
FROM {_PAGES} WHERE image_count > 0 AND (NOT has_text_layer OR {_has("replace(coalesce(text, ''), ' ', '')", pages.IMAGE_PAGE_WORDS)})""")
def recognition_jobs(spark, d):
    """Pages to recognise: without text layer, or with images beside words of licences; first pages and such words come first."""
    marked = pages.any_of(F.replace(F.coalesce("text", F.lit("")), F.lit(" "), F.lit("")), pages.IMAGE_PAGE_WORDS)
    p = _pages(spark, d).where((F.col("image_count") > 0) & (~F.col("has_text_layer") | marked))
    return p.select("pdf_id", "page", F.when(~F.col("has_text_layer"), "scanned").otherwise("image_in_text").alias("reason"), F.when((F.col("page") <= 3) | marked, "identity_fast").otherwise("normal").alias("priority"))


#: Keys of properties that prove little, as file-name patterns (fixed values).
LIMITED_KEYS = ("*date*", "xmp:*", "producer*", "cre?tor*")


@query("SELECT DISTINCT pdf_id, k AS key, coalesce(bool_or(lower(k) GLOB p), false) AS limited FROM (SELECT pdf_id, unnest(map_keys(metadata)) AS k FROM parsed_pdfs), (SELECT unnest([" + _in(LIMITED_KEYS) + "]) AS p) GROUP BY pdf_id, k")
def limited_keys(spark, d):
    m = table(spark, d, "parsed_pdfs").select("pdf_id", F.explode(F.map_keys("metadata")).alias("key"))
    return m.select("pdf_id", "key", F.lower("key").rlike("|".join(map(pages.glob, LIMITED_KEYS))).alias("limited"))


@query("""WITH c AS (SELECT project_id, arg_max(project_name, (saved_at, config_id)) AS name FROM project_configs WHERE project_name IS NOT NULL AND project_name <> '' GROUP BY project_id)
SELECT hit_id, project_id FROM field_hits JOIN c USING (project_id) WHERE contains(value, name)""")
def mentions_project(spark, d):
    c = table(spark, d, "project_configs").where("project_name IS NOT NULL AND project_name <> ''").groupBy("project_id").agg(F.max_by("project_name", F.struct("saved_at", "config_id")).alias("name"))
    h = table(spark, d, "field_hits").select("hit_id", "project_id", "value")
    return h.join(c, "project_id").where(F.contains("value", F.col("name"))).select("hit_id", "project_id")


_LOOSE = "^bids/(?:(?:inbox|incoming|uploads)/.*|[^/]+)$"


@query(f"SELECT project_id, bool_or(coalesce(regexp_matches(relative_path, '{_LOOSE}'), false)) AS needs_grouping FROM field_hits GROUP BY project_id")
def requires_grouping(spark, d):
    loose = F.coalesce(F.col("relative_path").rlike(_LOOSE), F.lit(False))
    return table(spark, d, "field_hits").groupBy("project_id").agg(F.max(loose).alias("needs_grouping"))


_LABEL_KEY = "regexp_replace(regexp_replace(lower(" + wide("label") + "), '^\\s*[0-9]+(?:\\.[0-9]+)*[.、)）]?\\s*', ''), '[\\s:：,，。;；()（）\\[\\]【】、.\\-]', '', 'g')"


@query(f"SELECT l AS label_key, n, length(l) BETWEEN 2 AND 80 AND l NOT IN ({_in(pages.GENERIC_LABELS)}) AND NOT regexp_matches(l, '^[0-9.]+$') AND {_has('l', pages.METRIC_WORDS)} AS is_metric FROM (SELECT {_LABEL_KEY} AS l, count(*) AS n FROM (SELECT label FROM field_hits WHERE label IS NOT NULL UNION ALL SELECT regexp_extract(text, '^([^:：]+)[:：]', 1) FROM ocr_blocks WHERE text IS NOT NULL) GROUP BY 1)")
def metric_labels(spark, d):
    a = table(spark, d, "field_hits").where("label IS NOT NULL").select("label")
    b = table(spark, d, "ocr_blocks").where("text IS NOT NULL").select(F.regexp_extract("text", "^([^:：]+)[:：]", 1).alias("label"))
    one = a.unionByName(b).groupBy(text.label_key(F.col("label")).alias("label_key")).agg(F.count("*").alias("n"))
    return one.select("label_key", "n", pages.looks_like_metric(F.col("label_key")).alias("is_metric"))


_STEM = "regexp_extract(relative_path, '([^/]*?)(?:\\.[^./]*)?$', 1)"


@query(f"""SELECT path, score, score >= 4 AND {_has('lower(stem)', pages.TEMPLATE_NAMES)} AS candidate FROM (SELECT path, stem, CASE WHEN regexp_matches(path, '(^|/)procurement/') THEN 1 ELSE 0 END + {' + '.join(f"CASE WHEN contains(stem, '{w}') THEN 3 ELSE 0 END" for w in pages.TEMPLATE_WORDS)} AS score
FROM (SELECT DISTINCT relative_path AS path, {_STEM} AS stem FROM (SELECT relative_path FROM field_hits UNION ALL SELECT 'procurement/' || doc_kind || '/技术参数模板.docx' FROM documents)) WHERE path IS NOT NULL)""")
def template_candidates(spark, d):
    p = table(spark, d, "field_hits").select("relative_path").unionByName(table(spark, d, "documents").select(F.concat(F.lit("procurement/"), "doc_kind", F.lit("/技术参数模板.docx")).alias("relative_path")))
    p = p.where("relative_path IS NOT NULL").distinct().select(F.col("relative_path").alias("path"), pages.template_score(F.col("relative_path")).alias("score"), F.lower(F.regexp_extract("relative_path", "([^/]*?)(?:\\.[^./]*)?$", 1)).alias("stem"))
    return p.select("path", "score", ((F.col("score") >= 4) & pages.any_of(F.col("stem"), pages.TEMPLATE_NAMES)).alias("candidate"))


_CUTS = "|".join("\\" + w if w == "(" else w for w in extract.NAME_CUTS)


def _clean(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '(?s)(?:{_CUTS}).*$', ''), '^[\\s：:，,]+|[\\s：:，,]+$', '', 'g')"


def _name_ok(c: str) -> str:
    return f"(regexp_matches({c}, '^[\\x{{4e00}}-\\x{{9fa5}}·A-Za-z]{{2,8}}$') AND {c} NOT IN ({_in(sorted(extract.NOT_NAMES))}) AND left({c}, 1) NOT IN ({_in(sorted(extract.NO_NAME_START))}) AND NOT {_has(c, extract.NO_NAME_PARTS)})"


_PERSON = ("legal_rep_name", "bid_agent_name", "shareholder_name", "contact_name")


@query(f"SELECT hit_id, n AS cleaned, {_name_ok('n')} AS plausible FROM (SELECT hit_id, {_clean('value')} AS n FROM field_hits WHERE value IS NOT NULL AND field IN ({_in(_PERSON)}))")
def cleaned_names(spark, d):
    h = table(spark, d, "field_hits").where(F.col("value").isNotNull() & F.col("field").isin(*_PERSON)).select("hit_id", pages.name_cleaned(F.col("value")).alias("cleaned"))
    return h.select("hit_id", "cleaned", pages.name_plausible(F.col("cleaned")).alias("plausible"))


_V = "regexp_replace(value, '^[\\s：:，,；;]+|[\\s：:，,；;]+$', '', 'g')"
_PROJECT_OK = f"(length(w) BETWEEN 8 AND 120 AND {_has('w', extract.PROJECT_WORDS)} AND NOT {_has('w', extract.PROJECT_NOISE)})"


@query(f"""SELECT hit_id, CASE WHEN v <> '' AND length(v) <= 80 THEN CASE WHEN field IN ({_in(_PERSON)}) THEN CASE WHEN {_name_ok('n')} THEN n END WHEN field = 'project_name' THEN CASE WHEN {_PROJECT_OK} THEN v END
WHEN field = 'tenderer' THEN CASE WHEN length(w) <= 80 AND regexp_matches(w, '(?:公司|厂|中心|单位)$') THEN v END WHEN field IN ('address', 'bid_date', 'project_code') THEN v END END AS coerced
FROM (SELECT *, {_clean('v')} AS n, regexp_replace(v, '\\s', '', 'g') AS w FROM (SELECT hit_id, field, {_V} AS v FROM field_hits WHERE value IS NOT NULL))""")
def coerced_values(spark, d):
    return table(spark, d, "field_hits").where("value IS NOT NULL").select("hit_id", pages.coerced(F.col("field"), F.col("value")).alias("coerced"))


@query("""WITH b AS (SELECT document_id, page, regexp_extract(text, '([1-9][0-9]{16}[0-9Xx])', 1) AS v, regexp_matches(text, '授权|委托') AS m, bbox.x + bbox.width / 2 AS x, bbox.y + bbox.height / 2 AS y FROM ocr_blocks WHERE text IS NOT NULL AND bbox IS NOT NULL),
p AS (SELECT document_id, page FROM b GROUP BY ALL HAVING bool_or(m) AND count(DISTINCT CASE WHEN v <> '' THEN v END) >= 2),
o AS (SELECT document_id, page, v, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM b SEMI JOIN p USING (document_id, page) WHERE v <> '' GROUP BY ALL)
SELECT document_id, page, CASE WHEN max(x) - min(x) >= 0.12 THEN 'x' ELSE 'y' END AS axis, CASE WHEN max(x) - min(x) >= 0.12 THEN arg_min(v, (x, v)) ELSE arg_min(v, (y, v)) END AS first_id, CASE WHEN max(x) - min(x) >= 0.12 THEN arg_max(v, (x, v)) ELSE arg_max(v, (y, v)) END AS last_id FROM o GROUP BY document_id, page""")
def id_roles(spark, d):
    return pages.id_roles(table(spark, d, "ocr_blocks"), ["document_id", "page"], "授权|委托")


_TOPS = "regexp_replace({}, '\\s', '', 'g')"


def _proj(c: str) -> str:
    return _PROJECT_OK.replace("(w", "(" + _TOPS.format(c)).replace("contains(w", "contains(" + _TOPS.format(c))


@query(f"""WITH b AS (SELECT document_id, page, block_id, block_no, trim(text) AS t, confidence AS c, coalesce(bbox.y, 1.0) AS y FROM ocr_blocks WHERE text IS NOT NULL AND trim(text) <> ''),
k AS (SELECT *, bool_or(contains(t, '投标文件') OR contains(t, '采购')) OVER (PARTITION BY document_id, page) AS cover FROM b),
l AS (SELECT *, lead(t, 1) OVER w AS t1, lead(t, 2) OVER w AS t2, lead(y, 1) OVER w AS y1, lead(y, 2) OVER w AS y2, lead(c, 1) OVER w AS c1, lead(c, 2) OVER w AS c2, row_number() OVER w AS i FROM k WHERE cover AND y <= 0.9 AND NOT contains(t, '项目编号') WINDOW w AS (PARTITION BY document_id, page ORDER BY y, block_no, block_id)),
m AS (SELECT *, CASE WHEN coalesce(y1 - y <= 0.2, false) AND {_proj('(t || t1)')} THEN {{'v': t || t1, 'c': least(c, c1)}} WHEN coalesce(y1 - y <= 0.2, false) AND coalesce(y2 - y <= 0.2, false) AND {_proj('(t || t1 || t2)')} THEN {{'v': t || t1 || t2, 'c': least(c, c2)}} END AS p FROM l)
SELECT * FROM (SELECT document_id, page, min(CASE WHEN i = 1 AND length(regexp_replace(t, '\\s', '', 'g')) <= 80 AND regexp_matches(regexp_replace(t, '\\s', '', 'g'), '(?:公司|厂|中心|单位)$') THEN t END) AS tenderer, arg_min(p.v, i) AS project_name, arg_min(p.c, CASE WHEN p IS NOT NULL THEN i END) AS confidence FROM m GROUP BY ALL) WHERE tenderer IS NOT NULL OR project_name IS NOT NULL""")
def cover_titles(spark, d):
    """Titles of pages on bids or purchases, over most of the page (the tables hold no covers)."""
    return pages.cover_titles(table(spark, d, "ocr_blocks"), ["document_id", "page"], ("投标文件", "采购"), 0.9, 0.2)


_METRICS = (("address", "地址"), ("address", "注册地址"), ("phone", "联系电话"), ("phone", "电话"), ("email", "E-mail"), ("date", "日期"))
_METRIC_SQL = "(VALUES " + ", ".join(f"('{m}', '{w}')" for m, w in _METRICS) + ") m(metric, label)"


@query(f"""WITH b AS (SELECT document_id, page, block_id, bbox, regexp_replace(text, '\\s', '', 'g') AS t FROM ocr_blocks WHERE text IS NOT NULL AND trim(text) <> ''),
h AS (SELECT block_id, document_id, page, arg_max(metric, (length(label), metric, label)) AS metric, arg_max(label, (length(label), metric, label)) AS label FROM b JOIN {_METRIC_SQL} ON starts_with(t, label) GROUP BY ALL),
g AS (SELECT b.*, h.metric, h.label FROM b LEFT JOIN h USING (document_id, page, block_id)),
l AS (SELECT *, CASE WHEN substr(t, length(label) + 1, 1) IN (':', '：') THEN substr(t, length(label) + 2) END AS rest FROM g WHERE metric IS NOT NULL),
n AS (SELECT l.document_id, l.page, l.metric, v.block_id, v.t AS value, (v.bbox.y + v.bbox.height / 2) - (l.bbox.y + l.bbox.height / 2) AS dy, v.bbox.x - (l.bbox.x + l.bbox.width) AS dx, l.bbox AS lb, v.bbox AS vb FROM l JOIN g v ON v.document_id = l.document_id AND v.page = l.page WHERE l.rest IS NULL AND l.t = l.label AND l.bbox IS NOT NULL AND v.metric IS NULL AND v.bbox IS NOT NULL),
s AS (SELECT document_id, page, metric, block_id, value, round(CASE WHEN abs(dy) <= greatest(2.5 * lb.height, 0.045) AND dx >= 0 THEN abs(dy) + 0.05 * dx WHEN dy > 0 AND dy <= greatest(5 * lb.height, 0.12) AND abs(vb.x - lb.x) <= 0.18 THEN 0.2 + dy END, 6) AS score, 'near' AS relation FROM n),
u AS (SELECT document_id, page, metric, block_id, value, score, relation FROM s WHERE score IS NOT NULL UNION ALL SELECT document_id, page, metric, block_id, rest, 0.0, 'inline' FROM l WHERE rest <> '')
SELECT document_id, page, metric, arg_min(value, (score, block_id, value)) AS value, arg_min(relation, (score, block_id, value)) AS relation FROM u GROUP BY document_id, page, metric""")
def template_metrics(spark, d):
    m = spark.createDataFrame(list(_METRICS), "metric string, label string")
    return pages.metric_values(table(spark, d, "ocr_blocks"), m, ["document_id", "page"])


_W = wide("value")
_EXT = "(?i)(?:转|分机|ext\\.?|x\\.?)\\s*([0-9]{1,6})\\s*$"
_MAIN = f"ltrim(regexp_replace(regexp_replace({_W}, '{_EXT}', ''), '[\\s\\-－–—‐.（）()]', '', 'g'), '+86')"
_EXTN = f"regexp_extract({_W}, '{_EXT}', 1)"
_DIG = f"upper(regexp_replace({_W}, '\\s', '', 'g'))"
_MASKED = f"CASE WHEN length({_DIG}) < 8 THEN repeat('*', length({_DIG})) ELSE left({_DIG}, 4) || '**********' || right({_DIG}, 4) END"
_MOBILE = f"(length({_MAIN}) = 11 AND {_MAIN} LIKE '1%')"


@query(f"""SELECT hit_id, field, CASE WHEN field = 'legal_rep_id' THEN {_MASKED} WHEN field = 'phone' AND {_MOBILE} THEN left({_MAIN}, 3) || '****' || substr({_MAIN}, 8) ELSE value END AS value_masked,
CASE WHEN field = 'legal_rep_id' THEN NULL WHEN field = 'uscc' THEN nullif(regexp_replace(upper({_W}), '[ \\t]', '', 'g'), '') WHEN field = 'phone' THEN CASE WHEN {_MOBILE} THEN 'P' || left(sha256('salt' || {_MAIN}), 16) ELSE {_MAIN} || CASE WHEN {_EXTN} <> '' THEN '转' || {_EXTN} ELSE '' END END
WHEN field = 'email' THEN replace(lower(trim({_W})), ' ', '') WHEN field = 'address' THEN regexp_replace({_W}, '[\\s.。,，、;；:：\\-－–—]', '', 'g') WHEN field = 'project_code' THEN coalesce(nullif(regexp_extract(trim(replace(value, ' ', '')), '[A-Za-z0-9][A-Za-z0-9_\\-/]{{3,}}'), ''), trim(replace(value, ' ', ''))) ELSE trim(replace(value, ' ', '')) END AS normalized,
CASE WHEN field = 'legal_rep_id' THEN left(sha256('salt' || {_DIG}), 16) END AS digest, coalesce(confidence, 0) < 0.85 AS low, method || CASE WHEN field = 'legal_rep_id' THEN '+id_digest' ELSE '' END AS method FROM field_hits WHERE value IS NOT NULL AND field <> 'company_name'""")
def field_records(spark, d):
    """Field rows as they are kept: masked, normalised by field, with a digest of identity numbers and the mark of low confidence."""
    h = table(spark, d, "field_hits").where("value IS NOT NULL AND field <> 'company_name'")
    f, v = F.col("field"), F.col("value")
    main, ext = text.phone_main(v), text.phone_extension(v)
    mobile = (F.length(main) == 11) & main.startswith("1")
    flat = F.trim(F.replace(v, F.lit(" "), F.lit("")))
    code = F.regexp_extract(flat, "[A-Za-z0-9][A-Za-z0-9_\\-/]{3,}", 0)
    masked = F.when(f == "legal_rep_id", text.identity_mask(v)).when((f == "phone") & mobile, F.concat(F.left(main, F.lit(3)), F.lit("****"), F.substr(main, F.lit(8)))).otherwise(v)
    normal = (
        F.when(f == "legal_rep_id", None)
        .when(f == "uscc", F.nullif(text.credit_code(v), F.lit("")))
        .when(f == "phone", F.when(mobile, F.concat(F.lit("P"), F.left(F.sha2(F.concat(F.lit("salt"), main), 256), F.lit(16)))).otherwise(F.concat(main, F.when(ext != "", F.concat(F.lit("转"), ext)).otherwise(""))))
        .when(f == "email", text.email_key(v))
        .when(f == "address", text.address_key(v))
        .when(f == "project_code", F.coalesce(F.nullif(code, F.lit("")), flat))
        .otherwise(flat)
    )
    digest = F.when(f == "legal_rep_id", text.identity_digest(v, "salt"))
    method = F.concat("method", F.when(f == "legal_rep_id", "+id_digest").otherwise(""))
    return h.select("hit_id", "field", masked.alias("value_masked"), normal.alias("normalized"), digest.alias("digest"), (F.coalesce("confidence", F.lit(0.0)) < 0.85).alias("low"), method.alias("method"))


_LABELS = sorted({w for w in extract.FIELD_OF if not w.isascii()})


@query(f"SELECT block_id, arg_max(w, (length(w), w)) AS label FROM (SELECT block_id, regexp_replace(text, '\\s', '', 'g') AS t FROM ocr_blocks WHERE text IS NOT NULL) JOIN (SELECT unnest([{_in(_LABELS)}]) AS w) ON starts_with(t, w) GROUP BY block_id")
def longest_label(spark, d):
    """The longest label that begins a block: labels are tried from the longest to the shortest."""
    t = F.regexp_replace("text", "\\s", "")
    pattern = "^(?:" + "|".join(sorted(_LABELS, key=lambda w: (-len(w), w))) + ")"
    return table(spark, d, "ocr_blocks").where("text IS NOT NULL").select("block_id", F.regexp_extract(t, pattern, 0).alias("label")).where("label <> ''")


@query("""WITH b AS (SELECT block_id, bbox.x * 1000 AS x0, bbox.y * 1400 AS y0, (bbox.x + bbox.width) * 1000 AS x1, (bbox.y - bbox.height) * 1400 AS y1 FROM ocr_blocks WHERE bbox IS NOT NULL),
c AS (SELECT block_id, least(greatest(least(x0, x1), 0.0), 1000.0) AS a, least(greatest(greatest(x0, x1), 0.0), 1000.0) AS b, least(greatest(least(y0, y1), 0.0), 1400.0) AS c, least(greatest(greatest(y0, y1), 0.0), 1400.0) AS d FROM b)
SELECT block_id, round(a / 1000.0, 4) AS x, round(c / 1400.0, 4) AS y, round((b - a) / 1000.0, 4) AS width, round((d - c) / 1400.0, 4) AS height FROM c""")
def boxes_normalised(spark, d):
    b = table(spark, d, "ocr_blocks").where("bbox IS NOT NULL").select("block_id", (F.col("bbox.x") * 1000).alias("x0"), (F.col("bbox.y") * 1400).alias("y0"), ((F.col("bbox.x") + F.col("bbox.width")) * 1000).alias("x1"), ((F.col("bbox.y") - F.col("bbox.height")) * 1400).alias("y1"))
    n = b.select("block_id", text.box_normalised(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.lit(1000.0), F.lit(1400.0)).alias("n"))
    return n.select("block_id", *[F.round(f"n.{k}", 4).alias(k) for k in ("x", "y", "width", "height")])


@query("""WITH c AS (SELECT job_id AS sheet, CAST(round(bbox.y * 25) AS INT) AS r, CAST(round(bbox.x * 10) AS INT) AS k, min(text) AS t FROM ocr_blocks WHERE text IS NOT NULL AND bbox IS NOT NULL GROUP BY ALL),
l AS (SELECT c.*, m.field FROM c LEFT JOIN (VALUES ('法定代表人', 'legal_rep_name'), ('日期', 'bid_date'), ('青岚园林集团', 'company_name')) m(label, field) ON starts_with(regexp_replace(t, '[\\s:：]', '', 'g'), label)),
n AS (SELECT a.sheet, a.r, a.k, a.field, s.p, v.t FROM l a, (VALUES (0, 0, 1), (1, 0, 2), (2, 1, 0)) s(p, dr, dk) JOIN l v ON v.sheet = a.sheet AND v.r = a.r + s.dr AND v.k = a.k + s.dk WHERE a.field IS NOT NULL AND v.field IS NULL AND trim(v.t) <> '')
SELECT sheet, r AS "row", k AS col, field, arg_min(t, (p, t)) AS value FROM n GROUP BY ALL""")
def cell_values(spark, d):
    """Blocks as cells of a grid: for each label cell the first of its right, second right and lower neighbours without label."""
    b = table(spark, d, "ocr_blocks").where("text IS NOT NULL AND bbox IS NOT NULL")
    c = b.groupBy(F.col("job_id").alias("sheet"), F.round(F.col("bbox.y") * 25).cast("int").alias("row"), F.round(F.col("bbox.x") * 10).cast("int").alias("col")).agg(F.min("text").alias("text"))
    key = F.regexp_replace("text", "[\\s:：]", "")
    tag = F.when(key.startswith("法定代表人"), "legal_rep_name").when(key.startswith("日期"), "bid_date").when(key.startswith("青岚园林集团"), "company_name")
    return layout.adjacent(c.withColumn("field", tag)).select("sheet", "row", "col", "field", "value")


@query("""SELECT record_id, list_filter([trim(regexp_replace(coalesce(fields[k], ''), '[\\s\\p{Z}]+', ' ', 'g')) for k in ['企业名称', '信用代码']], lambda x: x <> '') AS cells FROM adapter_records WHERE coalesce(fields['企业名称'], '') <> ''""")
def html_cells(spark, d):
    """Cells of rows of HTML tables: written out and read again, with tags stripped and signs resolved."""
    esc = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    name, code = esc(F.element_at("fields", F.lit("企业名称"))), esc(F.element_at("fields", F.lit("信用代码")))
    html = F.concat(F.lit("<table><TR class=a><td><b>"), name, F.lit("</b></td>\n<td x>"), code, F.lit("</td></TR></table>"))
    rows = table(spark, d, "adapter_records").where("coalesce(element_at(fields, '企业名称'), '') <> ''").select("record_id", text.table_rows(html)[0].alias("c"))
    return rows.select("record_id", F.filter("c", lambda x: x != "").alias("cells"))


@query()
def page_fields(spark, d):
    """Field rows of all pages of parsed documents, by the scanner, with their place and evidence."""
    p = table(spark, d, "parsed_pdfs").select(F.col("document_id").alias("relative_path"), "pages")
    p = p.select("relative_path", F.explode("pages").alias("p")).where("p.text <> ''")
    u = p.select("relative_path", F.lit("pdf_page").alias("kind"), F.col("p.page").cast("string").alias("place"), F.col("p.text").alias("text"), ((F.col("p.page") == 1) & pages.looks_like_cover(F.col("p.text"))).alias("cover"))
    return pages.unit_fields(u)


@query()
def recognised_fields(spark, d):
    """Field rows of recognised blocks: by layout where a label stands alone, else by the scanner with less confidence."""
    labels = spark.createDataFrame([(w, f) for w, f in extract.FIELD_OF.items()], "label string, field string")
    return pages.recognised_fields(table(spark, d, "ocr_blocks"), labels, ["document_id", "page"])
