"""Queries on single values: identifiers, names, contacts, dates, hashes, classes of rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.functions import moments, text
from sieveline.operators import decide, extract
from sieveline.plans.registry import query
from sieveline.runtime import table

_W = "chr(12288)"
#: DuckDB's side of the native half-width subset: translate over the same characters.
WIDTH = f"translate({{}}, '{text.WIDE[:-1]}' || {_W}, '{text.NARROW[:-1].replace(chr(39), chr(39) * 2)}' || ' ')"


def wide(c: str) -> str:
    return WIDTH.replace("{}", c)


@query()
def p6_found(spark, d):
    return moments.found(spark, table(spark, d, "parsed_pdfs"), table(spark, d, "adapter_records"), table(spark, d, "project_configs"))


@query()
def p6_ambiguous(spark, d):
    """Deadlines whose local time meets no or two intervals of its zone."""
    df = moments.matches(table(spark, d, "project_configs").select("config_id", "bid_deadline", "tz_name"), "bid_deadline", "tz_name")
    return df.where(F.col("n_intervals").isin(0, 2)).select("config_id", "n_intervals")


@query(
    f"""WITH c AS (SELECT hit_id, coalesce(regexp_replace(upper({wide('value')}), '[ \\t]', '', 'g'), '') AS code FROM field_hits WHERE field = 'uscc')
    SELECT hit_id, code, CASE WHEN code = '' THEN 'absent' WHEN length(code) <> 18 THEN 'length_error'
      WHEN NOT regexp_full_match(code, '[{text.CODE_ALPHABET}]+') THEN 'charset_error'
      WHEN substr('{text.CODE_ALPHABET}', ((31 - list_sum([(instr('{text.CODE_ALPHABET}', substr(code, i, 1)) - 1) * [{', '.join(str(pow(3, i, 31)) for i in range(17))}][i] for i in range(1, 18)]) % 31) % 31 + 1)::INT, 1) <> substr(code, 18, 1) THEN 'check_digit_error'
      ELSE 'valid' END AS status FROM c"""
)
def uscc_checksum(spark, d):
    h = table(spark, d, "field_hits").where("field = 'uscc'")
    return h.select("hit_id", text.credit_code(F.col("value")).alias("code"), text.credit_status(F.col("value")).alias("status"))


@query(
    f"""SELECT hit_id, CASE WHEN value IS NULL THEN NULL WHEN NOT regexp_full_match(value, '[0-9]{{17}}[0-9Xx]') THEN false
      ELSE substr('{text.ID_CHECK}', (list_sum([substr(value, i, 1)::INT * {list(text.ID_WEIGHTS)}[i] for i in range(1, 18)]) % 11 + 1)::INT, 1) = upper(substr(value, 18, 1)) END AS valid
    FROM field_hits WHERE field = 'legal_rep_id' AND value IS NOT NULL"""
)
def id18_check(spark, d):
    h = table(spark, d, "field_hits").where("field = 'legal_rep_id' AND value IS NOT NULL")
    return h.select("hit_id", text.identity_valid(F.col("value")).alias("valid"))


_KEY = f"regexp_replace({wide('name')}, '[\\s\\x{{85}}\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{3000}}]+', '', 'g')"
_ENDED = _KEY
for _ in range(3):
    _ENDED = f"regexp_replace({_ENDED}, '(?:{text.ORG_ENDINGS})$', '')"


@query(f"SELECT result_id, {_KEY} AS name_key, regexp_replace({_ENDED}, '[（(][^）)]*[）)]$', '') AS search_key FROM subject_results WHERE name IS NOT NULL")
def name_search_key(spark, d):
    s = table(spark, d, "subject_results").where("name IS NOT NULL")
    return s.select("result_id", text.company_key(F.col("name")).alias("name_key"), text.search_key(F.col("name")).alias("search_key"))


_EXT = "(?i)(?:转|分机|ext\\.?|x\\.?)\\s*([0-9]{1,6})\\s*$"


@query(f"SELECT hit_id, ltrim(regexp_replace(regexp_replace({wide('value')}, '{_EXT}', ''), '[\\s\\-－–—‐.（）()]', '', 'g'), '+86') AS main, regexp_extract({wide('value')}, '{_EXT}', 1) AS extension FROM field_hits WHERE field = 'phone' AND value IS NOT NULL")
def phone_normalized(spark, d):
    h = table(spark, d, "field_hits").where("field = 'phone' AND value IS NOT NULL")
    return h.select("hit_id", text.phone_main(F.col("value")).alias("main"), text.phone_extension(F.col("value")).alias("extension"))


@query(f"SELECT hit_id, replace(lower(trim({wide('value')})), ' ', '') AS email FROM field_hits WHERE field = 'email' AND value IS NOT NULL")
def email_normalized(spark, d):
    return table(spark, d, "field_hits").where("field = 'email' AND value IS NOT NULL").select("hit_id", text.email_key(F.col("value")).alias("email"))


_ADDR = f"regexp_replace({wide('value')}, '[\\s.。,，、;；:：\\-－–—]', '', 'g')"


@query(
    f"""WITH k AS (SELECT hit_id, {_ADDR} AS k FROM field_hits WHERE field = 'address' AND value IS NOT NULL),
    p AS (SELECT hit_id, k, regexp_extract(k, '^(.*?(?:省|自治区))', 1) AS prov FROM k), c AS (SELECT *, substr(k, length(prov) + 1) AS r FROM p),
    e AS (SELECT *, regexp_extract(r, '^(.*?市)', 1) AS city FROM c)
    SELECT hit_id, k AS address_key, prov || city || regexp_extract(substr(r, length(city) + 1), '^(.*?(?:区|县|旗))', 1) AS region_key FROM e"""
)
def address_keys(spark, d):
    h = table(spark, d, "field_hits").where("field = 'address' AND value IS NOT NULL")
    return h.select("hit_id", text.address_key(F.col("value")).alias("address_key"), text.region_key(F.col("value")).alias("region_key"))


_DIG = f"upper(regexp_replace({wide('value')}, '\\s', '', 'g'))"


@query(f"SELECT hit_id, CASE WHEN length({_DIG}) < 8 THEN repeat('*', length({_DIG})) ELSE left({_DIG}, 4) || '**********' || right({_DIG}, 4) END AS masked, left(sha256('salt' || {_DIG}), 16) AS digest FROM field_hits WHERE field = 'legal_rep_id' AND value IS NOT NULL")
def id_mask_digest(spark, d):
    h = table(spark, d, "field_hits").where("field = 'legal_rep_id' AND value IS NOT NULL")
    return h.select("hit_id", text.identity_mask(F.col("value")).alias("masked"), text.identity_digest(F.col("value"), "salt").alias("digest"))


@query("SELECT block_id, regexp_replace(text, '(^|[^0-9])(1[3-9][0-9])[0-9]{4}([0-9]{4})($|[^0-9])', '\\1\\2****\\3\\4', 'g') AS redacted FROM ocr_blocks WHERE text IS NOT NULL")
def redacted_text(spark, d):
    return table(spark, d, "ocr_blocks").where("text IS NOT NULL").select("block_id", text.mobile_redacted(F.col("text")).alias("redacted"))


@query("SELECT block_id, array_to_string(list_slice(regexp_extract_all(text, '1[3-9][0-9]{9}'), 1, 5), '|') AS leaks FROM ocr_blocks WHERE regexp_matches(text, '1[3-9][0-9]{9}')")
def sensitive_leak_scan(spark, d):
    found = F.regexp_extract_all("text", F.lit("1[3-9][0-9]{9}"), F.lit(0))
    return table(spark, d, "ocr_blocks").where(F.col("text").rlike("1[3-9][0-9]{9}")).select("block_id", F.array_join(F.slice(found, 1, 5), "|").alias("leaks"))


_D = "^\\s*([0-9]{4})\\s*[-/.年]\\s*([0-9]{1,2})\\s*[-/.月]\\s*([0-9]{1,2})"


@query(f"WITH t AS (SELECT record_id, {wide('effective_from')} AS t FROM adapter_records) SELECT record_id, CASE WHEN regexp_extract(t, '{_D}', 1) <> '' THEN try_strptime(regexp_extract(t, '{_D}', 1) || '-' || lpad(regexp_extract(t, '{_D}', 2), 2, '0') || '-' || lpad(regexp_extract(t, '{_D}', 3), 2, '0'), '%Y-%m-%d')::DATE END AS day FROM t")
def iso_dates(spark, d):
    return table(spark, d, "adapter_records").select("record_id", text.iso_day(F.col("effective_from")).alias("day"))


@query("SELECT hit_id, 'EV-' || left(sha256('{\"document_id\":' || to_json(document_id) || ',\"field\":' || to_json(field) || ',\"value\":' || coalesce(to_json(value)::VARCHAR, 'null') || '}'), 12) AS stable_id FROM field_hits")
def stable_ids(spark, d):
    h = table(spark, d, "field_hits")
    return h.select("hit_id", text.stable_id("EV-", document_id=F.col("document_id"), field=F.col("field"), value=F.col("value")).alias("stable_id"))


@query("SELECT vec_id, [CASE WHEN x::DOUBLE * 64 >= list_sum([y::DOUBLE for y in embedding]) THEN 1 ELSE 0 END for x in embedding] AS bits FROM embeddings")
def ahash_bits(spark, d):
    total = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double"))
    return table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.when(x.cast("double") * 64 >= total, 1).otherwise(0)).alias("bits"))


@query("""WITH b AS (SELECT vec_id, [CASE WHEN x::DOUBLE * 64 >= list_sum([y::DOUBLE for y in embedding]) THEN 1 ELSE 0 END for x in embedding] AS b FROM embeddings)
SELECT vec_id, array_to_string([substr('0123456789abcdef', b[4 * i - 3] * 8 + b[4 * i - 2] * 4 + b[4 * i - 1] * 2 + b[4 * i] + 1, 1) for i in range(1, 17)], '') AS fingerprint FROM b""")
def ahash_fingerprint(spark, d):
    return table(spark, d, "embeddings").select("vec_id", text.average_hash(F.col("embedding")).alias("fingerprint"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def props_json_path(spark, d):
    return table(spark, d, "events").select("event_id", text.json_path(F.col("props"), "k").cast("bigint").alias("k"))


@query("SELECT hit_id, regexp_replace(regexp_replace(lower(" + wide("label") + "), '^\\s*[0-9]+(?:\\.[0-9]+)*[.、)）]?\\s*', ''), '[\\s:：,，。;；()（）\\[\\]【】、.\\-]', '', 'g') AS label_key FROM field_hits WHERE label IS NOT NULL")
def label_keys(spark, d):
    return table(spark, d, "field_hits").where("label IS NOT NULL").select("hit_id", text.label_key(F.col("label")).alias("label_key"))


@query("SELECT DISTINCT name, trim(regexp_replace(name, '[（(](?:公章|盖章|签章)[）)]\\s*$', '')) AS display FROM subject_results WHERE name IS NOT NULL")
def company_display(spark, d):
    return table(spark, d, "subject_results").where("name IS NOT NULL").select("name", text.company_display(F.col("name")).alias("display")).distinct()


@query("SELECT p_partkey, chr((65 + (p_size - 1) % 26)::INT) AS letter, CASE WHEN p_size > 26 THEN 'A' ELSE '' END || chr((65 + (p_size - 1) % 26)::INT) AS letters, p_size AS back FROM part")
def column_letter_roundtrip(spark, d):
    p = table(spark, d, "part").withColumn("letters", text.column_letters(F.col("p_size")))
    return p.select("p_partkey", F.right("letters", F.lit(1)).alias("letter"), "letters", text.column_number(F.col("letters")).alias("back"))


# classes of rows


@query(
    """SELECT doc_id, CASE WHEN t LIKE '%授权委托%' THEN 'authorization' WHEN t LIKE '%报价%' OR t LIKE '%单价%' THEN 'bid_schedule' WHEN t LIKE '%技术%' OR t LIKE '%规格%' THEN 'technical'
       WHEN t LIKE '%投标人%' OR t LIKE '%投标文件%' THEN 'business' ELSE 'unknown' END AS subtype FROM (SELECT doc_id, regexp_replace(text, '\\s+', '', 'g') AS t FROM documents)"""
)
def document_subtype(spark, d):
    t = F.regexp_replace("text", "\\s+", "")
    has = lambda *w: F.coalesce(t.rlike("|".join(w)), F.lit(False))
    kind = F.when(has("授权委托"), "authorization").when(has("报价", "单价"), "bid_schedule").when(has("技术", "规格"), "technical").when(has("投标人", "投标文件"), "business").otherwise("unknown")
    return table(spark, d, "documents").select("doc_id", kind.alias("subtype"))


@query("SELECT pdf_id, p.page AS page, CASE WHEN p.page <= 3 THEN 'identity_fast' ELSE 'normal' END AS priority FROM (SELECT pdf_id, unnest(pages) AS p FROM parsed_pdfs) WHERE coalesce(trim(p.text), '') = '' AND p.image_count > 0")
def ocr_page_jobs(spark, d):
    p = table(spark, d, "parsed_pdfs").select("pdf_id", F.explode("pages").alias("p"))
    need = (F.coalesce(F.trim("p.text"), F.lit("")) == "") & (F.col("p.image_count") > 0)
    return p.where(need).select("pdf_id", "p.page", F.when(F.col("p.page") <= 3, "identity_fast").otherwise("normal").alias("priority"))


@query("""SELECT hit_id, confidence < 0.85 AS low, (regexp_matches(lower(relative_path), '\\.(pdf|png|jpe?g|tiff?)$') AND coalesce(page >= 1, false)) OR value_bbox IS NOT NULL OR coalesce(method = 'table', false) AS traceable FROM field_hits""")
def match_eligibility(spark, d):
    h = table(spark, d, "field_hits")
    place = F.coalesce(decide.traceable(F.col("relative_path"), F.col("page"), F.col("value_bbox"), F.col("method")), F.lit(False))
    return h.select("hit_id", decide.low_confidence(F.col("confidence")).alias("low"), place.alias("traceable"))


@query("""SELECT pdf_id, k AS key, lower(split_part(split_part(k, ':', -1), '.', -1)) AS leaf, CASE WHEN lower(split_part(k, ':', -1)) IN ('creationdate', 'moddate', 'metadatadate') THEN 'limited' WHEN lower(k) IN ('author', 'company') THEN 'limited' WHEN lower(k) IN ('producer', 'creator') THEN 'common' ELSE 'other' END AS info_class, v AS value
FROM (SELECT pdf_id, unnest(map_keys(metadata)) AS k, unnest(map_values(metadata)) AS v FROM parsed_pdfs)""")
def metadata_fields(spark, d):
    m = table(spark, d, "parsed_pdfs").select("pdf_id", F.explode("metadata").alias("key", "value"))
    last = F.lower(F.element_at(F.split("key", ":"), -1))
    kind = F.when(last.isin("creationdate", "moddate", "metadatadate"), "limited").when(F.lower("key").isin("author", "company"), "limited").when(F.lower("key").isin("producer", "creator"), "common").otherwise("other")
    return m.select("pdf_id", "key", F.element_at(F.split(last, "\\."), -1).alias("leaf"), kind.alias("info_class"), "value")


@query("SELECT record_id, coalesce(nullif(nullif(fields['企业名称'], '-'), '暂无'), nullif(fields['当事人'], '-'), fields['name']) AS name, array_to_string(list_sort([k for k in map_keys(fields) if k NOT IN ('行为', '处罚决定文号')]), ',') AS kept FROM adapter_records")
def first_field_value(spark, d):
    r = table(spark, d, "adapter_records")
    name = F.coalesce(F.nullif(F.nullif(F.element_at("fields", F.lit("企业名称")), F.lit("-")), F.lit("暂无")), F.nullif(F.element_at("fields", F.lit("当事人")), F.lit("-")), F.element_at("fields", F.lit("name")))
    kept = F.array_join(F.array_sort(F.map_keys(F.map_filter("fields", lambda k, v: ~k.isin("行为", "处罚决定文号")))), ",")
    return r.select("record_id", name.alias("name"), kept.alias("kept"))


@query("SELECT hit_id, CASE WHEN confidence < 0.85 THEN 'human_review_required' WHEN method = 'ocr' THEN 'candidate_ocr' ELSE 'candidate' END AS state, regexp_matches(value, '[分支]公司[）)]?$') AS branch FROM field_hits WHERE value IS NOT NULL")
def review_state(spark, d):
    state = F.when(decide.low_confidence(F.col("confidence")), "human_review_required").when(F.col("method") == "ocr", "candidate_ocr").otherwise("candidate")
    return table(spark, d, "field_hits").where("value IS NOT NULL").select("hit_id", state.alias("state"), F.col("value").rlike("[分支]公司[）)]?$").alias("branch"))


# extraction


@query("SELECT block_id, array_to_string(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'), '|') AS emails FROM ocr_blocks WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')")
def email_fields(spark, d):
    p = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
    return table(spark, d, "ocr_blocks").where(F.col("text").rlike(p)).select("block_id", F.array_join(F.regexp_extract_all("text", F.lit(p), F.lit(0)), "|").alias("emails"))


@query("SELECT doc_id, list_filter([try_cast(replace(x, ',', '') AS DOUBLE) for x in regexp_extract_all(text, '([0-9]{1,3}(?:,[0-9]{3})+(?:\\.[0-9]+)?|[0-9]+(?:\\.[0-9]+)?)', 1)], lambda v: v IS NOT NULL AND v < 1e9) AS amounts FROM documents WHERE text IS NOT NULL")
def amount_fields(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", text.amounts(F.col("text")).alias("amounts"))


@query()
def inline_fields(spark, d):
    return extract.fields(table(spark, d, "ocr_blocks").where("text IS NOT NULL"), "text", "block_id").select("block_id", "ord", "field", "value", "via_label")


@query("SELECT doc_id, unnest([s for s in [trim(x) for x in regexp_split_to_array(regexp_replace(text, '([。；;！!])', '\\1\n', 'g'), '\n')] if length(s) BETWEEN 8 AND 200 AND regexp_matches(s, '" + "|".join(extract.KEYWORDS) + "')]) AS sentence FROM documents WHERE text IS NOT NULL")
def clause_sentences(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.explode(extract.clause_sentences(F.col("text"))).alias("sentence"))


@query("SELECT DISTINCT doc_id, topic FROM documents JOIN (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in extract.KEYWORDS.items()) + ") k(word, topic) ON contains(text, word)")
def clause_topics(spark, d):
    topics = F.array(*[F.when(F.contains(F.col("text"), F.lit(k)), F.lit(v)) for k, v in extract.KEYWORDS.items()])
    return table(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.array_compact(topics))).alias("topic"))
