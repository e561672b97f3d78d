"""Pages, their roles and what their layout says: covers, roles of identity numbers, titles, template metrics, predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.text import stable_id
from sieveline.operators.extract import NAME_CUTS, NO_NAME_PARTS, NO_NAME_START, NOT_NAMES, PROJECT_NOISE, PROJECT_WORDS, fields
from sieveline.operators.layout import spatial_pairs

#: Fields that only a cover may give, and words of covers (fixed values).
COVER_FIELDS = ("project_name", "project_code", "tenderer", "bid_date")
COVER_WORDS = ("投标文件", "投标书", "封面")
#: Words of pages whose image is recognised although they have a text layer (fixed values).
IMAGE_PAGE_WORDS = ("营业执照", "统一社会信用代码", "资格证明", "单位名称", "法人代表", "授权代表")
#: Labels that are no metric, and words that a metric holds (fixed values).
GENERIC_LABELS = "指标 指标名称 参数 技术参数 技术指标 要求 技术要求 响应 响应情况 投标响应 单位 备注 序号 项目 项目名称 采购需求 技术需求 符合性 是否响应".split()
METRIC_WORDS = "指标 参数 规格 型号 性能 容量 尺寸 材质 功率 数量 等级 标准 要求".split()
#: Words of file names by which a template is found, and those it must have (fixed values).
TEMPLATE_WORDS = "招标 采购 模板 技术规范 技术参数 评分 需求".split()
TEMPLATE_NAMES = ("模板", "空白", "template")


def any_of(c: Column, words: Sequence[str]) -> Column:
    """Whether a text holds one of the words."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def looks_like_cover(c: Column) -> Column:
    return F.coalesce(any_of(c, COVER_WORDS) & ~F.contains(c, F.lit("授权委托书")), F.lit(False))


def glob(pattern: str) -> str:
    """A file-name pattern with * and ? as an anchored regular expression."""
    return "^" + "".join(".*" if c == "*" else "." if c == "?" else "\\" + c if not c.isalnum() else c for c in pattern) + "$"


def looks_like_metric(key: Column) -> Column:
    """A label key of 2 to 80 characters that is not generic, no number, and holds a word of metrics."""
    return F.length(key).between(2, 80) & ~key.isin(*GENERIC_LABELS) & ~key.rlike("^[0-9.]+$") & any_of(key, METRIC_WORDS)


def template_score(path: Column) -> Column:
    """3 for each word of templates in the file's name, 1 for a path below procurement/."""
    name = F.regexp_extract(path, "([^/]*?)(?:\\.[^./]*)?$", 1)
    score = F.when(path.rlike("(^|/)procurement/"), 1).otherwise(0)
    for w in TEMPLATE_WORDS:
        score = score + F.when(F.contains(name, F.lit(w)), 3).otherwise(0)
    return score


def name_cleaned(c: Column) -> Column:
    """A name without what follows it: brackets, actions, lists."""
    cuts = "|".join("\\" + w if w in "(" else w for w in NAME_CUTS)
    return F.regexp_replace(F.regexp_replace(c, f"(?s)(?:{cuts}).*$", ""), "^[\\s：:，,]+|[\\s：:，,]+$", "")


def name_plausible(c: Column) -> Column:
    shape = c.rlike("^[\\u4e00-\\u9fa5·A-Za-z]{2,8}$") & ~c.isin(*sorted(NOT_NAMES)) & ~F.left(c, F.lit(1)).isin(*sorted(NO_NAME_START))
    return shape & ~any_of(c, NO_NAME_PARTS)


def project_plausible(c: Column) -> Column:
    v = F.regexp_replace(c, "\\s", "")
    return F.length(v).between(8, 120) & any_of(v, PROJECT_WORDS) & ~any_of(v, PROJECT_NOISE)


def tenderer_plausible(c: Column) -> Column:
    v = F.regexp_replace(c, "\\s", "")
    return (F.length(v) <= 80) & v.rlike("(?:公司|厂|中心|单位)$")


def coerced(field: Column, value: Column) -> Column:
    """A value next to a label if it has the shape of its field, else null; fields with a shape of their own give null."""
    v = F.regexp_replace(value, "^[\\s：:，,；;]+|[\\s：:，,；;]+$", "")
    name = name_cleaned(v)
    fits = F.when(field.isin("legal_rep_name", "bid_agent_name", "shareholder_name", "contact_name"), F.when(name_plausible(name), name))
    fits = fits.when(field == "project_name", F.when(project_plausible(v), v)).when(field == "tenderer", F.when(tenderer_plausible(v), v))
    return F.when((v != "") & (F.length(v) <= 80), fits.when(field.isin("address", "bid_date", "project_code"), v))


def id_roles(blocks: DataFrame, keys: Sequence[str], marks: str, spread: float = 0.12) -> DataFrame:
    """(keys..., axis, first_id, last_id): on pages that match ``marks`` and show two or more identity numbers, the first and the last
    one along the page's axis: from left to right if they are spread over ``spread`` of the width, else from top to bottom."""
    number = F.regexp_extract("text", "([1-9][0-9]{16}[0-9Xx])", 1)
    seen = blocks.where("text IS NOT NULL AND bbox IS NOT NULL").select(*keys, number.alias("v"), F.col("text").rlike(marks).alias("m"), (F.col("bbox.x") + F.col("bbox.width") / 2).alias("x"), (F.col("bbox.y") + F.col("bbox.height") / 2).alias("y"))
    pages = seen.groupBy(*keys).agg(F.max("m").alias("m"), F.count_distinct(F.when(F.col("v") != "", F.col("v"))).alias("n")).where("m AND n >= 2").select(*keys)
    one = seen.where("v <> ''").groupBy(*keys, "v").agg(F.round(F.avg("x"), 6).alias("x"), F.round(F.avg("y"), 6).alias("y"))
    side = F.max("x") - F.min("x") >= spread
    ends = lambda by: (F.min_by("v", F.struct(by, "v")), F.max_by("v", F.struct(by, "v")))
    (xa, xb), (ya, yb) = ends("x"), ends("y")
    done = one.join(pages, list(keys), "left_semi").groupBy(*keys).agg(F.when(side, "x").otherwise("y").alias("axis"), xa.alias("xa"), xb.alias("xb"), ya.alias("ya"), yb.alias("yb"))
    pick = lambda a, b: F.when(F.col("axis") == "x", F.col(a)).otherwise(F.col(b))
    return done.select(*keys, "axis", pick("xa", "ya").alias("first_id"), pick("xb", "yb").alias("last_id"))


def cover_titles(blocks: DataFrame, keys: Sequence[str], words: Sequence[str] = ("投标文件", "投标书"), top: float = 0.38, near: float = 0.10) -> DataFrame:
    """(keys..., tenderer, project_name, confidence): what the top blocks of a page with words of covers say without labels.

    The first top block names the tenderer if it has that shape; the project is the first run of a block with one or two that
    follow within ``near`` and that together has the shape of a project's name.
    """
    y = F.coalesce("bbox.y", F.lit(1.0))
    b = blocks.where("text IS NOT NULL AND trim(text) <> ''").select(*keys, "block_id", "block_no", F.trim("text").alias("t"), "confidence", y.alias("y"))
    w = Window.partitionBy(*keys)
    cover = F.max(any_of(F.col("t"), words).cast("int")).over(w)
    tops = b.withColumn("cover", cover).where((F.col("cover") == 1) & (F.col("y") <= top) & ~F.contains("t", F.lit("项目编号")))
    order = w.orderBy("y", "block_no", "block_id")
    for k in (1, 2):
        for c in ("t", "y", "confidence"):
            tops = tops.withColumn(f"{c}{k}", F.lead(c, k).over(order))
    tops = tops.withColumn("i", F.row_number().over(order))
    close = lambda k: F.coalesce(F.col(f"y{k}") - F.col("y") <= near, F.lit(False))
    two, three = F.concat("t", "t1"), F.concat("t", "t1", "t2")
    ok2, ok3 = close(1) & project_plausible(two), close(1) & close(2) & project_plausible(three)
    tops = tops.withColumn("p", F.when(ok2, F.struct(two.alias("v"), F.least("confidence", "confidence1").alias("c"))).when(ok3, F.struct(three.alias("v"), F.least("confidence", "confidence2").alias("c"))))
    first = F.min(F.when((F.col("i") == 1) & tenderer_plausible(F.col("t")), F.col("t")))
    project = F.min_by("p", F.when(F.col("p").isNotNull(), F.col("i")))
    out = tops.groupBy(*keys).agg(first.alias("tenderer"), project.alias("p"))
    return out.select(*keys, "tenderer", F.col("p.v").alias("project_name"), F.col("p.c").alias("confidence")).where("tenderer IS NOT NULL OR project_name IS NOT NULL")


def metric_values(blocks: DataFrame, metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., metric, value, relation): for each metric of a template and each page one value: of a block 'label: value', else
    the nearest block without label to the right in its row or below; the longest label that begins a block is its metric.

    metrics: metric, label (label keys). Labels are a template's and join by their first character; blocks meet in their page.
    """
    b = blocks.where("text IS NOT NULL AND trim(text) <> ''").select(*keys, "block_id", "bbox", F.regexp_replace("text", "\\s", "").alias("t"))
    m = metrics.select("metric", "label", F.left("label", F.lit(1)).alias("c"))
    hit = b.withColumn("c", F.left("t", F.lit(1))).join(m, "c").where(F.startswith("t", F.col("label")))
    told = hit.groupBy(*keys, "block_id").agg(F.max(F.struct(F.length("label").alias("n"), "metric", "label")).alias("m"))
    tagged = b.join(told.select(*keys, "block_id", "m.metric", "m.label"), [*keys, "block_id"], "left")
    rest = F.regexp_replace(F.substr("t", F.length("label") + 1, F.length("t")), "^[:：]", "")
    label = tagged.where("metric IS NOT NULL").withColumn("rest", F.when(F.substr("t", F.length("label") + 1, F.lit(1)).isin(":", "："), rest))
    inline = label.where("rest <> ''").select(*keys, "metric", "block_id", F.lit(0.0).alias("score"), F.col("rest").alias("value"), F.lit("inline").alias("relation"))
    left = label.where("rest IS NULL AND t = label AND bbox IS NOT NULL").select(*keys, "metric", F.col("block_id").alias("lid"), F.col("bbox").alias("l"))
    right = tagged.where("metric IS NULL AND bbox IS NOT NULL").select(*keys, "block_id", "t", F.col("bbox").alias("v"))
    dy = (F.col("v.y") + F.col("v.height") / 2) - (F.col("l.y") + F.col("l.height") / 2)
    dx = F.col("v.x") - (F.col("l.x") + F.col("l.width"))
    row = (F.abs(dy) <= F.greatest(2.5 * F.col("l.height"), F.lit(0.045))) & (dx >= 0)
    below = (dy > 0) & (dy <= F.greatest(5 * F.col("l.height"), F.lit(0.12))) & (F.abs(F.col("v.x") - F.col("l.x")) <= 0.18)
    score = F.when(row, F.abs(dy) + 0.05 * dx).when(below, 0.2 + dy)
    pairs = left.join(right, list(keys)).withColumn("score", F.round(score, 6)).where("score IS NOT NULL")
    near = pairs.select(*keys, "metric", "block_id", "score", F.col("t").alias("value"), F.lit("near").alias("relation"))
    best = inline.unionByName(near).groupBy(*keys, "metric").agg(F.min(F.struct("score", "block_id", "value", "relation")).alias("b"))
    return best.select(*keys, "metric", "b.value", "b.relation")


def template_labels(units: DataFrame) -> DataFrame:
    """(relative_path, metric_id, label): metrics that a blank template names in its cells, each label once, in order.

    units: relative_path, kind, place, text of :func:`sieveline.sources.files.office_units`.
    """
    key = F.regexp_replace(F.regexp_replace("text", "^\\s*(?:[（(]?[一二三四五六七八九十百0-9]+[）).、]|[-—•●])\\s*", ""), "[\\s:：]", "")
    cells = units.where("kind = 'cell'").select("relative_path", F.col("place").try_cast("int").alias("place"), key.alias("label"))
    first = cells.where(looks_like_metric(F.col("label"))).groupBy("relative_path", "label").agg(F.min("place").alias("place"))
    number = F.row_number().over(Window.partitionBy("relative_path").orderBy("place"))
    return first.select("relative_path", F.format_string("M-%03d", number).alias("metric_id"), "label")


def text_units(scans: DataFrame, office: DataFrame, texts: DataFrame) -> DataFrame:
    """(relative_path, kind, place, text, cover) of everything that was read: pages, paragraphs and cells, text files."""
    p = scans.select("relative_path", F.explode("pages").alias("p")).where("p.text <> ''")
    cover = (F.col("p.page") == 1) & looks_like_cover(F.col("p.text"))
    a = p.select("relative_path", F.lit("pdf_page").alias("kind"), F.col("p.page").cast("string").alias("place"), F.col("p.text").alias("text"), cover.alias("cover"))
    b = office.where("status = 'ok' AND NOT startswith(kind, 'prop:')").select("relative_path", "kind", "place", "text", F.lit(False).alias("cover"))
    c = texts.select("relative_path", F.lit("text").alias("kind"), F.lit("0").alias("place"), "text", F.lit(False).alias("cover"))
    return a.unionByName(b).unionByName(c)


def unit_fields(units: DataFrame, confidence: float = 1.0, digest: str = "EV-") -> DataFrame:
    """(evidence_id, relative_path, kind, place, field, value, via_label, confidence): field rows of text units with their place.

    Public fields count only from a cover; each (unit, field, value) counts once, the first way found.
    """
    found = fields(units, "text", "relative_path", "kind", "place", "cover").where(~F.col("field").isin(*COVER_FIELDS) | F.col("cover"))
    ident = stable_id(digest, field=F.col("field"), kind=F.col("kind"), path=F.col("relative_path"), place=F.col("place"), value=F.col("value"))
    return found.select(ident.alias("evidence_id"), "relative_path", "kind", "place", "field", "value", "via_label", F.lit(confidence).alias("confidence"))


def recognised_fields(blocks: DataFrame, labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., field, value, confidence, relation): what recognised blocks say: values beside or below a label with the lower
    confidence of the two, else what the scanner finds inside a block, with at most 0.85; a page-wide result has at most 0.5."""
    near = spatial_pairs(blocks, labels, list(keys)).select(*keys, "field", "value", "confidence", F.lit("layout").alias("relation"))
    boxed = F.when(F.col("bbox").isNull(), F.least("confidence", F.lit(0.5))).otherwise(F.least("confidence", F.lit(0.85)))
    inside = fields(blocks.where("text IS NOT NULL").withColumn("c", boxed), "text", *keys, "c").select(*keys, "field", "value", F.col("c").alias("confidence"), F.lit("inline").alias("relation"))
    every = near.unionByName(inside)
    rank = F.struct((F.col("relation") == "inline").cast("int").alias("a"), (-F.col("confidence")).alias("b"))
    best = every.groupBy(*keys, "field", "value").agg(F.min_by(F.struct("confidence", "relation"), rank).alias("t"))
    return best.select(*keys, "field", "value", "t.confidence", "t.relation")
