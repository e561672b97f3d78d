"""Blocks and cells by their place: reading order, the value next to a label, adjacent cells, text of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reading_order(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Text of each page: its blocks by y, then x, a missing place last; ties by block number."""
    item = F.struct(F.coalesce("bbox.y", F.lit(1.0)).alias("y"), F.coalesce("bbox.x", F.lit(1.0)).alias("x"), "block_no", "block_id", "text")
    return blocks.where(F.col("text").isNotNull()).groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda b: b["text"]), "\n").alias("page_text"), F.count("*").alias("n_blocks"))


def spatial_pairs(blocks: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """For each label block the nearest value block of its page: to the right in the same row, else below.

    blocks: keys, block_id, block_no, text, confidence, bbox; labels: label, field. A value block is no label itself. Right: the
    centres differ by at most max(2.5 heights, 0.045) in y, score dy + 0.05 dx; below: within max(5 heights, 0.12) in y and
    0.18 in x, score 0.2 + dy. The candidates of a page meet within the page only.
    """
    known = labels.select("label", "field")
    b = blocks.where(F.col("text").isNotNull() & F.col("bbox").isNotNull()).withColumn("key", F.regexp_replace("text", "[\\s:：]", ""))
    tagged = b.join(known, F.col("key") == F.col("label"), "left")
    left = tagged.where(F.col("field").isNotNull()).select(*keys, "field", F.col("block_id").alias("label_id"), F.col("bbox").alias("lb"), F.col("confidence").alias("lc"))
    right = tagged.where(F.col("field").isNull()).select(*keys, F.col("block_id").alias("value_id"), F.col("block_no").alias("vn"), "text", F.col("bbox").alias("vb"), F.col("confidence").alias("vc"))
    j = left.join(right, keys)
    dy = (F.col("vb.y") + F.col("vb.height") / 2) - (F.col("lb.y") + F.col("lb.height") / 2)
    dx = F.col("vb.x") - (F.col("lb.x") + F.col("lb.width"))
    row = (F.abs(dy) <= F.greatest(2.5 * F.col("lb.height"), F.lit(0.045))) & (F.col("vb.x") >= F.col("lb.x"))
    below = (dy > 0) & (dy <= F.greatest(5 * F.col("lb.height"), F.lit(0.12))) & (F.abs(F.col("vb.x") - F.col("lb.x")) <= 0.18)
    score = F.when(row & (dx >= 0), F.abs(dy) + 0.05 * dx).when(below, 0.2 + dy)
    scored = j.withColumn("score", score).where(F.col("score").isNotNull())
    best = scored.groupBy(*keys, "field", "label_id").agg(F.min(F.struct("score", "vn", "value_id", "text", F.least("lc", "vc").alias("confidence"))).alias("t"))
    return best.select(*keys, "field", "label_id", "t.value_id", F.col("t.text").alias("value"), "t.confidence", F.round("t.score", 6).alias("score"))


def adjacent(cells: DataFrame) -> DataFrame:
    """For each cell with a field the first cell without one among its right, second right and lower neighbour.

    cells: sheet, row, col, text, field. One equality join on the place of the neighbour, then the smallest preference.
    """
    steps = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for p, (dr, dc) in enumerate([(0, 1), (0, 2), (1, 0)])]))
    asked = cells.where(F.col("field").isNotNull()).select("sheet", "row", "col", "field", steps.alias("s")).select("sheet", F.col("row").alias("r0"), F.col("col").alias("c0"), "field", "s.p", (F.col("row") + F.col("s.dr")).alias("row"), (F.col("col") + F.col("s.dc")).alias("col"))
    value = cells.where(F.col("field").isNull() & (F.trim("text") != "")).select("sheet", "row", "col", F.col("text").alias("value"))
    hit = asked.join(value, ["sheet", "row", "col"]).groupBy("sheet", "r0", "c0", "field").agg(F.min(F.struct("p", "value")).alias("t"))
    return hit.select("sheet", F.col("r0").alias("row"), F.col("c0").alias("col"), "field", "t.value", F.lit(0.9).alias("confidence"))


def cell_values(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Values next to the cells whose text is one of the labels. cells: sheet, row, col, text; labels: label, field."""
    known = labels.select("label", "field")
    return adjacent(cells.withColumn("key", F.regexp_replace("text", "[\\s:：]", "")).join(known, F.col("key") == F.col("label"), "left"))


def next_line(lines: DataFrame, keys: list[str], pos: str, line: str, label: str) -> DataFrame:
    """The rest of a line that begins with a label, else the next line of its text."""
    w = Window.partitionBy(*keys).orderBy(pos)
    rest = F.trim(F.regexp_extract(line, f"^\\s*(?:{label})\\s*[:：]?\\s*(.*)$", 1))
    seen = lines.withColumn("__next", F.lead(line).over(w)).where(F.col(line).rlike(f"^\\s*(?:{label})"))
    return seen.select(*keys, pos, F.when(rest != "", rest).otherwise(F.trim("__next")).alias("value"))
