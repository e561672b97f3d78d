"""First, last, nearest and most certain rows of a key: the ordered idioms, each with an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. Spark keeps only one row a key and partition before the shuffle (limit pushed into the window)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).drop("__r")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both sides by key; the new side wins."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def replace_overlapping(old: DataFrame, new: DataFrame, ids: str) -> DataFrame:
    """Drops the old rows that share an id with a new row, then appends the new ones."""
    taken = new.select(F.explode(ids).alias("__i")).distinct()
    keyed = old.withColumn("__k", F.monotonically_increasing_id())
    gone = keyed.select("__k", F.explode(ids).alias("__i")).join(taken, "__i", "left_semi").select("__k").distinct()
    return keyed.join(gone, "__k", "left_anti").drop("__k").unionByName(new)


def by_precedence(df: DataFrame, keys: Sequence[str], status: str, ranks: dict[str, int], tie: Column) -> DataFrame:
    """One row a key with the highest rank of its status; of equal ranks the earlier by ``tie``."""
    rank = F.coalesce(F.element_at(F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))]), F.col(status)), F.lit(-1))
    return first_by(df, keys, [rank.desc(), tie.asc()])


def modal(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each key; of equally frequent ones the first seen. Summed by value before any window."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return counts.groupBy(*keys).agg(F.max_by(F.struct(F.col(value).alias("v"), F.col("n").alias("c")), F.struct("n", (-F.col("seen")).alias("s"))).alias("t")).select(*keys, F.col("t.v").alias(value), F.col("t.c").alias("n"))


def top_two_gap(df: DataFrame, keys: Sequence[str], score: str, name: str) -> DataFrame:
    """Best row of each key, its lead over the second and whether that leaves it open (a second exists within 1.0)."""
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(name))
    r = df.withColumn("__r", F.row_number().over(w)).withColumn("second", F.lead(score).over(w)).where(F.col("__r") == 1)
    return r.select(*keys, name, score, "second", F.coalesce(F.col(score) - F.col("second") < 1.0, F.lit(False)).alias("ambiguous"))


def total_after_heading(lines: DataFrame, keys: Sequence[str], line: str, pos: str, heading: str = "合计|Total", reach: int = 4) -> DataFrame:
    """For each text the amount that follows the first heading whose window of lines holds any: the last one with decimals, else
    the last one of a line with 元, else null. Texts without any amount after a heading give no row."""
    w = Window.partitionBy(*keys).orderBy(pos).rowsBetween(0, reach)
    number = F.regexp_extract_all(F.col(line), F.lit(r"(?<![0-9.,])((?:[0-9]{1,3}(?:,[0-9]{3})+(?![0-9])|[0-9]+)(?:\.[0-9]+)?)"), F.lit(1))
    plain = F.transform(number, lambda x: F.replace(x, F.lit(","), F.lit("")))
    found = lines.withColumn("__n", F.struct(plain.alias("all"), F.filter(plain, lambda x: x.contains(".")).alias("exact"), F.when(F.col(line).contains("元"), plain).otherwise(F.array().cast("array<string>")).alias("money")))
    seen = found.withColumn("__w", F.collect_list("__n").over(w)).where(F.col(line).rlike(heading))
    last = lambda part: F.try_element_at(F.flatten(F.col(f"__w.{part}")), F.lit(-1))
    amounts = seen.where(F.size(F.flatten(F.col("__w.all"))) > 0).select(*keys, pos, F.coalesce(last("exact"), last("money")).cast("double").alias("__t"))
    one = amounts.groupBy(*keys).agg(F.min_by(F.struct("__t"), pos).alias("__o"))
    return one.select(*keys, F.col("__o.__t").alias("total"))
