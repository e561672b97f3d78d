"""Putting rows together: overrides, ordinals, quotas over files, nested results, checks that accept all rows or none."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.runtime import cut


def overridden(rows: DataFrame, manual: DataFrame, key: str, value: str) -> DataFrame:
    """Automatic values replaced by confirmed ones of the same key; confirmations of unknown keys come out as rows with an error."""
    m = manual.select(key, F.col(value).alias("__m"))
    done = rows.join(m, key, "left").withColumn(value, F.coalesce("__m", value)).withColumn("error", F.lit(None).cast("string")).drop("__m")
    lost = manual.join(rows.select(key), key, "left_anti").withColumn("error", F.lit("unknown key"))
    return done.unionByName(lost, allowMissingColumns=True)


def all_or_nothing(results: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Adds the list of failed checks of each row and whether the whole delivery is accepted.

    The count of bad rows is one number, joined back to all rows; every failed check is named, not only the first.
    """
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    checked = results.withColumn("errors", failed)
    total = checked.agg(F.coalesce(F.sum((F.size("errors") > 0).cast("bigint")), F.lit(0)).alias("__bad"))
    return checked.crossJoin(F.broadcast(total)).withColumn("accepted", F.col("__bad") == 0).drop("__bad")


def dense_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Consecutive numbers from 0 over a total order without a single-partition window.

    Rows are sorted over all partitions and written with their partition and their place in it, so that counts and rows speak of
    the same partitions; counts by partition (one number each, as many as partitions) give every partition its offset.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("__p", F.spark_partition_id())
    ranged = cut(ranged.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*order))))
    counts = ranged.groupBy("__p").agg(F.count("*").alias("__n"))
    offsets = counts.withColumn("__o", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__o")
    return ranged.join(offsets, "__p").withColumn(name, F.col("__o") + F.col("__i") - 1).drop("__p", "__i", "__o")


def quota_with_memory(lines: DataFrame, group: str, file: str, pos: str, text: str, quota: int) -> DataFrame:
    """The first ``quota`` new texts of each file, files in order: a text emitted by an earlier file does not count again, one
    beyond an earlier file's quota may still come. Sequential by nature within a group; a group is the set of files of one job.

    Only the texts' digests and places go to the sequential step, not the texts.
    """
    slim = lines.select(group, file, pos, F.sha2(text, 256).alias("h"))

    def run(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in lists:
            out = []
            for rows in series:
                seen: set[str] = set()
                used: dict[object, int] = {}
                keep = []
                for r in sorted(rows, key=lambda r: (r["f"], r["p"])):
                    if used.get(r["f"], 0) < quota and r["h"] not in seen:
                        seen.add(r["h"])
                        used[r["f"]] = used.get(r["f"], 0) + 1
                        keep.append({"f": r["f"], "p": r["p"]})
                out.append(keep)
            yield pd.Series(out, dtype=object)

    kinds = dict(lines.dtypes)
    lists = slim.groupBy(group).agg(F.collect_list(F.struct(F.col(file).alias("f"), F.col(pos).alias("p"), "h")).alias("rows"))
    kept = lists.select(group, F.explode(F.pandas_udf(run, f"array<struct<f: {kinds[file]}, p: {kinds[pos]}>>")("rows")).alias("x"))
    return lines.join(kept.select(group, F.col("x.f").alias(file), F.col("x.p").alias(pos)), [group, file, pos], "left_semi")


def csv_sink(df: DataFrame, path: str) -> None:
    """A CSV with header; columns are written as strings in the order given."""
    df.select([F.col(c).cast("string") for c in df.columns]).write.mode("overwrite").option("header", "true").csv(path)


def bundle(parts: dict[str, DataFrame], path: str) -> None:
    """Every part of a result as JSON lines below one directory, each written by the executors."""
    for name, df in parts.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def paired_table(heads: DataFrame, bodies: DataFrame) -> DataFrame:
    """Body rows with the first header of as many cells and the same group, as maps.

    heads: page, grp, pos, cells; bodies: page, grp, row, cells.
    """
    h = heads.select("page", "grp", F.size("cells").alias("n"), "pos", F.col("cells").alias("names")).groupBy("page", "grp", "n").agg(F.min_by("names", "pos").alias("names"))
    j = bodies.withColumn("n", F.size("cells")).join(h, ["page", "grp", "n"])
    return j.select("page", "grp", "row", F.map_filter(F.map_from_arrays("names", "cells"), lambda k, v: F.trim(v) != "").alias("fields"))
