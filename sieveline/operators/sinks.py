"""Sinks: single files that appear whole or not at all, tables for people, caches by content, measured stages, schemas."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that a progress event may hold (fixed values).
EVENT_KEYS = ("phase", "status", "event", "message", "done", "total", "seconds")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_whole(spark: SparkSession, path: str, chunks: Iterator[str] | list[str]) -> None:
    """Writes a text file under another name and renames it when it is complete; readers never see a part of it."""
    fs, target = _fs(spark, path)
    tmp = target.suffix(f".{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        for c in chunks:
            out.write(bytearray(c.encode("utf-8")))
        out.hsync()
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(tmp, target):
        raise OSError(f"cannot write {path}")


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """A small object as one JSON file, keys sorted."""
    write_whole(spark, path, [json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2)])


def _cell(v: object) -> str:
    s = "" if v is None else str(v)
    return '"' + s.replace('"', '""') + '"' if any(c in s for c in ',"\r\n') else s


def write_csv(df: DataFrame, path: str, order: list[str], titles: Mapping[str, str] | None = None) -> None:
    """One CSV file for people, with a byte order mark, in the order given. Rows stream through the driver partition by
    partition and are never held together; large tables go to :func:`assemble.csv_sink`."""

    def lines() -> Iterator[str]:
        yield "\ufeff" + ",".join(_cell((titles or {}).get(c, c)) for c in df.columns) + "\r\n"
        for r in df.orderBy(*order).toLocalIterator():
            yield ",".join(map(_cell, r)) + "\r\n"

    write_whole(df.sparkSession, path, lines())


def write_sheets(sheets: Mapping[str, DataFrame], path: str) -> None:
    """A workbook as a directory of CSV tables, one a sheet; a sheet without rows keeps its header."""
    for name, df in sheets.items():
        df.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{path}/{name}")


def markdown_table(df: DataFrame, order: list[str], most: int = 100) -> str:
    """The first rows of a report table as Markdown; what is beyond is counted in a last line."""
    rows = df.orderBy(*order).limit(most + 1).collect()
    esc = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)] + ["| " + " | ".join(map(esc, r)) + " |" for r in rows[:most]]
    return "\n".join(lines + ([f"({df.count() - most} more rows)"] if len(rows) > most else []))


def cached(df: DataFrame, key: str, path: str, compute) -> DataFrame:
    """Rows of a cache by content: keys of ``df`` that the Parquet table at ``path`` lacks are computed and appended.

    compute takes the rows that are missing and gives rows with the key; the whole cache for the keys of df is returned.
    """
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    have = spark.read.parquet(path) if fs.exists(p) else None
    todo = df if have is None else df.join(have.select(key).distinct(), key, "left_anti")
    compute(todo.dropDuplicates([key])).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(df.select(key).distinct(), key, "left_semi")


def stage_seconds(old: Mapping[str, float], stage: str, seconds: float) -> dict[str, float]:
    """Measured stages after one more: a stage that ran again replaces its figure."""
    return {**old, stage: round(seconds, 3)}


def progress_event(**values: object) -> str:
    """One line of JSON with the allowed scalar keys only; texts are cut to 200 characters."""
    kept = {k: values[k] for k in EVENT_KEYS if k in values and isinstance(values[k], (str, int, float, bool, type(None)))}
    return json.dumps({k: v[:200] if isinstance(v, str) else v for k, v in kept.items()}, ensure_ascii=False)


def schemas(tables: Mapping[str, DataFrame]) -> dict[str, dict]:
    """The schema of each table as JSON."""
    return {name: json.loads(df.schema.json()) for name, df in tables.items()}


def key_hits(value: object, forbidden: tuple[str, ...]) -> list[str]:
    """Forbidden keys anywhere in a nested result, each once."""
    found: set[str] = set()
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, Mapping):
            found |= {k for k in v if k in forbidden}
            todo += v.values()
        elif isinstance(v, (list, tuple)):
            todo += v
    return sorted(found)


def forbidden_columns(df: DataFrame, forbidden: tuple[str, ...]) -> list[str]:
    """Forbidden names anywhere in a schema: what a table may hold is known without its rows."""
    return key_hits({n: _names(t) for n, t in ((f.name, f.dataType) for f in df.schema.fields)}, forbidden)


def _names(kind) -> object:
    if hasattr(kind, "fields"):
        return {f.name: _names(f.dataType) for f in kind.fields}
    return [_names(getattr(kind, k)) for k in ("elementType", "valueType") if hasattr(kind, k)]


def export_copies(spark: SparkSession, paths: list[str], target: str) -> list[str]:
    """Copies finished files into a directory; missing ones are left out and named in the result of what was copied."""
    done = []
    fs, to = _fs(spark, target)
    fs.mkdirs(to)
    util, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        src, path = _fs(spark, p)
        if src.exists(path):
            util.copy(src, path, fs, to, False, True, conf)
            done.append(p)
    return done


def record_stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Adds a count to a stage that the listener reports when the stage runs, without a job of its own."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))
