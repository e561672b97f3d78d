"""Streams: last-wins upsert of a stream into a keyed Parquet table, and windowed counts with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sieveline.operators.ordered import first_by, upsert


def upsert_stream(stream: DataFrame, table: str, key: str, order: str, checkpoint: str) -> StreamingQuery:
    """Keeps the newest row of each key in generations of a Parquet table; a batch that is run again writes the same generation."""
    spark = stream.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        new = first_by(batch, [key], [F.col(order).desc()])
        old = current(spark, table, number - 1)
        (new if old is None else upsert(old, new, key)).write.mode("overwrite").parquet(f"{table}/generation={number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table: str, number: int) -> DataFrame | None:
    """The table after a batch; None before the first."""
    return spark.read.parquet(f"{table}/generation={number}") if number >= 0 else None


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
