"""Session, table access, code shipping and lineage cuts shared by all operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def session(app: str = "sieveline", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SIEVELINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.path.join(tempfile.gettempdir(), "sieveline-checkpoints"))  # local master only
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that Python workers can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="sieveline-")) / "sieveline.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: that of spark.checkpoint.dir. An error where none is set, except on a local master."""
    sc = spark.sparkContext
    where = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if where:
        return where
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        return os.path.join(tempfile.gettempdir(), "sieveline-checkpoints")  # one machine, so its own folder is shared by all tasks
    raise ValueError("spark.checkpoint.dir must name a folder that all executors share")


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage: the rows are written as a Parquet table into the shared folder, and read from it.

    Executors may be lost afterwards without losing the rows. Lazy frames may read the table at any later time, so it is deleted
    when the application ends.
    """
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/sieveline-{uuid.uuid4().hex}")
    df.write.parquet(path.toString())
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(path.toString())


def spread(df: DataFrame, least: int = 0) -> DataFrame:
    """Repartitions rows over all cores before Python work, but only where the input has fewer partitions than the cluster cores.

    A small Parquet file is read by one task, which would leave the other cores idle; a large table is split by its files already
    and stays as it is, without a shuffle of its texts. Planning the scan starts no job.
    """
    sc = df.sparkSession.sparkContext
    cores = max(least, sc.defaultParallelism)
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(max(cores, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
