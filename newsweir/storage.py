"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local folder serves for a
    session of one machine (tests); on a cluster that is an error, as executors could not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='newsweir-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back, which cuts its lineage.

    The files survive the loss of any executor. `discard` deletes them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/newsweir-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_written_to"] = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the table that `cut` wrote for `df`."""
    path = getattr(df, "__dict__", {}).get("_written_to")
    if path:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def partitions(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: at least the cores, at least what the session sets for shuffles."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
