"""Writing articles, reports and state. Data go first, the marks that they were written after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import strip


def lede(body: Column, most: int = 300) -> Column:
    """The start of a body, with single line breaks."""
    return F.substring(F.replace(strip(F.coalesce(body, F.lit(""))), F.lit("\n\n"), F.lit("\n")), 1, most)


def output_rows(classified: DataFrame, country: Column) -> DataFrame:
    """The columns of the published table, in order; confidence to three decimals."""
    return classified.select(
        F.col("title_en").alias("title"), "section", "region", country.alias("country"), "url", "source_name", "published_at", "image_url", "primary_domain", "primary_url", "primary_confidence",
        F.bround("confidence", 3).alias("confidence"), lede(F.col("body")).alias("lede"),
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Versions v1, v2, ... that a folder has."""
    at = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit() and exists(spark, f"{base}/{n}/_SUCCESS"))


def write_version(df: DataFrame, base: str) -> int:
    """Write `df` as the next version of a table (the first is 1); earlier ones stay. A version counts once it is whole."""
    n = max(versions(df.sparkSession, base), default=0) + 1
    df.write.mode("overwrite").parquet(f"{base}/v{n}")
    return n


def read_version(spark: SparkSession, base: str, n: int | None = None) -> DataFrame:
    """A version of a table, the last unless one is given."""
    n = n or max(versions(spark, base))
    return spark.read.option("mergeSchema", True).parquet(f"{base}/v{n}")


def commit_run(rows: DataFrame, output: str, state: DataFrame, state_base: str, log: DataFrame, log_path: str) -> int:
    """Append the rows, then write the state's next version, then the log: URLs are marked seen only once their rows are out."""
    rows.write.mode("append").parquet(output)
    n = write_version(state, state_base)
    log.write.mode("append").json(log_path)
    return n
