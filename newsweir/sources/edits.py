"""Deletes and corrections of single rows of a versioned table, without writing the table again.

They are small tables beside a version, applied when it is read. The next version, written from what is read, has them for good;
they belong to their version alone, so a row that a later version brings back stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .sinks import exists, read_version, versions, write_version


def _path(base: str, what: str, n: int) -> str:
    return f"{base}/{what}/of=v{n}"


def _last(spark: SparkSession, base: str, n: int | None) -> int:
    return n or max(versions(spark, base))


def delete_rows(gone: DataFrame, base: str, key: str = "row_id", n: int | None = None) -> None:
    """Delete the rows of a version (the last) whose key is in `gone` (key, reason). To delete a row again changes nothing."""
    n = _last(gone.sparkSession, base, n)
    gone.select(F.col(key).alias("_key"), F.col("reason") if "reason" in gone.columns else F.lit(None).cast("string").alias("reason")).write.mode("append").parquet(_path(base, "deletes", n))


def patch_rows(patches: DataFrame, base: str, key: str = "row_id", n: int | None = None) -> None:
    """Correct rows of a version (the last): for each key and column that isn't null in `patches` the new value, of several
    patches the last one."""
    spark = patches.sparkSession
    n = _last(spark, base, n)
    path = _path(base, "patches", n)
    turn = spark.read.parquet(path).agg(F.max("_turn")).first()[0] + 1 if exists(spark, f"{path}/_SUCCESS") else 0
    patches.withColumnRenamed(key, "_key").withColumn("_turn", F.lit(turn)).write.mode("append").parquet(path)


def deleted(spark: SparkSession, base: str, n: int | None = None) -> DataFrame:
    """_key, reason: the rows that are deleted from a version, each once."""
    n = _last(spark, base, n)
    path = _path(base, "deletes", n)
    if not exists(spark, f"{path}/_SUCCESS"):
        return spark.createDataFrame([], "_key string, reason string")
    return spark.read.parquet(path).groupBy("_key").agg(F.min("reason").alias("reason"))


def read_live(spark: SparkSession, base: str, key: str = "row_id", n: int | None = None) -> DataFrame:
    """A version with its deletes and corrections."""
    n = _last(spark, base, n)
    x = read_version(spark, base, n)
    if exists(spark, f"{_path(base, 'deletes', n)}/_SUCCESS"):
        x = x.join(deleted(spark, base, n).select(F.col("_key").alias(key)), key, "left_anti")
    if exists(spark, f"{_path(base, 'patches', n)}/_SUCCESS"):
        p = spark.read.option("mergeSchema", True).parquet(_path(base, "patches", n))
        new = [c for c in p.columns if c not in ("_key", "_turn")]
        w = Window.partitionBy("_key").orderBy("_turn").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        p = p.select("_key", *[F.last(c, ignorenulls=True).over(w).alias(f"_{c}") for c in new]).distinct()
        x = x.join(p.withColumnRenamed("_key", key), key, "left")
        x = x.withColumns({c: F.coalesce(f"_{c}", c) if c in x.columns else F.col(f"_{c}") for c in new}).drop(*[f"_{c}" for c in new])
    return x


def compact(spark: SparkSession, base: str, key: str = "row_id") -> int:
    """Write what is read of the last version as the next one; its number."""
    return write_version(read_live(spark, base, key), base)
