"""State of seen articles in partitions, and runs that are committed once.

A store is a folder: `seen` (state, one partition for each prefix of the URL hash), `rows` (one folder a run), `log` (one a
run) and `staged` (a run on its way). A run reads and rewrites only the partitions that its URLs fall into.

A commit first stages everything that the run gives: its rows, its summary, and last the new content of the partitions it
touches. Until that is whole nothing else has changed, and a rerun makes it again. Once it is whole, what follows is copying:
rows, then state, then log, each overwriting the same places with the same content, so that a run which failed anywhere is
finished by any later commit, and appends nothing twice. One commit at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import upserted

SEEN = "url_hash string, canonical_url string, title string, published_at timestamp, first_seen_at timestamp, last_seen_at timestamp, source_domain string, portal string, cached_row_json string"
DIGITS = 2


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _whole(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(at)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def bucketed(rows: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Rows with the partition of their url_hash."""
    return rows.withColumn("bucket", F.substring("url_hash", 1, digits))


class Store:
    """A store under `base`, in 16 ** `digits` partitions; a larger one wants more, and keeps what it began with."""

    def __init__(self, spark: SparkSession, base: str, digits: int = DIGITS, schema: str = SEEN) -> None:
        self.spark, self.base, self.digits, self.schema = spark, base.rstrip("/"), digits, schema
        held = [n for n in _names(spark, f"{self.base}/seen") if n.startswith("bucket=")]
        if held and len(held[0]) != len("bucket=") + digits:
            raise ValueError(f"the store at {base} has partitions of {len(held[0]) - len('bucket=')} digits")

    def touched(self, rows: DataFrame) -> list[str]:
        """The partitions of rows (url_hash): 16 ** digits at most, however many rows there are."""
        return sorted(r.bucket for r in bucketed(rows, self.digits).select("bucket").distinct().collect() if r.bucket)

    def seen(self, buckets: list[str] | None = None) -> DataFrame:
        """The state, or some partitions of it, which alone are read."""
        if not any(n.startswith("bucket=") for n in _names(self.spark, f"{self.base}/seen")):
            return self.spark.createDataFrame([], self.schema)
        x = self.spark.read.schema(f"{self.schema}, bucket string").parquet(f"{self.base}/seen")
        return (x if buckets is None else x.where(F.col("bucket").isin(buckets or [""]))).drop("bucket")

    def seen_of(self, rows: DataFrame) -> DataFrame:
        """The partitions of the state that rows (url_hash) fall into."""
        return self.seen(self.touched(rows))

    def rows(self) -> DataFrame:
        """The rows of all runs, with `run`."""
        return self.spark.read.option("basePath", f"{self.base}/rows").option("mergeSchema", True).parquet(f"{self.base}/rows/run=*").withColumn("run", F.col("run").cast("string"))

    def runs(self) -> list[str]:
        """The runs that are committed."""
        return [n[4:] for n in _names(self.spark, f"{self.base}/log") if n.startswith("run=") and _whole(self.spark, f"{self.base}/log/{n}")]

    def log(self) -> DataFrame:
        """Summaries of the runs, with `run`."""
        return self.spark.read.option("basePath", f"{self.base}/log").json(f"{self.base}/log/run=*").withColumn("run", F.col("run").cast("string"))

    def commit(self, run: str, made: Callable[[], dict[str, DataFrame]]) -> bool:
        """Commit the run of that name once: `made` gives rows, marks (the state's columns, one row per url_hash) and summary.
        False if it was committed before. Runs that failed half-way are finished first."""
        if not re.fullmatch(r"[\w.-]+", run):
            raise ValueError("a run's name has letters, digits, dots and hyphens only")
        self.recover()
        if run in self.runs():
            return False
        parts, at = made(), self._staged(run)
        for name in ("rows", "summary", "marks"):
            parts[name].write.mode("overwrite").parquet(f"{at}/{name}")
        marks = self.spark.read.schema(self.schema).parquet(f"{at}/marks")
        new = bucketed(upserted(self.seen_of(marks), marks), self.digits)
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{at}/seen")
        self._finish(run)
        return True

    def recover(self) -> list[str]:
        """Finish the runs that are staged whole, and forget those that aren't; the names of the former."""
        done = []
        for run in _names(self.spark, f"{self.base}/staged"):
            if _whole(self.spark, f"{self._staged(run)}/seen"):
                self._finish(run)
                done.append(run)
            else:
                _delete(self.spark, self._staged(run))
        return done

    def _staged(self, run: str) -> str:
        return f"{self.base}/staged/{run}"

    def _finish(self, run: str) -> None:
        at = self._staged(run)
        self._publish(f"{at}/rows", f"{self.base}/rows/run={run}")
        if any(n.startswith("bucket=") for n in _names(self.spark, f"{at}/seen")):
            x = self.spark.read.schema(f"{self.schema}, bucket string").parquet(f"{at}/seen")
            x.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.base}/seen")
        self.spark.read.parquet(f"{at}/summary").withColumn("rows_written", F.lit(self.spark.read.parquet(f"{at}/rows").count())).write.mode("overwrite").json(f"{self.base}/log/run={run}")
        _delete(self.spark, at)

    def _publish(self, source: str, target: str) -> None:
        self.spark.read.parquet(source).write.mode("overwrite").parquet(target)
