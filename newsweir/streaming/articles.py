"""Articles as a stream: candidates once per URL, counts by window, and the state of sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import candidates
from ..sources.state import Store


def fresh_stream(articles: DataFrame, hours: int = 48, late: str = "48 hours") -> DataFrame:
    """Candidates of a stream (url, title, published_at): each URL once within the watermark, rows without a date as of now.

    The state holds the URL hashes of the watermark's span alone."""
    x = articles.withColumn("at", F.coalesce("published_at", F.current_timestamp()))
    x = candidates(x).where(F.col("at") >= F.current_timestamp() - F.expr(f"interval {int(hours)} hours")) if hours else candidates(x)
    return x.withWatermark("at", late).dropDuplicatesWithinWatermark(["url_hash"])


def committed(articles: DataFrame, store: Store, made: Callable[[DataFrame], dict[str, DataFrame]], checkpoint: str, name: str = "batch") -> StreamingQuery:
    """Commit each batch of a stream to a store once, as a run named by its number, until all that is there now is done.

    `made` gives a batch's rows, marks and summary (see `plans.runs.production_run`). A batch that failed anywhere is
    delivered again with its number; what it had committed or staged is not made a second time."""

    def commit(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            store.commit(f"{name}-{number:08d}", lambda: made(batch))

    return articles.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, key: str, at: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """key, start, end, n: spans of a key's rows of which each is within `gap` of the next, of a stream or a table."""
    x = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return x.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def counts_by_window(events: DataFrame, at: str, key: Column, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows by window and key of a stream or table; late rows beyond the watermark are left out of a stream."""
    x = events.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), key.alias("key")).agg(F.count("*").alias("n"))
    return x.select(F.col("w.start").alias("start"), "key", "n")


def source_gaps(events: DataFrame, key: str, at: str) -> DataFrame:
    """key, calls, last: a running state of each source of a stream, as updates; the state is two numbers a source."""
    out, state = f"{key} string, calls long, last timestamp", "calls long, last timestamp"

    def update(k: tuple, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        calls, last = held.get if held.exists else (0, pd.Timestamp(0))
        for b in batches:
            calls, last = calls + len(b), max(last, b[at].max())
        held.update((int(calls), last))
        yield pd.DataFrame({key: [k[0]], "calls": [calls], "last": [last]})

    return events.groupBy(key).applyInPandasWithState(update, out, state, "update", "NoTimeout")


def write_once(stream: DataFrame, path: str, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None):
    """Process what is there and end: exactly once into Parquet, or by a function of each batch."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.foreachBatch(each).start() if each else w.format("parquet").option("path", path).start()
    q.awaitTermination()
    return q
