"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame operations alone.

Texts are lower-cased runs of letters and digits; shingles are five such words. An item is in a document if at least
0.8 of the item's distinct shingles occur in it. An item with n shingles may then miss m = n - ceil(0.8 n), so of the
m + 1 shingles with the least hashes (its MinHash sketch) one at least occurs in the document: the search loses nothing.
Items are partitioned by size (powers of two). The greatest hash in the sketches of a partition is its limit, and the
shingles of a document under that limit are the document's sketch for it: a longer item has a lower limit, so the sketch is a
fraction of the shingles. A document has sketches only for the partitions whose items can be in it, those with no more than
1.25 times its distinct shingles. Sketches meet by hash. Candidates are verified by the exact containment of shingle strings; only their documents are
read a second time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, discard

SHINGLE, LEAST = 5, 0.8


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits of a text, none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: str, n: int = SHINGLE) -> Column:
    """Strings of n consecutive words of the array column `words`, none if there are fewer."""
    return F.expr(f"if(size({words}) < {n}, array(), transform(sequence(1, size({words}) - {n - 1}), i -> array_join(slice({words}, i, {n}), ' ')))").cast("array<string>")


def hashes_of(words: str, n: int = SHINGLE) -> Column:
    """64-bit hashes of the shingles, made of the words' hashes."""
    parts = ", ".join(f"h[i + {k}]" for k in range(n))
    coded = f"transform({words}, w -> xxhash64(w))"
    return F.expr(f"if(size({words}) < {n}, array(), transform(array({coded}), h -> transform(sequence(0, size(h) - {n}), i -> xxhash64({parts})))[0])").cast("array<bigint>")


def sketches(items: DataFrame, least: float = LEAST, n: int = SHINGLE) -> DataFrame:
    """item_id, n_item, size_class, sketch: the least hashes of each item's shingles. Items without shingles go."""
    x = items.select("item_id", words_of(F.col("text")).alias("words"))
    x = x.select("item_id", F.array_sort(F.array_distinct(hashes_of("words", n))).alias("h")).where("size(h) > 0")
    x = x.select("item_id", F.size("h").alias("n_item"), F.floor(F.log2(F.size("h"))).alias("size_class"), "h")
    return x.withColumn("sketch", F.slice("h", 1, (F.col("n_item") - F.ceil(least * F.col("n_item") - 1e-9) + 1).cast("int"))).drop("h")


def partition_limits(sketched: DataFrame) -> list[tuple[int, int]]:
    """(least size, greatest sketch hash) of every partition of items; as many as powers of two, so a bounded list."""
    got = sketched.groupBy("size_class").agg(F.min("n_item").alias("n"), F.max(F.element_at("sketch", -1)).alias("limit")).collect()
    return sorted((r.n, r.limit) for r in got)


def document_sketches(docs: DataFrame, limits: list[tuple[int, int]], least: float = LEAST, n: int = SHINGLE) -> DataFrame:
    """doc_id, hash: the shingle hashes of each document under the limit of a partition whose items it can hold."""
    x = docs.select("doc_id", words_of(F.col("text")).alias("words")).select("doc_id", hashes_of("words", n).alias("h"))
    of = F.greatest(F.lit(-(2**63)), *[F.when(F.size("h") >= math.ceil(least * size - 1e-9), F.lit(limit)).otherwise(-(2**63)) for size, limit in limits])
    x = x.where(F.size("h") >= math.ceil(least * limits[0][0] - 1e-9)).withColumn("limit", of)
    return x.select("doc_id", F.explode(F.filter("h", lambda h: h <= F.col("limit"))).alias("hash"))


def candidates(docs: DataFrame, items: DataFrame, least: float = LEAST, n: int = SHINGLE) -> DataFrame:
    """Distinct (doc_id, item_id) that share a shingle of the item's sketch. No pair that passes `least` is missing."""
    sketched = cut(sketches(items, least, n), "sketches")
    limits = partition_limits(sketched)
    if not limits:
        discard(sketched)
        return docs.select("doc_id").join(items.select("item_id"), F.lit(False)).distinct()
    x = document_sketches(docs, limits, least, n)
    found = cut(x.join(sketched.select("item_id", F.explode("sketch").alias("hash")), "hash").select("doc_id", "item_id").distinct(), "found")
    discard(sketched)
    return found


def contained(docs: DataFrame, items: DataFrame, least: float = LEAST, n: int = SHINGLE) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment of every document that holds an item.

    Null texts have no words; items and documents of fewer than five words have no shingles and match nothing. Rows that
    repeat a doc_id or item_id count as one with the greatest containment. Empty tables give an empty one. Texts of any length
    are read whole; equal hashes of different shingles only make candidates, which the strings then decide."""
    pairs = candidates(docs, items, least, n)
    ids = pairs.select(F.col("doc_id").alias("p")).distinct()
    d = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("p")), "left_semi").select("doc_id", words_of(F.col("text")).alias("words"))
    t = items.select("item_id", words_of(F.col("text")).alias("words")).select("item_id", F.array_distinct(shingles_of("words", n)).alias("of_item")).where("size(of_item) > 0")
    x = d.join(pairs.select(F.col("doc_id").alias("p"), "item_id"), F.col("doc_id").eqNullSafe(F.col("p"))).join(t.withColumnRenamed("item_id", "q"), F.col("item_id").eqNullSafe(F.col("q")))
    x = x.select("doc_id", "item_id", F.size("of_item").alias("n_item"), F.size(F.array_intersect("of_item", shingles_of("words", n))).alias("n_shared"))
    x = x.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("containment") >= least)
    best = F.max(F.struct("containment", "n_item", "n_shared")).alias("b")
    return x.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.n_item", "b.n_shared", "b.containment")


def contaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """One row per contaminated document: doc_id, n_items, item_list (ascending, joined by commas), containment (greatest).

    Nulls, repeated rows, ties, empty tables and very long texts as in `contained`."""
    x = contained(docs, items, **how).groupBy("doc_id").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_set("item_id")).alias("s"), F.max("containment").alias("containment"))
    return x.select("doc_id", "n_items", F.array_join(F.col("s").cast("array<string>"), ",").alias("item_list"), "containment")


def clean_documents(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The documents that hold no item, all columns as they are.

    Null and empty texts, and texts of too few words for a shingle, hold none and stay; so do all documents if there are no
    items. Rows that repeat a doc_id, null ones included, are judged together: if one holds an item, all go. A containment of
    exactly the limit counts. Texts of any length are read whole; an empty table gives an empty one."""
    bad = contained(docs, items, **how).select(F.col("doc_id").alias("_nw_bad")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_nw_bad")), "left_anti")
