"""Substring dedup over words by level-wise doubling.

Over the corpus, the level of a quarter of the final length comes first: every final window sends one window of that length
(its anchor, see `repeats`), and final windows whose anchor occurs once are out. In a task, which has all strings of an
anchor, windows of one word grow to twice their length again and again. A window is formed only of two windows that
both were repeated at the level before, and each level keeps the windows that occur twice, until the final length or until no
candidate survives.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import covered, repeated_windows

WIDTH = 35


def equal_windows(words: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Which windows of words (64-bit hashes) at `starts` are equal to a window at another of `starts`."""
    out = np.zeros(len(starts), bool)
    wanted = np.zeros(len(words), bool)
    wanted[starts] = True
    covers, names = 1, np.unique(words, return_inverse=True)[1].ravel().astype(np.int64)
    alive = np.bincount(names, minlength=1)[names] > 1 if len(names) else out
    while covers < width:
        longer = min(2 * covers, width)
        step, n = longer - covers, len(words) - longer + 1
        if n < 1:
            return out
        at = np.flatnonzero(alive[:n] & alive[step : step + n] & (wanted[:n] if longer == width else True))
        if not len(at):
            return out
        pairs = names[at] * (int(names.max()) + 1) + names[at + step]
        _, back, count = np.unique(pairs, return_inverse=True, return_counts=True)
        names, alive = np.zeros(n, np.int64), np.zeros(n, bool)
        names[at], alive[at] = back.ravel(), count[back.ravel()] > 1
        covers = longer
    return alive[starts]


def _words(texts: pa.Array):
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = split.flatten()
    coded = pc.dictionary_encode(flat)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    every = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.uint64)
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    at = split.offsets.to_numpy() - split.offsets[0].as_py()
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield every[a:b][there[a:b]]


def _same(x: np.ndarray) -> np.ndarray:
    return x


def _apply(width: int, with_text: bool):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                split = pc.ascii_split_whitespace(pc.fill_null(part.column(1), ""))
                flat, at = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
                there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
                n = np.diff(np.concatenate([[0], np.cumsum(there)])[at])
                keep = there.copy()
                for row in np.flatnonzero(part.column(2).is_valid().to_numpy(zero_copy_only=False)).tolist():
                    own = np.flatnonzero(there[at[row] : at[row + 1]]) + at[row]
                    keep[own[covered(int(n[row]), part.column(2)[row].as_py(), width)]] = False
                upto = np.concatenate([[0], np.cumsum(keep)])[at]
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), flat.filter(pa.array(keep))), " ")
                sums = [hashlib.sha256(t.as_buffer()).hexdigest() for t in text]
                arrays = [part.column(0), pa.array(n), pa.array(n - np.diff(upto)), pa.array(sums, pa.string()), *[text] * with_text]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * with_text])

    return go


def without_repeats(docs: DataFrame, width: int = WIDTH, with_text: bool = False, **how) -> DataFrame:
    """Remove every word that lies in a window of `width` words whose sequence also starts elsewhere in `docs`.

    One row per document: doc_id, n_words, n_removed, kept_sha256, and with `with_text` the kept words joined by a space.
    Windows are judged on the input; null texts have no words; rows that repeat a doc_id are documents of their own,
    so equal rows lose all windows; texts of any length are taken whole; an empty table gives an empty one."""
    spans = repeated_windows(docs, _words, _same, lambda t, s: equal_windows(t, s, width), width, (width + 3) // 4, "u8", **how)
    t, q = docs.select("doc_id", "text", F.xxhash64("text").alias("k")).alias("t"), spans.alias("q")
    x = t.join(q, F.col("t.doc_id").eqNullSafe(F.col("q.doc_id")) & F.col("t.k").eqNullSafe(F.col("q.k")), "left").select("t.doc_id", "text", "spans")
    return x.mapInArrow(_apply(width, with_text), f"doc_id long, n_words long, n_removed long, kept_sha256 string{', kept string' * with_text}")
