"""Exact substring dedup over bytes, with suffix arrays built by the difference-cover algorithm.

`repeats` deals strings to tasks by anchor, so that equal windows meet in one task, however large the corpus; of strings with
many copies it deals two. A task sorts the suffixes of its strings by the difference cover {1, 2} modulo 3: it sorts the sampled
triples, names them, recurses on the names until they are unique or cover a window, merges the remaining suffixes, and compares
the prefixes of suffixes that are adjacent in order, byte by byte. Anchors with too many classes for one task are cut into parts,
and what is still too much is counted by windows' digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import mix64, ragged
from .repeats import _ranges, covered, repeated_windows

WIDTH, GRAM, STRETCH, COMPARED = 200, 32, 16, 1 << 20
_BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def in_order(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of keys of at most `bits` bits, for each place in that order where its equals start, and the flags of the
    places where they do."""
    n = len(keys)
    low = max(1, n - 1).bit_length()
    if bits + low <= 63:  # keys and places in one number sort faster than places by keys
        packed = np.sort(keys << low | np.arange(n))
        order, k = packed & ((1 << low) - 1), packed >> low
    else:
        order = np.argsort(keys)
        k = keys[order]
    new = np.ones(n, bool)
    np.not_equal(k[1:], k[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return order, np.repeat(first, np.diff(np.append(first, n))), new


def names_of(keys: np.ndarray, bits: int = 63) -> np.ndarray:
    """Ranks of keys from 1, equal keys alike."""
    order, _, new = in_order(keys, bits)
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new)
    return out


def merged(a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the keys a, then b: how many of both are less, and how many of b."""
    order, first, _ = in_order(np.concatenate([a, b]), bits)
    less, less_b = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    of_b = np.concatenate([[0], np.cumsum(order >= len(a))])
    less[order], less_b[order] = first, of_b[first]
    return less, less_b


def suffix_ranks(s: np.ndarray, depth: int, span: int = 1) -> np.ndarray:
    """Ranks of the suffixes of s (positive integers, no more different ones than symbols, each spanning `span` symbols
    of the text). Suffixes that agree over `depth` symbols may share a rank."""
    n = len(s)
    w, p = int(s.max(initial=1)).bit_length(), np.concatenate([s, np.zeros(6, np.int64)])
    # a suffix past the end of each kind closes the ones and the zeros
    zero, one, two = np.arange(0, n + 1, 3), np.arange(1, n + 1, 3), np.arange(2, n + 2, 3)
    sample = np.concatenate([one, two])
    if 3 * w <= 63:
        named = names_of((p[sample] << w | p[sample + 1]) << w | p[sample + 2], 3 * w)
    else:  # two symbols as one, by their rank
        named = names_of(names_of(p[sample] << w | p[sample + 1], 2 * w) << w | p[sample + 2])
    count = int(named.max(initial=0))
    if count < len(sample) and span * 3 < depth:
        ranks = suffix_ranks(named, depth, span * 3)
        named = np.cumsum(np.bincount(ranks) > 0)[ranks]
        count = int(named.max(initial=0))
    r, g = np.zeros(n + 6, np.int64), np.zeros(n + 6, np.int64)
    r[sample] = named
    # zeros and ones compare by a symbol and the name after it; zeros and twos by a symbol and the rank, among zeros and
    # ones, of the suffix after it
    b, (z, o) = count.bit_length(), (len(zero), len(one))
    less, less_one = merged(p[zero] << b | r[zero + 1], p[one] << b | r[one + 1], w + b)
    g[zero], g[one] = less[:z], less[z:]
    b = (z + o).bit_length()
    both, less_two = merged(p[zero] << b | g[zero + 1], p[two] << b | g[two + 1], w + b)
    # how many suffixes of each kind are less
    of_sample = np.cumsum(np.bincount(named, minlength=count + 1))[named - 1]
    out = np.empty(n + 3, np.int64)
    out[zero] = less[:z] + less_two[:z]
    out[one] = of_sample[:o] + (less - less_one)[z:]
    out[two] = of_sample[o:] + (both - less_two)[z:]
    return out[:n]


def equal_windows(text: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Which windows of bytes at `starts` (ascending) are equal to a window at another of `starts`."""
    out = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return out
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(4 * width, np.int64)])
    order, _, _ = in_order(suffix_ranks(padded, width)[starts], len(padded).bit_length())
    equal = np.zeros(len(order) - 1, bool)
    a, b = starts[order[:-1]], starts[order[1:]]
    # neighbours whose two windows both move on by one byte are compared as one longer stretch
    by = np.argsort(order[:-1])
    step, far = np.diff(a[by]), np.diff((b - a)[by])
    edge = np.flatnonzero(np.concatenate([[True], (step != 1) | (far != 0)]))
    windows = np.diff(np.append(edge, len(by)))
    long = windows >= STRETCH
    first, size = edge[long], windows[long] + width - 1
    for lo, hi in _parts_of(size, COMPARED):
        at = ragged(a[by[first[lo:hi]]], size[lo:hi])
        unlike = np.concatenate([[0], np.cumsum(text[at] != text[at + np.repeat((b - a)[by[first[lo:hi]]], size[lo:hi])])])
        w = size[lo:hi] - width + 1
        k = ragged(np.cumsum(size[lo:hi]) - size[lo:hi], w)
        equal[by[ragged(first[lo:hi], w)]] = unlike[k + width] == unlike[k]
    alive = by[np.repeat(~long, windows)]
    if len(alive):
        eight = np.lib.stride_tricks.as_strided(np.concatenate([text, np.zeros(8, np.uint8)])[: len(text) + 8 - (len(text) + 8) % 8].view("<u8"), (len(text),), (1,))
        for k in [*range(0, width - 7, 8), width - 8]:
            alive = alive[eight[a[alive] + k] == eight[b[alive] + k]]
        equal[alive] = True
    out[order[:-1][equal]] = True
    out[order[1:][equal]] = True
    return out


def _parts_of(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries that sum up to about `most`."""
    ends, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most)))
        yield lo, hi
        lo = hi


def _bytes(texts: pa.Array):
    for t in texts:
        yield np.frombuffer(t.as_buffer(), np.uint8) if t.is_valid else np.zeros(0, np.uint8)


def _apply(width: int, with_text: bool):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out = []
                for sym, spans in zip(_bytes(part.column(1)), part.column(2).to_pylist(), strict=True):
                    gone = covered(len(sym), spans, width)
                    kept = sym[~gone].tobytes()
                    out.append((len(sym), len(sym) - len(kept), len(_ranges(gone)[0]), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
                cols = list(zip(*out, strict=True))
                arrays = [part.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), *[pa.array(cols[4], pa.binary())] * with_text]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text])

    return go


def without_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, with_text: bool = False, **how) -> DataFrame:
    """Remove every byte that lies in a string of `width` bytes which also starts elsewhere in the texts of `docs`.

    One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and with `with_text`
    the kept bytes. Strings are judged on the input; null texts are empty; texts shorter than `width` stay; rows that
    repeat a doc_id are documents of their own, so equal rows lose all windows; texts of any length are taken whole; an
    empty table gives an empty one."""
    spans = repeated_windows(docs, _bytes, _BYTE_HASH.__getitem__, lambda t, s: equal_windows(t, s, width), width, gram, "u1", **how)
    t, q = docs.select("doc_id", "text", F.xxhash64("text").alias("k")).alias("t"), spans.alias("q")
    x = t.join(q, F.col("t.doc_id").eqNullSafe(F.col("q.doc_id")) & F.col("t.k").eqNullSafe(F.col("q.k")), "left").select("t.doc_id", "text", "spans")
    return x.mapInArrow(_apply(width, with_text), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string{', kept binary' * with_text}")
