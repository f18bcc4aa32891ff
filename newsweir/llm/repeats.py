"""Windows of symbols that start at more than one place of a corpus, found without an all-pairs step.

Every window of `width` symbols has an anchor: of its grams of `gram` symbols the one with the least hash, the leftmost
of equals. As the anchor is a function of the window alone, equal windows have equal anchors at equal offsets. Consecutive
windows with the same anchor form a run, and a run is known by its anchor's hash and a 128-bit digest of its symbols.

1. Runs whose anchor occurs once hold no repeated window and go (two counts by key, combined before the shuffle).
2. Runs with equal digests form a class, of which the first and the last run stand for all: a class of very many copies sends
   two strings on, not more.
3. The strings of all anchors with two runs or more are dealt to tasks by anchor, so that equal windows meet in one task, and
   a `settle` function compares the windows of all strings, those of the two runs of a class included, and says which occur
   twice.
4. Anchors with more than MANY classes never meet in a task: their strings are cut into parts of few windows, dealt by the
   symbols that these have in common, and parts of which more than MANY meet are counted by digests of single windows.
5. Repeated windows go back to all runs of their class and to their documents, which are read once more to apply them.

Steps 1, 2 and 4 hold however many rows share an anchor or a run; joins by run have one row per run on one side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, discard, mix64, partitions

MANY, CHUNK, TASK_SYMBOLS = 2048, 1 << 22, 1 << 18
_CLASS = ["mh", "c1", "c2"]


def gram_hashes(h: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of `gram` symbols from the symbols' hashes, by doubling."""
    total, done, power, step = None, 0, 1, h
    mult = 0x9E3779B97F4A7C15
    left = gram
    while True:
        if left & 1:
            m = len(h) - (done + power) + 1
            total = step[:m] if total is None else total[:m] * np.uint64(mult) + step[done : done + m]
            done += power
        left >>= 1
        if not left:
            return mix64(total)
        step, power, mult = step[: len(step) - power] * np.uint64(mult) + step[power:], power * 2, (mult * mult * 0x9E3779B97F4A7C15 | 1) % (1 << 64)


def runs_of(grams: np.ndarray, per_window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor position of every run; a window has `per_window` grams."""
    first, count, anchor = [], [], []
    last = len(grams) - per_window  # of the windows
    for lo in range(0, last + 1, CHUNK):
        part = grams[lo : min(lo + CHUNK - 1, last) + per_window]
        key = part & ~np.uint64(0xFFFFFF) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span * 2 <= per_window:
            key, span = np.minimum(key[: len(key) - span], key[span:]), span * 2
        n = len(part) - per_window + 1
        if span < per_window:
            key = np.minimum(key[:n], key[per_window - span : per_window - span + n])
        at = (key[:n] & np.uint64(0xFFFFFF)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        first.append(starts + lo)
        count.append(np.diff(np.append(starts, n)))
        anchor.append(at[starts] + lo)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (first, count, anchor))


def digests(data: memoryview, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit digests of slices of bytes, as pairs of 64-bit integers."""
    of = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([of(data[a:b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]), "<i8").reshape(-1, 2)


def _runs(symbols: Callable, hashed: Callable, width: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                rows, cols = [], ([], [], [], [])
                for row, sym in enumerate(symbols(part.column(2))):
                    if len(sym) < width:
                        continue
                    g = gram_hashes(hashed(sym), gram)
                    first, count, anchor = runs_of(g, width - gram + 1)
                    size = sym.itemsize
                    c = digests(memoryview(sym).cast("B"), first * size, (first + count - 1 + width) * size)
                    rows.append(np.full(len(first), row))
                    for col, x in zip(cols, (first, count, g[anchor].view(np.int64), c), strict=True):
                        col.append(x)
                if rows:
                    at = pa.array(np.concatenate(rows))
                    first, count, mh, c = map(np.concatenate, cols)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), *map(pa.array, (first, count, mh, c[:, 0].copy(), c[:, 1].copy()))], names=["doc_id", "k", "s", "n", *_CLASS])

    return find


def _slices(symbols: Callable, width: int):
    """Symbols of the runs that a document is asked for; a task answers for one of the rows that are equal in id and text."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answered: set[tuple] = set()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out, data = [], []
                for doc, k, sym, want in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), symbols(part.column(2)), part.column(3).to_pylist(), strict=True):
                    if (doc, k) in answered:
                        continue
                    answered.add((doc, k))
                    raw, size = memoryview(np.ascontiguousarray(sym)).cast("B"), sym.itemsize
                    for w in want:
                        out += [w] * w["times"]
                        data += [bytes(raw[w["s"] * size : (w["s"] + w["n"] - 1 + width) * size])] * w["times"]
                if out:
                    yield pa.RecordBatch.from_pydict({c: pa.array([w[c] for w in out], pa.int64()) for c in (*_CLASS, "n", "classes")} | {"data": pa.array(data, pa.binary())})

    return take


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _settled(settle: Callable, dtype: str, width: int):
    """Ranges of windows that occur in two strings, from strings in order of bucket."""

    def work(keys: list[np.ndarray], data: list[bytes]):
        key = np.concatenate(keys)  # bucket, mh, c1, c2, off
        # a string that is alone in its bucket is compared with none: its windows have one anchor at unlike places
        new = np.concatenate([[True], key[1:, 0] != key[:-1, 0]])
        own = np.flatnonzero(~(new & np.append(new[1:], True)))
        text = np.frombuffer(b"".join([data[k] for k in own.tolist()]), dtype)
        count = np.array([len(data[k]) for k in own.tolist()], np.int64) // np.dtype(dtype).itemsize - width + 1
        at, first = np.cumsum(count + width - 1) - (count + width - 1), np.cumsum(count) - count
        starts = np.arange(int(count.sum())) + np.repeat(at - first, count)
        a, b = _ranges_within(settle(text, starts), first, count)
        of = np.searchsorted(first, a, "right") - 1
        move, of = key[own[of], 4] - first[of], own[of]
        return pa.RecordBatch.from_arrays([*(pa.array(key[of, j]) for j in range(1, 4)), pa.array(a + move), pa.array(b + move)], names=[*_CLASS, "a", "b"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, data, held, last = [], [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, d = batch.column(0).to_numpy(), batch.column(5).to_pylist()
            k = np.stack([batch.column(j).to_numpy() for j in range(5)], 1)
            lo = 0
            for c in [*np.flatnonzero(np.concatenate([[last != bucket[0]], bucket[1:] != bucket[:-1]])).tolist(), len(k)]:
                if c > lo:
                    keys.append(k[lo:c])
                    data += d[lo:c]
                    held += sum(map(len, d[lo:c]))
                    lo, last = c, bucket[c - 1]
                if c < len(k) and held >= TASK_SYMBOLS * np.dtype(dtype).itemsize:
                    yield work(keys, data)
                    keys, data, held = [], [], 0
        if data:
            yield work(keys, data)

    return go


def _ranges_within(flags: np.ndarray, first: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges of set flags that don't cross the start of a string."""
    before = np.concatenate([[False], flags[:-1]])
    new = flags & ~before
    new[first[windows > 0]] |= flags[first[windows > 0]]
    a = np.flatnonzero(new)
    after = np.concatenate([~flags[1:], [True]])
    ends = first[windows > 0] + windows[windows > 0] - 1
    after[ends] = True
    return a, np.flatnonzero(flags & after) + 1


def _parts(hashed: Callable, dtype: str, width: int, gram: int):
    """Strings cut into runs of at most PART windows, whose bucket is the digest of the symbols that all windows at those
    places from the anchor have in common, whether the string has them all or not."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, step = np.dtype(dtype).itemsize, max(1, width // 12)
        for batch in batches:
            rows, data = [], []
            for row, raw in enumerate(batch.column(5)):
                raw = raw.as_py()
                sym = np.frombuffer(raw, dtype)
                n = len(sym) - width + 1
                anchor = int(runs_of(gram_hashes(hashed(sym), gram), width - gram + 1)[2][0])
                back = (anchor - np.arange(n)) // step  # how far before the anchor a window starts
                for g in np.unique(back).tolist():
                    at = np.flatnonzero(back == g)
                    lo, hi = int(at[0]), int(at[-1]) + 1
                    core = slice(max(anchor - g * step, 0), anchor - (g + 1) * step + 1 + width)
                    rows.append((row, lo, int.from_bytes(xxhash.xxh3_64_digest(raw[core.start * size : core.stop * size]), "little", signed=True)))
                    data.append(raw[lo * size : (hi - 1 + width) * size])
            if rows:
                at = pa.array([r[0] for r in rows])
                fixed = [batch.column(j).take(at) for j in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array([r[2] for r in rows], pa.int64()), *fixed, pa.array([r[1] for r in rows], pa.int64()), pa.array(data, pa.binary())], names=["bucket", *_CLASS, "off", "data"])

    return go


def _windows(width: int, dtype: str):
    """Digests of all windows of strings."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.dtype(dtype).itemsize
        for batch in batches:
            for row in range(batch.num_rows):
                data = memoryview(batch.column(5)[row].as_py())
                n = len(data) // size - width + 1
                w = digests(data, np.arange(n) * size, (np.arange(n) + width) * size)
                fixed = [pa.array(np.full(n, batch.column(j)[row].as_py())) for j in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(np.arange(n) + batch.column(4)[row].as_py()), pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy())], names=[*_CLASS, "a", "w1", "w2"])

    return go


def repeated_windows(docs: DataFrame, symbols: Callable, hashed: Callable, settle: Callable, width: int, gram: int, dtype: str, many: int = MANY) -> DataFrame:
    """doc_id, k (hash of the text), spans: ranges [a, b) of first symbols of windows that start at another place too.

    symbols(texts) gives the symbols (of `dtype`) of each text of an Arrow array; hashed(symbols) gives their hashes.
    settle(text, starts) says which windows of a string at `starts` are equal to another there. Documents without
    such windows have no row; documents that are equal in doc_id and text share one."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("k"), "text")
    runs = cut(texts.mapInArrow(_runs(symbols, hashed, width, gram), "doc_id long, k long, s long, n long, mh long, c1 long, c2 long"), "runs")
    # what is joined below is written first: a join of two exchanges alone can be split where one key has very many rows
    often = cut(runs.groupBy("mh").agg(F.count("*").alias("c")).where("c > 1").select("mh"), "often")
    live = cut(runs.join(often, "mh", "left_semi"), "live")
    discard(runs)
    place = F.struct("doc_id", "k", "s")
    classes = live.groupBy(*_CLASS).agg(F.count("*").alias("runs"), F.min(place).alias("rep"), F.max(place).alias("last"), F.max("n").alias("n"))
    classes = cut(classes, "classes")
    several = classes.groupBy("mh").agg(F.count("*").alias("classes"))
    # two runs of a class at one place are rows that are equal in id and text: that place is sent twice
    alone = F.col("rep").eqNullSafe(F.col("last"))
    sent = F.when(alone, F.array(F.struct(F.col("rep").alias("at"), F.least("runs", F.lit(2)).cast("int").alias("times")))).otherwise(F.array(F.struct(F.col("rep").alias("at"), F.lit(1).alias("times")), F.struct(F.col("last").alias("at"), F.lit(1).alias("times"))))
    asked = classes.join(several, "mh").where("classes > 1 or runs > 1").select(*_CLASS, "n", "classes", F.explode(sent).alias("x"))
    asked = asked.select("x.at.doc_id", "x.at.k", F.struct(*_CLASS, "n", "classes", "x.times", "x.at.s").alias("want"))
    asked = asked.groupBy("doc_id", "k").agg(F.collect_list("want").alias("want"))
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.k").eqNullSafe(F.col(f"{b}.k"))
    strings = texts.alias("t").join(asked.alias("q"), same("t", "q")).select("t.doc_id", "t.k", "text", "want")
    strings = cut(strings.mapInArrow(_slices(symbols, width), "mh long, c1 long, c2 long, n long, classes long, data binary"), "strings")
    n, ranged = partitions(docs.sparkSession), "mh long, c1 long, c2 long, a long, b long"
    row = ["bucket", *_CLASS, "off", "data"]
    few = strings.where(F.col("classes") <= many).select(F.col("mh").alias("bucket"), *_CLASS, F.lit(0).cast("long").alias("off"), "data")
    # anchors with many classes: by what windows at about the same place have in common
    parts = strings.where(F.col("classes") > many).select(*_CLASS, "n", "classes", "data").mapInArrow(_parts(hashed, dtype, width, gram), "bucket long, mh long, c1 long, c2 long, off long, data binary")
    sizes = parts.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    parts = cut(parts.join(sizes, "bucket").select(*row, "c"), "parts")
    few = few.unionByName(parts.where(F.col("c") <= many).select(*row))
    few = few.repartition(n, "bucket").sortWithinPartitions("bucket", *_CLASS, "off").mapInArrow(_settled(settle, dtype, width), ranged)
    # and what is still too much for a task, by digests of single windows
    hot = parts.where(F.col("c") > many).select(*row).mapInArrow(_windows(width, dtype), "mh long, c1 long, c2 long, a long, w1 long, w2 long")
    counted = hot.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1").select("w1", "w2")
    hot = hot.join(counted, ["w1", "w2"], "left_semi").select(*_CLASS, "a", (F.col("a") + 1).alias("b"))
    ranges = few.unionByName(hot)
    ranges = cut(ranges.groupBy(*_CLASS).agg(F.collect_set(F.struct("a", "b")).alias("r")), "ranges")
    spans = live.join(ranges, _CLASS).select("doc_id", "k", F.transform("r", lambda x: F.struct((x["a"] + F.col("s")).alias("a"), (x["b"] + F.col("s")).alias("b"))).alias("r"))
    spans = cut(spans.groupBy("doc_id", "k").agg(F.flatten(F.collect_list("r")).alias("spans")), "spans")
    for x in (live, classes, strings, parts, often, ranges):
        discard(x)
    return spans


def covered(n: int, spans: list[dict] | None, width: int) -> np.ndarray:
    """Flags of the symbols, of n, that a window at a start of `spans` covers."""
    edges = np.zeros(n + 1, np.int64)
    if spans:
        a, b = np.array([s["a"] for s in spans]), np.array([s["b"] for s in spans])
        np.add.at(edges, a, 1)
        np.add.at(edges, b - 1 + width, -1)
    return np.cumsum(edges[:-1]) > 0
