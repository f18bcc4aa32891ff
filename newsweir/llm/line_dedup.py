"""Lines that many documents hold, kept in one of them only.

1. Every line's key is hashed to 128 bits; a written table has one row of numbers for each line that is long enough.
2. The documents of each distinct hash are counted (combined before the shuffle), and of those in two documents or more the
   hashes are dealt to shards by hash. A task builds a shard's minimal perfect hash, which gives every hash of the shard a slot
   of its own, and fills the arrays: a fingerprint (the other half of the hash, by which lines of one document alone, that the
   shard doesn't hold, are told apart), the count, and the greatest doc_id.
3. Documents probe the arrays: each line's hash goes to its shard's task, which loads one shard at a time, looks up whole
   batches of hashes, and gives back which lines of which document go. No line is joined to a line.

A line that very many documents hold would send all its probes to one shard. Hashes with more than a sixteenth of a task's share
of all lines are fewer than sixteen a task at any size of the corpus; they form a small index of their own, which every task
holds and probes in place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, discard, mix64, partitions, slices

MIN_CHARS, MIN_DOCS, SHARD, SLICE = 40, 5, 1 << 16, 1 << 23
SPACE = " \t\n\v\f\r"
LEAST = -(1 << 63)


class PerfectHash:
    """Slots 0 to n-1 for n distinct 128-bit hashes (two columns), about three bits a hash.

    Each level has twice as many bits as hashes are left; a hash that is alone on its bit is settled there, the others go to
    the next level. A slot is the number of bits set before, by counts at every 64-bit word."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @staticmethod
    def _bits(h: np.ndarray, level: int, size: int) -> np.ndarray:
        turn = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
        return (mix64(h[:, 0] ^ mix64(h[:, 1] + turn)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, h: np.ndarray) -> PerfectHash:
        sizes, words, level = [], [], 0
        while len(h):
            size = -(-2 * len(h) // 64) * 64
            at = cls._bits(h, level, size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            h = h[~alone[at]]
            level += 1
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64))

    def slots(self, h: np.ndarray) -> np.ndarray:
        """The slot of every hash; of one that isn't held, any slot or -1."""
        out, left, start = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = start + self._bits(h[left], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            here = self.words[word]
            found = (here >> bit) & np.uint64(1) == 1
            below = here & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[found]] = (self.ranks[word] + np.bitwise_count(below))[found]
            left, start = left[~found], start + size
        return out


class Shard:
    """Fingerprints, counts and greatest doc_ids, in the slots of a minimal perfect hash."""

    def __init__(self, slots: PerfectHash, prints: np.ndarray, counts: np.ndarray, last: np.ndarray) -> None:
        self.slots, self.prints, self.counts, self.last = slots, prints, counts, last

    @classmethod
    def of(cls, h: np.ndarray, counts: np.ndarray, last: np.ndarray) -> Shard:
        """From columns, one entry for each line's hash."""
        slots = PerfectHash.of(h)
        order = np.empty(len(h), np.int64)
        order[slots.slots(h)] = np.arange(len(h))
        return cls(slots, h[order, 1].copy(), np.minimum(counts, 0xFFFFFFFF).astype(np.uint32)[order], last[order])

    def to_bytes(self) -> bytes:
        head = np.array([len(self.slots.sizes), len(self.slots.words), len(self.prints)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.slots.sizes, self.slots.words, self.prints, self.last, self.counts))

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        (a, b, n), at, parts = np.frombuffer(data, np.int64, 3).tolist(), 24, []
        for size, kind in ((a, np.int64), (b, np.uint64), (n, np.uint64), (n, np.int64), (n, np.uint32)):
            parts.append(np.frombuffer(data, kind, size, at))
            at += size * np.dtype(kind).itemsize
        return cls(PerfectHash(parts[0], parts[1]), parts[2], parts[4], parts[3])

    def probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the hashes are held, and of these the counts and greatest doc_ids."""
        slot = self.slots.slots(h)
        at = np.flatnonzero(slot >= 0)
        at = at[self.prints[slot[at]] == h[at, 1]]
        return at, self.counts[slot[at]], self.last[slot[at]]


def line_hashes(texts: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number within the text and 128-bit hash (two columns) of all lines that are long enough."""
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    keys = pc.ascii_lower(pc.ascii_trim(lines.flatten(), SPACE))
    long = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
    first = lines.offsets.to_numpy() - lines.offsets[0].as_py()
    row = np.searchsorted(first, long, "right") - 1
    of = xxhash.xxh3_128_digest
    h = np.frombuffer(b"".join([of(k) for k in keys.take(pa.array(long)).cast(pa.binary()).to_pylist()]), "<u8").reshape(-1, 2)
    return row, long - first[row], h


def _hashed(min_chars: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2), SLICE):
                part = batch.slice(lo, hi - lo)
                row, line, h = line_hashes(part.column(2), min_chars)
                # the first line of each key in its document counts
                order = np.lexsort((line, h[:, 1], h[:, 0], row))
                same = (row[order[1:]] == row[order[:-1]]) & (h[order[1:]] == h[order[:-1]]).all(axis=1)
                new = np.ones(len(row), bool)
                new[order[1:]] = ~same
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(line, pa.int32()), *(pa.array(h[:, j].copy().view(np.int64)) for j in (0, 1)), pa.array(new)], names=["id", "k", "line", "h", "f", "new"])

    return go


def _equal(x: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal values next to each other."""
    edge = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    return list(zip(edge.tolist(), [*edge[1:].tolist(), len(x)], strict=True))


def _pairs(batch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in ("h", "f")], 1).view(np.uint64)


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays of shards, from counted hashes in order of shard."""
    held: list[pa.RecordBatch] = []

    def arrays() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        data = Shard.of(_pairs(t), t.column("n").to_numpy(), t.column("last").to_numpy()).to_bytes()
        return pa.RecordBatch.from_arrays([t.column("shard")[:1].combine_chunks(), pa.array([data])], names=["shard", "data"])

    for batch in batches:
        shard = batch.column(0).to_numpy()
        for lo, hi in _equal(shard):
            if held and held[0].column(0)[0].as_py() != shard[lo]:
                yield arrays()
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield arrays()


def _gone(arrays: Shard, batch: pa.RecordBatch, min_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The lines that the arrays hold, and those of them that go."""
    at, count, last = arrays.probe(_pairs(batch))
    return at, at[(count >= min_docs) & (last != batch.column("id").to_numpy()[at])]


def _routed(common: bytes, shards: int, min_docs: int):
    """Lines on the way to their shards; of those that the small index of common lines holds, those that go, with a shard
    below 0 that has no arrays."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Shard.from_bytes(common)
        for batch in batches:
            shard = batch.column("h").to_numpy() % shards
            held, gone = _gone(index, batch, min_docs)
            shard[gone] = -1 - (batch.column("id").to_numpy()[gone] + gone) % shards  # dealt out evenly, whatever the rows are
            stays = np.ones(batch.num_rows, bool)
            stays[held] = False
            stays[gone] = True
            at = pa.array(np.flatnonzero(stays))
            yield pa.RecordBatch.from_arrays([pa.array(shard).take(at), *(batch.column(c).take(at) for c in ("id", "k", "line", "h", "f"))], names=["shard", "id", "k", "line", "h", "f"])

    return go


def _probed(min_docs: int):
    """Lines that go, from lines in order of shard, each shard's arrays before its lines."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, arrays = None, None
        for batch in batches:
            shard, data = batch.column("shard").to_numpy(), batch.column("data")
            for lo, hi in _equal(shard):
                if shard[lo] != now:
                    now, arrays = shard[lo], None
                    if data[lo].is_valid:
                        arrays, lo = Shard.from_bytes(data[lo].as_py()), lo + 1
                part = batch.slice(lo, hi - lo)
                if now >= 0:
                    part = part.take(pa.array(_gone(arrays, part, min_docs)[1])) if arrays else part.slice(0, 0)
                yield part.select(["id", "k", "line"])

    return go


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines that go."""
    for batch in batches:
        for lo, hi in slices(batch.column(1), SLICE):
            part = batch.slice(lo, hi - lo)
            texts = pc.fill_null(part.column(1), "")
            n, gone = pc.add(pc.count_substring(texts, "\n"), 1).cast(pa.int64()), pc.fill_null(pc.list_value_length(part.column(2)), 0)
            at = np.flatnonzero(gone.to_numpy(zero_copy_only=False) > 0)
            kept = []
            for text, lines in zip(texts.take(pa.array(at)).to_pylist(), part.column(2).take(pa.array(at)).to_pylist(), strict=True):
                out = set(lines)
                kept.append("\n".join([x for k, x in enumerate(text.split("\n")) if k not in out]))
            if kept:
                mask = np.zeros(len(texts), bool)
                mask[at] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(kept, texts.type))
            yield pa.RecordBatch.from_arrays([part.column(0), n, gone.cast(pa.int64()), texts], names=["doc_id", "n_lines", "n_dropped", "kept"])


def without_common_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, hot: int | None = None, size: int = SHARD) -> DataFrame:
    """One row per document: doc_id, n_lines (before), n_dropped, kept (the other lines, joined by a line feed).

    Lines end at line feeds; null and empty texts have one empty line. A line's key has no white space at its ends and no
    capital A to Z; keys of at least `min_chars` code points in at least `min_docs` documents go, with all their lines, from
    all documents but those of the greatest doc_id that holds them. Rows equal in doc_id are documents of their own; a null
    doc_id is below all others. Texts of any length are read whole; an empty table gives an empty one; other columns don't
    come through. `hot` (16 a task) bounds the index of common lines, `size` the hashes of a shard."""
    if min_docs < 2:
        raise ValueError("min_docs is 2 at least")
    tasks = partitions(docs.sparkSession)
    hot = hot or 16 * tasks
    texts = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("id"), F.xxhash64("text").alias("k"), "text")
    lines = cut(texts.select("id", "k", "text").mapInArrow(_hashed(min_chars), "id long, k long, line int, h long, f long, new boolean"), "lines")
    counts = lines.where("new").groupBy("h", "f").agg(F.count("*").alias("n"), F.max("id").alias("last")).where("n > 1")
    counts = cut(counts, "counts")
    total, distinct = lines.where("new").count(), counts.count()
    often = F.col("n") > total / hot  # fewer than `hot` hashes, whatever the corpus has
    rows = counts.where(often).collect()
    common = Shard.of(np.array([[r.h, r.f] for r in rows], np.int64).reshape(-1, 2).view(np.uint64), np.array([r.n for r in rows], np.int64), np.array([r.last for r in rows], np.int64))
    shards = max(16 * tasks, -(-distinct // size))
    dealt = counts.where(~often).select(F.pmod("h", F.lit(shards)).alias("shard"), "h", "f", "n", "last")
    arrays = dealt.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(_built, "shard long, data binary")
    asked = lines.select("id", "k", "line", "h", "f").mapInArrow(_routed(common.to_bytes(), shards, min_docs), "shard long, id long, k long, line int, h long, f long")
    asked = asked.unionByName(arrays, allowMissingColumns=True).repartition(tasks, "shard").sortWithinPartitions("shard", F.col("data").isNull())
    gone = asked.mapInArrow(_probed(min_docs), "id long, k long, line int").groupBy("id", "k").agg(F.collect_set("line").alias("lines"))
    gone = cut(gone, "gone")  # so that both sides of the join are exchanges, of which Spark can split large ones
    discard(lines)
    discard(counts)
    key = docs.schema["doc_id"].dataType.simpleString()
    # a merge join at every size: texts are dealt out alike whether or not the lines that go would fit into a broadcast
    out = texts.join(gone.hint("merge"), ["id", "k"], "left").select("doc_id", "text", "lines")
    return out.mapInArrow(_kept, f"doc_id {key}, n_lines long, n_dropped long, kept string")
