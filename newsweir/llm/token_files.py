"""Token-ID output in directly addressable codes.

A file holds the ids of consecutive documents. An id is split into chunks of 8 bits. Level 0 has the low chunk of every
id; a bitmap says which ids go on, and level 1 holds the next chunk of those alone, and so on. A rank directory has the
number of set bits before every 512th position, so the chunk of any id on the next level is found by one directory entry
and a popcount of at most 64 bytes: any token is read without decoding others.

Layout (little endian): b"DAC1", u32 documents D, u64 ids N, u8 levels, i64[D] doc ids, u8[D] whether the doc id is
there, u64[D+1] first ids, then per level: u64 length n, u8[n] chunks, and unless it is the last: u8[(n+7)//8] bitmap,
u64[n//512+1] directory. Files are rows of a Parquet table (part, seg, blob), which Spark commits whole or not at all. The
table isn't compressed, so a blob stands in its Parquet file byte for byte, and an id is read by reading a few bytes of it.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import partitions, shared_dir
from .tokens import Pieces, encode_words

TOKENIZER, END, PER_FILE, TEXT = "word_bpe_49k.json", 1, 1_000_000, 16_000_000
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file from the ids of documents, one after another."""
    there = np.array([d is not None for d in doc_ids], np.uint8)
    out, levels, rest = [], 0, ids.astype(np.uint64)
    while True:
        low, rest = (rest & np.uint64(255)).astype(np.uint8), rest >> np.uint64(8)
        more = rest > 0
        levels += 1
        out += [struct.pack("<Q", len(low)), low.tobytes()]
        if not more.any():
            break
        bits = np.packbits(more, bitorder="little")
        upto = np.concatenate([[0], np.cumsum(more, dtype=np.uint64)])
        out += [bits.tobytes(), upto[: len(low) // 512 * 512 + 1 : 512].astype("<u8").tobytes()]
        rest = rest[more]
    head = b"DAC1" + struct.pack("<IQB", len(doc_ids), len(ids), levels)
    first = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    return b"".join([head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), there.tobytes(), first.tobytes(), *out])


class TokenFile:
    """Random access to a file's ids."""

    def __init__(self, blob: bytes):
        if blob[:4] != b"DAC1":
            raise ValueError("not a token file")
        d, self.n, levels = struct.unpack_from("<IQB", blob, 4)
        at = 17
        ids, at = np.frombuffer(blob, "<i8", d, at), at + 8 * d
        there, at = np.frombuffer(blob, np.uint8, d, at), at + d
        self.doc_ids = [int(i) if t else None for i, t in zip(ids, there, strict=True)]
        self.first, at = np.frombuffer(blob, "<u8", d + 1, at).astype(np.int64), at + 8 * (d + 1)
        self.levels = []
        for k in range(levels):
            (n,) = struct.unpack_from("<Q", blob, at)
            low, at, bits, ranks = np.frombuffer(blob, np.uint8, n, at + 8), at + 8 + n, None, None
            if k < levels - 1:
                bits, at = np.frombuffer(blob, np.uint8, (n + 7) // 8, at), at + (n + 7) // 8
                ranks, at = np.frombuffer(blob, "<u8", n // 512 + 1, at), at + 8 * (n // 512 + 1)
            self.levels.append((low, bits, ranks))

    @staticmethod
    def rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before position i."""
        lo = i // 512
        n = int(ranks[lo]) + int(_POP[bits[lo * 64 : i // 8]].sum())
        return n + (int(_POP[int(bits[i // 8]) & ((1 << i % 8) - 1)]) if i % 8 else 0)

    def token(self, i: int) -> int:
        """The i-th id."""
        value = shift = 0
        for low, bits, ranks in self.levels:
            value |= int(low[i]) << shift
            if bits is None or not int(bits[i // 8]) >> i % 8 & 1:
                return value
            i, shift = self.rank(bits, ranks, i), shift + 8
        return value

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Ids begin to end-1."""
        out, where, shift = np.zeros(end - begin, np.uint32), np.arange(end - begin), 0
        for low, bits, ranks in self.levels:
            if begin == end:
                break
            out[where] |= low[begin:end].astype(np.uint32) << np.uint32(shift)
            if bits is None:
                break
            on = np.unpackbits(bits[begin // 8 : (end + 7) // 8], bitorder="little")[begin % 8 : begin % 8 + end - begin].astype(bool)
            begin = self.rank(bits, ranks, begin)
            where, end, shift = where[on], begin + int(on.sum()), shift + 8
        return out


def _writer(name: str, end_id: int, per_file: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part, seg = Pieces.of(name), TaskContext.get().partitionId(), 0
        docs, counts, ids, held = [], [], [], 0

        def flush():
            blob = pack(docs, np.concatenate(counts), np.concatenate(ids))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seg": pa.array([seg], pa.int32()), "n_tokens": pa.array([held], pa.int64()), "blob": pa.array([blob], pa.binary())})

        for batch in batches:
            texts, keys = batch.column(1), batch.column(0).to_pylist()
            sizes = np.cumsum(np.diff(np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_string(texts.type) else np.int64)[texts.offset : texts.offset + len(texts) + 1])) if len(texts) else np.zeros(0)
            at = 0
            while at < len(keys):  # slices of about TEXT bytes
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TEXT, "right")))
                got, n = encode_words(texts.slice(at, to - at), cache)
                upto = np.concatenate([[0], np.cumsum(n)])
                ids.append(np.insert(got, upto[1:], end_id))
                counts.append(n + 1)
                docs += keys[at:to]
                held, at = held + len(ids[-1]), to
                if held >= per_file:
                    yield flush()
                    seg, docs, counts, ids, held = seg + 1, [], [], [], 0
        if docs:
            yield flush()

    return write


def write_token_files(docs: DataFrame, path: str, name: str = TOKENIZER, end_id: int = END, per_file: int = PER_FILE) -> None:
    """Encode every text (null: empty), append `end_id` to each, and write the files to the table `path` in ascending
    order of doc_id (null first; rows that repeat a doc_id in the order of their texts' hashes). Texts of any length are
    encoded whole; an empty table gives a table without files."""
    n = partitions(docs.sparkSession)
    by_range = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    by_range.mapInArrow(_writer(name, end_id, per_file), "part int, seg int, n_tokens long, blob binary").write.option("compression", "none").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, seg, blob in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            f = TokenFile(blob)
            ids = f.tokens(0, f.n).astype("<u4").tobytes()
            d = len(f.doc_ids)
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(f.first[:-1].tolist(), f.first[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part] * d, pa.int32()), "seg": pa.array([seg] * d, pa.int32()), "doc_id": pa.array(f.doc_ids, pa.int64()), "at": pa.array(f.first[:-1]), "n_tokens": pa.array(np.diff(f.first)), "ids_crc32": pa.array(crc, pa.int64())}
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold, one row per document: doc_id, start, n_tokens, ids_crc32.

    Starts come from running sums over files, first by part and then within a part; the sums never see documents."""
    files = spark.read.schema("part int, seg int, n_tokens long, blob binary").parquet(path)
    rows = files.select("part", "seg", "blob").mapInArrow(_read, "part int, seg int, doc_id long, at long, n_tokens long, ids_crc32 long")
    before = (Window.unboundedPreceding, -1)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    sums = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("base"))
    segs = files.select("part", "seg", F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seg").rowsBetween(*before)), F.lit(0)).alias("in_part"))
    base = segs.join(sums, "part").select("part", "seg", (F.col("base") + F.col("in_part")).alias("base"))
    return rows.join(base, ["part", "seg"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str | None = None, **how) -> DataFrame:
    """Write the files, to a new table in the shared folder unless `path` is given, and read them back."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/newsweir-tokens-{uuid.uuid4().hex}"
    write_token_files(docs, path, **how)
    return read_token_files(spark, path)
