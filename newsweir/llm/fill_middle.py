"""Fill-in-middle: texts cut into prefix, middle and suffix, and put together again in another order.

The cuts of all texts of a batch are found at once, on the UTF-8 bytes as Arrow holds them, one text after the other:

1. a table gives every byte its class (continuation, white space, line feed, other);
2. a table over the classes of two adjacent bytes marks the bytes at which a unit starts; the first byte of a document has
   no byte before it, so that nothing reaches over from the document before;
3. cumulative sums of the marks, taken anew at each document's start, give its number of units;
4. a search in these sums finds the byte of the k-th unit, for all rows and cuts together.

The sums are kept for blocks of 64 bytes, and within blocks only where a cut falls, so that they take an eighth of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import slices, utf8

MARKS = ("<P>", "<S>", "<M>")
SLICE, BLOCK = 1 << 24, 64
_CONT, _SPACE, _LINE, _OTHER, _NONE = range(5)

CLASS = np.full(256, _OTHER, np.uint8)
CLASS[0x80:0xC0] = _CONT
CLASS[[0x09, 0x0B, 0x0C, 0x0D, 0x20]] = _SPACE
CLASS[0x0A] = _LINE


def _pairs(unit: str) -> np.ndarray:
    """Flags by class of a byte and of the next: whether a unit starts at the next."""
    out = np.zeros((5, 5), bool)
    if unit == "codepoint":
        out[:, [_SPACE, _LINE, _OTHER]] = True
    elif unit == "word":  # with the white space after it
        out[[_SPACE, _LINE], _OTHER] = True
    elif unit == "line":  # with its line feed
        out[_LINE, :] = True
    else:
        raise ValueError(f"no such unit: {unit}")
    out[_NONE, :] = True
    return out


class Ranks:
    """Cumulative sums of flags."""

    def __init__(self, flags: np.ndarray) -> None:
        self.n = len(flags)
        self.blocks = np.append(flags, np.zeros(-len(flags) % BLOCK or BLOCK, bool)).reshape(-1, BLOCK)
        self.sums = np.cumsum(np.count_nonzero(self.blocks, axis=1))

    def before(self, at: np.ndarray) -> np.ndarray:
        """How many flags are set before each position."""
        block, rest = np.divmod(at, BLOCK)
        inner = np.arange(BLOCK) < rest[:, None]
        return np.where(block > 0, self.sums[block - 1], 0) + np.count_nonzero(self.blocks[block] & inner, axis=1)

    def position(self, rank: np.ndarray) -> np.ndarray:
        """Where the rank-th set flag, from 1, stands; the end for a rank beyond them all."""
        block = np.searchsorted(self.sums, rank)
        out = np.full(len(rank), self.n)
        has = np.flatnonzero(block < len(self.sums))
        block = block[has]
        rest = rank[has] - np.where(block > 0, self.sums[block - 1], 0)
        out[has] = block * BLOCK + np.argmax(np.cumsum(self.blocks[block], axis=1) >= rest[:, None], axis=1)
        return out


def unit_starts(raw: np.ndarray, at: np.ndarray, unit: str) -> np.ndarray:
    """Flags of the bytes at which a unit starts."""
    right = CLASS[raw]
    left = np.empty_like(right)
    left[1:] = right[:-1]
    left[at[:-1][at[:-1] < at[1:]]] = _NONE
    return _pairs(unit)[left, right]


def holding(raw: np.ndarray, at: np.ndarray, marks: tuple[str, ...]) -> np.ndarray:
    """Flags of the texts that hold one of the marks."""
    out = np.zeros(len(at) - 1, bool)
    for mark in (m.encode() for m in marks):
        hits = np.flatnonzero(raw == mark[0])
        for k in range(1, len(mark)):
            hits = hits[hits + k < len(raw)]
            hits = hits[raw[hits + k] == mark[k]]
        row = np.searchsorted(at, hits, "right") - 1
        out[row[hits + len(mark) <= at[row + 1]]] = True
    return out


def transform(texts: pa.Array, h: np.ndarray, unit: str, plain: int, spm: int, marks: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Units, form (0 plain, 1 psm, 2 spm), units of prefix and of middle, and output of every text; h has four numbers a text."""
    raw, at = utf8(texts)
    ranks = Ranks(unit_starts(raw, at, unit))
    base = ranks.before(at)
    n, base = np.diff(base), base[:-1]
    first, second = np.sort(np.stack([h[0] % (n + 1), h[1] % (n + 1)]), axis=0)
    cut1, cut2 = ranks.position(np.concatenate([base + first, base + second]) + 1).reshape(2, -1)
    form = np.where((n == 0) | (h[2] % 100 >= 100 - plain) | holding(raw, at, marks), 0, np.where(h[3] % 100 < spm, 2, 1))
    view, (p, s, m) = memoryview(np.ascontiguousarray(raw)), (x.encode() for x in marks)
    pieces: list = []
    for kind, a, b, c, d in zip(form.tolist(), at[:-1].tolist(), cut1.tolist(), cut2.tolist(), at[1:].tolist(), strict=True):
        if kind == 0:
            pieces.append(view[a:d])
        elif kind == 1:
            pieces += (p, view[a:b], s, view[c:d], m, view[b:c])
        else:
            pieces += (s, view[c:d], p, view[a:b], m, view[b:c])
    size = np.diff(at) + np.where(form > 0, len(p) + len(s) + len(m), 0)
    ends = np.concatenate([[0], np.cumsum(size)])
    # the engine takes strings of 32-bit offsets; a slice is one text at most beyond SLICE
    out = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(b"".join(pieces))])
    return n, form, first, second - first, out


def fill_middle(docs: DataFrame, unit: str = "codepoint", plain: int = 10, spm: int = 20, marks: tuple[str, str, str] = MARKS, seed: str = "1") -> DataFrame:
    """One row per document: doc_id, n (units), form ("plain", "psm", "spm"), prefix_n, middle_n (units; null if plain),
    output.

    A unit is a code point, a word with the white space after it, or a line with its line feed. The cuts and the form depend
    on the sha256 of seed:doc_id alone, so reruns agree; `plain` and `spm` are per cents. A text without units, and one that
    holds a mark, is plain. Null texts are empty; a null doc_id hashes as an empty one; rows equal in doc_id are cut at the
    same shares of their own texts; texts of any length are taken whole; an empty table gives an empty one; other columns
    don't come through."""
    key = docs.schema["doc_id"].dataType.simpleString()
    names = np.array(["plain", "psm", "spm"], object)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE):
                part = batch.slice(lo, hi - lo)
                h = np.stack([part.column(k).to_numpy() for k in range(2, 6)])
                n, form, prefix, middle, out = transform(part.column(1), h, unit, plain, spm, marks)
                counts = [pa.array(x, pa.int64(), mask=form == 0) for x in (prefix, middle)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(names[form], pa.string()), *counts, out], names=["doc_id", "n", "form", "prefix_n", "middle_n", "output"])

    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(sha, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    return docs.select("doc_id", "text", *h).mapInArrow(go, f"doc_id {key}, n long, form string, prefix_n long, middle_n long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text of an output. As no text that was cut holds a mark, and no mark's end is a mark's start, the output has three."""
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in marks))
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
