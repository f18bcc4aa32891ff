"""Token counts of sections by offset-mapped attribution.

A document is encoded once, as a whole. Its tokens' character spans are joined to the spans of its sections (an interval
join within the document, by binary search, as both are in order), and each token goes to one section by an explicit
rule: "first" (the default) to the section of the token's first character, "last" to that of its last character,
"most" to the one with most of its characters, the earlier of two with as many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tokens import Pieces, encode_spans

TOKENIZER = "byte_bpe_50k.json"


def line_starts(text: str) -> np.ndarray:
    """Where the lines of a text start; a line's break belongs to it. One section at 0 for an empty text."""
    out, at = [0], text.find("\n")
    while at >= 0 and at + 1 < len(text):
        out.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(out, np.int64)


def attribute(begin: np.ndarray, end: np.ndarray, starts: np.ndarray, rule: str = "first") -> np.ndarray:
    """The section of every token; sections are [starts[k], starts[k+1])."""
    a = np.searchsorted(starts, begin, "right") - 1
    if rule == "first":
        return a
    b = np.searchsorted(starts, np.maximum(end - 1, begin), "right") - 1
    if rule == "last":
        return b
    if rule != "most":
        raise ValueError(f"no such rule: {rule}")
    out = a.copy()
    for k in np.flatnonzero(a != b):  # only tokens across a boundary
        edges = np.concatenate([[begin[k]], starts[a[k] + 1 : b[k] + 1], [end[k]]])
        out[k] = a[k] + int(np.argmax(np.diff(edges)))
    return out


def section_tokens(docs: DataFrame, name: str = TOKENIZER, rule: str = "first") -> DataFrame:
    """One row per section (line) of every document: doc_id, section (from 0), begin, end (characters), n_tokens.

    Null and empty texts have one section of no tokens. The counts of a document's sections sum to its tokens. Rows that
    repeat a doc_id give their own sections; texts of any length are encoded whole; a token that begins where two sections
    meet belongs to the later one; an empty table gives an empty one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Pieces.of(name, offsets=True)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part, out = batch.slice(lo, 256), []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for key, text, (_, begin, end) in zip(part.column(0).to_pylist(), texts, encode_spans(texts, cache), strict=True):
                    starts = line_starts(text)
                    n = np.bincount(attribute(begin, end, starts, rule), minlength=len(starts))
                    out.append((key, starts, np.append(starts[1:], len(text)), n))
                sizes = [len(x[1]) for x in out]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([x[0] for x in out], pa.int64()).take(pa.array(np.repeat(np.arange(len(out)), sizes))),
                        "section": pa.array(np.concatenate([np.arange(k) for k in sizes])),
                        **{c: pa.array(np.concatenate([x[k] for x in out]).astype(np.int64)) for k, c in ((1, "begin"), (2, "end"), (3, "n_tokens"))},
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, section long, begin long, end long, n_tokens long")
