"""Suffix-array and level-wise dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from newsweir.llm import repeats, substring_dedup, suffix_dedup

DOC = "doc_id long, text string, other int"


def brute(seqs, width):
    """Flags of the symbols covered by windows that start twice."""
    seen = Counter(tuple(s[i : i + width]) for s in seqs for i in range(len(s) - width + 1))
    out = []
    for s in seqs:
        f = [False] * len(s)
        for i in range(len(s) - width + 1):
            if seen[tuple(s[i : i + width])] > 1:
                f[i : i + width] = [True] * width
        out.append(f)
    return out


def corpus(rng, words, n, size):
    """Texts with copies, near copies, shared passages, self-repeats and periodic text."""
    base = [" ".join(rng.choices(words, k=rng.randint(0, size))) for _ in range(n)]
    passage = " ".join(rng.choices(words, k=size // 2))
    out = list(base)
    for b in base[: n // 3]:
        w = b.split()
        if w:
            w[rng.randrange(len(w))] = "EDIT"
        out += [b, " ".join(w), f"{b[: len(b) // 2]} {passage} {rng.random()}", f"{passage[5:]} {b}"]
    out += ["ab " * 200, "x" * 900, "x" * 199, passage, f"{passage} {passage}", None, "", " \n ", "é" * 150 + "日本" * 60, "é" * 150 + "日本" * 60]
    return [(i, t, i) for i, t in enumerate(out)] + [(3, out[3], 0), (3, "other text", 1), (None, out[5], 1)]


def check_bytes(spark, rows, width, gram, **how):
    flags = brute([(r[1] or "").encode() for r in rows], width)
    want = Counter()
    for r, f in zip(rows, flags, strict=True):
        b = (r[1] or "").encode()
        kept = bytes(x for x, g in zip(b, f, strict=True) if not g)
        spans = len(re.findall("1+", "".join("01"[g] for g in f)))
        want[(r[0], len(b), sum(f), spans, hashlib.sha256(kept).hexdigest())] += 1
    got = suffix_dedup.without_repeats(spark.createDataFrame(rows, DOC), width, gram, **how).collect()
    assert Counter(map(tuple, got)) == want


def check_words(spark, rows, width, **how):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    want = Counter()
    for r, w, f in zip(rows, docs, brute(docs, width), strict=True):
        kept = " ".join(x for x, g in zip(w, f, strict=True) if not g)
        want[(r[0], len(w), sum(f), hashlib.sha256(kept.encode()).hexdigest())] += 1
    got = substring_dedup.without_repeats(spark.createDataFrame(rows, DOC), width, **how).collect()
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("many", [4096, 8, 2])
def test_bytes(spark, many):
    rng = random.Random(many)
    check_bytes(spark, corpus(rng, ["alpha", "be", "gamma", "dé", "\n", "zeta-zeta"], 24, 120), 200, 32, many=many)


@pytest.mark.parametrize("many", [4096, 8, 2])
def test_words(spark, many):
    rng = random.Random(many)
    check_words(spark, corpus(rng, ["alpha", "be", "gamma", "dé", "\n", "zeta zeta"], 24, 160), 35, many=many)
    check_words(spark, corpus(rng, ["a", "b"], 12, 60), 7, many=many)


def test_empty(spark):
    none = spark.createDataFrame([], DOC)
    assert suffix_dedup.without_repeats(none).count() == 0 and substring_dedup.without_repeats(none).count() == 0


@pytest.mark.parametrize("symbols,n", [(2, 500), (4, 3000), (256, 3000), (1, 700)])
def test_suffix_ranks(symbols, n):
    rng = np.random.default_rng(n + symbols)
    depth = 20
    text = rng.integers(1, symbols + 1, n)
    if n > 1500:
        text[1000:1400] = text[200:600]
    padded = np.concatenate([text, np.zeros(4 * depth, int)])
    r = suffix_dedup.suffix_ranks(padded, depth)
    heads = [tuple(padded[i : i + depth]) for i in range(n - depth)]
    order = sorted(range(n - depth), key=lambda i: r[i])
    assert all(heads[a] <= heads[b] for a, b in zip(order[:-1], order[1:], strict=True))


def test_equal_windows_of_long_strings():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 256, 1_300_000).astype(np.uint8)
    text[900_000:900_500] = text[100:600]
    starts = np.arange(0, len(text) - 200, 50)
    assert np.flatnonzero(suffix_dedup.equal_windows(text, starts)).tolist() == [*range(2, 9), *range(18_000, 18_007)]


def test_runs_are_functions_of_windows():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([rng.integers(0, 2**63, 77).astype(np.uint64), a])
    at = {}
    for off, x in ((0, a), (77, b)):
        for f, n, p in zip(*repeats.runs_of(x, 50), strict=True):
            for i in range(f, f + n):
                at.setdefault(i - off, []).append(p - off)
    assert all(len(set(v)) == 1 for i, v in at.items() if i >= 0)


def test_comparing_decides(spark):
    """Without the suffix arrays or levels nothing is found, copies of whole texts included."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=60)
    texts = [" ".join(rng.choices(words, k=80) + passage[rng.randrange(4) :] + rng.choices(words, k=80)) for _ in range(12)]
    texts += texts[:3] * 4
    docs = spark.createDataFrame([(i % 20, t, i) for i, t in enumerate(texts)], DOC)
    none = lambda text, starts: np.zeros(len(starts), bool)
    for symbols, hashed, settle, width, gram, kind in (
        (suffix_dedup._bytes, suffix_dedup._BYTE_HASH.__getitem__, suffix_dedup.equal_windows, 200, 32, "u1"),
        (substring_dedup._words, substring_dedup._same, substring_dedup.equal_windows, 35, 9, "u8"),
    ):
        size = lambda f: sum(x.b - x.a for r in repeats.repeated_windows(docs, symbols, hashed, f, width, gram, kind).collect() for x in r.spans)  # noqa: E731, B023
        assert size(none) == 0 < size(settle)
