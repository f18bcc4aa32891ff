"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Texts are lower-cased words. A k-mer is five consecutive words with its occurrence number in the document, so repeats
count. For each of BANDS hash functions the LEAST k-mers of least hash are taken and hashed in the order in which they
stand in the text: two documents agree on a band with the probability that they share those k-mers in that order, which
follows edit similarity, not just the sets. With 2 k-mers and 64 bands, texts of which every fifth word, the most that is
allowed, was replaced agree on a band with probability 0.9, and of which every tenth was with 0.9999. Short texts have some
bands of two-word k-mers besides.

Equal sequences of words are one vertex. In a bucket of equal bands every document is first compared with one other, the
bucket's least (a star), which joins most of a large group. Then all pairs of a bucket whose classes differ are settled,
also those with a document that has its link already: buckets are dealt in tiles of about TILE documents a side, and
within a tile only pairs are compared that share a word among their rarest fifth and one more. Similar texts share
at least 0.8 of the longer one's words, so none is lost by that. Where tiles would
get more than MORE times all texts, as by many unlike documents of one template, documents of buckets that are larger than a tile
are dealt by these words instead, if that sends fewer texts: documents that have no rare word in common never meet then, and
the others meet whatever their bucket. Compared pairs are verified:
the edit distance of the word sequences, by furthest-reaching points on a band of diagonals, is at most 0.2 of the
longer one. Classes are the connected components of the links, which are those of all similar pairs that share a band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .base import cut, discard, mix64, partitions
from .repeats import gram_hashes
from .tokens import let_go

SHINGLE, LEAST, BANDS, SIMILAR = 5, 2, 64, 0.8
#: Texts of fewer than SHORT words have SHORT_BANDS more bands of SHORT_SHINGLE words, as few of their k-mers outlive an edit.
SHORT, SHORT_SHINGLE, SHORT_BANDS = 64, 2, 16
TILE, TILE_WORDS = 2048, 1_000_000
#: Documents, by hash, whose words tell how common a word is; and the most words that are told of.
DRAWN, KNOWN = 4096, 100_000
#: Times all texts that tiles may get before large buckets are dealt by words.
MORE = 8
#: Rows and pairs of a tile that are looked at together.
ROWS, PAIRS = 64, 1 << 14
_TILE = ["x", "y", "i", "j"]
_ODD = (mix64(np.arange(1, BANDS + SHORT_BANDS + 1, dtype=np.uint64)) | np.uint64(1))[:, None]
_XOR = mix64(np.arange(101, BANDS + SHORT_BANDS + 101, dtype=np.uint64))[:, None]


def words_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """64-bit hashes of the lower-cased words of each text; none for null."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    flat = split.flatten()
    coded = pc.dictionary_encode(flat)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    every = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.uint64)
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    at = split.offsets.to_numpy() - split.offsets[0].as_py()
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield every[a:b][there[a:b]]


def _bands(words: np.ndarray, shingle: int, bands: slice) -> np.ndarray:
    g = gram_hashes(words, shingle)
    order = np.argsort(g, kind="stable")
    s = g[order]
    same = s[1:] == s[:-1]
    if same.any():  # label occurrences
        first = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(s)), 0))
        label = np.empty(len(s), np.uint64)
        label[order] = (np.arange(len(s)) - first).astype(np.uint64)
        g = np.where(label > 0, mix64(g + label * np.uint64(0x9E3779B97F4A7C15)), g)  # the first stays as in a text without repeats
    odd, xor, rows = _ODD[bands], _XOR[bands], np.arange(bands.stop - bands.start)
    n = min(LEAST, len(g))
    # the least of each band, some bands at a time so that what is at work stays small
    at = np.empty((len(rows), n), np.int64)
    step = max(1, (1 << 18) // len(g))
    for lo in range(0, len(rows), step):
        part = slice(lo, lo + step)
        h = (g[None, :] ^ xor[part]) * odd[part]
        h ^= h >> np.uint64(31)
        for k in range(n):
            at[part, k] = h.argmin(axis=1)
            h[np.arange(len(h)), at[part, k]] = np.uint64(0xFFFFFFFFFFFFFFFF)
    at.sort(axis=1)
    out = np.arange(bands.start, bands.stop, dtype=np.uint64)
    for k in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + g[at[:, k]])
    return out


def order_min_hash(words: np.ndarray) -> np.ndarray:
    """The bands of a document of five words or more."""
    out = _bands(words, SHINGLE, slice(0, BANDS))
    return out if len(words) >= SHORT else np.concatenate([out, _bands(words, SHORT_SHINGLE, slice(BANDS, BANDS + SHORT_BANDS))])


def edit_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two sequences if it is at most `limit`, else -1, on the diagonals within `limit` of the main one.

    A column of the band is kept as two bit vectors, of the cells that are one more and one less than the cell above; a
    column takes a few operations on integers of 2 * limit + 1 bits."""
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > limit:
        return -1
    same = a[:m] == b  # equal ends change nothing
    head = m if same.all() else int(np.argmin(same))
    a, b = a[head:], b[head:]
    n, m = n - head, m - head
    same = a[n - m :][::-1] == b[::-1]
    tail = m if same.all() else int(np.argmin(same))
    n, m = n - tail, m - tail
    a, b = a[:n], b[:m]
    if not m:
        return n
    limit = min(limit, n)
    _, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    diff = np.bincount(where.ravel()[:n], minlength=1 + where.max()) - np.bincount(where.ravel()[n:], minlength=1 + where.max())
    if max(diff[diff > 0].sum(), -diff[diff < 0].sum()) > limit:  # the words alone tell
        return -1
    at: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    every, bottom = (1 << 2 * limit + 1) - 1, 1 << 2 * limit
    # bit p of column j stands for row j - limit + p; `cost` is the cell at the band's lower edge, later that of the last row
    up, down, cost = (1 << limit + 1) - 1 << limit, 0, limit
    for j, w in enumerate(b.tolist()):
        hit = at.get(w, 0)
        hit = (hit >> j - limit if j > limit else hit << limit - j) & every
        flat = ((hit & up) + up ^ up | hit | down) & every  # as cheap as the cell before on the diagonal
        right, left = down | every & ~(flat | up), flat & up  # one more, one less than the cell to the left
        if j < n - limit:
            cost += not flat & bottom
            if cost > 2 * limit - (n - m):
                return -1
        else:
            p = n - j - 1 + limit
            cost += (right >> p & 1) - (left >> p & 1)
            if cost - (m - j - 1) > limit:
                return -1
        flat >>= 1
        up, down = left | every & ~(flat | right), flat & right
    return cost if cost <= limit else -1


def alike(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> bool:
    """Whether the edit similarity of two sequences of words is `least` or more."""
    most = max(len(a), len(b))
    return most > 0 and edit_distance(a, b, int((1 - least) * most + 1e-9)) >= 0


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            ids, exact, sizes, bands = [], [], [], []
            for row, w in enumerate(words_of(part.column(1))):
                if not len(w):
                    continue
                ids.append(row)
                exact.append(xxhash.xxh3_128_digest(memoryview(w).cast("B")))
                sizes.append(len(w))
                bands.append(order_min_hash(w).view(np.int64).tolist() if len(w) >= SHINGLE else [])
            if ids:
                e = np.frombuffer(b"".join(exact), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(ids)), pa.array(e[:, 0].copy()), pa.array(e[:, 1].copy()), pa.array(sizes), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "c1", "c2", "words", "bands"])


def _verify(least: float):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ok = [alike(a, b, least) for a, b in zip(words_of(part.column(2)), words_of(part.column(3)), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ok)], names=["a", "b", "ok"])

    return go


def tokens_of(words: np.ndarray) -> np.ndarray:
    """A number for each word and its occurrence, so that repeated words are told apart."""
    words = np.sort(words)
    first = np.maximum.accumulate(np.where(np.concatenate([[True], words[1:] != words[:-1]]), np.arange(len(words)), 0)) if len(words) else np.zeros(0, np.int64)
    return words + mix64((np.arange(len(words)) - first).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in words_of(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(tokens_of(w).view(np.int64))], names=["token"])


def _prefixes(known: np.ndarray, often: np.ndarray, least: float):
    """The rarest words of each document, of which similar ones have one in common, in one order of all words."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for w in words_of(batch.column(3)):
                t = tokens_of(w)
                at = np.minimum(np.searchsorted(known, t), max(len(known) - 1, 0))
                df = np.where(known[at] == t, often[at], 0) if len(known) else np.zeros(len(t), np.int64)
                out.append(t[np.lexsort((t, df))][: int((1 - least) * len(t) + 1e-9) + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), pa.array([o.tolist() for o in out], pa.list_(pa.int64()))], names=["doc_id", "class", "words", "tokens"])

    return go


def candidates(docs: list[np.ndarray], least: float) -> np.ndarray:
    """Symmetric matrix that has every pair of documents (by their words) whose edit similarity can be `least` or more.

    Such a pair shares max(n, m) - limit words or more, each counted as often as it occurs. In one order of all words, the
    first limit + 1 of the two documents therefore have one in common; the order is by rarity."""
    n = np.array([len(w) for w in docs])
    words, doc = np.concatenate(docs), np.repeat(np.arange(len(docs)), n)
    order = np.lexsort((words, doc))
    words, doc = words[order], doc[order]
    new = np.concatenate([[True], (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])])
    occurrence = np.arange(len(words)) - np.maximum.accumulate(np.where(new, np.arange(len(words)), 0))
    _, token, count = np.unique(words + mix64(occurrence.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15), return_inverse=True, return_counts=True)
    order = np.lexsort((token, count[token], doc))
    place = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)
    first = order[place <= ((1 - least) * n + 1e-9).astype(np.int64)[doc]]
    token, doc = token[first], doc[first]
    order = np.argsort(token, kind="stable")
    token, doc = token[order], doc[order]
    ends = np.flatnonzero(np.concatenate([token[1:] != token[:-1], [True]])) + 1
    starts = np.concatenate([[0], ends[:-1]])
    many = ends - starts > 1
    out = np.zeros((len(n), len(n)), bool)
    for a, b in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
        out[doc[a:b, None], doc[a:b]] = True
    for lo in range(0, len(n), ROWS):  # lengths that are too unlike, some rows at a time as their table is large
        own = n[lo : lo + ROWS, None]
        out[lo : lo + ROWS] &= np.abs(own - n) <= (1 - least) * np.maximum(own, n) + 1e-9
    return out


def _tile_links(tile: pa.Table, least: float) -> list[tuple[int, int]]:
    """Links between different classes of a tile: of all pairs, or of those across its two parts, that meet in no earlier band;
    in a tile of a word (band -1) of all that share a band."""
    docs = [w for c in tile.column("text").chunks for w in words_of(c)]
    ids, kind, part = (tile.column(c).to_numpy() for c in ("doc_id", "class", "part"))
    of = tile.column("bands").combine_chunks()
    bands = np.arange(len(docs))[:, None] + np.full((1, BANDS + SHORT_BANDS), 1 << 40)  # unlike all others
    size = np.diff(of.offsets.to_numpy())
    bands[np.arange(BANDS + SHORT_BANDS) < size[:, None]] = of.flatten().to_numpy()
    x, i, j = (tile.column(c)[0].as_py() for c in "xij")
    maybe = candidates(docs, least)

    def here() -> Iterator[tuple[int, int]]:
        """Pairs that may be links, in order, of which some rows and then some pairs are looked at together."""
        for lo in range(0, len(docs), ROWS):
            rows = slice(lo, lo + ROWS)
            some = maybe[rows] & (kind[rows, None] != kind)
            if i != j:
                some &= part[rows, None] != part
            a, b = np.nonzero(some)
            a += lo
            a, b = a[a < b], b[a < b]
            for k in range(0, len(a), PAIRS):
                p, q = a[k : k + PAIRS], b[k : k + PAIRS]
                same = bands[p] == bands[q]
                on = same.any(axis=1) if x < 0 else same.argmax(axis=1) == x
                yield from zip(p[on].tolist(), q[on].tolist(), strict=True)

    up: dict[int, int] = {}

    def top(c: int) -> int:
        while c in up:
            c = up[c]
        return c

    out = []
    for p, q in here():
        c, d = top(int(kind[p])), top(int(kind[q]))
        if c != d and alike(docs[p], docs[q], least):
            up[max(c, d)] = min(c, d)
            out.append((int(ids[p]), int(ids[q])))
    return out


def _tiles(least: float):
    """Links of tiles, whose rows follow each other."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            if held and sum(h.num_rows for h in held) > 1:
                got = _tile_links(pa.Table.from_batches(held), least)
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in got], pa.int64()), pa.array([q for _, q in got], pa.int64())], names=["a", "b"])
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in _TILE])
            ends = [*(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            start = 0
            for end in ends:
                if held and [held[-1].column(c)[0].as_py() for c in _TILE] != key[:, start].tolist():
                    yield from done()
                held.append(batch.slice(start, end - start))
                start = end
        yield from done()

    return go


def _parts(members: DataFrame) -> DataFrame:
    """x, y, n, top_n, top (largest class), rest, tops (parts of its members and of the others) of buckets with several classes."""
    per = members.groupBy("x", "y", "class").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    total = per.groupBy("x", "y").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "w", "class")).alias("top")).where("n > top.n")
    parts = lambda n, w: F.ceil(F.greatest(n / TILE, w / TILE_WORDS))
    whole = parts(F.col("n"), F.col("w")) <= 1
    return total.select("x", "y", "n", F.col("top.n").alias("top_n"), F.col("top.class").alias("top"), F.when(whole, 1).otherwise(parts(F.col("n") - F.col("top.n"), F.col("w") - F.col("top.w"))).alias("rest"), F.when(whole, 0).otherwise(parts(F.col("top.n"), F.col("top.w"))).alias("tops"))


def _dealt(members: DataFrame) -> DataFrame:
    """Tiles x, y, i, j with their members, whose `part` is i or j, of buckets x, y with several classes.

    The members of a bucket's largest class need not be compared with each other: they meet only the rest."""
    total = _parts(members)
    m = members.join(total.drop("n", "top_n"), ["x", "y"])
    among = F.xxhash64("doc_id", F.lit("part"))
    is_top = (F.col("class") == F.col("top")) & (F.col("tops") > 0)
    m = m.withColumn("part", F.when(is_top, F.col("rest") + F.expr("pmod(xxhash64(doc_id, 'part'), greatest(tops, 1))")).otherwise(F.pmod(among, F.col("rest"))))
    other = F.explode(F.when(F.col("part") >= F.col("rest"), F.sequence(F.lit(0).cast("long"), F.col("rest") - 1)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("rest") + F.col("tops") - 1)))
    m = m.withColumn("other", other)
    return m.select("x", "y", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "doc_id", "class")


def _by_words(large: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The documents of large buckets (doc_id, class, words) as members of buckets of their rarest words, x is -1."""
    own = large.select("doc_id", "class", "words").distinct()
    n = own.count()
    some = own.where(F.pmod(F.xxhash64("doc_id", F.lit("words")), F.lit(max(1, n // DRAWN))) == 0).select("doc_id").hint("merge")
    told = texts.join(some, "doc_id", "left_semi").select("text").mapInArrow(_counted, "token long").groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    told = sorted((r.token & (1 << 64) - 1, r.n) for r in told.orderBy(F.desc("n"), "token").limit(KNOWN).collect())
    known, often = np.array([t for t, _ in told], np.uint64), np.array([c for _, c in told], np.int64)
    x = own.hint("merge").join(texts.select("doc_id", "text"), "doc_id").select("doc_id", "class", "words", "text")
    x = x.mapInArrow(_prefixes(known, often, least), "doc_id long, class long, words long, tokens array<long>")
    return x.select(F.lit(-1).cast("long").alias("x"), F.explode("tokens").alias("y"), "doc_id", "words", "class")


def _sent(parts: DataFrame) -> int:
    """How many texts the tiles of buckets get."""
    rows = F.when(F.col("tops") == 0, F.col("n") * F.col("rest")).otherwise((F.col("n") - F.col("top_n")) * (F.col("rest") + F.col("tops")) + F.col("top_n") * F.col("rest"))
    return parts.agg(F.sum(rows)).first()[0] or 0


def _all_tiles(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The tiles of all buckets (members: x, y, doc_id, words, class), as a written table.

    Only where they would get more than MORE times all texts are large buckets dealt by words, if that is less."""
    if _sent(_parts(members)) <= MORE * texts.count():
        return cut(_dealt(members), "tiles")
    big = cut(_parts(members).where("rest + tops > 1").select("x", "y"), "large")
    large = cut(members.join(big, ["x", "y"]), "large-members")
    by_words = cut(_by_words(large, texts, least), "by-words")
    fewer = by_words if _sent(_parts(by_words)) < _sent(_parts(large)) else large
    out = cut(_dealt(members.join(big, ["x", "y"], "left_anti")).unionByName(_dealt(fewer)), "tiles")
    for t in (big, large, by_words):
        discard(t)
    return out


def _numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """`docs` with _nw_uid, a number for each document, and whether there are rows that repeat a doc_id.

    It is the doc_id; of rows that repeat one, that is for the least text, and others have a number from 2^62 on, made of
    doc_id and text."""
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_nw_n")).where("_nw_n > 1")
    if not repeated.limit(1).count():
        return docs.withColumn("_nw_uid", F.col("doc_id")), False
    first = docs.select(F.col("doc_id").alias("_nw_of"), "text").join(repeated.select(F.col("doc_id").alias("_nw_of")), "_nw_of").groupBy("_nw_of").agg(F.min(F.coalesce("text", F.lit(""))).alias("_nw_first"))
    other = F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(2**62 - 1)) + F.lit(2**62)
    x = docs.join(first, F.col("doc_id") == F.col("_nw_of"), "left")
    return x.withColumn("_nw_uid", F.when(F.coalesce("text", F.lit("")) != F.col("_nw_first"), other).otherwise(F.col("doc_id"))).drop("_nw_of", "_nw_first"), True


def _classes(docs: DataFrame, least: float) -> DataFrame:
    """id, component (its class) of the documents (doc_id, text; each doc_id once) that are similar to another."""
    sketches = cut(docs.mapInArrow(_sketch, "doc_id long, c1 long, c2 long, words long, bands array<long>"), "sketches")
    exact = sketches.groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.max("words").alias("words"), F.min_by("bands", "doc_id").alias("bands"))
    exact = cut(exact, "exact")
    copies = sketches.join(exact.where("n > 1").select("c1", "c2", "rep"), ["c1", "c2"]).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = exact.select(F.col("rep").alias("doc_id"), "words", "bands").where("size(bands) > 0")
    members = reps.select("doc_id", "words", F.posexplode("bands").alias("band", "key")).select("doc_id", "words", F.col("band").cast("long").alias("x"), F.col("key").alias("y"))
    hubs = members.groupBy("x", "y").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    hubs = cut(hubs, "hubs")  # so that a join with a very large bucket can be split
    shared = cut(members.join(hubs, ["x", "y"]), "shared")
    pairs = cut(shared.where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    # the documents that are compared at all; by a merge join at any size
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().hint("merge")
    short = reps.select("doc_id", F.transform("bands", lambda b: F.shiftright(b, 32).cast("int")).alias("bands"))  # halves are enough to tell bands apart
    texts = cut(docs.join(ids, "doc_id", "left_semi").hint("merge").join(short, "doc_id"), "texts")
    ta, tb = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    both = pairs.hint("merge").join(tb, "b").hint("merge").join(ta, "a").select("a", "b", "ta", "tb")
    got = cut(both.mapInArrow(_verify(least), "a long, b long, ok boolean"), "verified")
    near = components(got.where("ok").select("a", "b"))
    classed = shared.drop("hub").join(near, F.col("doc_id") == F.col("id"), "left").withColumn("class", F.coalesce("component", "doc_id")).drop("id", "component")
    classed = cut(classed, "members")
    tiles = _all_tiles(classed, texts, least)
    dealt = tiles.hint("merge").join(texts, "doc_id").select(*_TILE, "part", "doc_id", "class", "bands", "text")
    dealt = dealt.repartition(4 * partitions(docs.sparkSession), *_TILE).sortWithinPartitions(*_TILE)
    more = cut(dealt.mapInArrow(_tiles(least), "a long, b long"), "more")
    out = components(copies.unionByName(got.where("ok").select("a", "b")).unionByName(more))
    for x in (sketches, exact, hubs, shared, pairs, texts, got, classed, tiles, more):
        discard(x)
    return out


def near_duplicates(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """doc_id, class_id (the least doc_id of the document's class), kept (doc_id = class_id) of every row.

    Documents with equal words are of one class, whatever their length. Null texts and texts without words are classes
    of their own; texts of fewer than five words have only equal ones. Texts of any length are compared whole. Rows that
    repeat a doc_id with another text are documents of their own: a class of such rows alone has a number from 2^62 on.
    Rows without doc_id have no class and are kept. An empty table gives an empty one; of ties the least doc_id counts."""
    numbered, repeats = _numbered(docs.select("doc_id", "text"))
    return _classified(numbered, repeats, least).select("doc_id", F.coalesce("_nw_class", "doc_id").alias("class_id"), "kept")


def _classified(numbered: DataFrame, repeats: bool, least: float) -> DataFrame:
    """`numbered` documents with _nw_class and kept."""
    known = numbered.where(F.col("_nw_uid").isNotNull()).select(F.col("_nw_uid").alias("doc_id"), "text")
    classes = _classes(known.dropDuplicates(["doc_id"]) if repeats else known, least).select(F.col("id").alias("_nw_id"), F.col("component").alias("_nw_component"))
    out = numbered.join(classes, F.col("_nw_uid") == F.col("_nw_id"), "left").withColumn("_nw_class", F.coalesce("_nw_component", "_nw_uid"))
    return out.withColumn("kept", F.coalesce(F.col("_nw_uid") == F.col("_nw_class"), F.lit(True)))


def one_of_each(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The documents, all columns as they are, with one of every class of near duplicates: that of the least doc_id. Rows that
    repeat a doc_id with another text are documents of their own; of equal ones one stays. Rows without doc_id stay."""
    numbered, repeats = _numbered(docs)
    gone = _classified(numbered.select("doc_id", "text", "_nw_uid"), repeats, least).where("not kept").select(F.col("_nw_uid").alias("_nw_gone")).distinct()
    kept = numbered.join(gone, F.col("_nw_uid") == F.col("_nw_gone"), "left_anti")
    if repeats:
        kept = kept.where("_nw_uid is not null").dropDuplicates(["_nw_uid"]).unionByName(kept.where("_nw_uid is null"))
    return kept.drop("_nw_uid")
