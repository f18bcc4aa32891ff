"""Near duplicates of texts and vectors against brute force."""

import random
from collections import Counter

import math

import numpy as np
import pytest
from newsweir.llm import near_dedup, vector_dedup
from newsweir.operators import components as graph
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("seed", range(4))
def test_edit_distance(seed):
    rng = random.Random(seed)
    for _ in range(60):
        a = [rng.randrange(rng.choice([2, 5, 50])) for _ in range(rng.randrange(40))]
        b = [x for x in a if rng.random() > 0.1] if rng.random() < 0.7 else [rng.randrange(5) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(50))
        want, limit = plain_distance(a, b), rng.randrange(30)
        got = near_dedup.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64), limit)
        assert got == (want if want <= limit else -1), (a, b, limit)


def components_of(pairs, ids):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {i: top(i) for i in ids}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7), (150, 151)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    ids = {x for p in pairs for x in p if p[0] != p[1]}
    assert got == components_of([p for p in pairs if p[0] != p[1]], ids)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_documents(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=60))
    texts = [" ".join(rng.choices(words, k=rng.randint(8, 300))) for _ in range(60)]
    for t in list(texts[:25]):
        w = t.split()
        for _ in range(max(1, len(w) // 60)):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts += [" ".join(w), t.upper() if len(w) % 2 else t]
    w = texts[0].split()
    texts += [" ".join(w[:k] + ["new"] + w[k + 1 :]) for k in range(0, len(w), 3)]  # a larger group
    texts += [f"{passage} {' '.join(rng.choices(words, k=150))}" for _ in range(25)]  # a shared passage
    texts += ["one two", "one two", "", None, "  ", "x y z a b", "x y z a c"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    tokens = [(t or "").lower().split() for t in texts]

    def shingles(t):
        seen = Counter(tuple(t[i : i + 5]) for i in range(len(t) - 4))
        return {(g, k) for g, n in seen.items() for k in range(n)}

    grams = [shingles(t) for t in tokens]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if tokens[i] and (tokens[i] == tokens[j] or plain_distance(tokens[i], tokens[j]) <= 0.2 * max(len(tokens[i]), len(tokens[j])) + 1e-9)]
    sure = [(i, j) for i, j in pairs if tokens[i] == tokens[j] or grams[i] and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])]
    may = components_of(pairs, range(len(texts)))  # a class lies within one of these, and similar shingles are of one class
    got = {r.doc_id: r for r in near_dedup.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert len(got) == len(rows) and len(sure) > 60
    assert all(got[i].class_id == got[j].class_id for i, j in sure)
    assert all(may[i] == may[r.class_id] and r.class_id <= i for i, r in got.items())
    assert all(r.kept == (r.doc_id == r.class_id) for r in got.values())
    odd = [*rows, (3, "~ another text of the same id here", None, None, None), (None, texts[0], None, None, None)]
    kept = near_dedup.one_of_each(spark.createDataFrame(odd, DOC))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == DOC.replace(" long", "").replace(" string", "").split(", ") and sorted(i for i in ids if i is not None) == sorted([*{r.class_id for r in got.values()}, 3]) and None in ids
    again = near_dedup.near_duplicates(spark.createDataFrame([*odd, rows[5], (2, texts[9], None, None, None)], DOC)).collect()
    own = [r for r in again if r.doc_id == 3]  # another text of an id is a document of its own, and a copy is in its copy's class
    assert len(again) == len(odd) + 2 and {r.class_id for r in own} > {got[3].class_id} and {r.class_id for r in again if r.doc_id == 2} == {got[2].class_id, got[9].class_id}
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOC)).count() == 0


def test_near_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((700, 16))
    for k in range(60):  # groups of some size, and pairs
        x[600 + k] = x[0] + 0.05 * rng.standard_normal(16)
    for k in range(30):
        x[660 + k] = x[100 + k] * 3 + 0.1 * rng.standard_normal(16)
    x[690:695] = x[200]
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)] + [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [], None), (1003, [float("nan")] + [1.0] * 15, 1), (1004, [None] + [1.0] * 15, 1), (1005, [1.0, 2.0], 1), (1006, [2.0, 4.0], 1), (None, [1.0] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vector_dedup.near_vectors(df).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, 0)
    pairs = [(int(i), int(j)) for i, j in zip(*np.nonzero(s >= 0.9), strict=True)]
    want = components_of(pairs, range(700))
    found = sum(got[i].n_links for i in range(700))
    assert len(got) == len(rows) and 0.98 * len(pairs) <= found <= len(pairs)
    assert sum(got[i].component_id == want[i] for i in range(700)) >= 0.99 * 700
    assert [got[k].n_links for k in (1000, 1001, 1002, 1003, 1004)] == [0] * 5 and got[1006].component_id == 1005
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values() if r.vec_id is not None)
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def band_classes(rows):
    """Classes by brute force: components of all pairs that share a band and are similar."""
    tokens = [t.split() for _, t, *_ in rows]
    code = {w: i for i, w in enumerate(sorted({w for t in tokens for w in t}))}
    docs = [np.array([code[w] for w in t], np.uint64) for t in tokens]
    bands = [near_dedup.order_min_hash(w) for t in tokens for w in near_dedup.words_of(near_dedup.pa.array([" ".join(t)]))]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if not {*bands[i].tolist()}.isdisjoint(bands[j].tolist()) and near_dedup.alike(docs[i], docs[j])]
    return components_of(pairs, range(len(rows))), pairs


def test_recall_of_bands():
    """Of pairs up to the threshold, one in five words replaced, nine in ten and more share a band, with repeats or without."""
    rng, found, total = random.Random(3), 0, 0
    for size in (20, 60, 150, 400, 900):
        for _ in range(80):
            x = [rng.randrange(5000) for _ in range(size)]
            if rng.random() < 0.5:
                x[: size // 4] = x[size // 2 : size // 2 + size // 4]
            y = x[:]
            for k in rng.sample(range(size), rng.randint(1, size // 5)):
                y[k] = 10**6 + rng.randrange(10**6)
            a, b = (near_dedup.order_min_hash(near_dedup.mix64(np.array(w, np.uint64))).tolist() for w in (x, y))
            assert near_dedup.alike(np.array(x), np.array(y))
            found, total = found + (not {*a}.isdisjoint(b)), total + 1
    assert found >= 0.95 * total


def test_recall_of_classes(spark):
    """Against brute force over all pairs, by edit distance alone."""
    rng = random.Random(21)
    words = [f"w{i}" for i in range(900)]
    texts = [rng.choices(words, k=rng.randint(10, 200)) for _ in range(60)]
    for t in list(texts):
        w = t[:]
        for k in rng.sample(range(len(w)), max(1, int(rng.random() * 0.2 * len(w)))):
            w[k] = f"x{rng.randrange(10**6)}"
        texts.append(w)
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if plain_distance(texts[i], texts[j]) <= 0.2 * max(len(texts[i]), len(texts[j])) + 1e-9]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert len(pairs) >= 60 and sum(got[i] == got[j] for i, j in pairs) >= 0.93 * len(pairs)
    assert all(got[i] == i or (i, got[i]) in pairs for i in got)


def test_very_long_texts(spark):
    """Two long texts with a few edits, and a long one with another start, in the time of a test."""
    rng = random.Random(22)
    x = [f"w{rng.randrange(3000)}" for _ in range(60_000)]
    y, z = x[:], [f"v{rng.randrange(3000)}" for _ in range(30_000)] + x[30_000:]
    for k in range(0, 60_000, 37):
        y[k] = "edited"
    rows = [(i, " ".join(t), None, None, None) for i, t in enumerate((x, y, z))]
    assert [r.class_id for r in sorted(near_dedup.near_duplicates(spark.createDataFrame(rows, DOC)).collect())] == [0, 0, 2]


def test_pairs_within_a_template(spark, monkeypatch):
    """Texts of one template, nearly all unlike, of which a few late pairs are alike."""
    monkeypatch.setattr(near_dedup, "TILE", 64, raising=False)  # several tiles a bucket
    rng = random.Random(5)
    template, texts = [f"t{i}" for i in range(110)], []
    for _ in range(400):
        texts.append(" ".join(template + [f"v{rng.randrange(10**6)}" for _ in range(40)]))
    for k in range(380, 400):  # no five words outside the template are common
        w = texts[k].split()
        texts.append(" ".join(x if i < 110 or i % 4 else f"u{k}-{i}" for i, x in enumerate(w)))
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    want, pairs = band_classes(rows)
    assert len(pairs) >= 18
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert got == want


def test_chains_of_versions(spark):
    """Versions v1, v2, v3, of which v1 and v3 are unlike: v2, linked to its bucket's hub v1, still meets v3."""
    rng = random.Random(7)
    first, texts = [f"t{i}" for i in range(60)], []
    texts.append(" ".join(first))
    late = []
    for k in range(100):
        at = rng.randrange(40)
        v2 = first[:at] + [f"a{k}-{i}" for i in range(9)] + first[at + 9 :]
        to = rng.choice([x for x in range(52) if abs(x - at) >= 9])
        late.append(" ".join(v2[:to] + [f"b{k}-{i}" for i in range(8)] + v2[to + 8 :]))
        texts.append(" ".join(v2))
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts + late)]
    want, pairs = band_classes(rows)
    assert len({want[i] for i in range(101, 201)}) < 100
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert got == want


def test_sparse_vectors_are_audited(spark, monkeypatch):
    """Two pairs among 1,500 vectors that the search misses: the audit sees that, and brute force gives them."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1500, 24))
    x[1400], x[1450] = x[3] + 0.02 * rng.standard_normal(24), x[700] + 0.02 * rng.standard_normal(24)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    compare = vector_dedup._compare
    monkeypatch.setattr(vector_dedup, "_compare", lambda *a: compare(*a).where("sim < 0.9"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_vectors(df).collect()}
    assert got == {i: (0, i) for i in range(1500)} | {3: (1, 3), 1400: (1, 3), 700: (1, 700), 1450: (1, 700)}


def test_links_come_from_the_lists(spark, monkeypatch):
    """2,000 vectors with pairs, a chain, a dense group, equal vectors and repeated ids: all links are found by the search, the
    audit comes to its sample alone, and no brute force is run. The same where nothing is linked."""
    r = np.random.default_rng(7)
    x = r.standard_normal((2000, 32))
    for k in range(0, 300, 2):  # pairs just above and just below the threshold
        y = r.standard_normal(32)
        y -= (y @ x[k]) * x[k] / (x[k] @ x[k])
        c = [0.97, 0.905, 0.895][k // 2 % 3]
        x[k + 1] = c * x[k] / np.linalg.norm(x[k]) + math.sqrt(1 - c * c) * y / np.linalg.norm(y)
    for k in range(301, 330):
        x[k] = x[k - 1] + 0.25 * r.standard_normal(32)
    x[400:460] = x[400] + 0.1 * r.standard_normal((60, 32))
    x[500:520] = x[500]
    ids = np.arange(2000) * 3
    ids[510] = ids[500]  # a repeated id
    monkeypatch.setattr(vector_dedup, "brute_force", lambda *a: pytest.fail("brute force"))
    sizes = []
    true = vector_dedup._true
    monkeypatch.setattr(vector_dedup, "_true", lambda vectors, drawn, cosine: (sizes.append(drawn.count()), true(vectors, drawn, cosine))[1])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    classes = df.groupBy("embedding").agg(F.min("vec_id").alias("v")).select("v", F.col("embedding").alias("vec"))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = np.argwhere(u @ u.T >= 0.9)
    want = {(int(ids[a]), int(ids[b])) for a, b in near if a != b and not (500 < a < 520 or 500 < b < 520)}
    monkeypatch.setattr(vector_dedup, "AUDIT", 200)
    found = {(q.u, q.v) for q in vector_dedup.links(classes, 0.9).collect()}
    assert found <= want and len(found) >= 0.98 * len(want) and len(want) > 3000
    assert len(sizes) == 1 and 100 < sizes[0] < 320
    far = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(r.standard_normal((500, 64)))], "v long, vec array<float>")
    assert vector_dedup.links(far, 0.9).count() == 0 and len(sizes) == 2
    got = {q.vec_id: q for q in vector_dedup.near_vectors(df.where("vec_id between 1400 and 1700")).dropDuplicates(["vec_id"]).collect()}
    assert got[1500].component_id == got[1557].component_id == 1500 and got[1500].n_links == 19


def test_templates_grow_in_proportion(spark, monkeypatch):
    """Unlike documents of one template, a few of which are alike: the texts that tiles get grow as the documents, not as
    their square, and the classes are those of all pairs. Where words tell nothing, tiles of whole buckets stay."""
    monkeypatch.setattr(near_dedup, "TILE", 32)
    monkeypatch.setattr(near_dedup, "MORE", 1)
    sizes, tiles = [], near_dedup._all_tiles
    monkeypatch.setattr(near_dedup, "_all_tiles", lambda *a: (lambda t: (sizes.append((t.count(), t.where("x < 0").count())), t)[1])(tiles(*a)))

    def classes(n):
        rng = random.Random(n)
        template, texts = [f"t{i}" for i in range(70)], []
        for _ in range(n):
            texts.append(" ".join(template + [f"v{rng.randrange(10**9)}" for _ in range(30)]))
        for k in range(20):
            texts.append(" ".join(w if i < 70 or i % 3 else f"u{k}-{i}" for i, w in enumerate(texts[k].split())))
        rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
        return rows, {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}

    rows, got = classes(300)
    assert got == band_classes(rows)[0]
    many, got = classes(2400)
    assert {got[2400 + k] for k in range(20)} == set(range(20)) and len(set(got.values())) == 2400
    (small, _), (large, by_words) = sizes
    assert by_words == large and large < 400 and large <= 10 * max(small, 1)
    rng = random.Random(1)  # few words in all, none rare
    few = [(i, " ".join(["same"] * 30 + [rng.choice("abcdefgh") for _ in range(20)]), "en", "s", 0) for i in range(150)]
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(few, DOC)).collect()} == band_classes(few)[0]


def test_vectors_in_slices(spark, monkeypatch):
    """Groups are compared a slice at a time, each of a part of them, and the links are those of all pairs."""
    r = np.random.default_rng(11)
    x = r.standard_normal((500, 24))
    for k in range(80):
        x[400 + k] = x[k % 50] + 0.05 * r.standard_normal(24)
    rows, compare = [], vector_dedup._compare
    monkeypatch.setattr(vector_dedup, "SLICE", 125)
    monkeypatch.setattr(vector_dedup, "_compare", lambda groups, *how: rows.append(groups.count()) or compare(groups, *how))
    got = {(q.u, q.v) for q in vector_dedup.links(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "v long, vec array<double>"), 0.9).collect()}
    x /= np.linalg.norm(x, axis=1)[:, None]
    s = x @ x.T
    np.fill_diagonal(s, 0)
    assert got == set(zip(*(p.tolist() for p in np.nonzero(s >= 0.9)), strict=True)) and len(got) >= 160
    assert len(rows) % 4 == 0 and max(rows[:4]) < 0.6 * sum(rows[:4])
