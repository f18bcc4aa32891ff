"""Common lines, fill-in-middle and the filter audit against brute force on small tables."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from newsweir.llm import fill_middle, filter_audit, line_dedup
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = " \t\n\v\f\r"


def frame(spark, rows, schema=DOC):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows] if schema is DOC else rows, schema)


def more(df, names):
    for c in names:
        df = df.withColumn(c, F.lit(c))
    return df


# --- lines


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def common_lines(rows, min_chars=40, min_docs=5):
    """(doc_id, n_lines, n_dropped, kept) of (doc_id, text)."""
    held = defaultdict(list)
    key = lambda x: lower(x.strip(SPACE))
    rank = lambda i: -(1 << 63) if i is None else i
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k].append(rank(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(held[key(x)]) < min_docs or max(held[key(x)]) == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows():
    r = random.Random(4)
    base = [f"line number {k} of the text that " + "long enough é " * 3 for k in range(30)] + ["short", "", "   ", "x" * 39, "y" * 40, "Ä" * 40, "ä" * 40]
    rows = []
    for i in range(80):
        lines = [r.choice(base[: 1 + i % len(base)]) for _ in range(r.randrange(12))]
        lines = [r.choice(["", " ", "\t", "\r", "\v\f"]) + (x.upper() if r.random() < 0.2 else x) + r.choice(["", " ", "\r"]) for x in lines]
        rows.append((i * 3 % 80, "\n".join(lines)))
    rows += [(500 + i, "the one line that a third of all the documents hold\nown " + str(i)) for i in range(40)]
    # no-break spaces are kept, one document below and one above the number that is asked for, repeated rows, no id
    rows += [(600 + i, " " + "a line of exactly four documents, no more than that") for i in range(4)] + [(700 + i, "a line of exactly five documents, which is enough") for i in range(5)]
    rows += [(800, "twice in its document, and its rows are repeated too\n" * 2)] * 6 + [(None, "the one line that a third of all the documents hold")] * 2 + [(None, None), (900, ""), (901, "\n\n")]
    return rows


@pytest.mark.parametrize("how", [{}, {"hot": 2, "size": 3}, {"hot": 1}, {"hot": 10**6}])
def test_common_lines(spark, how):
    """Whether lines are answered by the shards, by the index of common ones or by both."""
    rows = line_rows()
    got = line_dedup.without_common_lines(frame(spark, [(i, t, "s") for i, t in rows]), **how)
    assert sorted(map(tuple, got.collect()), key=str) == common_lines(rows)


def test_common_lines_of_other_bounds(spark):
    rows = line_rows()
    got = line_dedup.without_common_lines(frame(spark, [(i, t, "s") for i, t in rows]), min_chars=3, min_docs=2)
    assert sorted(map(tuple, got.collect()), key=str) == common_lines(rows, 3, 2)
    with pytest.raises(ValueError):
        line_dedup.without_common_lines(frame(spark, []), min_docs=1)


def test_common_lines_need_the_arrays(spark, monkeypatch):
    """Every line that goes was found in a shard's arrays."""
    docs = frame(spark, [(i, t, "s") for i, t in line_rows()])
    none = line_dedup.Shard.of(np.zeros((0, 2), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)).to_bytes()
    monkeypatch.setattr(line_dedup.Shard, "to_bytes", lambda self: none)  # of the index of common lines
    monkeypatch.setattr(line_dedup, "_built", lambda batches: (pa.RecordBatch.from_pydict({"shard": pa.array([], pa.int64()), "data": pa.array([], pa.binary())}) for _ in batches))
    assert line_dedup.without_common_lines(docs).agg(F.sum("n_dropped")).first()[0] == 0


def test_common_lines_of_long_empty_and_clashing_tables(spark):
    long = "\n".join(f"line {k % 7} of a very long text with many lines, {k % 9}" for k in range(100_000))
    docs = frame(spark, [(i, long, "s") for i in range(5)] + [(9, "z" * 3_000_000, "s")])
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.without_common_lines(docs).collect()}
    assert got == {**{i: (100_000, 100_000) for i in range(4)}, 4: (100_000, 0), 9: (1, 0)}
    assert line_dedup.without_common_lines(docs.limit(0)).count() == 0
    rows = line_rows()
    clash = more(frame(spark, [(i, t, "s") for i, t in rows]), ["id", "k", "line", "h", "f", "new", "n", "last", "shard", "data", "lines", "kept", "n_lines"])
    assert sorted(map(tuple, line_dedup.without_common_lines(clash).collect()), key=str) == common_lines(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 70_000])
def test_perfect_hash(n):
    """Slots are 0 to n-1, each once; hashes that aren't held are told apart by their fingerprints."""
    r = np.random.default_rng(n)
    h = r.integers(0, 1 << 63, (n, 2), np.uint64)
    h[: n // 2, 0] = 7  # equal in one half
    slots = line_dedup.PerfectHash.of(h)
    assert np.array_equal(np.sort(slots.slots(h)), np.arange(n))
    assert n < 1000 or 64 * len(slots.words) < 5.5 * n
    shard = line_dedup.Shard.from_bytes(line_dedup.Shard.of(h, np.arange(n), np.arange(n) * 3 - n).to_bytes())
    at, count, last = shard.probe(h)
    assert np.array_equal(at, np.arange(n)) and np.array_equal(count, np.arange(n)) and np.array_equal(last, np.arange(n) * 3 - n)
    assert not len(shard.probe(r.integers(0, 1 << 63, (5000, 2), np.uint64))[0])


# --- fill in the middle

TEXTS = ["", None, "a", "ab", "é", "日本語 テキスト", "😀😀x😀", "plain <P> mark", "no <P mark> here", "<S>", "x<M", ">", "<", "a<M>", "a\nb\n\nc", "  lead", "tail \n", "é combining", "<<<P", "word " * 300, "\n", "S>", "\x00 nul"]


def middle(i, t, plain=10, spm=20, seed="1"):
    t = t or ""
    n, h = len(t), hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return (i, n, "plain", None, None, t)
    p, m, s = t[:a], t[a:b], t[b:]
    return (i, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (i, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def middle_rows():
    rows = [(k * 37 + j, t) for k in range(12) for j, t in enumerate(TEXTS)]
    return rows + [(5, "rows of one id"), (5, "rows of one id"), (None, "no id at all"), (None, None)]


def test_fill_middle(spark):
    rows = middle_rows()
    docs = frame(spark, [(i, t, "s") for i, t in rows])
    got = fill_middle.fill_middle(docs)
    assert sorted(map(tuple, got.collect()), key=str) == sorted((middle(i, t) for i, t in rows), key=str)
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}
    back = got.select(fill_middle.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert Counter(r.t for r in back) == Counter(t or "" for _, t in rows)
    other = fill_middle.fill_middle(docs, plain=0, spm=100, seed="x")
    assert sorted(map(tuple, other.collect()), key=str) == sorted((middle(i, t, 0, 100, "x") for i, t in rows), key=str)
    assert fill_middle.fill_middle(docs.limit(0)).count() == 0
    clash = more(docs, ["h1", "h2", "n", "form", "output", "prefix_n"])
    assert sorted(map(str, fill_middle.fill_middle(clash).collect())) == sorted(map(str, got.collect()))


@pytest.mark.parametrize(("unit", "pattern"), [("word", r"(?s)^[ \t\n\v\f\r]+(?=[^ \t\n\v\f\r])|[^ \t\n\v\f\r]+[ \t\n\v\f\r]*|^[ \t\n\v\f\r]+$"), ("line", r"[^\n]*\n|[^\n]+$")])
def test_fill_middle_by_words_and_lines(spark, unit, pattern):
    rows = [(i, t) for i, t in middle_rows() if i is not None]
    for r in fill_middle.fill_middle(frame(spark, [(i, t, "s") for i, t in rows]), unit=unit).collect():
        if r.form != "plain":
            text = spark.range(1).select(fill_middle.restored(F.lit(r.output), F.lit(r.form)).alias("t")).first().t if r.doc_id < 20 else None
            parts = dict(zip(re.findall("<([PSM])>", r.output), re.split("<[PSM]>", r.output)[1:], strict=True))
            whole = parts["P"] + parts["M"] + parts["S"]
            assert text is None or text == whole
            units = re.findall(pattern, whole)
            assert "".join(units) == whole and len(units) == r.n
            assert "".join(units[: r.prefix_n]) == parts["P"] and "".join(units[r.prefix_n : r.prefix_n + r.middle_n]) == parts["M"]


def test_cuts_of_a_batch():
    """Slices of arrays, slices of few bytes, nulls with bytes, texts longer than a slice, both widths of offsets."""
    r = random.Random(1)
    texts = [None if r.random() < 0.1 else "".join(r.choice("aé日😀 <PSM>\n") for _ in range(r.choice([0, 1, 3, 64, 65, 500]))) for _ in range(400)]
    h = np.array([[r.randrange(1 << 32) for _ in texts] for _ in range(4)], np.int64)
    for kind in (pa.string(), pa.large_string()):
        whole = pa.array(texts, kind)
        for lo, hi in [(0, 400), (3, 3), (7, 250), *fill_middle.slices(whole, 700)]:
            n, form, first, second, out = fill_middle.transform(whole.slice(lo, hi - lo), h[:, lo:hi], "codepoint", 10, 20, fill_middle.MARKS)
            assert len(out) == hi - lo
            for k, t in enumerate(texts[lo:hi]):
                t = t or ""
                a, b = sorted(int(x) % (len(t) + 1) for x in h[:2, lo + k])
                assert (n[k], first[k], second[k]) == (len(t), a, b - a)
                p, m, s = t[:a], t[a:b], t[b:]
                assert out[k].as_py() == [t, f"<P>{p}<S>{s}<M>{m}", f"<S>{s}<P>{p}<M>{m}"][form[k]]
    assert [x for a, b in fill_middle.slices(whole, 700) for x in range(a, b)] == list(range(400))


def test_fill_middle_of_a_long_text(spark):
    text = "é日😀 a" * 1_600_000  # more bytes than a slice
    for r in fill_middle.fill_middle(frame(spark, [(k, text, "s") for k in (1,)])).collect():
        assert tuple(r) == middle(r.doc_id, text)


# --- filters


def audit(rows, labels, letters="ABCDE"):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    docs = [(i, t or "", s or "") for i, t, s in rows]
    fails = []
    for i, t, _ in docs:
        w = words(t)
        fails.append(
            (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and any(j is not None and j < i and t == u for j, u, _ in docs))
        )
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    out, shapley = {}, Counter()
    for part in {s for _, _, s in docs}:
        own = [k for k, d in enumerate(docs) if d[2] == part]
        for order in itertools.permutations(letters):
            alive = own
            for step, x in enumerate(order):
                f = letters.index(x)
                gone = [k for k in alive if fails[k][f]]
                alive = [k for k in alive if not fails[k][f]]
                out[part, "".join(order), step + 1] = (len(alive), len(gone), sum(fails[k][f] for k in own) - len(gone), sum(fails[k][f] and sum(fails[k]) == 1 for k in own), sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone))
                shapley[part, x] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows():
    r, rows = random.Random(2), []
    for i in range(150):
        pool = [f"w{k}" for k in range(r.choice([20, 400]))]
        t = " ".join(r.choice(pool) for _ in range(r.choice([150, 199, 200, 320])))
        t = t.upper() if r.random() < 0.2 else t
        rows.append((i, t + r.choice(["", "", " $", " |"]), r.choice(["a", "b", None, ""])))
    rows += [(200 + i, rows[r.randrange(150)][1], r.choice(["a", "c"])) for i in range(40)]
    return rows + [(300, None, "b"), (301, "", None), (7, rows[7][1], "a"), (None, rows[9][1], "a"), (None, None, "only here")]


def audited(spark, rows, labels, add=()):
    docs, marks = more(frame(spark, rows and [(i, t, s) for i, t, s in rows]), add), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.audited(filter_audit.failures(docs, marks)).collect()}


def test_filter_audit(spark):
    rows = audit_rows()
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 240, 2)] + [(4, 1, None), (4, None, 1), (6, None, None), (None, 1, 1), (7, 1, 0)]
    want = audit(rows, labels)
    assert audited(spark, rows, labels) == want
    assert audited(spark, rows, labels, ["part", "A", "E", "digest", "good", "least", "quality"]) == want
    assert audited(spark, rows, []) == audit(rows, [])
    assert audited(spark, [], labels) == {}


def test_states_are_shared(spark, monkeypatch):
    """32 sets of filters serve 120 orders: one count each of the 31 that are left by an edge, five persisted at most."""
    held, most, counts = [], [], []
    kind = type(spark.range(1))
    keep, drop = kind.persist, kind.unpersist
    monkeypatch.setattr(kind, "persist", lambda self, *a: (held.append(1), most.append(len(held)), keep(self, *a))[2])
    monkeypatch.setattr(kind, "unpersist", lambda self, *a: (held.pop(), drop(self, *a))[1])
    failed = spark.range(64).selectExpr("'p' as part", *[f"id & {1 << k} > 0 as {x}" for k, x in enumerate("ABCDE")], "true as good", "false as toxic")
    walked = filter_audit.edges(failed, "ABCDE")
    assert walked.count() == 80 and walked.select("state").distinct().count() == 31
    assert not held and max(most) <= 5
    # independent filters of one half each: every edge removes half of what is there
    assert {(r.alive, r.removed) for r in walked.collect()} == {(64 >> k, 32 >> k) for k in range(5)}


def test_other_filters(spark):
    failed = spark.range(30).selectExpr("'p' as part", "id % 2 = 0 as X", "id % 3 = 0 as Y", "id % 10 = 0 as good", "false as toxic")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley) for r in filter_audit.audited(failed, "XY").collect()}
    assert got == {("XY", 1): (15, 15, 0, 10, 3, 25), ("XY", 2): (10, 5, 5, 5, 0, 15), ("YX", 1): (20, 10, 0, 5, 1, 15), ("YX", 2): (10, 10, 5, 10, 2, 25)}
    with pytest.raises(ValueError):
        filter_audit.audited(failed, "XX")
