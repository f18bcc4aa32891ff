"""The partitioned state, runs that are committed once, and streams that commit their batches."""

import json
from datetime import datetime, timedelta

import pytest
from newsweir.operators import dedup
from newsweir.plans import runs
from newsweir.sources.state import SEEN, Store
from newsweir.streaming import articles as streams
from pyspark.sql import functions as F

from test_runs import T, world

S = runs.Settings(now=T, hours=48, cap=9.0, sections=["Market"])


def content(store):
    rows = sorted((r.run, r.seq, r.title) for r in store.rows().collect())
    return rows, sorted((r.url_hash, r.title, r.first_seen_at) for r in store.seen().collect()), sorted((r.run, r.written, r.rows_written, r.cost) for r in store.log().collect())


def plain(store, articles):
    """A run without gates but the state: new URLs become rows."""
    new = dedup.unseen(dedup.fresh_candidates(articles, 48, T), store.seen_of(dedup.candidates(articles)))
    marks = new.select("url_hash", "canonical_url", "title", "published_at", F.lit(T).alias("first_seen_at"), F.lit(T).alias("last_seen_at"), "source_domain", F.lit("RU").alias("portal"), F.lit(None).cast("string").alias("cached_row_json"))
    return {"rows": new.select("seq", "title"), "marks": marks, "summary": new.agg(F.count("*").alias("written"), F.lit(0.0).alias("cost"))}


def begun(spark, path):
    """A store whose state has one article from before."""
    store = Store(spark, path)
    _, seen, _, _ = world(spark)
    nothing = spark.createDataFrame([], "seq long, run_of string")
    assert store.commit("first", lambda: {"rows": nothing, "summary": spark.createDataFrame([(0, 0.0)], "written long, cost double"), "marks": seen})
    return store


def test_two_runs(spark, tmp_path):
    """A second run of the same articles publishes nothing; a run's name is taken once."""
    store = begun(spark, f"file://{tmp_path}/s")
    a, _, known, said = world(spark)
    assert runs.committed_run(store, "one", a, known, said, S)
    assert not runs.committed_run(store, "one", a, known, said, S)
    assert runs.committed_run(store, "two", a, known, said, S)
    rows, seen, log = content(store)
    assert [r[:2] for r in rows] == [("one", 1), ("one", 6)] and len(seen) == 3
    assert log == [("first", 0, 0, 0.0), ("one", 2, 2, 0.3), ("two", 0, 0, 0.1)] and store.runs() == ["first", "one", "two"]
    with pytest.raises(ValueError):
        Store(spark, f"file://{tmp_path}/s", digits=3)
    with pytest.raises(ValueError):
        store.commit("../x", dict)


@pytest.mark.parametrize("at", ["marks", "staged", "rows out", "state out", "log out"])
def test_killed(spark, tmp_path, monkeypatch, at):
    """Wherever a run fails, the next commit finishes it or makes it again: no row is lost or out twice."""
    a = world(spark)[0]
    whole, store = begun(spark, f"file://{tmp_path}/whole"), begun(spark, f"file://{tmp_path}/killed")
    assert whole.commit("one", lambda: plain(whole, a))

    class Killed(Exception):
        pass

    def dies(*_, **__):
        raise Killed

    with monkeypatch.context() as m:
        if at == "marks":  # rows and marks are staged, the state's partitions aren't
            m.setattr("newsweir.sources.state.upserted", dies)
        elif at == "staged":
            m.setattr(Store, "_publish", dies)
        elif at == "rows out":
            publish = Store._publish
            m.setattr(Store, "_publish", lambda *x: (publish(*x), dies()))
        elif at == "state out":
            m.setattr(type(a.write), "json", dies)
        else:
            m.setattr("newsweir.sources.state._delete", dies)
        with pytest.raises(Killed):
            store.commit("one", lambda: plain(store, a))
    # another run comes first: it finds the state as the killed one left it, or would have
    assert store.commit("other", lambda: plain(store, a.limit(0)))
    assert store.commit("one", lambda: plain(store, a)) == (at == "marks")
    got, want = content(store), content(whole)
    assert got[:2] == want[:2] and [x for x in got[2] if x[0] != "other"] == want[2]
    assert not any((tmp_path / "killed" / "staged").glob("*"))


def test_only_touched_partitions(spark, tmp_path):
    store = begun(spark, f"file://{tmp_path}/s")
    marks = spark.range(200).selectExpr("sha2(string(id), 256) as url_hash", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in SEEN.split(", ")[1:]])
    nothing = spark.createDataFrame([], "seq long")
    store.commit("many", lambda: {"rows": nothing, "summary": spark.createDataFrame([(0,)], "written long"), "marks": marks})
    few = marks.limit(2)
    assert len(store.touched(few)) <= 2 and store.seen().count() == 201
    part = store.seen_of(few)
    assert all("bucket=" in f and f.split("bucket=")[1][:2] in store.touched(few) for f in part.inputFiles()) or "PartitionFilters: [bucket" in part._jdf.queryExecution().toString()
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "seen").rglob("*.parquet")}
    store.commit("again", lambda: {"rows": nothing, "summary": spark.createDataFrame([(0,)], "written long"), "marks": few.withColumn("title", F.lit("new"))})
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "seen").rglob("*.parquet")}
    kept = {p.parent.name for p in before if after.get(p) == before[p]}
    assert len(kept) == len({p.parent.name for p in before}) - len(store.touched(few))
    assert store.seen().count() == 201
    assert not dedup.unseen(few, store.seen_of(few)).count()


def test_stream_of_batches(spark, tmp_path, monkeypatch):
    """A batch that fails after its rows are out is delivered again and adds nothing; the next ones follow."""
    a = world(spark)[0]
    (tmp_path / "in").mkdir()
    for k, part in enumerate(("seq in (1, 2, 8)", "seq in (4, 6)", "seq in (3, 6, 1)")):
        lines = [json.dumps(r.asDict(), default=str) for r in a.where(part).collect()]
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(lines))
    store = begun(spark, f"file://{tmp_path}/s")

    def run():
        stream = spark.readStream.schema(a.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
        streams.committed(stream, store, lambda batch: plain(store, batch), f"{tmp_path}/checkpoint").awaitTermination()

    publish, failed = Store._publish, []

    def once(self, source, target):
        publish(self, source, target)
        if "00000001" in target and not failed:
            failed.append(1)
            raise RuntimeError("killed")

    monkeypatch.setattr(Store, "_publish", once)
    with pytest.raises(Exception, match="killed"):
        run()
    assert failed and store.runs() == ["batch-00000000", "first"]
    run()
    rows, seen, _ = content(store)
    assert [r[:2] for r in rows] == [("batch-00000000", 1), ("batch-00000000", 8), ("batch-00000001", 4), ("batch-00000001", 6)]
    assert store.runs() == ["batch-00000000", "batch-00000001", "batch-00000002", "first"] and len(seen) == 5


def test_sessions(spark):
    at = [0, 10, 39, 70, 200, 229, 260]
    x = spark.createDataFrame([("k", T + timedelta(minutes=m)) for m in at] + [("other", T)], "key string, at timestamp")
    got = sorted(map(tuple, streams.sessions(x, "key", "at").collect()))
    t = lambda m: datetime(2026, 4, 27, 12) + timedelta(minutes=m)
    assert got == [("k", t(0), t(69), 3), ("k", t(70), t(100), 1), ("k", t(200), t(259), 2), ("k", t(260), t(290), 1), ("other", t(0), t(30), 1)]


def test_edits(spark, tmp_path):
    from newsweir.sources import edits, sinks

    base = f"file://{tmp_path}/t"
    x = spark.createDataFrame([(k, f"t{k}", k) for k in range(6)], "row_id long, title string, n int")
    sinks.write_version(x, base)
    assert sorted(map(tuple, edits.read_live(spark, base).collect())) == sorted(map(tuple, x.collect())) and edits.deleted(spark, base).count() == 0
    edits.delete_rows(spark.createDataFrame([(1, "phrase"), (9, "none")], "row_id long, reason string"), base)
    edits.delete_rows(spark.createDataFrame([(1,)], "row_id long"), base)
    edits.patch_rows(spark.createDataFrame([(2, "new", None), (3, None, 7)], "row_id long, title string, n int"), base)
    edits.patch_rows(spark.createDataFrame([(2, None, "note"), (8, "nobody", "x")], "row_id long, title string, note string"), base)
    live = edits.read_live(spark, base)
    assert sorted((r.row_id, r.title, r.n, r.note) for r in live.collect()) == [(0, "t0", 0, None), (2, "new", 2, "note"), (3, "t3", 7, None), (4, "t4", 4, None), (5, "t5", 5, None)]
    assert {r["_key"]: r.reason for r in edits.deleted(spark, base).collect()} == {1: "phrase", 9: "none"}
    assert edits.compact(spark, base) == 2 and edits.read_live(spark, base).count() == 5 and sinks.read_version(spark, base, 1).count() == 6
    sinks.write_version(x, base)
    assert edits.read_live(spark, base).count() == 6  # a row that a later version brings back stays


def test_components_that_grow(spark):
    """Two increments give what one run gives, whatever joins what."""
    import random

    from newsweir.operators import components as graph

    r = random.Random(6)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(230)]
    of = lambda part: spark.createDataFrame(part, "a long, b long")
    want = {q.id: q.component for q in graph.components(of(edges)).collect()}
    first = graph.components(of(edges[:90]))
    second = graph.grown(first, of(edges[90:170]))
    third = graph.grown(second, of(edges[170:]))
    loops = {a for a, b in edges if a == b} - set(want)  # a link of a vertex to itself makes it one of its own
    got = {q.id: q.component for q in third.collect()}
    assert {k: v for k, v in got.items() if k not in loops} == want and all(got.get(k, k) == k for k in loops)
    now = {q.component: q.now for q in graph.moved(second, third).collect()}
    before = {q.component for q in second.collect()}
    assert now == {c: got[c] for c in before if got[c] != c} and now
    assert graph.grown(of([]).select(F.col("a").alias("id"), F.col("b").alias("component")), of(edges)).count() == len(got)


def test_feed_chain(spark, tmp_path):
    from newsweir.operators import stories
    from newsweir.sources import discovery, tables

    item = "<item><title>{}</title><link>{}</link>{}</item>"
    (tmp_path / "one.xml").write_text("<rss>" + "".join(item.format(*x) for x in [("A", "https://e.com/a", "<pubDate>soon</pubDate><updated>2026-04-27T10:00:00Z</updated>"), ("", "https://e.com/b", ""), ("C", "", ""), ("D", "https://e.com/d", "")]) + "</rss>")
    (tmp_path / "two.xml").write_text("<rss>" + item.format("A", "https://e.com/a", "") + "</rss>")
    names = spark.createDataFrame([(f"file://{tmp_path}/one.xml", "https://one.com/feed")], "file string, source_url string")
    names = names.withColumn("file", F.replace("file", F.lit("file:///"), F.lit("file:/"))).unionByName(names)
    items = tables.feed_items(spark, f"{tmp_path}/*.xml", names=names)
    assert {(r.source_url.split("/")[-1], r.pos, r.title) for r in items.collect()} == {("feed", 1, "A"), ("feed", 2, ""), ("feed", 3, "C"), ("feed", 4, "D"), ("two.xml", 1, "A")}
    pages = spark.createDataFrame([("https://e.com/a", "", "body", None), ("https://e.com/b", "own", "body", T), ("https://e.com/d", "page", "body", None)], "url string, title string, body string, published_at timestamp")
    get = lambda *a: {(r.source_url.split("/")[-1], r.url[-1], r.title, r.published_at) for r in discovery.feed_articles(items, pages, *a).collect()}
    assert get(3) == {("feed", "a", "A", datetime(2026, 4, 27, 10)), ("two.xml", "a", "A", None)}  # the first three, of which two are good
    assert get(9, False) == {("feed", "a", None, None), ("feed", "b", "own", T), ("feed", "d", "page", None), ("two.xml", "a", None, None)}
    links = spark.createDataFrame([("s", k, f"https://e.com/{k}") for k in range(1, 10)], "source_url string, rank int, url string")
    captured = spark.createDataFrame([(f"https://e.com/{k}", f"t{k}") for k in (2, 3, 5, 7)], "url string, title string")
    assert sorted((r.rank, r.title) for r in discovery.first_articles(links, captured, 3).collect()) == [(1, "t2"), (2, "t3"), (3, "t5")]
    feed = spark.createDataFrame([(10, "x", ["https://x.com", "https://y.com"], None), (11, "y", ["https://x.com"], T)], "row_id long, title string, urls array<string>, published_at timestamp")
    summary = spark.createDataFrame([(1, "https://x.com", "zzz", ["https://x.com"], T), (2, "https://y.com", "qqq", ["https://y.com"], T)], "cluster_id long, canonical_url string, canonical_title string, members array<string>, published_at timestamp")
    placed = stories.routed(summary, feed)
    assert {r.cluster_id: r.feed_row for r in placed.collect()} == {1: 11, 2: 10}  # the later row of a URL
    assert {r.row_id: r.published_at for r in stories.redated(feed, placed).collect()} == {10: T, 11: T}
