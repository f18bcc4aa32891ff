"""Relational operators, sources, sinks and streams on small tables."""

import random
from datetime import datetime, timedelta

import pytest
from newsweir.functions import text
from newsweir.functions.urls import url_hash
from newsweir.operators import budget, dedup, origins, reports, stats, stories
from newsweir.operators.components import components
from newsweir.sources import config, discovery, sinks, tables
from newsweir.streaming import articles as streams
from pyspark.sql import functions as F

T = datetime(2026, 4, 27, 12)
ARTICLE = "seq long, url string, title string, published_at timestamp"


def arts(spark, rows):
    return spark.createDataFrame(rows, ARTICLE)


def test_fresh_candidates(spark):
    rows = [(1, "https://e.com/a?ref=x", "t", T - timedelta(days=9)), (2, "https://e.com/a", "t", T), (3, "https://E.com/a#x", "t", T), (4, None, "t", T), (5, "https://e.com/b", "", T), (6, "https://e.com/c", "t", None)]
    got = dedup.fresh_candidates(arts(spark, rows), 48, T)
    assert sorted(r.seq for r in got.collect()) == [2, 6]


def test_upsert(spark):
    kind = "url_hash string, title string, last_seen_at int, cached_row_json string"
    got = dedup.upserted(spark.createDataFrame([("a", "A", 1, "x"), ("b", "B", 1, "y")], kind), spark.createDataFrame([("b", "new", 2, None), ("c", "C", 2, "z")], kind))
    assert sorted(map(tuple, got.collect())) == [("a", "A", 1, "x"), ("b", "B", 2, "y"), ("c", "C", 2, "z")]


def test_fuzzy(spark):
    found = arts(spark, [(1, "u", "Toyota unveils the new Camry sedan", T), (2, "u", "BMW profit falls", T), (3, "u", "", T)])
    known = spark.createDataFrame([("Toyota unveils new Camry sedan today",), (None,), ("",)], "title string")
    assert sorted(r.seq for r in dedup.without_similar(found, known).collect()) == [2, 3]


def test_earliest(spark):
    title = "Toyota unveils the new Camry sedan in Tokyo"
    rows = [(1, "https://press.com/a", title, T), (2, "https://blog.com/a", f"{title} — Blog", T + timedelta(hours=3)), (3, "https://t.me/x", title, T - timedelta(hours=1)), (4, "https://www.blog.com/b", title, T - timedelta(hours=9)), (5, "https://z.com/q", "short", T), (6, "https://w.com/q", title, None)]
    for f in (origins.earliest_same_title, origins.earliest_similar):
        got = {r.seq: (r.primary_domain, r.confidence) for r in f(arts(spark, rows), ["press.com"], ["blog.com"], ["t.me"]).collect()}
        assert got == {1: ("blog.com", "medium"), 2: ("press.com", "high"), 3: ("blog.com", "medium")}, f


def test_stories(spark):
    rows = [(1, "https://a.com/1", "Toyota recalls cars in Japan", T), (2, "https://b.com/1", "Toyota recalls its cars in Japan", T + timedelta(hours=30)), (3, "https://press.com/1", "Toyota recalls cars in Japan", T + timedelta(hours=60)), (4, "https://c.com/1", "Toyota recalls cars in Japan", T + timedelta(days=9)), (5, "https://d.com/1", "Toyota recalls cars in Japan", None), (6, "https://e.com/1", "BMW sales", T)]
    a = arts(spark, rows)
    got = {r.seq: r.cluster_id for r in stories.clusters(a.where("seq <> 5"), ["toyota", "bmw"]).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 6: 6}
    s = stories.summaries(stories.clusters(a, ["toyota"]), ["press.com"])
    assert {r.cluster_id: (r.size, r.canonical_seq) for r in s.collect()} == {1: (5, 3), 6: (1, 6)}
    feed = spark.createDataFrame([(10, "EN: Toyota recalls cars in Japan", ["https://x.com"], 1), (11, "EN: other", ["https://e.com/1"], None)], "row_id long, title string, urls array<string>, count int")
    placed = stories.routed(s, feed, ["toyota", "bmw"])
    assert {r.cluster_id: (r.feed_row, r.how) for r in placed.collect()} == {1: (10, "title"), 6: (11, "url")}
    assert {r.row_id: (len(r.urls), r["count"]) for r in stories.merged(feed, placed).collect()} == {10: (6, 6), 11: (1, 1)}
    assert stories.roll_up(s.limit(0)).first().clusters == 0


def plain_stories(rows, brands, hours=36):
    """Stories by all pairs of articles."""
    from newsweir.functions.text import set_ratio

    up = {r[0]: r[0] for r in rows}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for x in rows:
        for y in rows:
            near = not x[3] or not y[3] or abs(x[3] - y[3]) <= timedelta(hours=hours)
            if x[0] < y[0] and near and any(b in x[2].lower() and b in y[2].lower() for b in brands) and set_ratio(x[2].lower(), y[2].lower()) >= 72:
                a, b = sorted((top(x[0]), top(y[0])))
                up[b] = a
    return {k: top(k) for k in up}


def test_stories_against_all_pairs(spark):
    rng = random.Random(4)
    words = "toyota bmw recalls cars japan germany sales of the new sedan plant opens closes workers".split()
    base = [" ".join(rng.choices(words, k=rng.randint(3, 9))) for _ in range(25)]
    rows = []
    for k in range(300):
        t = rng.choice(base).split()
        if rng.random() < 0.3:
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((k, f"https://e.com/{k}", " ".join(t), None if rng.random() < 0.05 else T + timedelta(hours=rng.randrange(2000))))
    got = {r.seq: r.cluster_id for r in stories.clusters(arts(spark, rows), ["toyota", "bmw"]).collect()}
    assert got == plain_stories(rows, ["toyota", "bmw"]) and len({*got.values()}) > 30


def test_similar_titles_against_all_pairs(spark):
    """Latin titles with edited words, titles without a common word, and titles without spaces."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(300)]
    titles = [" ".join(rng.choices(words, k=rng.randint(2, 14))) for _ in range(120)]
    for t in list(titles):
        w = t.split()
        w[rng.randrange(len(w))] = rng.choice(words)
        titles += [" ".join(w), t[: len(t) // 2] + "x" + t[len(t) // 2 + 1 :], t.upper()]
    titles += ["新型の電気自動車を東京で発表した", "新型の電気自動車を大阪で発表した", "自動車", "Toyota", "Toyotas", "toyota"]
    x = spark.createDataFrame([(t,) for t in titles], "title string")
    for least in (72.0, 85.0):
        found, every = ({(r.a, r.b) for r in dedup.title_pairs(x, x, least, exact).collect()} for exact in (False, True))
        assert found <= every and len(found) >= 0.99 * len(every) and ("新型の電気自動車を東京で発表した", "新型の電気自動車を大阪で発表した") in found
    assert every == {(a, b) for a in {*titles} for b in {*titles} if text.set_ratio(a, b) >= 85}
    assert dedup.title_pairs(x.limit(0), x, 72.0).count() == 0


def test_links_and_feeds(spark):
    html = """<a href="/news/a-1">1</a> <a class=x href='https://www.e.com/news/b?utm_source=x'>2</a><a href=/news/a-1#top>again</a><a href="//other.org/news/c">no</a><a href="mailto:x@e.com">m</a>
    <a href="../news/d.html">3</a><a href="/about">no</a><a href="/news/b?utm_id=2">b again</a>"""
    pages = spark.createDataFrame([("https://www.e.com/x/y/", html), ("https://f.com/", None)], "url string, html string")
    assert [r.url for r in discovery.article_links(pages, 9).orderBy("rank").collect()] == ["https://www.e.com/news/a-1", "https://www.e.com/news/b?utm_source=x", "https://www.e.com/x/news/d.html"]
    assert len(discovery.article_links(pages, 9, by_canonical=False).collect()) == 4 and len(discovery.article_links(pages, 2).collect()) == 2
    items = spark.createDataFrame([("s", k, t, u, "Sun, 27 Apr 2026 13:45:00 +0300") for k, (t, u) in enumerate([("T1", "https://e.com/1"), ("", "https://e.com/2"), ("T3", "https://e.com/3"), ("T4", "https://e.com/4")])], "source_url string, pos int, title string, link string, published_text string")
    read = spark.createDataFrame([("https://e.com/1", None, "b", None), ("https://e.com/3", "Own", "b", T)], "url string, title string, body string, published_at timestamp")
    got = {r.url: (r.title, r.published_at) for r in discovery.feed_articles(items, read, 3).collect()}  # of three items the second has no title
    assert got == {"https://e.com/1": ("T1", datetime(2026, 4, 27, 10, 45)), "https://e.com/3": ("Own", T)}
    found = spark.createDataFrame([(s, k) for s, n in (("a", 3), ("b", 4), ("c", 2)) for k in range(n)], "source_url string, rank int")
    assert {r.source_url for r in discovery.soft_cap(found, 4).collect()} == {"a", "b"}


def test_config(spark, tmp_path):
    (tmp_path / "blacklist.json").write_text('{"domains": ["Bad.com"], "topic_phrases_ru": ["Слон"], "topic_phrases_en": ["Circus"]}', encoding="utf-8")
    (tmp_path / "brand_domains.json").write_text('{"brands": [{"brand": "Maker", "aliases": ["MK"], "domains": ["maker.com"]}]}')
    (tmp_path / "sources_overrides.json").write_text('{"overrides": [{"url": "https://a.com/", "rss_url": "https://a.com/rss"}]}')
    (tmp_path / "whitelist_domains.json").write_text("")
    s = config.settings(str(tmp_path), T, hours=48)
    assert (s.blocked_domains, s.blocked_phrases, s.brands, s.whitelist, s.hours) == (["bad.com"], ["слон", "circus"], [("Maker", ["MK"], ["maker.com"])], [], 48)
    assert [r.rss_url for r in config.overrides(spark, str(tmp_path)).collect()] == ["https://a.com/rss"]
    assert config.quirks(str(tmp_path))["rewrites"] == {} and config.source_columns(str(tmp_path))["url"] == "url" and stories.lexicon(s.brands and [(n, a) for n, a, _ in s.brands]) == ["maker"]


def test_reports(spark):
    v1 = spark.createDataFrame([(1, "u1", "pass", "not_news"), (2, "u2", "pass", "news_in_topic"), (3, "u3", "pass", None), (4, "u4", "no", None), (5, "u1", "pass", "not_news")], "seq long, url string, verdict string, label string")
    v2 = spark.createDataFrame([(1, "u1", "no"), (2, "u2", "pass"), (3, "u3", "no"), (4, "u4", "no")], "seq long, url string, verdict string")
    r = reports.version_summary(v1, v2, "url", "pass").first()
    assert tuple(r) == (4, 2, 1, 0, 1, 0, 1)
    rows = spark.createDataFrame([("in", "A", "1,5"), ("in", "A (неактивный)", "x"), ("out", "B", None), (None, None, "0.25")], "verdict string, section string, cost string")
    got = {(x.block, x.label): (x.n, x.share) for x in reports.panel(rows, {"verdict": "(empty)"}, F.coalesce(F.col("verdict") == "in", F.lit(False))).collect()}
    assert got == {("verdict", "in"): (2, "50.0%"), ("verdict", "out"): (1, "25.0%"), ("verdict", "(empty)"): (1, "25.0%"), ("section", "A"): (2, "100.0%"), ("cost", "sum"): (4, "1.7500")}
    assert reports.markdown(spark.createDataFrame([("a|b", None)], "x string, y string")) == "| x | y |\n| --- | --- |\n| a\\|b |  |"
    feed = spark.createDataFrame([(1, "t", ["https://bad.com/a"]), (2, "t", ["https://a.com/1", "https://www.bad.com/x"]), (3, "t", ["https://a.com/x.pdf"]), (4, "A shocking video", ["https://a.com/1"]), (5, "Football cup", ["https://a.com/1"]), (6, "New sedan", ["https://a.com/1"])], "row_id long, title string, urls array<string>")
    assert {r.row_id: r.reason for r in stories.cleaned(feed, ["bad.com"], []).collect()} == {1: "domain", 2: "member", 3: "document", 4: "phrase", 5: "topic"}


def test_command_line(capsys, tmp_path):
    from newsweir.__main__ import main, shown

    assert main(["queries"]) == 0 and "url_canonical" in capsys.readouterr().out
    assert main(["show-config", str(tmp_path)]) == 0 and '"hours": 24' in capsys.readouterr().out
    assert shown({"api_key": "x", "hours": 1}) == {"api_key": "***", "hours": 1}


def test_components(spark):
    got = {r.id: r.component for r in components(spark.createDataFrame([(1, 2), (3, 2), (5, 4), (4, 5), (9, 9)], "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


def test_budget(spark):
    calls = spark.createDataFrame([(k, T + timedelta(days=k // 2, minutes=k), 0.3) for k in range(6)], "k long, at timestamp, cost double")
    assert sorted(r.k for r in budget.within(calls, 1.0, ["at", "k"]).collect()) == [0, 1, 2]
    assert round(budget.running(calls, ["at", "k"]).agg(F.max("spent")).first()[0], 6) == 1.8


def test_stats(spark):
    x = spark.createDataFrame([(1, "a", True, True), (2, "b", True, False), (3, "b", False, False), (4, None, False, True)], "seq long, k string, p boolean, a boolean")
    assert [(r.v, r.n) for r in stats.top(x, F.col("k"), "v", 2).collect()] == [("b", 2), ("a", 1)]
    c = stats.confusion(x, F.col("p"), F.col("a")).first()
    assert (c.tp, c.fp, c.fn, c.tn, c.f1) == (1, 1, 1, 1, 0.5) and stats.confusion(x.limit(0), F.col("p"), F.col("a")).first().f1 == 0
    assert {(r.value, r.n) for r in stats.panel(x, ["k"]).collect()} == {("a", 1), ("b", 2), ("(none)", 1)}
    assert len(stats.hours_of_day(x.withColumn("t", F.lit(T)), F.col("t")).collect()) == 24


def test_sources(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Имя,URL,Type,On\n A ,https://a.com/,rss,да\n,https://b.com/x,,\nC,,html,1\n", encoding="utf-8")
    tab = tables.read_tab(spark, f"{tmp_path}/s.csv", "name string")
    got = tables.sources(tab, {"name": "Имя", "url": "URL", "type": "Type", "is_active": "On"})
    assert [(r.name, r.type, r.is_active) for r in got.collect()] == [("A", "rss", True), ("https://b.com/x", "html", True)]
    over = spark.createDataFrame([(1, "https://b.com/", None, None), (2, "https://b.com/", "https://b.com/rss", None)], "ord int, prefix string, rss_url string, requires_js boolean")
    assert {r.url: r.type for r in tables.overridden(got, over).collect()} == {"https://a.com/": "rss", "https://b.com/x": "rss"}
    assert tables.read_tab(spark, f"{tmp_path}/none.csv", "name string").count() == 0
    shots = spark.createDataFrame([(k, "s2" if k % 2 else "s1", f"t{k}", "local") for k in range(9)], "seq long, section string, title string, region string")
    assert [r.seq for r in tables.few_shots(shots).collect()] == [0, 2, 4, 1, 3, 5]
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>T</title><link>https://e.com/a</link><pubDate>Sun, 27 Apr 2026 13:45:00 GMT</pubDate></item><item><title>no link</title></item></channel></rss>")
    assert [(r.pos, r.link) for r in tables.feed_items(spark, f"{tmp_path}/f.xml").where("link is not null").collect()] == [(1, "https://e.com/a")]


def test_versions(spark, tmp_path):
    base, x = f"{tmp_path}/state", spark.range(3)
    assert sinks.commit_run(x, f"{tmp_path}/out", x, base, x, f"{tmp_path}/log") == 1 and sinks.write_version(x.limit(1), base) == 2
    assert sinks.read_version(spark, base).count() == 1 and sinks.read_version(spark, base, 1).count() == 3


def test_streams(spark, tmp_path):
    kind = "url string, title string, published_at timestamp"
    spark.createDataFrame([("https://e.com/a", "t", T), ("https://e.com/a?ref=1", "t", T), ("https://e.com/b", "t", None)], kind).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(kind).parquet(f"{tmp_path}/in")
    streams.write_once(streams.fresh_stream(stream, 0), f"{tmp_path}/out", f"{tmp_path}/c1")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    got = streams.counts_by_window(spark.read.parquet(f"{tmp_path}/in"), "published_at", F.lit("k")).where("start is not null").collect()
    assert [r.n for r in got] == [2]
    seen = []
    q = streams.source_gaps(stream.where("published_at is not null").withColumn("k", F.lit("s")), "k", "published_at").writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True)
    q.foreachBatch(lambda df, _: seen.extend(df.collect())).start().awaitTermination()
    assert [(r.k, r.calls) for r in seen] == [("s", 2)]


def test_registry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 40


@pytest.mark.parametrize("name", ["url_canonical", "story_clusters", "earliest_copy", "budget_running_cap", "date_from_text", "page_links", "review_panel", "versions_compared", "batch_report", "channel_previews"])
def test_catalogue_against_sql(spark, name):
    import duckdb
    from newsweir.plans import catalog, catalog_rules, catalog_state  # noqa: F401, the others add to the first

    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("pages", "documents", "events", "labels"):
        c.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    got = catalog.QUERIES[name](spark, d).toPandas()
    want = c.sql(catalog.SQL[name]).df()[list(got.columns)]
    key = list(got.columns)
    assert got.sort_values(key).astype(str).values.tolist() == want.sort_values(key).astype(str).values.tolist()


def test_hash(spark):
    assert spark.createDataFrame([("https://E.com/a?utm_id=1",), ("https://e.com/a",)], "u string").select(url_hash(F.col("u"))).distinct().count() == 1


def test_stories_and_feeds_take_all_documents(spark, tmp_path):
    from newsweir.plans import catalog

    rows = [(i, f"headline{i} number{i}\nbody", "en", "src1", 10) for i in range(40)] + [(40, "the river rises above its banks\nx", "en", "src1", 1), (41, "the river rises above its bank\nx", "en", "src2", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    times = [(i, catalog.NOW - timedelta(minutes=i)) for i in range(42)]
    spark.createDataFrame(times, "event_id long, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")
    cluster = {r.seq: r.cluster_id for r in catalog.story_clusters_fuzzy(spark, str(tmp_path)).collect()}
    assert len(cluster) == 42 and cluster[41] == 40
    assert {r.cluster_id for r in catalog.feed_route(spark, str(tmp_path)).collect()} == set(range(42))
    merged = {r.row_id: (r.urls, r["count"]) for r in catalog.feed_merge(spark, str(tmp_path)).collect()}
    assert set(merged) == {0, 10, 20, 30, 40} and merged[40] == (2, 2)


def test_small_reports(spark):
    import json

    x = spark.createDataFrame([(k, f"a|b{k}", T) for k in range(5)], "n long, t string, at timestamp").orderBy("n")
    assert reports.markdown(x.select("n", "t"), 2) == "| n | t |\n| --- | --- |\n| 0 | a\\|b0 |\n| 1 | a\\|b1 |\n\nThe first 2 rows of more."
    assert reports.markdown(x.select("n").limit(1)).count("\n") == 2
    got = json.loads(reports.as_json(x, 3))
    assert got["more"] and [r["n"] for r in got["rows"]] == [0, 1, 2] and got["rows"][0]["at"] == "2026-04-27 12:00:00"


def test_readers_of_tabs(spark):
    tab = spark.createDataFrame([("u", "t", "Новость", "нет", "v", " не новость ")], "URL string, Title string, A string, B string, V string, H string")
    got = tables.labels(tab, {"article": "a", "topic": "b", "verdict": "v", "human": "h"}).first()
    assert tuple(got) == ("u", "t", True, False, "v", "не новость", "not_news")
    x = spark.createDataFrame([("ab", "<ul><li>abc</li></ul>"), ("abc", ""), ("abcd", None), ("abcdef", "<p>x</p>")], "t string, b string")
    assert tuple(stats.mean_lengths(x, t=F.col("t"), b=F.col("b")).first()) == (4, 4, 2)  # 3.75, 2
    assert tuple(stats.mean_lengths(x.where("t in ('ab', 'abc')"), t=F.col("t"), b=F.col("b")).first()) == (2, 2, 3)  # 2.5 to even
    assert tuple(stats.mean_lengths(x.limit(0), t=F.col("t")).first()) == (0, 0)


def test_table_functions(spark):
    """Table functions give the rows of the functions that they stand for; a page without rows, or null, gives none."""
    from newsweir.functions import channels, pages, udtfs

    post = '<div class="tgme_widget_message" data-post="c/{}"><div class="tgme_widget_message_text">{}<br>x <a href="https://e.com/{}">l</a></div></div>'
    x = spark.createDataFrame([("https://t.me/s/c", "".join(post.format(k, f"Title {k}", k) for k in range(5))), ("https://t.me/s/d", None), (None, "<p>no posts")], "url string, html string")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
    assert same(channels.channel_posts(x, 3), udtfs.channel_posts(x, 3)) and udtfs.channel_posts(x, 3).count() == 3
    html = spark.createDataFrame([(1, "https://e.com/2026/04/27/a", "<html><title>A title of a page</title><article><p>Text</p><img src='/i.png'></article>"), (2, "u", "<p>none"), (3, None, None)], "page_id long, url string, html string")
    assert same(pages.articles(html), udtfs.articles(html)) and {r.page_id for r in udtfs.articles(html).collect()} == {r.page_id for r in pages.articles(html).collect()}
    udtfs.register(spark)
    html.createOrReplaceTempView("captured")
    assert spark.sql("SELECT page_id, a.title FROM captured, LATERAL page_article(url, html) AS a WHERE a.title LIKE 'A%'").collect()[0].page_id == 1
