"""Queries against their SQL on tables with copies and odd rows that the smallest tables lack."""

from datetime import datetime, timedelta

import pytest
from newsweir.functions.fixed import STRONG_MARKERS

LONG = "Long enough a title of the page"
H = '<h1>{}</h1><a href="/a{}">a</a><a href="/b">b</a>'


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """pages of which several have one URL, documents with years and numbers like years, and events."""
    d = str(tmp_path_factory.mktemp("odd"))
    titles = ["One &amp; two", "Three &quot;four&quot;", "Cut &amp;&amp;&amp", "Cut &quot", "AT&T &copy5", "&amp;amp; twice"]
    pages = [(k, f"https://e.com/{'same' if k in (3, 4, 8, 9, 12) else k}?utm_source=x", H.format(titles[k % len(titles)], "")) for k in range(24)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    texts = ["A title of 2019\nbody", "A title\nCall +1 (962) 555-2005 in 2001", f"A trash {STRONG_MARKERS[0]}\n", f"{LONG} - Site\nx"]
    docs = [(k, f"{texts[k % 4]} {k}", "en", f"src{k % 9}", 10) for k in range(16)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(k, datetime(2024, 1, 30) - timedelta(hours=k)) for k in range(12)], "event_id long, ts timestamp").write.parquet(f"{d}/events.parquet")
    return d


@pytest.mark.parametrize("name", ["cache_restore", "seen_upsert", "source_totals", "html_title", "html_title_lateral", "feed_new_rows", "calls_whole", "calls_charged", "calls_promoted", "calls_pending", "gate_order"])
def test_against_sql(spark, odd, name):
    import duckdb
    from newsweir.plans import catalog, catalog_rules, catalog_state  # noqa: F401, the others add to the first

    c = duckdb.connect()
    for t in ("pages", "documents", "events"):
        c.sql(f"create view {t} as select * from '{odd}/{t}.parquet/*.parquet'")
    got = catalog.QUERIES[name](spark, odd).toPandas()
    want = c.sql(catalog.SQL[name]).df()[list(got.columns)]
    rows = lambda x: sorted(map(str, x.astype(str).values.tolist()))
    assert rows(got) == rows(want)


def test_phrase_beside_a_marker(spark, odd):
    """A title with the phrase and a strong marker is rejected, as the SQL of the query knows no markers."""
    test_against_sql(spark, odd, "blacklist_verdict")


def test_links_of_pages_under_one_url(spark):
    """Links that stand at one place of several pages under one URL are ranked by the link, in every run."""
    from newsweir.sources import discovery

    pages = [(f"https://e.com/p{k}", f'<a href="/{x}{k}">x</a>') for k in range(30) for x in "dbca"]
    x = spark.createDataFrame(pages, "url string, html string")
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        got = {(r.source_url, r.rank): r.url for r in discovery.article_links(x, 3, ["/"], by_canonical=False).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == {(f"https://e.com/p{k}", n + 1): f"https://e.com/{x}{k}" for k in range(30) for n, x in enumerate("abc")}


def test_restored_once(spark):
    """A URL that was cached twice gives one row, with what was seen last."""
    from newsweir.operators import dedup

    seen = spark.createDataFrame([("a", "RU", 1, ("old", None)), ("a", "RU", 2, ("new", None)), ("a", "KZ", 3, ("other", None))], "url_hash string, portal string, last_seen_at int, cached struct<section: string, verdict: string>")
    got = dedup.restored(spark.createDataFrame([(1, "a"), (2, "b")], "seq long, url_hash string"), seen, "RU").collect()
    assert {r.seq: (r.cached and r.cached.section, r.from_cache) for r in got} == {1: ("new", True), 2: (None, False)} and len(got) == 2


def test_calls_not_asked_are_spread(spark):
    """Rows that don't ask have join keys of their own: a call that nobody makes puts no task in charge of all rows."""
    from newsweir.plans import calls

    x = spark.range(400).selectExpr("id AS seq", "concat('t', id) AS title", "'b' AS body", "'en' AS source_language", "'possible_news' AS verdict")
    none = {c: spark.createDataFrame([], calls.ANSWERS[c]) for c in calls.CALLS}
    asked = calls._answered(x.withColumns({f"_{c}": x.title for c in calls.CALLS}), "section", none["section"], x.seq < 0)
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    assert "no call" in plan and asked.where("section is not null or _asked_section").count() == 0 and asked.count() == 400
    keys = x.selectExpr("concat('no call ', xxhash64(title, title, title, seq)) AS k")
    assert keys.distinct().count() == 400


def test_pages_in_slices(spark, monkeypatch):
    """Pages become Python objects a slice at a time, in order, whatever batch Spark hands over; null pages have no article."""
    import pyarrow as pa
    from newsweir.functions import pages

    n = 3 * pages.AT_ONCE + 5
    read = []
    monkeypatch.setattr(pages, "read_page", lambda u, h: read.append(u) or {"title": h, "images": [u]})
    out = []
    for part in pages._pages.func(iter([(pa.array([f"u{k}" for k in range(n)]), pa.array(["x"] * (n - 1) + [None]))])):
        assert len(part) <= pages.AT_ONCE and len(read) <= len(out) + pages.AT_ONCE
        out += part.to_pylist()
    assert [p["images"][0] for p in out] == [f"u{k}" for k in range(n)] and out[-1]["title"] is None


def test_titles_are_made_before_events_are_joined(spark, odd):
    """Queries that don't want texts don't shuffle them: below the join there are titles, and no text comes out of it."""
    from newsweir.plans import catalog

    plan = catalog.articles(spark, odd).select("seq", "title")._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Join")[0]
    assert "substring" not in above and "substring" in plan


def test_ratios_in_slices():
    """Pairs are compared a slice at a time, in order, whatever batch Spark hands over."""
    import pandas as pd
    from newsweir.functions import text

    n = 2 * text.PAIRS + 7
    a, b = pd.Series([f"word {k} more" for k in range(n)]), pd.Series([f"word {k - k % 2} more" for k in range(n)])
    parts = list(text.token_set_ratio().func(iter([(a, b)])))
    assert [len(p) for p in parts] == [text.PAIRS, text.PAIRS, 7]
    assert [x == 100 for p in parts for x in p] == [k % 2 == 0 for k in range(n)]
