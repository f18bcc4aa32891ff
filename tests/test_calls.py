"""Chained model calls from replay tables, pending requests, and the cap over calls."""

import random

import pytest
from newsweir.operators import budget
from newsweir.plans import calls, runs
from newsweir.sources.discovery import absolute
from newsweir.sources import tables
from pyspark.sql import functions as F
from test_runs import T, world

SECTIONS = [("Market", "sales "), ("Tech", "new things")]
SHOTS = [("Market", "Sales rise"), ("Tech", "A new engine")]
ARTICLE = "seq long, title string, body string, source_language string, verdict string"


def articles(spark):
    rows = [(1, "good", "b", "de", "possible_news"), (2, "off topic", "b", "en", "possible_news"), (3, "waits for a section", "b", None, "possible_news"), (4, "never asked before", "b", "en", "possible_news"), (5, "fails", "b", "en", "possible_news"), (6, "good", "b", "de", "possible_news"), (7, None, None, None, "certain_news"), (8, "odd section", "b" * 5000, "en", "possible_news"), (9, "good", "b", "en", "possible_news")]
    return spark.createDataFrame(rows, ARTICLE)


def replay(spark, x, country="Country"):
    """Answers to some of the calls of x, by title."""
    k = calls.keys(F.col("title"), F.col("body"), F.col("source_language"), SECTIONS, SHOTS, country)
    of = lambda call, where: x.where(where).select("seq", "title", k[call].alias("key"), F.lit(0.1).alias("cost"), F.lit(None).cast("string").alias("error"))
    relevance = of("relevance", "seq not in (4, 7)").select("key", (F.col("title") != "off topic").alias("relevant"), "cost", "error")
    section = of("section", "seq not in (3, 4)").select("key", F.when(F.col("title") == "odd section", "Weather").otherwise("Market").alias("section"), F.lit("Local").alias("region"), F.lit(0.5).alias("confidence"), "cost", F.when(F.col("title") == "fails", "timeout").alias("error"))
    titles = of("titles", "seq not in (9)").select("key", F.concat(F.lit("EN "), "seq").alias("title_en"), F.lit("RU").alias("title_ru"), F.lit("DE").alias("language"), "cost", "error")
    return {"relevance": relevance.unionByName(relevance), "section": section, "titles": titles}


def test_chained_calls(spark):
    x = articles(spark)
    got = {r.seq: r for r in calls.chained(x, replay(spark, x), SECTIONS, SHOTS, "Country").collect()}
    made = {k: [c.call for c in r.calls] for k, r in got.items()}
    assert made == {1: list(calls.CALLS), 6: list(calls.CALLS), 2: ["relevance"], 3: ["relevance"], 4: [], 5: ["relevance", "section"], 7: [], 8: list(calls.CALLS), 9: ["relevance", "section"]}
    assert {k: r.verdict for k, r in got.items()} == {1: "certain_news", 2: "rejected", 3: "certain_news", 4: "possible_news", 5: "certain_news", 6: "certain_news", 7: "certain_news", 8: "certain_news", 9: "certain_news"}
    assert (got[1].section, got[8].section, got[1].region, got[1].title_en, got[6].title_en, got[8].language) == ("Market", "Other news", "Local", "EN 1", "EN 1", "DE")
    assert got[5].note == "section: timeout" and got[1].note is None and got[1].cost == 0.3 and got[2].cost == 0.1
    assert {k: r.pending.call for k, r in got.items() if r.pending} == {3: "section", 4: "relevance", 7: "relevance", 9: "titles"}
    asked = {(r.call, r.seq) for r in calls.requests(calls.chained(x, replay(spark, x), SECTIONS, SHOTS, "Country")).collect()}
    assert asked == {("section", 3), ("relevance", 4), ("relevance", 7), ("titles", 9)}
    assert calls.chained(x.limit(0), replay(spark, x), SECTIONS).count() == 0
    # all that the prompt is made of is in the key: another country, other few-shots or sections have no answers
    for other in (("Elsewhere", SECTIONS, SHOTS), ("Country", SECTIONS[:1], SHOTS), ("Country", SECTIONS, SHOTS[:1])):
        waits = {r.seq: r.pending.call for r in calls.chained(x, replay(spark, x), other[1], other[2], other[0]).where("pending is not null").collect()}
        assert waits[1] == "section" and waits[8] == "section" and 2 not in waits
    shots = tables.few_shots(spark.createDataFrame([(k, f"s{k % 9}", f"t{k}", "") for k in range(60)], "seq long, section string, title string, region string"))
    assert calls.shots_of(shots, 4) == [("s0", "t0"), ("s0", "t9"), ("s0", "t18"), ("s1", "t1")]


def test_cap_over_calls(spark):
    """The call that breaks the cap is charged and its article lost; earlier calls of it stay spent."""
    r = random.Random(3)
    rows = [(seq, [(k + 1, f"c{k}", "x", r.choice([0.0, 1.0, 2.0, 5.0])) for k in range(r.randrange(4))]) for seq in range(200)]
    x = spark.createDataFrame(rows, "seq long, calls array<struct<step: int, call: string, key: string, cost: double>>")
    for cap in (0, 3, 40.0, 10**6):
        kept, spent, paid, broken = set(), 0, [], False
        for seq, own in rows:
            for step, *_, cost in own:
                if not broken:
                    spent += cost
                    paid.append((seq, step, float(spent)))
                    broken = spent > cap
            if not broken:
                kept.add(seq)
        assert {q.seq for q in budget.whole_within(x, cap, ["seq"]).collect()} == kept
        assert sorted((q.seq, q.step, q.spent) for q in budget.charged(x, cap, ["seq"]).collect()) == paid
    one = lambda *costs: spark.createDataFrame([(k, [(1, "c", "x", c)]) for k, c in enumerate(costs)], x.schema)
    assert budget.whole_within(one(0.3, 0.4), 1.0, ["seq"]).count() == 2 and budget.charged(one(0.3, 0.4), 1.0, ["seq"]).count() == 2
    assert budget.whole_within(one(0.3, 0.3), 0.5, ["seq"]).count() == 1 and budget.charged(one(0.3, 0.3), 0.5, ["seq"]).agg(F.max("spent")).first()[0] == pytest.approx(0.6)


def test_production_run_by_calls(spark):
    a, seen, known, _ = world(spark)
    s = runs.Settings(now=T, hours=48, cap=9.0, sections=SECTIONS, shots=SHOTS, country="Country")
    x = a.withColumn("verdict", F.lit(""))
    k = calls.keys(F.col("title"), F.col("body"), F.col("source_language"), SECTIONS, SHOTS, "Country")
    none = F.lit(None).cast("string").alias("error")
    answers = {
        "relevance": x.where("seq in (1, 5, 6)").select(k["relevance"].alias("key"), (F.col("seq") != 5).alias("relevant"), F.lit(0.1).alias("cost"), none),
        "section": x.where("seq in (1, 6)").select(k["section"].alias("key"), F.lit("Market").alias("section"), F.lit("Global").alias("region"), F.lit(0.9).alias("confidence"), F.lit(0.1).alias("cost"), none),
        "titles": x.where("seq = 1").select(k["titles"].alias("key"), F.lit("T").alias("title_en"), F.lit("Т").alias("title_ru"), F.lit("EN").alias("language"), F.lit(0.1).alias("cost"), none),
    }
    out = runs.production_run(a, seen, known, answers, s)
    assert [(r.seq, r.section, r.country) for r in out["rows"].collect()] == [(1, "Market", "Country")]
    assert {(r.call, r.seq) for r in out["requests"].collect()} == {("titles", 6), ("relevance", 8)}


def test_links_as_browsers_see_them(spark):
    from urllib.parse import urldefrag, urljoin

    bases = ["https://e.com/a/b/c/d/e/f/g.html", "https://e.com/a/g.html", "https://e.com", "https://e.com/", "https://e.com/a/b/", "http://e.com/a//b/c?x=1/2#f", "https://e.com?q=/a/b"]
    hrefs = ["x", "./x", "../x", "../../x", "../../../../../../x", "../", "..", ".", "./", "/x", "/x/../y", "/../x", "/a/./b/", "x/../../y/", "?q=1", "x?y=../z", "//o.com/a/../b", "https://o.com/a/../b", "#f", "a//b", "x#f", "", "/", "a/b/c/../../../../d", "  x ", "y/..", "/a//b/../c"]
    rows = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    for r in rows.select("b", "h", absolute(F.col("b"), F.col("h")).alias("u")).collect():
        own = urldefrag(r.h.strip())[0]
        assert r.u == (urldefrag(urljoin(r.b, r.h.strip()))[0] if own else None), r
    assert rows.limit(1).select(absolute(F.col("b"), F.lit("mailto:a@b.c")).alias("u")).first().u is None


def test_urls_without_a_host(spark):
    from newsweir.functions.urls import canonical
    from newsweir.operators import dedup
    from urllib.parse import parse_qsl, urlencode, urlparse, urlunparse

    urls = ["/path", "path/x", "abc", "/path?utm_source=1&a=b", "mailto:a@b.c", "HTTPS:/x", "https:x", "//", "///x", "////x", "?a=1", "#f", "https:///p?x=1", "e.com/a", "javascript:void(0)", "tel:+1", "https://E.com"]
    for r in spark.createDataFrame([(u,) for u in urls], "u string").select("u", canonical(F.col("u")).alias("c")).collect():
        p = urlparse(r.u)
        query = urlencode([(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k != "utm_source"])
        assert r.c == urlunparse((p.scheme.lower() or "https", p.netloc.lower(), p.path or "/", p.params, query, "")), r
    rows = spark.createDataFrame([(k, u, f"t{k}", "body", T, "en") for k, u in enumerate(["/a", "/b", "c", "/a", None, None])], "seq long, url string, title string, body string, published_at timestamp, source_language string")
    assert {r.seq for r in dedup.fresh_candidates(rows, 48, T).collect()} == {0, 1, 2}
    assert {r.seq for r in runs.graded(rows, runs.Settings(now=T, hours=48)).where("verdict = 'duplicate'").collect()} == {3}
