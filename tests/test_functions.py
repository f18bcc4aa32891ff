"""Scalar functions on literal cases."""

import random
from datetime import datetime

import pytest
from newsweir.functions import dates, rules, text, urls
from newsweir.functions.pages import articles, read_page
from newsweir.operators import origins
from pyspark.sql import functions as F


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "url,want",
    [
        ("HTTP://News.Weir.ORG/River/?gclid=7&page=2&fbclid=q#top", "http://news.weir.org/River/?page=2"),
        ("https://Weir.org?", "https://weir.org/"),
        ("http://e.com:80/A?b=&UTM_id=3&c", "http://e.com/A?b=&c="),
        ("https://e.com:443/a?q=a b*~&x=%C3%A9", "https://e.com/a?q=a+b%2A~&x=%C3%A9"),
        ("  https://e.com/a/  ", "https://e.com/a/"),
        ("https://e.com/?a=1=2&&b=3", "https://e.com/?a=1%3D2&b=3"),
        (None, None),
        ("nothing", "https:nothing"),
    ],
)
def test_canonical(spark, url, want):
    assert one(spark, url, urls.canonical) == want


def test_urls(spark):
    assert one(spark, "https://www.weir.org/x", urls.domain) == "weir.org"
    assert one(spark, "m.weir.org", urls.bare_domain) == "weir.org"
    assert one(spark, "press.bmw.com", lambda x: urls.host_in(x, ["www.bmw.com"])) is True
    assert one(spark, "notbmw.com", lambda x: urls.host_in(x, ["bmw.com"])) is False
    assert one(spark, "https://e.com/", urls.is_junk) is True and one(spark, None, urls.is_junk) is True and one(spark, "https://e.com/a/b", urls.is_junk) is False
    assert one(spark, "https://e.com/2026/4/a-b-c/index", urls.path_pattern) == "/YYYY/NN/_slug_/index"
    assert [one(spark, u, urls.channel_preview) for u in ("https://t.me/weir", "http://www.t.me/s/weir", "t.me/weir/77?single", "https://t.me/+Invite", "")] == ["https://t.me/s/weir"] * 3 + [None, None]


def test_titles(spark):
    assert one(spark, "A long enough title about cars — River Post", text.normalised_title) == "a long enough title about cars"
    assert one(spark, "A long enough title about cars | weir.org | News", text.normalised_title) == "a long enough title about cars"
    assert one(spark, None, text.normalised_title) == ""
    assert one(spark, "Sets its line-up to 10 models in India", text.cluster_title) == "sets its line"
    r = one(spark, "EN: One 2024\nRU: Два 2025", text.language_lines)
    assert (r.en, r.ru) == ("One 2024", "Два 2025") and one(spark, "plain", text.language_lines).en == "plain"
    assert one(spark, "x 2024 2021", lambda x: text.year_drift(x, F.lit("2021 2022"))) == ["2022", "2024"]
    assert [one(spark, v, text.truthy) for v in ("да", " Yes ", "0", None)] == [True, True, False, False]


def test_set_ratio():
    assert text.set_ratio("a b", "b a") == 100 and text.set_ratio("", "a") == 0 and text.set_ratio("a b c", "a b") == 100
    assert text.set_ratio("Toyota launches new Camry", "Toyota launches a new Camry in Japan") == 100
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("ab c", k=rng.randrange(30))) for _ in range(2))
        row = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                row[i + 1][j + 1] = row[i][j] + 1 if x == y else max(row[i][j + 1], row[i + 1][j])
        assert text.lcs_lengths([a], [b]).tolist() == [row[-1][-1]]
        assert text.set_ratio(a, b) == text.set_ratio(b, a) and 0 <= text.set_ratio(a, b) <= 100


def test_lengths_of_many_pairs():
    rng = random.Random(3)
    pairs = [("".join(rng.choices("abcdé日", k=rng.randrange(200))), "".join(rng.choices("abcdé日", k=rng.choice([0, 5, 63, 64, 65, 128, 200])))) for _ in range(120)]
    got = text.lcs_lengths([a for a, _ in pairs], [b for _, b in pairs])
    for (a, b), n in zip(pairs, got.tolist(), strict=True):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        assert n == row[-1]
    assert text.set_ratios(["a b", None, "x"], ["b a", "x", ""]).tolist() == [100, 0, 0]


def test_dates(spark):
    day = datetime(2026, 4, 27)
    assert one(spark, "https://e.com/2026/04/27/x", dates.from_url) == day and one(spark, "https://e.com/2026/02/31/", dates.from_url) is None
    for t in ("27 апреля 2026", "April 27, 2026", "27 April 2026", "27.04.2026", "2026-04-27"):
        assert one(spark, f"news of {t} here", lambda x: dates.from_text(x, F.lit(""))) == day, t
    assert one(spark, "27.04.2010", lambda x: dates.from_text(x, F.lit(""))) is None
    assert one(spark, "31.02.2026 then 2026-04-27", lambda x: dates.from_text(x, F.lit(""))) == day
    assert one(spark, "2026-04-27T10:00:00+03:00", dates.parsed) == datetime(2026, 4, 27, 7)
    assert one(spark, "Sun, 27 Apr 2026 13:45:00 GMT", dates.parsed) == datetime(2026, 4, 27, 13, 45)
    assert one(spark, "27.04.2026", dates.parsed) == day and one(spark, "soon", dates.parsed) is None
    now = datetime(2026, 4, 27, 12)
    assert [one(spark, t, lambda x: dates.is_fresh(x, 48, now), "timestamp") for t in (datetime(2026, 4, 27, 7), datetime(2026, 4, 24), None, datetime(2027, 1, 1))] == [True, False, True, True]


@pytest.mark.parametrize(
    "x,want",
    [
        ("2025-11-03T07:08:09Z", datetime(2025, 11, 3, 7, 8, 9)),
        ("2025-11-03 07:08:09+0500", datetime(2025, 11, 3, 2, 8, 9)),
        ("2025-11-03T07:08", datetime(2025, 11, 3, 7, 8)),
        ("2025/11/3", datetime(2025, 11, 3)),
        ("3-11-2025", datetime(2025, 11, 3)),
        (" 3.11.2025 07:08:09 ", datetime(2025, 11, 3, 7, 8, 9)),
        ("Fri, 03 Nov 2025 07:08:09 -0200", datetime(2025, 11, 3, 9, 8, 9)),
        ("Mon, 3 Nov 2025 07:08:09 GMT", datetime(2025, 11, 3, 7, 8, 9)),
        ("2025", None),
        ("31.11.2025", None),
        ("", None),
        (None, None),
    ],
)
def test_times(spark, x, want):
    assert one(spark, x, dates.parsed) == want


@pytest.mark.parametrize("path,want", [("a_2025-11-03.html", True), ("x-2025-11-03/b", True), ("20251103/c", True), ("2025/11/3", True), ("20251103x/", False), ("2025-11-031/", False), ("2014/11/03/", False), ("2025/13/03/", False), ("2014/11/03/and-2025-11-03", True)])
def test_dates_in_paths(spark, path, want):
    assert one(spark, f"https://weir.org/{path}", dates.from_url) == (datetime(2025, 11, 3) if want else None)


@pytest.mark.parametrize(
    "said,want",
    [("3 ноября 2025 года", True), ("Nov. 3, 2025", True), ("Sept 3 2025", False), ("3 NOVEMBER 2025", True), ("3/11/2025", True), ("5 маршрутов 2025", False), ("decade 12, 2025", False), ("3 ноября 2014, 3 ноября 2025", False), ("30 февраля 2025, Nov 3, 2025", True), ("12025-11-03", False)],
)
def test_dates_in_texts(spark, said, want):
    got = one(spark, said, lambda x: dates.from_text(F.lit("news"), x))
    assert (got == datetime(2025, 11, 3)) is want


def test_channel():
    from newsweir.functions.channels import read_posts

    page = """<div class="m" data-post="weir/1"><div class="tgme_widget_message_text js">Old<br/>line <a href="https://a.org/x">a</a><a href="https://t.me/b">b</a></div><time datetime="2025-11-03T07:00:00+00:00"></time></div>
    <div class="m" data-post="weir/2"><a class="tgme_widget_message_photo_wrap" style="width:9px;background-image:url('https://c.org/p.jpg')"></a><div class="tgme_widget_message_text"><div>Newer  </div><br>text &amp; more</div></div>
    <div class="m" data-post="weir/3"><a class="tgme_widget_message_photo_wrap" style="url(x)"></a></div>"""
    got = read_posts(page)
    assert [(p["url"], p["title"], p["image_url"], p["outbound_links"]) for p in got] == [("https://t.me/weir/2", "Newer", "https://c.org/p.jpg", []), ("https://t.me/weir/1", "Old", None, ["https://a.org/x"])]
    assert got[0]["body"] == "Newer\ntext & more" and got[1]["date_text"].startswith("2025-11-03") and read_posts(None) == []


def test_verdicts(spark):
    rows = [
        ("A car market review of the year", "x" * 1200, "https://e.com/news/a", '{"@type": "NewsArticle"}', datetime(2026, 1, 1)),
        ("untitled", "x" * 1200, "https://e.com/news/a", "", None),
        ("A fine title of some length", "x" * 1200, "https://e.com/news/a.pdf", "", datetime(2026, 1, 1)),
        ("Time to rethink all of it now", "x" * 600, "https://e.com/tag/x", "", None),
        (None, None, "https://e.com/", None, None),
    ]
    df = spark.createDataFrame(rows, "title string, body string, url string, html string, at timestamp")
    got = [r.v for r in df.select(rules.article_verdict(*map(F.col, ("title", "body", "url", "html", "at"))).alias("v")).collect()]
    assert [g.is_article for g in got] == [True, False, False, False, False]
    assert [g.score for g in got] == [1.0, 0.0, 0.0, 0.0, 0.0] and got[1].reasons == ["missing-or-placeholder-title"]
    topic = lambda t, lang="en": one(spark, t, lambda x: rules.topic_verdict(x, F.lit(""), F.lit(lang)))
    assert topic("New sedan and SUV from Toyota").hits == 3 and topic("The marketing of football").passes is False
    assert topic("자동차", "ko").passes is True and topic("자동차", "").passes is False and topic("Новые электромобили").passes is True
    black = lambda t: one(spark, t, lambda x: rules.blacklist_reason(F.lit("https://e.com/a"), x, ["bad.com"], ["электробус"], ["BMW"]))
    assert black("Электробус на линии") == "phrase: электробус" and black("BMW представила электробус") is None and black("Вы не поверите, BMW") == "clickbait: вы не поверите"
    assert [one(spark, x, rules.human_label) for x in ("Новость", "не по теме", "нет", "это не новость", "", None)] == ["news_in_topic", "news_off_topic", "not_news", "not_news", "", ""]


PRIMARY = [
    ("https://press.toyota.com/a", "t", "b", [], "https://press.toyota.com/a", "high"),
    ("https://blog.com/a", "t", "b", ["https://facebook.com/sharer/?u=1", "https://press.toyota.com/r/1"], "https://press.toyota.com/r/1", "high"),
    ("https://blog.com/a", "Toyota news", "b", ["https://x.org/1", "https://www.toyota.jp/n/1"], "https://www.toyota.jp/n/1", "high"),
    ("https://blog.com/a", "t", "b", ["https://www.toyota.jp/n/1"], "https://www.toyota.jp/n/1", "medium"),
    ("https://blog.com/a", "t", "according to x", ["https://t.me/c/1", "https://x.org/1"], "https://x.org/1", "medium"),
    ("https://blog.com/a", "t", "b", ["https://x.org/1"], "https://blog.com/a", "low"),
    ("https://blog.com/a", "t", "b", None, "https://blog.com/a", "low"),
    ("https://news.com/a", "t", "b", ["https://press.toyota.com/r/1"], "https://news.com/a", "high"),
]


def test_primary_source(spark):
    df = spark.createDataFrame([(i, *p[:4]) for i, p in enumerate(PRIMARY)], "i int, url string, title string, body string, links array<string>")
    p = origins.primary_source(F.col("url"), F.col("title"), F.col("body"), F.col("links"), [("Toyota", [], ["toyota.jp"]), ("BMW", [], ["bmw.com"])], ["According to"], ["press.toyota.com"], ["t.me"], ["news.com"])
    got = [(r.p.url, r.p.confidence) for r in df.select("i", p.alias("p")).orderBy("i").collect()]
    assert got == [p[4:] for p in PRIMARY]


HTML = """<html><head><meta property="og:title" content="The title"><meta property="article:published_time" content="2026-04-10T08:00:00Z"><link rel="alternate" type="application/rss+xml" href="/feed">
<script type="application/ld+json">{"@graph": [{"datePublished": "2025-01-01"}]}</script></head><body><nav><a href="https://x.org/n">n</a></nav>
<article><h1>H</h1><p>Body one.</p><img src="/i.png" width="800"><img src="/small.png" width="20"><a href="https://press.com/r">r</a><a href="/own">o</a></article></body>"""


def test_pages(spark):
    p = read_page("https://e.com/a", HTML)
    assert (p["title"], p["body"], p["image_url"], p["outbound_links"], p["feed_url"]) == ("The title", "H\nBody one.\nr\no", "https://e.com/i.png", ["https://press.com/r"], "https://e.com/feed")
    rows = articles(spark.createDataFrame([("https://e.com/a", HTML), ("https://e.com/2026/04/27/b", "<h1>x</h1>"), ("https://e.com/c", None), ("https://e.com/d", "<p>no title")], "url string, html string")).collect()
    assert {r.url: r.published_at for r in rows} == {"https://e.com/a": datetime(2026, 4, 10, 8), "https://e.com/2026/04/27/b": datetime(2026, 4, 27)}
