"""Rules that score, grade and reject articles, as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .urls import bare_domain, domain, netloc, part, strip


def any_of(text: Column, parts: list[str]) -> Column:
    """Whether a text contains one of `parts`."""
    return F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(text, p)) if parts else F.lit(False)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is made once, however often it is read."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def link_density(html: Column, body_length: Column) -> Column:
    """Links for each character of the body, 0 without html or body."""
    links = F.regexp_count(F.coalesce(html, F.lit("")), F.lit("<a "))
    return F.when(body_length > 0, links / F.greatest(body_length, F.lit(1))).otherwise(0.0)


def article_verdict(title: Column, body: Column, url: Column, html: Column, published: Column, whitelist: list[str] | None = None) -> Column:
    """is_article, score (0 to 1, three decimals) and reasons of an article, by an additive rubric."""
    html, title, body = (F.coalesce(x, F.lit("")) for x in (html, title, body))
    return bound(F.length(strip(body)), lambda size: _article_verdict(title, size, url, html, published, whitelist))


def _article_verdict(title: Column, size: Column, url: Column, html: Column, published: Column, whitelist: list[str] | None) -> Column:
    packed, name = F.replace(html, F.lit(" "), F.lit("")), F.lower(strip(title))
    low, path, full = F.lower(title), F.lower(part(url, 3)), F.lower(url)
    typed = lambda t: F.contains(packed, F.lit(f'"@type":"{t}"'))
    density = link_density(html, size)
    binary = F.exists(F.array(*map(F.lit, fixed.BINARY_EXTENSIONS)), lambda e: F.endswith(path, e))
    host = F.regexp_replace(netloc(url), r"^www\.", "")
    terms = [
        (typed("NewsArticle"), 0.4, "schema:NewsArticle"),
        (~typed("NewsArticle") & typed("Article"), 0.25, "schema:Article"),
        (F.contains(html, F.lit('og:type" content="article"')), 0.2, "og:type=article"),
        (published.isNotNull(), 0.25, "published_at"),
        (size >= 1000, 0.25, "body>=1000"),
        (size.between(500, 999), 0.15, "body>=500"),
        (size.between(200, 499), 0.05, "body>=200"),
        (size < 200, 0.0, "body<200"),
        (F.length(title).between(20, 220), 0.1, "title-length-ok"),
        (any_of(path, fixed.ARTICLE_URL), 0.1, "url-article-slug"),
        (binary, -0.8, "binary-document-url"),
        (any_of(full, fixed.NON_ARTICLE_URL), -0.5, "url-non-article-pattern"),
        (any_of(low, fixed.OP_ED), -0.6, "title-op-ed"),
        (any_of(low, fixed.LIFESTYLE), -0.6, "title-lifestyle"),
        (host.isin(whitelist) if whitelist else F.lit(False), 0.15, "whitelist-domain"),
        (density > 0.08, -0.3, "high-link-density"),
    ]

    def verdict(f: Column) -> Column:
        total = F.lit(0.0)
        for k, (_, weight, _) in enumerate(terms):
            total = total + F.when(f["on"][k], weight).otherwise(0.0)
        score = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(total, 6))), 3)
        reasons = F.array_compact(F.array(*[F.when(f["on"][k], F.lit(said)) for k, (_, _, said) in enumerate(terms)]))
        return F.struct(
            (~f["empty"] & (score >= 0.35) & f["long"] & ~f["binary"]).alias("is_article"),
            F.when(f["empty"], 0.0).otherwise(score).alias("score"),
            F.when(f["empty"], F.array(F.lit("missing-or-placeholder-title"))).otherwise(reasons).alias("reasons"),
            (~f["empty"] & f["binary"]).alias("binary"),
        )

    return bound(F.struct(F.array(*[on for on, _, _ in terms]).alias("on"), (size >= 200).alias("long"), binary.alias("binary"), name.isin(fixed.PLACEHOLDER).alias("empty")), verdict)


def _pattern(word: str) -> str | None:
    """The pattern of a Latin word, at word ends unless it has its own space there; null for other scripts, which match as parts."""
    if re.search("[぀-ヿ㐀-䶿一-鿿Ѐ-ӿ]", word):
        return None
    return ("" if word.startswith(" ") else r"\b") + re.escape(word.lower()) + ("" if word.endswith(" ") else r"\b")


def hits(text: Column, words: list[str]) -> Column:
    """The words of a list that a lower-case text has, trimmed, in the list's order."""
    if not words:
        return F.array().cast("array<string>")
    # patterns are constants, compiled once, and tried for the few words alone that the text contains
    found = lambda t, w, p: F.contains(t, F.lit(w.lower())) & t.rlike("(?U)" + p) if p else F.contains(t, F.lit(w.lower()))
    # as a bound variable, so that the text is made once and not for each word
    return bound(text, lambda t: F.array_compact(F.array(*[F.when(found(t, w, _pattern(w)), F.lit(w.strip())) for w in words])))


def topic_verdict(title: Column, body: Column, language: Column, topic: list[str] = fixed.TOPIC, off_topic: list[str] = fixed.OFF_TOPIC, covered: list[str] = fixed.COVERED_LANGUAGES) -> Column:
    """passes, hits, negative, samples: whether words of the topic outnumber those that speak against it.

    In a language that the lists don't cover, a text without any word of either passes with one hit."""
    text = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.substring(F.coalesce(body, F.lit("")), 1, 2000)))
    lang = F.substring(F.lower(F.coalesce(language, F.lit(""))), 1, 2)

    def verdict(f: Column) -> Column:
        good, bad = f["good"], f["bad"]
        trust = (F.size(good) == 0) & (bad == 0) & (lang != "") & ~lang.isin(covered)
        return F.struct(
            (trust | (F.size(good) >= 1) & (F.size(good) > bad)).alias("passes"),
            F.when(trust, 1).otherwise(F.size(good)).alias("hits"),
            bad.alias("negative"),
            F.when(trust, F.array(F.concat(F.lit("lang-fallback:"), lang))).otherwise(F.slice(good, 1, 5)).alias("samples"),
        )

    return bound(text, lambda t: bound(F.struct(F.array_distinct(hits(t, topic)).alias("good"), F.size(hits(t, off_topic)).alias("bad")), verdict))


def grade(article: Column, topic: Column) -> Column:
    """not_article, off_topic, certain_news or possible_news of the two verdicts."""
    return (
        F.when(article["binary"] | ~article["is_article"], "not_article")
        .when(~topic["passes"], "off_topic")
        .when((article["score"] >= 0.65) & (topic["hits"] >= 2), "certain_news")
        .otherwise("possible_news")
    )


def brand_signal(title: Column, names: list[str], markers: list[str] = fixed.STRONG_MARKERS) -> Column:
    """Whether a lower-case title has a strong marker or a brand: names under four characters stand alone."""
    long, short = [n for n in names if len(n) >= 4], [n for n in names if len(n) < 4]
    return any_of(title, markers) | any_of(title, long) | any_of(F.concat(F.lit(" "), title, F.lit(" ")), [f" {n} " for n in short])


def blacklist_reason(url: Column, title: Column, domains: list[str], phrases: list[str], brands: list[str] | None = None, force: list[str] = fixed.FORCE_REJECT, markers: list[str] = fixed.STRONG_MARKERS) -> Column:
    """Why an article is rejected outright: its domain, a phrase that always rejects, or a phrase of a title without a
    brand or one of `markers`; null if it isn't."""
    d, low = domain(F.coalesce(url, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
    first = lambda values, test: F.get(F.filter(F.array(*map(F.lit, values)) if values else F.array().cast("array<string>"), test), F.lit(0))
    by_domain = first(domains, lambda b: (d == b) | F.endswith(d, F.concat(F.lit("."), b)))
    forced, phrase = first(force, lambda p: F.contains(low, p)), first([p for p in phrases if p], lambda p: F.contains(low, p))
    return F.coalesce(F.concat(F.lit("domain: "), by_domain), F.concat(F.lit("clickbait: "), forced), F.when(~brand_signal(low, [b.lower() for b in brands or []], markers), F.concat(F.lit("phrase: "), phrase)))


def human_label(raw: Column, exact: bool = True) -> Column:
    """news_in_topic, news_off_topic or not_news of what people wrote; empty if it is none. Without `exact` only by what the text
    contains, not by the lists of whole answers."""
    whole = lambda values: t.isin(values) if exact else F.lit(False)
    t = F.replace(F.lower(strip(F.coalesce(raw, F.lit("")))), F.lit("ё"), F.lit("е"))
    return (
        F.when(whole(fixed.IN_TOPIC), "news_in_topic").when(whole(fixed.NOT_IN_TOPIC), "news_off_topic").when(whole(fixed.NOT_NEWS), "not_news")
        .when(F.contains(t, F.lit("не новост")), "not_news").when(F.contains(t, F.lit("не по теме")), "news_off_topic").when(F.contains(t, F.lit("новост")), "news_in_topic").otherwise("")
    )


def health(status: Column, error: Column, attempted: Column, passed: Column) -> Column:
    """The bucket of a source's last run: what kept it from giving articles, or healthy."""
    s, e = F.coalesce(strip(status.cast("string")), F.lit("")), F.lower(F.coalesce(error, F.lit("")))
    none = lambda x: F.coalesce(strip(x.cast("string")), F.lit("")).isin("", "0")
    return (
        F.when(s.isin("403", "401"), "blocked").when(s.isin("404", "410"), "gone").when(s.rlike(r"^5\d\d$"), "server error")
        .when(e.rlike("timeout|timed out"), "timeout").when(e.rlike("connecterror|connect error|nameresolution|dns"), "connection")
        .when((e != "") & (s == ""), "other error").when((s != "200") & ((s != "") | (e != "")), "unknown")
        .when(none(attempted), "no articles").when(none(passed), "no topic hits").otherwise("healthy")
    )


def junk_cluster(title: Column, urls: Column, lede: Column, junk: list[str]) -> Column:
    """Whether a story isn't one: two words or fewer, a junk phrase, a static document, not translated, or short all over."""
    t = strip(F.coalesce(title, F.lit("")))
    text = strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"(?U)\s*EN:\s*", ""), r"(?U)\s*RU:\s*", " "), r"(?U)\s*\([A-Za-zА-Яа-яЁё]{2,4}\)\s*", ""))
    words = F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))
    static = any_of(F.lower(F.array_join(urls, " ")), fixed.STATIC_DOCUMENT_URL)
    return (words <= 2) | any_of(F.lower(t), [j.lower() for j in junk]) | static | ~(F.contains(t, F.lit("EN:")) | F.contains(t, F.lit("RU:"))) | ((F.length(strip(F.coalesce(lede, F.lit("")))) < 50) & (words < 6))


def link_domain(url: Column) -> Column:
    """Domain of a link without www., m. or amp."""
    return bare_domain(domain(url))


def retryable(status: Column, error: Column) -> Column:
    """Whether a fetch is worth a second try: 202, a server error or a broken connection, never a timeout or another 4xx."""
    e = F.lower(F.coalesce(error, F.lit("")))
    return F.coalesce((status == 202) | status.between(500, 599), F.lit(False)) | e.rlike("readerror|remoteprotocolerror")


def source_kind(url: Column, content_type: Column, head: Column, feed_entries: Column) -> Column:
    """How a source is read: a channel, a feed by type or first bytes, a page with a feed that has entries, or a page."""
    feed = F.lower(F.coalesce(content_type, F.lit(""))).rlike("rss|atom|xml") & strip(F.coalesce(head, F.lit(""))).rlike(r"(?is)^(?:<\?xml.*)?<(?:rss|feed|rdf)|^<\?xml")
    return F.when(F.regexp_replace(netloc(url), r"^www\.", "") == "t.me", "channel").when(feed, "rss").when(feed_entries > 0, "discovered").otherwise("html")


def looks_like_news(title: Column, body: Column, published: Column, url_hint: Column) -> Column:
    """A cheap test of a captured page: a title of ten characters or more, and a date, a hint in the URL or a long body."""
    return F.coalesce(F.length(strip(title)) >= 10, F.lit(False)) & (published.isNotNull() | url_hint | (F.length(F.coalesce(body, F.lit(""))) >= 500))


def language_tag(language: Column, tags: dict[str, str]) -> Column:
    """The tag of a language by its first two letters, these in upper case if it has none, empty for null or blank."""
    known = F.create_map(*[F.lit(x) for kv in tags.items() for x in kv]) if tags else F.create_map().cast("map<string,string>")
    low = F.substring(F.lower(strip(F.coalesce(language, F.lit("")))), 1, 2)
    return F.coalesce(F.try_element_at(known, low), F.upper(low))
