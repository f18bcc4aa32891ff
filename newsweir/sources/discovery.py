"""Links of index pages to articles, and articles of feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import parsed
from ..functions.fixed import DISCOVERY_URL
from ..functions.urls import canonical, host_in, looks_like_article, netloc, strip

# fixed values: where feeds are sought if a page names none
FEED_PATHS = ["/feed", "/rss", "/rss.xml", "/feed.xml", "/atom.xml", "/index.xml"]
_HREF = r"(?is)<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"


def _resolved(segments: Column) -> Column:
    """The path of segments, each `..` with the segment before it taken out, none above the root."""
    up = lambda seen: F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(0)))
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda seen, s: F.when(s == "..", up(seen)).when(s == ".", seen).otherwise(F.concat(seen, F.array(s))))
    kept = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.concat(F.lit("/"), F.regexp_replace(F.array_join(kept, "/"), "^/", ""))


def absolute(base: Column, href: Column) -> Column:
    """A link as seen from a page, without fragment; null for other schemes than http and https and for bare fragments."""
    h = F.regexp_replace(strip(href), "#.*$", "")
    root, scheme = F.regexp_extract(base, "^([A-Za-z]+://[^/?#]*)", 1), F.regexp_extract(base, "^([A-Za-z]+:)//", 1)
    path, query = F.regexp_extract(h, r"^([^?]*)", 1), F.regexp_extract(h, r"^[^?]*(\?.*)$", 1)
    folder = F.split(F.regexp_extract(base, "^[A-Za-z]+://[^/?#]*((?:/[^/?#]*)*)/", 1), "/")
    own = F.split(path, "/")
    inner = F.filter(F.concat(folder, F.slice(own, F.lit(1), F.size(own) - 1)), lambda s: s != "")
    below = F.concat(inner, F.slice(own, F.size(own), F.lit(1)))
    return (
        F.when(h.rlike("^(?i)https?://"), h).when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None)).when(F.startswith(h, F.lit("//")), F.concat(scheme, h))
        .when(F.startswith(h, F.lit("/")), F.concat(root, _resolved(own), query)).when(F.startswith(h, F.lit("?")), F.concat(F.regexp_extract(base, "^([^?#]*)", 1), h)).when(h != "", F.concat(root, _resolved(below), query))
    )


def article_links(pages: DataFrame, limit: int, hints: list[str] = DISCOVERY_URL, by_canonical: bool = True) -> DataFrame:
    """source_url, rank, url: the first `limit` links of each page (url, html) to other pages of its host that look like
    articles, each once by its canonical form (or as it stands), in page order."""
    parts = F.zip_with(F.regexp_extract_all("html", F.lit(_HREF), 1), F.zip_with(F.regexp_extract_all("html", F.lit(_HREF), 2), F.regexp_extract_all("html", F.lit(_HREF), 3), lambda a, b: F.concat(a, b)), lambda a, b: F.concat(a, b))
    x = pages.select(F.col("url").alias("source_url"), F.posexplode(parts).alias("pos", "href")).withColumn("url", absolute(F.col("source_url"), F.col("href")))
    x = x.where(F.col("url").isNotNull() & (netloc(F.col("url")) == netloc(F.col("source_url"))) & looks_like_article(F.col("url"), hints))
    x = x.groupBy("source_url", (canonical(F.col("url")) if by_canonical else F.col("url")).alias("key")).agg(F.min(F.struct("pos", "url")).alias("m"))
    x = x.withColumn("rank", F.row_number().over(Window.partitionBy("source_url").orderBy("m")))  # links at one place, of pages under one URL, by the link
    return x.where(F.col("rank") <= limit).select("source_url", "rank", F.col("m.url").alias("url"))


def feed_candidates(base: Column) -> Column:
    """Where a page's feed may be if it names none."""
    root = F.regexp_extract(base, "^([A-Za-z]+://[^/?#]*)", 1)
    return F.transform(F.array(*map(F.lit, FEED_PATHS)), lambda p: F.concat(root, p))


def first_articles(links: DataFrame, pages: DataFrame, most: int) -> DataFrame:
    """The first `most` links of each source (source_url, rank, url) of which an article was captured (pages: url, others), by
    rank, with their page's columns. Links are tried in order until enough succeed: what comes after isn't asked for."""
    x = links.select("source_url", "rank", "url").join(pages, "url")
    x = x.withColumn("_k", F.row_number().over(Window.partitionBy("source_url").orderBy("rank"))).where(F.col("_k") <= most)
    return x.withColumn("rank", F.col("_k").cast("int")).drop("_k")


def index_articles(index: DataFrame, pages: DataFrame, most: int, hints: list[str] = DISCOVERY_URL) -> DataFrame:
    """The first `most` articles of each index page (url, html): of its first 3 * `most` links those that were captured."""
    return first_articles(article_links(index, 3 * most, hints), pages, most)


def feed_articles(items: DataFrame, pages: DataFrame, most: int, from_feed: bool = True) -> DataFrame:
    """The first `most` items of each feed (source_url, pos, title, link, published_text) as articles: seq-less rows with title
    and date of the captured page (url, title, body, published_at), or with `from_feed` those of the feed where the page has
    none; without it a title in the feed isn't needed. Items without a link go, and those of which no page was captured."""
    x = items.withColumn("k", F.row_number().over(Window.partitionBy("source_url").orderBy("pos"))).where(F.col("k") <= most)
    x = x.where((F.coalesce("link", F.lit("")) != "") & ((F.coalesce("title", F.lit("")) != "") | F.lit(not from_feed)))
    i, p = x.alias("i"), pages.alias("p")
    title = F.coalesce(F.nullif(F.col("p.title"), F.lit("")), F.col("i.title") if from_feed else F.lit(None))
    at = F.coalesce("p.published_at", parsed(F.col("i.published_text"))) if from_feed else F.col("p.published_at")
    return i.join(p, F.col("i.link") == F.col("p.url")).select("i.source_url", "p.url", title.alias("title"), "p.body", at.alias("published_at"))


def soft_cap(found: DataFrame, most: int, source: str = "source_url", order: str = "rank") -> DataFrame:
    """Rows of the sources up to `most` rows, checked between sources: the source that passes the cap is still whole."""
    sums = found.groupBy(source).agg(F.count("*").alias("_c"), F.min(F.struct(order, source)).alias("_o"))
    sums = sums.withColumn("_before", F.coalesce(F.sum("_c").over(Window.orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return found.join(sums.where(F.col("_before") < most).select(source), source, "left_semi")


def insecure(url: Column, hosts: list[str]) -> Column:
    """Whether a URL is fetched without checking certificates."""
    return host_in(netloc(url), hosts)


def rewritten(url: Column, rewrites: dict[str, str]) -> Column:
    """A URL, or what it is replaced by."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in rewrites.items() for x in kv]), url), url) if rewrites else url
