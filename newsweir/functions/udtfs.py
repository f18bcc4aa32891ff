"""Pages and channels as table functions, for SQL: `SELECT ... FROM pages, LATERAL channel_posts(html, 15)`.

Each row of a table is handed to a function, in Arrow batches, and gives rows of its own, which are joined to it. `register` makes
the functions known to a session; as classes they serve `DataFrame.lateralJoin`."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .channels import read_posts
from .dates import from_text, from_url, parsed
from .pages import SCHEMA, read_page


@F.udtf(returnType="pos int, url string, title string, body string, date_text string, image_url string, outbound_links array<string>", useArrow=True)
class ChannelPosts:
    """The newest posts of a preview page (html), at most so many."""

    def eval(self, html: str, most: int) -> Iterator[tuple]:
        for k, p in enumerate(read_posts(html)[:most]):
            yield k, p["url"], p["title"], p["body"], p["date_text"], p["image_url"], p["outbound_links"]


@F.udtf(returnType=SCHEMA, useArrow=True)
class PageArticle:
    """The article of a page (url, html), a row if it has a title."""

    def eval(self, url: str, html: str) -> Iterator[tuple]:
        page = read_page(url or "", html)
        if page["title"] is not None:
            yield tuple(page[c] for c in SCHEMA.names)


def register(spark: SparkSession) -> None:
    """Make channel_posts(html, most) and page_article(url, html) known to a session."""
    spark.udtf.register("channel_posts", ChannelPosts)
    spark.udtf.register("page_article", PageArticle)


def channel_posts(pages: DataFrame, most: int = 15) -> DataFrame:
    """As `channels.channel_posts`, by a lateral join."""
    x = pages.select(F.col("url").alias("source_url"), "html").lateralJoin(ChannelPosts(F.col("html").outer(), F.lit(most)))
    return x.drop("html").withColumn("published_at", parsed(F.col("date_text"))).drop("date_text")


def articles(pages: DataFrame) -> DataFrame:
    """As `pages.articles`, by a lateral join."""
    x = pages.lateralJoin(PageArticle(F.col("url").outer(), F.col("html").outer()))
    return x.withColumn("published_at", F.coalesce(parsed(F.col("date_text")), from_url(F.col("url")), from_text(F.col("title"), F.col("body")))).drop("date_text")
