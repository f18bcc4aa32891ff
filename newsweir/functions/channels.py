"""Posts of a public channel's preview page."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .dates import parsed

# fixed values: marks of the preview page: the attribute with a post's name, and classes of its text and its pictures
POST_ATTRIBUTE, HOST = "data-post", "t.me/"
TEXT_CLASS, PICTURE_CLASSES = "tgme_widget_message_text", ["tgme_widget_message_photo_wrap", "link_preview_image", "link_preview_right_image"]
LEAST_TITLE, MOST_TITLE = 3, 220

_POST = StructType([StructField(c, ArrayType(StringType()) if c == "outbound_links" else StringType()) for c in ("url", "title", "body", "date_text", "image_url", "outbound_links")])
_PICTURE = re.compile(r"url\(['\"]?([^'\")]+)")


class _Preview(HTMLParser):
    """Events of a preview page in order: (post, name), (text, part), (link, address), (date, time), (picture, address)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str]] = []
        self.open_divs, self.text_div = 0, 0  # divs that are open, and which of them is the text's, 0 for none

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        classes = a.get("class", "").split()
        self.open_divs += tag == "div"
        if "/" in a.get(POST_ATTRIBUTE, ""):
            self.events.append(("post", a[POST_ATTRIBUTE]))
        if tag == "div" and TEXT_CLASS in classes and not self.text_div:
            self.text_div = self.open_divs
        if tag == "time" and a.get("datetime"):
            self.events.append(("date", a["datetime"]))
        if not {*PICTURE_CLASSES}.isdisjoint(classes) and (found := _PICTURE.search(a.get("style", ""))):
            self.events.append(("picture", found[1]))
        if self.text_div and tag == "br":
            self.events.append(("text", "\n"))
        if self.text_div and tag == "a":
            self.events.append(("link", a.get("href", "").strip()))

    def handle_endtag(self, tag):
        if tag == "div":
            self.text_div = 0 if self.text_div == self.open_divs else self.text_div
            self.open_divs -= 1

    def handle_data(self, data):
        if self.text_div:
            self.events.append(("text", data))


def read_posts(html: str | None) -> list[dict]:
    """Posts with a text, newest (last on the page) first. The title is the first line, of three characters or more; the first
    date and the first picture count; links to the site itself don't."""
    page = _Preview()
    page.feed(html or "")
    posts: list[dict[str, list[str]]] = []
    for kind, value in page.events:
        if kind == "post":
            posts.append({"post": [value], "text": [], "link": [], "date": [], "picture": []})
        elif posts:
            posts[-1][kind].append(value)
    out = []
    for p in posts[::-1]:
        lines = [x for x in map(str.strip, "".join(p["text"]).splitlines()) if x]
        if lines and len(lines[0]) >= LEAST_TITLE:
            links = {u: None for u in p["link"] if re.match("https?://", u) and HOST not in u}
            out.append({"url": f"https://{HOST}{p['post'][0]}", "title": lines[0][:MOST_TITLE].strip(), "body": "\n".join(lines), "date_text": next(iter(p["date"]), None), "image_url": next(iter(p["picture"]), None), "outbound_links": [*links]})
    return out


def channel_posts(pages: DataFrame, most: int = 15) -> DataFrame:
    """The newest posts of each preview page (url, html): source_url, pos, url, title, body, published_at, image_url, outbound_links."""
    schema = StructType([StructField("source_url", StringType()), StructField("posts", ArrayType(_POST))])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"source_url": b["url"], "posts": [read_posts(h)[:most] for h in b["html"]]})

    x = pages.select("url", "html").mapInPandas(read, schema).select("source_url", F.posexplode("posts").alias("pos", "p"))
    return x.select("source_url", "pos", "p.*").withColumn("published_at", parsed(F.col("date_text"))).drop("date_text")
