"""Reading sources, sections, few-shots, titles, feeds and run files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import parsed
from ..functions.rules import human_label
from ..functions.text import truthy
from ..functions.urls import strip


def read_tab(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header, all cells trimmed text, missing ones empty; an empty table if the path isn't there."""
    try:
        x = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        x = spark.createDataFrame([], schema)
    return x.select(*[F.coalesce(strip(F.col(f"`{c}`")), F.lit("")).alias(c) for c in x.columns])


def _column(df: DataFrame, *names: str) -> Column:
    """The first of several columns that the table has, else empty text."""
    have = {c.lower(): c for c in df.columns}
    found = next((have[n.lower()] for n in names if n.lower() in have), None)
    return F.col(f"`{found}`") if found else F.lit("")


def sources(tab: DataFrame, columns: dict[str, str], others: list[str] = ()) -> DataFrame:
    """name, url, type (rss or html), is_active, requires_js, language of the rows with a URL, and `others` as they stand.
    `columns` gives the header of each field. A blank flag of activity is true, a blank name is the URL."""
    c = lambda k: strip(_column(tab, columns.get(k, k)))
    kind = F.when(F.lower(c("type")) == "rss", "rss").otherwise("html")
    x = tab.select(
        F.coalesce(F.nullif(c("name"), F.lit("")), c("url")).alias("name"), c("url").alias("url"), kind.alias("type"),
        truthy(F.coalesce(F.nullif(c("is_active"), F.lit("")), F.lit("true"))).alias("is_active"), truthy(c("requires_js")).alias("requires_js"), F.nullif(c("language"), F.lit("")).alias("language"), *others,
    )
    return x.where("url <> ''")


def active_sources(tab: DataFrame, limit: int = 400, flag: str = "is_active", url: str = "url") -> DataFrame:
    """The first `limit` rows by seq whose flag isn't 0 and whose URL starts with http."""
    return tab.where((strip(_column(tab, flag)) != "0") & _column(tab, url).rlike("^https?://")).orderBy("seq").limit(limit)


def overridden(found: DataFrame, overrides: DataFrame) -> DataFrame:
    """Sources with the first override (ord, prefix, rss_url, requires_js) whose prefix starts their URL and that changes
    something; a feed URL makes the type rss."""
    o = overrides.where("rss_url is not null or requires_js is not null").select("ord", "prefix", F.col("rss_url").alias("o_rss"), F.col("requires_js").alias("o_js"))
    # a prefix holds its host, so sources and overrides meet on it
    host = lambda c: F.regexp_extract(c, "^(https?://[^/]*)", 1)
    x = found.select("url", host(F.col("url")).alias("h")).distinct().join(o.withColumn("h", host(F.col("prefix"))), "h").where(F.startswith("url", "prefix"))
    best = x.groupBy("url").agg(F.min_by(F.struct("o_rss", "o_js"), "ord").alias("o"))
    y = found.join(best, "url", "left")
    return y.withColumns({"type": F.when(F.col("o.o_rss").isNotNull(), "rss").otherwise(F.col("type")), "requires_js": F.coalesce("o.o_js", "requires_js"), "feed_url": F.col("o.o_rss")}).drop("o")


def sections(tab: DataFrame) -> DataFrame:
    """name, description of the rows with a name; without such headers the first two columns."""
    first, second = [*tab.columns, *[None, None]][:2]
    name = _column(tab, "name") if "name" in map(str.lower, tab.columns) else F.col(f"`{first}`")
    about = _column(tab, "description") if "description" in map(str.lower, tab.columns) else F.col(f"`{second}`") if second else F.lit("")
    return tab.select(strip(name).alias("name"), strip(about).alias("description")).where("name <> ''")


def few_shots(tab: DataFrame, most: int = 3) -> DataFrame:
    """The first rows by seq of each section: seq, section, title, region (Local, Global or null), sections in order of their first row."""
    region = F.initcap(strip(_column(tab, "region", "регион")))
    x = tab.select("seq", strip(_column(tab, "section", "раздел")).alias("section"), strip(_column(tab, "title", "название")).alias("title"), F.when(region.isin("Local", "Global"), region).alias("region"))
    x = x.where("section <> '' and title <> ''")
    w = Window.partitionBy("section")
    x = x.withColumns({"k": F.row_number().over(w.orderBy("seq")), "first": F.min("seq").over(w)}).where(F.col("k") <= most)
    return x.orderBy("first", "seq").drop("k", "first")


def labels(tab: DataFrame, columns: dict[str, str], article: str = "Новость", topic: str = "Авто/эконом") -> DataFrame:
    """url, title, is_article, on_topic, verdict, said, label of a tab that people reviewed. `columns` gives the header of url,
    title, article, topic, verdict and human; `article` and `topic` are the cells that mean yes (fixed values)."""
    c = lambda k: strip(_column(tab, columns.get(k, k)))
    return tab.select(
        c("url").alias("url"), c("title").alias("title"), (c("article") == article).alias("is_article"), (c("topic") == topic).alias("on_topic"), c("verdict").alias("verdict"), c("human").alias("said"),
        human_label(c("human")).alias("label"),
    )


def titles(*tabs: DataFrame) -> DataFrame:
    """All titles that aren't blank, copies included, of several tables: each by the first of its headers name, title, название."""
    parts = [t.select(strip(_column(t, "name", "title", "название")).alias("title")).where("title <> ''") for t in tabs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def feed_items(spark: SparkSession, path: str, row: str = "item", names: DataFrame | None = None) -> DataFrame:
    """source_url, pos, title, link, published_text of the items of feeds (`entry` for Atom), by the XML reader, as
    `discovery.feed_articles` takes them.

    A feed is a file; `names` (file, source_url) gives its source by the file's whole path, which stands for it else. pos counts within the
    file. A link is the text of its element, or the address of one that isn't to another form of the item; null if there is none, as such items count among the
    first of a feed. The date is the first of
    published, updated and created that can be read."""
    link = "array<struct<_VALUE: string, _href: string, _rel: string>>"
    x = spark.read.format("xml").option("rowTag", row).schema(f"title string, link {link}, pubDate string, published string, updated string, created string").load(path)
    good = F.filter("link", lambda a: F.coalesce(a["_rel"], F.lit("alternate")) == "alternate")
    address = F.get(F.filter(F.transform(good, lambda a: F.coalesce(F.nullif(strip(a["_VALUE"]), F.lit("")), strip(a["_href"]))), lambda a: a != ""), F.lit(0))
    told = ["published", "pubDate", "updated", "created"]
    when = F.coalesce(*[F.when(parsed(F.col(c)).isNotNull(), F.col(c)) for c in told], *told)
    x = x.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_at"), strip(F.col("title")).alias("title"), address.alias("link"), when.alias("published_text"))
    x = x.withColumn("pos", F.row_number().over(Window.partitionBy("file").orderBy("_at")).cast("long"))
    if names is not None:
        x = x.join(names.select("file", "source_url"), "file", "left")
    source = F.coalesce("source_url", "file") if names is not None else F.col("file")
    return x.select(source.alias("source_url"), "pos", "title", "link", "published_text")


def merged_runs(spark: SparkSession, path: str, key: str = "sheet_row") -> DataFrame:
    """JSON records of several run files, one per key: that of the last file by name. Records without a key, or with 0, go."""
    x = spark.read.option("multiLine", True).json(path).withColumns({"_file": F.input_file_name(), "_place": F.monotonically_increasing_id()})  # of one file the last record
    x = x.where(F.coalesce(F.col(key).cast("long"), F.lit(0)) != 0)
    return x.groupBy(key).agg(F.max_by(F.struct(*[c for c in x.columns if c not in (key, "_file", "_place")]), F.struct("_file", "_place")).alias("r")).select(key, "r.*")


def source_counts(found: DataFrame, portal: str = "portal") -> DataFrame:
    """Sources, active ones, and active ones by type for each portal."""
    on = F.col("is_active")
    return found.groupBy(portal).agg(F.count("*").alias("total"), F.count_if(on).alias("active"), F.count_if(on & (F.col("type") == "rss")).alias("rss"), F.count_if(on & (F.col("type") == "html")).alias("html"))
