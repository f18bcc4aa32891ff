"""More queries of the catalogue: what stays from run to run, chained calls, and ways from feeds and index pages to articles."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, rules, text, udtfs, urls
from ..operators import budget, components, dedup, reports, stats
from ..operators.title_index import TitleIndex
from ..sources import discovery, edits, sinks, tables
from ..sources.state import Store
from ..storage import cut, shared_dir
from ..streaming.articles import sessions
from . import calls
from .catalog import _ARTICLES, _CANON, NOW, SQL, articles, query, table
from .catalog_rules import _previews

LATER = datetime(2024, 2, 1)


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/newsweir-{name}-{uuid.uuid4().hex}"


def _marks(pages: DataFrame, portal: str, at: datetime, cached) -> DataFrame:
    x = pages.select(urls.url_hash(F.col("url")).alias("url_hash"), urls.canonical(F.col("url")).alias("canonical_url"), F.concat(F.lit("page "), "page_id").alias("title"), "page_id")
    x = x.groupBy("url_hash").agg(F.min_by(F.struct("canonical_url", "title", "page_id"), "page_id").alias("p")).select("url_hash", "p.*")
    return x.select(
        "url_hash", "canonical_url", "title", F.lit(None).cast("timestamp").alias("published_at"), F.lit(at).alias("first_seen_at"), F.lit(at).alias("last_seen_at"), F.lit("e.com").alias("source_domain"), F.lit(portal).alias("portal"),
        cached.alias("cached_row_json"),
    )


@query(
    f"WITH {_CANON}, h AS (SELECT sha256(canonical_url) AS url_hash, page_id FROM c), one AS (SELECT url_hash, min(page_id) AS p FROM h WHERE page_id % 2 = 0 GROUP BY 1), two AS (SELECT url_hash, min(page_id) AS p FROM h WHERE page_id % 3 = 0 GROUP BY 1) "
    "SELECT coalesce(one.url_hash, two.url_hash) AS url_hash, 'page ' || coalesce(one.p, two.p) AS title, CASE WHEN one.p IS NOT NULL THEN 'RU' ELSE 'KZ' END AS portal, CASE WHEN one.p IS NOT NULL THEN TIMESTAMP '2024-01-31' ELSE TIMESTAMP '2024-02-01' END AS first_seen_at, "
    "CASE WHEN two.p IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-31' END AS last_seen_at, CASE WHEN two.p % 9 = 0 THEN 'new' WHEN one.p % 4 = 0 THEN 'old' END AS cached_row_json, CASE WHEN one.p IS NOT NULL THEN 'one' ELSE 'two' END AS run "
    "FROM one FULL JOIN two ON one.url_hash = two.url_hash"
)
def state_two_runs(spark, d):
    """The state after two runs that were committed, the second one twice, and the run that published each URL."""
    pages, store = table(spark, d, "pages"), Store(spark, _folder(spark, "store"), digits=1)

    def made(part: str, portal: str, at: datetime, cached) -> dict[str, DataFrame]:
        marks = _marks(pages.where(part), portal, at, cached)
        new = dedup.unseen(marks, store.seen_of(marks)).select("url_hash")
        return {"rows": new, "marks": marks, "summary": new.agg(F.count("*").alias("written"))}

    store.commit("one", lambda: made("page_id % 2 = 0", "RU", NOW, F.when(F.col("page_id") % 4 == 0, "old")))
    for _ in range(2):
        store.commit("two", lambda: made("page_id % 3 = 0", "KZ", LATER, F.when(F.col("page_id") % 9 == 0, "new")))
    return store.seen().join(store.rows(), "url_hash").select("url_hash", "title", "portal", "first_seen_at", "last_seen_at", "cached_row_json", "run")


@query(
    "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events WHERE ts IS NOT NULL), "
    "s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 12 HOUR AS \"end\", count(*) AS n FROM s GROUP BY user_id, k"
)
def event_sessions(spark, d):
    return sessions(table(spark, d, "events").where("ts is not null"), "user_id", "ts", "12 hours")


@query(
    f"WITH {_CANON}, x AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN path WHEN 1 THEN substr(path, 2) ELSE 'mailto:p' || page_id || '@e.com' END AS u FROM c), "
    "y AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://' || u WHEN 1 THEN 'https:' || u ELSE u END AS canonical_url FROM x WHERE u <> '') SELECT min(page_id) AS page_id, canonical_url FROM y GROUP BY canonical_url"
)
def candidates_without_host(spark, d):
    """Links without a host are candidates of their own, each once."""
    path, k = urls.part(F.col("url"), 3), F.col("page_id") % 3
    u = F.when(k == 0, path).when(k == 1, F.substring(path, 2, 10**6)).otherwise(F.concat(F.lit("mailto:p"), "page_id", F.lit("@e.com")))
    x = table(spark, d, "pages").select("page_id", F.col("page_id").alias("seq"), u.alias("url"), F.lit("t").alias("title"), F.lit(None).cast("timestamp").alias("published_at"))
    return dedup.fresh_candidates(x, 48, NOW).select("page_id", "canonical_url")


_SECTIONS, _SHOTS, _COUNTRY = [("Market", "sales"), ("Tech", "new things")], [("Market", "Sales rise"), ("Tech", "A new engine")], "Country"
_H = "substr(sha256({}), 1, 16)"
_LF = " || chr(10) || "
_K1 = _H.format(_LF.join(["'relevance'", "title", "substr(body, 1, 500) || chr(10)"]))
_K2 = _H.format(_LF.join(["'section'", "'Country'", "'- Market: sales' || chr(10) || '- Tech: new things'", "'[Market] Sales rise' || chr(10) || '[Tech] A new engine'", "title", "substr(body, 1, 4000) || chr(10)"]))
_K3 = _H.format(_LF.join(["'titles'", "title", "coalesce(lang, '') || chr(10)"]))
_CALLS = (
    f"WITH {_ARTICLES}, k AS (SELECT seq, {_K1} AS k1, {_K2} AS k2, {_K3} AS k3 FROM a), "
    "r1 AS (SELECT k1, min(seq % 3 > 0) AS relevant FROM k WHERE seq % 5 > 0 GROUP BY 1), r2 AS (SELECT k2, min(CASE WHEN seq % 2 = 0 THEN 'Market' ELSE 'Weather' END) AS section FROM k WHERE seq % 7 > 0 GROUP BY 1), r3 AS (SELECT k3, min('T' || seq) AS title_en FROM k WHERE seq % 11 > 0 GROUP BY 1), "
    "j AS (SELECT k.*, relevant, section, title_en FROM k LEFT JOIN r1 USING (k1) LEFT JOIN r2 USING (k2) LEFT JOIN r3 USING (k3)) "
)


def _chained(spark, d) -> DataFrame:
    """Articles with the answers of replay tables that lack some keys."""
    x = articles(spark, d).withColumn("verdict", F.lit("possible_news"))
    k = calls.keys(F.col("title"), F.col("body"), F.col("source_language"), _SECTIONS, _SHOTS, _COUNTRY)
    no = F.lit(None).cast("string").alias("error")
    s = F.col("seq")
    answers = {
        "relevance": x.where(s % 5 > 0).select(k["relevance"].alias("key"), (s % 3 > 0).alias("relevant"), F.lit(4.0).alias("cost"), no),
        "section": x.where(s % 7 > 0).select(k["section"].alias("key"), F.when(s % 2 == 0, "Market").otherwise("Weather").alias("section"), F.lit("Local").alias("region"), F.lit(0.5).alias("confidence"), F.lit(2.0).alias("cost"), no),
        "titles": x.where(s % 11 > 0).select(k["titles"].alias("key"), F.concat(F.lit("T"), s).alias("title_en"), F.lit("RU").alias("title_ru"), F.lit("EN").alias("language"), F.lit(1.0).alias("cost"), no),
    }
    # neither bodies nor answers' other columns are written or shuffled: keys are made where the articles are read
    return cut(calls.chained(x, answers, _SECTIONS, _SHOTS, _COUNTRY).select("seq", "verdict", "section", "title_en", "cost", "calls", "pending"), "chained")


@query(
    _CALLS + "SELECT seq, CASE WHEN relevant THEN 'certain_news' WHEN NOT relevant THEN 'rejected' ELSE 'possible_news' END AS verdict, CASE WHEN relevant THEN CASE section WHEN 'Weather' THEN 'Other news' ELSE section END END AS section, "
    "CASE WHEN relevant AND section IS NOT NULL THEN title_en END AS title_en, (CASE WHEN relevant IS NULL THEN 0 WHEN NOT relevant THEN 4 WHEN section IS NULL THEN 4 WHEN title_en IS NULL THEN 6 ELSE 7 END)::DOUBLE AS cost FROM j"
)
def calls_promoted(spark, d):
    return _chained(spark, d).select("seq", "verdict", "section", "title_en", "cost")


@query(
    _CALLS + "SELECT call, key, min(seq) AS seq FROM (SELECT seq, CASE WHEN relevant IS NULL THEN 'relevance' WHEN relevant AND section IS NULL THEN 'section' WHEN relevant AND title_en IS NULL THEN 'titles' END AS call, "
    "CASE WHEN relevant IS NULL THEN k1 WHEN relevant AND section IS NULL THEN k2 WHEN relevant AND title_en IS NULL THEN k3 END AS key FROM j) WHERE call IS NOT NULL GROUP BY call, key"
)
def calls_pending(spark, d):
    return calls.requests(_chained(spark, d))


_SPENT = _CALLS + (
    ", p AS (SELECT seq, unnest(CASE WHEN relevant IS NULL THEN [] WHEN NOT relevant OR section IS NULL THEN [4] WHEN title_en IS NULL THEN [4, 2] ELSE [4, 2, 1] END) AS cost, unnest(CASE WHEN relevant IS NULL THEN [] WHEN NOT relevant OR section IS NULL THEN [1] WHEN title_en IS NULL THEN [1, 2] ELSE [1, 2, 3] END) AS step FROM j), "
    "s AS (SELECT *, sum(cost) OVER (ORDER BY seq, step) AS spent FROM p), cap AS (SELECT sum(cost) / 2 AS cap FROM p)"
)


@query(_SPENT + " SELECT seq, step::INT AS step, spent::DOUBLE AS spent FROM s, cap WHERE spent - cost <= cap")
def calls_charged(spark, d):
    """The calls that half of what all would cost pays for, the one that breaks the cap included."""
    x = _chained(spark, d)
    return budget.charged(x, x.agg(F.sum("cost") / 2).first()[0], ["seq"]).select("seq", "step", "spent")


@query(_SPENT + ", w AS (SELECT j.seq, sum(coalesce(c, 0)) OVER (ORDER BY j.seq) AS upto FROM j LEFT JOIN (SELECT seq, sum(cost) AS c FROM p GROUP BY seq) q USING (seq)) SELECT seq FROM w, cap WHERE upto <= cap")
def calls_whole(spark, d):
    """The articles all of whose calls half of what all would cost pays for."""
    x = _chained(spark, d)
    return budget.whole_within(x, x.agg(F.sum("cost") / 2).first()[0], ["seq"]).select("seq")


@query(
    "WITH l AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents WHERE source IS NOT NULL), g AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rank) AS k FROM l WHERE rank <= 12 AND doc_id % 3 > 0) "
    "SELECT source AS source_url, k::INT AS rank, 'https://' || source || '.example.com/news/' || doc_id AS url, doc_id FROM g WHERE k <= 4"
)
def index_articles(spark, d):
    """The first four articles of index pages made of all documents, of twelve links each, of which a third fails."""
    x = table(spark, d, "documents").where("source is not null")
    url = F.concat(F.lit("https://"), "source", F.lit(".example.com/news/"), "doc_id")
    link = F.concat(F.lit('<p><a class="x" href="../news/'), "doc_id", F.lit('#top">a</a><a href="../news/'), "doc_id", F.lit('">b</a><a href="https://other.org/news/1">c</a>'))
    page = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", link.alias("l")))), lambda s: s["l"]), "")
    index = x.groupBy("source").agg(page.alias("html")).select(F.concat(F.lit("https://"), "source", F.lit(".example.com/index/all.html")).alias("url"), "html")
    got = discovery.index_articles(index, x.where("doc_id % 3 > 0").select(url.alias("url"), "doc_id"), 4, ["/news/"])
    return got.select(urls.netloc(F.col("source_url")).alias("h"), "rank", "url", "doc_id").select(F.substring_index("h", ".", 1).alias("source_url"), "rank", "url", "doc_id")


@query(
    "WITH i AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos FROM documents WHERE source IS NOT NULL) "
    "SELECT source || '.xml' AS source_url, 'https://e.com/' || doc_id AS url, 'item ' || doc_id AS title, CASE doc_id % 3 WHEN 1 THEN TIMESTAMP '2024-01-02 03:04:05' WHEN 2 THEN TIMESTAMP '2024-01-03 00:00:00' END AS published_at FROM i WHERE pos <= 6 AND doc_id % 4 > 0"
)
def feed_files(spark, d):
    """Feeds written of all documents, one a source, read again and joined with captured pages that have no date."""
    x = table(spark, d, "documents").where("source is not null")
    when = F.when(F.col("doc_id") % 3 == 1, "<pubDate>Tue, 02 Jan 2024 06:04:05 +0300</pubDate>").when(F.col("doc_id") % 3 == 2, "<pubDate>soon</pubDate><updated>2024-01-03</updated>").otherwise("")
    item = F.concat(F.lit("<item><title>item "), "doc_id", F.lit("</title><link>https://e.com/"), "doc_id", F.lit("</link>"), when, F.lit("</item>"))
    base = _folder(spark, "feeds")
    xml = x.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("i")))), lambda s: s["i"]), "\n").alias("items"))
    xml.select("source", F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>")).alias("value")).repartition("source").write.partitionBy("source").text(base)
    names = spark.read.text(f"{base}/*/*.txt").select(F.col("_metadata.file_path").alias("file"), F.concat(F.regexp_extract("_metadata.file_path", "source=([^/]*)/", 1), F.lit(".xml")).alias("source_url")).distinct()
    items = tables.feed_items(spark, f"{base}/*/*.txt", names=names)
    pages = x.where("doc_id % 4 > 0").select(F.concat(F.lit("https://e.com/"), "doc_id").alias("url"), F.lit("").alias("title"), F.col("text").alias("body"), F.lit(None).cast("timestamp").alias("published_at"))
    return discovery.feed_articles(items, pages, 6).select("source_url", "url", "title", "published_at")


@query("SELECT page_id AS row_id, CASE WHEN page_id % 7 = 3 THEN 'b' WHEN page_id % 7 = 2 THEN 'a' ELSE url END AS title, 3 AS version FROM pages WHERE page_id % 5 > 0 AND NOT (page_id % 3 = 0 AND page_id % 2 = 0)")
def rows_edited(spark, d):
    """A table after deletes and corrections in two versions, the second of which was written from the first with its edits."""
    x, base = table(spark, d, "pages").select(F.col("page_id").alias("row_id"), F.col("url").alias("title")), _folder(spark, "table")
    sinks.write_version(x, base)
    edits.delete_rows(x.where("row_id % 5 = 0"), base)
    edits.delete_rows(x.where("row_id % 10 = 0").select("row_id", F.lit("again").alias("reason")), base)
    edits.patch_rows(x.where("row_id % 7 in (2, 3)").select("row_id", F.lit("a").alias("title")), base)
    edits.patch_rows(x.where("row_id % 7 in (3, 4)").select("row_id", F.when(F.col("row_id") % 7 == 3, "b").alias("title")), base)
    edits.compact(spark, base)
    edits.delete_rows(x.where("row_id % 6 = 0"), base)
    n = edits.compact(spark, base)
    return edits.read_live(spark, base).withColumn("version", F.lit(n))


@query(f"WITH {_ARTICLES} SELECT seq AS id, min(seq) OVER (PARTITION BY title) AS component FROM a WHERE title IN (SELECT title FROM a GROUP BY title HAVING count(*) > 1)")
def components_grown(spark, d):
    """Articles linked to the next one of their title, in three runs of which each adds its links to the components so far."""
    x = articles(spark, d).select("seq", "title")
    e = x.select("seq", F.lag("seq").over(Window.partitionBy("title").orderBy("seq")).alias("before")).where("before is not null").select(F.col("before").alias("a"), F.col("seq").alias("b"), (F.col("seq") % 3).alias("k"))
    e = cut(e, "links")  # each run would shuffle the titles again
    stars = components.components(e.where("k = 0"))
    for k in (1, 2):
        stars = cut(components.grown(stars, e.where(F.col("k") == k)), "stars")
    return stars


@query()
def title_index(spark, d):
    """Titles of the odd documents against an index that the even ones were added to in two parts."""
    x = articles(spark, d).select("seq", "title")
    index = TitleIndex(spark, _folder(spark, "index"), f"titles_{uuid.uuid4().hex[:12]}", 16)
    index.begin(x.where("seq % 2 = 0").select("title"))
    for k in (0, 2):
        index.add(x.where(F.col("seq") % 4 == k).select("title"))
    found = index.pairs(x.where("seq % 2 = 1").select("title"), 85.0)  # a written table
    index.forget()
    return found


@query(f"WITH {_ARTICLES} SELECT trim(source) AS name, trim(coalesce(lang, '')) AS description, count(*) AS n FROM a WHERE trim(source) <> '' GROUP BY 1, 2")
def section_table(spark, d):
    tab = articles(spark, d).select(F.concat(F.lit(" "), "source_name").alias("Name"), F.concat(F.coalesce("source_language", F.lit("")), F.lit(" ")).alias("Description"))
    return tables.sections(tab).groupBy("name", "description").agg(F.count("*").alias("n"))


@query(f"WITH {_ARTICLES} SELECT title, count(*) AS n FROM (SELECT title FROM a WHERE title <> '' UNION ALL SELECT trim(source) FROM a WHERE trim(source) <> '') GROUP BY title")
def titles_of_tabs(spark, d):
    x = articles(spark, d)
    return tables.titles(x.select("seq", F.col("title").alias("Название")), x.select(F.col("source_name").alias("Name"))).groupBy("title").agg(F.count("*").alias("n"))


_PATHS = ", ".join(f"'{p}'" for p in discovery.FEED_PATHS)


@query(f"WITH {_CANON}, x AS (SELECT page_id, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) AS root FROM c) SELECT page_id, unnest([root || p FOR p IN [{_PATHS}]]) AS feed FROM x")
def feed_candidates(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(discovery.feed_candidates(F.col("url"))).alias("feed"))


@query("WITH b AS (SELECT event_type, event_id, 'n' || event_id AS title FROM events) SELECT event_type, event_id AS ord, title FROM b UNION ALL SELECT DISTINCT event_type, -1, '— ' || event_type FROM b")
def feed_prepended(spark, d):
    x = table(spark, d, "events").select("event_type", F.col("event_id").alias("ord"), F.concat(F.lit("n"), "event_id").alias("title"))
    return reports.prepended(x, "event_type")


@query(f"WITH {_ARTICLES} SELECT seq, title AS ask FROM a WHERE title <> ''")
def titles_asked_again(spark, d):
    x = articles(spark, d).where("title <> ''")
    said = text.combined_title(F.col("title"), F.col("source_name"), F.upper("source_language"), 400)
    return reports.answered_titles(x.select("seq", said.alias("title"))).select("seq", "ask")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31' - to_hours(CASE WHEN event_id % 2 = 0 THEN 24 ELSE 72 END)")
def freshness_asked(spark, d):
    """Fresh events by the span that was asked for, or by the default."""
    x = table(spark, d, "events").where("ts is not null")
    of = lambda k, asked: x.where(F.col("event_id") % 2 == k).where(dates.is_fresh(F.col("ts"), dates.hours_or(asked, 24), NOW)).select("event_id")
    return of(0, 0).unionByName(of(1, 72))


@query(
    f"WITH {_ARTICLES}, t AS (SELECT CASE WHEN title <> '' THEN length(title) END AS n, CASE WHEN seq % 3 > 0 AND body <> '' THEN length(trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))) END AS b FROM a) "
    "SELECT count(*) AS n, coalesce(round_even(avg(n), 0), 0)::BIGINT AS title, coalesce(round_even(avg(b), 0), 0)::BIGINT AS bullets FROM t"
)
def mean_lengths(spark, d):
    """Mean lengths of titles and of bodies as lists of bullets, where there are some."""
    bullets = F.when(F.col("seq") % 3 > 0, F.concat(F.lit("<ul><li>"), F.when(F.col("body") != "", F.col("body")), F.lit("</li></ul>")))
    return stats.mean_lengths(articles(spark, d), title=F.col("title"), bullets=bullets)


_SAID = ["Новость", "новость, но не по теме", "Не новость", "это точно новость!", "", "не по теме", "новость не по тематике", "?"]


@query(
    "SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'news_in_topic' WHEN 1 THEN 'news_off_topic' WHEN 2 THEN 'not_news' WHEN 3 THEN 'news_in_topic' WHEN 5 THEN 'news_off_topic' WHEN 6 THEN 'news_in_topic' ELSE '' END AS label, event_id % 2 = 0 AS is_article FROM events"
)
def labels_compared(spark, d):
    """Labels by what people's answers contain, beside the reader of review tabs."""
    said = F.element_at(F.lit(_SAID), (F.col("event_id") % len(_SAID) + 1).cast("int"))
    tab = table(spark, d, "events").select(F.col("event_id").cast("string").alias("URL"), F.when(F.col("event_id") % 2 == 0, "Новость ").otherwise("нет").alias("Статья"), said.alias("Проверка"))
    x = tables.labels(tab, {"article": "статья", "human": "проверка"})
    return x.select(F.col("url").cast("long").alias("event_id"), rules.human_label(F.col("said"), exact=False).alias("label"), "is_article")


@query(f"WITH {_CANON} SELECT page_id, regexp_replace(host, '^(?:www|m|amp)\\.', '') IN ('example.com') OR ends_with(host, '.example.com') AS insecure FROM c")
def pages_insecure(spark, d):
    return table(spark, d, "pages").select("page_id", discovery.insecure(F.col("url"), ["www.example.com"]).alias("insecure"))


@query(SQL["channel_previews"])
def channel_previews_lateral(spark, d):
    """The posts of channel_previews by a table function in SQL."""
    udtfs.register(spark)
    return spark.sql("SELECT p.url AS source, pos, x.url, title, body FROM {pages} AS p, LATERAL channel_posts(p.html, 15) AS x", pages=_previews(spark, d))


@query(SQL["html_title"])
def html_title_lateral(spark, d):
    return udtfs.articles(table(spark, d, "pages")).select("page_id", "title")
