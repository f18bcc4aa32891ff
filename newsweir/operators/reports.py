"""Rows of reports: articles, sources, cached verdicts, and the figures of panels and reviews."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.urls import canonical, domain, strip, url_hash

#: Tags of languages in titles, for the English and for the Russian line (fixed values).
TAGS = {
    "en": ("EN", "АНГЛ"), "ru": ("RU", "РУС"), "de": ("DE", "НЕМ"), "fr": ("FR", "ФР"), "it": ("IT", "ИТАЛ"), "es": ("ES", "ИСП"), "zh": ("ZH", "КИТ"), "ja": ("JA", "ЯП"),
    "ko": ("KO", "КОР"), "pl": ("PL", "ПОЛ"), "pt": ("PT", "ПОР"), "nl": ("NL", "НИД"), "cs": ("CS", "ЧЕШ"), "tr": ("TR", "ТУР"), "uk": ("UK", "УКР"),
}
#: A section whose rows are published as inactive, and how (fixed values).
INACTIVE, INACTIVE_MARK = "Test-drive", " (неактивный)"
CACHED_MARK = "из кэша"


def tags(language: Column) -> tuple[Column, Column]:
    """The tags of a language, by its first two letters; the letters in upper case if it has none, empty for null."""
    code = F.substring(F.lower(strip(F.coalesce(language, F.lit("")))), 1, 2)
    of = lambda k: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for c, t in TAGS.items() for x in (c, t[k])]), code), F.upper(code))
    return of(0), of(1)


def percent(n: Column, total: Column) -> Column:
    """n of total with one decimal and a percent sign, empty without a total."""
    return F.when(total > 0, F.concat(F.format_number(100 * n / total, 1), F.lit("%"))).otherwise("")


def report_title(title: Column, en: Column, ru: Column, language: Column) -> Column:
    """Both lines with their tags if there are both, else the title with the English tag."""
    e, r = tags(language)
    tagged = lambda x, t: F.concat(x, F.when(t != "", F.concat(F.lit(" ("), t, F.lit(")"))).otherwise(""))
    there = lambda x: F.coalesce(x, F.lit("")) != ""
    both = F.concat(F.lit("EN: "), tagged(F.substring(en, 1, 220), e), F.lit("\nRU: "), tagged(F.substring(ru, 1, 220), r))
    return F.when(there(en) & there(ru), both).when(there(title), tagged(F.substring(title, 1, 400), e)).otherwise("")


def article_report(rows: DataFrame, run_at: Column, country: Column) -> DataFrame:
    """The 28 columns of the batch report, in order, of graded articles with a model's answers and a primary source."""
    c, blank = F.col, lambda x: F.coalesce(x.cast("string"), F.lit(""))
    hits = F.substring(F.array_join("samples", ", "), 1, 180)
    topic = F.when(c("on_topic"), "авто/эконом").otherwise("не авто")
    return rows.select(
        run_at.alias("run_at"), report_title(c("title"), c("title_en"), c("title_ru"), c("source_language")).alias("title"), F.substring(F.replace(strip(blank(c("body"))), F.lit("\n\n"), F.lit("\n")), 1, 300).alias("lede"), c("url"),
        F.when(c("section") == INACTIVE, F.concat("section", F.lit(INACTIVE_MARK))).otherwise(blank(c("section"))).alias("section"), blank(c("region")).alias("region"), country.alias("country"), "published_at", blank(c("image_url")).alias("image_url"),
        "primary_domain", "primary_url", "primary_confidence", blank(c("note")).alias("note"), "confidence", "verdict", F.lit("").alias("manual_check"), F.lit("").alias("comment"),
        "source_url", "source_idx", "article_idx", F.length(blank(c("body"))).alias("body_length"), F.when(c("is_article"), "Да").otherwise("Нет").alias("is_article"), "score", F.substring(F.array_join("reasons", ", "), 1, 400).alias("reasons"),
        F.when(hits != "", F.concat(topic, F.lit(": "), hits)).otherwise(topic).alias("topic"), blank(c("relevant")).alias("relevance"), F.col("cost"), blank(c("primary_method")).alias("primary_method"),
    )


def source_report(rows: DataFrame, run_at: Column, most: int = 3) -> DataFrame:
    """The 18 columns of the report on sources, from their attempted articles (source_idx, source_url, kind, feed_url, status,
    error, elapsed_ms, and of the article seq, title, body, published_at, image_url, news_like, is_article, on_topic)."""
    has = lambda x: F.coalesce(F.col(x).cast("string"), F.lit("")) != ""
    passed = F.col("is_article") & F.col("on_topic")
    w = Window.partitionBy("source_idx").orderBy("seq")
    nth = lambda on: F.when(on, F.sum(on.cast("int")).over(w))
    x = rows.withColumns({"_t": nth(has("title")), "_p": nth(has("title") & passed)})
    first = lambda k: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(k) <= most, F.struct(F.col(k).alias("k"), F.substring("title", 1, 80).alias("t"))))), lambda s: s["t"]), " | ")
    same = lambda c: F.min(c).alias(c)
    return x.groupBy("source_idx").agg(
        same("source_url"), same("kind"), same("feed_url"), F.min(F.col("status").cast("string")).alias("status"), F.count("seq").alias("attempted"), F.count_if(has("title")).alias("with_title"), F.count_if(has("body")).alias("with_body"),
        F.count_if(F.col("published_at").isNotNull()).alias("with_date"), F.count_if(has("image_url")).alias("with_image"), F.count_if("news_like").alias("news_like"), F.count_if("is_article").alias("articles"), F.count_if(passed).alias("passed"),
        F.max("elapsed_ms").alias("elapsed_ms"), same("error"), first("_t").alias("samples"), first("_p").alias("passed_samples"),
    ).select(run_at.alias("run_at"), "*")


def cache_entries(rows: DataFrame, portal: str, failed: list[str] = ("fetch_error", "extract_error")) -> DataFrame:
    """What a run remembers of its articles, as rows of the state: all with a URL but those that failed, which are to be tried
    again. The cached row is JSON; its note has no mark of an earlier cache."""
    cut = lambda c, n: F.substring(F.coalesce(c, F.lit("")), 1, n).alias(c)
    note = F.regexp_replace(F.replace(F.coalesce("note", F.lit("")), F.lit(CACHED_MARK), F.lit("")), r"^[ |]+|[ |]+$", "").alias("note")
    row = F.struct("verdict", "score", F.substring(F.array_join("reasons", ", "), 1, 300).alias("reasons"), "hits", "relevant", "section", "region", "confidence", cut("title_en", 300), cut("title_ru", 300), note, "primary_url", "primary_domain", "primary_confidence")
    x = rows.where((F.coalesce("url", F.lit("")) != "") & ~F.col("verdict").isin(list(failed)))
    u = canonical(F.col("url"))
    return x.select(url_hash(F.col("url")).alias("url_hash"), u.alias("canonical_url"), F.substring("title", 1, 500).alias("title"), "published_at", domain(u).alias("source_domain"), F.lit(portal).alias("portal"), F.to_json(row).alias("cached_row_json"))


def panel(rows: DataFrame, columns: dict[str, str], accepted: Column, section: str = "section", cost: str = "cost") -> DataFrame:
    """block, label, n, share of the statistics panel in one pass over the rows: `columns` (with the label of blanks) of all rows,
    sections of accepted ones without the mark of inactive ones; and the sum of all costs that are numbers, as text with a comma or a point."""
    blank = lambda c, say: F.coalesce(F.nullif(strip(F.col(c).cast("string")), F.lit("")), F.lit(say))
    marks = [F.struct(F.lit(c).alias("block"), blank(c, say).alias("label"), F.lit(0.0).alias("cost")) for c, say in columns.items()]
    sections = F.when(accepted, F.struct(F.lit("section").alias("block"), F.replace(blank(section, "(none)"), F.lit(INACTIVE_MARK), F.lit("")).alias("label"), F.lit(0.0).alias("cost")))
    money = F.struct(F.lit("cost").alias("block"), F.lit("sum").alias("label"), F.coalesce(F.replace(strip(F.col(cost).cast("string")), F.lit(","), F.lit(".")).try_cast("double"), F.lit(0.0)).alias("cost"))
    x = rows.select(F.explode(F.array_compact(F.array(*marks, sections, money))).alias("m")).groupBy("m.block", "m.label").agg(F.count("*").alias("n"), F.sum("m.cost").alias("cost"))
    total = F.sum("n").over(Window.partitionBy("block"))
    return x.withColumn("share", F.when(F.col("block") == "cost", F.format_string("%.4f", "cost")).otherwise(percent(F.col("n"), total))).select("block", "label", "n", "share")


def health_breakdown(sources: DataFrame, bucket: Column, host: Column) -> DataFrame:
    """bucket, n, share, domains (different ones, in order, one string) of the health of sources."""
    x = sources.select(bucket.alias("bucket"), host.alias("d"))
    x = x.groupBy("bucket").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("d")), " ").alias("domains"))
    return x.select("bucket", "n", percent(F.col("n"), F.sum("n").over(Window.partitionBy())).alias("share"), "domains")


def wrong(rows: DataFrame, predicted: Column, label: Column, most: int = 20) -> DataFrame:
    """kind, seq, title of the first `most` wrong decisions of each kind: false_news (people say it is none), off_topic (news of
    another topic) and missed (news of the topic that was turned down)."""
    kind = F.when(predicted & (label == "not_news"), "false_news").when(predicted & (label == "news_off_topic"), "off_topic").when(~predicted & (label == "news_in_topic"), "missed")
    x = rows.withColumn("kind", kind).where("kind is not null")
    return x.withColumn("k", F.row_number().over(Window.partitionBy("kind").orderBy("seq"))).where(F.col("k") <= most).select("kind", "seq", "title")


def version_summary(one: DataFrame, two: DataFrame, key: str, passing: str) -> DataFrame:
    """One row on two versions (key, verdict, and label of the first): common, changed, newly rejected that people call no news
    (fixed), news (worse) or nothing, and still passing that are no news or news. Of repeated keys the last by seq counts."""
    last = lambda d, c, n: d.groupBy(key).agg(F.max_by(c, "seq").alias(n))
    x = last(one, F.struct("verdict", "label"), "a").join(last(two, "verdict", "b"), key)
    a, b, label = F.col("a.verdict") == passing, F.col("b") == passing, F.coalesce("a.label", F.lit(""))
    news = label.isin("news_in_topic", "news_off_topic")
    n = F.count_if
    return x.agg(
        F.count("*").alias("common"), n(~F.col("a.verdict").eqNullSafe(F.col("b"))).alias("changed"), n(a & ~b & (label == "not_news")).alias("fixed"), n(a & ~b & news).alias("worse"), n(a & ~b & (label != "not_news") & ~news).alias("unlabelled"),
        n(a & b & (label == "not_news")).alias("still_wrong"), n(a & b & news).alias("still_right"),
    )


def issue_counts(suspects: DataFrame, total: int) -> DataFrame:
    """issue (what stands before its colon), n, share of all `total` rows."""
    x = suspects.select(F.explode("issues").alias("i")).groupBy(F.substring_index("i", ":", 1).alias("issue")).agg(F.count("*").alias("n"))
    return x.withColumn("share", percent(F.col("n"), F.lit(total)))


def candidates_for_people(articles: DataFrame, most_body: int = 1800, most_links: int = 10) -> DataFrame:
    """Certain and possible news for a review: the start of the body and the first links."""
    x = articles.where(F.col("verdict").isin("certain_news", "possible_news"))
    return x.select("seq", "url", "title", F.substring("body", 1, most_body).alias("body"), F.slice("outbound_links", 1, most_links).alias("links"), "published_at", "verdict")


def prepended(batches: DataFrame, batch: str = "run_at") -> DataFrame:
    """Feed rows with their place: the newest batch first, a separator before each batch."""
    heads = batches.select(batch).distinct().select(batch, F.lit(-1).cast("long").alias("ord"), F.concat(F.lit("— "), F.col(batch).cast("string")).alias("title"))
    return batches.select(batch, "ord", "title").unionByName(heads).orderBy(F.desc(batch), "ord")


def _first_rows(df: DataFrame, most: int) -> tuple[list, bool]:
    """At most `most` rows, and whether there are more."""
    rows = df.limit(most + 1).collect()
    return rows[:most], len(rows) > most


def markdown(df: DataFrame, most: int = 1000) -> str:
    """A small report as a Markdown table, of at most `most` rows; a last line says so if there are more."""
    line = lambda cells: "| " + " | ".join(str(c).replace("|", "\\|").replace("\n", " ") for c in cells) + " |"
    rows, more = _first_rows(df, most)
    return "\n".join([line(df.columns), line("---" for _ in df.columns), *[line("" if v is None else v for v in r) for r in rows], *[f"\nThe first {most} rows of more."] * more])


def as_json(df: DataFrame, most: int = 1000) -> str:
    """A small report as JSON: rows (at most `most`), and whether there are more. Times are text."""
    rows, more = _first_rows(df, most)
    return json.dumps({"rows": [r.asDict(recursive=True) for r in rows], "more": more}, ensure_ascii=False, default=str, indent=1)


def answered_titles(rows: DataFrame) -> DataFrame:
    """Rows to ask a model about again, with the title that it gets."""
    return rows.withColumn("ask", text.clean_title(F.col("title")))
