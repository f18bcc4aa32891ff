"""Whole runs: the gates that articles pass, answers of a model taken from a table, and the rows that come out."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import fixed, rules, text
from ..functions.dates import is_fresh
from ..functions.urls import domain, url_hash
from ..operators import budget, dedup, origins
from ..sources.state import Store
from ..storage import cut
from . import calls


@dataclass
class Settings:
    """What a run takes as given."""

    now: datetime
    hours: int = 24
    portal: str = "RU"
    country: str = "Russia [7]"
    countries: dict[str, str] = field(default_factory=dict)
    title_threshold: float = 0.85
    cap: float = 5.0
    blocked_domains: list[str] = field(default_factory=list)
    blocked_phrases: list[str] = field(default_factory=list)
    forced_phrases: list[str] = field(default_factory=lambda: list(fixed.FORCE_REJECT))
    brands: origins.Brands = field(default_factory=list)
    cues: list[str] = field(default_factory=list)
    press: list[str] = field(default_factory=list)
    mirrors: list[str] = field(default_factory=list)
    whitelist: list[str] = field(default_factory=list)
    sections: list[str | tuple[str, str]] = field(default_factory=list)
    shots: list[tuple[str, str]] = field(default_factory=list)

    @property
    def cell(self) -> str:
        """What the column country has for the portal."""
        return self.countries.get(self.portal, self.country)


def graded(articles: DataFrame, s: Settings, seen: DataFrame | None = None) -> DataFrame:
    """Fresh articles (seq, url, title, body, html, published_at, source_language) with verdict, score, hits and reason.

    The gates in order: blacklisted, duplicate (of an earlier URL that isn't blacklisted), cached, then the grade of the
    two rule verdicts. A blacklisted article never makes a later one a duplicate."""
    x = articles.where(is_fresh(F.col("published_at"), s.hours, s.now)).withColumn("url_hash", url_hash(F.col("url")))
    names = [n for name, aliases, _ in s.brands for n in (name, *aliases)]
    x = x.withColumn("reason", rules.blacklist_reason(F.col("url"), F.col("title"), s.blocked_domains, s.blocked_phrases, names, s.forced_phrases))
    own = F.coalesce("url_hash", F.concat(F.lit("seq "), F.col("seq").cast("string")))  # an article without a URL has no copies
    order = Window.partitionBy(own, F.col("reason").isNull()).orderBy("seq")
    x = x.withColumn("copy", F.when(F.col("reason").isNull(), F.row_number().over(order)).otherwise(1))
    x = dedup.restored(x, seen, s.portal) if seen is not None else x.withColumn("from_cache", F.lit(False))
    html = F.col("html") if "html" in articles.columns else F.lit(None).cast("string")
    x = x.withColumn("a", rules.article_verdict(F.col("title"), F.col("body"), F.col("url"), html, F.col("published_at"), s.whitelist))
    x = x.withColumn("t", rules.topic_verdict(F.col("title"), F.col("body"), F.col("source_language")))
    verdict = F.when(F.col("reason").isNotNull(), "blacklisted").when(F.col("copy") > 1, "duplicate").when(F.col("from_cache"), "cached").otherwise(rules.grade(F.col("a"), F.col("t")))
    told = {"is_article": F.col("a.is_article"), "reasons": F.col("a.reasons"), "on_topic": F.col("t.passes"), "samples": F.col("t.samples")}
    return x.withColumns({"verdict": verdict, "score": F.col("a.score"), "hits": F.col("t.hits"), **told}).drop("a", "t", "copy")


def with_answers(articles: DataFrame, answers: DataFrame, s: Settings) -> DataFrame:
    """Articles with a model's answers (key, relevant, section, region, confidence, title_en, title_ru, cost, error).

    The key is the hash of title and excerpt. An irrelevant article gets the verdict rejected; one with an error keeps a
    note; a possible one that is relevant becomes certain; unknown sections are Other news. Without an answer: a note."""
    x = articles.withColumn("key", text.prompt_hash(F.coalesce("title", F.lit("")), F.substring(F.coalesce("body", F.lit("")), 1, 500)))
    # of several answers to one prompt the least by all columns, so that reruns agree
    x = x.join(answers.groupBy("key").agg(F.min(F.struct(*[c for c in answers.columns if c != "key"])).alias("_a")).select("key", "_a.*"), "key", "left")
    names = [n if isinstance(n, str) else n[0] for n in s.sections]
    section = F.when(F.col("section").isin(names or [""]), F.col("section")).when(F.col("section").isNotNull(), "Other news")
    verdict = F.when(F.col("relevant") == F.lit(False), "rejected").when((F.col("verdict") == "possible_news") & F.col("relevant"), "certain_news").otherwise(F.col("verdict"))
    note = F.coalesce("error", F.when(F.col("relevant").isNull(), "no answer"))
    return x.withColumns({"section": section, "verdict": verdict, "note": note, "cost": F.round(F.coalesce("cost", F.lit(0.0)), 5)})


def with_primary(articles: DataFrame, s: Settings, corpus: DataFrame | None = None) -> DataFrame:
    """Articles with their primary source by links, and where its confidence isn't high, by the earliest article of the
    corpus (seq, url, title, published_at; the articles themselves by default) with a similar title, if there is one."""
    links = F.col("outbound_links") if "outbound_links" in articles.columns else F.array().cast("array<string>")
    p = origins.primary_source(F.col("url"), F.col("title"), F.col("body"), links, s.brands, s.cues, s.press, s.mirrors, s.whitelist)
    x = articles.withColumn("p", p)
    rows = articles.select("seq", "url", "title", "published_at")
    every = rows if corpus is None else corpus.select(*rows.columns)
    early = origins.earliest_similar(every, s.press, s.whitelist, s.mirrors, wanted=x.where("p.confidence <> 'high'").select("seq"))
    x = x.join(early.select("seq", F.struct(F.col("primary_url").alias("url"), F.col("primary_domain").alias("domain"), "confidence").alias("e")), "seq", "left")
    found = (F.col("p.confidence") != "high") & F.col("e").isNotNull()
    best = F.when(found, F.col("e")).otherwise(F.col("p"))
    return x.withColumns({"primary_url": best["url"], "primary_domain": best["domain"], "primary_confidence": best["confidence"], "primary_method": F.when(found, "earliest").when(F.col("p.url") == F.col("url"), "self").otherwise("links")}).drop("p", "e")


def production_run(articles: DataFrame, seen: DataFrame, titles: DataFrame, answers: DataFrame | dict[str, DataFrame], s: Settings) -> dict[str, DataFrame]:
    """rows: what is published of a run; marks: what the state gets, and seen: the state with it; summary: its counters;
    requests: with one table of answers a call (`plans.calls`), the calls that have no answer yet. Those of a run that isn't
    committed can be answered and the run made again; articles that wait aren't marked seen.

    Fresh candidates not seen before and without a similar title get a model's answers in order of seq until the cost
    breaks the cap, which is charged (spent) and ends the run (aborted): rows before that are published and marked seen, the
    others, and the rejected, come again. cost is that of the rows within the cap. Steps that are read twice are written once, and counted by observation as they are."""
    told = {step: Observation(step) for step in ("found", "fresh", "new", "asked", "paid", "written")}
    n = F.count(F.lit(1)).alias("n")
    found = cut(dedup.fresh_candidates(articles.observe(told["found"], n), s.hours, s.now).observe(told["fresh"], n), "fresh")
    new = dedup.without_similar(dedup.unseen(found, seen), titles, s.title_threshold).observe(told["new"], n)
    new = new.withColumn("verdict", F.lit("possible_news"))
    one = isinstance(answers, DataFrame)
    answered = with_answers(new, answers, s) if one else calls.chained(new, answers, [(n, "") if isinstance(n, str) else n for n in s.sections], s.shots, s.cell)
    answered = cut(answered.observe(told["asked"], n, F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost")), "answered")
    within = budget.within(answered, s.cap, ["seq"]) if one else budget.whole_within(answered, s.cap, ["seq"]).where("pending is null")
    paid = cut(within.observe(told["paid"], n, F.round(F.coalesce(F.sum("cost"), F.lit(0.0)), 5).alias("cost")), "paid")
    single = F.array(F.struct(F.lit(1).alias("step"), F.lit("all").alias("call"), F.lit("").alias("key"), "cost"))
    spent = budget.charged(answered.withColumn("calls", single) if one else answered, s.cap, ["seq"]).agg(F.coalesce(F.max("spent"), F.lit(0.0))).first()[0]
    kept = with_primary(paid.where("verdict = 'certain_news' and note is null"), s, articles)
    rows = kept.select(
        "seq", text.combined_title(F.col("title_en"), F.col("title_ru"), F.upper(F.coalesce("source_language", F.lit("")))).alias("title"), "section", "region", F.lit(s.cell).alias("country"), "url", domain(F.col("url")).alias("domain"),
        "published_at", "primary_url", "primary_domain", "primary_confidence", F.bround("confidence", 3).alias("confidence"), "url_hash",
    )
    rows = cut(rows.observe(told["written"], n), "rows")
    marks = paid.join(rows.select("seq"), "seq", "left_semi").select("url_hash", "canonical_url", "title", "published_at", F.lit(s.now).alias("first_seen_at"), F.lit(s.now).alias("last_seen_at"), "source_domain", F.lit(s.portal).alias("portal"), F.lit(None).cast("string").alias("cached_row_json"))
    counts = {step: o.get.get("n") or 0 for step, o in told.items() if step != "asked"}
    # costs aren't negative: a call breaks the cap exactly if all together do
    counts |= {"cost": told["paid"].get.get("cost") or 0.0, "spent": round(spent, 5), "aborted": (told["asked"].get.get("cost") or 0.0) > s.cap}
    kinds = {"cost": "double", "spent": "double", "aborted": "boolean"}
    summary = articles.sparkSession.createDataFrame([counts], ", ".join(f"{c} {kinds.get(c, 'long')}" for c in counts))
    asked = {} if one else {"requests": calls.requests(answered)}
    return asked | {"rows": rows, "marks": marks, "seen": dedup.upserted(seen, marks), "summary": summary}


def committed_run(store: Store, run: str, articles: DataFrame, titles: DataFrame, answers: DataFrame, s: Settings) -> bool:
    """Run and commit once under the name `run`: only the partitions of the state that the articles fall into are read and
    rewritten, and of a run that failed half-way nothing is lost or written twice. False if it was committed before."""

    def made() -> dict[str, DataFrame]:
        return production_run(articles, store.seen_of(dedup.candidates(articles)), titles, answers, s)

    return store.commit(run, made)


def report_rows(articles: DataFrame) -> DataFrame:
    """The columns of the batch report: combined title, start of the body, reasons and scores of every graded article."""
    body = F.replace(F.coalesce("body", F.lit("")), F.lit("\n\n"), F.lit("\n"))
    return articles.select("seq", "url", "title", F.substring(F.trim(body), 1, 300).alias("lede"), "published_at", "verdict", "score", "hits", F.substring(F.coalesce("reason", F.lit("")), 1, 400).alias("reason"))


def suspect(title: Column, similar: Column) -> Column:
    """What is odd about a combined title: years that only one language has, or lines that are too unlike (under 35)."""
    lines = text.language_lines(title)
    years = text.year_drift(lines["en"], lines["ru"])
    both = (lines["en"] != "") & (lines["ru"] != "")
    return F.array_compact(F.array(F.when(both & (F.size(years) > 0), F.concat(F.lit("years: "), F.array_join(years, ","))), F.when(both & (similar < 35), F.lit("unlike"))))


def suspects(rows: DataFrame) -> DataFrame:
    """seq, issues of rows (seq, title) with an odd title."""
    lines = text.language_lines(F.col("title"))
    x = rows.withColumn("ratio", text.token_set_ratio()(lines["en"], lines["ru"])).withColumn("issues", suspect(F.col("title"), F.col("ratio")))
    return x.where("size(issues) > 0").select("seq", "issues")


def dated_again(rows: DataFrame) -> DataFrame:
    """Rows (seq, urls, title, lede, published_at) with a date where they had none: of the first URL that holds one, else of
    the text."""
    from ..functions.dates import from_text, from_url

    x = rows.withColumn("found", F.get(F.filter(F.transform("urls", from_url), lambda d: d.isNotNull()), F.lit(0)))
    return x.withColumn("published_at", F.coalesce("published_at", "found", from_text(F.col("title"), F.col("lede")))).drop("found")


def retried(rows: DataFrame) -> DataFrame:
    """Certain rows to ask a model again: with an error, no section or no EN line, that have a title and a body."""
    bad = F.col("note").isNotNull() | (F.coalesce("section", F.lit("")) == "") | ~F.contains(F.coalesce("title", F.lit("")), F.lit("EN:"))
    return rows.where((F.col("verdict") == "certain_news") & bad & (F.coalesce("title", F.lit("")) != "") & (F.coalesce("body", F.lit("")) != ""))


def applied(rows: DataFrame, patches: DataFrame, key: str = "seq") -> DataFrame:
    """Rows with the values of patches (one per key) where these have some."""
    new = [c for c in patches.columns if c != key]
    x = rows.join(patches.select(key, *[F.col(c).alias(f"_{c}") for c in new]), key, "left")
    return x.withColumns({c: F.coalesce(f"_{c}", c) if c in rows.columns else F.col(f"_{c}") for c in new}).drop(*[f"_{c}" for c in new])
