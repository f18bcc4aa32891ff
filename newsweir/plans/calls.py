"""A model's three chained calls, answered from tables: is an article relevant, which section and region, what titles.

Each call has a key of its own, the hash of all that its prompt is made of, and a replay table of answers by key. A call is
made only if the one before it was answered without an error and let the article through. Calls whose key has no answer are
pending: they are a table of requests, for whoever asks the model, and with the new answers the same run goes on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import prompt_hash

CALLS = ("relevance", "section", "titles")
ANSWERS = {
    "relevance": "key string, relevant boolean, cost double, error string",
    "section": "key string, section string, region string, confidence double, cost double, error string",
    "titles": "key string, title_en string, title_ru string, language string, cost double, error string",
}
EXCERPT, BODY, SHOTS = 500, 4000, 20


def shots_of(shots: DataFrame, most: int = SHOTS) -> list[tuple[str, str]]:
    """The first few-shots (section, title) as a prompt has them, of a table in order (see `sources.tables.few_shots`)."""
    return [(r.section, r.title) for r in shots.limit(most).collect()]


def keys(title: Column, body: Column, language: Column, sections: list[tuple[str, str]], shots: list[tuple[str, str]], country: str) -> dict[str, Column]:
    """The key of each call: over title and excerpt; over country, sections, few-shots, title and body; over title and language."""
    title, body = F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))
    known = "\n".join(f"- {name}: {about.strip()}" for name, about in sections)
    shown = "\n".join(f"[{section}] {t}" for section, t in shots[:SHOTS])
    return {
        "relevance": prompt_hash(F.lit("relevance"), title, F.substring(body, 1, EXCERPT)),
        "section": prompt_hash(F.lit("section"), F.lit(country), F.lit(known), F.lit(shown), title, F.substring(body, 1, BODY)),
        "titles": prompt_hash(F.lit("titles"), title, F.coalesce(language, F.lit(""))),
    }


def _answered(x: DataFrame, call: str, answers: DataFrame, asked: Column) -> DataFrame:
    """x with the answer (a struct named after the call) to the rows that ask, null where there is none."""
    fields = [c.split()[0] for c in ANSWERS[call].split(", ")][1:]
    # of several answers to one prompt the least by all columns, so that reruns agree
    one = answers.groupBy("key").agg(F.min(F.struct(*[F.col(c) for c in fields])).alias(call)).withColumnRenamed("key", "_key")
    # rows that don't ask meet nothing; each has a key of its own, or all would go to the task of nulls
    apart = F.concat(F.lit("no call "), F.xxhash64(*[F.col(f"_{c}") for c in CALLS], "seq").cast("string"))
    return x.withColumn("_ask", F.when(asked, F.col(f"_{call}")).otherwise(apart)).join(one, F.col("_ask") == F.col("_key"), "left").drop("_ask", "_key").withColumn(f"_asked_{call}", F.coalesce(asked, F.lit(False)))


def chained(articles: DataFrame, answers: dict[str, DataFrame], sections: list[tuple[str, str]], shots: list[tuple[str, str]] = (), country: str = "") -> DataFrame:
    """Articles (seq, title, body, source_language, verdict, others) with what the calls say: relevant, section, region,
    confidence, title_en, title_ru, language, cost, note, calls and pending.

    An irrelevant article gets the verdict rejected; a possible one that is relevant becomes certain; an unknown section is
    Other news. note joins the errors of all steps in order; calls has step, call, key and cost of each call that was
    answered; pending the call and key that has no answer yet, after which nothing is asked."""
    of = keys(F.col("title"), F.col("body"), F.col("source_language") if "source_language" in articles.columns else F.lit(""), list(sections), list(shots), country)
    x = articles.withColumns({f"_{call}": of[call] for call in CALLS})
    good = lambda call: F.col(call).isNotNull() & F.col(f"{call}.error").isNull()
    x = _answered(x, "relevance", answers["relevance"], F.lit(True))
    x = _answered(x, "section", answers["section"], good("relevance") & F.col("relevance.relevant"))
    x = _answered(x, "titles", answers["titles"], F.col("_asked_section") & good("section"))
    named = F.col("section.section")
    section = F.when(named.isin([n for n, _ in sections] or [""]), named).when(named.isNotNull(), "Other news")
    verdict = F.when(F.col("relevance.relevant") == F.lit(False), "rejected").when((F.col("verdict") == "possible_news") & F.col("relevance.relevant"), "certain_news").otherwise(F.col("verdict"))
    made = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(k + 1).alias("step"), F.lit(c).alias("call"), F.col(f"_{c}").alias("key"), F.coalesce(F.col(f"{c}.cost"), F.lit(0.0)).alias("cost"))) for k, c in enumerate(CALLS)]))
    note = F.nullif(F.concat_ws(" | ", *[F.when(F.col(f"{c}.error").isNotNull(), F.concat(F.lit(f"{c}: "), F.col(f"{c}.error"))) for c in CALLS]), F.lit(""))
    waits = F.coalesce(*[F.when(F.col(f"_asked_{c}") & F.col(c).isNull(), F.struct(F.lit(c).alias("call"), F.col(f"_{c}").alias("key"))) for c in CALLS])
    # the answers' structs have the names of columns that come out of them, so all are read before any is replaced
    out = {
        "relevant": F.col("relevance.relevant"), "region": F.col("section.region"), "confidence": F.col("section.confidence"), "title_en": F.col("titles.title_en"), "title_ru": F.col("titles.title_ru"),
        "language": F.col("titles.language"), "verdict": verdict, "calls": made, "note": note, "pending": waits, "section": section,
    }
    kept = [c for c in articles.columns if c not in out]
    x = x.select(*kept, *[v.alias(k) for k, v in out.items()])
    return x.withColumn("cost", F.round(F.aggregate("calls", F.lit(0.0), lambda a, c: a + c["cost"]), 5))


def requests(asked: DataFrame) -> DataFrame:
    """call, key, seq of the calls that wait for an answer, each key once, with the first article that asks it."""
    return asked.where("pending is not null").groupBy("pending.call", "pending.key").agg(F.min("seq").alias("seq"))
