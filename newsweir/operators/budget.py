"""Cost of model calls, and a cap on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def call_costs(calls: DataFrame, prices: DataFrame, write: float = 1.25, read: float = 0.10) -> DataFrame:
    """`calls` (model, input_tokens, output_tokens, cache_write_tokens, cache_read_tokens) with cost.

    `prices` (model, input_price, output_price, per million tokens). A model that isn't there costs as the dearest."""
    dearest = prices.agg(F.max_by(F.struct("input_price", "output_price"), F.col("input_price") + F.col("output_price")).alias("d"))
    x = calls.join(prices, "model", "left").crossJoin(F.broadcast(dearest))  # one row
    i, o = F.coalesce("input_price", "d.input_price"), F.coalesce("output_price", "d.output_price")
    tokens = lambda c: F.coalesce(c, F.lit(0)) / 1_000_000
    cost = tokens("input_tokens") * i + tokens("cache_write_tokens") * i * write + tokens("cache_read_tokens") * i * read + tokens("output_tokens") * o
    return x.withColumn("cost", cost).drop("input_price", "output_price", "d")


def running(calls: DataFrame, order: list[str], cost: str = "cost", span: str = "bucket") -> DataFrame:
    """`calls` with spent, the sum of cost up to each call in `order`.

    The sum goes over spans of the first order column (minutes, or 100,000 numbers) first and then within a span, so no
    task has all calls."""
    of = F.date_trunc("minute", order[0]) if dict(calls.dtypes)[order[0]].startswith("timestamp") else F.expr(f"{order[0]} div 100000")
    x = calls.withColumn(span, of)
    sums = x.groupBy(span).agg(F.sum(cost).alias("c"))
    sums = sums.select(F.col(span).alias("_s"), F.coalesce(F.sum("c").over(Window.orderBy(span).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("base"))
    w = Window.partitionBy(span).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return x.join(sums, F.col(span).eqNullSafe(F.col("_s"))).withColumn("spent", F.col("base") + F.sum(cost).over(w)).drop("_s", "base", span)


def within(calls: DataFrame, cap: float, order: list[str], cost: str = "cost") -> DataFrame:
    """Calls up to the cap: the call that breaks it is charged, but it and all later ones give nothing."""
    return running(calls, order, cost).where(F.col("spent") <= cap)


def charged(articles: DataFrame, cap: float, order: list[str]) -> DataFrame:
    """The calls (an array of structs step, call, key, cost) of articles, one row each, in order of article and step, with
    spent; up to the one that breaks the cap, which is charged too. What was spent is the last row's, the greatest."""
    x = running(articles.select(*order, F.inline("calls")), [*order, "step"])
    return x.where(F.col("spent") - F.col("cost") <= cap)


def whole_within(articles: DataFrame, cap: float, order: list[str]) -> DataFrame:
    """The articles all of whose calls are within the cap: the one whose call breaks it is lost, though its earlier calls were
    paid, and so are all after it. Articles without calls stay if no call before them breaks the cap."""
    x = articles.withColumn("_cost", F.aggregate("calls", F.lit(0.0), lambda a, c: a + c["cost"]))
    # costs aren't negative: an article's last call is its dearest sum
    return running(x, order, "_cost").where(F.col("spent") <= cap).drop("_cost")
