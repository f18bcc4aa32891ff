"""Profiles and quality figures of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import without_tags


def top(df: DataFrame, key: Column, name: str, k: int, order: str = "seq") -> DataFrame:
    """The k most frequent values with n and their share of all rows; ties in the order in which they first come."""
    g = df.groupBy(key.alias(name)).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    # the total is one row, so that the values, which can be very many, needn't meet in one task
    some = g.orderBy(F.desc("n"), "first").limit(k).crossJoin(F.broadcast(df.agg(F.count("*").alias("all"))))
    return some.orderBy(F.desc("n"), "first").select(name, "n", (F.col("n") / F.col("all")).alias("share"))


def hours_of_day(df: DataFrame, at: Column) -> DataFrame:
    """Rows by hour of day, all 24."""
    every = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    n = df.where(at.isNotNull()).groupBy(F.hour(at).alias("hour")).agg(F.count("*").alias("n"))
    return every.join(n, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n"))


def balanced(df: DataFrame, key: str, title: str, per_key: int = 8, prefix: int = 60) -> DataFrame:
    """First rows by seq: of titles equal in lower case over `prefix` characters the first of all, then `per_key` of each key."""
    x = df.where((F.coalesce(key, F.lit("")) != "") & (F.coalesce(title, F.lit("")) != ""))
    one = Window.partitionBy(F.lower(F.substring(title, 1, prefix))).orderBy("seq")
    x = x.withColumn("k", F.row_number().over(one)).where("k = 1")
    return x.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("seq"))).where(F.col("rank") <= per_key).drop("k")


def confusion(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 and accuracy; 0 where undefined."""
    p, a = predicted, actual
    x = df.agg(F.count_if(p & a).alias("tp"), F.count_if(p & ~a).alias("fp"), F.count_if(~p & a).alias("fn"), F.count_if(~p & ~a).alias("tn"))
    ratio = lambda n, d: F.coalesce(F.try_divide(n, d), F.lit(0.0))
    x = x.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return x.withColumns({"f1": ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), "accuracy": ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))})


def panel(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and share by each of several columns in one pass: field, value (blank as (none)), n, share."""
    marks = [F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit("(none)")).alias(c) for c in columns]
    x = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), m.alias("value")) for c, m in zip(columns, marks, strict=True)])).alias("f"))
    x = x.groupBy("f.field", "f.value").agg(F.count("*").alias("n"))
    return x.withColumn("share", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy("field")), 1))


def transitions(one: DataFrame, two: DataFrame, key: str, value: str) -> DataFrame:
    """before, after, n of rows in both versions; of rows that repeat a key the last by seq counts."""
    last = lambda d, c: d.groupBy(key).agg(F.max_by(value, "seq").alias(c))
    return last(one, "before").join(last(two, "after"), key).groupBy("before", "after").agg(F.count("*").alias("n"))


def per_source(df: DataFrame, source: str, passed: Column, samples: int = 3, most: int = 80) -> DataFrame:
    """Rows, passed rows and the first titles of each source."""
    first = Window.partitionBy(source).orderBy("seq")
    some = df.withColumn("k", F.row_number().over(first)).where(F.col("k") <= samples).groupBy(source).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.substring("title", 1, most).alias("t")))), lambda s: s["t"]), " | ").alias("samples"))
    return df.groupBy(source).agg(F.count("*").alias("n"), F.count_if(passed).alias("passed")).join(some, source)


def agreement(answers: DataFrame, item: str, provider: str, value: str) -> DataFrame:
    """Items that two providers answered, those on which they agree, and the share."""
    x = answers.groupBy(item).agg(F.count_distinct(provider).alias("providers"), F.count_distinct(value).alias("values")).where("providers >= 2")
    return x.agg(F.count("*").alias("items"), F.count_if(F.col("values") == 1).alias("agree")).withColumn("share", F.coalesce(F.try_divide("agree", "items"), F.lit(0.0)))


def outcomes(df: DataFrame, section: Column, note: Column) -> DataFrame:
    """Rows that a model answered, refused with a note, or never saw."""
    done, failed = F.coalesce(section, F.lit("")) != "", F.coalesce(note, F.lit("")) != ""
    return df.agg(F.count_if(done).alias("answered"), F.count_if(~done & failed).alias("failed"), F.count_if(~done & ~failed).alias("unasked"))


def spent(calls: DataFrame, by: str) -> DataFrame:
    """Calls, cost, and mean tokens and latency of each provider."""
    return calls.groupBy(by).agg(F.count("*").alias("calls"), F.sum("cost").alias("cost"), F.avg(F.col("input_tokens") + F.col("output_tokens")).alias("mean_tokens"), F.avg("latency_ms").alias("mean_latency"))


def mean_lengths(rows: DataFrame, **texts: Column) -> DataFrame:
    """n, and for each of `texts` the mean length of those that aren't empty, without tags, rounded half to even; 0 if there
    are none."""
    size = lambda t: F.length(without_tags(t))
    mean = lambda t: F.coalesce(F.bround(F.avg(F.when(F.coalesce(t, F.lit("")) != "", size(t))), 0), F.lit(0)).cast("long")
    return rows.agg(F.count("*").alias("n"), *[mean(t).alias(k) for k, t in texts.items()])
