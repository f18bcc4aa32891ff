"""Mixing sources to target weights, in DataFrame operations alone.

The words of a source, documents in a fixed order, form one stream that is cut into blocks of `block` words. A mix is a
row of slots, dealt to output shards of SHARD slots. Every slot draws a source at random by the targets, seeded by its
shard, so the counts of sources in a shard are a multinomial draw. The draws of all shards are then reconciled with the
exact totals: a source drawn too often gives up evenly spaced draws of its own, which go to the sources drawn too seldom.
A source's kept draws keep their numbers, so which draws it gives up decides which of its blocks are taken. A number
passes through a permutation of the source's blocks, anew for every pass over them, and blocks are joined by index. A source
whose draws would go beyond `cap` passes is numbered without gaps, so no block is taken more than `cap` times. No step
holds all rows of a source in one task: ranks go over shards first, running sums over (source, bucket of a hash of doc_id).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import WORD, cut, partitions, word_count

BLOCK, SHARE, CAP, WEIGHTS, BUCKETS, BUCKET_ROWS, SHARD, CHUNK = 32, 1.5, 2, (5.0, 2.0, 1.0), 4096, 16384, 4096, 8192
#: Multipliers of the index permutations; primes, so each is coprime to any count that it does not divide.
PRIMES = (999983, 999979, 999961, 999959, 999953, 999931, 999917, 999907)


def permutation(n: F.Column, seed: F.Column) -> F.Column:
    """A pseudorandom permutation of 0..n-1 as struct (mul, add): an affine map whose multiplier is a prime that does not
    divide n."""
    h = F.conv(F.substring(F.md5(seed), 1, 7), 16, 10).cast("long")
    p = F.array(*map(F.lit, PRIMES)).cast("array<bigint>")
    nth = lambda k: F.element_at(p, ((h + k) % len(PRIMES) + 1).cast("int"))
    return F.struct(F.when(n % nth(0) != 0, nth(0)).when(n % nth(1) != 0, nth(1)).otherwise(nth(2)).alias("mul"), h.alias("add"))


def targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple = WEIGHTS) -> DataFrame:
    """Words to take from each source. `sizes` has source and source_size; adds rn (its number), target.

    Weights go to sources by code point order, null last, repeating. No target is above `cap` times its source's size;
    the excess goes to the others by weight until none is above: sources fill up in order of cap by weight, so one
    pass over the sorted sources finds the level at which the rest is shared."""
    every, w = Window.orderBy(F.col("source").asc_nulls_last()), F.array(*map(F.lit, weights))
    all_rows = Window.partitionBy()
    x = sizes.withColumn("rn", F.row_number().over(every) - 1).withColumn("w", F.element_at(w, F.col("rn") % len(weights) + 1))
    x = x.withColumn("cap", cap * F.col("source_size").cast("double")).withColumn("key", F.col("cap") / F.col("w"))
    filled = Window.orderBy("key", "rn").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(filled), F.lit(0.0))
    level = (share * F.sum("source_size").over(all_rows) - before("cap")) / (F.sum("w").over(all_rows) - before("w"))
    x = x.withColumn("level", level)
    x = x.withColumn("at", F.min(F.when(F.col("level") <= F.col("key"), F.struct("key", "rn", "level"))).over(all_rows)["level"])
    return x.select("source", "source_size", "rn", F.coalesce(F.least("cap", F.col("at") * F.col("w")), F.col("cap")).alias("target"))


def drawn_slots(spark: SparkSession, src: DataFrame, cap: float, seed: str) -> DataFrame:
    """slot, shard, rn, block, pass of every slot of the mix. `src` has rn, blocks, slots (to take) and first (the slots of
    the sources before it)."""
    total = src.agg(F.sum("slots")).first()[0] or 0
    # every slot throws a dart at the line of all targets: chunk of the line -> source that owns it
    spread = src.where("slots > 0").withColumn("chunk", F.explode(F.sequence(F.expr(f"first div {CHUNK}"), F.expr(f"(first + slots - 1) div {CHUNK}"))))
    line = spark.range(0, total, 1, partitions(spark)).select(F.col("id").alias("slot"), F.expr(f"id div {SHARD}").alias("shard"))
    dart = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(seed), "shard", F.col("slot") % SHARD)), 1, 15), 16, 10).cast("long")
    line = line.withColumn("q", dart % max(total, 1)).withColumn("chunk", F.expr(f"q div {CHUNK}"))
    draws = line.join(spread.select("chunk", "rn", "first", "slots"), "chunk").where("q >= first and q < first + slots")
    draws = cut(draws.groupBy("shard", "rn").agg(F.sort_array(F.collect_list("slot")).alias("at")), "draws")
    # where each shard's draws of a source start among all of its draws; over groups of shards first
    counts = draws.select("shard", "rn", F.size("at").alias("n"), F.expr(f"shard div {SHARD}").alias("group"))
    before = (Window.unboundedPreceding, -1)
    groups = counts.groupBy("group", "rn").agg(F.sum("n").alias("n"))
    groups = groups.select("group", "rn", F.coalesce(F.sum("n").over(Window.partitionBy("rn").orderBy("group").rowsBetween(*before)), F.lit(0)).alias("base"))
    starts = counts.join(groups, ["group", "rn"]).select("shard", "rn", (F.col("base") + F.coalesce(F.sum("n").over(Window.partitionBy("rn", "group").orderBy("shard").rowsBetween(*before)), F.lit(0))).alias("start"))
    # the totals: how much each source has too many or too few draws, and where these stand among all such
    sums = src.join(counts.groupBy("rn").agg(F.sum("n").alias("n")), "rn", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = sums.withColumns({"over": F.greatest(F.lit(0), F.col("n") - F.col("slots")), "lack": F.greatest(F.lit(0), F.col("slots") - F.col("n"))})
    upto = lambda c: F.coalesce(F.sum(c).over(Window.orderBy("rn").rowsBetween(*before)), F.lit(0))
    sums = cut(sums.select("rn", "blocks", "n", "over", "lack", upto("over").alias("over_at"), upto("lack").alias("lack_at")), "sums")
    x = draws.join(starts, ["shard", "rn"]).join(sums.select("rn", "blocks", "n", "over", "over_at"), "rn").select("*", F.posexplode("at").alias("k", "slot"))
    x = x.withColumn("j", F.col("start") + F.col("k")).withColumns({"gone": F.expr("j * over div n"), "gone_too": F.expr("(j + 1) * over div n")})
    x = x.withColumn("e", F.when(F.col("gone") < F.col("gone_too"), F.col("over_at") + F.col("gone")))
    lacking = sums.where("lack > 0").select(F.explode(F.sequence(F.expr(f"lack_at div {CHUNK}"), F.expr(f"(lack_at + lack - 1) div {CHUNK}"))).alias("chunk"), "lack_at", "lack", F.struct("rn", "blocks", "n").alias("to"))
    x = x.join(lacking, (F.expr(f"e div {CHUNK}") == F.col("chunk")) & F.expr("e >= lack_at and e < lack_at + lack"), "left")
    dense = F.when(F.col("n") > cap * F.col("blocks"), F.col("j") - F.col("gone")).otherwise(F.col("j"))
    moved = F.col("e").isNotNull()
    x = x.select("slot", "shard", F.when(moved, F.col("to.rn")).otherwise(F.col("rn")).alias("rn"), F.when(moved, F.col("to.n") + F.col("e") - F.col("lack_at")).otherwise(dense).alias("i"), F.when(moved, F.col("to.blocks")).otherwise(F.col("blocks")).alias("of"))
    passes = sums.where("blocks > 0").select("rn", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(math.ceil(cap)).cast("long"))).alias("pass"))
    passes = passes.select("rn", "pass", "blocks", permutation(F.col("blocks"), F.concat_ws("-", F.lit(seed), "rn", "pass")).alias("p"))
    x = x.withColumn("pass", F.expr("i div of")).join(passes, ["rn", "pass"])
    return x.select("slot", "shard", "rn", F.expr("(p.mul * (i % blocks) + p.add) % blocks").alias("block"), "pass")


def mix(docs: DataFrame, block: int = BLOCK, share: float = SHARE, cap: float = CAP, weights: tuple = WEIGHTS, seed: str = "mix") -> dict[str, DataFrame]:
    """The mix of `docs` (doc_id, text, source, any others).

    Returns sources (source, source_size, rn, target, blocks, slots, first), slots (slot, shard, rn, block, pass) and
    pieces (row, doc_id, size, rn, block, from, words, times): the part of a document that lies in a block, with how
    often the mix takes it. Null and empty texts have no words and no pieces; null is a source of its own; rows that
    repeat a doc_id are documents of their own; of equal doc_ids the hash of the text gives the order. Texts of any length
    are cut into blocks whole. An empty table, or one without words, gives empty tables."""
    spark = docs.sparkSession
    # documents are dealt to buckets by a hash, whatever their ids have in common, and to more of them if there are more
    buckets = max(BUCKETS, docs.count() // BUCKET_ROWS)
    place = F.conv(F.substring(F.md5(F.concat(F.lit("place-"), F.coalesce("doc_id", F.xxhash64("text")).cast("string"))), 1, 8), 16, 10).cast("long") % buckets
    sized = cut(docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("tie"), place.alias("bucket")), "sized")
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    src = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), share, cap, weights)
    src = src.withColumn("blocks", F.ceil(F.col("source_size") / block)).withColumn(
        "slots", F.coalesce(F.least((F.lit(cap) * F.col("blocks")).cast("long"), F.round(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size"))).cast("long")), F.lit(0).cast("long"))
    )
    src = src.withColumn("first", F.coalesce(F.sum("slots").over(Window.orderBy("rn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    src = cut(src, "sources")
    slots = drawn_slots(spark, src, cap, seed)
    # documents: where each starts in its source's stream
    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("base", F.coalesce(F.sum("words").over(by_bucket), F.lit(0))).join(src.select(F.col("source").alias("of"), "rn"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "words")
    in_bucket = Window.partitionBy("d.source", "d.bucket").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sized.alias("d")
        .join(base.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.bucket") == F.col("b.bucket")))
        .select("doc_id", "tie", "size", "rn", (F.col("base") + F.coalesce(F.sum("size").over(in_bucket), F.lit(0))).alias("at"))
    )
    cuts = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}"))))
    cuts = cuts.withColumn("from", F.greatest(F.lit(0), F.col("block") * block - F.col("at"))).withColumn("words", F.least("size", (F.col("block") + 1) * block - F.col("at")) - F.col("from"))
    drawn = slots.groupBy("rn", "block").agg(F.count("*").alias("times"))
    pieces = cuts.join(drawn, ["rn", "block"], "left").withColumn("times", F.coalesce("times", F.lit(0)))
    return {"sources": src, "slots": slots, "pieces": pieces, "sized": sized}


def mixed_sizes(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, times (the most often that a part is taken).

    Documents without words are kept with size 0 and taken 0."""
    m = mix(docs, **how)
    key = ["doc_id", "tie"]
    taken = m["pieces"].groupBy(*key, "rn").agg(F.sum(F.col("words") * F.col("times")).alias("taken"), F.max("times").alias("times"), F.first("size").alias("n"))
    # copies of a row (same doc_id and text) share one key and as many pieces as there are copies; each gets its part
    copies = m["sized"].groupBy(*key, "source", "size").agg(F.count("*").alias("copies"))
    out = copies.join(m["sources"].select(F.col("source").alias("of"), "source_size", "target", "rn"), F.col("source").eqNullSafe(F.col("of")))
    t, o = taken.alias("t"), out.alias("o")
    out = o.join(t, (F.col("o.rn") == F.col("t.rn")) & F.col("o.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("o.tie").eqNullSafe(F.col("t.tie")), "left")
    out = out.select("o.doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "copies", F.coalesce("times", F.lit(0)).alias("times"))
    out = out.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    each = F.expr("taken div copies + if(k <= taken % copies, 1, 0)")
    return out.select("doc_id", "size", "source_size", "target", each.cast("long").alias("taken"), "times")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents that the mix holds, with the columns of `docs` (doc_id, text, lang, source, n_chars).

    A null source is a source of its own; null texts and texts without words are in no block and don't come; documents
    without a doc_id are dealt by the hash of their text; rows equal in doc_id and text share what is taken of them; of equal doc_ids the
    hash of the text gives the order. Texts of any length are cut whole; an empty table gives an empty one.
    A document whose blocks are taken twice comes twice. A text whose blocks are all taken stays as it is; of others
    the taken words remain, with the white space after them, so lines stay lines."""
    m = mix(docs, **how)
    p = m["pieces"].where("times > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    p = p.groupBy("doc_id", "tie", "pass").agg(F.sum("words").alias("_nw_got"), F.array_sort(F.collect_list(F.struct("from", "words"))).alias("_nw_parts"))
    p = p.select(F.col("doc_id").alias("_nw_id"), F.col("tie").alias("_nw_of"), "_nw_got", "_nw_parts")
    copies = docs.withColumn("_nw_tie", F.xxhash64("text"))
    out = copies.join(p, F.col("doc_id").eqNullSafe(F.col("_nw_id")) & F.col("_nw_tie").eqNullSafe(F.col("_nw_of")))
    words = F.regexp_extract_all("text", F.lit(rf"({WORD}[\x20\x09-\x0D]*)"))
    some = F.array_join(F.flatten(F.transform("_nw_parts", lambda x: F.slice(F.col("_nw_words"), x["from"].cast("int") + 1, x["words"].cast("int")))), "")
    some = F.regexp_replace(some, r"[\x20\x09-\x0D]+$", "")
    out = out.withColumn("_nw_words", F.when(F.col("_nw_got") < word_count("text"), words))
    out = out.withColumn("_nw_text", F.when(F.col("_nw_words").isNull(), F.col("text")).otherwise(some))
    return out.select(*[F.col("_nw_text").alias("text") if c == "text" else F.length("_nw_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
