"""How filters interact: what each removes in every order in which they can be applied.

The orders of k filters form a trie of k! paths, but a survivor set depends on which filters have been applied, not on their
order. So the trie is walked depth first over sets: a set that was met by another path is not visited again. In each set
the survivors are a persisted DataFrame, made from those of the set before by one more filter; one aggregation counts what
every filter not yet applied removes from them, by part, which are the edges that leave the set. On the way back the survivors
are let go, so that at most k sets are held at a time.

Documents are read once: what fails which filter is a narrow written table, on which all survivor sets rest. A lost executor's
survivors are made again from it.
"""

from __future__ import annotations

import uuid
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import WORD, cut, discard, shared_dir, word_count

#: Least words, least distinct words and most capitals (both as shares of a hundred), signs of markup.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SIGNS = 200, 50, 2, "[#$%&*|]"


def text_filters(text: Column) -> dict[str, Column]:
    """When a text, not null, fails: A too few words, B too few distinct ones, C too many capitals, D signs of markup."""
    words = word_count(text)
    return {
        "A": words < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), 0))) < MIN_DISTINCT * words,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_CAPITALS * F.char_length(text),
        "D": text.rlike(SIGNS),
    }


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: part, failures A to E, good, toxic, as a written table.

    E: a document of a smaller doc_id has the same text, found by the text's sha256. A null text is empty, a null source the
    part "". Documents equal in doc_id are documents of their own, none smaller than the other; a null doc_id is smaller than
    none and none is smaller than it. Of several labels of a document one of quality 1 makes it good, one of toxic 1 toxic;
    without labels it is neither."""
    text = F.coalesce("text", F.lit(""))
    marked = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), *[c.alias(k) for k, c in text_filters(text).items()])
    marked = cut(marked, "marked")
    copies = marked.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("c")).where("c > 1").drop("c")
    copies = cut(copies, "copies")  # so that both sides of the join are exchanges, of which Spark can split large ones
    label = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    out = marked.join(label, "doc_id", "left").join(copies, "digest", "left")
    no = F.lit(False)
    out = cut(out.select("part", "A", "B", "C", "D", F.coalesce(F.col("doc_id") > F.col("least"), no).alias("E"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")), "failures")
    discard(marked)
    discard(copies)
    return out


def edges(failed: DataFrame, letters: str) -> DataFrame:
    """part, state (letters applied, in order), letter, alive (before), removed, good_lost, toxic_lost of every edge, as a
    written table. A part without survivors in a state has no row of it."""
    path = f"{shared_dir(failed.sparkSession)}/newsweir-edges-{uuid.uuid4().hex}"
    seen: set[str] = set()

    def visit(state: str, alive: DataFrame) -> None:
        seen.add(state)
        left = [x for x in letters if x not in state]
        after = {x: "".join(sorted(state + x)) for x in left}
        again = len(left) > 1 and not seen.issuperset(after.values())
        if again:
            alive.persist()
        lost = [F.struct(F.lit(x).alias("letter"), F.count_if(x).alias("removed"), F.count_if(F.col(x) & F.col("good")).alias("good_lost"), F.count_if(F.col(x) & F.col("toxic")).alias("toxic_lost")) for x in left]
        counts = alive.groupBy("part").agg(F.count("*").alias("alive"), F.array(*lost).alias("lost"))
        counts.select("part", F.lit(state).alias("state"), "alive", F.inline("lost")).write.mode("append").parquet(path)
        for x in left:
            if len(left) > 1 and after[x] not in seen:
                visit(after[x], alive.where(~F.col(x)))
        if again:
            alive.unpersist()

    visit("", failed)
    out = failed.sparkSession.read.parquet(path)
    out.__dict__["_written_to"] = path
    return out


def audited(failed: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters (filter_order) and step, with counts of the part's documents: kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley.

    `failed` has part, one boolean column for each letter, good and toxic, none of them null. Parts have all orders and steps,
    zeros included; an empty table gives an empty one. There are k! orders and 2^k states: k is 7 at most."""
    if not 0 < len(letters) <= 7 or len(set(letters)) < len(letters):
        raise ValueError("from one to seven different letters")
    k, walked = len(letters), edges(failed, letters)
    fails = F.array(*[F.col(x).cast("int") for x in letters])
    only = F.aggregate(fails, F.lit(0), lambda a, b: a + b) == 1
    each = [F.struct(F.lit(x).alias("letter"), F.count_if(x).alias("fails"), F.count_if(F.col(x) & only).alias("only")) for x in letters]
    parts = failed.groupBy("part").agg(F.map_from_entries(F.array(*[F.struct(x["letter"], x) for x in each])).alias("own"))
    # an edge lies on as many orders as there are of the filters before it times those after it
    size = F.length("state")
    weight = F.element_at(F.lit([factorial(s) * factorial(k - 1 - s) for s in range(k)]), size + 1)
    of = F.map_from_entries(F.collect_list(F.struct(F.concat("state", F.lit(">"), "letter"), F.struct("alive", "removed", "good_lost", "toxic_lost")))).alias("edge")
    shapley = F.map_from_entries(F.array(*[F.struct(F.lit(x), F.coalesce(F.sum(F.when(F.col("letter") == x, F.col("removed") * weight)), F.lit(0))) for x in letters])).alias("shapley")
    parts = cut(parts.join(walked.groupBy("part").agg(of, shapley), "part"), "parts")
    discard(walked)
    orders = ["".join(x) for x in permutations(sorted(letters))]
    out = parts.withColumn("filter_order", F.explode(F.lit(orders))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    out = out.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    before = F.array_join(F.array_sort(F.split(F.substring("filter_order", F.lit(1), F.col("step") - 1), "")), "")
    out = out.withColumn("e", F.col("edge")[F.concat(before, F.lit(">"), "letter")]).withColumn("o", F.col("own")[F.col("letter")])
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "part", "filter_order", "step", count(F.col("e.alive") - F.col("e.removed")).alias("kept"), count(F.col("e.removed")).alias("removed"), (F.col("o.fails") - count(F.col("e.removed"))).alias("redundant"),
        F.col("o.only").alias("unique_fails"), count(F.col("e.good_lost")).alias("good_lost"), count(F.col("e.toxic_lost")).alias("toxic_lost"), count(F.col("shapley")[F.col("letter")]).alias("shapley"),
    )
