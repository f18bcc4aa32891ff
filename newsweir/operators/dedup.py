"""Candidates, duplicates within a run and against what was seen, and the state of seen articles."""

from __future__ import annotations

from datetime import datetime
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import is_fresh
from ..functions.similar import similar
from ..functions.text import token_set_ratio
from ..functions.urls import canonical, domain, url_hash
from ..storage import cut, discard, partitions

if TYPE_CHECKING:
    from .title_index import TitleIndex

#: Titles of a group, at least and at most, groups between; and those of a slot of time, at least, and groups between.
TILE_LEAST, TILE_MOST, TILES, SLOT_LEAST, SLOT_TILES = 512, 32768, 16, 2048, 6
#: Titles of a side that all tiles get, at most; then titles of a tile, at most, and tiles.
FEW, FEW_MOST, FEW_TILES = 2048, 8192, 64


def candidates(articles: DataFrame) -> DataFrame:
    """Articles with a URL and a title, with canonical_url, url_hash and source_domain."""
    x = articles.where((F.coalesce("url", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != ""))
    return x.withColumns({"canonical_url": canonical(F.col("url")), "url_hash": url_hash(F.col("url")), "source_domain": domain(F.col("url"))})


def first_of(df: DataFrame, key: list[str | Column], order: list[str | Column], n: int = 1) -> DataFrame:
    """The first `n` rows of each key. With `n` rows wanted Spark limits each partition before the shuffle."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def fresh_candidates(articles: DataFrame, hours: int, now: datetime) -> DataFrame:
    """Fresh candidates, the first in `seq` of each URL: only a fresh copy takes a URL's place."""
    x = candidates(articles).where(is_fresh(F.col("published_at"), hours, now))
    return first_of(x, ["url_hash"], ["seq"])


def unseen(found: DataFrame, seen: DataFrame, portal: str | None = None) -> DataFrame:
    """Rows whose url_hash isn't among those seen, whatever the portal unless one is given."""
    known = seen if portal is None else seen.where(F.col("portal") == portal)
    return found.join(known.select("url_hash").distinct(), "url_hash", "left_anti")


def restored(found: DataFrame, seen: DataFrame, portal: str, key: str = "url_hash") -> DataFrame:
    """Rows with what an earlier run of the portal cached for their URL (cached), and whether it decides (from_cache). Another
    `key` tells captures of one URL apart. Of several rows cached under one key the last seen counts, so no row comes out twice."""
    last = [c for c in ("last_seen_at",) if c in seen.columns]
    known = seen.where((F.col("portal") == portal) & F.col("cached").isNotNull()).groupBy(key).agg(F.max(F.struct(*last, "cached")).alias("_k")).select(key, "_k.cached")
    x = found.join(known, key, "left")
    return x.withColumn("from_cache", F.coalesce(F.col("cached")["section"].isNotNull() | F.col("cached")["verdict"].isin("not_article", "off_topic"), F.lit(False)))


def upserted(seen: DataFrame, run: DataFrame, key: str = "url_hash") -> DataFrame:
    """The state after a run: new URLs are added; of those there, last_seen_at is that of the run and the cache that of
    the run if it has one. Title, portal and first_seen_at stay. One row per url_hash on each side, or per another `key`, as
    where captures of one URL are kept apart."""
    s, r = seen.withColumn("_there", F.lit(True)).alias("s"), run.alias("r")
    x = s.join(r, F.col(f"s.{key}") == F.col(f"r.{key}"), "full_outer")
    keep = [c for c in seen.columns if c not in ("last_seen_at", "cached_row_json")]
    newer = [F.coalesce("r.last_seen_at", "s.last_seen_at").alias("last_seen_at"), F.coalesce("r.cached_row_json", "s.cached_row_json").alias("cached_row_json")]
    return x.select(*[F.when(F.col("s._there"), F.col(f"s.{c}")).otherwise(F.col(f"r.{c}")).alias(c) for c in keep], *newer)


def weighed_tokens(titles: DataFrame) -> DataFrame:
    """tid, token, weight (its share of the title's characters) of the words of distinct titles (tid, title)."""
    words = F.array_distinct(F.filter(F.split("title", r"(?U)\s+"), lambda w: w != ""))
    x = titles.select("tid", words.alias("ws")).withColumn("n", F.aggregate("ws", F.lit(0), lambda s, w: s + F.length(w) + 1))
    return x.select("tid", "n", F.explode("ws").alias("token")).select("tid", "token", ((F.length("token") + 1) / F.col("n")).alias("weight"))


def ranked_tokens(tokens: DataFrame, often: DataFrame) -> DataFrame:
    """tid, token, before of weighed tokens: the share of a title in its commoner words and the token itself.
    `often` (token, df) says how common tokens are; one that isn't there is rarer than all."""
    order = Window.partitionBy("tid").orderBy(F.desc("df"), "token")
    x = tokens.join(often, "token", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    return x.select("tid", "token", F.coalesce(F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0)).alias("before"))


def is_rare(least: float) -> Column:
    """Whether two titles that reach a ratio of `least` by their common words may have to meet on a token: these are
    `least` / (200 - `least`) of one title, so its commonest tokens that together hold less aren't needed."""
    return F.col("before") >= least / (200 - least) - 1e-9


def searched(titles: DataFrame, least: float) -> DataFrame:
    """a, b, ratio of all pairs with a ratio of `least` or more of distinct titles (title, side: 1 for a, 2 for b, 3 for both).

    Titles are dealt to groups, and each two groups are a tile of one task, which tells the pairs that fall short by bounds that
    are proven (see `functions.similar`). So no candidates are written or shuffled, but each title as often as there are groups.
    Where one side has few titles, these go to all tiles, and each of the others to one."""
    r = titles.agg(F.count_if(F.col("side") != 2).alias("a"), F.count_if(F.col("side") != 1).alias("b"), F.count("*").alias("n")).first()
    n, few = r.n, min(r.a, r.b)
    if few <= FEW and n > 2 * FEW:
        mine, tiles = (1 if r.a == few else 2), -(-n // max(TILE_LEAST, min(FEW_MOST, n // FEW_TILES)))
        way = lambda side, second, tile: titles.where(F.col("side") != 3 - side).select(tile.alias("tile"), F.lit(False).alias("own"), F.lit(second).alias("second"), F.lit(side).alias("side"), "title")
        every = way(mine, False, F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)).cast("array<bigint>")))
        return _of_tiles(every.unionByName(way(3 - mine, True, F.pmod(F.xxhash64("title"), F.lit(tiles)))), least, tiles)
    groups = -(-n // max(TILE_LEAST, min(TILE_MOST, n // TILES))) or 1
    k, own = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))), F.pmod(F.xxhash64("title"), F.lit(groups)).cast("int")
    x = titles.select("title", "side", own.alias("g"), k.alias("k"))
    x = x.select((F.least("g", "k") * F.lit(groups).cast("long") + F.greatest("g", "k")).alias("tile"), (F.col("g") == F.col("k")).alias("own"), (F.col("g") > F.col("k")).alias("second"), "side", "title")
    return _of_tiles(x, least, groups * (groups + 1) // 2)


def searched_near(titles: DataFrame, least: float) -> DataFrame:
    """a, b of all pairs, a before b, with a ratio of `least` or more of titles (title, slot: a whole number, distinct) that
    have a slot in common or two that follow each other. Groups are of a slot, and only those of near slots make a tile."""
    sizes = titles.groupBy("slot").count().agg(F.count("*").alias("slots"), F.max("count").alias("most")).first()
    most = sizes.most or 0
    groups = -(-most // max(SLOT_LEAST, min(TILE_MOST, most // SLOT_TILES))) or 1
    own = F.pmod(F.xxhash64("title"), F.lit(groups)).cast("int")
    x = titles.select("title", "slot", own.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("k"))
    # with the groups of its slot, as the first with those of the next, as the second with those of the one before
    way = lambda slot, p, q, own, second: F.struct(*[v.alias(c) for v, c in ((slot, "slot"), (p, "p"), (q, "q"), (own, "own"), (second, "second"))])
    s, g, k, no = F.col("slot"), F.col("g"), F.col("k"), F.lit(False)
    ways = F.array(way(s, F.least(g, k), F.greatest(g, k), g == k, g > k), way(s, g + groups, k + groups, no, no), way(s - 1, k + groups, g + groups, no, ~no))
    x = x.select("title", F.inline(ways)).select(F.xxhash64("slot", "p", "q").alias("tile"), "own", "second", F.lit(3).alias("side"), "title")
    found = _of_tiles(x, least, sizes.slots * groups * (3 * groups + 1) // 2)
    return found.where("a < b").select("a", "b").distinct()


def _of_tiles(dealt: DataFrame, least: float, tiles: int) -> DataFrame:
    """a, b, ratio of the pairs of tiles (tile, own: one group with itself, second: whether a title is of the second group, side,
    title)."""

    def tile(key: tuple, rows: pa.Table) -> pa.Table:
        alone = key[1].as_py()
        side = lambda second, s: rows.filter((pc.field("second") == second) & (pc.field("side") == s))["title"].to_pylist()
        a, b = ({s: sorted(side(second, s)) for s in (1, 2, 3)} for second in (False, not alone))
        found = []
        # what is of both sides is compared once; a group with itself once
        ways = [(a[1], b[2] + b[3], 1), (a[3], b[2], 1)] + [(a[2], b[1] + b[3], 2), (a[3], b[1], 2)] * (not alone) + [(a[3], b[3], 3)]
        for p, q, to in ways:
            if p and q:
                at, of, ratio = similar(p, q, least, to == 3 and alone)
                one, two = [p[m] for m in at.tolist()], [q[m] for m in of.tolist()]
                found += [(one, two, ratio)] * (to != 2) + [(two, one, ratio)] * (to != 1)
        if alone:
            same = [t for t in a[3] if t.strip()]
            found.append((same, same, np.full(len(same), 100.0)))
        one, two, ratio = ([v for x in found for v in x[c]] for c in range(3))
        return pa.table({"a": pa.array(one, pa.string()), "b": pa.array(two, pa.string()), "ratio": pa.array(ratio, pa.float64())})

    dealt = dealt.repartition(max(partitions(dealt.sparkSession), min(tiles, 2000)), "tile", "own")
    return cut(dealt.groupBy("tile", "own").applyInArrow(tile, "a string, b string, ratio double"), "similar")


def title_pairs(left: DataFrame, right: DataFrame | TitleIndex, least: float, exact: bool = False) -> DataFrame:
    """a, b, ratio: the pairs of distinct titles of `left` and `right` (title, or an index of titles) with a ratio of `least`
    or more.

    No pair is lost, see `searched`. `exact` compares all pairs without bounds, block by block, to hold the search against."""
    if not isinstance(right, DataFrame):
        return right.pairs(left, least)
    l, r = (x.where("title <> ''").select("title").distinct().withColumn("tid", F.xxhash64("title")) for x in (left, right))
    titles = cut(l.withColumn("side", F.lit(1)).unionByName(r.withColumn("side", F.lit(2))).groupBy("tid").agg(F.min("title").alias("title"), F.sum("side").alias("side")), "titles")
    if exact:
        n = partitions(left.sparkSession)
        blocks = lambda d, p: d.select(F.col("title").alias(p), F.pmod("tid", F.lit(n)).alias(f"{p}_at"))
        one = blocks(titles.where("side <> 2"), "a").withColumn("b_at", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        x = one.join(blocks(titles.where("side <> 1"), "b"), "b_at").select("a", "b")
        return x.withColumn("ratio", token_set_ratio(least)("a", "b")).where(F.col("ratio") >= least)
    out = searched(titles, least)
    discard(titles)
    return out


def without_similar(found: DataFrame, titles: DataFrame | TitleIndex, threshold: float = 0.85) -> DataFrame:
    """Rows (with seq, title) but those whose title is similar to one of `titles` (title, or an index of titles). Empty titles
    match nothing."""
    right = titles.select("title") if isinstance(titles, DataFrame) else titles
    bad = title_pairs(found.select("title"), right, 100 * threshold).select(F.col("a").alias("title")).distinct()
    return found.join(bad, "title", "left_anti").select(*found.columns)
