"""Queries over the operators of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document's bytes without strings of 200 bytes that start elsewhere too."""
    from .suffix_dedup import without_repeats

    return without_repeats(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix with target weights takes from every document."""
    from .mixing import mixed_sizes

    return mixed_sizes(table(spark, sf_dir, "documents")).drop("times")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    from .near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from .html_text import extracted

    return extracted(table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from the token files."""
    from .token_files import token_files

    return token_files(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold items of the benchmark."""
    from .decontam import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    from .token_counts import section_tokens

    return section_tokens(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document's words without windows of 35 words that start elsewhere too."""
    from .substring_dedup import without_repeats

    return without_repeats(table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    from .vector_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    from .langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without lines that many documents hold."""
    from .line_dedup import without_common_lines

    out = without_common_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut in three and put together for filling in the middle."""
    from .fill_middle import fill_middle, restored

    out = fill_middle(table(spark, sf_dir, "documents"))
    back = F.sha2(restored(F.col("output"), F.col("form")), 256)
    return out.select("doc_id", "n", "form", F.col("prefix_n").alias("prefix_chars"), F.col("middle_n").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"), back.alias("restored_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their orders, by source."""
    from .filter_audit import audited, failures

    return audited(failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries op<N>_<name> of the subpackage."""
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express."""
    return {"op6_decontamination": OP6, "op2_mixing": OP2, "op1_suffix_array_dedup": OP1, "op8_substring_dedup": OP8, "op9_embedding_near_dedup": OP9, "op11_line_dedup": OP11, "op12_fill_in_middle": OP12, "op13_filter_audit": OP13}


OP6 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS s FROM d),
bs AS (SELECT DISTINCT item_id, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS s FROM b),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
p AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_list,
       max(CAST(n_shared AS DOUBLE) / n_item) AS containment
FROM p JOIN n USING (item_id) WHERE CAST(n_shared AS DOUBLE) / n_item >= 0.8 GROUP BY doc_id
"""

_PRIMES = "[999983, 999979, 999961, 999959, 999953, 999931, 999917, 999907]"


def _permuted(index: str, n: str, seed: str) -> str:
    h = f"CAST('0x' || substr(md5({seed}), 1, 7) AS BIGINT)"
    p = [f"CAST({_PRIMES}[({h} + {k}) % 8 + 1] AS BIGINT)" for k in range(3)]
    mul = f"CASE WHEN {n} % {p[0]} <> 0 THEN {p[0]} WHEN {n} % {p[1]} <> 0 THEN {p[1]} ELSE {p[2]} END"
    return f"((({mul}) * ({index}) + {h}) % {n})"


OP2 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rn FROM s),
s2 AS (SELECT *, CASE rn % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 2 * source_size::DOUBLE AS cap FROM s1),
s3 AS (SELECT *, cap / w AS key FROM s2),
s4 AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY key, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY key, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM s3),
lv AS (SELECT level FROM s4 WHERE level <= key ORDER BY key, rn LIMIT 1),
s5 AS (SELECT s4.*, least(cap, coalesce((SELECT level FROM lv) * w, cap)) AS target FROM s4),
s6 AS (SELECT *, CAST(ceil(source_size / 32.0::DOUBLE) AS BIGINT) AS blocks FROM s5),
s7 AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(2 * blocks, CAST(floor(target * blocks / source_size + 0.5) AS BIGINT)) END AS slots FROM s6),
s8 AS (SELECT *, coalesce(sum(slots) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM s7),
tot AS (SELECT sum(slots)::BIGINT AS n FROM s8),
line AS (SELECT g, CAST('0x' || substr(md5('mix-' || (g // 4096) || '-' || (g % 4096)), 1, 15) AS BIGINT) % n AS q FROM (SELECT unnest(range(0, n)) AS g, n FROM tot)),
draw AS (SELECT rn, row_number() OVER (PARTITION BY rn ORDER BY g) - 1 AS j FROM line JOIN s8 ON q >= first AND q < first + slots),
cnt AS (SELECT s8.rn, blocks, slots, count(j)::BIGINT AS n FROM s8 LEFT JOIN draw ON draw.rn = s8.rn GROUP BY ALL),
c2 AS (SELECT *, greatest(0, n - slots) AS over, greatest(0, slots - n) AS lack FROM cnt),
c3 AS (SELECT *, coalesce(sum(over) OVER w, 0)::BIGINT AS over_at, coalesce(sum(lack) OVER w, 0)::BIGINT AS lack_at FROM c2 WINDOW w AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
x AS (SELECT rn, blocks, n, over_at, j, j * over // n AS gone, (j + 1) * over // n AS gone_too FROM draw JOIN c3 USING (rn)),
drawn AS (SELECT rn, blocks, CASE WHEN n > 2 * blocks THEN j - gone ELSE j END AS k FROM x WHERE gone = gone_too
          UNION ALL SELECT c3.rn, c3.blocks, c3.n + x.over_at + x.gone - c3.lack_at FROM x JOIN c3 ON x.over_at + x.gone >= c3.lack_at AND x.over_at + x.gone < c3.lack_at + c3.lack WHERE x.gone < x.gone_too),
slot AS (SELECT rn, {_permuted("k % blocks", "blocks", "'mix-' || rn || '-' || (k // blocks)")} AS block FROM drawn),
times AS (SELECT rn, block, count(*) AS times FROM slot GROUP BY rn, block),
placed AS (SELECT doc_id, size, rn, (sum(size) OVER (PARTITION BY d.source ORDER BY CAST('0x' || substr(md5('place-' || doc_id), 1, 8) AS BIGINT) % (SELECT greatest(4096, count(*) // 16384) FROM documents), doc_id) - size)::BIGINT AS pos
           FROM d JOIN s8 ON d.source IS NOT DISTINCT FROM s8.source),
cuts AS (SELECT *, unnest(range(pos // 32, (pos + size - 1) // 32 + 1)) AS block FROM placed WHERE size > 0),
got AS (SELECT doc_id, sum((least(size, (c.block + 1) * 32 - pos) - greatest(0, c.block * 32 - pos)) * coalesce(times, 0))::BIGINT AS taken
        FROM cuts c LEFT JOIN times t ON t.rn = c.rn AND t.block = c.block GROUP BY doc_id)
SELECT d.doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM d JOIN s8 ON d.source IS NOT DISTINCT FROM s8.source LEFT JOIN got ON got.doc_id = d.doc_id
"""

# windows of 200 bytes, by position from 1
OP1 = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
win AS (SELECT doc_id, i, md5(hex(b[i:i + 199])) AS k FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS i FROM d)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
hit AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM win JOIN rep USING (k)),
run AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + 199 AS z FROM run GROUP BY doc_id, r),
gap AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
kept AS (SELECT d.doc_id, coalesce(string_agg(CASE WHEN g.a > g.before + 1 THEN hex(d.b[g.before + 1:g.a - 1]) ELSE '' END, '' ORDER BY g.a), '') AS h, coalesce(max(g.z), 0) AS z, count(g.a) AS n, coalesce(sum(g.z - g.a + 1), 0) AS gone
         FROM d LEFT JOIN gap g USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, gone::BIGINT AS n_removed, n AS n_spans,
       sha256(unhex(h || CASE WHEN octet_length(b) > z THEN hex(b[z + 1:octet_length(b)]) ELSE '' END)) AS kept_sha256
FROM d JOIN kept USING (doc_id)
"""

OP8 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win JOIN rep USING (k)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN cov USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) BETWEEN 0.9 AND 2),
r(id, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept FROM v JOIN m ON id = vec_id LEFT JOIN n ON a = vec_id
"""

OP11 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
line AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
cut AS (SELECT *, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
often AS (SELECT key, max(doc_id) AS last FROM cut WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, chr(10) ORDER BY p) AS t FROM cut LEFT JOIN often USING (key) WHERE last IS NULL OR last = doc_id GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_lines, (len(w) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || doc_id) AS h FROM documents),
g AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS u, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS v, CAST('0x' || h[17:24] AS BIGINT) % 100 AS r, CAST('0x' || h[25:32] AS BIGINT) % 100 AS s FROM d),
f AS (SELECT *, least(u, v) AS a, greatest(u, v) AS b, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r >= 90 THEN 'plain' WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
o AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS z FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM o
"""

OP13 = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
e AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
f AS (SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (doc_id > least)::INT AS fails,
        coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM d JOIN e USING (t) LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS c, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
parts AS (SELECT DISTINCT part FROM g),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o(filter_order, mask) AS (SELECT '', 0 UNION ALL SELECT filter_order || letter, mask + bit FROM o JOIN x ON mask & bit = 0),
steps AS (SELECT o.filter_order, step, letter, bit, (SELECT coalesce(sum(y.bit), 0) FROM x y WHERE instr(substring(o.filter_order, 1, step - 1), y.letter) > 0)::INT AS before
          FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM o WHERE mask = 31) o JOIN x ON letter = substring(o.filter_order, step, 1)),
s AS (SELECT part, filter_order, step, letter, coalesce(sum(c) FILTER (fails & (before | bit) = 0), 0)::BIGINT AS kept,
        coalesce(sum(c) FILTER (fails & before = 0 AND fails & bit > 0), 0)::BIGINT AS removed, coalesce(sum(c) FILTER (fails & before > 0 AND fails & bit > 0), 0)::BIGINT AS redundant,
        coalesce(sum(c) FILTER (fails = bit), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (fails & before = 0 AND fails & bit > 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & bit > 0), 0)::BIGINT AS toxic_lost FROM parts JOIN g USING (part) CROSS JOIN steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM s
"""
