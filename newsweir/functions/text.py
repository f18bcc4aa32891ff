"""Text functions as column expressions, and fuzzy similarity as an Arrow function."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .urls import strip

#: Cells of the table of matches of a batch of pairs at once.
MATCHES, KINDS = 1 << 18, 64
#: Pairs whose words are held at once, however many Spark hands over.
PAIRS = 1 << 11
# fixed values: what titles lose, or have replaced, before they are compared
LAST_TAG, ANY_TAG = (r"(?U)\([a-zа-я]{2,4}\)\s*$", ""), (r"\([a-zа-яё]{2,4}\)", "")
EN_PREFIX, RU_PREFIX, RU_LINE = (r"(?U)^en:\s*", ""), (r"(?U)^ru:\s*", ""), (r"(?U)\n\s*ru:\s*", " | ")
LAST_PART, FEED_LAST_PART = (r"(?U)\s*[—\-|]\s*[a-zа-я0-9 .&]+$", ""), (r"[—\-|]\s*[a-zа-я0-9 .&]+$", "")
SPACES = (r"(?U)\s+", " ")
_SUFFIX = r"(?U)\s*[–—\-|]\s+[^|–—\-]+$"


def first_line(text: Column, most: int = 220) -> Column:
    """The trimmed first line, cut to `most` characters."""
    return strip(F.substring(F.substring_index(text, "\n", 1), 1, most))


def normalised_title(title: Column) -> Column:
    """Lower case, without up to two trailing site names unless under 20 characters would remain. Null is empty."""
    t = strip(F.coalesce(title, F.lit("")))
    one = strip(F.regexp_replace(t, _SUFFIX, ""))
    two = strip(F.regexp_replace(one, _SUFFIX, ""))
    return F.lower(F.when((one == t) | (F.length(one) < 20), t).when((two == one) | (F.length(two) < 20), one).otherwise(two))


def _without(text: Column, *steps: tuple[str, str]) -> Column:
    """A lower-case text after replacements one after another, with white space as one space and trimmed."""
    t = F.lower(F.coalesce(text, F.lit("")))
    for pattern, to in (*steps, SPACES):
        t = F.regexp_replace(t, pattern, to)
    return strip(t)


def cluster_title(title: Column) -> Column:
    """The form in which stories are compared: lower case, without a language tag at the end, an EN: prefix (RU: lines
    follow after a bar) or the last part of letters and digits after a dash or bar, white space as one space."""
    return _without(title, LAST_TAG, EN_PREFIX, RU_LINE, LAST_PART)


def feed_title(title: Column) -> Column:
    """The form in which stories are compared with a feed: as cluster_title, but without any language tag and RU: prefix."""
    return _without(title, EN_PREFIX, RU_LINE, RU_PREFIX, ANY_TAG, FEED_LAST_PART)


def without_tags(html: Column) -> Column:
    """Tags as spaces, trimmed."""
    return strip(F.regexp_replace(html, "<[^>]+>", " "))


def without_language_tag(title: Column) -> Column:
    """Without a trailing (XX)."""
    return F.regexp_replace(title, r"(?U)\s*\([A-ZА-ЯЁ]{2,4}\)\s*$", "")


def language_lines(title: Column, last: bool = True) -> Column:
    """The EN: and RU: lines of a combined title, of several the last (or the first); all of it as en if there is no prefix."""
    lines = F.split(F.coalesce(title, F.lit("")), "\n")
    of = lambda p: F.filter(lines, lambda x: F.startswith(x, F.lit(p)))
    line = lambda p: strip(F.coalesce(F.substr(F.try_element_at(of(p), F.lit(-1 if last else 1)), F.lit(4)), F.lit("")))
    some = (F.size(of("EN:")) > 0) | (F.size(of("RU:")) > 0)
    return F.struct(F.when(some, line("EN:")).otherwise(strip(F.coalesce(title, F.lit("")))).alias("en"), F.when(some, line("RU:")).otherwise("").alias("ru"))


def clean_title(title: Column) -> Column:
    """The title to ask a model about again: the first EN: line, without a language tag, or all of it if there is none."""
    return without_language_tag(language_lines(title, last=False)["en"])


def combined_title(en: Column, ru: Column, tag: Column, most: int = 220) -> Column:
    """EN and RU lines, each cut to `most` characters (220 in reports, 400 for imported answers), with a language tag unless
    it is empty. An empty or null line is left out."""
    end = F.when(F.coalesce(tag, F.lit("")) != "", F.concat(F.lit(" ("), tag, F.lit(")"))).otherwise("")
    line = lambda p, x: F.when(F.coalesce(x, F.lit("")) != "", F.concat(F.lit(f"{p}: "), F.substring(x, 1, most), end))
    return F.concat_ws("\n", line("EN", en), line("RU", ru))


def localised_title(en: Column, ru: Column, language: Column) -> Column:
    """The title of a published row: both languages in one line, and the source's language."""
    return F.concat(en, F.lit(" / "), ru, F.lit(" ("), F.upper(language), F.lit(")"))


def prompt_hash(*parts: Column) -> Column:
    """Sixteen hex digits of the sha256 of the parts, a line break after each."""
    return F.substring(F.sha2(F.concat(*[F.concat(p, F.lit("\n")) for p in parts]), 256), 1, 16)


def year_drift(en: Column, ru: Column) -> Column:
    """Years that only one of two titles has, ascending."""
    years = lambda x: F.array_distinct(F.regexp_extract_all(x, F.lit(r"\b(20\d{2})\b")))
    return F.array_sort(F.array_union(F.array_except(years(en), years(ru)), F.array_except(years(ru), years(en))))


def future_past(title: Column, body: Column, verbs: list[str], year: int) -> Column:
    """The least year before `year` that a text speaks of in the future tense, by one of `verbs`; null if there is none."""
    text = F.lower(F.concat_ws("\n", title, body))
    told = F.exists(F.array(*map(F.lit, verbs)), lambda v: F.contains(text, v)) if verbs else F.lit(False)
    years = F.transform(F.regexp_extract_all(text, F.lit(r"\b(20\d{2})\b")), lambda y: y.cast("int"))
    return F.when(told, F.array_min(F.filter(years, lambda y: y < year)))


def truthy(x: Column) -> Column:
    """A flag from text; null is false."""
    return F.coalesce(F.lower(strip(x)).isin("1", "true", "yes", "y", "да", "истина", "on"), F.lit(False))


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of many pairs at once, a bit per character of b, in words of 64."""
    n, la, lb = len(a), np.array([len(x) for x in a]), np.array([len(x) for x in b])
    out = np.zeros(n, np.int64)
    chars = np.frombuffer("".join([*a, *b]).encode("utf-32-le", "surrogatepass"), np.uint32)
    there = np.zeros(int(chars.max(initial=0)) + 1, bool)
    there[chars] = True
    coded = (np.cumsum(there) - 1)[chars]
    many, words = int(there.sum()), int(lb.max(initial=0)) // 64 + 1
    starts_a, starts_b = np.cumsum(la) - la, int(la.sum()) + np.cumsum(lb) - lb
    step = max(1, MATCHES // ((many + 1) * words))
    for lo in range(0, n, step):
        own_a, own_b = la[lo : lo + step], lb[lo : lo + step]
        rows = np.arange(len(own_a)) * (many + 1)

        def codes(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
            """Where each character's matches stand, a row for each place; the last of a pair's is of no character."""
            k = np.arange(int(size.max(initial=0)))[:, None]
            return rows + np.where(k < size, coded[np.minimum(starts + k, len(coded) - 1)] if len(coded) else many, many)

        match = np.zeros((words, len(rows) * (many + 1)), np.uint64)
        for k, at in enumerate(codes(starts_b[lo : lo + step], own_b)):
            match[k // 64, at] |= np.uint64(1 << k % 64)
        match[:, rows + many] = 0
        bits = np.clip(own_b - 64 * np.arange(words)[:, None], 0, 64)
        full = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(bits, 63).astype(np.uint64)) - np.uint64(1))
        state = full.copy()
        for at in codes(starts_a[lo : lo + step], own_a):
            carry = None
            for w in range(words):
                hit = state[w] & match[w, at]
                total = state[w] + hit
                more = total < hit
                if carry is not None:
                    total += carry
                    more |= total < carry
                carry = more.astype(np.uint64)
                state[w] = total | (state[w] ^ hit)
        out[lo : lo + step] = own_b - np.bitwise_count(state & full).sum(0, dtype=np.int64)
    return out


def set_ratios(a: list[str | None], b: list[str | None], least: float = 0.0) -> np.ndarray:
    """Similarity, 0 to 100, of pairs of texts as sets of words, case-sensitive; 0 if either is empty. Ratios below `least`
    may be 0.

    Words and characters of each text are counted once. Where two texts have too few characters in common, wherever they stand, for
    the ratio in question, their common subsequence isn't sought."""
    place: dict[str, int] = {}
    ia, ib = (np.array([place.setdefault(x or "", len(place)) for x in side], np.int64) for side in (a, b))
    words = [set(x.split()) for x in place]
    joined = [" ".join(w) for w in words]
    size = np.array([len(x) for x in joined], np.int64)
    chars = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32) % KINDS  # what shares a number looks alike
    counts = np.bincount(np.repeat(np.arange(len(joined)), size) * KINDS + chars, minlength=len(joined) * KINDS).reshape(-1, KINDS).astype(np.int32)
    common = np.concatenate([np.minimum(counts[ia[k : k + 4096]], counts[ib[k : k + 4096]]).sum(1) for k in range(0, len(ia), 4096)] or [np.zeros(0, np.int64)])
    near = (200 * common >= least * (size[ia] + size[ib])).tolist()
    out, later = np.zeros(len(a)), []
    for k, (p, q) in enumerate(zip(ia.tolist(), ib.tolist(), strict=True)):
        x, y = words[p], words[q]
        if not x or not y:
            continue
        both = x & y
        if len(both) == len(x) or len(both) == len(y):
            out[k] = 100.0
            continue
        i, gap = 0, 0
        if both:
            i, gap = sum(map(len, both)) + len(both) - 1, 1
        total = int(size[p] + size[q])  # of what is common and what is of one text alone, and the spaces between
        d, e = int(size[p]) - i - gap, int(size[q]) - i - gap
        if both:
            out[k] = max(100 - 100 * (gap + d) / (2 * i + gap + d), 100 - 100 * (gap + e) / (2 * i + gap + e))
        if near[k] and not out[k] >= least > 0:
            later.append((k, d, e, total, " ".join(sorted(x - both)), " ".join(sorted(y - both))))
    if later:
        k, d, e, total = (np.array([x[c] for x in later]) for c in range(4))
        out[k] = np.maximum(out[k], 100 - 100 * (d + e - 2 * lcs_lengths([x[4] for x in later], [x[5] for x in later])) / total)
    return out


def set_ratio(a: str, b: str, least: float = 0.0) -> float:
    """`set_ratios` of one pair."""
    return float(set_ratios([a], [b], least)[0])


def token_set_ratio(least: float = 0.0):
    """A function of two columns: `set_ratio` of each row. Ratios below `least` may come as 0."""

    @F.pandas_udf(DoubleType())
    def ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in pairs:
            for k in range(0, len(a), PAIRS):
                yield pd.Series(set_ratios(a[k : k + PAIRS].tolist(), b[k : k + PAIRS].tolist(), least))

    return ratio
