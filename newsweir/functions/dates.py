"""Dates of articles as column expressions. Times are UTC: the session's time zone is to be UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: notations of times in order, the years that a date may have, and names of months
ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
FORMATS = ["yyyy-M-d HH:mm:ss", "yyyy-M-d", "yyyy/M/d", "d.M.yyyy HH:mm", "d.M.yyyy HH:mm:ss", "d.M.yyyy", "d/M/yyyy", "d-M-yyyy"]
MAIL_FORMATS = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss XXX", "d MMM yyyy HH:mm:ss 'GMT'", "d MMM yyyy HH:mm:ss 'UTC'", "d MMM yyyy HH:mm:ss"]
FIRST_YEAR, LAST_YEAR = 2015, 2030
MONTHS_RU = ["января", "февраля", "марта", "апреля", "мая", "июня", "июля", "августа", "сентября", "октября", "ноября", "декабря"]
MONTHS_EN = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
SHORT_EN = {"jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12}
IN_PATH = [r"/(\d{4})/(\d{1,2})/(\d{1,2})(?:/|$)", r"[/_-](\d{4})-(\d{1,2})-(\d{1,2})(?:[/_.-]|$)", r"/(\d{4})(\d{2})(\d{2})/"]

_NUMBER_RU = {m: k + 1 for k, m in enumerate(MONTHS_RU)}
_NUMBER_EN = {m: k + 1 for k, m in enumerate(MONTHS_EN)} | SHORT_EN


def parsed(x: Column) -> Column:
    """A timestamp from text: ISO with Z, an offset or neither, one of FORMATS, or the notation of mails, with a weekday (that
    isn't checked) or without. Without an offset it is UTC; null if none fits."""
    t = F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    mail = F.regexp_replace(t, r"^[A-Za-z]{3},\s+", "")
    iso = F.regexp_replace(F.when(t.rlike(ISO), t), r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.coalesce(F.try_to_timestamp(iso), *[F.try_to_timestamp(t, F.lit(f)) for f in FORMATS], *[F.try_to_timestamp(mail, F.lit(f)) for f in MAIL_FORMATS])


def _date(y: Column, m: Column, d: Column) -> Column:
    """Midnight of a day, null if the year is out of range or there is no such day."""
    made = F.try_to_timestamp(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd"))
    return F.when(y.try_cast("int").between(FIRST_YEAR, LAST_YEAR), made)


def from_url(url: Column) -> Column:
    """The date in a URL's path: /2026/04/27/, -2026-04-27 between separators, /20260427/. Of each notation the first match
    counts; one that is no date leaves it to the next notation."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.coalesce(*[_date(*(F.regexp_extract(path, p, k) for k in (1, 2, 3))) for p in IN_PATH])


def _named(text: Column, pattern: str, months: dict[str, int], order: tuple[int, int, int]) -> Column:
    """The first match of a notation with a month's name; `order` has the groups of year, month and day."""
    number = F.create_map(*[F.lit(str(x)) for kv in months.items() for x in kv])
    y, m, d = (F.regexp_extract(text, pattern, k) for k in order)
    return _date(y, F.try_element_at(number, F.lower(m)), d)


def from_text(title: Column, body: Column, most: int = 1500) -> Column:
    """The date in a title and the start of a body: of each notation (Russian, English with the month first, English with the
    day first, numbers with dots or slashes, ISO) the first match alone; one that is no date leaves it to the next notation."""
    t = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.substring(F.coalesce(body, F.lit("")), 1, most))
    ru, en = "|".join(MONTHS_RU), "|".join([*MONTHS_EN, *SHORT_EN])
    numbers = lambda p, y, m, d: _date(*(F.regexp_extract(t, p, k) for k in (y, m, d)))
    return F.coalesce(
        _named(t, rf"(?iuU)\b(\d{{1,2}})\s+({ru})\s+(\d{{4}})\b", _NUMBER_RU, (3, 2, 1)),
        _named(t, rf"(?iuU)\b({en})\.?\s+(\d{{1,2}}),?\s+(\d{{4}})\b", _NUMBER_EN, (3, 1, 2)),
        _named(t, rf"(?iuU)\b(\d{{1,2}})\s+({en})\.?\s+(\d{{4}})\b", _NUMBER_EN, (3, 2, 1)),
        numbers(r"(?U)\b(\d{1,2})[./](\d{1,2})[./](\d{4})\b", 3, 2, 1),
        numbers(r"(?U)\b(\d{4})-(\d{2})-(\d{2})\b", 1, 2, 3),
    )


def published(*found: Column) -> Column:
    """The first date of a cascade (meta data, URL, text, feed)."""
    return F.coalesce(*found)


def is_fresh(when: Column, hours: int, now: datetime) -> Column:
    """At most `hours` old; without a date, or in the future, fresh."""
    return when.isNull() | (when >= F.lit(now) - F.expr(f"interval {int(hours)} hours"))


def hours_or(asked: int | None, default: int) -> int:
    """The span of freshness that was asked for; none and 0 mean the default."""
    return asked or default
