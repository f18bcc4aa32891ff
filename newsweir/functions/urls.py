"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: query parameters that only track
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "yclid", "gclid", "fbclid", "mc_cid", "mc_eid", "ref", "ref_src"]
# fixed values: parts of links that never lead to a source
JUNK = [
    "facebook.com/sharer/", "facebook.com/share/", "twitter.com/intent/", "twitter.com/share", "t.me/share", "vk.com/share", "linkedin.com/share", "pinterest.com/pin/create", "wa.me/",
    "api.whatsapp.com/send", "ok.ru/share", "reddit.com/submit", "/print/", "?print=", "/print.html", "mailto:", "/email-this", "/sendtofriend", "/login", "/signin", "/sign-in", "/auth/", "/oauth",
    "/register", "/signup", "/sign-up", "/contact", "/contacts", "/contact-us", "/contact.html", "/feedback", "/support", "doubleclick.net", "googleadservices", "google.com/url?",
    "googletagmanager.com", "ga4-", "/redir?", "/redirect?", "/click?", "/r.php?", "/search?", "/search/", "?q=",
]
_WITH_HOST = ["http", "https", "ftp", "file", "ws", "wss"]
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


#: All white space of Unicode.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(x: Column) -> Column:
    """Without white space at both ends, no-break spaces included."""
    return F.btrim(x, F.lit(SPACES))


def part(url: Column, k: int) -> Column:
    """1 scheme, 2 host with port, 3 path, 4 query of a URL; empty if not there."""
    return F.regexp_extract(url, _SPLIT, k)


def netloc(url: Column) -> Column:
    """Lower-case host, port and user as they stand."""
    return F.lower(part(url, 2))


def _decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def _encoded(x: Column) -> Column:
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical(url: Column) -> Column:
    """Lower-case scheme (https if none) and host, no default port, no tracking parameters, no fragment, an empty path as /.

    A URL without a host keeps its path: https:///path, or mailto:name where the scheme has no host. Null for null."""
    u = strip(url)
    scheme = F.coalesce(F.nullif(F.lower(part(u, 1)), F.lit("")), F.lit("https"))
    host = F.when(scheme == "http", F.regexp_replace(netloc(u), ":80$", "")).when(scheme == "https", F.regexp_replace(netloc(u), ":443$", "")).otherwise(netloc(u))
    path = F.coalesce(F.nullif(part(u, 3), F.lit("")), F.lit("/"))
    pairs = F.filter(F.split(part(u, 4), "&"), lambda x: x != "")
    named = F.transform(pairs, lambda x: F.struct(_decoded(F.regexp_extract(x, "^([^=]*)", 1)).alias("k"), _decoded(F.regexp_extract(x, "^[^=]*=(.*)$", 1)).alias("v")))
    kept = F.filter(named, lambda x: ~F.lower(x["k"]).isin(TRACKING))
    query = F.array_join(F.transform(kept, lambda x: F.concat(_encoded(x["k"]), F.lit("="), _encoded(x["v"]))), "&")
    slashes = (host != "") | F.startswith(path, F.lit("//")) | (scheme.isin(_WITH_HOST) & F.startswith(path, F.lit("/")))
    return F.concat(scheme, F.when(slashes, "://").otherwise(":"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def url_hash(url: Column) -> Column:
    """sha256 of the canonical URL, hex."""
    return F.sha2(canonical(url), 256)


def domain(url: Column) -> Column:
    """Host without www."""
    return F.regexp_replace(netloc(url), r"^www\.", "")


def bare_domain(d: Column) -> Column:
    """A host without one of www., m. or amp."""
    return F.regexp_replace(F.lower(d), r"^(?:www|m|amp)\.", "")


def host_in(d: Column, hosts: list[str]) -> Column:
    """Whether a host is one of `hosts` or below it, both without www., m. or amp."""
    import re

    bare = sorted({re.sub(r"^(?:www|m|amp)\.", "", h.lower()) for h in hosts})
    if not bare:
        return F.lit(False)
    n = bare_domain(d)
    return F.exists(F.array(*map(F.lit, bare)), lambda h: (n == h) | F.endswith(n, F.concat(F.lit("."), h)))


def is_junk(url: Column, fragments: list[str] = JUNK) -> Column:
    """Whether a link is empty, has a junk fragment, or no path."""
    low = F.lower(url)
    bad = F.exists(F.array(*map(F.lit, fragments)), lambda f: F.contains(low, f))
    return F.coalesce((url == "") | bad | (F.regexp_replace(part(url, 3), "/+$", "") == ""), F.lit(True))


def looks_like_article(url: Column, hints: list[str]) -> Column:
    """Whether the path has one of `hints`, or a last segment of three hyphens or more."""
    path = F.lower(part(url, 3))
    bare = F.regexp_replace(path, "/+$", "")
    last = F.element_at(F.split(bare, "/"), -1)
    return (bare != "") & (F.exists(F.array(*map(F.lit, hints)), lambda h: F.contains(path, h)) | (F.regexp_count(last, F.lit("-")) >= 3))


def path_pattern(url: Column) -> Column:
    """The shape of the first four path segments: YYYY, NN, _id_, _slug_ or the segment."""
    segments = F.slice(F.filter(F.split(part(url, 3), "/"), lambda s: s != ""), 1, 4)
    shape = lambda s: (
        F.when(s.rlike(r"^20\d{2}$"), "YYYY").when(s.rlike(r"^\d{1,2}$"), "NN").when(s.rlike("^(?:[0-9a-f-]{8,}|[0-9]+)$"), "_id_").when(F.contains(s, F.lit("-")) | (F.length(s) > 20), "_slug_").otherwise(s)
    )
    return F.concat(F.lit("/"), F.array_join(F.transform(segments, shape), "/"))


def without_generic_image(url: Column, fragments: list[str]) -> Column:
    """Empty if an image URL has a fragment of a generic image."""
    return F.when(F.exists(F.array(*map(F.lit, fragments)), lambda f: F.contains(F.lower(url), f)), "").otherwise(url)


def route(url: Column, browser: list[str], impersonated: list[str]) -> Column:
    """How a URL is fetched: the first list that has its host, else http."""
    d = netloc(url)
    return F.when(host_in(d, browser), "browser").when(host_in(d, impersonated), "impersonated").otherwise("http")


def channel_preview(url: Column) -> Column:
    """The preview page of a public channel link, null for invitations and links without a name."""
    name = F.regexp_extract(url, r"^(?:https?://)?(?:www\.)?t\.me/(?:s/)?([^/?#]*)", 1)
    return F.when((name != "") & ~F.startswith(name, F.lit("+")), F.concat(F.lit("https://t.me/s/"), name))
