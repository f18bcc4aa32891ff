"""Configuration files: sections, headers of source tables, overrides, brands, cues, trusted hosts, fetch quirks, blacklist.

A file is YAML (if the parser is installed) or JSON, read on the driver: these are lists that people keep by hand. A file
that isn't there, or is empty, gives empty values."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read(path: str | Path) -> dict:
    """The mapping in a file; `name.yaml` or `name.json`, whichever is there, for a path without an ending."""
    path = Path(path)
    for p in [path] if path.suffix else [path.with_suffix(".yaml"), path.with_suffix(".json")]:
        if p.exists():
            text = p.read_text(encoding="utf-8")
            if p.suffix == ".json":
                return json.loads(text or "{}") or {}
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError(f"reading {p} needs a YAML parser; keep the file as JSON") from e
            return yaml.safe_load(text) or {}
    return {}


def _lower(values) -> list[str]:
    return [str(v).strip().lower() for v in values or [] if v]


def sections(folder: str) -> list[str]:
    """Names of sections in order."""
    return [s["name"] for s in read(f"{folder}/sections").get("sections") or []]


def source_columns(folder: str) -> dict[str, str]:
    """The header of each field of a source table, as `tables.sources` takes it."""
    fields = {k: k for k in ("name", "url", "type", "is_active", "language")}
    return fields | {k: v for k, v in (read(f"{folder}/sources_schema").get("columns") or {}).items() if v}


def overrides(spark: SparkSession, folder: str) -> DataFrame:
    """ord, prefix, rss_url, requires_js, language of the overrides of sources, as `tables.overridden` takes them."""
    items = read(f"{folder}/sources_overrides").get("overrides") or []
    rows = [(k, x["url"], x.get("rss_url"), True if x.get("requires_js") else None, x.get("language")) for k, x in enumerate(items)]
    return spark.createDataFrame(rows, "ord int, prefix string, rss_url string, requires_js boolean, language string")


def brands(folder: str) -> list[tuple[str, list[str], list[str]]]:
    """Brand, aliases, domains, in order."""
    return [(b["brand"], list(b.get("aliases") or []), list(b.get("domains") or [])) for b in read(f"{folder}/brand_domains").get("brands") or []]


def cues(folder: str) -> dict[str, list[str]]:
    """phrases of all languages, press (hosts of press releases) and mirrors."""
    x = read(f"{folder}/primary_source_cues")
    return {"cues": [p for ps in (x.get("phrases") or {}).values() for p in ps], "press": list(x.get("press_release_hosts") or []), "mirrors": list(x.get("mirror_hosts") or [])}


def whitelist(folder: str) -> list[str]:
    """Trusted domains, lower case, each once."""
    return sorted({*_lower(read(f"{folder}/whitelist_domains").get("domains"))})


def quirks(folder: str) -> dict:
    """insecure, browser and impersonated hosts (lower case), and rewrites of URLs."""
    x = read(f"{folder}/http_quirks")
    return {"insecure": _lower(x.get("ssl_insecure")), "browser": _lower(x.get("playwright_domains")), "impersonated": _lower(x.get("impersonate_domains")), "rewrites": {str(k): str(v) for k, v in (x.get("url_rewrites") or {}).items()}}


def blacklist(folder: str) -> dict[str, list[str]]:
    """domains and phrases (Russian, then English), lower case; only the domains are trimmed."""
    x = read(f"{folder}/blacklist")
    return {"domains": _lower(x.get("domains")), "phrases": [str(p).lower() for k in ("topic_phrases_ru", "topic_phrases_en") for p in x.get(k) or [] if p]}


def settings(folder: str, now, **other):
    """The settings of a run from a folder of configuration files."""
    from ..plans.runs import Settings

    c, b = cues(folder), blacklist(folder)
    return Settings(now=now, blocked_domains=b["domains"], blocked_phrases=b["phrases"], brands=brands(folder), cues=c["cues"], press=c["press"], mirrors=c["mirrors"], whitelist=whitelist(folder), sections=sections(folder), **other)
