"""Command line: `python -m newsweir run QUERY TABLES OUT` writes a query's rows as Parquet, `queries` lists them,
`show-config FOLDER` prints the settings of a folder of configuration files, without secrets, and `publish STORE RUN ARTICLES
ANSWERS` makes a run of captured articles and commits it to a store once; it ends with 2 if the cap of cost was broken. Logs are
lines of text, or with --json-log objects."""

from __future__ import annotations

import argparse
import json
import logging
import re
from datetime import UTC, datetime


def shown(settings: dict) -> dict:
    """Settings with the values of keys, tokens and passwords replaced."""
    return {k: "***" if re.search("key|token|secret|password", k, re.IGNORECASE) and v else v for k, v in settings.items()}


class JsonLines(logging.Formatter):
    """A log record as one JSON object."""

    def format(self, record: logging.LogRecord) -> str:
        told = {"at": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname.lower(), "logger": record.name, "event": record.getMessage()}
        if record.exc_info:
            told["error"] = self.formatException(record.exc_info)
        return json.dumps(told | getattr(record, "fields", {}), ensure_ascii=False, default=str)


def publish(spark, a: argparse.Namespace) -> int:
    """Make a run of captured articles and commit it, or with dry_run only show its rows."""
    from pyspark.sql import functions as F

    from .operators import dedup
    from .plans import calls, runs
    from .sources.config import settings
    from .sources.sinks import exists
    from .sources.state import Store

    log, now = logging.getLogger("newsweir.publish"), datetime.fromisoformat(a.now).astimezone(UTC).replace(tzinfo=None) if a.now else datetime.now(UTC).replace(tzinfo=None)
    s = settings(a.config, now) if a.config else runs.Settings(now=now)
    s.portal, s.hours = a.portal.upper(), a.since_hours or s.hours
    articles = dedup.first_of(spark.read.parquet(a.articles), ["source_name"], ["seq"], a.limit)
    three = all(exists(spark, f"{a.answers}/{c}") for c in calls.CALLS)
    answers = {c: spark.read.parquet(f"{a.answers}/{c}") for c in calls.CALLS} if three else spark.read.parquet(a.answers)
    titles = spark.read.parquet(a.titles) if a.titles else spark.createDataFrame([], "title string")
    log.info("run begins", extra={"fields": {"run": a.run, "portal": s.portal, "dry_run": a.dry_run, "limit": a.limit}})
    store = Store(spark, a.store)
    if a.dry_run:
        out = runs.production_run(articles, store.seen_of(dedup.candidates(articles)), titles, answers, s)
        for r in out["rows"].drop("url_hash").toLocalIterator():
            log.info("row", extra={"fields": r.asDict()})
        summary = out["summary"].first().asDict()
    else:
        if not runs.committed_run(store, a.run, articles, titles, answers, s):
            log.warning("the run was committed before", extra={"fields": {"run": a.run}})
        summary = store.log().where(F.col("run") == a.run).first().asDict()
    print(json.dumps(summary, default=str))
    return 2 if summary["aborted"] else 0


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="newsweir", description=__doc__)
    p.add_argument("--log", default="INFO")
    p.add_argument("--json-log", action="store_true")
    sub = p.add_subparsers(dest="what", required=True)
    run = sub.add_parser("run")
    for a in ("query", "tables", "out"):
        run.add_argument(a)
    sub.add_parser("queries")
    sub.add_parser("show-config").add_argument("folder")
    out = sub.add_parser("publish")
    for x in ("store", "run", "articles", "answers"):
        out.add_argument(x)
    out.add_argument("--portal", "-p", required=True, type=str.upper, choices=["RU", "UZ", "KZ"])
    out.add_argument("--dry-run", action="store_true", help="show the rows, commit nothing")
    out.add_argument("--limit", type=int, default=20, help="most articles of a source")
    out.add_argument("--since-hours", type=int, help="instead of the settings' span of freshness")
    for x in ("--titles", "--config", "--now"):
        out.add_argument(x)
    a = p.parse_args(args)
    handler = logging.StreamHandler()
    handler.setFormatter(JsonLines() if a.json_log else logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
    own = logging.getLogger("newsweir")  # others' loggers stay as they are
    own.handlers, own.propagate = [handler], False
    own.setLevel(a.log)
    from .plans import catalog, catalog_rules, catalog_state  # noqa: F401, the others add to the first

    if a.what == "queries":
        print("\n".join(sorted(catalog.QUERIES)))
    elif a.what == "show-config":
        from .sources.config import settings

        print(json.dumps(shown(vars(settings(a.folder, datetime.now(UTC)))), default=str, ensure_ascii=False, indent=1))
    else:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
        if a.what == "publish":
            return publish(spark, a)
        catalog.QUERIES[a.query](spark, a.tables).write.mode("overwrite").parquet(a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
