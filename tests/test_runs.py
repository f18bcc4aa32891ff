"""Whole runs on small tables."""

import json
from datetime import datetime, timedelta

import pytest
from newsweir.functions.text import prompt_hash
from newsweir.functions.urls import url_hash
from newsweir.plans import runs
from newsweir.sources import tables
from pyspark.sql import functions as F

T = datetime(2026, 4, 27, 12)
SEEN = "url_hash string, canonical_url string, title string, published_at timestamp, first_seen_at timestamp, last_seen_at timestamp, source_domain string, portal string, cached_row_json string"


def world(spark):
    rows = [
        (1, "https://blog.com/a?utm_source=x", "Toyota opens a new plant in the north", "body one", T),
        (2, "https://blog.com/a", "Toyota opens a new plant in the north again", "body", T),
        (3, "https://blog.com/seen", "Something that was seen before by all", "body", T),
        (4, "https://blog.com/b", "Sales of sedans fall for the third month", "body", T),
        (5, "https://blog.com/c", "A recipe for soup with many onions", "soup", T),
        (6, "https://blog.com/d", "BMW recalls cars of the last two years", "body", None),
        (7, "https://blog.com/e", "Old news of a week ago about cars", "body", T - timedelta(days=7)),
        (8, "https://press.com/n", "Toyota opens new plant in the north", "body", T - timedelta(hours=40)),
    ]
    a = spark.createDataFrame(rows, "seq long, url string, title string, body string, published_at timestamp").withColumn("source_language", F.lit("en"))
    seen = spark.createDataFrame([("https://blog.com/seen",)], "u string").select(url_hash(F.col("u")).alias("url_hash"), *[F.lit(None).cast(k.split()[1]).alias(k.split()[0]) for k in SEEN.split(", ")[1:]])
    key = prompt_hash(F.col("title"), F.substring("body", 1, 500))
    said = a.where("seq in (1, 5, 6)").select(key.alias("key"), (F.col("seq") != 5).alias("relevant"), F.when(F.col("seq") == 1, "Market").otherwise("Weather").alias("section"), F.lit("Global").alias("region"), F.lit(0.87654).alias("confidence"), F.concat(F.lit("T "), "seq").alias("title_en"), F.lit("Т").alias("title_ru"), F.lit(0.1).alias("cost"), F.lit(None).cast("string").alias("error"))
    known = spark.createDataFrame([("Sales of sedans fall for a third month",)], "title string")
    return a, seen, known, said


def test_production_run(spark):
    a, seen, known, said = world(spark)
    s = runs.Settings(now=T, hours=48, cap=0.25, sections=["Market"], press=["press.com"])
    out = runs.production_run(a, seen, known, said.unionByName(said), s)
    rows = {r.seq: r for r in out["rows"].collect()}
    assert set(rows) == {1}  # 6 breaks the cap, 5 is of another topic, 8 has no answer
    assert (rows[1].title, rows[1].section, rows[1].domain, rows[1].confidence) == ("EN: T 1 (EN)\nRU: Т (EN)", "Market", "blog.com", 0.877)
    assert (rows[1].primary_domain, rows[1].primary_confidence) == ("press.com", "high")  # an earlier article with a similar title
    assert tuple(out["summary"].first()) == (8, 6, 4, 2, 1, 0.2, 0.3, True)
    assert out["seen"].count() == 2
    more = runs.production_run(a, seen, known, said, runs.Settings(now=T, hours=48, cap=9.0, sections=["Market"]))
    assert {r.seq: r.section for r in more["rows"].collect()} == {1: "Market", 6: "Other news"}


def test_batch_gates(spark):
    a, seen, _, _ = world(spark)
    s = runs.Settings(now=T, hours=48, blocked_phrases=["soup"], blocked_domains=["press.com"])
    got = {r.seq: r.verdict for r in runs.graded(a, s).collect()}
    assert got == {1: "not_article", 2: "duplicate", 3: "not_article", 4: "not_article", 5: "blacklisted", 6: "not_article", 8: "blacklisted"}
    assert {r.seq for r in runs.report_rows(runs.graded(a, s)).collect()} == set(got)


def test_patches_and_dates(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "seq long, title string, note string")
    got = runs.applied(rows, spark.createDataFrame([(2, None, "y", 7)], "seq long, title string, note string, more int"))
    assert sorted(map(tuple, got.collect())) == [(1, "a", None, None), (2, "b", "y", 7)]
    old = spark.createDataFrame([(1, ["https://e.com/x", "https://e.com/2026/04/27/y"], "t", "l", None), (2, ["https://e.com/x"], "t", "on 27.04.2026", None), (3, [], "t", "2026-04-27", T)], "seq long, urls array<string>, title string, lede string, published_at timestamp")
    day = datetime(2026, 4, 27)
    assert {r.seq: r.published_at for r in runs.dated_again(old).collect()} == {1: day, 2: day, 3: T}


def test_run_files(spark, tmp_path):
    (tmp_path / "1.json").write_text('[{"sheet_row": 1, "v": "a"}, {"sheet_row": 2, "v": "b"}, {"sheet_row": 0, "v": "z"}]')
    (tmp_path / "2.json").write_text('[{"sheet_row": 2, "v": "c"}, {"sheet_row": 3, "v": "d"}, {"sheet_row": 3, "v": "e"}, {"v": "none"}]')
    assert {r.sheet_row: r.v for r in tables.merged_runs(spark, f"{tmp_path}/*.json").collect()} == {1: "a", 2: "c", 3: "e"}
    (tmp_path / "atom.xml").write_text('<feed><entry><title>A</title><link rel="self" href="https://e.com/self"/><link href="https://e.com/a"/><updated>2026-04-27T10:00:00Z</updated></entry></feed>')
    got = tables.feed_items(spark, f"{tmp_path}/atom.xml", "entry").collect()
    assert [(r.title, r.link, r.published_text) for r in got] == [("A", "https://e.com/a", "2026-04-27T10:00:00Z")]


def test_publish(spark, tmp_path, capsys):
    """A run from the command line: shown, committed once, ended by its cap."""
    from newsweir.__main__ import main

    a, _, known, said = world(spark)
    a.withColumn("source_name", F.lit("one")).write.parquet(f"{tmp_path}/articles")
    said.write.parquet(f"{tmp_path}/answers")
    known.write.parquet(f"{tmp_path}/titles")
    args = ["--json-log", "publish", f"file://{tmp_path}/store", "r1", f"{tmp_path}/articles", f"{tmp_path}/answers", "--titles", f"{tmp_path}/titles", "-p", "kz", "--since-hours", "48", "--now", "2026-04-27T12:00:00+00:00"]
    assert main([*args, "--dry-run"]) == 0
    out = capsys.readouterr()
    told = [json.loads(x) for x in out.err.splitlines() if x.startswith("{")]
    assert [x["event"] for x in told if x["logger"] == "newsweir.publish"] == ["run begins", "row", "row"] and told[0]["portal"] == "KZ"
    assert json.loads(out.out)["written"] == 2 and not (tmp_path / "store").exists()
    assert main([*args, "--limit", "1"]) == 0 and json.loads(capsys.readouterr().out)["written"] == 1
    assert main(args) == 0 and json.loads(capsys.readouterr().out)["written"] == 1  # r1 is committed
    args[3] = "r2"
    assert main(args) == 0 and json.loads(capsys.readouterr().out)["written"] == 1  # the other article alone
    (tmp_path / "config").mkdir()
    args[3] = "r3"
    with pytest.MonkeyPatch.context() as m:
        m.setattr(runs.Settings, "cap", 0.05, raising=False)
        m.setattr("newsweir.sources.config.settings", lambda folder, now: runs.Settings(now=now, cap=0.05))
        assert main([*args, "--config", str(tmp_path)]) == 2
    with pytest.raises(SystemExit):
        main([*args[:-4], "-p", "xx"])
