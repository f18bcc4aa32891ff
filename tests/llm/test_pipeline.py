"""The corpus pipeline against its stages, one at a time, on a small table."""

import random

from newsweir.llm.tokens import tokenizer

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(8)
    words = {"en": "the of and with that house river green water stone".split(), "de": "der die und mit das häuser fluß grün wasser stein".split()}
    item = " ".join(rng.choices(words["en"], k=30))
    rows = []
    for i in range(60):
        g = rng.choice(["en", "de"])
        rows.append((i, " ".join(f"{w}{rng.choice('abcdefgh')}" for w in rng.choices(words[g], k=rng.randint(60, 200))), g, rng.choice("xyz"), 0))
    rows += [(60 + i, f"{rows[i][1]} end", "en", "x", 0) for i in range(5)]
    rows += [(70, f"{rows[7][1]} {item}", "en", "x", 0), (71, None, "en", "x", 0), (72, "12 !", "en", None, 0)]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs.collect()
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in seen["language ID"]} == {r[0] for r in rows} - {71, 72}
    alike = len(rows[7][1].split()) >= 4 * 30  # whether 70 is 0.8 like 7, of which it is a copy with an item
    assert {r.doc_id for r in seen["near dedup"]} == {*range(60)} | (set() if alike else {70})
    assert {r.doc_id for r in seen["decontamination"]} == {r.doc_id for r in seen["near dedup"]} - {70}
    t = tokenizer("word_bpe_49k.json")
    want = sorted((r.doc_id, len(t.encode(r.text, add_special_tokens=False).ids) + 1) for r in seen["mixing"])
    assert sorted((r.doc_id, r.n_tokens) for r in seen["token files"]) == want
    assert max(r.start + r.n_tokens for r in seen["token files"]) == sum(n for _, n in want)
    assert len(corpus_pipeline.run(spark, str(tmp_path)).collect()) == len(want)


def test_pipeline_of_nothing(spark, tmp_path):
    """Empty tables, and a table of odd rows alone, go through all stages."""
    import corpus_pipeline

    odd = [(1, None, None, None, None), (2, "", "en", None, 0), (2, "one two three", None, None, 13), (None, "one two three", None, "s", 13), (5, "one two three", None, "s", 13)]
    for name, rows, want in (("none", [], 0), ("odd", odd, 2)):
        spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        assert len(corpus_pipeline.run(spark, f"{tmp_path}/{name}").select("doc_id").distinct().collect()) == want, name
