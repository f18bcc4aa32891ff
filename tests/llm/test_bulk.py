"""Mixing, token files, token counts, decontamination, language identification, HTML extraction on small tables."""

import random
import zlib

import numpy as np
import pytest
from newsweir.llm import decontam, html_text, langid, mixing, token_counts, token_files
from newsweir.llm.tokens import Pieces, encode_spans, tokenizer

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", None, "  ", "a", "Hello  World\n\n x", " lead and trail ", "It's we'll they'd", "tab\tsep\r\nline", "é combining ́x", "İstanbul ΣΑΣ", "a<|endoftext|>b <|endoftext|> c", "emoji 😀😀 ok", "nb sp x", "12 345 6.7", "...!!! ??", "x" * 3000, "word " * 2000, "a \n b", "\n\n\n", "日本語 テキスト です", "foo!'s a-'t b=\u0338c don't.stop x!!'re y'll-z 3,5.7% e-mail_x@y.z a<|endoftext|>!b é!\u0301"]


def frame(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


def odd(spark):
    return frame(spark, [(i, t, "en", None if i % 3 == 0 else f"s{i % 4}", len(t or "")) for i, t in enumerate(ODD)])


def test_token_files_equal_plain_encoding(spark):
    t = tokenizer(token_files.TOKENIZER)
    rows = {r.doc_id: r for r in token_files.token_files(odd(spark)).collect()}
    start = 0
    for i, text in enumerate(ODD):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        r = rows[i]
        assert (r.start, r.n_tokens) == (start, len(ids)), (i, text)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert token_files.token_files(odd(spark).limit(0)).count() == 0


def test_pieces_of_all_code_points():
    """No letter before a sign changes the ids, whatever its normal form is."""
    import pyarrow as pa
    from newsweir.llm.tokens import encode_words

    cache, rng = Pieces(token_files.TOKENIZER), random.Random(2)
    texts = [f"{chr(i)}- {chr(i)}.a b{chr(i)}/" for i in range(0x20, 0x30000) if not 0xD800 <= i < 0xE000]
    texts += ["".join(rng.choices("abİßéЖя09 \n.-,!'’\u0338\u0301ΣΑς日本क\u0958ড়=<|>%/()", k=rng.randint(1, 25))) for _ in range(20_000)]
    for lo in range(0, len(texts), 20_000):
        part = texts[lo : lo + 20_000]
        ids, n = encode_words(pa.array(part), cache)
        parts = np.split(ids, np.cumsum(n)[:-1])
        want = cache.tok.encode_batch_fast(part, add_special_tokens=False)
        assert [t for t, a, w in zip(part, parts, want, strict=True) if a.tolist() != w.ids] == []


def test_random_access():
    rng = random.Random(1)
    ids = [rng.choice([0, 1, 255, 256, 49407, 70000, 2**31]) for _ in range(3000)]
    f = token_files.TokenFile(token_files.pack([5, None], np.array([1000, 2000]), np.array(ids)))
    assert f.doc_ids == [5, None] and f.tokens(0, 3000).tolist() == ids
    assert f.tokens(513, 1601).tolist() == ids[513:1601] and f.tokens(7, 7).tolist() == []
    assert [f.token(i) for i in range(0, 3000, 37)] == ids[::37]
    assert token_files.TokenFile(token_files.pack([], np.zeros(0, int), np.zeros(0, int))).n == 0


def test_spans_equal_plain_encoding():
    cache = Pieces(token_counts.TOKENIZER, offsets=True)
    texts = [t or "" for t in [*ODD, "The cat sat.\nOn the mat, it's fine.\n\nEnd", "a\x1cb c", "x\u3000y z", "\u00a0 x"]]
    for text, (ids, a, b) in zip(texts, encode_spans(texts, cache), strict=True):
        e = cache.tok.encode(text, add_special_tokens=False)
        assert ids.tolist() == e.ids, text
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == e.offsets, text


def test_section_tokens(spark):
    got = token_counts.section_tokens(odd(spark)).collect()
    t = tokenizer(token_counts.TOKENIZER)
    for i, text in enumerate(ODD):
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.section)
        assert sum(r.n_tokens for r in mine) == len(t.encode(text or "").ids)
        assert mine[0].begin == 0 and mine[-1].end == len(text or "")
        for r in mine:
            assert r.n_tokens == sum(r.begin <= o[0] < max(r.end, 1) for o in t.encode(text or "").offsets)
    at = np.array([0, 4]), np.array([4, 9])
    assert token_counts.attribute(*at, np.array([0, 5]), "first").tolist() == [0, 0]
    assert token_counts.attribute(*at, np.array([0, 5]), "last").tolist() == [0, 1]
    assert token_counts.attribute(*at, np.array([0, 5]), "most").tolist() == [0, 1]
    with pytest.raises(ValueError):
        token_counts.attribute(*at, np.array([0, 5]), "other")


def brute_containment(docs, items):
    import regex

    def shingles(t):
        w = regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
        return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}

    out = {}
    for i, t in items:
        s = shingles(t)
        for d, x in docs:
            if s and len(s & shingles(x)) / len(s) >= 0.8:
                out.setdefault(d, set()).add(i)
    return out


def test_decontamination(spark):
    rng = random.Random(3)
    w = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(w, k=rng.randint(3, 40)))) for i in range(30)] + [(90, None), (91, "")]
    docs = []
    for d in range(120):
        parts = [" ".join(rng.choices(w, k=rng.randint(0, 80)))]
        if d % 3 == 0:
            x = (items[rng.randrange(30)][1]).split()
            if d % 2:
                x[rng.randrange(len(x))] = "changed"
            parts += [" ".join(x).upper(), "the end"]
        docs.append((d, " ".join(parts)))
    docs += [(200, None), (201, ""), (5, items[4][1])]
    got = decontam.contaminated(frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string"))
    assert {r.doc_id: set(map(int, r.item_list.split(","))) for r in got.collect()} == brute_containment(docs, items)
    assert decontam.contaminated(frame(spark, docs, "doc_id long, text string"), frame(spark, [], "item_id long, text string")).count() == 0
    kept = {r.doc_id for r in decontam.clean_documents(frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string")).collect()}
    assert kept == {d for d, _ in docs} - set(brute_containment(docs, items))


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 900)), "en", rng.choice(["a", "a", "a", "b", "c", None]), 0) for i in range(200)] + [(300, None, None, "z", 0), (301, "q q", "en", "only", 0)]
    out = mixing.mixed_sizes(frame(spark, rows)).collect()
    again = mixing.mixed_sizes(frame(spark, rows[::-1])).collect()
    assert sorted(out) == sorted(again) and len(out) == len(rows)
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r[0])
    total = sum(size.values())
    got = {r.doc_id: r for r in out}
    want, order = {}, sorted((s for s in by if s is not None)) + [None]
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, left = set(), 1.5 * total
    while True:
        free = [s for s in order if s not in full]
        rest = left - sum(2 * sum(size[d] for d in by[s]) for s in full)
        over = {s for s in free if rest * w[s] / sum(w[x] for x in free) > 2 * sum(size[d] for d in by[s])}
        want = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        if not over:
            break
        full |= over
    want |= {s: 2.0 * sum(size[d] for d in by[s]) for s in full}
    for s, ds in by.items():
        assert all(abs(got[d].target - want[s]) < 1e-6 for d in ds)
        assert abs(sum(got[d].taken for d in ds) - want[s]) <= 40, s
    assert all(0 <= got[d].taken <= 2 * size[d] == 2 * got[d].size for d in size)
    texts = mixing.mixed_documents(frame(spark, rows)).collect()
    for d in size:
        assert sum(len(r.text.split()) for r in texts if r.doc_id == d) == got[d].taken
    assert mixing.mixed_sizes(frame(spark, rows).limit(0)).count() == 0
    double = mixing.mixed_sizes(frame(spark, rows[:20] * 2)).collect()
    assert len(double) == 40


def test_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 31, 999983, 4096):
        m = min(n, 5000)
        p = mixing.permutation(F.lit(n), F.lit("x"))
        got = spark.range(m).select(((p["mul"] * F.col("id") + p["add"]) % n).alias("p")).distinct().where(f"p >= 0 and p < {n}").count()
        assert got == m


def test_language(spark):
    rng = random.Random(7)
    words = {"en": "the of and with that house river green water".split(), "de": "der die und mit das häuser fluß grün wasser".split(), "fr": "le la et avec que maison rivière vert eau".split()}
    rows = [(i, " ".join(rng.choices(words[g], k=20)), g, "s", 0) for i, g in enumerate(rng.choices(list(words), k=300))]
    extra = [(1000, None, "en", None, 0), (1001, "", None, None, 0), (1002, "123 !!", "de", None, 0), (1003, "x", None, None, 0), (1004, "the house " * 20000, None, None, 0)]
    out = {r.doc_id: r for r in langid.identify(frame(spark, rows + extra)).collect()}
    assert len(out) == 305
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert held and all(out[r[0]].held_out for r in held)
    assert sum(out[r[0]].lang_pred == r[2] for r in held) >= 0.98 * len(held)
    assert [out[k].lang_pred for k in (1000, 1001, 1002, 1004)] == ["und", "und", "und", "en"]
    assert all(0 <= r.score <= 1 for r in out.values())
    assert {r.lang_pred for r in langid.identify(frame(spark, [(1, "text", None, "s", 4)])).collect()} == {"und"}
    kept = langid.known_language(frame(spark, rows + extra))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r.doc_id for r in kept.collect()} == set(out) - {1000, 1001, 1002}


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="ad">Buy this now.</div><div id="cookie-notice">We use cookies.</div>
<article><h1>Title  &eacute;</h1><p><b>One two&nbsp;three.<br><p>Short.</p><div class="share">Share it</div><p>Last &lt;p&gt; <a href="x">link</a> text.</article>
<section id="comments"><p>A reader says that this is the best and that it was not as good as the other one.</p></section><aside><p>See also</p></aside><form><input><p>Sign up</p></form><footer>&copy; x</footer></body>"""
PLAIN = """<body><div><a href=x>Home</a> | <a href=y>News</a> | <a href=z>About us and more</a></div><p>{}</p><p>Short one.</p><p>{}</p><div><a href=x>Terms of use</a> <a href=y>Privacy</a></div></body>"""


def test_more_languages_than_landmarks(spark):
    """Every label is learned, however many there are; ties of hashes and repeated rows change nothing."""
    rows = [(i, f"wort{chr(97 + g % 26)}{chr(97 + g // 26)} " * 5, f"l{g:03}", "s", 0) for g in range(80) for i in range(6 * g, 6 * g + 6)]
    out = langid.identify(frame(spark, rows + rows[:50])).collect()
    held = [r for r in out if r.held_out]
    want = {r[0]: r[2] for r in rows}
    assert len(out) == len(rows) + 50 and len({r.lang_pred for r in out}) == 80
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.98 * len(held)


def test_unknown_languages_go(spark):
    """A text that shares nothing with any learned language is rejected by its score; without labels nothing with a letter is."""
    rows = [(i, "the house of the river" if i % 2 else "das haus und der fluß", "en" if i % 2 else "de", "s", 0) for i in range(60)]
    odd = [(100, "этого языка здесь нет", None, "s", 0), (101, "the river", None, "s", 0), (102, "!!", None, "s", 0)]
    assert {r.doc_id for r in langid.known_language(frame(spark, rows + odd)).collect()} == {*range(60), 101}
    assert {r.doc_id for r in langid.known_language(frame(spark, odd)).collect()} == {100, 101}
    assert langid.known_language(frame(spark, [])).count() == 0 == langid.identify(frame(spark, [])).count()


def test_folded_matrix_is_kernel_ridge():
    """The scores from the folded matrix equal those of an explicit Nyström kernel ridge regression."""
    rng = random.Random(9)
    words = {"a": "alpha beta gamma delta".split(), "b": "uno due tre quattro".split(), "c": "eins zwei drei vier".split()}
    langs = [rng.choice("abc") for _ in range(90)]
    texts = [" ".join(rng.choices(words[g] + ["common"], k=8)) for g in langs]
    grams = [{(n, t[i : i + n]) for t in [langid.normalised(x)] for n in langid.ORDERS for i in range(len(t) - n + 1)} for x in texts]
    marks = np.zeros((90, langid.PLACES), np.uint8)
    for row, x in zip(marks, texts, strict=True):
        langid.presence(langid.normalised(x), row)
    model = langid.Model.fit(np.packbits(marks, axis=1), langs, landmarks=30)
    kernel = np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in grams] for x in grams])
    pick = [k for g in "abc" for k in [k for k in range(90) if langs[k] == g][:10]]
    values, vectors = np.linalg.eigh(kernel[np.ix_(pick, pick)])
    keep = values > 1e-6 * values[-1]
    phi = kernel[:, pick] @ vectors[:, keep] / np.sqrt(values[keep])
    y = np.array([[1.0 if g == c else -1.0 for c in "abc"] for g in langs])
    w = np.array([90 / (3 * langs.count(g)) for g in langs])[:, None]
    mp, my = (w * phi).sum(0) / w.sum(), (w * y).sum(0) / w.sum()
    beta = np.linalg.solve((w * (phi - mp)).T @ (phi - mp) + langid.RIDGE * 90 * np.eye(phi.shape[1]), (w * (phi - mp)).T @ (y - my))
    want = (phi - mp) @ beta + my
    got, scores = model.predict(texts)
    assert got == ["abc"[k] for k in want.argmax(1)]
    e = np.exp(4 * (want - want.max(1, keepdims=True)))
    assert np.allclose(scores, (e / e.sum(1, keepdims=True)).max(1), atol=2e-3)


def test_draws_decide_what_is_taken(spark, monkeypatch):
    """Each shard has its own multinomial counts; other draws take other blocks, and the totals stay what they are."""
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(1, 900)), "en", rng.choice("aabc"), 0) for i in range(300)]
    monkeypatch.setattr(mixing, "SHARD", 256)
    m = mixing.mix(frame(spark, rows))
    src = {r.rn: r for r in m["sources"].collect()}
    slots = m["slots"].collect()
    assert len(slots) == sum(r.slots for r in src.values()) == len({r.slot for r in slots})
    counts = {}
    for r in slots:
        counts.setdefault(r.shard, {}).setdefault(r.rn, []).append((r.block, r["pass"]))
    for rn, s in src.items():
        mine = [x for c in counts.values() for x in c.get(rn, [])]
        assert len(mine) == s.slots and len(set(mine)) == len(mine) and all(0 <= b < s.blocks and p < 2 for b, p in mine)
        per = [len(c.get(rn, [])) for k, c in counts.items() if k < max(counts)]
        share = s.slots / len(slots)
        assert len(set(per)) > 3 and np.std(per) < 3 * np.sqrt(256 * share * (1 - share)) + 1 and np.std(per) > 0.3 * np.sqrt(256 * share * (1 - share))
    one = {r.doc_id: r for r in mixing.mixed_sizes(frame(spark, rows)).collect()}
    monkeypatch.setattr(mixing, "SHARD", 300)
    two = {r.doc_id: r for r in mixing.mixed_sizes(frame(spark, rows)).collect()}
    assert sum(one[d].taken != two[d].taken for d in one) > 10
    for s in "abc":
        ids = [r[0] for r in rows if r[3] == s]
        assert all(abs(sum(x[d].taken for d in ids) - one[ids[0]].target) <= 40 for x in (one, two))


def test_size_partitions_prune(spark):
    """Long items have a low limit, so a document sends few shingles for them; and none where no item can be in it."""
    rng = random.Random(12)
    w = [f"w{i}" for i in range(3000)]
    items = frame(spark, [(i, " ".join(rng.choices(w, k=rng.randint(140, 400)))) for i in range(40)], "item_id long, text string")
    docs = frame(spark, [(0, " ".join(rng.choices(w, k=3000))), (1, " ".join(rng.choices(w, k=90)))], "doc_id long, text string")
    limits = decontam.partition_limits(decontam.sketches(items))
    sent = {r.doc_id: r["count"] for r in decontam.document_sketches(docs, limits).groupBy("doc_id").count().collect()}
    assert len(limits) == 2 and 0.1 * 2996 < sent[0] < 0.6 * 2996 and 1 not in sent


def test_html(spark):
    assert html_text.main_text(PAGE) == "Title é\nOne two three.\nShort.\nLast <p> link text."
    a, b = "It was the best of the times and it was what they had in the town of their own. " * 4, "There is a house in the city that we like and it is not for sale, as you know. " * 4
    assert html_text.main_text(PLAIN.format(a, b)).split("\n") == [a.strip(), "Short one.", b.strip()]
    inner = f'<div class="site-header">Site</div><main><header class="entry-header"><h1>Head</h1></header><p>{a}</p><p>Short one.</p><ul class="commentlist"><li>{b}</li></ul></main><p>{b}</p>'
    assert html_text.main_text(inner).split("\n") == ["Head", a.strip(), "Short one."]
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<article>" + "<p>x y</p>" * 5000), (1, "u", PAGE), (6, "u", "just text & more")]
    out = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == 7 and all(r.n_chars == len(r.text) for r in out)
    assert next(r for r in out if r.page_id == 2).text == "" and next(r for r in out if r.page_id == 5).text.count("x y") == 5000


def test_html_places_and_quotes():
    a, b = "It was the best of the times and it was what they had in the town of their own. " * 4, "There is a house in the city that we like and it is not for sale, as you know. " * 4
    text = html_text.main_text
    assert text("<article><p data-x='it's'>text of it</p></article>") == "text of it"
    assert text("<article><p title=\"a > b\">one</p><p title='x>two</p></article>") == "one\ntwo"  # a quote that never ends ends at the tag's end
    for name in ("legal-analysis", "social-history", "related-work theory", "navigators-guide"):
        assert text(f"<article><div class='{name}'><p>{a}</p></div></article>") == a.strip(), name
    for name in ("cookie-notice", "adBanner", "share-buttons", "site_footer", "related-posts", "ad-3"):
        assert text(f"<article><p>{b}</p><div class='{name}'><p>{a}</p></div></article>") == b.strip(), name
    # teaser cards in article elements don't bound the text, whether it stands in main or in a div
    cards = "".join(f"<article><a href=/{k}>A card of some words {k}</a></article>" for k in range(5))
    for tag in ("div", "main"):
        assert text(f"<nav><a href=/>Home</a></nav><{tag}><h1>Head</h1><p>{a}</p><p>{b}</p></{tag}><section>{cards}</section>") == f"Head\n{a.strip()}\n{b.strip()}"
    # a list of nothing but links inside an article goes, by its density; what is around it stays
    assert text(f"<article><p>{a}</p><ul><li><a href=x>Other story of the day</a></li><li><a href=y>One more</a></li></ul><p>{b}</p></article>") == f"{a.strip()}\n{b.strip()}"


def test_html_two_passes():
    """Both passes take part on a page with an article element, and without them the text is another."""
    a = "It was the best of the times and it was what they had in the town of their own. " * 4
    found = html_text.blocks(f"<article><h1>Head</h1><p>{a}</p><p>Short.</p><p><a href=x>All of it a link</a></p></article><p>{a}</p>")
    first = [html_text.first_pass(b) for b in found]
    assert first == ["short", "good", "short", "bad", "good"] and html_text.bound(found, first) == 0
    found = found[:4]
    assert html_text.bound(found, first[:4]) == 2 and html_text.labels(found) == [True, True, True, False]


def test_html_gold():
    """Pages put together from parts whose label is known, with an article element, a main element or neither."""
    rng = random.Random(13)
    common, rare = "the of and to in is it that was for as with".split(), [f"w{i}x" for i in range(200)]
    para = lambda n: " ".join(rng.choice(common) if rng.random() < 0.45 else rng.choice(rare) for _ in range(n)).capitalize() + "."
    right = total = extra = 0
    for k in range(150):
        tag, want = ("article", "main", "div")[k % 3], []
        body = []
        for _ in range(rng.randint(3, 8)):
            p = para(rng.choice([6, 12, 70, 90]))
            body.append(f"<p>{p}</p>")
            want.append(p)
        long = para(80)
        body.insert(rng.randrange(len(body) + 1), f"<p>{long}</p>")
        want.append(long)
        if k % 3 == 0:
            body.insert(1, f"<div class='ad-box'>{para(9)}</div>")
        links = lambda n: "".join(f"<li><a href=/{i}>{para(2)}</a></li>" for i in range(n))
        page = f"<nav><ul>{links(6)}</ul></nav><div class=sidebar><p>{para(30)}</p></div><{tag}>{''.join(body)}</{tag}><ul>{links(4)}</ul><div id=comments><p>{para(70)}</p></div><footer>{para(8)}</footer>"
        got = html_text.main_text(page).split("\n")
        right += sum(p in got for p in want)
        total += len(want)
        extra += sum(g not in want for g in got)
        if tag != "div":
            assert sorted(got) == sorted(want), page
    assert right >= 0.97 * total and extra == 0


def test_html_in_linear_time():
    import time

    for part in ("<a b=\"x\" c='", "<p title='it's'>text", "<!-- ", "<svg>", "<div>", "&amp", "<", "</p", "<p x='", "<b><i></b>", "<li>"):
        start = time.time()
        html_text.main_text(part * (3_000_000 // len(part)))
        assert time.time() - start < 40, part


def test_very_long_texts_and_empty_tables(spark):
    from newsweir.llm import substring_dedup, suffix_dedup

    long = " ".join(f"w{i % 5000}x{i // 5000 % 7}" for i in range(120_000))
    docs = frame(spark, [(1, long, None, None, 0), (2, long, None, None, 0), (3, "x", None, None, 0)])
    assert {r.doc_id: r.n_removed for r in suffix_dedup.without_repeats(docs).collect()} == {1: len(long), 2: len(long), 3: 0}
    assert {r.doc_id: r.n_removed for r in substring_dedup.without_repeats(docs).collect()} == {1: 120_000, 2: 120_000, 3: 0}
    assert {r.doc_id: r.n_items for r in decontam.contaminated(docs, frame(spark, [(1, long[500:2000])], "item_id long, text string")).collect()} == {1: 1, 2: 1}
    assert sum(r.taken for r in mixing.mixed_sizes(docs).collect()) >= 240_000
    none = docs.limit(0)
    assert token_counts.section_tokens(none).count() == 0 == html_text.extracted(frame(spark, [], "page_id long, url string, html string")).count()


def test_clashing_columns_of_reports(spark):
    """Columns of any name beside those that an operator reads change nothing."""
    from newsweir.llm import substring_dedup, suffix_dedup, vector_dedup
    from pyspark.sql import functions as F

    def more(df):
        for c in ("k", "spans", "n_removed", "start", "n_tokens", "section", "v", "u", "sim", "component_id", "n_links", "n_chars", "kept", "bands", "rep"):
            if c not in df.columns:
                df = df.withColumn(c, F.lit(c))
        return df

    docs, pages = odd(spark), frame(spark, [(1, "u", PAGE), (2, None, None)], "page_id long, url string, html string")
    vectors = frame(spark, [(k, [1.0, k / 100, 0.5]) for k in range(20)], "vec_id long, embedding array<double>")
    for f, df in ((suffix_dedup.without_repeats, docs), (substring_dedup.without_repeats, docs), (html_text.extracted, pages), (token_files.token_files, docs), (token_counts.section_tokens, docs), (vector_dedup.near_vectors, vectors)):
        assert sorted(map(str, f(df).collect())) == sorted(map(str, f(more(df)).collect()))


def test_clashing_columns(spark):
    """Columns of any name come through unchanged."""
    from newsweir.llm import near_dedup
    from pyspark.sql import functions as F

    docs = odd(spark)
    for c in ("gone", "bad", "tie", "got", "parts", "times", "k", "size", "lang_pred", "score", "hub", "rn", "words", "block"):
        docs = docs.withColumn(c, F.lit(c))
    items = frame(spark, [(1, "a b c d e f")], "item_id long, text string")
    for out in (langid.known_language(docs), decontam.clean_documents(docs, items), mixing.mixed_documents(docs), near_dedup.one_of_each(docs)):
        assert out.columns == docs.columns
        assert {r.got for r in out.collect()} == {"got"}
