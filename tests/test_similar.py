"""The search for similar titles loses no pair: it is held against all pairs."""

import random

import numpy as np
import pytest
from newsweir.functions import similar as s
from newsweir.functions.text import set_ratios


def made(n, seed, length=14):
    """Titles of made words, copies with changed characters and words, titles of one and two words, long and odd ones."""
    r = random.Random(seed)
    words = ["".join(r.choice("etaoinshrdlué") for _ in range(r.randrange(2, 8))) for _ in range(120)] + ["the", "of"] * 10
    out = [" ".join(r.choice(words) for _ in range(r.randrange(1, length))) for _ in range(n)]
    for t in out[: n // 2]:
        at = r.randrange(len(t))
        out.append(t[:at] + r.choice("xyz ") + t[at + r.randrange(3) :])
    out += ["汽车 市场", "汽车 市场 新闻", "x", "x y", "", "  ", "e" * 400, "e" * 390 + " t", "z" * 70 + " the of", "z" * 68 + "y the of", "\ud800 a"]
    return out


def by_all(a, b, least):
    i, j = (x.ravel() for x in np.meshgrid(range(len(a)), range(len(b)), indexing="ij"))
    r = set_ratios([a[k] for k in i], [b[k] for k in j], least)
    return {(int(p), int(q)): float(x) for p, q, x in zip(i, j, r, strict=True) if x >= least}


@pytest.mark.parametrize("least", [60.0, 72.0, 85.0])
def test_no_pair_is_lost(least, monkeypatch):
    a, b = made(110, 1, 40), made(90, 2)
    b += a[::5]
    want = by_all(a, b, least)
    for blocks in ((512, 4096, 32768), (16, 40, 50)):
        for name, v in zip(("ROWS", "COLUMNS", "TOGETHER"), blocks, strict=True):
            monkeypatch.setattr(s, name, v)
        got = s.similar(a, b, least)
        assert dict(zip(zip(got[0].tolist(), got[1].tolist(), strict=True), got[2].tolist(), strict=True)) == want and len(want) > 20
        i, j, _ = s.similar(a, a, least, True)
        assert len(i) and set(zip(i.tolist(), j.tolist(), strict=True)) == {(p, q) for p, q in by_all(a, a, least) if p < q}


def test_pairs_of_common_words_alone(spark):
    """Titles of three common words, of which none is rare: all pairs are found, and tiles of several groups give each once."""
    from newsweir.operators import dedup

    r = random.Random(3)
    words = ["alpha", "alphas", "beta", "betas", "gamma", "gammas", "delta", "deltas"]
    titles = sorted({" ".join(r.choice(words) for _ in range(3)) for _ in range(150)})
    left, right = titles[:80], titles[40:]
    df = lambda x: spark.createDataFrame([(t,) for t in x], "title string")
    want = {(left[p], right[q]) for p, q in by_all(left, right, 85.0)}
    least, dedup.TILE_LEAST = dedup.TILE_LEAST, 30
    try:
        got = [(x.a, x.b) for x in dedup.title_pairs(df(left), df(right), 85.0).collect()]
    finally:
        dedup.TILE_LEAST = least
    assert len(got) == len(set(got)) and set(got) == want


def test_blocks_are_told_once(monkeypatch):
    """What a block of titles is told by is made once, not again for each block that it meets."""
    told, side = [], s._Side
    monkeypatch.setattr(s, "COLUMNS", 20)
    monkeypatch.setattr(s, "_Side", lambda titles, *how: told.append(tuple(titles)) or side(titles, *how))
    a, b = made(30, 4), made(25, 5)
    i, j, _ = s.similar(a, b, 72.0)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(by_all(a, b, 72.0))
    assert len(told) == -(-len(a) // 20) + -(-len(b) // 20)


def test_titles_of_near_slots(spark, monkeypatch):
    """Of titles in slots all similar pairs of one slot or of two that follow each other are found, once, and no others."""
    from newsweir.operators import dedup

    monkeypatch.setattr(dedup, "SLOT_LEAST", 12)
    monkeypatch.setattr(dedup, "TILE_MOST", 12)
    titles = sorted({t for t in made(70, 6) if t.strip() and "\ud800" not in t})
    slots = [(t, (k * 7 + n) % 6) for k, t in enumerate(titles) for n in range(1 + k % 2)]
    of = {t: {x for u, x in slots if u == t} for t in titles}
    near = lambda p, q: any(abs(x - y) <= 1 for x in of[p] for y in of[q])
    every = {(titles[p], titles[q]) for p, q in by_all(titles, titles, 72.0) if p < q}
    got = [(x.a, x.b) for x in dedup.searched_near(spark.createDataFrame(slots, "title string, slot long"), 72.0).collect()]
    want = {x for x in every if near(*x)}
    assert len(got) == len(set(got)) and set(got) == want and 0 < len(want) < len(every)


def test_few_titles_go_to_all_tiles(spark, monkeypatch):
    """Where one side has few titles each of the other is dealt once; all pairs are found, whichever side has few."""
    from newsweir.operators import dedup

    rows, tiles = [], dedup._of_tiles
    monkeypatch.setattr(dedup, "FEW", 20)
    monkeypatch.setattr(dedup, "TILE_LEAST", 20)
    monkeypatch.setattr(dedup, "_of_tiles", lambda dealt, *how: rows.append(dealt.count()) or tiles(dealt, *how))
    many = sorted({t for t in made(80, 7) if t.strip() and "\ud800" not in t})
    few = [*many[:8], *(t + " x" for t in many[8:16])]
    df = lambda x: spark.createDataFrame([(t,) for t in x], "title string")
    want = {(few[p], many[q]) for p, q in by_all(few, many, 72.0)}
    got = [(x.a, x.b) for x in dedup.title_pairs(df(few), df(many), 72.0).collect()]
    back = [(x.b, x.a) for x in dedup.title_pairs(df(many), df(few), 72.0).collect()]
    assert sorted(got) == sorted(back) == sorted(want) and len(want) > 16
    assert max(rows) <= len(many) + len(few) * -(-len({*few, *many}) // 20)
