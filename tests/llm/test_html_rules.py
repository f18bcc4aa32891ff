"""Pages on which the rules decide: hidden parts, headings, lists and tables, densities."""

import pytest
from newsweir.llm import html_text

EN = "The council said on Monday that it would not open the bridge before the end of the year, as the work on the north side has taken more time than it had planned for."
EN2 = "When the first part was done in the spring, most of the people who live there were able to use it again, but not all of the shops on the other side of the river."
DE = "Der Rat hat am Montag gesagt, dass die Brücke nicht vor dem Ende des Jahres geöffnet werden kann, weil die Arbeiten auf der Nordseite mehr Zeit brauchen als man gedacht hatte."
FI = "Kaupunginhallitus ilmoitti maanantaina sillan avaamisen viivästyvän pohjoisrannan rakennustöiden pitkittymisen vuoksi, vaikka ensimmäinen osuus valmistui jo keväällä liikenteelle ja asukkaille."
ZH = "市议会周一表示，由于北侧的工程比原计划花费更多时间，大桥在年底之前不会开放。第一部分在春天完工以后，住在那里的大多数人又可以使用它了，但是河对岸的商店还不行。"
NAV = "".join(f'<a href="/{k}">Section number {k}</a> ' for k in range(6))
TEASERS = "".join(f'<article class="card"><h3><a href="/{k}">A teaser about the thing number {k}</a></h3><p><a href="/{k}">read on</a></p></article>' for k in range(4))

#: page, main text
GOLD = [
    # links inside the article, between paragraphs, under a name that says nothing
    (f'<html><body><article><h1>Bridge</h1><p>{EN}</p><div class="zq1">{NAV}</div><p>{EN2}</p></article></body></html>', ["Bridge", EN, EN2]),
    # the text in plain divs, teasers in article elements
    (f'<html><body><div class="x1">{NAV}</div><div class="x2"><h1>Bridge</h1><div>{EN} {EN2}</div><div>{EN2} {EN}</div></div>{TEASERS}</body></html>', ["Bridge", f"{EN} {EN2}", f"{EN2} {EN}"]),
    # pages without stop words of the four languages
    (f'<html><body><div class="x1">{NAV}</div><div><h1>Silta</h1><p>{FI}</p><p>{FI}</p></div><div class="x3">{NAV}</div></body></html>', ["Silta", FI, FI]),
    (f'<html><body><div class="x1">{NAV}</div><div><p>{ZH}</p></div><div class="x3">{NAV}</div></body></html>', [ZH]),
    # short lines inherit from what is nearest: one in the text, one between lists of links
    (f'<html><body><div>{NAV}</div><div>Top stories today</div><div>{NAV}</div><div>{NAV}</div><div><p>{DE} {DE}</p><p>Foto: dpa</p><p>{DE} {DE}</p></div><div>{NAV}</div><div>Impressum</div><div>{NAV}</div></body></html>', [f"{DE} {DE}", "Foto: dpa", f"{DE} {DE}"]),
    # comments beside the article under a name that isn't listed
    (f'<html><body><article><h1>Bridge</h1><p>{EN}</p><p>{EN2}</p></article><div class="zz"><p>I think that they should have known this before, as we all did.</p></div></body></html>', ["Bridge", EN, EN2]),
]


def accuracy(main) -> float:
    """Share of the blocks of all pages, wanted or given, that are both."""
    right = every = 0
    for page, want in GOLD:
        got = main(page).split("\n")
        both = sum(min(got.count(x), want.count(x)) for x in set(want))
        right, every = right + both, every + len(got) + len(want) - both
    return right / every


def test_rules_decide(monkeypatch):
    """Both passes change the text of these pages, and without either it is worse."""
    for page, want in GOLD:
        assert html_text.main_text(page).split("\n") == want
    whole = accuracy(html_text.main_text)
    assert whole == 1
    with monkeypatch.context() as m:
        m.setattr(html_text, "first_pass", lambda b: "bad" if b.bad else "good")
        assert accuracy(html_text.main_text) < 0.7
    with monkeypatch.context() as m:
        m.setattr(html_text, "second_pass", lambda found, first, within: [x == "good" and b.place >= within for b, x in zip(found, first, strict=True)])
        assert accuracy(html_text.main_text) < 0.8


@pytest.mark.parametrize("style", ["display:none", "color:red;" * 500 + "display : none", "x" * 5000 + ";DISPLAY:NONE;" + "y" * 100])
def test_hidden_by_style(style):
    assert html_text.main_text(f'<article><p>{EN}</p><div style="{style}"><p>{EN2}</p></div></article>') == EN


def test_deep_headings():
    """A heading is one however deep its text lies."""
    deep = "<h2>" + "<div>" * 9 + "A long heading without words that are common, Bridgework Northside Overview Quarterly Statement" + "</div>" * 9 + "</h2>"
    assert [b.heading for b in html_text.blocks(f"<article>{deep}<p>{EN}</p></article>")] == [True, False]


def test_lists_and_tables():
    """Items of links are dropped, what has no links beside them stays."""
    page = f'<article><p>{EN}</p><ul><li><a href="/a">Where the bridge is on the map</a></li><li>Plain item</li><li><a href="/b">More about the river</a></li></ul><table><tr><td>1998</td><td>12 m</td></tr><tr><td><a href="/c">A table of links</a></td><td>14 m</td></tr></table></article>'
    assert html_text.main_text(page).split("\n") == [EN, "Plain item", "1998", "12 m", "14 m"]
