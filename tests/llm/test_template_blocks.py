"""Blocks of the main slot's own class are template text."""

from __future__ import annotations

import pytest

from eventlift.llm import template
from eventlift.llm.ship import ship


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


def texts(session, rows):
    frame = session.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: (r.text, r.n_chars) for r in template.main_texts(frame).collect()}


def page(text: str, note: str = "We use cookies", more: str = "") -> str:
    return f"<html><body><main><div>Home</div><p>{text}</p>{more}<div><b>{note}</b></div></main></body></html>"


def test_text_on_every_page_of_a_slot_is_template(session):
    own = {i: f"article number {i} has words of its own and goes on for a while {'x' * (i + 1)}" for i in range(12)}
    often = "stands on all pages but one"
    rows = [(i, f"http://many/{i}", page(t, more=f"<p>{often}</p>" if i else "")) for i, t in own.items()]
    rows += [(100 + i, f"http://few/{i}", page(own[i])) for i in range(3)]
    rows += [(200, "http://many/off", "<p>off template")]
    got = texts(session, rows + rows[:2])
    for i, t in own.items():
        want = t + f"\n{often}" if i else t
        assert got[i] == (want, len(want))
    assert got[100] == ((want := f"Home\n{own[0]}\nWe use cookies"), len(want))  # too few pages to tell
    assert got[200][0] == "off template"


def test_copies_of_one_article_keep_it(session):
    same = "the article that every page of this host repeats, long enough to be most of the text"
    rows = [(i, f"http://copies/{i}", page(same, note=f"page {i}")) for i in range(15)] + [(50 + i, f"http://equal/{i}", page(same)) for i in range(15)]
    got = texts(session, rows)
    assert all(got[i][0] == f"Home\n{same}\npage {i}" for i in range(15))
    assert all(got[50 + i][0] == f"Home\n{same}\nWe use cookies" for i in range(15))


def test_blocks_of_the_slots_class():
    rows = [("", None, 1, 12, 12, 0), ("/main", None, 7, 12, 12, 1000), ("/main", 5, 7, 12, 12, 40), ("/main", 6, 8, 12, 12, 40), ("/aside", 9, 7, 12, 12, 40)]
    assert template.template_blocks("/main", rows) == [5]
    assert template.template_blocks("/main", [(*r[:3], 9, 9, r[5]) for r in rows]) == []
