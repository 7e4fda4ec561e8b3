"""Tags whose names only begin like silent ones, and empty ones."""

import time
import zlib

import numpy as np
import pytest

from cellshift.llm import html_extract


def texts(page):
    return [b.text for b in html_extract.blocks(page)]


@pytest.mark.parametrize("name", html_extract.SILENT_TAGS)
def test_custom_elements_hide_nothing(name):
    assert texts(f"<p>one<{name}-x></{name}-x> two</p><p>three</p>") == ["one two", "three"]
    assert texts(f"<p>one<{name}-x a='>'> in</{name}-x> two</p><p>three</p>") == ["one in two", "three"]


@pytest.mark.parametrize("tag", ["<svg/>", "<svg />", "<SVG class='a>b' width=\"1\"/>"])
def test_a_closed_svg_is_empty(tag):
    assert texts(f"<p>one{tag} two</p><p>three</p>") == ["one two", "three"]


@pytest.mark.parametrize("name", html_extract.SILENT_TAGS)
def test_silent_tags_stay_silent(name):
    assert texts(f"<p>one<{name} a='b/c'>hidden</{name}> two</p>") == ["one two"]
    assert texts(f"<p>one<{name}>hidden</{name}\n> two</p>") == ["one two"]


def _path(place):
    words = []
    while place is not None:
        words = [*place.words, *words]
        place = place.outer
    return words


def _plain_row(words):
    """The path's part of a row, from all of its words."""
    row = np.zeros(html_extract.PATH_SIZE + 2, dtype=np.float32)
    for up, word in enumerate(reversed(words)):
        row[zlib.crc32(word.encode()) % html_extract.PATH_SIZE] += 1.0 if up < 4 else 0.5
    row[-2] = any(w in html_extract.OUTSIDE_TAGS or w[1:] in html_extract.OUTSIDE_WORDS for w in words)
    row[-1] = any(w in html_extract.INSIDE_TAGS for w in words)
    return row


def test_paths_add_up_to_all_their_words():
    page = '<main class="a b"><nav id=menu><ul><li>x<li class="c d e f g">y<b>z</b></ul></nav><p>u<div>v</main>w'
    found = html_extract.blocks(page)
    assert [b.text for b in found] == ["x", "yz", "u", "v", "w"]
    assert _path(found[1].place) == ["main", ".a", ".b", "nav", ".menu", "ul", "li", ".c", ".d", ".e", ".f", ".g"]
    for b in found:
        assert b.place.row.tolist() == _plain_row(_path(b.place)).tolist()


def test_end_tags_that_may_be_left_out():
    page = "<table><tr><td>a<td>b<table><tr><td>inner</table>c<tr><th>d</table><dl><dt>e<dd>f<dt>g</dl>h"
    found = html_extract.blocks(page)
    depth = {b.text: len(_path(b.place)) for b in found}
    assert depth == {"a": 3, "b": 3, "inner": 6, "c": 3, "d": 3, "e": 2, "f": 2, "g": 2, "h": 0}


def test_elements_left_open_cost_the_same_however_many():
    for piece in ("<div>x ", "<td>x ", "<i>x</u>", "<p class='a b'>x "):
        long, started = piece * (200_000 // len(piece)), time.perf_counter()
        found = html_extract.blocks(long)
        if piece != "<i>x</u>":
            assert len(found) == 200_000 // len(piece)
        html_extract.features(found)
        assert time.perf_counter() - started < 20  # minutes, where every block spells its path out
