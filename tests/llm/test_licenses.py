"""Licence scans against a plain matcher that tries every place."""

import re
from collections import Counter

import pytest
from conftest import *  # noqa: F401,F403
from hypothesis import given, settings, strategies as st

from emberfold.llm.license_texts import LICENSES, PHRASES, Template
from emberfold.llm.licenses import Automaton, license_labels, regions, scan_licenses
from emberfold.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ends(parts, words, at):
    """All places behind the words that the regions can take from ``at`` on."""
    here = {at}
    for kind, *more in parts:
        if kind == "word":
            here = {p + 1 for p in here if p < len(words) and words[p].encode() == more[0]}
        elif kind == "any":
            here = {p + n for p in here for n in range(more[0], more[1] + 1) if p + n <= len(words)}
        else:
            here |= {e for p in here for e in ends(more[0], words, p)}
    return here


def plain_places(text, templates):
    words, out = plain_words(text), []
    for t, template in enumerate(templates):
        parts = regions(template.text)
        begin_of = {}
        for at in range(len(words)):
            for end in ends(parts, words, at):
                begin_of.setdefault(end - 1, at)
        last = {}
        for end, begin in begin_of.items():
            last[begin] = max(last.get(begin, 0), end)
        out += sorted((t, begin, end) for begin, end in last.items())
    return len(words), out


def plain_row(name, text):
    templates = [*PHRASES, *LICENSES]
    n, places = plain_places(text, templates)
    base = [p for p in places if p[0] < len(PHRASES)]
    inside = {k for _, a, b in places for k in range(a, b + 1)}
    labels = lambda found: ",".join(sorted({templates[t].label for t, _, _ in found}))
    return (name, n, len(base), min((a for _, a, _ in base), default=None), max((a for _, a, _ in base), default=None),
            labels(base), labels(places), len(inside) / n if n else 0.0)


def filled(template, optional=True):
    """A text that the template accepts."""
    def say(parts):
        for kind, *more in parts:
            if kind == "word":
                yield more[0].decode()
            elif kind == "any":
                yield from ["Somebody"] * more[1 if optional else 0]
            elif optional:
                yield from say(more[0])
    return " ".join(say(regions(template.text)))


TEXTS = ["GNU General  Public\tLicense; cc-by. CC BY-NC 4.0 mit-license", "gnu general public licenses", "GNU\nGENERAL (PUBLIC) license",
         "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.", "ccby cc by1 ccé by cc by",
         "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.",
         "mit license mit license", None, "", "...", "é ÀÉ x"]


@pytest.mark.parametrize("template", LICENSES, ids=lambda t: t.name)
def test_templates_accept_their_wording(template):
    automaton = Automaton([*PHRASES, *LICENSES])
    for optional in (True, False):
        text = "x " + filled(template, optional).upper().replace(" ", ", ") + " y"
        n, places = automaton.scan(text)
        assert any(automaton.templates[t].label == template.label and (a, b) == (1, n - 2) for t, a, b in places)
        assert (n, places) == plain_places(text, automaton.templates)
    # one mandatory word changed
    words = filled(template).split()
    changed = " ".join(["other" if w == words[-1] else w for w in words])
    optional_end = regions(template.text)[-1][0] == "optional"
    assert optional_end or template.name not in {automaton.templates[t].name for t, _, _ in automaton.scan(changed)[1]}


def test_query_equals_plain_version(spark, sf_dir, docs):
    got = Counter(tuple(r) for r in QUERIES["op13_licenses"](spark, sf_dir).collect())
    rows = docs.select("doc_id", "text").collect()
    assert got == Counter(plain_row(*r) for r in rows)
    assert any("apache-2.0" in r[6] for r in got) and any(r[2] == 0 and not r[6] for r in got)


def test_odd_texts(spark, odd, empty):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()] + [(100 + k, t) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "cast(null as int) AS places", "cast(null as int) AS n_words")
    assert Counter(tuple(r) for r in license_labels(scan_licenses(df)).collect()) == Counter(plain_row(*r) for r in rows)
    assert scan_licenses(empty).count() == 0


OWN = [Template("a", "a", "a b <<beginOptional>>c <<beginOptional>>d<<endOptional>><<endOptional>> e"),
       Template("b", "b", "<<beginOptional>>a<<endOptional>> b <<var;name=\"x\";words=\"0-2\">> a"),
       Template("c", "c", "c <<var;name=\"x\";words=\"1-3\">><<beginOptional>> b<<endOptional>>"),
       Template("d", "d", "<<var;name=\"x\";words=\"1-1\">> d <<beginOptional>>e <<var;name=\"x\";words=\"1-2\">><<endOptional>> a"),
       Template("e", "e", "b")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f".split()), max_size=30), st.sampled_from([1, 5, 1000]),
       st.sampled_from([OWN, OWN[:3], OWN[:1]]))
def test_random_words(words, slice_bytes, templates):
    text = " ".join(words)
    assert Automaton(templates).scan(text, slice_bytes) == plain_places(text, templates)


def test_small_memory_gives_the_same(monkeypatch):
    from emberfold.llm import licenses
    text = " ".join("abcdef"[k * k % 7 % 6] for k in range(500)) + " " + filled(LICENSES[0])
    want = Automaton([*OWN, *LICENSES]).scan(text)
    monkeypatch.setattr(licenses, "MEMO_STATES", 3)
    assert Automaton([*OWN, *LICENSES]).scan(text, 50) == want


@pytest.mark.parametrize("markup", ["<<beginOptional>>a", "a<<endOptional>>", "<<var;name=\"x\">> a",
                                    "<<beginOptional>>a<<endOptional>>"])
def test_wrong_markup_raises(markup):
    with pytest.raises(ValueError):
        regions(markup)
