"""Licence scans: templates with optional and replaceable regions as automata over words.

A template's mandatory words have to stand in a text as they are; what is marked optional may be missing, and a
replaceable region takes any words within its bounds. All templates are compiled into one automaton that
reads a text once. Its sets of states are made into states of their own as texts lead to them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.license_texts import LICENSES, PHRASES, Template
from emberfold.llm.worker import once, pieces, small_batches

# Bytes of a text read at a time.
SLICE_BYTES = 1 << 20
# Sets of states remembered per Python worker; beyond, they are found anew.
MEMO_STATES = 20_000

_TAG = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
_WORDS = re.compile(r'words="(\d+)-(\d+)"')
# Lower-cases A-Z; what is neither a digit, a letter nor beyond ASCII parts words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
                 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_LETTERS).split()


def regions(markup: str) -> list[tuple]:
    """A template as ``("word", w)``, ``("any", least, most)`` and ``("optional", regions)``."""
    stack: list[list[tuple]] = [[]]
    for k, part in enumerate(_TAG.split(markup)):
        if k % 2 == 0:
            stack[-1] += [("word", w) for w in words_of(part)]
        elif part == "beginOptional":
            stack.append([])
        elif part == "endOptional":
            if len(stack) == 1:
                raise ValueError("an optional region ends that has not begun")
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        else:
            bounds = _WORDS.search(part)
            if bounds is None:
                raise ValueError(f"a replaceable region without its number of words: {part}")
            stack[-1].append(("any", int(bounds[1]), int(bounds[2])))
    if len(stack) > 1:
        raise ValueError("an optional region does not end")
    if not any(kind == "word" for kind, *_ in stack[0]):
        raise ValueError("a template needs mandatory words")
    return stack[0]


class Automaton:
    """All templates as one automaton; state k leads to k + 1 by its word, or by a jump to a later state.

    Sets of states are the bits of an integer.
    """

    def __init__(self, templates: Sequence[Template]):
        self.templates = list(templates)
        self.by_word: dict[bytes | None, int] = {None: 0}
        self.any, self.jumps, self.begins, self.ends = 0, [], [], []
        self.size = 0
        for template in self.templates:
            self.begins.append(self.size)
            self._add(regions(template.text))
            self.ends.append(self.size)
            self.size += 1
        self.start = 0
        for begin in self.begins:
            self.start |= self._closed(1 << begin)
        self.accepting = 0
        for end in self.ends:
            self.accepting |= 1 << end
        if self.start & self.accepting:
            raise ValueError("a template accepts no words at all")
        self.longest = max((e - b for b, e in zip(self.begins, self.ends)), default=0)
        # words that lead on from the start; all, if a template may begin with any word
        self.first = None if self.start & self.any else {
            w for w, bits in self.by_word.items() if w is not None and bits & self.start}
        self._forget()

    def _add(self, parts: list[tuple]) -> None:
        for kind, *more in parts:
            if kind == "word":
                self.by_word[more[0]] = self.by_word.get(more[0], 0) | 1 << self.size
                self.size += 1
            elif kind == "optional":
                begin = self.size
                self._add(more[0])
                self.jumps.append((begin, self.size))
            else:
                least, most = more
                for k in range(most):
                    self.any |= 1 << self.size
                    self.size += 1
                self.jumps += [(self.size - most + k, self.size) for k in range(least, most)]

    def _closed(self, states: int) -> int:
        """With all that jumps reach; an inner jump is listed before the one around it."""
        while True:
            more = states
            for here, there in self.jumps:
                if more >> here & 1:
                    more |= 1 << there
            if more == states:
                return states
            states = more

    def _forget(self) -> None:
        self.sets, self.known, self.steps, self.found = [], {}, [], []
        self._name(self.start)

    def _name(self, states: int) -> int:
        if states not in self.known:
            self.known[states] = len(self.sets)
            self.sets.append(states)
            self.steps.append({})
            self.found.append([t for t, end in enumerate(self.ends) if states >> end & 1])
        return self.known[states]

    def step(self, state: int, word: bytes) -> int:
        """The name of the set that ``word`` leads to, by way of the memory."""
        kept = word if word in self.by_word else None
        states = self.sets[state]
        then = self._closed((states & (self.by_word[kept] | self.any)) << 1) | self.start
        if len(self.sets) >= MEMO_STATES and then not in self.known:
            self._forget()
            return self._name(then)
        name = self._name(then)
        self.steps[state][kept] = name
        return name

    def begin_of(self, template: int, words: list[bytes], last: int) -> int:
        """The earliest place from which the template accepts the words up to ``last``."""
        begin, states, found = 1 << self.begins[template], 1 << self.ends[template], last
        place = last
        back = [(h, t) for h, t in self.jumps if self.begins[template] <= h <= self.ends[template]]
        while True:
            for here, there in reversed(back * 2):
                if states >> there & 1:
                    states |= 1 << here
            if states & begin and place < last:
                found = place + 1
            if place < 0 or not states:
                return found
            word = words[place]
            states = states >> 1 & (self.by_word.get(word, 0) | self.any)
            states &= (1 << self.ends[template]) - begin
            place -= 1

    def scan(self, text: str, slice_bytes: int = SLICE_BYTES) -> tuple[int, list[tuple[int, int, int]]]:
        """How many words, and ``(template, first word, last word)``: of equal ends the earliest begin, of equal
        begins the latest end."""
        data = text.encode().translate(_LETTERS)
        places: dict[tuple[int, int], int] = {}
        state, before, tail, at = 0, 0, [], 0
        first = self.first
        while at < len(data):
            end = data.find(b" ", at + slice_bytes) if len(data) - at > slice_bytes else -1
            words = data[at:end if end >= 0 else len(data)].split()
            at = end + 1 if end >= 0 else len(data)
            begins = iter(range(len(words)) if first is None else [i for i, w in enumerate(words) if w in first])
            steps, i = self.steps, 0
            while True:
                if state == 0:
                    i = next((b for b in begins if b >= i), None)
                    if i is None:
                        break
                while i < len(words):
                    word = words[i]
                    then = steps[state].get(word)
                    if then is None:
                        then = None if word in self.by_word else steps[state].get(None)
                        if then is None:
                            then = self.step(state, word)
                            steps = self.steps
                    state = then
                    for t in self.found[state]:
                        held = tail + words if i < self.longest else words
                        last = i + len(held) - len(words)
                        begin = self.begin_of(t, held, last) + before + i - last
                        places[t, begin] = max(places.get((t, begin), 0), before + i)
                    i += 1
                    if state == 0:
                        break
                if i >= len(words):
                    break
            before += len(words)
            tail = (tail + words)[-self.longest:] if len(words) < self.longest else words[-self.longest:]
        return before, sorted((t, begin, end) for (t, begin), end in places.items())


def covered(places: list[tuple[int, int, int]]) -> int:
    """Words that lie in any place."""
    total, done = 0, -1
    for first, last in sorted((p[1], p[2]) for p in places):
        if last > done:
            total += last - max(first, done + 1) + 1
            done = last
    return total


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: Sequence[Template] = (*PHRASES, *LICENSES)) -> DataFrame:
    """``doc_id, n_words, n_covered, places``: where templates accept words of a text.

    ``places`` lists ``template, label, first_word, last_word`` in the order of the templates, ``n_covered`` counts the words
    in any of them. Words are digits, letters A-Z in lower case and all beyond ASCII. Of a template's
    places with the same last word the longest counts, of those with the same first word too. Texts are
    read whole, a slice at a time, and the automaton goes on from one to the next.

    Nothing is shuffled. A NULL or empty text has no words and no places; NULL and repeated ids keep
    a row per row; an empty table gives none.
    """
    rows = small_batches(df).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    templates = tuple(templates)

    def run(batches):
        automaton = once(("licenses", templates), lambda: Automaton(templates))
        kind = pa.list_(pa.struct([("template", pa.string()), ("label", pa.string()),
                                   ("first_word", pa.int64()), ("last_word", pa.int64())]))
        for batch in pieces(batches, "text"):
            counts, inside, places = [], [], []
            for text in batch.column("text").to_pylist():
                n, found = automaton.scan(text or "")
                counts.append(n)
                inside.append(covered(found))
                places.append([{"template": templates[t].name, "label": templates[t].label, "first_word": a,
                                "last_word": b} for t, a, b in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(inside, pa.int64()),
                 pa.array(places, kind)], names=["doc_id", "n_words", "n_covered", "places"])

    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_covered bigint, places array<struct<template: string, "
                                "label: string, first_word: bigint, last_word: bigint>>")


def license_labels(scanned: DataFrame, phrases: Sequence[Template] = PHRASES) -> DataFrame:
    """Sums up :func:`scan_licenses` per text.

    ``n_base`` places of ``phrases``, the smallest and largest of their ``first_word`` (NULL without any), their labels and
    those of all templates, each once, in order and joined by commas; ``score`` is the share of the words that
    lie in licence wording.
    """
    names = F.array(*[F.lit(p.name) for p in phrases])
    base = F.filter("places", lambda p: F.array_contains(names, p["template"]))
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(
        F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform(base, lambda p: p["first_word"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.when(F.col("n_words") > 0, F.col("n_covered") / F.col("n_words")).otherwise(0.0).alias("score"))
