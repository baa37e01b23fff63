"""License scan: matching statistics over a generalised suffix automaton of license words.

All templates go into one suffix automaton whose letters are words. Streaming a text
through it gives, at every word, the longest stretch ending there that stands in some
template. Short phrases are found exactly, from the suffix links; long stretches are
chained per template, in text and template order, and the covered share is the score.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from dataclasses import dataclass, field
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import per_text, with_struct

# The phrases of the base search and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices that go with well-known licenses, as their publishers print them.
TEMPLATES = {
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE.""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied.""",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}

# Letters A-Z become lower case; of the ASCII characters only letters and digits belong to words.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_TO_WORDS).split()


@dataclass
class State:
    length: int
    link: int
    next: dict[bytes, int] = field(default_factory=dict)


class SuffixAutomaton:
    """Of several word sequences; every state knows the places (sequence, end) of its longest string."""

    def __init__(self, sequences: list[list[bytes]]):
        self.states = [State(0, -1)]
        ends: list[set[tuple[int, int]]] = [set()]
        for k, words in enumerate(sequences):
            at = 0
            for i, word in enumerate(words):
                at = self._extend(at, word)
                while len(ends) < len(self.states):
                    ends.append(set())
                ends[at].add((k, i))
        order = sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length)
        for s in order:
            if self.states[s].link > 0:
                ends[self.states[s].link] |= ends[s]
        self.ends = [sorted(e) for e in ends]

    def _clone(self, p: int, word: bytes, q: int) -> int:
        copy = len(self.states)
        old = self.states[q]
        self.states.append(State(self.states[p].length + 1, old.link, dict(old.next)))
        while p >= 0 and self.states[p].next.get(word) == q:
            self.states[p].next[word] = copy
            p = self.states[p].link
        old.link = copy
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        states = self.states
        q = states[last].next.get(word)
        if q is not None:
            return q if states[q].length == states[last].length + 1 else self._clone(last, word, q)
        new = len(states)
        states.append(State(states[last].length + 1, 0))
        p = last
        while p >= 0 and word not in states[p].next:
            states[p].next[word] = new
            p = states[p].link
        if p >= 0:
            q = states[p].next[word]
            states[new].link = q if states[q].length == states[p].length + 1 else self._clone(p, word, q)
        return new

    def walk(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """Matching statistics (word index, state, length), where the length is over 0."""
        states, out = self.states, []
        known = states[0].next
        at = length = 0
        for i, word in enumerate(words):
            if not at:
                if word not in known:
                    continue
                at, length = known[word], 1
            else:
                while at and word not in states[at].next:
                    at = states[at].link
                    length = states[at].length
                if word not in states[at].next:
                    continue
                at, length = states[at].next[word], length + 1
            out.append((i, at, length))
        return out


def chained(matches: list[tuple[int, int, int]], window: int, least: float) -> tuple[int, list[tuple[int, int, int]]]:
    """The most that a chain of (text start, template start, length) covers, and chains as (covered, first word, end).

    Stretches of a chain follow each other in the text and in the template, at most
    ``window`` words apart in the text; where two overlap, the later one counts with what is
    left of it. The chain that covers most (then the shortest, then the first) is taken, and
    again among the stretches beside it, as long as one covers ``least``. ``matches`` are sorted.
    """
    starts = [m[0] for m in matches]
    reach = window + max((m[2] for m in matches), default=0)
    best: list[tuple[int, int] | None] = [None] * len(matches)
    ends: list[int] = []  # of the chains taken, sorted
    queue: list[tuple[int, int, int, int]] = []

    def follow(j: int) -> tuple[int, int]:
        """Most covered, then latest first word, of the chains that end with stretch j."""
        text, place, size = matches[j]
        k = bisect_right(ends, text)
        floor = max(text - reach, ends[k - 1] if k else 0)
        here = (size, text)
        for i in range(j - 1, -1, -1):
            t, p, s = matches[i]
            if t < floor:
                break
            cut = max(0, t + s - text, p + s - place)
            if best[i] and t < text and p < place and cut < size and text - (t + s) <= window:
                here = max(here, (best[i][0] + size - cut, best[i][1]))
        return here

    def keep(j: int, here: tuple[int, int]) -> None:
        best[j] = here
        end = matches[j][0] + matches[j][2]
        if here[0] >= least:
            heappush(queue, (-here[0], end - here[1], here[1], j))

    for j in range(len(matches)):
        keep(j, follow(j))
    most = max((x[0] for x in best), default=0)
    taken = []
    while queue:
        covered, width, first, j = heappop(queue)
        if best[j] != (-covered, first):
            continue
        end = first + width
        taken.append((-covered, first, end))
        insort(ends, end)
        # What overlaps the chain is used up. Stretches after it lose what led up to them; beyond
        # their reach from the last one that changed, all stays as it is.
        changed = end
        for i in range(bisect_right(starts, first - reach - 1), len(matches)):
            text, _, size = matches[i]
            if text > changed + reach:
                break
            if text < end:
                if text + size > first:
                    best[i] = None
            elif best[i] and (here := follow(i)) != best[i]:
                keep(i, here)
                changed = text
    return most, taken


class LicenseScanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, str], least: int, share: float, window: int):
        self.labels = [*phrases.values(), *templates]
        sequences = [words_of(x.encode()) for x in [*phrases, *templates.values()]]
        self.sizes = [len(s) for s in sequences]
        self.n_phrases, self.least, self.share, self.window = len(phrases), least, share, window
        self.automaton = SuffixAutomaton(sequences)
        states = self.automaton.states
        # Phrases that end at a state: those that are whole strings of it or of a link ancestor.
        self.whole: list[list[tuple[int, str]]] = []
        for s in range(len(states)):
            here, at = [], s
            while at > 0:
                for k, i in self.automaton.ends[at]:
                    if k < len(phrases) and i == self.sizes[k] - 1 and states[states[at].link].length < i + 1 <= states[at].length:
                        here.append((i + 1, self.labels[k]))
                at = states[at].link
            self.whole.append(sorted(here))

    def __call__(self, data: bytes) -> tuple:
        words = words_of(data)
        statistics = self.automaton.walk(words)
        places, base = [], set()
        for i, at, length in statistics:
            for size, label in self.whole[at]:
                if size <= length:
                    places.append(i - size + 1)
                    base.add(label)
        score, spans = self.covered(self.stretches(statistics))
        labels = sorted(base | {s["label"] for s in spans})
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            sorted(base),
            labels,
            max(score, 1.0 if base else 0.0),
            spans,
        )

    def stretches(self, statistics: list[tuple[int, int, int]]) -> dict[int, list[tuple[int, int, int]]]:
        """Per template the stretches (text start, template start, length) that it shares with the text, none longer on either side.

        A state's suffix links lead to shorter ends of what was matched, which stand in other templates: for every
        place of a template the first state on the way that has it tells how far back it agrees.
        """
        states, found = self.automaton.states, {}
        before: dict[tuple[int, int], int] = {}  # place that the word before ended at, and how long it agreed
        last = -2

        def end(open_: dict[tuple[int, int], int], i: int) -> None:
            for (k, place), length in open_.items():
                found.setdefault(k, []).append((i - length + 1, place - length + 1, length))

        for i, at, length in statistics:
            here: dict[tuple[int, int], int] = {}
            while at > 0 and length >= self.least:
                for place in self.automaton.ends[at]:
                    if place[0] >= self.n_phrases:
                        here.setdefault(place, length)
                at = states[at].link
                length = states[at].length
            if before and last == i - 1:
                end({(k, p): n for (k, p), n in before.items() if (k, p + 1) not in here}, last)
            else:
                end(before, last)
            before, last = here, i
        end(before, last)
        return found

    def covered(self, by_template: dict[int, list[tuple[int, int, int]]]) -> tuple[float, list[dict]]:
        """The best covered share of a template, and the spans that cover ``share`` of one."""
        score, spans = 0.0, []
        for k, matches in sorted(by_template.items()):
            size = self.sizes[k]
            most, chains = chained(sorted(matches), self.window, self.share * size)
            score = max(score, most / size)
            spans += [{"label": self.labels[k], "start": a, "end": b, "coverage": c / size} for c, a, b in chains]
        return min(1.0, score), sorted(spans, key=lambda s: (s["start"], s["label"], s["end"]))


RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
    "labels array<string>, score double, spans array<struct<label: string, start: bigint, end: bigint, coverage: double>>"
)
RESULT_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def license_columns(
    text: Column,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    least: int = 4,
    share: float = 0.6,
    window: int = 40,
) -> Column:
    def make():
        return LicenseScanner(phrases, templates, least, share, window)

    return per_text(make, RESULT)(text)


def scan_licenses(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with words, phrase places, labels, score and covered template spans (in words).

    A template's label is given where a chain of stretches of at least ``least`` words,
    no further than ``window`` words apart, covers ``share`` of it; each such notice has
    its span, in texts of any length and however many fragments stand around it; templates that share words are
    all found, each by its own stretches. The score is the best
    covered share, and 1 where a phrase of the base search stands. NULL and empty
    texts have no words, no labels and score 0; an empty table gives no rows. Columns of the result's names are replaced.
    Rows are scanned one by one, so long texts and repeated rows gather nowhere.
    """
    return with_struct(docs, license_columns(F.col(text), **options), RESULT_NAMES)
