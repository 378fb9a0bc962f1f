"""Licence scans by matching statistics of a generalised suffix automaton.

The automaton holds every run of words of the licence templates. A file is streamed
through it word by word, which gives, at each word, the longest run ending there
that some template holds (the matching statistics). Maximal runs of at least
``MIN_MATCH`` words are chained, template by template, into spans whose words stand
in the template's order; a span that covers enough of its template is a find.
Where spans overlap, the one that covers more of its template stays.

Words that no template holds reset the automaton, so only stretches of template
words are streamed; a file costs one dictionary lookup per word beside that. The
automaton is a fixed value of this module's size and travels with the tasks' code.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import map_texts

# Phrases that name a licence by themselves, and wordings of licences
# and notices that are in common use.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify,"
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the Software.",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed"
        " to in writing, software distributed under the License is distributed on an \"AS IS\""
        " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    (
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation; either"
        " version 2 of the License, or (at your option) any later version.",
    ),
    ("lgpl-3", "licensed under the GNU Lesser General Public License, version 3"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If"
        " a copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/.",
    ),
    ("mpl-2", "licensed under the Mozilla Public License, version 2.0"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer.",
    ),
    ("bsd-3", "licensed under the BSD 3-Clause License"),
    ("bsd-2", "licensed under the BSD 2-Clause License"),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    ("isc", "licensed under the ISC License"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1", "licensed under the CC0 1.0 Universal Public Domain Dedication"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "cc-by-sa",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    (
        "cc-by-nc",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
)
# End of fixed values.

#: Shortest run of words that counts as a match.
MIN_MATCH = 3
#: Most file words between two matches of one span.
MAX_GAP = 8
#: Least part of a template's words that a span must match.
MIN_COVERAGE = 0.8

#: Bytes of words (digits, a-z and all beyond ASCII) stay, A-Z become small, others separate.
_TO_WORDS = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split()


@dataclass
class _State:
    longest: int
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)


class SuffixAutomaton:
    """All runs of the added sequences; state 0 is the empty run."""

    def __init__(self):
        self.states = [_State(0)]
        self.ends: list[set[tuple[int, int]]] = [set()]
        self._sequences = 0

    def _new(self, longest: int, link: int, following: dict[int, int]) -> int:
        self.states.append(_State(longest, link, following))
        self.ends.append(set())
        return len(self.states) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """A state for the runs of ``target`` no longer than those of ``at`` and the word."""
        old = self.states[target]
        copy = self._new(self.states[at].longest + 1, old.link, dict(old.next))
        old.link = copy
        while at >= 0 and self.states[at].next.get(word) == target:
            self.states[at].next[word] = copy
            at = self.states[at].link
        return copy

    def _extend(self, last: int, word: int) -> int:
        states = self.states
        target = states[last].next.get(word)
        if target is not None:
            if states[target].longest == states[last].longest + 1:
                return target
            return self._split(last, word, target)
        made, at = self._new(states[last].longest + 1, 0, {}), last
        while at >= 0 and word not in states[at].next:
            states[at].next[word] = made
            at = states[at].link
        if at >= 0:
            target = states[at].next[word]
            if states[target].longest != states[at].longest + 1:
                target = self._split(at, word, target)
            states[made].link = target
        return made

    def add(self, sequence: Iterable[int]) -> int:
        """Add all runs of ``sequence``; returns the state of the whole."""
        at = 0
        for position, word in enumerate(sequence):
            at = self._extend(at, word)
            self.ends[at].add((self._sequences, position))
        self._sequences += 1
        return at

    def close(self) -> None:
        """Give each state all places where its runs end: its own and those of longer runs."""
        for i in sorted(range(1, len(self.states)), key=lambda i: -self.states[i].longest):
            self.ends[self.states[i].link] |= self.ends[i]

    def find(self, sequence: Iterable[int]) -> int:
        at = 0
        for word in sequence:
            at = self.states[at].next[word]
        return at


@dataclass(frozen=True)
class Span:
    label: str
    template: int
    first_word: int
    last_word: int
    coverage: float


class Scanner:
    """Finds base phrases and template spans in texts."""

    def __init__(self, base=BASE_PHRASES, templates=TEMPLATES):
        base = [(label, words_of(text)) for label, text in base]
        templates = [(label, words_of(text)) for label, text in templates]
        self.base_labels = [label for label, _ in base]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(words) for _, words in templates]
        self.ids: dict[bytes, int] = {}
        coded = [
            [self.ids.setdefault(word, len(self.ids) + 1) for word in words]
            for _, words in [*templates, *base]
        ]
        automaton = SuffixAutomaton()
        for sequence in coded:
            automaton.add(sequence)
        automaton.close()
        self.automaton = automaton
        # For each state: template ends of its runs, and base phrases that end its runs.
        n = len(templates)
        self.ends = [sorted(x for x in ends if x[0] < n) for ends in automaton.ends]
        phrases = {}
        for number, sequence in enumerate(coded[n:]):
            phrases.setdefault(automaton.find(sequence), []).append((number, len(sequence)))
        self.phrases: list[list[tuple[int, int]]] = []
        for i in range(len(automaton.states)):
            found, at = [], i
            while at >= 0:
                found += phrases.get(at, [])
                at = automaton.states[at].link
            self.phrases.append(found)

    def _stream(self, ids: list[int], start: int, matches: list, base: list) -> None:
        """Matching statistics of a stretch of template words, from file word ``start`` on."""
        states, at, length = self.automaton.states, 0, 0
        for position, word in enumerate(ids, start):
            following = states[at].next.get(word)
            if following is None:
                if length >= MIN_MATCH:
                    matches.append((position, length, at))
                while following is None and at:
                    at = states[at].link
                    length = states[at].longest
                    following = states[at].next.get(word)
                if following is None:
                    continue
            at, length = following, length + 1
            for number, size in self.phrases[at]:
                if length >= size:
                    base.append((position - size + 1, number))
        if length >= MIN_MATCH:
            matches.append((start + len(ids), length, at))

    def _spans(self, matches: list[tuple[int, int, int]]) -> list[Span]:
        """Chains of matches that cover enough of a template, the better of any that overlap."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for end, length, state in matches:
            for template, last in self.ends[state]:
                by_template.setdefault(template, []).append((end - length, last + 1 - length, length))
        found = []
        for template, pieces in by_template.items():
            size = self.sizes[template]
            pieces.sort()
            best, first, reach = [], [], max(length for _, _, length in pieces)
            for i, (start, place, length) in enumerate(pieces):
                total, origin = length, start
                for j in range(i - 1, -1, -1):
                    s, p, n = pieces[j]
                    if s + reach + MAX_GAP < start:
                        break
                    near = s + n <= start <= s + n + MAX_GAP
                    if near and p + n <= place and best[j] + length > total:
                        total, origin = best[j] + length, first[j]
                best.append(total)
                first.append(origin)
                if total >= MIN_COVERAGE * size:
                    found.append(
                        Span(self.labels[template], template, origin, start + length - 1, total / size)
                    )
        found.sort(key=lambda s: (-s.coverage, s.first_word - s.last_word, s.first_word, s.template))
        kept: list[Span] = []
        taken: set[int] = set()
        for span in found:
            place = range(span.first_word, span.last_word + 1)
            if taken.isdisjoint(place):
                taken.update(place)
                kept.append(span)
        return sorted(kept, key=lambda s: s.first_word)

    def scan(self, text: str) -> tuple[int, list[tuple[int, str]], list[Span]]:
        """Number of words, base phrases as (first word, label), and template spans."""
        words = words_of(text)
        n = len(words)
        if n < MIN_MATCH:
            return n, [], []
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.int32, n)
        known = ids > 0
        triples = known[:-2] & known[1:-1] & known[2:]
        if not triples.any():
            return n, [], []
        edges = np.flatnonzero(np.diff(triples, prepend=False, append=False))
        matches: list[tuple[int, int, int]] = []
        base: list[tuple[int, int]] = []
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            self._stream(ids[start : end + 2].tolist(), start, matches, base)
        places = sorted({(start, self.base_labels[number]) for start, number in base})
        return n, places, self._spans(matches) if matches else []


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, base_places and spans for each row of ``docs``.

    ``base_places`` are the base phrases (first word, label); ``spans`` the covered
    template spans (label, template, first_word, last_word, coverage). Null and
    empty texts have no words and empty lists; repeated rows give one result each;
    no rows give no rows.
    """

    def start():
        held = scanner()

        def work(texts):
            found = [held.scan(text) for text in texts]
            yield [n for n, _, _ in found]
            yield [[{"first_word": w, "label": x} for w, x in places] for _, places, _ in found]
            yield [[vars(span) for span in spans] for _, _, spans in found]

        return work

    return map_texts(
        docs,
        start,
        "n_words long, base_places array<struct<first_word: long, label: string>>,"
        " spans array<struct<label: string, template: int, first_word: long, last_word: long,"
        " coverage: double>>",
        id_col,
        text_col,
    )


def digest(scanned: DataFrame) -> DataFrame:
    """One line per file: counts, places and labels of ``scan_licenses``.

    ``score`` is 1 where a base phrase stands, else the best coverage of a span, else 0.
    """

    def names(labels):
        return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))

    base, spans = F.col("base_places"), F.col("spans")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base.first_word).alias("first_word"),
        F.array_max(base.first_word).alias("last_word"),
        names(base.label).alias("base_labels"),
        names(F.concat(base.label, spans.label)).alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max(spans.coverage), F.lit(0.0)))
        .alias("score"),
        "spans",
    )
