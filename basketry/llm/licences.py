"""Licence scan: matching statistics of a text against a suffix automaton of all templates.

The templates (phrases, notices, licence texts) are sequences of words; one generalised
suffix automaton holds every run of words of any of them. A text is streamed through it
word by word, which gives for each word the longest run ending there that some template
contains. Maximal runs are anchors; anchors of one template that follow each other in text
and template are chained, and a chain that covers enough of its template is a found span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from basketry.llm.tasks import alnum_words, map_arrow, table, texts_of

# Base phrases and their labels.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Public licence notices, shortened to their characteristic sentences.
TEMPLATES = (
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("mit-notice", "Released under the MIT License"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    (
        "gpl-notice",
        "This work is licensed under the GNU General Public License, version 3",
    ),
    (
        "gpl-text",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software.",
    ),
    (
        "apache-text",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ),
)


@dataclass(frozen=True)
class Chaining:
    """Anchors have ``least_run`` words; a chain bridges ``gap`` words in text and template;
    a found span covers ``least_cover`` of its template."""

    least_run: int = 3
    gap: int = 12
    least_cover: float = 0.75


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[set[tuple[int, int]]] = [set()]

    def _state(self, length: int, link: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, state: int, word: int) -> int:
        """State of ``state``'s longest run followed by ``word``, split off if it must be."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def add(self, words: list[int], template: int) -> None:
        last = 0
        for position, word in enumerate(words):
            if word in self.next[last]:
                last = self._split(last, word)
            else:
                state, new = last, self._state(self.length[last] + 1, 0, {})
                while state >= 0 and word not in self.next[state]:
                    self.next[state][word] = new
                    state = self.link[state]
                if state >= 0:
                    self.link[new] = self._split(state, word)
                last = new
            self.ends[last].add((template, position + 1))

    def finish(self) -> None:
        """Hands the ends of each run to its suffixes."""
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]


class Scanner:
    """Matching statistics, phrase places and covered spans of one text at a time."""

    def __init__(self, phrases, templates, chaining: Chaining):
        self.phrases, self.chaining = phrases, chaining
        self.labels = [label for label, _ in (*phrases, *templates)]
        texts = [alnum_words(t.encode()) for _, t in (*phrases, *templates)]
        self.sizes = [len(words) for words in texts]
        if not all(self.sizes):
            raise ValueError("a template without words")
        self.numbers: dict[bytes, int] = {}
        self.automaton = SuffixAutomaton()
        for number, words in enumerate(texts):
            ids = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
            self.automaton.add(ids, number)
        self.automaton.finish()
        # Phrases that are suffixes of the longest run of a state.
        own, self.marks = self.automaton, [[] for _ in self.automaton.link]
        for state in sorted(range(1, len(own.link)), key=lambda s: own.length[s]):
            here = [
                p
                for p in range(len(phrases))
                if self.sizes[p] == own.length[state] and (p, self.sizes[p]) in own.ends[state]
            ]
            self.marks[state] = [*here, *self.marks[own.link[state]]]

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(position, state, length) where the longest known run has two words or more."""
        step, link, length = self.automaton.next, self.automaton.link, self.automaton.length
        known = self.numbers.get
        state = run = 0
        for position, word in enumerate(map(known, words)):
            if word is None:
                state = run = 0
                continue
            while state and word not in step[state]:
                state = link[state]
                run = length[state]
            if word in step[state]:
                state = step[state][word]
                run += 1
                yield position, state, run

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple]]:
        """Phrase places (start, phrase) and spans (start, end, template, cover)."""
        places: list[tuple[int, int]] = []
        anchors: dict[int, list[tuple[int, int, int]]] = {}
        before = (-2, 0, 0)

        def close(position: int, state: int, run: int) -> None:
            if run >= self.chaining.least_run:
                first: dict[int, int] = {}
                for template, end in sorted(self.automaton.ends[state]):
                    first.setdefault(template, end)
                for template, end in first.items():
                    anchors.setdefault(template, []).append((position + 1 - run, run, end))

        for position, state, run in self.statistics(words):
            for phrase in self.marks[state]:
                if run >= self.sizes[phrase]:
                    places.append((position + 1 - self.sizes[phrase], phrase))
            if before[0] + 1 != position or run <= before[2]:
                close(*before)
            before = (position, state, run)
        close(*before)
        spans = [
            span
            for template, found in sorted(anchors.items())
            for span in self._chains(template, found)
        ]
        return sorted(places), spans

    def _chains(self, template: int, anchors: list[tuple[int, int, int]]) -> Iterator[tuple]:
        """Chains of anchors (start in text, words, end in template) in text order."""
        limit = self.chaining.gap
        start = end = reached = covered = 0
        for at, run, to in [*anchors, (None, 0, 0)]:
            if covered and (
                at is None
                or at - end > limit
                or to <= reached
                or to - run - reached > limit
            ):
                if covered >= self.chaining.least_cover * self.sizes[template]:
                    yield start, end, template, covered / self.sizes[template]
                covered = 0
            if at is None:
                return
            if not covered:
                start, end, reached = at, at, to - run
            # An anchor may overlap the one before it, in the text or in the template.
            covered += min(at + run - max(at, end), to - max(to - run, reached))
            end, reached = at + run, to


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, spans string"
)


def scan_licences(
    docs: DataFrame,
    phrases=PHRASES,
    templates=TEMPLATES,
    chaining: Chaining = Chaining(),
) -> DataFrame:
    """One row per document with the places of phrases and the spans of templates.

    ``spans`` lists ``label:first word:end word`` of chains, ``score`` is the highest share
    of a template that a chain covers, 1 where a phrase stands. A null or empty text has no
    words, null places, empty labels and score 0. Repeated rows are scanned as they come;
    columns other than ``doc_id`` and ``text`` are not read. A narrow map without shuffle.
    """
    own = Scanner(phrases, templates, chaining)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = []
            for text in texts_of(batch):
                words = alnum_words(text)
                places, spans = own.scan(words)
                base = {own.labels[p] for _, p in places}
                labels = base | {own.labels[t] for *_, t, _ in spans}
                starts = [s for s, _ in places]
                rows.append(
                    (
                        len(words),
                        len(places),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(labels)),
                        min(1.0, max([float(bool(places)), *(c for *_, c in spans)])),
                        ",".join(f"{own.labels[t]}:{s}:{e}" for s, e, t, _ in sorted(spans)),
                    )
                )
            names = SCHEMA.replace(",", "").split()[2::2]
            columns = list(zip(*rows)) or [()] * len(names)
            yield {"doc_id": batch.column("doc_id"), **dict(zip(names, columns))}

    return map_arrow(docs.select("doc_id", "text"), SCHEMA, run)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))
