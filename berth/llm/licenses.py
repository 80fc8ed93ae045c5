"""License scans by matching statistics over a suffix automaton of licence texts.

The words of all templates go into one generalised suffix automaton. A document's words stream
through it; at each word the state tells the longest run of words, ending there, that stands in
some template. Where such a run cannot grow, it is a match. Matches of at least LONG words are
chained per template, in the order of both texts and with bounded gaps, and a chain covers a
share of its template. Short phrases are templates of their own, found at every place.

The automaton depends on the templates only. A document is scanned as a stream; what is kept of
it are its matches.

Defined results: a null or empty text has no words, no labels and the score 0; a null doc_id is
kept; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm.common import record_batch, texts, words_of

#: A match that counts for a template has at least so many words.
LONG = 4
#: Words that two chained matches may be apart, in either text.
GAP = 40
#: Share of a template that a chain covers for its label to be given.
COVERED = 0.5

# Phrases with their labels, then wording of widely used licences.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
     " software and associated documentation files (the Software), to deal in the Software without"
     " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
     " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
     " Software is furnished to do so, subject to the following conditions"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or"
     " substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
     " except in compliance with the License. You may obtain a copy of the License at"
     " http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the"
     " License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either"
     " express or implied. See the License for the specific language governing permissions and"
     " limitations under the License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of"
     " the GNU General Public License as published by the Free Software Foundation, either version 3 of"
     " the License, or (at your option) any later version"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
     " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
     " GNU General Public License for more details"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are"
     " permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of"
     " conditions and the following disclaimer"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
     " without fee is hereby granted, provided that the above copyright notice and this permission"
     " notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
     " copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free"
     " to copy, modify, publish, use, compile, sell, or distribute this software"),
]

SCANS = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)
_SCAN_SCHEMA = pa.schema(
    [
        *((n, pa.int64()) for n in ("doc_id", "n_words", "n_base", "first_word", "last_word")),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ]
)


@dataclass
class State:
    length: int
    link: int
    next: dict[int, int] = field(default_factory=dict)
    #: Template -> where, in words, the state's runs first end there.
    ends: dict[int, int] = field(default_factory=dict)
    #: Phrases that are suffixes of the state's longest run.
    phrases: tuple[int, ...] = ()


@dataclass(frozen=True)
class Match:
    start: int  # in words of the document
    length: int
    ends: Mapping[int, int]  # template -> end of the match there


class Automaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, templates: Iterable[tuple[str, str]], phrases: Mapping[str, str]):
        self.states = [State(0, -1)]
        self.ids: dict[bytes, int] = {}
        self.labels: list[str] = []
        self.sizes: list[int] = []
        self.phrase_labels = list(phrases.values())
        self.phrase_sizes: list[int] = []
        for label, text in templates:
            words = self.words(text)
            self.add(words, len(self.labels))
            self.labels.append(label)
            self.sizes.append(len(words))
        phrase_state = []
        for phrase in phrases:
            words = self.words(phrase)
            phrase_state.append(self.add(words, None))
            self.phrase_sizes.append(len(words))
        # A state's runs are suffixes of those of the states that link to it.
        by_length = sorted(range(1, len(self.states)), key=lambda s: self.states[s].length)
        for s in reversed(by_length):
            for template, end in self.states[s].ends.items():
                ends = self.states[self.states[s].link].ends
                ends[template] = min(end, ends.get(template, end))
        for s in by_length:
            own = tuple(k for k, p in enumerate(phrase_state) if p == s)
            self.states[s].phrases = self.states[self.states[s].link].phrases + own

    def words(self, text: str) -> list[int]:
        return [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]

    def _split(self, above: int, below: int, word: int) -> int:
        copy = State(
            self.states[above].length + 1, self.states[below].link,
            dict(self.states[below].next), dict(self.states[below].ends),
        )
        self.states.append(copy)
        new = len(self.states) - 1
        self.states[below].link = new
        while above >= 0 and self.states[above].next.get(word) == below:
            self.states[above].next[word] = new
            above = self.states[above].link
        return new

    def add(self, words: list[int], template: int | None) -> int:
        """Add a sequence; returns the state of the whole."""
        last = 0
        for end, word in enumerate(words, 1):
            known = self.states[last].next.get(word)
            if known is not None:
                fits = self.states[known].length == self.states[last].length + 1
                last = known if fits else self._split(last, known, word)
            else:
                self.states.append(State(self.states[last].length + 1, 0))
                new, above = len(self.states) - 1, last
                while above >= 0 and word not in self.states[above].next:
                    self.states[above].next[word] = new
                    above = self.states[above].link
                if above >= 0:
                    below = self.states[above].next[word]
                    fits = self.states[below].length == self.states[above].length + 1
                    self.states[new].link = below if fits else self._split(above, below, word)
                last = new
            if template is not None:
                self.states[last].ends.setdefault(template, end)
        return last

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[Match]]:
        """(start, phrase) of all phrases, and all matches of LONG words that cannot grow."""
        found: list[tuple[int, int]] = []
        matches: list[Match] = []
        states = self.states
        state, length, at = states[0], 0, -1
        get = self.ids.get
        for at, word in enumerate(map(get, words)):
            if word is None:
                if length >= LONG:
                    matches.append(Match(at - length, length, state.ends))
                if length:
                    state, length = states[0], 0
                continue
            following = state.next.get(word)
            if following is None:
                if length >= LONG:
                    matches.append(Match(at - length, length, state.ends))
                while following is None and state.link >= 0:
                    state = states[state.link]
                    length = state.length
                    following = state.next.get(word)
                if following is None:
                    length = 0
                    continue
            state = states[following]
            length += 1
            for phrase in state.phrases:
                if self.phrase_sizes[phrase] <= length:
                    found.append((at + 1 - self.phrase_sizes[phrase], phrase))
        if length >= LONG:
            matches.append(Match(at + 1 - length, length, state.ends))
        return found, matches

    def coverage(self, matches: list[Match]) -> dict[int, float]:
        """Template -> share of it that its best chain of matches covers."""
        best: dict[int, float] = {}
        open_chains: dict[int, list[int]] = {}  # template -> end in document, end there, covered
        for match in matches:
            stop = match.start + match.length
            for template, end in match.ends.items():
                begin = end - match.length
                chain = open_chains.get(template)
                if chain and begin >= chain[1] - match.length and end > chain[1] and (
                    match.start - chain[0] <= GAP and begin - chain[1] <= GAP
                ):
                    chain[2] += end - max(begin, chain[1])
                    chain[:2] = stop, end
                else:
                    chain = open_chains[template] = [stop, end, match.length]
                share = chain[2] / self.sizes[template]
                best[template] = max(best.get(template, 0.0), share)
        return best


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    return Automaton(TEMPLATES, PHRASES)


def scan_text(text: str) -> tuple:
    """The columns of SCANS behind doc_id."""
    own = automaton()
    words = words_of(text)
    found, matches = own.scan(words)
    covered = own.coverage(matches)
    base = {own.phrase_labels[p] for _, p in found}
    labels = base | {own.labels[t] for t, share in covered.items() if share >= COVERED}
    starts = [s for s, _ in found]
    score = max([0.5 if found else 0.0, *covered.values()])
    return (
        len(words), len(found), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), min(score, 1.0),
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row for each document; the columns are SCANS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t) for t in texts(batch.column(1))]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield record_batch(_SCAN_SCHEMA, [batch.column(0), *columns])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCANS)


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, template, label, start, length): matches of LONG words and more, in words."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("template", pa.int32()), ("label", pa.string()),
         ("start", pa.int64()), ("length", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton()
        for batch in batches:
            rows = [
                (doc_id, t, own.labels[t], m.start, m.length)
                for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True)
                for m in own.scan(words_of(text))[1]
                for t in m.ends
            ]
            yield record_batch(schema, list(zip(*rows, strict=True)) or [[]] * 5)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, template int, label string, start long, length long"
    )
