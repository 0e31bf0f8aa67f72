"""Licence scans: matching statistics of whole texts against a generalised suffix automaton of licence words.

All templates (licence texts, notices and short phrases) are put into one suffix automaton over words.  A text is streamed through
it: after every word the automaton knows the longest stretch ending there that some template holds, and its suffix links
lead to the shorter stretches of other templates.  Stretches on one diagonal (same shift between text and template)
are one match.  Long matches of a template in order, with few foreign words between them, are chained; a chain that covers
enough of its template is a span of that licence."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # of bytes in lower case; UTF-8 has no such byte inside a longer character
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
PIECE = 1 << 16  # bytes of a text that are cut into words at once
MIN_MATCH = 4    # words of a match that counts; a shorter template counts as a whole
SHORT = 16       # a template of fewer words must be covered wholly
MIN_COVER = 0.8  # share of a longer template's words that a span covers
MAX_GAP = 24     # foreign words between two matches of one span

# Phrases whose places are counted, and their labels.
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

# Notices and licence texts as their publishers word them.
NOTICES = [
    ("agpl-3.0", "gnu affero general public license version 3"),
    ("apache-2.0", "apache license version 2 0"),
    ("apache-2.0", "spdx license identifier apache 2 0"),
    ("bsd", "bsd license"),
    ("bsd-2-clause", "spdx license identifier bsd 2 clause"),
    ("bsd-3-clause", "spdx license identifier bsd 3 clause"),
    ("cc-by-4.0", "cc by 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0 international"),
    ("cc-by-nc-4.0", "cc by nc 4 0"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0 international"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0"),
    ("cc-by-nd-4.0", "cc by nd 4 0"),
    ("cc-by-sa-3.0", "cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international"),
    ("cc0-1.0", "cc0 1 0"),
    ("gpl-2.0", "gnu general public license version 2"),
    ("gpl-2.0", "spdx license identifier gpl 2 0"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("gpl-3.0", "spdx license identifier gpl 3 0"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "mit license"),
    ("mit", "spdx license identifier mit"),
    ("mpl-2.0", "mozilla public license version 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
                   "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable "
                   "law or agreed to in writing software distributed under the license is distributed on an as is basis without "
                   "warranties or conditions of any kind either express or implied see the license for the specific language "
                   "governing permissions and limitations under the license"),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
                     "following conditions are met 1 redistributions of source code must retain the above copyright notice this list of "
                     "conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice "
                     "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
                     "distribution"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                     "derived from this software without specific prior written permission"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
            "published by the free software foundation"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
            "merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
            "that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
            "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
            "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do "
            "so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies "
            "or substantial portions of the software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed "
                "with this file you can obtain one at http mozilla org mpl 2 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
             "damages arising from the use of this software permission is granted to anyone to use this software for any purpose including "
             "commercial applications and to alter it and redistribute it freely"),
]


@dataclass(frozen=True)
class Span:
    """Words ``first`` to ``last`` of a text that cover ``covered`` words of a template."""

    label: str
    template: int
    first: int
    last: int
    covered: int
    share: float


def template_words(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


class Automaton:
    """Generalised suffix automaton of templates given as lists of words."""

    def __init__(self, templates: list[list[bytes]]):
        self.templates = templates
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for t in templates for w in t))}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.own: list[list[tuple[int, int]]] = [[]]  # (template, last word) of the prefix that ends in the state
        coded = [[self.vocabulary[w] for w in t] for t in templates]
        for words in coded:
            last = 0
            for c in words:
                last = self._extend(last, c)
        for t, words in enumerate(coded):
            state = 0
            for j, c in enumerate(words):
                state = self.next[state][c]
                self.own[state].append((t, j))
        self.children: list[list[int]] = [[] for _ in self.next]
        for state in range(1, len(self.next)):
            self.children[self.link[state]].append(state)
        self._ends: dict[int, list[tuple[int, int, int]]] = {}

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.own.append([])
        return len(self.next) - 1

    def _split(self, p: int, c: int) -> int:
        """The state after ``p`` by ``c`` whose longest stretch is one word longer than that of ``p``."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c)
        return new

    def ends(self, state: int) -> list[tuple[int, int, int]]:
        """(template, last word, longest length) of every place in a template where a suffix of the state's stretches of two words or more ends.

        The length is that of the state itself, or of the nearest state up the links that has the place."""
        found = self._ends.get(state)
        if found is None:
            seen: dict[tuple[int, int], int] = {}
            at = state
            while self.length[at] >= 2:
                below = [at]
                while below:
                    s = below.pop()
                    for place in self.own[s]:
                        seen.setdefault(place, self.length[at])
                    below.extend(self.children[s])
                at = self.link[at]
            found = self._ends[state] = [(t, e, n) for (t, e), n in seen.items()]
        return found


class Scanner:
    """One text at a time through an automaton whose first templates are counted phrases."""

    def __init__(self, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES, min_match: int = MIN_MATCH,
                 min_cover: float = MIN_COVER, max_gap: int = MAX_GAP):
        self.labels = [label for label, _ in [*phrases, *notices]]
        self.automaton = Automaton([template_words(text) for _, text in [*phrases, *notices]])
        self.sizes = [len(t) for t in self.automaton.templates]
        if min(self.sizes, default=2) < 2:
            raise ValueError("templates have two words or more")
        self.n_phrases, self.min_cover, self.max_gap = len(phrases), min_cover, max_gap
        self.least = [n if t < len(phrases) else min(min_match, n) for t, n in enumerate(self.sizes)]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[Span]]:
        """Number of words, (template, first word) of every phrase, and the spans of notices, by first word."""
        a = self.automaton
        get = a.vocabulary.get
        state, length, before = 0, 0, -2
        n_words = at = 0
        places: list[tuple[int, int]] = []
        spans: list[Span] = []
        matches: dict[tuple[int, int], list[int]] = {}  # (template, shift) -> first and last word of the newest match
        done: list[tuple[int, int, int, int]] = []      # (template, first, last, first word in the template)
        heard = -1
        size = len(text)
        text = text.lower()
        while at < size:
            stop = at + PIECE
            if stop < size:
                gap = _BREAK.search(text, stop)
                stop = gap.start() if gap else size
            codes = np.array([get(w, -1) for w in WORD.findall(text, at, stop)], np.int64)
            for i in np.flatnonzero(codes >= 0).tolist():
                c, i_word = int(codes[i]), n_words + i
                if i_word != before + 1:
                    state = length = 0
                before = i_word
                while state and c not in a.next[state]:
                    state = a.link[state]
                    length = a.length[state]
                state = a.next[state].get(c, 0)
                length = length + 1 if state else 0
                if length < 2:
                    continue
                for t, end, longest in a.ends(state):
                    n = min(length, longest)
                    if n < self.least[t]:
                        continue
                    if t < self.n_phrases:
                        if end == self.sizes[t] - 1:
                            places.append((t, i_word - n + 1))
                        continue
                    if i_word - heard > self.max_gap + 1:
                        spans += self._chains(done, matches)
                    heard = i_word
                    held = matches.get((t, i_word - end))
                    if held and held[1] == i_word - 1:
                        held[1] = i_word
                    else:
                        if held:
                            done.append((t, held[0], held[1], held[0] - (i_word - end)))
                        matches[t, i_word - end] = [i_word - n + 1, i_word]
            n_words += len(codes)
            at = stop
        spans += self._chains(done, matches)
        return n_words, places, sorted(spans, key=lambda s: (s.first, s.last, s.template))

    def _chains(self, done: list, matches: dict) -> list[Span]:
        """The spans of all matches so far, which are forgotten."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for t, first, last, start in done:
            by_template.setdefault(t, []).append((first, last, start))
        for (t, shift), (first, last) in matches.items():
            by_template.setdefault(t, []).append((first, last, first - shift))
        done.clear()
        matches.clear()
        return [s for t, own in by_template.items() for s in self.chain(t, sorted(own))]

    def chain(self, template: int, matches: list[tuple[int, int, int]]) -> list[Span]:
        """Spans of one template from its matches (first word, last word, first word in the template), sorted.

        A chain goes forward in text and template; where a match overlaps the one before, only its new words count.  Of chains that
        overlap the one covering more stays, then the earlier one."""
        size = self.sizes[template]
        best: list[tuple[int, int]] = []  # covered words and first word of the best chain up to each match
        for j, (first, last, start) in enumerate(matches):
            top = (last - first + 1, first)
            for k in range(j - 1, -1, -1):
                f, l, s = matches[k]
                if f < first - self.max_gap - size:
                    break
                new = min(last - l, start + last - first - (s + l - f), last - first + 1)
                if s < start and f < first and new > 0 and first - l - 1 <= self.max_gap and best[k][0] + new > top[0]:
                    top = (best[k][0] + new, best[k][1])
            best.append(top)
        need = size if size < SHORT else self.min_cover * size
        out: list[Span] = []
        for (covered, first), (_, last, _) in sorted(zip(best, matches), key=lambda x: (-x[0][0], x[0][1], x[1][1])):
            if covered >= need and all(last < o.first or first > o.last for o in out):
                out.append(Span(self.labels[template], template, first, last, covered, covered / size))
        return out


FOUND = ("n_words long, places array<struct<label:string,first:long,last:long>>, "
         "spans array<struct<label:string,template:int,first:long,last:long,covered:long,share:double>>")
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first", pa.int64()), ("last", pa.int64()),
                             ("covered", pa.int64()), ("share", pa.float64())]))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: list[tuple[str, str]] = PHRASES,
                  notices: list[tuple[str, str]] = NOTICES, min_match: int = MIN_MATCH, min_cover: float = MIN_COVER,
                  max_gap: int = MAX_GAP) -> DataFrame:
    """(key, n_words, places, spans) of every whole text.

    ``places`` are all places of the ``phrases``, in order; ``spans`` the stretches of words that cover a notice: every word of a notice under
    16 words, else ``min_cover`` of its words by matches of ``min_match`` words or more, not more than ``max_gap`` foreign words apart.
    Words are counted from 0, in lower case (A-Z only).  Both lists of (label, text) are parameters of bounded size; each task builds their automaton.

    Null and empty texts have no words and empty lists.  Rows are scanned one by one: repeated rows and rows with equal or null ids each
    come back.  Other columns are ignored, whatever their names; an empty table gives an empty result.  A text is read in pieces of 64 KB, so that its words
    are never all held."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices, min_match, min_cover, max_gap)
        for b in batches:
            n_words, places, spans = [], [], []
            for whole in b.column(1).cast(pa.large_binary()):
                n, found, chains = scanner.scan(whole.as_py() or b"")
                n_words.append(n)
                places.append([{"label": scanner.labels[t], "first": i, "last": i + scanner.sizes[t] - 1} for t, i in sorted(found, key=lambda x: x[::-1])])
                spans.append([vars(s) for s in chains])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(places, _PLACES), pa.array(spans, _SPANS)],
                                             ["key", "n_words", "places", "spans"])

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"key {kind}, {FOUND}").withColumnRenamed("key", key)


def license_labels(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row a text from the output of :func:`scan_licenses`: counts, labels of the phrases alone and of phrases and spans, and the score:
    the largest share of a template that a place (1) or a span covers."""
    base = F.transform("places", lambda p: p["label"])
    both = F.array_union(base, F.transform("spans", lambda s: s["label"]))
    share = F.array_max(F.transform("spans", lambda s: s["share"]))
    return found.select(key, "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(F.transform("places", lambda p: p["first"])).alias("first_word"),
                        F.array_max(F.transform("places", lambda p: p["first"])).alias("last_word"),
                        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
                        F.array_join(F.array_sort(both), ",").alias("labels"),
                        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(share, F.lit(0.0))).alias("score"), "spans")
