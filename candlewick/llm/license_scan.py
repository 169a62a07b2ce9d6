"""Licence scan by matching statistics on a generalised suffix automaton.

The templates are licence notices and phrases, cut into words.  All their word
sequences go into one generalised suffix automaton: a state stands for word
sequences with the same ends in the templates, its suffix link leads to the
longest of their suffixes with more ends.

A text is streamed once, word by word (A-Z lower-cased, words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``).  At every word the automaton gives the
matching statistics: the longest run of words ending there that stands in any
template, and its state.  From them follow

* the places of the phrases: a phrase ends at a word if its state is the
  current one or lies on its suffix links, and the run is long enough;
* the long matches: a run of at least ``MIN_WORDS`` words of a template (or the
  whole of a shorter one) that neither the text's nor the template's next word
  prolongs.

Matches of one template are chained: a chain's matches follow each other in
template and text (what overlaps counts once), with at most ``MAX_GAP`` text
words between two.  The chain that covers the most template words wins; it is
a covered span if it covers ``COVERED`` of the template.  It is closed when the
text has left it by more than the gap, or when a match after it can't lengthen
it any more (the next copy begins), so the matches held are those of the last
gap and template, whatever the text's length.  Labels of spans and phrases are the
document's; its score is the largest covered share of any notice, and 1 where a
phrase stands.  A covered span inside that of another template which covers
more words is not told apart from it and dropped ("Attribution" in
"Attribution-ShareAlike").

The automaton is built from a stated set of templates, at most
``TEMPLATE_WORDS`` words, and broadcast; more is a ValueError.

Edge cases: null and empty texts have no words, no labels and score 0.  Texts
of any length are streamed in pieces of ``PIECE`` bytes.  A template without
words is ignored; templates that repeat words or each other are fine.  Repeated
rows get equal results.  An empty table gives an empty result.  Other columns
pass through; a column named like the output is replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches, worker_cache

MIN_WORDS = 4
MAX_GAP = 12
COVERED = 0.8
PIECE = 1 << 20
TEMPLATE_WORDS = 200_000

# Fixed value: the word pattern, on UTF-8 bytes (bytes from \x80 up belong to words).
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

#: Phrases that are looked for as they stand, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Licence notices as their publishers word them, with their labels.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction, including '
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer."),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
            "(at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
             "License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
            "to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

_SPAN = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first", pa.int64()), ("last", pa.int64()),
                   ("covered", pa.int32()), ("words", pa.int32())])
_RESULT = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                     ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
                     ("labels", pa.list_(pa.string())), ("spans", pa.list_(_SPAN)), ("score", pa.float64())])
_RESULT_DDL = ("struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, "
               "base_labels: array<string>, labels: array<string>, spans: array<struct<label: string, template: int, "
               "first: bigint, last: bigint, covered: int, words: int>>, score: double>")


def words_of(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return WORD.findall(raw.lower())


class Automaton:
    """Generalised suffix automaton of word sequences.

    ``next``, ``link`` and ``length`` are its states; ``ends[s]`` lists the
    (template, position) that made state s (clones have none: theirs are those
    of the states below them in the tree of links)."""

    def __init__(self, templates: list[list[bytes]]):
        self.templates = templates
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [[]]
        self.coded = [[self.ids.setdefault(w, len(self.ids)) for w in t] for t in templates]
        for t, words in enumerate(self.coded):
            last = 0
            for at, w in enumerate(words):
                last = self._grown(last, w)
                self.ends[last].append((t, at))
        self.below: list[list[int]] = [[] for _ in self.next]
        for s in range(1, len(self.next)):
            self.below[self.link[s]].append(s)

    def _state(self, length: int, link: int, arcs: dict) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, w: int) -> int:
        """The state of p's longest sequence with ``w``, cut out of a longer one if it has to be."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _grown(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w)
        return new

    def state_of(self, words: list[int]) -> int:
        s = 0
        for w in words:
            s = self.next[s][w]
        return s

    def ends_below(self, state: int, besides: int = -1) -> Iterator[tuple[int, int]]:
        """(template, position) of all ends of a state's sequences, without those of ``besides``."""
        stack = [state]
        while stack:
            s = stack.pop()
            if s != besides:
                yield from self.ends[s]
                stack += self.below[s]


class Scanner:
    """Automaton, phrases and thresholds as a worker uses them."""

    def __init__(self, notices: list[tuple[str, str]], phrases: dict[str, str], min_words: int, max_gap: int,
                 covered: float):
        named = [(label, words_of(text), False) for label, text in notices]
        named += [(label, words_of(text), True) for text, label in phrases.items()]
        named = [x for x in named if x[1]]
        self.labels, self.phrase = [x[0] for x in named], [x[2] for x in named]
        self.sizes = [len(x[1]) for x in named]
        self.max_gap, self.covered = max_gap, covered
        self.least = [min(min_words, n) for n in self.sizes]
        a = self.automaton = Automaton([x[1] for x in named])
        # phrases that end where a state's sequences do: their own state's, and those on its suffix links
        own: dict[int, list[int]] = {}
        for t, is_phrase in enumerate(self.phrase):
            if is_phrase:
                own.setdefault(a.state_of(a.coded[t]), []).append(t)
        by_length = sorted(range(1, len(a.next)), key=a.length.__getitem__)
        self.phrases_at: list[tuple] = [()] * len(a.next)
        for s in by_length:
            self.phrases_at[s] = (*own.get(s, ()), *self.phrases_at[a.link[s]])
        # the shortest run that is a long match of a notice at or below the state
        self.needs = [min((self.least[t] for t, _ in e if not self.phrase[t]), default=1 << 30) for e in a.ends]
        for s in reversed(by_length):
            self.needs[a.link[s]] = min(self.needs[a.link[s]], self.needs[s])


def pieces(raw: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that cut no word."""
    at = 0
    while at < len(raw):
        m = _BREAK.search(raw, at + size) if at + size < len(raw) else None
        end = m.start() if m else len(raw)
        yield raw[at:end].lower()
        at = end


def statistics(scanner: Scanner, raw: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(word number, state, run, next word's id or None), for the words whose run is not empty.

    The last item yielded has state -1 and the number of words."""
    a = scanner.automaton
    arcs, link, length, known = a.next, a.link, a.length, a.ids.get
    state = run = n = 0
    held = None
    for piece in pieces(raw):
        found = list(map(known, WORD.findall(piece)))
        for at, w in enumerate(found, n):
            if held is not None:
                yield *held, w
                held = None
            if w is None:
                state = run = 0
                continue
            while state and w not in arcs[state]:
                state = link[state]
                run = length[state]
            if w in arcs[state]:
                state = arcs[state][w]
                run += 1
                held = (at, state, run)
        n += len(found)
    if held is not None:
        yield *held, None
    yield n, -1, 0, None


class _Chains:
    """Chains of one template's matches.  ``done`` has the closed ones that won
    (covered, first word, last word)."""

    def __init__(self, size: int, max_gap: int, enough: float):
        self.size, self.max_gap, self.enough = size, max_gap, enough
        self.open: list[tuple] = []   # (template end, text end, first word of the chain, covered)
        self.best = None
        self.done: list[tuple] = []

    def close(self) -> None:
        if self.best:
            self.done.append(self.best)
        self.open, self.best = [], None

    def add(self, t_end: int, end: int, run: int) -> None:
        """A match of ``run`` words that ends at word ``end``, in the order of the ends."""
        begin, t_begin = end - run + 1, t_end - run + 1
        if self.open and begin - self.open[-1][1] - 1 > self.max_gap:
            self.close()
        # a match to come begins after end - size
        self.open = [m for m in self.open if end - m[1] <= self.max_gap + self.size]
        covered, first = run, begin
        for te, e, f, c in self.open:
            if te < t_end and e < end and begin - e - 1 <= self.max_gap:
                more = c + run - max(0, te - t_begin + 1, e - begin + 1)
                if (more, f) > (covered, first):
                    covered, first = more, f
        if self.best and begin > self.best[2] and covered <= self.best[0] and self.best[0] >= self.enough * self.size:
            self.close()
            covered, first = run, begin
        self.open.append((t_end, end, first, covered))
        if self.best is None or covered > self.best[0]:
            self.best = (covered, first, end)


def scan(scanner: Scanner, text: str | None) -> dict:
    """One document: its phrases, covered spans, labels and score."""
    a = scanner.automaton
    chains: dict[int, _Chains] = {}
    n_base, first, last, base = 0, None, None, set()
    n_words = 0
    for at, state, run, follows in statistics(scanner, (text or "").encode()):
        if state < 0:
            n_words = at
            break
        for t in scanner.phrases_at[state]:
            if scanner.sizes[t] <= run:
                start = at - scanner.sizes[t] + 1
                n_base += 1
                first = start if first is None else min(first, start)
                last = start if last is None else max(last, start)
                base.add(scanner.labels[t])
        s, long, child = state, run, -1
        while s > 0 and long >= scanner.needs[s]:
            for t, end in a.ends_below(s, child):
                whole = a.coded[t]
                if long >= scanner.least[t] and not scanner.phrase[t] and whole[end + 1:end + 2] != [follows]:
                    if t not in chains:
                        chains[t] = _Chains(len(whole), scanner.max_gap, scanner.covered)
                    chains[t].add(end, at, long)
            child, s = s, a.link[s]
            long = a.length[s]
    spans, score = [], 1.0 if n_base else 0.0
    for t, found in chains.items():
        found.close()
        for covered, begin, end in found.done:
            share = covered / scanner.sizes[t]
            score = max(score, share)
            if share >= scanner.covered:
                spans.append({"label": scanner.labels[t], "template": t, "first": begin, "last": end,
                              "covered": covered, "words": scanner.sizes[t]})
    spans = apart(spans)
    return {"n_words": n_words, "n_base": n_base, "first_word": first, "last_word": last, "base_labels": sorted(base),
            "labels": sorted(base | {x["label"] for x in spans}), "spans": spans, "score": score}


def apart(spans: list[dict]) -> list[dict]:
    """Spans in text order, without those inside one that covers more."""
    out, active = [], []
    for x in sorted(spans, key=lambda x: (x["first"], -x["last"], -x["covered"], x["template"])):
        active = [y for y in active if y["last"] >= x["first"]]
        if not any(y["last"] >= x["last"] and y["covered"] > x["covered"] for y in active):
            out.append(x)
            active.append(x)
    return out


def scan_licenses(df: DataFrame, text: str = "text", out: str = "license",
                  notices: Iterable[tuple[str, str]] = tuple(NOTICES), phrases: dict[str, str] | None = None,
                  min_words: int = MIN_WORDS, max_gap: int = MAX_GAP, covered: float = COVERED) -> DataFrame:
    """Add struct column ``out``: n_words, n_base, first_word, last_word (places
    of phrases), base_labels, labels, spans (words first to last, covered words
    of the template's words) and score."""
    notices, phrases = list(notices), dict(PHRASES if phrases is None else phrases)
    size = sum(len(words_of(x)) for x in [*(t for _, t in notices), *phrases])
    if size > TEMPLATE_WORDS:
        raise ValueError(f"the templates have {size} words, at most {TEMPLATE_WORDS} are broadcast")
    if min_words < 1 or max_gap < 0:
        raise ValueError("min_words >= 1 and max_gap >= 0")
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((notices, phrases))
    name = uuid.uuid4().hex

    @F.arrow_udf(_RESULT_DDL)
    def scanned(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store, at = worker_cache(), ("license", name)
        if at not in store:
            store.clear()
            store[at] = Scanner(*shared.value, min_words, max_gap, covered)
        for texts in it:
            yield pa.array([scan(store[at], t.as_py()) for t in texts], _RESULT)

    return df.withColumn(out, scanned(F.col(text)))
