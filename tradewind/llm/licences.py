"""Licence scans with a generalised suffix automaton over the words of licence templates.

The automaton recognises every run of words that stands in some template. A text is streamed
through it once: after each word it holds the longest suffix that is such a run (the matching
statistic). Runs that cannot be extended and have ``MIN_MATCH`` words or more become anchors,
and anchors in rising order of both text and template are chained into covered template spans.
The automaton grows with the templates only, and the working memory of a text with its words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phrases that are reported by themselves, and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Public licence notices. The Apache, GPL, LGPL, MPL, MIT, BSD and ISC texts as their
# authors ask to put them into files.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
               "except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the "
             "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
            "of the MPL was not distributed with this file, You can obtain one at"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted, provided that the above copyright notice and this permission notice "
            "appear in all copies"),
)
MIN_MATCH = 4
MIN_COVERED = 0.6

SCHEMA = ("n_words long, places array<struct<label: string, start: long, end: long>>, "
          "spans array<struct<label: string, start: long, end: long, covered: double>>")
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                             ("covered", pa.float64())]))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """Runs of a-z, 0-9 and anything beyond ASCII, after lower-casing A-Z alone."""
    return _WORD.findall(text.encode().lower())


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with the places where each state ends."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.ids: dict[bytes, int] = {}
        for number, words in enumerate(sequences):
            last = 0
            for i, word in enumerate(words):
                last = self._extend(last, self.ids.setdefault(word, len(self.ids)))
                self.ends[last].append((number, i + 1))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]
        self.ends = [sorted(set(e)) for e in self.ends]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, source: int, target: int, word: int) -> int:
        """A copy of ``target`` that ends the shorter runs which reach it through ``source``."""
        copy = self._state(self.length[source] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while source >= 0 and self.next[source].get(word) == target:
            self.next[source][word] = copy
            source = self.link[source]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, word)
        new, at = self._state(self.length[last] + 1, 0, {}), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            exact = self.length[target] == self.length[at] + 1
            self.link[new] = target if exact else self._split(at, target, word)
        return new

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(position, state, length) for each word that ends a run of the templates."""
        state = length = 0
        edges, link, longest = self.next, self.link, self.length
        for i, word in enumerate(map(self.ids.get, words)):
            if word is None:
                state = length = 0
                continue
            while state and word not in edges[state]:
                state = link[state]
                length = longest[state]
            state = edges[state].get(word, 0)
            length = length + 1 if state else 0
            if state:
                yield i, state, length


    def whole(self, sizes: list[int]) -> list[list[int]]:
        """By state, the sequences of these sizes (the first ones) that end a run of the state."""
        found: list[list[int]] = [[] for _ in self.next]
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            own = [n for n, stop in self.ends[state] if n < len(sizes) and stop == sizes[n] == self.length[state]]
            found[state] = sorted({*own, *found[self.link[state]]})
        return found


@cache
def automaton() -> tuple[SuffixAutomaton, list[int], list[list[int]]]:
    """The automaton of phrases and templates, the sizes of both, and the phrases that end in a state."""
    parts = [words_of(text) for text, _ in PHRASES] + [words_of(text) for _, text in TEMPLATES]
    auto, sizes = SuffixAutomaton(parts), [len(p) for p in parts]
    return auto, sizes, auto.whole(sizes[:len(PHRASES)])


def _chains(anchors: list[tuple[int, int, int]], size: int) -> Iterator[tuple[int, int, float]]:
    """Best chains of one template as (start, end, share covered), not overlapping in the text.

    ``anchors``: (text start, template start, length). Each is joined to the best earlier one that
    ends before it in text and template and starts at most two template lengths before it.
    """
    anchors = sorted(anchors)
    best, before, first = [], [], 0
    for j, (at, pos, n) in enumerate(anchors):
        while anchors[first][0] < at - 2 * size:
            first += 1
        found = max(((best[i], i) for i in range(first, j)
                     if anchors[i][0] + anchors[i][2] <= at and anchors[i][1] + anchors[i][2] <= pos),
                    default=(0, -1))
        best.append(found[0] + n)
        before.append(found[1])
    taken: set[int] = set()
    for j in sorted(range(len(anchors)), key=lambda j: (-best[j], j)):
        if best[j] < MIN_COVERED * size:
            break
        path, i = [], j
        while i >= 0 and i not in taken:
            path.append(i)
            i = before[i]
        covered = sum(anchors[i][2] for i in path)
        taken.update(path)
        if covered >= MIN_COVERED * size:
            yield anchors[path[-1]][0], anchors[j][0] + anchors[j][2], covered / size


def scan_text(text: str) -> tuple[int, list[dict], list[dict]]:
    """Number of words, places of the phrases, and covered template spans of one text."""
    (auto, sizes, phrases), words = automaton(), words_of(text)
    places, anchors = [], defaultdict(list)

    def anchor(end: int, state: int, length: int) -> None:
        for number, stop in auto.ends[state]:
            if number >= len(PHRASES):
                anchors[number].append((end - length, stop - length, length))

    held = None
    for i, state, length in auto.statistics(words):
        for number in phrases[state]:
            if sizes[number] <= length:
                places.append({"label": PHRASES[number][1], "start": i + 1 - sizes[number], "end": i + 1})
        if held and (held[0] != i or length != held[2] + 1):
            anchor(*held)
        held = (i + 1, state, length) if length >= MIN_MATCH else None
    if held:
        anchor(*held)
    spans = [{"label": TEMPLATES[number - len(PHRASES)][0], "start": a, "end": b, "covered": share}
             for number, found in anchors.items() for a, b, share in _chains(found, sizes[number])]
    return len(words), places, sorted(spans, key=lambda s: (s["start"], s["end"], s["label"]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [scan_text(text.as_py() or "") for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([f[0] for f in found], pa.int64()),
             pa.array([f[1] for f in found], _PLACES), pa.array([f[2] for f in found], _SPANS)],
            names=["doc_id", "n_words", "places", "spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``places`` of the phrases and template ``spans``.

    Starts and ends count words from 0, ends exclusive. A null or empty text has no words and empty
    lists; a text without matches has empty lists; repeated rows and null ids give a row each.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(_scan, f"doc_id {kind}, {SCHEMA}"))
