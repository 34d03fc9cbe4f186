"""Licence scans with a generalised suffix automaton of licence wording.

All templates are in one automaton over words. A text is streamed through it: at each word the automaton knows the
longest match with any template that ends there. Matches that cannot be extended and are long enough become anchors;
anchors that follow each other in the text and in a template are chained, and the share of the template that a chain
covers decides on its label. Words outside the templates' vocabulary end every match, so only runs of known words are
streamed; they are found for all texts of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesloom.llm.words import groups, word_hashes

IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# Phrases that count wherever they stand.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of common licence notices, as words.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license "
                   "is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights "
            "to this work"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published "
            "by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    *[(label, phrase) for phrase, label in BASE.items()],
]
LEAST_MATCH = 3       # words of an anchor; a shorter template must match as a whole
LARGEST_GAP = 8       # words of the text between two anchors of a chain
LEAST_COVERED = 0.6   # of a template's words, for its label


class Automaton:
    """Generalised suffix automaton of sequences of numbers, with the places where each state's words end."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for which, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].append((which, place + 1))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] += self.ends[state]
        self.ends[0] = []

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, parent: int, word: int) -> int:
        """The state for the parent's words and one more, apart from longer words that share its transition."""
        state = self.next[parent][word]
        if self.length[state] == self.length[parent] + 1:
            return state
        copy = self._state(self.length[parent] + 1)
        self.next[copy], self.link[copy] = dict(self.next[state]), self.link[state]
        self.link[state] = copy
        while parent >= 0 and self.next[parent].get(word) == state:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new, parent = self._state(self.length[last] + 1), last
        while parent >= 0 and word not in self.next[parent]:
            self.next[parent][word] = new
            parent = self.link[parent]
        self.link[new] = self._split(parent, word) if parent >= 0 else 0
        return new

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest match that ends at each word."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield state, length

    def anchors(self, words: list[int], start: int, least: int) -> Iterator[tuple[int, int, int, int]]:
        """Matches that the next word does not extend: template, its first word, the text's first word, length."""
        found = [*self.statistics(words), (0, 0)]
        for i, (state, length) in enumerate(found[:-1]):
            if length and found[i + 1][1] <= length:
                for which, end in self.ends[state]:
                    if length >= least or length == end == self.whole[which]:
                        yield which, end - length, start + i + 1 - length, length


class Scanner:
    """The automaton of a list of templates (label, words), with the hashes of their vocabulary."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES):
        self.labels = [label for label, _ in templates]
        words = sorted({w for _, text in templates for w in text.split()})
        hashes, _ = self._hash(" ".join(words))
        self.number = dict(zip(words, range(len(words))))
        order = np.argsort(hashes)
        self.hashes, self.order = hashes[order], order
        sequences = [[self.number[w] for w in text.split()] for _, text in templates]
        self.automaton = Automaton(sequences)
        self.automaton.whole = self.whole = [len(s) for s in sequences]
        self.base = {label: [self.number[w] for w in phrase.split()] for phrase, label in BASE.items()}

    @staticmethod
    def _hash(text: str) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(text.encode(), np.uint8)
        return word_hashes(data, np.array([0, len(data)]), IS_WORD, 3)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the vocabulary, -1 if it has none."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def covered(self, known: np.ndarray) -> dict[str, float]:
        """Best covered share of a template for each label, over a text's word numbers."""
        chains: dict[int, tuple[int, int, int]] = {}  # template: end in the text, end in the template, covered
        best: dict[str, float] = {}
        in_run = np.concatenate([[False], known >= 0, [False]])
        edges = np.flatnonzero(in_run[1:] != in_run[:-1])
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if stop - start < min(LEAST_MATCH, *self.whole):
                continue
            for which, place, at, n in self.automaton.anchors(known[start:stop].tolist(), start, LEAST_MATCH):
                end, place_end, size = chains.get(which, (0, 0, 0))
                if size and place >= place_end and 0 <= at - end <= LARGEST_GAP:
                    size += n
                else:
                    size = n
                chains[which] = (at + n, place + n, size)
                label = self.labels[which]
                best[label] = max(best.get(label, 0.0), min(1.0, size / self.whole[which]))
        return best

    def scan(self, known: np.ndarray) -> tuple:
        """The figures of one text: base places with first and last, base labels, labels and score."""
        starts, base = [], []
        for label, phrase in self.base.items():
            size = len(known) - len(phrase) + 1
            if size > 0:
                here = np.ones(size, bool)
                for k, word in enumerate(phrase):
                    here &= known[k:k + size] == word
                if here.any():
                    base.append(label)
                    starts.append(np.flatnonzero(here))
        best = self.covered(known)
        places = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        labels = sorted({*base, *(label for label, share in best.items() if share >= LEAST_COVERED)})
        return (len(known), len(places), int(places.min()) if len(places) else None,
                int(places.max()) if len(places) else None, ",".join(sorted(base)), ",".join(labels),
                max([0.0, *best.values()]))


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                    ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                    ("labels", pa.string()), ("score", pa.float64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    one = scanner()
    for batch in batches:
        keys, rows = batch.column(0).to_pylist(), []
        for data, bounds in groups(batch.column(1)):
            hashes, before = word_hashes(data, bounds, IS_WORD, 3)
            known = one.numbers(hashes)
            for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
                rows.append((keys[len(rows)], *one.scan(known[a:b])))
        columns = list(zip(*rows)) or [[]] * len(RESULT)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT)


def scan(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text; other columns are ignored).

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII. Null texts are empty: no words,
    no places, empty labels, score 0. ``score`` is the largest share of a template that a chain covers. Texts are
    scanned whole and each by itself, so nothing is shuffled.
    """
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        _scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
               "labels string, score double")
