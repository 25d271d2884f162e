"""Licence scan: a generalised suffix automaton of licence tokens, streamed over the texts.

The automaton holds every run of words of every licence template and base
phrase. A text passes through it word by word and yields matching statistics:
at each word, the longest run ending there that some template holds. Long runs
are chained, per template, into spans that cover part of it in order.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.llm.shared import map_arrow, slices, utf8
from vestibule.llm.words import ALNUM

# Phrases that name a licence, and the label of each.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public licence notices, by label.
TEMPLATES = {
    "agpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation"
    ),
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": (
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied"
    ),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"
    ),
    "isc-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted"
    ),
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "mit-release": "Released under the MIT License",
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"
    ),
}

# Words in a run that counts toward a template, and the covered share that labels a text.
MIN_RUN = 3
MIN_COVER = 0.6
# Bytes of a text that are split into words at a time.
BLOCK = 1 << 20

SCAN = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [
                        ("label", pa.string()),
                        ("start", pa.int64()),
                        ("end", pa.int64()),
                        ("covered", pa.float64()),
                    ]
                )
            ),
        ),
    ]
)


def word_list(text: str) -> list[bytes]:
    """The words of a template or phrase, as the scan sees them."""
    return text.encode().translate(ALNUM).split()


def word_blocks(raw: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text in order, a bounded number of bytes at a time."""
    start = 0
    while start < len(raw):
        end = min(start + size, len(raw))
        block = raw[start:end].translate(ALNUM)
        if end < len(raw) and (cut := block.rfind(b" ")) >= 0:
            end, block = start + cut + 1, block[:cut]
        elif end < len(raw):  # one word fills the block: take it whole
            rest = raw[end:].translate(ALNUM)
            cut = rest.find(b" ")
            cut = len(rest) if cut < 0 else cut
            end, block = end + cut, block + rest[:cut]
        yield block.split()
        start = end


class LicenseAutomaton:
    """Generalised suffix automaton over the words of templates and base phrases."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.labels = list(templates)
        self.lengths = [len(word_list(t)) for t in templates.values()]
        self.phrase_labels = list(phrases.values())
        phrase_words = [word_list(p) for p in phrases]
        self.phrase_lengths = [len(words) for words in phrase_words]
        if not all(self.lengths) or not all(self.phrase_lengths):
            raise ValueError("a template or phrase has no words")
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.size = [0]
        ends: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, text in enumerate(templates.values()):
            state = 0
            for i, word in enumerate(word_list(text)):
                state = self._extend(state, word)
                ends[state].append((t, i + 1))
        last = []
        for words in phrase_words:
            state = 0
            for word in words:
                state = self._extend(state, word)
            last.append(state)
        self.vocabulary = frozenset(w for arcs in self.next for w in arcs)
        # Where in which templates a state's run ends: its own places and its suffix children's.
        places: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for state, found in ends.items():
            while state > 0:
                places[state].extend(found)
                state = self.link[state]
        self.places = [tuple(sorted(set(p))) for p in places]
        # Which phrases end wherever a state's run ends.
        self.phrases: list[tuple[int, ...]] = []
        for state in range(len(self.next)):
            found, up = [], state
            while up > 0:
                found.extend(p for p, s in enumerate(last) if s == up)
                up = self.link[up]
            self.phrases.append(tuple(found))

    def _extend(self, last: int, word: bytes) -> int:
        """Add ``word`` behind the run that ends in state ``last``."""
        known = self.next[last].get(word)
        if known is not None:
            if self.size[known] == self.size[last] + 1:
                return known
            return self._split(last, word, known)
        new = self._state({}, self.size[last] + 1)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            target = self.next[at][word]
            fits = self.size[target] == self.size[at] + 1
            self.link[new] = target if fits else self._split(at, word, target)
        return new

    def _state(self, arcs: dict[bytes, int], size: int) -> int:
        self.next.append(arcs)
        self.size.append(size)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, at: int, word: bytes, target: int) -> int:
        """A copy of ``target`` for the runs no longer than that of ``at`` plus ``word``."""
        copy = self._state(dict(self.next[target]), self.size[at] + 1)
        self.link[copy], self.link[target] = self.link[target], copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy


@dataclass
class Scan:
    """One text on its way through the automaton."""

    automaton: LicenseAutomaton
    n_words: int = 0
    state: int = 0
    length: int = 0
    previous: int = -2
    base: list[int] = field(default_factory=list)
    base_labels: set[str] = field(default_factory=set)
    runs: list[tuple[int, int, int]] = field(default_factory=list)

    def feed(self, words: list[bytes]) -> None:
        auto, base = self.automaton, self.n_words
        known = auto.vocabulary
        for i in [i for i, word in enumerate(words) if word in known]:
            self._step(base + i, words[i])
        self.n_words = base + len(words)

    def _step(self, at: int, word: bytes) -> None:
        auto = self.automaton
        if at != self.previous + 1:
            self._close()
            self.state = self.length = 0
        state = self.state
        if word not in auto.next[state]:
            self._close()
            while state > 0 and word not in auto.next[state]:
                state = auto.link[state]
                self.length = auto.size[state]
        self.state = auto.next[state].get(word, 0)
        self.length = self.length + 1 if self.state else 0
        self.previous = at
        for p in auto.phrases[self.state]:
            if (n := auto.phrase_lengths[p]) <= self.length:
                self.base.append(at - n + 1)
                self.base_labels.add(auto.phrase_labels[p])

    def _close(self) -> None:
        """Keep the run that ends before the next word, if it is long."""
        if self.length >= MIN_RUN:
            self.runs.append((self.previous + 1, self.length, self.state))

    def finish(self) -> dict:
        self._close()
        spans = [s for s in chain_runs(self.automaton, self.runs) if s["covered"] >= MIN_COVER]
        labels = self.base_labels | {s["label"] for s in spans}
        score = max([1.0 if self.base else 0.0, *(s["covered"] for s in spans)])
        return {
            "n_words": self.n_words,
            "n_base": len(self.base),
            "first_word": min(self.base, default=None),
            "last_word": max(self.base, default=None),
            "base_labels": ",".join(sorted(self.base_labels)),
            "labels": ",".join(sorted(labels)),
            "score": score,
            "spans": spans,
        }


def chain_runs(automaton: LicenseAutomaton, runs: list[tuple[int, int, int]]) -> list[dict]:
    """Chain runs ``(end, length, state)`` in text order into covered spans of templates.

    A chain goes on while the next run lies further on in the template and the
    gap in the text is at most the template's length; else a new one begins.
    """
    spans: list[dict] = []
    open_chains: dict[int, list[int]] = {}  # template: text start, text end, template end, covered

    def close(t: int) -> None:
        start, end, _, covered = open_chains.pop(t)
        spans.append(
            {
                "label": automaton.labels[t],
                "start": start,
                "end": end,
                "covered": covered / automaton.lengths[t],
            }
        )

    for end, length, state in runs:
        # Per template the first place beyond the chain's end, else the first place.
        best: dict[int, int] = {}
        for t, place in automaton.places[state]:
            reached = open_chains[t][2] if t in open_chains else -1
            if t not in best or best[t] <= reached < place:
                best[t] = place
        for t, place in best.items():
            chain = open_chains.get(t)
            if chain and (place <= chain[2] or end - length - chain[1] > automaton.lengths[t]):
                close(t)
                chain = None
            if chain is None:
                open_chains[t] = [end - length, end, place, length]
            else:
                chain[3] += min(length, place - chain[2])
                chain[1], chain[2] = end, place
    for t in list(open_chains):
        close(t)
    return sorted(spans, key=lambda s: (s["start"], s["label"]))


def scan_text(automaton: LicenseAutomaton, raw: bytes) -> dict:
    scan = Scan(automaton)
    for words in word_blocks(raw):
        scan.feed(words)
    return scan.finish()


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: counts, places and labels of licences, and their spans.

    ``spans`` lists the covered template spans as word positions ``[start, end)``
    with the covered share of the template; ``score`` is 1 where a base phrase
    stands, else the largest share. Null and empty texts have no words, no labels
    and score 0. Repeated rows and repeated ids give a row each. Other columns
    are not read. The automaton's size is that of the templates; memory in a task
    does not grow with a text beyond its own bytes.
    """
    automaton = LicenseAutomaton(templates or TEMPLATES, phrases or BASE_PHRASES)

    def scan(batches):
        for rows in slices(batches):
            found = [scan_text(automaton, raw) for raw in rows["raw"]]
            columns = {name: [f[name] for f in found] for name in SCAN.names if name != "doc_id"}
            yield pa.RecordBatch.from_pydict({"doc_id": rows["doc_id"], **columns}, schema=SCAN)

    return map_arrow(docs.select("doc_id", utf8(F.col(text)).alias("raw")), scan, SCAN)
