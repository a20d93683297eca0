"""License scans: a generalised suffix automaton over the words of licence texts.

Templates (short licence notices, given below or by the caller) are small and
fixed, so their automaton is built on the driver and shipped with the task. A
text streams through it once: at each word the automaton holds the longest
template substring that ends there (the matching statistic). Right-maximal
matches of ``MIN_WORDS`` and more, found at all their places in the templates,
are chained per template (in order in both, gaps up to ``GAP`` words); a chain
that covers enough of its template labels the text and gives a span. Templates
under ``SHORT`` words are mostly words that any notice has, so share alone does
not do: the words that tell one from all other labels' templates (of these the
capitalised ones, a licence's name, if it has such) must lie in the chain; one
that has none (``licensed under CC BY 4.0``) must stand whole, without other words
between. In turn two words make a match there if such a name is the first.

Base phrases are templates as well: a phrase stands where the state's suffix
chain holds it, so every place counts, not only right-maximal ones.

One scan, one Arrow pass, no shuffle. Defined results: null and empty texts
have no words, no labels and score 0; texts of any length are scanned whole; each
repeated row is scanned alike; labels of equal cover are all given; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewh.llm.common import pick

MIN_WORDS = 3
GAP = 6
COVERED = 0.6
SHORT = 12

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Short notices as their licences word them.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        " files (the \"Software\"), to deal in the Software without restriction",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met",
        "Licensed under the BSD License",
    ],
    "gpl": [
        "licensed under the GNU General Public License",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "lgpl": ["under the terms of the GNU Lesser General Public License"],
    "agpl": ["under the terms of the GNU Affero General Public License"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "cc-by": [
        "licensed under a Creative Commons Attribution 4.0 International License",
        "licensed under the Creative Commons Attribution License",
        "licensed under CC BY 4.0",
    ],
    "cc-by-sa": ["licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "licensed under CC BY-SA 4.0"],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
}

#: Bytes of a word keep their place (A-Z lowered), all others part words.
_WORD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

_WORD_AS_IS = bytes(c if 0x41 <= c <= 0x5A else w for c, w in enumerate(_WORD))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


class Automaton:
    """Generalised suffix automaton of token sequences (Blumer et al.).

    ``step`` moves the matching statistic over a token; ``ends`` gives, for a
    state, all (template, end) places of its substrings.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        places: list[list[tuple[int, int]]] = [[]]
        for t, seq in enumerate(sequences):
            last = 0
            for p, c in enumerate(seq):
                last = self._extend(last, c, places)
                places[last].append((t, p + 1))
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[s] > 0:
                places[self.link[s]] += places[s]
        self.ends = [sorted(set(p)) for p in places]
        self.phrases: list[tuple[tuple[int, int], ...]] = [()] * len(self.size)

    def _new(self, size: int, edges: dict[int, int], link: int, places: list) -> int:
        self.next.append(edges)
        self.size.append(size)
        self.link.append(link)
        places.append([])
        return len(self.size) - 1

    def _split(self, p: int, c: int, q: int, places: list) -> int:
        clone = self._new(self.size[p] + 1, dict(self.next[q]), self.link[q], places)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int, places: list) -> int:
        if (q := self.next[last].get(c)) is not None:  # this prefix is known from another template
            return q if self.size[q] == self.size[last] + 1 else self._split(last, c, q, places)
        now, p = self._new(self.size[last] + 1, {}, 0, places), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = now
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[now] = q if self.size[q] == self.size[p] + 1 else self._split(p, c, q, places)
        return now

    def step(self, state: int, n: int, c: int) -> tuple[int, int]:
        """(state, matched length) after one more token."""
        while state > 0 and c not in self.next[state]:
            state = self.link[state]
            n = self.size[state]
        to = self.next[state].get(c)
        return (0, 0) if to is None else (to, n + 1)

    def mark(self, sequence: list[int], label: int) -> None:
        """Let every state know that this sequence ends where it does."""
        state = 0
        for c in sequence:
            state = self.next[state][c]
        below = {state}
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            if self.link[s] in below:
                below.add(s)
        for s in below:
            self.phrases[s] += ((len(sequence), label),)


class Scanner:
    """Templates, phrases and their automaton; picklable and small."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
                 min_words: int = MIN_WORDS, gap: int = GAP, covered: float = COVERED):
        self.min_words, self.gap, self.covered = min_words, gap, covered
        self.vocab: dict[bytes, int] = {}
        ids = lambda text: [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
        self.templates = [(label, ids(t)) for label, texts in templates.items() for t in texts]
        self.names, self.proper = self._names(templates)
        self.phrases = [(label, ids(p)) for p, label in phrases.items()]
        self.least = min([min_words, *(len(p) for _, p in self.phrases)])
        self.auto = Automaton([t for _, t in self.templates + self.phrases])
        for k, (_, seq) in enumerate(self.phrases):
            self.auto.mark(seq, k)

    def _names(self, templates: dict[str, list[str]]) -> tuple[list[frozenset[int] | None], list[frozenset[int]]]:
        """For each template the places of the words that tell it from other labels' (None for
        long ones), and which of them are a licence's name."""
        texts = [t for own in templates.values() for t in own]
        labels: dict[int, set[str]] = {}
        for label, seq in self.templates:
            for w in seq:
                labels.setdefault(w, set()).add(label)
        names, proper = [], []
        for text, (_, seq) in zip(texts, self.templates):
            telling = [i for i, w in enumerate(seq) if len(labels[w]) == 1]
            # As _WORD parts them, with capitals left.
            raw = text.encode("utf-8", "surrogatepass").translate(_WORD_AS_IS).split()
            capital = [i for i in telling if i and raw[i][:1].isupper()]
            names.append(frozenset(capital or telling) if len(seq) < SHORT else None)
            proper.append(frozenset(capital if len(seq) < SHORT else ()))
        return names, proper

    def _told(self, t: int, chain: list[tuple[int, int, int]]) -> bool:
        """Whether a chain (first match first) has what tells a short template from others."""
        names, size = self.names[t], len(self.templates[t][1])
        if names is None:
            return True
        covered = {q for _, p, n in chain for q in range(p, p + n)}
        if names:
            return names <= covered
        return len(covered) == size == chain[-1][0] + chain[-1][2] - chain[0][0]

    def scan(self, words: list[bytes]) -> dict:
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))
        known = ids > 0
        # Only runs of two known words and more can hold a match or a phrase, but for phrases (or matches) of one word.
        pair = np.flatnonzero(known[:-1] & known[1:] if self.least > 1 else known)
        base: list[tuple[int, int]] = []
        found: dict[int, list[tuple[int, int, int]]] = {}
        if len(pair):
            cuts = np.flatnonzero(np.diff(pair) > 1)
            for a, b in zip(pair[np.r_[0, cuts + 1]].tolist(), pair[np.r_[cuts, len(pair) - 1]].tolist()):
                self._run(ids[a:b + (2 if self.least > 1 else 1)].tolist(), a, base, found)
        spans = [s for t, matches in found.items() for s in self._chain(t, matches)]
        return {"base": base, "spans": sorted(spans)}

    def _run(self, ids: list[int], at: int, base: list, found: dict) -> None:
        """Phrase places (start, phrase) and right-maximal matches of a run of known words."""
        auto, state, n = self.auto, 0, 0
        for i, c in enumerate(ids):
            before = (state, n)
            state, n = auto.step(state, n, c)
            if n <= before[1]:
                self._match(*before, at + i, found)
            for size, k in auto.phrases[state]:
                if size <= n:
                    base.append((at + i + 1 - size, k))
        self._match(state, n, at + len(ids), found)

    def _match(self, state: int, n: int, end: int, found: dict) -> None:
        if n >= min(2, self.min_words):
            for t, e in self.auto.ends[state]:
                # A pair of words counts where it begins with a licence's name ("new BSD License").
                if t < len(self.templates) and (n >= self.min_words or e - n in self.proper[t]):
                    found.setdefault(t, []).append((end - n, e - n, n))

    def _chain(self, t: int, matches: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str, float]]:
        """Covered spans (start, end, label, share of the template) of one template.

        A match follows another if it starts behind its end in both, or runs over
        it by less than its own length, with at most ``gap`` words between in the
        text; the chain with most template words wins. A match looks back over the
        reach of one template only, so long texts cost in proportion.
        """
        label, seq = self.templates[t]
        reach = 2 * len(seq) + self.gap
        matches.sort()
        best, back = [], []
        for j, (d, p, n) in enumerate(matches):
            top, frm = n, -1
            for i in range(j - 1, -1, -1):
                d0, p0, n0 = matches[i]
                if d - d0 > reach:
                    break
                over = max(0, d0 + n0 - d, p0 + n0 - p)
                if p > p0 and d > d0 and over < n and d - (d0 + n0) <= self.gap and best[i] + n - over > top:
                    top, frm = best[i] + n - over, i
            best.append(top)
            back.append(frm)
        free = len(matches)
        used = [False] * free
        for j in sorted(range(len(matches)), key=lambda k: -best[k]):
            if best[j] < self.covered * len(seq):
                break
            chain, i = [], j
            while i >= 0 and not used[i]:
                chain.append(i)
                i = back[i]
            if i < 0 and self._told(t, [matches[k] for k in reversed(chain)]):
                for k in chain:
                    used[k] = True
                yield matches[chain[-1]][0], matches[j][0] + matches[j][2], label, min(1.0, best[j] / len(seq))


def _digest(scanner: Scanner, text: str | None) -> tuple:
    words = words_of(text)
    got = scanner.scan(words)
    base = {scanner.phrases[k][0] for _, k in got["base"]}
    labels = base | {s[2] for s in got["spans"]}
    starts = [s for s, _ in got["base"]]
    score = 1.0 if base else max((s[3] for s in got["spans"]), default=0.0)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score, [{"start": a, "end": b, "label": c, "covered": d} for a, b, c, d in got["spans"]])


def scan_licenses(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """One row per row of ``docs``: n_words, the base phrases' places (n_base,
    first_word, last_word, base_labels), all labels, the score (1 with a base
    phrase, else the largest covered share of a template) and the spans."""
    scanner = scanner or Scanner()
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("covered", pa.float64())]))]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_digest(scanner, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
                                             if rows else [batch.column("doc_id")] + [pa.array([], k) for k in kinds], ["doc_id", *names])

    return pick(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
             " spans array<struct<start:long,end:long,label:string,covered:double>>")
