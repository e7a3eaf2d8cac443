"""License scan: an exact set-similarity join of text blocks with license templates.

A block is any run of as many consecutive words of a text as a template has (A-Z
lower-cased, split at all ASCII that is no letter or digit), so a notice is found
whatever lines it is wrapped over.  A block belongs to a template if it holds at least
``CONTAINMENT`` of the template's distinct words.

* Template words are put in order of their frequency in the whole corpus (a first
  pass; one number per template word comes back), rarest first.
* Prefix filter: with ``need`` words to share, a block must hold one of the first
  ``size - need + 1`` words of the template in that order.  An inverted index of these
  words gives the templates that stand to reason at each place of a text.
* Length filter: a stretch of a text with fewer than ``need`` words of the template in
  reach of such a place is out.
* Positional filter: if the first word shared stands at place i of the template's order,
  at most ``size - i`` words can be shared; so each place looks only at the template's
  words that follow its own in that order, and rarer ones are left to their own places.
* Survivors are counted in full: a word counts for the blocks that begin after its
  last occurrence before, so each block counts it once.

Templates are a fixed list, so what is broadcast does not grow with the data, and
the join needs no shuffle.  Besides, the words of the base phrases standing in a
row give the base labels.

Defined cases: a null text counts as empty (no words, no labels, score 0); an empty
table gives an empty result; a text shorter than a template is one block; a null doc_id
passes through; rows are judged one by one, so repeated rows give equal results; texts
of any length are read whole, in arrays of 16 bytes a word; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordbytes as wb

CONTAINMENT = 0.8
#: Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices of public licenses and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved"),
]


def _words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    starts, ends, _ = wb.spans(data, np.array([0, len(data)]), wb.ALNUM)
    return wb.hashes(data, starts, ends, fold=True)


def _vocabulary(templates) -> np.ndarray:
    return np.unique(np.concatenate([_words(t) for _, t in templates]))


def _texts(batches) -> Iterator[tuple]:
    """(batch, lo, hi, word hashes, first word of each text)."""
    for batch in batches:
        data, offsets = wb.utf8(batch.column(1))
        for lo, hi in wb.groups(offsets):
            a, b = offsets[lo], offsets[hi]
            part, at = data[a:b], offsets[lo : hi + 1] - a
            starts, ends, first = wb.spans(part, at, wb.ALNUM)
            yield batch, lo, hi, wb.hashes(part, starts, ends, fold=True), first


def _members(vocabulary: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of vocabulary words, and their index in it."""
    seen = np.zeros(1 << 16, dtype=bool)
    seen[(vocabulary >> np.uint64(48)).astype(np.int64)] = True
    at = np.flatnonzero(seen[(hashes >> np.uint64(48)).astype(np.int64)])
    index = np.minimum(np.searchsorted(vocabulary, hashes[at]), len(vocabulary) - 1)
    ok = vocabulary[index] == hashes[at]
    return at[ok], index[ok]


def word_frequencies(docs: DataFrame, templates=TEMPLATES) -> np.ndarray:
    """Occurrences in all of ``docs`` of each template word, in the vocabulary's order."""
    vocabulary = _vocabulary(templates)

    def count(batches):
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for _, _, _, hashes, _ in _texts(batches):
            total += np.bincount(_members(vocabulary, hashes)[1], minlength=len(vocabulary))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["word", "n"])

    rows = docs.select("doc_id", "text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(vocabulary), dtype=np.int64)
    for r in rows:
        out[r["word"]] = r["n"]
    return out


class Index:
    """Templates with their words in order of frequency, and an inverted index of their prefixes."""

    def __init__(self, templates, frequencies: np.ndarray, containment: float):
        self.vocabulary = _vocabulary(templates)
        self.labels = [label for label, _ in templates]
        #: Words of each template with repeats (the length of a block), different words, words to share.
        self.length, self.size, self.need = [], [], []
        #: Place of each vocabulary word in a template's order, -1 if it is not there.
        self.place = np.full((len(templates), len(self.vocabulary)), -1, dtype=np.int64)
        self.prefix = np.zeros((len(templates), len(self.vocabulary)), dtype=bool)
        for t, (_, text) in enumerate(templates):
            words = _words(text)
            index = np.searchsorted(self.vocabulary, np.unique(words))
            index = index[np.lexsort((self.vocabulary[index], frequencies[index]))]
            need = max(1, int(np.ceil(containment * len(index) - 1e-9)))
            self.length.append(len(words))
            self.size.append(len(index))
            self.need.append(need)
            self.place[t, index] = np.arange(len(index))
            self.prefix[t, index[: len(index) - need + 1]] = True
        self.any_prefix = self.prefix.any(axis=0)

    def join(self, at: np.ndarray, word: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(template, texts with a block that meets the threshold, most words shared), from the places of
        vocabulary words in order, and the text of each."""
        if not self.any_prefix[word].any():
            return
        # Texts far apart, so that no block reaches into the next.
        at = at + owner * max(self.length)
        for t in np.flatnonzero(self.prefix[:, np.unique(word)].any(axis=1)).tolist():
            length, size, need = self.length[t], self.size[t], self.need[t]
            mine = np.flatnonzero(self.place[t, word] >= 0)
            where, order = at[mine], self.place[t, word[mine]]
            seeds = np.flatnonzero(order <= size - need)
            lo, hi = np.searchsorted(where, where[seeds] - length + 1), np.searchsorted(where, where[seeds] + length - 1, "right")
            seeds, lo, hi = (x[hi - lo >= need] for x in (seeds, lo, hi))
            if not len(seeds):
                continue
            # Words in reach of a seed that follow it in the template's order, and the seed.
            n = hi - lo
            near = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)
            seed = np.repeat(np.arange(len(seeds)), n)
            later = order[near] >= np.repeat(order[seeds], n)
            near, seed = near[later], seed[later]
            held = np.bincount(seed, minlength=len(seeds))
            enough = (held >= need)[seed]
            near, seed = near[enough], seed[enough]
            if not len(near):
                continue
            best = self._most(where, order, near, seed, where[seeds], length)
            ok = best >= need
            text = owner[mine][seeds[ok]]
            texts, which = np.unique(text, return_inverse=True)
            most = np.zeros(len(texts), dtype=np.int64)
            np.maximum.at(most, which, best[ok])
            if len(texts):
                yield t, texts, most

    @staticmethod
    def _most(where, order, near, seed, middle, length) -> np.ndarray:
        """For each seed, the most different words of any block that holds it."""
        # The last place before of the same word for the same seed.
        by_word = np.lexsort((near, order[near], seed))
        same = np.zeros(len(near), dtype=bool)
        same[1:] = (seed[by_word][1:] == seed[by_word][:-1]) & (order[near[by_word]][1:] == order[near[by_word]][:-1])
        before = np.full(len(near), -(1 << 62), dtype=np.int64)
        previous = where[near[by_word]]
        before[by_word[1:]] = np.where(same[1:], previous[:-1], before[by_word[1:]])
        # Blocks that count this word begin in from..to, and hold the seed.
        begin = np.maximum(np.maximum(before + 1, where[near] - length + 1), middle[seed] - length + 1)
        end = np.minimum(where[near], middle[seed])
        ok = begin <= end
        begin, end, seed = begin[ok], end[ok], seed[ok]
        place = np.concatenate([begin, end + 1])
        step = np.repeat(np.array([1, -1]), len(begin))
        both = np.concatenate([seed, seed])
        run = np.lexsort((step, place, both))  # what ends at a place goes before what begins there
        level = np.cumsum(step[run])
        out = np.zeros(len(middle), dtype=np.int64)
        np.maximum.at(out, both[run], level)
        return out


def scan(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    ``score`` is the greatest share of a template found in one block, 1 where a base
    phrase stands, 0 where nothing does.
    """
    index = Index(templates, word_frequencies(docs, templates), containment)
    phrases = [(_words(p), label) for p, label in PHRASES.items()]

    def run(batches):
        for batch, lo, hi, hashes, first in _texts(batches):
            n = hi - lo
            owner = np.repeat(np.arange(n), np.diff(first))
            base_n = np.zeros(n, dtype=np.int64)
            least = np.full(n, np.iinfo(np.int64).max)
            most = np.full(n, -1)
            base: list[set] = [set() for _ in range(n)]
            for words, label in phrases:
                m = len(hashes) - len(words) + 1
                if m <= 0:
                    continue
                here = hashes[:m] == words[0]
                for j in range(1, len(words)):
                    here &= hashes[j : j + m] == words[j]
                at = np.flatnonzero(here)
                at = at[owner[at] == owner[at + len(words) - 1]]
                place = at - first[owner[at]]
                np.add.at(base_n, owner[at], 1)
                np.minimum.at(least, owner[at], place)
                np.maximum.at(most, owner[at], place)
                for i in np.unique(owner[at]).tolist():
                    base[i].add(label)
            labels = [set(s) for s in base]
            score = np.array([1.0 if s else 0.0 for s in base])
            at, word = _members(index.vocabulary, hashes)
            for t, texts, shared in index.join(at, word, owner[at]):
                for i, s in zip(texts.tolist(), (shared / index.size[t]).tolist(), strict=True):
                    labels[i].add(index.labels[t])
                    score[i] = max(score[i], s)
            none = base_n == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, n),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(base_n),
                    pa.array(least.astype(np.int64), mask=none),
                    pa.array(most.astype(np.int64), mask=none),
                    pa.array([",".join(sorted(s)) for s in base], pa.string()),
                    pa.array([",".join(sorted(s)) for s in labels], pa.string()),
                    pa.array(score),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
