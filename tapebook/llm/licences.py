"""Licence notices in texts: a suffix automaton of template words, chained into covered spans.

All templates and phrases make one automaton. Texts stream through it, word by word; the state after
a word gives the longest stretch that ends there and is part of some template. From it follow the longest such
stretch of each template, and the phrases that end there. Long stretches of one template that follow
each other in the text and in the template, with few words between them, are chained; a chain covers a
span of the text and some of the template's words. A span that covers enough of them gives the label,
unless most of it lies in spans of other labels that cover more of theirs (notices resemble each other).

Only words next to each other in some template (or phrase) can be part of a stretch of two; others are
left out before the automaton runs, many texts at a time, which changes no result. Nothing is shuffled.
Words are compared by 64-bit hashes of their bytes.

Null and empty texts have no words, no places and no spans; every row is answered by itself, so repeated
rows and ids don't matter; an empty table gives no rows. New columns take free names, so columns of
clashing names stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .automaton import SuffixAutomaton
from .shared import free_name, small_batches
from .words import ALNUM, Block, HashSet, mix, word_blocks

#: Stretches of at least so many words are chained, over at most so many other words of the text.
SEED, GAP = 3, 12
#: A label needs this share of a template's words.
SHARE = 0.8
#: Different stretches whose matches a task remembers.
REMEMBERED = 20_000

# Phrases that always give their label.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

# Notices as their licences word them.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "Released under the MIT License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("epl", "made available under the terms of the Eclipse Public License 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work"),
)

PLACES = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))
SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("template", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("covered", T.LongType()),
            T.StructField("share", T.DoubleType()),
        ]
    )
)
_PLACES_ARROW = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))
_SPANS_ARROW = pa.list_(
    pa.struct(
        [("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]
    )
)
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(text: str) -> np.ndarray:
    """Hashes of a text's words."""
    return np.concatenate([np.zeros(0, np.uint64), *[b.hashes() for b in word_blocks(pa.array([text]), ALNUM)]])


@dataclass(frozen=True)
class Anchor:
    """A longest stretch of a template: words of the text from ``start`` to ``end`` (behind the last), the template's up to ``there``."""

    template: int
    start: int
    end: int
    there: int


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]], seed: int, gap: int, share: float):
        self.templates, self.phrases, self.seed, self.gap, self.share = templates, phrases, max(seed, 1), gap, share
        self.words = [word_hashes(t) for _, t in (*templates, *phrases)]
        sequences = [w.tolist() for w in self.words]
        self.automaton = SuffixAutomaton(sequences)
        self.singles = HashSet(np.concatenate([np.zeros(0, np.uint64), *self.words]))
        self.pairs = HashSet(np.concatenate([np.zeros(0, np.uint64), *[_pairs(w) for w in self.words]]))
        # the phrases that end at each state: those whose own state it is, or leads to by links
        own: dict[int, list[int]] = {}
        for k, s in enumerate(sequences[len(templates) :]):
            if s:
                own.setdefault(self.automaton.statistics(s)[-1][0], []).append(k)
        self.ending = [[] for _ in self.automaton.next]
        for state in range(1, len(self.ending)):
            up = state
            while up > 0:
                self.ending[state] += own.get(up, [])
                up = self.automaton.link[up]
        # stretches too short to be chained matter only if they hold a whole phrase
        self.least = min([self.seed, *[len(s) for s in sequences[len(templates) :] if s]])
        self.begins = np.array([s[0] for s in sequences[len(templates) :] if s], np.uint64)
        self.seen: dict[bytes, tuple[list[tuple[int, int]], list[Anchor]]] = {}

    def stretches(self, block: Block) -> Iterator[tuple[int, int, np.ndarray]]:
        """Row, first word (in the row) and words of each stretch of template words that can hold a match."""
        words = block.hashes()
        if not words.size or not self.singles.values.size:
            return
        row = block.row_of_word()
        known = np.zeros(len(words), bool)
        known[self.singles.find(words)[0]] = True
        joined = np.zeros(len(words), bool)  # with the word before
        if len(words) > 1:
            joined[self.pairs.find(_pairs(words))[0] + 1] = True
            joined[1:] &= row[1:] == row[:-1]
        head = np.flatnonzero(known & ~joined)
        if not head.size:
            return
        inside = known & joined
        stop = np.flatnonzero(known & ~np.append(inside[1:], False)) + 1
        long = (stop - head >= self.seed) | ((stop - head >= self.least) & (np.add.reduceat(np.isin(words, self.begins), head) > 0))
        for s, e in zip(head[long].tolist(), stop[long].tolist()):
            yield int(row[s]), int(s - block.bounds[row[s]]), words[s:e]

    def matches(self, words: np.ndarray) -> tuple[list[tuple[int, int]], list[Anchor]]:
        """Phrases (number, start) and longest stretches of templates in some words, by their ends."""
        key = words.tobytes()
        if key in self.seen:
            return self.seen[key]
        places, anchors = [], []
        before: dict[int, tuple[int, list[int]]] = {}
        statistics = self.automaton.statistics(words.tolist())
        for end, (state, length) in enumerate(statistics, 1):
            for k in self.ending[state]:
                size = len(self.words[len(self.templates) + k])
                if size <= length:
                    places.append((k, end - size))
            now = self.automaton.longest_by_sequence(state, length, self.seed)
            anchors += self._ended(before, now, end - 1)
            before = now
        anchors += self._ended(before, {}, len(statistics))
        if len(self.seen) < REMEMBERED and len(words) < 1024:
            self.seen[key] = (places, anchors)
        return places, anchors

    def _ended(self, before: dict, now: dict, end: int) -> list[Anchor]:
        """Stretches up to ``end`` that the next word doesn't make longer."""
        out = []
        for which, (length, ends) in before.items():
            if which < len(self.templates) and not (which in now and now[which][0] == length + 1):
                out += [Anchor(which, end - length, end, there) for there in ends]
        return out

    def spans(self, anchors: list[Anchor]) -> tuple[list[dict], float]:
        """The chains of one text that cover enough of their template, and the best share of all."""
        by_template: dict[int, list[Anchor]] = {}
        for a in anchors:
            by_template.setdefault(a.template, []).append(a)
        out, best = [], 0.0
        for which, found in sorted(by_template.items()):
            total = len(self.words[which])
            for start, (covered, end) in sorted(chains(found, self.gap).items()):
                share = covered / total
                best = max(best, share)
                if share >= self.share:
                    label = self.templates[which][0]
                    out.append({"label": label, "template": which, "start": start, "end": end, "covered": covered, "share": share})
        return settle(out), best

    def scan(self, column: pa.Array) -> tuple[list[int], list[list[dict]], list[list[dict]], list[float]]:
        """Words, places of phrases, spans and the best share of each text."""
        counts: list[int] = []
        places: list[list[dict]] = []
        spans: list[list[dict]] = []
        shares: list[float] = []
        for block in word_blocks(column, ALNUM):
            anchors: dict[int, list[Anchor]] = {}
            here: list[list[dict]] = [[] for _ in range(block.rows)]
            for row, first, words in self.stretches(block):
                phrases, stretches = self.matches(words)
                for k, start in phrases:
                    label, size = self.phrases[k][0], len(self.words[len(self.templates) + k])
                    here[row].append({"label": label, "start": first + start, "length": size})
                if stretches:
                    moved = [Anchor(a.template, first + a.start, first + a.end, a.there) for a in stretches]
                    anchors.setdefault(row, []).extend(moved)
            for row in range(block.rows):
                covered, share = self.spans(anchors[row]) if row in anchors else ([], 0.0)
                spans.append(covered)
                shares.append(1.0 if here[row] else share)
            counts += block.counts.tolist()
            places += here
        return counts, places, spans, shares


def _pairs(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * _PAIR + words[1:])


def settle(spans: list[dict]) -> list[dict]:
    """The spans, best shares first, without those of which over half lies in better ones of other labels."""
    kept: list[dict] = []
    for s in sorted(spans, key=lambda s: (-s["share"], -s["covered"], s["start"], s["template"])):
        near = [(max(k["start"], s["start"]), min(k["end"], s["end"])) for k in kept if k["label"] != s["label"]]
        inside = reached = 0
        for start, end in sorted(near):
            inside += max(0, end - max(start, reached))
            reached = max(reached, end)
        if 2 * inside <= s["end"] - s["start"]:
            kept.append(s)
    return kept


def chains(anchors: list[Anchor], gap: int) -> dict[int, tuple[int, int]]:
    """First word -> (template words covered, end) of the best chain that begins there.

    Anchors of one template; of two that follow each other, both ends grow, and at most ``gap`` words of the
    text lie between. Words that overlap count once.
    """
    anchors = sorted(anchors, key=lambda a: (a.end, a.there, a.start))
    gained, root = [], []
    begin = 0
    best: dict[int, tuple[int, int]] = {}
    longest = max(a.end - a.start for a in anchors)
    for j, a in enumerate(anchors):
        size = a.end - a.start
        value, source = size, a.start
        while anchors[begin].end < a.end - longest - gap:
            begin += 1
        for i in range(begin, j):
            b = anchors[i]
            if b.end < a.end and b.there < a.there and a.start - b.end <= gap:
                total = gained[i] + min(size, a.end - b.end, a.there - b.there)
                if total > value or (total == value and root[i] < source):
                    value, source = total, root[i]
        gained.append(value)
        root.append(source)
        if value > best.get(source, (0, 0))[0]:
            best[source] = (value, a.end)
    return best


def scan(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None,
    templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
    seed: int = SEED, gap: int = GAP, share: float = SHARE,
) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, by default all) with ``n_words``, ``places`` (label, start
    and length in words of every phrase), ``spans`` (template stretches that cover ``share`` of it or
    more) and ``cover`` (the best share of any template; 1 with a phrase)."""
    spark = small_batches(docs.sparkSession)
    keep = tuple(docs.columns) if keep is None else keep
    names = [free_name(docs, n) for n in ("n_words", "places", "spans", "cover")]
    body = free_name(docs, "_body")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias(body))
    types = (T.LongType(), PLACES, SPANS, T.DoubleType())
    schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(n, t) for n, t in zip(names, types)]])
    arguments = spark.sparkContext.broadcast((tuple(templates), tuple(phrases), seed, gap, share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*arguments.value)
        for batch in batches:
            counts, places, spans, shares = scanner.scan(batch.column(batch.num_columns - 1))
            found = [pa.array(counts, pa.int64()), pa.array(places, _PLACES_ARROW), pa.array(spans, _SPANS_ARROW), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], schema.names)

    return rows.mapInArrow(run, schema)


def label_text(*found: Column) -> Column:
    """Distinct labels of arrays of places or spans, sorted and comma-joined."""
    return F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(*[F.transform(a, lambda x: x["label"]) for a in found]))))
