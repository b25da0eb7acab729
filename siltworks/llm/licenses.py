"""License texts in documents: phrases, and templates by an exact set-similarity join of text blocks.

Method. A block is a line of a document, a template the text of a common notice; both are sets of
words. A block holds a template if it has at least ``percent`` % of the template's words. To find
all such pairs, words are ordered by how many blocks of the whole corpus hold them, rarest first.
A template of ``m`` words needs ``a`` of them, so a block that holds it has one of the template's
first ``m - a + 1`` words. For blocks with such a word, the length filter asks for ``a`` words at
all and the positional filter for enough words after the first shared one in both orders; what
passes is verified by counting the shared words. Templates are a bounded list that tasks hold.

Notices may be wrapped. The paragraphs of a document, which lines without words part, are put through
the same filters. A paragraph holds a wrapped template if it has the same share of the template's words
(each counted where it first stands) in the template's order, over at least two lines, and with so few
other words between that they are within ``100 / percent`` times the template's length. A paragraph's
words alone don't count: long ones hold those of short templates anywhere.

Phrases are words that stand consecutively, and are counted wherever they stand.

Defined cases: null text counts as empty and has no words, places or labels; repeated rows each
give a row; an empty table gives an empty table; further columns are ignored; whole texts are read,
a text at a time, and neither lines nor texts have a bound. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Sink, rows_of, whole_text
from .wordhash import WordHasher, classes_of

PERCENT = 80

# Phrases with their labels, and notices with theirs.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def _word_table() -> np.ndarray:
    """Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` in lower case: A-Z are told apart from a-z only there."""
    return classes_of(word=bytes(b for b in range(256) if b >= 128 or chr(b).isalnum()))


class Blocks:
    """Words of texts and the lines they stand in."""

    def __init__(self):
        self.hasher = WordHasher(_word_table())

    def words(self, text: str) -> list[int]:
        return self.hasher.words(text.encode())[1].tolist()

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes and the number of each word's line."""
        raw = text.encode("utf-8", "surrogatepass")
        starts, hashes = self.hasher.words(raw)
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
        return hashes, np.searchsorted(ends, starts)


def word_frequencies(rows: DataFrame, words: list[int]) -> dict[int, int]:
    """How many blocks of the corpus hold each of the given words (a bounded list)."""
    schema = pa.schema([("word", pa.int64()), ("blocks", pa.int64())])
    known = np.array(sorted(words), np.uint64)

    def count(batches):
        blocks, sums = Blocks(), np.zeros(len(known), np.int64)
        for (text,) in rows_of(batches):
            hashes, lines = blocks.of(text)
            at = np.searchsorted(known, hashes)
            at[at == len(known)] = 0
            same = known[at] == hashes
            pairs = np.unique(lines[same] * len(known) + at[same])
            np.add.at(sums, pairs % len(known), 1)
        yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(sums)], schema=schema)

    counted = rows.mapInArrow(count, "word bigint, blocks bigint").groupBy("word").agg(F.sum("blocks").alias("blocks"))
    return {word & (1 << 64) - 1: blocks for word, blocks in counted.collect()}  # one row for each word of the templates


class Templates:
    """An index of templates by the words of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], frequencies: dict[int, int], percent: int = PERCENT):
        blocks = Blocks()
        self.rank = {w: k for k, w in enumerate(sorted(frequencies, key=lambda w: (frequencies[w], w)))}
        self.sets, self.labels, self.least = [], [], []
        self.orders, self.rooms = [], []
        self.index: dict[int, list[tuple[int, int]]] = {}
        for number, (label, text) in enumerate(templates):
            ordered = sorted(set(blocks.words(text)), key=self.rank.__getitem__)
            least = -(-percent * len(ordered) // 100)
            self.sets.append(ordered)
            self.labels.append(label)
            self.least.append(least)
            spoken = blocks.words(text)
            self.orders.append({word: place for place, word in enumerate(dict.fromkeys(spoken))})
            self.rooms.append(len(spoken) * 100 // percent)
            for place, word in enumerate(ordered[:len(ordered) - least + 1]):
                self.index.setdefault(word, []).append((number, place))
        self.first = np.array(sorted(self.index), np.uint64)
        self.known = np.array(sorted(self.rank), np.uint64)

    def matches(self, hashes: np.ndarray, lines: np.ndarray) -> list[tuple[int, int, float]]:
        """Line, template number and containment of every pair that reaches the threshold."""
        out = []
        for line in np.unique(lines[_among(hashes, self.first)]).tolist():
            first, last = np.searchsorted(lines, (line, line + 1))
            words = np.unique(hashes[first:last])
            ordered = sorted(words[_among(words, self.known)].tolist(), key=self.rank.__getitem__)
            held, seen = set(ordered), set()
            for place, word in enumerate(ordered):
                for number, at in self.index.get(word, ()):
                    if number in seen:
                        continue
                    seen.add(number)  # the first shared word of the template's prefix
                    template, least = self.sets[number], self.least[number]
                    if len(words) < least or min(len(ordered) - place, len(template) - at) < least:
                        continue
                    shared = len(held.intersection(template))
                    if shared >= least:
                        out.append((line, number, shared / len(template)))
        return out

    def wrapped(self, hashes: np.ndarray, lines: np.ndarray) -> list[tuple[int, int, float]]:
        """First line, template number and containment of notices that stand on several lines, once for each paragraph."""
        if not len(lines) or lines[0] == lines[-1]:
            return []
        paragraphs = np.concatenate(([0], np.cumsum(np.diff(lines) > 1)))
        out = []
        for paragraph, number, _ in self.matches(hashes, paragraphs):
            first, last = np.searchsorted(paragraphs, (paragraph, paragraph + 1))
            if lines[first] != lines[last - 1]:
                count, line = self._in_order(hashes[first:last], lines[first:last], number)
                if count >= self.least[number]:
                    out.append((line, number, count / len(self.sets[number])))
        return out

    def _in_order(self, words: np.ndarray, lines: np.ndarray, number: int) -> tuple[int, int]:
        """The most words of a template that stand in its order over several lines, and the line of the first."""
        order, least, room = self.orders[number], self.least[number], self.rooms[number]
        at = np.flatnonzero(_among(words, np.array(sorted(order), np.uint64)))
        turns = [order[word] for word in words[at].tolist()]
        ends = np.searchsorted(at, at + room)
        lines = lines[at]
        starts = np.flatnonzero((ends - np.arange(len(at)) >= least) & (lines != lines[ends - 1]) & (np.array(turns) <= len(order) - least))
        best, best_line = 0, -1
        for start in starts.tolist():
            if len(order) - turns[start] <= best:
                continue
            longest = {start: 1}  # chains from the start word, by their last word
            for k in range(start + 1, int(ends[start])):
                if turns[k] > turns[start]:
                    longest[k] = 1 + max(n for j, n in longest.items() if turns[j] < turns[k])
                    if longest[k] > best and lines[k] != lines[start]:
                        best, best_line = longest[k], int(lines[start])
        return best, best_line


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(known, hashes)
    at[at == len(known)] = 0
    return known[at] == hashes


def phrase_places(hashes: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Where the words of a phrase stand consecutively."""
    room = len(hashes) - len(phrase) + 1
    if room <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(hashes[:room] == np.uint64(phrase[0]))
    for k, word in enumerate(phrase[1:], 1):
        at = at[hashes[at + k] == np.uint64(word)]
    return at


_SCAN = pa.schema([("row_key", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                   ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                   ("blocks", pa.list_(pa.struct([("line", pa.int64()), ("template", pa.int64()), ("containment", pa.float64())])))])
_SCAN_SQL = ("row_key bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
             "labels string, score double, blocks array<struct<line bigint, template bigint, containment double>>")


def scan(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES,
         percent: int = PERCENT) -> DataFrame:
    """``<id>, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks`` of every row.

    ``blocks`` are the pairs of line (of wrapped notices, the first) and template with their containment, ``score`` is the highest
    containment, and 1 where a phrase stands.
    """
    rows = df.select(F.col(id_column).cast("bigint").alias("row_key"), whole_text(text_column).alias("body"))
    words = sorted({w for _, text in templates for w in Blocks().words(text)})
    frequencies = word_frequencies(rows.select("body"), words)
    frequencies = {w: frequencies.get(w, 0) for w in words}

    return _scan(rows, templates, phrases, percent, frequencies).withColumnRenamed("row_key", id_column)


def _scan(rows: DataFrame, templates, phrases, percent: int, frequencies: dict[int, int]) -> DataFrame:
    def run(batches):
        blocks, index, sink = Blocks(), Templates(templates, frequencies, percent), Sink(_SCAN)
        wanted = [(blocks.words(text), label) for text, label in phrases]
        for key, text in rows_of(batches):
            hashes, lines = blocks.of(text)
            found = [(phrase_places(hashes, phrase), label) for phrase, label in wanted]
            found = [(places, label) for places, label in found if len(places)]
            base = {label for _, label in found}
            first = min((int(p[0]) for p, _ in found), default=None)
            last = max((int(p[-1]) for p, _ in found), default=None)
            pairs = index.matches(hashes, lines) + index.wrapped(hashes, lines)
            labels = base | {index.labels[number] for _, number, _ in pairs}
            score = 1.0 if base else max((c for _, _, c in pairs), default=0.0)
            row = (key, len(hashes), sum(len(p) for p, _ in found), first, last, ",".join(sorted(base)), ",".join(sorted(labels)),
                   score, [{"line": a, "template": b, "containment": c} for a, b, c in pairs])
            if sink.add(row, 128 + 32 * len(pairs)):
                yield sink.flush()
        yield sink.flush()

    return rows.mapInArrow(run, _SCAN_SQL)
