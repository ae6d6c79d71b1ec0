"""License scans as an exact set-similarity join.

Text blocks are joined with the word sets of license templates: a block matches a
template when it holds at least the template's share of its distinct words (`thresholds` by label, else
`threshold`) and all of its naming words (`naming` by label): a notice of a few words must be held whole, and
a text that differs from another license's in one name needs that name.
Blocks are lines (long lines as overlapping runs of words) and, for text wrapped
over lines and templates of any length, windows of the whole document: for a
template of n words, 2 n words from every n-th word on, so any n words in a row
lie in a window.  The join is exact:

* words are ordered by their frequency in the whole corpus, rarest first (counted
  by a Spark job; only template words matter, so what is collected is bounded by
  the templates);
* prefix filter: a matching block holds one of the template's first
  |T| - ceil(t |T|) + 1 words, which an inverted index answers;
* length filter: it holds ceil(t |T|) template words at all;
* positional filter: what follows the shared word on either side must suffice;
* survivors are counted exactly.

The templates are a parameter (their size is the caller's) and go to the tasks
with the function; documents are scanned in one map, without a shuffle.  Phrases
that name a license outright are reported beside the join's matches.

Defined cases: a null text is empty (no words, no match); repeated rows are
scanned each; a null id stays null; templates without words never match; of
templates with equal word sets each matches; an empty table gives an empty
result; other columns of the input are ignored.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ALNUM_LOWER, id_text

#: Phrases that name a license.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Fixed values: (label, text) of notices and of passages of well-known public licenses.
TEMPLATES = (
    ("mit-notice", "Released under the MIT License."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files, to deal in the Software without restriction"),
    ("apache-2.0-text", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "General Public License as published by the Free Software Foundation"),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met"),
    ("mpl-2.0-text", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
THRESHOLD = 0.8
#: Templates with a share of their own: notices, of which every word counts.
THRESHOLDS = {"mit-notice": 1.0, "apache-2.0-notice": 1.0, "gpl-3.0-notice": 1.0, "cc-by-nc-4.0-notice": 1.0, "cc-by-4.0-notice": 1.0}
#: Words without which a text is another license's.
NAMING = {"mpl-2.0-text": ("mozilla",), "gpl-text": ("gnu", "general", "public")}
BLOCK_WORDS, BLOCK_STEP = 128, 64


def line_words(raw: bytes) -> list[list[bytes]]:
    return [line.split() for line in raw.translate(ALNUM_LOWER_LINES).split(b"\n")]


#: As ALNUM_LOWER, but line ends stay.
ALNUM_LOWER_LINES = bytes(0x0A if c == 0x0A else ALNUM_LOWER[c] for c in range(256))


def blocks(lines: list[list[bytes]]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first word in the document, words) of every block."""
    at = 0
    for words in lines:
        if len(words) <= BLOCK_WORDS:
            if words:
                yield at, words
        else:
            for i in range(0, len(words) - BLOCK_WORDS + BLOCK_STEP, BLOCK_STEP):
                yield at + i, words[i:i + BLOCK_WORDS]
        at += len(words)


class TemplateIndex:
    """Inverted index over the prefixes of frequency-ordered template word sets."""

    def __init__(self, templates: Sequence[tuple[str, str]], threshold: float, frequency: dict[bytes, int],
                 thresholds: Mapping[str, float] = THRESHOLDS, naming: Mapping[str, Sequence[str]] = NAMING):
        self.labels = [label for label, _ in templates]
        sets = [set(text.encode().translate(ALNUM_LOWER).split()) for _, text in templates]
        words = sorted(set().union(*sets), key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(words)}
        self.steps = [len(text.encode().translate(ALNUM_LOWER).split()) for _, text in templates]
        self.sets = [frozenset(self.rank[w] for w in s) for s in sets]
        self.needed = [max(1, math.ceil(thresholds.get(label, threshold) * len(s) - 1e-9)) for label, s in zip(self.labels, self.sets)]
        self.named = [frozenset(self.rank.get(w.encode(), -1) for w in naming.get(label, ())) for label in self.labels]
        self.index: dict[int, list[tuple[int, int]]] = {}
        for t, s in enumerate(self.sets):
            for i, r in enumerate(sorted(s)[:max(0, len(s) - self.needed[t] + 1)]):
                self.index.setdefault(r, []).append((t, i))
        self.prefix_words = frozenset(words[r] for r in self.index)

    def match(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of every template that the block holds."""
        ranks = sorted({self.rank[w] for w in words if w in self.rank})
        tried: set[int] = set()
        out = []
        for j, r in enumerate(ranks):
            for t, i in self.index.get(r, ()):
                need = self.needed[t]
                if t in tried or len(ranks) < need:
                    continue
                # nothing before position i of the template was shared, or it would have been tried
                if 1 + min(len(self.sets[t]) - i - 1, len(ranks) - j - 1) < need:
                    continue
                tried.add(t)
                shared = len(self.sets[t].intersection(ranks))
                if shared >= need and self.named[t].issubset(ranks):
                    out.append((t, shared / len(self.sets[t])))
        return sorted(out)


    def windows(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(first word, number of words, template, containment) of every window of the document that holds the template."""
        placed = [(i, self.rank[w]) for i, w in enumerate(words) if w in self.rank]
        present = {r for _, r in placed}
        out = []
        for t, (wanted, need, step) in enumerate(zip(self.sets, self.needed, self.steps)):
            if len(wanted & present) < need or not self.named[t] <= present:
                continue
            parts: dict[int, set[int]] = {}  # the template's words in each run of `step` words
            for i, r in placed:
                if r in wanted:
                    parts.setdefault(i // step, set()).add(r)
            for k in sorted({k for part in parts for k in (part - 1, part) if k == 0 or k > 0 and (k + 1) * step < len(words)}):
                held = parts.get(k, set()) | parts.get(k + 1, set())
                shared = len(held)
                if shared >= need and self.named[t] <= held:
                    out.append((k * step, min(2 * step, len(words) - k * step), t, shared / len(wanted)))
        return out


def word_frequencies(docs: DataFrame, words: frozenset[bytes], text_col: str = "text") -> dict[bytes, int]:
    """Occurrences of the given words in the corpus (one count a word comes back)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                seen.update(filter(words.__contains__, (raw or b"").translate(ALNUM_LOWER).split()))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

    found = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(count, "word binary, n long")
    return {bytes(r.word): r.n for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _phrase_places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[dict]:
    """Places of the phrases; one walk over the words, however often a phrase's last word stands there."""
    last_words: dict[bytes, list[tuple[list[bytes], str]]] = {}
    for phrase, label in phrases:
        last_words.setdefault(phrase[-1], []).append((phrase, label))
    out = []
    for at, word in enumerate(words):
        if word in last_words:
            for phrase, label in last_words[word]:
                first = at - len(phrase) + 1
                if first >= 0 and words[first:at + 1] == phrase:
                    out.append({"first_word": first, "label": label})
    return sorted(out, key=lambda p: (p["first_word"], p["label"]))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
         phrases: Sequence[tuple[str, str]] = PHRASES, id_col: str = "doc_id", text_col: str = "text",
         thresholds: Mapping[str, float] = THRESHOLDS, naming: Mapping[str, Sequence[str]] = NAMING) -> DataFrame:
    """One row for each document: doc_id, n_words, base (places of the phrases:
    first_word, label), blocks and windows (matches of the join with lines and with
    windows of the document: first_word, n_words, label, containment)."""
    vocabulary = frozenset(w for _, text in templates for w in text.encode().translate(ALNUM_LOWER).split())
    index = TemplateIndex(templates, threshold, word_frequencies(docs, vocabulary, text_col), thresholds, naming)
    spoken = [(p.encode().translate(ALNUM_LOWER).split(), label) for p, label in phrases]
    place = pa.list_(pa.struct([("first_word", pa.int64()), ("label", pa.string())]))
    block = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", place), ("blocks", block), ("windows", block)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_words = {p[-1] for p, _ in spoken}
        for batch in batches:
            n_words, base, found, wide = [], [], [], []
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                words = (raw or b"").translate(ALNUM_LOWER).split()
                n_words.append(len(words))
                base.append([] if last_words.isdisjoint(words) else _phrase_places(words, spoken))
                found.append([])
                wide.append([])
                if index.prefix_words.isdisjoint(words):
                    continue  # the prefix filter, for all blocks at once
                for at, part in blocks(line_words(raw)):
                    found[-1] += [{"first_word": at, "n_words": len(part), "label": index.labels[t], "containment": c} for t, c in index.match(part)]
                wide[-1] += [{"first_word": at, "n_words": n, "label": index.labels[t], "containment": c} for at, n, t, c in index.windows(words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip((n_words, base, found, wide), list(schema)[1:]))], schema=schema)

    matches = "array<struct<first_word: long, n_words: long, label: string, containment: double>>"
    ddl = f"doc_id long, n_words long, base array<struct<first_word: long, label: string>>, blocks {matches}, windows {matches}"
    return id_text(docs, id_col, text_col).mapInArrow(run, ddl)
