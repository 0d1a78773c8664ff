"""License scan: an exact set-similarity join of text blocks with license templates.

Blocks are stretches of ``2 * L`` words that start every ``L`` words, ``L`` being the length
of the longest template, so any notice of up to ``L`` words lies whole in some block. A
block is a set of words; it holds a template if it has at least ``threshold`` of the
template's distinct words. Words are ordered by how many documents of the whole corpus
hold them, rarest first, counted by one job over all rows. A pair is looked at only if
the block has a word of the template's prefix (all but ``ceil(threshold * size) - 1`` of its
words, so one of them must occur), has words enough, and has words enough left behind
the first shared one; pairs that pass are counted exactly. ``license_matches`` returns every pair of block
and template at the threshold, ``license_scan`` counts them as ``n_matches``.

Labels want more than a match, as licenses share most of their words. A template of fewer than ``SHORT`` distinct words
must occur whole in the matching block, its words in order with at
most one other word between two of them: of so few words, those that tell it from another license are too small a part. Of longer ones, a
word that no template of another label holds must be in the block, if the template has such words.

The templates are a parameter of bounded size, held by every task. Base phrases are
counted wherever their words stand one after another. Null texts count as empty: no words,
null places, empty labels, score 0. Ids may be null or repeated; each row gets its row.
"""

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from barkeep.llm.batches import pick, slices, to_batch, word_bytes, words_of

# The phrases and labels every scan reports.
BASE = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Short notices as their licenses recommend them.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the"
            " GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)
MOST_TEMPLATE_BYTES = 4_000_000
SHORT = 8

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, n_matches long"
)
MATCHES = "doc_id long, first_word long, label string, template string, overlap long, containment double"
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("n_matches", pa.int64()),
    ]
)
_MATCHES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("first_word", pa.int64()),
        ("label", pa.string()),
        ("template", pa.string()),
        ("overlap", pa.int64()),
        ("containment", pa.float64()),
    ]
)


def document_frequency(texts, words):
    """How many rows hold each of the given words, for words that occur: one row per word."""
    words = frozenset(words)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        counts = Counter()
        for batch in batches:
            for _, raws in slices(batch, "text"):
                for raw in raws:
                    counts.update(words.intersection(word_bytes(raw).split()))
        yield to_batch(schema, [w.decode() for w in counts], list(counts.values()))

    counted = texts.select("text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Matcher:
    """Templates as sets in corpus order, with an index of their prefixes."""

    def __init__(self, templates, frequency, threshold):
        spelt = [word_bytes(text.encode()).split() for _, text in templates]
        sets = [frozenset(words) for words in spelt]
        self.labels = [label for label, _ in templates]
        self.texts = [text for _, text in templates]
        self.order = {
            w: n for n, w in enumerate(sorted(set().union(*sets), key=lambda w: (frequency.get(w.decode(), 0), w)))
        }
        self.sorted = [sorted(self.order[w] for w in s) for s in sets]
        self.needed = [max(1, math.ceil(threshold * len(s) - 1e-9)) for s in sets]
        self.phrases = [
            re.compile(rb"(?: \S+)? ".join([b" " + re.escape(words[0]), *map(re.escape, words[1:])]) + b" ")
            if words and len(s) < SHORT
            else None
            for words, s in zip(spelt, sets)
        ]
        users = {}
        for label, s in zip(self.labels, sets):
            for w in s:
                users.setdefault(w, set()).add(label)
        self.own = [frozenset(self.order[w] for w in s if len(users[w]) == 1) for s in sets]
        self.prefixes = {}
        for t, numbers in enumerate(self.sorted):
            for place, number in enumerate(numbers[: len(numbers) - self.needed[t] + 1]):
                self.prefixes.setdefault(number, []).append((t, place))
        names = {n: w for w, n in self.order.items()}
        self.prefix_words = frozenset(names[n] for n in self.prefixes)
        self.length = max((len(word_bytes(text.encode()).split()) for _, text in templates), default=1)

    def matches(self, words):
        """(template, first word of the block, shared words, fit for a label) of all pairs at the threshold."""
        found = []
        if self.prefix_words.isdisjoint(words):
            return found
        order, step = self.order.get, self.length
        for start in range(0, max(1, len(words) - step), step):
            stretch = words[start : start + 2 * step]
            block, line = set(stretch), None
            shared = sorted(n for n in map(order, block) if n is not None)
            have = set(shared)
            seen = set()
            for at, number in enumerate(shared):
                for t, place in self.prefixes.get(number, ()):
                    if t in seen:
                        continue
                    seen.add(t)
                    need, numbers = self.needed[t], self.sorted[t]
                    if len(block) < need or 1 + min(len(numbers) - place - 1, len(shared) - at - 1) < need:
                        continue
                    overlap = sum(n in have for n in numbers)
                    if overlap < need:
                        continue
                    fit = not self.own[t] or not self.own[t].isdisjoint(have)
                    if fit and self.phrases[t]:
                        line = line or b" %b " % b" ".join(stretch)
                        fit = overlap == len(numbers) and self.phrases[t].search(line) is not None
                    found.append((t, start, overlap, fit))
        return found


def _base_places(words, base):
    """(start, label) of every phrase occurrence."""
    last = {}
    for phrase, label in base:
        last.setdefault(phrase[-1], []).append((phrase, label))
    ends = [i for i, w in enumerate(words) if w in last]
    return [
        (i - len(phrase) + 1, label)
        for i in ends
        for phrase, label in last[words[i]]
        if i + 1 >= len(phrase) and words[i - len(phrase) + 1 : i + 1] == phrase
    ]


def _matcher(texts, templates, threshold):
    if sum(len(text) for _, text in templates) > MOST_TEMPLATE_BYTES:
        raise ValueError("every task holds all templates: they must stay below MOST_TEMPLATE_BYTES")
    vocabulary = set().union(*(word_bytes(text.encode()).split() for _, text in templates))
    # At most one row per template word comes back.
    frequency = {r["word"]: r["n"] for r in document_frequency(texts, vocabulary).collect()}
    return Matcher(templates, frequency, threshold)


def license_matches(docs, templates=TEMPLATES, threshold=0.8, id_col="doc_id", text_col="text"):
    """One row per block and template at the threshold, with the place of the block's first word.

    Rows without a match, null and empty texts among them, give none; repeated rows give theirs each.
    """
    texts = pick(docs, id_col, text_col)
    matcher = _matcher(texts, templates, threshold)

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                out = [
                    (doc_id, start, matcher.labels[t], matcher.texts[t], overlap, overlap / len(matcher.sorted[t]))
                    for doc_id, raw in zip(rows.column("doc_id").to_pylist(), raws)
                    for t, start, overlap, _ in matcher.matches(words_of(raw))
                ]
                if out:
                    yield to_batch(_MATCHES, *map(list, zip(*out)))

    return texts.mapInArrow(run, MATCHES)


def license_scan(docs, templates=TEMPLATES, threshold=0.8, base=BASE, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: base places, labels, the largest containment of a label's template as score, matches."""
    texts = pick(docs, id_col, text_col)
    matcher = _matcher(texts, templates, threshold)
    phrases = [(phrase.encode().split(), label) for phrase, label in base]
    rare = [phrase[-1] for phrase, _ in phrases]

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                out = [[] for _ in range(8)]
                for raw in raws:
                    shown = word_bytes(raw)
                    words = shown.split()
                    places = _base_places(words, phrases) if any(w in shown for w in rare) else []
                    matches = matcher.matches(words)
                    held = [(t, overlap / len(matcher.sorted[t])) for t, _, overlap, fit in matches if fit]
                    own = {label for _, label in places}
                    starts = [start for start, _ in places]
                    score = 1.0 if places else max((share for _, share in held), default=0.0)
                    labels = own | {matcher.labels[t] for t, _ in held}
                    for column, value in zip(
                        out,
                        (
                            len(words),
                            len(places),
                            min(starts, default=None),
                            max(starts, default=None),
                            ",".join(sorted(own)),
                            ",".join(sorted(labels)),
                            score,
                            len(matches),
                        ),
                    ):
                        column.append(value)
                yield to_batch(_OUT, rows.column("doc_id"), *out)

    return texts.mapInArrow(run, SCHEMA)
