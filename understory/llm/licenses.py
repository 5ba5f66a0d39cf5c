"""License scans: phrases, and an exact set-similarity join of text blocks with license notices.

Blocks are all runs of as many consecutive words as a template has, over line ends too.
A template is found in a block that holds at least `threshold` of the template's distinct
words and all of its distinguishing words.  Words are ordered by how many documents of the
whole table hold them, rarest first; a document can only have such a block if it holds one
of the template's first words in that order (prefix filter), has enough words (length
filter) and, at the first shared word, enough words left in both orders (position filter).
In what passes, counts of the template's words slide over their places, so every block is
counted exactly and the join loses nothing.

Blocks that touch are one place, reported by the best of them.  Where templates of several
labels lie over each other (a notice that others are a part of), the one of the greatest
containment, then of the most words, is the place's label.

Templates are a parameter of a few short texts and travel with the code; documents
are never shuffled.

Defined results: null and empty texts have 0 words, no labels and score 0; a very long text
is read whole; null and repeated ids don't matter; input columns of a made column's name are
replaced, others kept; repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from understory.llm import textkernel as tk
from understory.llm.common import map_arrow, with_text_columns

#: Phrases of the base labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, distinguishing words and wording of public license notices.
TEMPLATES = [
    ("agpl", "affero", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache-2.0", "apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsl-1.0", "organization", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("cc-by-4.0", "attribution 4", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "noncommercial 4", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa-4.0", "sharealike 4", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "general public", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("isc", "fee", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl", "lesser", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("mit", "deal sublicense", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("mpl-2.0", "mozilla", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "unencumbered", "This is free and unencumbered software released into the public domain."),
    ("zlib", "arising", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
]
THRESHOLD = 0.8

FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("matches", T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("word", T.LongType()), T.StructField("containment", T.DoubleType())]))),
]

_TO_WORDS = bytes(int(b) or 32 for b in tk.WORD_BYTE)


def _words(text: str) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split()


@dataclass(frozen=True)
class Item:
    """A template: distinct words in global order, how many a block must hold, and its words in all."""

    label: str
    marks: frozenset
    ordered: list
    whole: frozenset
    need: int
    length: int


class Matcher:
    """The templates in global word order, with an index on their prefixes."""

    def __init__(self, templates: list[tuple[str, str, str]], frequency: dict[bytes, int], threshold: float):
        vocabulary = {w for _, _, text in templates for w in _words(text)}
        self.rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
        self.index: dict[bytes, list[tuple[Item, int]]] = {}
        for label, marks, text in templates:
            ordered = sorted(set(_words(text)), key=self.rank.__getitem__)
            need = max(1, math.ceil(threshold * len(ordered) - 1e-9))
            item = Item(label, frozenset(_words(marks)), ordered, frozenset(ordered), need, len(_words(text)))
            for at, w in enumerate(ordered[: len(ordered) - need + 1]):
                self.index.setdefault(w, []).append((item, at))
        self.prefixes = frozenset(self.index)

    def candidates(self, words: frozenset) -> list[Item]:
        """The templates that a document of these words may have a block of."""
        shared = sorted((w for w in words if w in self.rank), key=self.rank.__getitem__)
        seen, out = set(), []
        for j, w in enumerate(shared):
            for item, i in self.index.get(w, ()):
                if id(item) in seen:
                    continue
                seen.add(id(item))  # the first shared word: the ones before it are in one order only
                if len(words) >= item.need and 1 + min(len(item.ordered) - i - 1, len(shared) - j - 1) >= item.need:
                    if item.marks <= words and len(item.whole & words) >= item.need:
                        out.append(item)
        return out

    def found(self, words: list[bytes]) -> list[dict]:
        """The places of templates in a document, in their order."""
        places: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.rank:
                places.setdefault(w, []).append(i)
        hits = [(held, *hit) for item in self.candidates(frozenset(places) if len(places) == len(words) else frozenset(words)) for held, *hit in _best(words, places, item)]
        kept: list[tuple] = []
        for held, first, last, item in sorted(hits, key=lambda h: (-h[0] / len(h[3].ordered), -h[0], h[3].label, h[1])):
            if all(first > y or last < x or item.label == other.label for _, x, y, other in kept):
                kept.append((held, first, last, item))
        return [{"label": item.label, "word": first, "containment": held / len(item.ordered)} for held, first, _, item in sorted(kept, key=lambda h: (h[1], h[3].label))]


def _best(words: list[bytes], places: dict[bytes, list[int]], item: Item) -> Iterator[tuple[int, int, int, Item]]:
    """(words held, first, last, item) of the best block of each place; blocks end at words of the template, as the best ones do."""
    at = sorted(i for w in item.ordered for i in places.get(w, ()))
    counts: Counter = Counter()
    left, best, upto = 0, None, -1
    for i in at:
        counts[words[i]] += 1
        while i - at[left] >= item.length:
            counts[words[at[left]]] -= 1
            if not counts[words[at[left]]]:
                del counts[words[at[left]]]
            left += 1
        if len(counts) < item.need or not item.marks <= counts.keys():
            continue
        if best is not None and at[left] > upto:
            yield best
            best = None
        if best is None or len(counts) > best[0]:
            best = (len(counts), at[left], i, item)
        upto = i
    if best is not None:
        yield best


def _places(words: list[bytes], phrases: dict[bytes, str]) -> list[tuple[int, str]]:
    """(start, label) of every place where a phrase's words stand consecutively."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        wanted = b" " + phrase + b" "
        at = joined.find(wanted)
        while at >= 0:
            found.append((joined.count(b" ", 0, at), label))
            at = joined.find(wanted, at + 1)
    return found


def _scan(column: pa.Array, matcher: Matcher, phrases: dict[bytes, str]) -> list[pa.Array]:
    out: list[list] = [[] for _ in FIELDS]
    keys = [p.split()[-1] for p in phrases]
    for text in column.cast(pa.binary()).to_pylist():
        low = (text or b"").translate(_TO_WORDS)
        words = low.split()
        places = sorted(_places(words, phrases)) if any(k in low for k in keys) else []
        matches = [] if matcher.prefixes.isdisjoint(words) else matcher.found(words)
        base = {label for _, label in places}
        every = base | {m["label"] for m in matches}
        score = 1.0 if base else max((m["containment"] for m in matches), default=0.0)
        for value, to in zip((len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(base)), ",".join(sorted(every)), score, matches), out, strict=True):
            to.append(value)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("containment", pa.float64())]))]
    return [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]


def frequencies(docs: DataFrame, templates: list[tuple[str, str, str]], text_col: str = "text") -> dict[bytes, int]:
    """In how many documents each template word stands, over the whole table."""
    vocabulary = frozenset(w for _, _, text in templates for w in _words(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                if text:
                    total.update(vocabulary.intersection(text.translate(_TO_WORDS).split()))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    counted = map_arrow(docs.select(text_col), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.collect()}  # a row a template word at most


def scan(docs: DataFrame, text_col: str = "text", phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """docs with the columns of FIELDS.

    n_base, first_word, last_word, base_labels come from phrases; labels has the
    templates' labels too; matches: label, first word and containment of each place of a
    template; score is 1 for a base phrase, else the highest containment.
    """
    frequency = frequencies(docs, templates, text_col)
    wanted = {" ".join(p.split()).encode(): label for p, label in phrases.items()}

    def kernel():
        matcher = Matcher(templates, frequency, threshold)
        return lambda column: _scan(column, matcher, wanted)

    return with_text_columns(docs, text_col, FIELDS, kernel)


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for each row of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", *(f.name for f in FIELDS if f.name != "matches"))
