"""License notices in whole texts: exact phrases, and an exact set-similarity join with templates.

A template is a set of words. The text blocks held against it are windows of twice its length,
one beginning at every multiple of its length, so that any passage of that length lies whole
in one of them. A block is a match if it holds ``THRESHOLD`` percent of the template's words.

The words of each template are ordered by their counts in all texts, rarest first. A match holds
at least one of the first few of them (prefix filter), cannot be shorter than the words it
must hold (length filter), and must still be able to reach their number from the place in
the order where its first word stands (positional filter). Only what passes is counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parvis.llm.tables import id_text
from parvis.llm.words import LETTERS, text_bytes, cut_words, word_slices

THRESHOLD = 80

# Phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"),
           ("cc by", "cc-by"), ("mit license", "mit"))
# Opening sentences of well-known public licenses.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the Software), to deal in the Software "
            "without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this "
               "file except in compliance with the License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or "
            "neighboring rights to this work"),
)


def split_words(text: str) -> list[str]:
    data, offsets = text_bytes(pa.array([text], pa.string()))
    words = cut_words(data, offsets, LETTERS)
    return [words.word(i).decode() for i in range(len(words.hash))]


class Vocabulary:
    """The distinct words of phrases and templates, found by their hashes."""

    def __init__(self, phrases, templates) -> None:
        self.phrases, self.templates = tuple(phrases), tuple(templates)
        texts = [t for t, _ in self.phrases] + [t for _, t in self.templates]
        self.words = sorted({w for t in texts for w in split_words(t)})
        data, offsets = text_bytes(pa.array([" ".join(self.words)], pa.string()))
        hashes = cut_words(data, offsets, LETTERS).hash
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        self.place = {w: i for i, w in enumerate(self.words)}

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words of no template."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.number[at], -1)

    def of(self, text: str) -> list[int]:
        return [self.place[w] for w in split_words(text)]


def word_counts(rows: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How often each word of the vocabulary occurs in all texts; a row per word is collected."""
    size = len(vocabulary.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for _, _, words in word_slices(batch.column(1), LETTERS):
                found = vocabulary.numbers(words.hash)
                counts += np.bincount(found[found >= 0], minlength=size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(counts)], names=["word", "n"])

    counts = np.zeros(size, np.int64)
    for row in rows.mapInArrow(run, "word long, n long").groupBy("word").agg(
            F.sum("n").alias("n")).collect():
        counts[row["word"]] = row["n"]
    return counts


class Matcher:
    """Templates with their words in the global order, ready to be joined with texts."""

    def __init__(self, vocabulary: Vocabulary, counts: np.ndarray, threshold: int) -> None:
        self.vocabulary, self.parts = vocabulary, []
        for label, text in vocabulary.templates:
            numbers = vocabulary.of(text)
            order = sorted(set(numbers), key=lambda w: (counts[w], w))
            need = -(-threshold * len(order) // 100)
            rank = np.full(len(vocabulary.words) + 1, -1)
            rank[order] = np.arange(len(order))
            self.parts.append((label, len(numbers), len(order), need, rank))
        self.phrases = [(np.array(vocabulary.of(t)), label) for t, label in vocabulary.phrases]

    def base(self, numbers: np.ndarray, first: np.ndarray):
        """``(text, start word, label)`` of every place of a phrase, of all texts of a slice."""
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for phrase, label in self.phrases:
            last = len(numbers) - len(phrase) + 1
            if last <= 0:
                continue
            hit = numbers[:last] == phrase[0]
            for k in range(1, len(phrase)):
                hit &= numbers[k:last + k] == phrase[k]
            at = np.flatnonzero(hit)
            at = at[text_of[at] == text_of[at + len(phrase) - 1]]
            yield from zip(text_of[at].tolist(), (at - first[text_of[at]]).tolist(),
                           [label] * len(at), strict=True)

    def matches(self, numbers: np.ndarray):
        """``(label, first word, end word, containment)`` of every block of one text that matches."""
        for label, length, size, need, rank in self.parts:
            if len(numbers) < need:
                continue
            ranks = rank[numbers]
            near = np.flatnonzero((ranks >= 0) & (ranks < size - need + 1))
            blocks = np.unique(np.concatenate([near // length, near // length - 1]))
            for block in blocks[blocks >= 0].tolist() or [0] * bool(len(near)):
                start, end = block * length, min((block + 2) * length, len(numbers))
                found = ranks[start:end]
                found = found[found >= 0]
                if not len(found) or size - found.min() < need or end - start < need:
                    continue
                held = len(np.unique(found))
                if held >= need:
                    yield label, start, end, held / size


FOUND = ("doc_id long, n_words long, places array<struct<label: string, word: long>>, "
         "blocks array<struct<label: string, first_word: long, end_word: long, "
         "containment: double>>")


def find_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES,
                  threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
                  ) -> DataFrame:
    """One row per text: its number of words, the places of phrases and the matching blocks.

    Words are lower-cased runs of ASCII letters, digits and any non-ASCII characters, counted from
    0. A null text is empty. Templates and phrases are a fixed list of the caller's; their words
    are the only ones counted. Blocks that overlap are all listed.
    """
    rows = id_text(docs, id_col, text_col)
    vocabulary = Vocabulary(phrases, templates)
    matcher = Matcher(vocabulary, word_counts(rows, vocabulary), threshold)
    place = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    block = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                ("end_word", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places, blocks = [], [], []
            for i, j, words in word_slices(batch.column(1), LETTERS):
                numbers = vocabulary.numbers(words.hash)
                counts += np.diff(words.first).tolist()
                own = [[] for _ in range(j - i)]
                for text, word, label in matcher.base(numbers, words.first):
                    own[text].append({"label": label, "word": word})
                places += own
                for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                    blocks.append([dict(zip(("label", "first_word", "end_word", "containment"), m,
                                            strict=True)) for m in matcher.matches(numbers[a:b])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(places, place),
                 pa.array(blocks, block)], names=["doc_id", "n_words", "places", "blocks"])

    return rows.mapInArrow(run, FOUND)


def license_report(found: DataFrame) -> DataFrame:
    """Per text: phrase places and labels, all labels, and the best containment (1 for a phrase)."""
    def written(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    starts, base = F.col("places.word"), F.col("places.label")
    best = F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        written(base).alias("base_labels"),
        written(F.concat(base, F.col("blocks.label"))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"))
