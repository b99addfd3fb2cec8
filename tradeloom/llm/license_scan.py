"""Licence scan with a positional index of rare words.

The index has, for each word of a licence template, its places in the templates and its rarity over all documents. A
document is looked up by the rarest words of each template; each hit proposes where the template would start, proposals
of all words at the same start are intersected, and the score of a start is the rarity of its words that stand where the
template has them. A match needs the least score of its template and all mandatory key phrases, each in its place.
Phrases that must be counted wherever they stand are templates that match only whole.

A null or empty text has no words and no labels; repeated rows stay repeated; an empty table gives an empty result;
extra columns stay as they are, one called like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.texts import Texts, Words, slices, span_hashes, words

#: Rarest words of a template by which it is looked up.
LOOKUPS = 3
#: Least share of a template's rarity that must be in place.
LEAST = 0.6

# Phrases counted wherever their words stand consecutively, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Openings of well-known licences as (label, words, mandatory key phrase).
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
]

_BREAKS = np.ones(256, bool)
_BREAKS[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _hash(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return span_hashes(data, np.zeros(1, np.int64), np.array([len(data)]))[0]


@dataclass
class Template:
    label: str
    words: np.ndarray
    required: np.ndarray
    least: float
    base: bool


class Index:
    """Licence words by hash, and all templates as word numbers."""

    def __init__(self, base: dict[str, str], templates: list[tuple[str, str, str]]) -> None:
        vocabulary = sorted({w for text in [*base, *(t for _, t, _ in templates)] for w in text.split()}, key=_hash)
        number = {w: i for i, w in enumerate(vocabulary)}
        self.words = vocabulary
        self.hashes = np.array([_hash(w) for w in vocabulary], np.uint64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.hashes & np.uint64(0xFFFF)] = True
        self.templates = []
        for text, label in base.items():
            parts = np.array([number[w] for w in text.split()])
            self.templates.append(Template(label, parts, np.ones(len(parts), bool), 1.0, True))
        for label, text, phrase in templates:
            parts, key = text.split(), phrase.split()
            at = next(i for i in range(len(parts)) if parts[i : i + len(key)] == key)
            required = np.zeros(len(parts), bool)
            required[at : at + len(key)] = True
            self.templates.append(Template(label, np.array([number[w] for w in parts]), required, LEAST, False))

    def numbers(self, texts: Texts, found: Words) -> np.ndarray:
        """Number of each word of the texts, -1 for words of no template."""
        hashes = span_hashes(_LOWER[texts.data], found.starts, found.ends)
        result = np.full(len(hashes), -1, np.int16)
        hits = np.flatnonzero(self.maybe[hashes & np.uint64(0xFFFF)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[hits]), len(self.hashes) - 1)
        real = self.hashes[place] == hashes[hits]
        result[hits[real]] = place[real]
        return result

    def frequencies(self, documents: DataFrame) -> np.ndarray:
        """Rarity of each licence word: log((documents + 1) / (documents with it + 1)), counted over all documents."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(self.words) + 1, np.int64)
            for texts in slices(batches):
                found = words(Texts(texts.rows, _LOWER[texts.data], texts.offsets), _BREAKS)
                numbers = self.numbers(texts, found)
                at = np.flatnonzero(numbers >= 0)
                pairs = np.unique(np.stack([found.text_of()[at], numbers[at].astype(np.int64)], 1), axis=0)
                total[:-1] += np.bincount(pairs[:, 1], minlength=len(self.words))
                total[-1] += len(texts)
            yield pa.RecordBatch.from_pydict({"word": pa.array(np.arange(len(total)), pa.int32()), "n": total})

        rows = documents.select("text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros(len(self.words) + 1)
        for row in rows:
            counts[row.word] = row.n
        return np.log((counts[-1] + 1) / (counts[:-1] + 1)) + 1e-9

    def matches(self, template: Template, numbers: np.ndarray, bounds: tuple[np.ndarray, np.ndarray], by_word: dict[int, np.ndarray], rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and scores of the template's matches. ``bounds``: first word and end of the text of each word."""
        weights = rarity[template.words]
        # Without key phrases in place there is no match, so the rarest words are taken from these.
        keys = np.flatnonzero(template.required)
        keys = keys[np.argsort(-weights[keys], kind="stable")][: 1 if template.base else LOOKUPS]
        proposals = [by_word[template.words[k]] - k for k in keys if template.words[k] in by_word]
        if not proposals:
            return np.zeros(0, np.int64), np.zeros(0)
        starts = np.unique(np.concatenate(proposals))
        anchor = starts + keys[0]
        good = (anchor >= 0) & (anchor < len(numbers))
        starts, anchor = starts[good], anchor[good]
        low, high = bounds[0][anchor], bounds[1][anchor]
        score, whole = np.zeros(len(starts)), np.ones(len(starts), bool)
        for k, word in enumerate(template.words):
            at = starts + k
            inside = (at >= low) & (at < high)
            here = inside & (numbers[np.clip(at, 0, len(numbers) - 1)] == word)
            score += here * weights[k]
            if template.required[k]:
                whole &= here
        score = score / weights.sum()
        good = whole & (score >= template.least - 1e-9)
        return starts[good], score[good]


def scan(documents: DataFrame, base: dict[str, str] = BASE, templates: list[tuple[str, str, str]] = TEMPLATES) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score, and the places of all matches."""
    index = Index(base, templates)
    rarity = index.frequencies(documents)
    added = {
        "n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long",
        "base_labels": "string", "labels": "string", "score": "double", "places": "array<struct<label:string,word:bigint>>",
    }
    kept = [f.name for f in documents.schema if f.name not in added]
    place_type = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            found = words(Texts(texts.rows, _LOWER[texts.data], texts.offsets), _BREAKS)
            numbers = index.numbers(texts, found)
            counts, text_of = found.counts(), found.text_of()
            bounds = found.offsets[:-1][text_of], found.offsets[1:][text_of]
            hits = np.flatnonzero(numbers >= 0)
            order = hits[np.argsort(numbers[hits], kind="stable")]
            present, first = np.unique(numbers[order], return_index=True)
            by_word = dict(zip(present.tolist(), np.split(order, first[1:]), strict=False))
            n = len(texts)
            n_base, score = np.zeros(n, np.int64), np.zeros(n)
            first_word, last_word = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            labels: list[set] = [set() for _ in range(n)]
            base_labels: list[set] = [set() for _ in range(n)]
            places: list[list] = [[] for _ in range(n)]
            for template in index.templates:
                starts, scores = index.matches(template, numbers, bounds, by_word, rarity)
                which = text_of[starts + np.flatnonzero(template.required)[0]]
                within = starts - found.offsets[which]
                np.maximum.at(score, which, scores)
                if template.base:
                    np.add.at(n_base, which, 1)
                    np.minimum.at(first_word, which, within)
                    np.maximum.at(last_word, which, within)
                for text, place in zip(which.tolist(), within.tolist(), strict=True):
                    labels[text].add(template.label)
                    places[text].append({"label": template.label, "word": place})
                    if template.base:
                        base_labels[text].add(template.label)
            columns = [
                pa.array(counts), pa.array(n_base),
                pa.array(first_word, mask=n_base == 0), pa.array(last_word, mask=n_base == 0),
                pa.array([",".join(sorted(x)) for x in base_labels]), pa.array([",".join(sorted(x)) for x in labels]),
                pa.array(np.minimum(score, 1.0).round(6)), pa.array(places, place_type),
            ]
            yield pa.RecordBatch.from_arrays([*(texts.rows.column(c) for c in kept), *columns], names=[*kept, *added])

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name not in added]
    return documents.mapInArrow(run, ", ".join(schema + [f"{c} {t}" for c, t in added.items()]))
