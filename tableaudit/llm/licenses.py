"""Licence scan by a positional index of rare words.

The index lists, for each template, the positions of its rarest words; rarity is
the inverse document frequency over all documents.  For each file the scan looks
up its licence words in that index, each giving (template, start) as the word's
place less the word's place in the template.  Starts on which enough rare words
agree are candidates; a candidate counts when all words of the template's
mandatory phrases stand where the template has them, and it is scored by the
share of the template's words that do.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import folded

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")

# The base phrases, and sentences by which public licences are known.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license",
        ("licensed under the apache license", "in compliance with the license"),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ("you can redistribute it and or modify it", "gnu general public license"),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted",
        ("with or without fee is hereby granted",),
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license",
        ("terms of the mozilla public license",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("bsd", "bsd license", ("bsd license",)),
    ("mpl", "mozilla public license", ("mozilla public license",)),
    ("cc", "creative commons attribution", ("creative commons attribution",)),
    ("cc", "licensed under cc by", ("cc by",)),
)


@dataclass(frozen=True)
class Template:
    """A licence text: its label, its words, the phrases that must be there, and whether it is a base phrase."""

    label: str
    words: tuple[bytes, ...]
    mandatory: tuple[int, ...]
    base: bool


def _template(label: str, text: str, phrases: tuple[str, ...], base: bool) -> Template:
    words = tuple(text.encode().split())
    places: set[int] = set()
    for phrase in phrases:
        wanted = tuple(phrase.encode().split())
        start = next(i for i in range(len(words)) if words[i : i + len(wanted)] == wanted)
        places |= set(range(start, start + len(wanted)))
    return Template(label, words, tuple(sorted(places)), base)


TEMPLATES = tuple(
    [_template(label, phrase, (phrase,), True) for phrase, label in BASE.items()]
    + [_template(label, text, phrases, False) for label, text, phrases in NOTICES]
)


def _words(text: bytes) -> list[bytes]:
    return _WORDS.findall(text)


def document_frequency(docs: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of these words occurs, over all documents; under b"" their number.

    The words are those of the templates, so the result has one row for each of them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in folded(batch.column(0)):
                seen.update(words.intersection(_words(text)))
                seen[b""] += 1
        yield pa.RecordBatch.from_pydict(
            {"word": [w.decode() for w in seen], "n": pa.array(seen.values(), pa.int64())}
        )

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long")
    return {r["word"].encode(): r["n"] for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


@dataclass(frozen=True)
class Index:
    """Postings of rare words, (template, place), and how many of them must agree for each template."""

    templates: tuple[Template, ...]
    postings: dict[bytes, tuple[tuple[int, int], ...]]
    votes: tuple[int, ...]


def build_index(templates: tuple[Template, ...], frequency: dict[bytes, int], rare_words: int = 5) -> Index:
    total = frequency.get(b"", 0)
    idf = {w: math.log((1 + total) / (1 + frequency.get(w, 0))) for t in templates for w in t.words}
    postings: dict[bytes, list[tuple[int, int]]] = {}
    votes = []
    for number, template in enumerate(templates):
        # Rare words are taken from the mandatory phrases: all of them are there in every hit.
        words = sorted({template.words[i] for i in template.mandatory}, key=lambda w: (-idf[w], w))[:rare_words]
        places = [i for i in template.mandatory if template.words[i] in words]
        votes.append(len(places))
        for i in places:
            postings.setdefault(template.words[i], []).append((number, i))
    return Index(templates, {w: tuple(p) for w, p in postings.items()}, tuple(votes))


def scan_words(words: list[bytes], index: Index, least_share: float) -> list[tuple[int, int, float]]:
    """(template, start, share of its words in place) of each template that the words hold."""
    postings = index.postings
    agree: Counter = Counter()
    for at, word in enumerate(words):
        if word in postings:
            for number, place in postings[word]:
                agree[number, at - place] += 1
    found = []
    for (number, start), votes in agree.items():
        template = index.templates[number]
        end = start + len(template.words)
        if votes < index.votes[number]:
            continue
        # Every mandatory word needs a place inside the text.
        if start + template.mandatory[0] < 0 or start + template.mandatory[-1] >= len(words):
            continue
        if any(words[start + i] != template.words[i] for i in template.mandatory):
            continue
        held = sum(0 <= i < len(words) and words[i] == template.words[i - start] for i in range(start, end))
        share = held / len(template.words)
        if template.base or share >= least_share:
            found.append((number, start, share))
    return sorted(found, key=lambda f: (f[1], f[0]))


SCAN = (
    "doc_id long, n_words long, hits array<struct<label:string, start:long, length:int, share:double, base:boolean>>"
)


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    rare_words: int = 5,
    least_share: float = 0.8,
) -> DataFrame:
    """For each document (doc_id, text): n_words and its hits, in order of place.

    Words count from 0.  A hit needs all mandatory words in place and
    ``least_share`` of all words; base phrases need all.  Null and empty texts
    have no words and no hits; repeated rows give repeated results; an empty
    table gives none.  Other columns are not read.
    """
    words = {w for t in templates for w in t.words}
    index = build_index(templates, document_frequency(docs, words), rare_words)
    hit = pa.struct(
        [
            ("label", pa.string()), ("start", pa.int64()), ("length", pa.int32()), ("share", pa.float64()),
            ("base", pa.bool_()),
        ]
    )
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(hit))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hits = [], []
            for text in folded(batch.column(1)):
                found_words = _words(text)
                counts.append(len(found_words))
                hits.append(
                    [
                        {
                            "label": templates[n].label,
                            "start": start,
                            "length": len(templates[n].words),
                            "share": share,
                            "base": templates[n].base,
                        }
                        for n, start, share in scan_words(found_words, index, least_share)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(hits, pa.list_(hit))], schema=schema
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(scan, SCAN)


def license_digest(scanned: DataFrame) -> DataFrame:
    """Counts, places and labels of each document's hits."""
    base = F.filter("hits", lambda h: h["base"])
    labels = lambda hits: F.array_join(F.sort_array(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda h: h["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda h: h["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0)).alias("score"),
        F.size("hits").cast("long").alias("n_hits"),
    )
