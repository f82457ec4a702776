"""Licence scan with a positional index of rare tokens.

Templates are short licence texts and bare phrases, each with a label. The index keeps, per template, the postings
(word, position) of its words with the highest inverse document frequency, counted over all texts that are scanned. In
a file only those rare words are looked up. A posting at template position p met at word i votes for the template
starting at word i - p; votes that agree intersect the postings by relative position. An alignment is a match when the
template's mandatory phrase stands at its place (shifted by SLACK words at most) and enough of the template's words
stand at theirs. A bare phrase is a template that is its own mandatory phrase, with one posting, its rarest word: every
place where the phrase stands is found, and each is verified word by word.

Defined results: null is the empty text: no words, no places, score 0.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Phrases of the base rule with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Openings of well-known licence texts, as words, with label and mandatory phrase.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit", "free of charge to any person"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd", "redistribution and use in source and binary forms"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
     "license", "apache-2.0", "apache license version 2 0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl", "gnu general public license"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0",
     "gnu general public license version 3"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
     "public license as published by the free software foundation", "lgpl", "gnu lesser general public license"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0",
     "mozilla public license v 2 0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "isc", "for any purpose with or without fee"),
    ("this is free and unencumbered software released into the public domain", "unlicense",
     "unencumbered software released into the public domain"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0", "cc by nc 4 0"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0",
     "creative commons attribution 4 0"),
)

POSTINGS = 5
SLACK = 2
LEAST_SHARE = 0.6

#: A-Z lower-cased, every other ASCII character that is no letter or digit turned into a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def scan_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


@dataclass(frozen=True)
class Template:
    words: tuple[bytes, ...]
    label: str
    phrase: tuple[bytes, ...]
    at: int
    bare: bool

    @staticmethod
    def of(text: str, label: str, phrase: str) -> "Template":
        words, must = tuple(text.encode().split()), tuple(phrase.encode().split())
        at = next(i for i in range(len(words)) if words[i:i + len(must)] == must)
        return Template(words, label, must, at, words == must)


def default_templates() -> tuple[Template, ...]:
    return (*(Template.of(p, label, p) for p, label in PHRASES), *(Template.of(*t) for t in TEMPLATES))


class Index:
    """Postings of the rarest words of each template under given document frequencies."""

    def __init__(self, templates: tuple[Template, ...], frequency: dict[bytes, int], documents: int):
        self.templates = templates
        self.idf = {w: log((1 + documents) / (1 + frequency.get(w, 0))) for t in templates for w in t.words}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, t in enumerate(templates):
            rare = sorted(set(t.words), key=lambda w: (-self.idf[w], w))[:1 if t.bare else POSTINGS]
            for p, w in enumerate(t.words):
                if w in rare:
                    self.postings[w].append((k, p))
        self.rare = frozenset(self.postings)

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, share of its words in place) of every match."""
        if self.rare.isdisjoint(words):
            return []
        votes: Counter = Counter()
        for i, w in enumerate(words):
            if w in self.rare:
                for k, p in self.postings[w]:
                    votes[k, i - p] += 1
        found = []
        for (k, start), n in votes.items():
            t = self.templates[k]
            if t.bare:
                if start >= 0 and tuple(words[start:start + len(t.words)]) == t.words:
                    found.append((k, start, 1.0))
            elif n >= 2 and self._phrase_near(t, words, start):
                share = sum(0 <= start + j < len(words) and words[start + j] == w for j, w in enumerate(t.words)) / len(t.words)
                if share >= LEAST_SHARE:
                    found.append((k, start, share))
        return found

    @staticmethod
    def _phrase_near(t: Template, words: list[bytes], start: int) -> bool:
        n = len(t.phrase)
        return any(i >= 0 and tuple(words[i:i + n]) == t.phrase
                   for i in range(start + t.at - SLACK, start + t.at + SLACK + 1))


def document_frequencies(df: DataFrame, vocabulary: frozenset[bytes], text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """Number of texts with each word of the vocabulary, and of all texts; one small row per word and task travels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(vocabulary.intersection(scan_words(text.as_py())))
            counts[b""] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                         ["word", "n"])

    found = df.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {bytes(r["word"]): r["n"] for r in found}
    return counts, counts.pop(b"", 0)


def scan(df: DataFrame, templates: tuple[Template, ...] | None = None, id_col: str = "doc_id", text_col: str = "text"
         ) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches (label, start, share)."""
    templates = default_templates() if templates is None else templates
    counts, total = document_frequencies(df, frozenset(w for t in templates for w in t.words), text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, counts, total)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = scan_words(text.as_py())
                found = index.scan(words)
                base = sorted(s for k, s, _ in found if templates[k].bare)
                rows.append({
                    "doc_id": doc_id.as_py(), "n_words": len(words), "n_base": len(base),
                    "first_word": base[0] if base else None, "last_word": base[-1] if base else None,
                    "base_labels": ",".join(sorted({templates[k].label for k, _, _ in found if templates[k].bare})),
                    "labels": ",".join(sorted({templates[k].label for k, _, _ in found})),
                    # A bare phrase is half the evidence, a licence text in place up to all of it.
                    "score": max([0.5 if templates[k].bare else share for k, _, share in found], default=0.0),
                    "matches": [{"label": templates[k].label, "start": s, "share": share}
                                for k, s, share in sorted(found, key=lambda f: (f[1], f[0]))]})
            yield pa.RecordBatch.from_pylist(rows, schema)

    kind = df.schema[id_col].dataType.simpleString()
    out = (f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double, matches array<struct<label: string, start: long, share: double>>")
    match = pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())])
    from pyspark.sql.pandas.types import to_arrow_type
    schema = pa.schema([("doc_id", to_arrow_type(df.schema[id_col].dataType)), *((n, pa.int64()) for n in
                        ("n_words", "n_base", "first_word", "last_word")), ("base_labels", pa.string()),
                        ("labels", pa.string()), ("score", pa.float64()), ("matches", pa.list_(match))])
    return df.select(id_col, text_col).mapInArrow(run, out)
