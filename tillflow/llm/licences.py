"""Licence scan with a positional index of rare words.

The templates' words are weighed by how many documents hold them (idf over the whole
corpus, counted for the templates' vocabulary only). Each template is entered in the
index under its few rarest words with their positions. A file looks up the rare words it
holds; postings that agree on where the template begins are one match, which must
cover most of the rare words, hold the template's mandatory phrase, and agree with
most of its other words.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Fixed values. Phrases that count wherever they stand, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Fixed values. Templates: label, mandatory phrase, text.
TEMPLATES = [
    ("mit", "released under the mit license", "released under the mit license"),
    ("mit", "permission is hereby granted", """permission is hereby granted free of charge to any person
     obtaining a copy of this software and associated documentation files the software to deal in the
     software without restriction including without limitation the rights to use copy modify merge publish
     distribute sublicense and or sell copies of the software"""),
    ("apache", "under the apache license", "licensed under the apache license version 2 0"),
    ("gpl", "gnu general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it", """this program is free software you can redistribute it and or
     modify it under the terms of the gnu general public license as published by the free software foundation"""),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms", """redistribution and use in source and binary
     forms with or without modification are permitted provided that the following conditions are met"""),
    ("mpl", "mozilla public license", """this source code form is subject to the terms of the mozilla public
     license v 2 0"""),
]


@dataclass
class Template:
    label: str
    phrase: list[bytes]
    words: list[bytes]
    rare: list[int]  # positions of its rarest words


def template_words(text: str) -> list[bytes]:
    return WORD.findall(text.encode())


def document_counts(docs: DataFrame, vocabulary: set[bytes], text: str) -> tuple[dict[bytes, int], int]:
    """In how many documents each word of a fixed vocabulary stands, and how many there are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts[b""] += batch.num_rows
            for raw in batch.column(0).to_pylist():
                counts.update(vocabulary.intersection(WORD.findall(raw.lower())))
        yield pa.RecordBatch.from_arrays([
            pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"])

    whole = docs.select(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("text"))
    rows = whole.mapInArrow(work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {bytes(r["word"]): r["n"] for r in rows}
    return found, found.pop(b"", 0)


def indexed(templates: list[tuple[str, str, str]], counts: dict[bytes, int], documents: int,
            rare_words: int) -> list[Template]:
    """The templates with the positions of their words of highest idf."""
    made = []
    for label, phrase, text in templates:
        words = template_words(text)
        idf = [math.log((documents + 1) / (counts.get(w, 0) + 1)) for w in words]
        rare = sorted(range(len(words)), key=lambda i: (-idf[i], i))[:rare_words]
        made.append(Template(label, template_words(phrase), words, sorted(rare)))
    return made


class Scanner:
    def __init__(self, templates: list[Template], agree: float, phrases: dict[str, str]):
        self.templates = templates
        self.agree = agree
        self.phrases = [(template_words(p), label) for p, label in phrases.items()]
        self.last = {p[-1] for p, _ in self.phrases}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, template in enumerate(templates):
            for place in template.rare:
                self.postings[template.words[place]].append((number, place))
        self.rare = set(self.postings)

    def base(self, words: list[bytes]) -> list[tuple[int, str]]:
        """(first word, label) of every place of a phrase."""
        found = []
        for phrase, label in self.phrases:
            at = -1
            for _ in range(words.count(phrase[0])):
                at = words.index(phrase[0], at + 1)
                if words[at:at + len(phrase)] == phrase:
                    found.append((at, label))
        return found

    def matches(self, words: list[bytes]) -> list[tuple[float, int, int]]:
        """(score, template, first word) of every template that stands in the words."""
        votes: Counter = Counter()
        for place, word in enumerate(words):
            for number, own in self.postings.get(word, ()):
                votes[number, place - own] += 1
        found = []
        for (number, begin), n in votes.items():
            template = self.templates[number]
            if n < self.agree * len(template.rare) or begin < 0:
                continue
            span = words[begin:begin + len(template.words)]
            same = sum(a == b for a, b in zip(span, template.words))
            score = same / len(template.words)
            if score >= self.agree and contains(span, template.phrase):
                found.append((score, number, begin))
        return found


def contains(words: list[bytes], phrase: list[bytes]) -> bool:
    return any(words[i:i + len(phrase)] == phrase for i in range(len(words) - len(phrase) + 1))


def scan(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, rare_words: int = 5,
         agree: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, matches (array of label, first_word, score).

    Words are runs of digits, letters and anything beyond ASCII, A-Z in lower case. n_base
    counts the places of the fixed phrases; first_word and last_word are the least and
    greatest place (null without one). labels are the phrases' and the matches', distinct,
    sorted, joined by commas. score is 1 if a phrase stands there, else the best match's,
    else 0. A null or empty text has no words, no labels and score 0. Repeated rows are
    answered each, other columns are ignored, an empty table gives an empty one.
    """
    vocabulary = {w for _, _, t in templates for w in template_words(t)}
    counts, documents = document_counts(docs, vocabulary, text)
    scanner = Scanner(indexed(templates, counts, documents, rare_words), agree, PHRASES)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
    match = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("score", pa.float64())])
    types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.list_(match)]

    def answer(raw: bytes) -> tuple:
        words = WORD.findall(raw.lower())
        if scanner.rare.isdisjoint(words) and scanner.last.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0, []
        base = scanner.base(words)
        hits = [(scanner.templates[k].label, begin, score) for score, k, begin in scanner.matches(words)]
        places = [p for p, _ in base]
        labels = {label for _, label in base}
        return (
            len(words), len(base), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)), ",".join(sorted(labels | {h[0] for h in hits})),
            1.0 if base else max((h[2] for h in hits), default=0.0),
            [{"label": a, "first_word": b, "score": c} for a, b, c in sorted(hits, key=lambda h: (h[1], h[0]))],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(i, *answer(raw)) for i, raw in zip(ids, batch.column(1).to_pylist(), strict=True)]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

    whole = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("text")).mapInArrow(
        work, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, matches array<struct<label:string,first_word:long,score:double>>")
