"""License scans by a positional rare-token index, in DataFrame functions only.

Templates are short notices with one mandatory key phrase each, and licence texts cut
into passages, each with its own. The index lists, under the words of a template that
fewest templates use, where they stand in it. A file's words are looked up once: each
hit votes for where its template would begin, and a beginning for which enough words
agree is verified by comparing the whole key phrase. A found place is scored by how much
of the template's weight (inverse frequency of its words) stands aligned around it; a
licence text is found where all its passages are, so an edit spoils only the passage it
falls into, and that only where it hits the key phrase or most of the indexed words.
Everything happens within a row, so nothing is shuffled and a file may hold any number
of places.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import ascii_lower, inputs
from tapelake.llm.license_texts import TEXTS

# What stands between words, after lower-casing A-Z.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words of a notice's key phrase in the index, all of which have to agree.
INDEX_WORDS = 2
# Words of a passage in the index, and how many have to agree.
PASSAGE_WORDS = 6
PASSAGE_VOTES = 2

# Label, notice, and its mandatory key phrase. The base phrases come first.
BASE = [
    ("mit", "released under the mit license", "mit license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "licensed under the gnu general public license version 3", "general public license"),
]
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("bsd", "licensed under the bsd license", "bsd license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms",
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "permission is hereby granted free of charge",
    ),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc0", "dedicated to the public domain under creative commons zero", "creative commons zero"),
    ("proprietary", "all rights reserved", "all rights reserved"),
]


@dataclass(frozen=True)
class Notice:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool

    @cached_property
    def key_at(self) -> int:
        spans = range(len(self.words) - len(self.key) + 1)
        return next(i for i in spans if self.words[i : i + len(self.key)] == self.key)


def notices(extra: list[tuple[str, str, str]] | None = None) -> list[Notice]:
    rows = [(*row, True) for row in BASE] + [(*row, False) for row in (NOTICES if extra is None else extra)]
    return [Notice(label, tuple(text.split()), tuple(key.split()), base) for label, text, key, base in rows]


def weights(known: list[Notice]) -> dict[str, float]:
    """Inverse notice frequency of every word."""
    uses = Counter(word for notice in known for word in set(notice.words))
    return {word: math.log(1 + len(known) / n) for word, n in uses.items()}


def index_words(notice: Notice, weight: dict[str, float]) -> list[tuple[str, int]]:
    """The rarest words of the key phrase with their offsets in it."""
    ranked = sorted(enumerate(notice.key), key=lambda at: (-weight[at[1]], at[0]))
    return [(word, offset) for offset, word in ranked[:INDEX_WORDS]]


@dataclass(frozen=True)
class Licence:
    label: str
    unless: str  # the label of a licence that takes its place
    parts: tuple[int, ...]  # numbers of its passages


def plain_words(text: str) -> tuple[str, ...]:
    return tuple(word for word in re.split(SEPARATOR, text.lower()) if word)


def licence_texts(texts: list | None = None) -> tuple[list[Licence], list[Notice]]:
    """Licences, and the distinct passages that they consist of."""
    passages: dict[tuple, Notice] = {}
    numbers: dict[tuple, int] = {}
    licences = []
    for label, unless, parts in TEXTS if texts is None else texts:
        own = [(plain_words(text), tuple(key.split())) for text, key in parts]
        for words, key in own:
            numbers.setdefault((words, key), len(numbers))
            passages.setdefault((words, key), Notice(label, words, key, False))
        licences.append(Licence(label, unless or "", tuple(numbers[part] for part in own)))
    return licences, list(passages.values())


def passage_words(passage: Notice, weight: dict[str, float]) -> list[tuple[str, int]]:
    """The rarest words of a passage with their offsets in it."""
    ranked = sorted(enumerate(passage.words), key=lambda at: (-weight[at[1]], at[0]))
    return [(word, offset) for offset, word in ranked[:PASSAGE_WORDS]]


def literal(value: object) -> str:
    """A constant in SQL; words hold no quotes."""
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(map(literal, value))})"
    if isinstance(value, dict):
        fields = (f"'{name}', {literal(own)}" for name, own in value.items())
        return f"named_struct({', '.join(fields)})"
    if isinstance(value, float):
        return f"{value!r}D"
    return f"'{value}'" if isinstance(value, str) else str(value).lower()


class Index:
    """Templates by number, notices before passages, and the positions of their rarest words."""

    def __init__(self, known: list[Notice], passages: list[Notice]):
        self.templates = [*known, *passages]
        weight, passage_weight = weights(known), weights(passages)
        self.weights = [
            [(weight if t < len(known) else passage_weight)[word] for word in template.words]
            for t, template in enumerate(self.templates)
        ]
        self.postings: dict[str, list[dict[str, int]]] = {}
        self.votes = []
        for t, template in enumerate(self.templates):
            if t < len(known):
                own = [(word, template.key_at + at) for word, at in index_words(template, weight)]
                self.votes.append(len(own))
            else:
                own = passage_words(template, passage_weight)
                self.votes.append(min(len(own), PASSAGE_VOTES))
            for word, at in own:
                self.postings.setdefault(word, []).append({"t": t, "p": at})

    def of_each(self, values: list) -> Column:
        return F.expr(literal(values))

    def hits(self, words: Column) -> Column:
        """The words that are in the index, with their places."""
        listed = list(self.postings)
        hit = F.transform(
            words, lambda word, at: F.when(word.isin(listed), F.struct(word.alias("word"), at.alias("at")))
        )
        return F.filter(hit, lambda x: x.isNotNull())

    def agreed(self, hits: Column) -> Column:
        """Array of (t, s): where a template would begin, by enough of its words."""
        pairs = ", ".join(f"{literal(word)}, {literal(own)}" for word, own in self.postings.items())
        postings = F.expr(f"map({pairs})")
        begun = F.transform(
            hits,
            lambda hit: F.transform(
                F.element_at(postings, hit["word"]),
                lambda entry: F.struct(entry["t"].alias("t"), (hit["at"] - entry["p"]).alias("s")),
            ),
        )
        needed = self.of_each(self.votes)

        def enough(votes: Column) -> Column:
            return F.filter(
                votes,
                lambda vote, i: (F.get(votes, i + F.get(needed, vote["t"]) - 1) == vote)
                & ((i == 0) | (F.get(votes, i - 1) != vote)),
            )

        # Bound to a name by a transform over one element, and so sorted once.
        return F.transform(F.array(F.array_sort(F.flatten(begun))), enough)[0]

    def found(self, words: Column, hits: Column) -> Column:
        """Array of (t, start of the key phrase, aligned weight), key phrases verified."""
        key_at = self.of_each([t.key_at for t in self.templates])
        keys = self.of_each([t.key for t in self.templates])
        texts = self.of_each([t.words for t in self.templates])
        weight = self.of_each(self.weights)

        def stands(vote: Column) -> Column:
            start, key = vote["s"] + F.get(key_at, vote["t"]), F.get(keys, vote["t"])
            return (start >= 0) & (F.slice(words, F.greatest(start, F.lit(0)) + 1, F.size(key)) == key)

        def aligned(vote: Column) -> Column:
            each = F.transform(
                F.get(texts, vote["t"]),
                lambda word, j: F.when(
                    F.get(words, vote["s"] + j) == word, F.get(F.get(weight, vote["t"]), j)
                ).otherwise(0.0),
            )
            return F.aggregate(each, F.lit(0.0), lambda total, x: total + x)

        return F.transform(
            F.filter(self.agreed(hits), stands),
            lambda vote: F.struct(
                vote["t"].alias("t"),
                (vote["s"] + F.get(key_at, vote["t"])).cast("long").alias("start"),
                aligned(vote).alias("aligned"),
            ),
        )

    def places(self, found: Column, notices: int) -> Column:
        """Places of the notices, as PLACE."""
        labels = self.of_each([t.label for t in self.templates])
        base = self.of_each([t.base for t in self.templates])
        length = self.of_each([len(t.key) for t in self.templates])
        total = self.of_each([float(sum(w)) for w in self.weights])
        return F.transform(
            F.filter(found, lambda place: place["t"] < notices),
            lambda place: F.struct(
                F.get(labels, place["t"]).alias("label"),
                F.get(base, place["t"]).alias("base"),
                place["start"].alias("start"),
                F.get(length, place["t"]).alias("words"),
                F.least(place["aligned"] / F.get(total, place["t"]), F.lit(1.0)).alias("score"),
            ),
        )

    def texts(self, found: Column, licences: list[Licence], notices: int) -> Column:
        """Licence texts of which every passage was found, as TEXT."""
        every = self.of_each(
            [
                {
                    "label": one.label,
                    "unless": one.unless,
                    "parts": [notices + part for part in one.parts],
                    "total": float(sum(sum(self.weights[notices + part]) for part in one.parts)),
                }
                for one in licences
            ]
        )
        there = F.transform(found, lambda place: place["t"])
        whole = F.filter(every, lambda one: F.size(F.array_except(one["parts"], there)) == 0)

        def share(one: Column) -> Column:
            best = F.transform(
                one["parts"],
                lambda part: F.array_max(
                    F.transform(F.filter(found, lambda place: place["t"] == part), lambda place: place["aligned"])
                ),
            )
            return F.least(F.aggregate(best, F.lit(0.0), lambda total, x: total + x) / one["total"], F.lit(1.0))

        def kept(whole: Column) -> Column:
            labels = F.transform(whole, lambda one: one["label"])
            last = F.filter(whole, lambda one: ~F.array_contains(labels, one["unless"]))
            return F.transform(last, lambda one: F.struct(one["label"].alias("label"), share(one).alias("score")))

        return F.transform(F.array(whole), kept)[0]


PLACE = "array<struct<label:string,base:boolean,start:bigint,words:int,score:double>>"
TEXT = "array<struct<label:string,score:double>>"


def license_places(
    docs: DataFrame,
    extra: list[tuple[str, str, str]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: list | None = None,
) -> DataFrame:
    """(doc_id, n_words, places, texts) of every row.

    places lists each key phrase of a notice found, base phrases included; texts lists each
    licence all of whose passages are found, with the aligned share of its weight.
    A null text counts as empty and has no words. A phrase that occurs n times gives
    n places. Repeated rows and missing ids are passed on; other columns are ignored.
    """
    known = notices(extra)
    licences, passages = licence_texts(texts)
    index = Index(known, passages)
    rows = inputs(docs, doc_id=id_col, text=text_col)
    rows = rows.select(
        "doc_id", F.array_remove(F.split(ascii_lower(F.col("text")), SEPARATOR), "").alias("words")
    )
    rows = rows.withColumn("hits", index.hits(F.col("words")))
    any_hit = F.size("hits") > 0
    rows = rows.withColumn("found", F.when(any_hit, index.found(F.col("words"), F.col("hits"))))
    any_found = F.size("found") > 0
    places = index.places(F.col("found"), len(known))
    of_texts = index.texts(F.col("found"), licences, len(known)) if licences else F.array().cast(TEXT)
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(any_found, places).otherwise(F.array().cast(PLACE)).alias("places"),
        F.when(any_found, of_texts).otherwise(F.array().cast(TEXT)).alias("texts"),
    )


def license_summary(found: DataFrame) -> DataFrame:
    """One row per document: counts and span of the base phrases, labels, and the best score."""
    base = F.filter("places", lambda p: p["base"])

    def labels(*of: Column) -> Column:
        names = F.concat(*(F.transform(one, lambda p: p["label"]) for one in of))
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    return found.withColumn("found_base", base).select(
        "doc_id",
        "n_words",
        F.size("found_base").cast("long").alias("n_base"),
        F.array_min("found_base.start").alias("first_word"),
        F.array_max("found_base.start").alias("last_word"),
        labels(F.col("found_base")).alias("base_labels"),
        labels(F.col("places"), F.col("texts")).alias("labels"),
        F.coalesce(
            F.greatest(F.array_max("places.score"), F.array_max("texts.score")), F.lit(0.0)
        ).alias("score"),
    )
