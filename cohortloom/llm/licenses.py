"""License scans by a positional index of rare words, with DataFrame functions alone.

A text is cut into words. Document frequencies of all words of the known notices, over
the whole table, give their inverse document frequency (IDF). The index holds each
notice's rarest words with their places in it. A document's words that the index holds,
its rarest license words, are looked up; a posting turns each place into a start of its
notice, and starts on which at least two rare words of a notice agree are candidates.
A candidate is scored by the IDF share of the notice's words that stand at their
relative place, give or take `SLACK` words, and accepted if its mandatory key phrases
stand in that stretch of the text.

Plain phrases are notices of which every word is mandatory: their rarest word finds
every place where it could stand, and all other words are verified there, so each place
is found. No step shuffles text; only word counts of the notices are aggregated.

Defined cases: a null or empty text has no words, no label and score 0. Rows with equal
or null ids are kept as rows of their own. A stretch that reaches beyond the text counts
the words inside. An empty table gives no rows. Columns other than id and text are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import text_of

# What counts as between words, and the plain phrases with their labels.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Public license notices as words, each with the phrases that it must hold.
NOTICES = (
    ("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license",)),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
     ("apache license", "except in compliance with the license")),
    ("boost-1", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("bsd-2", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms",)),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
     ("neither the name", "to endorse or promote products")),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
     ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
     ("creative commons attribution sharealike",)),
    ("cc0", "dedicated to the public domain under the creative commons cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    ("epl-2", "made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    ("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("with or without fee is hereby granted",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     ("permission is hereby granted", "free of charge")),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

KEYS = 3  # rare words of a notice that the index holds
AGREE = 2  # of them have to agree on a start
SLACK = 2  # words by which a word may be out of place
ACCEPTED = 0.6  # IDF share from which a candidate counts


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased.

    `lower` also turns other letters into lower case, which neither cuts words nor makes
    them equal to words of plain letters, but for the Kelvin sign, so that is replaced first.
    """
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138"))), BETWEEN, -1), "")


@dataclass(frozen=True)
class Notice:
    label: str
    words: tuple[str, ...]
    weights: tuple[float, ...]
    keys: tuple[tuple[str, int], ...]
    """Rarest words and their first places, rarest first."""
    phrases: tuple[str, ...]


def document_frequencies(words: DataFrame, vocabulary: set[str]) -> tuple[int, dict[str, int]]:
    """Rows, and rows that hold each word of the vocabulary; as many rows as that has words reach the driver."""
    wanted = F.array(*[F.lit(w) for w in sorted(vocabulary)])
    held = words.select(F.explode(F.concat(F.array_intersect("words", wanted), F.array(F.lit("")))).alias("word"))
    found = {row.word: row["count"] for row in held.groupBy("word").count().collect()}
    return found.get("", 0), found


def weighed(label: str, text: str, phrases: tuple[str, ...], idf: dict[str, float], keys: int) -> Notice:
    words = tuple(text.split())
    total = sum(idf[w] for w in words)
    rare = sorted(set(words), key=lambda w: (-idf[w], w))[:keys]
    return Notice(label, words, tuple(idf[w] / total for w in words), tuple((w, words.index(w)) for w in rare), phrases)


def index(words: DataFrame, notices=NOTICES, phrases=PHRASES) -> tuple[list[Notice], list[Notice]]:
    """(notices, plain phrases), weighed by the document frequencies of this table."""
    vocabulary = {w for _, text, _ in notices for w in text.split()} | {w for _, text in phrases for w in text.split()}
    rows, counts = document_frequencies(words, vocabulary)
    idf = {w: math.log((rows + 2) / (counts.get(w, 0) + 1)) for w in vocabulary}
    return (
        [weighed(label, text, must, idf, KEYS) for label, text, must in notices],
        [weighed(label, text, (text,), idf, 1) for label, text in phrases],
    )


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _starts(key: str, place: int) -> str:
    return f"transform(filter(_hits, h -> h.word = '{key}'), h -> h.at - {place})"


def _places(notice: Notice) -> Column:
    """(start, label) of a plain phrase: starts by its rarest word, where every other word stands too."""
    (key, place), *_ = notice.keys
    rest = " AND ".join(f"get(words, s + {i}) <=> '{w}'" for i, w in enumerate(notice.words) if i != place) or "true"
    return F.expr(f"transform(filter({_starts(key, place)}, s -> {rest}), s -> struct(s AS start, '{notice.label}' AS label))")


def _candidates(notice: Notice) -> str:
    """Starts on which `AGREE` rare words agree: those that stand in the sorted list of all starts that often."""
    arrays = ", ".join(_starts(key, place) for key, place in notice.keys)
    hop = min(AGREE, len(notice.keys))
    listed = f"array_sort(concat({arrays}))"
    return f"array_distinct(filter(transform({listed}, (s, i) -> IF(get({listed}, i + {hop - 1}) <=> s, s, NULL)), s -> s IS NOT NULL))"


def _matches(notice: Notice) -> Column:
    """(label, start, length, score) of accepted candidates of a notice."""
    length = len(notice.words)
    share = " + ".join(
        f"IF(array_contains(slice(words, greatest(s + {i - SLACK} + 1, 1), greatest({2 * SLACK + 1} + least(s + {i - SLACK}, 0), 0)), '{w}'), {weight!r}D, 0D)"
        for i, (w, weight) in enumerate(zip(notice.words, notice.weights, strict=True))
    )
    stretch = f"concat(' ', array_join(slice(words, greatest(s - {SLACK} + 1, 1), greatest({length + 2 * SLACK} + least(s - {SLACK}, 0), 0)), ' '), ' ')"
    verified = " AND ".join(f"contains({stretch}, ' {phrase} ')" for phrase in notice.phrases)
    scored = f"transform(filter({_candidates(notice)}, s -> {verified}), s -> struct('{notice.label}' AS label, s AS start, {length} AS length, least(1D, {share}) AS score))"
    return F.expr(f"filter({scored}, m -> m.score >= {ACCEPTED})")


def scan(docs: DataFrame, notices=NOTICES, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, places, matches) of every document.

    `places` are (start, label) of the plain phrases in the order of the text, `matches`
    (label, start, length, score) of the notices; starts and lengths are in words.
    """
    words = docs.select(F.col(f"`{id_col}`").alias("id"), words_of(text_of(f"`{text_col}`")).alias("words"))
    known, plain = index(words, notices, phrases)
    keys = _quoted(sorted({key for notice in (*known, *plain) for key, _ in notice.keys}))
    hits = F.expr(f"filter(transform(words, (w, i) -> IF(w IN ({keys}), struct(w AS word, i AS at), NULL)), h -> h IS NOT NULL)")
    found = words.withColumn("_hits", hits)
    places = F.concat(*[_places(n) for n in plain])
    matches = F.concat(*[_matches(n) for n in known])
    # Without a rare word there is nothing to look up.
    none = F.size("_hits") == 0
    return found.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.when(none, F.array().cast("array<struct<start:int,label:string>>")).otherwise(F.array_sort(places)).alias("places"),
        F.when(none, F.array().cast("array<struct<label:string,start:int,length:int,score:double>>")).otherwise(matches).alias("matches"),
    )


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: number and range of the plain phrases' places, labels of theirs and of all, best score."""
    base = F.array_distinct("places.label")
    any_base = F.size("places") > 0
    best = F.coalesce(F.array_max("matches.score"), F.lit(0.0))
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").cast("long").alias("first_word"),
        F.array_max("places.start").cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, "matches.label")), ",").alias("labels"),
        F.when(any_base, 1.0).otherwise(best).alias("score"),
    )
