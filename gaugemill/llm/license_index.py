"""Licence scan with a positional index of rare licence words.

1. One pass splits every text into words and keeps which words of the licence
   vocabulary it holds.  Only texts that hold all words of some key phrase keep their
   words for the later steps: without them no phrase can be verified.
2. The vocabulary is ordered by inverse document frequency, counted over all documents.
3. Of each template whose key words a file holds, the MIN_VOTES rarest words of the key
   phrase are looked up in the file.  Postings are intersected by relative position: an
   occurrence at word i of a word that stands at t in a template votes for the template
   starting at i - t.
4. Starts with MIN_VOTES votes are verified: the template's key phrase must stand, word by
   word, where the start puts it.  Wherever it stands, all its words vote for that start,
   so no key phrase is missed.

Base labels come from their phrases alone and stay whatever the index says.  All of it
is built-in column functions; the vocabulary and the templates are literals.

Defined results: a null text is empty; without words or phrases all counts are 0,
positions are null and labels are empty; repeated rows are returned as often as they
come; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.llm.common import materialize

MIN_VOTES = 2

# Base phrases and the labels they give.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of public licence notices, as words; the key phrase must stand.
NOTICES = [
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files the software to deal in the software "
            "without restriction", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain "
                 "a copy of the license at http www apache org licenses license 2 0",
     "apache org licenses license 2"),
    ("gpl-2", "licensed under the gnu general public license version 2",
     "gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("gpl-3", "gnu general public license as published by the free software foundation either "
              "version 3 of the license", "either version 3 of the license"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3",
     "gnu lesser general public license version 3"),
    ("agpl-3", "licensed under the gnu affero general public license version 3",
     "gnu affero general public license"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are "
              "permitted provided that the following conditions are met",
     "redistribution and use in source and binary forms"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license v 2"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial", "commons attribution noncommercial"),
    ("cc0", "dedicated to the public domain under cc0 1 0", "public domain under cc0"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    key_at: int


def templates(notices: list[tuple[str, str, str]] | None = None) -> list[Template]:
    out = []
    for n, (label, text, phrase) in enumerate(notices or NOTICES):
        words, key = tuple(text.split()), tuple(phrase.split())
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        out.append(Template(n, label, words, key, at))
    return out


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _holds(present: Column, words) -> Column:
    return F.size(F.array_except(_strings(sorted(set(words))), present)) == 0


def ascii_words(text: Column) -> Column:
    """Words of digits, letters and code points beyond ASCII, with A-Z in lower case."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def word_table(docs: DataFrame, known: list[Template]) -> DataFrame:
    """(doc_id, n_words, present, words): the licence words a text holds; its words only if a key phrase may stand."""
    vocabulary = sorted({w for t in known for w in t.words} | {w for p in BASE for w in p.split()})
    keys = {t.key for t in known} | {tuple(p.split()) for p in BASE}
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        ascii_words(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"),
    )
    held = split.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"),
        F.array_intersect(_strings(vocabulary), F.col("words")).alias("present"),
    )
    may = None
    for key in sorted(keys):
        one = _holds(F.col("present"), key)
        may = one if may is None else may | one
    return held.select(
        "doc_id", "n_words", "present", F.when(may, F.col("words")).alias("words")
    )


def vocabulary_by_rarity(held: DataFrame, known: list[Template]) -> list[str]:
    """Licence words, rarest first, by the documents that hold them; one row per word is collected."""
    counts = {
        r[0]: r[1]
        for r in held.select(F.explode("present").alias("word")).groupBy("word").count().collect()
    }
    return sorted({w for t in known for w in t.words}, key=lambda w: (counts.get(w, 0), w))


def _starts(words: Column, phrase: tuple[str, ...]) -> Column:
    """Positions at which a phrase's words stand consecutively."""
    last = F.size(words) - len(phrase)
    at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(at, lambda i: _stands(words, i, phrase))


def _stands(words: Column, at: Column, phrase: tuple[str, ...]) -> Column:
    same = None
    for k, word in enumerate(phrase):
        one = (F.get(words, at + k) == word).eqNullSafe(F.lit(True))
        same = one if same is None else same & one
    return same


def _postings(present: Column, known: list[Template], rarity: list[str]) -> Column:
    """(word, template, at): MIN_VOTES places of each key phrase whose words are all present, rarest words first."""
    none = F.array().cast("array<struct<word:string,template:int,at:int>>")
    found = []
    for t in known:
        places = sorted(range(len(t.key)), key=lambda k: rarity.index(t.key[k]))
        # A key phrase of fewer words votes repeatedly.
        places = (places * MIN_VOTES)[:MIN_VOTES]
        one = F.array(*[
            F.struct(F.lit(t.key[k]).alias("word"), F.lit(t.number).alias("template"),
                     F.lit(t.key_at + k).alias("at"))
            for k in places
        ])
        found.append(F.when(_holds(present, t.key), one).otherwise(none))
    return F.flatten(F.array(*found)) if found else none


def _candidates(words: Column, postings: Column) -> Column:
    """Starts (template, at) for which MIN_VOTES postings stand at the right places."""
    rare = F.transform(postings, lambda p: p["word"])
    found = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("i"))),
        lambda x: F.array_contains(rare, x["word"]),
    )
    votes = F.flatten(F.transform(
        found,
        lambda x: F.transform(
            F.filter(postings, lambda p: p["word"] == x["word"]),
            lambda p: F.struct(p["template"].alias("template"), (x["i"] - p["at"]).alias("at")),
        ),
    ))
    # Sorted votes: the start of a run of MIN_VOTES equal ones is enough.
    return _let(
        F.sort_array(votes),
        lambda s: F.array_distinct(
            F.filter(s, lambda x, i: (F.get(s, i + (MIN_VOTES - 1)) == x).eqNullSafe(F.lit(True)))
        ),
    )


def _verified(words: Column, candidates: Column, known: list[Template]) -> Column:
    """(label, share of the template's words in place) of candidates whose key phrase stands."""

    def judge(c: Column) -> Column:
        out = F.lit(None).cast("struct<label:string,share:double>")
        for t in known:
            in_place = sum(
                (F.when((F.get(words, c["at"] + k) == w) & (c["at"] + k >= 0), 1).otherwise(0)
                 for k, w in enumerate(t.words)),
                F.lit(0),
            )
            here = F.struct(
                F.lit(t.label).alias("label"), (in_place / F.lit(float(len(t.words)))).alias("share")
            )
            out = F.when(
                (c["template"] == t.number) & _stands(words, c["at"] + t.key_at, t.key), here
            ).otherwise(out)
        return out

    return F.filter(F.transform(candidates, judge), lambda x: x.isNotNull())


def scan(docs: DataFrame, notices: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row of ``docs``."""
    known = templates(notices)
    held = materialize(word_table(docs, known), "licences")
    rarity = vocabulary_by_rarity(held, known)
    nowhere = F.array().cast("array<int>")
    words, present = F.col("words"), F.col("present")
    some = words.isNotNull()
    phrases = [tuple(p.split()) for p in BASE]
    places = [
        F.when(some & _holds(present, p), _starts(words, p)).otherwise(nowhere).alias(f"base{n}")
        for n, p in enumerate(phrases)
    ]
    postings = F.when(some, _postings(present, known, rarity))
    found = held.select("doc_id", "n_words", "words", *places, postings.alias("postings"))
    none = F.array().cast("array<struct<label:string,share:double>>")
    verified = F.when(
        some,
        _let(
            F.struct(words.alias("w"), F.col("postings").alias("p")),
            lambda x: _let(
                _candidates(x["w"], x["p"]), lambda c: _verified(x["w"], c, known)
            ),
        ),
    ).otherwise(none)
    found = found.select("doc_id", "n_words", *[f"base{n}" for n in range(len(phrases))],
                         verified.alias("verified"))
    at = [F.col(f"base{n}") for n in range(len(phrases))]
    n_base = sum((F.size(a) for a in at), F.lit(0)).cast("long")
    base_labels = F.array_compact(F.array(*[
        F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(at, BASE.values())
    ]))
    own = F.transform("verified", lambda x: x["label"])
    shares = F.transform("verified", lambda x: x["share"])
    labels = F.array_sort(F.array_distinct(F.concat(base_labels, own)))
    return found.select(
        "doc_id", "n_words",
        n_base.alias("n_base"),
        F.array_min(F.concat(*at)).cast("long").alias("first_word"),
        F.array_max(F.concat(*at)).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce(F.array_max(shares), F.lit(0.0))).alias("score"),
    )
