"""License scans (operator 11), in DataFrame functions alone.

Licence texts and notices are templates in a positional index: word -> (template,
place). How many documents hold each licence word is counted over all documents.
Of every template, a file's highest-IDF words (``RARE`` of those it holds) are
looked up: each occurrence at a place p and posting at a place q votes for the
template at p - q. Places on which ``VOTES`` rare occurrences agree are candidates;
there the template's mandatory key phrases must stand word for word, in notices
exactly in place, in longer texts within ``SLACK`` words of it, so that edited
copies are found as well. The base phrases are templates whose key phrase is the
whole phrase. A match's score is the share of the template's words that stand in
place.

A template is looked at only if the file holds all words of its key phrases, which
loses nothing. Each text is worked on in its own row, whole: the only shuffle is
the count of the licence words, summed per task first, and only those counts (one
per word of the index) go to the driver. Work and memory are linear in the text.

Defined cases: a null or empty text has no words and no labels; a null id is kept;
repeated rows are scanned each for itself; an empty table gives an empty result;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

#: Rare words of a template that are looked up in a file, occurrences that must agree, words a key phrase may be off.
RARE, VOTES, SLACK = 5, 2, 2

# Base phrases, by label.
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}

# Licence texts (their opening words) and notices, with their mandatory key phrases.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies",
     ["with or without fee is hereby granted"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met", ["redistribution and use in source and binary forms"]),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
                 "with the License", ["not use this file except in compliance"]),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation, either version 3 of the License",
     ["gnu general public license", "version 3"]),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation; either version 2 of the License",
     ["gnu general public license", "version 2"]),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation", ["gnu lesser general public license"]),
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
               "version 3 of the License", ["gnu affero general public license", "version 3"]),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ["mozilla public license v 2"]),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
     ["eclipse public license 2"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["unencumbered software released into the public domain"]),
    ("mit", "under the terms of the MIT license", ["mit license"]),
    ("gpl-3", "licensed under the GNU General Public License, version 3", ["gnu general public license version 3"]),
    ("gpl-2", "licensed under the GNU General Public License, version 2", ["gnu general public license version 2"]),
    ("cc0", "CC0 1.0 Universal public domain dedication", ["cc0 1 0"]),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License",
     ["creative commons attribution 4 0"]),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
     ["creative commons attribution sharealike"]),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ["creative commons attribution noncommercial"]),
]

#: What separates words, by code point; upper-case letters are lower-cased before.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
_TRIMMED = "".join(chr(c) for c in range(128) if not re.match("[0-9a-z]", chr(c)))


def words_in(text: str) -> list[str]:
    return re.findall(f"[^{SEPARATORS}]+", text.lower())


class Template:
    """A template's words, its key phrases with their places, and how far these may be off."""

    def __init__(self, label: str, text: str, keys: list[str], base: bool = False):
        self.label, self.words, self.base = label, words_in(text), base
        self.keys = []
        for key in map(words_in, keys):
            n = len(key)
            self.keys.append((next(q for q in range(len(self.words)) if self.words[q:q + n] == key), key))
        self.key_words = sorted({w for _, key in self.keys for w in key})
        # a notice is short: its key phrases stand exactly in place
        self.slack = 0 if base or len(self.words) <= 12 else SLACK


INDEX = ([Template(label, phrase, [phrase], True) for label, phrase in BASE.items()]
         + [Template(*t) for t in TEMPLATES])
VOCABULARY = sorted({w for t in INDEX for w in t.words})


def _strings(xs: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in xs])


def with_words(df: DataFrame) -> DataFrame:
    """(doc_id, words, n_words) of (doc_id, text)."""
    # the Kelvin sign is no ASCII letter, but its lower case is one
    low = F.lower(F.replace(F.col("text"), F.lit("K"), F.lit("ø")))
    trimmed = F.btrim(low, F.lit(_TRIMMED))
    return (df.select("doc_id", trimmed.alias("_t"))
            .select("doc_id", F.split("_t", f"[{SEPARATORS}]+").alias("words"), (F.col("_t") == "").alias("_none"))
            .select("doc_id", "words", F.when(F.col("_none"), 0).otherwise(F.size("words")).cast("long").alias("n_words")))


def document_frequency(words: DataFrame) -> dict[str, int]:
    """Documents that hold each word of the index: one number per word of a fixed list."""
    held = words.select(F.explode(F.array_intersect("words", _strings(VOCABULARY))).alias("w"))
    found = {r.w: r["count"] for r in held.groupBy("w").count().collect()}
    return {w: found.get(w, 0) for w in VOCABULARY}


def _index(df: dict[str, int]) -> Column:
    """The templates as one constant; ``by_idf`` lists a template's words, rarest first."""
    def one(t: Template) -> Column:
        by_idf = sorted(set(t.words), key=lambda w: (df[w], w))
        return F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), _strings(t.words).alias("words"),
            _strings(by_idf).alias("by_idf"), _strings(t.key_words).alias("key_words"),
            F.array(*[F.struct(F.lit(w).alias("w"), F.lit(q).alias("q")) for q, w in enumerate(t.words)]).alias("postings"),
            F.array(*[F.struct(F.lit(q).alias("q"), _strings(key).alias("words")) for q, key in t.keys]).alias("keys"),
            F.array(*[F.lit(d) for d in range(-t.slack, t.slack + 1)]).alias("slack"))
    return F.array(*[one(t) for t in INDEX])


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def license_matches(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and ``found``: label, base, places (of the first word, from 0) and score of every template found."""
    split = with_words(documents(df, id_col, text_col))
    index = _index(document_frequency(split))
    held = split.withColumn("hits", F.array_intersect("words", _strings(VOCABULARY)))
    words = F.col("words")

    def candidates(t: Column) -> Column:
        rare = F.slice(F.array_intersect(t.by_idf, F.col("hits")), 1, RARE)
        at = _let(rare, lambda r: F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(r, words[i])))
        votes = F.flatten(F.transform(at, lambda i: F.transform(
            F.filter(t.postings, lambda p: p.w == words[i]), lambda p: i - p.q)))
        # sorted, equal votes are neighbours: a place has enough if the vote VOTES - 1 further is the same
        return _let(F.sort_array(votes), lambda v: F.array_distinct(
            F.filter(v, lambda o, k: F.coalesce(F.get(v, k + (VOTES - 1)) == o, F.lit(False)))))

    def verified(t: Column, o: Column) -> Column:
        def stands(q: Column, key: Column) -> Column:
            return F.when(q >= 0, F.slice(words, F.greatest(q, F.lit(0)) + 1, F.size(key)) == key).otherwise(F.lit(False))
        return F.forall(t["keys"], lambda k: F.exists(t.slack, lambda d: stands(o + k.q + d, k.words)))

    def share(t: Column, o: Column) -> Column:
        same = F.filter(t.postings, lambda p: F.coalesce(F.get(words, o + p.q) == p.w, F.lit(False)))
        return F.size(same) / F.size(t.words)

    def match(t: Column) -> Column:
        places = F.filter(candidates(t), lambda o: verified(t, o))
        return _let(places, lambda at: F.struct(
            t.label.alias("label"), t.base.alias("base"), at.alias("places"),
            F.array_max(F.transform(at, lambda o: share(t, o))).alias("score")))

    possible = F.filter(index, lambda t: F.size(F.array_intersect(t.key_words, F.col("hits"))) == F.size(t.key_words))
    found = F.filter(F.transform(possible, match), lambda m: F.size(m.places) > 0)
    return held.select("doc_id", "n_words", found.alias("found"))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: words, base places and their ends, labels, the best score."""
    base = F.filter("found", lambda m: m.base)
    places = F.flatten(F.transform(base, lambda m: m.places))

    def labels(found) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m.label))), ",")
    return license_matches(df, id_col, text_col).select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"), labels(base).alias("base_labels"), labels("found").alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda m: m.score)), F.lit(0.0)).alias("score"))


def _list(xs: list[str]) -> str:
    return "[" + ",".join(f"'{x}'" for x in xs) + "]"


#: The same rows for DuckDB.
SQL = f"""
WITH tpl(t, label, base, words, n_keys, slack) AS (VALUES {','.join(
    f"({k},'{t.label}',{t.base},{_list(t.words)},{len(t.keys)},{t.slack})" for k, t in enumerate(INDEX))}),
keys(t, k, q, words) AS (VALUES {','.join(
    f"({k},{j},{q},{_list(key)})" for k, t in enumerate(INDEX) for j, (q, key) in enumerate(t.keys))}),
post AS (SELECT t, unnest(words) AS w, unnest(range(len(words))) AS q FROM tpl),
d AS (SELECT row_number() OVER () AS r, doc_id,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^{SEPARATORS}]+') AS ws FROM documents),
occ AS (SELECT r, p, w FROM (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM d)
        WHERE w IN (SELECT w FROM post)),
df AS (SELECT w, count(DISTINCT r) AS df FROM occ GROUP BY w),
rare AS (SELECT r, t, w FROM (
           SELECT r, t, h.w, row_number() OVER (PARTITION BY r, t ORDER BY df, h.w) AS k
           FROM (SELECT DISTINCT r, w FROM occ) h JOIN (SELECT DISTINCT t, w FROM post) p ON h.w = p.w JOIN df ON df.w = h.w)
         WHERE k <= {RARE}),
cand AS (SELECT occ.r, rare.t, p - q AS o FROM rare JOIN occ ON occ.r = rare.r AND occ.w = rare.w
         JOIN post ON post.t = rare.t AND post.w = rare.w GROUP BY occ.r, rare.t, p - q HAVING count(*) >= {VOTES}),
ok AS (SELECT cand.r, cand.t, cand.o FROM cand JOIN keys ON keys.t = cand.t JOIN tpl ON tpl.t = cand.t JOIN d ON d.r = cand.r
       WHERE len(list_filter(range(-slack, slack + 1), lambda s: o + q + s >= 0
             AND ws[o + q + s + 1 : o + q + s + len(keys.words)] = keys.words)) > 0
       GROUP BY cand.r, cand.t, cand.o, n_keys HAVING count(*) = n_keys),
m AS (SELECT ok.r, label, base, o, len(list_filter(range(len(words)), lambda j: o + j >= 0 AND coalesce(ws[o + j + 1] = words[j + 1], false)))
      / len(words) AS score FROM ok JOIN tpl ON tpl.t = ok.t JOIN d ON d.r = ok.r)
SELECT doc_id, len(ws) AS n_words, count(o) FILTER (base) AS n_base, min(o) FILTER (base) AS first_word,
       max(o) FILTER (base) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(score), 0.0) AS score
FROM d LEFT JOIN m ON d.r = m.r GROUP BY d.r, doc_id, ws
"""
