"""Licence scans by a positional rare-token index.

Templates of licence lines are indexed by word: word -> (template, position). Each
template posts the words of its mandatory key phrase of highest inverse document
frequency (taken over all files). A file looks up each of its licence words once and
turns every posting into (template, relative position: place in the file less place
in the template); pairs with all the votes that their template needs are places where
its key phrase is then checked word for word. As it holds the posted words itself, no
place of it is missed, whatever else the file holds.

Index, phrases and lines are literals of one expression each, whatever the number of
templates. Everything after the one count of document frequencies happens within a
row: no shuffle of files, so no group can become hot. The counts have one row per word
of the templates, so what reaches the driver is bounded by the templates.

Defined results: a null or empty text has no words, null places, empty labels and
score 0. Repeated rows get equal results; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import table, text_of

#: What separates words; the base phrases and their labels.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Fixed values: (label, line, mandatory key phrase within the line); several lines may have one label.
TEMPLATES = (
    ("agpl-3.0", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "use this file except in compliance with the license"),
    ("artistic-2.0", "distributed under the terms of the artistic license 2 0", "artistic license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "contributors may be used to endorse or promote products"),
    ("bsl-1.0", "distributed under the boost software license version 1 0", "boost software license version 1 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international license", "attribution sharealike 4 0 international"),
    ("cc0-1.0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", "eclipse public license 2 0"),
    ("gpl-2.0", "the gnu general public license as published by the free software foundation either version 2 of the license", "free software foundation either version 2 of the license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-3.0", "the gnu general public license as published by the free software foundation either version 3 of the license", "free software foundation either version 3 of the license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "must not be misrepresented as being the original software"),
)
#: Words that any prose has; they are no licence words.
COMMON = frozenset("a and any are by for in into is it no of on or the this to use was with without 0 2 3 4".split())
#: How many words of a key phrase vote, the rarest ones; a place needs the votes of all.
VOTES = 2


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BREAK), "")


def licence_words(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, line, _ in templates for w in line.split()} - COMMON)


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Over all documents: their number, and how many hold each licence word."""
    found = docs.select(F.array_intersect(words_of(text_of(text_col)), F.array(*map(F.lit, vocabulary))).alias("w"))
    rows = found.agg(F.count("*").alias("n"), *(F.count_if(F.array_contains("w", w)).alias(f"c{i}") for i, w in enumerate(vocabulary))).first()
    return rows["n"], {w: rows[f"c{i}"] for i, w in enumerate(vocabulary)}


def _phrase_at(words: str, at: str, phrase: list[str]) -> str:
    return " AND ".join(f"get({words}, {at} + {k}) <=> '{w}'" for k, w in enumerate(phrase))


def _shift(line: list[str], key: list[str]) -> int:
    return next(i for i in range(len(line)) if line[i : i + len(key)] == key)


def _posted(line: list[str], key: list[str], idf: dict[str, float]) -> dict[int, str]:
    """Place in the line -> word, of the VOTES rarest words of its key phrase (any words where it has no licence word)."""
    at = {i + _shift(line, key): w for i, w in enumerate(key)}
    return dict(sorted(((i, w) for i, w in at.items() if w in idf), key=lambda x: (-idf[x[1]], x))[:VOTES]) or dict(list(at.items())[:VOTES])


def _strings(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _ints(values) -> str:
    return "array(" + ", ".join(map(str, values)) + ")"


def index_of(templates, idf: dict[str, float]) -> tuple[dict[str, list[tuple[int, int]]], list[int]]:
    """The postings, word -> (template, position), and the votes that each template needs."""
    postings: dict[str, list[tuple[int, int]]] = {}
    needed = []
    for k, (_, line, key) in enumerate(templates):
        posted = _posted(line.split(), key.split(), idf)
        needed.append(len(posted))
        for at, w in posted.items():
            postings.setdefault(w, []).append((k, at))
    return postings, needed


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    vocabulary = licence_words(templates)
    total, counts = document_frequencies(docs, text_col, vocabulary)
    idf = {w: math.log((total + 1) / (counts[w] + 1)) for w in vocabulary}
    postings, needed = index_of(templates, idf)
    lines, keys = [line.split() for _, line, _ in templates], [key.split() for _, _, key in templates]
    sep = BREAK.replace("\\", "\\\\")
    base_any = "|".join(p.replace(" ", sep) for p, _ in BASE)

    rows = docs.select(F.col(id_col), words_of(text_of(text_col)).alias("w"), F.expr(f"coalesce(cast(`{text_col}` AS string), '') RLIKE '(?i)(?:{base_any})'").alias("may"))
    #: Places of the base phrases, only where the text may have one.
    for k, (phrase, _) in enumerate(BASE):
        p = phrase.split()
        rows = rows.withColumn(f"b{k}", F.expr(f"CASE WHEN may THEN filter(sequence(0, size(w)), i -> {_phrase_at('w', 'i', p)}) ELSE array() END"))
    #: One look-up for each licence word of the file: the template and the relative position of its postings.
    rare = ", ".join(f"'{w}'" for w in sorted(postings))
    listed = ", ".join("array(" + ", ".join(f"named_struct('t', {t}, 'p', {p})" for t, p in postings[w]) + ")" for w in sorted(postings))
    index = f"map_from_arrays({_strings(sorted(postings))}, array({listed}))"
    hits = f"filter(transform(w, (x, i) -> struct(x AS x, i AS i)), h -> h.x IN ({rare}))"
    rows = rows.withColumn("votes", F.expr(f"sort_array(flatten(transform({hits}, h -> transform(try_element_at({index}, h.x), q -> struct(q.t AS t, h.i - q.p AS r)))))"))
    #: Runs of equal pairs; a pair is kept once, where its run reaches the votes that its template needs, if the key phrase stands there.
    need = f"get({_ints(needed)}, v.t)"
    reached = f"get(votes, i - {need} + 1) <=> v AND NOT (get(votes, i - {need}) <=> v)"
    phrases, shifts = "array(" + ", ".join(map(_strings, keys)) + ")", _ints(_shift(line, key) for line, key in zip(lines, keys))
    phrase = f"v.r + get({shifts}, v.t) >= 0 AND slice(w, v.r + get({shifts}, v.t) + 1, size(get({phrases}, v.t))) = get({phrases}, v.t)"
    rows = rows.withColumn("places", F.expr(f"filter(votes, (v, i) -> {reached} AND {phrase})"))
    #: The share of the line that stands around a place.
    whole = "array(" + ", ".join(map(_strings, lines)) + ")"
    share = f"size(filter(transform(get({whole}, v.t), (x, j) -> get(w, v.r + j) <=> x), ok -> ok)) / double(size(get({whole}, v.t)))"
    rows = rows.withColumn("best", F.expr(f"coalesce(array_max(transform(places, v -> {share})), 0D)"))
    own = F.expr(f"transform(places, v -> get({_strings(label for label, _, _ in templates)}, v.t))")

    base = F.array_compact(F.array(*(F.when(F.size(f"b{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE))))
    places = [f"b{k}" for k in range(len(BASE))]
    return rows.select(
        id_col,
        F.size("w").cast("long").alias("n_words"),
        sum((F.size(b) for b in places[1:]), F.size(places[0])).cast("long").alias("n_base"),
        F.least(*(F.array_min(b) for b in places)).cast("long").alias("first_word"),
        F.greatest(*(F.array_max(b) for b in places)).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.greatest(F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.lit(0.0)), "best").alias("score"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
