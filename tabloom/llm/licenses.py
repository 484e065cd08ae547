"""License scans with a positional index of rare words, built-in functions only.

Every licence template is indexed by word and position. A notice holds its template's
key phrases word by word, so wherever the key word of the highest IDF, counted over all
files, stands, the template would start so many words before; all such places of all
templates are tried. A start counts if the template's rare words stand at the same
relative positions and its key phrases word by word.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, lower_ascii, table

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The phrases that always count, wherever their words stand in a row.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def split_words(text: str) -> list[str]:
    """The words of a template as the scan makes them of a file: a caller's may have any characters."""
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(SPLIT, lower) if w]


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # phrases of the text that must stand word by word

    @property
    def words(self) -> list[str]:
        return split_words(self.text)

    def key_words(self) -> list[tuple[int, str]]:
        w, out = self.words, []
        for key in self.keys:
            k = split_words(key)
            at = next(i for i in range(len(w)) if w[i : i + len(k)] == k)
            out += [(at + j, x) for j, x in enumerate(k)]
        return sorted(set(out))

#: Identifiers of licences, as words, and the labels that they stand for.
IDENTIFIERS = {
    "mit": "mit", "apache 2 0": "apache-2", "gpl 2 0": "gpl-2", "gpl 3 0": "gpl-3", "lgpl 2 1": "lgpl-2", "lgpl 3 0": "lgpl-3", "agpl 3 0": "agpl-3", "mpl 2 0": "mpl-2", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd",
    "isc": "isc", "unlicense": "unlicense", "cc0 1 0": "cc0", "cc by 4 0": "cc-by", "cc by sa 4 0": "cc-by-sa", "cc by nc 4 0": "cc-by-nc",
}


def _gnu(label: str, kind: str, version: str) -> Template:
    """The header of a file under one of the GNU licences."""
    key = f"gnu {kind}general public license as published by the free software foundation either version {version} of the license"
    return Template(label, f"you can redistribute it and or modify it under the terms of the {key} or at your option any later version", (key,))


#: Notices by which a text is put under a licence, as words.
TEMPLATES = (
    Template("mit", "released under the mit license", ("under the mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "person obtaining a copy")),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("lgpl-3", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license version 3",)),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license version 3",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "with or without modification")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", ("the software is provided as is without warranty of any kind", "and noninfringement")),
    Template("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties", ("by the copyright holders and contributors as is",)),
    Template("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", ("unless required by applicable law or agreed to in writing",)),
    Template("gpl-3", "the gnu general public license is a free copyleft license for software and other kinds of works", ("general public license is a free copyleft license for software",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    _gnu("gpl-2", "", "2"), _gnu("gpl-3", "", "3"), _gnu("lgpl-2", "lesser ", "2 1"), _gnu("lgpl-3", "lesser ", "3"), _gnu("agpl-3", "affero ", "3"),
    *(Template(label, f"spdx license identifier {name}", (f"spdx license identifier {name}",)) for name, label in IDENTIFIERS.items()),
    *(Template(label, f"{name} {end}", (f"{name} {end}",)) for name, label in IDENTIFIERS.items() if "gpl" in name for end in ("or later", "only")),
    *(Template(label, name, (name,)) for name, label in IDENTIFIERS.items() if name.startswith("cc")),
)

#: So many of a template's words are its rare ones, and so great a share of those must match.
RARE_WORDS, SHARE = 6, 0.6


def scan_words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), SPLIT), lambda w: w != "")


def idf(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, float]:
    """IDF of each licence word over all rows; as many numbers as there are such words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = F.array_distinct(F.filter(scan_words(text), lambda w: w.isin(vocabulary)))
    # words that no file has are counted by the row of an empty string
    seen = {r.w: r["count"] for r in docs.select(F.explode(F.concat(F.array(F.lit("")), known)).alias("w")).groupBy("w").count().collect()}
    n = seen.get("", 0)
    return {w: math.log((n + 1) / (seen.get(w, 0) + 1)) for w in vocabulary}


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence notices in every whole text.

    Returns the id column, n_words, n_base (places of base phrases), first_word and
    last_word (their least and greatest start, else null), base_labels, labels (with
    those of matched templates; both distinct, sorted, comma-joined) and score (1 with a
    base phrase, else the greatest share of a matched template's rare words, else 0).
    A null text is empty: no words, no labels; null ids and repeated rows stay; an empty
    table gives no rows; other columns are ignored. Equal IDFs go by the alphabet.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    weight = idf(docs, vocabulary, text_col)
    by_idf = sorted(vocabulary, key=lambda w: (-weight[w], w))
    rank = {w: i for i, w in enumerate(by_idf)}
    rare = [sorted(((i, w) for i, w in enumerate(t.words)), key=lambda x: (rank[x[1]], x[0]))[:RARE_WORDS] for t in templates]
    # one key word of each template is looked up, as a match has them all; without keys any rare word may be the one that stands
    sought = [sorted(t.key_words(), key=lambda x: (rank[x[1]], x[0]))[:1] or r for t, r in zip(templates, rare)]
    searched = sorted({w for s in sought for _, w in s})
    quoted = lambda x: x.replace("\\", "\\\\").replace("'", "\\'")
    places = lambda at: "array(" + ", ".join(f"struct({i} AS i, '{w}' AS w)" for i, w in at) + ")"
    index = "array(" + ", ".join(f"struct('{quoted(t.label)}' AS label, {places(r)} AS rare, {places(t.key_words())} AS keys)" for t, r in zip(templates, rare)) + ")"
    postings = "array(" + ", ".join(f"struct({k} AS t, {i} AS i, '{w}' AS w)" for k, s in enumerate(sought) for i, w in s) + ")"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = docs.select(F.col(id_col), F.inline(let(scan_words(text), lambda w: F.array(F.struct(w.alias("__w"))))))
    at = lambda offset, i: f"get(__w, {offset} + {i})"
    base = []
    for phrase, label in BASE:
        p = phrase.split()
        rest = " AND ".join(f"{at('i', j)} <=> '{w}'" for j, w in enumerate(p))
        base.append(f"transform(CASE WHEN array_contains(__w, '{p[-2]}') AND size(__w) >= {len(p)} THEN filter(sequence(0, size(__w) - 1), i -> {rest}) ELSE array() END, i -> struct(i AS at, '{label}' AS label))")
    # where the words that are looked up stand in the file
    known = ", ".join(f"'{w}'" for w in searched)
    hits = f"filter(transform(__w, (w, i) -> CASE WHEN w IN ({known}) THEN struct(w AS w, i AS i) END), x -> x IS NOT NULL)"
    found = words.select(id_col, "__w", F.expr(f"concat({', '.join(base)})").alias("__base"), F.expr(hits).alias("__hits"))
    starts = f"array_distinct(flatten(transform(__hits, h -> transform(filter({postings}, p -> p.w = h.w), p -> struct(p.t AS t, h.i - p.i AS o)))))"
    share = f"transform({starts}, s -> transform(array(element_at({index}, s.t + 1)), x -> struct(x.label AS label, size(filter(x.rare, r -> {at('s.o', 'r.i')} <=> r.w)) / size(x.rare) AS share, forall(x.keys, k -> {at('s.o', 'k.i')} <=> k.w) AS keys))[0])"
    matched = found.select(id_col, F.size("__w").cast("long").alias("n_words"), "__base", F.inline(F.expr(f"array(struct(CASE WHEN size(__hits) > 0 THEN filter({share}, m -> m.keys AND m.share >= {SHARE}D) ELSE NULL END AS __m))")))
    some = F.coalesce(F.col("__m.label"), F.array().cast("array<string>"))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return matched.select(
        id_col, "n_words", F.size("__base").cast("long").alias("n_base"), F.array_min("__base.at").cast("long").alias("first_word"), F.array_max("__base.at").cast("long").alias("last_word"),
        joined(F.col("__base.label")).alias("base_labels"), joined(F.concat(F.col("__base.label"), some)).alias("labels"),
        F.when(F.size("__base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("__m.share"), F.lit(0.0))).alias("score"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
