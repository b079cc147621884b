"""Licence scan over a positional index of rare licence words.

Words of the templates are looked up in every file in one pass, with their
positions.  Which of them are rare is counted over all files.  A template's
words then say where it would start (position of the word in the file less
its position in the template); starting with the word of the highest IDF,
these starts are intersected, so that a file without a template's rarest word
is done with it at once.  What is left are verified places of the template's
mandatory key phrase.  DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import ascii_lower, stored

#: Fixed value: what separates words (the text in lower case already).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``words``: the whole template; ``first``, ``n``: its key phrase, which
    must stand word for word.  ``base``: one of the fixed phrases."""

    label: str
    words: tuple[str, ...]
    first: int
    n: int
    base: bool = False

    @property
    def key(self) -> range:
        return range(self.first, self.first + self.n)


def template(label: str, before: str, key: str, after: str = "", base: bool = False) -> Template:
    b, k, a = before.split(), key.split(), after.split()
    return Template(label, (*b, *k, *a), len(b), len(k), base)


#: The phrases and labels of the base scan.
BASE = (
    template("cc-by", "", "cc by", base=True),
    template("gpl", "", "general public license", base=True),
    template("reserved", "", "all rights reserved", base=True),
)
#: Notices by which files state well-known licences.
NOTICES = (
    template("agpl", "licensed under the gnu", "affero general public license", "version 3"),
    template("apache-2.0", "licensed under the", "apache license version 2 0"),
    template("bsd", "", "redistribution and use in source and binary forms", "with or without modification are permitted"),
    template("cc-by-4.0", "licensed under", "cc by 4 0"),
    template("cc-by-nc", "licensed under", "cc by nc", "4 0"),
    template("cc-by-sa", "licensed under", "cc by sa", "4 0"),
    template("creative-commons", "licensed under a", "creative commons attribution", "license"),
    template("gpl-2", "under the terms of the gnu", "general public license version 2"),
    template("gpl-3", "this work is licensed under the gnu", "general public license version 3"),
    template("isc", "", "permission to use copy modify and or distribute this software", "for any purpose with or without fee"),
    template("lgpl", "licensed under the gnu", "lesser general public license"),
    template("mit", "released under the", "mit license"),
    template("mit-text", "", "permission is hereby granted free of charge", "to any person obtaining a copy"),
    template("mpl-2.0", "subject to the terms of the", "mozilla public license", "v 2 0"),
)


def scan(docs: DataFrame, templates: tuple[Template, ...] = (*BASE, *NOTICES), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, n_base (places of base phrases),
    first_word and last_word (smallest and largest start of these, words from
    0; null without any), base_labels, labels (distinct, sorted, joined by
    commas) and score: the largest share of a template's words that stand in
    place around a verified key phrase, 0 without one.

    Null and empty texts have no words.  Null ids and repeated rows are
    scanned like any other, very long texts whole; other columns are ignored;
    an empty table gives no rows.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    clean = F.regexp_replace(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), "^" + BETWEEN, "")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.split(clean, BETWEEN).alias("w"))
    size = F.size("w")
    n_words = (size - F.when(F.element_at("w", -1) == "", 1).otherwise(0)).cast("long")
    at = F.array_compact(F.transform("w", lambda x, i: F.when(x.isin(vocabulary), F.struct(i.alias("p"), x.alias("w")))))
    hits = stored(rows.select("id", n_words.alias("n_words"), at.alias("hits")), "licences")

    seen = hits.select(F.explode(F.array_distinct(F.col("hits")["w"])).alias("w")).groupBy("w").count()
    files = {r["w"]: r["count"] for r in seen.collect()}  # at most one row a template word
    rarity = {w: -math.log1p(files.get(w, 0)) for w in vocabulary}

    found = hits.select("id", "n_words", *[_places(t, rarity).alias(f"t{i}") for i, t in enumerate(templates)], "hits")
    base = [i for i, t in enumerate(templates) if t.base]
    base_starts = F.concat(*[F.transform(f"t{i}", lambda s, k=templates[i].first: s + k) for i in base])
    labels = lambda which: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.size(f"t{i}") > 0, F.lit(templates[i].label)) for i in which])))), ",")
    shares = [_share(t, f"t{i}") for i, t in enumerate(templates)]
    out = found.withColumn("starts", base_starts).select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(range(len(templates))).alias("labels"),
        F.greatest(*shares).alias("score"),
    )
    return out


def _starts(word: str, at: int) -> Column:
    """Where the template would start for each place of its word."""
    return F.transform(F.filter("hits", lambda h: h["w"] == word), lambda h: h["p"] - at)


def _places(t: Template, rarity: dict[str, float]) -> Column:
    """Starts at which the whole key phrase stands (the template may start
    before the text: those are kept, as only its key phrase is mandatory)."""
    order = sorted(t.key, key=lambda j: (-rarity[t.words[j]], j))
    places = _starts(t.words[order[0]], order[0])
    for j in order[1:]:
        places = F.when(F.size(places) == 0, F.array().cast("array<int>")).otherwise(F.array_intersect(places, _starts(t.words[j], j))) if j == order[1] else F.array_intersect(places, _starts(t.words[j], j))
    return places


def _share(t: Template, places: str) -> Column:
    """Of a verified template's words, the largest share that stands in place."""
    rest = [j for j in range(len(t.words)) if j not in t.key]
    n = float(len(t.words))
    if not rest:
        return F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    met = lambda s: sum((F.array_contains(_starts(t.words[j], j), s).cast("int") for j in rest), F.lit(t.n))
    return F.when(F.size(places) > 0, F.array_max(F.transform(places, met)) / F.lit(n)).otherwise(F.lit(0.0))
