"""License scan by a positional index of rare words (native expressions only).

Every template has words, a key phrase of consecutive words among them that is
mandatory, and a label.  From the corpus comes the document frequency of all template
words; the ``RARE`` words of a key phrase with the highest IDF are its entry in the
index: word -> (template, position).  A document looks up the places of its words
that are in the index; a template's postings are brought to the place where the key
phrase would begin and intersected, and where they agree all words of the phrase are
verified.  So every place of every key phrase is found, in one pass without a shuffle;
common words cost nothing.

``score`` is the best share of a template's words that stand where they should around
a verified place: 1 for a whole notice, less for a mere mention, 0 without a label.

Defined results: a null text is the empty text (no words, no labels); repeated rows and
null ids keep their rows; further columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let, text_of

RARE = 2
# What parts words after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool = False

    @property
    def key_at(self) -> int:
        return next(i for i in range(len(self.words)) if self.words[i:i + len(self.key)] == self.key)


def _template(label: str, words: str, key: str, base: bool = False) -> Template:
    return Template(label, tuple(words.split()), tuple(key.split()), base)


# Base phrases and labels, then the labels of this method.
TEMPLATES = (
    _template("gpl", "licensed under the gnu general public license", "gnu general public license", True),
    _template("apache", "licensed under the apache license", "apache license", True),
    _template("cc-by", "licensed under cc by", "cc by", True),
    _template("mit", "released under the mit license", "mit license", True),
    _template("gpl-3.0", "licensed under the gnu general public license version 3",
              "gnu general public license version 3"),
    _template("gpl-2.0", "licensed under the gnu general public license version 2",
              "gnu general public license version 2"),
    _template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    _template("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    _template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    _template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    _template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    _template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    _template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    _template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy",
              "permission is hereby granted free of charge"),
    _template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
              "redistribution and use in source and binary forms"),
    _template("isc", "permission to use copy modify and or distribute this software for any purpose",
              "permission to use copy modify and or distribute"),
    _template("unlicense", "this is free and unencumbered software released into the public domain",
              "free and unencumbered software"),
    _template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


def words_of(text: Column) -> Column:
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, SEPARATORS), "")


def _words(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rare_words(docs: DataFrame, text_col: str = "text",
               templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """Document frequency, over all documents, of the templates' key words (the
    driver gets one number per word)."""
    vocabulary = sorted({w for t in templates for w in t.key})
    found = docs.select(F.explode(F.array_intersect(words_of(text_of(text_col)), _words(vocabulary))).alias("w")) \
        .groupBy("w").count()
    return dict.fromkeys(vocabulary, 0) | {r["w"]: r["count"] for r in found.collect()}


def index_entries(frequency: dict[str, int], template: Template) -> list[tuple[str, int]]:
    """(word, position in the key phrase) of the phrase's rarest words."""
    places = sorted(range(len(template.key)), key=lambda i: (frequency[template.key[i]], i))
    chosen: dict[str, int] = {}
    for i in places:
        if template.key.count(template.key[i]) == 1 and len(chosen) < RARE:
            chosen[template.key[i]] = i
    return sorted(chosen.items())


def _starts(words: Column, hits: Column, template: Template, entries: list[tuple[str, int]]) -> Column:
    """All verified places of the template's key phrase."""
    def postings(word: str, at: int) -> Column:
        return F.transform(F.filter(hits, lambda h: h["w"] == word), lambda h: h["i"] - at)

    agreed = reduce(F.array_intersect, [postings(word, at) for word, at in entries])
    return F.filter(agreed, lambda s: F.when(s < 0, False).otherwise(
        F.slice(words, s + 1, F.lit(len(template.key))) == _words(template.key)))


def _cover(words: Column, starts: Column, template: Template) -> Column:
    """The best number of template words in place around a verified place."""
    def around(s: Column) -> Column:
        first = s - template.key_at
        total = F.lit(0)
        for j, w in enumerate(template.words):
            total = total + F.coalesce((F.get(words, first + j) == w).cast("int"), F.lit(0))
        return total

    return F.coalesce(F.array_max(F.transform(starts, around)), F.lit(0)) / F.lit(float(len(template.words)))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels,
    labels, score."""
    frequency = rare_words(docs, text_col, templates)
    entries = {t: index_entries(frequency, t) for t in templates}
    index = sorted({w for e in entries.values() for w, _ in e})

    def looked_up(words: Column) -> Column:
        placed = F.filter(F.transform(words, lambda w, i: F.when(w.isin(index), F.struct(w.alias("w"), i.alias("i")))),
                          lambda h: h.isNotNull())

        def result(t: Template, hits: Column) -> Column:
            return let(_starts(words, hits, t, entries[t]), lambda s: F.struct(
                F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), s.alias("starts"),
                _cover(words, s, t).alias("cover")))

        return let(placed, lambda hits: F.array(*[result(t, hits) for t in templates]))

    shape = "array<struct<label: string, base: boolean, starts: array<int>, cover: double>>"
    looked = let(words_of(F.col("t")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.when(F.arrays_overlap(w, _words(index)), looked_up(w).cast(shape))
        .otherwise(F.array().cast(shape)).alias("found")))
    per_doc = docs.select(id_col, text_of(text_col).alias("t")).select(id_col, looked.alias("d"))

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")

    met = F.filter(F.col("d.found"), lambda x: F.size(x["starts"]) > 0)
    base = F.filter(met, lambda x: x["base"])
    places = F.flatten(F.transform(base, lambda x: x["starts"]))
    return per_doc.select(
        id_col, F.col("d.n_words").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(met).alias("labels"),
        F.coalesce(F.array_max(F.transform(met, lambda x: x["cover"])), F.lit(0.0)).alias("score"))
