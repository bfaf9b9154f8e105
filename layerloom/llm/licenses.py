"""Licence phrases and templates in texts, found through a positional index of rare words; built-in functions only.

Every template has words and a mandatory key phrase (a run of its words). A first pass counts in how many documents each licence word
occurs. Each document gets postings (places) of the licence words that are rarest in the corpus, by inverse document frequency: the two rarest of every
template's key phrase. A posting says where the template would start, place - position in the template; the starts that both words agree on
are candidates, and a candidate counts if the whole key phrase stands there. A document without one of the rarest words is not cut into words at all.
All of it stays in the document's row: no join, no shuffle but that of the few counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from layerloom.llm.common import whole_text

# Characters of words, before and after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]  # a run of words

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key)


def template(label: str, text: str, key: str) -> Template:
    return Template(label, tuple(text.split()), tuple(key.split()))


# The base phrases and their labels.
BASE_PHRASES = (
    template("mit", "mit license", "mit license"),
    template("apache", "apache license", "apache license"),
    template("gpl", "general public license", "general public license"),
)
# Opening words of well-known licence notices.
NOTICES = (
    template("mit", "released under the mit license", "mit license"),
    template("apache", "licensed under the apache license version 2 0", "apache license"),
    template("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    template("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms",
    ),
    template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "permission to use copy modify and or distribute",
    ),
)


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    return F.filter(F.split(lowered(text), BETWEEN), lambda w: w != "")


def inverse_frequencies(texts: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """log(documents / documents with the word), over all rows; a word found nowhere counts as found once.

    Per row only the licence words present leave the scan; at most one value per vocabulary word reaches the driver.
    """
    present = F.array_intersect(F.split(lowered(F.col("text")), BETWEEN), F.array(*map(F.lit, vocabulary)))
    counts = [F.count_if(F.array_contains("present", w)).alias(f"c{i}") for i, w in enumerate(vocabulary)]
    row = texts.select(present.alias("present")).agg(F.count(F.lit(1)).alias("n"), *counts).first()
    return {w: math.log(max(row["n"], 1) / max(row[f"c{i}"], 1)) for i, w in enumerate(vocabulary)}


# Words of a key phrase whose postings are intersected.
LOOKED_UP = 2


def rarest_places(t: Template, frequency: dict[str, float]) -> list[int]:
    """The places in the key phrase of its rarest different words, rarest first; ties: the longer word, then the alphabet."""
    first = {w: i for i, w in reversed(list(enumerate(t.key)))}
    return sorted(first.values(), key=lambda i: (frequency[t.key[i]], len(t.key[i]), t.key[i]), reverse=True)[:LOOKED_UP]


def _starts(t: Template, places: list[int]) -> Column:
    """Zero-based starts of the key phrase in ``words``: those on which the postings of the words at ``places`` of the phrase agree, verified."""
    key, n = F.array(*map(F.lit, t.key)), len(t.key)

    def told(at: int) -> Column:
        return F.transform(F.col("postings")[t.key[at]], lambda p: p - F.lit(at))

    agreed = reduce(F.array_intersect, map(told, places))
    return F.filter(agreed, lambda s: (s >= 0) & (F.slice("words", F.greatest(s, F.lit(0)) + 1, n) == key))


def scan_licenses(
    documents: DataFrame,
    base: tuple[Template, ...] = BASE_PHRASES,
    notices: tuple[Template, ...] = NOTICES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_words, n_base (places of base phrases), first_word and last_word (smallest and largest start of these),
    base_labels, labels (of base phrases and notices; distinct, sorted, comma-joined) and score: the largest share of a notice's words that stand
    in place around its key phrase, 0 without one.

    Defined results: null text is empty; texts without words give zeros, null places, empty labels. Rows with equal ids are separate
    documents. An empty table gives no rows. Other columns are not read.
    """
    texts = documents.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))
    templates = [*base, *notices]
    frequency = inverse_frequencies(texts, sorted({w for t in templates for w in t.key}))
    places = {t: rarest_places(t, frequency) for t in templates}
    has_rare = F.col("text").rlike("(?i)" + "|".join(sorted({t.key[places[t][0]] for t in templates})))
    indexed = sorted({t.key[at] for t in templates for at in places[t]})
    read = texts.select(
        "doc_id",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(has_rare, words_of(F.col("text"))).otherwise(F.array().cast("array<string>")).alias("words"),
    )
    found = F.filter(F.sequence(F.lit(1), F.size("words")), lambda i: F.get(F.col("words"), i - 1).isin(indexed))
    standing = F.when(F.size("words") > 0, F.transform(found, lambda i: i - 1)).otherwise(F.array().cast("array<int>"))
    read = read.withColumn("places", standing)

    def places_of(word: str) -> Column:
        return F.filter("places", lambda p: F.get(F.col("words"), p) == word)

    by_word = [places_of(w).alias(w) for w in indexed]
    read = read.withColumn("postings", F.struct(*by_word))
    starts = {t: _starts(t, places[t]) for t in templates}
    read = read.select(
        "doc_id",
        "n_words",
        "words",
        *[starts[t].alias(f"b{i}") for i, t in enumerate(base)],
        *[starts[t].alias(f"m{i}") for i, t in enumerate(notices)],
    )

    def share(i: int, t: Template) -> Column:
        """Best share of the notice's words in place over the places of its key phrase."""

        def in_place(s: Column) -> Column:
            one = lambda k, w: F.coalesce((F.get(F.col("words"), s + (k - t.key_at)) == w).cast("int"), F.lit(0))
            return sum((one(k, w) for k, w in enumerate(t.words)), F.lit(0)) / F.lit(float(len(t.words)))

        return F.coalesce(F.array_max(F.transform(f"m{i}", in_place)), F.lit(0.0))

    every = F.concat(*[F.col(f"b{i}") for i in range(len(base))])

    def joined(labels: list[tuple[str, str]]) -> Column:
        found = F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, label in labels])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(found))), ",")

    base_columns = [(f"b{i}", t.label) for i, t in enumerate(base)]
    notice_columns = [(f"m{i}", t.label) for i, t in enumerate(notices)]
    return read.select(
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        joined(base_columns).alias("base_labels"),
        joined(base_columns + notice_columns).alias("labels"),
        F.greatest(F.lit(0.0), *[share(i, t) for i, t in enumerate(notices)]).alias("score"),
    )
