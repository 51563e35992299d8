"""Find licence notices with a positional index of rare licence words. DataFrame functions only.

Every template is indexed by word and position. Of a file's words, those of the index are kept with
their positions and weighted by inverse document frequency over all files. The highest-IDF words of each template are looked up
first: so many that an alignment (position in the file less position in the template) without any of them cannot reach the share that is
asked for. Only alignments that one of them proposes are looked at further: the postings of all the template's words are intersected with the file's
by relative position, the weights found there are added up, and the largest share counts. A template is named if enough
of its weight stands there and all its key phrases occur.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import ascii_lower
from loadkit.session import stage

# Words of a text whose A-Z are yet to be lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Function words of the templates, which are not indexed.
COMMON = frozenset("a and any are be by can for in is it its of on or that the this to under with you without".split())

# Phrases and labels of the base scan.
BASE = {"mit": ["mit license"], "apache": ["apache license"], "gpl": ["general public license"]}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


# Wording of public licence notices and the phrases each must have.
TEMPLATES = (
    Template("apache-2", "licensed under the apache license version 2", ("apache license version 2",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source", "binary forms")),
    Template("cc-by", "this work is licensed under a creative commons attribution", ("creative commons attribution",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("free software", "gnu general public license")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("use copy modify", "hereby granted")),
    Template("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free", "associated documentation files")),
    Template("mit-short", "released under the mit license", ("mit license",)),
    Template("mpl-2", "subject to the terms of the mozilla public license version 2", ("mozilla public license",)),
)
SHARE = 0.7


def _index(templates: tuple[Template, ...]) -> tuple[list[tuple[str, str, int]], list[str]]:
    """Postings (word, label, position), and all words whose places in a file are needed."""
    postings = [(w, t.label, i) for t in templates for i, w in enumerate(t.text.split()) if w not in COMMON]
    phrases = [p for t in templates for p in t.phrases] + [p for ps in BASE.values() for p in ps]
    return postings, sorted({w for w, _, _ in postings} | {w for p in phrases for w in p.split()})


def weighted(postings: list[tuple[str, str, int]], weight: dict[str, float], share: float) -> list[tuple[str, str, int, float, bool]]:
    """(word, label, position, share of the template's weight, rare) of every posting.

    The rarest postings of a template are marked until they hold more than `1 - share` of its weight: what lacks all of them falls short of `share`.
    """
    out = []
    for label in sorted({label for _, label, _ in postings}):
        own = sorted(((weight[w], w, at) for w, other, at in postings if other == label), reverse=True)
        total, held = sum(x for x, _, _ in own), 0.0
        for x, word, at in own:
            out.append((word, label, at, x / total if total else 0.0, held <= 1 - share + 1e-9))
            held += x / total if total else 0.0
    return out


def _starts(places: Column, phrase: str) -> Column:
    """Positions where the words of the phrase stand one after the other. All its words are in `places`, in order."""
    words = phrase.split()

    def at(x: Column, i: Column) -> Column:
        fits = x["word"] == words[0]
        for k, word in enumerate(words[1:], 1):
            later = F.get(places, i + k)
            fits = fits & F.coalesce((later["word"] == word) & (later["pos"] == x["pos"] + k), F.lit(False))
        return F.when(fits, x["pos"])

    return F.array_compact(F.transform(places, at))


def places_of(docs: DataFrame, words: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, places): the words of the list that occur, with their positions."""
    found = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))
    taken = docs.select(F.col(key).alias("doc_id"), found.alias("words"))
    # `lower` may turn other letters into a-z, so what it lets through is lower-cased once more, exactly.
    held = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.cast("bigint").alias("pos"))), lambda x: F.lower(x["word"]).isin(words))
    exact = F.filter(F.transform(held, lambda x: F.struct(ascii_lower(x["word"]).alias("word"), x["pos"].alias("pos"))), lambda x: x["word"].isin(words))
    return taken.select("doc_id", F.size("words").cast("bigint").alias("n_words"), exact.alias("places"))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: tuple[Template, ...] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row.

    The base columns count the places of the base phrases. score is the largest share of a named template's
    weight that stands at one alignment, 0 where none is named. Null and empty texts have no words and no
    labels (empty strings). Repeated rows are scanned each; null ids stay; no rows give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    postings, words = _index(templates)
    placed = stage(places_of(docs, words, text, key).withColumn("row", F.monotonically_increasing_id()), "licence-places")

    base = {label: F.flatten(F.array(*[_starts(F.col("places"), p) for p in phrases])) for label, phrases in BASE.items()}
    every = F.flatten(F.array(*base.values()))
    named = F.array_compact(F.array(*[F.when(F.size(starts) > 0, label) for label, starts in base.items()]))
    some = placed.filter(F.size("places") > 0)
    some = some.withColumn("starts", every).withColumn("base", F.array_sort(named))
    some = stage(some, "licence-some")

    # One row for each word of the index and one for the files: the vocabulary bounds what the driver sees.
    files = placed.count()
    held = some.select(F.explode(F.array_distinct(F.transform("places", lambda x: x["word"]))).alias("word")).groupBy("word").count().collect()
    seen = {r["word"]: r["count"] for r in held}
    weight = {w: math.log((files + 1) / (seen.get(w, 0) + 0.5)) for w in words}
    index = spark.createDataFrame(weighted(postings, weight, share), "word string, label string, at bigint, part double, rare boolean")

    # Files without a rare word are not looked at again; of the others only alignments that a rare word proposes.
    def placed_words(rows: DataFrame, part: DataFrame) -> DataFrame:
        found = rows.select("row", F.explode("places").alias("x")).select("row", "x.word", "x.pos").join(F.broadcast(part), "word")
        return found.withColumn("offset", F.col("pos") - F.col("at"))

    proposed = stage(placed_words(some, index.filter("rare")).select("row", "label", "offset").distinct(), "licence-proposed")
    aligned = placed_words(some.join(proposed.select("row").distinct(), "row", "left_semi"), index).join(proposed, ["row", "label", "offset"], "left_semi")
    aligned = aligned.groupBy("row", "label", "offset").agg(F.sum("part").alias("share"))
    best = aligned.groupBy("row", "label").agg(F.least(F.max("share"), F.lit(1.0)).alias("share"))
    phrases = F.create_map(*[x for t in templates for x in (F.lit(t.label), _all([F.size(_starts(F.col("places"), p)) > 0 for p in t.phrases]))])
    verified = some.select("row", phrases.alias("verified"))
    kept = best.filter(F.col("share") >= share).join(verified, "row").filter(F.col("verified")[F.col("label")])
    kept = kept.groupBy("row").agg(F.collect_set("label").alias("own"), F.max("share").alias("score"))

    text_of = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    with_words = some.join(kept, "row", "left").select(
        "doc_id", "n_words", F.size("starts").cast("bigint").alias("n_base"), F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), text_of(F.concat("base", F.coalesce("own", F.array().cast("array<string>")))).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
    nothing = F.lit(None).cast("bigint")
    without = placed.filter(F.size("places") == 0).select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_base"), nothing.alias("first_word"), nothing.alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"))
    return with_words.unionByName(without)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
