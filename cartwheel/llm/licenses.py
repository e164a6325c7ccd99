"""License scans by diagonal voting, in DataFrame operations only.

Every text is read as words. The hashes of its rolling k-word windows are
joined with those of the templates' windows; a hit at text word i and template
word j lies on the diagonal i - j. Hits are counted per template and diagonal,
neighbouring diagonals (a word more or less in between) are merged, and a span
counts as a match if enough of the template's windows voted for it. Where
matches of different labels overlap, the one with the most votes stands (a
variant's wording against the plain one's). Phrases (short templates, matched word by word) are the base rules: every place where
the phrase's words stand consecutively.

All window hashes of all texts take part; the templates are a constant of some
twenty thousand windows (:data:`TEMPLATES`, :mod:`cartwheel.llm.notices`,
:data:`PHRASES`), so the join is a broadcast of a proven bound, and only hits
are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.notices import notices
from cartwheel.plans.sink import materialize

# fixed values: base phrases and their labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: single sentences that stand for a licence; whole notices are in
# cartwheel.llm.notices
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software "
           "and associated documentation files the software to deal in the software without restriction",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except "
              "in compliance with the license",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "lgpl": "licensed under the gnu lesser general public license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted "
           "provided that the following conditions are met",
    "mpl": "this source code form is subject to the terms of the mozilla public license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by": "licensed under a creative commons attribution 4 0 international license",
}


@dataclass(frozen=True)
class LicenseParams:
    k: int = 3                # words of a rolling window
    max_drift: int = 3        # neighbouring diagonals at most this far apart are merged
    min_coverage: float = 0.6  # share of a template's windows that must vote


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STRETCH = 64  # words
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of digits, a-z and characters
    beyond ASCII. Null and empty texts have none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, _GAP), lambda w: w != "")


def template_windows(spark: SparkSession, templates: list[tuple[str, str, int]], k: int) -> DataFrame:
    """``label, own, tid, place, windows, h``: one row per template window."""
    rows = []
    for tid, (label, text, own) in enumerate(templates):
        w = [x for x in re.split(_GAP, text.translate(str.maketrans(_UPPER, _LOWER))) if x]  # as words_of
        n = len(w) - k + 1
        rows += [(label, own, tid, place, n, w[place:place + k]) for place in range(n)]
    t = spark.createDataFrame(rows, "label string, own int, tid int, place int, windows int, w array<string>")
    return t.withColumn("h", F.xxhash64(*[F.col("w")[j] for j in range(k)])).drop("w")


def phrase_places(words: Column, phrase: str) -> Column:
    """Starts (from 0) of all places where the phrase's words stand consecutively."""
    w = phrase.split()
    n = F.size(words)
    at = F.filter(F.sequence(F.lit(0), n - len(w)),
                  lambda i: _all([words[i + j] == x for j, x in enumerate(w)]))
    return F.when((n >= len(w)) & F.array_contains(words, w[-1]) & F.array_contains(words, w[0]), at) \
            .otherwise(F.array().cast("array<int>"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def hits_of(texts: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """``key, at`` and the template's columns for every window of
    ``texts(key, words)`` that a template has. Windows only pass by: the
    templates are broadcast."""
    n = F.size("words")
    windows = F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.col("words")[i + j] for j in range(k)])))
    return texts.select("key", F.posexplode(windows).alias("at", "h")).join(F.broadcast(table), "h")


def spans(hits: DataFrame, params: LicenseParams = LicenseParams()) -> DataFrame:
    """``key, label, first, last, coverage`` of the template matches.

    ``hits``: :func:`hits_of` (texts of one key are one text). ``first`` and ``last`` are the first and last
    word of the span; ``coverage`` is the share of the template's windows that
    vote for it, each counted once. Of overlapping spans of different labels
    those with fewer votes are dropped; passages of a licence's own go first."""
    p = params
    votes = hits \
        .groupBy("key", "label", "own", "tid", "windows", (F.col("at") - F.col("place")).alias("diagonal")).agg(
            F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("place").alias("places"))
    # neighbouring diagonals: a new run starts where the next one is too far
    w = Window.partitionBy("key", "tid").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(w) > p.max_drift).cast("int"), F.lit(1))
    runs = votes.withColumn("new", new).withColumn("run", F.sum("new").over(w))
    merged = runs.groupBy("key", "label", "own", "tid", "windows", "run").agg(
        F.min("first").alias("first"), (F.max("last") + p.k - 1).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("got"))
    found = merged.withColumn("coverage", F.col("got") / F.col("windows")).filter(F.col("coverage") >= p.min_coverage)
    found, _ = materialize(found, "license-spans")
    # spans that overlap meet in a stretch of text, which only few can touch
    placed = found.select("key", "label", "tid", "run", "first", "last", F.struct("own", "got").alias("votes"),
                          F.explode(F.sequence(F.floor(F.col("first") / _STRETCH), F.floor(F.col("last") / _STRETCH))).alias("stretch"))
    a, b = placed.alias("a"), placed.alias("b")
    beaten = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.stretch") == F.col("b.stretch"))
                    & (F.col("a.label") != F.col("b.label")) & (F.col("a.votes") < F.col("b.votes"))
                    & (F.col("a.first") <= F.col("b.last")) & (F.col("b.first") <= F.col("a.last"))) \
        .select("a.key", "a.tid", "a.run").distinct()
    return found.join(beaten, ["key", "tid", "run"], "left_anti").select("key", "label", "first", "last", "coverage")


def scan(docs: DataFrame, params: LicenseParams = LicenseParams()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score``.

    ``score`` is 1 where a base phrase stands, else the best coverage of the
    method's matches, else 0. Null and empty texts have no words and no labels
    (empty strings). Matches are found per distinct text, so repeated rows and
    null ids are harmless; extra columns are ignored. Texts are read twice."""
    p = params
    table = template_windows(docs.sparkSession, [(label, t, 0) for label, t in TEMPLATES.items()] + notices(), p.k)
    table, _ = materialize(table, "license-templates")
    text = F.col("text").cast("string")
    base = F.filter(F.array(*[F.struct(F.lit(label).alias("label"), phrase_places(F.col("words"), phrase).alias("at"))
                              for phrase, label in PHRASES.items()]), lambda x: F.size(x["at"]) > 0)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("key"), words_of(text).alias("words"))
    rows, _ = materialize(texts.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), base.alias("base")), "license-rows")
    marks = spans(hits_of(texts.select("key", "words"), table, p.k), p) \
        .groupBy("key").agg(F.collect_set("label").alias("extra"), F.max("coverage").alias("best"))
    marks, _ = materialize(marks, "license-marks")
    places = F.flatten(F.transform("base", lambda x: x["at"]))
    own = F.transform("base", lambda x: x["label"])
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    none = F.array().cast("array<string>")
    return rows.join(marks, "key", "left").select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        joined(own).alias("base_labels"), joined(F.concat(own, F.coalesce("extra", none))).alias("labels"),
        F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
