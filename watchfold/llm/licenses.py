"""License scans: a trained paragraph classifier, in DataFrame functions only.

A paragraph is a line of a document, or a run of wrapped lines: neighbours of at most
``WIDTH`` characters, up to ``REACH`` lines before and after one that mentions a licence,
without a blank or longer line between them. A sparse logistic regression over the paragraph's word
1- and 2-grams gives a probability for every licence family and for "unknown"; the
probabilities are calibrated by a temperature on paragraphs kept apart. The
prediction is confirmed by comparing the paragraph with the family's templates: the share of
a template's 2-grams that the paragraph holds or, for templates of at most ``SHORT`` 2-grams, also the share of
the paragraph's that are the template's (three at least). A run counts only if it holds that much of a template
while none of its lines does, for its family; it stands at its first line, in place of
the lines that do not, and overlapping runs of one family are one.

Only paragraphs with a line that mentions one of the ``STEMS`` (in any case) or ``NAMES`` (abbreviations
in capitals, so that no common word is one) are classified: a licence text names a licence, its family, a
copyright, a permission or a warranty, and a test holds every template to that. All others are unknown by definition
and not returned. Texts are filtered and cut up by Spark's own functions in one
pass; n-grams meet one table of a fixed size, with the weights and the templates, in one
broadcast join, and are added up once.

The model is fitted on the driver on the templates with words left out, in other
orders and surroundings, against paragraphs of a bounded sample of the documents
(``BACKGROUND`` rows at most) and against confusable sentences.

Defined cases: null or empty texts have no paragraphs; a paragraph without n-grams
of the model is unknown; on equal probabilities the first family by name wins; repeated rows
are returned each time; lines and texts may be of any length, the work grows with it; a null id is kept;
a table without rows gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from functools import reduce
from operator import add, or_

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from watchfold.llm.common import read_table

UNKNOWN = "unknown"
# Word stems and names of which a paragraph holds one to be looked at.
STEMS = ["licen", "copyright", "copyleft", "spdx", "warrant", "permission", "permitted",
         "redistribut", "public domain", "free software", "creative commons", "unencumbered",
         "attribution", "mozilla"]
NAMES = ["GPL", "Apache", "APACHE", "BSD", "CC0", "CC BY", "CC-BY", "CC 0", "ISC", "MIT", "MPL", "GNU"]
# Public licence notices by family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later"],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted",
        "Released under the ISC License."],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only"],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT"],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0"],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights; "
        "CC0 1.0 Universal"],
}
# Sentences with the same words that grant no licence of a family.
CONFUSABLE = [
    "All rights reserved.", "Copyright 2020 the authors.", "The driver showed a licence to the officer.",
    "Her fishing license expired in May.", "The permission was denied by the version control system.",
    "A warranty of two years is included.", "The work is in the public library, version 2.",
    "No permission is needed to enter the building.", "This license plate was released in the year 2.0.",
    "The general asked for permission to use the software.", "Licensed plumbers work under pressure."]
BACKGROUND = 1_000
EXAMPLES = 40                    # altered copies of each template
PENALTY, STEPS, RATE = 1e-4, 400, 2.0
CONFIRMED = 0.6
SHORT = 8                        # 2-grams of a template that may be a part of what a paragraph holds
WIDTH, REACH = 100, 8            # characters of a wrapped line, lines of a run on either side
SEED = 20


def words_of(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def grams_of(words: list[str]) -> set[str]:
    return set(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}


def examples(background: list[list[str]], seed: int = SEED) -> list[tuple[set[str], str]]:
    """(n-grams, family) of altered templates and of what is no licence."""
    dice, out = random.Random(seed), []
    filler = [w for row in background for w in row] or ["the", "of", "this"]
    loose = lambda n: [dice.choice(filler) for _ in range(dice.randint(0, n))]
    for family in sorted(TEMPLATES):
        for template in TEMPLATES[family]:
            words = words_of(template)
            for _ in range(EXAMPLES):
                kept = [w for w in words if dice.random() > 0.07] or words
                out.append((grams_of(loose(8) + kept + loose(8)), family))
            out += [(grams_of(words), family)] * 5
    other = [words_of(t) for t in CONFUSABLE] + background
    for words in other:
        out += [(grams_of(words), UNKNOWN)] * 2
    for words in [words_of(t) for t in CONFUSABLE]:
        for _ in range(EXAMPLES):
            out.append((grams_of(loose(8) + words + loose(8)), UNKNOWN))
    for _ in range(EXAMPLES * 6):            # single words of templates among others
        pick = [dice.choice(words_of(dice.choice(TEMPLATES[dice.choice(sorted(TEMPLATES))]))) for _ in range(3)]
        mixed = loose(20) + pick
        dice.shuffle(mixed)
        out.append((grams_of(mixed), UNKNOWN))
    dice.shuffle(out)
    return out


def fit(background: list[str], seed: int = SEED):
    """(classes, {n-gram: weights}, intercepts); the weights hold the calibration."""
    data = examples([words_of(p)[:60] for p in background], seed)
    classes = sorted(TEMPLATES) + [UNKNOWN]
    known = set().union(*(grams_of(words_of(t)) for ts in TEMPLATES.values() for t in ts),
                        *(grams_of(words_of(t)) for t in CONFUSABLE))
    slots = {g: i for i, g in enumerate(sorted(known))}
    x = np.zeros((len(data), len(slots)))
    y = np.zeros((len(data), len(classes)))
    for k, (grams, family) in enumerate(data):
        x[k, [slots[g] for g in grams if g in slots]] = 1
        y[k, classes.index(family)] = 1
    apart = np.arange(len(data)) % 5 == 0
    w, b = np.zeros((len(slots), len(classes))), np.zeros(len(classes))
    a, target = x[~apart], y[~apart]
    for _ in range(STEPS):                   # batch gradient descent
        z = a @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        w -= RATE * (a.T @ (p - target) / len(a) + PENALTY * w)
        b -= RATE * (p - target).mean(0)
    z, best = x[apart] @ w + b, (math.inf, 1.0)
    for temperature in np.linspace(0.3, 3.0, 28):
        s = z / temperature
        log_p = s - s.max(1, keepdims=True)
        log_p -= np.log(np.exp(log_p).sum(1, keepdims=True))
        best = min(best, (-(log_p * y[apart]).sum(), float(temperature)))
    w, b = w / best[1], b / best[1]
    return classes, {g: w[i].tolist() for g, i in slots.items()}, b.tolist()


def mentions(column):
    """A stem in any case, or a name in capitals that stands alone."""
    # the lambda's argument is evaluated once; written out, each stem would lower the text again
    stem = F.exists(F.array(F.lower(column)), lambda t: reduce(or_, [F.contains(t, F.lit(s)) for s in STEMS]))
    some = reduce(or_, [F.contains(column, F.lit(n)) for n in NAMES])
    return stem | (some & F.rlike(column, F.lit(f"(^|[^A-Za-z0-9])[AL]?({'|'.join(NAMES)})([^A-Za-z]|$)")))


def once(expression):
    """``expression`` as a generator's output, which the optimizer does not write out again where it is used."""
    return F.explode_outer(F.array(expression))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, row, at, first, last, text): each line that mentions a licence, and the run around it
    (``first`` < ``last``) if it has neighbours; ``at`` is the line's number."""
    short = lambda x: (F.trim(x) != "") & (F.length(x) <= WIDTH)
    lines = (docs.select("doc_id", "text").filter(mentions(F.col("text")))
             .select("doc_id", F.monotonically_increasing_id().alias("row"), once(F.split("text", "\n")).alias("lines")))
    named = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
                     lambda u: mentions(u["line"]))
    around = F.transform(named, lambda u: F.struct(
        u["at"].alias("at"), u["line"].alias("line"), F.greatest(u["at"] - REACH, F.lit(0)).alias("low"),
        F.transform(F.sequence(F.greatest(u["at"] - REACH, F.lit(0)), F.least(u["at"] + REACH, F.size("lines") - 1)),
                    lambda j: F.col("lines")[j]).alias("near")))
    near = (lines.select("doc_id", "row", F.explode_outer(around).alias("u")).filter("u IS NOT NULL")
            .select("doc_id", "row", "u.*"))
    breaks = F.filter(F.transform("near", lambda x, i: F.when(~short(x), i + F.col("low"))), lambda i: i.isNotNull())
    ends = (near.withColumn("breaks", breaks)
            .withColumn("first", F.coalesce(F.array_max(F.filter("breaks", lambda i: i < F.col("at"))) + 1, "low"))
            .withColumn("last", F.coalesce(F.array_min(F.filter("breaks", lambda i: i > F.col("at"))) - 1,
                                           F.col("low") + F.size("near") - 1)))
    run = F.when(short(F.col("line")) & (F.col("last") > F.col("first")), F.struct(
        "first", "last", F.array_join(F.slice("near", F.col("first") - F.col("low") + 1,
                                              F.col("last") - F.col("first") + 1), " ").alias("text")))
    alone = F.struct(F.col("at").alias("first"), F.col("at").alias("last"), F.col("line").alias("text"))
    return (ends.select("doc_id", "row", "at", F.explode_outer(F.array(alone, run)).alias("u"))
            .filter("u IS NOT NULL").select("doc_id", "row", "at", "u.*"))


def model_table(spark: SparkSession, weights: dict, classes: list[str], templates: list) -> DataFrame:
    """gram, w0.. (weights of the classes), t0.. (1 if the template holds the 2-gram)."""
    grams = sorted(set(weights).union(*(pairs for _, pairs in templates)))
    rows = [(g, *weights.get(g, [0.0] * len(classes)), *(int(g in pairs) for _, pairs in templates)) for g in grams]
    return spark.createDataFrame(rows, ", ".join(
        ["gram string", *(f"w{i} double" for i in range(len(classes))), *(f"t{k} int" for k in range(len(templates)))]))


def scored(parts: DataFrame, model) -> DataFrame:
    """The paragraphs with family, probability, similarity and confirmed."""
    classes, weights, intercept = model
    templates = [(f, pairs_of(words_of(t))) for f, ts in TEMPLATES.items() for t in ts]
    words = F.filter(F.split(F.lower("text"), "[^a-z0-9]+"), lambda w: w != "")
    n = F.greatest(F.size("words") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("words", F.lit(1), n), F.slice("words", F.lit(2), n),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    key = ["doc_id", "row", "at", "first", "last"]
    grams = (parts.select(*key, once(words).alias("words")).select(*key, "words", once(F.array_distinct(pairs)).alias("pairs"))
             .select(*key, F.size("pairs").alias("own"),
                     F.explode_outer(F.concat(F.array_distinct("words"), "pairs")).alias("gram")))
    sums = grams.join(F.broadcast(model_table(parts.sparkSession, weights, classes, templates)), "gram", "left") \
        .groupBy(*key, "own").agg(
            *[(F.coalesce(F.sum(f"w{i}"), F.lit(0.0)) + intercept[i]).alias(f"s{i}") for i in range(len(classes))],
            *[F.coalesce(F.sum(f"t{k}"), F.lit(0)).alias(f"n{k}") for k in range(len(templates))])
    top = F.greatest(*[f"s{i}" for i in range(len(classes))])
    total = reduce(add, [F.exp(F.col(f"s{i}") - top) for i in range(len(classes))])
    family, held, part = F.lit(classes[-1]), F.lit(0.0), F.lit(0.0)
    for i in range(len(classes) - 2, -1, -1):
        of = [(k, len(pairs)) for k, (f, pairs) in enumerate(templates) if f == classes[i] and pairs]
        best = F.col(f"s{i}") == top
        family = F.when(best, classes[i]).otherwise(family)
        held = F.when(best, _most([F.col(f"n{k}") / size for k, size in of])).otherwise(held)
        part = F.when(best, _most([F.when(F.col(f"n{k}") >= 3, F.col(f"n{k}") / F.col("own")).otherwise(0.0)
                                   for k, size in of if size <= SHORT])).otherwise(part)
    return sums.select(*key, family.alias("family"), (1 / total).alias("probability"), held.alias("held"),
                       F.greatest(held, part).alias("similarity")) \
        .withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("similarity") >= CONFIRMED))


def _most(shares: list):
    return F.greatest(F.lit(0.0), F.lit(0.0), *shares)


def scan(docs: DataFrame, model) -> DataFrame:
    """doc_id, paragraph, family, probability, template_similarity, confirmed."""
    rows = scored(paragraphs(docs), model).withColumn("alone", F.col("first") == F.col("last")) \
        .withColumn("sure", (F.col("family") != UNKNOWN) & (F.col("held") >= CONFIRMED)).filter("alone OR sure")
    near = Window.partitionBy("row").orderBy("at").rangeBetween(-2 * REACH, 2 * REACH)
    own = F.collect_set(F.when(F.col("alone") & F.col("sure"), F.struct("at", "family"))).over(near)
    rows = rows.withColumn("lines", own).filter(F.col("alone") | ~F.exists("lines", lambda x: (
        x["family"] == F.col("family")) & x["at"].between(F.col("first"), F.col("last"))))
    before = Window.partitionBy("row").orderBy("at", "last").rowsBetween(Window.unboundedPreceding, -1)
    reached = {f: F.max(F.when(~F.col("alone") & (F.col("family") == f), F.col("last"))).over(before) for f in TEMPLATES}
    end = reduce(lambda rest, f: F.when(F.col("family") == f, reached[f]).otherwise(rest), TEMPLATES, F.lit(None))
    runs = F.collect_set(F.when(~F.col("alone"), F.struct("first", "last"))).over(near)
    rows = rows.withColumn("end", end).withColumn("runs", runs).filter(F.when(
        F.col("alone"), F.col("sure") | ~F.exists("runs", lambda r: F.col("at").between(r["first"], r["last"])))
        .otherwise(F.coalesce(F.col("first") > F.col("end"), F.lit(True))))
    return rows.select("doc_id", F.col("first").cast("int").alias("paragraph"), "family", "probability",
                       F.col("similarity").alias("template_similarity"), "confirmed")


def pairs_of(words: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def background_sample(docs: DataFrame, bound: int = BACKGROUND) -> list[str]:
    """First lines of at most ``bound`` documents, picked by a hash of their id."""
    rows = docs.count()
    share = min(1.0, bound / max(rows, 1))
    sample = (docs.filter(F.pmod(F.xxhash64(F.lit("lines"), "doc_id"), F.lit(1_000_000)) < share * 1e6)
              .select("doc_id", F.substring_index("text", "\n", 1).alias("line"))
              .filter(F.col("line").isNotNull() & ~mentions(F.col("line"))).limit(2 * bound))
    return [r.line for r in sorted(sample.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.line))]


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return scan(docs, fit(background_sample(docs)))


QUERIES = {"op6_license_scan": op6_license_scan}
