"""Operator 5, licence scans: a trained paragraph classifier with template confirmation.

A sparse logistic regression over word n-grams tells licence families apart.  It is
trained on variations of notice texts, on a bounded sample of corpus paragraphs as
background, and its "unknown" verdict is calibrated on licences it was not shown.  All
n-grams frequent in the notices are features, common words too, and every paragraph with
a word pair among them is scored.  A family found is confirmed if one of its notices
stands in the paragraph for the most part, whatever text is around it, or if the
paragraph is for the most part an excerpt of its notices.
"""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.llm.tables import load, settled, small_table, stored

# Short notices by which works are put under well-known licences.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under"
        " the License is distributed on an \"AS IS\" BASIS.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License.",
        "You may not use the material for commercial purposes.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "You must give appropriate credit, provide a link to the license, and indicate if changes"
        " were made.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
        " License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "bsd": (
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright, all rights reserved. No part of this publication may be reproduced without"
        " the prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}
# Licences that calibrate "unknown": like the above in form, but of no trained family.
UNSEEN = (
    "Licensed under the Mozilla Public License, v. 2.0.",
    "This Source Code Form is subject to the terms of the Mozilla Public License.",
    "Distributed under the Boost Software License, Version 1.0.",
    "Licensed under the Eclipse Public License 2.0.",
    "Released under the zlib license.",
    "This font software is licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the European Union Public Licence.",
    "Released into the public domain under the Unlicense.",
    "Licensed under the Artistic License 2.0.",
    "This database is made available under the Open Database License.",
)
FAMILIES = tuple(TEMPLATES)
NONE = len(FAMILIES)  # the class of ordinary paragraphs
BACKGROUND = 4000  # paragraphs; the bound of the training sample
VARIATIONS = 40
LENGTHS = (1, 2, 3)
STEPS = 400
PENALTY = 2e-4
CONFIRMED = 0.5


def _grams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in LENGTHS for i in range(len(words) - n + 1)}


def _long_grams(text: str) -> set[str]:
    """The word pairs and triples of a notice."""
    return {g for g in _grams(_words(text)) if " " in g}


def _words(text: str) -> list[str]:
    out = "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text)
    return out.lower().split()


def paragraph_words(text: Column) -> Column:
    """Lower-case words; ASCII punctuation parts them."""
    plain = F.lower(F.regexp_replace(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _ngrams(words: Column, n: int) -> Column:
    last = F.size(words) - n
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)])
    )).otherwise(F.array().cast("array<string>"))


def _shared_grams(words: Column, own: list[str], shared: list[str]) -> Column:
    """The different n-grams of a paragraph that are among ``shared``, in order.

    Those all begin with a word of ``own``, so n-grams are made at such words only.  Past the
    last word they come out shorter, which repeats one that is there anyway.
    """
    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(own))

    def made(n: int) -> Column:
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]))

    grams = F.concat(*[made(n) for n in LENGTHS])
    return F.array_sort(F.array_distinct(F.filter(grams, lambda g: g.isin(shared))))


def _long_size(words: Column) -> Column:
    """How many different word pairs and triples a paragraph of two words or more has, by hash."""
    def different(n: int) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(words) - n),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]),
        )
        return F.size(F.array_distinct(hashes))

    return different(2) + F.when(F.size(words) > 2, different(3)).otherwise(0)


def _varied(text: str, draw: random.Random) -> list[str]:
    """The words of a notice with some left out, or set among corpus-like filler."""
    words = [w for w in _words(text) if draw.random() > 0.15] or _words(text)
    filler = [f"filler{draw.randrange(1000)}" for _ in range(draw.choice((0, 0, 3, 8)))]
    at = draw.randrange(len(filler) + 1)
    return filler[:at] + words + filler[at:]


def _set_among(text: str, others: list[str], draw: random.Random) -> list[str]:
    """The words of a notice within the words of an ordinary paragraph."""
    at = draw.randrange(len(others) + 1)
    return others[:at] + _words(text) + others[at:]


class Classifier:
    """Weights by n-gram, with intercepts, one column per family and one for none."""

    def __init__(self, background: list[list[str]]):
        draw = random.Random(5)
        among = [words for words in background if words] or [[]]
        rows = [(words, NONE) for words in background if words]
        held = []
        for number, family in enumerate(FAMILIES):
            for text in TEMPLATES[family]:
                rows += [(_words(text), number)] * 5
                rows += [(_varied(text, draw), number) for _ in range(VARIATIONS)]
                rows += [(_set_among(text, draw.choice(among), draw), number) for _ in range(VARIATIONS)]
                held += [_varied(text, draw) for _ in range(VARIATIONS // 2)]
        unseen = [_varied(t, draw) for t in UNSEEN for _ in range(VARIATIONS)]
        self.words = {w for texts in TEMPLATES.values() for t in texts for w in _words(t)}
        counts = Counter(
            g for words, family in rows if family != NONE for g in _grams(words)
            if all(w in self.words for w in g.split(" "))
        )
        kept = sorted(g for g, n in counts.items() if n > 2)
        # A word triple that is a feature has pairs that are.
        self.pairs = [g for g in kept if g.count(" ") == 1]
        self.index = {g: i for i, g in enumerate(kept)}
        self.weights = np.zeros((len(kept), NONE + 1), np.float32)
        self.bias = np.zeros(NONE + 1, np.float32)
        self._fit(rows)
        self.least = self._calibrated(held, unseen)
        used = np.abs(self.weights).sum(axis=1) > 0
        self.index = {g: i for g, i in self.index.items() if used[i]}

    def _matrix(self, texts: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.weights)), np.float32)
        for row, words in enumerate(texts):
            out[row, [self.index[g] for g in _grams(words) if g in self.index]] = 1
        return out

    def _probabilities(self, x: np.ndarray) -> np.ndarray:
        logits = x @ self.weights + self.bias
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        return logits / logits.sum(axis=1, keepdims=True)

    def _fit(self, rows: list[tuple[list[str], int]]) -> None:
        """Gradient steps on the mean loss, each followed by shrinking towards zero (L1)."""
        # Equal examples, above all background paragraphs without any feature, are one row.
        counts = Counter(
            (tuple(sorted(self.index[g] for g in _grams(words) if g in self.index)), family)
            for words, family in rows
        )
        x = np.zeros((len(counts), len(self.weights)), np.float32)
        for row, (features, _) in enumerate(counts):
            x[row, list(features)] = 1
        families = np.array([family for _, family in counts])
        number = np.array(list(counts.values()), float)
        y = np.eye(NONE + 1)[families]
        weight = 1 / np.maximum(np.bincount(families, number, NONE + 1), 1)
        each = (number * (weight / weight.sum())[families])[:, None].astype(np.float32)
        squares = np.full_like(self.weights, 1e-4)
        bias_squares = np.full_like(self.bias, 1e-4)
        for _ in range(STEPS):
            error = ((self._probabilities(x) - y) * each).astype(np.float32)
            step, bias_step = x.T @ error, error.sum(axis=0)
            squares += step**2
            bias_squares += bias_step**2
            rate = 0.3 / np.sqrt(squares)
            moved = self.weights - rate * step
            self.weights = np.sign(moved) * np.maximum(np.abs(moved) - rate * PENALTY, 0)
            self.bias -= 0.3 * bias_step / np.sqrt(bias_squares)

    def _calibrated(self, held: list[list[str]], unseen: list[list[str]]) -> float:
        """The probability that best parts held-out notices from licences never shown."""
        good = np.sort(self._probabilities(self._matrix(held))[:, :NONE].max(axis=1))
        bad = np.sort(self._probabilities(self._matrix(unseen))[:, :NONE].max(axis=1))
        limits = np.unique(np.r_[good, bad])
        right = [np.mean(good >= v) + np.mean(bad < v) for v in limits]
        return float(limits[int(np.argmax(right))])


def background_sample(docs: DataFrame, number: int = BACKGROUND) -> list[list[str]]:
    """The words of about ``number`` paragraphs of least hash, twice as many at most.

    Drawn from all paragraphs of all documents; a paragraph that shares three words in a
    row with a template is no background.
    """
    taken = {g for texts in TEMPLATES.values() for t in texts for g in _grams(_words(t))
             if g.count(" ") == 2 or g in ("all rights", "rights reserved")}
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    total = lines.count()
    # Hashes are even over their range, so this share of it holds about ``number`` paragraphs.
    share = min(1.0, number / max(total, 1))
    least = int(-(2**63) + share * (2**64 - 2**12))
    drawn = lines.filter(F.xxhash64("line") <= F.lit(least)).distinct()
    rows = drawn.limit(2 * number).select(paragraph_words(F.col("line")).alias("w")).collect()
    return [r["w"] for r in rows if not _grams(r["w"]) & taken]


def scan_paragraphs(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, text_hash, paragraph, family, probability, similarity, verdict).

    A row for each paragraph (line) that has a word pair of the model and is not judged ordinary.
    ``verdict`` is the family when its probability is at least the calibrated one and the
    templates confirm it, else ``unknown``.
    """
    spark = docs.sparkSession
    cut = docs.select(
        "doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("paragraph", "line")
    ).withColumn("words", paragraph_words(F.col("line")))
    cut = settled(cut, "doc_id", "text_hash", "paragraph", values=["words"])
    # Both words of a pair are words of notices; only then are pairs made and looked up.
    own = F.filter("words", lambda w: w.isin(sorted(model.words)))
    found = cut.filter(F.size(own) > 1).filter(
        F.exists(_ngrams(F.col("words"), 2), lambda g: g.isin(model.pairs))
    )
    columns = [f"w{k}" for k in range(NONE + 1)]
    shares = [f"s{k}" for k in range(NONE)]
    # Marks: the notices, each with the size of its word pairs and triples, then the families.
    notices = [(k, g) for k, f in enumerate(FAMILIES) for g in map(_long_grams, TEMPLATES[f])]
    having = defaultdict(set)
    for number, (family, longs) in enumerate(notices):
        for gram in longs:
            having[gram] |= {number, len(notices) + family}
    marks = small_table(
        spark, [(n, f, len(longs)) for n, (f, longs) in enumerate(notices)]
        + [(len(notices) + f, f, None) for f in range(NONE)],
        "mark int, family int, size int",
    )
    # A paragraph is judged by the n-grams it shares with the model or the notices, and by how many
    # pairs and triples it has.  Only these leave the task, and equal ones are scored once.
    shared = sorted({*model.index, *having})
    at = ["doc_id", "text_hash", "paragraph"]
    found = settled(found, *at, values=[
        _long_size(F.col("words")).alias("longer"),
        _shared_grams(F.col("words"), sorted(model.words), shared).alias("features"),
    ])
    key = ["set_a", "set_b"]
    found = stored(found.withColumns({
        "set_a": F.xxhash64("longer", "features"), "set_b": F.xxhash64(F.lit(1), "longer", "features"),
    }), "paragraphs")
    grams = found.select(*key, "longer", "features").distinct().select(
        *key, "longer", F.explode("features").alias("gram")
    )
    # One row per feature of a model of fixed size, or gram of a notice.
    nothing = [0.0] * (NONE + 1)
    known = small_table(
        spark, [(g, *(map(float, model.weights[model.index[g]]) if g in model.index else nothing), sorted(having.get(g, ())))
         for g in shared],
        "gram string, " + ", ".join(f"{c} double" for c in columns) + ", marks array<int>",
    )
    scored = grams.join(F.broadcast(known), "gram")
    sums = scored.groupBy(*key).agg(
        *[(F.sum(c) + float(b)).alias(c) for c, b in zip(columns, model.bias)]
    )
    # Of a notice's word pairs and triples those met, or of the paragraph's those in a family's notices.
    met = scored.select(*key, "longer", F.explode("marks").alias("mark")).groupBy(*key, "mark").agg(
        F.count(F.lit(1)).alias("n"), F.max("longer").alias("longer")
    ).join(F.broadcast(marks), "mark")
    share = F.col("n") / F.coalesce("size", "longer")
    met = met.groupBy(*key).agg(
        *[F.max(F.when(F.col("family") == k, share)).alias(s) for k, s in enumerate(shares)]
    )
    sums = sums.join(met, key, "left").fillna(0.0, shares)
    top = F.greatest(*columns)
    total = sum((F.exp(F.col(c) - top) for c in columns), F.lit(0.0))
    best = F.array_max(F.array(*[
        F.struct(F.col(f"w{k}").alias("w"), F.lit(f).alias("family"), F.col(f"s{k}").alias("s"))
        for k, f in enumerate(FAMILIES)
    ]))
    judged = sums.withColumns({
        "best": best, "none": F.exp(F.col(f"w{NONE}") - top) / total, "total": total, "top": top,
    }).filter("none < 0.5")
    probability = F.exp(F.col("best.w") - F.col("top")) / F.col("total")
    sure = (probability >= model.least) & (F.col("best.s") >= CONFIRMED)
    verdicts = judged.select(
        *key, F.col("best.family").alias("family"), probability.alias("probability"),
        F.col("best.s").alias("similarity"),
        F.when(sure, F.col("best.family")).otherwise("unknown").alias("verdict"),
    )
    places = found.select(*at, *key).distinct()
    return places.join(verdicts, key).drop(*key)


def scan_licences(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """Per document: paragraphs with a licence, the families confirmed, and how many are unknown.

    Null and empty texts have none.  Rows of equal id and text get equal results.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    model = model or Classifier(background_sample(docs))
    hits = scan_paragraphs(keyed, model).groupBy(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.array_sort(F.collect_set("verdict")), ",").alias("families"),
        F.count_if(F.col("verdict") == "unknown").alias("unknown"),
    )
    rows = keyed.drop("text").join(
        hits, keyed["doc_id"].eqNullSafe(hits["_id"]) & (keyed["text_hash"] == hits["_hash"]), "left"
    )
    return rows.select(
        "doc_id", F.coalesce("n", F.lit(0)).alias("n_paragraphs"),
        F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("unknown", F.lit(0)).alias("n_unknown"),
    )


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the licence families that their paragraphs name."""
    return scan_licences(load(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op5_licence_scan": op5_licence_scan}
ORACLES: dict[str, str] = {}
