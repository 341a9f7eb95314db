"""Licence scan: which licence families a text's paragraphs state.

A paragraph is a run of lines without a blank one between them. It is looked at
through windows of ``WINDOW`` words, each half over the next, so that a statement
may be wrapped over lines and its place in a long paragraph doesn't matter. A
window is scored by one logistic regression for each family over its distinct
word 1- and 2-grams. The regressions are sparse (fitted with an L1 penalty) and
are fitted on the driver to labelled paragraphs: statements made from the
templates by dropping words, joining statements of two families and adding
context, ordinary sentences that share their words, and their words scattered. Each family's score is
calibrated (Platt) on paragraphs left out of the fit. A paragraph in which no
family reaches the threshold is ``unknown``. A prediction counts as confirmed if
its window holds enough of the 2-grams of one of the family's templates.

Most paragraphs can't reach the threshold: a family's bias and all its positive
weights but those of its few strongest n-grams stay below it. So only texts,
paragraphs and windows that hold a word of such an n-gram are scored. These words
follow from the weights (``Model.triggers``), and leaving out the rest changes no
result.

Scoring is DataFrame functions only: the weights are one constant map from
n-gram to a number for each family, and a text's paragraphs are handled within
its row, so nothing is shuffled.

Defined results: null text counts as empty; a text without any word has 0
paragraphs; a text without licence statement has no families and a null best
family; texts are read whole, whatever their length; equal scores go to the
family that comes last in the alphabet; repeated rows give repeated results;
other columns play no part, whatever their names.
"""

from __future__ import annotations

import json
import math
import random
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import text_or_empty

#: Statements by family; a parameter.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": ("Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0.", "You may not use this file except in compliance with the Apache License.", "Under the terms of Apache 2.0.", "SPDX-License-Identifier: Apache-2.0"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted.", "Released under the BSD 3-Clause License.", "Distributed under the BSD License.", "SPDX: BSD-3-Clause"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License."),
    "cc0": ("This work is dedicated to the public domain under CC0 1.0.", "No rights reserved, CC0 public domain dedication."),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it under the terms of the GNU General Public License.", "Distributed under the terms of the GPL v3.", "GNU GPL v3 or later.", "SPDX-License-Identifier: GPL-3.0-or-later"),
    "mit": ("MIT License.", "Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.", "Licensed under the MIT License.", 'The software is provided "as is", without warranty of any kind.', 'The software is provided "as is".', "SPDX-License-Identifier: MIT"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.", "Under the MPL 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "proprietary": ("All rights reserved.", "Proprietary and confidential, unauthorized copying is prohibited.", "Copyright, all rights reserved."),
}
#: Ordinary sentences with words of licence statements.
ORDINARY = (
    "The driver showed a license to the officer.",
    "They reserved a table for the public dinner.",
    "The apache helicopter was under repair.",
    "Students of MIT released a new version of the work.",
    "All rights of way are kept open in general.",
    "You may use this road free of charge.",
    "A copy of the source was found in the library.",
    "The work is subject to weather and to the terms of trade.",
    "The version that was released last year is used in public.",
    "Fishing without a license is not permitted here.",
    "Creative work is common among the public.",
    "The general asked for permission to use the form.",
    "The software is sold with a warranty of two years.",
    "Any person may ask for a copy under the terms of the house.",
    "It is as it is, without doubt, and provided for in the file.",
    "Two of the later forms are distributed in binary and in print.",
)
#: Words that may stand around a statement without meaning anything for it.
CONTEXT = "lorem ipsum dolor sit amet und der die das mit les des pour dans que los las una con por time year people house water day long made good new".split()
#: Words of a window; the next one starts half a window later.
WINDOW = 40
THRESHOLD = 0.6
CONFIRMED_FROM = 0.5
#: Points and hyphens within a word belong to it, those at its end do not.
WORD = r"[a-z0-9][a-z0-9.-]*+"
BLANK_LINE = r"\n[\x20\x09\x0B-\x0D]*+\n"
UNKNOWN = "unknown"


def words_of(text: str) -> list[str]:
    return [w.rstrip(".-") for w in re.findall(WORD, text.lower())]


def _grams(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


def grams(paragraph: str) -> set[str]:
    return _grams(words_of(paragraph))


def _pairs(paragraph: str) -> list[str]:
    return sorted(g for g in grams(paragraph) if " " in g)


def windows(paragraph: str) -> list[list[str]]:
    words, step = words_of(paragraph), WINDOW // 2
    return [words[i : i + WINDOW] for i in range(0, max(1, len(words) - step), step)]


@dataclass
class Model:
    families: list[str]
    bias: list[float]
    weights: dict[str, list[float]]
    templates: dict[str, tuple[str, ...]]

    def score(self, statement: str) -> dict[str, float]:
        """Scores of one window."""
        found = [self.weights[g] for g in sorted(grams(statement)) if g in self.weights]
        return {f: 1 / (1 + math.exp(-max(-500.0, min(500.0, self.bias[i] + sum(w[i] for w in found))))) for i, f in enumerate(self.families)}

    def triggers(self, threshold: float = THRESHOLD) -> list[str]:
        """Words of which a window must hold one for any family to reach ``threshold``."""
        common = Counter(w for s in (*ORDINARY, *CONTEXT) for w in words_of(s))
        out: set[str] = set()
        for i, bias in enumerate(self.bias):
            strong = sorted(((w[i], g) for g, w in self.weights.items() if w[i] > 0), reverse=True)
            rest = bias + sum(w for w, _ in strong)
            for weight, gram in strong:
                if rest < math.log(threshold / (1 - threshold)) - 1e-3:
                    break
                rest -= weight
                parts = gram.split(" ")
                if not out & set(parts):  # both words of a 2-gram are there if it is
                    out.add(min(parts, key=lambda p: (common[p], -len(p), p)))
            else:
                raise ValueError(f"the bias of {self.families[i]} reaches the threshold by itself")
        return sorted(out)


def examples(templates: dict[str, tuple[str, ...]], ordinary: Iterable[str], seed: int = 7, copies: int = 24) -> list[tuple[str, frozenset[str]]]:
    """Labelled paragraphs: templates with words dropped, context added, and some joined with another's."""
    rng, out = random.Random(seed), []
    filler = [w for s in ORDINARY for w in re.findall(r"\w+", s.lower())] + CONTEXT
    around = lambda most: [rng.choice(filler) for _ in range(rng.randrange(most))]
    whole = [(family, text) for family, texts in templates.items() for text in texts]
    for family, text in whole:
        words = text.split()
        for i in range(copies):
            kept = [w for w in words if i == 0 or len(words) < 5 or rng.random() > 0.08]
            label, more = {family}, []
            if i % 4 == 3:
                other, also = rng.choice(whole)
                label, more = label | {other}, around(6) + also.split()
            head, tail = (around(12) if i > 2 else [] for _ in range(2))
            out.append((" ".join(head + kept + more + tail), frozenset(label)))
    for text in ordinary:
        words = text.split()
        for _ in range(copies):
            rest = [w for w in words if rng.random() > 0.1]
            out.append((" ".join(rest + around(16)), frozenset()))
    single = [w for _, text in whole for w in text.split()]
    for _ in range(2 * copies * len(whole)):  # words of statements apart from each other state nothing
        out.append((" ".join(w for word in rng.sample(single, rng.randrange(1, 6)) for w in (word, rng.choice(filler))), frozenset()))
    rng.shuffle(out)
    return out


def fit(templates: dict[str, tuple[str, ...]] | None = None, ordinary: Iterable[str] = ORDINARY, l1: float = 1e-3, rounds: int = 600) -> Model:
    templates = templates or TEMPLATES
    data = [(sorted(grams(p)), f) for p, f in examples(templates, ordinary)]
    cut = len(data) * 3 // 4
    often = Counter(g for found, _ in data[:cut] for g in found)
    names = sorted(g for g, n in often.items() if n > 2)  # the penalty leaves rarer ones no weight anyway
    place = {g: j for j, g in enumerate(names)}
    x = np.zeros((len(data), len(names)))
    for i, (found, _) in enumerate(data):
        x[i, [place[g] for g in found if g in place]] = 1.0
    families = sorted(templates)
    y = np.array([[f in label for f in families] for _, label in data], float)
    w, b = np.zeros((len(names), len(families))), np.full(len(families), -2.0)
    v, c, t = w.copy(), b.copy(), 1.0
    step = 4 * cut / (np.linalg.norm(x[:cut], 2) ** 2 + cut)
    for _ in range(rounds):  # accelerated proximal gradient
        error = (1 / (1 + np.exp(-np.clip(x[:cut] @ v + c, -50, 50))) - y[:cut]) / cut
        new = v - step * (x[:cut].T @ error)
        new = np.sign(new) * np.maximum(0, np.abs(new) - step * l1)
        new_b, new_t = c - step * error.sum(axis=0), (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / new_t * (new - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new, new_b, new_t
    bias = []
    for i in range(len(families)):
        a, shift = _calibrated((x[cut:] @ w[:, i] + b[i]).tolist(), (y[cut:, i] > 0).tolist())
        w[:, i] *= a
        bias.append(round(float(a * b[i] + shift), 4))
    w = np.round(w, 4)
    return Model(families, bias, {g: w[j].tolist() for g, j in place.items() if w[j].any()}, templates)


def _calibrated(logits: list[float], labels: list[bool]) -> tuple[float, float]:
    """Slope and intercept of Platt's calibration with smoothed targets."""
    hits = sum(labels)
    target = [(hits + 1) / (hits + 2) if y else 1 / (len(labels) - hits + 2) for y in labels]
    z, goal = np.array(logits), np.array(target)
    a, c = 1.0, 0.0
    for _ in range(300):
        e = 1 / (1 + np.exp(-np.clip(a * z + c, -50, 50))) - goal
        a, c = max(0.1, a - 0.02 * float(e @ z) / max(1, len(z))), c - 0.2 * float(e.mean() if len(z) else 0)
    return a, c


_FOUND = "array<struct<family:string,score:double,likeness:double>>"


def _judged(words: Column, model: Model, threshold: float) -> Column:
    """Families (family, score, likeness to its nearest template) that a window states."""
    pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    table = F.from_json(F.lit(json.dumps(model.weights)), "map<string,array<double>>")
    known = F.filter(F.transform(F.array_distinct(F.concat(words, pairs)), lambda g: F.try_element_at(table, g)), lambda w: w.isNotNull())
    start = F.array(*(F.lit(float(b)) for b in model.bias))
    sums = F.aggregate(known, start, lambda acc, w: F.zip_with(acc, w, lambda x, y: x + y))
    names = F.array(*map(F.lit, model.families))
    scored = F.transform(sums, lambda z, i: F.struct(F.get(names, i).alias("family"), F.round(1 / (1 + F.exp(-z)), 6).alias("score")))
    likeness = {}
    for family in model.families:
        listed = [F.array(*map(F.lit, _pairs(t))) for t in model.templates[family] if _pairs(t)]
        likeness[family] = F.greatest(*(F.size(F.array_intersect(pairs, t)) / F.size(t) for t in listed), F.lit(0.0))
    near = lambda family: F.coalesce(*(F.when(family == f, c) for f, c in likeness.items()))
    return F.transform(F.filter(scored, lambda s: s["score"] >= threshold), lambda s: F.struct(s["family"], s["score"], F.round(near(s["family"]), 6).alias("likeness")))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: paragraphs, those that state no known family, the families (confirmed ones apart), the best family and its score."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    triggers = model.triggers(threshold)
    cue = "(?i)(?<![a-z0-9])(?:" + "|".join(map(re.escape, triggers)) + ")(?![a-z0-9])"
    listed = F.array(*map(F.lit, triggers))
    # parts of a text without any word are no paragraphs
    paragraphs = F.filter(F.split("text", BLANK_LINE), lambda p: p.rlike("[A-Za-z0-9]"))
    rows = rows.withColumn("hit", F.col("text").rlike(cue) if triggers else F.lit(False))
    rows = rows.select("doc_id", F.size(paragraphs).cast("long").alias("n"), F.when(F.col("hit"), F.filter(paragraphs, lambda p: p.rlike(cue))).alias("cued"))
    step = WINDOW // 2

    def found(paragraph: Column) -> Column:
        words = F.transform(F.regexp_extract_all(F.lower(paragraph), F.lit(WORD), F.lit(0)), lambda w: F.rtrim(w, F.lit(".-")))
        # let-bindings: an array of one element, so that the words are found once
        parts = F.flatten(F.transform(F.array(words), lambda all_: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), (F.size(all_) - step - 1) / step).cast("int")), lambda i: F.slice(all_, i * step + 1, WINDOW))))
        return F.flatten(F.transform(F.filter(parts, lambda w: F.arrays_overlap(w, listed)), lambda w: _judged(w, model, threshold)))

    rows = rows.select("doc_id", "n", F.when(F.size("cued") > 0, F.filter(F.transform("cued", found), lambda f: F.size(f) > 0)).otherwise(F.array().cast(f"array<{_FOUND}>")).alias("stated"))
    rows = rows.select("doc_id", "n", F.size("stated").cast("long").alias("n_stated"), F.flatten("stated").alias("found"))
    sure = F.filter("found", lambda x: x["likeness"] >= CONFIRMED_FROM)
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: x["family"]))), ",")
    best = F.array_max(F.transform("found", lambda x: F.struct(x["score"].alias("score"), x["family"].alias("family"))))
    return rows.select(
        F.col("doc_id").alias(id_col),
        F.col("n").alias("n_paragraphs"),
        (F.col("n") - F.col("n_stated")).alias("n_unknown"),
        names("found").alias("families"),
        names(sure).alias("confirmed_families"),
        best["family"].alias("best_family"),
        best["score"].alias("best_score"),
    )
